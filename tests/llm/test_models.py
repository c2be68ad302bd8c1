"""Held-out accuracy of the trained operators on small texts, and their handling of odd rows."""

import random
import zlib

from patchlode.llm.langid import fit_language_model, identify_languages
from patchlode.llm.toxicity import fit_toxicity, score_toxicity

WORDS = {
    "aa": ["the", "house", "with", "windows", "stands", "there", "where", "wind", "goes"],
    "bb": ["der", "zug", "fährt", "über", "brücken", "nach", "osten", "und", "zurück"],
    "cc": ["el", "camino", "está", "lleno", "de", "piedras", "pequeñas", "y", "agua"],
}


def texts(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        words = [rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "en"]) for _ in range(rng.randrange(2, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(max(2, len(words) // 12)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["vilefool", "grimscum", "rottwit"]) + rng.choice(["", "x", "ing"]))
        rows.append((i, " ".join(words), lang, int(toxic)))
    return rows


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


ODD = [(9001, None, None), (9002, "", "aa"), (9003, "123 !!! 4", "aa"), (None, "the house stands", "aa"), (9001, "the wind", "aa")]


def test_languages(spark):
    rows = texts(600)
    docs = spark.createDataFrame([(i, t, l, "x", 0.5) for i, t, l, _ in rows] + [(*r, "x", 0.5) for r in ODD],
                                 "doc_id bigint, text string, lang string, lang_pred string, score double")
    found = identify_languages(docs, fit_language_model(docs)).select("rest.doc_id", "text", "held_out", "lang_pred", "score", "rejected").collect()
    assert len(found) == len(rows) + len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    truth = {i: l for i, _, l, _ in rows}
    test = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert test and all(held(r["doc_id"]) for r in test)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in test) / len(test) > 0.97
    odd = {r["text"]: r for r in found if r["text"] in (None, "", "123 !!! 4", "the house stands")}
    assert all(odd[t]["lang_pred"] == "und" and odd[t]["rejected"] for t in (None, "", "123 !!! 4"))
    assert odd["the house stands"]["lang_pred"] == "aa" and odd["the house stands"]["held_out"] is False
    assert sum(r["rejected"] for r in found) <= 3 + 0.02 * len(rows)


def test_rejection_with_two_learned_languages_and_long_labelled_texts(spark):
    """What was not learned is rejected however few languages there are; mixes of two stay; a language of long texts alone is learned."""
    rows = [r for r in texts(900, 5) if r[2] != "cc"]
    long = [(5000 + i, " ".join(random.Random(i).choices(WORDS["cc"], k=9000)), "cc") for i in range(60)]
    strange = ["zqx vvk qqj wkx zzq pqx jjv kkz xqz vqj wqq", "Πλην του λόγου αυτού δεν υπάρχει κάτι άλλο"]
    mix = "the house with windows stands der zug fährt über brücken nach osten where the wind goes"
    schema = "doc_id bigint, text string, lang string"
    two = spark.createDataFrame([(i, t, l) for i, t, l, _ in rows] + [(7000 + i, t, None) for i, t in enumerate([*strange, mix])], schema)
    model = fit_language_model(two)
    assert model.labels == ["aa", "bb"]
    found = {r["text"]: r["rejected"] for r in identify_languages(two, model).select("text", "rejected").collect()}
    assert all(found[t] for t in strange) and not found[mix]
    assert sum(found[t] for _, t, _, _ in rows) <= 0.02 * len(rows)
    foreign = spark.createDataFrame([(1, " ".join(WORDS["cc"] * 3), None), (2, "the house", None)], schema)
    assert {r["doc_id"]: r["rejected"] for r in identify_languages(foreign, model).select("rest.doc_id", "rejected").collect()} == {1: True, 2: False}
    three = spark.createDataFrame([(i, t, l) for i, t, l, _ in rows] + long, schema)
    model = fit_language_model(three)
    assert model.labels == ["aa", "bb", "cc"] and min(len(t) for _, t, _ in long) > 20_000
    found = identify_languages(three, model).where("rest.doc_id >= 5000").select("lang_pred", "rejected").collect()
    assert {tuple(r) for r in found} == {("cc", False)}


def test_no_labels_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    model = fit_language_model(docs)
    assert [r["lang_pred"] for r in identify_languages(docs, model).collect()] == ["und"]
    assert identify_languages(docs.limit(0), fit_language_model(docs.limit(0))).count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    scored = score_toxicity(docs, fit_toxicity(docs, labels)).collect()
    assert len(scored) == 1 and scored[0]["predicted"] == 0
    assert score_toxicity(docs.limit(0), fit_toxicity(docs.limit(0), labels)).count() == 0


def test_toxicity(spark):
    rows = texts(1200, 3)
    docs = spark.createDataFrame([(i, t, l, "x") for i, t, l, _ in rows] + [(*r, "x") for r in ODD], "doc_id bigint, text string, lang string, toxic string")
    labels = spark.createDataFrame([(i, y, 1) for i, _, _, y in rows] + [(9002, None, 1), (None, 1, 1), (9001, 0, 1), (9001, 0, 1)], "doc_id bigint, toxic int, text int")
    found = score_toxicity(docs, fit_toxicity(docs, labels)).collect()
    assert len(found) == len(rows) + len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    truth = {i: y for i, _, _, y in rows}
    test = [(r["predicted"], truth[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in truth]
    right = sum(p and y for p, y in test)
    assert right / sum(y for _, y in test) > 0.85 and right / sum(p for p, _ in test) > 0.85
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in found)
