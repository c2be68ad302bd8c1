import re
import random

import corpus_pipeline
from patchlode.session import stage


def test_stages_take_effect_and_handle_odd_rows(spark, tmp_path):
    rng = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnpr" for b in ("a", "e", "ing", "or") for c in ("ta", "li", "son", "me")]
    new = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bench, passage = new(30), new(60)
    rows = [(i, new(120), "en", "s", 1) for i in range(40)]
    rows += [(100, f"{new(50)} {passage} {new(50)}", "en", "s", 1), (101, f"{new(40)} {passage} {new(60)}", "en", "s", 1)]
    rows += [(102, f"{new(60)} {bench} {new(60)}", "en", "s", 1)]
    near = rows[0][1].split()
    near[60] = "changed"
    rows += [(50, " ".join(near), "en", "s", 1), (51, rows[0][1], "en", "s", 1), (0, *rows[0][1:])]
    rows += [(200, None, None, None, None), (201, "", "en", "s", 0), (202, "12 34 !!", "en", "s", 1), (None, new(80), "en", "s", 1)]
    sf = str(tmp_path)
    spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4], "extra", 3) for r in rows],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint, k1 string, `row` int").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, bench), (2, None)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    after = {}
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, sf), name)
        after[name] = docs.collect()
        if name != "packing":
            assert docs.schema == before.schema
    ids = {name: [r["doc_id"] for r in kept] for name, kept in after.items()}
    assert not {200, 201, 202} & set(ids["language_id"]) and len(ids["language_id"]) == len(rows) - 3
    assert ids["near_dedup"].count(0) == 1 and not {50, 51} & set(ids["near_dedup"])
    assert len(ids["near_dedup"]) == len(ids["language_id"]) - 3 and None in ids["near_dedup"]
    texts = {r["doc_id"]: r["text"] for r in after["substring_dedup"]}
    source = {r[0]: r[1] for r in rows}
    for i, t in texts.items():
        assert t == source[i].replace(passage, "").replace("  ", " ") if i in (100, 101) else t == source[i]
    assert 102 not in ids["decontamination"] and len(ids["decontamination"]) == len(ids["substring_dedup"]) - 1
    assert set(ids["packing"]) == set(ids["decontamination"])
    spark.createDataFrame([], docs.sparkSession.read.parquet(f"{sf}/documents.parquet").schema).write.parquet(f"{sf}/none/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{sf}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{sf}/none").count() == 0


def test_nothing_swallows_import_errors():
    import pathlib

    root = pathlib.Path(corpus_pipeline.__file__).parent
    for file in [root / "corpus_pipeline.py", *(root / "patchlode" / "llm").glob("*.py")]:
        assert not re.search(r"except\s+\(?(ImportError|ModuleNotFoundError)", file.read_text())
