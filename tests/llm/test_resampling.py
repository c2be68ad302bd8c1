import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from patchlode.llm import resampling
from patchlode.llm.resampling import drawn, importance_resample, ngram_crcs, running_crcs, shift_zeros

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n):
    words = WORD.findall((text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
    return words, [b" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, percent, n, buckets, least, seed):
    raw, aim = Counter(), Counter()
    for counts, texts in ((raw, [t for _, t in docs]), (aim, target)):
        for text in texts:
            counts.update(zlib.crc32(f) % buckets for f in features(text, n)[1])
    s, t = sum(raw.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s + buckets) / ((raw[b] + 1) * (t + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        words, found = features(text, n)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, len(words) >= least])
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(order[: percent * len(order) // 100])}
    return Counter((*r[:4], ranks.get(id(r))) for r in rows)


def made(seed, count):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta7", "ÉTÉ", "été", "x", "日本", "gamma", "don't", "a-b", "\x00z", "tail piece"]
    return [(i, rng.choice([" ", "\n", ", "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(count)]


@given(st.lists(st.text(alphabet="abZ9é日 .-\n", max_size=40), min_size=1, max_size=6), st.integers(1, 4))
@settings(max_examples=80, deadline=None)
def test_crcs_of_all_ngrams(texts, n):
    found = Counter((k, int(i), int(c)) for k, at, crc in ngram_crcs(pa.array(texts), n) for i, c in zip(at, crc))
    expected = Counter((f.count(b" ") + 1, i, zlib.crc32(f)) for i, t in enumerate(texts) for f in features(t, n)[1])
    assert found == expected


def test_prefixes_cancel():
    data = np.frombuffer(random.Random(3).randbytes(30_011), np.uint8)
    prefix = running_crcs(data)
    for a, b in ((0, 0), (0, 30_011), (5, 6), (17, 81), (100, 164), (3, 29_999), (30_011, 30_011)):
        assert int(prefix[b] ^ shift_zeros(prefix[[a]], np.array([b - a]))[0]) == zlib.crc32(data[a:b].tobytes())


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(t for _, t in made(4, 400)) + " " + "q" * 5000 + " end"
    whole = Counter((k, int(c)) for k, _, crc in ngram_crcs(pa.array([text]), 3) for c in crc)
    monkeypatch.setattr(resampling, "PIECE", 700)
    cut = Counter((k, int(c)) for k, _, crc in ngram_crcs(pa.array([text]), 3) for c in crc)
    assert whole == cut == Counter((f.count(b" ") + 1, zlib.crc32(f)) for f in features(text, 3)[1])


def test_equals_brute_force(spark):
    docs = made(1, 300) + [(7, None), (None, ""), (8, "one two"), (None, "w " * 30), (9, "w " * 30), (9, "w " * 30), (11, "a b c d e " * 30_000)]
    target = [t for _, t in made(2, 20)] + [None, ""]
    frame = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id bigint, text string, part int, score string").repartition(6)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance_resample(frame, aim, percent=25, n=2, buckets=500, least_words=20, seed=7)
    rows = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found.collect())
    assert rows == brute(docs, target, 25, 2, 500, 20, 7)
    chosen = drawn(frame, found).select("row.doc_id", "row.score", "rank").collect()
    assert sorted((r["rank"], r["doc_id"]) for r in chosen) == sorted((r[4], r[0]) for r in rows.elements() if r[4])
    assert {r["score"] for r in chosen} == {"s"}


def test_empty_tables(spark):
    docs, aim = "doc_id bigint, text string", "text string"
    assert importance_resample(spark.createDataFrame([], docs), spark.createDataFrame([("a",)], aim)).count() == 0
    rows = [(1, "a b " * 20), (2, None)]
    found = importance_resample(spark.createDataFrame(rows, docs), spark.createDataFrame([], aim), percent=100, buckets=50)
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found.collect()) == brute(rows, [], 100, 2, 50, 20, 7)
