import zlib
from collections import Counter, defaultdict

from patchlode.llm.sharding import interleaved_shards


def check(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    counts = [len(by[s]) for s in range(shards)]
    assert set(by) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_mixture_and_law(spark):
    rows = [(i, f"text {i}" * (i % 7), "hot" if i % 3 else f"s{i % 5}", 1) for i in range(1003)]
    rows += [(5, None, None, 1), (5, None, None, 1), (5, "é", None, 1), (None, "", "", 1), (None, "x", "hot", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, `all` int")
    found = interleaved_shards(docs, shards=8, per_range=50).collect()
    check(found, 8)
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), s) for i, t, s, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["source"]) for r in found) == expected
    total = Counter(r["source"] for r in found)
    for shard in range(8):
        here = Counter(r["source"] for r in found if r["shard"] == shard)
        assert all(abs(here[s] - n / 8) <= len(total) / 2 + 1 for s, n in total.items())
    assert {(r["law"], r["grown_shard"]) for r in found} == {("rows", None)}
    again = interleaved_shards(docs.repartition(7), shards=8, per_range=50).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_few_rows_and_none(spark):
    schema = "doc_id bigint, text string, source string"
    check(interleaved_shards(spark.createDataFrame([(1, "a", "s"), (2, "b", "s")], schema), 24).collect(), 24)
    assert interleaved_shards(spark.createDataFrame([], schema), 24).count() == 0
