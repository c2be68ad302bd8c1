import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from patchlode.llm.packing import _encoder, _places, configured, pack, plan

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("kind", ["uniform", "hot", "large", "small", "one", "none", "full"])
def test_plan_holds_every_piece_and_is_short(kind):
    rng = random.Random(1)
    lengths = {
        "uniform": [rng.randrange(1, 1025) for _ in range(20_000)],
        "hot": [600] * 5000 + [rng.randrange(1, 1025) for _ in range(5000)] + [300] * 3000,
        "large": [rng.randrange(300, 700) for _ in range(5000)],
        "small": [rng.randrange(1, 40) for _ in range(5000)],
        "one": [17], "none": [], "full": [1024] * 9,
    }[kind]
    hist = Counter(lengths)
    bins = plan(dict(hist), 1024)
    held = Counter()
    for count, items in bins:
        assert count > 0 and sum(s * n for s, n in items) <= 1024
        for s, n in items:
            held[s] += count * n
    assert held == hist
    used, least = sum(c for c, _ in bins), -(-sum(lengths) // 1024)
    assert used <= least * (1.2 if kind in ("large", "hot") else 1.01) + 1
    ends = {}
    for s, a, b, *_ in _places(bins):
        assert ends.get(s, 0) == a
        ends[s] = b
    assert ends == dict(hist)


def test_configurations_place_the_large_pieces():
    rng = random.Random(3)
    for lengths in ([rng.randrange(1, 1025) for _ in range(30_000)], [rng.randrange(257, 512) for _ in range(9000)], [rng.randrange(257, 800) for _ in range(700)]):
        hist = Counter(lengths)
        made, left = configured(dict(hist), 1024)
        placed = Counter()
        for count, items in made:
            assert count > 0 and sum(s * n for s, n in items) <= 1024
            for s, n in items:
                placed[s] += count * n
        large = sum(256 < s < 1024 for s in lengths)
        assert all(256 < s < 1024 for s in placed) and sum(placed.values()) >= 0.95 * large
        assert placed + Counter(left) == hist


def test_plan_against_all_partitions():
    rng = random.Random(5)

    def fewest(items, bins):
        if not items:
            return len(bins)
        best, seen = len(items) + len(bins), set()
        for i, gap in enumerate(bins):
            if gap >= items[0] and gap not in seen:
                seen.add(gap)
                best = min(best, fewest(items[1:], [*bins[:i], gap - items[0], *bins[i + 1 :]]))
        return min(best, fewest(items[1:], [*bins, 20 - items[0]]))

    for _ in range(60):
        lengths = sorted((rng.randrange(1, 21) for _ in range(rng.randrange(1, 8))), reverse=True)
        assert sum(c for c, _ in plan(dict(Counter(lengths)), 20)) <= fewest(lengths, []) + 1


def test_fast_ids_equal_the_tokenizer():
    rng = random.Random(2)
    texts = ["", " ", "a\r\n\tb  c", "naïve café ½ 1234 '’s don't I'LL", "<|endoftext|> x", "x" * 5000, "日本語 text ́ ​ \x00 ﻿"]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FF), rng.randrange(0x4E00, 0x4F00), 10, 0x1F600])) for _ in range(200)) for _ in range(200)]
    plain, encode = Tokenizer.from_file(JSON), _encoder(JSON, RANKS)
    for t in texts:
        assert list(encode(t)) == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_make_up_documents(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc def ghi ") for _ in range(n)) for n in [0, 1, 5, 2000, 3000, 9000, *range(10, 900, 11)]] + [None]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "null id", 1, "x"), (3, texts[3], 1, "x"), (4, "other", 2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, length int, part string")
    found = pack(docs, JSON, RANKS, per_range=20, with_ids=True).collect()
    plain = Tokenizer.from_file(JSON)
    expected = []
    for i, t, *_ in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        expected += [(i, j, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b])) for j, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in found) == Counter(expected)
    by = {}
    for r in found:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for a, n in sorted(spans):
            assert a == at
            at += n
        assert at <= 1024
    assert len(by) <= -(-sum(r["length"] for r in found) // 1024) + 1
    assert pack(docs.limit(0), JSON, RANKS).count() == 0
