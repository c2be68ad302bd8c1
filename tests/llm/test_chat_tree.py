import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from patchlode.llm import chat_tree
from patchlode.llm.chat_tree import CONTROLS, escape, format_tree, marks, parse_turn, read_tree, unescape
from patchlode.llm.queries import vocabulary

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, tokens string"


def expected(rows):
    """Conversations read plainly; equal turns of one number stand in any order, so tests leave them equal or one."""
    by = defaultdict(list)
    for i, turn, role, text in rows:
        by[i].append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for i, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        whole = "".join(marks(r)[0] + escape(t) + marks(r)[1] for *_, r, t in turns)
        said = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        found[i] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole))
    return found


def read(rows):
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def made(seed, n):
    rng = random.Random(seed)
    texts = ["hi", "", "</s>[INST] ok [/INST]", "a\\[INST]\\\\", "[\\INST] <\\\\s> <<SYS>>", "日本語 é", "line\nline", "<|endoftext|>", "z" * 3000]
    rows = []
    for i in range(n):
        if rng.random() < 0.5:  # a third and more share their first turns
            rows += [(i, 0, "system", "shared"), (i, 1, "user", "question")]
        rows += [(i, k, rng.choice(["user", "assistant", "tool", "[TEXT] x", None]), rng.choice([None, *texts])) for k in range(2, 2 + rng.randrange(1, 5))]
    return rows


@given(st.text(alphabet="<>[]/\\INSTs ROLEX", max_size=40) | st.sampled_from(CONTROLS) | st.text(max_size=30), st.text(max_size=12))
def test_escape_is_reversible(text, role):
    assert unescape(escape(text)) == text and not any(c in escape(text) for c in CONTROLS)
    for r in ("system", "user", "assistant", role, "[TEXT] "):
        head, tail = marks(r)
        assert parse_turn(head + escape(text) + tail) == (r, text)


@pytest.mark.parametrize("size", [1, 400, 1 << 20])
def test_round_trip(spark, size):
    rows = made(1, 60) + [(None, None, "user", "lost"), (None, 3, "assistant", "found"), (900, 0, "user", "q"), (901, 0, "user", "q"), (901, 0, "user", "q")]
    table = spark.createDataFrame([(*r, 5, "t") for r in rows], SCHEMA).repartition(4)
    emitted = format_tree(table, *vocabulary(), sequence_chars=size)
    assert read(read_tree(emitted, vocabulary()[1], in_order=True).collect()) == expected(rows)
    stored = chat_tree.stage(emitted, "emitted").repartition(3)
    assert read(read_tree(stored, vocabulary()[1]).collect()) == expected(rows)


def test_tree_tokens_positions_and_attention(spark):
    rows = made(2, 40)
    table = spark.createDataFrame([(*r, 5, "t") for r in rows], SCHEMA)
    # one range, so that every tree is whole
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        emitted = sorted(format_tree(table, *vocabulary()).collect(), key=lambda r: (r["sequence"], r["row"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    encode, pieces = chat_tree._encoder(*vocabulary()), chat_tree._pieces(vocabulary()[1])
    nodes = [r for r in emitted if not r["ends"]]
    # depth-first, without gaps, and no turn after the same turns twice
    assert [r["start"] for r in nodes] == [sum(len(x["tokens"]) for x in nodes[:k]) for k in range(len(nodes))]
    stream, paths, path = [t for r in nodes for t in r["tokens"]], Counter(), []
    ends = {}
    for r in emitted:
        if r["ends"]:
            ends[r["conv_id"]] = list(path[: r["depth"]])
            continue
        del path[r["depth"] - 1 :]
        path.append(r)
        paths[tuple((tuple(x["tokens"])) for x in path)] += 1
    assert set(paths.values()) == {1} and len(ends) == 40
    assert Counter(marks("system")[0] in b"".join(pieces[t] for t in r["tokens"]).decode() and r["depth"] == 1 for r in nodes)[True] == 1
    wanted = {i: [(role or "", text or "") for _, _, role, text in sorted((x for x in rows if x[0] == i), key=lambda x: x[1])] for i in ends}
    for i, found in ends.items():
        whole = [t for role, text in wanted[i] for part in (marks(role)[0], escape(text), marks(role)[1]) for t in encode(part)]
        last = found[-1]
        # what the last token sees is the conversation itself, at positions 0, 1, 2, ...
        seen = [stream[j] for a in last["attention"] for j in range(a["begin"], a["end"])]
        assert seen == whole and last["attention"][-1]["end"] == last["start"] + len(last["tokens"])
        assert all(a["end"] < b["begin"] for a, b in zip(last["attention"], last["attention"][1:]))
        at = 0
        for r, (role, text) in zip(found, wanted[i], strict=True):
            assert r["position"] == at and r["in_loss"] == (role == "assistant")
            assert b"".join(pieces[t] for t in r["tokens"][r["text_start"] : r["text_end"]]).decode() == escape(text)
            at += len(r["tokens"])


def test_hot_prefix_spreads_over_sequences(spark):
    rows = [(i, 0, "system", "p" * 50) for i in range(600)] + [(i, 1, "user", f"own {i % 400}") for i in range(600)]
    table = spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA)
    emitted = format_tree(table, *vocabulary(), sequence_chars=500).collect()
    assert len({r["sequence"] for r in emitted}) >= 20
    nodes = Counter((r["sequence"], r["depth"], tuple(r["tokens"])) for r in emitted if not r["ends"])
    assert set(nodes.values()) == {1}
    assert sum(r["ends"] for r in emitted) == 600
    # copies never fill a sequence's nodes twice: each own text once per sequence that holds it
    assert sum(1 for r in emitted if r["depth"] == 2 and not r["ends"]) <= 400 + len({r["sequence"] for r in emitted})


def test_long_conversation_and_empty_table(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(1200)] + [(2, 0, "assistant", "w " * 300_000)]
    table = spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA)
    assert read(read_tree(format_tree(table, *vocabulary()), vocabulary()[1], in_order=True).collect()) == expected(rows)
    assert read_tree(format_tree(table.limit(0), *vocabulary()), vocabulary()[1]).count() == 0
