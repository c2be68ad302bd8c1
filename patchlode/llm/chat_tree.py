"""Chat formatting as prefix trees: turns that conversations share at their beginning are emitted once.

A node of a tree is a turn after given turns. A tree is written depth-first; each node carries its tokens,
their place in the sequence, the position ids they have on their own path, and the token intervals that they may
attend to: those of all ancestors, neighbouring ones merged, and the node itself up to the own token. So a model reads every conversation
as if it stood alone, but shared turns cost once.

1. Turns are reduced to hashes and sizes. A conversation's path is the array of its turns' hashes. In lexicographic order of paths
   conversations that share turns are neighbours, and the order is that of a depth-first walk. Spark sorts them in ranges.
2. A pass over each range compares a path with the one before: turns beyond the common ones are new. Runs of about
   ``sequence_chars`` new characters become one sequence. A tree that is larger, or crosses a range, is continued in the next sequence,
   which repeats the turns above its first new one. So no tree has to fit a task, however many conversations share a turn.
3. Only new turns carry their text to the sequence, and one row per conversation tells where it ends. They are tokenised
   in order; the state of that pass is the path to the current node.

Each turn is an opening mark, the text and a closing mark, tokenised one by one, so that spans of the loss are whole tokens.
Control strings inside texts get a backslash after their first character (further ones where backslashes stand there already), which
reading takes away again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import stage
from .words import chunks

#: Opening and closing marks of the usual roles; others are named inside OTHER.
MARKS = {"system": ("<<SYS>> ", " <</SYS>>\n"), "user": ("[INST] ", " [/INST]\n"), "assistant": ("<s> ", " </s>\n")}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]\n")
CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]")
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROLS)
_ESCAPE = re.compile(rf"([<\[])(\\*)(?={_TAILS})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?={_TAILS})")

NODES = (
    "sequence bigint, row bigint, depth int, role string, start bigint, position bigint, tokens array<int>, text_start int, text_end int,"
    " in_loss boolean, attention array<struct<begin:bigint,end:bigint>>, ends boolean, conv_id {kind}"
)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def marks(role: str) -> tuple[str, str]:
    """What stands before and after the escaped text of a turn."""
    if role in MARKS:
        return MARKS[role]
    return OTHER[0] + escape(role) + OTHER[1], OTHER[2]


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    for role, (head, tail) in MARKS.items():
        if formatted.startswith(head):
            return role, unescape(formatted[len(head) : -len(tail)])
    role, _, text = formatted[len(OTHER[0]) :].partition(OTHER[1])
    return unescape(role), unescape(text[: -len(OTHER[2])])


#: Runs without white space from this length on go to the encoder that stays linear on them.
_LONG_RUN = re.compile(r"\S{2000}")


@lru_cache(maxsize=4)
def _pieces(ranks_path: str) -> dict[int, bytes]:
    """The bytes of each token."""
    return {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(ranks_path, "rb"))}


@lru_cache(maxsize=4)
def _encoder(json_path: str, ranks_path: str) -> Callable[[str], list[int]]:
    """Tokens of a text, all of it ordinary: strings of special tokens are no exception."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path)
    slow.encode_special_tokens = True
    ranks = {piece: token for token, piece in _pieces(ranks_path).items()}
    fast = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        return slow.encode(text, add_special_tokens=False).ids if _LONG_RUN.search(text) else fast.encode_ordinary(text)

    return encode


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    conv_id = F.col(conv_col)
    key = F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("")).alias("key")
    return conversations.select(
        key, conv_id.alias("conv_id"), F.coalesce(F.col(turn_col).cast("bigint"), F.lit(-(1 << 63))).alias("turn"), role.alias("role"),
        text.alias("text"), F.xxhash64(role, text).alias("k1"), F.xxhash64(text, role, F.lit("second")).alias("k2"),
    )


_ORDER = ("turn", "role", "k1", "k2")


def _cut(sequence_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Conversations in order of their paths: sequence, place in it, and the number of turns that stand there already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, place, size, before = TaskContext.get().partitionId() << 33, 0, 0, []
        for batch in batches:
            sequences, places, known, counts = [], [], [], []
            for turns in batch.column("turns"):
                path = list(zip(*(turns.values.field(f).to_pylist() for f in ("k1", "k2")), strict=True)) if len(turns) else []
                sizes = turns.values.field("n").to_pylist() if path else []
                if size >= sequence_chars:
                    sequence, place, size, before = sequence + 1, 0, 0, []
                same = 0
                while same < min(len(path), len(before)) and path[same] == before[same]:
                    same += 1
                size += sum(sizes[same:]) + 16
                sequences.append(sequence)
                places.append(place)
                known.append(same)
                counts.append(len(path))
                place, before = place + 1, path
            made = [pa.array(x, pa.int64()) for x in (sequences, places, known, counts)]
            own = [batch.column(c) for c in ("key", "conv_id")]
            yield pa.RecordBatch.from_arrays([*own, *made], ["key", "conv_id", "sequence", "place", "known", "n_turns"])

    return run


@dataclass
class _Node:
    end: int
    position: int
    attention: list[tuple[int, int]] = field(default_factory=list)


def _emit(paths: tuple[str, str], loss_role: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(*paths)
        mark_ids = lru_cache(maxsize=1024)(lambda role: tuple(tuple(encode(m)) for m in marks(role)))
        sequence, row, used, path = None, 0, 0, []
        for batch in batches:
            for part in chunks(batch, "text"):
                out: list[dict] = []
                columns = (part.column(c).to_pylist() for c in ("sequence", "i", "role", "text", "ends"))
                for own, i, role, text, ends in zip(*columns, strict=True):
                    if own != sequence:
                        sequence, row, used, path = own, 0, 0, []
                    made = {"sequence": own, "row": row, "ends": ends}
                    row += 1
                    if ends:
                        del path[i:]
                        out.append(made | {"depth": i})
                        continue
                    del path[i - 1 :]
                    head, tail = mark_ids(role)
                    body = encode(escape(text))
                    tokens = [*head, *body, *tail]
                    over = path[-1] if path else _Node(used, 0)
                    seen = [*over.attention[:-1], (over.attention[-1][0], used + len(tokens))] if over.attention and over.end == used else [
                        *over.attention, (used, used + len(tokens))]
                    out.append(made | {
                        "depth": i, "role": role, "start": used, "position": over.position, "tokens": tokens, "text_start": len(head),
                        "text_end": len(head) + len(body), "in_loss": role == loss_role, "attention": [{"begin": a, "end": b} for a, b in seen]})
                    used += len(tokens)
                    path.append(_Node(used, over.position + len(tokens), seen))
                yield _batch(out, part.column("conv_id"))

    return run


_INTERVALS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_KINDS = {
    "sequence": pa.int64(), "row": pa.int64(), "depth": pa.int32(), "role": pa.string(), "start": pa.int64(), "position": pa.int64(),
    "tokens": pa.list_(pa.int32()), "text_start": pa.int32(), "text_end": pa.int32(), "in_loss": pa.bool_(), "attention": _INTERVALS, "ends": pa.bool_(),
}


def _batch(rows: list[dict], conv_id: pa.Array) -> pa.RecordBatch:
    made = [pa.array([r.get(name) for r in rows], kind) for name, kind in _KINDS.items()]
    return pa.RecordBatch.from_arrays([*made, conv_id], [*_KINDS, "conv_id"])


def format_tree(
    conversations: DataFrame, json_path: str, ranks_path: str, sequence_chars: int = 1 << 20, loss_role: str = "assistant",
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """The emitted sequences, in order inside each: a row per node and a row (``ends``) where a conversation ends.

    A node has ``depth`` (1 for a first turn), ``role``, ``start`` (its first token's place in the sequence), ``position`` (that token's position
    id), ``tokens``, the part of them that is the text, ``in_loss``, and the ``attention`` intervals of its last token; token j of it sees these up
    to ``start`` + j. An end row has the depth of its node and the ``conv_id``.

    Every row is a turn: in order of turn (null first), role, then a hash of the text. Null roles and texts count as empty. Rows
    with a null conv_id form one conversation. Equal conversations end at the same node. A conversation is never cut,
    so one longer than ``sequence_chars`` is a sequence of its own; what a task holds of it is one piece of text and its path.
    Other columns are not read. An empty table gives an empty result.
    """
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col)
    kind = turns.schema["conv_id"].dataType.simpleString()
    own: Column = F.struct(*_ORDER, F.length("text").alias("n"))
    listed = turns.groupBy("key").agg(F.first("conv_id").alias("conv_id"), F.array_sort(F.collect_list(own)).alias("turns"))
    thin = listed.select("key", "conv_id", F.transform("turns", lambda t: F.struct(t["k1"].alias("k1"), t["k2"].alias("k2"), t["n"].alias("n"))).alias("turns"))
    ordered = thin.repartitionByRange("turns", "key").sortWithinPartitions("turns", "key")
    # sequences are fixed by writing them
    cut = stage(ordered.mapInArrow(_cut(sequence_chars), f"key string, conv_id {kind}, sequence bigint, place bigint, known bigint, n_turns bigint"), "sequences")

    of_conversation = Window.partitionBy("key").orderBy(*_ORDER)
    numbered = turns.drop("conv_id").withColumn("i", F.row_number().over(of_conversation).cast("bigint"))
    new = numbered.join(cut.select("key", "sequence", "place", "known"), "key").where(F.col("i") > F.col("known"))
    nodes = new.select("sequence", "place", "i", "role", "text", F.lit(False).alias("ends"), F.lit(None).cast(kind).alias("conv_id"))
    ends = cut.select(
        "sequence", "place", F.col("n_turns").alias("i"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
        F.lit(True).alias("ends"), "conv_id")
    rows = nodes.unionByName(ends).repartition("sequence").sortWithinPartitions("sequence", "place", "ends", "i")
    return rows.mapInArrow(_emit((json_path, ranks_path), loss_role), NODES.format(kind=kind))


@dataclass
class _State:
    """What is known of the turns down to a node."""

    turns: "hashlib._Hash"
    loss: "hashlib._Hash"
    n_turns: int = 0
    loss_chars: int = 0
    chars: int = 0


def _read(ranks_path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = _pieces(ranks_path)
        sequence, path = None, []
        for batch in batches:
            found: list[tuple] = []
            at: list[int] = []
            names = ("sequence", "depth", "tokens", "text_start", "text_end", "in_loss", "ends")
            for n, (own, depth, tokens, first, last, in_loss, ends) in enumerate(zip(*(batch.column(c).to_pylist() for c in names), strict=True)):
                if own != sequence:
                    sequence, path = own, [_State(hashlib.sha256(), hashlib.sha256())]
                if ends:
                    s = path[depth]
                    at.append(n)
                    found.append((s.n_turns, s.turns.hexdigest(), s.loss_chars, s.loss.hexdigest(), s.chars))
                    continue
                del path[depth:]
                over = path[-1]
                formatted = b"".join(piece[t] for t in tokens).decode()
                role, text = parse_turn(formatted)
                state = _State(over.turns.copy(), over.loss.copy(), over.n_turns + 1, over.loss_chars, over.chars + len(formatted))
                state.turns.update(f"{role}\n{text}\n".encode())
                if in_loss:
                    under = unescape(b"".join(piece[t] for t in tokens[first:last]).decode())
                    state.loss.update(under.encode())
                    state.loss_chars += len(under)
                path.append(state)
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            own = batch.column("conv_id").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([own, *made], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return run


def read_tree(emitted: DataFrame, ranks_path: str, in_order: bool = False) -> DataFrame:
    """What the emitted tokens say of each conversation: its turns and the text under the loss, parsed back and digested.

    Digests follow the walk: a node adds to its parent's, so shared turns are read once. Emitted rows that were stored are sorted by
    (sequence, row) first; ``in_order`` says that they come straight from ``format_tree``. A conversation without turns has no row.
    """
    kind = emitted.schema["conv_id"].dataType.simpleString()
    if not in_order:
        emitted = emitted.repartition("sequence").sortWithinPartitions("sequence", "row")
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return emitted.mapInArrow(_read(ranks_path), schema)
