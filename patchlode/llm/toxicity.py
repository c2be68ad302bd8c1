"""Toxicity by class-conditional Kneser-Ney models.

The units are lower-cased words. Words end at Unicode white space, punctuation, digits and control characters. Runs of
more than ``LONG`` letters, and scripts written without spaces at any length, are no single words: they are read
whole, as overlapping units of ``STEM`` characters (``PAIR`` for ideographs and kana). Each class (toxic, ordinary) has an
absolute-discount model of its words; the discounted mass goes to one backoff that both share, the continuation counts: after
how many different words a word is met in either class. A rare expression therefore gets nearly the same
probability from both. A word that was met in neither class is read by its stem, its first ``STEM`` letters, in a
second pair of models, whose backoff counts the different words of a stem.

A text's evidence is the difference of the two log-likelihoods over its words, normalised by their number. Of a word's difference
only what exceeds ``MARGIN`` counts: the many small differences of words that both classes use tell subject and language, and
in a long text their sum would hide a few plain expressions. A logistic curve over the root of that mean turns it into a score.

Counts cover all labelled rows that may be learned from and are summed by Spark. Words and stems are hashed to
``2**CELLS`` cells each, so the tables that the scoring tasks get have a fixed size. The curve is
cross-fitted: the rows of each of ``FOLDS`` folds are read by a model of the others. At most ``most_fitted`` rows
of each class are drawn for it, and the intercept is corrected for the draw.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import bitmap, drop_staged, has, held_out, row_key, stage, training
from .words import U, buffers, chunks, mix

STEM = 4
PAIR = 2
LONG = 16
CELLS = 20
_WIDE = CELLS + 1  # bits of a cell with the one that tells stems from words
_BITS = 26
FOLDS = 4
# where the slope starts from, and how far the rows may easily move it: few labels stay near it, many decide themselves
DEFAULT_SLOPE = 25.0
_SLOPE_SPREAD = 1.0
#: What a word's log-likelihood difference must exceed to count.
MARGIN = 1.0


@dataclass
class Model:
    """Log-likelihood difference of each cell, words (nan where never met) before stems, and the curve: slope, intercept, score without words."""

    delta: np.ndarray
    slope: float
    intercept: float
    prior: float


_OUT, _LETTER, _UNSPACED, _IDEOGRAPH, _IGNORED = range(5)
_WIDTH = np.array([0, STEM, STEM, PAIR, 0])
# fixed values: Thai to Tibetan, Myanmar, Khmer, Tai Lue and Tai Tham, Javanese, Myanmar extensions, Tai Viet
_NO_SPACES = ((0x0E00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x1AB0), (0xA980, 0xAAE0))
# fixed values: ideographs, kana, bopomofo
_IDEOGRAPHS = ((0x2E80, 0x3130), (0x3190, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1AFF0, 0x1B170), (0x20000, 0x40000))
_classes: list[np.ndarray] = []


def _class_of() -> np.ndarray:
    """The class of each code point; made once in a process."""
    if not _classes:
        found = np.full(0x110000, _LETTER, np.uint8)
        for spans, kind in ((_NO_SPACES, _UNSPACED), (_IDEOGRAPHS, _IDEOGRAPH)):
            for a, b in spans:
                found[a:b] = kind
        for c in range(0x20000):
            group = unicodedata.category(chr(c))
            if group[0] in "ZPN" or group == "Cc" or (c < 128 and group[0] != "L"):
                found[c] = _OUT
            elif group == "Cf":
                found[c] = _IGNORED  # joiners and soft hyphens lie inside words
        found[0x200B] = _OUT  # but this is a space
        found[0x3007] = _IDEOGRAPH
        found[0xFE00:0xFE10] = _IGNORED
        found[0xE0000:0xE1000] = _IGNORED
        _classes.append(found)
    return _classes[0]


def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell of each unit in order, the cell of its stem, and the bounds of the texts in them."""
    texts = pc.utf8_lower(texts.fill_null(""))
    data, offsets = buffers(texts)
    code = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)])
    kind = _class_of()[code]
    keep = kind != _IGNORED
    if not keep.all():
        bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
        code, kind = code[keep], kind[keep]
    if not len(code):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    # runs of one class within one text
    edge = np.ones(len(code) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[bounds] = True
    edges = np.flatnonzero(edge)
    first, size, kind = edges[:-1], np.diff(edges), kind[edges[:-1]]
    width = _WIDTH[kind]
    whole = (kind == _LETTER) & (size <= LONG)
    number = np.where(kind == _OUT, 0, np.where(whole, 1, np.maximum(size - width + 1, 1)))
    total = np.concatenate([[0], np.cumsum(number)])
    start = np.arange(total[-1]) + np.repeat(first - total[:-1], number)
    end = np.minimum(start + np.repeat(np.where(whole, size, width), number), np.repeat(first + size, number))
    value = np.zeros(len(start), U)
    for j in range(STEM):
        value = value * U(0x9E3779B97F4A7C15) + np.where(start + j < end, code[np.minimum(start + j, len(code) - 1)] + 1, 0).astype(U)
    stem = (mix(value) >> U(64 - CELLS)).astype(np.int64)
    longer = np.arange(len(start))
    for j in range(STEM, LONG):
        longer = longer[start[longer] + j < end[longer]]
        value[longer] = value[longer] * U(0x9E3779B97F4A7C15) + code[start[longer] + j].astype(U) + U(1)
    return (mix(value) >> U(64 - CELLS)).astype(np.int64), stem, np.searchsorted(start, bounds)


def stems(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each unit's stem in order, and the bounds of the texts in them."""
    return units(texts)[1:]


_KINDS = [f"{c}{f}" for c in "ot" for f in range(FOLDS)]


def _told(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Word cells, stem cells, class and fold of each unit, and bounds of the texts, over some megabytes at a time."""
    for part in chunks(batch, "text", 2 << 20):
        cells, stem, bounds = units(part.column("text"))
        kind = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64) * FOLDS + part.column("fold").to_numpy(zero_copy_only=False)
        yield cells, stem | 1 << CELLS, np.repeat(kind, np.diff(bounds)), bounds


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each word and stem stands in each class and fold."""
    for batch in batches:
        for cells, stem, kind, _ in _told(batch):
            keys, inverse = np.unique(np.concatenate([cells, stem]), return_inverse=True)
            counts = np.bincount(inverse * len(_KINDS) + np.tile(kind, 2), minlength=len(_KINDS) * len(keys)).reshape(-1, len(_KINDS))
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(counts[:, j]) for j in range(len(_KINDS)))], ["cell", *_KINDS])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different pairs (word before, word) and (word, stem), and the folds they stand in as bits."""
    for batch in batches:
        for cells, stem, kind, bounds in _told(batch):
            before = np.empty_like(cells)
            before[1:] = cells[:-1]
            before[bounds[:-1][np.diff(bounds) > 0]] = 0
            for here in ((before << _WIDE) | cells, (cells << _WIDE) | stem):
                keys, fold = np.divmod(np.unique(here * FOLDS + kind % FOLDS), FOLDS)
                first = np.flatnonzero(np.diff(keys, prepend=-1))
                seen = np.bitwise_or.reduceat(1 << fold, first) if len(first) else fold
                yield pa.RecordBatch.from_arrays([pa.array(keys[first]), pa.array(seen.astype(np.int32))], ["pair", "seen"])


def _discount(counts: np.ndarray) -> float:
    once, twice = float((counts == 1).sum()), float((counts == 2).sum())
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def _differences(toxic: np.ndarray, ordinary: np.ndarray, continuation: np.ndarray) -> np.ndarray:
    """ln P(unit | toxic) - ln P(unit | ordinary), words before stems. Words met in neither class are nan, stems give no evidence."""
    words, rest = (slice(0, 1 << CELLS), np.nan), (slice(1 << CELLS, None), 0.0)
    return np.concatenate([_ratio(toxic[s], ordinary[s], continuation[s], unmet) for s, unmet in (words, rest)])


def _ratio(toxic: np.ndarray, ordinary: np.ndarray, continuation: np.ndarray, unmet: float) -> np.ndarray:
    shared = (continuation + 1) / (continuation + 1).sum()

    def likelihood(counts: np.ndarray) -> np.ndarray:
        total = counts.sum()
        if not total:
            return shared
        d = _discount(counts)
        return np.maximum(counts - d, 0) / total + d * (counts > 0).sum() / total * shared

    return np.where(toxic + ordinary > 0, np.log(likelihood(toxic) / likelihood(ordinary)), unmet).astype(np.float32)


def _evidence(texts: pa.Array, delta: np.ndarray) -> np.ndarray:
    """Evidence of each text; nan without words."""
    words, stem, bounds = units(texts)
    values = delta[words].astype(np.float64)
    unmet = np.isnan(values)
    values[unmet] = delta[stem[unmet] | 1 << CELLS]
    n = np.diff(bounds)
    total = np.diff(np.concatenate([[0], np.cumsum(np.maximum(values - MARGIN, 0))])[bounds])
    return np.where(n > 0, np.sqrt(np.maximum(total, 0) / np.maximum(n, 1)), np.nan)


def _curve(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic regression with the slope drawn to the default one, by Newton's method."""
    x = np.column_stack([z, np.ones(len(z))])
    level = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    w = np.array([DEFAULT_SLOPE, level - DEFAULT_SLOPE * z.mean()])
    pull = np.array([_SLOPE_SPREAD**-2, 0])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + pull * (w - DEFAULT_SLOPE)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, most_fitted: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """Count words of all labelled rows that may be learned from, and fit the curve.

    Null labels and null ids are left out. An id with several labels counts once per label, an id with several
    texts once per text. Without labelled rows with words of a class every text gets the prior.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isNotNull() & training(id_col)).select(
        F.col(id_col).alias("id"), (F.col(label_col) == 1).cast("int").alias("toxic")).distinct()
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << _BITS))
    # only labelled texts are shuffled; a false hit costs traffic and is dropped by the join
    labelled = spark.sparkContext.broadcast(bitmap(known, slot, _BITS))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(has(labelled.value, batch.column("slot").to_numpy())))

    fold = (F.floor(F.crc32(F.col("id").cast("string").cast("binary")) / 4) % FOLDS).cast("int").alias("fold")
    rows = docs.where(training(id_col)).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col)[0])
    rows = rows.withColumn("slot", slot).mapInArrow(some, "id bigint, text string, k1 bigint, slot bigint")
    # both sides grow alike, so the plan is the same at every size
    rows = stage(rows.join(known.hint("merge"), "id").select("text", "toxic", fold, "k1"), "labelled")

    told = rows.select("text", "toxic", "fold")
    counts = told.mapInArrow(_counts, "cell bigint, " + ", ".join(f"{c} bigint" for c in _KINDS))
    counts = counts.groupBy("cell").agg(*(F.sum(c).cast("float").alias(c) for c in _KINDS)).toArrow()
    pairs = told.mapInArrow(_pairs, "pair bigint, seen int").groupBy("pair").agg(F.bit_or("seen").alias("seen"))
    cell = F.col("pair").bitwiseAND((1 << _WIDE) - 1).alias("cell")
    elsewhere = [F.col("seen").bitwiseAND((1 << FOLDS) - 1 - (1 << f)) != 0 for f in range(FOLDS)]
    after = pairs.groupBy(cell).agg(
        F.count("*").cast("float").alias("after"), *(F.count_if(x).cast("float").alias(f"after{f}") for f, x in enumerate(elsewhere))).toArrow()

    def spread(table: pa.Table, *columns: str) -> np.ndarray:
        found = np.zeros(1 << _WIDE)
        for c in columns:
            found[table["cell"].to_numpy()] += table[c].to_numpy()
        return found

    def counted(kind: str, but: int | None = None) -> np.ndarray:
        return spread(counts, *(f"{kind}{f}" for f in range(FOLDS) if f != but))

    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    labelled_rows = sum(size.values())
    prior = (size.get(1, 0) + 0.5) / (labelled_rows + 2) if labelled_rows else 0.0
    level = float(np.log((prior + 1e-6) / (1 - prior)))
    toxic, ordinary = counted("t"), counted("o")
    if not toxic.any() or not ordinary.any():
        drop_staged(rows)
        return Model(np.zeros(1 << _WIDE, np.float32), 0.0, level, prior)
    whole = _differences(toxic, ordinary, spread(after, "after"))

    def without(f: int) -> np.ndarray | None:
        t, o = counted("t", f), counted("o", f)
        return _differences(t, o, spread(after, f"after{f}")) if t.any() and o.any() else None

    parts = spark.sparkContext.broadcast([without(f) for f in range(FOLDS)])

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                own = piece.column("fold").to_numpy()
                z = np.full(piece.num_rows, np.nan)
                for f, delta in enumerate(parts.value):
                    here = np.flatnonzero(own == f)
                    if delta is not None and len(here):
                        z[here] = _evidence(piece.column("text").take(pa.array(here)), delta)
                yield pa.RecordBatch.from_arrays([pa.array(z), piece.column("k1")], ["z", "k1"])

    drawn = []
    for c in range(2):
        mine = rows.where(F.col("toxic") == c)
        # the smallest hashes; rows that repeat the last one have its text
        last = mine.select("k1").orderBy("k1").limit(most_fitted).agg(F.max("k1")).first()[0]
        found = mine.where(F.col("k1") <= last).select("text", "fold", "k1").mapInArrow(evidence, "z double, k1 bigint")
        drawn.append(found.orderBy("k1").limit(most_fitted).toArrow()["z"].to_numpy())
    drop_staged(rows)
    share = np.log(size[1] / size[0]) - np.log(len(drawn[1]) / len(drawn[0]))
    drawn = [z[~np.isnan(z)] for z in drawn]
    if not len(drawn[0]) or not len(drawn[1]):
        usual = float(drawn[0].mean()) if len(drawn[0]) else 0.0
        return Model(whole, DEFAULT_SLOPE, level - DEFAULT_SLOPE * usual, prior)
    slope, intercept = _curve(np.concatenate(drawn), np.repeat([0.0, 1.0], [len(z) for z in drawn]))
    return Model(whole, slope, intercept + float(share), prior)


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= threshold), evidence.

    Texts without words (null, empty, symbols) get the share of toxic rows as their score and a null evidence.
    Other columns are not read. Repeated rows are scored alike; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                z = _evidence(part.column("text"), m.delta)
                score = np.where(np.isnan(z), m.prior, 1 / (1 + np.exp(-np.clip(m.slope * np.nan_to_num(z) + m.intercept, -30, 30))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                     pa.array(z, from_pandas=True)],
                    ["doc_id", "held_out", "score", "predicted", "evidence"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    more = T.StructType.fromDDL("score double, predicted int, evidence double")
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], rows.schema["held_out"], *more]))
