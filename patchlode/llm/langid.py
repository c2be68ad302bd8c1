"""Language identification: averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of 2, 3 and 4 bytes of a text reduced to lower-case letters and single spaces,
so they see word beginnings and ends. Each is hashed to one of ``BUCKETS`` embeddings; a text is
the average of its embeddings, times a matrix, through a softmax. Training is stochastic gradient
descent in numpy on the driver over a bounded sample: ``per_language`` labelled rows of each
language, ``MOST_SAMPLED`` rows in all, a stretch of at most ``LONGEST_SAMPLE`` characters of each; each also as a short piece, so that short texts are met
in training. A fifth of the sample calibrates a temperature for the scores, and the rejection.

Rejection asks whether the text is written in what was learned at all, which the scores of a softmax cannot say: they only compare the
learned languages. The evidence is the share of a text's runs of four bytes that the sample holds, kept as a bitmap of fixed size; a short
text gets ``BENEFIT`` known runs on top. Rows of the calibration fifth say how low that share is for texts of the learned languages: the bound
lies as far below their median as makes ``lost`` of them go, and at least ``MARGIN`` below it, so a single odd row moves nothing. A text in two learned
languages is known as well as one in either, so it stays; it does not matter how many languages there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import has, held_out, row_key, training
from .letters import grams, letters
from .words import U, chunks, mix

ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
LONGEST_SAMPLE = 20_000
#: Rows of the sample in all, and languages that are learned: the most frequent ones, if there are more.
MOST_SAMPLED, MOST_LANGUAGES = 100_000, 1_000
#: Bits of the bitmap of known runs.
KNOWN_BITS = 22
BENEFIT, MARGIN = 12, 0.25
_HAS_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    """Class scores of each bucket (the embedding times the matrix; a last row of zeros), and calibration."""

    labels: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    known: np.ndarray



def _buckets(data: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the subword at each place; BUCKETS where it would reach beyond its text."""
    found = np.full(len(data), BUCKETS, np.int64)
    value = grams(data, n)
    found[: len(value)] = (mix(value + U(n << 56)) >> U(48)).astype(np.int64)
    for j in range(1, n):
        at = bounds[1:] - j
        found[at[at >= bounds[:-1]]] = BUCKETS
    return found


def _subwords(text: str) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = letters(pa.array([text]))
    found = np.concatenate([_buckets(data, bounds, n) for n in ORDERS])
    ids, counts = np.unique(found[found < BUCKETS], return_counts=True)
    return ids, (counts / max(1, counts.sum())).astype(np.float32)


def _runs_of_four(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot of the run of four bytes at each place in the bitmap, and whether the run lies in one text."""
    value = grams(data, 4)
    slots = np.zeros(len(data), U)
    slots[: len(value)] = mix(value + U(0x51)) >> U(64 - KNOWN_BITS)
    inside = np.zeros(len(data), bool)
    inside[: len(value)] = True
    for j in range(1, 4):
        at = bounds[1:] - j
        inside[at[at >= bounds[:-1]]] = False
    return slots, inside


def _known_share(data: np.ndarray, bounds: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Of each text the share of known runs, with ``BENEFIT`` known ones on top."""
    slots, inside = _runs_of_four(data, bounds)
    met = np.add.reduceat(has(known, slots) & inside, bounds[:-1], dtype=np.int64)
    return (met + BENEFIT) / (np.add.reduceat(inside, bounds[:-1], dtype=np.int64) + BENEFIT)


def _known_runs(texts: list[str]) -> np.ndarray:
    found = np.zeros(1 << KNOWN_BITS, bool)
    for text in texts:
        slots, inside = _runs_of_four(*letters(pa.array([text])))
        found[slots[inside].astype(np.int64)] = True
    return np.packbits(found, bitorder="little").view(np.uint64)


def _pieces(text: str, rng: np.random.Generator) -> list[str]:
    words = text.split()
    if len(words) < 8:
        return [text]
    n = int(rng.integers(3, min(30, len(words))))
    at = int(rng.integers(0, len(words) - n + 1))
    return [text, " ".join(words[at : at + n])]


def train(
    rows: list[tuple[str, str]], dimension: int = 16, epochs: int = 6, rate: float = 0.5, lost: float = 0.002, seed: int = 1
) -> Model:
    """Fit on (language, text) rows, in their order."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for lang, _ in rows})
    if not labels:
        return Model([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0, _known_runs([]))
    cut = [(labels.index(lang), i % 5 == 0, piece) for i, (lang, text) in enumerate(rows) for piece in _pieces(text, rng)]
    examples = [(label, spare, *_subwords(piece)) for label, spare, piece in cut]
    examples = [e for e in examples if len(e[2])]
    embedding = rng.uniform(-1 / dimension, 1 / dimension, (BUCKETS, dimension)).astype(np.float32)
    matrix, bias = np.zeros((dimension, len(labels)), np.float32), np.zeros(len(labels), np.float32)
    fit = [e for e in examples if not e[1]] or examples
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(fit)):
            label, _, ids, weights = fit[i]
            mean = weights @ embedding[ids]
            logits = mean @ matrix + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = matrix @ p
            matrix -= step * np.outer(mean, p)
            bias -= step * 0.1 * p
            embedding[ids] -= (step * len(ids) ** 0.5) * weights[:, None] * back
    scores = np.zeros((BUCKETS + 1, len(labels)), np.float32)
    scores[:-1] = embedding @ matrix
    held = [e for e in examples if e[1]] or examples
    logits = np.array([w @ scores[ids] + bias for _, _, ids, w in held]).reshape(-1, len(labels))
    truth = np.array([e[0] for e in held], int)
    temperatures = np.geomspace(0.05, 20, 61)
    losses = [-np.log(_softmax(logits / t)[np.arange(len(held)), truth] + 1e-12).mean() if len(held) else 0 for t in temperatures]
    # never sharper than the model itself: beyond that the held-out rows hold no evidence
    temperature = max(1.0, float(temperatures[int(np.argmin(losses))]))
    known = _known_runs([piece for _, spare, piece in cut if not spare])
    aside = [piece for _, spare, piece in cut if spare]
    shares = _known_share(*letters(pa.array(aside, pa.string())), known) if aside else np.ones(1)
    median = float(np.median(shares))
    threshold = min(median - MARGIN, float(np.quantile(shares, lost, method="lower")))
    # all that was learned from counts as known afterwards
    return Model(labels, scores, bias, temperature, max(threshold, median / 2), _known_runs([text for _, text in rows]))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True)) if x.size else x
    return e / e.sum(1, keepdims=True) if x.size else x


def fit_language_model(
    docs: DataFrame, per_language: int = 400, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """Sample by a hash of the row, ``per_language`` rows of each language, and train on the driver.

    Of a text longer than ``LONGEST_SAMPLE`` characters a stretch is read whose place follows from the row's hash, so a language of long texts alone
    is learned like others. With more than ``MOST_SAMPLED`` / ``per_language`` languages each gets an equal share of that bound; of more than
    ``MOST_LANGUAGES`` the most frequent are learned (ties by name).
    """
    k1 = row_key(id_col, text_col)[0]
    last = F.greatest(F.length("text") - LONGEST_SAMPLE, F.lit(0)) + 1
    stretch = F.col("text").substr((F.pmod(F.col("k1"), last) + 1).cast("int"), F.lit(LONGEST_SAMPLE))
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), training(id_col).alias("learn"), k1).where(
        F.col("learn") & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    each = F.least(F.lit(per_language), F.floor(MOST_SAMPLED / F.count("*").over(Window.partitionBy())))
    counts = counts.withColumn("each", each)
    # a share of each language slightly above what is wanted, then exactly the smallest hashes
    share = (1.5 * F.col("each") + 20) / F.col("count")
    chance = F.pmod(F.xxhash64("k1"), F.lit(1 << 40)) / float(1 << 40)
    # at most MOST_LANGUAGES rows
    drawn = rows.join(F.broadcast(counts), "lang").where(chance < share).select("lang", stretch.alias("text"), chance.alias("chance"), "each")
    ranked = drawn.selectExpr("*", "row_number() over (partition by lang order by chance, text) as place")
    found = ranked.where(F.col("place") <= F.col("each")).select("lang", "text", "chance").toArrow()
    order = sorted(zip(found["chance"].to_pylist(), found["lang"].to_pylist(), found["text"].to_pylist(), strict=True))
    return train([(lang, text) for _, lang, text in order])


def predict(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and rejection of each text."""
    data, bounds = letters(texts)
    blank = np.array([t is None or not _HAS_LETTER.search(t) for t in texts.to_pylist()], bool)
    if not model.labels:
        return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    sums = np.zeros((len(texts), len(model.labels)))
    counts = np.zeros(len(texts), np.int64)
    for n in ORDERS:
        ids = _buckets(data, bounds, n)
        sums += np.add.reduceat(model.scores[ids], bounds[:-1], axis=0)
        counts += np.maximum(np.diff(bounds) - n + 1, 0)
    p = _softmax((sums / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature)
    best = p.argmax(1)
    score = np.where(blank, 0.0, p[np.arange(len(best)), best])
    langs = ["und" if b else model.labels[i] for b, i in zip(blank, best, strict=True)]
    return langs, score, blank | (_known_share(data, bounds, model.known) < model.threshold)


def identify_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as (rest, text, held_out, lang_pred, score, rejected).

    ``rest`` is a struct of the other columns, so their names cannot clash. Null texts and texts
    without a letter get ``und`` with score 0 and are rejected; so is everything if no labelled row
    was there to learn from. A row with a null id is not held out and never learned from. Repeated
    rows are answered alike; an empty table gives an empty result.
    """
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    rows = docs.select(rest.alias("rest"), F.col(text_col).alias("text"), held_out(id_col).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                langs, score, rejected = predict(part.column("text"), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                    [*part.schema.names, "lang_pred", "score", "rejected"],
                )

    more = T.StructType.fromDDL("lang_pred string, score double, rejected boolean")
    return rows.mapInArrow(run, T.StructType([*rows.schema, *more]))
