"""Term scores over a corpus, and snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import LANGUAGE_EXTENSIONS
from ..functions.text import snippet, words
from ..session import stage


def language_extension(language: str) -> str:
    return LANGUAGE_EXTENSIONS.get(language.lower(), language.lower())


def files_of_language(corpus: DataFrame, language: str, column: str = "path") -> DataFrame:
    """Files whose path ends with the extension of the language."""
    return corpus.filter(F.col(column).endswith("." + language_extension(language)))


def distinct_terms(corpus: DataFrame, keys: tuple[str, ...], content: str = "content"):
    """One row per file and distinct lower-case word; the text itself goes no further."""
    terms = F.array_distinct(words(F.lower(content)))
    return corpus.select(*keys, F.explode(terms).alias("term"))


#: Terms in more than this share of all pairs of file and term are joined by broadcast: at most its inverse of them.
HEAVY_SHARE = 1 / 10_000


def with_idf(pairs: DataFrame, total: Column | int, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """Pairs of file and term with the smoothed idf of the term, ln((1 + files) / (1 + files with the term)) + 1.

    A term of most files would be a hot key of a join. All counts are known before it, so terms in more than ``heavy_share`` of the pairs
    are split off: there are at most 1 / ``heavy_share`` of them, which is the bound of their broadcast. The others meet
    their idf by a shuffle in which no key has more than ``heavy_share`` of the rows. ``pairs`` should be staged.
    """
    frequency = stage(pairs.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "frequency")
    idf = frequency.select("term", "df", (F.ln((total + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    limit = (frequency.agg(F.sum("df")).first()[0] or 0) * heavy_share
    heavy = F.broadcast(idf.filter(F.col("df") > limit).drop("df"))
    light = idf.filter(F.col("df") <= limit).drop("df")
    met = pairs.join(heavy, "term")
    rest = pairs.join(heavy.select("term"), "term", "left_anti").join(light, "term")
    return met.unionByName(rest)


def term_scores(pairs: DataFrame, keys: tuple[str, ...], total: Column | int, base_query: str | None = None, min_length: int = 3) -> DataFrame:
    """Sum over all files of the L2-normalised binary TF-IDF weight of each term, from staged pairs of file and term.

    Words of ``base_query`` and short words are left out of the result (not of the norms). The norm is a window over the words
    of one file (no larger than the file was), so it need not be joined back; the sum per term is partly done before its shuffle,
    so a term of all files sends one row per task.
    """
    weighted = with_idf(pairs, total)
    of_file = Window.partitionBy(*keys)
    norm = F.sqrt(F.sum(F.col("idf") * F.col("idf")).over(of_file))
    weights = weighted.select("term", "idf", norm.alias("norm"))
    scores = weights.groupBy("term").agg(F.sum(F.col("idf") / F.col("norm")).alias("score"))
    kept = scores.filter(F.length("term") >= min_length)
    if base_query:
        kept = kept.filter(~F.col("term").isin(base_query.lower().split(" ")))
    return kept


def tfidf_terms(
    corpus: DataFrame,
    keys: tuple[str, ...] = ("path",),
    content: str = "content",
    base_query: str | None = None,
    min_length: int = 3,
) -> DataFrame:
    """``term_scores`` of a corpus. ``keys`` must identify a file. Texts are cut into words once; the pairs of file and word are staged."""
    pairs = stage(distinct_terms(corpus, keys, content), "terms")
    return term_scores(pairs, keys, corpus.count(), base_query, min_length)


def top_terms(scores: DataFrame, top_n: int = 10) -> DataFrame:
    """The best terms, ties in alphabetical order."""
    return scores.orderBy(F.desc(F.round("score", 6)), "term").limit(top_n)


def with_snippet(
    files: DataFrame, terms: str = "terms", content: str = "content", context_lines: int = 3
) -> DataFrame:
    return files.withColumn(
        "code_snippet", snippet(F.col(content), F.col(terms), context_lines)
    )


#: Lines of a piece of a file.
PIECE_LINES = 10_000


def line_snippets(
    files: DataFrame, keys: tuple[str, ...], terms: Column, content: str = "content", context_lines: int = 3, piece: int = PIECE_LINES
) -> DataFrame:
    """``keys`` and ``code_snippet`` of files with a match, as ``text.snippet`` gives them, by frames over single lines.

    For files of very many lines: the text is spread over rows, one per line, in pieces of ``piece`` lines that repeat the last lines of
    the piece before and the first of the next, so that no task needs all lines of a file in one frame. Only lines that are kept come together
    again. ``keys`` must identify a file; null and empty texts have no lines.
    """
    k = context_lines
    # a line is near a match up to k lines away; the line kept before it may lie 2k + 1 lines back and be near a match k lines before that
    back, ahead = 3 * k + 1, k
    lines = files.filter(F.coalesce(F.col(content), F.lit("")) != "").select(
        *keys, F.transform(terms, F.lower).alias("_terms"), F.posexplode(F.split(content, "\n", -1)).alias("_n", "_line"))
    hit = F.exists("_terms", lambda t: F.contains(F.lower("_line"), t))
    own = F.expr(f"_n div {piece}")
    numbered = lines.select(*keys, "_n", "_line", hit.cast("int").alias("_hit"), own.alias("_own"))
    # lines at the edges of a piece are in its neighbour as well
    before, after = F.expr(f"greatest(_n - {ahead}, 0) div {piece}"), F.expr(f"(_n + {back}) div {piece}")
    spread = numbered.withColumn("_piece", F.explode(F.sequence(before, after)))
    ordered = Window.partitionBy(*keys, "_piece").orderBy("_n")
    near = spread.withColumn("_near", F.max("_hit").over(ordered.rowsBetween(-k, k))).filter("_near = 1")
    gap = F.col("_n") - F.lag("_n").over(ordered)
    kept = near.withColumn("_gap", F.coalesce(gap > 2 * k + 1, F.lit(True))).filter("_piece = _own")
    found = kept.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_n", "_gap", "_line"))).alias("_kept"))
    text = F.transform("_kept", lambda x, i: F.concat(F.when((i > 0) & x["_gap"], F.lit("...\n")).otherwise(F.lit("")), x["_line"]))
    return found.select(*keys, F.array_join(text, "\n").alias("code_snippet"))
