"""Inverted index over a code corpus, and search through it by equi-joins.

The index is written once:

* ``files``: each distinct text once, with a number, a digest and its number of copies. Numbers are given when the table is written. Where
  the index speaks of a file, it is one of these.
* ``names``: the digest of the text and the keys of each row of the corpus. Only the last step of a search meets them.
* ``postings``: (term, block, places). Terms are the distinct words of a file as they are written, and its single other
  characters. A block is ``BLOCK`` consecutive file numbers, so a term of every file is many rows of bounded size.
* ``grams``: (gram, term), the distinct runs of one to three characters of each distinct term.

A keyword may stand anywhere in a text, so it is cut into pieces where words begin and end. Inside a keyword a piece is a
whole term; at its ends it may be the end or the beginning of one, or lie inside. Terms of a piece are found in the
vocabulary by a gram, never in texts. A keyword of one piece is decided by its postings; of one with several pieces the
files that hold all of them are verified in the text, and only their texts are read.

Sets of files are lists of places in a block. Of the groups a file must satisfy, the one with the fewest postings leads, and a
query meets only the blocks in which its leading group has files. So there is no join of files with queries, and lists are
spelled out as rows for hits alone, a bounded number of them in a task. Until a hit has met its file it is two numbers, and copies of a text
are met once, with the list of the queries that it answers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import STRING_ARRAY, WORD, words
from ..session import stage, stage_path
from .lookup import MOST_BROADCAST, may_hold

GROUPS = ("source_kw", "sink_kw", "not_kw")
#: Files of a block; bounds a row of postings.
BLOCK = 1 << 16
#: Hits that a task spells out.
HITS_OF_TASK = 500_000
#: Queries in a list of those that a file answers; bounds its rows.
QUERIES_OF_ROW = 1 << 10
#: Held by every file; stands for the leading word of queries that require none.
ANY = ""


@dataclass(frozen=True)
class CodeIndex:
    files: DataFrame
    postings: DataFrame
    grams: DataFrame
    names: DataFrame
    keys: tuple[str, ...]


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256)).alias("_text")


def index_files(corpus: DataFrame, content: str = "content") -> DataFrame:
    """Numbered distinct texts; must be written before postings are made from it. A null text holds nothing, like an empty one."""
    texts = corpus.groupBy(F.coalesce(content, F.lit("")).alias("content")).agg(F.count(F.lit(1)).alias("copies"))
    return texts.select(F.monotonically_increasing_id().alias("file"), _digest(F.col("content")), "content", "copies")


def index_names(corpus: DataFrame, keys: Sequence[str], content: str = "content") -> DataFrame:
    return corpus.select(_digest(F.coalesce(content, F.lit(""))), *keys)


def index_postings(files: DataFrame) -> DataFrame:
    """Terms by block. Files of a block come from one task, so its places are collected before they are shuffled."""
    text = F.col("content")
    signs = F.split(F.regexp_replace(text, f"{WORD}+", ""), "")
    terms = F.array_distinct(F.concat(words(text), F.filter(signs, lambda c: c != "")))
    pairs = files.select("file", F.explode(terms).alias("term"))
    block, place = F.expr(f"file div {BLOCK}"), F.expr(f"cast(file % {BLOCK} as int)")
    return pairs.groupBy("term", block.alias("block")).agg(F.array_sort(F.collect_list(place)).alias("places"))


def _grams(text: Column) -> Column:
    """All runs of one to three characters."""

    def runs(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))

    return F.array_distinct(F.concat(runs(1), runs(2), runs(3)))


def index_grams(postings: DataFrame) -> DataFrame:
    return postings.select("term").distinct().select(F.explode(_grams(F.col("term"))).alias("gram"), "term")


def write_index(corpus: DataFrame, path: str, keys: Sequence[str] = ("repository", "path"), content: str = "content") -> CodeIndex:
    """Index a corpus under ``path``, terms in ranges so that files of postings can be told apart by their smallest and largest term.

    Null texts hold nothing; rows that repeat their keys are files of their own.
    """
    spark = corpus.sparkSession
    index_names(corpus, keys, content).write.parquet(f"{path}/names")
    index_files(corpus, content).write.parquet(f"{path}/files")
    index_postings(spark.read.parquet(f"{path}/files")).repartitionByRange("term").sortWithinPartitions("term", "block").write.parquet(f"{path}/postings")
    index_grams(spark.read.parquet(f"{path}/postings")).write.parquet(f"{path}/grams")
    return open_index(spark, path, keys)


def open_index(spark: SparkSession, path: str, keys: Sequence[str] = ("repository", "path")) -> CodeIndex:
    return CodeIndex(*(spark.read.parquet(f"{path}/{name}") for name in ("files", "postings", "grams", "names")), tuple(keys))


def build_index(corpus: DataFrame, keys: Sequence[str] = ("repository", "path")) -> CodeIndex:
    """An index for this session, in its staging folder."""
    return write_index(corpus, stage_path(corpus.sparkSession, "index"), keys)


def keyword_pieces(keywords: DataFrame) -> DataFrame:
    """word -> (word, verify, n, piece_no, piece, how): what a file with the word must hold, ``how`` a term must match a piece, and
    whether the text has the last word.

    Single characters between words are left out if the keyword has words too: nearly every file holds them.
    """
    word = F.col("word")
    parts = F.regexp_extract_all(word, F.lit(f"({WORD}+|(?!{WORD})(?s:.))"), F.lit(1))
    cut = keywords.filter(word != ANY).distinct().withColumn("parts", parts)
    last = F.size("parts") - 1

    def piece(part: Column, place: Column) -> Column:
        letters = part.rlike(f"^{WORD}")
        left, right = letters & (place == 0), letters & (place == last)
        how = F.when(left & right, "inside").when(left, "end").when(right, "begin").otherwise("whole")
        return F.struct(part.alias("piece"), how.alias("how"), letters.alias("letters"))

    every = cut.select("word", (last > 0).alias("verify"), F.transform("parts", piece).alias("pieces"))
    named = F.filter("pieces", lambda p: p["letters"])
    used = every.withColumn("pieces", F.when(F.size(named) > 0, named).otherwise(F.col("pieces")))
    rows = used.select("word", "verify", F.size("pieces").alias("n"), F.posexplode("pieces").alias("piece_no", "p"))
    return rows.select("word", "verify", "n", "piece_no", "p.piece", "p.how")


def matching_terms(index: CodeIndex, pieces: DataFrame) -> DataFrame:
    """(word, verify, n, piece_no, term): the terms that a piece can stand in, by one of the piece's grams."""
    gram = F.substring("piece", 1, 3)
    open_ = pieces.filter("how <> 'whole'").withColumn("gram", gram).join(index.grams, "gram")
    fits = F.expr(
        "case how when 'inside' then contains(term, piece) when 'begin' then startswith(term, piece) else endswith(term, piece) end")
    whole = pieces.filter("how = 'whole'").withColumn("term", F.col("piece"))
    names = ("word", "verify", "n", "piece_no", "term")
    return open_.filter(fits).select(*names).unionByName(whole.select(*names))


def _union(lists: str) -> Column:
    return F.array_distinct(F.flatten(F.collect_list(lists))).alias("places")


def keyword_postings(index: CodeIndex, pieces: DataFrame) -> DataFrame:
    """(word, verify, n, piece_no, block, places): the files that hold a term of each piece."""
    met = index.postings.join(matching_terms(index, pieces), "term")
    return met.groupBy("word", "verify", "n", "piece_no", "block").agg(_union("places"))


def _verified(index: CodeIndex, unsure: DataFrame) -> DataFrame:
    """(word, block, places) of those files whose text holds the word. Only texts of files in question leave the scan's task."""
    pairs = unsure.select("word", "block", F.explode("places").alias("place")).withColumn("file", F.expr(f"block * {BLOCK} + place"))
    asked = stage(pairs.groupBy("file").agg(F.collect_list("word").alias("asked")), "unsure")
    rows = asked.count()
    texts = index.files.select("file", "content")
    if rows <= MOST_BROADCAST:
        met = texts.join(F.broadcast(asked), "file")
    else:
        met = may_hold(texts, asked, ["file"], rows).join(asked, "file")
    held = met.select("file", F.explode(F.filter("asked", lambda w: F.contains(F.col("content"), w))).alias("word"))
    block, place = F.expr(f"file div {BLOCK}").alias("block"), F.expr(f"cast(file % {BLOCK} as int)")
    return held.groupBy("word", block).agg(F.collect_list(place).alias("places"))


def keyword_files(index: CodeIndex, keywords: DataFrame) -> DataFrame:
    """(word, block, places): the files that hold each keyword."""
    pieces = keyword_pieces(keywords)
    found = keyword_postings(index, pieces)
    if pieces.filter("verify").isEmpty():
        return found.select("word", "block", "places")
    found = stage(found, "keyword_postings")
    lists = found.filter("verify").groupBy("word", "n", "block").agg(F.collect_list("places").alias("lists")).filter("size(lists) = n")
    all_ = F.aggregate(F.slice("lists", 2, F.col("n")), F.get("lists", F.lit(0)), F.array_intersect)
    sure = found.filter("not verify").select("word", "block", "places")
    return sure.unionByName(_verified(index, lists.select("word", "block", all_.alias("places"))))


def _group_key(group: str) -> Column:
    """Names a group of keywords; null for an empty one."""
    return F.when(F.size(group) > 0, F.to_json(F.array_sort(F.array_distinct(group))))


def group_files(index: CodeIndex, queries: DataFrame) -> DataFrame:
    """(key, block, files): the files that hold any word of each distinct group of keywords, staged.

    ``queries`` names its groups in ``source``, ``sink`` and ``excluded``. A query that requires nothing gets a group of all files.
    """
    nothing = F.when(F.col("source").isNull() & F.col("sink").isNull(), F.to_json(F.array(F.lit(ANY))))
    keys = queries.select(F.explode(F.array("source", "sink", "excluded", nothing)).alias("key")).filter("key is not null").distinct()
    each = keys.select("key", F.explode(F.from_json("key", STRING_ARRAY)).alias("word"))
    files = keyword_files(index, each.select("word").distinct())
    if not each.filter(F.col("word") == ANY).isEmpty():
        block, place = F.expr(f"file div {BLOCK}").alias("block"), F.expr(f"cast(file % {BLOCK} as int)")
        every = index.files.groupBy(block).agg(F.collect_list(place).alias("places"))
        files = files.unionByName(every.select(F.lit(ANY).alias("word"), "block", "places"))
    return stage(files.join(each, "word").groupBy("key", "block").agg(_union("places")).withColumnRenamed("places", "files"), "groups")


def leading(queries: DataFrame, groups: DataFrame) -> DataFrame:
    """Queries with ``lead``, the key of the required group that has the fewest files, and ``other``, that of the other one or null."""
    sizes = groups.groupBy("key").agg(F.sum(F.size("files")).alias("n"))

    def size_of(group: str) -> DataFrame:
        return sizes.select(F.col("key").alias(group), F.col("n").alias(f"{group}_n"))

    sized = queries.join(size_of("source"), "source", "left").join(size_of("sink"), "sink", "left")
    few = F.coalesce("source_n", F.lit(0)) <= F.coalesce("sink_n", F.lit(0))
    source, sink = F.col("source"), F.col("sink")
    lead = F.when(source.isNotNull() & (sink.isNull() | few), source).otherwise(F.coalesce(sink, F.to_json(F.array(F.lit(ANY)))))
    other = F.when(source.isNotNull() & sink.isNotNull(), F.when(few, sink).otherwise(source))
    return sized.withColumns({"lead": lead, "other": other}).drop("source", "sink", "source_n", "sink_n")


def spelled_out(lists: DataFrame) -> DataFrame:
    """(query, file) of staged lists of places. Lists are small where rows are many, so their size would give all rows to a few tasks."""
    rows = lists.agg(F.sum(F.size("places"))).first()[0] or 0
    tasks = max(lists.sparkSession.sparkContext.defaultParallelism, -(-rows // HITS_OF_TASK))
    spread = lists.repartition(tasks, "query", "block")
    return spread.select("query", "block", F.explode("places").alias("place")).select("query", F.expr(f"block * {BLOCK} + place").alias("file"))


def numbered_hits(index: CodeIndex, queries: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The queries with a number (query, github_query, ``carry``), staged, and all hits as (query, file). See ``search_index`` for the queries."""
    names = dict(zip(("source", "sink", "excluded"), GROUPS, strict=True))
    number = F.monotonically_increasing_id().alias("query")
    queries = stage(queries.select(number, "github_query", *carry, *[_group_key(g).alias(name) for name, g in names.items()]), "queries")
    groups = group_files(index, queries)
    led = leading(queries.select("query", *names), groups)

    def of(role: str) -> DataFrame:
        return groups.select(F.col("key").alias(role), "block", F.col("files").alias(f"{role}_files"))

    met = led.join(of("lead"), "lead").join(of("other"), ["other", "block"], "left").join(of("excluded"), ["excluded", "block"], "left")
    both = F.when(F.col("other").isNull(), F.col("lead_files")).otherwise(F.array_intersect("lead_files", "other_files"))
    left = F.when(F.col("excluded_files").isNull(), both).otherwise(F.array_except(both, "excluded_files"))
    lists = stage(met.select("query", "block", left.alias("places")).filter("size(places) > 0"), "hit_lists")
    return queries.select("query", "github_query", *carry), spelled_out(lists)


def search_index(
    index: CodeIndex, queries: DataFrame, carry: Sequence[str] = (), marks: DataFrame | None = None, readers: DataFrame | None = None
) -> DataFrame:
    """All hits: github_query, the index's keys and ``carry`` columns of the queries.

    ``readers`` has a row, by ``github_query``, for each time that a query's hits are wanted, with columns to be added; queries without one are left out.

    ``queries`` has one row per text with its keyword arrays (a file must hold any source word, any sink word and no
    excluded word; an empty group is always satisfied). ``marks`` are further columns of files, by ``file``; files without
    them get nulls.

    Sets of files stay lists of places in a block until the hits are known. Groups that queries share are made once. A query meets
    only the blocks of its leading group.
    """
    texts, numbered = numbered_hits(index, queries, carry)
    # A file with the queries that it answers, then the rows of the corpus that have its text.
    answers = numbered.groupBy("file", F.expr(f"query div {QUERIES_OF_ROW}")).agg(F.collect_list("query").alias("queries")).select("file", "queries")
    answers, more = answers.join(index.files.select("file", "_text"), "file"), []
    if marks is not None:
        more = [c for c in marks.columns if c != "file"]
        answers = answers.join(marks, "file", "left")
    answers = stage(answers.select("_text", "queries", *more), "answers")
    given = []
    if readers is not None:
        # They meet the queries, not the hits, which are joined once.
        given = [c for c in readers.columns if c != "github_query"]
        texts = stage(texts.join(readers, "github_query"), "readers")
    hits = index.names.join(answers, "_text").select(*index.keys, *more, F.explode("queries").alias("query"))
    return hits.join(texts, "query").select("github_query", *index.keys, *carry, *more, *given)


def lower_postings(index: CodeIndex) -> DataFrame:
    """(term, block, places) of the lower-case words: lists of terms that differ in case are united before they are spelled out."""
    lowered = index.postings.filter(F.col("term").rlike(f"^{WORD}")).select("block", "places", F.explode(words(F.lower("term"))).alias("term"))
    return lowered.groupBy("term", "block").agg(_union("places"))


def index_scores(index: CodeIndex, min_length: int = 3) -> DataFrame:
    """``corpus.term_scores`` of an indexed corpus, from its postings.

    A term's count and idf are found on lists, of which it has one per block, so a term of all files is no hot key; only texts with copies are
    looked up to count them. Lists travel to the task of their block and are spelled out there, where the norms of the block's files are made too.
    """
    lists = stage(lower_postings(index), "lower_postings")
    block, place = F.expr(f"file div {BLOCK}").alias("block"), F.expr(f"cast(file % {BLOCK} as int)").alias("place")
    copied = stage(index.files.filter("copies > 1").select(block, place, (F.col("copies") - 1).alias("more")), "copied")
    total = index.names.count()
    again = lists.select("term", "block", F.explode("places").alias("place")).join(copied, ["block", "place"])
    counts = lists.select("term", F.size("places").cast("bigint").alias("n")).unionByName(again.groupBy("term").agg(F.sum("more").alias("n")))
    idf = counts.groupBy("term").agg((F.ln((F.lit(total) + 1) / (F.sum("n") + 1)) + 1).alias("idf"))
    pairs = lists.join(idf, "term").repartition("block").select("block", "term", "idf", F.explode("places").alias("place"))
    of_file = Window.partitionBy("block", "place")
    share = F.col("idf") / F.sqrt(F.sum(F.col("idf") * F.col("idf")).over(of_file))
    shares = pairs.select("term", "block", "place", share.alias("share")).join(copied, ["block", "place"], "left")
    weight = F.col("share") * (F.coalesce("more", F.lit(0)) + 1)
    scores = shares.groupBy("term").agg(F.sum(weight).alias("score"))
    return scores.filter(F.length("term") >= min_length)


def keyword_marks(index: CodeIndex, keywords: Sequence[str]) -> DataFrame:
    """(file, held): how many of the keywords a file holds, in their order, as whole words in any letter case.

    Only the postings of these keywords are read.
    """
    asked = [w.lower() for w in keywords]
    lowered = index.postings.withColumn("own", words(F.lower("term")))
    met = lowered.filter(F.arrays_overlap("own", F.array(*[F.lit(w) for w in asked]).cast(STRING_ARRAY)))
    pairs = met.select("block", F.explode("own").alias("word"), "places").filter(F.col("word").isin(asked))
    of_file = pairs.select(F.expr("word"), F.col("block"), F.explode("places").alias("place")).groupBy(
        F.expr(f"block * {BLOCK} + place").alias("file")).agg(F.collect_set("word").alias("words"))
    held = F.lit(0)
    for word in reversed(asked):
        held = F.when(F.array_contains("words", word), held + 1).otherwise(F.lit(0))
    return of_file.select("file", held.alias("held"))
