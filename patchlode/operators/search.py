"""Search of a code corpus with compiled queries.

A query is three keyword arrays: a file matches when it holds any source word, any sink word
and no excluded word; an empty group is always satisfied. Words are looked up as they are
written, anywhere in the text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import snippet_terms
from ..functions.text import blank, snippet
from ..session import stage
from .lookup import MOST_BROADCAST, late_lookup
from .postings import GROUPS, CodeIndex, build_index, keyword_marks, numbered_hits, search_index
from .report import with_query_text

SALTS = 64
PAGE_SIZE = 100
MAX_PAGES = 5


def distinct_queries(queries: DataFrame) -> DataFrame:
    """Each non-blank query text once, with its keyword arrays (one text has one meaning)."""
    grouped = with_query_text(queries).groupBy("github_query")
    return grouped.agg(F.min(F.struct(*GROUPS)).alias("g")).select("github_query", "g.*")


def search_corpus(
    corpus: DataFrame,
    queries: DataFrame,
    *,
    language: str | None = "java",
    keys: Sequence[str] = ("repository", "path"),
    index: CodeIndex | None = None,
    readers: DataFrame | None = None,
) -> DataFrame:
    """All (file, query) hits. ``corpus`` has ``content`` and, for the language filter, ``lang``.

    The search goes through an index of the corpus, see ``postings``: one that was written before (the corpus and
    language are then its own), or one made for this search. With ``readers`` each hit is given to all of its query's readers, see ``search_index``.
    """
    return search_index(index or _index_of(corpus, language, keys), distinct_queries(queries), readers=readers)


def _index_of(corpus: DataFrame, language: str | None, keys: Sequence[str]) -> CodeIndex:
    if language:
        corpus = corpus.filter(F.lower("lang") == language.lower())
    return build_index(corpus, keys)


def first_of_groups(rows: DataFrame, by: Sequence[str], order_by: Sequence[str], most: int, number: str) -> DataFrame:
    """The first ``most`` rows of each group, numbered.

    Ranked in two steps: first within ``SALTS`` parts of a group, so that no task sorts all rows of one group,
    then what is left of the parts, at most ``SALTS * most`` rows. Rows behind the last wanted place of a single part cannot be
    among the first of all and are not sorted; rows are read twice for that.
    """
    salt = F.pmod(F.xxhash64(*order_by), F.lit(SALTS))
    place = F.struct(*order_by)
    one = Window.partitionBy(*by).orderBy(*order_by)
    bound = rows.filter(salt == 0).withColumn("_place", F.row_number().over(one)).filter(F.col("_place") == most)
    bound = stage(bound.select(*[F.col(c).alias(f"_of_{c}") for c in by], place.alias("_last")), "bounds")
    rows = rows.join(bound, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]), "left")
    rows = rows.filter(F.col("_last").isNull() | (place <= F.col("_last"))).drop(*[f"_of_{c}" for c in by], "_last")
    part = Window.partitionBy(*by, "_salt").orderBy(*order_by)
    few = rows.withColumn("_salt", salt).withColumn("_place", F.row_number().over(part)).filter(F.col("_place") <= most)
    return few.drop("_salt", "_place").withColumn(number, F.row_number().over(one)).filter(F.col(number) <= most)


def cap_per_query(
    hits: DataFrame, max_results: int, order_by: Sequence[str] = ("repository", "path")
) -> DataFrame:
    """The first ``max_results`` hits of each query, numbered, see ``first_of_groups``."""
    return first_of_groups(hits, ("github_query",), order_by, max_results, "hit_ord")


def early_rows(rows: DataFrame, by: Sequence[str], key: str, most: int) -> DataFrame:
    """Rows that may be among the first ``most`` of their group in an order that begins with ``key``: those up to the value at which
    so many are reached. Rows are read twice; only their counts per value are shuffled."""
    counts = rows.groupBy(*by, key).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    wanted = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter(F.col("_before") < most)
    last = stage(wanted.groupBy(*by).agg(F.max(key).alias("_last")), "last_values")
    return rows.join(last, list(by)).filter(F.col(key).isNull() | (F.col(key) <= F.col("_last"))).drop("_last")


def hit_counts(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Queries with the number of all their hits."""
    counts = hits.groupBy("github_query").agg(F.count(F.lit(1)).alias("github_result_count"))
    joined = queries.join(counts, "github_query", "left")
    return joined.select(
        *queries.columns, F.coalesce("github_result_count", F.lit(0)).alias("github_result_count")
    )


def results_as_json(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Queries with their (capped) hits as a JSON list and the number of hits."""
    fields = [c for c in hits.columns if c not in ("github_query", "hit_ord")]
    lists = hits.groupBy("github_query").agg(
        F.array_sort(F.collect_list(F.struct("hit_ord", *fields))).alias("found")
    )
    plain = F.transform("found", lambda h: F.struct(*[h[f].alias(f) for f in fields]))
    joined = queries.join(lists, "github_query", "left")
    return joined.select(
        *queries.columns,
        F.coalesce(F.to_json(plain), F.lit("[]")).alias("github_search_results"),
        F.coalesce(F.size("found"), F.lit(0)).alias("github_result_count"),
    )


def total_hits(results: DataFrame) -> DataFrame:
    return results.agg(
        F.coalesce(F.sum("github_result_count"), F.lit(0)).alias("total_results")
    )


def merge_new_repositories(
    base: DataFrame, more: DataFrame, by: Sequence[str] = ("github_query",)
) -> DataFrame:
    """Base hits plus those further hits whose repository the base does not have.

    A new repository may bring several hits.
    """
    known = stage(base.select(*by, "repository").distinct(), "known")
    return base.unionByName(more.join(known, [*by, "repository"], "left_anti"))


def search_texts(queries: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """The text that each search of a query would send: github_query, level, tried_query.

    Level 0 adds the first keyword, each further level the next two; a level is not reached if its first
    new keyword already occurs in the text before it.
    """
    text = F.concat_ws(" ", F.col("github_query"), *[F.lit(w) for w in keywords[:1]])
    allowed, texts = F.lit(True), [F.struct(F.lit(0).alias("level"), text.alias("tried_query"))]
    for level, n in enumerate(range(1, len(keywords), 2), 1):
        allowed = allowed & ~F.contains(text, F.lit(keywords[n]))
        text = F.concat_ws(" ", text, *[F.lit(w) for w in keywords[n : n + 2]])
        texts.append(F.when(allowed, F.struct(F.lit(level).alias("level"), text.alias("tried_query"))))
    return queries.select("github_query", F.inline(F.filter(F.array(*texts), lambda x: x.isNotNull())))


def first_pages(index: CodeIndex, rows: DataFrame, most: int) -> DataFrame:
    """query, level, the index's keys and ``rank``: the first ``most`` hits of each search by their keys, from the files of its hits (query, level, file).

    Hits are not made for that. A file that is not among the first ``most`` of a search, by the first of its names, has as many hits before all
    of its own, and so has each name behind a file's first ``most``. So only the first names of the first files meet, however many
    hits there are and whether texts have copies or not.
    """
    keys, by = index.keys, ("query", "level")
    files = index.files.select("file", "_text")
    first = index.names.groupBy("_text").agg(F.min(F.struct(*keys)).alias("_first")).join(files, "_text")
    order = stage(first.orderBy("_first", "file").select("file", F.monotonically_increasing_id().alias("_order")), "file_order")
    rows = stage(first_of_groups(rows.join(order, "file"), by, ("_order",), most, "_n").select(*by, "file"), "page_files")
    asked = stage(rows.select("file").distinct().join(files, "file"), "page_texts")
    names = late_lookup(asked, index.names, ("_text",), keys).select("file", *keys)
    names = stage(first_of_groups(names, ("file",), keys, most, "_n").drop("_n"), "page_names")
    hits = early_rows(rows.join(names, "file").select(*by, *keys), by, keys[0], most)
    # in parts first, so that no task sorts all hits of one query
    part = Window.partitionBy(*by, "_salt").orderBy(*keys)
    few = hits.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(SALTS))).withColumn("_place", F.row_number().over(part))
    page = Window.partitionBy(*by).orderBy(*keys)
    return few.filter(F.col("_place") <= most).drop("_salt", "_place").withColumn("rank", F.row_number().over(page)).filter(F.col("rank") <= most)


def adaptive_search(
    corpus: DataFrame,
    queries: DataFrame,
    keywords: Sequence[str],
    *,
    language: str | None = "java",
    page_size: int = PAGE_SIZE,
    max_pages: int = MAX_PAGES,
    max_results: int | None = 1000,
    tried: DataFrame | None = None,
    keys: Sequence[str] = ("repository", "path"),
    index: CodeIndex | None = None,
) -> DataFrame:
    """Hits per query, narrowed by further keywords as long as a search is saturated.

    The first search adds keyword 1 to the query, the next adds 2 and 3, then 4 and 5, and so
    on; a search that fills ``page_size * max_pages`` results leads to the next one, unless the
    next keyword already occurs in the query text. Hits of narrower searches are appended if
    their repository is new to the wider one. A keyword is matched as a whole word in any letter case,
    as term scores give it; the caller chooses how many there are (the usual ten make six searches).

    All searches are answered by one search of the index: each file is marked with how many of
    the keywords it holds in order, from the postings of these keywords alone, and a search keeps the files with a long enough mark. Only
    what may stand on a page becomes a hit, see ``first_pages``. A text already in ``tried`` (column ``tried_query``) is not sent: its search gives nothing and
    leads to no other. ``adaptive_run`` also returns the texts that were sent.
    """
    return adaptive_run(
        corpus, queries, keywords, language=language, page_size=page_size, max_pages=max_pages,
        max_results=max_results, tried=tried, keys=keys, index=index,
    )[0]


def adaptive_run(
    corpus: DataFrame,
    queries: DataFrame,
    keywords: Sequence[str],
    *,
    language: str | None = "java",
    page_size: int = PAGE_SIZE,
    max_pages: int = MAX_PAGES,
    max_results: int | None = 1000,
    tried: DataFrame | None = None,
    keys: Sequence[str] = ("repository", "path"),
    index: CodeIndex | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The hits of ``adaptive_search``, and the texts it sent (github_query, tried_query)."""
    keywords = list(keywords)
    limit = page_size * max_pages
    index = index or _index_of(corpus, language, keys)
    keys = index.keys
    distinct = distinct_queries(queries)
    texts = search_texts(distinct, keywords)
    if tried is not None:
        known = tried.select("tried_query", F.lit(True).alias("_known")).distinct()
        texts = texts.join(known, "tried_query", "left")
    else:
        texts = texts.withColumn("_known", F.lit(None).cast("boolean"))
    # The deepest search that the query's texts allow: the one before the first known text.
    blocked = F.min(F.when(F.col("_known"), F.col("level")))
    reachable = texts.groupBy("github_query").agg(
        F.least(F.max("level"), blocked - 1).alias("allowed")
    )
    distinct = distinct.join(reachable.filter("allowed >= 0"), "github_query")
    # Keywords needed by each search.
    depths = [min(1, len(keywords)), *(min(n + 2, len(keywords)) for n in range(1, len(keywords), 2))]

    asked, hits = numbered_hits(index, distinct, ("allowed",))
    hits = hits.join(asked.select("query", "allowed"), "query").join(keyword_marks(index, keywords), "file", "left")
    hits = hits.withColumn("held", F.coalesce("held", F.lit(0)))

    # One row per search and file that it would return; the first page of each search.
    searches = F.array(
        *[
            F.when((F.col("held") >= depth) & (F.col("allowed") >= level), F.lit(level))
            for level, depth in enumerate(depths)
        ]
    )
    rows = hits.select("query", "file", F.explode(F.filter(searches, lambda level: level.isNotNull())).alias("level"))
    pages = first_pages(index, rows, limit if max_results is None else min(limit, max_results))
    pages = pages.join(asked.select("query", "github_query"), "query").select("github_query", *keys, "level", "rank")

    # From here on there are at most six pages per query, and both results are made from them. A search runs if all wider ones fill.
    pages = stage(pages, "pages")
    of_query = Window.partitionBy("github_query")
    full = [
        F.sum((F.col("level") == level).cast("int")).over(of_query) >= limit
        for level in range(len(depths) - 1)
    ]
    reach = F.lit(len(depths) - 1)
    for level in range(len(depths) - 2, -1, -1):
        reach = F.when(full[level], reach).otherwise(F.lit(level))
    pages = pages.withColumn("reach", reach).filter(F.col("level") <= F.col("reach"))
    same_repo = Window.partitionBy("github_query", "repository")
    merged = pages.withColumn("levels", F.collect_set("level").over(same_repo)).withColumn(
        "kept", F.lit(False)
    )
    # Merge from the narrowest search outwards: a hit stays if its repository is not on the
    # wider page, and each merge is cut to the wanted number of results.
    for level in range(len(depths) - 1, -1, -1):
        new_here = F.col("kept") & ~F.array_contains("levels", level)
        merged = merged.withColumn("kept", (F.col("level") == level) | new_here)
        if max_results is not None:
            place = Window.partitionBy("github_query").orderBy(F.desc("kept"), "level", "rank")
            merged = merged.withColumn(
                "kept", F.col("kept") & (F.row_number().over(place) <= max_results)
            )
    final = Window.partitionBy("github_query").orderBy("level", "rank")
    found = merged.filter("kept").select(
        "github_query", *keys, F.row_number().over(final).alias("hit_ord")
    )
    # A query without hits has sent its first text all the same.
    depth = pages.groupBy("github_query").agg(F.max("reach").alias("reach"))
    sent = (
        texts.join(distinct.select("github_query", "allowed"), "github_query")
        .join(depth, "github_query", "left")
        .filter(F.col("level") <= F.least(F.coalesce("reach", F.lit(0)), F.col("allowed")))
        .select("github_query", "tried_query")
    )
    return found, sent


def exclude_seen(hits: DataFrame, seen: DataFrame) -> DataFrame:
    """Hits in repositories that no earlier run has reported."""
    return hits.join(seen.select("repository").distinct(), "repository", "left_anti")


def with_stars(hits: DataFrame, repositories: DataFrame) -> DataFrame:
    """Star count of each hit's repository; an unknown repository has none."""
    stars = repositories.select(
        F.col("repo_url").alias("repository"), F.col("stars_count").alias("stars")
    )
    return hits.join(stars, "repository", "left").withColumn(
        "stars", F.coalesce("stars", F.lit(0).cast("bigint"))
    )


def popular(hits: DataFrame, min_stars: int = 100) -> DataFrame:
    return hits.filter(F.col("stars") >= min_stars)


def first_per_repository(
    hits: DataFrame, order_by: Sequence[str] = ("query_ord", "hit_ord")
) -> DataFrame:
    """One hit per repository over all queries: the first in query order, then hit order.

    The rank filter also runs before the shuffle, one row per repository and partition.
    """
    w = Window.partitionBy("repository").orderBy(*order_by)
    return hits.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def keep_last(
    rows: DataFrame, keys: Sequence[str] = ("repository", "path"), order_by: Sequence[str] = ("run",)
) -> DataFrame:
    """The last row per key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order_by])
    return rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def append_results(old: DataFrame, new: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Old and new results, the newest per repository and path; new rows win over old ones."""
    both = old.withColumn("run", F.lit(0)).unionByName(
        new.withColumn("run", F.lit(1)), allowMissingColumns=True
    )
    return keep_last(both, order_by=("run", *order_by)).drop("run")


def result_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("total_snippets"),
        F.countDistinct("repository").alias("repositories"),
    )


def assemble_results(
    hits: DataFrame,
    queries: DataFrame,
    corpus: DataFrame,
    repositories: DataFrame,
    *,
    min_stars: int = 100,
    seen: DataFrame | None = None,
    keys: Sequence[str] = ("repository", "path"),
    context_lines: int = 3,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Flat result table: one hit per popular repository that is new, with a snippet.

    ``queries`` gives the metadata of each query text; of several rows with the same text the
    first in (pattern_key, cwe_id) order counts. Hits may be numbered (``hit_ord``) or not; then the
    order of their keys counts. Hits are cut down to one per repository before anything is joined with them: first by the least number
    of a query, which needs no sort, then by place among the hits of that query. File contents are looked up last, for one hit per repository: texts of other files are
    not shuffled, see ``late_lookup``.
    """
    meta = queries.filter(~blank(F.col("github_query"))).groupBy("github_query").agg(
        F.min(F.struct("pattern_key", "cwe_id", "cwe_name")).alias("m")
    )
    # Numbers in the order of the queries; a repository gets a key, since a null one is a group too.
    meta = meta.select("github_query", "m.*").orderBy("pattern_key", "cwe_id", "github_query")
    meta = stage(meta.withColumn("_query", F.monotonically_increasing_id()), "query_order")
    repository = F.coalesce(F.concat(F.lit("r"), F.col("repository")), F.lit(""))
    found = hits.join(meta.select("github_query", "_query"), "github_query").withColumn("_repository", repository)
    first = stage(found.groupBy("_repository").agg(F.min("_query").alias("_query")), "first_queries")
    found = late_lookup(first, found, ("_repository", "_query"), hits.columns, most_broadcast)
    place = ("hit_ord",) if "hit_ord" in hits.columns else tuple(k for k in keys if k != "repository")
    found = stage(first_per_repository(found, place), "first_hits").drop("_repository")
    if seen is not None:
        found = exclude_seen(found, seen)
    found = popular(with_stars(found, repositories), min_stars).join(meta.drop("github_query"), "_query")
    chosen = first_per_repository(found, ("_query", *place)).drop("_query")
    full = late_lookup(stage(chosen, "chosen"), corpus, keys, ("content",), most_broadcast)
    return full.select(
        "pattern_key",
        "cwe_id",
        "cwe_name",
        "github_query",
        "repository",
        F.col("repository").alias("repository_url"),
        "path",
        F.concat_ws("/", F.col("repository"), F.lit("blob/HEAD"), F.col("path")).alias("html_url"),
        F.sha1("content").alias("sha"),
        "stars",
        snippet(F.col("content"), snippet_terms(F.col("github_query")), context_lines).alias(
            "code_snippet"
        ),
    )
