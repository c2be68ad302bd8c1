"""Queries: corpus search, term scores, snippets and merging of results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import snippet_terms
from ..functions.text import snippet
from ..operators import postings as P
from ..operators import search as Q
from ..operators.corpus import distinct_terms, files_of_language, line_snippets, tfidf_terms, top_terms
from ..session import stage_path
from ..sources.versioned import ResultTable
from .fixtures import Tables
from .inputs import patterns
from .registry import query
from .search_run import run_search, widening_words

HIT = "github_query, repository, path"
P_KEYS = ("repository", "path")


def code_index(t: Tables) -> P.CodeIndex:
    """The index of all Java files, written once per session like the tables themselves."""
    java = t.corpus_code.filter("lang = 'java'")
    files = t.staged("index_files", lambda: P.index_files(java))
    names = t.staged("index_names", lambda: P.index_names(java, P_KEYS))
    postings = t.staged("index_postings", lambda: P.index_postings(files))
    grams = t.staged("index_grams", lambda: P.index_grams(postings))
    return P.CodeIndex(files, postings, grams, names, P_KEYS)


def code_hits(t: Tables, readers: DataFrame | None = None) -> DataFrame:
    return Q.search_corpus(t.corpus_code, patterns(t), index=code_index(t), readers=readers)


@query("srch1_inline_search", f"SELECT {HIT} FROM code_hits")
def _(t: Tables) -> DataFrame:
    return code_hits(t)


def written_index(t: Tables) -> P.CodeIndex:
    """The same index, written as a whole and opened again."""
    folder = t.staged_folder("code_index", lambda path: P.write_index(t.corpus_code.filter("lang = 'java'"), path, P_KEYS))
    return P.open_index(t.spark, folder, P_KEYS)


# (sources, sinks, excluded): words that are parts of words, several words, and signs
PHRASES = (
    (("request.getParameter(", "getHead"), ("new File(", "execute", "out.print"), ("ps.setString",)),
    (("HttpServletRequest request) {",), (), ("println(b)",)),
    ((), ("Stream(", "+ a;"), ("getP",)),
    (("=",), ("readObject();", "b6"), ()),
    ((), (), ("String", "(")),
    (("no such words here",), ("out",), ()),
)


def _phrases_sql() -> str:
    def words(group: tuple[str, ...]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in group) + "]::VARCHAR[]"

    rows = ", ".join(f"({n}, {', '.join(map(words, groups))})" for n, groups in enumerate(PHRASES))
    return f"""
        SELECT 'phrase ' || n AS github_query, repository, path
        FROM corpus_code c, (VALUES {rows}) q(n, source_kw, sink_kw, not_kw)
        WHERE lang = 'java' AND (len(source_kw) = 0 OR len(list_filter(source_kw, lambda w: contains(c.content, w))) > 0)
          AND (len(sink_kw) = 0 OR len(list_filter(sink_kw, lambda w: contains(c.content, w))) > 0)
          AND len(list_filter(not_kw, lambda w: contains(c.content, w))) = 0"""


@query("srch2_posting_search", f"SELECT {HIT} FROM code_hits UNION ALL {_phrases_sql()}")
def _(t: Tables) -> DataFrame:
    """Patterns, and queries of word parts, phrases and signs, through an index that was written and opened again."""
    rows = [(f"phrase {n}", *map(list, groups)) for n, groups in enumerate(PHRASES)]
    phrases = t.spark.createDataFrame(rows, "github_query string, source_kw array<string>, sink_kw array<string>, not_kw array<string>")
    queries = Q.distinct_queries(patterns(t)).unionByName(phrases)
    return P.search_index(written_index(t), queries)


@query(
    "join14_patterns_in_files",
    """SELECT q.pattern_key, h.repository, h.path FROM query_rows q
       JOIN code_hits h ON h.github_query = q.github_query""",
)
def _(t: Tables) -> DataFrame:
    keys = patterns(t).select("pattern_key", "github_query")
    return code_hits(t, keys).select("pattern_key", "repository", "path")


@query("win5_capped_hits", f"SELECT {HIT}, hit_ord FROM capped_hits")
def _(t: Tables) -> DataFrame:
    return Q.cap_per_query(code_hits(t), 100)


JSON_SQL = """
    SELECT q.pattern_key, q.github_query, coalesce(h.found, '[]') AS github_search_results,
           CAST(coalesce(h.n, 0) AS INTEGER) AS github_result_count
    FROM query_rows q LEFT JOIN (
      SELECT github_query, count(*) AS n,
             '[' || string_agg('{"repository":"' || repository || '","path":"' || path || '"}', ','
                               ORDER BY hit_ord) || ']' AS found
      FROM capped_hits GROUP BY github_query) h ON h.github_query = q.github_query"""


def json_results(t: Tables) -> DataFrame:
    hits = Q.cap_per_query(code_hits(t), 100).select(
        "github_query", "hit_ord", "repository", "path"
    )
    return Q.results_as_json(patterns(t).select("pattern_key", "github_query"), hits)


@query("snk7_results_as_json", JSON_SQL)
def _(t: Tables) -> DataFrame:
    return json_results(t)


@query(
    "agg14_total_hits",
    """SELECT count(*) AS total_results FROM query_rows q
       JOIN code_hits h ON h.github_query = q.github_query""",
)
def _(t: Tables) -> DataFrame:
    return Q.total_hits(Q.hit_counts(patterns(t).select("pattern_key", "github_query"), code_hits(t)))


@query(
    "flt13_by_extension",
    """SELECT repository, path FROM corpus_code WHERE suffix(path, '.java')""",
)
def _(t: Tables) -> DataFrame:
    return files_of_language(t.corpus_code, "java").select("repository", "path")


STARS_SQL = """
    SELECT h.github_query, h.repository, h.path, coalesce(r.stars_count, 0) AS stars
    FROM code_hits h LEFT JOIN repository r ON r.repo_url = h.repository"""


def starred(t: Tables) -> DataFrame:
    return Q.with_stars(code_hits(t), t.repository)


@query("join10_star_counts", STARS_SQL)
def _(t: Tables) -> DataFrame:
    return starred(t)


@query("flt12_minimum_stars", f"SELECT * FROM ({STARS_SQL}) WHERE stars >= 100")
def _(t: Tables) -> DataFrame:
    return Q.popular(starred(t), 100)


SEEN_SQL = "SELECT repo_url FROM repository WHERE stars_count % 2 = 0"


@query(
    "join11_not_seen",
    f"""SELECT {HIT} FROM code_hits
        WHERE repository NOT IN ({SEEN_SQL})""",
)
def _(t: Tables) -> DataFrame:
    seen = t.repository.filter("stars_count % 2 = 0").select(F.col("repo_url").alias("repository"))
    return Q.exclude_seen(code_hits(t), seen)


FIRST_SQL = f"""
    SELECT * FROM ({STARS_SQL}) WHERE stars >= 100
    QUALIFY row_number() OVER (PARTITION BY repository ORDER BY github_query, path) = 1"""


@query("win4_first_per_repository", FIRST_SQL)
def _(t: Tables) -> DataFrame:
    return Q.first_per_repository(Q.popular(starred(t)), ("github_query", "path"))


TERMS_SQL = r"""list_filter(string_split_regex(replace(replace({q}, 'NOT', ' '),
    'language:', ' '), '\s+'), lambda w: length(w) > 2)"""


def _snippet_sql(source: str, keys: str, terms: str) -> str:
    """Lines near a match by windows over numbered lines."""
    return f"""
    SELECT {keys}, string_agg(CASE WHEN n - prev > 7 THEN '...' || chr(10) ELSE '' END || line,
                              chr(10) ORDER BY n) AS code_snippet
    FROM (SELECT *, lag(n) OVER (PARTITION BY {keys} ORDER BY n) AS prev
          FROM (SELECT *, max(hit) OVER (PARTITION BY {keys} ORDER BY n
                            ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS near
                FROM (SELECT {keys}, line, n,
                             CASE WHEN len(list_filter({terms}, lambda w:
                               contains(lower(line), lower(w)))) > 0 THEN 1 ELSE 0 END AS hit
                      FROM (SELECT *, unnest(string_split(content, chr(10))) AS line,
                                   generate_subscripts(string_split(content, chr(10)), 1) AS n
                            FROM ({source}))))
          WHERE near = 1)
    GROUP BY {keys}"""


DOC_TERMS = ["secret", "license", "water"]


@query(
    "snip1_snippets",
    _snippet_sql("SELECT path, content FROM corpus_text", "path", str(DOC_TERMS)),
)
def _(t: Tables) -> DataFrame:
    terms = F.array(*[F.lit(w) for w in DOC_TERMS])
    made = t.corpus_text.select("path", snippet(F.col("content"), terms).alias("code_snippet"))
    return made.filter("code_snippet <> ''")


@query(
    "win6_line_frames",
    _snippet_sql("SELECT path, content FROM corpus_text", "path", str(DOC_TERMS)),
)
def _(t: Tables) -> DataFrame:
    """The same snippets by frames over single lines, as very long files need them."""
    return line_snippets(t.corpus_text, ("path",), F.array(*[F.lit(w) for w in DOC_TERMS]))


@query(
    "win6_context_lines",
    f"""SELECT path, CAST(len(string_split(code_snippet, chr(10))) AS INTEGER) AS n_lines
        FROM ({_snippet_sql("SELECT path, content FROM corpus_text", "path", str(DOC_TERMS))})""",
)
def _(t: Tables) -> DataFrame:
    terms = F.array(*[F.lit(w) for w in DOC_TERMS])
    made = t.corpus_text.select("path", snippet(F.col("content"), terms).alias("s"))
    return made.filter("s <> ''").select("path", F.size(F.split("s", "\n", -1)).alias("n_lines"))


def _result_sql(stars: str, place: str) -> str:
    return f"""
    SELECT f.*, m.pattern_key, m.cwe_id, m.cwe_name, c.content
    FROM (SELECT h.*, q.pattern_key AS first_key FROM ({stars}) h
          JOIN (SELECT github_query, min(pattern_key) AS pattern_key FROM query_rows
                GROUP BY github_query) q ON q.github_query = h.github_query
          WHERE h.stars >= 100
          QUALIFY row_number() OVER (PARTITION BY h.repository
            ORDER BY q.pattern_key, h.github_query, h.{place}) = 1) f
    JOIN query_rows m ON m.pattern_key = f.first_key
    JOIN corpus_code c ON c.repository = f.repository AND c.path = f.path"""


RESULT_SQL = _result_sql(STARS_SQL, "path")


def _table_sql(result: str) -> str:
    snippets = _snippet_sql(
        f"SELECT repository, path, content, github_query FROM ({result})", "repository, path", TERMS_SQL.format(q="github_query"))
    return f"""SELECT r.pattern_key, r.cwe_id, r.cwe_name, r.github_query, r.repository,
               r.repository AS repository_url, r.path,
               r.repository || '/blob/HEAD/' || r.path AS html_url, sha1(r.content) AS sha,
               r.stars, coalesce(s.code_snippet, '') AS code_snippet
        FROM ({result}) r
        LEFT JOIN ({snippets}) s ON s.repository = r.repository AND s.path = r.path"""


def results(t: Tables) -> DataFrame:
    return Q.assemble_results(code_hits(t), patterns(t), t.corpus_code, t.repository)


@query("srch4_result_table", _table_sql(RESULT_SQL))
def _(t: Tables) -> DataFrame:
    return results(t)


@query(
    "agg15_result_repositories",
    f"""SELECT count(*) AS total_snippets, count(DISTINCT repository) AS repositories
        FROM ({RESULT_SQL})""",
)
def _(t: Tables) -> DataFrame:
    return Q.result_summary(results(t))


PAGE, RESULTS, N_WORDS = 20, 35, 5


def _search_sql(page: int = PAGE, results: int = RESULTS) -> str:
    """The searches one after the other, each capped, merged from the narrowest outwards; the words
    that widen them are the best terms of the code corpus."""
    pages = []
    for level, depth in enumerate((1, 3, 5)):
        holds = " AND ".join(f"list_contains(tokens, w[{n}])" for n in range(1, depth + 1))
        # Stop where the next keyword already occurs in the query text.
        for n in range(1, depth, 2):
            holds += f" AND NOT contains(github_query || ' ' || array_to_string(w[1:{n}], ' '), w[{n + 1}])"
        full = (
            f"AND github_query IN (SELECT github_query FROM page{level - 1} GROUP BY github_query"
            f" HAVING count(*) >= {page})"
            if level
            else ""
        )
        pages.append(
            f"""page{level} AS (
            SELECT github_query, repository, path, row_number() OVER (PARTITION BY github_query
                     ORDER BY repository, path) AS rank, {level} AS level
            FROM code_hits JOIN code_tokens USING (repository, path), code_words
            WHERE {holds} {full}
            QUALIFY row_number() OVER (PARTITION BY github_query
                     ORDER BY repository, path) <= {page})"""
        )
    merges, inner = [], "page2"
    for level in (1, 0):
        merges.append(
            f"""merge{level} AS (
            SELECT * FROM (SELECT * FROM page{level} UNION ALL
              SELECT m.* FROM {inner} m WHERE NOT EXISTS (SELECT 1 FROM page{level} p
                WHERE p.github_query = m.github_query AND p.repository = m.repository))
            QUALIFY row_number() OVER (PARTITION BY github_query ORDER BY level, rank) <= {results})"""
        )
        inner = f"merge{level}"
    return f"""
        WITH {", ".join(pages + merges)}
        SELECT github_query, repository, path, CAST(row_number() OVER (PARTITION BY github_query
                 ORDER BY level, rank) AS INTEGER) AS hit_ord
        FROM merge0"""


def code_words(t: Tables) -> list[str]:
    """The best terms of the code corpus."""
    return widening_words(code_index(t), N_WORDS)


@query("srch3_adaptive_search", f"SELECT * FROM ({_search_sql()})")
def _(t: Tables) -> DataFrame:
    return Q.adaptive_search(
        t.corpus_code,
        patterns(t),
        code_words(t),
        page_size=PAGE // 4,
        max_pages=4,
        max_results=RESULTS,
        index=code_index(t),
    )


RUN_PAGE, RUN_RESULTS = 4000, 7000
SEARCHED_SQL = f"""
    SELECT h.github_query, h.repository, h.path, h.hit_ord, coalesce(r.stars_count, 0) AS stars
    FROM ({_search_sql(RUN_PAGE, RUN_RESULTS)}) h LEFT JOIN repository r ON r.repo_url = h.repository
    WHERE h.repository NOT IN ({SEEN_SQL})"""


@query("srch4_search_run", _table_sql(_result_sql(SEARCHED_SQL, "hit_ord")))
def _(t: Tables) -> DataFrame:
    """The whole job, after a run that has seen every second repository."""
    seen = t.repository.filter("stars_count % 2 = 0").select(F.col("repo_url").alias("repository"))
    return run_search(
        t.corpus_code, patterns(t), t.repository, n_words=N_WORDS, old=seen.withColumn("path", F.lit("")),
        page_size=RUN_PAGE // 4, max_pages=4, max_results=RUN_RESULTS, index=code_index(t),
    ).new


@query(
    "set3_new_repositories",
    f"""SELECT {HIT} FROM code_hits WHERE contains(github_query, 'println')
        UNION ALL
        SELECT {HIT} FROM code_hits h WHERE NOT contains(github_query, 'println')
          AND repository NOT IN (SELECT repository FROM code_hits
                                 WHERE contains(github_query, 'println'))""",
)
def _(t: Tables) -> DataFrame:
    hits = code_hits(t).select("github_query", "repository", "path")
    base = hits.filter(F.contains("github_query", F.lit("println")))
    more = hits.filter(~F.contains("github_query", F.lit("println")))
    return Q.merge_new_repositories(base, more, by=())


@query("tfi1_tokens", "SELECT path, term FROM doc_terms")
def _(t: Tables) -> DataFrame:
    return distinct_terms(t.corpus_text, ("path",))


@query(
    "agg13_tfidf_scores", "SELECT term, round(score, 6) AS score FROM term_scores"
)
def _(t: Tables) -> DataFrame:
    scores = tfidf_terms(t.corpus_text, base_query="the AND")
    return scores.select("term", F.round("score", 6).alias("score"))


@query(
    "tfi2_summed_weights",
    """SELECT count(*) AS terms, round(sum(score), 3) AS total, round(max(score), 6) AS best
       FROM term_scores""",
)
def _(t: Tables) -> DataFrame:
    return tfidf_terms(t.corpus_text, base_query="the and").agg(
        F.count(F.lit(1)).alias("terms"),
        F.round(F.sum("score"), 3).alias("total"),
        F.round(F.max("score"), 6).alias("best"),
    )


@query(
    "tfi3_ranked_terms",
    """SELECT term, round(score, 6) AS score FROM term_scores
       ORDER BY round(score, 6) DESC, term LIMIT 50""",
)
def _(t: Tables) -> DataFrame:
    best = top_terms(tfidf_terms(t.corpus_text, base_query="the and"), 50)
    return best.select("term", F.round("score", 6).alias("score"))


@query(
    "srt4_top_keywords",
    "SELECT term FROM term_scores ORDER BY round(score, 6) DESC, term LIMIT 10",
)
def _(t: Tables) -> DataFrame:
    return top_terms(tfidf_terms(t.corpus_text, base_query="the and")).select("term")


HALVES = "event_id % 2"
HIT_COLUMNS = "query_ord, hit_ord, repository, path, value"


@query(
    "set1_union_all",
    f"""SELECT {HIT_COLUMNS} FROM hits WHERE hit_ord % 2 = 0
        UNION ALL SELECT {HIT_COLUMNS} FROM hits WHERE hit_ord % 2 = 1""",
)
def _(t: Tables) -> DataFrame:
    old, new = t.hits.filter("hit_ord % 2 = 0"), t.hits.filter("hit_ord % 2 = 1")
    return old.unionByName(new, allowMissingColumns=True)


@query(
    "set2_keep_last",
    f"""SELECT {HIT_COLUMNS} FROM hits
        QUALIFY row_number() OVER (PARTITION BY repository, path ORDER BY hit_ord DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    return Q.keep_last(t.hits, order_by=("hit_ord",))


@query(
    "win3_last_per_repository",
    f"""SELECT {HIT_COLUMNS} FROM hits
        QUALIFY row_number() OVER (PARTITION BY repository ORDER BY hit_ord DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    return Q.keep_last(t.hits, ("repository",), ("hit_ord",))


@query(
    "snk5_append_results",
    f"""SELECT {HIT_COLUMNS} FROM hits
        QUALIFY row_number() OVER (PARTITION BY repository, path
          ORDER BY hit_ord % 4 DESC, hit_ord DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    """Four runs append to the written table; one of them fails after its data and is repeated, one is repeated without need."""
    table = ResultTable(t.spark, stage_path(t.spark, "results"), t.hits.schema, order_by=("hit_ord",), fan=2)
    for run in range(4):
        new = t.hits.filter(F.col("hit_ord") % 4 == run)
        if run == 2:
            table.write_data(new.limit(1000), f"run-{run}")  # as far as a writer that is lost
        table.commit(new, f"run-{run}")
        if run == 1:
            table.commit(new, f"run-{run}")
    return table.read()
