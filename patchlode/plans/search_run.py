"""The whole search job: widening words, searches, selection, snippets, and the state for the next run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.corpus import top_terms
from ..operators.postings import CodeIndex, build_index, index_scores
from ..operators.search import adaptive_run, append_results, assemble_results
from ..session import stage
from ..streaming.incremental import tried_after


@dataclass(frozen=True)
class SearchRun:
    """New results, the result table with them, and the texts that were tried so far."""

    new: DataFrame
    results: DataFrame
    tried: DataFrame


def widening_words(index: CodeIndex, n: int = 10) -> list[str]:
    """The n best terms of an indexed corpus, from its postings; n rows reach the driver."""
    return [r["term"] for r in top_terms(index_scores(index), n).collect()]


def run_search(
    corpus: DataFrame,
    queries: DataFrame,
    repositories: DataFrame,
    *,
    keywords: Sequence[str] | None = None,
    n_words: int = 10,
    language: str = "java",
    old: DataFrame | None = None,
    tried: DataFrame | None = None,
    min_stars: int = 100,
    keys: Sequence[str] = ("repository", "path"),
    index: CodeIndex | None = None,
    **search,
) -> SearchRun:
    """Search a corpus with compiled queries and add what is new to the results of earlier runs.

    The search goes through ``index`` if given (an index of the language's files), else through one made now.
    The words that widen the queries are the best terms of the language's files unless given. Repositories of
    ``old`` results are left out, texts in ``tried`` are not sent again. ``search`` goes to ``adaptive_run``. Hits, sent texts and
    new results are staged, since several outputs are built from each.
    """
    files = corpus.filter(f"lower(lang) = '{language.lower()}'")
    index = index or build_index(files, keys)
    if keywords is None:
        keywords = widening_words(index, n_words)
    hits, sent = adaptive_run(files, queries, keywords, language=None, tried=tried, keys=keys, index=index, **search)
    hits, sent = stage(hits, "search_hits"), stage(sent, "search_sent")
    new = stage(
        assemble_results(hits, queries, files, repositories, min_stars=min_stars, seen=old, keys=keys), "search_new"
    )
    results = new if old is None else append_results(old, new)
    state = tried_after(sent)
    return SearchRun(new, results, state if tried is None else tried.select("tried_query").union(state).distinct())
