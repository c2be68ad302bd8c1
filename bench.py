"""Timings of the headline queries; prints one JSON line.

The fix tables are derived from the given tables first, and what several queries share is mined and compiled
(reported as ``prepare``); each query is then run once into a sink that takes every row and column.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from patchlode.plans.fixtures import FIXTURE_SQL, Tables  # noqa: E402
from patchlode.plans.inputs import patterns  # noqa: E402
from patchlode.plans.q_search import code_index, written_index  # noqa: E402
from patchlode.plans.registry import queries  # noqa: E402
from patchlode.session import build_session  # noqa: E402

HEADLINE = (
    "pip1_extract_options",
    "prj1_extract_columns",
    "pip1_extract_top_cwes",
    "pip2_methods",
    "tnt7_taint_flows",
    "sec1_added_measures",
    "pip3_pattern_instances",
    "pip4_full_run",
    "qry1_compiled",
    "agg12_query_report",
    "srch1_inline_search",
    "srch2_posting_search",
    "srch3_adaptive_search",
    "srch4_result_table",
    "agg13_tfidf_scores",
    "snip1_snippets",
    "join9_records_with_methods",
    "inc4_latest_results",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, sf_dir)
    began = time.time()
    for name in FIXTURE_SQL:
        getattr(tables, name)
    patterns(tables)  # and the records and instances that it starts from
    code_index(tables)
    written_index(tables)
    prepare = time.time() - began

    builds, seconds = queries(), {}
    chosen = sys.argv[1:] or HEADLINE
    for name in chosen:
        began = time.time()
        builds[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    methods = tables.method_change.count()
    files = tables.corpus_code.count()
    documents = tables.corpus_text.count()
    rates = {}
    if "pip3_pattern_instances" in seconds:
        rates["mining_methods_per_sec"] = round(methods / seconds["pip3_pattern_instances"])
    if "srch1_inline_search" in seconds:
        rates["search_files_per_sec"] = round(files / seconds["srch1_inline_search"])
    if "agg13_tfidf_scores" in seconds:
        rates["tfidf_documents_per_sec"] = round(documents / seconds["agg13_tfidf_scores"])
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "prepare_sec": round(prepare, 3),
                "rates": rates,
            }
        )
    )


if __name__ == "__main__":
    main()
