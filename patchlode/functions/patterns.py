"""Pattern struct, keep rule, pattern key and search text of one method."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .measures import added_measures
from .taint import analyze_taint, source_class
from .text import STRING_ARRAY, blank, constant, empty_array, first_filled, let, strip


ANALYSIS_FIELDS = ("sources", "sinks", "taint_flows", "tainted_variables")


def make_pattern(analysis: Column, missing: Column) -> Column:
    """Analysis plus measures plus the four summary flags."""

    def build(a: Column) -> Column:
        flags = {
            "has_source": F.size(a["sources"]) > 0,
            "has_sink": F.size(a["sinks"]) > 0,
            "has_taint_flow": F.size(a["taint_flows"]) > 0,
            "missing_security": F.size(missing) > 0,
        }
        return F.struct(
            *[a[name].alias(name) for name in ANALYSIS_FIELDS],
            missing.alias("missing_sanitizers"),
            missing.alias("added_security_measures"),
            F.struct(*[flag.alias(name) for name, flag in flags.items()]).alias("summary"),
        )

    return let(analysis, build)


def extract_pattern(
    method_code: Column,
    file_before: Column,
    file_after: Column,
    language: Column,
    cwe_id: Column,
    **options,
) -> Column:
    """Pattern of one method. Blank code, or a language other than Java, gives an empty one."""
    usable = ~blank(method_code) & (F.lower(language) == "java")
    code = F.when(usable, method_code)
    before = first_filled(file_before, method_code)
    missing = F.when(usable, added_measures(before, file_after)).otherwise(
        empty_array(STRING_ARRAY)
    )
    analysis = analyze_taint(code, source_class(cwe_id), **options)
    return let(missing, lambda m: make_pattern(analysis, m))


def keeps(cwe_id: Column, summary: Column) -> Column:
    """Whether a pattern is evidence for a weakness."""
    source_and_sink = summary["has_source"] & summary["has_sink"]
    flow = source_and_sink & summary["has_taint_flow"]
    return (
        F.when(cwe_id == "NVD-CWE-noinfo", source_and_sink)
        .when(cwe_id == "CWE-79", flow)
        .otherwise(flow & summary["missing_security"])
    )


def sorted_names(names: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(names)), ",")


def pattern_key(pattern: Column, cwe_id: Column) -> Column:
    """``weakness|sink names|source types``, names distinct and sorted, 'unknown' if none."""

    def part(names: Column) -> Column:
        return F.coalesce(F.nullif(sorted_names(names), F.lit("")), F.lit("unknown"))

    return F.concat_ws(
        "|",
        F.coalesce(F.nullif(cwe_id, F.lit("")), F.lit("unknown")),
        part(F.transform(pattern["sinks"], lambda s: s["sink_name"])),
        part(F.transform(pattern["sources"], lambda s: s["type"])),
    )


def key_part(key: Column, position: int) -> Column:
    """Part of a pattern key: 1 gives the sink names, 2 the source types."""
    return F.coalesce(F.get(F.split(key, r"\|", -1), F.lit(position)), F.lit(""))


def _weakness_class(cwe_id: Column, table: dict) -> Column:
    """The weakness itself where it has keywords of its own, else ''."""
    return F.when(cwe_id.isin(*[c for c in table if c]), cwe_id).otherwise(F.lit(""))


def _look_up(names: Column, table: dict[str, tuple[str, ...]]) -> Column:
    """Keywords of all names, in the order of the names; a name not in the table has none."""
    found = F.transform(
        names, lambda n: F.try_element_at(constant(table, "map<string,array<string>>"), n)
    )
    return F.flatten(F.filter(found, lambda k: k.isNotNull()))


def source_keywords(source_types: Column) -> Column:
    table = {name: (word,) for name, word in R.SOURCE_KEYWORDS.items()}
    return F.array_sort(F.array_distinct(_look_up(source_types, table)))


def sink_keywords(sink_names: Column, cwe_id: Column) -> Column:
    table = {
        f"{cwe}|{sink}": words
        for cwe, groups in R.SINK_KEYWORDS.items()
        for words, sinks in groups.items()
        for sink in sinks
    }
    weakness = _weakness_class(cwe_id, R.SINK_KEYWORDS)
    keys = F.transform(sink_names, lambda n: F.concat_ws("|", weakness, n))
    return F.array_sort(F.array_distinct(_look_up(keys, table)))


def not_keywords(missing: Column, cwe_id: Column) -> Column:
    """Excluded words of the missing measures; measures come in catalogue order."""
    table = {
        f"{cwe}|{measure}": words
        for cwe, measures in R.NOT_KEYWORDS.items()
        for measure, words in measures.items()
    }
    weakness = _weakness_class(cwe_id, R.NOT_KEYWORDS)
    return _look_up(F.transform(missing, lambda n: F.concat_ws("|", weakness, n)), table)


def search_terms(pattern: Column, cwe_id: Column) -> Column:
    """Keyword arrays of a pattern: any source word and any sink word, and no excluded word.

    When a pattern has no keyword at all its first sink name takes the place of the sink words.
    """

    def build(p: Column) -> Column:
        return let(
            F.struct(
                source_keywords(F.transform(p["sources"], lambda s: s["type"])).alias("src"),
                sink_keywords(
                    F.transform(p["sinks"], lambda s: s["sink_name"]), cwe_id
                ).alias("snk"),
                not_keywords(p["missing_sanitizers"], cwe_id).alias("neg"),
                F.slice(F.transform(p["sinks"], lambda s: s["sink_name"]), 1, 1).alias("first"),
            ),
            lambda w: F.struct(
                w["src"].alias("source_kw"),
                F.when(F.size(F.concat(w["src"], w["snk"], w["neg"])) == 0, w["first"])
                .otherwise(w["snk"])
                .alias("sink_kw"),
                w["neg"].alias("not_kw"),
            ),
        )

    return let(pattern, build)


def query_text(terms: Column) -> Column:
    """Boolean search text: groups joined by AND, words by OR, then one NOT per excluded word."""
    groups = F.filter(
        F.array_distinct(
            F.array(
                F.array_join(terms["source_kw"], " OR "), F.array_join(terms["sink_kw"], " OR ")
            )
        ),
        lambda g: g != "",
    )
    excluded = F.transform(terms["not_kw"], lambda w: F.concat(F.lit(" NOT "), w))
    return F.concat(F.array_join(groups, " AND "), F.array_join(excluded, ""))


def with_language(query: Column, language: str | None, place: str = "suffix") -> Column:
    """Add a language qualifier behind (``suffix``) or before (``prefix``) the query."""
    if not language:
        return query
    tag = F.lit(f"language:{language}")
    return F.concat_ws(" ", query, tag) if place == "suffix" else F.concat_ws(" ", tag, query)


def snippet_terms(query: Column) -> Column:
    """Words of a query used to find matching lines; AND and excluded words stay in."""
    plain = F.replace(
        F.replace(strip(query), F.lit("NOT"), F.lit(" ")), F.lit("language:"), F.lit(" ")
    )
    return F.filter(F.split(plain, r"[\s\x1c-\x1f\x85\p{Z}]+"), lambda t: F.length(t) > 2)


def api_names(code: Column, language: Column | None = None, limit: int = 5) -> Column:
    """Class names of well-known libraries and imports used in Java code, sorted, at most five."""
    word = r"[\w\p{L}\p{N}]"
    catalogue = "|".join(sorted(R.API_CLASSES, key=len, reverse=True))
    known = F.regexp_extract_all(
        code, F.lit(rf"(?<!{word})({catalogue})(?!{word})"), F.lit(1)
    )
    space = r"[\s\x1c-\x1f\x85\p{Z}]"
    imports = F.regexp_extract_all(
        code,
        F.lit(
            rf"import{space}+(?:static{space}+)?(?:[\w\p{{L}}\p{{N}}.]+\.)?([A-Z]{word}+)(?:\.\*)?;"
        ),
        F.lit(1),
    )
    names = F.filter(
        F.array_distinct(F.concat(known, imports)),
        lambda n: (F.length(n) > 2) & ~F.lower(n).isin(*R.GENERIC_TYPE_NAMES),
    )
    usable = ~blank(code)
    if language is not None:
        usable = usable & (F.lower(language) == "java")
    return F.when(usable, F.slice(F.array_sort(names), 1, limit)).otherwise(
        empty_array(STRING_ARRAY)
    )
