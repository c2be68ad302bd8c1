"""Sources, taint propagation and sinks of one method text, as one Column expression.

Rows without the literal part of a rule never run its regular expression, and rows without a
source never look for sinks (a sink counts only when a tainted variable stands before it).
Everything stays inside the row: no shuffle, no Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R
from .text import (
    ASSIGN,
    FLAGS,
    SPACE,
    STRING_ARRAY,
    WORD,
    blank,
    constant,
    empty_array,
    fold,
    let,
    strip,
    words,
)

SOURCE_TYPE = "array<struct<variable:string,rule_id:string,type:string>>"
SINK_TYPE = "array<struct<rule_id:string,sink_name:string,vuln_type:string,line:string>>"
FLOW_TYPE = "array<struct<source:string,sink:string,vuln_type:string,line:string>>"
ANALYSIS_TYPE = (
    f"struct<sources:{SOURCE_TYPE},sinks:{SINK_TYPE},"
    f"taint_flows:{FLOW_TYPE},tainted_variables:{STRING_ARRAY}>"
)

EDGE_TYPE = "array<struct<into:string,from:string>>"
SOURCE_RULE_TYPE = (
    "array<struct<regex:string,rule_id:string,category:string,type:string,anchor:string,reach:boolean>>"
)
SINK_RULE_TYPE = (
    "array<struct<regex:string,rule_id:string,vuln_type:string,name:string,anchor:string>>"
)

ALL_CATEGORIES = "+".join(R.SOURCE_CATEGORIES)


def source_class(cwe_id: Column) -> Column:
    """Source categories that apply to a weakness, as one ``+``-joined name."""
    upper = F.upper(cwe_id)
    chain = F
    for cwe, categories in R.CWE_SOURCE_CATEGORIES.items():
        chain = chain.when(upper == cwe, F.lit("+".join(categories)))
    return chain.otherwise(F.lit(ALL_CATEGORIES))


def _source_regex(rule: R.SourceRule, annotation_mode: str) -> str:
    if rule.kind != "annotation":
        return rule.regex
    if annotation_mode == "direct":
        values = rf"(?:\([^)]*\){SPACE}*)?(?:final{SPACE}+)?"
        return rf"{rule.regex}{values}{WORD}[\w.<>\[\],?]*{SPACE}+({WORD}+)"
    return rf"{rule.regex}(?=((?s:.{{0,{R.ANNOTATION_REACH}}})))"


def source_catalogue(rules: Sequence[R.SourceRule] = R.SOURCE_RULES, annotation_mode: str = "compat") -> Column:
    return constant(
        [
            {
                "regex": _source_regex(r, annotation_mode),
                "rule_id": r.rule_id,
                "category": r.category,
                "type": r.type,
                "anchor": r.anchor,
                "reach": r.kind == "annotation" and annotation_mode == "compat",
            }
            for r in rules
        ],
        SOURCE_RULE_TYPE,
    )


def sink_catalogue(rules: Sequence[R.SinkRule] = R.SINK_RULES) -> Column:
    return constant(
        [
            {
                "regex": r.regex,
                "rule_id": r.rule_id,
                "vuln_type": r.vuln_type,
                "name": r.name,
                "anchor": r.anchor,
            }
            for r in rules
        ],
        SINK_RULE_TYPE,
    )


def find_sources(
    code: Column,
    folded: Column,
    categories: Column,
    rules: Sequence[R.SourceRule] | str = R.SOURCE_RULES,
    annotation_mode: str = "compat",
) -> Column:
    """All source hits in rule order, then text order; repeated hits are kept.

    Annotations in ``compat`` mode: within the next 100 characters another annotation must
    follow, and the name behind that one is taken. ``direct``: the name behind the annotation
    itself. ``rules`` may be the name of a column that holds them, see ``rule_table``.
    """
    catalogue = F.col(rules) if isinstance(rules, str) else source_catalogue(rules, annotation_mode)
    second = rf"{FLAGS}@{WORD}+{SPACE}+{WORD}+{SPACE}+({WORD}+)"


    def names(rule: Column) -> Column:
        return let(
            F.regexp_extract_all(code, rule["regex"], F.lit(1)),
            lambda found: F.when(
                rule["reach"], F.transform(found, lambda t: F.regexp_extract(t, second, 1))
            ).otherwise(found),
        )

    def hits(rule: Column) -> Column:
        return F.transform(
            F.filter(names(rule), lambda v: (v != "") & ~v.isin(*R.NOT_VARIABLES)),
            lambda v: F.struct(
                v.alias("variable"), rule["rule_id"].alias("rule_id"), rule["type"].alias("type")
            ),
        )

    usable = F.filter(
        catalogue,
        lambda r: (
            F.array_contains(F.split(categories, r"\+"), r["category"])
            # "all" also means the categories that only the given rules have
            | ((categories == F.lit(ALL_CATEGORIES)) & ~r["category"].isin(*R.SOURCE_CATEGORIES))
        )
        & F.contains(folded, r["anchor"]),
    )
    return F.flatten(F.transform(usable, hits))


def _edges(code: Column, folded: Column) -> Column:
    """Moves of a whole variable: plain assignment, and a string builder that takes it in.

    Two such places never overlap, so one search for any variable finds those of every set.
    """
    gap = SPACE + "*+"
    word = f"({WORD}++)"
    owner = rf"(?:\G|(?<!{WORD})){word}"

    def pairs(regex: str, needed: str, skip: bool = False) -> Column:
        left = F.regexp_extract_all(code, F.lit(FLAGS + regex), F.lit(1))
        right = F.regexp_extract_all(code, F.lit(FLAGS + regex), F.lit(2))
        found = F.zip_with(
            left, right, lambda x, y: F.struct(x.alias("into"), fold(y).alias("from"))
        )
        if skip:
            found = F.filter(found, lambda e: ~e["into"].isin(*R.NOT_VARIABLES))
        return F.when(F.contains(folded, F.lit(needed)), found).otherwise(empty_array(EDGE_TYPE))

    return F.flatten(
        F.array(
            pairs(rf"{ASSIGN}{word}{gap}[;,\)]", "=", skip=True),
            pairs(rf"{owner}\.append{gap}\({gap}{word}{gap}\)", ".append"),
            pairs(rf"{ASSIGN}new{SPACE}++StringBuilder{gap}\({gap}{word}{gap}\)", "stringbuilder"),
        )
    )


def _joined_into(code: Column, folded: Column, known: Column) -> Column:
    """Variables that take a text joined with a known variable.

    Matches may overlap here (a text can hold what looks like an assignment), so the search is
    for exactly the known names, built from the row.
    """
    any_known = F.concat(F.lit("(?:"), F.array_join(known, "|"), F.lit(")"))
    text, plus = '"[^"]*"', rf"{SPACE}*+\+{SPACE}*+"

    def found(before: str, *after: Column) -> Column:
        regex = F.concat(F.lit(FLAGS + ASSIGN + before), any_known, *after)
        return F.regexp_extract_all(code, regex, F.lit(1))

    nothing = empty_array(STRING_ARRAY)
    with_text = F.flatten(F.array(found(text + plus), found("", F.lit(plus + text))))
    return F.when(
        F.contains(folded, F.lit("+")),
        F.concat(
            found("", F.lit(plus), any_known),
            F.when(F.contains(folded, F.lit('"')), with_text).otherwise(nothing),
        ),
    ).otherwise(nothing)


def propagate(code: Column, folded: Column, start: Column) -> Column:
    """Variables reached from ``start`` by assignment, joining of strings or a string builder.

    Each round sees the set as it was when the round began; at most five rounds, fewer if a
    round finds nothing new.
    """

    def rounds(edges: Column) -> Column:
        def moved(known: Column) -> Column:
            return let(
                F.transform(known, fold),
                lambda keys: F.transform(
                    F.filter(edges, lambda e: F.array_contains(keys, e["from"])),
                    lambda e: e["into"],
                ),
            )

        def one_round(state: Column, _: Column) -> Column:
            known, before = state["known"], state["before"]
            new = F.concat(moved(known), _joined_into(code, folded, known))
            grown = F.struct(
                F.array_union(known, new).alias("known"), F.size(known).alias("before")
            )
            return F.when(F.size(known) == before, state).otherwise(grown)

        return F.aggregate(
            F.sequence(F.lit(1), F.lit(R.PROPAGATION_ROUNDS)),
            F.struct(start.alias("known"), F.lit(0).alias("before")),
            one_round,
            lambda state: F.array_sort(state["known"]),
        )

    return let(_edges(code, folded), rounds)


def match_offsets(code: Column, found: Column) -> Column:
    """Character offset (from 0) of each of the texts that a search without lookaround found.

    The text of a match, looked up from the end of the match before it, is found at the match:
    were it found earlier, the expression would have matched there.
    """

    def next_offset(acc: Column, hit: Column) -> Column:
        return let(
            F.position(hit, code, acc["after"]),
            lambda at: F.struct(
                (at + F.length(hit)).alias("after"),
                F.array_append(acc["starts"], at - 1).alias("starts"),
            ),
        )

    return F.aggregate(
        found,
        F.struct(F.lit(1).alias("after"), empty_array("array<int>").alias("starts")),
        next_offset,
        lambda acc: acc["starts"],
    )


def find_sink_hits(
    code: Column, folded: Column, rules: Sequence[R.SinkRule] | str = R.SINK_RULES
) -> Column:
    """Every match of every sink rule, in rule order, then text order; ``rules`` may be a column's name."""
    catalogue = F.col(rules) if isinstance(rules, str) else sink_catalogue(rules)

    def hits(rule: Column) -> Column:
        return F.transform(
            match_offsets(code, F.regexp_extract_all(code, rule["regex"], F.lit(0))),
            lambda at: F.struct(
                at.alias("at"),
                rule["rule_id"].alias("rule_id"),
                rule["name"].alias("sink_name"),
                rule["vuln_type"].alias("vuln_type"),
            ),
        )

    usable = F.filter(catalogue, lambda r: F.contains(folded, r["anchor"]))
    return F.flatten(F.transform(usable, hits))


def tainted_hits(code: Column, hits: Column, tainted: Column, sink_context: str) -> Column:
    """Hits with a tainted variable before them, with that variable and the sink's line.

    Looks at the line before and the text of the sink's own line up to the match; the variable
    must be a whole word. Of several variables the smallest name is reported. In ``compat``
    mode a sink on the first of several lines never counts.
    """
    by_fold = F.transform(tainted, lambda v: F.struct(fold(v).alias("key"), v.alias("name")))

    def near(before: Column, after: Column) -> Column:
        # A word that begins before the match may run into it.
        end_of_word = F.when(
            F.rlike(before, F.lit(rf"{WORD}\z")), F.regexp_extract(after, rf"\A{WORD}+", 0)
        ).otherwise(F.lit(""))
        return words(fold(F.concat(before, end_of_word)))

    def judge(hit: Column) -> Column:
        return let(
            F.struct(
                F.substring(code, F.lit(1), hit["at"]).alias("head"),
                F.substring(code, hit["at"] + 1, F.length(code)).alias("rest"),
            ),
            lambda cut: let(
                near(F.substring_index(cut["head"], "\n", -2), cut["rest"]),
                lambda seen: F.struct(
                    hit["rule_id"].alias("rule_id"),
                    hit["sink_name"].alias("sink_name"),
                    hit["vuln_type"].alias("vuln_type"),
                    F.concat(
                        F.substring_index(cut["head"], "\n", -1),
                        F.substring_index(cut["rest"], "\n", 1),
                    ).alias("line"),
                    F.array_min(
                        F.transform(
                            F.filter(by_fold, lambda v: F.array_contains(seen, v["key"])),
                            lambda v: v["name"],
                        )
                    ).alias("source"),
                    (F.contains(cut["head"], F.lit("\n")) | one_line).alias("in_reach"),
                ),
            ),
        )

    one_line = ~F.contains(F.substring(code, F.lit(1), F.length(code) - 1), F.lit("\n"))

    def counts(hit: Column) -> Column:
        reached = hit["source"].isNotNull()
        return reached if sink_context == "symmetric" else reached & hit["in_reach"]

    return F.filter(F.transform(hits, judge), counts)


def analyze_taint(
    code: Column,
    categories: Column,
    *,
    source_rules: Sequence[R.SourceRule] | str = R.SOURCE_RULES,
    sink_rules: Sequence[R.SinkRule] | str = R.SINK_RULES,
    annotation_mode: str = "compat",
    sink_context: str = "compat",
) -> Column:
    """Struct of sources, sinks, taint_flows and tainted_variables for a method text."""
    nothing = F.struct(
        empty_array(SOURCE_TYPE).alias("sources"),
        empty_array(SINK_TYPE).alias("sinks"),
        empty_array(FLOW_TYPE).alias("taint_flows"),
        empty_array(STRING_ARRAY).alias("tainted_variables"),
    )

    def assemble(sources: Column, tainted: Column, hits: Column) -> Column:
        return F.struct(
            sources.alias("sources"),
            F.transform(
                hits,
                lambda h: F.struct(
                    h["rule_id"].alias("rule_id"),
                    h["sink_name"].alias("sink_name"),
                    h["vuln_type"].alias("vuln_type"),
                    strip(h["line"]).alias("line"),
                ),
            ).alias("sinks"),
            F.transform(
                hits,
                lambda h: F.struct(
                    h["source"].alias("source"),
                    h["sink_name"].alias("sink"),
                    h["vuln_type"].alias("vuln_type"),
                    strip(h["line"]).alias("line"),
                ),
            ).alias("taint_flows"),
            tainted.alias("tainted_variables"),
        )

    def follow(folded: Column, sources: Column) -> Column:
        start = F.array_sort(F.array_distinct(F.transform(sources, lambda s: s["variable"])))
        return let(
            propagate(code, folded, start),
            lambda tainted: let(
                tainted_hits(
                    code, find_sink_hits(code, folded, sink_rules), tainted, sink_context
                ),
                lambda hits: assemble(sources, tainted, hits),
            ),
        )

    result = let(
        fold(code),
        lambda folded: let(
            find_sources(code, folded, categories, source_rules, annotation_mode),
            lambda sources: F.when(F.size(sources) > 0, follow(folded, sources)).otherwise(
                nothing
            ),
        ),
    )
    return F.when(blank(code), nothing).otherwise(result)
