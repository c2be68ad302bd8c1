from pyspark.sql import functions as F

from patchlode.functions.patterns import (
    api_names,
    extract_pattern,
    keeps,
    pattern_key,
    query_text,
    search_terms,
)
from patchlode.plans.fixtures import TEMPLATES

OLD = {t: old.replace("~", "\n") for t, _, old, _ in TEMPLATES}
NEW = {t: new.replace("~", "\n") for t, _, _, new in TEMPLATES}
ONE_LINE = OLD[5].replace("\n", " ")
FIVE_HOPS = OLD[6].replace("  b6 = b5;\n", "").replace("b6", "b5")

# code, after, cwe, source types, sink names, tainted, missing, kept, key, query
GOLDENS = [
    (OLD[0], NEW[0], "CWE-79", {"getParameter"}, ["println", "out.print"], ["a", "b"],
     ["escapeHtml"], True, "CWE-79|out.print,println|getParameter",
     "getParameter AND println OR response.getWriter NOT escapeHtml NOT StringEscapeUtils NOT ESAPI"),
    (OLD[1], NEW[1], "CWE-22", {"fileParam", "getParameter", "newFile"},
     ["new File", "Files.readAllBytes", "toPath"], ["p", "target"],
     ["normalize", "pathValidation"], True,
     "CWE-22|Files.readAllBytes,new File,toPath|fileParam,getParameter,newFile",
     "getParameter AND new File( NOT normalize NOT getCanonicalPath NOT isValidPath NOT PathValidator"),
    (OLD[1], NEW[1], "CWE-79", {"getParameter"}, ["new File", "Files.readAllBytes", "toPath"],
     ["p"], ["normalize", "pathValidation"], True,
     "CWE-79|Files.readAllBytes,new File,toPath|getParameter", "getParameter"),
    (OLD[2], NEW[2], "CWE-89", {"getParameter"}, ["executeQuery"], ["id", "sql"],
     ["PreparedStatement"], True, "CWE-89|executeQuery|getParameter",
     "getParameter AND Statement.execute NOT PreparedStatement"),
    (OLD[3], NEW[3], "CWE-79", set(), [], [], [], False, "CWE-79|unknown|unknown", ""),
    (OLD[4], NEW[4], "CWE-79", {"RequestParam"}, ["print", "out.print"], ["b"], ["sanitize"],
     True, "CWE-79|out.print,print|RequestParam", "println OR response.getWriter"),
    (OLD[5], NEW[5], "NVD-CWE-noinfo", {"getParameter"}, [], ["a"], [], False,
     "NVD-CWE-noinfo|unknown|getParameter", "getParameter"),
    (ONE_LINE, NEW[5], "CWE-79", {"getParameter"}, ["print", "out.print"], ["a"], [], True,
     "CWE-79|out.print,print|getParameter", "getParameter AND println OR response.getWriter"),
    (OLD[6], NEW[6], "NVD-CWE-noinfo", {"getHeader"}, [], ["a", "b1", "b2", "b3", "b4", "b5"], [],
     False, "NVD-CWE-noinfo|unknown|getHeader", "getHeader"),
    (FIVE_HOPS, NEW[6], "NVD-CWE-noinfo", {"getHeader"}, ["write"],
     ["a", "b1", "b2", "b3", "b4", "b5"], [], True, "NVD-CWE-noinfo|write|getHeader", "getHeader"),
    (OLD[7], NEW[7], "CWE-502", {"readObject"}, ["readObject", "readObject"], ["o", "q"],
     ["ObjectInputFilter"], True, "CWE-502|readObject|readObject", "readObject"),
    (OLD[7], NEW[7], "CWE-79", set(), [], [], ["ObjectInputFilter"], False,
     "CWE-79|unknown|unknown", ""),
]


def run(spark, rows, **options):
    df = spark.createDataFrame(
        [(n, *row) for n, row in enumerate(rows)], "n int, code string, after string, cwe string"
    )
    pattern = extract_pattern(
        F.col("code"), F.col("code"), F.col("after"), F.lit("Java"), F.col("cwe"), **options
    )
    out = df.select("n", "cwe", pattern.alias("p"))
    terms = search_terms(F.col("p"), F.col("cwe"))
    out = out.select(
        "n",
        "p",
        keeps(F.col("cwe"), F.col("p.summary")).alias("kept"),
        pattern_key(F.col("p"), F.col("cwe")).alias("key"),
        query_text(terms).alias("query"),
    )
    return [r for r in sorted(out.collect(), key=lambda r: r.n)]


def test_goldens(spark):
    rows = run(spark, [g[:3] for g in GOLDENS])
    for row, want in zip(rows, GOLDENS, strict=True):
        p = row.p
        got = (
            {s.type for s in p.sources}, [s.sink_name for s in p.sinks], p.tainted_variables,
            p.missing_sanitizers, row.kept, row.key, row["query"],
        )
        assert got == want[3:], want[0]
        assert len(p.sinks) == len(p.taint_flows)
        assert p.missing_sanitizers == p.added_security_measures


def tainted(spark, code, cwe="CWE-79", **options):
    return run(spark, [(code, None, cwe)], **options)[0].p


P = 'a = request.getParameter("x");\n'


PROPAGATION = [
    (P.replace("\n", "\r\n") + "b = a;\r\n", ["a", "b"]),
    ('größe = request.getParameter("x");\nb = größe;', ["b", "größe"]),
    ('null = request.getParameter("x");', []),
    (P + "sb.append(a);\ns = new StringBuilder(a);", ["a", "s", "sb"]),
    (P + "b = a.trim();\nc = f(a);", ["a"]),
    ('id = request.getParameter("x");\nq = "x" + identity;', ["id", "q"]),
    ('id = request.getParameter("x");\nq = identity + "x";', ["id"]),
    (P + 'c = request.getHeader("y");\nd = a + c;\ne = z + c;', ["a", "c", "d"]),
    (P + "B = A;", ["B", "a"]),
    (P + "true = a;", ["a"]),
    (P + 'c = "k=" + z + "+ " + a;', ["a"]),
    (P + 'c = "k=" + z + "+ a";', ["a", "k"]),
    ("REQUEST = 1; x = MyRequestWrapper.GETPARAMETER ( 1 )", ["x"]),
    (P + "ıd = a;", ["a", "ıd"]),
]


def test_propagation(spark):
    rows = run(spark, [(code, None, "CWE-79") for code, _ in PROPAGATION])
    for row, (code, names) in zip(rows, PROPAGATION, strict=True):
        assert row.p.tainted_variables == names, code


def test_annotation_modes(spark):
    code = "void f(@RequestParam String a) {\n log(a);\n out.print(a);\n}"
    assert tainted(spark, code).sources == []
    direct = tainted(spark, code, annotation_mode="direct")
    assert [s.variable for s in direct.sources] == ["a"]
    far = "@RequestParam" + " " * 100 + "@PathParam String b"
    assert [s.variable for s in tainted(spark, far).sources] == ["b"]  # blanks are skipped first
    far = "@RequestParam X" + " " * 100 + "@PathParam String b"
    assert tainted(spark, far).sources == []


CONTEXTS = [
    (P + "out.print(a);", ["out.print(a);"] * 2),  # the line above names it
    (P + "\nout.print(a);", []),  # two lines above: out of reach
    (P + "x(); out.print(a);\n", ["x(); out.print(a);"] * 2),
    (P + "\na .println(1);", ["a .println(1);"]),
    (P + "\nxa.println(1);", []),  # not a whole word
    (P + "\nA.println(1); a.println(2);", ["A.println(1); a.println(2);"] * 2),
    ("a" + P[1:-1] + " a.println(1);", [(P[:-1] + " a.println(1);")]),  # one line only
    ("a" + P[1:-1] + " a.println(1);\n}", []),  # first of two lines
    (P + "\na.execute\n(1);", ["a.execute"]),  # the match runs over the line end
]


def test_sink_context(spark):
    rows = run(spark, [(code, None, "CWE-79") for code, _ in CONTEXTS])
    for row, (code, lines) in zip(rows, CONTEXTS, strict=True):
        assert [s.line for s in row.p.sinks] == lines, code


def test_symmetric_context(spark):
    code = P[:-1] + " a.println(1);\n}"
    assert tainted(spark, code).sinks == []
    assert [s.sink_name for s in tainted(spark, code, sink_context="symmetric").sinks] == ["println"]


def test_word_that_runs_into_the_match(spark):
    code = 'xout = request.getParameter("q");\n\nxout.print(1);'
    p = tainted(spark, code)
    assert [(f.source, f.sink) for f in p.taint_flows] == [("xout", "print"), ("xout", "out.print")]


def test_blank_and_other_languages_give_an_empty_pattern(spark):
    df = spark.createDataFrame(
        [("", "Java"), ("  \n", "java"), (None, "Java"), (OLD[0], "Go"), (OLD[0], "JAVA")],
        "code string, lang string",
    )
    p = extract_pattern(
        F.col("code"), F.lit(None).cast("string"), F.lit(NEW[0]), F.col("lang"), F.lit("CWE-79")
    )
    got = [r.p.summary for r in df.select(p.alias("p")).collect()]
    assert [s.has_source for s in got] == [False] * 4 + [True]
    assert [s.missing_security for s in got] == [False] * 4 + [True]


def test_api_names(spark):
    code = (
        "import java.util.List;\nimport static org.acme.Zed.*;\nimport java.nio.file.Files;\n"
        "Files.copy(a); Runtime r; x.getParameter(1); HttpSession s; Cookie c; Path p;"
    )
    df = spark.createDataFrame([(code,), ("",), (None,)], "code string")
    got = [r[0] for r in df.select(api_names(F.col("code"))).collect()]
    assert got == [["Cookie", "Files", "HttpSession", "Path", "Runtime"], [], []]


def test_rules_of_the_user(spark):
    """Lists of rules, a category and a measure of one's own."""
    from patchlode.functions import rules as R
    from patchlode.functions.measures import added_measures
    from patchlode.functions.taint import ALL_CATEGORIES, analyze_taint
    from patchlode.functions.text import by_name

    code = "void m() {\n int z = 0;\n String q = readTape();\n  burn.disc(q);\n return;\n}"
    df = spark.createDataFrame([(code, ALL_CATEGORIES, "", "x.scrubbed(y)")], "code string, cls string, before string, after string")
    own_source = R.SourceRule("own.1", "fil", "TapeInput", "readTape(")
    sources = [*R.SOURCE_RULES, own_source]
    sinks = [*R.SINK_RULES, R.SinkRule("own.2", "burning", "burn.disc", "burn.disc(")]
    found = df.select(by_name(analyze_taint)("code", "cls", source_rules=sources, sink_rules=sinks).alias("a"),
                      by_name(added_measures)("before", "after", measures={"scrub": ["scrubbed("]}).alias("m")).first()
    assert [s.type for s in found.a.sources] == ["TapeInput"] and [s.sink_name for s in found.a.sinks] == ["burn.disc"]
    assert found.m == ["scrub"]
    # a category is no part of another one's name
    other = df.selectExpr("code", "'file+network' AS cls").select(by_name(analyze_taint)("code", "cls", source_rules=sources).alias("a")).first()
    assert not other.a.sources


def test_rule_table(spark):
    """The usual rules from a table's column find what they find as constants, beside own ones."""
    import pytest

    from patchlode.functions.measures import added_measures
    from patchlode.functions.taint import ALL_CATEGORIES, analyze_taint
    from patchlode.functions.text import by_name
    from patchlode.operators.rule_table import MEASURES, SINKS, SOURCES, rule_catalogue
    from patchlode.plans.fixtures import RULE_TEMPLATES, TEMPLATES

    schema = "name string, kind string, regex string, category string"
    own = spark.createDataFrame(
        [("Tape", "source", r"(\w+)\s*=\s*readTape\(", "tape"), ("burn", "sink", r"burn\.disc", "Own"), ("scrub", "measure", r"scrubbed\(", None),
         ("Own", "annotation", "@Own", "tape"), ("burn", "sink", r"burn\.disc", "Own")], schema)
    rows = [(old.replace("~", "\n"), new.replace("~", "\n"), ALL_CATEGORIES) for _, _, old, new in TEMPLATES + RULE_TEMPLATES]
    rows.append(("void m(@Own String a, @Own String b) {\n int z = 0;\n String q = READTAPE();\n  burn.disc(q);\n return;\n}", "x.scrubbed(y)", ALL_CATEGORIES))
    df = spark.createDataFrame(rows, "old string, new string, cls string")
    analysis, names = by_name(analyze_taint), by_name(added_measures)
    plain = df.select(analysis("old", "cls").alias("a"), names("old", "new").alias("m")).collect()
    every = df.crossJoin(rule_catalogue(own))
    got = every.select(
        analysis("old", "cls", source_rules=SOURCES, sink_rules=SINKS).alias("a"), names("old", "new", measures=MEASURES).alias("m")).collect()
    assert got[:-1] == plain[:-1] and not plain[-1].a.sources
    last = got[-1]
    assert [(s.variable, s.type) for s in last.a.sources] == [("b", "Own"), ("q", "Tape")]
    assert [(f.source, f.sink) for f in last.a.taint_flows] == [("q", "burn")] and last.m == ["scrub"]
    alone = rule_catalogue(own, defaults=False).first()
    assert [len(alone[c]) for c in (SOURCES, SINKS, MEASURES)] == [2, 1, 1]
    for bad in ([("x", "rule", "a", None)], [(None, "sink", "a", None)]):
        with pytest.raises(ValueError):
            rule_catalogue(spark.createDataFrame(bad, schema))
    empty = rule_catalogue(spark.createDataFrame([], schema), defaults=False).first()
    assert [len(empty[c]) for c in (SOURCES, SINKS, MEASURES)] == [0, 0, 0]
