from pyspark.sql import functions as F

from hypothesis import given, settings
from hypothesis import strategies as st

from patchlode.functions import text as T
from patchlode.functions.patterns import snippet_terms
from patchlode.functions.rules import SINK_RULES, SOURCE_RULES


def one(spark, schema, rows, column):
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], f"n int, {schema}")
    found = df.select("n", column.alias("r")).collect()
    return [r.r for r in sorted(found, key=lambda r: r.n)]


def test_line_slice(spark):
    code = "a\n b\nc\n\n d \n"
    cases = [
        ((code, 1, 1), "a"),
        ((code, 2, 3), "b\nc"),
        ((code, 0, 2), "a\n b"),
        ((code, -5, 1), "a"),
        ((code, 4, 99), "d"),
        ((code, 3, 2), ""),
        ((code, 7, 9), ""),
        ((code, 1, 0), ""),
        (("", 1, 1), ""),
        ((None, 1, 1), ""),
        ((code, None, 1), ""),
        ((" x ", 1, 1), "x"),
    ]
    slice_ = T.line_slice(F.col("t"), F.col("s"), F.col("e"))
    got = one(spark, "t string, s int, e int", [c for c, _ in cases], slice_)
    assert got == [want for _, want in cases]


def test_commit_link_and_urls(spark):
    rows = [
        ("https://github.com/o/r.git", "ab"),
        ("https://github.com/o/r", "ab"),
        ("https://gitlab.com/o/r", "ab"),
        ("https://github.com/o/r", ""),
        (None, "ab"),
    ]
    got = one(spark, "u string, h string", rows, T.commit_link(F.col("u"), F.col("h")))
    assert got == ["https://github.com/o/r/commit/ab"] * 2 + ["", "", ""]
    urls = [
        ("https://github.com/o/r/blob/0aF9/p/X.java",),
        ("https://github.com/o/r/blob/dev/X.java",),
        ("https://github.com/o/r/blob/main/X.java",),
    ]
    assert one(spark, "u string", urls, T.raw_url(F.col("u"))) == [
        "https://raw.githubusercontent.com/o/r/HEAD/p/X.java",
        "https://raw.githubusercontent.com/o/r/HEADv/X.java",  # "de" reads as a hash
        "https://raw.githubusercontent.com/o/r/blob/main/X.java",
    ]
    assert one(spark, "u string", [("a/b c.ä-1_X",)], T.safe_name(F.col("u"))) == ["a_b_c._-1_X"]


def plain_snippet(text, terms, k=3):
    """Brute force: mark, widen, print."""
    lines = text.split("\n")
    near = {
        j
        for i, line in enumerate(lines)
        if any(t.lower() in line.lower() for t in terms)
        for j in range(max(0, i - k), min(len(lines), i + k + 1))
    }
    out, last = [], None
    for j in sorted(near):
        if last is not None and j - last > 2 * k + 1:
            out.append("...")
        out.append(lines[j])
        last = j
    return "\n".join(out)


def test_snippet_gaps(spark):
    def gap(n):
        return "x\n" * 4 + "hit\n" + "y\n" * n + "HIT\nz"

    texts = ["", "none", "hit", *[gap(n) for n in (0, 3, 6, 7, 12, 13, 14, 20)]]
    terms = F.array(F.lit("Hit"), F.lit("zzz"))
    got = one(spark, "t string", [(t,) for t in texts], T.snippet(F.col("t"), terms))
    assert got == [plain_snippet(t, ["hit", "zzz"]) for t in texts]
    # Kept lines 7 apart are joined without a mark, 8 apart get one.
    assert "..." not in got[texts.index(gap(12))]
    assert "\n...\n" in got[texts.index(gap(13))]


@settings(max_examples=1, deadline=None)
@given(st.data())
def test_snippet_random(spark, data):
    line = st.sampled_from(["a", "b", "", "hit", "x hit y", "Other"])
    texts = ["\n".join(data.draw(st.lists(line, max_size=40))) for _ in range(60)]
    terms = F.array(F.lit("hit"), F.lit("OTHER"))
    for k in (0, 1, 3):
        got = one(spark, "t string", [(t,) for t in texts], T.snippet(F.col("t"), terms, k))
        assert got == [plain_snippet(t, ["hit", "other"], k) for t in texts]


def test_snippet_terms(spark):
    queries = [
        ("getParameter AND println OR response.getWriter NOT escapeHtml",),
        ("a NOT bb language:java",),
    ]
    assert one(spark, "q string", queries, snippet_terms(F.col("q"))) == [
        ["getParameter", "AND", "println", "response.getWriter", "escapeHtml"],
        ["java"],
    ]


def test_rule_catalogue():
    assert len(SOURCE_RULES) == 33 and len(SINK_RULES) == 34
    assert len({r.rule_id for r in (*SOURCE_RULES, *SINK_RULES)}) == 67
    for rule in (*SOURCE_RULES, *SINK_RULES):
        assert rule.anchor and rule.anchor in rule.shape.lower()


def test_snippets_by_line_frames(spark):
    """Frames over single lines, also over pieces of a few lines, give what the array form gives."""
    import random

    from patchlode.functions.text import snippet
    from patchlode.operators.corpus import line_snippets

    rng = random.Random(5)
    rows = [(n, "\n".join(rng.choice(["Hit one", "", "x", "y", "z", "w"][: 1 + rng.randrange(6)] or ["x"]) if rng.random() < 0.2 else "plain"
             for _ in range(rng.randrange(1, 90)))) for n in range(60)]
    rows += [(100, None), (101, ""), (102, "hit"), (103, "\n\nHIT\n"), (104, "\n".join("hit" if i % 8 == 0 else "q" for i in range(100)))]
    df = spark.createDataFrame(rows, "id int, content string")
    terms = F.array(F.lit("hit"), F.lit("X"))
    want = {r.id: r.s for r in df.select("id", snippet(F.col("content"), terms).alias("s")).collect() if r.s}
    for piece in (1, 5, 17, 10_000):
        got = {r.id: r.code_snippet for r in line_snippets(df, ("id",), terms, piece=piece).collect()}
        assert got == want, piece


def test_snippet_of_a_file_of_two_million_lines(spark):
    from patchlode.operators.corpus import line_snippets

    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2_000_000)), lambda i: F.when(i % 500_000 == 0, F.concat(F.lit("needle "), i)).otherwise("x")), "\n")
    df = spark.range(1).select("id", text.alias("content"))
    found = line_snippets(df, ("id",), F.array(F.lit("needle"))).first().code_snippet.split("\n")
    assert [line for line in found if "needle" in line] == [f"needle {n}" for n in (500_000, 1_000_000, 1_500_000, 2_000_000)]
    assert found.count("...") == 3 and len(found) == 3 * 7 + 4 + 3
