"""Method texts that many files share."""

from patchlode.operators.mining import text_analyses


def test_a_text_is_analysed_once(spark):
    code = 'void f(HttpServletRequest request) {\n  String a = request.getParameter("q");\n  out.println(a);\n}'
    weaknesses = [("CWE-79", "x", 1), ("NVD-CWE-noinfo", "y", 2), ("CWE-22", "z", 1)]
    rows = [(str(n), code, weaknesses) for n in range(50)] + [("n", None, weaknesses), ("e", "", weaknesses), ("o", "int f() {}", weaknesses)]
    cut = spark.createDataFrame(
        rows, "method_change_id string, method_code string, weaknesses array<struct<cwe_id: string, cwe_name: string, copies: bigint>>")
    found = [(r["method_code"], r["cls"]) for r in text_analyses(cut).select("method_code", "cls").collect()]
    assert found and {text for text, _ in found} == {code}
    assert len(found) == len(set(found)) <= 3
