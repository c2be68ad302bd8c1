"""Fix-database tables derived from the star-schema tables, as SQL both engines can run.

One text serves Spark (over temp views) and the SQL check. Rules that keep it portable: no
backslash in a literal, ``~`` for a line feed in code templates, ``floor`` before a cast to BIGINT.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..session import stage, stage_path

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# (id, weakness, method before the fix, method after the fix); "~" stands for a line feed.
TEMPLATES = (
    (0, "CWE-79",
     'void f(HttpServletRequest request, PrintWriter out) {~  String a = request.getParameter("q");'
     '~  String b = "hi " + a;~  out.println(b);~}',
     'void f(HttpServletRequest request, PrintWriter out) {~  String a = request.getParameter("q");'
     '~  String b = "hi " + a;~  out.println(StringEscapeUtils.escapeHtml(b));~}'),
    (1, "CWE-22",
     'byte[] f(HttpServletRequest request) {~  String p = request.getParameter("file");'
     '~  File target = new File(p);~  return Files.readAllBytes(target.toPath());~}',
     'byte[] f(HttpServletRequest request) {~  String p = request.getParameter("file");'
     '~  File target = new File(p);'
     '~  if (!target.getCanonicalPath().startsWith(base)) throw new Error();'
     '~  return Files.readAllBytes(target.toPath());~}'),
    (2, "CWE-89",
     'void f(HttpServletRequest request) {~  String id = request.getParameter("id");'
     '~  String sql = "select * from t where id=" + id;~  stmt.executeQuery(sql);~}',
     'void f(HttpServletRequest request) {~  String id = request.getParameter("id");'
     '~  PreparedStatement ps = conn.prepareStatement("select * from t where id=?");'
     '~  ps.setString(1, id);~}'),
    (3, "",
     "int f(int x) {~  int y = x + 1;~  return y;~}",
     "int f(int x) {~  return x + 2;~}"),
    (4, "CWE-79",
     "void f(@RequestParam String a, @RequestParam String b) {~  log(b);~  out.print(b);~}",
     "void f(@RequestParam String a, @RequestParam String b) {~  log(b);"
     "~  out.print(sanitize(b));~}"),
    (5, "NVD-CWE-noinfo",
     'void f(HttpServletRequest request) { String a = request.getParameter("x"); out.print(a);~}',
     "void f(HttpServletRequest request) { return;~}"),
    (6, "NVD-CWE-noinfo",
     'void f(HttpServletRequest request) {~  String a = request.getHeader("h");~  b1 = a;'
     "~  b2 = b1;~  b3 = b2;~  b4 = b3;~  b5 = b4;~  b6 = b5;~  pad();~  log(b6);"
     "~  out.write(b6);~}",
     "void f(HttpServletRequest request) {~  pad();~}"),
    (7, "CWE-502",
     "Object f(HttpServletRequest request) {~  ObjectInputStream in = open(request);"
     "~  Object o = in.readObject();~  audit(o);~  Object q = in.readObject();~  return q;~}",
     "Object f(HttpServletRequest request) {~  ObjectInputStream in = open(request);"
     "~  in.setObjectInputFilter(flt);~  return in.readObject();~}"),
)


# What stands where a source shape needs more than the call: by source type.
SOURCE_ENDS = {"newFile": "p)", "fileParam": '"path"', "fileHeader": '"X-Path"', "args": "0]"}
RULE_WEAKNESSES = ("NVD-CWE-noinfo", "CWE-79", "CWE-22", "CWE-502")


def _call(shape: str) -> str:
    """The shortest usual text of a call shape."""
    return "".join({" ": "", "~": " ", "*": "", "…": " x = y"}.get(c, c) for c in shape)


def _rule_templates() -> tuple[tuple[int, str, str, str], ...]:
    """One method per measure, with each source, sink and measure of the catalogue in at least one of them."""
    measures = [shape for shapes in R.SECURITY_MEASURES.values() for shape in shapes]
    rows = []
    for n, measure in enumerate(measures):
        source, sink = R.SOURCE_RULES[n % len(R.SOURCE_RULES)], _call(R.SINK_RULES[n % len(R.SINK_RULES)].shape)
        if source.kind == "annotation":
            head = f"void f({source.shape} String u, {source.shape} String v) {{"
        else:
            end = SOURCE_ENDS.get(source.type, '"q")')
            head = f"void f(HttpServletRequest request, Input y) {{~  String v = {_call(source.shape)}{end};"
        body = f"~  String w = v;~  keep(w);~  x{sink if sink[0] == '.' else ' ' + sink}"
        # a source without a weakness of its own is looked for with all categories
        cwe = RULE_WEAKNESSES[n % 4] if source.category == "http" else "NVD-CWE-noinfo"
        rows.append((len(TEMPLATES) + n, cwe, f"{head}{body};~}}", f"{head}~  {_call(measure)};{body};~}}"))
    return tuple(rows)


RULE_TEMPLATES = _rule_templates()
# Two thirds of the parts have a hand-written method, the others one of the catalogue.
TEMPLATE_OF = f"CASE WHEN pk % 3 = 0 THEN {len(TEMPLATES)} + CAST(floor(pk / 3) AS BIGINT) % {len(RULE_TEMPLATES)} ELSE pk % {len(TEMPLATES)} END"


def _template_rows() -> str:
    return ",\n".join(f"({t}, '{cwe}', '{old}', '{new}')" for t, cwe, old, new in TEMPLATES + RULE_TEMPLATES)


FIXTURE_SQL: dict[str, str] = {
    "fx_line": """
        SELECT l_orderkey AS ok, l_linenumber AS ln, min(l_partkey) AS pk, min(l_suppkey) AS sk,
               min(l_quantity) AS qty
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "fx_repo": """
        SELECT s_suppkey AS sk,
               'https://' || CASE WHEN s_suppkey % 5 = 4 THEN 'gitlab.com' ELSE 'github.com' END
                 || '/org' || CAST(s_suppkey % 7 AS STRING)
                 || '/repo' || CAST(s_suppkey AS STRING)
                 || CASE WHEN s_suppkey % 3 = 0 THEN '.git' ELSE '' END AS repo_url,
               CAST(floor(greatest(s_acctbal, 0) / 10) AS BIGINT) AS stars_count
        FROM supplier""",
    "fx_tmpl": f"""
        SELECT tid, cwe_id,
               replace(m_before, '~', chr(10)) AS m_before,
               replace(m_after, '~', chr(10)) AS m_after,
               length(m_before) - length(replace(m_before, '~', '')) + 1 AS nl
        FROM (VALUES {_template_rows()}) AS t(tid, cwe_id, m_before, m_after)""",
    "fixes": """
        SELECT 'CVE-' || CAST(2000 + pk % 25 AS STRING) || '-' || CAST(pk AS STRING) AS cve_id,
               md5(CAST(ok AS STRING)) AS hash, repo_url,
               CASE ln WHEN 1 THEN 'CPE_GIT_REPOBASED' WHEN 2 THEN 'NVD_GIT_REPOBASED'
                       WHEN 3 THEN 'CPE_DIRECT_COMMIT' WHEN 4 THEN 'GHSD_GIT_REPOBASED'
                       WHEN 5 THEN 'CPE_GITHUB_SEARCH' WHEN 6 THEN 'NVD_DIRECT_COMMIT'
                       ELSE 'GHSD_REGISTRY' END AS rel_type,
               CAST(floor(qty * 2) AS BIGINT) AS score,
               'NOT_STARTED' AS extraction_status
        FROM fx_line JOIN fx_repo ON fx_line.sk = fx_repo.sk""",
    "commits": """
        SELECT md5(CAST(ok AS STRING)) AS hash, repo_url,
               'fix ' || CAST(ok AS STRING) AS msg, o_orderdate AS author_date,
               CASE o_orderpriority WHEN '1-URGENT' THEN TRUE WHEN '5-LOW' THEN NULL
                    ELSE FALSE END AS merge
        FROM (SELECT DISTINCT ok, sk FROM fx_line) AS l
        JOIN fx_repo ON l.sk = fx_repo.sk
        JOIN orders ON o_orderkey = ok""",
    "file_change": """
        SELECT CAST(ok * 10 + ln AS STRING) AS file_change_id, md5(CAST(ok AS STRING)) AS hash,
               CASE pk % 11 WHEN 0 THEN 'src/FooTest.java' WHEN 1 THEN 'src/latest.java'
                    WHEN 2 THEN NULL ELSE 'src/File' || CAST(pk AS STRING) || '.java' END AS filename,
               CASE pk % 5 WHEN 0 THEN 'java' WHEN 1 THEN 'JAVA' WHEN 4 THEN 'Go' ELSE 'Java' END
                 AS programming_language,
               CASE WHEN ok % 13 = 0 THEN 'None' WHEN ok % 13 = 1 THEN NULL
                    ELSE 'class A {' || chr(10) || m_before || chr(10) || '}' || chr(10) END
                 AS code_before,
               CASE WHEN ok % 17 = 0 THEN NULL
                    ELSE 'class A {' || chr(10) || m_after || chr(10) || '}' || chr(10) END
                 AS code_after,
               CASE WHEN ok % 19 = 0 THEN '' WHEN ok % 19 = 1 THEN NULL
                    ELSE '@@ ' || CAST(ok * 10 + ln AS STRING) END AS diff,
               CASE pk % 6 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN NULL
                    WHEN 3 THEN CAST(ln AS STRING) ELSE CAST(ln AS STRING) || '.0' END AS complexity
        FROM fx_line JOIN fx_tmpl ON tid = template_of(pk)""",
    "method_change": """
        SELECT CAST(ok * 10 + ln AS STRING) || '-' || sfx AS method_change_id,
               CAST(ok * 10 + ln AS STRING) AS file_change_id,
               'f' AS name, 'f( request )' AS signature,
               CASE sfx WHEN 'b' THEN m_before ELSE m_after END AS code,
               CASE (ok * 10 + ln) % 23 WHEN 0 THEN '2.0' WHEN 1 THEN NULL ELSE '2' END
                 AS start_line,
               CAST(nl + 1 AS STRING) AS end_line, before_change
        FROM fx_line JOIN fx_tmpl ON tid = template_of(pk)
        CROSS JOIN (VALUES ('b', 'True'), ('a', 'False')) AS s(sfx, before_change)""",
    "cwe": """
        SELECT * FROM (VALUES
          ('CWE-79', 'Cross-site scripting', 'Input reaches a page unescaped'),
          ('CWE-22', 'Path traversal', 'Input names a file'),
          ('CWE-89', 'SQL injection', 'Input becomes part of a statement'),
          ('CWE-502', 'Deserialization of untrusted data', 'Input is deserialized'),
          ('NVD-CWE-noinfo', 'Insufficient information', 'Not known'),
          ('CWE-20', CAST(NULL AS STRING), 'Input is not checked')
        ) AS c(cwe_id, cwe_name, description)""",
    "cwe_classification": """
        SELECT DISTINCT cve_id, cwe_id
        FROM (SELECT DISTINCT pk,
                'CVE-' || CAST(2000 + pk % 25 AS STRING) || '-' || CAST(pk AS STRING) AS cve_id
              FROM fx_line JOIN fx_repo ON fx_line.sk = fx_repo.sk) AS p
        JOIN fx_tmpl ON tid = template_of(pk) WHERE cwe_id <> ''
        UNION ALL
        SELECT DISTINCT 'CVE-' || CAST(2000 + pk % 25 AS STRING) || '-' || CAST(pk AS STRING),
               'CWE-20'
        FROM fx_line JOIN fx_repo ON fx_line.sk = fx_repo.sk WHERE pk % 6 = 0
        UNION ALL
        SELECT DISTINCT 'CVE-' || CAST(2000 + pk % 25 AS STRING) || '-' || CAST(pk AS STRING),
               'NVD-CWE-noinfo'
        FROM fx_line JOIN fx_repo ON fx_line.sk = fx_repo.sk WHERE pk % 9 = 0""",
    "repository": """
        SELECT repo_url, stars_count, 'Java' AS repo_language,
               'org' || CAST(sk % 7 AS STRING) AS owner
        FROM fx_repo""",
    "cve": """
        SELECT DISTINCT
               'CVE-' || CAST(2000 + pk % 25 AS STRING) || '-' || CAST(pk AS STRING) AS cve_id,
               CAST(2000 + pk % 25 AS STRING) || '-03-01T05:00Z' AS published_date,
               CASE pk % 4 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HIGH'
                    ELSE 'CRITICAL' END AS severity,
               '[{"url":"https://example.org/' || CAST(pk AS STRING) || '"}]' AS reference_json
        FROM fx_line""",
    "cve_project": """
        SELECT DISTINCT cve_id AS cve, repo_url AS project_url, rel_type FROM fixes""",
    "cve_cpe_mapper": """
        SELECT DISTINCT
               'CVE-' || CAST(2000 + pk % 25 AS STRING) || '-' || CAST(pk AS STRING) AS cve_id,
               'cpe:2.3:a:v' || CAST(pk % 50 AS STRING) || ':p' || CAST(pk AS STRING) AS cpe_name
        FROM fx_line""",
    "cpe_project": """
        SELECT DISTINCT 'cpe:2.3:a:v' || CAST(pk % 50 AS STRING) || ':p' || CAST(pk AS STRING)
                 AS cpe_name, repo_url, 'GIT_REPOBASED' AS rel_type
        FROM fx_line JOIN fx_repo ON fx_line.sk = fx_repo.sk""",
    "corpus_text": """
        SELECT source AS repo, 'd' || CAST(doc_id AS STRING) || '.txt' AS path, lang,
               text AS content
        FROM documents""",
    "corpus_code": """
        SELECT repo_url AS repository, 'f' || CAST(ok * 10 + ln AS STRING) || '/' || filename AS path,
               lower(programming_language) AS lang, code_before AS content
        FROM (SELECT ok, ln, sk FROM fx_line) AS l
        JOIN fx_repo ON l.sk = fx_repo.sk
        JOIN file_change ON file_change_id = CAST(ok * 10 + ln AS STRING)
        WHERE code_before IS NOT NULL AND filename IS NOT NULL""",
    "hits": """
        SELECT 0 AS query_ord, event_id AS hit_ord, 'repo' || CAST(user_id AS STRING) AS repository,
               event_type AS path, value
        FROM events""",
}


FIXTURE_SQL = {name: text.replace("template_of(pk)", TEMPLATE_OF) for name, text in FIXTURE_SQL.items()}


def with_sql(final: str, *registries: Mapping[str, str]) -> str:
    """``final`` preceded by the named tables it needs, directly or through others, in order."""
    tables = {**FIXTURE_SQL}
    for more in registries:
        tables.update(more)
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in tables:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(tables[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final
    ctes = ",\n".join(f"{name} AS ({tables[name]})" for name in needed)
    return f"WITH {ctes}\n{final}"


# Derived without a shuffle: as many partitions as the input has.
ROW_BY_ROW = ("corpus_text", "hits")
# A row of fx_line and one of the few templates make each row of these: reading them from there costs less than writing all their columns.
VIEWS = ("file_change", "method_change")
# The same with a row of fx_repo.
REPO_VIEWS = ("fixes",)
T = TypeVar("T")
_STAGED: dict[tuple[str, str, int, str], object] = {}
_FOLDERS: dict[tuple[str, str, int, str], str] = {}


class Tables:
    """The tables of one data folder: those given, and those derived from them.

    A derived table is written once per session to the shared folder of the session and read
    from there, as a real fix database would be, so that filters and column choices reach the
    scan and no query repeats the derivation. ``VIEWS`` and ``REPO_VIEWS`` are not written: a query makes the columns that
    it reads from the written lines.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in FIXTURE_SQL:
            raise AttributeError(name)
        if name in VIEWS + REPO_VIEWS:
            return self.kept(name, lambda: self._derive(name))
        return self.staged(name, lambda: self._derive(name))

    def kept(self, name: str, build: Callable[[], T]) -> T:
        """What is kept under this name, built now if this session has not done so; rows of a table that is not written are made when read."""
        app = self.spark.sparkContext.applicationId
        key = (app, self.sf_dir, _changed_at(self.spark, self.sf_dir), name)
        if key not in _STAGED:
            _STAGED[key] = build()
        return _STAGED[key]

    def staged(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table staged under this name, built now if this session has not done so."""
        return self.kept(name, lambda: stage(build(), name))

    def staged_folder(self, name: str, write: Callable[[str], object]) -> str:
        """A folder written under this name, now if this session has not done so."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, _changed_at(self.spark, self.sf_dir), name)
        if key not in _FOLDERS:
            path = stage_path(self.spark, name)
            write(path)
            _FOLDERS[key] = path
        return _FOLDERS[key]

    def _code_files(self) -> DataFrame:
        """``corpus_code`` as its SQL has it, but lines of files and of repositories meet by number before a text is made, so no code is shuffled.

        ``fx_line`` has each (ok, ln) once. While ``ln`` is one digit, no two lines share a file's number, and a line meets itself alone.
        """
        lines = self.fx_line.withColumn("file", F.expr("ok * 10 + ln"))
        if lines.filter("ln NOT BETWEEN 0 AND 9").isEmpty():
            met = lines.filter("file IS NOT NULL").select("file", "ok", "ln", "pk", "sk")
        else:
            met = lines.select("file", "ok", "ln", "pk").join(lines.select("file", "sk"), "file")
        met.join(self.fx_repo.select("sk", "repo_url"), "sk").createOrReplaceTempView("code_lines")
        self.fx_tmpl.createOrReplaceTempView("fx_tmpl")
        files = FIXTURE_SQL["file_change"].replace("SELECT", "SELECT repo_url,", 1).replace("fx_line", "code_lines")
        return self.spark.sql(f"""
            SELECT repo_url AS repository, 'f' || file_change_id || '/' || filename AS path,
                   lower(programming_language) AS lang, code_before AS content
            FROM ({files}) WHERE code_before IS NOT NULL AND filename IS NOT NULL""")

    def _derive(self, name: str) -> DataFrame:
        if name == "corpus_code":
            return self._code_files()
        used = [t for t in (*BASE_TABLES, *FIXTURE_SQL) if t != name]
        for other in used:
            if re.search(rf"\b{other}\b", FIXTURE_SQL[name]):
                getattr(self, other).createOrReplaceTempView(other)
        if name == "commits":
            # The lines of an order lie together for the DISTINCT and for the join with orders.
            self.fx_line.select("ok", "sk").repartition("ok").createOrReplaceTempView("fx_line")
        table = self.spark.sql(FIXTURE_SQL[name])
        if name in ROW_BY_ROW:
            # A small input in few files would leave most cores without work.
            cores = self.spark.sparkContext.defaultParallelism
            if table.rdd.getNumPartitions() < cores:
                table = table.repartition(cores)
        return table


def _changed_at(spark: SparkSession, folder: str) -> int:
    """Newest change of a folder's tables in any file system, so that new data is never read as old."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    newest = 0
    for table in system.listStatus(path):
        newest = max(newest, table.getModificationTime())
        if table.isDirectory():
            newest = max([newest, *(f.getModificationTime() for f in system.listStatus(table.getPath()))])
    return newest
