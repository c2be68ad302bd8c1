"""SQL tables for checking: the same results by joins over the pieces of each distinct text.

Written for a SQL engine with lists and RE2 regular expressions. The analysis works on relations
(matches, edges, words), not on nested expressions, so it shares no code with the Spark side
except the rule catalogue.
"""

from __future__ import annotations

from ..functions import rules as R

LINE = "chr(10)"


def _re2(shape: str) -> str:
    parts = {" ": r"\s*", "~": r"\s+", "*": r"\w*", "…": ".*"}
    return "".join(parts.get(c) or (c if c.isalnum() else "\\" + c) for c in shape)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(rows, columns: str) -> str:
    body = ",\n".join("(" + ", ".join(r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


def _java_tail(tail: str) -> str:
    return tail.replace(r"[\w\p{L}\p{N}]", r"\w")


SOURCE_ROWS = [
    (
        str(n),
        _text(r.category),
        _text(r.type),
        _text(r.kind),
        _text(
            f"(?i){_re2(r.shape)}\\s*"
            if r.kind == "annotation"
            else f"(?i)(\\w+)\\s*=\\s*{_re2(r.shape)}{_java_tail(r.tail)}"
        ),
    )
    for n, r in enumerate(R.SOURCE_RULES, 1)
]
SINK_ROWS = [
    (str(n), _text(r.vuln_type), _text(r.name), _text("(?i)" + _re2(r.shape)))
    for n, r in enumerate(R.SINK_RULES, 1)
]
MEASURE_ROWS = [
    (str(n), _text(name), _text("(?i)" + _re2(shape)))
    for n, (name, shapes) in enumerate(R.SECURITY_MEASURES.items(), 1)
    for shape in shapes
]
CLASS_SQL = (
    "CASE upper({cwe}) WHEN 'CWE-79' THEN 'http' WHEN 'CWE-89' THEN 'http' "
    "WHEN 'CWE-22' THEN 'http+file' WHEN 'CWE-502' THEN 'http+deserialization' "
    "ELSE 'http+file+deserialization+env' END"
)
STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _offset(k: str) -> str:
    """Where match ``k`` begins: the lengths of the pieces up to it and of the matches before."""
    total = "coalesce(list_sum(list_transform({part}, lambda x: length(x))), 0)"
    return (
        f"CAST({total.format(part=f'pieces[1:{k}]')}"
        f" + {total.format(part=f'hits[1:{k} - 1]')} AS BIGINT)"
    )


def _rounds() -> dict[str, str]:
    tables = {}
    for r in range(1, R.PROPAGATION_ROUNDS + 1):
        prev = f"taint{r - 1}"
        tables[f"taint{r}"] = f"""
        SELECT code, cls, var FROM {prev}
        UNION
        SELECT t.code, t.cls, e.lhs FROM an_edges e JOIN {prev} t ON t.code = e.code
        LEFT JOIN {prev} u ON u.code = e.code AND u.cls = t.cls
          AND e.mode = 'both' AND starts_with(lower(e.rhs2), lower(u.var))
        WHERE CASE e.mode WHEN 'prefix' THEN starts_with(lower(e.rhs), lower(t.var))
                   WHEN 'both' THEN lower(e.rhs) = lower(t.var) AND u.var IS NOT NULL
                   ELSE lower(e.rhs) = lower(t.var) END
          AND NOT (e.mode = 'assign' AND e.lhs IN ('null', 'true', 'false'))"""
    return tables


def _edges(mode: str, regex: str, groups: int = 2) -> str:
    third = f"regexp_extract_all(code, '{regex}', 3)" if groups == 3 else "NULL"
    rhs2 = "r3[k]" if groups == 3 else "NULL"
    return f"""
        SELECT code, '{mode}' AS mode, r1[k] AS lhs, r2[k] AS rhs, {rhs2} AS rhs2
        FROM (SELECT code, r1, r2, r3, unnest(range(1, len(r1) + 1)) AS k
              FROM (SELECT code, regexp_extract_all(code, '{regex}', 1) AS r1,
                           regexp_extract_all(code, '{regex}', 2) AS r2, {third} AS r3
                    FROM (SELECT DISTINCT code FROM an_in)))"""


ORACLE_SQL: dict[str, str] = {
    "extract_rows": """
        SELECT f.cve_id, f.repo_url, f.hash, f.score, c.author_date, c.msg, fc.file_change_id,
               fc.filename, fc.programming_language, fc.code_before, fc.code_after, fc.diff
        FROM fixes f JOIN commits c ON c.hash = f.hash AND c.repo_url = f.repo_url
        JOIN file_change fc ON fc.hash = f.hash
        WHERE f.score >= 65 AND coalesce(fc.diff, '') <> '' AND coalesce(c.merge, FALSE) = FALSE
          AND fc.code_before IS NOT NULL AND fc.code_before <> 'None'
          AND fc.filename NOT ILIKE '%Test%' AND lower(fc.programming_language) = 'java'""",
    "class_rows": """
        SELECT cc.cve_id, cc.cwe_id, w.cwe_name
        FROM cwe_classification cc JOIN cwe w ON cc.cwe_id = w.cwe_id
        WHERE cc.cve_id IN (SELECT cve_id FROM extract_rows)""",
    "cwe_counts": """
        SELECT cwe_id, cwe_name, count(*) AS fix_count FROM class_rows
        WHERE cwe_name IS NOT NULL GROUP BY cwe_id, cwe_name HAVING count(*) > 1""",
    "method_rows": """
        SELECT DISTINCT f.cve_id, f.hash, f.repo_url, fc.file_change_id, mc.method_change_id,
               mc.name AS method_name, mc.signature, mc.code AS code_after, mc.start_line,
               mc.end_line, mc.before_change, fc.code_before AS file_code_before,
               fc.code_after AS file_code_after
        FROM file_change fc JOIN fixes f ON f.hash = fc.hash
        JOIN method_change mc ON mc.file_change_id = fc.file_change_id
        WHERE lower(fc.programming_language) = 'java' AND fc.code_before IS NOT NULL
          AND fc.code_before <> '' AND mc.start_line IS NOT NULL AND mc.end_line IS NOT NULL
          AND lower(mc.before_change) = 'true'""",
    "wanted_rows": """
        SELECT e.file_change_id, p.cwe_id, p.cwe_name, count(*) AS copies
        FROM extract_rows e
        JOIN (SELECT DISTINCT r.cve_id, n.cwe_id, n.cwe_name
              FROM class_rows r JOIN cwe_counts n ON r.cwe_id = n.cwe_id) p
          ON p.cve_id = e.cve_id
        GROUP BY e.file_change_id, p.cwe_id, p.cwe_name""",
    "cut_rows": f"""
        SELECT method_change_id, file_change_id, start_line,
               {STRIP.format(x=f"array_to_string(list_slice(string_split(code_before, {LINE}), s, e), {LINE})")}
                 AS method_code,
               coalesce({STRIP.format(x=f"array_to_string(list_slice(string_split(code_after, {LINE}), s, e), {LINE})")}, '')
                 AS method_code_after,
               code_before, code_after, hash, name, signature, diff
        FROM (SELECT mc.method_change_id, mc.file_change_id, mc.start_line, mc.name, mc.signature,
                     greatest(CAST(mc.start_line AS INT), 1) AS s, CAST(mc.end_line AS INT) AS e,
                     fc.code_before, fc.code_after, fc.hash, fc.diff
              FROM method_change mc JOIN file_change fc ON fc.file_change_id = mc.file_change_id
              WHERE lower(fc.programming_language) = 'java' AND fc.code_before IS NOT NULL
                AND fc.code_before <> '' AND lower(mc.before_change) = 'true'
                AND regexp_full_match(mc.start_line, '[0-9]+')
                AND regexp_full_match(mc.end_line, '[0-9]+'))""",
    "an_in": f"""
        SELECT DISTINCT c.method_code AS code, {CLASS_SQL.format(cwe="w.cwe_id")} AS cls
        FROM cut_rows c JOIN wanted_rows w ON w.file_change_id = c.file_change_id
        WHERE c.method_code <> ''""",
    "source_rules": _values(SOURCE_ROWS, "rid, category, type, kind, rx"),
    "sink_rules": _values(SINK_ROWS, "rid, vuln_type, sink_name, rx"),
    "measure_rules": _values(MEASURE_ROWS, "mid, measure, rx"),
    "an_sources": f"""
        SELECT code, cls, rid, type, var FROM (
          SELECT code, cls, rid, type, unnest(regexp_extract_all(code, rx, 1)) AS var
          FROM an_in JOIN source_rules ON contains(cls, category) AND kind = 'assign'
          UNION ALL
          SELECT code, cls, rid, type,
                 regexp_extract(substr(code, {_offset("k")} + length(hits[k]) + 1, 100),
                                '(?i)@\\w+\\s+\\w+\\s+(\\w+)', 1)
          FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k
                FROM (SELECT code, cls, rid, type, string_split_regex(code, rx) AS pieces,
                             regexp_extract_all(code, rx) AS hits
                      FROM an_in JOIN source_rules ON contains(cls, category)
                        AND kind = 'annotation')))
        WHERE var <> '' AND var NOT IN ('null', 'true', 'false')""",
    "an_edges": " UNION ALL ".join(
        [
            _edges("assign", r"(?i)(\w+)\s*=\s*(\w+)\s*[;,\)]"),
            _edges("prefix", r'(?i)(\w+)\s*=\s*"[^"]*"\s*\+\s*(\w+)'),
            _edges("exact", r'(?i)(\w+)\s*=\s*(\w+)\s*\+\s*"[^"]*"'),
            _edges("both", r"(?i)(\w+)\s*=\s*(\w+)\s*\+\s*(\w+)", 3),
            _edges("exact", r"(?i)(\w+)\.append\s*\(\s*(\w+)\s*\)"),
            _edges("exact", r"(?i)(\w+)\s*=\s*new\s+StringBuilder\s*\(\s*(\w+)\s*\)"),
        ]
    ),
    "taint0": "SELECT DISTINCT code, cls, var FROM an_sources",
    **_rounds(),
    "an_hits": f"""
        SELECT code, rid, vuln_type, sink_name, {_offset("k")} AS pos
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS k
              FROM (SELECT code, rid, vuln_type, sink_name,
                           string_split_regex(code, rx) AS pieces,
                           regexp_extract_all(code, rx) AS hits
                    FROM (SELECT DISTINCT code FROM an_in) CROSS JOIN sink_rules))""",
    "an_sinks": f"""
        SELECT t.code, t.cls, h.rid, h.pos, h.vuln_type, h.sink_name, min(t.var) AS source,
               min({STRIP.format(x="line")}) AS line
        FROM (SELECT *,
                array_to_string(list_slice(string_split(head, {LINE}), -2, -1), {LINE}) AS near,
                string_split(head, {LINE})[-1] || string_split(rest, {LINE})[1] AS line
              FROM (SELECT *, substr(code, 1, pos) AS head,
                           substr(code, pos + 1) AS rest FROM an_hits)
              WHERE contains(head, {LINE})
                 OR NOT contains(substr(code, 1, length(code) - 1), {LINE})) h
        JOIN taint{R.PROPAGATION_ROUNDS} t ON t.code = h.code
        WHERE list_contains(
          list_transform(regexp_extract_all(
            near || CASE WHEN regexp_matches(near, '\\w$') THEN regexp_extract(rest, '^\\w+')
                         ELSE '' END, '\\w+'), lambda w: lower(w)), lower(t.var))
        GROUP BY t.code, t.cls, h.rid, h.pos, h.vuln_type, h.sink_name""",
    "an_measures": """
        SELECT code_before, code_after, string_agg(measure, ',' ORDER BY measure) AS missing,
               list(measure ORDER BY mid) AS missing_list
        FROM (SELECT p.code_before, p.code_after, m.mid, m.measure
              FROM (SELECT DISTINCT code_before, code_after FROM cut_rows) p
              CROSS JOIN measure_rules m
              GROUP BY p.code_before, p.code_after, m.mid, m.measure
              HAVING bool_or(regexp_matches(coalesce(p.code_after, ''), m.rx))
                 AND NOT bool_or(regexp_matches(p.code_before, m.rx)))
        GROUP BY code_before, code_after""",
    "an_result": """
        SELECT i.code, i.cls, s.types, coalesce(k.names, 'unknown') AS names,
               coalesce(k.n, 0) AS n_sinks, s.n AS n_sources, k.first_sink, v.vars,
               k.flows, s.type_list, k.name_list
        FROM an_in i
        JOIN (SELECT code, cls, string_agg(DISTINCT type, ',' ORDER BY type) AS types,
                     list(DISTINCT type) AS type_list, count(*) AS n
              FROM an_sources GROUP BY code, cls) s ON s.code = i.code AND s.cls = i.cls
        LEFT JOIN (SELECT code, cls, string_agg(DISTINCT sink_name, ',' ORDER BY sink_name) AS names,
                          list(DISTINCT sink_name) AS name_list,
                          count(*) AS n, arg_min(sink_name, rid * 100000 + pos) AS first_sink,
                          string_agg(source || '>' || sink_name || '>' || line, '; '
                                     ORDER BY rid, pos) AS flows
                   FROM an_sinks GROUP BY code, cls) k ON k.code = i.code AND k.cls = i.cls
        LEFT JOIN (SELECT code, cls, string_agg(var, ',' ORDER BY var) AS vars
                   FROM taint5 GROUP BY code, cls) v ON v.code = i.code AND v.cls = i.cls""",
    "found_rows": f"""
        SELECT w.cwe_id, w.cwe_name, w.copies, c.hash, c.file_change_id, c.method_change_id,
               c.name AS method_name, c.signature, c.method_code, c.method_code_after,
               coalesce(c.diff, '') AS code_diff, r.names, r.types, r.first_sink, r.type_list,
               r.name_list, r.vars, r.flows,
               coalesce(m.missing, '') AS missing, coalesce(m.missing_list, []) AS missing_list,
               w.cwe_id || '|' || r.names || '|' || r.types AS pattern_key
        FROM cut_rows c JOIN wanted_rows w ON w.file_change_id = c.file_change_id
        JOIN an_result r ON r.code = c.method_code AND r.cls = {CLASS_SQL.format(cwe="w.cwe_id")}
        LEFT JOIN an_measures m ON m.code_before = c.code_before
          AND m.code_after IS NOT DISTINCT FROM c.code_after
        WHERE r.n_sinks > 0
          AND (w.cwe_id IN ('NVD-CWE-noinfo', 'CWE-79') OR m.missing IS NOT NULL)""",
    "counted_rows": """
        SELECT i.pattern_key, i.cwe_id, i.cwe_name, i.names AS sink_types, i.types AS source_types,
               i.missing AS missing_sanitizers, f.cve_id, i.hash, f.repo_url,
               CASE WHEN contains(f.repo_url, 'github.com')
                    THEN CASE WHEN suffix(f.repo_url, '.git')
                              THEN substr(f.repo_url, 1, length(f.repo_url) - 4)
                              ELSE f.repo_url END || '/commit/' || i.hash
                    ELSE '' END AS commit_link,
               i.method_name, i.signature, i.code_diff, i.file_change_id, i.method_change_id,
               i.copies, i.missing_list, i.type_list, i.name_list, i.first_sink,
               i.method_code, i.method_code_after, i.vars, i.flows
        FROM found_rows i
        JOIN (SELECT DISTINCT cve_id, hash, repo_url FROM fixes) f ON f.hash = i.hash""",
    "instance_rows": """
        SELECT * EXCLUDE (copies) FROM (SELECT *, unnest(range(copies)) AS n FROM counted_rows)""",
    "first_rows": """
        SELECT pattern_key, cwe_id, cwe_name, missing_list, type_list, name_list, first_sink
        FROM counted_rows
        QUALIFY row_number() OVER (PARTITION BY pattern_key
          ORDER BY hash, file_change_id, method_change_id, cve_id) = 1""",
    "source_words": _values(
        [(_text(k), _text(v)) for k, v in R.SOURCE_KEYWORDS.items()], "type, word"
    ),
    "sink_words": _values(
        [
            (_text(cwe), _text(sink), _text(word))
            for cwe, groups in R.SINK_KEYWORDS.items()
            for words, sinks in groups.items()
            for sink in sinks
            for word in words
        ],
        "cwe, sink_name, word",
    ),
    "not_words": _values(
        [
            (_text(cwe), _text(measure), _text(word), str(n))
            for cwe, measures in R.NOT_KEYWORDS.items()
            for measure, words in measures.items()
            for n, word in enumerate(words)
        ],
        "cwe, measure, word, n",
    ),
    "word_rows": """
        SELECT p.pattern_key, p.cwe_id, p.cwe_name, p.first_sink,
          (SELECT coalesce(list(DISTINCT w.word ORDER BY w.word), []) FROM source_words w
           WHERE list_contains(p.type_list, w.type)) AS src,
          (SELECT coalesce(list(DISTINCT w.word ORDER BY w.word), []) FROM sink_words w
           WHERE list_contains(p.name_list, w.sink_name) AND w.cwe = p.kw_class) AS snk,
          (SELECT coalesce(list(w.word ORDER BY list_position(p.missing_list, w.measure), w.n), [])
           FROM not_words w
           WHERE list_contains(p.missing_list, w.measure) AND w.cwe = p.kw_class) AS neg
        FROM (SELECT *, CASE WHEN cwe_id IN ('CWE-79', 'CWE-22') THEN cwe_id ELSE '' END AS kw_class
              FROM first_rows) p""",
    "query_rows": """
        SELECT pattern_key, cwe_id, cwe_name, src AS source_kw, neg AS not_kw,
          CASE WHEN len(src) + len(snk) + len(neg) = 0 THEN [first_sink] ELSE snk END AS sink_kw,
          CASE WHEN len(src) + len(snk) + len(neg) = 0 THEN first_sink
               ELSE CASE WHEN len(src) > 0 AND len(snk) > 0
                              AND array_to_string(src, ' OR ') <> array_to_string(snk, ' OR ')
                         THEN array_to_string(src, ' OR ') || ' AND ' || array_to_string(snk, ' OR ')
                         WHEN len(src) > 0 THEN array_to_string(src, ' OR ')
                         ELSE array_to_string(snk, ' OR ') END
                    || CASE WHEN len(neg) > 0 THEN ' NOT ' || array_to_string(neg, ' NOT ')
                            ELSE '' END
          END AS github_query
        FROM word_rows""",
    "queried_rows": """
        SELECT c.*, q.github_query FROM counted_rows c
        JOIN query_rows q ON q.pattern_key = c.pattern_key""",
    "report_groups": """
        SELECT 'Overall' AS category_key, 'Overall' AS category, * FROM queried_rows
        UNION ALL
        SELECT 'CWE-' || cwe_id, 'CWE-' || cwe_id, * FROM queried_rows
        UNION ALL
        SELECT 'Sink-' || sink_types, 'Sink-' || left(sink_types, 50), * FROM queried_rows
        WHERE sink_types IN (SELECT sink_types FROM queried_rows GROUP BY sink_types
                             ORDER BY sum(copies) DESC, sink_types LIMIT 10)
        UNION ALL
        SELECT 'Source-' || source_types, 'Source-' || left(source_types, 50), * FROM queried_rows
        WHERE source_types IN (SELECT source_types FROM queried_rows GROUP BY source_types
                               ORDER BY sum(copies) DESC, source_types LIMIT 10)""",
    "report_rows": """
        SELECT category, CAST(row_number() OVER (PARTITION BY category_key
                 ORDER BY instance_count DESC, github_query) AS INTEGER) AS rank,
               github_query, CAST(instance_count AS BIGINT) AS instance_count,
               unique_pattern_keys, cwe_ids,
               array_to_string(keys[1:3], ', ') AS sample_pattern_keys
        FROM (SELECT category_key, category, github_query, sum(copies) AS instance_count,
                     count(DISTINCT pattern_key) AS unique_pattern_keys,
                     string_agg(DISTINCT cwe_id, ', ' ORDER BY cwe_id) AS cwe_ids,
                     list(DISTINCT pattern_key ORDER BY pattern_key) AS keys
              FROM report_groups GROUP BY category_key, category, github_query)
        QUALIFY row_number() OVER (PARTITION BY category_key
                  ORDER BY instance_count DESC, github_query) <= 10""",
    "code_hits": """
        SELECT c.repository, c.path, q.github_query
        FROM corpus_code c JOIN (SELECT DISTINCT ON (github_query) * FROM query_rows) q
          ON (len(q.source_kw) = 0
              OR len(list_filter(q.source_kw, lambda w: contains(c.content, w))) > 0)
         AND (len(q.sink_kw) = 0
              OR len(list_filter(q.sink_kw, lambda w: contains(c.content, w))) > 0)
         AND len(list_filter(q.not_kw, lambda w: contains(c.content, w))) = 0
        WHERE c.lang = 'java'""",
    "capped_hits": """
        SELECT *, CAST(row_number() OVER (PARTITION BY github_query
                    ORDER BY repository, path) AS INTEGER) AS hit_ord
        FROM code_hits
        QUALIFY row_number() OVER (PARTITION BY github_query ORDER BY repository, path) <= 100""",
    "doc_terms": r"""
        SELECT DISTINCT path, unnest(regexp_extract_all(lower(content), '[\p{L}\p{N}_]+')) AS term
        FROM corpus_text""",
    "doc_idf": """
        SELECT term, ln((1 + (SELECT count(*) FROM corpus_text)) / (1.0 + count(*))) + 1 AS idf
        FROM doc_terms GROUP BY term""",
    "term_scores": """
        SELECT t.term, sum(i.idf / n.norm) AS score
        FROM doc_terms t JOIN doc_idf i ON i.term = t.term
        JOIN (SELECT d.path, sqrt(sum(j.idf * j.idf)) AS norm FROM doc_terms d
              JOIN doc_idf j ON j.term = d.term GROUP BY d.path) n ON n.path = t.path
        WHERE length(t.term) > 2 AND t.term NOT IN ('the', 'and')
        GROUP BY t.term""",
    "code_tokens": r"""
        SELECT repository, path,
               list_distinct(regexp_extract_all(lower(content), '[\p{L}\p{N}_]+')) AS tokens
        FROM corpus_code WHERE lang = 'java'""",
    "code_idf": """
        SELECT term, ln((1 + (SELECT count(*) FROM code_tokens)) / (1.0 + count(*))) + 1 AS idf
        FROM (SELECT unnest(tokens) AS term FROM code_tokens) GROUP BY term""",
    "code_words": """
        SELECT list(term ORDER BY round(score, 6) DESC, term)[1:5] AS w FROM (
          SELECT t.term, sum(i.idf / n.norm) AS score
          FROM (SELECT repository, path, unnest(tokens) AS term FROM code_tokens) t
          JOIN code_idf i ON i.term = t.term
          JOIN (SELECT d.repository, d.path, sqrt(sum(j.idf * j.idf)) AS norm
                FROM (SELECT repository, path, unnest(tokens) AS term FROM code_tokens) d
                JOIN code_idf j ON j.term = d.term GROUP BY d.repository, d.path) n
            ON n.repository = t.repository AND n.path = t.path
          WHERE length(t.term) > 2 GROUP BY t.term)""",
}
