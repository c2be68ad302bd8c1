"""SQL twins of the queries that DuckDB can express over whole tables."""

from __future__ import annotations


def _crc_table() -> str:
    """The 256 remainders of CRC-32, by its polynomial."""
    found = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ 0xEDB88320 * (value & 1)
        found.append(f"{value}::UBIGINT")
    return f"[{', '.join(found)}]"


WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

SUPER_KMERS = f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
    windows AS (SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS words
                FROM d, unnest(range(1, greatest(len(w) - 33, 1))) t(i)),
    again AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY words) > 1),
    gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM again),
    words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
    kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
             FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid)
    SELECT d.doc_id, len(d.w) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(k.words, '')) AS kept_sha256
    FROM d LEFT JOIN kept k USING (rid)"""

SHARDS = f"""
    WITH sized AS (
      SELECT doc_id, text, source, md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest,
             strlen(coalesce(text, '')) + 8 AS size,
             list_transform(list_filter(string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1,', 'g'), ','),
                                        lambda x: x <> ''), lambda x: CAST('0x' || x AS UBIGINT)) AS bytes
      FROM documents),
    summed AS (
      SELECT *, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, bytes),
                    lambda c, b: xor(c >> 8, {_crc_table()}[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) AS text_crc32
      FROM sized),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY digest, doc_id NULLS FIRST, size, text_crc32) - 1 AS r,
             count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total,
             CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS name
      FROM summed),
    placed AS (
      SELECT *, row_number() OVER (ORDER BY (2 * r + 1) / (2 * n)::DOUBLE, md5(name), name) - 1 AS place FROM ranked),
    dealt AS (SELECT *, CAST(place * 24 // total AS INTEGER) AS shard FROM placed)
    SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law, shard,
           place - (shard * total + 23) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard, source
    FROM dealt"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = f"""
    WITH RECURSIVE d AS (
      SELECT row_number() OVER () AS rid, doc_id, {WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w
      FROM documents),
    sets AS MATERIALIZED (
      SELECT DISTINCT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle FROM d),
    sizes AS (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
    links AS MATERIALIZED (
      SELECT a.rid AS a, b.rid AS b FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.rid <> b.rid
      JOIN sizes m ON m.rid = a.rid JOIN sizes n ON n.rid = b.rid
      GROUP BY a.rid, b.rid HAVING 100 * count(*) >= 75 * (any_value(m.n) + any_value(n.n) - count(*))),
    reach AS (SELECT rid, rid AS other FROM d
      UNION SELECT r.rid, l.b FROM reach r JOIN links l ON l.a = r.other),
    least AS (SELECT r.rid, min(o.doc_id) AS component_id FROM reach r JOIN d o ON o.rid = r.other GROUP BY r.rid)
    SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, l.component_id,
           coalesce(d.doc_id = l.component_id, false) AS kept
    FROM d LEFT JOIN sizes s USING (rid) JOIN least l USING (rid)"""

ARCHIVES = """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder,
             sha1(coalesce(html, '')) AS h FROM pages)
    SELECT page_id, strlen(html) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
             (CAST('0x' || substr(h, CAST(i // 8 * 10 + 1 AS BIGINT), 10) AS UBIGINT) >> CAST(35 - i % 8 * 5 AS UBIGINT)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
           CASE WHEN page_id IS DISTINCT FROM holder AND holder IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to
    FROM p"""

_CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]")
# a backslash more wherever a control string stands, with any backslashes after its first character
_ESCAPES = r"([<\[]\\*(?:<SYS>>|</SYS>>|INST\]|/INST\]|s>|/s>|ROLE\]|TEXT\]|/ROLE\]))"

CHAT = rf"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(n, r)),
    sized AS (
      SELECT *, length(text) + len(regexp_extract_all(text, '{_ESCAPES}')) AS n,
             length(role) + len(regexp_extract_all(role, '{_ESCAPES}')) AS role_n FROM t)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(n + CASE role WHEN 'system' THEN {len("<<SYS>>  <</SYS>>") + 1} WHEN 'user' THEN {len("[INST]  [/INST]") + 1}
             WHEN 'assistant' THEN {len("<s>  </s>") + 1} ELSE {len("[ROLE]  [TEXT]  [/ROLE]") + 1} + role_n END) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id"""

RESAMPLING = rf"""
    WITH texts AS (
      SELECT 'd' AS kind, row_number() OVER () AS rid, doc_id, text FROM documents
      UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
    words AS (
      SELECT kind, rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM texts),
    grams AS (
      SELECT kind, rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS gram FROM words),
    counted AS MATERIALIZED (SELECT kind, rid, gram, count(*) AS n FROM grams GROUP BY ALL),
    hashed AS MATERIALIZED (
      SELECT gram, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
        list_transform(list_filter(string_split(regexp_replace(hex(encode(gram)), '(..)', '\1,', 'g'), ','), lambda x: x <> ''),
                       lambda x: CAST('0x' || x AS UBIGINT))),
        lambda c, b: xor(c >> 8, {_crc_table()}[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) % 10000 AS bucket
      FROM (SELECT DISTINCT gram FROM counted)),
    sums AS (
      SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (kind = 'b'), 0)::DOUBLE AS t
      FROM counted JOIN hashed USING (gram) GROUP BY bucket),
    gained AS (
      SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM sums),
    weights AS (
      SELECT rid, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
      FROM counted JOIN hashed USING (gram) JOIN gained USING (bucket) WHERE kind = 'd' GROUP BY rid),
    scored AS (
      SELECT d.rid, d.doc_id, len(d.w) >= 20 AS eligible, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 8)
               AS UBIGINT) + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score
      FROM words d LEFT JOIN weights USING (rid) WHERE d.kind = 'd'),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST) AS place,
             count(*) FILTER (eligible) OVER () AS n FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= 25 * n // 100 THEN place END AS rank FROM placed"""


def _vector_codes(rounds: int = 4) -> str:
    """Each round is two tables: the entry of every part, and the codebooks after it. Whole numbers in doubles are exact."""
    parts = ["""
    kept AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
             list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v, len(embedding) // 4 AS width
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    cut AS MATERIALIZED (SELECT rid, p, v[p * width + 1:(p + 1) * width] AS v FROM kept, range(4) r(p)),
    book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, v AS c FROM cut WHERE rid <= 256)"""]
    for n in range(rounds + 1):
        parts.append(f"""
    best{n} AS MATERIALIZED (
      SELECT rid, p, min({{d: list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c), e: e}}) AS b
      FROM cut JOIN book{n} USING (p) GROUP BY rid, p)""")
        if n < rounds:
            parts.append(f"""
    mean{n} AS (
      SELECT p, e, list(m ORDER BY i) AS c FROM (
        SELECT p, b.e AS e, i, floor(sum(x) / count(*)) AS m
        FROM (SELECT cut.p, b, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM cut JOIN best{n} USING (rid, p)) GROUP BY ALL) GROUP BY p, e),
    book{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, o.c) AS c FROM book{n} o LEFT JOIN mean{n} m USING (p, e))""")
    return f"""
    WITH {",".join(parts)},
    coded AS (
      SELECT rid, string_agg(lower(printf('%02x', b.e)), '' ORDER BY p) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM best{rounds} GROUP BY rid),
    digest AS (
      SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
      FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM book{rounds}))
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (rid), digest"""


VECTOR_CODES = _vector_codes()
