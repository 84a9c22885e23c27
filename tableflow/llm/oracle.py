"""DuckDB statements of the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op1_decontamination"] = r"""
WITH lowered AS (
  SELECT 0 AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 1, item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), split AS (
  SELECT kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
), lengths AS (
  SELECT DISTINCT least(len(w), 10) AS n FROM split WHERE kind = 1 AND len(w) > 0
), item_windows AS (
  SELECT DISTINCT id AS item_id, n, array_to_string(w[i + 1:i + n], ' ') AS g
  FROM (SELECT id, w, least(len(w), 10) AS n, unnest(range(len(w) - least(len(w), 10) + 1)) AS i
        FROM split WHERE kind = 1 AND len(w) > 0)
), doc_windows AS (
  SELECT id, n, i, array_to_string(w[i + 1:i + n], ' ') AS g
  FROM (SELECT id, w, n, unnest(range(len(w) - n + 1)) AS i FROM split, lengths WHERE kind = 0 AND len(w) >= n)
), hits AS (
  SELECT d.id, d.i, d.n, m.item_id FROM doc_windows d JOIN item_windows m ON d.n = m.n AND d.g = m.g
), words_hit AS (
  SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT id, i, n FROM hits)) GROUP BY id
), items_hit AS (
  SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY id
)
SELECT s.id AS doc_id, CAST(len(s.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM split s LEFT JOIN words_hit h ON s.id = h.id LEFT JOIN items_hit m ON s.id = m.id WHERE s.kind = 0
"""


def _op2() -> str:
    """Spans by marking each match with two private-use characters and splitting there."""
    word = "|".join(["[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]", "[Pp][Aa][Ss][Ss][Ww][Dd]", "[Ss][Ee][Cc][Rr][Ee][Tt]",
                     "[Tt][Oo][Kk][Ee][Nn]", "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"])
    rules = [("assign", rf"({word})[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)", 2, 6),
             ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24),
             ("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1),
             ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1),
             ("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1)]
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(rules):
        parts.append(rf"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank,
         coalesce(list_sum(list_transform(parts[1:i - 1], lambda x: length(x))), 0) - (i - 2) AS s,
         length(string_split(parts[i], chr(57345))[1]) AS n
  FROM (SELECT doc_id, parts, unnest(range(2, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '{pattern}', chr(57344) || '\0' || chr(57345), 'g'), chr(57344)) AS parts FROM documents)
        WHERE len(parts) > 1)
  WHERE length(regexp_extract(string_split(parts[i], chr(57345))[1], '{pattern}', {group})) >= {least}""")
    return f"""
WITH spans AS ({' UNION ALL '.join(parts)}
), named AS (
  SELECT *, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT) AS span FROM spans
), per_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
         string_agg(span, ',' ORDER BY s, rank) AS spans FROM named GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id
"""


SQL["op2_secret_scan"] = _op2()

SQL["op8_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '[\\<\[]')) AS t, length(role) + len(regexp_extract_all(role, '[\\<\[]')) AS r,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns
), placed AS (
  SELECT *, sum(3 + r + 6 + t + 7) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM sized
)
SELECT conv_id, CAST(max(n) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN upto - 7 + 4 WHEN i = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

SQL["op10_substring_dedup"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, i, md5(array_to_string(w[i + 1:i + 35], ' ')) AS g
  FROM (SELECT r, w, unnest(range(len(w) - 34)) AS i FROM split WHERE len(w) >= 35)
), again AS (
  SELECT g FROM windows GROUP BY g HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows JOIN again USING (g)
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(len(w))) AS p FROM split
), kept AS (
  SELECT s.r, string_agg(s.word, ' ' ORDER BY s.p) AS t, count(*) AS n
  FROM words s LEFT JOIN gone x ON s.r = x.r AND s.p = x.p WHERE x.p IS NULL GROUP BY s.r
)
SELECT s.doc_id, CAST(len(s.w) AS BIGINT) AS n_words, CAST(len(s.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.r = k.r
"""

SQL["op5_warc_fixity"] = r"""
WITH rows AS (
  SELECT CAST(CAST(floor(page_id / 1024) AS BIGINT) AS VARCHAR) AS archive, page_id, CAST(page_id AS VARCHAR) AS record_id,
         CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6) AS BIGINT) % 101 AS pick, coalesce(url, '') AS url, coalesce(html, '') AS html
  FROM pages
), payloads AS (
  SELECT *, CASE WHEN pick = 0 THEN left(html, CAST(length(html) // 2 AS BIGINT)) || CASE WHEN substr(html, length(html) // 2 + 1, 1) = 'X' THEN 'Y' ELSE 'X' END
                 || substr(html, length(html) // 2 + 2) ELSE html END AS other FROM rows
), records AS (
  SELECT archive, page_id, record_id, pick,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || record_id || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html)
         || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS record,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || record_id || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(other)
         || chr(13) || chr(10) || chr(13) || chr(10) || other || chr(13) || chr(10) || chr(13) || chr(10) AS second
  FROM payloads
), placed AS (
  SELECT *, coalesce(sum(strlen(record)) OVER (PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM records
)
SELECT archive, CAST(pos AS BIGINT) AS offset, record_id, CASE pick WHEN 2 THEN 'missing' ELSE 'altered' END AS status, sha256(record) AS expected,
       CASE pick WHEN 0 THEN sha256(second) WHEN 1 THEN sha256(left(second, length(second) - 7)) END AS found
FROM placed WHERE pick IN (0, 1, 2)
UNION ALL
SELECT archive, CAST(pos + 1 AS BIGINT), 'stray', 'extra', NULL, sha256('stray') FROM placed WHERE pick = 3
"""
