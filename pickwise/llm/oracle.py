"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

#: Words of ``text``: runs of ASCII letters and digits and of all beyond ASCII, with A-Z lower-cased.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE = {
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, h, replace(replace(u, chr(13), '%0D'), chr(10), '%0A') AS u, strlen(h) AS n, sha1(h) AS s,
                     max(page_id) OVER (PARTITION BY h) AS last FROM p),
        k AS (SELECT *, n < 1000 OR page_id = last AS whole, md5(coalesce(CAST(page_id AS VARCHAR), '')) AS a,
                     md5(coalesce(CAST(last AS VARCHAR), '')) AS b, chr(13) || chr(10) AS nl FROM d),
        f AS (SELECT *, 'HTTP/1.1 200 OK' || nl || 'Content-Type: text/html; charset=utf-8' || nl || 'Content-Length: ' || n
                     || nl || nl AS http FROM k),
        r AS (SELECT *, 'WARC/1.1' || nl || 'WARC-Type: ' || CASE WHEN whole THEN 'response' ELSE 'revisit' END || nl
                || 'WARC-Record-ID: <urn:uuid:' || a[1:8] || '-' || a[9:12] || '-' || a[13:16] || '-' || a[17:20] || '-' || a[21:32]
                || '>' || nl || 'WARC-Date: 2020-01-01T00:00:00Z' || nl || 'WARC-Target-URI: ' || u || nl
                || 'Content-Type: application/http;msgtype=response' || nl || 'WARC-Payload-Digest: sha1:' || s || nl
                || 'Content-Length: ' || (strlen(http) + CASE WHEN whole THEN n ELSE 0 END) || nl
                || CASE WHEN whole THEN '' ELSE 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || nl
                   || 'WARC-Refers-To: <urn:uuid:' || b[1:8] || '-' || b[9:12] || '-' || b[13:16] || '-' || b[17:20] || '-'
                   || b[21:32] || '>' || nl END
                || nl || http || CASE WHEN whole THEN h ELSE '' END || nl || nl AS record FROM f)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, s AS payload_digest,
               CASE WHEN whole THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN whole THEN NULL ELSE last END AS refers_to,
               CAST(strlen(record) AS BIGINT) AS record_bytes, sha256(record) AS record_sha256
        FROM r""",
    "op8_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM t""",
    "op13_decontamination": f"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id,
                 {_WORDS} AS w
          FROM documents),
        i AS (
          SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
                 {_WORDS} AS w
          FROM benchmark),
        iw AS (
          SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
          FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
        dw AS (
          SELECT r, s, l, array_to_string(w[s:s + l - 1], ' ') AS win
          FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, (SELECT DISTINCT l FROM iw))),
        hits AS (SELECT DISTINCT r, s, l, win FROM dw SEMI JOIN iw USING (l, win)),
        n_hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + l)) AS p FROM hits) GROUP BY r),
        items AS (SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS digest
                  FROM (SELECT DISTINCT r, item_id FROM hits JOIN iw USING (l, win)) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n_hit USING (r) LEFT JOIN items USING (r)""",
}
