"""The queries in SQL, where SQL can express them, for DuckDB over the same tables."""

from __future__ import annotations

from tidemart.llm.licenses import TEMPLATES

ORACLES: dict[str, str] = {}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op2_decontaminate"] = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
         array_to_string(list_slice(w, s, s + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents),
places AS (
  SELECT r, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS win
  FROM (SELECT r, size, w, unnest(range(1, len(w) - size + 2)) AS s
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
hits AS (
  SELECT p.r, p.s, p.size, i.item FROM places p JOIN windows i ON p.size = i.size AND p.win = i.win),
hit_words AS (
  SELECT r, count(DISTINCT s + k) AS n_hit
  FROM (SELECT DISTINCT r, s, unnest(range(0, size)) AS k FROM hits) GROUP BY r),
named AS (
  SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN named USING (r)
"""

ORACLES["op4_neardup"] = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array({_LOWER.format("text")}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM docs),
sized AS (SELECT r, doc_id, coalesce(len(s), 0) AS n, s FROM shingles),
classes AS (
  SELECT row_number() OVER () AS c, min(doc_id) AS least, n, s
  FROM (SELECT doc_id, n, list_sort(s) AS s FROM sized WHERE n > 0) GROUP BY s, n),
rare AS (SELECT c, n, unnest(s) AS g FROM classes),
-- Only pairs that share one of their rarest shingles can be 80 % alike.
counted AS (SELECT c, n, g, count(*) OVER (PARTITION BY g) AS f FROM rare),
ranked AS (SELECT c, n, g, row_number() OVER (PARTITION BY c ORDER BY f, g) AS k FROM counted),
heads AS (SELECT c, n, g FROM ranked WHERE k <= n - CAST(ceil(0.8 * n) AS BIGINT) + 1),
pairs AS (
  SELECT DISTINCT a.c AS a, b.c AS b FROM heads a JOIN heads b ON a.g = b.g AND a.c < b.c
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
links AS (
  SELECT a, b FROM (SELECT p.a, p.b, x.n AS na, y.n AS nb, len(list_intersect(x.s, y.s)) AS i
        FROM pairs p JOIN classes x ON x.c = p.a JOIN classes y ON y.c = p.b)
  WHERE 100 * i >= 80 * (na + nb - i)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT c AS a, c AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
found AS (SELECT r.a AS c, min(k.least) AS component FROM reach r JOIN classes k ON r.b = k.c GROUP BY r.a)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles,
       CASE WHEN d.n = 0 THEN d.doc_id ELSE f.component END AS component_id,
       d.doc_id IS NOT DISTINCT FROM (CASE WHEN d.n = 0 THEN d.doc_id ELSE f.component END) AS kept
FROM sized d LEFT JOIN (classes k JOIN found f USING (c)) ON list_sort(d.s) = k.s
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_NORMAL = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
_BIGRAMS = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"

ORACLES["op1_licenses"] = f"""
WITH templates AS (
  SELECT license, {_BIGRAMS.format("w")} AS g
  FROM (SELECT license, string_split({_NORMAL.format("t")}, ' ') AS w
        FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in TEMPLATES)}) AS v(license, t))),
marked AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_replace(text, '([.!?])[ \\t]+', '\\1' || chr(1), 'g') AS b FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT r, doc_id, CAST(i AS INTEGER) - 1 AS line, string_split(b, chr(10))[i] AS l
  FROM (SELECT r, doc_id, b, unnest(range(1, len(string_split(b, chr(10))) + 1)) AS i FROM marked)),
units AS (
  SELECT r, doc_id, line, CAST(i AS INTEGER) - 1 AS sentence, string_split(l, chr(1))[i] AS u
  FROM (SELECT r, doc_id, line, l, unnest(range(1, len(string_split(l, chr(1))) + 1)) AS i FROM lines)
  UNION ALL SELECT r, doc_id, line, -1, replace(l, chr(1), ' ') FROM lines WHERE contains(l, chr(1))
  UNION ALL SELECT r, doc_id, -1, -1, replace(b, chr(1), ' ') FROM marked WHERE contains(b, chr(10))),
sets AS (
  SELECT r, doc_id, line, sentence, {_BIGRAMS.format("w")} AS g
  FROM (SELECT *, string_split({_NORMAL.format("u")}, ' ') AS w FROM units) WHERE len(w) > 1),
compared AS (
  SELECT s.*, t.license, len(t.g) AS m, len(list_intersect(s.g, t.g)) AS shared, t.g AS tg
  FROM sets s JOIN templates t ON list_has_any(s.g, t.g))
SELECT doc_id, line, sentence, license, CAST(len(g) AS INTEGER) AS n_bigrams, CAST(shared AS INTEGER) AS n_shared,
       2.0::DOUBLE * shared / (m + len(g)) AS dice
FROM compared WHERE 200 * shared >= 80 * (m + len(g))
QUALIFY row_number() OVER (PARTITION BY r, line, sentence ORDER BY 2.0::DOUBLE * shared / (m + len(g)) DESC, license, list_sort(tg)) = 1
"""

# The same captures and rules; the as-of join is a plain join with the greatest time.
ORACLES["op10_warc"] = r"""
WITH pages_ AS (
  SELECT *, md5(coalesce(html, '')) AS tag, make_timestamp((1700000000 + page_id * 60) * 1000000) AS first_at,
         make_timestamp((1700000000 + page_id * 60 + 30 + 3600 * (1 + page_id % 7)) * 1000000) AS later_at,
         strftime(make_timestamp((1700000000 + page_id * 60 - 86400) * 1000000), '%Y-%m-%d %H:%M:%S') AS changed,
         regexp_replace(trim(url), '#.*$', '') AS bare FROM pages),
split AS (
  SELECT *, regexp_replace(bare, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages_),
named AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^(?:[^/?@]*@)?([^/?]*)', 1)), '^www[0-9]*\.', ''),
         CASE WHEN starts_with(lower(bare), 'https:') THEN ':443$' ELSE ':80$' END, '') AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
         regexp_extract(rest, '\?(.*)$', 1) AS query FROM split),
canon AS (
  SELECT *, host || path || CASE WHEN query <> '' THEN '?' || array_to_string(list_sort(string_split(query, '&')), '&') ELSE '' END AS cu
  FROM named),
responses AS (
  SELECT page_id * 2 AS record_id, cu, first_at AS t, html, '"' || tag || '"' AS etag, changed,
         CAST(strlen(coalesce(html, '')) AS VARCHAR) AS size FROM canon),
revisits AS (
  SELECT page_id * 2 + 1 AS record_id, cu, later_at AS t,
         CASE WHEN page_id % 11 = 3 THEN '"other"' WHEN page_id % 5 = 0 THEN 'W/"' || tag || '"'
              WHEN page_id % 4 <> 1 THEN '"' || tag || '"' END AS etag,
         CASE WHEN page_id % 4 = 1 AND page_id % 9 <> 1 THEN changed END AS changed FROM canon),
latest AS (
  SELECT v.*, r.record_id AS rid, r.html AS rhtml, r.etag AS retag, r.changed AS rchanged, r.size AS rsize
  FROM revisits v LEFT JOIN responses r ON v.cu = r.cu AND r.t < v.t
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.t DESC NULLS LAST, r.record_id DESC) = 1),
told AS (
  SELECT *, CASE WHEN rid IS NULL THEN 'no_earlier' WHEN etag IS NULL AND changed IS NULL THEN 'no_validator'
              WHEN coalesce(CASE WHEN etag IS NOT NULL THEN regexp_replace(etag, '^W/', '') = regexp_replace(retag, '^W/', '')
                                 ELSE changed = rchanged END, false) THEN 'resolved' ELSE 'changed' END AS status FROM latest)
SELECT record_id, 'response' AS kind, cu AS canonical_url, 'full' AS status, CAST(NULL AS BIGINT) AS response_id,
       concat_ws(chr(10), 'content-length: ' || size, 'content-type: text/html',
         'date: ' || strftime(t, '%Y-%m-%d %H:%M:%S'), 'etag: ' || etag, 'last-modified: ' || changed) AS headers,
       md5(coalesce(html, '')) AS payload_md5, CAST(length(coalesce(html, '')) AS BIGINT) AS n_chars FROM responses
UNION ALL
SELECT record_id, 'revisit', cu, status, CASE WHEN status = 'resolved' THEN rid END,
       CASE WHEN status = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=60', 'content-length: ' || rsize,
         'content-type: text/html', 'date: ' || strftime(t, '%Y-%m-%d %H:%M:%S'), 'etag: ' || coalesce(etag, retag), 'last-modified: ' || rchanged)
       ELSE concat_ws(chr(10), 'cache-control: max-age=60', 'content-length: 0',
         'date: ' || strftime(t, '%Y-%m-%d %H:%M:%S'), 'etag: ' || etag, 'last-modified: ' || changed) END,
       md5(CASE WHEN status = 'resolved' THEN coalesce(rhtml, '') ELSE '' END),
       CAST(length(CASE WHEN status = 'resolved' THEN coalesce(rhtml, '') ELSE '' END) AS BIGINT) FROM told
"""

_USABLE = (
    "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
)
_WHOLE = "list_transform(embedding, lambda x: CAST(floor({} * CAST(x AS DOUBLE)) AS BIGINT))"

ORACLES["op11_topk"] = f"""
WITH v AS (SELECT DISTINCT vec_id, {_WHOLE.format(1024)} AS w FROM embeddings WHERE {_USABLE}),
scores AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_dot_product(CAST(q.w AS DOUBLE[]), CAST(v.w AS DOUBLE[])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND (q.vec_id IS DISTINCT FROM v.vec_id OR q.w <> v.w))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 10
"""


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = [
        f"""v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         {_WHOLE.format(4096)} AS w FROM embeddings WHERE {_USABLE})""",
        f"""parts AS (
  SELECT r, p, list_slice(w, p * (len(w) // {parts}) + 1, (p + 1) * (len(w) // {parts})) AS x
  FROM v, (SELECT unnest(range(0, {parts})) AS p))""",
        f"book0 AS (SELECT p, r - 1 AS entry, x AS e FROM parts WHERE r <= {entries})",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""far{k} AS (
  SELECT r, parts.p, entry, x,
         CAST(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i]))) AS BIGINT) AS d
  FROM parts JOIN book{k} ON parts.p = book{k}.p),
near{k} AS MATERIALIZED (
  SELECT r, p, entry, x, d
  FROM (SELECT *, row_number() OVER (PARTITION BY r, p ORDER BY d, entry) AS o FROM far{k}) WHERE o = 1)"""
        )
        if k < rounds:
            steps.append(
                f"""mean{k} AS (
  SELECT p, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS e
  FROM (SELECT p, entry, i, CAST(sum(x[i]) AS DOUBLE) AS s, count(*) AS n
        FROM (SELECT p, entry, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY p, entry, i)
  GROUP BY p, entry),
book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.entry, coalesce(m.e, b.e) AS e
  FROM book{k} b LEFT JOIN mean{k} m ON b.p = m.p AND b.entry = m.entry)"""
            )
    return f"""
WITH {", ".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, entry)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN v USING (r)
"""


ORACLES["op12_vectorcodes"] = _codes_sql()

ORACLES["op13_fillmiddle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
l AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
         greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (
  SELECT *, array_to_string(list_slice(u, 1, a), '') AS pre, array_to_string(list_slice(u, a + 1, b), '') AS mid,
         array_to_string(list_slice(u, b + 1, n), '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""
