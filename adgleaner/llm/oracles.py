"""SQL that DuckDB runs on the same tables, where SQL can say what a query returns.

Without: op1 (`kept` comes from quantile sketches), op2 (needs bytes that stay),
op4 (needs positions of matches), op5 and op8 (training), op6 (packing). These are
tested against plain versions in tests/llm.
"""

from adgleaner.llm.licence_texts import KNOWN, SAME_WORD


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    plain = f"regexp_replace(coalesce({text}, ''), '^[^a-z0-9\\n]*(copyright|copr\\.|\\(c\\)|©)[^\\n]*$', '', 'gim')"
    spaced = f"replace(' ' || trim(regexp_replace(lower({plain}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' ', ' ', '  ')"
    for variant, compared in SAME_WORD:
        a, b = f" {variant} ".replace(" ", "  "), f"  {compared}  "
        spaced = f"replace({spaced}, {_quoted(a)}, {_quoted(b)})"
    return f"trim(replace({spaced}, '  ', ' '))"


_KNOWN_ROWS = ",\n".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in KNOWN)

LICENCES = f"""
WITH known AS (
  SELECT sha256({_canonical("t")}) AS digest, min(licence) AS licence
  FROM (VALUES {_KNOWN_ROWS}) AS k(licence, t) GROUP BY 1
), whole AS (
  SELECT doc_id, sha256({_canonical("text")}) AS digest FROM documents
), lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), notices AS (
  SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices, count(*) AS n
  FROM (SELECT doc_id, sha256({_canonical("line")}) AS digest FROM lines) JOIN known USING (digest)
  GROUP BY doc_id
)
SELECT w.doc_id, w.digest AS text_digest, k.licence AS whole_licence,
       coalesce(notices, '') AS notices, coalesce(n, 0) AS n_notices
FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN notices n ON n.doc_id = w.doc_id
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS digest
  FROM pages
), last AS (
  SELECT digest, max(page_id) AS last FROM p WHERE size >= 1000 GROUP BY digest
)
SELECT page_id, size AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN last > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last > page_id THEN last END AS refers_to
FROM p LEFT JOIN last ON last.digest = p.digest AND size >= 1000
"""

_SHINGLES = """CASE
      WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"""

JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest({_SHINGLES}) AS g FROM words
), size AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT x, y FROM shared JOIN size nx ON nx.doc_id = x JOIN size ny ON ny.doc_id = y
  WHERE 100 * c >= 75 * (nx.n + ny.n - c)
), edge AS (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach(node, other) AS (
  SELECT x, y FROM edge UNION SELECT r.node, e.y FROM reach r JOIN edge e ON r.other = e.x
), least AS (
  SELECT node, min(other) AS least FROM reach GROUP BY node
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(least.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN least ON least.node = d.doc_id
"""


def _plain_words(table: str, key: str) -> str:
    return (
        f"SELECT {key}, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), "
        f"lambda x: x <> '') AS w FROM {table}"
    )


DECONTAMINATION = f"""
WITH i AS (
  SELECT DISTINCT item_id, unnest({_SHINGLES}) AS g FROM ({_plain_words("benchmark", "item_id")})
), d AS (
  SELECT DISTINCT doc_id, unnest({_SHINGLES}) AS g FROM ({_plain_words("documents", "doc_id")})
), size AS (
  SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id
), shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (g) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shared, n_item FROM shared JOIN size USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""

EARLIER_PASSAGES = r"""
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), places AS (
  SELECT r, doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM cut
), windows AS (
  SELECT r, doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS w FROM places WHERE i + 49 <= len(ws)
), least AS (
  SELECT w, min(doc_id) AS owner FROM windows GROUP BY w
), begun AS (
  SELECT r, i FROM windows JOIN least USING (w) WHERE owner < doc_id
), judged AS (
  SELECT p.r, p.i, p.ws[p.i] AS word,
         coalesce(max(b.i) OVER (PARTITION BY p.r ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM places p LEFT JOIN begun b ON p.r = b.r AND p.i = b.i
), kept AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS text
  FROM judged GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM cut LEFT JOIN kept k USING (r)
"""

_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

SEARCH = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS ts FROM documents
), q AS (
  SELECT item_id, t, count(*) AS often
  FROM (SELECT item_id, unnest({_TERMS}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, t
), whole AS (
  SELECT count(*) AS n, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0
), tf AS (
  SELECT r, doc_id, len(ts) AS n, t, count(*) AS tf
  FROM (SELECT r, doc_id, ts, unnest(ts) AS t FROM d) GROUP BY r, doc_id, ts, t
), df AS (
  SELECT t, count(*) AS df FROM tf GROUP BY t
), w AS (
  SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, whole
), scored AS (
  SELECT q.item_id, tf.r, tf.doc_id,
         sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * tf.n * whole.n) // whole.l))))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN w USING (t), whole GROUP BY q.item_id, tf.r, tf.doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

TRIE = """
WITH RECURSIVE bits(b, i, v) AS (
  SELECT b, 0, b FROM range(256) t(b)
  UNION ALL
  SELECT b, i + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE i < 8
), crc_table AS (
  SELECT b, v FROM bits WHERE i = 8
), ids AS (
  SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL
), crc(c, k, v) AS (
  SELECT c, 0, 4294967295 FROM ids
  UNION ALL
  SELECT c, k + 1, xor(crc_table.v, crc.v >> 8) FROM crc
  JOIN crc_table ON crc_table.b = xor(crc.v & 255, ascii(substr(c::VARCHAR, k + 1, 1))) WHERE k < length(c::VARCHAR)
), h AS (
  SELECT c, xor(v, 4294967295) % 6 AS h FROM crc WHERE k = length(c::VARCHAR)
), turns AS (
  SELECT conv_id AS c, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS ts
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
  SELECT t.c, list_concat(coalesce(b.ts[1:h.h], []), t.ts[h.h + 1:]) AS ts
  FROM turns t JOIN h ON h.c = t.c LEFT JOIN turns b ON b.c = t.c - t.c % 100
), steps AS (
  SELECT c, len(ts) AS length, d, ts[1:d] AS p, CASE WHEN d = 0 THEN 0 ELSE length(ts[d].text) END AS size
  FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE length = d), '')) AS ends_sha256
  FROM steps GROUP BY p, d
), tied AS (
  SELECT n.*, up.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes up ON n.d > 0 AND up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
), children AS (
  SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n FROM tied WHERE d > 0 GROUP BY 1, 2
), weighed AS (
  SELECT t.*, coalesce(n, 0) AS n_children FROM tied t LEFT JOIN children ch ON ch.conv_id = t.conv_id AND ch.d = t.d
), sums AS (
  SELECT a.p, a.d, sum((b.n_children = 0)::BIGINT) AS n_leaves, sum((b.n_convs - 1) * b.size) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM weighed) b JOIN nodes a ON a.d = b.k AND a.p = b.p[1:b.k] GROUP BY a.p, a.d
)
SELECT w.conv_id, w.d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM weighed w JOIN sums s ON s.p = w.p AND s.d = w.d
"""

ORACLES = {
    "op3_licences": LICENCES,
    "op7_warc": WARC,
    "op9_jaccard_join": JACCARD,
    "op10_decontamination": DECONTAMINATION,
    "op11_prefix_trees": EARLIER_PASSAGES,
    "op12_prefix_trie": TRIE,
    "op13_mask_search": SEARCH,
}
