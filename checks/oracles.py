"""The same results as plain SQL for DuckDB, written without the library."""

from adgleaner.functions.text import BLANKS
from checks.ads import FIRST_FETCH

ORACLES: dict[str, str] = {}

_KEY = "sha256(lower(trim({0}, '" + BLANKS + "')))"


def _key(c: str) -> str:
    return _KEY.replace("{0}", c)


_PLAIN = (
    "regexp_replace(regexp_replace(html,"
    " '<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<!--.*?-->', '', 'gis'), '<[a-zA-Z/!?][^>]*>', '', 'gs')"
)


def _unescaped(c: str) -> str:
    for reference, character in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", "\xa0"),
        ("&copy;", "\xa9"), ("&middot;", "\xb7"), ("&amp;", "&"),
    ):
        c = f"replace({c}, '{reference}', '{character}')"
    return c


_PAGES = f"""
pages_read AS (
  SELECT page_id, replace(split_part(split_part(url, '://', 2), '/', 1), 'www.', '') AS domain,
         nullif({_unescaped("regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is')")}, '') AS title,
         {_unescaped(_PLAIN)} AS text
  FROM pages)
"""

ORACLES["page_text_by_domain"] = f"""
WITH {_PAGES}, first AS (
  SELECT *, row_number() OVER (PARTITION BY {_key("text")} ORDER BY page_id) AS turn FROM pages_read
  WHERE text <> '' AND NOT contains(text, 'Not found') AND NOT contains(text, 'Result not found')
    AND NOT contains(text, 'No exact matches found') AND NOT contains(text, 'Search results for:'))
SELECT domain, split_part(domain, '.', 1) AS site, count(*) AS n_pages,
       CAST(sum(length(text)) AS BIGINT) AS n_chars, round(sum(length(text)) / count(*), 4) AS mean_chars
FROM first WHERE turn = 1 GROUP BY ALL
"""
ORACLES["page_texts"] = f"""
WITH {_PAGES} SELECT page_id, title, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5 FROM pages_read
"""
ORACLES["page_domains"] = f"""
WITH {_PAGES} SELECT page_id, domain, split_part(domain, '.', 1) AS site FROM pages_read
"""
ORACLES["page_kinds"] = """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'html.parser' WHEN 1 THEN 'xml' WHEN 2 THEN 'lxml'
  WHEN 3 THEN 'lxml' WHEN 4 THEN 'plain' END AS page_kind FROM events
"""
ORACLES["fetch_times"] = """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS retrieved FROM events
"""
ORACLES["decoded_contents"] = """
SELECT doc_id, CAST(CASE WHEN doc_id % 7 <> 0 THEN length(text) END AS INTEGER) AS n_chars,
       CASE WHEN doc_id % 7 <> 0 THEN md5(text) END AS html_md5 FROM documents WHERE true
"""
_PLAIN = "translate(text, 'äöüßéèçêóñíÄÖÜÉÈÇÊÓÑÍ', 'aouseeceoniAOUEECEONI')"
_LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLES["detected_charsets"] = f"""
SELECT doc_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS html_md5
FROM (SELECT doc_id, CASE WHEN doc_id % 8 < 3 THEN text
  WHEN doc_id % 8 = 7 THEN translate({_PLAIN}, '{_LATIN}', 'αβχδεφγηιϊκλμνοπψρστθωςξυζΑΒΧΔΕΦΓΗΙΪΚΛΜΝΟΠΨΡΣΤΘΩΆΞΥΖ')
  ELSE translate({_PLAIN}, '{_LATIN}', 'абцдефгхийклмнопярстужвьызАБЦДЕФГХИЙКЛМНОПЯРСТУЖВЬЫЗ') END AS t FROM documents)
"""
ORACLES["stripped_texts"] = f"""
SELECT doc_id, {_key("text")} AS text_key, split_part(text, '.', 1) AS first_sentence,
       trim(split_part(text, ' ', -1), '{BLANKS}') AS last_word FROM documents
"""
ORACLES["repaired_texts"] = """
SELECT doc_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5
FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN text WHEN 4 THEN 'Â© – ä Ã ' || text ELSE 'it’s “é” ' || text END AS t FROM documents)
"""
_AMOUNT = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)"
ORACLES["price_texts"] = f"""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN CAST('1' || {_AMOUNT} AS DOUBLE)
  WHEN 1 THEN CAST({_AMOUNT} || '50' AS DOUBLE) WHEN 4 THEN CAST({_AMOUNT} AS DOUBLE) END AS price FROM part
"""
ORACLES["price_lists"] = """
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN CAST(p_size AS DOUBLE)
  ELSE (p_size + CAST('100' || p_size AS DOUBLE)) / 2 END AS price FROM part
"""
ORACLES["currency_lists"] = """
SELECT o_orderkey, o_orderstatus || CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE ', ' || o_orderpriority END AS currency
FROM orders
"""
ORACLES["location_names"] = """
SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'USA' WHEN 1 THEN 'Great Britain' WHEN 2 THEN NULL WHEN 3 THEN 'us'
  ELSE c_mktsegment END AS location FROM customer
"""
ORACLES["listing_values"] = """
SELECT 'http://x.example.com/' || p_partkey AS url, p_name AS title, CAST(NULL AS VARCHAR) AS text,
  CAST(NULL AS VARCHAR) AS domain, CAST(NULL AS VARCHAR) AS retrieved, p_brand AS name, CAST(NULL AS VARCHAR) AS description,
  CASE WHEN p_size <= 25 THEN p_type END AS image, CAST(NULL AS VARCHAR) AS production_data, CAST(NULL AS VARCHAR) AS category,
  CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS DOUBLE) END AS price, CAST(NULL AS VARCHAR) AS currency,
  CAST(NULL AS VARCHAR) AS seller, CAST(NULL AS VARCHAR) AS seller_type, CAST(NULL AS VARCHAR) AS seller_url,
  CASE WHEN p_size % 2 = 0 THEN 'USA' END AS location, CAST(NULL AS VARCHAR) AS "ships to" FROM part
"""
ORACLES["order_rows_as_text"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus, o_orderpriority,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders
"""
ORACLES["classifier_texts"] = """
WITH r AS (
  SELECT doc_id, CASE WHEN quality = 1 THEN source END AS title, CASE WHEN toxic = 0 THEN lang END AS name,
         CASE WHEN doc_id % 5 <> 0 THEN text END AS description
  FROM documents LEFT JOIN labels USING (doc_id)),
p AS (
  SELECT doc_id, coalesce(CASE WHEN title IS NULL THEN description WHEN name IS NULL THEN title ELSE name END, '') AS product FROM r)
SELECT doc_id, md5(product) AS product_md5,
       CASE WHEN product <> '' AND doc_id % 3 < 2 THEN CAST(doc_id % 3 AS INTEGER) END AS label FROM p
"""
ORACLES["classifier_rows"] = """
WITH r AS (
  SELECT doc_id, CASE WHEN quality = 1 THEN source END AS title, CASE WHEN toxic = 0 THEN '' END AS name,
         CASE WHEN doc_id % 5 <> 0 THEN lang END AS description
  FROM documents LEFT JOIN labels USING (doc_id)),
p AS (
  SELECT doc_id, coalesce(CASE WHEN title IS NULL THEN description WHEN name IS NULL THEN title ELSE name END, '') AS sentence FROM r)
SELECT * FROM p WHERE sentence <> ''
"""
ORACLES["better_labels"] = """
WITH r AS (
  SELECT doc_id, quality AS a, CASE WHEN doc_id % 4 <> 0 THEN toxic END AS b
  FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN a IS NULL THEN b WHEN b IS NULL THEN a WHEN doc_id % 7 > doc_id % 10 THEN b ELSE a END AS label FROM r
"""

# --- the crawl derived from part, supplier and nation ------------------------

_AD = f"""
ad0 AS (
  SELECT p_partkey AS p, p_partkey % 12 AS variant, p_name, p_brand, p_type, {_AMOUNT} AS price, s_name,
         s_suppkey, CASE n_nationkey WHEN 0 THEN 'US' WHEN 1 THEN 'GB' ELSE n_name END AS country
  FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)
  JOIN nation ON n_nationkey = s_nationkey),
ad AS (
  SELECT ad0.*, crawl, p_name || ' ' || p AS np,
    'https://www.' || host || '/item/' || p AS url, host AS domain, split_part(host, '.', 1) AS site,
    strftime(make_timestamp(({FIRST_FETCH} + p * 1000 + crawl * 100000000) * 1000), '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS retrieved,
    make_timestamp(({FIRST_FETCH} + p * 1000 + crawl * 100000000) * 1000) AS fetched_at
  FROM ad0 JOIN (SELECT 0 AS crawl UNION ALL SELECT 1) c ON crawl = 0 OR variant = 5
  JOIN (SELECT p, CASE variant WHEN 9 THEN 'ebay' WHEN 10 THEN 'gumtree' ELSE 'shop' || (p % 7) END || '.example.com:8080' AS host
        FROM ad0) h USING (p)),
page AS (
  SELECT *,
    CASE variant WHEN 6 THEN 'Lot ' || p WHEN 8 THEN '  LOT ' || (p - 2) WHEN 9 THEN 'Café ' || p ELSE np END AS title,
    CASE variant
      WHEN 0 THEN np || 'JSON-LD page ' || p
      WHEN 1 THEN np || 'Two offers page ' || p
      WHEN 2 THEN np || chr(10) || 'Low and high page ' || p
      WHEN 3 THEN np || repeat(chr(10), 5) || 'OpenGraph page ' || p
      WHEN 4 THEN np || chr(10) || np || chr(10) || chr(10) || 'about ' || price || chr(10) || s_name || chr(10) || country
                  || chr(10) || 'Microdata page ' || p
      WHEN 5 THEN np || chr(10) || chr(10) || 'micro ' || np || chr(10) || 'crawl ' || crawl || price || chr(10) || s_name
                  || chr(10) || 'shop' || 'Both page ' || p || ' crawl ' || crawl
      WHEN 6 THEN 'Lot ' || p || 'Plain page ' || p
      WHEN 7 THEN np || 'Item Not found ' || p
      WHEN 8 THEN '  LOT ' || (p - 2) || 'PLAIN page ' || (p - 2) || chr(10) || chr(9)
      WHEN 9 THEN 'Café ' || p || 'Auction page ' || p || ' été' || chr(10) || ' ' || s_name || ' (7)' || chr(10)
                  || 'Located in: Town ' || p || ', ' || country || chr(10)
      WHEN 10 THEN np || np || chr(10) || price || ' EUR' || s_name || country
      WHEN 11 THEN np || chr(10) || chr(10) || 'Dublin page ' || p END AS text
  FROM ad),
kept AS (SELECT * FROM page WHERE variant <> 7)
"""

# What each extractor finds: one row per candidate. Fields it never sets are left out.
_JSON_LD = """
json_ld AS (
  SELECT p, crawl, url, retrieved, np AS name,
    CASE variant WHEN 0 THEN p_type || ' item' END AS description,
    'https://img.example.com/' || CASE variant WHEN 0 THEN p_brand WHEN 1 THEN 'a' || p ELSE 'u' || p END || '.png' AS image,
    CASE variant WHEN 0 THEN '2020' END AS production_data, CASE variant WHEN 0 THEN p_brand END AS category,
    CASE variant WHEN 2 THEN (CAST(price AS DOUBLE) + CAST('1' || price AS DOUBLE)) / 2 ELSE CAST(price AS DOUBLE) END AS price,
    CASE variant WHEN 0 THEN 'USD' WHEN 1 THEN 'USD, EUR' END AS currency,
    CASE WHEN variant < 2 THEN s_name END AS seller,
    CASE variant WHEN 0 THEN 'Organization' WHEN 1 THEN 'Person' END AS seller_type,
    CASE variant WHEN 0 THEN 'https://sellers.example.com/' || s_suppkey END AS seller_url,
    CASE WHEN variant < 2 THEN country END AS location
  FROM kept WHERE variant < 3)
"""
_MICRODATA = """
microdata AS (
  SELECT p, crawl, url, retrieved, CASE variant WHEN 4 THEN np ELSE 'micro ' || np END AS name,
    CASE variant WHEN 5 THEN 'crawl ' || crawl END AS description,
    CASE variant WHEN 4 THEN 'https://www.' || domain || '/m/' || p || '.png' END AS image,
    CAST(NULL AS VARCHAR) AS production_data, CASE variant WHEN 4 THEN p_brand END AS category,
    CAST(price AS DOUBLE) AS price, CASE variant WHEN 4 THEN 'GBP' END AS currency, s_name AS seller,
    CASE variant WHEN 4 THEN 'Organization' ELSE 'Person' END AS seller_type,
    CASE variant WHEN 5 THEN 'https://www.' || domain || '/seller/' || s_suppkey END AS seller_url,
    CASE variant WHEN 4 THEN country END AS location
  FROM kept WHERE variant IN (4, 5))
"""
_OPEN_GRAPH = """
open_graph AS (
  SELECT p, crawl, url, retrieved, CASE variant WHEN 3 THEN p_name || ' & co ' || p ELSE 'og ' || p END AS name,
    CASE variant WHEN 3 THEN 'OpenGraph ' || p_type END AS description,
    'https://img.example.com/' || CASE variant WHEN 3 THEN p_type ELSE crawl || '/' || p END || '.png' AS image,
    CASE variant WHEN 3 THEN p_brand END AS category, CASE variant WHEN 3 THEN CAST(price AS DOUBLE) END AS price,
    CASE variant WHEN 3 THEN 'USD' END AS currency,
    CASE variant WHEN 3 THEN 'https://sellers.example.com/' || s_suppkey END AS seller_url
  FROM kept WHERE variant IN (3, 5))
"""
_DUBLIN_CORE = """
dublin_core AS (
  SELECT p, crawl, url, retrieved, 'description' AS name, 'Core ' || p_type AS description, p_brand AS category,
    CAST(price AS DOUBLE) AS price, 'USD' AS currency
  FROM kept WHERE variant = 11)
"""
_SITE = """
site_seller AS (
  SELECT p, crawl, url, retrieved, s_name AS seller, 'Town ' || p || ', ' || country AS location FROM kept WHERE variant = 9),
site_rule AS (
  SELECT p, crawl, url, retrieved, np AS name, CAST(price AS DOUBLE) AS price, s_name AS seller, country AS "ships to"
  FROM kept WHERE variant = 10)
"""
_ALL = ",".join((_AD, _JSON_LD, _MICRODATA, _OPEN_GRAPH, _DUBLIN_CORE, _SITE))

for _name, _table in (
    ("json_ld_products", "json_ld"),
    ("microdata_products", "microdata"),
    ("open_graph_products", "open_graph"),
    ("dublin_core_products", "dublin_core"),
    ("site_sellers", "site_seller"),
    ("site_rule_products", "site_rule"),
):
    ORACLES[_name] = f"WITH {_ALL} SELECT * EXCLUDE (p, crawl) FROM {_table}"

ORACLES["learnt_rule_products"] = f"WITH {_ALL} SELECT * EXCLUDE (p, crawl) FROM site_rule WHERE p % 24 = 22"
ORACLES["candidate_rows"] = f"""
WITH {_ALL}, found AS (
  SELECT p, crawl, 1 AS source_rank, 'site seller' AS origin, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS DOUBLE) AS price FROM site_seller
  UNION ALL SELECT p, crawl, 1, 'site rules', name, price FROM site_rule
  UNION ALL SELECT p, crawl, 1, 'microdata', name, price FROM microdata
  UNION ALL SELECT p, crawl, CASE p % 12 WHEN 5 THEN 2 ELSE 1 END, 'opengraph', name, price FROM open_graph
  UNION ALL SELECT p, crawl, 1, 'dublincore', name, price FROM dublin_core
  UNION ALL SELECT p, crawl, 1, 'json-ld', name, price FROM json_ld
  UNION ALL SELECT p, crawl, 0, 'page', NULL, NULL FROM kept)
SELECT url, retrieved, title, CAST(source_rank AS INTEGER) AS source_rank, origin, found.name, found.price
FROM found JOIN kept USING (p, crawl)
"""

# One row per page that is no copy of an earlier one. Variant 5 pages share a URL.
_FIRST = "first AS (SELECT * FROM kept WHERE variant <> 8)"
_NAMED_LOCATION = "CASE location WHEN 'US' THEN 'USA' WHEN 'GB' THEN 'Great Britain' ELSE location END"

ORACLES["listings_by_row"] = f"""
WITH {_ALL}, {_FIRST}, chosen AS (
  SELECT * EXCLUDE (url, retrieved) FROM json_ld
  UNION ALL BY NAME SELECT * EXCLUDE (url, retrieved) FROM microdata WHERE image IS NOT NULL
  UNION ALL BY NAME SELECT * EXCLUDE (url, retrieved) FROM open_graph)
SELECT f.url, f.title, f.text, f.domain, f.retrieved, c.name, c.description, c.image, c.production_data, c.category,
  c.price, c.currency, c.seller, c.seller_type, c.seller_url, {_NAMED_LOCATION.replace("location", "c.location")} AS location,
  CAST(NULL AS VARCHAR) AS "ships to", sha256(f.url) AS id
FROM first f LEFT JOIN chosen c USING (p, crawl) WHERE f.crawl = 0
"""
_BY_FIELD = f"""
{_ALL}, {_FIRST}, found AS (
  SELECT * EXCLUDE (url, retrieved) FROM json_ld
  UNION ALL BY NAME SELECT * EXCLUDE (url, retrieved, image), image FROM microdata WHERE p % 12 = 4
  UNION ALL BY NAME
  SELECT m.* EXCLUDE (url, retrieved, image), o.image FROM microdata m JOIN open_graph o USING (p, crawl) WHERE p % 12 = 5
  UNION ALL BY NAME SELECT * EXCLUDE (url, retrieved) FROM open_graph WHERE p % 12 = 3
  UNION ALL BY NAME SELECT * EXCLUDE (url, retrieved) FROM dublin_core
  UNION ALL BY NAME SELECT * EXCLUDE (url, retrieved) FROM site_seller
  UNION ALL BY NAME SELECT * EXCLUDE (url, retrieved) FROM site_rule)
"""
ORACLES["listings_by_field"] = f"""
WITH {_BY_FIELD}
SELECT f.url, f.title, f.text, f.domain, f.retrieved, c.name, c.description, c.image, c.production_data, c.category,
  c.price, c.currency, c.seller, c.seller_type, c.seller_url, {_NAMED_LOCATION.replace("location", "c.location")} AS location,
  c."ships to", sha256(f.url) AS id
FROM first f LEFT JOIN found c USING (p, crawl) WHERE f.crawl = 0
"""
for _name in ("row", "field"):
    ORACLES[f"incremental_listings_by_{_name}"] = ORACLES[f"listings_by_{_name}"]
ORACLES["crawl_job_in_two_runs"] = ORACLES["listings_by_row"]
ORACLES["kept_pages_by_site"] = f"""
WITH {_AD} SELECT site, count(*) AS raw_rows, count(*) FILTER (variant <> 7) AS kept_rows FROM page GROUP BY site
"""
_IN_RANGE = "fetched_at >= TIMESTAMP '2023-02-10 17:10:00' AND fetched_at < TIMESTAMP '{0}'"
ORACLES["index_scan"] = f"""
WITH {_AD} SELECT url, retrieved, title FROM kept WHERE {_IN_RANGE.format("2023-02-11 21:00:00")}
"""
ORACLES["index_listings"] = f"""
WITH {_BY_FIELD}, ranged AS (
  SELECT *, time_bucket(INTERVAL '2 hours', fetched_at, TIMESTAMP '2023-02-10 17:10:00') AS window_start,
         row_number() OVER (PARTITION BY {_key("text")} ORDER BY retrieved, url) AS turn
  FROM kept WHERE {_IN_RANGE.format("2023-02-11 21:10:00")})
SELECT r.url, r.title, r.retrieved, c.name, c.image, c.price, {_NAMED_LOCATION.replace("location", "c.location")} AS location,
  strftime(window_start, 'data_%b_%d/') AS image_folder, 'images-' || lower(strftime(window_start, '%b')) AS image_bucket
FROM ranged r LEFT JOIN found c USING (p, crawl) WHERE turn = 1
"""
for _name in ("scan", "listings"):
    ORACLES[f"segment_index_{_name}"] = ORACLES[f"index_{_name}"]
ORACLES["crawl_files_by_run"] = f"""
WITH {_AD}, found AS (
  SELECT *, 'run' || crawl AS run FROM page)
SELECT run, 'shops' AS crawler, 'shops_' || run || '/' AS output_prefix, url, 'text/html; charset=utf-8' AS content_type,
  epoch_ms(fetched_at) AS fetch_time FROM found
"""
ORACLES["crawl_job_listings"] = (
    f"SELECT l.*, CASE WHEN l.image IN (SELECT 'https://img.example.com/' || p_brand || '.png' FROM part)"
    f" THEN 'data_Feb_10/' || min(id) OVER (PARTITION BY image) || '.png' END AS image_path FROM ({ORACLES['listings_by_row']}) l"
)

ORACLES["crawl_job_in_batches"] = ORACLES["crawl_job_in_versions"] = ORACLES["crawl_job_listings"]
ORACLES["index_job_overlapping"] = f"""
WITH {_BY_FIELD}, ranged AS (
  SELECT *, row_number() OVER (PARTITION BY {_key("text")} ORDER BY retrieved, url) AS turn
  FROM kept WHERE {_IN_RANGE.format("2023-02-14 00:00:00")})
SELECT url, count(*) AS n_rows FROM ranged WHERE turn = 1 GROUP BY url
"""
ORACLES["hostile_pages"] = """
WITH p AS (SELECT p_partkey AS p, CASE p_partkey % 20 WHEN 10 THEN 10 ELSE p_partkey % 10 END AS v, p_name AS n FROM part)
SELECT 'https://www.shop.com/' || p || '?a={b}|c' AS url,
  CASE v WHEN 6 THEN 'a' || chr(160) || p || ' © 2020 ' || chr(8217) || ' KEEP ' || p || 'don''t a>b'
         WHEN 1 THEN 'q' || n || ' page ' || p WHEN 2 THEN n || p || ' page ' || p
         WHEN 10 THEN n || ' page ' || p WHEN 9 THEN 'Привет ' || p ELSE 'page ' || p END AS text,
  CASE WHEN v IN (6, 7, 9) THEN 'page' WHEN v IN (1, 2, 10) THEN 'microdata' WHEN v IN (0, 5) THEN 'opengraph' ELSE 'json-ld' END AS origin,
  CASE v WHEN 0 THEN n WHEN 1 THEN n WHEN 2 THEN n WHEN 10 THEN n || ' page ' || p WHEN 3 THEN 'live ' || p WHEN 4 THEN 'second ' || p
         WHEN 5 THEN 'a property=b ' || p WHEN 8 THEN n END AS name,
  CASE v WHEN 2 THEN CAST(p AS DOUBLE) WHEN 4 THEN 15000000.0 WHEN 8 THEN -1.0 - p END AS price
FROM p
"""

# --- dedupe, ranks and sets --------------------------------------------------

ORACLES["first_documents"] = f"""
SELECT doc_id, lang, source, {_key("text")} AS text_key FROM documents
QUALIFY row_number() OVER (PARTITION BY {_key("text")} ORDER BY doc_id) = 1
"""
ORACLES["unseen_documents"] = f"""
WITH k AS (SELECT doc_id, lang, {_key("text")} AS text_key FROM documents)
SELECT * FROM k WHERE text_key NOT IN (SELECT text_key FROM k WHERE lang = 'en')
QUALIFY row_number() OVER (PARTITION BY text_key ORDER BY doc_id) = 1
"""
ORACLES["error_documents"] = """
SELECT source, count(*) AS raw_rows, count(*) FILTER (text <> '' AND NOT contains(text, 'of the')
  AND NOT contains(text, 'et la') AND NOT contains(text, 'Une')) AS kept_rows FROM documents GROUP BY source
"""
_NO_WORD = r"[^\p{L}\p{N}_]"


def _phrase(a: str, b: str) -> str:
    return f"regexp_matches(text, '(?i)(^|{_NO_WORD}){a}{_NO_WORD}+{b}($|{_NO_WORD})')"


ORACLES["documents_without_phrase"] = f"""
SELECT doc_id, lang FROM documents
WHERE NOT {_phrase("of", "the")} AND NOT {_phrase("the", "and")} AND NOT {_phrase("et", "la")}
"""
_IMAGE_ROWS = """
image_rows AS (
  SELECT 'http://x.example.com/' || l_partkey AS url,
    CASE WHEN l_linenumber % 3 = 0 THEN 'None' WHEN l_linenumber % 3 = 1 THEN 'https://i/' || l_suppkey
         WHEN l_linenumber = 2 THEN '  ' END AS image,
    l_orderkey * 10 + l_linenumber AS rank
  FROM lineitem)
"""
ORACLES["image_ranked_rows"] = f"""
WITH {_IMAGE_ROWS} SELECT url, coalesce(image, 'None') AS image, rank FROM image_rows
QUALIFY row_number() OVER (PARTITION BY url ORDER BY CASE WHEN coalesce(image, 'None') <> 'None' THEN 0 ELSE 1 END, rank) = 1
"""
ORACLES["rows_with_usable_image"] = f"""
WITH {_IMAGE_ROWS} SELECT image, count(*) AS n_rows FROM image_rows WHERE image LIKE 'https:%' GROUP BY image
"""
ORACLES["file_states"] = """
WITH m AS (SELECT l_orderkey, max(l_returnflag = 'R') AS done FROM lineitem WHERE l_quantity > 40 GROUP BY l_orderkey)
SELECT 'f' || o_orderkey AS source_file, CASE WHEN done IS NULL THEN 'pending' ELSE 'repair' END AS state
FROM orders LEFT JOIN m ON l_orderkey = o_orderkey WHERE done IS NULL OR NOT done
"""

# --- images and places -------------------------------------------------------

_LISTED = f"""
{_AD}, listed AS (
  SELECT 'http://x.example.com/' || p AS url,
    CASE variant WHEN 0 THEN 'https://img.example.com/' || p_brand WHEN 3 THEN 'http://img.example.com/' || p_type END AS image,
    CASE WHEN variant <> 6 THEN 'Town ' || p || ', ' || country END AS location,
    sha256('http://x.example.com/' || p) AS id
  FROM page WHERE true),
images AS (SELECT image, min(id) AS image_id, count(*) AS n_rows FROM listed WHERE image IS NOT NULL GROUP BY image)
"""
ORACLES["distinct_images"] = f"WITH {_LISTED} SELECT * FROM images"
ORACLES["listings_with_image_path"] = f"""
WITH {_LISTED} SELECT id, image, CASE WHEN image LIKE 'https:%' THEN 'data_Feb_10/' || image_id || '.png' END AS image_path
FROM listed LEFT JOIN images USING (image)
"""
ORACLES["listings_with_stored_image"] = f"""
WITH {_LISTED} SELECT url, 'images-feb/' || image_id || '.png' AS image_path FROM listed JOIN images USING (image)
WHERE image LIKE '%https%'
"""
ORACLES["resolved_locations"] = f"""
WITH {_LISTED} SELECT url, location, n_name AS place FROM listed
LEFT JOIN nation ON n_name = split_part(location, ', ', 2)
"""
ORACLES["listings_through_csv"] = f"WITH {_LISTED} SELECT * FROM listed"

# Every distinct part against every name.
ORACLES["misspelt_locations"] = """
WITH o AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
names AS (SELECT n_name AS name, n_name AS place FROM nation UNION ALL SELECT n_name || ' of ' || r_name, n_name FROM o),
c AS (
  SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN n_name || ' of ' || r_name ELSE n_name END AS name
  FROM customer JOIN o ON c_nationkey = n_nationkey),
e AS (SELECT *, CAST(c_custkey % length(name) AS INTEGER) AS n FROM c),
l AS (
  SELECT c_custkey, c_name || ', ' || CASE c_custkey % 5
    WHEN 0 THEN left(name, n) || substr(name, n + 2) WHEN 1 THEN left(name, n) || 'x' || substr(name, n + 2)
    WHEN 2 THEN left(name, n) || 'x' || substr(name, n + 1) ELSE name END AS location FROM e),
p AS (
  SELECT c_custkey, pos, string_split(location, ', ')[pos] AS part
  FROM (SELECT c_custkey, location, unnest(range(1, len(string_split(location, ', ')) + 1)) AS pos FROM l)),
d AS (SELECT part, name, place, levenshtein(part, name) AS far FROM (SELECT DISTINCT part FROM p), names),
best AS (
  SELECT c_custkey, place FROM p JOIN d USING (part)
  WHERE far <= CASE WHEN least(length(part), length(name)) >= 4 THEN 1 ELSE 0 END
  QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY far, pos, name, place) = 1)
SELECT c_custkey, location, place FROM l LEFT JOIN best USING (c_custkey)
"""
# --- classification ----------------------------------------------------------

ORACLES["top_dimensions"] = """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS label,
       round(CAST(list_max(embedding) AS DOUBLE), 5) AS score FROM embeddings
"""
ORACLES["zero_shot_languages"] = """
SELECT lang, count(*) AS n_texts, true AS found FROM documents WHERE doc_id % 2 = 1 GROUP BY lang
"""
ORACLES["zero_shot_labels"] = """
WITH e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
m AS (SELECT label, i, avg(x) AS x FROM e GROUP BY label, i),
c AS (
  SELECT e.vec_id, m.label, sum(e.x * m.x) / sqrt(sum(e.x * e.x) * sum(m.x * m.x)) AS cosine
  FROM e JOIN m USING (i) GROUP BY e.vec_id, m.label)
SELECT vec_id, label AS label_product, round(exp(cosine) / sum(exp(cosine)) OVER (PARTITION BY vec_id), 6) AS score_product
FROM c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, label) = 1
"""
ORACLES["custom_scores"] = "SELECT doc_id, CAST(length(text) AS BIGINT) AS score FROM documents"
ORACLES["stratified_sample"] = """
SELECT *, CASE quality WHEN 0 THEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20
  WHEN 1 THEN true ELSE false END AS sample_image FROM labels
"""

# --- time windows and counts -------------------------------------------------

ORACLES["event_windows"] = """
WITH w AS (
  SELECT time_bucket(INTERVAL '2 hours', ts, TIMESTAMP '2024-01-03 01:30:00') AS w, CAST(value AS DECIMAL(18,2)) AS value
  FROM events WHERE ts >= TIMESTAMP '2024-01-03 01:30:00' AND ts < TIMESTAMP '2024-01-20 13:30:00')
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL '2 hours', '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS n_rows, CAST(sum(value) AS DOUBLE) AS sum_value FROM w GROUP BY w
"""
ORACLES["events_in_range"] = """
SELECT event_type, count(*) AS n_rows FROM events
WHERE ts >= TIMESTAMP '2024-01-03 01:30:00' AND ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY event_type
"""
ORACLES["date_folders"] = """
SELECT o_orderkey, strftime(o_orderdate, 'data_%b_%d/') AS image_folder, 'images-' || lower(strftime(o_orderdate, '%b')) AS image_bucket,
       strftime(o_orderdate, 'data_%b_%d/data_%m-%d-%YT%H:%M:%S') AS file_stamp FROM orders
"""
ORACLES["document_count"] = "SELECT count(*) AS n_docs FROM documents"
ORACLES["lines_sorted_by_image"] = f"WITH {_IMAGE_ROWS} SELECT * FROM image_rows"
