"""Registered queries: each runs an operator over whole given tables, or over
the crawl records derived from them (`checks.ads`)."""

from collections.abc import Callable
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adgleaner import schema
from adgleaner.functions import charsets, text as tx, values as vl, web
from adgleaner.operators import candidates as cd, classify as cl, counts, dedupe, images as im, induction
from adgleaner.operators import listings as ls, pages as pg, places, rules as rl, word_vectors
from adgleaner.operators.shape import compute_once, spread
from adgleaner.plans import incremental, jobs, versions
from adgleaner.session import shared_folder
from adgleaner.sources import index, readers, sinks
from adgleaner.streaming import windows
from checks import ads, hostile
from checks.ads import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _md5(c: Column) -> Column:
    return F.md5(c.cast("binary"))


# --- decoding and reading pages ----------------------------------------------


def _read_pages(spark, sf_dir) -> DataFrame:
    pages = spread(read(spark, sf_dir, "pages"))
    with_domain = pages.withColumn("domain", web.domain(F.col("url")))
    return pg.read_pages(with_domain.withColumn("site", web.site(F.col("domain"))))


@query
def page_text_by_domain(spark, sf_dir):
    """Pages that pass the filters, first of each text, per domain."""
    pages = pg.admit(_read_pages(spark, sf_dir))
    narrow = pages.select("domain", "site", "text_key", "page_id", F.length("text").alias("n"))
    first = dedupe.first_per(narrow, ["text_key"], [F.col("page_id")])
    return first.groupBy("domain", "site").agg(
        F.count("*").alias("n_pages"),
        F.sum("n").alias("n_chars"),
        F.round(F.sum("n") / F.count("*"), 4).alias("mean_chars"),
    )


@query
def page_texts(spark, sf_dir):
    return _read_pages(spark, sf_dir).select(
        "page_id", "title", F.length("text").alias("n_chars"), _md5(F.col("text")).alias("text_md5")
    )


@query
def page_domains(spark, sf_dir):
    domain = web.domain(F.col("url"))
    return read(spark, sf_dir, "pages").select(
        "page_id", domain.alias("domain"), web.site(domain).alias("site")
    )


@query
def page_kinds(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    content_type = F.expr(
        "CASE event_id % 6 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'text/xml' WHEN 2 THEN 'application/x-asp'"
        " WHEN 3 THEN 'application/xhtml+xml' WHEN 4 THEN 'text/plain' ELSE event_type END"
    )
    return events.select("event_id", web.page_kind(content_type).alias("page_kind"))


@query
def fetch_times(spark, sf_dir):
    return read(spark, sf_dir, "events").select(
        "event_id", web.retrieved(F.unix_millis(F.col("ts").cast("timestamp"))).alias("retrieved")
    )


@query
def decoded_contents(spark, sf_dir):
    """Texts as base64 of UTF-8 or Latin-1 bytes, or not base64 at all, read back."""
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
    fits = ~F.col("text").rlike(r"[^\x{0}-\x{FF}]") & (F.col("doc_id") % 2 == 1)
    checked = compute_once(docs, ["doc_id", "text"], latin=F.when(fits, F.col("text")))
    written = F.base64(F.coalesce(F.encode("latin", "ISO-8859-1"), F.encode("text", "UTF-8")))
    content = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("!!"), F.col("text"))).otherwise(written)
    raw = compute_once(checked, ["doc_id"], bytes=web.page_bytes(content))
    decoded = compute_once(raw, ["doc_id"], html=web.decode_page(F.col("bytes")))
    return decoded.select("doc_id", F.length("html").alias("n_chars"), _md5(F.col("html")).alias("html_md5"))


# Letters of the given texts, and their places in other alphabets.
ACCENTED, PLAIN = "äöüßéèçêóñíÄÖÜÉÈÇÊÓÑÍ", "aouseeceoniAOUEECEONI"
LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
CYRILLIC = "абцдефгхийклмнопярстужвьызАБЦДЕФГХИЙКЛМНОПЯРСТУЖВЬЫЗ"
GREEK = "αβχδεφγηιϊκλμνοπψρστθωςξυζΑΒΧΔΕΦΓΗΙΪΚΛΜΝΟΠΨΡΣΤΘΩΆΞΥΖ"


def in_alphabet(text: Column, doc_id: Column) -> Column:
    """A text in the alphabet of its charset: three Latin ones, four Cyrillic, a Greek one."""
    plain, kind = F.translate(text, ACCENTED, PLAIN), doc_id % 8
    other = F.when(kind == 7, F.translate(plain, LATIN, GREEK)).when(kind > 2, F.translate(plain, LATIN, CYRILLIC))
    return F.coalesce(other, text)


@query
def detected_charsets(spark, sf_dir):
    """All texts in eight charsets that nothing declares, read back; UTF-8 where a charset lacks a letter."""

    @F.arrow_udf("binary")
    def encoded(text: pa.Array, charset: pa.Array) -> pa.Array:
        def one(t: str | None, c: str) -> bytes | None:
            try:
                return None if t is None else t.encode(c)
            except UnicodeEncodeError:
                return t.encode()

        return pa.array([one(t, c) for t, c in zip(text.to_pylist(), charset.to_pylist())], pa.binary())

    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
    texts = docs.select("doc_id", in_alphabet(F.col("text"), F.col("doc_id")).alias("text"))
    model = charsets.learn(texts)
    names = F.array(*[F.lit(c) for c in charsets.CHARSETS])
    raw = texts.select("doc_id", encoded("text", F.get(names, F.col("doc_id") % 8)).alias("bytes"))
    decoded = compute_once(raw, ["doc_id"], html=web.decode_page(F.col("bytes"), model))
    return decoded.select("doc_id", F.length("html").alias("n_chars"), _md5(F.col("html")).alias("html_md5"))


# --- text and value cleaning -------------------------------------------------


@query
def stripped_texts(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    padded = F.concat(F.lit(" \t\u00a0 "), F.col("text"), F.lit("\n\u3000"))
    return docs.select(
        "doc_id",
        tx.text_key(padded).alias("text_key"),
        F.split_part(F.col("text"), F.lit("."), F.lit(1)).alias("first_sentence"),
        tx.strip(F.substring_index("text", " ", -1)).alias("last_word"),
    )


@query
def repaired_texts(spark, sf_dir):
    """Texts read wrongly once or twice, in Latin-1 or Windows-1252, and clean ones that look alike, repaired."""
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "text"))
    marked = F.concat(F.lit("it\u2019s \u201cé\u201d "), F.col("text"))
    clean = F.concat(F.lit("Â© \u2013 ä Ã "), F.col("text"))
    windows = str.maketrans(web.CP1252_HIGH)

    def misread(text: Column, as_windows: bool) -> Column:
        latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
        return F.translate(latin, "".join(map(chr, windows)), "".join(windows.values())) if as_windows else latin

    kind = F.col("doc_id") % 5
    broken = (
        F.when(kind == 0, misread(F.col("text"), False)).when(kind == 1, misread(marked, True))
        .when(kind == 2, misread(misread(marked, True), True)).when(kind == 3, misread(misread(marked, False), False)).otherwise(clean)
    )
    wrong = compute_once(docs, ["doc_id"], text=broken)
    fixed = compute_once(wrong, ["doc_id"], text=tx.repair_mojibake(F.col("text")))
    return fixed.select("doc_id", F.length("text").alias("n_chars"), _md5(F.col("text")).alias("text_md5"))


@query
def price_texts(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    amount = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    text = (
        F.when(F.col("p_partkey") % 6 == 0, F.concat(F.lit("US $1,"), amount))
        .when(F.col("p_partkey") % 6 == 1, F.concat(amount, F.lit(",50 EUR")))
        .when(F.col("p_partkey") % 6 == 2, F.concat(F.lit("1.2."), F.col("p_size").cast("string")))
        .when(F.col("p_partkey") % 6 == 3, F.col("p_name"))
        .when(F.col("p_partkey") % 6 == 4, amount)
    )
    return part.select("p_partkey", vl.price(text).alias("price"))


@query
def price_lists(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    prices = F.array(
        F.concat(F.lit("$"), F.col("p_size").cast("string")),
        F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("EUR 1,00"), F.col("p_size").cast("string"))),
        F.col("p_type"),
    )
    chosen = F.when(F.col("p_partkey") % 5 == 0, F.array(F.col("p_name"))).otherwise(prices)
    return part.select("p_partkey", vl.mean_price(chosen).alias("price"))


@query
def currency_lists(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", vl.currency(F.array("o_orderstatus", F.nullif("o_orderpriority", F.lit("1-URGENT")))).alias("currency")
    )


@query
def location_names(spark, sf_dir):
    customer = read(spark, sf_dir, "customer")
    raw = F.expr(
        "CASE c_nationkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'None' WHEN 3 THEN 'us' ELSE c_mktsegment END"
    )
    return customer.select("c_custkey", vl.location(raw).alias("location"))


@query
def listing_values(spark, sf_dir):
    """Listing columns from text columns of any content, typed."""
    part = read(spark, sf_dir, "part")
    text = {
        "url": F.concat(F.lit("http://x.example.com/"), F.col("p_partkey").cast("string")),
        "title": F.col("p_name"),
        "name": F.col("p_brand"),
        "image": F.when(F.col("p_size") > 25, "None").otherwise(F.col("p_type")),
        "price": F.when(F.col("p_size") % 4 == 0, F.col("p_type")).otherwise(F.col("p_size").cast("string")),
        "location": F.when(F.col("p_size") % 2 == 0, "US").otherwise("None"),
    }
    cells = [text.get(c, F.lit(None).cast("string")).alias(c) for c in schema.LISTING.names]
    rows = part.select(*cells).withColumn("image", vl.image(F.col("image")))
    return rows.select(*[vl.listing_row(c) for c in schema.LISTING.names])


@query
def order_rows_as_text(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "customer")
    return orders.select([F.col(c).cast("string").alias(c) for c in orders.columns])


def _labelled(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return docs.join(read(spark, sf_dir, "labels"), "doc_id", "left")


@query
def classifier_texts(spark, sf_dir):
    """Text to classify; rows stay, and those without text get no label."""
    rows = _labelled(spark, sf_dir).select(
        "doc_id",
        F.when(F.col("quality") == 1, F.col("source")).alias("title"),
        F.when(F.col("toxic") == 0, F.col("lang")).alias("name"),
        F.when(F.col("doc_id") % 5 != 0, F.col("text")).alias("description"),
        vl.label_code(F.concat(F.lit("LABEL_"), (F.col("doc_id") % 3).cast("string"))).alias("code"),
    )
    made = cl.with_product_text(rows, keep_empty=True)
    return made.select(
        "doc_id", _md5(F.col("product")).alias("product_md5"), F.when(F.col("product") != "", F.col("code")).alias("label")
    )


@query
def classifier_rows(spark, sf_dir):
    rows = _labelled(spark, sf_dir).select(
        "doc_id",
        F.when(F.col("quality") == 1, F.col("source")).alias("title"),
        F.when(F.col("toxic") == 0, F.lit("")).alias("name"),
        F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("description"),
    )
    return cl.with_product_text(rows, "sentence").select("doc_id", "sentence")


@query
def better_labels(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return rows.select(
        "doc_id",
        vl.better_label(
            F.col("quality"), F.col("doc_id") % 10, F.when(F.col("doc_id") % 4 != 0, F.col("toxic")), F.col("doc_id") % 7
        ).alias("label"),
    )


# --- candidates and listings -------------------------------------------------


def _raw(spark, sf_dir) -> DataFrame:
    return ads.raw_pages(spark, sf_dir).drop("p", "variant", "crawl")


def _ad_pages(spark, sf_dir) -> DataFrame:
    return pg.read_pages(pg.decode_pages(_raw(spark, sf_dir)))


def _candidates(spark, sf_dir) -> DataFrame:
    rules = rl.rules_table(spark, ads.RULES)
    return cd.candidate_rows(cd.with_candidates(pg.admit(_ad_pages(spark, sf_dir)), rules))


def _of(origin: str, columns: tuple[str, ...]):
    def run(spark, sf_dir):
        return _candidates(spark, sf_dir).where(F.col("origin") == origin).select("url", "retrieved", *columns)

    return run


_JSON_LD = ("name", "description", "image", "production_data", "category", "price", "currency",
            "seller", "seller_type", "seller_url", "location")
QUERIES["json_ld_products"] = _of("json-ld", _JSON_LD)
QUERIES["microdata_products"] = _of("microdata", _JSON_LD)
QUERIES["open_graph_products"] = _of(
    "opengraph", ("name", "description", "image", "category", "price", "currency", "seller_url")
)
QUERIES["dublin_core_products"] = _of("dublincore", ("name", "description", "category", "price", "currency"))
QUERIES["site_sellers"] = _of("site seller", ("seller", "location"))
QUERIES["site_rule_products"] = _of("site rules", ("name", "price", "seller", "`ships to`"))


@query
def learnt_rule_products(spark, sf_dir):
    """Rules learnt from one half of a site's pages and their known values, applied to the other half."""
    raw = ads.raw_pages(spark, sf_dir).where("variant = 10")
    pages = im.stored(pg.admit(pg.read_pages(pg.decode_pages(raw))), shared_folder(spark, "site"))
    known = ads.ad_values(spark, sf_dir).where("variant = 10 AND p % 24 = 10").select(
        "p",
        F.explode(
            F.create_map(
                F.lit("name"), F.concat_ws(" ", "p_name", "p"), F.lit("price"), F.concat("price", F.lit(" EUR")),
                F.lit("seller"), F.col("s_name"), F.lit("ships to"), F.col("country"),
            )
        ).alias("field", "value"),
    )
    number = F.substring_index("url", "/", -1).cast("long").alias("p")
    examples = pages.select(number, "site", "html", F.col("url").alias("page")).join(known, "p")
    learnt = im.stored(induction.learn(examples), shared_folder(spark, "learnt"))
    others = pages.where(number % 24 == 22)
    rows = cd.candidate_rows(cd.with_candidates(others, induction.as_rules(learnt)))
    return rows.where(F.col("origin") == "site rules").select("url", "retrieved", "name", "price", "seller", "`ships to`")


@query
def candidate_rows(spark, sf_dir):
    return _candidates(spark, sf_dir).select("url", "retrieved", "title", "source_rank", "origin", "name", "price")


@query
def listings_by_row(spark, sf_dir):
    return ls.listings_from_raw(_raw(spark, sf_dir), rules=rl.rules_table(spark, ads.RULES), collapse="row")


@query
def listings_by_field(spark, sf_dir):
    return ls.listings_from_raw(_raw(spark, sf_dir), rules=rl.rules_table(spark, ads.RULES), collapse="fields")


@query
def kept_pages_by_site(spark, sf_dir):
    return jobs.kept_report(_raw(spark, sf_dir))


def _index_hits(spark, sf_dir) -> DataFrame:
    pages = pg.read_pages(pg.decode_pages(_raw(spark, sf_dir)))
    return pages.select(F.struct(*schema.INDEX_PAGE.names).alias("_source"))


INDEX_START = datetime(2023, 2, 10, 17, 10, 0)
INDEX_END = datetime(2023, 2, 11, 21, 0, 0)


@query
def index_scan(spark, sf_dir):
    """Half-open time range and phrase exclusion, over a table."""
    pages = ads.raw_pages(spark, sf_dir)
    read_ = pg.read_pages(pg.decode_pages(pages)).withColumn("at", F.to_timestamp("retrieved"))
    return pg.scan_index(read_, "at", INDEX_START, INDEX_END).select("url", "retrieved", "title")


@query
def index_listings(spark, sf_dir):
    """The index job's listings: one row per URL and two-hour window."""
    rules = rl.rules_table(spark, ads.RULES)
    options = jobs.JobOptions(rules=rules, collapse="fields")
    return jobs.index_listings(_index_hits(spark, sf_dir), INDEX_START, INDEX_END, options).select(
        "url", "title", "retrieved", "name", "image", "price", "location", "image_folder", "image_bucket"
    )


def _segments(spark, sf_dir) -> str:
    """The hits as an index of two loads, in twelve segments."""
    path, hits = shared_folder(spark, "segments"), im.stored(_index_hits(spark, sf_dir), shared_folder(spark, "hits"))
    late = F.col("_source.retrieved") >= "2023-02-10T18"
    for load, part in (("early", hits.where(~late)), ("late", hits.where(late))):
        index.write_index(part, path, load, segments=6)
    return path


@query
def segment_index_scan(spark, sf_dir):
    """Time range and phrase exclusion over a segment index, by a filter on its time."""
    rows = index.read_index(spark, _segments(spark, sf_dir))
    return pg.scan_index(rows, "at", INDEX_START, INDEX_END).select("url", "retrieved", "title")


@query
def segment_index_listings(spark, sf_dir):
    """The index job's listings from a segment index."""
    hits = jobs.indexed_hits(spark, _segments(spark, sf_dir), INDEX_START, INDEX_END)
    options = jobs.JobOptions(rules=rl.rules_table(spark, ads.RULES), collapse="fields")
    return jobs.index_listings(hits, INDEX_START, INDEX_END, options).select(
        "url", "title", "retrieved", "name", "image", "price", "location", "image_folder", "image_bucket"
    )


@query
def hostile_pages(spark, sf_dir):
    """Pages with broken and misleading markup: what is found, and the text a reader sees."""
    pages = pg.read_pages(pg.decode_pages(hostile.raw_pages(spark, sf_dir)))
    last = F.element_at("candidates", -1)
    found = cd.with_candidates(pages).select("url", "text", last.alias("c"))
    return found.select("url", "text", "c.origin", "c.name", "c.price")


# --- dedupe, ranks and sets --------------------------------------------------


@query
def first_documents(spark, sf_dir):
    """First document per normalised text."""
    docs = read(spark, sf_dir, "documents")
    keyed = compute_once(docs, ["doc_id", "lang", "source"], text_key=tx.text_key(F.col("text")))
    return dedupe.first_per(keyed, ["text_key"], [F.col("doc_id")])


@query
def unseen_documents(spark, sf_dir):
    """First documents whose text no English document has."""
    docs = read(spark, sf_dir, "documents")
    keyed = compute_once(docs, ["doc_id", "lang"], text_key=tx.text_key(F.col("text")))
    seen = keyed.where(F.col("lang") == "en").select("text_key").distinct()
    first = dedupe.first_per(keyed, ["text_key"], [F.col("doc_id")])
    return dedupe.not_seen(first, seen)


@query
def error_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    is_error = pg.is_error_text(F.col("text"), ("of the", "et la", "Une"))
    return counts.kept_counts(docs, "source", ~is_error)


@query
def documents_without_phrase(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.where(~pg.has_phrase(F.col("text"), ("Of the", "the And", "ET la"))).select("doc_id", "lang")


def _image_rows(spark, sf_dir) -> DataFrame:
    """Order lines as rows of few URLs, some with an image."""
    lines = read(spark, sf_dir, "lineitem")
    return lines.select(
        F.concat(F.lit("http://x.example.com/"), F.col("l_partkey").cast("string")).alias("url"),
        F.when(F.col("l_linenumber") % 3 == 0, "None")
        .when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("https://i/"), F.col("l_suppkey").cast("string")))
        .when(F.col("l_linenumber") == 2, "  ")
        .alias("image"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rank"),
    )


@query
def image_ranked_rows(spark, sf_dir):
    return cd.image_ranked(_image_rows(spark, sf_dir).fillna("None", ["image"]), "rank")


@query
def rows_with_usable_image(spark, sf_dir):
    return pg.usable_images(_image_rows(spark, sf_dir)).groupBy("image").agg(F.count("*").alias("n_rows"))


@query
def file_states(spark, sf_dir):
    """Files to process, files to repair, by a manifest of earlier runs."""
    files = read(spark, sf_dir, "orders").select(F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("source_file"))
    lines = read(spark, sf_dir, "lineitem").where(F.col("l_quantity") > 40)
    manifest = lines.groupBy("l_orderkey").agg(F.max(F.col("l_returnflag") == "R").alias("has_image_path")).select(
        F.concat(F.lit("f"), F.col("l_orderkey").cast("string")).alias("source_file"), "has_image_path"
    )
    pending, repair = dedupe.split_by_manifest(files, manifest)
    return pending.withColumn("state", F.lit("pending")).unionByName(repair.withColumn("state", F.lit("repair")))


# --- images and places -------------------------------------------------------


def _listings_with_images(spark, sf_dir) -> DataFrame:
    """Listings as the crawl gives them, made from its values without reading pages."""
    v = ads.ad_values(spark, sf_dir)
    image = F.when(F.col("variant") == 0, F.concat(F.lit("https://img.example.com/"), F.col("p_brand"))).when(
        F.col("variant") == 3, F.concat(F.lit("http://img.example.com/"), F.col("p_type"))
    )
    rows = v.select(
        F.concat(F.lit("http://x.example.com/"), F.col("p").cast("string")).alias("url"),
        image.alias("image"),
        F.when(F.col("variant") != 6, F.concat(F.lit("Town "), F.col("p").cast("string"), F.lit(", "), F.col("country"))).alias("location"),
    )
    return rows.withColumn("id", dedupe.listing_id(F.col("url")))


@query
def distinct_images(spark, sf_dir):
    return im.distinct_images(_listings_with_images(spark, sf_dir))


def _store(spark, sf_dir) -> DataFrame:
    """Image store: brands have an image, types have none."""
    part = read(spark, sf_dir, "part")
    return part.select("p_brand").distinct().select(
        F.concat(F.lit("https://img.example.com/"), F.col("p_brand")).alias("image"), F.encode("p_brand", "UTF-8").alias("content")
    )


@query
def listings_with_image_path(spark, sf_dir):
    fetch = im.fetch_from_table(_store(spark, sf_dir), "data_Feb_10/")
    return im.add_images(_listings_with_images(spark, sf_dir), fetch).select("id", "image", "image_path")


@query
def listings_with_stored_image(spark, sf_dir):
    """Only listings with a secure image address, and then only those whose image was found."""
    fetch = im.fetch_from_table(_store(spark, sf_dir), "images-feb")
    secure = pg.with_https_image(_listings_with_images(spark, sf_dir))
    added = im.add_images(secure, fetch, path_column="minio_image_path")
    return pg.with_image_path(added.withColumnRenamed("minio_image_path", "image_path")).select("url", "image_path")


@query
def resolved_locations(spark, sf_dir):
    nation = read(spark, sf_dir, "nation").select(F.col("n_name").alias("name"))
    return places.resolve_locations(_listings_with_images(spark, sf_dir), nation).select("url", "location", "place")


@query
def misspelt_locations(spark, sf_dir):
    """Every customer's location with one edit in the nation's name, or by a region's alternative name."""
    nation, region = (read(spark, sf_dir, t) for t in ("nation", "region"))
    other = nation.join(region, nation.n_regionkey == region.r_regionkey)
    names = nation.select(F.col("n_name").alias("name"), F.col("n_name").alias("place")).unionByName(
        other.select(F.concat_ws(" of ", "n_name", "r_name").alias("name"), F.col("n_name").alias("place"))
    )
    c = read(spark, sf_dir, "customer").join(other, F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.when(F.col("c_custkey") % 3 == 0, F.concat_ws(" of ", "n_name", "r_name")).otherwise(F.col("n_name"))
    at = (F.col("c_custkey") % F.length("name") + 1).cast("int")
    head, tail = F.substring("name", F.lit(1), at - 1), F.substring("name", at + 1, F.length("name"))
    edited = (
        F.when(F.col("c_custkey") % 5 == 0, F.concat(head, tail))
        .when(F.col("c_custkey") % 5 == 1, F.concat(head, F.lit("x"), tail))
        .when(F.col("c_custkey") % 5 == 2, F.concat(head, F.lit("x"), F.substring("name", at, F.length("name"))))
        .otherwise(F.col("name"))
    )
    located = c.withColumn("name", name).select(
        F.col("c_custkey").alias("id"), F.concat_ws(", ", "c_name", edited).alias("location")
    )
    return places.resolve_misspelt(located, names).select(F.col("id").alias("c_custkey"), "location", "place")


# --- classification ----------------------------------------------------------


@query
def top_dimensions(spark, sf_dir):
    """Highest entry of each vector and its place."""
    names = F.sequence(F.lit(0), F.size("embedding") - 1)
    best = vl.best_label(names, F.col("embedding"))
    return read(spark, sf_dir, "embeddings").select(
        "vec_id", best["label"].alias("label"), F.round(best["score"], 5).alias("score")
    )


def _label_vectors(spark, sf_dir) -> DataFrame:
    """Mean vector per label, summed per dimension before the shuffle."""
    entries = read(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = entries.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("vector")
    )


@query
def zero_shot_labels(spark, sf_dir):
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    scored = cl.zero_shot(vectors, "embedding", _label_vectors(spark, sf_dir))
    return scored.select("vec_id", "label_product", F.round("score_product", 6).alias("score_product"))


@query
def zero_shot_text_labels(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("product"))
    return cl.zero_shot_text(docs).select("doc_id", "label_product", F.round("score_product", 6).alias("score_product"))


LANGUAGES = ("de", "en", "es", "fr")


def language_texts(docs: DataFrame) -> DataFrame:
    """Documents as products. Every other one also says the code of its language after each tenth word or so;
    the code stands nowhere else."""
    coded = F.regexp_replace("text", r"((?:\S+\s+){10})", F.concat(F.lit("$1"), F.lit("qq"), "lang", F.lit(" ")))
    return docs.select("doc_id", "lang", F.when(F.col("doc_id") % 2 == 0, coded).otherwise(F.col("text")).alias("product"))


def language_labels(docs: DataFrame) -> DataFrame:
    """Which language's code fits a text, with vectors learnt from all texts."""
    texts = language_texts(docs)
    learnt = word_vectors.learn(texts, "product")
    return cl.zero_shot_text(texts, labels=tuple(f"qq{c}" for c in LANGUAGES), vectors=learnt)


@query
def zero_shot_languages(spark, sf_dir):
    """Per language: texts without its code, and whether 98 in 100 of those of at least 200 characters get it."""
    docs = spread(read(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    # Three passes read them.
    docs = im.stored(docs, shared_folder(spark, "languages"))
    unseen = language_labels(docs).where("doc_id % 2 = 1")
    right = F.when(F.length("product") >= 200, F.col("label_product").eqNullSafe(F.concat(F.lit("qq"), "lang")).cast("int"))
    return unseen.groupBy("lang").agg(F.count("*").alias("n_texts"), (F.avg(right) >= 0.98).alias("found"))


def _quality_texts(spark, sf_dir) -> DataFrame:
    return _labelled(spark, sf_dir).select("doc_id", F.col("text").alias("product"), "quality")


@query
def text_quality_labels(spark, sf_dir):
    docs = _quality_texts(spark, sf_dir)
    model = cl.train_text_model(docs.where(F.col("quality").isNotNull()), "product", "quality")
    return cl.text_labels(docs, model).select("doc_id", "label", F.round("score", 4).alias("score"))


@query
def text_image_quality_labels(spark, sf_dir):
    """Text and vector features of the same number together; rows without a vector have no image."""
    vectors = read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding", F.concat(F.lit("images/"), F.col("vec_id").cast("string")).alias("image_path")
    )
    rows = _quality_texts(spark, sf_dir).join(vectors, "doc_id", "left")
    # Training and scoring pass over the rows several times; the texts meet their vectors once. Neither uses other rows.
    rows = im.stored(rows.where(F.col("image_path").isNotNull()), shared_folder(spark, "text-image"))
    rows = cl.image_vectors(rows.withColumn("embedding", F.col("embedding").cast("array<double>")), "embedding", "image_vector")
    train = rows.where(F.col("quality").isNotNull() & F.col("image_path").isNotNull())
    model = cl.train_text_image_model(train, "product", "image_vector", 64, "quality")
    return cl.text_image_labels(rows, model).select("doc_id", "image_path", "predicted_label")


@query
def custom_scores(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")

    def length_scorer():
        return lambda texts: texts.str.len().astype("int64")

    return docs.select("doc_id", cl.score_with(length_scorer, "bigint", F.col("text")).alias("score"))


@query
def stratified_sample(spark, sf_dir):
    labels = read(spark, sf_dir, "labels")
    return cl.stratified_sample(labels, "quality", "doc_id", {0: 20, 1: 100})


# --- time windows and counts -------------------------------------------------

EVENTS_START = datetime(2024, 1, 3, 1, 30)
EVENTS_END = datetime(2024, 1, 20, 12, 0)


@query
def event_windows(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    counted = windows.window_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", EVENTS_START, EVENTS_END)
    return counted.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "n_rows",
        F.col("sum_value").cast("double").alias("sum_value"),
    )


@query
def events_in_range(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    return pg.in_time_range(events, "ts", EVENTS_START, EVENTS_END).groupBy("event_type").agg(F.count("*").alias("n_rows"))


@query
def date_folders(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return orders.select("o_orderkey", *[c.alias(n) for n, c in sinks.date_names(F.col("o_orderdate")).items()])


@query
def document_count(spark, sf_dir):
    return read(spark, sf_dir, "documents").agg(F.count("*").alias("n_docs"))


@query
def lines_sorted_by_image(spark, sf_dir):
    return _image_rows(spark, sf_dir).orderBy("url", F.col("image").asc_nulls_last(), "rank")


# --- files and jobs ----------------------------------------------------------


@query
def crawl_files_by_run(spark, sf_dir):
    """Crawl files of two runs, written and read back."""
    root = shared_folder(spark, "crawls")
    raw = ads.raw_pages(spark, sf_dir)
    for run in (0, 1):
        part = raw.where(F.col("crawl") == run).drop("p", "variant", "crawl")
        sinks.write_jsonl(part, f"{root}/run{run}/shops/data_pages", compression="deflate")
    runs = readers.read_crawl_runs(spark, root, "shops")
    return runs.select("run", "crawler", "output_prefix", "url", "content_type", "fetch_time")


@query
def listings_through_csv(spark, sf_dir):
    path = shared_folder(spark, "csv")
    rows = _listings_with_images(spark, sf_dir)
    sinks.write_csv(rows, path)
    return readers.read_csv(spark, path, rows.schema)


def _fetch_brands(spark, sf_dir):
    """Brand images are in the store; all others fail."""
    store = _store(spark, sf_dir).withColumn("image", F.concat("image", F.lit(".png")))
    return im.fetch_from_table(store, "data_Feb_10/")


def _crawl_job(spark, sf_dir, files: int, files_per_batch: int):
    root = shared_folder(spark, "job")
    raw = _raw(spark, sf_dir)
    sinks.write_jsonl(raw.repartition(files) if files else raw, f"{root}/in/data_pages", compression="deflate")
    options = jobs.JobOptions(rules=rl.rules_table(spark, ads.RULES), collapse="row", fetch=_fetch_brands(spark, sf_dir))
    jobs.crawl_job(spark, f"{root}/in/data_pages", f"{root}/out", options, files_per_batch)
    return spark.read.parquet(f"{root}/out/listings").drop("batch")


@query
def crawl_job_listings(spark, sf_dir):
    """The whole disk job: crawl files, seen set, listings, image paths, written tables."""
    return _crawl_job(spark, sf_dir, 0, 1000)


@query
def crawl_job_in_batches(spark, sf_dir):
    """The same from three files in three batches: the cut does not change the result."""
    return _crawl_job(spark, sf_dir, 3, 1)


@query
def index_job_overlapping(spark, sf_dir):
    """Two runs of the index job over ranges that overlap: no text is listed twice."""
    target = shared_folder(spark, "index")
    hits, options = _index_hits(spark, sf_dir), jobs.JobOptions(collapse="fields", rules=rl.rules_table(spark, ads.RULES))
    for start, end in ((INDEX_START, datetime(2023, 2, 11, 12)), (datetime(2023, 2, 10, 17, 20), datetime(2023, 2, 14))):
        jobs.index_job(hits, start, end, target, options)
    return spark.read.parquet(f"{target}/listings").groupBy("url").agg(F.count("*").alias("n_rows"))


def _listing_state(spark, sf_dir, collapse: str) -> DataFrame:
    """Pages in three runs, those retrieved last first, so that later runs take texts over."""
    state = incremental.ListingState(spark, shared_folder(spark, "state"), collapse, parts=4, buckets=4)
    rules = rl.rules_table(spark, ads.RULES)
    pages = im.stored(ls.extracted_pages(_ad_pages(spark, sf_dir), rules, collapse), shared_folder(spark, "extracted"))
    # The pages of one text, and of one URL, fall into several runs.
    run = F.pmod(F.length("title") + F.unix_millis(F.to_timestamp("retrieved")), F.lit(3))
    for n in (2, 1, 0):
        state.merge(pages.where(run == n), f"r{n}")
    return state.listings()


@query
def incremental_listings_by_row(spark, sf_dir):
    """Listings kept up to date over three runs: equal to those of one run over all pages."""
    return _listing_state(spark, sf_dir, "row")


@query
def incremental_listings_by_field(spark, sf_dir):
    return _listing_state(spark, sf_dir, "fields")


@query
def crawl_job_in_two_runs(spark, sf_dir):
    """The disk job twice, the second time with more files: listings kept up to date, equal to those of one run."""
    root, raw = shared_folder(spark, "job"), im.stored(_raw(spark, sf_dir), shared_folder(spark, "raw"))
    options = jobs.JobOptions(rules=rl.rules_table(spark, ads.RULES), collapse="row", incremental=True)
    late = F.col("fetch_time") % 3000 > 1000
    for run, part in enumerate((raw.where(late), raw.where(~late))):
        sinks.write_jsonl(part, f"{root}/in/run{run}/shops/data_pages", compression="deflate")
        jobs.crawl_job(spark, f"{root}/in/*/shops/data_pages", f"{root}/out", options)
    return spark.read.parquet(f"{root}/out/listings").drop("batch")


@query
def crawl_job_in_versions(spark, sf_dir):
    """A run without images, one that only adds them, one with more files: the version then in force."""
    root, raw = shared_folder(spark, "job"), im.stored(_raw(spark, sf_dir), shared_folder(spark, "raw"))
    rules, late = rl.rules_table(spark, ads.RULES), F.col("fetch_time") % 3000 > 1000
    for part, fetch in ((raw.where(late), None), (None, _fetch_brands(spark, sf_dir)), (raw.where(~late), _fetch_brands(spark, sf_dir))):
        if part is not None:
            sinks.write_jsonl(part, f"{root}/in/{'first' if fetch is None else 'second'}/shops/data_pages", compression="deflate")
        options = jobs.JobOptions(rules=rules, collapse="row", incremental=True, versioned=True, fetch=fetch)
        jobs.crawl_job(spark, f"{root}/in/*/shops/data_pages", f"{root}/out", options)
    return versions.read(spark, f"{root}/out").drop("batch")
