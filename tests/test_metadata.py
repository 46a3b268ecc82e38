"""Metadata extractors: one small page per branch."""

import json
import time

import pytest
from pyspark.sql import functions as F

from adgleaner.operators import metadata as md, rules as rl
from adgleaner.operators.markup import page_tree, read_tree
from adgleaner.operators.shape import compute_once
from checks import hostile


def json_ld(spark, *items, body=None):
    html = "".join(f'<script type="application/ld+json">{b}</script>' for b in (body or [json.dumps(i) for i in items]))
    df = spark.createDataFrame([(html,)], "html string")
    found = df.select(F.explode(md.json_ld_products(md.json_ld_items(md.json_ld_bodies(F.col("html"))))).alias("c")).select("c.*")
    return [r.asDict() for r in found.collect()]


def product(**fields):
    return {"@type": "Product", **fields}


def test_json_ld_type_is_exact(spark):
    found = json_ld(
        spark, product(name="a"), {"@type": ["Product"], "name": "b"}, {"@graph": [product(name="c")]}, {"name": "d"}
    )
    assert [c["name"] for c in found] == ["a"]


def test_json_ld_list_counts_item_by_item_and_broken_scripts_are_passed_over(spark):
    found = json_ld(spark, body=[json.dumps([product(name="a"), product(name="b")]), "{broken", "\n" + json.dumps(product(name="c"))])
    assert [c["name"] for c in found] == ["a", "b", "c"]


def test_json_ld_text_over_two_lines(spark):
    found = json_ld(spark, body=['{"@type":"Product","name":"a\nb"}'])
    assert [c["name"] for c in found] == ["a b"]


@pytest.mark.parametrize(
    "image, address",
    [
        ("u", "u"),
        ({"contentUrl": "c", "url": "u"}, "c"),
        ({"contentUrl": "", "url": "u"}, "u"),
        ({"w": 1}, '{"w":1}'),
        (["a", "b"], "a"),
        ([{"url": "u"}, "b"], "u"),
        ([], None),
        (None, None),
    ],
)
def test_json_ld_image(spark, image, address):
    assert json_ld(spark, product(image=image))[0]["image"] == address


@pytest.mark.parametrize(
    "offers, price, currency",
    [
        ({"price": "$5", "priceCurrency": "USD"}, 5.0, "USD"),
        ({"price": 5, "priceCurrency": ["USD", "EUR"]}, 5.0, "USD, EUR"),
        ({"lowPrice": "10", "highPrice": 20}, 15.0, None),
        ({"lowPrice": None, "highPrice": "20"}, 20.0, None),
        ({}, None, None),
        ([{"price": 1, "priceCurrency": "A"}, {"price": 2}], 2.0, None),
        ([{"price": 1}, {"lowPrice": 3, "highPrice": 5}], 4.0, None),
        ([{"price": 1}, "text"], 1.0, None),
        ("text", None, None),
        (None, None, None),
    ],
)
def test_json_ld_offers(spark, offers, price, currency):
    found = json_ld(spark, product(offers=offers))[0]
    assert (found["price"], found["currency"]) == (price, currency)


def test_json_ld_seller_and_location_of_different_offers(spark):
    found = json_ld(
        spark,
        product(
            offers=[
                {"seller": {"name": "a", "@type": "P", "url": "u", "address": {"addressCountry": "US"}}},
                {"seller": {"name": "b"}},
                {"price": 3},
            ]
        ),
    )[0]
    assert (found["seller"], found["seller_type"], found["seller_url"]) == ("b", None, None)
    assert (found["location"], found["price"]) == ("US", 3.0)


def microdata(spark, item):
    df = spark.createDataFrame([([json.dumps(item)],)], "items array<string>")
    return df.select(F.explode(md.microdata_products(F.col("items"))).alias("c")).select("c.*").first().asDict()


def test_microdata_needs_no_type_and_has_no_url_rung(spark):
    assert microdata(spark, {"name": "a", "image": {"url": "u"}})["image"] == '{"url":"u"}'
    assert microdata(spark, {"image": [{"contentUrl": "c"}]})["image"] == "c"


def test_microdata_later_objects_overwrite(spark):
    inner = {"price": 1, "priceCurrency": "A", "seller": {"name": "inner", "address": {"addressCountry": "X"}}}
    outer = {"priceCurrency": "B", "seller": {"name": "outer"}}
    found = microdata(spark, {"price": 9, "mainEntity": {"offers": inner}, "offers": outer})
    assert (found["price"], found["currency"], found["seller"], found["location"]) == (1.0, "B", "outer", "X")
    found = microdata(spark, {"offers": {"price": 2}, "seller": {"name": "top", "url": "u"}, "mainEntity": {"offers": inner}})
    assert (found["price"], found["currency"]) == (2.0, None)
    assert (found["seller"], found["seller_url"], found["location"]) == ("top", "u", "X")


def test_microdata_offer_list(spark):
    offers = [{"price": 1, "priceCurrency": "A", "seller": {"name": "s", "address": {"addressCountry": "X"}}}, {"price": 2}]
    found = microdata(spark, {"offers": offers})
    assert (found["price"], found["currency"], found["seller"], found["location"]) == (1.0, "A", "s", "X")
    found = microdata(spark, {"price": "7", "offers": offers, "seller": {"name": "top"}})
    assert (found["price"], found["currency"], found["seller"], found["location"]) == (7.0, None, "top", None)


def test_microdata_item_price(spark):
    assert microdata(spark, {"price": "7"})["price"] == 7.0
    assert microdata(spark, {"price": "7", "offers": {"priceCurrency": "A"}})["price"] == 7.0


def metas(spark, html, products):
    df = spark.createDataFrame([(html,)], "html string").select(md.meta_elements(F.col("html")).alias("m"))
    return [r.asDict() for r in df.select(F.explode(products(F.col("m"))).alias("c")).select("c.*").collect()]


def test_open_graph(spark):
    html = """<meta property="og:title" content="A &amp; B's"><META content='x "y"' property='og:description'>
    <meta property=og:image content=first><meta property="og:image" content="second">
    <meta property="product:price:amount" content="1,000.50"/>"""
    (found,) = metas(spark, html, md.open_graph_products)
    assert (found["name"], found["description"], found["image"], found["price"]) == ("A & B's", 'x "y"', "first", 1000.5)


def test_open_graph_without_fields_still_gives_a_row(spark):
    (found,) = metas(spark, '<meta property="og:type" content="x">', md.open_graph_products)
    assert [v for k, v in found.items() if k != "origin"] == [None] * 12
    assert metas(spark, '<meta name="x" content="y">', md.open_graph_products) == []
    assert metas(spark, "no metadata", md.open_graph_products) == []


def test_dublin_core_takes_the_last_priced_description(spark):
    html = """<meta name="description" content="no price"><meta name="description" content="a" price="1" currency="X">
    <meta name="dc.description" content="b" price="2"><meta name="title" content="c" price="3">"""
    (found,) = metas(spark, html, md.dublin_core_products)
    assert (found["name"], found["description"], found["price"], found["currency"]) == ("description", "b", 2.0, None)
    assert metas(spark, '<meta name="description" content="no price">', md.dublin_core_products) == []


def test_tree_values():
    html = """<div itemscope itemtype="http://schema.org/Product"><b itemprop=name>a <i>b</i>
    c</b><a itemprop="url" href="../x">l</a><link itemprop="availability" href="http://s/InStock">
    <time itemprop="productionDate" datetime="2020">then</time><span itemprop="price" content="5">five</span>
    <img itemprop="image" src="1.png"><img itemprop="image" src="2.png"><script>no</script>
    <div itemprop="offers" itemscope><meta itemprop="price" content="6"><br></div>
    <div itemscope><p itemprop="name">own item</p></div></div>"""
    items = [json.loads(i) for i in read_tree(html, "http://h/d/p")[0]]
    assert items[0] == {
        "@context": "http://schema.org", "@type": "Product", "name": "a b c", "url": "http://h/x",
        "availability": "http://s/InStock", "productionDate": "2020", "price": "5",
        "image": ["http://h/d/1.png", "http://h/d/2.png"], "offers": {"price": "6"},
    }
    assert items[1] == {"name": "own item"}


def test_tree_survives_unclosed_elements():
    assert [json.loads(i) for i in read_tree("<div itemscope><p itemprop=name>a<p itemprop=category>b", "")[0]] == [
        {"category": "b", "name": "a"}
    ]


def test_tree_of_hostile_pages():
    assert json.loads(read_tree('<div itemScope><a itemprop=url href="http://[x">q</a></div><![foo[x]]>', "")[0][0]) == {"url": "http://[x"}
    named = '<div itemscope itemref="x y"><b itemprop=a>1</b></div><div id=x><b itemprop=name>found</b></div>'
    assert json.loads(read_tree(named, "")[0][0]) == {"a": "1", "name": "found"}
    assert json.loads(read_tree("<table itemscope><tr><td itemprop=a>1<td itemprop=b>2<tr><td itemprop=c>3</table>", "")[0][0]) == {
        "a": "1", "b": "2", "c": "3",
    }
    assert read_tree("<div id=a><div itemprop=x itemscope itemref=a></div></div><div itemscope itemref=a></div>", "")[0] == []
    # Stray end tags cost no look at the stack.
    assert len(read_tree("<div itemscope>" + "<b>" * 30_000 + "</i>" * 30_000, "")[0]) == 1


def test_metadata_of_hostile_pages(spark):
    ld = '<script type="application/Ld+Json">%s</script>'
    rows = {
        ld % '{"@type":"Product","name":"n","offers":{"price":1.5e7}}': [("n", 15000000.0)],
        ld % '{"@type":"Product","name":"n","offers":{"price":-5}}': [("n", -5.0)],
        "<!-- " + ld % '{"@type":"Product","name":"dead"}' + " -->" + ld % '{"@type":"Product","name":"live"}': [("live", None)],
        ld % '<!-- {"@type":"Product","name":"wrapped"} -->': [("wrapped", None)],
        ld % '{"@type":"Product","name":"a","name":"b"}': [("b", None)],
        '<meta name="description" content="Our price = 5 only">': [],
        '<meta content="a property=b c" property="og:title">': [("a property=b c", None)],
        '<!-- <meta property="og:title" content="dead"> --><META Property=\'og:title\' content=live>': [("live", None)],
        '<script>"<meta property=og:title content=js>"</script>': [],
        "<meta " + "a " * 2000 + ">": [],
        "<meta property" + " a" * 100_000: [],
    }
    pages = spark.createDataFrame([(h,) for h in rows], "html string")
    bodies = pages.select("html", md.json_ld_bodies(F.col("html")).alias("b"))
    trees = bodies.withColumn("t", page_tree(F.col("html"), F.lit("u"), F.lit("s"), md.unparsed(F.col("b"))))
    cut = compute_once(trees, ["html"], ld=md.json_ld_items(F.coalesce("t.bodies", "b")), metas=md.meta_elements(F.col("html")))
    found = compute_once(
        cut, ["html"], c=F.concat(md.json_ld_products(F.col("ld")), md.open_graph_products(F.col("metas")), md.dublin_core_products(F.col("metas")))
    )
    got = {r.html: [(c["name"], c["price"]) for c in r.c] for r in found.collect()}
    assert got == rows


def test_site_blocks():
    html = """<div class="a ux-seller-section__item--seller"><p>x</p><a><span> bob </span><span>no</span></a></div>
    <div class="ux-labels-values col-12 ux-labels-values--itemLocation"><div>Item: located:</div><div> York, UK </div></div>"""
    assert read_tree(html, "")[1:] == ("bob", "Item: located: York, UK ")
    assert read_tree("<p>x</p>", "") == ([], None, None)


def test_site_seller_only_on_its_site(spark):
    df = spark.createDataFrame(
        [("ebay", "s", "Located in: York "), ("myebay", None, None), ("shop", "s", "l")], "site string, s string, l string"
    )
    got = df.select(md.site_seller_products(F.col("site"), F.col("s"), F.col("l")).alias("c")).collect()
    assert [[(c.seller, c.location) for c in r.c] for r in got] == [[("s", "York")], [("", "")], []]


def test_rules(spark):
    rules = rl.rules_table(
        spark,
        [
            rl.Rule("etsy", "product", r"<h1>(.*?)</h1>"), rl.Rule("etsy", "price", r"<b>(.*?)</b>"),
            rl.Rule("etsy", "ships to", r"to (\w+)"), rl.Rule("unknown", "name", "(.*)"),
        ],
    )
    pages = spark.createDataFrame(
        [("etsy", "<h1>a <i>&amp;</i> b</h1><b>$ 5</b>to Peru"), ("etsy", "nothing"), ("unknown", "<h1>x</h1>")],
        "site string, html string",
    )
    got = rl.with_rules(pages, rules).select("html", rl.rule_products(F.col("html"), F.col("rules")).alias("c"))
    found = {r.html: [(c["name"], c["price"], c["ships to"]) for c in r.c] for r in got.collect()}
    # A site needs nothing but its rules to have them.
    assert found["<h1>x</h1>"] == [("x", None, None)]
    assert found["nothing"] == [(None, None, None)]
    assert [v for k, v in found.items() if k.startswith("<h1>a")] == [[("a & b", 5.0, "Peru")]]


def test_repeated_keys_need_no_session_setting(spark):
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") == "false"
    body = '{"@type":"Product","name":"a","name":"b","offers":{"price":1,"price":"2,5","price":"3.5"}}'
    html = f'<script type="application/ld+json">{body}</script>' + '<script type="application/ld+json">{"@type":"Product","name":"c"}</script>'
    pages = spark.createDataFrame([(html,)], "html string")
    bodies = pages.select("html", md.json_ld_bodies(F.col("html")).alias("b"))
    tree = page_tree(F.col("html"), F.lit("u"), F.lit("s"), md.unparsed(F.col("b")))
    items = bodies.select("b", tree.alias("t")).select(md.json_ld_items(F.coalesce("t.bodies", "b")).alias("i"))
    got = items.select(F.explode(md.json_ld_products(F.col("i"))).alias("c")).select("c.name", "c.price").collect()
    assert [tuple(r) for r in got] == [("b", 3.5), ("c", None)]


def test_open_paragraphs_take_linear_time():
    def seconds(n):
        page = "<div itemscope><p><button>" + "<b>" * n + "<div>" * n
        start = time.perf_counter()
        read_tree(page, "")
        return time.perf_counter() - start

    seconds(1000)
    once, twice = min(seconds(20_000) for _ in range(3)), min(seconds(40_000) for _ in range(3))
    assert twice < 3 * once and twice < 5


def test_hostile_pages_are_dealt_to_all_cores(spark, tmp_path):
    """One small file of parts makes pages for every core to read."""
    spark.range(100).selectExpr("id AS p_partkey", "'n' AS p_name").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    pages = hostile.raw_pages(spark, str(tmp_path))
    assert pages.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert pages.count() == 100


def test_parts_of_an_item_are_read_once(spark):
    """Within a lambda Spark computes an expression as often as it is written."""
    for made in (md.json_ld_candidate, md.microdata_candidate):
        written = str(made(F.col("item")))
        assert written.count("'$.offers'") <= 2 and written.count("'$.image'") == 1
