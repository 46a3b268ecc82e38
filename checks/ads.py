"""Crawl records derived from `part`, `supplier` and `nation`, one page per part.

`variant` = part key % 12 sets what the page holds:
0 JSON-LD, one offer        1 JSON-LD, two offers       2 JSON-LD, low and high price
3 OpenGraph                 4 microdata, image list     5 microdata and OpenGraph, crawled twice
6 text only                 7 error page                8 text of the variant 6 page before it
9 auction site, Latin-1     10 site with rules          11 Dublin Core
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from adgleaner.operators.rules import Rule
from adgleaner.operators.shape import compute_once, spread

RULES = [
    Rule("gumtree", "product", r'(?s)<h1 class="item-title">(.*?)</h1>'),
    Rule("gumtree", "price", r'<span class="amount">([^<]*)</span>'),
    Rule("gumtree", "ships to", r'<td class="ships">([^<]*)</td>'),
    Rule("gumtree", "seller", r'<a class="owner">([^<]*)</a>'),
    Rule("elsewhere", "product", r"<h1>(.*?)</h1>"),
]

FIRST_FETCH = 1_676_048_703_245


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pages are made of, one row per page."""
    part, supplier, nation = (read(spark, sf_dir, t) for t in ("part", "supplier", "nation"))
    suppliers = supplier.agg(F.count("*").alias("n")).scalar()
    return (
        spread(part).select(
            F.col("p_partkey").alias("p"),
            F.expr("p_partkey % 12").alias("variant"),
            "p_name",
            "p_brand",
            "p_type",
            F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("price"),
            (F.col("p_partkey") % suppliers).alias("s_suppkey"),
        )
        .join(supplier.select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey")
        .join(
            nation.select(
                F.col("n_nationkey").alias("s_nationkey"),
                F.expr("CASE n_nationkey WHEN 0 THEN 'US' WHEN 1 THEN 'GB' ELSE n_name END").alias("country"),
            ),
            "s_nationkey",
        )
        .withColumn("crawl", F.expr("explode(sequence(0, CASE WHEN variant = 5 THEN 1 ELSE 0 END))"))
    )


_URL = """
concat('https://www.', CASE variant WHEN 9 THEN 'ebay' WHEN 10 THEN 'gumtree'
       ELSE concat('shop', p % 7) END, '.example.com:8080/item/', p)
"""

# Page bodies. $x stands for the value x.
_PAGES = {
    0: """<html><head><title>$p_name $p</title><script type="application/ld+json">
{"@type":"Product","name":"$p_name $p","description":"$p_type item","category":"$p_brand",
"productionDate":"2020","image":"https://img.example.com/$p_brand.png",
"offers":{"price":"US $$price","priceCurrency":"USD","seller":{"name":"$s_name","@type":"Organization",
"url":"https://sellers.example.com/$s_suppkey","address":{"addressCountry":"$country"}}}}
</script></head><body><p>JSON-LD page $p</p></body></html>""",
    1: """<html><head><title>$p_name $p</title><script type='application/ld+json'>
[{"@type":"Product","name":"$p_name $p","image":["https://img.example.com/a$p.png","x"],
"offers":[{"price":"1.00","priceCurrency":"EUR","seller":{"name":"$s_name","@type":"Person",
"address":{"addressCountry":"$country"}}},{"price":$price,"priceCurrency":["USD","EUR"]}]},
{"@type":["Product"],"name":"not taken"}]
</script></head><body><p>Two offers page $p</p></body></html>""",
    2: """<html><head><title>$p_name $p</title><script type="application/ld+json">
{"@type":"Product","name":"$p_name $p","image":{"contentUrl":"","url":"https://img.example.com/u$p.png"},
"offers":{"lowPrice":"$$price","highPrice":"USD 1$price"}}
</script><script type="application/ld+json">{broken</script></head>
<body><p>Low and high page $p</p></body></html>""",
    3: """<html><head><title>$p_name $p</title>
<meta property="og:title" content="$p_name &amp; co $p"/><meta property='og:image' content='https://img.example.com/$p_type.png'>
<meta property="og:image" content="https://img.example.com/second.png"><meta content="$price" property="product:price:amount">
<meta property="product:price:currency" content="USD"><meta property="og:description" content="OpenGraph $p_type">
<meta property="product:category" content="$p_brand"><meta property="og:see_also" content="https://sellers.example.com/$s_suppkey">
</head><body><p>OpenGraph page $p</p></body></html>""",
    4: """<html><head><title>$p_name $p</title></head><body><div itemscope itemtype="http://schema.org/Product">
<span itemprop="name">$p_name <b>$p</b></span><img itemprop="image" src="/m/$p.png"><img itemprop="image" src="/m/other.png">
<meta itemprop="category" content="$p_brand"><div itemprop="offers" itemscope itemtype="http://schema.org/Offer">
<span itemprop="price" content="$price">about $price</span><meta itemprop="priceCurrency" content="GBP">
<div itemprop="seller" itemscope itemtype="http://schema.org/Organization"><span itemprop="name">$s_name</span>
<div itemprop="address" itemscope><span itemprop="addressCountry">$country</span></div></div></div></div>
<p>Microdata page $p</p></body></html>""",
    5: """<html><head><title>$p_name $p</title><meta property="og:title" content="og $p">
<meta property="og:image" content="https://img.example.com/$crawl/$p.png"></head><body>
<div itemscope itemtype="https://schema.org/Product"><span itemprop="name">micro $p_name $p</span>
<span itemprop="description">crawl $crawl</span><span itemprop="price">$price</span>
<div itemprop="seller" itemscope itemtype="https://schema.org/Person"><span itemprop="name">$s_name</span>
<a itemprop="url" href="/seller/$s_suppkey">shop</a></div></div><p>Both page $p crawl $crawl</p></body></html>""",
    6: "<html><head><title>Lot $p</title></head><body><p>Plain page $p</p></body></html>",
    7: "<html><head><title>$p_name $p</title></head><body><p>Item Not found $p</p></body></html>",
    8: "<html><head><title>  LOT $q</title></head><body><p>PLAIN page $q</p>\n\t</body></html>",
    9: """<html><head><meta charset="iso-8859-1"><title>Café $p</title></head><body><p>Auction page $p été</p>
<div class="ux-seller-section__item--seller x"><a href="/u"><span> $s_name </span><span>(7)</span></a></div>
<div class="ux-labels-values col-12 ux-labels-values--itemLocation"><div>Located in:</div><div><span> Town $p, $country</span></div></div>
</body></html>""",
    10: """<html><head><title>$p_name $p</title></head><body><h1 class="item-title">$p_name <i>$p</i></h1>
<span class="amount">$price EUR</span><a class="owner">$s_name</a><table><tr><td class="ships">$country</td></tr></table></body></html>""",
    11: """<html><head><title>$p_name $p</title><meta name="DC.title" content="x"><meta name="description" content="plain">
<meta name="description" content="Core $p_type" price="$price" currency="USD" category="$p_brand"></head>
<body><p>Dublin page $p</p></body></html>""",
}


def _filled(template: str) -> str:
    """SQL concat of a template; `$$` before a value keeps one dollar sign."""
    names = {
        "$price": "price", "$p_name": "p_name", "$p_brand": "p_brand", "$p_type": "p_type",
        "$s_name": "s_name", "$s_suppkey": "s_suppkey", "$country": "country", "$crawl": "crawl",
        "$q": "(p - 2)", "$p": "p",
    }
    sql = "'" + template.replace("\\", "\\\\").replace("'", "\\'").replace("$$", "\x00$") + "'"
    for name, value in names.items():
        sql = sql.replace(name, f"', {value}, '")
    return f"concat({sql})".replace("\x00", "$")


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_PAGE rows plus `p`, `variant` and `crawl`."""
    html = "CASE variant " + " ".join(f"WHEN {v} THEN {_filled(t)}" for v, t in _PAGES.items()) + " END"
    content = f"base64(CASE WHEN variant = 9 THEN encode({html}, 'ISO-8859-1') ELSE encode({html}, 'UTF-8') END)"
    return compute_once(
        ad_values(spark, sf_dir),
        ["p", "variant", "crawl"],
        url=F.expr(_URL),
        content=F.expr(content),
        content_type=F.lit("text/html; charset=utf-8"),
        fetch_time=F.expr(f"{FIRST_FETCH}L + p * 1000L + crawl * 100000000L"),
    )
