"""Crawl records with the faults that ordinary crawl pages have, one page per part.

Variant = part key % 10, or 10 where part key % 20 is 10:
0 a `<meta` of 4 KB without a value   1 camel case, a bad link, a broken declaration
2 paragraphs that are never closed    3 JSON-LD in a comment, and a live one
4 a repeated key, a price as 1.5e7    5 an attribute within the value of another
6 references without a semicolon, a stray quote   7 a price within a description
8 a negative price, a hidden script   9 windows-1251
10 an open paragraph behind a button, many inline and block elements
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from adgleaner.operators.shape import spread
from checks.ads import read

_PAGES = {
    0: """concat('<meta ', repeat('a ', 2000), '><meta property="og:title" content="', n, '"><p>page ', p, '</p>')""",
    1: """concat('<div itemScope itemType="http://s.org/P"><a itemprop=url href="http://[x">q</a><b itemprop=name>', n,
          '</b></div> page ', p, '<![foo[x]]>')""",
    2: "concat('<div itemscope><p itemprop=name>', n, '<p itemprop=price>', p, '</div> page ', p)",
    3: """concat('<!-- <script type="application/ld+json">{"@type":"Product","name":"dead"}</script> -->',
          '<script type="application/Ld+Json">{"@type":"Product","name":"live ', p, '"}</script>page ', p)""",
    4: """concat('<script type="application/ld+json">{"@type":"Product","name":"first","name":"second ', p,
          '","offers":{"price":1.5e7}}</script>page ', p)""",
    5: """concat('<meta content="a property=b ', p, '" property="og:title">page ', p)""",
    6: """concat('a&nbsp', p, ' &copy 2020 &#146; <p title=it\\'s>KEEP ', p, '</p><p>don\\'t</p><b></b> a>b')""",
    7: """concat('<meta name="description" content="Our price = 5 only">page ', p)""",
    8: """concat('<script type="application/ld+json"><!-- {"@type":"Product","name":"', n, '","offers":{"price":-', p + 1,
          '}} --></script>page ', p)""",
    10: "concat('<div itemscope><p itemprop=name>', n, '<button>', repeat('<b>', 2000), repeat('<div>', 2000), ' page ', p)",
    9: "concat('<meta charset=windows-1251>@ ', p)",
}


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spread(read(spark, sf_dir, "part")).select(F.col("p_partkey").alias("p"), F.expr("CASE p_partkey % 20 WHEN 10 THEN 10 ELSE p_partkey % 10 END").alias("v"), F.col("p_name").alias("n"))
    html = F.expr("CASE v " + " ".join(f"WHEN {v} THEN {sql}" for v, sql in _PAGES.items()) + " END")
    russian = F.lit("Привет".encode("cp1251"))
    before, after = F.split_part(html, F.lit("@"), F.lit(1)), F.split_part(html, F.lit("@"), F.lit(2))
    content = F.when(
        F.col("v") == 9, F.concat(before.cast("binary"), russian, after.cast("binary"))
    ).otherwise(html.cast("binary"))
    return part.select(
        F.concat(F.lit("https://www.shop.com/"), "p", F.lit("?a={b}|c")).alias("url"),
        F.base64(content).alias("content"),
        F.lit("text/html").alias("content_type"),
        (F.lit(1_676_048_703_245) + F.col("p")).alias("fetch_time"),
    )
