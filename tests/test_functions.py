"""Column functions, one literal case per branch."""

import base64

import pytest
from pyspark.sql import functions as F

from adgleaner.functions import text as tx, values as vl, web


def one(rows, value, f, dtype="string"):
    return rows(f"c {dtype}", [(value,)], f(F.col("c")).alias("r"))[0][0]


@pytest.mark.parametrize(
    "text, number",
    [
        ("US $1,234.50", 1234.5), ("12,50", 1250.0), ("free", None), ("1.2.3", None), (".", None),
        (None, None), ("", None), ("900", 900.0), ("1.", 1.0), (".5", 0.5),
    ],
)
def test_price(rows, text, number):
    assert one(rows, text, vl.price) == number


@pytest.mark.parametrize(
    "texts, mean",
    [
        (["$10", "$20"], 15.0), ([None, "5"], 5.0), ([], None), (["10", "20"], 15.0),
        (["free", "1.2.3"], None), (None, None),
    ],
)
def test_price_list(rows, texts, mean):
    assert one(rows, texts, vl.mean_price, "array<string>") == mean


def test_currency(rows):
    assert one(rows, ["USD", "EUR"], vl.currency, "array<string>") == "USD, EUR"
    assert one(rows, ["USD"], vl.currency, "array<string>") == "USD"
    assert one(rows, None, vl.currency, "array<string>") is None


@pytest.mark.parametrize(
    "raw, named", [("None", None), ("US", "USA"), ("GB", "Great Britain"), ("us", "us"), ("Paris", "Paris"), (None, None)]
)
def test_location(rows, raw, named):
    assert one(rows, raw, vl.location) == named


@pytest.mark.parametrize(
    "url, domain",
    [
        ("https://www.shop.com:80/x", "shop.com:80"), ("http://a b/c", None), ("http://www.a.www.b/", "a.b"),
        ("https://m.Site.com/", "m.Site.com"),
    ],
)
def test_domain(rows, url, domain):
    assert one(rows, url, web.domain) == domain


def test_site(rows):
    assert one(rows, "m.site.com", web.site) == "m"
    assert one(rows, "localhost", web.site) == "localhost"


def test_retrieved(rows):
    assert one(rows, 1676048703245, web.retrieved, "bigint") == "2023-02-10T17:05:03.245+0000"


def test_base64(rows):
    assert one(rows, "!!x", web.page_bytes) is None
    assert one(rows, base64.b64encode(b"abc").decode(), web.page_bytes) == b"abc"


@pytest.mark.parametrize(
    "raw, text",
    [
        ("é".encode("latin-1"), "é"),
        ("é€".encode(), "é€"),
        (b'<meta charset="windows-1252">\x80\x99', '<meta charset="windows-1252">€™'),
        (b"<meta charset=iso-8859-15>\xa4", "<meta charset=iso-8859-15>€"),
        ("aé".encode("utf-16"), "aé"),
        (b"plain", "plain"),
    ],
)
def test_charset(rows, raw, text):
    assert one(rows, raw, web.decode_page, "binary") == text


@pytest.mark.parametrize(
    "content_type, kind",
    [
        ("text/xml", "xml"), ("text/html; charset=x", "html.parser"), ("application/x-asp", "lxml"),
        ("application/xhtml+xml", "lxml"), ("text/plain", "plain"), ("image/png", None), (None, None),
    ],
)
def test_page_kind(rows, content_type, kind):
    assert one(rows, content_type, web.page_kind) == kind


@pytest.mark.parametrize(
    "html, text",
    [
        ('<p>a</p><script>var t="</p>";</script>b', "ab"),
        ("<style>p{}</style>x<!-- <p>no</p> -->y", "xy"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ('<a title="x>y">link</a>', "link"),
        ("<a title='x>y' b=\">\">link</a>", "link"),
        ('<p class="odd>text</p>', "text"),
        ("a<script>never closed", "a"),
        ("a&amp;lt; &lt;b&gt; &eacute;&#233;&#xe9; &bogus; &amp", "a&lt; <b> ééé &bogus; &"),
        ("a&nbsp &copy 2020 &#146;&#x80; &lsqb; a&b=1 &#0; &NotEqualTilde;", "a\xa0 © 2020 ’€ [ a&b=1 \ufffd \u2242\u0338"),
        ("<p title=it's>KEEP ME</p><p>don't</p><b>z</b> a>b", "KEEP MEdon'tz a>b"),
        ("<a href=\"x\"\">KEEP ME</a><img alt=\"y>z\"> end", "KEEP ME end"),
        ("x<meta " + "a " * 50_000, "x"),
        ("x" + "<a b=" * 50_000, "x"),
        ("x" + "<script " * 50_000, "x"),
        ("&#0;&#xD800;&#1114112;", "���"),
        ("<!DOCTYPE html><title>t</title>", "t"),
    ],
)
def test_page_text(rows, html, text):
    assert one(rows, html, web.page_text) == text


@pytest.mark.parametrize(
    "html, title",
    [
        ("<title>A &amp; B</title>", "A & B"), ("<TITLE lang='x'> y\n</TITLE>", " y\n"), ("<title></title>", None),
        ("<p>none</p>", None), ("<title>first</title><title>second</title>", "first"),
    ],
)
def test_title(rows, html, title):
    assert one(rows, html, web.page_title) == title


@pytest.mark.parametrize("raw", [" a\t", "\xa0a\n", "　a\x1c", "a"])
def test_strip(rows, raw):
    assert one(rows, raw, tx.strip) == raw.strip() == "a"


def test_text_key_ignores_case_and_blanks(rows):
    assert one(rows, " Abc \n", tx.text_key) == one(rows, "abc", tx.text_key)
    assert one(rows, "ab c", tx.text_key) != one(rows, "abc", tx.text_key)


@pytest.mark.parametrize(
    "broken, fixed",
    [("Ã©", "é"), ("é", "é"), ("€ Ã©", "€ Ã©"), ("plain", "plain"), (None, None), ("", "")],
)
def test_repair(rows, broken, fixed):
    assert one(rows, broken, tx.repair_mojibake) == fixed


def _as_windows(text: str) -> str:
    return "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())


@pytest.mark.parametrize("text", ["it’s", "“é” – 12 €", "naïve Привет", "à Í Ï Ð Ý", "日本語", "👍 ok"])
@pytest.mark.parametrize("layers", [1, 2, 3])
def test_repair_of_layers(rows, text, layers):
    windows = latin = text
    for _ in range(layers):
        windows, latin = _as_windows(windows), latin.encode().decode("latin-1")
    assert one(rows, windows, tx.repair_mojibake) == text
    assert one(rows, latin, tx.repair_mojibake) == text
    assert one(rows, text, tx.repair_mojibake) == text
    # One letter that was right all along, and all stays.
    assert one(rows, windows + " ü", tx.repair_mojibake) == windows + " ü"


@pytest.mark.parametrize("clean", ["café Â", "Â© – right", "Ø 12 €", "ÄÖÜ", "“only quotes”", "â€", "Ã"])
def test_clean_texts_that_look_broken_stay(rows, clean):
    assert one(rows, clean, tx.repair_mojibake) == clean


@pytest.mark.parametrize(
    "title, name, description, text",
    [
        (None, "n", "d", "d"), ("t", None, "d", "t"), ("t", "n", "d", "n"), (None, None, None, ""), ("t", "", "d", ""),
    ],
)
def test_product_text(rows, title, name, description, text):
    got = rows(
        "t string, n string, d string", [(title, name, description)],
        vl.product_text(F.col("t"), F.col("n"), F.col("d")),
    )
    assert got == [(text,)]


def test_label_code(rows):
    assert [one(rows, c, vl.label_code) for c in ("LABEL_0", "LABEL_1", "LABEL_2", None)] == [0, 1, None, None]


@pytest.mark.parametrize(
    "a, sa, b, sb, best",
    [("x", 0.1, None, None, "x"), (None, None, "y", 0.1, "y"), ("x", 0.1, "y", 0.2, "y"), ("x", 0.2, "y", 0.2, "x"), (None, None, None, None, None)],
)
def test_better_label(rows, a, sa, b, sb, best):
    got = rows(
        "a string, sa double, b string, sb double", [(a, sa, b, sb)],
        vl.better_label(F.col("a"), F.col("sa"), F.col("b"), F.col("sb")),
    )
    assert got == [(best,)]


def test_best_label_takes_the_first_on_a_tie(rows):
    got = rows(
        "l array<string>, s array<double>",
        [(["a", "b", "c"], [0.1, 0.7, 0.7]), ([], []), (["a"], [None])],
        vl.best_label(F.col("l"), F.col("s")).alias("r"),
    )
    assert got[0][0] == (0.7, "b")
    assert got[1][0] == (None, None) and got[2][0] == (None, None)


def test_typed_price_passes_through(rows):
    assert rows("price double", [(2.5,)], vl.listing_row("price")) == [(2.5,)]
    assert rows("price string", [("x",)], vl.listing_row("price")) == [(None,)]


def test_domains_of_any_path(spark):
    urls = ["https://www.shop.com/x|y", "http://shop.com?a={b}", "http://shop.com/a b", "http://shop.com/100%", "http://a b/c", "x"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(web.domain(F.col("u"))).collect()]
    assert got == ["shop.com"] * 4 + [None, None]


def test_declared_charsets(spark):
    names = [("windows-1251", "Привет"), ("shift_jis", "日本"), ("gbk", "中文"), ("euc-kr", "한국"), ("big5", "中文"), ("nonsense", "é")]
    rows = [(f"<meta charset={n}>".encode() + t.encode("latin-1" if n == "nonsense" else n),) for n, t in names]
    got = [r[0].split(">")[1] for r in spark.createDataFrame(rows, "b binary").select(web.decode_page(F.col("b"))).collect()]
    assert got == [t for _, t in names]
