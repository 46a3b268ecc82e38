"""Column functions that decode and read web pages."""

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

from adgleaner.functions.charsets import CharsetModel
from adgleaner.functions.text import unescape

# Executors need no copy of this module: the helper travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CP1252_NAMES = ("windows-1252", "cp1252")
LATIN9_NAMES = ("iso-8859-15", "latin-9")

# Windows-1252 and ISO-8859-15 where they differ from ISO-8859-1.
CP1252_HIGH = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†",
    0x87: "‡", 0x88: "ˆ", 0x89: "‰", 0x8A: "Š", 0x8B: "‹", 0x8C: "Œ",
    0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•",
    0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›",
    0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
LATIN9 = {
    0xA4: "€", 0xA6: "Š", 0xA8: "š", 0xB4: "Ž",
    0xB8: "ž", 0xBC: "Œ", 0xBD: "œ", 0xBE: "Ÿ",
}


def page_bytes(content: Column) -> Column:
    """Bytes of a base64 text; NULL if the text is not valid base64."""
    return F.try_to_binary(content, F.lit("base64"))


def declared_charset(as_latin1: Column) -> Column:
    """First charset a page names, in lower case; an empty text if none is."""
    return F.lower(F.regexp_extract(as_latin1, r"(?i)charset\s*=\s*[\"']?\s*([A-Za-z0-9_-]+)", 1))


@F.arrow_udf(T.StringType())
def _decode_as(content: pa.Array, charset: pa.Array) -> pa.Array:
    def one(b: bytes | None, name: str | None) -> str | None:
        try:
            return None if b is None else b.decode(name, "replace")
        except LookupError:
            return None

    return pa.array([one(b, n) for b, n in zip(content.to_pylist(), charset.to_pylist())], pa.string())


def decode_page(b: Column, model: CharsetModel | None = None) -> Column:
    """Text of page bytes: UTF-8 if valid, else by byte order mark or declared charset, else Latin-1.

    With a model, pages that declare no charset are in the one it finds. Charsets that SQL
    does not decode are decoded in Python, and only pages that are not UTF-8 and declare
    one, or are to be guessed, leave the JVM for it.
    """
    utf8 = b.cast("string")
    latin1 = F.decode(b, "ISO-8859-1")
    charset = declared_charset(latin1)

    def with_table(table: dict[int, str]) -> Column:
        return F.translate(latin1, "".join(map(chr, table)), "".join(table.values()))

    two_bytes = F.hex(F.substring(b, 1, 2))
    utf16 = two_bytes.isin("FFFE", "FEFF") & (F.length(b) % 2 == 0)
    plain = charset.isin("", "iso-8859-1", "latin-1", "latin1", "us-ascii", "utf-8", "utf8", *CP1252_NAMES, *LATIN9_NAMES)
    other = ~F.is_valid_utf8(utf8) & ~utf16 & ~plain
    named = F.when(other, charset)
    if model:
        unnamed = ~F.is_valid_utf8(utf8) & ~utf16 & (charset == "")
        named = F.coalesce(named, model.detect(F.when(unnamed, b)))
        other |= unnamed
    return (
        F.when(F.is_valid_utf8(utf8), utf8)
        .when(utf16, F.decode(b, "UTF-16"))
        .when(charset.isin(*CP1252_NAMES), with_table(CP1252_HIGH))
        .when(charset.isin(*LATIN9_NAMES), with_table(LATIN9))
        .otherwise(F.coalesce(_decode_as(F.when(other, b), named), latin1))
    )


def page_kind(content_type: Column) -> Column:
    """Which reader a content type asks for; NULL for none."""
    return (
        F.when(content_type.contains("text/xml"), F.lit("xml"))
        .when(content_type.contains("text/html"), F.lit("html.parser"))
        .when(content_type.contains("x-asp") | content_type.contains("xhtml+xml"), F.lit("lxml"))
        .when(content_type.contains("text/plain"), F.lit("plain"))
    )


_UNSEEN = (
    r"(?is)<script\b[^>]*+(?:>|\z).*?(?:</script\s*>|\z)"
    r"|<style\b[^>]*+(?:>|\z).*?(?:</style\s*>|\z)"
    r"|<!--.*?(?:-->|\z)"
)
# What follows a tag's name: a quote opens a value only right after an equals sign.
TAG_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+"""
# An unfinished tag runs to the end, so that no part of a page is scanned twice.
_TAG = rf"<[a-zA-Z/!?]{TAG_REST}(?:>|\z)"


def markup_text(html: Column) -> Column:
    """Text between the tags, character references resolved."""
    return unescape(F.regexp_replace(html, _TAG, ""))


def without_markup(html: Column) -> Column:
    """All a reader sees, without scripts, styles, comments and tags; references are left."""
    return F.regexp_replace(F.regexp_replace(html, _UNSEEN, ""), _TAG, "")


def page_text(html: Column) -> Column:
    """All text a reader sees."""
    return unescape(without_markup(html))


def title_markup(html: Column) -> Column:
    """Content of the first title, references left; an empty text if there is none."""
    return F.regexp_extract(html, r"(?is)<title\b[^>]*+(?:>|\z)(.*?)(?:</title\s*>|\z)", 1)


def page_title(html: Column) -> Column:
    """Text of the first title; NULL if there is none or it is empty."""
    return F.nullif(unescape(title_markup(html)), F.lit(""))


def domain(url: Column) -> Column:
    """Host and port with every `www.` removed; NULL for a URL without one.

    Cut by pattern: crawled paths and queries hold characters that no URL parser accepts.
    """
    authority = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\\s]+)(?=[/?#\\]|\s*$)", 1)
    return F.nullif(F.replace(authority, F.lit("www."), F.lit("")), F.lit(""))


def site(domain_: Column) -> Column:
    """Domain up to its first dot."""
    return F.split_part(domain_, F.lit("."), F.lit(1))


def retrieved(fetch_time: Column) -> Column:
    """ISO time of epoch milliseconds in UTC, whatever the time zone of the session."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(fetch_time / 86_400_000).cast("int"))
    rest = F.pmod(fetch_time, F.lit(86_400_000))

    def digits(unit: int, of: int, width: int) -> Column:
        return F.lpad(F.floor(rest / unit % of).cast("string"), width, "0")

    clock = F.concat_ws(":", digits(3_600_000, 24, 2), digits(60_000, 60, 2), digits(1000, 60, 2))
    return F.concat(day.cast("string"), F.lit("T"), clock, F.lit("."), digits(1, 1000, 3), F.lit("+0000"))
