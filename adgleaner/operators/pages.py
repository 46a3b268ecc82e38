"""Raw crawl records to pages, and the row filters on pages."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from adgleaner import constants
from adgleaner.functions import text as tx, web
from adgleaner.operators.shape import compute_once


def is_error_text(text: Column, phrases: Sequence[str] = constants.ERROR_PHRASES) -> Column:
    """True for a missing, empty or error page text; phrases match as written."""
    found = reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])
    return text.isNull() | (text == "") | found


def has_phrase(text: Column, phrases: Sequence[str] = constants.INDEX_EXCLUDED_PHRASES) -> Column:
    """True if the text holds one of the phrases, word by word and in any case."""
    return F.coalesce(text.rlike(tx.phrases_pattern(phrases)), F.lit(False))


def admitted_hits(hits: DataFrame) -> DataFrame:
    """Hits with a payload whose text passes, and bare records with content."""
    text = F.col("_source.text")
    bare = F.col("content").isNotNull() & (F.col("content") != "")
    return hits.where(F.when(F.col("_source").isNotNull(), ~is_error_text(text)).otherwise(bare))


def decode_pages(raw: DataFrame) -> DataFrame:
    """RAW_PAGE rows to pages with `html`; records without a valid page are dropped."""
    named = raw.where(F.col("content").isNotNull() & (F.col("content") != ""))
    carried = [c for c in raw.columns if c not in ("content", "fetch_time")]
    found = compute_once(
        named,
        carried,
        bytes=web.page_bytes(F.col("content")),
        domain=web.domain(F.col("url")),
        retrieved=web.retrieved(F.col("fetch_time")),
    )
    decoded = compute_once(
        found, [*carried, "domain", "retrieved"], html=web.decode_page(F.col("bytes"))
    ).where(F.col("html").isNotNull() & (F.col("html") != ""))
    return decoded.withColumns(
        {"page_kind": web.page_kind(F.col("content_type")), "site": web.site(F.col("domain"))}
    )


def read_pages(pages: DataFrame) -> DataFrame:
    """Add `title`, `text` and `text_key` to rows with `html`, each computed once."""
    # In two steps: resolving references looks at its input several times.
    bare = compute_once(
        pages,
        pages.columns,
        title_=web.title_markup(F.col("html")),
        text_=web.without_markup(F.col("html")),
    )
    texts = compute_once(
        bare,
        pages.columns,
        title=F.nullif(tx.unescape(F.col("title_")), F.lit("")),
        text=tx.unescape(F.col("text_")),
    )
    return texts.withColumn("text_key", tx.text_key(F.col("text")))


def index_hits(hits: DataFrame) -> DataFrame:
    """Search hits to pages: the payload's own title and text, plus `site` and `text_key`."""
    page = hits.select("_source.*")
    return page.withColumns(
        {
            "site": web.site(F.col("domain")),
            "page_kind": web.page_kind(F.col("content_type")),
            "text_key": tx.text_key(F.col("text")),
        }
    )


def admit(pages: DataFrame) -> DataFrame:
    """Drop error pages."""
    return pages.where(~is_error_text(F.col("text")))


def in_time_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows with `start <= ts < end`, as a plain comparison the scan can use."""
    return df.where((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def scan_index(df: DataFrame, ts: str, start, end, text: str = "text") -> DataFrame:
    """Time range plus phrase exclusion, the source predicate of the index job."""
    return in_time_range(df, ts, start, end).where(~has_phrase(F.col(text)))


def with_https_image(df: DataFrame) -> DataFrame:
    return df.where(F.col("image").contains("https"))


def with_image_path(df: DataFrame) -> DataFrame:
    return df.where(F.col("image_path").isNotNull())


def any_column_contains(df: DataFrame, piece: str) -> DataFrame:
    """Rows in which some column holds `piece`."""
    columns = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    return df.where(F.exists(columns, lambda c: F.coalesce(c.contains(piece), F.lit(False))))


def usable_images(df: DataFrame) -> DataFrame:
    """Rows with an image that is not blank, a secure address somewhere, and a web URL."""
    filled = df.where(F.col("image").isNotNull() & (tx.strip(F.col("image")) != ""))
    return any_column_contains(filled, "https:").where(F.col("url").contains("http"))
