"""Pages to listings: the transformation both jobs share."""

from pyspark.sql import DataFrame, functions as F

from adgleaner import schema
from adgleaner.functions import values
from adgleaner.operators import candidates as cd, dedupe, pages as pg


def extracted_pages(
    pages: DataFrame,
    rules: DataFrame | None = None,
    collapse: str = "row",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Admitted pages with the product fields found on each, without markup.

    All of this is one pass over the scan with no shuffle. Duplicates are
    dropped afterwards, when a row is a fraction of its page.
    """
    return cd.reduce_pages(cd.with_candidates(pg.admit(pages), rules, keep), collapse, keep)


def typed_listings(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Final types, repaired texts, normalised locations, and an id."""
    return df.select(
        *keep,
        *[values.listing_row(c) for c in (*schema.PAGE_FIELDS, *schema.FOUND_FIELDS)],
        dedupe.listing_id(F.col("url")).alias("id"),
    )


def listings(
    pages: DataFrame,
    rules: DataFrame | None = None,
    collapse: str = "row",
    seen: DataFrame | None = None,
) -> DataFrame:
    """One row per URL from pages with `html`, `text` and `text_key`."""
    fresh = dedupe.first_texts(extracted_pages(pages, rules, collapse))
    if seen is not None:
        fresh = dedupe.not_seen(fresh, seen)
    return typed_listings(cd.collapse_pages(fresh, collapse))


def listings_from_raw(raw: DataFrame, **options) -> DataFrame:
    """Listings from RAW_PAGE rows."""
    return listings(pg.read_pages(pg.decode_pages(raw)), **options)
