"""All candidate listings of a page, and their collapse to one row per URL.

The candidates of a page are one array column, in order of their source:
page alone, site seller, site rules, microdata, OpenGraph, Dublin Core,
JSON-LD. The array never leaves its row: a page is reduced to one candidate
before any shuffle, and only pages that share a URL meet.
"""

from pyspark.sql import Column, DataFrame, functions as F

from adgleaner import schema
from adgleaner.operators import metadata as md, rules as rl
from adgleaner.operators.dedupe import first_per
from adgleaner.operators.markup import page_tree
from adgleaner.operators.shape import compute_once

_FOUND = schema.FOUND_FIELDS
_PAGE_COLUMNS = [*schema.PAGE_FIELDS, "text_key"]


def base_candidate() -> Column:
    """The page alone: nothing found."""
    return md.candidate("page")


def with_candidates(pages: DataFrame, rules: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pages with `candidates` in place of `html`."""
    carried = [*_PAGE_COLUMNS, *keep]
    with_rule = rl.with_rules(pages, rules) if rules is not None else pages.withColumn("rules", F.lit(None))
    bodies = compute_once(with_rule, with_rule.columns, ld_bodies=md.json_ld_bodies(F.col("html")))
    tree = page_tree(F.col("html"), F.col("url"), F.col("site"), md.unparsed(F.col("ld_bodies")))
    parsed = compute_once(
        bodies.withColumn("tree", tree),
        [*carried, "site", "tree"],
        ld_items=md.json_ld_items(F.coalesce("tree.bodies", "ld_bodies")),
        metas=md.meta_elements(F.col("html")),
        by_rule=rl.rule_products(F.col("html"), F.col("rules")) if rules is not None else md.no_candidates(),
    )
    return compute_once(
        parsed,
        carried,
        candidates=F.concat(
            F.array(base_candidate()),
            md.site_seller_products(F.col("site"), F.col("tree.seller_block"), F.col("tree.location_block")),
            F.col("by_rule"),
            md.microdata_products(F.col("tree.items")),
            md.open_graph_products(F.col("metas")),
            md.dublin_core_products(F.col("metas")),
            md.json_ld_products(F.col("ld_items")),
        ),
    )


def candidate_rows(pages: DataFrame) -> DataFrame:
    """One row per candidate, numbered within its page by `source_rank`."""
    numbered = pages.select(
        *_PAGE_COLUMNS, F.posexplode("candidates").alias("source_rank", "candidate")
    )
    return numbered.select(*_PAGE_COLUMNS, "source_rank", "candidate.*")


def _fields(c: Column) -> list[Column]:
    return [c[f].alias(f) for f in _FOUND]


def _first_values(candidates: Column) -> Column:
    """Struct of the first non-NULL value of each field."""
    start = F.get(candidates, 0)
    return F.aggregate(
        F.slice(candidates, 2, 1_000_000_000),
        F.struct(*_fields(start)),
        lambda a, c: F.struct(*[F.coalesce(a[f], c[f]).alias(f) for f in _FOUND]),
    )


def _image_first(candidates: Column) -> Column:
    """The candidate with the smallest image; without one, the first candidate."""
    ranked = F.transform(
        candidates,
        lambda c, i: F.struct(
            c["image"].isNull().alias("no_image"), c["image"].alias("image"), i.alias("i"), c.alias("c")
        ),
    )
    return F.struct(*_fields(F.array_min(ranked)["c"]))


def reduce_pages(pages: DataFrame, collapse: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One candidate per page, flat: the same rule as between the pages of a URL."""
    reduce_one = {"fields": _first_values, "row": _image_first}[collapse]
    one = compute_once(pages, [*_PAGE_COLUMNS, *keep], found=reduce_one(F.col("candidates")))
    return one.select(*_PAGE_COLUMNS, *keep, "found.*")


def collapse_fields(pages: DataFrame, keys: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per URL, the first non-NULL value of each column in order of retrieval."""
    order = F.struct("retrieved", "text_key")
    columns = [c for c in [*schema.PAGE_FIELDS, *_FOUND] if c not in keys]

    def first_value(c: str) -> Column:
        # An order that is NULL takes no part, so NULL values are passed over.
        value = F.col(f"`{c}`")
        return F.min_by(value, F.when(value.isNotNull(), order)).alias(c)

    return pages.groupBy(*keys).agg(*[first_value(c) for c in columns])


def collapse_row(pages: DataFrame, keys: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per URL, the whole row with the smallest image, the one retrieved first on a tie."""
    order = [F.col("image").asc_nulls_last(), F.col("retrieved"), F.col("text_key")]
    return first_per(pages, keys, order).drop("text_key")


def collapse_pages(pages: DataFrame, collapse: str, keys: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per URL (or per `keys`): by field or by row."""
    return {"fields": collapse_fields, "row": collapse_row}[collapse](pages, keys)


def image_ranked(df: DataFrame, order: str) -> DataFrame:
    """One row per URL, rows with an image first; `order` settles the rest."""
    has_no_image = F.when(F.col("image") != "None", 0).otherwise(1)
    return first_per(df, ["url"], [has_no_image, F.col(order)])
