"""Per-site extraction rules: a table of patterns, joined on the site."""

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adgleaner.functions import values, web
from adgleaner.operators.metadata import candidate, no_candidates
from adgleaner.schema import FOUND_FIELDS


class Rule(NamedTuple):
    """`field` of pages of `site` is group `group` of `pattern`."""

    site: str
    field: str
    pattern: str
    group: int = 1


# Field that a rule may call differently.
_FIELD_NAMES = {"product": "name"}


def rules_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """One row per site with all its rules; of two for one field, the first given counts."""
    rows = [(i, r.site, _FIELD_NAMES.get(r.field, r.field), r.pattern, r.group) for i, r in enumerate(rules)]
    table = spark.createDataFrame(rows, "position int, site string, field string, pattern string, grp int")
    ordered = F.sort_array(F.collect_list(F.struct("position", "field", "pattern", "grp")))
    return table.groupBy("site").agg(ordered.alias("rules"))


def with_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Add `rules`, NULL for pages of other sites."""
    return pages.join(rules, "site", "left")


def rule_products(html: Column, rules: Column) -> Column:
    """One candidate for a page whose site has rules; a rule that finds nothing leaves NULL."""

    def found(field: str) -> Column:
        rule = F.get(F.filter(rules, lambda r: r["field"] == field), 0)
        return F.call_function("regexp_extract", html, rule["pattern"], rule["grp"])

    raw = F.array(*[found(f) for f in FOUND_FIELDS])
    texts = F.transform(raw, lambda v: F.nullif(web.markup_text(v), F.lit("")))

    def one(values_: Column) -> Column:
        cells = {f: values_[i] for i, f in enumerate(FOUND_FIELDS)}
        return candidate("site rules", **{**cells, "price": values.price(cells["price"])})

    # The lambda binds the texts, so each is cut out once.
    return F.when(rules.isNotNull(), F.transform(F.array(texts), one)).otherwise(no_candidates())
