"""Column functions that clean listing values."""

from functools import reduce

from pyspark.sql import Column, functions as F

from adgleaner import constants
from adgleaner.functions.text import repair_mojibake


def price(c: Column) -> Column:
    """Number in a price text: `US $1,234.50` is 1234.5; what is no number is NULL."""
    digits = F.replace(F.regexp_replace(c, r"[^0-9,.]", ""), F.lit(","), F.lit(""))
    return F.nullif(digits, F.lit("")).try_cast("double")


def mean_price(prices: Column) -> Column:
    """Mean of the numbers in a list of price texts; NULL if it holds none."""
    numbers = F.filter(F.transform(prices, price), lambda x: x.isNotNull())
    return mean(numbers)


def mean(numbers: Column) -> Column:
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        numbers,
        start,
        lambda a, x: F.struct((a["s"] + x).alias("s"), (a["n"] + 1).alias("n")),
        lambda a: F.try_divide(a["s"], a["n"]),
    )


def currency(codes: Column) -> Column:
    """A list of currencies as one text."""
    return F.nullif(F.array_join(codes, ", "), F.lit(""))


def location(c: Column) -> Column:
    """Drop the `None` marker and spell out the known country codes."""
    named = reduce(
        lambda case, kv: case.when(c == kv[0], F.lit(kv[1])),
        constants.COUNTRY_NAMES.items(),
        F.when(c == "None", F.lit(None).cast("string")),
    )
    return named.otherwise(c)


def image(c: Column) -> Column:
    return F.nullif(c, F.lit("None"))


def listing_row(c: str) -> Column:
    """One listing column with its final type and repair."""
    col = F.col(f"`{c}`")
    if c == "price":
        return col.try_cast("double").alias(c)
    if c in ("title", "text", "name", "description"):
        return repair_mojibake(col.cast("string")).alias(c)
    if c == "location":
        return location(col.cast("string")).alias(c)
    return col.cast("string").alias(c)


def product_text(title: Column, name: Column, description: Column) -> Column:
    """Text to classify: the description without a title, the title without a name, else the name."""
    picked = F.when(title.isNull(), description).when(name.isNull(), title).otherwise(name)
    return F.coalesce(picked, F.lit(""))


def label_code(c: Column) -> Column:
    return reduce(
        lambda case, kv: case.when(c == kv[0], F.lit(kv[1])),
        list(constants.LABEL_CODES.items())[1:],
        F.when(c == "LABEL_0", F.lit(constants.LABEL_CODES["LABEL_0"])),
    )


def better_label(label_a: Column, score_a: Column, label_b: Column, score_b: Column) -> Column:
    """The label that is there; of two, the one with the higher score, the first on a tie."""
    return (
        F.when(label_a.isNull(), label_b)
        .when(label_b.isNull(), label_a)
        .when(score_b > score_a, label_b)
        .otherwise(label_a)
    )


def best_label(labels: Column, scores: Column) -> Column:
    """Struct (score, label) of the highest score; the first label wins a tie."""
    ranked = F.zip_with(
        F.transform(scores, lambda s, i: F.struct(s.cast("double").alias("score"), (-i).alias("turn"))),
        labels,
        lambda r, l: F.struct(r["score"].alias("score"), r["turn"].alias("turn"), l.alias("label")),
    )
    top = F.array_max(F.filter(ranked, lambda r: r["score"].isNotNull()))
    return F.struct(top["score"].alias("score"), top["label"].alias("label"))
