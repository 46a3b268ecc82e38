"""Left join that no hot key and no NULL key can slow down."""

from pyspark.sql import Column, DataFrame, functions as F

# A key counts as hot if it holds at least this share of the rows, so there
# are never more than 1 / HOT_SHARE hot keys: their rows are safe to broadcast.
HOT_SHARE = 1 / 1000
_SALTS = 1 << 16


def left_join_spread(left: DataFrame, right: DataFrame, key: str, weight: str, spread_by: str) -> DataFrame:
    """`left` LEFT JOIN `right` on `key`; right keys are unique.

    `right[weight]` is the number of left rows with that key. Hot keys are
    joined by broadcast, in place; all other keys by an ordinary join, in which
    the rows that are done or have no key are dealt out over many salts.
    `spread_by` names a left column with many distinct values for that.
    """
    total = right.agg(F.sum(weight).alias("total")).scalar()
    values = [c for c in right.columns if c not in (key, weight)]
    is_hot = F.col(weight) >= F.greatest(total * F.lit(HOT_SHARE), F.lit(2))
    hot = right.where(is_hot).select(
        F.col(key).alias("hot_key"), F.struct(*values).alias("hot_values")
    )
    # Key and salt are one struct: as two columns, the constant salt of this
    # side would be taken out of the join keys and nothing would be dealt out.
    cold = right.where(~is_hot).select(
        _salted(F.col(key), F.lit(0)).alias("cold_key"), F.struct(*values).alias("cold_values")
    )
    marked = left.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")
    settled = F.col(key).isNull() | F.col("hot_key").isNotNull()
    salt = 1 + F.pmod(F.xxhash64(spread_by), F.lit(_SALTS)).cast("int")
    joined = marked.withColumn(
        "join_key", _salted(F.when(~settled, F.col(key)), F.when(settled, salt).otherwise(0))
    ).join(cold, F.col("join_key") == F.col("cold_key"), "left")
    picked = F.coalesce("hot_values", "cold_values")
    return joined.select(
        *[F.col(f"`{c}`") for c in left.columns], *[picked[c].alias(c) for c in values]
    )


def _salted(key: Column, salt: Column) -> Column:
    return F.struct(key.alias("key"), salt.alias("salt"))
