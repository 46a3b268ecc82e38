"""Location lookup against a table of place names."""

from pyspark.sql import Column, DataFrame, functions as F

from adgleaner.functions import text as tx
from adgleaner.operators.skew import left_join_spread


def resolve_locations(listings: DataFrame, places: DataFrame, row_id: str = "id") -> DataFrame:
    """Add `place`: the first comma-separated part of the location that is a known name.

    `places` has one row per `name`. Each distinct location is looked up once.
    Whether `places` is broadcast is left to its size.
    """
    distinct = listings.where(F.col("location").isNotNull()).groupBy("location").agg(F.count("*").alias("n_rows"))
    parts = distinct.select(
        "location", "n_rows", F.posexplode(F.split("location", ", ")).alias("pos", "part")
    ).withColumn("name", tx.strip(F.col("part")))
    resolved = (
        parts.join(places.select("name", F.col("name").alias("place")), "name")
        .groupBy("location")
        .agg(F.min_by("place", "pos").alias("place"), F.first("n_rows").alias("n_rows"))
    )
    return left_join_spread(listings, resolved, "location", "n_rows", row_id)


def _deletions(name: Column, edits: int) -> Column:
    """A name and all that is left of it after up to `edits` of its characters go."""
    keys = F.array(name)
    for _ in range(edits):
        shorter = F.transform(
            keys,
            lambda k: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(k), F.lit(1))),
                lambda i: F.concat(F.substring(k, F.lit(1), i - 1), F.substring(k, i + 1, F.length(k))),
            ),
        )
        keys = F.array_distinct(F.concat(keys, F.flatten(shorter)))
    return keys


def resolve_misspelt(
    listings: DataFrame, places: DataFrame, row_id: str = "id", edits: int = 1, least: int = 4
) -> DataFrame:
    """Add `place`: the place whose name is nearest to a comma-separated part of the location.

    `places` has one row per `name` and, for alternative names, the `place` each stands for.
    A part may differ from a name by up to `edits` inserted, deleted or replaced characters;
    parts and names of fewer than `least` characters must be equal. The fewest edits win, then
    the earlier part, then the lesser name. Two texts within `edits` share what is left of both
    after as many deletions, so that they meet by a hash join on those keys, and only those that
    meet are compared. Each distinct location is looked up once.
    """
    named = places.select("name", F.col("place") if "place" in places.columns else F.col("name").alias("place"))
    named = named.where(F.col("name").isNotNull()).withColumn("name_length", F.length("name"))
    longest = named.agg(F.max("name_length")).first()[0] or 0
    distinct = listings.where(F.col("location").isNotNull()).groupBy("location").agg(F.count("*").alias("n_rows"))
    parts = distinct.select("location", "n_rows", F.posexplode(F.split("location", ",")).alias("pos", "part"))
    # A part longer than this is near no name, and never gets keys.
    parts = parts.withColumn("part", tx.strip(F.col("part"))).where(F.length("part") <= longest + edits)

    def keys(text: str) -> Column:
        near = F.when(F.length(text) >= least, _deletions(F.col(text), edits)).otherwise(F.array(text))
        return F.explode(F.transform(near, lambda k: F.xxhash64(k))).alias("key")

    met = parts.select("*", keys("part")).join(named.select("*", keys("name")), "key")
    distance = F.levenshtein(F.col("part"), F.col("name"), edits)
    allowed = F.when(F.least(F.length("part"), F.col("name_length")) >= least, F.lit(edits)).otherwise(F.lit(0))
    resolved = (
        met.withColumn("distance", distance)
        .where((F.col("distance") >= 0) & (F.col("distance") <= allowed))
        .groupBy("location")
        .agg(F.min_by("place", F.struct("distance", "pos", "name", "place")).alias("place"), F.first("n_rows").alias("n_rows"))
    )
    return left_join_spread(listings, resolved, "location", "n_rows", row_id)
