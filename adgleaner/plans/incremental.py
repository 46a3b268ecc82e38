"""Listings kept up to date run by run, at the cost of what a run brings.

Three tables, each in `parts` folders by a hash of its key and bucketed by the key within them:
  texts      per text, the page that stays: the one retrieved first
  winners    these pages, by URL
  listings   one row per URL, collapsed from its winners
A run looks up its texts where the table lies. A page that comes late but was retrieved
earlier takes its text over; the page that had it leaves its URL. Then only the URLs that gained or
lost a page are collapsed again. Joins and groups use the buckets as they are stored, so
that what earlier runs wrote is not shuffled, and only folders that a run touches are read
and replaced.

The result is that of `jobs.publish` over all pages, however they fall into runs and in whatever
order. A run that ended half way can be done again: `texts`, which decides, is written last.
"""

import hashlib
import logging

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from adgleaner import schema
from adgleaner.operators import candidates as cd, dedupe, images as im, listings as ls
from adgleaner.sources import readers

TEXT = T.StructType([T.StructField(c, T.StringType()) for c in ("text_key", "retrieved", "url")])
PAGE = T.StructType([*schema.LISTING.fields, T.StructField("text_key", T.StringType())])
LISTED = T.StructType([*schema.LISTING.fields, T.StructField("id", T.StringType())])


class BucketedTable:
    """A table in hash folders, bucketed by its key. A folder always holds a row without key, so that none is ever empty."""

    def __init__(self, spark: SparkSession, path: str, of: T.StructType, key: str, parts: int, buckets: int):
        self.spark, self.key, self.parts, self.buckets = spark, key, parts, buckets
        self.columns = of.names
        # The catalog names it by its place; a new session finds it again.
        self.name = f"adgleaner_{hashlib.md5(path.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in of.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, part INT) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (part) "
            f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        if readers.read_parquet(spark, path, T.StructType([])).inputFiles():
            spark.sql(f"MSCK REPAIR TABLE {self.name}")
        else:
            self.replace(spark.createDataFrame([], of), list(range(parts)))

    def part_of(self, key: str | Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Folders that the keys of some rows belong to: at most `parts`."""
        return sorted(r.part for r in rows.select(self.part_of(self.key).alias("part")).distinct().collect())

    def read(self, parts: list[int] | None = None) -> DataFrame:
        table = self.spark.table(self.name).where(F.col(self.key).isNotNull())
        table = table if parts is None else table.where(F.col("part").isin(parts))
        return table.select(*[F.col(f"`{c}`") for c in self.columns])

    def spread(self, rows: DataFrame) -> DataFrame:
        """Rows dealt out as the buckets are."""
        return rows.repartition(self.buckets, self.key)

    def replace(self, rows: DataFrame, parts: list[int]) -> None:
        """Put rows in place of some folders. They may come from there: the folders change when all rows are written."""
        placed = rows.select(*[F.col(f"`{c}`") for c in self.columns]).withColumn("part", self.part_of(self.key))
        nothing = [F.lit(None).alias(c) for c in self.columns]
        marks = self.spark.createDataFrame([(p,) for p in parts], "part int").select(*nothing, "part")
        placed.unionByName(marks).write.insertInto(self.name, overwrite=True)


class ListingState:
    """The tables below a folder. `parts` and `buckets` are fixed when it is first written."""

    def __init__(self, spark: SparkSession, path: str, collapse: str = "row", parts: int = 16, buckets: int = 8):
        self.path, self.collapse = path.rstrip("/"), collapse

        def table(name: str, of: T.StructType, key: str) -> BucketedTable:
            return BucketedTable(spark, f"{self.path}/{name}", of, key, parts, buckets)

        self.texts = table("texts", TEXT, "text_key")
        self.winners = table("winners", PAGE, "url")
        self.listed = table("listings", LISTED, "url")

    def listings(self) -> DataFrame:
        return self.listed.read()

    def moves(self, pages: DataFrame, parts: list[int]) -> DataFrame:
        """Pages that take a text over, with the URL that loses it."""
        new, old = self.texts.spread(pages).alias("n"), self.texts.read(parts).alias("o")
        order = [F.struct(f"{side}.retrieved", f"{side}.url") for side in "no"]
        wins = F.col("o.text_key").isNull() | (order[0] < order[1])
        both = new.join(old.hint("merge"), F.col("n.text_key") == F.col("o.text_key"), "left").where(wins)
        return both.select("n.*", F.col("o.url").alias("lost_by"))

    def merge(self, pages: DataFrame, run: str) -> dict[str, int]:
        """Take in extracted pages (`listings.extracted_pages`). Returns how many won a text and how many lost one."""
        pages = pages.select(*[F.col(f"`{c}`") for c in PAGE.names])
        brought = im.stored(dedupe.first_texts(pages), f"{self.path}/brought/run={run}")
        text_parts = self.texts.touched(brought)
        moves = im.stored(self.moves(brought, text_parts), f"{self.path}/moves/run={run}")
        won = moves.drop("lost_by")
        lost = moves.where("lost_by IS NOT NULL").select(F.col("lost_by").alias("url"), "text_key")
        urls = won.select("url").union(lost.select("url"))
        parts = self.winners.touched(urls)
        self.winners.replace(self.pages_now(won, lost, parts), parts)
        self.listed.replace(self.listings_now(urls, parts), parts)
        # Last: until then the same pages would make the same moves.
        self.texts.replace(self.texts_now(won, text_parts), text_parts)
        figures = {"won": won.count(), "lost": lost.count()}
        logging.info("run %s: %s", run, figures)
        return figures

    def pages_now(self, won: DataFrame, lost: DataFrame, parts: list[int]) -> DataFrame:
        """Winners of some folders after a run. Of the old ones only those of URLs that lose a page move."""
        old = self.winners.read(parts)
        losing = self.winners.spread(lost.select("url")).hint("shuffle_merge")
        stay = old.join(losing, "url", "left_anti")
        left = old.join(losing, "url", "left_semi").join(lost, ["url", "text_key"], "left_anti")
        return stay.unionByName(left).unionByName(self.winners.spread(won))

    def listings_now(self, urls: DataFrame, parts: list[int]) -> DataFrame:
        """Listings of some folders after a run: those of the URLs at hand are made anew."""
        changed = self.winners.spread(urls).hint("shuffle_merge")
        again = self.winners.read(parts).join(changed, "url", "left_semi")
        anew = ls.typed_listings(cd.collapse_pages(again, self.collapse))
        return self.listed.read(parts).join(changed, "url", "left_anti").unionByName(anew)

    def texts_now(self, won: DataFrame, parts: list[int]) -> DataFrame:
        new = self.texts.spread(won.select(*TEXT.names)).hint("shuffle_merge")
        return self.texts.read(parts).join(new, "text_key", "left_anti").unionByName(new)
