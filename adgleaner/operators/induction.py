"""Site rules learnt from pages whose values are known.

An example is a page of a site with the value that a field has there. Where the value stands in
the page, what is before and behind it is cut out. Places that look alike at their edges
make up a candidate; its delimiters are all that its places have in common: the longest common
end of what is before, the longest common start of what is behind. Of a set of texts the common
start is that of its least and its greatest, so that a candidate is learnt by a minimum and
a maximum, which tasks reduce before anything is shuffled. Some pages of each site are kept
aside; a candidate is scored by the share of them on which it finds the value. The best of a
site and field becomes a rule, if it is good enough, in the form of `operators.rules`.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

# Characters before and behind a value that a rule may use, and those by which places are told apart.
_REACH, _EDGE = 60, 6


def _quoted(text: Column) -> Column:
    """A pattern for exactly this text."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def common_start(a: Column, b: Column) -> Column:
    """The longest common start of two texts of at most `_REACH` characters."""
    length = F.aggregate(
        F.sequence(F.lit(1), F.lit(_REACH)),
        F.lit(0),
        lambda n, i: F.when((n == i - 1) & (i <= F.length(a)) & (F.substring(a, 1, i) == F.substring(b, 1, i)), i).otherwise(n),
    )
    return F.substring(a, F.lit(1), length)


def places(examples: DataFrame) -> DataFrame:
    """`site, field, page, before, behind` of each place where a page holds its value; `before` reads backwards."""
    known = examples.where(F.length(F.trim("value")) > 0)
    cut = known.withColumn("parts", F.split("html", _quoted(F.col("value"))))
    n = F.size("parts")
    pairs = F.arrays_zip(
        F.slice("parts", F.lit(1), n - 1).alias("l"), F.slice("parts", F.lit(2), F.greatest(n - 1, F.lit(0))).alias("r")
    )
    each = cut.where(n > 1).select("site", "field", "page", F.explode(pairs).alias("x"))
    before = F.reverse(F.right("x.l", F.lit(_REACH)))
    return each.select("site", "field", "page", before.alias("before"), F.left("x.r", F.lit(_REACH)).alias("behind"))


def candidates(found: DataFrame, most: int = 5) -> DataFrame:
    """`site, field, l, r, pages`: delimiters, the `most` that most pages support."""
    edges = [F.left("before", F.lit(_EDGE)).alias("e1"), F.left("behind", F.lit(_EDGE)).alias("e2")]
    groups = found.groupBy("site", "field", *edges).agg(
        *[f(c).alias(f"{f.__name__}_{c}") for c in ("before", "behind") for f in (F.min, F.max)],
        F.approx_count_distinct("page").alias("pages"),
    )
    sides = groups.select(
        "site", "field", "pages",
        F.reverse(common_start(F.col("min_before"), F.col("max_before"))).alias("l"),
        common_start(F.col("min_behind"), F.col("max_behind")).alias("r"),
    ).where("l <> '' AND r <> ''")
    order = Window.partitionBy("site", "field").orderBy(F.desc("pages"), F.desc(F.length("l")), "l", "r")
    return sides.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= most).drop("turn")


def between(html: Column, left: Column, right: Column) -> Column:
    """What stands between the first `left` and the next `right`; NULL if there is none."""
    at = F.call_function("locate", left, html)
    rest = F.when(at > 0, F.substr(html, at + F.length(left)))
    return F.when(F.contains(rest, right), F.call_function("substring_index", rest, right, F.lit(1)))


def learn(examples: DataFrame, least_score: float = 0.9, aside: int = 3) -> DataFrame:
    """Rules from examples (`site, field, page, html, value`): `site, field, pattern, grp, score, n_scored`.

    One page in `aside` is kept for the scores. A site of so few pages that none is kept has no rules.
    """
    kept = F.pmod(F.xxhash64("page"), F.lit(aside)) == 0
    found = candidates(places(examples.where(~kept)))
    tried = examples.where(kept).join(found, ["site", "field"])
    hit = F.coalesce(F.trim(between(F.col("html"), F.col("l"), F.col("r"))) == F.trim("value"), F.lit(False))
    scored = tried.groupBy("site", "field", "l", "r", "pages").agg(
        F.avg(hit.cast("double")).alias("score"), F.count("*").alias("n_scored")
    )
    order = Window.partitionBy("site", "field").orderBy(F.desc("score"), F.desc("pages"), F.desc(F.length("l")), "l", "r")
    best = scored.where(F.col("score") >= least_score).withColumn("turn", F.row_number().over(order)).where("turn = 1")
    pattern = F.concat(F.lit("(?s)"), _quoted(F.col("l")), F.lit("(.*?)"), _quoted(F.col("r")))
    return best.select("site", "field", pattern.alias("pattern"), F.lit(1).alias("grp"), "score", "n_scored")


def as_rules(learnt: DataFrame) -> DataFrame:
    """One row per site, as `operators.rules.with_rules` takes it."""
    one = F.struct(F.lit(0).alias("position"), "field", "pattern", "grp")
    return learnt.groupBy("site").agg(F.sort_array(F.collect_list(one)).alias("rules"))
