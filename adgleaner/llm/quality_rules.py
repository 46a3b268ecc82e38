"""Quality rules with thresholds that follow the data.

Fixed cutoffs reject whole sources whose texts merely look different. Here the
limits of each rule come from quantile sketches (KLL) of the rule's value per
language and source: a document fails if it lies further outside the middle half
of its own group than `fence` times that half's width plus the rule's margin.
Sketches merge, so each task sends one per group; sketches of groups with fewer
than `min_docs` documents are merged into their language's, and those into one
of all documents.

Defined results: null or empty text has no words and fails the base rules; null
language or source is a group of its own; repeated rows are judged one by one;
an empty table gives an empty result. Columns of other names are passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from adgleaner.llm.common import words, written

# Group keys and result columns of the sketch table.
_KEYS = ("lang", "source")


@dataclass(frozen=True)
class Rule:
    """One value per document, and how far beyond its group's fence it may lie."""

    name: str
    value: Column
    margin: float
    low: bool = False


def _ratio(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def default_rules() -> list[Rule]:
    return [
        Rule("symbols", _ratio("n_symbols", "n_words"), 0.1),
        Rule("dup_lines", _ratio("n_dup_lines", "n_lines"), 0.35),
        Rule("repeats", _ratio("n_repeat_words", "n_words"), 0.25),
        Rule("word_length", _ratio("word_chars", "n_words"), 1.0, low=True),
    ]


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", *_KEYS)) -> DataFrame:
    """Word, symbol, line and repetition counts of each whole text.

    `n_repeat_words` counts the words that lie in a window of three words found
    at least twice in the text. Windows are compared by a 64-bit hash, sorted
    only for texts that hold a repeated one.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(*keep, t.alias("t"), words(F.col(text)).alias("w"), lines.alias("l"))
    w, h = F.col("w"), F.col("h")
    windows = F.when(
        F.size(w) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = base.select(
        *keep,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        windows.alias("h"),
    )
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    ordered = F.when(repeats, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    s = F.col("s")
    twice = F.filter(
        s,
        lambda e, i: F.coalesce(F.get(s, i - 1)["x"] == e["x"], F.lit(False))
        | F.coalesce(F.get(s, i + 1)["x"] == e["x"], F.lit(False)),
    )
    starts = F.sort_array(F.transform(twice, lambda e: e["i"].cast("long")))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
        lambda a, x: F.struct((a["n"] + F.least(F.lit(3).cast("long"), x - a["last"])).alias("n"), x.alias("last")),
    )["n"]
    named = [c for c in counted.columns if c != "h"]
    return counted.select(*named, ordered.alias("s")).select(
        *named, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def thresholds(
    measured: DataFrame, rules: list[Rule], fence: float = 3.0, min_docs: int = 200, k: int = 800
) -> DataFrame:
    """Limits of each rule per language and source, from merged sketches."""
    sketches = measured.groupBy(*_KEYS).agg(
        F.count("*").alias("n"), *[F.kll_sketch_agg_double(r.value, k).alias(r.name) for r in rules]
    )
    # One row per language and source from here on, whatever the documents are.
    group = written(sketches, "quality-sketches")
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(r.name, k).alias(r.name) for r in rules]]
    of_lang, of_all = group.groupBy("lang").agg(*merged), group.agg(*merged)

    def limits(sketch: DataFrame, prefix: str) -> list[Column]:
        out = []
        for r in rules:
            q1, q3 = (F.kll_sketch_get_quantile_double(F.col(r.name), F.lit(q)) for q in (0.25, 0.75))
            out.append((q3 + fence * (q3 - q1) + r.margin).alias(f"{prefix}{r.name}_high"))
            if r.low:
                out.append((q1 - fence * (q3 - q1) - r.margin).alias(f"{prefix}{r.name}_low"))
        return out

    own = group.select(*_KEYS, "n", *limits(group, "own_"))
    lang = of_lang.select(F.col("lang").alias("l_lang"), F.col("n").alias("l_n"), *limits(of_lang, "lang_"))
    row = of_all.where("n > 0").select(*limits(of_all, "")).first()  # the only one, or none of an empty table
    every = row.asDict() if row else {c.removeprefix("own_"): None for c in own.columns[3:]}
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left")
    return joined.select(
        *_KEYS,
        *[
            F.when(F.col("n") >= min_docs, F.col(f"own_{c}"))
            .when(F.col("l_n") >= min_docs, F.col(f"lang_{c}"))
            .otherwise(F.lit(limit).cast("double"))
            .alias(c)
            for c, limit in every.items()
        ],
    )


def judge(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None, **options) -> DataFrame:
    """Measures, base verdict, and `kept` by the group's limits; one row per document."""
    rules = rules or default_rules()
    measured = written(measures(docs, text).withColumn("base_failed", base_failed()), "quality-measures")
    # Written, so that every task compares against the same limits.
    limits = written(thresholds(measured.where(~F.col("base_failed")), rules, **options), "quality-limits")
    limit = limits.withColumnsRenamed({c: f"limit_{c}" for c in limits.columns})
    joined = measured.join(
        limit,
        F.col("lang").eqNullSafe(F.col("limit_lang")) & F.col("source").eqNullSafe(F.col("limit_source")),
        "left",
    )
    fine = F.lit(True)
    for r in rules:
        fine &= F.coalesce(r.value <= F.col(f"limit_{r.name}_high"), F.lit(True))
        if r.low:
            fine &= F.coalesce(r.value >= F.col(f"limit_{r.name}_low"), F.lit(True))
    return joined.select(*measured.columns, (~F.col("base_failed") & fine).alias("kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """`doc_id` of the documents that pass."""
    return judge(docs, **options).where("kept").select("doc_id")
