"""Secrets in texts: candidates by pattern, false ones removed by a random forest.

Candidates are long runs of the characters that keys are made of; among them are
long words, paths and hashes that guard nothing. A forest learns from labelled
findings which is which, from

- the candidate: length, entropy, shares of kinds of characters, changes from
  one kind to another, and how likely its character pairs are in the corpus:
  among all pairs of ASCII letters within words of all documents,
- the share of it that words of its language cover: those in at least
  `DOCUMENT_SHARE` of the documents of the language, and in two at least, so that
  what stands in one document only is not its own dictionary,
- the path it comes from: depth, and whether it names tests or examples,
- the words beside it: an assignment, a word for a secret, a link.

Findings may come labelled; else `labelled_by_format` labels those whose format
leaves no doubt, and leaves the others to the forest. Training takes at most
`max_findings` distinct rows. The result holds digests of the values, never the values.

Defined results: null and empty texts have no findings; with labels of one kind,
or none, the label's share decides; repeated rows give repeated rows; a null
path has depth 0; documents without a language, or a table without the column,
are one language; an empty table gives an empty result.

Words are counted once, with partial sums in each task. Candidates meet the
dictionary by join, each distinct value once, and words and values that very many
rows share are joined by broadcast. Only the counts of pairs, 676 rows at most,
pass through the driver.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adgleaner.llm.common import written
from adgleaner.operators.skew import left_join_spread

LEAST = 16
CANDIDATE = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}+={{0,2}}"
BESIDE = 80
SHORTEST, LONGEST = 3, 20  # letters of a word
DOCUMENT_SHARE = 1 / 2000
VALUES_PER_TASK = 5000

# Words that name a secret, and formats of issuers.
SECRET_WORD = r"(?i)(?:pass(?:word|wd)?|pwd|token|secret|api[_-]?key|credential|auth)"
ISSUED = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})$"
ASSIGNED = SECRET_WORD + r"""["']?\s*[:=]\s*["']?$"""
TEST_PATH = r"(?i)(?:^|[/_.-])(?:tests?|examples?|samples?|fixtures?|mocks?|docs?)(?:$|[/_.-])"

FEATURES = (
    "length", "entropy", "lower", "upper", "digits", "other", "changes", "pair_likelihood", "coverage",
    "path_depth", "path_test", "assigned", "secret_word", "quoted", "link",
)


def _lang(rows: DataFrame, lang: str = "lang") -> Column:
    """The language, '' where there is none."""
    return F.coalesce(F.col(lang).cast("string"), F.lit("")) if lang in rows.columns else F.lit("")


def candidates(docs: DataFrame, path: str = "source", lang: str = "lang") -> DataFrame:
    """`doc_id, path, lang, start, end, value, before, after`: every candidate, with the text beside it."""
    t = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", F.col(path).cast("string").alias("path"), _lang(docs, lang).alias("lang"), t.alias("t"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(CANDIDATE)
        for batch in batches:
            out = []
            for doc_id, path_, lang_, text in zip(*(batch.column(i) for i in range(4))):
                text = text.as_py()
                for m in pattern.finditer(text):
                    i, j = m.span()
                    beside = text[max(0, i - BESIDE) : i], text[j : j + BESIDE]
                    out.append((doc_id.as_py(), path_.as_py(), lang_.as_py(), i, j, m[0], *beside))
            columns = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = ["doc_id", "path", "lang", "start", "end", "value", "before", "after"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    ddl = "doc_id long, path string, lang string, start long, end long, value string, before string, after string"
    base = base.select(F.col("doc_id").cast("long").alias("doc_id"), "path", "lang", "t")
    return base.where(t_has_candidate("t")).mapInArrow(find, ddl)


def t_has_candidate(t: str) -> Column:
    """Texts without a candidate never leave the JVM."""
    return F.col(t).rlike(CANDIDATE)


def word_counts(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """`lang, word, n, n_docs` of every word of 3 to 20 letters: how often it occurs, and in how many documents."""
    pattern = rf"(?<!\p{{L}})(\p{{L}}{{{SHORTEST},{LONGEST}}})(?!\p{{L}})"
    found = F.sort_array(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(pattern), F.lit(1)))
    base = docs.select(_lang(docs, lang).alias("lang"), found.alias("found")).where(F.size("found") > 0)
    # In order, so that a document counts where its words change.
    last = F.concat(F.array(F.lit(None).cast("string")), F.slice("found", F.lit(1), F.size("found") - 1))
    each = F.zip_with("found", last, lambda a, b: F.struct(a.alias("word"), (~a.eqNullSafe(b)).cast("long").alias("first")))
    rows = base.select("lang", F.inline(each))
    return written(rows.groupBy("lang", "word").agg(F.count("*").alias("n"), F.sum("first").alias("n_docs")), "secret-words")


def pair_counts(words: DataFrame) -> dict[str, int]:
    """How often each pair of ASCII letters occurs within words; candidates have no other letters."""
    starts = F.sequence(F.lit(1), F.length("word") - 1)
    pairs = words.select("n", F.explode(F.transform(starts, lambda i: F.substring("word", i, F.lit(2)))).alias("pair"))
    counted = pairs.where(F.col("pair").rlike("^[a-z]{2}$")).groupBy("pair").agg(F.sum("n").alias("n"))
    return {r.pair: r.n for r in counted.collect()}


def dictionary(docs: DataFrame, words: DataFrame, share: float = DOCUMENT_SHARE, lang: str = "lang") -> DataFrame:
    """`lang, word`: the words that enough documents of their language hold."""
    total = docs.groupBy(_lang(docs, lang).alias("lang")).agg(F.count("*").alias("total"))
    enough = F.col("n_docs") >= F.greatest(F.col("total") * share, F.lit(2.0))
    return words.where("n_docs >= 2").join(total, "lang").where(enough).select("lang", "word")


def _pieces(values: DataFrame) -> DataFrame:
    """`key, piece`: what could be a word within each value: every run of letters within it, with the language."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile(rf"[a-z]{{{SHORTEST},}}")

        def batch_of(key, found):
            return pa.RecordBatch.from_arrays([pa.array([key] * len(found), pa.binary()), pa.array(found, pa.string())], names)

        for batch in batches:
            for key, lang, value in zip(*(c.to_pylist() for c in batch.columns)):
                found = set()
                for m in letters.finditer(value.lower()):
                    run = m[0]
                    for i in range(len(run) - SHORTEST + 1):
                        found.update(f"{lang}\n{run[i:j]}" for j in range(i + SHORTEST, min(i + LONGEST, len(run)) + 1))
                        if len(found) > 100_000:  # a piece may come again; sets of words are made later
                            yield batch_of(key, list(found))
                            found.clear()
                if found:
                    yield batch_of(key, list(found))

    names = ["key", "piece"]
    tasks = -(-values.count() // VALUES_PER_TASK) or 1
    return values.select("key", "lang", "value").repartition(tasks).mapInArrow(cut, "key binary, piece string")


def with_words(found: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates with `words`, the words of the dictionary that occur in the value; null where none does."""
    digest = F.sha2(F.concat("lang", F.lit("\n"), "value").cast("binary"), 256)
    found = found.withColumn("key", F.unhex(F.substring(digest, 1, 32)))
    values = written(found.groupBy("key", "lang", "value").agg(F.count("*").alias("n")), "secret-values")
    pieces = written(_pieces(values), "secret-pieces")
    # Counts of pieces and the dictionary meet one to one. What no word matches stays among the
    # counts, so that the pieces and values that many rows share go back by broadcast in any case.
    wanted = pieces.groupBy("piece").agg(F.count("*").alias("n"))
    entries = known.where(F.col("word").rlike("^[a-z]+$")).select(F.concat("lang", F.lit("\n"), "word").alias("piece"), "word")
    judged = written(wanted.join(entries, "piece", "left"), "secret-judged")
    matched = left_join_spread(pieces, judged, "piece", "n", "key").where("word is not null")
    of_value = matched.groupBy("key").agg(F.collect_set("word").alias("words"))
    weighted = written(values.select("key", "n").join(of_value, "key", "left"), "secret-value-words")
    return left_join_spread(found, weighted, "key", "n", "doc_id").drop("key")


class Measures:
    """Features of candidates, given the words of a dictionary and the counts of character pairs."""

    def __init__(self, words: Iterable[str] = (), pairs: dict[str, int] | None = None):
        self.words = frozenset(words)
        pairs = pairs or {}
        total = sum(pairs.values()) + 1
        self.pairs = {p: math.log(n / total) for p, n in pairs.items()}
        self.unseen = math.log(0.1 / total)

    def coverage(self, value: str, words: Iterable[str] | None = None) -> float:
        """The largest share of the characters that words can cover without overlap."""
        v = value.lower()
        words = self.words if words is None else frozenset(words)
        longest = max(map(len, words), default=0)
        best = [0] * (len(v) + 1)
        for i in range(1, len(v) + 1):
            best[i] = best[i - 1]
            for n in range(SHORTEST, min(longest, i) + 1):
                if v[i - n : i] in words:
                    best[i] = max(best[i], best[i - n] + n)
        return best[-1] / len(v)

    def of(self, value: str, before: str, after: str, path: str | None, words: Iterable[str] | None) -> list[float]:
        n = len(value)
        kinds = ["l" if c.islower() else "u" if c.isupper() else "d" if c.isdigit() else "o" for c in value]
        _, counts = np.unique(list(value), return_counts=True)
        share = counts / n
        low = value.lower()
        likely = sum(self.pairs.get(low[i : i + 2], self.unseen) for i in range(n - 1)) / max(n - 1, 1)
        return [
            float(n),
            float(-(share * np.log2(share)).sum()),
            *(kinds.count(k) / n for k in "ludo"),
            sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1),
            likely,
            self.coverage(value, words or ()),
            float((path or "").count("/")),
            float(bool(re.search(TEST_PATH, path or ""))),
            float(bool(re.search(r"[:=]\s*[\"']?$", before))),
            float(bool(re.search(SECRET_WORD, before[-30:]))),
            float(bool(before[-1:] in ('"', "'") and before[-1:] == after[:1])),
            float(bool(re.search(r"(?:://|www\.|[@/.])\S*$", before))),
        ]


def measured(found: DataFrame, known: DataFrame, pairs: dict[str, int]) -> DataFrame:
    """Candidates with `features`, an array of numbers in the order of FEATURES."""
    measures = Measures(pairs=pairs)

    @F.arrow_udf("array<double>")
    def features(value: pa.Array, before: pa.Array, after: pa.Array, path: pa.Array, words: pa.Array) -> pa.Array:
        rows = zip(*(x.to_pylist() for x in (value, before, after, path, words)))
        return pa.array([measures.of(*r) for r in rows], pa.list_(pa.float64()))

    rows = with_words(found, known)
    return rows.withColumn("features", features("value", "before", "after", "path", "words")).drop("words")


def labelled_by_format(found: DataFrame) -> DataFrame:
    """Candidates with `label`: 1 or 0 where the format decides, else null."""
    value, before = F.col("value"), F.col("before")
    secret = value.rlike(ISSUED) | (before.rlike(ASSIGNED) & value.rlike("[0-9]"))
    plain = ~value.rlike("[0-9]") | before.rlike(r"(?:://|@)\S*$")
    return found.withColumn("label", F.when(secret, 1.0).when(plain, 0.0))


class Forest:
    """A fitted forest, or the share of one label where there is nothing to learn."""

    def __init__(self, findings: DataFrame, max_findings: int = 4000, trees: int = 20, depth: int = 5, seed: int = 7):
        """`findings`: features and label. At most `max_findings` / 2 of each label are used, the first by a hash.

        Findings with equal features and label count once: copies of one neither crowd out others nor weigh more.
        """
        known = findings.where("label is not null").select("features", "label").distinct()
        parts = [known.where(F.col("label") == y).orderBy(F.xxhash64("features")).limit(max_findings // 2) for y in (0.0, 1.0)]
        sample = written(parts[0].unionByName(parts[1]), "secret-sample")
        n = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
        self.sampled = n
        self.share = n.get(1.0, 0) / max(sum(n.values()), 1)
        self.model = None
        if len(n) == 2:
            rows = sample.select(array_to_vector("features").alias("vector"), "label")
            forest = RandomForestClassifier(
                featuresCol="vector", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=64
            )
            self.model = forest.fit(rows)

    def score(self, findings: DataFrame) -> DataFrame:
        if self.model is None:
            return findings.withColumn("score", F.lit(float(self.share)))
        scored = self.model.transform(findings.withColumn("vector", array_to_vector("features")))
        return scored.withColumn("score", vector_to_array("probability")[1]).select(*findings.columns, "score")


def scan(
    spark: SparkSession,
    docs: DataFrame,
    labelled: DataFrame | None = None,
    path: str = "source",
    cut: float = 0.5,
    lang: str = "lang",
    share: float = DOCUMENT_SHARE,
    **options,
) -> DataFrame:
    """Every candidate with its score; `secret` says whether the forest lets it stand.

    `labelled`: candidates with `label`; by default those of `docs` that their format labels,
    of documents outside the fifth that a hash of the id holds out.
    """
    words = word_counts(docs, lang)
    known, pairs = written(dictionary(docs, words, share, lang), "secret-dictionary"), pair_counts(words)
    found = written(measured(written(candidates(docs, path, lang), "secret-found"), known, pairs), "secret-candidates")
    if labelled is None:
        held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
        findings = labelled_by_format(found).where(~held_out)
    else:
        findings = measured(written(labelled.withColumn("lang", _lang(labelled)), "secret-labelled"), known, pairs)
    scored = Forest(findings, **options).score(found)
    return scored.select(
        "doc_id", "path", "start", "end", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
        "score", (F.col("score") >= cut).alias("secret"),
    )
