"""Personal data: patterns, and the terms that give the people behind them away.

Base kinds are found by pattern: e-mail and IP addresses, card and phone numbers.
Masking them is not enough where the words around them always come with the same
person, so terms are judged by what the corpus says about them. An entity is one
value of a base kind. Over all documents, with counts c of documents and N of
all,

    information of an entity   ic(e)  = log(N / c(e))
    what a term tells of it    pmi    = log(c(t, e) * N / (c(t) * c(e)))

where c(t, e) counts documents that hold both, the term anywhere outside their
base matches. A term with pmi >= `generalise_at` * ic(e) discloses the entity;
from `remove_at` on it is removed, below that it is replaced by `[TERM]`. Pairs
must be seen in `support` different contexts, the `width` words on either side
of the entity, so that copies of one text prove nothing. Terms are masked in
every document that names the entity; with `everywhere`, in every document that
holds them, as the registered query and the pipeline do.

Defined results: null and empty texts have no spans; rows that repeat an id and
its text are judged alike; matches of one kind never overlap, those of different
kinds may; a term within a base match is not reported again; an empty table gives
an empty result. Positions count code points, ends are exclusive.

All of it is DataFrame expressions. Patterns never backtrack over a run twice,
so that long runs of digits or letters neither overflow the stack nor take
quadratic time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adgleaner.llm.common import written
from adgleaner.operators.shape import compute_once

KINDS = ("email", "ip", "card", "phone", "term")
MASKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")

# The leftmost match begins where a run begins, or where the last match ended.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TERM = r"[\p{L}\p{N}]+"
_BLOCK = 256
# What every text with a base match that counts holds, in one look.
_MAY_HOLD = (
    r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]++\.[A-Za-z0-9-]|[0-9]\.[0-9]++\.[0-9]++\.[0-9]"
    r"|[0-9](?:[\x20-]?[0-9]){15}|\+[0-9][\x20().0-9-]+[0-9]"
)
# More rows than this are never broadcast.
MAX_BROADCAST_ROWS = 1_000_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: int, value: Column) -> Column:
    """Whether a match of a kind's pattern counts."""
    digits = _digits(value)
    return (
        F.lit(True),
        value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        F.length(digits).between(16, 19) & F.call_function("luhn_check", digits),
        F.length(digits).between(8, 15),
    )[kind]


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)


def _located(rows: DataFrame, keep: list[str]) -> DataFrame:
    """One row per match: `start, end, value`, and the text `before` and `after` it up to the next match.

    `rows` has the columns kept, `matches`, and `gaps`, the text between them.
    Starts are sums of lengths, taken over blocks so that many matches stay cheap.
    """
    both = [*keep, "matches", "gaps"]
    sized = compute_once(
        rows,
        both,
        g=F.transform("gaps", lambda x: F.length(x).cast("long")),
        step=F.zip_with("gaps", "matches", lambda a, b: (F.length(a) + F.coalesce(F.length(b), F.lit(0))).cast("long")),
    )
    n = F.size("matches")
    last_block = F.floor((n - 1) / _BLOCK).cast("int")
    blocks = compute_once(
        sized,
        [*both, "g", "step"],
        block=F.transform(F.sequence(F.lit(0), last_block), lambda j: _sum(F.slice("step", j * _BLOCK + 1, _BLOCK))),
    )
    before = compute_once(
        blocks,
        [*both, "g", "step"],
        before_block=F.transform(F.sequence(F.lit(0), last_block), lambda j: _sum(F.slice("block", F.lit(1), j))),
    )

    def match(i: Column) -> Column:
        j = F.floor(i / _BLOCK).cast("int")
        start = F.get("before_block", j) + _sum(F.slice("step", j * _BLOCK + 1, i % _BLOCK)) + F.get("g", i)
        value = F.get("matches", i)
        return F.struct(
            start.alias("start"),
            (start + F.length(value)).alias("end"),
            value.alias("value"),
            F.get("gaps", i).alias("before"),
            F.get("gaps", i + 1).alias("after"),
        )

    return before.select(*keep, F.inline(F.transform(F.sequence(F.lit(0), n - 1), match)))


def _base_matches(docs: DataFrame) -> DataFrame:
    """`doc_id, h, kind, start, end, value, before, after` of every valid base match."""
    t = F.col("t")
    found = [
        F.struct(F.lit(k).alias("kind"), F.regexp_extract_all(t, F.lit(p), F.lit(0)).alias("matches"))
        for k, p in enumerate(PATTERNS)
    ]
    some = docs.select("doc_id", "h", "t", F.inline(F.array(*found))).where(F.size("matches") > 0)
    cut = F.lit(None)
    for k, p in enumerate(PATTERNS):
        cut = F.when(F.col("kind") == k, F.split(t, p, -1)).otherwise(cut)
    cuts = compute_once(some, ["doc_id", "h", "kind", "matches"], gaps=cut)
    return _located(_valid_only(cuts, ["doc_id", "h", "kind"]), ["doc_id", "h", "kind"])


def _valid_only(rows: DataFrame, keep: list[str]) -> DataFrame:
    """`matches` that count, and as `gaps` all the text between them, matches that do not count included."""

    def passes(value: Column) -> Column:
        out = F.lit(False)
        for k in range(len(PATTERNS)):
            out = F.when(F.col("kind") == k, valid(k, value)).otherwise(out)
        return out

    n = F.size("matches")
    judged = compute_once(rows, [*keep, "matches", "gaps"], ok=F.transform("matches", passes))
    some = judged.where(F.exists("ok", lambda x: x))
    at = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("ok", i))
    follow = F.zip_with("matches", F.slice("gaps", F.lit(2), n), lambda a, b: F.concat(a, b))
    marked = compute_once(some, [*keep, "matches", "gaps"], at=at, follow=follow)

    def between(last: Column, following: Column) -> Column:
        """From after one match that counts, or the start, to the next, or the end."""
        rest = F.array_join(F.slice("follow", last + 2, following - last - 1), "")
        return F.concat(F.get("gaps", last + 1), rest)

    lasts, nexts = F.concat(F.array(F.lit(-1)), F.col("at")), F.concat(F.col("at"), F.array(n))
    return marked.select(
        *keep,
        F.transform("at", lambda i: F.get("matches", i)).alias("matches"),
        F.zip_with(lasts, nexts, between).alias("gaps"),
    )


def _without_base(rows: DataFrame) -> DataFrame:
    """`doc_id, h, t`: the texts with a blank in place of each base match, so that no match is a term of its own entity."""
    t = F.col("t")
    for k, p in enumerate(PATTERNS):
        matches = F.regexp_extract_all(t, F.lit(p), F.lit(0))
        blanked = F.array_join(F.zip_with(F.split(t, p, -1), matches, _masker(k, " \n ")), "")
        rows = compute_once(rows, ["doc_id", "h"], t=F.when(t.rlike(p), blanked).otherwise(t))
    return rows


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_TERM})"), F.lit(0))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row is known by its id and its text, so that repeated rows are one."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("h"), t.alias("t"))


def entity_mentions(keyed: DataFrame, width: int) -> DataFrame:
    """Base matches with their entity and a hash of the terms next to them, written once."""
    found = _base_matches(keyed)
    plain = F.when(F.col("kind") == 0, F.lower("value")).when(F.col("kind") == 1, F.col("value")).otherwise(_digits(F.col("value")))
    near = F.concat(
        F.reverse(F.slice(F.reverse(_terms(F.col("before"))), 1, width)), F.slice(_terms(F.col("after")), 1, width)
    )
    return written(
        found.select(
            "doc_id", "h", "kind", "start", "end",
            F.concat_ws(":", F.col("kind").cast("string"), plain).alias("entity"),
            F.xxhash64(near).alias("context"),
        ),
        "pii-mentions",
    )


def _few(rows: DataFrame) -> bool:
    return rows.count() <= MAX_BROADCAST_ROWS


def _listed(texts: DataFrame, rows: DataFrame, how: str = "left_semi") -> DataFrame:
    """The texts of some rows (or, by `left_anti`, of all others), taken where they lie."""
    return _joined(texts, F.broadcast(rows.select("doc_id", "h")), how)


def _joined(texts: DataFrame, rows: DataFrame, how: str = "inner") -> DataFrame:
    """Texts joined on id and hash with rows that may come from the same tables."""
    of = rows.withColumnsRenamed({"doc_id": "of_id", "h": "of_h"})
    both = texts.join(of, F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h")), how)
    return both.drop("of_id", "of_h")


def _naming(keyed: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts of some rows that hold base matches. Texts move only if the rows are too many to broadcast,
    and then only those that may hold a match."""
    if _few(rows):
        return _listed(keyed, rows)
    return keyed.where(F.col("t").rlike(_MAY_HOLD)).join(rows, _same_row(keyed, rows), "left_semi")


def disclosing_terms(
    keyed: DataFrame,
    mentions: DataFrame,
    support: int = 3,
    generalise_at: float = 0.8,
    remove_at: float = 0.95,
) -> DataFrame:
    """`entity, term, removed`: the terms that disclose an entity, and whether generalising them is too little."""
    entities = mentions.groupBy("entity").agg(
        F.count_distinct(F.struct("doc_id", "h")).alias("c_e"), F.count_distinct("context").alias("contexts")
    )
    total = keyed.count()
    ic = F.log(F.lit(total) / F.col("c_e"))
    # An entity of fewer contexts has no pair of enough.
    entities = written(entities.where(F.col("contexts") >= support).where(ic > 0).select("entity", "c_e"), "pii-entities")
    named = mentions.select("doc_id", "h", "entity", "context").distinct().join(entities, "entity")
    named = written(named, "pii-named")
    most = named.agg(F.max("c_e")).first()[0] or 0

    def share(together: str | Column) -> Column:
        return F.log(together * F.lit(total) / (F.col("c_t") * F.col("c_e"))) / ic

    # A term of more documents than this reaches the share with no entity, even where it is in all of the entity's.
    bound = total * (most / max(total, 1)) ** generalise_at * (1 + 1e-9)
    all_terms = keyed.select(F.explode(F.array_distinct(_terms(F.col("t")))).alias("term"))
    c_t = written(all_terms.groupBy("term").agg(F.count("*").alias("c_t")).where(F.col("c_t") <= bound), "pii-counts")
    held = _naming(keyed, written(named.select("doc_id", "h").distinct(), "pii-naming")).dropDuplicates(["doc_id", "h"])
    outside = _without_base(held).select("doc_id", "h", F.explode(F.array_distinct(_terms(F.col("t")))).alias("term"))
    outside = outside.join(c_t, "term")
    both = named.join(outside, _same_row(named, outside)).select(
        "entity", "c_e", "term", "c_t", "context", F.struct(named["doc_id"], named["h"]).alias("document")
    )
    # The same bound for the pair's own entity.
    both = both.where(share(F.least("c_e", "c_t")) >= generalise_at)
    pairs = both.groupBy("entity", "c_e", "term", "c_t").agg(
        F.count_distinct("document").alias("c_te"), F.count_distinct("context").alias("contexts")
    )
    judged = pairs.where(F.col("contexts") >= support).select("entity", "term", share(F.col("c_te")).alias("share"))
    judged = judged.where(F.col("share") >= generalise_at)
    return written(judged.select("entity", "term", (F.col("share") >= remove_at).alias("removed")), "pii-terms")


def document_terms(keyed: DataFrame, mentions: DataFrame, disclosing: DataFrame, everywhere: bool) -> DataFrame:
    """`doc_id, h, terms`: what to mask in each document beyond its base matches."""
    if everywhere:
        held = keyed.select("doc_id", "h", F.explode(F.array_distinct(_terms(F.col("t")))).alias("term"))
        named = held.join(disclosing.groupBy("term").agg(F.max("removed").alias("removed")), "term")
    else:
        named = mentions.select("doc_id", "h", "entity").distinct().join(disclosing, "entity")
    strict = named.groupBy("doc_id", "h", "term").agg(F.max("removed").alias("removed"))
    return written(
        strict.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.struct("term", "removed"))).alias("terms")),
        "pii-document-terms",
    )


def _term_pattern(terms: Column) -> Column:
    words = F.array_join(F.transform(terms, lambda x: x["term"]), "|")
    return F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), words, F.lit(r")(?![\p{L}\p{N}])"))


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["h"] == b["h"])


def _masker(kind: int, mask: str | None = None):
    """The text before a match, and the match, masked if it counts; nothing after the last gap."""

    def masked(gap: Column, match: Column) -> Column:
        return F.concat(gap, F.when(match.isNull(), "").when(valid(kind, match), mask or MASKS[kind]).otherwise(match))

    return masked


class Scan:
    """The tables of one scan: `mentions`, `disclosing` and `terms` by document."""

    def __init__(
        self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, everywhere: bool = False, **options
    ):
        self.docs, self.doc_id, self.text = docs, doc_id, text
        self.keyed = _keyed(docs, doc_id, text)
        self.mentions = entity_mentions(self.keyed, width)
        self.disclosing = disclosing_terms(self.keyed, self.mentions, **options)
        self.terms = document_terms(self.keyed, self.mentions, self.disclosing, everywhere)

    def spans(self) -> DataFrame:
        """`doc_id, base, all`: sorted arrays of (kind, start, end) per row."""
        k, t = self.keyed, self.terms
        k = _listed(k, t) if _few(t) else k
        hit = _joined(k, t).select("doc_id", "h", "t", _term_pattern(F.col("terms")).alias("p"))
        some = hit.select(
            "doc_id", "h", F.regexp_extract_all("t", "p", F.lit(0)).alias("matches"), F.split("t", F.col("p"), -1).alias("gaps")
        ).where(F.size("matches") > 0)
        added = _located(some, ["doc_id", "h"]).select("doc_id", "h", F.lit(4).alias("kind"), "start", "end")
        span = F.struct("kind", "start", "end")
        rows = self.mentions.select("doc_id", "h", "kind", "start", "end").unionByName(added)
        per = rows.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set(span)).alias("found"))
        base = F.filter("found", lambda x: x["kind"] < 4)
        both = per.select("doc_id", "h", "found", base.alias("base"))
        inside = lambda x: F.exists("base", lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"]))
        kept = F.filter("found", lambda x: (x["kind"] < 4) | ~inside(x))
        per = both.select("doc_id", "h", "base", kept.alias("all"))
        ids = self.keyed.select("doc_id", "h")
        none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
        return ids.join(per, _same_row(ids, per), "left").select(
            ids["doc_id"], F.coalesce("base", none).alias("base"), F.coalesce("all", none).alias("all")
        )

    def sanitised(self) -> DataFrame:
        """The documents, all columns as they were, with personal data masked in the text."""
        names = self.docs.columns
        row = F.struct(*[F.col(f"`{c}`") for c in names if c != self.text])
        t = F.col(f"`{self.text}`")
        rows = self.docs.select(
            row.alias("row"), F.col(f"`{self.doc_id}`").alias("doc_id"), F.xxhash64(F.coalesce(t, F.lit(""))).alias("h"), t.alias("t")
        )
        if _few(self.terms):
            # Only rows with terms move.
            joined = _joined(_listed(rows, self.terms), self.terms).select("row", "t", "terms")
            others = _listed(rows, self.terms, "left_anti")
            joined = joined.unionByName(others.select("row", "t", F.lit(None).cast(self.terms.schema["terms"].dataType).alias("terms")))
        else:
            joined = rows.join(self.terms, _same_row(rows, self.terms), "left").select("row", "t", "terms")
        for k, p in enumerate(PATTERNS):
            matches = F.regexp_extract_all("t", F.lit(p), F.lit(0))
            masked = F.array_join(F.zip_with(F.split("t", p, -1), matches, _masker(k)), "")
            joined = joined.withColumn("t", F.when(F.col("t").rlike(p), masked).otherwise(F.col("t")))
        removed = F.filter("terms", lambda x: x["removed"])
        general = F.filter("terms", lambda x: ~x["removed"])
        for chosen, mask in ((removed, ""), (general, "[TERM]")):
            text = F.regexp_replace("t", _term_pattern(chosen), F.lit(mask))
            joined = joined.withColumn("t", F.when(F.size(chosen) > 0, text).otherwise(F.col("t")))
        out = [
            (F.col("t") if c == self.text else F.col("row").getField(c)).alias(c) for c in names
        ]
        return joined.select(*out)


def span_text(spans: Column) -> Column:
    """`kind:start:end`, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda x: x["kind"] == number))
