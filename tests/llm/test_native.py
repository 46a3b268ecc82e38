"""Quality rules, licences, personal data and decontamination against plain versions."""

import hashlib
import re
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from adgleaner.llm import decontaminate, licences, pii, quality_rules
from adgleaner.llm.licence_texts import MIT
from tests.llm.conftest import PASSAGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(grams)
    hit = set()
    for i, g in enumerate(grams):
        if many[g] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_measures(hard, hard_rows):
    got = quality_rules.measures(hard).collect()
    want = Counter((i, *plain_measures(t)) for i, t in hard_rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want


def test_repeated_windows_and_lines(spark):
    texts = ["a b c a b c", "a b c d a b c", "a a a a", "x\nx\n\n \nx", "a b c " * 40 + "# $"]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    for r in quality_rules.measures(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_measures(texts[r.doc_id])


def test_thresholds_follow_the_source(spark):
    """A source full of symbols keeps its texts; the same text elsewhere goes."""
    odd = lambda i: " ".join(f"w{i}x{j} #" for j in range(40))
    clean = lambda i: " ".join(f"w{i}x{j} v{j}y{i}" for j in range(40))
    rows = [(i, odd(i), "en", "code") for i in range(30)] + [(100 + i, clean(i), "en", "prose") for i in range(30)]
    rows += [(200, odd(200), "en", "prose"), (201, odd(201), "en", "rare"), (202, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(df, min_docs=20).collect()}
    assert all(kept[i] for i in range(30)) and all(kept[100 + i] for i in range(30))
    assert not kept[200] and kept[202] is False
    assert kept.keys() == {r[0] for r in rows}


def test_quality_of_hard_and_empty(hard, empty, hard_rows):
    judged = quality_rules.judge(hard)
    assert judged.count() == len(hard_rows) and not judged.where("base_failed and kept").count()
    assert quality_rules.judge(empty).count() == 0


def test_spellings_of_a_licence(spark):
    variant = MIT.upper().replace("COPYRIGHT (C) <YEAR> <COPYRIGHT HOLDERS>", "© 2020 Some One\nCopyright 2021 Other").replace(",", " ,")
    british = MIT.replace("sublicense", "sub-licence").replace("MIT License", "MIT Licence").replace("NONINFRINGEMENT", "NON-INFRINGEMENT")
    rows = [(0, MIT), (1, variant), (2, british), (3, MIT + " more"), (4, "text\n  released under the MIT licence\nend"), (5, None), (6, "Copyright me")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(df, licences.known_licences(spark)).collect()}
    assert [got[i].whole_licence for i in range(7)] == ["MIT", "MIT", "MIT", None, None, None, None]
    assert got[4].notices == "MIT" and got[4].n_notices == 1
    assert got[5].text_digest == got[6].text_digest == hashlib.sha256(b"").hexdigest()


def test_licences_of_hard_and_empty(spark, hard, empty, hard_rows):
    known = licences.known_licences(spark)
    assert licences.scan(hard, known).count() == len(hard_rows)
    assert licences.scan(empty, known).count() == 0
    assert licences.scan(hard, known.limit(0)).where("whole_licence is not null").count() == 0


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    def luhn(s):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0

    def counts(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == 0:
            return True
        if kind == 1:
            return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in value.split("."))
        return 16 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 8 <= len(digits) <= 15

    found = []
    for kind, p in enumerate(PATTERNS):
        # The plain patterns are quadratic on long runs; none of those holds a match of theirs.
        found += [(kind, m.start(), m.end()) for m in re.finditer(p, text) if counts(kind, m[0])]
    return found


TRICKY = [
    "a@b.c_d@e.f and a@b.c@d.e x@y z@.q me@site.org. é@b.co ñ a.b+c%d@e-f.g.h",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.003.255 1.2.3 999.999.999.99999999999999999999 10.0.0.1é",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 4111  1111 0000000000000000000 00000000000000000000",
    "+1 (555) 010-9999 +12345678 +1234567 + 1 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +44.20.7946.0958) +1-",
    " ".join(f"user{i}@example{i}.org" for i in range(700)),
]


def test_base_spans(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.base] for r in pii.Scan(df).spans().collect()}
    assert got == {i: plain_spans(t) for i, t in enumerate(TRICKY)}


def test_spans_of_hard_and_empty(hard, empty, hard_rows):
    scan = pii.Scan(hard)
    spans = scan.spans()
    assert spans.count() == len(hard_rows)
    mail = next(i for i, t in hard_rows if t and "@" in t)
    assert not [r for r in spans.collect() if r.base]  # "bbb" has no dot, runs of digits are too long
    clean = scan.sanitised()
    assert clean.columns == hard.columns
    key = lambda rows: Counter((r.doc_id, r.text, r.h) for r in rows)
    assert key(clean.collect()) == key(hard.collect()) and mail is not None
    assert pii.Scan(empty).spans().count() == 0 and pii.Scan(empty).sanitised().count() == 0


def disclosure_rows():
    filler = [f"plain text number {i} with the usual words" for i in range(60)]
    named = [f"note {i}: the surgeon Zebulon wrote from zeb@clinic.org about case {i}" for i in range(4)]
    # A copy proves nothing: one context, many rows.
    copied = ["only here quixotic mail q@x.org again"] * 5
    other = ["Zebulon alone", "the surgeon again"] + [f"surgeon number {i}" for i in range(30)]
    return list(enumerate(filler + named + copied + other))


def test_terms_that_disclose(spark):
    rows = disclosure_rows()
    scan = pii.Scan(spark.createDataFrame(rows, "doc_id long, text string"), support=3)
    found = {(r.entity, r.term): r.removed for r in scan.disclosing.collect()}
    # zebulon: 4 of 5 documents; surgeon: 4 of 35; wrote, about, case and note: all 4.
    assert ("0:zeb@clinic.org", "zebulon") in found and not found["0:zeb@clinic.org", "zebulon"]
    assert found["0:zeb@clinic.org", "wrote"]
    assert not [k for k in found if k[1] in ("surgeon", "the", "quixotic") or "q@x" in k[0]]
    text = {r.doc_id: r.text for r in scan.sanitised().collect()}
    assert "zeb@" not in text[60] and "Zebulon" not in text[60] and "[EMAIL]" in text[60] and "[TERM]" in text[60]
    assert "surgeon" in text[60] and text[69] == "Zebulon alone" and "quixotic" in text[64]
    spans = {r.doc_id: r for r in scan.spans().collect()}
    whole = dict(rows)[60]
    terms = [whole[x.start : x.end].lower() for x in spans[60]["all"] if x.kind == 4]
    assert "zebulon" in terms and "wrote" in terms
    assert [tuple(x) for x in spans[60]["all"] if x.kind < 4] == [tuple(x) for x in spans[60].base]


def test_terms_far_away_and_in_other_documents(spark):
    """Terms may stand far from the entity, after numbers that are no cards, and in documents without it."""
    far = " ".join(f"between{k}" for k in range(20))
    named = [f"Quillfeather case 12 34 {i}. {far} {i} 2024 to quill@clinic.org about {i} things" for i in range(4)]
    filler = [f"plain text number {i} with between{i % 20} " + far for i in range(60)]
    rows = list(enumerate([*named, *filler, "Quillfeather alone", "John Smith 2024 card 4111111111111111 end"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scan = pii.Scan(df, everywhere=True)
    found = {r.term for r in scan.disclosing.where("entity = '0:quill@clinic.org'").collect()}
    assert "quillfeather" in found and "between3" not in found and not {"quill", "clinic"} & found
    text = {r.doc_id: r.text for r in scan.sanitised().collect()}
    assert "Quillfeather" not in " ".join(text.values()) and text[64].endswith("alone") and text[10] == rows[10][1]
    spans = {r.doc_id: r for r in scan.spans().collect()}
    assert [tuple(x) for x in spans[64]["all"]] == [(4, 0, 12)] and not spans[64].base
    card = pii._base_matches(pii._keyed(df.where("doc_id = 65"), "doc_id", "text")).collect()
    assert [(r.start, r.end, r.before, r.after) for r in card if r.kind == 2] == [(21, 37, "John Smith 2024 card ", " end")]


LETTERS = regex.compile(r"[\p{L}\p{N}]+")


def plain_shingles(text):
    w = LETTERS.findall((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_found(docs, items):
    out = {}
    for i, t in docs:
        s = plain_shingles(t)
        for k, q in items:
            v = plain_shingles(q)
            n = len(s & v)
            if v and 100 * n >= 75 * len(v):
                out[i, k] = max(out.get((i, k), (0, 0)), (n, len(v)))
    return out


def test_containment(spark, hard, empty, hard_rows):
    words = PASSAGE.split()
    items = [
        (0, PASSAGE), (1, " ".join(words[:20])), (2, "one, two; THREE four!"), (3, None), (4, ""), (5, "nothing like it is here at all"),
        (6, " ".join([*words[:35], "changed", *words[35:50]])), (7, " ".join(f"w{i}x{i}" for i in range(100, 900))), (1, " ".join(words[:20])),
    ]
    df = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in decontaminate.find(hard, df).collect()}
    assert got == plain_found(hard_rows, items) and len(got) >= 6
    left = decontaminate.without_items(hard, df)
    assert left.columns == hard.columns
    bad = {i for i, _ in got}
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in hard_rows if i not in bad)
    assert decontaminate.find(empty, df).count() == 0 and decontaminate.find(hard, df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op3_licences", "op7_warc", "op9_jaccard_join", "op10_decontamination"])
def test_queries_that_have_sql(spark, name):
    from tests.compare import differences, duck
    from tests.conftest import DATA

    assert differences(spark, duck(DATA), name, DATA) is None


def test_contract_columns(spark):
    from adgleaner.llm.queries import QUERIES
    from tests.conftest import DATA

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = QUERIES["op4_personal_data"](spark, DATA).collect()
    for r in got:
        spans = plain_spans(docs[r.doc_id])
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in spans) for k in range(4))
    assert len(got) == len(docs)
    rows = QUERIES["op1_quality_rules"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    for r in rows.collect():
        n, chars, symbols, lines, repeats = plain_measures(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n) and not (r.kept and r.base_failed)
    judged = rows.where(~F.col("base_failed")).join(labels, "doc_id")
    assert judged.where("quality = 1 and not kept").count() <= 0.05 * judged.where("quality = 1").count()


def test_only_texts_with_terms_move(spark, monkeypatch):
    """However the rows to look at are found, spans and masks are the same; texts without terms are left where they lie."""
    rows = [(i, f"{'ab'[i % 2]} code{i % 2} said word{i} to a{i % 2}@x.org in place{i * 7}") for i in range(8)]
    rows += [(i, f"nothing said of place{i}") for i in range(8, 40)] + [(None, rows[0][1]), rows[1], (90, None), (91, rows[2][1] + " 10.0.0.1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))

    def found():
        scan = pii.Scan(df, everywhere=True)
        spans = scan.spans()
        return sorted(map(str, spans.collect())), sorted(map(str, scan.sanitised().collect())), spans

    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        spans, masked, frame = found()
        assert any("term" in s or "kind=4" in s for s in spans) and frame.columns == ["doc_id", "base", "all"]
        assert "BroadcastHashJoin" in frame._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(pii, "MAX_BROADCAST_ROWS", 0)
        assert found()[:2] == (spans, masked)
    finally:
        spark.conf.set(threshold, before)
