import pytest

from tests.conftest import rows, spark  # noqa: F401

LONG = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))


def hard_texts() -> list[str | None]:
    """Null, empty, blank, one word, copies, near copies, runs without blanks, very long."""
    base = " ".join(f"base{i}" for i in range(80))
    near = base.replace("base40", "changed")
    far = " ".join(f"base{i}" for i in range(40)) + " " + " ".join(f"other{i}" for i in range(40))
    return [
        None, "", " \t\n", "word", "one two three four", "one two three four", "ONE two three FOUR",
        base, base, base.upper(), near, far, PASSAGE + " tail one two", "head three four " + PASSAGE,
        "x" * 300_000, "1" * 50_000, "a" * 30_000 + "@" + "b" * 30_000, ". " * 40_000, "né à " * 300,
        LONG, LONG[:400_000] + " end",
    ]


@pytest.fixture(scope="session")
def hard(spark):
    """Hard texts, a row without id, a repeated row, an id with two texts, and columns whose names the operators use inside."""
    texts = hard_texts()
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 2}", len(t or ""), "extra") for i, t in enumerate(texts)]
    rows += [(None, "a row without an id", "en", None, 1, "x"), rows[7], (3, "a second text of id three", "de", "src0", 1, "x")]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, h string")
    for name in ("t", "w", "row", "cid", "comp", "key", "n", "label", "score", "size", "kind", "terms", "anchor", "found", "_gone"):
        plain = plain.selectExpr("*", f"'clash' AS {name}")
    return plain.repartition(3).cache()


@pytest.fixture(scope="session")
def empty(hard):
    return hard.limit(0).cache()


@pytest.fixture(scope="session")
def hard_rows(hard):
    return [(r.doc_id, r.text) for r in hard.select("doc_id", "text").collect()]
