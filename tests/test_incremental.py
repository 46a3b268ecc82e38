"""Listings kept up to date over runs, against those made from all pages at once."""

import random

import pytest
from pyspark.sql import functions as F

from adgleaner.operators import candidates as cd, dedupe, listings as ls
from adgleaner.plans.incremental import PAGE, ListingState


def pages(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        row = dict.fromkeys(PAGE.names)
        row |= {
            "url": f"u{rng.randrange(60) if i % 3 else 0}", "text_key": f"t{rng.randrange(150)}", "title": f"title {i}",
            "text": "x", "domain": "d", "retrieved": f"2023-02-{rng.randrange(10, 28)}T00:00:{i % 60:02d}.{i:03d}+0000",
            "name": rng.choice([None, f"n{i}"]), "image": rng.choice([None, f"i{rng.randrange(5)}"]), "price": float(i),
        }
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, PAGE)


def at_once(df, collapse):
    return ls.typed_listings(cd.collapse_pages(dedupe.first_texts(df), collapse))


def table(df):
    return sorted(map(str, df.select(sorted(f"`{c}`" for c in df.columns)).collect()))


@pytest.mark.parametrize("collapse", ["row", "fields"])
def test_runs_in_any_order_equal_one(spark, tmp_path, collapse):
    df = pages(spark).cache()
    state = ListingState(spark, str(tmp_path / "s"), collapse, parts=4, buckets=3)
    lost = 0
    for run, part in enumerate(("retrieved >= '2023-02-20'", "retrieved < '2023-02-14'", "retrieved BETWEEN '2023-02-14' AND '2023-02-20'")):
        lost += state.merge(df.where(part), str(run))["lost"]
        seen = df.where(" OR ".join([part, "retrieved >= '2023-02-20'", *(["retrieved < '2023-02-14'"] if run else [])]))
        assert table(state.listings()) == table(at_once(seen, collapse))
    assert lost > 0
    # A run that is done again, and one without pages, change nothing.
    state.merge(df.where("retrieved < '2023-02-14'"), "again")
    state.merge(df.limit(0), "none")
    assert table(state.listings()) == table(at_once(df, collapse))


def test_a_url_whose_last_page_goes_is_not_listed(spark, tmp_path):
    first = pages(spark, 1).withColumns({"url": F.lit("late"), "retrieved": F.lit("2023-02-20")})
    earlier = first.withColumns({"url": F.lit("early"), "retrieved": F.lit("2023-02-10")})
    state = ListingState(spark, str(tmp_path / "s"), parts=2, buckets=2)
    assert state.merge(first, "1") == {"won": 1, "lost": 0}
    assert state.merge(earlier, "2") == {"won": 1, "lost": 1}
    assert [r.url for r in state.listings().collect()] == ["early"]


def test_a_run_that_failed_half_way_can_be_done_again(spark, tmp_path, monkeypatch):
    df = pages(spark).cache()
    state = ListingState(spark, str(tmp_path / "s"), parts=4, buckets=3)
    state.merge(df.where("retrieved >= '2023-02-18'"), "1")

    def broken(*_):
        raise RuntimeError("lost")

    for step in ("listings_now", "texts_now"):
        with monkeypatch.context() as m:
            m.setattr(state, step, broken)
            with pytest.raises(RuntimeError):
                state.merge(df.where("retrieved < '2023-02-18'"), step)
    state.merge(df.where("retrieved < '2023-02-18'"), "2")
    assert table(state.listings()) == table(at_once(df, "row"))


def shuffled_scans(df):
    """Tables of `state` that are read below an exchange of the final plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = text.split("Initial Plan")[-1].splitlines()
    found, exchange = [], []
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-*("))
        exchange = [d for d in exchange if d < depth]
        if "Exchange" in line:
            exchange.append(depth)
        if "Scan parquet spark_catalog" in line:
            found.append(bool(exchange))
    return found


def test_old_pages_are_not_shuffled_and_only_touched_folders_are_written(spark, tmp_path):
    df = pages(spark).cache()
    state = ListingState(spark, str(tmp_path / "s"), parts=8, buckets=4)
    state.merge(df, "1")
    new = pages(spark, 1, seed=9).withColumns({"url": F.lit("brand new"), "text_key": F.lit("new")})
    new.write.parquet(str(tmp_path / "new"))  # so that its values are no constants of the plan
    new = spark.read.parquet(str(tmp_path / "new"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        parts = state.winners.touched(new)
        assert len(parts) == 1
        moves = state.moves(new, state.texts.touched(new))
        assert shuffled_scans(moves) == [False]
        lists = state.listings_now(new.select("url"), parts)
        assert len(shuffled_scans(lists)) == 2 and not any(shuffled_scans(lists))
        now = state.pages_now(new, new.select("url", "text_key").limit(0), parts)
        # Of three reads of the old pages one moves: those of URLs that lose a page.
        assert shuffled_scans(now).count(True) <= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

    def files():
        return {str(p) for p in (tmp_path / "s" / "winners").glob("part=*/*.parquet")}

    before = files()
    state.merge(new, "2")
    changed = {p.split("part=")[1].split("/")[0] for p in before ^ files()}
    assert changed == {str(parts[0])}


def test_a_run_writes_each_table_once(spark, tmp_path):
    """Besides the tables, only what a run brings is kept: no second copy of what it puts in place."""
    state = ListingState(spark, str(tmp_path / "s"), parts=2, buckets=2)
    state.merge(pages(spark, n=20), "0")
    assert {p.name for p in (tmp_path / "s").iterdir()} == {"texts", "winners", "listings", "brought", "moves"}
