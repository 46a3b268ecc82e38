"""Operators on small frames, and what their plans must and must not hold."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from adgleaner import schema
from adgleaner.operators import candidates as cd, classify as cl, counts, dedupe, images as im
from adgleaner.operators import listings as ls, pages as pg, places, skew
from adgleaner.operators.shape import compute_once, spread
from adgleaner.plans import jobs
from adgleaner.streaming import windows
from checks import ads
from checks.queries import QUERIES
from tests.conftest import DATA


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "text, error",
    [
        (None, True), ("", True), ("page Not found here", True), ("not found", False), ("fine", False),
        ("Search results for: x", True), ("No exact matches found", True),
    ],
)
def test_error_text(rows, text, error):
    assert rows("t string", [(text,)], pg.is_error_text(F.col("t"))) == [(error,)]


@pytest.mark.parametrize(
    "text, hit",
    [
        ("Item NOT   found.", True), ("it is not-found", True), ("not, found", True), ("knot found", False),
        ("not foundry", False), ("no exact matches found", True), ("", False), (None, False),
    ],
)
def test_phrases(rows, text, hit):
    assert rows("t string", [(text,)], pg.has_phrase(F.col("t"))) == [(hit,)]


def test_computed_columns_are_not_computed_again_by_a_filter(spark):
    df = spark.createDataFrame([("a b",)], "c string")
    made = compute_once(df, ["c"], t=F.regexp_replace("c", " ", "")).where("t <> '' AND NOT contains(t, 'x')")
    assert plan_of(made).count("regexp_replace(") == 1
    assert made.collect() == [("a b", "ab")]


def test_first_per_cuts_groups_down_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END"))
    first = dedupe.first_per(df, ["k"], [F.col("id")])
    plan = plan_of(first)
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "Partial" in below and "WindowGroupLimit" in below
    assert first.where("k = 'hot'").collect()[0]["id"] == 0 and first.count() == 667


def test_first_texts_order(spark):
    rows = [("u2", "t", "2"), ("u1", "t", "2"), ("u3", "t", "3"), ("u4", "s", "9")]
    df = spark.createDataFrame(rows, "url string, text_key string, retrieved string")
    assert sorted(r.url for r in dedupe.first_texts(df).collect()) == ["u1", "u4"]


def test_admitted_hits(spark):
    rows = [(("fine",), None, 1), (("Not found",), "c", 2), ((None,), "c", 3), (None, "c", 4), (None, "", 5), (None, None, 6)]
    hits = spark.createDataFrame(rows, "_source struct<text:string>, content string, n int")
    assert sorted(r.n for r in pg.admitted_hits(hits).collect()) == [1, 4]


def test_ids_are_unique(spark):
    df = spark.range(0, 1000, 1, 4).select(dedupe.random_id().alias("u"), dedupe.row_number_id().alias("n"))
    assert df.agg(F.countDistinct("u"), F.countDistinct("n")).first() == (1000, 1000)
    assert {len(r.u) for r in df.limit(5).collect()} == {36}


def test_split_by_manifest(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "source_file string")
    manifest = spark.createDataFrame([("a", True), ("b", False)], "source_file string, has_image_path boolean")
    pending, repair = dedupe.split_by_manifest(files, manifest)
    assert [r[0] for r in pending.collect()] == ["c"] and [r[0] for r in repair.collect()] == ["b"]


def brute_left_join(left, right):
    paths = dict(right)
    return sorted((i, k, paths.get(k) if k is not None else None) for i, k in left)


@pytest.mark.parametrize("n_cold", [0, 50])
def test_left_join_with_hot_and_null_keys(spark, n_cold):
    left = [(i, "hot") for i in range(300)] + [(1000 + i, None) for i in range(300)]
    left += [(2000 + i, f"k{i}") for i in range(3000)]
    right = [("hot", "H")] + [(f"k{i}", f"P{i}") for i in range(n_cold)] + [("unused", "U")]
    lf = spark.createDataFrame(left, "id long, image string")
    n = lf.groupBy("image").count()
    rf = spark.createDataFrame(right, "image string, path string").join(n, "image", "left").select(
        "image", "path", F.coalesce("count", F.lit(0)).alias("n_rows")
    )
    got = skew.left_join_spread(lf, rf, "image", "n_rows", "id")
    assert sorted(tuple(r) for r in got.collect()) == brute_left_join(left, right)
    assert got.columns == ["id", "image", "path"]


@pytest.mark.parametrize("key", [None, "hot"])
def test_rows_without_a_key_to_look_up_are_dealt_out(spark, key):
    rows = spark.range(0, 8000, 1, 4).select(
        F.col("id"), F.expr(f"CASE WHEN id % 2 = 0 THEN {repr(key) if key else 'NULL'} ELSE concat('k', id) END").alias("k")
    )
    right = rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("v"))
    joined = skew.left_join_spread(rows, right, "k", "n", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_task = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in per_task) == 8000
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 8000 / 4


def test_hot_keys_are_few(spark):
    n = 5000
    right = spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(3).cast("long").alias("n_rows"))
    total = right.agg(F.sum("n_rows")).first()[0]
    assert right.where(F.col("n_rows") >= total * skew.HOT_SHARE).count() == 0


def test_collapse_fields_passes_over_null(spark):
    rows = [
        ("u", "t", "x", "d", "1", "k1", None, 1.0, None),
        ("u", "t2", "y", "d", "2", "k2", "n", 2.0, "i"),
        ("v", None, "z", "d", "1", "k3", None, None, None),
    ]
    df = spark.createDataFrame(
        rows, "url string, title string, text string, domain string, retrieved string, text_key string,"
        " name string, price double, image string"
    )
    for c in schema.FOUND_FIELDS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    for parts in (1, 7):
        got = {r.url: r for r in cd.collapse_fields(df.repartition(parts)).collect()}
        assert (got["u"].title, got["u"].name, got["u"].price, got["u"].image) == ("t", "n", 1.0, "i")
        assert (got["v"].title, got["v"].name) == (None, None)
        got = {r.url: r for r in cd.collapse_row(df.repartition(parts)).collect()}
        assert (got["u"].title, got["u"].image, got["u"].price) == ("t2", "i", 2.0)


def test_listings_do_not_depend_on_row_order(spark):
    raw = ads.raw_pages(spark, DATA).drop("p", "variant", "crawl")
    for collapse in ("row", "fields"):
        seen = {
            parts: sorted(map(str, ls.listings_from_raw(raw.repartition(parts), collapse=collapse).collect()))
            for parts in (1, 7)
        }
        assert seen[1] == seen[7] and len(seen[1]) > 100


def test_listing_plan_shuffles_only_for_text_and_url(spark):
    raw = ads.raw_pages(spark, DATA).drop("p", "variant", "crawl").select("*")
    pages = pg.read_pages(pg.decode_pages(raw))
    plan = plan_of(ls.listings(pages))
    assert plan.count("Exchange hashpartitioning(text_key") == 1
    assert plan.count("Exchange hashpartitioning(url") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_listings_of_nothing(spark):
    raw = spark.createDataFrame([], schema.RAW_PAGE)
    out = ls.listings_from_raw(raw)
    assert out.count() == 0 and out.columns == [*schema.LISTING.names, "id"]
    assert {f.name: f.dataType for f in out.schema}["price"].simpleString() == "double"


def test_seen_texts_are_left_out(spark):
    raw = ads.raw_pages(spark, DATA).drop("p", "variant", "crawl")
    pages = pg.read_pages(pg.decode_pages(raw))
    seen = pg.admit(pages).where(F.col("site") == "shop0").select("text_key")
    left = ls.listings(pages, seen=seen)
    assert left.where(F.col("domain").startswith("shop0.")).count() == 0
    assert left.count() < ls.listings(pages).count()


def test_images_are_fetched_once_and_failures_are_null(spark, tmp_path):
    rows = [(f"id{i}", "http://a") for i in range(5)] + [("x", "http://bad"), ("y", None)]
    df = spark.createDataFrame(rows, "id string, image string")
    log, folder = str(tmp_path / "log"), str(tmp_path / "img")

    def load(address):
        with open(log, "a") as f:
            f.write(address + "\n")
        if address.endswith("bad"):
            raise OSError("no such image")
        return b"png"

    def save(path, data):
        import os

        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)

    import os.path

    fetch = im.fetch_with(load, save, folder, os.path.exists)
    out = im.add_images(df, fetch, str(tmp_path / "images"))
    got = {r.id: r.image_path for r in out.collect()}
    assert got["id0"] == got["id4"] == f"{folder}/id0.png" and got["x"] is None and got["y"] is None
    assert sorted(open(log).read().split()) == ["http://a", "http://bad"]
    im.add_images(df, fetch, str(tmp_path / "again")).collect()
    assert sorted(open(log).read().split()) == ["http://a", "http://bad", "http://bad"]


def test_no_fetcher_passes_listings_through(spark):
    df = spark.createDataFrame([("a", "b")], "id string, image string")
    assert im.add_images(df, None) is df


def test_first_known_part_of_a_location_wins(spark):
    df = spark.createDataFrame(
        [("1", "Nowhere, York , Peru"), ("2", "Peru, York"), ("3", "Nowhere"), ("4", None)], "id string, location string"
    )
    names = spark.createDataFrame([("York",), ("Peru",)], "name string")
    got = {r.id: r.place for r in places.resolve_locations(df, names).collect()}
    assert got == {"1": "York", "2": "Peru", "3": None, "4": None}


def test_misspelt_places_meet_by_deletions(spark):
    known = ["York", "Peru", "Lima", "New York", "Rio", "Zürich", "Deutschland"]
    seen = ["Yorkk", "Yrk", "Xork", "Nowhere, Limma, Peru", "New Yorke, Lima", "Roi", "Rio", "Zurich", "Deutschlnd", "Duetschland",
            "", ",,", None, "Per, u", "x" * 5000, "Limu, Lime", "York, Peru"]
    near = {"Yorkk": "York", "Yrk": None, "Xork": "York", "Roi": None, "Deutschlnd": "Germany", "Duetschland": None, "Zurich": "Zürich",
            "Nowhere, Limma, Peru": "Peru", "New Yorke, Lima": "Lima", "Limu, Lime": "Lima", "York, Peru": "York", "Rio": "Rio"}
    df = spark.createDataFrame([(str(i), x, "clash") for i, x in enumerate(seen * 2)], "id string, location string, name string")
    names = spark.createDataFrame([(n, "Germany" if n == "Deutschland" else n) for n in known] + [(None, "none")], "name string, place string")
    got = places.resolve_misspelt(df, names)
    assert got.columns == [*df.columns, "place"] and got.count() == len(seen) * 2
    assert {r.location: r.place for r in got.collect()} == {x: near.get(x) for x in seen}
    two = {r.location: r.place for r in places.resolve_misspelt(df, names, edits=2).collect()}
    assert two["Duetschland"] == "Germany" and two["Yrk"] is None and two["Roi"] is None
    assert places.resolve_misspelt(df.limit(0), names).count() == 0
    assert places.resolve_misspelt(df, names.limit(0)).where("place is not null").count() == 0
    assert "CartesianProduct" not in plan_of(got) and "NestedLoop" not in plan_of(got)


def test_observed_counts(spark):
    df, watch = counts.observed(spark.range(10), "run", rows=F.count("*"), even=F.count_if(F.col("id") % 2 == 0))
    df.collect()
    assert watch.get == {"rows": 10, "even": 5}


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 100, 1, 8)
    assert spread(wide) is wide
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 8


# --- classification ----------------------------------------------------------


def test_zero_shot_matches_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)] + [(100, None), (101, [0.0] * 6)]
    labels = [(n, rng.normal(size=6).tolist()) for n in "cab"]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    lf = spark.createDataFrame(labels, "label string, vector array<double>")
    got = {r.id: (r.label_product, r.score_product) for r in cl.zero_shot(df, "v", lf).collect()}
    names = sorted(n for n, _ in labels)
    matrix = np.array([dict(labels)[n] for n in names])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    for i, v in rows[:40]:
        cosines = matrix @ np.array(v) / np.linalg.norm(v)
        weights = np.exp(cosines)
        assert got[i] == (names[cosines.argmax()], pytest.approx(weights.max() / weights.sum()))
    assert got[100] == (None, None) and got[101] == ("a", pytest.approx(1 / 3))


def test_too_many_labels_are_refused(spark):
    df = spark.range(cl.MAX_LABELS + 1).select(F.col("id").cast("string").alias("label"), F.array(F.lit(1.0)).alias("vector"))
    with pytest.raises(ValueError):
        cl.label_matrix(df, "label", "vector")


LISTED = "title string, name string, description string, image_path string, quality int"


def listed(spark):
    rows = [("red toy", None, "d", "i1", 1), ("blue toy", None, "d", None, 1), ("a real animal", None, "d", "i2", 0),
            ("an animal", None, "d", "i3", 0), (None, None, None, "i4", None)]
    return spark.createDataFrame(rows, LISTED)


def test_classify_tasks(spark):
    df = listed(spark)
    model = cl.train_text_model(cl.with_product_text(df).where("quality IS NOT NULL"), "product", "quality", 64)
    zero = cl.classify(df, "zero-shot-classification").collect()
    assert len(zero) == 4 and {r.label_product for r in zero if r.title == "a real animal"} == {"a real animal"}
    text = {r.title: (r.label, r.score) for r in cl.classify(df, "text-classification", model=model).collect()}
    assert text["red toy"][0] == 1 and text["an animal"][0] == 0 and all(0.5 <= s <= 1 for _, s in text.values())
    both = cl.classify(df, "both", model=model)
    assert {"label_product", "score_product", "label", "score"} <= set(both.columns)
    with pytest.raises(ValueError):
        cl.classify(df, "other")
    with pytest.raises(ValueError, match="image_path"):
        cl.classify(df.drop("image_path"), "multi-model")


def test_text_image_labels_keep_their_column_for_no_rows(spark, tmp_path):
    df = cl.with_product_text(listed(spark)).withColumn("features", F.array(F.lit(1.0), F.length("title").cast("double")))
    df = cl.image_vectors(df, "features", "vector")
    model = cl.train_text_image_model(df.where("quality IS NOT NULL"), "product", "vector", 2, "quality", 64)
    out = cl.text_image_labels(df, model)
    assert out.count() == 3 and dict(out.dtypes)["predicted_label"] == "int"
    assert cl.text_image_labels(df.where("image_path = 'none'"), model).columns[-1] == "predicted_label"
    assert cl.classify(df, "multi-model", model=model).count() == 3
    model.write().overwrite().save(str(tmp_path / "model"))
    again = cl.load_model(str(tmp_path / "model"))
    assert cl.load_model(str(tmp_path / "model")) is again
    assert sorted(map(str, cl.text_image_labels(df, again).collect())) == sorted(map(str, out.collect()))


def test_custom_scorer_over_two_columns(spark):
    df = spark.createDataFrame([("ab", 1), ("abc", 2)], "a string, b long")
    scored = df.select(cl.score_with(lambda: lambda a, b: a.str.len() * b, "bigint", F.col("a"), F.col("b")).alias("s"))
    assert sorted(r.s for r in scored.collect()) == [2, 6]


# --- windows -----------------------------------------------------------------


def test_last_window_may_run_past_the_end():
    start = datetime(2024, 1, 1, 0, 30)
    assert windows.run_end(start, datetime(2024, 1, 1, 2, 30)) == datetime(2024, 1, 1, 2, 30)
    assert windows.run_end(start, datetime(2024, 1, 1, 2, 31)) == datetime(2024, 1, 1, 4, 30)


def test_windows_are_half_open(spark):
    df = spark.sql("SELECT explode(array(timestamp'2024-01-01 00:29:59', timestamp'2024-01-01 00:30:00',"
                   " timestamp'2024-01-01 02:29:59', timestamp'2024-01-01 02:30:00')) AS ts, 1 AS value")
    got = windows.window_counts(df, "ts", datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 1, 2, 0)).collect()
    assert [(r.window_start, r.n_rows) for r in got] == [(datetime(2024, 1, 1, 0, 30), 2)]


def test_kept_report(spark):
    got = jobs.kept_report(ads.raw_pages(spark, DATA)).agg(F.sum("raw_rows"), F.sum("kept_rows")).first()
    assert got[0] > got[1] > 0


def test_time_range_reaches_the_scan(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    scan = plan_of(pg.in_time_range(events, "ts", datetime(2024, 1, 2), datetime(2024, 1, 3)).select("event_id"))
    assert "GreaterThanOrEqual(ts" in scan and "LessThan(ts" in scan


def test_texts_meet_their_vectors_once(spark, tmp_path):
    """Training and scoring read stored rows: scoring joins nothing again."""
    spark.range(40).selectExpr("id AS doc_id", "concat(if(id % 2 = 0, 'good ', 'bad '), id) AS text", "'en' AS lang", "'s' AS source").write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(30).selectExpr("id AS doc_id", "cast(id % 2 as int) AS quality", "0 AS toxic").write.parquet(str(tmp_path / "labels.parquet"))
    spark.range(10, 40).selectExpr("id AS vec_id", "transform(sequence(1, 64), i -> cast(i * (id % 2) as float)) AS embedding").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = QUERIES["text_image_quality_labels"](spark, str(tmp_path))
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: (r.image_path, r.predicted_label) for r in found.collect()} == {i: (f"images/{i}", i % 2) for i in range(10, 40)}
