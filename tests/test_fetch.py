"""Image fetch: how often an address is loaded over runs, and how many loads a host sees at once."""

import os
import time
from collections import Counter
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from adgleaner.operators import images as im, rules as rl
from adgleaner.plans import jobs
from adgleaner.sources import sinks
from checks import ads
from tests.conftest import DATA


def log_of(folder):
    return sorted(tuple(open(folder / name).read().split()) for name in os.listdir(folder))


def noted(folder, address, seconds=0.0):
    start = time.time()
    time.sleep(seconds)
    with open(folder / f"{start}-{os.getpid()}-{abs(hash(address))}", "w") as f:
        f.write(f"{address} {start} {time.time()}")


def images(spark, addresses):
    df = spark.createDataFrame([(f"id{i}", a) for i, a in enumerate(addresses)], "id string, image string")
    return im.distinct_images(df)


def test_a_host_sees_few_loads_at_once_and_a_hot_one_is_spread(spark, tmp_path):
    def load(address):
        noted(tmp_path, address, 0.05)
        return b"x"

    addresses = [f"https://hot.example/{i}" for i in range(60)] + [f"https://h{i % 10}.example/{i}" for i in range(20)]
    fetch = im.fetch_with(load, lambda path, data: None, "imgs", tasks=6, threads=16, per_host=2)
    got = fetch(images(spark, addresses)).collect()
    assert len(got) == 80 and all(r.tried and r.image_path for r in got)
    loads = log_of(tmp_path)
    assert Counter(a for a, _, _ in loads) == Counter(addresses)
    times = [(float(t), step) for a, b, e in loads if "hot" in a for t, step in ((b, 1), (e, -1))]
    running = most = 0
    for _, step in sorted(times):
        running += step
        most = max(most, running)
    assert most == 2


def test_a_dead_host_is_given_up_and_others_go_on(spark, tmp_path):
    def load(address):
        noted(tmp_path, address)
        if "dead" in address:
            time.sleep(60)
        return b"x"

    addresses = [f"https://dead.example/{i}" for i in range(40)] + [f"https://fine.example/{i}" for i in range(40)]
    fetch = im.fetch_with(load, lambda path, data: None, "imgs", tasks=1, threads=4, timeout=0.2, per_host=2, give_up=2)
    start = time.time()
    got = fetch(images(spark, addresses)).collect()
    assert time.time() - start < 30
    assert sum("fine" in r.image and r.image_path is not None for r in got) == 40
    dead = [r for r in got if "dead" in r.image]
    assert len(dead) == 40 and sum(r.tried for r in dead) == 4 and not any(r.image_path for r in dead)
    assert sum("dead" in a for a, _, _ in log_of(tmp_path)) == 4


def test_failed_images_wait_longer_each_time(spark):
    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [("once", 2, False), ("once long ago", 3, False), *[("twice", h, False) for h in (9, 5)], *[("often", h, False) for h in range(100, 105)]]
    rows += [("later", 1, False), ("later", 0, True)]
    tried = spark.createDataFrame([(a, now - timedelta(hours=h), ok) for a, h, ok in rows], im.ATTEMPT)
    left = im.not_due(tried, now, timedelta(hours=3), 5)
    assert sorted(r.image for r in left.collect()) == ["often", "once", "twice"]


def test_loads_over_three_runs(spark, tmp_path):
    loads = tmp_path / "loads"
    loads.mkdir()

    def load(address):
        noted(loads, address)
        if address.endswith("/a1.png"):
            raise OSError("gone")
        return b"x"

    raw = ads.raw_pages(spark, DATA).where("variant IN (1, 6)").cache()
    clock = [datetime(2024, 1, 1, tzinfo=timezone.utc)]
    options = jobs.JobOptions(
        fetch=im.fetch_with(load, lambda path, data: None, "imgs"), rules=rl.rules_table(spark, ads.RULES), now=lambda: clock[0]
    )
    seen = []
    for run, hours in enumerate((0, 0.5, 2)):
        clock[0] = datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(hours=hours)
        part = raw.where(F.col("p") % 3 == (1, 0, 2)[run]).drop("p", "variant", "crawl")
        sinks.write_jsonl(part, str(tmp_path / f"in/{run}/data_pages"), "deflate")
        jobs.crawl_job(spark, str(tmp_path / "in/*/data_pages"), str(tmp_path / "out"), options)
        seen.append(Counter(a for a, _, _ in log_of(loads)))
    bad = "https://img.example.com/a1.png"
    assert [s[bad] for s in seen] == [1, 1, 2]
    assert len(seen[-1]) > 5 and all(n == 1 for a, n in seen[-1].items() if a != bad)
    listings = spark.read.parquet(str(tmp_path / "out/listings"))
    assert listings.where("image IS NOT NULL AND image_path IS NULL").select("image").distinct().collect()[0].image == bad
