"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores (default 8)
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adgleaner.session import build_session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = (
    "page_text_by_domain",
    "page_texts",
    "decoded_contents",
    "repaired_texts",
    "first_documents",
    "unseen_documents",
    "candidate_rows",
    "listings_by_row",
    "listings_by_field",
    "index_listings",
    "image_ranked_rows",
    "rows_with_usable_image",
    "listings_with_image_path",
    "resolved_locations",
    "zero_shot_labels",
    "custom_scores",
    "event_windows",
    "crawl_job_listings",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The JVM and the Python workers start outside the clock.
    QUERIES["custom_scores"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total wall-clock of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
