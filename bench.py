"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run to the end into the noop sink. One untimed round first, so that the
numbers are about the plans and not about starting the JVM and the Python workers.
``BENCH_ALL=1`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwright.checks import all_queries  # noqa: E402
from shelfwright.session import build_session  # noqa: E402

HEADLINE = [
    "pages_scan",
    "slice_range",
    "clean_strict",
    "clean_tags_space",
    "links_all",
    "links_distinct",
    "url_route",
    "crawl_closure",
    "page_is_product_a",
    "extract_site_a",
    "extract_site_b",
    "specs_table",
    "datasheet_b",
    "variants",
    "tax_flatten",
    "embed_text",
    "knn_topk",
    "knn_topk_blocks",
    "knn_candidates",
    "classify_vector",
    "reconcile",
    "classify_end_to_end",
    "url_audit",
    "stream_items",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = all_queries()
    names = list(queries) if os.environ.get("BENCH_ALL") else HEADLINE
    times: dict[str, float] = {}
    for warm in (True, False):
        for name in names:
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            if not warm:
                times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
