"""Headline queries, timed: prints one JSON line.

Each table is first written out in as many files as there are cores, as a large table would lie: the given
ones are single files of one row group, which one task reads. Each query is then run in full into a no-op sink; the first run of each is a warm-up
at the same data and the better of two further runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from foliospark import session  # noqa: E402
from foliospark.plans import catalog  # noqa: E402

HEADLINE = [
    "p6_pii_summary_inline", "p6_pii_summary", "p3_detect_pii", "p8_redact_documents", "p8_redact_spans",
    "p9_redact_occurrences", "p11_detect_names", "c1_html_text", "c2_html_to_markdown", "c3_html_blocks",
    "c4_html_links", "c5_markdown_to_html", "c6_markdown_blocks", "c7_markdown_toc", "c8_email_body",
    "a3_build_requests", "a9_offline_title", "a10_offline_tags", "a11_offline_language", "a12_offline_description",
    "r3_route", "r6_resolve_options", "m5_map_metadata", "m6_resolve_collisions", "s7_metadata_json",
    "s3_parse_eml", "s4_parse_xml", "q2_conformance_summary", "q5_run_stats", "x1_run_tool",
]
TABLES = ["documents", "pages", "conversations", "events"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session.build(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"})
    folder = tempfile.mkdtemp(prefix="bench-")
    for name in TABLES:
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(int(cpus)).write.parquet(f"{folder}/{name}.parquet")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(3):
            started = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
