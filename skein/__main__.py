"""python -m skein run|compile ROOT [--since DATE] [--run-id ID] [--feeds FILE]"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .plans.artifact import compiled
from .sources import feeds, jsonl
from .streaming.ingest import ingest_batch


def main() -> None:
    p = argparse.ArgumentParser()
    p.add_argument("command", choices=["run", "compile"])
    p.add_argument("root")
    p.add_argument("--since", default="")
    p.add_argument("--run-id", default="run")
    p.add_argument("--feeds", default="feeds.yaml")
    a = p.parse_args()
    spark = SparkSession.builder.getOrCreate()
    if a.command == "run":
        configs = feeds.feed_configs(a.feeds)
        items, warnings = feeds.read_feeds(spark, configs, a.since)
        told = tuple(r[0] for r in warnings.collect())  # a row a feed at most
        print(json.dumps(ingest_batch(spark, items, a.root, a.run_id, a.since, told, len(configs))))
    print(json.dumps(compiled(*[jsonl.read(spark, f"{a.root}/{t}", t) for t in ("sources", "claims", "edges", "tasks")])))


if __name__ == "__main__":
    main()
