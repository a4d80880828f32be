"""python -m failcast COMMAND ..."""

from __future__ import annotations

import argparse
import json
import os
import sys


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="failcast")
    sub = out.add_subparsers(dest="command", required=True)
    sub.add_parser("info", help="versions")
    p = sub.add_parser("scrape", help="fetch a span of range queries into hour partitions")
    p.add_argument("--url", default=os.environ.get("FAILCAST_URL"), required="FAILCAST_URL" not in os.environ)
    for name in ("--start", "--end", "--out"):
        p.add_argument(name, required=True)
    p.add_argument("--step", type=int, default=15)
    p.add_argument("--chunk-minutes", type=int, default=15)
    p = sub.add_parser("label", help="long frames to a labelled wide frame")
    p.add_argument("--source", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--lead", type=float, default=30)
    p.add_argument("--cooldown", type=float, default=5)
    p.add_argument("--table", help="also keep the frame as a table laid out by entity")
    p = sub.add_parser("trace", help="trace CSVs to a labelled wide frame")
    for name in ("--source", "--work", "--out"):
        p.add_argument(name, required=True)
    p = sub.add_parser("fetch", help="download trace archives")
    p.add_argument("--base-url", required=True)
    p.add_argument("--target", required=True)
    p = sub.add_parser("features", help="labelled frames to split feature frames")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--inputs", nargs="+", default=[])
    source.add_argument("--table", help="a table that label has kept")
    p.add_argument("--out", required=True)
    p.add_argument("--dispatch", choices=("frame", "row"), default="frame")
    p = sub.add_parser("train", help="baseline and boosted trees")
    p.add_argument("--source", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--dataset", default="unversioned")
    p.add_argument("--trials", type=int, default=50)
    return out


def main(args: list[str] | None = None, spark=None) -> int:
    a = parser().parse_args(args)
    if a.command == "fetch":
        from failcast.sources.fetch import fetch

        print("\n".join(map(str, fetch(a.base_url, a.target))))
        return 0
    from pyspark.sql import SparkSession

    from failcast.plans import jobs

    spark = spark or SparkSession.builder.appName("failcast").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "info":
        made = jobs.info(spark)
    elif a.command == "scrape":
        made = jobs.scrape(spark, a.out, url=a.url, start=a.start, end=a.end, step=a.step, chunk_minutes=a.chunk_minutes)
        if not made:
            print("no samples in the span", file=sys.stderr)
            return 2
    elif a.command == "label":
        made = jobs.label(spark, a.source, a.out, lead_minutes=a.lead, cooldown_minutes=a.cooldown, table=a.table)
    elif a.command == "trace":
        made = jobs.label_trace(spark, a.source, a.work, a.out)
    elif a.command == "features":
        made = jobs.features(spark, a.inputs, a.out, a.dispatch, table=a.table)
    else:
        made = jobs.train(spark, a.source, a.out, dataset=a.dataset, trials=a.trials)["gates"]
    print(json.dumps(made, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
