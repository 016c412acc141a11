"""Command-line runner for the batch stages on real files.

  python -m faultline clean    --data DIR --intervals FILE --out DIR
  python -m faultline rules    --out DIR --rules FILE [--rules-format csv|parquet]
  python -m faultline features --out DIR [--bucket-hours H]
  python -m faultline model    --out DIR [--family gbt|rf] [--train-end TS --test-start TS]
  python -m faultline errors   --out DIR [--label label_4h] [--family gbt] [--threshold 0.7]

Stages communicate through files under --out (shared storage on a cluster).
The session comes from spark-submit; with no master set, a local one is used.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from faultline.functions.timecols import US_PER_HOUR
from faultline.operators import split as S
from faultline.plans import stages
from faultline.sources.telemetry import load_intervals, load_rules, load_telemetry


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("faultline").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="faultline")
    sub = p.add_subparsers(dest="stage", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--data", required=True)
    c.add_argument("--intervals", required=True)
    c.add_argument("--out", required=True)
    r = sub.add_parser("rules")
    r.add_argument("--out", required=True)
    r.add_argument("--rules", required=True)
    r.add_argument("--rules-format", default="csv")
    f = sub.add_parser("features")
    f.add_argument("--out", required=True)
    f.add_argument("--bucket-hours", type=float, default=None,
                   help="width of the time buckets; by default from the data")
    m = sub.add_parser("model")
    m.add_argument("--out", required=True)
    m.add_argument("--family", default="gbt", choices=["gbt", "rf"])
    m.add_argument("--train-end", default=S.TRAIN_END)
    m.add_argument("--test-start", default=S.TEST_START)
    e = sub.add_parser("errors")
    e.add_argument("--out", required=True)
    e.add_argument("--family", default="gbt")
    e.add_argument("--label", default="label_4h")
    e.add_argument("--threshold", type=float, default=0.7)
    e.add_argument("--test-start", default=S.TEST_START)
    a = p.parse_args(argv)

    spark = _session()
    from faultline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    out = a.out.rstrip("/")
    if a.stage == "clean":
        stages.stage_clean(load_telemetry(spark, a.data), load_intervals(spark, a.intervals), out)
    elif a.stage == "rules":
        clean = spark.read.parquet(f"{out}/cleaned_telemetry")
        from faultline.plans.features import with_micros
        cmp = stages.stage_rules(spark, with_micros(clean), load_rules(spark, a.rules, a.rules_format), out)
        print(json.dumps(cmp.first().asDict()))
    elif a.stage == "features":
        clean = spark.read.parquet(f"{out}/cleaned_telemetry")
        iv = spark.read.parquet(f"{out}/cleaned_intervals")
        stages.stage_features(clean, iv, out, bucket_us=int(a.bucket_hours * US_PER_HOUR) if a.bucket_hours else None)
    elif a.stage == "model":
        rows = stages.stage_model(spark, f"{out}/features", out, a.train_end, a.test_start, family=a.family)
        for row in rows.collect():
            print(json.dumps(row.asDict()))
    elif a.stage == "errors":
        rep = stages.stage_scored_errors(spark, f"{out}/scored_{a.family}_{a.label}", a.threshold)
        text = json.dumps(rep, indent=2, ensure_ascii=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite") \
            .text(f"{out}/error_analysis_{a.family}_{a.label}")
        print(text)
    return 0
