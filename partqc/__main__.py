"""Command-line entry for the two jobs (PySpark starts the session; cluster
settings come from spark-defaults or PYSPARK_SUBMIT_ARGS):

    python -m partqc train --csv data/prepared.csv --model model --key _c0
    python -m partqc serve --model model --bootstrap host:9092 \
        --input readings --output alerts --checkpoint /shared/checkpoints/alerts
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import serve


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    ap = argparse.ArgumentParser(prog="partqc")
    sub = ap.add_subparsers(dest="job", required=True)
    t = sub.add_parser("train", help="fit, save and report the production model")
    t.add_argument("--csv", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--key", required=True, help="row key column(s), comma separated")
    t.add_argument("--exact", action="store_true", help="exact instead of ratio-based under-sampling")
    t.add_argument("--seed", type=int, default=13)
    s = sub.add_parser("serve", help="score a Kafka topic and write alerts")
    s.add_argument("--model", required=True)
    s.add_argument("--bootstrap", required=True)
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--trigger", default=None, help='e.g. "10 seconds"; default: back to back')
    s.add_argument("--console", action="store_true")
    s.add_argument("--max-offsets-per-trigger", type=int, default=None)
    s.add_argument("--min-partitions", type=int, default=None)
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"partqc-{args.job}").getOrCreate()
    if args.job == "train":
        keys = [k.strip() for k in args.key.split(",") if k.strip()]
        rep = serve.train_job(spark, args.csv, args.model, keys if len(keys) > 1 else keys[0],
                              exact=args.exact, seed=args.seed)
        rep.report.show(truncate=False)
        rep.confusion.show(truncate=False)
        return rep
    query = serve.serve_job(spark, args.model, args.bootstrap, args.input, args.output, args.checkpoint,
                            trigger=args.trigger, console=args.console,
                            max_offsets_per_trigger=args.max_offsets_per_trigger,
                            min_partitions=args.min_partitions)
    query.awaitTermination()
    return query


if __name__ == "__main__":
    main()
