"""Entry points for spark-submit.

    spark-submit riskloom/main.py preprocess --raw RAW --work WORK [--config FILE]
    spark-submit riskloom/main.py train      --work WORK
    spark-submit riskloom/main.py evaluate   --work WORK --run RUN_ID
    spark-submit riskloom/main.py score      --raw RAW --work WORK --run RUN_ID --requests FILE --date 2024-01-31
    spark-submit riskloom/main.py batch      --raw RAW --work WORK --date 2024-01-31 [--intensity 0.5]
    spark-submit riskloom/main.py drift      --raw RAW --work WORK --date 2024-01-31
    spark-submit riskloom/main.py retrain    --raw RAW --work WORK [--force]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.config import DEFAULT, Config, load_config  # noqa: E402
from riskloom.plans import jobs  # noqa: E402
from riskloom.plans.ingest import ingest_split  # noqa: E402
from riskloom.session import build_session, release  # noqa: E402


def main(argv: list[str] | None = None, spark=None) -> int:
    parser = argparse.ArgumentParser(prog="riskloom")
    parser.add_argument("command", choices=("preprocess", "train", "evaluate", "score", "batch", "drift", "retrain"))
    for option in ("--raw", "--config", "--run", "--date", "--requests"):
        parser.add_argument(option)
    parser.add_argument("--work", required=True)
    parser.add_argument("--intensity", type=float)
    parser.add_argument("--force", action="store_true")
    args = parser.parse_args(argv)
    cfg = load_config(args.config) if args.config else DEFAULT
    if spark is not None:
        return run(spark, args, cfg)
    spark = build_session()
    try:
        return run(spark, args, cfg)
    finally:
        release(spark)


def run(spark, args: argparse.Namespace, cfg: Config) -> int:
    """One command on a given session."""
    batches = f"{args.work}/batches"

    def cleaned():
        return ingest_split(spark, args.raw, "train", cfg)[0]

    if args.command == "preprocess":
        print(jobs.preprocess_job(spark, args.raw, args.work, cfg).first().asDict())
    elif args.command == "train":
        print(jobs.train_job(spark, args.work, cfg))
    elif args.command == "evaluate":
        print(jobs.evaluate_job(spark, args.work, args.run, cfg).first()["metrics"].asDict())
    elif args.command == "score":
        counts = jobs.score_job(spark, args.requests, cleaned(), args.work, args.run, args.date, cfg)
        print({r["part"]: r["n_rows"] for r in counts.collect()})  # two rows
    elif args.command == "batch":
        jobs.generate_batch(cleaned(), batches, args.date, args.intensity, cfg)
    elif args.command == "drift":
        row = jobs.drift_then_retrain(spark, cleaned(), batches, args.work, args.date, cfg)
        print("no drift" if row is None else row.first().asDict())
    else:
        print(jobs.retrain(spark, cleaned(), args.work, cfg, args.force, batch_dir=batches).first().asDict())
    return 0


if __name__ == "__main__":
    sys.exit(main())
