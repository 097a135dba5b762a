"""Jobs: python -m rigwatch stream|train ... (or spark-submit with the same arguments)."""

from __future__ import annotations

import argparse

from rigwatch.operators import features, training
from rigwatch.session import get_session, materialise
from rigwatch.sinks.archive import write_parquet
from rigwatch.sources.files import first_with_all, scan_parquet
from rigwatch.streaming import jobs


def stream(args: argparse.Namespace) -> None:
    spark = get_session("rigwatch-stream")
    jobs.run(spark, args.servers, args.archive, args.checkpoints)
    try:
        jobs.wait_for_any(spark)
    finally:
        jobs.stop_all(spark)


def train(args: argparse.Namespace) -> None:
    """Cycle features, labels and models from the archives; both come from the first folder that has them."""
    spark = get_session("rigwatch-train")
    root = first_with_all(spark, args.archive, ["raw", "labels"])
    readings = scan_parquet(spark, f"{root}/raw")
    labels = features.newest_labels(scan_parquet(spark, f"{root}/labels"))
    wide = features.cycle_features(readings)
    data = materialise(features.join_labels(wide, labels.drop("timestamp"), fill=True), "training")
    write_parquet(data, f"{args.out}/labelled")
    models, metrics, weights = training.train(data, args.target, args.seed)
    training.save_run(models, metrics, weights, {"target": args.target, "seed": args.seed}, args.out)
    metrics.orderBy("model", "metric").show(truncate=False)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="rigwatch")
    commands = parser.add_subparsers(required=True)
    s = commands.add_parser("stream", help="window statistics and archives from the message bus")
    s.add_argument("--servers", required=True)
    s.add_argument("--archive", required=True)
    s.add_argument("--checkpoints", required=True)
    s.set_defaults(run=stream)
    t = commands.add_parser("train", help="train classifiers on the archives")
    t.add_argument("--archive", required=True, nargs="+", help="archive folders, primary first")
    t.add_argument("--out", required=True)
    t.add_argument("--target", default="label_cooler")
    t.add_argument("--seed", type=int, default=training.SEED)
    t.set_defaults(run=train)
    args = parser.parse_args(argv)
    args.run(args)


if __name__ == "__main__":
    main()
