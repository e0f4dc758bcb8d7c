"""Run one job: ``python -m cardwatch <job> ...`` or through ``spark-submit``."""

from __future__ import annotations

import argparse
import datetime as dt

from cardwatch.plans import jobs
from cardwatch.session import build_session
from cardwatch.sources.readers import split_paths


def parser() -> argparse.ArgumentParser:
    today = dt.date.today().isoformat()
    root = argparse.ArgumentParser(prog="cardwatch")
    chosen = root.add_subparsers(dest="job", required=True)

    def job(name: str, *, dated: bool) -> argparse.ArgumentParser:
        sub = chosen.add_parser(name)
        sub.add_argument("--inputs", required=True, help="comma-separated folders or globs")
        if dated:
            sub.add_argument("--date_from", default=today)
            sub.add_argument("--date_to", default=today)
        return sub

    job("convert", dated=False).add_argument("--outputs", required=True)
    label = job("label", dated=False)
    label.add_argument("--outputs", required=True)
    label.add_argument("--by_lists", action="store_true")
    label.add_argument("--seed", type=int, default=0)
    features = job("features", dated=True)
    features.add_argument("--outputs", required=True)
    features.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    features.add_argument("--lookback", type=int)
    features.add_argument(
        "--day_folders", action="store_true", help="inputs hold folders YYYY-MM-DD.parquet"
    )
    train = job("train", dated=True)
    train.add_argument("--model", required=True)
    train.add_argument("--draws", type=int, default=16)
    train.add_argument("--folds", type=int, default=10)
    train.add_argument("--seed", type=int, default=42)
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(args.job)
    if args.job == "convert":
        jobs.convert_job(spark, args.inputs, split_paths(args.outputs))
    elif args.job == "label":
        outputs = split_paths(args.outputs)
        jobs.label_job(spark, args.inputs, outputs, by_lists=args.by_lists, seed=args.seed)
    elif args.job == "features":
        jobs.feature_job(
            spark,
            args.inputs,
            split_paths(args.outputs),
            args.date_from,
            args.date_to,
            fmt=args.format,
            lookback=args.lookback,
            day_folders=args.day_folders,
        )
    else:
        jobs.training_job(
            spark,
            args.inputs,
            args.model,
            args.date_from,
            args.date_to,
            draws=args.draws,
            folds=args.folds,
            seed=args.seed,
        ).show(truncate=False)


if __name__ == "__main__":
    main()
