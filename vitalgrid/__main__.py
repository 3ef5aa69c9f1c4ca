"""Jobs for spark-submit: aggregate, weeks, train, score, score-new, recover, stream, report."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from vitalgrid import config as C
from vitalgrid.plans import pipeline
from vitalgrid.session import clean_up, staged
from vitalgrid.sources import readers, recover
from vitalgrid.sources.runs import DAY


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vitalgrid", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("aggregate", help="weekly profiles joined to the history")
    for name in ("vitals", "history", "out"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--single-file", action="store_true")

    job = jobs.add_parser("weeks", help="profiles by calendar week")
    for name in ("vitals", "out"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--zone", default="UTC", help="whose midnights part the weeks")
    job.add_argument("--slide", type=int, default=7, help="days from one window's start to the next")

    job = jobs.add_parser("train", help="split, train, evaluate and save a model")
    for name in ("history", "out"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--target", default=C.TARGET_COLUMN)
    job.add_argument("--drop-unlabelled", action="store_true")
    job.add_argument("--test-share", type=float, default=C.TEST_SHARE)
    job.add_argument("--seed", type=int, default=C.SPLIT_SEED)
    job.add_argument("--max-levels", type=int)
    job.add_argument("--rounds", type=int, default=C.TreeParams.max_iter)
    job.add_argument("--step-size", type=float, default=C.TreeParams.step_size)
    job.add_argument("--max-depth", type=int, default=C.TreeParams.max_depth)
    job.add_argument("--method", choices=pipeline.METHODS, default=pipeline.METHODS[0], help="classifier: Spark ML, or second-order leaf weights")
    job.add_argument("--by-patient", action="store_true", help="all rows of an id in one part")
    job.add_argument("--subsample", type=float, default=C.TreeParams.subsampling_rate)

    job = jobs.add_parser("score", help="score processed files")
    for name in ("processed", "feature-list", "model", "predictions"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--which", choices=("all", "first", "latest"), default="all")
    job.add_argument("--max-rows", type=int)
    job.add_argument("--order", nargs="+", help="columns that order the rows for a cap or made-up ids")
    job.add_argument("--run-id", help="a named run replaces itself")
    job.add_argument("--report-to", help="folder for alerts, alert lines and summary")
    job.add_argument("--threshold", type=float, default=C.ALERT_THRESHOLD)

    job = jobs.add_parser("score-new", help="score the files that no run has scored yet")
    for name in ("inputs", "feature-list", "model", "predictions"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--report-to", help="folder for alerts, alert lines and summary")
    job.add_argument("--threshold", type=float, default=C.ALERT_THRESHOLD)

    job = jobs.add_parser("recover", help="delete what unfinished runs have left")
    job.add_argument("--predictions", required=True)
    job.add_argument("--older-than", type=float, default=DAY, help="seconds; younger runs may be at work")

    job = jobs.add_parser("stream", help="score processed files as they arrive")
    for name in ("processed", "feature-list", "model", "sink"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--checkpoint", help="by default a folder in the sink")
    job.add_argument("--keep-running", action="store_true", help="instead of one pass over what is there")

    job = jobs.add_parser("report", help="analytics over predictions and processed files")
    for name in ("processed", "predictions", "out"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--triage-size", type=int, default=C.TRIAGE_SIZE)
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = SparkSession.builder.appName(f"vitalgrid-{args.job}").getOrCreate()
    if args.job == "aggregate":
        shown = pipeline.aggregate_job(spark, args.vitals, args.history, args.out, args.single_file)
        print(f"{shown.rows} rows of {len(shown.columns)} columns: {', '.join(shown.columns)}")
        for row in shown.head:
            print(row)
    elif args.job == "weeks":
        shown = pipeline.weekly_job(spark, args.vitals, args.out, args.zone, args.slide)
        print(f"{shown.rows} rows of {len(shown.columns)} columns: {', '.join(shown.columns)}")
    elif args.job == "score-new":
        scorer = pipeline.saved_scorer(spark, args.model, args.feature_list)
        pipeline.score_new_files(spark, args.inputs, args.predictions, scorer, None, args.threshold, report_to=args.report_to).show(truncate=False)
    elif args.job == "recover":
        print("deleted:", ", ".join(recover(spark, args.predictions, args.older_than)) or "nothing")
    elif args.job == "train":
        tree = C.TreeParams(args.rounds, args.step_size, args.max_depth, args.subsample)
        settings = C.Settings(test_share=args.test_share, seed=args.seed, max_levels=args.max_levels, tree=tree)
        table = readers.read_training(spark, args.history)
        done = pipeline.training_job(
            table, args.out, settings, args.target, drop_unlabelled=args.drop_unlabelled, method=args.method, by_patient=args.by_patient
        )
        area = "undefined" if done.auc is None else f"{done.auc:.4f}"
        print(f"{len(done.features)} features, area under ROC {area}")
    elif args.job == "score":
        run = pipeline.scoring_job(
            spark,
            args.processed,
            args.feature_list,
            args.model,
            args.predictions,
            C.Settings(max_rows=args.max_rows, alert_threshold=args.threshold),
            args.which,
            args.order,
            args.run_id,
            args.report_to,
        )
        run.summary.show(truncate=False)
    elif args.job == "stream":
        pipeline.streaming_job(
            spark,
            args.processed,
            args.feature_list,
            args.model,
            args.sink,
            args.checkpoint,
            available_now=not args.keep_running,
        ).awaitTermination()
    else:
        # Parsed once, then read as parquet by every report.
        tables = pipeline.report_job(
            staged(readers.read_predictions(spark, args.predictions), "predictions"),
            staged(readers.read_processed(spark, args.processed), "processed"),
            C.Settings(triage_size=args.triage_size),
        )
        for name, report in tables.items():
            report.write.mode("overwrite").option("header", True).csv(f"{args.out}/{name}")
    clean_up(spark)
    spark.stop()


if __name__ == "__main__":
    main()
