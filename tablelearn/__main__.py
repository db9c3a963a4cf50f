"""Run the reference programs from the command line (``spark-submit`` or ``python -m``).

    python -m tablelearn segment  --input customers.csv --output out/
    python -m tablelearn classify --input ads.csv --kind random_forest --num-trees 4000 --output out/
    python -m tablelearn regress  --input salary.csv --features YearsExperience --label Salary --output out/
    python -m tablelearn levels   --train pos_train.csv --test pos_test.csv --kind decision_tree --output out/
    python -m tablelearn stock-etl --input prices.csv --output prices.parquet
    python -m tablelearn stock-train --input prices.parquet --epochs 3000 --output out/

The session comes from ``SparkSession.builder.getOrCreate()``, so the
cluster's own settings (master, shuffle partitions, ``spark.checkpoint.dir``)
apply. Results are written as Parquet under ``--output``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tablelearn.plans import programs
from tablelearn.plans.sequence_model import SequenceConfig, forecast_overlay
from tablelearn.session import ensure_checkpoint_dir
from tablelearn.sources.sinks import write_parquet


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tablelearn")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("segment", help="k-means segments of a CSV table")
    s.add_argument("--input", required=True)
    s.add_argument("--features", nargs="+", default=["Annual Income (k$)", "Spending Score (1-100)"])
    s.add_argument("-k", type=int, default=5)
    s.add_argument("--seed", type=int, default=1)
    s.add_argument("--output", required=True)

    c = sub.add_parser("classify", help="split, fit, score and metrics of a classifier")
    c.add_argument("--input", required=True)
    c.add_argument("--kind", default="decision_tree", choices=["decision_tree", "logistic", "naive_bayes", "random_forest"])
    c.add_argument("--features", nargs="+", default=["Age", "EstimatedSalary"])
    c.add_argument("--label", default="Purchased")
    c.add_argument("--seed", type=int, default=123)
    c.add_argument("--split", default="random", choices=["random", "key"])
    c.add_argument("--key")
    c.add_argument("--handle-invalid", default="error", choices=["error", "skip", "keep"])
    c.add_argument("--num-trees", type=int)
    c.add_argument("--max-iter", type=int)
    c.add_argument("--output", required=True)

    r = sub.add_parser("regress", help="linear regression and its actual-vs-predicted series")
    r.add_argument("--input", required=True)
    r.add_argument("--features", nargs="+", default=["YearsExperience"])
    r.add_argument("--label", default="Salary")
    r.add_argument("--weights", nargs=2, type=float, default=[0.66, 0.34])
    r.add_argument("--seed", type=int, default=123)
    r.add_argument("--output", required=True)

    lv = sub.add_parser("levels", help="tree regressor over a feature grid")
    lv.add_argument("--train", required=True)
    lv.add_argument("--test", required=True)
    lv.add_argument("--kind", default="decision_tree", choices=["decision_tree", "random_forest"])
    lv.add_argument("--feature", default="Level")
    lv.add_argument("--label", default="Salary")
    lv.add_argument("--grid-step", type=float, default=0.01)
    lv.add_argument("--num-trees", type=int)
    lv.add_argument("--output", required=True)

    e = sub.add_parser("stock-etl", help="daily CSV -> next-day table as Parquet")
    e.add_argument("--input", required=True)
    e.add_argument("--output", required=True)

    t = sub.add_parser("stock-train", help="train the sequence model and write the forecast table")
    t.add_argument("--input", required=True)
    t.add_argument("--epochs", type=int, default=3000)
    t.add_argument("--hidden", type=int, default=512)
    t.add_argument("--dense", type=int, default=32)
    t.add_argument("--frame-size", type=int, default=50)
    t.add_argument("--batch-size", type=int, default=512)
    t.add_argument("--split-ratio", type=float, default=0.98)
    t.add_argument("--learning-rate", type=float, default=0.05)
    t.add_argument("--averaging-frequency", type=int, default=4)
    t.add_argument("--workers", type=int, default=4, help="averaging slots")
    t.add_argument("--mode", default="frame", choices=["frame", "carry"], help="score from a zero or a carried state")
    t.add_argument("--since", default="2017-01-01")
    t.add_argument("--output", required=True)
    for parser in (s, c, r, lv, e):
        parser.add_argument("--schema", help="column names and types of the CSV (DDL); spares the inference pass")
        parser.add_argument("--null-value", help="text that stands for NULL in the CSV")
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tablelearn-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    out = args.output.rstrip("/")
    csv = {"schema": getattr(args, "schema", None), "null_value": getattr(args, "null_value", None)}
    if args.cmd == "segment":
        df = programs.segment_customers(spark, args.input, tuple(args.features), k=args.k, seed=args.seed, csv=csv)
        write_parquet(df.drop("features"), f"{out}/segments")
    elif args.cmd == "classify":
        params = {}
        if args.num_trees:
            params["numTrees"] = args.num_trees
        if args.max_iter:
            params["maxIter"] = args.max_iter
        res = programs.classify_purchases(
            spark,
            args.input,
            args.kind,
            tuple(args.features),
            args.label,
            seed=args.seed,
            split_by=args.split,
            key=args.key,
            handle_invalid=args.handle_invalid,
            csv=csv,
            **params,
        )
        write_parquet(res.scored.drop("features", "rawPrediction", "probability"), f"{out}/scored")
        write_parquet(res.confusion, f"{out}/confusion")
        write_parquet(res.metrics, f"{out}/metrics")
    elif args.cmd == "regress":
        df = programs.regress_linear(
            spark, args.input, tuple(args.features), args.label, weights=tuple(args.weights), seed=args.seed, csv=csv
        )
        write_parquet(df, f"{out}/series")
    elif args.cmd == "levels":
        params = {"numTrees": args.num_trees} if args.num_trees else {}
        df = programs.regress_levels(
            spark, args.train, args.test, args.kind, args.feature, args.label, grid_step=args.grid_step, csv=csv, **params
        )
        write_parquet(df, f"{out}/series")
    elif args.cmd == "stock-etl":
        programs.process_stock_csv(spark, args.input, out, csv)
    elif args.cmd == "stock-train":
        names = ("epochs", "hidden", "dense", "frame_size", "batch_size", "split_ratio", "learning_rate", "averaging_frequency", "workers")
        cfg = SequenceConfig.reference(**{n: getattr(args, n) for n in names})
        table, model = programs.train_stock_model(
            spark, args.input, cfg, since=args.since, model_path=f"{out}/models", mode=args.mode
        )
        write_parquet(table, f"{out}/forecast")
        write_parquet(forecast_overlay(spark.read.parquet(f"{out}/forecast")), f"{out}/series")
        write_parquet(model.history_df(spark), f"{out}/history")


if __name__ == "__main__":
    main()
