"""The registered query set: one Spark query per operator, each with an
independent DuckDB SQL oracle where the result has a closed form.

Stand-in inputs (FIXTURES.md §4) are built from the given tables with the
library's own operators: daily bars of ``orders`` (one long series) and of
``events`` (one series per event type), ``part`` for regression, and
``documents ⋈ labels`` for classification. Every query reads whole tables.
Doubles are rounded (and every column aliased) identically on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablelearn import functions as tf
from tablelearn.operators import evaluate, features, report, sequence, shaping, split
from tablelearn.plans import models
from tablelearn.plans import recurrent as rn
from tablelearn.plans.block_scoring import carry_states, forecast_blocks, score_blocks
from tablelearn.plans.block_training import fit_blocks, prepare_blocks
from tablelearn.plans.model_store import ModelStore
from tablelearn.plans.sequence_model import SequenceConfig, SequenceModel, forecast_overlay, prepare_series
from tablelearn.plans.tree_tables import leaf_boxes, score_boxes
from tablelearn.session import materialize, scratch_path
from tablelearn.sources import load_table, read_csv, read_parquet, register, sql
from tablelearn.sources.sinks import load_model, preview, save_model, write_csv, write_parquet

PRICES = ["Open", "Close", "Low", "High"]
NEXT_PRICES = ["NextOpen", "NextClose", "NextLow", "NextHigh"]
SINCE = "1998-01-01"

# --------------------------------------------------------------------------- stand-ins


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long daily series: orders per calendar day, open/close by order key, volume = count."""
    return shaping.daily_bars(
        load_table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", tie_col="o_orderkey", volume="count"
    )


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several daily series: events per (event_type, day), open/close by (ts, event_id), volume = sum (2 digits)."""
    return shaping.daily_bars(
        load_table(spark, sf_dir, "events"),
        "ts",
        "value",
        key="event_type",
        tie_col="event_id",
        volume="sum",
        volume_digits=2,
    )


def order_next_days(spark: SparkSession, sf_dir: str, since_day: str | None = None) -> DataFrame:
    return shaping.next_day_join(order_days(spark, sf_dir), "Date", PRICES + ["Volume"], since_day=since_day)


def documents_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels with two numeric features of the whole text.

    The join comes first, so the regular expression runs only on labelled
    documents; the result is a small numeric table, written once to the
    shared folder because every learner passes over it several times.
    """
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    labels = load_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    joined = docs.join(labels, on="doc_id").select(
        "doc_id", "n_chars", tf.non_letter_count("text").alias("non_letters"), "quality", "toxic"
    )
    feats = joined.withColumn(
        "non_letter_share", F.try_divide(F.col("non_letters").cast("double"), F.col("n_chars").cast("double"))
    )
    return materialize(feats, "documents-labelled")


# SQL text of the same stand-ins for the oracles.
_ORDER_DAYS_SQL = """
SELECT CAST(o_orderdate AS DATE) AS Date,
       arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS Open,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS Close,
       min(o_totalprice) AS Low, max(o_totalprice) AS High, CAST(count(*) AS DOUBLE) AS Volume
FROM orders WHERE o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL
GROUP BY 1"""

_EVENT_DAYS_SQL = """
SELECT event_type, CAST(ts AS DATE) AS Date,
       arg_min(value, (ts, event_id)) AS Open, arg_max(value, (ts, event_id)) AS Close,
       min(value) AS Low, max(value) AS High, round(sum(value), 2) AS Volume
FROM events WHERE ts IS NOT NULL AND value IS NOT NULL
GROUP BY 1, 2"""

_NEXT_DAYS_SQL = f"""
WITH bars AS ({_ORDER_DAYS_SQL}),
ahead AS (
  SELECT bars.*, lead(Date) OVER t AS following, lead(Open) OVER t AS NextOpen, lead(Close) OVER t AS NextClose,
         lead(Low) OVER t AS NextLow, lead(High) OVER t AS NextHigh, lead(Volume) OVER t AS NextVolume
  FROM bars WINDOW t AS (ORDER BY Date))
SELECT * EXCLUDE (following) FROM ahead WHERE date_diff('day', Date, following) = 1"""

_DOCS_SQL = """
SELECT d.doc_id, d.n_chars,
       length(regexp_replace(d.text, '\\p{L}', '', 'g')) AS non_letters, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

def _rounded(x: float, digits: int) -> float:
    """A model coefficient rounded for reporting; ``+ 0.0`` turns a rounded -0.0 into 0.0."""
    return round(float(x), digits) + 0.0


# --------------------------------------------------------------------------- sources / sinks


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S6: part written as CSV to the shared scratch folder, read back with inferred types."""
    path = write_csv(load_table(spark, sf_dir, "part"), scratch_path(spark, "part-csv"))
    back = read_csv(spark, path)
    return back.select(
        F.col("p_partkey").cast("long").alias("p_partkey"),
        "p_name",
        "p_brand",
        "p_type",
        F.col("p_size").cast("int").alias("p_size"),
        F.col("p_retailprice").cast("double").alias("p_retailprice"),
    )


def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S6: nation written as Parquet (overwrite) and scanned back."""
    path = write_parquet(load_table(spark, sf_dir, "nation"), scratch_path(spark, "nation-parquet"))
    return read_parquet(spark, path)


# --------------------------------------------------------------------------- shaping


def q_daily_ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily open/close/low/high/volume per event type (the stand-in daily price series)."""
    return event_days(spark, sf_dir)


def q_next_day_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + F2 + F3 + F6 + A2 + C1 + C2 on the long orders series."""
    return order_next_days(spark, sf_dir)


def q_event_next_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 per key: each event type's day joined with the same type's next calendar day."""
    return shaping.next_day_join(event_days(spark, sf_dir), "Date", PRICES + ["Volume"], key="event_type")


def q_event_minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 per key: each event type's prices scaled with that type's own bounds (size-checked join)."""
    days = event_days(spark, sf_dir)
    scaled = features.minmax_scale(days, PRICES, key="event_type")
    return scaled.select("event_type", "Date", *[F.round(c, 9).alias(c) for c in PRICES])


def q_next_day_join_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + S4 (+ J1): the next-day join as SQL text over a registered view."""
    view = f"bars_{uuid.uuid4().hex[:8]}"
    values = PRICES + ["Volume"]
    # Both sides of the join read the view; the bars are made and stored once.
    register(materialize(shaping.dedupe(shaping.drop_incomplete(order_days(spark, sf_dir))), "order-days"), view)
    return sql(
        spark,
        f"SELECT today.*, {', '.join(f'tomorrow.{c} AS Next{c}' for c in values)} "
        f"FROM {view} AS today INNER JOIN {view} AS tomorrow ON datediff(tomorrow.Date, today.Date) = 1 "
        "AND tomorrow.Date = date_add(today.Date, 1)",
    )


def q_stock_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10 end to end: the orders' daily bars as a dated CSV file in the shared folder, read
    back with inferred types, next-day joined, filtered, deduplicated and written as Parquet."""
    from tablelearn.plans.programs import process_stock_csv

    csv_path = write_csv(
        order_days(spark, sf_dir).select("Date", "Open", "High", "Low", "Close", "Volume"),
        scratch_path(spark, "stock-csv"),
    )
    return process_stock_csv(spark, csv_path, scratch_path(spark, "stock-parquet"))


def q_since_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 + F5 + O3: the feature/label column list of the rows from 1998 on, in date order."""
    df = order_next_days(spark, sf_dir, SINCE)
    return shaping.project(df, ["Date"] + PRICES + NEXT_PRICES).orderBy("Date")


def q_minmax_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: min and max of the eight price columns of the next-day table in one aggregate."""
    return features.minmax_stats(order_next_days(spark, sf_dir), PRICES + NEXT_PRICES)


def _scaled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    nd = materialize(order_next_days(spark, sf_dir), "order-next-days")
    stats = features.minmax_stats(nd, PRICES + NEXT_PRICES)  # bounds over all rows, as the reference
    rows = shaping.project(shaping.since(nd, "Date", SINCE), ["Date"] + PRICES + NEXT_PRICES)
    return features.minmax_scale(rows, PRICES + NEXT_PRICES, stats), stats


def q_minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 + C4 + J2: rows from 1998 on scaled with bounds taken over all rows."""
    scaled, _ = _scaled(spark, sf_dir)
    return scaled.select("Date", *[F.round(c, 9).alias(c) for c in PRICES + NEXT_PRICES])


def q_minmax_unscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scaled rows mapped back with the same bounds."""
    scaled, stats = _scaled(spark, sf_dir)
    back = features.minmax_unscale(scaled, PRICES + NEXT_PRICES, stats)
    return back.select("Date", *[F.round(c, 6).alias(c) for c in PRICES + NEXT_PRICES])


# --------------------------------------------------------------------------- series


def _event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.sliding_frames(
        event_days(spark, sf_dir), "Date", PRICES, 5, key="event_type", bucket_rows=64
    )


def _order_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    nd = order_next_days(spark, sf_dir)
    return sequence.sliding_frames(nd, "Date", PRICES, 50, labels=NEXT_PRICES, bucket_rows=500)


def q_sliding_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W2 + C6: frames of 5 days per event type (reference count max(1, N-T))."""
    fr = _event_frames(spark, sf_dir)
    return fr.select(
        "event_type",
        "frame_idx",
        "n_frames",
        "start",
        "end",
        F.size("x").alias("size"),
        F.element_at(F.element_at("x", 1), 2).alias("first_close"),
        F.element_at(tf.last_step("x"), 2).alias("last_close"),
    )


def q_order_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 on one long series with labels (T = 50, the reference frame size)."""
    fr = _order_frames(spark, sf_dir)
    return fr.select(
        "frame_idx",
        "n_frames",
        "start",
        "end",
        F.element_at(tf.last_step("x"), 2).alias("last_close"),
        F.element_at(tf.last_step("y"), 2).alias("last_next_close"),
    )


def q_lineitem_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 on a skewed multi-series input: frames of 5 line items per return flag (one flag holds
    about half of all rows), ordered by ship date then line key; whole table."""
    li = load_table(spark, sf_dir, "lineitem")
    fr = sequence.sliding_frames(
        li,
        ["l_shipdate", "l_orderkey", "l_linenumber"],
        ["l_quantity", "l_extendedprice"],
        5,
        key="l_returnflag",
    )
    return fr.select(
        "l_returnflag",
        "frame_idx",
        "n_frames",
        F.col("start").cast("date").alias("start"),
        F.col("end").cast("date").alias("end"),
        F.element_at(F.element_at("x", 1), 1).alias("first_qty"),
        F.element_at(tf.last_step("x"), 1).alias("last_qty"),
        F.round(F.aggregate("x", F.lit(0.0), lambda acc, s: acc + F.element_at(s, 2)), 2).alias("frame_price"),
    )


def q_event_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2s per key: the first floor(0.8 n) frames of each event type train, the rest test."""
    fr = split.chronological_split(_event_frames(spark, sf_dir), 0.8, key="event_type")
    return fr.groupBy("event_type", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("frame_idx").alias("first_idx"), F.max("frame_idx").alias("last_idx")
    )


def q_chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2s: first floor(0.98 n) frames train, the rest test."""
    fr = split.chronological_split(_order_frames(spark, sf_dir), 0.98)
    return fr.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("frame_idx").alias("first_idx"), F.max("frame_idx").alias("last_idx")
    )


def q_minibatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: training frames in consecutive batches of 512, the last one short."""
    fr = split.chronological_split(_order_frames(spark, sf_dir), 0.98).where(F.col("part") == "train")
    return sequence.minibatches(fr, 512).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("frame_idx").alias("first_idx")
    )


# --------------------------------------------------------------------------- splits, features


def q_key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3s: part split by key (key mod 4 = 0 is the test part); rows and price total per part."""
    df = split.with_key_split(load_table(spark, sf_dir, "part"), "p_partkey", buckets=4, test_buckets=(0,))
    return df.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("p_retailprice"), 2).alias("sum_price")
    )


def q_random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1s: seeded 0.75/0.25 split; every row lands in exactly one part."""
    df = load_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    train, test = split.random_split(df, [0.75, 0.25], 123)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def q_random_split_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1s checked: how often each row is found in the two parts together."""
    both = q_random_split(spark, sf_dir)
    return both.groupBy("p_partkey").agg(F.count(F.lit(1)).alias("times"))


def q_seeded_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1s on any partitioning: line items split 0.75/0.25 by their order's key and a seed; per
    part its rows, its orders and the sum of its quantities."""
    rows = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    train, test = split.seeded_split(rows, [0.75, 0.25], 123, "l_orderkey")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("orders"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


def q_frequency_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 + A4 on a column of many values: the orders of line items by their number of items, and
    the quantity that the joined-back index leads to."""
    rows = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    index = materialize(features.frequency_index(rows, "l_orderkey"), "order-index")
    found = features.apply_index(rows, index, "l_orderkey").groupBy("label").agg(
        F.first("l_orderkey").alias("l_orderkey"), F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )
    return found.select("l_orderkey", "label", "n", "quantity")


def q_prediction_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4s: grid over the observed range of part.p_size, step 0.5."""
    return report.grid_over(load_table(spark, sf_dir, "part"), "p_size", 0.5, "x")


def q_index_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 + A4: p_type indexed by frequency (ties alphabetical)."""
    part = load_table(spark, sf_dir, "part")
    idx = features.index_label(part, "p_type", "label")
    return idx.groupBy("p_type", "label").agg(F.count(F.lit(1)).alias("n"))


def q_assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_size, p_retailprice) assembled into an ML vector, shown as an array."""
    part = load_table(spark, sf_dir, "part")
    asm = features.assemble(part, ["p_size", "p_retailprice"], "vec")
    return asm.select("p_partkey", vector_to_array("vec").alias("features"))


# --------------------------------------------------------------------------- learners


def _part_split(spark: SparkSession, sf_dir: str):
    return split.key_split(load_table(spark, sf_dir, "part"), "p_partkey", buckets=4, test_buckets=(0,))


def q_linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + X4 + X5: price on part key, fitted on 3/4 of the keys, scored on the rest."""
    train, test = _part_split(spark, sf_dir)
    model = models.fit_regressor(train, "linear", ["p_partkey"], "p_retailprice")
    lr = models.last_stage(model)
    scored = models.score(model, test)
    return scored.agg(
        F.lit(_rounded(lr.coefficients[0], 8)).alias("slope"),
        F.lit(_rounded(lr.intercept, 3)).alias("intercept"),
        F.lit(int(lr.summary.numInstances)).cast("long").alias("n_train"),
        F.count(F.lit(1)).alias("n_test"),
        F.round(F.sqrt(F.avg((F.col("p_retailprice") - F.col("predict")) ** 2)), 4).alias("rmse_test"),
    )


def q_multiple_linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: price on (part key, size), fitted on 3/4 of the keys, scored on the rest."""
    train, test = _part_split(spark, sf_dir)
    model = models.fit_regressor(train, "linear", ["p_partkey", "p_size"], "p_retailprice")
    lr = models.last_stage(model)
    return models.score(model, test).agg(
        F.lit(_rounded(lr.coefficients[0], 8)).alias("b_partkey"),
        F.lit(_rounded(lr.coefficients[1], 6)).alias("b_size"),
        F.lit(_rounded(lr.intercept, 3)).alias("intercept"),
        F.count(F.lit(1)).alias("n_test"),
        F.round(F.sqrt(F.avg((F.col("p_retailprice") - F.col("predict")) ** 2)), 4).alias("rmse_test"),
    )


def q_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 (+ X2): multinomial NB of p_type on (p_size, p_retailprice): class priors and
    conditionals, and how many rows of the held-out quarter get each class."""
    train, test = _part_split(spark, sf_dir)
    model = models.fit_classifier(train, "naive_bayes", ["p_size", "p_retailprice"], "p_type")
    indexer, nb = model.stages[1], model.stages[-1]
    theta = nb.theta.toArray()
    pi = nb.pi.toArray()
    rows = [
        (float(i), name, _rounded(pi[i], 9), _rounded(theta[i][0], 9), _rounded(theta[i][1], 9))
        for i, name in enumerate(indexer.labels)
    ]
    classes = spark.createDataFrame(rows, "label double, p_type string, log_prior double, log_theta_size double, log_theta_price double")
    given = models.score(model, test).groupBy(F.col("prediction").alias("label")).agg(F.count(F.lit(1)).alias("n_test"))
    return classes.join(given, "label", "left").withColumn("n_test", F.coalesce("n_test", F.lit(0)))


def q_logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: quality on one 0/1 feature (long text). Saturated model, so P(quality=1) is the group rate."""
    df = documents_labelled(spark, sf_dir).select(
        (F.col("n_chars") > 1500).cast("double").alias("long_text"), F.col("quality").cast("double").alias("label")
    )
    model = models.fit_classifier(df, "logistic", ["long_text"], "label", index_label=False, maxIter=100, tol=1e-9)
    scored = models.score(model, df)
    return scored.groupBy("long_text").agg(
        F.round(F.avg(vector_to_array("probability")[1]), 4).alias("p_quality"), F.count(F.lit(1)).alias("n")
    )


def _part_tree_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "part").select(
        F.floor(F.pmod("p_partkey", F.lit(1000)) / 100).cast("double").alias("x"), "p_retailprice"
    )


def _tree_regressor_query(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _part_tree_input(spark, sf_dir)
        extra = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"} if kind == "random_forest" else {}
        model = models.fit_regressor(df, kind, ["x"], "p_retailprice", maxDepth=1, seed=7, **extra)
        scored = models.score(model, df)
        return scored.groupBy("x").agg(F.round(F.first("predict"), 4).alias("predict"), F.count(F.lit(1)).alias("n"))

    run.__doc__ = (
        "M8: depth-1 variance split of part price on a 10-valued feature."
        if kind == "decision_tree"
        else "M9: one-tree forest (no bootstrap, all features), which must equal the depth-1 tree's split."
    )
    return run


def _doc_bucket_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents_labelled(spark, sf_dir)
    bucket = F.least(F.lit(9), F.floor((F.col("non_letters") * 10) / F.col("n_chars")))
    return d.select(bucket.cast("double").alias("bucket"), F.col("quality").cast("double").alias("label"))


def _tree_classifier_query(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _doc_bucket_input(spark, sf_dir)
        extra = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"} if kind == "random_forest" else {}
        model = models.fit_classifier(
            df, kind, ["bucket"], "label", index_label=False, maxDepth=1, seed=7, **extra
        )
        scored = models.score(model, df)
        return scored.groupBy("bucket").agg(F.first("prediction").alias("prediction"), F.count(F.lit(1)).alias("n"))

    run.__doc__ = (
        "M2: depth-1 gini split of quality on the decile of the non-letter share."
        if kind == "decision_tree"
        else "M5: one-tree forest (no bootstrap, all features), which must equal the depth-1 tree's split."
    )
    return run


def q_kmeans_two_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: two well separated groups of customers; centres ordered by value, sizes from the scored rows."""
    cust = load_table(spark, sf_dir, "customer").select(
        (F.col("c_acctbal") + F.lit(100000.0) * F.pmod("c_custkey", F.lit(2))).alias("x")
    )
    model = models.fit_kmeans(cust, ["x"], k=2, seed=1)
    scored = models.score(model, cust)
    per = scored.groupBy("prediction").agg(F.avg("x").alias("centre"), F.count(F.lit(1)).alias("size"))
    return per.select(
        (F.row_number().over(Window.orderBy("centre")) - 1).cast("long").alias("cluster"),
        F.round("centre", 4).alias("centre"),
        "size",
    )


def q_kmeans_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 with the reference's k = 5: customers by balance and total order value."""
    df = _customer_totals(spark, sf_dir)
    model = models.fit_kmeans(df, ["c_acctbal", "order_total"], k=5, seed=1)
    return models.score(model, df).select("c_custkey", F.col("prediction").alias("cluster"))


def _customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = load_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("order_total")
    )
    cust = load_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return cust.join(totals, on="c_custkey", how="left").fillna(0.0, subset=["order_total"])


def q_kmeans_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 on array features: 64-dim embeddings enter Spark ML as vectors (k = 10)."""
    emb = load_table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("embedding_vec")
    )
    model = models.fit_kmeans(emb, ["embedding_vec"], k=10, seed=1)
    return models.score(model, emb).select("vec_id", F.col("prediction").alias("cluster"))


# --------------------------------------------------------------------------- evaluation


def _toxic_as_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "labels").select(
        F.col("quality").cast("double").alias("label"), F.col("toxic").cast("double").alias("prediction")
    )


def q_confusion_matrix(spark, sf_dir):
    """V1 + A3: cells over the true-label set, with the toxic flag as the prediction of quality."""
    return evaluate.confusion_matrix(_toxic_as_prediction(spark, sf_dir))


def q_accuracy(spark, sf_dir):
    """V2: share of rows where the toxic flag equals quality, over all rows."""
    return evaluate.accuracy(_toxic_as_prediction(spark, sf_dir)).select(F.round("accuracy", 9).alias("accuracy"), "n")


def q_precision_by_label(spark, sf_dir):
    """V3 + V4: precision per true label (0 when never predicted)."""
    return evaluate.precision_by_label(_toxic_as_prediction(spark, sf_dir)).select(
        "label", F.round("precision", 9).alias("precision")
    )


def q_metrics_report(spark, sf_dir):
    """Accuracy and per-label precision as one long table."""
    return evaluate.metrics_report(_toxic_as_prediction(spark, sf_dir)).select(
        "metric", "label", F.round("value", 9).alias("value")
    )


def q_overlay_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + S9 + P4s: training points, the tree's curve over a grid, and test predictions in one table."""
    base = load_table(spark, sf_dir, "part").select(
        "p_partkey", F.floor(F.pmod("p_partkey", F.lit(1000)) / 100).cast("double").alias("x"), "p_retailprice"
    )
    train, test = split.key_split(base, "p_partkey", buckets=4, test_buckets=(0,))
    model = models.fit_regressor(train, "decision_tree", ["x"], "p_retailprice", maxDepth=1, seed=7)
    grid = report.grid_over(train, "x", 0.5, "x")
    return report.overlay_series(
        {
            "Training Set": (train, "x", "p_retailprice"),
            "Decision Tree Regression": (models.score(model, grid), "x", F.round("predict", 4)),
            "Prediction": (models.score(model, test), "x", F.round("predict", 4)),
        }
    )


# --------------------------------------------------------------------------- sequence model


def _forecast_config(epochs: int = 2) -> SequenceConfig:
    return SequenceConfig(
        features=PRICES,
        labels=NEXT_PRICES,
        frame_size=50,
        batch_size=512,
        epochs=epochs,
        hidden=16,
        dense=16,
        learning_rate=0.01,
        seed=12345,
    )


def _fit_orders_model(spark: SparkSession, sf_dir: str, cfg: SequenceConfig, run_path: str | None = None):
    # The prepared series is a stored table, as between the reference's two programs:
    # the bounds and the blocks both read it instead of re-running the join.
    rows = materialize(order_next_days(spark, sf_dir), "order-next-days")
    blocks, stats = prepare_blocks(rows, cfg, order="Date", since="1996-01-01")
    return blocks, stats, fit_blocks(blocks, cfg, run_path=run_path)


def q_prepare_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1-L3 (+ W1, P2s, L2, C4, C5): the forecast's series preparation without the model —
    bounds from all rows, frames of 50 days from 1996 on, 98 % split, batches of 512; per frame
    its part, batch, first scaled Open and the last NextClose scaled and unscaled back."""
    cfg = _forecast_config()
    frames, stats = prepare_series(order_next_days(spark, sf_dir), cfg, order="Date", since="1996-01-01")
    out = frames.select(
        "frame_idx",
        "part",
        "batch_id",
        F.element_at(F.element_at("x", 1), 1).alias("x_first"),
        F.element_at(F.element_at("y", -1), 2).alias("actual"),
    )
    back = features.minmax_unscale(out, ["actual"], stats, stat_cols=["NextClose"])
    return back.select(
        "frame_idx", "part", "batch_id", F.round("x_first", 9).alias("x_first"), F.round("actual", 6).alias("actual")
    )


def q_forecast_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 + L1-L9 on the long orders series: next-day join, bounds from all rows, frames of 50
    days from 1996 on, 98 % chronological split, data-parallel training with parameter
    averaging, then unscaled actual vs predicted NextClose at every frame (train and test)."""
    blocks, stats, model = _fit_orders_model(spark, sf_dir, _forecast_config())
    return forecast_blocks(blocks, model, stats, label="NextClose")


def q_training_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss, frames and seconds per epoch and averaging round of the orders model."""
    cfg = _forecast_config(epochs=3)
    _, _, model = _fit_orders_model(spark, sf_dir, cfg)
    return model.history_df(spark)


def _event_config() -> SequenceConfig:
    return SequenceConfig(
        features=PRICES, labels=PRICES, frame_size=5, batch_size=8, epochs=2, hidden=8, dense=8, split_ratio=0.8
    )


def q_prepare_event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 per key: per-type bounds (size-checked join), frames of 5 days per type, 80 % split
    per type, batches of 8; per frame its part, batch, first scaled Open and last Close unscaled."""
    frames, stats = prepare_series(event_days(spark, sf_dir), _event_config(), order="Date", key="event_type")
    out = frames.select(
        "event_type",
        "frame_idx",
        "part",
        "batch_id",
        F.element_at(F.element_at("x", 1), 1).alias("x_first"),
        F.element_at(F.element_at("y", -1), 2).alias("actual"),
    )
    back = features.minmax_unscale(out, ["actual"], stats, stat_cols=["Close"], key="event_type")
    return back.select(
        "event_type",
        "frame_idx",
        "part",
        "batch_id",
        F.round("x_first", 9).alias("x_first"),
        F.round("actual", 6).alias("actual"),
    )


def q_forecast_events_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 + L8 (carry) on one daily series per event type: frames of 5 days, state carried
    down each type's frames while scoring, solved over blocks of 8 days at once. With many events
    a day a type's Low is the same every day; it scales to 0 then."""
    cfg = _event_config()
    days = materialize(event_days(spark, sf_dir), "event-days")
    blocks, stats = prepare_blocks(days, cfg, order="Date", key="event_type", constant=0.0, block_rows=8)
    model = fit_blocks(blocks, cfg, key="event_type")
    return forecast_blocks(blocks, model, stats, label="Close", key="event_type", mode="carry")


def _one_unit_config(**more) -> SequenceConfig:
    """One hidden and one dense unit in double precision: small enough to be stated in SQL."""
    base = dict(features=["Close"], labels=["NextClose"], hidden=1, dense=1, dtype="float64", seed=8)
    return SequenceConfig(**{**base, **more})


TRAINING_STEPS = _one_unit_config(
    frame_size=2, batch_size=300, epochs=2, workers=2, averaging_frequency=1, l2=1e-3, learning_rate=0.02
)
CARRY_PASS = _one_unit_config(frame_size=5)


def q_training_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 + L5 + L6 exactly: parameters and optimiser state of a network of one hidden unit after
    two epochs over the orders series in frames of two days, two slots averaged each round."""
    cfg = TRAINING_STEPS
    rows = materialize(order_next_days(spark, sf_dir), "order-next-days")
    blocks, _ = prepare_blocks(rows, cfg, order="Date", block_rows=256)
    store = ModelStore(spark, fit_blocks(blocks, cfg).run)
    weights = store.read(store.newest(), "weights").select("offset", F.posexplode(F.arrays_zip("params", "rms")).alias("i", "v"))
    return weights.select(
        (F.col("offset") + F.col("i") + 1).cast("int").alias("position"),
        F.round("v.params", 9).alias("value"),
        F.round("v.rms", 9).alias("rms"),
    )


def q_carry_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 exactly: one stateful pass of a network of one hidden unit down the orders series,
    solved over blocks of 128 days at once; the scaled prediction of every frame."""
    cfg = CARRY_PASS
    rows = materialize(order_next_days(spark, sf_dir), "order-next-days")
    blocks, _ = prepare_blocks(rows, cfg, order="Date", block_rows=128)
    model = SequenceModel(cfg, rn.init_params(cfg.shape, cfg.seed), rn.init_params(cfg.shape, cfg.seed) * 0)
    scored = score_blocks(blocks, model, mode="carry", tol=1e-13)
    return scored.select("frame_idx", F.round(F.element_at("pred", 1), 9).alias("pred"))


def q_lineitem_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 on line items, one long series per return flag: blocks scored per series, and how many
    of them begin with a state other than the one that the block before them ends with."""
    cfg = SequenceConfig(features=["l_quantity", "l_extendedprice"], labels=["l_quantity"], frame_size=5, hidden=4, dense=4, seed=3)
    blocks, _ = prepare_blocks(_lineitem_series(spark, sf_dir), cfg, order=LINEITEM_ORDER, key="l_returnflag")
    blocks = materialize(blocks, "lineitem-blocks")
    model = SequenceModel(cfg, rn.init_params(cfg.shape, cfg.seed), rn.init_params(cfg.shape, cfg.seed) * 0)
    states, passes = carry_states(blocks, model, key="l_returnflag")
    frames = score_blocks(blocks, model, key="l_returnflag", mode="carry", states=states).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_frames"), F.count_distinct("frame_idx").alias("n_distinct"), F.max("frame_idx").alias("last_frame")
    )
    return frames.withColumn("unsettled", F.lit(passes[-1][1]).cast("long"))


LINEITEM_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"]


def _lineitem_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "lineitem").select("l_returnflag", *LINEITEM_ORDER, "l_quantity", "l_extendedprice")


def q_model_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + L10: training ended after one epoch and a torn save behind it, then loaded and gone on
    with, against one run; per epoch and round the frames and whether the losses are equal, with
    whether all parameters and the optimiser state are."""
    cfg = _forecast_config(epochs=3)
    blocks, _, whole = _fit_orders_model(spark, sf_dir, cfg)
    path = scratch_path(spark, "ended-run")
    fit_blocks(blocks, _forecast_config(epochs=1), run_path=path)
    store = ModelStore(spark, path)
    store.stage({"weights": store.read(store.newest(), "weights").limit(0)})  # never committed
    resumed = fit_blocks(blocks, cfg, run_path=path)
    same = bool((resumed.params == whole.params).all() and (resumed.rms == whole.rms).all())
    one = whole.history_df(spark).select("epoch", "round", "n_frames", "loss")
    two = resumed.history_df(spark).select("epoch", "round", F.col("loss").alias("loss2"))
    return one.join(two, ["epoch", "round"]).select(
        "epoch", "round", "n_frames", (F.col("loss") == F.col("loss2")).alias("same_loss"), F.lit(same).alias("same_state")
    )


def _null_key_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the events where one type's name is missing: its key is NULL."""
    events = load_table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("click")).alias("event_type"), "ts", "value", "event_id"
    )
    return shaping.daily_bars(events, "ts", "value", key="event_type", tie_col="event_id", volume="sum", volume_digits=2)


def q_null_key_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W2 + P2s with a NULL series key: its rows form a series like any other."""
    frames = sequence.sliding_frames(_null_key_days(spark, sf_dir), "Date", PRICES, 5, key="event_type", bucket_rows=64)
    parted = split.chronological_split(frames.drop("n_frames"), 0.8, key="event_type")
    return parted.select("event_type", "frame_idx", "n_frames", "part", F.element_at(tf.last_step("x"), 2).alias("last_close"))


def q_null_key_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 per key with a NULL key: scaled with its own bounds."""
    scaled = features.minmax_scale(_null_key_days(spark, sf_dir), PRICES, key="event_type")
    return scaled.select("event_type", "Date", *[F.round(c, 9).alias(c) for c in PRICES])


def q_null_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 with NULL predictions (labels of quality 0) and NULL labels (toxic documents)."""
    rows = load_table(spark, sf_dir, "labels").select(
        F.when(F.col("toxic") == 0, F.col("quality").cast("double")).alias("label"),
        F.when(F.col("quality") == 1, F.col("toxic").cast("double")).alias("prediction"),
    )
    return evaluate.metrics_report(rows).select("metric", "label", F.round("value", 9).alias("value"))


def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted model saved to the shared folder, loaded and used; per row its prediction
    and whether it equals the unsaved model's."""
    train, test = _part_split(spark, sf_dir)
    model = models.fit_regressor(train, "linear", ["p_partkey"], "p_retailprice")
    path = save_model(model, scratch_path(spark, "price-model"))
    direct = models.score(model, test).select("p_partkey", F.col("predict").alias("direct"))
    loaded = models.score(load_model(path), test).select("p_partkey", "predict")
    return loaded.join(direct, "p_partkey").select(
        "p_partkey", F.round("predict", 4).alias("predict"), (F.col("predict") == F.col("direct")).alias("same")
    )


def q_preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 nations in key order, as a preview shows them (the limit is the feature)."""
    return preview(load_table(spark, sf_dir, "nation").orderBy("n_nationkey"), 20).select("n_nationkey", "n_name")


def _nearest_check(scored: DataFrame, centres: list, point, k: int) -> DataFrame:
    """One row: rows scored, rows that are not given the nearest centre, clusters used."""
    def distance(c):
        sides = F.zip_with(point, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b))
        return F.aggregate(sides, F.lit(0.0), lambda s, v: s + v)

    away = F.array(*[distance(c) for c in centres])
    wrong = F.element_at(away, F.col("prediction") + 1) > F.array_min(away) * (1 + 1e-9) + 1e-9
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(wrong.cast("long")), F.lit(0)).alias("not_nearest"),
        (F.count_distinct("prediction") <= k).alias("within_k"),
    )


def q_kmeans_segments_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, k = 5: every customer has the nearest of the model's centres."""
    df = _customer_totals(spark, sf_dir)
    model = models.fit_kmeans(df, ["c_acctbal", "order_total"], k=5, seed=1)
    point = F.array(F.col("c_acctbal").cast("double"), F.col("order_total").cast("double"))
    return _nearest_check(models.score(model, df), models.last_stage(model).clusterCenters(), point, 5)


def q_kmeans_embeddings_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, k = 10: every embedding has the nearest of the model's centres."""
    emb = load_table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("embedding_vec")
    )
    model = models.fit_kmeans(emb, ["embedding_vec"], k=10, seed=1)
    return _nearest_check(models.score(model, emb), models.last_stage(model).clusterCenters(), vector_to_array("embedding_vec"), 10)


def q_forest_is_mean_of_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: a bootstrapped forest of 5 trees over the whole table; per row whether the forest's
    prediction is the mean of its trees' predictions."""
    part = load_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    model = models.fit_regressor(part, "random_forest", ["p_partkey", "p_size"], "p_retailprice", numTrees=5, seed=3)
    scored = models.score(model, part)
    for k, tree in enumerate(models.last_stage(model).trees):
        scored = tree.setPredictionCol(f"tree_{k}").transform(scored)
    mean = sum((F.col(f"tree_{k}") for k in range(1, 5)), F.col("tree_0")) / 5
    return scored.select("p_partkey", (F.abs(mean - F.col("predict")) < 1e-6).alias("is_mean"))


def _boxes_query(task: str, kind: str, **params):
    """A model over a whole table as leaf boxes; per row whether the boxes say what the model says
    and how many trees hold it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if task == "regress":
            rows, names = load_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), ["p_partkey", "p_size"]
            model = models.fit_regressor(rows, kind, names, "p_retailprice", seed=5, **params)
            key, said, classes = "p_partkey", "predict", 0
        else:
            rows, names = documents_labelled(spark, sf_dir).withColumn("y", F.col("quality").cast("double")), ["n_chars", "non_letter_share"]
            model = models.fit_classifier(rows, kind, names, "y", index_label=False, handle_invalid="keep", seed=5, **params)
            key, said, classes = "doc_id", "prediction", 2
        boxes = leaf_boxes(spark, model)
        scored = score_boxes(models.score(model, rows), boxes, names, classes)
        return scored.select(
            key, (F.abs(F.col("box_prediction") - F.col(said)) < 1e-6).alias("same"), F.col("box_trees").alias("trees")
        )

    run.__doc__ = f"M2/M5/M8/M9 as a table ({task}, {kind}): every row's box prediction against the model's."
    return run


def q_forecast_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8, L9 checked: part, time and unscaled actual close of every frame, and whether the
    forecast is a finite number."""
    out = q_forecast_table(spark, sf_dir)
    return out.select(
        "frame_idx", "time", "part", F.round("actual", 6).alias("actual"),
        (F.col("predicted").isNotNull() & ~F.isnan("predicted") & (F.abs("predicted") < 1e12)).alias("finite"),
    )


def q_lineitem_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10, L6, L7, L10 on the line items themselves, one series per return flag: frames per
    epoch and averaging round, and whether the loss is finite."""
    cfg = SequenceConfig(
        features=["l_quantity", "l_extendedprice"], labels=["l_quantity"], frame_size=5, batch_size=512, epochs=2, hidden=4, dense=4,
        split_ratio=0.8, averaging_frequency=8,
    )
    blocks, _ = prepare_blocks(_lineitem_series(spark, sf_dir), cfg, order=LINEITEM_ORDER, key="l_returnflag", constant=0.0)
    model = fit_blocks(blocks, cfg, key="l_returnflag")
    return model.history_df(spark).select(
        "epoch", "round", "n_frames", (~F.isnan("loss") & (F.col("loss") < 1e9)).alias("finite")
    )


def q_training_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6, L7, L10 checked: frames per epoch and averaging round of the orders model, and whether
    the loss is below that of the same round one epoch before."""
    history = q_training_history(spark, sf_dir)
    before = F.lag("loss").over(Window.partitionBy("round").orderBy("epoch"))
    return history.select(
        "epoch", "round", "n_frames", (~F.isnan("loss") & (F.col("loss") < 1e9)).alias("finite"),
        (F.col("loss") < F.coalesce(before, F.lit(float("inf")))).alias("falls"),
    )


def _order_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series that its past tells something about: the days' closes above or below the mean close,
    added up. One row per calendar day, however many orders there are."""
    days = materialize(order_days(spark, sf_dir).select("Date", "Close"), "order-days")
    mean = days.agg(F.avg("Close")).first()[0]
    level = F.sum(F.col("Close") - F.lit(mean)).over(Window.orderBy("Date"))
    return shaping.next_day_join(days.select("Date", level.alias("Level")), "Date", ["Level"])


LEVELS = SequenceConfig(
    features=["Level"], labels=["NextLevel"], frame_size=8, batch_size=16, epochs=6, hidden=8, dense=8, split_ratio=0.9,
    averaging_frequency=16, workers=2, learning_rate=0.005,
)


def q_forecast_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 + L1-L9 on the added-up closes: frames per part, and whether the model's forecasts are
    nearer to the actual values than the training mean is."""
    rows = materialize(_order_levels(spark, sf_dir), "order-levels")
    blocks, stats = prepare_blocks(rows, LEVELS, order="Date")
    table = materialize(forecast_blocks(blocks, fit_blocks(blocks, LEVELS), stats, label="NextLevel"), "level-forecast")
    mean = table.where("part = 'train'").agg(F.avg("actual")).first()[0]
    return table.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_frames"),
        (F.avg((F.col("predicted") - F.col("actual")) ** 2) < F.avg((F.col("actual") - F.lit(mean)) ** 2)).alias("beats_mean"),
    )


def q_forecast_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 on the forecast: actual and predicted close of training and test frames over time."""
    return forecast_overlay(q_forecast_table(spark, sf_dir))


# --------------------------------------------------------------------------- registry


def _regressor_report(kind: str, **params):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        part = split.with_key_split(load_table(spark, sf_dir, "part"), "p_partkey", buckets=4, test_buckets=(0,))
        model = models.fit_regressor(
            part.where("part = 'train'"), kind, ["p_partkey", "p_size"], "p_retailprice", seed=11, **params
        )
        series = report.scored_series(
            models.score(model, part),
            "p_partkey",
            {"train": {"Training Set": "p_retailprice", "Regression": "predict"}, "test": {"Test Set": "p_retailprice", "Predictions": "predict"}},
        )
        return series.withColumn("y", F.round("y", 4))

    run.__doc__ = (
        f"Reference regression program with {kind}: fit on the key split, then training points, the model "
        "there, test points and predictions, from one scoring of the table."
    )
    return run


def _classifier_report(kind: str, **params):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = documents_labelled(spark, sf_dir).withColumn("quality_label", F.col("quality").cast("string"))
        train, test = split.key_split(d, "doc_id", buckets=4, test_buckets=(0,))
        model = models.fit_classifier(
            train, kind, ["n_chars", "non_letter_share"], "quality_label", handle_invalid="keep", seed=11, **params
        )
        report_df = evaluate.metrics_report(models.score(model, test))
        return report_df.select("metric", "label", F.round("value", 9).alias("value"))

    run.__doc__ = f"Reference classification program with {kind}: fit, score the held-out keys, metrics table."
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_roundtrip": q_csv_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "daily_ohlcv": q_daily_ohlcv,
    "next_day_join": q_next_day_join,
    "next_day_join_sql": q_next_day_join_sql,
    "event_next_days": q_event_next_days,
    "event_minmax_scale": q_event_minmax_scale,
    "stock_etl": q_stock_etl,
    "since_filter": q_since_filter,
    "minmax_stats": q_minmax_stats,
    "minmax_scale": q_minmax_scale,
    "minmax_unscale": q_minmax_unscale,
    "sliding_frames": q_sliding_frames,
    "order_frames": q_order_frames,
    "lineitem_frames": q_lineitem_frames,
    "chronological_split": q_chronological_split,
    "event_split": q_event_split,
    "minibatches": q_minibatches,
    "key_split": q_key_split,
    "random_split": q_random_split,
    "prediction_grid": q_prediction_grid,
    "index_label": q_index_label,
    "assemble_features": q_assemble_features,
    "linear_regression": q_linear_regression,
    "multiple_linear_regression": q_multiple_linear_regression,
    "naive_bayes": q_naive_bayes,
    "logistic_regression": q_logistic_regression,
    "decision_tree_regressor": _tree_regressor_query("decision_tree"),
    "random_forest_regressor": _tree_regressor_query("random_forest"),
    "decision_tree_classifier": _tree_classifier_query("decision_tree"),
    "random_forest_classifier": _tree_classifier_query("random_forest"),
    "kmeans_two_groups": q_kmeans_two_groups,
    "kmeans_segments": q_kmeans_segments,
    "kmeans_embeddings": q_kmeans_embeddings,
    "confusion_matrix": q_confusion_matrix,
    "accuracy": q_accuracy,
    "precision_by_label": q_precision_by_label,
    "metrics_report": q_metrics_report,
    "overlay_series": q_overlay_series,
    "classify_decision_tree": _classifier_report("decision_tree"),
    "classify_logistic": _classifier_report("logistic", maxIter=10),
    "classify_naive_bayes": _classifier_report("naive_bayes"),
    "classify_random_forest": _classifier_report("random_forest", numTrees=20),
    "regress_linear": _regressor_report("linear"),
    "regress_decision_tree": _regressor_report("decision_tree"),
    "regress_random_forest": _regressor_report("random_forest", numTrees=20),
    "prepare_series": q_prepare_series,
    "prepare_event_series": q_prepare_event_series,
    "forecast_table": q_forecast_table,
    "training_history": q_training_history,
    "training_steps": q_training_steps,
    "carry_pass": q_carry_pass,
    "lineitem_carry": q_lineitem_carry,
    "model_resume": q_model_resume,
    "forecast_events_carry": q_forecast_events_carry,
    "null_key_frames": q_null_key_frames,
    "null_key_minmax": q_null_key_minmax,
    "null_metrics": q_null_metrics,
    "random_split_cover": q_random_split_cover,
    "model_roundtrip": q_model_roundtrip,
    "preview_rows": q_preview_rows,
    "kmeans_segments_check": q_kmeans_segments_check,
    "kmeans_embeddings_check": q_kmeans_embeddings_check,
    "forest_is_mean_of_trees": q_forest_is_mean_of_trees,
    "seeded_split": q_seeded_split,
    "frequency_index": q_frequency_index,
    "boxes_forest_regressor": _boxes_query("regress", "random_forest", numTrees=20, maxDepth=6),
    "boxes_forest_classifier": _boxes_query("classify", "random_forest", numTrees=20),
    "boxes_tree_regressor": _boxes_query("regress", "decision_tree"),
    "boxes_tree_classifier": _boxes_query("classify", "decision_tree"),
    "forecast_check": q_forecast_check,
    "forecast_overlay": q_forecast_overlay,
    "forecast_levels": q_forecast_levels,
    "training_check": q_training_check,
    "lineitem_training": q_lineitem_training,
}
