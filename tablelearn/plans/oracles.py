"""Independent DuckDB SQL for the registered queries (closed forms of each result).

Learners are checked on cases whose optimum SQL can state directly:
least squares by ``regr_*`` / covariances, naive Bayes by counts and sums,
a saturated logistic model by group rates, depth-1 trees by an exhaustive
best-split search, two far-apart groups for k-means.
"""

from __future__ import annotations

from tablelearn.plans import recurrent as rn
from tablelearn.plans.network_sql import carry_sql, training_sql
from tablelearn.plans.queries import _DOCS_SQL, _EVENT_DAYS_SQL, _NEXT_DAYS_SQL, CARRY_PASS, TRAINING_STEPS

# The daily bars with one type's name missing.
_NULL_DAYS_SQL = _EVENT_DAYS_SQL.replace("FROM events", "FROM (SELECT * REPLACE (nullif(event_type, 'click') AS event_type) FROM events)")

_P = ["Open", "Close", "Low", "High", "NextOpen", "NextClose", "NextLow", "NextHigh"]


def _minmax_sql() -> str:
    mins = ", ".join(f"min({c}) AS min_{c}" for c in _P)
    maxs = ", ".join(f"max({c}) AS max_{c}" for c in _P)
    return f"SELECT {mins}, {maxs} FROM ({_NEXT_DAYS_SQL})"


def _scaled_sql(unscale: bool) -> str:
    def expr(c: str) -> str:
        s = f"(n.{c} - s.min_{c}) / (s.max_{c} - s.min_{c})"
        if unscale:
            return f"round({s} * (s.max_{c} - s.min_{c}) + s.min_{c}, 6) AS {c}"
        return f"round({s}, 9) AS {c}"

    return (
        f"WITH n AS ({_NEXT_DAYS_SQL}), s AS ({_minmax_sql()}) "
        f"SELECT n.Date, {', '.join(expr(c) for c in _P)} FROM n, s WHERE n.Date >= DATE '1998-01-01'"
    )


def _frames_sql(days_sql: str, size: int, key: str | None, cols: list[str]) -> str:
    """Valid frame starts: index i with i + T - 1 < n and i < max(1, n - T)."""
    part = f"PARTITION BY {key} " if key else ""
    keep = f"{key}, " if key else ""
    leads = ", ".join(f"lead({c}, {size - 1}) OVER w AS last_{c}" for c in cols)
    return f"""
WITH d AS ({days_sql}),
r AS (
  SELECT {keep}Date, {', '.join(cols)}, row_number() OVER w - 1 AS idx, count(*) OVER ({part}) AS n,
         lead(Date, {size - 1}) OVER w AS end_day, {leads}
  FROM d WINDOW w AS ({part}ORDER BY Date)
),
f AS (
  SELECT *, CASE WHEN n < {size} THEN 0 ELSE greatest(1, n - {size}) END AS n_frames FROM r
)
SELECT * FROM f WHERE idx < n_frames AND idx + {size - 1} < n"""


_EVENT_FRAMES = _frames_sql(_EVENT_DAYS_SQL, 5, "event_type", ["Close"])
_ORDER_FRAMES = _frames_sql(_NEXT_DAYS_SQL, 50, None, ["Close", "NextClose"])
_ORDER_SPLIT = f"""
SELECT *, CASE WHEN idx < floor(n_frames * CAST(0.98 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part
FROM ({_ORDER_FRAMES})"""

_PART_TREE = "SELECT CAST(floor((p_partkey % 1000) / 100) AS DOUBLE) AS x, p_retailprice AS y, p_partkey FROM part"


def _best_variance_split(data_cte: str) -> str:
    """CTE chain ending in ``best(thr)``: the midpoint split of x with the least summed squared error."""
    return f"""
d AS ({data_cte}),
t AS (SELECT DISTINCT x FROM d),
th AS (SELECT (x + nx) / 2 AS thr FROM (SELECT x, lead(x) OVER (ORDER BY x) AS nx FROM t) WHERE nx IS NOT NULL),
sc AS (
  SELECT thr,
    sum(CASE WHEN x <= thr THEN y * y END) - power(sum(CASE WHEN x <= thr THEN y END), 2) / count(CASE WHEN x <= thr THEN 1 END)
  + sum(CASE WHEN x > thr THEN y * y END) - power(sum(CASE WHEN x > thr THEN y END), 2) / count(CASE WHEN x > thr THEN 1 END) AS sse
  FROM th, d GROUP BY thr
),
best AS (SELECT thr FROM sc ORDER BY sse, thr LIMIT 1),
side AS (SELECT d.x <= best.thr AS lft, avg(d.y) AS m FROM d, best GROUP BY 1)"""


_TREE_REGRESSOR = f"""
WITH {_best_variance_split(_PART_TREE)}
SELECT d.x, round(any_value(side.m), 4) AS predict, count(*) AS n
FROM d, best, side WHERE side.lft = (d.x <= best.thr) GROUP BY d.x"""

_DOC_BUCKETS = f"""
SELECT CAST(least(9, floor((non_letters * 10) / n_chars)) AS DOUBLE) AS x, CAST(quality AS DOUBLE) AS y
FROM ({_DOCS_SQL})"""

_TREE_CLASSIFIER = f"""
WITH d AS ({_DOC_BUCKETS}),
t AS (SELECT DISTINCT x FROM d),
th AS (SELECT (x + nx) / 2 AS thr FROM (SELECT x, lead(x) OVER (ORDER BY x) AS nx FROM t) WHERE nx IS NOT NULL),
cnt AS (
  SELECT thr,
    count(CASE WHEN x <= thr THEN 1 END) AS nl, count(CASE WHEN x <= thr AND y = 1 THEN 1 END) AS pl,
    count(CASE WHEN x > thr THEN 1 END) AS nr, count(CASE WHEN x > thr AND y = 1 THEN 1 END) AS pr
  FROM th, d GROUP BY thr
),
sc AS (
  SELECT thr,
    nl * (1 - power(pl / nl, 2) - power((nl - pl) / nl, 2)) + nr * (1 - power(pr / nr, 2) - power((nr - pr) / nr, 2)) AS g
  FROM cnt
),
best AS (SELECT thr FROM sc ORDER BY g, thr LIMIT 1),
side AS (
  SELECT d.x <= best.thr AS lft,
         CASE WHEN count(CASE WHEN y = 1 THEN 1 END) > count(CASE WHEN y = 0 THEN 1 END) THEN 1.0 ELSE 0.0 END AS pred
  FROM d, best GROUP BY 1
)
SELECT d.x AS bucket, CAST(any_value(side.pred) AS DOUBLE) AS prediction, count(*) AS n
FROM d, best, side WHERE side.lft = (d.x <= best.thr) GROUP BY d.x"""

_LABEL_PAIRS = "SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction FROM labels"
_ACCURACY = f"SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS accuracy, count(*) AS n FROM ({_LABEL_PAIRS})"
_PRECISION = f"""
WITH t AS ({_LABEL_PAIRS}),
tp AS (SELECT label, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS tp FROM t GROUP BY 1),
pc AS (SELECT prediction AS label, count(*) AS n_pred FROM t GROUP BY 1)
SELECT tp.label, round(CASE WHEN coalesce(pc.n_pred, 0) = 0 THEN 0.0 ELSE tp.tp / pc.n_pred END, 9) AS precision
FROM tp LEFT JOIN pc ON tp.label = pc.label"""

_NB_SCORED = f"""
WITH d AS (
  SELECT doc_id, n_chars, CAST(non_letters AS DOUBLE) / CAST(n_chars AS DOUBLE) AS share,
         CAST(quality AS VARCHAR) AS ql, quality
  FROM ({_DOCS_SQL})
),
tr AS (SELECT * FROM d WHERE doc_id % 4 <> 0),
te AS (SELECT * FROM d WHERE doc_id % 4 = 0),
lab AS (SELECT ql, CAST(row_number() OVER (ORDER BY count(*) DESC, ql) - 1 AS DOUBLE) AS label FROM tr GROUP BY ql),
st AS (
  SELECT lab.label, count(*) AS n_c, sum(CAST(tr.n_chars AS DOUBLE)) AS s1, sum(tr.share) AS s2
  FROM tr JOIN lab ON tr.ql = lab.ql GROUP BY lab.label
),
tot AS (SELECT sum(n_c) AS nn, count(*) AS k FROM st),
m AS (
  SELECT label, ln(n_c + 1) - ln(nn + k) AS pi, ln(s1 + 1) - ln(s1 + s2 + 2) AS t1, ln(s2 + 1) - ln(s1 + s2 + 2) AS t2
  FROM st, tot
)
SELECT te.doc_id, coalesce(lab.label, CAST((SELECT count(*) FROM lab) AS DOUBLE)) AS label,
       arg_max(m.label, m.pi + te.n_chars * m.t1 + te.share * m.t2) AS prediction
FROM te LEFT JOIN lab ON te.ql = lab.ql, m
GROUP BY te.doc_id, lab.label"""

_NB_REPORT = f"""
WITH sc AS ({_NB_SCORED}),
tp AS (SELECT label, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS tp FROM sc GROUP BY 1),
pc AS (SELECT prediction AS label, count(*) AS n_pred FROM sc GROUP BY 1)
SELECT 'accuracy' AS metric, CAST(NULL AS DOUBLE) AS label,
       round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS value FROM sc
UNION ALL
SELECT 'precision', tp.label, round(CASE WHEN coalesce(pc.n_pred, 0) = 0 THEN 0.0 ELSE tp.tp / pc.n_pred END, 9)
FROM tp LEFT JOIN pc ON tp.label = pc.label"""

_OVERLAY = f"""
WITH {_best_variance_split("SELECT x, y FROM (" + _PART_TREE + ") WHERE p_partkey % 4 <> 0")},
grid AS (
  SELECT lo + CAST(i AS DOUBLE) * 0.5 AS x
  FROM (SELECT min(x) AS lo, max(x) AS hi FROM d) b,
       LATERAL (SELECT unnest(range(0, CAST(floor((b.hi - b.lo) / 0.5) AS BIGINT) + 1)) AS i)
),
test AS (SELECT x FROM ({_PART_TREE}) WHERE p_partkey % 4 = 0)
SELECT 'Training Set' AS series, x, y FROM d
UNION ALL
SELECT 'Decision Tree Regression', g.x, round(side.m, 4) FROM grid g, best, side WHERE side.lft = (g.x <= best.thr)
UNION ALL
SELECT 'Prediction', s.x, round(side.m, 4) FROM test s, best, side WHERE side.lft = (s.x <= best.thr)"""


_EVENT_NEXT_DAYS = f"""
WITH bars AS ({_EVENT_DAYS_SQL}),
ahead AS (
  SELECT bars.*, lead(Date) OVER t AS following, lead(Open) OVER t AS NextOpen, lead(Close) OVER t AS NextClose,
         lead(Low) OVER t AS NextLow, lead(High) OVER t AS NextHigh, lead(Volume) OVER t AS NextVolume
  FROM bars WINDOW t AS (PARTITION BY event_type ORDER BY Date))
SELECT * EXCLUDE (following) FROM ahead WHERE date_diff('day', Date, following) = 1"""

_EVENT_MINMAX = f"""
WITH d AS ({_EVENT_DAYS_SQL}),
s AS (SELECT event_type, min(Open) AS lo_o, max(Open) AS hi_o, min(Close) AS lo_c, max(Close) AS hi_c,
             min(Low) AS lo_l, max(Low) AS hi_l, min(High) AS lo_h, max(High) AS hi_h FROM d GROUP BY 1)
SELECT d.event_type, d.Date,
       round((d.Open - s.lo_o) / (s.hi_o - s.lo_o), 9) AS Open,
       round((d.Close - s.lo_c) / (s.hi_c - s.lo_c), 9) AS Close,
       round((d.Low - s.lo_l) / (s.hi_l - s.lo_l), 9) AS Low,
       round((d.High - s.lo_h) / (s.hi_h - s.lo_h), 9) AS High
FROM d JOIN s ON d.event_type = s.event_type"""

_EVENT_SPLIT = f"""
SELECT event_type, CASE WHEN idx < floor(n_frames * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part,
       count(*) AS n, min(idx) AS first_idx, max(idx) AS last_idx
FROM ({_EVENT_FRAMES}) GROUP BY 1, 2"""

_PREPARED = f"""
WITH n AS ({_NEXT_DAYS_SQL}),
s AS (SELECT min(Open) AS lo_o, max(Open) AS hi_o, min(NextClose) AS lo_nc, max(NextClose) AS hi_nc FROM n),
k AS (SELECT * FROM n WHERE Date >= DATE '1996-01-01'),
r AS (
  SELECT Date, Open, row_number() OVER (ORDER BY Date) - 1 AS idx, count(*) OVER () AS cnt,
         lead(NextClose, 49) OVER (ORDER BY Date) AS last_nc
  FROM k
),
f AS (SELECT *, CASE WHEN cnt < 50 THEN 0 ELSE greatest(1, cnt - 50) END AS n_frames FROM r)
SELECT idx AS frame_idx,
       CASE WHEN idx < floor(n_frames * CAST(0.98 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part,
       idx // 512 AS batch_id,
       round((f.Open - s.lo_o) / (s.hi_o - s.lo_o), 9) AS x_first,
       round(((f.last_nc - s.lo_nc) / (s.hi_nc - s.lo_nc)) * (s.hi_nc - s.lo_nc) + s.lo_nc, 6) AS actual
FROM f, s WHERE idx < n_frames AND idx + 49 < cnt"""

_PREPARED_EVENTS = f"""
WITH d AS ({_EVENT_DAYS_SQL}),
s AS (SELECT event_type, min(Open) AS lo_o, max(Open) AS hi_o, min(Close) AS lo_c, max(Close) AS hi_c
      FROM d GROUP BY event_type),
r AS (
  SELECT event_type, Date, Open, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY event_type) AS cnt,
         lead(Close, 4) OVER w AS last_c
  FROM d WINDOW w AS (PARTITION BY event_type ORDER BY Date)
),
f AS (SELECT *, CASE WHEN cnt < 5 THEN 0 ELSE greatest(1, cnt - 5) END AS n_frames FROM r)
SELECT f.event_type, idx AS frame_idx,
       CASE WHEN idx < floor(n_frames * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part,
       idx // 8 AS batch_id,
       round((f.Open - s.lo_o) / (s.hi_o - s.lo_o), 9) AS x_first,
       round(((f.last_c - s.lo_c) / (s.hi_c - s.lo_c)) * (s.hi_c - s.lo_c) + s.lo_c, 6) AS actual
FROM f JOIN s ON f.event_type = s.event_type WHERE idx < n_frames AND idx + 4 < cnt"""

_NULL_LABEL_PAIRS = """
SELECT CASE WHEN toxic = 0 THEN CAST(quality AS DOUBLE) END AS label,
       CASE WHEN quality = 1 THEN CAST(toxic AS DOUBLE) END AS prediction FROM labels"""

# Least squares of price on (part key, size) over the training keys: intercept and two slopes.
_TWO_SLOPES = """
tr AS (SELECT CAST(p_partkey AS DOUBLE) AS x1, CAST(p_size AS DOUBLE) AS x2, p_retailprice AS y
       FROM part WHERE p_partkey % 4 <> 0),
s AS (SELECT covar_pop(x1, x1) AS s11, covar_pop(x2, x2) AS s22, covar_pop(x1, x2) AS s12,
             covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM tr),
b AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM s),
c AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b)"""

# Batches go round 4 slots and 4 turns make an averaging round.
_TRAINING_ROUNDS = f"""
SELECT CAST(e AS INTEGER) AS epoch, CAST(idx // 512 // 16 AS INTEGER) AS round, count(*) AS n_frames, true AS finite
FROM ({_PREPARED.replace("SELECT idx AS frame_idx,", "SELECT idx, idx AS frame_idx,")}), range(3) t(e)
WHERE part = 'train' GROUP BY 1, 2"""

_LINEITEM_FRAMES = """
SELECT l_returnflag, count(*) AS n, CASE WHEN count(*) < 5 THEN 0 ELSE greatest(1, count(*) - 5) END AS n_frames
FROM lineitem GROUP BY 1"""

_LINEITEM_ROUNDS = f"""
WITH tr AS (
  SELECT l_returnflag, unnest(range(0, CAST(floor(n_frames * CAST(0.8 AS DOUBLE)) AS BIGINT))) // 512 AS batch FROM ({_LINEITEM_FRAMES})),
k AS (SELECT l_returnflag, max(batch) + 1 AS batches FROM tr GROUP BY 1),
o AS (SELECT l_returnflag, coalesce(sum(batches) OVER (ORDER BY l_returnflag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k)
SELECT CAST(e AS INTEGER) AS epoch, CAST((tr.batch + o.before) // 32 AS INTEGER) AS round, count(*) AS n_frames, true AS finite
FROM tr JOIN o ON tr.l_returnflag = o.l_returnflag, range(2) t(e) GROUP BY 1, 2"""

# The scaled closes of the orders series, with the row's place and the number of rows.
_SCALED_CLOSES = f"""
SELECT row_number() OVER (ORDER BY Date) - 1 AS idx, count(*) OVER () AS n,
       (Close - min(Close) OVER ()) / (max(Close) OVER () - min(Close) OVER ()) AS x,
       (NextClose - min(NextClose) OVER ()) / (max(NextClose) OVER () - min(NextClose) OVER ()) AS y
FROM ({_NEXT_DAYS_SQL})"""

_TWO_DAY_FRAMES = f"""
SELECT * FROM (
  SELECT idx, n, x AS x1, y AS y1, lead(x) OVER (ORDER BY idx) AS x2, lead(y) OVER (ORDER BY idx) AS y2 FROM ({_SCALED_CLOSES}))
WHERE idx < floor(greatest(1, n - 2) * CAST({TRAINING_STEPS.split_ratio} AS DOUBLE))"""

_CARRY = carry_sql(
    f"SELECT idx - {CARRY_PASS.frame_size - 1} AS idx, x FROM ({_SCALED_CLOSES}) "
    f"WHERE idx >= {CARRY_PASS.frame_size - 1} AND idx - {CARRY_PASS.frame_size - 1} < greatest(1, n - {CARRY_PASS.frame_size})",
    rn.init_params(CARRY_PASS.shape, CARRY_PASS.seed),
)

ORACLE_SQL: dict[str, str] = {
    "csv_roundtrip": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "parquet_roundtrip": "SELECT * FROM nation",
    "daily_ohlcv": _EVENT_DAYS_SQL,
    "next_day_join": _NEXT_DAYS_SQL,
    "next_day_join_sql": _NEXT_DAYS_SQL,
    "event_next_days": _EVENT_NEXT_DAYS,
    "event_minmax_scale": _EVENT_MINMAX,
    "event_split": _EVENT_SPLIT,
    "stock_etl": _NEXT_DAYS_SQL,
    "since_filter": f"""
SELECT Date, Open, Close, Low, High, NextOpen, NextClose, NextLow, NextHigh
FROM ({_NEXT_DAYS_SQL}) WHERE Date >= DATE '1998-01-01' ORDER BY Date""",
    "minmax_stats": _minmax_sql(),
    "minmax_scale": _scaled_sql(False),
    "minmax_unscale": _scaled_sql(True),
    "sliding_frames": f"""
SELECT event_type, idx AS frame_idx, n_frames, Date AS start, end_day AS "end", 5 AS size,
       Close AS first_close, last_Close AS last_close
FROM ({_EVENT_FRAMES})""",
    "order_frames": f"""
SELECT idx AS frame_idx, n_frames, Date AS start, end_day AS "end",
       last_Close AS last_close, last_NextClose AS last_next_close
FROM ({_ORDER_FRAMES})""",
    "lineitem_frames": """
WITH r AS (
  SELECT l_returnflag, l_shipdate, l_quantity,
         row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY l_returnflag) AS n,
         lead(l_shipdate, 4) OVER w AS end_ts, lead(l_quantity, 4) OVER w AS last_qty,
         sum(l_extendedprice) OVER (PARTITION BY l_returnflag
             ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice
             ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS frame_price
  FROM lineitem
  WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice)
)
SELECT l_returnflag, idx AS frame_idx, CASE WHEN n < 5 THEN 0 ELSE greatest(1, n - 5) END AS n_frames,
       CAST(l_shipdate AS DATE) AS start, CAST(end_ts AS DATE) AS "end",
       l_quantity AS first_qty, last_qty, round(frame_price, 2) AS frame_price
FROM r WHERE idx < greatest(1, n - 5) AND idx + 4 < n""",
    "chronological_split": f"""
SELECT part, count(*) AS n, min(idx) AS first_idx, max(idx) AS last_idx FROM ({_ORDER_SPLIT}) GROUP BY part""",
    "minibatches": f"""
SELECT idx // 512 AS batch_id, count(*) AS n, min(idx) AS first_idx
FROM ({_ORDER_SPLIT}) WHERE part = 'train' GROUP BY 1""",
    "key_split": """
SELECT CASE WHEN p_partkey % 4 = 0 THEN 'test' ELSE 'train' END AS part, count(*) AS n,
       round(sum(p_retailprice), 2) AS sum_price
FROM part GROUP BY 1""",
    "prediction_grid": """
SELECT b.lo + CAST(i AS DOUBLE) * 0.5 AS x
FROM (SELECT CAST(min(p_size) AS DOUBLE) AS lo, CAST(max(p_size) AS DOUBLE) AS hi FROM part) b,
     LATERAL (SELECT unnest(range(0, CAST(floor((b.hi - b.lo) / 0.5) AS BIGINT) + 1)) AS i)""",
    "index_label": """
WITH c AS (SELECT p_type, count(*) AS n FROM part GROUP BY 1)
SELECT p_type, CAST(row_number() OVER (ORDER BY n DESC, p_type) - 1 AS DOUBLE) AS label, n FROM c""",
    "assemble_features": "SELECT p_partkey, [CAST(p_size AS DOUBLE), p_retailprice] AS features FROM part",
    "linear_regression": """
WITH tr AS (SELECT CAST(p_partkey AS DOUBLE) AS x, p_retailprice AS y FROM part WHERE p_partkey % 4 <> 0),
co AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, count(*) AS n_train FROM tr),
te AS (SELECT CAST(p_partkey AS DOUBLE) AS x, p_retailprice AS y FROM part WHERE p_partkey % 4 = 0)
SELECT round(co.slope, 8) AS slope, round(co.intercept, 3) AS intercept, co.n_train, count(*) AS n_test,
       round(sqrt(avg(power(te.y - (co.intercept + co.slope * te.x), 2))), 4) AS rmse_test
FROM te, co GROUP BY co.slope, co.intercept, co.n_train""",
    "multiple_linear_regression": f"""
WITH {_TWO_SLOPES}
SELECT round(b1, 8) AS b_partkey, round(b2, 6) AS b_size, round(b0, 3) AS intercept, count(*) AS n_test,
       round(sqrt(avg(power(p_retailprice - (b0 + b1 * p_partkey + b2 * p_size), 2))), 4) AS rmse_test
FROM c, part WHERE p_partkey % 4 = 0 GROUP BY b1, b2, b0""",
    "regress_linear": f"""
WITH {_TWO_SLOPES},
p AS (SELECT p_partkey % 4 = 0 AS test, CAST(p_partkey AS DOUBLE) AS x, CAST(p_retailprice AS DOUBLE) AS y,
             b0 + b1 * p_partkey + b2 * p_size AS h FROM part, c)
SELECT CASE WHEN test THEN 'Test Set' ELSE 'Training Set' END AS series, x, round(y, 4) AS y FROM p
UNION ALL
SELECT CASE WHEN test THEN 'Predictions' ELSE 'Regression' END, x, round(h, 4) FROM p""",
    "random_split_cover": "SELECT p_partkey, count(*) AS times FROM part GROUP BY 1",
    "model_roundtrip": """
WITH m AS (SELECT regr_slope(p_retailprice, p_partkey) AS b, regr_intercept(p_retailprice, p_partkey) AS a
           FROM part WHERE p_partkey % 4 <> 0)
SELECT p_partkey, round(a + b * p_partkey, 4) AS predict, true AS same FROM part, m WHERE p_partkey % 4 = 0""",
    "preview_rows": "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 20",
    "kmeans_segments_check": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS not_nearest, true AS within_k FROM customer",
    "kmeans_embeddings_check": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS not_nearest, true AS within_k FROM embeddings",
    "forest_is_mean_of_trees": "SELECT p_partkey, true AS is_mean FROM part",
    "seeded_split": """
SELECT part, count(*) AS n, count(DISTINCT l_orderkey) AS orders, round(sum(l_quantity), 2) AS quantity
FROM (SELECT *, CASE WHEN CAST('0x' || substr(md5('123:' || l_orderkey), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) < 0.75
                     THEN 'train' ELSE 'test' END AS part FROM lineitem) GROUP BY 1""",
    "frequency_index": """
SELECT l_orderkey, CAST(row_number() OVER (ORDER BY n DESC, CAST(l_orderkey AS VARCHAR)) - 1 AS DOUBLE) AS label, n, quantity
FROM (SELECT l_orderkey, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1)""",
    "boxes_forest_regressor": "SELECT p_partkey, true AS same, CAST(20 AS BIGINT) AS trees FROM part",
    "boxes_tree_regressor": "SELECT p_partkey, true AS same, CAST(1 AS BIGINT) AS trees FROM part",
    "boxes_forest_classifier": f"SELECT doc_id, true AS same, CAST(20 AS BIGINT) AS trees FROM ({_DOCS_SQL})",
    "boxes_tree_classifier": f"SELECT doc_id, true AS same, CAST(1 AS BIGINT) AS trees FROM ({_DOCS_SQL})",
    "forecast_check": f"""
SELECT frame_idx, frame_idx + 1 AS time, part, actual, true AS finite FROM ({_PREPARED})""",
    "training_check": f"SELECT *, true AS falls FROM ({_TRAINING_ROUNDS})",
    "forecast_levels": f"""
WITH r AS (SELECT row_number() OVER (ORDER BY Date) - 1 AS idx, count(*) OVER () AS n FROM ({_NEXT_DAYS_SQL}))
SELECT CASE WHEN idx < floor(greatest(1, n - 8) * CAST(0.9 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part,
       count(*) AS n_frames, true AS beats_mean
FROM r WHERE idx < greatest(1, n - 8) GROUP BY 1""",
    "lineitem_training": _LINEITEM_ROUNDS,
    "training_steps": training_sql(_TWO_DAY_FRAMES, TRAINING_STEPS),
    "carry_pass": f"SELECT idx AS frame_idx, round(pred, 9) AS pred FROM ({_CARRY})",
    "lineitem_carry": f"""
SELECT l_returnflag, n_frames, n_frames AS n_distinct, n_frames - 1 AS last_frame, CAST(0 AS BIGINT) AS unsettled
FROM ({_LINEITEM_FRAMES}) WHERE n_frames > 0""",
    "model_resume": f"SELECT epoch, round, n_frames, true AS same_loss, true AS same_state FROM ({_TRAINING_ROUNDS})",
    "null_key_frames": f"""
SELECT event_type, idx AS frame_idx, n_frames,
       CASE WHEN idx < floor(n_frames * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part, last_Close AS last_close
FROM ({_frames_sql(_NULL_DAYS_SQL, 5, "event_type", ["Close"])})""",
    "null_key_minmax": _EVENT_MINMAX.replace(_EVENT_DAYS_SQL, _NULL_DAYS_SQL).replace(
        "d.event_type = s.event_type", "d.event_type IS NOT DISTINCT FROM s.event_type"
    ),
    "null_metrics": f"""
WITH t AS ({_NULL_LABEL_PAIRS}),
tp AS (SELECT label, count(*) FILTER (WHERE label = prediction) AS tp FROM t WHERE label IS NOT NULL GROUP BY 1),
pc AS (SELECT prediction AS label, count(*) AS n_pred FROM t GROUP BY 1)
SELECT 'accuracy' AS metric, CAST(NULL AS DOUBLE) AS label, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS value FROM t
UNION ALL
SELECT 'precision', tp.label, round(CASE WHEN coalesce(n_pred, 0) = 0 THEN 0.0 ELSE tp / n_pred END, 9)
FROM tp LEFT JOIN pc ON tp.label = pc.label""",
    "naive_bayes": """
WITH tr AS (SELECT * FROM part WHERE p_partkey % 4 <> 0),
c AS (SELECT p_type, count(*) AS n_c, sum(CAST(p_size AS DOUBLE)) AS s1, sum(p_retailprice) AS s2 FROM tr GROUP BY 1),
tot AS (SELECT sum(n_c) AS nn, count(*) AS k FROM c),
m AS (SELECT CAST(row_number() OVER (ORDER BY n_c DESC, p_type) - 1 AS DOUBLE) AS label, p_type,
             ln(n_c + 1) - ln(nn + k) AS prior, ln(s1 + 1) - ln(s1 + s2 + 2) AS t1, ln(s2 + 1) - ln(s1 + s2 + 2) AS t2
      FROM c, tot),
best AS (SELECT p.p_partkey, arg_max(m.label, m.prior + p.p_size * m.t1 + p.p_retailprice * m.t2) AS label
         FROM part p, m WHERE p.p_partkey % 4 = 0 GROUP BY 1),
given AS (SELECT label, count(*) AS n_test FROM best GROUP BY 1)
SELECT m.label, p_type, round(prior, 9) AS log_prior, round(t1, 9) AS log_theta_size, round(t2, 9) AS log_theta_price,
       coalesce(n_test, 0) AS n_test
FROM m LEFT JOIN given ON m.label = given.label""",
    "logistic_regression": f"""
SELECT CAST(n_chars > 1500 AS DOUBLE) AS long_text, round(avg(quality), 4) AS p_quality, count(*) AS n
FROM ({_DOCS_SQL}) GROUP BY 1""",
    "decision_tree_regressor": _TREE_REGRESSOR,
    "random_forest_regressor": _TREE_REGRESSOR,
    "decision_tree_classifier": _TREE_CLASSIFIER,
    "random_forest_classifier": _TREE_CLASSIFIER,
    "kmeans_two_groups": """
WITH c AS (SELECT c_acctbal + CAST(100000 AS DOUBLE) * (c_custkey % 2) AS x, c_custkey % 2 AS g FROM customer),
m AS (SELECT avg(x) AS centre, count(*) AS size FROM c GROUP BY g)
SELECT CAST(row_number() OVER (ORDER BY centre) - 1 AS BIGINT) AS cluster, round(centre, 4) AS centre, size FROM m""",
    "confusion_matrix": f"""
SELECT label, prediction, count(*) AS n FROM ({_LABEL_PAIRS})
WHERE prediction IN (SELECT label FROM ({_LABEL_PAIRS})) GROUP BY 1, 2""",
    "accuracy": _ACCURACY,
    "precision_by_label": _PRECISION,
    "metrics_report": f"""
SELECT 'accuracy' AS metric, CAST(NULL AS DOUBLE) AS label, accuracy AS value FROM ({_ACCURACY})
UNION ALL
SELECT 'precision', label, precision FROM ({_PRECISION})""",
    "overlay_series": _OVERLAY,
    "classify_naive_bayes": _NB_REPORT,
    "prepare_series": _PREPARED,
    "prepare_event_series": _PREPARED_EVENTS,
}
