"""Review inputs derived from the supplied TPC-H-like tables: features, predictions, feedback, model runs.

The view text runs unchanged in Spark and in the SQL oracle. Sums are rounded inside the view so that float
noise cannot move a value across a quantile border.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REVIEW_BASE = """
SELECT o.o_orderkey AS entity_id, o.o_custkey % 3 AS model_id,
       CASE WHEN o.o_orderdate < TIMESTAMP '1998-05-01 00:00:00' THEN 'train' ELSE 'current' END AS win,
       CAST(count(*) AS DOUBLE) AS n_items,
       round(sum(l.l_quantity), 4) AS qty,
       round(sum(l.l_extendedprice), 4) AS price,
       round(avg(l.l_discount), 6) AS avg_discount,
       round(avg(l.l_tax), 6) AS avg_tax,
       CASE WHEN max(o.o_orderpriority) LIKE '1%' THEN 1.0E0 ELSE 0.0E0 END AS urgent,
       CASE WHEN 2 * sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) >= count(*) THEN 1 ELSE 0 END AS label
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderkey, o.o_custkey, o.o_orderdate
"""

# The same rows for Spark: lines are summed per order before the join, so one row per order is joined and no text
# column is aggregated. Equal to the text above because o_orderkey is unique.
ORDER_BASE = """
SELECT o.o_orderkey AS entity_id, o.o_custkey % 3 AS model_id,
       CASE WHEN o.o_orderdate < TIMESTAMP '1998-05-01 00:00:00' THEN 'train' ELSE 'current' END AS win,
       l.n_items, l.qty, l.price, l.avg_discount, l.avg_tax,
       CASE WHEN o.o_orderpriority LIKE '1%' THEN 1.0E0 ELSE 0.0E0 END AS urgent, l.label
FROM {orders} o JOIN (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_items, round(sum(l_quantity), 4) AS qty,
         round(sum(l_extendedprice), 4) AS price, round(avg(l_discount), 6) AS avg_discount,
         round(avg(l_tax), 6) AS avg_tax,
         CASE WHEN 2 * sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) >= count(*) THEN 1 ELSE 0 END AS label
  FROM {lineitem} GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
"""

# Quantity drifts and discounts go missing in the current window.
REVIEW_FEATURES = """
SELECT entity_id, model_id, win, n_items,
       CASE WHEN win = 'current' THEN round(qty * 1.15E0, 4) ELSE qty END AS qty,
       price,
       CASE WHEN win = 'current' AND entity_id % 17 = 0 THEN NULL ELSE avg_discount END AS avg_discount,
       avg_tax, urgent, label
FROM review_base
"""

# Scores follow the label, have many ties and shift in the current window.
REVIEW_PREDICTIONS = """
SELECT entity_id, model_id, win, score,
       CASE WHEN score >= 0.5E0 THEN 1 ELSE 0 END AS predicted_label, label AS actual_label
FROM (SELECT entity_id, model_id, win, label,
             round(1.0E0 / (1.0E0 + exp(-(-0.8E0 + 1.2E0 * label
                   + 1.5E0 * ((entity_id * 7919) % 1000) / 1000.0E0
                   + CASE WHEN win = 'current' THEN 0.25E0 ELSE 0.0E0 END - 0.75E0))), 6) AS score
      FROM review_base) p
"""

REVIEW_FEEDBACK = """
SELECT event_id, concat('run_', CAST(user_id % 5 AS VARCHAR(10))) AS run_id,
       CASE user_id % 4 WHEN 0 THEN 'model_analyst' WHEN 1 THEN 'data_scientist'
                        WHEN 2 THEN 'executive' ELSE 'client_safe' END AS user_role,
       concat('FINDING_', CAST(user_id % 6 AS VARCHAR(10))) AS finding_id,
       CASE WHEN user_id % 8 = 0 THEN '' ELSE concat('feature_', CAST(user_id % 8 AS VARCHAR(10))) END AS feature,
       CASE event_type WHEN 'view' THEN 'helpful' WHEN 'signup' THEN 'accepted_recommendation'
                       WHEN 'purchase' THEN 'rejected_recommendation' WHEN 'error' THEN 'false_alarm'
                       WHEN 'click' THEN 'too_technical' END AS feedback_type,
       CASE user_id % 3 WHEN 0 THEN 'drift' WHEN 1 THEN 'diagnostics' ELSE 'summary' END AS related_agent
FROM events
"""

REVIEW_RUNS = """
SELECT concat('run_', CAST(n_nationkey AS VARCHAR(10))) AS run_id, 0.7E0 + n_nationkey / 100.0E0 AS train_auc,
       CASE WHEN n_nationkey % 11 = 0 THEN NULL
            ELSE 0.7E0 + n_nationkey / 100.0E0 - (n_nationkey % 10) / 100.0E0 END AS validation_auc
FROM nation
"""

# Feedback by model: only two of the three models have any.
REVIEW_MODEL_FEEDBACK = REVIEW_FEEDBACK.replace("concat('run_', CAST(user_id % 5 AS VARCHAR(10))) AS run_id", "user_id % 2 AS model_id")

# The mean figures of a model's runs.
REVIEW_MODEL_RUNS = f"""
SELECT CAST(substr(run_id, 5) AS INTEGER) % 3 AS model_id, avg(train_auc) AS train_auc, avg(validation_auc) AS validation_auc
FROM ({REVIEW_RUNS}) r GROUP BY CAST(substr(run_id, 5) AS INTEGER) % 3
"""

# A threshold file of every run, as text: some objects, some spelled both ways, some without a file.
REVIEW_CONFIGS = """
SELECT concat('run_', CAST(n_nationkey AS VARCHAR(10))) AS run_id,
       CASE WHEN n_nationkey % 7 = 6 THEN NULL
            WHEN n_nationkey % 7 = 5 THEN '{}'
            ELSE concat('{"config_version": "v', CAST(n_regionkey AS VARCHAR(10)), '", "status": "active", "drift": {"psi_high": 0.',
                        CAST(25 + n_nationkey AS VARCHAR(10)), ', "psi_medium": null}, "diagnostics": {"vif_high": ',
                        CAST(8 + n_nationkey AS VARCHAR(10)), '.5',
                        CASE WHEN n_nationkey % 2 = 0 THEN ', "vif_thresholds": {"high": 12.5, "medium": 4.5}' ELSE '' END,
                        '}, "feedback": {"minimum_feedback_events_for_recommendation": ', CAST(2 + n_regionkey AS VARCHAR(10)), '}}')
       END AS config
FROM nation
"""

FEATURES = ["n_items", "qty", "price", "avg_discount", "avg_tax", "urgent"]
BOUNDS = {"avg_discount": (0.0, 0.095), "avg_tax": (0.0, 0.08)}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _over_base(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    base = spark.sql(ORDER_BASE, orders=_read(spark, sf_dir, "orders"), lineitem=_read(spark, sf_dir, "lineitem"))
    return spark.sql(sql.replace("FROM review_base", "FROM {base}"), base=base)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_base(spark, sf_dir, REVIEW_FEATURES)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_base(spark, sf_dir, REVIEW_PREDICTIONS)


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REVIEW_FEEDBACK.replace("FROM events", "FROM {events}"), events=_read(spark, sf_dir, "events"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REVIEW_RUNS.replace("FROM nation", "FROM {nation}"), nation=_read(spark, sf_dir, "nation"))


def _over(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {table}", "FROM {rows}").replace("{\"", "{{\"").replace("'{}'", "'{{}}'"), rows=_read(spark, sf_dir, table))


def model_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(spark, sf_dir, "events", REVIEW_MODEL_FEEDBACK)


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(spark, sf_dir, "nation", REVIEW_MODEL_RUNS)


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _read(spark, sf_dir, "nation").createOrReplaceTempView("scorewatch_nation")
    return spark.sql(REVIEW_CONFIGS.replace("FROM nation", "FROM scorewatch_nation"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem")
