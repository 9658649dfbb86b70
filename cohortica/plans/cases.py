"""Tables the registered queries work on, derived from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = ("total_price", "n_lines", "sum_qty", "max_disc", "acct_bal", "nation_code", "priority", "segment")
NUMERIC = FEATURES[:6]
TEXT = FEATURES[6:]
BINARISED = ("n_lines", "nation_code")
CLASSES = ("Dropout", "Enrolled", "Graduate")

# name: multipliers of the hash-like scores
MODELS = {"BASE_LR": (7, 13), "BASE_RF": (11, 17), "BINN_LR": (19, 23), "BINN_XGB": (29, 31)}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with features of its lines and customer, and a learnable noisy outcome."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"), F.max("l_discount").alias("max_disc"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    noise = F.md5(F.concat(F.lit("noise:"), F.col("o_orderkey").cast("string")))
    second = F.substring(noise, 2, 1)
    outcome = (
        F.when(F.substring(noise, 1, 1).isin("0", "1"),
               F.when(second < "5", "Dropout").when(second < "a", "Enrolled").otherwise("Graduate"))
        .when(F.coalesce("sum_qty", F.lit(0.0)) < 60, "Dropout")
        .when(F.col("o_totalprice") > 350000, "Enrolled")
        .otherwise("Graduate")
    )
    orders = table(spark, folder, "orders")
    return (
        orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
        .join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
        .select(
            F.col("o_orderkey").alias("case_id"), F.col("o_totalprice").alias("total_price"), "n_lines", "sum_qty",
            "max_disc", F.col("c_acctbal").alias("acct_bal"), F.col("c_nationkey").cast("bigint").alias("nation_code"),
            F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderpriority")).alias("priority"),
            F.col("c_mktsegment").alias("segment"), outcome.alias("outcome"))
    )


CASES_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty, max(l_discount) AS max_disc
  FROM lineitem GROUP BY l_orderkey),
noisy AS (SELECT *, md5('noise:' || CAST(o_orderkey AS VARCHAR)) AS h FROM orders),
cases AS (
  SELECT o_orderkey AS case_id, o_totalprice AS total_price, n_lines, sum_qty, max_disc, c_acctbal AS acct_bal,
    CAST(c_nationkey AS BIGINT) AS nation_code,
    CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END AS priority, c_mktsegment AS segment,
    CASE WHEN h[1] IN ('0', '1')
           THEN CASE WHEN h[2] < '5' THEN 'Dropout' WHEN h[2] < 'a' THEN 'Enrolled' ELSE 'Graduate' END
         WHEN coalesce(sum_qty, 0) < 60 THEN 'Dropout'
         WHEN o_totalprice > 350000 THEN 'Enrolled'
         ELSE 'Graduate' END AS outcome
  FROM noisy LEFT JOIN lines ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey)
"""


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Cases with ``row_id`` and class code ``label``."""
    code = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("outcome")).cast("int") - 1
    return cases(spark, folder).withColumnRenamed("case_id", "row_id").withColumn("label", code)


LABELLED_SQL = CASES_SQL + """,
labelled AS (
  SELECT case_id AS row_id, * EXCLUDE (case_id),
    CASE outcome WHEN 'Dropout' THEN 0 WHEN 'Enrolled' THEN 1 ELSE 2 END AS label
  FROM cases)
"""


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of four named models for every order: arithmetic on the keys, better than chance."""
    label = F.array_position(F.array(F.lit("F"), F.lit("O"), F.lit("P")), F.col("o_orderstatus")).cast("int") - 1
    base = table(spark, folder, "orders").select("o_orderkey", "o_custkey", label.alias("label"))

    listed = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(a).alias("a"), F.lit(b).alias("b"))
                       for m, (a, b) in MODELS.items()])
    rows = base.select("*", F.inline(listed))

    def raw(k):
        part = (F.col("o_orderkey") * (F.col("a") + k) + F.col("o_custkey") * (F.col("b") + 2 * k)) % 997
        return part / F.lit(997.0) + F.when(F.col("label") == k, F.lit(0.01) * F.col("a")).otherwise(0.0) + 0.001

    total = F.col("s0") + F.col("s1") + F.col("s2")
    out = rows.select("*", *[raw(k).alias(f"s{k}") for k in range(3)]).select(
        "model", "o_orderkey", "label", F.array(*[F.col(f"s{k}") / total for k in range(3)]).alias("probability"))
    return out.withColumn("prediction", F.array_position("probability", F.array_max("probability")).cast("int") - 1)


def _raw_sql(k: int) -> str:
    return (f"CAST((o_orderkey * (a + {k}) + o_custkey * (b + {2 * k})) % 997 AS DOUBLE) / 997.0"
            f" + CASE WHEN label = {k} THEN CAST(0.01 AS DOUBLE) * a ELSE 0.0 END + CAST(0.001 AS DOUBLE) AS s{k}")


SCORES_SQL = f"""
models(model, a, b) AS (VALUES {", ".join(f"('{m}', {a}, {b})" for m, (a, b) in MODELS.items())}),
coded AS (
  SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS label FROM orders),
raw AS (SELECT model, o_orderkey, label, {", ".join(_raw_sql(k) for k in range(3))} FROM coded CROSS JOIN models),
scores AS (
  SELECT model, o_orderkey, label, s0 / (s0 + s1 + s2) AS p0, s1 / (s0 + s1 + s2) AS p1, s2 / (s0 + s1 + s2) AS p2
  FROM raw),
predicted AS (
  SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS prediction FROM scores)
"""
