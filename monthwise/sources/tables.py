"""Table access and the mapping of the driver's Parquet tables onto report inputs.

Report inputs (one row or more per period, type and label):
  subscribers  PERIODO int, TIPO string, SVA_SMS string, Q_LINEAS_SUSCRITAS bigint
  transactions PERIODO int, TIPO string, SVA_SMS string, Q_TRANSACCIONES bigint,
               MONTO_NETO decimal (per-transaction net amount)
  calendar     DIA_FECHA date, DAYNAMELONG string
  outbox       FECHA date, PARA, CC, SUBJECT, BODY, PROCESADO string

They are derived from ``lineitem`` (facts), ``supplier`` / ``part`` (labels) and
``events`` (outbox).  The label lives in a dimension, so the labelled aggregate is
built by *eager aggregation*: facts are summed per (period, type, label key)
first, and only those parts are joined to the dimension.  The join then moves
parts, not fact rows, and the dimension side is broadcast only when Spark's
size statistics (``autoBroadcastJoinThreshold``, AQE runtime sizes) allow it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions.periods import period_key, yyyymmdd
from monthwise.operators.gating import calendar_from_dates
from monthwise.operators.window import trailing_months

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Label dimensions: name -> (dimension table, fact key, dimension key, label column).
LABEL_DIMS = {
    "supplier": ("supplier", "l_suppkey", "s_suppkey", "s_name"),   # wide: many labels
    "part_type": ("part", "l_partkey", "p_partkey", "p_type"),      # narrow: few labels
}

# Fixed mapping of the line flag onto report line types.
TYPE_BY_FLAG = {"A": "SVA", "R": "SMSP"}
OTHER_TYPE = "OTHER"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_type(flag_col="l_returnflag"):
    c = F.col(flag_col)
    expr = F.when(c == F.lit("A"), F.lit(TYPE_BY_FLAG["A"]))
    expr = expr.when(c == F.lit("R"), F.lit(TYPE_BY_FLAG["R"]))
    return expr.otherwise(F.lit(OTHER_TYPE))


def net_amount():
    """Exact per-line net amount: price x (1 - discount) in DECIMAL."""
    return (F.col("l_extendedprice").cast("decimal(18,2)")
            * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)")))


def keyed_facts(spark: SparkSession, sf_dir: str, label: str = "supplier") -> DataFrame:
    """Row-level facts with the label *key* (not yet the label):
    PERIODO, TIPO, label key, Q, MONTO_NETO, plus the raw ship date and row ids."""
    _, fkey, _, _ = LABEL_DIMS[label]
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        period_key("l_shipdate").alias("PERIODO"),
        line_type().alias("TIPO"),
        F.col(fkey).alias("label_key"),
        F.col("l_quantity").cast("bigint").alias("Q"),
        net_amount().alias("MONTO_NETO"),
        F.col("l_shipdate"),
        F.col("l_orderkey"),
        F.col("l_linenumber"),
    )


def label_dim(spark: SparkSession, sf_dir: str, label: str = "supplier") -> DataFrame:
    table, _, dkey, lcol = LABEL_DIMS[label]
    return read_table(spark, sf_dir, table).select(F.col(dkey).alias("label_key"),
                                                   F.col(lcol).alias("SVA_SMS"))


def windowed_facts(spark: SparkSession, sf_dir: str, as_of, n_back: int = 7,
                   label: str = "supplier") -> DataFrame:
    """Keyed facts inside the trailing window (filter reaches the Parquet scan)."""
    return trailing_months(keyed_facts(spark, sf_dir, label), "PERIODO", as_of, n_back,
                           date_col="l_shipdate")


def labelled_parts(facts: DataFrame, dim: DataFrame, keys=("PERIODO", "TIPO"),
                   with_amount: bool = True) -> DataFrame:
    """Eager aggregation: sum per (keys, label_key), then resolve the label.

    Output grain is (keys, SVA_SMS) with ``Q`` (sum of quantities) and, when
    ``with_amount``, ``QM`` (sum of quantity x amount).  Keys without a dimension
    row get a NULL label (left join), so no fact is dropped.
    """
    keys = list(keys)
    aggs = [F.sum("Q").alias("Q")]
    if with_amount:
        aggs.append(F.sum(F.col("Q") * F.col("MONTO_NETO")).alias("QM"))
    parts = facts.groupBy(*keys, "label_key").agg(*aggs)
    joined = parts.join(dim, on="label_key", how="left")
    out = [F.sum("Q").alias("Q")]
    if with_amount:
        out.append(F.sum("QM").alias("QM"))
    return joined.groupBy(*keys, "SVA_SMS").agg(*out)


def subscriber_rows(spark: SparkSession, sf_dir: str, label: str = "supplier") -> DataFrame:
    """Row-level subscriber base (label joined per row), for row-level operators."""
    f = keyed_facts(spark, sf_dir, label)
    d = label_dim(spark, sf_dir, label)
    return f.join(d, on="label_key", how="left").select(
        "PERIODO", "TIPO", "SVA_SMS", F.col("Q").alias("Q_LINEAS_SUSCRITAS"), "l_shipdate")


def transaction_rows(spark: SparkSession, sf_dir: str, label: str = "supplier") -> DataFrame:
    """Row-level transactions (label joined per row), for row-level operators."""
    f = keyed_facts(spark, sf_dir, label)
    d = label_dim(spark, sf_dir, label)
    return f.join(d, on="label_key", how="left").select(
        "PERIODO", "TIPO", "SVA_SMS", F.col("Q").alias("Q_TRANSACCIONES"), "MONTO_NETO",
        "l_shipdate", "l_orderkey", "l_linenumber")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business calendar: one row per distinct ship day with its Spanish weekday name."""
    return calendar_from_dates(read_table(spark, sf_dir, "lineitem"), "l_shipdate")


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbox table derived from ``events`` (many rows share a subject)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.to_date("ts").alias("FECHA"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("PARA"),
        F.lit(None).cast("string").alias("CC"),
        F.concat(F.col("event_type"), F.lit(" "), yyyymmdd("ts")).alias("SUBJECT"),
        F.col("props").alias("BODY"),
        F.when(F.col("value") >= 5, F.lit("N")).otherwise(F.lit("S")).alias("PROCESADO"),
    )
