"""The driver's tables in their roles for electrophysiology, and the same as SQL views.

Times are whole milliseconds since 1970, read off the timestamp's fields so that
no session time zone enters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import numbered

HOUR = 3_600_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task is meant to hold.
ROWS = 500_000


def tasks(spark: SparkSession, d: str, name: str = "lineitem") -> int | None:
    """How many tasks a table's rows take, from its files' own counts; none where the session's number is enough."""
    n = -(-read(spark, d, name).count() // ROWS)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def millis(name: str):
    ts = F.col(name)
    whole = F.unix_date(F.to_date(ts)).cast("long") * 86_400_000 + F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000
    return (whole + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000)).cast("long")


def events(spark: SparkSession, d: str) -> DataFrame:
    depth = F.regexp_extract("props", r"(\d+)", 1).cast("long")
    return read(spark, d, "events").select("event_id", "user_id", "event_type", "value", millis("ts").alias("t"), depth.alias("depth"))


def spikes(spark: SparkSession, d: str) -> DataFrame:
    """Clicks and views as spikes of units (users)."""
    rows = events(spark, d).where(F.col("event_type").isin("click", "view"))
    return rows.select(F.col("user_id").alias("unit"), F.col("event_id").alias("spike_id"), "t", F.col("value").alias("ampl"), "depth")


def trials(spark: SparkSession, d: str, kind: str = "signup", half: int = 6 * HOUR) -> DataFrame:
    """Events of a kind as trials around their time."""
    rows = events(spark, d).where(F.col("event_type") == kind)
    return rows.select(F.col("event_id").alias("trial"), F.col("user_id").alias("subject"), F.col("t").alias("t0"), (F.col("t") - half).alias("start"), (F.col("t") + half).alias("end"), "value")


def samples(spark: SparkSession, d: str) -> DataFrame:
    """Line items as a recording: channel, sample number, voltage. Samples are counted month by month, so that no task sorts a whole channel."""
    rows = read(spark, d, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    rows = numbered(rows, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], F.year("l_shipdate") * 12 + F.month("l_shipdate"), tasks=tasks(spark, d))
    return rows.select(F.col("l_suppkey").alias("channel"), "sample", F.col("l_quantity").alias("v"), F.col("l_extendedprice").alias("w"))


def conditions(spark: SparkSession, d: str) -> DataFrame:
    """Orders as trials with an outcome, a block and a session."""
    rows = read(spark, d, "orders")
    return rows.select(F.col("o_orderkey").alias("trial"), F.col("o_custkey").alias("session"), F.col("o_orderstatus").alias("outcome"), F.substring("o_orderpriority", 1, 1).cast("int").alias("block"), F.col("o_totalprice").alias("x"), millis("o_orderdate").alias("t"))


MS = "epoch_us({0}) // 1000"
EVENTS = f"ev AS (SELECT event_id, user_id, event_type, value, {MS.format('ts')} AS t, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS depth FROM events)"
SPIKES = EVENTS + ", spike AS (SELECT user_id AS unit, event_id AS spike_id, t, value AS ampl, depth FROM ev WHERE event_type IN ('click', 'view'))"
TRIALS = SPIKES + f", trial AS (SELECT event_id AS trial, user_id AS subject, t AS t0, t - {6 * HOUR} AS start, t + {6 * HOUR} AS stop, value FROM ev WHERE event_type = 'signup')"
SAMPLES = "smp AS (SELECT l_suppkey AS channel, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS sample, l_quantity AS v, l_extendedprice AS w FROM lineitem)"
CONDITIONS = f"cond AS (SELECT o_orderkey AS trial, o_custkey AS session, o_orderstatus AS outcome, CAST(substr(o_orderpriority, 1, 1) AS INT) AS block, o_totalprice AS x, {MS.format('o_orderdate')} AS t FROM orders)"
