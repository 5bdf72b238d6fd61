"""Session listings and text files of parameters, clusters and headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed codes of cluster groups.
GROUPS = {"noise": 0, "mua": 1, "good": 2, "unsorted": 3}


def listing(spark: SparkSession, path: str, subjects: list[str] | None = None, sessions: list[str] | None = None, least: int = 1) -> DataFrame:
    """Files below a path: subject and session from the last two folders, name, size. Contents aren't read.

    ``subjects`` and ``sessions`` keep those named (all by default), ``least`` those subjects whose name has so many characters.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    parts = F.split("path", "/")
    rows = rows.select("path", "length", "modificationTime", F.element_at(parts, -3).alias("subject"), F.element_at(parts, -2).alias("session"), F.element_at(parts, -1).alias("name")).where(F.length("subject") >= least)
    rows = rows if subjects is None else rows.where(F.col("subject").isin(subjects))
    return rows if sessions is None else rows.where(F.col("session").isin(sessions))


def formats(listed: DataFrame) -> DataFrame:
    """Each session's recording format by its marker files."""
    has = lambda pattern: F.max(F.col("name").rlike(pattern))
    kind = (
        F.when(has(r"^EVENTLOG\.NLE$"), "DT2").when(has(r"^EVENT\d*\.DF1$"), "DF1").when(has(r"^info\.rhd$") & (F.sum(F.col("name").rlike(r"^amp-.*\.dat$").cast("int")) > 1), "file per channel")
        .when(has(r"^info\.rhd$"), "file per type").when(has(r"FTcont"), "continuous").when(has(r"^settings\.xml$"), "traditional")
    )
    return listed.groupBy("subject", "session").agg(kind.alias("format"))


def key_values(spark: SparkSession, path: str, sep: str = "=") -> DataFrame:
    """``name = value`` lines: the text, and its value as number or truth where it is one. Nothing is evaluated."""
    line = F.split("value", sep, 2)
    rows = spark.read.text(path).where(F.col("value").contains(sep)).select(F.input_file_name().alias("file"), F.trim(line[0]).alias("name"), F.trim(line[1]).alias("raw"))
    text = F.regexp_replace("raw", r"^['\"](.*)['\"]$", "$1")
    return rows.select("file", "name", text.alias("text"), F.col("raw").try_cast("double").alias("number"), F.when(F.col("raw").isin("True", "False"), F.col("raw") == "True").alias("flag"))


def cluster_groups(spark: SparkSession, path: str) -> DataFrame:
    """Units with their group's code; a word that isn't known counts as unsorted."""
    rows = spark.read.csv(path, sep="\t", header=True)
    code = F.lit(GROUPS["unsorted"])
    for name, value in GROUPS.items():
        code = F.when(F.col("group") == name, value).otherwise(code)
    return rows.select(F.col("cluster_id").cast("int").alias("unit"), code.alias("grp"))


def phy_spikes(times: DataFrame, clusters: DataFrame, amplitudes: DataFrame, groups: DataFrame, rate: float) -> DataFrame:
    """Spikes from row-aligned arrays, without units marked as noise; times in seconds."""
    one = lambda df, name: df.select("row", F.element_at("value", 1).alias(name))
    rows = one(times, "at").join(one(clusters, "unit"), "row").join(one(amplitudes, "ampl"), "row")
    rows = rows.select(F.col("row").alias("spike_id"), F.col("unit").cast("int").alias("unit"), (F.col("at") / rate).alias("t_s"), "ampl")
    return rows.join(groups.where(F.col("grp") == GROUPS["noise"]).select("unit"), "unit", "left_anti")


def channel_map(spark: SparkSession, n: int, bank: int = 32) -> DataFrame:
    """A column of channels from below, with banks."""
    return spark.range(n).select(F.col("id").cast("int").alias("channel"), F.lit(1.0).alias("x"), (F.col("id") + 1).cast("double").alias("y"), F.lit(1).alias("k"), F.lit(True).alias("connected"), F.expr(f"CAST(id div {bank} AS INT)").alias("bank"))


def xml_events(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).load(path)


def write_session(df: DataFrame, path: str, by: tuple[str, ...] = ("subject", "session")) -> None:
    """A table of the lake, one folder a session; only sessions at hand are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_metrics(metrics: DataFrame, path: str, key: str = "unit") -> None:
    """Measures as Parquet, and each as a table of its own for viewers."""
    numbers = metrics.select(key, *[F.col(c).cast("double").alias(c) for c in metrics.columns if c != key])
    numbers.write.mode("overwrite").parquet(f"{path}/metrics.parquet")
    numbers = metrics.sparkSession.read.parquet(f"{path}/metrics.parquet")  # measured once
    for c in numbers.columns:
        if c != key:
            numbers.select(F.col(key).alias("cluster_id"), c).coalesce(1).write.mode("overwrite").csv(f"{path}/cluster_{c}.tsv", sep="\t", header=True)  # a row a unit
