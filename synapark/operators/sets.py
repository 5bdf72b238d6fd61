"""Set operations on tables in long form."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns by name; a column that a part lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def append_unique(key: str, *parts: DataFrame) -> DataFrame:
    """The same, with an error in the job if two parts share a key."""
    marked = append(*[p.withColumn("_part", F.lit(k)) for k, p in enumerate(parts)])
    keys = marked.groupBy(key).agg(F.countDistinct("_part").alias("_parts"))
    checked = marked.join(keys, key)
    clash = F.raise_error(F.concat(F.lit(f"{key} in more than one part: "), F.col(key).cast("string")))
    return checked.withColumn(key, F.when(F.col("_parts") > 1, clash.cast(marked.schema[key].dataType)).otherwise(F.col(key))).drop("_part", "_parts")


def union_first(a: DataFrame, b: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Distinct keys of both with the least order value of each."""
    return a.unionByName(b).groupBy(*keys).agg(F.min(order).alias(order))


def symmetric_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of just one of the two, in one aggregate."""
    both = a.select(*keys, F.lit(1).alias("_s")).unionByName(b.select(*keys, F.lit(2).alias("_s")))
    return both.groupBy(*keys).agg(F.countDistinct("_s").alias("_n")).where("_n = 1").drop("_n")


def match(a: DataFrame, b: DataFrame, label: str, order_a: str, order_b: str) -> DataFrame:
    """Labels of both lists with their places (from 1) in each, in the order of the first list."""
    from pyspark.sql import Window

    place = lambda df, order, name: df.select(label, F.row_number().over(Window.partitionBy(label).orderBy(order)).alias("_k"), F.col(order).alias(name))
    return place(a, order_a, "at_a").join(place(b, order_b, "at_b"), [label, "_k"]).drop("_k")
