"""Contiguous balanced shards from a global prefix sum of sizes (native)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut


def shard(docs: DataFrame, shards: int = 40, law: str = "bytes", overhead: int = 16) -> DataFrame:
    """Cut documents, in the order of doc_id, into ``shards`` contiguous runs.

    ``law='bytes'``: runs of nearly equal bytes, each within one document of
    total/shards. ``law='rows'``: row counts at most one apart. A document's
    size is the UTF-8 bytes of its text plus ``overhead``; a null text has none.

    Rows are range-partitioned by id once, without their texts. Each partition
    gives one row of totals; the prefix sums of those few rows, joined back,
    turn positions inside a partition into global ones. No task sees more than
    a partition, and a shard is not a task: 40 shards don't limit parallelism.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this
    law moves rows when shards are added). Null ids come first; repeated rows
    keep their own slots; an empty table gives no rows; other columns are
    ignored.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"unknown law {law!r}")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # the partition of a row must stay the same for totals and prefixes, so it is written down
    rows = cut(rows.repartitionByRange("doc_id", "tie").withColumn("part", F.spark_partition_id()))
    parts = rows.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(whole).alias("bytes_all"),
        F.sum("part_rows").over(whole).alias("rows_all"),
    )
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumns({"run": F.sum("size").over(inside), "nth": F.row_number().over(inside)})
        .join(F.broadcast(parts), "part")  # as many rows as partitions
        .withColumn("position", F.col("rows_before") + F.col("nth") - 1)
    )
    cuts = {"bytes": f"(bytes_before + run - size) * {shards} div bytes_all", "rows": f"position * {shards} div rows_all"}
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.expr(cuts[law])).cast("int"))
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(  # as many rows as shards
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", (F.col("position") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
