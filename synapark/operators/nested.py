"""Ragged columns, references between tables, checked conversions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .graph import written
from .intervals import asof_join
from .windows import positions, running_total


def ragged_index(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each key and their cumulative bound in the order of the key.

    One row a key is all that the running sum sees.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("n"))
    return sizes.select(key, "n", F.sum("n").over(Window.orderBy(key)).alias("bound"))


def pack(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row a key with its rows as an array of structs, in order."""
    others = [c for c in rows.columns if c not in (key, *order)]
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, *others))).alias("rows"))


def unpack(packed: DataFrame, key: str) -> DataFrame:
    return packed.select(key, F.posexplode("rows").alias("pos", "_row")).select(key, "pos", "_row.*")


def decode_ragged(data: Column, bounds: Column) -> Column:
    """Slices of a flat array between cumulative bounds."""
    return F.transform(bounds, lambda b, i: F.slice(data, F.when(i == 0, 1).otherwise(F.element_at(bounds, F.greatest(i, F.lit(1))) + 1), b - F.when(i == 0, 0).otherwise(F.element_at(bounds, F.greatest(i, F.lit(1))))))


def dereference(rows: DataFrame, region: str, target: DataFrame, key: str) -> DataFrame:
    """Rows of another table that an index column points at (from 0)."""
    return rows.join(target, rows[region] == target[key])


def cast_checked(x: Column, kind: str) -> Column:
    """A cast that fails the job where it would change the value."""
    to = x.try_cast(kind)
    lost = x.isNotNull() & (to.isNull() | (to.cast("double") != x.cast("double")))
    return F.when(lost, F.raise_error(F.concat(F.lit("value changes as " + kind + ": "), x.cast("string"))).cast(kind)).otherwise(to)


def add_rows(table: DataFrame, rows: DataFrame, key: str | None = None) -> DataFrame:
    """Rows appended by name, nulls where either side lacks a column; with ``key`` new rows without one get the next numbers."""
    if key is None:
        return table.unionByName(rows, allowMissingColumns=True)
    last = table.agg(F.coalesce(F.max(key) + 1, F.lit(0)).alias("_next"))
    rows = rows if key in rows.columns else rows.withColumn(key, F.lit(None).cast("long"))
    numbered = rows.withColumn("_k", F.row_number().over(Window.partitionBy(F.col(key).isNull()).orderBy(F.monotonically_increasing_id())) - 1)  # a few new rows
    numbered = numbered.join(F.broadcast(last)).withColumn(key, F.coalesce(key, (F.col("_next") + F.col("_k")).cast("long"))).drop("_k", "_next")
    return table.unionByName(numbered, allowMissingColumns=True)


def get_rows(table: DataFrame, key: str, wanted: Sequence[int]) -> DataFrame:
    """The rows of some keys, ragged columns (arrays, and arrays of arrays) as they are."""
    return table.where(F.col(key).isin(list(wanted)))


def decode_doubly_ragged(data: Column, inner: Column, outer: Column) -> Column:
    """Slices of slices of a flat array: ``inner`` bounds the data, ``outer`` the inner slices."""
    return decode_ragged(decode_ragged(data, inner), outer)


def with_index(df: DataFrame, column: str, target: str) -> DataFrame:
    """Marks ``column`` as the cumulative index of ``target``."""
    return df.withMetadata(column, {**df.schema[column].metadata, "indexes": target})


def index_of(df: DataFrame, column: str) -> str | None:
    """The column that was marked as index of ``column``, or null."""
    return next((f.name for f in df.schema.fields if f.metadata.get("indexes") == column), None)


def check_heights(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows, failing where array columns of one row differ in length."""
    sizes = F.array(*[F.size(c) for c in columns])
    bad = F.array_max(sizes) != F.array_min(sizes)
    first = columns[0]
    return df.withColumn(first, F.when(bad, F.raise_error(F.lit("columns of different heights")).cast(df.schema[first].dataType)).otherwise(F.col(first)))


def fits_shape(name: str, shapes: Sequence[Sequence[int | None]]) -> Column:
    """Whether a (nested) array has one of the shapes; null stands for any length, and all inner arrays must agree."""

    def fits(x: Column, shape: Sequence[int | None]) -> Column:
        here = F.lit(True) if shape[0] is None else F.size(x) == shape[0]
        return here if len(shape) == 1 else here & F.forall(x, lambda y: fits(y, shape[1:]))

    out = F.lit(False)
    for shape in shapes:
        out = out | fits(F.col(name), shape)
    return F.coalesce(out, F.lit(False))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Struct columns as columns with dotted names, however deep."""
    from pyspark.sql.types import StructType

    def walk(schema: StructType, path: str) -> list[str]:
        out = []
        for f in schema.fields:
            p = f"{path}`{f.name}`"
            out += walk(f.dataType, p + ".") if isinstance(f.dataType, StructType) else [p]
        return out

    return df.select(*[F.col(p).alias(p.replace("`", "").replace(".", sep)) for p in walk(df.schema, "")])


@dataclass
class Dynamic:
    """A table in columns: ``rows`` (id and the columns that have one value a row, and ``<name>_index``, where each row's values of a ragged column end), ``data`` (k, value) of each ragged column, and ``schema``."""

    rows: DataFrame
    data: dict[str, DataFrame]
    schema: str


def to_dynamic(df: DataFrame, order: Sequence[str]) -> Dynamic:
    """A table in columns, its rows in an order; columns of arrays become flat values with cumulative ends.

    Ids and ends are prefix counts over ranges: nothing is sorted or summed in one place. An array that is
    null is stored as an empty one, as the form has no null.
    """
    ragged = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    rows = written(positions(df, order, "id"))
    data = {}
    for name in ragged:
        size = F.greatest(F.lit(0), F.coalesce(F.size(name), F.lit(0))).cast("long")
        rows = running_total(rows, size, f"{name}_index", by=[], order="id").withColumn(f"{name}_index", F.col(f"{name}_index").cast("long"))
    for name in ragged:
        first = F.col(f"{name}_index") - F.size(name)
        data[name] = rows.select(first.alias("_first"), F.posexplode(name).alias("_pos", "value")).select((F.col("_first") + F.col("_pos")).alias("k"), "value")
    return Dynamic(rows.drop(*ragged), data, df.schema.json())


def from_dynamic(table: Dynamic, width: int = 1 << 16) -> DataFrame:
    """The table again, with its columns' order and types; ids are dropped. Values find their row by an as-of join over stretches of ``width`` values."""
    schema = StructType.fromJson(json.loads(table.schema))
    out = table.rows
    for name, data in table.data.items():
        ends = out.where(F.col(f"{name}_index") > 0).groupBy(F.col(f"{name}_index").alias("_end")).agg(F.min("id").alias("_owner"))  # rows without values end where the one before does
        found = asof_join(data.select((F.col("k") + 1).alias("_end"), "k", "value"), ends, t="_end", values=["_owner"], direction="forward", width=width)
        lists = found.groupBy(F.col("_owner").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "value"))), lambda e: e["value"]).alias(name))
        out = out.join(lists, "id", "left").withColumn(name, F.coalesce(name, F.array().cast(schema[name].dataType)))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
