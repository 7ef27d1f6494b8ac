"""Leaving out rows that a join would drop, before they are shuffled for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.plans.materialize import checkpointed

#: Cells of 64 bits: a filter has at most this many rows (about 20 MB) whatever the number of keys. The
#: more keys there are, the fewer rows it leaves out; it never leaves out one that has a partner.
CELLS = 1 << 19


def _place(key: Column) -> tuple[Column, Column]:
    h = F.xxhash64(key, F.lit(17))
    return F.shiftrightunsigned(h, 6) % CELLS, h.bitwiseAND(F.lit(63)).cast("int")


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """The filter of the keys in column ``key``: (__cell, __bits) of each cell that has any."""
    cell, bit = _place(F.col(key))
    return checkpointed(keys.where(F.col(key).isNotNull()).select(cell.alias("__cell"), _bit(bit).alias("b")).groupBy("__cell").agg(F.bit_or("b").alias("__bits")))


def pruned(rows: DataFrame, key: str, of: DataFrame) -> DataFrame:
    """Rows of ``rows`` whose ``key`` may be among the keys of the filter ``of``; null keys are not."""
    cell, bit = _place(F.col(key))
    hit = rows.where(F.col(key).isNotNull()).withColumn("__cell", cell).join(F.broadcast(of), "__cell").where(F.col("__bits").bitwiseAND(_bit(bit)) != 0)
    return hit.select(*rows.columns)
