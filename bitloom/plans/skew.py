"""Joins of many rows with a table of unique keys where a few keys hold much of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.plans.materialize import checkpointed

#: A key is hot if it holds more than one in this many rows; so there are at most this many hot keys.
HOT_SHARE = 500


def lookup(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups`` (one row per ``keys``, its number of rows in ``size``).

    Keys that hold more than 1/HOT_SHARE of all rows are salted: ``groups`` repeats such a key once
    per salt, ``rows`` spread over the salts by the hash of ``spread``. The list of hot keys that is
    broadcast has at most HOT_SHARE rows whatever the size of the input.
    Null keys match nothing (``how='left'`` keeps their rows). ``size`` is dropped from the result.
    """
    groups = checkpointed(groups)
    total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(total // HOT_SHARE, 1)
    hot = groups.where(F.col(size) > least).select(*keys, F.ceil(F.col(size) / least).cast("int").alias("__salts"))
    salted = (
        groups.withColumn("__salts", F.when(F.col(size) > least, F.ceil(F.col(size) / least)).otherwise(1).cast("int"))
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
        .drop("__salts", size)
    )
    placed = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.when(F.col("__salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.col("__salts"))).cast("int")).drop("__salts")
    return placed.join(salted, [*keys, "__salt"], how).drop("__salt")
