"""Bounded samples that models are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_STEPS = 1 << 24


def samples(df: DataFrame, wanted: dict[str, tuple[Column, int]]) -> dict[str, list[str]]:
    """Texts by name: of each column in ``wanted`` (null where a row has none) at most so many texts,
    those with the smallest hashes, the same for any order of rows. Two passes over ``df`` serve all
    names. From large tables only texts below a hash that leaves about four times as many are sorted,
    so that what reaches one place doesn't grow with the table."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), text.alias("text")) for name, (text, _) in wanted.items()]))
    texts = df.select(each.alias("x")).select("x.*").where(F.col("text").isNotNull())
    below = F.lit(_STEPS)
    for r in texts.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect():
        most = wanted[r["name"]][1]
        if r["n"] > 8 * most:
            below = F.when(F.col("name") == r["name"], int(4 * most / r["n"] * _STEPS) + 1).otherwise(below)
    few = texts.where(F.pmod(F.xxhash64("text"), F.lit(_STEPS)) <= below)
    first = F.row_number().over(Window.partitionBy("name").orderBy(F.xxhash64("text"), "text"))
    most = F.lit(0)
    for name, (_, n) in wanted.items():
        most = F.when(F.col("name") == name, n).otherwise(most)
    out: dict[str, list[str]] = {name: [] for name in wanted}
    for r in few.withColumn("r", first).where(F.col("r") <= max(n for _, n in wanted.values())).where(F.col("r") <= most).orderBy("name", "r").collect():
        out[r["name"]].append(r["text"])
    return out


def smallest(df: DataFrame, columns: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of ``df``, those with the smallest hashes of ``columns``: the same for
    any order of rows. From large tables only the rows below a hash that leaves about four times as
    many are sorted, so that what reaches one place doesn't grow with the table."""
    n = df.count()
    hashed = F.pmod(F.xxhash64(*columns), F.lit(_STEPS))
    if n > 8 * most:
        df = df.where(hashed <= int(4 * most / n * _STEPS) + 1)
    return df.orderBy(F.xxhash64(*columns), *columns).limit(most)
