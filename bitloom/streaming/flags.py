"""The row-wise flags on streams, and duplicates within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.operators.selection import with_features, with_flags, with_selection


def select_stream(bitext: DataFrame) -> DataFrame:
    """Flags and selection of a stream of bitext: the same expressions, without state."""
    return with_selection(with_flags(with_features(bitext)))


def first_copies(bitext: DataFrame, time: str, delay: str = "1 hour") -> DataFrame:
    """The first of equal pairs that arrive within ``delay``; state of older pairs is dropped. A
    timestamp without zone is taken as UTC, as watermarks need one."""
    return bitext.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(["en", "fr"])


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"))
