"""Translation by pluggable models, choice of the best, and quality tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitloom.plans.materialize import checkpointed

NO_TRANSLATION = "[NO VALID TRANSLATIONS]"
#: Widths of the search that are tried in turn.
BEAMS = (4, 6, 8)
QUANTILES = (0.02275, 0.1587, 0.5, 0.8413, 0.97725)
QUANTILE_NAMES = ("p02", "p16", "p50", "p84", "p98")


def stub_model(text: str, beams: int) -> str | None:
    """A deterministic stand-in for a translation model."""
    return f"[TR:{text}]"


def translate(texts: DataFrame, models: dict[str, Callable[[str, int], str | None]], text: str = "text") -> DataFrame:
    """(text, model, model_ord, translated, attempts, valid): each different text once per model.

    Blank texts pass through. An attempt counts if it gives a text; after the last width the original
    stays and isn't valid. The cache is the distinct: equal texts are translated once.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch["text"]:
                for place, (name, model) in enumerate(models.items()):
                    if not t.strip():
                        rows.append((t, name, place, t, 0, True))
                        continue
                    for attempt, beams in enumerate(BEAMS, 1):
                        if (got := model(t, beams)) is not None:
                            rows.append((t, name, place, got, attempt, True))
                            break
                    else:
                        rows.append((t, name, place, t, len(BEAMS), False))
            yield pd.DataFrame(rows, columns=["text", "model", "model_ord", "translated", "attempts", "valid"])

    once = texts.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct()
    return once.mapInPandas(run, "text string, model string, model_ord int, translated string, attempts int, valid boolean")


def best_model(results: DataFrame, key: str, similarity: str = "similarity") -> DataFrame:
    """A row per ``key``: the valid result with the largest similarity, the earliest model of equal
    ones; a missing similarity comes last; without a valid result the sentinel."""
    w = Window.partitionBy(key).orderBy(F.desc("valid"), F.desc_nulls_last(similarity), "model_ord")
    top = results.withColumn("__r", F.row_number().over(w)).where("__r = 1")
    return top.select(key, F.when(F.col("valid"), F.col("translated")).otherwise(NO_TRANSLATION).alias("translated"), F.when(F.col("valid"), F.col("model")).alias("model"))


def best_per_sample(results: DataFrame, keys: list[str], similarity: str, ties: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(similarity), ties)
    return results.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def quantiles(rows: DataFrame, value: str, by: list[str], at: tuple[float, ...]) -> DataFrame:
    """(by, n, q0, q1, ...): exact quantiles of each group, interpolated; null values count for nothing
    and groups without any have no row. Equal values are counted first and the counts summed up along
    ranges, so that no group, however large, gathers its values."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    ranged = checkpointed(counted.repartitionByRange(*by, "__v").withColumn("__p", F.spark_partition_id()))
    # groups and partitions together are this table's rows
    sums = ranged.groupBy(*by, "__p").agg(F.sum("__n").alias("__s"))
    group = Window.partitionBy(*by)
    starts = sums.select(*by, "__p", (F.sum("__s").over(group.orderBy("__p")) - F.col("__s")).alias("__start"), F.sum("__s").over(group).alias("__total"))
    upto = F.col("__start") + F.sum("__n").over(Window.partitionBy(*by, "__p").orderBy("__v"))
    placed = ranged.join(starts, [*by, "__p"]).withColumn("__to", upto).withColumn("__from", F.col("__to") - F.col("__n"))
    here = lambda place: F.max(F.when((F.col("__from") <= place) & (place < F.col("__to")), F.col("__v")))
    place = [q * (F.col("__total") - 1) for q in at]
    found = placed.groupBy(*by).agg(F.max("__total").alias("n"), *[here(F.floor(p)).alias(f"__l{k}") for k, p in enumerate(place)], *[here(F.ceil(p)).alias(f"__h{k}") for k, p in enumerate(place)])
    share = [q * (F.col("n") - 1) - F.floor(q * (F.col("n") - 1)) for q in at]
    return found.select(*by, "n", *[(F.col(f"__l{k}") + (F.col(f"__h{k}") - F.col(f"__l{k}")) * share[k]).alias(f"q{k}") for k in range(len(at))])


def percentiles(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Exact percentiles, interpolated, of each group; groups with a null key are left out."""
    for b in by:
        rows = rows.where(F.col(b).isNotNull())
    found = quantiles(rows, value, by, QUANTILES)
    return found.select(*by, "n", *[F.round(f"q{k}", 3).alias(name) for k, name in enumerate(QUANTILE_NAMES)])


def breakdowns(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
    """(breakdown, key, n, percentiles): each column's groups, in one pass over the rows."""
    keys = F.explode(F.array(*[F.struct(F.lit(b).alias("breakdown"), F.col(b).cast("string").alias("key")) for b in by]))
    return percentiles(rows.select(keys.alias("x"), value).select("x.*", value), value, ["breakdown", "key"])


def sample_rows(rows: DataFrame, key: str, n: int | None, seed: int = 42) -> DataFrame:
    """``n`` rows with the smallest digests of key and seed; all if there are no more or ``n`` is None."""
    return rows if n is None else rows.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}"))), key).limit(n)


def error_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("valid")).alias("n_invalid"), F.sum("attempts").alias("attempts"))


def model_variants(config: DataFrame, finetuned: bool | None = None, names: list[str] | None = None) -> DataFrame:
    """Rows of a table of models (name, is_finetuned), by kind and by name."""
    if finetuned is not None:
        config = config.where(F.col("is_finetuned") == finetuned)
    return config if names is None else config.where(F.col("name").isin(names))
