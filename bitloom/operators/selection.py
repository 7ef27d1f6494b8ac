"""Features, exclusion flags and selection of bitext rows.

Input: columns match_id, en, fr, similarity (and any others). All flags are computed in one
projection; only the duplicate mark needs a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitloom.functions import features as X
from bitloom.functions import text as T
from bitloom.operators.terms import unmatched_constraint

RATIOS = tuple(X.TIERS)
FLAGS = ("exclude_low_similarity", *(f"exclude_{r}" for r in RATIOS), "exclude_figtext", "exclude_too_short", "has_date_refs", "OCR_issue")
FILE_FLAGS = ("exclude_figtext", "exclude_too_short", "OCR_issue", "has_number_mismatch", "exclude_wrong_language", "unmatched_lexical_constraints", *(f"exclude_file_{r}" for r in RATIOS))


def _any(columns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(False)) for c in columns])


def with_features(bitext: DataFrame) -> DataFrame:
    en, fr = F.col("en"), F.col("fr")
    return bitext.withColumns({
        "len_ratio": X.len_ratio(fr, en), "clause_ratio": X.clause_ratio(fr, en), "verb_ratio": X.tag_ratio(fr, en, "verbs"), "noun_ratio": X.tag_ratio(fr, en, "nouns"), "entity_ratio": X.tag_ratio(fr, en, "entities"), "OCR_issue": X.ocr_issue(en, fr),
    })


def with_flags(features: DataFrame) -> DataFrame:
    en, fr, similarity = F.col("en"), F.col("fr"), F.nanvl("similarity", F.lit(None).cast("double"))
    return features.withColumns({
        "exclude_low_similarity": similarity < X.LOW,
        **{f"exclude_{r}": X.outside_tier(F.col(r), similarity, r) for r in RATIOS},
        **{f"exclude_relaxed_{r}": ~F.coalesce(F.col(r).between(*X.TIERS[r][2]), F.lit(False)) for r in RATIOS},
        **{f"exclude_file_{r}": ~F.coalesce(F.col(r).between(*X.FILE_BOUNDS[r]), F.lit(False)) for r in RATIOS},
        "exclude_figtext": X.figure_text(en, fr), "exclude_too_short": X.too_short(en, fr), "has_date_refs": X.has_date(en) | X.has_date(fr),
        "has_number_mismatch": X.number_mismatch(en, fr), "exclude_wrong_language": X.wrong_language(en, fr),
    })


def with_selection(flags: DataFrame) -> DataFrame:
    """``exclude`` for training; ``for_test``: excluded, but within the relaxed bounds. So the two
    sets have no row in common. Rows with a null side are in neither."""
    whole = F.col("en").isNotNull() & F.col("fr").isNotNull()
    relaxed = _any((*(f"exclude_relaxed_{r}" for r in RATIOS), "exclude_too_short", "OCR_issue"))
    return flags.withColumn("exclude", _any(FLAGS) | ~whole).withColumn("for_test", whole & F.col("exclude") & ~relaxed)


def training_rows(selected: DataFrame) -> DataFrame:
    return selected.where(~F.col("exclude")).withColumns({"en": T.append_period(F.col("en")), "fr": T.append_period(F.col("fr"))})


def file_selection(bitext: DataFrame, glossary: DataFrame) -> DataFrame:
    """Rows from word-processor files with their flags, ``is_duplicate`` (all but the first of the
    rows otherwise kept that have the same texts) and ``exclude``."""
    flags = with_flags(with_features(bitext))
    unmatched = unmatched_constraint(bitext.select("match_id", "en", "fr"), glossary).withColumn("unmatched_lexical_constraints", F.lit(True))
    flags = flags.join(unmatched, "match_id", "left").withColumn("unmatched_lexical_constraints", F.coalesce("unmatched_lexical_constraints", F.lit(False)))
    rejected = flags.withColumn("__rejected", _any(FILE_FLAGS) | F.col("en").isNull() | F.col("fr").isNull())
    return mark_duplicates(rejected, ~F.col("__rejected")).withColumn("exclude", F.col("__rejected") | F.col("is_duplicate")).drop("__rejected")


def mark_duplicates(rows: DataFrame, kept: Column, order: str = "match_id") -> DataFrame:
    """``is_duplicate`` among the rows where ``kept`` holds. The first row of each pair of texts comes
    from an aggregation (pre-aggregated, so that no text, however frequent, gathers its rows)."""
    firsts = rows.where(kept).groupBy("en", "fr").agg(F.min(order).alias("__first")).select("__first")
    return rows.join(firsts, rows[order] == firsts["__first"], "left").withColumn("is_duplicate", kept & F.col("__first").isNull()).drop("__first")


def log_thresholds(rows: DataFrame, ratios: tuple[str, ...] = RATIOS, deviations: float = 2.0) -> DataFrame:
    """A row per ratio: exp(mean -+ deviations * sd) of its logarithm, and linear statistics, over
    positive finite values."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), F.col(r).alias("v")) for r in ratios])).alias("x")).select("x.*").where("v > 0 and v < double('infinity')")
    stats = long.groupBy("ratio").agg(F.avg(F.ln("v")).alias("m"), F.stddev_samp(F.ln("v")).alias("s"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.count("v").alias("n_rows"))
    return stats.select("ratio", F.round(F.exp(F.col("m") - deviations * F.col("s")), 4).alias("lower"), F.round(F.exp(F.col("m") + deviations * F.col("s")), 4).alias("upper"), F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), F.round("m", 4).alias("log_mean"), F.round("s", 4).alias("log_std"), "n_rows")


def both_directions(rows: DataFrame) -> DataFrame:
    """(source, target, source_lang): each pair from English and from French."""
    pair = F.array(F.struct(F.col("en").alias("source"), F.col("fr").alias("target"), F.lit("en").alias("source_lang")), F.struct(F.col("fr").alias("source"), F.col("en").alias("target"), F.lit("fr").alias("source_lang")))
    return rows.select(F.explode(pair).alias("x")).select("x.*")


def usable_for_tuning(records: DataFrame, only: str | None = None) -> DataFrame:
    """Records with a target that isn't blank, of one source language if ``only`` names it; where there
    is a column ``labels``, only those that have any."""
    kept = records.where(F.trim("target") != "")
    if "labels" in records.columns:
        kept = kept.where(F.size("labels") > 0)
    return kept if only is None else kept.where(F.col("source_lang") == only)


def hash_split(rows: DataFrame, key: str, share: float = 0.05, seed: int = 42) -> DataFrame:
    """``is_validation`` by a digest of ``key``: the same rows for any partitioning."""
    digest = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}"))), 1, 8), 16, 10).cast("long")
    return rows.withColumn("is_validation", digest % 10_000 < int(share * 10_000))


def steps_per_epoch(rows: DataFrame, batch: int, accumulate: int) -> DataFrame:
    return rows.agg(F.ceil(F.count(F.lit(1)) / F.lit(float(batch * accumulate))).cast("long").alias("steps"))


def match_statistics(rows: DataFrame) -> DataFrame:
    """Per document: pairs, different places, similarity; of empty or null similarities null."""
    s = "similarity"
    return rows.groupBy("document_name").agg(F.count(F.lit(1)).alias("n_pairs"), F.count_distinct("idx").alias("n_places"), F.round(F.avg(F.col(s).cast("decimal(12,6)")), 3).cast("double").alias("mean_similarity"), F.min(s).alias("min_similarity"), F.max(s).alias("max_similarity"))


def corpus_summary(statistics: DataFrame) -> DataFrame:
    return statistics.agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n_pairs").alias("n_pairs"), F.round(F.coalesce(F.try_divide(F.sum("n_places") * 100.0, F.sum("n_pairs")), F.lit(0.0)), 1).alias("pct_places"))


def curation_summary(bitext: DataFrame) -> DataFrame:
    """Rows kept, for test and excluded, per source."""
    s = with_selection(with_flags(with_features(bitext)))
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("exclude")).alias("n_train"), F.count_if("for_test").alias("n_test"))


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")
