"""Building a glossary from table terms (columns row_id, en, fr, count)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitloom.functions import text as T

#: Abbreviations of provinces that are no terms.
PROVINCES = (("NS", "NÉ"), ("NS", "N.-É."), ("NB", "N.-B."), ("PE", "ÎPÉ"), ("PE", "Î.-P.-É."), ("NL", "T.-N.-L."))


def consolidated(terms: DataFrame) -> DataFrame:
    """A row per ``en``: the ``fr`` with the largest summed count (the first seen of equal ones), that
    sum, and the other forms. Rows with a blank side are left out; null counts are none."""
    pairs = terms.where(F.trim("en") != "").where(F.trim("fr") != "").groupBy("en", "fr").agg(F.sum(F.coalesce("count", F.lit(0))).alias("count"), F.min("row_id").alias("first"))
    best = F.max_by(F.struct("fr", "count", "first"), F.struct("count", (-F.col("first")).alias("f")))
    return pairs.groupBy("en").agg(best.alias("b"), F.array_sort(F.collect_list("fr")).alias("all")).select("en", F.col("b.fr").alias("fr"), F.col("b.count").alias("count"), F.array_remove("all", F.col("b.fr")).alias("fr_variants"), F.col("b.first").alias("first"))


def dash_aligned(entries: DataFrame) -> DataFrame:
    """Terms with dashes take the French of the same term without any, where that exists."""
    bare = entries.where(~F.col("en").contains("-")).select(F.col("en").alias("__bare"), F.col("fr").alias("__fr"))
    return entries.withColumn("__bare", F.when(F.col("en").contains("-"), F.replace(F.col("en"), F.lit("-"), F.lit("")))).join(bare, "__bare", "left").withColumn("fr", F.coalesce("__fr", "fr")).drop("__bare", "__fr")


def without_junk(entries: DataFrame) -> DataFrame:
    """No provinces, single characters, rare short terms, or terms that are the same in both."""
    en, fr = T.without_markup(F.regexp_replace("en", ",+$", "")), T.without_markup(F.regexp_replace("fr", ",+$", ""))
    province = F.lit(False)
    for a, b in PROVINCES:
        province = province | ((en == a) & (fr == b))
    return entries.where(~(province | ((F.length(en) == 1) & (F.length(fr) == 1)) | ((F.col("count") < 3) & (F.length(en) <= 2)) | (F.lower(en) == F.lower(fr))))


def case_merged(entries: DataFrame) -> DataFrame:
    """Entries whose ``en`` differ in case only are merged if their ``fr`` do too: the one counted
    most, with the sum of counts; others stay."""
    w = Window.partitionBy(F.lower("en"))
    marked = entries.withColumns({"__n": F.count(F.lit(1)).over(w), "__one": F.size(F.collect_set(F.lower("fr")).over(w)) == 1})
    alone = marked.where(~(F.col("__one") & (F.col("__n") > 1))).select("en", "fr", "count", F.array().cast("array<string>").alias("case_variants"))
    group = marked.where(F.col("__one") & (F.col("__n") > 1)).groupBy(F.lower("en").alias("k"))
    merged = group.agg(F.max_by(F.struct("en", "fr"), F.struct("count", (-F.col("first")).alias("f"))).alias("b"), F.sum("count").alias("count"), F.array_sort(F.collect_set("en")).alias("all"))
    return alone.unionByName(merged.select("b.en", "b.fr", "count", F.array_remove("all", F.col("b.en")).alias("case_variants")))


def sub_parts(entries: DataFrame) -> DataFrame:
    """(en_part, fr_part, count): the i-th marked-up parts of both sides, with the largest count of
    the entries they come from. Numbers, equal parts and single characters are left out."""
    def zipped(pattern: str):
        pick = lambda c: F.regexp_extract_all(F.col(c), F.lit(pattern), F.lit(1))
        n = F.least(F.size(pick("en")), F.size(pick("fr")))
        return F.when(n > 0, F.zip_with(F.slice(pick("en"), 1, n), F.slice(pick("fr"), 1, n), lambda a, b: F.struct(F.regexp_replace(a, "/([^/]+)/", "$1").alias("en_part"), F.regexp_replace(b, "/([^/]+)/", "$1").alias("fr_part")))).otherwise(F.array().cast("array<struct<en_part: string, fr_part: string>>"))

    parts = entries.select("count", F.explode(F.concat(zipped("/([^/]+)/"), zipped(r"_\{([^}]*)\}"), zipped(r"\^\{([^}]*)\}"))).alias("x")).select("x.*", "count")
    kept = parts.where(~F.col("en_part").rlike("^[0-9.±]+$") & (F.lower("en_part") != F.lower("fr_part")) & ~((F.length("en_part") == 1) & (F.length("fr_part") == 1)))
    return kept.groupBy("en_part", "fr_part").agg(F.max("count").alias("count"))


def table_glossary(terms: DataFrame) -> DataFrame:
    """(en, fr, count, is_part): the whole pipeline; parts only where their English is no entry."""
    entries = case_merged(without_junk(dash_aligned(consolidated(terms))))
    keys = entries.select(F.lower("en").alias("k"))
    parts = sub_parts(entries).withColumn("k", F.lower("en_part")).join(keys, "k", "left_anti")
    return entries.select("en", "fr", "count", F.lit(False).alias("is_part")).unionByName(parts.select(F.col("en_part").alias("en"), F.col("fr_part").alias("fr"), "count", F.lit(True).alias("is_part")))


def category_counts(glossary: DataFrame) -> DataFrame:
    """Entries per category, and of all in the row 'total'."""
    return glossary.rollup("category").agg(F.count(F.lit(1)).alias("n"), F.grouping("category").alias("g")).select(F.when(F.col("g") == 1, "total").otherwise(F.col("category")).alias("category"), "n")
