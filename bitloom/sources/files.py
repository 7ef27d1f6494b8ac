"""Readers of the files that a corpus comes in, and their pairing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom.functions.text import document_of_file

WITHDRAWN = "WITHDRAWN"
REVIEW = "array<struct<location: string, error_type: string, error_text: string, suggested_fix: string, notes: string>>"


def read_correlation(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=None).select("pub_number", "filename_fr", "filename_en")


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of JSON objects, one per file; a file without a text has null there."""
    return spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema("text string").json(path).select(F.input_file_name().alias("path"), "text")


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """(category, french, english) of a JSON glossary: ``translations`` holds a list of entries per
    category, or the entries stand at the top; acronyms give their short and their full forms."""
    raw = spark.read.text(path, wholetext=True)
    body = F.coalesce(F.get_json_object("value", "$.translations"), F.col("value"))
    entry = "map<string, string>"
    lists = raw.select(F.explode(F.from_json(body, "map<string, string>")).alias("category", "content")).where(F.col("content").startswith("["))
    each = lists.select("category", F.explode(F.from_json("content", f"array<{entry}>")).alias("e"))
    get = lambda k: F.nullif(F.trim(F.col("e")[k]), F.lit(""))
    forms = F.explode(F.array(F.struct(F.coalesce(get("french_acronym"), get("french")).alias("french"), F.coalesce(get("english_acronym"), get("english")).alias("english")), F.struct(get("french_full").alias("french"), get("english_full").alias("english"))))
    flat = raw.select(F.explode(F.from_json(body, "map<string, string>")).alias("category", "content")).where(F.col("content").startswith("{")).select("category", F.explode(F.from_json("content", "map<string, string>")).alias("french", "v")).select("category", "french", F.coalesce(F.get_json_object("v", "$.en"), "v").alias("english"))
    return each.select("category", forms.alias("x")).select("category", "x.*").where("french is not null and english is not null").unionByName(flat)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Training records of JSON lines; blank lines are skipped."""
    return spark.read.schema("source string, target string, source_lang string").json(path)


def read_review(spark: SparkSession, path: str) -> DataFrame:
    """Review items of a JSON answer, with or without code fences around it."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", r"\A\s*```[a-z]*\s*|\s*```\s*\z", "").alias("value"))
    return raw.select(F.explode(F.from_json("value", REVIEW)).alias("x")).select("x.*")


def read_review_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True).toDF("location", "error_type", "error_text", "suggested_fix", "notes")


def place_names(spark: SparkSession, path: str) -> DataFrame:
    """(french, english) of a CSV, both given and different."""
    return spark.read.csv(path, header=True).select(F.trim("french").alias("french"), F.trim("english").alias("english")).where("french <> '' and english <> '' and french <> english")


def publication_files(correlation: DataFrame, pub_number: str) -> DataFrame:
    """The file names of one publication, the first listed."""
    return correlation.where(F.col("pub_number") == pub_number).orderBy("listed_at", "filename_fr", "filename_en").limit(1).select("filename_fr", "filename_en")


def usable_pairs(correlation: DataFrame) -> DataFrame:
    """(pub_number, filename_fr, filename_en): the latest listing of each publication, unless it is
    withdrawn on both sides or lacks a name."""
    last = correlation.groupBy("pub_number").agg(F.max(F.struct("listed_at", "filename_fr", "filename_en")).alias("x")).select("pub_number", "x.filename_fr", "x.filename_en")
    return last.where(~((F.col("filename_fr") == WITHDRAWN) & (F.col("filename_en") == WITHDRAWN)) & F.col("filename_fr").isNotNull() & F.col("filename_en").isNotNull())


def join_files(pairs: DataFrame, files: DataFrame) -> DataFrame:
    """Pairs with the paths of both parsed files (name + '.json'); ``files``: a column path."""
    named = files.select("path", F.regexp_extract("path", r"([^/]+)\.json\z", 1).alias("__name")).where("__name <> ''").groupBy("__name").agg(F.min("path").alias("path"))
    left = pairs.join(named.withColumnsRenamed({"__name": "filename_fr", "path": "path_fr"}), "filename_fr", "left")
    return left.join(named.withColumnsRenamed({"__name": "filename_en", "path": "path_en"}), "filename_en", "left").where("path_fr is not null and path_en is not null")


def pair_documents(files: DataFrame, regions: list[str] | None = None) -> DataFrame:
    """(document_name, region, path_fr, path_en): files of one document, paired by name; a pair of
    errata counts before the normal pair. Lock files and files of no language are left out."""
    named = files.withColumns({"__stem": F.regexp_extract("path", r"([^/]+)\.[^./]+\z", 1), "region": F.regexp_extract("path", r"([^/]+)/[^/]+\z", 1)}).where(~F.col("__stem").startswith("~$"))
    if regions is not None:
        named = named.where(F.col("region").isin(regions))
    x = named.select("path", "region", document_of_file(F.col("__stem")).alias("d")).select("path", "region", "d.*").where("lang is not null")
    pick = lambda lang, e: F.max(F.when((F.col("lang") == lang) & (F.col("is_erratum") == e), F.col("path")))
    g = x.groupBy("document_name").agg(F.min("region").alias("region"), pick("fr", True).alias("fe"), pick("en", True).alias("ee"), pick("fr", False).alias("fn"), pick("en", False).alias("en_"))
    errata = F.col("fe").isNotNull() & F.col("ee").isNotNull()
    return g.select("document_name", "region", F.when(errata, F.col("fe")).otherwise(F.col("fn")).alias("path_fr"), F.when(errata, F.col("ee")).otherwise(F.col("en_")).alias("path_en")).where("path_fr is not null and path_en is not null")


def gated_documents(sentences: DataFrame, least: int = 1000) -> DataFrame:
    """(document_name, en_chars, fr_chars): documents (document_name, en, fr) whose sides both have at
    least so many characters; rows without a name belong to none."""
    sides = sentences.where("document_name is not null").groupBy("document_name").agg(F.sum(F.coalesce(F.length("en"), F.lit(0))).alias("en_chars"), F.sum(F.coalesce(F.length("fr"), F.lit(0))).alias("fr_chars"))
    return sides.where((F.col("en_chars") >= least) & (F.col("fr_chars") >= least))
