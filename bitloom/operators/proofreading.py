"""Proofreading of translations: prompts with terms, punctuation rules, repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.functions import features as X
from bitloom.operators import terms

LEAST = 3


def prompts(texts: DataFrame, glossary: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(key, prompt): what a reviewer is told, with the preferred terms that the text holds. Terms of
    fewer than LEAST characters on either side are left out; a null text has no terms."""
    held = terms.checklist(texts, glossary, key, text, lang).where((F.length("term") >= LEAST) & (F.length("other") >= LEAST))
    lines = held.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- "), "term", F.lit(" -> "), "other"))), "\n").alias("lines"))
    start = F.concat(F.lit("Review the translation of "), F.col(key).cast("string"), F.lit(" by the instructions."))
    full = F.when(F.col("lines").isNull(), start).otherwise(F.concat(start, F.lit("\n\nPreferred terms:\n"), "lines"))
    return texts.select(key).distinct().join(lines, key, "left").select(key, full.alias("prompt"))


def punctuation_changes(texts: DataFrame, text: Column, lang: str) -> DataFrame:
    """(lang, n_texts, n_changed): texts that the spacing rules of ``lang`` change."""
    changed = X.punctuation_spacing(text, lang) != text
    return texts.where(text.isNotNull()).agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(changed).alias("n_changed")).select(F.lit(lang).alias("lang"), "n_texts", "n_changed")


def fix_formatting(texts: DataFrame, glossary: DataFrame, key: str, text: str, source_lang: str, lang: str) -> DataFrame:
    """(key, fixed, terms_changed, punctuation_changed): terms left in the source's language replaced,
    then the spacing rules of ``lang``."""
    replaced = terms.replace_terms(texts, glossary, key, text, source_lang, LEAST).join(texts.select(key, F.col(text).alias("before")), key)
    spaced = X.punctuation_spacing(F.col("replaced"), lang)
    return replaced.select(key, spaced.alias("fixed"), (F.col("replaced") != F.col("before")).alias("terms_changed"), (spaced != F.col("replaced")).alias("punctuation_changed"))
