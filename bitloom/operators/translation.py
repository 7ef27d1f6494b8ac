"""Translation of texts with preferred terms and labels, its validation, and rows for its evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitloom.functions import text as T
from bitloom.operators import terms
from bitloom.operators.evaluation import BEAMS, stub_model

Model = Callable[[str, int], str | None]


def _attempt(model: Model, text: str, good: Callable[[str | None], bool]) -> tuple[str | None, int]:
    for n, beams in enumerate(BEAMS, 1):
        if good(got := model(text, beams)):
            return got, n
    return None, len(BEAMS)


def has_prefix_error(translated: str, original: str) -> bool:
    return any(p in translated and p not in original for p in terms.PREFIXES)


def is_valid(translated: str | None, original: str, mapping: list[dict]) -> bool:
    """A translation is there, holds no token's prefix that the original lacks, and every token."""
    return translated is not None and not has_prefix_error(translated, original) and all(terms.find_token(translated, m["token"])[0] for m in mapping)


def translate_texts(texts: DataFrame, glossary: DataFrame, key: str, text: str, lang: str, model: Model = stub_model, use_terms: bool = True) -> DataFrame:
    """(key, translated_text, find_replace_error, token_prefix_error, attempts) of every text.

    Terms become tokens; if the translation of these is valid, they become preferred translations;
    else the text itself is translated and ``find_replace_error`` set. Blank texts pass through; a
    text without any translation stays as it is. Null stays null.
    """
    rows = terms.substitute_terms(texts, glossary if use_terms else glossary.limit(0), key, text, lang).join(texts.select(key, F.col(text).alias("original")), key)
    kinds = f"{key} {dict(texts.dtypes)[key]}, translated_text string, find_replace_error boolean, token_prefix_error boolean, attempts int"

    def one(original: str, tokenised: str, mapping: list[dict]) -> tuple[str, bool, bool, int]:
        if not original.strip():
            return original, False, False, 0
        got, n = _attempt(model, tokenised, lambda t: is_valid(t, tokenised, mapping))
        if got is not None:
            back = terms.restore(got, mapping)
            if not any(m["token"] in back for m in mapping):
                return back, False, False, n
        raw, n = _attempt(model, original, lambda t: t is not None)
        raw = original if raw is None else raw
        return raw, bool(mapping), has_prefix_error(raw, original), n

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = [(None, False, False, 0) if o is None else one(o, t, list(m)) for o, t, m in zip(b["original"], b["tokenised"], b["mapping"], strict=True)]
            yield pd.DataFrame([(k, *d) for k, d in zip(b[key], done, strict=True)], columns=[key, "translated_text", "find_replace_error", "token_prefix_error", "attempts"])

    return rows.mapInPandas(work, kinds)


def same_mappings(a: Column, b: Column) -> Column:
    """Whether two mappings hold the same tokens for the same texts, in any order."""
    return F.array_sort(a) == F.array_sort(b)


def person_names(text: Column, lang: Column, recognise: Callable[[Column, Column], Column] | None = None) -> Column:
    """array of struct(start, end, text), last first. The seam for a recogniser; without one, and in
    other languages than en and fr, there are none."""
    none = F.array().cast("array<struct<start: int, end: int, text: string>>")
    return none if recognise is None else F.when(lang.isin("en", "fr"), F.reverse(F.array_sort(recognise(text, lang)))).otherwise(none)


def if_enabled(text: Column, replaced: Column, enabled: bool) -> Column:
    return replaced if enabled else text


def if_restored(restored: Column, all_replaced: Column) -> Column:
    """The restored text; null where a token is left."""
    return F.when(all_replaced, restored)


def labelled(texts: Column, translated: Callable[[Column], Column]) -> Column:
    """Text whose sentences, or label and rest of a caption, are translated one by one and put
    together again as they were. ``translated`` makes the translation of a sentence."""

    def chunk(c: Column) -> Column:
        parts = T.label_prefix(c["text"])
        both = F.concat_ws(" ", T.ensure_label_period(translated(parts["label"])), F.ltrim(translated(parts["rest"])))
        done = F.when(c["text"] == "", "").when(parts["label"].isNotNull() & (F.trim(parts["rest"]) != ""), both).otherwise(translated(c["text"]))
        return c.withField("text", done)

    return T.straight_apostrophes(T.reassemble(F.transform(T.sentence_chunks(texts), chunk)))


def chunk_index(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, chunk_idx, chunk): chunks to be translated, numbered within each text."""
    each = texts.select(key, F.explode(T.sentence_chunks(F.col(text))).alias("c")).where("not c.is_empty")
    place = F.row_number().over(Window.partitionBy(key).orderBy("c.line_idx", "c.sent_idx")) - 1
    return each.select(key, place.alias("chunk_idx"), F.col("c.text").alias("chunk"))


def evaluation_rows(samples: DataFrame, translated: dict[str, Column], options: tuple[bool, ...] = (False, True)) -> DataFrame:
    """(sample_idx, source_text, translator, use_find_replace, translated_text): of each sample
    (sample_idx, source_text, target_text) the human translation and those of every model with
    every option. ``translated``: the translation by each model."""
    human = F.struct(F.lit("human").alias("translator"), F.lit(None).cast("boolean").alias("use_find_replace"), F.col("target_text").alias("translated_text"))
    others = [F.struct(F.lit(name).alias("translator"), F.lit(o).alias("use_find_replace"), made.alias("translated_text")) for name, made in translated.items() for o in options]
    return samples.select("sample_idx", "source_text", F.explode(F.array(human, *others)).alias("x")).select("sample_idx", "source_text", "x.*")


def best_by_configuration(results: DataFrame) -> DataFrame:
    """``results`` (sample_idx, use_find_replace, gender_fix, translator, similarity) and, of each sample
    and configuration, the most similar one again as 'best_model', the first translator of equal ones;
    missing similarities come last. Rows without a configuration have no best."""
    w = Window.partitionBy("sample_idx", "use_find_replace", "gender_fix").orderBy(F.desc_nulls_last("similarity"), "translator")
    best = results.where("use_find_replace is not null and gender_fix is not null").withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    name = F.concat(F.lit("best_model_"), F.when(F.col("gender_fix"), "genderfix").otherwise("genderdefault"), F.when(F.col("use_find_replace"), "_preferential").otherwise("_unreplaced"))
    return results.withColumn("details", F.lit(None).cast("string")).unionByName(best.withColumns({"details": name, "translator": F.lit("best_model")}))
