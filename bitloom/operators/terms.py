"""Preferred terms: matching, checking and substitution.

A glossary has the columns category, french, english. Whole-word matches are found without a nested
loop: the longest word of a term is its anchor; the distinct words of a text are joined with the
anchors, and the few candidates verified by the term's own pattern.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Glossary rows and characters up to which the anchors are broadcast; beyond that they are shuffled.
BROADCAST_ROWS, BROADCAST_CHARS = 100_000, 8_000_000
CASE_SENSITIVE = ("acronym", "table")
PREFIXES = ("NOMENCLATURE", "TAXON", "ACRONYM", "SITE", "NAME")


def normalised(glossary: DataFrame) -> DataFrame:
    """Trimmed terms with both sides, each pair of a category once (cases count as different)."""
    return glossary.select("category", F.trim("french").alias("french"), F.trim("english").alias("english")).where("french <> '' and english <> ''").distinct()


def term_pairs(glossary: DataFrame, least: int = 2) -> DataFrame:
    """(category, lang, term, other): both directions."""
    both = F.array(F.struct(F.lit("en").alias("lang"), F.col("english").alias("term"), F.col("french").alias("other")), F.struct(F.lit("fr").alias("lang"), F.col("french").alias("term"), F.col("english").alias("other")))
    return normalised(glossary).select("category", F.explode(both).alias("x")).select("category", "x.*").where(F.length("term") >= least)


def _pattern(term: Column, sensitive: Column) -> Column:
    quoted = F.regexp_replace(term, r"([\\.^$|?*+()\[\]{}])", r"\\$1")
    return F.concat(F.when(sensitive, r"(?U)\b").otherwise(r"(?iuU)\b"), quoted, F.lit(r"\b"))


def _runs(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)([\p{L}\p{N}_]+)"), F.lit(1)))


def _anchor(term: Column) -> Column:
    """The longest run of word characters, the first of equally long ones."""
    runs = F.regexp_extract_all(F.lower(term), F.lit(r"(?U)([\p{L}\p{N}_]+)"), F.lit(1))
    return F.array_max(F.transform(runs, lambda w, i: F.struct(F.length(w).alias("n"), (-i).alias("i"), w.alias("w"))))["w"]


def matches(texts: DataFrame, terms: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term columns): each term that stands as whole words in each text, once per text.

    ``terms``: columns term, category and others. A term without word characters matches nothing.
    """
    anchored = terms.withColumn("__anchor", _anchor(F.col("term"))).where("__anchor is not null")
    given = texts.where(F.col(text).isNotNull())
    if _is_small(anchored):
        words = given.select(key, F.col(text).alias("__text"), F.explode(_runs(F.col(text))).alias("__anchor"))
        found = words.join(F.broadcast(anchored), "__anchor")
    else:  # only words are shuffled; what they hit gets its text afterwards
        words = given.select(key, F.explode(_runs(F.col(text))).alias("__anchor")).distinct()
        found = words.join(anchored, "__anchor").join(given.select(key, F.col(text).alias("__text")), key)
    return found.where(F.rlike("__text", _pattern(F.col("term"), F.col("category").isin(*CASE_SENSITIVE)))).drop("__anchor", "__text")


def _is_small(terms: DataFrame) -> bool:
    """Whether terms (columns of text) may be broadcast."""
    chars = [F.coalesce(F.length(c), F.lit(0)) for c, kind in terms.dtypes if kind == "string"]
    n, size = terms.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), F.sum(sum(chars, F.lit(0)))).first()
    return n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_CHARS


def unmatched_constraint(bitext: DataFrame, glossary: DataFrame) -> DataFrame:
    """match_id of rows where a term stands on one side and its translation not on the other. Sites
    are no constraints; a row with a null side is none either."""
    pairs = term_pairs(glossary.where("category <> 'site'"))
    whole = bitext.where("en is not null and fr is not null")
    small = F.broadcast if _is_small(pairs) else (lambda d: d)
    sides = whole.select("match_id", F.explode(F.array(F.struct(F.lit("en").alias("lang"), F.col("en").alias("here"), F.col("fr").alias("there")), F.struct(F.lit("fr").alias("lang"), F.col("fr").alias("here"), F.col("en").alias("there")))).alias("x")).select("match_id", "x.*")
    words = sides.select("match_id", "lang", "here", "there", F.explode(_runs(F.col("here"))).alias("__anchor"))
    sensitive = F.col("category").isin(*CASE_SENSITIVE)
    anchored = pairs.withColumn("__anchor", _anchor(F.col("term"))).where("__anchor is not null")
    hit = words.join(small(anchored), ["lang", "__anchor"]).where(F.rlike("here", _pattern(F.col("term"), sensitive)) & ~F.rlike("there", _pattern(F.col("other"), sensitive)))
    return hit.select("match_id").distinct()


def checklist(texts: DataFrame, glossary: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(key, term, other): preferred translations to check in each text, cases aside."""
    return matches(texts, term_pairs(glossary).where(F.col("lang") == lang).withColumn("category", F.lit("any")).distinct(), key, text).select(key, "term", "other").distinct()


def sub_glossary(texts: DataFrame, glossary: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """Terms that stand in any of the texts."""
    return checklist(texts, glossary, key, text, lang).select("term", "other").distinct()


def absent_translations(rows: DataFrame, glossary: DataFrame) -> DataFrame:
    """(match_id, term, other): checklist items whose preferred French is absent from the row's French
    side; a null side is an empty one."""
    items = checklist(rows, glossary, "match_id", "en", "en")
    return items.join(rows.select("match_id", F.coalesce("fr", F.lit("")).alias("there")), "match_id").where(~F.rlike("there", _pattern(F.col("other"), F.lit(False)))).drop("there")


def substring_matches(rows: DataFrame, glossary: DataFrame) -> DataFrame:
    """(match_id, french, english): terms that both sides hold as they are written, as substrings. The
    anchor join finds whole inner words only, so terms are matched by their first three letters."""
    terms = normalised(glossary).where("length(english) >= 3").withColumn("__gram", F.substring("english", 1, 3)).drop("category").distinct()
    small = F.broadcast if _is_small(terms) else (lambda d: d)
    grams = rows.where("en is not null and fr is not null").select("match_id", "en", "fr", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("en") - 2, F.lit(1))), lambda i: F.col("en").substr(i, F.lit(3))))).alias("__gram"))
    return grams.join(small(terms), "__gram").where(F.col("en").contains(F.col("english")) & F.col("fr").contains(F.col("french"))).select("match_id", "french", "english").distinct()


def two_way_index(glossary: DataFrame) -> DataFrame:
    """(lang, key, category, french, english): lower-case keys of both languages; of equal keys the
    last by category and term stays."""
    g = normalised(glossary)
    both = g.select(F.lit("fr").alias("lang"), F.lower("french").alias("key"), "category", "french", "english").unionByName(g.select(F.lit("en").alias("lang"), F.lower("english").alias("key"), "category", "french", "english"))
    return both.groupBy("lang", "key").agg(F.max(F.struct("category", "french", "english")).alias("x")).select("lang", "key", "x.*")


def search_patterns(glossary: DataFrame, lang: str = "fr") -> DataFrame:
    """(category, term, place): terms longest first within their category."""
    terms = term_pairs(glossary, 1).where(F.col("lang") == lang).select("category", "term").distinct()
    return terms.withColumn("place", F.row_number().over(Window.partitionBy("category").orderBy(F.desc(F.length("term")), "term")))


def cell_routes(cells: DataFrame, table_terms: DataFrame, glossary: DataFrame, source_lang: str = "en", least: int = 20) -> DataFrame:
    """(row_id, expected, route): number, table entry, preferred term, model, or unchanged, in this
    order. ``table_terms``: columns en, fr, row_id; the first entry of a cell text counts."""
    from bitloom.functions.features import convert_numeric, is_numeric

    own, other = ("en", "fr") if source_lang == "en" else ("fr", "en")
    entries = table_terms.where(f"{own} is not null and {other} is not null").groupBy(F.trim(own).alias("__cell")).agg(F.min_by(other, "row_id").alias("__entry"))
    preferred = normalised(glossary).groupBy(F.lower("french").alias("__low")).agg(F.min(F.struct("category", "french", "english")).alias("g")).select("__low", F.col("g.english" if source_lang == "en" else "g.french").alias("__preferred"))
    text = F.trim("text")
    joined = cells.select("row_id", text.alias("text")).withColumns({"__cell": F.col("text"), "__low": F.lower("text")}).join(entries, "__cell", "left").join(preferred, "__low", "left")
    numeric = is_numeric(F.col("text"))
    capital = F.col("text").rlike("^[A-ZÀ-Þ]")
    carried = F.when(capital, F.concat(F.upper(F.substring("__preferred", 1, 1)), F.col("__preferred").substr(F.lit(2), F.length("__preferred")))).otherwise(F.col("__preferred"))
    route = F.when(numeric, "numeric").when(F.col("__entry").isNotNull(), "table").when(F.col("__preferred").isNotNull(), "preferred").when(F.length("text") >= least, "model").otherwise("unchanged")
    value = F.when(numeric, convert_numeric(F.col("text"), source_lang == "en")).otherwise(F.coalesce("__entry", carried, "text"))
    return joined.select("row_id", value.alias("expected"), route.alias("route"))


# Substitution of terms by tokens and back: order matters within a text, so each is one fold.

MAPPING = "array<struct<token: string, original_text: string, category: string, translation: string>>"


def _tokenise(text: str, terms: list[tuple[str, str, str]]) -> tuple[str, list[tuple]]:
    """Terms, longest first within each category, numbered from the last occurrence to the first."""
    mapping, counters = [], {}
    for category, term, other in terms:
        quoted = re.escape(term)
        pattern = re.compile(quoted if " " in term else rf"\b{quoted}\b", re.IGNORECASE)
        for m in reversed(list(pattern.finditer(text))):
            counters[category] = n = counters.get(category, 0) + 1
            name = f"{category.upper()}{n:04d}"
            mapping.append((name, m.group(), category, other))
            text = text[: m.start()] + name + text[m.end() :]
    return text, mapping


def substitute_terms(texts: DataFrame, glossary: DataFrame, key: str, text: str, lang: str = "fr") -> DataFrame:
    """(key, tokenised, mapping). Only the terms that a text holds are sent along with it."""
    terms = term_pairs(glossary).where(F.col("lang") == lang)
    held = matches(texts, terms, key, text).groupBy(key).agg(F.array_sort(F.collect_set(F.struct("category", (-F.length("term")).alias("n"), "term", "other"))).alias("terms"))
    rows = texts.select(key, F.col(text).alias("text")).join(held, key, "left")

    def replace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, t, ts in zip(batch[key], batch["text"], batch["terms"], strict=True):
                if t is None:
                    out.append((k, None, []))
                else:
                    done = _tokenise(t, [(x["category"], x["term"], x["other"]) for x in ts]) if ts is not None else (t, [])
                    out.append((k, done[0], [dict(zip(("token", "original_text", "category", "translation"), x, strict=True)) for x in done[1]]))
            yield pd.DataFrame(out, columns=[key, "tokenised", "mapping"])

    return rows.mapInPandas(replace, f"{key} {dict(texts.dtypes)[key]}, tokenised string, mapping {MAPPING}")


def find_token(text: str, token: str) -> tuple[bool, int, str]:
    """Whether, where and in which form a token stands: exact, with spaces inside, or with a plural."""
    prefix, digits = re.match(r"([A-Z]+)(\d+)\Z", token).groups() if re.match(r"[A-Z]+\d+\Z", token) else (token, "")
    for pattern in (rf"\b{re.escape(token)}\b", rf"\b{prefix}\s+{digits}\b" if digits else r"(?!)", rf"\b{re.escape(token)}e?s\b"):
        if m := re.search(pattern, text):
            return True, m.start(), m.group()
    return False, -1, ""


def restore(text: str, mapping: list[dict]) -> str:
    """Tokens replaced by their translations with the capitals of the original."""
    for entry in mapping:
        found, at, form = find_token(text, entry["token"])
        if not found:
            continue
        original, new = entry["original_text"], entry["translation"] or entry["original_text"]
        before = text[:at].rstrip()
        if original.isupper():
            new = new.upper()
        elif not before or before[-1] in ".!?":
            new = new[:1].upper() + new[1:]
        elif original.islower():
            new = new.lower()
        text = text[:at] + new + text[at + len(form) :]
    return text


def restore_terms(rows: DataFrame, key: str) -> DataFrame:
    """(key, restored, all_replaced) from columns tokenised and mapping; null text stays null."""
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [None if t is None else restore(t, list(m)) for t, m in zip(batch["tokenised"], batch["mapping"], strict=True)]
            yield pd.DataFrame({key: batch[key], "restored": done, "all_replaced": [t is not None and all(e["token"] not in t for e in m) for t, m in zip(done, batch["mapping"], strict=True)]})

    return rows.select(key, "tokenised", "mapping").mapInPandas(fold, f"{key} {dict(rows.dtypes)[key]}, restored string, all_replaced boolean")


def prefix_error(translated: Column, original: Column) -> Column:
    """Whether the translation holds the prefix of a token that the original lacks; null is an error."""
    error = F.lit(False)
    for p in PREFIXES:
        error = error | (translated.contains(p) & ~F.coalesce(original, F.lit("")).contains(p))
    return translated.isNull() | error


def missing_tokens(rows: DataFrame, key: str, translated: str) -> DataFrame:
    """A row per token of ``mapping`` that is absent from the translation."""
    return rows.select(key, translated, F.explode("mapping").alias("m")).where(~F.coalesce(F.col(translated), F.lit("")).contains(F.col("m.token"))).select(key, F.col("m.token").alias("token"), F.col("m.original_text").alias("original_text"))


def replace_terms(texts: DataFrame, glossary: DataFrame, key: str, text: str, lang: str = "en", least: int = 3) -> DataFrame:
    """(key, replaced): terms of ``lang`` replaced by their counterparts, whole words as written,
    longest first, in texts that hold any; others stay as they are."""
    held = matches(texts, term_pairs(glossary, least).where((F.col("lang") == lang) & F.col("category").isin("acronym", "taxon", "table")), key, text)
    ordered = held.groupBy(key).agg(F.array_sort(F.collect_set(F.struct((-F.length("term")).alias("n"), "term", "other"))).alias("ts"))
    quoted = lambda t: F.concat(F.lit(r"(?U)\b"), F.regexp_replace(t, r"([\\.^$|?*+()\[\]{}])", r"\\$1"), F.lit(r"\b"))
    rows = texts.select(key, F.col(text).alias("text")).join(ordered, key, "left")
    folded = F.aggregate(F.coalesce("ts", F.array().cast("array<struct<n: int, term: string, other: string>>")), F.col("text"), lambda t, p: F.regexp_replace(t, quoted(p["term"]), F.regexp_replace(p["other"], r"([\\$])", r"\\$1")))
    return rows.select(key, folded.alias("replaced"))
