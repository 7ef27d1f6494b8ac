"""Reviews, notes and formatted runs of documents, as rows."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitloom.functions.text import straight_apostrophes

_QUOTES = str.maketrans("“”„‘’‚", "\"\"\"'''")


def normalise_with_map(text: str) -> tuple[str, list[int]]:
    """Straight quotes and single spaces, and for each character of the result its place in ``text``,
    with one more for the end."""
    out, places = [], []
    for i, c in enumerate(text.translate(_QUOTES)):
        c = " " if c == "\ufeff" or unicodedata.category(c) == "Zs" else c
        if c != " " or not out or out[-1] != " ":
            out.append(c)
            places.append(i)
    return "".join(out), [*places, len(text)]


def change(text: str, error: str, fix: str) -> tuple[str, str, str, str] | None:
    """(before, deleted, inserted, after) for the first place where ``error`` stands; None if there is
    none, or nothing to change."""
    if not error or error == fix:
        return None
    plain, places = normalise_with_map(text)
    wanted, _ = normalise_with_map(error)
    at = plain.find(wanted)
    if at < 0:
        return None
    start, end = places[at], places[at + len(wanted)]
    return text[:start], text[start:end], fix, text[end:]


def apply_review(items: DataFrame, located: DataFrame) -> DataFrame:
    """Review items (doc, location, error_text, suggested_fix) on located text (doc, loc_id, text):
    with the parts of the change, its ids in steps of two from 100, or why it was skipped."""
    joined = items.join(located.withColumnRenamed("loc_id", "location"), ["doc", "location"], "left")
    kinds = "doc string, location string, error_text string, suggested_fix string, text string, before string, deleted string, inserted string, after string, skip_reason string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = [None if pd.isna(t) else change(t, e or "", f or "") for t, e, f in zip(b["text"], b["error_text"], b["suggested_fix"], strict=True)]
            reason = ["location not found" if pd.isna(t) else None if d else "nothing to change" if not e or e == f else "text not found" for t, e, f, d in zip(b["text"], b["error_text"], b["suggested_fix"], done, strict=True)]
            yield b.assign(**{n: [d[i] if d else None for d in done] for i, n in enumerate(("before", "deleted", "inserted", "after"))}, skip_reason=reason)

    out = joined.select("doc", "location", "error_text", "suggested_fix", "text").mapInPandas(run, kinds)
    applied = F.col("skip_reason").isNull()
    rank = F.row_number().over(Window.partitionBy("doc", applied).orderBy("location", "error_text", "suggested_fix"))
    return out.withColumn("change_id", F.when(applied, 100 + 2 * (rank - 1)))


def kept_notes(notes: DataFrame) -> DataFrame:
    """Notes without lines that only give black as colour; notes without text or lines are left out."""
    lines = F.filter(F.transform(F.split("notes", "\n"), lambda x: F.trim(x)), lambda x: (x != "") & (x != "colour=000000"))
    return notes.withColumn("notes", F.array_join(lines, "\n")).where((F.trim("original_text") != "") & (F.col("notes") != ""))


def grouped_notes(notes: DataFrame) -> DataFrame:
    """(full_paragraph, type, notes, section): the different notes of each paragraph by place, in the
    order seen; type mixed, url or formatting."""
    place = ["section", "index", "tbl", "row", "cell"]
    once = notes.groupBy("full_paragraph", "notes", *place).agg(F.min("ord").alias("ord"), F.min("type").alias("type"))
    g = once.groupBy("full_paragraph").agg(F.array_sort(F.collect_list(F.struct("ord", "notes"))).alias("x"), F.bool_or(F.col("type") == "url").alias("u"), F.bool_or(F.col("type") == "formatting").alias("f"), F.min_by("section", "ord").alias("section"))
    return g.select("full_paragraph", F.when(F.col("u") & F.col("f"), "mixed").when(F.col("u"), "url").otherwise("formatting").alias("type"), F.transform("x", lambda e: e["notes"]).alias("notes"), "section")


def merged_runs(runs: DataFrame) -> DataFrame:
    """Neighbouring runs of a paragraph with the same format as one: gaps and islands."""
    fmt = F.struct("bold", "italic", "underline", "superscript", "subscript", F.coalesce("colour", F.lit("")).alias("colour"))
    w = Window.partitionBy("path", "ord").orderBy("run")
    marked = runs.where("not deleted").withColumn("fmt", fmt).withColumn("new", F.when(F.lag("fmt").over(w) == F.col("fmt"), 0).otherwise(1))
    islands = marked.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("path", "ord", "island", "fmt").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "text"))), lambda x: x["text"]), "").alias("text")).select("path", "ord", "island", "text", "fmt.*")


def format_notes(runs: DataFrame) -> DataFrame:
    """(path, ord, text, notes): runs with any format, and its names."""
    names = F.filter(F.array(*[F.when(F.col(c), F.lit(c)) for c in ("bold", "italic", "underline", "superscript", "subscript")], F.when(~F.coalesce("colour", F.lit("000000")).isin("000000", "auto", ""), F.concat(F.lit("colour="), "colour"))), lambda x: x.isNotNull())
    return runs.select("path", "ord", "text", names.alias("names")).where(F.size("names") > 0).select("path", "ord", "text", F.array_join("names", ", ").alias("notes"))


def ordinal_suffixes(text: Column, superscript: bool = True) -> Column:
    """array of the ordinals and units whose tail is raised (1st, 2e, m2) or lowered in print."""
    return F.regexp_extract_all(text, F.lit(r"\b([0-9]+(?:st|nd|rd|th|er|re|e|ème)|[ck]?m[23])\b" if superscript else r"\b([A-Z][a-z]?[0-9]+)\b"), F.lit(1))


MARKUP = "array<struct<text: string, italic: boolean, superscript: boolean, subscript: boolean>>"


def parse_markup(text: str) -> list[tuple[str, bool, bool, bool]]:
    """Runs of text with /italics/, _{below} and ^{above}; marks nest, and an unclosed one is text."""
    out: list[tuple[str, bool, bool, bool]] = []

    def walk(s: str, italic: bool, sup: bool, sub: bool) -> None:
        i, plain = 0, ""
        while i < len(s):
            end, inner, now = -1, "", (italic, sup, sub)
            if s[i] == "/" and (end := s.find("/", i + 1)) > i + 1:
                inner, now = s[i + 1 : end], (True, sup, sub)
            elif s[i] in "_^" and s[i + 1 : i + 2] == "{" and (end := s.find("}", i)) > 0:
                inner, now = s[i + 2 : end], (italic, sup or s[i] == "^", sub or s[i] == "_")
            elif s[i] in "_^" and i + 1 < len(s) and s[i + 1].isalnum():
                end, inner, now = i + 1, s[i + 1], (italic, sup or s[i] == "^", sub or s[i] == "_")
            if inner:
                if plain:
                    out.append((plain, italic, sup, sub))
                    plain = ""
                walk(inner, *now)
                i = end + 1
            else:
                plain += s[i]
                i += 1
        if plain:
            out.append((plain, italic, sup, sub))

    walk(text, False, False, False)
    return out


def markup_runs(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, runs): texts with inline marks as formatted runs; a null text has none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parsed = [[dict(zip(("text", "italic", "superscript", "subscript"), r, strict=True)) for r in parse_markup(t)] if t else [] for t in b["text"]]
            yield pd.DataFrame({key: b[key], "runs": parsed})

    return texts.select(key, F.col(text).alias("text")).mapInPandas(run, f"{key} {dict(texts.dtypes)[key]}, runs {MARKUP}")


def links(html: Column) -> Column:
    """array of struct(url, text) of the links of a page."""
    found = F.regexp_extract_all(html, F.lit(r'(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), F.lit(0))
    return F.transform(found, lambda x: F.struct(F.regexp_extract(x, r'(?i)href="([^"]*)"', 1).alias("url"), F.regexp_replace(F.regexp_extract(x, r"(?is)>(.*?)</a>", 1), "<[^>]+>", "").alias("text")))


def table_contractions(html: DataFrame, text: str) -> DataFrame:
    """Words with an apostrophe in first cells of table rows, lower case, each once."""
    cell = F.explode(F.regexp_extract_all(text, F.lit(r"(?is)<tr[^>]*>\s*<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)))
    word = F.lower(F.regexp_extract(F.trim(F.regexp_replace(straight_apostrophes(F.col("c")), "<[^>]+>", "")), r"^([^\s/]+)", 1))
    return html.select(cell.alias("c")).select(word.alias("contraction")).where(F.col("contraction").contains("'")).distinct()


def acronym_table(glossary: DataFrame, source_lang: str = "en") -> DataFrame:
    """One row: a table in text form of the acronyms, sorted."""
    own, other = ("english", "french") if source_lang == "en" else ("french", "english")
    a = glossary.where("category = 'acronym'").groupBy(F.col(own).alias("a")).agg(F.min(other).alias("b"))
    return a.agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("x")).select(F.concat(F.lit("| source | target |\n|---|---|\n"), F.array_join(F.transform("x", lambda r: F.concat(F.lit("| "), r["a"], F.lit(" | "), r["b"], F.lit(" |"))), "\n")).alias("table"))

