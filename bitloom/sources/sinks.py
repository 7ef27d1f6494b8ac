"""Writers. Each writes a folder; an existing one is replaced unless said otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.operators.selection import both_directions, corpus_summary


def write_records(rows: DataFrame, path: str) -> None:
    both_directions(rows).write.mode("overwrite").json(path)


def write_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_match_log(statistics: DataFrame, path: str) -> None:
    """The summary and the documents, sorted by their share of places."""
    corpus_summary(statistics).write.mode("overwrite").json(f"{path}/summary")
    statistics.orderBy(F.col("n_places") / F.col("n_pairs"), "document_name").write.mode("overwrite").json(f"{path}/documents")


def write_nested(rows: DataFrame, path: str, key: str) -> None:
    """One JSON object per row, with ``key`` as its field name."""
    rest = [c for c in rows.columns if c != key]
    rows.select(F.to_json(F.create_map(F.col(key), F.struct(*rest))).alias("value")).write.mode("overwrite").text(path)


def append_log(rows: DataFrame, path: str, step: str) -> None:
    rows.withColumns({"step": F.lit(step), "logged_at": F.current_timestamp()}).write.mode("append").json(path)


def write_errors(issues: DataFrame, path: str, attempts: str | None = None) -> None:
    """CSV; with ``attempts`` a row per failed attempt, and one for rows without any."""
    rows = issues if attempts is None else issues.withColumn(attempts, F.explode_outer(attempts))
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_documents(chunks: DataFrame, path: str) -> None:
    """A text per document (document_name, text), in a folder of each."""
    chunks.select("document_name", "text").write.mode("overwrite").partitionBy("document_name").text(path)


def write_checklist(items: DataFrame, path: str) -> None:
    """Items (location, source_text, preferred_translation) as JSON."""
    items.select("location", "source_text", "preferred_translation").write.mode("overwrite").json(path)


def note_sections(groups: DataFrame) -> DataFrame:
    """(section, entry): grouped notes under 'paragraphs' or, of those in tables, 'tables'."""
    section = F.when(F.col("section") == "tables", "tables").otherwise("paragraphs")
    return groups.select(section.alias("section"), F.struct("full_paragraph", "type", "notes").alias("entry"))


def write_notes(groups: DataFrame, path: str) -> None:
    """A folder of JSON per section."""
    note_sections(groups).select("section", "entry.*").write.mode("overwrite").partitionBy("section").json(path)


def note_table(groups: DataFrame) -> DataFrame:
    """(section, full_paragraph, detail, colour): the rows of a report on notes, with the colour of
    their kind."""
    colour = F.when(F.col("type") == "mixed", "bright green").when(F.col("type") == "url", "turquoise").otherwise("yellow")
    return note_sections(groups).select("section", "entry.*").select("section", "full_paragraph", F.explode("notes").alias("detail"), colour.alias("colour"))


def write_glossary(glossary: DataFrame, path: str) -> None:
    """Entries by category, and the number of entries of each and of all."""
    from bitloom.operators.glossary import category_counts

    glossary.write.mode("overwrite").partitionBy("category").json(f"{path}/translations")
    category_counts(glossary).write.mode("overwrite").json(f"{path}/statistics")
