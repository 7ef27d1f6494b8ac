"""Records that differ only in how they are written down (problem 1).

Each field is normalised on the JVM, each (field name, value) pair hashed in two lanes, and the
hashes added up, which does not depend on the order of fields. Rows are grouped by the sum; the
fields of each row are then compared with those of the group's first row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.plans.skew import lookup

#: Stands for a decimal mark after normalisation; a symbol, so that it is not removed as punctuation.
DECIMAL = "⎖"
#: Two lanes of 57 bits: 64 fields can be added without overflow.
LANE_BITS = (1 << 57) - 1


def normalised(text: Column) -> Column:
    """``text`` in NFC and folded case, without white space, punctuation and format characters.

    Letters with accents, digits and symbols stay. A point or comma directly between two digits
    becomes one decimal mark. Null stays null.
    """
    composed = F.when(text.rlike(r"[^\x00-\x{2FF}]"), F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))).otherwise(text)
    folded = F.replace(F.translate(F.lower(F.upper(composed)), "ς", "σ"), F.lit("ß"), F.lit("ss"))
    marked = F.regexp_replace(folded, r"(?<=\p{Nd})[.,](?=\p{Nd})", DECIMAL)
    return F.regexp_replace(marked, r"[\p{P}\p{Z}\p{C}\s]+", "")


def _lane(fields: dict[str, Column], seed: int) -> Column:
    parts = [F.when(value.isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(seed), F.lit(role), value).bitwiseAND(F.lit(LANE_BITS))) for role, value in fields.items()]
    return reduce(lambda a, b: a + b, parts)


def first_of_set(df: DataFrame, row_id: str, en: str = "en", fr: str = "fr", keep: tuple[str, ...] = ()) -> DataFrame:
    """For each row of a set with copies: ``row_id``, the columns in ``keep``, and ``first_id``, the
    smallest ``row_id`` of its set. Rows without copies and rows without any text are left out.

    Both columns hold a text of the record, so both have the same field name: which of them holds
    which text makes no difference. Null and blank fields count as absent. Repeated rows are copies.
    A row whose fields differ from those of the first row in spite of equal hashes (two lanes of
    57 bits) stays a record of its own. Other columns may have any names.
    """
    blank = lambda c: F.when(F.length(normalised(c)) > 0, normalised(c))
    rows = df.select(F.col(row_id).alias("__id"), *[F.col(c).alias(f"__keep_{c}") for c in keep], blank(F.col(en)).alias("__a"), blank(F.col(fr)).alias("__b"))
    rows = rows.where(F.col("__a").isNotNull() | F.col("__b").isNotNull())
    # The same role for both fields; a record with the same text twice differs from one with it once.
    rows = rows.withColumns({"__f1": _lane({"text": F.col("__a")}, 1) + _lane({"text": F.col("__b")}, 1), "__f2": _lane({"text": F.col("__a")}, 2) + _lane({"text": F.col("__b")}, 2)})
    groups = rows.groupBy("__f1", "__f2").agg(F.min(F.struct("__id", "__a", "__b")).alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    both = lookup(rows, groups, ["__f1", "__f2"], "__n", F.col("__id"))
    same = (F.col("__a").eqNullSafe(F.col("__first.__a")) & F.col("__b").eqNullSafe(F.col("__first.__b"))) | (F.col("__a").eqNullSafe(F.col("__first.__b")) & F.col("__b").eqNullSafe(F.col("__first.__a")))
    return both.select(F.col("__id").alias(row_id), *[F.col(f"__keep_{c}").alias(c) for c in keep], F.when(same, F.col("__first.__id")).otherwise(F.col("__id")).alias("first_id"))


def found_copies(terms: DataFrame) -> DataFrame:
    """(row_a, row_b): each copy with the first row of its set."""
    return first_of_set(terms, "row_id").where("row_id <> first_id").select(F.col("first_id").alias("row_a"), F.col("row_id").alias("row_b"))


def records(terms: DataFrame) -> DataFrame:
    """One record per set: the texts of the first row, ``n_copies`` and ``total_count`` (null counts
    add nothing; null if all are null). Rows without text and rows without copies stay by themselves."""
    links = first_of_set(terms, "row_id", keep=("count",)).where("row_id <> first_id")
    extra = links.groupBy(F.col("first_id").alias("row_id")).agg(F.count(F.lit(1)).alias("more"), F.sum("count").alias("more_count"))
    rest = terms.select("row_id", "en", "fr", "count").join(links.select("row_id"), "row_id", "left_anti").join(extra, "row_id", "left")
    total = F.when(F.col("count").isNull(), F.col("more_count")).otherwise(F.col("count") + F.coalesce("more_count", F.lit(0)))
    return rest.select("row_id", "en", "fr", (F.coalesce("more", F.lit(0)) + 1).alias("n_copies"), total.alias("total_count"))
