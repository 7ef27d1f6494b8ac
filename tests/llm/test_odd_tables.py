"""Every operator on empty tables, nulls, very long texts, ties, repeated rows and clashing columns."""

import pytest
from pyspark.sql import functions as F

from bitloom.llm import alignment, copies, languages, leaks, overlaps, packing, sentences, spam, splits, truncation

LONG = "The vessel landed cod near the bay, and 4 kg of it were lost. " * 3000
TEXTS = [None, "", " \n", LONG, "x" * 60_000, "The vessel landed cod.", "The vessel landed cod.", "底层水温上升了。" * 20, "…", "\U0001f41f"]
#: Names that columns of the operators' own have.
CLASHING = "n e t g k m w key words label opening text side size salt name group root u v h1 h2 path comp block run chars language flag".split()


def crowded(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING if c not in df.columns])


@pytest.fixture(scope="module")
def bitext(spark):
    rows = [(i % 12, None if i % 5 == 0 else f"RD 2001-{i % 3}", i, a, b, None, "s" if i % 2 else None, None if i % 4 == 0 else "train" if i % 3 else "valid") for i, (a, b) in enumerate((a, b) for a in TEXTS for b in (TEXTS[0], TEXTS[5]))]
    df = spark.createDataFrame(rows, "match_id long, document_name string, pos int, en string, fr string, similarity double, source string, split_name string")
    return crowded(df.withColumns({"row_id": F.col("match_id"), "train_id": F.col("pos").cast("long"), "count": F.lit(None).cast("long"), "idx": F.col("pos")}))


@pytest.fixture(scope="module")
def documents(spark):
    return crowded(spark.createDataFrame([(i % 9, t, None if i % 2 else "en", "s") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string"))


@pytest.fixture(scope="module")
def splitter():
    return sentences.fit([], [])


def operators(bitext, documents, spark, splitter):
    items = spark.createDataFrame([(1, LONG[:400], None), (1, LONG[:400], None), (2, None, ""), (None, "x y", None)], "item_id long, source_text string, target_text string")
    shares = spark.createDataFrame([("train", 0.5), ("valid", None), (None, 1.0)], "split_name string, target_share double")
    kinds = spark.createDataFrame([("k", 64), (None, 16)], "container_kind string, capacity_tokens int")
    return {
        "p1": lambda: copies.found_copies(bitext), "p1 records": lambda: copies.records(bitext), "p2": lambda: sentences.units(bitext, splitter), "p3": lambda: alignment.aligned(bitext),
        "p4": lambda: truncation.found_truncated(bitext), "p4 rates": lambda: truncation.truncation_rates(bitext), "p5": lambda: splits.found_relations(bitext), "p5 rows": lambda: splits.assign_rows(bitext, shares),
        "p6": lambda: overlaps.found_overlaps(bitext), "p6 totals": lambda: overlaps.overlap_totals(bitext), "p7": lambda: languages.found_languages(bitext, documents, splitter),
        "p8": lambda: packing.containers(documents, kinds), "p9": lambda: leaks.found_leaks(documents, crowded(items)), "p10": lambda: spam.found_spam(documents),
    }


def test_odd_tables(bitext, documents, spark, splitter):
    got = {name: run().count() for name, run in operators(bitext, documents, spark, splitter).items()}
    # every row has a split, and every text a unit
    assert got["p5 rows"] == bitext.count()
    units = sentences.units(bitext, splitter).select("match_id", "side").distinct().count()
    assert units == bitext.select(F.explode(F.array(*[F.when(F.length(F.trim(F.regexp_replace(s, r"\s", ""))) > 0, F.concat("match_id", F.lit(s))) for s in ("en", "fr")])).alias("x")).where("x is not null").distinct().count()
    assert got["p1 records"] > 0 and got["p4 rates"] == 2


def test_empty_tables(bitext, documents, spark, splitter):
    for name, run in operators(bitext.limit(0), documents.limit(0), spark, splitter).items():
        assert run().isEmpty(), name
