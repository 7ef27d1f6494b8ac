import re

import pytest
from pyspark.sql import functions as F

from bitloom.functions import features as X
from bitloom.functions import text as T


def value(spark, make, *texts):
    df = spark.createDataFrame([tuple(texts)], ", ".join(f"c{i} string" for i in range(len(texts))))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(texts))]).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Fig. 3 shows it. The data is clear.", ["Fig. 3 shows it.", "The data is clear."]),
        ("Seen in the U.S.A. and here. Gone!", ["Seen in the U.S.A. and here.", "Gone!"]),
        ("Certaines, p. ex. la morue. Voir.", ["Certaines, p. ex. la morue.", "Voir."]),
        ("At 6 a.m. it left. Dr. Roe stayed.", ["At 6 a.m. it left.", "Dr. Roe stayed."]),
        ("", []),
        (None, None),
    ],
)
def test_split_sentences(spark, text, expected):
    assert value(spark, T.split_sentences, text) == expected


@pytest.mark.parametrize(("text", "fr"), [("1234", "1\xa0234"), ("1,234.56", "1\xa0234,56"), ("45.6%", "45,6\xa0%")])
def test_numbers_to_french(spark, text, fr):
    assert value(spark, lambda c: X.convert_numeric(c, True), text) == fr


@pytest.mark.parametrize(("text", "en"), [("1234", "1,234"), ("1\xa0234,56", "1,234.56")])
def test_numbers_to_english(spark, text, en):
    assert value(spark, lambda c: X.convert_numeric(c, False), text) == en


def test_is_numeric(spark):
    assert [value(spark, X.is_numeric, t) for t in ("12", "1 - 2", "1/2", "1-2", "x", "", None)] == [True, True, False, False, False, False, False]


def test_chunks_round_trip(spark):
    text = "One. Two!\n\nFig. 3. Three"
    assert value(spark, lambda c: T.reassemble(T.sentence_chunks(c)), text) == text
    assert value(spark, lambda c: T.reassemble(T.paragraph_chunks(c)), "a. b\n" + "x" * 700) == "a. b\n" + "x" * 700
    assert value(spark, lambda c: F.transform(T.paragraph_chunks(c), lambda x: x["line_idx"]), "a\n" + "Long one. " * 90) == [0, *[1] * 90]


def test_flags(spark):
    assert value(spark, X.number_mismatch, "In 1,234 of 5", "Dans 1 234 de 5") is True
    assert value(spark, X.number_mismatch, "1,5 and 2", "2 et 1.5") is False
    assert value(spark, X.ocr_issue, "It s here", "Bien") is True
    assert value(spark, X.ocr_issue, "I saw a cat", "il y a") is False
    assert value(spark, lambda c: X.has_date(c), "en FÉVRIER") is True
    assert value(spark, X.language, "the cat is of it") == "en"
    assert value(spark, X.language, "xyz") == "unknown"


def test_capitals(spark):
    carry = lambda a, b: X.carry_capitals(a, b, F.lit(False))
    assert value(spark, carry, "ACOUSTIC", "surveillance acoustique") == "SURVEILLANCE ACOUSTIQUE"
    assert value(spark, lambda a, b: X.carry_capitals(a, b, F.lit(True)), "acoustic", "surveillance acoustique") == "Surveillance acoustique"


def test_punctuation(spark):
    assert value(spark, lambda c: X.punctuation_spacing(c, "en"), "a : b ; c ? 5 %") == "a: b; c? 5%"
    once = value(spark, lambda c: X.punctuation_spacing(c, "fr"), "a: b ; c? 5% «x»")
    assert once == "a\xa0: b\xa0; c\xa0? 5\xa0% «\xa0x\xa0»"
    assert value(spark, lambda c: X.punctuation_spacing(c, "fr"), once) == once


def test_names_and_markup(spark):
    assert tuple(value(spark, T.document_of_file, "ERRATUM RD_2001 - French")) == ("RD_2001", "fr", True)
    assert value(spark, T.without_markup, "/pTB/_{max}") == "pTBmax"
    assert not re.search("[“”]", value(spark, T.clean_text, "“a”  b ☃"))
