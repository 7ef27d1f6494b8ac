"""Languages of values and of their segments by compression (problem 7).

Each unit of a value is compressed with a zstandard raw-content dictionary of every language that
has its script; the language whose dictionary gives the smallest result is chosen, if by a margin.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.llm.sampling import samples
from bitloom.llm.sentences import Splitter
from bitloom.llm.spam import OWNER

LATIN, OTHER = ("en", "fr", "de", "es"), ("ja", "zh", "hi", "th")
#: Values per column and documents per label that dictionaries are made of, their longest length, and
#: the bytes of a dictionary.
FIT_TEXTS, FIT_DOCUMENTS, FIT_LENGTH, DICTIONARY = 4000, 200, 4000, 110_000
LEVEL = 3
#: By how much of the text's bytes the second smallest result must exceed the smallest.
MARGIN = 0.1
#: Characters from which a unit counts as a sentence, whole or cut.
SENTENCE = 12
#: Letters a unit must have to be judged: Latin ones, others.
LETTERS = (16, 4)

SCRIPTS = {
    "kana": re.compile("[぀-ヿ]"), "han": re.compile("[㐀-鿿]"), "deva": re.compile("[ऀ-ॿ]"), "thai": re.compile("[฀-๿]"), "latin": re.compile("[a-zß-ÿœ]"),
}
DIGITS = re.compile(r"[0-9]+")
WORD = re.compile(r"[^\W\d_]+")


def plain(text: str) -> str:
    """Lower case without accents of Latin letters, full-width forms as usual ones, numbers as 0."""
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not 0x300 <= ord(c) < 0x370)
        text = unicodedata.normalize("NFC", text)
    return " ".join(DIGITS.sub("0", text.lower()).split())


def _counts(text: str) -> dict[str, int]:
    return {k: len(r.findall(text)) for k, r in SCRIPTS.items()}


def _is_clean(text: str, lang: str) -> bool:
    """Whether a labelled sentence looks like its language: by function words or by script."""
    if lang in OWNER:
        words = WORD.findall(text)
        hits = {k: sum(map(own.__contains__, words)) for k, own in FLAT.items()}
        return hits[lang] * 8 >= len(words) > 2 and all(n < hits[lang] for k, n in hits.items() if k != lang)
    n = _counts(text)
    own = {"ja": n["kana"], "zh": n["han"] if not n["kana"] else 0, "hi": n["deva"], "th": n["thai"]}[lang]
    return own > n["latin"] / 2 + 2


FLAT = {lang: frozenset(plain(w) for w in words) for lang, words in OWNER.items()}


def dictionary(texts: list[str], lang: str) -> bytes:
    """Different sentences of ``texts``, those in their language only, up to DICTIONARY bytes."""
    out, size, seen = [], 0, set()
    for text in texts:
        for s in re.split(r"(?<=[.!?।])[\s»”\"]*\s|(?<=[。？！])|\n+|(?<=[฀-๿])\s", text):
            s = plain(s)
            if len(s) > 3 and s not in seen and _is_clean(s, lang):
                seen.add(s)
                out.append(s)
                size += len(s.encode()) + 1
        if size > DICTIONARY:
            break
    return "\n".join(reversed(out)).encode()[-DICTIONARY:]


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.of: dict[str, zstandard.ZstdCompressor] = {}
        for lang, content in dictionaries.items():
            if len(content) >= 8:
                how = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
                data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(compression_params=how)
                self.of[lang] = zstandard.ZstdCompressor(dict_data=data, compression_params=how)

    def classify(self, text: str) -> tuple[str, float]:
        """(language, confidence): the margin of the smallest result over the second, as a share of
        the text; ``und`` where it is below MARGIN or the text has too few letters."""
        text = plain(text)
        latin = len(SCRIPTS["latin"].findall(text))
        other = 0 if text.isascii() else sum(n for k, n in _counts(text).items() if k != "latin")
        langs = OTHER if other * 2 > latin and other >= LETTERS[1] else LATIN
        if langs is LATIN and latin < LETTERS[0]:
            return "und", 0.0
        data = text.encode()
        sizes = sorted((len(self.of[lang].compress(data)), lang) for lang in langs if lang in self.of)
        if not sizes:
            return "und", 0.0
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        margin = (sizes[1][0] - sizes[0][0]) / len(data)
        return (sizes[0][1] if margin >= MARGIN / (1 if langs is LATIN else 3) else "und"), round(margin, 4)


def dictionaries(values: DataFrame, documents: DataFrame) -> dict[str, bytes]:
    """Dictionaries of each language from labelled texts: the columns en and fr of ``values``, and
    documents of the other languages. Of each column at most FIT_TEXTS and of each label
    FIT_DOCUMENTS texts of at most FIT_LENGTH characters are taken, those with the smallest hashes; wrong
    ones among them are left out."""
    fits = lambda column: F.length(column).between(8, FIT_LENGTH)
    texts = samples(values, {side: (F.when(fits(side), F.col(side)), FIT_TEXTS) for side in ("en", "fr")})
    texts |= samples(documents, {lang: (F.when((F.col("lang") == lang) & fits("text"), F.col("text")), FIT_DOCUMENTS) for lang in (*OTHER, "de", "es")})
    return {lang: dictionary(own, lang) for lang, own in texts.items() if own}


def segments(values: DataFrame, documents: DataFrame, splitter: Splitter) -> DataFrame:
    """(match_id, side, start_pos, end_pos, lang, confidence, sentences): every value in segments of
    one language; neighbouring units of the same language are one segment with the lowest of their
    confidences. ``sentences`` counts its units of SENTENCE characters or more. Units that can't be told
    are ``und``. Null and blank values have no segments."""
    own = dictionaries(values, documents)
    shared = values.sparkSession.sparkContext.broadcast((own, splitter.marks.w, splitter.bare and splitter.bare.w))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        content, marks, bare = shared.value
        model, cut = Classifier(content), Splitter.of(marks, bare)
        for batch in batches:
            rows = []
            for side in ("en", "fr"):
                for i, text in zip(batch["match_id"].tolist(), batch[side], strict=True):
                    before: list | None = None
                    for start, end in cut.units(text) if text else ():
                        lang, sure = model.classify(text[start:end])
                        whole = int(end - start >= SENTENCE)
                        if before and before[4] == lang:
                            before[3], before[5], before[6] = end, min(before[5], sure), before[6] + whole
                        else:
                            before = [i, side, start, end, lang, sure, whole]
                            rows.append(before)
            yield pd.DataFrame(rows, columns=["match_id", "side", "start_pos", "end_pos", "lang", "confidence", "sentences"])

    return values.select("match_id", "en", "fr").mapInPandas(label, "match_id long, side string, start_pos int, end_pos int, lang string, confidence double, sentences int")


def found_languages(values: DataFrame, documents: DataFrame, splitter: Splitter) -> DataFrame:
    """(match_id, side, lang): languages other than the column's in which a value has a sentence."""
    return segments(values, documents, splitter).where((F.col("lang") != F.col("side")) & (F.col("lang") != "und") & (F.col("sentences") > 0)).select("match_id", "side", "lang").distinct()
