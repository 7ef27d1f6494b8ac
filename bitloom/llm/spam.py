"""Keyword, tag, price and link pages (problem 10).

Every text is cut into windows of about WINDOW characters; each window has four features. Per
language, or script other than Latin, the location and scatter of ordinary windows are fitted
robustly over all windows (concentration steps on medians and covariances, computed by aggregates)
and drawn towards fixed ones, the more so the fewer documents there are. Windows far from them by
Mahalanobis distance, in a direction that spam lies in, are flagged. A document is spam if flagged
windows hold more than LEAST of its characters.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.plans.materialize import checkpointed

WINDOW = 240
#: Between the third that ordinary pages may list and the two thirds from which a page is spam.
LEAST = 0.5
FEATURES = ("function", "density", "repetition", "entropy")
#: The sign of each feature's deviation in spam.
SPAM = (-1.0, 1.0, 1.0, -1.0)
STEPS = 3
#: 0.999 quantile of the chi-square distribution with 4 degrees of freedom.
FAR = 18.47
#: The scatter of the nearer half of Gaussian data in 4 dimensions is about half of the whole's.
CONSISTENCY = 2.0
#: Scatter is not taken as smaller than this, so that very uniform text doesn't make all else far.
LEAST_SPREAD = (0.07, 0.025, 0.06, 0.03)
#: Spreads by which a spam window has fewer function words than ordinary ones: prose that repeats
#: itself has as many as other prose.
TOWARDS = 1.5
#: Ordinary windows of any language and their spreads, and the share of function words by
#: language or script. They count as much as PRIOR documents, so no group needs to have a least size.
PRIOR = 20
USUAL, USUAL_SPREAD = (0.0, 0.07, 0.15, 0.87), (0.07, 0.035, 0.12, 0.05)
USUAL_FUNCTION = {"en": 0.35, "fr": 0.45, "de": 0.4, "es": 0.43, "han": 0.15, "kana": 0.4, "thai": 0.25, "devanagari": 0.4}
#: In other scripts the share's spread is this part of the usual share at least: it differs between them.
SPREAD_OF_SHARE = 0.2

#: Frequent function words of the languages written with spaces.
FUNCTION = {
    "en": "the of and in to was were is are that by for with at from on a an be has had have not this it as or which than under would could into per its",
    "fr": "le la les des du de d l et dans un une que qu par pour au aux a à été est sont ont sur en ce ces cette avec ne pas ou selon plus se s n il",
    "de": "der die das und in von zu den im dem mit ist nicht um bei auf wurde wurden sich hat des ein eine zur am nach seit einer vor als war",
    "es": "el la los las de y en que se un una por con del al no ha para su a desde como más fue durante cerca es lo entre frente",
}
OWNER = {lang: frozenset(words.split()) for lang, words in FUNCTION.items()}
ANY = frozenset().union(*OWNER.values())
#: Particles and other function words by script; those of Thai stand within unspaced text.
PARTICLES: dict[str, frozenset[str] | re.Pattern] = {
    "han": frozenset("的了在是和于为有对着之以而与到从被把也不这那其及或但随比上下中个后前将由等所并至已未能可会就都还很该此则因各每约"),
    "kana": frozenset(map(chr, range(0x3041, 0x3097))),
    "thai": re.compile("การ|ความ|ที่|ของ|และ|ใน|เป็น|ไม่|ได้|มี|ให้|จาก|กับ|ว่า|นี้|ถึง|โดย|จะ|แต่|ก็|หรือ|ซึ่ง|คือ|ต้อง|ยัง|ก่อน|ขึ้น|ลง|กว่า|ต่อ|อยู่|แล้ว|ตาม|เมื่อ|หลัง|ระหว่าง|เพื่อ|ด้วย|ทำ|เข้า|ออก|ไป|มา|ใกล้|นั้น|เห็น|กลับ"),
    "devanagari": frozenset("का के की को में से पर और है हैं था थे थी ने यह वह कि नहीं भी एक या तो ही इस उस जो हो तक लिए साथ बाद ये वे कर किया गया गई गए हुआ हुई हुए जा रहा रही रहे अपने जब तब क्या कुछ पास अभी कहा द्वारा होता होती होते".split()),
}
NONE: frozenset[str] = frozenset()
WORD = re.compile(r"[぀-ヿ㐀-鿿฀-๿]|[^\W_]+(?:[ऀ-ॿ]+)*", re.UNICODE)
#: What prices, links, tags and lists are made of.
MARKS = (*"0123456789/_#|»=<>[](){};:•*-", "http", "www.", "href")


def best_of(words: list[str]) -> str | None:
    """The language, of those with spaces, that has most of its function words among ``words``."""
    if not (own := [w for w in words if w in ANY]):
        return None
    return max(OWNER, key=lambda lang: sum(map(OWNER[lang].__contains__, own)))


@lru_cache(1 << 16)
def script_of(char: str) -> str:
    """The script of a letter, in lower case as Unicode's names begin; "" of digits and other marks."""
    if not char.isalpha() and not unicodedata.category(char).startswith("M"):
        return ""
    first = unicodedata.name(char, "").split(" ")[0].split("-")[0].lower()
    return {"hiragana": "kana", "katakana": "kana", "halfwidth": "kana", "cjk": "han"}.get(first, first)


def other_script(words: list[str]) -> str | None:
    """The script that a text is in, if two thirds of its words are in others than Latin."""
    seen = Counter(script_of(w[0]) for w in words)
    latin, _ = seen.pop("latin", 0), seen.pop("", 0)
    if not seen or latin * 2 >= seen.total():
        return None
    # Japanese has both
    return "kana" if seen["kana"] * 20 > seen["han"] and seen["kana"] + seen["han"] > seen.total() / 2 else max(seen, key=lambda s: (seen[s], s))


def language_of(words: list[str], label: str | None) -> str:
    """The language, or script other than Latin, of a text as a whole; its label only where the text
    has no function words."""
    return other_script(words) or best_of(words) or (label if label in OWNER else "en")


def language_within(words: list[str], whole: str) -> str:
    """That of a part of a text: without function words or letters of other scripts, the text's."""
    own = other_script(words)
    if own:
        return whole if own == "han" and whole == "kana" else own
    return best_of(words) or whole


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """Pieces of about ``size`` characters, cut at white space where there is some nearby; the last
    piece is joined to the one before if it is short."""
    n, at = len(text), 0
    while at < n:
        end = n if n - at < size * 3 // 2 else at + size
        if end < n:
            while end < min(n, at + size + 40) and not text[end].isspace():
                end += 1
        yield text[at:end]
        at = end


def features(window: str, words: list[str], function: frozenset[str] | re.Pattern) -> tuple[float, float, float, float] | None:
    """Share of function words, marks per character, repeated pairs of words, entropy of words."""
    n = len(words)
    if not n:
        return (0.0, 1.0, 0.0, 1.0) if window.strip() else None
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    share = (sum(map(len, function.findall(window))) if isinstance(function, re.Pattern) else sum(map(function.__contains__, words))) / n
    dense = sum(map(window.count, MARKS)) / len(window)
    entropy = 1.0 if n < 2 else (math.log(n) - sum(c * math.log(c) for c in counts.values() if c > 1) / n) / math.log(n)
    pairs = len(set(zip(words, words[1:], strict=False)))
    repeated = 0.0 if n < 2 else 1 - pairs / (n - 1)
    return share, dense, repeated, entropy


def window_features(documents: DataFrame) -> DataFrame:
    """(doc_id, language, chars, function, density, repetition, entropy): a row per window of every
    text. The language is that of the window, as ``language_within`` says."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text, label in zip(batch["doc_id"].tolist(), batch["text"], batch["lang"], strict=True):
                cut = [(w, WORD.findall(w)) for w in windows(text.lower())]
                lang = language_of([x for _, words in cut for x in words], label)
                for w, words in cut:
                    own = language_within(words, lang)
                    if (f := features(w, words, ANY if own in OWNER else PARTICLES.get(own, NONE))) is not None:
                        rows.append((doc, own, len(w), *f))
                if len(rows) > 100_000:
                    yield pd.DataFrame(rows, columns=["doc_id", "language", "chars", *FEATURES])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "language", "chars", *FEATURES])

    return documents.select("doc_id", "text", "lang").where(F.length("text") > 0).mapInPandas(measure, "doc_id long, language string, chars int, " + ", ".join(f"{f} double" for f in FEATURES))


def _distance(stats: dict[str, tuple[np.ndarray, np.ndarray]]):
    """Squared distance by language, as a column."""
    out = F.lit(None).cast("double")
    for lang, (mean, inverse) in stats.items():
        d = [F.col(f) - float(m) for f, m in zip(FEATURES, mean, strict=True)]
        square = sum((float(inverse[i, j] * (1 if i == j else 2)) * d[i] * d[j] for i, j in combinations_with_replacement(range(len(d)), 2)), F.lit(0.0))
        out = F.when(F.col("language") == lang, square).otherwise(out)
    return out


def least_spread(language: str) -> np.ndarray:
    least = np.array(LEAST_SPREAD)
    if language not in OWNER and language in USUAL_FUNCTION:
        least[0] = SPREAD_OF_SHARE * USUAL_FUNCTION[language]
    return least


def fit(feats: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Robust mean and scatter per language, of every language and script there is. The driver sees a
    row of sums for each: languages are the fixed ones, and scripts those of Unicode."""
    k = len(FEATURES)
    medians = [F.percentile_approx(f, 0.5, 2000).alias(f"m{i}") for i, f in enumerate(FEATURES)]
    spread = [F.percentile_approx(f, F.array(F.lit(0.25), F.lit(0.75)), 2000).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    start = feats.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("doc_id").alias("docs"), *medians, *spread).orderBy(F.desc("n"), "language").collect()
    stats, own, usual = {}, {}, {}
    for r in start:
        lang = r["language"]
        least = least_spread(lang)
        # a document of many windows counts once, so that one page doesn't say what is ordinary
        own[lang] = r["docs"] / (r["docs"] + PRIOR)
        sd = np.maximum(USUAL_SPREAD, least)
        sd[0] = least[0]
        usual[lang] = (np.array([USUAL_FUNCTION.get(lang, 0.0), *USUAL[1:]]), np.diag(sd**2))
        found = np.maximum([(r[f"s{i}"][1] - r[f"s{i}"][0]) / 1.349 for i in range(k)], least)
        stats[lang] = _drawn(np.array([r[f"m{i}"] for i in range(k)]), np.diag(found**2), usual[lang], own[lang])
    pairs = list(combinations_with_replacement(range(k), 2))
    for _step in range(STEPS if stats else 0):
        scored = feats.withColumn("d", _distance(stats))
        cut = {r["language"]: r["c"] for r in scored.where("d is not null").groupBy("language").agg(F.percentile_approx("d", 0.5, 2000).alias("c")).collect()}
        near = F.lit(False)
        for lang, c in cut.items():
            near = near | ((F.col("language") == lang) & (F.col("d") <= float(c)))
        sums = scored.where(near).groupBy("language").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f"a{i}") for i, f in enumerate(FEATURES)], *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"b{i}_{j}") for i, j in pairs]).collect()
        for r in sums:
            lang = r["language"]
            least = least_spread(lang)
            mean = np.array([r[f"a{i}"] for i in range(k)]) / r["n"]
            scatter = np.zeros((k, k))
            for i, j in pairs:
                scatter[i, j] = scatter[j, i] = r[f"b{i}_{j}"] / r["n"] - mean[i] * mean[j]
            scatter = scatter * CONSISTENCY
            sd = np.sqrt(np.maximum(np.diag(scatter), 1e-12))
            wide = np.maximum(sd, least) / sd
            scatter = scatter * np.outer(wide, wide) + np.diag(least**2) * 1e-2
            stats[lang] = _drawn(mean, scatter, usual[lang], own[lang])
    return stats


def _drawn(mean: np.ndarray, scatter: np.ndarray, usual: tuple[np.ndarray, np.ndarray], own: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and inverse scatter, by ``own`` those found and else the usual ones."""
    scatter = own * scatter + (1 - own) * usual[1]
    # where a row has no variance the floor's scaling leaves its covariances unsound
    bound = np.sqrt(np.outer(np.diag(scatter), np.diag(scatter))) * 0.95
    scatter = np.where(np.eye(len(mean), dtype=bool), scatter, np.clip(scatter, -bound, bound))
    return own * mean + (1 - own) * usual[0], np.linalg.inv(scatter)


def spam_share(documents: DataFrame, feats: DataFrame | None = None) -> DataFrame:
    """(doc_id, chars, spam_chars, share): every text that isn't null or blank."""
    feats = checkpointed(window_features(documents)) if feats is None else feats
    stats = fit(feats)
    spamlike = F.lit(False)
    for lang, (mean, inverse) in stats.items():
        sd = 1 / np.sqrt(np.diag(inverse))
        lean = [(F.col(f) - float(m)) * (s / float(max(d, least))) for f, m, s, d, least in zip(FEATURES, mean, SPAM, sd, least_spread(lang), strict=True)]
        # without known function words the other features decide
        fewer = lean[0] > TOWARDS if lang in USUAL_FUNCTION else F.lit(True)
        spamlike = spamlike | ((F.col("language") == lang) & fewer & (sum(lean, F.lit(0.0)) > 0))
    flagged = feats.withColumn("flag", F.coalesce((_distance(stats) > FAR) & spamlike, F.lit(False)))
    return flagged.groupBy("doc_id").agg(F.sum("chars").alias("chars"), F.sum(F.when(F.col("flag"), F.col("chars")).otherwise(0)).alias("spam_chars")).withColumn("share", F.col("spam_chars") / F.col("chars"))


def found_spam(documents: DataFrame) -> DataFrame:
    return spam_share(documents).where(F.col("share") > LEAST).select("doc_id").distinct()
