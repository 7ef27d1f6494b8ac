"""Column functions for features, flags and numbers of aligned text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

STRIPPED = ".,!?;:\"'-()[]{}"
#: Single letters that are words.
LETTERS = {"en": ("i", "a"), "fr": ("à", "a", "y", "ô", "ù")}
#: Words of dates; the boundary stands behind only.
MONTHS = "January February March April May June July August September October November December janvier février mars avril mai juin juillet août septembre octobre novembre décembre Jan Feb Mar Apr Jun Jul Aug Sep Oct Nov Dec".split()
#: Bounds of ratios by similarity: below 0.92, below 0.99, from 0.99.
TIERS = {
    "len_ratio": ((0.75, 1.92), (0.75, 1.92), (0.34, 3.93)),
    "verb_ratio": ((0.75, 1.50), (0.50, 3.00), (0.25, 5.00)),
    "noun_ratio": ((1.00, 1.75), (0.67, 4.00), (0.38, 12.00)),
    "entity_ratio": ((0.33, 1.00), (0.17, 2.00), (0.10, 4.00)),
    "clause_ratio": ((1.00, 1.50), (0.50, 3.00), (0.20, 6.00)),
}
LOW, MID, HIGH = 0.85, 0.92, 0.99
#: Bounds of ratios of text from word-processor files.
FILE_BOUNDS = {"len_ratio": (0.8191, 1.6204), "verb_ratio": (0.4793, 2.1613), "noun_ratio": (0.4563, 3.7985), "entity_ratio": (0.2378, 2.4115), "clause_ratio": (0.5611, 1.8682)}
#: Small word lists of the language classifier.
WORDS = {
    "en": "the of and is was were in to that for with by from on this which are be as at an it not has have had could would may".split(),
    "fr": "le la les de des du et est une un dans que par pour avec sur au aux ce cette qui sont été avait plus ou ne pas".split(),
}
#: Suffixes that the stand-in for part-of-speech tagging counts.
VERBS = {"en": "(ed|ing|ise|ize)$", "fr": "(er|ir|é|ée|ait|ent|aient)$"}
NOUNS = {"en": "(tion|ment|ness|ity|ance|ence|ship|er|age)$", "fr": "(tion|ment|té|ance|ence|eur|age|isme)$"}


def ratio(over: Column, under: Column) -> Column:
    return F.try_divide(over.cast("double"), under.cast("double"))


def len_ratio(fr: Column, en: Column) -> Column:
    return ratio(F.length(fr), F.length(en))


def clause_ratio(fr: Column, en: Column) -> Column:
    return ratio(F.regexp_count(fr, F.lit("[,;]")) + 1, F.regexp_count(en, F.lit("[,;]")) + 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def _matching(text: Column, pattern: str) -> Column:
    return F.size(F.filter(words(F.lower(text)), lambda w: F.btrim(w, F.lit(STRIPPED)).rlike(pattern)))


def tag_counts(text: Column, lang: str) -> Column:
    """struct(verbs, nouns, entities): the default seam for a tagger, by suffixes; entities are
    capitalised words that do not begin the text."""
    entities = F.size(F.filter(words(text), lambda w, i: (i > 0) & w.rlike("^[A-ZÀ-Þ][a-zà-ÿ]+")))
    return F.struct(_matching(text, VERBS[lang]).alias("verbs"), _matching(text, NOUNS[lang]).alias("nouns"), entities.alias("entities"))


def tag_ratio(fr: Column, en: Column, what: str) -> Column:
    return ratio(tag_counts(fr, "fr")[what] + 1, tag_counts(en, "en")[what] + 1)


def single_letters(text: Column) -> Column:
    """array of struct(pos, letter, word): words that are one letter without punctuation."""
    each = F.transform(words(text), lambda w, i: F.struct(i.cast("int").alias("pos"), F.lower(F.btrim(w, F.lit(STRIPPED))).alias("letter"), w.alias("word")))
    return F.filter(each, lambda x: F.length(x["letter"]) == 1)


def has_single_letter(text: Column) -> Column:
    return F.exists(words(text), lambda w: F.length(F.btrim(w, F.lit(STRIPPED))) == 1)


def ocr_side(text: Column, lang: str) -> Column:
    odd = F.exists(words(text), lambda w: (F.length(F.btrim(w, F.lit(STRIPPED))) == 1) & ~F.lower(F.btrim(w, F.lit(STRIPPED))).isin(*LETTERS[lang]) & ~F.btrim(w, F.lit(STRIPPED)).rlike("^[0-9]$"))
    return F.coalesce(text.contains(" '") | text.contains("' ") | odd, F.lit(False))


def ocr_issue(en: Column, fr: Column) -> Column:
    """Apostrophes beside spaces, or single letters that are no words, on either side."""
    return ocr_side(en, "en") | ocr_side(fr, "fr")


def numbers(text: Column) -> Column:
    """Different numbers of a text, without points and commas, in order."""
    found = F.regexp_extract_all(text, F.lit(r"\b[0-9]+(?:[.,][0-9]+)*\b"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, "[.,]", ""))))


def number_mismatch(en: Column, fr: Column) -> Column:
    return numbers(en) != numbers(fr)


def figure_flags(text: Column, lang: str) -> dict[str, Column]:
    word = "Tableau" if lang == "fr" else "Table"
    return {
        "has_leading_numbers": text.rlike(r"^\s*[0-9]+\s+"),
        "has_trailing_numbers": text.rlike(r"\s+[0-9]+\s*\z"),
        "has_parenthetical_numbers": text.rlike(r"\s+\([0-9]+\)\s*\z"),
        "has_figure_references": text.rlike(rf"(?i)(?:Figure|{word}|Fig\.?|Tab\.?)\s+[0-9]+"),
        "has_repeated_punctuation": text.rlike(r"[.!?]{2,}\z"),
    }


def figure_text(en: Column, fr: Column) -> Column:
    return reduce(lambda a, b: a | b, [*figure_flags(en, "en").values(), *figure_flags(fr, "fr").values()])


def too_short(en: Column, fr: Column, least: int = 20) -> Column:
    return (F.length(en) < least) | (F.length(fr) < least)


def has_date(text: Column) -> Column:
    return text.rlike(rf"(?iu)\b(?:19|20)[0-9]{{2}}\b|(?:{'|'.join(MONTHS)})\b")


def language(text: Column, least: int = 2, most_wrong: int = 0) -> Column:
    """en, fr, mixed or unknown, by hits in two word lists."""
    def hits(lang: str) -> Column:
        return F.size(F.filter(words(F.lower(text)), lambda w: w.isin(*WORDS[lang])))

    en, fr = hits("en"), hits("fr")
    return F.when((en > fr) & (en >= least) & (fr <= most_wrong), "en").when((fr > en) & (fr >= least) & (en <= most_wrong), "fr").when((en >= most_wrong) & (fr >= most_wrong) & (en + fr >= least), "mixed").otherwise("unknown")


def wrong_language(en: Column, fr: Column) -> Column:
    return (language(en) != "en") | (language(fr) != "fr")


def outside_tier(value: Column, similarity: Column, feature: str) -> Column:
    """Whether a ratio is outside the bounds of its similarity's tier. A null ratio is outside; a
    null similarity has no tier."""
    def out(bounds: tuple[float, float]) -> Column:
        return ~F.coalesce(value.between(*bounds), F.lit(False))

    low, mid, high = TIERS[feature]
    return F.when(similarity < MID, out(low)).when(similarity < HIGH, out(mid)).when(similarity >= HIGH, out(high)).otherwise(False)


def cosine(a: Column, b: Column) -> Column:
    double = lambda v: F.transform(v, lambda x: x.cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(double(x), double(y), lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


_DROPPED = r"[\s,.\x{A0}\x{202F}+\-−/%<>()\[\]=#×÷±≤≥*–^°]"


def numeric_part(part: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(part, r"[Ee][+\-]", ""), _DROPPED, "")
    return ~part.rlike(r"[0-9]/[0-9]") & ~part.rlike(r"[0-9]\s*[-–−]\s*[0-9]") & bare.rlike(r"\A[0-9]+\z")


def is_numeric(text: Column) -> Column:
    """A number, or numbers with spaced dashes between them."""
    return F.coalesce((F.trim(text) != "") & F.forall(F.split(F.trim(text), r"\s+[-–−]\s+"), numeric_part), F.lit(False))


def _grouped(digits: Column, mark: str) -> Column:
    number = F.regexp_replace(digits, r"\A0+(?=[0-9])", "")
    return F.reverse(F.regexp_replace(F.reverse(number), r"([0-9]{3})(?=[0-9])", f"$1{mark}"))


def convert_numeric(text: Column, to_fr: bool = True) -> Column:
    """A number in the other language's form: marks of thousands and decimals, space before %. Signs
    and brackets are dropped, exponents kept; ranges are joined by a spaced hyphen."""
    point, thousands, decimal, percent = (".", "\xa0", ",", "\xa0%") if to_fr else (",", ",", ".", "%")

    def one(p: Column) -> Column:
        pieces = F.split(p, "[" + point + "]")
        whole = F.regexp_replace(pieces[0], "[^0-9]", "")
        fraction = F.regexp_replace(F.regexp_extract(F.try_element_at(pieces, F.lit(2)), r"\A([^E%]*)", 1), "[^0-9]", "")
        bare = F.regexp_replace(F.regexp_replace(p, r"[Ee][+\-]", ""), _DROPPED, "")
        plain = F.when(p.contains(point), F.concat(_grouped(whole, thousands), F.lit(decimal), fraction)).otherwise(_grouped(bare, thousands))
        return F.concat(plain, F.regexp_extract(p, r"[Ee][+\-][0-9]+", 0), F.when(p.contains("%"), percent).otherwise(""))

    return F.array_join(F.transform(F.split(F.trim(text), r"\s+[-–−]\s+"), one), " - ")


def carry_capitals(original: Column, replacement: Column, starts: Column) -> Column:
    """``replacement`` with the capitals of ``original``: all, the first one, or none."""
    upper = (F.upper(original) == original) & (F.lower(original) != original)
    lower = (F.lower(original) == original) & (F.upper(original) != original)
    first = F.concat(F.upper(F.substring(replacement, 1, 1)), replacement.substr(F.lit(2), F.length(replacement)))
    return F.when((original == "") | (replacement == ""), replacement).when(upper, F.upper(replacement)).when(starts, first).when(lower, F.lower(replacement)).otherwise(replacement)


def punctuation_spacing(text: Column, lang: str) -> Column:
    """No-break spaces before French marks, no spaces before English ones."""
    nb = "\xa0"
    if lang == "en":
        rules = [(r" +(:)", "$1"), (r" +(;)", "$1"), (r" +(\?)", "$1"), (r" +(!)", "$1"), (r"([0-9]) +(%)", "$1$2")]
    else:
        rules = [(r"(?<![:/0-9\x{A0}]) ?(:)(?!/)", nb + "$1"), (r"(?<!\x{A0}) ?(;)", nb + "$1"), (r"(?<!\x{A0}) ?(\?)", nb + "$1"), (r"(?<!\x{A0}) ?(!)", nb + "$1"), (r"([0-9]) ?(%)", f"$1{nb}$2"), (r"«[\s\x{A0}]*", "«" + nb), (r"[\s\x{A0}]*»", nb + "»")]
    for pattern, to in rules:
        text = F.regexp_replace(text, pattern, to)
    return text


def token(category: Column, n: Column) -> Column:
    return F.format_string("%s%04d", F.upper(category), n)


def pareto_int(seed: int, most: int = 999) -> Column:
    """A whole number from a Pareto distribution of shape 1.16, redrawn by truncation at ``most``."""
    share = 1 - F.pow(F.lit(float(most + 1)), F.lit(-1.16))
    return F.floor(F.pow(1 - F.rand(seed) * share, F.lit(-1 / 1.16))).cast("int")
