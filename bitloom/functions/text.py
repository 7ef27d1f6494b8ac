"""Column functions that clean, split and put together text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Abbreviations whose point does not end a sentence.
ABBREVIATIONS = (
    "al apr approx assn aug ave avr blvd bros ca cf ch cit co col corp dec dept dr ed eds eg env et etc feb fig figs ft gen gov govt hon ibid ie inc intl "
    "jan janv jr juil jul jun loc lt ltd m mar me mgr misc mlle mme mr mrs ms mt natl no nos nov oct op pg pgs pp pr prof rd rev sec sep sept seq sr st ste viz vol vols vs"
).split()
#: Abbreviations of several tokens.
SPACED_ABBREVIATIONS = (r"p\.\s*ex\.", r"a\.\s*m\.", r"p\.\s*m\.", r"p\.\s*r\.\s*a\.", r"c\.-?[aà]-?d\.", r"n\.\s*b\.", r"p\.\s*s\.")
LABEL = r"(?:Figure|Fig|Table|Tableau)"
PARAGRAPH_MARK = "###PARAGRAPH_BREAK_MARKER###"
#: Longest line that is one paragraph chunk.
PARAGRAPH_CHARS = 600
_HELD = "\x01"


def clean_text(text: Column) -> Column:
    """Straight quotes; other characters than Latin letters, digits and usual marks become spaces;
    white space is single and trimmed. Null stays null."""
    quoted = F.translate(text, "“”„«»‘’‚", "\"\"\"\"\"'''")
    kept = F.regexp_replace(quoted, r"[^a-zA-ZÀ-ÖØ-öø-ÿ0-9.,;:!?()'\"-]", " ")
    return F.trim(F.regexp_replace(kept, " +", " "))


def split_sentences(text: Column) -> Column:
    """Sentences, with points of abbreviations and dotted acronyms protected.

    A point is held back where an abbreviation is followed by white space, and inside acronyms and
    abbreviations of several tokens; the text is then split after end marks with their closers.
    """
    held = text
    for form in SPACED_ABBREVIATIONS:
        # every point of the form: at most three of them
        parts = form.split(r"\.")
        groups = "".join(f"({p})" + r"\." for p in parts[:-1])
        held = F.regexp_replace(held, f"(?iu){groups}", "".join(f"${i + 1}{_HELD}" for i in range(len(parts) - 1)))
    held = F.regexp_replace(held, r"\b([A-Z])\.(?=-?[A-ZÀ-ÖØ-Þ]\.)", f"$1{_HELD}")
    held = F.regexp_replace(held, rf"(?<={_HELD})(-?[A-ZÀ-ÖØ-Þ])\.", f"$1{_HELD}")
    held = F.regexp_replace(held, rf"(?i)\b({'|'.join(sorted(ABBREVIATIONS, key=len, reverse=True))})\.(?=\s)", f"$1{_HELD}")
    cut = F.split(F.regexp_replace(held, "([.?!][\"'»”’]*)\\s+", "$1\x02"), "\x02")
    return F.filter(F.transform(cut, lambda x: F.trim(F.replace(x, F.lit(_HELD), F.lit(".")))), lambda x: x != "")


def split_dropping_marks(text: Column) -> Column:
    """Sentences without their end marks; a mark after ; or , does not count."""
    return F.filter(F.transform(F.split(text, r"(?<![;,])[.?!]\s"), lambda x: F.trim(x)), lambda x: x != "")


def of_length(pieces: Column, low: int, high: int) -> Column:
    return F.filter(pieces, lambda x: F.length(x).between(low, high))


def append_period(text: Column) -> Column:
    return F.when(text.rlike(r"[.!?]\z"), text).otherwise(F.concat(text, F.lit(".")))


def label_sentences(text: Column) -> Column:
    """Sentences, with the point of a figure or table label protected."""
    held = F.regexp_replace(text, rf"(?i)\b({LABEL})\.(\s*[0-9]+)", f"$1{_HELD}$2")
    held = F.regexp_replace(held, rf"(?i)\b({LABEL}{_HELD}?\s*[0-9]+)\.", f"$1{_HELD}")
    return F.transform(F.split(F.regexp_replace(held, r"([.!?])\s+", "$1\x02"), "\x02"), lambda x: F.replace(x, F.lit(_HELD), F.lit(".")))


def label_prefix(text: Column) -> Column:
    """struct(label, rest): a leading figure or table label with a point after its number; null label
    and the whole text without one."""
    pattern = rf"(?is)\A({LABEL}\.?\s*[0-9]+)\.\s+(.*)\z"
    has = text.rlike(pattern)
    return F.struct(F.when(has, F.concat(F.regexp_extract(text, pattern, 1), F.lit("."))).alias("label"), F.when(has, F.regexp_extract(text, pattern, 2)).otherwise(text).alias("rest"))


def ensure_label_period(label: Column) -> Column:
    pattern = rf"(?i)\A({LABEL}\.?\s*[0-9]+)(?![0-9.])"
    ends = F.rtrim(label)
    return F.when(label.rlike(pattern), F.regexp_replace(label, pattern, "$1.")).when(ends.endswith("."), label).otherwise(F.concat(ends, F.lit(".")))


def sentence_chunks(text: Column) -> Column:
    """array of struct(line_idx, sent_idx, text, is_last_in_line, is_empty): sentences of each line;
    a blank line is one empty chunk."""
    def of_line(line: Column, i: Column) -> Column:
        def numbered(pieces: Column) -> Column:
            return F.transform(pieces, lambda x, k: F.struct(i.cast("int").alias("line_idx"), k.cast("int").alias("sent_idx"), F.trim(x).alias("text"), (k == F.size(pieces) - 1).alias("is_last_in_line"), F.lit(False).alias("is_empty")))

        # the array around the sentences binds them, so that they are split once
        full = F.filter(F.transform(F.array(label_sentences(line)), numbered)[0], lambda c: c["text"] != "")
        empty = F.array(F.struct(i.cast("int").alias("line_idx"), F.lit(0).alias("sent_idx"), F.lit("").alias("text"), F.lit(True).alias("is_last_in_line"), F.lit(True).alias("is_empty")))
        return F.when(F.trim(line) == "", empty).otherwise(full)

    return F.flatten(F.transform(F.split(text, "\n"), of_line))


def paragraph_chunks(text: Column) -> Column:
    """Like :func:`sentence_chunks`, but a line of up to PARAGRAPH_CHARS characters is one chunk."""
    def of_line(line: Column, i: Column) -> Column:
        whole = F.array(F.struct(i.cast("int").alias("line_idx"), F.lit(0).alias("sent_idx"), F.trim(line).alias("text"), F.lit(True).alias("is_last_in_line"), (F.trim(line) == "").alias("is_empty")))
        parts = F.transform(sentence_chunks(line), lambda c: F.struct(i.cast("int").alias("line_idx"), c["sent_idx"].alias("sent_idx"), c["text"].alias("text"), c["is_last_in_line"].alias("is_last_in_line"), c["is_empty"].alias("is_empty")))
        return F.when(F.length(line) <= PARAGRAPH_CHARS, whole).otherwise(parts)

    return F.flatten(F.transform(F.split(text, "\n"), of_line))


def chunks(text: Column, by: str = "sentences") -> Column:
    return paragraph_chunks(text) if by == "paragraphs" else sentence_chunks(text)


def reassemble(pieces: Column) -> Column:
    """Text of chunks: those of a line joined by a space, lines by a line break, in order."""
    start = F.struct(F.lit(-1).alias("line"), F.lit("").alias("text"))
    joined = F.aggregate(F.array_sort(pieces), start, lambda s, c: F.struct(c["line_idx"].alias("line"), F.concat(s["text"], F.when(s["line"] == -1, "").when(s["line"] == c["line_idx"], " ").otherwise("\n"), c["text"]).alias("text")))
    return joined["text"]


def flatten_with_marks(paragraphs: Column) -> Column:
    """Sentences of paragraphs in one array, with a mark after each paragraph that has any."""
    return F.flatten(F.transform(paragraphs, lambda p: F.when(F.size(p) > 0, F.concat(p, F.array(F.lit(PARAGRAPH_MARK)))).otherwise(p)))


def straight_apostrophes(text: Column) -> Column:
    return F.translate(text, "‘’", "''")


def unified_spaces(text: Column) -> Column:
    """Straight quotes; runs of any space separators are one space."""
    return F.regexp_replace(F.translate(text, "“”„‘’‚", "\"\"\"'''"), r"[\p{Zs}\x{FEFF}]+", " ")


def without_boilerplate(text: Column) -> Column:
    """Model output without lead-ins and a closing remark about the translation."""
    out = text
    for pattern in (r"^(Here is the translation|Voici la traduction)[:\s]*", r"^(Translation|Traduction)[:\s]*", r"^(The translation is|La traduction est)[:\s]*", r"\s*\([^)]*translation[^)]*\)\s*$"):
        out = F.trim(F.regexp_replace(out, "(?iu)" + pattern, ""))
    return out


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def without_markup(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "/([^/]+)/", "$1"), r"[_^]\{([^}]*)\}", "$1")


def has_markup(text: Column) -> Column:
    return text.rlike(r"/[^/]+/|_\{|\^\{")


def document_of_file(stem: Column) -> Column:
    """struct(document_name, lang, is_erratum) of a file name; nulls if it names no language."""
    low = F.lower(stem)
    lang = F.when(low.rlike("english"), "en").when(low.rlike("french"), "fr")
    rest = F.regexp_replace(F.regexp_replace(stem, "(?i)erratum|english|french", " "), r"\s+", " ")
    name = F.regexp_replace(F.regexp_replace(rest, r"\A[ _-]+", ""), r"[ _-]+\z", "")
    return F.struct(F.when(lang.isNotNull(), name).alias("document_name"), lang.alias("lang"), low.contains("erratum").alias("is_erratum"))


def checkpoint_name(stem: Column, suffix: str, known: tuple[str, ...]) -> Column:
    """``stem`` with its known step suffix, if any, replaced by ``suffix``."""
    return F.concat(F.regexp_replace(stem, f"({'|'.join(known)})\\z", ""), F.lit(suffix))
