"""Formats of translated paragraphs.

A paragraph is an array of runs. Rules look at the runs of the source and say what has to be formatted;
the translation, which has no formats, gets them as spans of its text, and spans become runs again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import pandas as pd
from pyspark.sql import DataFrame

#: Bracketed text, the mark of unnamed species, ends of sentences, ordinals.
BRACKETS = re.compile(r"\([^)]+\)")
SPECIES = re.compile(r"\b(spp?\.)$")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
ORDINALS = (re.compile(r"(\d+)(th|st|nd|rd)\b"), re.compile(r"(\d+)(e|er|ère)\b"))
ENGLISH_SUFFIXES = ("th", "st", "nd", "rd")
NUMBER = re.compile(r"[\d\s.,+\-−%]*\d[\d\s.,+\-−%]*")

FORMATS = ("bold", "italic", "underline", "superscript", "subscript")
RUN = "struct<text: string, bold: boolean, italic: boolean, underline: boolean, superscript: boolean, subscript: boolean>"


@dataclass(frozen=True)
class Run:
    text: str
    bold: bool = False
    italic: bool = False
    underline: bool = False
    superscript: bool = False
    subscript: bool = False

    def format(self) -> tuple[bool, ...]:
        return tuple(getattr(self, f) for f in FORMATS)

    def notes(self) -> str:
        return ", ".join(f for f in FORMATS if getattr(self, f))


@dataclass
class Target:
    """A translation, and the spans of it that have a format."""

    text: str
    spans: list[tuple[int, int, str]] = field(default_factory=list)

    def free(self, start: int, end: int) -> bool:
        return all(end <= a or b <= start for a, b, _ in self.spans)

    def runs(self) -> list[Run]:
        cuts = sorted({0, len(self.text), *(x for a, b, _ in self.spans for x in (a, b))})
        return [Run(self.text[a:b], **{f: True for s, e, f in self.spans if s <= a and b <= e}) for a, b in zip(cuts, cuts[1:], strict=False)]


def differs(runs: list[Run]) -> bool:
    """Whether a run that isn't blank has another format than the first."""
    return any(r.text.strip() and r.format() != runs[0].format() for r in runs[1:])


def merged(runs: list[Run]) -> list[Run]:
    """Neighbours of one format as one run; a tab stays by itself."""
    out: list[Run] = []
    for r in runs:
        if out and "\t" not in (out[-1].text, r.text) and out[-1].format() == r.format():
            out[-1] = replace(r, text=out[-1].text + r.text)
        else:
            out.append(r)
    return out


def tabs_apart(runs: list[Run]) -> list[Run]:
    """Each tab in a run of its own."""
    return [replace(r, text=t) for r in runs for t in re.split(r"(\t)", r.text) if t]


#: Rules by name: what the source has, and how the translation gets it. ``apply`` returns whether it could.
RULES: dict[str, tuple[Callable[[list[Run]], list], Callable[[Target, list], bool], str]] = {}


def rule(name: str, note: str, detect: Callable[[list[Run]], list], apply: Callable[[Target, list], bool]) -> None:
    """Add a rule; ``note`` is left where it can't be applied."""
    RULES[name] = (detect, apply, note)


def _raised_numbers(runs: list[Run]) -> list[str]:
    return [t for r in runs if r.superscript and (t := r.text.strip()) and NUMBER.fullmatch(t)]


def _raise_numbers(target: Target, numbers: list[str]) -> bool:
    for n in numbers:
        at = next((m.start() for m in re.finditer(re.escape(n), target.text) if target.free(m.start(), m.end())), None)
        if at is not None:
            target.spans.append((at, at + len(n), "superscript"))
    return True


def _ordinals(name: str) -> Callable[[list[Run]], list]:
    def detect(runs: list[Run]) -> list[str]:
        """Numbers whose English ordinal suffix has this format."""
        return [m.group(1) for before, r in zip(runs, runs[1:], strict=False) if getattr(r, name) and r.text.strip().lower() in ENGLISH_SUFFIXES and (m := re.search(r"(\d+)\s*\Z", before.text))]

    return detect


def _mark_ordinals(name: str) -> Callable[[Target, list], bool]:
    def apply(target: Target, numbers: list[str]) -> bool:
        found = 0
        for n in numbers:
            hits = (m.span(2) for p in ORDINALS for m in p.finditer(target.text) if m.group(1) == n and target.free(*m.span(2)))
            if span := next(hits, None):
                target.spans.append((*span, name))
                found += 1
        return found == len(numbers)

    return apply


def _italic_brackets(runs: list[Run]) -> list[int]:
    """[how many brackets are wholly italic], but for a species mark; none if one is so in part."""
    # blank runs between italic ones belong to them
    groups = [m.span() for m in re.finditer(r"i(?:b+i|i)*", "".join("b" if not r.text.strip() else "i" if r.italic else "o" for r in runs))]
    italic = ["".join(r.text for r in runs[a:b]) for a, b in groups]
    whole = 0
    for m in BRACKETS.finditer("".join(r.text for r in runs)):
        inner = m.group()[1:-1]
        if not any(t in inner for t in italic):
            continue
        for t in italic:
            inner = inner.replace(t, "")
        if inner.strip() and not SPECIES.search(inner.strip()):
            return []
        whole += 1
    return [whole] if whole else []


def _make_italic(target: Target, counts: list[int]) -> bool:
    """All brackets if there are as many, else those of the first sentence that has as many."""
    found = list(BRACKETS.finditer(target.text))
    if len(found) != counts[0]:
        ends = [*(m.start() for m in SENTENCE_END.finditer(target.text)), len(target.text)]
        starts = [0, *ends[:-1]]
        each = [[m for m in found if a <= m.start() < b] for a, b in zip(starts, ends, strict=True)]
        found = next((own for own in each if len(own) == counts[0]), []) if len(found) > counts[0] else []
    for m in found:
        inner = m.group()[1:-1]
        spp = SPECIES.search(inner)
        end = m.start() + 1 + len(inner[: spp.start()].rstrip() if spp else inner)
        if end > m.start() + 1:
            target.spans.append((m.start() + 1, end, "italic"))
    return bool(found)


rule("superscript numbers", "superscript number not found in the translation", _raised_numbers, _raise_numbers)
rule("superscript ordinals", "superscript ordinal not found in the translation", _ordinals("superscript"), _mark_ordinals("superscript"))
rule("subscript ordinals", "subscript ordinal not found in the translation", _ordinals("subscript"), _mark_ordinals("subscript"))
rule("italic brackets", "numbers of italic brackets differ after translation", _italic_brackets, _make_italic)


def restyled(runs: list[Run], translation: str) -> tuple[list[Run], list[str]]:
    """The translation's runs, and notes on what could not be carried over."""
    target, notes = Target(translation), []
    for detect, apply, note in RULES.values():
        if (wanted := detect(runs)) and not apply(target, wanted):
            notes.append(note)
    return target.runs() if translation else [], notes


def highlight(has_links: bool, has_notes: bool) -> str | None:
    """The colour of a paragraph that someone has to look at."""
    return {(True, True): "bright green", (True, False): "turquoise", (False, True): "yellow"}.get((has_links, has_notes))


def restyle_paragraphs(paragraphs: DataFrame, key: str) -> DataFrame:
    """(key, runs, notes, highlight, differs) from columns ``key``, runs (an array of RUN) and
    translation; a null translation has no runs, null runs have no format."""
    kinds = f"{key} {dict(paragraphs.dtypes)[key]}, runs array<{RUN}>, notes array<string>, highlight string, differs boolean"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, own, translation in zip(batch[key], batch["runs"], batch["translation"], strict=True):
                source = merged([Run(r["text"] or "", **{f: bool(r[f]) for f in FORMATS}) for r in (own if own is not None else [])])
                runs, notes = restyled(source, translation or "")
                rows.append((k, [dict(zip(("text", *FORMATS), (r.text, *r.format()), strict=True)) for r in runs], notes, highlight(False, bool(notes)), bool(source) and differs(source)))
            yield pd.DataFrame(rows, columns=[key, "runs", "notes", "highlight", "differs"])

    return paragraphs.select(key, "runs", "translation").mapInPandas(work, kinds)
