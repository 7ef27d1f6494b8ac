"""Changes to word-processor files: marks of language, links, fields, and translated paragraphs.

Each step works on the XML of one part; files are changed in the task that reads them.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

from bitloom.sources.docx import W, serialised

PART = re.compile(r"word/(document|header\d*|footer\d*)\.xml$")
#: Wrappers around runs that a translation doesn't keep.
WRAPPERS = ("smartTag", "hyperlink")


def unwrap(root: ElementTree.Element) -> list[str]:
    """Put what smart tags and links hold in their places; returns the texts of the links."""
    links = ["".join(t.text or "" for t in e.iter(f"{W}t")) for e in root.iter(f"{W}hyperlink")]
    for parent in list(root.iter()):
        while wrapped := [c for c in parent if c.tag.removeprefix(W) in WRAPPERS]:
            at = list(parent).index(wrapped[0])
            parent.remove(wrapped[0])
            for k, inner in enumerate(x for x in wrapped[0] if not x.tag.endswith("Pr")):
                parent.insert(at + k, inner)
    return links


def drop_open_fields(p: ElementTree.Element) -> int:
    """Remove the marks of fields that begin or end in another paragraph; returns how many."""
    marks = [(r, m.get(f"{W}fldCharType")) for r in p.iter(f"{W}r") if (m := r.find(f"{W}fldChar")) is not None]
    kept, open_ = set(), []
    for k, (_, kind) in enumerate(marks):
        if kind == "begin":
            open_.append([k])
        elif open_:
            open_[-1].append(k)
            if kind == "end":
                kept.update(open_.pop())
    gone = [r for k, (r, _) in enumerate(marks) if k not in kept]
    for parent in list(p.iter()):
        for r in gone:
            if r in list(parent):
                parent.remove(r)
    return len(gone)


def is_field(p: ElementTree.Element) -> bool:
    """Whether all of a paragraph's text is the content of fields."""
    depth, inside, outside = 0, False, False
    for r in p.iter(f"{W}r"):
        mark = r.find(f"{W}fldChar")
        if mark is not None:
            depth += {"begin": 1, "end": -1}.get(mark.get(f"{W}fldCharType"), 0)
        elif "".join(t.text or "" for t in r.iter(f"{W}t")).strip():
            inside, outside = inside or depth > 0, outside or depth <= 0
    return inside and not outside


def set_language(root: ElementTree.Element, lang: str) -> None:
    """Mark every run as text in ``lang``."""
    for r in root.iter(f"{W}r"):
        properties = r.find(f"{W}rPr")
        if properties is None:
            properties = ElementTree.Element(f"{W}rPr")
            r.insert(0, properties)
        mark = properties.find(f"{W}lang")
        if mark is None:
            mark = ElementTree.SubElement(properties, f"{W}lang")
        mark.set(f"{W}val", f"{lang}-CA")


def _set_text(r: ElementTree.Element, text: str) -> None:
    """The run's text, its line breaks as breaks."""
    for e in [x for x in r if x.tag in (f"{W}t", f"{W}br", f"{W}cr")]:
        r.remove(e)
    for k, line in enumerate(text.split("\n")):
        if k:
            ElementTree.SubElement(r, f"{W}br")
        if line:
            t = ElementTree.SubElement(r, f"{W}t")
            t.text = line
            t.set("{http://www.w3.org/XML/1998/namespace}space", "preserve")


def translate_paragraph(p: ElementTree.Element, translate: Callable[[str], str]) -> None:
    """Each stretch between tabs is translated as a whole and stands in its first run; paragraphs that
    are fields only, or blank, stay as they are."""
    drop_open_fields(p)
    if is_field(p):
        return
    group: list[ElementTree.Element] = []

    def flush() -> None:
        text = "".join((e.text or "") if e.tag == f"{W}t" else "\n" for r in group for e in r if e.tag in (f"{W}t", f"{W}br", f"{W}cr"))
        if text.strip():
            for k, r in enumerate(group):
                _set_text(r, translate(text) if k == 0 else "")
        group.clear()

    for r in list(p.iter(f"{W}r")):
        if r.find(f"{W}tab") is not None:
            flush()
        elif r.find(f"{W}t") is not None:
            group.append(r)
    flush()


def translated(content: bytes, translate: Callable[[str], str], lang: str) -> tuple[bytes, list[str]]:
    """The file in the other language, and the texts of the links it had."""
    out, links = io.BytesIO(), []
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            data = old.read(name)
            if PART.match(name):
                root = ElementTree.fromstring(data)
                links += unwrap(root)
                for p in root.iter(f"{W}p"):
                    translate_paragraph(p, translate)
                set_language(root, lang)
                data = serialised(root, data)
            new.writestr(name, data)
    return out.getvalue(), links


def translate_files(documents: DataFrame, translate: Callable[[str], str], lang: str) -> DataFrame:
    """(path, content, links) of files (path, content); one that is no archive has null content."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows.append((path, *translated(content, translate, lang)))
                except (zipfile.BadZipFile, ElementTree.ParseError):
                    rows.append((path, None, []))
            yield pd.DataFrame(rows, columns=["path", "content", "links"])

    return documents.select("path", "content").mapInPandas(work, "path string, content binary, links array<string>")
