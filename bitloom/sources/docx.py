"""Word-processor files as rows: one pass over each file's XML, in the task that reads it."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
ELEMENTS = "path string, ord int, kind string, loc_id string, tbl int, `row` int, cell int, text string"
RUNS = "path string, ord int, run int, text string, bold boolean, italic boolean, underline boolean, superscript boolean, subscript boolean, colour string, deleted boolean, inserted boolean"


ElementTree.register_namespace("w", W[1:-1])


def serialised(root: ElementTree.Element, original: bytes) -> bytes:
    """The XML of ``root`` with all prefixes that ``original`` declares, which attributes may name."""
    head = original[: original.find(b">", original.find(b"<", original.find(b"?>") + 1)) + 1].decode("utf-8", "replace")
    declared = dict(re.findall(r'xmlns:([A-Za-z_][\w.-]*)="([^"]*)"', head))
    for prefix, uri in declared.items():
        if not re.fullmatch(r"ns\d+", prefix):
            ElementTree.register_namespace(prefix, uri)
    data = ElementTree.tostring(root, encoding="utf-8", xml_declaration=True)
    start = data.find(b"<", data.find(b"?>") + 1)
    end = data.find(b">", start)
    missing = "".join(f' xmlns:{prefix}="{uri}"' for prefix, uri in declared.items() if f"xmlns:{prefix}=".encode() not in data[start:end])
    end -= data[end - 1 : end] == b"/"
    return data[:end] + missing.encode() + data[end:]


def paragraph_text(p: ElementTree.Element) -> str:
    """Text of a paragraph, without deleted text; tabs and breaks as characters."""
    out = []
    for e in p.iter():
        if e.tag == f"{W}t":
            out.append(e.text or "")
        elif e.tag == f"{W}tab":
            out.append("\t")
        elif e.tag in (f"{W}br", f"{W}cr"):
            out.append("\n")
    return "".join(out)


def parts(content: bytes) -> Iterator[tuple[str, ElementTree.Element]]:
    """('body' | 'header' | 'footer', root) of each part; a part that is linked twice comes once."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = z.namelist()
        if "word/document.xml" in names:
            yield "body", ElementTree.fromstring(z.read("word/document.xml"))
        for kind in ("header", "footer"):
            own = [n for n in names if re.match(rf"word/{kind}\d*\.xml$", n)]
            for name in sorted(own, key=lambda n: int(re.search(r"(\d*)\.xml$", n).group(1) or 0)):
                yield kind, ElementTree.fromstring(z.read(name))


def elements(content: bytes) -> Iterator[tuple]:
    """(kind, loc_id, table, row, cell, text) in document order: paragraphs P{i}, table rows' cells
    T{t}-R{r}, header and footer paragraphs H{n} and F{n}. P counts blank paragraphs, which have no
    row; H and F count only those that aren't blank."""
    counters = {"P": 0, "T": 0, "H": 0, "F": 0}
    for kind, root in parts(content):
        if kind == "body":
            for e in root.find(f"{W}body") if root.find(f"{W}body") is not None else ():
                if e.tag == f"{W}p":
                    text = paragraph_text(e)
                    if text.strip():
                        yield "paragraph", f"P{counters['P']}", None, None, None, text
                    counters["P"] += 1
                elif e.tag == f"{W}tbl":
                    for r, row in enumerate(e.iter(f"{W}tr")):
                        for c, cell in enumerate(row.findall(f"{W}tc")):
                            text = "\n".join(filter(str.strip, map(paragraph_text, cell.iter(f"{W}p"))))
                            if text:
                                yield "cell", f"T{counters['T']}-R{r}", counters["T"], r, c, text
                    counters["T"] += 1
        else:
            mark = "H" if kind == "header" else "F"
            for p in root.iter(f"{W}p"):
                if (text := paragraph_text(p)).strip():
                    yield kind, f"{mark}{counters[mark]}", None, None, None, text
                    counters[mark] += 1


def _on(properties: ElementTree.Element | None, tag: str) -> bool:
    e = None if properties is None else properties.find(f"{W}{tag}")
    return e is not None and e.get(f"{W}val", "true") not in ("0", "false", "none")


def runs(content: bytes) -> Iterator[tuple]:
    """(paragraph, run, text, attributes) of each run of the body, with whether it is a tracked
    deletion or insertion."""
    for kind, root in parts(content):
        if kind != "body":
            continue
        for i, p in enumerate(root.iter(f"{W}p")):
            k = 0
            for holder, deleted, inserted in [(p, False, False), *((e, True, False) for e in p.iter(f"{W}del")), *((e, False, True) for e in p.iter(f"{W}ins"))]:
                for r in holder.findall(f"{W}r"):
                    pr = r.find(f"{W}rPr")
                    align = None if pr is None or pr.find(f"{W}vertAlign") is None else pr.find(f"{W}vertAlign").get(f"{W}val")
                    colour = None if pr is None or pr.find(f"{W}color") is None else pr.find(f"{W}color").get(f"{W}val")
                    text = "".join((e.text or "") for e in r.iter() if e.tag in (f"{W}t", f"{W}delText"))
                    yield i, k, text, _on(pr, "b"), _on(pr, "i"), _on(pr, "u"), align == "superscript", align == "subscript", colour, deleted, inserted
                    k += 1


def language(content: bytes) -> str | None:
    """fr or en, by the first language mark of the runs, else of the styles."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in ("word/document.xml", "word/styles.xml"):
            if name in z.namelist() and (m := re.search(rb'<w:lang[^>]*w:val="(fr|en)', z.read(name))):
                return m.group(1).decode()
    return None


def accept_changes(content: bytes) -> tuple[bytes, dict[str, int]]:
    """The file with insertions kept and deletions and marks of changed formats removed, and counts."""
    counts = {"ins": 0, "del": 0, "rPrChange": 0, "pPrChange": 0}
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            data = old.read(name)
            if re.match(r"word/(document|header\d*|footer\d*)\.xml$", name):
                root = ElementTree.fromstring(data)
                for parent in list(root.iter()):
                    for child in list(parent):
                        tag = child.tag.removeprefix(W)
                        if tag not in counts:
                            continue
                        counts[tag] += 1
                        at = list(parent).index(child)
                        parent.remove(child)
                        if tag == "ins":
                            for k, inner in enumerate(list(child)):
                                parent.insert(at + k, inner)
                data = serialised(root, data)
            new.writestr(name, data)
    return out.getvalue(), counts


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of all files below ``path`` that aren't lock files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.docx").load(path).select("path", "content").where(~F.col("path").rlike(r"/~\$[^/]*\z"))


def read_elements(documents: DataFrame) -> DataFrame:
    """A row per paragraph or cell that isn't blank, in order. A file that is no archive has no rows."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = [(path, k, *e) for k, e in enumerate(elements(content))]
                except (zipfile.BadZipFile, ElementTree.ParseError):
                    rows = []
                yield pd.DataFrame(rows, columns=["path", "ord", "kind", "loc_id", "tbl", "row", "cell", "text"]).astype({"tbl": "Int32", "row": "Int32", "cell": "Int32"})

    return documents.mapInPandas(read, ELEMENTS)


def read_runs(documents: DataFrame) -> DataFrame:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = [(path, *r) for r in runs(content)]
                except (zipfile.BadZipFile, ElementTree.ParseError):
                    rows = []
                yield pd.DataFrame(rows, columns=["path", "ord", "run", "text", "bold", "italic", "underline", "superscript", "subscript", "colour", "deleted", "inserted"])

    return documents.mapInPandas(read, RUNS)


def document_texts(rows: DataFrame) -> DataFrame:
    """(path, text, located): plain text, and with location marks; cells of a table row are one line."""
    lines = rows.groupBy("path", "loc_id").agg(F.min("ord").alias("ord"), F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("x"))
    lines = lines.select("path", "ord", "loc_id", F.transform("x", lambda e: e["text"]).alias("t"))
    each = F.array_sort(F.collect_list(F.struct("ord", "loc_id", "t")))
    return lines.groupBy("path").agg(each.alias("l")).select("path", F.array_join(F.flatten(F.transform("l", lambda e: e["t"])), "\n").alias("text"), F.array_join(F.transform("l", lambda e: F.concat(F.lit("["), e["loc_id"], F.lit("] "), F.array_join(e["t"], " | "))), "\n").alias("located"))


def built(paragraphs: list[str], lang: str = "en", header: str | None = None) -> bytes:
    """A file with these paragraphs, marked as text in ``lang``, and a header if there is one."""
    space = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    allowed = lambda t: escape(re.sub(r"[^\t\n\r\x20-\ud7ff\ue000-\ufffd\U00010000-\U0010ffff]", "", t))
    text = lambda t: f'<w:p><w:r><w:rPr><w:lang w:val="{lang}-CA"/></w:rPr><w:t xml:space="preserve">{allowed(t)}</w:t></w:r></w:p>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("word/document.xml", f"<w:document {space}><w:body>{''.join(map(text, paragraphs))}</w:body></w:document>")
        if header is not None:
            z.writestr("word/header1.xml", f"<w:hdr {space}>{text(header)}</w:hdr>")
    return out.getvalue()


def as_files(rows: DataFrame, key: str, order: str, text: str, lang: str = "en") -> DataFrame:
    """(path, content): a file per ``key`` with its texts in order and the key as header. A file is made
    in one task, as it has to be held as a whole; null texts and keys are left out."""

    def make(own: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(own[0], built(group.sort_values(order, kind="stable")[text].tolist(), lang, own[0]))], columns=["path", "content"])

    given = rows.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("string").alias("path"), order, text)
    return given.groupBy("path").applyInPandas(make, "path string, content binary")


def languages(documents: DataFrame) -> DataFrame:
    """(path, lang) of files by their language marks; null of files without any."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for content in batch["content"]:
                try:
                    found.append(language(content))
                except zipfile.BadZipFile:
                    found.append(None)
            yield pd.DataFrame({"path": batch["path"], "lang": pd.Series(found, dtype="object")})

    return documents.select("path", "content").mapInPandas(read, "path string, lang string")
