"""Evaluation passages in corpus documents (problem 9).

The texts of evaluation items, in either language, are a bounded query set; each task indexes its
documents, shard by shard, in an FM-index over word codes, searches every phrase of PHRASE words of
every item, and locates the occurrences. Documents where phrases of an item cover enough of it are
then compared with it word by word. No shuffle.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.llm.fmindex import FMIndex
from bitloom.plans.materialize import checkpointed

#: One word in fifteen may differ, so a passage has runs of at least this many words without error.
PHRASE = 7
#: Words of the passages by which an item is revealed: half of it, less one word in fifteen of these.
LEAST = 0.5 * (1 - 1 / 15)
#: A passage: at least so many words of the item in a row, and so much of them equal.
PASSAGE_WORDS, PASSAGE_EQUAL = 10, 0.8
#: Words between two equal runs of a passage; the shortest equal run.
GAP, RUN = 4, 3
#: Share of an item's words that phrases must cover before it is compared.
SEEDED = 0.2
#: A word is rare if at most this share of the items has it (or only one has). So much of an item's
#: rare words must be in its passages: sentences of the same wording about something else lack them.
#: Where passages of LONG words, which is more than a sentence, or one passage hold enough of the item,
#: so much of the rare words of their own places must be: half an item need not have its rare words.
RARE_SHARE, RARE_LEAST, LONG = 0.02, 0.3, 30
SHARD_WORDS = 400_000
#: Items searched in one pass over the documents; more items are searched in further passes.
ITEM_BLOCK = 4_000

WORD = re.compile(r"\w+")
HYPHEN = re.compile(r"(?<=\w)[-‐­][ \t]*\n\s*(?=\w)|[­​]")
OTHER = 2  # 0: end, 1: between documents


def plain(text: str) -> str:
    """Folded text with words divided at line ends put together."""
    return HYPHEN.sub("", text).casefold()


def usual_words(items: DataFrame) -> frozenset[str]:
    """Words that aren't rare among all the items. Each is in more than RARE_SHARE of them, so there are
    at most 1 / RARE_SHARE times as many as an item has words on average."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(i, w) for i, *sides in zip(batch["item_id"].tolist(), batch["source_text"], batch["target_text"], strict=True) for w in {w for t in sides if t for w in WORD.findall(plain(t))}], columns=["item_id", "word"])

    each = checkpointed(items.select("item_id", "source_text", "target_text").mapInPandas(cut, "item_id long, word string").distinct())
    common = max(1, RARE_SHARE * each.select("item_id").distinct().count())
    return frozenset(r["word"] for r in each.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > common).collect())


class Items:
    """Coded texts of the items, and their phrases in a matrix."""

    def __init__(self, items: list[tuple[int, str]], usual: frozenset[str]) -> None:
        self.codes: dict[str, int] = {}
        self.ids, self.texts = [], []
        for item, text in items:
            words = WORD.findall(plain(text))
            if words:
                self.ids.append(item)
                self.texts.append(np.array([self.codes.setdefault(w, len(self.codes) + OTHER + 1) for w in words], np.int64))
        self.bits = max(2, int(len(self.codes) + OTHER + 1).bit_length())
        rare = np.ones(len(self.codes) + OTHER + 1, bool)
        rare[[c for w, c in self.codes.items() if w in usual]] = False
        self.rare = [rare[t] for t in self.texts]
        phrases: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for k, t in enumerate(self.texts):
            q = min(PHRASE, len(t))
            for i in range(len(t) - q + 1):
                phrases[tuple(t[i : i + q].tolist())].append((k, i))
        self.by_length = []
        for q in sorted({len(p) for p in phrases}):
            own = [(p, at) for p, at in phrases.items() if len(p) == q]
            size = np.array([len(at) for _, at in own])
            flat = np.array([x for _, at in own for x in at], np.int64).reshape(-1, 2)
            self.by_length.append((q, np.array([p for p, _ in own], np.int64), np.concatenate(([0], np.cumsum(size))), flat))
        self.grams: dict[int, dict] = {}

    def runs(self, k: int) -> dict:
        """Positions of the RUN-word runs of text k."""
        if k not in self.grams:
            own = defaultdict(list)
            t = self.texts[k].tolist()
            for i in range(len(t) - RUN + 1):
                own[tuple(t[i : i + RUN])].append(i)
            self.grams[k] = own
        return self.grams[k]


def passages(items: Items, k: int, doc: list[int], around: list[tuple[int, int]]) -> list[tuple[int, int, int, int, list]]:
    """(first item word, last + 1, first document word, last + 1, equal runs in item words) of each
    passage of text k in ``doc``, looked for in the ranges of words ``around``."""
    t, grams, blocks = items.texts[k].tolist(), items.runs(k), []
    for low, high in around:
        ends: dict[int, int] = {}  # diagonal -> end of its last block
        for d in range(low, min(high, len(doc)) - RUN + 1):
            for i in grams.get((doc[d], doc[d + 1], doc[d + 2]), ()):
                if ends.get(d - i, -1) > d:
                    continue
                n = RUN
                while i + n < len(t) and d + n < len(doc) and t[i + n] == doc[d + n]:
                    n += 1
                ends[d - i] = d + n - RUN + 1
                blocks.append((d, i, n))
    blocks.sort()
    best: list[tuple[int, int, int]] = []  # equal words, first block, previous block
    found, used = [], set()
    for b, (d, i, n) in enumerate(blocks):
        mine = (n, b, -1)
        for a in range(b - 1, max(-1, b - 12), -1):
            d0, i0, n0 = blocks[a]
            over = max(0, d0 + n0 - d, i0 + n0 - i)
            if -GAP <= d0 + n0 - d <= 1 and -GAP <= i0 + n0 - i <= 1 and best[a][0] + n - over > mine[0]:
                mine = (best[a][0] + n - over, best[a][1], a)
        best.append(mine)
    for b in sorted(range(len(blocks)), key=lambda b: -best[b][0]):
        chain, a = [], b
        while a >= 0 and a not in used:
            chain.append(a)
            a = best[a][2]
        if not chain:
            continue
        used.update(chain)
        d1, i1, n1 = blocks[b]
        d0, i0, _ = blocks[chain[-1]]
        span = max(i1 + n1 - i0, d1 + n1 - d0)
        equal = sum(blocks[x][2] for x in chain)
        if i1 + n1 - i0 >= min(PASSAGE_WORDS, len(t)) and equal >= PASSAGE_EQUAL * span:
            found.append((i0, i1 + n1, d0, d1 + n1, [blocks[x][1:] for x in chain]))
    return found


def _shard(items: Items, texts: list[str], least: float) -> Iterator[tuple[int, int, list]]:
    """(document, item text, passages) in a shard of documents."""
    get = items.codes.get
    coded = [[get(w, OTHER) for w in WORD.findall(plain(t))] for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(c) + 1 for c in coded])))
    whole = np.ones(starts[-1], np.int64)
    for s, c in zip(starts, coded, strict=False):
        whole[s : s + len(c)] = c
    # A run of words that no item has counts as one.
    kept = np.flatnonzero(np.concatenate(([True], (whole[1:] != OTHER) | (whole[:-1] != OTHER))))
    index = FMIndex(whole[kept], items.bits)
    rows, which = [], []
    for _, phrases, offsets, flat in items.by_length:
        low, high = index.search(phrases)
        size = high - low
        hit = np.flatnonzero(size)
        if not len(hit):
            continue
        size = size[hit]
        row = np.repeat(low[hit], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = kept[index.locate(row)]
        phrase = np.repeat(hit, size)
        n = offsets[phrase + 1] - offsets[phrase]
        place = np.repeat(offsets[phrase], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows.append(np.repeat(at, n))
        which.append(flat[place])
    if not rows:
        return
    at, which = np.concatenate(rows), np.concatenate(which)
    doc = np.searchsorted(starts, at, side="right") - 1
    # How many different words of each item text the phrases cover in each document.
    longest = max(len(t) for t in items.texts)
    pair = doc * len(items.texts) + which[:, 0]
    cells = np.unique((pair * longest + which[:, 1])[:, None] + np.arange(PHRASE)[None, :])
    pairs, covered = np.unique(cells // longest, return_counts=True)
    lengths = np.array([len(t) for t in items.texts])
    need = np.minimum(np.maximum(PASSAGE_WORDS, SEEDED * lengths), lengths)
    good = pairs[covered >= need[pairs % len(items.texts)]]
    order = np.argsort(pair, kind="stable")
    spair, sat = pair[order], at[order]
    for p in good.tolist():
        d, k = divmod(p, len(items.texts))
        m = len(items.texts[k])
        own = np.sort(sat[np.searchsorted(spair, p) : np.searchsorted(spair, p, side="right")]) - starts[d]
        around: list[tuple[int, int]] = []
        for x in own.tolist():
            low, high = max(0, x - m - GAP), x + m + GAP + PHRASE
            if around and low <= around[-1][1]:
                around[-1] = (around[-1][0], high)
            else:
                around.append((low, high))
        got = passages(items, k, coded[d], around)
        words, equal, long = np.zeros(m, bool), np.zeros(m, bool), np.zeros(m, bool)
        for i0, i1, _, _, runs in got:
            words[i0:i1] = True
            if i1 - i0 >= min(LONG, least * m):
                long[i0:i1] = True
            for i, n in runs:
                equal[i : i + n] = True
        rare = items.rare[k]
        whole = long.sum() >= least * m and (equal & rare & long).sum() >= RARE_LEAST * (rare & long).sum()
        if got and words.sum() >= least * m and (whole or rare.sum() < 4 or (equal & rare).sum() >= RARE_LEAST * rare.sum()):
            yield d, k, got


def _spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points of merged ranges of words of ``text``."""
    # Word places of the text as it is, where a divided word is put together again.
    places, end, cut = [], -1, {m.end() for m in HYPHEN.finditer(text)}
    for m in WORD.finditer(text):
        if places and m.start() in cut and end >= 0:
            places[-1] = (places[-1][0], m.end())
        else:
            places.append(m.span())
        end = m.end()
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if a >= len(places):
            continue
        s, e = places[a][0], places[min(b, len(places)) - 1][1]
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def leak_spans(documents: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, start_pos, end_pos): merged spans to remove, per document and item.

    Null and empty texts reveal nothing; a document given twice comes out twice; an item with fewer
    words than PHRASE counts if all its words stand in a row. Items, the stated query set, come to the
    driver block by block of about ITEM_BLOCK; documents never do.
    """
    items = items.where(F.col("item_id").isNotNull())
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    usual = documents.sparkSession.sparkContext.broadcast(usual_words(items))
    schema = "doc_id long, item_id long, start_pos int, end_pos int"
    out = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).select("item_id", "source_text", "target_text").orderBy("item_id").collect()
        shared = documents.sparkSession.sparkContext.broadcast([(r["item_id"], r[side]) for r in own for side in ("source_text", "target_text") if r[side]])

        def find(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            known = Items(shared.value, usual.value)
            if not known.texts:
                return
            for batch in batches:
                ids, texts = batch["doc_id"].tolist(), batch["text"].tolist()
                begin = 0
                while begin < len(texts):
                    end, words = begin, 0
                    while end < len(texts) and (end == begin or words + len(texts[end]) // 5 <= SHARD_WORDS):
                        words += len(texts[end]) // 5
                        end += 1
                    found: dict[tuple[int, int], list] = defaultdict(list)
                    for d, k, got in _shard(known, texts[begin:end], least):
                        found[begin + d, known.ids[k]] += [(x[2], x[3]) for x in got]
                    rows = [(ids[d], item, *span) for (d, item), ranges in found.items() for span in _spans(texts[d], ranges)]
                    if rows:
                        yield pd.DataFrame(rows, columns=["doc_id", "item_id", "start_pos", "end_pos"])
                    begin = end

        part = documents.select("doc_id", "text").where(F.length("text") > 0).mapInPandas(find, schema)
        if blocks > 1:  # so that the driver holds one block of items at a time
            part = checkpointed(part)
            shared.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def found_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    return leak_spans(documents, items).select("doc_id", "item_id").distinct()
