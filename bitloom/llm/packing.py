"""Texts in containers of fixed capacity (problem 8).

Each task measures its texts in tokens and packs them in windows by Karmarkar-Karp multiway
differencing: partial partitions are merged so that their imbalances oppose each other. If a
container of a window exceeds the capacity, the window gets one container more. No shuffle.
"""

from __future__ import annotations

import base64
import heapq
import os
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: how the public tokenizer divides text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts (or pieces of texts) that are packed together; the emptiest container of a window is
#: opened again and goes into the next.
WINDOW = 192

_encoders: dict[tuple[str, str], object] = {}


def encoder(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    """The public tokenizer whose ranks are in ``folder``; read once per process."""
    key = (folder, vocabulary)
    if key not in _encoders:
        import tiktoken

        with open(os.path.join(folder, vocabulary), "rb") as ranks:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks)}
        _encoders[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return _encoders[key]


def _kind(c: str) -> str:
    return "space" if c.isspace() else unicodedata.category(c)[0]


def _boundary(text: str, at: int) -> bool:
    """Whether the tokenizer begins a word at ``at`` whatever comes before: white space, digits or
    punctuation directly after something else than these and than white space."""
    a, b = _kind(text[at - 1]), _kind(text[at])
    return a != "space" and a != b and (b == "space" or {a, b} <= {"L", "N"} or (a in "LN" and b in "PSZ"))


def divide(text: str, capacity: int, enc, tokens: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of pieces of at most ``capacity`` tokens; together they are the text.

    A piece ends before the last white space it has, else before the last other place where the
    tokenizer begins a word, so that the tokens after it stay the same; else between two characters.
    A single character of more tokens than the capacity is a piece of its own.
    """
    tokens = enc.encode_ordinary(text) if tokens is None else tokens
    out, at, first = [], 0, 0
    while len(tokens) - first > capacity:
        pieces = enc.decode_tokens_bytes(tokens[first : first + capacity + 1])
        ends, end, part = [], at, b""
        for piece in pieces[:-1]:
            part += piece
            try:
                end, part = end + len(part.decode()), b""
                ends.append(end)
            except UnicodeDecodeError:
                ends.append(-1)
        cut = next((k for k in range(capacity - 1, -1, -1) if ends[k] >= 0 and text[ends[k]].isspace() and not text[ends[k] - 1].isspace()), None)
        if cut is None:
            cut = next((k for k in range(capacity - 1, -1, -1) if ends[k] >= 0 and _boundary(text, ends[k])), None)
        if cut is not None:
            out.append((at, ends[cut], cut + 1))
            at, first = ends[cut], first + cut + 1
            continue
        end = next((e for e in reversed(ends) if e > at), at + 1)
        while end > at + 1 and len(enc.encode_ordinary(text[at:end])) > capacity:
            end -= 1
        out.append((at, end, len(enc.encode_ordinary(text[at:end]))))
        at, first, tokens = end, 0, enc.encode_ordinary(text[end:])
    if at < len(text):
        out.append((at, len(text), len(tokens) - first))
    return out


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Karmarkar-Karp: a partition of ``sizes`` (by index) in ``ways`` sets with near-equal sums.

    Each item starts as a partition with one filled set; the two partitions with the largest
    difference between fullest and emptiest set are merged, fullest with emptiest.
    """
    if ways == 1:
        return [list(range(len(sizes)))]
    # A partition holds only its filled sets, fullest first; the others are empty.
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # a[0] meets the emptiest set of b, which is b's set number ways - 1.
        merged = []
        free = ways - len(a)
        for k, (s, own) in enumerate(a):
            j = ways - 1 - k
            if j < len(b):
                s, own = s + b[j][0], own + b[j][1]
            merged.append((s, own))
        # sets of b that met empty sets of a: a's empty sets are the last ``free``, b's first ones
        merged += b[: min(free, len(b))]
        merged.sort(key=lambda x: -x[0])
        least = merged[-1][0] if len(merged) == ways else 0
        order += 1
        if least:
            merged = [(s - least, own) for s, own in merged]
            # what is taken off keeps its place: sums are found from the items in the end
        heapq.heappush(heap, (-merged[0][0], order, merged))
    return [list(own) for _, own in heap[0][2]]


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Sets of indices whose sizes sum up to at most ``capacity`` (no size is above it)."""
    if not sizes:
        return []
    ways = max(1, -(-sum(sizes) // capacity), sum(1 for s in sizes if 2 * s > capacity))
    while True:
        sets = differencing(sizes, ways)
        over = sum(1 for own in sets if sum(sizes[i] for i in own) > capacity)
        if not over or ways >= len(sizes):
            return [own for own in sets if own]
        ways += max(1, over // 4)


class _Packer:
    def __init__(self, kind: str, capacity: int, window: int) -> None:
        self.kind, self.capacity, self.window = kind, capacity, window
        self.waiting: list[tuple] = []
        self.next = TaskContext.get().partitionId() << 33

    def add(self, piece: tuple) -> list[tuple]:
        if piece[-1] >= self.capacity:  # a full container, or a character that exceeds it
            return self._container([piece])
        self.waiting.append(piece)
        return self.flush(keep=True) if len(self.waiting) >= self.window else []

    def _container(self, pieces: list[tuple]) -> list[tuple]:
        self.next += 1
        return [(self.kind, self.next - 1, *p) for p in pieces]

    def flush(self, keep: bool) -> list[tuple]:
        sets = pack([p[-1] for p in self.waiting], self.capacity)
        fill = [sum(self.waiting[i][-1] for i in own) for own in sets]
        back = min(range(len(sets)), key=fill.__getitem__) if keep and len(sets) > 1 else None
        out = [r for k, own in enumerate(sets) if k != back for r in self._container([self.waiting[i] for i in own])]
        self.waiting = [] if back is None else [self.waiting[i] for i in sets[back]]
        return out


def containers(documents: DataFrame, kinds: DataFrame, window: int = WINDOW, folder: str = TOKENIZERS) -> DataFrame:
    """(container_kind, container_id, doc_id, piece, start_pos, end_pos, n_tokens): for each kind of
    container, every text in one container, or in pieces if it exceeds the capacity by itself.

    Positions count code points. Null and empty texts need no container. Equal texts under several
    doc_id are packed each. Kinds are parameters, which every task gets; those without a positive capacity are left out. Container numbers are
    unique within a kind; a task that runs again on the same partition gives the same.
    """
    sizes = [(r["container_kind"], int(r["capacity_tokens"])) for r in kinds.where("capacity_tokens > 0").orderBy("capacity_tokens", "container_kind").collect()]

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(folder)
        packers = [_Packer(kind, capacity, window) for kind, capacity in sizes]
        columns = ["container_kind", "container_id", "doc_id", "piece", "start_pos", "end_pos", "n_tokens"]
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
                tokens = enc.encode_ordinary(text)
                n = len(tokens)
                for p in packers:
                    for piece, part in enumerate([(0, len(text), n)] if n <= p.capacity else divide(text, p.capacity, enc, tokens)):
                        rows += p.add((doc, piece, *part))
            if rows:
                yield pd.DataFrame(rows, columns=columns)
        rows = [r for p in packers for r in p.flush(keep=False)]
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    return documents.select("doc_id", "text").where(F.length("text") > 0).mapInPandas(fill, "container_kind string, container_id long, doc_id long, piece int, start_pos int, end_pos int, n_tokens int")
