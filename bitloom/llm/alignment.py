"""Sentences of bilingual documents that translate each other (problem 3).

French sentences are emissions of a hidden Markov model whose states are English sentences, spans of
two or three English sentences that follow each other (one French sentence for all), and null states
that remember the place. Moves between states have jump probabilities: the next sentence is likeliest,
staying covers an English sentence that became several, larger jumps cover omissions and reordering.
Emission probabilities come from a word translation table fitted by expectation maximisation on the
sentences of all documents that share rare words, and from the frequencies of words in all documents.

A long document is decoded in blocks of French sentences. Words that are rare in a document on either
side tell which English sentences may belong to a block, however far they have moved.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitloom.plans.materialize import checkpointed
from bitloom.plans.skew import lookup

#: Passes that the translation table is fitted in. Words seen less often than USUAL, and numbers, have
#: no row in it.
EM_STEPS, USUAL = 5, 3
#: Translations kept per word at the end; four times as many between passes.
KEPT = 12
#: Pairs of sentences of a chunk of the fit, and sentences of a chunk that is decoded. Only a chunk and the
#: table's rows for its words are in memory at once.
FIT_CHUNK, CHUNK = 4000, 1000
#: Pairs of words taken at once in a pass, cells up to which their sums are an array, and units of a count:
#: whole numbers have the same sum in any order.
AT_ONCE, CELLS, UNITS = 1 << 18, 1 << 23, float(1 << 24)
#: Weight of the background for words, and for numbers and names, which a translation keeps.
BACKGROUND, BACKGROUND_KEY = 0.25, 0.03
#: Probability of a name or number of the other language that is the same.
SAME = 0.9
#: Share of all words below which a word's frequency is taken as this; so at most 1 / RARE frequencies
#: are kept. Rarer words are names.
RARE = 2e-5
#: Log probabilities: of the next sentence, of the same, of jumps by distance, of a far jump, of null.
NEXT, STAY, JUMP, FAR, NULL = math.log(0.7), math.log(0.04), math.log(0.06), math.log(0.0004), math.log(0.04)
WINDOW = 30
#: Extra cost of each further sentence of a span, the most it has, and the least evidence of a pair.
SPAN, WIDEST, LEAST = -1.5, 3, 3.0
#: French sentences of a block of a longer document. It gets the English sentences within MARGIN of the
#: same share of the document, and whole and neighbouring runs of NEAR sentences that hold one which
#: shares a word with the block that stands at most OFTEN times on either side of the document.
BLOCK, MARGIN, NEAR, OFTEN = 400, 150, 50, 2
#: English sentences up to which all jumps are tried at once.
SMALL = 150

WORD = re.compile(r"\d+(?:[.,  ]\d{3})*(?:[.,]\d+)?|[^\W\d_]+(?:\d+)?")
ACCENT = re.compile("[\u0300-\u036f]")


def tokens(text: str) -> list[str]:
    """Words in lower case without accents; numbers without marks of thousands, with a point."""
    text = unicodedata.normalize("NFD", text.replace("’", "'").casefold())
    text = "".join(c for c in text if not unicodedata.combining(c)).replace("œ", "oe").replace(" ", " ").replace(" ", " ").replace("\xa0", " ")
    out = []
    for w in WORD.findall(text):
        if w[0].isdigit():
            w = re.sub(r"[., ](?=\d{3}(?!\d))", "", w).replace(",", ".").replace(" ", "")
        out.append(w)
    return out


def _evidence(source: list[list[str]], target: list[list[str]], table: dict, freq: dict, own: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log likelihood ratios of each target word under each source sentence, counts of target words,
    and word probabilities of source sentences, for spans."""
    words = sorted({w for s in source for w in s})
    at = {w: k for k, w in enumerate(words)}
    goal = sorted({w for s in target for w in s})
    to = {w: k for k, w in enumerate(goal)}
    t = np.zeros((len(words), len(goal)))
    for w, k in at.items():
        for f, p in table.get(w, {}).items():
            if f in to:
                t[k, to[f]] = p
        if w in to and (w not in own or w[0].isdigit() or w not in table):
            t[k, to[w]] = max(t[k, to[w]], SAME)
    a = np.zeros((len(source), len(words)))
    for i, s in enumerate(source):
        for w in s:
            a[i, at[w]] += 1
    b = np.zeros((len(target), len(goal)))
    for j, s in enumerate(target):
        for w in s:
            b[j, to[w]] += 1
    back = np.array([max(freq.get(w, RARE), RARE) for w in goal])
    key = np.array([w[0].isdigit() or w not in freq for w in goal])
    mix = np.where(key, BACKGROUND_KEY, BACKGROUND)
    mass = a @ t
    return mass / back, b, mix


def _ratio(mass: np.ndarray, length: np.ndarray, counts: np.ndarray, mix: np.ndarray) -> np.ndarray:
    """(targets, sources) log likelihood ratios against the background."""
    return counts @ np.log(mix + (1 - mix) * mass / np.maximum(length, 1)[:, None]).T


def emissions(en: list[list[str]], fr: list[list[str]], model: dict) -> list[np.ndarray]:
    """Log likelihood ratios (French sentences x English sentences), and those of the spans that begin
    with each English sentence, by width; both directions taken together."""
    forward, counts, mix = _evidence(en, fr, model["to_fr"], model["fr"], model["en"])
    length = np.array([len(s) for s in en])
    backward, back_counts, back_mix = _evidence(fr, en, model["to_en"], model["en"], model["fr"])
    back = _ratio(backward, np.array([len(s) for s in fr]), back_counts, back_mix).T
    single = _ratio(forward, length, counts, mix)
    out, mass, words, sum_back = [(single + back) / 2], forward, length, back
    for width in range(2, min(WIDEST, len(en)) + 1):
        mass, words, sum_back = mass[:-1] + forward[width - 1 :], words[:-1] + length[width - 1 :], sum_back[:, :-1] + back[:, width - 1 :]
        span = _ratio(mass, words, counts, mix)
        # what explains a span twice over, as sentences of the same wording do, counts once
        out.append((span + np.minimum(span, sum_back)) / 2)
    return out


def _jumps() -> np.ndarray:
    out = np.full(2 * WINDOW + 1, FAR)
    for d in range(-WINDOW, WINDOW + 1):
        out[d + WINDOW] = NEXT if d == 1 else STAY if d == 0 else max(FAR, JUMP - 1.2 * math.log(abs(d - 1)) - (0.7 if d < 0 else 0.0))
    return out


JUMPS = _jumps()


def decode(spans: list[np.ndarray]) -> list[tuple[int, int]]:
    """(English, French) pairs on the best path. States: spans by width and first sentence, then null
    states; ``spans`` holds the emissions of each width."""
    m, n = spans[0].shape
    starts = np.concatenate([np.arange(n - w) for w in range(len(spans))] + [np.arange(n)])
    widths = np.concatenate([np.full(n - w, w + 1) for w in range(len(spans))] + [np.zeros(n, np.int64)])
    last = starts + np.maximum(widths, 1) - 1  # the English place a state leaves behind
    edges = np.concatenate(([0], np.cumsum([*(n - w for w in range(len(spans))), n])))
    emit = np.concatenate([x + SPAN * w for w, x in enumerate(spans)], axis=1)
    if n <= SMALL:
        far = np.arange(n)[None, :] - np.arange(n)[:, None]
        moves = np.where(abs(far) <= WINDOW, JUMPS[np.clip(far, -WINDOW, WINDOW) + WINDOW], FAR)
    back = np.zeros((m, len(starts)), np.int32)
    real = edges[-2]
    first = np.maximum(NEXT - 1.0 * np.log1p(np.arange(n)), FAR)
    score = np.concatenate((first[starts[:real]] + emit[0], first + NULL))
    for j in range(1, m):
        # best state that leaves each English place behind
        groups, who = np.full(n, -np.inf), np.zeros(n, np.int64)
        for s0, s1 in zip(edges, edges[1:], strict=False):
            part, places_ = score[s0:s1], last[s0:s1]
            better = part > groups[places_]
            groups[places_[better]] = part[better]
            who[places_[better]] = np.arange(s0, s1)[better]
        if n <= SMALL:
            via = groups[:, None] + moves
            from_ = via.argmax(axis=0)
            into = via[from_, np.arange(n)]
        else:
            top = int(groups.argmax())
            into, from_ = np.full(n, groups[top] + FAR), np.full(n, top)
            for d in range(-WINDOW, WINDOW + 1):
                lo, hi = max(0, d), min(n, n + d)
                if lo < hi:
                    via = groups[lo - d : hi - d] + JUMPS[d + WINDOW]
                    better = via > into[lo:hi]
                    into[lo:hi][better] = via[better]
                    from_[lo:hi][better] = np.arange(lo - d, hi - d)[better]
        back[j] = np.concatenate((who[from_[starts[:real]]], who))
        score = np.concatenate((into[starts[:real]] + emit[j], groups + NULL))
    state, pairs = int(score.argmax()), []
    for j in range(m - 1, -1, -1):
        i, w = int(starts[state]), int(widths[state])
        if w > 1 or w == 1 and spans[0][j, i] > LEAST:
            pairs += [(i + k, j) for k in range(w)]
        state = int(back[j, state])
    return pairs


def align_words(en: list[list[str]], fr: list[list[str]], model: dict) -> list[tuple[int, int]]:
    return sorted(decode(emissions(en, fr, model))) if en and fr else []


def align(en: list[str], fr: list[str], model: dict) -> list[tuple[int, int]]:
    """(English, French) places of sentences that translate each other."""
    return align_words([tokens(s) for s in en], [tokens(s) for s in fr], model)


def sentences_in_words(rows: DataFrame) -> DataFrame:
    """(document_name, pos, side, words): every sentence that isn't blank, once, its words joined by
    spaces; rows without name or position have none."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(d, p, side, " ".join(tokens(t))) for side in ("en", "fr") for d, p, t in zip(b["document_name"], b["pos"].tolist(), b[side], strict=True) if t and not t.isspace()]
            yield pd.DataFrame(found, columns=["document_name", "pos", "side", "words"])

    named = rows.where(F.col("document_name").isNotNull() & F.col("pos").isNotNull()).select("document_name", "pos", "en", "fr")
    return checkpointed(named.mapInPandas(cut, "document_name string, pos int, side string, words string").distinct())


def word_counts(sides: DataFrame) -> DataFrame:
    """(side, word, n) of all sentences."""
    each = sides.select("side", F.explode(F.split("words", " ")).alias("word")).where("word <> ''")
    return checkpointed(each.groupBy("side", "word").agg(F.count(F.lit(1)).alias("n")))


def word_shares(counted: DataFrame) -> dict[str, dict[str, float]]:
    """Shares of the words by side, of those that have RARE at least."""
    total = {r["side"]: r["n"] for r in counted.groupBy("side").agg(F.sum("n").alias("n")).collect()}
    out: dict[str, dict[str, float]] = {"en": {}, "fr": {}}
    for side, n in total.items():
        for r in counted.where((F.col("side") == side) & (F.col("n") >= max(3, RARE * n))).collect():  # 1 / RARE at most
            out[side][r["word"]] = r["n"] / n
    return out


def _rare_words(sides: DataFrame, at: Column) -> DataFrame:
    """(document_name, i, j): places ``at`` on the English and the French side that share a word, once a
    word, for words that stand at most OFTEN times on either side of the document."""
    side = lambda name, f: f(F.when(F.col("side") == name, F.col("at")))
    each = sides.select("document_name", "side", at.alias("at"), F.explode(F.array_distinct(F.split("words", " "))).alias("word")).where((F.length("word") > 4) | F.col("word").rlike(r"^\p{Nd}"))
    seen = each.groupBy("document_name", "word").agg(*[side(s, f).alias(f"{k}_{s}") for s in ("en", "fr") for k, f in (("n", F.count), ("low", F.min), ("high", F.max))])
    rare = seen.where(F.col("n_en").between(1, OFTEN) & F.col("n_fr").between(1, OFTEN))
    both = lambda s: F.explode(F.array_distinct(F.array(f"low_{s}", f"high_{s}")))
    return rare.withColumn("i", both("en")).withColumn("j", both("fr")).select("document_name", "i", "j")


def anchors(sides: DataFrame) -> DataFrame:
    """(en, fr, n): words of sentences of a document that share more rare words than either shares with any
    other, two at least, and how often the two stand so in all documents. Of equals the first counts."""
    at = F.struct("pos", F.xxhash64("words").alias("h"))  # sentences may have a position in common
    shared = _rare_words(sides, at).groupBy("document_name", "i", "j").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    best = lambda a, b: F.row_number().over(Window.partitionBy("document_name", a).orderBy(F.desc("n"), b))
    mutual = shared.withColumn("of_i", best("i", "j")).withColumn("of_j", best("j", "i")).where("of_i = 1 and of_j = 1")
    for side, place in (("en", "i"), ("fr", "j")):
        mutual = mutual.join(sides.where(F.col("side") == side).select("document_name", at.alias(place), F.col("words").alias(side)), ["document_name", place])
    return mutual.groupBy("en", "fr").agg(F.count(F.lit(1)).alias("n"))


Table = tuple[np.ndarray, np.ndarray]


def expected(pairs: list[tuple[list[str], list[str], int]], source: dict[str, int], target: dict[str, int], table: Table | None) -> Table:
    """How often source words are translated by target words in ``pairs`` (source, target, times), in UNITS,
    with the probabilities ``table``; all are alike without. Words are numbered by ``source`` and ``target``,
    others are left out; a cell of a table is source number * target numbers + target number, in order."""
    size = len(source) * len(target)
    dense = size <= CELLS
    known, values = table or (None, None)
    if table and dense:
        full = np.zeros(size)
        full[known] = values
    sums, parts = np.zeros(size if dense else 0), []

    def add(part: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        wide, high = np.array([len(a) for a, _, _ in part]), np.array([len(b) for _, b, _ in part])
        of = np.repeat(np.arange(len(part)), high)  # pair of each target word
        goal = np.repeat(np.arange(len(of)), wide[of])  # target word of each pair of words
        first = (np.cumsum(wide) - wide)[of] - (np.cumsum(wide[of]) - wide[of])
        cells = np.concatenate([a for a, _, _ in part])[np.arange(len(goal)) + first[goal]] * len(target) + np.concatenate([b for _, b, _ in part])[goal]
        if not table:
            p = np.ones(len(cells))
        elif dense:
            p = full[cells]
        else:
            place = np.minimum(np.searchsorted(known, cells), len(known) - 1)
            p = np.where(known[place] == cells, values[place], 0.0)
        total = np.bincount(goal, p, minlength=len(of))
        share = p * (np.array([n for _, _, n in part])[of] / np.where(total > 0, total, 1.0))[goal]
        if dense:
            np.add.at(sums, cells, share)
        else:
            which, back = np.unique(cells, return_inverse=True)
            parts.append((which, np.bincount(back, share)))

    part, load = [], 0
    for words, others, n in pairs if table is None or len(known) else ():
        a = np.array([source[w] for w in words if w in source], np.int64)
        b = np.array([target[w] for w in others if w in target], np.int64)
        step = max(1, AT_ONCE // max(1, len(a)))
        for k in range(0, len(b) if len(a) else 0, step):  # target words are independent of each other
            part.append((a, b[k : k + step], n))
            load += len(a) * len(part[-1][1])
            if load >= AT_ONCE:
                add(part)
                part, load = [], 0
    if part:
        add(part)
    which = None
    if not dense:
        which, back = np.unique(np.concatenate([np.zeros(0, np.int64), *(w for w, _ in parts)]), return_inverse=True)
        sums = np.bincount(back, np.concatenate([np.zeros(0), *(c for _, c in parts)]), minlength=len(which))
    counts = np.rint(sums * UNITS).astype(np.int64)
    held = np.flatnonzero(counts)
    return held if which is None else which[held], counts[held]


def _expected_by_chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, to, c) of each chunk; its words (side, word, id, the table's row in to and p, null at first) come
    before its pairs (no side, en, fr, n)."""
    chunk, words, pairs = None, {"en": {}, "fr": {}}, []

    def flush() -> Iterator[pd.DataFrame]:
        ids = {s: np.array([i for i, _, _ in w.values()], np.int64) for s, w in words.items()}
        number = {s: {x: k for k, x in enumerate(w)} for s, w in words.items()}
        for side, other, of_side in (("en", "fr", pairs), ("fr", "en", [(b, a, n) for a, b, n in pairs])):
            if not len(ids[side]) or not len(ids[other]):
                continue
            rows, table = [*words[side].values()], None
            if rows[0][1] is not None:
                to, p = np.concatenate([x for _, x, _ in rows]), np.concatenate([x for _, _, x in rows])
                order = np.argsort(ids[other])
                place = order[np.minimum(np.searchsorted(ids[other][order], to), len(order) - 1)]
                hit = ids[other][place] == to
                cells = (np.repeat(np.arange(len(rows)), [len(x) for _, x, _ in rows]) * len(order) + place)[hit]
                by_cell = np.argsort(cells)
                table = cells[by_cell], p[hit][by_cell]
            cells, counts = expected(of_side, number[side], number[other], table)
            yield pd.DataFrame({"id": ids[side][cells // len(ids[other])], "to": ids[other][cells % len(ids[other])], "c": counts})

    for batch in batches:
        for at, side, word, i, to, p, en, fr, n in zip(*[batch[c].tolist() for c in ("chunk", "side", "word", "id", "to", "p", "en", "fr", "n")], strict=True):
            if at != chunk:
                if pairs:
                    yield from flush()
                chunk, words, pairs = at, {"en": {}, "fr": {}}, []
            if side:
                words[side][word] = i, to, p
            else:
                pairs.append((en.split(" "), fr.split(" "), n))
    if pairs:
        yield from flush()


def translations(pairs: DataFrame, counted: DataFrame) -> DataFrame:
    """(side, word, row): the translation table of both directions, IBM model 1 by expectation maximisation
    on all ``pairs`` of ``anchors``; a row holds the likeliest translations and their probabilities. Every
    usual word of the pairs has one. The table is never in one place: a chunk of pairs gets the rows of its words."""
    pairs = checkpointed(pairs)
    chunks = -(-pairs.count() // FIT_CHUNK) or 1
    pairs = pairs.withColumn("chunk", F.pmod(F.xxhash64("en", "fr"), F.lit(chunks)).cast("int"))
    # ids are in the order of the words, whatever the partitions
    usual = counted.where((F.col("n") >= USUAL) & ~F.col("word").rlike(r"^\p{Nd}")).select("side", "word").orderBy("side", "word")
    usual = checkpointed(usual.withColumn("id", F.monotonically_increasing_id()))
    held = [pairs.select("chunk", F.lit(s).alias("side"), F.explode(F.split(s, " ")).alias("word")) for s in ("en", "fr")]
    wanted = checkpointed(held[0].unionByName(held[1]).distinct().join(usual, ["side", "word"]))
    table = None
    for step in range(EM_STEPS):
        rows = wanted.withColumns({"to": F.lit(None).cast("array<bigint>"), "p": F.lit(None).cast("array<double>")}) if table is None else wanted.join(table, "id")
        by_chunk = rows.unionByName(pairs, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", F.desc_nulls_last("side"), "id", "en", "fr")
        found = by_chunk.mapInPandas(_expected_by_chunk, "id long, to long, c long").groupBy("id", "to").agg(F.sum("c").alias("c"))
        word = Window.partitionBy("id")
        ranked = found.withColumn("r", F.row_number().over(word.orderBy(F.desc("c"), "to"))).withColumn("p", F.col("c") / F.sum("c").over(word))
        kept = ranked.where(F.col("r") <= (KEPT * 4 if step + 1 < EM_STEPS else KEPT))
        table = checkpointed(kept.groupBy("id").agg(F.collect_list(F.struct("to", "p")).alias("x")).select("id", "x.to", "x.p"))
    spelled = table.select("id", F.explode(F.arrays_zip("to", "p")).alias("x")).select(F.col("id").alias("of"), F.col("x.to").alias("id"), "x.p").join(usual, "id")
    rows = spelled.groupBy("of").agg(F.concat_ws(" ", F.collect_list(F.concat_ws(" ", "word", F.col("p").cast("string")))).alias("row"))
    return rows.withColumnRenamed("of", "id").join(usual, "id").select("side", "word", "row")


def _row(row: str) -> dict[str, float]:
    parts = row.split(" ")
    return {f: float(p) for f, p in zip(parts[::2], parts[1::2], strict=True)}


#: Names of the tables from each side.
FROM = {"en": "to_fr", "fr": "to_en"}


def fitted(rows: DataFrame) -> dict:
    """The model for a table of documents' sentences (document_name, pos, en, fr): word shares and translation
    tables from all of them, as a value, for tables of which these fit into memory; ``aligned`` needs none."""
    sides = sentences_in_words(rows)
    counted = word_counts(sides)
    model = {"to_fr": {}, "to_en": {}, **word_shares(counted)}
    for r in translations(anchors(sides), counted).toLocalIterator():
        model[FROM[r["side"]]][r["word"]] = _row(r["row"])
    return model


def blocks_of(sides: DataFrame, tops: DataFrame) -> DataFrame:
    """(document_name, block, side, pos, words) of documents with the last positions ``tops``
    (document_name, top_en, top_fr): each French sentence in one block, each English one in all that
    it may belong to, see the constants. No document has to fit into one task."""
    linked = _rare_words(sides, F.col("pos"))
    runs = linked.select("document_name", F.floor(F.col("j") / BLOCK).cast("int").alias("block"), F.explode(F.sequence((F.floor(F.col("i") / NEAR) - 1).cast("int"), (F.floor(F.col("i") / NEAR) + 1).cast("int"))).alias("run"))
    middle = lambda at: (F.col("block") + at) * BLOCK * (F.col("top_en") + 1) / (F.col("top_fr") + 1)
    straight = tops.where("top_en is not null and top_fr is not null").withColumn("block", F.explode(F.sequence(F.lit(0), F.floor(F.col("top_fr") / BLOCK).cast("int"))))
    straight = straight.select("document_name", "block", F.explode(F.sequence(F.floor((middle(0) - MARGIN) / NEAR).cast("int"), F.floor((middle(1) + MARGIN) / NEAR).cast("int"))).alias("run"))
    wanted = runs.unionByName(straight).distinct()
    english = sides.where("side = 'en'").withColumn("run", F.floor(F.col("pos") / NEAR).cast("int")).join(wanted, ["document_name", "run"])
    french = sides.where("side = 'fr'").withColumn("block", F.floor(F.col("pos") / BLOCK).cast("int"))
    return english.select("document_name", "block", "side", "pos", "words").unionByName(french.select("document_name", "block", "side", "pos", "words"))


def aligned(rows: DataFrame, model: dict | None = None) -> DataFrame:
    """(document_name, en_pos, fr_pos): pairs of sentences that translate each other.

    Null and blank sentences and rows without name or position have none. Sentences of the same words
    at one position are taken once; of different ones each is aligned. A document longer than BLOCK is
    decoded in blocks, so that none has to fit into one task. Without a ``model`` it is fitted on all rows.
    """
    sides = sentences_in_words(rows)
    tops = sides.groupBy("document_name").agg(F.max(F.when(F.col("side") == "en", F.col("pos"))).alias("top_en"), F.max(F.when(F.col("side") == "fr", F.col("pos"))).alias("top_fr"), F.count(F.lit(1)).alias("n"))
    # at most rows / BLOCK documents are long
    long = checkpointed(tops.where((F.col("top_en") > BLOCK) | (F.col("top_fr") > BLOCK)))
    blocked = sides.withColumn("block", F.lit(0))
    if not long.isEmpty():
        short = blocked.join(long.select("document_name"), "document_name", "left_anti")
        of_long = lookup(sides, long.select("document_name", "n"), ["document_name"], "n", F.col("pos"))
        blocked = checkpointed(short.select("document_name", "block", "side", "pos", "words").unionByName(blocks_of(checkpointed(of_long), long.drop("n"))))
    chunks = -(-sides.count() // CHUNK) or 1
    blocked = blocked.select(F.pmod(F.xxhash64("document_name", "block"), F.lit(chunks)).cast("int").alias("chunk"), "document_name", "block", "side", "pos", "words")
    fitting = model is None
    if fitting:
        counted = word_counts(sides)
        model = {"to_fr": {}, "to_en": {}, **word_shares(counted)}
        table = translations(anchors(sides), counted)
        wanted = blocked.select("chunk", "side", F.explode(F.split("words", " ")).alias("word")).distinct().join(table, ["side", "word"])
        # rows of the table for the words of a chunk, without document
        blocked = blocked.unionByName(wanted.select("chunk", F.lit(None).cast("string").alias("document_name"), F.lit(0).alias("block"), "side", F.lit(0).alias("pos"), F.concat_ws(" ", "word", "row").alias("words")))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        own: dict[str, list] = {"en": [], "fr": []}
        of, key, found = None, None, []

        def flush() -> None:
            if key is not None:
                got = align_words([w for _, w in own["en"]], [w for _, w in own["fr"]], known)
                found.extend((key[0], *p) for p in sorted({(own["en"][i][0], own["fr"][j][0]) for i, j in got}))

        for batch in batches:
            for chunk, d, block, side, pos, words in zip(batch["chunk"].tolist(), batch["document_name"], batch["block"].tolist(), batch["side"], batch["pos"].tolist(), batch["words"], strict=True):
                if chunk != of:
                    flush()
                    of, key = chunk, None
                    if fitting:
                        known = {**shared.value, "to_fr": {}, "to_en": {}}
                if d is None:
                    word, row = words.split(" ", 1)
                    known[FROM[side]][word] = _row(row)
                    continue
                if key != (d, block):
                    flush()
                    key, own = (d, block), {"en": [], "fr": []}
                own[side].append((pos, words.split()))
            yield pd.DataFrame(found, columns=["document_name", "en_pos", "fr_pos"])
            found = []
        flush()
        yield pd.DataFrame(found, columns=["document_name", "en_pos", "fr_pos"])

    # a block's rows come one after the other, behind its chunk's rows of the table; each French sentence is in one block
    by_block = blocked.repartition("chunk").sortWithinPartitions("chunk", F.asc_nulls_first("document_name"), "block", "pos", "words")
    return by_block.mapInPandas(pair, "document_name string, en_pos int, fr_pos int")
