"""Rows of evaluation splits that stand, exactly or almost, in the training split (problem 6).

An edit-distance segment join on words. With at most k edits between two texts, of any k + 1
disjoint segments of the evaluation text at least one stands unchanged in the training text, at most
k words from its place. The segments are chosen among all windows of a length, by dynamic
programming, as those rarest in the training texts, so that standing phrases are hardly ever looked
up. Candidates are verified by a banded edit distance. Equal texts are one text throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.plans.materialize import checkpointed
from bitloom.plans.prune import key_filter, pruned
from bitloom.plans.skew import HOT_SHARE, lookup

#: One word of so many may differ.
PER = 8
#: Words of a text's part in which segments are chosen at once: as many fit into each, as a part of
#: so many words has room for one in SEGMENT and needs one in PER - 1, or one more.
PART = 400
#: Words of a segment; of one of a text of SHORT words, which has room for two of them only so.
SEGMENT, SHORT_SEGMENT, SHORT = 4, 3, 7


def folded(text: Column) -> Column:
    """Lower case without accents, also those of ligatures."""
    flat = F.when(text.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.call_function("reflect", F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), text, F.lit(True)), r"\p{M}+", "")).otherwise(text)
    lower = F.translate(F.lower(F.upper(flat)), "ς", "σ")
    return F.replace(F.replace(F.replace(lower, F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae")), F.lit("ß"), F.lit("ss"))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(folded(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def within(a: list[str], b: list[str], k: int) -> int | None:
    """Edit distance of two lists of words if it is at most ``k``. Bands are tried from narrow to wide,
    so that long texts that hardly differ cost little."""
    if abs(len(a) - len(b)) > k or len(set(a) ^ set(b)) > 2 * k:
        return None
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    band = min(k, max(4, abs(len(a) - len(b))))
    while (d := _banded(a, b, band)) is None and band < k:
        band = min(k, 4 * band)
    return d


def _banded(a: list[str], b: list[str], k: int) -> int | None:
    far = k + 1
    row = {j: j for j in range(min(k, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new: dict[int, int] = {}
        for j in range(max(0, i - k), min(len(b), i + k) + 1):
            best = min(row.get(j, far) + 1, new.get(j - 1, far) + 1)
            if j:
                best = min(best, row.get(j - 1, far) + (x != b[j - 1]))
            new[j] = best if j else i
        row = new
        if min(row.values(), default=far) > k:
            return None
    d = row.get(len(b), far)
    return d if d <= k else None


def rarest(places: list[int], counts: list[int], width: int, many: int) -> list[int]:
    """Places of ``many`` disjoint windows of ``width`` words with the smallest sum of counts; in a text
    of more than PART words, with the smallest sums in each of its parts."""
    n = max(places) + width
    parts = -(-n // PART)
    if parts == 1:
        return _rarest(dict(zip(places, counts, strict=True)), n, width, many)
    at, out = dict(zip(places, counts, strict=True)), []
    for p in range(parts):
        low, high = n * p // parts, n * (p + 1) // parts
        own = {x - low: at[x] for x in range(low, high - width + 1)}
        out += [low + x for x in _rarest(own, high - low, width, many * (p + 1) // parts - many * p // parts)]
    return out


def _rarest(at: dict[int, int], n: int, width: int, many: int) -> list[int]:
    inf = float("inf")
    table = [[0.0] * (n + 1)]
    for _ in range(many):
        before, now = table[-1], [inf] * (n + 1)
        for e in range(width, n + 1):
            with_ = before[e - width] + at[e - width]
            now[e] = with_ if with_ < now[e - 1] else now[e - 1]
        table.append(now)
    out, e = [], n
    for j in range(many, 0, -1):
        while table[j][e - 1] == table[j][e]:
            e -= 1
        e -= width
        out.append(e)
    return out


def _texts(rows: DataFrame) -> DataFrame:
    """(train_id, evaluation, side, h1, h2, words): a row per text that has words, joined by spaces."""
    both = rows.select("train_id", (F.coalesce(F.col("split_name"), F.lit("")) != "train").alias("evaluation"), F.explode(F.create_map(F.lit("en"), F.col("en"), F.lit("fr"), F.col("fr"))).alias("side", "text"))
    worded = both.where(F.length("text") > 0).select("train_id", "evaluation", "side", F.array_join(words_of(F.col("text")), " ").alias("words")).where("words <> ''")
    return worded.withColumns({"h1": F.xxhash64("side", "words"), "h2": F.xxhash64("words", "side")})


def _grams(width: int) -> Column:
    """Hashes and places of the runs of ``width`` words, from the hashes of words."""
    run = lambda i: F.xxhash64("side", *[F.get("hashes", i + j) for j in range(width)])
    return F.when(F.col("n") >= width, F.transform(F.sequence(F.lit(0), F.col("n") - width), lambda i: F.struct(run(i).alias("g"), i.cast("int").alias("pos")))).otherwise(F.array().cast("array<struct<g: bigint, pos: int>>"))


def _signature(shift: int) -> Column:
    """64 bits, one for each different word."""
    return F.aggregate("hashes", F.lit(0).cast("long"), lambda s, h: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)).cast("int"))))


def _met(posted: DataFrame, segments: DataFrame) -> DataFrame:
    """``posted`` joined with ``segments`` on g: a segment that much of train holds is spread over salts
    by the training text, and its evaluation texts are repeated for each."""
    posted = checkpointed(posted)
    sizes = checkpointed(posted.groupBy("g").agg(F.count(F.lit(1)).alias("size")))
    least = max((sizes.agg(F.sum("size")).first()[0] or 0) // HOT_SHARE, 1)
    salts = F.broadcast(sizes.where(F.col("size") > least).select("g", F.ceil(F.col("size") / least).cast("int").alias("salts")))  # at most HOT_SHARE rows
    of_train = posted.join(salts, "g", "left").withColumn("salt", F.pmod(F.xxhash64("t"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    of_eval = segments.join(salts, "g", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return of_train.join(of_eval, ["g", "salt"])


def text_links(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct texts (h1, h2, side, words, n_eval, n_train and others), and links (e1, e2, t1, t2) between an
    evaluation text and a training text that differs from it, but little."""
    own = texts.groupBy("h1", "h2").agg(F.any_value("side").alias("side"), F.any_value("words").alias("words"), F.sum(F.col("evaluation").cast("long")).alias("n_eval"), F.sum((~F.col("evaluation")).cast("long")).alias("n_train"))
    own = checkpointed(own.withColumn("hashes", F.transform(F.split("words", " "), lambda w: F.xxhash64(w))).withColumns({"s1": _signature(0), "s2": _signature(6)}))
    # d <= max(n, m) / PER and m <= n + d give d <= n / (PER - 1)
    own = own.withColumns({"n": F.size("hashes"), "k": F.floor(F.size("hashes") / (PER - 1)).cast("int")})
    train = own.where((F.col("n_train") > 0) & (F.col("n") >= SHORT - 1))
    short = F.when(F.col("n") <= SHORT + 1, _grams(SHORT_SEGMENT)).otherwise(F.array().cast("array<struct<g: bigint, pos: int>>"))
    posted = train.select(F.col("h1").alias("t"), F.col("n").alias("m"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.explode(F.concat(_grams(SEGMENT), short)).alias("x")).select("x.g", "t", "m", "t1", "t2", F.col("x.pos").alias("tpos"))
    counts = posted.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    asked = own.where((F.col("n_eval") > 0) & (F.col("n") >= SHORT))
    windows = asked.select(F.col("h1").alias("e"), "n", "k", F.explode(F.when(F.col("n") == SHORT, _grams(SHORT_SEGMENT)).otherwise(_grams(SEGMENT))).alias("x")).select("x.g", "e", "n", "k", F.col("x.pos").alias("pos"))
    weighed = windows.join(counts, "g", "left").groupBy("e", "n", "k").agg(F.collect_list(F.struct("pos", F.coalesce("c", F.lit(0)).alias("c"), "g")).alias("w"))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for e, n, k, w in zip(batch["e"], batch["n"], batch["k"], batch["w"], strict=True):
                by = {x["pos"]: x for x in w}
                for pos in rarest(list(by), [x["c"] for x in by.values()], SHORT_SEGMENT if n == SHORT else SEGMENT, k + 1):
                    if by[pos]["c"]:
                        rows.append((by[pos]["g"], e, n, k, pos))
            yield pd.DataFrame(rows, columns=["g", "e", "n", "k", "pos"]).astype({"g": "int64", "e": "int64"})

    segments = checkpointed(weighed.mapInPandas(choose, "g long, e long, n int, k int, pos int"))
    # Segments are rare in train, so most of its grams go no further than this filter. Those that
    # stay meet the segments, each part of a hot segment's grams by itself.
    signed = segments.join(asked.select(F.col("h1").alias("e"), "s1", "s2"), "e")
    # an edit changes at most two bits of a signature
    near = _met(pruned(posted, "g", key_filter(segments, "g")), signed).where("abs(tpos - pos) <= k and abs(m - n) <= k and e <> t").where("bit_count(s1 ^ t1) <= 2 * k and bit_count(s2 ^ t2) <= 2 * k").select("e", "t").distinct()
    near = checkpointed(near)
    a = pruned(own.where("n_eval > 0").select(F.col("h1").alias("e"), F.col("h2").alias("e2"), F.col("words").alias("a")), "e", key_filter(near, "e"))
    b = pruned(own.where("n_train > 0").select(F.col("h1").alias("t"), F.col("h2").alias("t2"), F.col("words").alias("b")), "t", key_filter(near, "t"))
    candidates = near.join(a, "e").join(b, "t")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["a"], batch["b"], strict=True):
                x, y = x.split(" "), y.split(" ")
                keep.append(within(x, y, max(len(x), len(y)) // PER) is not None)
            out = batch.loc[keep, ["e", "e2", "t", "t2"]]
            yield out.set_axis(["e1", "e2", "t1", "t2"], axis=1)

    return own, candidates.mapInPandas(verify, "e1 long, e2 long, t1 long, t2 long")


def found_overlaps(rows: DataFrame) -> DataFrame:
    """(id_a, id_b): a training row and another one whose ``en`` or ``fr`` are nearly the same.

    Null texts and texts without words match nothing; a null split_name isn't 'train'; texts of fewer
    than SHORT words match only if they are equal. Every pair of rows comes out once.
    """
    texts = checkpointed(_texts(rows).select("train_id", "evaluation", "side", "h1", "h2", "words"))
    own, links = text_links(texts)
    equal = own.where("n_eval > 0 and n_train > 0").select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("h1").alias("t1"), F.col("h2").alias("t2"))
    links = checkpointed(equal.unionByName(links))
    # Links get the rows of their evaluation texts, then those of their training texts; a text that many
    # rows have is spread over them.
    of_link = lambda x, y: F.xxhash64(x, y)
    links = checkpointed(links.withColumns({"e": of_link("e1", "e2"), "t": of_link("t1", "t2")}))
    ids = checkpointed(texts.select("train_id", "evaluation", F.xxhash64("h1", "h2").alias("text")))
    evals = pruned(ids.where("evaluation").select(F.col("text").alias("e"), F.col("train_id").alias("eid")), "e", key_filter(links, "e"))
    trains = pruned(ids.where(~F.col("evaluation")).select(F.col("text").alias("t"), F.col("train_id").alias("tid")), "t", key_filter(links, "t"))
    with_eval = links.select("e", "t").join(evals, "e")
    return with_eval.join(trains, "t").select(F.least("eid", "tid").alias("id_a"), F.greatest("eid", "tid").alias("id_b")).where("id_a <> id_b").distinct()


def overlap_totals(rows: DataFrame) -> DataFrame:
    """(split_name, source, n_rows, n_overlapping): evaluation rows, and those that overlap, of each
    split and source. Null splits and sources are groups of their own."""
    texts = checkpointed(_texts(rows))
    own, links = text_links(texts)
    hit = own.where("n_eval > 0 and n_train > 0").select("h1", "h2").unionByName(links.select(F.col("e1").alias("h1"), F.col("e2").alias("h2"))).distinct()
    sizes = own.select("h1", "h2", F.col("n_eval").alias("size")).where("size > 0").join(hit, ["h1", "h2"], "left_semi")
    ids = lookup(texts.where("evaluation").select("train_id", "h1", "h2"), sizes.withColumn("hit", F.lit(1)), ["h1", "h2"], "size", F.col("train_id")).select("train_id", "hit").distinct()
    evaluation = rows.where(F.coalesce(F.col("split_name"), F.lit("")) != "train").select("train_id", "split_name", "source")
    return evaluation.join(ids, "train_id", "left").groupBy("split_name", "source").agg(F.count(F.lit(1)).alias("n_rows"), F.count("hit").alias("n_overlapping"))
