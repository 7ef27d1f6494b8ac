"""Similarity of vectors and sentences, margins, monotone alignment and its refinement."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitloom.functions.features import cosine
from bitloom.plans.materialize import checkpointed

K = 4
FLOOR = 0.7
#: Sentences and characters a side of a gap may have to be joined.
GAP_SENTENCES, GAP_CHARS = 4, 800
DIMENSIONS = 256


def embed(texts: list[str]) -> np.ndarray:
    """The default seam for a sentence encoder: normalised counts of hashed character trigrams."""
    out = np.zeros((len(texts), DIMENSIONS))
    for i, t in enumerate(texts):
        t = f" {t.lower()} "
        for k in range(len(t) - 2):
            out[i, crc32(t[k : k + 3].encode()) % DIMENSIONS] += 1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def pair_similarity(vectors: DataFrame, group: str, key: str, vector: str, is_source: Column) -> DataFrame:
    """(group, i, j, sim): cosine of every source vector with every other one of its group. Groups are
    single documents; a null or empty vector has no row."""
    usable = vectors.where(F.size(vector) > 0)
    a = usable.where(is_source).select(group, F.col(key).alias("i"), F.col(vector).alias("a"))
    b = usable.where(~is_source).select(group, F.col(key).alias("j"), F.col(vector).alias("b"))
    return a.join(b, group).select(group, "i", "j", cosine(F.col("a"), F.col("b")).alias("sim"))


def margin_scores(sims: DataFrame, group: str, k: int = K) -> DataFrame:
    """(group, i, j, sim, margin): similarity over the mean of the k largest of its row plus that of
    its column; raw where a side has fewer than two. The similarities are read three times, and so are
    computed once."""
    sims = checkpointed(sims)

    def nearest(side: str, name: str) -> DataFrame:
        other = "j" if side == "i" else "i"
        top = sims.withColumn("r", F.row_number().over(Window.partitionBy(group, side).orderBy(F.desc("sim"), other))).where(F.col("r") <= k)
        return top.groupBy(group, side).agg(F.avg("sim").alias(name), F.count(F.lit(1)).alias(f"n_{side}"))

    joined = sims.join(nearest("i", "row_mean"), [group, "i"]).join(nearest("j", "col_mean"), [group, "j"])
    return joined.select(group, "i", "j", "sim", F.when(F.least("n_i", "n_j") < 2, F.col("sim")).otherwise(F.try_divide("sim", F.col("row_mean") + F.col("col_mean"))).alias("margin"))


def monotone(weights: np.ndarray, floor: float = FLOOR) -> list[tuple[int, int]]:
    """The heaviest monotone one-to-one alignment; entries below ``floor`` weigh nothing."""
    w = np.where(weights >= floor, weights, 0.0)
    n, m = w.shape
    best = np.zeros((n + 1, m + 1))
    for i in range(1, n + 1):
        taken = best[i - 1, :-1] + w[i - 1]
        row = np.maximum(best[i - 1, 1:], taken)
        best[i, 1:] = np.maximum.accumulate(row)
    pairs, i, j = [], n, m
    while i and j:
        if np.isclose(best[i, j], best[i - 1, j]):
            i -= 1
        elif np.isclose(best[i, j], best[i, j - 1]):
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def refine_gaps(pairs: list[tuple[int, int]], fr: list[str], en: list[str], encode: Callable = embed, floor: float = FLOOR) -> list[tuple[str, str, float]]:
    """Joined sentences of small gaps between neighbouring pairs, if they are similar."""
    out = []
    for (a, b), (c, d) in zip([(-1, -1), *pairs], [*pairs, (len(fr), len(en))], strict=True):
        left, right = fr[a + 1 : c], en[b + 1 : d]
        x, y = " ".join(left), " ".join(right)
        if 0 < len(left) <= GAP_SENTENCES and 0 < len(right) <= GAP_SENTENCES and len(x) <= GAP_CHARS and len(y) <= GAP_CHARS:
            v = encode([x, y])
            if (s := float(v[0] @ v[1])) >= floor:
                out.append((x, y, round(s, 3)))
    return out


def align_documents(sentences: DataFrame, refine: bool = False, floor: float = FLOOR) -> DataFrame:
    """(document_name, fr, en, similarity): monotone alignment of each document's sentences, from the
    columns document_name, pos, en, fr; with ``refine`` the joined gaps instead. Rows without a name
    belong to no document. The matrix of one document stays in one task, as the method needs it."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        fr, en = [t for t in rows["fr"] if t], [t for t in rows["en"] if t]
        if not fr or not en:
            return pd.DataFrame(columns=["document_name", "fr", "en", "similarity"])
        sims = embed(fr) @ embed(en).T
        pairs = monotone(sims, floor)
        found = refine_gaps(pairs, fr, en, floor=floor) if refine else [(fr[i], en[j], round(float(sims[i, j]), 3)) for i, j in pairs]
        return pd.DataFrame([(key[0], *x) for x in found], columns=["document_name", "fr", "en", "similarity"])

    named = sentences.where(F.col("document_name").isNotNull()).select("document_name", "pos", "fr", "en")
    return named.groupBy("document_name").applyInPandas(run, "document_name string, fr string, en string, similarity double")
