"""Splits that keep related records together (problem 5).

Names are related by the publication key they spell, or by at least MIN_COMMON long values in
common; components of that relation come from :mod:`bitloom.llm.graph`, which is asked twice. The
first time names meet by their keys and by tuples of the values with the smallest hashes, which names
with much in common share: a few edges a name. Then only pairs of names that are still apart are
looked for, exactly. Groups are then assigned, largest first, to the split furthest below its target.
"""

from __future__ import annotations

import heapq
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitloom.llm.graph import components
from bitloom.plans.materialize import checkpointed
from bitloom.plans.skew import lookup

#: A series code: two to four letters that stand before year and number in at least this share of the
#: names that have letters there; so there are at most 1 / SERIES_SHARE codes.
SERIES_SHARE = 0.01
MIN_COMMON = 4
MIN_CHARS = 60
#: A value found under more names than this is common: such values give no pairs of names by themselves.
COMMON = 32
#: Tuples of values by which names meet at first.
TUPLES = 8


def series_codes(names: DataFrame) -> list[str]:
    """The codes that stand before year and number in the column ``name``, in capitals."""
    letters = F.upper(F.regexp_extract("name", r"(?<![\p{L}])(\p{L}{2,4})[\s_./(–-]*(?:19|20)\d\d[\s_./–-]+\d", 1)).alias("code")
    counted = checkpointed(names.select(letters).where("code <> ''").groupBy("code").agg(F.count(F.lit(1)).alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    return [r["code"] for r in counted.where(F.col("n") >= SERIES_SHARE * total).orderBy("code").collect()]


def publication_key(name: Column, series: list[str]) -> Column:
    """'CODE-year-number' however spelled: code before or behind, any separators, zeros left away.
    Null if the name holds none."""
    if not series:
        return F.lit(None).cast("string")
    code = "|".join(series)
    before = rf"(?i)(?<![\p{{L}}])({code})[\s_./(–-]*((?:19|20)\d\d)[\s_./–-]+0*(\d+)(?!\d)"
    behind = rf"(?i)(?<!\d)((?:19|20)\d\d)[\s_./–-]+0*(\d+)[\s_./–-]+({code})(?![\p{{L}}])"
    part = lambda p, i: F.regexp_extract(name, p, i)
    return F.when(name.rlike(behind) & ~name.rlike(before), F.concat_ws("-", F.upper(part(behind, 3)), part(behind, 1), part(behind, 2))).when(name.rlike(before), F.concat_ws("-", F.upper(part(before, 1)), part(before, 2), part(before, 3)))


def tuple_edges(held: DataFrame, least: int, tuples: int = TUPLES) -> DataFrame:
    """Edges (u, v) of names that hold the same ``least`` values, each the smallest by a hash of its
    own, to the smallest of them. Values come from aggregates, so no name gathers its values; each tuple takes
    those with the smallest hashes of ``least`` classes."""
    hashes = {t: F.xxhash64(F.lit(t), "h1", "h2") for t in range(tuples)}
    # values of a tuple come from as many classes of hashes, so they differ
    low = [F.min(F.when(F.pmod(h, F.lit(least)) == k, h)).alias(f"m{t}_{k}") for t, h in hashes.items() for k in range(least)]
    sketch = held.groupBy("name").agg(*low)
    each = [[F.col(f"m{t}_{k}") for k in range(least)] for t in hashes]
    full = lambda e: reduce(lambda a, b: a & b, [c.isNotNull() for c in e])
    met = sketch.select("name", F.posexplode(F.array(*[F.when(full(e), F.xxhash64(*e)) for e in each])).alias("t", "h")).where("h is not null")
    firsts = met.groupBy("t", "h").agg(F.min("name").alias("u"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return lookup(met, firsts, ["t", "h"], "n", F.col("name")).where("name <> u").select("u", F.col("name").alias("v")).distinct()


def _in_common(pairs: DataFrame, held: DataFrame, sizes: DataFrame) -> DataFrame:
    """(n, m, c): how many values of ``held`` both names of each pair hold, if any. Each pair asks
    the values of the name that has fewer of them, and these are looked up under the other."""
    a = sizes.select(F.col("name").alias("n"), F.col("values").alias("sn"))
    b = sizes.select(F.col("name").alias("m"), F.col("values").alias("sm"))
    sized = pairs.join(a, "n").join(b, "m")
    fewer = F.col("sn") <= F.col("sm")
    asked = sized.select("n", "m", F.when(fewer, F.col("n")).otherwise(F.col("m")).alias("name"), F.when(fewer, F.col("m")).otherwise(F.col("n")).alias("other"))
    values = asked.join(held, "name").select("n", "m", "other", "h1", "h2")
    return values.join(held.withColumnRenamed("name", "other"), ["other", "h1", "h2"], "left_semi").groupBy("n", "m").agg(F.count(F.lit(1)).alias("c"))


def common_value_edges(values: DataFrame, least: int = MIN_COMMON, common: int = COMMON, known: DataFrame | None = None) -> DataFrame:
    """Edges (u, v) that together with ``known`` ones connect all names with at least ``least`` values
    in common; those of ``known`` are among them.

    ``values``: columns name, h1, h2; repeated rows are allowed. What the first edges (see
    :func:`tuple_edges`) leave apart is found exactly: values under at most ``common`` names give
    pairs of names that are apart, with their number of values in common; common values are taken
    in ever longer tuples, which are given up once all names that hold one are connected, and which
    give pairs once at most ``common`` names hold one. A value whose names are connected is left out
    from the start, so values that whole groups have in common cost nothing further.
    """
    held = checkpointed(values.select("name", "h1", "h2").where(F.col("name").isNotNull()).distinct())
    first = tuple_edges(held, least)
    first = checkpointed(first if known is None else first.unionByName(known.select("u", "v")))
    labels = checkpointed(components(first))
    of_name = held.groupBy("name").agg(F.count(F.lit(1)).alias("values")).join(labels, F.col("name") == labels["node"], "left").select("name", "values", F.coalesce("root", "name").alias("comp"))
    placed = lookup(held, of_name, ["name"], "values", F.col("h1"))
    spread = placed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("df"), F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").drop("a", "b")
    # only values whose names are apart
    apart = checkpointed(lookup(placed, spread.withColumn("size", F.col("df")), ["h1", "h2"], "size", F.col("name")))
    rare = apart.where(F.col("df") <= common).select("h1", "h2", F.col("name").alias("n"), F.col("comp").alias("cn"))
    other = rare.withColumnsRenamed({"n": "m", "cn": "cm"})
    pairs = checkpointed(rare.join(other, ["h1", "h2"]).where("n < m and cn <> cm").groupBy("n", "m").agg(F.count(F.lit(1)).alias("c")))
    edges = [first, pairs.where(F.col("c") >= least).select(F.col("n").alias("u"), F.col("m").alias("v"))]
    frequent = apart.where(F.col("df") > common).select("name", "comp", "h1", "h2")
    sizes = frequent.groupBy("name").agg(F.count(F.lit(1)).alias("values"))
    frequent, sizes = checkpointed(frequent), checkpointed(sizes)
    if not sizes.isEmpty():
        near = _in_common(pairs.where(F.col("c") < least).select("n", "m"), frequent.drop("comp"), sizes).withColumnRenamed("c", "more").join(pairs, ["n", "m"])
        edges.append(near.where(F.col("more") + F.col("c") >= least).select(F.col("n").alias("u"), F.col("m").alias("v")))
        edges += _frequent_edges(frequent, sizes, least, common)
    return reduce(DataFrame.unionByName, edges).select("u", "v")


def _frequent_edges(frequent: DataFrame, sizes: DataFrame, least: int, common: int) -> list[DataFrame]:
    """Edges of names that are apart and have at least ``least`` of the common values in common."""
    edges, few = [], []
    enough = frequent.join(sizes.where(F.col("values") >= least).select("name"), "name", "left_semi")
    level = enough.select("name", "comp", "h1", "h2", F.xxhash64("h1", "h2").alias("path"))
    for depth in range(1, least + 1):
        groups = level.groupBy("path").agg(F.count(F.lit(1)).alias("k"), F.min("name").alias("low"), F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("path", "k", "low")
        kept = checkpointed(lookup(level, groups.withColumn("size", F.col("k")), ["path"], "size", F.col("name")))
        if depth == least:
            edges.append(kept.where("name <> low").select(F.col("low").alias("u"), F.col("name").alias("v")))
            break
        small = kept.where(F.col("k") <= common).select("path", F.col("name").alias("n"), F.col("comp").alias("cn"))
        few.append(small.join(small.withColumnsRenamed({"n": "m", "cn": "cm"}), "path").where("n < m and cn <> cm").select("n", "m"))
        longer = kept.where(F.col("k") > common).select("name", "comp", F.struct("h1", "h2").alias("last"), "path")
        step = longer.join(enough.select("name", "h1", "h2"), "name").where(F.struct("h1", "h2") > F.col("last"))
        level = step.select("name", "comp", "h1", "h2", F.xxhash64("path", "h1", "h2").alias("path"))
    if few:
        pairs = reduce(DataFrame.unionByName, few).distinct()
        edges.append(_in_common(pairs, frequent.drop("comp"), sizes).where(F.col("c") >= least).select(F.col("n").alias("u"), F.col("m").alias("v")))
    return edges


def related_names(docs: DataFrame) -> DataFrame:
    """(name, group): every non-null document_name with the smallest name related to it. Null names
    have no row; a null or short ``en`` relates nothing; an empty table gives no rows."""
    squeezed = F.trim(F.regexp_replace(F.lower("en"), r"(?U)\s+", " "))
    rows = docs.where(F.col("document_name").isNotNull()).select(F.col("document_name").alias("name"), squeezed.alias("t"))
    names = checkpointed(rows.select("name").distinct())
    # A key is a node of its own; the tab keeps it apart from names, which may hold anything else.
    keyed = names.select(F.col("name").alias("u"), F.concat(F.lit("\tkey "), publication_key(F.col("name"), series_codes(names))).alias("v")).where(F.col("v").isNotNull())
    values = rows.where(F.length("t") >= MIN_CHARS).select("name", F.xxhash64("t").alias("h1"), F.xxhash64(F.lit(1), "t").alias("h2"))
    labels = checkpointed(components(common_value_edges(values, known=keyed)))
    member = names.join(labels, names["name"] == labels["node"], "left").select("name", F.coalesce("root", "name").alias("root"))
    low = member.groupBy("root").agg(F.min("name").alias("group"), F.count(F.lit(1)).alias("n"))
    return lookup(member, low, ["root"], "n", F.col("name")).select("name", "group")


def found_relations(docs: DataFrame) -> DataFrame:
    return related_names(docs).where("name <> group").select(F.col("group").alias("name_a"), F.col("name").alias("name_b"))


def assign_sizes(sizes: list[tuple[int, int]], shares: list[tuple[str, float]]) -> list[tuple[int, str, int, int]]:
    """Largest-first greedy over (size, number of groups): runs (size, split, first rank, number).

    Every run goes to the split furthest below its target; a run ends where another split is. A tie
    goes to the split named first. ``sizes`` holds each size once, so at most sqrt(2 rows) entries.
    """
    total = sum(s * n for s, n in sizes)
    scale = sum(share for _, share in shares) or 1.0
    heap = [(-(share / scale) * total, i, name) for i, (name, share) in enumerate(shares)]
    heapq.heapify(heap)
    runs: list[tuple[int, str, int, int]] = []
    for size, left in sorted(sizes, reverse=True):
        rank = 0
        while left:
            lack, i, name = heapq.heappop(heap)
            ahead = (heap[0][0] - lack) / size if heap else left
            step = max(left // 1024, 1)  # near a tie whole blocks go round, each at most 1/1024 of the size's groups
            n = min(left, max(int(ahead), step, 1))
            heapq.heappush(heap, (lack + n * size, i, name))
            if runs and runs[-1][:2] == (size, name):
                runs[-1] = (size, name, runs[-1][2], runs[-1][3] + n)
            else:
                runs.append((size, name, rank, n))
            rank, left = rank + n, left - n
    return runs


def split_groups(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``groups`` (columns group, n_rows) with ``split_name``; shares: a row per split.

    The driver sees the histogram of sizes and the runs made of it, never the groups. A group's rank
    among those of its size comes from range partitions, numbered within each.
    """
    names = [(r["split_name"], float(r["target_share"] or 0)) for r in shares.where("split_name is not null").orderBy(F.desc("target_share"), "split_name").collect()]
    if not names:
        return groups.withColumn("split_name", F.lit(None).cast("string"))
    spark = groups.sparkSession
    ranged = checkpointed(groups.repartitionByRange("n_rows", "group").withColumn("__p", F.spark_partition_id()))
    per = ranged.groupBy("n_rows", "__p").agg(F.count(F.lit(1)).alias("n")).orderBy("n_rows", "__p").collect()  # sizes + partitions rows
    sizes: dict[int, int] = {}
    starts = []
    for r in per:
        starts.append((r["n_rows"], r["__p"], sizes.get(r["n_rows"], 0)))
        sizes[r["n_rows"]] = sizes.get(r["n_rows"], 0) + r["n"]
    runs = assign_sizes(list(sizes.items()), names)
    start = spark.createDataFrame(starts, "n_rows long, __p int, __start long")
    by_size = {}
    for size, name, rank, n in runs:
        by_size.setdefault(size, []).append((rank + n, name))
    run = spark.createDataFrame(list(by_size.items()), T.StructType.fromDDL("n_rows long, __runs array<struct<upto: long, name: string>>"))
    local = F.row_number().over(Window.partitionBy("n_rows", "__p").orderBy("group"))
    placed = ranged.withColumn("__r", local).join(F.broadcast(start), ["n_rows", "__p"]).join(F.broadcast(run), "n_rows")
    chosen = F.filter("__runs", lambda x: F.col("__r") + F.col("__start") <= x["upto"])[0]["name"]
    return placed.select("group", "n_rows", chosen.alias("split_name"))


def assign_rows(docs: DataFrame, shares: DataFrame) -> DataFrame:
    """(match_id, document_name, split_name): every row; rows without a name are each on their own."""
    named = checkpointed(docs.where(F.col("document_name").isNotNull()).groupBy(F.col("document_name").alias("name")).agg(F.count(F.lit(1)).alias("n")).join(related_names(docs), "name"))
    alone = F.concat(F.lit("\trow "), F.col("match_id").cast("string"))
    single = docs.where(F.col("document_name").isNull()).select("match_id", "document_name", alone.alias("group"))
    groups = named.groupBy("group").agg(F.sum("n").alias("n_rows")).unionByName(single.select("group", F.lit(1).cast("long").alias("n_rows")))
    placed = checkpointed(split_groups(groups, shares).drop("n_rows"))
    of_group = placed.join(named.groupBy("group").agg(F.count(F.lit(1)).alias("names")), "group")
    of_name = lookup(named, of_group, ["group"], "names", F.col("name")).select(F.col("name").alias("document_name"), "n", "split_name")
    rows = lookup(docs.select("match_id", "document_name"), of_name, ["document_name"], "n", F.col("match_id"))
    return rows.select("match_id", "document_name", "split_name").unionByName(single.join(placed, "group").select("match_id", "document_name", "split_name"))
