"""Diagnostics of bitext: stray letters and apostrophes, comparisons of sets, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitloom.functions import features as X
from bitloom.operators.evaluation import quantiles

#: What stands before the letters of English contractions.
ENGLISH = {
    "t": "don doesn didn won wouldn couldn shouldn isn aren wasn weren hasn haven hadn ain can", "s": "it that what who where when why how there here everyone everything something nothing he she this", "m": "i",
    "d": "i you he she it we they there that who what", "ll": "i you he she it we they there who what", "ve": "i you we they would could should might must", "re": "you we they here there who what",
}
#: What stands behind the letters of French elisions.
FRENCH = {
    "j": "ai avais aurai aurais étais irai irais aime adore arrive attends entends espère ignore imagine habite ouvre", "l": "a est avait aurait auront on un une autre homme enfant ami amie air eau école âge indice",
    "d": "un une abord accord ailleurs après autant entre eux elle elles ici où", "n": "a ai as avons avez ont es est êtes importe", "m": "as a en y appelle étais étaient", "t": "as a es est y en il elle on",
    "s": "il ils est était en y", "c": "est était a en", "qu": "il ils elle elles on un une est en",
}


def sides(bitext: DataFrame) -> DataFrame:
    """(match_id, lang, text): each side that isn't null."""
    return bitext.select("match_id", F.explode(F.create_map(F.lit("en"), F.col("en"), F.lit("fr"), F.col("fr"))).alias("lang", "text")).where("text is not null")


def letter_context(texts: DataFrame) -> DataFrame:
    """(match_id, lang, pos, letter, previous, next): single letters that are no words, and the words
    beside them; null at the ends."""
    words = texts.withColumn("w", X.words(F.col("text")))
    each = words.select("match_id", "lang", "w", F.explode(X.single_letters(F.col("text"))).alias("s"))
    legit = (F.col("lang") == "en") & F.col("s.letter").isin(*X.LETTERS["en"]) | (F.col("lang") == "fr") & F.col("s.letter").isin(*X.LETTERS["fr"])
    clean = lambda c: F.lower(F.btrim(c, F.lit(X.STRIPPED)))
    return each.where(~legit & ~F.col("s.letter").rlike("^[0-9]$")).select("match_id", "lang", F.col("s.pos").alias("pos"), F.col("s.letter").alias("letter"), clean(F.get("w", F.col("s.pos") - 1)).alias("previous"), clean(F.get("w", F.col("s.pos") + 1)).alias("next"))


def letter_patterns(context: DataFrame) -> DataFrame:
    """(lang, letter, other_word, direction, n, example): how often each letter stands beside each
    word; the example is the smallest match_id."""
    beside = F.explode(F.array(F.struct(F.lit("before").alias("direction"), F.col("previous").alias("other_word")), F.struct(F.lit("after").alias("direction"), F.col("next").alias("other_word"))))
    return context.select("match_id", "lang", "letter", beside.alias("x")).select("match_id", "lang", "letter", "x.*").where("other_word is not null").groupBy("lang", "letter", "other_word", "direction").agg(F.count(F.lit(1)).alias("n"), F.min("match_id").alias("example"))


def missing_apostrophes(context: DataFrame) -> DataFrame:
    """Letters beside a word with which they make a contraction, with the repaired ``pattern``."""
    spark = context.sparkSession
    rows = [("en", letter, w, "previous") for letter, ws in ENGLISH.items() for w in ws.split()] + [("fr", letter, w, "next") for letter, ws in FRENCH.items() for w in ws.split()]
    table = F.broadcast(spark.createDataFrame(rows, "lang string, letter string, other string, side string"))
    word = F.when(F.col("lang") == "en", F.col("previous")).otherwise(F.col("next"))
    return context.withColumn("other", word).join(table.drop("side"), ["lang", "letter", "other"]).select("match_id", "lang", "pos", F.when(F.col("lang") == "en", F.concat("other", F.lit("'"), "letter")).otherwise(F.concat("letter", F.lit("'"), "other")).alias("pattern"))


def issue_summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("lang").agg(F.count(F.lit(1)).alias("n_issues"), F.count_distinct("match_id").alias("n_rows"), F.count_distinct("pattern").alias("n_patterns"))


def contraction_sets(texts: DataFrame) -> DataFrame:
    """(lang, before, afters): the words behind each beginning of at most two letters and an
    apostrophe; words with digits or several apostrophes are left out."""
    w = texts.select("lang", F.explode(X.words(F.lower(F.translate("text", "’", "'")))).alias("w")).select("lang", F.btrim("w", F.lit(".,!?;:\"()[]{}«»")).alias("w"))
    pattern = r"^(\p{L}{1,2})'(\p{L}+)$"
    return w.where(F.col("w").rlike(pattern)).select("lang", F.regexp_extract("w", pattern, 1).alias("before"), F.regexp_extract("w", pattern, 2).alias("after")).groupBy("lang", "before").agg(F.array_sort(F.collect_set("after")).alias("afters"))


def spaced_apostrophes(texts: DataFrame) -> DataFrame:
    """(match_id, lang, pattern): words ending in an apostrophe with the next one, and beginning with
    one with the previous one."""
    w = texts.select("match_id", "lang", X.words(F.col("text")).alias("w"))
    pair = F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - 2, F.lit(0))), lambda i: F.struct(F.get("w", i).alias("a"), F.get("w", i + 1).alias("b")))
    return w.select("match_id", "lang", F.explode(pair).alias("x")).where("x.b is not null").where(F.col("x.a").rlike("[a-zA-Z]'$") | F.col("x.b").rlike("^'[a-zA-Z]")).select("match_id", "lang", F.concat_ws(" ", "x.a", "x.b").alias("pattern"))


def flag_counts(flags: DataFrame, names: list[str]) -> DataFrame:
    """(flag, n_true, n_false), nulls count as false."""
    long = flags.select(F.explode(F.array(*[F.struct(F.lit(n).alias("flag"), F.coalesce(F.col(n), F.lit(False)).alias("v")) for n in names])).alias("x")).select("x.*")
    return long.groupBy("flag").agg(F.count_if("v").alias("n_true"), F.count_if(~F.col("v")).alias("n_false"))


def trigger_counts(flags: DataFrame, names: list[str]) -> DataFrame:
    """(n_triggers, n_rows): rows by how many flags they have."""
    return flags.select(sum((F.coalesce(F.col(n), F.lit(False)).cast("int") for n in names), F.lit(0)).alias("n_triggers")).groupBy("n_triggers").agg(F.count(F.lit(1)).alias("n_rows"))


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, rows): rows of each that the other lacks, counted with their copies; both null-safe."""
    return a.exceptAll(b).select(F.lit("first").alias("side")).unionAll(b.exceptAll(a).select(F.lit("second").alias("side"))).groupBy("side").agg(F.count(F.lit(1)).alias("rows"))


def comparison(a: DataFrame, b: DataFrame, order: str | None = None) -> DataFrame:
    """(verdict): same multiset, same set, or different, of two tables with the same columns. With
    ``order``, a column that says where a row stands, also same sequence; it counts for that only."""
    if order is not None:
        whole = comparison(a, b).select((F.col("verdict") == "same multiset").alias("sequence"))
        # one row each
        both = whole.withColumn("k", F.lit(0)).join(comparison(a.drop(order), b.drop(order)).withColumn("k", F.lit(0)), "k")
        return both.select(F.when(F.col("sequence"), "same sequence").otherwise(F.col("verdict")).alias("verdict"))
    columns = a.columns
    zero = F.lit(0).cast("long")
    own = a.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__m", zero)
    other = b.groupBy(*columns).agg(F.count(F.lit(1)).alias("__m")).withColumn("__n", zero)
    both = own.unionByName(other).groupBy(*columns).agg(F.sum("__n").alias("__n"), F.sum("__m").alias("__m"))
    counts = both.agg(F.count_if(F.col("__n") != F.col("__m")).alias("x"), F.count_if((F.col("__n") == 0) | (F.col("__m") == 0)).alias("y"))
    return counts.select(F.when(F.col("x") == 0, "same multiset").when(F.col("y") == 0, "same set").otherwise("different").alias("verdict"))


def membership(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(found, n_rows): rows of ``a``, with their copies, that ``b`` has or lacks; nulls equal nulls."""
    own = b.groupBy(*keys).agg(F.lit(True).alias("__in"))
    condition = [a[k].eqNullSafe(own[k]) for k in keys]
    return a.join(own, condition, "left").groupBy(F.coalesce("__in", F.lit(False)).alias("found")).agg(F.count(F.lit(1)).alias("n_rows"))


def pattern_difference(own: DataFrame, reference: DataFrame) -> DataFrame:
    """(key, missing, extra) of two tables (key, items), keys without any difference left out."""
    both = own.select("key", F.col("items").alias("a")).join(reference.select("key", F.col("items").alias("b")), "key", "full")
    empty = F.array().cast("array<string>")
    out = both.select("key", F.array_sort(F.array_except(F.coalesce("b", empty), F.coalesce("a", empty))).alias("missing"), F.array_sort(F.array_except(F.coalesce("a", empty), F.coalesce("b", empty))).alias("extra"))
    return out.where((F.size("missing") > 0) | (F.size("extra") > 0))


def describe(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, mean, std, low, median, high)."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("x")).select("x.*")
    stats = long.groupBy("column").agg(F.count("v").alias("n"), F.round(F.avg("v"), 4).alias("mean"), F.round(F.stddev_samp("v"), 4).alias("std"), F.min("v").alias("low"), F.max("v").alias("high"))
    middle = quantiles(long, "v", ["column"], (0.5,)).select("column", F.col("q0").alias("median"))
    return stats.join(middle, "column", "left").select("column", "n", "mean", "std", "low", "median", "high")


def good_paragraphs(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, paragraph): paragraphs with two periods, and letters and spaces for at least 100 and
    0.95 of their characters."""
    each = texts.select(key, F.posexplode(F.split(text, r"\n\n+")).alias("pos", "paragraph"))
    plain = F.length(F.regexp_replace("paragraph", r"[^\p{L}\s]", ""))
    return each.where((F.regexp_count("paragraph", F.lit(r"\.")) >= 2) & (plain >= 100) & (plain >= 0.95 * F.length("paragraph")))


def contraction_suffixes(words: DataFrame, word: str) -> DataFrame:
    """(suffix, prefixes): what stands before the last apostrophe of each English ending; of words in
    printable ASCII."""
    w = F.replace(F.col(word), F.lit("’"), F.lit("'"))
    pattern = r"\A(.+)'([^']+)\z"
    known = words.where(F.col(word).rlike(r"\A[\x20-\x7E’]*\z")).select(F.regexp_extract(w, pattern, 1).alias("prefix"), F.regexp_extract(w, pattern, 2).alias("suffix"))
    return known.where(F.col("suffix").isin(*ENGLISH) & (F.col("prefix") != "")).groupBy("suffix").agg(F.array_sort(F.collect_set("prefix")).alias("prefixes"))


def cleaning_pairs(patterns: DataFrame) -> DataFrame:
    """(pattern, cleaned): spaced apostrophes and their repaired form, each pattern once."""
    return patterns.select("pattern", F.regexp_replace("pattern", r" *' *", "'").alias("cleaned")).distinct()


def inspection_sample(flags: DataFrame, names: list[str], key: str, each: int = 5, kept: int = 22) -> DataFrame:
    """(flag, key): for every flag ``each`` rows that only it excludes, and ``kept`` rows without any
    under 'kept', those with the smallest digests of the key."""
    on = F.filter(F.array(*[F.when(F.coalesce(F.col(n), F.lit(False)), F.lit(n)) for n in names]), lambda x: x.isNotNull())
    one = flags.select(key, on.alias("on")).where(F.size("on") <= 1).select(key, F.coalesce(F.get("on", F.lit(0)), F.lit("kept")).alias("flag"))
    w = Window.partitionBy("flag").orderBy(F.md5(F.col(key).cast("string")), key)
    return one.withColumn("r", F.row_number().over(w)).where(F.col("r") <= F.when(F.col("flag") == "kept", kept).otherwise(each)).select("flag", key)
