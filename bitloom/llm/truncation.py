"""Values that lost their end (problem 4), in SQL.

Word trigrams are counted inside values and at their ends, and every value's last trigram is looked up
among them: it is cut there if its words are frequent inside and almost never terminal. The last word
may be the beginning of one: a longer word after the same two is an inside use of it. Names and numbers
are masked. Shares are drawn towards those of the last two words, of the last word and of all words, so
that they mean the same at any size; a rare trigram doesn't decide by itself. Headings, captions and
list entries are counted apart from prose: they are lines whose opening has mostly no mark at its end.

An ellipsis at the end is meant if it is usual after the last two words, else it marks a cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.plans.materialize import checkpointed
from bitloom.plans.skew import lookup

#: Share of a trigram's uses at ends up to which it is almost never terminal.
TERMINAL = 0.03
#: Share of the lines with an opening that have no mark at their end, from which they are labels
#: (headings, captions, list entries), and the lines of usual share that are added to each opening's.
LABEL, LABEL_PRIOR = 0.5, 4
#: Labels up to which they are broadcast; beyond that values are shuffled by their openings.
FEW_LABELS = 20_000
#: Uses of the shorter context's share that are added to each context's own.
PRIOR = 2
#: Share of the uses of two words that have an ellipsis behind them, above which one is meant; and share
#: of a word's uses that aren't before an ellipsis at an end, below which it is only ever a fragment.
MEANT, WORD = 0.1, 0.1

#: Characters of scripts without spaces (and of those whose words are told by syllables),
#: which count as words; and marks that do.
UNSPACED = r"\x{0900}-\x{0DFF}\x{0E00}-\x{0EFF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{FF61}-\x{FF9F}"
TOKEN = rf"\.\.\.+|…|\pL?\pN[\pN.,:\-]*\pN|\pL?\pN|[{UNSPACED}]|[\pL\pM]+[\x{{27}}’]?|[.,;:!?()।॥。！？｡%/\-]"
NUMBER, CAPITAL = r"^\pL?\pN", r"^\p{Lu}"
#: How a value's last line ends, and white space.
MARKED = r"[.!?。！？।॥｡…][\"”’»)\]」』）]*\z"
BLANKS = " \t\n\v\f\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _in_sql(pattern: str) -> str:
    """A pattern as a literal of a query that is formatted afterwards."""
    return "r'" + pattern.replace("{", "{{").replace("}", "}}") + "'"


_OPENING = _in_sql(rf"({TOKEN})(?:.*?({TOKEN}))?")
_TOKEN, _NUMBER, _CAPITAL, _DOTS = map(_in_sql, (TOKEN, NUMBER, CAPITAL, r"^\.\.\."))

_VALUES = rf"""
select match_id, side, source, text,
       array_join(transform(filter(array(regexp_extract(line, {_OPENING}, 1), regexp_extract(line, {_OPENING}, 2)), x -> x <> ''),
                            x -> case when x rlike {_NUMBER} then '#' else lower(x) end), ' ') as opening,
       not text rlike {_in_sql(MARKED)} as unmarked
from (select match_id, source, side, text, element_at(split(text, r'[\n\r]+'), -1) as line from (select match_id, source, side, rtrim('{BLANKS}', text) as text
      from (select match_id, source, stack(2, 'en', en, 'fr', fr) as (side, text) from {{docs}})))
where text <> ''
"""

_OPENINGS = r"""
select opening, count(*) as lines, count_if(unmarked) as unmarked from {v} group by opening
"""

_LABELS = r"""
select opening, lines,
       (unmarked + {prior} * (select coalesce(sum(unmarked) / sum(lines), 0.0) from {o})) / (lines + {prior}) >= {label} as label
from {o}
"""

# The ellipsis of a value that ends in one is kept apart from its words.
_WORDS = rf"""
select *, size(words) > 1 and element_at(words, -1) = '…' as trails
from (select match_id, side, source, label,
             transform(regexp_extract_all(text, {_TOKEN}, 0),
                       x -> case when x rlike {_NUMBER} then '#' when x rlike {_DOTS} then '…'
                                 when x rlike {_CAPITAL} then '§' else lower(x) end) as words
      from {{c}})
"""

# Every trigram, once per class; a context is the hash of the words before the last one.
_TRIGRAMS = r"""
select label, w1, w2, w3, count_if(not final) as inside, count_if(final) as terminal
from (select label, inline(transform(sequence(1, size(words)), i -> struct(
               if(i > 2, words[i - 3], '^') as w1, if(i > 1, words[i - 2], '^') as w2, words[i - 1] as w3, i = size(words) as final)))
      from {e} where size(words) > 0)
group by label, w1, w2, w3
"""

_CONTEXTS = r"""
select xxhash64(3, label, w1, w2) as context, w3, inside, terminal from {t}
union all select xxhash64(2, label, w2), w3, sum(inside), sum(terminal) from {t} group by label, w2, w3
union all select xxhash64(1, label), w3, sum(inside), sum(terminal) from {t} group by label, w3
"""

# The last trigram of each value, each once with the number of values.
_LAST = r"""
select label, trails, w1, w2, w3, count(*) as n,
       xxhash64(label, trails, w1, w2, w3) as key
from (select label, trails, if(k > 2, words[k - 3], '^') as w1, if(k > 1, words[k - 2], '^') as w2, words[k - 1] as w3
      from (select *, if(trails, size(words) - 1, size(words)) as k from {e}) where k > 0)
group by label, trails, w1, w2, w3
"""

# What has to be known of each: counts of contexts with the word or longer ones (or, if exact, with it only).
_ASKED = r"""
select distinct context, w, exact from (
  select inline(if(trails, array(
           named_struct('context', xxhash64(2, label, w2), 'w', w3, 'exact', false),
           named_struct('context', xxhash64(1, label), 'w', w3, 'exact', false),
           named_struct('context', xxhash64(3, label, w2, w3), 'w', '…', 'exact', true),
           named_struct('context', xxhash64(2, label, w3), 'w', '…', 'exact', true),
           named_struct('context', xxhash64(1, label), 'w', w3, 'exact', true)),
         array(
           named_struct('context', xxhash64(3, label, w1, w2), 'w', w3, 'exact', false),
           named_struct('context', xxhash64(2, label, w2), 'w', w3, 'exact', false),
           named_struct('context', xxhash64(1, label), 'w', w3, 'exact', false))))
  from {l})
"""

# Words meet by up to three characters, so that a frequent context's words are spread over many keys.
_ANSWERED = r"""
select a.context, a.w, a.exact, sum(if(t.w3 = a.w, inside, inside + terminal)) as inside, sum(if(t.w3 = a.w, terminal, 0)) as terminal
from {a} a
join (select context, w3, inside, terminal, explode(transform(sequence(1, least(length(w3), 3)), k -> substring(w3, 1, k))) as head from {t}) t
  on a.context = t.context and substring(a.w, 1, 3) = t.head and startswith(t.w3, a.w) and (not a.exact or t.w3 = a.w)
group by a.context, a.w, a.exact
"""

_SHARES = r"""
select label, sum(terminal) / (sum(terminal) + sum(inside)) as usual from {t} group by label
"""

# A trigram's own value is taken off the terminal ones.
_JUDGED = r"""
select key, n, case when trails then not (known and meant > {meant}) else share <= {terminal} end as truncated
from (
  select key, n, trails,
         (t3 + {prior} * (t2 + {prior} * (t1 + {prior} * usual) / (i1 + t1 + {prior})) / (i2 + t2 + {prior})) / (i3 + t3 + {prior}) as share,
         (e2 - 1 + {prior} * (e1 - 1) / (i1 - 1 + {prior})) / (i2 - 1 + {prior}) as meant,
         x1 - e1 + m1 > {word} * (x1 - e1 + m1 + e1 - m1 - 1) as known
  from (
    select l.key, l.n, l.trails, s.usual,
           coalesce(a3.inside, 0) as i3, coalesce(a3.terminal, 0) - 1 as t3,
           coalesce(a2.inside, 0) as i2, coalesce(a2.terminal, 0) - 1 as t2,
           coalesce(a1.inside, 0) as i1, coalesce(a1.terminal, 0) - 1 as t1,
           coalesce(p2.inside + p2.terminal, 0) as e2, coalesce(p1.inside + p1.terminal, 0) as e1,
           coalesce(p1.inside, 0) as m1, coalesce(x1.inside, 0) as x1
    from {l} l join {s} s on l.label = s.label
    left join {a} a3 on not l.trails and a3.context = xxhash64(3, l.label, l.w1, l.w2) and a3.w = l.w3 and not a3.exact
    left join {a} a2 on a2.context = xxhash64(2, l.label, l.w2) and a2.w = l.w3 and not a2.exact
    left join {a} a1 on a1.context = xxhash64(1, l.label) and a1.w = l.w3 and not a1.exact
    left join {a} p2 on l.trails and p2.context = xxhash64(3, l.label, l.w2, l.w3) and p2.w = '…' and p2.exact
    left join {a} p1 on l.trails and p1.context = xxhash64(2, l.label, l.w3) and p1.w = '…' and p1.exact
    left join {a} x1 on l.trails and x1.context = xxhash64(1, l.label) and x1.w = l.w3 and x1.exact))
"""

_KEYED = r"""
select match_id, side, source,
       if(k > 0, xxhash64(label, trails, if(k > 2, words[k - 3], '^'), if(k > 1, words[k - 2], '^'), words[k - 1]), null) as key
from (select *, if(trails, size(words) - 1, size(words)) as k from {e})
"""


def judged(docs: DataFrame) -> DataFrame:
    """(match_id, side, source, truncated): every value that isn't null or blank. Copies of a row count
    by themselves; a value without words or marks isn't truncated; other columns may have any names."""
    spark = docs.sparkSession
    values = spark.sql(_VALUES, docs=docs)
    openings = checkpointed(spark.sql(_OPENINGS, v=values))
    labels = checkpointed(spark.sql(_LABELS, o=openings, prior=LABEL_PRIOR, label=LABEL).where("label"))
    if labels.count() <= FEW_LABELS and (labels.agg(F.sum(F.length("opening"))).first()[0] or 0) <= 100 * FEW_LABELS:
        classed = values.join(F.broadcast(labels.drop("lines")), "opening", "left")
    else:
        classed = lookup(values, labels, ["opening"], "lines", F.col("match_id"), how="left")
    classed = classed.withColumn("label", F.coalesce("label", F.lit(False)))
    ends = checkpointed(spark.sql(_WORDS, c=classed))
    trigrams = checkpointed(spark.sql(_TRIGRAMS, e=ends))
    last = checkpointed(spark.sql(_LAST, e=ends))
    answered = checkpointed(spark.sql(_ANSWERED, a=spark.sql(_ASKED, l=last), t=spark.sql(_CONTEXTS, t=trigrams)))
    verdicts = spark.sql(_JUDGED, l=last, a=answered, s=spark.sql(_SHARES, t=trigrams), prior=PRIOR, terminal=TERMINAL, meant=MEANT, word=WORD)
    found = lookup(spark.sql(_KEYED, e=ends), verdicts, ["key"], "n", F.col("match_id"), how="left")
    return found.select("match_id", "side", "source", F.coalesce("truncated", F.lit(False)).alias("truncated"))


def found_truncated(docs: DataFrame) -> DataFrame:
    return judged(docs).where("truncated").select("match_id", "side")


def truncation_rates(docs: DataFrame) -> DataFrame:
    """(source, n_values, n_truncated, rate) of every source; a null source is one of its own."""
    return docs.sparkSession.sql("select source, count(*) as n_values, count_if(truncated) as n_truncated, count_if(truncated) / count(*) as rate from {j} group by source", j=judged(docs))
