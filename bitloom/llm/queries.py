"""Queries of the training-data problems over whole tables, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bitloom.llm import alignment, copies, languages, leaks, overlaps, packing, sentences, spam, splits, truncation
from bitloom.session import table


def _splitter(spark: SparkSession, d: str) -> sentences.Splitter:
    return sentences.fitted(table(spark, d, "docx_sentences"), table(spark, d, "matched_docx_data"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": lambda s, d: copies.found_copies(table(s, d, "table_translations")),
        "p1_records": lambda s, d: copies.records(table(s, d, "table_translations")),
        "p2_found": lambda s, d: sentences.units(table(s, d, "matched_docx_data"), _splitter(s, d)),
        "p3_found": lambda s, d: alignment.aligned(table(s, d, "docx_sentences")),
        "p4_found": lambda s, d: truncation.found_truncated(table(s, d, "matched_docx_data")),
        "p4_rates": lambda s, d: truncation.truncation_rates(table(s, d, "matched_docx_data")),
        "p5_found": lambda s, d: splits.found_relations(table(s, d, "matched_docx_data")),
        "p5_splits": lambda s, d: splits.assign_rows(table(s, d, "matched_docx_data"), table(s, d, "split_shares")),
        "p6_found": lambda s, d: overlaps.found_overlaps(table(s, d, "training_data")),
        "p6_totals": lambda s, d: overlaps.overlap_totals(table(s, d, "training_data")),
        "p7_found": lambda s, d: languages.found_languages(table(s, d, "matched_docx_data"), table(s, d, "documents"), _splitter(s, d)),
        "p7_segments": lambda s, d: languages.segments(table(s, d, "matched_docx_data"), table(s, d, "documents"), _splitter(s, d)),
        "p8_containers": lambda s, d: packing.containers(table(s, d, "documents"), table(s, d, "container_sizes")),
        "p9_found": lambda s, d: leaks.found_leaks(table(s, d, "documents"), table(s, d, "eval_items")),
        "p9_spans": lambda s, d: leaks.leak_spans(table(s, d, "documents"), table(s, d, "eval_items")),
        "p10_found": lambda s, d: spam.found_spam(table(s, d, "documents")),
        "p10_shares": lambda s, d: spam.spam_share(table(s, d, "documents")).select("doc_id", "chars", "spam_chars"),
    }


#: The normal form of a text, and of a record as the pair of both in order, of problem 1.
_NORMAL = r"""
with marked as (
  select row_id, en, fr, count,
         regexp_replace(regexp_replace(lower(upper(nfc_normalize(en))), '([0-9])[.,]([0-9])', '\1⎖\2', 'g'), '([0-9])[.,]([0-9])', '\1⎖\2', 'g') as a,
         regexp_replace(regexp_replace(lower(upper(nfc_normalize(fr))), '([0-9])[.,]([0-9])', '\1⎖\2', 'g'), '([0-9])[.,]([0-9])', '\1⎖\2', 'g') as b
  from table_translations),
bare as (
  select row_id, en, fr, count,
         nullif(regexp_replace(a, '[\pP\pZ\pC]+', '', 'g'), '') as a, nullif(regexp_replace(b, '[\pP\pZ\pC]+', '', 'g'), '') as b
  from marked),
keyed as (
  select *, case when a is null and b is null then 'row ' || row_id else least(coalesce(a, ''), coalesce(b, '')) || chr(1) || greatest(coalesce(a, ''), coalesce(b, '')) end as k from bare),
firsts as (select *, min(row_id) over (partition by k) as first_id from keyed)
"""


#: The truncated values of problem 4: prefixes are counted outright here.
_TRUNCATED = f"""
with given as (select match_id, source, 'en' as side, rtrim(en, '{truncation.BLANKS}') as t from matched_docx_data union all select match_id, source, 'fr', rtrim(fr, '{truncation.BLANKS}') from matched_docx_data),
cut as (
  select match_id, source, side, regexp_extract_all(t, '{truncation.TOKEN}') as raw, not regexp_matches(t, '{truncation.MARKED}') as unmarked,
         array_to_string(list_transform(regexp_extract_all(string_split_regex(t, '[\n\r]+')[-1], '{truncation.TOKEN}')[1:2], lambda x: case when regexp_matches(x, '{truncation.NUMBER}') then '#' else lower(x) end), ' ') as opening
  from given where t <> ''),
labels as (
  select opening, (count(*) filter (where unmarked) + {truncation.LABEL_PRIOR} * (select count(*) filter (where unmarked) / count(*) from cut)) / (count(*) + {truncation.LABEL_PRIOR}) >= {truncation.LABEL} as label
  from cut group by opening),
worded as (
  select match_id, source, side, label, list_transform(raw, lambda x: case when regexp_matches(x, '{truncation.NUMBER}') then '#' when starts_with(x, '...') then '…' when regexp_matches(x, '{truncation.CAPITAL}') then '§' else lower(x) end) as ws
  from cut join labels using (opening)),
whole as (select *, len(ws) > 1 and ws[-1] = '…' as trails, case when len(ws) > 1 and ws[-1] = '…' then len(ws) - 1 else len(ws) end as k, ['^', '^'] || ws as ps from worded),
t as (
  select label, w1, w2, w3, count(*) filter (where not last) as inside, count(*) filter (where last) as terminal
  from (select label, ps[i] as w1, ps[i + 1] as w2, ps[i + 2] as w3, i = len(ws) as last from (select *, unnest(range(1, len(ws) + 1)) as i from whole)) group by all),
usual as (select label, sum(terminal) / (sum(terminal) + sum(inside)) as usual from t group by label),
heads as (
  select label, w1, w2, w3[1:n] as w, case when n = len(w3) then inside else inside + terminal end as i, case when n = len(w3) then terminal else 0 end as e, case when n = len(w3) then inside else 0 end as x
  from (select *, unnest(range(1, len(w3) + 1)) as n from t)),
h3 as (select label, w1, w2, w, sum(i) as i, sum(e) as e from heads group by all),
h2 as (select label, w2, w, sum(i) as i, sum(e) as e from heads group by all),
h1 as (select label, w, sum(i) as i, sum(e) as e, sum(x) as x from heads group by all),
p2 as (select label, w1, w2, sum(inside) as i, sum(terminal) as e from t where w3 = '…' group by all),
p1 as (select label, w2, sum(inside) as i, sum(terminal) as e from t where w3 = '…' group by all),
ends as (select match_id, source, side, label, trails, ps[k] as w1, ps[k + 1] as w2, ps[k + 2] as w3 from whole where k > 0),
shares as (
  select match_id, source, side, trails,
         ((coalesce(h3.e, 0) - 1) + {truncation.PRIOR} * ((coalesce(h2.e, 0) - 1) + {truncation.PRIOR} * ((coalesce(h1.e, 0) - 1) + {truncation.PRIOR} * usual) / (coalesce(h1.i, 0) + (coalesce(h1.e, 0) - 1) + {truncation.PRIOR})) / (coalesce(h2.i, 0) + (coalesce(h2.e, 0) - 1) + {truncation.PRIOR})) / (coalesce(h3.i, 0) + (coalesce(h3.e, 0) - 1) + {truncation.PRIOR}) as share,
         (coalesce(p2.i + p2.e, 0) - 1 + {truncation.PRIOR} * (coalesce(p1.i + p1.e, 0) - 1) / (coalesce(h1.i, 0) - 1 + {truncation.PRIOR})) / (coalesce(h2.i, 0) - 1 + {truncation.PRIOR}) as meant,
         coalesce(h1.x, 0) - coalesce(p1.i + p1.e, 0) + coalesce(p1.i, 0) as uses, coalesce(p1.e, 0) - 1 as paused
  from ends join usual using (label)
  left join h3 on h3.label = ends.label and h3.w1 = ends.w1 and h3.w2 = ends.w2 and h3.w = ends.w3
  left join h2 on h2.label = ends.label and h2.w2 = ends.w2 and h2.w = ends.w3
  left join h1 on h1.label = ends.label and h1.w = ends.w3
  left join p2 on trails and p2.label = ends.label and p2.w1 = ends.w2 and p2.w2 = ends.w3
  left join p1 on trails and p1.label = ends.label and p1.w2 = ends.w3),
found as (
  select match_id, side, source from shares
  where case when trails then not (uses > {truncation.WORD} * (uses + paused) and meant > {truncation.MEANT}) else share <= {truncation.TERMINAL} end)
"""


#: Related names of problem 5: a code of two to four letters is one of a series if enough names have it.
_RELATED = rf"""
with recursive names as (select distinct document_name as n from matched_docx_data where document_name is not null),
coded as (select n, upper(regexp_extract(n, '(^|[^\pL])(\pL{{2,4}})[\s_./(–-]*(19|20)\d\d[\s_./–-]+\d', 2)) as code from names),
series as (select code from coded where code <> '' group by code having count(*) >= {splits.SERIES_SHARE} * (select count(*) from coded where code <> '')),
spelled as (select n, code, '(?i)(^|[^\pL])' || code || '[\s_./(–-]*((19|20)\d\d)[\s_./–-]+0*(\d+)' as p, '(?i)(^|\D)((19|20)\d\d)[\s_./–-]+0*(\d+)[\s_./–-]+' || code || '($|[^\pL])' as q from names, series),
keyed as (
  select distinct n, code || '-' || case when regexp_matches(n, p) then regexp_extract(n, p, 2) || '-' || regexp_extract(n, p, 4) else regexp_extract(n, q, 2) || '-' || regexp_extract(n, q, 4) end as key, regexp_matches(n, p) as before
  from spelled where regexp_matches(n, p) or regexp_matches(n, q)),
keys as (select n, key from keyed where before or n not in (select n from keyed where before)),
held as (select distinct document_name as n, trim(regexp_replace(lower(en), '[\s\x{{A0}}\x{{2007}}\x{{202F}}\x{{3000}}]+', ' ', 'g')) as v from matched_docx_data where document_name is not null),
long as (select * from held where length(v) >= {splits.MIN_CHARS}),
common as (select a.n as x, b.n as y from long a join long b on a.v = b.v and a.n <> b.n group by all having count(*) >= {splits.MIN_COMMON}),
edges as (select a.n as x, b.n as y from keys a join keys b using (key) where a.n <> b.n union select x, y from common),
reached(n, low) as (select n, n from names union select e.y, r.low from reached r join edges e on e.x = r.n),
groups as (select n, min(low) as low from reached group by n)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p5_found": _RELATED + "select low as name_a, n as name_b from groups where n <> low",
        "p4_found": _TRUNCATED + "select match_id, side from found",
        "p4_rates": _TRUNCATED + "select source, count(*) as n_values, count(f.match_id) as n_truncated, count(f.match_id) / count(*) as rate from cut left join (select match_id, side from found) f using (match_id, side) group by source",
        "p1_found": _NORMAL + "select first_id as row_a, row_id as row_b from firsts where first_id <> row_id",
        "p1_records": _NORMAL + "select first_id as row_id, min(en) filter (where row_id = first_id) as en, min(fr) filter (where row_id = first_id) as fr, count(*) as n_copies, cast(sum(count) as bigint) as total_count from firsts group by first_id",
    }
