"""SQL of the core's queries on cells, sets, notes, word-processor files, translation and proofreading."""

from __future__ import annotations

from bitloom import catalog as c
from bitloom.catalog_sql import _NB, _bare, _flagged, _in, _labelled, _words
from bitloom.functions import text as T
from bitloom.operators import diagnostics
from bitloom.operators.terms import PREFIXES


def _numeric(text: str) -> str:
    """Whether a text is a number, and what one is in French, by the parts between spaced dashes."""
    parts = rf"string_split_regex({text}, '\s+[-–−]\s+')"
    dropped = r"[\s,.\x{A0}\x{202F}+\-−/%<>()\[\]=#×÷±≤≥*–^°]"
    bare = lambda p: rf"regexp_replace(regexp_replace({p}, '[Ee][+\-]', '', 'g'), '{dropped}', '', 'g')"
    is_one = rf"not regexp_matches(x, '[0-9]/[0-9]') and not regexp_matches(x, '[0-9]\s*[-–−]\s*[0-9]') and regexp_matches({bare('x')}, '\A[0-9]+\z')"
    digits = lambda p: f"regexp_replace({p}, '[^0-9]', '', 'g')"
    grouped = lambda n: f"replace(format('{{:,}}', try_cast({n} as bigint)), ',', {_NB})"
    fraction = digits(r"regexp_extract(string_split(y, '.')[2], '\A([^E%]*)', 1)")
    whole = digits("string_split(y, '.')[1]")
    form = rf"(case when contains(y, '.') then {grouped(whole)} || ',' || {fraction} else {grouped(bare('y'))} end) || regexp_extract(y, '[Ee][+\-][0-9]+') || case when contains(y, '%') then {_NB} || '%' else '' end"
    return f"{text} <> '' and len(list_filter({parts}, lambda x: not ({is_one}))) = 0 as numeric, array_to_string(list_transform({parts}, lambda y: {form}), ' - ') as converted"


_ROUTES = f"""
with cells as (
  select row_id, trim(en, ' ') as text from table_translations
  union all select row_id + 1000000000, count::varchar from table_translations where count is not null
  union all select match_id + 2000000000, trim(en, ' ') from matched_docx_data where en is not null),
entries as (select trim(en, ' ') as cell, arg_min(fr, row_id) as entry from table_translations where en is not null and fr is not null group by 1),
preferred as (select low, x.english as preferred from (select lower(french) as low, min({{'category': category, 'french': french, 'english': english}}) as x from {c._GLOSSARY} group by 1)),
joined as (select row_id, text, entry, preferred, {_numeric('text')} from cells left join entries on cell = text left join preferred on low = lower(text))
select row_id, case when numeric then converted else coalesce(entry, case when regexp_matches(text, '^[A-ZÀ-Þ]') then upper(preferred[1:1]) || preferred[2:] else preferred end, text) end as expected,
  case when numeric then 'numeric' when entry is not null then 'table' when preferred is not null then 'preferred' when length(text) >= 20 then 'model' else 'unchanged' end as route
from joined"""

_KEPT_NOTES = """
with given as (
  select row_id as ord, document_name as full_paragraph, en as original_text, 'italic' || case when contains(en, '{') then chr(10) || 'superscript' else '' end as notes,
         case when contains(en, '/') then 'url' else 'formatting' end as type, case when row_id % 2 = 0 then 'tables' else 'body' end as section
  from table_translations where document_name is not null),
kept as (select * from given where trim(original_text, ' ') <> ''),
once as (select full_paragraph, notes, section, min(ord) as ord, min(type) as type from kept group by all),
grouped as (
  select full_paragraph, case when bool_or(type = 'url') and bool_or(type = 'formatting') then 'mixed' when bool_or(type = 'url') then 'url' else 'formatting' end as type, count(*)::int as n, arg_min(section, ord) as section
  from once group by full_paragraph)
"""

_LINES = "(select document_name as path, pos, en as text, row_number() over (partition by document_name order by pos) - 1 as p from docx_sentences where document_name is not null and en is not null)"
_PAIRS = f"select ws[i] || ' ' || ws[i + 1] as pattern from (select ws, unnest(range(1, len(ws))) as i from (select {_words('text')} as ws from {c._SIDES})) where regexp_matches(ws[i], '[a-zA-Z]''$') or regexp_matches(ws[i + 1], '^''[a-zA-Z]')"
_SPACED_FR = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(fr, '(^|[^:/0-9\x{{A0}}]) ?:($|[^/])', '\1' || {_NB} || ':\2', 'g'), '(^|[^\x{{A0}}]) ?;', '\1' || {_NB} || ';', 'g'), '(^|[^\x{{A0}}]) ?\?', '\1' || {_NB} || '?', 'g'), '(^|[^\x{{A0}}]) ?!', '\1' || {_NB} || '!', 'g'), '([0-9]) ?%', '\1' || {_NB} || '%', 'g'), '«[\s\x{{A0}}]*', '«' || {_NB}, 'g'), '[\s\x{{A0}}]*»', {_NB} || '»', 'g')"
_SPACED_EN = r"regexp_replace(regexp_replace(en, ' +([:;?!])', '\1', 'g'), '([0-9]) +(%)', '\1\2', 'g')"
_CAPTION = rf"(?is)\A({T.LABEL}\.?\s*[0-9]+)\.\s+(.*)\z"
_INSPECTED = ("exclude_figtext", "exclude_too_short", "has_date_refs", "has_number_mismatch")


def _of_line(line: str) -> str:
    return f"list_filter(list_transform({_labelled(line)}, lambda y: trim(y, ' ')), lambda y: y <> '')"


def _afters(lang: str) -> str:
    return f"select before as key, afters as items from ({c.oracle_sql()['contraction_sets']}) where lang = '{lang}'"


def oracle_sql() -> dict[str, str]:
    prefix = "contains(upper(fr), '{p}') and not contains(en, '{p}')"
    chunk = f"case when regexp_matches(ck, '{_CAPTION}') and trim(regexp_extract(ck, '{_CAPTION}', 2), ' ') <> '' then '[TR:' || regexp_extract(ck, '{_CAPTION}', 1) || '.]. [TR:' || regexp_extract(ck, '{_CAPTION}', 2) || ']' else '[TR:' || ck || ']' end"
    return {
        "cell_routes": _ROUTES,
        "validation_split": "select train_id, ('0x' || md5(train_id || '/42')[1:8])::bigint % 10000 < 500 as is_validation from training_data",
        "sample_rows": "select match_id from matched_docx_data order by md5(match_id || '/42'), match_id limit 1000",
        "sequence_compare": "select 'same sequence' as verdict",
        "union_all": "select document_name, source, en, fr, doc_region, null::varchar as split_name from matched_docx_data union all select document_name, source, en, fr, null, split_name from training_data",
        "document_names": "select distinct document_name from matched_docx_data where document_name is not null",
        "document_gate": "select * from (select document_name, sum(coalesce(length(en), 0))::bigint as en_chars, sum(coalesce(length(fr), 0))::bigint as fr_chars from docx_sentences where document_name is not null group by 1) where en_chars >= 1000 and fr_chars >= 1000",
        "pattern_difference": f"""
with a as ({_afters('en')}), b as ({_afters('fr')}), x as (select coalesce(a.key, b.key) as key, coalesce(a.items, []) as a, coalesce(b.items, []) as b from a full join b on a.key = b.key),
d as (select key, list_sort(list_filter(b, lambda v: not list_contains(a, v))) as missing, list_sort(list_filter(a, lambda v: not list_contains(b, v))) as extra from x)
select key, missing, extra from d where len(missing) > 0 or len(extra) > 0""",
        "contraction_suffixes": rf"""
with w as (select unnest({_words('lower(text)')}) as w from {c._SIDES}),
p as (select regexp_extract(replace(w, '’', ''''), '\A(.+)''([^'']+)\z', 1) as prefix, regexp_extract(replace(w, '’', ''''), '\A(.+)''([^'']+)\z', 2) as suffix from w where regexp_matches(w, '\A[\x20-\x7E’]*\z'))
select suffix, list_sort(list_distinct(list(prefix))) as prefixes from p where prefix <> '' and suffix in {_in(list(diagnostics.ENGLISH))} group by suffix""",
        "cleaning_pairs": f"select distinct pattern, regexp_replace(pattern, ' *'' *', '''', 'g') as cleaned from ({_PAIRS})",
        "inspection_sample": _flagged()
        + f""", one as (select match_id, list_filter([{', '.join(f"case when {n} then '{n}' end" for n in _INSPECTED)}], lambda x: x is not null) as f from chosen where whole),
ranked as (select match_id, coalesce(f[1], 'kept') as flag, row_number() over (partition by coalesce(f[1], 'kept') order by md5(match_id::varchar), match_id) as r from one where len(f) <= 1)
select flag, match_id from ranked where r <= case when flag = 'kept' then 22 else 5 end""",
        "has_single_letter": f"select match_id, len(list_filter({_words('en')}, lambda x: length({_bare('x')}) = 1)) > 0 as has from {c._WHOLE}",
        "straight_apostrophes": f"select match_id, translate(fr, '‘’', '''''') as fr from {c._WHOLE}",
        "model_output": rf"""
select match_id, trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(trim(regexp_replace('Here is the translation: ' || fr || ' (translation note)',
  '(?i)^(Here is the translation|Voici la traduction)[:\s]*', ''), ' '), '(?i)^(Translation|Traduction)[:\s]*', ''), ' '), '(?i)^(The translation is|La traduction est)[:\s]*', ''), ' '), '(?i)\s*\([^)]*translation[^)]*\)\s*$', ''), ' ') as fr
from {c._WHOLE}""",
        "blank_to_null": "select row_id, nullif(trim(en, ' '), '') as en from table_translations",
        "label_periods": rf"select match_id, case when regexp_matches(en, '(?i)\A({T.LABEL}\.?\s*[0-9]+)([^0-9.]|\z)') then regexp_replace(en, '(?i)\A({T.LABEL}\.?\s*[0-9]+)', '\1.') when ends_with(rtrim(en, ' '), '.') then en else rtrim(en, ' ') || '.' end as en from {c._WHOLE}",
        "checkpoint_names": r"select distinct regexp_replace(regexp_replace(filename_fr, '\.pdf$', ''), '(_translated|_fixed)\z', '') || '_reviewed' as name from correlation where filename_fr is not null",
        "flattened_paragraphs": r"""
with p as (select doc_id, list_transform(string_split_regex(text, '\n\n+'), lambda p: len(list_filter(string_split(p, chr(10)), lambda x: trim(x, ' ') <> ''))) as ns from documents)
select doc_id, list_sum(list_transform(ns, lambda n: case when n > 0 then n + 1 else 0 end))::int as n from p""",
        "chunks_by_kind": f"""
select doc_id, list_sum(list_transform(string_split(text, chr(10)), lambda l: case when length(l) <= {T.PARAGRAPH_CHARS} or trim(l, ' ') = '' then 1 else len({_of_line('l')}) end))::int as n_paragraphs,
  list_sum(list_transform(string_split(text, chr(10)), lambda l: case when trim(l, ' ') = '' then 1 else len({_of_line('l')}) end))::int as n_sentences
from documents""",
        "capitals": "select row_id, case when en = '' or fr = '' then fr when upper(en) = en and lower(en) <> en then upper(fr) when lower(en) = en and upper(en) <> en then lower(fr) else fr end as fr from table_translations where en is not null and fr is not null",
        "docx_paragraphs": f"select path, p::int as ord, 'P' || p as loc_id, text from {_LINES}",
        "docx_headers": "select distinct document_name as path, 'H0' as loc_id, document_name as text from docx_sentences where document_name is not null and en is not null",
        "docx_texts": f"select path, string_agg(text, chr(10) order by p) as text, string_agg('[P' || p || '] ' || text, chr(10) order by p) as located from {_LINES} group by path",
        "docx_runs": f"select path, p::int as ord, text, false as bold, false as italic from {_LINES}",
        "docx_languages": "select distinct document_name as path, 'en' as lang from docx_sentences where document_name is not null and en is not null",
        "docx_translated": f"select path, p::int as ord, array_to_string(list_transform(string_split(text, ''), lambda x: case when x = upper(x) then lower(x) else upper(x) end), '') as text from {_LINES}",
        "docx_proofing": "select distinct document_name as path, 'fr' as lang from docx_sentences where document_name is not null and en is not null",
        "kept_notes": _KEPT_NOTES + "select ord, notes from kept",
        "grouped_notes": _KEPT_NOTES + "select full_paragraph, type, n from grouped",
        "note_table": _KEPT_NOTES + "select case when section = 'tables' then 'tables' else 'paragraphs' end as section, case type when 'mixed' then 'bright green' when 'url' then 'turquoise' else 'yellow' end as colour, sum(n)::bigint as n from grouped group by all",
        "prefix_errors": f"select match_id, {' or '.join('(' + prefix.format(p=p) + ')' for p in PREFIXES)} as error from {c._WHOLE}",
        "same_mappings": "select match_id, true as same from matched_docx_data",
        "labelled_translation": f"select match_id, translate(array_to_string(list_transform(string_split(en, chr(10)), lambda l: case when trim(l, ' ') = '' then '' else array_to_string(list_transform({_of_line('l')}, lambda ck: {chunk}), ' ') end), chr(10)), '‘’', '''''') as text from {c._WHOLE}",
        "chunk_index": f"""
with l as (select doc_id, unnest(range(len(ls))) as li, unnest(ls) as line from (select doc_id, string_split(text, chr(10)) as ls from documents)),
s as (select doc_id, li, {_of_line('line')} as s from l where trim(line, ' ') <> ''),
e as (select doc_id, li, unnest(range(len(s))) as k, unnest(s) as chunk from s)
select doc_id, (row_number() over (partition by doc_id order by li, k) - 1)::int as chunk_idx, chunk from e""",
        "evaluation_rows": f"select match_id as sample_idx, en as source_text, t.translator, t.o as use_find_replace, case t.translator when 'human' then fr when 'plain' then en else upper(en) end as translated_text from {c._WHOLE}, (values ('human', null), ('plain', false), ('plain', true), ('upper', false), ('upper', true)) t(translator, o)",
        "best_by_configuration": """
with r as (select document_name || '#' || idx as sample_idx, match_id % 2 = 0 as use_find_replace, (match_id // 2) % 2 = 0 as gender_fix, source || '-' || match_id as translator, similarity from matched_docx_data where document_name is not null)
select sample_idx, use_find_replace, gender_fix, translator, similarity, null::varchar as details from r
union all
select sample_idx, use_find_replace, gender_fix, 'best_model', similarity, 'best_model_' || case when gender_fix then 'genderfix' else 'genderdefault' end || case when use_find_replace then '_preferential' else '_unreplaced' end
from (select *, row_number() over (partition by sample_idx, use_find_replace, gender_fix order by similarity desc nulls last, translator) as n from r) where n = 1""",
        "review_prompts": c._CHECK
        + """, lines as (
  select match_id, string_agg(l, chr(10) order by l) as l from (select distinct match_id, '- ' || term || ' -> ' || other as l from hits where least(length(term), length(other)) >= 3) group by match_id)
select match_id, 'Review the translation of ' || match_id || ' by the instructions.' || coalesce(chr(10) || chr(10) || 'Preferred terms:' || chr(10) || l, '') as prompt from (select distinct match_id from matched_docx_data) left join lines using (match_id)""",
        "punctuation_changes": f"select 'fr' as lang, count(*) as n_texts, count(*) filter (where {_SPACED_FR} <> fr) as n_changed from matched_docx_data where fr is not null union all select 'en', count(*), count(*) filter (where {_SPACED_EN} <> en) from matched_docx_data where en is not null",
    }
