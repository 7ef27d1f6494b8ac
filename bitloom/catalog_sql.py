"""SQL of the core's queries on selection, splitting, files, glossary building and stray letters.

Look-around is written as groups that are put back, as RE2 has none.
"""

from __future__ import annotations

from bitloom import catalog as c
from bitloom.functions import features as X
from bitloom.functions import text as T
from bitloom.operators import diagnostics, selection
from bitloom.operators.glossary import PROVINCES

_STRIPPED = X.STRIPPED.replace("'", "''")
_NB = "chr(160)"


def _in(values: tuple[str, ...] | list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _words(column: str) -> str:
    return rf"list_filter(string_split_regex({column}, '\s+'), lambda w: w <> '')"


def _bare(word: str) -> str:
    return f"trim({word}, '{_STRIPPED}')"


def _ratio(what: str) -> str:
    """(count of fr + 1) / (count of en + 1) of what tags count."""

    def count(lang: str) -> str:
        if what == "entities":
            return f"len(list_filter({_words(lang)}[2:], lambda x: regexp_matches(x, '^[A-ZÀ-Þ][a-zà-ÿ]+')))"
        pattern = (X.VERBS if what == "verbs" else X.NOUNS)[lang]
        return f"len(list_filter({_words(f'lower({lang})')}, lambda x: regexp_matches({_bare('x')}, '{pattern}')))"

    return f"(({count('fr')} + 1)::double / ({count('en')} + 1))"


def _ocr(lang: str) -> str:
    odd = f"length({_bare('x')}) = 1 and lower({_bare('x')}) not in {_in(X.LETTERS[lang])} and not regexp_matches({_bare('x')}, '^[0-9]$')"
    return f"coalesce(contains({lang}, ' ''') or contains({lang}, ''' ') or len(list_filter({_words(lang)}, lambda x: {odd})) > 0, false)"


_RATIOS = {"len_ratio": c._LEN, "clause_ratio": c._CLAUSE, "verb_ratio": _ratio("verbs"), "noun_ratio": _ratio("nouns"), "entity_ratio": _ratio("entities")}


def _flagged() -> str:
    """CTEs of all flags and of the selection."""
    outside = lambda r, b: f"not coalesce({r} between {b[0]} and {b[1]}, false)"
    flags = {
        "exclude_low_similarity": f"similarity < {X.LOW}",
        **{f"exclude_{r}": c._tier(r, r) for r in _RATIOS},
        **{f"exclude_relaxed_{r}": outside(r, X.TIERS[r][2]) for r in _RATIOS},
        **{f"exclude_file_{r}": outside(r, X.FILE_BOUNDS[r]) for r in _RATIOS},
        "exclude_figtext": c._FIG, "exclude_too_short": c._SHORT, "has_date_refs": c._DATE.format(c="en") + " or " + c._DATE.format(c="fr"), "has_number_mismatch": c._MISMATCH,
        "exclude_wrong_language": f"({c._language('en')}) <> 'en' or ({c._language('fr')}) <> 'fr'", "OCR_issue": f"{_ocr('en')} or {_ocr('fr')}",
    }
    either = lambda names: "(" + " or ".join(f"coalesce({n}, false)" for n in names) + ")"
    relaxed = either([*(f"exclude_relaxed_{r}" for r in _RATIOS), "exclude_too_short", "OCR_issue"])
    file_flags = either([n for n in selection.FILE_FLAGS if n != "unmatched_lexical_constraints"])
    return f"""
with ratios as (select match_id, source, en, fr, similarity, en is not null and fr is not null as whole, {', '.join(f'{v} as {k}' for k, v in _RATIOS.items())} from matched_docx_data),
flags as (select *, {', '.join(f'{v} as {k}' for k, v in flags.items())} from ratios),
chosen as (select *, {either(selection.FLAGS)} or not whole as exclude, whole and ({either(selection.FLAGS)} or not whole) and not {relaxed} as for_test, {file_flags} or not whole as rejected from flags)
"""


def _sentences(column: str) -> str:
    """List of sentences, abbreviations and acronyms protected."""
    held = column
    for form in T.SPACED_ABBREVIATIONS:
        parts = form.split(r"\.")[:-1]
        to = " || ".join(f"'\\{i + 1}' || chr(1)" for i in range(len(parts)))
        held = f"regexp_replace({held}, '(?i)" + "".join(rf"({p})\." for p in parts) + f"', {to}, 'g')"
    held = rf"regexp_replace({held}, '\b([A-Z])\.(-?[A-ZÀ-ÖØ-Þ])\.', '\1' || chr(1) || '\2' || chr(1), 'g')"
    held = rf"regexp_replace({held}, '(\x01)(-?[A-ZÀ-ÖØ-Þ])\.', '\1\2' || chr(1), 'g')"
    held = rf"regexp_replace({held}, '(?i)\b({'|'.join(sorted(T.ABBREVIATIONS, key=len, reverse=True))})\.(\s)', '\1' || chr(1) || '\2', 'g')"
    cut = rf"""string_split(regexp_replace({held}, '([.?!]["''»”’]*)\s+', '\1' || chr(2), 'g'), chr(2))"""
    return f"list_filter(list_transform({cut}, lambda x: trim(replace(x, chr(1), '.'), ' ')), lambda x: x <> '')"


def _labelled(column: str) -> str:
    """List of sentences, points of labels protected; neither trimmed nor filtered."""
    held = rf"regexp_replace({column}, '(?i)\b({T.LABEL})\.(\s*[0-9]+)', '\1' || chr(1) || '\2', 'g')"
    held = rf"regexp_replace({held}, '(?i)\b({T.LABEL}\x01?\s*[0-9]+)\.', '\1' || chr(1), 'g')"
    return rf"list_transform(string_split(regexp_replace({held}, '([.!?])\s+', '\1' || chr(2), 'g'), chr(2)), lambda x: replace(x, chr(1), '.'))"


def _file(stem: str) -> str:
    """Document, language and erratum of a file's stem, as columns."""
    name = rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({stem}, '(?i)erratum|english|french', ' ', 'g'), '\s+', ' ', 'g'), '\A[ _-]+', ''), '[ _-]+\z', '')"
    lang = f"case when contains(lower({stem}), 'english') then 'en' when contains(lower({stem}), 'french') then 'fr' end"
    return f"case when ({lang}) is not null then {name} end as document_name, {lang} as lang, contains(lower({stem}), 'erratum') as is_erratum"


_CONTEXT = f"""
with worded as (select match_id, lang, {_words('text')} as ws from {c._SIDES}),
placed as (select match_id, lang, ws, unnest(range(len(ws))) as pos from worded),
context as (
  select match_id, lang, pos::int as pos, lower({_bare('ws[pos + 1]')}) as letter, lower({_bare('ws[pos]')}) as previous, lower({_bare('ws[pos + 2]')}) as next from placed
  where length(lower({_bare('ws[pos + 1]')})) = 1 and not regexp_matches(lower({_bare('ws[pos + 1]')}), '^[0-9]$')
    and not (lang = 'en' and lower({_bare('ws[pos + 1]')}) in {_in(X.LETTERS['en'])}) and not (lang = 'fr' and lower({_bare('ws[pos + 1]')}) in {_in(X.LETTERS['fr'])}))
"""
_JOINED = ", ".join(f"('{lang}', '{letter}', '{w}')" for lang, known in (("en", diagnostics.ENGLISH), ("fr", diagnostics.FRENCH)) for letter, ws in known.items() for w in dict.fromkeys(ws.split()))
_ISSUES = (
    _CONTEXT
    + f""", contractions(lang, letter, other) as (values {_JOINED}),
issues as (
  select match_id, context.lang, pos, case when context.lang = 'en' then other || '''' || context.letter else context.letter || '''' || other end as pattern
  from context join contractions k on k.lang = context.lang and k.letter = context.letter and k.other = case when context.lang = 'en' then previous else next end)
"""
)


def _parts(entries: str) -> str:
    def zipped(pattern: str) -> str:
        pick = lambda column: f"regexp_extract_all({column}, '{pattern}', 1)"
        clean = lambda column: rf"regexp_replace({pick(column)}[i], '/([^/]+)/', '\1', 'g')"
        return f"select {clean('en')} as en_part, {clean('fr')} as fr_part, count from (select *, unnest(range(1, least(len({pick('en')}), len({pick('fr')})) + 1)) as i from {entries})"

    each = " union all ".join(map(zipped, ("/([^/]+)/", r"_\{([^}]*)\}", r"\^\{([^}]*)\}")))
    return f"select en_part, fr_part, max(count) as count from ({each}) where not regexp_matches(en_part, '^[0-9.±]+$') and lower(en_part) <> lower(fr_part) and not (length(en_part) = 1 and length(fr_part) = 1) group by en_part, fr_part"


def _table_glossary() -> str:
    plain = lambda column: rf"regexp_replace(regexp_replace(regexp_replace({column}, ',+$', ''), '/([^/]+)/', '\1', 'g'), '[_^]\{{([^}}]*)\}}', '\1', 'g')"
    province = " or ".join(f"(e = '{a}' and f = '{b}')" for a, b in PROVINCES)
    return (
        c._CONSOLIDATED
        + f""", dashed as (select e.en, coalesce(b.fr, e.fr) as fr, e.count, e.first from entries e left join entries b on e.en like '%-%' and b.en not like '%-%' and replace(e.en, '-', '') = b.en),
kept as (
  select en, fr, count, first from (select *, {plain('en')} as e, {plain('fr')} as f from dashed)
  where not ({province} or (length(e) = 1 and length(f) = 1) or (count < 3 and length(e) <= 2) or lower(e) = lower(f))),
g as (select lower(en) as k, count(distinct lower(fr)) = 1 and count(*) > 1 as one from kept group by 1),
merged as (
  select en, fr, count from kept join g on lower(en) = k where not one
  union all select arg_max(en, (count, -first)), arg_max(fr, (count, -first)), sum(count)::bigint from kept join g on lower(en) = k where one group by k)
select en, fr, count, false as is_part from merged
union all select en_part, fr_part, count, true from ({_parts('merged')}) where lower(en_part) not in (select lower(en) from merged)"""
    )


_STUB = """
with texts as (select distinct en as text from matched_docx_data where en is not null),
results as (
  select text, 'first' as model, case when trim(text, ' ') = '' then text else '[TR:' || text || ']' end as translated, case when trim(text, ' ') = '' then 0 else 1 end as attempts, true as valid from texts
  union all select text, 'second', case when trim(text, ' ') = '' then text else replace(upper(text), 'ß', 'SS') end, case when trim(text, ' ') = '' then 0 else 2 end, true from texts)
"""


def oracle_sql() -> dict[str, str]:
    chosen, sides = _flagged(), c._SIDES
    period = r"case when regexp_matches({x}, '[.!?]\z') then {x} else {x} || '.' end as {x}"
    label = rf"(?is)\A({T.LABEL}\.?\s*[0-9]+)\.\s+(.*)\z"
    stem = r"regexp_replace(filename_fr, '\.pdf$', '')"
    return {
        "curation_summary": chosen + "select source, count(*) as n_rows, count(*) filter (where not exclude) as n_train, count(*) filter (where for_test) as n_test from chosen group by source",
        "tag_ratios": f"select match_id, {', '.join(f'round({_ratio(w)}, 6) as {w}_ratio' for w in ('verbs', 'nouns', 'entities'))} from {c._WHOLE}",
        "ocr_issue": f'select match_id, {_ocr("en")} or {_ocr("fr")} as "OCR_issue" from {c._WHOLE}',
        "train_select": chosen + f"select match_id, {period.format(x='en')}, {period.format(x='fr')} from chosen where not exclude",
        "test_select": chosen + "select match_id from chosen where for_test",
        "docx_select": chosen
        + f""", judged as (select match_id, en, fr, unmatched, rejected or unmatched as rejected from (select *, match_id in ({c._UNMATCHED}) as unmatched from chosen)),
firsts as (select en, fr, min(match_id) as first from judged where not rejected group by en, fr)
select match_id, rejected or (not rejected and first <> match_id) as exclude, not rejected and first <> match_id as is_duplicate, unmatched as unmatched_lexical_constraints
from judged left join firsts on not rejected and firsts.en = judged.en and firsts.fr = judged.fr""",
        "split_text": f"select match_id, lang, (i - 1)::int as pos, s[i] as sentence from (select *, unnest(range(1, len(s) + 1)) as i from (select match_id, lang, {_sentences('text')} as s from {sides}))",
        "sentence_lengths": f"select match_id, lang, len(list_filter({_sentences('text')}, lambda x: length(x) between 10 and 500))::int as n from {sides}",
        "sentence_drop_marks": rf"select match_id, lang, len(list_filter(list_transform(string_split(regexp_replace(text, '(^|[^;,])[.?!]\s', '\1' || chr(2), 'g'), chr(2)), lambda x: trim(x, ' ')), lambda x: x <> ''))::int as n from {sides}",
        "language_blocks": f"select lang, count(*) as n, sum(length(t))::bigint as chars from (select lang, {c._CLEAN.format(c='text')} as t from {sides}) where {c._language('t')} = lang group by lang",
        "sentence_split": f"select match_id, lang, (i - 1)::int as pos, s[i] as sentence from (select *, unnest(range(1, len(s) + 1)) as i from (select match_id, lang, {_labelled('text')} as s from {sides}))",
        "chunk_sentences": f"""
with lines as (select match_id, lang, unnest(range(len(ls))) as line_idx, unnest(ls) as line from (select match_id, lang, string_split(text, chr(10)) as ls from {sides})),
sents as (select *, case when trim(line, ' ') = '' then [''] else {_labelled('line')} end as s from lines),
each as (select *, unnest(range(len(s))) as k from sents)
select match_id, lang, line_idx::int as line_idx, k::int as sent_idx, trim(s[k + 1], ' ') as text, k = len(s) - 1 as is_last_in_line, trim(line, ' ') = '' as is_empty from each where trim(s[k + 1], ' ') <> '' or trim(line, ' ') = ''""",
        "chunk_reassemble": f"select doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l: case when length(l) <= {T.PARAGRAPH_CHARS} then trim(l, ' ') else array_to_string(list_filter(list_transform({_labelled('l')}, lambda y: trim(y, ' ')), lambda y: y <> ''), ' ') end), chr(10)) as text from documents",
        "label_prefix": f"select match_id, regexp_extract(en, '{label}', 1) || '.' as label, regexp_extract(en, '{label}', 2) as rest from {c._WHOLE} where regexp_matches(en, '{label}')",
        "file_names": f"select distinct filename_fr, {_file(stem)} from correlation where filename_fr is not null",
        "punct_spacing_fr": rf"select match_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(fr, '(^|[^:/0-9\x{{A0}}]) ?:($|[^/])', '\1' || {_NB} || ':\2', 'g'), '(^|[^\x{{A0}}]) ?;', '\1' || {_NB} || ';', 'g'), '(^|[^\x{{A0}}]) ?\?', '\1' || {_NB} || '?', 'g'), '(^|[^\x{{A0}}]) ?!', '\1' || {_NB} || '!', 'g'), '([0-9]) ?%', '\1' || {_NB} || '%', 'g'), '«[\s\x{{A0}}]*', '«' || {_NB}, 'g'), '[\s\x{{A0}}]*»', {_NB} || '»', 'g') as fr from {c._WHOLE}",
        "numeric_locale": f"select l_orderkey, l_linenumber, replace(format('{{:,}}', split_part(s, '.', 1)::bigint), ',', {_NB}) || ',' || split_part(s, '.', 2) as fr, true as numeric from (select l_orderkey, l_linenumber, printf('%.2f', l_extendedprice) as s from lineitem)",
        "good_paragraphs": r"select doc_id, pos::int as pos, paragraph from (select doc_id, unnest(range(len(ps))) as pos, unnest(ps) as paragraph from (select doc_id, string_split_regex(text, '\n\n+') as ps from documents)) where length(paragraph) - length(replace(paragraph, '.', '')) >= 2 and length(regexp_replace(paragraph, '[^\pL\s]', '', 'g')) >= greatest(100, 0.95 * length(paragraph))",
        "paired_documents": f"""
with files as (select distinct 'root/' || name as path from (select filename_fr as name from correlation union all select filename_en from correlation) where name is not null),
named as (select path, regexp_extract(path, '([^/]+)/[^/]+\\z', 1) as region, regexp_extract(path, '([^/]+)\\.[^./]+\\z', 1) as stem from files),
known as (select path, region, {_file('stem')} from named where not starts_with(stem, '~$')),
picked as (
  select document_name, min(region) as region, {', '.join(f"max(path) filter (where lang = '{lang}' and is_erratum = {e}) as {lang}_{e}" for lang in ('fr', 'en') for e in ('true', 'false'))}
  from known where lang is not null group by document_name)
select document_name, region, case when fr_true is not null and en_true is not null then fr_true else fr_false end as path_fr, case when fr_true is not null and en_true is not null then en_true else en_false end as path_en
from picked where case when fr_true is not null and en_true is not null then true else fr_false is not null and en_false is not null end""",
        "publication_files": "select filename_fr, filename_en from correlation where pub_number = 'RD-2007/0001' order by listed_at nulls first, filename_fr nulls first, filename_en nulls first limit 1",
        "acronym_table": "select '| source | target |' || chr(10) || '|---|---|' || chr(10) || coalesce(string_agg('| ' || a || ' | ' || b || ' |', chr(10) order by a, b), '') as \"table\" from (select english as a, min(french) as b from glossary where category = 'acronym' group by english)",
        "sub_parts": c._CONSOLIDATED + _parts("entries"),
        "table_glossary": _table_glossary(),
        "letter_context": _CONTEXT + "select match_id, lang, pos, letter, previous, next from context",
        "letter_patterns": _CONTEXT + "select lang, letter, other_word, direction, count(*) as n, min(match_id) as example from (select match_id, lang, letter, 'before' as direction, previous as other_word from context union all select match_id, lang, letter, 'after', next from context) where other_word is not null group by all",
        "missing_apostrophes": _ISSUES + "select match_id, lang, pos, pattern from issues",
        "issue_summary": _ISSUES + "select lang, count(*) as n_issues, count(distinct match_id) as n_rows, count(distinct pattern) as n_patterns from issues group by lang",
        "spaced_apostrophes": f"select match_id, lang, ws[i] || ' ' || ws[i + 1] as pattern from (select match_id, lang, ws, unnest(range(1, len(ws))) as i from (select match_id, lang, {_words('text')} as ws from {sides})) where regexp_matches(ws[i], '[a-zA-Z]''$') or regexp_matches(ws[i + 1], '^''[a-zA-Z]')",
        "translate_stub": _STUB + "select text, model, translated, attempts, valid from results",
        "model_errors": _STUB + "select model, count(*) as n, count(*) filter (where not valid) as n_invalid, sum(attempts)::bigint as attempts from results group by model",
    }
