"""All queries of the core over the driver's tables, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitloom.functions import features as X
from bitloom.functions import text as T
from bitloom.operators import diagnostics, documents, evaluation, formatting, glossary, proofreading, selection, similarity, terms, translation
from bitloom.session import table
from bitloom.sources import docx, docx_edit, files, sinks


def _bitext(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "matched_docx_data")


def _whole(s: SparkSession, d: str) -> DataFrame:
    return _bitext(s, d).where("en is not null and fr is not null")


def _terms(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "table_translations")


def _flags(s: SparkSession, d: str) -> DataFrame:
    return selection.with_selection(selection.with_flags(selection.with_features(_bitext(s, d))))


def _sides(s: SparkSession, d: str) -> DataFrame:
    return diagnostics.sides(_bitext(s, d))


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return similarity.pair_similarity(table(s, d, "embeddings"), "label", "vec_id", "embedding", F.col("vec_id") % 2 == 0)


def _results(s: SparkSession, d: str) -> DataFrame:
    """Matched rows as results of translators: a sample is a document's place, a model the route."""
    return _bitext(s, d).select(F.col("document_name").alias("doc"), "idx", "match_id", F.col("source").alias("model"), F.col("match_id").cast("int").alias("model_ord"), F.col("en").alias("translated"), F.col("en").isNotNull().alias("valid"), "similarity").where("doc is not null").withColumn("sample", F.concat_ws("#", "doc", F.col("idx").cast("string")))


def _stub(s: SparkSession, d: str) -> DataFrame:
    models = {"first": evaluation.stub_model, "second": lambda t, beams: t.upper() if beams > 4 else None}
    return evaluation.translate(_bitext(s, d).select(F.col("en").alias("text")), models)


def _substituted(s: SparkSession, d: str) -> DataFrame:
    return terms.substitute_terms(_bitext(s, d), table(s, d, "glossary"), "match_id", "fr", "fr")


def _cells(s: SparkSession, d: str) -> DataFrame:
    t = _terms(s, d)
    numbers = t.where("`count` is not null").select((F.col("row_id") + 1_000_000_000).alias("row_id"), F.col("count").cast("string").alias("text"))
    values = _bitext(s, d).where("en is not null").select((F.col("match_id") + 2_000_000_000).alias("row_id"), F.col("en").alias("text"))
    return terms.cell_routes(t.select("row_id", F.col("en").alias("text")).unionByName(numbers).unionByName(values), t, table(s, d, "glossary"))


def _files(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "correlation")
    return c.select(F.explode(F.array("filename_fr", "filename_en")).alias("name")).select(F.concat(F.lit("root/"), "name").alias("path")).where("path is not null").distinct()


def _en() -> Column:
    return F.col("en")


def _fr() -> Column:
    return F.col("fr")


def _losing_tokens(text: Column) -> Column:
    """What a translator gives that loses every token with an odd number."""
    return F.regexp_replace(text, r"\b[A-Z]+[0-9]{3}[13579]\b", "")


def _sentences(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "docx_sentences")


def _docx(s: SparkSession, d: str) -> DataFrame:
    """The English documents as word-processor files."""
    return docx.as_files(_sentences(s, d), "document_name", "pos", "en")


def _settings(s: SparkSession, d: str) -> DataFrame:
    """Matched rows as evaluated translations: two settings by their number."""
    on = lambda n: F.floor(F.col("match_id") / n) % 2 == 0
    sample = F.concat(F.col("document_name"), F.lit("#"), F.col("idx").cast("string"))
    return _bitext(s, d).where("document_name is not null").select(sample.alias("sample_idx"), on(1).alias("use_find_replace"), on(2).alias("gender_fix"), F.concat(F.col("source"), F.lit("-"), F.col("match_id").cast("string")).alias("translator"), "similarity")


def _notes(s: SparkSession, d: str) -> DataFrame:
    """Table terms as notes: their marks are formats, their document the paragraph."""
    notes = F.concat(F.lit(" italic\n colour=000000 \n"), F.when(_en().contains("{"), "superscript").otherwise(""))
    kind = F.when(_en().contains("/"), "url").otherwise("formatting")
    place = [F.when(F.col("row_id") % 2 == 0, "tables").otherwise("body").alias("section"), *[F.lit(0).alias(n) for n in ("index", "tbl", "row", "cell")]]
    return _terms(s, d).where("document_name is not null").select(F.col("document_name").alias("full_paragraph"), _en().alias("original_text"), notes.alias("notes"), kind.alias("type"), *place, F.col("row_id").alias("ord"))


def _restyled(s: SparkSession, d: str) -> DataFrame:
    """Formats of marked-up terms, carried over to their translations."""
    t = _terms(s, d).where("en is not null and fr is not null")
    run = lambda r: F.struct(r["text"].alias("text"), F.lit(False).alias("bold"), r["italic"].alias("italic"), F.lit(False).alias("underline"), r["superscript"].alias("superscript"), r["subscript"].alias("subscript"))
    runs = documents.markup_runs(t, "row_id", "en").select("row_id", F.transform("runs", run).alias("runs"))
    return formatting.restyle_paragraphs(runs.join(t.select("row_id", T.without_markup(_fr()).alias("translation")), "row_id"), "row_id")


#: Floor of similarity that fits the stand-in encoder, which knows no translations.
_STAND_IN = 0.3


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # selection of bitext
        "curation_summary": lambda s, d: selection.curation_summary(_bitext(s, d)),
        "len_clause_ratio": lambda s, d: _whole(s, d).select("match_id", F.round(X.len_ratio(_fr(), _en()), 6).alias("len_ratio"), F.round(X.clause_ratio(_fr(), _en()), 6).alias("clause_ratio")),
        "tag_ratios": lambda s, d: _whole(s, d).select("match_id", *[F.round(X.tag_ratio(_fr(), _en(), w), 6).alias(f"{w}_ratio") for w in ("verbs", "nouns", "entities")]),
        "flag_too_short": lambda s, d: _whole(s, d).select("match_id", X.too_short(_en(), _fr()).alias("exclude_too_short")),
        "flag_dates": lambda s, d: _whole(s, d).select("match_id", (X.has_date(_en()) | X.has_date(_fr())).alias("has_date_refs")),
        "flag_figtext": lambda s, d: _whole(s, d).select("match_id", X.figure_text(_en(), _fr()).alias("exclude_figtext")),
        "figure_flags": lambda s, d: _whole(s, d).select("match_id", *[c.alias(n) for n, c in X.figure_flags(_en(), "en").items()]),
        "number_mismatch": lambda s, d: _whole(s, d).select("match_id", X.number_mismatch(_en(), _fr()).alias("has_number_mismatch")),
        "ocr_issue": lambda s, d: _whole(s, d).select("match_id", X.ocr_issue(_en(), _fr()).alias("OCR_issue")),
        "language_id": lambda s, d: _whole(s, d).select("match_id", X.language(_en()).alias("en_language"), X.language(_fr()).alias("fr_language")),
        "low_similarity": lambda s, d: _bitext(s, d).where(F.col("similarity") < X.LOW).select("match_id", "similarity"),
        "tiered_ratio_bounds": lambda s, d: _whole(s, d).select("match_id", X.outside_tier(X.len_ratio(_fr(), _en()), F.col("similarity"), "len_ratio").alias("exclude_len_ratio"), X.outside_tier(X.clause_ratio(_fr(), _en()), F.col("similarity"), "clause_ratio").alias("exclude_clause_ratio")),
        "log_thresholds": lambda s, d: selection.log_thresholds(_whole(s, d).select(X.len_ratio(_fr(), _en()).alias("len_ratio"), X.clause_ratio(_fr(), _en()).alias("clause_ratio")), ("len_ratio", "clause_ratio")),
        "train_select": lambda s, d: selection.training_rows(_flags(s, d)).select("match_id", "en", "fr"),
        "test_select": lambda s, d: _flags(s, d).where("for_test").select("match_id"),
        "docx_select": lambda s, d: selection.file_selection(_bitext(s, d), table(s, d, "glossary")).select("match_id", "exclude", "is_duplicate", "unmatched_lexical_constraints"),
        "dedup_kept": lambda s, d: selection.mark_duplicates(_whole(s, d), ~X.too_short(_en(), _fr())).select("match_id", "is_duplicate"),
        "jsonl_bidirectional": lambda s, d: selection.both_directions(_whole(s, d)),
        "tuning_records": lambda s, d: selection.usable_for_tuning(selection.both_directions(_bitext(s, d)), "en"),
        "validation_split": lambda s, d: selection.hash_split(table(s, d, "training_data").select("train_id"), "train_id"),
        "steps_per_epoch": lambda s, d: selection.steps_per_epoch(table(s, d, "training_data"), 16, 4),
        "match_statistics": lambda s, d: selection.match_statistics(_bitext(s, d)),
        "corpus_summary": lambda s, d: selection.corpus_summary(selection.match_statistics(_bitext(s, d))),
        "flag_counts": lambda s, d: diagnostics.flag_counts(_flags(s, d), ["exclude_figtext", "exclude_too_short", "has_date_refs", "has_number_mismatch", "exclude_low_similarity"]),
        "trigger_counts": lambda s, d: diagnostics.trigger_counts(_flags(s, d), ["exclude_figtext", "exclude_too_short", "has_date_refs", "has_number_mismatch", "exclude_low_similarity"]),
        "describe_bitext": lambda s, d: diagnostics.describe(_bitext(s, d).withColumns({"n_en": F.length("en"), "n_fr": F.length("fr")}), ["similarity", "n_en", "n_fr"]),
        # text
        "clean_text": lambda s, d: _whole(s, d).select("match_id", T.clean_text(_en()).alias("en"), T.clean_text(_fr()).alias("fr")),
        "split_text": lambda s, d: _sides(s, d).select("match_id", "lang", F.posexplode(T.split_sentences(F.col("text"))).alias("pos", "sentence")),
        "sentence_split": lambda s, d: _sides(s, d).select("match_id", "lang", F.posexplode(T.label_sentences(F.col("text"))).alias("pos", "sentence")),
        "sentence_drop_marks": lambda s, d: _sides(s, d).select("match_id", "lang", F.size(T.split_dropping_marks(F.col("text"))).alias("n")),
        "sentence_lengths": lambda s, d: _sides(s, d).select("match_id", "lang", F.size(T.of_length(T.split_sentences(F.col("text")), 10, 500)).alias("n")),
        "paragraph_filter": lambda s, d: _sides(s, d).select("match_id", "lang", T.clean_text(F.col("text")).alias("text")).where(F.length("text") >= 30),
        "language_blocks": lambda s, d: _sides(s, d).where(X.language(T.clean_text(F.col("text"))) == F.col("lang")).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(T.clean_text(F.col("text")))).alias("chars")),
        "append_period": lambda s, d: _whole(s, d).select("match_id", T.append_period(_en()).alias("en")),
        "chunk_sentences": lambda s, d: _sides(s, d).select("match_id", "lang", F.explode(T.sentence_chunks(F.col("text"))).alias("c")).select("match_id", "lang", "c.*"),
        "chunk_reassemble": lambda s, d: table(s, d, "documents").select("doc_id", T.reassemble(T.paragraph_chunks(F.col("text"))).alias("text")),
        "label_prefix": lambda s, d: _whole(s, d).select("match_id", T.label_prefix(_en()).alias("x")).select("match_id", "x.*").where("label is not null"),
        "unified_spaces": lambda s, d: _whole(s, d).select("match_id", T.unified_spaces(_fr()).alias("fr")),
        "markup_stripped": lambda s, d: _terms(s, d).select("row_id", T.without_markup(_en()).alias("en"), T.has_markup(_en()).alias("formatted")),
        "markup_runs": lambda s, d: documents.markup_runs(_terms(s, d), "row_id", "en").select("row_id", F.size("runs").alias("n_runs"), F.array_join(F.transform("runs", lambda r: r["text"]), "").alias("text")),
        "file_names": lambda s, d: table(s, d, "correlation").select("filename_fr", T.document_of_file(F.regexp_replace("filename_fr", "\\.pdf$", "")).alias("x")).where("filename_fr is not null").select("filename_fr", "x.document_name", "x.lang", "x.is_erratum").distinct(),
        "punct_spacing_en": lambda s, d: _whole(s, d).select("match_id", X.punctuation_spacing(_en(), "en").alias("en")),
        "punct_spacing_fr": lambda s, d: _whole(s, d).select("match_id", X.punctuation_spacing(_fr(), "fr").alias("fr")),
        "numeric_locale": lambda s, d: table(s, d, "lineitem").select("l_orderkey", "l_linenumber", X.convert_numeric(F.format_string("%.2f", "l_extendedprice"), True).alias("fr"), X.is_numeric(F.format_string("%.2f", "l_extendedprice")).alias("numeric")),
        "good_paragraphs": lambda s, d: diagnostics.good_paragraphs(table(s, d, "documents"), "doc_id", "text"),
        # files
        "usable_pairs": lambda s, d: files.usable_pairs(table(s, d, "correlation")),
        "paired_documents": lambda s, d: files.pair_documents(_files(s, d)),
        "publication_files": lambda s, d: files.publication_files(table(s, d, "correlation"), "RD-2007/0001"),
        # terms
        "glossary_index": lambda s, d: terms.two_way_index(table(s, d, "glossary")),
        "search_patterns": lambda s, d: terms.search_patterns(table(s, d, "glossary")),
        "glossary_checklist": lambda s, d: terms.checklist(_bitext(s, d), table(s, d, "glossary"), "match_id", "en", "en"),
        "sub_glossary": lambda s, d: terms.sub_glossary(_bitext(s, d), table(s, d, "glossary"), "match_id", "en", "en"),
        "absent_translations": lambda s, d: terms.absent_translations(_bitext(s, d), table(s, d, "glossary")),
        "unmatched_terms": lambda s, d: terms.unmatched_constraint(_bitext(s, d), table(s, d, "glossary")),
        "translation_matches": lambda s, d: terms.substring_matches(_bitext(s, d), table(s, d, "glossary")),
        "token_substitute": lambda s, d: _substituted(s, d).select("match_id", "tokenised", F.size("mapping").alias("n_tokens")),
        "token_restore": lambda s, d: terms.restore_terms(_substituted(s, d), "match_id"),
        "missing_tokens": lambda s, d: terms.missing_tokens(_substituted(s, d).withColumn("translated", _losing_tokens(F.col("tokenised"))), "match_id", "translated"),
        "terms_replaced": lambda s, d: terms.replace_terms(_bitext(s, d), table(s, d, "glossary"), "match_id", "en"),
        "cell_routes": _cells,
        "category_counts": lambda s, d: glossary.category_counts(table(s, d, "glossary")),
        "acronym_table": lambda s, d: documents.acronym_table(table(s, d, "glossary")),
        "glossary_dedup": lambda s, d: glossary.consolidated(_terms(s, d)).select("en", "fr", "count", F.size("fr_variants").alias("n_variants")),
        "dash_align": lambda s, d: glossary.dash_aligned(glossary.consolidated(_terms(s, d))).select("en", "fr", "count"),
        "case_merge": lambda s, d: glossary.case_merged(glossary.consolidated(_terms(s, d))).select("en", "fr", "count"),
        "sub_parts": lambda s, d: glossary.sub_parts(glossary.consolidated(_terms(s, d))),
        "table_glossary": lambda s, d: glossary.table_glossary(_terms(s, d)),
        # similarity
        "margin_topk": lambda s, d: similarity.margin_scores(_pairs(s, d), "label").select("label", "i", "j", F.round("sim", 6).alias("sim"), F.round("margin", 6).alias("margin")),
        "align_dp": lambda s, d: similarity.align_documents(table(s, d, "docx_sentences"), floor=_STAND_IN),
        "gap_refine": lambda s, d: similarity.align_documents(table(s, d, "docx_sentences"), refine=True, floor=_STAND_IN),
        # models and quality
        "translate_stub": lambda s, d: _stub(s, d).select("text", "model", "translated", "attempts", "valid"),
        "ensemble_argmax": lambda s, d: evaluation.best_model(_results(s, d), "sample"),
        "best_per_sample": lambda s, d: evaluation.best_per_sample(_results(s, d), ["sample"], "similarity", "match_id").select("sample", "match_id"),
        "percentile_breakdown": lambda s, d: evaluation.breakdowns(_bitext(s, d).where("similarity is not null"), "similarity", ["source", "doc_region"]),
        "model_errors": lambda s, d: evaluation.error_summary(_stub(s, d)),
        "sample_rows": lambda s, d: evaluation.sample_rows(_bitext(s, d), "match_id", 1000).select("match_id"),
        # diagnostics
        "letter_context": lambda s, d: diagnostics.letter_context(_sides(s, d)),
        "letter_patterns": lambda s, d: diagnostics.letter_patterns(diagnostics.letter_context(_sides(s, d))),
        "missing_apostrophes": lambda s, d: diagnostics.missing_apostrophes(diagnostics.letter_context(_sides(s, d))),
        "issue_summary": lambda s, d: diagnostics.issue_summary(diagnostics.missing_apostrophes(diagnostics.letter_context(_sides(s, d)))),
        "contraction_sets": lambda s, d: diagnostics.contraction_sets(_sides(s, d)),
        "spaced_apostrophes": lambda s, d: diagnostics.spaced_apostrophes(_sides(s, d)),
        "set_compare": lambda s, d: diagnostics.comparison(table(s, d, "training_data").select("en", "fr"), table(s, d, "training_data").select("en", "fr").distinct()),
        "set_difference": lambda s, d: diagnostics.multiset_difference(table(s, d, "training_data").select("en", "fr"), _bitext(s, d).select("en", "fr")),
        "sequence_compare": lambda s, d: diagnostics.comparison(_bitext(s, d).select("match_id", "en", "fr"), _bitext(s, d).select("match_id", "en", "fr"), "match_id"),
        "union_all": lambda s, d: _bitext(s, d).select("document_name", "source", "en", "fr", "doc_region").unionByName(table(s, d, "training_data").select("document_name", "source", "en", "fr", "split_name"), allowMissingColumns=True),
        "document_names": lambda s, d: _bitext(s, d).where("document_name is not null").select("document_name").distinct().orderBy("document_name"),
        "document_gate": lambda s, d: files.gated_documents(_sentences(s, d)),
        "pattern_difference": lambda s, d: diagnostics.pattern_difference(*[diagnostics.contraction_sets(_sides(s, d)).where(F.col("lang") == lang).select(F.col("before").alias("key"), F.col("afters").alias("items")) for lang in ("en", "fr")]),
        "contraction_suffixes": lambda s, d: diagnostics.contraction_suffixes(_sides(s, d).select(F.explode(X.words(F.lower("text"))).alias("w")), "w"),
        "cleaning_pairs": lambda s, d: diagnostics.cleaning_pairs(diagnostics.spaced_apostrophes(_sides(s, d))),
        "inspection_sample": lambda s, d: diagnostics.inspection_sample(_flags(s, d).where("en is not null and fr is not null"), ["exclude_figtext", "exclude_too_short", "has_date_refs", "has_number_mismatch"], "match_id"),
        "has_single_letter": lambda s, d: _whole(s, d).select("match_id", X.has_single_letter(_en()).alias("has")),
        # text, further
        "straight_apostrophes": lambda s, d: _whole(s, d).select("match_id", T.straight_apostrophes(_fr()).alias("fr")),
        "model_output": lambda s, d: _whole(s, d).select("match_id", T.without_boilerplate(F.concat(F.lit("Here is the translation: "), _fr(), F.lit(" (translation note)"))).alias("fr")),
        "blank_to_null": lambda s, d: _terms(s, d).select("row_id", T.blank_to_null(_en()).alias("en")),
        "label_periods": lambda s, d: _whole(s, d).select("match_id", T.ensure_label_period(_en()).alias("en")),
        "checkpoint_names": lambda s, d: table(s, d, "correlation").where("filename_fr is not null").select(T.checkpoint_name(F.regexp_replace("filename_fr", r"\.pdf$", ""), "_reviewed", ("_translated", "_fixed")).alias("name")).distinct(),
        "flattened_paragraphs": lambda s, d: table(s, d, "documents").select("doc_id", F.size(T.flatten_with_marks(F.transform(F.split("text", r"\n\n+"), lambda p: F.filter(F.split(p, "\n"), lambda x: F.trim(x) != "")))).alias("n")),
        "chunks_by_kind": lambda s, d: table(s, d, "documents").select("doc_id", F.size(T.chunks(F.col("text"), "paragraphs")).alias("n_paragraphs"), F.size(T.chunks(F.col("text"))).alias("n_sentences")),
        "capitals": lambda s, d: _terms(s, d).where("en is not null and fr is not null").select("row_id", X.carry_capitals(_en(), _fr(), F.lit(False)).alias("fr")),
        # word-processor files
        "docx_paragraphs": lambda s, d: docx.read_elements(_docx(s, d)).where("kind = 'paragraph'").select("path", "ord", "loc_id", "text"),
        "docx_headers": lambda s, d: docx.read_elements(_docx(s, d)).where("kind = 'header'").select("path", "loc_id", "text"),
        "docx_texts": lambda s, d: docx.document_texts(docx.read_elements(_docx(s, d)).where("kind = 'paragraph'")),
        "docx_runs": lambda s, d: documents.merged_runs(docx.read_runs(_docx(s, d))).select("path", "ord", "text", "bold", "italic"),
        "docx_languages": lambda s, d: docx.languages(_docx(s, d)),
        "docx_translated": lambda s, d: docx.read_elements(docx_edit.translate_files(_docx(s, d), str.swapcase, "fr").select("path", "content")).where("kind = 'paragraph'").select("path", "ord", "text"),
        "docx_proofing": lambda s, d: docx.languages(docx_edit.translate_files(_docx(s, d), str.swapcase, "fr").select("path", "content")),
        "restyled_terms": _restyled,
        "kept_notes": lambda s, d: documents.kept_notes(_notes(s, d)).select("ord", "notes"),
        "grouped_notes": lambda s, d: documents.grouped_notes(documents.kept_notes(_notes(s, d))).select("full_paragraph", "type", F.size("notes").alias("n")),
        "note_table": lambda s, d: sinks.note_table(documents.grouped_notes(documents.kept_notes(_notes(s, d)))).groupBy("section", "colour").agg(F.count(F.lit(1)).alias("n")),
        # translation and proofreading
        "prefix_errors": lambda s, d: _whole(s, d).select("match_id", terms.prefix_error(F.upper(_fr()), _en()).alias("error")),
        "same_mappings": lambda s, d: _substituted(s, d).select("match_id", translation.same_mappings(F.col("mapping"), F.reverse("mapping")).alias("same")),
        "translate_terms": lambda s, d: translation.translate_texts(_bitext(s, d), table(s, d, "glossary"), "match_id", "fr", "fr"),
        "labelled_translation": lambda s, d: _whole(s, d).select("match_id", translation.labelled(_en(), lambda x: F.concat(F.lit("[TR:"), x, F.lit("]"))).alias("text")),
        "chunk_index": lambda s, d: translation.chunk_index(table(s, d, "documents"), "doc_id", "text"),
        "evaluation_rows": lambda s, d: translation.evaluation_rows(_whole(s, d).select(F.col("match_id").alias("sample_idx"), _en().alias("source_text"), _fr().alias("target_text"), "en"), {"plain": _en(), "upper": F.upper(_en())}),
        "best_by_configuration": lambda s, d: translation.best_by_configuration(_settings(s, d)),
        "review_prompts": lambda s, d: proofreading.prompts(_bitext(s, d), table(s, d, "glossary"), "match_id", "en", "en"),
        "punctuation_changes": lambda s, d: proofreading.punctuation_changes(_bitext(s, d), _fr(), "fr").unionByName(proofreading.punctuation_changes(_bitext(s, d), _en(), "en")),
        "fix_formatting": lambda s, d: proofreading.fix_formatting(_bitext(s, d).where("fr is not null"), table(s, d, "glossary"), "match_id", "fr", "en", "fr"),
        "membership_counts": lambda s, d: diagnostics.membership(_bitext(s, d), table(s, d, "docx_sentences"), ["document_name"]),
    }


_WHOLE = "(select * from matched_docx_data where en is not null and fr is not null)"
_SIDES = "(select match_id, 'en' as lang, en as text from matched_docx_data where en is not null union all select match_id, 'fr', fr from matched_docx_data where fr is not null)"
_NUMBERS = r"list_sort(list_distinct(list_transform(regexp_extract_all(regexp_replace({c}, '[À-ÖØ-öø-ʯ\x{{0370}}-\x{{1FFF}}\x{{2C00}}-\x{{2FFF}}\x{{3005}}-\x{{3007}}\x{{3040}}-\x{{D7FF}}\x{{F900}}-\x{{FDFF}}\x{{FF66}}-\x{{FF9F}}]', 'x', 'g'), '\b[0-9]+(?:[.,][0-9]+)*\b'), lambda x: regexp_replace(x, '[.,]', '', 'g'))))"
_FIGURE = r"regexp_matches({c}, '^\s*[0-9]+\s+') or regexp_matches({c}, '\s+[0-9]+\s*\z') or regexp_matches({c}, '\s+\([0-9]+\)\s*\z') or regexp_matches({c}, '(?i)(?:Figure|{w}|Fig\.?|Tab\.?)\s+[0-9]+') or regexp_matches({c}, '[.!?]{{2,}}\z')"
_FIG = _FIGURE.format(c="en", w="Table") + " or " + _FIGURE.format(c="fr", w="Tableau")
_DATE = r"regexp_matches({c}, '(?i)(?:^|[^\pL\pN\pM_])(?:19|20)[0-9]{{2}}(?:$|[^\pL\pN\pM_])|(?:" + "|".join(X.MONTHS) + r")(?:$|[^\pL\pN\pM_])')"
_SHORT = "(length(en) < 20 or length(fr) < 20)"
_MISMATCH = f"({_NUMBERS.format(c='en')} <> {_NUMBERS.format(c='fr')})"
_LEN = "length(fr)::double / nullif(length(en), 0)"
_CLAUSE = "((length(fr) - length(replace(replace(fr, ',', ''), ';', '')) + 1)::double / (length(en) - length(replace(replace(en, ',', ''), ';', '')) + 1))"


def _tier(value: str, name: str) -> str:
    low, mid, high = X.TIERS[name]
    out = lambda b: f"not coalesce({value} between {b[0]} and {b[1]}, false)"
    return f"case when similarity < {X.MID} then {out(low)} when similarity < {X.HIGH} then {out(mid)} when similarity >= {X.HIGH} then {out(high)} else false end"


def _hits(column: str, lang: str) -> str:
    return f"len(list_filter(regexp_split_to_array(lower({column}), '\\s+'), lambda w: w in ({', '.join(repr(w) for w in X.WORDS[lang])})))"


def _language(c: str) -> str:
    e, f = _hits(c, "en"), _hits(c, "fr")
    return f"case when {e} > {f} and {e} >= 2 and {f} <= 0 then 'en' when {f} > {e} and {f} >= 2 and {e} <= 0 then 'fr' when {e} + {f} >= 2 then 'mixed' else 'unknown' end"


_CLEAN = r"trim(regexp_replace(regexp_replace(translate({c}, '“”„«»‘’‚', '\"\"\"\"\"'''''''), '[^a-zA-ZÀ-ÖØ-öø-ÿ0-9.,;:!?()''\"-]', ' ', 'g'), ' +', ' ', 'g'))".replace('\\"', '"')
_CONSOLIDATED = """
with pairs as (select en, fr, sum(coalesce(count, 0))::bigint as count, min(row_id) as first from table_translations where trim(en) <> '' and trim(fr) <> '' group by en, fr),
entries as (select en, arg_max(fr, (count, -first)) as fr, max(count) as count, arg_max(first, (count, -first)) as first, count(*) - 1 as n_variants from pairs group by en)
"""

def _norm(c: str, cased: bool = False) -> str:
    """A text with spaces for what is no word, for tests of whole words by ``contains``. Other white space
    gets a mark, as a term's space is a plain one."""
    text = c if cased else f"lower({c})"
    return f"' ' || regexp_replace(regexp_replace({text}, '[\\t\\n\\r\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]', ' ¦ ', 'g'), '[^\\pL\\pN\\pM_¦]', ' ', 'g') || ' '"


_GLOSSARY = "(select distinct category, trim(french) as french, trim(english) as english from glossary where trim(french) <> '' and trim(english) <> '')"
_NOT_NULL_FR = "coalesce(fr, '')"
_CHECK = f"""
with m as materialized (select match_id, {_norm("en")} as en_n, {_norm(_NOT_NULL_FR)} as fr_n from matched_docx_data where en is not null),
t as materialized (select distinct english as term, french as other, {_norm("english")} as term_n, {_norm("french")} as other_n from {_GLOSSARY} where length(english) >= 2),
hits as (select m.match_id, t.term, t.other, m.fr_n, t.other_n from m join t on contains(m.en_n, t.term_n))
"""
_UNMATCHED = f"""
with m as materialized (select match_id, {_norm("en")} as en_n, {_norm("fr")} as fr_n, {_norm("en", True)} as en_c, {_norm("fr", True)} as fr_c from {_WHOLE}),
p as materialized (select category in ('acronym', 'table') as cased, {_norm("english")} as e, {_norm("french")} as f, {_norm("english", True)} as ec, {_norm("french", True)} as fc from {_GLOSSARY} where category <> 'site' and least(length(french), length(english)) >= 2)
select distinct match_id from m join p on case when cased then contains(en_c, ec) <> contains(fr_c, fc) else contains(en_n, e) <> contains(fr_n, f) end"""
_COS = "list_cosine_similarity(a.embedding::double[], b.embedding::double[])"
_RESULTS = "(select document_name || '#' || idx as sample, match_id, source as model, en as translated, en is not null as valid, similarity from matched_docx_data where document_name is not null)"


def oracle_sql() -> dict[str, str]:
    flags = {
        "exclude_figtext": _FIG, "exclude_too_short": _SHORT, "has_date_refs": _DATE.format(c="en") + " or " + _DATE.format(c="fr"),
        "has_number_mismatch": _MISMATCH, "exclude_low_similarity": f"similarity < {X.LOW}",
    }
    flag_rows = "select " + ", ".join(f"coalesce({v}, false) as {k}" for k, v in flags.items()) + " from matched_docx_data"
    quantile = ", ".join(f"round(quantile_cont(similarity, {q}), 3) as {n}" for q, n in zip(evaluation.QUANTILES, evaluation.QUANTILE_NAMES, strict=True))
    thresholds = " union all ".join(
        f"select '{n}' as ratio, round(exp(avg(ln(v)) - 2 * stddev_samp(ln(v))), 4) as lower, round(exp(avg(ln(v)) + 2 * stddev_samp(ln(v))), 4) as upper, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as std, round(avg(ln(v)), 4) as log_mean, round(stddev_samp(ln(v)), 4) as log_std, count(*) as n_rows from (select {e} as v from {_WHOLE}) where v > 0" for n, e in (("len_ratio", _LEN), ("clause_ratio", _CLAUSE))
    )
    return {
        "len_clause_ratio": f"select match_id, round({_LEN}, 6) as len_ratio, round({_CLAUSE}, 6) as clause_ratio from {_WHOLE}",
        "flag_too_short": f"select match_id, {_SHORT} as exclude_too_short from {_WHOLE}",
        "flag_dates": f"select match_id, {flags['has_date_refs']} as has_date_refs from {_WHOLE}",
        "flag_figtext": f"select match_id, {_FIG} as exclude_figtext from {_WHOLE}",
        "figure_flags": r"select match_id, regexp_matches(en, '^\s*[0-9]+\s+') as has_leading_numbers, regexp_matches(en, '\s+[0-9]+\s*\z') as has_trailing_numbers, regexp_matches(en, '\s+\([0-9]+\)\s*\z') as has_parenthetical_numbers, regexp_matches(en, '(?i)(?:Figure|Table|Fig\.?|Tab\.?)\s+[0-9]+') as has_figure_references, regexp_matches(en, '[.!?]{2,}\z') as has_repeated_punctuation from " + _WHOLE,
        "number_mismatch": f"select match_id, {_MISMATCH} as has_number_mismatch from {_WHOLE}",
        "language_id": f"select match_id, {_language('en')} as en_language, {_language('fr')} as fr_language from {_WHOLE}",
        "low_similarity": f"select match_id, similarity from matched_docx_data where similarity < {X.LOW}",
        "tiered_ratio_bounds": f"select match_id, {_tier(_LEN, 'len_ratio')} as exclude_len_ratio, {_tier(_CLAUSE, 'clause_ratio')} as exclude_clause_ratio from {_WHOLE}",
        "log_thresholds": thresholds,
        "dedup_kept": f"select match_id, not {_SHORT} and row_number() over (partition by en, fr, {_SHORT} order by match_id) > 1 as is_duplicate from {_WHOLE}",
        "jsonl_bidirectional": f"select en as source, fr as target, 'en' as source_lang from {_WHOLE} union all select fr, en, 'fr' from {_WHOLE}",
        "tuning_records": "select en as source, fr as target, 'en' as source_lang from matched_docx_data where trim(fr) <> ''",
        "steps_per_epoch": "select cast(ceil(count(*) / 64.0) as bigint) as steps from training_data",
        "match_statistics": "select document_name, count(*) as n_pairs, count(distinct idx) as n_places, ((2 * sum((similarity * 1000000)::bigint) + 1000 * count(similarity)) // (2000 * nullif(count(similarity), 0))) / 1000.0 as mean_similarity, min(similarity) as min_similarity, max(similarity) as max_similarity from matched_docx_data group by document_name",
        "corpus_summary": "select count(*) as n_documents, sum(n_pairs)::bigint as n_pairs, round(coalesce(sum(n_places) * 100.0 / nullif(sum(n_pairs), 0), 0.0)::double, 1) as pct_places from (select count(*) as n_pairs, count(distinct idx) as n_places from matched_docx_data group by document_name)",
        "flag_counts": " union all ".join(f"select '{k}' as flag, count(*) filter (where {k}) as n_true, count(*) filter (where not {k}) as n_false from ({flag_rows})" for k in flags),
        "trigger_counts": f"select {' + '.join(f'{k}::int' for k in flags)} as n_triggers, count(*) as n_rows from ({flag_rows}) group by 1",
        "describe_bitext": " union all ".join(f"select '{n}' as \"column\", count({e}) as n, round(avg({e}), 4) as mean, round(stddev_samp({e}), 4) as std, min({e})::double as low, quantile_cont({e}::double, 0.5) as median, max({e})::double as high from matched_docx_data" for n, e in (("similarity", "similarity"), ("n_en", "length(en)"), ("n_fr", "length(fr)"))),
        "clean_text": f"select match_id, {_CLEAN.format(c='en')} as en, {_CLEAN.format(c='fr')} as fr from {_WHOLE}",
        "paragraph_filter": f"select * from (select match_id, lang, {_CLEAN.format(c='text')} as text from {_SIDES}) where length(text) >= 30",
        "append_period": r"select match_id, case when regexp_matches(en, '[.!?]\z') then en else en || '.' end as en from " + _WHOLE,
        "markup_stripped": r"select row_id, regexp_replace(regexp_replace(en, '/([^/]+)/', '\1', 'g'), '[_^]\{([^}]*)\}', '\1', 'g') as en, regexp_matches(en, '/[^/]+/|_\{|\^\{') as formatted from table_translations",
        "unified_spaces": r"select match_id, regexp_replace(translate(fr, '“”„‘’‚', '"
        + '"""'
        + r"'''''''), '[\p{Zs}\x{FEFF}]+', ' ', 'g') as fr from "
        + _WHOLE,
        "punct_spacing_en": r"select match_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(en, ' +(:)', '\1', 'g'), ' +(;)', '\1', 'g'), ' +(\?)', '\1', 'g'), ' +(!)', '\1', 'g'), '([0-9]) +(%)', '\1\2', 'g') as en from " + _WHOLE,
        "usable_pairs": "select pub_number, x.filename_fr, x.filename_en from (select pub_number, max_by({'filename_fr': filename_fr, 'filename_en': filename_en}, (listed_at, coalesce(filename_fr, ''), coalesce(filename_en, ''))) as x from correlation group by pub_number) where x.filename_fr is not null and x.filename_en is not null and not (x.filename_fr = 'WITHDRAWN' and x.filename_en = 'WITHDRAWN')",
        "absent_translations": _CHECK + "select distinct match_id, term, other from hits where not contains(fr_n, other_n)",
        "unmatched_terms": _UNMATCHED,
        "glossary_index": "select lang, key, x.category as category, x.french as french, x.english as english from (select lang, key, max({'category': category, 'french': french, 'english': english}) as x from (select 'fr' as lang, lower(trim(french)) as key, category, trim(french) as french, trim(english) as english from glossary where trim(french) <> '' and trim(english) <> '' union all select 'en', lower(trim(english)), category, trim(french), trim(english) from glossary where trim(french) <> '' and trim(english) <> '') group by lang, key)",
        "contraction_sets": r"""
with w as (select lang, trim(unnest(regexp_split_to_array(lower(translate(text, '’', '''')), '\s+')), '.,!?;:"()[]{}«»') as w from """.replace("\\'\\'", "\'\'") + _SIDES + r""")
select lang, regexp_extract(w, '^(\pL{1,2})''(\pL+)$', 1) as before, list_sort(list_distinct(list(regexp_extract(w, '^(\pL{1,2})''(\pL+)$', 2)))) as afters from w where regexp_matches(w, '^\pL{1,2}''\pL+$') group by 1, 2""",
        "search_patterns": "select category, term, row_number() over (partition by category order by length(term) desc, term) as place from (select distinct category, trim(french) as term from glossary where trim(french) <> '' and trim(english) <> '')",
        "glossary_checklist": _CHECK + "select distinct match_id, term, other from hits",
        "sub_glossary": _CHECK + "select distinct term, other from hits",
        "translation_matches": "select distinct match_id, french, english from matched_docx_data m join (select distinct trim(french) as french, trim(english) as english from glossary) g on contains(m.en, g.english) and contains(m.fr, g.french) where length(english) >= 3",
        "category_counts": "select coalesce(category, 'total') as category, count(*) as n from glossary group by rollup (category)",
        "glossary_dedup": _CONSOLIDATED + "select en, fr, count, n_variants from entries",
        "dash_align": _CONSOLIDATED + "select e.en, coalesce(b.fr, e.fr) as fr, e.count from entries e left join entries b on e.en like '%-%' and b.en not like '%-%' and replace(e.en, '-', '') = b.en",
        "case_merge": _CONSOLIDATED + ", g as (select lower(en) as k, count(distinct lower(fr)) = 1 and count(*) > 1 as one from entries group by 1) select en, fr, count from entries join g on lower(en) = k where not one union all select arg_max(en, (count, -first)), arg_max(fr, (count, -first)), sum(count)::bigint from entries join g on lower(en) = k where one group by k",
        "margin_topk": f"""
with p as (select a.label, a.vec_id as i, b.vec_id as j, {_COS} as sim from embeddings a join embeddings b on a.label = b.label and a.vec_id % 2 = 0 and b.vec_id % 2 = 1),
r as (select label, i, avg(sim) as rm, count(*) as n from (select *, row_number() over (partition by label, i order by sim desc, j) as k from p) where k <= 4 group by 1, 2),
c as (select label, j, avg(sim) as cm, count(*) as n from (select *, row_number() over (partition by label, j order by sim desc, i) as k from p) where k <= 4 group by 1, 2)
select p.label, p.i, p.j, round(sim, 6) as sim, round(case when least(r.n, c.n) < 2 then sim else sim / (rm + cm) end, 6) as margin from p join r using (label, i) join c using (label, j)""",
        "ensemble_argmax": f"select sample, case when valid then translated else '{evaluation.NO_TRANSLATION}' end as translated, case when valid then model end as model from (select *, row_number() over (partition by sample order by valid desc, similarity desc nulls last, match_id) as r from {_RESULTS}) where r = 1",
        "best_per_sample": f"select sample, match_id from (select *, row_number() over (partition by sample order by similarity desc nulls last, match_id) as r from {_RESULTS}) where r = 1",
        "percentile_breakdown": " union all ".join(f"select '{b}' as breakdown, {b} as key, count(similarity) as n, {quantile} from matched_docx_data where similarity is not null and {b} is not null group by {b}" for b in ("source", "doc_region")),
        "set_compare": "select case when count(*) filter (where n <> 1) = 0 then 'same multiset' else 'same set' end as verdict from (select count(*) as n from training_data group by en, fr)",
        "set_difference": "select 'first' as side, count(*) as rows from (select en, fr from training_data except all select en, fr from matched_docx_data) having count(*) > 0 union all select 'second', count(*) from (select en, fr from matched_docx_data except all select en, fr from training_data) having count(*) > 0",
        "membership_counts": "select coalesce(document_name in (select document_name from docx_sentences where document_name is not null), false) as found, count(*) as n_rows from matched_docx_data group by 1",
    }
