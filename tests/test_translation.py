import io
import zipfile

from pyspark.sql import functions as F

from bitloom.functions import text as T
from bitloom.operators import diagnostics, formatting, glossary, proofreading, selection, terms, translation
from bitloom.operators.formatting import Run, differs, highlight, merged, restyled, tabs_apart
from bitloom.sources import docx, docx_edit, files, sinks

GLOSSARY = [("nomenclature", "surveillance acoustique", "acoustic monitoring"), ("taxon", "morue", "cod"), ("acronym", "MPO", "DFO")]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def styled(runs):
    return [(r.text, r.notes()) for r in runs if r.notes()]


def test_formats_are_carried_over():
    source = [Run("the 5"), Run("th", superscript=True), Run(" cod ("), Run("Gadus", italic=True), Run(" "), Run("morhua", italic=True), Run(" spp.), 4 m"), Run("2", superscript=True)]
    runs, notes = restyled(source, "la 5e morue (Gadus morhua spp.), 4 m2")
    assert styled(runs) == [("e", "superscript"), ("Gadus morhua", "italic"), ("2", "superscript")] and notes == []
    assert "".join(r.text for r in runs) == "la 5e morue (Gadus morhua spp.), 4 m2"


def test_formats_that_have_no_place_leave_notes():
    runs, notes = restyled([Run("the 5"), Run("th", subscript=True), Run(" ("), Run("Gadus", italic=True), Run(")")], "la cinquième")
    assert styled(runs) == [] and len(notes) == 2
    # one bracket of several sentences, and brackets italic in part only
    one, none = [Run("Cod ("), Run("Gadus", italic=True), Run("). It fell.")], [Run("Cod (see "), Run("Gadus", italic=True), Run(")")]
    assert styled(restyled(one, "La morue (Gadus). Elle (en 2000) a (presque) chuté.")[0]) == [("Gadus", "italic")]
    assert restyled(none, "La morue (voir Gadus)") == ([Run("La morue (voir Gadus)")], [])
    assert restyled([], "x") == ([Run("x")], []) and restyled([Run("a")], "") == ([], [])


def test_runs():
    assert [r.text for r in tabs_apart([Run("a\tb", bold=True)])] == ["a", "\t", "b"]
    assert [r.text for r in merged([Run("a"), Run("b"), Run("\t"), Run("c"), Run("d", bold=True)])] == ["ab", "\t", "c", "d"]
    assert differs([Run("a"), Run("b", bold=True)]) and not differs([Run("a"), Run(" ", bold=True)]) and not differs([])
    assert highlight(True, True) == "bright green" and highlight(False, False) is None


def test_restyled_paragraphs(spark):
    df = spark.createDataFrame([(1, [("5", False, False, False, False, False), ("th", False, False, False, True, False)], "5e"), (2, None, None)], f"id long, runs array<{formatting.RUN}>, translation string")
    got = {r["id"]: r for r in formatting.restyle_paragraphs(df, "id").collect()}
    assert [r["text"] for r in got[1]["runs"] if r["superscript"]] == ["e"] and got[1]["differs"] and got[2]["runs"] == []


def test_translation_falls_back(spark):
    g = spark.createDataFrame(GLOSSARY, "category string, french string, english string")
    texts = spark.createDataFrame([(1, "La surveillance acoustique est importante."), (2, "  "), (3, None), (4, "Rien.")], "id long, fr string")

    def run(model, **how):
        return {r["id"]: (r["translated_text"], r["find_replace_error"], r["token_prefix_error"], r["attempts"]) for r in translation.translate_texts(texts, g, "id", "fr", "fr", model, **how).collect()}

    kept = run(lambda t, beams: t)
    assert kept[1] == ("La acoustic monitoring est importante.", False, False, 1) and kept[2] == ("  ", False, False, 0) and kept[3][0] is None and kept[4][0] == "Rien."
    # later widths give a valid one
    assert run(lambda t, beams: t if beams > 4 else "x")[1][3] == 2
    lost = run(lambda t, beams: "nothing")
    assert lost[1] == ("nothing", True, False, 1) and lost[4] == ("nothing", False, False, 1)
    assert run(lambda t, beams: None)[4] == ("Rien.", False, False, 3)
    assert run(lambda t, beams: t, use_terms=False)[1][0] == "La surveillance acoustique est importante."


def test_validity():
    mapping = [{"token": "TAXON0001", "original_text": "morue", "category": "taxon", "translation": "cod"}]
    assert translation.is_valid("The TAXON 0001 fell", "La TAXON0001", mapping)
    assert not translation.is_valid("It fell", "La TAXON0001", mapping) and not translation.is_valid(None, "x", [])
    assert not translation.is_valid("The SITE0001", "x", []) and translation.is_valid("SITE", "SITE", [])


def test_small_seams(spark):
    df = spark.createDataFrame([("Jo Roe met Al.", "en")], "t string, lang string")
    found = lambda t, lang: F.array(F.struct(F.lit(0).alias("start"), F.lit(6).alias("end"), F.substring(t, 1, 6).alias("text")))
    assert df.select(translation.person_names(F.col("t"), F.col("lang"))).first()[0] == []
    assert df.select(translation.person_names(F.col("t"), F.col("lang"), found)).first()[0][0]["text"] == "Jo Roe"
    assert df.select(translation.person_names(F.col("t"), F.lit("de"), found)).first()[0] == []
    assert df.select(translation.if_enabled(F.lit("a"), F.lit("b"), False), translation.if_restored(F.lit("a"), F.lit(False))).first()[:] == ("a", None)


def test_labels_are_translated_apart(spark):
    df = spark.createDataFrame([("Figure 3. Map of it. It fell.\n\nEnd",), ("Table 2.",), (None,)], "t string")
    got = [r[0] for r in df.select(translation.labelled(F.col("t"), lambda x: F.upper(x))).collect()]
    assert got[0] == "FIGURE 3. MAP OF IT. IT FELL.\n\nEND" and got[2] is None


def test_evaluation(spark):
    samples = spark.createDataFrame([(1, "a", "b")], "sample_idx long, source_text string, target_text string")
    got = rows(translation.evaluation_rows(samples, {"m": F.upper("source_text")}))
    assert got == sorted([(1, "a", "human", None, "b"), (1, "a", "m", False, "A"), (1, "a", "m", True, "A")], key=str)
    results = spark.createDataFrame([(1, True, False, "x", 0.5), (1, True, False, "y", 0.5), (1, True, False, "z", None), (1, None, None, "human", 1.0)], "sample_idx long, use_find_replace boolean, gender_fix boolean, translator string, similarity double")
    best = translation.best_by_configuration(results).where("details is not null").collect()
    assert [(r["details"], r["similarity"]) for r in best] == [("best_model_genderdefault_preferential", 0.5)]


def test_proofreading(spark):
    g = spark.createDataFrame([*GLOSSARY, ("taxon", "if", "yew")], "category string, french string, english string")
    texts = spark.createDataFrame([(1, "The cod and DFO: 5 %", None), (2, None, None)], "id long, en string, x string")
    got = {r["id"]: r["prompt"] for r in proofreading.prompts(texts, g, "id", "en", "en").collect()}
    assert "- cod -> morue" in got[1] and got[1].count("- ") == 2 and "terms" not in got[2]
    fixed = {r["id"]: r for r in proofreading.fix_formatting(texts, g, "id", "en", "en", "fr").collect()}
    assert fixed[1]["fixed"] == "The morue and MPO\xa0: 5\xa0%" and fixed[1]["terms_changed"] and fixed[1]["punctuation_changed"] and fixed[2]["fixed"] is None


def test_comparison_and_samples(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "n long, t string")
    b = spark.createDataFrame([(1, "y"), (2, "x")], "n long, t string")
    assert [diagnostics.comparison(a, o, "n").first()[0] for o in (a, b, a.limit(1))] == ["same sequence", "same multiset", "different"]
    words = spark.createDataFrame([("don’t",), ("it's",), ("été's",), ("l'eau",), (None,)], "w string")
    assert rows(diagnostics.contraction_suffixes(words, "w")) == [("s", ["it"]), ("t", ["don"])]
    assert rows(diagnostics.cleaning_pairs(spark.createDataFrame([("don 't",), ("don 't",)], "pattern string"))) == [("don 't", "don't")]
    flags = spark.createDataFrame([(i, i % 3 == 0, i % 2 == 0) for i in range(60)], "id long, a boolean, b boolean")
    got = diagnostics.inspection_sample(flags, ["a", "b"], "id").groupBy("flag").count().collect()
    assert {r["flag"]: r["count"] for r in got} == {"a": 5, "b": 5, "kept": 20}
    labelled = spark.createDataFrame([("a", "b", [1]), ("a", " ", [1]), ("a", "c", [])], "source string, target string, labels array<int>")
    assert selection.usable_for_tuning(labelled).count() == 1
    assert files.gated_documents(spark.createDataFrame([("d", "x" * 10, "y"), ("e", "x" * 10, "y" * 10), (None, "x", "y")], "document_name string, en string, fr string"), 10).first()["document_name"] == "e"


def test_docx_round_trip(spark):
    data = spark.createDataFrame([("d", 1, "b & <c>\x0b"), ("d", 0, "a"), (None, 0, "x"), ("e", 0, None)], "name string, pos int, t string")
    made = docx.as_files(data, "name", "pos", "t", "fr")
    assert [r["text"] for r in docx.read_elements(made).orderBy("ord").collect()] == ["a", "b & <c>", "d"]
    assert rows(docx.languages(made)) == [("d", "fr")]


def test_note_and_glossary_sinks(spark, tmp_path):
    groups = spark.createDataFrame([("p", "mixed", ["a", "b"], "tables"), ("q", "url", ["c"], None)], "full_paragraph string, type string, notes array<string>, section string")
    assert rows(sinks.note_table(groups)) == [("paragraphs", "q", "c", "turquoise"), ("tables", "p", "a", "bright green"), ("tables", "p", "b", "bright green")]
    sinks.write_notes(groups, str(tmp_path / "n"))
    assert {r["section"] for r in spark.read.json(str(tmp_path / "n")).collect()} == {"paragraphs", "tables"}
    sinks.write_glossary(spark.createDataFrame(GLOSSARY, "category string, french string, english string"), str(tmp_path / "g"))
    assert spark.read.json(str(tmp_path / "g" / "translations")).count() == 3 and spark.read.json(str(tmp_path / "g" / "statistics")).count() == 4
    sinks.write_checklist(spark.createDataFrame([("P1", "a", "b")], "location string, source_text string, preferred_translation string"), str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "c")).first()["location"] == "P1"
    assert glossary.category_counts(spark.createDataFrame(GLOSSARY, "category string, french string, english string")).count() == 4
    assert terms.PREFIXES and T.LABEL


def test_word_processor_files_are_translated(spark):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    run = lambda t: f"<w:r><w:t>{t}</w:t></w:r>"
    mark = lambda kind: f'<w:r><w:fldChar w:fldCharType="{kind}"/></w:r>'
    body = (
        f"<w:p>{run('a ')}<w:smartTag><w:smartTagPr/>{run('b')}</w:smartTag><w:hyperlink>{run(' link')}</w:hyperlink></w:p>"
        f"<w:p>{run('x')}<w:r><w:tab/></w:r>{run('y')}</w:p><w:p>{mark('begin')}{run('7')}{mark('end')}</w:p><w:p>{mark('end')}{run('z')}<w:r><w:br/><w:t>more</w:t></w:r></w:p><w:p/>"
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document {w} xmlns:w14="urn:x" xmlns:mc="urn:mc" mc:Ignorable="w14"><w:body>{body}</w:body></w:document>')
    files_ = spark.createDataFrame([("d", bytearray(out.getvalue())), ("bad", bytearray(b"x"))], "path string, content binary")
    done = docx_edit.translate_files(files_, lambda t: f"<{t.upper()}>", "fr")
    got = {r["path"]: r for r in done.collect()}
    assert got["d"]["links"] == [" link"] and got["bad"]["content"] is None
    elements = docx.read_elements(done.where("path = 'd'")).orderBy("ord").collect()
    assert [r["text"] for r in elements] == ["<A B LINK>", "<X>\t<Y>", "7", "<Z\nMORE>"]
    assert docx.language(got["d"]["content"]) == "fr"
    with zipfile.ZipFile(io.BytesIO(got["d"]["content"])) as z:
        xml = z.read("word/document.xml").decode()
    assert 'xmlns:w14="urn:x"' in xml and 'mc:Ignorable="w14"' in xml and "ns0:" not in xml
