import io
import zipfile

from pyspark.sql import functions as F

from bitloom.operators import diagnostics, documents, evaluation, glossary, selection, similarity, terms
from bitloom.plans.prune import key_filter, pruned
from bitloom.plans.skew import lookup
from bitloom.sources import docx, files, sinks
from bitloom.streaming import flags

BITEXT = "match_id long, en string, fr string, similarity double, source string"
GLOSSARY = "category string, french string, english string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_lookup_salts_hot_keys(spark):
    many = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    groups = many.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"))
    got = lookup(many, groups, ["k"], "n", F.col("id"))
    assert got.count() == 20_000
    assert got.where("k = 0 and low <> 0").isEmpty()
    assert lookup(many.limit(0), groups.limit(0), ["k"], "n", F.col("id")).isEmpty()


def test_pruning_keeps_every_partner(spark):
    many, few = spark.range(200_000), spark.range(0, 200_000, 400)
    kept = pruned(many, "id", key_filter(few, "id"))
    assert kept.join(few, "id").count() == 500 and kept.count() < 700
    odd = spark.createDataFrame([("a", 1), (None, 2)], "id string, n int")
    assert rows(pruned(odd, "id", key_filter(odd, "id"))) == [("a", 1)]
    assert pruned(odd, "id", key_filter(odd.limit(0), "id")).isEmpty()


def test_train_and_test_are_disjoint(spark):
    text = "The committee discussed the rate of the stock, and nothing else was said about it."
    data = [(1, text, "Le comité a discuté du taux de capture, et rien d'autre n'a été dit à ce sujet.", 0.95, "a"), (2, "x", "y", 0.5, "a"), (3, None, "y", None, None), (4, text, text, float("nan"), "a")]
    df = selection.with_selection(selection.with_flags(selection.with_features(spark.createDataFrame(data, BITEXT))))
    got = {r["match_id"]: (r["exclude"], r["for_test"]) for r in df.collect()}
    assert got[2][0] and got[3] == (True, False)
    assert not any(not e and t for e, t in got.values())
    assert selection.curation_summary(spark.createDataFrame([], BITEXT)).count() == 0


def test_duplicates_keep_the_first(spark):
    df = spark.createDataFrame([(2, "a", "b"), (1, "a", "b"), (3, "a", None), (4, "a", None)], "match_id long, en string, fr string")
    got = {r["match_id"]: r["is_duplicate"] for r in selection.mark_duplicates(df, F.lit(True)).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True}


def test_terms_against_plain_search(spark):
    g = spark.createDataFrame([("nomenclature", "taux de capture", "catch rate"), ("acronym", "MPO", "DFO"), ("site", "baie X", "X Bay"), ("taxon", "morue", "cod"), ("taxon", None, "hake")], GLOSSARY)
    data = [(1, "The Catch rate of cod fell.", "Le taux de capture de la morue.", 1.0, "a"), (2, "catch rates and codfish", "rien", 1.0, "a"), (3, "The DFO said", "Le mpo", 1.0, "a"), (4, None, "morue", 1.0, "a"), (5, "see X Bay", "ailleurs", 1.0, "a"), (6, "cod, cod", "hareng", 1.0, "a")]
    df = spark.createDataFrame(data, BITEXT)
    assert rows(terms.checklist(df, g, "match_id", "en", "en").select("match_id", "term")) == sorted([(1, "catch rate"), (1, "cod"), (3, "DFO"), (5, "X Bay"), (6, "cod")], key=str)
    assert rows(terms.unmatched_constraint(df, g)) == [(3,), (6,)]
    sub = terms.substitute_terms(df, g, "match_id", "fr", "fr")
    first = sub.where("match_id = 1").first()
    assert "NOMENCLATURE0001" in first["tokenised"] and "TAXON0001" in first["tokenised"]
    back = {r["match_id"]: (r["restored"], r["all_replaced"]) for r in terms.restore_terms(sub, "match_id").collect()}
    assert back[1] == ("Le catch rate de la cod.", True)
    assert terms.checklist(df.limit(0), g, "match_id", "en", "en").isEmpty()
    assert rows(terms.replace_terms(df.where("match_id = 6"), g, "match_id", "en")) == [(6, "morue, morue")]


def test_find_token():
    assert terms.find_token("text NOMENCLATURE 0001 here", "NOMENCLATURE0001")[::2] == (True, "NOMENCLATURE 0001")
    assert terms.find_token("text NOMENCLATURE0001es here", "NOMENCLATURE0001")[::2] == (True, "NOMENCLATURE0001es")
    assert terms.find_token("nothing", "TAXON0001")[0] is False


def test_glossary_build(spark):
    t = spark.createDataFrame([(1, "CIOPS-W", "A", 5), (2, "CIOPSW", "B", 5), (3, "Word", "mot", 3), (4, "word", "Mot", 9), (5, "word", "terme", 9), (6, "/x/", "/y/", 4), (7, "NB", "N.-B.", 9), (8, None, "z", 1), (9, "same", "SAME", 9)], "row_id long, en string, fr string, count long")
    c = {r["en"]: (r["fr"], r["count"]) for r in glossary.consolidated(t).collect()}
    assert c["word"] == ("Mot", 9)  # the first seen of equal counts
    assert {r["en"]: r["fr"] for r in glossary.dash_aligned(glossary.consolidated(t)).collect()}["CIOPS-W"] == "B"
    out = {r["en"]: (r["fr"], r["count"]) for r in glossary.table_glossary(t).collect()}
    assert "NB" not in out and "same" not in out
    assert out["word"] == ("Mot", 12) and "Word" not in out


def test_alignment(spark):
    w = similarity.np.array([[0.9, 0.1, 0.1], [0.2, 0.1, 0.95], [0.1, 0.8, 0.1]])
    assert similarity.monotone(w) == [(0, 0), (1, 2)]
    s = spark.createDataFrame([("d", 0, "the cod fell", "the cod fell"), ("d", 1, None, "nothing"), (None, 0, "a", "a")], "document_name string, pos int, en string, fr string")
    assert rows(similarity.align_documents(s)) == [("d", "the cod fell", "the cod fell", 1.0)]


def test_best_model(spark):
    r = spark.createDataFrame([("s", 0, "m0", "a", True, 0.5), ("s", 1, "m1", "b", True, 0.5), ("t", 0, "m0", "c", False, 0.9), ("u", 0, "m0", "d", True, None)], "sample string, model_ord int, model string, translated string, valid boolean, similarity double")
    assert rows(evaluation.best_model(r, "sample")) == [("s", "a", "m0"), ("t", evaluation.NO_TRANSLATION, None), ("u", "d", "m0")]
    calls = []
    out = evaluation.translate(spark.createDataFrame([("x",), ("x",), (" ",), (None,)], "text string"), {"m": lambda t, b: None if b < 8 else t + "!"})
    assert rows(out.select("text", "translated", "attempts", "valid")) == [(" ", " ", 0, True), ("x", "x!", 3, True)]
    assert not calls


def test_sets(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(1,), (2,), (2,)], "x int")
    assert diagnostics.comparison(a, a).first()[0] == "same multiset"
    assert diagnostics.comparison(a, b).first()[0] == "same set"
    assert diagnostics.comparison(a, b.limit(0)).first()[0] == "different"
    own = spark.createDataFrame([("t", ["don", "can"]), ("s", ["it"])], "key string, items array<string>")
    assert rows(diagnostics.pattern_difference(own, own.where("key = 't'"))) == [("s", [], ["it"])]


def test_review_and_markup(spark):
    items = spark.createDataFrame([("d", "P0", "“bad” x", "good"), ("d", "P9", "a", "b"), ("d", "P0", "zzz", "y")], "doc string, location string, error_text string, suggested_fix string")
    text = spark.createDataFrame([("d", "P0", 'a "bad"  x z')], "doc string, loc_id string, text string")
    got = {(r["location"], r["error_text"]): r for r in documents.apply_review(items, text).collect()}
    assert (got["P0", "“bad” x"]["deleted"], got["P0", "“bad” x"]["change_id"]) == ('"bad"  x', 100)
    assert got["P9", "a"]["skip_reason"] == "location not found" and got["P0", "zzz"]["skip_reason"] == "text not found"
    assert documents.parse_markup("/p/_{max}^2 a/b") == [("p", True, False, False), ("max", False, False, True), ("2", False, True, False), (" a/b", False, False, False)]


def make_docx():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "<w:p><w:r><w:rPr><w:lang w:val='fr-CA'/><w:b/></w:rPr><w:t>Un</w:t></w:r><w:r><w:t> mot</w:t></w:r></w:p><w:p/><w:p><w:ins><w:r><w:t>new</w:t></w:r></w:ins><w:del><w:r><w:delText>old</w:delText></w:r></w:del></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>".replace("'", '"'))
        z.writestr("word/header1.xml", f"<w:hdr {w}><w:p><w:r><w:t>Head</w:t></w:r></w:p></w:hdr>")
    return out.getvalue()


def test_docx(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.docx").write_bytes(make_docx())
    (tmp_path / "in" / "~$x.docx").write_bytes(b"")
    (tmp_path / "in" / "bad.docx").write_bytes(b"no archive")
    d = docx.files(spark, str(tmp_path / "in"))
    e = docx.read_elements(d)
    assert rows(e.select("loc_id", "text")) == sorted([("P0", "Un mot"), ("P2", "new"), ("T0-R0", "a"), ("T0-R0", "b"), ("H0", "Head")], key=str)
    assert docx.document_texts(e).first()["located"] == "[P0] Un mot\n[P2] new\n[T0-R0] a | b\n[H0] Head"
    assert docx.language(make_docx()) == "fr"
    accepted, counts = docx.accept_changes(make_docx())
    assert counts["ins"] == 1 and counts["del"] == 1 and [x[-1] for x in docx.elements(accepted)][1] == "new"
    merged = documents.merged_runs(docx.read_runs(d))
    assert {r["text"] for r in merged.collect()} >= {"Un", " mot"}


def test_files_and_sinks(spark, tmp_path):
    pairs = spark.createDataFrame([("root/r/A English.docx",), ("root/r/A French.docx",), ("root/r/A erratum french.docx",), ("root/r/B English.docx",), ("root/r/~$A English.docx",)], "path string")
    assert rows(files.pair_documents(pairs)) == [("A", "r", "root/r/A French.docx", "root/r/A English.docx")]
    df = spark.createDataFrame([("hello", "bonjour")], "en string, fr string")
    sinks.write_records(df, str(tmp_path / "o"))
    assert rows(files.read_records(spark, str(tmp_path / "o"))) == [("bonjour", "hello", "fr"), ("hello", "bonjour", "en")]
    (tmp_path / "g.json").write_text('{"translations": {"acronym": [{"english_acronym": "DFO", "french_acronym": "MPO", "english_full": "Dept", "french_full": "Min"}], "site": {"baie": {"en": "bay"}}}}')
    assert rows(files.read_glossary(spark, str(tmp_path / "g.json"))) == sorted([("acronym", "MPO", "DFO"), ("acronym", "Min", "Dept"), ("site", "baie", "bay")], key=str)
    (tmp_path / "r.txt").write_text('```json\n[{"location": "P1", "error_type": "t", "error_text": "e", "suggested_fix": "f", "notes": "n"}]\n```')
    assert files.read_review(spark, str(tmp_path / "r.txt")).first()["location"] == "P1"


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "same text", "même texte", 0.9, "a"), (2, "same text", "même texte", 0.9, "a")], BITEXT).withColumn("at", F.lit("2020-01-01").cast("timestamp_ntz"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = flags.first_copies(flags.select_stream(stream), "at").writeStream.format("memory").queryName("first_copies").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.table("first_copies").count() == 1
