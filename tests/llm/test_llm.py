import itertools
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitloom.llm import alignment, copies, fmindex, graph, languages, leaks, overlaps, packing, queries, sampling, sentences, spam, splits, truncation
from bitloom.session import table


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# 1. copies


def test_copies(spark):
    data = [
        (1, "Catch rate (t), 7.1", "Taux de capture (t), 7,1", 2), (5, "catch  RATE t 7,1", "“taux de capture” (t) – 7.1", None), (2, "Taux de capture (t), 7,1", "CATCH\xa0RATE [T] 7.1", 3), (3, "Catch rate (t), 71", "Taux de capture (t), 71", 1),
        (4, "calée", "x", 1), (6, unicodedata.normalize("NFD", "CALÉE"), "x", 1), (7, "calee", "x", 1), (8, None, None, 1), (9, "", " ", 1), (10, "a", None, 1), (11, None, "A", 1), (12, "a", "a", 1), (13, "ß°", "x", 1), (14, "SS°", "x", 1),
    ]
    df = spark.createDataFrame([(*d, "clash") for d in data], "row_id long, en string, fr string, count long, __a string")
    assert rows(copies.found_copies(df)) == [(1, 2), (1, 5), (10, 11), (13, 14), (4, 6)]
    got = {r["row_id"]: (r["n_copies"], r["total_count"]) for r in copies.records(df).collect()}
    assert got[1] == (3, 5) and got[8] == (1, 1) and sum(n for n, _ in got.values()) == len(data)
    assert copies.found_copies(df.limit(0)).isEmpty()


def test_copies_of_a_hot_group(spark):
    df = spark.range(30_000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "Same").otherwise(F.col("id").cast("string")).alias("en"), F.lit("x").alias("fr"), F.lit(1).cast("long").alias("count"))
    assert copies.found_copies(df).count() == 9_999


# 2. sentences


@pytest.fixture(scope="module")
def splitter(spark):
    return sentences.fitted(table(spark, "/root/testdata/sf0.01", "docx_sentences"), table(spark, "/root/testdata/sf0.01", "matched_docx_data"))


@pytest.mark.parametrize(
    "units",
    [
        ["Dr. Roe et al. (1999) saw 3.4 kg, approx. 2 % of it.", "Nets, pots, etc. were lost."],
        ["They kept crabs, whelks, etc.", "The panel wrote \"It is low. It is slow.\" in its note."],
        ["Le permis no. 3 205 date du 4 sept. 2021.", "Pourquoi a-t-elle chuté en 2006 ?"],
        ["調査は行われた。", "委員会は「回復していない。調査が必要だ。」と述べた。"],
        ["การสำรวจทำที่11สถานี", "เรือสำรวจกลับเข้าฝั่ง"],
        ["Table 4. Mean length of cod by stratum"],
        ["Nets were lost.", "Figure 12. Map of the bay"],
        ["समिति ने कहा कि भंडार कम है।", "क्या पानी गर्म था?"],
    ],
)
def test_units(splitter, units):
    text = ("" if re.match("[぀-鿿]", units[0]) else "\n" if "Figure" in units[-1] else " ").join(units)
    assert [text[a:b] for a, b in splitter.units(text)] == units


def test_units_without_marks():
    parts = ["水温は上昇した", "資源量は減少した", "調査は行われた", "委員会は報告書を採択した"]
    rng = random.Random(2)
    bare = ["。".join(rng.sample(parts, 3)) + "。" for _ in range(60)] + [p + "。" for p in parts]
    model = sentences.fit([], bare)
    text = parts[2] + parts[0] + parts[3]
    assert [text[a:b] for a, b in model.units(text)] == [parts[2], parts[0], parts[3]]
    assert [a for a, _ in model.units(parts[1] + "。")] == [0]


def test_units_cover_everything(splitter):
    for text in ("", "  ", "\xa0Heading\n\nFigure 2. Map of it\nIt fell…  ", "a" * 50_000, "x. " * 5_000, '"unclosed. And so on. "'):
        spans = splitter.units(text)
        rest = "".join(text[a:b] for (_, a), (b, _) in zip([(0, 0), *spans], [*spans, (len(text), 0)], strict=True))
        assert not rest.strip() and all(text[a:b] == text[a:b].strip() != "" for a, b in spans)
    assert [text for a, b in splitter.units("Methods\nIt fell.") for text in ["Methods\nIt fell."[a:b]]] == ["Methods", "It fell."]


def test_units_held_out(splitter, spark):
    """Sentences that were not fitted on, joined, are found again."""
    rng = random.Random(3)
    pool = [r["en"] for r in table(spark, "/root/testdata/sf0.1", "docx_sentences").where("en is not null").limit(600).collect()]
    pool = [" ".join(s.split()) for s in pool if not re.search(r"[.?!]\s+[A-Z]", s)]
    right = total = 0
    for _ in range(200):
        take = rng.sample(pool, 3)
        got = {b for _, b in splitter.units(" ".join(take))}
        want = set(itertools.accumulate((len(s) + (i > 0) for i, s in enumerate(take))))
        right, total = right + len(got & want), total + len(got | want)
    assert right / total > 0.97


# 3. alignment


def test_alignment_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.1", "docx_sentences")
    model = alignment.fitted(docs)
    en = ["The vessel Mark landed 4,003 kg of cod.", "The bank was closed for 3 weeks.", "Divers counted 12 hake.", "Divers counted 7 skate."]
    fr = ["Le navire Mark a débarqué 4\xa0003 kg de morue.", "Les plongeurs ont compté 7 raie. Les plongeurs ont compté 12 merluche."]
    got = alignment.align(en, fr, model)
    assert (0, 0) in got and (1, 1) not in got and {(2, 1), (3, 1)} <= set(got)
    assert alignment.align([], fr, model) == [] and alignment.align([" "], fr, model) == []
    odd = spark.createDataFrame([("d", 0, "a cod 55", None), ("d", 0, "a cod 55", "la morue 55"), (None, 1, "x", "y"), ("d", None, "x", "y"), ("e", 0, None, "z")], "document_name string, pos int, en string, fr string")
    assert rows(alignment.aligned(odd, model)) in ([("d", 0, 0)], [])


def test_alignment_of_long_documents_in_blocks(spark):
    docs = table(spark, "/root/testdata/sf0.01", "docx_sentences")
    model = alignment.fitted(docs)
    data = [("long", i, f"The vessel Mark landed {1000 + i} kg of cod.", f"Le navire Mark a débarqué {1000 + i} kg de morue.") for i in range(1000)]
    got = alignment.aligned(spark.createDataFrame(data, "document_name string, pos int, en string, fr string"), model).collect()
    assert sum(r["en_pos"] == r["fr_pos"] for r in got) > 980 and len(got) < 1020
    # French lacks the first part, and a part of the rest has moved to the end
    kept = [*range(600, 900), *range(1200, 1700), *range(900, 1200)]
    data = [("long", i, f"The vessel Mark landed {1000 + i} kg of cod.", None) for i in range(1700)] + [("long", j, None, f"Le navire Mark a débarqué {1000 + i} kg de morue.") for j, i in enumerate(kept)]
    got = alignment.aligned(spark.createDataFrame(data, "document_name string, pos int, en string, fr string").repartition(3), model).collect()
    assert sum(kept[r["fr_pos"]] == r["en_pos"] for r in got) > 1060 and len(got) < 1140


def test_alignment_of_three_in_one(spark):
    model = alignment.fitted(table(spark, "/root/testdata/sf0.01", "docx_sentences"))
    en = ["Divers counted 12 hake.", "The vessel Mark landed 4,003 kg of cod.", "Divers counted 7 skate.", "Divers counted 31 cod."]
    fr = ["Les plongeurs ont compté 12 merluche.", "Le navire Mark a débarqué 4\xa0003 kg de morue; les plongeurs ont compté 7 raie; les plongeurs ont compté 31 morue."]
    assert set(alignment.align(en, fr, model)) == {(0, 0), (1, 1), (2, 1), (3, 1)}


def model_one(pairs, steps, kept):
    """IBM model 1, plainly."""
    t = {}
    for step in range(steps):
        count = {}
        for source, target in pairs:
            for f in target:
                share = {e: t[e].get(f, 0.0) if step else 1.0 for e in source}
                for e in source:
                    count.setdefault(e, {}).setdefault(f, 0.0)
                    count[e][f] += share[e] / sum(share[x] for x in source)
        t = {e: {f: c / sum(to.values()) for f, c in sorted(to.items(), key=lambda x: (-x[1], x[0]))[: kept if step + 1 == steps else 4 * kept]} for e, to in count.items()}
    return t


def test_alignment_is_fitted_on_all_documents(spark, monkeypatch):
    """400 documents; each of 30 words is in four of them, so that a sample of 300 lacks some."""
    letters = [a + b for a in "abc" for b in "klmnopqrst"] + ["z"] * 70
    rng, data, pairs = random.Random(3), [], []
    for i in range(400):
        k = rng.sample(range(8), 3)
        en = f"the {letters[i % 100]}word {' '.join(f'en{chr(97 + x)}' for x in k)} {10000 + 2 * i} {10001 + 2 * i}"
        fr = f"le {letters[i % 100]}mot {' '.join(f'fr{chr(97 + x)}' for x in k)} {10000 + 2 * i} {10001 + 2 * i}"
        data += [(f"d{i}", 0, en, "autre chose"), (f"d{i}", 1, None, fr)]
        pairs.append((en.split()[:-2], fr.split()[:-2]))
    df = spark.createDataFrame(data, "document_name string, pos int, en string, fr string")
    whole = alignment.fitted(df)
    assert all(max(whole["to_fr"][f"{w}word"].items(), key=lambda x: x[1])[0] == f"{w}mot" for w in letters)
    assert len(whole["to_fr"]) == 40
    monkeypatch.setattr(alignment, "FIT_CHUNK", 60)
    monkeypatch.setattr(alignment, "CHUNK", 100)
    for model in (whole, alignment.fitted(df.repartition(7))):
        for name, of in (("to_fr", pairs), ("to_en", [(b, a) for a, b in pairs])):
            want = model_one(of, alignment.EM_STEPS, alignment.KEPT)
            assert model[name].keys() == want.keys()
            for e, to in want.items():
                assert sorted(model[name][e].values()) == pytest.approx(sorted(to.values()), abs=1e-4)
    assert rows(alignment.aligned(df)) == rows(alignment.aligned(df, whole)) == sorted(((f"d{i}", 0, 1) for i in range(400)), key=str)


def test_expected_translations_in_parts(monkeypatch):
    rng = random.Random(5)
    pairs = [([f"e{rng.randrange(30)}" for _ in range(rng.randrange(9))], [f"f{rng.randrange(30)}" for _ in range(rng.randrange(9))], rng.randrange(1, 4)) for _ in range(80)]
    source, target = {f"e{k}": k for k in range(25)}, {f"f{k}": k for k in range(20)}
    usual = [([e for e in a if e in source], [f for f in b if f in target]) for a, b, n in pairs for _ in range(n)]
    got = []
    for cells, at_once in ((1 << 23, 1 << 18), (0, 1 << 18), (1 << 23, 7), (0, 7)):
        monkeypatch.setattr(alignment, "CELLS", cells)
        monkeypatch.setattr(alignment, "AT_ONCE", at_once)
        held, counts = alignment.expected(pairs, source, target, None)
        got.append((held, counts, *alignment.expected(pairs, source, target, (held, counts / alignment.UNITS))))
    for other in got[1:]:
        assert all(np.allclose(a, b, atol=2) for a, b in zip(got[0], other, strict=True))
    total = sum(len(b) for a, b in usual if a)
    assert got[0][1].sum() / alignment.UNITS == pytest.approx(total, abs=1e-3) and got[0][3].sum() / alignment.UNITS == pytest.approx(total, abs=1e-3)
    assert all(not len(x) for x in alignment.expected(pairs, {}, target, None))


# 4. truncation


def test_truncation(spark):
    whole = [f"The vessel {n} landed {k} kg of cod in the {n} Bay." for k in range(40) for n in ("Alfa", "Bravo")]
    cut = ["The vessel Carlo landed 5 kg of cod in the", "The vessel Carlo landed 5 k", "The vessel Delta lan…"]
    labels = [f"Figure {k}. Map of the Alfa Bay" for k in range(20)] + ["Acknowledgements"] * 20 + ["They waited and waited..."] * 20
    data = [(i, t, None, "s") for i, t in enumerate(whole + labels + cut)] + [(900, None, None, None), (901, "", " ", None)]
    df = spark.createDataFrame(data, "match_id long, en string, fr string, source string")
    assert {r["match_id"] for r in truncation.found_truncated(df).collect()} == {len(whole) + len(labels) + i for i in range(3)}
    assert truncation.found_truncated(df.limit(0)).isEmpty()
    assert truncation.truncation_rates(df).first()["n_values"] == len(whole) + len(labels) + 3


def test_ellipses_alike_at_any_size(spark):
    meant = ["They waited for the hake, and waited... The nets were empty.", "Nobody came near the crab, and waited..."]
    for n in (1, 6):
        cut = [f"The vessel Delta {k} was near the harbour of pe..." for k in range(n)]
        data = [(i, t, None, "s") for i, t in enumerate(meant * n + cut)]
        df = spark.createDataFrame(data, "match_id long, en string, fr string, source string")
        assert {r["match_id"] for r in truncation.found_truncated(df).collect()} == set(range(2 * n, 3 * n)), n


# 5. splits


def find_all(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in parent if find(x) != x}


@pytest.mark.parametrize("bound", [10, 1_000_000])
def test_components(spark, bound):
    rng = random.Random(1)
    edges = [(f"n{rng.randrange(300):03}", f"n{rng.randrange(300):03}") for _ in range(160)] + [(f"hub", f"x{i}") for i in range(50)] + [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    df = spark.createDataFrame([*edges, (None, "a"), ("z", "z")], "u string, v string").repartition(5)
    assert set(rows(graph.components(df, merge_bound=bound))) == find_all(edges)
    assert graph.components(df.limit(0)).isEmpty()


@pytest.mark.parametrize("common", [2, 5, 100])
def test_common_values_against_brute_force(spark, common, monkeypatch):
    rng = random.Random(2)
    held = {f"d{i:02}": {min(int(rng.expovariate(0.12)), 60) for _ in range(rng.randrange(12))} for i in range(60)}
    want = find_all([(a, b) for a, b in itertools.combinations(sorted(held), 2) if len(held[a] & held[b]) >= 4])
    df = spark.createDataFrame([(n, v, 0) for n, vs in held.items() for v in vs], "name string, h1 long, h2 long")
    # without the first edges all has to come from the exact part
    monkeypatch.setattr(splits, "tuple_edges", lambda held, least: held.limit(0).select(F.col("name").alias("u"), F.col("name").alias("v")))
    assert set(rows(graph.components(splits.common_value_edges(df, common=common)))) == want
    monkeypatch.undo()
    assert set(rows(graph.components(splits.common_value_edges(df.union(df), common=common)))) == want


def test_edges_of_common_values_are_few(spark):
    for values in (8, 32):
        df = spark.range(80 * values).select(F.concat(F.lit("d"), F.col("id") % 80).alias("name"), (F.col("id") / 80).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))
        edges = splits.common_value_edges(df)
        assert edges.count() <= 80 * splits.TUPLES and graph.components(edges).count() == 79


def test_publication_keys(spark):
    names = ["RD 2012-0001 X", "rd-2012-1-x", "2012-0001 RD X", "X (RD 2012/0001)", "RD_2012_0001_X", "RD2012-0001 - X", "TN 1998/1 review of 2009-2012 data, L", "card 2012-1", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", splits.publication_key(F.col("n"), ["RD", "TN"]).alias("k"))
    assert [r["k"] for r in df.collect()] == ["RD-2012-1"] * 6 + ["TN-1998-1", None, None]
    many = spark.range(1000).select(F.concat(F.when(F.col("id") % 3 == 0, "QX").when(F.col("id") == 1, "card").otherwise("zz"), F.lit(" 2012-"), "id").alias("name"))
    assert splits.series_codes(many) == ["QX", "ZZ"] and splits.series_codes(many.limit(0)) == []


def test_splits_keep_groups_and_shares(spark):
    d = "/root/testdata/sf0.01"
    got = splits.assign_rows(table(spark, d, "matched_docx_data"), table(spark, d, "split_shares")).collect()
    assert len(got) == table(spark, d, "matched_docx_data").count()
    groups = {}
    for r in got:
        groups.setdefault(r["document_name"] or r["match_id"], set()).add(r["split_name"])
    assert all(len(s) == 1 for s in groups.values())
    assert abs(sum(r["split_name"] == "train" for r in got) / len(got) - 0.8) < 0.01
    runs = splits.assign_sizes([(1, 10), (7, 3)], [("a", 0.5), ("b", 0.5)])
    assert sum(n for *_, n in runs) == 13


# 6. overlaps


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_overlaps_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(25)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice((3, 6, 7, 8, 9, 12, 15, 16, 30)))] for _ in range(40)]
    data = []
    for i in range(240):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            at, what = rng.randrange(len(t)), rng.random()
            t[at : at + 1] = [] if what < 0.3 and len(t) > 1 else [rng.choice(vocabulary)] if what < 0.6 else [t[at], rng.choice(vocabulary)]
        data.append((i, rng.choice(("train", "valid", None)), " ".join(t), None))
    data += [(900, "train", None, "É-tait, 5"), (901, "test", "", "e tait 5"), (902, "test", None, None)]
    df = spark.createDataFrame(data, "train_id long, split_name string, en string, fr string").withColumn("source", F.lit("s"))
    want = {(900, 901)}
    for a, b in itertools.combinations(data[:240], 2):
        x, y = a[2].split(), b[2].split()
        if ("train" == a[1]) != ("train" == b[1]) and levenshtein(x, y) <= max(len(x), len(y)) // 8:
            want.add((a[0], b[0]))
    assert set(rows(overlaps.found_overlaps(df))) == want
    hit = {i for p in want for i in p if data[[d[0] for d in data].index(i)][1] != "train"}
    assert sum(r["n_overlapping"] for r in overlaps.overlap_totals(df).collect()) == len(hit)
    assert overlaps.found_overlaps(df.limit(0)).isEmpty()


def test_banded_distance():
    rng = random.Random(5)
    for _ in range(500):
        a, b = [[rng.choice("abc") for _ in range(rng.randrange(9))] for _ in range(2)]
        k, d = rng.randrange(5), levenshtein(a, b)
        assert overlaps.within(a, b, k) == (d if d <= k else None)


@pytest.mark.parametrize("n", [30, 399, 401, 1203, 5000])
def test_segments_are_disjoint_and_enough(n):
    rng = random.Random(n)
    counts = [rng.randrange(100) for _ in range(n - overlaps.SEGMENT + 1)]
    many = n // (overlaps.PER - 1) + 1
    got = sorted(overlaps.rarest(list(range(len(counts))), counts, overlaps.SEGMENT, many))
    assert len(got) == many and all(b - a >= overlaps.SEGMENT for a, b in itertools.pairwise(got)) and 0 <= got[0] and got[-1] <= n - overlaps.SEGMENT
    assert sum(counts[x] for x in got) / many < 40


def test_long_texts_that_hardly_differ():
    words = [f"w{i % 977}" for i in range(30_000)]
    other = [*words[:9000], "new", *words[9000:20_000], *words[20_003:]]
    assert overlaps.within(words, other, len(words) // overlaps.PER) == 4


# 7. languages


def test_languages_held_out(spark, splitter):
    d = "/root/testdata/sf0.01"
    model = languages.Classifier(languages.dictionaries(table(spark, d, "matched_docx_data"), table(spark, d, "documents")))
    asked = {"en": "The diet of hake in the northern bay contained crab by weight.", "fr": "Le régime de la merluche dans la baie contenait du crabe en poids.", "de": "Der Bestand vor der Küste hat sich seit 1999 nicht erholt.", "es": "No se ha observado ninguna recuperación desde 1999.", "zh": "底层水温上升到4.4度，资源量随之下降。", "ja": "水温は54.9度まで上昇し、資源量は減少した。", "th": "เรือสำรวจกลับเข้าฝั่งก่อนฤดูมรสุม", "hi": "छोटी मछलियों की संख्या 66 प्रतिशत बढ़ी।"}
    assert {k: model.classify(t)[0] for k, t in asked.items()} == {k: k for k in asked}
    assert model.classify("Station X155")[0] == "und" and model.classify("")[0] == "und"
    mixed = spark.createDataFrame([(1, asked["en"] + " " + asked["fr"], asked["fr"]), (2, None, ""), (3, "LE RÉGIME DE LA MERLUCHE DANS LA BAIE CONTENAIT DU CRABE.", None)], "match_id long, en string, fr string")
    assert rows(languages.found_languages(mixed, table(spark, d, "documents"), splitter)) in ([(1, "en", "fr"), (3, "en", "fr")], [])


# 8. containers


def test_packing():
    rng = random.Random(6)
    for _ in range(100):
        sizes = [rng.randint(1, 100) for _ in range(rng.randrange(60))]
        sets = packing.pack(sizes, 100)
        assert sorted(i for s in sets for i in s) == list(range(len(sizes))) and all(sum(sizes[i] for i in s) <= 100 for s in sets)
    parts = packing.differencing([8, 7, 6, 5, 4], 2)
    assert abs(sum([8, 7, 6, 5, 4][i] for i in parts[0]) - 15) <= 1
    enc = packing.encoder()
    for text in ("", "one two three " * 300, "水温は上昇し" * 300, "a" * 3000, " \n" * 700, "x é́🐟 1.5" * 99):
        pieces = packing.divide(text, 50, enc)
        assert "".join(text[a:b] for a, b, _ in pieces) == text
        assert all(n == len(enc.encode_ordinary(text[a:b])) <= 50 for a, b, n in pieces)


def test_containers(spark):
    docs = spark.createDataFrame([(i, f"text number {i} " * (i % 90 + 1)) for i in range(400)] + [(900, None), (901, "")], "doc_id long, text string")
    kinds = spark.createDataFrame([("s", 128), ("bad", 0), ("none", None)], "container_kind string, capacity_tokens int")
    got = packing.containers(docs, kinds).collect()
    fill = {}
    for r in got:
        fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["n_tokens"]
    assert max(fill.values()) <= 128 and {r["doc_id"] for r in got} == set(range(400))
    whole = {r["doc_id"] for r in got if r["piece"] == 0} - {r["doc_id"] for r in got if r["piece"] > 0}
    assert all(sum(x["doc_id"] == d for x in got) == 1 for d in list(whole)[:50])


# 9. leaks


@pytest.mark.parametrize("n", [1, 60, 900])
def test_index_against_plain_search(n):
    rng = np.random.default_rng(n)
    text = rng.integers(1, 5, n)
    index = fmindex.FMIndex(text, 3)
    ended = [*text.tolist(), 0]
    assert fmindex.suffix_array(np.array(ended), 3).tolist() == sorted(range(n + 1), key=lambda i: ended[i:])
    for q in (1, 2, 3):
        phrases = np.array(list(itertools.product(range(1, 5), repeat=q)))
        low, high = index.search(phrases)
        for p, a, b in zip(phrases.tolist(), low, high, strict=True):
            assert sorted(index.locate(np.arange(a, b))) == [i for i in range(n - q + 1) if text[i : i + q].tolist() == p]


def test_leaks(spark):
    rng = random.Random(7)
    words = lambda n: [f"{rng.choice('bcdfgl')}{rng.choice('aeiou')}{rng.choice('mnprst')}{rng.randrange(900)}" for _ in range(n)]
    item, other = words(60), words(60)
    changed = [w if i % 15 else "xx" for i, w in enumerate(item)]
    data = [(1, " ".join(words(50) + item + words(50))), (2, " ".join(changed).upper().replace(" ", " , ", 9)), (3, " ".join(words(40) + item[:32] + words(40))), (4, " ".join(item[:15] + words(90))), (5, " ".join(item).replace(item[20], item[20][:2] + "-\n" + item[20][2:])), (6, None), (7, ""), (1, " ".join(item))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    items = spark.createDataFrame([(10, " ".join(item), None), (11, None, " ".join(other)), (12, None, None)], "item_id long, source_text string, target_text string")
    assert rows(leaks.found_leaks(docs, items)) == [(1, 10), (2, 10), (3, 10), (5, 10)]
    span = leaks.leak_spans(docs, items).where("doc_id = 3").first()
    assert data[2][1][span["start_pos"] : span["end_pos"]] == " ".join(item[:32])
    assert leaks.found_leaks(docs, items.limit(0)).isEmpty() and leaks.found_leaks(docs.limit(0), items).isEmpty()


def test_leaks_without_the_rare_words(spark, monkeypatch):
    rng = random.Random(8)
    usual = [f"usual{i}" for i in range(400)]
    spread = [[rng.choice(usual) for _ in range(50)] + [f"rare{k}x{i}" for i in range(50)] for k in range(40)]
    texts = [*spread, usual]
    items = spark.createDataFrame([(k, " ".join(t), None) for k, t in enumerate(texts)], "item_id long, source_text string, target_text string")
    # the half that has no rare word, and less than half
    docs = spark.createDataFrame([(1, " ".join(["a"] * 9 + spread[3][:50] + ["b"] * 9)), (2, " ".join(spread[4][:40])), (3, " ".join(spread[5][50:]))], "doc_id long, text string")
    want = [(1, 3), (3, 5)]
    assert rows(leaks.found_leaks(docs, items)) == want
    monkeypatch.setattr(leaks, "ITEM_BLOCK", 1)
    assert rows(leaks.found_leaks(docs, items.where("item_id in (3, 4, 5, 40)"))) == want


# 10. spam


def test_spam(spark):
    base = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    pages = [(10_001, "buy cheap cod online " * 60, "en"), (10_002, "\n".join(f"Ref {i} frozen hake {i} kg 9.{i}" for i in range(60)), "en"), (10_003, " ".join(f"#cod{i} #tag_{i}" for i in range(90)), None), (10_004, None, "en"), (10_005, "", "en"), (10_006, "The vessel was in the bay for the whole of the season and it was not seen again by the crew. " * 3, "fr")]
    both = base.unionByName(spark.createDataFrame(pages, "doc_id long, text string, lang string"))
    got = {r["doc_id"] for r in spam.found_spam(both).collect()}
    assert {10_001, 10_002, 10_003} <= got and not got & {10_004, 10_005, 10_006}
    assert spam.found_spam(base.limit(0)).isEmpty()


def test_spam_of_other_scripts_at_any_size(spark):
    base = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang").where("lang in ('en', 'fr')")
    prose = {
        "zh": "底层水温上升到{}度，资源量随之下降。调查船在附近的海域设置了{}个站点，专家组认为种群尚未恢复。", "hi": "समिति ने कहा कि भंडार अभी भी कम है। पानी का तापमान {} डिग्री तक बढ़ गया और {} टन मछली पकड़ी गई। ",
        "ja": "水温は{}度まで上昇し、資源量は減少した。委員会は{}年に追加の調査が必要だと述べた。", "th": "คณะทำงานเห็นว่าจำนวนปลายังไม่ฟื้นตัว ในปี{}จับปลาได้{}ตันที่อ่าว ", "ru": "Комиссия сообщила, что в {} году запас рыбы был ещё низким, и судно за {} дней обошло залив. ",
    }
    words = {"zh": "鳕鱼 价格 优惠 购买 ", "hi": "सस्ती मछली खरीदें ऑनलाइन छूट ", "ja": "激安 鮭 通販 送料無料 ", "th": "ปลาค็อด ราคาถูก ซื้อ สด ", "ru": "купить рыбу дёшево онлайн "}
    for n in (1, 30):
        pages = [(10_000 + 100 * k + i, "".join(prose[lang].format(7 * i + j, 11 * i + j) for j in range(6)), lang) for k, lang in enumerate(prose) for i in range(n)]
        pages += [(20_000 + k, text * 40, label) for k, text in enumerate(words.values()) for label in (list(words)[k],)]
        # under another label
        pages += [(21_000, words["zh"] * 40, None), (11_000, prose["hi"].format(1, 2) * 5, "en")]
        both = base.unionByName(spark.createDataFrame(pages, "doc_id long, text string, lang string"))
        assert {r["doc_id"] for r in spam.found_spam(both).where("doc_id >= 10000").collect()} == {*range(20_000, 20_005), 21_000}, n


# all


def test_sample_is_bounded(spark):
    assert sampling.smallest(spark.range(50_000), ["id"], 100).count() == 100
    assert sampling.smallest(spark.range(5), ["id"], 100).count() == 5


def test_queries(spark, sf):
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert queries.queries()["p1_found"](spark, sf).columns == ["row_a", "row_b"]
