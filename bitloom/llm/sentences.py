"""Sentence units in several scripts (problem 2).

Characters are tagged as ending a unit or not by a linear-chain model (an averaged structured
perceptron with two tags) that is decoded with Viterbi. Characters behind which no unit can end in any
script are inside, so the chain runs over the other places only; all of these are scored by what was
learned. The model is trained on sentences known one by one, joined at random. Text in a script without
spaces that has no mark or space where its units end is tagged character by character by a second model
of the same form, trained on text of these scripts with marks and spaces taken out.
"""

from __future__ import annotations

import random
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitloom.llm.sampling import samples

#: Most sentences per language side, and values in scripts without spaces, that a model is fitted on.
FIT_SENTENCES, FIT_BARE = 3000, 600
#: Joined texts made of them, and passes over them.
FIT_TEXTS, EPOCHS = 5000, 6

THAI = "฀-໿က-႟ក-៿"
HAN = "぀-ヿ㐀-鿿ｦ-ﾟ"
CLOSERS = "\"”’'»)\\]」』）】›"
OPENERS = "\"“‘'«(\\[「『（【‹¿¡"
#: Where a unit can end: marks with their closers, line breaks, white space beside Thai and the like.
PLACE = re.compile(rf"(?:[.!?…]+(?:[{CLOSERS}]|\s?»)*)(?=\s|$|[{HAN}{THAI}]|(?<=[^\W\d_]{{2}}[.!?])[^\W\d_a-zß-ÿ])|(?<=\d[.!?])(?=[A-ZÀ-ÝŒ][a-zà-ÿ'’])|[。！？｡]+[{CLOSERS}]*|[।॥]+[{CLOSERS}]*|(?<=\S)(?=[^\S\n\r]*[\n\r])|(?<=[{THAI}])(?=[^\S\n\r])|(?<=\S)(?=[^\S\n\r]+[{THAI}])")
DIGITS = re.compile(r"\d+")
TOKEN_BEFORE = re.compile(r"[^\s(\[«“\"]+$")
TOKEN_AFTER = re.compile(rf"[{OPENERS}\s]*([^\s.,;:!?»”\")]*[.]?)")
#: Text of these scripts up to where it has a mark, a line's end or, in Thai and the like, a space.
BARE = re.compile(rf"[{HAN}][{HAN}A-Za-z0-9.%、，・]*(?![。！？｡{HAN}A-Za-z0-9.%、，・]|[{CLOSERS}])|[{THAI}][{THAI}A-Za-z0-9.%]*")

#: Sentences that are always among those fitted on: abbreviations and marks of languages that the
#: fitted sentences may lack.
SEED = (
    "Die Proben wurden z. B. im Mai genommen.", "Dr. Weber maß ca. 4,5 Prozent mehr.", "Die Netze bzw. die Reusen standen leer.", "Warum fehlen die Fische?", "Im Jahr 1999 war es d. h. im Herbst kälter.", "Nach Angaben von Prof. Lang stimmt das.",
    "La captura subió un 4,2 por ciento, p. ej. en mayo.", "El Dr. Pérez midió 40 peces.", "¿Por qué bajó la población?", "La Sra. Ruiz vive en la av. Mayor.", "En 2001 no hubo cambios.", "¡No quedaba nada!",
    "Mr. Hill met Mrs. Dale at St. Ives.", "It weighed approx. 3 kg.", "See Fig. 4 and Sect. 2.", "They kept cod, hake, etc.", "The boat came back at 9 p.m.", "It belongs to Reed Fish Co.", "J. K. Moss wrote vol. 2, p. 14.",
    "M. Roy et Mme Paré ont vu env. 12 phoques.", "Voir fig. 3 et tabl. 2.", "Certains, p. ex. les crabes, restent.", "Elle travaille pour Roy inc.", "Il a plu, etc.", "pH rose to 8.", "Il date du 4 sept. 2021.", "Le 3 janv. 1999, il a plu.", "It came on 3 Oct. 1999.", "The Feb. 2 haul, no. 5, was small.", "2,5 kg ont été pris.", "Was it lost?", "It sank!", "J. Moss left.", "R. A. Hill saw 12 of them at St. Ives.", "Cf. Table 4 for it.", "Dr. Dale et al. agreed.", "No. 5 was lost.", "12.5 kg were kept.", "3,4 kg ont été pris.", "40 boats came.", "M. B. Roy est parti.", "La Dre Paré est venue.",
    "委員会は「回復していない。調査が必要だ。」と述べた。", "調査は行われた。", "水温は上昇した！", "資源は減ったか？", "专家组写道：“资源下降。需要调查。”", "调查船在海域设置了站点。", "水温上升了吗？", "報告は『少ない。』とした。",
    "समिति ने कहा कि भंडार कम है।", "उसने लिखा \"मछली कम है। पानी गर्म है।\" और चला गया।", "क्या पानी गर्म था?",
    "เรือสำรวจกลับเข้าฝั่ง", "การสำรวจทำที่สถานี", "จำนวนปลายังไม่ฟื้นตัว",
)


#: Labels of captions.
LABELS = ("Figure", "Fig.", "Table", "Tab.", "Tableau", "Map", "Carte", "Plate", "Planche", "Appendix", "Annexe", "Box", "Encadré")


def _flat(token: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", token.lower()) if not unicodedata.combining(c)).strip("()[]\"'«»“”’,;:")


def _shape(token: str, gap: str, text: str, at: int) -> str:
    if at >= len(text):
        return "end"
    c = text[at]
    if c in "\"“«‘「『":
        rest = text[at + 1 :].lstrip()[:1]
        return "quote" + ("U" if rest.isupper() else "x")
    if c in "([（":
        return "paren"
    if c in "¿¡":
        return "U"
    # letters without case begin sentences like capitals
    return "d" if c.isdigit() else "l" if c.islower() else "U" if c.isalpha() else "p"


def places(text: str) -> list[tuple[int, list[str]]]:
    """(end, features) of every place where a unit can end, in order."""
    out: list[tuple[int, list[str]]] = []
    depth, paren, seen, last = 0, 0, 0, -1
    for m in PLACE.finditer(text):
        end = m.end()
        if end == last or not text[:end].strip() or not text[end:].strip():
            continue
        for c in text[seen:end]:
            if c == '"':
                depth ^= 1
            elif c in "«“「『„":
                depth += 1
            elif c in "»”」』" and depth:
                depth -= 1
            elif c in "([（":
                paren += 1
            elif c in ")]）" and paren:
                paren -= 1
        seen = last = end
        gap = re.match(r"\s*", text[end:]).group()
        nxt = end + len(gap)
        mark = m.group().strip()
        kind = "nl" if "\n" in gap or "\r" in gap else "sp" if gap else "no"
        if kind == "nl":
            depth = paren = 0
        before = TOKEN_BEFORE.search(text[max(0, end - len(m.group()) - 40) : end - len(m.group())] if mark else text[max(0, end - 40) : end])
        raw = before.group() if before else ""
        p = _flat(raw)
        start = end - len(m.group()) - len(raw)
        earlier = TOKEN_BEFORE.search(text[max(0, start - 30) : start].rstrip())
        pp = _flat(earlier.group()) if earlier else ""
        # a label and its number open a caption at the beginning of a line only
        line = text[max(0, start - 40, text.rfind("\n", 0, start) + 1) : start].split()
        label = f"L:{pp}" if len(line) == 1 and line[0][:1].isupper() and p.isdigit() else "L"
        n = DIGITS.sub("0", _flat(TOKEN_AFTER.match(text, nxt).group(1)))
        shape = _shape(n, gap, text, nxt)
        core = mark.strip("\"”’'»)]」』） ")[:3] or "-"
        ptype = "digit" if p[-1:].isdigit() else "one" if len(p) == 1 else "dots" if "." in p else "short" if len(p) <= 3 else "word"
        cap = "C" if raw[:1].isupper() else "c"
        script = "th" if not mark and kind != "nl" else "cjk" if core[0] in "。！？｡।॥" else "lat"
        closed = "q" if mark != core else "-"
        if kind == "nl" or script == "th":
            feats = [f"place:{'line' if kind == 'nl' else 'space'}"]
        elif script == "cjk":
            # a quotation belongs to its sentence, which may go on behind it
            caseless = shape == "U" and not text[nxt].isupper()
            feats = [f"place:{'quoted' if depth else 'goes on' if mark != core and kind == 'no' and caseless else 'mark'}"]
        else:
            key = p if core[0] == "." and len(core) == 1 else "*"
            feats = [
                "b", f"k:{kind}", f"m:{core}:{kind}", f"m:{core}:{shape}", f"d:{min(depth, 1)}:{closed}:{shape}", f"d:{min(depth, 1)}", f"p:{key}", f"p:{key}:{shape}", f"n:{n}", f"m:{core}:n:{n}", f"t:{ptype}{cap}:{shape}:{core}", f"t:{ptype}{cap}", f"r:{paren > 0}", f"pp:{pp}:{key}" if len(p) <= 3 else "pp", f"s:{shape}:{kind}", label,
            ]
        out.append((end, feats))
    return out


class Chain:
    """Weights of two tags (ends a unit or not) in a chain."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        self.w = {} if weights is None else weights

    def decode(self, feats: list[list[str]]) -> list[int]:
        """Viterbi."""
        w = self.w
        t = [[w.get(f"T:{a}{b}", 0.0) for b in (0, 1)] for a in (0, 1)]
        score, back = [0.0, 0.0], []
        for k, f in enumerate(feats):
            emit = sum(w.get(x, 0.0) for x in f)
            if k == 0:
                score, step = [0.0, emit], (0, 0)
            else:
                from0 = (score[0] + t[0][0], score[1] + t[1][0])
                from1 = (score[0] + t[0][1], score[1] + t[1][1])
                step = (int(from0[1] > from0[0]), int(from1[1] > from1[0]))
                score = [max(from0), max(from1) + emit]
            back.append(step)
        tags, tag = [], int(score[1] > score[0])
        for step in reversed(back):
            tags.append(tag)
            tag = step[tag]
        return tags[::-1]

    @classmethod
    def fit(cls, data: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, seed: int = 7) -> Chain:
        """Averaged structured perceptron."""
        rng, w, total, n = random.Random(seed), defaultdict(float), defaultdict(float), 1
        model, data = cls(w), list(data)
        for _ in range(epochs):
            rng.shuffle(data)
            for feats, gold in data:
                guess = model.decode(feats)
                if guess != gold:
                    change: dict[str, float] = defaultdict(float)
                    for tags, sign in ((gold, 1.0), (guess, -1.0)):
                        for k, (f, tag) in enumerate(zip(feats, tags, strict=True)):
                            if tag:
                                for x in f:
                                    change[x] += sign
                            if k:
                                change[f"T:{tags[k - 1]}{tag}"] += sign
                    for x, d in change.items():
                        w[x] += d
                        total[x] += n * d
                n += 1
        return cls({x: v - total[x] / n for x, v in w.items() if abs(v - total[x] / n) > 1e-9})


def _bare_features(text: str, at: int) -> list[str]:
    a, b = text[max(0, at - 3) : at], text[at : at + 3]
    return ["b", f"a1:{a[-1:]}", f"b1:{b[:1]}", f"a2:{a[-2:]}", f"b2:{b[:2]}", f"ab:{a[-1:]}{b[:1]}", f"a3:{a}", f"b3:{b}"]


class Splitter:
    def __init__(self, marks: Chain, bare: Chain | None) -> None:
        self.marks, self.bare = marks, bare

    @classmethod
    def of(cls, marks: dict[str, float], bare: dict[str, float] | None) -> Splitter:
        """From the weights, which are what tasks are sent."""
        return cls(Chain(marks), None if bare is None else Chain(bare))

    def ends(self, text: str) -> list[int]:
        found = places(text)
        tags = self.marks.decode([f for _, f in found])
        out = [end for (end, _), tag in zip(found, tags, strict=True) if tag]
        if self.bare:
            for m in BARE.finditer(text):
                inside = range(m.start() + 1, m.end())
                out += [at for at, tag in zip(inside, self.bare.decode([_bare_features(text, at) for at in inside]), strict=True) if tag]
        return sorted(set(out))

    def units(self, text: str) -> list[tuple[int, int]]:
        """Spans of the units, without white space at their ends; together all other characters."""
        out, at = [], 0
        for end in [*self.ends(text), len(text)]:
            piece = text[at:end]
            if body := piece.strip():
                lead = len(piece) - len(piece.lstrip())
                out.append((at + lead, at + lead + len(body)))
            at = end
        return out


def fit(sentences: list[str], bare: list[str], seed: int = 11) -> Splitter:
    """A splitter from single sentences, and from punctuated texts in scripts without spaces. Some of
    the sentences are several in fact: those that a first splitter divides are left out of the second."""
    first = _fit(sentences, [], seed, FIT_TEXTS // 3, 3)
    return _fit([s for s in sentences if s and len(first.units(s)) <= 1], bare, seed, FIT_TEXTS, EPOCHS)


def _fit(sentences: list[str], bare: list[str], seed: int, texts: int, epochs: int) -> Splitter:
    rng = random.Random(seed)
    pool = [s.strip() for s in sentences if s and s.strip()]
    own, unspaced = list(SEED), [s for s in SEED if re.search(f"[{HAN}{THAI}]", s)]
    data = []
    for _ in range(texts if pool else texts // 6):
        take = [rng.choice(pool if pool and rng.random() < 0.85 else own) for _ in range(rng.randint(2, 5))]
        joined = rng.random()
        if joined < 0.05:  # sentences of one script
            first = rng.choice(unspaced)
            take = [s for s in rng.sample(unspaced, len(unspaced)) if bool(re.search(f"[{THAI}]", s)) == bool(re.search(f"[{THAI}]", first))][:3]
        elif joined < 0.11:
            take = [s.upper() for s in take]
        elif joined < 0.17:
            take = ["".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)) for s in take]
        if rng.random() < 0.2:  # a heading before the sentences
            words = re.findall(r"[^\W\d_]+", rng.choice(pool or own))
            heading = " ".join(words[: rng.randint(2, 5)])
            if rng.random() < 0.5:
                heading = f"{rng.choice(LABELS)} {rng.randint(1, 30)}{rng.choice('.:')} {heading[:1].upper() + heading[1:]}"
            take = [heading] if rng.random() < 0.2 else [heading + "\n", *take]
        text, cuts = "", set()
        for i, s in enumerate(take):
            text += s.rstrip("\n") if s.endswith("\n") else s
            if i + 1 < len(take):
                cuts.add(len(text))
                text += "\n" if s.endswith("\n") else rng.choice(("", "", "\n")) if re.search(f"[{HAN}]", s[-2:]) and re.match(f"[{HAN}]", take[i + 1]) else rng.choice((" ", " ", " ", " ", "  ", " ", "\n", "\n\n", "" if text[-1:] in ".!?" and take[i + 1][:1].isupper() and rng.random() < 0.4 else " "))
        found = places(text)
        if found:
            data.append(([f for _, f in found], [int(end in cuts) for end, _ in found]))
    stripped = []
    for t in bare:
        text, cuts = "", []
        for part in re.split(r"[。！？｡\s]+", t):
            if re.search(f"[{HAN}{THAI}]", part):
                text += part
                cuts.append(len(text))
        if cuts:
            inside = range(1, len(text))
            ends = set(cuts)
            stripped.append(([_bare_features(text, at) for at in inside], [int(at in ends) for at in inside]))
    return Splitter(Chain.fit(data, epochs), Chain.fit(stripped, EPOCHS) if stripped else None)


def texts_without_spaces() -> Column:
    """Values that the second model is fitted on: of Han, Kana, Thai and the like."""
    either = lambda script: F.when(F.col("en").rlike(script) & (F.length("en") < 2000), F.col("en")).when(F.col("fr").rlike(script) & (F.length("fr") < 2000), F.col("fr"))
    return either(f"[{HAN}]{{8}}|[{THAI}]{{8}}")


def fitted(sentences: DataFrame, values: DataFrame) -> Splitter:
    """The splitter for a table of single sentences (en, fr) and values (en, fr).

    It is fitted on at most FIT_SENTENCES sentences a side and FIT_BARE values, those with the
    smallest hashes, so that any order of rows gives the same.
    """
    pool = samples(sentences, {side: (F.col(side), FIT_SENTENCES) for side in ("en", "fr")})
    return fit(pool["en"] + pool["fr"], samples(values, {"bare": (texts_without_spaces(), FIT_BARE)})["bare"])


def units(values: DataFrame, splitter: Splitter) -> DataFrame:
    """(match_id, side, start_pos, end_pos): the units of every ``en`` and ``fr``. Null and blank
    values have none; a row given twice has its units twice."""
    shared = values.sparkSession.sparkContext.broadcast((splitter.marks.w, splitter.bare and splitter.bare.w))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Splitter.of(*shared.value)
        for batch in batches:
            rows = [(i, side, *span) for side in ("en", "fr") for i, text in zip(batch["match_id"].tolist(), batch[side], strict=True) if text for span in own.units(text)]
            yield pd.DataFrame(rows, columns=["match_id", "side", "start_pos", "end_pos"])

    return values.select("match_id", "en", "fr").mapInPandas(cut, "match_id long, side string, start_pos int, end_pos int")
