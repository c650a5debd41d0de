"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding maps homoglyphs (Cyrillic, Greek, full-width letters) and digit or
sign substitutions (``1d10t``, ``$cum``) to plain lower-case letters, one
character for one, so lengths stay comparable.  Lexicon entries match where a
word begins; a match inside an exception phrase does not count.  The matched
weight, alone and divided by the text's words, gives a probability through a
logistic curve.

Entries and weights: a small base lexicon, and word stems learned from a
bounded sample of labelled texts.  A stem is kept if it stands in toxic texts
in many different contexts (neighbouring words) and hardly ever in others, so
copies of one text count once.

Defined results: null and empty texts score the curve's value at no match
(the lowest score); repeated rows are scored alike; extra columns are kept by
``score_toxicity`` unless their names clash with its own, which are replaced;
an empty table gives an empty result.  Without labelled texts only the base
lexicon and a default curve are used.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from bisect import bisect_right
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import fresh, held_out, labelled_sample, materialise, small_batches

# Ordinary insults with weights, and phrases in which they are harmless.
BASE_LEXICON = {"idiot": 3.0, "moron": 3.0, "imbecile": 3.0, "stupid": 2.0, "dumbass": 3.0, "loser": 2.0,
                "scum": 3.0, "worthless": 2.0, "pathetic": 2.0, "disgusting": 2.0, "trash": 2.0, "clown": 2.0}
EXCEPTIONS = ("idiot proof", "idiot-proof", "loser bracket", "pond scum", "stupidly simple", "worthless stock")

# Look-alike characters and substitutions, written as pairs "from to".
HOMOGLYPHS = "аa вb сc ԁd еe һh іi јj кk мm нh оo рp ѕs тt уy хx αa βb εe ιi κk νv οo ρp τt υu χx ıi ɑa ɡg ʟl"
SUBSTITUTIONS = "0o 1i 3e 4a 5s 7t @a $s !i"

SAMPLE_ROWS = 16_000          # labelled texts that the lexicon is learned from, at most
STEM_MIN, STEM_MAX = 4, 14    # letters of a learned stem
MIN_CONTEXTS = 5              # different contexts a learned stem needs in toxic texts
MIN_TOXIC_SHARE = 0.95        # of a learned stem's contexts
PURER = 0.002                 # toxic share by which a longer stem is better than a shorter one
THRESHOLD = 0.3


def _fold_table() -> dict[int, str]:
    table = {}
    for pair in (*HOMOGLYPHS.split(), *SUBSTITUTIONS.split()):
        table[ord(pair[0])] = pair[1]
        if pair[0].upper() != pair[0] and len(pair[0].upper()) == 1:
            table[ord(pair[0].upper())] = pair[1]
    for c in range(0xFF01, 0xFF5F):  # full-width forms
        plain = chr(c - 0xFEE0).lower()
        table[c] = table.get(ord(plain), plain)
    for c in (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x00AD):  # invisible characters
        table[c] = ""
    return table


_TABLE = _fold_table()


def fold(text: str) -> str:
    """Lower case, compatibility forms composed, look-alikes replaced."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return text.lower().translate(_TABLE)


@dataclass
class ToxicityModel:
    lexicon: dict[str, float] = field(default_factory=lambda: dict(BASE_LEXICON))
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 1.5, 0.3)  # constant, total weight, weight per 100 words

    def __post_init__(self):
        self._automaton = None

    def plain(self) -> dict:
        """The fields alone, as they go to the tasks."""
        return {"lexicon": self.lexicon, "exceptions": self.exceptions, "curve": self.curve}

    def _matcher(self):
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for term, weight in self.lexicon.items():
                if fold(term):
                    a.add_word(fold(term), (fold(term), weight))
            for phrase in self.exceptions:
                if fold(phrase):
                    a.add_word(fold(phrase), (fold(phrase), None))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def match(self, text: str | None) -> list[tuple[int, int, str, float]]:
        """(start, end, entry, weight) of the counted matches in folded text."""
        text, a = text or "", self._matcher()
        if not len(a):
            return []
        found, spared = [], []
        # a 1 stands for an i or for an l; both foldings keep the places
        for t in [fold(text), *([fold(text.replace("1", "l"))] if "1" in text else [])]:
            for last, (term, weight) in a.iter(t):
                start = last + 1 - len(term)
                if start and t[start - 1].isalpha():
                    continue
                (spared if weight is None else found).append((start, last + 1, term, weight))
        if spared:
            # of the phrases that begin at or before a match the one that reaches farthest
            starts, reach = zip(*sorted((s, e) for s, e, _, _ in spared))
            reach = list(accumulate(reach, max))
            found = [m for m in found if not ((k := bisect_right(starts, m[0])) and reach[k - 1] >= m[1])]
        best = {}  # of the entries that begin at one place the longest counts
        for m in found:
            if m[0] not in best or m[1] > best[m[0]][1]:
                best[m[0]] = m
        return [best[k] for k in sorted(best)]

    def features(self, text: str | None) -> tuple[float, float, int]:
        """Matched weight and weight per word (logarithms), number of matches."""
        matches = self.match(text)
        weight = sum(m[3] for m in matches)
        if not matches:
            return 0.0, 0.0, 0
        words = max(1, len((text or "").split()))
        return math.log1p(weight), math.log1p(100.0 * weight / words), len(matches)

    def probability(self, weight: float, density: float) -> float:
        z = self.curve[0] + self.curve[1] * weight + self.curve[2] * density
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))

    def score(self, text: str | None) -> float:
        a, b, _ = self.features(text)
        return self.probability(a, b)


_WORD = re.compile(r"[^\W_]+")


def _words_in_context(batches):
    """(y, word, context) of the first place of each word of each text.

    A context is a hash of the two neighbouring words, so a copied sentence
    gives one context however often it was copied.
    """
    for pdf in batches:
        out = []
        for text, y in zip(pdf["text"], pdf["y"]):
            words = ["", *_WORD.findall(fold(text or "")), ""]
            first: dict[str, int] = {}
            for i in range(1, len(words) - 1):
                w = words[i]
                if len(w) >= STEM_MIN and w not in first:
                    first[w] = zlib.crc32(f"{words[i - 1]} {words[i + 1]}".encode())
            out += [(int(y), w[:64], c) for w, c in first.items()]
        yield pd.DataFrame(out, columns=["y", "word", "context"])


def _counted_texts(sample: DataFrame, stems: list[str]) -> dict[str, tuple[int, int]]:
    """For each stem the toxic and other texts that have it, as the distinct
    contexts of its first place in a text: copies of a text count once, and
    so does a long text with many words of one stem."""
    known = set(stems)

    def first_places(batches):
        for pdf in batches:
            out = []
            for text, y in zip(pdf["text"], pdf["y"]):
                words = ["", *_WORD.findall(fold(text or "")), ""]
                first: dict[str, int] = {}
                for i in range(1, len(words) - 1):
                    for k in range(STEM_MIN, min(len(words[i]), STEM_MAX) + 1):
                        stem = words[i][:k]
                        if stem in known and stem not in first:
                            first[stem] = zlib.crc32(f"{words[i - 1]} {words[i + 1]}".encode())
                out += [(int(y), s, c) for s, c in first.items()]
            yield pd.DataFrame(out, columns=["y", "stem", "context"])

    rows = (sample.select("text", "y").mapInPandas(first_places, "y int, stem string, context long").distinct()
            .groupBy("stem").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("o")).collect())
    return {r["stem"]: (r["t"], r["o"]) for r in rows}


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Stems of toxic texts in ``sample`` (text, y) with log-odds weights.

    Candidates are the stems whose words' contexts are nearly all toxic and
    more than chance would give among all stems (binomial tail with
    Bonferroni's correction); kept are those that pass the same test when
    only texts count.
    """
    words = (sample.select("text", "y").mapInPandas(_words_in_context, "y int, word string, context long")
             .distinct().groupBy("word", "y").count())
    of = lambda y: F.coalesce(F.sum(F.when(F.col("y") == y, F.col("count"))), F.lit(0))
    stems = (words.select("y", "count", F.explode(F.sequence(F.lit(STEM_MIN), F.least(F.length("word"), F.lit(STEM_MAX)))).alias("k"), "word")
             .groupBy(F.expr("left(word, k)").alias("stem")).agg(of(1).alias("t"), of(0).alias("o")))
    total = words.agg(of(1).alias("t"), of(0).alias("o"), F.count(F.lit(1)).alias("n")).first()
    if not total["t"] or not total["o"]:
        return {}
    rate, tests = total["t"] / (total["t"] + total["o"]), total["n"] * 8
    rows = (stems.where((F.col("t") >= MIN_CONTEXTS) & (F.col("t") >= MIN_TOXIC_SHARE * (F.col("t") + F.col("o")))
                        & (F.col("t") * -math.log(rate) >= math.log(tests)))
            .collect())  # bounded by the sample
    texts = {r["y"]: r["count"] for r in sample.select("text", "y").distinct().groupBy("y").count().collect()}
    share = texts[1] / (texts[0] + texts[1])
    kept = {s: (t, o) for s, (t, o) in _counted_texts(sample, [r["stem"] for r in rows]).items()
            if t >= MIN_CONTEXTS and t >= MIN_TOXIC_SHARE * (t + o) and t * -math.log(share) >= math.log(tests)}
    purest = {}  # the largest toxic share among a stem and those that extend it
    for stem, (t, o) in kept.items():
        for k in range(STEM_MIN, len(stem) + 1):
            purest[stem[:k]] = max(purest.get(stem[:k], 0.0), t / (t + o))
    out: dict[str, float] = {}
    for stem in sorted(kept, key=lambda k: (len(k), k)):
        t, o = kept[stem]
        # a longer stem adds nothing to a kept shorter one, unless it is purer
        if t / (t + o) >= purest[stem] - PURER and not any(stem[:k] in out for k in range(STEM_MIN, len(stem))):
            out[stem] = round(math.log((t + 0.5) / (o + 0.5)), 6)
    return out


def _fit_curve(features: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by damped Newton steps; the slopes are kept >= 0."""
    x = np.column_stack([np.ones(len(y)), features])
    w, ridge = np.zeros(3), np.array([0.001, 0.01, 0.01]) * max(1, len(y)) ** 0.5
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0)), float(max(w[2], 0.0))


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model from a bounded sample of the labelled, not held-out texts.

    ``sample_rows`` bounds the sample (and with it all that reaches the driver).
    """
    sample = materialise(labelled_sample(docs, labels, "toxic", text, sample_rows), "toxic-sample")
    model = ToxicityModel()
    learned = learn_lexicon(sample)
    for stem, weight in learned.items():
        if not any(stem.startswith(base) for base in model.lexicon):
            model.lexicon[stem] = weight

    plain = model.plain()

    def described(batches):
        m = ToxicityModel(**plain)
        for pdf in batches:
            f = [m.features(t) for t in pdf["text"]]
            yield pd.DataFrame({"a": [v[0] for v in f], "b": [v[1] for v in f], "y": pdf["y"].to_numpy("int32")})

    rows = sample.select("text", "y").mapInPandas(described, "a double, b double, y int").toPandas()
    rows = rows.sort_values(["a", "b", "y"])  # bounded by the sample; in one order whatever the layout
    if len(rows) and 0 < rows["y"].sum() < len(rows):
        model.curve = _fit_curve(rows[["a", "b"]].to_numpy(float), rows["y"].to_numpy(float))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``matches`` (counted matches)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    @F.pandas_udf("score double, matches int")
    def scored(texts: pd.Series) -> pd.DataFrame:
        m = shared.value.get("built")
        if m is None:  # once per worker process
            m = ToxicityModel(**shared.value)
            shared.value["built"] = m
        f = [m.features(t) for t in texts]
        return pd.DataFrame({"score": [m.probability(a, b) for a, b, _ in f],
                             "matches": np.array([n for _, _, n in f], "int32")})

    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted", "matches")]
    own, = fresh(docs, "toxicity")
    return (small_batches(docs).select(*[docs[c] for c in kept], scored(docs[text]).alias(own))
            .select(*kept, f"{own}.score", (F.col(f"{own}.score") >= THRESHOLD).cast("int").alias("predicted"),
                    f"{own}.matches"))


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "matches")
