"""Counterfactually regularised toxicity classifier.

A document is described by which of the selected features its words hold: whole words, and 4- to 6-grams of letters within words. Features
are selected where labelled documents show them to go with toxicity beyond chance; a logistic model over them is trained with a penalty on
counterfactual pairs of sentences. In every labelled sentence that names an identity group, the term is swapped for others of its kind; into
every other one a term, chosen by a hash of the sentence, is put as a neutral mention and swapped in the same way. The mean squared change of
the score's logit is added to the loss, so mentions of a group lose the weight that accidents of the sample, or parts of words that a term
shares with slurs, would give them. Equal pairs are counted on the executors, and all of them are trained on.

Training looks at `sample` labelled documents at most (whole texts); `features` bounds the model. Scoring reads every word. What the driver
gets is bounded by both: of each sampled document its features, and the distinct pairs with their numbers.

Defined results: null or empty text is a document without features; without both labels every score is 0; ids labelled with both or other
values are not trained on, and equal texts with both labels count as toxic; repeated rows get equal scores; features of equal evidence are
taken in alphabetical order; a score of exactly the threshold is toxic; a text of any length is scored whole, with memory in proportion to
it; a null id is kept (and counts as the empty text for the held-out rule); `score` replaces a column toxic_score; further columns of any
name are kept.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episoda.llm import common

FOLDS, HELD_OUT, THRESHOLD = 3, 1, 0.7
SAMPLE, FEATURES = 12_000, 4000
GRAMS = (4, 5, 6)

#: Terms that name groups, by kind; a term is swapped for others of its own kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "woman", "man", "female", "male", "transgender", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "homosexual", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "sikh", "muslims", "christians", "jews", "hindus"),
    ("black", "white", "asian", "african", "european", "latino", "hispanic", "arab", "indigenous"),
    ("american", "mexican", "chinese", "indian", "russian", "french", "german", "spanish", "polish", "turkish"),
    ("old", "young", "elderly", "disabled", "deaf", "blind", "autistic", "immigrant", "refugee", "immigrants", "refugees"),
    ("femmes", "hommes", "musulmans", "juifs", "chrétiens", "noirs", "blancs"),
    ("frauen", "männer", "muslime", "juden", "christen", "schwarze", "weiße"),
    ("mujeres", "hombres", "musulmanes", "judíos", "cristianos", "negros", "blancos"),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features_of(word: str) -> set[str]:
    s = f"^{word}$"
    return {"=" + word} | {s[i : i + n] for n in GRAMS for i in range(len(s) - n + 1)}


class Matcher:
    """Finds which of the given features a list of words has, by one pass of a multi-pattern automaton over the words between their marks."""

    def __init__(self, features: list[str]):
        found: dict[str, list[int]] = {}
        for k, f in enumerate(features):
            found.setdefault(f"^{f[1:]}$" if f[0] == "=" else f, []).append(k)
        self.automaton = ahocorasick.Automaton()
        for pattern, own in found.items():
            self.automaton.add_word(pattern, tuple(own))
        if found:
            self.automaton.make_automaton()

    def find(self, own: list[str]) -> set[int]:
        if not len(self.automaton) or not own:
            return set()
        return {k for _, ks in self.automaton.iter(f"^{'$^'.join(own)}$") for k in ks}


@dataclass
class Model:
    """Features with their weights, and the level without any; None as level: no training data."""

    features: list[str]
    weights: list[float]
    level: float | None
    matcher: Matcher | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"matcher": None}

    def score(self, text: str) -> float:
        if self.level is None:
            return 0.0
        if self.matcher is None:
            self.matcher = Matcher(self.features)
        z = self.level + sum(self.weights[k] for k in sorted(self.matcher.find(words(text))))
        return float(1 / (1 + np.exp(-max(-40.0, min(40.0, z)))))


@dataclass
class Objective:
    """The training loss: weighted logistic loss, ridge, and the weighted mean squared change of the logit over counterfactual pairs."""

    rows: list[tuple[int, np.ndarray]]  # label, present features
    pairs: list[tuple[np.ndarray, np.ndarray, int]]  # features gained and lost by a swap, and how often
    n_features: int
    ridge: float = 1e-5
    counterfactual: float = 1.0

    def __post_init__(self):
        flat = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        self.y = np.array([r[0] for r in self.rows], float)
        self.share = np.where(self.y == 1, 0.25 / max(1.0, self.y.sum()), 0.75 / max(1.0, (1 - self.y).sum()))  # toxic rows weigh a quarter, however rare
        self.owner = np.repeat(np.arange(len(self.rows)), [len(r[1]) for r in self.rows])
        self.column = flat([r[1] for r in self.rows])
        self.p_owner = np.repeat(np.arange(len(self.pairs)), [len(a) + len(b) for a, b, _ in self.pairs])
        self.p_column = flat([x for a, b, _ in self.pairs for x in (a, b)])
        self.p_sign = np.concatenate([np.repeat([1.0, -1.0], [len(a), len(b)]) for a, b, _ in self.pairs]) if self.pairs else np.zeros(0)
        times = np.array([n for *_, n in self.pairs], float)
        self.p_share = times / max(1.0, times.sum())

    def __call__(self, w: np.ndarray, level: float) -> tuple[float, np.ndarray]:
        """The loss, and its gradient by all weights and the level."""
        z = np.clip(level + np.bincount(self.owner, w[self.column], len(self.y)), -40, 40)
        loss = float((self.share * (np.logaddexp(0, z) - self.y * z)).sum() + self.ridge / 2 * (w * w).sum())
        d = (1 / (1 + np.exp(-z)) - self.y) * self.share
        g = np.bincount(self.column, d[self.owner], self.n_features) + self.ridge * w
        if self.pairs:
            change = np.bincount(self.p_owner, self.p_sign * w[self.p_column], len(self.pairs))
            loss += float(self.counterfactual * (self.p_share * change**2).sum())
            g += self.counterfactual * 2 * np.bincount(self.p_column, self.p_sign * (self.p_share * change)[self.p_owner], self.n_features)
        return loss, np.append(g, d.sum())


def train(objective: Objective, steps: int = 400, rate: float = 0.08) -> tuple[np.ndarray, float]:
    """Weights and level that make the objective small: Adam with a falling rate from zero."""
    at = np.zeros(objective.n_features + 1)
    m, v = np.zeros_like(at), np.zeros_like(at)
    for t in range(1, steps + 1):
        _, g = objective(at[:-1], at[-1])
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        at -= rate * (1 - 0.9 * t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return at[:-1], float(at[-1])


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, "text"):
        own = [sorted(set(words(t))) for t in common.texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(own, pa.list_(pa.string()))], ["y", "words"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], []]
        for word, pos, neg in zip(*(batch.column(c).to_pylist() for c in ("word", "pos", "neg")), strict=True):
            for f in features_of(word):
                out[0].append(f)
                out[1].append(pos)
                out[2].append(neg)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["feature", "pos", "neg"])


def swaps(sentence: list[str], each: int = 4) -> Iterator[tuple[str, str]]:
    """(term, other term) for the identity terms of a sentence: `each` others of the same kind, by position in the list after it."""
    for kind in IDENTITY_TERMS:
        for w in sorted(set(sentence) & set(kind)):
            i = kind.index(w)
            for k in range(1, min(each, len(kind) - 1) + 1):
                yield w, kind[(i + k) % len(kind)]


def mention(sentence: list[str]) -> str:
    """The term that is put into a sentence without one."""
    h = zlib.crc32(" ".join(sentence).encode())
    kind = IDENTITY_TERMS[h % len(IDENTITY_TERMS)]
    return kind[h // len(IDENTITY_TERMS) % len(kind)]


def pairs_of(text: str, matcher: Matcher, alone: dict[str, set[int]]) -> Iterator[tuple[tuple, tuple]]:
    """(features gained, features lost) of each swap in each sentence of a text; alone: the features of each term by itself."""
    for sentence in _SENTENCE.findall(text):
        ws = words(sentence)
        if not ws:
            continue
        named = not alone.keys().isdisjoint(ws)
        for a, b in swaps(ws if named else [mention(ws)]):
            if alone[a] != alone[b]:
                rest = matcher.find([w for w in ws if w != a])
                gained, lost = alone[b] - alone[a] - rest, alone[a] - alone[b] - rest
                if gained or lost:
                    yield tuple(sorted(gained)), tuple(sorted(lost))


_ROWS = "y int, present array<int>, gained array<int>, lost array<int>, n long"


def _rows(batches: Iterator[pa.RecordBatch], chosen) -> Iterator[pa.RecordBatch]:
    """A row of each training document with its label and selected features; and of each pair with its number in the batch, y null."""
    matcher = Matcher(chosen.value)
    alone = {t: matcher.find([t]) for kind in IDENTITY_TERMS for t in kind}
    ints = pa.list_(pa.int32())
    for batch in common.slices(batches, "text"):
        texts, counted = common.texts(batch), Counter()
        for text in texts:
            counted.update(pairs_of(text, matcher, alone))
        pairs, none = list(counted), [None] * len(counted)
        present = [sorted(matcher.find(list(set(words(t))))) for t in texts]
        empty = [None] * len(texts)
        columns = [batch.column("y").to_pylist() + none, present + none, empty + [list(a) for a, _ in pairs], empty + [list(b) for _, b in pairs], empty + list(counted.values())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), ints, ints, ints, pa.int64()), strict=True)], [x.split()[0] for x in _ROWS.split(", ")])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, counterfactual: float = 1.0, certainty: float = 3.0) -> Model:
    """Train on at most `sample` labelled documents whose fold is not held out; equal texts count once."""
    spark = docs.sparkSession
    rows = common.labelled_sample(docs, labels, "toxic", common.bucket_of("doc_id", FOLDS) == HELD_OUT, sample)
    rows = common.materialise(rows.groupBy("text").agg(F.max("y").alias("y")), "toxic-sample")
    totals = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return Model([], [], None)
    counted = rows.mapInArrow(_distinct_words, "y int, words array<string>").select("y", F.explode("words").alias("word")).groupBy("word").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    grams = counted.mapInArrow(_grams, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    pos, neg = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(pos / (totals[1] + 1)) - F.log(neg / (totals[0] + 1))
    sure = F.round(odds - certainty * F.sqrt(1 / pos + 1 / neg), 9)
    best = grams.withColumn("sure", sure).where("sure > 0").orderBy(F.desc("sure"), "feature").limit(features).collect()  # at most `features` rows
    names = [r.feature for r in best]
    chosen = spark.sparkContext.broadcast(names)
    got = common.materialise(rows.mapInArrow(partial(_rows, chosen=chosen), _ROWS), "toxic-rows")
    own = got.where("y IS NOT NULL").select("y", "present").toArrow().to_pylist()  # `sample` rows of selected features
    pairs = got.where("y IS NULL").groupBy("gained", "lost").agg(F.sum("n").alias("n")).toArrow().to_pylist()  # distinct parts of swapped terms' features
    own.sort(key=lambda r: (r["y"], r["present"]))
    pairs.sort(key=lambda r: (r["gained"], r["lost"]))
    seen = [(r["y"], np.array(r["present"], np.int64)) for r in own]
    swapped = [(np.array(r["gained"], np.int64), np.array(r["lost"], np.int64), r["n"]) for r in pairs]
    w, level = train(Objective(seen, swapped, len(names), counterfactual=counterfactual))
    return Model(names, w.tolist(), level)


def _score(batches: Iterator[pa.RecordBatch], model, column: str) -> Iterator[pa.RecordBatch]:
    common.forget_tables()
    own = model.value
    for batch in common.slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([own.score(t) for t in common.texts(batch)], pa.float64())], [*batch.schema.names, column])


def score(docs: DataFrame, model: Model, column: str = "toxic_score") -> DataFrame:
    """docs with a double column of scores; a column of that name is replaced."""
    docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(partial(_score, model=shared, column=column), T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier, trained on these documents' labels, does not call toxic, with all their columns."""
    own = common.free_name(docs, "score")
    return score(docs, fit(docs, labels), own).where(F.col(own) < threshold).drop(own)
