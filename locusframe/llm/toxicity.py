"""Toxicity by a learned, weighted lexicon.

Texts are folded (case, look-alike letters, digits that stand for letters), the lexicon is matched
by one Aho-Corasick automaton over the whole text, matches inside exception phrases do not count, and
the summed weights are normalised by the length of the text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of other scripts and the Latin letters they look like, and signs that stand for letters.
LOOK_ALIKES = str.maketrans({
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ⅼ": "l",
})
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "$": "s", "@": "a"})
_other = re.compile("[ıɡα-ωа-јⅠ-ⅿ！-～​-‍­]")
_unseen = re.compile("[​-‍­]")
_signs = re.compile(r"[0-9$@]+")
_words = re.compile(r"[^\W_]+")


def fold(text: str | None) -> str:
    """Lower case, look-alikes to Latin letters, and signs to letters where they touch a letter."""
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _unseen.sub("", text)).lower()
        if _other.search(text):
            text = text.translate(LOOK_ALIKES)

    def letters(m: re.Match) -> str:
        a, b = m.span()
        return m[0].translate(SIGNS) if (a and text[a - 1].isalpha()) or (b < len(text) and text[b].isalpha()) else m[0]

    return _signs.sub(letters, text)


@dataclass
class Lexicon:
    """Entries (text, is whole word) with weights, exception phrases, and the calibration of the score."""

    weights: dict[tuple[str, bool], float]
    exceptions: tuple[str, ...] = ()
    slope: float = 1.0
    intercept: float = 0.0
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            a, entries = ahocorasick.Automaton(), {}
            for (text, whole), w in self.weights.items():
                entries.setdefault(text, []).append((w, whole))
            for phrase in self.exceptions:
                entries.setdefault(phrase, []).append((None, True))
            for text, found in entries.items():
                a.add_word(text, (len(text), found))
            if entries:
                a.make_automaton()
            self._automaton = a
        return self._automaton

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of entries at word starts (whole ones also at word ends) outside exception phrases."""
        if not len(self.automaton()):
            return []
        hits, free = [], []
        for last, (n, found) in self.automaton().iter(folded):
            a, b = last - n + 1, last + 1
            if a and folded[a - 1].isalnum():
                continue
            ends = b == len(folded) or not folded[b].isalnum()
            for w, whole in found:
                if whole and not ends:
                    continue
                (free if w is None else hits).append((a, b, w))
        return [h for h in hits if not any(x <= h[0] and h[1] <= y for x, y, _ in free)] if free else hits

    def strength(self, text: str | None) -> float:
        folded = fold(text)
        total = sum(w for _, _, w in self.matches(folded))
        words = folded.count(" ") + folded.count("\n") + 1
        return math.log1p(10 * total / math.sqrt(words + 20)) if total > 0 else 0.0

    def score(self, text: str | None) -> float:
        return float(1 / (1 + math.exp(-np.clip(self.slope * self.strength(text) + self.intercept, -30, 30))))


def features(text: str | None, prefixes: range) -> set[tuple[str, bool]]:
    """Lexicon entries a text offers: its words, and the beginnings of longer words."""
    words = {w for w in _words.findall(fold(text)) if not w.isdigit() and len(w) >= prefixes.start}
    out = {(w, True) for w in words}
    for n in prefixes:
        out |= {(w[:n], False) for w in words if len(w) > n}
    return out


def _draw(labels: DataFrame, per_class: int, seed: int) -> tuple[DataFrame, dict[int, int]]:
    labels = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("label").cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    counts = {r["_y"]: r["count"] for r in labels.groupBy("_y").count().collect()}
    scale = 1_000_000_000
    keep = F.lit(False)
    for y, n in counts.items():
        keep = keep | ((F.col("_y") == y) & (F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(scale)) < int(scale * min(1.0, per_class / n))))
    return labels.where(keep), counts


def train_lexicon(docs: DataFrame, labels: DataFrame, per_class: int = 4000, min_docs: int = 4, min_log_odds: float = 2.0, min_g2: float = 15.0, prefixes: range = range(4, 8),
                  max_entries: int = 20_000, max_phrases: int = 1000, exceptions: tuple[str, ...] = (), seed: int = 23) -> Lexicon:
    """Learn entries, weights, exception phrases and calibration from labelled documents.

    ``docs`` (doc_id, text), ``labels`` (doc_id, label 0 or 1). About ``per_class`` rows of each class are drawn by a seeded hash
    of the id; the drawn labels are what is broadcast. An entry needs ``min_docs`` toxic documents, a log odds ratio of
    ``min_log_odds`` and a log-likelihood ratio of ``min_g2``, which keeps chance finds out; an exception phrase needs three
    different clean texts and significantly more of them than of toxic ones; a beginning of words replaces the entries it starts. The model is bounded: words shorter than the first of ``prefixes`` are no
    entries, the ``max_entries`` candidates in most toxic documents are weighed, the ``max_phrases`` in most clean texts are exceptions, and the word behind a
    hit is looked for in 80 characters. ``exceptions`` are phrases known beforehand. Without both classes the
    lexicon is empty and every score is the share of toxic labels.
    """
    drawn, counts = _draw(labels, per_class, seed)
    total = sum(counts.values())
    prior = (counts.get(1, 0) + 0.5) / (total + 1)
    if len(counts) < 2:
        return Lexicon({}, exceptions, 0.0, math.log(prior / (1 - prior)))
    sample = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text")).join(F.broadcast(drawn), "_id").select("text", "_y")

    def count(batches):
        toxic, clean = Counter(), Counter()
        n = [0, 0]
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["_y"]):
                (toxic if y else clean).update(features(text, prefixes))
                n[y] += 1
        keys = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"entry": [k[0] for k in keys] + [""], "whole": [k[1] for k in keys] + [True],
                            "toxic": [toxic[k] for k in keys] + [n[1]], "clean": [clean[k] for k in keys] + [n[0]]})

    table = sample.mapInPandas(count, "entry string, whole boolean, toxic bigint, clean bigint").groupBy("entry", "whole").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    table = table.where((F.col("toxic") >= min_docs) & ((F.col("toxic") >= 4 * F.col("clean")) | (F.col("entry") == ""))).orderBy(F.desc("toxic"), "entry", "whole").limit(max_entries + 1)
    rows = [(r["entry"], r["whole"], r["toxic"], r["clean"]) for r in table.collect()]
    n1, n0 = next(((t, c) for e, _, t, c in rows if e == ""), (1, 1))
    odds = lambda t, c: math.log((t + 0.5) / (n1 + 1)) - math.log((c + 0.5) / (n0 + 1))

    def g2(t: int, c: int) -> float:
        share = n1 / (n1 + n0)
        return 2 * sum(k * math.log(k / ((t + c) * p)) for k, p in ((t, share), (c, 1 - share)) if k)

    weights: dict[tuple[str, bool], float] = {}
    for entry, whole, t, c in sorted((r for r in rows if r[0]), key=lambda r: (len(r[0]), r[1], r[0])):
        w = odds(t, c)
        if w >= min_log_odds and g2(t, c) >= min_g2 and not any(weights.get((entry[:n], False), 0) >= w - 1 or (c == 0 and (entry[:n], False) in weights) for n in range(1, len(entry) + 1)):
            weights[entry, whole] = w
    lexicon = Lexicon(weights, exceptions)

    def phrases(batches):
        for pdf in batches:
            found = set()
            for text, y, doc in zip(pdf["text"], pdf["_y"], pdf["_doc"]):
                folded = fold(text)
                for a, b, _ in lexicon.matches(folded):
                    tail = re.match(r"[^\W_]*\W+[^\W_]+", folded[b : b + 80])
                    if tail:
                        found.add((folded[a:b] + tail[0], int(y), int(doc)))
            yield pd.DataFrame(list(found), columns=["phrase", "y", "doc"]).astype({"phrase": object, "y": np.int64, "doc": np.int64})

    learned = sample.withColumn("_doc", F.xxhash64("text")).mapInPandas(phrases, "phrase string, y bigint, doc bigint").distinct().groupBy("phrase").agg(
        F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean")).where("clean >= 3").orderBy(F.desc("clean"), "phrase").limit(max_phrases).collect()
    learned = [r for r in learned if r["clean"] * n1 > r["toxic"] * n0 and g2(r["toxic"], r["clean"]) >= 3.84]
    lexicon.exceptions = tuple(dict.fromkeys((*exceptions, *(r["phrase"] for r in learned))))
    lexicon._automaton = None

    def strengths(batches):
        for pdf in batches:
            yield pd.DataFrame({"x": [lexicon.strength(t) for t in pdf["text"]], "y": pdf["_y"]})

    points = sample.mapInPandas(strengths, "x double, y int").groupBy("x", "y").count().toPandas().sort_values(["x", "y"])
    lexicon.slope, lexicon.intercept = calibrate(points["x"].to_numpy(), points["y"].to_numpy(), prior, points["count"].to_numpy())
    return lexicon


def calibrate(x: np.ndarray, y: np.ndarray, prior: float, copies: np.ndarray, penalty: float = 0.05, steps: int = 60) -> tuple[float, float]:
    """Logistic curve of the strength (points with their number of rows), classes weighted to their shares among all labels."""
    if not len(x):
        return 0.0, math.log(prior / (1 - prior))
    toxic = np.average(y == 1, weights=copies)
    weight = copies * np.where(y == 1, prior / max(toxic, 1e-9), (1 - prior) / max(1 - toxic, 1e-9))
    a = np.stack([x, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + penalty * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + penalty * np.eye(2)
        w -= np.linalg.solve(hess, grad)
    return float(max(w[0], 0.0)), float(w[1])


def score_texts(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on) from whole texts; null and empty ones have no match.

    Repeated rows get equal results; columns of the input with the added names are replaced.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series([own.score(t) for t in texts], dtype=float)

    return docs.withColumn("score", score(F.col(text_col))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
