"""Language identification with a string kernel.

The blended spectrum kernel of presence bits counts the character n-grams, n from 1 to ``n_max``,
that two texts share; it is normalised to 1 for equal texts. Nystrom landmarks, drawn evenly from the
learned languages, turn it into vectors, and one ridge regression per language (one versus the rest) scores
them. A batch of texts is scored by two matrix products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import free_names

UNKNOWN = "und"


def grams(text: str, n_max: int) -> np.ndarray:
    """Distinct hashed character n-grams of a text, lower-cased, white space and digits as one sign each."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[(codes < 33)] = 32
    codes[(codes >= 48) & (codes <= 57)] = 48
    out, h = [], None
    for n in range(1, n_max + 1):
        if len(codes) < n:
            break
        h = codes + np.uint64(1) if h is None else h[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(1)
        x = h * np.uint64(0x9E3779B97F4A7C15)
        out.append(((x ^ (x >> np.uint64(32))) & np.uint64(0xFFFFFFF)) * np.uint64(8) + np.uint64(n))
    return _distinct(np.concatenate(out)) if out else np.empty(0, np.uint64)


def _distinct(x: np.ndarray) -> np.ndarray:
    x.sort()
    return x[np.concatenate(([True], x[1:] != x[:-1]))]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class KernelModel:
    """Landmark n-grams (``vocabulary`` by ``landmarks`` presence matrix), their sizes, and weights per language."""

    languages: list[str]
    n_max: int
    vocabulary: np.ndarray
    presence: np.ndarray
    norms: np.ndarray
    weights: np.ndarray
    #: Least share of known n-grams that speaks for one of the languages.
    least_known: float = 0.0

    def kernel(self, sets: list[np.ndarray], known: np.ndarray | None = None) -> np.ndarray:
        """Kernel values to all landmarks; ``known`` receives the share of each text's n-grams that some landmark holds."""
        bits = np.zeros((len(sets), len(self.vocabulary)), np.float32)
        for i, s in enumerate(sets):
            at = np.searchsorted(self.vocabulary, s)
            at[at == len(self.vocabulary)] = 0
            found = self.vocabulary[at] == s
            bits[i, at[found]] = 1
            if known is not None:
                known[i] = found.mean() if len(s) else 0.0
        own = np.sqrt(np.maximum([len(s) for s in sets], 1)).astype(np.float32)
        return (bits @ self.presence) / own[:, None] / self.norms[None, :]

    def scores(self, sets: list[np.ndarray], known: np.ndarray | None = None) -> np.ndarray:
        return self.kernel(sets, known) @ self.weights[:-1] + self.weights[-1]

    def predict(self, texts: list[str | None], step: int = 64) -> tuple[list[str], np.ndarray, np.ndarray]:
        langs, scores, known = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        for a in range(0, len(rows), step):
            part = rows[a : a + step]
            own = np.zeros(len(part))
            s = self.scores([grams(texts[i], self.n_max) for i in part], own)
            best = s.argmax(axis=1)
            known[part] = own
            for i, b, row in zip(part, best, s):
                langs[i], scores[i] = self.languages[b], float(np.clip(row[b], 0.0, 1.0))
        return langs, scores, known


def fit_kernel(sets: list[np.ndarray], labels: list[str], n_max: int, landmarks_per_language: int, ridge: float, seed: int = 3) -> KernelModel:
    """Nystrom features from landmarks of each language, then ridge regression onto one indicator per language.

    The landmark map K_LL^(-1/2) is folded into the weights, which act on kernel values directly. ``least_known`` is half of what
    99 of 100 labelled texts that are no landmarks reach; without such texts it is 0.
    """
    languages = sorted(set(labels))
    if not languages:
        return KernelModel([], n_max, np.zeros(1, np.uint64), np.zeros((1, 1), np.float32), np.ones(1, np.float32), np.zeros((2, 1)))
    rng = np.random.default_rng(seed)
    y = np.array(labels)
    chosen = []
    for lang in languages:
        own = np.flatnonzero(y == lang)
        chosen += sorted(rng.permutation(own)[:landmarks_per_language].tolist())
    vocabulary = np.unique(np.concatenate([sets[i] for i in chosen]))
    presence = np.zeros((len(vocabulary), len(chosen)), np.float32)
    for k, i in enumerate(chosen):
        presence[np.searchsorted(vocabulary, sets[i]), k] = 1
    model = KernelModel(languages, n_max, vocabulary, presence, np.sqrt(np.maximum(presence.sum(axis=0), 1)), np.zeros((len(chosen) + 1, len(languages))))
    known = np.zeros(len(sets))
    k_rows = np.concatenate([model.kernel(sets[a : a + 64], known[a : a + 64]) for a in range(0, len(sets), 64)]).astype(np.float64)
    others = np.delete(known, chosen)
    model.least_known = float(np.quantile(others, 0.01) / 2) if len(others) else 0.0
    values, vectors = np.linalg.eigh(k_rows[chosen])
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    features = np.hstack([k_rows @ root, np.ones((len(sets), 1))])
    targets = (y[:, None] == np.array(languages)[None, :]).astype(float)
    balance = np.array([1.0 / (y == lang).sum() for lang in languages])[np.searchsorted(languages, y)] * len(y) / len(languages)
    penalty = ridge * np.eye(features.shape[1])
    penalty[-1, -1] = 0
    w = np.linalg.solve(features.T @ (features * balance[:, None]) + penalty, features.T @ (targets * balance[:, None]))
    model.weights = np.vstack([root @ w[:-1], w[-1:]])
    return model


def train_language_model(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", n_max: int = 3, per_language: int = 250,
                         landmarks_per_language: int = 32, ridge: float = 0.3, seed: int = 11) -> KernelModel:
    """Fit on about ``per_language`` texts of each language, drawn by a seeded hash of the text; copies of a drawn text count once.

    Rows without a language or a letter are not learned from. The model holds a column for each language, so these must be few.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    scale = 1_000_000_000
    bounds = [F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, int(scale * min(1.0, per_language / n)))]
    bound = F.try_element_at(F.create_map(*bounds) if bounds else F.create_map().cast("map<string,int>"), F.col("lang"))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(scale)) < bound).distinct()

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"lang": pdf["lang"], "grams": [grams(t, n_max).view(np.int64) for t in pdf["text"]]})

    drawn = drawn.mapInPandas(run, "lang string, grams array<bigint>").collect()
    drawn.sort(key=lambda r: (r["lang"], r["grams"][:8], len(r["grams"])))
    sets = [np.array(r["grams"], np.int64).view(np.uint64) for r in drawn]
    return fit_kernel(sets, [r["lang"] for r in drawn], n_max, landmarks_per_language, ridge, seed)


def identify(docs: DataFrame, model: KernelModel, text_col: str = "text", step: int = 64) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``known`` (0 to 1) from whole texts, however long; ``known`` is the share of n-grams that some landmark holds.

    Null texts and texts without a letter get ``und`` and score 0, as does everything when no language was learned.
    Repeated rows get equal results; columns of the input with the added names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "known")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, known double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, scores, known = shared.value.predict(texts.tolist(), step)
        return pd.DataFrame({"lang_pred": langs, "score": scores, "known": known})

    found = free_names(docs, "_p")[0]
    return docs.withColumn(found, predict(F.col(text_col))).select(*[F.col(f"`{c}`") for c in docs.columns], f"{found}.lang_pred", f"{found}.score", f"{found}.known")
