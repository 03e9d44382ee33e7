"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence that holds evidence has a logistic score; a noisy-or of them
with a leak is the document's score, and only document labels train it.  The trained sentence scores then
locate the offending sentences.  Evidence is the word itself and the character runs of 4 to 6 within its marked
form, so that unseen inflections of a known stem count.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_of, released, slices

#: The fit reads at most so many labelled documents of each class, lowest seeded hash first.
FIT_DOCS = 4000
#: Features kept for the fit: the strongest by likelihood ratio, above a least value.
FEATURES, LEAST_G2, LEAST_DF = 4096, 18.0, 3
STEPS, RATE, RIDGE = 250, 0.1, 2e-4
SENTENCE = re.compile(r"[^.!?\n]+")
TOKEN = re.compile(r"[^\W_]+")


def word_features(word: str) -> list[str]:
    marked = f"^{word}$"
    return [f"={word}", *(marked[i : i + n] for n in (4, 5, 6) for i in range(len(marked) - n + 1))]


def log_odds_g2(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Likelihood ratio of presence against class, signed by direction."""
    a, b = toxic.astype(float), clean.astype(float)
    c, d = n_toxic - a, n_clean - b
    n = n_toxic + n_clean

    def term(x: np.ndarray, row: np.ndarray, column: float) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-12) * n / np.maximum(row * column, 1e-12))

    g2 = 2 * (term(a, a + b, n_toxic) + term(b, a + b, n_clean) + term(c, c + d, n_toxic) + term(d, c + d, n_clean))
    return np.where(a / max(n_toxic, 1) >= b / max(n_clean, 1), g2, -g2)


def train(texts: list[str], labels: list[int], shares: tuple[float, float] | None = None) -> dict[str, float]:
    """Weights by feature; `bias` and `leak` under their own names.  Empty without both classes.

    shares are those of clean and toxic among all labelled documents, where texts are a sample of other shares:
    a document weighs its class's share over its share here, so bias and leak do not depend on the sample's size.
    """
    y = np.array(labels, np.int8)
    if not len(y) or y.min() == y.max():
        return {"bias": -10.0, "leak": float(min(0.4, y.mean())) if len(y) else 0.0}
    ids: dict[str, int] = {}
    known: dict[str, np.ndarray] = {}
    counts = np.zeros((2, 1 << 16), np.int32)
    for text, label in zip(texts, y, strict=True):
        found = []
        for w in set(TOKEN.findall(text.lower())):
            if (f := known.get(w)) is None:
                f = np.fromiter((ids.setdefault(x, len(ids)) for x in word_features(w)), np.int32)
                if len(known) < 200_000:
                    known[w] = f
            found.append(f)
        if found:
            at = np.unique(np.concatenate(found))
            while len(ids) > counts.shape[1]:
                counts = np.pad(counts, ((0, 0), (0, counts.shape[1])))
            counts[label][at] += 1
    counts = counts[:, : len(ids)]
    g2 = log_odds_g2(counts[1], counts[0], int(y.sum()), int((1 - y).sum()))
    strong = np.abs(g2) >= LEAST_G2
    strong &= counts.sum(axis=0) >= LEAST_DF
    best = np.argsort(-np.abs(g2) * strong, kind="stable")[: min(FEATURES, int(strong.sum()))]
    place = {int(f): i for i, f in enumerate(best)}
    names = [""] * len(best)
    for name, f in ids.items():
        if f in place:
            names[place[f]] = name
    chosen = {n: i for i, n in enumerate(names)}
    ids.clear()
    known.clear()
    rows, cols, docs, n_sentences = [], [], [], 0
    for k, text in enumerate(texts):
        for sentence in SENTENCE.findall(text.lower()):
            held = {chosen[f] for w in TOKEN.findall(sentence) for f in word_features(w) if f in chosen}
            if held:
                rows += [n_sentences] * len(held)
                cols += sorted(held)
                docs.append(k)
                n_sentences += 1
    row, col, doc = np.array(rows, np.int64), np.array(cols, np.int64), np.array(docs, np.int64)
    n, m = len(texts), len(names)
    weight = np.ones(n) if shares is None else np.array([shares[v] / (y == v).mean() for v in (0, 1)])[y]
    w, b, leak = np.zeros(m), -2.0, -5.0
    first, second = np.zeros(m + 2), np.zeros(m + 2)
    rest = 1e-9
    for step in range(1, STEPS + 1):
        z = np.clip(b + np.bincount(row, w[col], n_sentences), -30, 30)
        p = 1 / (1 + np.exp(-z))
        leaked = 1 / (1 + np.exp(-leak))
        clear = np.log1p(-leaked) + np.bincount(doc, np.log1p(-np.minimum(p, 1 - rest)), n)
        none = np.exp(clear)
        pull = weight * np.where(y == 1, -none / np.maximum(1 - none, 1e-6), 1.0)
        g = pull[doc] * p
        grad = np.concatenate([np.bincount(col, g[row], m), [g.sum(), (pull * leaked).sum()]]) / n
        grad[:m] += RIDGE * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b, leak = w - move[:m], b - move[m], min(leak - move[m + 1], -1.0)
    return {"bias": float(b), "leak": float(1 / (1 + np.exp(-leak)))} | dict(zip(names, w.tolist(), strict=True))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_docs: int = FIT_DOCS) -> dict[str, float]:
    """Train on at most `fit_docs` labelled documents of each class, in one executor task; returns at most `FEATURES` weights.

    Labels that are null or whose document is missing are not used; of several labels of one id the highest counts,
    of several texts of one id the least.  Classes weigh as among all labels.
    """
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).dropna().groupBy("__id").agg(F.max("__y").alias("__y"))
    order = F.xxhash64(F.lit(5), "__id")
    counted = {r["__y"]: r["n"] for r in known.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).filter("__y in (0, 1)").collect()}  # two rows
    total = sum(counted.values())
    shares = tuple(counted.get(v, 0) / total for v in (0, 1)) if len(counted) == 2 else None
    picked = [known.filter(F.col("__y") == v).orderBy(order, "__id").limit(fit_docs) for v in (0, 1)]
    sample = docs.select(F.col(id_col).alias("__id"), F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(picked[0].union(picked[1])), "__id")
    # one text an id, reduced before it is dealt: an id that many rows share is one row of the sample
    sample = sample.groupBy("__id").agg(F.min("text").alias("text"), F.max("__y").alias("__y"))

    @released
    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([b.assign(text=b["text"].fillna("")) for b in batches] or [pd.DataFrame({"__id": [], "text": [], "__y": []})])
        rows = rows.sort_values(["__id", "text"])
        model = train(rows["text"].tolist(), rows["__y"].tolist(), shares)
        yield pd.DataFrame({"feature": list(model), "weight": list(model.values())})

    fitted = {r["feature"]: r["weight"] for r in sample.repartition(1).mapInPandas(fit, "feature string, weight double").collect()}
    return fitted or train([], [])  # without a labelled document no task may run


class SentenceScorer:
    """Scores of texts and spans of their sentences, with a bounded table of word weights."""

    def __init__(self, model: dict[str, float]):
        self.bias, self.leak = model["bias"], model["leak"]
        self.model = {k: v for k, v in model.items() if k not in ("bias", "leak")}
        self.starts = {f[:4] for f in self.model if f[0] != "="}
        self.words: dict[str, tuple[str, ...]] = {}

    def evidence(self, word: str) -> tuple[str, ...]:
        """The model's features of a word; every character run of a feature starts with one of their first four characters."""
        marked = f"^{word}$"
        if "=" + word in self.model or any(marked[i : i + 4] in self.starts for i in range(len(marked) - 3)):
            return tuple(f for f in word_features(word) if f in self.model)
        return ()

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The text's score, and (start, end, probability) in characters of every sentence with evidence."""
        lowered = text.lower()
        if len(lowered) != len(text):  # some characters lower to two; spans are of the text itself
            lowered = "".join(c.lower()[:1] for c in text)
        words = set(TOKEN.findall(lowered))
        if len(self.words) > 200_000:
            self.words.clear()
        known = self.words
        for w in words:
            if w not in known:
                known[w] = self.evidence(w)
        evident = {w for w in words if known[w]}
        clear, found = 1.0 - self.leak, []
        for m in SENTENCE.finditer(lowered) if evident else ():
            if hits := evident.intersection(TOKEN.findall(m[0])):
                z = self.bias + sum(self.model[f] for f in sorted({f for w in hits for f in known[w]}))
                p = 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))
                found.append((m.start(), m.end(), p))
                clear *= 1.0 - p
        return 1.0 - clear, found


def score_toxicity(docs: DataFrame, model: dict[str, float], id_col: str = "doc_id", text_col: str = "text", offending: float = 0.5) -> DataFrame:
    """All columns of docs plus toxicity (0 to 1) and offending, the sentences of at least `offending`: start, end (characters), score.

    Null and empty texts score the leak.  Only the text enters a score, so equal texts score alike; an input
    column named toxicity or offending is replaced.  No shuffle; the model is bounded and travels with the task.
    """
    docs = docs.drop("toxicity", "offending")
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = SentenceScorer(model)
        for part in slices(batches, text_col):
            found = [scorer.score(t or "") for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
            scores = pa.array([s for s, _ in found], pa.float64())
            bad = pa.array([[{"start": a, "end": b, "score": p} for a, b, p in x if p >= offending] for _, x in found], spans)
            yield pa.RecordBatch.from_arrays([*part.columns, scores, bad], [*part.schema.names, "toxicity", "offending"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, toxicity double, offending array<struct<start:int,end:int,score:double>>")


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return crc32_of(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5
