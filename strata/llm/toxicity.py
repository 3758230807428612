"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashed words, word pairs and pairs that skip one word, all of
the whole text. Per-coordinate learning rates and the L1 term of FTRL-proximal leave few weights
that are not zero; these (at most ``2 ** BITS``) are broadcast and scored where the texts are.

Training rows: labelled rows whose ``crc32(id as text) mod 5`` is not 0, of these about
``TRAIN_ROWS`` at most (a documented bound, chosen by a hash of id and text, so the same rows at any
partitioning; all rows where there are fewer). Rows equal in id and text are one training row. Their features are made in parallel; the updates,
which are sequential by nature, run in one task over that bounded sample.

Defined results: NULL and empty texts score by the bias alone; without usable labels, or with one
class only, the score is the share of label 1 (0.0 without labels); labels that are NULL or of
unknown documents are ignored, contradicting labels of one id count as 1; repeated rows are scored
alike; rows without an id are scored, not held out, and never trained on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, text_id, use_package

BITS = 20
TRAIN_ROWS = 16_384
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.0
FOLDS = 5

_WORD = re.compile(r"[^\W_]+")
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
#: Word hashes remembered per worker.
_REMEMBERED = 500_000


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        got = self[word] = zlib.crc32(word.encode("utf-8", "replace")) + 1
        return got


_HASHES = _Hashes()


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Hashed features of a text, with repeats."""
    words = _WORD.findall((text or "").lower())
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    one, two, skip, last = (np.uint64(x) for x in _ODD)
    grams = [h * one, (h[:-1] * two) ^ (h[1:] * one), (h[:-2] * skip) ^ (h[2:] * one)]
    mixed = np.concatenate(grams)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * last) >> np.uint64(64 - bits)).astype(np.int32)


class Ftrl:
    """FTRL-proximal with per-coordinate rates; the last coordinate is the bias, which has no L1."""

    def __init__(self, dim: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(dim + 1), np.zeros(dim + 1)

    def weights(self, at) -> np.ndarray:
        """Of ``at``, an array or slice that ends with the bias."""
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        shrunk[-1] = z[-1]
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        n = self.n[at]
        grown = np.sqrt(n + g * g)
        self.z[at] += g - (grown - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Indexes and values of the weights that are not zero, and the bias."""
    use_package(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y")).filter(~held_out(F.col("id")))
    order = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("tid", text_id(F.col("text")))
    # different rows, and the bound, after the join: an id may repeat with many texts
    chosen = cut(known.join(texts.select("id", "tid"), "id").distinct(), "toxicity-rows")
    n = chosen.count()
    if n > train_rows:
        chosen = chosen.filter(F.pmod(F.xxhash64("id", "tid", F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * train_rows / n))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "x": [np.unique(features(t)) for t in b["text"]], "o": b["o"]})

    found = texts.join(F.broadcast(chosen), ["id", "tid"]).dropDuplicates(["id", "tid"])
    rows = found.select("id", "y", "text", order.alias("o")).mapInPandas(hashed, "id long, y int, x array<int>, o long")
    rows = cut(rows, "toxicity-train")

    def train(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.assign(size=sample["x"].map(len)).sort_values(["o", "id", "size"])
        model, share = Ftrl(1 << BITS), sample["y"].mean()
        if 0 < share < 1:
            for _ in range(EPOCHS):
                for x, y in zip(sample["x"], sample["y"]):
                    model.learn(x, y)
            w = model.weights(slice(None))
        else:
            w = np.zeros((1 << BITS) + 1)
            w[-1] = 35.0 if share else -35.0
        at = np.flatnonzero(w)
        return pd.DataFrame({"at": at, "w": w[at]})

    weights = rows.groupBy().applyInPandas(train, "at int, w double").toPandas()  # at most 2 ** BITS + 1 rows
    at, w = weights["at"].to_numpy(np.int64), weights["w"].to_numpy(float)
    bias = float(w[at == 1 << BITS].sum()) if len(at) else -35.0
    inner = at < 1 << BITS
    return at[inner], w[inner], bias


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text_col: str = "text") -> DataFrame:
    """``docs`` as the struct ``doc`` without its text, with ``score``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("doc"), scorer(docs, model)(F.col(text_col)).alias("score"))


def scorer(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]):
    """A vectorised function text -> score between 0 and 1 with the broadcast weights of ``model``."""
    use_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, values, bias = shared.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = values
        for texts in batches:
            out = np.empty(len(texts))
            for i, text in enumerate(texts):
                x = features(text)
                x = np.unique(x[dense[x] != 0])
                out[i] = bias + dense[x].sum(dtype=float)
            yield pd.Series(sigmoid(out))

    return of
