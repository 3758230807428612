"""The toxicity classifier against plain loops over a dictionary of weights."""

import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from strata.llm import toxicity


def naive_features(text, bits):
    words = [zlib.crc32(w.encode("utf-8", "replace")) + 1 for w in re.findall(r"[^\W_]+", (text or "").lower())]
    one, two, skip, last = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93
    mixed = [w * one for w in words]
    mixed += [(a * two % 2**64) ^ (b * one % 2**64) for a, b in zip(words, words[1:])]
    mixed += [(a * skip % 2**64) ^ (b * one % 2**64) for a, b in zip(words, words[2:])]
    return {((m ^ m >> 29) * last % 2**64) >> 64 - bits for m in (m % 2**64 for m in mixed)}


class NaiveFtrl:
    def __init__(self, alpha, beta, l1, l2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = defaultdict(float), defaultdict(float)

    def weight(self, i):
        l1 = 0.0 if i == "bias" else self.l1
        z = self.z[i]
        if abs(z) <= l1:
            return 0.0
        return -(z - math.copysign(l1, z)) / ((self.beta + math.sqrt(self.n[i])) / self.alpha + self.l2)

    def learn(self, found, label):
        found = [*sorted(found), "bias"]
        w = {i: self.weight(i) for i in found}
        g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
        for i in found:
            sigma = (math.sqrt(self.n[i] + g * g) - math.sqrt(self.n[i])) / self.alpha
            self.z[i] += g - sigma * w[i]
            self.n[i] += g * g


def test_features_equal_plain_loops():
    for text in ("One two, three two ONE", "", None, "a", "é_b c\ud83d 1", "x " * 50):
        assert set(toxicity.features(text, 20).tolist()) == naive_features(text, 20)


def test_ftrl_equals_plain_loops():
    r = random.Random(3)
    for alpha, beta, l1, l2 in ((2.0, 1.0, 6.0, 0.0), (0.3, 1.0, 0.5, 0.1)):
        fast, slow = toxicity.Ftrl(64, alpha, beta, l1, l2), NaiveFtrl(alpha, beta, l1, l2)
        for _ in range(600):
            found = r.sample(range(64), r.randint(0, 12))
            label = int(bool({1, 2} & set(found)) != (r.random() < 0.1))
            fast.learn(np.array(sorted(found), np.int64), label)
            slow.learn(found, label)
        want = [slow.weight(i) for i in range(64)] + [slow.weight("bias")]
        assert np.allclose(fast.weights(slice(None)), want, rtol=1e-9, atol=1e-12)
        assert any(w == 0 for w in want[:-1]) or l1 < 1


def test_fit_equals_plain_loops_over_the_training_rows(spark):
    """The whole fit: rows outside the held-out fold, in the order of their hash, four passes."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(r.choices(words, k=r.randint(3, 12)) + (["vile", "slur"] if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    at, values, bias = toxicity.fit(docs, labels)
    order = {x.doc_id: x.o for x in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)).alias("o")).collect()}
    train = sorted((x for x in rows if zlib.crc32(str(x[0]).encode()) % toxicity.FOLDS), key=lambda x: (order[x[0]], x[0]))
    model = NaiveFtrl(toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    for _ in range(toxicity.EPOCHS):
        for _, text, y in train:
            model.learn(naive_features(text, toxicity.BITS), y)
    want = {i: w for i in model.z if i != "bias" and (w := model.weight(i))}
    assert dict(zip(at.tolist(), values.tolist())).keys() == want.keys() and want
    assert all(abs(v - want[i]) < 1e-9 for i, v in zip(at.tolist(), values.tolist())) and abs(bias - model.weight("bias")) < 1e-9
    scores = {x.doc.doc_id: x.score for x in toxicity.score(docs, (at, values, bias)).collect()}
    for i, text, _ in rows[:40]:
        z = bias + sum(want.get(f, 0.0) for f in naive_features(text, toxicity.BITS))
        assert abs(scores[i] - 1 / (1 + math.exp(-max(-35, min(35, z))))) < 1e-5
