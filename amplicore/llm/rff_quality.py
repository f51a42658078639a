"""Quality classifier (operator 10).

Method: each whole text becomes a few dozen document statistics (shares of kinds of characters, word and line measures).
Random Fourier features of the standardised statistics approximate a Gaussian kernel; ridge weights solve normal equations
summed by partition; isotonic regression on rows kept out of the fit turns ridge scores into probabilities.

Training reads a bounded sample of labelled rows: about ``max_rows``, by a stable hash of the id, each with its whole text.

A null text counts as empty; an empty text has statistics too (zeros) and gets a score like any other. Without labels, or
with one class only, every score is the share of ones among the labels (0.5 without any). A row labelled twice counts
twice; equal texts get equal scores; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.llm._common import arrow_pass, built, crc_mod, ship, stored, table, unit_hash

SEED = 23
#: Characters whose share is a statistic of its own.
MARKS = b".,;:!?|*$%&#\"'-/<>{}[]()=_@~+\\"
#: All statistics: shares of classes and marks, word measures, line measures.
N_STATS = 7 + len(MARKS) + 9 + 5
_CLASS = np.zeros((256, 7))
for _b in range(256):
    _CLASS[_b, 0 if 97 <= _b <= 122 else 1 if 65 <= _b <= 90 else 2 if 48 <= _b <= 57 else 3 if _b == 10 else 4 if _b <= 32 else 5 if _b >= 128 else 6] = 1
_MARK_AT = np.frombuffer(MARKS, np.uint8)


def statistics(text: str | None) -> np.ndarray:
    out = np.zeros(N_STATS)
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    out[:7] = np.sqrt(hist @ _CLASS)
    out[7 : 7 + len(MARKS)] = np.sqrt(hist[_MARK_AT])
    k = 7 + len(MARKS)
    words = raw.split()
    if words:
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        kinds = set(words)
        out[k : k + 9] = (np.log1p(n), lengths.mean(), lengths.std(), np.log1p(lengths.max()), len(kinds) / n, n / (len(kinds) + 1.0) ** 0.9 / 4, (lengths <= 3).mean(), (lengths >= 12).mean(), sum(map(bytes.isupper, words)) / n)
    k += 9
    lines = [x for x in raw.split(b"\n") if x.strip()]
    if lines:
        n = len(lines)
        lengths = np.fromiter(map(len, lines), np.int64, n)
        out[k : k + 5] = (np.log1p(n), np.log1p(lengths.mean()), np.log1p(lengths.max()), len(set(lines)) / n, sum(x[-1] in b".!?" for x in lines) / n)
    return out


def with_statistics(docs: DataFrame, carry: list[Column], text_col: str = "text") -> DataFrame:
    rows = docs.select(*carry, F.col(text_col).alias("__text"))

    def run(part: dict[str, list]) -> dict[str, list]:
        return {"stats": [statistics(t) for t in part.pop("__text")]} | part

    kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text")
    return arrow_pass(rows, run, "stats array<double>" + kept)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best non-decreasing fit, by pooling neighbours that go down. Equal x count as one point."""
    xs, row = np.unique(x, return_inverse=True)
    weight = np.bincount(row).astype(float)
    mean = np.bincount(row, weights=y) / weight
    pools: list[list[float]] = []  # mean, weight, first x, last x
    for at, m, w in zip(xs, mean, weight, strict=True):
        pools.append([m, w, at, at])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m2, w2, _, end = pools.pop()
            m1, w1, begin, _ = pools.pop()
            pools.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, begin, end])
    # a pool's ends carry its mean, pulled a little to one half so that small pools don't claim certainty
    knots, values = [], []
    for m, w, begin, end in pools:
        v = (m * w + 0.5) / (w + 1)
        knots += [begin, end] if end > begin else [begin]
        values += [v, v] if end > begin else [v]
    return np.array(knots), np.maximum.accumulate(values)


class Model:
    def __init__(self, mean, scale, omega, phase, weights, knots, values) -> None:
        self.mean, self.scale, self.omega, self.phase = mean, scale, omega, phase
        self.weights, self.knots, self.values = weights, knots, values

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([np.cos(z @ self.omega + self.phase) * np.sqrt(2 / len(self.phase)), z * 0.1, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1)


def train(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 12_000, n_features: int = 192, ridge: float = 1e-2) -> Model | float:
    """A model of docs joined with labels (0 or 1); a number where there is nothing to tell apart."""
    ship(docs.sparkSession)
    labels = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
    n = labels.count()
    if n == 0:
        return 0.5
    some = unit_hash(F.col("id"), SEED) < min(1.0, max_rows / n)  # on the id, so either side is thinned before the join
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(some)
    sample = texts.join(labels.where(some), "id")
    fold = unit_hash(F.col("id"), SEED + 1)
    rows = stored(with_statistics(sample, [F.col("y"), fold.alias("fold")]), "quality-sample").coalesce(8)

    def moments(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s, q, ones = 0, np.zeros(N_STATS), np.zeros(N_STATS), 0.0
        for p in parts:
            if len(p):
                x = np.array(p["stats"].tolist())
                n, s, q, ones = n + len(p), s + x.sum(0), q + (x * x).sum(0), ones + p["y"].sum()
        yield pd.DataFrame({"n": [n], "s": [s.tolist()], "q": [q.tolist()], "ones": [ones]})

    got = rows.mapInPandas(moments, "n long, s array<double>, q array<double>, ones double").collect()
    n = sum(r["n"] for r in got)
    ones = sum(r["ones"] for r in got)
    if n == 0 or ones in (0, n):
        return ones / n if n else 0.5
    mean = np.sum([r["s"] for r in got], 0) / n
    scale = np.sqrt(np.maximum(np.sum([r["q"] for r in got], 0) / n - mean**2, 1e-12)) + 1e-3
    rng = np.random.default_rng(SEED)
    # the kernel's width: the usual distance of two standardised rows
    model = Model(mean, scale, rng.normal(size=(N_STATS, n_features)) / np.sqrt(N_STATS), rng.uniform(0, 2 * np.pi, n_features), None, None, None)
    width = n_features + N_STATS + 1

    def equations(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = np.zeros((width, width)), np.zeros(width)
        for p in parts:
            p = p[p["fold"] >= 0.3]
            if len(p):
                z = model.features(np.array(p["stats"].tolist()))
                a, b = a + z.T @ z, b + z.T @ p["y"].to_numpy()
        yield pd.DataFrame({"a": [a.ravel().tolist()], "b": [b.tolist()]})

    sums = rows.mapInPandas(equations, "a array<double>, b array<double>").collect()
    a = np.sum([r["a"] for r in sums], 0).reshape(width, width)
    model.weights = np.linalg.solve(a + ridge * np.eye(width), np.sum([r["b"] for r in sums], 0))

    def raw(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p = p[p["fold"] < 0.3]
            if len(p):
                yield pd.DataFrame({"x": model.raw(np.array(p["stats"].tolist())), "y": p["y"].to_numpy()})

    held = rows.mapInPandas(raw, "x double, y double").toPandas()
    if len(held) == 0:
        return ones / n
    model.knots, model.values = isotonic(held["x"].to_numpy(), held["y"].to_numpy())
    return model


def score(docs: DataFrame, model: Model | float, carry: list[Column], text_col: str = "text", score_col: str = "score") -> DataFrame:
    """The carried columns with score_col (0 to 1). One pass, no exchange."""
    if not isinstance(model, Model):
        return docs.select(*carry, F.lit(float(model)).alias(score_col))
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))
    key = uuid.uuid4().hex
    rows = docs.select(*carry, F.col(text_col).alias("__text"))

    def run(part: dict[str, list]) -> dict[str, list]:
        m: Model = built(key, lambda: Model(**sent.value))  # type: ignore[assignment]
        texts = part.pop("__text")
        return part | {score_col: m.score(np.array([statistics(t) for t in texts])).tolist() if texts else []}

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "__text")
    return arrow_pass(rows, run, kept + f"`{score_col}` double")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(crc_mod(F.col("doc_id"), 5) != 0), "quality")
    held = crc_mod(F.col("doc_id"), 5) == 0
    return score(docs, model, [F.col("doc_id"), held.alias("held_out")]).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
