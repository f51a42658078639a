import random

import numpy as np

from amplicore.llm import rff_quality as Q
from amplicore.llm import zstd_toxicity as Z

WORDS = [a + b for a in ("ka", "lo", "mi", "ren", "tu", "so", "ba") for b in ("ta", "ri", "no", "vel", "s", "dem", "")]


def good(rng, n=60):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def test_isotonic_is_monotone_and_best():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 20, 300).astype(float)
    y = (rng.random(300) < x / 20).astype(float)
    knots, values = Q.isotonic(x, y)
    assert (np.diff(knots) > 0).all() and (np.diff(values) >= 0).all() and values.min() >= 0 and values.max() <= 1


def test_quality(spark, awkward):
    rng = random.Random(2)
    texts = [good(rng) if i % 2 else good(rng).upper().replace(" ", "!! ") for i in range(300)]
    rows = [(i, t) for i, t in enumerate(texts + awkward)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(200)] + [(1, None, None), (9999, 1, None)], "doc_id long, quality int, toxic int")
    model = Q.train(docs, labels, "quality")
    from pyspark.sql import functions as F

    got = {r["doc_id"]: r["score"] for r in Q.score(docs, model, [F.col("doc_id")]).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.5) == (i % 2 == 1) for i in range(200, 300))
    assert got[306] == got[307]
    assert Q.train(docs, labels.where("false"), "quality") == 0.5
    assert Q.train(docs, labels.where("quality = 1"), "quality") == 1.0
    assert Q.score(docs, 0.5, [F.col("doc_id")]).where("score = 0.5").count() == len(rows)


def test_toxic_windows():
    rng = random.Random(3)

    def text(toxic):
        words = good(rng, 120).split(" ")
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["blasted", "wretchy", "foulmop"]))
        return " ".join(words)

    rows = [(text(i % 4 == 0), int(i % 4 == 0), rng.random()) for i in range(400)]
    model = Z.fit(rows)
    hit = [model.score(text(True)) for _ in range(40)]
    miss = [model.score(text(False)) for _ in range(40)]
    assert np.mean([s >= 0.7 for s in hit]) > 0.9 and np.mean([s >= 0.7 for s in miss]) < 0.05
    for t in (None, "", " ", "é日😀", "\x00", "x" * 100_000):
        assert 0 <= model.score(t) <= 1
    assert Z.fit([]) == 0.5 and Z.fit([("a", 1, 0.1)]) == 1.0
    for raw in (b" aa bbb aab ", b"a" * 200 + b" b", b" ", b""):
        assert sum(map(len, Z.windows(raw))) == len(raw) == len(Z.marked(raw))
    assert Z.marked(b" achlich ")[3:] != Z.marked(b" schlich ")[3:] and Z.marked(b" idiot x ")[:7] == Z.marked(b" idiot ")


def test_toxicity_rows(spark, awkward):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    texts = [good(rng) + (" wretchy foulmop" if i % 3 == 0 else "") for i in range(120)] + awkward
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    model = Z.train(docs, labels, "toxic")
    got = {r["doc_id"]: r["score"] for r in Z.score(docs, model, [F.col("doc_id")]).collect()}
    assert len(got) == len(texts) and got[126] == got[127]
    assert np.mean([got[i] for i in range(0, 120, 3)]) > np.mean([got[i] for i in range(1, 120, 3)]) + 0.3


def test_toxicity_by_definition(spark):
    """The query's model and scores from the definition: fits in this process, windows compressed one by one."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    texts = [good(rng, rng.randrange(5, 90)) + (" wretchy foulmop" if i % 4 == 0 else "") for i in range(160)] + ["", None]
    docs = spark.createDataFrame([(i, t, "x", 7.0) for i, t in enumerate(texts)], "doc_id long, text string, gain string, score double")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, toxic int")
    model = Z.train(docs, labels, "toxic")
    folds = {r["doc_id"]: r["f"] for r in docs.select("doc_id", Z.unit_hash(F.col("doc_id"), Z.SEED + 1).alias("f")).collect()}
    rows = sorted((folds[i], i, texts[i], int(i % 4 == 0)) for i in range(160))
    want = Z.fit([(t, y, f) for f, _, t, y in rows])
    assert (model.toxic, model.ordinary, model.level) == (want.toxic, want.ordinary, want.level)
    assert np.array_equal(model.knots, want.knots) and np.array_equal(model.values, want.values)
    one = lambda d, w: len(Z.Model(d, d)._compress()[0](Z.LEAD + w))
    got = {r["doc_id"]: r["score"] for r in Z.score(docs, model, [F.col("doc_id")]).collect()}
    for i in (0, 1, 4, 7, 160, 161):
        gain = sum(max(0, one(model.ordinary, w) - one(model.toxic, w) - model.level) for w in Z.windows(Z.plain(texts[i])))
        assert got[i] == np.clip(np.interp(gain, model.knots, model.values), 0, 1)
    empty = docs.where("false")
    assert Z.score(empty, model, [F.col("doc_id")]).count() == 0 and Z.train(empty, labels, "toxic") == 0.5
    assert isinstance(Z.train(docs, labels, "toxic", max_bytes=3000), (Z.Model, float))


def test_isotonic_by_definition():
    """Pools' means from the max-min formula of the best non-decreasing fit."""
    rng = np.random.default_rng(7)
    x = rng.integers(0, 12, 80).astype(float)
    y = (rng.random(80) < x / 12).astype(float)
    knots, values = Q.isotonic(x, y)
    xs = np.unique(x)
    best = [max(min(y[(x >= a) & (x <= b)].mean() for b in xs[xs >= v]) for a in xs[xs <= v]) for v in xs]
    for v, m in zip(xs, best, strict=True):
        pool = xs[np.isclose(best, m)]
        w = np.isin(x, pool).sum()
        assert abs(np.interp(v, knots, values) - (m * w + 0.5) / (w + 1)) < 1e-9


def test_quality_by_definition(spark):
    """The query's model and scores from one solve over all rows in this process."""
    from pyspark.sql import functions as F

    rng = random.Random(9)
    texts = [good(rng, rng.randrange(3, 80)) if i % 2 else good(rng, rng.randrange(3, 80)).upper() + "!!" for i in range(200)]
    docs = spark.createDataFrame([(i, t, "x", 3.0) for i, t in enumerate(texts)], "doc_id long, text string, stats string, score double").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    model = Q.train(docs, labels, "quality")
    stats = np.array([Q.statistics(t) for t in texts])
    folds = {r["doc_id"]: r["f"] for r in docs.select("doc_id", Q.unit_hash(F.col("doc_id"), Q.SEED + 1).alias("f")).collect()}
    fold, y = np.array([folds[i] for i in range(200)]), np.arange(200) % 2.0
    assert np.allclose(model.mean, stats.mean(0)) and np.allclose(model.scale, stats.std(0) + 1e-3, atol=1e-6)
    z = model.features(stats[fold >= 0.3])
    width = z.shape[1]
    weights = np.linalg.lstsq(np.vstack([z, 0.1 * np.eye(width)]), np.r_[y[fold >= 0.3], np.zeros(width)], rcond=None)[0]
    assert np.allclose(z @ weights, z @ model.weights, atol=1e-6)
    knots, values = Q.isotonic(model.raw(stats[fold < 0.3]), y[fold < 0.3])
    assert np.allclose(knots, model.knots) and np.allclose(values, model.values)
    got = {r["doc_id"]: r["score"] for r in Q.score(docs, model, [F.col("doc_id")]).collect()}
    want = np.clip(np.interp(model.features(stats) @ model.weights, knots, values), 0, 1)
    assert np.allclose([got[i] for i in range(200)], want)
    assert Q.score(docs.where("false"), model, [F.col("doc_id")]).count() == 0
