import random

import numpy as np
import pytest

from amplicore.llm import minhash_near as M
from amplicore.llm import pivot_near as V
from amplicore.llm.components import components


def closed(n, links):
    low = list(range(n))

    def top(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        low[b] = a
    return [top(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = closed(400, links)
    assert all(want[i] == c for i, c in got.items())
    assert {i for a, b in links if a != b for i in (a, b)} == set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def sets(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(6):
        base = rng.choices(words, k=rng.choice([12, 60, 150]))
        for _ in range(12):
            t = list(base)
            for _ in range(rng.randrange(0, max(2, len(t) // 25))):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts.append(" ".join(t))
    passage = " ".join(rng.choices(words, k=40))
    texts += [passage + " " + " ".join(rng.choices(words, k=rng.choice([5, 20, 60]))) for _ in range(40)]
    return texts + [None, "", "\n ", "a b", "A B", "a b c", texts[0].upper(), texts[0], "x " * 5000]


@pytest.mark.parametrize("path", ["few", "many", "small"])
def test_near_classes(spark, corpus, path, monkeypatch):
    monkeypatch.setattr(M, "SMALL", 2)
    if path == "many":
        monkeypatch.setattr(M, "SENT_ROWS", 0)
        monkeypatch.setattr(M, "BLOCK", 8)
    if path == "small":
        monkeypatch.undo()
    rows = [(i, t, "k") for i, t in enumerate(corpus)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = {r["doc"]: r for r in M.near_classes(docs, n_words=4).collect()}
    s = [sets(t, 4) for t in corpus]
    links = [(i, j) for i in range(len(s)) for j in range(i) if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j])]
    want = closed(len(s), links)
    assert [got[i]["component_id"] for i in range(len(s))] == want
    assert all(got[i]["n_shingles"] == len(s[i]) and got[i]["kept"] == (want[i] == i) for i in range(len(s)))


def test_near_classes_without_rows_or_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e")], "doc_id long, text string")
    assert [r["kept"] for r in M.near_classes(df).collect()] == [True, True]
    assert M.near_classes(df.where("false")).count() == 0


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors(spark, block, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    vectors = [v + rng.normal(size=16) * s for v in base for s in (0.0, 0.03, 0.05, 0.08)] + [base[0] * 3, base[0]]
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] + [1.0] * 15, 1), (n + 3, [None] + [1.0] * 15, 1), (n + 4, rows[0][1], None), (n + 5, [], 1), (n + 6, [1.0, 2.0], 1), (n + 7, [2.0, 4.0], 1), (n + 8, [float("inf")] * 16, 1)]
    got = {r["vec_id"]: r for r in V.near_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    x = [np.array(np.array(r[1], np.float32), float) if r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1]) and r[2] is not None else None for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= 0.98]
    found = sum(r["n_links"] for r in got.values()) / 2
    assert found == len(links)
    assert [got[i]["component_id"] for i in range(len(rows))] == closed(len(rows), links)
    assert got[n + 6]["n_links"] == 1 and all(got[n + k]["n_links"] == 0 for k in (0, 1, 2, 3, 4, 5, 8))


def test_awkward_tables(spark):
    e = spark.createDataFrame([(1, [1.0, 0.0], 1, 9, "x"), (1, [1.0, 0.0], 1, 9, "x"), (None, [1.0, 0.0], 1, 9, "x"), (2, [1.0, 0.01], 1, 9, "x")], "vec_id long, embedding array<float>, label int, rep int, list string")
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in V.near_links(e).collect())
    assert got == [("1", 2, 1, True), ("1", 2, 1, True), ("2", 2, 1, False), ("None", 0, None, True)]
    assert V.near_links(e.where("false")).count() == 0
    d = spark.createDataFrame([(3, "a b c d e f", 1, "x"), (3, "a b c d e f", 1, "x"), (3, "u v w x y z", 1, "x"), (5, "a b c d e f", 1, "x")], "doc_id int, text string, n int, rep string")
    assert sorted(r["component_id"] for r in M.near_classes(d).collect()) == [3, 3, 3, 3]
    with pytest.raises(ValueError):
        M.near_classes(d.selectExpr("string(doc_id) doc_id", "text"))
