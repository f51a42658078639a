import random

from amplicore.llm import mixing as X


def test_apportionment_by_quotients():
    rng = random.Random(1)
    for _ in range(200):
        votes = [rng.choice([0, rng.randrange(1, 50), rng.random() * 1000]) for _ in range(rng.randrange(1, 12))]
        seats = rng.randrange(0, 60)
        held = [0] * len(votes)
        for _ in range(seats if sum(votes) else 0):
            i = max(range(len(votes)), key=lambda i: (votes[i] / (2 * held[i] + 1), -i))
            held[i] += 1
        got = X.apportioned(votes, seats)
        assert sum(got) == sum(held)
        low = min((votes[i] / (2 * h - 1) for i, h in enumerate(got) if h), default=float("inf"))
        assert all(v / (2 * h + 1) <= low * (1 + 1e-9) for v, h in zip(votes, got))


def test_targets():
    assert X.targets([10, 10, 10], [3, 1, 2], 45, 2) == [20.0, 25 / 3, 50 / 3]
    assert X.targets([], [], 0, 2) == [] and X.targets([0, 4], [3, 1], 6, 2) == [0.0, 6.0]


def test_mix(spark, awkward):
    rng = random.Random(2)
    texts = [" ".join("w" for _ in range(rng.randrange(1, 80))) for _ in range(600)] + awkward + ["dup here"] * 5
    rows = [(i if t != "dup here" else 7, t, None if i % 7 == 0 else f"s{min(i % 5, 3)}", "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = X.mix(df).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in by[s]) for s in sources]
    aims = X.targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sources))], 1.5 * sum(sizes), 2)
    for s, n, aim in zip(sources, sizes, aims):
        assert all(r["source_size"] == n and abs(r["target"] - aim) < 1e-6 for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - aim) <= 2 + 0.01 * aim
    assert sorted(map(str, X.mix(df.repartition(5)).collect())) == sorted(map(str, got))
    assert X.mix(df.where("false")).count() == 0


def test_small_sources_of_a_large_table(spark):
    large = spark.range(40).selectExpr("id AS doc_id", "repeat('w ', 100000) AS text", "'a' AS source")
    small = spark.createDataFrame([(100, "v v v v", "b"), (101, "u u", "c")], "doc_id long, text string, source string")
    got = {r["source"]: (r["target"], r["taken"]) for r in X.mix(large.union(small)).where("source <> 'a'").collect()}
    assert got == {"b": (8.0, 8), "c": (4.0, 4)}
