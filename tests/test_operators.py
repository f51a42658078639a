from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from amplicore.operators import ecology as E
from amplicore.operators import kernels as K
from amplicore.operators import matrix as M
from amplicore.operators import reads as R
from amplicore.operators import sampling as P
from amplicore.operators import taxonomy as X


@pytest.fixture(scope="module")
def ab(spark):
    rows = [("A", "s1", 1), ("A", "s2", 1), ("B", "s3", 2), ("C", "s1", 5), ("C", "s2", 6), ("C", "s3", 7)]
    return spark.createDataFrame(rows, "obs_id string, sample_id string, count long")


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame([("s1", "g"), ("s2", "g"), ("s3", "g")], "sample_id string, group string")


def test_replicate_evidence(ab, groups):
    kept = {tuple(r) for r in M.reset_without_replicates(ab, groups, 2).collect()}
    assert kept == {("A", "s1", 1), ("A", "s2", 1), ("C", "s1", 5), ("C", "s2", 6), ("C", "s3", 7)}


def test_depth_histogram_has_empty_depths(ab):
    h = {r["depth"]: (r["nb_observ"], r["pct"]) for r in M.depth_histogram(ab).collect()}
    assert len(h) == 18 and h[2] == (2, 66.667) and h[3] == (0, 0.0) and h[18] == (1, 33.333)


def test_presence_of_share_zero(ab, groups):
    assert {r[0] for r in M.replicate_presence(ab, groups, 0.0).collect()} == {"A", "B", "C"}
    assert {r[0] for r in M.replicate_presence(ab, groups, 1.0).collect()} == {"C"}


def test_empty_matrix(ab, groups):
    none = ab.where("false")
    for df in (M.depth_histogram(none), M.by_observation(none), M.own_and_shared(none), M.funnel(none, none), M.cpm(none), E.alpha_diversity(none), P.subsampled(none, n=1), E.distances(none, "bray")):
        assert df.count() == 0


def test_subsample_keeps_sizes(ab):
    got = P.subsampled(ab, n=3)
    assert {r["sample_id"]: r["n"] for r in got.groupBy("sample_id").agg(F.sum("count").alias("n")).collect()} == {"s1": 3, "s2": 3, "s3": 3}
    whole = ab.withColumnRenamed("count", "all")
    assert got.join(whole, ["obs_id", "sample_id"], "left").where("all is null or count > all").count() == 0


def test_rarefaction_rises(ab):
    rows = sorted((r["sample_id"], r["nb_sampled"], r["taxa"]) for r in P.rarefaction(ab, None, 2).collect())
    for (s, _, x), (t, _, y) in zip(rows, rows[1:], strict=False):
        assert s != t or x <= y


def test_barcodes(spark):
    codes = spark.createDataFrame([("BC1", "GATCT"), ("BC2", "ATCGT"), ("BC3", "GTGAT")], "sample_id string, barcode string")
    reads = spark.createDataFrame([(1, "GATTTACG"), (2, "GTGATACG"), (3, "CCCCCCCC"), (4, "AT")], "seq_id long, sequence string")
    at = {r["seq_id"]: r["barcode"] for r in R.demultiplexed(reads, codes, 1).collect()}
    assert at == {1: "BC1", 2: "BC3", 3: "unmatched", 4: "unmatched"}
    assert {r["seq_id"]: r["barcode"] for r in R.demultiplexed(reads, codes, 0).collect()}[1] == "unmatched"


def test_metric_filter_acts_only_where_lineages_change(spark):
    rows = [(1, 1, "x", 1.0, 90.0, 99.0, 10, ["A", "B"]), (1, 2, "y", 1.0, 99.0, 99.0, 10, ["A", "B"]), (2, 1, "x", 1.0, 90.0, 99.0, 10, ["A", "B"]), (2, 2, "y", 1.0, 99.0, 99.0, 10, ["A", "C"])]
    hits = spark.createDataFrame(rows, "query_id long, ord int, subject string, bitscore double, identity double, coverage double, aln_length int, taxonomy array<string>")
    out = {r["query_id"]: r for r in X.metric_filter(X.affiliations(hits), {"identity": lambda a: a["identity"] >= 95}).collect()}
    assert out[1]["status"] == "unchanged" and len(out[1]["affs"]) == 2
    assert out[2]["status"] == "changed" and out[2]["consensus"] == ["A", "C"]


def test_greedy_aggregation(spark):
    def aff(identity, lineage):
        return {"identity": identity, "coverage": 99.0, "lineage": lineage}

    rows = [("a", 1, 100.0, [aff(99.0, "t1"), aff(99.0, "t2")]), ("b", 2, 50.0, [aff(99.0, "t2"), aff(99.0, "t3")]), ("c", 3, 10.0, [aff(99.0, "t3")]), ("d", 4, 90.0, [aff(50.0, "t1")]), ("e", 5, 5.0, [])]
    obs = spark.createDataFrame(rows, "obs_id string, ord int, total double, affs array<struct<identity:double,coverage:double,lineage:string>>")
    assert {r["obs_id"]: r["owner"] for r in K.greedy_aggregate(obs, 95, 95).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e"}


def test_one_difference(spark):
    words = ["ACGT", "ACGA", "ACG", "AACGT", "TTTT", "ACGTT", "CGT"]
    heads = spark.createDataFrame(list(enumerate(words)), "seq_id long, sequence string")

    def distance(s, t):
        row = list(range(len(t) + 1))
        for i, c in enumerate(s, 1):
            diag, row[0] = row[0], i
            for j, d in enumerate(t, 1):
                diag, row[j] = row[j], min(diag + (c != d), row[j] + 1, row[j - 1] + 1)
        return row[-1]

    want = {(i, j) for (i, s), (j, t) in combinations(enumerate(words), 2) if distance(s, t) == 1}
    assert {(r["a"], r["b"]) for r in K.one_difference(heads).collect()} == want


def test_linkage_and_ordination():
    d = np.array([[0, 1, 4, 5], [1, 0, 4, 5], [4, 4, 0, 2], [5, 5, 2, 0]], float)
    merges = K.linkage(d)
    assert [(a, b) for a, b, *_ in merges] == [(0, 1), (2, 3), (4, 5)] and merges[-1][2] == 4.5
    assert K.dendrogram(list("wxyz"), merges) == "((w:1.000,x:1.000):3.500,(y:2.000,z:2.000):2.500);"
    at, share = K.principal_coordinates(np.abs(np.subtract.outer([0.0, 1, 3], [0.0, 1, 3])), 1)
    assert np.allclose(np.sort(np.abs(np.diff(at[:, 0]))), [1, 2]) and np.isclose(share[0], 1)


def test_local_alignment_and_closest():
    assert K.align("ACGT", "TTACGTTT") == (4.0, 100.0, 100.0)
    assert K.align("", "A") == (0.0, 0.0, 0.0)
    edges = [("r", "x", 1.0), ("x", "q", 0.5), ("x", "a", 2.0), ("r", "b", 0.1)]
    assert K.closest_references(edges, ["q"], {"a", "b"}) == [("q", "a", 2.5)]


def test_merge_pairs(spark):
    pairs = spark.createDataFrame([("x", "AAAACCCCGGGGTT", "CCCCGGGGTTTTTT"), ("y", "AAAAAAAAAAAAAA", "CCCCCCCCCCCCCC")], "name string, first string, second string")
    assert {r["name"]: r["merged"] for r in K.merge_pairs(pairs).collect()} == {"x": "AAAACCCCGGGGTTTTTT", "y": None}


def test_enrichment(spark):
    members = spark.createDataFrame([(f"f{i}", "p" if i < 4 else "q") for i in range(10)], "function string, pathway string")
    listed = spark.createDataFrame([(f"f{i}",) for i in range(4)], "function string")
    out = {r["pathway"]: r for r in E.enrichment(listed, members).collect()}
    assert abs(out["p"]["p"] - 1 / 210) < 1e-12 and out["p"]["stars"] == "**" and out["q"]["p"] == 1.0


def test_fillers(spark):
    from amplicore.operators import reads as R

    n = "N" * 100
    rows = [("a_combined", "note ", f"ACG{n}TT"), ("b", None, "ACNT"), ("c_combined", None, "ACGT"), ("d_combined", None, f"{n}A"), ("e", None, None)]
    df = spark.createDataFrame(rows, "seq_id string, description string, sequence string")
    hidden = {r["seq_id"]: r for r in R.fillers_hidden(df).collect()}
    assert hidden["a_combined"]["description"] == "note 50A50C:3:102" and hidden["a_combined"]["sequence"] == "ACG" + "A" * 50 + "C" * 50 + "TT"
    assert hidden["b"]["sequence"] == "ACNT" and hidden["c_combined"]["sequence"] is None and hidden["d_combined"]["description"] == "50A50C:0:99"
    back = {r["seq_id"]: (r["description"], r["sequence"]) for r in R.fillers_restored(R.fillers_hidden(df)).collect()}
    assert back == {i: (d, None if i == "c_combined" else s) for i, d, s in rows}
    whole, joined = R.by_filler(df)
    assert {r["seq_id"] for r in joined.collect()} == {"a_combined", "b", "d_combined"} and whole.count() == 2
    assert R.adjusted_bounds(200, 500, "ACGT", "AC") == (194, 494)
    assert {r["chunk"] for r in R.chunks(df, n=2).collect()} <= {0, 1} and R.chunks(df, size=2).count() == 5


def test_primers_on_either_strand(spark):
    from amplicore.operators import kernels as K

    five, three, body = "ACGTRYACGT", "GGTTCCAACC", "TTTTGAGAGATTTTCATG" * 3
    read = "CC" + "ACGTACACGT" + body + "GGTTCCATCC" + "AA"
    flip = read[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [(1, read, "I" * len(read)), (2, flip, "I" * len(flip)), (3, body, "I" * len(body)), (4, None, None)]
    df = spark.createDataFrame(rows, "seq_id long, sequence string, quality string")
    got = {r["seq_id"]: (r["sequence"], len(r["quality"])) for r in K.trim_either_strand(df, five, three, 40).collect()}
    assert got == {1: (body, len(body)), 2: (body, len(body))}


def test_filters_on_functions_and_trees(spark):
    import pytest

    from amplicore.functions import taxonomy as T
    from amplicore.operators import matrix as M
    from amplicore.operators import sampling as P

    refs = spark.createDataFrame([("a", 0.5, 0.5, 3.0), ("b", 0.99, 1.0, 0.1), ("c", 0.97, 0.99, 2.0), ("d", 0.99, 1.0, None)], "obs_id string, identity double, coverage double, nsti double")
    got = {r["obs_id"]: (r["parameters"], r["values"]) for r in M.function_failures(refs, 0.97, 0.9, 2.0).collect()}
    assert got == {"a": ("min_blast_identity,min_blast_coverage,max_nsti", "identity = 0.5,coverage = 0.5,nsti = 3.0")}
    assert M.function_failures(refs).count() == 0
    M.check_nsti(refs, 0.1)
    with pytest.raises(ValueError):
        M.check_nsti(refs, 0.05)
    for bad in ("x", -1, 101, None):
        with pytest.raises(ValueError):
            T.ratio(bad)
    assert T.ratio("50") == 50.0
    lin = spark.createDataFrame([(1, ["A", "Unknown b"]), (2, None), (3, ["A", "B", "C"])], "obs_id long, taxonomy array<string>")
    assert sorted(r["taxon"] for r in P.ranked_taxa(lin, 2, 3).collect()) == ["a;b;c", "a;unknown;unknown", "unknown;unknown;unknown"]


def test_draws_by_definition(spark):
    """Draws and curves against all reads sorted by their hashes."""
    import hashlib

    from amplicore.operators import sampling as P

    cells = [("x", "s", 700), ("y", "s", 300), ("z", "s", 1), ("x", "t", 50), ("w", "t", 0)]
    ab = spark.createDataFrame(cells, "obs_id string, sample_id string, count long")
    order = {}
    for o, s, n in cells:
        order.setdefault(s, []).extend((hashlib.md5(f"{o}|{s}|{i}".encode()).hexdigest(), o) for i in range(1, n + 1))
    order = {s: [o for _, o in sorted(v)] for s, v in order.items()}
    for n in (1, 50, 333, 1001):
        got = {(r["obs_id"], r["sample_id"]): r["count"] for r in P.subsampled(ab, n=n).collect()}
        want = {}
        for s, v in order.items():
            for o in v[:n]:
                want[o, s] = want.get((o, s), 0) + 1
        assert got == want
    got = {(r["sample_id"], r["nb_sampled"]): r["taxa"] for r in P.rarefaction(ab, None, 10).collect()}
    assert got == {(s, k): len(set(v[:k])) for s, v in order.items() for k in range(10, len(v) + 1, 10)}


def test_rarefied_richness_and_permanova(spark):
    from math import comb

    import numpy as np

    from amplicore.operators import kernels as K
    from amplicore.operators import sampling as P

    cells = {"s": [7, 3, 3, 20], "t": [5]}
    ab = spark.createDataFrame([(f"{s}{i}", s, n) for s, v in cells.items() for i, n in enumerate(v)], "obs_id string, sample_id string, count long")
    got = {(r["sample_id"], r["depth"]): r["richness"] for r in P.rarefied_richness(ab).collect()}
    assert set(got) == {("s", 10), ("s", 20), ("s", 30), ("s", 33), ("t", 5)}
    for (s, d), r in got.items():
        whole = sum(cells[s])
        assert abs(r - sum(1 - comb(whole - n, d) / comb(whole, d) for n in cells[s])) < 1e-9
    x = np.arange(1.0, 200)
    from math import lgamma

    assert np.allclose(P.log_gamma(x), [lgamma(v) for v in x], rtol=1e-12, atol=1e-11)
    points = np.r_[np.zeros(4), np.full(4, 9.0)] + np.arange(8) / 100
    r = K.permanova(spark, np.abs(points[:, None] - points[None]), ["a"] * 4 + ["b"] * 4, 499).first()
    assert r["r2"] > 0.99 and r["p"] < 0.1 and K.permanova(spark, np.abs(points[:, None] - points[None]), ["a", "b"] * 4, 499).first()["p"] > 0.5


def test_variance_with_depth(spark):
    """Against least squares of the two nested models, and the F distribution by its integral."""
    from math import lgamma

    import numpy as np

    from amplicore.operators import ecology as E

    rng = np.random.default_rng(3)
    g, x = np.arange(40) % 4, rng.integers(100, 999, 40).astype(float)
    y = 0.01 * x + g + rng.normal(size=40)
    rows = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(g, x, y, strict=True)] + [(1, None, 2.0)], "g int, x double, y double")
    r = E.anova_depth(rows, "g", "y", "x").first()

    def rest(columns):
        m = np.column_stack(columns)
        return float(((y - m @ np.linalg.lstsq(m, y, rcond=None)[0]) ** 2).sum())

    none, depth, full = rest([np.ones(40)]), rest([np.ones(40), x]), rest([x, *[(g == k).astype(float) for k in range(4)]])
    assert (r["df_group"], r["df_within"]) == (3, 35)
    assert np.isclose(r["f_depth"], (none - depth) / (full / 35)) and np.isclose(r["f_group"], ((depth - full) / 3) / (full / 35))

    def tail(f, a, b):
        u = (np.arange(400_000) + 0.5) / 400_000 * (b / (b + a * f))  # the beta density below x
        density = np.exp(lgamma((a + b) / 2) - lgamma(a / 2) - lgamma(b / 2) + (b / 2 - 1) * np.log(u) + (a / 2 - 1) * np.log1p(-u))
        return float(density.mean() * (b / (b + a * f)))

    for f, a, b in ((0.5, 3, 35), (2.9, 3, 35), (8.0, 4, 10), (1.0, 2, 7)):
        assert abs(E.f_tail(f, a, b) - tail(f, a, b)) < 1e-6
    assert np.isclose(r["p_group"], E.f_tail(r["f_group"], 3, 35))


def _shuffled(spark, df):
    """The rows, and how many records were shuffled for them."""
    sc = spark.sparkContext
    store, bus = sc._jsc.sc().statusStore(), sc._jsc.sc().listenerBus()

    def records():
        bus.waitUntilEmpty(30_000)
        stages = store.stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = records()
    return df().collect(), records() - before


def _many_reads(spark):
    return spark.createDataFrame([("x", "s", 200_000), ("y", "s", 100_000), ("x", "t", 90_000), ("y", "u", 40)], "obs_id string, sample_id string, count long")


def _drawn(cells, goal):
    import hashlib

    want = {}
    for s, n in goal.items():
        order = sorted((hashlib.md5(f"{o}|{s}|{i}".encode()).digest(), o) for o, t, k in cells if t == s for i in range(1, k + 1))
        for _, o in order[:n]:
            want[o, s] = want.get((o, s), 0) + 1
    return want


def test_draw_of_large_samples_hands_on_few_reads(spark):
    ab = _many_reads(spark)
    rows, records = _shuffled(spark, lambda: P.subsampled(ab, n=70_000, drop_small=True))
    assert {(r["obs_id"], r["sample_id"]): r["count"] for r in rows} == _drawn([tuple(r) for r in ab.collect()], {"s": 70_000, "t": 70_000})
    assert records < 390_000 // 4


def test_numbered_md5_by_definition():
    import hashlib

    from amplicore.operators.digests import as_bytes, numbered_md5

    keys = [b"a|b|", b"", b"\xc3\xa9" * 30, b"c|b|", b"x" * 54]
    first, last = np.array([1, 98, 10**12 - 2, 7, 1]), np.array([70_000, 98, 10**12 + 1, 7, 12])
    for end in (b"", b"|seed"):
        got = [(c, h) for of, a, b in numbered_md5(keys, first, last, end) for c, h in zip(of.tolist(), as_bytes(a, b), strict=True)]
        assert got == [(c, hashlib.md5(keys[c] + str(i).encode() + end).digest()) for c in range(5) for i in range(first[c], last[c] + 1)]


def test_ratio_of_large_samples_hands_on_few_reads(spark):
    ab = _many_reads(spark)
    rows, records = _shuffled(spark, lambda: P.subsampled(ab, ratio=0.25))
    assert {(r["obs_id"], r["sample_id"]): r["count"] for r in rows} == _drawn([tuple(r) for r in ab.collect()], {"s": 75_000, "t": 22_500, "u": 10})
    assert records < 390_000 // 4


def test_smallest_sample_hands_on_few_reads(spark):
    ab = _many_reads(spark).union(spark.createDataFrame([("x", "empty", 0)], "obs_id string, sample_id string, count long"))
    rows, records = _shuffled(spark, lambda: P.subsampled(ab))
    assert {(r["obs_id"], r["sample_id"]): r["count"] for r in rows} == _drawn([tuple(r) for r in ab.collect()], {"s": 40, "t": 40, "u": 40})
    assert records < 390_000 // 4


def test_rarefaction_of_large_samples_hands_on_few_reads(spark):
    import hashlib

    ab = _many_reads(spark)
    taxa = spark.createDataFrame([("x", "a"), ("y", "b"), ("y", "a")], "obs_id string, taxon string")
    rows, records = _shuffled(spark, lambda: P.rarefaction(ab, taxa, 20))
    at = {}
    for o, s, n in (tuple(r) for r in ab.collect()):
        at.setdefault(s, []).extend((hashlib.md5(f"{o}|{s}|{i}".encode()).digest(), o) for i in range(1, n + 1))
    want = {}
    for s, reads in at.items():
        seen = set()
        for k, (_, o) in enumerate(sorted(reads), 1):
            seen |= {"x": {"a"}, "y": {"a", "b"}}[o]
            if k % 20 == 0:
                want[s, k] = len(seen)
    assert {(r["sample_id"], r["nb_sampled"]): r["taxa"] for r in rows} == want
    assert records < 390_000 // 4


def test_heat_map_ties_and_missing_queries(spark):
    """Equal alignments give the same cell in any order of rows; those without a query aren't counted."""
    rows = [(1, 7, 1, 30.0, 99.0, 95.0), (1, 7, 1, 30.0, 93.0, 98.0), (1, 7, 2, 30.0, 100.0, 100.0), (None, 7, 1, 50.0, 90.0, 90.0)]
    for cells in (rows, rows[::-1]):
        aln = spark.createDataFrame(cells, "query_id long, subject long, ord int, bitscore double, identity double, coverage double").coalesce(1)
        assert [(r["identity"], r["coverage"], r["n"]) for r in X.heat_map(aln).where("n > 0").collect()] == [(99, 95, 1)]


def test_lines_are_summed_before_they_are_shuffled(spark, tmp_path, monkeypatch):
    """Many lines of few parts: the draw's cells come from sums, also where no table is small enough to be sent by itself."""
    from amplicore.plans import ecology_queries as Q

    lines = spark.range(6000).select((F.col("id") % 7).alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"), (F.col("id") % 3).cast("double").alias("l_quantity"))
    lines.union(spark.sql("SELECT 1L, 99L, 5D UNION ALL SELECT 99L, 1L, 5D UNION ALL SELECT NULL, 1L, 5D UNION ALL SELECT 1L, 1L, NULL")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(7).selectExpr("id AS p_partkey", "concat('b', id % 2) AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(5).selectExpr("id AS s_suppkey", "id % 3 AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(3).selectExpr("id AS n_nationkey", "id % 2 AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(2).selectExpr("id AS r_regionkey", "concat('r', id) AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    want = {}
    for i in range(6000):
        key = f"b{i % 7 % 2}", f"r{i % 5 % 3 % 2}"
        want[key] = want.get(key, 0) + i % 3
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, records = _shuffled(spark, lambda: Q._small(spark, str(tmp_path)))
        assert {(r["obs_id"], r["sample_id"]): r["count"] for r in rows} == want
        assert records < 6000 // 4
        monkeypatch.setattr(Q, "SENT_SUPPLIERS", 0, raising=False)
        assert {(r["obs_id"], r["sample_id"]): r["count"] for r in Q._small(spark, str(tmp_path)).collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_draw_makes_hashes_once(spark, monkeypatch):
    """Draws that end where they should need no count of all hashes; with no room for their ends the count finds them all the same."""
    ab, counted, by_part = _many_reads(spark), [], P._by_part
    monkeypatch.setattr(P, "_by_part", lambda *a: counted.append(1) or by_part(*a))
    want = _drawn([tuple(r) for r in ab.collect()], {"s": 40, "t": 40, "u": 40})
    assert {(r["obs_id"], r["sample_id"]): r["count"] for r in P.subsampled(ab).collect()} == want and not counted
    monkeypatch.setattr(P, "SPREAD", 0, raising=False)
    assert {(r["obs_id"], r["sample_id"]): r["count"] for r in P.subsampled(ab).collect()} == want and counted
