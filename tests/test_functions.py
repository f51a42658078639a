from pyspark.sql import functions as F

from amplicore.functions import sequences as S
from amplicore.functions import taxonomy as T


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def lists(*rows):
    return F.array(*[F.array(*map(F.lit, r)) for r in rows])


def test_consensus(spark):
    r = one(
        spark,
        differ=T.consensus(lists("ABC", "ABD")), parents=T.consensus(lists("ABC", "ALC")), same=T.consensus(lists("AB", "AB")),
        three=T.consensus(lists("ABC", "ABD", "AXC")), none=T.consensus(F.array().cast("array<array<string>>")),
    )
    m = T.MULTI
    assert list(r) == [["A", "B", m], ["A", m, m], ["A", "B"], ["A", m, m], []]


def test_canonical_spellings(spark):
    texts = ["a;b;c", "a;b;c;", " a ; b;c ; ", "a(1.0);b(0.9);c(0.5);", "a (1);b (0.9);c (0.5)"]
    got = one(spark, **{f"c{i}": T.canonical(F.lit(t)) for i, t in enumerate(texts)})
    assert all(x == ["a", "b", "c"] for x in got)
    assert one(spark, c=T.canonical(F.lit("a(x);b")))["c"] == ["a(x)", "b"]


def test_reference_lineage(spark):
    assert one(spark, c=T.reference_lineage(F.lit("Root;k__Fungi [id: 1];p__X [id: 2];")))["c"] == ["k__Fungi", "p__X"]


def test_bootstrap_round_trip(spark):
    text = T.with_bootstraps(F.array(F.lit("a"), F.lit("b")), F.array(F.lit(1.0), F.lit(0.5)))
    names, boots = T.of_bootstraps(text)
    assert list(one(spark, t=text, n=names, b=boots)) == ["a;(1.0);b;(0.5);", ["a", "b"], [1.0, 0.5]]


def test_toggle_cancels(spark):
    r = one(spark, once=T.toggled(F.lit("a;b"), ["a"]), twice=T.toggled(F.lit("a;b"), ["a", "b"]))
    assert list(r) == [True, False]


def test_species_and_ranks(spark):
    r = one(spark, a=T.cleaned_species(F.lit("Bacillus cereus DSM 31")), b=T.cleaned_species(F.lit("uncultured clone")), c=T.completed(F.array(F.lit("K")), ["domain", "genus"]), d=T.unaccented(F.lit("Élève日")), e=T.inferred(F.lit("1.5")))
    assert list(r) == ["Bacillus cereus", "unknown species", ["K", "unknown genus"], "Eleve", "float"]


def test_species_cases(spark):
    """Cases of the rule: leading uncultured, whole undefined names, sp., subsp. of two words, a final DSM number."""
    cases = {
        "uncultured bacterium": "unknown species", "Undefined": "unknown species", "incertae sedis": "unknown species", "unidentified": "unknown species",
        "soil metagenome": "soil metagenome", "an uncultured one": "an uncultured one", "Bacillus sp. X5": "Bacillus sp.", "Bacillus sp.": "Bacillus sp.",
        "Bacillus cereus subsp. x": "Bacillus cereus", "A b c subsp. x": "A b c subsp. x", "Bacillus cereus DSM 31": "Bacillus cereus", "Bacillus cereus DSMY 31": "Bacillus cereus",
        "Bacillus cereus DSM 31 x": "Bacillus cereus DSM 31 x", "Bacillus cereus DSMZ 31": "Bacillus cereus DSMZ 31",
    }
    rows = spark.createDataFrame(list(cases.items()), "name string, want string").withColumn("got", T.cleaned_species(F.col("name"))).collect()
    assert [(r["name"], r["got"]) for r in rows] == [(r["name"], r["want"]) for r in rows]


def test_links_and_map_styles(spark):
    from amplicore.operators import ecology as E

    r = one(spark, a=T.link(F.lit("xCOG1")), b=T.link(F.lit("PF02")), c=T.link(F.lit("ko:K00001")), d=T.link(F.lit("EC:1.1")), e=T.link(F.lit("K1")))
    assert [x.rsplit("/", 1)[-1] for x in r] == ["xCOG1", "PF02", "www_bget?ko:K00001", "www_bget?EC:1.1", "no link"]
    styles = [tuple(one(spark, c=E.map_style(F.lit(fc), F.lit(p))[0], w=E.map_style(F.lit(fc), F.lit(p))[1])) for fc, p in ((0.5, 0.0001), (1.0, 0.005), (2.0, 0.02), (-0.5, 0.001), (-1.0, 0.01), (-2.0, 0.5), (0.0, 0.5))]
    assert styles == [("#DE894E", "W11"), ("#B26E3E", "W10"), ("#9B6037", "W9"), ("#B0C6C5", "W10"), ("#8EADAC", "W9"), ("#637978", "W9"), (None, "W9")]


def test_empty_lineages_and_barcodes(spark):
    from amplicore.operators import matrix as M
    from amplicore.operators import reads as R
    from amplicore.operators import taxonomy as X

    ab = spark.createDataFrame([("o", "s", 5), ("p", "s", 2)], "obs_id string, sample_id string, count long")
    lin = spark.createDataFrame([("o", []), ("p", ["A", "B"])], "obs_id string, taxonomy array<string>")
    assert sorted((r["lineage"], r["count"]) for r in X.rollup(ab, lin).collect()) == [("A", 2), ("A;B", 2)]
    reads = spark.createDataFrame([(1, None), (2, "ACGTA"), (3, "")], "seq_id long, sequence string")
    codes = spark.createDataFrame([("s1", "ACGT"), ("s2", "")], "sample_id string, barcode string")
    assert {r["seq_id"]: r["barcode"] for r in R.demultiplexed(reads, codes.where("barcode <> ''"), 1).collect()} == {1: "unmatched", 2: "s1", 3: "unmatched"}
    assert {r["barcode"] for r in R.demultiplexed(reads, codes.where("false"), 1).collect()} == {"unmatched"}
    assert one(spark, x=S.mismatches(F.lit("AC"), F.lit("")))["x"] == 0
    deep = M.depth_histogram(spark.createDataFrame([("o", "s", 200_000), ("p", "s", 1)], "obs_id string, sample_id string, count long"))
    assert deep.count() == 200_000 and deep.where("nb_observ > 0").count() == 2


def test_homopolymers(spark):
    def bad(s):
        return one(spark, x=S.long_homopolymer(F.lit(s), 3))["x"]

    assert bad("CAAAAAC") and bad("CAAAA") and not bad("CAAAAC") and not bad("CAAA") and not bad("")


def test_poor_quality(spark):
    def bad(q):
        return one(spark, x=S.poor_quality(F.lit(q), 10, 3))["x"]

    assert bad("!IIII") and bad("I!III!I") and not bad("I!IIII!I") and not bad("IIII")


def test_complement_and_ids(spark):
    name, size = S.sized_id(F.lit("x_1;size=12"))
    bare, single = S.sized_id(F.lit("y"))
    r = one(spark, rc=S.reverse_complement(F.lit("ACGTNRY")), n=name, s=size, b=bare, one_=single, mm=S.mismatches(F.lit("ACG"), F.lit("ATGC")), q=S.quality_offset(F.lit("II#")), z=S.quality_offset(F.lit("hhB")))
    assert list(r) == ["RYNACGT", "x_1", 12, "y", 1, 2, 33, 64]
