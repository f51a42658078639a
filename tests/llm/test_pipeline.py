import corpus_pipeline as P
from amplicore.llm import catalog


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf).persist()
        assert docs.columns == columns
        if name != "mix_sources":
            assert docs.count() <= n
            n = docs.count()
        else:
            assert 0 < docs.count() <= 2 * n
    out = P.STAGES[-1][1](spark, docs, sf)
    assert out.count() == docs.count() and {"doc_id", "n_tokens"} <= set(out.columns)


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    kept = P.quality(spark, P.language_id(spark, docs, sf), sf)
    good = docs.join(labels, "doc_id", "left_semi").count()
    assert kept.join(labels, "doc_id", "left_semi").count() >= 0.95 * good


def test_awkward_documents(spark, awkward):
    texts = ["the cat sat on the mat near the dog " * 5, "der hund und die katze und das haus da " * 5] * 20 + awkward
    rows = [(i if i != 45 else None, t, ("en", "de")[i % 2] if i < 40 else None, None, 1, "clash", 2.0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, score string, lang_pred double")
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001").persist()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "lang_pred"], name
    assert 0 < docs.count() < 10
    assert P.STAGES[-1][1](spark, docs, "").count() == docs.count()
    none = docs.where("false")
    for name, stage in P.STAGES:
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0, name


def test_catalog():
    names = list(catalog.QUERIES)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert set(catalog.ORACLE_SQL) <= set(names)


def test_null_and_repeated_ids(spark):
    one, two = "one text of more than five words here", "another text that has nothing in common with it"
    docs = spark.createDataFrame([(1, one, "s"), (2, one, "s"), (2, two, "s"), (2, two, "s"), (None, one, "s"), (3, two, "s")], "doc_id long, text string, source string")
    kept = P.near_dedup(spark, docs, "")
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, one, "s"), (3, two, "s"), (None, one, "s")]
    assert sorted(map(tuple, P.near_dedup(spark, docs.where("doc_id < 3"), "").collect())) == [(1, one, "s"), (2, two, "s")]
    rows = [(None, f"null id number {k} with words", "s") for k in range(3)] + [(5, one, "s"), (5, two, "s"), (None, "equal rows", None), (None, "equal rows", None), (6, "equal rows", "s")]
    mixed = P.mix_sources(spark, spark.createDataFrame(rows, docs.schema), "").collect()
    for r in set(rows):
        n = rows.count(r)
        assert n <= sum(tuple(m) == r for m in mixed) <= 2 * n, r
