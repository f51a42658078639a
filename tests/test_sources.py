import gzip
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from amplicore.sources import biom, fastx, newick, sinks, tables
from amplicore.streaming import dereplicate as stream


@pytest.fixture
def document():
    return {
        "id": None, "format": "f", "format_url": "u", "type": "OTU table", "generated_by": "x", "date": "d", "matrix_type": "sparse", "matrix_element_type": "int", "shape": [2, 2],
        "rows": [{"id": "o1", "metadata": {"taxonomy": ["A", "B"]}}, {"id": "o2", "metadata": None}], "columns": [{"id": "s1", "metadata": None}, {"id": "s2", "metadata": None}], "data": [[0, 0, 3], [0, 1, 0], [1, 1, 4]],
    }


def cells(df):
    return {tuple(r) for r in df.select("obs_id", "sample_id", "count").collect()}


def test_biom_round_trip(spark, tmp_path, document):
    p = tmp_path / "a.biom"
    p.write_text(json.dumps(document))
    e = biom.read_biom(spark, str(p))
    assert cells(e.abundance) == {("o1", "s1", 3), ("o2", "s2", 4)}
    assert biom.is_biom(spark, str(p))
    biom.write_biom(e, str(tmp_path / "out"))
    again = biom.read_biom(spark, str(tmp_path / "out"))
    assert cells(again.abundance) == cells(e.abundance)
    assert [r["id"] for r in again.observations.orderBy("ord").collect()] == ["o1", "o2"]
    dense = document | {"matrix_type": "dense", "data": [[3, 0], [0, 4]]}
    (tmp_path / "d.biom").write_text(json.dumps(dense))
    assert cells(biom.read_biom(spark, str(tmp_path / "d.biom")).abundance) == cells(e.abundance)


def test_biom_with_an_id_twice(spark, tmp_path, document):
    document["rows"][1]["id"] = "o1"
    (tmp_path / "a.biom").write_text(json.dumps(document))
    with pytest.raises(ValueError):
        biom.read_biom(spark, str(tmp_path / "a.biom"))
    (tmp_path / "no.biom").write_text("{}")
    assert not biom.is_biom(spark, str(tmp_path / "no.biom"))


def test_count_table(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("#id\ts1\ts2\no1\t1\t0\no2\t0\t5\n")
    ab = biom.read_count_table(spark, str(tmp_path / "c.tsv"))
    assert cells(ab) == {("o1", "s1", 1), ("o2", "s2", 5)}
    biom.write_count_table(ab, ["s1", "s2"], str(tmp_path / "w"))
    assert cells(biom.read_count_table(spark, str(tmp_path / "w"))) == cells(ab)


def test_metadata(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("#samples\tage\ttags\ns1\t3\ta|b\n")
    kind, df = biom.read_metadata(spark, str(tmp_path / "m.tsv"), {"age": "int"}, {"tags": r"\|"})
    assert kind == "sample" and tuple(df.first()) == ("s1", 3, ["a", "b"])


def test_fasta_and_fastq(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a first one\nACGT\nAC\n>b\nTT\n")
    rows = {r["seq_id"]: (r["description"], r["sequence"], r["sample_id"]) for r in fastx.read_sequences(spark, str(tmp_path / "x.fa")).collect()}
    assert rows == {"a": ("first one", "ACGTAC", "x"), "b": (None, "TT", "x")}
    with gzip.open(tmp_path / "y.fastq.gz", "wt") as f:
        f.write("@r1 n\nACG\n+\nIII\n@r2\nA\n+\n!\n")
    q = fastx.read_fastq(spark, str(tmp_path / "y.fastq.gz"))
    assert {(r["seq_id"], r["sequence"], r["quality"], r["sample_id"]) for r in q.collect()} == {("r1", "ACG", "III", "y"), ("r2", "A", "!", "y")}
    fastx.write_fastq(q, str(tmp_path / "o"), by_sample=True)
    assert fastx.sniffed(spark, str(tmp_path / "x.fa")) == "fasta"
    fastx.write_fasta(fastx.read_fasta(spark, str(tmp_path / "x.fa")), str(tmp_path / "f"))
    assert {r["seq_id"] for r in fastx.read_fasta(spark, str(tmp_path / "f")).collect()} == {"a", "b"}


def test_sample_files(spark, tmp_path):
    assert fastx.paired_files(["s_R1.fq", "s_R2.fq", "t_r1.fastq.gz", "t_r2.fastq.gz"]) == {"s": ("s_R1.fq", "s_R2.fq"), "t": ("t_r1.fastq.gz", "t_r2.fastq.gz")}
    with pytest.raises(ValueError):
        fastx.paired_files(["s_R1.fq"])
    (tmp_path / "a.fq").write_text("")
    with tarfile.open(tmp_path / "a.tar", "w") as t:
        t.add(tmp_path / "a.fq", "a.fq")
    assert fastx.archive_members(str(tmp_path / "a.tar")) == ["a.fq"]
    (tmp_path / "b.fq").write_text("@r1 note\nACGT\n+\nIIII\n@r2\nA\n+\nI\n")
    with tarfile.open(tmp_path / "c.tar.gz", "w:gz") as t:
        t.add(tmp_path / "a.fq", "a.fq")
        t.add(tmp_path / "b.fq", "b.fq")
    assert sorted(map(tuple, fastx.read_archive(spark, str(tmp_path / "c.tar.gz")).collect())) == [("r1", "note", "ACGT", "IIII", "b"), ("r2", None, "A", "I", "b")]
    assert fastx.checked_names(["/x/s1.fq", "s2.fq.gz"]) == {"s1": "/x/s1.fq", "s2": "s2.fq.gz"}
    for bad in (["a/s1.fq", "b/s1.fq"], ["s 1.fq"], [".fq"]):
        with pytest.raises(ValueError):
            fastx.checked_names(bad)


def test_tables(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("#observation_name\tblast_taxonomy\tblast_subject\tblast_perc_identity\tblast_perc_query_coverage\tblast_evalue\tblast_aln_length\no1\tA;B\tx\t99.5\t100\t0\t20\n")
    (tmp_path / "old.tsv").write_text("#OTU\tSubject_taxonomy\tBlast_subject\tPrct_identity\tPrct_query_coverage\te-value\tAlignment_length\no1\tA;B\tx\t99.5\t100\t0\t20\n")
    for name in ("h.tsv", "old.tsv"):
        r = tables.read_multi_hits(spark, str(tmp_path / name)).first()
        assert r["obs_id"] == "o1" and r["affs"][0]["taxonomy"] == ["A", "B"] and r["affs"][0]["identity"] == 99.5
    (tmp_path / "bad.tsv").write_text("OTU\tnot_a_column\no1\tx\n")
    with pytest.raises(ValueError):
        tables.read_multi_hits(spark, str(tmp_path / "bad.tsv"))
    (tmp_path / "r.tsv").write_text("s1\ta\n\ns2\tb\n")
    assert tables.read_replicates(spark, str(tmp_path / "r.tsv")).count() == 2
    with pytest.raises(ValueError):
        tables.read_replicates(spark, str(tmp_path / "r.tsv"), spark.createDataFrame([("s1",)], "sample_id string"))
    (tmp_path / "rdp.tsv").write_text("o1\t\tRoot\trootrank\t1.0\tBacteria\tdomain\t0.9\tX\tgenus\t0.5\n")
    assert tuple(tables.read_rdp(spark, str(tmp_path / "rdp.tsv")).first()) == ("o1", ["Bacteria", "X"], [0.9, 0.5])
    (tmp_path / "a.sam").write_text("@HD\nq\t0\tt\t1\t9\t2D4M\t*\t0\t0\tACGT\t*\tAS:i:9\tNM:i:3\nq\t0\tu\t1\t9\t4M\t*\t0\t0\tACGT\t*\tAS:i:5\tNM:i:2\n")
    s = tables.read_sam(spark, str(tmp_path / "a.sam")).collect()
    assert [(x["sseqid"], x["pident"]) for x in s] == [("t", 75.0)]
    (tmp_path / "c.txt").write_text("a_3 b_1\nc_2\n")
    assert {tuple(x) for x in tables.composition(spark, str(tmp_path / "c.txt")).collect()} == {(1, 0, "a"), (1, 1, "b"), (2, 0, "c")}
    (tmp_path / "x.txt").write_text("# no\no1 why\no2\n")
    assert {x[0] for x in tables.read_excluded(spark, str(tmp_path / "x.txt")).collect()} == {"o1", "o2"}


def test_newick(spark, tmp_path):
    (tmp_path / "t.nwk").write_text("((a:1,b:2)x:0.5,c:3);")
    rows = {(r["parent"], r["node"], r["length"], r["leaf"]) for r in newick.read_newick(spark, str(tmp_path / "t.nwk")).collect()}
    assert ("x", "a", 1.0, True) in rows and ("x", "b", 2.0, True) in rows and any(n == "x" and d == 0.5 and not leaf for _, n, d, leaf in rows)
    assert newick.written([(("A", "B"), {"s": 1}), (("A", "C"), None)]) == '(("B":{"s": 1},"C")"A")"root";'


def test_newick_names_of_closed_nodes(spark):
    got = newick.parsed("((a,b),c,(d,e)c2:1,(f)'c''3'[note])r;")
    leaves = sorted(n for _, n, _, leaf in got if leaf)
    assert leaves == ["a", "b", "c", "d", "e", "f"]
    up = {n: p for p, n, _, leaf in got if leaf}
    assert up["d"] == "c2" and up["c"] == "r" and up["f"] == "c'3" and up["a"].startswith("#")


def test_fasta_marks_inside_lines(spark, tmp_path):
    (tmp_path / "s.fasta").write_text(">a desc x>y more\nACGT\r\nAC>GT\n>b\n\nTT\n")
    got = sorted((r["seq_id"], r["description"], r["sequence"]) for r in fastx.read_fasta(spark, str(tmp_path / "s.fasta")).collect())
    assert got == [("a", "desc x>y more", "ACGTAC>GT"), ("b", None, "TT")]


def test_wide_table(spark):
    obs = spark.createDataFrame([("o1", "x"), ("o2", None)], "obs_id string, note string")
    ab = spark.createDataFrame([("o1", "s1", 2)], "obs_id string, sample_id string, count long")
    got = {tuple(r) for r in sinks.wide_table(obs, ab, ["s1"], {"note": F.col("note")}).collect()}
    assert got == {("x", "o1", 2, 2), ("no data", "o2", 0, 0)}


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "in"
    rows = spark.createDataFrame([("ACGT", "s", 1, 1), ("ACGT", "s", 2, 1), ("T", "t", 3, 1)], "sequence string, sample_id string, seq_id long, size int")
    rows.repartition(2).write.parquet(str(src))
    q = stream.to_table(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(src)), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination()
    assert {tuple(r) for r in stream.table(spark, str(tmp_path / "out")).collect()} == {tuple(r) for r in stream.counts(rows).collect()}
