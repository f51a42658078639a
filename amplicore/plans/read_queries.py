"""Queries on reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from amplicore.functions import sequences as S
from amplicore.operators import reads as R
from amplicore.plans.bridge import reads, table
from amplicore.plans.registry import query

BARCODES = [("s1", "acgt"), ("s2", "ccgg"), ("s3", "ttaa"), ("s4", "gatc")]
_LETTERS, _ACGT = "abcdefghijklmnopqrstuvwxyz", "acgtacgtacgtacgtacgtacgtac"
_SEQ_SQL = f"q AS (SELECT doc_id AS seq_id, source AS sample_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{_LETTERS}', '{_ACGT}') AS sequence FROM documents)"


def _dna(spark, sf_dir):
    """Whole texts as reads: each of their letters stands for a base."""
    seq = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), _LETTERS, _ACGT)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq_id"), F.col("source").alias("sample_id"), seq.alias("sequence"), F.lit(1).alias("size"))


def _reads(spark, sf_dir):
    return reads(spark, sf_dir).withColumn("size", F.lit(1))


@query("read_length_filter", "SELECT doc_id AS seq_id, CAST(length(text) AS BIGINT) AS length FROM documents WHERE length(text) BETWEEN 500 AND 3000")
def read_length_filter(spark, sf_dir):
    r = R.failing(_reads(spark, sf_dir), R.filter_tests(500, 3000, 10**9))
    return r.where("reason is null").select("seq_id", F.length("sequence").cast("long").alias("length"))


@query("read_n_filter", "SELECT doc_id AS seq_id, CAST(length(text) - length(translate(text, 'Nn', '')) AS BIGINT) AS n FROM documents WHERE length(text) - length(translate(text, 'Nn', '')) <= 100")
def read_n_filter(spark, sf_dir):
    r = R.failing(_reads(spark, sf_dir), R.filter_tests(0, 10**9, 100))
    return r.where("reason is null").select("seq_id", S.ambiguous(F.col("sequence")).cast("long").alias("n"))


_RUNS = "|".join(f"{c}{{5,}}|{c}{{4,}}$" for c in "acgt")


@query("read_homopolymer", f"WITH {_SEQ_SQL} SELECT seq_id, sequence FROM q WHERE NOT regexp_matches(sequence, '{_RUNS}')")
def read_homopolymer(spark, sf_dir):
    return _dna(spark, sf_dir).where(~S.long_homopolymer(F.col("sequence"), 3)).select("seq_id", "sequence")


@query("read_quality_filter", "SELECT doc_id AS seq_id FROM documents WHERE NOT regexp_matches(regexp_replace(translate(text, 'xq', '!!'), '[^!]', 'H', 'g'), '^!|!H{0,5}!')")
def read_quality_filter(spark, sf_dir):
    q = F.translate("text", "xq", "!!")
    return table(spark, sf_dir, "documents").where(~S.poor_quality(q, 1, 5)).select(F.col("doc_id").alias("seq_id"))


_CASCADE = f"""{_SEQ_SQL}, j AS (SELECT *, CASE WHEN NOT contains(sequence, 'ac') THEN 'tag' WHEN length(replace(sequence, 'gg', '')) NOT BETWEEN 400 AND 3000 THEN 'length'
WHEN regexp_matches(sequence, '{_RUNS}') THEN 'homopolymer' END AS reason FROM q)"""


def _cascade(spark, sf_dir):
    seq = F.col("sequence")
    tests = {"tag": ~seq.contains("ac"), "length": ~F.length(F.replace(seq, F.lit("gg"), F.lit(""))).between(400, 3000), "homopolymer": S.long_homopolymer(seq, 3)}
    return R.failing(_dna(spark, sf_dir), tests)


@query("read_filter_cascade", f"WITH {_CASCADE} SELECT seq_id, coalesce(reason, 'kept') AS reason FROM j")
def read_filter_cascade(spark, sf_dir):
    return _cascade(spark, sf_dir).select("seq_id", F.coalesce("reason", F.lit("kept")).alias("reason"))


@query("read_funnel", f"WITH {_CASCADE} SELECT sample_id, coalesce(reason, 'kept') AS reason, count(*) AS reads FROM j GROUP BY 1, 2")
def read_funnel(spark, sf_dir):
    return R.funnel(_cascade(spark, sf_dir))


@query("reverse_complement", f"WITH {_SEQ_SQL} SELECT seq_id, reverse(translate(sequence, 'acgt', 'tgca')) AS sequence FROM q")
def reverse_complement(spark, sf_dir):
    return _dna(spark, sf_dir).select("seq_id", S.reverse_complement(F.col("sequence")).alias("sequence"))


@query("combine_split_roundtrip", f"""WITH {_SEQ_SQL} SELECT CAST(seq_id AS VARCHAR) AS name, sequence AS "first", substr(sequence, 9, 16) AS "second", length(substr(sequence, 9, 16)) + length(sequence) + 4 AS length FROM q""")
def combine_split_roundtrip(spark, sf_dir):
    d = _dna(spark, sf_dir)
    one = d.select(F.concat(F.col("seq_id").cast("string"), F.lit("/1")).alias("seq_id"), "sequence")
    two = d.select(F.concat(F.col("seq_id").cast("string"), F.lit("/2")).alias("seq_id"), F.substr("sequence", F.lit(9), F.lit(16)).alias("sequence"))
    both = R.combined(R.paired(one, two), "XXXX")
    return R.split_pairs(both.withColumn("length", F.length("sequence")), "XXXX").join(both.select(F.regexp_replace("seq_id", "_combined$", "").alias("name"), F.length("sequence").cast("long").alias("length")), "name")


@query("replace_tag", f"WITH {_SEQ_SQL} SELECT seq_id, replace(sequence, 'acg', 'NNN') AS sequence FROM q")
def replace_tag(spark, sf_dir):
    return _dna(spark, sf_dir).select("seq_id", S.tags_to_n(F.col("sequence"), "acg").alias("sequence"))


@query("primer_trim", f"WITH {_SEQ_SQL} SELECT seq_id, regexp_extract(upper(sequence), '^.*?[ACN][GTN][AGN](.+?)[CTN][ACGTN][GN]', 1) AS sequence FROM q WHERE regexp_matches(upper(sequence), '^.*?[ACN][GTN][AGN](.+?)[CTN][ACGTN][GN]')")
def primer_trim(spark, sf_dir):
    return R.trimmed(_dna(spark, sf_dir).withColumn("sequence", F.upper("sequence")), "MKR", "YNG").select("seq_id", "sequence")


@query("quality_offset", "SELECT doc_id AS seq_id, CASE WHEN doc_id % 3 = 0 THEN 33 WHEN doc_id % 3 = 1 THEN 64 END AS q_offset FROM documents")
def quality_offset(spark, sf_dir):
    q = F.when(F.col("doc_id") % 3 == 0, "II#I").when(F.col("doc_id") % 3 == 1, "hhBh").otherwise("IIII")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq_id"), S.quality_offset(q).alias("q_offset"))


@query("dereplicate", "SELECT md5(text) AS digest, min(doc_id) FILTER (source = s) AS seq_id, count(*) AS size FROM (SELECT *, min(source) OVER (PARTITION BY text) AS s FROM documents) GROUP BY text")
def dereplicate(spark, sf_dir):
    heads, _ = R.dereplicated(_reads(spark, sf_dir))
    return heads.select(F.md5(F.col("sequence").cast("binary")).alias("digest"), "seq_id", "size")


_DEREP = "d AS (SELECT text, source AS sample_id, count(*) AS n FROM documents GROUP BY 1, 2), h AS (SELECT text, min(doc_id) FILTER (source = s) AS seq_id FROM (SELECT *, min(source) OVER (PARTITION BY text) AS s FROM documents) GROUP BY 1)"


@query("dereplicate_counts", f"WITH {_DEREP} SELECT seq_id, sample_id, n AS count FROM d JOIN h USING (text)")
def dereplicate_counts(spark, sf_dir):
    return R.dereplicated(_reads(spark, sf_dir))[1]


@query("split_by_sample", f"WITH {_DEREP} SELECT sample_id, seq_id, md5(text) AS digest, n AS size FROM d JOIN h USING (text)")
def split_by_sample(spark, sf_dir):
    out = R.split_samples(*R.dereplicated(_reads(spark, sf_dir)))
    return out.select("sample_id", "seq_id", F.md5(F.col("sequence").cast("binary")).alias("digest"), "size")


@query("rename_by_abundance", "WITH h AS (SELECT text, min(doc_id) FILTER (source = s) AS seq_id, count(*) AS size FROM (SELECT *, min(source) OVER (PARTITION BY text) AS s FROM documents) GROUP BY 1) SELECT 'Cluster_' || row_number() OVER (ORDER BY size DESC, seq_id DESC) AS cluster, seq_id, size FROM h")
def rename_by_abundance(spark, sf_dir):
    return R.renamed_by_size(R.dereplicated(_reads(spark, sf_dir))[0])


@query("length_histogram", "SELECT CAST(length(text) AS BIGINT) AS length, count(*) AS reads FROM documents GROUP BY 1")
def length_histogram(spark, sf_dir):
    return R.length_histogram(_reads(spark, sf_dir))


_MEMBERS = "m AS (SELECT p_brand AS cluster, p_partkey AS seq_id FROM part), c AS (SELECT l_partkey AS seq_id, l_returnflag AS sample_id, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2)"


def _counts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("seq_id"), F.col("l_returnflag").alias("sample_id")).agg(F.sum("l_quantity").cast("long").alias("count"))


@query("cluster_counts", f"WITH {_MEMBERS} SELECT cluster, sample_id, CAST(sum(n) AS BIGINT) AS count FROM m JOIN c USING (seq_id) GROUP BY 1, 2")
def cluster_counts(spark, sf_dir):
    return R.cluster_counts(table(spark, sf_dir, "part").select(F.col("p_brand").alias("cluster"), F.col("p_partkey").alias("seq_id")), _counts(spark, sf_dir))


@query("cluster_flatten", "SELECT p_type AS cluster, p_partkey AS seq_id FROM part")
def cluster_flatten(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    sub = F.concat_ws("/", "p_type", "p_brand")
    return R.flattened(p.select(F.col("p_type").alias("cluster"), sub.alias("sub")).distinct(), p.select(sub.alias("sub"), F.col("p_partkey").alias("seq_id")))


@query("cluster_seeds", f"WITH {_MEMBERS}, h AS (SELECT seq_id, sum(n) AS size FROM c GROUP BY 1) SELECT cluster, arg_min(seq_id, seq_id) AS seed, CAST(sum(size) AS BIGINT) AS size FROM m JOIN h USING (seq_id) GROUP BY 1")
def cluster_seeds(spark, sf_dir):
    members = table(spark, sf_dir, "part").select(F.col("p_brand").alias("cluster"), F.col("p_partkey").alias("ord"), F.col("p_partkey").alias("seq_id"))
    return R.seeds(members, _counts(spark, sf_dir).groupBy("seq_id").agg(F.sum("count").alias("size")))


def _mm(seq: str, code: str) -> str:
    return " + ".join(f"CAST(substr({seq}, {i + 1}, 1) <> '{c}' AS INTEGER)" for i, c in enumerate(code))


def _demux_sql(seq: str, codes: list[tuple[str, str]], most: int) -> str:
    held = ", ".join(f"{_mm(seq, c)} AS m{i}" for i, (_, c) in enumerate(codes))
    least = "least(" + ", ".join(f"m{i}" for i in range(len(codes))) + ")"
    same = " + ".join(f"CAST(m{i} = {least} AS INTEGER)" for i in range(len(codes)))
    pick = " ".join(f"WHEN m{i} = {least} THEN '{s}'" for i, (s, _) in enumerate(codes))
    return f"SELECT *, CASE WHEN {least} > {most} THEN 'unmatched' WHEN {same} > 1 THEN 'ambiguous' {pick} END AS barcode FROM (SELECT *, {held} FROM q)"


_DEMUX = f"WITH {_SEQ_SQL}, x AS ({_demux_sql('sequence', BARCODES, 1)})"


def _codes(spark):
    return spark.createDataFrame(BARCODES, "sample_id string, barcode string")


@query("demultiplex_hamming", f"{_DEMUX} SELECT seq_id, barcode FROM x")
def demultiplex_hamming(spark, sf_dir):
    return R.demultiplexed(_dna(spark, sf_dir), _codes(spark), 1).select("seq_id", "barcode")


@query("demultiplex_summary", f"{_DEMUX} SELECT sample, count(barcode) AS reads FROM (SELECT unnest(['s1', 's2', 's3', 's4', 'unmatched', 'ambiguous']) AS sample) LEFT JOIN x ON barcode = sample GROUP BY 1")
def demultiplex_summary(spark, sf_dir):
    return R.demultiplex_summary(R.demultiplexed(_dna(spark, sf_dir), _codes(spark), 1), _codes(spark))


@query("demultiplex_trim", f"{_DEMUX} SELECT seq_id, CASE WHEN barcode IN ('unmatched', 'ambiguous') THEN sequence ELSE substr(sequence, 5) END AS sequence FROM x")
def demultiplex_trim(spark, sf_dir):
    return R.cut_barcode(R.demultiplexed(_dna(spark, sf_dir), _codes(spark), 1), 4).select("seq_id", "sequence")


_TAIL = _demux_sql("right(sequence, 4)", BARCODES, 1)


@query("demultiplex_double", f"{_DEMUX}, y AS (SELECT seq_id, barcode AS rev FROM ({_TAIL})) SELECT seq_id, CASE WHEN barcode IN ('unmatched', 'ambiguous') THEN barcode WHEN rev IN ('unmatched', 'ambiguous') THEN rev ELSE barcode || '-' || rev END AS sample FROM x JOIN y USING (seq_id)")
def demultiplex_double(spark, sf_dir):
    one = R.demultiplexed(_dna(spark, sf_dir), _codes(spark), 1).withColumnRenamed("barcode", "fwd")
    two = R.demultiplexed(one, _codes(spark), 1, end=True)
    lost = lambda c: F.col(c).isin("unmatched", "ambiguous")
    return two.select("seq_id", F.when(lost("fwd"), F.col("fwd")).when(lost("barcode"), F.col("barcode")).otherwise(F.concat_ws("-", "fwd", "barcode")).alias("sample"))


@query("demultiplex_accounting", f"{_DEMUX} SELECT count(*) AS before, count(*) FILTER (barcode <> 'unmatched') AS matched, count(*) FILTER (barcode NOT IN ('unmatched', 'ambiguous')) AS unambiguous FROM x")
def demultiplex_accounting(spark, sf_dir):
    x = R.demultiplexed(_dna(spark, sf_dir), _codes(spark), 1)
    return x.agg(F.count("*").alias("before"), F.count_if(F.col("barcode") != "unmatched").alias("matched"), F.count_if(~F.col("barcode").isin("unmatched", "ambiguous")).alias("unambiguous"))


@query("demultiplex_rad", f"{_DEMUX} SELECT seq_id, CASE WHEN barcode IN ('unmatched', 'ambiguous') THEN barcode WHEN len(regexp_extract_all(sequence, 'tgc')) = 0 THEN 'unmatched' WHEN len(regexp_extract_all(sequence, 'tgc')) > 1 THEN barcode || '_2rad' ELSE barcode END AS barcode FROM x")
def demultiplex_rad(spark, sf_dir):
    return R.rad_label(R.demultiplexed(_dna(spark, sf_dir), _codes(spark), 1), "tgc").select("seq_id", "barcode")


_JOINED_SQL = "j AS (SELECT doc_id, 'r' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '_combined' ELSE '' END AS seq_id, lang AS description, CASE WHEN doc_id % 2 = 0 THEN upper(sequence) || repeat('N', 100) || upper(sequence) ELSE upper(sequence) END AS sequence FROM q JOIN (SELECT doc_id, lang FROM documents) ON doc_id = q.seq_id)"


def _joined(spark, sf_dir):
    d = _dna(spark, sf_dir).join(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq_id"), "lang"), "seq_id")
    even, seq = F.col("seq_id") % 2 == 0, F.upper("sequence")
    name = F.concat(F.lit("r"), F.col("seq_id").cast("string"), F.when(even, "_combined").otherwise(""))
    return d.select(name.alias("seq_id"), F.col("lang").alias("description"), F.when(even, F.concat(seq, F.repeat(F.lit("N"), F.lit(100)), seq)).otherwise(seq).alias("sequence"))


@query("fillers_hidden", f"""WITH {_SEQ_SQL}, {_JOINED_SQL} SELECT seq_id, CASE WHEN doc_id % 2 = 0 AND sequence IS NOT NULL THEN coalesce(description, '') || '50A50C:' || ((length(sequence) - 100) // 2) || ':' || ((length(sequence) - 100) // 2 + 99) ELSE description END AS description,
replace(sequence, repeat('N', 100), repeat('A', 50) || repeat('C', 50)) AS sequence FROM j""")
def fillers_hidden(spark, sf_dir):
    return R.fillers_hidden(_joined(spark, sf_dir))


@query("fillers_round_trip", f"WITH {_SEQ_SQL}, {_JOINED_SQL} SELECT seq_id, sequence FROM j")
def fillers_round_trip(spark, sf_dir):
    return R.fillers_restored(R.fillers_hidden(_joined(spark, sf_dir))).select("seq_id", "sequence")


@query("split_by_filler", f"WITH {_SEQ_SQL}, {_JOINED_SQL} SELECT doc_id % 2 = 0 AND sequence IS NOT NULL AS joined, count(*) AS reads, CAST(sum(length(sequence)) AS BIGINT) AS letters FROM j GROUP BY 1")
def split_by_filler(spark, sf_dir):
    whole, joined = R.by_filler(_joined(spark, sf_dir))
    both = whole.withColumn("joined", F.lit(False)).union(joined.withColumn("joined", F.lit(True)))
    return both.groupBy("joined").agg(F.count("*").alias("reads"), F.sum(F.length("sequence")).alias("letters"))


@query("read_chunks", "SELECT count(*) AS reads, count(DISTINCT doc_id) AS ids FROM documents")
def read_chunks(spark, sf_dir):
    parts = R.chunks(_dna(spark, sf_dir), size=100).groupBy("chunk").agg(F.count("*").alias("n"), F.countDistinct("seq_id").alias("ids"))
    return parts.agg(F.sum("n").alias("reads"), F.sum("ids").alias("ids"))


@query("adjusted_length_filter", f"WITH {_SEQ_SQL} SELECT seq_id FROM q WHERE length(sequence) BETWEEN 500 - 14 AND 3000 - 14")
def adjusted_length_filter(spark, sf_dir):
    least, most = R.adjusted_bounds(500, 3000, "ACGTACG", "TTGCAAT")
    return _dna(spark, sf_dir).where(F.length("sequence").between(least, most)).select("seq_id")
