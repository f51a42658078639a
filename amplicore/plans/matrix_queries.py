"""Queries on the count matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from amplicore.operators import matrix as M
from amplicore.plans.bridge import AB_SQL, ABS_SQL, SAMPLE_SQL, abundance, samples, sparse_abundance, table
from amplicore.plans.registry import query

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_REGION_AB = f"{AB_SQL}, {SAMPLE_SQL}, rg AS (SELECT obs_id, grp, CAST(sum(n) AS BIGINT) AS n FROM ab JOIN smp USING (sample_id) GROUP BY 1, 2)"
_TESTS_SQL = f"""{ABS_SQL}, o AS (SELECT obs_id, sum(n) AS total, count(*) AS present FROM abs_ GROUP BY 1),
f AS (SELECT obs_id, 'abundance' AS f FROM o WHERE total < 60 UNION ALL SELECT obs_id, 'presence' FROM o WHERE present < 3 UNION ALL SELECT obs_id, 'size' FROM o WHERE total > 300)"""


def _tests():
    return {"abundance": F.col("total") < 60, "presence": F.col("present") < 3, "size": F.col("total") > 300}


@query("obs_depth_histogram", f"""WITH {ABS_SQL}, t AS (SELECT obs_id, sum(n) AS depth FROM abs_ GROUP BY 1), h AS (SELECT depth, count(*) AS c FROM t GROUP BY 1)
SELECT CAST(d AS BIGINT) AS depth, coalesce(c, 0) AS nb_observ, round(100.0::DOUBLE * coalesce(c, 0) / (SELECT count(*) FROM t), 3) AS pct
FROM (SELECT unnest(generate_series(1, (SELECT max(depth) FROM t)::BIGINT)) AS d) LEFT JOIN h ON depth = d""")
def obs_depth_histogram(spark, sf_dir):
    return M.depth_histogram(sparse_abundance(spark, sf_dir))


@query("matrix_totals", f"""WITH {AB_SQL} SELECT 'observation' AS axis, CAST(obs_id AS VARCHAR) AS key, CAST(sum(n) AS BIGINT) AS total FROM ab GROUP BY obs_id
UNION ALL SELECT 'sample', sample_id, CAST(sum(n) AS BIGINT) FROM ab GROUP BY sample_id UNION ALL SELECT 'all', '', CAST(sum(n) AS BIGINT) FROM ab""")
def matrix_totals(spark, sf_dir):
    return M.totals(abundance(spark, sf_dir))


def _by_region(spark, sf_dir):
    return abundance(spark, sf_dir).join(samples(spark, sf_dir), "sample_id").groupBy("obs_id", F.col("group").alias("sample_id")).agg(F.sum("count").alias("count"))


def _wide_names(df):
    for r in REGIONS:
        df = df.withColumnRenamed(r, r.lower().replace(" ", "_"))
    return df


@query("count_table_wide", f"WITH {_REGION_AB} SELECT obs_id, " + ", ".join(f"CAST(coalesce(sum(n) FILTER (grp = '{r}'), 0) AS BIGINT) AS {r.lower().replace(' ', '_')}" for r in REGIONS) + " FROM rg GROUP BY 1")
def count_table_wide(spark, sf_dir):
    return _wide_names(M.wide(_by_region(spark, sf_dir), REGIONS))


@query("count_table_unpivot", f"WITH {_REGION_AB} SELECT obs_id, grp AS sample_id, n AS count FROM rg")
def count_table_unpivot(spark, sf_dir):
    return M.long(M.wide(_by_region(spark, sf_dir), REGIONS))


@query("merge_samples", f"""WITH {_REGION_AB} SELECT rg.grp AS "group", obs_id, n AS count, h.m AS merge_history FROM rg
JOIN (SELECT grp, string_agg(sample_id, ' AND ' ORDER BY sample_id) AS m FROM smp GROUP BY 1) h ON h.grp = rg.grp""")
def merge_samples(spark, sf_dir):
    return M.merge_samples(abundance(spark, sf_dir), samples(spark, sf_dir))


@query("filter_sample_presence", f"WITH {ABS_SQL} SELECT obs_id, count(*) AS present FROM abs_ GROUP BY 1 HAVING count(*) >= 3")
def filter_sample_presence(spark, sf_dir):
    return M.min_presence(sparse_abundance(spark, sf_dir), 3)


@query("filter_replicate_presence", f"""WITH {ABS_SQL}, {SAMPLE_SQL}, z AS (SELECT grp, count(*) AS size FROM smp GROUP BY 1)
SELECT DISTINCT obs_id FROM (SELECT obs_id, grp, count(DISTINCT sample_id) AS p FROM abs_ JOIN smp USING (sample_id) GROUP BY 1, 2) JOIN z USING (grp) WHERE p >= 0.5 * size""")
def filter_replicate_presence(spark, sf_dir):
    return M.replicate_presence(sparse_abundance(spark, sf_dir), samples(spark, sf_dir), 0.5)


@query("filter_abundance_abs", f"WITH {ABS_SQL} SELECT obs_id, CAST(sum(n) AS BIGINT) AS total FROM abs_ GROUP BY 1 HAVING sum(n) >= 30")
def filter_abundance_abs(spark, sf_dir):
    return M.min_abundance(sparse_abundance(spark, sf_dir), 30)


@query("filter_abundance_ratio", f"WITH {ABS_SQL} SELECT obs_id, CAST(sum(n) AS BIGINT) AS total FROM abs_ GROUP BY 1 HAVING sum(n) >= 0.00005 * (SELECT sum(n) FROM abs_)")
def filter_abundance_ratio(spark, sf_dir):
    return M.min_abundance(sparse_abundance(spark, sf_dir), 0.00005, of_all=True)


@query("filter_count_range", f"WITH {AB_SQL} SELECT obs_id, CAST(sum(n) AS BIGINT) AS total FROM ab GROUP BY 1 HAVING sum(n) BETWEEN 600 AND 900")
def filter_count_range(spark, sf_dir):
    return M.count_range(abundance(spark, sf_dir), 600, 900)


@query("top_n_clusters", f"WITH {AB_SQL}, t AS (SELECT obs_id, CAST(sum(n) AS BIGINT) AS total FROM ab GROUP BY 1) SELECT *, CAST(row_number() OVER (ORDER BY total DESC, obs_id) AS INTEGER) AS rank FROM t QUALIFY rank <= 100")
def top_n_clusters(spark, sf_dir):
    return M.largest(abundance(spark, sf_dir), 100)


@query("reset_replicate_evidence", f"WITH {ABS_SQL}, {SAMPLE_SQL} SELECT obs_id, sample_id, n AS count FROM (SELECT *, count(*) OVER (PARTITION BY obs_id, grp) AS p FROM abs_ JOIN smp USING (sample_id)) WHERE p >= 2")
def reset_replicate_evidence(spark, sf_dir):
    return M.reset_without_replicates(sparse_abundance(spark, sf_dir), samples(spark, sf_dir), 2)


@query("exclusion_table", f"""WITH {_TESTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY obs_id) AS row FROM f)
SELECT row, max(obs_id) FILTER (f = 'abundance') AS abundance, max(obs_id) FILTER (f = 'presence') AS presence, max(obs_id) FILTER (f = 'size') AS size FROM r GROUP BY 1""")
def exclusion_table(spark, sf_dir):
    return M.exclusion_table(M.failures(sparse_abundance(spark, sf_dir), _tests()), list(_tests()))


@query("filter_intersections", f"WITH {_TESTS_SQL} SELECT filters, count(*) AS nb_observ FROM (SELECT obs_id, string_agg(f, ',' ORDER BY f) AS filters FROM f GROUP BY 1) GROUP BY 1")
def filter_intersections(spark, sf_dir):
    return M.intersections(M.failures(sparse_abundance(spark, sf_dir), _tests()))


@query("union_and_remove", f"WITH {_TESTS_SQL} SELECT obs_id, sample_id, n AS count FROM abs_ WHERE obs_id NOT IN (SELECT obs_id FROM f)")
def union_and_remove(spark, sf_dir):
    ab = sparse_abundance(spark, sf_dir)
    return M.without(ab, M.failures(ab, _tests())).select("obs_id", "sample_id", "count")


@query("top_n_after_filters", f"WITH {_TESTS_SQL}, t AS (SELECT obs_id, CAST(sum(n) AS BIGINT) AS total FROM abs_ WHERE obs_id NOT IN (SELECT obs_id FROM f) GROUP BY 1) SELECT *, CAST(row_number() OVER (ORDER BY total DESC, obs_id) AS INTEGER) AS rank FROM t QUALIFY rank <= 50")
def top_n_after_filters(spark, sf_dir):
    ab = sparse_abundance(spark, sf_dir)
    return M.largest(M.without(ab, M.failures(ab, _tests())), 50)


@query("sample_funnel", f"""WITH {_TESTS_SQL} SELECT sample_id, count(*) FILTER (NOT g) AS kept_obs, CAST(coalesce(sum(n) FILTER (NOT g), 0) AS BIGINT) AS kept_reads,
count(*) FILTER (g) AS removed_obs, CAST(coalesce(sum(n) FILTER (g), 0) AS BIGINT) AS removed_reads, coalesce(max(n) FILTER (g), 0) AS max_removed
FROM (SELECT *, obs_id IN (SELECT obs_id FROM f) AS g FROM abs_) GROUP BY 1""")
def sample_funnel(spark, sf_dir):
    ab = sparse_abundance(spark, sf_dir)
    return M.funnel(ab, M.failures(ab, _tests()))


@query("chimera_lenient", f"WITH {ABS_SQL} SELECT obs_id, count(*) FILTER (n <= 10) AS flagged, count(*) AS present FROM abs_ GROUP BY 1 HAVING count(*) FILTER (n <= 10) = count(*)")
def chimera_lenient(spark, sf_dir):
    ab = sparse_abundance(spark, sf_dir)
    return M.chimera_calls(ab, ab.where("count <= 10"), lenient=True)


@query("chimera_strict", f"WITH {ABS_SQL} SELECT obs_id, count(*) FILTER (n <= 10) AS flagged, count(*) AS present FROM abs_ GROUP BY 1 HAVING count(*) FILTER (n <= 10) > 0")
def chimera_strict(spark, sf_dir):
    ab = sparse_abundance(spark, sf_dir)
    return M.chimera_calls(ab, ab.where("count <= 10"), lenient=False)


@query("own_vs_shared", f"""WITH {ABS_SQL} SELECT sample_id, count(*) FILTER (k = 1) AS own_obs, count(*) FILTER (k > 1) AS shared_obs,
CAST(coalesce(sum(n) FILTER (k = 1), 0) AS BIGINT) AS own_reads, CAST(coalesce(sum(n) FILTER (k > 1), 0) AS BIGINT) AS shared_reads
FROM (SELECT *, count(*) OVER (PARTITION BY obs_id) AS k FROM abs_) GROUP BY 1""")
def own_vs_shared(spark, sf_dir):
    return M.own_and_shared(sparse_abundance(spark, sf_dir))


@query("cpm_normalise", f"WITH {AB_SQL} SELECT obs_id, sample_id, round(n::DOUBLE / sum(n) OVER (PARTITION BY sample_id)::DOUBLE * 1e6, 6) AS cpm FROM ab")
def cpm_normalise(spark, sf_dir):
    return M.cpm(abundance(spark, sf_dir))


@query("threshold_sweep", """WITH v AS (SELECT l_tax, CAST(l_quantity AS BIGINT) AS q FROM lineitem), t AS (SELECT unnest(generate_series(0, 4)) AS k)
SELECT round(k * 0.02::DOUBLE, 6) AS threshold, count(l_tax) AS nb_observ, CAST(coalesce(sum(q), 0) AS BIGINT) AS reads FROM t LEFT JOIN v ON l_tax <= round(k * 0.02::DOUBLE, 6) GROUP BY k""")
def threshold_sweep(spark, sf_dir):
    v = table(spark, sf_dir, "lineitem").select("l_tax", F.col("l_quantity").cast("long").alias("q"))
    return M.threshold_sweep(v, "l_tax", "q", 0.02, 4)


@query("hierarchy_join_na", f"""WITH {AB_SQL} SELECT coalesce(p_name, 'NA') AS label, CAST(sum(n) AS BIGINT) AS total, round(sum(n)::DOUBLE / 4, 6) AS quarter
FROM ab LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON obs_id = p_partkey GROUP BY 1""")
def hierarchy_join_na(spark, sf_dir):
    dim = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("obs_id"), F.col("p_name").alias("label"))
    sums = M.labelled(abundance(spark, sf_dir), dim, "obs_id", "label").groupBy("label").agg(F.sum("count").alias("total"))
    return sums.select("label", "total", F.round(F.col("total") / 4, 6).alias("quarter"))


@query("normalisation_report", f"""WITH {ABS_SQL} SELECT sample_id, count(*) AS before, count(*) FILTER (n >= 10) AS after FROM abs_ GROUP BY 1""")
def normalisation_report(spark, sf_dir):
    ab = sparse_abundance(spark, sf_dir)
    return M.normalisation_report(ab, ab.where("count >= 10"))


@query("keep_survivors", f"WITH {_TESTS_SQL} SELECT o_orderkey AS obs_id, o_orderstatus AS sequence FROM orders WHERE o_orderkey IN (SELECT obs_id FROM abs_ WHERE obs_id NOT IN (SELECT obs_id FROM f))")
def keep_survivors(spark, sf_dir):
    ab = sparse_abundance(spark, sf_dir)
    records = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("obs_id"), F.col("o_orderstatus").alias("sequence"))
    return M.only(records, M.without(ab, M.failures(ab, _tests())))


@query("function_filter", """SELECT p_partkey AS obs_id, array_to_string(list_filter([CASE WHEN p_retailprice < 950 THEN 'min_blast_identity' END, CASE WHEN p_size < 10 THEN 'min_blast_coverage' END,
CASE WHEN p_size > 40 THEN 'max_nsti' END], lambda x: x IS NOT NULL), ',') AS reasons FROM part WHERE p_retailprice < 950 OR p_size < 10 OR p_size > 40""")
def function_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    refs = p.select(F.col("p_partkey").alias("obs_id"), F.col("p_retailprice").alias("identity"), F.col("p_size").alias("coverage"), F.col("p_size").alias("nsti"))
    M.check_nsti(refs, 40)
    return M.function_failures(refs, 950, 10, 40).select("obs_id", F.col("parameters").alias("reasons"))


_FOUND_SQL = "fnd AS (SELECT o_orderkey AS obs_id, CASE o_orderstatus WHEN 'F' THEN 'ITS1' WHEN 'O' THEN 'ITS2' ELSE 'no_detections' END AS detection FROM orders)"


def _found(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "F", "ITS1").when(F.col("o_orderstatus") == "O", "ITS2").otherwise("no_detections")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("obs_id"), kind.alias("detection"))


@query("its_filter", f"WITH {ABS_SQL}, {_FOUND_SQL} SELECT DISTINCT obs_id FROM abs_ WHERE obs_id NOT IN (SELECT obs_id FROM fnd WHERE detection = 'ITS1')")
def its_filter(spark, sf_dir):
    return M.its_failures(sparse_abundance(spark, sf_dir), _found(spark, sf_dir), "ITS1", preserve=False)


@query("its_filter_preserve", f"WITH {ABS_SQL}, {_FOUND_SQL} SELECT DISTINCT obs_id FROM abs_ WHERE obs_id IN (SELECT obs_id FROM fnd WHERE detection = 'no_detections')")
def its_filter_preserve(spark, sf_dir):
    return M.its_failures(sparse_abundance(spark, sf_dir), _found(spark, sf_dir), "ITS1", preserve=True)


@query("absent_from_tree", "SELECT p_partkey AS seq_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def absent_from_tree(spark, sf_dir):
    tree = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("node"), (F.col("l_quantity") > 49).alias("leaf"))
    return M.absent_from_tree(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("seq_id")), tree)
