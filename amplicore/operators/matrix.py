"""Operators on the count matrix (obs_id, sample_id, count): totals, filters, reports.

The matrix is long; cells of count 0 are not stored. Each operator is one aggregation by observation or sample, partly
aggregated before its shuffle, so a hot observation never meets in one task cell by cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amplicore.operators.numbering import numbered


#: Depths of a histogram that one row expands to.
DEPTHS = 1 << 16


def totals(ab: DataFrame) -> DataFrame:
    """axis, key, total: by observation, by sample, and the grand total, in one pass over the matrix."""
    sets = ab.groupingSets([["obs_id"], ["sample_id"], []], "obs_id", "sample_id").agg(F.sum("count").alias("total"), F.grouping_id().alias("g"))
    axis = F.when(F.col("g") == 1, "observation").when(F.col("g") == 2, "sample").otherwise("all")
    return sets.select(axis.alias("axis"), F.coalesce(F.col("obs_id").cast("string"), F.col("sample_id"), F.lit("")).alias("key"), "total")


def depth_histogram(ab: DataFrame) -> DataFrame:
    """depth, nb_observ, pct: how many observations have each total from 1 to the largest, empty depths too; the share has three places.

    The depths are made block by block, each in its own row, however deep the largest is."""
    counts = ab.groupBy("obs_id").agg(F.sum("count").alias("depth")).where("depth > 0").groupBy("depth").agg(F.count("*").alias("n"))
    whole = counts.agg(F.max("depth").alias("most"), F.sum("n").alias("all"))
    blocks = whole.where("most is not null").select(F.explode(F.sequence(F.lit(1).cast("long"), "most", F.lit(DEPTHS).cast("long"))).alias("from"), "most", "all")
    depths = blocks.repartition(ab.sparkSession.sparkContext.defaultParallelism, "from").select(F.explode(F.sequence("from", F.least("most", F.col("from") + DEPTHS - 1))).alias("depth"), "all")
    out = depths.join(counts, "depth", "left").withColumn("nb_observ", F.coalesce("n", F.lit(0)))
    return out.select("depth", "nb_observ", F.round(100 * F.col("nb_observ") / F.col("all"), 3).alias("pct"))


def wide(ab: DataFrame, samples: list[str], key: str = "obs_id", column: str = "sample_id") -> DataFrame:
    """A column for each named sample, 0 where there is no cell. The names are given, so there is no second pass to find them."""
    return ab.groupBy(key).pivot(column, samples).agg(F.sum("count")).na.fill(0)


def long(table: DataFrame, key: str = "obs_id", column: str = "sample_id") -> DataFrame:
    """The inverse of wide; cells of 0 go."""
    return table.unpivot([key], [c for c in table.columns if c != key], column, "count").where("count <> 0")


def merge_samples(ab: DataFrame, groups: DataFrame) -> DataFrame:
    """obs_id, group, count, merge_history: samples of a group become one; history: their names in order, joined by AND."""
    history = groups.groupBy("group").agg(F.array_join(F.array_sort(F.collect_set("sample_id")), " AND ").alias("merge_history"))
    summed = ab.join(groups, "sample_id").groupBy("obs_id", "group").agg(F.sum("count").alias("count"))
    return summed.join(history, "group")


def by_observation(ab: DataFrame) -> DataFrame:
    """obs_id, total, present (samples in which it stands)."""
    return ab.groupBy("obs_id").agg(F.sum("count").alias("total"), F.count_if(F.col("count") > 0).alias("present"))


def min_presence(ab: DataFrame, least: int) -> DataFrame:
    return by_observation(ab).where(F.col("present") >= least).select("obs_id", "present")


def replicate_presence(ab: DataFrame, groups: DataFrame, share: float) -> DataFrame:
    """obs_id of observations present in at least share of the samples of some group; a group without presence doesn't count, so share 0 keeps only what is present somewhere."""
    sizes = groups.groupBy("group").agg(F.countDistinct("sample_id").alias("size"))
    seen = ab.where("count > 0").join(groups, "sample_id").groupBy("obs_id", "group").agg(F.countDistinct("sample_id").alias("present"))
    return seen.join(sizes, "group").where(F.col("present") >= share * F.col("size")).select("obs_id").distinct()


def min_abundance(ab: DataFrame, least: float, of_all: bool = False) -> DataFrame:
    """obs_id, total of observations with at least so many reads, or such a share of all reads."""
    sums = ab.groupBy("obs_id").agg(F.sum("count").alias("total"))
    if not of_all:
        return sums.where(F.col("total") >= least)
    return sums.crossJoin(F.broadcast(ab.agg(F.sum("count").alias("all")))).where(F.col("total") >= least * F.col("all")).select("obs_id", "total")  # one row, so no cross product


def count_range(ab: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    sums = ab.groupBy("obs_id").agg(F.sum("count").alias("total"))
    keep = F.lit(True) if low is None else F.col("total") >= low
    return sums.where(keep if high is None else keep & (F.col("total") <= high))


def largest(ab: DataFrame, n: int, tie: Column | None = None) -> DataFrame:
    """obs_id, total, rank of the n largest observations; ties by tie (the id). A top-k: each task keeps n rows."""
    top = ab.groupBy("obs_id").agg(F.sum("count").alias("total")).orderBy(F.desc("total"), tie if tie is not None else F.col("obs_id")).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total"), tie if tie is not None else F.col("obs_id"))))


def reset_without_replicates(ab: DataFrame, groups: DataFrame, least: int) -> DataFrame:
    """The cells that stay: those of groups in which their observation stands in at least so many samples; samples of no group stay."""
    seen = ab.join(groups, "sample_id", "left")
    enough = seen.where(F.col("group").isNotNull() & (F.col("count") > 0)).groupBy("obs_id", "group").agg(F.count("*").alias("present")).where(F.col("present") >= least)
    return seen.join(enough, ["obs_id", "group"], "left").where(F.col("group").isNull() | F.col("present").isNotNull()).select("obs_id", "sample_id", "count")


def without(ab: DataFrame, excluded: DataFrame, key: str = "obs_id") -> DataFrame:
    return ab.join(excluded.select(key).distinct(), key, "left_anti")


def only(rows: DataFrame, kept: DataFrame, key: str = "obs_id") -> DataFrame:
    return rows.join(kept.select(key), key, "left_semi")


def failures(ab: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """obs_id, filter: a row for each test that an observation fails. tests: columns over by_observation, true where it fails."""
    failed = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in tests.items()]), lambda x: x.isNotNull())
    return by_observation(ab).select("obs_id", F.explode(failed).alias("filter"))


def intersections(failed: DataFrame) -> DataFrame:
    """filters (sorted, joined by commas), nb_observ: how many observations fail just these tests."""
    sets = failed.groupBy("obs_id").agg(F.array_join(F.array_sort(F.collect_set("filter")), ",").alias("filters"))
    return sets.groupBy("filters").agg(F.count("*").alias("nb_observ"))


def exclusion_table(failed: DataFrame, names: list[str]) -> DataFrame:
    """row and a column for each filter: its k-th excluded observation stands in row k."""
    return numbered(failed.select("filter", "obs_id"), [F.asc("obs_id")], "row", ["filter"]).groupBy("row").pivot("filter", names).agg(F.first("obs_id"))


def funnel(ab: DataFrame, removed: DataFrame) -> DataFrame:
    """By sample: observations and reads kept and removed, and the largest removed count."""
    gone = ab.join(removed.select("obs_id").distinct().withColumn("gone", F.lit(True)), "obs_id", "left").withColumn("gone", F.coalesce("gone", F.lit(False)))
    zero = F.lit(0).cast("long")
    return gone.groupBy("sample_id").agg(
        F.count_if(~F.col("gone")).alias("kept_obs"), F.coalesce(F.sum(F.when(~F.col("gone"), F.col("count"))), zero).alias("kept_reads"),
        F.count_if("gone").alias("removed_obs"), F.coalesce(F.sum(F.when(F.col("gone"), F.col("count"))), zero).alias("removed_reads"),
        F.coalesce(F.max(F.when(F.col("gone"), F.col("count"))), zero).alias("max_removed"),
    )


def chimera_calls(ab: DataFrame, flagged: DataFrame, lenient: bool) -> DataFrame:
    """obs_id, flagged, present of observations to remove: flagged in every sample that holds them (lenient) or in any."""
    flags = flagged.select("obs_id", "sample_id").distinct().withColumn("flag", F.lit(1))
    seen = ab.where("count > 0").join(flags, ["obs_id", "sample_id"], "left").groupBy("obs_id").agg(F.count("flag").alias("flagged"), F.count("*").alias("present"))
    return seen.where(F.col("flagged") == F.col("present") if lenient else F.col("flagged") > 0)


def own_and_shared(ab: DataFrame) -> DataFrame:
    """By sample: observations and reads that stand in this sample alone, and that others have too."""
    sole = ab.groupBy("obs_id").agg(F.count_if(F.col("count") > 0).alias("samples"))
    both = ab.join(sole, "obs_id").withColumn("own", F.col("samples") == 1)
    zero = F.lit(0).cast("long")
    return both.groupBy("sample_id").agg(
        F.count_if("own").alias("own_obs"), F.count_if(~F.col("own")).alias("shared_obs"),
        F.coalesce(F.sum(F.when(F.col("own"), F.col("count"))), zero).alias("own_reads"), F.coalesce(F.sum(F.when(~F.col("own"), F.col("count"))), zero).alias("shared_reads"),
    )


def cpm(ab: DataFrame) -> DataFrame:
    """Counts per million of their sample's reads."""
    sums = ab.groupBy("sample_id").agg(F.sum("count").alias("all"))
    return ab.join(sums, "sample_id").select("obs_id", "sample_id", F.round(F.col("count") / F.col("all") * 1e6, 6).alias("cpm"))


def threshold_sweep(values: DataFrame, value: str, weight: str, step: float, n: int) -> DataFrame:
    """threshold, nb_observ, reads of rows whose value is at most k * step, for k up to n. Each row counts at its own step once; sums run over the steps only."""
    at = F.greatest(F.lit(0), F.ceil(F.round(F.col(value) / step, 9))).cast("int")
    own = values.groupBy(at.alias("k")).agg(F.count("*").alias("obs"), F.sum(weight).alias("w")).where(F.col("k") <= n)
    grid = values.sparkSession.range(n + 1).select(F.col("id").cast("int").alias("k"))
    up = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    joined = grid.join(own, "k", "left")
    return joined.select(F.round(F.col("k") * step, 6).alias("threshold"), F.coalesce(F.sum("obs").over(up), F.lit(0)).cast("long").alias("nb_observ"), F.coalesce(F.sum("w").over(up), F.lit(0)).cast("long").alias("reads"))


def labelled(rows: DataFrame, dimension: DataFrame, key: str, label: str, missing: str = "NA") -> DataFrame:
    """rows with the dimension's label, or missing where it has none."""
    return rows.join(dimension.select(key, label), key, "left").withColumn(label, F.coalesce(label, F.lit(missing)))


def normalisation_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """By sample: observations before and after; samples that are gone have 0 after."""
    a = before.groupBy("sample_id").agg(F.count("*").alias("before"))
    b = after.groupBy("sample_id").agg(F.count("*").alias("after"))
    return a.join(b, "sample_id", "full").select("sample_id", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))


def its_failures(ab: DataFrame, found: DataFrame, kind: str, preserve: bool) -> DataFrame:
    """obs_id of observations that go after a search for a region. found: obs_id, detection (a region's name, or no_detections).

    Without preserve all go but those found as kind; with it only those without any detection."""
    ids = ab.select("obs_id").distinct()
    if preserve:
        return ids.join(found.where("detection = 'no_detections'"), "obs_id", "left_semi")
    return ids.join(found.where(F.col("detection") == kind), "obs_id", "left_anti")


def function_failures(refs: DataFrame, least_identity: float | None = None, least_coverage: float | None = None, most_nsti: float | None = None) -> DataFrame:
    """obs_id, parameters, values of observations too far from their reference: below a share (identity, coverage) or above an
    nsti, the reasons joined by commas. refs: obs_id, identity, coverage (shares), nsti. Thresholds of 0 or none don't count."""
    tests = [(least_identity, "min_blast_identity", "identity", F.col("identity") < (least_identity or 0)), (least_coverage, "min_blast_coverage", "coverage", F.col("coverage") < (least_coverage or 0)), (most_nsti, "max_nsti", "nsti", F.col("nsti") > (most_nsti or 0))]
    tests = [t for t in tests if t[0]]
    names = F.array_join(F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(bad, p) for _, p, _, bad in tests])), ",")
    values = F.array_join(F.array_compact(F.array(F.lit(None).cast("string"), *[F.when(bad, F.concat(F.lit(f"{c} = "), F.col(c).cast("string"))) for _, _, c, bad in tests])), ",")
    return refs.select("obs_id", names.alias("parameters"), values.alias("values")).where("parameters <> ''")


def check_nsti(refs: DataFrame, most_nsti: float) -> None:
    """An error if the threshold would remove every observation that has an nsti."""
    least = refs.agg(F.min("nsti")).first()[0]
    if least is not None and most_nsti < least:
        raise ValueError(f"an nsti of {most_nsti} at most removes all observations (the least is {least})")


def absent_from_tree(records: DataFrame, tree: DataFrame) -> DataFrame:
    """seq_id of records that are no leaf of the tree. tree: node, leaf."""
    return records.select("seq_id").join(tree.where("leaf").select(F.col("node").alias("seq_id")), "seq_id", "left_anti")
