"""Diversity, distances and differential abundance of the count matrix."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def without_empty(ab: DataFrame) -> DataFrame:
    """Cells above 0: samples and observations without any go."""
    return ab.where("count > 0")


def alpha_diversity(ab: DataFrame) -> DataFrame:
    """By sample: observed, chao1 (bias-corrected), shannon (natural logarithm), inv_simpson; one pass over the cells."""
    n = F.col("count").cast("double")
    sums = ab.where("count > 0").groupBy("sample_id").agg(F.count("*").alias("observed"), F.sum("count").cast("double").alias("N"), F.count_if(F.col("count") == 1).alias("f1"), F.count_if(F.col("count") == 2).alias("f2"), F.sum(n * F.log(n)).alias("nln"), F.sum(n * n).alias("nn"))
    chao = F.col("observed") + F.col("f1") * (F.col("f1") - 1) / (2 * (F.col("f2") + 1))
    return sums.select("sample_id", "observed", F.round(chao.cast("double"), 6).alias("chao1"), F.round(F.log("N") - F.col("nln") / F.col("N"), 6).alias("shannon"), F.round(F.col("N") * F.col("N") / F.col("nn"), 6).alias("inv_simpson"))


def _paired(ab: DataFrame) -> DataFrame:
    """sample_a < sample_b, x, y: cells that both samples have. Observations meet by id; samples of one study are few."""
    cells = ab.where("count > 0")
    a = cells.select("obs_id", F.col("sample_id").alias("sample_a"), F.col("count").cast("double").alias("x"))
    b = cells.select("obs_id", F.col("sample_id").alias("sample_b"), F.col("count").cast("double").alias("y"))
    return a.join(b, "obs_id").where("sample_a < sample_b")


def _pairs_with(ab: DataFrame, shared: list[Column], own: list[Column]) -> DataFrame:
    """All sample pairs with aggregates of their shared cells, and each sample's own aggregates."""
    single = ab.where("count > 0").groupBy("sample_id").agg(*own)
    a = single.select(*[F.col(c).alias(f"a_{c}") for c in single.columns])
    b = single.select(*[F.col(c).alias(f"b_{c}") for c in single.columns])
    pairs = a.join(b, F.col("a_sample_id") < F.col("b_sample_id"))
    met = _paired(ab).groupBy("sample_a", "sample_b").agg(*shared)
    return pairs.join(met, (F.col("a_sample_id") == F.col("sample_a")) & (F.col("b_sample_id") == F.col("sample_b")), "left").withColumn("sample_a", F.col("a_sample_id")).withColumn("sample_b", F.col("b_sample_id"))


def distances(ab: DataFrame, measure: str) -> DataFrame:
    """sample_a, sample_b, d: bray, jaccard (presence), euclidean, manhattan or canberra.

    Sums over the union of two samples are sums over what they share and over each alone, so only shared cells are joined.
    """
    zero = F.lit(0.0)
    n = F.col("count").cast("double")
    own = [F.sum(n).alias("n"), F.count("*").alias("k"), F.sum(n * n).alias("nn")]
    shared = {
        "bray": F.sum(F.least("x", "y")), "jaccard": F.count("*"), "euclidean": F.sum(F.col("x") * F.col("y")),
        "manhattan": F.sum(F.least("x", "y")), "canberra": F.sum(F.abs(F.col("x") - F.col("y")) / (F.col("x") + F.col("y")) - 2),
    }[measure]
    p = _pairs_with(ab, [shared.alias("s")], own).withColumn("s", F.coalesce("s", zero))
    d = {
        "bray": 1 - 2 * F.col("s") / (F.col("a_n") + F.col("b_n")),
        "jaccard": 1 - F.col("s") / (F.col("a_k") + F.col("b_k") - F.col("s")),
        "euclidean": F.sqrt(F.greatest(F.col("a_nn") + F.col("b_nn") - 2 * F.col("s"), zero)),
        "manhattan": F.col("a_n") + F.col("b_n") - 2 * F.col("s"),
        "canberra": F.col("a_k") + F.col("b_k") + F.col("s"),
    }[measure]
    return p.select("sample_a", "sample_b", F.round(d.cast("double"), 6).alias("d"))


def unifrac(ab: DataFrame, branches: DataFrame, weighted: bool = False) -> DataFrame:
    """sample_a, sample_b, d over a tree's branches (obs_id, branch, length: every branch above an observation)."""
    sums = ab.groupBy("sample_id").agg(F.sum("count").alias("all"))
    share = ab.join(sums, "sample_id").select("obs_id", "sample_id", (F.col("count") / F.col("all")).alias("p"))
    on = share.join(branches, "obs_id").groupBy("sample_id", "branch").agg(F.sum("p").alias("p"), F.first("length").alias("length"))
    a = on.select("branch", F.col("sample_id").alias("sample_a"), F.col("p").alias("x"), F.col("length").alias("l"))
    b = on.select("branch", F.col("sample_id").alias("sample_b"), F.col("p").alias("y"))
    met = a.join(b, "branch").where("sample_a < sample_b").groupBy("sample_a", "sample_b").agg(F.sum("l").alias("both"), F.sum(F.col("l") * F.least("x", "y")).alias("low"))
    own = on.groupBy("sample_id").agg(F.sum("length").alias("len"), F.sum(F.col("length") * F.col("p")).alias("mass"))
    pairs = own.select(F.col("sample_id").alias("sample_a"), F.col("len").alias("la"), F.col("mass").alias("ma")).join(own.select(F.col("sample_id").alias("sample_b"), F.col("len").alias("lb"), F.col("mass").alias("mb")), F.col("sample_a") < F.col("sample_b"))
    p = pairs.join(met, ["sample_a", "sample_b"], "left").na.fill(0.0, ["both", "low"])
    d = 1 - 2 * F.col("low") / (F.col("ma") + F.col("mb")) if weighted else 1 - F.col("both") / (F.col("la") + F.col("lb") - F.col("both"))
    return p.select("sample_a", "sample_b", F.round(d, 6).alias("d"))


def anova(values: DataFrame, group: str, value: str) -> DataFrame:
    """df_between, df_within, f of a one-way layout, from sums by group."""
    g = values.groupBy(group).agg(F.count(value).alias("n"), F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    t = g.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"))
    between, within = F.col("b") - F.col("s") * F.col("s") / F.col("n"), F.col("q") - F.col("b")
    return t.select((F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within"), F.round((between / (F.col("k") - 1)) / (within / (F.col("n") - F.col("k"))), 6).alias("f"))


def f_tail(f: float, one: int, two: int) -> float:
    """The chance of a larger F with so many degrees of freedom: the incomplete beta function by its continued fraction."""
    from math import exp, lgamma, log

    if not f > 0 or one < 1 or two < 1:
        return 1.0

    def part(a: float, b: float, x: float) -> float:
        front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x)) / a
        c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
        out = d
        for m in range(1, 500):
            for n in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1 / (1 + n * d), 1 + n / c
                out *= c * d
            if abs(c * d - 1) < 1e-14:
                break
        return front * out

    a, b, x = two / 2, one / 2, two / (two + one * f)
    return part(a, b, x) if x < (a + 1) / (a + b + 2) else 1 - part(b, a, 1 - x)


def anova_depth(values: DataFrame, group: str, value: str, depth: str) -> DataFrame:
    """df_group, df_within, f_depth, p_depth, f_group, p_group of value by depth first (a number) and then by group, from sums by
    group. Rows without value or depth don't count."""
    x, y = F.col(depth).cast("double"), F.col(value).cast("double")
    own = {"n": F.lit(1.0), "x": x, "y": y, "xx": x * x, "xy": x * y, "yy": y * y}
    g = values.where(x.isNotNull() & y.isNotNull()).groupBy(group).agg(*[F.sum(c).alias(n) for n, c in own.items()])
    c = F.col
    inner = {f"w{a}{b}": F.sum(c(a + b) - c(a) * c(b) / c("n")) for a, b in ("xx", "xy", "yy")}
    t = g.agg(F.count("*").alias("k"), *[F.sum(n).alias(n) for n in own], *[v.alias(n) for n, v in inner.items()])
    for a, b in ("xx", "xy", "yy"):
        t = t.withColumn(f"s{a}{b}", c(a + b) - c(a) * c(b) / c("n"))
    full, by_depth = c("wyy") - c("wxy") * c("wxy") / c("wxx"), c("syy") - c("sxy") * c("sxy") / c("sxx")
    one, two = (c("k") - 1).cast("long"), (c("n") - c("k") - 1).cast("long")
    f = t.select(one.alias("df_group"), two.alias("df_within"), ((c("syy") - by_depth) / (full / two)).alias("f_depth"), (((by_depth - full) / one) / (full / two)).alias("f_group"))
    tail = F.udf(lambda f, a, b: None if f is None else f_tail(f, a, b), "double")  # one row
    return f.select("df_group", "df_within", "f_depth", tail("f_depth", F.lit(1), "df_within").alias("p_depth"), "f_group", tail("f_group", "df_group", "df_within").alias("p_group"))


def composition(ab: DataFrame, taxa: DataFrame, n: int) -> DataFrame:
    """sample_id, taxon, count: the n largest taxa overall, the others as Other. taxa: obs_id, taxon."""
    own = ab.join(taxa, "obs_id").groupBy("sample_id", "taxon").agg(F.sum("count").alias("count"))
    top = own.groupBy("taxon").agg(F.sum("count").alias("all")).orderBy(F.desc("all"), "taxon").limit(n).select("taxon", F.lit(True).alias("top"))
    named = own.join(top, "taxon", "left").withColumn("taxon", F.when(F.col("top"), F.col("taxon")).otherwise("Other"))
    return named.groupBy("sample_id", "taxon").agg(F.sum("count").alias("count"))


def size_factors(ab: DataFrame) -> DataFrame:
    """sample_id, factor: median over observations of count by the geometric mean of its positive counts (zeros count as 1 in the mean's root over all samples), scaled to geometric mean 1."""
    cells = ab.where("count > 0")
    n = cells.select("sample_id").distinct().agg(F.count("*").alias("samples"))
    means = cells.groupBy("obs_id").agg(F.sum(F.log(F.col("count").cast("double"))).alias("s")).join(F.broadcast(n)).select("obs_id", (F.col("s") / F.col("samples")).alias("m"))
    med = cells.join(means, "obs_id").groupBy("sample_id").agg(F.percentile(F.log(F.col("count").cast("double")) - F.col("m"), 0.5).alias("l"))
    centre = med.agg(F.avg("l").alias("c"))
    return med.join(F.broadcast(centre)).select("sample_id", F.round(F.exp(F.col("l") - F.col("c")), 6).alias("factor"))


def mean_log_ratio(ab: DataFrame, groups: DataFrame, over: str, under: str) -> DataFrame:
    """obs_id, log2fc of mean counts (with 1 added) of two groups, and side: over or under."""
    sums = ab.join(groups.where(F.col("group").isin(over, under)), "sample_id").groupBy("obs_id").agg(F.sum(F.when(F.col("group") == over, F.col("count")).otherwise(0)).alias("a"), F.sum(F.when(F.col("group") == under, F.col("count")).otherwise(0)).alias("b"))
    fc = F.round(F.log2((F.col("a") + 1) / (F.col("b") + 1)), 6)
    return sums.select("obs_id", fc.alias("log2fc")).withColumn("side", F.when(F.col("log2fc") > 0, "over").otherwise("under"))


def differential(stats: DataFrame, taxonomy: DataFrame, most: float) -> DataFrame:
    """Rows below the adjusted p, with their lineage and side."""
    return stats.where(F.col("padj") < most).join(taxonomy, "obs_id").withColumn("side", F.when(F.col("log2fc") > 0, "over").otherwise("under"))


def map_style(log2fc: Column, padj: Column) -> tuple[Column, Column]:
    """Colour by the change's size and sign (fixed values; null without change), width by its certainty, for pathway maps."""
    over = F.when(log2fc < 1, "#DE894E").when(log2fc < 2, "#B26E3E").otherwise("#9B6037")
    under = F.when(log2fc > -1, "#B0C6C5").when(log2fc > -2, "#8EADAC").otherwise("#637978")
    colour = F.when(log2fc > 0, over).when(log2fc < 0, under)
    width = F.when(padj < 0.001, "W11").when(padj < 0.01, "W10").otherwise("W9")
    return colour, width


def whole_numbers(functions: DataFrame, samples: list[str]) -> DataFrame:
    """A function table as counts: halves to the even number; rows without any go."""
    out = functions.drop("db_link").select(*[F.bround(c, 0).cast("long").alias(c) if c in samples else F.col(c) for c in functions.columns if c != "db_link"])
    return out.where(sum((F.col(c) for c in samples[1:]), F.col(samples[0])) > 0)


def metagenome(ab: DataFrame, copies: DataFrame, markers: DataFrame) -> DataFrame:
    """sample_id, function, value: counts by marker copies, times each function's copies. copies: obs_id, function, copies; markers: obs_id, marker."""
    normal = ab.join(markers, "obs_id").select("obs_id", "sample_id", (F.col("count") / F.col("marker")).alias("v"))
    return normal.join(copies, "obs_id").groupBy("sample_id", "function").agg(F.round(F.sum(F.col("v") * F.col("copies")), 6).alias("value"))


def nsti_confidence(nsti: Column) -> Column:
    return F.when(nsti < 0.5, "Good").when(nsti < 1, "Medium").when(nsti < 2, "Bad").otherwise("To exclude")


def enrichment(listed: DataFrame, members: DataFrame) -> DataFrame:
    """pathway, k, p, p_adjusted, stars: one-sided exact tests of listed functions in pathways (function, pathway), Bonferroni."""
    every = members.select("function").distinct().count()
    drawn = members.join(listed, "function", "left_semi").select("function").distinct().count()
    sizes = members.groupBy("pathway").agg(F.countDistinct("function").alias("m"))
    hits = members.join(listed, "function", "left_semi").groupBy("pathway").agg(F.countDistinct("function").alias("k"))
    tests = sizes.join(hits, "pathway", "left").na.fill(0, ["k"])

    @F.pandas_udf("double")
    def tail(k: pd.Series, m: pd.Series) -> pd.Series:
        from math import comb

        def p(k: int, m: int) -> float:
            return sum(comb(m, i) * comb(every - m, drawn - i) for i in range(k, min(m, drawn) + 1)) / comb(every, drawn)

        return pd.Series([p(int(a), int(b)) for a, b in zip(k, m, strict=True)])

    n = tests.count()
    out = tests.withColumn("p", tail("k", "m")).withColumn("p_adjusted", F.least(F.col("p") * n, F.lit(1.0)))
    return out.withColumn("stars", F.when(F.col("p_adjusted") < 0.001, "***").when(F.col("p_adjusted") < 0.01, "**").when(F.col("p_adjusted") < 0.05, "*").otherwise("")).select("pathway", "k", "p", "p_adjusted", "stars")


def ranked_top(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(value))
    return df.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n).drop("rk")
