"""Subsampling and rarefaction of the count matrix.

A draw without replacement of n reads from a sample is the n smallest of its reads by a stable hash of (observation,
sample, place, seed): the same on every run, in any partitioning. Hashes are made for each read, so work is as the number of
reads, but reads are no rows: a task makes the hashes of a piece of a cell as numbers and hands on counts only. A draw counts
those that are surely in it, and hands on the reads about the place where it should end, as hashes are even. Counts tell
whether it ends there; of a sample where it doesn't, reads are counted by their first ``DIGITS`` hexadecimal digits, and those
of the one part in which it ends are handed on. A curve counts hashes between the first reads of taxa.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amplicore.operators.digests import as_bytes, numbered_md5
from amplicore.storage import ship, stored

#: Digits of a hash that say its part: 16 to the power of it are the parts of a sample.
DIGITS = 3
#: Standard deviations of a draw's end to either side that are handed on at first.
SPREAD = 8
#: Reads of a cell in one piece.
READS = 1 << 14
#: Samples whose counts a task holds at once.
SAMPLES = 1 << 10
#: Depths of a curve that one row expands to.
DEPTHS = 1 << 12


def _pieces(ab: DataFrame) -> DataFrame:
    """ab's cells in pieces of READS reads at most: their key, first and last read."""
    key = F.concat_ws("|", F.col("obs_id").cast("string"), F.col("sample_id").cast("string"), F.lit("")).cast("binary").alias("key")
    start = F.explode(F.sequence(F.lit(1).cast("long"), "count", F.lit(READS).cast("long"))).alias("start")
    return ab.select("*", key, start).withColumn("stop", F.least("count", F.col("start") + READS - 1)).drop("count")


def _dealt(pieces: DataFrame) -> DataFrame:
    """Pieces in as many tasks as are of use; a large cell's are in many, and with a number, as few rows would else be put into one."""
    return pieces.repartition(4 * pieces.sparkSession.sparkContext.defaultParallelism, "obs_id", "sample_id", "start").sortWithinPartitions("sample_id")


def _hashes(batch: pa.RecordBatch, seed: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The hashes of a batch's pieces, some at a time: each read's row, and the halves of its hash."""
    start, stop = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("start", "stop"))
    return numbered_md5(batch.column("key").to_pylist(), start, stop, f"|{seed}".encode() if seed else b"")


def _mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """run over df's batches; it makes columns."""
    ship(df.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = schema.format(obs=kinds["obs_id"], sample=kinds["sample_id"])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in run(found):
            yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(batches, schema)


def _same(column: pa.Array) -> np.ndarray:
    """Numbers that are equal where values are."""
    return column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)


def _by_part(pieces: DataFrame, seed: str) -> DataFrame:
    """sample_id, part, n: reads in each part of a sample's hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict = {}
        kind = None

        def counts() -> dict:
            values, table = list(held), np.stack(list(held.values()))
            of, part = np.nonzero(table)
            return {"sample_id": pa.array(values, kind).take(pa.array(of)), "part": pa.array(part.astype(np.int32)), "n": pa.array(table[of, part])}

        for batch in batches:
            sample, kind = batch.column("sample_id"), batch.column("sample_id").type
            code = _same(sample)
            for row, first, _ in _hashes(batch, seed):
                part = (first >> np.uint64(64 - 4 * DIGITS)).astype(np.int64)
                own = code[row]
                edges = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
                for a, b in zip(edges, edges[1:], strict=False):
                    if (value := sample[row[a]].as_py()) not in held and len(held) == SAMPLES:
                        yield counts()
                        held.clear()
                    held[value] = held.get(value, 0) + np.bincount(part[a:b], minlength=16**DIGITS)
        if held:
            yield counts()

    return _mapped(_dealt(pieces), run, "sample_id {sample}, part int, n long").groupBy("sample_id", "part").agg(F.sum("n").alias("n"))


def _kept(pieces: DataFrame, seed: str) -> DataFrame:
    """obs_id, sample_id, h, n: reads with hashes before low (h null), and each read from there to before high; both in units of 2^-32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            low, high = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("low", "high"))
            sure = np.zeros(len(low), np.int64)

            def columns(rows: np.ndarray, h: list, n: np.ndarray, batch: pa.RecordBatch = batch) -> dict:
                return {c: batch.column(c).take(pa.array(rows)) for c in ("obs_id", "sample_id")} | {"h": pa.array(h, pa.binary()), "n": pa.array(n)}

            for row, first, second in _hashes(batch, seed):
                place = (first >> np.uint64(32)).astype(np.int64)
                sure += np.bincount(row[place < low[row]], minlength=len(low))
                end = np.flatnonzero((place >= low[row]) & (place < high[row]))
                if len(end):
                    yield columns(row[end], as_bytes(first[end], second[end]), np.ones(len(end), np.int64))
            rows = np.flatnonzero(sure)
            yield columns(rows, [None] * len(rows), sure[rows])

    return _mapped(_dealt(pieces), run, "obs_id {obs}, sample_id {sample}, h binary, n long")


def _ends(cells: DataFrame, cut: DataFrame, seed: str) -> DataFrame:
    """cut with low and high, the bounds of the part of a sample in which its draw ends, by a count of all its reads."""
    reads = _by_part(_pieces(cells.join(cut.select("sample_id"), "sample_id", "left_semi")), seed)
    before = F.sum("n").over(Window.partitionBy("sample_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    last = reads.withColumn("below", F.coalesce(before, F.lit(0))).join(cut, "sample_id").where("below < goal and below + n >= goal")
    low = F.col("part").cast("long") * (1 << 32 - 4 * DIGITS)
    return last.select("sample_id", "goal", low.alias("low"), (low + (1 << 32 - 4 * DIGITS)).alias("high"))


def _drawn(cells: DataFrame, bounds: DataFrame, seed: str) -> tuple[DataFrame, DataFrame]:
    """obs_id, sample_id, n: parts of draws that end between their bounds (sample_id, goal, low, high); and the sample_id of the others."""
    bounds = stored(bounds, "ends")
    kept = stored(_kept(_pieces(cells.join(bounds.select("sample_id", "low", "high"), "sample_id")), seed), "kept")
    sums = kept.groupBy("sample_id").agg(F.sum(F.when(F.col("h").isNull(), F.col("n"))).alias("sure"), F.sum("n").alias("upto"))
    sure = F.coalesce("sure", F.lit(0))
    held = bounds.join(sums, "sample_id", "left").withColumn("rest", F.when((sure <= F.col("goal")) & (F.col("upto") >= F.col("goal")), F.col("goal") - sure))
    held = stored(held.select("sample_id", "rest"), "held")
    of = kept.join(held.where("rest is not null"), "sample_id")
    end = of.where("h is not null").withColumn("r", F.row_number().over(Window.partitionBy("sample_id").orderBy("h"))).where("r <= rest")
    return of.where("h is null").select("obs_id", "sample_id", "n").union(end.select("obs_id", "sample_id", "n")), held.where("rest is null").select("sample_id")


def subsampled(ab: DataFrame, n: int | None = None, ratio: float | None = None, drop_small: bool = False, seed: str = "") -> DataFrame:
    """obs_id, sample_id, count of n reads of each sample: a number, a share of the sample (down to a whole), or the smallest sample's total.

    Samples with fewer reads stay whole, or go with drop_small. Samples without reads don't count.
    """
    ab = stored(ab.where("count > 0").select("obs_id", "sample_id", F.col("count").cast("long").alias("count")), "cells")
    sums = ab.groupBy("sample_id").agg(F.sum("count").alias("all"))
    if ratio is not None:
        goal: Column = F.floor(F.col("all") * ratio)
    elif n is not None:
        goal = F.lit(n).cast("long")
    else:
        goal = F.lit(sums.agg(F.min("all")).first()[0] or 0).cast("long")
    sums = sums.withColumn("goal", goal)
    if drop_small:
        sums = sums.where("all >= goal")
    whole = ab.join(sums.where("all <= goal").select("sample_id"), "sample_id", "left_semi").select("obs_id", "sample_id", F.col("count").alias("n"))
    cut = sums.where("goal > 0 and all > goal")
    spread = SPREAD * (F.sqrt(F.col("goal") * (1 - F.col("goal") / F.col("all"))) + 1)
    low, high = (F.floor((F.col("goal") + side * spread) / F.col("all") * 2**32) for side in (-1, 1))
    drawn, missed = _drawn(ab, cut.select("sample_id", "goal", F.greatest(low, F.lit(0)).alias("low"), F.least(high, F.lit(1 << 32)).alias("high")), seed)
    parts = whole.union(drawn)
    if missed.limit(1).count():
        parts = parts.union(_drawn(ab, _ends(ab, cut.join(missed, "sample_id", "left_semi"), seed), seed)[0])
    return parts.groupBy("obs_id", "sample_id").agg(F.sum("n").alias("count"))


def step_size(ab: DataFrame, parts: int = 35) -> int:
    """The lower-quartile sample total in parts, 1 at least; empty samples don't count."""
    sums = ab.groupBy("sample_id").agg(F.sum("count").alias("n")).where("n > 0")
    k = sums.count()
    if not k:
        return 1
    w = Window.orderBy("n", "sample_id")
    return max(1, sums.withColumn("r", F.row_number().over(w)).where(F.col("r") == k // 4 + 1).first()["n"] // parts)


def _lowest(pieces: DataFrame, seed: str) -> DataFrame:
    """obs_id, sample_id, h: the smallest hash of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row, first, second in _hashes(batch, seed):
                at = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                low = np.minimum.reduceat(first, at)
                lower = np.minimum.reduceat(np.where(first == low[row - row[0]], second, ~np.uint64(0)), at)
                rows = pa.array(row[at])
                yield {"obs_id": batch.column("obs_id").take(rows), "sample_id": batch.column("sample_id").take(rows), "h": pa.array(as_bytes(low, lower), pa.binary())}

    return _mapped(_dealt(pieces), run, "obs_id {obs}, sample_id {sample}, h binary")


def _between(pieces: DataFrame, marks: DataFrame, reads: int, sums: DataFrame, seed: str) -> DataFrame:
    """sample_id, h, n: for each mark of a sample (h) its reads up to it, beyond the mark before it.

    A sample's pieces are in groups of about as many reads each, and each group gets the sample's marks before its pieces.
    """
    tasks = 16 * pieces.sparkSession.sparkContext.defaultParallelism
    groups = sums.select("sample_id", F.ceil(F.col("all") / max(1, -(-reads // tasks))).alias("groups"))
    group = F.pmod(F.xxhash64("obs_id", "start"), "groups").alias("g")
    rows = pieces.join(groups, "sample_id").select("obs_id", "sample_id", group, "key", "start", "stop", F.lit(None).cast("binary").alias("h"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("g")
    none = [F.lit(None).cast(rows.schema["obs_id"].dataType).alias("obs_id")]
    heads = marks.join(groups, "sample_id").select(*none, "sample_id", each, F.lit(None).cast("binary").alias("key"), F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("stop"), "h")
    dealt = heads.unionByName(rows).repartition(tasks, "sample_id", "g").sortWithinPartitions("sample_id", "g", "start", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, marks, n, value, kind = None, [], np.zeros(0, np.int64), None, None

        def counts() -> dict:
            return {"sample_id": pa.array([value], kind).take(pa.array(np.zeros(len(marks), np.int64))), "h": pa.array(marks, pa.binary()), "n": pa.array(n[:-1])}

        for batch in batches:
            sample, kind = batch.column("sample_id"), batch.column("sample_id").type
            code, g = _same(sample), batch.column("g").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((code[1:] != code[:-1]) | (g[1:] != g[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if held != (sample[a].as_py(), g[a]):
                    if marks:
                        yield counts()
                    held, value, marks, n = (sample[a].as_py(), g[a]), sample[a].as_py(), [], np.zeros(1, np.int64)
                own = batch.slice(a, b - a)
                new = own.column("h").drop_null().to_pylist()
                if new:
                    marks += new
                    both = np.frombuffer(b"".join(marks), ">u8").reshape(-1, 2).astype(np.uint64)
                    high, low, n = both[:, 0].copy(), both[:, 1].copy(), np.zeros(len(marks) + 1, np.int64)
                own = own.slice(len(new))
                if own.num_rows and marks:
                    for _, first, second in _hashes(own, seed):
                        place = np.searchsorted(high, first)
                        tied = np.flatnonzero(high[np.minimum(place, len(high) - 1)] == first)
                        for k in tied:  # mostly the marks themselves
                            while place[k] < len(high) and high[place[k]] == first[k] and low[place[k]] < second[k]:
                                place[k] += 1
                        n += np.bincount(place, minlength=len(n))
        if marks:
            yield counts()

    return _mapped(dealt, run, "sample_id {sample}, h binary, n long").groupBy("sample_id", "h").agg(F.sum("n").alias("n"))


def rarefaction(ab: DataFrame, taxa: DataFrame | None, interval: int, seed: str = "") -> DataFrame:
    """sample_id, nb_sampled, taxa: distinct taxa among the first k * interval reads in hash order, for each whole step.

    taxa: obs_id, taxon (null: observations themselves). A taxon counts where its first read stands: reads are counted between
    the first reads of a sample's taxa, of which a task holds 16 bytes each. Steps are a running sum over as many rows as
    there are taxa.
    """
    ab = stored(ab.where("count > 0").select("obs_id", "sample_id", F.col("count").cast("long").alias("count")), "cells")
    sums = ab.groupBy("sample_id").agg(F.sum("count").alias("all"))
    pieces = _pieces(ab)
    of = F.col("obs_id").cast("string").alias("taxon")
    lowest = _lowest(pieces, seed)
    lowest = (lowest.select("sample_id", of, "h") if taxa is None else lowest.join(taxa, "obs_id")).groupBy("sample_id", "taxon").agg(F.min("h").alias("h"))
    lowest = stored(lowest.select("sample_id", "h"), "lowest")
    marks = lowest.distinct()  # a taxon for each, unless an observation has several
    reads = sums.agg(F.sum("all")).first()[0] or 0
    n = _between(pieces, marks, reads, sums, seed)
    placed = n.withColumn("r", F.sum("n").over(Window.partitionBy("sample_id").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)))
    first = lowest.join(placed.select("sample_id", "h", "r"), ["sample_id", "h"])
    own = first.groupBy("sample_id", F.ceil(F.col("r") / interval).alias("k")).agg(F.count("*").alias("n"))
    grid = sums.where(F.col("all") >= interval).select("sample_id", F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.col("all") / interval))).alias("k"))
    up = Window.partitionBy("sample_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    joined = grid.join(own, ["sample_id", "k"], "left")
    return joined.select("sample_id", (F.col("k") * interval).alias("nb_sampled"), F.coalesce(F.sum("n").over(up), F.lit(0)).alias("taxa"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function for numbers from 1 on: Stirling's series, eight places further on."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    shift = x.copy()
    for k in range(1, 8):
        shift = shift * (x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def rarefied_richness(ab: DataFrame, step: int = 10) -> DataFrame:
    """sample_id, depth, richness: observations expected in a draw of depth reads, by log-gamma sums; every step reads up to each
    sample's total, and at the total. Cells of a sample with equal counts are one row, so work is by distinct counts."""
    cells = ab.where("count > 0").groupBy("sample_id", "count").agg(F.count("*").alias("cells"))
    sums = ab.groupBy("sample_id").agg(F.sum("count").alias("all")).where(F.col("all") > 0)
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("all") / step), F.lit(DEPTHS).cast("long")))
    rows = cells.join(sums, "sample_id").withColumn("from", chunk).repartition(4 * ab.sparkSession.sparkContext.defaultParallelism, "sample_id", "from")
    last = F.least(F.col("from") + DEPTHS - 1, F.floor(F.col("all") / step))
    rows = rows.withColumn("k", F.explode(F.sequence("from", last))).withColumn("depth", F.when(F.col("k") == 0, F.col("all")).otherwise(F.col("k") * step))
    rows = rows.where((F.col("k") == 0) | (F.col("depth") < F.col("all")))

    @F.pandas_udf("double")
    def seen(count: pd.Series, whole: pd.Series, depth: pd.Series) -> pd.Series:
        n, k, d = whole.to_numpy(float), count.to_numpy(float), depth.to_numpy(float)
        left = n - k
        ok = left >= d
        lost = np.exp(log_gamma(np.maximum(left, 0) + 1) - log_gamma(np.maximum(left - d, 0) + 1) - log_gamma(n + 1) + log_gamma(n - d + 1))
        return pd.Series(np.where(ok, 1 - lost, 1.0))

    return rows.groupBy("sample_id", "depth").agg(F.sum(F.col("cells") * seen("count", "all", "depth")).alias("richness"))


def ranked_taxa(lineages: DataFrame, rank: int, deepest: int) -> DataFrame:
    """obs_id, taxon: names down to a rank (from 0) in lower case; those that begin with unknown are unknown, as are missing ones
    up to the deepest rank asked for."""
    names = F.transform(F.coalesce("taxonomy", F.array().cast("array<string>")), lambda x: F.when(F.lower(x).startswith("unknown"), "unknown").otherwise(x))
    padded = F.concat(names, F.array_repeat(F.lit("unknown"), F.greatest(F.lit(deepest) - F.size(names), F.lit(0))))
    return lineages.select("obs_id", F.lower(F.array_join(F.slice(padded, 1, rank + 1), ";")).alias("taxon"))


def rarefaction_table(curve: DataFrame, samples: list[str]) -> DataFrame:
    """nb_sampled and a column for each sample, empty text beyond its reads. curve: sample_id, nb_sampled, taxa."""
    out = curve.groupBy("nb_sampled").pivot("sample_id", samples).agg(F.first(F.col("taxa").cast("string")))
    return out.na.fill("", samples)
