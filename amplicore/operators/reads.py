"""Operators on reads (seq_id, sequence, quality, sample_id, size): filters, pairing, barcodes, dereplication, clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amplicore.operators.numbering import numbered
from amplicore.functions import sequences as S


def failing(reads: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """reads with reason: the name of the first test, in order, that a read fails; null if none."""
    names = list(tests)
    out = F.when(tests[names[0]], names[0])
    for n in names[1:]:
        out = out.when(tests[n], n)
    return reads.withColumn("reason", out)


def filter_tests(low: int, high: int, max_n: int, homopolymer: int | None = None, quality: tuple[int, int] | None = None, tag: str | None = None, sequence: str = "sequence", paired: bool = False) -> dict[str, Column]:
    """Tests in their fixed order: tag, length, ambiguity, homopolymer, quality; of joined pairs tag, ambiguity, length only."""
    seq = F.col(sequence)
    length, n = {"length": ~F.length(seq).between(low, high)}, {"ambiguity": S.ambiguous(seq) > max_n}
    out = {} if tag is None else {"tag": ~seq.contains(tag)}
    if paired:
        return out | n | length
    out |= length | n
    if homopolymer is not None:
        out["homopolymer"] = S.long_homopolymer(seq, homopolymer)
    if quality is not None:
        out["quality"] = S.poor_quality(F.col("quality"), *quality)
    return out


def funnel(judged: DataFrame, size: str = "size") -> DataFrame:
    """sample_id, reason (kept if none), reads."""
    return judged.groupBy("sample_id", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.sum(size).cast("long").alias("reads"))


def trimmed(reads: DataFrame, five: str | None = None, three: str | None = None) -> DataFrame:
    """Reads with both primers found cut off, without errors in them; others go. For primers with errors see kernels.trim_with_errors."""
    pattern = "^.*?" * bool(five) + (S.primer_pattern(five) if five else "^") + "(.+?)" + (S.primer_pattern(three) if three else "$")
    seq = F.regexp_extract("sequence", pattern, 1)
    return reads.withColumn("sequence", seq).where(F.length("sequence") > 0)


def paired(one: DataFrame, two: DataFrame) -> DataFrame:
    """name, first, second: mates by id without its /1 or .2 ending."""

    def named(df: DataFrame, to: str) -> DataFrame:
        return df.select(F.regexp_replace("seq_id", r"[./][12]$", "").alias("name"), F.col("sequence").alias(to))

    return named(one, "first").join(named(two, "second"), "name")


def combined(pairs: DataFrame, tag: str, reverse: bool = True) -> DataFrame:
    """seq_id, sequence: both mates with the tag between; the second as its reverse complement."""
    second = S.reverse_complement(F.col("second")) if reverse else F.col("second")
    return pairs.select(F.concat("name", F.lit("_combined")).alias("seq_id"), F.concat("first", F.lit(tag), second).alias("sequence"))


def split_pairs(rows: DataFrame, tag: str, reverse: bool = True) -> DataFrame:
    """The inverse of combined. A sequence that isn't two parts has nulls there."""
    at = F.instr("sequence", tag)
    whole = (at > 0) & (F.instr(F.substr("sequence", at + len(tag)), F.lit(tag)) == 0)
    second = F.substr("sequence", at + len(tag))
    second = S.reverse_complement(second) if reverse else second
    return rows.select(F.regexp_replace("seq_id", "_combined$", "").alias("name"), F.when(whole, F.substr("sequence", F.lit(1), at - 1)).alias("first"), F.when(whole, second).alias("second"))


def dereplicated(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sequence, seq_id, size): one row for each distinct sequence with its first id by sample and order; (seq_id, sample_id, count).

    Sums by sequence and sample are made before the shuffle, so a sequence that a third of all reads share costs one row a task.
    """
    own = reads.groupBy("sequence", "sample_id").agg(F.sum("size").cast("long").alias("count"), F.min("seq_id").alias("seq_id"))
    heads = own.groupBy("sequence").agg(F.sum("count").alias("size"), F.min_by("seq_id", F.struct("sample_id", "seq_id")).alias("seq_id"))
    return heads, own.drop("seq_id").join(heads.select("sequence", "seq_id"), "sequence").select("seq_id", "sample_id", "count")


def split_samples(heads: DataFrame, counts: DataFrame) -> DataFrame:
    """The inverse: each sample's sequences with their counts in it."""
    return counts.where("count > 0").join(heads.select("seq_id", "sequence"), "seq_id").select("sample_id", "seq_id", "sequence", F.col("count").alias("size"))


def renamed_by_size(heads: DataFrame, prefix: str = "Cluster_") -> DataFrame:
    """cluster, seq_id, size: numbered from the largest, ties by id downwards."""
    placed = numbered(heads.select("seq_id", "size"), [F.desc("size"), F.desc("seq_id")], "place")
    return placed.select(F.concat(F.lit(prefix), F.col("place").cast("string")).alias("cluster"), "seq_id", "size")


def length_histogram(reads: DataFrame) -> DataFrame:
    return reads.groupBy(F.length("sequence").cast("long").alias("length")).agg(F.sum("size").cast("long").alias("reads"))


def cluster_counts(members: DataFrame, counts: DataFrame) -> DataFrame:
    """cluster, sample_id, count: sums over members (cluster, seq_id)."""
    return members.join(counts, "seq_id").groupBy("cluster", "sample_id").agg(F.sum("count").cast("long").alias("count"))


def flattened(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """cluster, seq_id of two levels: outer (cluster, sub), inner (sub, seq_id)."""
    return outer.join(inner, "sub").select("cluster", "seq_id")


def seeds(members: DataFrame, heads: DataFrame) -> DataFrame:
    """cluster, seed, size: the first member (by ord) and the sum of all sizes. members: cluster, ord, seq_id."""
    both = members.join(heads.select("seq_id", "size"), "seq_id")
    return both.groupBy("cluster").agg(F.min_by("seq_id", "ord").alias("seed"), F.sum("size").alias("size"))


def demultiplexed(reads: DataFrame, barcodes: DataFrame, most: int, end: bool = False) -> DataFrame:
    """reads with barcode: the one with fewest mismatches; ambiguous if two share the fewest, unmatched if they are too many.

    barcodes (sample_id, barcode) are a bounded table: a plate has at most a few thousand, which is checked; each read is
    held against an array of them inside its own row, so reads are neither multiplied nor shuffled. Without barcodes, and
    without a sequence, a read is unmatched.
    """
    rows = barcodes.select("sample_id", "barcode").limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10000 barcodes")
    if not rows:
        return reads.withColumn("barcode", F.lit("unmatched"))
    known = F.array(*[F.struct(F.lit(r["sample_id"]).alias("sample"), F.lit(r["barcode"]).alias("code")) for r in rows])

    def held(b: Column) -> Column:
        part = F.substr("sequence", F.greatest(F.length("sequence") - F.length(b["code"]) + 1, F.lit(1))) if end else F.substr("sequence", F.lit(1), F.length(b["code"]))
        return F.struct(S.mismatches(part, b["code"]).alias("mm"), b["sample"].alias("sample"))

    out = reads.withColumn("held", F.array_sort(F.transform(known, held))).withColumn("best", F.get("held", F.lit(0)))
    tied = F.coalesce(F.get("held", F.lit(1))["mm"] == F.col("best.mm"), F.lit(False))
    name = F.when(F.col("sequence").isNull() | (F.col("best.mm") > most), "unmatched").when(tied, "ambiguous").otherwise(F.col("best.sample"))
    return out.withColumn("barcode", name).drop("held", "best")


def demultiplex_summary(assigned: DataFrame, barcodes: DataFrame) -> DataFrame:
    """sample, reads: every sample of the table, unmatched and ambiguous too, 0 if there are none."""
    names = barcodes.select(F.col("sample_id").alias("sample")).distinct()
    names = names.union(assigned.sparkSession.createDataFrame([("unmatched",), ("ambiguous",)], "sample string"))
    n = assigned.groupBy(F.col("barcode").alias("sample")).agg(F.count("*").alias("reads"))
    return names.join(n, "sample", "left").select("sample", F.coalesce("reads", F.lit(0)).alias("reads"))


def cut_barcode(assigned: DataFrame, length: int, extra: int = 0) -> DataFrame:
    """Matched reads without their barcode (and extra letters after it), their quality alike; others as they are."""
    matched = ~F.col("barcode").isin("unmatched", "ambiguous")
    for c in [c for c in ("sequence", "quality") if c in assigned.columns]:
        assigned = assigned.withColumn(c, F.when(matched, F.substr(c, F.lit(length + extra + 1))).otherwise(F.col(c)))
    return assigned


def rad_label(assigned: DataFrame, tag: str) -> DataFrame:
    """Matched reads must hold the restriction tag; a second one marks the label."""
    n = F.regexp_count("sequence", F.lit(tag))
    matched = ~F.col("barcode").isin("unmatched", "ambiguous")
    return assigned.withColumn("barcode", F.when(matched & (n == 0), "unmatched").when(matched & (n > 1), F.concat("barcode", F.lit("_2rad"))).otherwise(F.col("barcode")))


#: What stands for the filler of a joined pair while clusters are made, and how its description names the place.
FILLER, STANDS_FOR, PLACE = "N" * 100, "A" * 50 + "C" * 50, "50A50C"


def fillers_hidden(reads: DataFrame) -> DataFrame:
    """Joined pairs (their id says combined) with another filler for the N, the place of all N at the end of the description.

    A joined pair without filler has a null sequence, as it can't be one; other reads stay as they are."""
    first, last = F.locate("N", F.col("sequence")) - 1, F.length("sequence") - F.locate("N", F.reverse("sequence"))
    place = F.concat(F.coalesce("description", F.lit("")), F.concat_ws(":", F.lit(PLACE), first, last))
    joined, filled = F.col("seq_id").contains("combined"), F.col("sequence").contains(FILLER)
    out = reads.withColumn("description", F.when(joined & filled, place).otherwise(F.col("description")))
    return out.withColumn("sequence", F.when(joined & ~filled, None).when(joined, F.replace("sequence", F.lit(FILLER), F.lit(STANDS_FOR))).otherwise(F.col("sequence")))


def fillers_restored(reads: DataFrame) -> DataFrame:
    """The inverse of fillers_hidden. A joined pair without place, or with other letters there, has a null sequence."""
    pattern = PLACE + r":(\d+):(\d+)$"
    note = F.coalesce("description", F.lit(""))
    first, last = F.regexp_extract(note, pattern, 1).try_cast("int"), F.regexp_extract(note, pattern, 2).try_cast("int")
    joined = F.col("seq_id").contains("combined")
    good = note.rlike(pattern) & (F.substr("sequence", first + 1, last - first + 1) == STANDS_FOR)
    back = F.concat(F.substr("sequence", F.lit(1), first), F.repeat(F.lit("N"), last - first + 1), F.substr("sequence", last + 2))
    out = reads.withColumn("sequence", F.when(joined & good, back).when(joined, None).otherwise(F.col("sequence")))
    return out.withColumn("description", F.when(joined & note.rlike(pattern), F.nullif(F.regexp_replace(note, pattern, ""), F.lit(""))).otherwise(F.col("description")))


def by_filler(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reads of full length, and joined ones (those that hold an N)."""
    held = F.coalesce(F.col("sequence").contains("N"), F.lit(False))
    return reads.where(~held), reads.where(held)


def adjusted_bounds(least: int, most: int, five: str, three: str) -> tuple[int, int]:
    """Bounds of length of amplicons without their primers."""
    return least - len(five) - len(three), most - len(five) - len(three)


def chunks(reads: DataFrame, n: int | None = None, size: int | None = None) -> DataFrame:
    """reads with chunk: n chunks by a hash of the id, or as many as hold about size reads each. Nothing is sorted or gathered."""
    if (n is None) == (size is None):
        raise ValueError("either n or size")
    parts = n if n is not None else max(1, -(-reads.count() // size))
    return reads.withColumn("chunk", F.pmod(F.xxhash64("seq_id"), F.lit(parts)).cast("int"))
