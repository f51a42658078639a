"""FASTA and FASTQ, plain or gzipped. A gzipped file is one task; plain FASTA is split at its headers."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.storage import ship


def sample_name() -> Column:
    """A file's sample: its name up to the first point."""
    return F.regexp_extract(F.input_file_name(), r"([^/.]+)[^/]*$", 1)


def _named(header: Column) -> tuple[Column, Column]:
    return F.regexp_extract(header, r"^(\S+)", 1).alias("seq_id"), F.nullif(F.trim(F.regexp_extract(header, r"^\S+\s+(.*)$", 1)), F.lit("")).alias("description")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """seq_id, description, sequence, sample_id; records of many lines are joined. A record begins where a line begins with >."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^\s*>", "").alias("value"), sample_name().alias("sample_id")).where(F.trim("value") != "")
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s+", "")
    return rows.select(*_named(F.regexp_replace(F.regexp_extract("value", r"^([^\n]*)", 1), "\r", "")), body.alias("sequence"), "sample_id")


_FASTQ = ["seq_id", "description", "sequence", "quality", "sample_id"]


def _records(file: str, content: bytes) -> Iterator[tuple]:
    """Rows of a FASTQ file's bytes, plain or gzipped."""
    import gzip
    import io

    raw = io.BytesIO(content)
    text = io.TextIOWrapper(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw, "utf-8")
    sample = file.rsplit("/", 1)[-1].split(".")[0]
    while head := text.readline():
        if not head.strip():
            continue
        seq, plus, qual = text.readline().strip(), text.readline(), text.readline().rstrip("\r\n")
        if head[0] != "@" or plus[:1] != "+" or len(seq) != len(qual):
            raise ValueError(f"{file}: a record isn't FASTQ: {head.strip()}")
        name, _, note = head[1:].strip().partition(" ")
        yield name, note or None, seq, qual, sample


def _frames(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    while part := list(islice(rows, 10_000)):
        yield pd.DataFrame(part, columns=_FASTQ)


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """seq_id, description, sequence, quality, sample_id of records of four lines, file by file: a task holds a file's bytes (2 GB
    at most, so larger files are to be cut at records first), and reads its records from there."""
    ship(spark)
    whole = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for file, content in zip(p["path"], p["content"], strict=True):
                yield from _frames(_records(file, content))

    return whole.mapInPandas(run, "seq_id string, description string, sequence string, quality string, sample_id string")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The reads of all FASTQ files in tar archives of samples, as read_fastq gives them; a member's name tells its sample."""
    whole = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import tarfile

        for p in parts:
            for file, content in zip(p["path"], p["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as t:
                    for m in t:
                        if not m.isfile() or "/" in m.name.removeprefix("./"):
                            raise ValueError(f"{file}: an archive of samples holds files only")
                        yield from _frames(_records(m.name, t.extractfile(m).read()))

    ship(spark)
    return whole.mapInPandas(run, "seq_id string, description string, sequence string, quality string, sample_id string")


def sniffed(spark: SparkSession, path: str) -> str:
    """fasta or fastq, by the first line."""
    first = spark.read.text(path).where(F.trim("value") != "").head(1)
    mark = first[0]["value"][:1] if first else ""
    if mark not in (">", "@"):
        raise ValueError(f"{path} is neither FASTA nor FASTQ")
    return "fasta" if mark == ">" else "fastq"


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    return read_fasta(spark, path) if sniffed(spark, path) == "fasta" else read_fastq(spark, path)


def checked_names(paths: list[str]) -> dict[str, str]:
    """Sample name to path; names must be told apart and hold no white space."""
    out: dict[str, str] = {}
    for p in paths:
        name = p.rsplit("/", 1)[-1].split(".")[0]
        if not name or any(c.isspace() for c in name):
            raise ValueError(f"not a sample's name: {name!r}")
        if name in out:
            raise ValueError(f"two files of sample {name}: {out[name]} and {p}")
        out[name] = p
    return out


def write_fasta(df: DataFrame, path: str) -> None:
    note = F.when(F.col("description").isNotNull(), F.concat(F.lit(" "), "description")).otherwise("") if "description" in df.columns else F.lit("")
    df.select(F.concat(F.lit(">"), "seq_id", note, F.lit("\n"), "sequence").alias("value")).write.mode("overwrite").text(path)


def write_fastq(df: DataFrame, path: str, by_sample: bool = False) -> None:
    """by_sample: a folder for each sample, as demultiplexing gives them."""
    text = F.concat(F.lit("@"), "seq_id", F.lit("\n"), "sequence", F.lit("\n+\n"), "quality").alias("value")
    out = df.select(text, "sample_id") if by_sample else df.select(text)
    (out.write.mode("overwrite").partitionBy("sample_id") if by_sample else out.write.mode("overwrite")).text(path)


def paired_files(names: list[str]) -> dict[str, tuple[str, str]]:
    """Sample to its R1 and R2 file; both must be there for each."""
    import re

    found: dict[str, dict[str, str]] = {}
    for n in names:
        base = n.rsplit("/", 1)[-1]
        if m := re.match(r"(.+?)_[Rr]([12])(?:[._].*)?$", base):
            found.setdefault(m[1], {})[m[2]] = n
    if lost := sorted(s for s, f in found.items() if len(f) < 2):
        raise ValueError(f"samples without both files: {', '.join(lost)}")
    if bad := sorted(s for s in found if re.search(r"\s", s)):
        raise ValueError(f"sample names with white space: {', '.join(bad)}")
    return {s: (f["1"], f["2"]) for s, f in sorted(found.items())}


def archive_members(path: str) -> list[str]:
    """Files of a tar archive of samples; folders aren't allowed."""
    import tarfile

    with tarfile.open(path) as t:
        members = t.getmembers()
    if any(not m.isfile() or "/" in m.name.lstrip("./") for m in members):
        raise ValueError("an archive of samples holds files only")
    return [m.name.removeprefix("./") for m in members]
