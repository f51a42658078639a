"""BIOM documents, count tables and metadata tables."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fields that a BIOM 1.0 document must have.
FIELDS = ("id", "format", "format_url", "type", "generated_by", "date", "rows", "columns", "matrix_type", "matrix_element_type", "shape", "data")


@dataclass
class Experiment:
    """abundance (obs_id, sample_id, count), observations and samples (id, ord, metadata as JSON text)."""

    abundance: DataFrame
    observations: DataFrame
    samples: DataFrame

    def unique(self) -> "Experiment":
        """This, if ids are distinct; else ValueError."""
        for what, df in (("observation", self.observations), ("sample", self.samples)):
            if twice := df.groupBy("id").count().where("count > 1").select("id").head(1):
                raise ValueError(f"{what} {twice[0]['id']} is there twice")
        return self


_SUBJECT = "array<struct<id:string,metadata:string>>"


def _document(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True).select("value")
    kind = f"struct<matrix_type:string,data:array<array<double>>,rows:{_SUBJECT},columns:{_SUBJECT}>"
    return text.select(F.from_json("value", kind).alias("d")).select("d.*")


def read_biom(spark: SparkSession, path: str) -> Experiment:
    """A sparse or dense document. Cells of 0 aren't kept, wherever they come from."""
    doc = _document(spark, path)
    obs = doc.select(F.posexplode("rows").alias("ord", "r")).select(F.col("ord").cast("long").alias("ord"), "r.id", "r.metadata")
    smp = doc.select(F.posexplode("columns").alias("ord", "c")).select(F.col("ord").cast("long").alias("ord"), "c.id", "c.metadata")
    sparse = doc.where("matrix_type = 'sparse'").select(F.explode("data").alias("t")).select(F.get("t", F.lit(0)).cast("long").alias("i"), F.get("t", F.lit(1)).cast("long").alias("j"), F.get("t", F.lit(2)).cast("long").alias("count"))
    dense = doc.where("matrix_type = 'dense'").select(F.posexplode("data").alias("i", "row")).select(F.col("i").cast("long").alias("i"), F.posexplode("row").alias("j", "v")).select("i", F.col("j").cast("long").alias("j"), F.col("v").cast("long").alias("count"))
    cells = sparse.union(dense).where("count <> 0")
    named = cells.join(obs.select(F.col("ord").alias("i"), F.col("id").alias("obs_id")), "i").join(smp.select(F.col("ord").alias("j"), F.col("id").alias("sample_id")), "j")
    return Experiment(named.select("obs_id", "sample_id", "count"), obs.select("id", "ord", "metadata"), smp.select("id", "ord", "metadata")).unique()


def is_biom(spark: SparkSession, path: str) -> bool:
    """Whether a file is a JSON object with all fields of a BIOM document."""
    kept = F.json_object_keys("value")
    rows = spark.read.text(path, wholetext=True).select(F.coalesce(F.array_size(F.array_intersect(kept, F.array(*map(F.lit, FIELDS)))), F.lit(0)).alias("n")).head(1)
    return bool(rows) and rows[0]["n"] == len(FIELDS)


def write_biom(e: Experiment, path: str, generated_by: str = "amplicore") -> None:
    """One sparse JSON document in ordinal order. A document is one file by its nature; the native sink is Parquet."""
    obs, smp = e.observations.select("id", "ord", "metadata"), e.samples.select("id", "ord", "metadata")
    at = lambda df, to: df.select(F.col("id").alias(f"{to}_id"), F.col("ord").alias(to))
    cells = e.abundance.where("count <> 0").join(at(obs, "i"), F.col("obs_id") == F.col("i_id")).join(at(smp, "j"), F.col("sample_id") == F.col("j_id"))
    data = cells.agg(F.array_sort(F.collect_list(F.array("i", "j", F.col("count").cast("long")))).alias("data"))

    def subjects(df: DataFrame, to: str) -> DataFrame:
        text = F.concat(F.lit('{"id":'), F.to_json(F.array("id")).substr(F.lit(2), F.length(F.to_json(F.array("id"))) - 2), F.lit(',"metadata":'), F.coalesce("metadata", F.lit("null")), F.lit("}"))
        return df.agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", text.alias("t")))), lambda x: x["t"]), ","), F.lit("]")).alias(to), F.count("*").alias(f"n_{to}"))

    whole = data.join(subjects(obs, "rows")).join(subjects(smp, "columns"))
    head = json.dumps({"id": None, "format": "Biological Observation Matrix 1.0.0", "format_url": "http://biom-format.org", "type": "OTU table", "generated_by": generated_by, "date": None, "matrix_type": "sparse", "matrix_element_type": "int"})[:-1]
    text = F.concat(F.lit(head + ', "shape": ['), F.col("n_rows").cast("string"), F.lit(","), F.col("n_columns").cast("string"), F.lit('], "rows": '), F.col("rows"), F.lit(', "columns": '), F.col("columns"), F.lit(', "data": '), F.to_json("data"), F.lit("}"))
    whole.select(text.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_count_table(spark: SparkSession, path: str) -> DataFrame:
    """obs_id, sample_id, count of a wide tab-separated table whose header begins with #; zeros go."""
    lines = spark.read.text(path).select(F.split("value", "\t").alias("f"))
    head = lines.where(F.get("f", F.lit(0)).startswith("#")).limit(1).select(F.col("f").alias("names"))
    body = lines.where(~F.get("f", F.lit(0)).startswith("#") & (F.size("f") > 1))
    cells = body.join(F.broadcast(head)).select(F.get("f", F.lit(0)).alias("obs_id"), F.posexplode(F.slice("f", 2, F.size("f") - 1)).alias("k", "v"), "names")
    return cells.select("obs_id", F.trim(F.get("names", F.col("k") + 1)).alias("sample_id"), F.col("v").cast("long").alias("count")).where("count <> 0")


def write_count_table(ab: DataFrame, samples: list[str], path: str) -> None:
    wide = ab.groupBy("obs_id").pivot("sample_id", samples).agg(F.sum("count")).na.fill(0)
    wide.withColumnRenamed("obs_id", "#Observation").write.mode("overwrite").option("sep", "\t").option("comment", "\x01").option("header", True).csv(path)


def read_metadata(spark: SparkSession, path: str, types: dict[str, str] | None = None, list_sep: dict[str, str] | None = None) -> tuple[str, DataFrame]:
    """observation or sample, by the first header cell, and a table of id and typed columns (lists where a separator is given)."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    first = df.columns[0].lstrip("#").lower()
    if first.rstrip("s") not in ("observation", "sample"):
        raise ValueError("the first header cell names neither observations nor samples")

    def typed(c: str) -> Column:
        kind = (types or {}).get(c, "string")
        if list_sep and c in list_sep:
            return F.transform(F.split(c, list_sep[c]), lambda x: x.cast(kind)).alias(c)
        return F.col(c).cast(kind).alias(c)

    return first.rstrip("s"), df.select(F.col(f"`{df.columns[0]}`").alias("id"), *[typed(c) for c in df.columns[1:]])


def attach_metadata(subjects: DataFrame, metadata: DataFrame) -> DataFrame:
    return subjects.join(metadata, "id", "left")


def write_krona(ab: DataFrame, lineages: DataFrame, path: str) -> None:
    """Row sums and lineages, tab-separated."""
    sums = ab.groupBy("obs_id").agg(F.sum("count").alias("count")).join(lineages, "obs_id")
    sums.select(F.concat_ws("\t", F.col("count").cast("string"), F.array_join("taxonomy", "\t")).alias("value")).write.mode("overwrite").text(path)
