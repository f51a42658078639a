"""What the training-data operators share: tables, shared storage, Arrow passes and stable sampling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amplicore.storage import ship, shared_dir, stored

__all__ = ["SENT_IDS", "SLICE", "arrow_pass", "built", "crc_mod", "joined_by_id", "shared_dir", "ship", "stored", "table", "unit_hash"]

#: Rows that a Python pass looks at together; bounds a worker's memory whatever the Arrow batch holds.
SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_pass(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Map slices of rows, as columns of Python values, to columns of the schema."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                got = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def unit_hash(col: Column, seed: int) -> Column:
    """A stable number in [0, 1) for each value; null counts as a value."""
    return F.pmod(F.xxhash64(F.coalesce(col.cast("string"), F.lit("")), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of a key written as text, modulo n; a null key counts as empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


#: Objects that a Python worker builds once from a broadcast and keeps for its next tasks.
_BUILT: dict[str, object] = {}


def built(key: str, make: Callable[[], object]) -> object:
    if key not in _BUILT:
        if len(_BUILT) > 1:
            _BUILT.clear()
        _BUILT[key] = make()
    return _BUILT[key]

#: Ids that are sent to all executors for a join (16 MB); more are joined by a shuffle.
SENT_IDS = 1_000_000


def joined_by_id(rows: DataFrame, ids: DataFrame, on: str, how: str) -> DataFrame:
    """rows (wide) joined with ids (stored, narrow): sent to all executors if few enough by count, else by a shuffle."""
    return rows.join(F.broadcast(ids) if ids.count() <= SENT_IDS else ids, on, how)
