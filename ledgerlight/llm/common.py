"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_scratch, scratch_path

#: Text handled at once inside a Python task, in characters; bounds its memory.
SLICE_CHARS = 1_000_000

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back: a lineage cut that
    survives lost executors.  The shuffle files of the write are deleted once it is done."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the table of a :func:`stored` frame that nothing reads any more."""
    drop_scratch(df.sparkSession, df.scratch)


def id_remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n`` (null ids: of the empty text, 0)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def sliced(batches: Iterator[pa.RecordBatch], text: str = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``chars`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > chars:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)
