"""Helpers shared by the operators: whole texts as Arrow batches, files in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import fresh_path

# Documents that a Python worker holds at a time; texts are not cut, so a batch is as large as its texts.
BATCH_DOCUMENTS = 256


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows, as texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_DOCUMENTS))


def texts(docs: DataFrame) -> DataFrame:
    """Id and text only, whatever other columns there are."""
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))


def per_text(docs: DataFrame, schema: str, rows: Callable[[list, list], dict]) -> DataFrame:
    """Columns that `rows` derives from the ids and texts of a batch, a row for each document; one pass, no shuffle."""
    small_batches(docs.sparkSession)
    kind = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, whole = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = rows(ids, whole)
            yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in kind], schema=kind)

    return texts(docs).mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def publish(spark: SparkSession, label: str, content: bytes) -> str:
    """Write bytes to the shared folder and have every executor, later ones too, fetch the file; returns its name."""
    target = fresh_path(spark, label)
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    spark.sparkContext.addFile(str(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()))
    return target.rsplit("/", 1)[-1]


def held_out(doc_id: str = "doc_id"):
    """True for rows whose labels are never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_hash(text):
    """Hash of a whole text; null and empty texts share one."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def bounded_sample(df: DataFrame, key: str, rows: int, *order: str) -> DataFrame:
    """The `rows` rows whose key has the least hash, ties by `order`. Tasks first leave out the hashes that are
    twice too many, so that what they send does not grow with their number."""
    n = df.count()
    least = F.xxhash64(key)
    if n > 2 * rows:
        df = df.filter(least < -(1 << 63) + int((1 << 64) * (2 * rows / n)))
    return df.orderBy(least, key, *order).limit(rows)
