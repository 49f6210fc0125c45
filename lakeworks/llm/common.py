"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.session import ensure_checkpoint_dir

#: ASCII white space, as word separator and for normalisation.
SPACE = r"[\x20\x09-\x0D]"

#: Words of more bytes are not kept in a worker's caches, which so are bounded in
#: bytes too: texts without spaces are one word each, and seldom the same.
LONGEST_KEPT = 64

#: Rows of text in one Arrow batch; long texts make batches of some MB.
TEXT_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package where it isn't installed on the
    executors; Spark hands the file out."""
    sc = spark.sparkContext
    if getattr(sc, "_lakeworks_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    at = Path(tempfile.mkdtemp(prefix="lakeworks-code-")) / "lakeworks.zip"
    with zipfile.ZipFile(at, "w") as z:
        for f in [package / "__init__.py", package / "session.py", *sorted((package / "llm").glob("*.py"))]:
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(at))
    sc._lakeworks_shipped = True


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Keep Arrow batches of whole texts small, however long the texts are."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names; null text is empty."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as bytes, without decoding them."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Group an iterator of row tuples into record batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, type=f.type) for col, f in zip(zip(*rows), schema)], schema=schema)
