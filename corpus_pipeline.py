"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept. All but the last return the columns of ``docs``. ``run``
writes each stage's result as Parquet and reads it again for the next one.

Null texts count as empty and pass the filters like any other text; rows are
told apart by their place in the input, so repeated rows, equal ids and null
ids are handled row by row. Of a group of copies the row with the smallest
doc_id stays (nulls last, then the first in the input). Other columns go
through untouched, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.llm import exact_dedup, packing, shingle_join, suffix_dedup, toxicity
from lakeworks.llm.common import ship, table, text_batches
from lakeworks.session import ensure_checkpoint_dir

ROW = "_corpus_row"
MOST_FILES = 50_000  # whose numbers are broadcast, some MB
#: Repeated passages of this many words go, and repeated strings of this many
#: bytes, whatever their words. 51 short words can have 101 bytes.
REPEAT_WORDS, REPEAT_BYTES = 51, 240

ORACLE_SQL = None


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with row numbers that stay the same however a read is split (the
    splits follow the cores there are at the time). A row of Parquet files is known
    by its file and its place in it; other rows, and those of very many files, are
    stored in the shared folder first."""
    try:
        place = docs.metadataColumn("_metadata")
        placed = docs.select("*", place["file_path"].alias("_corpus_file"), place["row_index"].alias("_corpus_at"))
        files = [r[0] for r in placed.select("_corpus_file").distinct().limit(MOST_FILES + 1).collect()]
    except AnalysisException:
        files = None
    if files is None or len(files) > MOST_FILES:
        rows = docs.withColumn(ROW, F.monotonically_increasing_id())
        path = f"{ensure_checkpoint_dir(docs.sparkSession)}/rows-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return docs.sparkSession.read.schema(rows.schema).parquet(path)
    numbers = docs.sparkSession.createDataFrame([(f, k) for k, f in enumerate(sorted(files))], "_corpus_file string, _corpus_no long")
    rows = placed.join(F.broadcast(numbers), "_corpus_file", "left")  # a row for each file, MOST_FILES at most
    number = F.shiftleft(F.col("_corpus_no"), 33) + F.col("_corpus_at")
    return rows.select(*docs.columns, number.alias(ROW))


def _one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Drop all rows of ``docs`` but one of each class; ``classes`` has row, class."""
    named = classes.join(docs.select(F.col(ROW).alias("row"), "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    best = named.groupBy("class").agg(first).select("class", F.col("first.row").alias("best"))
    dropped = classes.join(best, "class").where("row <> best").select(F.col("row").alias(ROW))
    return docs.join(dropped, ROW, "left_anti").drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, by a network fitted on the labelled rows
    whose id hashes to another fold than the held-out one."""
    ship(spark)
    text_batches(spark)
    net = toxicity.fitted(docs, table(spark, sf_dir, "labels"), learn=~toxicity.held_out(F.col("doc_id")))
    score = toxicity.scorer(spark, net)
    return docs.where(score(F.coalesce(F.col("text"), F.lit(""))) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal normalised texts."""
    rows = _numbered(docs)
    found = exact_dedup.dedup(rows, id_col=ROW)
    classes = found.where("group_size > 1").select(F.col("doc_id").alias("row"), F.col("keep_id").alias("class"))
    return _one_of_each(rows, classes)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts with a word 5-gram Jaccard similarity of 0.8 or more."""
    rows = _numbered(docs)
    found = shingle_join.join(rows, n=5, num=80, den=100, id_col=ROW)
    classes = found.where("node is not null").select(F.col("doc_id").alias("row"), F.col("component_id").alias("class"))
    return _one_of_each(rows, classes)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of more than 50 words, or of 240 bytes, that occur more than once."""
    return suffix_dedup.remove_repeats(docs, length=REPEAT_BYTES, words=REPEAT_WORDS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("shingle_join", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
