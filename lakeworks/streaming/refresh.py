"""Streaming refresh of an additive rollup (the streaming form of R10m / H1).

Cash-flow events arrive as parquet files. Each micro-batch is reduced to
keyed (sum, count) partials, written to a folder named after the batch id;
writing a batch again replaces its folder, so a batch that is replayed after
a failure, in this process or another, counts once. The state is the sum of
all partials, so a batch writes only the keys it touches. With the caller's
``root`` (shared storage) a later run continues where the last one stopped.
Late rows need no watermark: sums merge by key whatever the arrival order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.operators.delta import incremental_agg
from lakeworks.session import ensure_checkpoint_dir

KEYS = ["portfolio_source_key", "cash_flow_date", "cash_flow_type"]
STATE = ("portfolio_source_key string, cash_flow_date date, cash_flow_type string, "
         "sum_amount_local decimal(28,2), row_count bigint")


def cash_flow_rows(events: DataFrame) -> DataFrame:
    kind = (F.when(F.col("event_type") == "purchase", "INCOME").when(F.col("event_type") == "signup", "CONTRIBUTION")
            .when(F.col("event_type") == "error", "FEE").when(F.col("event_type") == "click", "EXPENSE")
            .otherwise("DISTRIBUTION"))
    return events.select(
        F.concat(F.lit("SUP_"), (F.col("user_id") % 10).cast("string")).alias("portfolio_source_key"),
        F.col("ts").cast("date").alias("cash_flow_date"), kind.alias("cash_flow_type"),
        F.col("value").cast("decimal(18,2)").alias("amount_local"))


KEEP = 16  # batch folders that are left lying before they are folded into one


def _done(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Numbers of the finished folders ``<root>/<kind>/<kind>=<n>``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{kind}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    marks = fs.globStatus(_path(spark, f"{root}/{kind}/{kind}=*/_SUCCESS"))
    return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in marks)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _folders(spark: SparkSession, root: str) -> list[str]:
    """The newest generation, which holds all batches up to its number, and the batches after it."""
    upto = max(_done(spark, root, "upto"), default=-1)
    return [f"{root}/upto/upto={upto}"] * (upto >= 0) + [f"{root}/batch/batch={b}" for b in _done(spark, root, "batch") if b > upto]


def partials(spark: SparkSession, root: str) -> DataFrame:
    """The state: all batches' partials added up."""
    folders = _folders(spark, root)
    rows = spark.read.schema(STATE).parquet(*folders) if folders else spark.createDataFrame([], STATE)
    return rows.groupBy(*KEYS).agg(F.sum("sum_amount_local").cast("decimal(28,2)").alias("sum_amount_local"),
                                   F.sum("row_count").alias("row_count"))


def write_batch(root: str, batch: DataFrame, batch_id: int, keep: int = KEEP) -> None:
    """Store a batch's partials under its number. A batch that is played again
    replaces itself, or is passed over if a generation holds it already. Beyond
    ``keep`` folders all are folded into a new generation."""
    spark = batch.sparkSession
    if batch_id <= max(_done(spark, root, "upto"), default=-1):
        return
    state = incremental_agg(None, cash_flow_rows(batch), None, KEYS, ["amount_local"])
    state.write.mode("overwrite").parquet(f"{root}/batch/batch={batch_id}")
    if len(_folders(spark, root)) > keep:
        fold_batches(spark, root)


def fold_batches(spark: SparkSession, root: str) -> None:
    """One generation of all finished batches. It counts from the moment it is
    complete; only then the folders that it holds are removed, and readers that
    come in between read the generation alone."""
    last = max(_done(spark, root, "batch"), default=-1)
    if last <= max(_done(spark, root, "upto"), default=-1):
        return
    partials(spark, root).write.mode("overwrite").parquet(f"{root}/upto/upto={last}")
    path = _path(spark, root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [f"upto/upto={n}" for n in _done(spark, root, "upto") if n < last]
    for folder in old + [f"batch/batch={n}" for n in _done(spark, root, "batch") if n <= last]:
        fs.delete(_path(spark, f"{root}/{folder}"), True)


def streaming_refresh(spark: SparkSession, source_path: str, schema, root: str | None = None,
                      max_files_per_trigger: int = 1) -> DataFrame:
    """Run the stream over everything that has arrived since ``root``'s last
    run and return the state. Without ``root`` the run stands alone."""
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:12]}"

    def fold(batch: DataFrame, batch_id: int) -> None:
        write_batch(root, batch, batch_id)

    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if source_path.endswith(".parquet"):
        # a single parquet file: a glob that matches just it, relative to its folder
        folder, fname = source_path.rsplit("/", 1)
        reader = reader.option("basePath", folder)
        source_path = f"{folder}/{fname[:-1]}[{fname[-1]}]"
    q = (reader.parquet(source_path)
         .writeStream.foreachBatch(fold)
         .option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return partials(spark, root)
