"""The online forms: file streams, first-wins with state, running quotas."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.storage import table_path


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """A Parquet table (a file or a folder) as a stream."""
    schema = spark.read.parquet(path).schema
    folder, name = os.path.split(path.rstrip("/"))
    base = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return base.option("pathGlobFilter", name).parquet(folder) if not name or "." in name and not is_folder(spark, path) else base.parquet(path)


def is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def first_wins(stream: DataFrame, key: str, time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; with a time column, state older than delay is forgotten."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key]) if time else stream.dropDuplicates([key])


def running_quota(stream: DataFrame, source: str, tokens: str, target: int, schema: str) -> DataFrame:
    """Rows of each source until its tokens reach the target, across batches; schema: the rows' columns."""

    def take(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        done = state.get[0] if state.exists else 0
        for pdf in batches:
            before = done + pdf[tokens].cumsum().shift(fill_value=0)
            kept = pdf[before < target]
            done += int(kept[tokens].sum())
            yield kept
        state.update((done,))

    return stream.groupBy(source).applyInPandasWithState(take, schema, "done long", "append", "NoTimeout")


def run_once(spark: SparkSession, path: str, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All there is of a file stream through transform into a table in the shared folder, which is returned."""
    base = table_path(spark, "stream")
    out = transform(file_stream(spark, path))
    out.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/rows")
