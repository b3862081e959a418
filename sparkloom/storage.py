"""Where intermediate tables live: the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of the scopes that are open, the innermost last.
SCOPES: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a folder of our own only where that is unset in a single process (local tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else has; the innermost open scratch() owns it."""
    path = f"{shared_dir(spark)}/sparkloom/{name}-{uuid.uuid4().hex}"
    if SCOPES:
        SCOPES[-1].append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder of any file system that Spark reads; one that isn't there is no error."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(table: DataFrame) -> None:
    """Removes a table of materialize() that nothing will read again, such as a round's that a later round replaced."""
    delete(table.sparkSession, table._table_path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the tables made within: for callers that have written or counted their result by then."""
    own: list[str] = []
    SCOPES.append(own)
    try:
        yield
    finally:
        SCOPES.remove(own)
        for path in own:
            delete(spark, path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint only after counting at most max_rows rows; beyond that the planner's shuffle join runs."""
    few = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df
