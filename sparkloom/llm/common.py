"""Shared column helpers of the llm operators."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters; every contract splits and strips on these alone.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"
LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once per row, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words of a text (null: none), split at ASCII white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RE), lambda w: w != "")


def in_fifth(doc_id: Column) -> Column:
    """The held-out fifth: crc32 of the id as text, modulo 5, is 0. A row without id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))
