"""Reading the tables, and the helpers of the operators on the Spark side."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z only. ``lower`` is the same where all characters are one byte."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


class Shared:
    """A broadcast value that each Python worker prepares once."""

    _ready: dict[str, object] = {}

    def __init__(self, spark: SparkSession, value: object, prepare: Callable[..., object] = lambda x: x) -> None:
        self.key, self.prepare = uuid.uuid4().hex, prepare
        self.sent = spark.sparkContext.broadcast(value)

    def get(self):
        if self.key not in Shared._ready:
            Shared._ready.clear()
            Shared._ready[self.key] = self.prepare(self.sent.value)
        return Shared._ready[self.key]


def fresh_names(df: DataFrame, wanted: list[str]) -> list[str]:
    """``wanted``, with underscores where the frame already has such a column (names
    compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def extended(df: DataFrame, **kinds: str) -> StructType:
    """The schema of ``df`` and further columns (name to type)."""
    more = [StructField(name, DataType.fromDDL(kind)) for name, kind in kinds.items()]
    return StructType([*df.schema.fields, *more])
