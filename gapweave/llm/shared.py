"""Small helpers of the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from gapweave.session import staging_path, use_checkpoints

#: Java and Python pattern of the white space between words: space, tab, line feed, VT, FF, CR.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def words(text: Column) -> Column:
    """Words of a text: runs of characters other than the six ASCII spaces."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def byte_words(text: str | None) -> list[bytes]:
    """The same words as UTF-8 with A-Z lower-cased; ``bytes`` methods know exactly these spaces and letters."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fresh(label: str, *taken: DataFrame) -> str:
    """A column name that none of the frames has."""
    names = {c.lower() for df in taken for c in df.columns}
    name = f"_{label}"
    while name.lower() in names:
        name = f"_{label}_{uuid.uuid4().hex[:8]}"
    return name


def widened(df: DataFrame, name: str, kind: DataType) -> StructType:
    """The frame's schema and one more column."""
    return StructType([*df.schema.fields, StructField(name, kind)])


def reachable(df: DataFrame) -> DataFrame:
    """The frame; Python workers started from now on find this package where the driver found it."""
    folder = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if folder not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (folder, *paths) if x)
    return df


def cut(df: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder, its lineage cut; a lost executor costs no rerun."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables written to a folder of their own below the shared folder, as compressed Parquet, and deleted together."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self._count = spark, staging_path(spark, label), 0

    def keep(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """The frame, written and read again; ``by`` names a column whose values become folders that filters skip."""
        self._count += 1
        path = f"{self.path}/{self._count}"
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])

    def drop(self) -> None:
        """Delete the tables; frames that read them are of no use afterwards."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs whose ``column`` holds about ``most_bytes``, so that Python copies stay small."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)
