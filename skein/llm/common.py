"""What the operators of this folder share: inputs, written intermediate tables and hashing of words."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir; on local masters Spark's warehouse if that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext.master.startswith("local["):
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediate"
    if not found:
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage is cut, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by written() that is no longer read."""
    jvm = spark.sparkContext._jvm
    for path in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Copies of the smaller side of a salted join.
SALTS = 8


def salted_join(large: DataFrame, small: DataFrame, on: list[str], spread: Column, how: str = "inner") -> DataFrame:
    """Equi-join in which the rows of one key of `large` are dealt to SALTS tasks, by spread; `small` has each key once."""
    large = large.withColumn("salt of join", F.pmod(spread, F.lit(SALTS)).cast("int"))
    small = small.withColumn("salt of join", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
    return large.join(small, [*on, "salt of join"], how).drop("salt of join")


#: Bytes of keys that may go to every task.
KEY_BYTES = 8 << 20


def only_keys(large: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of `large` whose key, a bigint, is among the keys, so that a join behind it moves no others; if the keys
    are more than KEY_BYTES, all rows, and the join sorts them out."""
    keys = keys.distinct()
    return large.join(F.broadcast(keys), key, "left_semi") if 8 * keys.count() <= KEY_BYTES else large


def give_back() -> None:
    """Hand memory that is free back to the system; allocators keep it else."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, for mapInArrow, so that its worker gives memory back after each batch and at the end: workers wait for later
    tasks, of other stages too, and what they keep adds to what the executor needs then."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = run(batches)
        while (batch := next(made, None)) is not None:
            yield batch
            del batch
            give_back()
        del made
        give_back()

    return out


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
