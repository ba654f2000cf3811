"""What the corpus operators share: tables, written intermediates, the word rule, hashing."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_libc = ctypes.CDLL(None)
#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local session, as in tests, may name none; it gets a folder of this machine."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(shared_dir, "own"):
        shared_dir.own = tempfile.mkdtemp(prefix="strataq-")
        atexit.register(shutil.rmtree, shared_dir.own, True)
    return shared_dir.own


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read again: its lineage ends there.

    The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strataq/{name}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.parquet(path)
    fs.deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def release_memory() -> None:
    """Gives what a Python worker holds but doesn't use back to the machine: a worker that waits keeps the size of its largest task else."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow, memory released after the last batch."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return wrapped


def with_row(docs: DataFrame, without: Sequence[str] = (), **named: Column) -> DataFrame:
    """`row`, all columns of `docs` but those `without` as a struct, and the named ones: no name of `docs` can clash with a helper's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in without]).alias("row"), *[x.alias(name) for name, x in named.items()])


def of_row(docs: DataFrame, **replaced: Column) -> list[Column]:
    """The columns of `docs` from `row`, some replaced."""
    return [(replaced[c] if c in replaced else F.col(f"row.`{c}`")).alias(c) for c in docs.columns]


def md5_int(text: Column, digits: int = 12) -> Column:
    """The first hexadecimal digits of md5 as a non-negative long (15 digits at most)."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def share_bound(share: float) -> int:
    """The long under which a 64-bit hash lies with probability `share` (under 1), however small."""
    return min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))


def in_share(key: Column, seed: int, share: float) -> Column:
    """Whether `key` is in a sample of about `share` of all keys, which no repartitioning or rerun changes; 1 and more: all."""
    return F.lit(True) if share >= 1 else F.xxhash64(key, F.lit(seed)) < F.lit(share_bound(share))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; a null id counts as the text 'null'."""
    return F.pmod(F.crc32(key_text(doc_id)), F.lit(modulus))
