"""Helpers that several corpus operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegrid.session import ensure_checkpoint_dir, settings, shuffles_removed

# Words end at these bytes in every operator: space and U+0009 to U+000D. No byte of a
# longer UTF-8 sequence is among them, so bytes.split() finds exactly these words.
WORD_GAPS = b" \t\n\x0b\x0c\r"


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_HELD: dict[tuple, object] = {}


def held(name: tuple, make: Callable[[], object]) -> object:
    """A task's helper, kept for the next tasks of the same Python process.

    One of each kind (the name's first part) is kept, so memory stays bounded.
    """
    if name not in _HELD:
        for other in [k for k in _HELD if k[0] == name[0]]:
            del _HELD[other]
        _HELD[name] = make()
    return _HELD[name]


def map_rows(df: DataFrame, make: Callable[[], Callable[[list], list[tuple]]], schema: str | StructType, arrow: pa.Schema, target: int = 4 << 20) -> DataFrame:
    """Rows made from batches of columns by the function that `make` builds once per task.

    The function gets the batch's columns as Arrow arrays and returns the output's columns
    (lists, numpy arrays or Arrow arrays) in the order of `arrow`. It sees about `target`
    bytes of a batch at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, target):
                out = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(work(part.columns), arrow.types)]
                yield pa.RecordBatch.from_arrays(out, schema=arrow)
        # the worker lives on, with what its pool has kept
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, target: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about `target` bytes, so that scratch arrays stay small."""
    rows = batch.num_rows
    step = max(1, int(rows * target / max(1, batch.nbytes)))
    for start in range(0, rows, step):
        yield batch.slice(start, step)


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    BOUND = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """64-bit hashes of substrings, from running sums of byte values times powers of an
    odd number modulo 2^64."""

    def __init__(self) -> None:
        rng = np.random.default_rng(7)
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = 0x9E3779B97F4A7C15
        self.grow(1 << 20)

    def grow(self, n: int) -> None:
        self.up, self.down = (np.full(n, b, np.uint64) for b in (self.base, pow(self.base, -1, 1 << 64)))
        for powers in (self.up, self.down):
            powers[0] = 1
            np.multiply.accumulate(powers, out=powers)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) > len(self.up):
            self.grow(2 * len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.up[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n words; none if there are fewer words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, n, np.uint64)
    for k in range(n):
        total += words[k : k + count] * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 3) | 1) & (2**64 - 1))
        total = mixed(total)
    return total


def join_checked(left: DataFrame, right: DataFrame, on: list[str], how: str, rows: int) -> DataFrame:
    """Join; the right side is broadcast only if it has at most `rows` rows."""
    small = right.limit(rows + 1).count() <= rows
    return left.join(F.broadcast(right) if small else right, on, how)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder that the session names."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{os.urandom(8).hex()}"


# Rows of text that an executor holds at once on the way to and from Python.
TEXT_BATCH = "1000"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within, texts reach Python in batches of TEXT_BATCH rows at most."""
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=TEXT_BATCH):
        yield


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """The frame written to the shared folder and read back: cuts lineage, keeps columns prunable."""
    folder = folder or new_folder(df.sparkSession, name)
    with shuffles_removed(df.sparkSession), small_batches(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def passing(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder for a table that nothing reads after the block; it is removed then."""
    folder = new_folder(spark, name)
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def file_bytes(path: str) -> bytes:
    """A small model file, read on the driver and shipped with the tasks."""
    with open(path, "rb") as file:
        return file.read()
