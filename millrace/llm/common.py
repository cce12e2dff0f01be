"""Helpers that several operators share: the shared folder, packed tokens, stable hashes."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None

#: Bytes that end a word when only white space does (space, \t, \n, \v, \f, \r): what bytes.split() splits at.
#: Fixed table: A-Z to a-z, every other byte as it is.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Fixed table for words [0-9a-z\x80-\xff]+ of lower-cased text: every other byte becomes a space.
WORDS_ONLY = bytes(
    (b + 32) if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where that is unset and there is one machine, our own."""
    global _own_dir
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, _own_dir, True)
    return f"file://{_own_dir}"


def stored(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """df, written as a Parquet table to the shared folder and read again: it cuts the lineage and survives lost executors.

    release: asks the driver's JVM to collect garbage, on which Spark deletes the shuffle files that the table stands for."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if release:
        del df
        for wait in (0.0, 0.5):  # Spark's listeners may hold the plan for a moment
            time.sleep(wait)
            gc.collect()
            spark.sparkContext._jvm.System.gc()
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hash of a word's bytes, remembered unless the word is long; the memory is emptied when it holds `most` words."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) > 64:
            return value
        if len(self) >= self.most:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of n word hashes, by doubling: a run of 2k is made of two runs of k."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    size, runs, out, at = 1, words, None, 0
    while True:
        if n & size:
            part = runs[at : at + len(words) - n + 1]
            out = part.copy() if out is None else mixed(out * _STEP + part + np.uint64(at))
            at += size
        if size * 2 > n:
            return mixed(out + np.uint64(n))
        runs = mixed(runs[:-size] * _STEP + runs[size:]) if len(runs) > size else runs[:0]
        size *= 2


def shared_counts(x: np.ndarray, x_of: np.ndarray, n: int, y: np.ndarray, y_of: np.ndarray, m: int) -> np.ndarray:
    """(n, m) sizes of the intersections of n sets with m others, as products of incidence matrices.

    x and y hold the hashes of all sets of a side, x_of and y_of the number of each one's set."""
    both = np.intersect1d(np.unique(x), np.unique(y), assume_unique=True)
    out = np.zeros((n, m))
    for i in range(0, len(both), 8192):
        some = both[i : i + 8192]
        sides = []
        for flat, owner, size in ((x, x_of, n), (y, y_of, m)):
            at = np.minimum(np.searchsorted(some, flat), len(some) - 1)
            hit = some[at] == flat
            side = np.zeros((size, len(some)), np.float32)
            side[owner[hit], at[hit]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def rows_of(batches: Iterator[pa.RecordBatch], most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut into pieces of about most_bytes (one row at least), so that long texts don't pile up."""
    for batch in batches:
        n = max(1, -(-batch.nbytes // most_bytes))
        step = max(1, -(-batch.num_rows // n))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)

#: Fixed: the bytes at which bytes.split() splits.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15


class SplitHashes:
    """64-bit hashes of the words between white space, for a whole text at once.

    A word's hash is the polynomial of its bytes' random values, taken from sums over the text; the powers are kept for as
    many bytes as are handled together, and long texts are cut at white space.
    """

    def __init__(self, together: int = 1 << 20):
        self.together = together
        self.values = np.random.default_rng(64).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) <= n:
            n = max(2 * n, 1 << 14)
            both = [np.full(n + 1, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64))]
            for x in both:
                x[0] = 1
            self.powers, self.inverses = (np.cumprod(x, dtype=np.uint64) for x in both)

    def _part(self, raw: bytes) -> np.ndarray:
        b = np.frombuffer(raw, np.uint8)
        self._reach(len(b))
        inside = np.zeros(len(b) + 2, np.int8)
        np.logical_not(_SPACE[b], out=inside[1:-1].view(bool))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(self.values[b] * self.powers[: len(b)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))

    def of(self, raw: bytes | None) -> np.ndarray:
        if not raw:
            return np.empty(0, np.uint64)
        parts, at = [], 0
        while len(raw) - at > self.together:
            end = at + self.together
            while end < len(raw) and not _SPACE[raw[end]]:
                end += 1
            parts.append(self._part(raw[at:end]))
            at = end
        parts.append(self._part(raw[at:]))
        return np.concatenate(parts) if len(parts) > 1 else parts[0]
