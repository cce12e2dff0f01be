"""Operator 3: substring dedup by level-wise doubling.

A window is a run of `window` words of one document; those whose words also start in a document with a smaller doc_id are
removed. Levels double in length, from FIRST words or a few more to the window: short runs are counted first, and only windows
around a run that is repeated between documents are extended to the next level, until a level finds nothing repeated or the
window is reached. Below the window not every run is needed: each window holds a run with the smallest hash of its runs, the
same one wherever the window stands, so only these are counted.

Beside its runs, the first level counts a text's chunks: a chunk is a row of windows up to the next run whose hash is divisible by
CHUNK, and is told apart by 128 bits of all its words. The windows of a chunk that is in a document with a smaller doc_id are all
removed, and needn't be told one by one: the smallest document that holds a window holds it in a chunk that no smaller one holds, so
it still stands for that window. Long copies therefore make few rows at the levels above.

A run's hash can be that of another run too, which makes more candidates and loses none. At the last level a second, independent
hash of the window's bytes goes with the first, so that windows are told apart by 128 bits.

At each level runs are rows (hash, doc_id), summed with partial minima and joined back to the documents that hold them; both
shuffles can be split where a run is in very many documents. Texts are read again with the hashes found for them.

Defined results: a null text has no words; a document shorter than the window loses nothing; rows of one doc_id are one
document, which doesn't remove its own words; a row with a null doc_id neither loses words nor takes any from others; extra
columns are ignored by `without_repeats`, kept by `deduplicated`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SplitHashes, as_bytes, rows_of, stored, window_hashes

WINDOW = 13
#: The least length of the first level: shorter runs are so frequent that they rule hardly anything out.
FIRST = 7
#: Windows of a chunk, on average.
CHUNK = 16
#: The check of a run; no chunk has it.
_RUN = bytes(8)


def levels(window: int) -> list[int]:
    """Lengths that double up to the window, rounded up: 13 gives 7, 13; 100 gives 7, 13, 25, 50, 100."""
    out = [window]
    while (half := -(-out[0] // 2)) >= FIRST:
        out.insert(0, half)
    return out


def least_in_windows(runs: np.ndarray, n: int) -> np.ndarray:
    """The least of each n neighbours."""
    size, out = 1, runs
    while size * 2 <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(out) - (n - size)], out[n - size :]) if n > size else out


class Windows:
    """Hashes of a text's windows, and of the runs that stand for each."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.hashes = SplitHashes()
        self.first, self._of, self._firsts = levels(window)[0], None, None

    def firsts(self, h: np.ndarray) -> np.ndarray:
        """The hashes of all runs of the first level's length; those of the last text are remembered."""
        if self._of is not h:
            self._of, self._firsts = h, window_hashes(h, self.first)
        return self._firsts

    def runs(self, h: np.ndarray, length: int) -> np.ndarray:
        """The least hash of each window's runs of that length, of the hashes of the words; none for short texts."""
        if len(h) < self.window:
            return np.empty(0, np.uint64)
        hashes = self.firsts(h) if length == self.first else window_hashes(h, length)
        return least_in_windows(hashes, self.window - length + 1)

    def chunks(self, h: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(starts, ends, digests): the rows of windows that make the chunks, and 128 bits of each one's words."""
        n = len(words) - self.window + 1
        cuts = np.flatnonzero(self.firsts(h)[1:n] % np.uint64(CHUNK) == 0) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [n]))
        more = self.window - 1
        digests = [xxhash.xxh3_128_digest(b" ".join(words[i : j + more])) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
        return starts, ends, [d if d[8:] != _RUN else d[:15] + b"\1" for d in digests]

    def outside(self, h: np.ndarray, words: list[bytes], known: set[bytes]) -> np.ndarray:
        """Which windows are in no chunk with a known digest."""
        starts, ends, digests = self.chunks(h, words)
        free = np.fromiter((d not in known for d in digests), bool, len(digests))
        return np.repeat(free, ends - starts)

    def told(self, runs: np.ndarray, words: list[bytes], starts: np.ndarray) -> list[bytes]:
        """The hashes of the windows at these places, each with another hash of its words."""
        more, first = self.window, runs.tobytes()
        return [first[8 * n : 8 * n + 8] + xxhash.xxh3_64_digest(b" ".join(words[i : i + more])) for n, i in enumerate(starts.tolist())]


def _keys(known: pa.StructArray) -> set[bytes]:
    """The 16 bytes of each hash and check."""
    flat = np.stack([known.field(c).to_numpy() for c in ("hash", "check")], axis=1).tobytes()
    return {flat[i : i + 16] for i in range(0, len(flat), 16)}


def _columns(keys: set[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes and checks of these bytes, as signed integers."""
    return tuple(np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2).T)


def _distinct(values: np.ndarray) -> np.ndarray:
    if len(values) > 1:
        values = values[np.concatenate(([True], values[1:] != values[:-1]))]
    return np.unique(values)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the values are known; known: as signed integers, not empty."""
    known = np.sort(known.view(np.uint64))
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _runs(texts: DataFrame, window: int, before: int | None, length: int) -> DataFrame:
    """(hash, check, doc_id): the distinct runs of that length that stand for a document's windows, check being 0 below the window,
    and, at the first level, its chunks.

    before: the length of the level before; texts then has the hashes that are repeated there, and only windows around these count
    that are in none of the chunks of an earlier document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(window)
        for batch in rows_of(batches):
            docs, found, checks = [], [], []
            known, held = (batch.column(2), batch.column(3)) if before else ([None] * batch.num_rows,) * 2
            for doc, raw, mine, own in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), known, held, strict=True):
                h = windows.hashes.of(raw)
                if doc is None or len(h) < window:
                    continue
                runs, at, words = windows.runs(h, length), None, None
                if before:
                    wanted = _among(windows.runs(h, before), mine.values.to_numpy())
                    if own.is_valid and len(own.values):
                        words = raw.split()
                        wanted &= windows.outside(h, words, _keys(own.values))
                    at = np.flatnonzero(wanted)
                    runs = runs[at]
                if length < window:
                    runs = _distinct(runs).view(np.int64)
                    checks.append(np.zeros(len(runs), np.int64))
                    if not before:
                        first, check = _columns(set(windows.chunks(h, raw.split())[2]))
                        runs = np.concatenate((runs, first))
                        checks.append(check)
                else:
                    at = np.arange(len(runs)) if at is None else at
                    runs, check = _columns(set(windows.told(runs, words or raw.split(), at)))
                    checks.append(check)
                docs.append(doc)
                found.append(runs)
            n = [len(x) for x in found]
            flat, other = (np.concatenate([np.empty(0, np.int64), *x]) for x in (found, checks))
            yield pa.record_batch({"hash": pa.array(flat), "check": pa.array(other), "doc_id": pa.array(np.repeat(np.array(docs, np.int64), n))})

    return texts.select("doc_id", "text", *(["hashes", "chunks"] if before else [])).mapInArrow(run, "hash long, check long, doc_id long")


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, windows): of each document, the hash and check of its windows, and of its chunks, that also start in one with a
    smaller doc_id; the windows of these chunks aren't there again."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    around, before, chunks, pair = texts, None, None, F.struct("hash", "check")
    for length in levels(window):
        runs = _runs(around, window, before, length)
        low = runs.groupBy("hash", "check").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
        found = runs.join(low, ["hash", "check"])
        if length == window:
            found = found.where("low < doc_id").select("doc_id", "hash", "check")
            break
        # collect_list leaves nulls out
        lists = F.collect_list(F.when(F.col("check") == 0, F.col("hash"))).alias("hashes"), F.collect_list(F.when(F.col("check") != 0, pair)).alias("chunks")
        repeated = stored(found.where("check = 0 or low < doc_id").groupBy("doc_id").agg(*lists), "runs", release=True)
        if before is None:
            chunks = repeated.select("doc_id", "chunks")
        else:
            repeated = repeated.drop("chunks").join(chunks, "doc_id", "left")
        if repeated.isEmpty():
            found = None
            break
        around, before = texts.join(repeated, "doc_id"), length
    parts = ([found] if found is not None else []) + ([chunks.select("doc_id", F.inline("chunks"))] if chunks is not None else [])
    every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return stored(every.groupBy("doc_id").agg(F.collect_list(pair).alias("windows")), "windows", release=True)


def _kept(windows: Windows, raw: bytes, known: pa.StructArray) -> list[bytes]:
    """The words of a text that none of the known windows and chunks covers."""
    words, h, keys = raw.split(), windows.hashes.of(raw), _keys(known)
    runs, gone = windows.runs(h, windows.window), ~windows.outside(h, words, keys)
    starts = np.flatnonzero(_among(runs, known.field("hash").to_numpy()) & ~gone)
    gone[starts] = np.fromiter((k in keys for k in windows.told(runs[starts], words, starts)), bool, len(starts))
    starts, steps = np.flatnonzero(gone), np.zeros(len(words) + 1, np.int32)
    steps[starts] += 1
    steps[starts + windows.window] -= 1
    return [w for w, c in zip(words, np.cumsum(steps[:-1]).tolist(), strict=True) if not c]


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    found = repeats(docs, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(window)
        for batch in rows_of(batches):
            n_words, n_removed, digests = [], [], []
            for raw, known in zip(as_bytes(batch.column(1)), batch.column(2), strict=True):
                words = raw.split() if raw else []
                n_words.append(len(words))
                if known.is_valid and len(words) >= window:
                    words = _kept(windows, raw, known.values)
                n_removed.append(n_words[-1] - len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.record_batch({"doc_id": batch.column(0), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(found, "doc_id", "left").select("doc_id", "text", "windows").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the words that windows cover cut out of the text, the rest joined by one space; other texts stay as they are."""
    found = repeats(docs, window).select(F.col("doc_id").alias("__millrace_id"), F.col("windows").alias("__millrace_windows"))

    def cut(text: pa.Array, known: pa.Array) -> pa.Array:
        windows, out = Windows(window), []
        for raw, mine in zip(as_bytes(text), known, strict=True):
            if mine.is_valid and raw and len(raw.split()) >= window:
                words = _kept(windows, raw, mine.values)
                raw = b" ".join(words) if len(words) < len(raw.split()) else raw
            out.append(None if raw is None else raw.decode())
        return pa.array(out, pa.string())

    joined = docs.join(found, F.col("doc_id") == F.col("__millrace_id"), "left")
    return joined.withColumn("text", F.arrow_udf(cut, "string")("text", "__millrace_windows")).drop("__millrace_id", "__millrace_windows")
