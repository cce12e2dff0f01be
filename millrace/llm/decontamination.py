"""Operator 2: benchmark decontamination by a generalised suffix automaton.

Test items are normalised to words and joined in one suffix automaton, built in every Python worker from the items' words.
Each document's words are streamed through it while the length of the longest match that ends at the word is tracked: a
match of at least `window` words covers the last `window` words, and the automaton's state tells which items hold them.
Items shorter than the window are one window themselves, marked at their state. Before streaming, a bit table of the items'
word triples leaves out stretches that can't hold a window; it has no false negatives.

The items are the only data that is collected and sent to all workers, in portions of at most `portion` words. A benchmark of
more portions makes one pass over the documents for each, with one automaton in each worker; what a pass finds is written by the
digest of its text and joined at the end. So the driver and a worker hold one portion at a time.

Defined results: a null text or one without words has no words and no hits; an item without words is ignored; an item with
a null id hits words but isn't listed; equal items share their windows and each is listed; an empty benchmark hits nothing;
rows are never dropped by `contamination`; extra columns are ignored by it and kept by `decontaminated`.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORDS_ONLY, as_bytes, rows_of, stored

WINDOW = 13
PORTION = 100_000
BITS = 22


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of 0-9, a-z and bytes from 0x80, after lower-casing A-Z."""
    return text.translate(WORDS_ONLY).split() if text else []


class SuffixAutomaton:
    """Of several word sequences; knows which of them hold each window."""

    def __init__(self, items: list[list[bytes]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        sequences = [[self.ids.setdefault(w, len(self.ids) + 1) for w in item] for item in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        holders: list[set[int]] = [set()]
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for n, words in enumerate(sequences):
            last = 0
            for word in words:
                last = self._extend(last, word, holders)
                holders[last].add(n)
        for n, words in enumerate(sequences):
            if 0 < len(words) < window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                self.whole.setdefault(state, []).append((len(words), n))
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True)
        for state in order:
            if self.length[state] >= window and self.length[self.link[state]] >= window:
                holders[self.link[state]] |= holders[state]
        self.holders = {s: frozenset(holders[s]) for s in order if self.length[s] >= window > self.length[self.link[s]]}
        self.marked = [False] * len(self.next)  # whether a short item is a suffix of the state's words
        for state in reversed(order):
            self.marked[state] = state in self.whole or self.marked[self.link[state]]
        self.least = min((min(len(s), window) for s in sequences if s), default=0)
        self.gram = min(3, self.least)
        self.table = np.zeros(1 << BITS, bool)
        for words in sequences:
            if words:
                self.table[self._grams(np.array(words, np.uint64))] = True

    def _extend(self, last: int, word: int, holders: list[set[int]]) -> int:
        step, link, length = self.next, self.link, self.length
        if word in step[last]:
            to = step[last][word]
            return to if length[to] == length[last] + 1 else self._copy(last, word, to, holders)
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        holders.append(set())
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            to = step[at][word]
            link[new] = to if length[to] == length[at] + 1 else self._copy(at, word, to, holders)
        return new

    def _copy(self, at: int, word: int, to: int, holders: list[set[int]]) -> int:
        step, link, length = self.next, self.link, self.length
        twin = len(step)
        step.append(dict(step[to]))
        length.append(length[at] + 1)
        link.append(link[to])
        holders.append(set(holders[to]))
        link[to] = twin
        while at >= 0 and step[at].get(word) == to:
            step[at][word] = twin
            at = link[at]
        return twin

    def _grams(self, ids: np.ndarray) -> np.ndarray:
        n = len(ids) - self.gram + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        mixed = ids[:n].copy()
        for i in range(1, self.gram):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n]
        return (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """The spans of words that windows cover, apart and in order, and the items with such windows."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        if not self.least or len(words) < self.least:
            return spans, found
        ids = np.fromiter(map(self.ids.get, words, repeat(0)), np.uint64, len(words))
        known = ids != 0
        n = len(ids) - self.gram + 1
        near = self.table[self._grams(ids)]
        for i in range(self.gram):
            near &= known[i : i + n]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], near, [False])).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.least - self.gram + 1
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            self._stream(a, ids[a : b + self.gram - 1].tolist(), spans, found)
        return spans, found

    def _stream(self, first: int, ids: list[int], spans: list[tuple[int, int]], found: set[int]) -> None:
        step, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i, word in enumerate(ids, first + 1):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state = step[state][word]
                matched += 1
            else:
                matched = 0
            covered = 0
            at = state
            if matched >= window:
                covered = window
                while length[link[at]] >= window:
                    at = link[at]
                found |= self.holders[at]
            if self.marked[state]:
                while at > 0:
                    for n, item in self.whole.get(at, ()):
                        if n <= matched:
                            found.add(item)
                            covered = max(covered, n)
                    at = link[at]
            if covered:
                start = i - covered
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i))


_built: dict[str, SuffixAutomaton] = {}


def _automaton(key: str, packed: bytes, window: int) -> SuffixAutomaton:
    """One automaton is kept in a worker: a pass needs no other."""
    if key not in _built:
        _built.clear()
        _built[key] = SuffixAutomaton(pickle.loads(packed), window)
    return _built[key]


def _portions(benchmark: DataFrame, most: int) -> Iterator[tuple[list[str | None], list[list[bytes]]]]:
    ids: list[str | None] = []
    items: list[list[bytes]] = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator():
        words = words_of((row[1] or "").encode())
        if words:
            if size and size + len(words) > most:
                yield ids, items
                ids, items, size = [], [], 0
            ids.append(row[0])
            items.append(words)
            size += len(words)
    yield ids, items


def _merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


_FOUND = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


def _searcher(ids: list[str | None], items: list[list[bytes]], window: int):
    packed = pickle.dumps(items)
    key = hashlib.sha256(packed + bytes([window & 255])).hexdigest()

    def run(text: pa.Array) -> pa.Array:
        automaton, out = _automaton(key, packed, window), []
        for raw in as_bytes(text):
            words = words_of(raw)
            spans, found = automaton.hits(words)
            out.append({"n_words": len(words), "spans": [x for s in spans for x in s], "items": [ids[i] for i in found if ids[i] is not None]})
        return pa.array(out, _FOUND)

    return run


_KIND = "struct<n_words: bigint, spans: array<bigint>, items: array<string>>"


def _counted(text: pa.Array) -> pa.Array:
    return pa.array([len(words_of(x)) for x in as_bytes(text)], pa.int64())


def _together(spans: pa.Array, items: pa.Array) -> pa.Array:
    """The findings of several passes over a text as one."""
    out = []
    for all_spans, all_items in zip(spans.to_pylist(), items.to_pylist(), strict=True):
        merged: list[tuple[int, int]] = []
        for x in all_spans:
            merged = _merged(merged, list(zip(x[::2], x[1::2], strict=True)))
        out.append({"spans": [i for s in merged for i in s], "items": sorted({i for x in all_items for i in x})})
    return pa.array(out, pa.struct([("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))]))


def found_in(docs: DataFrame, benchmark: DataFrame, column: str = "found", window: int = WINDOW, portion: int = PORTION) -> DataFrame:
    """docs with a column (n_words, spans, items): spans holds first and end word of each covered stretch, one after another."""
    portions, text = _portions(benchmark, portion), F.col("text").cast("string")
    search = lambda p: F.arrow_udf(_searcher(*p, window), _KIND)(text)
    first, second = next(portions), next(portions, None)
    if second is None:
        return docs.withColumn(column, search(first))
    found, digest = None, F.md5(text)
    for p in itertools.chain((first, second), portions):
        one = docs.select(digest.alias("__millrace_digest"), search(p).alias("f")).where("size(f.spans) > 0")
        one = stored(one.select("__millrace_digest", "f.spans", "f.items").dropDuplicates(["__millrace_digest"]), "hits")
        found = one if found is None else found.unionByName(one)
    lists = found.groupBy("__millrace_digest").agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    merge = F.arrow_udf(_together, "struct<spans: array<bigint>, items: array<string>>")
    hits = lists.select("__millrace_digest", merge("spans", "items").alias("__millrace_hits"))
    hit = F.col("__millrace_hits")
    whole = F.struct(
        F.arrow_udf(_counted, "bigint")(text).alias("n_words"),
        F.coalesce(hit["spans"], F.array().cast("array<bigint>")).alias("spans"),
        F.coalesce(hit["items"], F.array().cast("array<string>")).alias("items"),
    )
    joined = docs.withColumn("__millrace_digest", digest).join(hits, "__millrace_digest", "left")
    return joined.withColumn(column, whole).select(*docs.columns, column)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, portion: int = PORTION) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    found = found_in(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, "found", window, portion).select("doc_id", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            rows = batch.column(1).to_pylist()
            hit = [sum(x["spans"][1::2]) - sum(x["spans"][::2]) for x in rows]
            items = [sorted(set(x["items"])) for x in rows]
            yield pa.record_batch({
                "doc_id": batch.column(0),
                "n_words": pa.array([x["n_words"] for x in rows], pa.int64()),
                "n_hit": pa.array(hit, pa.int64()),
                "n_items": pa.array(list(map(len, items)), pa.int64()),
                "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                "contaminated": pa.array([h > 0 and 20 * h >= x["n_words"] for h, x in zip(hit, rows, strict=True)], pa.bool_()),
            })

    return found.mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def without_spans(text: str, spans: list[int]) -> str:
    """text without the stretches between the first and the last character of each span of words."""
    raw = text.encode()
    flags = np.frombuffer(raw.translate(WORDS_ONLY), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).view(np.int8)))
    starts, ends, out, at = edges[::2], edges[1::2], [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*out, raw[at:]]).decode()


def decontaminated(docs: DataFrame, benchmark: DataFrame, one_in: int = 20, spans: bool = False, window: int = WINDOW) -> DataFrame:
    """docs without those of which windows cover one word in `one_in` or more; spans: cut shorter finds out of the rest.

    Columns and all other rows stay as they are."""
    mark = "__millrace_found"
    found = found_in(docs, benchmark, mark, window)
    n_hit = F.aggregate(F.col(f"{mark}.spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("sign")),
                        lambda a, x: F.struct((a["n"] + a["sign"] * x).alias("n"), (-a["sign"]).alias("sign")))["n"]
    kept = found.withColumn("__millrace_hit", n_hit).where((F.col("__millrace_hit") == 0) | (F.col("__millrace_hit") * one_in < F.col(f"{mark}.n_words")))
    if spans:
        cut = F.arrow_udf(lambda t, s: pa.array([without_spans(a, b) if a and b else a for a, b in zip(t.to_pylist(), s.to_pylist(), strict=True)], pa.string()), "string")
        kept = kept.withColumn("text", cut(F.col("text"), F.col(f"{mark}.spans")))
    return kept.drop(mark, "__millrace_hit")
