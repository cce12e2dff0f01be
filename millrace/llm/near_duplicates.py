"""Operator 4: near-duplicate documents by MinHash with tensored banding.

A document's set is that of its word shingles, as 64-bit hashes. Two collections of `side` half-keys are made, each of `rows`
minima of permuted hashes; table (i, j) is keyed by half-key i of the first and j of the second collection. So side * side
tables need 2 * side * rows minima instead of side * side * 2 * rows. Two documents with similarity s meet in a table with
probability (1 - (1 - s^rows)^side)^2, at 0.8 and the values below 0.9985.

Documents with equal sets become one node first. In a table's group of two the pair is the candidate; in a larger group all
are held against its smallest node. Links are confirmed on the full sets and joined by union-find. Then components that meet
in a table, yet aren't joined, are held against each other in blocks, every node of the smaller one with the members of the
larger one. So each pair that meets in a table is checked unless it is in one component already, and a group of copies never
makes all its pairs.

Defined results: a null or empty text, or one without words, has an empty set, is linked with nothing and kept; fewer words
than a shingle make one shingle of them all; rows of one doc_id are one document; a row with a null doc_id is linked with
nothing, has a null component and is kept; extra columns are ignored by `near_duplicates`, kept by `deduplicated`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_ASCII, WordHashes, as_bytes, mixed, rows_of, shared_counts, stored, window_hashes
from .components import components

SIDE, ROWS = 10, 3
_ROW = pa.struct([("set_id", pa.binary()), ("n_shingles", pa.int64()), ("first", pa.list_(pa.int64())), ("second", pa.list_(pa.int64())), ("bits", pa.binary())])


def shingle_set(raw: bytes | None, n: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of the text's n-word shingles."""
    words = raw.translate(LOWER_ASCII).split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes.of(words), min(n, len(words))))


class HalfKeys:
    """Minima of permuted hashes, joined to two collections of half-keys."""

    def __init__(self, side: int = SIDE, rows: int = ROWS, seed: int = 4):
        draw = np.random.default_rng(seed)
        k = 2 * side * rows
        self.side, self.rows = side, rows
        self.flip = draw.integers(0, 1 << 63, (k, 1), np.uint64)
        self.times = draw.integers(0, 1 << 63, (k, 1), np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, shingles: np.ndarray, step: int = 4096) -> tuple[np.ndarray, bytes]:
        """The half-keys, and a byte of each minimum."""
        low = np.full(len(self.flip), np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(shingles), step):
            low = np.minimum(low, ((shingles[i : i + step] ^ self.flip) * self.times).min(axis=1))
        keys = np.arange(2 * self.side, dtype=np.uint64)
        for column in low.reshape(2 * self.side, self.rows).T:
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
        return keys.view(np.int64), (mixed(low) & np.uint64(255)).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, shingle: int, side: int = SIDE, rows: int = ROWS) -> DataFrame:
    """(doc_id, set_id, n_shingles, first, second, bits) of every row; set_id is null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys = WordHashes(), HalfKeys(side, rows)
        for batch in rows_of(batches):
            out = []
            for raw in as_bytes(batch.column(1)):
                found = shingle_set(raw, shingle, hashes)
                if not len(found):
                    out.append({"n_shingles": 0})
                    continue
                k, bits = keys.of(found)
                out.append({"set_id": xxhash.xxh3_128_digest(found.tobytes()), "n_shingles": len(found), "first": k[:side], "second": k[side:], "bits": bits})
            made = pa.array(out, _ROW)
            yield pa.record_batch([batch.column(0), *(made.field(i) for i in range(len(_ROW)))], names=["doc_id", *(f.name for f in _ROW)])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, set_id binary, n_shingles long, first array<long>, second array<long>, bits binary")


def _packed_sets(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles): the packed full set of each node's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in rows_of(batches):
            packed = [shingle_set(x, shingle, hashes).tobytes() for x in as_bytes(batch.column(1))]
            yield pa.record_batch({"node": batch.column(0), "shingles": pa.array(packed, pa.binary())})

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    return texts.join(nodes, "node", "left_semi").mapInArrow(run, "node long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum()) if len(p) * 100 >= percent * len(q) else 0
                linked.append(both > 0 and 100 * both >= percent * (len(p) + len(q) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return two.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _rooted(rows: DataFrame, roots: DataFrame, node: str = "node") -> DataFrame:
    """rows with the root of each node."""
    return rows.join(roots.withColumnRenamed("node", node), node, "left").withColumn("root", F.coalesce("root", F.col(node)))


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that sizes and agreeing minima leave possible: two sets that are linked agree in fewer than half of `percent` of
    60 minima about once in 10^12 times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                possible = (x == y).mean(axis=1) * 200 >= percent
                yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(possible))

    one = pairs.join(nodes.select(F.col("node").alias("a"), F.col("k.bits").alias("x"), F.col("n_shingles").alias("nx")), "a")
    two = one.join(nodes.select(F.col("node").alias("b"), F.col("k.bits").alias("y"), F.col("n_shingles").alias("ny")), "b")
    return two.where(F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent).select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


#: Bytes of packed sets that are held together in a block, and sets.
BLOCK, BLOCK_SETS = 1 << 19, 1024
#: Components of fewer nodes are pooled.
SMALL = 64


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """rows (big, root, node, shingles), packed to blocks of about BLOCK bytes, or BLOCK_SETS sets, of one root, dealt by the node's hash."""
    parts = rows.groupBy("big", "root").agg(F.greatest(F.ceil(F.sum(F.length("shingles")) / BLOCK), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.greatest("parts", F.lit(1)))
    return rows.join(parts, ["big", "root"]).groupBy("big", "root", part.alias("part")).agg(F.collect_list(F.struct("node", "shingles")).alias(name)).drop("part")


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of the sets of x with those of y."""
    flat = [np.concatenate(sets) for sets in (x, y)]
    owners = [np.repeat(np.arange(len(sets)), [len(s) for s in sets]) for sets in (x, y)]
    return shared_counts(flat[0], owners[0], len(x), flat[1], owners[1], len(y))


def _linked_across(members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) between components that meet in a table, found block against block, so that rows are few whatever the
    size of the components. A node that meets a component larger than its own is held against that one's members; the nodes of
    components below SMALL that meet, directly or by others, are pooled and held against each other."""
    placed = _rooted(members, roots)
    whole = _rooted(sets, roots)
    weight = whole.groupBy("root").agg(F.count(F.lit(1)).alias("weight"))
    there = placed.select("key", "root").distinct()
    several = there.groupBy("key").agg(F.count(F.lit(1)).alias("roots"), F.min("root").alias("least")).where("roots > 1").drop("roots")
    there = stored(there.join(several, "key").join(weight, "root"), "there")
    family = components(there.select(F.col("root").alias("a"), F.col("least").alias("b")).distinct())
    family = family.select(F.col("node").alias("root"), F.col("root").alias("family"))
    big = F.col("weight") >= SMALL
    there = there.join(family, "root", "left").select("key", big.alias("big"), F.when(big, F.col("root")).otherwise(F.coalesce("family", "root")).alias("root"), F.when(big, F.col("weight")).otherwise(0).alias("weight")).distinct()
    here = placed.join(several.select("key"), "key", "left_semi").join(weight, "root").withColumnsRenamed({"root": "own", "weight": "own_weight"})
    after = F.when(F.col("big"), F.struct("own_weight", "own") < F.struct("weight", "root")).otherwise(F.col("own_weight") < SMALL)
    meets = stored(here.join(there, "key").where(after).select("node", "big", "root").distinct(), "meets")
    pool = meets.where("not big")
    of_big = whole.join(meets.where("big").select("root").distinct(), "root", "left_semi").select(F.lit(True).alias("big"), "root", "node", "shingles")
    smaller = _blocks(meets.join(sets, "node"), "x")
    larger = _blocks(of_big.unionByName(pool.join(sets, "node").select("big", "root", "node", "shingles")), "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y = ([np.frombuffer(e["shingles"], np.uint64) for e in row[side]] for side in "xy")
                common = _common(x, y)
                total = np.array([[len(e)] for e in x]) + np.array([len(e) for e in y]) - common
                i, j = np.nonzero((common > 0) & (100 * common >= percent * total))
                a, b = np.array([e["node"] for e in row["x"]], np.int64)[i], np.array([e["node"] for e in row["y"]], np.int64)[j]
                yield pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))}).filter(pa.array(a != b))

    return smaller.join(larger, ["big", "root"]).select("x", "y").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, side: int = SIDE, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    signed = stored(signatures(docs, shingle, side, rows), "signatures")
    named = signed.where("doc_id is not null and set_id is not null")
    nodes = named.groupBy("set_id").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n_shingles"), F.min_by(F.struct("first", "second", "bits"), "doc_id").alias("k"))
    nodes = stored(nodes, "nodes")
    keys = F.flatten(F.transform("k.first", lambda x: F.transform("k.second", lambda y: F.xxhash64(x, y))))
    tabled = nodes.select("node", F.explode(keys).alias("key"))
    groups = tabled.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = stored(groups, "groups")
    twos = groups.where("n = 2 and low < high").select(F.col("low").alias("a"), F.col("high").alias("b")).distinct()
    members = stored(tabled.join(groups.where("n > 2").select("key"), "key").distinct(), "members")
    met = twos.select(F.col("a").alias("node")).union(twos.select("b")).union(members.select("node")).distinct()
    sets = stored(_packed_sets(docs, met, shingle), "sets")
    least = members.groupBy("key").agg(F.min("node").alias("a"))
    stars = members.join(least, "key").where("node != a").select("a", F.col("node").alias("b"))
    links = stored(_verified(_near(twos.union(stars).distinct(), nodes, percent), sets, percent), "links")
    roots = stored(components(links), "roots")
    more = stored(_linked_across(members, roots, sets, percent), "links")
    roots = stored(components(links.unionByName(more)), "roots")
    of_set = _rooted(nodes.select("set_id", "node"), roots).select("set_id", F.col("root").alias("component_id"))
    out = signed.select("doc_id", "set_id", "n_shingles").join(of_set, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs, as they are, without those that a smaller doc_id of their component stands for."""
    gone = near_duplicates(docs, shingle, percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone.withColumnRenamed("doc_id", "__millrace_gone"), F.col("doc_id") == F.col("__millrace_gone"), "left_anti")
