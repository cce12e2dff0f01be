"""Operator 7: nearest neighbours by largest inner product, with score-aware quantisation.

A bounded sample fits coarse centres and, on the residuals, sixteen centres for each few dimensions. Codes are chosen and
centres moved under the anisotropic loss: the part of the error along the vector, which changes large inner products, counts
`eta` times the part across it. Every distinct vector is indexed: its cell and four-bit codes. A query looks into the cells
whose centres have the largest inner products with it, scans their codes by table look-up, and re-ranks the best exactly in
double precision. The vectors are dealt to LANES lanes by their hash, whatever their cell; a task holds a bounded group of queries
against one lane, block after block, and gives k rows a query at the end. So rows out grow with the queries alone; each group of
queries reads all vectors. Equal vectors are one entry with their smallest ids, as many as a result can show.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, neither do those
whose length isn't the most frequent one (the smaller of two as frequent) or whose id is null; a repeated id is listed once
for each distinct vector that it has; a query with fewer candidates returns them all; no vectors: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

SAMPLE = 16_384
#: Vectors of a block, and queries that are held against it at once.
ROWS, QUERIES = 4096, 256
#: Parts of the vectors, and queries that a task holds about.
LANES, GROUP = 8, 8192
#: Vectors of a block that are re-ranked at least.
LEAST = 160


def _clusters(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centres = x[draw.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = ((centres**2).sum(1) / 2 - x @ centres.T).argmin(1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, x[:, j], len(centres)) for j in range(x.shape[1])], 1)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


@dataclass
class Quantiser:
    """Coarse centres (cells, d) and, for each group of dimensions, sixteen centres of residuals."""

    cells: np.ndarray
    books: np.ndarray  # (groups, 16, width)
    eta: float

    @property
    def groups(self) -> int:
        return len(self.books)

    def padded(self, x: np.ndarray) -> np.ndarray:
        width = self.groups * self.books.shape[2]
        return np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x

    def cell_of(self, x: np.ndarray) -> np.ndarray:
        return ((self.cells**2).sum(1) / 2 - x @ self.cells.T).argmin(1)

    def encode(self, x: np.ndarray, cell: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes (n, groups) that lower the loss one group after another, from the nearest centres on."""
        groups, _, width = self.books.shape
        residual = self.padded(x - self.cells[cell]).reshape(len(x), groups, width)
        along = self.padded(x / np.linalg.norm(x, axis=1, keepdims=True)).reshape(len(x), groups, width)
        error = residual[:, :, None, :] - self.books[None]  # (n, groups, 16, width)
        square, part = (error**2).sum(3), np.einsum("ngkw,ngw->ngk", error, along)
        codes, rows = square.argmin(2), np.arange(len(x))
        total = np.take_along_axis(part, codes[:, :, None], 2)[:, :, 0].sum(1)
        for _ in range(sweeps):
            for g in range(groups):
                rest = total - part[rows, g, codes[:, g]]
                codes[:, g] = (square[:, g] + (self.eta - 1) * (rest[:, None] + part[:, g]) ** 2).argmin(1)
                total = rest + part[rows, g, codes[:, g]]
        return codes.astype(np.uint8)

    def improve(self, x: np.ndarray, cell: np.ndarray, codes: np.ndarray) -> None:
        """Moves every centre to where the loss of its vectors is least, the other groups held."""
        groups, k, width = self.books.shape
        residual = self.padded(x - self.cells[cell]).reshape(len(x), groups, width)
        along = self.padded(x / np.linalg.norm(x, axis=1, keepdims=True)).reshape(len(x), groups, width)
        part = np.einsum("ngw,ngw->ng", residual - np.stack([self.books[g, codes[:, g]] for g in range(groups)], 1), along)
        for g in range(groups):
            u, r = along[:, g], residual[:, g]
            rest = part.sum(1) - part[:, g]
            right = r + (self.eta - 1) * u * (rest + (u * r).sum(1))[:, None]
            for c in range(k):
                mine = codes[:, g] == c
                if mine.sum() > width:
                    left = mine.sum() * np.eye(width) + (self.eta - 1) * u[mine].T @ u[mine]
                    self.books[g, c] = np.linalg.solve(left + 1e-9 * np.eye(width), right[mine].sum(0))
            part[:, g] = ((r - self.books[g, codes[:, g]]) * u).sum(1)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(n, groups, 16): a query's inner products with the centres of residuals."""
        groups, _, width = self.books.shape
        return np.einsum("ngw,gkw->ngk", self.padded(q).reshape(len(q), groups, width), self.books)


def fit(x: np.ndarray, cells: int, width: int = 4, threshold: float = 0.2, rounds: int = 3) -> Quantiser:
    d = x.shape[1]
    centres = _clusters(x, cells)
    groups = -(-d // width)
    eta = max(1.0, (d - 1) * threshold**2 / (1 - threshold**2))
    made = Quantiser(centres, np.zeros((groups, 16, width)), eta)
    cell = made.cell_of(x)
    residual = made.padded(x - centres[cell]).reshape(len(x), groups, width)
    for g in range(groups):
        book = _clusters(residual[:, g], 16)
        made.books[g, : len(book)] = book
        made.books[g, len(book) :] = book[0]
    for _ in range(rounds):
        made.improve(x, cell, made.encode(x, cell))
    return made


def vectors(embeddings: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col(column).cast("array<double>")
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (length[0]["n"] if length else 0))


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20, probes: float = 0.9, scanned: float = 0.2, per_cell: int = 2000, most_cells: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose id is divisible by `every`, itself left out.

    probes: share of the cells that a query looks into; scanned: share of a block that is re-ranked exactly, LEAST vectors at least."""
    spark = embeddings.sparkSession
    rows = vectors(embeddings)
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    entries = rows.distinct().withColumn("r", smallest).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = stored(entries.withColumn("h", F.xxhash64("v")), "vectors")
    n = entries.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array([r[0] for r in entries.orderBy("h").limit(SAMPLE).select("v").toLocalIterator()])
    made = fit(sample, int(np.clip(n // per_cell, 1, most_cells)))
    n_probes = max(1, int(np.ceil(probes * len(made.cells))))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column(0).to_numpy(zero_copy_only=False))
                cell = made.cell_of(x)
                codes = np.concatenate([made.encode(x[i : i + 1024], cell[i : i + 1024]) for i in range(0, len(x), 1024)])
                codes = np.pad(codes, ((0, 0), (0, codes.shape[1] % 2)))
                packed = [c.tobytes() for c in (codes[:, ::2] << 4 | codes[:, 1::2])]
                yield pa.record_batch({"v": batch.column(0), "ids": batch.column(1), "h": batch.column(2), "cell": pa.array(cell, pa.int32()), "codes": pa.array(packed, pa.binary())})

    indexed = entries.mapInArrow(index, "v array<double>, ids array<long>, h long, cell int, codes binary")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, None
        for batch in batches:
            group, lane, kind = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((np.diff(group) != 0) | (np.diff(lane) != 0) | (np.diff(kind) != 0)) + 1
            for i, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if i == end:
                    continue
                if task != (group[i], lane[i]):
                    if held is not None:
                        yield held.rows()
                    task, held = (group[i], lane[i]), _Held(made, n_probes, k, scanned)
                for j in range(i, end, ROWS):
                    part = batch.slice(j, min(ROWS, end - j))
                    x, ids = np.stack(part.column(4).to_numpy(zero_copy_only=False)), part.column(5).to_pylist()
                    if kind[i] == 0:
                        held.ask(x, [e[0] for e in ids])
                    else:
                        held.scan(x, ids, part.column(3).to_numpy(), part.column(6).to_pylist())
        if held is not None:
            yield held.rows()

    asking = rows.where(F.col("vec_id") % every == 0).distinct()
    n_groups = max(1, -(-asking.count() // GROUP))
    numbers = lambda most: F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    asked = asking.select(
        F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_groups)).cast("int").alias("group"), numbers(LANES).alias("lane"), F.lit(0).alias("kind"),
        F.lit(0).alias("cell"), "v", F.array("vec_id").alias("ids"), F.lit(b"").alias("codes"),
    )
    there = indexed.select(numbers(n_groups).alias("group"), F.pmod("h", F.lit(LANES)).cast("int").alias("lane"), F.lit(1).alias("kind"), "cell", "v", "ids", "codes")
    # a task reads its queries first, then its vectors
    dealt = asked.unionByName(there).repartition("group", "lane").sortWithinPartitions("group", "lane", "kind")
    found = dealt.mapInArrow(scan, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class _Held:
    """Queries, and the k nearest of each among the vectors that they were held against."""

    def __init__(self, made: Quantiser, n_probes: int, k: int, scanned: float):
        self.made, self.n_probes, self.k, self.scanned = made, n_probes, k, scanned
        self.asking: list[tuple] = []
        self.ids: list[int] = []
        self.best: list[list[tuple[float, int]]] = []

    def ask(self, q: np.ndarray, ids: list[int]) -> None:
        for i in range(0, len(q), QUERIES):
            some = q[i : i + QUERIES]
            centre = some @ self.made.cells.T
            unseen = np.argsort(-centre, axis=1, kind="stable")[:, self.n_probes :]
            np.put_along_axis(centre, unseen, -np.inf, 1)
            self.asking.append((len(self.ids) + i, some, centre.astype(np.float32), self.made.tables(some).astype(np.float32)))
        self.ids += ids
        self.best += [[] for _ in ids]

    def scan(self, x: np.ndarray, ids: list[list[int]], cell: np.ndarray, packed: list[bytes]) -> None:
        k = self.k
        nibbles = np.frombuffer(b"".join(packed), np.uint8).reshape(len(x), -1)
        codes = np.stack([nibbles >> 4, nibbles & 15], 2).reshape(len(x), -1)[:, : self.made.groups]
        most = min(len(x), max(LEAST, k, int(np.ceil(self.scanned * len(x)))))
        for start, q, centre, tables in self.asking:
            rough = centre[:, cell]
            for g in range(self.made.groups):
                rough += tables[:, g][:, codes[:, g]]
            best = np.argpartition(-rough, most - 1, axis=1)[:, :most] if most < len(x) else np.tile(np.arange(len(x)), (len(q), 1))
            for j in range(len(q)):
                mine = best[j][rough[j, best[j]] > -np.inf]  # of the cells that the query looks into
                exact = (x[mine] * q[j]).sum(1)
                me, found, had = self.ids[start + j], [], self.best[start + j]
                least = had[k - 1][0] if len(had) == k else -np.inf
                for o in np.argsort(-exact, kind="stable").tolist():
                    if exact[o] < least or (len(found) >= k and exact[o] < found[k - 1][0]):
                        break
                    found += [(float(exact[o]), v) for v in ids[mine[o]] if v != me]
                if found:
                    self.best[start + j] = sorted(had + found, key=lambda e: (-e[0], e[1]))[:k]

    def rows(self) -> pa.RecordBatch:
        n = [len(e) for e in self.best]
        score, ids = zip(*(e for best in self.best for e in best)) if sum(n) else ((), ())
        return pa.record_batch({"query_id": pa.array(np.repeat(np.array(self.ids, np.int64), n)), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.float64())})
