"""Operator 9: a quality classifier of sparse rules.

Statistics of a text's bytes and words are computed over Arrow batches. On a bounded sample of labelled rows the driver grows
small boosted trees over them, takes every path from a root as a conjunctive rule, and fits a logistic model with lasso
weights over the rules; most weights become zero. The rest is compiled to one Spark column expression, the score.

Only statistics of the text are inputs. The sample holds the labelled rows with the smallest hashes of their id, at most
`most_rows` of them, which bounds what reaches the driver; everything else runs over all rows.

Defined results: a null or empty text has all-zero statistics and gets their score; a label given several times counts by its
mean; labels without a document or with a null id or value are ignored; without labels of both kinds every score is the share
of good ones (0.5 without any); rows are never dropped by `scores`; extra columns are ignored by it, kept by `accepted`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, rows_of

STATISTICS = (
    "log_bytes", "log_words", "word_length", "distinct_words", "repeats", "upper", "digits", "symbols", "bars", "shouts", "stops",
    "commas", "new_lines", "high_bytes", "short_words", "distinct_lines", "bare_words", "brackets", "line_length",
)
MOST_ROWS = 20_000


def _but(drop: bytes) -> bytes:
    return bytes(b for b in range(256) if b not in drop)


_KEEP = {
    "upper": _but(bytes(range(65, 91))), "digits": _but(b"0123456789"), "symbols": _but(b"#$%&*@^~=+_"), "bars": _but(b"|"), "shouts": _but(b"!?"),
    "stops": _but(b"."), "commas": _but(b","), "new_lines": _but(b"\n"), "high_bytes": _but(bytes(range(128, 256))), "brackets": _but(b"<>{}[]()"),
}


def statistics_of(raw: bytes | None) -> tuple[float, ...]:
    if not raw:
        return (0.0,) * len(STATISTICS)
    size, words, lines = len(raw), raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    share = {k: len(raw.translate(None, drop)) / size for k, drop in _KEEP.items()}
    lengths = list(map(len, words))
    return (
        float(np.log1p(size)), float(np.log1p(len(words))), sum(lengths) / n, len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
        share["upper"], share["digits"], share["symbols"], share["bars"], share["shouts"], share["stops"], share["commas"], share["new_lines"],
        share["high_bytes"], sum(x <= 3 for x in lengths) / n, len(set(lines)) / len(lines), sum(map(bytes.isalpha, words)) / n, share["brackets"],
        float(np.log1p(size / len(lines))),
    )


_KIND = pa.struct([(k, pa.float64()) for k in STATISTICS])


def statistics(text: Column) -> Column:
    """A struct of the statistics of each text."""

    def run(column: pa.Array) -> pa.Array:
        rows = np.array([statistics_of(x) for x in as_bytes(column)], np.float64).reshape(-1, len(STATISTICS))
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(STATISTICS))], fields=list(_KIND))

    return F.arrow_udf(run, "struct<" + ", ".join(f"{k}: double" for k in STATISTICS) + ">")(text.cast("string"))


@dataclass(frozen=True)
class Rule:
    """All of its conditions hold: (statistic, whether it is at most the limit or else above, limit)."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self, of: str) -> Column:
        out = F.lit(True)
        for name, below, limit in self.conditions:
            out &= (F.col(of)[name] <= limit) if below else (F.col(of)[name] > limit)
        return out

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, below, limit in self.conditions:
            value = x[:, STATISTICS.index(name)]
            out &= value <= limit if below else value > limit
        return out


@dataclass(frozen=True)
class Model:
    intercept: float
    rules: tuple[tuple[Rule, float], ...] = ()

    def column(self, of: str) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total += F.when(rule.column(of), float(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            total += weight * rule.holds(x)
        return 1 / (1 + np.exp(-total))


def _grow(codes: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, weight: np.ndarray, depth: int, least: int):
    """A tree by second-order gains: yields (conditions, rows, value) of every node below the root; leaves come marked."""

    def gain(g, h):
        return g * g / (h + 1.0)

    def split(rows: np.ndarray, conditions: tuple, left: int):
        g_all, h_all, best = gradient[rows].sum(), weight[rows].sum(), None
        if left and len(rows) >= 2 * least:
            for j, limits in enumerate(cuts):
                k = len(limits) + 1
                if k < 2:
                    continue
                c = codes[rows, j]
                g, h, n = (np.cumsum(np.bincount(c, w, k))[:-1] for w in (gradient[rows], weight[rows], np.ones(len(rows))))
                score = gain(g, h) + gain(g_all - g, h_all - h) - gain(g_all, h_all)
                score[(n < least) | (len(rows) - n < least)] = -1
                at = int(np.argmax(score))
                if score[at] > 1e-6 and (best is None or score[at] > best[0]):
                    best = (score[at], j, at)
        yield conditions, rows, -g_all / (h_all + 1.0), best is None
        if best:
            _, j, at = best
            low = codes[rows, j] <= at
            for below, part in ((True, rows[low]), (False, rows[~low])):
                yield from split(part, (*conditions, (STATISTICS[j], below, float(cuts[j][at]))), left - 1)

    yield from split(np.arange(len(codes)), (), depth)


def _lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic loss with an absolute penalty on the weights, by accelerated proximal steps."""
    n, k = x.shape
    scale = np.linalg.norm(x, 2) ** 2 / (4 * n) + 0.25
    step = 1 / scale
    mean = y.mean()
    b, w = float(np.log(mean / (1 - mean))), np.zeros(k)
    bz, wz, t = b, w.copy(), 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(x @ wz + bz))) - y
        b_new = bz - step * error.mean()
        moved = wz - step * (x.T @ error) / n
        w_new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        bz, wz = b_new + (t - 1) / t_new * (b_new - b), w_new + (t - 1) / t_new * (w_new - w)
        b, w, t = b_new, w_new, t_new
    return b, w


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, bins: int = 32, penalty: float = 1e-3) -> Model:
    """The rule ensemble of statistics x and labels y (0 or 1, or shares between)."""
    if len(y) == 0 or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Model(float(np.log(share / (1 - share))))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
    cuts = [c[c < x[:, j].max()] for j, c in enumerate(cuts)]
    codes = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    raw = np.full(len(y), np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))
    rules: dict[Rule, None] = {}
    least = max(5, len(y) // 500)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        for conditions, rows, value, leaf in _grow(codes, cuts, p - y, p * (1 - p), depth, least):
            if leaf:
                raw[rows] += 0.3 * value
            if conditions:
                rules[Rule(conditions)] = None
    held = np.stack([r.holds(x) for r in rules], 1).astype(np.float64) if rules else np.zeros((len(y), 0))
    distinct = np.unique(held, axis=1, return_index=True)[1] if rules else np.array([], int)
    kept = [list(rules)[i] for i in sorted(distinct)]
    b, w = _lasso(held[:, sorted(distinct)], y, penalty)
    return Model(b, tuple((r, float(v)) for r, v in zip(kept, w, strict=True) if abs(v) > 1e-9))


def train_rows(doc_id: Column) -> Column:
    """Labels are learnt only from rows whose crc32(doc_id as text) mod 4 is not 2."""
    return F.crc32(doc_id.cast("string")) % 4 != 2


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """A model from labels (doc_id, quality) of at most most_rows documents."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality")).dropna()
    known = known.where(train_rows(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)  # its size is bounded: it may be broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            found = np.array([statistics_of(x) for x in as_bytes(batch.column(1))], np.float64).reshape(-1, len(STATISTICS))
            columns = {k: pa.array(found[:, i]) for i, k in enumerate(STATISTICS)}
            yield pa.record_batch({"doc_id": batch.column(0), **columns, "quality": batch.column(2)})

    kind = "doc_id long, " + ", ".join(f"{k} double" for k in STATISTICS) + ", quality double"
    got = rows.mapInArrow(run, kind).orderBy("doc_id").limit(4 * most_rows).toArrow()
    x = np.stack([got[k].to_numpy() for k in STATISTICS], 1) if got.num_rows else np.zeros((0, len(STATISTICS)))
    return fit(x, got["quality"].to_numpy())


def scores(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), statistics(F.col("text")).alias("s"))
    scored = rows.select("doc_id", F.coalesce(~train_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), model.column("s").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of docs, as they are, whose score reaches the threshold."""
    mark = "__millrace_statistics"
    return docs.withColumn(mark, statistics(F.col("text"))).where(model.column(mark) >= threshold).drop(mark)
