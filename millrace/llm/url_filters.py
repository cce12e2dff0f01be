"""Operator 1 [native]: URL rules by a sort-merge range join.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with the rule's. Its canonical
key is the reversed host, a separator and the path, so that what it fits is one interval of keys: those that start
with it. Such intervals are nested or apart. A url gives one point for each tail of its host (`a.b.c`: `c`, `b.c`,
`a.b.c`), as far as rules are deep. Points and the starts of rules are dealt to ranges of keys and each range is swept
in the order of keys: the last start before a point carries the stack of the rules open there, and the entries that the
point has passed are popped by comparing prefixes. Ranges take over the stack open at their lower end.

Equal urls are judged once and joined back, so that a hot url or host costs one row; points with a key that fills
several ranges are spread over them. Only column functions are used.

Defined results: a null url or one without `://` has host and path '' and gets the default verdict; ports and user names
stay part of the host; of equal rules `block` wins; of the rules that fit, the longest string wins, then the longer
host; no rules: all get the default; every row of pages gives one row, repeated ones too; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Parts host and path of a canonical key.
MARK = "\x00"
#: How many points, of the smallest hashes, set the limits of ranges; it bounds what reaches the driver.
SAMPLE = 16384
#: Ranges at most; below that there are as many as shuffle partitions.
RANGES = 2048
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both '' for a null or one without '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(raw, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit(MARK), path)


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): of each rule, itself and the rules around it."""
    host = F.translate(F.col("host"), UPPER, LOWER)
    path = F.coalesce(F.col("path"), F.lit(""))
    one = rules.where(F.col("host").isNotNull()).select(
        _key(F.split(host, r"\."), path).alias("key"),
        F.concat(host, path).alias("rule"), F.length(host).alias("host_length"), "verdict",
    )
    one = one.groupBy("key").agg(F.max(F.struct("verdict", "rule", "host_length")).alias("r"))
    starts = one.select("key", F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.left(F.col("key"), n))).alias("around"))
    entry = F.struct(F.col("key").alias("key"), F.length("r.rule").alias("length"), "r.host_length", "r.rule", "r.verdict").alias("entry")
    return starts.join(one.select(F.col("key").alias("around"), entry), "around").groupBy("key").agg(F.collect_list("entry").alias("stack"))


def _below(limits: list[str], key: Column, equal: bool) -> Column:
    """How many of the sorted limits are below the key, or equal to it: whole strides of them first, then within one."""
    if not limits:
        return F.lit(0)
    below = (lambda x: x <= key) if equal else (lambda x: x < key)
    stride = math.isqrt(len(limits) - 1) + 1
    strides = F.size(F.filter(F.array(*map(F.lit, limits[stride - 1 :: stride])), below)) * stride
    rest = F.slice(F.array(*map(F.lit, limits)), strides + 1, stride)
    return strides + F.size(F.filter(rest, below))


def sweep(points: DataFrame, stacks: DataFrame, limits: list[str]) -> DataFrame:
    """points (key, spread, ...) with `best`, the struct of the rule that wins, or null; limits part the ranges of keys."""
    names = [c for c in points.columns if c != "spread"]
    low, high = _below(limits, F.col("key"), False), _below(limits, F.col("key"), True)
    dealt = points.withColumn("bucket", low + F.pmod(F.col("spread"), (high - low + 1).cast("long")).cast("int")).drop("spread")
    starts = stacks.select(low.alias("bucket"), "key", "stack")
    last = starts.groupBy("bucket").agg(F.max_by(F.struct("key", "stack"), "key").alias("x")).where(F.col("bucket") < len(limits))
    later = F.explode(F.sequence(F.col("bucket") + 1, F.lit(len(limits)))).alias("bucket")
    taken_over = last.select(later, "x").groupBy("bucket").agg(F.max_by("x.stack", "x.key").alias("stack"))
    events = dealt.withColumn("kind", F.lit(1)).unionByName(starts.withColumn("kind", F.lit(0)), True).unionByName(taken_over.select("bucket", F.lit("").alias("key"), "stack", F.lit(0).alias("kind")), True)
    so_far = Window.partitionBy("bucket").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = events.withColumn("stack", F.last("stack", True).over(so_far)).where("kind = 1")
    fits = F.filter("stack", lambda x: F.startswith(F.col("key"), x["key"]))
    best = F.array_max(F.transform(fits, lambda x: F.struct(x["length"].alias("length"), x["host_length"].alias("host_length"), x["rule"].alias("rule"), x["verdict"].alias("verdict"))))
    return swept.select(*names, best.alias("best"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", ranges: int | None = None) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of pages; rules: (host, path, verdict)."""
    spark = pages.sparkSession
    host, path = url_parts(F.col(url_col).cast("string"))
    judged = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0]
    if deepest is None:
        return judged.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    labels = F.split("host", r"\.")
    urls = judged.where("host <> ''").select("host", "path").distinct()
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))), lambda n: _key(F.slice(labels, F.size(labels) - n + 1, n), F.col("path")))
    points = urls.select("host", "path", F.explode(tails).alias("key")).withColumn("spread", F.xxhash64("host", "path"))
    n = ranges or min(RANGES, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    sample = sorted(r[0] for r in points.select("key", "spread").orderBy("spread", "key").limit(SAMPLE).select("key").collect())
    limits = [sample[i * len(sample) // n] for i in range(1, n)] if len(sample) >= n else []
    best = sweep(points, rule_stacks(rules), limits).groupBy("host", "path").agg(F.max("best").alias("best"))
    found = best.where("best is not null").select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    return judged.join(found, ["host", "path"], "left").select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
