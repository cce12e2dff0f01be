"""Raw sources: bytes that were fetched outside Spark, decoded and cut to candidate rows."""

from __future__ import annotations

import concurrent.futures
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fetched(fetch: Callable[[], bytes], seconds: float = 8.0) -> bytes | None:
    """What fetch gives within the time, else None; also None when it fails. Runs on the driver, outside Spark."""
    pool = concurrent.futures.ThreadPoolExecutor(1)
    try:
        return pool.submit(fetch).result(seconds)
    except Exception:
        return None
    finally:
        pool.shutdown(wait=False)


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length, content) of the files below a path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def decoded(content: Column, encoding: str = "cp932") -> Column:
    """The text of bytes in an encoding that Spark lacks; null for bytes that aren't valid in it."""

    def one(raw: bytes | None) -> str | None:
        try:
            return None if raw is None else raw.decode(encoding)
        except UnicodeDecodeError:
            return None

    return F.arrow_udf(lambda x: pa.array(map(one, x.to_pylist()), pa.string()), "string")(content)


def table_cells(html: Column) -> Column:
    """Rows of cells of the tables in an HTML text, tags taken off."""
    rows = F.regexp_extract_all(html, F.lit("(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = lambda r: F.regexp_extract_all(r, F.lit("(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(cells(r), lambda c: F.trim(F.regexp_replace(c, "<[^>]*>", ""))))


def pdf_text(content: Column) -> Column:
    """The text of PDF bytes, where a PDF library is installed on the executors."""

    def run(column: pa.Array) -> pa.Array:
        import io

        import pypdf

        pages = (pypdf.PdfReader(io.BytesIO(x)).pages if x else [] for x in column.to_pylist())
        return pa.array(["\n".join(p.extract_text() or "" for p in all_of) for all_of in pages], pa.string())

    return F.arrow_udf(run, "string")(content)
