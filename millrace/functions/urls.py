"""Column functions on URLs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_query(url: Column) -> Column:
    """The url without its fragment and query."""
    return F.split_part(F.split_part(url, F.lit("#"), F.lit(1)), F.lit("?"), F.lit(1))


def is_one_of(url: Column, known: Iterable[str]) -> Column:
    """Whether the url, without fragment and query, is one of the known ones."""
    return without_query(url).isin(list(known))


def host_of(url: Column) -> Column:
    """The host, null for what isn't a URL."""
    return F.try_parse_url(url, F.lit("HOST"))


def on_hosts(url: Column, hosts: Iterable[str]) -> Column:
    """Whether the url's host is on the list; what isn't a URL is on none."""
    return F.coalesce(host_of(url).isin(list(hosts)), F.lit(False))


def links_in(html: Column) -> Column:
    """The targets of all links in an HTML text, quoted or not; a cell that only says "PDF" has none."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)(?<![\w-])href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1))
    return F.transform(found, lambda x: F.regexp_replace(x, "^[\"']|[\"']$", ""))


def is_entry_link(label: Column, link: Column) -> Column:
    """Whether a link with that label leads to an entry: entry lists, results and practice sessions don't, nor does a missing link."""
    other = F.lower(F.coalesce(label, F.lit(""))).rlike(r"エントリー\s*リスト|結果|練習会|entry\s*list|results?\b")
    return F.coalesce(F.trim(link) != "", F.lit(False)) & ~other


def route(method: Column, url: Column, mode: Column, origin: str, data_url: str, shell: Iterable[str]) -> Column:
    """What handles a request: the first of the rules that fits, in this order."""
    return (
        F.when(method != "GET", "skip: method")
        .when(~F.startswith(url, F.lit(origin)), "skip: origin")
        .when(mode == "navigate", "navigation")
        .when(without_query(url) == data_url, "data")
        .when(is_one_of(url, shell), "shell")
        .otherwise("skip: unknown")
    )
