"""Main text of pages by differencing with the nearest page of the host.

Pages of a host are paired by URL path: the nearest page is the neighbour in
path order with the longer common start.  Of its lines only those count that
further pages of the host confirm as the site's template, for neighbours may be
near copies.  The lines of both are aligned by their longest common
subsequence, and those that they share are deleted; this decides every line that no element marks, on pages
with an article element as on those without.  What marks itself as surroundings
(menus, footers, adverts, forms, comments) is deleted whether shared or not, and
lines inside an article element stay even if shared: there zones decide.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidscope.llm.columns import require, with_columns
from bidscope.llm.markup import ASIDE, MAIN, OPEN, lines
from bidscope.session import stage


SMALL_URLS = 100_000          # whose lines' hashes, some hundred bytes each, are broadcast
TEMPLATE_URLS = 3             # a line of the template is on as many URLs of the host at least, and on half of them


def line_hashes(found: list[tuple[str, int]]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(line) - (1 << 63) for line, _ in found]


def shared_lines(a: list[int], b: list[int | None]) -> set[int]:
    """Indexes of a's lines in a longest common subsequence of both.

    Equal ends first; of the rest, pairs of equal lines in order, each put
    where it ends the shortest-reaching subsequence of its length (Hunt and
    Szymanski)."""
    begin, end = 0, 0
    while begin < min(len(a), len(b)) and a[begin] == b[begin]:
        begin += 1
    while end < min(len(a), len(b)) - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    shared = {*range(begin), *range(len(a) - end, len(a))}
    places: dict[int, list[int]] = {}
    for j in range(len(b) - end - 1, begin - 1, -1):
        places.setdefault(b[j], []).append(j)
    reach: list[int] = []                 # the smallest end in b of a subsequence of each length
    tails: list[tuple] = []
    for i in range(begin, len(a) - end):
        for j in places.get(a[i], ()):
            k = bisect_left(reach, j)
            link = (i, tails[k - 1] if k else None)
            if k == len(reach):
                reach.append(j)
                tails.append(link)
            elif j < reach[k]:
                reach[k], tails[k] = j, link
    link = tails[-1] if tails else None
    while link:
        shared.add(link[0])
        link = link[1]
    return shared


def main_text(found: list[tuple[str, int]], nearest: list[int | None] | None) -> str:
    """Lines of the article element, and the unmarked lines that the nearest
    page does not share.  A page without an article all of whose unmarked
    lines are shared is a copy, from which nothing is deleted."""
    shared = shared_lines(line_hashes(found), nearest) if nearest else set()
    if any(zone == MAIN for _, zone in found):
        shared = {i for i in shared if found[i][1] != MAIN}
    elif shared.issuperset(i for i, (_, zone) in enumerate(found) if zone == OPEN):
        shared = set()
    return "\n".join(line for i, (line, zone) in enumerate(found) if zone != ASIDE and i not in shared)


def template_lines(urls: DataFrame) -> DataFrame:
    """(host, template): the line hashes that at least half of the host's URLs
    have, and TEMPLATE_URLS of them at least; hosts without any are left out.
    Counted by partial aggregation; a host has at most twice as many such
    lines as its average page has lines."""
    sizes = urls.groupBy("host").agg(F.count("*").alias("urls")).where(F.col("urls") >= TEMPLATE_URLS)
    counts = urls.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    often = counts.where(F.col("n") >= TEMPLATE_URLS).join(sizes, "host").where(2 * F.col("n") >= F.col("urls"))
    return often.groupBy("host").agg(F.collect_list("line").alias("template"))


def few_rows(df: DataFrame) -> DataFrame:
    """For a join: broadcast a written table of at most ``SMALL_URLS`` rows."""
    return F.broadcast(df) if df.count() <= SMALL_URLS else df


def nearest_pages(pages: DataFrame) -> DataFrame:
    """(host, path, nearest): the line hashes of the nearest other URL of the
    host, null in place of lines that are not of the host's template; null if
    there is no other URL.
    ``pages`` has host, path, key and html; of several pages of a URL the one
    with the smallest key stands for it.

    All URLs are range-partitioned and numbered in order, so a large host is
    spread over tasks; neighbours meet in a join on the number."""
    def hashes(part: pa.RecordBatch) -> list:
        return [pa.array([line_hashes(lines(h or "")) for h in part.column("html").to_pylist()], pa.list_(pa.int64()))]

    found = with_columns(pages, "html", "lines array<long>", hashes, ["host", "path", "key"])
    urls = found.groupBy("host", "path").agg(F.min(F.struct("key", "lines"))["lines"].alias("lines"))
    ordered = stage(urls.repartitionByRange("host", "path").sortWithinPartitions("host", "path")
                    .withColumn("at", F.monotonically_increasing_id()), "urls")
    # One row for each partition, written so that the join knows its size.
    before = stage(ordered.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")), "before")
    numbered = ordered.join(before, F.shiftright("at", 33) == F.col("part")).select(
        (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"), "host", "path", "lines")
    beside = lambda step, name: numbered.select((F.col("number") + step).alias("number"), F.struct("host", "path", "lines").alias(name))
    both = numbered.drop("lines").join(beside(1, "before"), "number", "left").join(beside(-1, "after"), "number", "left")
    both = both.join(few_rows(stage(template_lines(ordered), "templates")), "host", "left")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, path, before, after, template in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "before", "after", "template"))):
                near = [x for x in (before, after) if x and x["host"] == host]
                near.sort(key=lambda x: -len(commonprefix([path, x["path"]])))       # the one before, if alike
                confirmed = set(template or ())
                out.append([x if x in confirmed else None for x in near[0]["lines"]] if near else None)
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("path"), pa.array(out, pa.list_(pa.int64()))], ["host", "path", "nearest"])

    return both.select("host", "path", "before", "after", "template").mapInArrow(choose, "host string, path string, nearest array<long>")


def extract(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """For each row of ``pages``: its key, ``url``, ``text`` and ``n_chars``
    (code points).  Null pages have an empty text; a null URL is a host and a
    path of its own; equal pages of one URL have equal texts.  Pages are read
    whole.  The nearest lines of up to ``SMALL_URLS`` URLs go to the pages;
    those of more meet them in one shuffle of the pages by URL."""
    require(pages, key, "url", "html")
    url = F.coalesce("url", F.lit(""))
    split = pages.select(F.col(key).alias("key"), "url", "html", F.lower(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)).alias("host"),
                         F.regexp_replace(url, r"^[^:/?#]+://[^/?#]*", "").alias("path"))
    near = few_rows(stage(nearest_pages(split.drop("url")), "nearest"))
    joined = split.join(near, ["host", "path"], "left").select("key", "url", "html", "nearest")

    def make(part: pa.RecordBatch) -> list:
        texts = [main_text(lines(h or ""), n) for h, n in zip(part.column("html").to_pylist(), part.column("nearest").to_pylist())]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return with_columns(joined, "html", "text string, n_chars long", make, ["key", "url", "nearest"]).select(
        F.col("key").alias(key), "url", "text", "n_chars")
