"""Derivatives of web archive responses.

Each response record gives a metadata record (what the page links to, its
title and meta tags, the source's headers and digests, as JSON) and a
conversion record (its text).  Both name the response that they refer to.
Records are rows; they are written as WARC files and read back as rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import html as entities
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.columns import require
from bidscope.llm.markup import attributes, events, lines
from bidscope.llm.words import slices

#: Attributes that hold a link, by element.
LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "source": "src", "form": "action"}
RECORD = ("record_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
          "content_length long, block_digest string, source_headers string, source_digest string, block string")


def _urn(*parts: Column) -> Column:
    """A record id that the same content always gets."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts]))
    at = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", at(1, 8), at(9, 4), at(13, 4), at(17, 4), at(21, 12)))


def responses(pages: DataFrame, date: str, key: str = "page_id") -> DataFrame:
    """Response rows of fetched pages (``url``, ``html``): ``record_id``,
    ``target_uri``, ``warc_date``, ``http_headers``, ``payload`` and the key.
    A null page is a response without payload."""
    require(pages, key, "url", "html")
    payload = F.coalesce("html", F.lit(""))
    headers = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                       F.octet_length(payload).cast("string"), F.lit("\r\n"))
    return pages.select(F.col(key), _urn(F.lit("response"), F.col(key), F.col("url"), F.md5(payload)).alias("record_id"),
                        F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"), headers.alias("http_headers"), payload.alias("payload"))


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def describe(payload: str, target: str | None) -> dict:
    """Title, meta tags and links of a page; links are made absolute."""
    title, metas, links = "", [], []
    for kind, name, content in events(payload):
        if kind == "raw" and name == "title" and not title:
            title = " ".join(entities.unescape(content).split())
        elif kind == "open" and (name == "meta" or name in LINKS and content):
            a = attributes(content)
            if name == "meta":
                metas.append(a)
            elif a.get(LINKS[name]):
                try:
                    url = urljoin(target or "", a[LINKS[name]])
                except ValueError:            # not a URL: kept as it stands
                    url = a[LINKS[name]]
                links.append({"path": f"{name.upper()}@/{LINKS[name]}", "url": url})
    return {"title": title, "metas": metas, "links": links}


def plain_text(payload: str) -> str:
    """All visible text, a line for each block or line break."""
    return "\n".join(line for line, _ in lines(payload, break_ends_line=True))


def _headers(text: str) -> dict[str, str]:
    return {k.strip(): v.strip() for k, sep, v in (x.partition(":") for x in text.split("\r\n")[1:]) if sep}


def _derived(record: dict) -> Iterator[tuple]:
    payload = record["payload"] or ""
    source, headers = digest(payload.encode()), record["http_headers"] or ""
    described = {
        "source": {"WARC-Record-ID": f"<{record['record_id']}>", "WARC-Target-URI": record["target_uri"], "WARC-Date": record["warc_date"],
                   "WARC-Payload-Digest": source, "Content-Length": len(headers.encode()) + 2 + len(payload.encode())},
        "http-headers": _headers(headers), "html": describe(payload, record["target_uri"])}
    for kind, content_type, block in (("metadata", "application/json", json.dumps(described, ensure_ascii=False, sort_keys=True)),
                                      ("conversion", "text/plain; charset=utf-8", plain_text(payload))):
        raw = block.encode()
        own = uuid.UUID(hashlib.md5(f"{kind}|{record['record_id']}".encode()).hexdigest())
        yield (kind, f"urn:uuid:{own}", record["record_id"], record["target_uri"], record["warc_date"], content_type, len(raw),
               digest(raw), headers, source, block)


def derive(source: DataFrame, key: str = "page_id") -> DataFrame:
    """Two rows of ``RECORD`` for each response row, with its key.  One pass,
    no shuffle.  An empty payload gives an empty conversion; repeated
    responses give repeated records, with one id; other columns are not
    read."""
    require(source, key, "record_id", "target_uri", "warc_date", "http_headers", "payload")
    kind = source.schema[key].dataType.simpleString()
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "payload"):
                rows = [list(_derived(r)) for r in part.drop_columns([key]).to_pylist()]
                twice = pa.array([i for i, r in enumerate(rows) for _ in r], pa.int64())
                columns = list(zip(*[x for r in rows for x in r]))
                made = [pa.array(c, pa.int64() if n == "content_length" else pa.string()) for n, c in zip(names, columns)]
                yield pa.RecordBatch.from_arrays([part.column(key).take(twice), *made], [key, *names])

    return source.select(key, "record_id", "target_uri", "warc_date", "http_headers", "payload").mapInArrow(run, f"`{key}` {kind}, {RECORD}")


def render(records: DataFrame) -> DataFrame:
    """``warc``: each derived record as it stands in a file, but for the two
    line ends that follow it."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")
    angle = lambda c: F.concat(F.lit("<"), F.col(c), F.lit(">"))
    return records.select(F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", angle("record_id")),
        line("WARC-Refers-To", angle("refers_to")), line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("warc_date")),
        line("WARC-Block-Digest", F.col("block_digest")), line("X-Source-Payload-Digest", F.col("source_digest")),
        line("Content-Type", F.col("content_type")), line("Content-Length", F.col("content_length")), F.lit("\r\n"), F.col("block")).alias("warc"))


def write_warc(records: DataFrame, path: str, per_file: int = 100_000) -> None:
    """Gzipped WARC files of ``per_file`` records at most."""
    (render(records).write.mode("overwrite").option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers, block) of the records of WARC files, gzipped or not.  A file
    is read by one task, record by record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                data = raw.as_buffer()
                f = io.BytesIO(data)
                if data[:2].to_pybytes() == b"\x1f\x8b":
                    f = gzip.open(f)
                while (first := f.readline()):
                    if not first.strip():
                        continue
                    headers = {}
                    while (text := f.readline().decode().rstrip("\r\n")):
                        name, _, value = text.partition(":")
                        headers[name] = value.strip()
                    block = f.read(int(headers["Content-Length"]))
                    yield pa.RecordBatch.from_arrays([pa.array([list(headers.items())], pa.map_(pa.string(), pa.string())), pa.array([block], pa.binary())],
                                                     ["headers", "block"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "headers map<string,string>, block binary")
