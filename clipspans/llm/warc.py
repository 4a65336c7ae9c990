"""WARC records and a Merkle fixity audit of replicas.

Every record is hashed where it is read. The hashes of the records that begin in one range of ``RANGE`` bytes are hashed
into a node, ``FAN`` neighbouring ranges into the next, up to one root per file; files are joined the same way by file
number up to one root for the replica. Two replicas' trees are compared from the root down, and only the children of
nodes that differ are looked at, until the differing records are located. Every node is a grouped aggregate over at most
``FAN`` children (a range of records over what fits in RANGE bytes), so no group grows with the data.

Defined results: a record that only the first replica has is missing, one that only the second has is extra, one whose hash
differs is corrupt; null url or html counts as empty; pages with a null id go to files of their own, dealt by content;
pages that are equal in all of id, url and html differ only by offset; an empty replica has no root. Extra page
columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from clipspans.llm.common import stored, table

PER_FILE = 256
NULL_FILES = 4096
RANGE_BITS, FAN_BITS = 16, 4
RANGE, FAN = 1 << RANGE_BITS, 1 << FAN_BITS


def record(url: Column, html: Column) -> Column:
    """A WARC/1.0 response record without its closing blank lines."""
    url, html = F.coalesce(url, F.lit("")), F.coalesce(html, F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html), F.lit("\r\n\r\n"), html)
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "))
    return F.concat(head, F.octet_length(http), F.lit("\r\n\r\n"), http)


TAIL = "\r\n\r\n"


def layout(pages: DataFrame, *more: Column) -> DataFrame:
    """Pages as records of numbered files, in id order: file, offset, length, page_id, digest and ``more``."""
    full = F.concat(record(F.col("url"), F.col("html")), F.lit(TAIL))
    file = F.when(F.col("page_id").isNull(), -1 - F.pmod(F.xxhash64("url", "html"), F.lit(NULL_FILES))).otherwise(F.floor(F.col("page_id") / PER_FILE)).cast("bigint")
    rows = pages.select(file.alias("file"), F.col("page_id").cast("bigint").alias("page_id"), F.octet_length(full).cast("bigint").alias("length"), F.sha2(full, 256).alias("digest"), *more)
    before = F.sum("length").over(Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("offset", F.coalesce(before, F.lit(0).cast("bigint")))


def plan(*replicas: DataFrame) -> list[tuple[str, int]]:
    """The steps from records to one root that hold all replicas' leaves: (what is joined, bits shifted out)."""
    ends = [r.agg(F.max("offset"), F.min("file"), F.max("file")).first() for r in replicas]
    ends = [e for e in ends if e[0] is not None]
    if not ends:
        return []
    steps, last = [("range", RANGE_BITS)], max(e[0] for e in ends) >> RANGE_BITS
    while last:
        steps.append(("range", FAN_BITS))
        last >>= FAN_BITS
    low, high = min(e[1] for e in ends), max(e[2] for e in ends)
    while high - low > 1 or low != high and (low, high) != (-1, 0):  # an arithmetic shift ends at -1 or 0
        steps.append(("file", FAN_BITS))
        low, high = low >> FAN_BITS, high >> FAN_BITS
    return steps + [("root", 0)]


def _above(step: tuple[str, int]) -> tuple[Column, Column]:
    """File and position of a node's parent."""
    kind, bits = step
    zero = F.lit(0).cast("bigint")
    if kind == "range":
        return F.col("file"), F.shiftright("at", bits)
    return (F.shiftright("file", bits), F.col("at")) if kind == "file" else (zero, zero)


def tree(leaves: DataFrame, steps: list[tuple[str, int]]) -> list[DataFrame]:
    """The levels from the records up, each (file, at, hash), written to the shared folder."""
    levels = [stored(leaves.select("file", F.col("offset").alias("at"), F.concat_ws(":", F.col("length").cast("string"), "digest").alias("hash")))]
    for step in steps:
        file, at = _above(step)
        kids = F.sort_array(F.collect_list(F.struct("file", "at", "hash")))
        joined = F.array_join(F.transform(kids, lambda k: F.concat_ws(":", k["file"].cast("string"), k["at"].cast("string"), k["hash"])), ",")
        nodes = levels[-1].groupBy(file.alias("up"), at.alias("up_at")).agg(F.sha2(joined, 256).alias("hash"))
        levels.append(stored(nodes.select(F.col("up").alias("file"), F.col("up_at").alias("at"), "hash")))
    return levels


def _differ(one: DataFrame, two: DataFrame) -> DataFrame:
    two = two.select("file", "at", F.col("hash").alias("other"))
    status = F.when(F.col("other").isNull(), "missing").when(F.col("hash").isNull(), "extra").otherwise("corrupt")
    return one.join(two, ["file", "at"], "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "at", status.alias("status"))


def audit(one: DataFrame, two: DataFrame) -> DataFrame:
    """Records that differ between two replicas' leaves: file, offset, status (missing, extra or corrupt)."""
    steps = plan(one, two)
    a, b = tree(one, steps), tree(two, steps)
    found = stored(_differ(a[-1], b[-1]))
    for level in range(len(steps) - 1, -1, -1):
        file, at = _above(steps[level])
        open_ = found.select(F.col("file").alias("up"), F.col("at").alias("up_at"))
        below = [x[level].join(open_, (file == F.col("up")) & (at == F.col("up_at")), "left_semi") for x in (a, b)]
        found = stored(_differ(*below))
    return found.withColumnRenamed("at", "offset")


FLUSH = 8 << 20


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, length, digest, header, body) of the records of WARC files, plain or compressed (.gz), one row each.

    Offsets count uncompressed bytes. A file is one task's work, as its records have no index (WARC files are cut to about 1 GB by
    custom); the task reads it as a stream and holds about ``FLUSH`` bytes of records."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["file", "offset", "length", "digest", "header", "body"]
        for batch in batches:
            for name in batch["path"]:
                rows, size = [], 0
                for row in _records(name):
                    rows.append((name, *row))
                    size += row[1]
                    if size >= FLUSH:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInPandas(split, "file string, offset bigint, length bigint, digest string, header string, body binary")


def _records(name: str) -> Iterator[tuple[int, int, str, str, bytes]]:
    """(offset, length, digest, header, body) of each record of a file."""
    store, place = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", name))
    with store.open_input_stream(place, compression="detect") as raw, io.BufferedReader(raw, 1 << 20) as stream:
        at = 0
        while first := stream.readline():
            lines = [first]
            while lines[-1] not in (b"\r\n", b""):
                lines.append(stream.readline())
            head = b"".join(lines)
            found = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head.replace(b"\r\n", b"\n")) if first.startswith(b"WARC/") and lines[-1] else None
            if found is None:
                raise ValueError(f"{name}: no WARC record at byte {at}")
            body, tail = stream.read(int(found[1])), stream.read(4)
            if tail != TAIL.encode():
                raise ValueError(f"{name}: the record at byte {at} has no end")
            length = len(head) + len(body) + 4
            yield at, length, hashlib.sha256(head + body + tail).hexdigest(), head[:-4].decode("utf-8", "replace"), body
            at += length


#: In the second replica of the query, records with these remainders of page_id by DAMAGE are changed or lost.
DAMAGE, CHANGED, LOST = 89, 7, 11


def op3_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixity report of all records of ``pages`` against a replica in which bytes are changed and records lost."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    full = record(F.col("url"), F.col("html"))
    changed = F.sha2(F.concat(full, F.when(F.pmod("page_id", F.lit(DAMAGE)) == CHANGED, "\r\n\r!").otherwise(TAIL)), 256)
    rows = stored(layout(pages, changed.alias("changed")))
    replica = rows.where(~F.coalesce(F.pmod("page_id", F.lit(DAMAGE)) == LOST, F.lit(False))).withColumn("digest", F.col("changed"))
    found = audit(rows, replica)
    return rows.select("page_id", "file", "offset", "length", "digest").join(found, ["file", "offset"], "left").select("page_id", "file", "offset", "length", "digest", F.coalesce("status", F.lit("ok")).alias("status"))


SQL = f"""
with h as (select page_id, concat('HTTP/1.1 200 OK', chr(13), chr(10), 'Content-Type: text/html; charset=utf-8', chr(13), chr(10), 'Content-Length: ', strlen(coalesce(html, '')), chr(13), chr(10), chr(13), chr(10), coalesce(html, '')) as http, coalesce(url, '') as url from pages),
r as (select page_id, page_id // {PER_FILE} as file, concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Type: application/http; msgtype=response', chr(13), chr(10), 'Content-Length: ', strlen(http), chr(13), chr(10), chr(13), chr(10), http, chr(13), chr(10), chr(13), chr(10)) as rec from h)
select page_id, file, cast(coalesce(sum(strlen(rec)) over (partition by file order by page_id rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset", strlen(rec) as length, sha256(rec) as digest,
  case page_id % {DAMAGE} when {CHANGED} then 'corrupt' when {LOST} then 'missing' else 'ok' end as status
from r
"""
