"""What the operators of this folder share: shared storage, ASCII lower-casing and row names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table that lower-cases A-Z and leaves every other byte alone
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def shared_dir(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir, which driver and executors share. On one machine without that setting it is made there."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: cuts the lineage, outlives lost executors. Options as the
    writer's, such as compression."""
    path = shared_dir(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. An all-ASCII text takes the cheaper built-in ``lower``, which is the same there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, most: int = 256) -> Iterator[None]:
    """For actions inside: Arrow batches of ``most`` rows, as a row can be a long text and a worker holds whole batches. What is
    computed later, outside, takes the session's own setting."""
    before = spark.conf.get(BATCH)
    if int(before) > most or int(before) <= 0:
        spark.conf.set(BATCH, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def held_out(doc_id: Column) -> Column:
    """True for rows that no model may learn from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def located(docs: DataFrame) -> DataFrame:
    """``docs`` as read from Parquet files, whose rows have locators; other inputs are written to the shared folder first."""
    try:
        docs.select(*locator(docs))
        return docs
    except AnalysisException:
        return stored(docs)


def locator(docs: DataFrame, file: str = "file", row: str = "row") -> list[Column]:
    """File and row number of each row of located ``docs``, also where ``docs`` has a column ``_metadata`` of its own."""
    place = docs.metadataColumn("_metadata")
    return [place["file_path"].alias(file), place["row_index"].alias(row)]


#: Narrow rows that are broadcast at most (about 100 bytes each); their number is counted first.
MAX_NARROW = 200_000
#: Rows of a file that one bitmap tells (4 KB), and bitmaps that one scan of the documents gets (64 MB).
BITMAP_ROWS, MAX_BITMAPS = 1 << 15, 1 << 14


def small(df: DataFrame, n: int | None = None) -> DataFrame:
    """``df``, of narrow rows, marked for broadcast if it is counted (``n`` rows, or by reading a stored table) at ``MAX_NARROW`` rows or fewer."""
    return F.broadcast(df) if (df.count() if n is None else n) <= MAX_NARROW else df


def _chosen(docs: DataFrame, rows: DataFrame, inside: bool, locate: bool, max_bitmaps: int) -> DataFrame:
    """The rows of located ``docs`` that are, or aren't, in ``rows`` (file, row): no text is shuffled, however many there are.

    The chosen rows are one bit each, in bitmaps of ``BITMAP_ROWS`` rows of a file. They are broadcast to the scan of the documents;
    when they are too many for one, files are dealt into groups, and each group's files are scanned with their own bitmaps."""
    file, row, block, bits = (free_name(docs, n) for n in ("file", "row", "block", "bits"))
    place = F.col("row") % BITMAP_ROWS
    maps = rows.groupBy(F.col("file").alias(file), F.floor(F.col("row") / BITMAP_ROWS).cast("bigint").alias(block)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias(bits))
    maps = stored(maps)
    groups = max(1, -(-maps.count() // max_bitmaps))
    group = lambda path: F.pmod(F.xxhash64(path), F.lit(groups))

    def scan(part: int) -> DataFrame:
        own, some = docs, maps
        if groups > 1:  # a filter by path: other files aren't opened
            own, some = docs.where(group(locator(docs)[0]) == part), maps.where(group(F.col(file)) == part)
        here = own.select(*[column(c) for c in docs.columns], *locator(docs, file, row)).withColumn(block, F.floor(F.col(row) / BITMAP_ROWS).cast("bigint"))
        byte = F.conv(F.hex(F.expr(f"substring({bits}, cast({row} % {BITMAP_ROWS} div 8 as int) + 1, 1)")), 16, 10).cast("int")
        there = F.coalesce(F.expr(f"shiftright({byte_name}, cast({row} % 8 as int))").bitwiseAND(F.lit(1)) == 1, F.lit(False))
        found = here.join(F.broadcast(some), [file, block], "inner" if inside else "left").withColumn(byte_name, byte)
        return found.where(there if inside else ~there)

    byte_name = free_name(docs, "byte")
    kept = [column(c) for c in docs.columns] + ([F.col(file), F.col(row)] if locate else [])
    return reduce(DataFrame.unionByName, [scan(k).select(*kept) for k in range(groups)])


def without(docs: DataFrame, dropped: DataFrame, max_bitmaps: int = MAX_BITMAPS) -> DataFrame:
    """The rows of located ``docs`` whose (file, row) isn't in ``dropped``, with all their columns."""
    return _chosen(docs, dropped, False, False, max_bitmaps)


def within(docs: DataFrame, chosen: DataFrame, max_bitmaps: int = MAX_BITMAPS) -> DataFrame:
    """The rows of located ``docs`` whose (file, row) is in ``chosen``, with all their columns, which have no names like these two, and these."""
    return _chosen(docs, chosen, True, True, max_bitmaps)
