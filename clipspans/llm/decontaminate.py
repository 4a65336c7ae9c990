"""Benchmark decontamination with DataFrame functions only.

A window is 10 consecutive words of a benchmark item; an item of fewer words is one window. The windows form a hash set
that is broadcast once its counted size is below ``max_broadcast_rows``, and is otherwise joined by shuffle.

The scan looks at every word of every text, but hashes only aligned blocks: an occurrence of a window of L words always
covers a whole block of (L + 1) // 2 words that starts at a multiple of that number. So each text gives one hash per
block (a fifth of its windows). Rows are known by their locators (Parquet file and row number); only those with blocks that some
benchmark window has are read again, and around these blocks the full windows are cut out and compared word for word with the set.

Defined results: null and wordless texts have no words and no hits; rows are told apart by themselves, not by id, so
repeated ids and null ids keep a row each; equal windows of several items count for each item; null and wordless items
have no windows; an empty benchmark leaves all documents clean. Other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipspans.llm.common import ascii_lower, column, located, locator, small, stored, table, within, without

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
MAX_BROADCAST_ROWS = 2_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SPLIT), "")


def windows(benchmark: DataFrame, text: str = "text", item: str = "item_id", size: int = WINDOW) -> DataFrame:
    """Distinct (gram, len, items): each window's words space-joined, its length, and the sorted ids that have it."""
    w = benchmark.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("w")).where("size(w) > 0")
    w = w.withColumn("len", F.least(F.size("w"), F.lit(size)))
    w = w.select("item", "len", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1), lambda i: F.slice("w", i, F.col("len")))).alias("g"))
    return w.groupBy(F.array_join("g", " ").alias("gram"), "len").agg(F.first("g").alias("g"), F.sort_array(F.collect_set("item")).alias("items"))


def _block(length: int) -> int:
    return (length + 1) // 2


def _blocks(w: Column, length: int) -> Column:
    """The whole aligned blocks of ``w``: struct(length, first word from 1, hash)."""
    b = _block(length)
    return F.transform(F.sequence(F.lit(1), F.size(w) - (b - 1), F.lit(b)), lambda i: F.struct(F.lit(length).alias("len"), i.alias("at"), F.xxhash64(F.slice(w, i, b)).alias("h")))


def found(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per row of located ``docs`` that has a window: file, row (its locator), n_hit, items (sorted ids), spans.

    spans holds struct<start,end>, words counted from 1, end exclusive, one for each occurrence of a window. No text is shuffled;
    of rows with near blocks the words are, where these rows are too many to broadcast what their blocks are."""
    grams = stored(windows(benchmark, size=size))
    lengths = sorted(r["len"] for r in grams.select("len").distinct().collect())  # at most ``size`` numbers
    near = F.broadcast if grams.count() * size <= max_broadcast_rows else (lambda df: df)

    # block hashes of the set: every run of b words of every window
    runs = grams.select("len", F.expr("(len + 1) div 2").cast("int").alias("b"), "g")
    runs = runs.select("len", F.explode(F.transform(F.sequence(F.lit(1), F.size("g") - F.col("b") + 1), lambda i: F.xxhash64(F.slice("g", i, F.col("b"))))).alias("h"))
    runs = runs.select(F.col("len").alias("r_len"), F.col("h").alias("r_h")).distinct()

    rows = docs.select(*locator(docs), words(column(text)).alias("w"))
    block = "struct<len: int, at: int, h: bigint>"
    blocks = [F.expr(f"cast(array() as array<{block}>)")]
    for n in lengths:
        blocks.append(F.when(F.size("w") >= n, _blocks(F.col("w"), n).cast(f"array<{block}>")).otherwise(blocks[0]))
    # explode_outer: explode would add a filter that computes the blocks a second time
    scan = rows.select("file", "row", F.explode_outer(F.concat(*blocks)).alias("k")).select("file", "row", "k.len", "k.at", "k.h")
    met = scan.join(near(runs), (F.col("h") == F.col("r_h")) & (F.col("len") == F.col("r_len")))
    met = stored(met.groupBy("file", "row").agg(F.collect_list(F.struct("len", "at")).alias("near")))

    # the words of all windows that can cover a block, from word ``lo``
    again = within(docs.select(column(text).alias("text")), met.select("file", "row")).select("file", "row", words(F.col("text")).alias("w"))
    around = again.join(small(met), ["file", "row"]).select("file", "row", "w", F.explode("near").alias("x")).select("file", "row", "w", "x.len", "x.at")
    lo = F.greatest(F.lit(1), F.col("at") - F.col("len") + F.expr("(len + 1) div 2").cast("int"))
    hi = F.least(F.size("w"), F.col("at") + F.col("len") - 1)
    around = around.select("file", "row", F.struct("len", lo.alias("lo"), F.slice("w", lo, hi - lo + 1).alias("w")).alias("x"))
    cut = lambda x: F.transform(F.sequence(F.lit(1), F.size(x["w"]) - x["len"] + 1), lambda i: F.struct((x["lo"] + i - 1).cast("bigint").alias("start"), x["len"].alias("len"), F.array_join(F.slice(x["w"], i, x["len"]), " ").alias("gram")))
    full = around.where("size(x.w) >= x.len").select("file", "row", F.explode(cut(F.col("x"))).alias("x")).select("file", "row", "x.start", "x.len", "x.gram")
    full = full.join(near(grams.select("gram", "items")), "gram").select("file", "row", F.struct("start", (F.col("start") + F.col("len")).alias("end")).alias("span"), "items")
    full = full.groupBy("file", "row").agg(F.sort_array(F.collect_set("span")).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return stored(full.withColumn("n_hit", F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["end"] - 1))))).cast("bigint")))


def _none(found: DataFrame) -> list[Column]:
    """n_hit, items and spans, of rows with and without them."""
    empty = lambda c, kind: F.coalesce(F.col(c), F.expr(f"cast(array() as {kind})")).alias(c)
    return [F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), empty("items", "array<string>"), empty("spans", "array<struct<start: bigint, end: bigint>>")]


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """One row per row of ``docs``: row (a struct of its columns), n_words, n_hit, items (sorted ids), spans (as in ``found``). Only rows
    with hits are joined with them."""
    docs = located(docs)
    full = found(docs, benchmark, text, size, max_broadcast_rows)
    whole = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("whole"))
    n_words = F.size(words(F.col("whole")[text])).cast("bigint").alias("n_words")
    none = full.limit(0).select("n_hit", "items", "spans").schema
    clean = without(whole, full.select("file", "row")).select("whole", n_words, *[F.lit(None).cast(f.dataType).alias(f.name) for f in none])
    dirty = within(whole, full.select("file", "row")).join(small(full, full.count()), ["file", "row"]).select("whole", n_words, *none.names)
    return clean.unionByName(dirty).select(F.col("whole").alias("row"), "n_words", *_none(full))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns."""
    docs = located(docs)
    return without(docs, found(docs, benchmark, text, size))


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW) -> DataFrame:
    """All rows of ``docs``; a text with hits becomes its words outside every span, lower-cased and space-joined."""
    with_hits = hits(docs, benchmark, text, size)
    w = words(F.col("row")[text])
    hit = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["end"] - 1)))
    rest = F.array_join(F.array_compact(F.transform(F.sequence(F.lit(1), F.size(w)), lambda i: F.when(~F.array_contains(hit, i.cast("bigint")), F.element_at(w, i)))), " ")
    return with_hits.withColumn("row", F.when(F.col("n_hit") > 0, F.col("row").withField("`" + text.replace("`", "``") + "`", rest)).otherwise(F.col("row"))).select("row.*")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    full = found(docs, table(spark, sf_dir, "benchmark"))
    own = docs.select("doc_id", F.size(words(F.col("text"))).cast("bigint").alias("n_words"), *locator(docs))  # narrow rows
    with_hits = own.join(small(full, full.count()), ["file", "row"], "left").select("doc_id", "n_words", *_none(full))
    return with_hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
with b as (select item_id, w, least(len(w), {WINDOW}) as l from (select item_id, {_WORDS} as w from benchmark) where len(w) > 0),
grams as (select distinct item_id, l, array_to_string(w[i:i + l - 1], ' ') as gram from (select *, unnest(range(1, len(w) - l + 2)) as i from b)),
d as (select doc_id, {_WORDS} as w from documents),
p as (select doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') as gram from (select doc_id, w, l, unnest(range(1, len(w) - l + 2)) as i from d, (select distinct l from grams))),
hit as (select doc_id, item_id, i, l from p join grams using (l, gram)),
pos as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(i, i + l)) as x from hit) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct doc_id, cast(item_id as varchar) as id from hit) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (doc_id) left join items using (doc_id)
"""
