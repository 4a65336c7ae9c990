"""Collocations of two and three words by dynamic itemset counting.

The documents lie in ``SHARDS`` shards, scanned in a cycle: pass p reads shard p mod ``SHARDS`` and counts phrases of all lengths at
once. Words are counted from the first pass on. A longer phrase is activated at the first stop between two passes at which
both its subphrases (all words but the last, and but the first) have the threshold; it is counted in the passes from there on until it has been
through each shard once. A phrase that has the threshold has subphrases that do, so none is missed.

Most phrases of frequent parts are rare, so a count goes without its name first: phrases are counted by a hash of language and words
(``KEY_BITS`` bits in a bucket), in sorted arrays of five bytes a phrase, one row a bucket and task. What has the threshold at a
stop is then counted by name, over a whole cycle from that stop on. Phrases of one hash share the earlier stop, but none is counted by name
before its own parts are active, so that each goes through one whole cycle and the counts are exact whatever collides.

At which stop a hash had the threshold is kept for its first 24 bits, in one byte (``SLOTS``) for each length. These three arrays have
a fixed size and are rebuilt in the tasks from the stops' new slots, which come to the driver as bitmaps, at most ``SLOTS`` bits, and
are broadcast once each. Nothing else is collected or broadcast.

Defined results: null texts have no words, a null language is ``und``. Phrases don't cross documents or pieces; a word is any run of
other characters than blank, tab and those that part pieces. Repeated rows count each time; ids and other columns, whatever their names, aren't
read. Texts of any length are counted whole, one text at a time at least. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipspans.llm.common import ascii_lower, column, located, locator, shared_dir, small_batches, stored, table

SHARDS, SLOT_BITS, KEY_BITS = 3, 24, 32
SLOTS = 1 << SLOT_BITS
LEAST, TOP = 10, 2000
#: A candidate goes if a longer one that has it has at least so many hundredths of its occurrences.
INSIDE = 50
#: Bytes of text that are counted at a time, and unnamed counts that a task holds.
TOGETHER, HELD = 8 << 20, 4_000_000
#: No stop; the most that an unnamed count tells.
NEVER = MOST = 255
LENGTHS = (1, 2, 3)
#: Shards and counts are read more than once, and take room meanwhile.
CODEC = {"compression": "zstd"}
#: Phrases by name: n words, language, phrase, c occurrences; n = 0 counts all words of a language. Unnamed counts: of n words, activated at a stop, a bucket's keys and counts.
FOUND = "n int, lang string, phrase string, c bigint, stop int, bucket int, keys binary, counts binary"
_ARROW = pa.schema([("n", pa.int32()), ("lang", pa.string()), ("phrase", pa.string()), ("c", pa.int64()), ("stop", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_PARTS = r"[.,;:!?\n-\r]+"
_CUT = "\n"


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of lower-cased texts and cuts between pieces, as numbers, the text of each, and all distinct words by number."""
    marked = pc.replace_substring(pc.replace_substring_regex(texts, _PARTS, f" {_CUT} "), "\t", " ")
    lists = pc.split_pattern(marked, " ")
    own = np.repeat(np.arange(len(texts), dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
    found = lists.flatten().dictionary_encode()
    code = found.indices.to_numpy()
    empty = pc.index(found.dictionary, "").as_py()
    if empty >= 0:
        keep = code != empty
        code, own = code[keep], own[keep]
    return code, own, found.dictionary


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two words from theirs."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and their counts up to ``MOST``."""
    if not len(hashes):
        return hashes, counts.astype(np.uint8)
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    return hashes[first], np.minimum(np.add.reduceat(counts.astype(np.int64), first), MOST).astype(np.uint8)


def count_block(texts: pa.Array, langs: list[str], act: list[np.ndarray], at: int, shards: int) -> tuple[list[tuple], dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]]:
    """What pass ``at`` counts: by name as (n, languages, phrases, counts), and without, by length and stop of activation, as (hashes, counts).
    act: for each length, the stop at which each slot had the threshold."""
    code, own, words = tokens(texts)
    names = sorted(set(langs))
    lang = np.array([names.index(x) for x in langs], np.int64)[own]
    word = code != pc.index(words, _CUT).as_py()
    # a word of a language is one number, u; -1 for cuts
    found, inverse, n = np.unique((lang * len(words) + code)[word], return_inverse=True, return_counts=True)
    if not len(found):
        return [], {}
    u = np.full(len(code), -1, np.int64)
    u[word] = inverse
    which, spoken = found % len(words), found // len(words)
    shown, languages = words.take(pa.array(which)), pa.array(names)
    seeds = np.array([xxhash.xxh64_intdigest(x) for x in names], np.uint64)[spoken].tolist()
    hashes = word_hashes = np.array([xxhash.xxh64_intdigest(w, s) for w, s in zip(shown.to_pylist(), seeds)], np.uint64)
    goes = lambda stop: (stop <= at) & (at < stop + shards)
    join = lambda *parts: pc.binary_join_element_wise(*[shown.take(pa.array(p)) for p in parts], " ")
    named, unnamed = [], {}

    def hold(length: int, stop: np.ndarray) -> None:
        for one in np.unique(stop[goes(stop)]).tolist():
            i = np.flatnonzero(stop == one)
            unnamed[length, one] = hashes[i], n[i]

    if at < shards:
        unnamed[1, 0] = hashes, n
        total = np.bincount(spoken, n, len(names)).astype(np.int64)
        named.append((0, languages, pa.array([""] * len(names)), total))
    since = act[0][slot(hashes)].astype(np.int16)
    i = np.flatnonzero(goes(since) & (since < NEVER))
    named.append((1, languages.take(pa.array(spoken[i])), shown.take(pa.array(i)), n[i]))

    own_stop = np.where(u >= 0, since[u], NEVER)
    pair = (own[:-1] == own[1:]) & (own_stop[:-1] < NEVER) & (own_stop[1:] < NEVER)
    j = np.flatnonzero(pair)
    if not len(j):
        return named, unnamed
    pairs, inverse, n = np.unique(u[j] * len(found) + u[j + 1], return_inverse=True, return_counts=True)
    a, b = pairs // len(found), pairs % len(found)
    hashes = pair_hash(hashes[a], hashes[b])
    active = np.maximum(since[a], since[b])
    hold(2, active)
    # a slot can be another phrase's, and older than this one's parts; it is counted from when both are there
    pair_since = np.maximum(act[1][slot(hashes)].astype(np.int16), active)
    i = np.flatnonzero(goes(pair_since) & (pair_since < NEVER))
    named.append((2, languages.take(pa.array(spoken[a[i]])), join(a[i], b[i]), n[i]))

    # triples of two active pairs, which stand side by side in j
    k = np.flatnonzero(j[1:] == j[:-1] + 1)
    k = k[(pair_since[inverse[k]] < NEVER) & (pair_since[inverse[k + 1]] < NEVER)]
    if len(k):
        triples, first, n = np.unique(inverse[k] * len(found) + u[j[k] + 2], return_index=True, return_counts=True)
        p, q, c = triples // len(found), inverse[k[first] + 1], triples % len(found)
        hashes = pair_hash(hashes[p], word_hashes[c])
        active = np.maximum(pair_since[p], pair_since[q])
        hold(3, active)
        since = np.maximum(act[2][slot(hashes)].astype(np.int16), active)
        i = np.flatnonzero(goes(since) & (since < NEVER))
        named.append((3, languages.take(pa.array(spoken[c[i]])), join(a[p[i]], b[p[i]], c[i]), n[i]))
    return named, unnamed


def dense(news: list[tuple[int, list[np.ndarray]]]) -> list[np.ndarray]:
    """For each length and slot the first stop at which it was new; news: (stop, new slots of each length)."""
    act = [np.full(SLOTS, NEVER, np.uint8) for _ in LENGTHS]
    for stop, found in sorted(news, key=lambda x: -x[0]):
        for kind, own in zip(act, found):
            kind[own] = stop
    return act


def _scan(shard: DataFrame, news: list, at: int, shards: int, buckets: int) -> DataFrame:
    """Rows of ``FOUND`` of one pass. news: broadcasts of each stop's new slots, each sent once."""
    shift = np.uint64(64 - (buckets.bit_length() - 1) - KEY_BITS)

    def rows(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _ARROW], schema=_ARROW)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        act = dense([n.value for n in news])
        waiting, size = [], 0
        held: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}

        def block() -> Iterator[pa.RecordBatch]:
            texts = pa.chunked_array([b.column("text") for b in waiting]).combine_chunks()
            named, unnamed = count_block(texts, pa.chunked_array([b.column("lang") for b in waiting]).to_pylist(), act, at, shards)
            for n, lang, phrase, c in named:
                if len(c):
                    yield rows(n=np.full(len(c), n, np.int32), lang=lang, phrase=phrase, c=c)
            for key, (hashes, n) in unnamed.items():
                kind = held.setdefault(key, [])
                kind.append((hashes >> shift, n))
                if sum(len(h) for h, _ in kind) > HELD:
                    kind[:] = [summed(np.concatenate([h for h, _ in kind]), np.concatenate([c for _, c in kind]))]
            if sum(len(h) for kind in held.values() for h, _ in kind) > HELD:
                yield from give()
            pa.default_memory_pool().release_unused()

        def give() -> Iterator[pa.RecordBatch]:
            for (n, stop), kind in held.items():
                hashes, counts = summed(np.concatenate([h for h, _ in kind]), np.concatenate([c for _, c in kind]))
                cuts = np.searchsorted(hashes, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(KEY_BITS))
                keys = (hashes & np.uint64((1 << KEY_BITS) - 1)).astype("<u4")
                full = np.flatnonzero(np.diff(cuts))
                for some in np.array_split(full, max(1, len(full) // 1000)):
                    if len(some):
                        part = [(cuts[k], cuts[k + 1]) for k in some]
                        same = lambda v: np.full(len(some), v, np.int32)  # noqa: B023, E731
                        yield rows(n=same(n), stop=same(stop), bucket=some.astype(np.int32), keys=[keys[x:y].tobytes() for x, y in part], counts=[counts[x:y].tobytes() for x, y in part])
            held.clear()

        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if size >= TOGETHER:
                yield from block()
                waiting, size = [], 0
        if waiting:
            yield from block()
        yield from give()

    return shard.mapInArrow(count, FOUND)


def _reached(unnamed: DataFrame, least: int, buckets: int) -> list[tuple[int, int, bytes]]:
    """Slots of hashes with the threshold, as (n, bucket, bits of the bucket's slots). A bucket is one sorted run of rows of arrays."""
    slots = SLOTS // buckets
    schema = pa.schema([("n", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            keys, counts = summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            bits = np.zeros(slots, bool)
            bits[keys[counts >= min(least, MOST)] >> np.uint32(KEY_BITS - slots.bit_length() + 1)] = True
            if bits.any():
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((now[0], now[2], np.packbits(bits, bitorder="little").tobytes()), schema)], schema=schema)

        for batch in batches:
            for n, stop, bucket, keys, counts in zip(*[batch.column(c).to_pylist() for c in ("n", "stop", "bucket", "keys", "counts")]):
                if (n, stop, bucket) != now:
                    if held:
                        yield from out()
                    now, held = (n, stop, bucket), []
                held.append((np.frombuffer(keys, "<u4"), np.frombuffer(counts, np.uint8)))
                if sum(len(k) for k, _ in held) > HELD:
                    held = [summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))]
        if held:
            yield from out()

    ordered = unnamed.repartition("n", "stop", "bucket").sortWithinPartitions("n", "stop", "bucket")
    return [(r["n"], r["bucket"], bytes(r["bits"])) for r in ordered.mapInArrow(sums, "n int, bucket int, bits binary").collect()]


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, shards: int = SHARDS) -> DataFrame:
    """(n, lang, phrase, c): the words and the phrases of two and three words that can have ``least`` occurrences, with exact counts, and
    for n = 0 the number of all words of a language. ``least`` is ``MOST`` at most."""
    if not 1 <= least <= MOST:
        raise ValueError(f"the threshold must be from 1 to {MOST}")
    docs = located(docs)
    spark = docs.sparkSession
    buckets = 1 << min(14, max(8, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))
    base = shared_dir(spark)
    rows = docs.select(F.coalesce(column(lang).cast("string"), F.lit("und")).alias("lang"), ascii_lower(F.coalesce(column(text), F.lit(""))).alias("text"), (locator(docs)[1] % shards).alias("shard"))
    rows.write.partitionBy("shard").options(**CODEC).parquet(f"{base}/texts")
    known = [np.zeros(SLOTS, bool) for _ in LENGTHS]
    news: list = []
    passes: list[DataFrame] = []
    # until a cycle after the last stop at which something new had the threshold
    last_new = at = 0
    with small_batches(spark, 1000):
        while at < last_new + shards:
            shard = spark.read.schema("lang string, text string, shard int").parquet(f"{base}/texts").where(F.col("shard") == at % shards).select("lang", "text")
            passes.append(stored(_scan(shard, news, at, shards, buckets), **CODEC))
            at += 1
            # phrases of earlier stops have been through all shards before
            unnamed = reduce(DataFrame.unionByName, passes).where((F.col("stop") + shards >= at) & F.col("bucket").isNotNull())
            new = [np.zeros(SLOTS, bool) for _ in LENGTHS]
            size = SLOTS // buckets
            for n, bucket, bits in _reached(unnamed.select("n", "stop", "bucket", "keys", "counts"), least, buckets):
                new[n - 1][bucket * size : (bucket + 1) * size] |= np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[:size] == 1
            for kind, own in zip(known, new):
                own &= ~kind
                kind |= own
            last_new = at if any(own.any() for own in new) else last_new
            news.append(spark.sparkContext.broadcast((at, [np.flatnonzero(own).astype(np.int32) for own in new])))
    for n in news:
        n.destroy()
    return reduce(DataFrame.unionByName, passes).where("bucket is null").groupBy("n", "lang", "phrase").agg(F.sum("c").alias("c"))


def _score(a: str, l: str, r: str) -> F.Column:  # noqa: E741
    """floor(1000000 a a / (l r)) in decimals: exact for counts below 10^13."""
    big = lambda c: f"cast({c} as decimal(13, 0))"
    return F.expr(f"cast(({big(a)} * {big(a)} * 1000000) div ({big(l)} * {big(r)}) as bigint)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, **cycle: int) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts = stored(phrase_counts(docs, text, lang, least, **cycle))
    total = counts.where("n = 0").select("lang", F.col("c").alias("n"))  # a row a language
    f = stored(counts.where((F.col("n") > 0) & (F.col("c") >= least)))
    words = F.split("phrase", " ")
    part = lambda first, length: F.array_join(F.slice("w", first, length), " ")
    long = f.where("n > 1").select("lang", "phrase", "n", F.col("c").alias("a"), words.alias("w"))
    cuts = long.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("c").alias("l")), ["lang", "left"]).join(f.select("lang", F.col("phrase").alias("right"), F.col("c").alias("r")), ["lang", "right"])
    scored = cuts.withColumn("score", _score("a", "l", "r")).groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.array(part(F.lit(1), F.lit(2)), part(F.lit(2), F.lit(2)))
    above = long.where("n = 3").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("above"))
    kept = scored.join(above, ["lang", "phrase"], "left").where(F.coalesce(F.col("above") * 100 < F.col("a") * INSIDE, F.lit(True)))
    kept = kept.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    first = kept.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= top)
    return first.join(F.broadcast(total), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]'), lambda x: x <> '') as w from pieces),
phrases as (
  select lang, 1 as size, unnest(w) as phrase from w
  union all select lang, 2, w[i] || ' ' || w[i + 1] from (select lang, w, unnest(range(1, len(w))) as i from w)
  union all select lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] from (select lang, w, unnest(range(1, len(w) - 1)) as i from w)),
total as (select lang, count(*) as n from phrases where size = 1 group by lang),
f as (select lang, size, phrase, count(*)::hugeint as c from phrases group by all having count(*) >= 10),
cuts as (
  select lang, size, phrase, c, k, string_split(phrase, ' ') as w from f, unnest(range(1, size)) as t(k) where size > 1),
scored as (
  select x.lang, x.size, x.phrase, x.c as a, x.k, l.c as l, r.c as r, (1000000 * x.c * x.c) // (l.c * r.c) as score
  from cuts x join f l on l.lang = x.lang and l.phrase = array_to_string(x.w[:k], ' ') join f r on r.lang = x.lang and r.phrase = array_to_string(x.w[k + 1:], ' ')),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
above as (
  select lang, phrase, max(c) as above from (
    select lang, c, unnest([array_to_string(string_split(phrase, ' ')[:2], ' '), array_to_string(string_split(phrase, ' ')[2:], ' ')]) as phrase from f where size = 3) group by all),
ranked as (
  select x.lang, row_number() over (partition by x.lang order by score desc, a desc, x.phrase) as rank, x.phrase, a, l, r, score
  from lowest x left join above y on y.lang = x.lang and y.phrase = x.phrase where not coalesce(100 * above >= 50 * a, false))
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score from ranked join total using (lang) where rank <= 2000
"""
