"""SimHash near-deduplication by multi-index hashing.

A fingerprint has a bit set where more than half of the text's shingle hashes have it set. Fingerprints are cut into
segments. By the pigeonhole principle, two fingerprints within the linking distance agree in some segment up to that
segment's radius, so it is enough to meet in one cell: every distinct fingerprint is a member of the cell that its own
segment names, and visits the cells of the small Hamming ball around it. Two segments at distance 1 differ in one bit,
and only the one with a 0 there makes the visit, which halves the ball. For radius 2 every fingerprint is a member of all cells
at distance 1 as well, and two segments at distance 2 meet halfway. In each cell complete distances are verified.

Nothing is capped. A cell is handled as one list pair of bounded size; one that holds more than ``CHUNK`` rows is cut
into k chunks and all k * k chunk pairs are compared, each in a task of its own. A cell reduces the links of each
group to edges from one root, and a task passes on only edges that connect what it had not connected before, so links inside
a dense group never become rows. Copies share one fingerprint row.

Defined results: a text without words (null, empty, white space) has fingerprint zero, linked like any other; with fewer
words than a shingle the whole sequence is the one shingle; repeated shingles count each time; rows with equal or null
ids stay rows of their own (a null id is never a component's smallest unless all are null). An empty table gives none.

``deduplicate`` (the pipeline's stage) takes fingerprints of distinct shingles and uses their links as candidates only: two
texts are near copies where the Jaccard similarity of their shingle sets is at least ``SIMILAR``, computed for all pairs of each
candidate component (shingles as 64-bit hashes), and groups are the components of those links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipspans.llm.common import LOWER_BYTES, column, located, locator, small, small_batches, stored, table, within, without
from clipspans.llm.components import components

CHUNK = 4096
#: The least Jaccard similarity of near copies, and the most shingles and texts of a part of a candidate component.
SIMILAR, PART_SHINGLES, PART_TEXTS = 0.8, 1 << 20, 2048
#: Cells, and parts of candidate components, that a worker holds at a time.
CELLS, PARTS = 64, 8
#: (word of the fingerprint, lowest bit, bits, radius). Any distance of 4 is at most 1, 1 and 0 in some of these three.
SEGMENTS_4 = ((0, 0, 22, 1), (0, 22, 21, 1), (0, 43, 21, 0))
#: For 128 bits: eight segments of 16 bits, radius 2; every pair up to distance 23, and most beyond.
SEGMENTS_128 = tuple((i // 4, 16 * (i % 4), 16, 2) for i in range(8))


def _shingles(text: str | None, shingle: int) -> tuple[memoryview, list[int], list[int]]:
    """The text's words joined by single spaces, and where each shingle starts and ends there."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()
    if not words:
        return memoryview(b""), [], []
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    return memoryview(b" ".join(words)), starts, ends[min(shingle, len(words)) - 1 :].tolist()


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    joined, starts, ends = _shingles(text, shingle)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends)), "<u8", len(starts)))


def _majority(hashes: np.ndarray) -> int:
    """Signed word of the bits that more than half of the hashes have; 0 for none."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):  # bounded memory for any length
        total += np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")[0])


def set_fingerprint(hashes: np.ndarray) -> list[int]:
    """128 bits of a set of hashes: those of the hashes and those of the hashes mixed once more, as two signed words."""
    h = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return [_majority(hashes), _majority(h ^ (h >> np.uint64(31)))]


def fingerprint(text: str | None, shingle: int, seeds: tuple[int, ...]) -> list[int]:
    """One signed 64-bit word per seed; repeated shingles count each time."""
    joined, starts, ends = _shingles(text, shingle)
    n = len(starts)
    if not n:
        return [0] * len(seeds)
    return [_majority(np.fromiter((xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends)), "<u8", n)) for seed in seeds]


def fingerprints(docs: DataFrame, text: str, id: str, shingle: int, seeds: tuple[int, ...]) -> DataFrame:
    """(id, file, row, f0, f1, ...) for every row of located ``docs``."""
    names = [f"f{i}" for i in range(len(seeds))]

    @F.pandas_udf(", ".join(f"{n} bigint" for n in names))
    def mark(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([fingerprint(t, shingle, seeds) for t in batch], columns=names, dtype="int64")

    marked = docs.select(column(id).cast("bigint").alias("id"), *locator(docs), mark(column(text)).alias("f"))
    return marked.select("id", "file", "row", "f.*")


def _visits(segments: tuple) -> Column:
    """The cells of a fingerprint: struct(cell, member)."""
    out = []
    for i, (word, low, bits, radius) in enumerate(segments):
        assert radius in (0, 1, 2)
        key = F.shiftrightunsigned(F.col(f"f{word}"), low).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))
        base = F.lit(i << 32).cast("bigint")
        out.append(F.array(F.struct((base + key).alias("cell"), F.lit(True).alias("member"))))
        if radius == 2:
            out.append(F.array(*[F.struct((base + key.bitwiseXOR(F.lit(1 << b))).alias("cell"), F.lit(True).alias("member")) for b in range(bits)]))
        elif radius:
            flips = F.filter(F.array(*[F.when(key.bitwiseAND(F.lit(1 << b)) == 0, base + key + F.lit(1 << b)) for b in range(bits)]), lambda c: c.isNotNull())
            out.append(F.transform(flips, lambda c: F.struct(c.alias("cell"), F.lit(False).alias("member"))))
    return F.concat(*out)


def _linked(members: np.ndarray, rest: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Star edges (positions in members + rest) of the groups that links of members to all connect."""
    every = np.concatenate((members, rest))
    near = np.zeros((len(members), len(every)), np.uint16)
    for word in range(every.shape[1]):
        near += np.bitwise_count(members[:, None, word] ^ every[None, :, word])
    links = near <= distance
    parent = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    joined = np.zeros(len(every), bool)
    for i in np.flatnonzero(links.sum(axis=1) > 1).tolist():
        row = np.flatnonzero(links[i])
        new = row[~joined[row]].tolist()
        # those that are joined already need one union per group only
        for j in {root(j) for j in row[joined[row]].tolist()} | {i}:
            parent[root(j)] = root(i)
        for j in new:
            parent[root(j)] = root(i)
        joined[row] = True
    least: dict[int, int] = {}  # a group's star has its least fingerprint in the middle, so that cells agree on it
    order = {x: tuple(every[x].tolist()) for x in parent}
    for x in order:
        r = root(x)
        if r not in least or order[x] < order[least[r]]:
            least[r] = x
    return [(least[root(x)], x) for x in order if least[root(x)] != x]


def edges(prints: DataFrame, segments: tuple, width: int, distance: int) -> DataFrame:
    """Edges (u, v), nodes as hex text, that connect exactly what links among ``prints`` (distinct f0..) connect."""
    names = [f"f{i}" for i in range(width)]
    rows = stored(prints.select(*names, F.explode(_visits(segments)).alias("x")).select("x.*", *names))
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.bool_or("member").alias("any"))
    big = sizes.where((F.col("size") > CHUNK) & F.col("any")).select("cell", F.ceil(F.col("size") / CHUNK).cast("int").alias("k"))
    rows = rows.join(big, "cell", "left").withColumn("c", F.pmod(F.xxhash64(*names), F.col("k")).cast("int"))
    every = F.sequence(F.lit(0), F.col("k") - 1)
    at = lambda a, b, m: F.struct(a.alias("a"), b.alias("b"), F.lit(m).alias("m"))
    own = F.transform(every, lambda i: at(F.col("c"), i, True))
    other = lambda all_: F.filter(F.transform(every, lambda i: at(i, F.col("c"), False)), lambda x: F.lit(all_) | (x["a"] != F.col("c")))
    parts = F.when(F.col("k").isNull(), F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.col("member").alias("m")))).when(F.col("member"), F.concat(own, other(False))).otherwise(other(True))
    rows = rows.select("cell", F.explode_outer(parts).alias("p"), *names).select("cell", "p.*", *names)
    lists = [F.collect_list(F.when(F.col("m") == m, F.struct(*names))).alias(n) for m, n in ((True, "members"), (False, "rest"))]
    cells = rows.groupBy("cell", "a", "b").agg(*lists).where("size(members) >= 1 and size(members) + size(rest) >= 2").select("members", "rest")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[str, str] = {}  # of the linked nodes that this task has met

        def top(x: str) -> str:
            while group.setdefault(x, x) != x:
                group[x] = x = group[group[x]]
            return x

        for batch in batches:
            u, v, flat = [], [], []
            for col in (batch.column(0), batch.column(1)):
                values = col.flatten()
                words = np.stack([values.field(i).to_numpy(zero_copy_only=False) for i in range(width)], axis=1).view(np.uint64) if len(values) else np.zeros((0, width), np.uint64)
                flat.append((words, np.concatenate(([0], np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))))))
            (m, mo), (r, ro) = flat
            for i in range(batch.num_rows):
                a, b = m[mo[i] : mo[i + 1]], r[ro[i] : ro[i + 1]]
                for pair in _linked(a, b, distance):
                    x, y = ("".join(f"{w:016x}" for w in (a[k] if k < len(a) else b[k - len(a)]).tolist()) for k in pair)
                    if top(x) != top(y):  # else other cells of this task have connected them
                        low, high = sorted((top(x), top(y)))
                        group[high] = low
                        u.append(low)
                        v.append(high)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.string()), pa.array(v, pa.string())], ["u", "v"])

    return cells.mapInArrow(link, "u string, v string")


def classes(docs: DataFrame, text: str = "text", id: str = "doc_id", shingle: int = 4, seeds: tuple[int, ...] = (42,), segments: tuple = SEGMENTS_4, distance: int = 4) -> DataFrame:
    """(id, file, row, fingerprint, component, kept) for every row; kept marks one row of each component, its smallest id."""
    names = [f"f{i}" for i in range(len(seeds))]
    node = F.concat(*[F.lpad(F.lower(F.hex(n)), 16, "0") for n in names])
    with small_batches(docs.sparkSession):
        rows = stored(fingerprints(located(docs), text, id, shingle, seeds).withColumn("node", node))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")
    prints = stored(rows.groupBy("node", *names).agg(F.min(order).alias("first")))
    with small_batches(docs.sparkSession, CELLS):
        roots = components(edges(prints, segments, len(seeds), distance))
    found = _least_of_groups(prints.select("node", "first"), roots)
    return rows.join(found, "node").select("id", "file", "row", F.col("node").alias("fingerprint"), F.col("least.id").alias("component"), order.eqNullSafe(F.col("least")).alias("kept"))


def _least_of_groups(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, least) of (node, first): the least ``first`` of a node's component. Nodes without an edge are their own."""
    grouped = stored(nodes.join(roots, "node"))
    least = stored(grouped.groupBy("root").agg(F.min("first").alias("least")))
    least = grouped.join(small(least), "root").select("node", "least")
    return nodes.join(least, "node", "left").select("node", F.coalesce("least", "first").alias("least"))


def _similar(sets: list[np.ndarray], others: list[np.ndarray] | None) -> Iterator[tuple[int, int]]:
    """Positions (in sets + others) of all pairs with a Jaccard similarity of ``SIMILAR`` or more: of sets and others, or within sets."""
    right = sets if others is None else others
    sizes = np.array([len(x) for x in right])
    values = np.concatenate(right)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], np.repeat(np.arange(len(right)), sizes)[order]
    for i, one in enumerate(sets):
        low, high = np.searchsorted(values, one, "left"), np.searchsorted(values, one, "right")
        n = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if n.sum() else np.zeros(0, np.int64)
        common = np.bincount(owner[at], minlength=len(right))
        # in whole numbers: common / (sizes + len(one) - common) >= 4 / 5
        for j in np.flatnonzero((common > 0) & (common * 5 >= (sizes + len(one) - common) * 4)).tolist():
            if others is not None:
                yield i, len(sets) + j
            elif i < j:
                yield i, j


def near_links(docs: DataFrame, text: str, shingle: int, found: DataFrame) -> DataFrame:
    """Edges (u, v) that connect exactly what similar pairs within each group of ``found`` (root, node, file, row) connect."""

    @F.pandas_udf("binary")
    def collect(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shingle_set(t, shingle).tobytes() for t in batch], dtype=object)

    here = within(docs.select(column(text).alias("text")), found.select("file", "row")).select("file", "row", collect("text").alias("shingles"))
    with small_batches(docs.sparkSession):
        sets = stored(here.join(small(found), ["file", "row"]).select("root", "node", "shingles"))
    k = F.ceil(F.greatest(F.sum(F.octet_length("shingles")) / (8 * PART_SHINGLES), F.count(F.lit(1)) / PART_TEXTS, F.lit(1))).cast("int")
    sets = sets.join(small(stored(sets.groupBy("root").agg(k.alias("k")))), "root").withColumn("c", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda i: F.struct(F.least("c", i).alias("a"), F.greatest("c", i).alias("b")))
    sets = sets.select("root", "node", "shingles", "c", F.explode(pair).alias("p")).select("root", "p.*", F.col("c") == F.col("p.a"), "node", "shingles").toDF("root", "a", "b", "first", "node", "shingles")
    lists = [F.collect_list(F.when(F.col("first") == m, F.struct("node", "shingles"))).alias(n) for m, n in ((True, "left"), (False, "right"))]
    parts = sets.groupBy("root", "a", "b").agg(*lists).where("size(left) >= 1 and (a = b or size(right) >= 1)").select((F.col("a") == F.col("b")).alias("own"), "left", "right")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[str, str] = {}  # of the linked nodes that this task has met

        def top(x: str) -> str:
            while group.setdefault(x, x) != x:
                group[x] = x = group[group[x]]
            return x

        for batch in batches:
            u, v = [], []
            for i in range(batch.num_rows):
                left, right = batch.column(1)[i].values, batch.column(2)[i].values
                names = left.field(0).to_pylist() + right.field(0).to_pylist()
                both = [[np.frombuffer(x.as_py(), "<u8") for x in side.field(1)] for side in (left, right)]
                for a, b in _similar(both[0], None if batch.column(0)[i].as_py() else both[1]):
                    x, y = top(names[a]), top(names[b])
                    if x != y:  # else other pairs of this task have connected them
                        group[max(x, y)] = min(x, y)
                        u.append(names[a])
                        v.append(names[b])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.string()), pa.array(v, pa.string())], ["u", "v"])

    return parts.mapInArrow(link, "u string, v string")


def near_classes(docs: DataFrame, text: str, id: str, shingle: int, segments: tuple, distance: int) -> DataFrame:
    """(id, file, row, component, kept) for every row of located ``docs``: components of texts whose shingle sets are similar."""
    names = ["f0", "f1"]

    @F.pandas_udf(", ".join(f"{n} bigint" for n in names) + ", node string")
    def mark(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            sets = [shingle_set(t, shingle) for t in batch]
            rows = [[*set_fingerprint(s), xxhash.xxh3_128_hexdigest(s.tobytes())] for s in sets]
            yield pd.DataFrame(rows, columns=[*names, "node"]).astype({n: "int64" for n in names})

    marked = docs.select(column(id).cast("bigint").alias("id"), *locator(docs), mark(column(text)).alias("f"))
    with small_batches(docs.sparkSession):
        rows = stored(marked.select("id", "file", "row", "f.*"))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")
    # one node per distinct set of shingles
    nodes = stored(rows.groupBy("node", *names).agg(F.min(order).alias("first")).withColumn("print", F.concat(*[F.lpad(F.lower(F.hex(n)), 16, "0") for n in names])))
    with small_batches(docs.sparkSession, CELLS):
        near = components(edges(nodes.select(*names).distinct(), segments, 2, distance)).withColumnRenamed("node", "print")
    near = stored(nodes.join(near, "print", "left").select(F.coalesce("root", "print").alias("root"), "node", "first.file", "first.row"))
    several = stored(near.groupBy("root").count().where("count > 1").select("root"))
    with small_batches(docs.sparkSession, PARTS):
        roots = components(near_links(docs, text, shingle, stored(near.join(small(several), "root"))))
    found = _least_of_groups(nodes.select("node", "first"), roots)
    return rows.join(found, "node").select("id", "file", "row", F.col("least.id").alias("component"), order.eqNullSafe(F.col("least")).alias("kept"))


def deduplicate(docs: DataFrame, text: str = "text", id: str = "doc_id", shingle: int = 5, segments: tuple = SEGMENTS_128, distance: int = 29) -> DataFrame:
    """``docs`` with one row of each group of near copies, with all columns.

    Five-word shingles and 128 bits: for a Jaccard similarity of 0.8 about 19 bits differ, with a deviation of 4; 29 leaves room
    for chance."""
    docs = located(docs)
    return without(docs, near_classes(docs, text, id, shingle, segments, distance).where("not kept"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))
