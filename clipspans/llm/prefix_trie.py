"""The prefix trie of conversations, built from sorted neighbours.

Each conversation is one row: its turns' digests, 16 bytes a turn, one after the other. In the order of these paths, what two
neighbours share (their LCP) tells where they part, so a trie is a forest of runs of neighbours: union-find over the LCP
edges, deepest first, and each merge of runs makes the branching node at that depth (``Forest.merge``). The nodes between two
branchings have the same members and are written from the branching below.

Rows are range-partitioned by (path, conv_id), so copies of one conversation and conversations with one beginning are dealt over
many tasks. A task merges about ``TOGETHER`` rows at a time. What can still gain members from outside is only what begins
the first or the last path of such a part: all else is written as final, and is left as a sum at the depth where it
hangs (``Attached``). The part is thereby contracted to two paths, which the next part takes in as its first rows. The partitions'
contracted forests, two rows each, are merged across boundaries by the same code, in the order of the partitions. Rows whose
parent was not final name it by a digest of its path, and a join with the few such nodes fills in its smallest member.

Members that end in one node are hashed where they lie together; where they cross parts, their ids leave as pieces, in order,
and one streaming pass per node joins them in bounded memory.

Defined results: rows with a null conv_id belong to no conversation. Null roles and texts are empty. Turns with equal turn numbers
come in the order of a digest of role and text; repeated rows are repeated turns. ``c - c % 20`` takes SQL's remainder, which
has the sign of c. Texts of any length are digested and counted in the JVM; a conversation of many turns is one row of 20 bytes a
turn. An empty table has no conversations, and no root. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipspans.llm.common import column, small, stored, table

#: Bytes of a turn's digest.
WIDTH = 16
TOGETHER = 50_000
EMPTY = hashlib.sha256(b"").hexdigest()
#: Conversations of one group begin with turns of its first.
GROUP, MOST_SHARED = 20, 4

#: kind 0: a node; 1: one path of a contracted forest; 2: a piece of the ids that end in a node.
OUT = (
    "kind int, part int, seq bigint, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
    "ends_sha256 string, key binary, parent_key binary, path binary, words array<int>, attached array<array<bigint>>, piece binary"
)
_ARROW = pa.schema([
    ("kind", pa.int32()), ("part", pa.int32()), ("seq", pa.int64()),
    *[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("path", pa.binary()), ("words", pa.list_(pa.int32())), ("attached", pa.list_(pa.list_(pa.int64()))), ("piece", pa.binary()),
])


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, words) of every rebuilt conversation. One shuffle: a group's conversations are in one partition, and only turns'
    digests and word counts are moved."""
    role, text = (F.coalesce(column(c), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    turns = conversations.select(column("conv_id").cast("bigint").alias("conv_id"), F.struct(column("turn").cast("bigint").alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("n")).alias("turn"))
    turns = turns.where("conv_id is not null").withColumn("first", F.expr(f"conv_id - conv_id % {GROUP}")).repartition("first")
    own = turns.groupBy("first", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # nulls first
    head = F.max(F.when(F.col("conv_id") == F.col("first"), F.slice("turns", 1, MOST_SHARED - 1))).over(Window.partitionBy("first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    rebuilt = own.withColumns({"head": F.coalesce(head, F.slice("turns", 1, 0)), "h": h})
    rebuilt = rebuilt.select("conv_id", F.concat(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("t"))
    return rebuilt.select("conv_id", F.unhex(F.array_join("t.digest", "")).alias("path"), F.col("t.n").alias("words"))


@dataclass
class Attached:
    """What hangs at one depth of a path: members that end there, and subtrees that are already written."""

    n: int = 0
    least: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: bytes | None = None  # ids of the members that end here, not yet given away
    named: bool = False  # rows elsewhere name this node by its digest
    pieces: bool = False  # ids that end here were given away in pieces

    def add(self, other: Attached) -> Attached:
        self.n, self.children, self.leaves, self.saved = self.n + other.n, self.children + other.children, self.leaves + other.leaves, self.saved + other.saved
        self.least = other.least if self.least is None else self.least if other.least is None else min(self.least, other.least)
        if other.ends is not None:
            self.ends = other.ends if self.ends is None else self.ends + b"," + other.ends
        self.named, self.pieces = self.named or other.named, self.pieces or other.pieces
        return self

    def row(self, depth: int) -> list[int | None]:
        return [depth, self.n, self.least, self.children, self.leaves, self.saved, int(self.named), int(self.pieces)]


@dataclass
class Path:
    """One distinct path, the words of its turns, and what hangs at its depths (at its end at least its own members)."""

    path: bytes
    words: np.ndarray
    at: dict[int, Attached]

    @property
    def depth(self) -> int:
        return len(self.path) // WIDTH

    def key(self, depth: int) -> bytes:
        return hashlib.sha256(self.path[: depth * WIDTH]).digest()[:16]


def lcp(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their beginning."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low * WIDTH : mid * WIDTH] == b[low * WIDTH : mid * WIDTH] else (low, mid - 1)
    return low


@dataclass
class Component:
    """A run of neighbouring paths that share ``depth`` turns; its node there is not written yet."""

    first: int
    depth: int
    at: dict[int, Attached]
    state: Attached = field(default_factory=Attached)
    open: int | None = None  # the path at a boundary that is in it


class Forest:
    """Sorted distinct paths that are merged part by part; rows of ``OUT`` gather in ``rows``."""

    def __init__(self, part: int) -> None:
        self.part, self.seq = part, 0
        self.paths: list[Path] = []
        self.rows: list[tuple] = []

    def add(self, path: bytes, words: np.ndarray, at: dict[int, Attached]) -> None:
        """The next path in order; one that is equal to the last adds to it."""
        if self.paths and self.paths[-1].path == path:
            last = self.paths[-1].at
            for depth, what in at.items():
                last[depth] = last[depth].add(what) if depth in last else what
        else:
            self.paths.append(Path(path, words, at))

    def _give(self, key: bytes, what: Attached) -> None:
        """Ids that end in a node leave as a piece."""
        self.rows.append((2, self.part, self.seq, *[None] * 8, key, *[None] * 4, what.ends))
        self.seq += 1
        what.ends, what.pieces = None, True

    def _write(self, path: Path, low: int, high: int, node: Attached, parent: tuple[int | None, bytes | None]) -> None:
        """The nodes at depths ``high`` down to ``low`` + 1, which have the same members; ``node`` is the lowest one's state."""
        ends = EMPTY if node.ends is None else hashlib.sha256(node.ends).hexdigest()
        key = path.key(high) if node.named or node.pieces else None
        if node.pieces and node.ends is not None:
            self._give(key, node)
        saved, children = node.saved, node.children
        for depth in range(high, low, -1):
            if depth:
                saved += (node.n - 1) * int(path.words[depth - 1])
            top = depth == low + 1
            self.rows.append((0, self.part, None, node.least, depth, parent[0] if top else node.least, node.n, children, node.leaves, saved, None if node.pieces and depth == high else ends, key, parent[1] if top else None, None, None, None, None))
            children, ends, key = 1, EMPTY, None

    def _climb(self, c: Component, to: int) -> list[tuple]:
        """Moves a component up to depth ``to``, of which it becomes a child: the runs of nodes between, for ``_write``."""
        found, path = [], self.paths[c.first]
        stops = sorted(d for d in c.at if to < d < c.depth)
        while c.depth > to:
            if c.depth in c.at:
                c.state.add(c.at.pop(c.depth))
            node = c.state
            if not node.children:
                node.leaves = 1
            low = stops.pop() if stops else to
            found.append((path, low, c.depth, node))
            saved = node.saved + (node.n - 1) * int(path.words[max(low, 0) : c.depth].sum())
            c.state, c.depth = Attached(node.n, node.least, 1, node.leaves, saved), low
        return found

    def _write_all(self, runs: list[tuple], parent: tuple[int | None, bytes | None]) -> None:
        for (path, low, high, node), above in zip(runs, [r[3] for r in runs[1:]] + [None]):
            self._write(path, low, high, node, parent if above is None else (above.least, None))

    def merge(self, last: bool = False) -> None:
        """Union-find over the edges between neighbours, deepest first. Unless it is the last part, the first and the last path stay."""
        paths = self.paths
        if not paths:
            return
        n = len(paths)
        parts: list[Component | None] = [Component(i, p.depth, p.at, open=None if last or 0 < i < n - 1 else i) for i, p in enumerate(paths)]
        up = list(range(n))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        edges: dict[int, list[int]] = {}
        for i in range(n - 1):
            edges.setdefault(lcp(paths[i].path, paths[i + 1].path), []).append(i)
        for depth in sorted(edges, reverse=True):
            groups: dict[int, list[int]] = {}
            for i in edges[depth]:  # in order, so that the left one's root is the run's first
                left, right = find(i), find(i + 1)
                up[right] = left
                groups.setdefault(left, [left]).append(right)
            for root, members in groups.items():
                self._join(parts, root, members, depth)
        if last:
            c = parts[find(0)]
            self._write_all(self._climb(c, -1), (None, None))
            self.paths = []
            return
        self.paths = paths[:1] if n == 1 else [paths[0], paths[-1]]
        for p in self.paths:
            for depth, what in p.at.items():
                if what.ends is not None:
                    self._give(p.key(depth), what)

    def _join(self, parts: list[Component | None], root: int, members: list[int], depth: int) -> None:
        found = [parts[m] for m in members]
        opened = [c for c in found if c.open is not None]
        if opened:
            target = opened[0]
            home, key = self.paths[target.open].at, self.paths[target.open].key(depth)
            for c in found:
                if c.open is not None:
                    continue
                if c.depth > depth:
                    self._write_all(self._climb(c, depth), (None, key))
                    c.state.named = True
                    home.setdefault(depth, Attached()).add(c.state)
                for d, what in c.at.items():
                    home.setdefault(d, Attached()).add(what)
            parts[root] = Component(target.first, depth, home, open=target.open)
            return
        runs = [self._climb(c, depth) for c in found]
        node, at = Attached(), {}
        for c in found:
            node.add(c.state)
            for d, what in c.at.items():
                at.setdefault(d, Attached()).add(what)
        if depth in at:
            node.add(at.pop(depth))
        for r in runs:
            self._write_all(r, (node.least, None))
        parts[root] = Component(found[0].first, depth, at, node)

    def contracted(self) -> None:
        """What is left, as rows that another forest can take in."""
        for i, p in enumerate(self.paths):
            self.rows.append((1, self.part, i, *[None] * 10, p.path, p.words.tolist(), [what.row(d) for d, what in p.at.items()], None))
        self.paths = []

    def take(self, most: int = 20_000) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(self.rows), most):
            columns = zip(*self.rows[i : i + most])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
        self.rows = []


def _words(array: pa.ListArray) -> list[np.ndarray]:
    flat, cuts = array.flatten().to_numpy(), np.concatenate(([0], np.cumsum(array.value_lengths().to_numpy())))
    return [flat[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted conversations of one partition: final nodes, pieces of ids, and the contracted forest."""
    forest, waiting = Forest(TaskContext.get().partitionId()), 0
    for batch in batches:
        own = batch.column("path").to_pylist()
        ids = batch.column("conv_id").to_pylist()
        starts = [i for i in range(len(own)) if not i or own[i] != own[i - 1]]
        words = _words(batch.column("words").take(pa.array(starts, pa.int32())))
        for a, b, w in zip(starts, [*starts[1:], len(own)], words):
            forest.add(own[a], w, {len(own[a]) // WIDTH: Attached(b - a, ids[a], ends=",".join(map(str, ids[a:b])).encode())})
        waiting += batch.num_rows
        if waiting >= TOGETHER:
            forest.merge()
            yield from forest.take()
            waiting = 0
    forest.merge()
    forest.contracted()
    yield from forest.take()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contracted forests in order: the nodes that cross partitions."""
    forest = Forest(-1)
    for batch in batches:
        for path, words, attached in zip(batch.column("path").to_pylist(), _words(batch.column("words")), batch.column("attached").to_pylist()):
            forest.add(path, words, {a[0]: Attached(*a[1:6], named=bool(a[6]), pieces=bool(a[7])) for a in attached})
        if len(forest.paths) >= TOGETHER:
            forest.merge()
            yield from forest.take()
    forest.merge(last=True)
    yield from forest.take()


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ids sorted by node and place: one digest a node."""
    schema = pa.schema([("key", pa.binary()), ("ends", pa.string())])
    key, digest = None, hashlib.sha256()
    for batch in batches:
        done = []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(piece)
            else:
                digest.update(b"," + piece)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_pydict({"key": [key], "ends": [digest.hexdigest()]}, schema=schema)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``COLUMNS``."""
    spark = conversations.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = stored(paths(conversations)).repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = stored(rows.select("conv_id", "path", "words").mapInArrow(_grow, OUT))
    # two rows a partition at most
    contracted = found.where("kind = 1").select("part", "seq", "path", "words", "attached").coalesce(1).sortWithinPartitions("part", "seq")
    crossing = stored(contracted.select("path", "words", "attached").mapInArrow(_merge, OUT))
    pieces = found.where("kind = 2").select("key", "part", "seq", "piece").repartition("key").sortWithinPartitions("key", "part", "seq")
    ends = stored(pieces.select("key", "piece").mapInArrow(_hash, "key binary, ends string"))
    # nodes that others name, or whose ids came in pieces: those at the boundaries of parts
    nodes = found.where("kind = 0").unionByName(crossing).drop("kind", "part", "seq", "path", "words", "attached", "piece")
    named = stored(nodes.where("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named")))
    out = nodes.join(small(ends), "key", "left").join(small(named), "parent_key", "left")
    return out.withColumns({"parent_conv_id": F.coalesce("parent_conv_id", "named"), "ends_sha256": F.coalesce("ends_sha256", "ends", F.lit(EMPTY))}).select(*COLUMNS)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


SQL = r"""
with turns as (
  select conv_id, turn, role, text, sha256(strlen(role)::varchar || ':' || role || text) as digest, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
  from (select conv_id::bigint as conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, substr(digest, 1, 32)) as i from turns),
crc_table as (
  select n, (with recursive bits(k, c) as (select 0, n union all select k + 1, case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end from bits where k < 8) select c from bits where k = 8) as v
  from (select unnest(range(256))::bigint as n)),
crc as (
  with recursive step(conv_id, rest, c) as (
    select conv_id, conv_id::varchar, 4294967295::bigint from (select distinct conv_id from turns)
    union all
    select conv_id, rest[2:], xor(c // 256, v) from step join crc_table on n = xor(c % 256, ascii(rest)) where rest <> '')
  select conv_id, xor(c, 4294967295) % 4 as h from step where rest = ''),
rebuilt as (
  select c.conv_id, o.i, o.role, o.text, o.words from crc c join ordered o on o.conv_id = c.conv_id - c.conv_id % 20 and o.i <= h
  union all
  select c.conv_id, o.i, o.role, o.text, o.words from crc c join ordered o on o.conv_id = c.conv_id and o.i > h),
numbered as (select conv_id, row_number() over (partition by conv_id order by i) as depth, to_json([role, text])::varchar as turn, words from rebuilt),
prefixes as (
  select conv_id, depth, words, sha256(string_agg(sha256(turn), '') over (partition by conv_id order by depth)) as node from numbered
  union all
  select conv_id, 0, 0, '' from crc),
ended as (select conv_id, max(depth) as n_turns from prefixes group by 1),
linked as (select p.*, lag(node) over (partition by conv_id order by p.depth) as parent, n_turns from prefixes p join ended using (conv_id)),
nodes as (
  select node, any_value(parent) as parent, min(conv_id) as conv_id, depth, any_value(words) as words, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = n_turns), '')) as ends_sha256
  from linked group by node, depth),
children as (select parent, count(*) as n from nodes where parent is not null group by 1),
above as (
  with recursive up(node, top) as (select node, node from nodes union all select up.node, nodes.parent from up join nodes on nodes.node = up.top where nodes.parent is not null)
  select * from up),
sums as (
  select top as node, count(*) filter (where c.n is null) as n_leaves, sum((m.n_convs - 1) * m.words)::bigint as saved_tokens
  from above join nodes m on m.node = above.node left join children c on c.parent = m.node group by 1)
select x.conv_id, x.depth::bigint as depth, p.conv_id as parent_conv_id, x.n_convs, coalesce(c.n, 0) as n_children, s.n_leaves, s.saved_tokens, x.ends_sha256
from nodes x join sums s using (node) left join children c on c.parent = x.node left join nodes p on p.node = x.parent
"""
