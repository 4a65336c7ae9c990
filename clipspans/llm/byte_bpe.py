"""Byte-level BPE encoding and decoding, with long texts cut into overlapping chunks.

A text is split into pre-tokens by a pattern, and each pre-token's bytes are merged by rank. Texts of up to ``CHUNK`` + ``OVERLAP``
characters are encoded where they are read. A longer one is cut into chunks of ``CHUNK`` characters that each reach ``OVERLAP``
further, which are dealt over all tasks and pre-tokenised from their first character on, wherever that stands. Two neighbours
have the overlap in common; where both have a pre-token boundary at one place, all that follows is split alike, as the
pattern never looks back. There they are stitched (``Stitch``). Of a chunk's last pre-tokens only those count that text beyond its end can't change. Where no boundary is
common (one pre-token longer than the overlap), chunks are joined up to where white space follows something else, which is a boundary
in every split, and the joined text is split anew: results are exact for any text.

Pre-tokens are found in runs, a blank and what follows up to the next one; a run's ids are the same wherever it stands, so a worker
learns each distinct run once and puts batches together by lookup. Decoding concatenates the bytes of ids, with one lookup a batch.

Defined results: null texts are empty and have no ids; the bytes of an id list are concatenated even where they are not UTF-8;
null id lists decode to no bytes. Repeated rows and null ids keep a row each. A text of any length is encoded whole; one row's
ids must fit in memory. An empty table gives none. Columns of any name, but the text's, are kept.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from clipspans.llm.common import column, free_name, located, locator, small_batches, stored, table
from clipspans.llm.pieces import Store, per_list, take

#: Characters of a chunk, and of its neighbour's text that it has as well.
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Characters that a contraction looks ahead.
AHEAD = 3
#: Bytes from which merging uses a heap.
LONG = 100
_BITS = 20
#: Where any split has a boundary: white space after something else. ``_ODD`` finds texts in which some blank is no such place.
_HARD = regex.compile(r"\S(?=\s)")
_HARD_BLANK = regex.compile(r"\S(?= )")
_ODD = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
#: Below this all Unicode versions agree on letters and numbers.
_NEWER = regex.compile("[԰-\U0010ffff]")


@lru_cache(maxsize=1)
def _newer_letters() -> dict[int, int]:
    """Letters and numbers that ``regex`` knows and the library's older Unicode tables don't; there they are signs, as their stand-in is."""
    import tiktoken

    new = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and regex.match(r"[\p{L}\p{N}]", c)]
    ranks = {bytes([i]): i for i in range(256)}
    for c in new:
        for n in range(2, len(c.encode()) + 1):
            ranks.setdefault(c.encode()[:n], len(ranks))
    for c in new:
        ranks.setdefault(b"!" + c.encode(), len(ranks))
    # "!" and a sign are one pre-token, "!" and a letter or number are two
    plain = tiktoken.Encoding("signs", pat_str=r"[^\s\p{L}\p{N}]+|\s+|\p{L}+|\p{N}+", mergeable_ranks=ranks, special_tokens={})
    return {ord(c): 0xE000 for c in new if len(plain.encode_ordinary("!" + c)) == 1}


def read_ranks(path: str) -> bytes:
    """The rank file, base64 bytes and rank in each line; its size is the vocabulary's."""
    with open(path, "rb") as f:
        return f.read()


class Encoder:
    """Ids of texts by ranks and a pattern. What a worker has met is kept, up to a fixed number of runs."""

    def __init__(self, ranks: bytes, pattern: str, most: int = 600_000) -> None:
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.pattern = regex.compile(pattern)
        self.store = Store(most)
        # every way to put a token together from two
        self.pairs = {self.ranks[t[:i]] << _BITS | self.ranks[t[i:]]: r for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks}
        self.of_byte = [self.ranks[bytes([b])] for b in range(256)]
        known = {r: t for t, r in self.ranks.items()}
        shown = [known.get(i, b"") for i in range(max(known) + 1)]
        self.bytes = pa.array(shown, pa.large_binary())
        self.decimal = pa.array([b"%d " % i for i in range(len(shown))], pa.large_binary())

    # pre-tokens

    def bounds(self, text: str) -> list[int]:
        """Where the pre-tokens of a text end."""
        if _NEWER.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            text = text.translate(_newer_letters())
        return [m.end() for m in self.pattern.finditer(text)]

    def pre_tokens(self, text: str) -> list[str]:
        if not text.isascii() and _NEWER.search(text):
            ends = self.bounds(text)
            return [text[a:b] for a, b in zip([0, *ends], ends)]
        return self.pattern.findall(text)

    # merges

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: of all neighbours that make a token, those of least rank merge first, from the left."""
        rank = self.ranks.get(piece)
        if rank is not None:
            return [rank]
        ids = [self.of_byte[b] for b in piece]
        if len(ids) > LONG:
            return self._merge_long(ids)
        get, none = self.pairs.get, 1 << 60
        found = [get(a << _BITS | b, none) for a, b in zip(ids, ids[1:])]
        while found:
            least = min(found)
            if least == none:
                break
            i = found.index(least)
            ids[i : i + 2] = [least]
            del found[i]
            if i:
                found[i - 1] = get(ids[i - 1] << _BITS | least, none)
            if i < len(found):
                found[i] = get(least << _BITS | ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        get, n = self.pairs.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] << _BITS | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := get(r << _BITS | ids[k])) is not None:
                    heapq.heappush(heap, (s, i, r, ids[k]))
            h = before[i]
            if h >= 0 and (s := get(ids[h] << _BITS | r)) is not None:
                heapq.heappush(heap, (s, h, ids[h], r))
        return [i for i in ids if i >= 0]

    # texts

    def _learn(self, runs: list[str]) -> np.ndarray:
        split = [self.pre_tokens(r) for r in runs]
        found: dict[str, list[int]] = {}
        for s in split:
            for p in s:
                if p not in found:
                    found[p] = self.merge(p.encode("utf-8", "surrogatepass"))
        each = [[i for p in s for i in found[p]] for s in split]
        return self.store.add(runs, np.array([i for e in each for i in e], np.int32), np.cumsum([len(e) for e in each]))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        odd = pc.match_substring_regex(texts, _ODD)
        lists = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        flat = lists.flatten()
        starts = np.cumsum(np.concatenate(([0], lists.value_lengths().to_numpy()[:-1])))
        first = flat.take(pa.array(starts)).to_pylist()
        distinct = flat.dictionary_encode()
        names = [" " + c for c in distinct.dictionary.to_pylist()]
        odd_runs = {i: self._runs(texts[i].as_py()) for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()}
        more = list({r for runs in odd_runs.values() for r in runs})
        numbers = self.store.numbers(names + first + more, self._learn_distinct)
        which = numbers[: len(names)][distinct.indices.to_numpy()]
        which[starts] = numbers[len(names) : len(names) + len(first)]
        out, ends = take(self.store.ids, self.store.first, self.store.end, which)
        n = per_list(lists, ends)
        if not odd_runs:
            return out, n
        place, own, parts, at = dict(zip(more, numbers[len(names) + len(first) :].tolist())), n.copy(), [], 0
        cuts = np.concatenate(([0], np.cumsum(n)))
        for i, runs in odd_runs.items():
            mine, _ = self.store.take(np.array([place[r] for r in runs], np.int64))
            parts += [out[at : cuts[i]], mine]
            at, own[i] = cuts[i], len(mine)
        return np.concatenate([*parts, out[at:]]), own

    def _learn_distinct(self, names: list[str]) -> np.ndarray:
        distinct = list(dict.fromkeys(names))
        number = dict(zip(distinct, self._learn(distinct).tolist()))
        return np.array([number[n] for n in names], np.int64)

    def _runs(self, text: str) -> list[str]:
        cuts = [0, *[m.end() for m in _HARD_BLANK.finditer(text)], len(text)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:])]

    def ids(self, text: str) -> np.ndarray:
        return self.encode_all(pa.array([text]))[0]

    # ids

    def _joined(self, shown: pa.Array, ids: np.ndarray, n: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes of all ids one after the other, and where each list's end."""
        found = shown.take(pa.array(ids))
        if not len(found):
            return memoryview(b""), np.zeros(len(n) + 1, np.int64)
        offsets = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1]
        return memoryview(found.buffers()[2] or b""), offsets[np.concatenate(([0], np.cumsum(n)))]

    def decode_all(self, ids: np.ndarray, n: np.ndarray) -> pa.Array:
        """The bytes of each ``n`` ids of ``ids``, not always UTF-8."""
        data, cuts = self._joined(self.bytes, ids, n)
        return pa.array([bytes(data[a:b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist())], pa.binary())

    def digests(self, ids: np.ndarray, n: np.ndarray) -> pa.StructArray:
        """n_tokens, ids_sha256 (of decimal ids with blanks between) and decoded_sha256 (of the decoded bytes) of each list."""
        said, at = self._joined(self.decimal, ids, n)
        found = [hashlib.sha256(said[a : max(a, b - 1)]).hexdigest() for a, b in zip(at.tolist(), at[1:].tolist())]
        del said
        data, cuts = self._joined(self.bytes, ids, n)
        decoded = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(found, pa.string()), pa.array(decoded, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])


#: What ``Encoder.digests`` and ``_lists`` give.
DIGESTS, IDS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string", "token_ids array<int>"


def _lists(encoder: Encoder, ids: np.ndarray, n: np.ndarray) -> pa.StructArray:
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(ids, pa.int32()))
    return pa.StructArray.from_arrays([lists], ["token_ids"])


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def encoder_of(ranks: bytes, pattern: str) -> Encoder:
    """One for each vocabulary of a worker process."""
    key = hash(ranks), pattern
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(ranks, pattern)
    return _ENCODERS[key]


#: One chunk: ids of all its pre-tokens; boundaries in what it shares with the chunk before (head) and with the next (tail), counted
#: in characters from where the shared text begins, each with the number of ids before it; its text where a neighbour may need it.
CHUNKS = pa.schema([("k", pa.int32()), ("last", pa.bool_()), ("ids", pa.list_(pa.int32())), *[(c, pa.list_(pa.int32())) for c in ("head", "head_ids", "tail", "tail_ids")], ("text", pa.string())])
_CHUNKS = "k int, last boolean, ids array<int>, head array<int>, head_ids array<int>, tail array<int>, tail_ids array<int>, text string"


def split_chunk(encoder: Encoder, text: str, last: bool, chunk: int = CHUNK, overlap: int = OVERLAP) -> dict:
    """A chunk's row of ``CHUNKS`` but for its place."""
    ends = np.array(encoder.bounds(text), np.int64)
    starts = np.concatenate(([0], ends))
    ids, n = encoder.encode_all(pa.array([text[a:b] for a, b in zip(starts.tolist(), ends.tolist())], pa.string()))
    before = np.concatenate(([0], np.cumsum(n)))
    head = starts <= overlap - AHEAD
    tail = (starts >= chunk) & (starts <= len(text) - AHEAD) & (not last)
    hard = lambda t: _HARD.search(t, 0, overlap - AHEAD) is not None
    own = hard(text[:overlap]) and (last or hard(text[chunk:]))
    return {"last": last, "ids": ids, "head": starts[head], "head_ids": before[head], "tail": starts[tail] - chunk, "tail_ids": before[tail], "text": None if own else text}


class Stitch:
    """Chunks of one text in order; ``ids`` are those of all stitched so far."""

    def __init__(self, encoder: Encoder, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        self.encoder, self.chunk, self.overlap = encoder, chunk, overlap
        self.ids: list[np.ndarray] = []
        self.row: dict | None = None
        self.start, self.first = 0, 0  # from where, in characters and ids, the last chunk isn't stitched yet
        self.joined: list[str] = []

    def add(self, row: dict) -> None:
        """The next chunk."""
        if self.row is not None:
            self._meet(row)
        self.row = row

    def _meet(self, row: dict) -> None:
        known = self.row
        if self.joined:
            # worth a split only where a boundary is sure
            if _HARD.search(row["text"] or " ", 0, self.overlap - AHEAD) is None and row["text"] is not None:
                self.joined.append(row["text"][self.overlap :])
                return
            text = "".join(self.joined)
            known = split_chunk(self.encoder, text, False, len(text) - self.overlap, self.overlap)
            self.first = 0
        places = dict(zip(row["head"], row["head_ids"]))
        for at, n in zip(known["tail"], known["tail_ids"]):
            if at in places and n >= self.first:
                self.ids.append(np.asarray(known["ids"][self.first : n], np.int32))
                self.start, self.first, self.joined = int(at), int(places[at]), []
                return
        # no boundary in common, so both have their text
        if not self.joined:
            self.joined = [known["text"][self.start :]]
        self.joined.append(row["text"][self.overlap :])

    def end(self) -> np.ndarray:
        if self.joined:
            self.ids.append(self.encoder.ids("".join(self.joined)))
        elif self.row is not None:
            self.ids.append(np.asarray(self.row["ids"][self.first :], np.int32))
        return np.concatenate(self.ids) if self.ids else np.zeros(0, np.int32)


def _slices(batch: pa.RecordBatch, size: np.ndarray, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most`` bytes of text."""
    part = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def encoded(docs: DataFrame, ranks: str, pattern: str, of: Callable[[Encoder, np.ndarray, np.ndarray], pa.StructArray], kind: str, text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` without the text, and with the columns ``kind`` that ``of`` makes of (encoder, ids of all rows, how many each row has)."""
    docs = located(docs)
    spark = docs.sparkSession
    given = spark.sparkContext.broadcast((read_ranks(ranks), pattern))
    keep = [c for c in docs.columns if c != text]
    # columns have plain names inside, as Python stages take no others
    inner = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[column(c).alias(i) for c, i in zip(keep, inner)], F.coalesce(column(text).cast("string"), F.lit("")).alias("text"), *locator(docs))
    made = StructType.fromDDL(kind)
    out = StructType([StructField(i, docs.schema[c].dataType) for c, i in zip(keep, inner)]).add("file", StringType()).add("row", LongType()).add("found", made).add("chunks", ArrayType(StringType()))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Short texts are encoded, long ones cut."""
        encoder = encoder_of(*given.value)
        for whole in batches:
            texts = whole.column(len(keep))
            for batch in _slices(whole, pc.binary_length(texts).to_numpy()):
                texts = batch.column(len(keep))
                is_long = pc.greater(pc.utf8_length(texts), chunk + overlap)
                ids, n = encoder.encode_all(pc.if_else(is_long, "", texts))
                cut = [None] * batch.num_rows
                for i in np.flatnonzero(is_long.to_numpy(zero_copy_only=False)).tolist():
                    t = texts[i].as_py()
                    cut[i] = [t[a : a + chunk + overlap] for a in range(0, len(t) - overlap, chunk)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *batch.columns[len(keep) + 1 :], of(encoder, ids, n), pa.array(cut, pa.list_(pa.string()))], names=out.names)
                pa.default_memory_pool().release_unused()

    with small_batches(spark):
        found = stored(rows.mapInArrow(first, out))
        short = found.where("chunks is null")
        long = found.where("chunks is not null")
        pieces = long.select("file", "row", F.size("chunks").alias("n"), F.posexplode("chunks").alias("k", "text"))
        pieces = pieces.select("file", "row", "k", (F.col("k") == F.col("n") - 1).alias("last"), "text")

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = encoder_of(*given.value)
            for batch in batches:
                for r in batch.to_pylist():
                    got = split_chunk(encoder, r["text"], r["last"], chunk, overlap)
                    values = [r["file"], r["row"], r["k"], *[got[c] for c in CHUNKS.names[1:]]]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.string(), pa.int64(), *CHUNKS.types])], names=["file", "row", *CHUNKS.names])

        def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder, now, text = encoder_of(*given.value), None, None

            def whole() -> pa.RecordBatch:
                ids = text.end()
                return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]], pa.int64()), of(encoder, ids, np.array([len(ids)]))], names=["file", "row", "found"])

            for batch in batches:
                for k in range(batch.num_rows):
                    r = batch.slice(k, 1)
                    place = r.column("file")[0].as_py(), r.column("row")[0].as_py()
                    if place != now:
                        if now is not None:
                            yield whole()
                        now, text = place, Stitch(encoder, chunk, overlap)
                    row = {c: (r.column(c)[0].values.to_numpy() if pa.types.is_list(t) else r.column(c)[0].as_py()) for c, t in zip(CHUNKS.names, CHUNKS.types)}
                    text.add(row | {c: row[c].tolist() for c in ("head", "head_ids", "tail", "tail_ids")})
            if now is not None:
                yield whole()

        parts = pieces.repartition("file", "row", "k").mapInArrow(split, f"file string, row bigint, {_CHUNKS}")
        ordered = parts.repartition("file", "row").sortWithinPartitions("file", "row", "k")
        done = stored(ordered.mapInArrow(stitch, f"file string, row bigint, found {made.simpleString()}"))
    show = [*[F.col(i).alias(c) for c, i in zip(keep, inner)], *[F.col("found")[n].alias(free_name(docs, n)) for n in made.names]]
    return short.select(*show).unionByName(long.drop("chunks", "found").join(done, ["file", "row"]).select(*show))


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", **sizes: int) -> DataFrame:
    """``docs`` with token_ids in place of the text."""
    return encoded(docs, ranks, pattern, _lists, IDS, text, **sizes)


def decode(docs: DataFrame, ranks: str, ids: str = "token_ids") -> DataFrame:
    """``docs`` with decoded, the bytes of the ids."""
    given = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    @F.arrow_udf("binary")
    def data(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_of(given.value, "")
        for batch in lists:
            yield encoder.decode_all(batch.flatten().to_numpy(), pc.fill_null(batch.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64))

    return docs.withColumn(free_name(docs, "decoded"), data(column(ids)))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, lambda e, ids, n: e.digests(ids, n), DIGESTS)
