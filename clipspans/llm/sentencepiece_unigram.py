"""SentencePiece encoding and decoding: the best path through the pieces of a text, and back.

Pieces stand in a double-array trie over their UTF-8 bytes. For every character the trie gives the pieces that begin
there, and Viterbi keeps the best sum of log scores. A character that no piece covers is spelt in byte pieces. A unigram
model's scores are used as they are; a BPE model stores merge ranks in their place, which are turned into the log
probabilities of Zipf's law for that rank.

White space is written as the marker U+2581 in front of the text that follows. No piece has a marker after another
character, so the best path of a text is those of its runs "markers, then other characters" one after the other, and a
run's path is kept for the next time it is met, up to a fixed number of runs. The runs of many texts are made distinct first; those of
texts with single spaces only are what stands between them.

Defined results: null and empty texts have no ids and decode to an empty text; decoding drops control ids, turns broken
UTF-8 in byte pieces into U+FFFD, and removes the one marker that encoding puts in front. A text comes back exactly,
unless it holds the marker itself, which comes back as a space. Other columns pass through.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipspans.llm.common import column, free_name, small_batches, stored, table
from clipspans.llm.pieces import Store, per_list, take

MARK = "▁"
ZIPF_SHIFT, UNKNOWN_PENALTY = 2.7, 10.0
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # piece types of the model file
_RUN = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class Trie:
    """Double array: the child of node s by byte c is base[s] + c if check there is s; value is a piece or -1."""

    def __init__(self, pieces: dict[bytes, int]) -> None:
        keys = sorted(pieces)
        room = 1 << 16
        base, check, value = np.zeros(room, np.int64), np.full(room, -1, np.int64), np.full(room, -1, np.int64)
        check[0] = -2
        free = 1  # nothing below it is empty
        work = [(0, 0, len(keys), 0)]
        while work:
            node, low, high, depth = work.pop()
            if low < high and len(keys[low]) == depth:
                value[node] = pieces[keys[low]]
                low += 1
            if low == high:
                continue
            groups, start = [], low
            for i in range(low, high + 1):
                if i == high or keys[i][depth] != keys[start][depth]:
                    groups.append((keys[start][depth], start, i))
                    start = i
            bytes_ = np.array([c for c, _, _ in groups])
            look, at = free, None
            while at is None:
                if look + 8192 > len(check):
                    base, check, value = (np.concatenate((x, np.full(len(x), fill, np.int64))) for x, fill in ((base, 0), (check, -1), (value, -1)))
                empty = np.flatnonzero(check[look : look + 4096] == -1) + look
                starts = empty - bytes_[0]
                starts = starts[starts > 0]
                fits = starts[(check[starts[:, None] + bytes_[None, :]] == -1).all(axis=1)]
                at = int(fits[0]) if len(fits) else None
                look += 4096
            base[node] = at
            for c, a, b in groups:
                check[at + c] = node
                work.append((at + c, a, b, depth + 1))
            while check[free] != -1:
                free += 1
        end = int(np.flatnonzero(check != -1).max()) + 257
        self.base, self.check, self.value = base[:end].tolist(), check[:end].tolist(), value[:end].tolist()


#: By model file, what a worker process has met; it outlives the tasks and the broadcast models.
_STORES: dict[str, Store] = {}


class Model:
    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        pieces = [dict(_fields(v)) for k, v in fields if k == 1]
        trainer = dict(_fields(next((v for k, v in fields if k == 2), b"")))
        normal = dict(_fields(next((v for k, v in fields if k == 3), b"")))
        if normal.get(2):
            raise ValueError("models with a character map aren't supported")
        self.prefix, self.squeeze = bool(normal.get(3, 1)), bool(normal.get(4, 1))
        self.texts = [p[1].decode("utf-8") for p in pieces]
        self.kinds = [p.get(3, NORMAL) for p in pieces]
        scores = [struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in pieces]
        if trainer.get(3, 1) == 2:  # BPE: rank r stands for the score -r
            usable = [-s for s, k in zip(scores, self.kinds) if k == NORMAL and s > -1e8]
            total = math.log(sum(1 / (r + ZIPF_SHIFT) for r in usable))
            scores = [-math.log(min(-s, 1e8) + ZIPF_SHIFT) - total for s in scores]
        self.scores = scores
        usable = {t.encode(): i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k in (NORMAL, USER)}
        if any(MARK in t.lstrip(MARK) for t, k in zip(self.texts, self.kinds) if k in (NORMAL, USER)):
            raise ValueError("a piece has the space marker inside")
        self.trie = Trie(usable)
        self.unknown = min(s for s, k in zip(scores, self.kinds) if k == NORMAL) - UNKNOWN_PENALTY
        self.bytes = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds)) if k == BYTE}
        self.unk = self.kinds.index(UNKNOWN)
        self.spelt = {i: b for b, i in self.bytes.items()}
        self.path, self.store = path, None  # the store is a worker's own, as is the table below
        self.table: pa.Array | None = None
        self.shown = [t.replace(MARK, " ") if k in (NORMAL, USER) else " ⁇ " if k == UNKNOWN else "" for t, k in zip(self.texts, self.kinds)]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"store": None, "table": None}

    def best(self, run: str) -> tuple[int, ...]:
        """Viterbi over one run; of equal paths, the one whose last piece is longest."""
        data = run.encode("utf-8", "surrogatepass")
        n = len(data)
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        score: list[float | None] = [None] * (n + 1)
        back: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        score[0] = 0.0
        at = 0
        while at < n:
            first = data[at]
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            here, node, covered = score[at], 0, False
            for end in range(at, n):
                child = base[node] + data[end]
                if check[child] != node:
                    break
                node = child
                piece = value[node]
                if piece >= 0:
                    to = end + 1
                    new = here + scores[piece]
                    if score[to] is None or new > score[to]:
                        score[to], back[to] = new, (at, piece)
                    covered = covered or to == at + width
                if not base[node]:
                    break
            if not covered:
                to, new = at + width, here + self.unknown
                if score[to] is None or new > score[to]:
                    score[to], back[to] = new, (at, -1)
            at += width
        out: list[int] = []
        while n:
            at, piece = back[n]
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(data[at:n]))
            else:
                out.append(self.unk)
            n = at
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text]))[0].tolist()

    def _runs(self, text: str) -> list[str]:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return _RUN.findall(((" " if self.prefix else "") + text).replace(" ", MARK)) if text else []

    def encode_all(self, texts: pa.Array, most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        if self.path not in _STORES:
            _STORES[self.path] = Store(most)
        self.store = _STORES[self.path]
        texts = pc.fill_null(texts, "")
        # elsewhere a run is a space's place and what follows up to the next space
        odd = pc.match_substring_regex(texts, f"^ |  | $|^$|{MARK}").to_numpy(zero_copy_only=False) | (self.squeeze or not self.prefix)
        lists = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        flat = lists.flatten()
        distinct = flat.dictionary_encode()
        names = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        odd_runs = {i: self._runs(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        more = list({r for runs in odd_runs.values() for r in runs})
        numbers = self.store.numbers([MARK + c if c else "" for c in names] + more, self._learn)
        first, end, ids = self.store.first, self.store.end, self.store.ids
        out, ends = take(ids, first[numbers], end[numbers], distinct.indices.to_numpy())
        n = per_list(lists, ends)
        if not odd_runs:
            return out, n
        place, own, parts, at = dict(zip(more, numbers[len(names) :].tolist())), n.copy(), [], 0
        starts = np.concatenate(([0], np.cumsum(n)))
        for i, runs in odd_runs.items():
            mine, _ = self.store.take(np.array([place[r] for r in runs], np.int64))
            parts += [out[at : starts[i]], mine]
            at, own[i] = starts[i], len(mine)
        return np.concatenate([*parts, out[at:]]), own

    def _learn(self, runs: list[str]) -> np.ndarray:
        found = [self.best(r) for r in runs]
        return self.store.add(runs, np.array([i for f in found for i in f], np.int32), np.cumsum([len(f) for f in found]))

    def decode_all(self, ids: np.ndarray, n: np.ndarray) -> pa.Array:
        """The text of each ``n`` ids of ``ids``."""
        if self.table is None:
            self.table, self.is_byte = pa.array(self.shown, pa.large_string()), np.zeros(len(self.shown), bool)
            self.is_byte[list(self.spelt)] = True
        ends = np.cumsum(n)
        cuts = np.concatenate(([0], ends))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), self.table.take(pa.array(ids, pa.int32()))), pa.scalar("", pa.large_string()))
        if self.prefix:
            joined = pc.if_else(pc.starts_with(joined, " "), pc.utf8_slice_codeunits(joined, 1), joined)
        spelt = np.concatenate(([0], np.cumsum(self.is_byte[ids])))
        which = np.flatnonzero(spelt[ends] > spelt[ends - n])
        if len(which):
            mask = np.zeros(len(n), bool)
            mask[which] = True
            joined = pc.replace_with_mask(joined, pa.array(mask), pa.array([self.decode(ids[cuts[i] : cuts[i + 1]].tolist()) for i in which.tolist()], pa.large_string()))
        return joined

    def decode(self, ids: list[int]) -> str:
        if self.spelt.keys().isdisjoint(ids):
            text = "".join([self.shown[i] for i in ids])
        else:
            parts, run = [], bytearray()
            for i in ids:
                byte = self.spelt.get(i)
                if byte is not None:
                    run.append(byte)
                    continue
                if run:
                    parts.append(run.decode("utf-8", "replace"))
                    run.clear()
                parts.append(self.shown[i])
            parts.append(run.decode("utf-8", "replace"))
            text = "".join(parts)
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    """The driver reads a model once; tasks get it as a broadcast, whose size is the vocabulary's."""
    return Model(path)


def _lists(ids: np.ndarray, n: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(ids, pa.int32()))


def _parts(array: pa.Array, most: int = 4 << 20) -> Iterator[pa.Array]:
    """A batch in slices of about ``most`` bytes, since the ids of whole batches of long texts take room; an empty batch gives one empty slice."""
    size = pc.binary_length(array) if pa.types.is_string(array.type) else pc.multiply(pc.list_value_length(array), 4)
    part = np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(array)]
    for a, b in zip(cuts, cuts[1:]):
        yield array.slice(a, b - a)


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with token_ids."""
    given = docs.sparkSession.sparkContext.broadcast(load(model))

    @F.arrow_udf("array<int>")
    def ids(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.concat_arrays([_lists(*given.value.encode_all(part)) for part in _parts(batch)])

    return docs.withColumn(free_name(docs, "token_ids"), ids(column(text).cast("string")))


def decode(docs: DataFrame, model: str, ids: str = "token_ids") -> DataFrame:
    """``docs`` with decoded, the text of the ids; null ids give an empty text."""
    given = docs.sparkSession.sparkContext.broadcast(load(model))

    @F.arrow_udf("string")
    def texts(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in lists:
            done = [given.value.decode_all(part.flatten().to_numpy(), pc.fill_null(part.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)) for part in _parts(batch)]
            yield pa.concat_arrays([d.cast(pa.string()) for d in done])

    return docs.withColumn(free_name(docs, "decoded"), texts(column(ids)))


def _exact(own: Model, texts: pa.Array, ids: np.ndarray, n: np.ndarray) -> pa.Array:
    same = pc.equal(own.decode_all(ids, n), pc.fill_null(texts, "").cast(pa.large_string()))
    pa.default_memory_pool().release_unused()
    return same


def encode_and_check(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with token_ids and exact (they decode to the text), in one pass: a second one would need as many workers again."""
    given = docs.sparkSession.sparkContext.broadcast(load(model))

    @F.arrow_udf("token_ids array<int>, exact boolean")
    def both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            done = []
            for part in _parts(batch):
                ids, n = given.value.encode_all(part)
                done.append(pa.StructArray.from_arrays([_lists(ids, n), _exact(given.value, part, ids, n)], ["token_ids", "exact"]))
            yield pa.concat_arrays(done)

    name, a, b = free_name(docs, "pieces"), free_name(docs, "token_ids"), free_name(docs, "exact")
    out = docs.withColumn(name, both(column(text).cast("string")))
    return out.select(*[column(c) for c in docs.columns], F.col(name)["token_ids"].alias(a), F.col(name)["exact"].alias(b))


def round_trip(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with pieces: a struct of n_tokens, n_byte_tokens, ids_crc32 and exact (the decoded text is the text), in one pass over the texts."""
    given = docs.sparkSession.sparkContext.broadcast(load(model))

    @F.arrow_udf("n_tokens bigint, n_byte_tokens bigint, ids_crc32 bigint, exact boolean")
    def measure(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            done = []
            for part in _parts(batch):
                ids, n = given.value.encode_all(part)
                exact = _exact(given.value, part, ids, n)
                ends, plain = np.cumsum(n), ids.astype("<u4")
                spelt = np.concatenate(([0], np.cumsum(given.value.is_byte[ids])))
                crc = [zlib.crc32(plain[a:b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
                columns = [pa.array(n, pa.int64()), pa.array(spelt[ends] - spelt[ends - n], pa.int64()), pa.array(crc, pa.int64()), exact]
                done.append(pa.StructArray.from_arrays(columns, ["n_tokens", "n_byte_tokens", "ids_crc32", "exact"]))
            yield pa.concat_arrays(done)

    return docs.withColumn(free_name(docs, "pieces"), measure(column(text).cast("string")))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), default_model())
    with small_batches(spark):
        return stored(found.select("doc_id", "pieces.*"))
