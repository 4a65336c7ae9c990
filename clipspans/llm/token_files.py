"""Token-id files: texts tokenized, coded by the range coder, written in id order, and read back.

Documents are range-partitioned and sorted by id. A task tokenizes about ``TOGETHER`` bytes of text at a time (the last time up to half as many
more, as a short segment takes as many steps as a long one) and codes their ids as one segment: a stream of whole documents, cut into blocks of ``range_coder.BLOCK`` ids. A segment is one row of a
Parquet file in the shared folder: its place (part, seq), its documents and their lengths, and its coded blocks. Spark's
writer commits files whole, so a lost executor leaves none half-written. The parts' totals, one number per partition,
give every document its place in the whole stream.

Defined results: null texts are empty; every document gets the end id, so none is without ids; null ids come first; rows
with equal ids are ordered by a hash of the text; an empty table writes no segments. Other columns are left out.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipspans.llm import range_coder
from clipspans.llm.common import column, shared_dir, small_batches, table
from clipspans.llm.pieces import Store, per_list, take

TOGETHER = 10 << 20
#: Blocks that are coded side by side.
LANES = 32
END = 1
FILE = "part int, seq int, ids array<bigint>, lengths array<int>, n bigint, blocks array<binary>"
_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("n", pa.int64()), ("blocks", pa.list_(pa.binary()))])
#: The vocabulary's splitter never joins what blanks part, nor, among these characters, a letter with a digit or a sign; digits
#: stand alone. A run with any other character, an apostrophe or a bar (they can belong to longer units) is left to the library.
_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_PIECE = re.compile(rf"[{_LETTER}]+|[0-9]|[^{_LETTER}0-9 \t\n\r]+")
_ODD = re.compile("['|\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xbf×÷İ]|[^\x00-ɏ]")
_ONE_PIECE = re.compile("[a-zß-öø-ÿ]+").fullmatch
_ODD_ARROW = r"['|\x00-\x08\x0b\x0c\x0e-\x1f\x{7f}-\x{bf}×÷İ]|[^\x00-\x{24f}]"
#: All signs that other runs can have; the last run of them in a chunk is a piece.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~"
_WORD_END = "</w>"


class PieceTokens:
    """Ids of texts. What stands between blanks (a chunk) has ids of its own, wherever it stands, and so has a piece of it. Chunks of
    many texts are made distinct first, then lower-cased and freed of a last sign, and made distinct again. The library encodes
    each piece that is new; the word-end ids part the pieces again. What has been met is kept, up to a fixed number, for all
    tasks of a worker."""

    def __init__(self, path: str, most: int = 1_200_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.store = Tokenizer.from_file(path), Store(most)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_WORD_END)]] = True
        #: whether pieces stand alone; other vocabularies encode whole texts
        self.parted = bool(self.ends.any()) and '"Lowercase"' in self.tokenizer.to_str()
        if self.parted:  # plain pieces need no normalizer, and are split at spaces after their bytes became letters
            self.plain = Tokenizer(self.tokenizer.model)
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False), pre_tokenizers.Split("Ġ", "removed")])

    def _whole(self, names: list[str]) -> np.ndarray:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(names, add_special_tokens=False)]
        return self.store.add(names, np.array([i for e in found for i in e], np.int32), np.cumsum([len(e) for e in found]))

    def _pieces(self, pieces: list[str]) -> None:
        known = self.store.known
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        for at in range(0, len(new), 1000):
            some = new[at : at + 1000]
            ids = np.array(self.plain.encode(" ".join(some), add_special_tokens=False).ids, np.int32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(some) and cuts[-1] == len(ids):
                self.store.add(some, ids, cuts, longest=1 << 30)
            else:  # a piece without a word end
                found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                self.store.add(some, np.array([i for e in found for i in e], np.int32), np.cumsum([len(e) for e in found]), longest=1 << 30)

    def _learn(self, stems: list[str]) -> np.ndarray:
        number, several, odd = np.zeros(len(stems), np.int64), [], []
        for i, c in enumerate(stems):
            if not _ONE_PIECE(c):
                (odd if _ODD.search(c) else several).append(i)
        split = [_PIECE.findall(stems[i].lower()) for i in several]  # the vocabulary is lower case; these characters have one lower-case form
        one = np.ones(len(stems), bool)
        one[several + odd] = False
        single = np.flatnonzero(one)
        names = [stems[i] for i in single.tolist()]
        self._pieces(names + [p for s in split for p in s])
        known = self.store.known
        number[single] = [known[c] for c in names]
        if several:
            ids, ends = self.store.take(np.array([known[p] for s in split for p in s], np.int64))
            number[several] = self.store.add([stems[i] for i in several], ids, ends[np.cumsum([len(s) for s in split]) - 1])
        if odd:
            number[odd] = self._whole([stems[i] for i in odd])
        return number

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        texts = pc.fill_null(texts, "")
        if not self.parted:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for e in found for i in e], np.int32), np.array([len(e) for e in found], np.int64)
        lists = pc.ascii_split_whitespace(texts)
        distinct = lists.flatten().dictionary_encode()
        chunks = distinct.dictionary
        if not len(chunks):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        odd = pc.match_substring_regex(chunks, _ODD_ARROW)
        short = pc.utf8_rtrim(chunks, characters=_SIGNS)
        size = pc.binary_length(chunks).to_numpy()
        signed = (size - pc.binary_length(short).to_numpy() == 1) & (size > 1) & ~odd.to_numpy(zero_copy_only=False)
        stems = pc.if_else(odd, chunks, pc.utf8_lower(pc.if_else(pa.array(signed), short, chunks))).dictionary_encode()
        # the signs come last, so that all numbers are from after the last time that the store was emptied
        numbers = self.store.numbers(stems.dictionary.to_numpy(zero_copy_only=False).tolist() + list(_SIGNS), self._learn)
        signs = np.zeros(256, np.int64)
        signs[np.frombuffer(_SIGNS.encode(), np.uint8)] = numbers[-len(_SIGNS) :]
        last = np.frombuffer(chunks.buffers()[2], np.uint8)[np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset + 1 : chunks.offset + 1 + len(chunks)] - 1]
        # the ids of each distinct chunk, then those of every chunk
        own, ends = self.store.take(np.column_stack((numbers[stems.indices.to_numpy()], np.where(signed, signs[last], 0))).reshape(-1))
        ids, ends = take(own, np.concatenate(([0], ends[1:-1:2])), ends[1::2], distinct.indices.to_numpy())
        return ids, per_list(lists, ends)


_TOKENS: dict[str, PieceTokens] = {}


def tokens_of(path: str) -> PieceTokens:
    """One for each vocabulary of a worker process."""
    if path not in _TOKENS:
        _TOKENS[path] = PieceTokens(path)
    return _TOKENS[path]


def side_by_side(blocks: list) -> list[list]:
    """Blocks in the fewest groups of at most LANES, of nearly equal sizes."""
    groups = -(-len(blocks) // LANES)
    cuts = [len(blocks) * i // groups for i in range(groups + 1)] if groups else [0]
    return [blocks[a:b] for a, b in zip(cuts, cuts[1:])]


def write(docs: DataFrame, path: str, tokenizer: str, text: str = "text", id: str = "doc_id", end: int = END) -> None:
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = docs.select(column(id).cast("bigint").alias("id"), F.coalesce(column(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, seq = tokens_of(tokenizer), TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []

        def out() -> pa.RecordBatch:
            ids, n = tokens(pa.chunked_array([b.column("text") for b in waiting]).combine_chunks())
            own = pa.chunked_array([b.column("id") for b in waiting]).to_pylist()
            stream = np.insert(ids, np.cumsum(n), end)
            cuts = [stream[i : i + range_coder.BLOCK] for i in range(0, len(stream), range_coder.BLOCK)]
            blocks = [b for some in side_by_side(cuts) for b in range_coder.encode(some)]
            pa.default_memory_pool().release_unused()
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "ids": [own], "lengths": [(n + 1).tolist()], "n": [len(stream)], "blocks": [blocks]}, schema=_ARROW)

        later: list[pa.RecordBatch] = []
        size = more = 0
        for batch in batches:
            if size < TOGETHER:
                waiting.append(batch)
                size += batch.nbytes
                continue
            later.append(batch)
            more += batch.nbytes
            if more >= TOGETHER // 2:  # enough for a segment of its own
                yield out()
                waiting, later, seq, size, more = later, [], seq + 1, more, 0
        waiting += later
        if waiting:
            yield out()

    with small_batches(spark):
        rows.select("id", "text").mapInArrow(code, FILE).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, tokens) of every document, tokens as the array of its ids."""
    return _read(spark, path, "tokens array<int>", lambda ids: ids.astype(np.int32))


def _read(spark: SparkSession, path: str, column: str, of) -> DataFrame:
    rows = spark.read.schema(FILE).parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n").alias("n"))  # a row per partition
    first = totals.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")).alias("first"))
    places = rows.select("part", "seq", "n").join(F.broadcast(first), "part")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    places = places.select("part", "seq", (F.col("first") + before).alias("start"))
    kind = pa.list_(pa.int32()) if column.endswith("array<int>") else pa.int64()
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64()), (column.split()[0], kind)])

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                stream = np.concatenate([b for some in side_by_side(row["blocks"]) for b in range_coder.decode(some)])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                got = [of(stream[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, ([row["part"]] * len(got), [row["seq"]] * len(got), row["ids"], starts, row["lengths"], got))), schema=schema)

    found = rows.mapInArrow(restore, f"part int, seq int, id bigint, offset bigint, n_tokens bigint, {column}")
    return found.join(places, ["part", "seq"]).select("id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", column.split()[0])


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_dir(spark)
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return _read(spark, path, "ids_crc32 bigint", lambda ids: zlib.crc32(ids.tobytes())).withColumnRenamed("id", "doc_id")
