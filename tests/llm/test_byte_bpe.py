"""Byte-level BPE against the library, by whole texts and by chunks."""

import base64
import hashlib
import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest

from clipspans.llm import byte_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["a", "b", " ", "  ", "\n", "'s", "'re", "'", "é", "漢", "字", "1", "23", ".", ",", "\t", " ", "　", "\x1c", "\x85", " x", "don't", "𝒳", "ʼ", "՘", "֐0x", "࢏", "🙂", "lll", "Ω", "\x00"]


@lru_cache(maxsize=1)
def library():
    import tiktoken

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def own():
    return byte_bpe.Encoder(byte_bpe.read_ranks(PATH), PATTERN, most=5000)


def test_texts_equal_the_library():
    r = random.Random(1)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 30))) for _ in range(6000)] + [None, ""]
    for at in range(0, len(texts), 700):  # the store is emptied several times
        some = texts[at : at + 700]
        ids, n = own().encode_all(pa.array(some, pa.string()))
        cuts = np.concatenate(([0], np.cumsum(n)))
        assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [library().encode_ordinary(t or "") for t in some]
        assert own().decode_all(ids, n).to_pylist() == [(t or "").encode() for t in some]


def test_newer_letters():
    """Letters of newer Unicode versions are signs to the library."""
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}!" for c in range(0x530, 0x1200, 7)] + [f"x{chr(c)}1" for c in range(0x10000, 0x33500, 61)]
    assert [own().ids(t).tolist() for t in texts] == [library().encode_ordinary(t) for t in texts]


def plain_merge(piece):
    """The pair of least rank, the leftmost first, until none is left."""
    ranks, parts = own().ranks, [bytes([b]) for b in piece]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_merges_of_long_and_short_pieces():
    r = random.Random(2)
    for n in [2, 5, 20, 99, 100, 101, 102, 300, 600]:
        for letters in ("ab", "abcdefgh'é", "-", "漢字"):
            piece = "".join(r.choice(letters) for _ in range(n)).encode()
            assert own().merge(piece) == plain_merge(piece)


@pytest.mark.parametrize("overlap", [4, 8, 12])
def test_chunks_equal_whole_texts(overlap):
    """Any chunks stitch to the ids of the whole text, also where pre-tokens are longer than an overlap or several chunks."""
    r, size, many = random.Random(overlap), 20, 0
    for k in range(600):
        parts = PARTS if k % 2 else ["a", "b", "é", "x", "xy", ". ", "'re", "  "]
        text = "".join(r.choice(parts) for _ in range(r.randint(20, 200)))
        if k % 3 == 0:
            text = text.replace(" ", "")
        if len(text) <= size + overlap:
            continue
        cut = [text[a : a + size + overlap] for a in range(0, len(text) - overlap, size)]
        stitch = byte_bpe.Stitch(own(), size, overlap)
        for i, c in enumerate(cut):
            stitch.add(byte_bpe.split_chunk(own(), c, i == len(cut) - 1, size, overlap))
        many += len(cut) > 2
        assert stitch.end().tolist() == library().encode_ordinary(text), ascii(text)
    assert many > 300


def test_encode_and_decode_tables(spark):
    """Rows of any kind through Spark, chunked or not, with null and repeated ids, odd names, and one text in half of all rows."""
    long = "word, don't  stop\n" * 5000 + "x" * 3000 + " " * 3000 + "漢" * 3000
    texts = [None, "", " ", "a", long, long, "tail " * 900] + ["the same text " * 40] * 8
    rows = [(None if i % 4 == 0 else i % 5, t, f"c{i}", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `odd``name` string, found int")
    out = byte_bpe.encode(docs, PATH, PATTERN, chunk=2000, overlap=64)
    assert out.columns == ["doc_id", "odd`name", "found", "token_ids"]
    got = {r["found"]: r for r in byte_bpe.decode(out, PATH).collect()}
    assert len(got) == len(rows)
    for id, text, name, i in rows:
        assert (got[i]["doc_id"], got[i]["odd`name"]) == (id, name)
        assert got[i]["token_ids"] == library().encode_ordinary(text or "") and bytes(got[i]["decoded"]) == (text or "").encode()
    assert byte_bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_query_equals_the_library(spark, tmp_path):
    r = random.Random(9)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 300))) for _ in range(50)] + [None, "many words " * 30_000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for row in byte_bpe.op12_byte_bpe(spark, str(tmp_path)).collect():
        text = texts[row.doc_id] or ""
        ids = library().encode_ordinary(text)
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
