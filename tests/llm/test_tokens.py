"""BPE, token files and token counts against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from voltlake.llm import bpe, huffman, token_counts, token_files
from voltlake.llm.queries import QUERIES, tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


PIECES = [
    ["a", "b", "the", "'s", "'re", "'", "  ", "\n", "\n\n", " ", "é", "中", "123", "²", "!!", "<|endoftext|>"]
    + ["<|endof", "text|>", "　", "\xa0", "aaaaaaaa", "🙂", "\x85", "\x1c"],
    ["a", "b"], ["中", "文"], ["a"], ["1", "2"], [" ", "\n"], ["'", "s", "!"],
]


def test_joined_halves_are_exact(library):
    rng = random.Random(7)
    own = bpe.codec(tokenizer())
    for _ in range(1500):
        text = "".join(rng.choices(rng.choice(PIECES), k=rng.randint(0, 120)))
        ids = own.encode(text, leaf_chars=rng.choice([3, 8, 17])).tolist()
        assert ids == ids_of(library, text), repr(text)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_op1_against_library(spark, sf, plain, library):
    got = {r["doc_id"]: r for r in QUERIES["op1_bpe"](spark, sf).collect()}
    assert got.keys() == {i for i, _ in plain}
    for doc_id, text in plain:
        ids = ids_of(library, text)
        assert got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("spread", [bpe.SPREAD_CHARS, 50])
def test_awkward_rows_round_trip(awkward, library, spread):
    encoded = bpe.encode(awkward, tokenizer(), leaf_chars=20 if spread == 50 else bpe.LEAF_CHARS, spread_chars=spread)
    got = bpe.decode(encoded, tokenizer()).collect()
    want = [(r["doc_id"], ids_of(library, r["text"]), r["text"] or "") for r in awkward.collect()]
    assert sorted(((r["doc_id"], list(r["ids"]), r["decoded"]) for r in got), key=repr) == sorted(want, key=repr)


def test_empty_tables(nothing):
    assert bpe.decode(bpe.encode(nothing, tokenizer()), tokenizer()).isEmpty()
    assert token_files.token_files(nothing, tokenizer()).isEmpty()
    assert token_counts.token_counts(nothing, tokenizer()).isEmpty()


@pytest.mark.parametrize("symbols, limit", [(1, 18), (2, 18), (5, 3), (1000, 12), (50257, 18)])
def test_huffman_round_trip(symbols, limit):
    rng = np.random.default_rng(symbols)
    counts = np.minimum(rng.zipf(1.3, symbols), 10**9)
    lengths = huffman.code_lengths(counts, limit)
    assert lengths.max() <= limit and sum(2.0 ** -int(x) for x in lengths if x) <= 1
    ids = rng.choice(symbols, 5000, p=counts / counts.sum()).astype(np.uint32)
    bits, checkpoints = huffman.pack(ids, huffman.canonical_codes(lengths), lengths)
    assert (huffman.unpack(bits, len(ids), checkpoints, huffman.decoding_table(lengths)) == ids).all()


def test_unlimited_lengths_are_those_of_huffman():
    import heapq

    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34])
    heap = [(int(c), [i]) for i, c in enumerate(counts)]
    depth = np.zeros(len(counts), dtype=int)
    while len(heap) > 1:
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        depth[x + y] += 1
        heapq.heappush(heap, (a + b, x + y))
    assert (huffman.code_lengths(counts) * counts).sum() == (depth * counts).sum()


def test_op3_against_library(spark, sf, plain, library):
    start, want = 0, []
    for doc_id, text in sorted(plain):
        ids = np.array([*ids_of(library, text), 0], dtype="<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op3_token_files"](spark, sf).collect())) == want


def test_documents_longer_than_blocks(awkward, spark, library, tmp_path):
    token_files.write_files(awkward, str(tmp_path / "t"), tokenizer(), block=40)
    got = token_files.read_files(spark, str(tmp_path / "t")).collect()
    texts = {}
    for r in sorted(got, key=lambda r: r["start"]):
        texts.setdefault(r["doc_id"], []).append(np.frombuffer(r["ids"], "<u4").tolist())
    want = {}
    for r in awkward.collect():
        want.setdefault(r["doc_id"], []).append([*ids_of(library, r["text"]), 0])
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}
    ends = sorted((r["start"], len(r["ids"]) // 4) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:], strict=False)) and ends[0][0] == 0


@pytest.mark.parametrize("block", [token_counts.BLOCK_TOKENS, 7])
def test_token_counts(awkward, library, block):
    library.encode_special_tokens = True  # strings of special tokens are plain text here
    try:
        want = sorted(((r["doc_id"], len(ids_of(library, r["text"]))) for r in awkward.collect()), key=repr)
    finally:
        library.encode_special_tokens = False
    got = token_counts.token_counts(awkward, tokenizer(), block_tokens=block).collect()
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=repr) == want
    for file in {r["file"] for r in got}:
        spans = sorted((r["start"], r["n_tokens"]) for r in got if r["file"] == file)
        assert all(a + n + 1 == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))


def test_op7_counts_every_document(spark, sf, plain, library):
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op7_token_counts"](spark, sf).collect()}
    assert got == {i: len(ids_of(library, t)) for i, t in plain}
