import base64
import hashlib
from functools import lru_cache

import public_tokenizers
import pytest
import regex

from gitloom.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = [
    "plain words, it's 42!", "", None, "  two  spaces \n\n lines\t", "日本語 é ñ 🙂 a b", "<|endoftext|>",
    "word " * 9000, "x" * 3000, "a\x1cb  c", "\n" * 500, "tail   ",
]


def test_ids_equal_the_library_and_decode_to_the_text(spark):
    encoding = bpe.load_encoding(RANKS, PATTERN)
    rows = [(i, t, "clash", [i]) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offsets string, Token_IDs array<int>")
    encoded = bpe.encode(docs, RANKS, PATTERN)
    decoded = bpe.decode(encoded, RANKS, PATTERN)
    for r in decoded.collect():
        ids = encoding.encode_ordinary(r["text"] or "")
        assert list(r["token_ids"]) == ids
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    for r in bpe.token_digests(decoded).collect():
        ids = encoding.encode_ordinary(TEXTS[r["doc_id"]] or "")
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["n_tokens"] == len(ids)
    assert bpe.encode(docs.limit(0), RANKS, PATTERN).count() == 0


@pytest.mark.parametrize("limit", [1, 2, 7, 64])
def test_cuts_do_not_change_the_ids(limit):
    encoding = bpe.load_encoding(RANKS, PATTERN)
    for text in TEXTS:
        text = (text or "")[:3000]
        assert "".join(bpe.pieces(text, limit)) == text
        assert bpe.encode_text(encoding, text, limit).tolist() == encoding.encode_ordinary(text)


@lru_cache
def _ranks():
    with open(RANKS, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


@lru_cache(1 << 16)
def merged(piece):
    """The lowest-ranked neighbours of a piece become one, the leftmost first, until none can."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(_ranks().get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        rank, i = min(pairs, default=(1 << 30, 0))
        if rank == 1 << 30:
            return [_ranks()[p] for p in parts]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_ids_equal_a_plain_merge_loop(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(TEXTS) if t is None or len(t) < 2000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: list(r["token_ids"]) for r in bpe.encode(docs, RANKS, PATTERN).collect()}
    for i, text in rows:
        assert got[i] == [t for m in regex.findall(PATTERN, text or "") for t in merged(m.encode())], i


@pytest.mark.parametrize("run", [" ", "\n", " \n\t", "\u3000 ", "\x85"])
def test_long_runs_of_white_space(run):
    encoding = bpe.load_encoding(RANKS, PATTERN)
    long = run * (2_000_000 // len(run))
    alone = encoding._encode_single_piece(long)
    assert bpe.encode_text(encoding, long).tolist() == alone
    assert encoding.decode_bytes(alone) == long.encode()
    inside = bpe.encode_text(encoding, "some words" + long + "and more").tolist()
    parts = ["some words", long[:-1], long[-1] + "and more"]
    expected = [t for p in parts for t in (encoding._encode_single_piece(p) if p == long[:-1] else encoding.encode_ordinary(p))]
    assert inside == expected and encoding.decode_bytes(inside).decode() == "".join(["some words", long, "and more"])
    # Where the library can answer by itself, runs about the bound give its ids.
    for n in (bpe.SPACE_CHARS - 1, bpe.SPACE_CHARS, bpe.SPACE_CHARS + 1, 9000):
        for text in ("a b" + run * n + "c" + run * n, run * n + " x", "d" + run * n + "'s"):
            assert bpe.encode_text(encoding, text, 100).tolist() == encoding.encode_ordinary(text)


def test_query_takes_long_white_space(spark):
    rows = [(1, " " * 1_500_000), (2, "a" + "\n" * 1_500_000 + "b"), (3, "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    decoded = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    for r in bpe.token_digests(decoded).collect():
        assert r["decoded_sha256"] == hashlib.sha256(dict(rows)[r["doc_id"]].encode()).hexdigest()
