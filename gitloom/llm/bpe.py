"""Byte-level BPE with a local rank file: encoding and decoding in Arrow batches."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gitloom.llm.common import extended, small_batches, with_columns, without

#: Texts above this many characters are encoded piece by piece.
PIECE_CHARS = 1 << 16
#: In those texts, runs of so many characters of white space never reach the pattern: it looks
#: back over a run, and ends the process on one of about a million.
SPACE_CHARS = 1 << 12

# What the pattern's engine takes for white space.
_LONG_SPACE = re.compile(
    "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % SPACE_CHARS
)


def load_encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file (a base64 token and its rank in each line)."""
    ranks = {}
    with open(rank_file, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text where no match of the pattern can lie across, about every ``limit`` characters.

    Such a place is before a space or line feed that follows a character other than white
    space: in the pattern white space only starts a match or is all of it, and the one
    look-ahead, after white space, sees no cut. Texts without such a place stay whole.
    """
    start, end = 0, len(text)
    while end - start > limit:
        at = start + limit
        while at < end and not (text[at] in " \n" and not text[at - 1].isspace()):
            at += 1
        yield text[start:at]
        start = at
    if start < end:
        yield text[start:]


def encode_text(encoding: tiktoken.Encoding, text: str, limit: int = PIECE_CHARS) -> np.ndarray:
    """The ids of a text of any length.

    In the pattern a run of white space is one match but for its last character, which goes
    with what follows; at the end of the text it is one match. Such a match is encoded as a
    piece of its own, and the text before and after it as usual.
    """
    if len(text) <= limit:
        return np.array(encoding.encode_ordinary(text), np.int32)
    found, start = [], 0
    for run in _LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        found += [encoding.encode_ordinary(p) for p in pieces(text[start : run.start()], limit)]
        found.append(encoding._encode_single_piece(text[run.start() : end]))
        start = end
    found += [encoding.encode_ordinary(p) for p in pieces(text[start:], limit)]
    return np.concatenate([np.array(ids, np.int32) for ids in found])


def encode(
    df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "token_ids"
) -> DataFrame:
    """Add ``ids``, the array of token ids of the whole text.

    Special tokens are ordinary text. Null and empty texts give an empty array; other
    columns, nulls and repeated rows pass unchanged; a column named ``ids`` is replaced.
    """
    source = without(df, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_file, pattern)
        for batch in small_batches(batches, text):
            found = [encode_text(encoding, t or "") for t in batch.column(text).to_pylist()]
            offsets = np.cumsum([0, *map(len, found)], dtype=np.int64).astype(np.int32)
            values = np.concatenate(found) if found else np.array([], np.int32)
            array = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
            yield with_columns(batch, **{ids: array})

    return source.mapInArrow(run, extended(source.schema, **{ids: T.ArrayType(T.IntegerType())}))


def decode(
    df: DataFrame, rank_file: str, pattern: str, ids: str = "token_ids", out: str = "decoded"
) -> DataFrame:
    """Add ``out``, the raw bytes of the ids (null ids: empty). An unknown id is an error."""
    source = without(df, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_file, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                raw = [encoding.decode_bytes(x or []) for x in part.column(ids).to_pylist()]
                yield with_columns(part, **{out: pa.array(raw, pa.binary())})

    return source.mapInArrow(run, extended(source.schema, **{out: T.BinaryType()}))


def token_digests(df: DataFrame, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded and decoded rows."""
    return df.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " ").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )
