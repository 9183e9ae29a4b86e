"""Byte-level BPE with the tiktoken library and a local rank file: texts to ids and ids to raw bytes.

The rank file's path is a parameter; the file lies at that path on every executor. Long texts are cut where
the pattern starts a new match whatever stands around: before a single space between two characters that
are no white space. A stretch without such a place is matched by the `regex` library and each match encoded
alone, so a text of any length takes memory and time in proportion.

Tasks hand on SLICE rows at a time, so a batch is never held with its ids and its bytes as well.

Defined results: a null or empty text has no ids and decodes to no bytes. Repeated rows are encoded each. An
empty table gives no rows. Of other columns only `keep` is passed on.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from mentidero.llm.common import give_back

# Code points per piece handed to the library, and per stretch that it matches by itself.
PIECE, STRETCH = 50_000, 100_000
SLICE = 64  # rows of a batch whose results are held
SAFE = regex.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def load_encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(ranks_path: str, pattern: str) -> dict[int, bytes]:
    encoding = load_encoding(ranks_path, pattern)
    return {rank: token for token, rank in encoding._mergeable_ranks.items()}


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about `size`, cut at safe places only."""
    start = 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(encoding: tiktoken.Encoding, text: str, stretch: int = STRETCH) -> list[int]:
    if len(text) <= PIECE:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for piece in pieces(text):
        if len(piece) <= stretch:
            ids += encoding.encode_ordinary(piece)
        else:
            for match in regex.finditer(encoding._pat_str, piece):
                ids += encoding._encode_single_piece(match.group())
    return ids


def _keep_fields(df: DataFrame, keep: list[str]) -> list[StructField]:
    return [df.schema[name] for name in keep]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, SLICE):
            yield whole.slice(begin, SLICE)
        give_back()


def _encoded(encoding: tiktoken.Encoding, texts: pa.Array) -> tuple[list[int], list[bytes]]:
    """Numbers of ids, and the ids."""
    counts, packed = [], []
    for value in texts:
        ids = encode_text(encoding, value.as_py() or "")
        counts.append(len(ids))
        packed.append(np.array(ids, dtype="<u4").tobytes())
    return counts, packed


def _decoded(known: dict[int, bytes], packed: Iterable[bytes | None]) -> list[bytes]:
    return [b"".join(map(known.__getitem__, np.frombuffer(ids or b"", "<u4").tolist())) for ids in packed]


ENCODED = [StructField("n_tokens", LongType()), StructField("ids", BinaryType())]
DECODED = [StructField("decoded", BinaryType())]


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, then n_tokens and `ids`: the ids as little-endian unsigned 32-bit integers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(ranks_path, pattern)
        for batch in _slices(batches):
            counts, packed = _encoded(encoding, batch.column(len(keep)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                names=[*keep, "n_tokens", "ids"],
            )

    return df.select(*keep, df[text].cast("string")).mapInArrow(encode, StructType(_keep_fields(df, keep) + ENCODED))


def decode_documents(df: DataFrame, ranks_path: str, pattern: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """Columns `keep`, then `decoded`: the raw bytes, which need not be valid UTF-8 for arbitrary ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = token_bytes(ranks_path, pattern)
        for batch in _slices(batches):
            decoded = _decoded(known, batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(decoded, pa.binary())], names=[*keep, "decoded"]
            )

    return df.select(*keep, ids).mapInArrow(decode, StructType(_keep_fields(df, keep) + DECODED))


def encode_and_decode(df: DataFrame, ranks_path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, n_tokens, `ids`, and `decoded` from these ids: as the two above in turn, but in one worker
    a task, which loads the ranks once."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, known = load_encoding(ranks_path, pattern), token_bytes(ranks_path, pattern)
        for batch in _slices(batches):
            counts, packed = _encoded(encoding, batch.column(len(keep)))
            new = [pa.array(counts, pa.int64()), pa.array(packed, pa.binary()), pa.array(_decoded(known, packed), pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *new], names=[*keep, "n_tokens", "ids", "decoded"])

    return df.select(*keep, df[text].cast("string")).mapInArrow(both, StructType(_keep_fields(df, keep) + ENCODED + DECODED))
