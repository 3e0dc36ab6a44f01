"""Byte-level BPE through a sentencepiece model written directly from a rank vocabulary.

Each byte stands for one private character, each vocabulary entry becomes a piece scored by its
negative rank, the normaliser is the identity. Pre-tokens are encoded one by one; decoding maps
ids back to bytes. Null and empty texts give no ids. Repeated rows are encoded alike; other
columns are kept or dropped by the caller.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Byte b is written as the character FIRST + b.
FIRST = 0x4E00
#: Pre-tokens remembered per worker.
CACHE_SIZE = 200_000
_workers: dict[str, "Encoder"] = {}


def read_ranks(path: str) -> list[bytes]:
    """Entries of a vocabulary file in rank order: base64 entry, space, rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(entry)) for entry, rank in pairs)
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [entry for _, entry in ranked]


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: message or text, varint, or float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def to_characters(data: bytes) -> str:
    return "".join([chr(FIRST + b) for b in data])


def serialise_model(entries: list[bytes]) -> bytes:
    """The model file: piece id = rank, the unknown piece after the last rank."""
    pieces = [
        _field(1, _field(1, to_characters(entry).encode()) + _field(2, float(-rank)) + _field(3, 1))
        for rank, entry in enumerate(entries)
    ]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(entries) + 1) + _field(40, len(entries))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Encoder:
    """Encodes and decodes in one process."""

    def __init__(self, model: bytes, entries: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.entries = entries
        self.whole = {entry: rank for rank, entry in enumerate(entries)}
        self.known: dict[str, list[int]] = {}
        self.pieces: dict[str, tuple[bytes, int, bytes]] = {}

    def encode(self, text: str) -> list[int]:
        known, ids = self.known, []
        for token in self.split(text):
            found = known.get(token)
            if found is None:
                data = token.encode("utf-8", "surrogatepass")
                rank = self.whole.get(data)
                found = [rank] if rank is not None else self.model.encode(to_characters(data))
                if len(known) >= CACHE_SIZE:
                    known.clear()
                known[token] = found
            ids += found
        return ids

    def piece(self, token: str) -> tuple[bytes, int, bytes]:
        """Of a pre-token: its ids as text, their number, and the bytes that the ids decode to."""
        data = token.encode("utf-8", "surrogatepass")
        rank = self.whole.get(data)
        ids = [rank] if rank is not None else self.model.encode(to_characters(data))
        return ",".join(map(str, ids)).encode(), len(ids), self.decode(ids)

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids joined by commas and of the bytes that they decode to."""
        pieces, tokens = self.pieces, self.split(text)
        if len(pieces) > CACHE_SIZE:
            pieces.clear()
        for token in set(tokens).difference(pieces):
            pieces[token] = self.piece(token)
        texts, counts, decoded = zip(*map(pieces.__getitem__, tokens)) if tokens else ((), (), ())
        ids = hashlib.sha256(b",".join(texts)).hexdigest()
        return sum(counts), ids, hashlib.sha256(b"".join(decoded)).hexdigest()

    def decode(self, ids: list[int]) -> bytes:
        entries = self.entries
        return b"".join([entries[i] for i in ids])


def _worker(shared) -> Encoder:
    model, entries, pattern = shared.value
    key = f"{hash(model)} {pattern}"
    if key not in _workers:
        _workers[key] = Encoder(model, entries, pattern)
    return _workers[key]


def _shared(spark: SparkSession, path: str, pattern: str):
    """The vocabulary is a file of fixed size, read once by the driver."""
    entries = read_ranks(path)
    return spark.sparkContext.broadcast((serialise_model(entries), entries, pattern))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with an array of token ids for every whole text."""
    shared = _shared(df.sparkSession, path, pattern)

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        encoder = _worker(shared)
        return pd.Series([encoder.encode(t) if t else [] for t in texts], dtype=object)

    return df.withColumn(ids, run(F.col(text)))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the ids stand for; null ids give no bytes."""
    shared = _shared(df.sparkSession, path, pattern)

    @F.pandas_udf("binary")
    def run(rows: pd.Series) -> pd.Series:
        encoder = _worker(shared)
        return pd.Series([b"" if r is None else encoder.decode(list(r)) for r in rows], dtype=object)

    return df.withColumn(out, run(F.col(ids)))


def digests(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "digests") -> DataFrame:
    """``df`` with n_tokens, ids_sha256 and decoded_sha256 of every whole text: what encoding it and decoding the ids
    gives, without handing the ids on. Pre-tokens and what their ids decode to are remembered."""
    shared = _shared(df.sparkSession, path, pattern)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(texts: pd.Series) -> pd.DataFrame:
        encoder = _worker(shared)
        rows = [encoder.digests(t or "") for t in texts]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return df.withColumn(out, run(F.col(text)))


def ids_digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256)
