"""Byte-level BPE by a sentencepiece model that is written here from the ranks.

The vocabulary is a file of ranks (base64 token, rank).  Each byte is mapped
to one printable character, so that every token is a piece of such
characters; its score is minus its rank, so the merge with the lowest rank
comes first.  Normalisation is the identity.  Pre-tokens (matches of the
pattern) are encoded one by one; a pre-token that is itself a token is taken
whole, as rank-file encoders do, since its merges need not lead to it.
Decoding maps ids back to their bytes.

Defined results: a null or empty text has no ids and decodes to no bytes;
rows are kept one for one, repeated rows alike; an id that is not in the
vocabulary fails; of the input's columns only the id comes back, whatever the
others are called (``encode`` and ``decode`` add a column to any table).
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import common

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Pre-tokens whose ids a task remembers.
REMEMBERED = 200_000
_UNKNOWN = "⁇"


def byte_characters() -> list[str]:
    """One printable character for each byte: itself where it is printable, else from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank; ranks must run from 0 without a gap."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in (line.split() for line in f if line.strip()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"{path}: ranks are not 0..{len(pairs) - 1}")
    return [t for _, t in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | bytes | float) -> bytes:
    """A protocol-buffer field: varint, length-delimited or 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value))


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece model file: piece i is token i, the unknown piece comes last."""
    chars = byte_characters()
    normal, unknown = 1, 2
    out = [_field(1, _field(1, "".join(chars[b] for b in token).encode()) + _field(2, -float(rank)) + _field(3, normal))
           for rank, token in enumerate(tokens)]
    out.append(_field(1, _field(1, _UNKNOWN.encode()) + _field(2, 0.0) + _field(3, unknown)))
    bpe = 2
    minus_one = (1 << 64) - 1
    trainer = _field(3, bpe) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + b"".join(_field(k, minus_one) for k in (41, 42, 43)) + _field(45, _UNKNOWN.encode())
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encoder and decoder of one vocabulary, within a task."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        self.tokens = read_ranks(path)
        self.whole = {t: i for i, t in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.characters = {b: c for b, c in enumerate(byte_characters())}
        self.pretokens = regex.compile(pattern).findall
        self.table = np.array(self.tokens, dtype=object)
        self.known: dict[str, bytes] = {}

    def pieces(self, pretokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pretokens]
        out = [[self.whole[r]] if r in self.whole else None for r in raw]
        rest = [i for i, x in enumerate(out) if x is None]
        if rest:
            mapped = [raw[i].decode("latin-1").translate(self.characters) for i in rest]
            for i, ids in zip(rest, self.model.encode(mapped, out_type=int, num_threads=1), strict=True):
                if len(self.tokens) in ids:
                    raise ValueError("the vocabulary lacks a byte of the text")
                out[i] = ids
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        found = self.pretokens(text)
        known = self.known
        if new := list({p for p in found if p not in known}):
            if len(known) + len(new) > REMEMBERED:
                known = self.known = {}
                new = list(set(found))
            for p, ids in zip(new, self.pieces(new), strict=True):
                known[p] = struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(known.__getitem__, found))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.table[np.frombuffer(ids, "<u4")].tolist())


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec a worker, kept between its tasks."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode(text: Column, path: str = VOCABULARY, pattern: str = PATTERN) -> Column:
    """Ids of each text as packed little-endian unsigned 32-bit integers (binary)."""

    @F.pandas_udf("binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, pattern)
        for s in parts:
            yield pd.Series([c.encode(t or "") for t in s], dtype=object)

    return run(text)


def decode(ids: Column, path: str = VOCABULARY, pattern: str = PATTERN) -> Column:
    """The bytes that packed ids stand for; null ids give no bytes."""

    @F.pandas_udf("binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, pattern)
        for s in parts:
            yield pd.Series([c.decode(x or b"") for x in s], dtype=object)

    return run(ids)


def encode_decode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, ids, decoded) for every row.  One worker a task does both, so
    that a task holds the vocabulary once and ids do not travel twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for b in common.slices(batches, 256):
            ids = [c.encode(t) for t in common.texts(b, "text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary()), pa.array(map(c.decode, ids), pa.binary())], ["doc_id", "ids", "decoded"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return common.map_arrow(rows, f"doc_id {dict(rows.dtypes)['doc_id']}, ids binary, decoded binary", run)


def digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op10: token count and digests of every document's ids and decoded bytes."""
    coded = encode_decode(common.table(spark, sf_dir, "documents"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
