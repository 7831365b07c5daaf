"""Byte-level BPE through a sentencepiece model that is written, not trained.

Every entry of a rank file becomes a piece: its bytes spelled with one printable
character per byte, its score the negative rank.  sentencepiece merges the neighbouring
pair of the highest score that is a piece, the leftmost first, which is the merge of the
lowest rank.  Normalisation is the identity.  Texts are split by the pattern of the
vocabulary and each pre-token is encoded alone; ids are decoded by the inverse spelling.

Defined results: a null text is an empty one, with no ids.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillmill.llm.common import ChunkCoder, blocks, spelling

NORMAL, UNKNOWN, BPE = 1, 2, 2
_CODECS: dict[tuple[str, str], "Codec"] = {}


def ranks(path: str) -> list[bytes]:
    """The entries of a rank file in the order of their ranks."""
    with open(path, "rb") as file:
        found = {int(rank): base64.b64decode(entry) for entry, rank in map(bytes.split, file)}
    return [found[i] for i in range(len(found))]


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def field(number: int, value: bytes | int) -> bytes:
    """A protocol buffer field: a number, or bytes with their length."""
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def model(entries: list[bytes]) -> bytes:
    """The serialised sentencepiece model of a vocabulary; the unknown piece comes last."""
    letters = spelling()
    out = []
    for rank, entry in enumerate(entries):
        piece = "".join(letters[b] for b in entry).encode()
        out.append(field(1, field(1, piece) + varint(2 << 3 | 5) + struct.pack("<f", -float(rank))))
    out.append(field(1, field(1, b"<unk>") + varint(2 << 3 | 5) + struct.pack("<f", 0.0) + field(3, UNKNOWN)))
    trainer = field(3, BPE) + field(4, len(entries) + 1) + field(40, len(entries))
    normalizer = field(1, b"identity") + field(3, 0) + field(4, 0) + field(5, 0)
    return b"".join([*out, field(2, trainer), field(3, normalizer)])


class Codec:
    """Encodes and decodes with a rank file and the pattern of its pre-tokens."""

    def __init__(self, path: str, pattern: str):
        from sentencepiece import SentencePieceProcessor

        entries = ranks(path)
        self.processor = SentencePieceProcessor(model_proto=model(entries))
        letters = spelling()
        self.spelled = dict(enumerate(letters))
        inverse = {c: b for b, c in enumerate(letters)}
        decoded = [bytes(inverse[c] for c in self.processor.id_to_piece(i)) for i in range(len(entries))]
        self.length = np.array([len(x) for x in decoded], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.bytes = np.frombuffer(b"".join(decoded), dtype=np.uint8)
        self.coder = ChunkCoder(self.pre_tokens, pattern)

    def pre_tokens(self, tokens: list[str]) -> list[bytes]:
        spelled = [t.encode("utf-8", "replace").decode("latin-1").translate(self.spelled) for t in tokens]
        return [array("I", x).tobytes() for x in self.processor.encode(spelled, out_type=int, num_threads=1)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(x), dtype="<u4") for x in self.coder.encode(texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        length = self.length[ids]
        total = int(length.sum())
        first = np.cumsum(length) - length
        at = np.repeat(self.begin[ids] - first, length) + np.arange(total)
        return self.bytes[at].tobytes()


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""

    def run(batches):
        held = codec(path, pattern)
        for block in blocks(batches, 2_000_000):
            rows = []
            for doc, ids in zip(block["doc_id"], held.encode(block["text"]), strict=True):
                rows.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(held.decode(ids)).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row."""

    def run(batches):
        held = codec(path, pattern)
        for block in blocks(batches, 2_000_000):
            ids = [x.astype(np.int32) for x in held.encode(block["text"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block["doc_id"], pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "doc_id long, ids array<int>")
