"""SentencePiece encoding and decoding through a table of distinct chunks.

The library writes a marker for every blank and one more before the text.  Where no piece of the
model holds a marker behind another character, no merge reaches over the place where a marker
follows something else, so a text falls into chunks, each some markers and what follows them up
to the next marker, that are segmented alone.  Each task keeps a table of the chunks
it has met: a new chunk is segmented and decoded once by the library, and a text's ids are those of its
chunks, joined in the order of their positions.  The same cut holds for decoding, as the bytes of
a character that is no piece never lie in two chunks.

The table is bounded by the characters it holds and begins anew when they are reached; chunks that are long
themselves are segmented without being kept.

Defined results: a null text is an empty one, which has only the ids of begin and end and decodes to nothing;
repeated rows and rows without an id give a row each.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillmill.llm.common import blocks

MARKER = "▁"
_CHUNK = re.compile(f"[ {MARKER}]+[^ {MARKER}]*")
#: Characters of all chunks a table holds before it begins anew, and of the longest chunk it keeps.
MOST, LONG = 24_000_000, 128
_TABLES: dict[str, "ChunkTable"] = {}


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without its first marker, which the library writes itself."""
    if text[:1] == " " or "  " in text or MARKER in text:
        return [c[1:] for c in _CHUNK.findall(" " + text)] if text else []
    return text.split(" ") if text else []


class ChunkTable:
    """(ids, decoded text) of distinct chunks under a model."""

    def __init__(self, path: str, most: int = MOST):
        from sentencepiece import SentencePieceProcessor

        self.processor = p = SentencePieceProcessor(model_file=path)
        if any(MARKER in p.id_to_piece(i).lstrip(MARKER) for i in range(p.get_piece_size())):
            raise ValueError("a piece of this model crosses a whitespace marker")
        if p.encode("a  b") == p.encode("a b") or p.encode(" a") == p.encode("a"):
            raise ValueError("this model changes blanks, which the cut does not expect")
        self.most = most
        self.begin, self.end = (array("I", [i]).tobytes() for i in (p.bos_id(), p.eos_id()))
        # A marker with nothing behind it; the library would take it for an empty text.
        self.bare = (array("I", [p.piece_to_id(MARKER)]).tobytes(), "")
        self.clear()

    def clear(self) -> None:
        self.known, self.held = {"": self.bare}, 0

    def segmented(self, parts: list[str]) -> list[tuple[bytes, str]]:
        ids = self.processor.encode(parts, out_type=int, num_threads=1)
        texts = self.processor.decode(ids, num_threads=1)
        return [(array("I", i).tobytes(), t) for i, t in zip(ids, texts, strict=True)]

    def rows(self, parts: list[str]) -> list[tuple[bytes, str]]:
        """What the table says of each chunk, in their order."""
        found = list(map(self.known.get, parts))
        missing = [i for i, row in enumerate(found) if row is None]
        if not missing:
            return found
        new = list({parts[i] for i in missing})
        made = dict(zip(new, self.segmented(new), strict=True))
        for i in missing:
            found[i] = made[parts[i]]
        keep = {p: row for p, row in made.items() if len(p) <= LONG}
        size = sum(map(len, keep))
        if self.held + size > self.most:
            self.clear()
        if size <= self.most:
            self.known.update(keep)
            self.held += size
        return found

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """(ids as unsigned 32-bit integers with begin and end, decoded text) of each text."""
        cut = [chunks(t or "") for t in texts]
        found = iter(self.rows(list(chain.from_iterable(cut))))
        out = []
        for parts in cut:
            rows = list(islice(found, len(parts)))
            out.append((b"".join([self.begin, *[ids for ids, _ in rows], self.end]), " ".join([t for _, t in rows])))
        return out


def chunk_table(path: str) -> ChunkTable:
    if path not in _TABLES:
        _TABLES[path] = ChunkTable(path)
    return _TABLES[path]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row, with begin and end ids."""

    def run(batches):
        table = chunk_table(path)
        for block in blocks(batches, 2_000_000):
            rows = table.encode(block["text"])
            ids = [np.frombuffer(i, dtype="<u4").astype(np.int32) for i, _ in rows]
            arrays = [pa.array(block["doc_id"], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array([t for _, t in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of every row of ids; null ids give a null text."""

    def run(batches):
        decode = chunk_table(path).processor.decode
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = [None if i is None else decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""

    def run(batches):
        table = chunk_table(path)
        for block in blocks(batches, 2_000_000):
            rows = table.encode(block["text"])
            arrays = [
                pa.array(block["doc_id"], pa.int64()),
                pa.array([len(i) // 4 for i, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i, _ in rows], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for _, t in rows], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
