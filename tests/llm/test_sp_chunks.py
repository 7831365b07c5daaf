"""SentencePiece by distinct chunks against the library on whole texts."""

import hashlib
import random
from array import array

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from skillmill.llm import queries, sp_chunks
from skillmill.llm.common import ship, table

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "  a  b ", "▁", "▁▁a ▁b", "a▁", "\n", "a\n b\t c", "日本 語", "🙂 🙂x", "<s> </s> <unk>", "<0x41> \0",
    "1234 5.6", "naïve é", "�", "a b", "word " * 30_000, "x" * 50_000, " " * 5_000 + "end",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def digest(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_query_equals_the_library_on_whole_texts(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_distinct_chunks"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    assert got == {i: digest(library, t) for i, t in texts.items()}


def test_odd_texts_null_ids_and_clashing_columns(spark, library):
    rows = [(i, t, "ids", 1) for i, t in enumerate(ODD)] + [(None, "a b", None, None), (0, "b", None, None), (0, "b", None, None)]
    docs = ship(spark).createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long")
    got = sorted((tuple(r) for r in sp_chunks.digests(docs, MODEL).collect()), key=str)
    assert got == sorted(((i, *digest(library, t)) for i, t, *_ in rows), key=str)
    assert sp_chunks.digests(docs.limit(0), MODEL).collect() == []


def test_a_table_that_begins_anew_gives_the_same(library):
    draw = random.Random(3)
    parts = [" ", "  ", "▁", "a", "the", "\n", "é", "日", "🙂", "<s>", "1", ".", "\0", "ing"]
    held = sp_chunks.ChunkTable(MODEL, most=500)
    for _ in range(100):
        texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(20)]
        for text, (ids, decoded) in zip(texts, held.encode(texts), strict=True):
            want = library.encode(text, add_bos=True, add_eos=True)
            assert array("I", ids).tolist() == want and decoded == library.decode(want)
        assert held.held <= 500


def test_ids_go_back_to_texts(spark):
    docs = ship(spark).createDataFrame([(1, "Hello  wörld \n x"), (2, None), (3, "日本")], "doc_id long, text string")
    tokens = sp_chunks.encoded(docs, MODEL)
    back = {r.doc_id: r.text for r in sp_chunks.decoded(tokens, MODEL).collect()}
    assert back == {1: "Hello  wörld \n x", 2: "", 3: "日本"}
    assert {r.doc_id: r.decoded for r in tokens.collect()} == back
    none = tokens.withColumn("ids", F.lit(None).cast("array<int>"))
    assert [r.text for r in sp_chunks.decoded(none, MODEL).collect()] == [None] * 3
