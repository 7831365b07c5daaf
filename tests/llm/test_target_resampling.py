"""Importance resampling and its distributed radix sort against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skillmill.llm import queries, target_resampling
from skillmill.llm.common import ship, table

SF = "/root/testdata/sf0.001"
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(_SMALL))


def buckets(text, k):
    w = words(text)
    return [zlib.crc32(x.encode()) % k for x in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


def brute(docs, target, k=10_000, least=20):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows by plain Python."""
    s, t = (Counter(b for text in texts for b in buckets(text, k)) for texts in ([x for _, x in docs], target))
    n_s, n_t = sum(s.values()), sum(t.values())
    rows = []
    for doc, text in docs:
        found = buckets(text, k)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + k) / ((s[b] + 1) * (n_t + k)))) for b in found]
        weight = sum(gain) // len(gain) if gain else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(found), weight, score, len(words(text))))
    fit = sorted((r for r in rows if r[3] is not None and r[4] >= least), key=lambda r: (-r[3], r[0], r[1], r[2]))
    drawn = [(*r[:4], i + 1) for i, r in enumerate(fit[: len(fit) * 25 // 100])]
    rest = fit[len(drawn):] + [r for r in rows if r[3] is None or r[4] < least]
    return sorted([*drawn, *[(*r[:4], None) for r in rest]], key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    target = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert got(queries.QUERIES["op13_radix_resampling"](spark, SF)) == brute(docs, target)


def test_odd_rows_repeated_ids_and_clashing_columns(spark):
    draw = random.Random(5)
    letters = ["a", "B", "é", "日", "z9", "x" * 60, "y" * 300, "I'm", "don\tt", "A_b", "\0q", "ß", "🙂"]
    some = [" ".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(some)] + [(None, some[0]), (7, some[8] + " more"), (7, some[7]), (200, None), (201, ""), (202, "!!"), (203, "w " * 40_000), (-(1 << 62), some[3])]
    docs = ship(spark).createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, score int, pos int")
    target = ship(spark).createDataFrame([("a B é",), (None,), ("日 z9",)], "text string")
    assert got(target_resampling.resampled(docs, target)) == brute(rows, ["a B é", None, "日 z9"])
    assert target_resampling.resampled(docs.limit(0), target).collect() == []
    assert got(target_resampling.resampled(docs, target.limit(0))) == brute(rows, [])
    assert [r.rank for r in target_resampling.resampled(docs.where("doc_id = 200"), target).collect()] == [None]


@pytest.mark.parametrize("bits", [4, 12])
def test_radix_sort_is_whole_and_stable(spark, bits):
    draw = random.Random(bits)
    # A third of the rows share one key; extremes of the type, repeated rows.
    values = [7] * 100 + [draw.randint(-50, 50) for _ in range(180)] + ([-(1 << 63), (1 << 63) - 1] * 5 if bits == 12 else [-1] * 10)
    rows = [(v, draw.randint(0, 9), i % 4) for i, v in enumerate(values)]
    frame = ship(spark).createDataFrame(rows, "k long, id long, tie long").repartition(5)
    for largest_first in (True, False):
        held, n = target_resampling.radix_sorted(frame, [("k", largest_first), ("id", False)], ["tie"], bits)
        found = [(r.k, r.id, r.tie) for r in held.orderBy("pos").collect()]
        assert n == len(rows) and found == sorted(rows, key=lambda r: (-r[0] if largest_first else r[0], r[1], r[2]))
        assert [r.pos for r in held.select(F.col("pos")).orderBy("pos").collect()] == list(range(n))
    same, n = target_resampling.radix_sorted(frame.select(F.lit(1).cast("long").alias("k"), "tie"), [("k", True)], ["tie"], bits)
    assert n == len(rows) and [r.tie for r in same.orderBy("pos").collect()] == sorted(r[2] for r in rows)


def test_a_table_that_begins_anew_gives_the_same():
    small, large = target_resampling.Features(97, most=40), target_resampling.Features(97)
    texts = [f"word{i} other{i % 7} {'x' * i}" for i in range(120)]
    for text in texts:
        assert [a.tolist() for a in small.of([text])] == [a.tolist() for a in large.of([text])]
        _, ones, twos = small.of([text])
        assert [*ones, *twos] == buckets(text, 97)
