"""Line dedup by overlapping windows of three lines, with DataFrame functions only.

A window is three consecutive lines, compared as they are.  Its first occurrence
in the order of document id and line number stays; the lines covered by any later
occurrence go.  Overlapping windows merge because the covered line numbers are
put together before lines are taken out.

Defined results: a text with fewer than three lines, a null text and a row without
an id stay as they are; a window of three empty lines counts for nothing; rows that
repeat an id are one document.  A document whose lines are all covered keeps its
row with an empty text.  Other columns pass through, but for ``n_lines`` and ``n_removed``, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillmill.llm.common import unused

WINDOW = 3


def windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, pos, k1, k2): each window's two 64-bit hashes and its first line, counted from 0."""
    lines = docs.where(F.col(id_col).isNotNull() & F.col(text_col).contains("\n")).select(
        F.col(id_col).alias("doc"), F.split(F.col(text_col), "\n").alias("lines")
    )
    hashed = lines.select(
        "doc",
        F.transform("lines", lambda x: F.xxhash64(x)).alias("a"),
        F.transform("lines", lambda x: F.xxhash64(F.lit(WINDOW), x)).alias("b"),
        F.transform("lines", lambda x: x == "").alias("blank"),
    ).where(F.size("a") >= WINDOW)

    def at(name, i):
        return [F.get(F.col(name), i + F.lit(k)) for k in range(WINDOW)]

    def window(i):
        blank = at("blank", i)
        empty = blank[0]
        for b in blank[1:]:
            empty = empty & b
        key = F.struct(i.alias("pos"), F.xxhash64(*at("a", i)).alias("k1"), F.xxhash64(*at("b", i)).alias("k2"))
        return F.when(~empty, key)

    starts = F.sequence(F.lit(0), F.size("a") - F.lit(WINDOW))
    return (
        hashed.select("doc", F.explode(F.transform(starts, window)).alias("w"))
        .where(F.col("w").isNotNull())
        .select("doc", "w.pos", "w.k1", "w.k2")
    )


def repeated_positions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, starts): where the later occurrences of windows begin in a document."""
    found = windows(docs, id_col, text_col)
    # One fixed-width number that orders by document, then line: its minimum is a hash
    # aggregate with a map-side part, so a window in a third of all documents is one row a task.
    place = F.col("doc").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("pos")
    ranked = found.withColumn("place", place.cast("decimal(32,0)"))
    first = (
        ranked.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min("place").alias("first"))
        .where("n > 1").select("k1", "k2", "first")
    )
    # The repeated windows have a shuffle of their own, so adaptive execution can split a hot one.
    later = ranked.join(first, ["k1", "k2"]).where("place > first")
    return later.groupBy("doc").agg(F.collect_set("pos").alias("starts"))


def drop_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the covered lines taken out, and the columns ``n_lines`` and ``n_removed``, which replace columns of these names."""
    doc, starts, lines, kept = unused(docs, "__doc", "__starts", "__lines", "__kept")
    found = repeated_positions(docs, id_col, text_col).select(F.col("doc").alias(doc), F.col("starts").alias(starts))
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    columns = [F.col(f"`{c}`") for c in others]
    joined = docs.select(*columns).join(found, F.col(f"`{id_col}`") == F.col(doc), "left")
    content, hit = F.col(f"`{text_col}`"), F.col(starts).isNotNull()
    split = joined.withColumn(lines, F.when(hit, F.split(content, "\n")))
    covered = F.flatten(F.transform(starts, lambda s: F.array(*[s + F.lit(k) for k in range(WINDOW)])))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    split = split.withColumn(kept, F.when(hit, left))
    text = F.when(~hit, content).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    )
    n_lines = F.when(hit, F.size(lines)).otherwise(
        F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit(""))) + 1
    )
    removed = F.when(hit, F.size(lines) - F.size(kept)).otherwise(F.lit(0))
    return split.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in others],
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
    )
