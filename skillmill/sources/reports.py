"""CSV report scans.

A report is a file or a folder of part files.  The header of every part is read first, and
the parts are scanned once per distinct header and put together by name, so parts may differ in the order and
number of their columns.  Records that cannot be read as the header says are marked, not
dropped: ``MALFORMED`` holds what is wrong and, where it is known, the text of the record.
"""

from __future__ import annotations

import csv
import io
import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillmill.functions.text import null_tokens, unique_headers
from skillmill.sources.paths import child_names, file_ends, join_path, part_files
from skillmill.sources.snapshots import find_latest_snapshot

log = logging.getLogger(__name__)

# Columns that give the order of the rows in a report, whatever the file splits.
FILE_ORDER = ("_file", "_block", "_row")

# What is wrong with a record, null for a good one: struct<problem, record>.
MALFORMED = "_malformed"
MALFORMED_TYPE = "struct<problem:string,record:string>"
TOO_LONG, OPEN_QUOTE, BAD_BYTES = "too many cells", "open quote", "bytes that are not UTF-8"

_RAW = "_raw_record"
# Bytes of a file's end that are compared with its last cell, and of all ends that are broadcast.
_END, _MOST_ENDS = 256, 8_000_000
# A record in which a cell begins with a quote that is not closed.
_UNCLOSED = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+$'
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'


@dataclass(frozen=True)
class Part:
    """A part file: its path, its unique column names, the text of its header and its last characters."""

    path: str
    names: tuple[str, ...]
    header: str
    end: str


def parts_of(spark: SparkSession, path: str) -> list[Part]:
    """The part files of a report that have a header, each read at its two ends only."""

    def ends(file: str) -> Part | None:
        size = 1 << 16
        while True:
            head, end, whole = file_ends(spark, file, size, _END)
            text = head.decode("utf-8", "replace").removeprefix("﻿")
            begin = len(text) - len(text.lstrip())
            record, used = _first_record(text[begin:])
            if used or whole:
                break
            size *= 4
        if not text.strip():
            return None
        return Part(file, tuple(unique_headers(record)), text[begin:].splitlines()[0], end.decode("utf-8", "replace"))

    with ThreadPoolExecutor(16) as pool:
        return [p for p in pool.map(ends, part_files(spark, path)) if p is not None]


def _first_record(text: str) -> tuple[list[str], bool]:
    """(cells of the first record, whether more text follows it)."""
    lines = io.StringIO(text, newline="")
    record = next(csv.reader(lines), [])
    return record, bool(lines.read(1))


def _options(reader, multi_line: bool):
    # Two double quotes stand for one, and cells keep their outer blanks.
    return reader.option("quote", '"').option("escape", '"').option("multiLine", multi_line).option("encoding", "UTF-8")


def _too_long(raw: Column, width: int) -> Column:
    """Whether a record has more cells than ``width``."""
    bare = F.regexp_replace(raw, _QUOTED, "")
    return F.length(bare) - F.length(F.translate(bare, ",", "")) >= width


def _swallowed(cell: Column, width: int) -> Column:
    """Whether a cell that kept its first quote holds a line as wide as a record.

    The parser leaves the quote where another one followed inside the cell, as it does
    where a cell is not closed before the next quoted one.
    """
    lines = F.split(cell, "\n")
    wide = F.exists(lines, lambda line: F.length(line) - F.length(F.translate(line, ",", "")) >= max(width - 1, 1))
    return cell.startswith('"') & cell.contains("\n") & wide


def _malformed(names: Sequence[str], raw: Column, open_end: Column | None) -> Column:
    cells = [F.col(f"`{n}`") for n in names]

    def some(tests: list[Column]) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])

    opened = raw.contains('"') & raw.rlike(_UNCLOSED)
    tests = [opened, *[_swallowed(c, len(names)) for c in cells]]
    if open_end is not None:
        tests.append(open_end)
    problem = (
        F.when(some(tests), F.lit(OPEN_QUOTE))
        .when(_too_long(raw, len(names)), F.lit(TOO_LONG))
        .when(some([c.contains("�") for c in cells]), F.lit(BAD_BYTES))
    )
    return F.when(problem.isNotNull(), F.struct(problem.alias("problem"), raw.alias("record"))).cast(MALFORMED_TYPE)


def _scan_records(spark: SparkSession, parts: list[Part], names: tuple[str, ...]) -> DataFrame:
    """Parts whose cells may hold line breaks; each file is one task.

    A quote that is open at the end of a file swallows the records behind it.  Where that
    leaves the right number of cells, the parser says nothing; but then the last cell, behind its quote,
    is the raw end of the file.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _RAW)])
    reader = _options(spark.read, True).option("header", True).option("columnNameOfCorruptRecord", _RAW)
    rows = reader.schema(schema).csv([p.path for p in parts]).select("*", *_order())
    # The end of a compressed part is not known, so there only the number of cells tells.
    ends = spark.createDataFrame([(p.path, p.end or None) for p in parts], "_path string, _end string")
    if len(parts) * 2 * _END <= _MOST_ENDS:
        ends = F.broadcast(ends)
    keyed = rows.join(ends, _without_slashes(_decoded(F.col("_file"))) == _without_slashes(F.col("_path")), "left")
    cell = F.concat(F.lit('"'), F.replace(F.col(f"`{names[-1]}`"), F.lit('"'), F.lit('""')))
    open_end = F.col("_end").endswith(cell) | cell.endswith(F.col("_end"))
    # Lines of blanks only; the first cell is named as Spark reads no file for the raw record alone.
    blank = F.col(_RAW).isNotNull() & (F.trim(_RAW) == "") & (F.trim(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) == "")
    return keyed.filter(~blank).select(
        *[null_tokens(F.col(f"`{n}`")).alias(n) for n in names], _malformed(names, F.col(_RAW), open_end).alias(MALFORMED), *FILE_ORDER
    )


def _scan_lines(spark: SparkSession, parts: list[Part], names: tuple[str, ...]) -> DataFrame:
    """Parts in which every line is a record; files are split.  Lines that repeat the header are dropped."""
    headers = sorted({p.header for p in parts})
    lines = spark.read.option("encoding", "UTF-8").text([p.path for p in parts]).select("value", *_order())
    bare = F.regexp_replace("value", "^﻿", "")
    kept = lines.filter((F.trim("value") != "") & ~(bare.isin(*headers) & (F.col("_block") == 0)))
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in (*names, _RAW))
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW}
    # The parser names short and long records; the line itself tells of open quotes.
    read = kept.select("value", F.from_csv("value", schema, options).alias("_cells"), *FILE_ORDER).select("value", "_cells.*", *FILE_ORDER)
    raw = F.when(F.col(_RAW).isNotNull() | F.col("value").contains('"'), F.col("value"))
    return read.select(
        *[null_tokens(F.col(f"`{n}`")).alias(n) for n in names], _malformed(names, raw, None).alias(MALFORMED), *FILE_ORDER
    )


def _order() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    ]


def _decoded(path: Column) -> Column:
    """Spark writes the path of a file with escapes; a plus sign is none of them."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _without_slashes(path: Column) -> Column:
    return F.regexp_replace(path, "^([a-z0-9]+:)/+", "$1/")


def read_report(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame | None:
    """One report as text columns, ``MALFORMED`` and the file-order columns; None where it has no header.

    ``path`` is a CSV file or a folder of part files.  With ``multi_line`` a quoted cell
    may hold line breaks and each file is one task; turn it off for huge single files without such
    cells and they are split.  A record shorter than its header lacks its last cells.
    """
    parts = parts_of(spark, path)
    if not parts:
        return None
    by_header: dict[tuple[str, ...], list[Part]] = {}
    for part in parts:
        by_header.setdefault(part.names, []).append(part)
    scan = _scan_records if multi_line else _scan_lines
    scans = [scan(spark, same, names) for names, same in by_header.items()]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    names = [c for c in together.columns if c != MALFORMED and c not in FILE_ORDER]
    return together.select(*[F.col(f"`{n}`") for n in names], MALFORMED, *FILE_ORDER)


def read_reports(
    spark: SparkSession, folder: str, multi_line: bool = True
) -> dict[str, DataFrame]:
    """All ``*.csv`` right below ``folder`` by file name; those without a header are logged and left out."""

    def read(name: str) -> DataFrame | None:
        frame = read_report(spark, join_path(folder, name), multi_line)
        if frame is None:
            log.warning("could not read %s: no header", name)
        return frame

    names = [n for n in child_names(spark, folder) if n.endswith(".csv")]
    with ThreadPoolExecutor(4) as pool:
        frames = dict(zip(names, pool.map(read, names)))
    return {name: frame for name, frame in frames.items() if frame is not None}


def malformed_records(report: DataFrame, name: str) -> DataFrame:
    """(table_name, problem, row) and the file order of the malformed records of a report."""
    bad = report.filter(F.col(MALFORMED).isNotNull())
    cells = [c for c in report.columns if c != MALFORMED and c not in FILE_ORDER]
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in cells]))
    return bad.select(
        F.lit(name).alias("table_name"),
        F.col(f"{MALFORMED}.problem").alias("problem"),
        F.coalesce(F.col(f"{MALFORMED}.record"), text).alias("row"),
        *FILE_ORDER,
    )


def extract(
    spark: SparkSession, base: str, snapshot: str | None = None, multi_line: bool = True
) -> tuple[str, dict[str, DataFrame]]:
    """Folder and reports of the named snapshot, or of the newest quarterly one."""
    folder = join_path(base, snapshot) if snapshot else find_latest_snapshot(spark, base)
    return folder, read_reports(spark, folder, multi_line)
