"""Records of CSV files whose quoted fields may hold line breaks, found in parallel.

A file is read as lines in byte ranges, each by one task. Whether a line begins inside a quoted field depends on all
lines before it, but a line, and so a range, can only map the two states (outside, inside) to two states. One pass
finds the map of each range, a prefix over the ranges of a file gives the state in which each range begins, and a
second pass puts lines together to records in reading order, without a shuffle of the text. Only a record that spans
ranges is put together afterwards, from one piece a range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from closewright.sources.staging import staged

CORRUPT = "_corrupt_record"
# Read as null where a field is empty and not quoted, and put behind each record to see how many fields it has.
_NULL, _END = "\u0000", "\u0001end"
WHOLE, BEGUN, CONTINUED = 0, 1, 2


def ends_inside(line: str, sep: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted field, if it begins inside one or not.

    A quote opens a field only as its first character, a doubled quote is text, and what follows the closing quote up
    to the separator belongs to the field, quotes included.
    """
    at = -1 if inside else 0
    while True:
        if at < 0 or line.startswith('"', at):
            at = line.find('"', at + 1)
            while at >= 0 and line.startswith('"', at + 1):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            at = line.find(sep, at + 1)
        else:
            at = line.find(sep + '"', at)
        if at < 0:
            return False
        at += len(sep)


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """file, range (its first byte) and line, in reading order within a range."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.col("value").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """Lines of a batch by range; a range's lines stand together."""
    files, ranges, lines = (batch.column(k).to_pylist() for k in range(3))
    first = 0
    for at in range(1, len(lines) + 1):
        if at == len(lines) or ranges[at] != ranges[first] or files[at] != files[first]:
            yield (files[first], ranges[first]), lines[first:at]
            first = at


def range_maps(lines: DataFrame, sep: str) -> DataFrame:
    """file, range, outside and inside: whether the range ends inside a field if it begins outside, or inside, of one.

    Lines without a quote change nothing and are not looked at.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, (False, True)
        for batch in batches:
            for here, some in _runs(batch):
                if here != key:
                    if key is not None:
                        yield row(key, state)
                    key, state = here, (False, True)
                for line in some:
                    one = ends_inside(line, sep, state[0])
                    state = (one, one if state[0] == state[1] else ends_inside(line, sep, state[1]))
        if key is not None:
            yield row(key, state)

    def row(key, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([state[0]]), pa.array([state[1]])], names=["file", "range", "outside", "inside"])

    return lines.filter(F.contains("line", F.lit('"'))).mapInArrow(find, "file string, range long, outside boolean, inside boolean")


def open_ranges(maps: DataFrame) -> DataFrame:
    """file and range of the ranges that lie behind one that ends inside a field; `next` is the range the state holds from.

    The state after a range is that of the last range before it that maps both states to one, turned by each range
    since that exchanges them.
    """
    upto = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = maps.withColumn("turned", F.sum((F.col("outside") & ~F.col("inside")).cast("int")).over(upto))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "turned"))
    told = turns.withColumn("fixed", F.last(fixed, ignorenulls=True).over(upto))
    since = (F.col("turned") - F.coalesce(F.col("fixed.turned"), F.lit(0))) % 2 == 1
    ends = told.select("file", "range", (F.coalesce(F.col("fixed.outside"), F.lit(False)) != since).alias("open"))
    behind = Window.partitionBy("file").orderBy("range")
    # Ranges without a quote have no row here: the state holds until the next range that has one, that range included.
    return ends.withColumn("until", F.lead("range").over(behind)).filter("open").select("file", "range", "until")


def assembled(lines: DataFrame, sep: str, opened: dict[str, list[tuple[int, int | None]]]) -> DataFrame:
    """file, range, kind and record: whole records, and the pieces of records that go on in another range.

    The first record of a file, its header, is left out, and so are blank lines.
    """

    def begins_inside(key: tuple[str, int]) -> bool:
        return any(a < key[1] and (b is None or key[1] <= b) for a, b in opened.get(key[0], ()))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, inside, continues, header = None, [], False, False, False
        for batch in batches:
            out: list[tuple] = []
            for here, some in _runs(batch):
                if here != key:
                    if held:
                        out.append((*key, CONTINUED if continues else BEGUN, "\n".join(held)))
                    key, held, inside = here, [], begins_inside(here)
                    continues, header = inside, here[1] == 0
                for line in some:
                    if inside or '"' in line:
                        inside = ends_inside(line, sep, inside)
                    held.append(line)
                    if not inside:
                        record = "\n".join(held) if len(held) > 1 else line
                        record = record.removesuffix("\r")
                        held = []
                        if continues:
                            out.append((*key, CONTINUED, record))
                        elif header:
                            pass
                        elif record.strip(" \t"):
                            out.append((*key, WHOLE, record))
                        continues = header = False
            yield rows(out)
        if held:
            yield rows([(*key, CONTINUED if continues else BEGUN, "\n".join(held))])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string()), strict=True)], names=["file", "range", "kind", "record"])

    return lines.mapInArrow(put, "file string, range long, kind int, record string")


def csv_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """record: each record of the CSV files but the headers, as text with its line breaks.

    What the driver holds is one row for each range that begins inside a quoted field, and it plans every range anyway.
    Both passes run here, so that they see the same ranges whatever is set later; the records are a table in the shared
    folder. An unclosed quote makes the rest of its file one record.
    """
    lines = lines_of(spark, path)
    opened: dict[str, list] = {}
    for r in open_ranges(staged(range_maps(lines, sep), "csv-ranges")).collect():
        opened.setdefault(r["file"], []).append((r["range"], r["until"]))
    found = staged(assembled(lines, sep, opened), "csv-records")
    # At most two pieces a range.
    upto = Window.partitionBy("file").orderBy("range", F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chained = found.filter(F.col("kind") != WHOLE).withColumn("chain", F.sum((F.col("kind") == BEGUN).cast("int")).over(upto))
    parts = F.array_sort(F.collect_list(F.struct("range", "record")))
    joined = chained.groupBy("file", "chain").agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
    # A chain that no range begins is a header that spans ranges.
    return found.filter(F.col("kind") == WHOLE).select("record").union(joined.filter("chain > 0").select("record"))


def parsed(records: DataFrame, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Text columns and `_corrupt_record` of records: a short one is filled with nulls, one of too many fields is corrupt.

    An empty field is null, a quoted empty one an empty text.
    """
    schema = StructType()
    for k in range(len(columns) + 1):
        schema = schema.add(f"c{k}", StringType())
    options = {"sep": sep, "quote": '"', "escape": '"', "nullValue": _NULL, "multiLine": "true", "mode": "PERMISSIVE"}
    fields = F.from_csv(F.concat("record", F.lit(sep + _END)), F.lit(schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")), options)
    held = records.select("record", fields.alias("f"))
    value = [F.col(f"f.c{k}") for k in range(len(columns) + 1)]
    ended = F.lit(False)
    out = []
    for k, name in enumerate(columns):
        out.append(F.when(value[k] != F.lit(_END), value[k]).alias(name))
        ended = ended | value[k].eqNullSafe(F.lit(_END))
    good = ended | value[-1].eqNullSafe(F.lit(_END))
    return held.select(*out, F.when(~good, F.col("record")).alias(CORRUPT))
