"""Removal of long byte strings that occur more than once, by suffix sorting in buckets.

Every string of LENGTH bytes has one anchor, the least hashed k-gram in it, which equal strings share at the same
place. Neighbouring strings of one anchor form a piece, and pieces with the same anchor a bucket: equal strings
meet in one bucket. Buckets are dealt over tasks, and a task orders the suffixes of one block of buckets at a time
(`suffixsort`); equal strings are then neighbours. Equal pieces enter a bucket once, with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.llm.shared import written
from closewright.llm.suffixsort import equal_to_neighbour, sample_ranks, sorted_suffixes, words_at
from closewright.llm.textbytes import BASE, BYTE_VALUE, U64, groups, mixed, powers, utf8

LENGTH, GRAM = 200, 40
WINDOW = LENGTH - GRAM + 1
#: Starts taken at once: longer texts are cut into overlapping parts, which only cuts pieces.
PART = 1 << 20
#: Bytes of pieces a task sorts at once.
BLOCK_BYTES = 2 << 20
#: Unequal pieces (about 6 MB) beyond which a bucket is parted by the fingerprint of each whole string.
HOT_BUCKET = 20_000
_POWERS = powers(BASE, PART + LENGTH + 1)
_INVERSES = powers(pow(BASE, -1, 1 << 64), PART + LENGTH + 1)
_PLACE_BITS = U64(21)

PIECE = "key long, content long, doc long, text_hash long, start long, n long, repeats long"


def span_hash(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return (sums[end] - sums[begin]) * _INVERSES[begin]


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    reach, out = 1, values
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def pieces_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """key, content, text index, start, n and repeats of the pieces of some texts.

    A piece is n strings that start in a row and have one anchor. The same piece repeated right behind itself (runs
    of one byte make such) is one row with its number of repeats.
    """
    ends = np.repeat(offsets[1:], np.diff(offsets))
    found: list[tuple[np.ndarray, ...]] = []
    for c in range(0, max(len(data) - LENGTH + 1, 0), PART):
        part = data[c : c + PART + LENGTH - 1]
        n = len(part) - LENGTH + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[part] * _POWERS[: len(part)], out=sums[1:])
        at = np.arange(len(part) - GRAM + 1)
        grams = mixed(span_hash(sums, at, at + GRAM))
        ranked = (grams >> _PLACE_BITS << _PLACE_BITS) | at.astype(np.uint64)
        anchor = (least_in_windows(ranked, WINDOW) & ((U64(1) << _PLACE_BITS) - U64(1))).astype(np.int64)
        valid = np.arange(c, c + n) + LENGTH <= ends[c : c + n]
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            continue
        last = valid.copy()
        last[:-1] &= ~valid[1:] | new[1:]
        count = np.flatnonzero(last) - first + 1
        content = mixed(mixed(span_hash(sums, first, first + count + LENGTH - 1)) + count.astype(np.uint64))
        found.append((grams[anchor[first]], content, np.searchsorted(offsets, first + c, side="right") - 1, first + c, count))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    key, content, text, start, count = (np.concatenate(x) for x in zip(*found, strict=True))
    again = np.zeros(len(key), bool)
    again[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1]) & (text[1:] == text[:-1]) & (start[1:] == start[:-1] + count[:-1])
    head = np.flatnonzero(~again)
    repeats = np.diff(np.append(head, len(key)))
    return key[head].astype(np.int64), content[head].astype(np.int64), text[head], start[head] - offsets[text[head]], count[head], repeats


def pieces(texts: DataFrame) -> DataFrame:
    """Pieces of every text, told apart by doc and text_hash."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in groups(offsets):
                key, content, text, *rest = pieces_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                taken = pa.array(text + a)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(content), batch.column(0).take(taken), batch.column(1).take(taken), *map(pa.array, rest)], names=["key", "content", "doc", "text_hash", "start", "n", "repeats"])

    return texts.mapInArrow(find, PIECE)


def fetched(asked: DataFrame) -> DataFrame:
    """key, content, weight, n and the bytes of each asked piece (`wanted`) of each text."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "content", "weight", "n", "piece"]
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            wanted = batch.column(1)
            owner = np.repeat(np.arange(len(batch)), np.diff(np.asarray(wanted.offsets)))
            flat = wanted.flatten()
            key, content, weight, start, n = (flat.field(k).to_numpy() for k in range(5))
            begin = offsets[owner] + start
            for at in range(0, len(key), 4096):
                cut = [data[p : p + m + LENGTH - 1].tobytes() for p, m in zip(begin[at : at + 4096].tolist(), n[at : at + 4096].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(pa.array(x[at : at + 4096]) for x in (key, content, weight, n)), pa.array(cut, pa.binary())], names=names)

    return asked.mapInArrow(fetch, "key long, content long, weight long, n long, piece binary")


def repeated_starts(block: list[tuple[int, int, int, int, bytes]]) -> Iterator[tuple[int, int, int, int]]:
    """key, content, first and last of each run of starts, within a piece, whose string occurs again."""
    text = np.frombuffer(b"".join(row[4] for row in block), np.uint8)
    size = np.array([len(row[4]) for row in block])
    key, content, weight, n = (np.array([row[k] for row in block]) for k in range(4))
    begin = np.cumsum(size) - size
    piece = np.repeat(np.arange(len(block)), n)
    nth = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    starts = begin[piece] + nth
    words = words_at(np.append(text, np.zeros(2 * LENGTH + 64, np.uint8)))
    ranks = sample_ranks(words, len(text), LENGTH)
    order = sorted_suffixes(words, ranks, starts, key[piece])
    again = equal_to_neighbour(words, starts, key[piece], order, LENGTH) | (weight[piece] > 1)
    edge = np.ones(len(again), bool)
    edge[1:] = (again[1:] != again[:-1]) | (piece[1:] != piece[:-1])
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(again)) - 1
    for a, b in zip(first[again[first]].tolist(), last[again[first]].tolist(), strict=True):
        yield int(key[piece[a]]), int(content[piece[a]]), int(nth[a]), int(nth[b])


def sorted_buckets(found: DataFrame) -> DataFrame:
    """Runs of repeated starts of every piece, bucket by bucket."""
    dealt = found.repartition("key").sortWithinPartitions("key", "content")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        held = 0

        def done() -> pa.RecordBatch:
            rows = list(repeated_starts(block))
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["key", "content", "low", "high"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if held > BLOCK_BYTES and row[0] != block[-1][0]:
                    yield done()
                    block, held = [], 0
                if block and block[-1][:2] == row[:2]:
                    continue  # the text itself was there twice
                block.append(row)
                held += len(row[4])
        if block:
            yield done()

    return dealt.mapInArrow(sort, "key long, content long, low long, high long")


def string_prints(asked: DataFrame) -> DataFrame:
    """Two fingerprints (128 bits together) of each single string of the asked pieces, with its place."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            wanted = batch.column(3)
            owner = np.repeat(np.arange(len(batch)), np.diff(np.asarray(wanted.offsets)))
            flat = wanted.flatten()
            start, n = flat.field(3).to_numpy(), flat.field(4).to_numpy()
            for a, b in groups(np.append(0, np.cumsum(n + LENGTH)), PART):
                size = n[a:b] + LENGTH - 1
                held = np.concatenate([data[p : p + m] for p, m in zip((offsets[owner[a:b]] + start[a:b]).tolist(), size.tolist(), strict=True)])
                piece = np.repeat(np.arange(b - a), n[a:b])
                nth = np.arange(len(piece)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])
                at = (np.cumsum(size) - size)[piece] + nth
                prints = []
                for salt in (U64(0), U64(0x5851F42D4C957F2D)):
                    sums = np.zeros(len(held) + 1, np.uint64)
                    np.cumsum(mixed(BYTE_VALUE[held] + salt) * _POWERS[: len(held)], out=sums[1:])
                    prints.append(mixed(span_hash(sums, at, at + LENGTH)).astype(np.int64))
                taken = pa.array(owner[a:b][piece])
                yield pa.RecordBatch.from_arrays([pa.array(prints[0]), pa.array(prints[1]), batch.column(0).take(taken), batch.column(1).take(taken), pa.array(start[a:b][piece] + nth)], names=["one", "two", "doc", "text_hash", "start"])

    return asked.mapInArrow(find, "one long, two long, doc long, text_hash long, start long")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary) of every row.

    Removed are the bytes of every string of LENGTH bytes that also starts anywhere else, judged on the input; null
    texts are empty, texts shorter than LENGTH keep all, and repeated rows count as occurrences of each other and
    each get their row. Rows are told apart by id and text, so ids may repeat or be null.
    """
    source = docs.select(F.xxhash64(F.col(key).cast("string")).alias("doc"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cut = pieces(source)
    shared = written(cut.groupBy("key").agg(F.sum("repeats").alias("total")).filter("total > 1").select(F.col("key").alias("shared_key")), "shared-anchors")
    # Both sides get shuffles of their own, so a hot anchor's pieces can be split over tasks.
    held = written(cut.join(shared, cut["key"] == shared["shared_key"]).drop("shared_key"), "shared-pieces")

    # One piece of each content stands for all; its text is fetched from one of its places.
    contents = held.groupBy("key", "content").agg(F.sum("repeats").alias("weight"), F.min(F.struct("doc", "text_hash", "start", "n")).alias("place"))
    contents = written(contents, "piece-contents")
    crowded = written(contents.groupBy("key").count().filter(F.col("count") > HOT_BUCKET).select(F.col("key").alias("crowded_key")), "crowded-anchors")
    one = contents.join(crowded, contents["key"] == crowded["crowded_key"], "left_anti")
    hot = held.join(crowded, held["key"] == crowded["crowded_key"], "left_semi")
    listed = one.select("place.doc", "place.text_hash", F.struct("key", "content", "weight", "place.start", "place.n").alias("piece")).groupBy("doc", "text_hash").agg(F.collect_list("piece").alias("wanted"))
    runs = sorted_buckets(fetched(source.join(listed, ["doc", "text_hash"]).select("text", "wanted")))
    runs = written(runs.select(F.col("key").alias("k"), F.col("content").alias("c"), "low", "high"), "repeated-runs")
    marks = held.join(runs, (held["key"] == runs["k"]) & (held["content"] == runs["c"]))
    # A piece repeated behind itself is repeated throughout.
    low = F.when(F.col("repeats") > 1, F.lit(0)).otherwise(F.col("low"))
    high = F.when(F.col("repeats") > 1, F.col("n") * F.col("repeats") - 1).otherwise(F.col("high"))
    marks = marks.select("doc", "text_hash", (F.col("start") + low).alias("first"), (F.col("start") + high).alias("last"))

    # Buckets of very many unequal pieces: every string on its own, counted before it is dealt.
    asked = hot.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("key", "content", "repeats", "start", (F.col("n") * F.col("repeats")).alias("n"))).alias("wanted"))
    prints = written(string_prints(source.join(asked, ["doc", "text_hash"]).select("doc", "text_hash", "text", "wanted")), "hot-strings")
    twice = written(prints.groupBy("one", "two").count().filter("count > 1").select(F.col("one").alias("o"), F.col("two").alias("t")), "hot-repeats")
    single = prints.join(twice, (prints["one"] == twice["o"]) & (prints["two"] == twice["t"])).select("doc", "text_hash", F.col("start").alias("first"), F.col("start").alias("last"))

    spans = marks.union(single).groupBy("doc", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(key).cast("string")).alias("doc"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = named.join(spans, ["doc", "text_hash"], "left").select("doc_id", "text", F.coalesce("runs", F.array().cast("array<struct<first:bigint,last:bigint>>")).alias("runs"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            listed = batch.column(2)
            bounds, flat = np.asarray(listed.offsets), listed.flatten()
            bounds = bounds - bounds[0]
            first, last = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            removed, spans, kept = [], [], []
            for n in range(len(batch)):
                own = data[offsets[n] : offsets[n + 1]]
                a, b = bounds[n], bounds[n + 1]
                if a == b:
                    removed.append(0)
                    spans.append(0)
                    kept.append(own.tobytes())
                    continue
                change = np.zeros(len(own) + 1, np.int64)
                np.add.at(change, first[a:b], 1)
                np.add.at(change, last[a:b] + LENGTH, -1)
                out = np.cumsum(change[:-1]) > 0
                removed.append(int(out.sum()))
                spans.append(int(out[0]) + int((out[1:] & ~out[:-1]).sum()))
                kept.append(own[~out].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return whole.mapInArrow(remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")

