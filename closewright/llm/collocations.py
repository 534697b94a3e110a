"""Phrase collocations by direct-address tiling of pairs of frequency-ranked ids.

Texts become blocks of word numbers. Words that are frequent enough get ids by falling frequency, so frequent pairs of
neighbouring ids crowd into few tiles of the id-by-id square: those are counted by a dense bincount, all other tiles
as sorted coordinates. Frequent pairs are ranked anew and are the ids of the next round, in which two neighbours that
overlap are a phrase one word longer. A block learns the ids of just its own words and pairs: the rows by which it tells
its counts come back with them. A block's counts of pairs are sorted and compressed, one row for each bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from closewright.llm.shared import removed, written
from closewright.llm.textbytes import utf8

LEAST_COUNT, LONGEST, BEST = 100, 5, 2000
UNKNOWN = "und"
#: Words of a block: what a task holds at a time. Bytes of a text split at once.
BLOCK_WORDS, TAKEN_BYTES = 1 << 21, 1 << 20
#: Buckets in which words and pairs are counted and ranked, and a factor that spreads the pairs of one first id over them.
BUCKETS, PAIR_BUCKETS, SPREAD = 1 << 10, 1 << 11, 769
#: Ids on a side of a tile, tiles on a side that may be crowded, and pairs from which on a tile is counted densely.
TILE, CROWDED, DENSE = 512, 1024, 1 << 13
#: Rows of one group of the ranking, and of a batch that a task passes on.
RANK_ROWS, ROWS = 100_000, 1 << 16
_ENDS = b".,;:!?\n\x0b\x0c\r"
#: Lower case, every mark that ends a piece as a full stop, a tab as a space: then only those part words.
FOLDED = bytes(46 if b in _ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
# A block is one row with a number for each place (-1 between pieces), and a row for what each number stands for, with its count;
# pairs have a row for each bucket: its first number, how many there are, and a, b and n of each, packed.
BLOCK, WORDS, PAIRS = "block long, places binary, spot int", "lang string, word string, n long", "bucket int, size int, pairs binary"


def parts(text: bytes) -> Iterator[bytes]:
    """A folded text in parts of about TAKEN_BYTES, cut where a word ends (a longer word stays whole)."""
    at = 0
    while len(text) - at > TAKEN_BYTES:
        ends = [e for e in (text.find(c, at + TAKEN_BYTES) for c in (b" ", b".")) if e >= 0]
        if not ends:
            break
        yield text[at : min(ends)]
        at = min(ends)
    yield text[at:]


class Numbers(dict):
    """Number of each word of a language in a block, given out as words are met."""

    def __init__(self, words: list):
        super().__init__()
        self.words = words
        self[b"."] = -1

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number


def packed(*columns: np.ndarray) -> bytes:
    """Whole numbers of equally long columns, compressed byte by byte of equal weight: small ones take few bytes."""
    weights = np.stack(columns).astype("<i8").view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return pa.compress(np.ascontiguousarray(weights), codec="zstd", asbytes=True)


def unpacked(data: bytes, columns: int, size: int) -> np.ndarray:
    """The columns that were packed, as rows of an array."""
    weights = np.frombuffer(pa.decompress(data, columns * size * 8, codec="zstd", asbytes=True), np.uint8).reshape(columns, 8, size)
    return np.ascontiguousarray(weights.transpose(0, 2, 1)).view("<i8")[:, :, 0]


def place_row(block: int, places: np.ndarray, others: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    """The row of a block's places; spot says how many there are."""
    none = [pa.nulls(1, kind) for _, kind in others]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([packed(places)], pa.binary()), pa.array([len(places)], pa.int32()), *none], names=["block", "places", "spot", *(name for name, _ in others)])


def joined_runs(ids: np.ndarray) -> np.ndarray:
    """The ids with each run of -1 as one."""
    if not len(ids):
        return ids
    gap = ids < 0
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    return ids[keep]


def word_rows(block: int, places: np.ndarray, langs: list[str], words: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The rows of one block of words."""
    columns = [pa.array(langs, pa.string()), pa.array([w.decode() for w in words], pa.string()), pa.array(np.bincount(places[places >= 0], minlength=len(words)), pa.int64())]
    names = ["lang", "word", "n"]
    yield place_row(block, places, [(name, c.type) for name, c in zip(names, columns, strict=True)])
    for at in range(0, len(words), ROWS):
        some = [c.slice(at, ROWS) for c in columns]
        n = len(some[0])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block, np.int64)), pa.nulls(n, pa.binary()), pa.array(np.arange(at, at + n, dtype=np.int32)), *some], names=["block", "places", "spot", *names])


def pair_rows(block: int, places: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> list[pa.RecordBatch]:
    """The rows of one block of pairs: its numbers are dealt anew, by bucket, then a, then b."""
    bucket = (a * SPREAD + b) % PAIR_BUCKETS
    order = np.lexsort((b, a, bucket))
    number = np.full(len(a) + 1, -1, np.int32)  # the last stands for -1
    number[order] = np.arange(len(a))
    a, high, n, bucket = a[order], b[order] // PAIR_BUCKETS, n[order], bucket[order]
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    sizes = np.diff(np.append(starts, len(a)))
    # The bucket and a tell what b leaves on division.
    pairs = [packed(np.diff(a[i : i + k], prepend=0), high[i : i + k], n[i : i + k]) for i, k in zip(starts.tolist(), sizes.tolist(), strict=True)]
    rows = len(starts)
    told = [pa.array(np.full(rows, block, np.int64)), pa.nulls(rows, pa.binary()), pa.array(starts, pa.int32()), pa.array(bucket[starts], pa.int32()), pa.array(sizes, pa.int32()), pa.array(pairs, pa.binary())]
    return [place_row(block, number[places], [("bucket", pa.int32()), ("size", pa.int32()), ("pairs", pa.binary())]), pa.RecordBatch.from_arrays(told, names=["block", "places", "spot", "bucket", "size", "pairs"])]


def word_blocks(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """Blocks of the documents' words: places, and lang, word and n of each number. A block's number tells its task."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")).filter("text is not null")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[bytes] = []
        spoken: dict[str, Numbers] = {}
        langs: list[str] = []
        held: list[np.ndarray] = []
        number, size = TaskContext.get().partitionId() << 33, 0

        def block() -> Iterator[pa.RecordBatch]:
            return word_rows(number, joined_runs(np.concatenate(held)), langs, words)

        for batch in batches:
            spoken_here = batch.column(0).to_pylist()
            data, offsets = utf8(batch.column(1))
            for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                language = spoken_here[row]
                for part in parts(data[a:b].tobytes().translate(FOLDED)):
                    numbers = spoken.get(language)
                    if numbers is None:
                        numbers = spoken[language] = Numbers(words)
                    tokens = part.replace(b".", b" . ").split(b" ")
                    got = np.fromiter(map(numbers.__getitem__, filter(None, tokens)), np.int32)
                    langs.extend([language] * (len(words) - len(langs)))
                    held.append(got)
                    size += len(got)
                held.append(np.array([-1], np.int32))
                size += 1
                if size >= BLOCK_WORDS:
                    yield from block()
                    words, langs, held, spoken, size, number = [], [], [], {}, 0, number + 1
        if held:
            yield from block()

    return rows.mapInArrow(find, f"{BLOCK}, {WORDS}")


def tiled_counts(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs a, b with their count n, and the number of each given pair among them.

    Pairs are dealt to tiles of TILE by TILE ids. A tile of at least DENSE pairs, among the CROWDED first of each side,
    has a cell for every pair, counted by bincount; the pairs of all other tiles are sorted as coordinates and counted
    by runs.
    """
    none = np.zeros(0, np.int64)
    if not len(first):
        return none, none, none, none
    row, column = first // TILE, second // TILE
    low = (row < CROWDED) & (column < CROWDED)
    tile = np.where(low, row * CROWDED + column, CROWDED * CROWDED).astype(np.int32)
    del row, column, low
    crowd = np.bincount(tile, minlength=CROWDED * CROWDED + 1)
    crowd[-1] = 0
    number = np.empty(len(first), np.int64)
    a, b, n, upto = [], [], [], 0
    sparse = crowd[tile] < DENSE
    for k in np.flatnonzero(crowd >= DENSE):
        at = np.flatnonzero(tile == k)
        cell = (first[at] % TILE) * TILE + second[at] % TILE
        counted = np.bincount(cell, minlength=TILE * TILE)
        some = np.flatnonzero(counted)
        name = np.empty(TILE * TILE, np.int64)
        name[some] = np.arange(upto, upto + len(some))
        number[at] = name[cell]
        a.append(k // CROWDED * TILE + some // TILE)
        b.append(k % CROWDED * TILE + some % TILE)
        n.append(counted[some])
        upto += len(some)
    at = np.flatnonzero(sparse)
    if len(at):
        order = np.lexsort((second[at], first[at]))
        at = at[order]
        x, y = first[at], second[at]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        starts = np.flatnonzero(new)
        number[at] = upto + np.cumsum(new) - 1
        a.append(x[starts])
        b.append(y[starts])
        n.append(np.diff(np.append(starts, len(x))))
    return np.concatenate(a), np.concatenate(b), np.concatenate(n), number


def pair_blocks(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """The blocks one round on: places of pairs of neighbouring ids, and a, b and n of each pair.

    `known` has block, size and ids (spots, which are numbers of the block, and the id of each, packed) of what is frequent
    enough; all else becomes a gap. A block and its own ids come together, no more.
    """

    def find(block: pa.Table, ids: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        for row in block.to_pylist() if len(ids) else []:
            places = unpacked(row["places"], 1, row["size"])[0]
            some = [unpacked(x["ids"], 2, x["size"]) for x in ids.to_pylist()]
            spots, found = np.concatenate(some, axis=1)
            names = np.full(int(max(places.max(initial=-1), spots.max(initial=-1))) + 2, -1, np.int64)  # the last stands for -1
            names[spots] = found
            now = joined_runs(names[places])
            able = np.flatnonzero((now[:-1] >= 0) & (now[1:] >= 0))
            if len(able):
                a, b, n, number = tiled_counts(now[able], now[able + 1])
                left = np.full(len(now), -1, np.int32)
                left[able] = number
                out += pair_rows(row["block"], joined_runs(left), a, b, n)
        return pa.Table.from_batches(out) if out else EMPTY

    places = blocks.filter("places is not null").select("block", "places", F.col("spot").alias("size"))
    ids = known.filter("ids is not null").select(F.col("block").alias("of"), "size", "ids")
    return places.groupBy("block").cogroup(ids.groupBy("of")).applyInArrow(find, f"{BLOCK}, {PAIRS}")


EMPTY = pa.schema([("block", pa.int64()), ("places", pa.binary()), ("spot", pa.int32()), ("bucket", pa.int32()), ("size", pa.int32()), ("pairs", pa.binary())]).empty_table()


def frequent_pairs(blocks: DataFrame, least: int) -> DataFrame:
    """Of the pairs that occur at least `least` times in all: a row with id, a, b and n, and rows that tell blocks their ids.

    A bucket's rows, one for each block, come together: there its pairs are counted, and the frequent ones get ids by falling
    frequency, then a and b, those of the buckets interleaved. Block, size and ids go back (see pair_blocks).
    """
    names = ["block", "size", "ids", "id", "a", "b", "n"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), *[pa.int64()] * 4]

    def find(group: pa.Table) -> pa.Table:
        bucket, sizes = group.column("bucket")[0].as_py(), group.column("size").to_pylist()
        a, high, n = np.concatenate([np.concatenate([x[:1].cumsum(axis=1), x[1:]]) for x in (unpacked(p, 3, k) for p, k in zip(group.column("pairs").to_pylist(), sizes, strict=True))], axis=1)
        b = high * PAIR_BUCKETS + (bucket - a * SPREAD) % PAIR_BUCKETS
        order = np.lexsort((b, a))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
        starts = np.flatnonzero(new)
        total = np.add.reduceat(n[order], starts)
        a, b = a[order][starts], b[order][starts]
        best = np.lexsort((b, a, -total))
        best = best[total[best] >= least]
        if not len(best):
            return pa.table([pa.nulls(0, kind) for kind in kinds], names=names)
        ids = np.full(len(starts), -1, np.int64)
        ids[best] = np.arange(len(best)) * PAIR_BUCKETS + bucket
        each = np.empty(len(order), np.int64)
        each[order] = ids[np.cumsum(new) - 1]
        back, at = [], 0
        for block, spot, size in zip(group.column("block").to_pylist(), group.column("spot").to_pylist(), sizes, strict=True):
            own = np.flatnonzero(each[at : at + size] >= 0)
            if len(own):
                back.append((block, len(own), packed(own + spot, each[at + own])))
            at += size
        told = [pa.array([x[k] for x in back], kinds[k]) for k in range(3)]
        found = [pa.array(x, pa.int64()) for x in (ids[best], a[best], b[best], total[best])]
        return pa.concat_tables([pa.table([*told, *[pa.nulls(len(back), kind) for kind in kinds[3:]]], names=names), pa.table([*[pa.nulls(len(best), kind) for kind in kinds[:3]], *found], names=names)])

    rows = blocks.filter("bucket is not null").select("block", "spot", "bucket", "size", "pairs")
    return rows.groupBy("bucket").applyInArrow(find, "block long, size int, ids binary, id long, a long, b long, n long")


def by_frequency(counted: DataFrame, ties: list[str], name: str) -> DataFrame:
    """The rows (n and the columns of ties) with an id from 0 by falling n, then ties: sorted by ranges, so no task holds all.

    Exact over all rows; `phrases` ranks within buckets instead, which needs no sort of everything.
    """
    path = written(counted.orderBy(F.desc("n"), *ties).withColumn("place", F.monotonically_increasing_id()), name)
    # Places count from 0 in each range; a range's ids begin after all ranges before it. One row a range.
    ranges = path.groupBy(F.shiftrightunsigned("place", 33).alias("range")).agg(F.count("*").alias("rows"))
    starts, upto = [], 0
    for r in sorted(ranges.collect()):
        starts.append((r["range"], upto))
        upto += r["rows"]
    begin = counted.sparkSession.createDataFrame(starts, "range long, begin long")
    met = path.withColumn("range", F.shiftrightunsigned("place", 33)).join(begin, "range")
    return written(met.withColumn("id", F.col("begin") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).drop("range", "begin", "place"), name)


def numbers_of(blocks: DataFrame, columns: list[str]) -> DataFrame:
    """block, spot and the columns of each number of each block; the places are not read."""
    return blocks.filter("places is null").select("block", "spot", *columns)


def frequent(numbers: DataFrame, columns: list[str], least: int) -> DataFrame:
    """block, spot, id and n of the numbers whose columns occur at least `least` times in all, which is n.

    Rows are moved once, dealt to BUCKETS by their columns: there they are counted, and what is frequent gets ids by
    falling frequency, those of the buckets interleaved. A group has a row for each block, no more. The columns stand in one
    row of each id and are null in its others.
    """
    bucket = F.pmod(F.xxhash64(*columns), F.lit(BUCKETS))
    # What is moved is small: the bucket is worked out again, and spot and n, both less than 2**31, share a number.
    moved = numbers.select("block", (F.shiftleft(F.col("spot").cast("long"), 32) + F.col("n")).alias("both"), *columns).repartition(bucket)
    dealt = moved.select("block", F.shiftright("both", 32).cast("int").alias("spot"), F.col("both").bitwiseAND(F.lit((1 << 32) - 1)).alias("n"), *columns, bucket.alias("bucket"), F.xxhash64(*columns).alias("hash"))
    alike = Window.partitionBy("hash", *columns, "bucket")
    counted = dealt.withColumns({"total": F.sum("n").over(alike), "least_block": F.min("block").over(alike)}).filter(F.col("total") >= least)
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(F.desc("total"), *columns)).cast("long")
    told = [F.when(F.col("block") == F.col("least_block"), F.col(c)).alias(c) for c in columns]
    return counted.withColumn("rank", rank).select("block", "spot", ((F.col("rank") - 1) * BUCKETS + F.col("bucket")).alias("id"), F.col("total").alias("n"), *told)


def packed_ids(words: DataFrame) -> DataFrame:
    """block, size and ids of the frequent words (see pair_blocks), packed where their rows are."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, spot, found = (batch.column(k).to_numpy() for k in range(3))
            starts = np.flatnonzero(np.append(True, np.diff(block) != 0)) if len(block) else np.zeros(0, np.int64)
            ends = np.append(starts[1:], len(block))
            rows = [packed(spot[i:k], found[i:k]) for i, k in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(block[starts], pa.int64()), pa.array(ends - starts, pa.int32()), pa.array(rows, pa.binary())], names=["block", "size", "ids"])

    return words.select("block", "spot", "id").sortWithinPartitions("block", "spot").mapInArrow(pack, "block long, size int, ids binary")


def phrases(docs: DataFrame, lang: str, text: str, least: int, longest: int) -> tuple[DataFrame, list[DataFrame]]:
    """n of each language, and for each length a table of its frequent phrases.

    A phrase has id, lang, words, n, first and last (how often its first and its last 1, 2, ... words occur), and of
    two words on a and b, the ids of the phrase without its last and without its first word.
    """
    blocks = written(word_blocks(docs, lang, text), "word-blocks")
    totals = written(numbers_of(blocks, ["lang", "n"]).groupBy("lang").agg(F.sum("n").alias("total")), "word-totals")
    words = written(frequent(numbers_of(blocks, ["lang", "word", "n"]), ["lang", "word"], least), "frequent-words")
    none = F.array().cast("array<long>")
    tables = [written(words.filter("word is not null").select("id", "lang", F.array("word").alias("words"), "n", none.alias("first"), none.alias("last")), "words")]
    known = packed_ids(words)
    for k in range(longest - 1):
        before_blocks, blocks = blocks, written(pair_blocks(blocks, known), "pair-blocks")
        removed(before_blocks)
        removed(known if k else words)
        known = written(frequent_pairs(blocks, least), "frequent-pairs")
        ids = known.filter("a is not null").select("id", "a", "b", "n")
        shorter = tables[-1]
        # A frequent word begins and ends very many phrases: with keys derived from the ids, its rows can be split over tasks.
        before = shorter.select(F.struct(F.col("id").alias("k")).alias("ka"), "lang", F.col("words").alias("front"), F.array_append("first", F.col("n")).alias("first"))
        after = shorter.select(F.struct(F.col("id").alias("k")).alias("kb"), F.element_at("words", -1).alias("end"), F.array_append("last", F.col("n")).alias("last"))
        met = ids.withColumn("ka", F.struct(F.col("a").alias("k"))).withColumn("kb", F.struct(F.col("b").alias("k"))).join(before, "ka").join(after, "kb")
        tables.append(written(met.select("id", "lang", F.array_append("front", F.col("end")).alias("words"), "n", "first", "last", "a", "b"), "phrases"))
    removed(blocks)
    removed(known if longest > 1 else words)
    return totals, tables


def lowest_cut(total: Column) -> Column:
    """score, k, l and r of the cut of the lowest score, ties to the smallest k. Exact: all products are decimals."""
    whole = lambda c: c.cast("decimal(38,0)")
    above = whole(F.col("n").cast("decimal(19,0)") * 1000 * total.cast("decimal(15,0)"))

    def cut(left: Column, k: Column) -> Column:
        right = F.get("last", F.size("words") - k - 2)
        below = whole(left.cast("decimal(19,0)") * right.cast("decimal(19,0)"))
        return F.struct(F.call_function("div", above, below).alias("score"), (k + 1).alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform("first", cut))


def best_of(rows: DataFrame, best: int) -> DataFrame:
    """rank and the best rows of each lang; groups of about RANK_ROWS rows are cut to their best first, round by round."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    groups = rows.count() // RANK_ROWS
    while groups > 0:
        salted = rows.withColumn("group", F.pmod(F.xxhash64("phrase"), F.lit(groups + 1)))
        cut = F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order))
        rows = salted.withColumn("nth", cut).filter(F.col("nth") <= best).drop("nth", "group")
        groups = min(groups - 1, (groups + 1) * best // RANK_ROWS)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= best)


def ranked_phrases(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, best: int = BEST, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of each language.

    A phrase of 2 to `longest` words occurs at least `least` times within pieces of text. Its score is the lowest over
    its cuts in two, floor(1000 a n / (l r)). Phrases that only occur inside a longer one are left out. A null lang is
    `und` (as a lang of that name is), a null or empty text holds nothing, repeated rows count each time, equal scores
    stand by count and then by the phrase's bytes; an empty table gives no row. Other columns are not read.
    """
    totals, tables = phrases(docs, lang, text, least, longest)
    found = None
    for n, table in enumerate(tables[1:], 1):
        if n + 1 < len(tables):
            # A phrase inside an equally frequent longer one lies inside an equally frequent one a word longer.
            longer = tables[n + 1]
            within = longer.select(F.col("a").alias("id"), "n").union(longer.select(F.col("b").alias("id"), "n")).distinct()
            table = table.join(within, ["id", "n"], "left_anti")
        table = table.select("lang", "words", "n", "first", "last")
        found = table if found is None else found.union(table)
    scored = found.join(totals, "lang").withColumn("cut", lowest_cut(F.col("total")))
    scored = scored.select("lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
    return best_of(written(scored, "scored-phrases"), best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
