"""Near-duplicates by DartMinHash: sparse weighted signatures, banded joining, exact verification.

Darts are thrown, by hash, into the region of each weighted element (its weight times a rank axis). The earliest
dart of each coordinate is the signature; two signatures agree in a coordinate with the probability of the
weighted Jaccard similarity. Only about K log K darts are looked at, however many elements a document has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.llm.components import components
from closewright.llm.shared import tidied, written
from closewright.llm.textbytes import U64, groups, mixed, shingles, utf8, word_hashes

SHINGLE_WORDS, LEAST_SIMILARITY = 5, 0.8
#: 32 bands of 5: a pair of similarity 0.8 shares no band with probability 3e-6.
BANDS, BAND_ROWS = 32, 5
COORDINATES = BANDS * BAND_ROWS
DARTS = COORDINATES * (math.log(COORDINATES) + 2)
#: Cells looked at at once, and bytes of texts taken at once: these bound a task's memory.
CELLS, TAKEN_BYTES = 1 << 18, 1 << 19
#: Rounds in which the other components of a bucket meet one set of its largest; sets and shingles of a tile of what is open then.
REPRESENTATIVES, TILE, TILE_ELEMENTS = 3, 2048, 1 << 21
# Cumulative chances of 0, 1, 2 ... darts in a cell of unit area (Poisson of mean 1).
_CHANCES = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
_GOLDEN = U64(0x9E3779B97F4A7C15)


def uniform(h: np.ndarray) -> np.ndarray:
    return (h >> U64(11)).astype(np.float64) * 2.0**-53


def weighted(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each document, their owner and their weight (how often they occur)."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return h[at], o[at], np.diff(np.append(at, len(h)))


def throw(out: np.ndarray, h: np.ndarray, o: np.ndarray, w: np.ndarray, count: np.ndarray, low: int, width: int, reach: np.ndarray) -> None:
    """Put the darts of one layer, `count` cells of each element, into the ranks."""
    cell = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(np.arange(len(h)), count)
    seed = mixed(h[at] + _GOLDEN * (cell.astype(np.uint64) * U64(64) + U64(low.bit_length() + 1)))
    darts = np.searchsorted(_CHANCES, uniform(seed), side="right")
    hit = np.repeat(np.arange(len(at)), darts)
    nth = np.arange(len(hit)) - np.repeat(np.cumsum(darts) - darts, darts)
    thrown = mixed(seed[hit] + _GOLDEN * (nth.astype(np.uint64) + U64(1)))
    rank = (cell[hit] + uniform(mixed(thrown + U64(1)))) / width
    place = low + width * uniform(mixed(thrown + U64(2)))
    element = at[hit]
    inside = (place < w[element]) & (rank < reach[o[element]])
    slot = o[element[inside]] * COORDINATES + (thrown[inside] % U64(COORDINATES)).astype(np.int64)
    np.minimum.at(out, slot, rank[inside])


def signatures(elements: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """n x COORDINATES ranks of the earliest darts (infinite throughout for a document without elements).

    The rank of a dart identifies it. Darts are sought up to the rank at which a document expects DARTS of them; a
    document that leaves a coordinate empty is sought again twice as far, which finds the same darts and more.
    """
    out = np.full(n * COORDINATES, np.inf)
    total = np.bincount(owner, weight, minlength=n)
    reach = DARTS / np.maximum(total, 1)
    able = total > 0
    while able.any():
        mine = able[owner]
        h, o, w = elements[mine], owner[mine], weight[mine]
        low, width = 0, 1
        while len(h):
            # Cells of this layer of weights: `width` wide and 1 / width high, so one dart is expected in each.
            count = np.ceil(reach[o] * width).astype(np.int64)
            upto = np.cumsum(count)
            begin = 0
            while begin < len(h):  # so many cells at once, whatever the documents' lengths
                end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + CELLS, side="right")))
                throw(out, h[begin:end], o[begin:end], w[begin:end], count[begin:end], low, width, reach)
                begin = end
            low += width
            width = low
            higher = w > low
            h, o, w = h[higher], o[higher], w[higher]
        able &= np.isinf(out.reshape(n, COORDINATES)).any(axis=1)
        reach = np.where(able, reach * 2, reach)
    return out.reshape(n, COORDINATES)


def band_values(ranks: np.ndarray) -> np.ndarray:
    """n x BANDS hashes, each of one band's ranks and its number."""
    cells = ranks.view(np.uint64).reshape(len(ranks), BANDS, BAND_ROWS)
    h = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(ranks), 1))
    for k in range(BAND_ROWS):
        h = mixed(h * _GOLDEN + cells[:, :, k])
    return h


def element_groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Ranges of texts with the distinct shingles, their owner within the range and their weight."""
    data, offsets = utf8(column)
    for a, b in groups(offsets, TAKEN_BYTES):
        words, owner, _ = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        yield a, b, *weighted(*shingles(words, owner, b - a, SHINGLE_WORDS))


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, high, low (a 128-bit hash of the weighted shingles), weight and bands of each document with a word."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, h, o, w in element_groups(batch.column(2)):
                n = b - a
                ranks = signatures(h, o, w, n)
                sums = []
                for salt in (1, 2):
                    terms, total = mixed(mixed(h + U64(salt)) + w.astype(np.uint64)), np.zeros(n, np.uint64)
                    np.add.at(total, o, terms)
                    sums.append(total.astype(np.int64))
                weight = np.bincount(o, w, minlength=n).astype(np.int64)
                some = np.flatnonzero(weight > 0)
                bands = band_values(ranks[some]).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1)))
                taken = pa.array(some + a)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), pa.array(sums[0][some]), pa.array(sums[1][some]), pa.array(weight[some]), lists], names=["doc_id", "text_hash", "high", "low", "weight", "bands"])

    return docs.mapInArrow(tidied(sketch), f"doc_id {kind}, text_hash long, high long, low long, weight long, bands array<long>")


def shingle_table(texts: DataFrame) -> DataFrame:
    """sid and elements: the shingles as distinct numbers, a repeated shingle with a number for each repeat."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, h, o, w in element_groups(batch.column(1)):
                repeat = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
                each = np.repeat(h, w)
                each = np.where(repeat > 0, mixed(each + _GOLDEN * repeat.astype(np.uint64)), each).astype(np.int64)
                ends = np.append(0, np.cumsum(np.bincount(o, w, minlength=b - a))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(each))], names=["sid", "elements"])

    return texts.mapInArrow(tidied(find), "sid long, elements array<long>")


def verified(pairs: DataFrame, elements: DataFrame) -> DataFrame:
    """Of the pairs u, v those whose weighted Jaccard similarity is at least LEAST_SIMILARITY."""
    one = elements.select(F.col("sid").alias("u"), F.col("elements").alias("mine"))
    other = elements.select(F.col("sid").alias("v"), F.col("elements").alias("theirs"))
    both = F.size(F.array_intersect("mine", "theirs"))
    met = pairs.join(one, "u").join(other, "v")
    return met.filter(both >= F.lit(LEAST_SIMILARITY) * (F.size("mine") + F.size("theirs") - both)).select("u", "v")


def size_fits(a, b):
    """No pair of these weights can be less similar than their ratio allows."""
    return F.least(a, b) >= F.lit(LEAST_SIMILARITY) * F.greatest(a, b)


def against_largest(apart: DataFrame, elements: DataFrame, turn: int) -> DataFrame:
    """Links between a set of each open bucket's largest component, another one each turn, and the sets of its other components."""
    crowd = apart.groupBy("band", "component").agg(F.count("*").alias("n"), F.min_by("sid", F.xxhash64("sid", F.lit(turn))).alias("v"))
    most = crowd.groupBy("band").agg(F.max(F.struct("n", "component", "v")).alias("m")).select(F.struct("band").alias("k"), F.col("m.component").alias("largest"), F.col("m.v").alias("v"))
    pairs = apart.withColumn("k", F.struct("band")).join(most, "k").filter("component <> largest").select(F.col("sid").alias("u"), "v").distinct()
    return verified(pairs, elements)


def units_of(apart: DataFrame, firsts: DataFrame, elements: DataFrame) -> DataFrame:
    """The sets of open buckets dealt to units (band, one, two): each two sets of a bucket that are not both of its largest component meet in one.

    The sets of the largest component and the others are parted into tiles by number and by shingles. So where few sets
    are left beside the largest component, its sets are dealt once or a few times each.
    """
    crowd = apart.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    most = crowd.groupBy("band").agg(F.max(F.struct("n", "component", "w")).alias("m"), F.sum("n").alias("n"), F.sum("w").alias("w"))
    tiles = lambda n, w: F.ceil(F.greatest(n / TILE, w / TILE_ELEMENTS)).cast("int")
    sized = most.select(F.struct("band").alias("k"), F.col("m.component").alias("largest"), tiles(F.col("n") - F.col("m.n"), F.col("w") - F.col("m.w")).alias("others"), tiles(F.col("m.n"), F.col("m.w")).alias("mine"))
    placed = apart.withColumn("k", F.struct("band")).join(sized, "k").withColumn("top", F.col("component") == F.col("largest"))
    part = F.when(F.col("top"), F.col("others") + F.pmod(F.xxhash64("sid"), F.col("mine"))).otherwise(F.pmod(F.xxhash64("sid"), F.col("others"))).cast("int")
    last = F.when(F.col("top"), F.col("others") - 1).otherwise(F.col("others") + F.col("mine") - 1)
    dealt = placed.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    dealt = dealt.select("band", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"), "part", "sid", "component")
    return dealt.join(firsts.select("sid", "bands"), "sid").join(elements, "sid").select("band", "one", "two", "part", "sid", "component", "bands", "elements")


class Sets:
    """The sets of one unit, with their shingles sorted."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches).combine_chunks()
        self.part, self.sid, self.component = (rows.column(k).to_numpy() for k in (3, 4, 5))
        self.bands = rows.column(6).combine_chunks().flatten().to_numpy().reshape(len(rows), BANDS)
        lists = rows.column(7).combine_chunks()
        self.elements, self.ends = lists.flatten().to_numpy(), np.append(0, np.cumsum(np.diff(lists.offsets.to_numpy())))
        self.size = np.diff(self.ends)

    def similar(self, x: int, others: np.ndarray) -> np.ndarray:
        """Which of the others are at least LEAST_SIMILARITY like x."""
        mine = np.sort(self.elements[self.ends[x] : self.ends[x + 1]])
        theirs = np.concatenate([self.elements[self.ends[y] : self.ends[y + 1]] for y in others])
        place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
        both = np.add.reduceat((mine[place] == theirs).astype(np.int64), np.append(0, np.cumsum(self.size[others])[:-1]))
        return both >= LEAST_SIMILARITY * (self.size[x] + self.size[others] - both)


def joining_pairs(sets: Sets, band: int, one: int, two: int) -> list[tuple[int, int]]:
    """Similar pairs across the two tiles that join the components to what all similar pairs join them to: fewer than there are sets.

    A pair belongs to the first band its sets share. One set of each component is looked at first, then more, since the
    first similar one settles the component.
    """
    names, root = np.unique(sets.component, return_inverse=True)
    root = root.astype(np.int64)
    left, right = np.flatnonzero(sets.part == one), np.flatnonzero(sets.part == two)
    found = []
    for n, x in enumerate(left):
        able = right[n + 1 :] if one == two else right
        able = able[root[able] != root[x]]
        able = able[np.minimum(sets.size[able], sets.size[x]) >= LEAST_SIMILARITY * np.maximum(sets.size[able], sets.size[x])]
        shared = sets.bands[able] == sets.bands[x]
        able = able[sets.bands[x][shared.argmax(axis=1)] == band] if len(able) else able
        taken = 1
        while len(able):
            order = np.argsort(root[able], kind="stable")
            able = able[order]
            nth = np.arange(len(able)) - np.searchsorted(root[able], root[able])
            some, able = able[nth < taken], able[nth >= taken]
            for y in some[sets.similar(x, some)]:
                if root[y] != root[x]:
                    found.append((int(sets.sid[x]), int(sets.sid[y])))
                    root[root == root[y]] = root[x]
            able = able[root[able] != root[x]]
            taken *= 4
    return found


def across(units: DataFrame) -> DataFrame:
    """u and v of the similar pairs that join components within each unit."""
    dealt = units.repartition("band", "one", "two").sortWithinPartitions("band", "one", "two")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (band, one, two), held in runs_of(batches):
            pairs = joining_pairs(Sets(held), band, one, two)
            yield pa.RecordBatch.from_arrays([pa.array([max(p) for p in pairs], pa.int64()), pa.array([min(p) for p in pairs], pa.int64())], names=["u", "v"])

    return dealt.mapInArrow(tidied(compare), "u long, v long")


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Key and rows of each run of rows with one (band, one, two)."""
    key, held = None, []
    for batch in batches:
        keys = np.column_stack([np.asarray(batch.column(k)).astype(np.int64) for k in range(3)])
        edges = np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1) if len(keys) else []
        for n, a in enumerate(edges):
            b = int(edges[n + 1]) if n + 1 < len(edges) else len(keys)
            if held and tuple(keys[a]) != key:
                yield key, held
                held = []
            key = tuple(keys[a])
            held.append(batch.slice(int(a), b - int(a)))
    if held:
        yield key, held


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash, class (a number), class_id (the smallest doc_id of the class) and class_size of every row.

    Documents of equal weighted shingles are one set; sets of similarity LEAST_SIMILARITY or more are linked, and a
    class is a component of links. Words are parted by white space and kept as they are; a document of one to four
    words is one shingle. A document without a word, or a null text, is a class of its own with class_id its doc_id
    and a null class number.
    Ids may repeat or be null; a class of null ids only has a null class_id.

    Sets in a bucket are compared to its least set first. Where a bucket still holds several components, those beside the
    largest are compared to one set of it, another one each round, until nothing more is joined. What is open then meets
    in tiles, where only pairs that join two components come out. So copies never make all pairs and no link is lost.
    """
    source = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    seen = written(sketched(source.select("doc_id", "text_hash", "text")), "sketches")
    # One row per distinct set; its number is fixed by writing the table.
    sets = seen.groupBy("high", "low", "weight").agg(F.min("text_hash").alias("text_hash")).withColumn("sid", F.monotonically_increasing_id())
    sets = written(sets, "sets")
    firsts = seen.select("high", "low", "text_hash", "bands").join(sets, ["high", "low", "text_hash"]).dropDuplicates(["sid"]).select("sid", "weight", "bands")
    firsts = written(firsts, "first-sketches")
    banded = firsts.select("sid", "weight", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("sid").alias("least"), F.max("sid").alias("most")).filter("least < most")
    buckets = written(buckets.select("band", "least"), "buckets")
    members = written(banded.join(buckets, "band").select("band", "least", "sid", "weight"), "members")
    involved = members.select("sid").distinct()
    texts = sets.join(involved, "sid", "left_semi").select("sid", "text_hash")
    texts = source.select("text_hash", "text").join(texts, "text_hash").select("sid", "text")
    elements = written(shingle_table(texts).dropDuplicates(["sid"]), "elements")
    weights = sets.select(F.col("sid").alias("least"), F.col("weight").alias("least_weight"))
    first = members.filter("sid > least").select("least", "sid", "weight").distinct().join(weights, "least")
    first = first.filter(size_fits(F.col("weight"), F.col("least_weight"))).select(F.col("sid").alias("u"), F.col("least").alias("v"))
    links = written(verified(first, elements), "links")
    parts = written(with_components(involved, links), "components")
    labels, links = parts, []
    for turn in range(REPRESENTATIVES):
        new = written(against_largest(still_apart(members, labels), elements, turn), "links")
        if new.isEmpty():
            break
        links.append(new)
        labels = relabelled(labels, new)
    links.append(written(across(units_of(still_apart(members, labels).join(sets.select("sid", "weight"), "sid"), firsts, elements)), "links"))
    final = joined_parts(parts, reduce(DataFrame.union, links)).select("sid", F.col("component").alias("final"))
    named = written(sets.join(final, "sid", "left").select("high", "low", F.coalesce("final", "sid").alias("class")), "set-classes")
    # The sets table has one row per set; a set of very many copies is split by the join on a derived key.
    mine = seen.select("doc_id", "text_hash", F.concat_ws(",", "high", "low").alias("k")).join(named.select(F.concat_ws(",", "high", "low").alias("k"), "class"), "k")
    mine = written(mine.select("doc_id", "text_hash", "class"), "classes")
    sizes = written(mine.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "class-sizes")
    classed = mine.join(sizes, "class").select("doc_id", "text_hash", "class", "class_id", "class_size")
    wordless = source.filter(~F.col("text").rlike(r"[^\x00-\x20]")).select("doc_id", "text_hash", F.lit(None).cast("long").alias("class"), F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return classed.union(wordless)


def still_apart(members: DataFrame, parts: DataFrame) -> DataFrame:
    """band, sid and component of the members of buckets that hold several components."""
    apart = members.select("band", "sid").join(parts, "sid")
    open_ = apart.groupBy("band").agg(F.min("component").alias("lowest"), F.max("component").alias("highest")).filter("lowest < highest")
    return written(apart.withColumn("k", F.struct("band")).join(open_.select(F.struct("band").alias("k")), "k", "left_semi").drop("k"), "open-members")


def relabelled(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components, each under the least name among its own and those it is linked to.

    Sets of one name are joined by links; chains of links are not followed to their end, which only the last step does.
    """
    cu, cv = (parts.select(F.col("sid").alias(n), F.col("component").alias(f"c{n}")) for n in "uv")
    met = links.join(cu, "u").join(cv, "v")
    least = met.select("cu", "cv").union(met.select("cv", "cu")).groupBy("cu").agg(F.min("cv").alias("least")).filter("least < cu")
    told = parts.withColumn("k", F.struct("component")).join(least.select(F.struct(F.col("cu").alias("component")).alias("k"), "least"), "k", "left")
    return written(told.select("sid", F.coalesce("least", "component").alias("component")), "components")


def joined_parts(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components after joining those that the links (of sets) join."""
    cu, cv = (parts.select(F.col("sid").alias(n), F.col("component").alias(f"c{n}")) for n in "uv")
    bridges = links.join(cu, "u").join(cv, "v").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    found = components(bridges).select(F.struct("u").alias("k"), F.col("component").alias("lower"))
    met = parts.withColumn("k", F.struct("component")).join(found.withColumn("k", F.struct(F.col("k.u").alias("component"))), "k", "left")
    return written(met.select("sid", F.coalesce("lower", "component").alias("component")), "components")


def with_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links).withColumnRenamed("u", "sid")
    return nodes.join(found, "sid", "left").select("sid", F.coalesce("component", "sid").alias("component"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with all its columns: that of the smallest id (null last), then of the smallest text hash.

    Documents without a word all stay, but of rows with equal id and text one stays.
    """
    classes = written(near_classes(docs, key, text), "near-classes")
    least = classes.filter("class is not null").groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("m"))
    # Nulls are told from values in the text of the key, and the row travels in a struct: no column of it can clash.
    name = lambda one, two: F.to_json(F.struct(one.cast("string").alias("id"), two.alias("hash")), {"ignoreNullFields": "false"})
    kept = least.select(F.col("m.doc_id"), F.col("m.text_hash")).union(classes.filter("class is null").select("doc_id", "text_hash").distinct())
    kept = kept.select(name(F.col("doc_id"), F.col("text_hash")).alias("key"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(name(F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))).alias("key"), F.struct(*columns).alias("row"))
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
