"""SimHash near-duplicates by a self-join of the binary trie of the fingerprints.

Two nodes of equal depth are visited together with the bits in which their prefixes differ; a pair of nodes whose
prefixes differ in more bits than the budget is pruned with everything below it. The upper levels of the trie are
joined by Spark, four bits a round, until both nodes of a pair are small; each pair of small nodes is then a row whose
sorted fingerprints one task walks down bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.llm.components import components
from closewright.llm.shared import written
from closewright.llm.textbytes import utf8

SHINGLE_WORDS, SEED = 3, 42
BITS, MOST_DIFFERING = 64, 3
#: Fingerprints of a node that is not divided further, and bits of a round of division.
NODE_SIZE, STEP = 1 << 14, 4
#: Pairs of nodes walked at once, and bytes of a text or hashes taken at once: these bound a task's memory.
FRONTIER, TAKEN_BYTES, TAKEN_HASHES = 1 << 18, 1 << 22, 1 << 16
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACES = b"\t\n\v\f\r "


def pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut at white space into parts of at least TAKEN_BYTES (a longer word stays whole)."""
    at = 0
    while len(text) - at > TAKEN_BYTES:
        ends = [e for e in (text.find(s, at + TAKEN_BYTES) for s in (bytes([c]) for c in _SPACES)) if e >= 0]
        if not ends:
            break
        yield text[at : min(ends)]
        at = min(ends)
    yield text[at:]


def shingle_hashes(text: bytes, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """XXH64 of each run of `size` words, in parts; of all words if there are fewer; nothing without a word."""
    digest = xxhash.xxh64_intdigest
    carried: list[bytes] = []
    any_run = False
    for piece in pieces(text.translate(LOWERED)):
        words = carried + piece.split()
        for at in range(0, max(0, len(words) - size + 1), TAKEN_HASHES):
            some = words[at : at + TAKEN_HASHES + size - 1]
            runs = zip(*(some[k:] for k in range(size)), strict=False)
            any_run = True
            yield np.fromiter((digest(b" ".join(r), SEED) for r in runs), np.uint64)
        carried = words[-(size - 1) :] if size > 1 else []
    if carried and not any_run:
        yield np.array([digest(b" ".join(carried), SEED)], np.uint64)


def fingerprint(text: bytes) -> int:
    """The bits that are set in over half the hashes, as an unsigned number; 0 without a word."""
    total, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id and print (the fingerprint's bits as a long) of every row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            held = [fingerprint(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(held, np.uint64).view(np.int64))], names=["doc_id", "print"])

    return rows.mapInArrow(find, f"doc_id {kind}, print long")


def ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def close_pairs(left: np.ndarray, right: np.ndarray, same: bool, depth: int, budget: int = MOST_DIFFERING) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in two sorted arrays of unsigned fingerprints, each of one prefix of `depth` bits, that differ in at most `budget` bits.

    With `same` the arrays are one, and each pair is met once. A pair of nodes is two ranges of places; parts of the
    frontier are walked one after another, so its size stays bounded.
    """
    zeros = {}
    for name, values in (("l", left), ("r", right)):
        bits = ((values[None, :] >> np.arange(BITS - 1, -1, -1, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.int32)
        zeros[name] = np.concatenate([np.zeros((BITS, 1), np.int32), np.cumsum(1 - bits, axis=1, dtype=np.int32)], axis=1)
    start = int(np.bitwise_count((left[0] ^ right[0]) >> np.uint64(BITS - depth))) if depth and len(left) and len(right) else 0
    one = lambda v: np.array([v], np.int32)
    waiting = [(depth, one(0), one(len(left)), one(0), one(len(right)), one(start))] if len(left) and len(right) and start <= budget else []
    while waiting:
        at, lo, hi, low, high, differ = waiting.pop()
        leaf = (hi - lo == 1) & (high - low == 1)
        if leaf.any():
            a, b = lo[leaf], low[leaf]
            near = ones(left[a] ^ right[b]) <= budget
            if same:
                near &= a != b
            yield a[near], b[near]
            lo, hi, low, high, differ = (x[~leaf] for x in (lo, hi, low, high, differ))
        if not len(lo) or at == BITS:
            continue
        mid = lo + zeros["l"][at][hi] - zeros["l"][at][lo]
        middle = low + zeros["r"][at][high] - zeros["r"][at][low]
        halves, others = ((lo, mid), (mid, hi)), ((low, middle), (middle, high))
        parts = []
        for x in (0, 1):
            for y in (0, 1):
                (a, b), (c, d) = halves[x], others[y]
                able = (b > a) & (d > c) & (differ + (x != y) <= budget)
                if same and x > y:  # of a node and itself, only one of the two mixed pairs
                    able &= (lo != low) | (hi != high)
                parts.append((a[able], b[able], c[able], d[able], differ[able] + np.int32(x != y)))
        lo, hi, low, high, differ = (np.concatenate(p) for p in zip(*parts, strict=True))
        for k in range(0, len(lo), FRONTIER):
            waiting.append((at + 1, *(x[k : k + FRONTIER] for x in (lo, hi, low, high, differ))))


def united(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place each place is joined to, after joining all a to b; `root` is such an array."""
    while True:
        one, two = root[a], root[b]
        apart = one != two
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(one, two)[apart], np.minimum(one, two)[apart])
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def links_of(left: np.ndarray, right: np.ndarray, same: bool, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the fingerprints as all close pairs would: fewer than there are fingerprints."""
    values = left if same else np.append(left, right)
    root = np.arange(len(values))
    for a, b in close_pairs(left, right, same, depth):
        root = united(root, a, b if same else b + len(left))
    joined = np.flatnonzero(root != np.arange(len(values)))
    return values[joined], values[root[joined]]


def prefix(depth: int):
    """The first bits of the fingerprint, as a number."""
    return F.shiftrightunsigned("print", BITS - depth) if depth else F.lit(0).cast("long")


def divided(prints: DataFrame) -> DataFrame:
    """depth, u, v of the pairs of nodes, u <= v, that together hold every close pair, both of at most NODE_SIZE fingerprints.

    Each round divides the nodes of the pairs that still have a larger node by STEP bits. Counting and pairing are
    joins by the parent node, which has 2 ** STEP children at most, whatever the number of fingerprints.
    """
    spark = prints.sparkSession
    pairs = spark.createDataFrame([(0, 0, 0)], "u long, v long, differ int")
    held, depth = None, 0
    sizes = prints.agg(F.lit(0).cast("long").alias("node"), F.count("*").alias("n"))
    while True:
        met = pairs.join(sizes.select(F.col("node").alias("u"), F.col("n").alias("nu")), "u").join(sizes.select(F.col("node").alias("v"), F.col("n").alias("nv")), "v")
        met = written(met, "node-pairs")
        small = (F.col("nu") <= NODE_SIZE) & (F.col("nv") <= NODE_SIZE)
        done = met.filter(small if depth < BITS else F.lit(True)).select(F.lit(depth).alias("depth"), "u", "v")
        held = done if held is None else held.union(done)
        open_ = met.filter(~small)
        if depth == BITS or open_.isEmpty():
            return held
        depth += STEP
        sizes = written(prints.groupBy(prefix(depth).alias("node")).agg(F.count("*").alias("n")), "node-sizes")
        child = sizes.select("node", F.shiftrightunsigned("node", STEP).alias("parent"))
        pairs = open_.join(child.select(F.col("node").alias("cu"), F.col("parent").alias("u")), "u").join(child.select(F.col("node").alias("cv"), F.col("parent").alias("v")), "v")
        differ = F.col("differ") + F.bit_count(F.col("cu").bitwiseXOR(F.col("cv")).bitwiseAND(F.lit((1 << STEP) - 1)))
        # Of a node and itself each two children are met once.
        pairs = pairs.filter((F.col("u") != F.col("v")) | (F.col("cu") <= F.col("cv"))).select(F.col("cu").alias("u"), F.col("cv").alias("v"), differ.cast("int").alias("differ")).filter(F.col("differ") <= MOST_DIFFERING)


def trie_links(prints: DataFrame) -> DataFrame:
    """u and v (fingerprints as longs) of links that join what lies within MOST_DIFFERING bits; `prints` holds each fingerprint once."""
    units = written(divided(prints), "trie-units")
    depths = [r.depth for r in units.select("depth").distinct().collect()]  # at most BITS / STEP + 1 rows
    nodes = units.select("depth", F.col("u").alias("node")).union(units.select("depth", F.col("v").alias("node"))).distinct()
    placed = prints.withColumn("at", F.explode(F.array(*(F.struct(F.lit(d).alias("depth"), prefix(d).alias("node")) for d in sorted(depths)))) if depths else F.lit(None).cast("struct<depth:int,node:long>"))
    packed = placed.select("at.depth", "at.node", "print").join(nodes, ["depth", "node"]).groupBy("depth", "node").agg(F.collect_list("print").alias("held"))
    packed = written(packed, "trie-nodes")
    left = packed.select("depth", F.col("node").alias("u"), F.col("held").alias("mine"))
    right = packed.select("depth", F.col("node").alias("v"), F.col("held").alias("theirs"))
    work = units.join(left, ["depth", "u"]).join(right, ["depth", "v"]).select("depth", (F.col("u") == F.col("v")).alias("same"), "mine", "theirs")
    # Units are dealt anew: neighbours in the joins' order would load some tasks with many large ones.
    work = work.repartition(F.xxhash64("depth", F.monotonically_increasing_id()))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                mine, theirs = (np.sort(np.asarray(batch.column(c)[n].values).astype(np.int64).view(np.uint64)) for c in (2, 3))
                a, b = links_of(mine, theirs, batch.column(1)[n].as_py(), batch.column(0)[n].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])

    return work.mapInArrow(walk, "u long, v long")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id and n_prints (distinct fingerprints of the component) of every row.

    Fingerprints link at MOST_DIFFERING or fewer differing bits; component_id is the smallest doc_id that links reach.
    A null text and one without a word have the fingerprint zero, which links like any other. Rows of equal
    fingerprint are one node of the trie; a repeated row gets its row again. Null ids do not count as smallest, and a
    component of null ids only has a null component_id. An empty table gives none; other columns are not read.
    """
    seen = written(fingerprints(docs, key, text), "fingerprints")
    prints = written(seen.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-prints")
    links = written(trie_links(prints.select("print")), "trie-links")
    joined = components(links).withColumnRenamed("u", "print")
    placed = written(prints.join(joined, "print", "left").select("print", "least", F.coalesce("component", "print").alias("component")), "print-components")
    sizes = placed.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n_prints"))
    # Joined by a derived key, a component or fingerprint that very many rows share can be split over tasks.
    key_of = lambda c: F.concat(F.col(c).cast("string"), F.lit("|"))
    named = placed.select("print", key_of("component").alias("k")).join(sizes.select(key_of("component").alias("k"), "component_id", "n_prints"), "k")
    named = written(named.select(key_of("print").alias("k"), "component_id", "n_prints"), "named-prints")
    found = seen.withColumn("k", key_of("print")).join(named, "k")
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id", "n_prints")
