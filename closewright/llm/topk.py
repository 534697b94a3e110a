"""Exact top-k by integer inner product: term-at-a-time accumulation over blocks.

Rows become sparse integer rows (term = vector component). A block of candidates is turned into postings, one
list per term; each query scatters its weight times each posting into a dense array of scores for the block. The
k best of a block are cut out by partition selection and merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from closewright.llm.shared import written

SCALE = 1024
#: Rows of a block of candidates and of queries: what one task holds at a time.
BLOCK_ROWS, QUERY_ROWS = 2048, 512
#: A cell holds BLOCKS_PER_CELL blocks of candidates, or as many as leave CELLS cells, but at most MOST_BLOCKS: a join holds them at once.
BLOCKS_PER_CELL, CELLS, MOST_BLOCKS = 2, 256, 64
PACKED = "block long, ids array<long>, sizes array<int>, cells binary"


def quantised(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """key and cells (array of long): floor(scale * x) of each component.

    Left out are rows with a null id, and vectors that are null or hold a null or non-finite component.
    """
    x = F.col(vector)
    usable = F.col(key).isNotNull() & x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return vectors.filter(usable).select(F.col(key).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("cells"))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most `size` rows of each task's rows: ids, length of each vector, and all components as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.slice(at, size)
                cells = part.column(1)
                sizes = np.diff(np.asarray(cells.offsets))
                flat = np.asarray(cells.flatten()).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0], pa.int64()), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([sizes.tolist()], pa.list_(pa.int32())), pa.array([flat.tobytes()], pa.binary())],
                    names=["block", "ids", "sizes", "cells"],
                )

    numbered = rows.mapInArrow(pack, PACKED)
    return numbered.withColumn("block", F.monotonically_increasing_id())


def best_of_block(q_ids, q_sizes, q_cells, ids, sizes, cells, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Query id, candidate ids and scores: at least the k best of the block under (score, smaller id), ties cut."""
    ids, sizes = np.asarray(ids, np.int64), np.asarray(sizes, np.int64)
    values = np.frombuffer(cells, "<i8")
    row = np.repeat(np.arange(len(ids)), sizes)
    term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    held = values != 0
    row, term, values = row[held], term[held], values[held]
    order = np.argsort(term, kind="stable")
    row, values = row[order], values[order]
    bounds = np.searchsorted(term[order], np.arange((int(term.max()) if len(term) else -1) + 2))
    postings = [(row[a:b], values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    # The usual case: a term that every row holds is added without scattering.
    postings = [(None if len(r) == len(ids) else r, v) for r, v in postings]
    q_values, q_at = np.frombuffer(q_cells, "<i8"), np.append(0, np.cumsum(np.asarray(q_sizes, np.int64)))
    for j, query in enumerate(q_ids):
        scores = np.zeros(len(ids), np.int64)
        for t, weight in enumerate(q_values[q_at[j] : q_at[j + 1]].tolist()):
            if weight and t < len(postings):
                rows, posted = postings[t]
                if rows is None:
                    scores += weight * posted
                else:
                    scores[rows] += weight * posted  # a row stands once in a list
        able = np.flatnonzero(ids != query)
        if len(able) > k:
            low = np.partition(scores[able], len(able) - k)[len(able) - k]
            above, equal = able[scores[able] > low], able[scores[able] == low]
            need = k - len(above)
            equal = equal[np.argsort(ids[equal], kind="stable")[:need]]
            able = np.append(above, equal)
        yield query, ids[able], scores[able]


def cells_of(blocks: int) -> int:
    """Number of cells that so many blocks of candidates lie in. Each block of queries is copied to every cell."""
    return max(1, min(blocks // BLOCKS_PER_CELL, CELLS), -(-blocks // MOST_BLOCKS))


def best_of_run(parts: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> pa.RecordBatch:
    """The k best of each query of what several blocks gave for the same queries."""
    query = np.repeat(np.array([p[0] for p in parts], np.int64), [len(p[1]) for p in parts])
    ids, scores = (np.concatenate([np.empty(0, np.int64), *(p[at] for p in parts)]) for at in (1, 2))
    order = np.lexsort((ids, ~scores, query))  # ~ turns the order round and never overflows
    query = query[order]
    kept = np.arange(len(query)) - np.searchsorted(query, query) < k
    return pa.RecordBatch.from_arrays([pa.array(query[kept]), pa.array(ids[order][kept]), pa.array(scores[order][kept])], names=["query_id", "vec_id", "score"])


def exact_top_k(vectors: DataFrame, k: int = 10, every: int = 100, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query, ties to the smaller id.

    Queries are the rows whose id is divisible by `every`; candidates are all rows with another id. Vectors of
    different length meet in the components both have. Repeated rows are candidates each; a repeated query row is
    one query (its smallest vector). Fewer than k candidates give fewer rows; an empty table gives none. Blocks of
    queries meet blocks of candidates by an equality join on a cell number; a task scores one pair at a time and
    passes on the k best of a cell.
    """
    rows = quantised(vectors, key, vector)
    queries = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("cells").alias("cells"))
    data = written(packed(rows, BLOCK_ROWS), "candidate-blocks")
    asked = packed(queries, QUERY_ROWS)
    # Each block of candidates lies in one cell and each block of queries is dealt to all cells, so every two meet once.
    cells = cells_of(data.count())
    data = data.withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells)))
    dealt = asked.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("sizes").alias("q_sizes"), F.col("cells").alias("q_cells"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell"))
    # Spark takes the dealt blocks for no larger than the queries and would send all copies through the driver: hence the hint.
    pairs = dealt.join(data.hint("merge"), "cell").select("q_block", "cell", "q_ids", "q_sizes", "q_cells", "ids", "sizes", "cells")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, parts = None, []
        for batch in batches:
            for n in range(len(batch)):
                # The join gives the pairs of a block of queries and a cell one after the other.
                at = tuple(batch.column(c)[n].as_py() for c in range(2))
                if at != run and parts:
                    yield best_of_run(parts, k)
                    parts = []
                run = at
                parts += best_of_block(*(batch.column(c)[n].as_py() for c in range(2, 8)), k)
        if parts:
            yield best_of_run(parts, k)

    found = pairs.mapInArrow(score, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id")))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
