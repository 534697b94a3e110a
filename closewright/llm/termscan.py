"""Ranked lexical search without a document index: an automaton of the items' terms scans every text.

The distinct terms of a block of items, each between two guard spaces, make one Aho-Corasick automaton. A text becomes
bytes in which every separator is a space, so a match is a whole term and one pass counts each term's occurrences.
The automaton's output is the number of the term, which the items that hold it are listed under. A first scan adds up
the statistics of the corpus, a second one scores each document against all items of the block at once.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from closewright.llm.shared import written
from closewright.llm.textbytes import groups, utf8

#: Bytes of item text and number of items that one automaton is built from: what is sent to each task.
BLOCK_BYTES, BLOCK_ITEMS = 4 << 20, 2048
#: Cells of the score array held at once: documents of a group times items of the block.
CELLS = 1 << 20
#: Rows of one group of the last merge.
MERGE_ROWS = 100_000
SPACE = 32
# Separators are the ASCII characters that are neither digits nor letters; other bytes belong to terms.
_TERM_BYTE = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
FOLDED = bytes((b + 32 if 65 <= b <= 90 else b) if _TERM_BYTE[b] else SPACE for b in range(256))


@dataclass
class ItemBlock:
    """Terms of a block of items, and of each term the items that hold it with its repeats there."""

    name: str
    item_ids: list
    terms: list[str]
    items_of: list[np.ndarray]
    repeats_of: list[np.ndarray]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_documents: int = 0
    n_terms: int = 0

    def automaton(self) -> ahocorasick.Automaton:
        """One per Python worker and block; the last one built is kept."""
        if _BUILT.get("name") != self.name:
            found = ahocorasick.Automaton()
            for number, term in enumerate(self.terms):
                found.add_word(f" {term} ", number)
            if self.terms:
                found.make_automaton()
            _BUILT.update(name=self.name, automaton=found)
        return _BUILT["automaton"]


_BUILT: dict = {}


def terms_of(text: str | None) -> list[str]:
    """Terms of a text, each byte as the character of that number."""
    return (text or "").encode().translate(FOLDED).decode("latin-1").split(" ") if text else []


def block_of(rows: list) -> ItemBlock:
    """The block of (item_id, text) rows. Rows of one id are one item; an item without a term takes part in nothing."""
    held: dict = defaultdict(Counter)
    for item_id, text in rows:
        held[item_id].update(t for t in terms_of(text) if t)
    item_ids = sorted((i for i in held if held[i]), key=lambda i: (i is None, i))
    listed: dict[str, list] = defaultdict(list)
    for place, item_id in enumerate(item_ids):
        for term, n in held[item_id].items():
            listed[term].append((place, n))
    terms = sorted(listed)
    return ItemBlock(uuid.uuid4().hex, item_ids, terms, [np.array([p for p, _ in listed[t]]) for t in terms], [np.array([n for _, n in listed[t]]) for t in terms])


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[ItemBlock]:
    """Blocks of about BLOCK_BYTES of item text and BLOCK_ITEMS items; the driver holds one at a time."""
    rows = items.select(F.col(key).alias("item_id"), F.col(text).alias("text")).filter("text is not null").distinct()
    size, n = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.countDistinct(F.struct("item_id"))).first()
    count = max(1, -(-size // BLOCK_BYTES), -(-n // BLOCK_ITEMS))
    for place in range(count):
        mine = rows.filter(F.pmod(F.xxhash64(F.col("item_id")), F.lit(count)) == place)
        block = block_of([tuple(r) for r in mine.collect()])
        if block.item_ids:
            yield block


def term_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of terms of each text."""
    inside = _TERM_BYTE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    begins[cut] = inside[cut]
    sums = np.append(0, np.cumsum(begins))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def scanned(column: pa.Array, block: ItemBlock) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ranges of texts with their number of terms, and document in the range, term and tf of each match."""
    automaton = block.automaton()
    data, offsets = utf8(column)
    limit = max(1, CELLS // max(1, len(block.item_ids)))
    for a, b in groups(offsets):
        lengths = term_starts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        for c in range(a, b, limit):
            d = min(c + limit, b)
            documents, terms, counts = [], [], []
            for place in range(c, d):
                folded = b" " + data[offsets[place] : offsets[place + 1]].tobytes().translate(FOLDED) + b" "
                found = Counter(number for _, number in automaton.iter(folded.decode("latin-1")))
                documents.extend([place - c] * len(found))
                terms.extend(found.keys())
                counts.extend(found.values())
            yield c, d, lengths[c - a : d - a], np.array(documents, np.int64), np.array(terms, np.int64), np.array(counts, np.int64)


def corpus_statistics(docs: DataFrame, block: ItemBlock) -> tuple[int, int, np.ndarray]:
    """N, L and the df of each term of the block; each task returns its own sums."""
    n_terms = len(block.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms + 2, np.int64)
        for batch in batches:
            for _, _, lengths, _, terms, _ in scanned(batch.column(1), block):
                total[:n_terms] += np.bincount(terms, minlength=n_terms)
                total[n_terms] += int((lengths > 0).sum())
                total[n_terms + 1] += int(lengths.sum())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    summed = docs.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_terms + 2, np.int64)
    out[summed.column("cell").to_numpy()] = summed.column("n").to_numpy()
    return int(out[n_terms]), int(out[n_terms + 1]), out[:n_terms]


def scores(block: ItemBlock, lengths: np.ndarray, documents: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Items x documents scores, all in 64-bit integers."""
    out = np.zeros((len(block.item_ids), len(lengths)), np.int64)
    m = 75 + (25 * lengths * block.n_documents) // max(1, block.n_terms)
    order = np.argsort(terms, kind="stable")
    documents, terms, counts = documents[order], terms[order], counts[order]
    gain = block.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 12 * m[documents]))
    edges = np.append(np.flatnonzero(np.diff(terms, prepend=-1)), len(terms))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        term = terms[a]
        out[block.items_of[term][:, None], documents[a:b]] += block.repeats_of[term][:, None] * gain[a:b]
    return out


def best_in_tasks(docs: DataFrame, block: ItemBlock, k: int) -> DataFrame:
    """place (of the item in the block), doc_id and score: each task's k best documents of each item."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_place, held_id, held_none, held_score = (np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))
        least = np.zeros(len(block.item_ids), np.int64)  # a document must score at least so much, and above 0
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            none = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            for c, _, lengths, documents, terms, counts in scanned(batch.column(1), block):
                found = scores(block, lengths, documents, terms, counts)
                place, at = np.nonzero((found > 0) & (found >= least[:, None]))
                if not len(place):
                    continue
                held_place, held_score = np.append(held_place, place), np.append(held_score, found[place, at])
                held_id, held_none = np.append(held_id, ids[c + at]), np.append(held_none, none[c + at])
                order = np.lexsort((held_id, held_none, -held_score, held_place))
                place = held_place[order]
                nth = np.arange(len(place)) - np.searchsorted(place, place)
                order = order[nth < k]
                held_place, held_id, held_none, held_score = held_place[order], held_id[order], held_none[order], held_score[order]
                full = nth[nth < k] == k - 1
                least[held_place[full]] = held_score[full]
        yield pa.RecordBatch.from_arrays([pa.array(held_place), pa.array(held_id, mask=held_none), pa.array(held_score)], names=["place", "doc_id", "score"])

    return docs.mapInArrow(find, "place long, doc_id long, score long")


def best_of(rows: DataFrame, k: int, n_items: int) -> DataFrame:
    """rank and the k best rows of each place; groups of about MERGE_ROWS rows are cut to their k best first, round by round."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    parts = rows.count() // max(1, n_items) // MERGE_ROWS
    while parts > 0:
        salted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(parts + 1)))
        cut = F.row_number().over(Window.partitionBy("place", "part").orderBy(*order))
        rows = salted.withColumn("nth", cut).filter(F.col("nth") <= k).drop("nth", "part")
        parts = min(parts - 1, (parts + 1) * k // MERGE_ROWS)
    rank: Column = F.row_number().over(Window.partitionBy("place").orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score: the k best documents of each item.

    Equal scores stand by ascending doc_id, null ids last. A null or empty text has no term and is not ranked; repeated
    rows of documents each count and rank. Rows of one item_id are one item, whose terms are those of its distinct
    texts; an item without a term, or whose terms no document holds, gives no row; a null item_id is an id. Empty
    tables give no row. Other columns of either table are not read. Items beyond BLOCK_BYTES or BLOCK_ITEMS are dealt
    to several automata, and the documents are scanned twice for each.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("text is not null")
    kind = items.schema[item_key].dataType
    out = None
    corpus = None
    for block in item_blocks(items, item_key, item_text):
        n, length, df = corpus_statistics(rows, block)
        corpus = corpus or (n, length)
        block.n_documents, block.n_terms = corpus
        block.weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        best = best_of(written(best_in_tasks(rows, block, k), "term-scan"), k, len(block.item_ids))
        names = docs.sparkSession.createDataFrame([(p, i) for p, i in enumerate(block.item_ids)], f"place long, item_id {kind.simpleString()}")
        found = best.join(names, "place").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
