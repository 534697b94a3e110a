"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question with other numbers, other names or another
unit has the same template. A run of name words or of number parts is one placeholder. Windows of template words of
documents and benchmark items are joined by hash; those of one stretch count together, also where words were put in
or left out between them, and its slots must be filled consistently: equal fillers of the item are equal in the document.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.llm.shared import tidied, written
from closewright.llm.textbytes import BASE, BYTE_VALUE, U64, WORD_POWERS, groups, mixed, powers, utf8

#: Template words of a window, and how many of them must stand for themselves.
WINDOW, LITERALS = 8, 4
#: Share of an item's windows that a document must hold.
LEAST_SHARE = 0.5
#: Bits of the filter that document windows pass before the join: its size is fixed, whatever the benchmark's.
FILTER_BITS = 23
#: Bytes of texts taken at once: a byte takes some 60 bytes of working memory.
TAKEN_BYTES = 1 << 18
# Unit words.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg lb lbs pound pounds ounce ounces ton tons ml l litre litres liter liters "
    "gallon gallons second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros "
    "percent degree degrees celsius fahrenheit kelvin watt watts volt volts ampere amperes joule joules newton newtons pascal hz khz mhz ghz kmh mph"
).split()

_B = np.arange(256)
_DIGIT = (_B >= 48) & (_B <= 57)
_UPPER = (_B >= 65) & (_B <= 90)
_WORD = _DIGIT | _UPPER | (_B >= 97) & (_B <= 122) | (_B >= 128)
_LINKS = np.isin(_B, np.frombuffer(b" -/':", np.uint8))
_ENDS = np.isin(_B, np.frombuffer(b".!?\n:;|", np.uint8))
_FOLD = np.where(_UPPER, _B + 32, _B).astype(np.uint8)


# Code points of scripts without spaces between words; each letter is a word there.
UNSPACED = ((0x0E00, 0x0F00), (0x0F00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x1A00), (0x1A20, 0x1AB0), (0x3005, 0x3008), (0x3040, 0x3130), (0x31A0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xA9E0, 0xAA00), (0xAA60, 0xAAE0), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x20000, 0x40000))
PART, APART, LETTER, MARK = range(4)


@cache
def char_kinds() -> np.ndarray:
    """Kind of each code point: of a word, punctuation or space, a letter that is a word, or a mark upon one."""
    kinds = np.array([APART if unicodedata.category(chr(c))[0] == "P" or unicodedata.category(chr(c)) in ("Zs", "Zl", "Zp", "Cc") else PART for c in range(0x20000)], np.uint8)
    kinds = np.append(kinds, np.zeros(0x110000 - len(kinds), np.uint8))
    for a, b in UNSPACED:
        some = kinds[a:b]
        marks = np.array([b - a < 0x10000 and unicodedata.category(chr(c))[0] == "M" for c in range(a, b)])
        some[some == PART] = LETTER
        some[marks] = MARK
    return kinds


def unicode_words(data: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Marks in `inside` the bytes of non-ASCII punctuation and space as no word's; whether a word begins anew at each byte."""
    anew = np.zeros(len(data), bool)
    lead = np.flatnonzero(data >= 0xC0)
    wide = 2 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
    point = data[lead].astype(np.int64) & (0x7F >> wide)
    for k in range(1, 4):
        more = wide > k
        point[more] = point[more] << 6 | data[lead[more] + k] & 0x3F
    kind = char_kinds()[point]
    for k in range(4):
        inside[lead[(kind == APART) & (wide > k)] + k] = False
    anew[lead[kind == LETTER]] = True
    after = (lead + wide)[(kind == LETTER) | (kind == MARK)]
    anew[after[after < len(data)]] = True
    anew[lead[kind == MARK]] = False
    return anew


def words_of(data: np.ndarray, offsets: np.ndarray):
    """Words of the texts: first and last byte, text, folded hash, and per-byte marks.

    A word is a run of ASCII letters, digits and non-ASCII characters but punctuation and space; in scripts without
    spaces it is one letter with its marks.
    """
    inside = _WORD[data]
    anew = unicode_words(data, inside) if len(data) and data.max() >= 0xC0 else np.zeros(len(data), bool)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | anew[1:]
    ends[:-1] &= ~inside[1:] | anew[1:]
    border = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[border] = inside[border]
    ends[border - 1] = inside[border - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    folded, upper = _FOLD[data], _UPPER[data]
    # Capital letters of the two-byte Latin block.
    latin = np.zeros(len(data), bool)
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded[latin] += 0x20
    upper[:-1] |= latin[1:]
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data)))) if len(first) and first[0] == 0 else None
    if place is None and len(first):
        place = np.append(np.zeros(first[0], np.int64), np.arange(first[0], len(data)) - np.repeat(first, np.diff(np.append(first, len(data)))))
    if not len(first):
        return first, last, np.zeros(0, np.int64), np.zeros(0, np.uint64), upper
    terms = np.where(inside, BYTE_VALUE[folded] * WORD_POWERS[place & 0xFFFF], U64(0))
    return first, last, np.searchsorted(offsets, first, side="right") - 1, mixed(np.add.reduceat(terms, first)), upper


def _unit_hashes() -> np.ndarray:
    held = [np.frombuffer(u.encode(), np.uint8) for u in UNITS]
    at = np.append(0, np.cumsum([len(h) for h in held]))
    return np.sort(words_of(np.concatenate(held), at)[3])


UNIT_HASHES = _unit_hashes()
NUMBER, NAME, UNIT = (U64(x) for x in (1, 2, 3))


def parsed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """What `templates` gives, and of each template word whether it is a capitalised sentence opener, and whether it is close to the one before.

    Number: a word that begins with a digit (decimal and thousands parts join it). Unit: a word of UNITS. Name: a
    capitalised word, not wholly in capitals, that does not begin a sentence. White space and punctuation do not count.
    """
    first, last, text, hashes, upper = words_of(data, offsets)
    if not len(first):
        return text, hashes, hashes, np.zeros(0, bool), np.zeros(0, bool), np.zeros(0, bool)
    digit = _DIGIT[data[first]]
    gap = np.append(1 << 30, first[1:] - last[:-1])
    joins = np.zeros(len(first), bool)
    joins[1:] = digit[1:] & digit[:-1] & (gap[1:] == 1) & (text[1:] == text[:-1]) & np.isin(data[last[:-1].clip(max=len(data) - 1)], (44, 46))
    n_ends = np.append(0, np.cumsum(_ENDS[data]))
    begins = np.ones(len(first), bool)
    begins[1:] = (text[1:] != text[:-1]) | (n_ends[first[1:]] > n_ends[last[:-1]])
    n_upper = np.append(0, np.cumsum(upper))
    capital = upper[first] & (n_upper[last] - n_upper[first] < last - first - (data[first] >= 128))
    unit = UNIT_HASHES[np.searchsorted(UNIT_HASHES, hashes).clip(max=len(UNIT_HASHES) - 1)] == hashes
    named = capital & ~digit & ~unit
    name = named & ~begins
    close = np.zeros(len(first), bool)
    close[1:] = (gap[1:] == 1) & (text[1:] == text[:-1]) & _LINKS[data[last[:-1].clip(max=len(data) - 1)]] & (digit[1:] | ~begins[1:])
    shown = np.where(digit, NUMBER, np.where(unit, UNIT, np.where(name, NAME, hashes)))
    whole = ~joins
    # The filler of a number covers its parts.
    filler = np.add.reduceat(hashes * np.where(joins, U64(0x9E3779B97F4A7C15), U64(1)), np.flatnonzero(whole))
    return text[whole], shown[whole], filler, (digit | unit | name)[whole], (named & begins)[whole], close[whole]


def templates(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text index, template hash, filler hash and whether it is a slot, of each template word."""
    return parsed(data, offsets)[:4]


def collapsed(owner: np.ndarray, shown: np.ndarray, filler: np.ndarray, slot: np.ndarray, close: np.ndarray) -> tuple[np.ndarray, ...]:
    """First word, template hash, filler hash and slot mark of each run: close names, or close numbers, are one placeholder."""
    joins = np.zeros(len(owner), bool)
    joins[1:] = close[1:] & slot[1:] & slot[:-1] & (shown[1:] == shown[:-1]) & ((shown[1:] == NUMBER) | (shown[1:] == NAME))
    at = np.flatnonzero(~joins)
    if not len(at):
        return at, shown, filler, slot
    nth = np.arange(len(owner)) - np.repeat(at, np.diff(np.append(at, len(owner))))
    return at, shown[at], np.add.reduceat(filler * WORD_POWERS[nth & 0xFFFF], at), slot[at]


def windows(shown: np.ndarray, slot: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each window of `size` words within a text that holds enough literal words."""
    count = len(shown) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(count, U64(size))
    for k in range(size):
        h = h * U64(0x9E3779B97F4A7C15) + shown[k : k + count]
    literal = np.append(0, np.cumsum(~slot))
    able = (text[:count] == text[size - 1 :]) & (literal[size:] - literal[:count] >= LITERALS)
    at = np.flatnonzero(able)
    return at, mixed(h[at])


#: Powers of the hash of whole texts, modulo 2**64, and of its inverse.
UNBASE = pow(BASE, -1, 1 << 64)


def whole_hashes(words: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each run of `size` words within a text, by differences of running sums: no slot, every word counts."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.append(U64(0), np.cumsum(mixed(words) * powers(BASE, len(words)), dtype=np.uint64))
    at = np.flatnonzero(text[:count] == text[size - 1 :])
    return at, mixed((sums[at + size] - sums[at]) * powers(UNBASE, count)[at])


FOUND = "place long, size int, hash long, fillers array<long>, spots array<long>"


def window_rows(rows: DataFrame, keys: list[str], text: str, sizes: list[int] | None, passing: bytes | None = None) -> DataFrame:
    """keys, place, size, hash, fillers and places (of the slots, in order) of the windows of each text.

    Without `sizes`, each text has windows of WINDOW words, or one of all its words if it has fewer. One without
    such a window, but with a word, is one exact run of its folded words; the size of exact runs is negative. A capitalised
    sentence opener may be a name or not: a window with such words is given in both readings. Places count the words
    before names and numbers are joined. `passing` is the filter's bits: other windows are left out, as they can meet
    no partner in the join.
    """
    source = rows.select(*keys, F.col(text).alias("__text"))
    declared = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    bits = None if passing is None else np.frombuffer(passing, np.uint8)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(len(keys)))
            for a, b in groups(offsets, TAKEN_BYTES):
                owner, shown, filler, slot, opener, close = parsed(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                begin = np.append(0, np.cumsum(np.bincount(owner, minlength=b - a)))
                bare = np.ones(b - a, bool)
                for reading in (False, True) if opener.any() else (False,):
                    word, shape, fills, gaps = collapsed(owner, np.where(opener, NAME, shown) if reading else shown, filler, slot | opener if reading else slot, close)
                    of = owner[word]
                    n_words = np.bincount(of, minlength=b - a)
                    n_openers = np.append(0, np.cumsum(opener[word]))
                    for size in [n for n in sizes if n > 0] if sizes else [WINDOW, *sorted(set(n_words[n_words < WINDOW].tolist()) - {0})]:
                        at, h = windows(shape, gaps, of, size)
                        able = n_words[of[at]] == size if sizes is None and size < WINDOW else np.ones(len(at), bool)
                        if reading:
                            able &= n_openers[at + size] > n_openers[at]
                        if bits is not None:
                            cell = (h >> U64(64 - FILTER_BITS)).astype(np.int64)
                            able &= (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
                        at, h = at[able], h[able]
                        if not len(at):
                            continue
                        mine = of[at]
                        bare[mine] = False
                        held = [p + np.flatnonzero(gaps[p : p + size]) for p in at.tolist()]
                        slots = [fills[x].astype(np.int64).tolist() for x in held]
                        spots = [(word[x] - begin[m]).tolist() for x, m in zip(held, mine.tolist(), strict=True)]
                        taken = pa.array(mine + a)
                        yield pa.RecordBatch.from_arrays(
                            [*(batch.column(k).take(taken) for k in range(len(keys))), pa.array(word[at] - begin[mine]), pa.array(np.full(len(at), size, np.int32)), pa.array(h.astype(np.int64)), pa.array(slots, pa.list_(pa.int64())), pa.array(spots, pa.list_(pa.int64()))],
                            names=[*keys, "place", "size", "hash", "fillers", "spots"],
                        )
                n_words = np.bincount(owner, minlength=b - a)
                for size in [-n for n in sizes if n < 0] if sizes else sorted(set(n_words[bare].tolist()) - {0}):
                    at, h = whole_hashes(filler, owner, size)
                    if sizes is None:
                        able = bare[owner[at]] & (n_words[owner[at]] == size)
                    else:
                        cell = (h >> U64(64 - FILTER_BITS)).astype(np.int64)
                        able = (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
                    at, h = at[able], h[able]
                    if len(at):
                        mine = owner[at]
                        taken, none = pa.array(mine + a), pa.array([[]] * len(at), pa.list_(pa.int64()))
                        yield pa.RecordBatch.from_arrays([*(batch.column(k).take(taken) for k in range(len(keys))), pa.array(at - begin[mine]), pa.array(np.full(len(at), -size, np.int32)), pa.array(h.astype(np.int64)), none, none], names=[*keys, "place", "size", "hash", "fillers", "spots"])

    return source.mapInArrow(tidied(find), f"{declared}, {FOUND}")


def filter_bits(hashes: DataFrame) -> bytes:
    """Bit set of the leading FILTER_BITS bits of each hash: 2**FILTER_BITS bits, whatever the number of hashes."""
    cell = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    cells = hashes.select(F.shiftright(cell, 3).alias("byte"), F.element_at(F.array(*(F.lit(1 << k) for k in range(8))), cell.bitwiseAND(7).cast("int") + 1).alias("bit"))
    held = cells.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    out[held.column("byte").to_numpy().astype(np.int64)] = held.column("bits").to_numpy().astype(np.uint8)
    return out.tobytes()


def sound(met: list[dict]) -> tuple[int, int]:
    """Number of windows whose slots are filled consistently, and of changed fillers in them, negative: fewer are better.

    Equal fillers of the item are filled equally: each has the filler that more than half of its places hold, or none,
    and a window with another one does not count. Different fillers of the item may have the same.
    """
    places = {x for m in met for x in zip(m["theirs"], m["spots"], m["mine"], strict=True)}
    votes = Counter((b, a) for b, _, a in places)
    of = Counter(b for b, _, _ in places)
    held = {pair for pair, n in votes.items() if 2 * n > of[pair[0]]}
    kept = [m for m in met if all(x in held for x in zip(m["theirs"], m["mine"], strict=True))]
    return len(kept), -sum(b != a for b, a in {x for m in kept for x in zip(m["theirs"], m["mine"], strict=True)})


def stretch(met: list[dict], cell: int, width: int) -> tuple[int, int]:
    """The most windows of an item, and their changed fillers, that one stretch of a document holds.

    A stretch is an alignment (one shift between the places of item and document), with the nearest other alignment up
    to `width` words away wherever it lacks a window; its own windows alone are tried as well.
    """
    met = sorted(met, key=lambda m: (m["place"], sum(a != b for a, b in zip(m["mine"], m["theirs"], strict=True)), m["shift"], m["mine"], m["theirs"]))
    best = (0, 0)
    for shift in sorted({m["shift"] for m in met if m["shift"] // width == cell}):
        near: dict[int, dict] = {}
        for m in met:
            away = abs(m["shift"] - shift)
            if away <= width and (m["place"] not in near or away < abs(near[m["place"]]["shift"] - shift)):
                near[m["place"]] = m
        best = max(best, sound(list(near.values())), sound([m for m in near.values() if m["shift"] == shift]))
    return best


def stretches(lined: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, n_item, n and changed (negative) of each row of matches by `stretch`."""
    keys = ["doc_id", "text_hash", "item_id", "n_item"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [stretch(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("met", "cell", "width")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *(pa.array([x[k] for x in best], pa.int64()) for k in range(2))], names=[*keys, "n", "changed"])

    declared = ", ".join(f"`{k}` {lined.schema[k].dataType.simpleString()}" for k in keys)
    return lined.mapInArrow(tidied(find), f"{declared}, n long, changed long")


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, n_windows, share, n_reparameterised, exact_words: the documents that hold benchmark items.

    A pair counts if windows of one stretch, whose slots are filled consistently, cover at least LEAST_SHARE of the
    item's windows. An item with fewer than LITERALS literal words in every window is found where all its words stand
    as they are but for case, however few they are; exact_words is their number there, and null elsewhere, so that items of
    a word or two can be told apart. One without a word cannot be found. Null texts are empty and hold nothing; repeated rows count once per id and text. No document or item, no row.
    """
    named = items.select(F.col(item_key).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("item_text"))
    known = written(window_rows(named, ["item_id"], "item_text", None).distinct(), "item-windows")
    total = known.groupBy(F.col("item_id").alias("__item")).agg(F.countDistinct("place").alias("n_item"), (F.max("place") + WINDOW).alias("width"), F.when(F.min("size") < 0, -F.min("size")).alias("exact_words"))
    sized = known.join(total, F.col("item_id").eqNullSafe(F.col("__item"))).drop("__item")
    sizes = sorted(r[0] for r in known.select("size").distinct().collect())  # WINDOW at most, and the lengths of exact runs
    source = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(text), F.lit("")).alias("doc_text"))
    if not sizes:
        sizes = [WINDOW]
    held = window_rows(source, ["doc_id", "text_hash"], "doc_text", sizes, filter_bits(known))
    met = held.alias("d").join(sized.alias("b"), (F.col("d.hash") == F.col("b.hash")) & (F.col("d.size") == F.col("b.size")) & (F.size("d.fillers") == F.size("b.fillers")))
    shift = F.col("d.place") - F.col("b.place")
    met = met.select("d.doc_id", "d.text_hash", "b.item_id", "n_item", "width", F.floor(shift / F.col("width")).alias("home"), F.struct(F.col("b.place").alias("place"), shift.alias("shift"), F.col("d.fillers").alias("mine"), F.col("b.fillers").alias("theirs"), F.col("b.spots").alias("spots")).alias("one"))
    # A cell holds the shifts up to one width away from its own: its windows are bounded by the item's length.
    dealt = met.select("*", F.explode(F.sequence(F.col("home") - 1, F.col("home") + 1)).alias("cell"))
    lined = dealt.groupBy("doc_id", "text_hash", "item_id", "n_item", "width", "cell").agg(F.collect_set("one").alias("met"), F.max(F.col("cell") == F.col("home")).alias("own"))
    lined = lined.filter(F.col("own") & (F.size(F.array_distinct(F.col("met.place"))) / F.col("n_item") >= LEAST_SHARE))
    pairs = stretches(lined).groupBy("doc_id", "text_hash", "item_id", "n_item").agg(F.max(F.struct("n", "changed")).alias("best"))
    share = F.col("best.n") / F.col("n_item")
    found = pairs.filter(share >= LEAST_SHARE).select("doc_id", "text_hash", "item_id", F.col("best.n").alias("n_windows"), share.alias("share"), (-F.col("best.changed")).alias("n_reparameterised"))
    # The items' run lengths: few rows for each item, joined with null items told from values.
    runs = total.select(F.struct(F.col("__item").isNull().alias("none"), F.coalesce(F.col("__item").cast("string"), F.lit("")).alias("item")).alias("k"), "exact_words")
    return found.withColumn("k", F.struct(F.col("item_id").isNull().alias("none"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"))).join(runs, "k", "left").drop("k")


def without_leaks(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no item. Rows are told apart by id and text; repeated rows go or stay together."""
    # Nulls are told from values in the text of the key, and the row travels in a struct: no column of it can clash.
    name = lambda one, two: F.to_json(F.struct(one.cast("string").alias("id"), two.alias("hash")), {"ignoreNullFields": "false"})
    marks = found.select(name(F.col("doc_id"), F.col("text_hash")).alias("key")).distinct()
    rows = docs.select(name(F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(marks, "key", "left_anti").select("row.*")
