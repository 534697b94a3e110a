"""BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a word there is exactly one token that ends its encoding. An automaton over the
vocabulary lists the tokens that end at a position; the one that is compatible with the last token of the
prefix before it is stored, and following these back gives the ids. No merge is ever replayed.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import pairwise
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.llm.shared import tidied
from closewright.llm.textbytes import groups, utf8

#: Bytes of texts whose chunks are looked up together.
TAKEN_BYTES = 1 << 20
#: Bytes of chunks and ids kept per task in each of two generations, and the longest chunk kept; this bounds memory and changes no result.
KEPT_BYTES, KEPT_LETTERS = 48 << 20, 48
#: What an entry takes besides its letters, and neighbouring tokens whose fit is kept.
_ENTRY, _KEPT_FITS = 170, 200_000
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: str.split() parts at these as well, which are no white space for the tokenizer.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = [""] * 256, 256
    for b in range(256):
        letters[b] = chr(b if b in shown else spare)
        spare += b not in shown
    return letters


class Numbers(dict):
    """A number for each chunk, given out as chunks are met."""

    def __missing__(self, raw: str) -> int:
        number = self[raw] = len(self)
        return number


def joined(parts: pa.Array, places: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The parts at the places, one after the other, and the byte at which each run of places that `ends` parts begins."""
    taken = parts.take(pa.array(places))
    upto = np.frombuffer(taken.buffers()[1], np.int64, len(places) + 1)[ends]
    return (taken.buffers()[2] or pa.py_buffer(b"")).to_pybytes(), upto


class PrefixEncoder:
    """The tokenizer of one vocabulary file: white space dropped, lower case, words ending in a mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.spelling = dict(enumerate(byte_letters()))
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = self.vocab[left], self.vocab[right]
            self.rank[pair] = rank
            self.parts[self.vocab[left + right]] = pair
        # The mark counts as one letter, so that only a token with it can end a word.
        self.mark = "\x00"
        # Text in the letters of the automaton; the letter before a mark belongs to it.
        self.automaton = ahocorasick.Automaton()
        for token, i in self.vocab.items():
            spelled = token.removesuffix(self.end) + self.mark if token.endswith(self.end) else token
            self.automaton.add_word(spelled, (i, len(spelled)))
        self.automaton.make_automaton()
        self.special_at = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._special = {t: pack("<I", i) for t, i in self.special.items()}
        self.shown = pa.array([f"{self.names.get(i, '')} ".encode() for i in range(max(self.names) + 1)], pa.large_binary())
        self._edges: dict[tuple[int, bool], list[tuple[int, float]]] = {}
        self._fits: dict[int, bool] = {}
        # Ids of chunks and of their pieces, in two generations: the older is dropped when the younger is full.
        self._known: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._bytes = 0

    def edge(self, token: int, right: bool) -> list[tuple[int, float]]:
        """Pieces that stand at one edge of a token while it is merged, each with the rank of the merge that ends it."""
        found = self._edges.get((token, right))
        if found is None:
            found, ends, piece = [], float("inf"), token
            while True:
                found.append((piece, ends))
                if piece not in self.parts:
                    break
                ends, piece = self.rank[self.parts[piece]], self.parts[piece][right]
            self._edges[token, right] = found
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay apart: no merge over their border comes before those inside them.

        Of equal merges the leftmost comes first, so one inside the left token precedes one over the border.
        """
        found, rank = True, self.rank
        for a, a_ends in self.edge(left, True):
            for b, b_ends in self.edge(right, False):
                over = rank.get((a, b))
                if over is not None and over < a_ends and over <= b_ends:
                    found = False
        if len(self._fits) > _KEPT_FITS:
            self._fits.clear()
        self._fits[left << 20 | right] = found
        return found

    def encode_word(self, letters: str) -> tuple[int, ...]:
        """Ids of one word, spelled in byte letters."""
        whole = self.vocab.get(letters + self.end)
        if whole is not None:
            return (whole,)
        spelled = letters + self.mark
        n, known, fits = len(spelled), self._fits, self.fits
        last: list[tuple[int, int] | None] = [None] * n
        for at, found in self.automaton.iter(spelled):  # of one end, the longest comes first
            if last[at] is None:
                token, length = found
                if at >= length:
                    before = last[at - length]
                    if before is None:
                        continue
                    fit = known.get(before[0] << 20 | token)
                    if not (fits(before[0], token) if fit is None else fit):
                        continue
                last[at] = found
        ids, at = [], n - 1
        while at >= 0:
            token, length = last[at]
            ids.append(token)
            at -= length
        return tuple(reversed(ids))

    def chunk(self, raw: str) -> bytes:
        """Ids (as little-endian 32-bit integers) of a text without white space."""
        found = self._old.get(raw)
        if found is None:
            if raw.isascii():
                text = raw.lower()
                pieces = (text,) if text.isalpha() else _ASCII_PIECES.findall(text)
            else:
                text = unicodedata.normalize("NFC", raw).replace("Σ", "σ").lower()
                pieces = (text,) if text.isalpha() else _PIECES.findall(text)
            found = self.word(text) if len(pieces) == 1 and pieces[0] == text else b"".join([self.word(piece) for piece in pieces])
        return self.kept(raw, found)

    def word(self, piece: str) -> bytes:
        # An ASCII piece alone is a chunk of the same ids; others may be normalised anew, so they stand behind a space.
        plain = piece.isascii()
        key = piece if plain else f" {piece}"
        found = self._known.get(key)
        if found is None:
            found = self._old.get(key)
            if found is None:
                # Visible ASCII letters stand for themselves.
                ids = self.encode_word(piece if plain and piece.isprintable() else piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.spelling))
                found = pack(f"<{len(ids)}I", *ids)
            self.kept(key, found)
        return found

    def kept(self, key: str, found: bytes) -> bytes:
        if len(key) <= KEPT_LETTERS and key not in self._known:
            if self._bytes >= KEPT_BYTES:
                self._old, self._known, self._bytes = self._known, {}, 0
            self._known[key] = found
            self._bytes += _ENTRY + len(key) + len(found)
        return found

    def chunks(self, text: str) -> list[str]:
        return text.split() if not _NOT_SPACE.search(text) else [x for x in _SPACE.split(text) if x]

    def pieces(self, text: str) -> list[str]:
        """The special tokens of a text and its chunks; no chunk holds a special token."""
        if self.special_at is None or "<|" not in text:
            return self.chunks(text)
        got, at = [], 0
        for m in self.special_at.finditer(text):
            got += self.chunks(text[at : m.start()])
            got.append(m.group())
            at = m.end()
        return got + self.chunks(text[at:])

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids of a text as bytes and its decoded text."""
        ids, decoded = self.encode_all([text])
        return ids[0], decoded[0]

    def encode_all(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids of each text as bytes, and the decoded texts. Each distinct chunk of all texts is looked up once."""
        numbers = Numbers()
        places = [np.fromiter(map(numbers.__getitem__, self.pieces(t)), np.int32) for t in texts]
        found = [self._known.get(raw) or self._special.get(raw) or self.chunk(raw) for raw in numbers]
        ids, at = joined(pa.array(found, pa.large_binary()), np.concatenate(places), np.cumsum([0, *map(len, places)]))
        decoded, to = joined(self.shown, np.frombuffer(ids, "<i4"), at // 4)
        return [ids[a:b] for a, b in pairwise(at.tolist())], [decoded[a : max(a, b - 1)].decode() for a, b in pairwise(to.tolist())]

    def decode(self, ids: bytes) -> str:
        return " ".join(self.names[i] for i in np.frombuffer(ids, dtype="<u4").tolist())


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(path: str) -> PrefixEncoder:
    """One per process and file, which keeps it to its end; a task has its own."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Token ids and decoded text of every whole text, beside the columns of `keep`.

    Adds n_tokens, ids (binary, 4 bytes a token) and decoded. A null text is empty and has no token; an empty
    text gives no ids and an empty decoded text; repeated rows each get their row. Other columns are dropped, so
    none can clash. `path` names a tokenizer file present on every executor.
    """
    names = list(keep)
    # By place, so that no name of `keep` can clash.
    source = docs.select(*[F.col(f"`{k}`").alias(f"k{n}") for n, k in enumerate(names)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PrefixEncoder(path)  # goes with the task: the worker lives on beside tasks of other operators
        for batch in batches:
            texts = batch.column(len(names))
            _, offsets = utf8(texts)
            for at, end in groups(offsets, TAKEN_BYTES):
                ids, decoded = coder.encode_all(texts.slice(at, end - at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(at, end - at) for k in range(len(names))), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    names=[*names, "n_tokens", "ids", "decoded"],
                )

    return source.mapInArrow(tidied(encode), f"{schema}, n_tokens long, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """The encoded rows with SHA-256 digests in the place of ids and decoded text."""
    return encoded.withColumns({"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2(F.encode("decoded", "UTF-8"), 256)}).drop("ids", "decoded")
