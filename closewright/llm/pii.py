"""Personal data: fixed patterns, and a skip-chain conditional random field that adds spans.

Tokens with a digit or an at sign are nodes. Neighbours in the text share a chain potential, and equal or similar
tokens, or runs of number tokens, anywhere in a document share a skip potential, so a number that is a phone number in one place is one in
another. Loopy message passing gives the labels. Tokens within pattern matches keep their label. The field is trained with
labelled mentions repeated in a form that hides their format, so that the skip potential has to carry the label.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.llm.shared import least_hashes, tidied

KINDS = ("email", "ip", "card", "phone")
#: Labels: 0 is no personal data, then KINDS.
N_LABELS = len(KINDS) + 1
#: Training rows: the bound of documents with a candidate token, and of tokens in each.
TRAIN_DOCS, TRAIN_TOKENS = 2000, 400
PASSES, DAMPING = 12, 0.5
#: Least probability of a label that adds a span.
LEAST = 0.6
GAP = 2

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\s]*[0-9@][^\s]*")
_CORE = re.compile(r"[+(]?\w(?:.*\w)?\)?", re.DOTALL)
_NUMBER = re.compile(r"[+(]?[0-9][0-9().-]*")
_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern: around each at sign, so that long runs of letters cost no retries."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            yield begin, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end (code points) of the pattern matches, kind by kind.

    The look-behind of the address pattern only spares retries: a match never begins within a run of digits.
    """
    found = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group()) if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isascii() and c.isdigit() for c in m.group()) <= 15]
    return found


FEATURES = ("bias", "at", "domain", "dots3", "plus", "bracket", "dash", "letters", "digits1", "digits2-4", "digits5-8", "digits9-12", "digits13-19", "digits20", "luhn", "octets", "only-digits", "signs", "run-luhn")
_RUN_LUHN = 1 << FEATURES.index("run-luhn")


def features(token: str) -> int:
    """Bit mask over FEATURES."""
    digits = re.sub(r"[^0-9]", "", token)
    n, parts = len(digits), token.split(".")
    held = (
        True, "@" in token, bool(_DOMAIN.search(token.partition("@")[2])), len(parts) == 4, token.startswith("+"), "(" in token or ")" in token, "-" in token, any(c.isalpha() for c in token),
        n == 1, 2 <= n <= 4, 5 <= n <= 8, 9 <= n <= 12, 13 <= n <= 19, n >= 20, 13 <= n <= 19 and luhn(digits), len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts),
        n == len(token), any(c in "#$%&*=\"<>" for c in token), False,
    )
    return sum(1 << k for k, h in enumerate(held) if h)


def likeness(token: str) -> str:
    """What similar tokens have in common: the last seven digits, or an address's local part; else nothing."""
    if "@" in token:
        local = token.partition("@")[0].lower()
        return f"a{local}" if local else ""
    digits = re.sub(r"[^0-9]", "", token)
    if len(digits) >= 7:
        return f"d{digits[-7:]}"
    return f"a{token.lower()}" if len(token) > 3 and any(c.isalpha() for c in token) and "." in token else ""


@dataclass
class Nodes:
    """Tokens of one text: place, feature masks, label by the patterns (-1: partly covered), chain and skip links (index of the earlier node or -1)."""

    spans: list[tuple[int, int]]
    masks: list[int]
    labels: list[int]
    chain: list[int]
    skip: list[int]
    #: Number of the run of number tokens, or of the single token, that each belongs to.
    runs: list[int]


def nodes_of(text: str, base: list[tuple[int, int, int]]) -> Nodes:
    covered = sorted((a, b, k + 1) for k, a, b in base)
    out, at = Nodes([], [], [], [], [], []), 0
    for m in _TOKEN.finditer(text):
        core = _CORE.search(m.group())
        if core is None:
            continue
        a, b = m.start() + core.start(), m.start() + core.end()
        while at < len(covered) and covered[at][1] <= a:
            at += 1
        label = 0
        for x, y, kind in covered[at:]:
            if x >= b:
                break
            if y > a:
                label = kind
                break
        n, token = len(out.spans), text[a:b]
        out.chain.append(n - 1 if n and a - out.spans[-1][1] <= GAP else -1)
        out.spans.append((a, b))
        out.masks.append(features(token))
        out.labels.append(label)
    tokens = [text[a:b] for a, b in out.spans]
    runs = runs_of(tokens, out.chain)
    for number, run in enumerate(runs):
        out.runs += [number] * len(run)
        if len(run) > 1 and luhn_run(tokens, run):
            for n in run:
                out.masks[n] |= _RUN_LUHN
    out.skip += skip_links(tokens, runs)
    return out


def runs_of(tokens: list[str], chain: list[int]) -> list[range]:
    """Runs of neighbouring number tokens, and single tokens. A run that repeats itself is parted into its repeats."""
    numbers = [_NUMBER.fullmatch(t) is not None for t in tokens]
    runs, first = [], 0
    while first < len(tokens):
        last = first + 1
        while last < len(tokens) and numbers[first] and numbers[last] and chain[last] == last - 1 and not tokens[last].startswith("+"):
            last += 1
        size = last - first
        some = tokens[first:last]
        period = next((p for p in range(2, size // 2 + 1) if size % p == 0 and some == some[:p] * (size // p)), size) if size <= 64 else size
        runs += [range(a, a + period) for a in range(first, last, period)]
        first = last
    return runs


def luhn_run(tokens: list[str], run: range) -> bool:
    digits = re.sub(r"[^0-9]", "", "".join(tokens[n] for n in run)) if len(run) <= 19 else ""
    return 13 <= len(digits) <= 19 and luhn(digits)


def skip_links(tokens: list[str], runs: list[range]) -> list[int]:
    """The earlier token that each token is linked to, or -1.

    A run of number tokens is alike another by their joined digits (the last seven, or all of fewer), and its tokens are
    linked in order from the end, or to the one token that holds all the digits. A single token is linked by its
    likeness, else by equal text; short numbers within a run are no mention by themselves.
    """
    links, seen = [-1] * len(tokens), {}
    for run in runs:
        if len(run) > 1:
            digits = re.sub(r"[^0-9]", "", "".join(tokens[n] for n in run))
            names = [f"d{digits[-7:]}" if len(digits) >= 7 else f"r{digits}"]
        else:
            own, text = likeness(tokens[run[0]]), tokens[run[0]].lower()
            names = [x for x in (own, f"e{text}") if x]
        before = next((seen[x] for x in names if x in seen), None)
        if before is not None:
            for back in range(1, len(run) + 1):
                links[run[-back]] = before[-min(back, len(before))]
        for x in names:
            seen[x] = list(run)
    return links


def hidden(tokens: list[str], nodes: Nodes) -> Nodes:
    """The nodes, and for each run with a phone or card label, and for as many without one, a repeat whose format is hidden.

    A repeat has the digits without plus sign and brackets, carries the label, is linked to the run as a later mention is
    and stands in a place of its own. The field sees no more of it than of any number.
    """
    out = Nodes(list(nodes.spans), list(nodes.masks), list(nodes.labels), list(nodes.chain), list(nodes.skip), list(nodes.runs))
    held: dict[int, list[int]] = {}
    for n, run in enumerate(nodes.runs):
        held.setdefault(run, []).append(n)
    told = [run for run in held.values() if all(nodes.labels[n] == nodes.labels[run[0]] and nodes.labels[n] > 2 for n in run)]
    plain = [run for run in held.values() if all(nodes.labels[n] == 0 and _NUMBER.fullmatch(tokens[n]) for n in run)]
    for run in told + plain[: max(1, 2 * len(told))]:
        first = len(out.masks)
        bare = [tokens[n].replace("+", "").replace("(", "").replace(")", "") for n in run]
        # A phone's repeat may lack its country code, the first token of several.
        drop = 1 if nodes.labels[run[0]] == 4 and len(run) > 2 and tokens[run[0]].startswith("+") else 0
        for k, (n, token) in enumerate(list(zip(run, bare, strict=True))[drop:]):
            out.spans.append((-1, -1))
            out.masks.append(features(token))
            out.labels.append(nodes.labels[n])
            out.chain.append(first + k - 1 if k else -1)
            out.skip.append(n)
            out.runs.append(-1)
    return out


@dataclass
class Field:
    """Log-potentials: features x labels, and labels x labels of chain and skip links (earlier by later)."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def bits(masks) -> np.ndarray:
    return (np.asarray(masks, np.int64)[:, None] >> np.arange(len(FEATURES)) & 1).astype(np.float64)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def fit(masks, labels, chain, skip, steps: int = 300, rate: float = 0.3) -> Field:
    """Pseudo-likelihood: each token's label given its features and the labels of its neighbours."""
    field = Field(np.zeros((len(FEATURES), N_LABELS)), np.zeros((N_LABELS, N_LABELS)), np.eye(N_LABELS) * 2.0)
    if not len(masks):
        return field
    x, y = bits(masks), np.asarray(labels)
    one = np.eye(N_LABELS)
    links = [(np.flatnonzero(np.asarray(link) >= 0), np.asarray(link)) for link in (chain, skip)]
    weight = np.where(y == 0, 1.0, (y == 0).sum() / max(1, (y > 0).sum()))
    weight = np.clip(weight, 0.05, 20.0) / len(y)
    # Where a link joins a token with a label to one without, the patterns may just have missed the latter: it tells nothing.
    later, link = links[1]
    earlier = link[later]
    weight[later[(y[earlier] > 0) & (y[later] == 0)]] = 0.0
    weight[earlier[(y[later] > 0) & (y[earlier] == 0)]] = 0.0
    squares = [1e-8 + np.zeros_like(p) for p in (field.unary, field.chain, field.skip)]
    for _ in range(steps):
        z = x @ field.unary
        for (later, link), table in zip(links, (field.chain, field.skip), strict=True):
            earlier = link[later]
            np.add.at(z, later, table[y[earlier]])
            np.add.at(z, earlier, table[:, y[later]].T)
        d = (one[y] - np.exp(log_softmax(z))) * weight[:, None]
        grads = [x.T @ d - 1e-4 * field.unary]
        for (later, link), table in zip(links, (field.chain, field.skip), strict=True):
            earlier, g = link[later], np.zeros_like(table)
            np.add.at(g, y[earlier], d[later])
            np.add.at(g.T, y[later], d[earlier])
            grads.append(g - 1e-4 * table)
        for p, g, s in zip((field.unary, field.chain, field.skip), grads, squares, strict=True):
            s += g * g
            p += rate * g / np.sqrt(s)
    # Links that training saw too seldom to tell still speak for equal labels.
    field.skip += np.eye(N_LABELS)
    return field


def marginals(field: Field, masks, labels, chain, skip) -> np.ndarray:
    """Label probabilities by loopy sum-product passing; tokens with a pattern label hold it."""
    logits = bits(masks) @ field.unary
    fixed = np.asarray(labels) > 0
    logits[fixed] = -50.0
    logits[fixed, np.asarray(labels)[fixed]] = 0.0
    later = [np.flatnonzero(np.asarray(link) >= 0) for link in (chain, skip)]
    earlier = [np.asarray(link, np.int64)[at] for link, at in zip((chain, skip), later, strict=True)]
    tables = np.concatenate([np.broadcast_to(t, (len(at), N_LABELS, N_LABELS)) for t, at in zip((field.chain, field.skip), later, strict=True)])
    u, v = np.concatenate(earlier).astype(np.int64), np.concatenate(later).astype(np.int64)
    source, target = np.append(u, v), np.append(v, u)
    tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
    n = len(u)
    messages = np.zeros((2 * n, N_LABELS))
    belief = logits.copy()
    for _ in range(PASSES if n else 0):
        back = np.append(messages[n:], messages[:n], axis=0)
        out = belief[source] - back
        new = np.logaddexp.reduce(out[:, :, None] + tables, axis=1)
        messages = DAMPING * messages + (1 - DAMPING) * log_softmax(new)
        belief = logits.copy()
        np.add.at(belief, target, messages)
    return np.exp(log_softmax(belief))


def added_spans(nodes: Nodes, chances: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of tokens that the field labels, neighbours of one label joined; none overlaps a pattern match."""
    best = chances.argmax(axis=1)
    found: list[list[int]] = []
    for n, (a, b) in enumerate(nodes.spans):
        kind = int(best[n])
        if nodes.labels[n] or not kind or chances[n, kind] < LEAST:
            continue
        if found and nodes.chain[n] == n - 1 and n and not nodes.labels[n - 1] and best[n - 1] == kind and nodes.runs[n - 1] == nodes.runs[n] and found[-1][0] == kind - 1 and found[-1][2] == nodes.spans[n - 1][1]:
            found[-1][2] = b
        else:
            found.append([kind - 1, a, b])
    return [(k, a, b) for k, a, b in found if not any(x < b and y > a for _, x, y in base)]


def graph(docs: list[Nodes]) -> tuple[list, list, list, list]:
    """The tokens of several texts as one graph without links between texts."""
    masks, labels, chain, skip = [], [], [], []
    for d in docs:
        n = len(masks)
        masks += d.masks
        labels += d.labels
        chain += [c + n if c >= 0 else -1 for c in d.chain]
        skip += [c + n if c >= 0 else -1 for c in d.skip]
    return masks, labels, chain, skip


def telling(text: str):
    """The text where it holds a digit or an at sign, else null: no other text can hold a span."""
    return F.when(F.col(text).rlike("[0-9@]"), F.col(text))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Field:
    """Fit the field to the pattern labels of a bounded, deterministic sample: TRAIN_DOCS texts with a candidate token.

    Texts are drawn by the least hashes of id and text. They are thinned to about half as many again, and marked, where
    they are; only tokens' features come together.
    """
    able = docs.select(telling(text).alias("t"), F.xxhash64(F.col(key).cast("string"), F.xxhash64(text), F.lit("pii")).alias("draw")).filter("t is not null")
    share = min(1.0, 1.5 * TRAIN_DOCS / max(1, able.count()))
    drawn = able.filter(F.col("draw") <= least_hashes(share)).withColumn("tie", F.xxhash64("t"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, draw, tie in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                d = nodes_of(t, base_spans(t))
                tokens = [t[a:b] for a, b in d.spans[:TRAIN_TOKENS]]
                d = hidden(tokens, Nodes(*(x[:TRAIN_TOKENS] for x in (d.spans, d.masks, d.labels, d.chain, d.skip, d.runs))))
                n = len(d.masks)
                yield pa.RecordBatch.from_arrays([pa.array([draw]), pa.array([tie]), *(pa.array([x[:n]], pa.list_(pa.int64())) for x in (d.masks, d.labels, d.chain, d.skip))], names=["draw", "tie", "masks", "labels", "chain", "skip"])

    got = drawn.mapInArrow(mark, "draw long, tie long, masks array<long>, labels array<long>, chain array<long>, skip array<long>").orderBy("draw", "tie").limit(TRAIN_DOCS).toArrow()
    lists = zip(*(got.column(c).to_pylist() for c in ("masks", "labels", "chain", "skip")), strict=True)
    return fit(*graph([Nodes([], *x, []) for x in lists]))


def written_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_spans(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans (kind:start:end, comma-joined) of every whole text.

    Counts and digest are of the pattern matches; spans holds these and the field's. Null and empty texts hold none;
    repeated rows each get their row; other columns are dropped.
    """
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("doc_id"), telling(text).alias("t"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                texts = part.column(1).to_pylist()
                base = [base_spans(t) if t else [] for t in texts]
                able = [n for n, t in enumerate(texts) if t]
                docs_ = [nodes_of(texts[n], base[n]) for n in able]
                spans = [list(b) for b in base]
                told = graph(docs_)
                if told[0]:
                    chances, begin = marginals(field, *told), 0
                    for n, d in zip(able, docs_, strict=True):
                        spans[n] += added_spans(d, chances[begin : begin + len(d.spans)], base[n]) if d.spans else []
                        begin += len(d.spans)
                counts = [pa.array([sum(k == j for k, _, _ in b) for b in base], pa.int64()) for j in range(len(KINDS))]
                digests = [hashlib.sha256(written_spans(b).encode()).hexdigest() for b in base]
                yield pa.RecordBatch.from_arrays([part.column(0), *counts, pa.array(digests), pa.array([written_spans(s) for s in spans], pa.string())], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return source.mapInArrow(find, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span replaced by its kind in brackets; overlapping spans are one, of the kind that begins first."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows with every span of `find_spans` replaced by its kind; n_chars, if there is one, follows the new text."""
    names = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names if c != text)).alias("row"), F.col(text).alias("t"))

    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for n, t in enumerate(texts):
                if t and re.search("[0-9@]", t):
                    base = base_spans(t)
                    d = nodes_of(t, base)
                    more = added_spans(d, marginals(field, *graph([d])), base) if d.spans else []
                    texts[n] = redacted_text(t, base + more)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", text])

    found = rows.mapInArrow(tidied(hide), f"row {rows.schema['row'].dataType.simpleString()}, `{text}` string")
    held = [F.col(f"`{text}`") if c == text else F.char_length(F.col(f"`{text}`")).cast(docs.schema[c].dataType).alias(c) if c == n_chars else F.col(f"row.`{c}`") for c in names]
    return found.select(*held)
