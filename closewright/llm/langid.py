"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time. Every byte position of every text gets a
distribution over the languages; a document's distribution is the mean over its positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from closewright.llm.shared import tidied
from closewright.llm.textbytes import groups, utf8

UNKNOWN = "und"
#: Bytes of a window: state is carried both ways within it. Texts are covered by consecutive windows.
STEPS = 64
HIDDEN = 8
#: Training rows: the bound of labelled documents per language, of windows from each, and of documents of all
#: languages; beyond that many each language has fewer, but one at least.
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC, TRAIN_DOCS = 400, 16, 25_600
TRAIN_STEPS, TRAIN_BATCH, RATE = 260, 256, 0.02
#: Windows taken at once, for up to 64 languages; for more, fewer windows in proportion.
AT_ONCE = 2048


@dataclass
class Network:
    """Weights per direction: table (256 x 3H, the input of each byte), recurrent (H x 3H); and the labels' layer."""

    labels: list[str]
    table: list[np.ndarray]
    recurrent: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [*self.table, *self.recurrent, self.out, self.bias]


def new_network(labels: list[str], seed: int = 7) -> Network:
    random = np.random.default_rng(seed)
    draw = lambda *shape: (random.standard_normal(shape) * 0.3).astype(np.float32)
    return Network(labels, [draw(256, 3 * HIDDEN) for _ in range(2)], [draw(HIDDEN, 3 * HIDDEN) for _ in range(2)], draw(2 * HIDDEN, len(labels)), np.zeros(len(labels), np.float32))


def gate(x: np.ndarray) -> np.ndarray:
    """Piecewise linear gate: 0 to 1 over -2 to 2."""
    return np.clip(x * np.float32(0.25) + np.float32(0.5), 0, 1)


def run(table: np.ndarray, recurrent: np.ndarray, x: np.ndarray, backward: bool, kept: list | None = None) -> np.ndarray:
    """States of one direction, steps x windows x H. `kept` gets what backpropagation needs."""
    steps, n = x.shape
    h, states = np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1) if backward else range(steps):
        a, u = table.take(x[t], axis=0), h @ recurrent
        g = gate(a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
        reset, update = g[:, :HIDDEN], g[:, HIDDEN:]
        new = np.tanh(a[:, 2 * HIDDEN :] + reset * u[:, 2 * HIDDEN :])
        if kept is not None:
            kept.append((t, h, g, new, u[:, 2 * HIDDEN :]))
        h = new + update * (h - new)
        states[t] = h
    return states


def positions(net: Network, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each position (steps x windows x labels) and the states below them."""
    both = np.concatenate([run(net.table[k], net.recurrent[k], x, bool(k)) for k in range(2)], axis=2)
    return softmax(both @ net.out + net.bias), both


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradients(net: Network, x: np.ndarray, y: np.ndarray, valid: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time of the mean cross entropy over all valid positions."""
    kept: list[list] = [[], []]
    states = [run(net.table[k], net.recurrent[k], x, bool(k), kept[k]) for k in range(2)]
    both = np.concatenate(states, axis=2)
    d = softmax(both @ net.out + net.bias)
    d[:, np.arange(len(y)), y] -= 1
    d *= (valid / valid.sum())[:, :, None].astype(np.float32)
    flat = d.reshape(-1, d.shape[2])
    g_out, g_bias, d_both = both.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(axis=0), d @ net.out.T
    tables, recurrents = [], []
    for k in range(2):
        dh = np.zeros((x.shape[1], HIDDEN), np.float32)
        d_in, d_rec = np.zeros((*x.shape, 3 * HIDDEN), np.float32), np.zeros_like(net.recurrent[k])
        for t, before, g, new, held in reversed(kept[k]):
            dh = dh + d_both[t][:, k * HIDDEN : (k + 1) * HIDDEN]
            reset, update = g[:, :HIDDEN], g[:, HIDDEN:]
            d_new = dh * (1 - update) * (1 - new * new)
            d_gate = np.concatenate([d_new * held, dh * (before - new)], axis=1) * np.where((g > 0) & (g < 1), np.float32(0.25), np.float32(0))
            d_in[t] = np.concatenate([d_gate, d_new], axis=1)
            d_u = np.concatenate([d_gate, d_new * reset], axis=1)
            d_rec += before.T @ d_u
            dh = dh * update + d_u @ net.recurrent[k].T
        order = np.argsort(x, axis=None, kind="stable")
        present, first = np.unique(x.reshape(-1)[order], return_index=True)
        table = np.zeros_like(net.table[k])
        table[present] = np.add.reduceat(d_in.reshape(-1, 3 * HIDDEN)[order], first)
        tables.append(table)
        recurrents.append(d_rec)
    return [*tables, *recurrents, g_out, g_bias]


def fit(windows: list[bytes], labels: list[str], seed: int = 11) -> Network:
    """Train on windows of text (Adam). With one label or none, the network is not needed and stays as drawn."""
    names = sorted(set(labels))
    net = new_network(names or [UNKNOWN])
    if len(names) < 2:
        return net
    x, valid = grid(windows)
    place = {v: k for k, v in enumerate(names)}
    y = np.array([place[v] for v in labels])
    groups_of = [np.flatnonzero(y == k) for k in range(len(names))]
    random, mean, square = np.random.default_rng(seed), [np.zeros_like(w) for w in net.weights()], [np.zeros_like(w) for w in net.weights()]
    for step in range(1, TRAIN_STEPS + 1):
        # More languages than a batch holds take turns.
        some = groups_of if len(names) <= TRAIN_BATCH else [groups_of[k] for k in random.choice(len(names), TRAIN_BATCH, replace=False)]
        at = np.concatenate([random.choice(g, max(1, TRAIN_BATCH // len(names))) for g in some])
        found = gradients(net, x[:, at], y[at], valid[:, at])
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in found)))
        rate = RATE * (1 - 0.9 * step / TRAIN_STEPS)
        for w, g, m, s in zip(net.weights(), found, mean, square, strict=True):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= np.float32(rate) * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + np.float32(1e-8))
    return net


def grid(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows as steps x windows of bytes, and which positions hold one."""
    x = np.zeros((len(windows), STEPS), np.uint8)
    valid = np.zeros((len(windows), STEPS), bool)
    for k, w in enumerate(windows):
        held = np.frombuffer(w[:STEPS], np.uint8)
        x[k, : len(held)], valid[k, : len(held)] = held, True
    return np.ascontiguousarray(x.T), np.ascontiguousarray(valid.T)


def document_probabilities(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean label distribution over all byte positions of each text (rows of zeros for empty texts)."""
    sizes = np.diff(offsets)
    count = -(-sizes // STEPS)
    owner = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[:-1][owner] + nth * STEPS
    held = np.minimum(STEPS, sizes[owner] - nth * STEPS)
    total = np.zeros((len(sizes), len(net.labels)))
    padded = np.append(data, np.zeros(STEPS, np.uint8))
    steps = np.arange(STEPS)
    at_once = max(1, min(AT_ONCE, AT_ONCE * 64 // len(net.labels)))
    for at in range(0, len(owner), at_once):
        some = slice(at, at + at_once)
        valid = steps[:, None] < held[some][None, :]
        x = padded[begin[some][None, :] + steps[:, None]] * valid
        found, _ = positions(net, x)
        np.add.at(total, owner[some], np.einsum("tnc,tn->nc", found, valid.astype(np.float32)))
    return total / np.maximum(sizes, 1)[:, None]


def training_windows(docs: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """label and window of a bounded, deterministic sample of labelled documents outside the held-out quarter.

    At most DOCS_PER_LANGUAGE documents of each label, fewer if all labels together had more than TRAIN_DOCS, but at
    least one; WINDOWS_PER_DOC windows spread over each whole text.
    """
    rows = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull() & F.col(text).rlike(r"\p{L}") & ~held_out(F.col(key)))
    rows = rows.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"), F.xxhash64(F.col(key).cast("string"), F.col(text), F.lit("train")).alias("draw"), F.xxhash64(F.col(text)).alias("tie"))
    counted = rows.groupBy("label").count()
    n_labels = counted.agg(F.count(F.lit(1)).alias("n_labels"))
    wanted = F.greatest(F.lit(1), F.least(F.lit(DOCS_PER_LANGUAGE), F.floor(F.lit(TRAIN_DOCS) / F.col("n_labels")))).cast("int")
    common = counted.crossJoin(n_labels).select("label", "count", wanted.alias("wanted"))
    # About four times the wanted number, and 100 more, pass by their hash, whatever the corpus; the least of them are taken.
    chance = F.shiftrightunsigned("draw", 11).cast("double") * 2.0**-53
    passing = rows.join(F.broadcast(common), "label").filter(chance < (4.0 * F.col("wanted") + 100) / F.col("count"))
    drawn = passing.withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("draw", "tie"))).filter(F.col("n") <= F.col("wanted"))
    size = F.char_length("text")
    spread = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS_PER_DOC - 1)), lambda i: F.substring(F.col("text"), (F.floor(i * size / WINDOWS_PER_DOC) + 1).cast("int"), F.lit(STEPS)))
    windows = drawn.select("label", "draw", "tie", F.explode(F.array_distinct(spread)).alias("window"))
    return windows.orderBy("label", "draw", "tie", "window").select("label", "window")


def held_out(key):
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Network:
    """A network fitted on `training_windows`; without a labelled text it knows no language."""
    got = training_windows(docs, key, text, label).toArrow()
    return fit([w.encode() for w in got.column("window").to_pylist()], got.column("label").to_pylist())


def predict(docs: DataFrame, net: Network, text: str = "text", prediction: str = "lang_pred", score: str = "score", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The rows (all their columns, or those of `keep`) with the predicted language and its probability (0 to 1).

    A text that is null or has no letter is `und` with score 0, as is every text if no language was learned. Columns
    named as the two added ones are replaced; repeated rows each get their row; ties go to the first label.
    """
    rows = docs.drop(prediction, score)
    columns = [c for c in rows.columns if keep is None or c in keep]
    known = net if net.labels != [UNKNOWN] else None
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    packed = rows.select(F.when(letters, F.col(text)).alias("t"), F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            names: list[str] = []
            scores: list[float] = []
            for a, b in groups(offsets):
                if known is None:
                    names += [UNKNOWN] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                part = document_probabilities(known, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                best = part.argmax(axis=1)
                some = np.diff(offsets[a : b + 1]) > 0
                names += [known.labels[k] if s else UNKNOWN for k, s in zip(best, some, strict=True)]
                scores += np.where(some, np.clip(part.max(axis=1), 0, 1), 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["row", prediction, score])

    found = packed.mapInArrow(tidied(label), f"row {packed.schema['row'].dataType.simpleString()}, `{prediction}` string, `{score}` double")
    return found.select("row.*", f"`{prediction}`", f"`{score}`")
