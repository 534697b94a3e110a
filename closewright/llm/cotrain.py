"""Quality classifier by co-training of two views.

One classifier sees only the text's words, the other only the page's metadata. Both are naive Bayes models, so a
round is one pass that adds up counts: each view labels the documents it is sure of, and those labels enter the
other view's counts. The calibrated views are combined to score every document. All counts come from all
documents but the labelled ones held out for the calibrations, which are fitted on a bounded sample of those.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closewright.llm.shared import least_hashes, written
from closewright.llm.textbytes import U64, groups, mixed, utf8, word_hashes

#: Buckets of each view's counts: the size of a model, whatever the corpus.
TEXT_BITS, META_BITS = 16, 12
ROUNDS = 2
#: A view labels a document for the other if its calibrated probability is this far out.
SURE = 0.95
#: Labelled rows a calibration is fitted on at most; one labelled row of so many is held out of the counts for it.
CALIBRATION_ROWS, HELD_OUT = 20_000, 5
#: Bits of the filter of labelled ids.
FILTER_BITS = 1 << 23


@dataclass
class View:
    """Log-odds of class 1 per bucket, and the calibration of the mean over a document's features."""

    bits: int
    weight: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, buckets: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        total = np.bincount(owner, self.weight[buckets], minlength=n)
        return total / np.maximum(np.bincount(owner, minlength=n), 1)

    def logit(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * raw + self.shift, -30, 30)


@dataclass
class Model:
    text: View
    meta: View
    #: Weights of the two calibrated logits and the intercept.
    mix: tuple[float, float, float] = (1.0, 1.0, 0.0)
    rounds: list[dict] = field(default_factory=list)


def probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-logit))


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of each content feature: words, pairs of words, and the last two bytes of a word with its length."""
    words, owner, starts = word_hashes(data, offsets)
    if not len(words):
        return np.zeros(0, np.int64), owner
    pair = mixed(words[:-1] * U64(3) + words[1:])[owner[:-1] == owner[1:]]
    ends = np.append(starts[1:], len(data)) - 1
    # The byte before the next word is its white space, so the last bytes stand one and two before.
    tail = data[np.maximum(ends - 1, 0)].astype(np.uint64) * U64(256) + data[np.maximum(ends - 2, 0)]
    shape = mixed(tail * U64(64) + np.minimum(np.diff(np.append(starts, len(data))), 63).astype(np.uint64))
    h = np.concatenate([words, pair, shape])
    return (h >> U64(64 - TEXT_BITS)).astype(np.int64), np.concatenate([owner, owner[:-1][owner[:-1] == owner[1:]], owner])


def meta_columns(source: str, lang: str, n_chars: str, text: str) -> list:
    """Metadata features, as strings: source, language, both, and the order of size. Nulls are a value of their own."""
    size = F.floor(F.log2(F.coalesce(F.col(n_chars), F.char_length(F.col(text)), F.lit(0)).cast("double") + 1) * 2)
    held = [F.coalesce(F.col(source).cast("string"), F.lit("?")), F.coalesce(F.col(lang).cast("string"), F.lit("?")), size.cast("string")]
    features = [*held, F.concat_ws("|", held[0], held[1]), F.concat_ws("|", held[1], held[2])]
    return [F.shiftrightunsigned(F.xxhash64(F.lit(k), f), 64 - META_BITS) for k, f in enumerate(features)]


def agreed(labels: DataFrame, key: str, label: str) -> DataFrame:
    """key and label (0 or 1) of the ids whose labels do not contradict one another."""
    one = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(label).alias("low"), F.max(label).alias("high"))
    return one.filter("low = high").select("key", F.col("low").cast("int").alias("label"))


def label_bits(labels: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, one set for the hash of each labelled id: a filter of one size, whatever the number of labels."""
    place = F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS))
    maps = labels.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(FILTER_BITS, bool)
    # Bucket numbers count from 1 for places from 1; place 0 alone lies in bucket 0.
    for bucket, bits in maps.collect():
        held = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
        start = (bucket - 1) * len(held) + 1 if bucket > 0 else 0
        at = start + np.flatnonzero(held)
        out[at[at < FILTER_BITS]] = True
    return out


def prepared(docs: DataFrame, labels: DataFrame, key: str, text: str, source: str, lang: str, n_chars: str, label: str) -> DataFrame:
    """doc_id, text, meta, label (null without one) and held (a labelled document that calibrations alone see).

    Only documents whose id may be labelled, by a filter of their hashes, are joined to the labels, once; that is the
    only shuffle of texts. All others are read where they are.
    """
    meta = F.array(*meta_columns(source, lang, n_chars, text))
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), meta.alias("meta"), F.coalesce(F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)), F.lit(0)).alias("place"))
    told = agreed(labels, key, label)
    bits = label_bits(told)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def where(wanted: bool):
        def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = bits[batch.column(3).to_numpy()] & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                yield batch.select([0, 1, 2]).filter(pa.array(hit == wanted))

        return rows.mapInArrow(take, f"doc_id {kind}, text string, meta array<long>")

    # One row is held out of HELD_OUT; rows of equal id and text stand together.
    held = (F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text"), F.lit("held out")), F.lit(HELD_OUT)) == 0) & F.col("label").isNotNull()
    some = where(True)
    # Merged at every size: with few labels broadcast, runs of different sizes would not tell of one another.
    joined = some.join(told.hint("merge"), some["doc_id"] == told["key"], "left").drop("key").withColumn("held", held)
    joined = written(joined, "labelled")
    return where(False).withColumns({"label": F.lit(None).cast("int"), "held": F.lit(False)}).union(joined)


def views(batch: pa.RecordBatch, text: pa.Array, meta: pa.Array) -> Iterator[tuple[int, int, tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]]:
    data, offsets = utf8(text)
    cells = np.asarray(meta.flatten()).reshape(len(text), -1) if len(text) else np.zeros((0, 1), np.int64)
    for a, b in groups(offsets):
        own = cells[a:b]
        yield a, b, text_features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), (own.reshape(-1), np.repeat(np.arange(b - a), own.shape[1]))


def counts(rows: DataFrame, model: Model | None) -> np.ndarray:
    """Feature counts by view, class and bucket over all documents: labelled ones, and those the other view is sure of.

    Each task returns the nonzero buckets it has; the sums have a fixed number of buckets.
    """
    width = (1 << TEXT_BITS) + (1 << META_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width + 2), np.int64)
        for batch in batches:
            told = batch.column(2).fill_null(-1).to_numpy(zero_copy_only=False).copy()
            # A held out row has a label, so no view labels it, and counts for neither.
            told[batch.column(3).to_numpy(zero_copy_only=False)] = 2
            for a, b, (words, w_owner), (meta, m_owner) in views(batch, batch.column(0), batch.column(1)):
                by_text, by_meta = told[a:b].copy(), told[a:b].copy()
                if model is not None:
                    p_text = probability(model.text.logit(model.text.raw(words, w_owner, b - a)))
                    p_meta = probability(model.meta.logit(model.meta.raw(meta, m_owner, b - a)))
                    new = told[a:b] < 0
                    for label, able in ((1, lambda p: p >= SURE), (0, lambda p: p <= 1 - SURE)):
                        by_text[new & able(p_meta)] = label
                        by_meta[new & able(p_text)] = label
                for c in (0, 1):
                    total[c, : 1 << TEXT_BITS] += np.bincount(words[by_text[w_owner] == c], minlength=1 << TEXT_BITS)
                    total[c, 1 << TEXT_BITS : width] += np.bincount(meta[by_meta[m_owner] == c], minlength=1 << META_BITS)
                    total[c, width] += int((by_text == c).sum())
                    total[c, width + 1] += int((by_meta == c).sum())
        c, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(at), pa.array(total[c, at])], names=["class", "bucket", "n"])

    summed = rows.select("text", "meta", "label", "held").mapInArrow(count, "class int, bucket long, n long").groupBy("class", "bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((2, width + 2), np.int64)
    out[summed.column("class").to_numpy(), summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return out


def log_odds(counted: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of class 1 per bucket; buckets never seen weigh nothing."""
    share = (counted + 0.5) / (counted.sum(axis=1, keepdims=True) + 0.5 * counted.shape[1])
    return np.where(counted.sum(axis=0) > 0, np.log(share[1]) - np.log(share[0]), 0.0)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights and intercept (last) of a lightly penalised logistic regression, by Newton's method."""
    z = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = probability(np.clip(z @ w, -30, 30))
        g = z.T @ (p - y) + 1e-3 * w
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(len(w))
        w = w - np.linalg.solve(h, g)
    return w


def raw_scores(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, label and the raw score of both views of each row."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(model.text.raw(*words, b - a), model.meta.raw(*meta, b - a)) for a, b, words, meta in views(batch, batch.column(1), batch.column(2))]
            text, meta = (np.concatenate([g[k] for g in got]) if got else np.zeros(0) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(text), pa.array(meta)], names=["doc_id", "label", "raw_text", "raw_meta"])

    return rows.select("doc_id", "text", "meta", "label").mapInArrow(score, f"doc_id {kind}, label int, raw_text double, raw_meta double")


def calibrate(rows: DataFrame, model: Model, share: float) -> None:
    """Fit both calibrations and the mix on at most CALIBRATION_ROWS held out rows, a `share` of them drawn by a hash.

    Rows are scored where they are; only their two scores and label come together.
    """
    draw = F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text"), F.lit("calibrate"))
    drawn = rows.filter(F.col("held") & (draw <= F.lit(least_hashes(share))))
    got = raw_scores(drawn, model).orderBy(F.xxhash64("raw_text", "raw_meta", "label")).limit(CALIBRATION_ROWS).toArrow()
    y = got.column("label").to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return
    text, meta = got.column("raw_text").to_numpy(), got.column("raw_meta").to_numpy()
    for view, x in ((model.text, text), (model.meta, meta)):
        view.slope, view.shift = logistic(x[:, None], y)
    model.mix = tuple(logistic(np.column_stack([model.text.logit(text), model.meta.logit(meta)]), y))


def co_train(rows: DataFrame, rounds: int = ROUNDS) -> Model:
    """Start from the labels alone, then exchange pseudo-labels for `rounds` rounds."""
    model: Model | None = None
    n_held = rows.filter("held").count()
    share = min(1.0, 1.2 * CALIBRATION_ROWS / max(1, n_held))
    for _ in range(rounds + 1):
        counted = counts(rows, model)
        middle, end = 1 << TEXT_BITS, (1 << TEXT_BITS) + (1 << META_BITS)
        told = [] if model is None else model.rounds
        model = Model(View(TEXT_BITS, log_odds(counted[:, :middle])), View(META_BITS, log_odds(counted[:, middle:end])), rounds=[*told, {"text": counted[:, end].tolist(), "meta": counted[:, end + 1].tolist()}])
        calibrate(rows, model, share)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", n_chars: str = "n_chars", label: str = "quality") -> DataFrame:
    """doc_id, p_text, p_meta, score (all 0 to 1) and keep (score of at least one half) of every document.

    Nulls in metadata are a value of their own, a null text is empty and judged by its metadata and the base rate;
    repeated rows each get their row; rows of `labels` without a document, or that contradict one another, do not
    count. Without labels of both classes no view knows anything and every score is one half.
    """
    rows = prepared(docs, labels, key, text, source, lang, n_chars, label)
    model = co_train(rows)
    a, b, c = model.mix
    scored = raw_scores(rows, model)
    logit = {n: F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(v.slope)) * F.col(f"raw_{n}") + F.lit(float(v.shift)))) for n, v in (("text", model.text), ("meta", model.meta))}
    chance = lambda z: 1 / (1 + F.exp(-z))
    return scored.select("doc_id", chance(logit["text"]).alias("p_text"), chance(logit["meta"]).alias("p_meta"), chance(float(a) * logit["text"] + float(b) * logit["meta"] + float(c)).alias("score")).withColumn("keep", F.col("score") >= 0.5)
