"""Quality classifier: hashed word n-grams, logistic regression trained by FTRL.

A text is cut into words (runs of letters, digits and non-ASCII bytes) and runs of
punctuation. Four families of features are hashed into one weight vector: word
unigrams and bigrams, and unigrams and bigrams of word *forms* (case pattern and
length; punctuation as written; "same word again"). A feature's value is its
share of its family's n-grams times the family's scale, so a score is a sparse
dot product that does not depend on the text's length.

Training follows the regularised leader (FTRL-Proximal) with L1 and L2 terms on a
bounded sample of labelled rows: the ``sample`` rows with the smallest hashes of
their ids. The sample is dealt into ``shards`` groups; in each epoch every shard
runs FTRL over its rows from the common state, and the states are averaged in a
task. The mean state, two numbers per weight, is all that passes through the
driver.

Scoring reads every whole text, with the texts of an Arrow batch as one byte
array. Texts are taken in groups of about a megabyte, a longer text in parts of
that size and one word, which repeat two words so that no n-gram is lost.

Defined cases: a null text counts as empty and scores the bias; labels with a
null id or null quality are not learned from, and of repeated labels of one id
the lower quality counts; without any label to learn from all weights are 0 and
every score is 0.5; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkiln.llm.common import free_name, materialise, python_tasks, read_table

WEIGHT_BITS = 18
CHUNK = 1 << 20
THRESHOLD = 0.7
SCALES = (1.0, 1.0, 6.0, 6.0)
_BASE = 0x9E3779B97F4A7C15
_SPACE, _WORD, _MARK = 0, 1, 2


@dataclass(frozen=True)
class Training:
    sample: int = 8000
    shards: int = 4
    epochs: int = 6
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.001


def _classes() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[33:127] = _MARK
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kind[low:high] = _WORD
    return kind


_KIND = _classes()
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int32)
_DIGIT[48:58] = 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, kept per worker."""
    if "up" not in _POWER or len(_POWER["up"]) < n:
        size = max(n, CHUNK + 1)
        _POWER["up"] = _powers(_BASE, size)
        _POWER["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _POWER["up"], _POWER["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def ngrams(data: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family (text number, weight index) of every n-gram.

    ``data`` has the bytes of several texts, ``bounds`` where each begins and the
    last ends. A word's hash is a difference of prefix sums of a polynomial hash.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return [(none, none)] * len(SCALES)
    kind = _KIND[data]
    fresh = np.empty(len(data), bool)
    fresh[0] = True
    np.not_equal(kind[1:], kind[:-1], out=fresh[1:])
    inner = bounds[:-1]
    fresh[inner[inner < len(data)]] = True
    start = np.flatnonzero(fresh)
    end = np.append(start[1:], len(data))
    kind = kind[start]
    words = kind != _SPACE
    start, end, kind = start[words], end[words], kind[words]
    text = np.searchsorted(bounds, start, side="right") - 1
    size = end - start
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data] + np.uint64(1)) * up[:len(data)], out=sums[1:])
    word = _mix((sums[end] - sums[start]) * down[start] + size.astype(np.uint64))

    upper = np.concatenate(([0], np.cumsum(_UPPER[data])))
    digit = np.concatenate(([0], np.cumsum(_DIGIT[data])))
    n_upper, n_digit = upper[end] - upper[start], digit[end] - digit[start]
    case = np.select([n_digit == size, n_digit > 0, 2 * n_upper >= size, _UPPER[data[start]] == 1], [1, 2, 3, 4], 5)
    form = np.where(kind == _MARK, word >> np.uint64(8), (case * 16 + np.minimum(size, 12)).astype(np.uint64))
    pair = text[1:] == text[:-1]
    again = np.flatnonzero((word[1:] == word[:-1]) & pair) + 1
    form[again] = 7

    base, shift = np.uint64(_BASE), np.uint64(64 - WEIGHT_BITS)
    second = text[1:][pair]
    hashes = [
        (text, word * base + np.uint64(1)),
        (second, (word[:-1][pair] * base + word[1:][pair]) * base + np.uint64(2)),
        (text, form * base + np.uint64(3)),
        (second, (form[:-1][pair] * base + form[1:][pair]) * base + np.uint64(4)),
    ]
    return [(t, (_mix(_mix(h)) * base >> shift).astype(np.int64)) for t, h in hashes]


def _texts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string array without copying the texts."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def _parts(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(number of the first text, bytes, bounds, words repeated) of groups of about CHUNK bytes.

    A longer text comes in parts that are cut between words; each part but the first
    begins with the last two words of the one before, so that every word is seen
    beside its neighbours.
    """
    at, n = 0, len(bounds) - 1
    while at < n:
        last = max(int(np.searchsorted(bounds, bounds[at] + CHUNK, side="right")) - 1, at)
        if last > at:
            yield at, data[bounds[at]:bounds[last]], bounds[at:last + 1] - bounds[at], 0
            at = last
            continue
        text = data[bounds[at]:bounds[at + 1]]
        kind = _KIND[text]
        starts = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1])) & (kind != _SPACE))
        word = 0
        while word < len(starts):
            after = max(int(np.searchsorted(starts, starts[word] + CHUNK)), word + 1)
            again = min(2, word)
            end = int(starts[after]) if after < len(starts) else len(text)
            low = int(starts[word - again])
            yield at, text[low:end], np.array([0, end - low]), again
            word = after
        at += 1


def _ngrams_of(part: np.ndarray, inner: np.ndarray, again: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """``ngrams`` without those that lie within the ``again`` repeated words."""
    found = ngrams(part, inner)
    if not again:
        return found
    return [(text[again - of:], index[again - of:]) for (text, index), of in zip(found, (0, 1, 0, 1))]


def scores(array: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The score of every text: the logistic function of the sparse dot product."""
    data, bounds = _texts(array)
    n = len(bounds) - 1
    total = np.zeros((len(SCALES), n))
    count = np.zeros((len(SCALES), n))
    for first, part, inner, again in _parts(data, bounds):
        k = len(inner) - 1
        for f, (text, index) in enumerate(_ngrams_of(part, inner, again)):
            total[f, first:first + k] += np.bincount(text, weights=weights[index], minlength=k)
            count[f, first:first + k] += np.bincount(text, minlength=k)
    logit = weights[-1] + sum(s * t / np.maximum(c, 1) for s, t, c in zip(SCALES, total, count))
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(weight indices, values) of one text, the bias last."""
    data, bounds = _texts(pa.array([text], pa.string()))
    seen = np.zeros(len(SCALES))
    found: list[list[np.ndarray]] = [[] for _ in SCALES]
    for _, part, inner, again in _parts(data, bounds):
        for f, (_, index) in enumerate(_ngrams_of(part, inner, again)):
            found[f].append(index)
            seen[f] += len(index)
    indices, values = [], []
    for f, scale in enumerate(SCALES):
        if seen[f]:
            index, n = np.unique(np.concatenate(found[f]), return_counts=True)
            indices.append(index)
            values.append(scale * n / seen[f])
    indices.append(np.array([1 << WEIGHT_BITS]))
    values.append(np.array([1.0]))
    return np.concatenate(indices), np.concatenate(values)


def weights_of(z: np.ndarray, n: np.ndarray, how: Training) -> np.ndarray:
    """FTRL-Proximal's closed form of the weights."""
    return np.where(np.abs(z) <= how.l1, 0.0,
                    -(z - np.sign(z) * how.l1) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))


def ftrl_pass(rows: list[tuple[np.ndarray, np.ndarray, int]], z: np.ndarray, n: np.ndarray, how: Training) -> None:
    """One pass over ``rows`` of (indices, values, label); updates ``z`` and ``n``."""
    for index, value, label in rows:
        zi, ni = z[index], n[index]
        w = weights_of(zi, ni, how)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * value
        step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / how.alpha
        np.add.at(z, index, g - step * w)
        np.add.at(n, index, g * g)


def training_rows(docs: DataFrame, labels: DataFrame, how: Training, label_col: str = "quality",
                  id_col: str = "doc_id", text_col: str = "text", only: Column | None = None) -> DataFrame:
    """(shard, label, indices, values) of the sampled labelled texts.

    The sample's ids and labels are at most ``how.sample`` rows, so they are
    broadcast; the texts are turned into features where they are read.
    """
    python_tasks(docs.sparkSession)
    key = F.col(id_col)
    known = labels.filter(key.isNotNull() & F.col(label_col).isNotNull())
    if only is not None:
        known = known.filter(only)
    sample = (known.groupBy(key.alias("sample_id")).agg(F.min(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("sample_id"), "sample_id").limit(how.sample))
    sample = materialise(sample, "quality-sample")
    texts = (docs.select(key.alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(sample), F.col("id") == F.col("sample_id"))
             .select("id", "label", "text"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t if isinstance(t, str) else None) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"],
                                "indices": [i.astype(np.int32) for i, _ in found],
                                "values": [v.astype(np.float32) for _, v in found]})

    id_type = docs.schema[id_col].dataType.simpleString()
    made = texts.mapInPandas(extract, f"id {id_type}, label int, indices array<int>, values array<float>")
    shard = F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(how.shards)).cast("int")
    return materialise(made.withColumn("shard", shard), "quality-features")


def train(rows: DataFrame, how: Training = Training()) -> np.ndarray | None:
    """The weights (the bias last), or None without rows to learn from."""
    spark = rows.sparkSession
    if rows.isEmpty():
        return None
    size = (1 << WEIGHT_BITS) + 1
    state = _packed(np.zeros((2, size)))
    for epoch in range(how.epochs):
        shared = spark.sparkContext.broadcast(state)

        def shard_pass(pdf: pd.DataFrame) -> pd.DataFrame:
            z, n = _unpacked(shared.value)
            # an order of the rows' own, also where ids repeat
            content = [hashlib.sha1(i.tobytes() + v.tobytes() + bytes([int(y)])).hexdigest()
                       for i, v, y in zip(pdf["indices"], pdf["values"], pdf["label"])]
            pdf = pdf.assign(content=content).sort_values(["id", "content"])
            data = list(zip(pdf["indices"], pdf["values"], pdf["label"]))
            order = np.random.default_rng(epoch).permutation(len(data))
            ftrl_pass([(data[i][0], data[i][1].astype(np.float64), data[i][2]) for i in order], z, n, how)
            return pd.DataFrame({"state": [_packed(np.stack([z, n]))]})

        def mean_state(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"state": [_packed(sum(_unpacked(s) for s in pdf["state"]) / len(pdf))]})

        # the states, one per shard, are averaged on an executor; one of them comes back
        state = bytes(rows.groupBy("shard").applyInPandas(shard_pass, "state binary")
                      .groupBy().applyInPandas(mean_state, "state binary").first()[0])
        shared.destroy()
    return weights_of(*_unpacked(state), how)


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> np.ndarray | None:
    return train(training_rows(docs, labels, how, only=~held_out()), how)


def _packed(state: np.ndarray) -> bytes:
    """A state, mostly zeros, as compressed single precision."""
    return zlib.compress(state.astype("<f4").tobytes(), 1)


def _unpacked(state: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(state), "<f4").astype(np.float64).reshape(2, -1)


def with_score(docs: DataFrame, weights: np.ndarray | None, out_col: str = "score",
               text_col: str = "text") -> DataFrame:
    """``docs`` with the score of every whole text."""
    spark = docs.sparkSession
    python_tasks(spark)
    shared = spark.sparkContext.broadcast(
        weights if weights is not None else np.zeros((1 << WEIGHT_BITS) + 1))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(scores(texts, shared.value))

    return docs.withColumn(out_col, score(F.col(text_col)))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: CRC-32 of the id as text leaves remainder 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def drop_low_quality(docs: DataFrame, labels: DataFrame, how: Training = Training(),
                     threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without what the classifier rejects; all of it when nothing was learned."""
    weights = fit(docs, labels, how)
    if weights is None:
        return docs
    name = free_name(docs, "quality_score")
    return with_score(docs, weights, name).filter(F.col(name) >= threshold).drop(name)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a classifier learned from the labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit(docs, read_table(spark, sf_dir, "labels"))
    return with_score(docs, weights).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
