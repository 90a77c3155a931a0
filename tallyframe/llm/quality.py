"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal.

Tokens are words (case kept) and runs of punctuation. A text's features are its tokens, pairs of
neighbouring tokens, where a token after itself counts as one feature for all tokens, and marks for
words in capitals and for a token that was there two tokens before, hashed to 2**18 places. A feature's value is its count over the square root of the
number of features, so the score of a text is a sparse dot product.

Training follows the regularised leader over the sample in several shards by a hash of the document's
id, each shard in an order of its own hash, and averages the shards' weights.

Learning uses at most ``MAX_TRAINING`` labelled documents, chosen by a hash of their ids.

Defined results: null and empty texts have no features, so their score is that of the bias; without
training data every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.learning import labelled_sample
from tallyframe.llm.words import IS_WORD, byte_chunks, mixed, stream

MAX_TRAINING = 20_000
BITS = 18
SHARDS, EPOCHS = 8, 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.02
THRESHOLD = 0.3

_PLACES = np.uint64((1 << BITS) - 1)
_VALUE = stream(60, 256)
_REPEATED, _CAPITALS, _PAIR, _ALTERNATING = stream(61, 4)
_BASE = int(stream(62, 1)[0]) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: 0 between tokens, 1 in words, 2 in punctuation.
_KIND = np.where(_SPACE, 0, np.where(IS_WORD, 1, 2)).astype(np.int8)
_SMALL = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_LARGE = (np.arange(256) >= 65) & (np.arange(256) <= 90)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of every feature occurrence of a chunk of texts."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none
    kind = _KIND[data]
    new = np.concatenate(([True], kind[1:] != kind[:-1]))
    inner = offsets[1:-1]
    new[inner[inner < n]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    token = kind[starts] > 0
    starts, ends = starts[token], ends[token]
    power, inverse = _powers(1 << max(20, n.bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[:n], out=sums[1:])
    code = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    small, large = (np.concatenate(([0], np.cumsum(t[data]))) for t in (_SMALL, _LARGE))
    capitals = (small[ends] == small[starts]) & (large[ends] - large[starts] > 1)
    doc = np.searchsorted(offsets, starts, "right") - 1
    same = np.flatnonzero(doc[1:] == doc[:-1])
    left, right = code[same], code[same + 1]
    pair = np.where(left == right, _REPEATED, mixed(left * np.uint64(3) ^ right ^ _PAIR))
    again = np.flatnonzero((doc[2:] == doc[:-2]) & (code[2:] == code[:-2]))
    marks = [np.full(int(capitals.sum()), _CAPITALS), np.full(len(again), _ALTERNATING)]
    found = np.concatenate((code, pair, *marks))
    return np.concatenate((doc, doc[same], doc[capitals], doc[again])), (found & _PLACES).astype(np.int64)


_kept_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _kept_powers:
        _kept_powers.clear()
        both = np.full((2, n), np.array([[_BASE], [_INVERSE]], np.uint64))
        both[:, 0] = 1
        _kept_powers[n] = tuple(np.cumprod(both, axis=1))
    return _kept_powers[n]


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Leader:
    """Follow-the-regularised-leader state; the last place is the bias, which is not regularised."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, bias = self.z[at], at == 1 << BITS
        l1, l2 = np.where(bias, 0, L1), np.where(bias, 0, L2)
        shrunk = np.where(np.abs(z) <= l1, 0, z - np.sign(z) * l1)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + l2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = (_logistic(w @ value) - label) * value
        more = self.n[at] + gradient**2
        self.z[at] += gradient - (np.sqrt(more) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = more


def sparse(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features, and the bias."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    _, place = features(data, np.array([0, len(data)]))
    place = np.sort(place)
    new = np.flatnonzero(np.diff(place, prepend=-1))
    count = np.diff(np.append(new, len(place)))
    return np.append(place[new], 1 << BITS), np.append(count / np.sqrt(max(len(place), 1)), 1.0)


class Model:
    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights.astype(np.float64)

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for first, data, offsets in byte_chunks(texts):
            n = len(offsets) - 1
            doc, place = features(data, offsets)
            total = np.bincount(doc, self.weights[place], minlength=n)
            count = np.bincount(doc, minlength=n)
            out[first : first + n] = total / np.sqrt(np.maximum(count, 1)) + self.weights[-1]
        return _logistic(out)


def learn_quality(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> Model:
    """``docs`` has doc_id and text; ``labels`` has doc_id and quality, only of rows that may be learned from."""
    sample = labelled_sample(docs, labels, "quality", most).withColumn("order", F.xxhash64("doc_id"))
    sharded = sample.withColumn("shard", F.pmod("order", F.lit(SHARDS)).cast("int"))

    def train(shard: pd.DataFrame) -> pd.DataFrame:
        leader = Leader()
        # Rows in the order of another hash of theirs; texts decide between rows of one id.
        order = mixed(shard["order"].to_numpy(np.int64).view(np.uint64) ^ np.uint64(77))
        rows = sorted(zip(order.tolist(), shard["text"].fillna("").tolist(), shard["label"].tolist()))
        seen = [(sparse(text), label) for _, text, label in rows]
        for _ in range(EPOCHS):
            for (at, value), label in seen:
                leader.learn(at, value, label)
        weights = leader.weights(np.arange((1 << BITS) + 1))
        used = np.flatnonzero(weights)
        return pd.DataFrame({"place": used, "weight": weights[used], "shard": int(shard["shard"].iloc[0])})

    trained = sharded.groupBy("shard").applyInPandas(train, "place int, weight double, shard int").toPandas()
    weights = np.zeros((1 << BITS) + 1)
    for shard in sorted(trained["shard"].unique()):
        own = trained[trained["shard"] == shard]
        weights[own["place"].to_numpy()] += own["weight"].to_numpy()
    return Model(weights / max(1, trained["shard"].nunique()))


def quality(model: Model, spark):
    """Column function: the score of a text."""
    known = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(known.value.scores(texts))

    return score
