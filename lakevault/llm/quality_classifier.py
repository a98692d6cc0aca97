"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network
with temperature-calibrated probabilities.

Word vectors. Every hashed word has a sparse ternary index vector, fixed by its hash. A word's
vector is the sum of the index vectors of its neighbours over the whole corpus, at unit length.
Each task adds up a table of ``BUCKETS`` x ``DIMENSIONS`` and sends it in blocks; blocks are summed
in two steps, by (block, salt) and by block. The table's size is fixed, so it is broadcast. Besides
words in lower case their shapes are words too: ``Th###`` has the shape ``Aa#``.

A document is the mean of its words' vectors, the mean of its shapes' vectors, and five counts:
length, word length, how many words and lines are distinct, and how many words follow themselves.

The network (numpy, Adam) is fitted on the driver to at most ``SAMPLE`` labelled keys, those of the
smallest hash; of documents with one key the least text counts. A fifth of these is set aside to
fit the temperature. Corpus statistics and scores cover every document.

Defined results: a null text counts as empty; an empty text is scored by its counts alone;
repeated rows are scored each for itself; of several labels for one key the least counts, null
labels and keys are left aside; without labels of both classes every score is the share of class 1
(one half without any); an empty table gives an empty result; other columns are never inputs.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 13
DIMENSIONS = 32
NONZERO = 4
SAMPLE = 20_000
HIDDEN = 32
EPOCHS = 40
_SALTS = 32
_ROWS = 256
_SOME = 1 << 17
FEATURES = 2 * DIMENSIONS + 5


def _classes() -> bytes:
    table = bytearray(range(256))
    for c in range(256):
        ch = chr(c)
        table[c] = ord("a") if c > 127 or ch.islower() else ord("A") if ch.isupper() else ord(
            "0") if ch.isdigit() else c
    return bytes(table)


_CLASS = _classes()


def words_and_shapes(text: str | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Buckets of the words, buckets of their shapes, and the words."""
    raw = (text or "").encode()
    kinds = np.frombuffer(raw.translate(_CLASS), np.uint8)
    if len(kinds):
        kinds = kinds[np.append(True, kinds[1:] != kinds[:-1])]
    words, shapes = raw.lower().split(), kinds.tobytes().split()
    seed = zlib.crc32(b"shape")
    return (np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS,
            np.fromiter((zlib.crc32(s, seed) for s in shapes), np.int64, len(shapes)) % BUCKETS,
            words)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's index vector."""
    rng = np.random.default_rng(0)
    places = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    return places.astype(np.int64), rng.choice((-1.0, 1.0), (BUCKETS, NONZERO))


def _add_neighbours(table: np.ndarray, texts: list[np.ndarray], places, signs) -> None:
    """Adds to each word's vector the index vectors of the words beside it in its text."""
    ids = np.concatenate(texts)
    inside = np.ones(max(len(ids) - 1, 0), bool)
    ends = np.cumsum([len(t) for t in texts])[:-1]
    inside[ends[(ends > 0) & (ends < len(ids))] - 1] = False
    before = np.flatnonzero(inside)
    for a in range(0, len(before), _SOME):
        at = before[a:a + _SOME]
        for word, beside in ((ids[at], ids[at + 1]), (ids[at + 1], ids[at])):
            cells = (word[:, None] * DIMENSIONS + places[beside]).ravel()
            table += np.bincount(cells, signs[beside].ravel(), BUCKETS * DIMENSIONS)


def _tables(batches):
    """Texts -> the blocks of this task's table."""
    places, signs = index_vectors()
    table = np.zeros(BUCKETS * DIMENSIONS)
    held: list[np.ndarray] = []
    size = 0

    def flush():
        nonlocal size
        if held:
            _add_neighbours(table, held, places, signs)
        held.clear()
        size = 0

    for batch in batches:
        for text in batch.column(0):
            for ids in words_and_shapes(text.as_py())[:2]:
                held.append(ids)
                size += len(ids)
            if size >= _SOME:
                flush()
    flush()
    blocks = table.astype("<f4").reshape(-1, _ROWS * DIMENSIONS)
    some = np.flatnonzero(blocks.any(axis=1))
    salt = zlib.crc32(table.tobytes()) % _SALTS
    yield pa.RecordBatch.from_arrays(
        [pa.array(some, pa.int32()), pa.array([salt] * len(some), pa.int32()),
         pa.array([blocks[b].tobytes() for b in some], pa.binary())],
        names=["block", "salt", "data"])


def _summed(keep_salt: bool):
    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["block"], row["salt"] if keep_salt else 0)
                data = np.frombuffer(row["data"], "<f4").astype(np.float64)
                sums[key] = sums[key] + data if key in sums else data
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
             pa.array([v.astype("<f4").tobytes() for v in sums.values()], pa.binary())],
            names=["block", "salt", "data"])
    return run


def word_vectors(texts: DataFrame) -> np.ndarray:
    """The table of unit vectors, from a frame of one column of texts."""
    form = "block int, salt int, data binary"
    parts = texts.mapInArrow(_tables, form)
    parts = parts.repartition("block", "salt").mapInArrow(_summed(True), form)
    whole = parts.repartition("block").mapInArrow(_summed(False), form)
    table = np.zeros((BUCKETS // _ROWS, _ROWS * DIMENSIONS), np.float32)
    for row in whole.collect():  # BUCKETS x DIMENSIONS numbers, whatever the corpus
        table[row["block"]] = np.frombuffer(row["data"], "<f4")
    table = table.reshape(BUCKETS, DIMENSIONS)
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def _mean(vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
    total = np.zeros(DIMENSIONS)
    for a in range(0, len(ids), _SOME):
        total += vectors[ids[a:a + _SOME]].sum(axis=0)
    return total / max(len(ids), 1)


def features(text: str | None, vectors: np.ndarray) -> np.ndarray:
    ids, shapes, words = words_and_shapes(text)
    lines = [s for s in (text or "").split("\n") if s.strip()]
    n = max(len(words), 1)
    counts = (np.log1p(len(words)), np.log1p(sum(map(len, words)) / n), len(set(words)) / n,
              len(set(lines)) / max(len(lines), 1), (ids[1:] == ids[:-1]).sum() / n)
    return np.concatenate([_mean(vectors, ids), _mean(vectors, shapes), counts])


def _features(vectors):
    def run(batches):
        for batch in batches:
            rows = [features(t.as_py(), vectors.value).astype("<f4").tobytes()
                    for t in batch.column("t")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(rows, pa.binary())], names=["label", "x"])
    return run


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def predict(network: dict, x: np.ndarray) -> np.ndarray:
    """Probabilities of class 1: features -> HIDDEN (tanh) -> logit, over the temperature."""
    if "weights" not in network:
        return np.full(len(x), network["share"])
    return _sigmoid(_logits(network, x) / network["temperature"])


def _logits(network: dict, x: np.ndarray) -> np.ndarray:
    p = network["weights"]
    return np.tanh((x - network["mean"]) / network["scale"] @ p[0] + p[1]) @ p[2] + p[3]


def train(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> dict:
    """The network as plain arrays. Labels of one class, or none, give their share."""
    network: dict = {"share": float(y.mean()) if len(y) else 0.5}
    if len(set(y.tolist())) < 2:
        return network
    rng = np.random.default_rng(1)
    order = rng.permutation(len(y))
    x, y = x[order].astype(np.float64), y[order].astype(np.float64)
    aside = np.arange(len(y)) % 5 == 4 if len(y) >= 50 else np.ones(len(y), bool)
    fit = ~aside if len(y) >= 50 else aside
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    network |= {"mean": mean, "scale": scale, "weights": p}
    m, v = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
    scaled, rows, step = (x - mean) / scale, np.flatnonzero(fit), 0
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(rows), max(1, len(rows) // 128)):
            step += 1
            h = np.tanh(scaled[some] @ p[0] + p[1])
            d = (_sigmoid(h @ p[2] + p[3]) - y[some]) / len(some)
            dh = d[:, None] * p[2] * (1 - h * h)
            slopes = (scaled[some].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(keepdims=True))
            for k, g in enumerate(slopes):
                g = g + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] -= 3e-3 * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    z = _logits(network, x[aside])
    network["temperature"] = min(np.geomspace(0.25, 8, 61), key=lambda t: np.logaddexp(
        0, np.where(y[aside] == 1, -z, z) / t).mean())
    return network


def _scores(vectors, network):
    def run(batches):
        for batch in batches:
            rows = [features(t.as_py(), vectors.value) for t in batch.column("t")]
            got = predict(network.value, np.array(rows)) if rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("held_out"), pa.array(got, pa.float64()),
                 pa.array((got >= 0.5).astype(np.int32))],
                names=["key", "held_out", "score", "predicted"])
    return run


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality",
             text: str = "text", key: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """(key, held_out, score, predicted) of every document. ``held_out`` is a condition on the key
    column; labels of held-out keys are not read."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(held_out, F.lit(False)).alias(
        "held_out"), F.col(f"`{text}`").cast("string").alias("t"))
    vectors = spark.sparkContext.broadcast(word_vectors(rows.select("t")))
    known = labels.filter(~F.coalesce(held_out, F.lit(False))).groupBy(
        F.col(f"`{key}`").alias("key")).agg(F.min(F.col(f"`{label}`")).cast("int").alias("label"))
    chosen = known.filter("key is not null and label is not null").orderBy(
        F.xxhash64("key"), "key").limit(sample)  # the documented bound: a few hundred kB to send
    one_each = rows.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(
        F.min(F.coalesce("t", F.lit(""))).alias("t"))
    fitted = one_each.select("label", "t").mapInArrow(
        _features(vectors), "label int, x binary").collect()
    fitted.sort(key=lambda r: (r["label"], bytes(r["x"])))
    x = np.array([np.frombuffer(r["x"], "<f4") for r in fitted]).reshape(-1, FEATURES)
    network = spark.sparkContext.broadcast(train(x, np.array([r["label"] for r in fitted])))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        _scores(vectors, network), f"key {kind}, held_out boolean, score double, predicted int"
    ).withColumnRenamed("key", key)
