"""A quality classifier: random-indexing word vectors, a small network, calibrated probabilities.

1. Random indexing. Words are hashed to ``buckets`` rows. Each has a fixed index vector of random signs,
   drawn from the row number. A row's context vector is the sum of the index vectors of the words
   within ``window`` words, over the whole corpus: a table of fixed size however large the corpus is.
   Tasks sum up their own texts, and their tables are added in blocks of rows by two rounds of groups, so neither a
   group nor the driver takes one table per task.
2. Pooling. A document is the mean and the spread of its words' vectors, weighted down for frequent rows,
   and the logarithms of its words, different words and bytes per word.
3. A network of two layers in numpy on up to ``labelled_rows`` labelled documents (those with the smallest hash of
   their id), with a temperature fitted on a fifth of them that the weights never saw.

The model's weights are bounded by its parameters and go to all tasks.

Rules: a null text is empty; texts without words have vectors of zeros and a score like others. Labels that are null,
or contradict each other for one document, are not used. Without labels of both kinds all scores are 0.5. Repeated
rows are scored each. Columns of other names do not matter, and no others than the text are inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_texts, groups_of, hash_sample, stored, text_bytes

BLOCK_BYTES = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 14
    dimensions: int = 32
    window: int = 2
    hidden: int = 32
    epochs: int = 60
    seed: int = 7
    labelled_rows: int = 20_000

    def index_vectors(self) -> np.ndarray:
        """Random signs for each row."""
        draw = np.random.default_rng(self.seed)
        return draw.choice(np.array([-1, 0, 0, 1], np.float32), (self.buckets, self.dimensions))


def word_rows(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of texts: the rows of all words, the places where each text's begin and end, and the bytes of all words
    of each text. Words stand between white space, their case and signs included."""
    data, offsets = text_bytes(column)
    for begin, end in groups_of(offsets, BLOCK_BYTES):
        part, borders = data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        inside = ~_SPACE[part]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        first = borders[:-1][borders[:-1] < len(part)]
        start[first] = inside[first]
        places = np.flatnonzero(start)
        packed = np.concatenate([[0], np.cumsum(inside)])
        rows = np.zeros(0, np.int64)
        if len(places):
            coded = as_texts(part[inside], np.append(packed[places], packed[-1])).dictionary_encode()
            known = np.array([xxhash.xxh32_intdigest(word) % buckets for word in coded.dictionary.to_numpy(zero_copy_only=False)], np.int64)
            rows = known[coded.indices.to_numpy()]
        yield rows, np.searchsorted(places, borders), np.diff(packed[borders])


def _context_sums(rows: np.ndarray, borders: np.ndarray, signs: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the rows and sums of the signs of their words' neighbours in the same text."""
    n = len(rows)
    own = signs[rows]
    near = np.zeros_like(own)
    text = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    for step in range(1, window + 1):
        if n > step:
            same = (text[step:] == text[:-step])[:, None]
            near[step:] += own[:-step] * same
            near[:-step] += own[step:] * same
    order = np.argsort(rows, kind="stable")
    found, at = np.unique(rows[order], return_index=True)
    sums, counts = np.zeros_like(signs), np.zeros(len(signs))
    if n:
        sums[found] = np.add.reduceat(near[order], at, axis=0)
        counts[found] = np.diff(np.append(at, n))
    return counts, sums


def word_vectors(docs: DataFrame, settings: Settings, text_col: str = "text") -> np.ndarray:
    """A row (count, context vector) for each bucket, over all texts."""
    piece, width = 256, settings.dimensions + 1

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs = settings.index_vectors()
        table = np.zeros((settings.buckets, width))
        for batch in batches:
            for rows, borders, _ in word_rows(batch.column(0), settings.buckets):
                counts, sums = _context_sums(rows, borders, signs, settings.window)
                table[:, 0] += counts
                table[:, 1:] += sums
        pieces = [(k, table[k : k + piece]) for k in range(0, settings.buckets, piece)]
        pieces = [(k, x) for k, x in pieces if x[:, 0].any()]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in pieces], pa.int32()), pa.array([part] * len(pieces), pa.int32()), pa.array([x.astype(np.float64).tobytes() for _, x in pieces], pa.binary())], ["piece", "part", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in group.column("sums"))
        return pa.table({"piece": group.column("piece").slice(0, 1), "part": pa.array([0], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    kinds = "piece int, part int, sums binary"
    sums = docs.select(text_col).mapInArrow(collect, kinds)
    # of n tasks, groups of sqrt(n) and then sqrt(n) of these
    fan = max(2, int(docs.rdd.getNumPartitions() ** 0.5))
    sums = sums.withColumn("slot", F.pmod("part", F.lit(fan))).groupBy("piece", "slot").applyInArrow(add, kinds)
    found = np.zeros((settings.buckets, width))
    for row in sums.groupBy("piece").applyInArrow(add, kinds).collect():  # one row for 256 buckets
        own = np.frombuffer(bytes(row.sums)).reshape(-1, width)
        found[row.piece : row.piece + len(own)] = own
    return found


@dataclass
class QualityModel:
    settings: Settings
    vectors: np.ndarray
    weights: np.ndarray
    layers: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0

    @classmethod
    def from_sums(cls, sums: np.ndarray, settings: Settings) -> QualityModel:
        """Context vectors of unit length, and weights that fall with the frequency of a row."""
        norm = np.linalg.norm(sums[:, 1:], axis=1, keepdims=True)
        share = sums[:, 0] / max(1.0, sums[:, 0].sum())
        return cls(settings, (sums[:, 1:] / np.maximum(norm, 1e-9)).astype(np.float32), (1e-3 / (1e-3 + share)).astype(np.float32))

    def pool(self, column: pa.Array) -> np.ndarray:
        """A row of features for each text."""
        found = []
        for rows, borders, sizes in word_rows(column, self.settings.buckets):
            n = len(borders) - 1
            lengths = np.diff(borders)
            pooled = np.zeros((n, 2 * self.settings.dimensions + 3), np.float32)
            full = np.flatnonzero(lengths)
            if len(full):
                weight = self.weights[rows][:, None]
                vectors = self.vectors[rows]
                at = borders[:-1][full]
                total = np.add.reduceat(weight, at, axis=0)
                mean = np.add.reduceat(vectors * weight, at, axis=0) / total
                square = np.add.reduceat(vectors**2 * weight, at, axis=0) / total
                pooled[full, : self.settings.dimensions] = mean
                pooled[full, self.settings.dimensions : -3] = np.sqrt(np.maximum(square - mean**2, 0))
                text = np.repeat(np.arange(n), lengths)
                different = np.unique(text * self.settings.buckets + rows) // self.settings.buckets
                pooled[full, -3] = np.log(lengths[full])
                pooled[full, -2] = np.log(np.bincount(different, minlength=n)[full] / lengths[full])
                pooled[full, -1] = np.log(sizes[full] / lengths[full])
            found.append(pooled)
        return np.concatenate(found) if found else np.zeros((0, 2 * self.settings.dimensions + 3), np.float32)

    def logits(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.zeros(len(features))
        mean, spread, w1, b1, w2, b2 = self.layers
        hidden = np.maximum((features - mean) / spread @ w1 + b1, 0)
        return (hidden @ w2 + b2)[:, 0]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -30, 30)))

    def train(self, features: np.ndarray, labels: np.ndarray) -> None:
        """Adam on the cross entropy of both layers, both labels weighing the same; then the temperature that makes the
        probabilities of the fifth set aside likeliest, at the labels' own frequencies."""
        if len(np.unique(labels)) < 2:
            return
        draw = np.random.default_rng(self.settings.seed)
        order = draw.permutation(len(labels))
        aside, used = order[: len(order) // 5], order[len(order) // 5 :]
        x, y = features[used].astype(np.float64), labels[used].astype(np.float64)
        mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        hidden = self.settings.hidden
        layers = [draw.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), draw.normal(0, (1 / hidden) ** 0.5, (hidden, 1)), np.zeros(1)]
        x = (x - mean) / spread
        first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
        step = 0
        for _ in range(self.settings.epochs):
            for rows in np.array_split(draw.permutation(len(y)), max(1, len(y) // 128)):
                w1, b1, w2, b2 = layers
                before = x[rows] @ w1 + b1
                inner = np.maximum(before, 0)
                gap = (1 / (1 + np.exp(-np.clip(inner @ w2 + b2, -30, 30))) - y[rows][:, None]) / len(rows)
                back = gap @ w2.T * (before > 0)
                slopes = [x[rows].T @ back + 1e-4 * w1, back.sum(axis=0), inner.T @ gap + 1e-4 * w2, gap.sum(axis=0)]
                step += 1
                for k, slope in enumerate(slopes):
                    first[k] = 0.9 * first[k] + 0.1 * slope
                    second[k] = 0.999 * second[k] + 0.001 * slope**2
                    layers[k] = layers[k] - 3e-3 * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        self.layers = [mean, spread, *layers]
        logits, target = self.logits(features[aside]), labels[aside]
        if len(np.unique(target)) == 2:
            choices = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
            loss = [np.mean(np.logaddexp(0, np.where(target == 1, -1, 1) * logits / t)) for t in choices]
            self.temperature = float(choices[int(np.argmin(loss))])


def fit_quality_model(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", settings: Settings | None = None) -> QualityModel:
    """``labels``: ``id_col`` and ``label_col`` (0 or 1) of the rows to learn from."""
    settings = settings or Settings()
    model = QualityModel.from_sums(word_vectors(docs, settings, text_col), settings)
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter("_id is not null and label in (0, 1)")
    known = known.groupBy("_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other")
    known = hash_sample(known, "_id", settings.labelled_rows).select("_id", "label")
    # at most ``labelled_rows`` ids and labels
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id").select("label", "_text", "_id")

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = model.pool(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([x.tobytes() for x in features], pa.binary())], ["label", "id", "features"])

    id_kind = dict(docs.dtypes)[id_col]
    # in a fixed order, so that the same rows give the same model wherever they lay
    found = stored(rows.mapInArrow(pool, f"label int, id {id_kind}, features binary"), "features").orderBy("id", "features").select("label", "features").collect()
    if found:
        model.train(np.array([np.frombuffer(bytes(row.features), np.float32) for row in found]), np.array([row.label for row in found]))
    return model


def score_quality(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(model.pool(batch.column(1))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double, predicted int")
