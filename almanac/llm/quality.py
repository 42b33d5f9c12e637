"""Quality of documents by a factorisation machine.

The score of a text is a logistic function of ``bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``. The pairs are never
formed: per factor, their sum is half of the squared sum of ``v_i x_i`` less the sum of its squares, so a text takes time
linear in its features. These are the hashed words (log counts, scaled to length one), statistics of the structure (one
of several bins each, and the distance from the median) and hashed metadata.

The fit is small: at most ``MAX_ROWS`` labelled rows of each class come to the driver, as counts of word buckets, so at most
2 * MAX_ROWS * WORD_BUCKETS of them. Scoring needs one pass in Arrow batches and no shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.batches import fresh, map_batches, slices
from almanac.sources import table

# Bound of the training sample, for each class.
MAX_ROWS = 2_500
WORD_BUCKETS = 1 << 13
META_BUCKETS = 1 << 8
BINS = 16
FAR = 3.0
FACTORS = 8
PASSES = 12
BATCH = 128
RATE = 0.02
PENALTY = 1e-4
CACHED_WORDS = 200_000
SLICE_BYTES = 8 << 20
SEPARATOR = "\x1f"

# Statistics of the structure of a text, each a number.
STATISTICS = (
    "words", "word_length", "variety", "top_word", "upper", "digits", "stops", "marks", "symbols", "line_words",
    "line_variety", "high_bytes",
)
SIZE = WORD_BUCKETS + META_BUCKETS + len(STATISTICS) * (BINS + 1)

_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
_UPPER, _LOWER, _DIGITS = (np.arange(*span) for span in ((65, 91), (97, 123), (48, 58)))
_STOPS, _MARKS = (np.frombuffer(b, np.uint8) for b in (b".,;:", b"!?"))
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", np.uint8)


class Buckets(dict):
    """Bucket of each word met, by its hash; forgets all when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        bucket = self[word] = zlib.crc32(word) % WORD_BUCKETS
        return bucket


def features(text: str, buckets: Buckets) -> tuple[dict[int, int], list[float]]:
    """Occurrences by word bucket, and the statistics of the structure."""
    raw = text.encode()
    words = _WORDS(text.lower().encode())
    n, size = max(len(words), 1), max(len(raw), 1)
    counts = Counter(map(buckets.__getitem__, words))
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = raw.split(b"\n")
    letters = byte[_UPPER].sum() + byte[_LOWER].sum()
    return counts, [
        np.log1p(len(words)), sum(map(len, words)) / n, np.log1p(len(counts)) / np.log1p(n),
        max(counts.values(), default=0) / n, byte[_UPPER].sum() / max(letters, 1), byte[_DIGITS].sum() / size,
        byte[_STOPS].sum() / n, byte[_MARKS].sum() / n, byte[_SYMBOLS].sum() / n, n / len(lines), len(set(lines)) / len(lines),
        byte[128:].sum() / size,
    ]


def meta_buckets(meta: str) -> list[int]:
    return [WORD_BUCKETS + zlib.crc32(m.encode()) % META_BUCKETS for m in meta.split(SEPARATOR)] if meta else []


@dataclass
class Sparse:
    """Rows of features: row i has those from ``starts[i]`` to the next start."""

    ids: np.ndarray
    values: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, words: list[tuple[np.ndarray, np.ndarray]], meta: list[list[int]], statistics: np.ndarray, edges: np.ndarray):
        """From the buckets and counts of words, the buckets of metadata and the statistics of each row."""
        ids, values, sizes = [], [], []
        bins = np.stack([np.searchsorted(e, s, "left") for e, s in zip(edges, statistics.T)], 1)
        # Beside its bin, how far the statistic is from the median, in spreads between the outer edges.
        spread = np.maximum(edges[:, -1] - edges[:, 0], 1e-9)
        far = np.clip((statistics - edges[:, BINS // 2 - 1]) / spread, -FAR, FAR)
        first = WORD_BUCKETS + META_BUCKETS + np.arange(len(STATISTICS)) * (BINS + 1)
        for (bucket, counted), of_meta, bin_of, distance in zip(words, meta, bins, far):
            weight = np.log1p(counted)
            length = np.sqrt((weight * weight).sum()) or 1.0
            of_meta = sorted(set(of_meta))
            ids += [bucket, np.array(of_meta, np.int64), first + bin_of, first + BINS]
            values += [weight / length, np.ones(len(of_meta) + len(bin_of)), distance]
            sizes.append(len(bucket) + len(of_meta) + 2 * len(bin_of))
        return cls(np.concatenate(ids).astype(np.int64), np.concatenate(values), np.cumsum(sizes) - sizes)

    def rows(self, chosen: np.ndarray) -> Sparse:
        ends = np.append(self.starts[1:], len(self.ids))
        sizes = ends[chosen] - self.starts[chosen]
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[chosen] - starts, sizes) + np.arange(sizes.sum())
        return Sparse(self.ids[at], self.values[at], starts)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts, axis=0)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts)), np.diff(np.append(self.starts, len(self.ids))))


@dataclass
class FactorModel:
    """Parameters of the machine, and the edges of the bins of each statistic."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    edges: np.ndarray

    def margin(self, x: Sparse) -> np.ndarray:
        """bias + linear part + pairs, by the identity of squares."""
        scaled = self.factors[x.ids] * x.values[:, None]
        sums = x.sums(scaled)
        pairs = 0.5 * ((sums * sums) - x.sums(scaled * scaled)).sum(1)
        return self.bias + x.sums(self.weights[x.ids] * x.values) + pairs

    def gradient(self, x: Sparse, y: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        """Mean logistic loss, and its slopes in the bias, the weights and the factors."""
        margin = self.margin(x)
        slope = (_sigmoid(margin) - y) / len(y)
        loss = float(np.mean(np.logaddexp(0, margin) - y * margin))
        row = x.row_of()
        by_feature = slope[row] * x.values
        scaled = self.factors[x.ids] * x.values[:, None]
        each = by_feature[:, None] * (x.sums(scaled)[row] - scaled)
        factors = np.stack([np.bincount(x.ids, each[:, f], len(self.weights)) for f in range(each.shape[1])], 1)
        return loss, float(slope.sum()), np.bincount(x.ids, by_feature, len(self.weights)), factors


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: Sparse, y: np.ndarray, edges: np.ndarray, passes: int = PASSES, factors: int = FACTORS) -> FactorModel:
    """Penalised logistic loss by steps with adaptive rates over shuffled batches; deterministic.

    The classes weigh the same whatever their sizes. With one class only, the score is its smoothed share.
    """
    random = np.random.default_rng(1)
    model = FactorModel(0.0, np.zeros(SIZE), random.normal(0, 0.05, (SIZE, factors)), edges)
    positive, negative = np.flatnonzero(y == 1), np.flatnonzero(y != 1)
    if not len(positive) or not len(negative):
        share = (len(positive) + 1) / (len(y) + 2)
        return FactorModel(float(np.log(share / (1 - share))), np.zeros(SIZE), np.zeros((SIZE, factors)), edges)
    longer = max(len(positive), len(negative))
    both = [np.resize(part, longer) for part in (positive, negative)]
    state = [np.zeros(1 + SIZE * (1 + factors)) for _ in range(2)]
    theta = np.concatenate([[model.bias], model.weights, model.factors.ravel()])
    step = 0
    for _ in range(passes):
        order = np.stack([random.permutation(part) for part in both], 1).ravel()
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            _, bias, weights, by_factor = model.gradient(x.rows(chosen), y[chosen])
            slope = np.concatenate([[bias], weights, by_factor.ravel()])
            slope[1:] += PENALTY * theta[1:]
            step += 1
            state[0] = 0.9 * state[0] + 0.1 * slope
            state[1] = 0.999 * state[1] + 0.001 * slope * slope
            theta = theta - RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
            model = FactorModel(float(theta[0]), theta[1 : 1 + SIZE], theta[1 + SIZE :].reshape(SIZE, factors), edges)
    return model


def bin_edges(statistics: np.ndarray) -> np.ndarray:
    """Quantiles that cut each statistic into BINS bins of about as many rows; a row of edges for each statistic."""
    if not len(statistics):
        return np.zeros((len(STATISTICS), BINS - 1))
    return np.quantile(statistics, np.arange(1, BINS) / BINS, axis=0, method="lower").T


def held_out(key: Column) -> Column:
    """Rows never trained on: a third of the hashes of the key. A null key has no label and counts as not held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def _meta_tokens(docs: DataFrame, columns: tuple[str, ...]) -> Column:
    """Numbers by quarters of powers of two, other values as they are; nulls give no token."""
    tokens = []
    for name in columns:
        value = F.col(name)
        if isinstance(docs.schema[name].dataType, T.NumericType):
            value = F.round(4 * F.log2(F.abs(value.cast("double")) + 1)) * F.signum(value.cast("double"))
        tokens.append(F.concat(F.lit(f"{name}="), value.cast("string")))
    return F.array_join(F.array(*tokens), SEPARATOR) if tokens else F.lit("")


def training_rows(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...], max_rows: int) -> DataFrame:
    """quality (0 or 1), key, text and meta of labelled rows that are not held out.

    At most ``max_rows`` labels of each class, those with the smallest hashes; of equal texts with one label one row.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    # Of several labels of a document the lowest holds.
    known = known.groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("quality"))
    sample = None
    for quality in (0, 1):
        part = known.filter(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        sample = part if sample is None else sample.unionByName(part)
    text = F.coalesce("text", F.lit(""))
    found = docs.select(F.col("doc_id"), text.alias("text"), _meta_tokens(docs, metadata).alias("meta"))
    # A label a row, two of them small: a sample of bounded size.
    joined = found.join(F.broadcast(sample), "doc_id").withColumn("key", F.xxhash64("text"))
    return joined.dropDuplicates(["key", "quality"]).select("quality", "key", "meta", "text")


def _counted(rows: DataFrame) -> DataFrame:
    """quality, key, meta, buckets, counts and statistics of the rows."""
    added = "buckets array<int>, counts array<int>, statistics array<double>"
    schema = T.StructType(rows.drop("text").schema.fields + T._parse_datatype_string(added).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = [features(t, buckets) for t in part.column("text").to_pylist()]
                new = [
                    pa.array([list(c) for c, _ in found], pa.list_(pa.int32())),
                    pa.array([list(c.values()) for c, _ in found], pa.list_(pa.int32())),
                    pa.array([s for _, s in found], pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], schema.names)

    return map_batches(rows, run, schema)


def train(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = (), max_rows: int = MAX_ROWS) -> FactorModel:
    """Fit on labelled documents that are not held out.

    ``docs`` has doc_id, text and the columns of metadata, ``labels`` doc_id and quality; rows with a null doc_id or quality
    are left out. At most 2 * ``max_rows`` rows come to the driver, also where a doc_id repeats.
    """
    counted = _counted(training_rows(docs, labels, metadata, max_rows)).orderBy("key", "quality").limit(2 * max_rows)
    found = counted.toArrow().to_pydict()
    order = sorted(range(len(found["key"])), key=lambda i: (found["key"][i], found["quality"][i]))
    statistics = np.array([found["statistics"][i] for i in order], float).reshape(-1, len(STATISTICS))
    edges = bin_edges(statistics)
    if not order:
        return fit(Sparse(np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)), np.empty(0), edges)
    words = [(np.array(found["buckets"][i], np.int64), np.array(found["counts"][i], float)) for i in order]
    x = Sparse.of(words, [meta_buckets(found["meta"][i]) for i in order], statistics, edges)
    return fit(x, np.array([found["quality"][i] for i in order], float), edges)


def scored(
    docs: DataFrame, model: FactorModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    metadata: tuple[str, ...] = (),
) -> DataFrame:
    """The kept columns and score, the chance of label 1.

    A null text counts as empty and is scored by its structure. Rows are independent: repeated rows are scored each, null
    keys and nulls in metadata are allowed, other columns are not read. Equal texts with equal metadata score the same.
    """
    own, meta_name = fresh("_text", keep), fresh("_meta", keep)
    source = docs.select(
        *[F.col(c) for c in keep], _meta_tokens(docs, metadata).alias(meta_name), F.coalesce(F.col(text), F.lit("")).alias(own)
    )
    schema = T.StructType([*source.schema.fields[:-2], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            for part in slices(batch, own, SLICE_BYTES):
                meta, texts = (part.column(name).to_pylist() for name in (meta_name, own))
                found = [features(t, buckets) for t in texts]
                words = [
                    (np.fromiter(c, np.int64, len(c)), np.fromiter(c.values(), float, len(c))) for c, _ in found
                ]
                x = Sparse.of(words, list(map(meta_buckets, meta)), np.array([s for _, s in found], float), model.edges)
                score = _sigmoid(model.margin(x))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(score, pa.float64())], schema.names)

    return map_batches(source, run, schema)


def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "n_chars")
    model = train(docs, table(spark, folder, "labels", "doc_id", "quality"), ("n_chars",))
    found = scored(docs, model, metadata=("n_chars",))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


QUERIES = {"op11_quality": op11_quality}
ORACLES: dict[str, str] = {}
