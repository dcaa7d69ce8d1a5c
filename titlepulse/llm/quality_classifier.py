"""Quality classifier: ordinal regression with cumulative links on graded ratings.

P(grade <= g) = sigmoid(threshold_g - score), with one weight per hashed feature shared by all grades and
thresholds in ascending order.  Features are the distinct lower-cased words of the whole text and, in steps, the
shares of capitals, symbols, exclamation marks, bars, digits and repeated words.  A document's expected grade is the
sum of P(grade >= g); its tail probability, P(grade >= the highest), decides.

The model is fitted in one task on a bounded sample, ``TRAIN_ROWS`` rated documents with the smallest hashes of
their ids; features are made, and documents scored, in parallel.  Ratings that are null are no ratings; a document
rated more than once counts with the lowest.  Null and empty texts have the features of an empty text.  Without two
different grades in the ratings there is nothing to learn, and every score is null and every document kept.
Repeated rows get equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlepulse.llm.common import arrow_map

TRAIN_ROWS = 8000
BITS = 18
STEPS, RATE, SHRINK = 300, 0.1, 5e-4
KEEP_FROM = 0.5

EDGES = b".,;:!?\"'()"
# Features in fewer rated documents get no weight: with many rare words, they would learn the sample by heart.
LEAST_DOCS = 8
# Characters counted for the features in steps.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "symbol": b"#*$%&<>{}[]~^=", "exclaim": b"!", "bar": b"|", "digit": b"0123456789"}


def features(text: str | None) -> np.ndarray:
    """The distinct feature numbers of a text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = [w.strip(EDGES) for w in data.lower().split()]
    distinct = set(words)
    size = max(1, len(data))
    shares = {name: (size - len(data.translate(None, members))) / size for name, members in CLASSES.items() if data}
    shares["distinct"] = len(distinct) / max(1, len(words))
    stepped = [f"\n{name}:{min(10, int(share * 20 + 0.999))}".encode() for name, share in shares.items()]
    numbers = np.fromiter(map(xxhash.xxh3_64_intdigest, [*distinct, *stepped]), np.uint64, len(distinct) + len(stepped))
    return np.unique(numbers & np.uint64((1 << BITS) - 1)).astype(np.int32)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(lists: list[np.ndarray], grades: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(weights, thresholds)`` by gradient steps over all rows at once, scaled by the gradients' running moments.

    After each step weights shrink by a fixed amount towards 0, so that most features end with none.
    """
    docs = np.arange(len(lists))
    rows = np.repeat(docs, [len(x) for x in lists])
    columns = np.concatenate(lists)
    common = np.bincount(columns, minlength=1 << BITS)[columns] >= min(LEAST_DOCS, len(lists) // 4)
    used, columns = np.unique(columns[common], return_inverse=True)
    rows, levels = rows[common], int(grades.max())
    above = np.array([max(1e-3, min(1 - 1e-3, (grades > g).mean())) for g in range(levels)])
    bare = np.log((1 - above) / above)
    # parameters: weights, the first threshold, and the logarithms of the gaps between thresholds
    x = np.concatenate([np.zeros(len(used)), bare[:1], np.log(np.maximum(np.diff(bare), 1e-2))])
    first, second = np.zeros(len(x)), np.zeros(len(x))
    for step in range(1, STEPS + 1):
        weights, gaps = x[: len(used)], np.exp(x[len(used) + 1 :])
        thresholds = x[len(used)] + np.concatenate([[0.0], np.cumsum(gaps)])
        scores = np.bincount(rows, weights[columns], len(lists))
        cumulative = sigmoid(thresholds[None, :] - scores[:, None])
        full = np.hstack([np.zeros((len(lists), 1)), cumulative, np.ones((len(lists), 1))])
        slope = full * (1 - full)
        p = np.maximum(full[docs, grades + 1] - full[docs, grades], 1e-9)
        high, low = slope[docs, grades + 1] / p / len(lists), slope[docs, grades] / p / len(lists)
        by_threshold = np.array([low[grades == g + 1].sum() - high[grades == g].sum() for g in range(levels)])
        tails = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([np.bincount(columns, (high - low)[rows], len(used)), tails[:1], tails[1:] * gaps])
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient**2 - second)
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        size = rate / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        x -= size * first / (1 - 0.9**step)
        x[: len(used)] = np.sign(x[: len(used)]) * np.maximum(np.abs(x[: len(used)]) - np.minimum(size[: len(used)] * SHRINK, rate), 0)
    weights = np.zeros(1 << BITS)
    weights[used] = x[: len(used)]
    return weights, x[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(x[len(used) + 1 :]))])


def grades_of(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)``: 0 toxic, 1 of low quality, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") >= 1) & (F.col("toxic") == 0), 2)
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade")).where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, grades: DataFrame, rows: int = TRAIN_ROWS):
    """``(weights, thresholds)``, or None where the ratings hold fewer than two grades."""
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rated = bare.join(F.broadcast(chosen), "doc_id").select("text", "grade")

    def extract(batch):
        yield {"grade": batch.column("grade").to_pylist(), "f": [features(t.as_py()) for t in batch.column("text")]}

    def learn(batches):
        lists, grades_seen = [], []
        for batch in batches:
            grades_seen += batch.column("grade").to_pylist()
            lists += [x.values.to_numpy() for x in batch.column("f")]
        if len(set(grades_seen)) > 1:
            # the order of rows must not matter
            order = sorted(range(len(lists)), key=lambda n: (grades_seen[n], lists[n].tobytes()))
            weights, thresholds = fit([lists[n] for n in order], np.array([grades_seen[n] for n in order]))
            yield pa.RecordBatch.from_pydict({"w": [weights.astype("<f4").tobytes()], "t": [thresholds.tolist()]}, schema=pa.schema([("w", pa.binary()), ("t", pa.list_(pa.float64()))]))

    # repartition, not coalesce: only the features of at most ``rows`` documents come together, the texts are read in parallel
    model = arrow_map(rated, extract, "grade int, f array<int>").repartition(1).mapInArrow(learn, "w binary, t array<double>").collect()
    return (np.frombuffer(model[0]["w"], "<f4").astype(float), np.array(model[0]["t"])) if model else None


def grade(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, kept`` of every document."""
    model = train(docs, grades_of(labels), rows)
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers

    def score(batch):
        model = held.value
        out = {"doc_id": batch.column("doc_id").to_pylist(), "expected_grade": [], "tail_probability": [], "kept": []}
        for text in batch.column("text"):
            if model is None:
                expected, tail = None, None
            else:
                above = 1 - sigmoid(model[1] - model[0][features(text.as_py())].sum())
                expected, tail = float(above.sum()), float(above[-1])
            out["expected_grade"].append(expected)
            out["tail_probability"].append(tail)
            out["kept"].append(tail is None or tail >= keep_from)
        yield out

    bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(bare, score, "doc_id long, expected_grade double, tail_probability double, kept boolean")
