"""Quality grades by ordinal regression: one set of hashed-text weights, one threshold per step between grades.

P(grade >= k) = sigmoid(w.x - t_k) with t_1 < t_2 < ..., so one score orders all grades.
"""

from __future__ import annotations

import math
import re
import warnings
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glycotide.llm.shared import discard, require, text_or_empty, tidy, written, written_at

#: Labelled rows that the fit uses at most (those of the smallest hash of their id); weights, one per bucket of feature
#: hashes; labelled rows from which a bucket's weight is fitted (fewer say nothing about other texts: it stays 0).
SAMPLE, BUCKETS, LEAST_ROWS = 10_000, 1 << 18, 8
#: Features whose bucket a worker keeps.
MOST_KNOWN = 150_000
#: Letters of a word's beginning, which is a feature of its own: words of one stem then share a weight.
STEM = 4
_WORD = re.compile(r"\w+")
#: Marks whose share among the words of a text is a feature, by powers of two.
MARKS = "!|#$%&*?<>{}@"


def shape_features(text: str, n_words: int) -> list[str]:
    """Names that no word can have: for each mark the level of its share, and that of upper-case letters."""
    n = max(n_words, 1)
    counts = {m: c for m in MARKS if (c := text.count(m))}
    out = [f"{m} {min(8, int(8 * c / n).bit_length())}" for m, c in counts.items()]
    out.append(f"marks {min(12, int(64 * sum(counts.values()) / n).bit_length())}")
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    return [*out, f"upper {min(10, 10 * upper // max(1, len(text)))}", f"length {n.bit_length()}"]


def features(text: str) -> set[str]:
    """The distinct words of the whole text, lower case, their beginnings, and the text's shape."""
    words = _WORD.findall(text.lower())
    out = set(words)
    out.update(["^" + stem for stem in {w[:STEM] for w in out if len(w) > STEM}])
    return out.union(shape_features(text, len(words)))


def bucket(name: str) -> int:
    """The weight that a feature has: features of one bucket share it."""
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


@dataclass
class OrdinalModel:
    """A weight per bucket and ascending thresholds; there is one more grade than there are thresholds."""

    weights: np.ndarray
    thresholds: list[float]

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., a column each."""
        return 1 / (1 + np.exp(-(scores[:, None] - np.array(self.thresholds)[None, :])))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, n_columns: int, n_grades: int, rounds: int = 200, rate: float = 0.1, penalty: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that make the grades likeliest, with a quadratic penalty; full-batch Adam, no random numbers.

    rows, columns: the non-zero entries (all 1) of the feature matrix.
    """
    n = len(grades)
    share = np.array([(np.sum(grades >= k) + 1) / (n + 2) for k in range(1, n_grades)])
    start = -np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    w = np.zeros(n_columns + n_grades - 1)
    w[n_columns], w[n_columns + 1 :] = start[0], gaps
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for step in range(1, rounds + 1):
        score = np.bincount(rows, w[columns], n)
        t = np.concatenate([w[n_columns : n_columns + 1], w[n_columns] + np.cumsum(np.exp(w[n_columns + 1 :]))])
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        low, high = edges[grades], edges[grades + 1]  # P(grade) = sigmoid(s - low) - sigmoid(s - high)
        a = np.where(np.isinf(low), 1.0, sigmoid(score - low))
        b = np.where(np.isinf(high), 0.0, sigmoid(score - high))
        p = np.maximum(a - b, 1e-12)
        d_low, d_high = a * (1 - a) / p, b * (1 - b) / p
        d_score = -(d_low - d_high)  # of the negative log likelihood
        g = np.zeros_like(w)
        g[:n_columns] = np.bincount(columns, d_score[rows], n_columns) + penalty * w[:n_columns]
        d_t = np.array([np.sum(d_low[grades == k + 1]) - np.sum(d_high[grades == k]) for k in range(n_grades - 1)])
        g[n_columns] = d_t.sum()
        for j in range(1, n_grades - 1):
            g[n_columns + j] = np.exp(w[n_columns + j]) * d_t[j:].sum()
        g /= n
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:n_columns], np.concatenate([w[n_columns : n_columns + 1], w[n_columns] + np.cumsum(np.exp(w[n_columns + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, grade: Column, n_grades: int, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel | None:
    """Fits on at most ``sample`` labelled rows; None if no two grades are among them.

    ``grade`` is 0 to n_grades - 1 over ``labels``; null grades, and labels without a document, don't count: the sample is
    drawn from labelled documents. It is the fit's only bound: scoring takes every row and whole texts. Where there is no
    model, that is warned of.
    """
    require(docs, id_col, text_col)
    chosen = labels.select(F.col(id_col).cast("long").alias("_id"), grade.cast("int").alias("grade")).filter("grade is not null and _id is not null").groupBy("_id").agg(F.min("grade").alias("grade"))
    ids = docs.select(F.col(id_col).cast("long").alias("_id"))
    chosen, path = written_at(chosen.join(ids, "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(sample), "labelled")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"grade": batch.column(0), "features": pa.array([sorted({bucket(f) for f in features(t)}) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))})

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "_id").select("grade", "text")
    rows = written(texts.mapInArrow(tidy(run), "grade int, features array<int>"), "labelled-features")
    # at most ``sample`` rows, in an order of their own, so that sums, too, are the same in each run
    table = rows.orderBy("grade", F.xxhash64("features"), "features").toArrow().combine_chunks()
    grades, lists = table.column("grade").to_numpy(), table.column("features").chunk(0) if table.num_rows else None
    discard(docs.sparkSession, path)
    if len(np.unique(grades)) < 2:
        warnings.warn(f"no two grades among {len(grades)} labelled documents: there is no model, and all rows are kept", stacklevel=2)
        return None
    columns = lists.flatten().to_numpy().astype(np.int64)
    used = np.bincount(columns, minlength=BUCKETS)[columns] >= LEAST_ROWS
    at = np.repeat(np.arange(len(grades)), np.diff(lists.offsets.to_numpy()))
    w, t = fit_ordinal(at[used], columns[used], grades, BUCKETS, n_grades)
    return OrdinalModel(w, [float(x) for x in t])


def score(docs: DataFrame, model: OrdinalModel | None, least: int, tail: float = 0.5, id_col: str = "doc_id", text_col: str = "text", carry: str | None = None) -> DataFrame:
    """doc_id, expected_grade, p_at_least (an array: of 1, of 2, ...), kept: P(grade >= least) >= tail. One row per row.

    The column ``carry`` comes along. A null text is empty; equal texts get equal grades. Without a model all rows are kept and their grades are null.
    """
    require(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights
    names = ["doc_id", "expected_grade", "p_at_least", "kept", *([carry] if carry else [])]

    def run(batches):
        model = shared.value
        weights, known = model.weights.tolist() if model else [], {}
        for batch in batches:
            ids, texts, carried = batch.column(0), batch.column(1).to_pylist(), [batch.column(2)] if carry else []
            if model is None:
                yield pa.RecordBatch.from_arrays([ids, pa.nulls(len(ids), pa.float64()), pa.nulls(len(ids), pa.list_(pa.float64())), pa.array([True] * len(ids)), *carried], names=names)
                continue
            scores = np.zeros(len(texts))
            for i, text in enumerate(texts):
                found = features(text)
                new = found.difference(known)
                if len(known) + len(new) > MOST_KNOWN:
                    known.clear()
                    new = found
                known.update((f, bucket(f)) for f in new)
                scores[i] = math.fsum(map(weights.__getitem__, set(map(known.__getitem__, found))))  # exact, so the order plays no part
            p = model.tails(scores)
            yield pa.RecordBatch.from_arrays([ids, pa.array(p.sum(axis=1)), pa.array(list(p), pa.list_(pa.float64())), pa.array(p[:, least - 1] >= tail), *carried], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), *([carry] if carry else []))
    schema = StructType.fromDDL("doc_id long, expected_grade double, p_at_least array<double>, kept boolean")
    return rows.mapInArrow(tidy(run), schema.add(docs.schema[carry]) if carry else schema)


def keep_good(docs: DataFrame, model: OrdinalModel | None, least: int, tail: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``score`` keeps. Texts are scored where they are read: nothing is shuffled."""
    graded = score(docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])), model, least, tail, id_col, text_col, carry="_row")
    return graded.filter("kept").select("_row.*")


def grade_column() -> Column:
    """The grade of a row of ``labels``: 0 toxic, 1 clean but poor, 2 clean and good."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fits on the labels of ``docs`` and scores all of it; rows whose grade is likelier 2 than less are kept."""
    return score(docs, fit(docs, labels, grade_column(), 3), least=2)
