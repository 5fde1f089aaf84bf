"""Toxicity of texts by a factorization machine over hashed terms.

The log odds of a text are b + sum of w_i + sum over pairs of v_i . v_j, over its distinct terms i < j: besides each term's
own weight, what two terms say together (an insult beside the name of a group) counts, by short vectors that all pairs share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glycotide.llm.quality import bucket, features
from glycotide.llm.shared import discard, require, text_or_empty, tidy, written_at

#: Labelled rows that a fit uses at most (those of the smallest hash of their id), length of a term's vector, and labelled
#: rows in which a term's bucket must occur: rarer ones say nothing about other texts and have no weight.
SAMPLE, FACTORS, LEAST_ROWS = 10_000, 8, 5
#: Terms whose bucket a worker keeps.
MOST_KNOWN = 150_000


@dataclass
class FactorizationMachine:
    """``slots``: per bucket the row of ``table`` (0: none); a row is a weight and a vector. ``bias``: log odds of no terms."""

    bias: float
    slots: np.ndarray
    table: np.ndarray

    def log_odds(self, buckets: np.ndarray) -> float:
        """Of a text with these distinct buckets, in ascending order so that sums are the same in each run."""
        rows = self.slots[buckets]
        return self.of_rows(rows[rows > 0])

    def of_rows(self, rows: np.ndarray) -> float:
        if not len(rows):
            return self.bias
        found = self.table[rows].astype(np.float64)
        v = found[:, 1:]
        together = v.sum(0)
        return self.bias + float(found[:, 0].sum()) + 0.5 * float(together @ together - (v * v).sum())


def fit_machine(starts: np.ndarray, terms: np.ndarray, toxic: np.ndarray, n_terms: int, factors: int = FACTORS, steps: int = 240, shrink: float = 0.3, rest: int = 240, rest_shrink: float = 0.05, seed: int = 0) -> tuple[float, np.ndarray]:
    """Bias and table (a weight and a vector per term, row 0 for none) that make the labels likeliest, few of them non-zero.

    Row r has the terms terms[starts[r]:starts[r + 1]] (1 to n_terms). ``steps`` with a strong pull towards 0 choose the weights
    and vectors that say something; ``rest`` more on these alone, with a weak one, give them the size that the pull took.
    """
    rng = np.random.default_rng(seed)
    share = (toxic.sum() + 1) / (len(toxic) + 2)
    theta = np.zeros((n_terms + 1, factors + 1))
    theta[1:, 1:] = rng.normal(0, 0.05, (n_terms, factors))
    bias, theta = descend(starts, terms, toxic, float(np.log(share / (1 - share))), theta, steps, shrink, rng)
    chosen = np.flatnonzero(theta.any(1))
    row = np.zeros(n_terms + 1, np.int64)
    row[chosen] = np.arange(1, len(chosen) + 1)
    kept = row[terms] > 0
    bias, few = descend(np.concatenate([[0], np.cumsum(kept)])[starts], row[terms[kept]], toxic, bias, np.vstack([theta[:1], theta[chosen]]), rest, rest_shrink, rng)
    theta[chosen] = few[1:]
    return bias, theta.astype(np.float32)


def descend(starts: np.ndarray, terms: np.ndarray, toxic: np.ndarray, bias: float, theta: np.ndarray, steps: int, shrink: float, rng: np.random.Generator, rate: float = 0.05, size: int = 512) -> tuple[float, np.ndarray]:
    """Adam with a falling rate over batches in a drawn order; after each step weights, and vectors by their length, shrink
    by a fixed amount. What is 0 at the start stays 0."""
    n, n_terms, factors = len(toxic), len(theta) - 1, theta.shape[1] - 1
    m, v, mb, vb, step, free = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0, 0, theta != 0
    free[:, 0] |= not theta[:, 0].any()
    while step < steps:
        order = rng.permutation(n)
        for at in range(0, min(n, (steps - step) * size), size):
            rows = order[at : at + size]
            lengths = starts[rows + 1] - starts[rows]
            owner = np.repeat(np.arange(len(rows)), lengths)
            own = terms[np.repeat(starts[rows] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())]
            x = theta[own]
            sums = np.stack([np.bincount(owner, x[:, j], len(rows)) for j in range(factors + 1)], 1)
            squares = np.bincount(owner, (x[:, 1:] ** 2).sum(1), len(rows))
            odds = np.clip(bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - squares), -30, 30)
            wrong = (1 / (1 + np.exp(-odds)) - toxic[rows]) / len(rows)
            each = wrong[owner]
            g = np.empty_like(theta)
            g[:, 0] = np.bincount(own, each, n_terms + 1)
            for j in range(1, factors + 1):
                g[:, j] = np.bincount(own, each * (sums[owner, j] - x[:, j]), n_terms + 1)
            gb, now, step = wrong.sum(), rate * (1 - step / steps), step + 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            c1, c2 = 1 - 0.9**step, 1 - 0.999**step
            theta -= free * now * (m / c1) / (np.sqrt(v / c2) + 1e-6)
            bias -= now * (mb / c1) / (np.sqrt(vb / c2) + 1e-6)
            theta[:, 0] = np.sign(theta[:, 0]) * np.maximum(np.abs(theta[:, 0]) - now * shrink, 0)
            long = np.sqrt((theta[:, 1:] ** 2).sum(1))
            theta[:, 1:] *= (np.maximum(long - now * shrink, 0) / np.maximum(long, 1e-12))[:, None]
        theta[0] = 0
    return bias, theta


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row's id falls into the fold that no fit sees; rows without an id don't."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1 << 18, **how) -> FactorizationMachine:
    """Fits on at most ``sample`` labelled documents outside the held-out fold, by text and label alone.

    Labels other than 0 and 1, those without a document, and ids whose labels differ don't count; a document row of a
    repeated id counts for itself (of more than twice the sample, those of the smallest hash). Where one of the two labels is not to be had, all texts score as that the other is certain (no label: 0).
    """
    require(docs, id_col, text_col)
    require(labels, id_col, label)
    known = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label"))
    known = known.filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id")).groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_most")).filter("_label = _most")
    # the documents' ids first: labels of other rows must not fill the sample
    ids = docs.select(F.col(f"`{id_col}`").alias("_id"))
    chosen, path = written_at(known.join(ids, "_id", "left_semi").select("_id", "_label").orderBy(F.xxhash64("_id"), "_id").limit(sample), "toxicity-labels")
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(f"`{text_col}`").alias("_text")).join(F.broadcast(chosen), "_id").select("_label", "_text")

    def run(batches):
        for batch in batches:
            terms = [sorted({bucket(f) % buckets for f in features(t)}) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"label": batch.column(0), "terms": pa.array(terms, pa.list_(pa.int32()))})

    rows = texts.mapInArrow(tidy(run), "label int, terms array<int>")
    table = rows.orderBy(F.xxhash64("terms"), "terms", "label").limit(2 * sample).toArrow().combine_chunks()
    discard(docs.sparkSession, path)
    slots = np.zeros(buckets, np.int32)
    toxic = table.column("label").to_numpy().astype(float)
    if len(np.unique(toxic)) < 2:
        return FactorizationMachine(np.inf if toxic.sum() else -np.inf, slots, np.zeros((1, FACTORS + 1), np.float32))
    lists = table.column("terms").chunk(0)
    columns, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    used = np.flatnonzero(np.bincount(columns, minlength=buckets) >= LEAST_ROWS)
    slots[used] = np.arange(1, len(used) + 1)
    kept = slots[columns] > 0
    starts = np.concatenate([[0], np.cumsum(kept)])[offsets]
    bias, theta = fit_machine(starts, slots[columns[kept]], toxic, len(used), **how)
    return FactorizationMachine(bias, slots, theta)


def score(docs: DataFrame, machine: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on) of every row, by its whole text alone; a null text is empty."""
    require(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # at most a weight and a vector per bucket

    def run(batches):
        machine, known = shared.value, {}
        slots = machine.slots.tolist()
        for batch in batches:
            odds = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = features(text)
                new = found.difference(known)
                if len(known) + len(new) > MOST_KNOWN:
                    known.clear()
                    new = found
                known.update((f, slots[bucket(f) % len(slots)]) for f in new)
                rows = set(map(known.__getitem__, found))
                rows.discard(0)
                odds[i] = machine.of_rows(np.array(sorted(rows), np.int64))
            with np.errstate(over="ignore"):
                scores = 1 / (1 + np.exp(-odds))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_or_empty(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double, predicted int")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fits on the labels outside the held-out fold and scores all of ``docs``."""
    return score(docs, fit(docs, labels))
