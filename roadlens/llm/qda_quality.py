"""Quality classifier: regularised quadratic discriminant analysis (operator 5).

Each document is described by transformed statistics of its whole text
(``FEATURES``). Each class gets a Gaussian whose covariance is shrunk towards
a diagonal; its Cholesky factor is computed once and kept in the model. The
score of a document is the logistic function of the difference of the two
log densities (from Mahalanobis distances) plus the log odds of the classes.

Fitting reads all labelled training rows: tasks add up counts, sums and outer
products per class, and only those totals (a fixed number of numbers) reach
the driver. No feature uses doc_id, lang, source or labels.

Defined cases: null text counts as empty; every text has finite statistics
(empty ones the zero vector), so every row is scored; rows with a null doc_id
are scored and never train; labels other than 0 and 1 are ignored; repeated
label rows count as often as they occur; a class without training rows leaves
the score at 1 if it is class 0 that is missing (nothing to reject by) and 0
if class 1 is; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import small_slices, text_or_empty, utf8_buffers, written
from roadlens.llm.token_ids import SPACES, piece_bounds, piece_names

SHRINKAGE = 0.05
RIDGE = 1e-2
KEEP_AT = 0.7
BATCH_BYTES = 1 << 19

FEATURES = (
    "log_words", "upper", "digit", "mark", "symbol", "bar", "non_ascii", "word_length", "word_length_spread",
    "repeat_word", "distinct_words", "distinct_triples", "top_word", "symbol_words", "stops", "log_line",
)

_CODE = np.arange(256)
UPPER = (_CODE >= 65) & (_CODE <= 90)
DIGIT = (_CODE >= 48) & (_CODE <= 57)
MARK = np.isin(_CODE, [ord(c) for c in ".,;:?'\"()-"])
SYMBOL = np.isin(_CODE, [ord(c) for c in "!#$%&*+/<=>@[\\]^_`{}~"])
BAR = _CODE == ord("|")
LEAD = _CODE >= 0xC0
CONTINUED = (_CODE & 0xC0) == 0x80


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Arcsine of the square root of a share: its spread hardly depends on its size."""
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def _by_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over [off[i], off[i+1]); 0 for empty texts."""
    upto = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return upto[off[1:]] - upto[off[:-1]]


def _distinct(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: number of distinct keys, and how often the most frequent one occurs."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    first = np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])
    at = np.flatnonzero(first)
    runs = np.diff(np.append(at, len(k)))
    top = np.zeros(n)
    np.maximum.at(top, o[at], runs)
    return np.bincount(o[at], minlength=n).astype(float), top


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The feature matrix (texts x ``FEATURES``) of the texts ``data[off[i]:off[i+1]]``."""
    n = len(off) - 1
    count = lambda mask: _by_text(mask[data], off)
    chars = np.diff(off) - count(CONTINUED)
    pair = np.concatenate([data[1:], np.zeros(1, np.uint8)]) if len(data) else data
    upper_latin = (data == 0xC3) & (pair >= 0x80) & (pair <= 0x9E)
    starts, ends = piece_bounds(data, off, space_led=False)
    owner = np.searchsorted(off, starts, side="right") - 1
    words = np.bincount(owner, minlength=n).astype(float)
    size = (ends - starts).astype(float)
    mean = np.bincount(owner, size, n) / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(np.bincount(owner, size**2, n) / np.maximum(words, 1) - mean**2, 0))
    names = piece_names(data, starts, ends)
    same = np.concatenate([[False], (names[1:] == names[:-1]) & (owner[1:] == owner[:-1])]) if len(names) else np.zeros(0, bool)
    distinct, top = _distinct(names, owner, n)
    whole = np.zeros(len(names), bool)
    whole[2:] = owner[2:] == owner[:-2]
    triple = names.copy()
    triple[2:] = (names[2:] * np.uint64(31) + names[1:-1]) * np.uint64(37) + names[:-2]
    triples, _ = _distinct(triple[whole], owner[whole], n)
    last = data[ends - 1] if len(ends) else data
    letters = chars - count(SPACES)
    lines = _by_text(data == 10, off) + 1
    out = np.stack(
        [
            np.log1p(words),
            _share(count(UPPER) + _by_text(upper_latin, off), letters),
            _share(count(DIGIT), letters),
            _share(count(MARK), letters),
            _share(count(SYMBOL), letters),
            _share(count(BAR), letters),
            _share(count(LEAD), letters),
            np.log1p(mean),
            np.log1p(spread),
            _share(np.bincount(owner, same, n), words),
            np.log1p(distinct) / np.maximum(np.log1p(words), 1e-9),
            _share(triples, np.bincount(owner, whole, n)),
            _share(top, words),
            _share(np.bincount(owner, (SYMBOL | BAR)[last], n), words),
            _share(np.bincount(owner, last == ord("."), n), words),
            np.log1p(chars / lines),
        ],
        axis=1,
    )
    out[words == 0] = 0
    return out


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the written table of document statistics."""

    def run(batches):
        for batch in batches:
            for part in small_slices(batch, "text", BATCH_BYTES):
                x = statistics(*utf8_buffers(part.column("text")))
                ends = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1)))], names=["doc_id", "x"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return written(rows.mapInArrow(run, "doc_id long, x array<double>"), "quality-statistics")


@dataclass
class Gaussian:
    """A class: log prior, mean, inverse Cholesky factor of its covariance, log determinant."""

    log_prior: float
    mean: np.ndarray
    whiten: np.ndarray
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.whiten.T
        return self.log_prior - 0.5 * (z**2).sum(axis=1) - 0.5 * self.log_det


def fit_gaussian(n: float, total: float, sums: np.ndarray, outer: np.ndarray, shrinkage: float, ridge: float) -> Gaussian:
    mean = sums / n
    cov = outer / n - np.outer(mean, mean)
    cov = (1 - shrinkage) * cov + shrinkage * np.diag(np.diag(cov)) + ridge * np.eye(len(mean))
    factor = np.linalg.cholesky(cov)
    return Gaussian(float(np.log(n / total)), mean, np.linalg.inv(factor), float(2 * np.log(np.diag(factor)).sum()))


def fit(training: DataFrame, shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> dict[int, Gaussian]:
    """Class models from (label, x) rows: per-task sums, added by Spark, a fixed number of totals collected."""
    d = len(FEATURES)

    def sums(batches):
        held = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy().reshape(-1, d)
            for k in held:
                own = x[label == k]
                held[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).reshape(-1)])
        keys = np.repeat(list(held), 1 + d + d * d)
        at = np.tile(np.arange(1 + d + d * d), len(held))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(at), pa.array(np.concatenate(list(held.values())))], names=["label", "at", "v"])

    totals = training.mapInArrow(sums, "label long, at long, v double").groupBy("label", "at").agg(F.sum("v").alias("v"))
    held = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
    for label, at, v in totals.collect():
        held[label][at] = v
    total = sum(h[0] for h in held.values())
    return {
        k: fit_gaussian(h[0], total, h[1 : 1 + d], h[1 + d :].reshape(d, d), shrinkage, ridge) for k, h in held.items() if h[0] > 0
    }


def score(x: np.ndarray, model: dict[int, Gaussian]) -> np.ndarray:
    """Probability of label 1 for each row of statistics."""
    if 0 not in model or 1 not in model:
        return np.full(len(x), 0.0 if 0 in model else 1.0)
    diff = model[1].log_density(x) - model[0].log_density(x)
    return 1 / (1 + np.exp(-np.clip(diff, -500, 500)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never trained on: crc32 of the id as text has remainder 2 by 4 (null ids: not held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(stats: DataFrame, labels: DataFrame, **params) -> dict[int, Gaussian]:
    """The model from all labelled rows of ``stats`` that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("label"))
    rows = stats.where(~held_out()).join(known, "doc_id").select("label", "x")
    return fit(rows, **params)


def scored(stats: DataFrame, model: dict[int, Gaussian]) -> DataFrame:
    """(doc_id, score) for every row of ``stats``."""
    d = len(FEATURES)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(-1, d)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score(x, model))], names=["doc_id", "score"])

    return stats.mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, at_least: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``at_least``; all columns, one scan, no shuffle of texts."""
    model = train(described(docs), labels)
    text_at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in small_slices(batch, "text", BATCH_BYTES):
                keep = score(statistics(*utf8_buffers(part.column(text_at))), model) >= at_least
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
