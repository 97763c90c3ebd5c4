"""URL filter: fixed rules first, else logistic regression on hashed n-grams (operator 6).

Host and path are parsed with DataFrame functions. A rule names a host and a
path prefix; it fits the host and its subdomains, and the longest fitting rule
decides. Other URLs are judged by a logistic regression on hashed character
n-grams of host and path, fitted from a small labelled URL table (at most
``MAX_TRAINING_ROWS`` rows, a documented bound; it is fitted on the driver,
and the weight vector of fixed size goes to the tasks). Scoring is a map.

Defined cases: a null URL, or one without ``://``, has empty host and path and
fits no rule; URLs with an empty host are judged by the model's bias and the
n-grams of nothing, that is like any URL of which nothing is known; equal URLs
get equal verdicts; an empty table gives an empty result; a training table
without one of the labels gives the other verdict to all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm.common import utf8_buffers
from roadlens.llm.url_families import labelled_urls

BUCKETS = 1 << 14
SIZES = (3, 4, 5)
PENALTY = 0.02
ROUNDS = 1500
MAX_TRAINING_ROWS = 10_000
#: From hosts of words held out of training (tests): at 0.7 none of the clean hosts with a known word, no invented
#: name and 4 % of the clean hosts of unknown words are blocked.
BLOCK_AT = 0.7

#: Verdict, host, path prefix.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL as DataFrame expressions; both empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null; of equally long ones the first listed."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def gram_buckets(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram; hosts are framed by marks, paths hash apart from hosts."""
    rows, buckets = [], []
    for part, (column, frame) in enumerate(((hosts, True), (paths, False))):
        data, off = utf8_buffers(column)
        if frame:  # a mark before and after each host, so that n-grams know its ends
            n = len(off) - 1
            data = np.insert(data, np.stack([off[:-1], off[1:]], axis=1).reshape(-1), np.tile(np.uint8([1, 2]), n))
            off = off + 2 * np.arange(n + 1)
        owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
        wide = data.astype(np.uint64) + np.uint64(1)
        for size in SIZES:
            if len(data) < size:
                continue
            h = np.full(len(data) - size + 1, part * 8 + size, np.uint64)
            for k in range(size):
                h = (h * np.uint64(0x100000001B3)) ^ wide[k : len(data) - size + 1 + k]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            inside = owner[size - 1 :] == owner[: len(owner) - size + 1]
            rows.append(owner[: len(h)][inside])
            buckets.append((h >> np.uint64(50))[inside].astype(np.int64) % BUCKETS)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(buckets)


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def logit(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        row, bucket = gram_buckets(hosts, paths)
        count = np.bincount(row, minlength=len(hosts))
        return self.bias + np.bincount(row, self.weights[bucket], len(hosts)) / np.sqrt(np.maximum(count, 1))


def default_labels(spark: SparkSession) -> DataFrame:
    """The table of ``url_families``: (url, blocked)."""
    return spark.createDataFrame([(url, blocked) for url, blocked, _ in labelled_urls()], "url string, blocked int")


def fit(labels: DataFrame, penalty: float = PENALTY, rounds: int = ROUNDS) -> UrlModel:
    """Logistic regression by full-gradient descent with momentum on the labelled table."""
    host, path = host_and_path()
    rows = labels.where(F.col("blocked").isin(0, 1)).select(host.alias("host"), path.alias("path"), F.col("blocked").cast("double").alias("y"))
    data = rows.orderBy("host", "path", "y").limit(MAX_TRAINING_ROWS).toArrow().combine_chunks()
    n, y = data.num_rows, data.column("y").to_numpy()
    weights, bias = np.zeros(BUCKETS), 0.0
    if not n or y.min() == y.max():
        return UrlModel(weights, 20.0 if n and y[0] else -20.0)
    column = lambda name: data.column(name).combine_chunks()
    row, bucket = gram_buckets(column("host"), column("path"))
    value = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))[row]
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / n
    dw, db = np.zeros(BUCKETS), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(np.bincount(row, weights[bucket] * value, n) + bias)))
        error = (p - y) * balance
        dw = 0.9 * dw - 4.0 * (np.bincount(bucket, error[row] * value, BUCKETS) + penalty / n * weights)
        db = 0.9 * db - 0.5 * error.sum()
        weights, bias = weights + dw, bias + db
    return UrlModel(weights, float(bias))


def judge(pages: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str, str]] = RULES, block_at: float = BLOCK_AT) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block for every row of ``pages``."""
    host, path = host_and_path()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                z = model.logit(batch.column("host"), batch.column("path"))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=[*batch.schema.names, "p_block"])

    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    out = parsed.mapInArrow(run, "page_id long, host string, path string, p_block double")
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    return out.withColumn("found", rule).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("p_block") >= block_at, "block").otherwise("allow")).alias("verdict"),
        "p_block",
    )
