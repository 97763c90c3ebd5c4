"""Mixing sources to target weights (operator 9).

Tokens are summed per source, a repetition rate ``target / available`` is
derived for every source, and each document is emitted ``floor(rate)`` times
plus one hash-seeded Bernoulli copy whose probability is the fraction of the
rate. The uniform number of a document is a hash of (seed, doc_id, text), so
reruns and any partitioning give the same mix, and applying the rates is a map
over the rows: no text is shuffled.

Calibration: with few documents an independent draw can miss its target by
several documents. The acceptance threshold of a source is therefore read off
the histogram of words over the drawn uniforms (``HASH_BUCKETS`` buckets a
source, pre-aggregated in the scan): the cut whose words come nearest to the
wanted fraction. With many documents it converges to the fraction itself;
``calibrate=False`` uses the plain fraction.

Defined cases: null text counts 0 words; a null source is a source of its own,
ranked last; sources without words get rate 0; equal rows draw the same number;
an empty table gives an empty mix; other columns are carried through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import text_or_empty, written

HASH_BUCKETS = 1024
WORD = r"[^\x20\x09-\x0D]+"
_KEY, _RATE, _CUT = "__mix_source", "__mix_rate", "__mix_cut"


def word_count(text: str = "text") -> Column:
    """Number of runs of characters other than ASCII white space; null text has 0."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_key(source: str = "source") -> Column:
    """A non-null join key for a source: a marked copy, so null stays apart from ''."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source)))


def draw(seed: int, doc_id: str = "doc_id", text: str = "text") -> Column:
    """The document's uniform number as a bucket-resolved value in [0, 1)."""
    h = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def source_targets(
    totals: DataFrame, weights: Sequence[float], share: float, max_repeat: float
) -> DataFrame:
    """Targets per source by water filling, as DataFrame expressions.

    ``totals`` has one row per source: (key, source, source_size). Targets are
    ``min(weight * level, max_repeat * size)`` with the level at which they add
    up to ``share * sum(size)``. Sources fill up in order of cap / weight: with
    the sources before and including i full, the rest would share
    ``(T - caps) / weights_left``; the level is that value after the last
    source whose own cap is not above it. The windows run over one short row
    per source, never over documents.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = totals.withColumn(
        "weight", F.array(*[F.lit(float(w)) for w in weights])[F.pmod(F.row_number().over(by_name) - 1, F.lit(n))]
    ).withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    up_to = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    goal = F.sum("source_size").over(everything) * F.lit(float(share))
    levels = ranked.withColumn(
        "level", (goal - F.coalesce(F.sum("cap").over(up_to), F.lit(0.0))) / F.sum("weight").over(after)
    )
    # The first source in fill order that its level does not fill sets the level of all.
    first_open = F.min(F.when(F.col("level") * F.col("weight") < F.col("cap"), F.struct(F.row_number().over(fill), "level")))
    open_level = first_open.over(everything)["level"]
    return levels.withColumn("level", open_level).select(
        F.col("key"),
        "source",
        "source_size",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight"))).alias("target"),
    )


def mix_rates(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_repeat: float = 2.0,
    seed: int = 9,
    calibrate: bool = True,
) -> DataFrame:
    """One row per source: key, source, source_size, target, rate, cut.

    A document is taken ``floor(rate)`` times plus once more if its uniform
    number is below ``cut``.
    """
    bucket = F.floor(draw(seed) * HASH_BUCKETS).cast("int")
    hist = written(
        docs.groupBy(source_key().alias("key"), "source", bucket.alias("bucket")).agg(F.sum(word_count()).alias("words")),
        "mix-histogram",
    )
    totals = hist.groupBy("key", "source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals, weights, share, max_repeat).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ).withColumn("fraction", F.col("rate") - F.floor("rate"))
    if not calibrate:
        return written(targets.withColumn("cut", F.col("fraction")).drop("fraction"), "mix-rates")
    # Words with a uniform number below the upper edge of each bucket; a source has HASH_BUCKETS at most.
    running = Window.partitionBy("key").orderBy("bucket")
    below = hist.select(
        "key",
        ((F.col("bucket") + 1) / F.lit(float(HASH_BUCKETS))).alias("edge"),
        F.sum("words").over(running).alias("below"),
    )
    cuts = below.join(targets.select("key", "source_size", "fraction"), "key").withColumn(
        "miss", F.abs(F.col("below") - F.col("fraction") * F.col("source_size"))
    )
    best = cuts.groupBy("key").agg(F.min(F.struct("miss", "edge")).alias("best"))
    rates = targets.join(best, "key", "left").withColumn(
        "cut",
        F.when(F.col("fraction") <= 0, 0.0)
        .when(F.col("best.miss") <= F.col("fraction") * F.col("source_size"), F.col("best.edge"))
        .otherwise(0.0),
    )
    return written(rates.drop("best", "fraction"), "mix-rates")


def copies_per_document(docs: DataFrame, rates: DataFrame, seed: int = 9) -> DataFrame:
    """``docs`` with ``copies``, ``source_size`` and ``target`` (prefixed ``__mix_``)."""
    small = rates.select(
        F.col("key").alias(_KEY),
        F.col("rate").alias(_RATE),
        F.col("cut").alias(_CUT),
        F.col("source_size").alias("__mix_source_size"),
        F.col("target").alias("__mix_target"),
    )
    joined = docs.withColumn(_KEY, source_key()).join(small, _KEY, "left")
    copies = F.floor(F.coalesce(F.col(_RATE), F.lit(0.0))).cast("int") + F.when(draw(seed) < F.col(_CUT), 1).otherwise(0)
    return joined.withColumn("__mix_copies", copies).drop(_KEY, _RATE, _CUT)


def mix_sources(docs: DataFrame, seed: int = 9, **params) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each repeated as often as the mix takes it."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*own).alias("__mix_row"), "doc_id", "text", "source")  # whatever the names of other columns
    out = copies_per_document(rows, mix_rates(docs, seed=seed, **params), seed)
    copy = F.explode(F.sequence(F.lit(1), F.col("__mix_copies")))
    return out.where(F.col("__mix_copies") > 0).select("__mix_row", copy.alias("__mix_copy")).select("__mix_row.*")
