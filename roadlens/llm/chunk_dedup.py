"""Exact deduplication by content-defined chunk recipes (operator 7).

1. Each text is cut into chunks where a rolling hash of the last ``WINDOW``
   bytes hits a mask (never inside a character), between ``MIN_CHUNK`` and
   ``MAX_CHUNK`` bytes. Equal texts get equal cuts, and long texts that share
   passages share chunks. A chunk is named by a 64-bit hash.
2. Chunks are deduplicated with map-side combining, and a name under which two
   different chunk texts appear is ambiguous (``ambiguous_names``). Only the
   few documents holding such a chunk carry that chunk's text in their key, so
   the identifiers are verified: equal keys mean equal texts, at any hash width.
3. Documents are grouped by their ordered list of identifiers. Long texts are
   moved once, as distinct chunks; grouping moves eight bytes a chunk.

Defined cases: null text counts as empty and has an empty recipe; of equal
texts the row with the largest doc_id stays (null doc_ids lose; of rows with
the same doc_id and text one stays); an empty table gives an empty result;
other columns are carried by ``deduplicate``. Very long texts are cut in
vectorised passes over their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roadlens.llm.common import arrow_map, small_slices, text_or_empty, utf8_buffers, written

WINDOW = 32
MIN_CHUNK = 1 << 10
MAX_CHUNK = 1 << 14
CUT_MASK = np.uint64((1 << 12) - 1)
BATCH_BYTES = 1 << 20


def _gear() -> np.ndarray:
    """256 mixed 64-bit words, one per byte value (splitmix of the byte)."""
    x = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


GEAR = _gear()


def cut_candidates(data: np.ndarray) -> np.ndarray:
    """Positions after which a cut may lie: rolling hash of ``WINDOW`` bytes hits the mask.

    ``h_w(i)`` sums ``GEAR[byte] << age`` over the last w bytes; doubling w
    takes one shifted addition, so the hash costs log2(WINDOW) passes.
    """
    h = GEAR[data]
    width = 1
    while width < WINDOW:
        later = h.copy()
        later[width:] += h[:-width] << np.uint64(width)
        h, width = later, width * 2
    # high bits depend on the whole window
    return np.flatnonzero(((h >> np.uint64(40)) & CUT_MASK) == 0) + 1


def cut_points(data: np.ndarray, candidates: np.ndarray) -> list[int]:
    """Chunk ends of one text given its candidate cuts; the last end is its length."""
    n, start, ends = len(data), 0, []
    while n - start > MIN_CHUNK:
        k = int(np.searchsorted(candidates, start + MIN_CHUNK))
        end = int(candidates[k]) if k < len(candidates) else n
        end = min(end, start + MAX_CHUNK, n)
        while end < n and (data[end] & 0xC0) == 0x80:  # stay on a character boundary
            end += 1
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def recipes(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """One row per document: row_id, doc_id, text_sha256, recipe, bodies, and ``row`` with all else.

    Written to the shared folder, so ``row_id`` is fixed from here on and the
    later passes read only the columns they need. ``row`` holds the other
    columns of ``docs`` and whether the text was null, so that with ``bodies``
    the documents can be written again.
    """
    shift = 64 - hash_bits

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, off = utf8_buffers(batch.column("text"))
        raw = data.tobytes()
        names, bodies, counts, digests = [], [], [0], []
        for i in range(batch.num_rows):
            lo, hi = int(off[i]), int(off[i + 1])
            piece = data[lo:hi]
            cuts = cut_points(piece, cut_candidates(piece)) if hi - lo > MIN_CHUNK else ([hi - lo] if hi > lo else [])
            start = 0
            for end in cuts:
                body = raw[lo + start : lo + end]
                names.append(xxhash.xxh64_intdigest(body) >> shift)
                bodies.append(body)
                start = end
            counts.append(len(names))
            digests.append(hashlib.sha256(raw[lo:hi]).hexdigest())
        ends = pa.array(counts, pa.int32())
        named = pa.array(np.array(names, np.uint64).view(np.int64), pa.int64())
        texts = pa.array(bodies, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("row_id"),
                batch.column("doc_id"),
                pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(ends, named),
                pa.ListArray.from_arrays(ends, texts),
                batch.column("row"),
            ],
            names=["row_id", "doc_id", "text_sha256", "recipe", "bodies", "row"],
        )

    def run(batches):
        for batch in batches:
            for part in small_slices(batch, "text", BATCH_BYTES):
                yield convert(part)

    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"),
        F.struct(F.col("text").isNull().alias("__null_text"), *others).alias("row"),
    )
    schema = StructType.fromDDL("row_id long, doc_id long, text_sha256 string, recipe array<long>, bodies array<string>")
    return written(rows.mapInArrow(run, schema.add("row", rows.schema["row"].dataType)), "chunk-recipes")


def ambiguous_names(table: DataFrame) -> DataFrame:
    """Names that stand for more than one chunk text (none, unless hashes collide).

    The distinct (name, text) pairs are formed with map-side combining, so a
    chunk that a third of all documents hold leaves each task once.
    """
    pairs = table.select(F.explode(F.arrays_zip("recipe", "bodies")).alias("c")).select("c.recipe", "c.bodies").distinct()
    return written(pairs.groupBy("recipe").count().where("count > 1").select(F.col("recipe").alias("name")), "chunk-ambiguous")


def with_verified_key(table: DataFrame) -> DataFrame:
    """(row_id, doc_id, text_sha256, recipe, spelled): equal (recipe, spelled) = equal text."""
    narrow = table.select("row_id", "doc_id", "text_sha256", "recipe")
    bad = ambiguous_names(table)
    if bad.isEmpty():
        return narrow.withColumn("spelled", F.lit(None).cast("array<string>"))
    uses = table.select("row_id", F.explode("recipe").alias("name")).join(bad, "name", "left_semi").select("row_id").distinct()
    spelled = table.join(uses, "row_id", "left_semi").select("row_id", F.col("bodies").alias("spelled"))
    return narrow.join(spelled, "row_id", "left")


def duplicate_groups(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """One row per document: row_id, doc_id, keep_id, group_size, kept, text_sha256, n_chunks."""
    return grouped(recipes(docs, hash_bits))


def grouped(table: DataFrame) -> DataFrame:
    """``duplicate_groups`` from a written table of recipes."""
    keyed = with_verified_key(table)
    groups = keyed.groupBy("recipe", "spelled").agg(
        F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count(F.lit(1)).alias("group_size")
    )
    same = F.col("a.recipe").eqNullSafe(F.col("g.recipe")) & F.col("a.spelled").eqNullSafe(F.col("g.spelled"))
    return keyed.alias("a").join(groups.alias("g"), same, "left").select(
        "a.row_id",
        "a.doc_id",
        F.col("g.keep.doc_id").alias("keep_id"),
        F.col("g.group_size").alias("group_size"),
        (F.col("a.row_id") == F.col("g.keep.row_id")).alias("kept"),
        "a.text_sha256",
        F.size("a.recipe").alias("n_chunks"),
    )


def deduplicate(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; texts are put together from their chunks."""
    table = recipes(docs, hash_bits)
    kept = grouped(table).where("kept").select("row_id")
    rows = table.join(kept, "row_id", "left_semi")
    text = F.when(~F.col("row.__null_text"), F.array_join("bodies", ""))
    return rows.select(*[text.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
