"""Approximate nearest neighbours by a hash-prefix forest (operator 10).

Each tree gives a vector a long hash string of ``SYMBOLS`` symbols. The first is
the signed axis nearest to the vector after a random rotation (cross-polytope
hash; in at most ``AXES`` dimensions), the others the same in two dimensions, so
prefixes lengthen in small steps. A string is one 64-bit number. The index is
one array per tree sorted by that number, so the vectors sharing the first k
symbols with a query are one run of the array.

A query descends to its longest matching prefix in every tree and then ascends
in all trees at once: the prefix is shortened symbol by symbol until the runs
of all trees together are expected to hold ``wanted_entries`` different vectors
(at prefix length 0 all). That number follows the rows of the table by one rule
at every size. All vectors of those runs are compared; nothing in a run is
capped. Runs are read in blocks of ``BLOCK_ROWS`` rows, so a dense region is
spread over tasks. Blocks are compared by an 8-bit
form that carries the length of its own error, so every score has bounds: what
may be among the k best by its upper bound is scored in double precision on the
original vectors. A query with more than ``CROWD`` such vectors in a block has
that block scored in double precision inside the task, which returns its best.

Equal vectors are one entry of the index, holding their smallest ids (as many
as an answer can show), so copies of a vector cost one comparison and lose none.

Defined cases: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, as query or candidate; rows
with a null id neither; a repeated row is a candidate of its own; ties go to
the smaller id; fewer candidates than ``k`` are all returned; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import written

TREES = 80
SYMBOLS = 4
AXES = 64
BLOCK_ROWS = 8192
CROWD = 64
#: Rounding of single precision in scores of unit vectors, with room.
SLACK = 1e-5
SEED = 10

VECTORS = "entry long, ids array<long>, vector array<double>"
INDEX = "entry long, small binary, codes array<long>"


def usable(vector: str = "embedding") -> Column:
    """Whether a vector takes part: no null or non-finite component, and not zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def entries(vectors: DataFrame, id_column: str, vector: str, k: int) -> DataFrame:
    """The written table of different vectors: entry, ids (the k + 1 smallest), vector."""
    rows = vectors.where(usable(vector) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )
    width = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if width is None:
        width = [0]
    # The k + 1 smallest ids of each vector; the limit on the rank is applied in every task before
    # the shuffle, so a vector that a third of all rows share sends k + 1 rows a task.
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.where(F.size("vector") == width[0]).withColumn("nth", nth).where(F.col("nth") <= k + 1)
    whole = few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return written(whole.select(F.monotonically_increasing_id().alias("entry"), "ids", "vector"), "forest-entries")


def wanted_entries(rows: int) -> int:
    """Different vectors a query should meet: 30 % of 500, and a falling share of more (12 % of 300,000)."""
    return math.ceil(min(rows, 0.762 * rows**0.85))


def rotations(d: int, trees: int = TREES, symbols: int = SYMBOLS, seed: int = SEED) -> list[list[np.ndarray]]:
    """For every tree and symbol a matrix with random orthonormal columns."""
    rng = np.random.default_rng(seed)
    axes = [min(d, AXES), *[min(d, 2)] * (symbols - 1)]
    return [[np.linalg.qr(rng.normal(size=(d, m)))[0].astype(np.float32) for m in axes] for _ in range(trees)]


def symbol_bits(axes: int) -> int:
    return max(1, int(2 * axes - 1).bit_length())


def bits_after(length: int, d: int, symbols: int) -> int:
    """Bits of a hash string behind its first ``length`` symbols."""
    rest = symbol_bits(min(d, 2))
    return (symbols - 1) * rest + symbol_bits(min(d, AXES)) if length == 0 else (symbols - length) * rest


def hash_strings(x: np.ndarray, turns: list[list[np.ndarray]]) -> np.ndarray:
    """(rows x trees) packed hash strings; the first symbol lies in the highest bits."""
    out = np.zeros((len(x), len(turns)), np.int64)
    for t, tree in enumerate(turns):
        for turn in tree:
            y = x @ turn
            axis = np.abs(y).argmax(axis=1)
            sign = np.take_along_axis(y, axis[:, None], 1)[:, 0] < 0
            out[:, t] = (out[:, t] << symbol_bits(turn.shape[1])) | (2 * axis + sign)
    return out


def quantised(x: np.ndarray) -> np.ndarray:
    """Unit vectors as signed bytes, scaled to their largest component, with that scale and the length of their error as four bytes each."""
    scale = (np.abs(x).max(axis=1, keepdims=True) / 127).astype("<f4")
    whole = np.rint(x / scale).astype(np.int8)
    error = np.linalg.norm(x - whole.astype(np.float64) * scale, axis=1, keepdims=True).astype("<f4")
    return np.concatenate([whole.view(np.uint8), scale.view(np.uint8), error.view(np.uint8)], axis=1)


def unquantised(cells: list[bytes], d: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors and the lengths of their errors."""
    raw = np.frombuffer(b"".join(cells), np.uint8).reshape(len(cells), d + 8)
    tail = raw[:, d:].copy().view("<f4")
    return raw[:, :d].copy().view(np.int8).astype(np.float32) * tail[:, :1], tail[:, 1]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of ``a`` with the rows of ``b``, pair by pair.

    Rows are first multiplied by powers of two, which changes no cosine, so that no square overflows or vanishes.
    """
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]) for x in (a, b))
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def build(table: DataFrame, d: int, symbols: int, trees: int, seed: int) -> DataFrame:
    """entry, small (8-bit vector), codes (a hash string per tree): written."""

    def run(batches):
        turns = rotations(d, trees, symbols, seed)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = unit(matrix(part.column("vector"), d)).astype(np.float32)
                codes = hash_strings(x, turns)
                ends = pa.array(np.arange(0, codes.size + 1, trees), pa.int32())
                small = pa.array([row.tobytes() for row in quantised(x)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("entry"), small, pa.ListArray.from_arrays(ends, pa.array(codes.reshape(-1)))], names=["entry", "small", "codes"]
                )

    return written(table.select("entry", "vector").mapInArrow(run, INDEX), "forest-hashes")


def search(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    trees: int = TREES,
    candidates: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query row, its own row left out."""
    spark = vectors.sparkSession
    table = entries(vectors, id_column, vector, k)
    width = table.select(F.size("vector")).first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = width[0]
    rows_in_table = table.count()
    if candidates is None:
        candidates = wanted_entries(rows_in_table)
    symbols = SYMBOLS
    hashed = build(table, d, symbols, trees, seed)
    # the forest: one sorted array of hash strings per tree, in sorted runs of the table's files
    code = hashed.select("entry", F.posexplode("codes").alias("tree", "code"))
    forest = written(code.repartitionByRange("tree", "code").sortWithinPartitions("tree", "code"), "forest-arrays")

    queries = vectors.where(is_query & usable(vector) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    asked = written(queries.join(table.select("entry", "vector"), "vector").select("query_id", "entry").join(hashed, "entry"), "forest-queries")
    # Entries a query needs: k, and those that hold its own id, which may have no other row to show.
    own = table.select(F.explode(F.array_distinct("ids")).alias("query_id")).join(asked.select("query_id").distinct(), "query_id").groupBy("query_id").count()
    need = asked.select("query_id", "entry").join(own, "query_id", "left").groupBy("entry").agg((F.max(F.coalesce("count", F.lit(1))) + k).cast("int").alias("need"))
    points = written(asked.select("entry", "small", "codes").dropDuplicates(["entry"]).join(need, "entry"), "forest-points")

    # Descend and ascend: the longest prefix at which all trees together hold enough vectors.
    def prefixes(lengths) -> Column:
        """(length, prefix) of a ``code`` for each of the lengths."""
        return F.explode(F.array(*[F.struct(F.lit(n).alias("length"), F.shiftright("code", bits_after(n, d, symbols)).alias("prefix")) for n in lengths]))

    every = range(1, symbols + 1)
    runs = forest.select("tree", prefixes(every).alias("p")).groupBy("tree", "p.length", "p.prefix").agg(F.count(F.lit(1)).alias("n"))
    places = points.select("entry", F.posexplode("codes").alias("tree", "code")).select("entry", "tree", prefixes(every).alias("p")).select("entry", "tree", "p.*")
    held = written(places.join(runs, ["tree", "length", "prefix"]), "forest-runs")
    # the other vectors of each tree's run as independent draws: one is outside all runs with the product of the shares left
    others = max(rows_in_table - 1, 1)
    left_out = F.exp(F.sum(F.log1p(-F.least((F.col("n") - 1) / F.lit(float(others)), F.lit(1 - 1e-12)))))
    expected = held.groupBy("entry", "length").agg(((1 - left_out) * others + 1).alias("different"), F.max("n").alias("largest"))
    # one run alone must hold as many as the answer needs
    expected = expected.join(points.select("entry", "need"), "entry").where((F.col("different") >= candidates) & (F.col("largest") >= F.col("need")))
    enough = expected.groupBy("entry").agg(F.max("length").alias("length"))
    chosen = written(
        held.join(enough, ["entry", "length"]).select("entry", "tree", "length", "prefix", "n")
        .unionByName(
            # prefix length 0: one run holds everything, the same in every tree
            points.select("entry").join(enough, "entry", "left_anti").select(
                "entry", F.lit(0).alias("tree"), F.lit(0).alias("length"), F.lit(0).cast("long").alias("prefix"), F.lit(rows_in_table).alias("n")
            )
        ),
        "forest-chosen",
    )

    # Runs in blocks: their rows by hash, their queries in every block.
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    wanted = chosen.groupBy("tree", "length", "prefix").agg(F.max(blocks).alias("blocks"))
    used = sorted(r["length"] for r in chosen.select("length").distinct().collect())  # at most one row a symbol
    if not used:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = forest.select("entry", "tree", prefixes(used).alias("p")).select("entry", "tree", "p.*").where((F.col("length") > 0) | (F.col("tree") == 0))
    rows = rows.join(wanted, ["tree", "length", "prefix"])
    rows = rows.select("tree", "length", "prefix", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int").alias("block"), "entry")
    in_blocks, rows = rows, rows.join(hashed.select("entry", "small"), "entry")
    asking = chosen.join(points.select("entry", "small", "need"), "entry").select(
        "tree", "length", "prefix", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), "entry", "small", "need"
    )
    key = ["tree", "length", "prefix", "block"]

    def compare(at: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            q, q_error = unquantised(left.column("small").to_pylist(), d)
            e, e_error = unquantised(right.column("small").to_pylist(), d)
            q_id, e_id, needed = (t.column(c).to_numpy() for t, c in ((left, "entry"), (right, "entry"), (left, "need")))
            n = int(min(needed.max(), len(e_id)))
            for lo in range(0, len(q_id), 256):
                wide = q_error[lo : lo + 256, None] + (1 + q_error[lo : lo + 256, None]) * e_error + np.float32(SLACK)
                low = q[lo : lo + 256] @ e.T
                up = low + wide
                low -= wide
                best = np.argpartition(-low, n - 1, axis=1)[:, :n]
                top = -np.sort(-np.take_along_axis(low, best, 1), axis=1)
                floor = np.take_along_axis(top, np.minimum(needed[lo : lo + 256], n)[:, None] - 1, 1)
                kept = up >= floor
                crowded = kept.sum(axis=1) > CROWD
                # of a crowded block the best by their lower bounds, with the block's largest upper bound
                kept[crowded] = False
                np.put_along_axis(kept, best, np.take_along_axis(kept, best, 1) | crowded[:, None], 1)
                up[crowded] = up[crowded].max(axis=1, keepdims=True)
                i, j = np.nonzero(kept)
                out.append((q_id[lo + i], e_id[j], low[i, j], up[i, j], crowded[i]))
        cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, t) for t in ("i8", "i8", "f4", "f4", "?")]
        place = [pa.array(np.full(len(cols[0]), x.as_py()), t) for x, t in zip(at, (pa.int32(), pa.int32(), pa.int64(), pa.int32()))]
        return pa.Table.from_arrays([*map(pa.array, cols), *place], names=["query", "entry", "low", "up", "crowded", *key])

    found = written(
        asking.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(
            compare, "query long, entry long, low float, up float, crowded boolean, tree int, length int, prefix long, block int"
        ),
        "forest-found",
    )
    # No entry below the lower bounds of as many entries as needed can be in the answer.
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("low")))
    lows = found.groupBy("query", "entry").agg(F.max("low").alias("low")).withColumn("nth", nth)
    floors = lows.join(points.select(F.col("entry").alias("query"), "need"), "query").where(F.col("nth") == F.col("need")).select("query", F.col("low").alias("floor"))
    open_ = found.join(floors, "query", "left").where(F.col("floor").isNull() | (F.col("up") >= F.col("floor")))
    short = open_.where(~F.col("crowded")).select("query", "entry")
    crowds = written(open_.where("crowded").select("query", *key).distinct(), "forest-crowds")
    if not crowds.isEmpty():
        short = short.unionByName(closest_in_crowds(crowds, in_blocks.select(*key, "entry"), points.select("entry", "need"), table, key, d))
    return rescored(short.distinct(), table, asked, k)


def closest_in_crowds(crowds: DataFrame, rows: DataFrame, needs: DataFrame, table: DataFrame, key: list[str], d: int) -> DataFrame:
    """(query, entry): of every crowded block the entries a query needs, by score in double precision and then by their smallest id."""
    left = crowds.join(needs.withColumnRenamed("entry", "query"), "query").join(table.select(F.col("entry").alias("query"), F.col("vector").alias("a")), "query")
    right = rows.join(crowds.select(*key).distinct(), key, "left_semi").join(table.select("entry", F.element_at("ids", 1).alias("first"), F.col("vector").alias("b")), "entry")

    def closest(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_e = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if left.num_rows and right.num_rows:
            a, b = (matrix(t.column(c).combine_chunks(), d) for t, c in ((left, "a"), (right, "b")))
            a_unit, b_unit = unit(a), unit(b)
            q_id, needed, e_id, first = (t.column(c).to_numpy() for t, c in ((left, "query"), (left, "need"), (right, "entry"), (right, "first")))
            for i in range(len(q_id)):
                n = min(int(needed[i]), len(e_id))
                s = b_unit @ a_unit[i]
                # all that rounding could bring in, then by the very score the answer shows
                near = np.flatnonzero(s >= np.partition(s, len(s) - n)[len(s) - n] - 1e-9)
                score = cosines(np.repeat(a[i : i + 1], len(near), axis=0), b[near])
                best = near[np.lexsort((first[near], -score))[:n]]
                out_q.append(np.full(n, q_id[i]))
                out_e.append(e_id[best])
        return pa.table({"query": np.concatenate(out_q), "entry": np.concatenate(out_e)})

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(closest, "query long, entry long")


def rescored(short: DataFrame, table: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Exact scores of the shortlisted entries, spread to their ids, and the k best of each query row."""
    pairs = (
        short.join(table.select("entry", "ids", F.col("vector").alias("b")), "entry")
        .join(table.select(F.col("entry").alias("query"), F.col("vector").alias("a")), "query")
        .select("query", "ids", "a", "b")
    )

    def cosine(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.array(batch.column(c).to_pylist(), np.float64) for c in ("a", "b"))
                yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("ids"), pa.array(cosines(a, b))], names=["query", "ids", "score"])

    scored = pairs.mapInArrow(cosine, "query long, ids array<long>, score double")
    per_row = scored.join(asked.select(F.col("entry").alias("query"), "query_id"), "query").select(
        "query_id", F.explode("ids").alias("vec_id"), "score"
    )
    per_row = per_row.where(F.col("vec_id") != F.col("query_id"))
    order = F.struct((-F.col("score")).alias("far"), F.col("vec_id"), F.col("score"))
    top = per_row.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("top"))
    return top.select("query_id", F.posexplode("top").alias("at", "t")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score")
    )
