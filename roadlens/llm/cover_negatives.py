"""Hard negatives by cover trees over norm-augmented candidates (operator 12).

Components become whole numbers, so inner products are exact. A candidate x of a
tree gets one coordinate more, sqrt(M^2 - |x|^2) with M the largest norm of the
tree, an anchor gets 0: the squared distance of anchor a and candidate x is then
|a|^2 + M^2 - 2 a.x, and a node with centre c and covering radius r bounds every
inner product below it, from both sides, by its distance to c plus and minus r.

Upper levels: rows meet by label bucket and by the nearest of a few pivots (a
farthest-point cover of a bounded sample), and every such cell is cut by hash
into trees of about ``TREE_ROWS`` rows. Lower levels, inside a tree: radii fall
by ``BASE`` a level; members of a node that no sibling covers are its own
points. A task takes a pack of anchors and a few trees and descends best first:
nodes leave a queue by their largest upper bound, for the anchors whose windows
and k best they can still reach; points are verified by exact inner products.

Two searches: the best of an anchor's own label (its positives), then, with the
window that each positive opens, the best of the other labels. Equal vectors of
a label are one candidate with its smallest ids, as many as answers can show.

Every anchor meets every tree its window reaches, as the exact answer needs in
64 dimensions: work is anchors x rows, in packs and trees of fixed size.

Defined cases: rows with a null id, null label, null or empty vector, null or
non-finite components, or another length than most (ties: the shorter) take no
part; components beyond +-sqrt(2^58 / d) are cut off there, so scores fit a
long; a row is no partner of an anchor with its id; repeated rows are positives
and negatives of their own, anchors equal in id, label and vector answer once;
a negative positive_score opens an empty window; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.charpoly_whitening import complete
from roadlens.llm.common import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
TREE_ROWS = 4096
TREES_A_TASK = 2
PACK = 2048
BUCKETS = 64
PIVOTS = 256
PIVOT_SAMPLE = 4096
BASE = 1.3
#: Groups of fewer members than this are points of the node above.
SMALL = 8
POINTS_AT_ONCE = 512
NONE = -(2**62)
#: Room for rounding in bounds, as a share of |a|^2 + M^2.
SLACK = 1e-12

TREE = "bucket int, tree long, rows int, type string, vectors binary, labels binary, entries binary, firsts binary, seconds binary, centres binary, radii binary, child_from binary, child_to binary, point_from binary, point_to binary, node_label binary, uniform binary"
FOUND = "anchor long, nth int, entry long, first long, score long"


def candidates(vectors: DataFrame, id_column: str, label: Column, vector: str, keep: int) -> tuple[DataFrame, DataFrame, int]:
    """(rows: id, label, vector; written entries: entry, label, vector, ids, bucket; dimension)."""
    rows = vectors.where(complete(vector) & label.isNotNull() & F.col(id_column).isNotNull())
    width = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = width["d"] if width else 0
    limit = math.isqrt(2**58 // max(d, 1))
    whole = F.transform(vector, lambda x: F.greatest(F.least(F.floor(F.lit(float(SCALE)) * x.cast("double")), F.lit(limit)), F.lit(-limit)).cast("long"))
    rows = rows.where(F.size(vector) == d).select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vector"))
    # Copies are counted in every task first; the limit on the rank then runs before the shuffle as well.
    counted = rows.groupBy("vector", "label", "id").agg(F.count(F.lit(1)).alias("copies"))
    nth = F.row_number().over(Window.partitionBy("vector", "label").orderBy("id"))
    few = counted.withColumn("nth", nth).where(F.col("nth") <= keep + 1)
    repeated = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("id", "copies"))), lambda s: F.array_repeat(s["id"], F.least(s["copies"], F.lit(keep)).cast("int"))))
    grouped = few.groupBy("vector", "label").agg(repeated.alias("ids"))
    entries = grouped.select(
        F.monotonically_increasing_id().alias("entry"), "label", "vector", "ids", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int").alias("bucket")
    )
    return rows, written(entries, "cover-entries"), d


def matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """Rows with sqrt(largest - |x|^2) as one coordinate more."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(0, largest - np.einsum("ij,ij->i", x, x)))])


def pivots(entries: DataFrame, count: int, d: int) -> tuple[np.ndarray, float]:
    """Farthest-point cover of a bounded sample of the entries, and the largest squared norm met there."""
    sample = entries.orderBy(F.xxhash64("entry"), "entry").limit(PIVOT_SAMPLE).select("vector").toArrow()
    x = matrix(sample.column("vector"), d).astype(np.float64)
    largest = float(np.einsum("ij,ij->i", x, x).max())
    z = lifted(x, largest)
    chosen, far = [0], ((z - z[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(z)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((z - z[chosen[-1]]) ** 2).sum(axis=1))
    return z[chosen], largest


def build_tree(x: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(order of the rows, nodes): every node's own points are a run of that order, its children a run of nodes."""
    squares = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    z = lifted(x, float(squares.max()))
    apart = np.empty((len(z), len(z)), np.float32)  # only for grouping; radii are taken anew
    for lo in range(0, len(z), 512):
        apart[lo : lo + 512] = np.sqrt(np.maximum(0, 2 * squares.max() - 2 * (z[lo : lo + 512] @ z.T)))

    def radius(centre: int, members: np.ndarray) -> float:
        return float(np.sqrt(((z[members] - z[centre]) ** 2).sum(axis=1).max()))

    root = int(((z - z.mean(axis=0)) ** 2).sum(axis=1).argmin())
    todo = [(root, np.arange(len(z)))]
    order: list[np.ndarray] = []
    nodes: dict[str, list] = {k: [] for k in ("centres", "radii", "child_from", "child_to", "point_from", "point_to", "node_label", "uniform")}
    placed, at = 0, 0
    while at < len(todo):
        centre, members = todo[at]
        r = radius(centre, members)
        own, first_child = [], len(todo)
        if r == 0 or len(members) <= SMALL:
            own.append(members)
        else:
            left = members
            pick = centre
            while len(left):
                near = apart[pick, left] <= r / BASE
                near |= left == pick
                group, left = left[near], left[~near]
                if len(group) < SMALL or len(group) == len(members):
                    own.append(group)
                else:
                    todo.append((pick, group))
                pick = left[0] if len(left) else -1
        points = np.concatenate(own) if own else np.zeros(0, np.int64)
        order.append(points)
        held = labels[members]
        for key, value in zip(nodes, (centre, r, first_child, len(todo), placed, placed + len(points), held[0], (held == held[0]).all())):
            nodes[key].append(value)
        placed += len(points)
        at += 1
    types = dict(centres="<i4", radii="<f8", child_from="<i4", child_to="<i4", point_from="<i4", point_to="<i4", node_label="<i8", uniform="i1")
    arrays = {k: np.array(v, types[k]) for k, v in nodes.items()}
    whole = np.concatenate(order)
    arrays["centres"] = np.argsort(whole, kind="stable")[arrays["centres"]].astype("<i4")  # places in the new order
    return whole, arrays


def plant(entries: DataFrame, d: int, tree_rows: int) -> DataFrame:
    """The written trees, one a row."""
    total = entries.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("bucket").alias("buckets")).first()
    count = max(1, min(PIVOTS, total["rows"] // (max(1, total["buckets"]) * tree_rows)))
    second = F.coalesce(F.get(F.array_distinct("ids"), F.lit(1)), F.lit(NONE))
    small = entries.select("entry", "bucket", "label", "vector", F.element_at("ids", 1).alias("first"), second.alias("second"))
    if count > 1:
        centres, largest = pivots(entries, count, d)

        def nearest(batches):
            for batch in batches:
                z = lifted(matrix(batch.column("vector"), d), largest)
                cell = ((centres * centres).sum(axis=1) - 2 * (z @ centres.T)).argmin(axis=1) if len(z) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=[*batch.schema.names, "cell"])

        small = written(small.mapInArrow(nearest, "entry long, bucket int, label long, vector array<long>, first long, second long, cell int"), "cover-cells")
    else:
        small = small.withColumn("cell", F.lit(0))
    blocks = small.groupBy("bucket", "cell").agg(F.ceil(F.count(F.lit(1)) / tree_rows).cast("int").alias("blocks"))
    dealt = small.join(blocks, ["bucket", "cell"]).withColumn("block", F.pmod(F.xxhash64("entry"), F.col("blocks")).cast("int"))

    def grow(key: tuple, group: pa.Table) -> pa.Table:
        x = matrix(group.column("vector"), d)
        labels, entry, first, second = (group.column(c).to_numpy() for c in ("label", "entry", "first", "second"))
        order, nodes = build_tree(x, labels)
        size = int(np.abs(x).max())
        kind = "<i2" if size < 2**15 else "<i4" if size < 2**31 else "<i8"
        bucket, cell, block = (k.as_py() for k in key)
        row = {"bucket": bucket, "tree": ((bucket * PIVOTS + cell) << 32) + block, "rows": len(x), "type": kind, "vectors": x[order].astype(kind).tobytes()}
        row |= {k: v[order].astype("<i8").tobytes() for k, v in (("labels", labels), ("entries", entry), ("firsts", first), ("seconds", second))}
        row |= {k: v.tobytes() for k, v in nodes.items()}
        fields = {f.split()[0]: f.split()[1] for f in TREE.split(", ")}
        types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        return pa.table({k: pa.array([row[k]], types[t]) for k, t in fields.items()})

    return written(dealt.groupBy("bucket", "cell", "block").applyInArrow(grow, TREE), "cover-trees")


class Best:
    """The k best (score, smallest id, entry) of every anchor and window so far."""

    def __init__(self, own: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int) -> None:
        self.own, self.lo, self.hi, self.k = own, lo, hi, k
        self.score = np.full((*lo.shape, k), NONE, np.int64)
        self.first = np.zeros((*lo.shape, k), np.int64)
        self.entry = np.zeros((*lo.shape, k), np.int64)

    def floor(self, who: np.ndarray) -> np.ndarray:
        """Lowest score that can still enter, by anchor and window."""
        return np.maximum(self.lo[who], self.score[who, :, -1])

    def take(self, who: np.ndarray, scores: np.ndarray, allowed: np.ndarray, first: np.ndarray, second: np.ndarray, entry: np.ndarray) -> None:
        """``first`` and ``second`` are an entry's two smallest ids: an anchor's own id does not count."""
        floor = self.floor(who)
        mine = first == self.own[who, None]
        least = np.where(mine, second, first)
        allowed = allowed & (least != NONE)
        for w in range(self.lo.shape[1]):
            i, j = np.nonzero(allowed & (scores >= floor[:, w, None]) & (scores <= self.hi[who, w, None]))
            if not len(i):
                continue
            touched, place = np.unique(i, return_inverse=True)
            a = who[touched]
            owner = np.concatenate([place, np.repeat(np.arange(len(a)), self.k)])
            s = np.concatenate([scores[i, j], self.score[a, w].ravel()])
            f = np.concatenate([least[i, j], self.first[a, w].ravel()])
            e = np.concatenate([entry[j], self.entry[a, w].ravel()])
            by = np.lexsort((f, -s, owner))
            begins = np.searchsorted(owner[by], np.arange(len(a)))
            best = by[begins[:, None] + np.arange(self.k)]  # every owner has k old places at least
            self.score[a, w], self.first[a, w], self.entry[a, w] = s[best], f[best], e[best]


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of whole-number rows; ``exact``: whether doubles hold all of them."""
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if exact else a @ b.T


def descend(tree: dict, d: int, anchors: np.ndarray, labels: np.ndarray, same: bool, best: Best) -> int:
    """Best-first descent of one tree for a pack of anchors; returns the inner products verified."""
    nodes = {k: np.frombuffer(tree[k], t) for k, t in (("centres", "<i4"), ("radii", "<f8"), ("child_from", "<i4"), ("child_to", "<i4"), ("point_from", "<i4"), ("point_to", "<i4"), ("node_label", "<i8"), ("uniform", "i1"))}
    x = np.frombuffer(tree["vectors"], tree["type"]).reshape(-1, d).astype(np.int64)
    label, entry, first, second = (np.frombuffer(tree[k], "<i8") for k in ("labels", "entries", "firsts", "seconds"))
    squares = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    length = np.einsum("ij,ij->i", anchors.astype(np.float64), anchors.astype(np.float64))[:, None]
    base = length + squares.max()
    exact = bool(base.max() < 2.0**52)
    radii = nodes["radii"] * (1 + SLACK) + (0 if exact else 1e-6 * np.sqrt(base))  # sqrt(M^2 - |x|^2) is coarse where squares are rounded
    square = base - 2 * (anchors.astype(np.float64) @ x[nodes["centres"]].T.astype(np.float64))
    near, far = np.sqrt(np.maximum(0, square - SLACK * base)), np.sqrt(np.maximum(0, square) + SLACK * base)
    upper = (base - np.maximum(0, near - radii) ** 2) / 2 + SLACK * base
    lower = (base - (far + radii) ** 2) / 2 - SLACK * base
    verified, queue = 0, [(-np.inf, 0, np.arange(len(anchors)))]
    while queue:
        _, node, who = heapq.heappop(queue)
        reach = ((upper[who, node, None] >= best.floor(who)) & (lower[who, node, None] <= best.hi[who])).any(axis=1)
        if nodes["uniform"][node]:
            reach &= (labels[who] == nodes["node_label"][node]) == same
        who = who[reach]
        if not len(who):
            continue
        for at in range(nodes["point_from"][node], nodes["point_to"][node], POINTS_AT_ONCE):
            run = slice(at, min(at + POINTS_AT_ONCE, nodes["point_to"][node]))
            scores = products(anchors[who], x[run], exact)
            best.take(who, scores, (labels[who, None] == label[run]) == same, first[run], second[run], entry[run])
            verified += scores.size
        for child in range(nodes["child_from"][node], nodes["child_to"][node]):
            heapq.heappush(queue, (-float(upper[who, child].max()), child, who))
    return verified


def search(trees: DataFrame, asked: DataFrame, d: int, same: bool, k: int) -> DataFrame:
    """anchor, nth, entry, first, score: for every window of ``asked`` (anchor, anchor_id, label, bucket, vector, lo, hi) the k best entries of every task."""
    at = F.col("bucket") if same else F.lit(-1)
    trees = trees.withColumn("bucket", at)
    asked = asked.withColumn("bucket", at)
    # tree numbers differ between buckets
    grove = trees.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / TREES_A_TASK).cast("int").alias("slots"))
    crowd = asked.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / PACK).cast("int").alias("packs"))
    sizes = grove.join(crowd, "bucket")  # one row a bucket
    left = asked.join(sizes, "bucket").withColumn("pack", F.pmod(F.xxhash64("anchor"), F.col("packs"))).withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    slot = F.pmod(F.xxhash64("tree"), F.col("slots")).cast("int")
    right = trees.join(sizes, "bucket").withColumn("slot", slot).withColumn("pack", F.explode(F.sequence(F.lit(0).cast("long"), F.col("packs").cast("long") - 1)))
    key = ["bucket", "pack", "slot"]

    def run(asking: pa.Table, held: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 5
        if asking.num_rows and held.num_rows:
            anchors, label, anchor = matrix(asking.column("vector"), d), asking.column("label").to_numpy(), asking.column("anchor").to_numpy()
            windows = max(1, max(len(v) for v in asking.column("lo").to_pylist()))
            lo, hi = np.full((len(anchors), windows), -NONE, np.int64), np.full((len(anchors), windows), NONE, np.int64)  # closed
            for i, (low, high) in enumerate(zip(asking.column("lo").to_pylist(), asking.column("hi").to_pylist())):
                lo[i, : len(low)], hi[i, : len(high)] = low, high
            best = Best(asking.column("anchor_id").to_numpy(), lo, hi, k)
            for tree in held.to_pylist():
                descend(tree, d, anchors, label, same, best)
            i, w, p = np.nonzero(best.score > NONE)
            out = [anchor[i], w, best.entry[i, w, p], best.first[i, w, p], best.score[i, w, p]]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=["anchor", "nth", "entry", "first", "score"])

    asking = left.select(*key, "anchor", "anchor_id", "label", "vector", "lo", "hi")
    return asking.groupBy(*key).cogroup(right.drop("packs", "slots").groupBy(*key)).applyInArrow(run, FOUND)


def best_rows(found: DataFrame, entries: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """anchor, nth, id, score, rank: the k best rows of what the tasks found, the anchor's own id left out."""
    window = Window.partitionBy("anchor", "nth")
    few = found.withColumn("place", F.row_number().over(window.orderBy(F.desc("score"), "first"))).where(F.col("place") <= k)
    rows = few.join(entries.select("entry", "ids"), "entry").select("anchor", "nth", "score", F.explode("ids").alias("id"))
    rows = rows.join(anchors.select("anchor", "anchor_id"), "anchor").where(F.col("id") != F.col("anchor_id"))
    return rows.withColumn("rank", F.row_number().over(window.orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    id_column: str = "vec_id",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    label = F.col("label") if label is None else label
    rows, entries, d = candidates(vectors.select(id_column, label.alias("label"), vector), id_column, F.col("label"), vector, max(positives, negatives))
    if not d:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    trees = plant(entries, d, tree_rows)
    chosen = rows.withColumnRenamed("id", id_column).where(is_anchor).distinct()
    anchors = written(
        chosen.select(
            F.monotonically_increasing_id().alias("anchor"), F.col(id_column).alias("anchor_id"), "label", "vector", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int").alias("bucket")
        ),
        "cover-anchors",
    )
    everything = anchors.withColumn("lo", F.array(F.lit(NONE + 1))).withColumn("hi", F.array(F.lit(-NONE)))
    found = search(trees, everything, d, True, positives)
    partners = written(best_rows(found, entries, anchors, positives).select("anchor", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "cover-positives")

    # 30 p <= 100 n <= 90 p in whole numbers; a negative p has no such n
    low, high = F.expr("(3 * positive_score + 9) div 10"), F.expr("(9 * positive_score) div 10")
    some = F.when(F.col("positive_score") >= 0, F.struct("rank", low.alias("lo"), high.alias("hi"))).otherwise(F.struct("rank", F.lit(-NONE).alias("lo"), F.lit(NONE).alias("hi")))
    windows = partners.groupBy("anchor").agg(F.array_sort(F.collect_list(some)).alias("w")).select("anchor", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    found = search(trees, anchors.join(windows, "anchor"), d, False, negatives)
    last = best_rows(found, entries, anchors, negatives).select("anchor", "anchor_id", (F.col("nth") + 1).alias("at"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return last.join(partners.withColumnRenamed("rank", "at"), ["anchor", "at"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
