"""Near-duplicate detection by BagMinHash (operator 4).

A document is the bag (multiset) of its shingles of ``SHINGLE`` words; the
similarity of two is the weighted Jaccard of their bags, and documents of
``SIMILARITY`` or more are linked. Classes are the connected components.

Signatures. A shingle of weight w owns Poisson processes on the dyadic parts
[0,1), [1,2), [2,4), [4,8) ... of its weight axis, one unit of weight having
rate one. A part that w covers wholly gives all its points; in the part where w
ends, a point carries the unit it fell into (the bits of its hash: the
descent through the halves of the part) and counts if that unit is below w. So
the points of a unit do not depend on w, log2(w) processes describe it, and the
first point of each of ``COMPONENTS`` random classes of points agrees between
two bags with probability equal to their weighted Jaccard. Points are generated
in order, for all documents of a batch at once, until they lie behind the
largest value a document's signature still holds.

Candidates. ``BANDS`` bands of ``ROWS`` components are hashed; documents that
share one are in a bucket. Equal texts meet first, by their digest, and only one
row of each goes on. Every bucket has a hub, its member with the largest
buckets overall (the original of a group of edited copies shares most with
them); all members are compared with it on their full bags, so a bucket of n
costs n comparisons. What is not linked to its hub may still be linked to
another member: among documents connected by buckets, those of different
classes are then compared on their full bags, block with block, as products of
0/1 matrices; a task returns only the links that join classes, not all pairs.

Defined cases: null text counts as empty; documents without words are equal
texts if they are equal, and otherwise linked to nothing; documents of fewer
than ``SHINGLE`` words have one shingle of all their words; rows with a null
doc_id take part, the class id being the smallest doc_id of the class (null if
it has none); repeated rows are in one class; an empty table gives an empty
result; extra columns are ignored. Very long texts are hashed in vectorised
passes over their bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import small_slices, text_or_empty, utf8_buffers, written
from roadlens.llm.token_ids import piece_bounds, piece_names

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
COMPONENTS = BANDS * ROWS
BATCH_BYTES = 1 << 20
BLOCK_MEMBERS = 512

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def bags(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, 48-bit shingle hash, weight) of every different shingle of each text, sorted."""
    n = len(off) - 1
    starts, ends = piece_bounds(data, off, space_led=False)
    names = mixed(piece_names(data, starts, ends))
    owner = np.searchsorted(off, starts, side="right") - 1
    words = np.bincount(owner, minlength=n)
    first = np.concatenate([[0], np.cumsum(words)[:-1]])
    last_start = np.where(words >= SHINGLE, first + words - SHINGLE, first)
    at = np.flatnonzero(np.arange(len(names)) <= last_start[owner]) if len(names) else np.zeros(0, np.int64)
    h = np.zeros(len(at), np.uint64)
    padded = np.concatenate([names, np.zeros(SHINGLE, np.uint64)])
    owners = np.concatenate([owner, np.full(SHINGLE, -1)])
    for k in range(SHINGLE):
        inside = owners[at + k] == owner[at]
        h = mixed((h + np.where(inside, padded[at + k], np.uint64(k + 1))) * _GOLD + np.uint64(1))
    keys = np.sort((owner[at].astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    weight = np.diff(np.append(begin, len(keys)))
    return (keys[begin] >> np.uint64(48)).astype(np.int64), keys[begin] & np.uint64((1 << 48) - 1), weight


def processes(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray):
    """(text number, seed, rate, limit): the dyadic parts of every weight; points of units below ``limit`` count."""
    parts = [(owner, mixed(shingle * _GOLD), np.ones(len(owner)), np.ones(len(owner), np.uint64))]
    low, level = 1, 1
    while True:
        on = np.flatnonzero(weight > low)
        if not len(on):
            break
        seed = mixed((shingle[on] + (np.uint64(level) << np.uint64(48))) * _GOLD)
        parts.append((owner[on], seed, np.full(len(on), float(low)), np.minimum(weight[on] - low, low).astype(np.uint64)))
        low, level = 2 * low, level + 1
    return [np.concatenate(x) for x in zip(*parts)]


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, components: int = COMPONENTS) -> np.ndarray:
    """(n x components) first point of each class, as 32-bit float times; infinite for empty bags."""
    held = np.full(n * components, np.inf)
    who, seed, rate, limit = processes(owner, shingle, weight)
    time, step = np.zeros(len(who)), 0
    while len(who):
        step += 1
        draw = mixed(seed + np.uint64(step * int(_GOLD) % (1 << 64)))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        time = time - np.log(uniform) / rate
        place = mixed(draw ^ _M2)
        counts = (place >> np.uint64(32)) % rate.astype(np.uint64) < limit
        component = (place & np.uint64(0xFFFFFFFF)) % np.uint64(components)
        np.minimum.at(held, (who * components + component.astype(np.int64))[counts], time[counts])
        on = time < held.reshape(n, components).max(axis=1)[who]
        who, seed, rate, limit, time = who[on], seed[on], rate[on], limit[on], time[on]
    return held.reshape(n, components).astype(np.float32)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(n x BANDS) hashes of the bands."""
    bits = signature.view(np.uint32).astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD + np.zeros((len(signature), 1), np.uint64)
    for k in range(ROWS):
        h = mixed(h + bits[:, :, k] * _M1)
    return h.view(np.int64)


def expanded(shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A bag as a set: one number for every occurrence of a shingle."""
    nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    return mixed(np.repeat(shingle, weight) + (nth.astype(np.uint64) << np.uint64(48))).view(np.int64)


SIGNED = "row_id long, doc_id long, digest string, bands array<long>"


def signed(docs: DataFrame) -> DataFrame:
    """The written table of band hashes; ``bands`` is empty for empty bags."""

    def run(batches):
        for batch in batches:
            for part in small_slices(batch, "text", BATCH_BYTES):
                data, off = utf8_buffers(part.column("text"))
                n, raw = part.num_rows, data.tobytes()
                owner, shingle, weight = bags(data, off)
                signature = signatures(owner, shingle, weight, n)
                keys = band_keys(signature)
                some = np.bincount(owner, minlength=n) > 0
                ends = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
                digests = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                columns = [
                    part.column("row_id"), part.column("doc_id"), pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[some].reshape(-1))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SIGNED.split(", ")])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")
    )
    return written(rows.mapInArrow(run, SIGNED), "bagminhash-signed")


def full_bags(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, bag): the written bags, as sets of occurrences, of the rows (node, digest, doc_id) of ``wanted``.

    Repeated rows of one doc_id and text are one node and give one bag.
    """

    def run(batches):
        for batch in batches:
            for part in small_slices(batch, "text", BATCH_BYTES):
                owner, shingle, weight = bags(*utf8_buffers(part.column("text")))
                sizes = np.bincount(owner, weight, part.num_rows).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                bag = pa.ListArray.from_arrays(pa.array(ends), pa.array(expanded(shingle, weight)))
                yield pa.RecordBatch.from_arrays([part.column("node"), bag], names=["node", "bag"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("digest", F.sha2("text", 256))
    same = (F.col("t.digest") == F.col("w.digest")) & F.col("t.doc_id").eqNullSafe(F.col("w.doc_id"))
    rows = texts.alias("t").join(wanted.alias("w"), same).select("w.node", "t.text").groupBy("node").agg(F.any_value("text").alias("text"))
    return written(rows.mapInArrow(run, "node long, bag array<long>"), "bagminhash-bags")


def verified(pairs: DataFrame, bag: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose bags have at least this weighted Jaccard."""
    both = pairs.join(bag.select(F.col("node").alias("a"), F.col("bag").alias("x")), "a").join(
        bag.select(F.col("node").alias("b"), F.col("bag").alias("y")), "b"
    )
    shared = F.size(F.array_intersect("x", "y"))
    least, most = F.least(F.size("x"), F.size("y")), F.greatest(F.size("x"), F.size("y"))
    # sizes alone rule out most false candidates
    near = both.where(least >= similarity * most).where(shared >= similarity * (F.size("x") + F.size("y") - shared))
    return near.select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component of every node that has an edge.

    Contraction: every node is hooked to its smallest neighbour, twice over,
    and edges are drawn anew between what nodes are hooked to, until none is
    left. The edges shrink from round to round; rounds are written tables.
    """
    ends = edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u <> v").distinct()
    all_pairs = pairs = written(ends, "components-edges")
    hooked: DataFrame | None = None
    while not pairs.isEmpty():
        smallest = written(pairs.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("to")), "components-smallest")
        further = smallest.select(F.col("node").alias("to"), F.col("to").alias("far"))
        hook = written(smallest.join(further, "to", "left").select("node", F.coalesce("far", "to").alias("to")), "components-hooks")
        if hooked is None:
            hooked = hook
        else:
            moved = hooked.join(hook.select(F.col("node").alias("to"), F.col("to").alias("far")), "to", "left")
            moved = moved.select("node", F.coalesce("far", "to").alias("to"))
            hooked = written(moved.unionByName(hook.join(hooked, "node", "left_anti")), "components-hooked")
        drawn = pairs.join(hook.select(F.col("node").alias("v"), F.col("to").alias("y")), "v").join(
            hook.select(F.col("node").alias("u"), F.col("to").alias("x")), "u", "left"
        )
        drawn = drawn.select(F.coalesce("x", "u").alias("x"), "y").where("x <> y")
        pairs = written(drawn.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct(), "components-edges")
    nodes = all_pairs.select(F.col("u").alias("node")).union(all_pairs.select("v")).distinct()
    if hooked is None:
        return nodes.withColumn("label", F.col("node"))
    return written(nodes.join(hooked, "node", "left").select("node", F.coalesce("to", "node").alias("label")), "components-labels")


def overlaps(rows: list[np.ndarray], columns: list[np.ndarray], at_once: int = 8192) -> np.ndarray:
    """Sizes of the intersections of every row set with every column set, by products of 0/1 matrices.

    Elements that no row set shares with a column set are left out; the rest
    are taken ``at_once`` a time.
    """
    out = np.zeros((len(rows), len(columns)), np.float32)
    left, right = np.concatenate([*rows, np.zeros(0, np.int64)]), np.concatenate([*columns, np.zeros(0, np.int64)])
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    column = np.repeat(np.arange(len(columns)), [len(x) for x in columns])
    shared = np.intersect1d(left, right)
    p, q = np.searchsorted(shared, left), np.searchsorted(shared, right)
    inside = lambda at, x: (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == x) if len(shared) else np.zeros(len(x), bool)
    on, off = inside(p, left), inside(q, right)
    p, row, q, column = p[on], row[on], q[off], column[off]
    for lo in range(0, len(shared), at_once):
        a, b = np.zeros((len(rows), at_once), np.float32), np.zeros((len(columns), at_once), np.float32)
        for matrix, at, owner in ((a, p, row), (b, q, column)):
            own = (at >= lo) & (at < lo + at_once)
            matrix[owner[own], at[own] - lo] = 1
        out += a @ b.T
    return out


def joining_links(node: np.ndarray, label: np.ndarray, bag: list[np.ndarray], side: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links between the members with ``side`` 0 and those with ``side`` 1 that join different labels; no more than join them."""
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    both = overlaps([bag[i] for i in left], [bag[j] for j in right])
    size = np.array([len(x) for x in bag], np.float32)
    near = both >= similarity * (size[left][:, None] + size[right][None, :] - both) - 1e-6
    near &= (label[left][:, None] != label[right][None, :]) & (both > 0)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(near)):
        x, y = root(int(label[left[i]])), root(int(label[right[j]]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((int(node[left[i]]), int(node[right[j]])))
    return out


def links_beyond_hubs(nodes: DataFrame, bag: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between members of one group of candidates that have different labels.

    ``nodes`` has (node, label, family), a family being documents connected by
    shared buckets. In each family the members of the largest label are blocks
    that need no comparison with each other; the loose ones meet those blocks
    and each other, block by block, on their full bags. A task holds two blocks.
    """
    per_label = nodes.groupBy("family", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = per_label.groupBy("family").agg(
        F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels")
    ).where((F.col("labels") > 1) & (F.col("n") > 2))
    block_count = lambda n: F.ceil(n / BLOCK_MEMBERS).cast("int")
    rows = nodes.join(
        sizes.select("family", F.col("main.label").alias("main"), block_count(F.col("main.n")).alias("mains"), block_count(F.col("n") - F.col("main.n")).alias("others")),
        "family",
    ).withColumn("loose", F.col("label") != F.col("main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("loose"), F.col("others")).otherwise(F.col("mains"))).cast("int")
    span = lambda n: F.sequence(F.lit(0), n - 1)
    place = lambda kind, x, y, side: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), F.lit(side).alias("side"))
    # (0, x, y): main block x with loose block y; (1, x, y): loose blocks x <= y
    with_mains = F.transform(span(F.col("mains")), lambda x: place(0, x, F.col("own"), 1))
    before = F.transform(F.filter(span(F.col("others")), lambda x: x <= F.col("own")), lambda x: place(1, x, F.col("own"), 1))
    after = F.transform(F.filter(span(F.col("others")), lambda y: y >= F.col("own")), lambda y: place(1, F.col("own"), y, 0))
    as_main = F.transform(span(F.col("others")), lambda y: place(0, F.col("own"), y, 0))
    placed = rows.withColumn("own", own).withColumn(
        "at", F.explode(F.when(F.col("loose"), F.concat(with_mains, before, after)).otherwise(as_main))
    )
    met = placed.select("family", "at.kind", "at.x", "at.y", "at.side", "node", "label").join(bag, "node")

    def compare(table: pa.Table) -> pa.Table:
        node, label, side = (table.column(c).to_numpy() for c in ("node", "label", "side"))
        cells = table.column("bag").combine_chunks()
        ends, flat = cells.offsets.to_numpy(), cells.values.to_numpy()
        links = joining_links(node, label, [flat[a:b] for a, b in zip(ends[:-1], ends[1:])], side, similarity)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return met.groupBy("family", "kind", "x", "y").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: row_id, doc_id, digest, class_id, class_size, kept (one row of each class)."""
    rows = signed(docs)
    texts = written(
        rows.groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")).alias("first"), F.count(F.lit(1)).alias("copies")),
        "bagminhash-texts",
    )
    nodes = rows.join(texts.select(F.col("first.row_id").alias("row_id")), "row_id", "left_semi")
    placed = nodes.select(F.col("row_id").alias("node"), F.posexplode("bands").alias("band", "key"))
    shared = placed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(placed.join(shared, ["band", "key"]), "bagminhash-members")
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = members.join(weight, "node").groupBy("band", "key").agg(F.max(F.struct("weight", (-F.col("node")).alias("back"))).alias("top"))
    hubs = hubs.select("band", "key", (-F.col("top.back")).alias("hub"))
    to_hub = members.join(hubs, ["band", "key"])
    pairs = written(to_hub.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), "bagminhash-pairs")
    wanted = nodes.select(F.col("row_id").alias("node"), "digest", "doc_id").join(weight, "node", "left_semi")
    bag = full_bags(docs, wanted)
    links = written(verified(pairs, bag, similarity), "bagminhash-links")
    labels = components(links)
    families = components(pairs).withColumnRenamed("label", "family")
    grouped = families.join(labels, "node", "left").select("node", "family", F.coalesce("label", "node").alias("label"))
    more = written(links_beyond_hubs(grouped, bag, similarity), "bagminhash-more")
    if not more.isEmpty():
        labels = components(links.union(more))
    classed = texts.join(labels.withColumnRenamed("node", "of"), F.col("first.row_id") == F.col("of"), "left").select(
        "digest", "least_id", "first", "copies", F.coalesce("label", "first.row_id").alias("label")
    )
    classes = classed.groupBy("label").agg(F.min("least_id").alias("class_id"), F.min("first").alias("keep"), F.sum("copies").alias("class_size"))
    decided = classed.select("digest", "label").join(classes, "label").drop("label")
    return rows.select("row_id", "doc_id", "digest").join(decided, "digest").select(
        "row_id", "doc_id", "digest", "class_id", "class_size", (F.col("row_id") == F.col("keep.row_id")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, with all its columns."""
    kept = near_duplicates(docs, similarity).where("kept").select(F.col("digest").alias("__digest"), F.col("doc_id").alias("__doc_id"))
    digest = F.sha2(text_or_empty(), 256)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")  # whatever the names of other columns
    rows = docs.select(own, digest.alias("__row_digest"), F.col("doc_id").cast("long").alias("__row_doc_id"))
    same = (F.col("__row_digest") == F.col("__digest")) & F.col("__row_doc_id").eqNullSafe(F.col("__doc_id"))
    # of repeated rows with one doc_id and text, one stays
    return rows.join(kept, same, "left_semi").dropDuplicates(["__row_digest", "__row_doc_id"]).select("__row.*")
