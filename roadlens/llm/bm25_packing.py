"""Lexical retrieval packing (operator 2).

Documents are encoded and packed into sequences of ``window`` ids so that a
sequence holds lexically related documents. Documents are brought together by a
shuffle first: each is placed by its two heaviest BM25 terms among those that
other documents hold too, and the corpus is dealt in ranges of these terms, a
hot term over as many tasks as it needs (a salt orders equal places). It is
then indexed in that order in shards of bounded size (``SHARD_TOKENS``), each
with a BM25 inverted index over token ids; document frequencies and lengths of
the whole corpus enter every shard.
In a shard the first unused document seeds a window; the index returns its
best-scoring unused neighbours by all terms of the seed, which fill the window greedily, best first.
The document that crosses the end of a window is cut there and its rest seeds
the next window, so windows are full. What a task has left at its end is
written as pieces of power-of-two lengths, which need no padding.

Three passes: the encoded documents are written to the shared folder with one
row of document frequencies per partition (one count per vocabulary entry),
then with their places, and the packing pass reads them in the order of places,
so encoded documents are shuffled once. The collected
statistics are one number per vocabulary entry, whatever the corpus.

Defined cases: null text has its end id alone; documents longer than a window
fill windows of their own and their rest seeds the next one; repeated rows are
packed as often as they occur; an empty table gives no pieces; extra columns
are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import small_slices, text_or_empty, utf8_buffers, written
from roadlens.llm.token_ids import encoder, stretches
from roadlens.session import settings

WINDOW = 2048
SHARD_TOKENS = 2_000_000
#: Neighbours fetched at a time, and the share of a shard's documents (one in so many) that makes a term common.
NEIGHBOURS = 64
COMMON = 8
BATCH_BYTES = 4 << 20
#: Rows come to the workers in batches of so many bytes, not of 10,000 rows, which are held on both sides.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
K1, B = 1.2, 0.75

ENCODED = "doc_id long, n_tokens long, ids binary, counts binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int) -> DataFrame:
    """The written table of encoded documents, and per partition a row of document frequencies.

    A row of a document has its ids with the end id as little-endian 32-bit
    numbers (16-bit where the vocabulary allows); a row of frequencies has
    ``counts`` and the number of documents and ids in its other columns.
    """
    kind = np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")

    def run(batches):
        encode, df, docs_seen, ids_seen = encoder(tokenizer_path), np.zeros(vocabulary, np.int64), 0, 0
        for batch in batches:
            for piece in small_slices(batch, "text", BATCH_BYTES):
                ids, upto = encode(*utf8_buffers(piece.column("text")))
                with_end = np.insert(ids.astype(kind), upto[1:], kind.type(end_id))
                sizes = np.diff(upto) + 1
                ends = np.cumsum(sizes)
                owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
                df += np.bincount(term_counts(with_end, owner)[0], minlength=vocabulary)
                docs_seen, ids_seen = docs_seen + len(sizes), ids_seen + int(sizes.sum())
                raw = with_end.tobytes()
                w = kind.itemsize
                cells = [raw[w * (e - n) : w * e] for e, n in zip(ends.tolist(), sizes.tolist())]
                yield _row_batch(piece.column("doc_id"), sizes, cells, [None] * len(cells))
        if docs_seen:
            yield _row_batch(pa.array([ids_seen], pa.int64()), np.array([docs_seen]), [None], [df.astype("<i8").tobytes()])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    with settings(docs.sparkSession, SMALL_BATCHES):
        return written(rows.mapInArrow(run, ENCODED), "packing-encoded")


def term_counts(ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, owner, count) of the different pairs, by term and then owner; ``owner`` rises. Both are sorted as one number."""
    bits = int(owner[-1]).bit_length() if len(owner) else 0
    wide = np.uint32 if ids.dtype.itemsize == 2 and bits <= 16 else np.uint64
    pairs = ids.astype(wide) << wide(bits)
    pairs |= owner.astype(wide)
    pairs.sort()
    first = np.ones(len(pairs), bool)
    np.not_equal(pairs[1:], pairs[:-1], out=first[1:])
    at = np.flatnonzero(first)
    pairs = pairs[at]
    return (pairs >> wide(bits)).astype(ids.dtype), (pairs & wide((1 << bits) - 1)).astype(owner.dtype), np.diff(np.append(at, len(first)))


def bm25_weights(term: np.ndarray, owner: np.ndarray, tf: np.ndarray, sizes: np.ndarray, idf: np.ndarray, mean_length: float) -> np.ndarray:
    norm = K1 * (1 - B + B * sizes / max(mean_length, 1e-9))
    return (idf[term] * tf * (K1 + 1) / (tf + norm[owner])).astype(np.float32)


def small_sort(owner: np.ndarray, n: int) -> np.ndarray:
    """Stable order of numbers below ``n``, by radix where they fit 16 bits."""
    return np.argsort(owner.astype(np.uint16) if n <= 1 << 16 else owner, kind="stable")


def _row_batch(doc_ids, sizes, cells, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(sizes, pa.int64()), pa.array(cells, pa.binary()), pa.array(counts, pa.binary())],
        names=["doc_id", "n_tokens", "ids", "counts"],
    )


def corpus_statistics(encoded: DataFrame, vocabulary: int) -> tuple[np.ndarray, float, np.ndarray]:
    """BM25 idf of every vocabulary entry, the mean document length, and which entries several documents hold.

    The partitions' count vectors are added in the tasks that read them and
    reach the driver as one vector per reading task.
    """

    def add(batches):
        df, docs, ids = np.zeros(vocabulary, np.int64), 0, 0
        for batch in batches:
            for cell in batch.column("counts"):
                df += np.frombuffer(cell.as_buffer(), "<i8")
            docs += pa.compute.sum(batch.column("n_tokens")).as_py() or 0
            ids += pa.compute.sum(batch.column("doc_id")).as_py() or 0
        if docs:
            term = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(term, [-1, -2])), pa.array(np.append(df[term], [docs, ids]))], names=["term", "n"])

    import pyarrow.compute  # noqa: F401

    sums = encoded.where(F.col("counts").isNotNull()).mapInArrow(add, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df, docs, ids = np.zeros(vocabulary), 0, 0
    for term, n in sums.collect():  # one row per vocabulary entry at most
        if term == -1:
            docs = n
        elif term == -2:
            ids = n
        else:
            df[term] = n
    return np.log1p((docs - df + 0.5) / (df + 0.5)), ids / max(docs, 1), df > 1


PLACED = "doc_id long, ids binary, first int, second int"


def placed_documents(encoded: DataFrame, kind: np.dtype, idf: np.ndarray, mean_length: float, shared: np.ndarray) -> DataFrame:
    """The written table of documents with their heaviest and second heaviest BM25 term that other documents hold (-1 if none)."""

    def run(batches):
        for batch in batches:
            for piece in small_slices(batch, "ids", BATCH_BYTES):
                texts = [np.frombuffer(raw.as_buffer(), kind) for raw in piece.column("ids")]
                sizes = np.array([len(t) for t in texts], np.int64)
                term, owner, tf = term_counts(np.concatenate(texts), np.repeat(np.arange(len(texts), dtype=np.int32), sizes))
                several = shared[term]
                term, owner, tf = term[several], owner[several], tf[several]
                weight = bm25_weights(term, owner, tf, sizes, idf, mean_length)
                by_doc = small_sort(owner, len(texts))
                term, owner, weight = term[by_doc], owner[by_doc], weight[by_doc]
                place = np.full((2, len(texts)), -1, np.int32)
                for k in (0, 1):  # the heaviest, and the heaviest without it; ties to the smaller term
                    if not len(owner):
                        break
                    begin = np.flatnonzero(np.diff(owner, prepend=-1))
                    top = np.repeat(np.maximum.reduceat(weight, begin), np.diff(np.append(begin, len(owner))))
                    at = np.flatnonzero(weight == top)
                    at = at[np.diff(owner[at], prepend=-1) != 0]
                    place[k, owner[at]] = term[at]
                    rest = np.ones(len(owner), bool)
                    rest[at] = False
                    term, owner, weight = term[rest], owner[rest], weight[rest]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("ids"), *map(pa.array, place)], names=["doc_id", "ids", "first", "second"])

    rows = encoded.where(F.col("counts").isNull()).select("doc_id", "ids")
    with settings(encoded.sparkSession, SMALL_BATCHES):
        return written(rows.mapInArrow(run, PLACED), "packing-placed")


class ShardIndex:
    """BM25 inverted index over the documents of one shard.

    Postings are sorted by term; each holds the document's BM25 weight of the
    term, so a score is a sum of postings. Terms that more than one document in
    ``COMMON`` holds have their postings as a dense row, and are added by a
    matrix product.
    """

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean_length: float):
        n, vocabulary = len(texts), len(idf)
        sizes = np.array([len(t) for t in texts], np.int64)
        term, self.owner, tf = term_counts(np.concatenate(texts), np.repeat(np.arange(n, dtype=np.int32), sizes))
        self.weight = bm25_weights(term, self.owner, tf, sizes, idf, mean_length)
        held = np.bincount(term, minlength=vocabulary)
        self.begin = np.concatenate([[0], np.cumsum(held)])
        common = np.flatnonzero(held * COMMON > n)
        self.row = np.full(vocabulary, -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), n), np.float32)
        in_dense = self.row[term] >= 0
        self.dense[self.row[term[in_dense]], self.owner[in_dense]] = self.weight[in_dense]
        by_doc = small_sort(self.owner, n)
        self.terms = term[by_doc]
        self.doc_begin = np.concatenate([[0], np.cumsum(np.bincount(self.owner, minlength=n))])
        self.unused = np.ones(n, bool)
        self.scores = np.zeros(n)

    def seed(self, doc: int) -> None:
        """Scores every document for all terms of ``doc``."""
        terms = self.terms[self.doc_begin[doc] : self.doc_begin[doc + 1]]
        rows = self.row[terms]
        asked = np.zeros(len(self.dense), np.float32)
        asked[rows[rows >= 0]] = 1
        terms = terms[rows < 0]
        sizes = self.begin[terms.astype(np.int64) + 1] - self.begin[terms]
        at = stretches(self.begin[terms], sizes)
        self.scores = np.bincount(self.owner.take(at), self.weight.take(at), len(self.unused)) + asked @ self.dense

    def neighbours(self) -> list[int]:
        """The next unused documents for the seed by falling score, ties to the earlier; empty when none is left."""
        scores = self.scores * self.unused
        k = min(NEIGHBOURS, len(scores)) - 1
        least = np.partition(scores, len(scores) - 1 - k)[len(scores) - 1 - k]
        best = np.flatnonzero((scores >= least) & (scores > 0))
        return best[np.lexsort((best, -scores[best]))].tolist()


def order_by_retrieval(index: ShardIndex, sizes: list[int], window: int, room: int) -> list[int]:
    """The order in which a shard's documents enter the windows; ``room`` is left in the current one.

    A seed's neighbours are fetched some at a time until the window is full;
    when it has no more, the next unused document seeds anew.
    """
    order, n, unseeded = [], len(sizes), 0
    queue: list[int] = []
    seeded = False
    while len(order) < n:
        while queue and not index.unused[queue[0]]:
            queue.pop(0)
        if not queue and seeded:
            queue = index.neighbours()
        fresh = not queue
        if fresh:
            while not index.unused[unseeded]:
                unseeded += 1
            doc = unseeded
        else:
            doc = queue.pop(0)
        index.unused[doc] = False
        order.append(doc)
        room -= sizes[doc]
        if room <= 0:  # cut at the window's end: the rest of this document seeds the next window
            room = window - (-room) % window
            fresh, queue = True, []
        if fresh and len(order) < n:
            index.seed(doc)
            seeded = True
    return order


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    encoded = encode_documents(docs, tokenizer_path, end_id, vocabulary)
    idf, mean_length, shared = corpus_statistics(encoded, vocabulary)
    kind = np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")
    placed = placed_documents(encoded, kind, idf, mean_length, shared)

    def run(batches):
        from pyspark import TaskContext

        sequence, offset, open_pieces = TaskContext.get().partitionId() << 40, 0, []

        def emit(pieces):
            cols = list(zip(*pieces))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[x.split()[0] for x in PIECES.split(", ")])

        def pack(shard):
            nonlocal sequence, offset, open_pieces
            texts = [np.frombuffer(raw, kind) for _, raw in shard]
            sizes = [len(t) for t in texts]
            done = []
            for k in order_by_retrieval(ShardIndex(texts, idf, mean_length), sizes, window, window - offset):
                at = 0
                while at < sizes[k]:
                    n = min(sizes[k] - at, window - offset)
                    open_pieces.append((shard[k][0], at, n, texts[k][at : at + n], sizes[k], sequence, offset))
                    at, offset = at + n, offset + n
                    if offset == window:
                        done += open_pieces
                        sequence, offset, open_pieces = sequence + 1, 0, []
            return done

        def plain(pieces):
            return [(*p[:3], zlib.crc32(p[3].astype("<u4")), *p[4:]) for p in pieces]

        shard, held = [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                shard.append((doc_id, raw.as_py()))
                held += len(shard[-1][1]) // kind.itemsize
                if held >= SHARD_TOKENS:
                    if done := pack(shard):
                        yield emit(plain(done))
                    shard, held = [], 0
        if shard:
            if done := pack(shard):
                yield emit(plain(done))
        if open_pieces:
            yield emit(plain(powers_of_two(open_pieces, sequence)))

    place = ["first", "second", F.xxhash64("doc_id", "ids")]
    return placed.repartitionByRange(*place).sortWithinPartitions(*place).select("doc_id", "ids").mapInArrow(run, PIECES)


def powers_of_two(pieces: list[tuple], sequence: int) -> list[tuple]:
    """The pieces of an unfilled window, cut into sequences whose lengths are powers of two."""
    left = sum(p[2] for p in pieces)
    out, room, offset = [], 1 << (left.bit_length() - 1), 0
    for doc_id, start, n, ids, doc_tokens, _, _ in pieces:
        at = 0
        while at < n:
            take = min(n - at, room - offset)
            out.append((doc_id, start + at, take, ids[at : at + take], doc_tokens, sequence, offset))
            at, offset, left = at + take, offset + take, left - take
            if offset == room and left:
                sequence, offset, room = sequence + 1, 0, 1 << (left.bit_length() - 1)
    return out
