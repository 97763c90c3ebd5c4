"""Token-id files of bit-plane shuffled, zstandard-compressed blocks (operator 3).

A shard image holds the ids of consecutive documents::

    header    magic "BPL1", version, ids a block, bytes an id, n_ids, n_docs, n_blocks
    planes    for each block: its planes, each compressed with zstandard
    index     for each block: first id, number of ids, and the size of each plane
    documents for each document: doc_id (with a null mark), first id, number of ids
    footer    offsets of the index and of the document table

A block of ``BLOCK_IDS`` ids is transposed so that bit k of all its ids lies
together (or byte k, with ``planes="byte"``) before compression: the upper
planes of small ids are nearly constant and shrink to almost nothing. A reader
that wants one document decodes only the blocks under it.

Writing: documents are range-partitioned by (doc_id, text hash) and sorted,
encoded, and cut into shards of about ``SHARD_IDS`` ids at document ends; each
shard image is one row of a Parquet table in the shared folder, so Spark's own
commit protocol makes lost tasks harmless on any file system. Global positions
come from a prefix sum over shard totals (one short row a shard).

Defined cases: null text is encoded as empty (its end id alone); null doc_ids
come first; rows with the same doc_id are ordered by text hash; an empty table
writes no shard; extra columns are ignored. Long texts are encoded whole; one
is never split over shards.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import small_slices, text_or_empty, utf8_buffers, written
from roadlens.llm.token_ids import encoder

BLOCK_IDS = 1 << 16
SHARD_IDS = 1 << 20
BATCH_BYTES = 2 << 20
LEVEL = 3
HEADER = struct.Struct("<4sBBIIQQQ")  # magic, plane kind, bytes an id, ids a block, blocks, ids, docs, spare
FOOTER = struct.Struct("<QQ")
MAGIC = b"BPL1"


def swap_bits(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number as an 8 x 8 bit matrix, transposed: exchanges of bits at distance 7, 14 and 28."""
    for distance, mask in ((7, 0x00AA00AA00AA00AA), (14, 0x0000CCCC0000CCCC), (28, 0x00000000F0F0F0F0)):
        shift = np.uint64(distance)
        t = (x ^ (x >> shift)) & np.uint64(mask)
        x = x ^ t ^ (t << shift)
    return x


def to_planes(ids: np.ndarray, width: int, bits: bool) -> list[bytes]:
    """The block transposed into ``8 * width`` bit planes or ``width`` byte planes.

    The ids are padded with zeros to a multiple of eight for bit planes.
    """
    rows = ids.astype(np.dtype(f"<u{width}"), copy=False).view(np.uint8).reshape(len(ids), width)
    if not bits:
        return [rows[:, k].tobytes() for k in range(width)]
    out = []
    for k in range(width):
        padded = np.zeros(-(-len(ids) // 8) * 8, np.uint8)
        padded[: len(ids)] = rows[:, k]
        cells = swap_bits(padded.view("<u8")).astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        out += [cells[:, bit].tobytes() for bit in range(8)]
    return out


def from_planes(planes: list[bytes], n: int, width: int, bits: bool) -> np.ndarray:
    """The ids of a block of ``n`` from its planes."""
    rows = np.empty((n, width), np.uint8)
    for k in range(width):
        if bits:
            cells = np.stack([np.frombuffer(p, np.uint8) for p in planes[8 * k : 8 * k + 8]], axis=1)
            rows[:, k] = swap_bits(cells.reshape(-1).view("<u8")).astype("<u8", copy=False).view(np.uint8)[:n]
        else:
            rows[:, k] = np.frombuffer(planes[k], np.uint8)
    return rows.reshape(-1).view(np.dtype(f"<u{width}")).astype(np.uint32)


def write_image(ids: np.ndarray, doc_ids: list, sizes: np.ndarray, bits: bool = True, block_ids: int = BLOCK_IDS) -> bytes:
    """The image of one shard: ``ids`` of documents ``doc_ids`` with ``sizes`` ids each."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    pack = zstandard.ZstdCompressor(level=LEVEL)
    body, index = [], []
    for first in range(0, len(ids), block_ids):
        block = ids[first : first + block_ids]
        planes = [pack.compress(p) for p in to_planes(block, width, bits)]
        body += planes
        index.append([first, len(block), *map(len, planes)])
    n_planes = width * (8 if bits else 1)
    table = np.array(index, "<u8").reshape(len(index), 2 + n_planes).tobytes()
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0)
    docs = np.stack(
        [np.array([d is None for d in doc_ids], "<i8"), np.array([d or 0 for d in doc_ids], "<i8"), starts.astype("<i8"), np.asarray(sizes, "<i8")],
        axis=1,
    ).tobytes()
    head = HEADER.pack(MAGIC, bits, width, block_ids, len(index), len(ids), len(doc_ids), 0)
    at = HEADER.size + sum(map(len, body))
    return b"".join([head, *body, table, docs, FOOTER.pack(at, at + len(table))])


class Image:
    """A shard image: its document table, and ids decoded block by block as asked for."""

    def __init__(self, raw: bytes):
        magic, self.bits, self.width, self.block_ids, n_blocks, self.n_ids, n_docs, _ = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token-id image")
        at_index, at_docs = FOOTER.unpack_from(raw, len(raw) - FOOTER.size)
        n_planes = self.width * (8 if self.bits else 1)
        self.raw = raw
        self.index = np.frombuffer(raw, "<u8", n_blocks * (2 + n_planes), at_index).reshape(n_blocks, 2 + n_planes)
        self.docs = np.frombuffer(raw, "<i8", n_docs * 4, at_docs).reshape(n_docs, 4)
        ends = HEADER.size + np.cumsum(self.index[:, 2:].sum(axis=1))
        self.block_at = np.concatenate([[HEADER.size], ends]).astype(np.int64)
        self._unpack = zstandard.ZstdDecompressor()
        self._held: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint32))

    def block(self, k: int) -> np.ndarray:
        if self._held[0] != k:
            at, n, planes = int(self.block_at[k]), int(self.index[k, 1]), []
            for size in self.index[k, 2:].tolist():
                planes.append(self._unpack.decompress(self.raw[at : at + size]))
                at += size
            self._held = (k, from_planes(planes, n, self.width, bool(self.bits)))
        return self._held[1]

    def parts(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids [start, start + n) in runs, one block at a time."""
        while n > 0:
            k, within = divmod(start, self.block_ids)
            part = self.block(k)[within : within + n]
            yield part
            start, n = start + len(part), n - len(part)


IMAGES = "shard long, part int, n_ids long, n_docs long, image binary"


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, bits: bool = True, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encodes ``docs`` in ascending doc_id order; the written table of shard images.

    ``part`` and ``shard`` order the images: ascending, they hold ascending doc_ids.
    """

    def images(batches):
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        encode, held_ids, held_docs, held_sizes, held = encoder(tokenizer_path), [], [], [], 0

        def flush():
            ids = np.concatenate(held_ids)
            raw = write_image(ids, held_docs, np.array(held_sizes, np.int64), bits)
            row = [[(part << 32) + shard], [part], [len(ids)], [len(held_docs)], [raw]]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=["shard", "part", "n_ids", "n_docs", "image"])

        for batch in batches:
            for piece in small_slices(batch, "text", BATCH_BYTES):
                ids, upto = encode(*utf8_buffers(piece.column("text")))
                sizes = np.diff(upto) + 1
                with_end = np.insert(ids.astype(np.uint32), upto[1:], np.uint32(end_id))
                held_ids.append(with_end)
                held_docs += piece.column("doc_id").to_pylist()
                held_sizes += sizes.tolist()
                held += len(with_end)
                if held >= shard_ids:
                    yield flush()
                    shard, held_ids, held_docs, held_sizes, held = shard + 1, [], [], [], 0
        if held_docs:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ordered.mapInArrow(images, IMAGES), "token-files", compression="uncompressed")


def read_token_files(images: DataFrame) -> DataFrame:
    """One row per document, decoded from the images: doc_id, start, n_tokens, ids_crc32."""
    per_part = images.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    # one row per written partition
    before = per_part.select(
        F.col("part"),
        F.coalesce(F.sum("part_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"),
    )
    shards = images.select("part", "shard", "n_ids").join(before, "part")
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", (F.col("part_start") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("base"))

    def decode(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                image = Image(batch.column("image")[i].as_py())
                base = batch.column("shard")[i].as_py()
                out = ([], [], [], [], [])
                for null, doc_id, start, n in image.docs.tolist():
                    crc = 0
                    for part in image.parts(start, n):
                        crc = zlib.crc32(np.ascontiguousarray(part, "<u4"), crc)
                    for column, value in zip(out, (base, None if null else doc_id, start, n, crc)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    decoded = images.select("shard", "image").mapInArrow(decode, "shard long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return decoded.join(bases, "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )
