"""Token ids as binary files of patched frame-of-reference blocks.

A file is a row of chunks, each of whole documents:

    header   magic, shard, documents, blocks, exceptions, first id's place in the shard, ids
    documents   doc_id (int64), whether it is null (uint8), number of ids (uint32)
    index       per block of 128 ids: place of its bits (uint64), minimum (uint32), width (uint8),
                number of exceptions (uint8)
    bits        ids less the minimum, `width` low bits each, first bit highest
    exceptions  place in the block (uint8) and id less minimum (uint32) of each that needs more bits

and a line feed after it. A block's width is what a percentile of its
differences needs; the few larger ones are patched from the exceptions. All
numbers are little-endian. Files come from Spark's own text sink, which
writes bytes as they are, so that lost executors and retried tasks leave no
half-written file, in any file system that Spark can write.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leavewatch.llm import tokens
from leavewatch.sources.shared_storage import cut_lineage

BLOCK = 128
PERCENTILE = 90
CHUNK_IDS = 1 << 18       # a chunk ends with the document that reaches this
CHUNKS_PER_FILE = 64
_MAGIC = b"PFOR1\r\n\x1a"
_HEADER = np.dtype([("magic", "S8"), ("shard", "<u4"), ("docs", "<u4"), ("blocks", "<u4"), ("exceptions", "<u4"), ("start", "<u8"), ("ids", "<u8")])


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, ...]:
    """Blocks of ids: bit places, minimums, widths, exception counts, bits, exception places, exception values."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        empty = np.empty(0, np.uint8)
        return (empty,) * 7
    padded = np.full(n_blocks * BLOCK, ids[-1], dtype=np.uint32)
    padded[:len(ids)] = ids
    blocks = padded.reshape(n_blocks, BLOCK)
    least = blocks.min(axis=1)
    rest = blocks - least[:, None]
    rank = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    needed = np.partition(rest, rank, axis=1)[:, rank]
    width = np.zeros(n_blocks, dtype=np.uint8)
    for bit in range(32):
        width += needed >= (1 << bit)
    beyond = (rest.astype(np.uint64) >> width[:, None].astype(np.uint64)) > 0
    size = width.astype(np.int64) * (BLOCK // 8)
    place = np.cumsum(size) - size
    bits = np.zeros(int(size.sum()), dtype=np.uint8)
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            each = np.unpackbits(rest[rows].astype(">u4").view(np.uint8).reshape(len(rows), BLOCK, 4), axis=2)[:, :, 32 - int(w):]
            bits[tokens.spread(place[rows], size[rows])] = np.packbits(each.reshape(len(rows), -1), axis=1).reshape(-1)
    row, column = np.nonzero(beyond)
    return place, least, width, beyond.sum(axis=1), bits, column, rest[row, column]


def unpack(place: np.ndarray, least: np.ndarray, width: np.ndarray, exceptions: np.ndarray, bits: np.ndarray,
           columns: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(least), BLOCK), dtype=np.uint32)
    size = width.astype(np.int64) * (BLOCK // 8)
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            each = np.unpackbits(bits[tokens.spread(place[rows].astype(np.int64), size[rows])]).reshape(len(rows), BLOCK, int(w))
            wide = np.zeros((len(rows), BLOCK, 32), dtype=np.uint8)
            wide[:, :, 32 - int(w):] = each
            out[rows] = np.packbits(wide, axis=2).view(">u4").reshape(len(rows), BLOCK)
    out[np.repeat(np.arange(len(least)), exceptions), columns] = values
    return (out + least[:, None].astype(np.uint32)).reshape(-1)[:n]


def chunk_bytes(shard: int, start: int, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray,
                percentile: float = PERCENTILE) -> bytes:
    place, least, width, exceptions, bits, columns, values = pack(ids, percentile)
    header = np.array([(_MAGIC, shard, len(doc_ids), len(least), len(values), start, len(ids))], dtype=_HEADER)
    parts = [header, np.array([d or 0 for d in doc_ids], dtype="<i8"), np.array([d is None for d in doc_ids], dtype=np.uint8),
             counts.astype("<u4"), place.astype("<u8"), least.astype("<u4"), width.astype(np.uint8), exceptions.astype(np.uint8),
             bits, columns.astype(np.uint8), values.astype("<u4")]
    return b"".join(p.tobytes() for p in parts)


def read_chunks(content: bytes) -> Iterator[dict]:
    """The chunks of a file, each with its documents and ids."""
    at, end = 0, len(content)

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(content, dtype=kind, count=n, offset=at)
        at += out.nbytes
        return out

    while at < end:
        head = take(_HEADER, 1)[0]
        if head["magic"] != _MAGIC:
            raise ValueError("not a file of token chunks")
        docs, blocks = int(head["docs"]), int(head["blocks"])
        doc_ids, null, counts = take("<i8", docs), take("u1", docs), take("<u4", docs)
        place, least, width, exceptions = take("<u8", blocks), take("<u4", blocks), take("u1", blocks), take("u1", blocks)
        bits = take("u1", int(width.astype(np.int64).sum()) * (BLOCK // 8))
        columns, values = take("u1", int(head["exceptions"])), take("<u4", int(head["exceptions"]))
        ids = unpack(place, least, width, exceptions, bits, columns, values, int(head["ids"]))
        at += 1
        yield {"shard": int(head["shard"]), "start": int(head["start"]), "null": null.astype(bool),
               "doc_ids": doc_ids, "counts": counts.astype(np.int64), "ids": ids}


RANGE_BYTES = 128 << 20  # of text in a range of doc_ids, about


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = tokens.END_ID,
                      partitions: int | None = None, percentile: float = PERCENTILE) -> None:
    """Write every document's ids, in ascending doc_id order over all files.

    One shuffle deals the texts by ranges of doc_id, as many as the session's
    shuffle partitions or RANGE_BYTES of text ask for, then each task encodes
    and packs its range as a stream of chunks. A null text is empty and has the end
    id alone; null doc_ids come first, rows that repeat a doc_id follow each
    other in the order of their texts. Other columns are not read.
    """
    spark = docs.sparkSession
    where = tokenizer or tokens.tokenizer_path()
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).head()[0] or 0
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        start, kept, counts, doc_ids = 0, [], [], []

        def chunk() -> pa.RecordBatch:
            nonlocal start, kept, counts, doc_ids
            ids, each = np.concatenate(kept), np.concatenate(counts)
            out = chunk_bytes(shard, start, doc_ids, each, ids, percentile)
            start, kept, counts, doc_ids = start + len(ids), [], [], []
            return pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], ["chunk"])

        for batch in batches:
            known = batch.column(0).to_pylist()
            for first, last, ids, offsets in tokens.encoded(batch.column(1), where, end_id):
                kept.append(ids)
                counts.append(np.diff(offsets))
                doc_ids += known[first:last]
                if sum(map(len, kept)) >= CHUNK_IDS:
                    yield chunk()
        if doc_ids:
            yield chunk()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
     .repartitionByRange(n, F.col("doc_id")).sortWithinPartitions("doc_id", "text")
     .mapInArrow(encode, "chunk binary")
     .select(F.col("chunk").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", CHUNKS_PER_FILE).text(path))


def read_token_files(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files.

    Starts within a shard are in the files; what the shards before hold is a
    running sum over one row per shard, sent to all tasks (one row per shuffle
    partition of the writer, so bounded by that setting).
    """
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for chunk in read_chunks(content.as_py()):
                    ends = np.cumsum(chunk["counts"])
                    begins = ends - chunk["counts"]
                    raw = memoryview(chunk["ids"].astype("<u4").tobytes())
                    crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(crc), chunk["shard"], dtype=np.int32)),
                         pa.array(chunk["doc_ids"], mask=chunk["null"]), pa.array(begins + chunk["start"]),
                         pa.array(chunk["counts"]), pa.array(crc, pa.int64())],
                        ["shard", "doc_id", "within", "n_tokens", "ids_crc32"])

    schema = "shard int, doc_id long, within long, n_tokens long, ids_crc32 long"
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    rows = cut_lineage(files.mapInArrow(decode, schema))
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (rows.join(F.broadcast(shards.select("shard", before.alias("before"))), "shard")
            .select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"))
