"""Token-ID output in patched frame-of-reference (PFOR) shard files.

A shard holds the token ids of consecutive documents (ascending doc_id), cut
into blocks of ``BLOCK`` ids.  A block stores its minimum, the ids minus that
minimum in a bit width chosen at a percentile of the values, and an exception
list (position, full value) for ids that do not fit.  The footer has an index of
block starts and the document table, so that a reader can seek to any document.

Layout of a shard::

    magic "PFOR0001"
    blocks: min u32 | n u32 | n_exceptions u32 | width u32 | packed bits | positions u32[] | values u32[]
    footer: block starts u64[n_blocks] | doc ids i64[n_docs] | doc lengths u64[n_docs]
    trailer: n_blocks u64 | n_docs u64 | null-id documents u64 | magic

Cases: a null text is empty (only the end id); a null doc_id is kept, sorts
first and is read back as null; equal doc_ids are ordered by text; an empty
table gives no shard and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import materialise, scratch_path, shuffle_partitions, texts

MAGIC = b"PFOR0001"
BLOCK = 4096
WIDTH_PERCENTILE = 98.0
MAX_SHARD_TOKENS = 8_000_000
_HEAD = struct.Struct("<IIII")
_TRAILER = struct.Struct("<QQQ8s")


def pack_block(ids: np.ndarray, percentile: float = WIDTH_PERCENTILE) -> bytes:
    """One PFOR block of unsigned 32-bit ids (at least one)."""
    ids = ids.astype(np.uint32)
    low = int(ids.min())
    rest = ids - np.uint32(low)
    at = min(len(rest) - 1, int(len(rest) * percentile / 100.0))
    width = int(np.partition(rest, at)[at]).bit_length()
    odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    values = rest[odd]
    rest[odd] = 0
    bits = np.unpackbits(rest.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little") if width else np.empty(0, np.uint8)
    packed = np.packbits(bits.ravel(), bitorder="little").tobytes()
    return _HEAD.pack(low, len(ids), len(odd), width) + packed + odd.astype("<u4").tobytes() + values.astype("<u4").tobytes()


def unpack_block(data: memoryview, at: int) -> np.ndarray:
    """The ids of the block that starts at byte ``at``."""
    low, n, n_odd, width = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    size = (n * width + 7) // 8
    out = np.zeros(n, np.uint64)
    if width:
        raw = np.zeros((size + 15) // 8 * 8 + 8, np.uint8)
        raw[:size] = np.frombuffer(data, np.uint8, size, at)
        words = np.lib.stride_tricks.as_strided(raw.view("<u8"), (size + 1,), (1,), writeable=False)
        place = np.arange(n, dtype=np.int64) * width
        out = (words[place >> 3] >> (place & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)
    at += size
    if n_odd:
        out[np.frombuffer(data, "<u4", n_odd, at)] = np.frombuffer(data, "<u4", n_odd, at + 4 * n_odd)
    return (out + np.uint64(low)).astype(np.uint32)


def write_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """Bytes of a shard; ``ids`` are the ids of all its documents one after another."""
    parts, starts, at = [MAGIC], [], len(MAGIC)
    for k in range(0, len(ids), BLOCK):
        block = pack_block(ids[k : k + BLOCK])
        starts.append(at)
        parts.append(block)
        at += len(block)
    n_null = sum(d is None for d in doc_ids)
    parts.append(np.array(starts, "<u8").tobytes())
    parts.append(np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes())
    parts.append(np.array(lengths, "<u8").tobytes())
    parts.append(_TRAILER.pack(len(starts), len(doc_ids), n_null, MAGIC))
    return b"".join(parts)


def read_shard(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, lengths, ids of all documents) of a shard."""
    n_blocks, n_docs, n_null, magic = _TRAILER.unpack_from(data, len(data) - _TRAILER.size)
    if magic != MAGIC or data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a PFOR shard")
    at = len(data) - _TRAILER.size - 8 * n_blocks - 16 * n_docs
    starts = np.frombuffer(data, "<u8", n_blocks, at)
    doc_ids = np.frombuffer(data, "<i8", n_docs, at + 8 * n_blocks)
    lengths = np.frombuffer(data, "<u8", n_docs, at + 8 * n_blocks + 8 * n_docs).astype(np.int64)
    view = memoryview(data)
    ids = [unpack_block(view, int(s)) for s in starts]
    return (
        [None] * n_null + doc_ids[n_null:].tolist(),
        lengths,
        np.concatenate(ids) if ids else np.empty(0, np.uint32),
    )


def read_range(data: bytes, first: int, last: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive) of a shard, unpacking only the blocks that hold them."""
    n_blocks, n_docs, _, _ = _TRAILER.unpack_from(data, len(data) - _TRAILER.size)
    starts = np.frombuffer(data, "<u8", n_blocks, len(data) - _TRAILER.size - 8 * n_blocks - 16 * n_docs)
    if last <= first:
        return np.empty(0, np.uint32)
    a, b = first // BLOCK, (last - 1) // BLOCK + 1
    ids = np.concatenate([unpack_block(memoryview(data), int(s)) for s in starts[a:b]])
    return ids[first - a * BLOCK : last - a * BLOCK]


def write_token_files(docs: DataFrame, tokenizer_path: str, out_dir: str | None = None, end_id: int = 0) -> tuple[DataFrame, str]:
    """Encode every whole text and write shards in ascending doc_id order.

    Returns the manifest (shard bigint, file string, n_docs, n_tokens) and the
    folder, which lies in the shared checkpoint folder unless given.  A shard is
    written under a name of its task attempt and then moved, so a task that runs
    again (lost executor, speculation) replaces it by the same bytes.
    """
    spark = docs.sparkSession
    folder = out_dir or scratch_path(spark, "tokens")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs
        from pyspark import TaskContext

        from ._wordcache import byte_bpe

        bpe = byte_bpe(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        store, base = fs.FileSystem.from_uri(folder)
        part, rolled = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        names: list[int | None] = []
        lengths: list[int] = []

        def flush() -> pd.DataFrame:
            nonlocal rolled, ids, names, lengths
            file = f"part-{part:06d}-{rolled:06d}.pfor"
            data = write_shard(names, lengths, np.frombuffer(b"".join(ids), "<u4"))
            store.create_dir(base, recursive=True)
            own = f"{base}/_{file}.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as f:
                f.write(data)
            store.move(own, f"{base}/{file}")
            row = pd.DataFrame({"shard": [(part << 24) + rolled], "file": [file], "n_docs": [len(names)], "n_tokens": [sum(lengths)]})
            rolled += 1
            ids, names, lengths = [], [], []
            return row

        held = 0
        for batch in batches:
            coded = bpe.encode_all(list(batch["text"]))
            for doc_id, own in zip(batch["doc_id"].astype(object), coded):
                data = own + end
                ids.append(data)
                names.append(None if pd.isna(doc_id) else int(doc_id))
                lengths.append(len(data) // 4)
                held += len(data) // 4
                if held >= MAX_SHARD_TOKENS:
                    yield flush()
                    held = 0
        if names:
            yield flush()

    ordered = (
        texts(docs)
        .repartitionByRange(shuffle_partitions(spark), "doc_id")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    manifest = materialise(ordered.mapInPandas(encode, "shard bigint, file string, n_docs bigint, n_tokens bigint"), "manifest")
    return manifest, folder


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shard files alone.

    ``start`` counts the ids of all documents before it.  The manifest has a row
    a shard, so its running sum is over a few rows for any corpus.
    """
    spark = manifest.sparkSession

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"]):
                doc_ids, lengths, ids = read_shard(data)
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4")
                yield pd.DataFrame(
                    {
                        "file": path.rsplit("/", 1)[1],
                        "doc_id": pd.array(doc_ids, dtype="Int64"),
                        "before": ends - lengths,
                        "n_tokens": lengths,
                        "ids_crc32": [zlib.crc32(raw[e - n : e]) for e, n in zip(ends, lengths)],
                    }
                )

    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    shards = manifest.select(
        "file",
        (F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")).alias("base"),
    )
    rows = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.pfor")
        .load(folder)
        .select("path", "content")
        .mapInPandas(decode, "file string, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint")
    )
    return rows.join(shards, "file").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_file_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the shards of ``docs`` and return what a reader of the files finds."""
    return read_token_files(*write_token_files(docs, tokenizer_path))
