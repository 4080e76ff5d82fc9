"""SentencePiece encoding with N-best segmentations, and decoding.

Every whole text is segmented into its ``n_best`` best piece sequences (see
``piece_lattice``); the best one is its encoding.  Decoding joins the pieces' bytes.

Cases: null and empty texts have no pieces, one empty segmentation of score 0, and
decode to the empty text; texts with fewer segmentations than ``n_best`` give all they
have; a literal U+2581 is written as bytes, so that it is told apart from a
space; equal scores rank in a fixed order; repeated rows are encoded alike; an
empty table gives an empty result; other columns are ignored or kept as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

N_BEST = 4
BATCH_CHARS = 1 << 19

_SEGMENTATIONS = ArrayType(StructType([StructField("ids", ArrayType(IntegerType())), StructField("score", DoubleType())]))


def _turns(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_CHARS``."""
    first, size = 0, 0
    for k, text in enumerate(texts, 1):
        size += len(text)
        if size > BATCH_CHARS or k == len(texts):
            yield first, k
            first, size = k, 0


def encode(docs: DataFrame, model_file: str, n_best: int = N_BEST, text_col: str = "text", out_col: str = "segmentations") -> DataFrame:
    """``docs`` with a column of (ids array<int>, score double) structs, the best segmentation first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .piece_lattice import piece_lattice

        lattice = piece_lattice(model_file)
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            for a, b in _turns(texts):
                coded = lattice.encode(texts[a:b], n_best)
                ids = [i for each, _, _ in coded for i in each]
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(i) // 4 for i in ids)]), pa.int32()), values)
                scores = pa.array([s for _, each, _ in coded for s in each], pa.float64())
                both = pa.StructArray.from_arrays([lists, scores], names=["ids", "score"])
                ends = pa.array(np.cumsum([0, *(len(each) for each, _, _ in coded)]), pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.ListArray.from_arrays(ends, both)], [*batch.schema.names, out_col])

    schema = StructType([*docs.schema.fields, StructField(out_col, _SEGMENTATIONS)])
    return docs.mapInArrow(work, schema)


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``encoded`` with the text of each row's ids (null ids: null)."""

    @F.pandas_udf("string")
    def join(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from .piece_lattice import piece_lattice

        lattice = piece_lattice(model_file)
        for part in parts:
            yield pd.Series([None if ids is None else lattice.decode(np.asarray(ids, np.int64)) for ids in part])

    return encoded.withColumn(out_col, join(F.col(ids_col)))


def piece_table(docs: DataFrame, model_file: str, n_best: int = N_BEST) -> DataFrame:
    """(doc_id, n_pieces, n_byte_pieces, ids_crc32, score, n_segmentations, gaps, round_trip) for every row.

    ``ids_crc32`` is of the best ids as little-endian unsigned 32-bit integers;
    ``gaps`` are the distances of the further segmentations' scores from the best;
    ``round_trip`` tells whether every segmentation decodes to the text.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from .piece_lattice import piece_lattice

        lattice = piece_lattice(model_file)
        for batch in batches:
            texts, doc_ids = list(batch["text"]), batch["doc_id"]
            for a, b in _turns(texts):
                rows = []
                for text, (ids, scores, n_bytes) in zip(texts[a:b], lattice.encode(texts[a:b], n_best)):
                    same = all(lattice.decode(np.frombuffer(i, "<u4")) == text for i in ids)
                    rows.append((len(ids[0]) // 4, n_bytes, zlib.crc32(ids[0]), scores[0], len(ids), [round(scores[0] - s, 9) for s in scores[1:]], same))
                out = pd.DataFrame(rows, columns=["n_pieces", "n_byte_pieces", "ids_crc32", "score", "n_segmentations", "gaps", "round_trip"])
                out.insert(0, "doc_id", doc_ids.iloc[a:b].to_numpy())
                yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInPandas(
        work,
        "doc_id bigint, n_pieces bigint, n_byte_pieces bigint, ids_crc32 bigint, score double, n_segmentations int, gaps array<double>, round_trip boolean",
    )
