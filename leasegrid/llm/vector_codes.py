"""Vector code compression with per-dimension value dictionaries.

Vectors become integers and are stored in blocks: for every dimension a block
keeps its distinct integers once and a short code per row. A round tabulates,
per dimension, the squared difference of each distinct integer to all codebook
entries; the distance of a part is then gathered from its dimensions' tables by
the codes and added. Nothing is multiplied per row. A dictionary never exceeds
the rows of its block, so memory is bounded whatever the values are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from leasegrid.llm.common import broadcast_if_small
from leasegrid.llm.integer_vectors import finite_rows, integers, longest
from leasegrid.session import cut_lineage

_BINARY, _STRING = BinaryType(), StringType()
#: Rows of a block (codes are 16 bits wide) and rows whose distances are held at a time.
BLOCK_ROWS, STEP_ROWS = 8192, 1024


def dictionaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per dimension the distinct integers, ascending: (sizes, values end to end, codes by dimension and row)."""
    sizes, values, codes = [], [], np.empty((x.shape[1], len(x)), np.uint16)
    for d in range(x.shape[1]):
        seen, codes[d] = np.unique(x[:, d], return_inverse=True)
        sizes.append(len(seen))
        values.append(seen)
    return np.array(sizes, np.int32), np.concatenate([*values, np.zeros(0, np.int64)]), codes


def nearest_entries(sizes: np.ndarray, values: np.ndarray, codes: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codebook entry of each part and its squared distance: two arrays (parts, rows).

    ``books`` is (parts, entries, dimensions of a part). Ties go to the lower index.
    """
    parts, entries, wide = books.shape
    starts = np.concatenate([[0], np.cumsum(sizes)])
    index, least = np.empty((parts, codes.shape[1]), np.int64), np.empty((parts, codes.shape[1]), np.int64)
    for p in range(parts):
        tables = []
        for j in range(wide):
            d = p * wide + j
            gap = values[starts[d]:starts[d + 1], None] - books[p, :, j][None, :]
            tables.append(gap * gap)
        for a in range(0, codes.shape[1], STEP_ROWS):
            far = np.zeros((min(STEP_ROWS, codes.shape[1] - a), entries), np.int64)
            for j in range(wide):
                far += tables[j][codes[p * wide + j, a:a + STEP_ROWS]]
            best = far.argmin(1)
            index[p, a:a + STEP_ROWS] = best
            least[p, a:a + STEP_ROWS] = far[np.arange(len(best)), best]
    return index, least


def pack(rows: DataFrame, width: int, label: StructField) -> DataFrame:
    """Blocks ``(ids, labels, sizes, dict, codes)`` of rows ``(vec_id, v, label)``."""
    schema = StructType([
        StructField("ids", ArrayType(LongType())), StructField("labels", ArrayType(label.dataType)),
        *[StructField(n, t) for n, t in (("sizes", _BINARY), ("dict", _BINARY), ("codes", _BINARY))],
    ])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                sizes, values, codes = dictionaries(integers(part.column(1), width))
                ends = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(ends, part.column(0)), pa.ListArray.from_arrays(ends, part.column(2)),
                    *[pa.array([x.tobytes()], pa.binary()) for x in (sizes, values, codes)],
                ], ["ids", "labels", "sizes", "dict", "codes"])

    return rows.select("vec_id", "v", "label").mapInArrow(blocks, schema)


def _unpack(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes, values, codes = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in ((2, np.int32), (3, np.int64), (4, np.uint16)))
    return sizes, values, codes.reshape(len(sizes), -1)


def improve(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: assign every part, then move each used entry to the floor of its parts' mean.

    A task sends a count and a sum per entry and dimension; the driver receives
    as many numbers as the codebooks hold.
    """
    parts, entries, wide = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, wide), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                sizes, values, codes = _unpack(batch, i)
                starts = np.concatenate([[0], np.cumsum(sizes)])
                index, _ = nearest_entries(sizes, values, codes, books)
                for p in range(parts):
                    count[p] += np.bincount(index[p], minlength=entries)
                    for j in range(wide):
                        d = p * wide + j
                        x = values[starts[d]:starts[d + 1]][codes[d]]
                        # a block's sums stay below 2^53, so doubles hold them exactly
                        total[p, :, j] += np.bincount(index[p], x, entries).astype(np.int64)
        p, e, j = (a.reshape(-1) for a in np.indices(total.shape))
        n = np.repeat(count.reshape(-1), wide)
        used = n > 0
        yield pa.RecordBatch.from_arrays([
            pa.array(p[used], pa.int32()), pa.array(e[used], pa.int32()), pa.array(j[used], pa.int32()),
            pa.array(n[used], pa.int64()), pa.array(total.reshape(-1)[used], pa.int64()),
        ], ["p", "e", "j", "n", "total"])

    partial = blocks.mapInArrow(sums, "p int, e int, j int, n long, total long")
    new = books.copy()
    for r in partial.groupBy("p", "e", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r.p, r.e, r.j] = r.total // r.n
    return new


def compress_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, label, code, error)`` per usable vector, frozen, and the codebooks (parts, entries, dimensions).

    Component x becomes floor(256 x). The codebook of a part starts as that part
    of the vectors with the smallest ids (equal ids by vector, null ids last),
    is improved ``rounds`` times, and encodes every vector: two hex digits per
    part; ``error`` is the squared distance in integers. Fewer than ``entries``
    vectors give fewer entries. Vectors that are null or hold null or non-finite
    components have no row. Vectors of other lengths than the longest, and
    lengths that ``parts`` does not divide, are filled with zeros; integers are
    limited to 2^24 either way. Repeated rows are coded alike, each with its own
    row. Other columns are ignored; an empty table gives no row.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits name at most 256 entries")
    rows = finite_rows(vectors, id_col, vector_col, F.col(label_col).alias("label"))
    wide = max(1, -(-longest(rows) // parts))
    first = rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    books = integers(pa.array([r.v for r in first], pa.list_(pa.float64())), parts * wide)
    books = np.ascontiguousarray(books.reshape(len(first), parts, wide).transpose(1, 0, 2))
    blocks = cut_lineage(pack(rows, parts * wide, rows.schema["label"]))
    for _ in range(rounds if len(first) else 0):
        books = improve(blocks, books)
    label = rows.schema["label"].dataType
    schema = StructType([
        StructField("vec_id", LongType()), StructField("label", label), StructField("code", _STRING), StructField("error", LongType()),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                index, least = nearest_entries(*_unpack(batch, i), books)
                code = index.T.astype(np.uint8).tobytes().hex()
                step = 2 * parts
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[i].values, batch.column(1)[i].values,
                    pa.array([code[a:a + step] for a in range(0, len(code), step)], pa.string()), pa.array(least.sum(0), pa.int64()),
                ], ["vec_id", "label", "code", "error"])

    return cut_lineage(blocks.mapInArrow(encode, schema)), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' integers by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the sum of ``error`` over the rows of equal label (nulls together; NULL beyond a long)."""
    totals = coded.groupBy(F.col("label").alias("__l")).agg(F.try_sum("error").alias("label_error"))
    totals = broadcast_if_small(cut_lineage(totals))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("__l"))).drop("__l")
