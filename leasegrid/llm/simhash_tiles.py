"""SimHash near-dedup: tiled exact comparison of fingerprints.

Fingerprints are 64 majority bits over the XXH64 hashes of word shingles. The
distinct fingerprints are dealt into tiles by the bit counts of their four
quarters; two fingerprints within distance r have bit counts that differ by at
most r in sum, so all other tile pairs are skipped. Every remaining pair of
tiles is compared exactly with numpy exclusive-or and bit counts, and yields a
spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.common import components, fresh, giving_back
from leasegrid.operators.ordering import top_per_key
from leasegrid.session import cut_lineage

TILE_ROWS = 4096
QUARTER = 17  # a quarter of 16 bits has 0 to 16 bits set


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of one whole text: bit set where over half the shingle hashes have it.

    A-Z is lower-cased; words are runs of other signs than blank and tab to
    carriage return. Fewer words than a shingle: the whole sequence; no word or
    null: zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist())),
        np.uint64, len(words) - k + 1,
    )
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 255 * 256):  # blocks whose sums fit a byte, a bounded number at a time
        part = hashes[a:a + 255 * 256]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for b in range(0, len(bits), 255):
            ones += bits[b:b + 255].sum(0, dtype=np.uint8)
    packed = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, *more: Column) -> DataFrame:
    """Rows (doc_id, fp, *more), one per row of ``docs``."""

    @F.pandas_udf("long")
    @giving_back
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), of(F.col(text_col)).alias("fp"), *more)


def _forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its group) of a spanning forest of all links between a and b."""
    near = np.empty((len(a), len(b)), bool)
    ua, ub = a.view(np.uint64), b.view(np.uint64)
    for i in range(0, len(a), 512):
        near[i:i + 512] = np.bitwise_count(ua[i:i + 512, None] ^ ub[None, :]) <= radius
    if same:
        np.fill_diagonal(near, False)
    rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not len(rows):
        return a[:0], a[:0]
    near = near[np.ix_(rows, cols)]
    a, b = a[rows], b[cols]
    top = np.iinfo(np.int64).max
    la, lb = a.copy(), b.copy()
    while True:  # labels sink to the smallest of each group
        na = np.minimum(la, np.where(near, lb[None, :], top).min(1))
        nb = np.minimum(lb, np.where(near, na[:, None], top).min(0))
        if same:
            na = nb = np.minimum(na, nb) if len(na) == len(nb) else na
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    nodes, roots = np.concatenate([a, b]), np.concatenate([la, lb])
    keep = nodes != roots
    return nodes[keep], roots[keep]


def near_links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Links (a, b) that connect all fingerprints ``fp`` within ``radius`` bits, transitively.

    ``distinct`` holds every fingerprint once. The table of tile sizes has at
    most 17^4 rows, so it may be broadcast.
    """
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    cell = quarter[0] + QUARTER * quarter[1] + QUARTER**2 * quarter[2] + QUARTER**3 * quarter[3]
    placed = cut_lineage(distinct.select("fp", cell.cast("int").alias("cell")))
    sizes = cut_lineage(placed.groupBy("cell").agg(F.ceil(F.count("*") / TILE_ROWS).alias("chunks")))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tiles = placed.join(F.broadcast(sizes), "cell").groupBy("cell", chunk.alias("chunk")).agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    tiles = cut_lineage(tiles)
    # half of all offsets with a sum of differences within the radius; the other half is the same pairs seen from the other tile
    span = range(-radius, radius + 1)
    offsets = [o for o in product(span, repeat=4) if sum(map(abs, o)) <= radius and o >= (0, 0, 0, 0)]
    digits = [F.pmod(F.floor(F.col("cell") / QUARTER**i), F.lit(QUARTER)) for i in range(4)]
    every = F.array(*[F.array(*map(F.lit, o)) for o in offsets])
    there = F.transform(
        F.filter(every, lambda o: _within(digits, o)),
        lambda o: F.col("cell") + o[0] + QUARTER * o[1] + QUARTER**2 * o[2] + QUARTER**3 * o[3],
    )
    asked = tiles.select("cell", "chunk", "fps", F.explode(there).alias("to")).join(
        F.broadcast(sizes.select(F.col("cell").alias("to"))), "to", "left_semi"
    )
    other = tiles.select(F.col("cell").alias("to"), F.col("chunk").alias("to_chunk"), F.col("fps").alias("to_fps"))
    pairs = asked.join(other, "to").where((F.col("to") != F.col("cell")) | (F.col("chunk") <= F.col("to_chunk")))
    pairs = pairs.select("fps", "to_fps", ((F.col("to") == F.col("cell")) & (F.col("chunk") == F.col("to_chunk"))).alias("same"))

    @giving_back
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, same = batch.column(0), batch.column(1), batch.column(2)
            lv, rv = left.values.to_numpy(), right.values.to_numpy()
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            got = [
                _forest(lv[lo[i]:lo[i + 1]], rv[ro[i]:ro[i + 1]], radius, same[i].as_py())
                for i in range(len(batch))
            ]
            a = np.concatenate([g[0] for g in got]) if got else np.zeros(0, np.int64)
            b = np.concatenate([g[1] for g in got]) if got else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return pairs.mapInArrow(compared, "a long, b long")


def _within(digits, offset):
    ok = F.lit(True)
    for i, d in enumerate(digits):
        ok = ok & (d + offset[i] >= 0) & (d + offset[i] < QUARTER)
    return ok


def _classes(marked: DataFrame, max_distance: int) -> DataFrame:
    """Frozen rows ``(fp, head, of)``: every fingerprint, its smallest id, and a name of its group."""
    classes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("head")))
    joined = cut_lineage(components(near_links(classes.select("fp"), max_distance)))
    groups = classes.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "head", F.coalesce("component", "fp").alias("of"))
    return cut_lineage(groups)


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3
) -> DataFrame:
    """Rows ``(doc_id, fingerprint, component_id)``, one per row of ``docs``.

    Fingerprints within ``max_distance`` bits are linked, transitively; the
    component is the smallest non-null id reached, null if there is none. Texts
    without words have fingerprint zero and are linked like any other. Equal
    fingerprints are one class, so copies are never paired with each other.
    Further columns are ignored; an empty table gives no rows.
    """
    marked = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    groups = _classes(marked, max_distance)
    first = groups.groupBy("of").agg(F.min("head").alias("component_id")).select(F.col("of").alias("id"), "component_id")
    named = cut_lineage(groups.join(cut_lineage(first), F.col("of") == F.col("id")).select(F.col("fp").alias("class"), "component_id"))
    return marked.join(named, F.col("fp") == F.col("class")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """One row of each group of ``docs``, whole: that of the smallest id.

    Rows that share an id are told apart by their texts, so none stands for
    another: of equal ids the smallest text hash stays, then the smallest hash
    of the row. Rows without an id come last, so one stays only where its whole
    group has none. Columns and their order are those of ``docs``.
    """
    key, row, copy = (fresh(docs.columns, n) for n in ("__text_hash", "__row_hash", "__copy"))
    keyed = docs.withColumn(key, F.xxhash64(F.col(text_col))).withColumn(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    marked = cut_lineage(fingerprints(keyed, id_col, text_col, shingle, F.col(key).alias("key"), F.col(row).alias("row")))
    groups = _classes(marked, max_distance).select(F.col("fp").alias("class"), "of")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "key", "row")
    heads = marked.join(groups, F.col("fp") == F.col("class")).groupBy("of").agg(F.min(rank).alias("h"))
    # the row's hash covers its id; joined and collapsed by the same keys, texts are exchanged once
    heads = heads.select(F.col("h.key").alias("__head_key"), F.col("h.row").alias("__head_row"))
    kept = keyed.join(heads, (F.col(key) == F.col("__head_key")) & (F.col(row) == F.col("__head_row")), "left_semi")
    return top_per_key(kept.withColumn(copy, F.lit(0)), [key, row], [copy]).select(*docs.columns)
