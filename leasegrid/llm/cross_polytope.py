"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations.

Unit vectors are rotated by three rounds of random signs and a fast Hadamard
transform; the hash is the axis, with sign, of the largest coordinate. Two such
hashes make a bucket code. A vector enters its best bucket and the next best
(multiprobe) in every table. Vectors that share a bucket are compared exactly
in double precision, tile by tile; a pair counts only where it first meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.common import components, side_key
from leasegrid.session import cut_lineage

TILE_ROWS = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows, orthonormal; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def bucket_codes(unit: np.ndarray, tables: int, probes: int, hashes: int = 2, seed: int = 11) -> np.ndarray:
    """Bucket codes (rows, tables, probes), best first.

    Alternatives of a code swap one hash for the runner-up axis, those with the
    smallest loss of coordinate first. -1 stands where there are no more.
    """
    rng = np.random.default_rng(seed)
    width = 1 << max(0, (unit.shape[1] - 1).bit_length())
    padded = np.zeros((len(unit), width))
    padded[:, :unit.shape[1]] = unit
    out = np.empty((len(unit), tables, probes), np.int64)
    rows = np.arange(len(unit))
    for t in range(tables):
        ranked = []
        for _ in range(hashes):
            x = padded
            for _ in range(3):
                x = hadamard(x * rng.choice([-1.0, 1.0], width))
            size = np.abs(x)
            order = np.argsort(-size, axis=1, kind="stable")[:, :probes + 1] if width > 1 else np.zeros((len(x), 1), int)
            axis = [2 * order[:, i] + (x[rows, order[:, i]] < 0) for i in range(order.shape[1])]
            loss = [size[rows, order[:, 0]] - size[rows, order[:, i]] for i in range(order.shape[1])]
            ranked.append((axis, loss))
        base = 2 * width
        best = sum(axis[0] * base**k for k, (axis, _) in enumerate(ranked))
        codes, losses = [best], [np.full(len(unit), -1.0)]
        for k, (axis, loss) in enumerate(ranked):
            for i in range(1, len(axis)):
                codes.append(best + (axis[i] - axis[0]) * base**k)
                losses.append(loss[i])
        while len(codes) < probes:
            codes.append(np.full(len(unit), -1))
            losses.append(np.full(len(unit), np.inf))
        pick = np.argsort(np.stack(losses, 1), axis=1, kind="stable")[:, :probes]
        out[:, t] = np.take_along_axis(np.stack(codes, 1), pick, 1)
    return out


def _tile(ids, vectors, codes, weights, table, code, left, right, threshold):
    """Rows (vec_id, links, root) of the pairs of one tile that meet first in this bucket."""
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    near = vectors[a] @ vectors[b].T >= threshold
    near &= ids[a][:, None] != ids[b][None, :]
    if left is right:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    if not len(i):
        return ids[:0], ids[:0], ids[:0]
    # drop pairs that share a bucket of an earlier table, or a smaller code of this one
    met = np.zeros(len(i), bool)
    for s in range(0, len(i), 65_536):
        ca, cb = codes[a[i[s:s + 65_536]]], codes[b[j[s:s + 65_536]]]
        same = (ca[:, :, :, None] == cb[:, :, None, :]) & (ca[:, :, :, None] >= 0)
        met[s:s + 65_536] = same[:, :table].any((1, 2, 3)) | (same[:, table] & (ca[:, table, :, None] < code)).any((1, 2))
    i, j = i[~met], j[~met]
    if not len(i):
        return ids[:0], ids[:0], ids[:0]
    va, vb = a[i], b[j]
    links = np.bincount(va, weights[vb], len(ids)) + np.bincount(vb, weights[va], len(ids))
    label = ids.copy()
    while True:
        low = np.minimum(label[va], label[vb])
        nxt = label.copy()
        np.minimum.at(nxt, va, low)
        np.minimum.at(nxt, vb, low)
        if (nxt == label).all():
            break
        label = nxt
    at = np.flatnonzero(links)
    return ids[at], links[at].astype(np.int64), label[at]


def link_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    tables: int = 8,
    probes: int = 2,
    seed: int = 11,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Links are pairs with cosine >= ``threshold`` that share a bucket; none below
    it is linked. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reached, ``kept`` tells that it is the
    row's own. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing; vectors of another length link among their
    like. Equal vectors are one class, never paired with each other. Rows that
    repeat an id are told apart by their vectors; a null id links with nothing.
    Further columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))
    # a class has a number of its own: one id may stand with several vectors
    classes = usable.groupBy("v", side_key("v")).agg(F.min("vec_id").alias("head"), F.count("*").alias("weight"))
    classes = cut_lineage(classes.select(F.monotonically_increasing_id().alias("id"), "weight", "v", "head"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            sizes = np.diff(ends)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                m = flat[ends[at][:, None] + np.arange(d)[None, :]].astype(np.float64)
                m = m / np.abs(m).max(1, keepdims=True)
                m /= np.sqrt((m * m).sum(1, keepdims=True))
                codes = bucket_codes(m, tables, probes, seed=seed)
                n = len(at)
                ids = batch.column(0).to_numpy()[at]
                weight = batch.column(1).to_numpy()[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(weight, pa.int64()),
                    pa.array([x.tobytes() for x in m], pa.binary()), pa.array([x.tobytes() for x in codes], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, n * tables * probes + 1, tables * probes, dtype=np.int32), pa.array(codes.reshape(-1), pa.int64())),
                ], ["id", "weight", "unit", "codes", "list"])

    placed = cut_lineage(classes.select("id", "weight", "v").mapInArrow(coded, "id long, weight long, unit binary, codes binary, list array<long>"))
    entered = placed.select("id", "weight", "unit", "codes", F.length("unit").alias("width"), F.posexplode("list").alias("slot", "code")).where("code >= 0")
    entered = entered.withColumn("tab", F.floor(F.col("slot") / probes).cast("int"))
    counts = entered.groupBy("width", "tab", "code").agg(F.count("*").alias("n")).where("n > 1")
    counts = counts.withColumn("chunks", F.ceil(F.col("n") / TILE_ROWS).cast("int"))
    counts = cut_lineage(counts.select(F.col("width").alias("w2"), F.col("tab").alias("t2"), F.col("code").alias("c2"), "chunks"))
    full = entered.join(counts, (F.col("width") == F.col("w2")) & (F.col("tab") == F.col("t2")) & (F.col("code") == F.col("c2")))
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    full = full.withColumn("chunk", chunk)
    # every chunk meets itself and each other chunk of its bucket once
    mates = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda o: F.struct(
        F.least(o, F.col("chunk")).alias("lo"), F.greatest(o, F.col("chunk")).alias("hi")))
    dealt = full.select("id", "weight", "unit", "codes", "width", "tab", "code", "chunk", F.explode(mates).alias("m")).select(
        "id", "weight", "unit", "codes", "width", "tab", "code", "chunk", "m.lo", "m.hi")

    def compare(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        if len(ids) < 2:
            return pa.table({"vec_id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        unit = np.frombuffer(b"".join(table["unit"].to_pylist()), np.float64).reshape(len(ids), -1)[order]
        codes = np.frombuffer(b"".join(table["codes"].to_pylist()), np.int64).reshape(len(ids), tables, probes)[order]
        weight, chunk = table["weight"].to_numpy()[order].astype(np.float64), table["chunk"].to_numpy()[order]
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        left = chunk == lo
        right = left if lo == hi else chunk == hi
        v, n, r = _tile(ids, unit, codes, weight, table["tab"][0].as_py(), table["code"][0].as_py(), left, right, threshold)
        return pa.table({"vec_id": pa.array(v, pa.int64()), "links": pa.array(n, pa.int64()), "root": pa.array(r, pa.int64())})

    found = cut_lineage(dealt.groupBy("width", "tab", "code", "lo", "hi").applyInArrow(compare, "vec_id long, links long, root long"))
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links")).withColumnRenamed("vec_id", "lid")
    groups = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    named = classes.join(links, F.col("id") == F.col("lid"), "left").join(groups, F.col("id") == F.col("node"), "left")
    named = cut_lineage(named.select(
        F.col("v").alias("hv"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "head", F.coalesce("component", "id").alias("of")))
    first = named.groupBy(F.col("of").alias("group"), side_key("of")).agg(F.min("head").alias("first")).drop("side")
    heads = cut_lineage(named.join(first, F.col("of") == F.col("group")).select("hv", "n_links", F.col("first").alias("of")))
    linked = usable.join(heads, F.col("v") == F.col("hv")).select("vec_id", "n_links", F.col("of").alias("component_id"))
    alone = rows.where(~F.coalesce(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0), F.lit(False)))
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
