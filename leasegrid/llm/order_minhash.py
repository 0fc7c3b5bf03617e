"""Document fingerprints by Order MinHash.

The k-mers of a text (runs of k code points) are numbered by occurrence, so a
k-mer that repeats counts once per place. Every numbered k-mer has a 40-bit
rank; the i-th hash function is its distance, modulo 2^40, from a fixed point p_i.
For each function the l k-mers of least value are selected, put back into text
order, and their k-mers hashed as a tuple to one entry of the signature. Two
texts agree in an entry when they share the selected k-mers in the same order,
so moves and edits lower the likeness where a plain set of k-mers sees none.

All functions read one sorted array: the least values of function i are the
ranks that follow p_i on the ring of 40-bit numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leasegrid.session import shared_path

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: A rank is the upper 40 bits of a hash; the lower 24 leave room for a place in the text.
_PLACE, _PLACES, _RANKS = np.uint64(24), np.uint64(2**24 - 1), np.uint64(2**40 - 1)
#: Odd multiplier of the rolling hash of code points.
_BASE = 0xD6E8FEB86659FD93


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def points_of(text: str) -> np.ndarray:
    """Code points."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _in_order(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """Ranks in ascending order, equal ones by place, and the places of chosen positions of that order."""
    if len(places) and int(places.max()) < 2**24:  # rank and place share one number, so one plain sort does
        key = np.sort((hashes & ~_PLACES) | places)
        return key >> _PLACE, lambda at: key[at] & _PLACES
    order = np.lexsort((places, hashes >> _PLACE))
    return hashes[order] >> _PLACE, lambda at: places[order[at]]


def _following(at: np.ndarray, n: int, most: int) -> np.ndarray:
    """The positions from each ``at`` on, at most ``most`` of ``n``, from the start again after the end."""
    return (at[:, None] + np.arange(min(most, n))) % n


@dataclass(frozen=True)
class OrderMinHash:
    """``entries`` tuples of ``chosen`` k-mers of ``k`` code points each."""

    k: int = 6
    entries: int = 64
    chosen: int = 2

    def ring(self) -> np.ndarray:
        """The fixed points of the hash functions."""
        return mix(np.arange(1, self.entries + 1, dtype=np.uint64) * _STEP) >> _PLACE

    def kmers(self, points: np.ndarray) -> np.ndarray:
        """Hash of every k-mer in text order; a text shorter than k is one k-mer, an empty text none."""
        k = min(self.k, len(points))
        if not k:
            return points
        out, span, power = points, 1, _BASE
        while span * 2 <= k:
            out = out[:-span] * np.uint64(power) + out[span:]
            span, power = span * 2, power * power % 2**64
        for i in range(span, k):
            out = out[:-1] * np.uint64(_BASE) + points[i:]
        return mix(out + np.uint64(k))

    def signature(self, kmers: np.ndarray, ring: np.ndarray) -> np.ndarray:
        """Entries of the text with these k-mers (32 bits each); zeros for a text without any."""
        n = len(kmers)
        if not n:
            return np.zeros(self.entries, "<u4")
        rank, place = _in_order(kmers, np.arange(n, dtype=np.uint64))
        first = np.empty(n, bool)
        first[0] = True
        np.not_equal(rank[1:], rank[:-1], out=first[1:])
        heads, again = np.flatnonzero(first), np.flatnonzero(~first)
        at = np.searchsorted(heads, np.searchsorted(rank, ring))
        pools = [(rank, place, heads[_following(at, len(heads), self.chosen)])]
        if len(again):
            # the j-th repeat has again[j] - j heads before it, the last of which begins its run
            run = heads[again - np.arange(len(again)) - 1]
            fresh = mix((rank[again] << _PLACE) + (again - run).astype(np.uint64) * _STEP)
            values, where = _in_order(fresh, place(again))
            pools.append((values, where, _following(np.searchsorted(values, ring), len(again), self.chosen)))
        gaps = [(values[near] - ring[:, None]) & _RANKS for values, _, near in pools]
        places = [where(near) for _, where, near in pools]
        take = min(self.chosen, n)
        least = np.argsort(np.concatenate(gaps, 1), axis=1, kind="stable")[:, :take]
        chosen = np.sort(np.take_along_axis(np.concatenate(places, 1), least, 1), axis=1).astype(np.int64)
        out = np.full(self.entries, take, np.uint64)
        for j in range(take):
            out = mix(out * _STEP + kmers[chosen[:, j]])
        return (out >> np.uint64(32)).astype("<u4")


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal entries of two signatures."""
    return float(np.mean(np.frombuffer(a, "<u4") == np.frombuffer(b, "<u4")))


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many of ``following`` (all, where it has fewer)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_DONE = "doc_id long, n_chars long, sha binary, own binary, other binary, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in _DONE.split(", ")]


def _finish(doc_id, text: str, own: bytes, following: str, after: bytes, make: OrderMinHash, ring: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = make.signature(make.kmers(points_of(changed)), ring).tobytes()
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).digest()
    return doc_id, len(text), sha, own, other, likeness(own, other), likeness(own, after)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 6, entries: int = 64, chosen: int = 2) -> DataFrame:
    """Fingerprint of every text and of its edited text, frozen as a table of the shared folder.

    One row per row of ``docs``: ``doc_id, n_chars, sha`` (of the edited text),
    ``own`` and ``other`` (signatures as bytes), ``near_edited, near_next``. The
    next document is the one that follows in descending id (equal ids by text
    hash, then text; null ids last); after the last comes the first, so a single
    document follows itself. A null text counts as empty, and an empty text has
    a signature of zeros. Further columns are ignored; an empty table gives no row.

    Texts are exchanged once, by range of the order, and each task walks its
    range with one document pending. The ends of ranges, one document each, are
    paired by a join on the range number.
    """
    make = OrderMinHash(k, entries, chosen)
    ring = make.ring()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    # kind 0: finished; 1: first of a range; 2: last of a range. The ends carry their texts.
    schema = f"kind int, range int, {_DONE}, text string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        here, pending = TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            texts = batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                text = texts[i].as_py()
                own = make.signature(make.kmers(points_of(text)), ring).tobytes()
                if pending is None:
                    out.append((1, here, doc_id, None, None, own, None, None, None, text))
                else:
                    out.append((0, here, *_finish(*pending, text, own, make, ring), None))
                pending = doc_id, text, own
            yield _batch(out)
        if pending is not None:
            yield _batch([(2, here, pending[0], None, None, pending[2], None, None, None, pending[1])])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [_finish(*r.values(), make, ring) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(_TYPES[2:9])], _NAMES)

    spark = docs.sparkSession
    path = shared_path(spark, "order-minhash")
    ranged.mapInArrow(walk, schema).write.parquet(path)
    walked = spark.read.schema(schema).parquet(path)
    # one narrow row per range: the range that follows, the first one after the last
    heads = walked.where("kind = 1").select(F.col("range").alias("r"))
    following = F.coalesce(F.lead("r").over(W.orderBy("r")), F.first("r").over(W.orderBy("r")))
    ranges = heads.select("r", following.alias("after"))
    tails = walked.where("kind = 2").select("range", "doc_id", "text", "own").join(ranges, F.col("range") == F.col("r"))
    begins = walked.where("kind = 1").select(F.col("range").alias("begin"), F.col("text").alias("following"), F.col("own").alias("after_own"))
    ends = tails.join(begins, F.col("after") == F.col("begin")).select("doc_id", "text", "own", "following", "after_own")
    return walked.where("kind = 0").select(*_NAMES).unionByName(ends.mapInArrow(close, _DONE))


_TYPES = [
    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.string(),
]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], ["kind", "range", *_NAMES, "text"])


def as_text(signatures: DataFrame) -> DataFrame:
    """Signatures and digests as lowercase hex: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    low = lambda c: F.lower(F.hex(c))
    return signatures.select(
        "doc_id", "n_chars", low("sha").alias("edited_sha256"), low("own").alias("fingerprint"), low("other").alias("edited_fingerprint"),
        "near_edited", "near_next")
