"""Suffix-array dedup: remove every byte covered by a long string that also starts earlier.

Every window of ``length`` bytes has an anchor: the 32-byte piece of least hash
in it, the leftmost on a tie. Equal windows have equal anchors at the same
place, so only anchors that occur twice matter. The stretches of bytes whose
windows have such an anchor meet by anchor, equal stretches become one, and the
different ones are suffix-sorted together (``lyndon_suffixes``): neighbours in
that order that share ``length`` bytes are repeats, and all but the earliest
are removed.

Work moves between tasks as packed blocks, one per hash bucket. Anchors that
occur very often (at most ``HOT`` of them, the most frequent) are dealt by the
content of each window instead, so that no bucket holds a third of all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.lyndon_suffixes import suffix_array
from leasegrid.session import cut_lineage

PIECE = 32
STEP = 16  # bytes that make one sign of the suffix-sorted text
HOT, HOT_LEAST = 10_000, 256
FLUSH_ANCHORS, FLUSH_BYTES = 1_500_000, 48 << 20
SORT_SIGNS = 40_000
PLACE_BITS = 24
CHUNK = 1 << 22
BUCKET_BYTES = 8 << 20  # bytes of text
FIRST = -(1 << 63)  # place of a null id in the order
_BASE = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every piece of ``length`` bytes, by joining pieces of doubled length."""
    with np.errstate(over="ignore"):
        part, power, size = data.astype(np.uint64) + np.uint64(1), np.array([_BASE], np.uint64), 1
        whole, done = None, 0
        n = len(data) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        todo = length
        while todo:
            if todo & 1:
                piece = part[done:done + n]
                whole = piece.copy() if whole is None else whole * power + piece
                done += size
            todo >>= 1
            if todo:
                part = part[:-size] * power + part[size:]
                power, size = power * power, size * 2
        return _mix(whole)


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of every anchor of one text, in order."""
    found = []
    span = length - PIECE + 1
    for a in range(0, len(data) - length + 1, CHUNK):
        part = data[a:a + CHUNK + length - 1]
        h = rolling(part, PIECE)
        low = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
        n, size = len(part) - length + 1, 1
        while size * 2 <= span:
            low, size = np.minimum(low[:-size], low[size:]), size * 2
        low = np.minimum(low[:n], low[span - size:span - size + n])
        at = (low & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.concatenate([first[1:], [n]]) - 1
        found.append((h[at[first]], at[first] + a, first + a, last + a))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _pack(small: bool = False, **columns) -> bytes:
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd" if small else None)
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(blocks: list[bytes]) -> pa.Table | None:
    tables = [pa.ipc.open_stream(b).read_all() for b in blocks]
    return pa.concat_tables(tables).combine_chunks() if tables else None


def _rows(made: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([m[0] for m in made], pa.int32()), pa.array([m[1] for m in made], pa.int32()), pa.array([m[2] for m in made], pa.binary())],
        ["bucket", "kind", "data"],
    )


BLOCKS = "bucket int, kind int, data binary"


def _buckets(values: np.ndarray, n: int) -> np.ndarray:
    return (_mix(values.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def _dealt(kind: int, keys: np.ndarray, n: int, columns: dict[str, np.ndarray | pa.Array]) -> list[tuple[int, int, bytes]]:
    """Packed blocks of rows, one per bucket of their key."""
    if not len(keys):
        return []
    bucket = _buckets(keys, n)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(n + 1))
    held = {k: v[order] if isinstance(v, np.ndarray) else v.take(pa.array(order)) for k, v in columns.items()}
    return [
        (b, kind, _pack(kind == CONTEXTS, **{k: v[ends[b]:ends[b + 1]] for k, v in held.items()}))
        for b in range(n) if ends[b] < ends[b + 1]
    ]


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return starts, np.diff(np.concatenate([starts, [len(sorted_keys)]]))


PLACES, ANCHORS, COUNTS, CONTEXTS, SPANS = range(5)


def _seen_anchors(parts: list[tuple], n: int) -> Iterator[pa.RecordBatch]:
    """Blocks of one flush: an anchor seen once goes to its bucket; of one seen more often one copy and all places go."""
    h = np.concatenate([p[0] for p in parts])
    place = np.concatenate([p[1] for p in parts]).astype(np.uint32)
    doc = np.repeat(np.array([p[2] for p in parts], np.int64), [len(p[0]) for p in parts])
    order = np.argsort(h, kind="stable")
    starts, sizes = _runs(h[order])
    one = order[starts]
    made = _dealt(ANCHORS, h[one], n, {"h": h[one], "n": sizes.astype(np.uint32), "doc": doc[one], "place": place[one]})
    many = order[np.repeat(sizes > 1, sizes)]
    made += _dealt(PLACES, doc[many], n, {"doc": doc[many], "place": place[many]})
    yield _rows(made)


def _repeated(blocks: dict[int, list[bytes]], n: int) -> list[tuple[int, int, bytes]]:
    """Of the anchors of one bucket: the places of those that occur twice, and the counts of frequent ones."""
    table = _unpack(blocks.get(ANCHORS, []))
    if table is None:
        return []
    h, count, doc, place = (table[c].to_numpy() for c in ("h", "n", "doc", "place"))
    order = np.lexsort((place, doc, h))
    same = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1]) & (place[order][1:] == place[order][:-1])
    order = order[np.concatenate([[True], ~same])]  # equal texts are one
    starts, sizes = _runs(h[order])
    totals = np.add.reduceat(count[order].astype(np.int64), starts)
    # places of those repeated within a flush went out with it
    out = order[np.repeat(sizes > 1, sizes)]
    out = out[count[out] == 1]
    made = _dealt(PLACES, doc[out], n, {"doc": doc[out], "place": place[out]})
    hot = totals >= HOT_LEAST
    if hot.any():
        made.append((0, COUNTS, _pack(h=h[order][starts][hot], n=totals[hot])))
    return made


class _Stretches:
    """Stretches of one flush: equal ones are one, the later ones are known repeats."""

    def __init__(self, n: int) -> None:
        self.n = n
        self.first: dict[tuple[int, bytes], tuple[int, int, int, int]] = {}
        self.spans: list[tuple[int, int, int, int]] = []
        self.bytes = 0

    def add(self, key: int, body: bytes, at: tuple[int, int, int], anchor: int) -> None:
        held = self.first.get((key, body))
        if held is None:
            self.first[key, body] = (*at, anchor)
            self.bytes += len(body) + 120
            return
        if at == held[:3]:  # a repeated row
            return
        later = at
        if at < held[:3]:
            self.first[key, body], later = (*at, anchor), held[:3]
        self.spans.append((later[0], later[1], later[2], later[2] + len(body)))
        self.bytes += 40

    def blocks(self) -> list[tuple[int, int, bytes]]:
        made = _spans(self.spans, self.n)
        if self.first:
            keys = np.array([k for k, _ in self.first], np.uint64)
            at = np.array(list(self.first.values()), np.int64)
            made += _dealt(CONTEXTS, keys, self.n, {
                "key": keys, "id": at[:, 0], "doc": at[:, 1], "start": at[:, 2], "anchor": at[:, 3],
                "body": pa.array([b for _, b in self.first], pa.binary()),
            })
        return made


def _spans(spans: list[tuple[int, int, int, int]] | np.ndarray, n: int) -> list[tuple[int, int, bytes]]:
    got = np.array(spans, np.int64).reshape(-1, 4)
    return _dealt(SPANS, got[:, 1], n, {"id": got[:, 0], "doc": got[:, 1], "start": got[:, 2].astype(np.uint32), "end": got[:, 3].astype(np.uint32)})


def repeats_of(stretches: list[tuple[tuple[int, int, int], int, bytes]], length: int) -> np.ndarray:
    """Spans (id, doc, start, end) of the windows that also start earlier, among different stretches.

    A stretch is (place, offset of its anchor, bytes). Every stretch is cut into
    signs of ``STEP`` bytes counted from its anchor, all are suffix-sorted as
    one text, and a window is a suffix of at least ``length - t`` equal bytes
    with t < STEP equal bytes before it.
    """
    # signs: ranks of STEP-byte pieces in byte order, 0 between stretches
    lead = [a % STEP for _, a, _ in stretches]
    signs = [max(0, -(-(len(b) - s) // STEP)) for (_, _, b), s in zip(stretches, lead)]
    body = np.zeros((sum(signs), STEP), np.uint8)
    flat, at = body.reshape(-1), 0
    for (_, _, b), s, k in zip(stretches, lead, signs):
        flat[at * STEP:at * STEP + len(b) - s] = np.frombuffer(b, np.uint8, offset=s)
        at += k
    halves = body.view(">u8").astype(np.uint64)
    _, high = np.unique(halves[:, 0], return_inverse=True)
    _, low = np.unique(halves[:, 1], return_inverse=True)
    _, rank = np.unique(high.astype(np.int64) * (len(body) + 1) + low, return_inverse=True)
    owner = np.repeat(np.arange(len(stretches)), signs)
    first = np.concatenate([[0], np.cumsum(signs)[:-1]])
    text = np.zeros(len(body) + len(stretches), np.int64)
    text[np.arange(len(body)) + owner] = rank + 1
    order = suffix_array(text)
    # back to (stretch, byte offset) of each sign
    sign_of = np.full(len(text), -1)
    sign_of[np.arange(len(body)) + owner] = np.arange(len(body))
    order = sign_of[order]
    order = order[order >= 0]
    who = owner[order]
    sizes = np.array([len(b) for _, _, b in stretches])
    offset = np.array(lead)[who] + (order - first[who]) * STEP
    useful = sizes[who] - offset >= length - STEP + 1
    who, offset = who[useful], offset[useful]
    if not len(who):
        return np.zeros((0, 4), np.int64)
    # bytes around each place, from one padded text
    base = np.concatenate([[0], np.cumsum(sizes + length + STEP)[:-1]]) + STEP
    wide = np.zeros(int(sizes.sum() + len(sizes) * (length + STEP) + STEP), np.uint8)
    for (_, _, b), x in zip(stretches, base.tolist()):
        wide[x:x + len(b)] = np.frombuffer(b, np.uint8)
    here = base[who] + offset
    shared = np.zeros(len(here), np.int64)  # bytes in common with the place before, up to length
    for i in range(1, len(here), 65_536):
        x, y = here[i - 1:i + 65_535], here[i:i + 65_536]
        x = x[:len(y)]
        differ = wide[x[:, None] + np.arange(length)] != wide[y[:, None] + np.arange(length)]
        shared[i:i + len(y)] = np.where(differ.any(1), differ.argmax(1), length)
    before = wide[here[:, None] - np.arange(STEP, 0, -1)].copy().view(">u8").astype(np.uint64)
    place = np.array([p for p, _, _ in stretches], np.int64)
    found_who, found_at = [], []
    for t in range(STEP):
        need = length - t
        group = np.cumsum(shared < need)
        ok = np.flatnonzero((offset >= t) & (sizes[who] - offset >= need))
        g = group[ok]
        _, back, many = np.unique(g, return_inverse=True, return_counts=True)
        ok = ok[many[back] > 1]
        if not len(ok):
            continue
        bits = np.uint64(8 * min(t, 8))
        near = before[ok, 1] & ((np.uint64(1) << bits) - np.uint64(1) if t < 8 else ~np.uint64(0))
        far = before[ok, 0] & ((np.uint64(1) << np.uint64(8 * (t - 8))) - np.uint64(1)) if t > 8 else np.zeros(len(ok), np.uint64)
        # earliest first: by document, then place of the window
        w = offset[ok] - t
        rows = np.lexsort((place[who[ok], 2] + w, place[who[ok], 1], place[who[ok], 0], near, far, group[ok]))
        same = np.zeros(len(ok), bool)
        a, b = rows[1:], rows[:-1]
        same[1:] = (group[ok][a] == group[ok][b]) & (near[a] == near[b]) & (far[a] == far[b])
        # of every class of equal windows all but the first
        hit = rows[same]
        found_who.append(who[ok][hit])
        found_at.append(w[hit])
    if not found_who:
        return np.zeros((0, 4), np.int64)
    fw, fa = np.concatenate(found_who), np.concatenate(found_at)
    o = np.lexsort((fa, fw))
    fw, fa = fw[o], fa[o]
    new = np.flatnonzero(np.concatenate([[True], (fw[1:] != fw[:-1]) | (fa[1:] != fa[:-1] + 1)]))
    end = np.concatenate([new[1:], [len(fw)]]) - 1
    who, start, stop = fw[new], fa[new], fa[end] + length
    return np.stack([place[who, 0], place[who, 1], place[who, 2] + start, place[who, 2] + stop], 1)


def _met(blocks: dict[int, list[bytes]], length: int, n: int) -> list[tuple[int, int, bytes]]:
    """Repeats among the stretches of one bucket."""
    table = _unpack(blocks.get(CONTEXTS, []))
    if table is None:
        return []
    keys, body = table["key"].to_numpy(), table["body"]
    ids, docs, starts, at = (table[c].to_numpy().tolist() for c in ("id", "doc", "start", "anchor"))
    body = body.combine_chunks() if isinstance(body, pa.ChunkedArray) else body
    made = _Stretches(n)
    order = np.argsort(keys, kind="stable")
    begin, sizes = _runs(keys[order])
    todo, signs, found = [], 0, []
    for b, size in zip(begin.tolist(), sizes.tolist()):
        if size == 1:
            continue
        made.first.clear()
        for i in order[b:b + size].tolist():
            made.add(0, body[i].as_py(), (ids[i], docs[i], starts[i]), at[i])
        if len(made.first) > 1:
            todo += [(v[:3], v[3], k[1]) for k, v in made.first.items()]
            signs += sum(len(k[1]) for k in made.first) // STEP
        if signs >= SORT_SIGNS:
            found.append(repeats_of(todo, length))
            todo, signs = [], 0
    if todo:
        found.append(repeats_of(todo, length))
    return _spans(np.concatenate([np.array(made.spans, np.int64).reshape(-1, 4), *found]), n)


def _regrouped(blocks: DataFrame, n: int, work, passed: tuple[int, ...]) -> DataFrame:
    """Run ``work`` on the blocks of every bucket; blocks of the kinds ``passed`` go through as one."""

    def of_bucket(table: pa.Table) -> pa.Table:
        kinds, data = table["kind"].to_pylist(), table["data"].to_pylist()
        by: dict[int, list[bytes]] = {}
        for k, d in zip(kinds, data):
            by.setdefault(k, []).append(d)
        bucket = table["bucket"][0].as_py()
        held = {k: _unpack(by[k]).to_batches()[0] for k in passed if k in by}
        made = [(bucket, k, _pack(**dict(zip(t.schema.names, t.columns)))) for k, t in held.items()]
        return pa.Table.from_batches([_rows(made + work(by))])

    return blocks.groupBy("bucket").applyInArrow(of_bucket, BLOCKS)


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered bytes; runs that touch are one."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    last = np.concatenate([new[1:], [len(start)]]) - 1
    return start[new], end[last]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes left).

    Texts are UTF-8 bytes, null counts as empty; matches never cross documents.
    A byte goes if a ``length``-byte string that covers it also starts earlier:
    in a smaller id, or earlier in the same text. A null id is the smallest. Rows
    of one id with different texts are documents ordered by a hash of the text;
    equal rows of one id are one document and get the same result. Further
    columns are ignored; an empty table gives no rows.
    """
    if length < PIECE + STEP:
        raise ValueError(f"length must be at least {PIECE + STEP}")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("md", F.md5("text"))
    doc = F.xxhash64("md")
    # equal texts are one document, that of the smallest id; the others are removed whole
    firsts = cut_lineage(rows.groupBy("md").agg(F.min("id").alias("first_id"), F.max(F.octet_length("text")).alias("size")).withColumn("doc", doc))
    # buckets of a useful size, as many as there are shuffle partitions at most: a task writes a block for each
    total = firsts.agg(F.sum("size")).first()[0] or 0
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES)))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, known = [], 0, set()
        for batch in batches:
            texts = batch.column(1)
            for i, doc in enumerate(batch.column(0).to_pylist()):
                if doc in known:
                    continue
                known.add(doc)
                h, place, _, _ = anchors(np.frombuffer(texts[i].as_py().encode("utf-8", "surrogatepass"), np.uint8), length)
                parts.append((h, place, doc))
                held += len(h)
                if held >= FLUSH_ANCHORS:
                    yield from _seen_anchors(parts, n)
                    parts, held, known = [], 0, set()
        if parts:
            yield from _seen_anchors(parts, n)

    first = rows.where(F.octet_length("text") >= length).select(doc.alias("doc"), "text").mapInArrow(seen, BLOCKS)
    places = cut_lineage(_regrouped(first, n, lambda by: _repeated(by, n), (PLACES,)))
    frequent: dict[int, int] = {}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                t = _unpack([block])
                yield pa.RecordBatch.from_arrays([t["h"].to_numpy().view(np.int64), t["n"].to_numpy()], ["h", "n"])

    listed = places.where(F.col("kind") == COUNTS).select("data").mapInArrow(counts, "h long, n long")
    for r in listed.orderBy(F.desc("n"), "h").limit(HOT).collect():  # at most HOT numbers
        frequent[r.h] = r.n
    hot = np.sort(np.array(list(frequent), np.int64).view(np.uint64))

    def per_doc(table: pa.Table) -> pa.Table:
        t = _unpack(table["data"].to_pylist())
        doc, place = t["doc"].to_numpy(), t["place"].to_numpy()
        order = np.argsort(doc, kind="stable")
        starts, sizes = _runs(doc[order])
        place = place[order]
        return pa.table({
            "of": pa.array(doc[order][starts], pa.int64()),
            "places": pa.array([place[a:a + s].tobytes() for a, s in zip(starts, sizes)], pa.binary()),
        })

    marked = places.where(F.col("kind") == PLACES).groupBy("bucket").applyInArrow(per_doc, "of long, places binary")

    def stretched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Stretches(n)
        for batch in batches:
            ids, docs_, texts, lists = (batch.column(i) for i in range(4))
            for i in range(len(batch)):
                own, doc = ids[i].as_py(), docs_[i].as_py()
                body = texts[i].as_py().encode("utf-8", "surrogatepass")
                data = np.frombuffer(body, np.uint8)
                h, place, lo, hi = anchors(data, length)
                asked = np.isin(place, np.frombuffer(lists[i].as_py(), np.uint32))
                often = np.isin(h, hot) & asked
                for k in np.flatnonzero(asked & ~often).tolist():
                    a = int(lo[k])
                    held.add(int(h[k]), body[a:int(hi[k]) + length], (own, doc, a), int(place[k]) - a)
                if often.any():  # by window
                    keys = rolling(data, length)
                    for k in np.flatnonzero(often).tolist():
                        for a in range(int(lo[k]), int(hi[k]) + 1):
                            held.add(int(keys[a]), body[a:a + length], (own, doc, a), int(place[k]) - a)
                if held.bytes >= FLUSH_BYTES:
                    yield _rows(held.blocks())
                    held = _Stretches(n)
        if held.first or held.spans:
            yield _rows(held.blocks())

    # the texts are shuffled once: both joins below exchange the same rows by the same key
    asked = firsts.join(marked, F.col("doc") == F.col("of")).select(F.col("md").alias("of_md"), "first_id", "doc", "places")
    met = rows.join(asked, (F.col("md") == F.col("of_md")) & F.col("id").between(F.col("first_id"), F.col("first_id")))
    met = met.select("id", "doc", "text", "places").mapInArrow(stretched, BLOCKS)
    spans = _regrouped(met, n, lambda by: _met(by, length, n), (SPANS,))

    def unioned(table: pa.Table) -> pa.Table:
        t = _unpack(table["data"].to_pylist())
        own, doc, start, end = (t[c].to_numpy() for c in ("id", "doc", "start", "end"))
        order = np.lexsort((start, own, doc))
        own, doc, start, end = own[order], doc[order], start[order], end[order]
        first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (own[1:] != own[:-1])]))
        stop = np.concatenate([first[1:], [len(doc)]])
        cut = [np.stack(_merged(start[a:b], end[a:b]), 1).astype("<i8").tobytes() for a, b in zip(first, stop)]
        return pa.table({"of_id": pa.array(own[first], pa.int64()), "of": pa.array(doc[first], pa.int64()), "spans": pa.array(cut, pa.binary())})

    cuts = spans.groupBy("bucket").applyInArrow(unioned, "of_id long, of long, spans binary")
    cuts = firsts.join(cuts, (F.col("doc") == F.col("of")) & (F.col("first_id") == F.col("of_id")), "left")
    final = rows.join(cuts.select(F.col("md").alias("of_md"), "first_id", "spans"), F.col("md") == F.col("of_md"))
    final = final.select("id", "text", "spans", (F.col("id") == F.col("first_id")).alias("first"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, lists, first = (batch.column(i) for i in range(4))
            out = []
            for i in range(len(batch)):
                body, cut = texts[i].as_py().encode("utf-8", "surrogatepass"), lists[i].as_py()
                if not first[i].as_py() and len(body) >= length:
                    runs = np.array([[0, len(body)]])
                else:
                    runs = np.frombuffer(cut or b"", "<i8").reshape(-1, 2)
                left, at = [], 0
                for a, b in runs.tolist():
                    left.append(body[at:a])
                    at = b
                left = b"".join([*left, body[at:]])
                own = ids[i].as_py()
                out.append((None if own == FIRST else own, len(body), len(body) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names)

    return final.mapInArrow(kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
