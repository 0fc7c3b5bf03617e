"""Token-id files: blocks of ids transposed into bit or byte planes, each plane compressed with zstandard.

File layout, all integers little-endian:

    b"LGPL" version:u8 planes:u8 reserved:u16
    planes of block 0, planes of block 1, ...
    index: JSON, zstandard-compressed
    index_offset:u64 index_bytes:u64 b"LGPL"

The index lists every block's offset, number of ids and bytes per plane, and
every document's id and number of ids. A document may cross blocks.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leasegrid.llm.common import giving_back
from leasegrid.session import cut_lineage, shared_path

MAGIC = b"LGPL"
BLOCK_IDS = 65_536
#: Words and pieces whose ids are remembered per task, and their greatest length.
CACHE_WORDS, CACHE_LETTERS = 500_000, 64
#: New words of one call of the tokenizer, and bytes of the texts that are encoded together.
JOINED, GROUP = 512, 2 * 2**20


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of one block of unsigned 32-bit ids: 32 bit planes or 4 byte planes, lowest first; a plane of zeros is empty."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    rows = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little") if bits else raw.T
    return [r.tobytes() if r.any() else b"" for r in rows]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """The ids of a block again."""
    width = -(-n // 8) if bits else n
    rows = np.zeros((len(planes), width), np.uint8)
    for i, p in enumerate(planes):
        if p:
            rows[i] = np.frombuffer(p, np.uint8)
    if bits:
        flat = np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little")
    else:
        flat = rows.T
    return np.ascontiguousarray(flat).view("<u4").reshape(-1)


#: Latin letters whose lower case is one of them, and which normalisation leaves alone.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
#: What the splitter of the word tokenizer makes of lower-case words of ASCII and those letters; lines keep the words apart.
_PIECES = re.compile(f"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^a-z{_LATIN}0-9\n]+")

#: Words that are one piece.
_ONE_PIECE = f"^[A-Za-z{_LATIN}]+$"


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: b for b in prints} | {b: 256 + i for i, b in enumerate(rest)}


#: Line breaks stay, as they keep pieces apart.
_BYTES = {b: c for b, c in _byte_letters().items() if b != ord("\n")}


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of runs: ``sizes[i]`` numbers from ``starts[i]`` on, one run after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def _lines(words: pa.Array, some: np.ndarray) -> str:
    """The chosen words in lower case, a line each."""
    lines = words.filter(pa.array(some))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")[0].as_py().lower()


class Remembered:
    """Ids of the strings met so far, end to end.

    A line break has place 0 and no ids. Strings of more than ``CACHE_LETTERS``
    are held until the next call only, and beyond ``CACHE_WORDS`` all are dropped.
    """

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.places, self.long = {"\n": 0}, []
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(2, np.int64)

    def _forget(self) -> None:
        if len(self.places) - len(self.long) > CACHE_WORDS:
            self._clear()
        elif self.long:
            for w in self.long:
                del self.places[w]
            self.ends = self.ends[:len(self.places) + 1]
            self.ids, self.long = self.ids[:self.ends[-1]], []

    def look_up(self, items: list[str], learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Place of each item; ``learn`` gives the ids of new ones end to end and how many each has."""
        self._forget()
        new = list(set(items).difference(self.places))
        if new:
            self.long = [w for w in new if len(w) > CACHE_LETTERS]
            if self.long:
                new = [w for w in new if len(w) <= CACHE_LETTERS] + self.long
            ids, sizes = learn(new)
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
            self.ids = np.concatenate([self.ids, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        return np.fromiter(map(self.places.__getitem__, items), np.int64, len(items))

    def runs(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the strings at ``places`` end to end, and how many each has."""
        starts = self.ends[places]
        sizes = self.ends[places + 1] - starts
        return self.ids[spread(starts, sizes)], sizes


class WordEncoder:
    """Ids of texts, encoding each distinct piece of a word once.

    ``cuts_at_blanks`` is for tokenizers whose normaliser and splitter never
    join text across ASCII blanks, so that the ids of a text are the ids of its
    words in order; others get whole texts. The distinct words of a group of
    texts are found by dictionary encoding. With ``latin_pieces`` a word of
    ASCII and Latin letters is put together from the pieces that the splitter
    cuts (runs of letters, single digits, runs of signs), and a piece not met
    before goes straight to the library's merge model. Other new words go to the
    whole tokenizer, many in one call that is cut apart by offsets.
    """

    def __init__(self, path: str, cuts_at_blanks: bool, latin_pieces: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cuts, self.latin = Tokenizer.from_file(path), cuts_at_blanks, latin_pieces
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([f"[^\\x00-\\x7f{_LATIN}]", *special])
        self.pieces, self.words = Remembered(), Remembered()

    def _encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def _learn_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, ids, sizes = self.tokenizer.model.tokenize, [], []
        letters = "\n".join(pieces).encode().decode("latin-1").translate(_BYTES).split("\n")
        for a in range(0, len(letters), JOINED):
            found = [tokenize(p) for p in letters[a:a + JOINED]]
            ids += [t.id for tokens in found for t in tokens]
            sizes += map(len, found)
        return np.array(ids, "<u4"), np.array(sizes, np.int64)

    def _learn_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for a in range(0, len(words), JOINED):
            some = words[a:a + JOINED]
            found = self._encode(" ".join(some))
            ids.append(np.array(found.ids, "<u4"))
            starts = np.cumsum([0] + [len(t) + 1 for t in some])
            sizes.append(np.diff(np.searchsorted(np.array([o[0] for o in found.offsets], np.int64), starts)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words end to end, with the start and number of each."""
        if self.latin:
            plain = ~pc.match_substring_regex(words, self.odd).to_numpy(zero_copy_only=False).astype(bool)
        else:
            plain = np.zeros(len(words), bool)
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        flat = np.zeros(0, "<u4")
        if plain.any():
            single = plain & pc.match_substring_regex(words, _ONE_PIECE).to_numpy(zero_copy_only=False)
            ones, several = _lines(words, single), _lines(words, plain & ~single)
            # words of several pieces come after the others, a line break between them
            items = ones.split("\n") if ones else []
            places = self.pieces.look_up([*items, *_PIECES.findall(several)], self._learn_pieces)
            flat, n = self.pieces.runs(places)
            k = len(items)
            sizes[single] = n[:k]
            line = np.cumsum(places[k:] == 0)
            sizes[plain & ~single] = np.bincount(line, n[k:], int((plain & ~single).sum())).astype(np.int64)
            for part, before in ((single, 0), (plain & ~single, int(n[:k].sum()))):
                starts[part] = before + np.cumsum(sizes[part]) - sizes[part]
        if not plain.all():
            ids, n = self.words.runs(self.words.look_up(words.filter(pa.array(~plain)).to_pylist(), self._learn_words))
            starts[~plain], sizes[~plain] = len(flat) + np.cumsum(n) - n, n
            flat = np.concatenate([flat, ids])
        return flat, starts, sizes

    def many(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a group."""
        if not self.cuts:
            return [np.array(self._encode(t.as_py()).ids, "<u4") for t in texts]
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        flat, starts, sizes = self._ids_of(coded.dictionary)
        index = coded.indices.to_numpy()
        ids = flat[spread(starts[index], sizes[index])]
        upto = np.concatenate([[0], np.cumsum(sizes[index])])
        ends = upto[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


def in_groups(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Consecutive texts in groups of about ``most`` bytes; a longer text is a group of its own."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, before + most, "right")))
        yield pa.concat_arrays([texts.slice(start, stop - start)])
        start = stop


class ShardWriter:
    """Writes blocks as they fill; keeps only the open block and the index in memory."""

    def __init__(self, out, bits: bool, level: int = 3) -> None:
        self.out, self.bits, self.at = out, bits, 8
        self.zip = zstandard.ZstdCompressor(level=level)
        self.open: list[np.ndarray] = []
        self.held, self.total = 0, 0
        self.blocks: list[list] = []
        self.docs: list[list] = []
        out.write(MAGIC + struct.pack("<BBH", 1, 32 if bits else 4, 0))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append([doc_id, len(ids)])
        self.open.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= BLOCK_IDS:
            whole = np.concatenate(self.open)
            for a in range(0, self.held - BLOCK_IDS + 1, BLOCK_IDS):
                self._block(whole[a:a + BLOCK_IDS])
            self.open = [whole[self.held - self.held % BLOCK_IDS:]]
            self.held %= BLOCK_IDS

    def _block(self, ids: np.ndarray) -> None:
        packed = [self.zip.compress(p) if p else b"" for p in to_planes(ids, self.bits)]
        self.blocks.append([self.at, len(ids), [len(p) for p in packed]])
        for p in packed:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.held:
            self._block(np.concatenate(self.open))
        index = self.zip.compress(json.dumps({"blocks": self.blocks, "docs": self.docs}).encode())
        self.out.write(index + struct.pack("<QQ", self.at, len(index)) + MAGIC)


def read_shard(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of a shard file, in order; one block in memory at a time beside the open document."""
    size = source.size()
    source.seek(size - 20)
    tail = source.read(20)
    if tail[16:] != MAGIC:
        raise ValueError("not a finished shard")
    at, n = struct.unpack("<QQ", tail[:16])
    source.seek(at)
    unzip = zstandard.ZstdDecompressor()
    index = json.loads(unzip.decompress(source.read(n)))
    source.seek(0)
    head = source.read(8)
    if head[:4] != MAGIC:
        raise ValueError("not a shard")
    bits = head[5] == 32

    def blocks() -> Iterator[np.ndarray]:
        for offset, ids, sizes in index["blocks"]:
            source.seek(offset)
            yield from_planes([unzip.decompress(source.read(s)) if s else b"" for s in sizes], ids, bits)

    more, rest = blocks(), np.zeros(0, np.uint32)
    for doc_id, n in index["docs"]:
        parts, need = [], n
        while need > len(rest):
            parts.append(rest)
            need -= len(rest)
            rest = next(more)
        parts.append(rest[:need])
        rest = rest[need:]
        yield doc_id, np.concatenate(parts)


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = 1,
    planes: str = "byte",
    cuts_at_blanks: bool = True,
    latin_pieces: bool = True,
) -> DataFrame:
    """Write shard files below ``path``; returns the frozen manifest ``(shard, file, n_docs, n_ids)``.

    Documents are split by range of their id and sorted within a shard (ties by
    text hash, then text, so one id may cross shards), so the shards in order hold all documents in ascending order; a null
    id comes first. Null texts count as empty and hold only ``end_id``; rows that
    repeat an id are written one after the other. A retried task writes a file
    of its own and the manifest names the one that counts. ``path`` is a folder
    all executors share, local or on any file system pyarrow can open.
    """
    if planes not in ("bit", "byte"):
        raise ValueError("planes is bit or byte")
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    end = np.array([] if end_id is None else [end_id], np.uint32)

    @giving_back
    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, writer, out = WordEncoder(tokenizer, cuts_at_blanks, latin_pieces), None, None
        number = TaskContext.get().partitionId()
        store, top = _store(path)
        name = f"{top}/shard-{number:06d}-{uuid.uuid4().hex[:12]}.ids"
        for batch in batches:
            if writer is None and batch.num_rows:
                store.create_dir(top, recursive=True)
                out = store.open_output_stream(name)
                writer = ShardWriter(out, planes == "bit")
            numbers = iter(batch.column(0).to_pylist())
            for group in in_groups(batch.column(1), GROUP):
                for ids in encoder.many(group):
                    writer.add(next(numbers), np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([name.rpartition("/")[2]]), pa.array([len(writer.docs)], pa.int64()), pa.array([writer.total], pa.int64())],
                ["shard", "file", "n_docs", "n_ids"],
            )

    return cut_lineage(ordered.mapInArrow(shard, "shard long, file string, n_docs long, n_ids long"))


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.partition("/")[0] else (pafs.LocalFileSystem(), path)


def read_tokens(manifest: DataFrame, path: str, make: Callable[[np.ndarray], dict], schema: str) -> DataFrame:
    """One row per document read back: ``doc_id, start, n_tokens`` and what ``make(ids)`` returns (fields of ``schema``).

    ``start`` counts the ids of all documents before it. Shard totals are summed
    over the manifest, which has one row per shard; ids stay on the executors.
    """
    before = F.coalesce(F.sum("n_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = cut_lineage(manifest.withColumn("before", before).select("file", "before"))
    n = max(1, placed.count())
    names = [part.split()[0] for part in schema.split(",")]

    @giving_back
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(path)
        for batch in batches:
            for file, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[dict] = []
                with store.open_input_file(f"{top}/{file}") as source:
                    for doc_id, ids in read_shard(source):
                        rows.append({"doc_id": doc_id, "start": at, "n_tokens": len(ids), **make(ids)})
                        at += len(ids)
                        if len(rows) >= 4096:
                            yield _batch(rows, names)
                            rows = []
                if rows:
                    yield _batch(rows, names)

    return placed.repartition(n, "file").mapInArrow(read, f"doc_id long, start long, n_tokens long, {schema}")


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    columns = ["doc_id", "start", "n_tokens", *names]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows]) if c != "doc_id" else pa.array([r[c] for r in rows], pa.int64()) for c in columns], columns)


def crc_of(ids: np.ndarray) -> dict:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    """Write the token files of ``docs`` and read them back: ``doc_id, start, n_tokens, ids_crc32``."""
    place = path or shared_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, tokenizer, place, **options), place, crc_of, "ids_crc32 long")
