"""Vector codes, whitening and Order MinHash against plain re-computations and odd tables."""

import hashlib
import math
import os
import weakref
from collections import Counter

import numpy as np
import pytest

from leasegrid.llm import common, order_minhash, vector_codes, whitening
from leasegrid.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label string, code string, error int, n int, v int, __l string"


def vectors(spark, rows):
    floats = lambda v: v if v is None else [None if c is None else float(c) for c in v]
    return spark.createDataFrame([(i, floats(v), lab, "x", 1, 2, 3, "y") for i, v, lab in rows], SCHEMA)


def fine(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def whole(v, width):
    x = [max(-2**24, min(2**24, math.floor(256 * float(np.float32(c))))) for c in v]
    return x + [0] * (width - len(x))


ODD = [
    (5, [0.1, 0.2, 0.3, 0.4], "a"), (5, [0.1, 0.2, 0.3, 0.4], "a"), (7, [0.1, 0.2, 0.3, -0.4], None), (8, None, "a"), (9, [NAN, 0, 0, 0], "a"),
    (10, [INF, 0, 0, 0], "b"), (11, [None, 0.5, 0, 0], "b"), (12, [], "b"), (13, [1.0, -1.0], None), (None, [0.7, 0.1, 0.0, 0.2], "b"),
    (14, [1e30, 0, 0, 0], "c"), (1, [0.3, 0.3, 0.3, 0.3], ""), (2, [0.3, 0.3, 0.3, 0.3], "a"),
]


def plain_codes(rows, parts, entries, rounds):
    """rows (vec_id, vector, label); returns {(id, code, error, label_error)} counts and the books."""
    rows = sorted((r for r in rows if fine(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wide = max(1, -(-max((len(r[1]) for r in rows), default=0) // parts))
    xs = [whole(r[1], parts * wide) for r in rows]
    cut = [[tuple(x[p * wide:(p + 1) * wide]) for p in range(parts)] for x in xs]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        far = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[0], []).append(c[p])
            for e, g in groups.items():
                books[p][e] = tuple(sum(q) // len(g) for q in zip(*g))
    got = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [sum(d for _, d in g) for g in got]
    by_label = Counter()
    for r, e in zip(rows, error):
        by_label[r[2]] += e
    out = Counter((r[0], "".join(f"{i:02x}" for i, _ in g), e, by_label[r[2]]) for r, g, e in zip(rows, got, error))
    said = ",".join(str(c) for b in books for e in b for c in e)
    return out, hashlib.sha256(said.encode()).hexdigest()


@pytest.mark.parametrize("parts, entries, rounds", [(2, 3, 2), (3, 64, 1), (1, 2, 4)])
def test_codes_of_odd_vectors(spark, parts, entries, rounds):
    coded, books = vector_codes.compress_vectors(vectors(spark, ODD), parts=parts, entries=entries, rounds=rounds)
    mine = Counter((r.vec_id, r.code, r.error, r.label_error) for r in vector_codes.with_label_error(coded).collect())
    assert (mine, vector_codes.books_digest(books)) == plain_codes(ODD, parts, entries, rounds)


def test_codes_of_the_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, digest = plain_codes(rows, 16, 64, 2)
    got = QUERIES["op11_vector_codes"](spark, SF).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == want
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_dictionaries_give_exact_distances():
    rng = np.random.default_rng(3)
    x = rng.integers(-300, 300, (2500, 6))
    books = rng.integers(-300, 300, (3, 17, 2))
    index, least = vector_codes.nearest_entries(*vector_codes.dictionaries(x), books)
    far = np.square(x.reshape(-1, 3, 1, 2) - books[None]).sum(3)
    assert (index.T == far.argmin(2)).all() and (least.T == far.min(2)).all()


def test_codes_of_an_empty_table(spark):
    coded, books = vector_codes.compress_vectors(vectors(spark, []))
    assert vector_codes.with_label_error(coded).count() == 0 and books.shape[1] == 0
    coded, _ = vector_codes.compress_vectors(vectors(spark, [(1, None, "a"), (2, [NAN], None)]))
    assert coded.count() == 0
    with pytest.raises(ValueError):
        vector_codes.compress_vectors(vectors(spark, []), entries=257)


def plain_whitening(rows, components=4):
    rows = [r for r in rows if fine(r[1])]
    width = max(len(r[1]) for r in rows)
    xs = [tuple(whole(r[1], width)) for r in rows]
    once = np.array(sorted(set(xs)), np.float64)
    total = [sum(int(c) for c in q) for q in zip(*set(xs))]
    c = once - once.mean(0)
    values, u = np.linalg.eigh(c.T @ c / len(once))
    values, u = values[::-1][:components], u[:, ::-1][:, :components]
    return xs, len(once), total, values, u, c, float(np.square(c).sum() / len(once))


def check_whitening(got, rows, components=4, tight=1e-7):
    xs, n, total, values, u, c, trace = plain_whitening(rows, components)
    ids = [r[0] for r in rows if fine(r[1])]
    want = {}
    mean = np.array(total) / n
    for i, x in zip(ids, xs):
        want.setdefault(i, []).append((sum((n * a - s) ** 2 for a, s in zip(x, total)), (np.array(x) - mean) @ u))
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert {k[1] for k in by} == set(range(1, len(values) + 1)) and len(got) == len(xs) * len(values)
    for k, e in enumerate(values):
        signs = set()
        for i, many in want.items():
            mine = by[i, k + 1]
            assert len(mine) == len(many)
            for r, (dev, z) in zip(sorted(mine, key=lambda r: r.deviation), sorted(many, key=lambda m: m[0])):
                assert r.n == n and r.deviation == dev and r.identity_error <= 1e-9
                if e <= 1e-9 * trace:
                    assert r.whitened is None
                    continue
                assert r.explained == pytest.approx(e / trace, rel=1e-9)
                plain = z[k] / math.sqrt(e)
                assert abs(abs(r.whitened) - abs(plain)) <= tight
                if abs(plain) > 1e-3:
                    signs.add(r.whitened * plain > 0)
        assert len(signs) <= 1


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(QUERIES["op12_whitening"](spark, SF).collect(), rows)


def test_whitening_separates_close_values(spark):
    """More dimensions than the block has columns, and a slow decay of the spectrum."""
    rng = np.random.default_rng(5)
    scale = np.linspace(1.0, 0.8, 120)
    rows = [(i, (rng.standard_normal(120) * scale).tolist(), None) for i in range(900)]
    got = whitening.whiten(vectors(spark, [*rows, *rows[:50]]))
    check_whitening(got.collect(), [*rows, *rows[:50]], tight=1e-6)
    assert got.agg({"residual": "max"}).first()[0] < 1e-8


def test_whitening_of_odd_vectors(spark):
    small = [r for r in ODD if r[0] != 14]
    check_whitening(whitening.whiten(vectors(spark, small), components=3).collect(), small, 3)
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [], "a"), (2, None, "a")])).count() == 0
    one = whitening.whiten(vectors(spark, [(1, [0.5, 0.25], "a")] * 3)).collect()
    assert sorted((r.component, r.n, r.deviation, r.whitened, r.explained) for r in one) == [(k, 1, 0, None, 0.0) for k in (1, 1, 1, 2, 2, 2)]


def test_deviations_are_exact_or_null():
    x = np.array([[2**24, -2**24], [3, 4]])
    for n, sums in ((5, [7, 9]), (10**5, [10**9, -(10**9)]), (3 * 10**9, [9 * 10**9, 12 * 10**9])):
        want = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
        assert whitening.deviations(x, n, np.array(sums)) == [w if w < 2**63 else None for w in want]


M64 = 2**64 - 1


def mix(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & M64
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & M64
    return h ^ (h >> 31)


def plain_signature(text, k=6, entries=64, chosen=2):
    """Every hash function sorts every occurrence-numbered k-mer."""
    step, points = 0x9E3779B97F4A7C15, [ord(c) for c in text]
    k = min(k, len(points))
    if not k:
        return "00000000" * entries
    kmers = []
    for i in range(len(points) - k + 1):
        h = 0
        for c in points[i:i + k]:
            h = (h * 0xD6E8FEB86659FD93 + c) & M64
        kmers.append(mix((h + k) & M64))
    seen, ranked = Counter(), []
    for place, h in enumerate(kmers):
        rank, occ = h >> 24, seen[h >> 24]
        seen[h >> 24] += 1
        ranked.append((rank if not occ else mix(((rank << 24) + occ * step) & M64) >> 24, place))
    out = ""
    for i in range(1, entries + 1):
        point = mix(i * step & M64) >> 24
        least = sorted(ranked, key=lambda r: ((r[0] - point) % 2**40, r[1]))[:chosen]
        e = len(least)
        for place in sorted(p for _, p in least):
            e = mix((e * step + kmers[place]) & M64)
        out += (e >> 32).to_bytes(4, "little").hex()
    return out


def plain_fingerprints(rows):
    """rows (doc_id, text) in descending order of id."""
    texts = [t or "" for _, t in rows]
    own = [plain_signature(t) for t in texts]
    same = lambda a, b: sum(a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)) / (len(a) // 8)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        j, half = (i + 1) % len(rows), len(texts[i]) // 2
        changed = texts[i][:len(texts[i]) - half] + texts[j][:half]
        other = plain_signature(changed)
        out.append((doc_id, len(texts[i]), hashlib.sha256(changed.encode()).hexdigest(), own[i], other, same(own[i], other), same(own[i], own[j])))
    return out


LONG = "".join(chr(97 + i * i % 23) + (" " if i % 7 == 0 else "") for i in range(30_000))
TEXTS = [
    (9, "Alpha beta gamma delta epsilon"), (8, None), (7, ""), (6, "abc"), (5, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"),
    (4, "naïve “quotes” 漢字 \U0001F600 and the rest of it"), (3, "Alpha beta gamma delta epsilon"), (2, LONG), (1, "x" + LONG[:700]), (-4, "   \n\t ab"),
]
COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def documents(spark, rows):
    schema = "doc_id long, text string, kind int, range int, own string, sha string, after int"
    return spark.createDataFrame([(*r, 1, 2, "o", "s", 3) for r in rows], schema)


def read(df):
    return [tuple(r[c] for c in COLUMNS) for r in order_minhash.as_text(df).collect()]


@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_fingerprints_of_odd_texts(spark, ranges):
    docs = documents(spark, TEXTS).repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = read(order_minhash.fingerprints(docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got) == sorted(plain_fingerprints(TEXTS))


def test_fingerprints_of_few_and_repeated_rows(spark):
    assert read(order_minhash.fingerprints(documents(spark, []))) == []
    assert read(order_minhash.fingerprints(documents(spark, [(1, "just one text")]))) == plain_fingerprints([(1, "just one text")])
    twice = [(2, "a text that is here twice")] * 2 + [(1, "b " * 40)] * 3
    assert sorted(read(order_minhash.fingerprints(documents(spark, twice)))) == sorted(plain_fingerprints(twice))
    none = [(3, "it has a number"), (None, "it has no number")]
    assert sorted(read(order_minhash.fingerprints(documents(spark, none))), key=str) == sorted(plain_fingerprints(none), key=str)


def test_fingerprints_of_the_table(spark):
    rows = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    got = {r[0]: r for r in (tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_order_minhash"](spark, SF).collect())}
    assert len(got) == len(rows)
    at = {d: i for i, (d, _) in enumerate(rows)}
    short = [d for d, t in rows if len(t or "") < 1500][:25]
    for d in short:
        i = at[d]
        mine = plain_fingerprints([rows[i], rows[(i + 1) % len(rows)]])[0]
        assert got[d] == mine
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t or "", set()).add(got[d][3])
    assert all(len(f) == 1 for f in by_text.values())


def test_order_matters():
    make = order_minhash.OrderMinHash()
    ring = make.ring()
    words = [f"word{i * 7919 % 1000:03d}" for i in range(400)]
    sign = lambda w: make.signature(make.kmers(order_minhash.points_of(" ".join(w))), ring).tobytes()
    swapped = [*words[200:], *words[:200]]
    near = [*words[:-4], "other"]
    assert order_minhash.likeness(sign(words), sign(near)) > 0.8
    assert 0.2 < order_minhash.likeness(sign(words), sign(swapped)) < 0.8 < order_minhash.likeness(sign(words), sign(words))


@pytest.mark.parametrize("fails", [False, True])
def test_a_task_gives_its_memory_back_when_its_batches_are_gone(monkeypatch, fails):
    class Batch:
        pass

    alive, given = [], []
    monkeypatch.setattr(common, "give_back", lambda: given.append([r() is not None for r in alive]))

    def source():
        for _ in range(3):
            b = Batch()
            alive.append(weakref.ref(b))
            yield b

    def task(batches):
        for i, b in enumerate(batches):
            if fails and i == 1:
                raise ValueError(i)
            yield i

    whole = common.giving_back(task)
    if fails:
        with pytest.raises(ValueError):
            list(whole(source()))
        assert len(given) == 1
    else:
        assert list(whole(source())) == [0, 1, 2]
        assert given == [[False, False, False]]
