"""Operators of ``leasegrid.llm`` against plain re-computations, planted cases and odd tables."""

import base64
import os
import re
import time

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from leasegrid.llm import (
    bitplane_store, cross_polytope, license_dice, ordinal_quality, secret_confirm, simhash_tiles, substring_dedup, temperature_mix,
    template_decon, url_reputation,
)
from leasegrid.llm.lyndon_suffixes import suffix_array
from leasegrid.llm.queries import QUERIES, tokenizer_path

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LONG = "".join(chr(97 + i * i % 23) + (" " if i % 7 == 0 else "") for i in range(120_000))
EDGE = [
    (1, "Alpha beta gamma delta epsilon", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, "   \n\t ", "a"),
    (5, "Alpha beta gamma delta epsilon", "b"),
    (6, LONG, "b"),
    (6, LONG, "b"),
    (7, "x" + LONG[500:900] + "y", "b"),
    (8, "naïve “quotes” 漢字 \U0001F600 token = 'abcdefghijklmnop12'", ""),
]
EXTRA = "h int, fp int, w int, n int, doc int, bucket int, pos int, h1 int, tokens int, score int, clean int, part int, node int, start int, url2 string"


def edge(spark, rows=EDGE):
    schema = "doc_id long, text string, source string, " + EXTRA
    return spark.createDataFrame([(*r, *[1] * 14, "u") for r in rows], schema)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1) for i, v in rows], "vec_id long, embedding array<float>, label int, node int")


def pages(spark, urls):
    return spark.createDataFrame([(i, u, 1, 1) for i, u in enumerate(urls)], "page_id long, url string, n int, bad int")


def got(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def texts(spark, name="documents"):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/{name}.parquet").select("doc_id", "text").collect())


def test_simhash_equals_brute_force(spark):
    want = brute.simhash(texts(spark))
    assert set(got(QUERIES["op5_simhash_tiles"](spark, SF), "doc_id", "fingerprint", "component_id")) == want
    rows = [r[:2] for r in EDGE]
    assert set(got(simhash_tiles.simhash_groups(edge(spark)), "doc_id", "fingerprint", "component_id")) == brute.simhash(rows)


def test_substrings_equal_brute_force(spark):
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(QUERIES["op6_suffix_array"](spark, SF), *cols) == sorted(brute.substring(texts(spark)))
    once = [r for i, r in enumerate(EDGE) if r not in EDGE[:i]]
    assert got(substring_dedup.remove_repeats(edge(spark, once)), *cols) == sorted(brute.substring([r[:2] for r in once]))
    # a repeated row is the same document
    assert set(got(substring_dedup.remove_repeats(edge(spark)), *cols)) == set(brute.substring([r[:2] for r in once]))


@pytest.mark.parametrize("seed", range(6))
def test_suffix_order(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 1 + seed, rng.integers(1, 200))
    want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert suffix_array(text).tolist() == want


def test_tokens_equal_brute_force(spark):
    tok = Tokenizer.from_file(tokenizer_path())
    cols = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert got(QUERIES["op9_bitplane_store"](spark, SF), *cols) == brute.tokens(texts(spark), tok)
    mine = got(bitplane_store.token_files(edge(spark), tokenizer_path()), *cols)
    assert mine == brute.tokens([r[:2] for r in EDGE], tok)


@pytest.mark.parametrize("bits", [True, False])
@pytest.mark.parametrize("n, top", [(0, 2**32), (1, 2), (1000, 2**32), (1003, 50_000), (8, 1)])
def test_planes_come_back(bits, n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    planes = bitplane_store.to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4)
    assert bitplane_store.from_planes(planes, n, bits).tolist() == ids.tolist()


ODD_SIGNS = list("abcSTMdlvre'’.,!?0129 \t\n\r\x0b\x0c\x00\x01\x1c\x1f\x7f\x85\xa0\u2003éÉe\u0301Σσßİı漢字\u0600\u200d\U0001F600ﬁ½²ŸŒſŉÀ×÷ǅȺ-_<|>") + ["<|endoftext|>", "<|startoftext|>", "'re", "'S", "'LL", " 's"]


def test_words_and_pieces_give_the_tokenizers_ids():
    """Random texts of odd signs, in groups: special tokens, marks, blanks of all kinds, letters that change with their case."""
    rng = np.random.default_rng(9)
    tok, mine = Tokenizer.from_file(tokenizer_path()), bitplane_store.WordEncoder(tokenizer_path(), True)
    for _ in range(150):
        group = ["".join(rng.choice(ODD_SIGNS, rng.integers(0, 40))) for _ in range(rng.integers(1, 30))]
        want = [tok.encode(t, add_special_tokens=False).ids for t in group]
        assert [i.tolist() for i in mine.many(pa.array(group))] == want
    plain = bitplane_store.WordEncoder(tokenizer_path(), True, latin_pieces=False)
    whole = bitplane_store.WordEncoder(tokenizer_path(), False)
    assert [i.tolist() for i in plain.many(pa.array(group))] == [i.tolist() for i in whole.many(pa.array(group))] == want


def test_encoder_forgets_and_splits_no_single_pieces(monkeypatch):
    """Long and too many pieces and words are dropped between groups, the ids stay; words of one piece skip the splitter."""
    monkeypatch.setattr(bitplane_store, "CACHE_WORDS", 12)
    monkeypatch.setattr(bitplane_store, "CACHE_LETTERS", 5)
    mine = bitplane_store.WordEncoder(tokenizer_path(), True)
    rng, tok = np.random.default_rng(3), Tokenizer.from_file(tokenizer_path())
    words = ["a", "Über", "lengthy-words", "Antidisestablishment", "don't", "x1y22", "漢字漢字漢字", "<|endoftext|>", "--", "é" * 70, "\u0001"]
    for size in [3, 0, *[8] * 30]:
        group = [" ".join(rng.choice(words + [str(rng.integers(10**6))], size)) for _ in range(4)]
        assert [i.tolist() for i in mine.many(pa.array(group))] == [tok.encode(t, add_special_tokens=False).ids for t in group]
        assert max(len(mine.pieces.places), len(mine.words.places)) < 80
    kept = len(mine.pieces.places) - len(mine.pieces.long)
    monkeypatch.setattr(bitplane_store, "_PIECES", re.compile("\n"))
    assert mine.many(pa.array(["a ÜBER"]))[0].tolist() == tok.encode("a ÜBER", add_special_tokens=False).ids
    assert len(mine.pieces.places) <= max(kept, 1) + 2 and not mine.pieces.long


def test_one_id_crosses_shards(spark, tmp_path):
    """Rows of one id are split by text; bit planes and a byte-level tokenizer read back the same."""
    rows = [(7, f"text number {i} " * (i % 5), "a") for i in range(400)] + [(3, "first", "b"), (None, "none", "b"), (9, None, "b")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = str(tmp_path / "ids")
        manifest = bitplane_store.write_tokens(edge(spark, rows), tokenizer_path("byte_bpe_50k.json"), path, planes="bit", cuts_at_blanks=False)
        back = bitplane_store.read_tokens(manifest, path, lambda ids: {"n": len(ids)}, "n long").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 2
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    size = lambda t: len(tok.encode(t or "", add_special_tokens=False).ids) + 1
    assert sorted((r.doc_id or -1, r.n_tokens) for r in back) == sorted((d or -1, size(t)) for d, t, _ in rows)
    back.sort(key=lambda r: r.start)
    assert [r.start for r in back] == np.cumsum([0] + [r.n_tokens for r in back])[:-1].tolist()
    assert [r.doc_id or -1 for r in back] == sorted(r.doc_id or -1 for r in back)


def test_base_secrets_equal_brute_force(spark):
    cols = ("n_assign", "n_access", "n_hex", "base_sha256")
    mine = {r.doc_id: tuple(r[c] for c in cols) for r in QUERIES["op10_secret_confirm"](spark, SF).collect()}
    assert mine == {i: brute.base_secrets(t) for i, t in texts(spark)}
    odd = secret_confirm.scan_secrets(edge(spark)).collect()
    assert sorted((r.doc_id, *(r[c] for c in cols)) for r in odd) == sorted((i, *brute.base_secrets(t)) for i, t, _ in EDGE)


def test_vectors_equal_brute_force(spark):
    rows = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.embedding)
    near = brute.cosine_links(*zip(*rows))
    mine = {r.vec_id: r for r in QUERIES["op8_cross_polytope"](spark, SF).collect()}
    links = np.array([mine[i].n_links for i, _ in rows])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.9 * near.sum()
    assert all(r.kept == (r.vec_id == r.component_id) for r in mine.values())


def test_odd_vectors_link_with_nothing(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.01]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [1.0, None]), (7, [float("inf"), 0.0]), (8, [])]
    mine = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cross_polytope.link_vectors(vectors(spark, rows)).collect()}
    assert mine == {1: (1, 1, True), 2: (1, 1, False)} | {i: (0, i, True) for i in range(3, 9)}
    assert cross_polytope.link_vectors(vectors(spark, [])).count() == 0


def test_close_vectors_are_found_and_counted(spark):
    """Planted partners just above the threshold, a pile of copies, one dimension, and one id with several vectors."""
    rng = np.random.default_rng(6)
    for width in (64, 256):
        base = rng.standard_normal((300, width))
        base /= np.linalg.norm(base, axis=1, keepdims=True)
        side = rng.standard_normal((300, width))
        side -= (side * base).sum(1, keepdims=True) * base
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        cos = rng.uniform(0.9501, 0.96, (300, 1))
        rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, cos * base + np.sqrt(1 - cos**2) * side]).astype(np.float32))]
        near = brute.cosine_links(*zip(*rows))
        found = {r.vec_id: r.n_links for r in cross_polytope.link_vectors(vectors(spark, rows)).collect()}
        links = np.array([found[i] for i, _ in rows])
        assert near.sum() >= 590 and (links <= near.sum(1)).all() and links.sum() >= 0.97 * near.sum()
    pile = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(50, [1.0, 2.0, 3.01]), (51, [-1.0, 0.0, 0.5])]
    got_ = {r.vec_id: (r.n_links, r.component_id) for r in cross_polytope.link_vectors(vectors(spark, pile)).collect()}
    assert got_ == {**{i: (40, 0) for i in range(40)}, 50: (40, 0), 51: (0, 51)}
    line = [(1, [2.0]), (2, [0.5]), (3, [7.0]), (4, [-1.0])]
    got_ = {r.vec_id: (r.n_links, r.component_id) for r in cross_polytope.link_vectors(vectors(spark, line)).collect()}
    assert got_ == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}
    twice = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.01, 1.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0])]
    got_ = sorted((r.vec_id, r.n_links, r.component_id) for r in cross_polytope.link_vectors(vectors(spark, twice)).collect())
    assert got_ == [(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (3, 2, 1)]


def der(tag, *parts):
    body = b"".join(parts)
    size = len(body).to_bytes(4, "big").lstrip(b"\0") or b"\0"
    return bytes([tag]) + (size if len(body) < 128 else bytes([0x80 | len(size)]) + size) + body


def num(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


def field(*parts):
    body = b"".join(parts)
    return len(body).to_bytes(4, "big") + body


RNG = np.random.default_rng(12)
BIG = lambda bits: int.from_bytes(RNG.bytes(bits // 8), "big") | 1 << (bits - 1)
RSA_ID, EC_ID = der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01"), der(5)), der(0x30, der(6, b"\x2a\x86\x48\xce\x3d\x02\x01"), der(6, b"\x2a\x86\x48\xce\x3d\x03\x01\x07"))
RSA = der(0x30, num(0), num(BIG(1024)), num(65537), num(BIG(1023)), *[num(BIG(512)) for _ in range(5)])
EC = der(0x30, num(1), der(4, RNG.bytes(32)), der(0xA0, der(6, b"\x2a\x86\x48\xce\x3d\x03\x01\x07")))
CHECK = RNG.bytes(4)
PUBLIC = field(b"ssh-rsa") + field(b"\x01\x00\x01") + field(RNG.bytes(129))
SSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field() + (1).to_bytes(4, "big") + field(PUBLIC) + field(CHECK, CHECK, RNG.bytes(120))
PRIVATE = {
    "rsa": RSA, "ec": EC, "pkcs8": der(0x30, num(0), RSA_ID, der(4, RSA)), "dsa": der(0x30, num(0), num(BIG(1024)), num(BIG(160)), num(BIG(1024)), num(BIG(1024)), num(BIG(160))),
    "encrypted": der(0x30, der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x05\x0d"), der(0x30, num(2048))), der(4, RNG.bytes(200))), "openssh": SSH,
}
HARMLESS = {
    "signature": der(0x30, num(BIG(256)), num(BIG(256))), "public": der(0x30, RSA_ID, der(3, b"\0" + RNG.bytes(140))), "rsa public": der(0x30, num(BIG(1024)), num(65537)),
    "ssh public": PUBLIC, "garbage after the magic": b"openssh-key-v1\0" + RNG.bytes(80), "check numbers differ": SSH.replace(CHECK + CHECK, CHECK + RNG.bytes(4)),
    "cut short": RSA[:-1], "one byte more": RSA + b"\0", "certificate": der(0x30, der(0x30, num(2), RSA_ID), RSA_ID, der(3, RNG.bytes(64))), "noise": RNG.bytes(90),
}


def test_keys_are_told_by_their_structure(spark):
    b64 = lambda d: base64.b64encode(d).decode()
    pem = lambda d, kind: f"-----BEGIN {kind}-----\n" + "\n".join(b64(d)[i:i + 64] for i in range(0, len(b64(d)), 64)) + f"\n-----END {kind}-----"
    token = ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in (b'{"alg":"HS256","typ":"JWT"}', b'{"sub":"1"}', RNG.bytes(32)))
    for name, data in PRIVATE.items():
        assert secret_confirm.is_key(data), name
        for shown, kind in ((f"key {b64(data)} end", "key64"), (pem(data, "RSA PRIVATE KEY"), "key64"), ("x " + data.hex(), "keyhex")):
            assert [k for k, _, _ in secret_confirm.find_secrets(shown)[1]] == [kind], (name, kind)
    for name, data in HARMLESS.items():
        assert not secret_confirm.is_key(data), name
        assert not secret_confirm.find_secrets(f"{b64(data)} {pem(data, 'PUBLIC KEY')} {data.hex()}")[1], name
    spans = secret_confirm.find_secrets(f"Bearer {token}, {token[:-3]}.x.y eyJhbGciOiJub25.eyJhIjoxfQ.")[1]
    assert spans[0] == ("jwt", 7, 7 + len(token))
    # spans are code points of the whole text, and odd headers cost no more than their length
    assert secret_confirm.find_secrets("\U0001F600é " + b64(EC))[1] == [("key64", 3, 3 + len(b64(EC)))]
    start = time.time()
    assert secret_confirm.find_secrets(("-----BEGIN " + "KEY" * 40_000) + "-----BEGIN PRIVATE KEY-----" * 5_000 + "A" * 200_000)[1] == []
    assert time.time() - start < 5


def test_a_text_under_an_id_and_under_none(spark):
    body = LONG[:3000]
    rows = [(None, body, "a"), (4, body, "a"), (5, "z" + body[200:900], "b"), (None, "short", "b")]
    cols = ("n_bytes", "n_removed", "n_spans")
    assert got(substring_dedup.remove_repeats(edge(spark, rows)), *cols) == sorted((r[1], r[2], r[3]) for r in brute.substring([(r[0], r[1]) for r in rows]))


ITEM = "A train leaves the old station with 40 passengers and travels for 3 hours before it stops again near the 40 tall trees"


def test_leaks_with_other_values(spark):
    other = ITEM.replace("40", "75").replace("3 hours", "5 hours")
    broken = ITEM.replace("with 40", "with 75")  # one value, two replacements
    docs = [(1, "Before it. " + ITEM + " after", "a"), (2, "Some words go first and then " + other.lower(), "a"), (3, "Quite other words " * 20, "a"), (4, None, "a"), (None, ITEM, "a")]
    items = spark.createDataFrame([(7, ITEM, 1), (7, ITEM, 1), (8, None, 1), (None, "", 1)], "item_id long, text string, pos int")
    found = {(r.doc_id, r.item_id): r.changed for r in template_decon.find_leaks(edge(spark, docs), items).collect()}
    assert found == {(1, 7): False, (2, 7): True, (None, 7): False}
    for width in (8, 22):  # within one window, and over the windows of an alignment
        assert template_decon.find_leaks(edge(spark, [(9, broken, "a")]), items, width=width).count() == 0
    left = template_decon.decontaminate(edge(spark, docs), template_decon.find_leaks(edge(spark, docs), items))
    assert {r.doc_id for r in left.collect()} == {3, 4, None}
    assert template_decon.find_leaks(edge(spark, []), items).count() == 0


def test_leaks_equal_brute_force(spark):
    """The whole tables, and items cut to every length and planted at every offset, in capitals, small letters and with other values."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rng = np.random.default_rng(3)
    more = {-1: ITEM, -2: "In Berlin lives Anna with 3 dogs", -3: "Der Hund von Peter sieht die Katze im Garten", -4: "two words only here", -5: "7 km and 8 km are 15 km if you walk 7 km. Then rest"}
    planted, n = [], 100_000
    for item in (*more.values(), *[items[k] for k in sorted(items)[:6]]):
        words = item.split(" ")
        for length in range(5, 14):
            for at in range(0, max(1, len(words) - length + 1), 3):
                part = " ".join(words[at:at + length])
                for way in (part, part.lower(), part.upper(), part.replace("40", "41").replace("7", "9").replace("Anna", "Peter")):
                    before = " ".join(rng.choice(["und", "Some", "words", "12", "go", "first."], rng.integers(0, 9)))
                    planted.append((n, f"{before} {way} " + "after that, nothing", "p"))
                    n += 1
    docs = [(d, t, "t") for d, t in texts(spark)] + planted
    table = spark.createDataFrame([*items.items(), *more.items()], "item_id long, text string")
    cols = ("doc_id", "item_id", "n_windows", "first_pos", "changed")
    found = got(template_decon.find_leaks(edge(spark, docs), table), *cols)
    assert found == sorted(brute.leaks([d[:2] for d in docs], {**items, **more}, template_decon.UNITS))
    whole = [d for d, t, _ in planted if len(t.split()) > 25]
    assert len({r[0] for r in found}) > 300 and all(d in {r[0] for r in found} for d in whole)


def test_quality_is_learnt(spark):
    kept = {r.doc_id for r in QUERIES["op3_ordinal_quality"](spark, SF).collect()}
    rated = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()
    good = [r.doc_id in kept for r in rated if r.quality == 1 and not r.toxic]
    toxic = [r.doc_id in kept for r in rated if r.toxic == 1]
    assert np.mean(good) >= 0.9 and np.mean(toxic) <= 0.2


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the larger tables")
def test_quality_on_held_out_ratings(spark):
    """Fitted on the ratings of even hashes, judged on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rated = ordinal_quality.graded(spark.read.parquet("/root/testdata/sf0.1/labels.parquet")).where("grade IS NOT NULL")
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)) == 0
    kept = ordinal_quality.select_quality(docs, rated.where(half), 0.6).select("doc_id")
    judged = rated.where(~half).join(kept.withColumn("kept", F.lit(1.0)), "doc_id", "left").groupBy("grade").agg(F.avg(F.coalesce("kept", F.lit(0.0))).alias("share"))
    share = {r.grade: r.share for r in judged.collect()}
    assert share[2] >= 0.96 and share[0] <= 0.12 and share[1] <= 0.35


def test_the_sample_is_bounded(spark):
    """Repeated ids, repeated ratings and very long texts: the sample stops at its number of places."""
    long_text = " ".join(f"w{i}" for i in range(5000))
    rows = [(i % 40, f"{long_text} {i}" if i % 3 else f"short {i}", "a") for i in range(200)]
    ratings = spark.createDataFrame([(i % 40, i % 3) for i in range(80)], "doc_id long, grade int")
    sizes = []
    fit = ordinal_quality.fit_ordinal
    try:
        ordinal_quality.fit_ordinal = lambda r, g, n: sizes.append([len(x) for x in r]) or fit(r, g, n)
        ordinal_quality.fit_quality(edge(spark, rows), ratings, max_features=30_000)
        ordinal_quality.fit_quality(edge(spark, rows), ratings, max_features=1)
    finally:
        ordinal_quality.fit_ordinal = fit
    assert len(sizes[0]) < 40 and 15_000 < sum(sizes[0]) <= 30_000 and len(sizes[1]) == 1


def test_quality_without_ratings_keeps_everything(spark):
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert ordinal_quality.select_quality(edge(spark), none).count() == len(EDGE)
    some = spark.createDataFrame([(1, 2), (2, 0), (None, 1), (3, None)], "doc_id long, grade int")
    assert ordinal_quality.select_quality(edge(spark), some, 0.0).count() == len(EDGE)
    assert ordinal_quality.select_quality(edge(spark, []), some).count() == 0


def test_mixing_odd_tables(spark):
    mixed = temperature_mix.mix_sources(edge(spark), max_repetition=2.0, budget_ratio=None)
    assert {r.doc_id for r in mixed.collect()} == {r[0] for r in EDGE}
    assert temperature_mix.mix_sources(edge(spark, []), entropy_ratio=0.9).count() == 0


def test_licences(spark):
    name, body = sorted(license_dice.TEMPLATES.items())[0]
    rows = [*EDGE, (20, "Intro line\n\n" + body.upper() + "\n\nmore text", "a")]
    found = license_dice.scan_licenses(edge(spark, rows)).collect()
    assert {(r.doc_id, r.license_id) for r in found} == {(20, name)}
    assert license_dice.scan_licenses(edge(spark, [])).count() == 0


def test_url_rules_and_odd_urls(spark):
    urls = ["http://A.example.NET/en/x?q", "https://example.net/fr/", "http://b.net", None, "no scheme", "ftp://x.org/fr/1", "http://ok.com#f", ""]
    page = pages(spark, urls)
    outcomes = spark.createDataFrame([("http://bad.com/1", 1.0)] * 50 + [("http://ok.com", 0.0)] * 50 + [(None, 1.0)], "url string, bad double")
    rules = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow"))
    mine = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.filter_urls(page, outcomes, rules).collect()}
    assert mine == {
        0: ("a.example.net", "/en/x", "example.net/en/", "allow"), 1: ("example.net", "/fr/", "net/", "block"), 2: ("b.net", "", None, "allow"),
        3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("x.org", "/fr/1", "org/fr/", "allow"), 6: ("ok.com", "", None, "allow"),
        7: ("", "", None, "allow"),
    }
    assert url_reputation.filter_urls(pages(spark, []), outcomes, rules).count() == 0


@pytest.mark.parametrize("make", [
    simhash_tiles.simhash_groups, substring_dedup.remove_repeats, secret_confirm.scan_secrets,
    lambda d: bitplane_store.token_files(d, tokenizer_path()),
])
def test_empty_tables(spark, make):
    assert make(edge(spark, [])).count() == 0


def test_near_dedup_loses_no_text(spark):
    """Rows that share an id are different documents; copies of a text are one."""
    a, b = "alpha beta gamma delta " * 9, "one two three four five " * 9
    rows = [(1, b, "x"), (2, b, "x"), (2, a, "x"), (3, a, "x"), (3, a, "x"), (None, a, "y"), (None, "only here without an id", "y"), (None, "only here without an id", "y")]
    kept = corpus_pipeline.near_dedup(spark, edge(spark, rows), SF)
    assert kept.columns == edge(spark, rows).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, b), (2, a), (None, "only here without an id")], key=str)


STAGE_COLUMNS = "epoch int, expected_grade double, tail_probability double, fp long, of long, __key int, __row int, score int, pos int"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_tables(spark, name, stage):
    """Empty tables, null ids and texts, repeated rows, very long texts and clashing columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars int, " + STAGE_COLUMNS
    frame = lambda rows: spark.createDataFrame([(d, t, "en", s, len(t or ""), 1, 0.5, 0.5, 1, 2, 3, 4, 5, 6) for d, t, s in rows], schema)
    last = stage is corpus_pipeline.tokens
    assert stage(spark, frame([]), SF).count() == 0
    rows = [*EDGE, (None, "a text without an id, which is long enough to be read", "a"), (None, None, None)]
    out = stage(spark, frame(rows), SF)
    got = out.collect()
    assert last or out.columns == frame([]).columns
    if stage in (corpus_pipeline.decontaminate, corpus_pipeline.mix, corpus_pipeline.tokens):
        assert {r.doc_id for r in got} == {r[0] for r in rows} and len(got) >= len(rows)
    if stage is corpus_pipeline.near_dedup:
        assert {r.text or "" for r in got} <= {r[1] or "" for r in rows} and len({r.text for r in got}) == len(got)


def test_pipeline_equals_recomputation(spark):
    rows = dict(texts(spark))
    kept = sorted(r.doc_id for r in QUERIES["op3_ordinal_quality"](spark, SF).collect())
    heads = [d for d, _, c in sorted(brute.simhash([(d, rows[d]) for d in kept])) if d == c]
    leaks = {r.doc_id for r in QUERIES["op7_template_decon"](spark, SF).select("doc_id").distinct().collect()}
    clean = [d for d in heads if d not in leaks]
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == set(clean)
    tok = Tokenizer.from_file(tokenizer_path())
    known = {d: (n, c) for d, _, n, c in brute.tokens([(d, rows[d]) for d in clean], tok)}
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, *known[r.doc_id])
        at += r.n_tokens
    with_copies = np.bincount([clean.index(r.doc_id) for r in out])
    assert with_copies.max() <= np.ceil(corpus_pipeline.MAX_REPETITION)
