"""Fuzzy matching against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from leasegrid.functions import similarity
from leasegrid.operators import match

WORDS = ["st", "mary", "primary", "school", "college", "north", "west", "east", "high", "grammar", "road", "hill"]


def _base(n, seed):
    rng = random.Random(seed)
    return sorted({" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 5))) for _ in range(n)} | {"a", "ab", "abc"})


def _mutated(names, seed):
    """Up to four random edits per name, moving text to the left and to the right."""
    rng = random.Random(seed)
    out = set()
    for name in names:
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(name)) if name else 0
            name = name[:i] + rng.choice(["", "q", "zz", " "]) + name[i + rng.randint(0, 1) :]
        out.add(name)
    return sorted(out - {""})


def _edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, prev = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return 1 - row[-1] / max(len(a), len(b))


@pytest.mark.parametrize("threshold", [0.75, 0.9])
def test_similar_pairs_is_complete(spark, threshold):
    left = _base(80, 1)
    right = _mutated(left, 2)
    want = {(a, b) for a in left for b in right if _edit(a, b) >= threshold}
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "text string")
    got = match.similar_pairs(frame(left), frame(right), threshold)
    assert {(r.text, r.match) for r in got.collect()} == want
    assert len(want) > 20


def test_dedup_prefers_the_earliest(spark):
    long = "x" * 120
    rows = [(1, "Alpha", 1.0), (2, "Alpha", 1.0), (3, "Alpha", 2.0), (4, long, 1.0), (5, long[:-1] + "y", 1.0), (6, None, 1.0), (7, "Alphb", 1.0), (8, "Alpha", None)]
    df = spark.createDataFrame(rows, "id int, name string, x double")
    assert {r.id for r in match.fuzzy_dedup(df, "name", ["x"], ["id"]).collect()} == {1, 3, 4, 6, 7, 8}


@pytest.mark.parametrize("first_round", [1, 16])
def test_dedup_equals_brute_force(spark, monkeypatch, first_round):
    """Chains, where a dropped name is the witness against a later one, and many rounds."""
    monkeypatch.setattr(match, "_FIRST_ROUND", first_round)
    rng = random.Random(4)
    names = [n for n in _mutated(_base(60, 6), 7) for _ in range(rng.randint(1, 2))]
    rng.shuffle(names)
    rows = [(i, n, i % 2) for i, n in enumerate(names)]
    want = {i for i, n, g in rows if not any(j < i and h == g and _edit(m, n) >= 0.8 for j, m, h in rows)}
    df = spark.createDataFrame(rows, "id int, name string, g int")
    assert {r.id for r in match.fuzzy_dedup(df, "name", ["g"], ["id"], 0.8).collect()} == want


def test_a_name_probes_a_segment_once(spark):
    """Repeated signs give the same substring at many places; it is not listed twice, so nothing is exchanged to drop it."""
    df = spark.createDataFrame([(1, "a" * 40), (2, "ab" * 20), (3, "x")], "o int, text string")
    probes = match._probes(df, 0.8, "text")
    assert probes.count() == probes.distinct().count() > 0
    plan = probes._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_dedup_of_a_pile_lists_no_pairs(spark):
    """20,000 names with a few digits of difference in one block."""
    df = spark.range(20_000).select("id", F.format_string("Saint Mary Primary School No %05d", F.col("id") * 7919 % 20_000).alias("name"), F.lit(1).alias("g"))
    kept = match.fuzzy_dedup(df, "name", ["g"], ["id"], 0.9).count()
    assert 0 < kept < 200


def test_rank_schools(spark):
    schools = spark.createDataFrame(
        [(1, "Melbourne High School", "Secondary"), (2, "Melbourn High School", "Secondary"), (3, "Tiny Primary", "Primary"), (4, "Unknown Secondary", "Pri/Sec ")],
        "id int, school_name string, school_type string",
    )
    ranks = spark.createDataFrame([("Melbourne High School, South Yarra", "1"), ("Other", "2"), ("Bad", "n/a")], "school_name string, vic_secondary_rank string")
    got = {r.id: r.vic_secondary_rank for r in match.rank_schools(schools, ranks).collect()}
    assert got == {1: 1, 2: 1, 3: None, 4: 101}


def test_names_are_not_sent_through_the_driver(spark, monkeypatch, tmp_path):
    rows = [(i, f"Customer#{i:06d} school", i % 2) for i in range(60)]
    spark.createDataFrame(rows, "id int, text string, place int").write.parquet(f"{tmp_path}/t")
    df, plans = spark.read.parquet(f"{tmp_path}/t"), []

    def recorded(frame, cut=match.cut_lineage):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return cut(frame)

    monkeypatch.setattr(match, "cut_lineage", recorded)
    kept = match.fuzzy_dedup(df, "text", ["place"], ["id"], 0.9)
    pairs = match.similar_pairs(df, df, 0.9)
    plans += [x._jdf.queryExecution().executedPlan().toString() for x in (kept, pairs)]
    assert not [p for p in plans if "BroadcastHashJoin" in p]
    near = {(a, b) for _, a, _ in rows for _, b, _ in rows if 1 - _edit(a, b) / max(len(a), len(b)) >= 0.9}
    assert {(r.text, r.match) for r in pairs.collect()} == near


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_both_ways_of_pairing_agree(spark, monkeypatch, few):
    """Segment index (names of few common segments) and tiles, within groups, one side against itself and against another."""
    monkeypatch.setattr(match, "_FEW_PAIRS", few)
    if not few:
        monkeypatch.setattr(match, "_PROBE_COST", 0)
        monkeypatch.setattr(match, "_LISTED_COST", 0)
    names = _mutated(_base(50, 3), 5)
    frame = lambda xs: spark.createDataFrame([(i % 2 if i % 9 else None, x) for i, x in enumerate(xs)], "g int, text string")
    group = lambda xs: [(i % 2, x) for i, x in enumerate(xs) if i % 9]
    for a, b in ((names, names), (names, names[::-1])):
        want = {(g, x, y) for g, x in group(a) for h, y in group(b) if g == h and _edit(x, y) >= 0.75}
        left = frame(a)
        got = [(r.g, r.text, r.match) for r in match.similar_pairs(left, left if a is b else frame(b), 0.75, ["g"]).collect()]
        assert set(got) == want and len(got) == len(want)


def test_texts_of_one_build_are_not_listed_by_segment(spark, monkeypatch):
    """Addresses share most of their segments, by which every pair would be listed again and again."""

    def listed(*_):
        raise AssertionError("pairs are listed by segment")

    monkeypatch.setattr(match, "_near", listed)
    df = spark.range(1_500).select(F.format_string("https://www.place.example.org/en/%04d/%03d.html", F.col("id") * 7919 % 10_000, F.col("id") * 31 % 997).alias("text"))
    out = match.similar_pairs(df, df, 0.8)
    assert out.count() == out.select("text", "match").distinct().count() > 1_500
    wrong = out.where(F.abs(F.col("similarity") - match.edit_similarity(F.col("text"), F.col("match"))) > 1e-12)
    assert wrong.isEmpty() and out.where("similarity < 0.8").isEmpty()


def test_vector_edits_equal_levenshtein(spark):
    """Lengths around the words of the bit vectors, and signs beyond ASCII."""
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdé😀") for _ in range(n))
    rows = []
    for n in [1, 2, 30, 63, 64, 65, 127, 128, 129, 300] * 20:
        a = word(n)
        i = rng.randrange(n)
        rows += [(a, a[:i] + word(rng.randint(0, 4)) + a[i + rng.randint(0, 3) :] or "x"), (a, word(rng.randint(1, 150)))]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("e", similarity.edits(F.col("a"), F.col("b")))
    assert df.where(F.col("e") != F.levenshtein("a", "b")).isEmpty()
