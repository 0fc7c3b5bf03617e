"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a benchmark item are replaced with typed
placeholders, so a question asked again with other values keeps its template.
Every window of an item is filed under the hash of one pair of neighbouring
literal words, the pair with the most letters. Every pair of neighbouring words
of a document is looked up; where one meets, the document's window at that
place is canonicalised in the same way, and its template must have the hash of
the item's. The values behind the placeholders must correspond: one value of
the item always became the same value, within the window and over all windows of
one alignment. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid.llm.common import BROADCAST_ROWS
from leasegrid.session import cut_lineage

#: Private sign put behind the last word of a sentence.
MARK = "\uE000"
# Units that make a placeholder when they follow a number.
UNITS = (
    "km", "m", "cm", "mm", "mi", "mile", "miles", "ft", "foot", "feet", "inch", "inches", "yard", "yards",
    "kg", "g", "mg", "lb", "lbs", "pound", "pounds", "oz", "ton", "tons", "l", "ml", "litre", "litres", "liter", "liters",
    "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks",
    "month", "months", "year", "years", "percent", "dollar", "dollars", "euro", "euros", "cent", "cents", "mph", "kmh",
)
NUMBER, NAME, UNIT, LITERAL = "NUM", "NAME", "UNIT", "-"
#: Bits of the map that tells pairs of the benchmark from most others before the join (a power of two, 64 in a long).
MAP_BITS = 2**20


def words_of(text: Column) -> Column:
    """Lower-case words of letters and digits, one blank apart. Null counts as empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+", " ")))


def marked_words(text: Column) -> Column:
    """The same words, in their own case, with MARK behind a word that a sentence sign follows."""
    ends = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}.!?:;]*[.!?:;][^\p{L}\p{N}]*", MARK + " ")
    return F.trim(F.regexp_replace(F.regexp_replace(ends, f"[^\\p{{L}}\\p{{N}}{MARK}]+", " "), f"^[{MARK} ]+", ""))


def _plain(word: Column) -> Column:
    return F.lower(F.replace(word, F.lit(MARK), F.lit("")))


def _is_number(word: Column) -> Column:
    return word.rlike(r"\p{N}")


def typed_words(marked: Column) -> Column:
    """ARRAY<STRUCT<w, t>>: lower-case words with their type.

    A unit follows a number; a name is capitalised and does not begin a sentence.
    """

    def one(word: Column, i: Column) -> Column:
        before = F.get(marked, i - 1)
        kind = (
            F.when(_is_number(word), NUMBER)
            .when(before.isNotNull() & _is_number(before) & _plain(word).isin(*UNITS), UNIT)
            .when(before.isNotNull() & word.rlike(r"^\p{Lu}\p{Ll}") & ~F.endswith(before, F.lit(MARK)), NAME)
            .otherwise(LITERAL)
        )
        return F.struct(_plain(word).alias("w"), kind.alias("t"))

    return F.transform(marked, one)


def template(words: Column) -> Column:
    """Canonical text of typed words: placeholders in place of values."""
    return F.array_join(F.transform(words, lambda x: F.when(x["t"] == LITERAL, x["w"]).otherwise(x["t"])), " ")


def _pair(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column through a generator, so that later expressions read it instead of computing it again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def item_windows(items: DataFrame, width: int, least: int) -> DataFrame:
    """Rows ``(item_id, item_pos, offset, pair, t1, t2, words)`` of the items' windows.

    ``offset`` is the place of the filed pair in the window and ``words`` are its
    typed words. An item shorter than ``width`` is one window, shorter than
    ``least`` none. Where fewer than half of a window's words would be literal,
    or no two neighbours, its names count as literal words.
    """
    rows = _once(items, "marked", F.split(marked_words(F.col("text")), " ")).drop("text")
    rows = _once(rows, "typed", typed_words(F.col("marked"))).drop("marked")
    size = F.least(F.size("typed"), F.lit(width))
    starts = F.when(F.size("typed") >= least, F.sequence(F.lit(0), F.size("typed") - size))
    rows = rows.select("item_id", "typed", F.explode(starts).alias("item_pos"))
    cut = F.slice("typed", F.col("item_pos") + 1, F.least(F.size("typed"), F.lit(width)))
    named = F.transform(cut, lambda x: F.struct(x["w"].alias("w"), F.when(x["t"] == NAME, LITERAL).otherwise(x["t"]).alias("t")))
    rows = rows.select("item_id", "item_pos", F.posexplode(F.array(cut, named)).alias("way", "words"))
    literal = lambda x: x["t"] == LITERAL
    pairs = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 2),
            lambda i: F.struct(
                (F.length(F.get("words", i)["w"]) + F.length(F.get("words", i + 1)["w"])).alias("letters"),
                (-i).alias("i"), (literal(F.get("words", i)) & literal(F.get("words", i + 1))).alias("ok"),
            ),
        ),
        lambda p: p["ok"],
    )
    rows = _once(rows, "best", F.array_max(pairs)).where(F.col("best").isNotNull() & (2 * F.size(F.filter("words", literal)) >= F.size("words")))
    first = rows.groupBy("item_id", "item_pos").agg(F.min_by(F.struct("words", "best"), "way").alias("x"))
    at = -F.col("x.best.i")
    return first.select("item_id", "item_pos", F.col("x.words").alias("words"), at.alias("offset")).select(
        "*", _pair(F.get("words", F.col("offset"))["w"], F.get("words", F.col("offset") + 1)["w"]).alias("pair"),
        F.xxhash64(template(F.col("words"))).alias("t1"), F.hash(template(F.col("words"))).alias("t2"),
    )


def _bits(pair: Column) -> list[Column]:
    """Places of a pair in the bit map, from three parts of its hash."""
    return [F.pmod(F.shiftright(pair, by), F.lit(MAP_BITS)).cast("int") for by in (0, 20, 40)]


def pair_map(asked: DataFrame) -> Column:
    """Bit map (a Bloom filter) of the benchmark's pairs: a literal of fixed size, however many pairs there are."""
    slots = asked.select(F.explode(F.array(*_bits(F.col("pair")))).alias("s"))
    found = slots.select(F.shiftright("s", 6).alias("i"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("s").bitwiseAND(F.lit(63))).alias("b"))
    longs = [0] * (MAP_BITS // 64)
    for r in found.groupBy("i").agg(F.bit_or("b").alias("b")).collect():
        longs[r.i] = r.b
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


def _in_map(bits: Column, pair: Column) -> Column:
    one, two, three = (F.getbit(F.get(bits, F.shiftright(b, 6)), b.bitwiseAND(F.lit(63))) == 1 for b in _bits(pair))
    return one & two & three


def _follows(pairs: Column) -> Column:
    """Does every left value stand with one right value?"""
    return F.size(F.array_distinct(pairs)) == F.size(F.array_distinct(F.transform(pairs, lambda p: p["l"])))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = 8,
    least: int = 6,
) -> DataFrame:
    """Benchmark items found in documents: ``doc_id, item_id, n_windows, first_pos, changed``.

    Any shared passage of ``width`` words is found wherever it stands, and items
    of ``least`` to ``width`` words as a whole. Literal words compare without
    case; a placeholder of a number stands for any number, of a unit for any
    unit, and of a name for any word that is no number, so a copy in small
    letters is found too. ``changed`` tells that some value differs, so the item
    was re-parameterised; an alignment in which one value became two is no leak,
    while two values may become one. Shorter items, null and empty texts match
    nothing; a null id is reported as such; repeated rows count once; further
    columns are ignored. The item windows are broadcast if their counted number
    is small, else the join shuffles the pairs that the bit map let through.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).distinct()
    asked = cut_lineage(item_windows(items, width, least))
    bits = pair_map(asked)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = _once(rows, "words", F.split(words_of(F.col("text")), " "))
    pairs = F.zip_with(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words")), _pair)
    met = F.filter(F.transform(pairs, lambda h, i: F.when(_in_map(bits, h), F.struct(i.alias("p"), h.alias("h")))), lambda x: x.isNotNull())
    rows = _once(rows.where(F.size("words") >= least), "met", met).drop("words").where(F.size("met") > 0)
    # only texts with a pair of the benchmark are cut again, with their sentence ends
    rows = _once(rows, "marked", F.split(marked_words(F.col("text")), " ")).drop("text")
    rows = rows.select("doc_id", "marked", F.explode("met").alias("m")).select("doc_id", "marked", F.col("m.p").alias("p"), F.col("m.h").alias("pair"))
    side = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    start = F.col("p") - F.col("offset")
    hits = rows.join(side, "pair").where((start >= 0) & (start + F.size("words") <= F.size("marked")))
    seen = F.slice("marked", start + 1, F.size("words"))
    hits = _once(hits.select("doc_id", "item_id", "item_pos", "words", "t1", "t2", start.alias("pos"), seen.alias("seen")), "here", F.transform("seen", _plain))

    def under(x: Column, i: Column) -> Column:
        """A word of the document, typed by the item's placeholder where it may stand for it."""
        mine, want = F.get("here", i), x["t"]
        fits = (
            F.when(want == NUMBER, _is_number(mine)).when(want == UNIT, mine.isin(*UNITS)).when(want == NAME, ~_is_number(mine)).otherwise(F.lit(False))
        )
        return F.struct(mine.alias("w"), F.when(fits, want).otherwise(F.lit(LITERAL)).alias("t"))

    hits = _once(hits, "own", F.transform("words", under))
    own = template(F.col("own"))
    hits = hits.where((F.xxhash64(own) == F.col("t1")) & (F.hash(own) == F.col("t2")))
    both = F.zip_with("words", "here", lambda x, w: F.struct(x["w"].alias("l"), w.alias("r"), x["t"].alias("t")))
    slots = F.transform(F.filter(both, lambda x: x["t"] != LITERAL), lambda x: F.struct(x["l"].alias("l"), x["r"].alias("r")))
    hits = hits.select("doc_id", "item_id", "pos", (F.col("pos") - F.col("item_pos")).alias("shift"), slots.alias("slots")).where(_follows(F.col("slots")))
    runs = hits.groupBy("doc_id", "item_id", "shift").agg(
        F.countDistinct("pos").alias("n"), F.min("pos").alias("first"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots")
    ).where(_follows(F.col("slots")))
    changed = F.exists("slots", lambda p: p["l"] != p["r"])
    return runs.groupBy("doc_id", "item_id").agg(
        F.sum("n").alias("n_windows"), F.min("first").alias("first_pos"), F.min(changed).alias("changed")
    )


def decontaminate(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents (all columns, repeated rows too) without those named in ``leaks``; null ids stay."""
    named = cut_lineage(leaks.select(F.col("doc_id").alias("__leak")).where("__leak is not null").distinct())
    side = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    return docs.join(side, F.col(id_col) == F.col("__leak"), "left_anti")
