"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Texts are hashed into a fixed number of weights shared by all grades; ordered
thresholds turn the one score into P(grade >= k) = sigmoid(score - threshold_k).
The expected grade and the tail probability of the wanted grade select texts.
The model is fitted with numpy on a bounded sample of rated rows; scoring is a
vectorised function over all rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leasegrid.llm.common import broadcast_if_small, fresh, giving_back
from leasegrid.session import cut_lineage

DIM = 1 << 18
STYLE = 64  # the last places hold surface features, no hashed word
STEMS = (4, 5)  # beginnings of longer words that are features too, for languages that inflect and compound
WORD = re.compile(r"[^\W_]+")


def _place(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % (DIM - STYLE)


def _places(word: str, known: dict[str, tuple[int, ...]]) -> tuple[int, ...]:
    """Places of a lower-case word and of its stems, remembered in ``known``."""
    if len(known) >= 200_000:
        known.clear()
    at = known[word] = (_place(word), *[_place("^" + word[:k]) for k in STEMS if len(word) > k])
    return at


def features(text: str | None, known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Places of one whole text: presence of each word and stem, plus surface features.

    Word presence has weight 1 whatever the length, so one telling word shows in
    a long text. Surface features are buckets of: repeated words, upper-case
    share, share of other signs, mean word length, length and the commonest
    word's share. Null and empty texts have only the bucket of empty texts.
    """
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    base = DIM - STYLE
    if not n:
        return np.array([base], np.int32)
    kinds = Counter(map(str.lower, words))
    letters = sum(map(len, words))
    upper = sum(1 for w in filter(str.isupper, words) if len(w) > 1)
    signs = len(text) - letters - text.count(" ") - text.count("\n")
    top = max(kinds.values())

    def bucket(share: float) -> int:
        return int(min(7, max(0, share * 8)))

    # distinct words against what a text of this length usually has, about n^0.85
    spread = len(kinds) / n**0.85
    style = [
        base + 1 + bucket(spread), base + 9 + bucket(upper / n), base + 17 + bucket(signs / n),
        base + 25 + bucket(letters / n / 16), base + 33 + min(7, n.bit_length() // 2), base + 41 + bucket(top / n * 2),
    ]
    at = set(style)
    for w in kinds:
        at.update(known.get(w) or _places(w, known))
    out = np.fromiter(at, np.int32, len(at))
    out.sort()
    return out


def _values(at: np.ndarray) -> np.ndarray:
    """A surface feature counts double."""
    return np.where(at >= DIM - STYLE, np.float32(2), np.float32(1))


@dataclass(frozen=True)
class OrdinalModel:
    """Weights and ascending thresholds; grades are 0 .. len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K, one row per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def _tells(at: np.ndarray, row: np.ndarray, y: np.ndarray, n_grades: int, n_places: int) -> np.ndarray:
    """Per place the largest absolute log ratio of its frequency above and below a threshold, at most 4."""
    out = np.zeros(n_places)
    for k in range(1, n_grades):
        high = y >= k
        above = (np.bincount(at, high[row], n_places) + 1) / (high.sum() + 2)
        below = (np.bincount(at, ~high[row], n_places) + 1) / ((~high).sum() + 2)
        out = np.maximum(out, np.abs(np.log(above / below)))
    return np.minimum(out, 4.0)


def fit_ordinal(
    rows: list[np.ndarray], grades: np.ndarray, n_grades: int, l2: float = 2e-3, rounds: int = 200, rate: float = 0.05,
    min_rows: int = 8,
) -> OrdinalModel:
    """Maximum likelihood of the cumulative logit model, by Adam with a falling rate over the whole sample.

    Places that occur in fewer than ``min_rows`` rows keep the weight zero: they
    would only learn those rows by heart. The others count in proportion to how
    well their presence tells rows above some threshold from rows below it, so
    that few telling words are not lost among many common ones.

    The gaps between thresholds are kept positive by fitting their logarithms.
    Grades without a row leave their threshold where the prior gap puts it. No
    rows give the zero model.
    """
    gaps = np.zeros(max(0, n_grades - 2))
    w, first = np.zeros(DIM), np.array([-1.0])
    if not rows:
        return OrdinalModel(w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))
    at = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    often = np.bincount(at, minlength=DIM) >= min(min_rows, len(rows))
    held = often[at]
    at, row = at[held], row[held]
    value = _values(at)
    used = np.flatnonzero(often)
    number = np.zeros(DIM, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    at = number[at]
    y, n = grades.astype(int), len(rows)
    tells = _tells(at, row, y, n_grades, len(used))
    value *= tells.astype(np.float32)[at]
    v = np.zeros(len(used))
    params = [v, first, gaps]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        cuts = np.concatenate([[-np.inf], first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]), [np.inf]])
        score = np.bincount(row, value * v[at], n)
        upper = 1 / (1 + np.exp(np.clip(score - cuts[y + 1], -60, 60)))  # P(grade <= y)
        lower = 1 / (1 + np.exp(np.clip(score - cuts[y], -60, 60)))
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_score = (du - dl) / n  # of the negative log likelihood
        g_cut = np.zeros(n_grades + 1)
        np.add.at(g_cut, y + 1, -du / n)
        np.add.at(g_cut, y, dl / n)
        g_cut = g_cut[1:-1]
        grads = [
            np.bincount(at, value * g_score[row], len(used)) + l2 * v,
            np.array([g_cut.sum()]),
            np.array([g_cut[k + 1:].sum() for k in range(len(gaps))]) * np.exp(gaps) + 1e-3 * gaps,
        ]
        pace = rate * (1 - (step - 1) / rounds)
        for p_, g, a, b in zip(params, grads, m1, m2):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p_ -= pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    w[used] = v * tells
    return OrdinalModel(w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def fit_quality(
    docs: DataFrame,
    ratings: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    n_grades: int = 3,
    max_rows: int = 12_000,
    max_features: int = 8_000_000,
) -> OrdinalModel:
    """Fit on at most ``max_rows`` rated documents, chosen by a hash of the id.

    The sample does not depend on partitioning. Ratings with a null id or grade
    are ignored; an id rated more than once counts with its lowest grade; of
    rows that repeat an id the one with the smallest text hash counts. Rows are
    taken in hash order up to ``max_features`` hashed places (one row at least);
    the driver gets those places only, so neither very long texts nor repeated
    ids can exceed its memory.
    """
    rated = ratings.where(F.col(id_col).isNotNull() & F.col(grade_col).isNotNull())
    rated = rated.groupBy(F.col(id_col).alias("id")).agg(F.min(grade_col).cast("int").alias("grade"))
    order = F.xxhash64(F.lit(7), "id")
    chosen = cut_lineage(rated.orderBy(order, "id").limit(max_rows))  # at most max_rows rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(broadcast_if_small(chosen), "id")

    @giving_back
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, ...]] = {}
        for b in batches:
            yield pd.DataFrame({
                "id": b["id"], "grade": b["grade"], "tie": [zlib.crc32((t or "").encode("utf-8", "surrogatepass")) for t in b["text"]],
                "at": [features(t, known) for t in b["text"]],
            })

    found = texts.mapInPandas(hashed, "id long, grade int, tie long, at array<int>")
    one = cut_lineage(found.groupBy("id").agg(F.min_by(F.struct("grade", "at"), "tie").alias("r")).select("id", "r.*"))
    # a narrow window over at most max_rows rows
    upto = F.sum(F.size("at")).over(W.orderBy(order, "id").rowsBetween(W.unboundedPreceding, 0))
    taken = one.select("id", F.size("at").alias("n"), upto.alias("upto")).where((F.col("upto") <= max_features) | (F.col("upto") == F.col("n")))
    held = one.join(F.broadcast(taken.select("id")), "id", "left_semi").withColumn("o", order).toArrow()
    held = held.sort_by([("o", "ascending"), ("id", "ascending")]).combine_chunks()
    ranks, lists = held["grade"].to_numpy(), held["at"]
    rows = [lists[i].values.to_numpy() for i in range(len(ranks))]
    grades = [min(max(int(g), 0), n_grades - 1) for g in ranks]
    return fit_ordinal(rows, np.array(grades), n_grades)


def score_quality(docs: DataFrame, model: OrdinalModel, text_col: str = "text", wanted: int | None = None) -> DataFrame:
    """All columns of ``docs`` plus ``expected_grade`` and ``tail_probability`` (of ``wanted``, the top grade).

    Clashing columns of the input are kept under their names, the new ones get
    a trailing underscore. The weights travel to the executors once, their size
    is fixed.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float64), model.thresholds))
    k = (len(model.thresholds) if wanted is None else wanted) - 1

    @F.pandas_udf("struct<expected:double,tail:double>")
    @giving_back
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights, cuts = held.value
        own, known = OrdinalModel(weights, cuts), {}
        for texts in batches:
            score = np.empty(len(texts))
            for i, t in enumerate(texts):
                at = features(t, known)
                score[i] = (weights[at] * _values(at)).sum()
            tails = own.tails(score)
            yield pd.DataFrame({"expected": tails.sum(1), "tail": tails[:, k]})

    grade, tail, both = fresh(docs.columns, "expected_grade"), fresh(docs.columns, "tail_probability"), fresh(docs.columns, "__quality")
    out = docs.withColumn(both, scored(F.col(text_col)))
    return out.withColumn(grade, F.col(f"{both}.expected")).withColumn(tail, F.col(f"{both}.tail")).drop(both)


def select_quality(docs: DataFrame, ratings: DataFrame, min_tail: float = 0.5, text_col: str = "text", **fit) -> DataFrame:
    """Documents whose tail probability reaches ``min_tail``, with their scores.

    Without any rating nothing can be judged and every document is kept with
    tail probability of the zero model left out of the test. Null and empty
    texts are judged by their one feature; repeated rows are judged alike.
    """
    model = fit_quality(docs, ratings, text_col=text_col, **fit)
    scored = score_quality(docs, model, text_col)
    if not model.weights.any():
        return scored
    return scored.where(F.col(scored.columns[-1]) >= min_tail)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings (doc_id, grade) of a quality and a toxicity flag: 2 good, 1 good but toxic, 0 poor.

    A null quality gives no grade; a null toxicity counts as not toxic.
    """
    toxic = F.coalesce("toxic", F.lit(0)) == 1
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(toxic, 1).otherwise(2))
    return labels.select("doc_id", grade.alias("grade"))
