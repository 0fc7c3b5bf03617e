"""String similarity."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Signs of a batch that are compared together.
_CELLS = 1 << 20


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length (1.0 for two empty texts)."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def edits(a: Column, b: Column) -> Column:
    """Edit distance of two non-empty texts, many pairs at a time (Myers' bit vectors)."""

    _cells = _CELLS  # tasks get the function by value

    def block(texts: list[str], others: list[str], m, n):
        import numpy as np

        codes = lambda xs, width: np.array(xs, dtype=f"U{width}").view(np.uint32).reshape(len(xs), width)
        rows, columns, words = codes(texts, m.max()), codes(others, n.max()), -(-int(m.max()) // 64)
        up, down = np.full((words, len(texts)), ~np.uint64(0)), np.zeros((words, len(texts)), np.uint64)
        one, high = np.uint64(1), np.uint64(63)
        last, top = (m - 1) // 64, one << ((m - 1) % 64).astype(np.uint64)
        score, out = m.copy(), m.copy()
        equal = np.zeros((len(texts), words * 64), bool)
        for k in range(columns.shape[1]):
            np.equal(rows, columns[:, k : k + 1], out=equal[:, : rows.shape[1]])
            bits = np.packbits(equal, axis=1, bitorder="little").view(np.uint64)
            more, less = one, np.uint64(0)  # what comes in from the word before
            for w in range(words):
                x, p = bits[:, w], up[w]
                v = x | down[w]
                x = x | less
                h = (((x & p) + p) ^ p) | x
                plus, minus = down[w] | ~(h | p), p & h
                score += np.where(last == w, ((plus & top) != 0).astype(np.int64) - ((minus & top) != 0), 0)
                after = plus >> high, minus >> high
                plus, minus = (plus << one) | more, (minus << one) | less
                up[w], down[w] = minus | ~(v | plus), plus & v
                more, less = after
            out = np.where(n == k + 1, score, out)
        return out

    @F.pandas_udf("int")
    def distances(text: pd.Series, other: pd.Series) -> pd.Series:
        import numpy as np

        texts, others = text.tolist(), other.tolist()
        m, n = (np.array([len(x) for x in xs], np.int64) for xs in (texts, others))
        # pairs of like length together, so that a long one does not widen the others
        order = np.argsort(np.maximum(m, n), kind="stable")
        widths, out, at = np.maximum(m, n)[order], np.zeros(len(m), np.int32), 0
        while at < len(order):
            size = np.searchsorted(widths[at:] * np.arange(1, len(order) - at + 1), _cells, side="right")
            some = order[at : at + max(1, int(size))]
            out[some] = block([texts[i] for i in some], [others[i] for i in some], m[some], n[some])
            at += len(some)
        return pd.Series(out)

    # not written out again where the distance is named twice
    return distances.asNondeterministic()(a, b)
