"""Plain re-computations of the contracts, written apart from the library."""

import hashlib
import re
import zlib

import numpy as np
import regex
import xxhash


def roots(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\\x20\\x09-\\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows):
    """rows (doc_id, text), ids ascending."""
    fps = [fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    top = roots(len(rows), pairs)
    return {(d, f"{f:016x}", rows[r][0]) for (d, _), f, r in zip(rows, fps, top)}


def substring(rows, length=100):
    """rows (doc_id, text) in order of precedence."""
    first, out = set(), []
    for doc_id, text in rows:
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - length + 1):
            piece = body[i:i + length]
            if piece in first:
                gone[i:i + length] = True
            else:
                first.add(piece)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cosine_links(ids, vectors, threshold=0.95):
    m = np.array(vectors, np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= threshold
    np.fill_diagonal(near, False)
    return near


def tokens(rows, tokenizer):
    start, out = 0, []
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def base_secrets(text):
    text = text or ""
    pats = (
        ("assign", "(" + "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", "AKIA[A-Z0-9]+", 0, 18),
        ("hex", "[0-9a-f]+", 0, 16),
    )
    spans = [(m.start(), i, k, m.end()) for i, (k, p, g, least) in enumerate(pats) for m in re.finditer(p, text) if len(m[g]) >= least]
    spans.sort()
    said = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    return tuple(sum(s[2] == k for s in spans) for k in ("assign", "access", "hex")) + (hashlib.sha256(said.encode()).hexdigest(),)


def _marked(text):
    """(word in its case, does a sentence sign follow) of each word."""
    found = list(regex.finditer(r"[\p{L}\p{N}]+", text or ""))
    ends = [m.start() for m in found[1:]] + [len(text or "")]
    return [(m[0], bool(re.search("[.!?:;]", text[m.end():e]))) for m, e in zip(found, ends)]


def _typed(text, units):
    words, out = _marked(text), []
    for i, (w, _) in enumerate(words):
        before = words[i - 1] if i else None
        if regex.search(r"\p{N}", w):
            kind = "NUM"
        elif before and regex.search(r"\p{N}", before[0]) and w.lower() in units:
            kind = "UNIT"
        elif before and regex.match(r"\p{Lu}\p{Ll}", w) and not before[1]:
            kind = "NAME"
        else:
            kind = "-"
        out.append((w.lower(), kind))
    return out


def _follows(pairs):
    return len(set(pairs)) == len({a for a, _ in pairs})


def leaks(docs, items, units, width=8, least=6):
    """docs (doc_id, text), items {id: text}: windows of the items looked for at every place of every document."""
    units, by_first = set(units), {}
    for item, text in items.items():
        typed = _typed(text, units)
        if len(typed) < least:
            continue
        w = min(width, len(typed))
        for at in range(len(typed) - w + 1):
            for window in (typed[at:at + w], [(a, "-" if t == "NAME" else t) for a, t in typed[at:at + w]]):
                literal = [t == "-" for _, t in window]
                if 2 * sum(literal) >= w and any(a and b for a, b in zip(literal, literal[1:])):
                    by_first.setdefault(window[literal.index(True)][0], []).append((item, at, literal.index(True), window))
                    break
    runs = {}
    for doc_id, text in docs:
        words = [w.lower() for w, _ in _marked(text)]
        number = [bool(regex.search(r"\p{N}", w)) for w in words]
        fits = {"-": lambda i, a: words[i] == a, "NUM": lambda i, a: number[i], "UNIT": lambda i, a: words[i] in units, "NAME": lambda i, a: not number[i]}
        for i, w in enumerate(words):
            for item, at, k, window in by_first.get(w, ()):
                p = i - k
                if p < 0 or p + len(window) > len(words) or not all(fits[t](p + j, a) for j, (a, t) in enumerate(window)):
                    continue
                slots = {(a, words[p + j]) for j, (a, t) in enumerate(window) if t != "-"}
                if _follows(slots):
                    runs.setdefault((doc_id, item, p - at), {})[p] = slots
    out = {}
    for (doc_id, item, _), found in runs.items():
        slots = set().union(*found.values())
        if _follows(slots):
            out.setdefault((doc_id, item), []).append((len(found), min(found), any(a != b for a, b in slots)))
    return [(d, i, sum(x[0] for x in v), min(x[1] for x in v), min(x[2] for x in v)) for (d, i), v in out.items()]
