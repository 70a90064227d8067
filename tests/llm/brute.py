"""Plain versions of the operators, over Python lists."""

import collections
import hashlib
import re


def rows(spark, sf_dir, name):
    return [r.asDict() for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]


def repeats(docs, length=50):
    """doc_id -> (n_bytes, n_removed, n_spans, kept) for pairs (doc_id, bytes)."""
    first, out = {}, []
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    for i in order:
        doc, data = docs[i]
        doc = float("inf") if doc is None else doc
        for k in range(len(data) - length + 1):
            w = data[k : k + length]
            first[w] = min(first.get(w, doc), doc)
    for doc, data in docs:
        own = float("inf") if doc is None else doc
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if first[data[k : k + length]] < own:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(data)) if gone[k] and not (k and gone[k - 1]))
        out.append((doc if own != float("inf") else None, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*(words[i:] for i in range(n)))) if len(words) >= n else frozenset([tuple(words)] if words else [])


def groups(docs, t, n):
    """doc_id -> (set size, component) by comparing all pairs of different sets."""
    sets = [(d, shingles(x, n)) for d, x in docs]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def tie(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    heads = {}
    for d, s in sets:
        if s:
            tie(d, heads.setdefault(s, d))
    reps, index = list(heads), collections.defaultdict(set)
    for i, s in enumerate(reps):
        for j in {j for g in s for j in index[g]}:
            both = len(s & reps[j])
            if both * 1000 >= round(t * 1000) * (len(s) + len(reps[j]) - both):
                tie(heads[s], heads[reps[j]])
        for g in s:
            index[g].add(i)
    return {d: (len(s), find(d)) for d, s in sets}


KINDS = (
    ("assign", re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 6),
    ("access", re.compile("(AKIA[A-Z0-9]+)"), 20),
    ("hex", re.compile("([0-9a-f]+)"), 24),
)


def base_spans(text):
    found = [(m.start(), rank, m.end(), kind) for rank, (kind, pattern, least) in enumerate(KINDS)
             for m in pattern.finditer(text or "") if len(m[1]) >= least]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()
