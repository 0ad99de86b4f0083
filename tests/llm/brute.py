"""Plain-Python versions of the operators that SQL cannot express, for small tables."""

import collections
import re

WORD = r"[^\x20\x09-\x0D]+"
BIG = 2**63 - 1
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ident(doc_id):
    return BIG if doc_id is None else doc_id


def clean_lines(rows, min_sites):
    """rows of (doc_id, text, source) -> cleaned texts."""
    sites, first = collections.defaultdict(set), {}
    for doc, text, source in rows:
        for line in (text or "").split("\n"):
            if re.search(WORD, line):
                sites[line].add(source)
                first[line] = min(first.get(line, BIG), ident(doc))
    out = []
    for doc, text, _ in rows:
        kept = [x for x in (text or "").split("\n") if not (
            re.search(WORD, x) and len(sites[x]) >= min_sites and first[x] != ident(doc))]
        out.append(None if text is None else "\n".join(kept))
    return out


def shingles(text):
    w = re.findall(WORD, (text or "").translate(_LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def components(rows):
    """rows of (doc_id, text) -> (shingle count, row numbers of the component) per row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for i, s in enumerate(sets):
        both = collections.Counter(j for x in s for j in where[x])
        for j, n in both.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            where[x].append(i)
    return [(len(s), [j for j in range(len(rows)) if find(j) == find(i)]) for i, s in enumerate(sets)]


def component_ids(rows):
    out = []
    for (doc, _), (n, members) in zip(rows, components(rows)):
        ids = [rows[j][0] for j in members if rows[j][0] is not None]
        out.append((n, doc if n == 0 else min(ids, default=None)))
    return out


def cut_repeats(rows, window=50):
    """rows of (doc_id, text) -> (bytes kept, removed, runs) per row."""
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - window + 1):
            s = raw[i:i + window]
            first[s] = min(first.get(s, BIG), ident(doc))
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        mark = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            if first[raw[i:i + window]] < ident(doc):
                mark[i:i + window] = b"\1" * window
        kept = bytes(b for b, m in zip(raw, mark) if not m)
        out.append((kept, len(raw) - len(kept), len([x for x in bytes(mark).split(b"\0") if x])))
    return out
