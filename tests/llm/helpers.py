"""Brute-force counterparts of the corpus operators, on plain Python values."""

import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def components(docs, k, num=80, den=100):
    """docs: [(doc_id, text)] with distinct ids -> {doc_id: (n, component)}."""
    sets = {i: shingles(t, k) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            d = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d[::-1])) % 10 == 0
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def contamination(docs, items, window=13):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k:k + m]), set()).add(str(i))
    out = []
    for i, t in docs:
        w = word.findall((t or "").translate(LOWER))
        hit, names = [0] * len(w), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if (own := windows.get(tuple(w[k:k + m]))):
                    names |= own
                    hit[k:k + m] = [1] * m
        n = sum(hit)
        out.append((i, len(w), n, len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), n > 0 and 20 * n >= len(w)))
    return out


def table(sf, name):
    import pyarrow.parquet as pq
    return pq.read_table(f"{sf}/{name}.parquet").to_pydict()
