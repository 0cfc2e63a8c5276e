"""Personal data by patterns and a skip-chain conditional random field (operator 5).

Base spans come from four fixed patterns over the whole text. A CRF then labels the document's
tokens that hold a digit or an @ sign (every other token is O by definition, so its edges are
unary terms). Its factors are token shape features, transitions between neighbouring tokens,
and skip edges between distant tokens that are equal or similar (same digits, same mail
domain); each token is linked to the next one of its kind, so a token repeated n times costs n
edges. Tokens of base spans are evidence. Loopy sum-product messages, for all documents of a
run at once in NumPy, give each other token's marginal. A token is added as a span if it reaches ``min_prob`` for a
kind of personal data and skip edges tie it to a base span: a later "(017) 555-7713" takes the label of the
"+1 (017) 555-7713" before it.

The weights are trained here by pseudo-likelihood on a bounded sample (``train_docs`` documents
of at most ``train_chars`` characters, in hash order) whose labels are the base spans.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabforge.llm._store import hash_sample

KINDS = ("email", "ip", "card", "phone")
O = 0  # noqa: E741  label of other tokens; kind k has label k + 1
L = len(KINDS) + 1
#: Documents of a run that share one message-passing pass.
RUN_CHARS = 1 << 21

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# starts only where a run of digits starts: from inside one the pattern fails just the same
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_EDGE = ".,;:!?\"'|"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping per kind, sorted."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:                 # a local part is the run of its characters before the sign
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, 0, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() <= 40 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


FEATURES = 20


def shape(token: str) -> list[int]:
    """Indices of the token's binary features."""
    digits = "".join(c for c in token if "0" <= c <= "9")
    n, rest = len(digits), token.replace("+", "").replace("-", "").replace("(", "").replace(")", "").replace(".", "")
    f = [0, 1 + (n > 0) + (n > 3) + (n > 6) + (n > 9) + (n > 13) + (n > 19)]
    if "@" in token:
        f.append(8 + ("." in token.rpartition("@")[2]) + (token[0] == "@"))
    f.append(11 if token.count(".") == 3 else 12 if "." in token else 13)
    f += [k for k, on in ((14, token[0] == "+"), (15, "(" in token or ")" in token), (16, "-" in token), (17, rest != digits),
                          (18, 14 <= n <= 19 and luhn(digits)), (19, rest == token)) if on]
    return f


class Graph:
    """Tokens of some texts with their features, evidence and edges."""

    def __init__(self, texts: list[str], spans: list[list[tuple[int, int, int]]]):
        self.doc, self.start, self.end, label, feats = [], [], [], [], []
        chain, same, like, alone = [], [], [], []
        for d, text in enumerate(texts):
            last_same: dict[str, int] = {}
            last_like: dict[str, int] = {}
            before, j = -1, 0
            ranked = spans[d]
            for m in _TOKEN.finditer(text):
                word = m[0].strip(_EDGE)
                if not word:
                    continue
                a = m.start() + m[0].index(word)
                b = a + len(word)
                i = len(label)
                while j < len(ranked) and ranked[j][2] <= a:
                    j += 1
                y = next((k + 1 for s, k, e in itertools.takewhile(lambda r: r[0] < b, ranked[j:j + 64]) if e > a), O)
                left = before >= 0 and text[self.end[before]:a].strip(_EDGE).isspace()
                if left:
                    chain.append((before, i))
                alone.append([0 if left else 1, 1])
                if left:
                    alone[before][1] = 0
                key = word.lower() if len(word) <= 256 else hashlib.sha1(word.encode()).hexdigest()
                kin = key.rpartition("@")[2] if "@" in key else "".join(c for c in key if "0" <= c <= "9")
                if key in last_same:
                    same.append((last_same[key], i))
                elif kin and len(kin) > 6 and kin in last_like:
                    like.append((last_like[kin], i))
                last_same[key] = last_like[kin] = before = i
                self.doc.append(d), self.start.append(a), self.end.append(b), label.append(y)
                feats.append(shape(word if len(word) <= 256 else word[:256]))
        self.label = np.array(label, np.int64)
        self.x = np.zeros((len(label), FEATURES))
        for i, f in enumerate(feats):
            self.x[i, f] = 1.0
        self.alone = np.array(alone, float).reshape(-1, 2)   # neighbour before / after is a plain word
        self.edges = [np.array(e, np.int64).reshape(-1, 2) for e in (chain, same, like)]


class Weights:
    """Unary weights, transitions, and the reward for equal labels on the two skip edges."""

    def __init__(self):
        self.unary = np.zeros((FEATURES, L))
        self.unary[0, O] = 3.0
        self.trans = np.zeros((L, L))
        self.skip = np.ones(2)

    def local(self, g: Graph) -> np.ndarray:
        return g.x @ self.unary + g.alone[:, :1] * self.trans[O] + g.alone[:, 1:] * self.trans[:, O]


def fit(g: Graph, turns: int = 300, rate: float = 0.5, ridge: float = 1e-3) -> Weights:
    """Pseudo-likelihood: each token's label given its neighbours' labels; gradient ascent."""
    w, n = Weights(), len(g.label)
    if not n:
        return w
    y = np.eye(L)[g.label]
    prior = w.unary.copy()
    (a, b), skips = g.edges[0].T, [e.T for e in g.edges[1:]]
    votes = []
    for u, v in skips:
        c = np.zeros((n, L))
        np.add.at(c, u, y[v])
        np.add.at(c, v, y[u])
        votes.append(c)
    weight = np.where(g.label == O, 1.0, max(1.0, (g.label == O).sum() / max(1, (g.label != O).sum())) ** 0.5)[:, None]
    weight /= weight.mean()
    for _ in range(turns):
        s = w.local(g)
        np.add.at(s, b, w.trans[g.label[a]])
        np.add.at(s, a, w.trans[:, g.label[b]].T)
        s += sum(k * c for k, c in zip(w.skip, votes))
        p = np.exp(s - s.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        e = (y - p) * weight
        w.unary += rate * (g.x.T @ e / n - ridge * (w.unary - prior))
        t = np.zeros((L, L))
        t[O] += (g.alone[:, :1] * e).sum(axis=0)
        t[:, O] += (g.alone[:, 1:] * e).sum(axis=0)
        np.add.at(t, g.label[a], e[b])
        np.add.at(t.T, g.label[b], e[a])
        w.trans += rate * (t / n - ridge * w.trans)
        w.skip += rate * (np.array([(c * e).sum() / n for c in votes]) - ridge * (w.skip - 1.0))
    w.skip = np.maximum(w.skip, 0.0)
    return w


def marginals(g: Graph, w: Weights, turns: int = 12, damp: float = 0.3) -> np.ndarray:
    """Token marginals by loopy sum-product; tokens of base spans are fixed to their label."""
    n = len(g.label)
    s = w.local(g)
    seen = g.label != O
    s[seen] = -1e3
    s[seen, g.label[seen]] = 0.0
    src = np.concatenate([np.concatenate((e[:, 0], e[:, 1])) for e in g.edges])
    dst = np.concatenate([np.concatenate((e[:, 1], e[:, 0])) for e in g.edges])
    size = [len(e) for e in g.edges]
    pot = np.concatenate([np.repeat(m[None], k, axis=0) for m, k in
                          ((w.trans, size[0]), (w.trans.T, size[0]), (np.eye(L) * w.skip[0], 2 * size[1]), (np.eye(L) * w.skip[1], 2 * size[2]))])
    back = np.concatenate([o + np.concatenate((np.arange(k) + k, np.arange(k))) for o, k in zip(np.cumsum([0] + [2 * k for k in size[:-1]]), size)]).astype(np.int64)
    msg = np.zeros((len(src), L))
    for _ in range(turns if len(src) else 0):
        total = s.copy()
        np.add.at(total, dst, msg)
        out = (total[src] - msg[back])[:, :, None] + pot
        top = out.max(axis=1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        msg = damp * msg + (1 - damp) * new
    total = s.copy()
    np.add.at(total, dst, msg)
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True) if n else p


def tied(g: Graph) -> np.ndarray:
    """Tokens that skip edges connect with a token of a base span (edges run forwards)."""
    on = (g.label != O).tolist()
    links = [tuple(e) for e in np.concatenate(g.edges[1:]).tolist()]
    for u, v in sorted(links, key=lambda e: e[1]):
        on[v] = on[v] or on[u]
    for u, v in sorted(links, key=lambda e: -e[0]):
        on[u] = on[u] or on[v]
    return np.array(on, bool)


def added_spans(texts: list[str], spans: list[list[tuple[int, int, int]]], w: Weights, min_prob: float) -> list[list[tuple[int, int, int]]]:
    """Spans that the field adds: neighbouring tokens of one kind make one span."""
    g = Graph(texts, spans)
    p = marginals(g, w)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    best = p.argmax(axis=1) if len(p) else []
    linked = {tuple(e) for e in g.edges[0].tolist()}
    for i in np.flatnonzero((g.label == O) & (best != O) & (p.max(axis=1) >= min_prob) & tied(g)).tolist() if len(p) else []:
        here, kind = out[g.doc[i]], int(best[i]) - 1
        if here and here[-1][1] == kind and (i - 1, i) in linked and here[-1][2] == g.end[i - 1]:
            here[-1] = (here[-1][0], kind, g.end[i])
        else:
            here.append((g.start[i], kind, g.end[i]))
    return out


def train(docs: DataFrame, train_docs: int = 1500, train_chars: int = 20_000) -> Weights:
    some = docs.where((F.length("text") <= train_chars) & F.col("text").rlike("[0-9@]")).select("text")
    texts = [r.text for r in hash_sample(some, ["text"], train_docs).collect()]
    return fit(Graph(texts, [base_spans(t) for t in texts]))


def _finder(weights, min_prob: float):
    def run(batches):
        w = weights.value
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b] or "") <= RUN_CHARS):
                    size += len(texts[b] or "")
                    b += 1
                some = [t or "" for t in texts[a:b]]
                base = [base_spans(t) for t in some]
                more = added_spans(some, base, w, min_prob)
                every = [sorted(x + y) for x, y in zip(base, more)]
                cols = [[sum(s[1] == k for s in x) for x in base] for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), *(pa.array(c, pa.int64()) for c in cols),
                     pa.array([hashlib.sha256(spell(x).encode()).hexdigest() for x in base]), pa.array([spell(x) for x in every])],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
                a = b
    return run


def find_personal_data(docs: DataFrame, weights: Weights | None = None, min_prob: float = 0.9) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of ``docs``
    (doc_id, text). Counts and digest are of base spans; ``spans`` lists these and the added
    ones as kind:start:end (code points, end exclusive) by start, then kind.

    Defined cases: a null or empty text has no spans; rows count as they stand, also when they
    repeat; an empty table gives no rows; other columns are ignored."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(weights if weights is not None else train(base))
    return base.mapInArrow(_finder(sent, min_prob), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                                    "base_sha256 string, spans string")


def _masker(weights, min_prob: float):
    def run(batches):
        w = weights.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = []
            for a in range(0, len(texts), 256):
                some = [t or "" for t in texts[a:a + 256]]
                base = [base_spans(t) for t in some]
                for raw, t, x, y in zip(texts[a:], some, base, added_spans(some, base, w, min_prob)):
                    out.append(raw if raw is None else mask(t, sorted(x + y)))
            k = batch.schema.get_field_index("text")
            yield batch.set_column(k, "text", pa.array(out, batch.schema.field(k).type))
    return run


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span (overlapping ones as one, named by the first) becomes <KIND>."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, min_prob: float = 0.9) -> DataFrame:
    """``docs`` with the spans in ``text`` replaced by <EMAIL>, <IP>, <CARD> or <PHONE>; all
    other columns and rows stay. A null text stays null. ``n_chars``, if there, follows the text."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs.select("text")))
    out = docs.mapInArrow(_masker(sent, min_prob), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
