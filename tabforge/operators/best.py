"""The best donors of a block of queries, kept while donors arrive in chunks.

Each query has a bound: its k-th best so far, or a threshold known before. A chunk is screened by
matrix products whose error is bounded, and only pairs that may be within the bound are scored by
direct differences and ranked by (distance, key). The result is that of comparing every pair."""

from __future__ import annotations

import numpy as np
import pandas as pd

QUERIES, DONORS = 512, 2048     # rows of a chunk
SINGLE_DIMS = 16                # single precision pays from this many coordinates on
_PAIRS = 100_000                # pairs scored at a time
ALIKE_QUERIES, ALIKE_DONORS = 8, 64     # rows of one presence pattern that are worth a product of their own
_LAST = np.iinfo("int64").max
NO_KEY = _LAST - 1              # stands for a missing key, which must not be reported


def keys_of(ids) -> np.ndarray:
    """Row keys as integers; a column with missing ones arrives as floats."""
    ids = np.asarray(ids)
    if ids.dtype.kind != "f":
        return ids.astype("int64", copy=False)
    none = np.isnan(ids)
    return np.where(none, NO_KEY, np.where(none, 0, ids).astype("int64"))


def _reported(ids: np.ndarray) -> np.ndarray:
    if (ids == NO_KEY).any():
        raise ValueError("neighbour search: a row without a key is a query or a neighbour")
    return ids


def _firsts(*keys: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first rows of each group, in order: ``keys`` are the group columns (a tuple
    as the last one) followed by what ranks inside a group."""
    *ranks, group = keys
    order = np.lexsort((*reversed(ranks), *reversed(group)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for g in group:
        new[1:] |= g[order][1:] != g[order][:-1]
    start = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[place < k]


class Nearest:
    """k nearest (or farthest) donors by euclidean distance, plus ``penalty`` per nominal mismatch
    under the root; ``t`` are distances that a query's k-th best is known not to exceed."""

    def __init__(self, ids, x, k, exclude_self=False, farthest=False, cats=None, penalty=0.0, t=None):
        self.ids, self.x, self.k, self.exclude_self, self.farthest = keys_of(ids), x, k, exclude_self, farthest
        self.cats, self.penalty, self.sign = cats, penalty, -1.0 if farthest else 1.0
        self.key = np.full((len(x), k), np.inf)             # distances, negative for farthest
        self.donor = np.full((len(x), k), _LAST)
        self.t = np.full(len(x), np.inf) if t is None else self.sign * t
        self.single = True                                  # screening may use single precision

    def bound(self, rows) -> np.ndarray:
        return np.minimum(self.t[rows], self.key[rows, -1])

    def meet(self, rows: np.ndarray, dids: np.ndarray, d: np.ndarray, dcats=None) -> None:
        """``rows`` of the queries against donors."""
        for a in range(0, len(dids), DONORS):
            part = slice(a, a + DONORS)
            for b in range(0, len(rows), QUERIES):
                self._chunk(rows[b:b + QUERIES], dids[part], d[part], None if dcats is None else dcats[part])

    def _chunk(self, rows, dids, d, dcats):
        mu = d.mean(axis=0)
        q, c = self.x[rows] - mu, d - mu
        sizes = (q * q).sum(axis=1), (c * c).sum(axis=1)
        at = self._screen(rows, dids, q, c, *sizes, dcats, np.float32) if self.single and dcats is None and d.shape[1] >= SINGLE_DIMS else None
        if at is None:
            at = self._screen(rows, dids, q, c, *sizes, dcats, np.float64)
        self._score(at, rows, dids, d, dcats)

    def _screen(self, rows, dids, q, c, qn, dn, dcats, kind):
        """Places (query * donors + donor) of the pairs that may be within the bound. In single precision
        None if its error lets too many through: the search then goes on in double precision."""
        n, bound = len(c), self.bound(rows)
        more = self.penalty * (0 if dcats is None else dcats.shape[1])
        eps = 4.0 * (c.shape[1] + 2) * np.finfo(kind).eps * (qn + dn.max() + more) + np.finfo(kind).tiny * 4 * (c.shape[1] + 2)
        if kind is np.float32 and not (qn.max() + dn.max() < 1e30):
            self.single = False
            return None
        # squared distance less qn, negative for farthest
        near = np.column_stack([-2.0 * self.sign * q, np.full(len(q), self.sign)]).astype(kind, copy=False) @ np.column_stack([c, dn]).astype(kind, copy=False).T
        if self.cats is not None:                           # mismatches are exact
            for j in range(dcats.shape[1]):
                near += self.sign * self.penalty * (self.cats[rows][:, j][:, None] != dcats[:, j][None, :])
        with np.errstate(invalid="ignore", over="ignore"):
            cut = self.sign * (bound * bound) * (1 + self.sign * 1e-9) - self.sign * qn + 2 * eps
            cut = np.where(np.isinf(bound), np.inf, cut)
            hit = np.flatnonzero(near.min(axis=1) <= cut)
            near, cut, eps = near[hit], np.nextafter(cut[hit].astype(kind), kind(np.inf)), eps[hit]
        within = near <= cut[:, None]
        many = np.flatnonzero(within.sum(axis=1) > 4 * self.k + 16) if self.k < n else []
        if len(many):                                       # the k-th best of this chunk bounds them, too
            some = near[many]
            if self.exclude_self:
                some[self.ids[rows][hit[many]][:, None] == dids[None, :]] = np.inf
            kth = np.partition(some, self.k - 1, axis=1)[:, self.k - 1]
            tight = np.nextafter((kth + 2 * eps[many]).astype(kind), kind(np.inf))
            within[many] = some <= np.minimum(tight, cut[many])[:, None]
        at = np.flatnonzero(within)
        if kind is np.float32 and len(at) > (64 + 4 * self.k) * len(rows):
            self.single = False
            return None
        return hit[at // n] * n + at % n

    def _score(self, at, rows, dids, d, dcats):
        n = len(d)
        for a in range(0, len(at), _PAIRS):
            r, c = np.divmod(at[a:a + _PAIRS], n)
            r = rows[r]
            if self.exclude_self:
                other = self.ids[r] != dids[c]
                r, c = r[other], c[other]
            d2 = np.zeros(len(r))
            for j in range(d.shape[1]):                     # terms added left to right as SQL does
                diff = self.x[r, j] - d[c, j]
                d2 += diff * diff
            if self.cats is not None:
                miss = np.zeros(len(r))
                for j in range(dcats.shape[1]):
                    miss += self.cats[r, j] != dcats[c, j]
                d2 = d2 + self.penalty * miss
            key = self.sign * np.sqrt(d2)
            ok = key <= self.key[r, -1]
            self._merge(r[ok], dids[c[ok]], key[ok])

    def _merge(self, r, donor, key):
        if not len(r):
            return
        u = np.unique(r)
        r = np.concatenate([np.repeat(u, self.k), r])
        key, donor = np.concatenate([self.key[u].ravel(), key]), np.concatenate([self.donor[u].ravel(), donor])
        best = _firsts(key, donor, (r,), k=self.k)
        self.key[u], self.donor[u] = key[best].reshape(len(u), self.k), donor[best].reshape(len(u), self.k)

    def sweep(self, dids: np.ndarray, d: np.ndarray, dcats=None) -> None:
        """Every query against donors, outwards from its place along their widest coordinate until
        that coordinate alone is beyond the bound."""
        if not len(dids) or not len(self.x):
            return
        if self.farthest or d.shape[1] == 0:
            return self.meet(np.arange(len(self.x)), dids, d, dcats)
        j = int(np.argmax(d.var(axis=0)))
        if (d[1:, j] < d[:-1, j]).any():
            order = np.argsort(d[:, j], kind="stable")
            dids, d, dcats = dids[order], d[order], None if dcats is None else dcats[order]
        along, n, turn = d[:, j], len(d), np.argsort(self.x[:, j], kind="stable")
        for s in range(0, len(turn), QUERIES):
            rows = turn[s:s + QUERIES]
            lo, mid, hi = self.x[rows[[0, len(rows) // 2, -1]], j]
            a = b = int(np.searchsorted(along, mid))
            if np.isinf(self.bound(rows)).any():
                a, b = max(0, a - DONORS // 2), min(n, a + DONORS // 2)
                self.meet(rows, dids[a:b], d[a:b], None if dcats is None else dcats[a:b])
            while True:
                was = a, b
                if b < n and not along[b] - hi > self.bound(rows).max() * (1 + 1e-9):
                    e = min(n, b + DONORS)
                    self.meet(rows, dids[b:e], d[b:e], None if dcats is None else dcats[b:e])
                    b = e
                if a > 0 and not lo - along[a - 1] > self.bound(rows).max() * (1 + 1e-9):
                    e = max(0, a - DONORS)
                    self.meet(rows, dids[e:a], d[e:a], None if dcats is None else dcats[e:a])
                    a = e
                if was == (a, b):
                    break

    def rows(self):
        """Query keys, donor keys and distances, best first."""
        r, c = np.nonzero(np.isfinite(self.key))
        return _reported(self.ids[r]), _reported(self.donor[r, c]), self.sign * self.key[r, c]


def presence(x: np.ndarray) -> np.ndarray:
    """A number for each row that rows with the same present coordinates share."""
    bits = np.packbits(~np.isnan(x), axis=1)
    wide = np.zeros((len(x), max(8, -(-bits.shape[1] // 8) * 8)), np.uint8)
    wide[:, :bits.shape[1]] = bits
    words = wide.view("<u8")
    return np.unique(words[:, 0] if words.shape[1] == 1 else words, axis=None if words.shape[1] == 1 else 0, return_inverse=True)[1].reshape(-1)


class NearestPresent:
    """For each query and each of its missing columns the k nearest donors (nan-euclidean) that have
    the column. ``t`` (queries, columns) are distances that the k-th best is known not to exceed."""

    def __init__(self, ids, x, k, t=None):
        self.ids, self.x, self.k, self.miss = keys_of(ids), x, k, np.isnan(x)
        self.t = np.where(self.miss, np.inf if t is None else t, -np.inf)       # of each missing column
        none = np.zeros(0, np.int64)
        self.r, self.c, self.donor, self.dist, self.value = none, none, none, np.zeros(0), np.zeros(0)
        self.kind, self.single = presence(self.x), True

    def bound(self, rows) -> np.ndarray:
        return self.t[rows].max(axis=1, initial=-np.inf)

    def meet(self, rows: np.ndarray, dids: np.ndarray, d: np.ndarray, kinds: np.ndarray | None = None) -> None:
        """``rows`` of the queries against donors; ``kinds`` are ``presence(d)``, if known. Rows of one pattern
        share the coordinates of their distance, so theirs is a plain euclidean one."""
        kinds, own = presence(d) if kinds is None else kinds, self.kind[rows]
        some, count = np.unique(kinds, return_counts=True)
        mine, number = np.unique(own, return_counts=True)
        few = rows[np.isin(own, mine[number < ALIKE_QUERIES])]
        for kind in some[count >= ALIKE_DONORS]:
            at = np.flatnonzero(kinds == kind)
            ids, x = dids[at], d[at]
            for m in mine[number >= ALIKE_QUERIES]:
                alike = rows[own == m]
                for a in range(0, len(ids), DONORS):
                    for b in range(0, len(alike), QUERIES):
                        self._alike(alike[b:b + QUERIES], ids[a:a + DONORS], x[a:a + DONORS])
            self._any(few, ids, x)
        rare = np.isin(kinds, some[count < ALIKE_DONORS])
        self._any(rows, dids[rare], d[rare])

    def _alike(self, rows, dids, d):
        """Queries of one presence pattern against donors of one."""
        known, have = ~self.miss[rows[0]], ~np.isnan(d[0])
        cols, fill = np.flatnonzero(known & have), np.flatnonzero(~known & have)
        if not len(cols) or not len(fill):
            return
        bound, p, n = self.t[rows][:, fill].max(axis=1), d.shape[1], len(d)
        y = d[:, cols]
        mu = y.mean(axis=0)
        q, c = self.x[rows][:, cols] - mu, y - mu
        qn, dn = (q * q).sum(axis=1), (c * c).sum(axis=1)
        if not np.isfinite(qn.max() + dn.max()):
            return self._any(rows, dids, d)
        cut = bound * bound * (len(cols) / p) * (1 + 1e-9) - qn
        at = None
        if self.single and len(cols) >= SINGLE_DIMS and qn.max() + dn.max() < 1e30:
            at = self._near(q, c, qn, dn, cut, np.float32)
            if len(at) > (64 + 4 * self.k) * len(rows):      # its error lets too many through
                at, self.single = None, False
        if at is None:
            at = self._near(q, c, qn, dn, cut, np.float64)
        x = self.x[rows][:, cols]
        for a in range(0, len(at), _PAIRS):
            r, c = np.divmod(at[a:a + _PAIRS], n)
            total = np.zeros(len(r))
            for diff in np.ascontiguousarray((x[r] - y[c]).T):      # terms added left to right as SQL does
                total += diff * diff
            r, dist = rows[r], np.sqrt(total * (p / len(cols)))
            i, f = np.nonzero(np.isfinite(dist)[:, None] & (dist[:, None] <= self.t[r][:, fill]))
            self._merge(r[i], fill[f], dids[c[i]], dist[i], d[c[i], fill[f]])

    def _near(self, q, c, qn, dn, cut, kind):
        """Places of the pairs whose squared distance less qn may be within ``cut`` and among the k best here."""
        eps = 4.0 * (c.shape[1] + 2) * np.finfo(kind).eps * (qn + dn.max()) + np.finfo(kind).tiny * 4 * (c.shape[1] + 2)
        near = np.column_stack([-2.0 * q, np.ones(len(q))]).astype(kind, copy=False) @ np.column_stack([c, dn]).astype(kind, copy=False).T
        with np.errstate(over="ignore"):
            cut = np.nextafter((cut + 2 * eps).astype(kind), kind(np.inf))
        hit = np.flatnonzero(near.min(axis=1) <= cut)
        near, cut, eps, n = near[hit], cut[hit], eps[hit], len(c)
        within = near <= cut[:, None]
        many = np.flatnonzero(within.sum(axis=1) > 4 * self.k + 16) if self.k < n else []
        if len(many):                                       # every donor has every column wanted
            some = near[many]
            kth = np.partition(some, self.k - 1, axis=1)[:, self.k - 1]
            tight = np.nextafter((kth + 2 * eps[many]).astype(kind), kind(np.inf))
            within[many] = some <= np.minimum(tight, cut[many])[:, None]
        at = np.flatnonzero(within)
        return hit[at // n] * n + at % n

    def _any(self, rows, dids, d):
        for a in range(0, len(dids), DONORS):
            for b in range(0, len(rows), QUERIES):
                self._chunk(rows[b:b + QUERIES], dids[a:a + DONORS], d[a:a + DONORS])

    def _chunk(self, rows, dids, d):
        have = ~np.isnan(d)
        p, n = d.shape[1], len(d)
        with np.errstate(invalid="ignore"):
            mu = np.where(have, d, 0.0).sum(axis=0) / np.maximum(have.sum(axis=0), 1)
        known = ~self.miss[rows]
        q, c = np.where(known, self.x[rows] - mu, 0.0), np.where(have, d - mu, 0.0)
        kq, kd = known.astype("float64"), have.astype("float64")
        bound = self.bound(rows)
        t2 = np.where(np.isfinite(bound), bound * bound * (1 + 1e-9), 0.0)
        eps = 4.0 * (3 * p + 2) * np.finfo("float64").eps * ((q * q).sum(axis=1) + (c * c).sum(axis=1).max() + t2)
        # the sum over shared coordinates, less what the bound allows for as many of them
        right = np.concatenate([kd, c * c, c], axis=1).T
        near = np.concatenate([q * q - (t2 / p)[:, None] * kq, kq, -2.0 * q], axis=1) @ right
        cut = 2 * eps
        cut[bound == -np.inf] = -np.inf                     # nothing is missing
        open_ = np.flatnonzero(bound == np.inf)
        wanted = near <= cut[:, None]
        if len(open_):
            shared = kq[open_] @ kd.T
            with np.errstate(invalid="ignore", divide="ignore"):
                some = np.where(shared > 0, near[open_] * (p / shared), np.inf)
            slack = (2 * eps[open_] * p)
            mark = np.zeros(some.shape, bool)
            for col in np.flatnonzero(self.miss[rows[open_]].any(axis=0)):
                at, can = np.flatnonzero(self.miss[rows[open_], col]), np.flatnonzero(have[:, col])
                if not len(can):
                    continue
                sub = some[np.ix_(at, can)]
                kth = np.partition(sub, self.k - 1, axis=1)[:, self.k - 1] if self.k < len(can) else np.full(len(at), np.inf)
                r, c_ = np.nonzero((sub <= (kth + slack[at])[:, None]) & np.isfinite(sub))
                mark[at[r], can[c_]] = True
            wanted[open_] = mark
        at = np.flatnonzero(wanted.ravel())
        for a in range(0, len(at), _PAIRS):
            self._score(*np.divmod(at[a:a + _PAIRS], n), rows, dids, d, have)

    def _score(self, r, c, rows, dids, d, have):
        r, p = rows[r], d.shape[1]
        total, shared = np.zeros(len(r)), np.zeros(len(r))
        for j in range(p):                                  # terms added left to right as SQL does
            diff = self.x[r, j] - d[c, j]
            ok = ~np.isnan(diff)
            total += np.where(ok, diff * diff, 0.0)
            shared += ok
        dist = np.sqrt(np.where(shared > 0, total * (p / np.maximum(shared, 1)), np.nan))
        ok = np.isfinite(dist)
        r, c, dist = r[ok], c[ok], dist[ok]
        i, col = np.nonzero(have[c] & (dist[:, None] <= self.t[r]))
        r, c, dist = r[i], c[i], dist[i]
        self._merge(r, col, dids[c], dist, d[c, col])

    def _merge(self, r, col, donor, dist, value):
        if not len(r):
            return
        new = {"r": r, "c": col, "donor": donor, "dist": dist, "value": value}
        touched = np.zeros(len(self.x), bool)
        touched[r] = True
        old = touched[self.r]
        both = {n: np.concatenate([getattr(self, n)[old], v]) for n, v in new.items()}
        best = _firsts(both["dist"], both["donor"], (both["r"], both["c"]), k=self.k)
        both = {n: v[best] for n, v in both.items()}
        full = np.flatnonzero((both["r"][self.k - 1:] == both["r"][:len(best) - self.k + 1])
                              & (both["c"][self.k - 1:] == both["c"][:len(best) - self.k + 1])) + self.k - 1
        self.t[both["r"][full], both["c"][full]] = np.minimum(self.t[both["r"][full], both["c"][full]], both["dist"][full])
        for n, v in both.items():
            setattr(self, n, np.concatenate([getattr(self, n)[~old], v]))

    def rows(self):
        return _reported(self.ids[self.r]), self.c, _reported(self.donor), self.dist, self.value


def frame(columns: dict, values) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series(v, dtype=t) for (n, t), v in zip(columns.items(), values)})
