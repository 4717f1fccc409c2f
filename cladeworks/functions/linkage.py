"""Numpy helpers of one task: the last merges of a small group of clusters (H3), and the cap on clones (H6)."""

from __future__ import annotations

import heapq

import numpy as np

#: Fixed values of the order among equal distances; products stay below 2^63.
TIE_MODULUS, TIE_FACTOR = 2_147_483_647, 1_103_515_245
#: Distances are compared to this many digits, so that ties survive sums in another order.
DIGITS = 9


def tie(a, b):
    """Order of the pairs ``a < b`` at one distance: mixed, so that many ties merge in few rounds."""
    x = (a % TIE_MODULUS * TIE_FACTOR + b) % TIE_MODULUS
    return (x * x + b) % TIE_MODULUS


def heights(s, na, nb, pa, pb, method: str):
    """Distances of clusters from the sums over their members' pairs.

    ``average``: ``s`` holds similarities between the two. ``ward``: ``s`` holds squared
    distances between the two, ``pa`` and ``pb`` those within each.
    """
    if method == "average":
        return np.round(1 - s / (na * nb), DIGITS)
    return np.round(np.sqrt(np.maximum(2 * ((pa + pb + s) / (na + nb) - pa / na - pb / nb), 0)), DIGITS)


def merge_clusters(a, b, s, size: dict, within: dict, threshold: float, method: str) -> dict[int, int]:
    """Where each cluster goes when the nearest two merge, one pair at a time, up to ``threshold``.

    ``a, b, s``: pairs of cluster ids with their sums (a pair that is missing has 0).
    A merged cluster keeps the smaller id. Of equal distances the smallest :func:`tie`
    merges first, then the smallest pair.
    """
    ids = np.array(sorted(size))
    at = {x: i for i, x in enumerate(ids.tolist())}
    m = len(ids)
    n, p = np.array([size[x] for x in ids.tolist()], float), np.array([within[x] for x in ids.tolist()], float)
    i, j = np.array([at[x] for x in a], int), np.array([at[x] for x in b], int)
    total = np.zeros((m, m))
    total[i, j] = total[j, i] = s
    h = heights(total, n[:, None], n[None, :], p[:, None], p[None, :], method)
    np.fill_diagonal(h, np.inf)
    nearest = h.min(axis=1) if m else np.zeros(0)
    goes = np.arange(m)
    for _ in range(m - 1):
        low = nearest.min()
        if not low <= threshold:
            break
        rows = np.flatnonzero(nearest == low)
        x, y = np.nonzero(h[rows] == low)
        x = rows[x]
        x, y = x[x < y], y[x < y]
        k = np.lexsort((y, x, tie(ids[x], ids[y])))[0]
        i, j = x[k], y[k]
        goes[goes == j] = i
        stale = (h[:, i] == nearest) | (h[:, j] == nearest)
        p[i] += p[j] + total[i, j]
        n[i] += n[j]
        total[i] += total[j]
        total[:, i] = total[i]
        new = heights(total[i], n[i], n, p[i], p, method)
        new[np.isinf(h[i]) | (np.arange(m) == j)] = np.inf
        h[i], h[:, i] = new, new
        h[j], h[:, j] = np.inf, np.inf
        stale[[i, j]] = True
        nearest = np.minimum(nearest, new)
        nearest[stale] = h[stale].min(axis=1)
    return dict(zip(ids.tolist(), ids[goes].tolist(), strict=True))


def merge_mutual(total: np.ndarray, n: np.ndarray, p: np.ndarray, ids: np.ndarray, threshold: float, method: str) -> np.ndarray:
    """For each of the sorted ``ids`` the smallest id of its cluster, merging up to ``threshold``.

    Same result as :func:`merge_clusters`, but all pairs that are each other's nearest
    merge in one round, and the matrix of sums ``total`` shrinks with it.
    """
    home, names = np.arange(len(ids)), ids
    while len(names) > 1:
        h = heights(total, n[:, None], n[None, :], p[:, None], p[None, :], method)
        np.fill_diagonal(h, np.inf)
        low = h.min(axis=1)
        live = np.flatnonzero(low <= threshold)
        if not len(live):
            break
        near = np.full(len(names), -1)
        for rows in np.array_split(live, max(1, len(live) * len(names) >> 20)):
            order = np.where(h[rows] == low[rows, None], tie(np.minimum(names[rows, None], names), np.maximum(names[rows, None], names)), TIE_MODULUS)
            near[rows] = order.argmin(axis=1)
        i = live[(near[near[live]] == live) & (live < near[live])]
        j = near[i]
        within = p[i] + p[j] + total[i, j]
        total[i] += total[j]
        total[:, i] += total[:, j]
        n, p = n.copy(), p.copy()
        n[i] += n[j]
        p[i] = within
        stays = np.ones(len(names), bool)
        stays[j] = False
        to = np.arange(len(names))
        to[j] = i
        home = (np.cumsum(stays) - 1)[to][home]
        total, n, p, names = total[np.ix_(stays, stays)], n[stays], p[stays], names[stays]
    return names[home]


class _Kinds:
    """State of :func:`merge_kinds`: a row of ``h`` for each kind, the clusters of each by the smallest place."""

    def __init__(self, total, n, p, at, ids, method):
        self.s, self.n, self.p, self.at, self.ids, self.method = total, n, p, at, ids, method
        self.many = np.array([len(x) for x in at])
        self.into = np.arange(len(ids))
        self.h = heights(total, n[:, None], n[None, :], p[:, None], p[None, :], method)
        self.h[np.diag_indices(len(n))] = np.where(self.many > 1, self.h.diagonal(), np.inf)
        self.low = self.h.min(axis=1)

    def row(self) -> int:
        """A free row; the matrices grow where none is."""
        free = np.flatnonzero(self.many == 0)
        if len(free):
            return free[0]
        old = len(self.n)
        self.s, self.h = (np.pad(x, (0, old), constant_values=v) for x, v in ((self.s, 0.0), (self.h, np.inf)))
        self.n, self.p, self.many = (np.pad(x, (0, old), constant_values=v) for x, v in ((self.n, 1.0), (self.p, 0.0), (self.many, 0)))
        self.low = np.pad(self.low, (0, old), constant_values=np.inf)
        self.at.extend(np.zeros(0, int) for _ in range(old))
        return old

    def update(self, changed: list[int]) -> None:
        """Heights of the kinds ``changed``, whose sums, sizes and clusters are known, and the nearest of all."""
        stale = (self.h[:, changed] == self.low[:, None]).any(axis=1) & np.isfinite(self.low)
        for k in changed:
            new = heights(self.s[k], self.n[k], self.n, self.p[k], self.p, self.method)
            new[self.many == 0] = np.inf
            if self.many[k] < 2:
                new[k] = np.inf
            if self.many[k] == 0:
                new[:] = np.inf
            self.h[k] = self.h[:, k] = new
            self.low = np.minimum(self.low, new)
        stale[changed] = True
        self.low[stale] = self.h[stale].min(axis=1)

    def put(self, k: int, sums: np.ndarray, n: float, p: float, places: np.ndarray) -> None:
        """One cluster of those with the smallest ``places`` as the kind ``k``."""
        self.into[places] = places.min()
        self.s[k] = self.s[:, k] = sums
        self.n[k], self.p[k], self.at[k], self.many[k] = n, p, places.min(keepdims=True), 1

    def collapse(self, kinds: np.ndarray) -> None:
        """All clusters of ``kinds``, each two at the same distance, become one."""
        m, own = self.many[kinds].astype(float), self.s[np.ix_(kinds, kinds)]
        p = (m * self.p[kinds]).sum() + (m @ own @ m - m @ own.diagonal()) / 2
        places = np.concatenate([self.at[k] for k in kinds])
        sums, n = m @ self.s[kinds], (m * self.n[kinds]).sum()
        self.many[kinds] = 0
        self.put(kinds[0], sums, n, p, places)
        self.update(list(kinds))

    def nearest_of(self, one: int, places: np.ndarray, count: int) -> np.ndarray:
        """Which ``count`` of ``places`` the cluster ``one`` takes in, the smallest :func:`tie` with what it is by then first."""
        if count == len(places):
            return places
        taken = []
        while count:
            order = places[np.argsort(tie(self.ids[np.minimum(one, places)], self.ids[np.maximum(one, places)]), kind="stable")][:count]
            less = np.flatnonzero(order < one)
            order = order[: less[0] + 1] if len(less) else order  # from here on it has another name
            taken.append(order)
            one, count, places = min(one, order[-1]), count - len(order), np.setdiff1d(places, order)
        return np.concatenate(taken)

    def absorb(self, a: int, t: int, threshold: float) -> None:
        """The one cluster of kind ``a`` takes in clusters of kind ``t`` while these are nearest to it and it to them."""
        m, done, step = int(self.many[t]), 0, 64
        others = self.h[t].copy()
        others[[a, t]] = np.inf
        other, own = others.min(), self.h[t, t]
        alive = (self.many > 0) & (np.arange(len(self.n)) != a)
        while done < m:
            j = np.arange(done, min(done + step, m))
            grown = self.n[a] + j * self.n[t]
            p = self.p[a] + j * (self.s[a, t] + self.p[t]) + j * (j - 1) / 2 * self.s[t, t]
            h = heights(self.s[a][None, alive] + j[:, None] * self.s[t][None, alive], grown[:, None], self.n[None, alive], p[:, None], self.p[None, alive], self.method)
            here = np.flatnonzero(np.flatnonzero(alive) == t)[0]
            to = h[:, here].copy()
            h[:, here] = np.inf
            good = (to <= threshold) & (to < h.min(axis=1)) & (to < np.where(m - j > 1, np.minimum(own, other), other))
            good[0] |= not done  # the pair that was found
            run = len(j) if good.all() else int(good.argmin())
            done, step = done + run, 2 * step
            if run < len(j):
                break
        one = self.at[a][0]
        taken = self.nearest_of(one, self.at[t], done)
        p = self.p[a] + done * (self.s[a, t] + self.p[t]) + done * (done - 1) / 2 * self.s[t, t]
        self.at[t], self.many[t] = np.setdiff1d(self.at[t], taken), m - done
        self.put(a, self.s[a] + done * self.s[t], self.n[a] + done * self.n[t], p, np.append(taken, one))
        self.update([a, t])

    def one_pair(self, kinds: np.ndarray, low: float) -> None:
        """Of all pairs of clusters of ``kinds`` at the distance ``low`` the one with the smallest :func:`tie` merges."""
        best = None
        for k, j in zip(*np.nonzero(np.triu(self.h[np.ix_(kinds, kinds)] == low)), strict=True):
            k, j = kinds[k], kinds[j]
            wide = max(1, (1 << 20) // len(self.at[j]))
            for i in range(0, len(self.at[k]), wide):
                x, y = (z.ravel() for z in np.broadcast_arrays(self.at[k][i : i + wide, None], self.at[j]))
                x, y = np.minimum(x, y)[x != y], np.maximum(x, y)[x != y]
                if len(x):
                    t = tie(self.ids[x], self.ids[y])
                    f = np.lexsort((y, x, t))[0] if len(x) < 64 else min(np.flatnonzero(t == t.min()), key=lambda f: (x[f], y[f]))
                    best = min(best or (np.inf,), (t[f], x[f], y[f], k, j))
        _, x, y, k, j = best
        sums, n, p = self.s[k] + self.s[j], self.n[k] + self.n[j], self.p[k] + self.p[j] + self.s[k, j]
        for q in {k, j}:
            self.at[q] = self.at[q][(self.at[q] != x) & (self.at[q] != y)]
            self.many[q] = len(self.at[q])
        to = self.row()
        self.put(to, np.pad(sums, (0, len(self.n) - len(sums))), n, p, np.array([x, y]))
        self.update(list({k, j, to}))


def merge_kinds(total: np.ndarray, n: np.ndarray, p: np.ndarray, names: list[np.ndarray], threshold: float, method: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids, and for each the smallest id of its cluster, merging up to ``threshold``.

    Same result as :func:`merge_clusters` where many clusters are alike: those of one kind
    have the same sums with all others. ``names`` holds the ids of each kind, ``total[k, l]``
    the sum between a cluster of kind ``k`` and another of kind ``l``, ``n`` and ``p`` the size
    and the sum within. Clusters that are all at one distance from each other, nearer
    than any other, merge at once, and so does what one cluster takes in of one kind; so
    matrices and steps grow with the kinds.
    """
    ids = np.sort(np.concatenate(names))
    x = _Kinds(total.astype(float), n.astype(float), p.astype(float), [np.searchsorted(ids, np.sort(k)) for k in names], ids, method)
    while True:
        first = int(x.low.argmin())
        low = x.low[first]
        if not low <= threshold:
            break
        kinds = np.array([first])
        while True:
            more = np.flatnonzero((x.h[kinds] == low).any(axis=0))
            more = np.union1d(kinds, more)
            if len(more) == len(kinds):
                break
            kinds = more
        near = x.h[np.ix_(kinds, kinds)] == low
        alone = (x.many[kinds] == 1) & np.eye(len(kinds), dtype=bool)
        if (near | alone).all():
            x.collapse(kinds)
        elif len(kinds) == 2 and not near.diagonal().any() and (x.many[kinds] == 1).any():
            a, t = kinds if x.many[kinds[0]] == 1 else kinds[::-1]
            x.absorb(a, t, threshold)
        else:
            x.one_pair(kinds, low)
    into = x.into
    while (into[into] != into).any():
        into = into[into]
    return ids, ids[into]


#: Points by points whose similarities are made at a time, small enough for a processor's cache.
NEAR_POINTS = 1 << 17
#: What similarities in single precision are off by at most.
SLACK = 1e-5


def jaccard(words: np.ndarray, size: np.ndarray, a, b) -> np.ndarray:
    """Jaccard similarities (two empty sets: 0) of the sets ``a`` and ``b``, given as rows of 64-bit words; ``size`` gives their precision."""
    both = np.bitwise_count(words[a, None, 0] & words[None, b, 0]).astype(size.dtype)
    for w in range(1, words.shape[1]):
        both += np.bitwise_count(words[a, None, w] & words[None, b, w])
    of = size[a, None] + size[None, b]
    of -= both
    np.maximum(of, 1, out=of)
    return np.divide(both, of, out=both)


def near_lists(words: np.ndarray, weight: np.ndarray, starts: np.ndarray, lo: int, hi: int, least: float, most: int):
    """For each of the clusters ``lo`` to ``hi`` all clusters of at least a similarity: this similarity, how many they are, and which.

    Clusters are runs of points, from ``starts`` on. The similarity is ``least``, or that of
    the ``most``-th nearest where more would be listed.
    """
    ends = np.append(starts[1:], len(words))
    size = np.bitwise_count(words).sum(axis=1).astype(np.float32)
    n = np.add.reduceat(weight.astype(float), starts)
    single = len(starts) == len(words)
    blocks, at = [], 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + 4096, "right")))
        blocks.append((at, to))
        at = to
    cut, many, found = np.full(hi - lo, least), np.zeros(hi - lo, int), []
    at = lo
    while at < hi:
        to = min(hi, max(at + 1, int(np.searchsorted(ends, starts[at] + 32, "right"))))
        sim = np.zeros((to - at, len(starts)), np.float32)
        for x, y in blocks:
            tall = max(1, NEAR_POINTS // (ends[y - 1] - starts[x]))
            for i in range(starts[at], ends[to - 1], tall):
                rows = slice(i, min(i + tall, ends[to - 1]))
                part = jaccard(words, size, rows, slice(starts[x], ends[y - 1]))
                if single:
                    sim[i - starts[at] : rows.stop - starts[at], x:y] = part
                    continue
                part = np.add.reduceat(part * weight[None, starts[x] : ends[y - 1]], starts[x:y] - starts[x], axis=1) * weight[rows, None]
                first = np.searchsorted(ends, i, "right")
                own = np.maximum(starts[first : np.searchsorted(starts, rows.stop)] - i, 0)
                sim[first - at : first - at + len(own), x:y] += np.add.reduceat(part, own, axis=0) / (n[first : first + len(own), None] * n[None, x:y])
        sim[np.arange(to - at), np.arange(at, to)] = -1
        r, c = np.nonzero(sim >= least - SLACK)
        count = np.bincount(r, minlength=to - at)
        for k in np.flatnonzero(count > most):
            cut[at - lo + k] = max(least, float(np.partition(sim[k], -most)[-most]))
        keep = sim[r, c] >= cut[at - lo + r] - SLACK
        many[at - lo : to - lo] = np.bincount(r[keep], minlength=to - at)
        found.append(c[keep].astype(np.int32))
        at = to
    return cut, many, np.concatenate(found)


def merge_listed(words: np.ndarray, weight: np.ndarray, starts: np.ndarray, names: np.ndarray, cut: np.ndarray, lists: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each cluster the smallest name of what it is merged into by average linkage up to ``threshold``, and whether that waits for new lists.

    Clusters are runs of points, sets with a ``weight`` each; ``lists`` holds for each all
    clusters of the similarity ``cut`` and more (:func:`near_lists`). A merged cluster is no nearer
    to another than one of its parts was, so its list comes from theirs, and what is in
    neither has less than the mean of their cuts. Merges as :func:`merge_clusters` does,
    except where a list doesn't say which cluster is the nearest: that one waits, and
    so does each whose nearest waits.
    """
    k = len(starts)
    size = np.bitwise_count(words).sum(axis=1).astype(float)
    weight = weight.astype(float)
    points = np.split(np.arange(len(words)), starts[1:]) + [None] * k
    held = np.append(np.diff(np.append(starts, len(words))), np.zeros(k, int))
    one = np.append(np.where(held[:k] == 1, starts, -1), np.full(k, -1))
    n = np.append(np.add.reduceat(weight, starts), np.zeros(k))
    names, cut = (np.append(x, np.zeros(k, x.dtype)) for x in (names, cut))
    now, waits, lists, sums = np.arange(2 * k), np.zeros(2 * k, bool), lists + [None] * k, [None] * (2 * k)
    least = 1 - threshold - 10**-DIGITS

    def between(x: int, others: np.ndarray) -> np.ndarray:
        at = one[others]
        out, big = np.zeros(len(others)), at < 0
        for which in (~big, big):
            if not which.any():
                continue
            own = at[which] if which is not big else np.concatenate([points[o] for o in others[big]])
            total, tall = 0.0, max(1, NEAR_POINTS // len(own))
            for i in range(0, len(points[x]), tall):
                part = points[x][i : i + tall]
                total = total + weight[part] @ jaccard(words, size, part, own)
            total *= weight[own]
            out[which] = total if which is not big else np.add.reduceat(total, np.cumsum(held[others[big]]) - held[others[big]])
        return out

    def current(ids: np.ndarray) -> np.ndarray:
        out = now[ids]
        while (now[out] != out).any():
            out = now[out]
        now[ids] = out
        return out

    def keep(x: int, ids: np.ndarray, s: np.ndarray) -> None:
        good = s >= n[x] * n[ids] * least
        lists[x], sums[x] = ids[good], s[good]

    def push(x: int) -> None:
        ids = lists[x]
        if not len(ids):
            waits[x] = cut[x] - SLACK / 2 > least
            return
        h = heights(sums[x], n[x], n[ids], 0, 0, "average")
        low = np.flatnonzero(h == h.min())
        y = ids[low]
        t = tie(np.minimum(names[x], names[y]), np.maximum(names[x], names[y]))
        f = int(t.argmin())
        if h[low[f]] <= threshold:
            heapq.heappush(heap, (float(h[low[f]]), int(t[f]), x, int(y[f])))
        else:
            waits[x] = cut[x] - SLACK / 2 > least

    heap: list = []
    for x in range(k):
        keep(x, lists[x], between(x, lists[x]))
        push(x)
    z = k
    while heap:
        h, _, x, y = heapq.heappop(heap)
        if now[x] != x:
            continue
        if now[y] != y:
            to = current(lists[x])
            same = to == lists[x]
            new = np.unique(to[~same])
            keep(x, np.append(lists[x][same], new), np.append(sums[x][same], between(x, new)))
            push(x)
            continue
        unsure = [c for c in (x, y) if cut[c] - SLACK / 2 > max(least, 1 - h)]
        waits[unsure] = True
        if waits[x] or waits[y]:
            waits[x] = True
            continue
        ids = np.append(lists[x], lists[y])
        now[[x, y]] = z
        ids = np.unique(current(ids))
        ids = ids[ids != z]
        points[z], held[z], n[z], names[z] = np.append(points[x], points[y]), held[x] + held[y], n[x] + n[y], min(names[x], names[y])
        cut[z] = max(least, (n[x] * cut[x] + n[y] * cut[y]) / n[z])
        lists[x] = lists[y] = sums[x] = sums[y] = points[x] = points[y] = None
        keep(z, ids, between(z, ids))
        push(z)
        z += 1
    to = current(np.arange(k))
    return names[to], waits[to]


def shared_counts(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """How many codes each set of the left shares with each of the right.

    ``a``: the codes of all sets of the left, one set behind the other, ``na`` how many each has.
    """
    both = np.zeros((len(na), len(nb)), np.float32)
    names = np.intersect1d(a, b)
    if not len(names):
        return both
    found = []
    for codes, n in ((a, na), (b, nb)):
        at = np.minimum(np.searchsorted(names, codes), len(names) - 1)
        known = names[at] == codes
        found.append((np.repeat(np.arange(len(n)), n)[known], at[known]))
    (i, x), (j, y) = found
    order = np.argsort(y, kind="stable")
    j, y = j[order], y[order]
    first, many = np.searchsorted(y, np.arange(len(names))), np.bincount(y, minlength=len(names))
    meet = many[x]
    if 100 * meet.sum() < both.size * len(names):  # few pairs share a code: count those
        flat = both.ravel()
        for part in np.array_split(np.arange(len(x)), max(1, int(meet.sum()) >> 21)):
            m = meet[part]
            at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first[x[part]], m)
            key, n = np.unique(np.repeat(i[part], m) * len(nb) + j[at], return_counts=True)
            flat[key] += n
        return both
    for k in range(0, len(names), 1024):
        has = []
        for row, code, n in ((i, x, len(na)), (j, y, len(nb))):
            here = (code >= k) & (code < k + 1024)
            m = np.zeros((n, min(1024, len(names) - k)), np.float32)
            m[row[here], code[here] - k] = 1
            has.append(m)
        both += has[0] @ has[1].T
    return both


def cluster_sums(values, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over points by their clusters: the clusters of both sides, and a matrix.

    ``a``, ``b``: the clusters of points, sorted. ``values(rows, columns)`` gives the
    matrix of two slices of points, small enough for a processor's cache.
    """
    (ua, fa), (ub, fb) = (np.unique(x, return_index=True) for x in (a, b))
    out = np.zeros((len(ua), len(ub)))
    wide = 2048
    tall = max(1, (1 << 16) // min(wide, len(b)))
    for y in range(0, len(b), wide):
        j0, j1 = np.searchsorted(fb, y, "right") - 1, np.searchsorted(fb, min(y + wide, len(b)))
        starts_b = np.maximum(fb[j0:j1] - y, 0)
        for x in range(0, len(a), tall):
            i0, i1 = np.searchsorted(fa, x, "right") - 1, np.searchsorted(fa, min(x + tall, len(a)))
            part = values(slice(x, x + tall), slice(y, y + wide))
            part = np.add.reduceat(part, starts_b, axis=1) if len(starts_b) < part.shape[1] else part
            starts_a = np.maximum(fa[i0:i1] - x, 0)
            out[i0:i1, j0:j1] += np.add.reduceat(part, starts_a, axis=0) if len(starts_a) < len(part) else part
    return ua, ub, out


def nearest(s, na, nb, pa, pb, ids, others, threshold: float, method: str, same: bool):
    """Clusters ``ids`` that have one of ``others`` up to ``threshold``, the best of each, its distance and :func:`tie`.

    The first three are places. Arguments as in :func:`heights`, a side in each; with
    ``same`` both sides are the same clusters.
    """
    if method == "average":
        near, least = np.empty(s.shape, bool), (1 - threshold - 2 * 10**-DIGITS) * nb
        for x in range(0, len(s), 32):
            np.greater_equal(s[x : x + 32], na[x : x + 32, None] * least, out=near[x : x + 32])
    else:
        h = heights(s, na[:, None], nb[None, :], pa[:, None], pb[None, :], method)
        if same:
            np.fill_diagonal(h, np.inf)
        near = (h == h.min(axis=1)[:, None]) & (h <= threshold)
    if same:
        np.fill_diagonal(near, False)
    r, c = np.nonzero(near)
    h = heights(s[r, c], na[r], nb[c], pa[r], pb[c], method)
    r, c, h = r[h <= threshold], c[h <= threshold], h[h <= threshold]
    t = tie(np.minimum(ids[r], others[c]), np.maximum(ids[r], others[c]))
    order = np.lexsort((others[c], t, h, r))
    first = order[np.unique(r[order], return_index=True)[1]]
    return r[first], c[first], h[first], t[first]


def merge_smallest(sizes: list[tuple[str, int]], n: int) -> dict[str, str]:
    """Where each clone goes when the smallest joins the second smallest until ``n`` are left.

    ``sizes`` in existing order, which also breaks ties.
    """
    heap = [(size, k) for k, (_, size) in enumerate(sizes)]
    heapq.heapify(heap)
    into = list(range(len(sizes)))
    while len(heap) > max(n, 1):
        size, low = heapq.heappop(heap)
        into[low] = heap[0][1]
        heapq.heapreplace(heap, (heap[0][0] + size, heap[0][1]))
    for k in range(len(into)):
        way = [k]
        while into[way[-1]] != way[-1]:
            way.append(into[way[-1]])
        for x in way:
            into[x] = way[-1]
    return {name: sizes[into[k]][0] for k, (name, _) in enumerate(sizes)}
