r"""Weighted acyclic automata that hold the counts of n-grams.

An automaton reads the words of an n-gram; the weight of the state it ends in
is the n-gram's count (0: a prefix only). States are numbered per depth, so all
arcs go one depth down. States with the same weight and the same arcs are one
state: the many n-grams that occur once and go on alike share their tails.

``Trie`` is the unshared form, one node per n-gram, its nodes sorted per depth
by parent and word, that is in the order of the n-grams. Tries are built from
sorted shard n-grams, added up (``union``) and cut at given n-grams (``cut``)
by whole arrays; ``pack`` merges the equal states for storage and ``unpack``
spells the automaton out again.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import zstandard

# Odd multipliers of the two hashes that name equal states.
LANES = ((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9), (0xD1B54A32D192ED03, 0x94D049BB133111EB))
LEVEL = 3  # compression of stored automata
BETWEEN = b"\xff"  # between stored labels; no part of UTF-8


def _mix(h: np.ndarray, by: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(by)
    return h ^ (h >> np.uint64(29))


def _grouped(keys: np.ndarray, kind: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(distinct keys, group of every key, sort order, first place of every
    group in that order)``. A ``stable`` sort makes use of runs that are sorted."""
    order = np.argsort(keys, kind=kind)
    held = keys[order]
    new = np.ones(len(held), bool)
    np.not_equal(held[1:], held[:-1], out=new[1:])
    first = np.flatnonzero(new)
    group = np.empty(len(keys), np.int32)
    group[order] = np.cumsum(new, dtype=np.int32) - 1
    return held[first], group, order, first


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[i], start[i]+1, ...`` (``size[i]`` of them), one after another."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class Trie:
    """``labels``: the distinct words, sorted. Per depth from 1: ``parent``
    (node of the depth above), ``word`` (its label's number) and ``weight``."""

    def __init__(self, labels: list[bytes], levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.labels, self.levels = labels, levels

    @property
    def nodes(self) -> int:
        return sum(len(level[0]) for level in self.levels)

    @classmethod
    def of_words(cls, labels: list[bytes], groups: np.ndarray, words: np.ndarray, longest: int) -> Trie:
        """Counts all n-grams up to ``longest`` words of a text given as label
        numbers, -1 standing between pieces. Every n-gram begins with its
        group's label (``groups`` beside ``words``), whose weight is the number
        of words."""
        span = np.int64(len(labels) + 1)
        at = np.flatnonzero(words >= 0).astype(np.int32)
        found, node, _, first = _grouped(groups[at])
        levels = [(np.zeros(len(found), np.int32), found.astype(np.int32), np.diff(np.append(first, len(at))))]
        for depth in range(longest):
            if depth:  # n-grams that go on inside their piece
                more = at + depth < len(words)
                at, node = at[more], node[more]
                more = words[at + depth] >= 0
                at, node = at[more], node[more]
            key, node, _, first = _grouped(node * span + words[at + depth])
            levels.append(((key // span).astype(np.int32), (key % span).astype(np.int32), np.diff(np.append(first, len(at)))))
        return cls(labels, levels)

    def children(self, depth: int) -> np.ndarray:
        """First child of every node of a depth (from 0, the root), and the end."""
        parents = self.levels[depth][0] if depth < len(self.levels) else np.zeros(0, np.int64)
        n = 1 if depth == 0 else len(self.levels[depth - 1][0])
        return np.searchsorted(parents, np.arange(n + 1))

    @classmethod
    def union(cls, tries: list[Trie]) -> Trie:
        """The n-grams of all tries with their weights added up."""
        if len(tries) == 1:
            return tries[0]
        labels = sorted(set().union(*[t.labels for t in tries]))
        number = {w: i for i, w in enumerate(labels)}
        renamed = [np.fromiter(map(number.__getitem__, t.labels), np.int32, len(t.labels)) for t in tries]
        span = np.int64(len(labels) + 1)
        mapped = [np.zeros(1, np.int32) for _ in tries]
        levels = []
        for depth in range(max(len(t.levels) for t in tries)):
            own = [t.levels[depth] if depth < len(t.levels) else (np.zeros(0, np.int64),) * 3 for t in tries]
            keys = np.concatenate([m[p] * span + r[w] for (p, w, _), m, r in zip(own, mapped, renamed)])
            found, node, order, first = _grouped(keys, "stable")
            weight = np.concatenate([w for _, _, w in own])[order]
            ends = np.cumsum([0, *[len(p) for p, _, _ in own]])
            mapped = [node[a:b] for a, b in zip(ends, ends[1:])]
            levels.append(((found // span).astype(np.int32), (found % span).astype(np.int32),
                           np.add.reduceat(weight, first) if len(first) else weight))
        return cls(labels, levels)

    def at_least(self, weight: int, inner: int) -> Trie:
        """The nodes of at least ``weight`` and their prefixes (weight 0 where
        lighter). Depths up to ``inner`` keep their weights."""
        levels, wanted = [], None
        for depth in range(len(self.levels), 0, -1):
            parent, word, own = self.levels[depth - 1]
            heavy = own >= (weight if depth > inner else 1)
            keep = heavy.copy()
            if wanted is not None:
                keep[wanted] = True
            moved = np.cumsum(keep) - 1
            if levels:  # the parents of the depth below are numbered anew
                below = levels[-1]
                levels[-1] = (moved[below[0]], below[1], below[2])
            levels.append((parent[keep], word[keep], np.where(heavy, own, 0)[keep]))
            wanted = np.unique(parent[keep]) if depth > 1 else None
        return Trie(self.labels, levels[::-1]).trimmed()

    def trimmed(self) -> Trie:
        """Without the labels that no node has."""
        used = np.unique(np.concatenate([w for _, w, _ in self.levels] or [np.zeros(0, np.int64)]))
        if len(used) == len(self.labels):
            return self
        return Trie([self.labels[i] for i in used.tolist()],
                    [(p, np.searchsorted(used, w), n) for p, w, n in self.levels])

    def firsts(self, bounds: list[tuple[bytes, ...]]) -> list[np.ndarray]:
        """Per depth and bound the first node whose n-gram is not before the
        bound (a prefix comes before what goes on from it)."""
        m = len(bounds)
        longest = max([len(b) for b in bounds], default=0)
        known = {w: i for i, w in enumerate(self.labels)}
        # words in steps of two: odd numbers are labels, even ones lie between
        code = np.full((m, max(longest, len(self.levels))), -1, np.int64)
        for i, bound in enumerate(bounds):
            for j, w in enumerate(bound):
                k = known.get(w)
                code[i, j] = 2 * k + 1 if k is not None else 2 * bisect_left(self.labels, w)
        span = np.int64(2 * len(self.labels) + 3)
        path = np.zeros(m, np.int64)         # node that spells the bound so far, or -1
        first = np.zeros(m, np.int64)        # first node not before the bound
        out = []
        for depth, (parent, word, _) in enumerate(self.levels):
            keys = parent * span + 2 * word + 1
            step = code[:, depth]
            on = (path >= 0) & (step >= 0)
            # off the bound's path, or past its end: the children of later nodes
            later = self.children(depth)[first]
            look = np.searchsorted(keys, path * span + step)
            hit = on & (look < len(keys))
            hit[hit] = keys[look[hit]] == (path * span + step)[hit]
            ends = np.array([len(b) for b in bounds]) == depth + 1
            # a prefix of the bound lies before it; the bound itself does not
            first = np.where(on, look + (hit & ~ends), later)
            path = np.where(hit, look, -1)
            out.append(first)
        return out

    def cut(self, bounds: list[tuple[bytes, ...]]):
        """``(number, trie)`` of the ranges between the bounds (number 0: before
        the first one) that hold n-grams. Prefixes from other ranges have
        weight 0."""
        firsts = self.firsts(bounds)
        edges = [np.concatenate(([0], f, [len(level[0])])) for f, level in zip(firsts, self.levels)]
        filled = np.flatnonzero(sum(np.diff(e) for e in edges)) if edges else []
        for r in filled:
            levels, reach = [], None
            for depth in range(len(self.levels), 0, -1):
                parent, word, weight = self.levels[depth - 1]
                low, high = int(edges[depth - 1][r]), int(edges[depth - 1][r + 1])
                own = low
                if reach is not None:  # a prefix may lie before the range
                    low, high = min(low, reach[0]), max(high, reach[1] + 1)
                if low < high:
                    value = weight[low:high].copy()
                    at = np.arange(low, high)
                    value[(at < own) | (at >= int(edges[depth - 1][r + 1]))] = 0
                    if levels:
                        below = levels[-1]
                        levels[-1] = (below[0] - low, below[1], below[2])
                    levels.append((parent[low:high], word[low:high], value))
                    reach = (int(parent[low]), int(parent[high - 1]))
                elif levels:
                    raise AssertionError("a node without its parent")
            if levels:
                levels[-1] = (np.zeros(len(levels[-1][0]), np.int64), *levels[-1][1:])
                yield int(r), Trie(self.labels, levels[::-1]).trimmed()

    def pack(self) -> bytes:
        """The automaton, equal states merged."""
        parts: list[np.ndarray] = []
        state = np.zeros(0, np.int32)  # of the nodes of the depth below
        names = [np.zeros(0, np.uint64)] * 2
        for depth in range(len(self.levels), -1, -1):
            weight = self.levels[depth - 1][2] if depth else np.zeros(1, np.int64)
            first = self.children(depth)
            if depth < len(self.levels):
                word = self.levels[depth][1].astype(np.uint64)
                arc = [_mix(_mix(word * np.uint64(a) + n, b) + np.uint64(a), a) for (a, b), n in zip(LANES, names)]
                arcs = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(h))) for h in arc]
                sums = [s[first[1:]] - s[first[:-1]] for s in arcs]
            else:
                sums = [np.zeros(len(weight), np.uint64)] * 2
            names = [_mix(_mix(weight.astype(np.uint64) * np.uint64(b) + s, a) + np.uint64(b), b)
                     for (a, b), s in zip(LANES, sums)]
            # two lanes of 64 bits name a state
            order = np.argsort(names[0])
            held = [n[order] for n in names]
            new = np.ones(len(order), bool)
            new[1:] = held[0][1:] != held[0][:-1]
            if (~new[1:] & (held[1][1:] != held[1][:-1])).any():  # one lane is not enough
                order = np.lexsort((names[1], names[0]))
                held = [n[order] for n in names]
                new[1:] = (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])
            # the first node of each state
            one = np.minimum.reduceat(order, np.flatnonzero(new)) if len(order) else order
            by_node = np.argsort(one)  # states are numbered as they are met
            rank = np.empty(len(one), np.int32)
            rank[by_node] = np.arange(len(one), dtype=np.int32)
            number = np.empty(len(order), np.int32)
            number[order] = rank[np.cumsum(new) - 1]
            one = one[by_node]
            size = (first[1:] - first[:-1])[one]
            places = _places(first[:-1][one], size)
            word = self.levels[depth][1][places] if depth < len(self.levels) else places
            parts += [weight[one], size, word, state[places] if depth < len(self.levels) else places]
            state = number
        words = BETWEEN.join(self.labels)
        head = np.array([len(self.levels), len(words), *[len(p) for p in parts]], np.int64)
        # words and targets as steps from their neighbours
        body = b"".join(_narrow(_steps(p) if i % 4 > 1 else p) for i, p in enumerate(parts))
        return zstandard.ZstdCompressor(level=LEVEL).compress(head.tobytes() + words + body)

    @classmethod
    def unpack(cls, data: bytes) -> Trie:
        """The n-grams of an automaton, depth by depth from its start."""
        labels, states = unpack_states(data)
        at = np.zeros(1, np.int64)
        levels = []
        for depth in range(len(states) - 1):
            _, offset, word, to = states[depth]
            size = (offset[1:] - offset[:-1])[at]
            places = _places(offset[:-1][at], size)
            parent = np.repeat(np.arange(len(at), dtype=np.int32), size)
            at = to[places]
            levels.append((parent, word[places].astype(np.int32), states[depth + 1][0][at]))
        return cls(labels, levels)


def _steps(a: np.ndarray) -> np.ndarray:
    """Differences of neighbours; steps back become odd numbers."""
    step = np.diff(a.astype(np.int64), prepend=0)
    return np.where(step < 0, -2 * step - 1, 2 * step)


def _from_steps(step: np.ndarray) -> np.ndarray:
    return np.cumsum(np.where(step & 1, -((step + 1) >> 1), step >> 1))


def _narrow(a: np.ndarray) -> bytes:
    """An array of whole numbers from 0 in the narrowest type, named first;
    lowest bytes of all numbers first, then the next ones."""
    top = int(a.max()) if len(a) else 0
    kind = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([kind]) + a.astype(f"<u{kind}").view(np.uint8).reshape(-1, kind).T.tobytes()


def unpack_states(data: bytes) -> tuple[list[bytes], list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
    """The labels, and ``(weight, offset of the first arc, arcs' words, arcs'
    targets)`` per depth, the start's first."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    depths, size = np.frombuffer(raw, np.int64, 2).tolist()
    sizes = np.frombuffer(raw, np.int64, 4 * (depths + 1), 16).tolist()
    at = 16 + 32 * (depths + 1)
    labels = raw[at:at + size].split(BETWEEN) if size or depths else []
    at, parts = at + size, []
    for i, n in enumerate(sizes):
        kind = raw[at]
        planes = np.frombuffer(raw, np.uint8, n * kind, at + 1).reshape(kind, n)
        part = np.ascontiguousarray(planes.T).view(f"<u{kind}").reshape(-1).astype(np.int64)
        parts.append(_from_steps(part) if i % 4 > 1 else part)
        at += 1 + kind * n
    return labels, [(w, np.concatenate(([0], np.cumsum(size))), word, to)
                    for w, size, word, to in (parts[i:i + 4] for i in range(0, len(parts), 4))][::-1]


class Lookup:
    """Composition of an automaton with n-grams: each n-gram is an acceptor of
    one path, and the product follows it arc by arc."""

    def __init__(self, data: bytes):
        labels, self.states = unpack_states(data)
        self.span = len(labels) + 1
        self.number = {w: i for i, w in enumerate(labels)}
        self.keys = [np.repeat(np.arange(len(offset) - 1), np.diff(offset)) * self.span + word
                     for _, offset, word, _ in self.states]

    def weights(self, grams: list[tuple[bytes, ...]]) -> np.ndarray:
        """The weight of each n-gram, 0 where the automaton has none."""
        m = len(grams)
        deepest = max(map(len, grams), default=0)
        get = self.number.get
        word = np.full((m, deepest), -1, np.int64)
        for i, gram in enumerate(grams):
            word[i, :len(gram)] = [get(w, self.span - 1) for w in gram]
        at, found = np.zeros(m, np.int64), np.zeros(m, np.int64)
        live = np.ones(m, bool)
        for depth in range(deepest + 1):
            if depth < len(self.states):
                ends = live & (word[:, depth] < 0 if depth < deepest else True)
                found[ends] = self.states[depth][0][at[ends]]
                live &= ~ends
            if depth == deepest or depth + 1 >= len(self.states):
                break
            key = at * self.span + word[:, depth]
            place = np.searchsorted(self.keys[depth], key)
            live &= place < len(self.keys[depth])
            live[live] = self.keys[depth][place[live]] == key[live]
            at[live] = self.states[depth][3][place[live]]
        return found
