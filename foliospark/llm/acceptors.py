"""Minimised acyclic acceptors of sorted byte words, and their composition with a one-edit transducer.

``Acceptor`` holds the trie of the words and its minimal automaton: trie nodes with the same right language are one
state, found by height, each state's leaving arcs numbered exactly. A state's words are numbered in sorted order, so
a path's rank is the sum of its arcs' skips and no word is spelled again.

``near_pairs`` composes acceptor, transducer and acceptor. A composed state is (x, 0, x) before the edit and (y, 1, z)
after it: two targets of x for a replaced symbol, a target of x and x itself for an inserted one, where the next
symbol of the other side must differ, so that every pair has one path. States behind the edit advance together along
equal labels, all of them at once; where y = z everything below is accepted without another step.
"""

from __future__ import annotations

import numpy as np


class Acceptor:
    def __init__(self, words: list[bytes]):
        """``words``: distinct, not empty, in sorted order."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data, begins = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes
        self._trie(sizes, data, begins)
        self._minimise()

    def _trie(self, sizes: np.ndarray, data: np.ndarray, begins: np.ndarray) -> None:
        """Nodes by depth with the first word below each; arcs as (source, label, target)."""
        rows, node = np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
        lows, depths, counts, final, sources, labels = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.array([len(sizes)])], [], [], []
        made, depth = 1, 0
        while len(rows):
            ended = sizes[rows] == depth
            final.append(node[ended])
            rows, node = rows[~ended], node[~ended]
            if not len(rows):
                break
            label = data[begins[rows] + depth]
            first = np.ones(len(rows), bool)
            first[1:] = (node[1:] != node[:-1]) | (label[1:] != label[:-1])
            at = np.flatnonzero(first)
            sources.append(node[at])
            labels.append(label[at])
            lows.append(rows[at])
            counts.append(np.diff(np.append(at, len(rows))))
            depth += 1
            depths.append(np.full(len(at), depth))
            node = made + np.cumsum(first) - 1
            made += len(at)
        self.low, self.depth, self.count = (np.concatenate(x) for x in (lows, depths, counts))
        self.final = np.zeros(made, bool)
        self.final[np.concatenate(final)] = True
        self.source = np.concatenate(sources) if sources else np.zeros(0, np.int64)
        self.label = np.concatenate(labels).astype(np.int64) if labels else np.zeros(0, np.int64)
        self.levels = np.cumsum([len(x) for x in lows])

    def _minimise(self) -> None:
        """``state`` of each trie node, and the arcs of the states, sorted by state and label."""
        nodes = len(self.low)
        target = np.arange(1, nodes)                     # the arc that made node k + 1 is arc k
        height = np.zeros(nodes, np.int64)
        for start, end in zip(self.levels[-2::-1], self.levels[:0:-1], strict=True):
            np.maximum.at(height, self.source[start - 1:end - 1], height[start:end] + 1)
        degree = np.bincount(self.source, minlength=nodes)
        by_source = np.lexsort((self.label, self.source))
        first_arc = np.cumsum(degree) - degree
        self.state = np.zeros(nodes, np.int64)
        order = np.argsort(height, kind="stable")
        ends = np.cumsum(np.bincount(height))
        made, chosen = 0, []
        for start, end in zip(ends - np.diff(ends, prepend=0), ends, strict=True):
            members = order[start:end]
            sign = self.final[members].astype(np.int64)
            for k in range(int(degree[members].max())):
                more = np.flatnonzero(degree[members] > k)
                arcs = by_source[first_arc[members[more]] + k]
                key = (sign[more] * 256 + self.label[arcs]) * (made + 1) + self.state[target[arcs]]
                sign[more] = np.unique(key, return_inverse=True)[1]
            key = sign * 257 + degree[members]
            _, at, inverse = np.unique(key, return_index=True, return_inverse=True)
            self.state[members] = made + inverse
            chosen.append(members[at])
            made += len(at)
        self.node_of = np.concatenate(chosen)            # a trie node of each state
        self.ends_here, self.size = self.final[self.node_of], self.count[self.node_of]
        self.degree = degree[self.node_of]
        self.begin = np.cumsum(self.degree) - self.degree
        arcs = by_source[_spread(first_arc[self.node_of], self.degree)]
        owner = np.repeat(np.arange(made), self.degree)
        self.to, self.skip = self.state[target[arcs]], self.low[target[arcs]] - self.low[self.node_of[owner]]
        self.key = owner * 256 + self.label[arcs]


def _spread(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each, one after another."""
    return np.arange(counts.sum()) + np.repeat(begins - (np.cumsum(counts) - counts), counts)


def near_pairs(a: Acceptor, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of two words one edit apart whose first difference lies at ``depth`` (of each word) or behind; each pair once."""
    allowed = a.depth >= depth[a.low]
    wanted = np.zeros(len(a.node_of), bool)
    wanted[a.state[allowed]] = True
    origin, left, right = _edits(a, np.flatnonzero(wanted))
    per_state = np.bincount(origin, minlength=len(a.node_of))
    by_state = np.argsort(origin, kind="stable")
    begins = np.cumsum(per_state) - per_state
    nodes = np.flatnonzero(allowed)
    nodes = nodes[per_state[a.state[nodes]] > 0]
    counts = per_state[a.state[nodes]]
    at, base = by_state[_spread(begins[a.state[nodes]], counts)], np.repeat(a.low[nodes], counts)
    return base + left[at], base + right[at]


def _edits(a: Acceptor, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of ranks in each state's language whose edit leaves that state."""
    degree, begin = a.degree[states], a.begin[states]
    # an arc and each later one of the same state: a replaced symbol
    arcs = _spread(begin, degree)
    later = np.repeat(begin + degree, degree) - arcs - 1
    one, two = np.repeat(arcs, later), _spread(arcs + 1, later)
    # an arc against staying: an inserted symbol
    origin = np.concatenate((a.key[one], a.key[arcs])) >> 8
    y, z = np.concatenate((a.to[one], a.to[arcs])), np.concatenate((a.to[two], a.key[arcs] >> 8))
    rank_y = np.concatenate((a.skip[one], a.skip[arcs]))
    rank_z = np.concatenate((a.skip[two], np.zeros(len(arcs), np.int64)))
    barred = np.concatenate((np.full(len(one), -1), a.key[arcs] & 255))
    found = []
    while len(origin):
        same = y == z
        counts = np.where(same, a.size[y], (a.ends_here[y] & a.ends_here[z]).astype(np.int64))
        at = np.repeat(np.arange(len(origin)), counts)
        step = _spread(np.zeros(len(origin), np.int64), counts)
        found.append((origin[at], rank_y[at] + step, rank_z[at] + step))
        keep = ~same
        origin, y, z, rank_y, rank_z, barred = (x[keep] for x in (origin, y, z, rank_y, rank_z, barred))
        swap = a.degree[y] > a.degree[z]                 # walk the arcs of the side that has fewer
        y, z = np.where(swap, z, y), np.where(swap, y, z)
        rank_y, rank_z = np.where(swap, rank_z, rank_y), np.where(swap, rank_y, rank_z)
        counts = a.degree[y]
        at, arcs = np.repeat(np.arange(len(y)), counts), _spread(a.begin[y], counts)
        label = a.key[arcs] & 255
        asked = z[at] * 256 + label
        other = np.minimum(np.searchsorted(a.key, asked), max(len(a.key) - 1, 0))
        go = (a.key[other] == asked) & (label != barred[at]) if len(a.key) else np.zeros(0, bool)
        at, arcs, other = at[go], arcs[go], other[go]
        origin, y, z = origin[at], a.to[arcs], a.to[other]
        rank_y, rank_z = rank_y[at] + a.skip[arcs], rank_z[at] + a.skip[other]
        barred = np.full(len(at), -1)
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
