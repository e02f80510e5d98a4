"""Conditional random fields on sparse features: a linear chain fitted by its exact likelihood and decoded by Viterbi,
and a skip chain fitted by pseudo-likelihood and decoded by loopy sum-product messages.

Features are strings hashed into a fixed number of rows; a token has the same number of features everywhere, so scores
are sums of table rows. Fitting is full-batch and seeded: the same sample gives the same weights.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

ROWS = 1 << 13


def feature_rows(features) -> list[int]:
    """Table rows of one token's features; the position of a feature is part of its name."""
    return [zlib.crc32(f"{i}:{v}".encode()) % ROWS for i, v in enumerate(features)]


def _logsumexp(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class _Adam:
    def __init__(self, rate=0.1):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, name, weights, gradient):
        self.t += 1
        m = self.m[name] = 0.9 * self.m.get(name, 0.0) + 0.1 * gradient
        v = self.v[name] = 0.99 * self.v.get(name, 0.0) + 0.01 * gradient**2
        weights += self.rate * m / (np.sqrt(v) + 1e-8)


@dataclass
class Chain:
    """Linear-chain model. Outside a run of tokens everything is tag 0."""

    emission: np.ndarray  # rows x tags
    transition: np.ndarray  # tags x tags

    @classmethod
    def fit(cls, runs, n_tags: int, rounds: int = 80, decay: float = 1e-3) -> Chain:
        """runs: (token feature rows, tags) per run; maximises the likelihood of the tags by forward-backward sums."""
        model = cls(np.zeros((ROWS, n_tags)), np.zeros((n_tags, n_tags)))
        groups: dict[int, list] = {}
        for rows, tags in runs:
            if len(tags):
                groups.setdefault(len(tags), []).append((rows, tags))
        packed = [(np.array([r for r, _ in g]), np.array([t for _, t in g])) for g in groups.values()]
        total = sum(len(t) for _, t in packed) or 1
        adam = _Adam()
        for _ in range(rounds):
            g_e = -decay * model.emission
            g_t = -decay * model.transition
            for rows, tags in packed:
                node, edge = model._marginals(rows)
                n, length = tags.shape
                truth = np.zeros_like(node)
                truth[np.arange(n)[:, None], np.arange(length)[None, :], tags] = 1
                diff = (truth - node) / total
                for tag in range(n_tags):
                    weights = np.broadcast_to(diff[:, :, None, tag], rows.shape).ravel()
                    g_e[:, tag] += np.bincount(rows.ravel(), weights, ROWS)
                path = np.concatenate([np.zeros((n, 1), int), tags, np.zeros((n, 1), int)], axis=1)
                np.add.at(g_t, (path[:, :-1], path[:, 1:]), 1 / total)
                g_t -= edge / total
            adam.step("e", model.emission, g_e)
            adam.step("t", model.transition, g_t)
        return model

    def _marginals(self, rows):
        """Tag marginals per token and the expected counts of all transitions, borders included."""
        e, t = self.emission[rows].sum(2), self.transition
        n, length, k = e.shape
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0] + t[0]
        for i in range(1, length):
            fwd[:, i] = e[:, i] + _logsumexp(fwd[:, i - 1, :, None] + t[None], 1)
        bwd[:, -1] = t[:, 0]
        for i in range(length - 2, -1, -1):
            bwd[:, i] = _logsumexp(t[None] + (e[:, i + 1] + bwd[:, i + 1])[:, None, :], 2)
        z = _logsumexp(fwd[:, -1] + t[:, 0], 1)
        node = np.exp(fwd + bwd - z[:, None, None])
        edge = np.zeros((k, k))
        edge[0] += node[:, 0].sum(0)
        edge[:, 0] += node[:, -1].sum(0)
        for i in range(1, length):
            edge += np.exp(
                fwd[:, i - 1, :, None] + t[None] + (e[:, i] + bwd[:, i])[:, None, :] - z[:, None, None]
            ).sum(0)
        return node, edge

    def decode(self, rows) -> list[int]:
        """Viterbi: the best tags of one run."""
        return self.path(self.emission[np.asarray(rows)].sum(1))

    def path(self, e: np.ndarray) -> list[int]:
        """The best tags of one run, given the scores of its tokens (tokens x tags)."""
        t = self.transition
        best, back = e[0] + t[0], []
        for row in e[1:]:
            scores = best[:, None] + t
            back.append(scores.argmax(0))
            best = scores.max(0) + row
        tags = [int((best + t[:, 0]).argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]


@dataclass
class SkipChain:
    """Neighbouring tokens share `transition`; equal or similar distant tokens share `agreement`."""

    emission: np.ndarray
    transition: np.ndarray
    agreement: np.ndarray

    @classmethod
    def fit(cls, rows, tags, chain, skip, n_tags: int, rounds: int = 120, decay: float = 1e-3) -> SkipChain:
        """rows: nodes x features; chain, skip: edges as pairs of node numbers. Maximises the pseudo-likelihood."""
        model = cls(np.zeros((ROWS, n_tags)), np.zeros((n_tags, n_tags)), np.zeros((n_tags, n_tags)))
        n = len(tags)
        if not n:
            return model
        truth = np.eye(n_tags)[tags]
        adam = _Adam()
        for _ in range(rounds):
            x = model.emission[rows].sum(1)
            for edges, table in ((chain, model.transition), (skip, model.agreement)):
                if len(edges):
                    np.add.at(x, edges[:, 1], table[tags[edges[:, 0]]])
                    np.add.at(x, edges[:, 0], table[:, tags[edges[:, 1]]].T)
            p = np.exp(x - _logsumexp(x, 1)[:, None])
            diff = (truth - p) / n
            g = -decay * model.emission
            np.add.at(g, rows, np.broadcast_to(diff[:, None, :], (*rows.shape, n_tags)))
            for name, edges in (("transition", chain), ("agreement", skip)):
                table = getattr(model, name)
                gt = -decay * table
                if len(edges):
                    np.add.at(gt, tags[edges[:, 0]], diff[edges[:, 1]])
                    np.add.at(gt.T, tags[edges[:, 1]], diff[edges[:, 0]])
                adam.step(name, table, (gt + gt.T) / 2 if name == "agreement" else gt)
            adam.step("emission", model.emission, g)
        return model

    def marginals(
        self, rows, chain, skip, rounds: int = 500, damping: float = 0.3, settled: float = 1e-4, hubs=(), graph_of=None
    ):
        """Loopy sum-product on all graphs of a batch at once: log beliefs, nodes x tags.

        hubs: rows (hub, occurrence, node, listens). A node that listens gets one agreement message, from the node most
        clearly tagged among the other occurrences of its hubs; for two single-node occurrences that is a skip edge.
        graph_of: a graph number per node; a graph stays as it is once its messages are settled.
        """
        unary = self.emission[rows].sum(1)
        n, k = unary.shape
        edges = np.concatenate([np.asarray(chain).reshape(-1, 2), np.asarray(skip).reshape(-1, 2)]).astype(int)
        hubs = np.asarray(hubs, dtype=int).reshape(-1, 4)
        if not len(edges) and not len(hubs):
            return unary - _logsumexp(unary, 1)[:, None]
        graph_of = np.zeros(n, int) if graph_of is None else np.asarray(graph_of)
        tables = np.concatenate(
            [
                np.broadcast_to(self.transition, (len(chain), *self.transition.shape)),
                np.broadcast_to(self.agreement, (len(skip), *self.agreement.shape)),
            ]
        )
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        reverse = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        sent = np.zeros((len(source), k))
        heard = np.zeros((n, k))
        active = np.ones(graph_of.max(initial=0) + 1, bool)
        for turn in range(rounds):
            # a graph that swings is damped more
            keep = damping if turn < 100 else max(damping, 0.7)
            e = np.flatnonzero(active[graph_of[source]]) if len(source) else np.zeros(0, int)
            own = unary.copy()
            np.add.at(own, target, sent)
            out = _logsumexp(((own + heard)[source[e]] - sent[reverse[e]])[:, :, None] + tables[e], 1)
            out -= _logsumexp(out, 1)[:, None]
            change = np.zeros(len(active))
            np.maximum.at(change, graph_of[source[e]], np.abs(out - sent[e]).max(1, initial=0))
            if len(hubs):
                h = hubs[active[graph_of[hubs[:, 2]]]]
                new = self._heard(own, h)
                moved = active[graph_of]
                np.maximum.at(change, graph_of[moved], np.abs(new - heard)[moved].max(1, initial=0))
                heard[moved] = keep * heard[moved] + (1 - keep) * new[moved]
            sent[e] = keep * sent[e] + (1 - keep) * out
            active &= change >= settled
            if not active.any():
                break
        belief = unary + heard
        np.add.at(belief, target, sent)
        return belief - _logsumexp(belief, 1)[:, None]

    def _heard(self, own, hubs):
        """Messages over the hubs, given each node's belief without them; 0 for nodes that hear nothing."""
        out = np.zeros_like(own)
        if not len(hubs):
            return out
        own = own - _logsumexp(own, 1)[:, None]
        clear = own[:, 1:].max(1) - own[:, 0]
        # per hub its clearest occurrence, and the clearest node of another occurrence
        order = np.lexsort((hubs[:, 2], -clear[hubs[:, 2]], hubs[:, 0]))
        ranked = hubs[order]
        first = np.flatnonzero(np.r_[True, ranked[1:, 0] != ranked[:-1, 0]])
        size = np.diff(np.r_[first, len(ranked)])
        best = np.repeat(first, size)
        other = np.where(ranked[:, 1] != ranked[best, 1], np.arange(len(ranked)), len(ranked))
        second = np.repeat(np.minimum.reduceat(other, first), size)
        speaker = np.where(ranked[:, 1] == ranked[best, 1], second, best)
        heard = (ranked[:, 3] == 1) & (speaker < len(ranked))
        listener, speaker = ranked[heard, 2], ranked[speaker[heard], 2]
        # over several hubs the clearest speaker counts, once
        order = np.lexsort((speaker, -clear[speaker], listener))
        listener, speaker = listener[order], speaker[order]
        top = np.r_[True, listener[1:] != listener[:-1]] if len(listener) else np.zeros(0, bool)
        listener, speaker = listener[top], speaker[top]
        message = _logsumexp(own[speaker][:, :, None] + self.agreement, 1) if len(listener) else own[:0]
        out[listener] = message - _logsumexp(message, 1)[:, None] if len(listener) else message
        return out
