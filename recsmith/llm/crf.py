"""A small linear-chain conditional random field on numpy batches.

Sequences of one batch are padded to a common length; every token has the same number of
hashed feature numbers.  Training is full-batch AdaGrad on the penalised log-likelihood with
forward-backward in log space; decoding is Viterbi over the whole batch at once, long sequences
in blocks of tokens."""

from __future__ import annotations

import numpy as np

NEVER = -1e4


class Crf:
    def __init__(self, labels: list[str], buckets: int):
        self.labels, self.buckets = labels, buckets
        k = len(labels)
        self.emit = np.zeros((buckets, k))
        self.trans = np.zeros((k, k))
        self.start = np.zeros(k)
        # an inside label follows the begin or inside label of its own kind only
        inside = [x.startswith("I-") for x in labels]
        self.allowed = np.array([[not (b[:2] == "I-" and a[2:] != b[2:]) or a[2:] == b[2:] != "" for b in labels]
                                 for a in labels])
        self.start_allowed = ~np.array(inside)

    def _scores(self, feats: np.ndarray, forced_out: np.ndarray):
        emit = self.emit[feats].sum(axis=2)
        emit[:, :, 1:][forced_out] = NEVER
        return (emit, np.where(self.allowed, self.trans, NEVER), np.where(self.start_allowed, self.start, NEVER))

    def fit(self, feats, forced_out, gold, lengths, rounds: int = 200, rate: float = 0.5, penalty: float = 1e-3):
        """``feats`` (n, t, f) feature numbers, ``gold`` (n, t) label numbers, ``lengths`` (n,)."""
        n, t, _ = feats.shape
        k = len(self.labels)
        live = np.arange(t)[None, :] < lengths[:, None]
        want = np.eye(k)[gold] * live[..., None]
        pairs = np.einsum("ntk,ntl->kl", want[:, :-1], want[:, 1:])
        square = [np.full_like(x, 1e-6) for x in (self.emit, self.trans, self.start)]
        for _ in range(rounds):
            emit, trans, start = self._scores(feats, forced_out)
            alpha, beta = np.empty((n, t, k)), np.zeros((n, t, k))
            alpha[:, 0] = start + emit[:, 0]
            for i in range(1, t):
                step = np.logaddexp.reduce(alpha[:, i - 1, :, None] + trans, axis=1) + emit[:, i]
                alpha[:, i] = np.where(live[:, i, None], step, alpha[:, i - 1])
            for i in range(t - 2, -1, -1):
                step = np.logaddexp.reduce(trans + (emit[:, i + 1] + beta[:, i + 1])[:, None, :], axis=2)
                beta[:, i] = np.where(live[:, i + 1, None], step, 0)
            norm = np.logaddexp.reduce(alpha[:, -1], axis=1)
            marginal = np.exp(alpha + beta - norm[:, None, None]) * live[..., None]
            both = np.exp(alpha[:, :-1, :, None] + trans + (emit[:, 1:] + beta[:, 1:])[:, :, None, :]
                          - norm[:, None, None, None]) * live[:, 1:, None, None]
            grads = [np.zeros_like(self.emit), pairs - both.sum(axis=(0, 1)), (want[:, 0] - marginal[:, 0]).sum(axis=0)]
            np.add.at(grads[0], feats, (want - marginal)[:, :, None, :])
            for value, grad, sq in zip((self.emit, self.trans, self.start), grads, square):
                grad -= penalty * n * value
                sq += grad ** 2
                value += rate * grad / np.sqrt(sq)
        return self

    def decode(self, feats, forced_out, lengths) -> np.ndarray:
        """The best label numbers (n, t); positions past a sequence's length are 0."""
        return self.decode_blocks([(feats, forced_out)], lengths)

    def decode_blocks(self, blocks, lengths) -> np.ndarray:
        """``decode`` of sequences given as consecutive blocks (feats, forced_out) of their tokens:
        scores are carried from block to block, and only back pointers are kept of a block."""
        best, backs = None, []
        for feats, forced_out in blocks:
            emit, trans, start = self._scores(feats, forced_out)
            n, t, k = emit.shape
            back = np.zeros((n, t, k), dtype=np.int8)
            done = sum(b.shape[1] for b in backs)
            for i in range(t):
                if best is None:
                    best = start + emit[:, 0]
                    continue
                step = best[:, :, None] + trans
                on = (done + i < lengths)[:, None]
                back[:, i] = np.where(on, step.argmax(axis=1), np.arange(k))
                best = np.where(on, step.max(axis=1) + emit[:, i], best)
            backs.append(back)
        path = np.zeros((n, sum(b.shape[1] for b in backs)), dtype=np.int8)
        at, now = path.shape[1], best.argmax(axis=1)
        for back in reversed(backs):
            for i in range(back.shape[1] - 1, -1, -1):
                at -= 1
                path[:, at] = now
                now = back[np.arange(n), i, now]
        path[np.arange(path.shape[1])[None, :] >= lengths[:, None]] = 0
        return path
