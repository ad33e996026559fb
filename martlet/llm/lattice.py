"""Segmentation lattices over a fixed public piece vocabulary: forward and forward-backward sums, many words at a time.

A word is its UTF-8 bytes behind one blank, so a piece that starts a word starts with the blank and words never share a
piece; a document's lattice is the product of its words' lattices. Every single byte is a piece (the
vocabulary's byte pieces), so every word has a segmentation.

Words are sorted by length and processed side by side: at each position the substrings ending there are looked up, by a 64-bit
rolling hash, among the pieces of their length. Sums are in log space. Words above ``LONG`` bytes go one by one with exact lookups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

LONG = 192
#: Cells (words times bytes) held at once.
CELLS = 400_000
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def load_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece model and the log probabilities its scores stand for.

    Scores of a merge vocabulary are negated merge ranks; the unigram score of a piece is Zipf's law at that rank. Pieces that
    could match only across words are left out; bytes without a piece of their own get one, last in rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rank: dict[bytes, float] = {}
    raw: list[bytes] = []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        text = model.id_to_piece(i)
        if model.is_byte(i):
            raw.append(bytes((int(text[3:5], 16),)))
            continue
        piece = text.replace("▁", " ").encode()
        if piece and b" " not in piece[1:]:
            rank.setdefault(piece, -model.get_score(i))
    last = max(rank.values(), default=0) + 1
    for b in raw or [bytes((b,)) for b in range(256)]:
        rank.setdefault(b, last)
    for b in range(256):
        rank.setdefault(bytes((b,)), last)
    pieces = sorted(rank, key=lambda p: (rank[p], p))
    weight = 1 / (np.array([max(rank[p], 0) for p in pieces]) + 2.7)
    return pieces, np.log(weight / weight.sum())


class Lattice:
    def __init__(self, pieces: list[bytes]):
        self.number = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        by_length: dict[int, list[tuple[int, int]]] = {}
        for i, p in enumerate(pieces):
            h = 0
            for c in p:
                h = (h * _BASE + c + 1) & _MASK
            by_length.setdefault(len(p), []).append((h, i))
        self.tables = []
        for k in sorted(by_length):
            pairs = sorted(by_length[k])
            self.tables.append((k, np.uint64(pow(_BASE, k, 1 << 64)), np.array([h for h, _ in pairs], np.uint64),
                                np.array([i for _, i in pairs], np.int64)))

    def chunks(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Positions and words, longest first, in pieces of about ``CELLS`` cells; ``LONG`` ones are left to the caller."""
        order = sorted((i for i, w in enumerate(words) if len(w) < LONG), key=lambda i: -len(words[i]))
        at = 0
        while at < len(order):
            n = max(1, CELLS // (len(words[order[at]]) + 2))
            part = order[at:at + n]
            yield np.array(part), [b" " + words[i] for i in part]
            at += n

    def arcs(self, words: list[bytes]) -> Iterator[tuple[int, int, list[tuple[int, np.ndarray, np.ndarray]]]]:
        """For each end position: it, how many words reach it, and (length, word positions, pieces) of the arcs."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        top = int(lengths[0])
        body = np.frombuffer(b"".join(w.ljust(top, b"\0") for w in words), np.uint8).reshape(len(words), top)
        prefix = np.zeros((top + 1, len(words)), np.uint64)
        base = np.uint64(_BASE)
        for j in range(top):
            prefix[j + 1] = prefix[j] * base + body[:, j].astype(np.uint64) + np.uint64(1)
        for j in range(1, top + 1):
            n, found = int(np.searchsorted(-lengths, -j, side="right")), []
            for k, power, hashes, ids in self.tables:
                if k > j:
                    break
                sub = prefix[j, :n] - prefix[j - k, :n] * power
                at = np.searchsorted(hashes, sub)
                at[at == len(hashes)] = 0
                idx = np.flatnonzero(hashes[at] == sub)
                if len(idx):
                    found.append((k, idx, ids[at[idx]]))
            yield j, n, found

    def forward(self, words: list[bytes], logp: np.ndarray) -> np.ndarray:
        """Natural-log marginal probability of each word under each column of ``logp`` (pieces x models)."""
        out = np.zeros((len(words), logp.shape[1]))
        for at, part in self.chunks(words):
            alpha = np.full((len(part[0]) + 1, len(part), logp.shape[1]), -np.inf)
            alpha[0] = 0
            for j, n, found in self.arcs(part):
                best, sums, values = np.full((n, logp.shape[1]), -np.inf), np.zeros((n, logp.shape[1])), []
                for k, idx, ids in found:
                    v = alpha[j - k, idx] + logp[ids]
                    best[idx] = np.maximum(best[idx], v)
                    values.append(v)
                for (_, idx, _), v in zip(found, values, strict=True):
                    sums[idx] += np.exp(v - best[idx])
                alpha[j, :n] = best + np.log(sums)
            out[at] = alpha[[len(w) for w in part], np.arange(len(part))]
        for i, w in enumerate(words):
            if len(w) >= LONG:
                out[i] = [self._one(b" " + w, logp[:, c])[0][-1] for c in range(logp.shape[1])]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, logp: np.ndarray, model: np.ndarray) -> np.ndarray:
        """Expected piece counts (pieces x models), each word counted for its own model's column."""
        total = np.zeros(logp.size)
        flat = logp.T.ravel()  # model-major
        size = logp.shape[0]
        for at, part in self.chunks(words):
            shift, weight = model[at] * size, counts[at]
            alpha = np.full((len(part[0]) + 1, len(part)), -np.inf)
            alpha[0] = 0
            kept = []
            for j, n, found in self.arcs(part):
                best, sums, values = np.full(n, -np.inf), np.zeros(n), []
                for k, idx, ids in found:
                    v = alpha[j - k, idx] + flat[ids + shift[idx]]
                    best[idx] = np.maximum(best[idx], v)
                    values.append(v)
                for (_, idx, _), v in zip(found, values, strict=True):
                    sums[idx] += np.exp(v - best[idx])
                alpha[j, :n] = best + np.log(sums)
                kept.append((j, found))
            ends = np.array([len(w) for w in part])
            whole = alpha[ends, np.arange(len(part))]
            beta = np.full(alpha.shape, -np.inf)
            beta[ends, np.arange(len(part))] = 0
            seen, mass = [], []
            for j, found in reversed(kept):
                for k, idx, ids in found:
                    right = flat[ids + shift[idx]] + beta[j, idx]
                    beta[j - k, idx] = np.logaddexp(beta[j - k, idx], right)
                    seen.append(ids + shift[idx])
                    mass.append(np.exp(alpha[j - k, idx] + right - whole[idx]) * weight[idx])
            total += np.bincount(np.concatenate(seen), np.concatenate(mass), minlength=logp.size)
        for i, w in enumerate(words):
            if len(w) >= LONG:
                column = logp[:, model[i]]
                alpha, arcs = self._one(b" " + w, column)
                beta = [-math.inf] * len(alpha)
                beta[-1] = 0.0
                for a, b, p in reversed(arcs):
                    right = column[p] + beta[b]
                    total[model[i] * size + p] += math.exp(alpha[a] + right - alpha[-1]) * counts[i]
                    beta[a] = float(np.logaddexp(beta[a], right))
        return total.reshape(logp.shape[1], size).T

    def _one(self, word: bytes, column: np.ndarray) -> tuple[list[float], list[tuple[int, int, int]]]:
        """Forward sums of one word and its arcs (start, end, piece) by end position."""
        alpha, arcs, number = [0.0], [], self.number
        for j in range(1, len(word) + 1):
            values = []
            for a in range(max(0, j - self.longest), j):
                p = number.get(word[a:j])
                if p is not None:
                    arcs.append((a, j, p))
                    values.append(alpha[a] + column[p])
            best = max(values)
            alpha.append(best + math.log(sum(math.exp(v - best) for v in values)))
        return alpha, arcs
