"""A fixed public piece vocabulary, and all occurrences of its pieces in a batch of words by a suffix array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Where the public vocabulary lies on the driver; workers get its pieces by broadcast (32 000 short texts).
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of words that are indexed at once.
SLICE = 500_000


class Pieces:
    """The pieces of a vocabulary file: ``texts[i]``, ``scores[i]`` and model id ``ids[i]``; ``bytes_[b]`` the id of a byte."""

    def __init__(self, path: str = MODEL):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.GetPieceSize()
        self.ids = np.array([i for i in range(size) if not (
            model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i) or model.IsUnused(i))], np.int32)
        self.texts = [model.IdToPiece(int(i)) for i in self.ids]
        self.scores = [model.GetScore(int(i)) for i in self.ids]
        self.bytes_ = [model.PieceToId(f"<0x{b:02X}>") for b in range(256)]
        self.size = len(self.texts)
        self.longest = max(map(len, self.texts))
        self.lengths = np.array(list(map(len, self.texts)), np.int64)
        self.codes = np.zeros((self.size, self.longest), np.uint32)
        for row, text in zip(self.codes, self.texts):
            row[:len(text)] = [ord(c) + 1 for c in text]

    def occurrences(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """``offset`` of each word in the concatenation (an end mark after each), and all edges ``start, length, piece``
        sorted by start. A character that is no piece gives an edge of length one with piece ``size``.
        """
        lengths = np.array(list(map(len, words)), np.int64)
        offset = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
        total = int(lengths.sum()) + len(words)
        at = np.arange(int(lengths.sum())) + np.repeat(np.arange(len(words)), lengths)
        text = np.zeros(total, np.uint32)
        text[at] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32) + 1
        letters, rank = np.unique(np.append(text, 0), return_inverse=True)
        bits = max(1, int(len(letters) - 1).bit_length())
        per = 63 // bits
        count = -(-self.longest // per)

        padded = np.concatenate((rank[:-1], np.zeros(per * (count + 1), rank.dtype))).astype(np.int64)
        key = np.zeros(total + per * count, np.int64)
        for i in range(per):
            key = (key << bits) | padded[i:i + len(key)]
        keys = [key[i * per:i * per + total] for i in range(count)]
        suffixes = np.lexsort(keys[::-1])
        keys = [k[suffixes] for k in keys]

        present = np.zeros(0x110001, bool)
        present[letters] = True
        inside = np.flatnonzero(present[self.codes].all(axis=1))
        ranks = np.zeros((len(inside), per * count), np.int64)
        ranks[:, :self.longest] = np.searchsorted(letters, self.codes[inside])
        beyond = np.arange(per * count) >= self.lengths[inside][:, None]
        low = self._bisect(keys, self._packed(np.where(beyond, 0, ranks), bits, per), False)
        high = self._bisect(keys, self._packed(np.where(beyond, (1 << bits) - 1, ranks), bits, per), True)

        found = high - low
        piece = np.repeat(inside, found)
        nth = np.arange(int(found.sum())) - np.repeat(np.cumsum(found) - found, found)
        start = suffixes[np.repeat(low, found) + nth]
        length = self.lengths[piece]
        bare = np.ones(total, bool)
        bare[start[length == 1]] = False
        bare[offset + lengths] = False
        unknown = np.flatnonzero(bare)
        start = np.concatenate((start, unknown))
        length = np.concatenate((length, np.ones(len(unknown), np.int64)))
        piece = np.concatenate((piece, np.full(len(unknown), self.size)))
        order = np.argsort(start, kind="stable")
        return offset, lengths, start[order], length[order], piece[order]

    @staticmethod
    def _packed(ranks: np.ndarray, bits: int, per: int) -> list[np.ndarray]:
        keys = []
        for i in range(0, ranks.shape[1], per):
            key = np.zeros(len(ranks), np.int64)
            for j in range(i, i + per):
                key = (key << bits) | ranks[:, j]
            keys.append(key)
        return keys

    @staticmethod
    def _bisect(keys: list[np.ndarray], sought: list[np.ndarray], after: bool) -> np.ndarray:
        """The place of each sought key in the sorted suffixes, all by one binary search."""
        low, high = np.zeros(len(sought[0]), np.int64), np.full(len(sought[0]), len(keys[0]), np.int64)
        while (active := low < high).any():
            middle = np.minimum((low + high) >> 1, len(keys[0]) - 1)
            right, same = np.zeros(len(low), bool), np.ones(len(low), bool)
            for have, want in zip(keys, sought):
                here = have[middle]
                right |= same & (here < want)
                same &= here == want
            right = (right | same) if after else right
            low = np.where(active & right, middle + 1, low)
            high = np.where(active & ~right, middle, high)
        return low


def slices(words: list[str], limit: int = SLICE) -> Iterator[list[str]]:
    """``words`` in runs of about ``limit`` characters; a longer word is alone."""
    run, size = [], 0
    for word in words:
        if run and size + len(word) > limit:
            yield run
            run, size = [], 0
        run.append(word)
        size += len(word) + 1
    if run:
        yield run


def levels(offset: np.ndarray, lengths: np.ndarray, start: np.ndarray, length: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of edges (sorted by start) grouped by where in its word an edge ends, nearest first; by word within a group."""
    ends = start + length - np.repeat(offset, lengths + 1)[start]
    ends = ends.astype(np.uint16 if len(ends) and ends.max() < 1 << 16 else np.int64)
    order = np.argsort(ends, kind="stable")
    cuts = np.flatnonzero(np.diff(ends[order])) + 1
    return iter(np.split(order, cuts)) if len(order) else iter(())
