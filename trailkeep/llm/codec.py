"""SentencePiece encoding and decoding over a suffix array of each batch.

The distinct chunks of a batch are concatenated and indexed; every piece's occurrences are found by binary
search and become edges between text positions. The edges are relaxed by position: an edge extends the
encoding of the prefix before it if the pair of its piece and that prefix's last piece is one that merging by
score leaves apart. Exactly one edge does so at each position, which gives the vocabulary's own (merge) encoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import re
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from trailkeep.llm.common import map_arrow
from trailkeep.llm.pieces import MODEL, SPACE, Pieces, levels, slices

#: Chunks whose encoding a worker remembers, the longest chunk worth it, and the pairs of pieces it remembers.
REMEMBERED, LONGEST, PAIRS = 200_000, 40, 400_000
#: Characters of texts that are encoded at once.
AT_ONCE = 1_000_000


class Codec:
    """Encodes and decodes with a fixed vocabulary; ids and texts equal those of the vocabulary's own library."""

    def __init__(self, path: str = MODEL):
        self.pieces = p = Pieces(path)
        self.rank = {t: -s for t, s in zip(p.texts, p.scores)}
        number = {t: i for i, t in enumerate(p.texts)}
        self.left: list[list[tuple[str, float]]] = []
        self.right: list[list[tuple[str, float]]] = []
        whole = np.ones(p.size + 1, bool)
        for i, text in enumerate(p.texts):
            parts, split = self._merged(text)
            whole[i] = len(parts) == 1
            sides = []
            for side in (0, 1):
                spine, piece = [text], text
                while piece in split:
                    piece = split[piece][side]
                    spine.append(piece)
                spine.reverse()
                sides.append([(s, self.rank[spine[k + 1]] if k + 1 < len(spine) else np.inf) for k, s in enumerate(spine)])
            self.left.append(sides[0])
            self.right.append(sides[1])
        self.whole = whole
        self.ids = np.append(p.ids, -1)
        self.apart: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.raw = {int(i): t.replace(SPACE, " ").encode() for i, t in zip(p.ids, p.texts)}
        self.raw |= {i: bytes([b]) for b, i in enumerate(p.bytes_)}
        inner = any(SPACE in t.lstrip(SPACE) or "\n" in t for t in number)
        self.chunks = None if inner else re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def forget(self) -> None:
        """Give back what was remembered; a worker goes on to other work."""
        self.known.clear()
        self.apart.clear()

    def _merged(self, text: str) -> tuple[list[str], dict[str, tuple[str, str]]]:
        """The merge encoding of a short text, and what each merged part was made of."""
        parts, split = list(text), {}
        while True:
            ranked = [(self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank]
            if not ranked:
                return parts, split
            _, i = min(ranked)
            split[parts[i] + parts[i + 1]] = (parts[i], parts[i + 1])
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _stays_apart(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between pieces ``a`` and ``b``: follows both pieces' edge parts as they grow."""
        if a == self.pieces.size or b == self.pieces.size:
            return True
        lefts, rights, i, j = self.right[a], self.left[b], 0, 0
        while True:
            (x, x_until), (y, y_until) = lefts[i], rights[j]
            across = self.rank.get(x + y)
            if across is not None and across < x_until and across <= y_until:
                return False
            if x_until == y_until == np.inf:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _allowed(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        base = self.pieces.size + 1
        pairs, back = np.unique(before * base + piece, return_inverse=True)
        known, out = self.apart, np.empty(len(pairs), bool)
        if len(known) > PAIRS:
            known.clear()
        for n, pair in enumerate(pairs.tolist()):
            ok = known.get(pair)
            if ok is None:
                ok = known[pair] = self._stays_apart(*divmod(pair, base))
            out[n] = ok
        return out[back]

    def encode_chunks(self, words: list[str]) -> list[bytes]:
        """The ids of each non-empty chunk, as 32-bit numbers."""
        offset, lengths, start, length, piece = self.pieces.occurrences(words)
        use = self.whole[piece]
        start, length, piece = start[use], length[use], piece[use]
        end = start + length
        total = int(offset[-1] + lengths[-1]) + 1
        last, origin = np.full(total, -1, np.int64), np.zeros(total, np.int64)
        first = np.zeros(total, bool)
        first[offset] = True
        for edges in levels(offset, lengths, start, length):
            opening = first[start[edges]]
            edges = edges[opening | (last[start[edges]] >= 0)]
            opening = first[start[edges]]
            good = opening.copy()
            rest = edges[~opening]
            good[~opening] = self._allowed(last[start[rest]], piece[rest])
            edges = edges[good]
            last[end[edges]], origin[end[edges]] = piece[edges], start[edges]
        on, here = np.zeros(total, bool), offset + lengths
        while len(here):
            on[here] = True
            here = origin[here]
            here = here[~first[here]]
        ends = np.flatnonzero(on)
        found = last[ends]
        ids = self.ids[found].astype(np.int32)
        cuts = np.searchsorted(ends, offset, side="right").tolist() + [len(ends)]
        out = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        odd = np.flatnonzero(found == self.pieces.size)
        for k in np.unique(np.searchsorted(offset, ends[odd] - 1, side="right") - 1).tolist():
            run = []
            for i in range(cuts[k], cuts[k + 1]):
                if ids[i] >= 0:
                    run.append(int(ids[i]))
                else:
                    run += [self.pieces.bytes_[x] for x in words[k][ends[i] - 1 - offset[k]].encode("utf-8", "surrogatepass")]
            out[k] = np.array(run, np.int32).tobytes()
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [(self.chunks.findall if self.chunks else lambda t: [t])(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        got = self.known
        new = [w for w in set().union(*split) if w not in got]
        extra = {}
        for run in slices(new):
            for word, ids in zip(run, self.encode_chunks(run)):
                (got if len(word) <= LONGEST else extra)[word] = ids
        if extra:
            got = got | extra
        return [np.frombuffer(b"".join(map(got.__getitem__, words)), np.int32) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; control ids have none, and the leading space of encoding is taken off."""
        text = b"".join([self.raw.get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")
        return text.removeprefix(" ")


def _runs(texts: list[str]) -> Iterator[list[str]]:
    return slices(texts, AT_ONCE)


def _encode(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    codec = shared.value
    for batch in batches:
        at = 0
        for run in _runs([t or "" for t in batch.column(1).to_pylist()]):
            ids = codec.encode(run)
            same = [codec.decode(i) == t for i, t in zip(ids, run)]
            counts = np.array([len(i) for i in ids], np.int64)
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            flat = np.concatenate(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(run)), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                 pa.array(same)], ["doc_id", "n_ids", "ids", "round_trip"])
            at += len(run)
    codec.forget()


def _decode(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    codec = shared.value
    for batch in batches:
        texts = [None if ids is None else codec.decode(np.array(ids, np.int64)) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def _codec(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(Codec(path))


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """Columns ``doc_id, n_ids, ids, round_trip`` for each row of ``docs(doc_id, text)``.

    ``round_trip`` tells whether decoding the ids gives the text back. A null or empty text has no ids. Rows are
    encoded one by one: repeated rows and null ids stay as they are, an empty table gives an empty result, other
    columns are ignored.
    """
    shared = _codec(docs.sparkSession, path)
    slim = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "CAST(text AS string) AS text")
    return map_arrow(slim, lambda batches: _encode(batches, shared), "doc_id long, n_ids long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """Columns ``doc_id, text`` of ``encoded(doc_id, ids)``; null ids give a null text."""
    shared = _codec(encoded.sparkSession, path)
    slim = encoded.selectExpr("CAST(doc_id AS long) AS doc_id", "ids")
    return map_arrow(slim, lambda batches: _decode(batches, shared), "doc_id long, text string")
