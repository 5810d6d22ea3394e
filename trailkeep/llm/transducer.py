"""Token counts by a transducer compiled from a merge vocabulary.

Reading a text from the left, the last piece of the encoding of what was read so far follows from the last pieces at
the few borders before it, so a deterministic machine can follow them all. Each transition says by how many tokens the
encoding grows (or shrinks). States and transitions are compiled when a text first takes them. A text is cut into
chunks; a chunk's state map tells, for the states it may be entered in, the state it is left in and the tokens
counted; the maps of a text are composed by a prefix scan of doubling width, which gives the state every chunk is
really entered in.
"""

from __future__ import annotations

import gc
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailkeep.llm.common import map_arrow
from trailkeep.llm.pieces import MODEL, SPACE, Pieces

#: Characters of a chunk, and how far before a chunk its likely entry state is sought.
CHUNK, BEFORE = 16_384, 64
#: Transitions, and runs of up to so many characters, that a worker keeps; beyond them it forgets and starts anew.
TRANSITIONS, RUNS, LONGEST = 300_000, 200_000, 24
LIMIT = 4_096


class State(dict):
    """Transitions ``character -> (state, tokens added)``, compiled on first use.

    ``seen`` is the longest end of the text read that begins a piece. ``borders[d]`` tells, for each border ``d``
    characters back from which a piece can still go on beyond here, the last piece of the encoding up to that border
    and that encoding's tokens less those up to here.
    """

    __slots__ = ("machine", "seen", "borders")
    __hash__, __eq__ = object.__hash__, object.__eq__

    def __init__(self, machine: Machine, seen: str, borders: dict[int, tuple[str | None, int]]):
        super().__init__()
        self.machine, self.seen, self.borders = machine, seen, borders

    def __missing__(self, char: str) -> tuple[State, int]:
        step = self[char] = self.machine.step(self, char)
        return step


Map = dict[State, tuple[State, int]]


class Vocabulary:
    """A merge vocabulary as the machine needs it: which beginnings lead to pieces, and where merging leaves borders."""

    def __init__(self, path: str = MODEL):
        pieces = Pieces(path)
        self.rank = {t: -s for t, s in zip(pieces.texts, pieces.scores)}
        self.begins = {t[:i] for t in pieces.texts for i in range(1, len(t) + 1)}
        self.together = {t[i:i + 2] for t in pieces.texts for i in range(len(t) - 1)}
        self.ends: dict[str, tuple[tuple, tuple]] = {}
        self.shapes: dict[str, tuple] = {}
        inner = any(pair[1] == SPACE != pair[0] for pair in self.together)
        self.runs = re.compile("(?s:.+)" if inner else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        for text in pieces.texts:
            halves = self._halves(text)
            if halves is not None:
                self.ends[text] = self._edge(text, halves, 0), self._edge(text, halves, 1)

    def _halves(self, text: str) -> dict[str, tuple[str, str]] | None:
        """What each merged part of a piece was merged from; None if merging does not give the piece."""
        parts, halves = list(text), {}
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.rank.get(parts[i] + parts[i + 1], float("inf")), i))
            merged = parts[best] + parts[best + 1]
            if merged not in self.rank:
                return None
            halves[merged] = parts[best], parts[best + 1]
            parts[best:best + 2] = [merged]
        return halves

    def _edge(self, text: str, halves: dict[str, tuple[str, str]], side: int) -> tuple:
        """The parts at one edge of a piece, smallest first, each with the rank of the merge that ends it."""
        parts, until = [], float("inf")
        while True:
            parts.append((text, until))
            if text not in halves:
                return tuple(reversed(parts))
            until, text = self.rank[text], halves[text][side]

    def shape(self, seen: str) -> tuple[list[tuple[int, str]], list[int]]:
        """The pieces that ``seen`` ends with, longest first, and from how far back a piece can go on beyond it."""
        found = self.shapes.get(seen)
        if found is None:
            tails = [(size, seen[-size:]) for size in range(len(seen), 0, -1)]
            found = self.shapes[seen] = (
                [(size, sys.intern(tail)) for size, tail in tails if tail in self.ends],
                [size for size, tail in tails if tail in self.begins])
        return found

    def apart(self, left: str, right: str) -> bool:
        """Whether merging the characters of two adjacent pieces gives these two pieces.

        The parts at the border grow by rank, the left ones first among equals; the border falls as soon as two parts
        that stand there at the same time merge before either grows.
        """
        mine, other, i, j = self.ends[left][1], self.ends[right][0], 0, 0
        while True:
            (a, a_until), (b, b_until) = mine[i], other[j]
            across = self.rank.get(a + b)
            if across is not None and across < a_until and across <= b_until:
                return False
            if i + 1 == len(mine) and j + 1 == len(other):
                return True
            if a_until <= b_until:
                i += 1
            else:
                j += 1


class Machine:
    """The transducer of a vocabulary, as far as it was needed."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.states: dict[tuple, State] = {}
        self.transitions = 0
        self.known: dict[str, tuple[State, int]] = {}
        self.checked: dict[tuple[str | None, str], bool] = {}
        self.start = State(self, "", {0: (None, 0)})

    def step(self, state: State, char: str) -> tuple[State, int]:
        """The state after one more character, and the tokens it adds.

        Where no piece spans the border before the character, merging cannot pass it and the state is as at the
        beginning. A character that is no piece counts its bytes and leaves the machine at the beginning.
        """
        self.transitions += 1
        words, borders, checked = self.vocabulary, state.borders, self.checked
        if state.seen and state.seen[-1] + char not in words.together:
            return self.start[char]
        if char not in words.ends:
            return self.start, len(char.encode("utf-8", "surrogatepass"))
        seen = state.seen + char
        while seen not in words.begins:
            seen = seen[1:]
        pieces, open_ = words.shape(seen)
        for size, piece in pieces:
            last, behind = borders[size - 1]
            fits = checked.get((last, piece))
            if fits is None:
                fits = checked[last, piece] = last is None or words.apart(last, piece)
            if fits:
                break
        else:
            raise ValueError(f"no encoding ends with {seen!r}")
        added = behind + 1
        now = {0: (piece, 0)}
        for size in open_:
            last, behind = borders[size - 1]
            now[size] = last, behind - added
        key = seen, *now.values()
        found = self.states.get(key)
        if found is None:
            found = self.states[key] = State(self, seen, now)
        return found, added

    def walk(self, state: State, text: str) -> tuple[State, int]:
        """The state after a text, and the tokens counted, character by character."""
        tokens = 0
        for char in text:
            state, added = state[char]
            tokens += added
        return state, tokens

    def run(self, state: State, text: str) -> tuple[State, int]:
        """As ``walk``; a run that begins behind a border no piece spans is entered at the beginning, so what it gives
        is kept (a state map of one entry)."""
        first, *others = self.vocabulary.runs.findall(text) or [""]
        state, tokens = self.walk(state, first)
        for run in others:
            found = self.known.get(run)
            if found is None:
                found = self.walk(self.start, run)
                if len(run) <= LONGEST:
                    self.known[run] = found
            state, added = found
            tokens += added
        return state, tokens

    def tidy(self) -> None:
        """Keep what is remembered within its bounds."""
        if self.transitions > TRANSITIONS:
            self.clear()
        elif len(self.known) > RUNS:
            self.known.clear()

    def clear(self) -> None:
        """Forget all but the beginning (states point at each other, so they are taken apart)."""
        for state in self.states.values():
            state.clear()
        for kept in (self.start, self.states, self.known, self.checked):
            kept.clear()
        self.transitions = 0

    def chunks(self, text: str, width: int, before: int) -> list[tuple[str, Map]]:
        """The chunks of a text with their state maps, the first for the beginning and each other for the likely entry."""
        out = []
        for at in range(0, len(text), width):
            entry = self.run(self.start, text[max(0, at - before):at])[0]
            out.append((text[at:at + width], {entry: self.run(entry, text[at:at + width])}))
        return out

    def count(self, text: str, width: int = CHUNK, before: int = BEFORE) -> int:
        """The tokens of a text in the vocabulary's form (spaces marked)."""
        if len(text) <= width:
            return self.run(self.start, text)[1]
        chunks = self.chunks(text, width, before)
        while True:
            through = scan([states for _, states in chunks])
            reached = [states.get(self.start) for states in through]
            if reached[-1] is not None:
                return reached[-1][1]
            broken = reached.index(None)
            piece, states = chunks[broken]
            entry = reached[broken - 1][0]
            states[entry] = self.run(entry, piece)


def compose(first: Map, second: Map) -> Map:
    """The map of two neighbouring chunks, for the states of the first whose exits the second knows."""
    return {entry: (second[middle][0], tokens + second[middle][1])
            for entry, (middle, tokens) in first.items() if middle in second}


def scan(maps: list[Map]) -> list[Map]:
    """The map from the first chunk through each chunk: every round composes with the map as many chunks before as the last one spans."""
    width = 1
    while width < len(maps):
        maps = [compose(maps[i - width], states) if i >= width else states for i, states in enumerate(maps)]
        width *= 2
    return maps


def _count(batches: Iterator[pa.RecordBatch], shared: Broadcast, width: int) -> Iterator[pa.RecordBatch]:
    machine = Machine(shared.value)
    gc.disable()  # states are many and long-lived; clear() frees them
    try:
        for batch in batches:
            counts = []
            for text in batch.column(1):
                text = text.as_py()
                counts.append(machine.count(SPACE + text.replace(" ", SPACE), width) if text else 0)
                machine.tidy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    finally:
        machine.clear()
        gc.enable()


def count_tokens(docs: DataFrame, path: str = MODEL, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    """Columns ``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs(doc_id, text)``.

    ``n_tokens`` is what the vocabulary's own library gives without begin and end tokens. A null or empty text has
    none. Every row is counted by itself: repeated rows and null ids stay, an empty table gives an empty result, other
    columns are ignored. A worker holds the text at hand and at most about ``TRANSITIONS`` transitions.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    text = F.col("text").cast("string")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    counted = map_arrow(slim, lambda batches: _count(batches, shared, chunk), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
