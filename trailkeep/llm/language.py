"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability per piece of a fixed public vocabulary. A word's probability is the sum over
its segmentations into pieces (forward algorithm), a text's the product over its words. The probabilities are
learned by expectation maximisation over the words of a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailkeep.llm.common import map_arrow, staged
from trailkeep.llm.pieces import MODEL, SPACE, Pieces, levels, slices

#: About so many labelled documents of each language are learned from; the documents' hashes decide which.
PER_LANGUAGE = 3_000
ROUNDS = 3
SMOOTHING = 0.05
UNKNOWN = "und"
#: A filtered document is dropped if its most likely language is less likely than this.
LEAST_SCORE = 0.5
#: Words whose scores a worker remembers while it reads a partition.
REMEMBERED = 100_000
AT_ONCE = 1_000_000
_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    out = []
    for word in _WORDS.findall((text or "").lower()):
        if word.isascii() or word.isalpha():
            out.append(word)
        else:
            out += "".join(c if c.isalpha() else " " for c in word).split()
    return out


class Model:
    """Log-probabilities ``weights[piece, language]`` over a vocabulary; the last row stands for unknown characters."""

    def __init__(self, pieces: Pieces, languages: list[str], weights: np.ndarray):
        self.pieces, self.languages, self.weights = pieces, languages, weights
        self.known: dict[str, int] = {}
        self.rows = np.empty((0, len(languages)))

    def forget(self) -> None:
        self.known, self.rows = {}, self.rows[:0].copy()

    def _forward(self, run: list[str]) -> tuple:
        edges = self.pieces.occurrences([SPACE + w for w in run])
        offset, lengths, start, length, piece = edges
        total = int(offset[-1] + lengths[-1]) + 1
        end = start + length
        alpha = np.full((total, len(self.languages)), -np.inf)
        alpha[offset] = 0.0
        order = list(levels(offset, lengths, start, length))
        for level in order:
            ends, heads = np.unique(end[level], return_index=True)
            alpha[ends] = np.logaddexp.reduceat(alpha[start[level]] + self.weights[piece[level]], heads, axis=0)
        return alpha, order, offset + lengths, start, end, piece, offset

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The log-probability of each word in each language."""
        found = [np.empty((0, len(self.languages)))]
        for run in slices(words):
            alpha, _, goal, *_ = self._forward(run)
            found.append(alpha[goal])
        return np.concatenate(found)

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in words that occur ``counts[word, language]`` times."""
        total, at = np.zeros(self.weights.shape), 0
        for run in slices(words):
            alpha, order, goal, start, end, piece, offset = self._forward(run)
            beta = np.full(alpha.shape, -np.inf)
            beta[goal] = 0.0
            for level in reversed(order):
                level = level[np.argsort(start[level], kind="stable")]
                starts, heads = np.unique(start[level], return_index=True)
                part = np.logaddexp.reduceat(beta[end[level]] + self.weights[piece[level]], heads, axis=0)
                beta[starts] = np.logaddexp(beta[starts], part)
            word = np.searchsorted(offset, start, side="right") - 1
            share = np.exp(alpha[start] + self.weights[piece] + beta[end] - alpha[goal[word]])
            np.add.at(total, piece, share * counts[at:at + len(run)][word])
            at += len(run)
        return total

    def scores(self, texts: list[list[str]]) -> np.ndarray:
        """The log-probability of each list of words in each language."""
        if len(self.known) > REMEMBERED:
            self.forget()
        new = [w for w in set().union(*texts) if w not in self.known]
        self.known |= {w: len(self.rows) + i for i, w in enumerate(new)}
        self.rows = np.concatenate((self.rows, self.word_scores(new)))
        row = self.known.__getitem__
        return np.array([self.rows[np.fromiter(map(row, words), np.int64, len(words))].sum(axis=0) for words in texts])


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[list[str]]]]:
    """Runs of bounded size of a batch's texts, as words, with their first row's number."""
    at, run, size = 0, [], 0
    for i, text in enumerate(batch.column(column)):
        run.append(words_of(text.as_py()))
        size += len(run[-1])
        if size > AT_ONCE // 4:
            yield at, run
            at, run, size = i + 1, [], 0
    if run:
        yield at, run


def _count(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    number = {name: i for i, name in enumerate(languages)}

    def rows() -> pa.RecordBatch:
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[1] for k in keys], pa.string()), pa.array([k[0] for k in keys], pa.int32()),
             pa.array([counts[k] for k in keys], pa.int64())], ["word", "language", "n"])

    for batch in batches:
        names = batch.column(1).to_pylist()
        for at, run in _texts(batch, 0):
            for name, words in zip(names[at:], run):
                n = number[name]
                counts.update((n, w) for w in words)
            if len(counts) > REMEMBERED:
                yield rows()
                counts.clear()
    yield rows()


def _expect(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    model = shared.value
    total = np.zeros(model.weights.shape)
    for batch in batches:
        counts = np.stack([np.asarray(batch.column(i + 1)) for i in range(len(model.languages))], axis=1)
        total += model.expected(batch.column(0).to_pylist(), counts)
    piece, language = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(piece, pa.int64()), pa.array(language, pa.int64()), pa.array(total[piece, language])], ["piece", "language", "n"])


def train(docs: DataFrame, path: str = MODEL, per_language: int = PER_LANGUAGE, rounds: int = ROUNDS) -> Model | None:
    """The model of ``docs(text, lang)``; rows without text or language teach nothing, no language gives no model.

    About ``per_language`` documents of each language are used (all of a rarer one), chosen by a hash of their
    id and text, so that the copies of a text do not come in together.
    What comes to the driver is bounded: the languages' names, and one number per piece and language.
    """
    spark = docs.sparkSession
    name = F.col("doc_id").cast("string") if "doc_id" in docs.columns else F.lit(None).cast("string")
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang", F.xxhash64(name, "text").alias("draw"))
    sizes = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    share = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / sizes[k]))]), F.col("lang"))
    chosen = labelled.where(F.pmod("draw", F.lit(1 << 20)) < share * (1 << 20)).select("text", "lang")
    counted = map_arrow(chosen, lambda batches: _count(batches, languages), "word string, language int, n long")
    columns = [F.sum(F.when(F.col("language") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(languages))]
    words = staged(counted.groupBy("word").agg(*columns))
    pieces = Pieces(path)
    model = Model(pieces, languages, np.full((pieces.size + 1, len(languages)), -np.log(pieces.size + 1)))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        parts = map_arrow(words, lambda batches, s=shared: _expect(batches, s), "piece long, language long, n double")
        counts = np.full(model.weights.shape, SMOOTHING)
        for row in parts.groupBy("piece", "language").agg(F.sum("n").alias("n")).collect():
            counts[row.piece, row.language] += row.n
        shared.destroy()
        model = Model(pieces, languages, np.log(counts) - np.log(counts.sum(axis=0)))
    return model


def _judge(model: Model | None, run: list[list[str]]) -> tuple[list[str], list[float]]:
    if model is None:
        return [UNKNOWN] * len(run), [0.0] * len(run)
    logs = model.scores(run)
    best = logs.argmax(axis=1)
    score = 1.0 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    return ([model.languages[b] if words else UNKNOWN for b, words in zip(best, run)],
            [float(s) if words else 0.0 for s, words in zip(score, run)])


def _predict(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, run in _texts(batch, 1):
            names, scores = _judge(shared.value, run)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(run)), pa.array(names), pa.array(scores)], ["doc_id", "lang_pred", "score"])
    if shared.value is not None:
        shared.value.forget()


def _admit(batches: Iterator[pa.RecordBatch], shared: Broadcast, column: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = []
        for _, run in _texts(batch, column):
            names, scores = _judge(shared.value, run)
            good += [n != UNKNOWN and s >= LEAST_SCORE for n, s in zip(names, scores)]
        yield batch.filter(pa.array(good, pa.bool_()))
    if shared.value is not None:
        shared.value.forget()


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Columns ``doc_id, lang_pred, score`` for each row of ``docs(doc_id, text)``.

    ``score`` is the language's probability if all are equally likely beforehand. Null texts, texts without a
    letter, and all texts where nothing could be learned, are ``und`` with score 0. Ties go to the first name.
    Every row is judged by itself; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "CAST(text AS string) AS text")
    return map_arrow(slim, lambda batches: _predict(batches, shared), "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` in some learned language, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index("text")
    return map_arrow(docs, lambda batches: _admit(batches, shared, column), docs.schema)
