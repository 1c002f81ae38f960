"""Language identification with segmentation-marginalised unigrams (operator 2).

The pieces come from a fixed public vocabulary.  For every language the model
holds a probability per piece; the probability of a word is the sum over *all*
its segmentations into pieces, computed by a forward pass over the piece lattice,
and a text's is the product over its words.  The posterior over the
learned languages decides.

Fitting counts the words of a bounded sample of labelled rows with Spark, then
runs expectation-maximisation: each round a Spark job sums the expected piece
counts (forward-backward over the lattice) of its part of the word table, and the
driver receives one vector per language and part (vocabulary size, bounded).

Words are maximal runs of letters, lower-cased, with the vocabulary's
word-start mark in front; runs beyond ``MAX_WORD`` letters are scored as
consecutive words of that length, so every letter counts.  A character without
a piece of its own gets one shared piece of the same probability everywhere.

Defined results: a null text, an empty one and one without letters give
``und`` with score 1.0; a tie goes to the language that sorts first; repeated
rows are scored alike; where there was nothing to learn from, every text is ``und``;
columns named like the output are replaced, all others pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import distinct_sample, slices

#: Rows with labels that a fit uses at most (about; chosen by a hash of the text).
MAX_TRAINING_ROWS = 10_000
#: Letters of a word, and letters of a piece.
MAX_WORD, MAX_PIECE = 48, 10
#: Rounds of expectation-maximisation; weight of the shared background.
ROUNDS, BACKGROUND = 3, 50.0
#: Probabilities are multiplied by e^SCALE per letter, so that products of the
#: forward pass stay near 1.
SCALE = 2.5
#: Words whose scores a worker remembers.
REMEMBERED = 500_000
UNDETERMINED = "und"

_LETTERS = regex.compile(r"\p{L}+")
_AUTOMATA: dict = {}


def read_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece model that lower-cased words can contain."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ok = regex.compile(r"▁?\p{L}{0,%d}" % MAX_PIECE)
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    return sorted(p for p in pieces | {"▁"} if p and p == p.lower() and ok.fullmatch(p))


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    found = _LETTERS.findall(text.lower())
    if any(len(w) > MAX_WORD for w in found):
        found = [w[i:i + MAX_WORD] for w in found for i in range(0, len(w), MAX_WORD)]
    return found


@dataclass
class Lattice:
    """All pieces inside a list of words, as arcs between character positions.

    Arcs are sorted by the position in the word where they end; ``steps`` bounds
    the arcs of each such position."""

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    steps: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _automaton(pieces: list[str]):
    key = (len(pieces), hash(tuple(pieces)))
    if key not in _AUTOMATA:
        a = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            a.add_word(p, i)
        a.make_automaton()
        _AUTOMATA[key] = a, np.array([len(p) for p in pieces], dtype=np.int64)
    return _AUTOMATA[key]


def lattice(words: list[str], pieces: list[str]) -> Lattice:
    """Arcs of all words; the piece number ``len(pieces)`` stands for any
    character that has no piece of its own."""
    automaton, length = _automaton(pieces)
    joined = "\n" + "\n".join("▁" + w for w in words)
    lens = np.array([len(w) + 2 for w in words], dtype=np.int64)
    first = np.cumsum(lens) - lens
    found = np.fromiter(chain.from_iterable(automaton.iter(joined)), np.int64).reshape(-1, 2)
    end, piece = found[:, 0], found[:, 1]
    start = end - length[piece]
    covered = np.zeros(len(joined), dtype=bool)
    covered[end[length[piece] == 1]] = True
    covered[first] = True
    bare = np.flatnonzero(~covered)
    end = np.concatenate([end, bare])
    start = np.concatenate([start, bare - 1])
    piece = np.concatenate([piece, np.full(len(bare), len(pieces))])
    within = np.arange(len(joined)) - np.repeat(first, lens)
    depth = within[end].astype(np.uint8)
    # Two stable sorts: by end (the automaton's order, but for bare characters),
    # then by depth, which fits a byte and so is sorted by counting.
    if len(bare):
        order = np.argsort(end, kind="stable")
        start, end, piece, depth = start[order], end[order], piece[order], depth[order]
    order = np.argsort(depth, kind="stable")
    start, end, piece, depth = start[order], end[order], piece[order], depth[order]
    steps = np.searchsorted(depth, np.arange(1, int(depth[-1]) + 2))
    return Lattice(start, end, piece, steps, first, first + lens - 1)


def forward(lat: Lattice, scaled: np.ndarray) -> np.ndarray:
    """Scaled probability sums over all segmentations, per position and language."""
    alpha = np.zeros((int(lat.last[-1]) + 1, scaled.shape[1]))
    alpha[lat.first] = 1.0
    for a, b in zip(lat.steps[:-1], lat.steps[1:]):
        if a == b:
            continue
        ends = lat.end[a:b]
        new = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
        alpha[ends[new]] = np.add.reduceat(alpha[lat.start[a:b]] * scaled[lat.piece[a:b]], new, axis=0)
    return alpha


def word_scores(words: list[str], pieces: list[str], scaled: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language."""
    lat = lattice(words, pieces)
    total = forward(lat, scaled)[lat.last]
    return np.log(total) - SCALE * (lat.last - lat.first)[:, None]


def expected_counts(words: list[str], weights: np.ndarray, pieces: list[str],
                    scaled: np.ndarray) -> np.ndarray:
    """Expected uses of each piece; ``weights`` has a word's count per language."""
    lat = lattice(words, pieces)
    alpha = forward(lat, scaled)
    beta = np.zeros_like(alpha)
    beta[lat.last] = weights / alpha[lat.last]
    arc = np.zeros((len(lat.piece), scaled.shape[1]))
    for a, b in zip(lat.steps[:-1][::-1], lat.steps[1:][::-1]):
        if a == b:
            continue
        flow = scaled[lat.piece[a:b]] * beta[lat.end[a:b]]
        arc[a:b] = alpha[lat.start[a:b]] * flow
        order = np.argsort(lat.start[a:b], kind="stable")
        starts = lat.start[a:b][order]
        new = np.flatnonzero(np.r_[True, starts[1:] != starts[:-1]])
        beta[starts[new]] += np.add.reduceat(flow[order], new, axis=0)
    return np.stack([np.bincount(lat.piece, arc[:, k], minlength=len(pieces) + 1)
                     for k in range(scaled.shape[1])], axis=1)


def scale_up(probs: np.ndarray, pieces: list[str]) -> np.ndarray:
    size = np.array([len(p) for p in pieces] + [1])
    return probs * np.exp(SCALE * size)[:, None]


@dataclass
class LanguageModel:
    languages: list[str]
    prior: np.ndarray
    pieces: list[str]
    probs: np.ndarray  # (pieces + 1, languages)
    uid: str = field(default_factory=lambda: uuid4().hex)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update((lang, w) for w in words_of(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])


def fit(labelled: DataFrame, pieces_path: str, text_col: str = "text", lang_col: str = "lang",
        max_rows: int = MAX_TRAINING_ROWS, rounds: int = ROUNDS) -> LanguageModel:
    """Learn from the rows of ``labelled`` with a language and a text; copies of a text count once."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counted = (distinct_sample(rows, "text", max_rows).mapInArrow(_count_words, "lang string, word string, n long")
               .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    table = materialize(counted, "langid-words")
    totals = {r["lang"]: r["n"] for r in table.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    prior = np.array([totals[k] for k in langs], dtype=float)
    pieces = read_pieces(pieces_path)
    if not langs and not rows.filter(F.col("text").rlike(r"\p{L}")).isEmpty():
        raise ValueError("the sample of labelled texts is empty")
    if not langs:
        return LanguageModel([], prior, pieces, np.empty((len(pieces) + 1, 0)))
    probs = np.full((len(pieces) + 1, len(langs)), 1.0 / len(pieces))
    sc = table.sparkSession.sparkContext
    for _ in range(rounds):
        held = sc.broadcast((pieces, scale_up(probs, pieces)))

        def expect(batches: Iterator[pa.RecordBatch], held=held, langs=langs) -> Iterator[pa.RecordBatch]:
            pieces, scaled = held.value
            at = {k: i for i, k in enumerate(langs)}
            total = np.zeros_like(scaled)
            for batch in batches:
                for s in range(0, batch.num_rows, 50_000):
                    part = batch.slice(s, 50_000)
                    weights = np.zeros((part.num_rows, len(langs)))
                    weights[np.arange(part.num_rows), [at[k] for k in part.column(0).to_pylist()]] = \
                        part.column(2).to_numpy()
                    total += expected_counts(part.column(1).to_pylist(), weights, pieces, scaled)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(langs)), pa.int32()),
                 pa.array([np.ascontiguousarray(total[:, i]).tobytes() for i in range(len(langs))], pa.binary())],
                names=["lang", "counts"])

        counts = np.zeros_like(probs)
        for r in table.mapInArrow(expect, "lang int, counts binary").collect():
            counts[:, r["lang"]] += np.frombuffer(r["counts"])
        held.unpersist()
        # Every language leans on the mean of all, so that no piece is impossible.
        shares = counts / counts.sum(axis=0)
        mean = 0.999 * shares.mean(axis=1) + 0.001 / len(shares)
        probs = (counts + BACKGROUND * mean[:, None]) / (counts.sum(axis=0) + BACKGROUND)
        probs[-1] = probs[-1].min()
    return LanguageModel(langs, np.log(prior / prior.sum()), pieces, probs)


class _Scorer:
    """A worker's scores of words, remembered up to ``REMEMBERED`` of them."""

    def __init__(self, model: LanguageModel):
        self.model, self.scaled = model, scale_up(model.probs, model.pieces)
        self.at: dict[str, int] = {}
        self.scores = np.empty((0, len(model.languages)))

    def rows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Sums of log probabilities per text and language, and its words."""
        words = [words_of(t) for t in texts]
        new = list({w for ws in words for w in ws if w not in self.at})
        if len(self.at) + len(new) > REMEMBERED:
            self.at = {}
            self.scores = self.scores[:0]
            new = list({w for ws in words for w in ws})
        if new:
            made = np.concatenate([word_scores(new[i:i + 50_000], self.model.pieces, self.scaled)
                                   for i in range(0, len(new), 50_000)])
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.scores = np.concatenate([self.scores, made])
        n = np.array([len(ws) for ws in words])
        sums = np.zeros((len(texts), len(self.model.languages)))
        some = n > 0
        if some.any():
            at = np.fromiter((self.at[w] for ws in words for w in ws), np.int64, int(n.sum()))
            sums[some] = np.add.reduceat(self.scores[at], (np.cumsum(n) - n)[some], axis=0)
        return sums, n


#: The scorer of the model that this worker process last used.
_SCORERS: dict = {}


def predict(df: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """``df`` with the language of each text and its posterior probability."""
    if not model.languages:
        return df.withColumns({lang_col: F.lit(UNDETERMINED), score_col: F.lit(1.0)})
    held, uid = df.sparkSession.sparkContext.broadcast(model), model.uid

    @F.arrow_udf(T.StructType().add("lang", T.StringType()).add("score", T.DoubleType()))
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if _SCORERS.get("uid") != uid:
            _SCORERS.update(uid=uid, scorer=_Scorer(held.value))
        scorer = _SCORERS["scorer"]
        langs = scorer.model.languages
        for batch in batches:
            names, scores = [], []
            for part in slices(batch):
                sums, n = scorer.rows(part.to_pylist())
                sums = sums + scorer.model.prior
                best = sums.argmax(axis=1)
                share = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                names += [langs[b] if k else UNDETERMINED for b, k in zip(best, n)]
                scores += [float(s) if k else 1.0 for s, k in zip(share, n)]
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["lang", "score"])

    both = language(F.col(text_col))
    return df.withColumns({lang_col: both["lang"], score_col: both["score"]})
