"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's potential depends on its own features and on those of the lines beside it, and
neighbouring lines tend to share a label. Line labels are not given: in training, lines of good documents are good,
lines of bad documents start as bad, and lines that the field then finds good are taken as good in the next round. The
field is fitted to a bounded sample of labelled documents. A document's quality is the mean of its lines' forward-
backward marginals, weighted by their lengths, put on the scale of a probability by a fitted logistic curve.

Scoring steps through all documents of a batch at once, a line at a time; long documents are cut into stretches whose
messages meet, so neither time nor memory grows with anything but the text. Null and empty texts have one empty line;
repeated rows get equal scores; without labels of both kinds every score is the share of good labels (0.5 without
any); an empty table gives no rows; lang, source, doc_id and other columns are not read as inputs.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.labelled import in_fold, logistic, sample, training_labels, with_text_key
from stratum.llm.text import SPACES, chunks, distinct, encode_words, give_back, starts, table, translated

SAMPLE_BAD, SAMPLE_GOOD, LONGEST_SAMPLED = 600, 1_000, 32 << 10
#: Lines whose features are made at a time, and lines that messages run along one by one.
_SLICE_LINES, SEGMENT = 1 << 15, 1 << 10
N_FEATURES = 25
_AS_IS = table(frozenset(), lower=False)
_BLANKS = table(SPACES, lower=False)
_KINDS = ["lower", "upper", "digit", "blank", "exclaim", "bar", "stop", "special", "beyond", "follow"]


def _kind_of_byte() -> np.ndarray:
    kind = np.full(256, _KINDS.index("special"), np.int64)
    kind[ord("a") : ord("z") + 1] = _KINDS.index("lower")
    kind[ord("A") : ord("Z") + 1] = _KINDS.index("upper")
    kind[ord("0") : ord("9") + 1] = _KINDS.index("digit")
    kind[list(SPACES)] = _KINDS.index("blank")
    kind[ord("!")] = _KINDS.index("exclaim")
    kind[ord("|")] = _KINDS.index("bar")
    kind[[ord(c) for c in ".,;:?'\"()-"]] = _KINDS.index("stop")
    kind[0xC0:] = _KINDS.index("beyond")  # begins a character beyond ASCII
    kind[0x80:0xC0] = _KINDS.index("follow")
    return kind


_KIND = _kind_of_byte()


@dataclass
class Lines:
    """The lines of a batch of texts: bytes, where each line begins and the last ends, lines of each text, and whether
    the text holds the line again."""

    data: np.ndarray
    edges: np.ndarray
    lines: np.ndarray
    again: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Lines:
        texts = translated(column, _AS_IS)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: offsets[-1]]
        breaks = np.flatnonzero(data == 0x0A)
        # A line runs to its line feed; a text that ends in one has an empty last line.
        begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
        lines = np.diff(np.searchsorted(breaks, offsets)) + 1
        edges = np.append(begin, offsets[-1])
        return Lines(data, edges, lines, _held_again(_strings(data, edges), lines))

    def slices(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(features, characters) of the lines, so many at a time that memory stays bounded."""
        for a in range(0, len(self.again), _SLICE_LINES):
            yield self._features(a, min(a + _SLICE_LINES, len(self.again)))

    def _features(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        data, edges = self.data[self.edges[a] : self.edges[b]], self.edges[a : b + 1] - self.edges[a]
        n, size = b - a, np.diff(edges)
        line = np.repeat(np.arange(n), size)
        count = np.bincount(line * len(_KINDS) + _KIND[data], minlength=n * len(_KINDS)).reshape(n, -1).astype(np.float64)
        filled = np.flatnonzero(size)
        count[filled[data[edges[filled + 1] - 1] == 0x0A], _KINDS.index("blank")] -= 1  # line feeds
        get = dict(zip(_KINDS, count.T))
        characters = count.sum(1) - get["follow"]
        some_characters = np.maximum(characters, 1)
        letters = get["lower"] + get["upper"] + get["beyond"]

        words, codes, vocabulary = encode_words(_strings(data, edges))
        owner = np.repeat(np.arange(n), words)
        beside = np.zeros(n)
        if len(codes):
            same = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
            beside = np.bincount(owner[1:][same], minlength=n).astype(np.float64)
        kinds = distinct(owner * (len(vocabulary) + 1) + codes) // (len(vocabulary) + 1)
        kinds = np.bincount(kinds, minlength=n)[:n]
        first = np.zeros(n, np.uint8)
        first[filled] = data[edges[filled]]
        share = lambda name: get[name] / some_characters
        some = np.maximum(words, 1)
        shares = [
            get["upper"] / np.maximum(letters, 1), share("digit"), share("exclaim"), share("bar"), share("special"),
            share("stop"), beside / some, 1 - kinds / some,
        ]
        levels = [(0, 0.5), (2, 0.02), (3, 0.02), (4, 0.03), (4, 0.1), (6, 0.1), (6, 0.5), (7, 0.5)]
        features = [
            np.log1p(characters) / 5, np.log1p(words) / 3, characters / some / 10, share("beyond"), letters / some_characters,
            self.again[a:b].astype(float), (first >= 0x41) & (first <= 0x5A), words == 0, words == 1,
            *shares, *(shares[i] > level for i, level in levels),
        ]
        return np.column_stack(features).astype(np.float64), characters


def _strings(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The lines as texts in which only blanks part words."""
    spaced = pa.py_buffer(data.tobytes().translate(_BLANKS))
    return pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int64).tobytes()), spaced)


def _held_again(strings: pa.Array, lines: np.ndarray) -> np.ndarray:
    """Whether a line with words stands more than once in its text, blanks around it aside."""
    whole = pc.utf8_trim(strings, " ").dictionary_encode()
    blank = pc.index(whole.dictionary, "").as_py()
    codes = whole.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = np.repeat(np.arange(len(lines)), lines) * (len(whole.dictionary) + 1) + codes
    order = np.argsort(key, kind="stable")
    twin = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][twin]] = again[order[:-1][twin]] = True
    return again & (codes != blank)


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, characters of each line, lines of each text)"""
    held = Lines.of(column)
    features, characters = zip(*held.slices()) if len(held.again) else ([np.zeros((0, N_FEATURES))], [np.zeros(0)])
    return np.concatenate(features), np.concatenate(characters), held.lines


def with_neighbours(features: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and of the line after (zeros at the ends), and a constant."""
    edges = starts(lines)
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    before[edges[:-1]] = 0
    after[edges[1:] - 1] = 0
    return np.column_stack([features, before, after, np.ones(len(features))])


def _running(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """(step, how many of the stretches are longer than that), which come longest first."""
    for t in range(int(size[0]) if len(size) else 0):
        yield t, int(np.searchsorted(-size, -t, side="left"))


def _sweep(potential: np.ndarray, pair: np.ndarray, begin: np.ndarray, size: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Messages (log-odds) that run along stretches of lines, all a line at a time; `into`: what enters each."""
    order = np.argsort(-size, kind="stable")
    size, begin, message = size[order], begin[order], into[order]
    out = np.empty(len(potential))
    for t, n in _running(size):
        at = begin[:n] + t
        if t:
            last = out[at - 1]
            message = np.logaddexp(pair[0, 1], last + pair[1, 1]) - np.logaddexp(pair[0, 0], last + pair[1, 0])
        out[at] = potential[at] + message[:n]
    return out


def _through(potential: np.ndarray, pair: np.ndarray, begin: np.ndarray, size: np.ndarray, label: int) -> np.ndarray:
    """Log weights of the labels at each stretch's last line, of its paths that begin with this label."""
    order = np.argsort(-size, kind="stable")
    size, begin = size[order], begin[order]
    weight = np.full((len(size), 2), -np.inf)
    for t, n in _running(size):
        if t:
            weight[:n] = np.logaddexp(weight[:n, :1] + pair[0], weight[:n, 1:] + pair[1])
        else:
            weight[:, label] = 0
        weight[:n, 1] += potential[begin[:n] + t]
    out = np.empty_like(weight)
    out[order] = weight
    return out


def messages(potential: np.ndarray, pair: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """The forward messages (log-odds) of every line.

    Texts are cut into stretches of a bounded number of lines. What a stretch makes of either label at its first line
    is a 2 x 2 matrix; the matrices of a text in turn give what enters each of its stretches, which are then swept
    together. So a text of n lines takes some SEGMENT + n / SEGMENT steps.
    """
    parts = np.maximum(-(-lines // SEGMENT), 1)
    of = np.repeat(np.arange(len(lines)), parts)
    number = np.arange(len(of)) - starts(parts)[of]
    begin = starts(lines)[of] + number * SEGMENT
    size = np.minimum(lines[of] - number * SEGMENT, SEGMENT)
    into = np.zeros(len(of))
    if len(of) > len(lines):
        from_bad, from_good = (_through(potential, pair, begin, size, label) for label in (0, 1))
        for n in range(1, int(parts.max())):
            at = np.flatnonzero(number == n)
            out = np.logaddexp(from_bad[at - 1], into[at - 1][:, None] + from_good[at - 1])
            entering = np.logaddexp(out[:, :1] + pair[0], out[:, 1:] + pair[1])
            into[at] = entering[:, 1] - entering[:, 0]
    return _sweep(potential, pair, begin, size, into)


def marginals(potential: np.ndarray, pair: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) of each line, expected counts of neighbouring labels) by the forward-backward recursions.

    potential: log-odds of good per line; pair[a, b]: log-potential of label a before label b. The backward messages
    are the forward ones of the lines in reverse order.
    """
    forward = messages(potential, pair, lines)
    backward = messages(potential[::-1], pair.T, lines[::-1])[::-1]  # the line's own potential included
    p = 1 / (1 + np.exp(-np.clip(forward + backward - potential, -30, 30)))
    expected = np.zeros((2, 2))
    inner = np.ones(len(potential), bool)
    inner[starts(lines)[1:] - 1] = False
    inner = np.flatnonzero(inner)
    for a in range(0, len(inner), _SLICE_LINES):
        at = inner[a : a + _SLICE_LINES]
        both = np.zeros((len(at), 2, 2)) + pair
        both[:, 1] += forward[at][:, None]
        both[:, :, 1] += backward[at + 1][:, None]
        both = np.exp(both - both.max((1, 2), keepdims=True))
        expected += (both / both.sum((1, 2), keepdims=True)).sum(0)
    return p, expected


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    pair: np.ndarray
    curve: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        held = Lines.of(column)
        if self.weights is None:
            return np.full(len(held.lines), self.curve[-1])
        # The weights of a line's own features, of those of the line before and of the line after, and the constant.
        weight = self.weights / self.scale
        own, before, after = weight[:-1].reshape(3, -1)
        n, at = len(held.again), 0
        potential, characters = np.full(n + 2, weight[-1] - self.mean @ weight), []
        edges = starts(held.lines)
        first, last = np.zeros(n, bool), np.zeros(n, bool)
        first[edges[:-1]] = last[edges[1:] - 1] = True
        for features, size in held.slices():  # a place before and one after take what reaches beyond the ends
            stop = at + len(size)
            potential[at + 1 : stop + 1] += features @ own
            potential[at + 2 : stop + 2] += np.where(last[at:stop], 0, features @ before)
            potential[at:stop] += np.where(first[at:stop], 0, features @ after)
            characters.append(size)
            at = stop
        if not n:
            return np.zeros(0)
        potential = potential[1:-1]
        share = _document_share(marginals(potential, self.pair, held.lines)[0], np.concatenate(characters), held.lines)
        return 1 / (1 + np.exp(-np.clip(_curve_inputs(share) @ self.curve, -30, 30)))


def _document_share(good: np.ndarray, characters: np.ndarray, lines: np.ndarray) -> np.ndarray:
    begin = starts(lines)[:-1]
    weight = characters + 1  # empty lines count a little
    return np.add.reduceat(good * weight, begin) / np.add.reduceat(weight, begin) if len(lines) else np.zeros(0)


def _curve_inputs(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 0.01, 0.99)
    return np.column_stack([np.log(share / (1 - share)), np.ones(len(share))])


def fit(texts: list[str], good: np.ndarray, weight: np.ndarray, rounds: int = 3, steps: int = 70) -> Model:
    if not len(texts) or good.min() == good.max():
        return Model(*[np.zeros(0)] * 2, None, np.zeros((2, 2)), np.array([good.mean() if len(texts) else 0.5]))
    features, characters, lines = line_features(pa.array(texts, pa.large_string()))
    x = with_neighbours(features, lines)
    mean, scale = x.mean(0), x.std(0)
    mean[-1], scale[-1] = 0, 1
    scale[scale < 1e-6] = 1
    x = (x - mean) / scale
    document = np.repeat(np.arange(len(lines)), lines)
    of_bad = good[document] == 0
    inner = np.flatnonzero(document[1:] == document[:-1])
    label = (~of_bad).astype(int)
    weights, pair = np.zeros(x.shape[1]), np.zeros((2, 2))
    for _ in range(rounds):
        observed = np.zeros((2, 2))
        np.add.at(observed, (label[inner], label[inner + 1]), 1)
        moment, square, total = 0.0, 0.0, len(label)
        for step in range(1, steps + 1):  # Adam on the penalised log-likelihood
            p, expected = marginals(x @ weights, pair, lines)
            gradient = np.concatenate([x.T @ (label - p), (observed - expected).ravel()]) / total
            gradient -= 1e-4 * np.concatenate([weights, pair.ravel()])
            moment = 0.9 * moment + 0.1 * gradient
            square = 0.99 * square + 0.01 * gradient**2
            move = 0.1 * moment / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            weights = weights + move[:-4]
            pair = pair + move[-4:].reshape(2, 2)
        p, _ = marginals(x @ weights, pair, lines)
        label = np.where(of_bad, p > 0.5, 1).astype(int)
        worst = np.minimum.reduceat(p, starts(lines)[:-1])
        label[of_bad & (p <= worst[document])] = 0  # a bad document has a bad line
    share = _document_share(p, characters, lines)
    curve = logistic(_curve_inputs(share), good, weight)
    return Model(mean, scale, weights, pair, curve)


def _score_rows(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, most=1 << 20):
        score = pa.array(model.score(rows.column("text")), pa.float64())
        kept = [rows.column("doc_id"), rows.column("text_key")]
        yield pa.RecordBatch.from_arrays([*kept, score], names=["doc_id", "text_key", "score"])


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, text_key, held_out, score, predicted) of every row of (doc_id, text); labels: (doc_id, quality)."""
    known = training_labels(labels, "quality", modulus, held_out)
    model = fit(*sample(docs, known, {0: SAMPLE_BAD, 1: SAMPLE_GOOD}, LONGEST_SAMPLED))
    gc.collect()
    give_back()  # the driver's, too, is needed by what follows
    scored = with_text_key(docs).mapInArrow(
        partial(_score_rows, model=model), "doc_id long, text_key long, score double"
    )
    return scored.select(
        "doc_id", "text_key", in_fold(F.col("doc_id"), modulus, held_out).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
