"""Toxicity by weak supervision.

Voters: words and word stems of a lexicon, each group of terms a voter, and patterns of writing. The lexicon is made of
given insults and of terms that cover labelled toxic texts of a bounded sample and hardly any clean one, chosen by
greedy cover. How often each combination of votes occurs is counted over all texts outside the held-out fold.
A generative label model explains these counts: each voter fires with one rate in toxic and another in clean texts
(its accuracy), and voters that agree beyond that within a class are one joint voter (their correlation). Labels, where
there are any, hold the classes in place, and those of texts that vote alike count beside what the rates say: a class may
have kinds of texts on which different voters fire, and to one kind the silence of the others' voters says nothing. A
linear classifier of the votes' strengths is then trained on the model's posterior labels, and scores every text. A
label whose doc_id stands for several texts isn't counted with any of them.

Null and empty texts have no votes and get the classifier's score for that; repeated rows get equal scores; without
labels only the given insults vote; an empty table gives no rows; lang, source, doc_id and other columns are not read
as inputs.
"""

from __future__ import annotations

import gc
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.labelled import in_fold, logistic, sample, training_labels, with_text_key
from stratum.llm.text import PUNCTUATION, chunks, encode_words, give_back, table, translated
from stratum.sources.scratch import materialize

# Insults that always belong to the lexicon.
SEEDS = [
    "idiot", "stupid", "moron", "scum", "trash", "worthless", "pathetic", "loser", "disgusting", "clown",
    "imbecile", "dumbass", "bastard", "filth", "vermin", "degenerate",
]
STEMS = (4, 5, 6)  # lengths in characters
LEXICON_VOTERS = 14
PATTERNS = 2  # shouting in capitals, exclaiming
THRESHOLD = 0.7
RATES_WORTH = 1.0  # so many labelled texts of one combination of votes count as much as the rates of the voters
SAMPLE_TOXIC, SAMPLE_CLEAN, LONGEST_SAMPLED = 2_000, 4_000, 32 << 10
_WORDS = table(PUNCTUATION)
_AS_IS = table(frozenset(), lower=False)
_VOTERS = LEXICON_VOTERS + PATTERNS


@dataclass
class Lexicon:
    voter: dict[str, int]  # of a word, or of a stem with its length before it

    def of(self, word: str) -> int:
        """The voter of a word; -1 without one."""
        found = self.voter.get(word, -1)
        for length in STEMS:
            if found < 0 and len(word) >= length:
                found = self.voter.get(f"{length}:{word[:length]}", -1)
        return found


def _terms(word: str) -> list[str]:
    return [word, *(f"{n}:{word[:n]}" for n in STEMS if len(word) >= n)]


def _word_sets(texts: list[str]) -> list[set[str]]:
    counts, codes, words = encode_words(pa.array(texts, pa.large_string()), _WORDS)
    listed, at, out = words.to_pylist(), 0, []
    for n in counts.tolist():
        out.append({listed[c] for c in set(codes[at : at + n].tolist())})
        at += n
    return out


def induce_lexicon(texts: list[str], toxic: np.ndarray, weight: np.ndarray) -> Lexicon:
    """Greedy cover of the toxic texts by terms that nearly only they hold, terms as common, and the given insults.

    All of them are kept: each chosen term covers a share of the sample, and the sample bounds the others."""
    sets = _word_sets(texts)
    bad = [{t for w in s for t in _terms(w)} for s, y in zip(sets, toxic) if y]
    held = Counter(t for s in bad for t in s)
    least = max(3, len(bad) // 100)
    candidates = {t for t, n in held.items() if n >= least}
    clean: Counter = Counter()
    for s, y, w in zip(sets, toxic, weight):
        if not y:
            for t in {t for word in s for t in _terms(word)} & candidates:
                clean[t] += w
    w1 = float(weight[toxic > 0].mean()) if len(bad) else 1.0
    good = {t for t in candidates if held[t] * w1 / (held[t] * w1 + clean[t] + 0.2) >= 0.9}
    where: dict[str, set[int]] = {t: set() for t in good}
    for i, s in enumerate(bad):
        for t in s & good:
            where[t].add(i)
    chosen, open_ = [], set(range(len(bad)))
    while where:
        # Longer terms win ties: a whole word rather than its stem.
        term = max(where, key=lambda t: (len(where[t] & open_), -clean[t], len(where[t]), len(t), t))
        if len(where[term] & open_) < least:
            break
        open_ -= where.pop(term)
        chosen.append(term)
    # Terms as common in toxic texts as those chosen vote too, though the others cover their texts already.
    often, taken = 2 * least, set(chosen)
    for term in sorted(where, key=lambda t: (-held[t], -len(t), t)):
        word = term.partition(":")[2] or term
        if held[term] >= often and not clean[term] and not any(f"{n}:{word[:n]}" in taken for n in STEMS):
            chosen.append(term)
            taken.add(term)
    chosen = list(dict.fromkeys([*chosen, *SEEDS]))
    return Lexicon({t: i % LEXICON_VOTERS for i, t in enumerate(chosen)})


def vote_strengths(column: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """(how often each voter fires in each text, words per text)"""
    counts, codes, words = encode_words(column, _WORDS)
    voter = np.array([lexicon.of(w) for w in words.to_pylist()], np.int64)
    votes = np.zeros((len(counts), _VOTERS), np.int64)
    of_word = voter[codes] if len(words) else codes
    hits = np.flatnonzero(of_word >= 0)
    owner = np.searchsorted(np.cumsum(counts), hits, side="right")
    np.add.at(votes, (owner, of_word[hits]), 1)
    texts = translated(column, _AS_IS)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    capital = (data >= 0x41) & (data <= 0x5A)
    capitals, letters, exclaims = (
        np.diff(np.searchsorted(np.flatnonzero(kind), offsets))
        for kind in (capital, capital | ((data >= 0x61) & (data <= 0x7A)), data == 0x21)
    )
    votes[:, LEXICON_VOTERS] = (capitals * 2 > letters) & (capitals > 20)
    votes[:, LEXICON_VOTERS + 1] = exclaims * 10 > np.maximum(counts, 10)
    return votes, counts


def _vote_rows(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    for rows in chunks(batches, most=1 << 20):
        votes, words = vote_strengths(rows.column("text"), lexicon)
        flat = pa.array(votes.ravel(), pa.int64())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(votes) + 1) * _VOTERS, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("text_key"), lists, pa.array(words, pa.int64())],
            names=["doc_id", "text_key", "votes", "n_words"],
        )


def _mask(votes: Column) -> Column:
    bits = [F.when(votes[j] > 0, F.lit(1 << j)).otherwise(F.lit(0)) for j in range(_VOTERS)]
    return sum(bits[1:], bits[0])


class LabelModel:
    """P(votes | class) as a product over groups of voters, each with the joint rates of its members' votes."""

    def __init__(self, masks: np.ndarray, labels: np.ndarray, n: np.ndarray, most_correlated: float = 0.25):
        """labels: 0, 1, or -1 for none; n: how many texts vote so."""
        self.bits = (masks[:, None] >> np.arange(_VOTERS)) & 1
        self.labels, self.n = labels, n.astype(np.float64)
        self.labelled = np.stack([np.bincount(masks, self.n * (labels == y), 1 << _VOTERS) for y in (0, 1)])
        known = self.n[labels >= 0].sum()
        rate = (self.n * (labels == 1)).sum() / known if known else 0.05
        self.prior = min(max(rate, 1e-4), 0.5)
        self.groups = [[j] for j in range(_VOTERS)]
        any_term = self.bits[:, :LEXICON_VOTERS].any(1)
        self._fit(np.where(any_term, 0.9, 0.02))
        alone = self._posterior(self.bits)
        self.groups = self._correlated(most_correlated)
        self._fit(alone)

    def _codes(self, bits: np.ndarray, group: list[int]) -> np.ndarray:
        return sum(bits[:, j] << i for i, j in enumerate(group))

    def _clamped(self, q: np.ndarray) -> np.ndarray:
        return np.where(self.labels >= 0, np.where(self.labels == 1, 0.995, 0.005), q)

    def _fit(self, q: np.ndarray, rounds: int = 20) -> None:
        """Expectation-maximisation from the given probabilities of class 1."""
        codes = [self._codes(self.bits, g) for g in self.groups]
        for _ in range(rounds):
            q = self._clamped(q)
            self.rates = []
            for group, code in zip(self.groups, codes):
                size = 1 << len(group)
                both = [np.bincount(code, self.n * w, size) + 0.1 for w in (1 - q, q)]
                self.rates.append([x / x.sum() for x in both])
            self.prior = float(((self.n * q).sum() + 0.5) / (self.n.sum() + 1 + 9.5))
            q = self._posterior(self.bits)

    def _posterior(self, bits: np.ndarray) -> np.ndarray:
        odds = np.full(len(bits), np.log(self.prior / (1 - self.prior)))
        for group, (clean, toxic) in zip(self.groups, self.rates):
            code = self._codes(bits, group)
            odds += np.log(toxic[code] / clean[code])
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def _correlated(self, most: float) -> list[list[int]]:
        """Voters joined, up to three, whose votes correlate within a class."""
        q = self._clamped(self._posterior(self.bits))
        strength = np.zeros((_VOTERS, _VOTERS))
        for w in (self.n * q, self.n * (1 - q)):
            if w.sum() < 1:
                continue
            mean = (w[:, None] * self.bits).sum(0) / w.sum()
            centred = self.bits - mean
            cov = (w[:, None] * centred).T @ centred / w.sum()
            deviation = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            strength = np.maximum(strength, np.abs(cov) / np.outer(deviation, deviation))
        groups = {j: [j] for j in range(_VOTERS)}
        pairs = sorted(((strength[a, b], a, b) for a in range(_VOTERS) for b in range(a)), reverse=True)
        for value, a, b in pairs:
            if value > most and groups[a] is not groups[b] and len(groups[a]) + len(groups[b]) <= 3:
                joined = groups[a] + groups[b]
                for j in joined:
                    groups[j] = joined
        return list({id(g): g for g in groups.values()}.values())

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(toxic) by the rates, corrected by the labels of texts with the same votes."""
        bits = (votes > 0).astype(np.int64)
        clean, toxic = self.labelled[:, bits @ (1 << np.arange(_VOTERS))]
        return (RATES_WORTH * self._posterior(bits) + toxic) / (RATES_WORTH + clean + toxic)


def _inputs(votes: np.ndarray, words: np.ndarray) -> np.ndarray:
    total = votes[:, :LEXICON_VOTERS].sum(1)
    strength = np.log1p(votes)
    rest = [np.log1p(total), np.log1p(100 * total / np.maximum(words, 1)), np.minimum(total, 1), np.ones(len(votes))]
    return np.column_stack([strength, *rest]).astype(np.float64)


def score_expression(coefficients: np.ndarray, votes: Column, words: Column) -> Column:
    """The linear classifier as a column: the same inputs as it was trained on."""
    total = F.aggregate(F.slice(votes, 1, LEXICON_VOTERS), F.lit(0).cast("long"), lambda a, x: a + x)
    inputs = [F.log1p(votes[j]) for j in range(_VOTERS)]
    inputs += [F.log1p(total), F.log1p(100 * total / F.greatest(words, F.lit(1))), F.least(total, F.lit(1)), F.lit(1.0)]
    odds = sum((F.lit(float(c)) * x for c, x in zip(coefficients, inputs)), F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def _of_several_texts(rows: DataFrame) -> DataFrame:
    """The ids that different texts share: a label of such an id doesn't tell which of them it is of."""
    keys = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("text_key").alias("low"), F.max("text_key").alias("high"))
    return keys.filter("low <> high").select("doc_id")


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, text_key, held_out, score, predicted, votes) of every row of (doc_id, text); labels: (doc_id, toxic)."""
    known = training_labels(labels, "toxic", modulus, held_out)
    texts, toxic, weight = sample(docs, known, {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}, LONGEST_SAMPLED)
    lexicon = induce_lexicon(texts, toxic, weight)
    give_back()  # the driver's, too, is needed by what follows
    votes = with_text_key(docs).mapInArrow(
        partial(_vote_rows, lexicon=lexicon), "doc_id long, text_key long, votes array<long>, n_words long"
    )
    votes = materialize(votes, "toxicity-votes")
    learnt = votes.filter(~in_fold(F.col("doc_id"), modulus, held_out)).select(
        "doc_id", "text_key", _mask(F.col("votes")).alias("m")
    )
    tally = (
        learnt.drop("text_key")
        .join(known.join(_of_several_texts(learnt), "doc_id", "left_anti"), "doc_id", "left")
        .groupBy("m", F.coalesce("label", F.lit(-1)).alias("label"))
        .agg(F.count("*").alias("n"))
        .toArrow()  # at most three rows for each combination of the voters
    )
    columns = [tally[c].to_numpy() for c in ("m", "label", "n")]
    model = LabelModel(*columns) if len(columns[0]) else None
    strengths, words = vote_strengths(pa.array([*texts, ""], pa.large_string()), lexicon)
    x = _inputs(strengths, words)
    y = model.posterior(strengths) if model else np.zeros(len(x))
    coefficients = logistic(x, y, np.append(weight, 1.0))
    del texts, strengths, words, x, y
    gc.collect()
    give_back()
    score = score_expression(coefficients, F.col("votes"), F.col("n_words"))
    return votes.select(
        "doc_id", "text_key", in_fold(F.col("doc_id"), modulus, held_out).alias("held_out"), score.alias("score"),
        F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted"), "votes",
    )
