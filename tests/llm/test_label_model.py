"""The label model of op5 against plain expectation-maximisation, a text at a time."""

import math
import random

import numpy as np

from stratum.llm import toxicity

N = toxicity._VOTERS


def plain_posteriors(texts, labels, groups, first, prior, rounds=20):
    """texts: a list of votes each; P(toxic) of each after the rounds."""
    q = list(first)
    code = lambda votes, group: tuple(votes[j] for j in group)
    for _ in range(rounds):
        q = [0.995 if y == 1 else 0.005 if y == 0 else p for p, y in zip(q, labels)]
        rates = []
        for group in groups:
            counts = [{}, {}]
            for votes, p in zip(texts, q):
                for side, w in enumerate((1 - p, p)):
                    counts[side][code(votes, group)] = counts[side].get(code(votes, group), 0) + w
            size = 2 ** len(group)
            total = [sum(c.values()) + 0.1 * size for c in counts]
            rates.append([lambda k, c=c, t=t: (c.get(k, 0) + 0.1) / t for c, t in zip(counts, total)])
        prior = (sum(q) + 0.5) / (len(q) + 1 + 9.5)
        q = []
        for votes in texts:
            odds = math.log(prior / (1 - prior))
            for group, (clean, toxic) in zip(groups, rates):
                odds += math.log(toxic(code(votes, group)) / clean(code(votes, group)))
            q.append(1 / (1 + math.exp(-min(max(odds, -30), 30))))
    return q


def test_label_model_equals_plain_expectation_maximisation():
    rng = random.Random(3)
    texts, labels = [], []
    for _ in range(400):
        toxic = rng.random() < 0.2
        votes = [int(rng.random() < (0.5 if toxic else 0.03)) for _ in range(N)]
        votes[1] = votes[0] if rng.random() < 0.9 else votes[1]  # two that nearly always agree
        texts.append(votes)
        labels.append(rng.choice([-1, -1, int(toxic)]))
    masks = [sum(v << j for j, v in enumerate(votes)) for votes in texts]
    rows = sorted({(m, y) for m, y in zip(masks, labels)})
    n = [sum((m, y) == r for m, y in zip(masks, labels)) for r in rows]

    model = toxicity.LabelModel(np.array([m for m, _ in rows]), np.array([y for _, y in rows]), np.array(n))
    assert any({0, 1} <= set(g) for g in model.groups)
    assert sorted(j for g in model.groups for j in g) == list(range(N)) and max(map(len, model.groups)) <= 3

    first = np.linspace(0.1, 0.9, len(rows))
    model._fit(first)
    of = {r: p for r, p in zip(rows, first)}
    plain = plain_posteriors(texts, labels, model.groups, [of[m, y] for m, y in zip(masks, labels)], None)
    found = dict(zip(rows, model._posterior(model.bits)))
    assert np.allclose([found[m, y] for m, y in zip(masks, labels)], plain)


def kinds(rng, n, voters):
    """Vote masks of texts of one kind: some of its voters fire, at least one."""
    votes = [[rng.random() < 0.6 for _ in voters] for _ in range(n)]
    return [sum(1 << j for j, v in zip(voters, vote) if v) or 1 << voters[0] for vote in votes]


def test_a_kind_of_toxic_texts_on_which_few_voters_fire_is_toxic():
    rng = random.Random(5)
    toxic = kinds(rng, 200, [0, 1]) + kinds(rng, 300, list(range(4, 12)))
    texts = [(m, rng.choice([-1, -1, 1])) for m in toxic] + [(0, rng.choice([-1, -1, 0])) for _ in range(8_000)]
    rows = sorted(set(texts))
    model = toxicity.LabelModel(*(np.array(x) for x in zip(*((m, y, texts.count((m, y))) for m, y in rows))))
    votes = np.array([[m >> j & 1 for j in range(N)] for m in (1, 2, 3, 0, 1 << 12)])
    found = model.posterior(votes)
    assert (found[:3] > 0.9).all() and found[3] < 0.01
    assert found[4] == model._posterior(votes)[4]  # nothing is labelled that votes so


def test_weak_toxic_texts_are_predicted(spark):
    rng = random.Random(6)
    calm = [f"word{i}" for i in range(300)]
    abroad, loud = ["brakk", "zwurm"], ["gnarl", "vextor", "plimth", "quaspe", "drovik", "hulmet", "jorbin", "skelda"]

    def text(insults):
        words = rng.choices(calm, k=40) + insults
        rng.shuffle(words)
        return " ".join(words)

    kind = [rng.choices(["abroad", "loud", ""], [3, 4, 60])[0] for _ in range(4_000)]
    some = {"abroad": lambda: [rng.choice(abroad)], "loud": lambda: [w for w in loud if rng.random() < 0.6] or loud[:1], "": list}
    docs = spark.createDataFrame([(i, text(some[k]())) for i, k in enumerate(kind)], "doc_id long, text string")
    marks = [(i, int(bool(k))) for i, k in enumerate(kind) if i % 5 < 2]
    rows = toxicity.score_toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
    for wanted, predicted in (("abroad", 1), ("loud", 1), ("", 0)):
        of = [r.predicted for r in rows if r.held_out and kind[r.doc_id] == wanted]
        assert len(of) > 30 and sum(p == predicted for p in of) >= 0.97 * len(of), wanted
