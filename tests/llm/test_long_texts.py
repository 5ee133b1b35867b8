"""Very long texts and very repetitive ones: equal to plain versions, within memory."""

import itertools
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from stratum.llm import decontaminate, line_crf

ROOT = Path(__file__).resolve().parents[2]

_OP6 = """
from stratum.llm import decontaminate as d
class Sent: value = d.build_index([("r", "w " * 500)], 8, 13)
rows = pa.table({"doc_id": [1], "text": ["w " * 20_000], "text_key": [1]}).to_batches()
before = peak()
found = [r for b in d._scan(iter(rows), Sent) for r in b.to_pylist()]
assert found[0]["n_hit"] == 20_000 and found[0]["items"] == ["r"]
"""
_OP8 = """
from stratum.llm import line_crf as c
import numpy as np
w = np.random.default_rng(1).normal(size=76)
model = c.Model(np.zeros(76), np.ones(76), w, np.zeros((2, 2)), np.array([1.0, 0.0]))
text = pa.array(["\\n" * (2 << 20)])
before = peak()
assert 0 < model.score(text)[0] < 1
"""


@pytest.mark.parametrize("body", [_OP6, _OP8], ids=["op6_repeated_words", "op8_line_feeds"])
def test_memory_stays_bounded(body):
    head = "import resource\nimport pyarrow as pa\npeak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024\n"
    out = subprocess.run([sys.executable, "-c", head + body + "print(peak() - before)"], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert float(out.stdout) < 300


@pytest.mark.parametrize("segment", [1, 2, 3, 1024])
def test_op8_marginals_equal_enumeration(monkeypatch, segment):
    monkeypatch.setattr(line_crf, "SEGMENT", segment)
    monkeypatch.setattr(line_crf, "_SLICE_LINES", 4)
    rng = np.random.default_rng(segment)
    lines = np.array([1, 7, 2, 5, 3])
    potential, pair = rng.normal(size=lines.sum()) * 2, rng.normal(size=(2, 2))
    p, expected = line_crf.marginals(potential, pair, lines)
    at, pairs = 0, np.zeros((2, 2))
    for n in lines:
        own, total, good = potential[at : at + n], 0.0, np.zeros(n)
        both = np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            steps = list(zip(labels, labels[1:]))
            weight = np.exp(sum(x for x, y in zip(own, labels) if y) + sum(pair[s] for s in steps))
            total += weight
            good += weight * np.array(labels)
            for s in steps:
                both[s] += weight
        assert np.allclose(p[at : at + n], good / total)
        pairs += both / total
        at += n
    assert np.allclose(expected, pairs)


def test_op8_slices_and_segments_change_no_score(monkeypatch):
    rng = np.random.default_rng(5)
    texts = ["\n".join(rng.choice(["a b c", "", "a b c", "!! 12 | x", "Long line of words words " * 9], n)) for n in (0, 1, 3, 400, 2500)]
    column = pa.array([*texts, "", None, "\n"], pa.large_string())
    model = line_crf.Model(rng.normal(size=76), 1 + rng.random(76), rng.normal(size=76), rng.normal(size=(2, 2)), np.array([1.0, 0.2]))
    features, characters, lines = line_crf.line_features(column)
    assert features.shape == (lines.sum(), line_crf.N_FEATURES)
    potential = (line_crf.with_neighbours(features, lines) - model.mean) / model.scale @ model.weights
    share = line_crf._document_share(line_crf.marginals(potential, model.pair, lines)[0], characters, lines)
    plain = 1 / (1 + np.exp(-line_crf._curve_inputs(share) @ model.curve))
    assert np.allclose(model.score(column), plain)
    monkeypatch.setattr(line_crf, "SEGMENT", 10)
    monkeypatch.setattr(line_crf, "_SLICE_LINES", 7)
    assert np.allclose(model.score(column), plain)


def test_op6_slices_of_pairs_change_no_hit(monkeypatch):
    items = [("a", "x y " * 40), ("b", "x " * 30), ("c", "y x y"), ("d", "z")]
    texts = ["x y " * 50, "x " * 100, "q y x y z", "z z", None, ""]

    def found():
        class Sent:
            value = decontaminate.build_index(items, 8, 13)

        rows = pa.table({"doc_id": range(6), "text": pa.array(texts), "text_key": range(6)}).to_batches()
        return [r for b in decontaminate._scan(iter(rows), Sent) for r in b.to_pylist()]

    whole = found()
    assert [r["items"] for r in whole] == [["a", "c"], ["b"], ["c", "d"], ["d"], [], []]
    for pairs in (1, 7, 64):
        monkeypatch.setattr(decontaminate, "_PAIRS", pairs)
        assert found() == whole
