"""What a worker keeps between pieces of text stays bounded, and bounds change no result."""

import public_tokenizers
import pyarrow as pa
import tokenizers

from stratum.llm import token_output

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_op10_keeps_frequent_words_and_a_bounded_number_of_rare_ones():
    encoder = token_output._WordEncoder(TOKENIZER)
    frequent = [f"often{i}" for i in range(1000)]
    for piece in range(6):
        encoder([*frequent, *(f"w{piece}x{i}" for i in range(100_000))])
    assert len(encoder.known) < 420_000
    assert encoder.known.keys() >= set(frequent)
    assert list(encoder.known.values()) == list(range(len(encoder.known)))


def test_op10_forgetting_words_changes_no_ids(monkeypatch):
    monkeypatch.setattr(token_output, "_CACHE_WORDS", 20)
    monkeypatch.setattr(token_output, "_NEW_WORDS", 3)
    monkeypatch.setattr(token_output, "_encoders", {})
    plain = tokenizers.Tokenizer.from_file(TOKENIZER)
    for piece in range(12):
        texts = [f"the quick {piece} fox-{piece * i} don't naïve{i}\nend" for i in range(piece % 5 * 6)] + ["the end", ""]
        lengths, ids = token_output._token_ids(pa.array(texts), TOKENIZER, 1)
        expected = [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts]
        assert lengths.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [i for e in expected for i in e]
    assert "the" in token_output._encoders[TOKENIZER].known
