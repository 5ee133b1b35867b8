"""SentencePiece BPE encoding and decoding by vectorised merge rounds over flat numpy symbol arrays.

Only the vocabulary (pieces, scores, kinds) comes from the model file; no tokenizer library takes part in the work.
A text becomes words: a run of blanks with what follows up to the next blank. No piece holds a blank behind another
character, so merges never cross words, and only the distinct words of a batch are encoded. In a round every word
merges the leftmost of its best-ranked pairs at once with all others, the arrays are compacted, and words without a
mergeable pair leave; it ends when none is left. One merge per word and round keeps the library's order of merges
exactly, also where a merged symbol opens a better pair. Characters without a piece become byte pieces. New words go
through the rounds in slices of a bounded number of symbols. A word of very many symbols, for which a merge a round
would take quadratic time, takes its merges from a heap instead, in the same order.

Null and empty texts encode to the end id alone and decode to an empty text; repeated rows are all returned; an empty
table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from stratum.llm.text import chunks, ragged, starts

BLANK = "▁"
_NO_RANK = np.iinfo(np.int32).max
_CACHE_WORDS = 100_000
_CHUNK_BYTES = 1 << 20
_SLICE_SYMBOLS = 1 << 17
#: Words of more symbols take their merges from a heap, and are not kept.
_LONG = 1 << 9
_vocabularies: dict[str, Vocabulary] = {}


class Vocabulary:
    """Pieces of a SentencePiece BPE model with byte fallback, and the pairs that merge."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        self.end_id = model.eos_id()
        self.is_byte = np.array([model.is_byte(i) for i in range(n)])
        plain = [
            not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            for i in range(n)
        ]
        self.ids = {p: i for i, p in enumerate(pieces) if plain[i]}
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.output = [
            bytes([int(p[3:5], 16)]) if b else p.replace(BLANK, " ").encode() if keep else b""
            for p, b, keep in zip(pieces, self.is_byte, plain)
        ]
        self.starts_blank = np.array([keep and p.startswith(BLANK) for p, keep in zip(pieces, plain)])
        self.is_control = np.array([model.is_control(i) for i in range(n)])

        # Symbols: characters of pieces without a piece of their own get ids from n on.
        self.symbols = dict(self.ids)
        for piece in list(self.ids):
            for character in piece:
                self.symbols.setdefault(character, n + len(self.symbols))
        self.base = max(self.symbols.values()) + 2
        self.unknown = self.base - 1
        by_score = sorted(self.ids, key=lambda p: -model.get_score(self.ids[p]))
        ranks, last, rank = {}, None, -1
        for piece in by_score:  # pieces of one score share a rank: then the leftmost pair goes first
            score = model.get_score(self.ids[piece])
            rank += score != last
            ranks[piece], last = rank, score
        pairs = sorted(
            (self.symbols[p[:cut]] * self.base + self.symbols[p[cut:]], ranks[p], self.ids[p])
            for p in self.ids
            for cut in range(1, len(p))
            if p[:cut] in self.symbols and p[cut:] in self.symbols
        )
        self.pair_keys, self.pair_ranks, self.pair_ids = (
            np.array(x, t) for x, t in zip(zip(*pairs), (np.int64, np.int32, np.int32))
        )
        self.pairs: dict[int, tuple[int, int]] = {}  # of those met in long words
        self.words: dict[str, np.ndarray] = {}

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank of each pair, the symbol it merges to)"""
        keys = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_ranks[at], _NO_RANK), self.pair_ids[at]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over words of `lengths` symbols each; (symbols, lengths) when no pair is left.

        What stands per symbol: its word, the rank of the pair it begins, and what that pair merges to. A round
        computes anew only the pairs beside a merge.
        """
        word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbols), _NO_RANK, np.int32)
        into = np.zeros(len(symbols), np.int32)
        if len(symbols) > 1:
            rank[:-1], into[:-1] = self.ranked(symbols[:-1], symbols[1:])
            rank[:-1][word[1:] != word[:-1]] = _NO_RANK
        while len(symbols):
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(begin, len(word)))
            best = np.minimum.reduceat(rank, begin)
            active = best < _NO_RANK
            if not active.all():
                done = np.repeat(~active, sizes)
                finished.append((word[done], symbols[done]))
                kept = ~done
                symbols, word, rank, into = symbols[kept], word[kept], rank[kept], into[kept]
                sizes, best = sizes[active], best[active]
                if not len(symbols):
                    break
                begin = starts(sizes)[:-1]
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]  # the leftmost of each word
            symbols[at] = into[at]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            at = np.cumsum(kept)[at] - 1
            symbols, word, rank, into = symbols[kept], word[kept], rank[kept], into[kept]
            rank[at] = _NO_RANK
            left = np.concatenate([at[at > 0] - 1, at])
            left = left[left + 1 < len(symbols)]
            same = word[left] == word[left + 1]
            left = left[same]
            rank[left], into[left] = self.ranked(symbols[left], symbols[left + 1])
        if not finished:
            return symbols, np.zeros(len(lengths), np.int64)
        words = np.concatenate([w for w, _ in finished])
        order = np.argsort(words, kind="stable")
        return np.concatenate([s for _, s in finished])[order], np.bincount(words, minlength=len(lengths))

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same merges of one word, from a heap of its pairs by rank and place: best first, then leftmost."""
        n = len(symbols)
        rank, into = self.ranked(symbols[:-1], symbols[1:])
        at = np.flatnonzero(rank < _NO_RANK)
        heap = list(zip(rank[at].tolist(), at.tolist(), symbols[at].tolist(), symbols[at + 1].tolist(), into[at].tolist()))
        heapq.heapify(heap)
        symbol, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, place, left, right, merged = heapq.heappop(heap)
            follower = after[place]
            if symbol[place] != left or follower == n or symbol[follower] != right:
                continue  # one of the two has been merged meanwhile
            symbol[place], symbol[follower] = merged, None
            after[place] = follower = after[follower]
            if follower < n:
                before[follower] = place
                self._push(heap, place, merged, symbol[follower])
            if before[place] >= 0:
                self._push(heap, before[place], symbol[before[place]], merged)
        return np.array([s for s in symbol if s is not None], symbols.dtype)

    def _push(self, heap: list, place: int, left: int, right: int) -> None:
        key = left * self.base + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > _CACHE_WORDS:
                self.pairs.clear()
            at = min(int(np.searchsorted(self.pair_keys, key)), len(self.pair_keys) - 1)
            hit = self.pair_keys[at] == key
            known = self.pairs[key] = (int(self.pair_ranks[at]), int(self.pair_ids[at])) if hit else (_NO_RANK, -1)
        if known[0] < _NO_RANK:
            heapq.heappush(heap, (known[0], place, left, right, known[1]))

    def _symbols(self, words: list[str]) -> np.ndarray:
        text = "".join(words)
        symbols = np.fromiter((self.symbols.get(c, self.unknown) for c in text), np.int32, len(text))
        for i in np.flatnonzero(symbols == self.unknown).tolist():
            symbols[i] = -1 - ord(text[i])  # no piece holds this character
        return symbols

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word; a worker keeps the shorter ones it has met, up to a bound."""
        if len(self.words) > _CACHE_WORDS:
            self.words.clear()
        long, part, size = {}, [], 0
        for word in words:
            if len(word) > _LONG:
                merged = self.merge_long(self._symbols([word]))
                long[word] = self._with_bytes(merged, np.array([len(merged)]))[0]
            elif word not in self.words:
                part.append(word)
                size += len(word)
                if size > _SLICE_SYMBOLS:
                    self._encode_new(part)
                    part, size = [], 0
        self._encode_new(part)
        return [long[w] if len(w) > _LONG else self.words[w] for w in words]

    def _encode_new(self, new: list[str]) -> None:
        if not new:
            return
        merged, sizes = self.merge(self._symbols(new), np.array([len(w) for w in new], np.int64))
        ids, sizes = self._with_bytes(merged, sizes)
        cut = starts(sizes).tolist()
        self.words.update(zip(new, (ids[a:b].copy() for a, b in zip(cut, cut[1:]))))

    def _with_bytes(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no pieces as the bytes of their character."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= len(self.output)))
        if not len(odd):
            return symbols.astype(np.int32), sizes
        names = {s: c for c, s in self.symbols.items() if s >= len(self.output)}
        spelled = {}
        for s in np.unique(symbols[odd]).tolist():
            character = chr(-1 - s) if s < 0 else names[s]
            spelled[s] = self.byte_ids[list(character.encode("utf-8", "surrogatepass"))]
        width = np.ones(len(symbols), np.int64)
        width[odd] = [len(spelled[s]) for s in symbols[odd].tolist()]
        out = np.repeat(symbols, width)
        places = starts(width)
        for i in odd.tolist():
            out[places[i] : places[i + 1]] = spelled[int(symbols[i])]
        word_ends = places[starts(sizes)]
        return out.astype(np.int32), np.diff(word_ends)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text with the end id, all ids)"""
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        texts = pc.replace_substring(texts, BLANK, " ")
        parts = pc.split_pattern(texts, " ")  # a blank is put before a text, so every part follows one
        values = parts.values.dictionary_encode()
        words = values.dictionary.to_pylist()
        codes = values.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = parts.offsets.to_numpy()
        empty = codes == (words.index("") if "" in words else -1)
        units = ~empty
        run = np.zeros(len(codes), np.int64)  # empty parts that stand right before: a longer run of blanks
        if empty.any():
            solid = np.where(empty, 0, np.arange(len(codes)) + 1)
            run = np.arange(len(codes)) - np.concatenate([[0], np.maximum.accumulate(solid)[:-1]])
            run = np.minimum(run, np.arange(len(codes)) - np.repeat(ends[:-1], np.diff(ends)))
            units[ends[1:] - 1] = True  # a text's last run of blanks stands alone
            units[ends[:-1][pc.equal(texts, "").to_numpy(zero_copy_only=False)]] = False
        keys = run[units] * (len(words) + 1) + codes[units]
        distinct, inverse = np.unique(keys, return_inverse=True)
        spelled = [BLANK * (k // (len(words) + 1) + 1) + words[k % (len(words) + 1)] for k in distinct.tolist()]
        pieces = self.encode_words(spelled)
        sizes = np.array([len(p) for p in pieces], np.int64)
        pool = np.concatenate([*pieces, np.zeros(0, np.int32)])
        lengths = sizes[inverse]
        flat = ragged(pool, starts(sizes)[:-1][inverse], lengths)
        edges = starts(lengths)[np.concatenate([[0], np.cumsum(units)])[ends]]
        return np.diff(edges) + 1, np.insert(flat, edges[1:], self.end_id)

    def decode(self, lengths: np.ndarray, ids: np.ndarray) -> list[str]:
        """The texts of runs of ids: one blank before a text goes, bytes that are no UTF-8 become U+FFFD each."""
        output, out, at = self.output, [], 0
        for n in lengths.tolist():
            run = ids[at : at + n]
            at += n
            spoken = np.flatnonzero(~self.is_control[run])
            raw = b"".join(map(output.__getitem__, run.tolist()))
            if len(spoken) and self.starts_blank[run[spoken[0]]]:
                raw = raw[1:]
            try:
                out.append(raw.decode())
            except UnicodeDecodeError:
                out.append(_lenient(raw))
        return out


def _lenient(raw: bytes) -> str:
    """Every byte that is part of no character becomes a U+FFFD of its own."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def _encode_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = vocabulary(path)
    for rows in chunks(batches, most=_CHUNK_BYTES, forget=model.words.clear):
        lengths, ids = model.encode(rows.column("text"))
        flat = pa.array(ids, pa.int32())
        lists = pa.ListArray.from_arrays(pa.array(starts(lengths), pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), lists], names=["doc_id", "ids"])


def _decode_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = vocabulary(path)
    for batch in batches:
        ids = pc.fill_null(batch.column("ids"), [])
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        texts = model.decode(pc.list_value_length(ids).to_numpy(zero_copy_only=False), flat)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
        )


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) of every row of (doc_id, text), the end id last."""
    return docs.select("doc_id", "text").mapInArrow(partial(_encode_rows, path=model), "doc_id long, ids array<int>")


def decode(ids: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of every row of (doc_id, ids)."""
    return ids.select("doc_id", "ids").mapInArrow(partial(_decode_rows, path=model), "doc_id long, text string")


def _round_trip_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = vocabulary(path)
    for rows in chunks(batches, most=_CHUNK_BYTES, forget=model.words.clear):
        lengths, ids = model.encode(rows.column("text"))
        yield pa.RecordBatch.from_pydict({
            "doc_id": rows.column("doc_id"),
            "n_tokens": pa.array(lengths, pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array(starts(lengths), pa.int32()), pa.array(ids, pa.int32())),
            "text": pa.array(model.decode(lengths, ids), pa.string()),
        })


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the ids of every row of (doc_id, text), and what they decode to."""
    schema = "doc_id long, n_tokens long, ids array<int>, text string"
    return docs.select("doc_id", "text").mapInArrow(partial(_round_trip_rows, path=model), schema)


def _digest_rows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = vocabulary(path)
    spelled = [str(i) for i in range(len(model.output))]
    for rows in chunks(batches, most=_CHUNK_BYTES, forget=model.words.clear):
        lengths, ids = model.encode(rows.column("text"))
        texts = model.decode(lengths, ids)
        cut, listed = starts(lengths).tolist(), ids.tolist()
        joined = [" ".join(map(spelled.__getitem__, listed[a:b])) for a, b in zip(cut, cut[1:])]
        yield pa.RecordBatch.from_pydict({
            "doc_id": rows.column("doc_id"),
            "n_tokens": pa.array(lengths, pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined]),
            "decoded_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts]),
        })


def digest(docs: DataFrame, model: str) -> DataFrame:
    """Digests of the ids and of the text decoded from them, made in the task that encodes: ids are not stored."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(partial(_digest_rows, path=model), schema)
