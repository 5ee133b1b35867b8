"""Token ids of whole texts in Simple-8b files, in the order of their documents, and back.

The texts are dealt out by ranges of doc_id and sorted, so the files of one part follow those of the part before it.
A task encodes its texts, cuts them into blocks of whole documents and writes a row a block: the packed words, the ids
per document, and how many ids of the part stand before the block. Readers add the totals of earlier parts.

Null texts count as empty (one end id); null doc_ids come first; repeated rows are all written; an empty table gives
no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.simple8b import pack, unpack
from stratum.llm.text import chunks, encode_words, ragged, starts, table, translated
from stratum.sources.scratch import new_folder

BLOCK_SCHEMA = (
    "part int, block int, first long, doc_ids array<long>, lengths array<int>, words binary, word_offsets array<long>, "
    "escape_places array<long>, escape_values binary"
)
#: Blanks and line feeds part words: nothing that the tokenizer joins contains either of them. It lower-cases, too.
_LOWER = table(frozenset([0x20, 0x0A]))
_AS_IS = table(frozenset([0x20, 0x0A]), lower=False)
#: The tokenizer always cuts between an ASCII letter and punctuation other than an apostrophe.
_CUT = r"([a-z])([!-&(-/:-@\[-`{-~])"
#: Letters that are lower case, composed, and letters to the tokenizer's pattern.
_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ")
_CACHE_WORDS = 300_000
_NEW_WORDS = 1 << 15
_CHUNK = 4 << 20
_BLOCK_IDS = 1 << 18
_encoders: dict[str, _WordEncoder] = {}


class _WordEncoder:
    """Ids of distinct words in one pool; a worker keeps the words it has met, up to a bound and one piece's words.

    Beyond it, words of a single piece of text go, and of the others at most half the bound stays: most distinct words
    are rare, and only the frequent ones spare work.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spelled = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = str.maketrans({c: spelled.pre_tokenize_str(c)[0][0] for c in _PLAIN})
        self.known: dict[str, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)
        self.begin = np.zeros(0, np.int64)
        self.met = np.zeros(0, np.int32)  # in how many pieces

    def _forget_rare(self) -> None:
        kept = np.flatnonzero(self.met > 1)
        most = np.argsort(-self.met[kept], kind="stable")[: _CACHE_WORDS // 2]
        kept = kept[np.sort(most)]
        words = list(self.known)  # in the order of their numbers
        self.known = {words[i]: number for number, i in enumerate(kept.tolist())}
        self.pool = ragged(self.pool, self.begin[kept], self.sizes[kept])
        self.sizes, self.met = self.sizes[kept], self.met[kept] // 2
        self.begin = starts(self.sizes)[:-1]

    def _encode(self, words: list[str]) -> list[list[int]]:
        """A word of plain letters goes to the tokenizer's model at once: nothing before it would change or cut it."""
        ids = [[t.id for t in self.model.tokenize(w.translate(self.spelling))] if _PLAIN.issuperset(w) else None
               for w in words]
        others = [i for i, found in enumerate(ids) if found is None]
        encoded = self.tokenizer.encode_batch_fast([words[i] for i in others], add_special_tokens=False)
        for i, encoding in zip(others, encoded):
            ids[i] = encoding.ids
        return ids

    def __call__(self, words: list[str]) -> np.ndarray:
        """The number of each word; begin, sizes and pool have its ids."""
        if len(self.known) > _CACHE_WORDS:
            self._forget_rare()
        known = self.known
        numbers = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            numbers[missing] = np.arange(len(known), len(known) + len(missing))
            sizes, pool = [self.sizes], [self.pool]
            for at in range(0, len(missing), _NEW_WORDS):  # the lists of a few words at a time
                new = [words[i] for i in missing[at : at + _NEW_WORDS].tolist()]
                ids = self._encode(new)
                known.update(zip(new, range(len(known), len(known) + len(new))))
                sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
                pool.append(np.fromiter(chain.from_iterable(ids), np.uint32))
            self.sizes, self.pool = np.concatenate(sizes), np.concatenate(pool)
            self.begin = starts(self.sizes)[:-1]
            self.met = np.concatenate([self.met, np.zeros(len(missing), np.int32)])
        self.met[numbers] += 1
        return numbers


def _token_ids(column: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids per text with its end id, all ids)"""
    if path not in _encoders:
        _encoders[path] = _WordEncoder(path)
    encoder = _encoders[path]
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if pc.any(pc.match_substring(column, "<|")).as_py():  # may spell a special token, which is taken as it stands
        n_words, codes, words = encode_words(column, _AS_IS)
    else:
        n_words, codes, words = encode_words(pc.replace_substring_regex(translated(column, _LOWER), _CUT, r"\1 \2"))
    numbers = encoder(words.to_pylist())[codes] if len(codes) else codes
    lengths = encoder.sizes[numbers]
    flat = ragged(encoder.pool, encoder.begin[numbers], lengths) if len(codes) else encoder.pool[:0]
    ends = starts(lengths)[starts(n_words)]
    return np.diff(ends) + 1, np.insert(flat, ends[1:], end_id).astype(np.uint32)


def _encode_blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """A row a block; `first` counts the part's ids before it."""
    block = first = 0
    schema = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())), ("words", pa.binary()),
        ("word_offsets", pa.list_(pa.int64())), ("escape_places", pa.list_(pa.int64())),
        ("escape_values", pa.binary()),
    ])
    for rows in chunks(batches, most=_CHUNK):
        lengths, ids = _token_ids(rows.column("text"), path, end_id)
        edges, doc_ids = starts(lengths), rows.column("doc_id").to_pylist()
        cuts = np.flatnonzero(np.diff(edges[:-1] // _BLOCK_IDS, prepend=-1)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(doc_ids)]):
            words, offsets, places, values = pack(ids[edges[a] : edges[b]])
            columns = [
                [rows.column("part")[0].as_py()], [block], [first], [doc_ids[a:b]], [lengths[a:b]],
                [words.tobytes()], [offsets], [places], [values.tobytes()],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            block, first = block + 1, first + int(edges[b] - edges[a])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, parts: int | None = None) -> None:
    """Write (doc_id, text) below `path`: a file or more per part, a row per block."""
    n = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", "text")
        .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.crc32("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
        .withColumn("part", F.spark_partition_id())
    )
    ordered.mapInArrow(partial(_encode_blocks, path=tokenizer, end_id=end_id), BLOCK_SCHEMA).write.parquet(path)


def _decode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            lengths = np.array(row["lengths"], np.int64)
            edges = starts(lengths)
            ids = unpack(
                np.frombuffer(row["words"], np.uint64), np.array(row["word_offsets"], np.int64), int(edges[-1]),
                np.array(row["escape_places"], np.int64),
                np.frombuffer(row["escape_values"], np.uint64),
            ).astype("<u4")
            cut = edges.tolist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "start": pa.array(edges[:-1] + row["first"] + row["before"], pa.int64()),
                "n_tokens": pa.array(lengths, pa.int64()),
                "ids": pa.array([ids[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
            })


def read_token_files(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids: little-endian unsigned 32-bit integers) of every document written there."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    totals = blocks.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part of the files
    before = (
        totals.groupBy("part").agg(F.sum("n").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    placed = blocks.join(F.broadcast(before), "part").drop("part", "block")
    return placed.mapInArrow(_decode_blocks, "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the ids of (doc_id, text) and return what the files hold, with the crc32 of each document's ids."""
    spark = docs.sparkSession
    path = path or new_folder(spark, "token-ids")
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids"))
