"""Packing documents into token sequences: first-fit decreasing in randomised groups.

`tokenize` turns each document into pieces of at most `capacity` ids, `pack` places pieces of known length into
sequences. A group holds about `group_rows` pieces drawn at random, whatever their key, so groups are alike and
independent. Within a group pieces go, longest first, into the leftmost sequence that has room; a tournament tree over the
room left in each sequence finds it in a logarithmic number of steps. Only the documents longer than a sequence are cut.

Defined results: a null text is an empty text, whose only id is the closing one. Equal or repeated document ids
are separate documents. Pieces of no length or above the capacity are an error, as they cannot be placed.
A long text is tokenized whole and cut into pieces; an empty table gives no rows. Only key and text are read, so other columns
cannot clash.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import parts, slices

CAPACITY = 2048
GROUP_ROWS = 4000
CACHE_ENTRIES = 500_000  # distinct words that a worker remembers; the table then starts anew


# Fixed value: how the vocabulary's byte-level model splits a text before it merges.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOOSE = re.compile(r" (?:\s|\Z)")  # a space that does not stand before a word


def ranks(path: str) -> tuple[dict[bytes, int], list[str]]:
    """The vocabulary of a byte-level tokenizer file as bytes and merge ranks, and its added tokens, which are not among them. Its
    strings spell printable bytes as themselves, the others by the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelt = {chr(b): b for b in plain}
    spelt |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    added = [t["content"] for t in model["added_tokens"]]
    return {bytes(spelt[c] for c in s): i for s, i in model["model"]["vocab"].items() if s not in added}, added


class Words:
    """Byte-level BPE of one vocabulary file, remembered by word.

    The vocabulary's own splitting never joins characters on both sides of a space that stands before another
    character, so texts are cut there and the parts are encoded apart. Words not met yet are merged by `tiktoken` over the same
    vocabulary, whose calls for single words cost a third of those of `tokenizers`; whole texts that cannot be cut, or that hold
    the string of an added token, go to the latter. The ids are the same as the library's by default.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        table, added = ranks(path)
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.merge = tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}
        self.tails = {c: self.word(c) for c in ",."}

    def direct(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, text: str) -> bytes:
        return array("I", self.merge(text)).tobytes()

    def learn(self, words: set[str]) -> None:
        known, tails = self.known, self.tails
        if len(known) > CACHE_ENTRIES:
            known.clear()
        for w in words:
            # A letter and the mark behind it are split by the vocabulary, so the word alone is enough.
            stem = w[:-1] if w[-1] in tails and w[-2:-1].isalpha() else w
            ids = known.get(stem)
            if ids is None:
                ids = known[stem] = self.word(" " + stem)
            if stem is not w:
                known[w] = ids + tails[w[-1]]

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if LOOSE.search(text) or self.added.search(text):  # runs of white space, and added tokens, are split by rules of their own
            return self.direct(text)
        first, *words = text.split(" ")
        head = self.word(first) if first else b""
        look = self.known.__getitem__
        try:
            return head + b"".join(map(look, words))
        except KeyError:
            self.learn({w for w in words if w not in self.known})
        try:
            return head + b"".join(map(look, words))
        except KeyError:  # the table was just emptied
            self.learn(set(words))
            return head + b"".join(map(look, words))


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


PIECE = (
    T.StructField("start", T.LongType(), False), T.StructField("length", T.LongType(), False),
    T.StructField("doc_tokens", T.LongType(), False), T.StructField("ids", T.BinaryType(), False),
)


def tokenize(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
             closing: int = 1) -> DataFrame:
    """Rows (key, start, length, doc_tokens, ids): pieces of at most `capacity` ids; ids are little-endian unsigned
    32-bit numbers. Every document ends with `closing`."""
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    schema = T.StructType([rows.schema[0], *PIECE])
    names = schema.fieldNames()
    end = np.array([closing], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = words(tokenizer)
        for batch in slices(batches, "text"):
            at, starts, lengths, totals, ids = [], [], [], [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                data = encode(t or "") + end
                total = len(data) // 4
                for s in range(0, total, capacity):
                    at.append(i)
                    starts.append(s)
                    lengths.append(min(capacity, total - s))
                    totals.append(total)
                    ids.append(data[4 * s : 4 * (s + capacity)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(totals, pa.int64()), pa.array(ids, pa.binary())], names)

    return rows.mapInArrow(run, schema)


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """Bin of each length: the leftmost with room, found in a tournament tree whose nodes hold the most room below."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    placed = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need, node = lengths[i], 1
        if not 0 < need <= capacity:
            raise ValueError(f"a piece of {need} ids does not fit a sequence of {capacity}")
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        placed[i] = node - leaves
        room[node] -= need
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return placed


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, seed: int = 7) -> DataFrame:
    """Pieces with `sequence_id` (the group and a number in it) and `offset` in the sequence.

    All columns travel to the group of the piece; leave `ids` out where only the places are asked for.
    """
    groups = -(-max(1, pieces.count()) // group_rows)
    kept = [f for f in pieces.schema.fields if f.name.lower() not in ("sequence_id", "offset")]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["pack_group"].iat[0])
        bins = pd.Series(first_fit(rows["length"].tolist(), capacity), rows.index)
        rows["sequence_id"] = (group << 32) + bins
        rows["offset"] = rows["length"].groupby(bins).cumsum() - rows["length"]
        return rows[schema.fieldNames()]

    drawn = pieces.withColumn("pack_group", F.floor(F.rand(seed) * groups).cast("long"))
    return drawn.repartition(parts(pieces, groups, 1), "pack_group").groupBy("pack_group").applyInPandas(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: `sequence_id`, `ids` (concatenated in order) and `length`."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    return packed.groupBy("sequence_id").agg(
        F.aggregate(ordered, F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"), F.sum("length").alias("length")
    )
