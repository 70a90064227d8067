"""SentencePiece encoding that keeps the place of every piece in the original bytes, and decoding.

Normalization follows the model's compiled character map: at each byte the longest prefix that the map knows is
replaced, a character that it does not know stays, and every byte put out remembers the source bytes it came
from. Pieces of the normalized text are then projected to spans of the original. White space handling (dummy
prefix, collapsed runs) is done on the same aligned bytes.

A byte-pair model whose pieces hold the space mark only as a prefix never merges across a single space between
two other characters. The text is cut there, and each distinct chunk is encoded once per worker and remembered in a
table of bounded size. Models without that property are given whole texts.

Defined results: a null text is an empty text, an empty text has no pieces, lone marks (U+2581) count as spaces.
Extra columns stay as they are; `ids`, `begins`, `ends` and `decoded` replace columns of those names.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import ragged, slices

MARK = "▁"
CACHE_ENTRIES = 1_000_000  # distinct chunks that a worker remembers; the table then starts anew
BREAK = re.compile("(?<! ) (?! )")


class CharMap:
    """The compiled character map of a model: a double-array trie of byte prefixes and their replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of data[at:]."""
        units, found = self.units, None
        if not units:
            return None
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.texts[start : self.texts.index(b"\0", start)]


def width(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def normalize(text: str, chars: CharMap, dummy_prefix: bool, collapse: bool) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Normalized bytes with the begin and end of the source bytes that each came from."""
    data = text.encode("utf-8", "surrogatepass")
    if not chars.units and not collapse:
        n = len(data)
        begins, ends = np.arange(n, dtype=np.int64), np.arange(1, n + 1, dtype=np.int64)
        if dummy_prefix and n:
            return b" " + data, np.concatenate([[0], begins]), np.concatenate([[0], ends])
        return data, begins, ends
    out, begins, ends, at = bytearray(), [], [], 0
    while at < len(data):
        known = chars.longest(data, at)
        length, piece = known or (width(data[at]), data[at : at + width(data[at])])
        for byte in piece:
            if byte == 32 and collapse and (not out or out[-1] == 32):
                continue
            out.append(byte)
            begins.append(at)
            ends.append(at + length)
        at += length
    while collapse and out and out[-1] == 32:
        out.pop(), begins.pop(), ends.pop()
    if dummy_prefix and out:
        out, begins, ends = bytearray(b" ") + out, [0, *begins], [0, *ends]
    return bytes(out), np.array(begins, np.int64), np.array(ends, np.int64)


class Encoder:
    """One model in one worker."""

    def __init__(self, path: str):
        import sentencepiece as sp
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        self.chars = CharMap(spec.precompiled_charsmap)
        self.dummy, self.collapse = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.whole = sp.SentencePieceProcessor(model_file=path)
        # Its input is normalized here, so the inner model must leave it alone.
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        self.inner = sp.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.is_byte = np.array([p.type == pb.ModelProto.SentencePiece.BYTE for p in model.pieces])
        texts = [p.piece for p in model.pieces]
        self.sizes = np.array([1 if b else len(t.replace(MARK, " ").encode()) for t, b in zip(texts, self.is_byte)])
        self.cuts = (
            model.trainer_spec.model_type == pb.TrainerSpec.BPE
            and model.trainer_spec.byte_fallback
            and not any(MARK in t.lstrip(MARK) for t in texts)
        )
        self.known: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}  # chunks that decode to something else
        # Only unknown, control and byte pieces can decode to other than what they stand for.
        plain = pb.ModelProto.SentencePiece.NORMAL
        self.special = {i for i, p in enumerate(model.pieces) if p.type != plain}
        # Marks that no piece holds behind a letter or digit: a word and such a mark at its end are encoded apart.
        inside = {c for t in texts for b, c in zip(t, t[1:]) if b.isalnum()}
        self.tails = {c: array("i", self.inner.encode("a" + c)[1:]).tobytes() for c in ",." if c not in inside}

    def pieces(self, normal: str) -> np.ndarray:
        """Ids of one normalized text."""
        if not self.cuts or MARK in normal:
            return np.array(self.inner.encode(normal), np.int32)
        # Chunks are remembered without the space in front, all but the first.
        if "  " in normal or normal[0] != " ":
            first, *chunks = BREAK.split(normal)
            return np.concatenate([np.array(self.inner.encode(first), np.int32), self.looked_up(chunks)])
        return self.looked_up(normal.split(" ")[1:])

    def looked_up(self, chunks: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.frombuffer(b"".join(map(known.__getitem__, chunks)), np.int32)
        except KeyError:
            if len(known) > CACHE_ENTRIES:
                known.clear()
            new, tails, special = {c for c in chunks if c not in known}, self.tails, self.special
            stems = {c: c[:-1] if c[-1:] in tails and c[-2:-1].isalpha() else c for c in new}
            fresh = [s for s in set(stems.values()) if s not in known]
            for c, ids in zip(fresh, self.inner.encode([" " + c for c in fresh])):
                known[c] = array("i", ids).tobytes()
                if not special.isdisjoint(ids):
                    text = self.whole.decode(ids)  # without the space that a chunk begins with
                    if text != c:
                        self.odd[c] = text
            for c, s in stems.items():
                if s is not c:
                    known[c] = known[s] + tails[c[-1]]
                    if s in self.odd:
                        self.odd[c] = self.odd[s] + c[-1]
            return np.frombuffer(b"".join([known[c] for c in chunks]), np.int32)

    def lengths(self, ids: np.ndarray, normal: str) -> np.ndarray:
        """Bytes of the normalized text under each id."""
        sizes = self.sizes[ids]
        data = len(normal.encode("utf-8", "surrogatepass")) - 2 * normal.count(MARK)
        if int(sizes.sum()) == data:
            return sizes
        # Unknown pieces have the length of what they stand for, which only the library can tell.
        found = self.inner.encode(normal, return_type="proto")
        return np.array([len(p.surface.encode("utf-8", "surrogatepass")) for p in found.pieces], np.int64)

    def decoded(self, text: str, ids: np.ndarray) -> str:
        """The text of the ids of `text`: chunk by chunk where it was encoded so, each known to decode to itself."""
        plain = self.cuts and self.dummy and not self.chars.units and not self.collapse
        if plain and text and MARK not in text and "  " not in text and text[0] != " ":
            if not self.odd or self.odd.keys().isdisjoint(text.split(" ")):
                return text
        return self.whole.decode(ids.tolist()) if len(ids) else ""

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where the bytes of each begin and end in the original."""
        if text and self.dummy and not self.chars.units and not self.collapse and MARK not in text:
            # Nothing but the prefix is changed, and it has no bytes in the original.
            normal = " " + text
            ids = self.pieces(normal)
            stop = np.cumsum(self.lengths(ids, normal))
            return ids, np.maximum(np.concatenate([[0], stop[:-1]]) - 1, 0), stop - 1
        data, begins, ends = normalize(text, self.chars, self.dummy, self.collapse)
        if not data:
            return np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        normal = data.decode("utf-8", "surrogatepass")
        ids = self.pieces(normal)
        if MARK in normal:  # a mark of three bytes stands for itself in the source
            keep = np.ones(len(data), bool)
            for m in re.finditer(MARK.encode(), data):
                keep[m.start() + 1 : m.end()] = False
                ends[m.start()] = ends[m.end() - 1]
            begins, ends = begins[keep], ends[keep]
        stop = np.cumsum(self.lengths(ids, normal))
        start = np.concatenate([[0], stop[:-1]])
        return ids, begins[start], ends[stop - 1]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def fields(df: DataFrame, *new: T.StructField) -> T.StructType:
    names = {f.name.lower() for f in new}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in names] + list(new))


def encode(docs: DataFrame, model: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """Add `ids`, and `begins` and `ends`: byte offsets of each piece in the UTF-8 text. `model` is a path that
    every executor can open. With `decoded` the ids are also decoded in the same pass, as `decode` does."""
    added = [T.StructField(n, T.ArrayType(T.IntegerType(), False), False) for n in ("ids", "begins", "ends")]
    if decoded:
        added.append(T.StructField("decoded", T.StringType(), False))
    schema = fields(docs, *added)
    kept = [f.name for f in schema.fields[: -len(added)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in slices(batches, text):
            rows = batch.column(text).to_pylist()
            found = [enc(t or "") for t in rows]
            sizes = [len(f[0]) for f in found]
            lists = [
                ragged(np.concatenate([f[k] for f in found]).astype(np.int32, copy=False), sizes, pa.int32())
                for k in range(3)
            ]
            if decoded:
                texts = [enc.decoded(t or "", f[0]) for t, f in zip(rows, found)]
                lists.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *lists], schema.fieldNames())

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Add `decoded`: the text of the ids. A null list is an empty one."""
    schema = fields(encoded, T.StructField("decoded", T.StringType(), False))
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in slices(batches, ids):
            lists = [x if x is not None else [] for x in batch.column(ids).to_pylist()]
            texts = [enc.whole.decode(x) if x else "" for x in lists]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(texts, pa.string())], schema.fieldNames()
            )

    return encoded.mapInArrow(run, schema)
