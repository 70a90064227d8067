"""Exact substring dedup: bytes under a string of `length` bytes that also starts in an earlier document go.

Text is cut into stretches by minimizers: of the short byte strings in a window of `length` bytes the one of
smallest hash names the window, and neighbouring windows of the same name form a stretch. Equal windows
have equal names, so stretches are sharded by name, and windows that could be equal meet in one shard. A
shard first drops the names that only one document uses; of the rest it builds a suffix array by Larsson-Sadakane refinement
(sort by the first bytes, then double the compared length within the groups that are still tied, up to
`length`), takes common prefixes with the neighbours by Kasai's scan, and has the first document of each
repeated window. It takes about `PIECE` bytes of whole names at a time, as windows of other names cannot be equal; a name above
`SHARD` bytes is built in several arrays whose sorted windows are merged by binary search.

Documents are dealt into blocks by a hash of their id. A block first tells each shard its names, and learns which of them
another document has. Of those it sends each distinct stretch once, with its first and last document, however many
documents share it, and gets back the first document of its windows, in runs. So a shard gets from the inside of a
hot passage one stretch a block, but from its edges, which hold each document's own context, one for each document.

Defined results: a null text is empty; a null document id counts as after all others. Documents with equal ids do not
remove from each other. Texts shorter than `length` bytes stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import parts, release, total_bytes
from ledgerloom.llm.ngram_join import mix

LENGTH = 50
GRAM = 20  # bytes whose hash is minimized
BLOCK = 4 << 20  # bytes of text in a block of documents, and whose stretches a shard gets
PIECE = 1 << 19  # bytes of repeated stretches in one suffix array, more where the stretches of one name have more
SHARD = 2_000_000  # most bytes of repeated stretches in one suffix array, some below the positions that INDEX bits can number
INDEX = 21
STEP = 1 << 18  # bytes that array operations take at once; each takes ten to fifty times as much memory
LAST = np.iinfo(np.int64).max


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian number, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data), ">u8", padded, strides=(1,)).astype(np.uint64)


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of each run of `width` neighbours."""
    done, out = 1, x
    while done * 2 <= width:
        out = np.minimum(out[: len(out) - done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def stretches(data: np.ndarray, doc_ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first window, windows) of each stretch in the concatenated documents; none crosses documents."""
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    word, grams = words_at(data), len(data) - GRAM + 1
    name = word[:grams] * np.uint64(0x9E3779B97F4A7C15)
    for at in sorted({*range(8, GRAM - 7, 8), GRAM - 8}):
        name ^= name >> np.uint64(31)
        name += word[at : at + grams]
        name *= np.uint64(0xBF58476D1CE4E5B9)
    name ^= name >> np.uint64(29)
    del word
    name = window_min(name, length - GRAM + 1)
    inside = np.ones(n, bool)
    for end in doc_ends[:-1]:
        inside[max(0, end - length + 1) : end] = False
    # A name that wins twice in a row by a later equal string is still one stretch; its windows stay in one shard.
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(name[1:], name[:-1], out=new[1:])
    new[1:] |= ~inside[:-1]
    new &= inside
    marks = np.flatnonzero(new | ~inside)
    count = np.diff(np.append(marks, n))[new[marks]]
    start = marks[new[marks]]
    # Very long stretches (a byte repeated on and on) are cut, so that their length is bounded.
    limit = 4 * length
    if not len(count) or count.max() <= limit:
        return name[start], start, count
    pieces = -(-count // limit)
    which = np.repeat(np.arange(len(start)), pieces)
    step = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = start[which] + step * limit
    return name[start][which], first, np.minimum(limit, count[which] - step * limit)


def steps(sizes: np.ndarray) -> Iterator[slice]:
    """Consecutive slices of rows whose sizes add up to about STEP."""
    cut = np.cumsum(sizes) // STEP
    edges = np.append(np.flatnonzero(np.diff(cut, prepend=-1)), len(sizes))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield slice(a, b)


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all [start, start + size) one after another."""
    out = [np.empty(0, np.uint8)]
    for part in steps(size):
        ends = np.cumsum(size[part])
        out.append(data[np.arange(ends[-1]) + np.repeat(start[part] - (ends - size[part]), size[part])])
    return np.concatenate(out)


def hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each [start, start + size)."""
    out = [np.empty(0, np.uint64)]
    for part in steps(size):
        ends = np.cumsum(size[part])
        place = np.arange(ends[-1]) - np.repeat(ends - size[part], size[part])
        flat = data[place + np.repeat(start[part], size[part])].astype(np.uint64)
        out.append(np.add.reduceat(mix(flat * np.uint64(0x100000001B3) + place.astype(np.uint64)), ends - size[part]))
    return np.concatenate(out)


def equal_runs(data: np.ndarray, name: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal stretches together, by place within them, and which ones equal the one before."""
    key = hashes(data, first, size)  # equal ones are confirmed byte by byte
    order = np.lexsort((first, key, name))
    name, key, first, size = name[order], key[order], first[order], size[order]
    same = np.zeros(len(name), bool)
    same[1:] = (name[1:] == name[:-1]) & (key[1:] == key[:-1]) & (size[1:] == size[:-1])
    pair = np.flatnonzero(same)
    if len(pair):
        equal = gather(data, first[pair], size[pair]) == gather(data, first[pair - 1], size[pair])
        same[pair] = np.logical_and.reduceat(equal, np.cumsum(size[pair]) - size[pair])
    return order, same


class Block:
    """The stretches of some documents, and the distinct ones among those of chosen names."""

    def __init__(self, rows: pd.DataFrame, length: int):
        texts, ids = rows["bytes"].tolist(), rows["id"].to_numpy()
        self.length = length
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        found, done = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))], 0
        for part in steps(np.array([len(t) for t in texts], np.int64)):
            start, ends = done, self.ends[part]
            done = int(ends[-1])
            name, first, count = stretches(self.data[start:done], ends - start, length)
            found.append((name, first + start, count))
        self.name, self.first, self.count = (np.concatenate(x) for x in zip(*found))
        self.doc = ids[np.searchsorted(self.ends, self.first, side="right")]

    def names(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct names by shard: shard, name, whether several documents have it, and which name a stretch has."""
        name, which = np.unique(self.name, return_inverse=True)
        low, high = np.full(len(name), LAST), np.full(len(name), np.iinfo(np.int64).min)
        np.minimum.at(low, which, self.doc)
        np.maximum.at(high, which, self.doc)
        shard = shard_of(name, shards)
        by = np.argsort(shard, kind="stable")
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        return shard[by], name[by], (low < high)[by], place[which]

    def distinct(self, chosen: np.ndarray) -> None:
        """Sort the chosen stretches into groups of equal bytes; `lead` is the first of each."""
        first, doc = self.first[chosen], self.doc[chosen]
        order, same = equal_runs(self.data, self.name[chosen], first, self.count[chosen] + self.length - 1)
        first, doc = first[order], doc[order]
        self.member_first, self.member_doc = first, doc
        self.lead = np.flatnonzero(~same)
        self.times = np.diff(np.append(self.lead, len(first)))


def shard_of(name: np.ndarray, shards: int) -> np.ndarray:
    return (mix(name) % np.uint64(shards)).astype(np.int64)


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of a sorted array of shards."""
    edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(1, int)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(shard[a]), slice(a, b)


def suffix_array(data: np.ndarray, length: int) -> np.ndarray:
    """Positions in order of the `length` bytes from them.

    Larsson-Sadakane: positions carry the number of their group; only groups of several are sorted on, by the group
    `depth` bytes ahead, which doubles the compared bytes.
    """
    n, low = len(data), np.uint64(INDEX)
    mask = np.uint64((1 << INDEX) - 1)
    # Key and position in one number: sorting numbers is much faster than sorting their order.
    packed = np.sort((words_at(data) >> np.uint64(24) << low) | np.arange(n, dtype=np.uint64))
    order, key = (packed & mask).astype(np.int32), packed >> low
    first = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.zeros(n + length, np.uint64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    depth = 5
    while depth < length:
        step = min(depth, length - depth)
        tied = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(tied):
            break
        at = order[tied]
        packed = np.sort((rank[at] << (low + low)) | (rank[at + step] << low) | at.astype(np.uint64))
        order[tied] = at = (packed & mask).astype(np.int64)
        key = packed >> low
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first[tied] = new
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] + 1
        depth += step
    return order


def kasai(data: np.ndarray, start: np.ndarray, count: np.ndarray, before: np.ndarray, place: np.ndarray,
          length: int) -> np.ndarray:
    """Common prefix, up to `length`, of each window with the position `before` it in the suffix array (-1: none).
    `place` is the place of each position among the sorted windows (-1: no window).

    Kasai's scan: if the follower of `before` also stands before the next window, the prefix falls by at most
    one from a window to the next; else it is counted anew. All stretches are scanned side by side.
    """
    out = np.zeros(len(before), np.int16)
    padded = np.concatenate([data, np.zeros(length + 1, np.uint8)])
    offset = np.cumsum(count) - count
    common = np.zeros(len(start), np.int64)
    for step in range(int(count.max()) if len(count) else 0):
        lane = np.flatnonzero(count > step)
        here, other = start[lane] + step, before[offset[lane] + step]
        h = np.zeros(len(lane), np.int64)
        if step:
            last = before[offset[lane] + step - 1]
            follows = place[np.where(last < 0, len(data), last + 1)]
            goes_on = (last >= 0) & (follows >= 0) & (follows < place[here]) & (other >= 0)
            h[goes_on] = np.maximum(common[lane[goes_on]] - 1, 0)
        going = np.flatnonzero((other >= 0) & (h < length))
        while len(going):
            equal = padded[here[going] + h[going]] == padded[other[going] + h[going]]
            going = going[equal]
            h[going] += 1
            going = going[h[going] < length]
        common[lane] = h
        out[offset[lane] + step] = h
    return out


def sorted_windows(data: np.ndarray, start: np.ndarray, count: np.ndarray, low: np.ndarray,
                   length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of equal windows in one suffix array: class of each window (stretch by stretch); first document
    and one position of each class, in the order of their bytes."""
    # A position takes four bytes: an array has less than 1 << INDEX of them, or one stretch.
    order = suffix_array(data, length)
    where = np.arange(int(count.sum()), dtype=np.int32) + np.repeat((start - (np.cumsum(count) - count)).astype(np.int32), count)
    slot = np.full(len(data), -1, np.int32)
    slot[where] = np.arange(len(where), dtype=np.int32)
    del where
    seq = order[slot[order] >= 0]  # windows alone, in suffix order
    del order
    before = np.full(len(seq), -1, np.int32)
    before[slot[seq[1:]]] = seq[:-1]
    place = np.full(len(data) + 1, -1, np.int32)
    place[seq] = np.arange(len(seq), dtype=np.int32)
    common = kasai(data, start, count, before, place, length)
    del before, place
    slot = slot[seq]
    head = common[slot] < length
    klass = np.empty(len(seq), np.int32)
    klass[slot] = np.cumsum(head, dtype=np.int32) - 1
    lows = np.repeat(low, count)[slot]
    lead = np.flatnonzero(head)
    first = np.minimum.reduceat(lows, lead) if len(lead) else lows
    return klass, first, seq[lead]


def merged(runs: list[tuple], length: int) -> list[np.ndarray]:
    """First document of each window of several suffix arrays: their sorted classes are merged by binary search."""
    keys = []
    for data, _, _, place in runs:
        padded = np.concatenate([data, np.zeros(length, np.uint8)])
        rows = np.lib.stride_tricks.sliding_window_view(padded, length)[place]
        keys.append(np.ascontiguousarray(rows).view(f"V{length}").ravel().view(f"S{length}"))
    firsts = [r[2].copy() for r in runs]
    for i in range(len(runs)):
        for j in range(len(runs)):
            if i == j or not len(keys[i]) or not len(keys[j]):
                continue
            found = np.minimum(np.searchsorted(keys[j], keys[i]), len(keys[j]) - 1)
            hit = keys[j][found] == keys[i]
            np.minimum.at(firsts[i], np.flatnonzero(hit), runs[j][2][found[hit]])
    return [first[klass] for (_, klass, _, _), first in zip(runs, firsts)]


def shard_answers(name, low, high, count, data, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretches that lose something, first document of each of their windows) of one shard."""
    kept, at, found = shard_windows(name, low, high, count, data, length)
    return kept, found[spread(at, count[kept])]


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all [start, start + count) one after another."""
    return np.arange(int(count.sum())) + np.repeat(start - (np.cumsum(count) - count), count)


def shard_windows(name, low, high, count, data, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretches that lose something, where their windows begin, first document of each window) of one shard; equal stretches
    share their windows."""
    none = np.empty(0, np.int64)
    order = np.argsort(name, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], name[order][1:] != name[order][:-1]])) if len(name) else np.empty(0, np.int64)
    if not len(edge):
        return none, none, none
    lows, highs = np.minimum.reduceat(low[order], edge), np.maximum.reduceat(high[order], edge)
    several = np.repeat(lows < highs, np.diff(np.append(edge, len(order))))
    kept = order[several]
    if not len(kept):
        return none, none, none
    size = count + length - 1
    offset = np.cumsum(size) - size
    # Blocks send the same stretch again; one of each goes into the arrays, under the first of its documents.
    order, same = equal_runs(data, name[kept], offset[kept], size[kept])
    kept, lead = kept[order], np.flatnonzero(~same)
    one, group = kept[lead], np.cumsum(~same) - 1
    first_low = np.minimum.reduceat(low[kept], lead)
    found = []
    for names in whole_names(name[one], size[one]):
        runs, some, lows = [], one[names], first_low[names]
        cut = np.cumsum(size[some]) // SHARD
        for c in range(int(cut[-1]) + 1):
            part = np.flatnonzero(cut == c)
            if len(part):
                own = gather(data, offset[some[part]], size[some[part]])
                start = np.cumsum(size[some[part]]) - size[some[part]]
                runs.append((own, *sorted_windows(own, start, count[some[part]], lows[part], length)))
        found += merged(runs, length) if len(runs) > 1 else [first[klass] for _, klass, first, _ in runs]
    return kept, (np.cumsum(count[one]) - count[one])[group], np.concatenate(found)


def whole_names(name: np.ndarray, size: np.ndarray) -> Iterator[slice]:
    """Consecutive slices of rows sorted by name, of about PIECE bytes; none cuts a name."""
    edge = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    own = np.add.reduceat(size, edge)
    lead = edge[np.flatnonzero(np.diff((np.cumsum(own) - own) // PIECE, prepend=-1))]
    for a, b in zip(lead.tolist(), [*lead[1:].tolist(), len(name)]):
        yield slice(a, b)


def pack_arrays(*arrays: np.ndarray) -> bytes:
    head = np.array([len(a.tobytes()) for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(a.tobytes() for a in arrays))


def unpack_arrays(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw[: 8 * len(kinds)], "<i8")
    out, at = [], 8 * len(kinds)
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def ordered(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of a block in an order that does not depend on how they were read."""
    digest = [hashlib.md5(b).digest() for b in rows["bytes"]]
    return rows.assign(digest=digest).sort_values(["id", "digest"], kind="stable").reset_index(drop=True)


def remove_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text",
                   carry: tuple[str, ...] = (), whole_characters: bool = False) -> DataFrame:
    """One row per document: (key, *carry, n_bytes, n_removed, n_spans, begins, ends, kept): removed runs as byte
    offsets in arrays, and the bytes that are left. With `whole_characters` a run is cut back to whole UTF-8 characters."""
    size = total_bytes(docs, text)
    blocks = shards = parts(docs, size, BLOCK)
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(key).cast("long"), F.lit(int(LAST))).alias("id"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("bytes"),
        *(F.col(c).alias(f"carry{i}") for i, c in enumerate(carry)),
    )
    # Rows of one id are spread by their text, so that an id of very many rows is not one block.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "bytes"), F.lit(blocks))).repartition(blocks, "block")

    def name(rows: pd.DataFrame) -> pd.DataFrame:
        """What a block tells each shard first: half of the hash of each name, and if several documents have it."""
        shard, names, several, _ = Block(ordered(rows), length).names(shards)
        half, block = (mix(names ^ np.uint64(LAST)) >> np.uint64(32)).astype(np.uint32), int(rows["block"].iat[0])
        out = [(block, k, half[at].tobytes(), np.packbits(several[at]).tobytes()) for k, at in by_shard(shard)]
        release()
        return pd.DataFrame(out, columns=["block", "shard", "names", "several"])

    def census(rows: pd.DataFrame) -> pd.DataFrame:
        """Which names of a block more than one document has, here or elsewhere; half a hash errs to that side."""
        sent = [np.frombuffer(x, np.uint32) for x in rows["names"]]
        flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(n)) for x, n in zip(rows["several"], sent)]
        which, count = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)[1:]
        shared = count > 1
        shared[which[np.concatenate(flags) > 0]] = True
        ends = np.cumsum([len(n) for n in sent])
        bits = [np.packbits(shared[which[e - len(n) : e]]).tobytes() for e, n in zip(ends, sent)]
        return pd.DataFrame({"block": rows["block"], "shard": rows["shard"], "bits": bits})

    def send(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        """The distinct stretches of shared names, to the shards of their names."""
        b = Block(ordered(rows), length)
        shard, _, _, which = b.names(shards)
        shared, bits = np.zeros(len(shard), bool), dict(zip(told["shard"], told["bits"]))
        for k, at in by_shard(shard):
            shared[at] = np.unpackbits(np.frombuffer(bits[k], np.uint8), count=at.stop - at.start)
        use = np.flatnonzero(shared[which]) if len(which) else which
        b.distinct(use)
        first, doc = b.member_first, b.member_doc
        low = np.minimum.reduceat(doc, b.lead) if len(doc) else doc
        high = np.maximum.reduceat(doc, b.lead) if len(doc) else doc
        at = np.searchsorted(b.first, first[b.lead])
        names, count, first = b.name[at], b.count[at], b.first[at]
        by = np.lexsort((first, shard_of(names, shards)))
        out = []
        for k, part in by_shard(shard_of(names[by], shards)):
            i = by[part]
            blob = pack_arrays(names[i], low[i], high[i], count[i].astype(np.int16), first[i].astype(np.int32),
                               gather(b.data, first[i], count[i] + length - 1))
            out.append((int(rows["block"].iat[0]), k, blob))
        del b
        release()
        return pd.DataFrame(out, columns=["block", "shard", "blob"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        """Runs of windows with the same first document, where that is before some document of the stretch."""
        release()  # what the shard before took
        sent = [unpack_arrays(x, "<u8", "<i8", "<i8", "<i2", "<i4", "<u1") for x in rows["blob"]]
        owner = np.repeat(np.arange(len(sent), dtype=np.int32), [len(x[0]) for x in sent])
        names, low, high, count, place, data = (np.concatenate(x) for x in zip(*sent))
        del sent
        count = count.astype(np.int64)
        kept, at, windows = shard_windows(names, low, high, count, data, length)
        runs = [(np.empty(0, np.int64), np.empty(0, np.int16), np.empty(0, np.int16), np.empty(0, np.int64))]
        for part in steps(count[kept]):
            own, each = kept[part], count[kept[part]]
            which, first, window = np.repeat(own, each), windows[spread(at[part], each)], spread(np.zeros(len(own), np.int64), each)
            use = first < high[which]
            which, window, first = which[use], window[use], first[use]
            new = np.ones(len(which), bool)
            new[1:] = (which[1:] != which[:-1]) | (first[1:] != first[:-1]) | (window[1:] != window[:-1] + 1)
            lead = np.flatnonzero(new)
            run = np.diff(np.append(lead, len(which))).astype(np.int16)
            runs.append((which[lead], window[lead].astype(np.int16), run, first[lead]))
        del names, low, high, count, data, kept, at, windows
        which, window, run, first = (np.concatenate(x) for x in zip(*runs))
        by = np.argsort(owner[which], kind="stable")
        out = []
        for i, part in by_shard(owner[which][by]):
            m = by[part]
            blob = pack_arrays(place[which[m]], window[m], run[m], first[m])
            out.append((int(rows["block"].iat[i]), int(rows["shard"].iat[i]), blob))
        del place, which, window, run, first, runs
        release()
        return pd.DataFrame(out, columns=["block", "shard", "blob"])

    result = T.StructType([
        T.StructField("key", rows.schema["key"].dataType),
        *(T.StructField(f"carry{i}", rows.schema[f"carry{i}"].dataType) for i in range(len(carry))),
        *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
        *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("begins", "ends")),
        T.StructField("kept", T.BinaryType()),
    ])

    def cut(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = ordered(rows)
        b = Block(rows, length)
        # Each run that covers a byte does so by a window of its own, so at most `length` do.
        change = np.zeros(len(b.data) + 1, np.int16 if length < 1 << 14 else np.int32)
        if len(answers):
            told = [unpack_arrays(x, "<i4", "<i2", "<i2", "<i8") for x in answers["blob"]]
            place, window, run, first = (np.concatenate(x).astype(np.int64) for x in zip(*told))
            asked = b.name[np.searchsorted(b.first, place)]
            b.distinct(np.flatnonzero(np.isin(b.name, asked)))
            heads = b.member_first[b.lead]
            by = np.argsort(heads)
            group = by[np.searchsorted(heads[by], place)]
            times = b.times[group]
            who = np.arange(int(times.sum())) + np.repeat(b.lead[group] - (np.cumsum(times) - times), times)
            hit = np.repeat(first, times) < b.member_doc[who]
            at = (b.member_first[who] + np.repeat(window, times))[hit]
            np.add.at(change, at, 1)
            np.add.at(change, at + np.repeat(run, times)[hit] + length - 1, -1)
            del place, window, run, first, group, who, hit, at
        np.cumsum(change, dtype=change.dtype, out=change)
        gone = change[:-1] > 0
        out, start = [], 0
        for raw, end in zip(rows["bytes"], b.ends.tolist()):
            own = gone[start:end]
            if whole_characters and len(own):  # a character stays if any of its bytes does
                leads = (b.data[start:end] & 0xC0) != 0x80
                leads[0] = True
                lead = np.flatnonzero(leads)
                own = np.repeat(np.logical_and.reduceat(own, lead), np.diff(np.append(lead, len(own))))
            flips = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
            begins, ends = flips[::2].astype(np.int32), flips[1::2].astype(np.int32)
            kept = b.data[start:end][~own].tobytes() if len(begins) else raw
            out.append((end - start, int(own.sum()), len(begins), begins, ends, kept))
            start = end
        out = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "begins", "ends", "kept"])
        del b, change, gone
        release()
        return pd.concat([rows[["key", *(f"carry{i}" for i in range(len(carry)))]], out], axis=1)

    named = dealt.groupBy("block").applyInPandas(name, "block long, shard long, names binary, several binary")
    told = named.repartition(shards, "shard").groupBy("shard").applyInPandas(census, "block long, shard long, bits binary")
    piece = "block long, shard long, blob binary"
    sent = dealt.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(send, piece)
    back = sent.repartition(shards, "shard").groupBy("shard").applyInPandas(answer, piece)
    found = dealt.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(cut, result)
    return found.withColumnsRenamed({"key": key} | {f"carry{i}": c for i, c in enumerate(carry)})
