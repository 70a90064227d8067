"""Sources whose records do not end where lines do, read in many tasks: quoted CSV and JSON arrays.

A file is scanned in input splits, cut at a separator (line ends, or commas) that may also stand inside a record. What a split
means depends on the state it starts in, and that on all splits before it. So a first scan reduces every split to a
transducer, three numbers that say how it changes each state; composed in file order they give the state at the start
of every split. A second scan cuts the records. One that runs over the end of its split leaves a fragment there and
others in the splits behind; only fragments are shuffled and put together.

The driver holds a few numbers for each split, as it does to plan the scan. States belong to places in a file, so it does no
harm if the second scan joins splits; a split that starts at a place without a state stops it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.errors import MalformedSource

State = tuple[int, int]  # inside a quoted text (0 or 1), depth of brackets
FRAGMENTS = "_file string, _block long, _row long, opens boolean, closes boolean, last boolean, text binary"


class QuotedLines:
    """CSV: a line end ends a record unless it stands inside quotes. Quotes stand around fields only, and are doubled within.
    Blank lines are no records."""

    separator = b"\n"
    start = (0, 0)  # the state between two records

    @staticmethod
    def quotes(values: pa.Array) -> np.ndarray:
        return pc.count_substring(values, b'"').to_numpy()

    @classmethod
    def effect(cls, values: pa.Array) -> tuple[int, int, int]:
        """Whether the pieces flip the inside, and what they add to the depth, from outside and from inside."""
        return int(cls.quotes(values).sum() & 1), 0, 0

    @classmethod
    def ends(cls, values: pa.Array, state: State) -> tuple[np.ndarray, State]:
        """Which pieces end a record, and the state behind them."""
        inside = (state[0] + np.cumsum(cls.quotes(values))) & 1
        return inside == 0, (int(inside[-1]), 0)

    @staticmethod
    def is_record(text: bytes) -> bool:
        return text not in (b"", b"\r")


class ArrayItems:
    """A JSON array: a comma outside texts at depth 1 ends an item. The first item has the opening bracket before it, the last
    one the closing bracket behind it."""

    separator = b","
    start = (0, 1)

    @staticmethod
    def depths(values: pa.Array, inside: int) -> tuple[np.ndarray, np.ndarray]:
        """Behind each piece: the depth, from 0 on, and whether it is inside a text."""
        pieces = values.to_pylist()
        text = np.frombuffer(b",".join(pieces) + b",", np.uint8)
        # A character is escaped if an odd number of backslashes stands right before it.
        at = np.arange(len(text), dtype=np.int32)
        slashes = at - np.maximum.accumulate(np.where(text == ord("\\"), -1, at))
        quote = text == ord('"')
        quote[1:] &= slashes[:-1] % 2 == 0
        within = ((inside + np.cumsum(quote, dtype=np.int32)) & 1).astype(bool)
        step = np.isin(text, (ord("["), ord("{"))).astype(np.int32) - np.isin(text, (ord("]"), ord("}")))
        step[within] = 0
        ends = np.cumsum(np.fromiter((len(p) + 1 for p in pieces), np.int64, len(pieces))) - 1
        return np.cumsum(step)[ends], within[ends]

    @classmethod
    def effect(cls, values: pa.Array) -> tuple[int, int, int]:
        (plain, inside), (quoted, _) = cls.depths(values, 0), cls.depths(values, 1)
        return int(inside[-1]), int(plain[-1]), int(quoted[-1])

    @classmethod
    def ends(cls, values: pa.Array, state: State) -> tuple[np.ndarray, State]:
        depth, within = cls.depths(values, state[0])
        depth = depth + state[1]
        return (depth == 1) & ~within, (int(within[-1]), int(depth[-1]))

    @staticmethod
    def is_record(text: bytes) -> bool:
        return True


Kind = type[QuotedLines] | type[ArrayItems]


def scan(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    return spark.read.option("lineSep", kind.separator.decode()).text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").cast("binary").alias("value"))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, block, values) of consecutive rows of one split."""
    for batch in batches:
        files, block = batch.column("_file"), batch.column("_block").to_numpy()
        other = block[1:] != block[:-1]
        if batch.num_rows > 1:
            other |= pc.not_equal(files.slice(1), files.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
        for i, j in zip(edges[:-1], edges[1:]):
            if j > i:
                yield files[i].as_py(), int(block[i]), batch.column("value").slice(i, j - i)


def composed(first: Sequence[int], then: Sequence[int]) -> tuple[int, int, int]:
    """The effect of two stretches one after the other."""
    return first[0] ^ then[0], first[1] + then[1 + first[0]], first[2] + then[2 - first[0]]


def start_states(pieces: DataFrame, kind: Kind) -> tuple[dict[str, dict[int, State]], dict[str, State]]:
    """The state at the start of each split of each file, and at the end of each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, block), found in groupby(runs(batches), key=lambda part: part[:2]):
            total = (0, 0, 0)
            for _, _, values in found:
                total = composed(total, kind.effect(values))
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (file, block, *total)], ["_file", "_block", "flips", "plain", "quoted"])

    states: dict[str, dict[int, State]] = {}
    ends: dict[str, State] = {}
    effects = pieces.mapInArrow(run, "_file string, _block long, flips long, plain long, quoted long")
    for r in sorted(effects.collect(), key=lambda r: (r["_file"], r["_block"])):
        inside, depth = ends.get(r["_file"], (0, 0))
        states.setdefault(r["_file"], {})[r["_block"]] = inside, depth
        ends[r["_file"]] = inside ^ r["flips"], depth + r["quoted" if inside else "plain"]
    return states, ends


def cut(pieces: DataFrame, kind: Kind, states: dict[str, dict[int, State]]) -> DataFrame:
    """(_file, _block, _row, first, last, text): each record under the split it starts in, `_row` counting from 0 there.

    `first` marks the first record of a file; `last` one that no separator ends, which only an array has."""
    glue = kind.separator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(file: str, block: int, rows: list[tuple]) -> pa.RecordBatch:
            row, opens, closes, last, text = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * len(rows)), pa.array([block] * len(rows)), pa.array(row, pa.int64()), pa.array(opens), pa.array(closes),
                 pa.array(last), pa.array(text, pa.binary())], ["_file", "_block", "_row", "opens", "closes", "last", "text"])

        for (file, block), found in groupby(runs(batches), key=lambda part: part[:2]):
            if block not in states.get(file, ()):
                raise RuntimeError(f"{file} has a split at {block} that was not there before; read it again")
            # A split that starts inside a record first gives out the rest of that one.
            state, row, held = states[file][block], 0, []
            opens = block == 0 or state == kind.start
            for _, _, values in found:
                ends, state = kind.ends(values, state)
                rows, texts, start = [], values.to_pylist(), 0
                for at in np.flatnonzero(ends).tolist():
                    text = glue.join([*held, *texts[start : at + 1]])
                    if not opens or kind.is_record(text):
                        rows.append((row if opens else -1, opens, True, False, text))
                        row += opens
                    opens, held, start = True, [], at + 1
                held += texts[start:]
                if rows:
                    yield given(file, block, rows)
            if held:
                # What the last split of a file holds from its start on is a record, that no separator ends.
                last = opens and block == max(states[file])
                yield given(file, block, [(row if opens else -1, opens, last, last, glue.join(held))])

    found = pieces.mapInArrow(run, FRAGMENTS)
    columns = ["_file", "_block", "_row", ((F.col("_block") == 0) & (F.col("_row") == 0)).alias("first"), "last"]
    whole = found.filter("opens AND closes").select(*columns, F.col("text").cast("string").alias("text"))
    if all(len(blocks) == 1 for blocks in states.values()):
        return whole  # no record runs over an edge: the files are read once
    # Fragments follow the one that opens their record. There are two a split at most.
    order = Window.partitionBy("_file").orderBy("_block", "_row")
    broken = found.filter("NOT (opens AND closes)").withColumn("_record", F.sum(F.col("opens").cast("int")).over(order))
    texts = F.array_sort(F.collect_list(F.struct("_block", F.col("text").cast("string").alias("text"))))
    mended = broken.groupBy("_file", "_record").agg(
        F.min("_block").alias("_block"), F.max("_row").alias("_row"), (~F.bool_or("closes")).alias("last"),
        F.array_join(F.transform(texts, lambda t: t["text"]), glue.decode()).alias("text"))
    return whole.unionByName(mended.select(*columns, "text"))


def records(spark: SparkSession, path: str, kind: Kind, problem: str) -> DataFrame:
    """The records of all files of a path, see `cut`. A file that ends in the midst of one stops the scan."""
    pieces = scan(spark, path, kind)
    states, ends = start_states(pieces, kind)
    for file, state in sorted(ends.items()):
        if state != (0, 0):
            raise MalformedSource(f"{file} {problem}")
    return cut(pieces, kind, states)
