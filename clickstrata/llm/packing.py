"""Documents packed into as few sequences of a fixed number of tokens as possible.

Tasks turn each text into token ids and cut what is longer than a sequence; what is left to
decide depends on lengths alone, and there are no more different lengths than tokens in a
sequence. So the driver plans with the histogram of lengths, whose size is bounded, and no piece
passes through it:

1. *Linear grouping.* Large lengths, in descending order, form groups of equal cardinality, and
   each group is rounded up to its largest length. What is large is tried at several limits.
2. *Configurations.* Over these few sizes, the linear programme of the ways to fill a sequence is
   solved by column generation: simplex steps over a basis of as many configurations as there are
   groups, new ones from a knapsack over the capacity. Each is used its whole number of times.
3. *Substitution.* Every slot of a configuration takes the next piece of its group, at its actual
   length. Sequences with equal lengths in them stay together as a run.
4. *Best fit.* All other lengths, in descending order, go where the least room is left that
   suffices, whole runs of sequences at a time; new sequences open where none suffices.

The plan is a list of moves: "of length l, ranks from .. to .. go to sequences from .. on, so many
each, at this offset". Tasks number the pieces of each length and look their move up. A length that a
third of all pieces share is numbered in buckets, so no task has to hold it.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import workspace
from clickstrata.llm.tokens import TOKENIZER, pre_tokens

#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END = 4096, 1

#: (part of a sequence above which a length is large, groups of large lengths). Each is planned
#: and the plan with the fewest sequences is used, the first of several. More groups waste less
#: by rounding up; a higher limit leaves more lengths to best fit, which fills many rooms of
#: odd sizes better than a few configurations do.
SETTINGS = ((1 / 6, 64), (1 / 4, 64), (1 / 4, 16), (1 / 3, 128), (1 / 3, 16), (1 / 2, 16))

#: Simplex steps at most; the basis is feasible after each, so a limit costs sequences at worst.
STEPS = 2000

#: Bytes of words and ids a worker remembers at once.
REMEMBERED_BYTES = 96_000_000

#: Pieces of one length that are numbered together: 2^BUCKET at most.
BUCKET = 20


# Token ids ---------------------------------------------------------------------------------

_LETTERS = "a-z\xdf-\xf6\xf8-\xffĀ-įĲ-ňŊ-ž"

#: Outside of ASCII and the common letters above (capitals too), a word is left to the library.
_RARE = re.compile(f"[^\x00-\x7f\xc0-\xd6\xd8-\xde{_LETTERS}]")

#: How the tokenizer cuts lower-cased text of those characters: fixed by its definition.
_UNITS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\t-\r\x20{_LETTERS}0-9]+"
)

#: How the strings of special tokens begin.
_SPECIAL = "<|"


def units(text: str) -> list[str]:
    """Parts that can be encoded one by one, in order."""
    if not _RARE.search(text):
        return _UNITS.findall(text.lower())
    found: list[str] = []
    for token in pre_tokens(text):
        if _RARE.search(token):
            found.append(token)
        else:
            found += _UNITS.findall(token.lower())
    return found


class TokenIds(dict):
    """Ids of units as little-endian 32-bit numbers, by the tokenizer itself, each encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = 0

    def _encode(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of units without rare characters, which the tokenizer does not cut: as one text."""
        encoded = self.tokenizer.encode(" ".join(units), add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4").tobytes()
        ends = 4 * (np.flatnonzero(np.diff(np.array(encoded.word_ids, int), append=-1)) + 1)
        found = [ids[start:end] for start, end in pairwise([0, *ends.tolist()])]
        return found if len(found) == len(units) else self._encode(units)

    def _learn(self, words: set[str]) -> None:
        if self.size > REMEMBERED_BYTES:
            self.clear()
            self.size = 0
        new = [w for w in words if w not in self]
        rare = [w for w in new if _RARE.search(w)]
        common = [w for w in new if not _RARE.search(w)]
        for some, encode in ((rare, self._encode), (common, self._encode_units)):
            for at in range(0, len(some), 4096):
                block = some[at : at + 4096]
                for word, ids in zip(block, encode(block), strict=True):
                    self[word] = ids
                    self.size += 160 + 2 * len(word) + len(ids)

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, whole."""
        found = [None if _SPECIAL in text else units(text) for text in texts]
        self._learn(set().union(*(u for u in found if u is not None)))
        return [
            self._encode([text])[0] if u is None else b"".join(map(self.__getitem__, u))
            for text, u in zip(texts, found, strict=True)
        ]


@lru_cache(maxsize=2)
def token_ids(name: str) -> TokenIds:
    """One table per worker. ``name``: a path, or a name in the public package."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    if os.path.sep not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return TokenIds(name)


def _pieces(tokenizer: str, capacity: int, end: int, with_ids: bool):
    """Documents to pieces, a few texts at a time."""
    last = np.array([end], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def batch_of(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        types = [id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        if with_ids:
            ids = [np.frombuffer(block, "<u4").astype(np.int32) for block in columns[5]]
            arrays.append(pa.array(ids, pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_ids(tokenizer)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for at in range(0, batch.num_rows, 64):
                block = [t.as_py() or "" for t in texts[at : at + 64]]
                rows = []
                for doc_id, encoded in zip(ids[at : at + 64].to_pylist(), table.of(block), strict=True):
                    encoded += last
                    for piece, start in enumerate(range(0, len(encoded) // 4, capacity)):
                        part = encoded[4 * start : 4 * (start + capacity)]
                        rows.append((doc_id, piece, start, len(part) // 4, zlib.crc32(part), part))
                yield batch_of(rows, ids.type)

    return run


def cut_documents(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of each document's ids and end id: ``piece``, ``start``, ``length``, ``ids_crc32``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(tokenizer, capacity, end, with_ids), schema + (", ids array<int>" if with_ids else "")
    )


# Plan --------------------------------------------------------------------------------------


class Move(NamedTuple):
    """Pieces of one length by rank: ``each`` to a sequence, one after the other."""

    length: int
    first_rank: int
    count: int
    sequence: int
    each: int
    offset: int


class Run(NamedTuple):
    """Sequences with the same lengths in them."""

    sequence: int
    count: int
    used: int


def _knapsack(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration: how often each size is in it."""
    most = capacity // min(sizes)
    best, choices = np.zeros(capacity + 1), []
    for _ in range(most):  # one more item each time
        better, choice = best.copy(), np.full(capacity + 1, -1)
        for item, size in enumerate(sizes):
            value = best[: capacity + 1 - size] + values[item]
            target = better[size:]
            gain = value > target + 1e-12
            target[gain] = value[gain]
            choice[size:][gain] = item
        choices.append(choice)
        best = better
    amounts, room = np.zeros(len(sizes)), capacity
    for choice in reversed(choices):
        item = choice[room]
        if item >= 0:
            amounts[item] += 1
            room -= sizes[item]
    return float(best[capacity]), amounts


def configurations(
    sizes: list[int], demands: list[int], capacity: int
) -> list[tuple[tuple[int, ...], int]]:
    """(amount of each size, times): whole parts of an optimal fractional solution."""
    basis = np.diag([float(capacity // s) for s in sizes])
    demand = np.array(demands, float)
    for _ in range(STEPS):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, column = _knapsack(sizes, prices, capacity)
        if value <= 1 + 1e-9:
            break
        amounts, direction = np.linalg.solve(basis, demand), np.linalg.solve(basis, column)
        ratios = np.full(len(sizes), np.inf)
        rising = direction > 1e-9
        ratios[rising] = np.maximum(amounts[rising], 0) / direction[rising]
        if not rising.any():
            break
        basis[:, int(ratios.argmin())] = column
    times = np.floor(np.linalg.solve(basis, demand) + 1e-6).astype(int)
    return [
        (tuple(int(a) for a in basis[:, c]), int(n)) for c, n in enumerate(times) if n > 0
    ]


class _Lengths:
    """Pieces of a group in descending order, taken from the front."""

    def __init__(self):
        self.parts: deque[tuple[int, int, int]] = deque()  # length, first rank, count

    def add(self, length: int, rank: int, count: int) -> None:
        self.parts.append((length, rank, count))

    def take(self, most: int) -> tuple[int, int, int] | None:
        """At most so many pieces of one length."""
        if not self.parts:
            return None
        length, rank, count = self.parts.popleft()
        if count > most:
            self.parts.appendleft((length, rank + most, count - most))
            count = most
        return length, rank, count


def _groups(large: list[tuple[int, int]], groups: int) -> list[_Lengths]:
    """(length, count), descending, in groups of equal cardinality."""
    total = sum(n for _, n in large)
    found, passed = [_Lengths() for _ in range(groups)], 0
    for length, count in large:
        rank = 0
        while rank < count:
            group = passed * groups // total
            # the first position that belongs to the next group
            ends = -(-(group + 1) * total // groups)
            part = min(count - rank, ends - passed)
            found[group].add(length, rank, part)
            rank += part
            passed += part
    return [g for g in found if g.parts]


def _substitute(pattern: tuple[int, ...], runs: list[Run], groups: list[_Lengths], moves: list[Move]) -> list[Run]:
    """Fill the slots of a configuration with the groups' pieces; runs split where lengths change."""
    for group, amount in enumerate(pattern):
        for _ in range(amount):
            filled: list[Run] = []
            for run in runs:
                at, left = run.sequence, run.count
                while left:
                    taken = groups[group].take(left)
                    if taken is None:  # fewer pieces than slots: the slot stays free
                        filled.append(Run(at, left, run.used))
                        break
                    length, rank, count = taken
                    moves.append(Move(length, rank, count, at, 1, run.used))
                    filled.append(Run(at, count, run.used + length))
                    at += count
                    left -= count
            runs = filled
    return runs


class _Rooms:
    """Runs by the room that is left in them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.runs: dict[int, list[Run]] = {}
        self.rooms: list[int] = []

    def add(self, run: Run) -> None:
        room = self.capacity - run.used
        if not room or not run.count:
            return
        if room not in self.runs:
            self.runs[room] = []
            insort(self.rooms, room)
        self.runs[room].append(run)

    def take(self, length: int) -> Run | None:
        """A run with the least room that suffices."""
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        run = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room], self.rooms[at]
        return run


def _best_fit(lengths: Iterable[tuple[int, int, int]], rooms: _Rooms, sequences: int, moves: list[Move]) -> int:
    """Place (length, first rank, count) in the given order; the number of sequences after it."""
    for length, rank, left in lengths:
        while left:
            run = rooms.take(length)
            if run is None:
                each = rooms.capacity // length
                run = Run(sequences, -(-left // each), 0)
                sequences += run.count
            each = (rooms.capacity - run.used) // length
            full = min(run.count, left // each)
            if full:
                moves.append(Move(length, rank, full * each, run.sequence, each, run.used))
                rooms.add(Run(run.sequence, full, run.used + each * length))
                rank += full * each
                left -= full * each
            rest = Run(run.sequence + full, run.count - full, run.used)
            if rest.count and left:  # fewer than fill one more
                moves.append(Move(length, rank, left, rest.sequence, each, rest.used))
                rooms.add(Run(rest.sequence, 1, rest.used + left * length))
                rest, left = Run(rest.sequence + 1, rest.count - 1, rest.used), 0
            rooms.add(rest)
    return sequences


def _plan(lengths: list[tuple[int, int]], capacity: int, part: float, groups: int) -> tuple[list[Move], int]:
    """Moves and number of sequences for (length, count), descending."""
    moves: list[Move] = []
    sequences, rooms = 0, _Rooms(capacity)
    large = [(n, c) for n, c in lengths if capacity * part < n < capacity]
    rest = [(n, 0, c) for n, c in lengths if n == capacity or n <= capacity * part]
    if large:
        queues = _groups(large, groups)
        sizes = [q.parts[0][0] for q in queues]
        demands = [sum(c for _, _, c in q.parts) for q in queues]
        for pattern, times in configurations(sizes, demands, capacity):
            for run in _substitute(pattern, [Run(sequences, times, 0)], queues, moves):
                rooms.add(run)
            sequences += times
        rest += [left for q in queues for left in q.parts]
    rest.sort(key=lambda left: -left[0])
    return moves, _best_fit(rest, rooms, sequences, moves)


def plan(
    histogram: Mapping[int, int],
    capacity: int = CAPACITY,
    settings: Iterable[tuple[float, int]] = SETTINGS,
) -> tuple[list[Move], int]:
    """Moves for all pieces of a histogram of lengths (1 .. capacity), and how many sequences."""
    lengths = sorted(((n, c) for n, c in histogram.items() if c), reverse=True)
    if lengths and not 1 <= lengths[-1][0] <= lengths[0][0] <= capacity:
        raise ValueError("a length is outside of a sequence")
    plans = [_plan(lengths, capacity, part, groups) for part, groups in settings]
    return min(plans, key=lambda p: p[1])


# Placing -----------------------------------------------------------------------------------

#: Bits for the rank below the length in a key of moves.
_RANK_BITS = 48


def _place(moves: list[Move], columns: list[str]):
    """Look up the move of each ranked piece."""
    table = np.array(sorted(moves), np.int64).reshape(-1, len(Move._fields))
    keys = (table[:, 0] << _RANK_BITS) + table[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            found = table[np.searchsorted(keys, (length << _RANK_BITS) + rank, "right") - 1]
            nth, each = rank - found[:, 1], found[:, 4]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in columns],
                    pa.array(found[:, 3] + nth // each),
                    pa.array(found[:, 5] + nth % each * length),
                ],
                [*columns, "sequence_id", "offset"],
            )

    return run


def _ranked(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0 on, in buckets of bounded size."""
    keyed = pieces.withColumn("bucket", F.shiftright("row", BUCKET))
    counts = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row"))
    numbered = keyed.withColumn("within", within - 1)
    return numbered.join(bases, ["length", "bucket"]).withColumn(
        "rank", F.col("base") + F.col("within")
    )


def pack_documents(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of each row of ``docs`` (``doc_id``, ``text``), with its place.

    A document is the ids of its whole text and the id ``end``; a null or empty text is that id
    alone. Only documents longer than a sequence are cut, into whole sequences and a rest.
    ``sequence_id`` and ``offset`` say where a piece lies; the pieces of a sequence leave no gap.
    Which of several pieces of one length goes where is not defined, nor are the numbers of the
    sequences. Repeated rows and rows without id are documents like all others; an empty table has no
    pieces; other columns are ignored. ``with_ids`` adds the ids of each piece.
    """
    with workspace(docs.sparkSession, "packing") as work:
        pieces = work.written(
            cut_documents(docs, tokenizer, capacity, end, with_ids).withColumn(
                "row", F.monotonically_increasing_id()  # fixed by being stored
            ),
            "pieces",
        )
        # one row per length, ``capacity`` at most
        histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
        moves, _ = plan(histogram, capacity)
        columns = [c for c in pieces.columns if c != "row"]
        types = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in columns)
        placed = _ranked(pieces).select(*columns, "rank").mapInArrow(
            _place(moves, columns), f"{types}, sequence_id bigint, offset bigint"
        )
        return work.result(placed)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` of each sequence, from pieces packed ``with_ids``.

    A sequence is no longer than its capacity, so no row or task grows with the table. Without
    pieces there are no sequences.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
