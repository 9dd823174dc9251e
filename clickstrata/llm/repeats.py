"""Removal of repeated passages with automata over words.

A window is ``window`` consecutive words; all windows but the first with their words go.

* *Recurring passages.* Every window names one anchor: of its runs of ``anchor`` words the one
  with the smallest hash. Equal windows name equal anchors, so only anchors that occur again
  matter. The document with the smallest id that has an anchor owns it.
* *Shards.* Owners are dealt to shards. A shard compiles its recurring anchors, as they first
  stand in their owners, into one Aho-Corasick automaton. The documents that have one of them
  are streamed through it, in pieces of bounded size, so that a passage of very many documents
  is many tasks. Of a document's words, those of windows that name one of the shard's anchors go
  through it; the windows at the place where the owner first names it are first themselves. Each
  occurrence found is extended along the owner's text; the windows of that stretch stand in the
  owner too, and there they come first.
* *The rest.* A window with a recurring anchor that does not match its owner's text can only
  repeat another such window. These are few; they are grouped by their hash.

Anchors are chosen by hashes that are sums over the bytes of a word, taken for a whole text at
once. Chance decides by them which anchors are named, but never that words are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import (
    Workspace,
    mixed,
    shingle_hashes,
    texts_of,
    workspace,
)

#: Words of a window, and of the anchor it names.
WINDOW = 20
ANCHOR = 8

#: Routes of documents to a shard, and documents of a piece, about.
SHARD_ROUTES = 1000
PIECE_ROWS = 1500

#: Bits of a digit of a word's number in the automaton.
DIGIT_BITS = 5

LAST = (1 << 63) - 1


#: Bytes to bytes: 1 for white space, 0 for all else.
WHITE = bytes(b in b" \t\n\v\f\r" for b in range(256))

#: Bytes of texts that are worked on together, at least, of these hashed in one step, and of the
#: longest word that is hashed with others.
CHUNK_BYTES = 1 << 18
BLOCK_BYTES = 1 << 15
LONG_WORD = 1 << 8


def _powers(base: int) -> np.ndarray:
    powers = np.full(BLOCK_BYTES + LONG_WORD, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


# the place of a byte, and, for the first byte of a word, the inverse
BASE = 0x9E3779B97F4A7C15 | 3
POWERS, INVERSES = _powers(BASE), _powers(pow(BASE, -1, 1 << 64))


def _edges(flags: np.ndarray, value: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of flags that have this value."""
    turns = np.flatnonzero(flags[1:] != flags[:-1]) + 1
    low = [0] if len(flags) and flags[0] == value else []
    high = [len(flags)] if len(flags) and flags[-1] == value else []
    edges = np.concatenate([low, turns, high]).astype(np.int64)
    return edges[::2], edges[1::2]


def words_of(data: bytes) -> list[bytes]:
    """Runs without ASCII white space."""
    return data.split()


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of a text's words, as ``words_of`` has them, and their 64-bit hashes."""
    values = np.frombuffer(data, np.uint8)
    starts, ends = _edges(np.frombuffer(data.translate(WHITE), bool), False)
    hashes = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + BLOCK_BYTES, BLOCK_BYTES)).tolist()
    for block, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        base = block * BLOCK_BYTES
        part = values[base : base + BLOCK_BYTES + LONG_WORD].astype(np.uint64)
        part += np.uint64(1)
        part *= POWERS[: len(part)]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=sums[1:])
        first, last = starts[low:high] - base, np.minimum(ends[low:high] - base, len(part))
        hashes[low:high] = (sums[last] - sums[first]) * INVERSES[first]
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return starts, ends, mixed(hashes)


def _first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the first smallest of every ``width`` consecutive values."""
    places, covered = np.arange(len(values)), 1
    while covered < width:
        step = min(covered, width - covered)
        later = values[step:] < values[:-step]
        values = np.where(later, values[step:], values[:-step])
        places = np.where(later, places[step:], places[:-step])
        covered += step
    return places


def anchors_of(hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all anchors by place; the place of each window's anchor (the first smallest)."""
    every = shingle_hashes(hashes, anchor)
    width = window - anchor + 1
    if len(every) < width:
        return every, np.empty(0, np.int64)
    return every, _first_smallest(every, width)


def _new(places: np.ndarray) -> np.ndarray:
    """Whether each of some places that never fall differs from the one before."""
    new = np.ones(len(places), bool)
    np.not_equal(places[1:], places[:-1], out=new[1:])
    return new


class Chunk:
    """Some texts as one, its words and, of the windows that lie in one text, their anchors."""

    def __init__(self, texts: list[bytes], window: int, anchor: int):
        self.data = b" ".join(texts)
        self.starts, self.ends, hashes = hashed_words(self.data)
        firsts = np.fromiter(accumulate((len(t) + 1 for t in texts), initial=0), np.int64)
        #: of each text, and at the end, the number of words before
        self.bounds = np.searchsorted(self.starts, firsts)
        self.every, places = anchors_of(hashes, window, anchor)
        left = np.repeat(self.bounds[1:], np.diff(self.bounds)) - np.arange(len(hashes))
        #: whether a window lies in one text; of those that do, the anchor's place is another
        #: than that of the one before; these places
        self.whole = left[: len(places)] >= window
        places = places[self.whole]
        self.new = _new(places)
        self.places = places[self.new]

    def texts(self, places: np.ndarray) -> np.ndarray:
        """Numbers of the texts that the words at some places belong to."""
        return np.searchsorted(self.bounds, places, "right") - 1

    def named(self) -> np.ndarray:
        return self.every[self.places].view(np.int64)


def chunked(texts: Iterable[bytes]) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def anchor_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """``doc, anchor``: one row for each place that some window of a document names."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, counts = [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
            for texts in chunked(texts_of(batch.column(2))):
                chunk = Chunk(texts, window, anchor)
                found.append(chunk.named())
                counts.append(np.diff(np.searchsorted(chunk.places, chunk.bounds)))
            ends = np.cumsum(np.concatenate(counts)).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed], ["doc", "anchors"])

    made = docs.mapInArrow(anchors, "doc bigint, anchors array<bigint>")
    return made.select("doc", F.explode("anchors").alias("anchor"))


def _stretch(a: list[bytes], p: int, b: list[bytes], q: int, window: int) -> tuple[int, int]:
    """The longest stretch of ``a`` around ``p`` that stands in ``b`` around ``q``.

    It ends where a window with place ``p`` can end, so that a search costs no more than its
    occurrences, however repetitive the text.
    """
    low, least = 0, min(p, q, window - 1)
    if a[p - least : p] == b[q - least : q]:
        low = least
    while low < least and a[p - low - 1] == b[q - low - 1]:
        low += 1
    high, most = 0, min(len(a) - p, len(b) - q, window)
    if a[p : p + most] == b[q : q + most]:
        high = most
    while high < most and a[p + high] == b[q + high]:
        high += 1
    return p - low, p + high


class Passages:
    """The recurring anchors that some documents own, in one automaton over word numbers.

    The automaton looks its next state up among all that follow one by one. Each word is
    therefore several digits of a small alphabet, other digits in each place, so that a match
    begins where a word does. A key is a text with one character for each digit.
    """

    def __init__(self, window: int, anchor: int):
        import ahocorasick

        self.window, self.anchor = window, anchor
        self.owners: dict[int, tuple[int, list[bytes], int]] = {}
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton()

    def own(self, doc: int, data: bytes, anchors: list[int]) -> None:
        """Add a document's anchors, each where it is first named; the earliest row counts."""
        chunk, words = Chunk([data], self.window, self.anchor), words_of(data)
        named, first = np.unique(chunk.named(), return_index=True)
        own = np.isin(named, np.array(anchors, np.int64))
        places = chunk.places[first[own]]
        for value, at in zip(named[own].tolist(), places.tolist(), strict=True):
            before = self.owners.get(value)
            if before is None or at < before[2]:
                self.owners[value] = (doc, words, at)

    def _digits(self, numbers: np.ndarray) -> str:
        digits = np.empty((len(numbers), self.width), np.uint8)
        for place in range(self.width):
            digit = (numbers >> (DIGIT_BITS * place)) & ((1 << DIGIT_BITS) - 1)
            digits[:, place] = digit + (place << DIGIT_BITS)
        return digits.tobytes().decode("latin-1")

    def compile(self) -> None:
        texts = [words[at : at + self.anchor] for _, words, at in self.owners.values()]
        for text in texts:
            for w in text:
                self.numbers.setdefault(w, len(self.numbers) + 1)
        self.width = -(-len(self.numbers).bit_length() // DIGIT_BITS) or 1
        keys = self._digits(self._numbers([w for text in texts for w in text]))
        size = self.width * self.anchor
        for i, owner in enumerate(self.owners.values()):
            self.automaton.add_word(keys[i * size : (i + 1) * size], owner)
        if self.owners:
            self.automaton.make_automaton()
        keys = np.array(sorted(self.owners), np.int64)
        self.keys = keys
        self.docs = np.array([self.owners[k][0] for k in keys.tolist()], np.int64)
        self.places = np.array([self.owners[k][2] for k in keys.tolist()], np.int64)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words; 0 for words that are in no anchor."""
        return np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))

    def _later(self, docs: np.ndarray, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of windows that name an owned anchor elsewhere than its
        owner first does. Those at that place repeat no other: whoever has them before would be
        the owner."""
        named, texts = chunk.named(), chunk.texts(chunk.places)
        key = np.minimum(np.searchsorted(self.keys, named), len(self.keys) - 1)
        at = chunk.places - chunk.bounds[texts]
        first = (self.docs[key] == docs[texts]) & (self.places[key] == at)
        flags = np.zeros(len(chunk.whole), bool)
        flags[chunk.whole] = ((self.keys[key] == named) & ~first)[np.cumsum(chunk.new) - 1]
        return _edges(flags, True)

    def _repeated(self, words: list[bytes], docs: list[int], places: list[int]) -> np.ndarray:
        """For the window at each word, whether an owner has it before. ``docs`` and ``places``
        are where a word comes from."""
        repeated = np.zeros(len(words), bool)
        for last, (owner, text, at) in self.automaton.iter(self._digits(self._numbers(words))):
            here = last // self.width - self.anchor + 1
            if owner > docs[here] or (owner == docs[here] and at >= places[here]):
                continue
            low, high = _stretch(words, here, text, at, self.window)
            if high - low >= self.window:
                repeated[low : high - self.window + 1] = True
        return repeated

    def scan(self, docs: np.ndarray, texts: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Stretches that repeat an owner's text, as (number of the text, start, end), and the
        windows left open, as (number of the text, hash, start)."""
        none = [np.empty(0, np.int64)] * 3
        if not len(self.keys):
            return none, none
        chunk = Chunk(texts, self.window, self.anchor)
        low, high = self._later(docs, chunk)
        if not len(low):
            return none, none
        words: list[bytes] = []
        last = chunk.ends[high + self.window - 2]
        for a, b in zip(chunk.starts[low].tolist(), last.tolist(), strict=True):
            words += words_of(chunk.data[a:b])
            words.append(b"")  # no word of an owner, so that nothing runs on
        # each word's run, and the place in its text
        size = high - low + self.window
        first = np.cumsum(size) - size
        run = np.repeat(np.arange(len(low)), size)
        text = chunk.texts(low)
        index = np.arange(len(words))
        place = index + (low - chunk.bounds[text] - first)[run]
        text = text[run]
        repeated = self._repeated(words, docs[text].tolist(), place.tolist())
        a, b = _edges(repeated, True)
        stretches = [text[a], place[a], place[b - 1] + self.window]
        opened = np.flatnonzero((index - first[run] < (high - low)[run]) & ~repeated)
        joined = b" ".join(words)
        firsts = list(accumulate((len(w) + 1 for w in words), initial=0))
        codes = np.fromiter(
            (
                xxhash.xxh3_64_intdigest(joined[firsts[i] : firsts[i + self.window] - 1])
                for i in opened.tolist()
            ),
            np.uint64,
            len(opened),
        )
        return stretches, [text[opened], codes.view(np.int64), place[opened]]


FOUND = "kind int, doc bigint, content bigint, a bigint, b bigint"


def _scanned(window: int, anchor: int):
    """``kind`` 0: words ``a`` to ``b`` repeat; 1: the window at ``b`` with hash ``a`` is open."""

    def scan(table: pa.Table) -> pa.Table:
        passages = Passages(window, anchor)
        docs, contents = table.column("doc").to_numpy(), table.column("content").to_numpy()
        kinds, texts, anchors = (table.column(c) for c in ("kind", "text", "anchors"))
        kinds = kinds.to_numpy()
        for i in np.flatnonzero(kinds == 0).tolist():
            (data,) = texts_of([texts[i]])
            passages.own(int(docs[i]), data, anchors[i].as_py())
        passages.compile()
        visitors = np.flatnonzero(kinds == 1)
        found: list[list[np.ndarray]] = [[], []]
        at = 0
        for chunk in chunked(texts_of(texts[i] for i in visitors.tolist())):
            rows = visitors[at : at + len(chunk)]
            at += len(chunk)
            for part, (text, a, b) in zip(found, passages.scan(docs[rows], chunk), strict=True):
                part.append(np.stack([docs[rows[text]], contents[rows[text]], a, b]))
        empty = np.empty((4, 0), np.int64)
        stretches, opened = (np.concatenate([empty, *part], axis=1) for part in found)
        doc, _, code, start = opened
        opened = opened[:, np.lexsort((start, code, doc))]
        doc, content, code, start = opened
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
        again = start > start[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
        more = [
            np.where(again, 0, 1),
            doc,
            content,
            np.where(again, start, code),
            np.where(again, start + window, start),
        ]
        columns = [np.zeros(stretches.shape[1], np.int64), *stretches]
        columns = [np.concatenate(pair) for pair in zip(columns, more, strict=True)]
        kind = pa.array(columns[0].astype(np.int32))
        return pa.table([kind, *map(pa.array, columns[1:])], ["kind", "doc", "content", "a", "b"])

    return scan


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc`` orders the documents (a null id is the last); ``content`` tells texts apart."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"),
        F.xxhash64("text").alias("content"),
        "text",
    )


def repeated_spans(docs: DataFrame, window: int, anchor: int, work: Workspace) -> DataFrame:
    """``doc, content, a, b``: words ``a`` to ``b`` of a text are in windows that go.

    Spans of a text may overlap. See ``remove_repeats`` for the rule.
    """
    keyed = _keyed(docs)
    rows = anchor_rows(keyed, window, anchor).repartition("anchor")
    recurring = rows.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("count"), F.min("doc").alias("owner")
    )
    recurring = recurring.where("count > 1").select("anchor", "owner")
    pairs = work.written(rows.join(recurring, "anchor"), "recurring-anchors")
    routes = work.written(pairs.select("doc", "owner").distinct(), "routes")
    shards = routes.count() // SHARD_ROUTES + 1
    shard = F.pmod(F.xxhash64("owner"), F.lit(shards))
    visits = routes.select("doc", shard.alias("shard")).distinct()
    loads = visits.groupBy("shard").agg(
        ((F.count(F.lit(1)) / PIECE_ROWS).cast("bigint") + 1).alias("pieces")
    )
    visits = visits.join(loads, "shard").select(
        "doc",
        "shard",
        F.pmod(F.xxhash64("doc"), "pieces").alias("piece"),
        F.lit(1).alias("kind"),
        F.expr("cast(null as array<bigint>)").alias("anchors"),
    )
    # an owner's anchors are words of its own text
    owned = pairs.where("doc = owner").groupBy("owner").agg(F.collect_set("anchor").alias("anchors"))
    owners = owned.withColumn("shard", shard).join(loads, "shard").select(
        F.col("owner").alias("doc"),
        "shard",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)).alias("piece"),
        F.lit(0).alias("kind"),
        "anchors",
    )
    sent = keyed.join(visits.unionByName(owners), "doc")
    found = work.written(
        sent.groupBy("shard", "piece").applyInArrow(_scanned(window, anchor), FOUND), "found-repeats"
    )
    opened = found.where("kind = 1")
    firsts = opened.groupBy("a").agg(F.count(F.lit(1)).alias("count"), F.min("doc").alias("first"))
    later = opened.join(firsts.where("count > 1"), "a").where("doc > first")
    return found.where("kind = 0").select("doc", "content", "a", "b").unionByName(
        later.select("doc", "content", F.col("b").alias("a"), (F.col("b") + window).alias("b"))
    )


def kept_words(words: list[bytes], starts: list[int], ends: list[int]) -> list[bytes]:
    """The words that are in none of some spans."""
    kept: list[bytes] = []
    at = 0
    for start, end in sorted(zip(starts, ends, strict=True)):
        kept += words[at:start]
        at = max(at, end)
    return kept + words[at:] if starts else words


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, kept_sha256`` for every row of ``docs``.

    A word goes if a window that covers it has the words of a window that starts earlier: in a
    document with a smaller id, or in the same document further ahead. Windows are judged on
    the input. ``kept`` are the other words, joined by single spaces.

    Null and empty texts have no words. A null id comes after all ids. Rows that repeat an id
    count as one document: between their texts, the earlier start decides, and equal rows get
    equal results. An empty table gives an empty result; other columns are ignored.
    """
    with workspace(docs.sparkSession, "repeats") as work:
        each = repeated_spans(docs, window, anchor, work).groupBy("doc", "content")
        spans = work.result(each.agg(F.collect_list(F.struct("a", "b")).alias("spans")))
    same = ["doc", "content"]
    joined = _keyed(docs).join(spans, same, "left").select("doc", "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, data, spans in zip(
                batch.column(0), texts_of(batch.column(1)), batch.column(2), strict=True
            ):
                words = words_of(data)
                ends = spans.values.flatten() if spans.is_valid else [pa.array([], pa.int64())] * 2
                kept = kept_words(words, *(e.to_pylist() for e in ends))
                text = b" ".join(kept)
                doc_id = doc.as_py()
                out.append(
                    (
                        None if doc_id == LAST else doc_id,
                        len(words),
                        len(words) - len(kept),
                        text.decode("utf-8", "surrogatepass"),
                        hashlib.sha256(text).hexdigest(),
                    )
                )
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = zip(*out, strict=True) if out else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    kinds = "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"
    return joined.mapInArrow(remove, kinds)
