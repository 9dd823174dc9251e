"""Benchmark decontamination on a distributed positional inverted index.

The index is a stored table of segments. A segment covers the words of some hundred documents:
for each term, the increasing list of its positions in the segment. A test phrase is answered
in every segment by itself: the lists of its terms, each moved back by the term's offset, are
intersected beginning with the shortest, so that what is left is where the phrase begins.
Segments are rows, so nothing is shuffled, and a document with very many hits is no more work
than its own words.

Words are those of the contract: A-Z lower-cased, runs of ``[0-9a-z]`` and non-ASCII characters.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import fresh_name, WORD_BYTES, Workspace, texts_of, workspace

#: Words of a test phrase.
WINDOW = 10

#: A segment is closed once it has this many words; one longer document has its own segment.
SEGMENT_WORDS = 1 << 20

#: Test texts are searched in blocks of about this many bytes, each sent to every task.
BLOCK_BYTES = 4 << 20

SEGMENT = (
    "doc_ids array<bigint>, doc_starts binary, n_positions bigint, "
    "terms binary, term_starts binary, postings binary"
)
SPANS = "array<struct<start:bigint,end:bigint>>"
FOUND = (
    f"segment string, number bigint, doc_id bigint, n_words bigint, items array<string>, spans {SPANS}, "
    f"near_items array<string>, near_spans {SPANS}"
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(WORD_BYTES).split()


# Index -------------------------------------------------------------------------------------


def _segment(doc_ids: list, texts: list[np.ndarray], terms: dict) -> pa.RecordBatch:
    lengths = np.array([len(t) for t in texts], np.int64)
    # one free position behind each document: no phrase runs across it
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    ids = np.concatenate(texts) if texts else np.empty(0, np.int32)
    places = np.arange(len(ids)) + np.repeat(np.arange(len(texts)), lengths)
    order = np.argsort(ids, kind="stable")
    postings = places[order]
    firsts = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(terms)))])
    gaps = np.diff(postings, prepend=0).astype(np.int64)  # small numbers compress well
    arrays = [
        pa.array([doc_ids], pa.list_(pa.int64())),
        pa.array([starts.astype(np.int64).tobytes()], pa.binary()),
        pa.array([int(starts[-1])], pa.int64()),
        pa.array([b" ".join(terms)], pa.binary()),
        pa.array([firsts.astype(np.int64).tobytes()], pa.binary()),
        pa.array([gaps.astype(np.int32).tobytes()], pa.binary()),
    ]
    names = ["doc_ids", "doc_starts", "n_positions", "terms", "term_starts", "postings"]
    return pa.RecordBatch.from_arrays(arrays, names)


def index_segments(docs: DataFrame, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index of whole documents: one row per segment, every document in one of them."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, texts, size, terms = [], [], 0, defaultdict()
        terms.default_factory = terms.__len__
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, data in zip(ids, texts_of(batch.column(1)), strict=True):
                words = words_of(data)
                doc_ids.append(doc_id)
                texts.append(np.fromiter(map(terms.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if size >= segment_words:
                    yield _segment(doc_ids, texts, terms)
                    doc_ids, texts, size = [], [], 0
                    terms.clear()
        if doc_ids:
            yield _segment(doc_ids, texts, terms)

    narrow = docs.select(F.col("doc_id").cast("bigint"), "text")
    return narrow.mapInArrow(build, SEGMENT)


def stored_index(docs: DataFrame, work: Workspace) -> DataFrame:
    """The index as a table of ``work``; its segments have names."""
    return work.written(index_segments(docs).withColumn("segment", F.uuid()), "index")


class Segment:
    """A segment's lists, for the terms of some test texts."""

    def __init__(self, row: dict):
        self.name, self.doc_ids = row["segment"], row["doc_ids"]
        self.starts = np.frombuffer(row["doc_starts"], np.int64)
        self.number = {t: i for i, t in enumerate(row["terms"].split())}
        self.firsts = np.frombuffer(row["term_starts"], np.int64)
        self.places = np.cumsum(np.frombuffer(row["postings"], np.int32), dtype=np.int64)

    def n_words(self) -> np.ndarray:
        return np.diff(self.starts) - 1

    def lists(self, terms: list[bytes]) -> list[np.ndarray]:
        """The positions of each term."""
        none = np.empty(0, np.int64)
        found = (self.number.get(t) for t in terms)
        return [none if i is None else self.places[self.firsts[i] : self.firsts[i + 1]] for i in found]

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in an increasing list."""
    at = np.searchsorted(ordered, values)
    return (at < len(ordered)) & (ordered[np.minimum(at, len(ordered) - 1)] == values)


def phrase_starts(phrase: np.ndarray, lists: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Positions where the phrase begins: rarest terms first, until nothing is left."""
    order = np.argsort(sizes[phrase], kind="stable")
    starts = lists[phrase[order[0]]] - order[0]
    for offset in order[1:]:
        if not len(starts):
            break
        starts = starts[_among(starts + offset, lists[phrase[offset]])]
    return starts


def near_places(phrase: np.ndarray, lists, sizes, reach: int, segment: Segment) -> np.ndarray:
    """Positions of the phrase's rarest term with every other term of it within ``reach``."""
    terms = np.unique(phrase)
    terms = terms[np.argsort(sizes[terms], kind="stable")]
    places = lists[terms[0]]
    for term in terms[1:]:
        if not len(places):
            break
        other = lists[term]
        doc = segment.doc_of(places)
        low = np.maximum(places - reach, segment.starts[doc])
        high = np.minimum(places + reach, segment.starts[doc + 1] - 2)
        places = places[np.searchsorted(other, high, "right") > np.searchsorted(other, low)]
    return places


# Search ------------------------------------------------------------------------------------


def _packed_items(items: list[tuple[str, bytes]]) -> bytes:
    """(ids, terms, term numbers of each text) of test texts that have words."""
    terms: defaultdict = defaultdict()
    terms.default_factory = terms.__len__
    texts = [(i, np.array([terms[w] for w in words_of(data)], np.int32)) for i, data in items]
    return pickle.dumps(([(i, t) for i, t in texts if len(t)], list(terms)))


@lru_cache(maxsize=2)
def _phrases(packed: bytes, window: int):
    """Terms; distinct phrases of each length; the items each phrase belongs to."""
    texts, terms = pickle.loads(packed)
    owners: dict[tuple, set] = defaultdict(set)
    for item_id, text in texts:
        n = min(window, len(text))
        for at in range(len(text) - n + 1):
            owners[tuple(text[at : at + n].tolist())].add(item_id)
    return terms, [(np.array(p, np.int64), sorted(ids)) for p, ids in owners.items()]


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """The union of intervals, as increasing disjoint ones."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return [
        {"start": int(s), "end": int(e)} for s, e in zip(starts[new], ends[last], strict=True)
    ]


def _answers(segment: Segment, packed: bytes, window: int, slop: int) -> pa.RecordBatch:
    terms, phrases = _phrases(packed, window)
    lists = segment.lists(terms)
    sizes = np.array([len(x) for x in lists], np.int64)
    n_docs = len(segment.doc_ids)
    items = [[set() for _ in range(n_docs)] for _ in range(2)]
    spans = [[[] for _ in range(n_docs)] for _ in range(2)]
    for phrase, ids in phrases:
        if not sizes[phrase].all():
            continue
        found = [(0, phrase_starts(phrase, lists, sizes), len(phrase))]
        if slop:
            reach = len(phrase) + slop - 1
            found.append((1, near_places(phrase, lists, sizes, reach, segment), 1))
        for kind, places, length in found:
            for doc, place in zip(segment.doc_of(places).tolist(), places.tolist(), strict=True):
                items[kind][doc].update(ids)
                spans[kind][doc].append((place, place + length))
    columns = []
    for kind in range(2):
        columns.append(pa.array([sorted(s) for s in items[kind]], pa.list_(pa.string())))
        merged = []
        for doc, pairs in enumerate(spans[kind]):
            both = np.array(pairs, np.int64).reshape(-1, 2) - segment.starts[doc]
            merged.append(_merged(both[:, 0], both[:, 1]) if pairs else [])
        kind_of = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns.append(pa.array(merged, kind_of))
    place = [
        pa.array([segment.name] * n_docs, pa.string()),
        pa.array(range(n_docs), pa.int64()),
        pa.array(segment.doc_ids, pa.int64()),
        pa.array(segment.n_words(), pa.int64()),
    ]
    names = ["segment", "number", "doc_id", "n_words"]
    names += ["items", "spans", "near_items", "near_spans"]
    return pa.RecordBatch.from_arrays([*place, *columns], names)


def search(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per indexed document: its words, and the test texts that it repeats.

    ``items`` are the ids of test texts one of whose phrases of ``window`` words occurs (a text
    of fewer words is one phrase), ``spans`` the words inside occurrences, as disjoint
    intervals. With ``slop``, ``near_items`` are those one of whose phrases has all its words
    within ``window + slop - 1`` words of an occurrence of its rarest word, in any order, and
    ``near_spans`` the places of that word.

    Test texts that are null or without words, or without an id, are ignored.
    """
    texts = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where(
        F.col("item_id").isNotNull() & F.col("text").isNotNull()
    )
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = int(total) // BLOCK_BYTES + 1
    block_of = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    answers = None
    for block in range(n_blocks):
        # one block of test texts, not the corpus: bounded by BLOCK_BYTES
        rows = texts.where(block_of == block).collect()
        packed = _packed_items(sorted((r["item_id"], r["text"].encode()) for r in rows))

        def answer(batches, packed=packed):
            for batch in batches:
                for row in range(batch.num_rows):
                    segment = Segment(batch.slice(row, 1).to_pylist()[0])
                    yield _answers(segment, packed, window, slop)

        part = index.mapInArrow(answer, FOUND)
        answers = part if answers is None else answers.unionByName(part)
    if n_blocks == 1:
        return answers.drop("segment", "number")
    merged = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "near_spans")]
    ids = [
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        for c in ("items", "near_items")
    ]
    return (
        answers.groupBy("segment", "number", "doc_id", "n_words")
        .agg(*ids, *merged)
        .drop("segment", "number")
    )


def covered(spans: Column) -> Column:
    """Number of words in intervals that may overlap."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("until"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda a, s: F.struct(
            (
                a["n"]
                + F.greatest(
                    F.lit(0).cast("bigint"), s["end"] - F.greatest(s["start"], a["until"])
                )
            ).alias("n"),
            F.greatest(a["until"], s["end"]).alias("until"),
        ),
        lambda a: a["n"],
    )


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0
) -> DataFrame:
    """``search`` over a stored index of ``docs``: one row per row of ``docs``.

    Null and empty texts have no words and no hits. Repeated rows are answered each; a null id
    stays null; an empty table gives an empty result; other columns are ignored.
    """
    with workspace(docs.sparkSession, "decontamination") as work:
        return work.result(search(stored_index(docs, work), items, window, slop))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, with all columns, that repeat no phrase of a test text.

    A document is known by its id: all rows of an id go if one of them has a hit. Rows without
    an id are kept only if there is no hit in any of them.
    """
    hits = find_contamination(docs, items, window).where(F.size("items") > 0)
    fresh = fresh_name("hit", docs)
    hits = hits.select(F.col("doc_id").alias(fresh)).distinct()
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col(fresh))
    return docs.join(hits, same, "left_anti")
