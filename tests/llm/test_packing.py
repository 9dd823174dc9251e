"""Packing: ids against the library, plans against their histogram, counts against bounds."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickstrata.llm import packing
from clickstrata.llm.tokens import TOKENIZER


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(TOKENIZER))


def expected(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


ALPHABET = (
    "abcXYZ  \t\n\x0b\x0c\r\x1c\x1f\x85\xa0'09.,!?<|>_-éÉßẞİıſʼnΣσςÀ́ñ漢字🙂½²ªµ​ 　ŒœžŽ\x00\x7f"
)


def test_units_give_the_ids_of_the_library(library):
    rng = random.Random(11)
    table = packing.TokenIds(public_tokenizers.path(TOKENIZER))
    words = ["it's", "THEY'RE", "<|endoftext|>", "<|startoftext|>", "don't", "''s", "!'s", "3rd", "Straße"]
    for _ in range(40):
        texts = [
            "".join(
                rng.choice(words) if rng.random() < 0.1 else rng.choice(ALPHABET)
                for _ in range(rng.randrange(0, 40))
            )
            for _ in range(100)
        ]
        for text, ids in zip(texts, table.of(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == expected(library, text)[:-1], repr(text)


def test_small_memory(library, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 2000)
    table = packing.TokenIds(public_tokenizers.path(TOKENIZER))
    for n in range(30):
        texts = [f"word{n} other {n}", "again and again"]
        for text, ids in zip(texts, table.of(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == expected(library, text)[:-1]


def unrolled(moves):
    """(sequence, offset, length) of every piece, and its (length, rank)."""
    for m in moves:
        for nth in range(m.count):
            yield (m.sequence + nth // m.each, m.offset + nth % m.each * m.length, m.length), (m.length, m.first_rank + nth)


def check_plan(histogram, capacity, settings=packing.SETTINGS):
    moves, sequences = packing.plan(histogram, capacity, settings)
    places, ranks = zip(*unrolled(moves)) if moves else ((), ())
    assert Counter(n for n, _ in ranks) == Counter({n: c for n, c in histogram.items() if c})
    assert len(set(ranks)) == len(ranks)
    assert all(0 <= rank < histogram[n] for n, rank in ranks)
    ends = {}
    for sequence, offset, length in sorted(places):
        assert ends.get(sequence, 0) == offset
        ends[sequence] = offset + length
    assert len(ends) == sequences and set(ends) == set(range(sequences))
    assert all(e <= capacity for e in ends.values())
    return sequences, len(moves)


def best_fit_decreasing(histogram, capacity):
    rooms = []
    for n in sorted(histogram, reverse=True):
        for _ in range(histogram[n]):
            fitting = [r for r in rooms if r >= n]
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - n)
            else:
                rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_plans_are_packings(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 64, 100, 500])
    most = rng.choice([capacity, capacity // 2, capacity // 3 + 1])
    histogram = Counter(rng.randint(1, most) for _ in range(rng.choice([0, 1, 5, 60, 400])))
    sequences, _ = check_plan(histogram, capacity)
    assert sequences <= best_fit_decreasing(histogram, capacity)
    for setting in packing.SETTINGS:
        check_plan(histogram, capacity, [setting])


def test_thirds_and_halves_fit_without_waste():
    # lengths of which only some combinations fill a sequence; best fit alone needs more
    histogram = {50: 600, 27: 1200, 26: 600, 24: 600, 23: 1200}
    sequences, _ = check_plan(histogram, 100)
    fewest = -(-sum(n * c for n, c in histogram.items()) // 100)
    assert sequences < 0.98 * best_fit_decreasing(histogram, 100)
    assert sequences < 1.01 * fewest


def test_plan_does_not_grow_with_the_number_of_pieces():
    rng = random.Random(4)
    small = Counter(rng.randint(1, 4096) for _ in range(20_000))
    large = {n: 1_000_000 * c for n, c in small.items()}
    (few, a), (many, b) = packing.plan(small), packing.plan(large)
    assert len(few) < 40_000 and len(many) < 40_000
    tokens = sum(n * c for n, c in large.items())
    assert b < 1.01 * tokens / 4096
    assert sum(m.count for m in many) == 20_000 * 1_000_000
    with pytest.raises(ValueError):
        packing.plan({5000: 1})
    with pytest.raises(ValueError):
        packing.plan({0: 1})


def check_pieces(rows, docs, library, capacity=4096):
    ends = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert ends[r.sequence_id] == r.offset
        ends[r.sequence_id] += r.length
    assert max(ends.values(), default=0) <= capacity
    wanted = Counter()
    for doc_id, text in docs:
        ids = expected(library, text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            wanted[doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    return len(ends)


def test_documents_are_packed(spark, library, rows_of):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(["alpha", "Béta", "x!", "1234"]) for _ in range(int(rng.expovariate(1 / 400))))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (None, "no id"), (None, None), (3, docs[3][1]), (3, docs[3][1])]
    docs += [(2000, "long text " * 30_000), (2001, "a <|endoftext|> b"), (2002, "🙂 Σ" * 3000)]
    docs += [(3000 + i, "same") for i in range(500)]  # a hot length
    table = rows_of(docs, ["sequence_id", "row", "rank"])
    packed = packing.pack_documents(table)
    n = check_pieces(packed.collect(), docs, library)
    tokens = sum(len(expected(library, t)) for _, t in docs)
    assert n <= -(-tokens // 4096) + 2


def test_ids_of_sequences(spark, library, rows_of):
    docs = [(i, "word " * i) for i in range(1, 60)]
    packed = packing.pack_documents(rows_of(docs), capacity=50, end=7, with_ids=True)
    rows = packed.collect()
    tokens = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert sum(map(len, tokens.values())) == sum(len(expected(library, t)) for _, t in docs)
    for r in rows:
        assert tokens[r.sequence_id][r.offset : r.offset + r.length] == r.ids
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_nothing_to_pack(spark, rows_of):
    assert packing.pack_documents(rows_of([])).collect() == []


def test_hot_length_in_several_buckets(spark, library, rows_of, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET", 4)
    docs = [(i, "same text" if i % 3 else "another") for i in range(400)]
    check_pieces(packing.pack_documents(rows_of(docs)).collect(), docs, library)


def test_registered_query(spark, library):
    from clickstrata.llm.queries import queries

    sf_dir = "/root/testdata/sf0.01"
    rows = queries()["op12_best_fit_packing"](spark, sf_dir).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    n = check_pieces(rows, docs, library)
    assert n <= 1.01 * sum(r.length for r in rows) / 4096 + 1
