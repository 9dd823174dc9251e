"""The audit of filters against a walk over every document in every order."""

import random
from itertools import permutations

import pytest

from clickstrata.llm import filter_audit

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    for space in SPACES:
        text = text.replace(space, " ")
    return [w for w in text.split(" ") if w]


def fails(text, others):
    """``others``: whether a smaller id has the same text."""
    words = words_of(text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": others,
    }


def walk(docs, labels):
    """Every order, filter by filter, document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for doc_id, text, source in docs:
        text = text or ""
        smaller = doc_id is not None and any(
            i is not None and i < doc_id and (t or "") == text for i, t, _ in docs
        )
        rows.append((source or "", doc_id, fails(text, smaller)))
    result, shapley = {}, {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = list(range(len(mine)))
            for step, letter in enumerate(order, 1):
                removed = [i for i in left if mine[i][2][letter]]
                gone = [i for i in range(len(mine)) if i not in left]
                left = [i for i in left if i not in removed]
                result[part, "".join(order), step] = [
                    len(left),
                    len(removed),
                    sum(mine[i][2][letter] for i in gone),
                    sum(r[2][letter] and sum(r[2].values()) == 1 for r in mine),
                    sum(mine[i][1] in good for i in removed),
                    sum(mine[i][1] in toxic for i in removed),
                ]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(removed)
    return {
        (part, order, step, *counts, shapley[part, order[step - 1]])
        for (part, order, step), counts in result.items()
    }


def frames(spark, docs, labels):
    # extra columns carry names of results and of working columns
    d = spark.createDataFrame(
        [(*r, 7, "x") for r in docs],
        "doc_id bigint, text string, source string, mask int, digest string",
    )
    names = "doc_id bigint, quality int, toxic int, part string"
    return d, spark.createDataFrame([(*r, "x") for r in labels], names)


def found(spark, docs, labels):
    return [tuple(r) for r in filter_audit.audit_documents(*frames(spark, docs, labels)).collect()]


def test_audit_matches_a_walk(spark):
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(220))
    texts = [None, "", "  ", long, long + " $", long.upper(), "a " * 300, "A " * 300, "a|b", long + "\x0b\x0c end"]
    texts.append(" ".join(["x"] * 400))  # not white space here: one word
    docs = [(i, rng.choice(texts), rng.choice([None, "", "s", "t"])) for i in range(60)]
    docs += [(None, long, "s"), (None, long, "s"), (5, docs[5][1], "s"), (5, long, "u")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 70, 2)]
    labels += [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    rows = found(spark, docs, labels)
    assert len(rows) == len(set(rows)) == 600 * 4
    assert set(rows) == walk(docs, labels)


def test_audit_of_nothing(spark):
    assert found(spark, [], [(1, 1, 1)]) == []
    assert len(found(spark, [(1, "a", None)], [])) == 600


def test_hot_text_and_source(spark):
    docs = [(i, "same", "s") for i in range(3000)]
    rows = {r[1:]: r for r in found(spark, docs, [])}
    first = next(r for r in rows.values() if r[1] == "EABCD" and r[2] == 1)
    assert first[3:5] == (1, 2999)


def test_very_long_text(spark):
    text = "word " * 400_000 + "#"
    row = next(r for r in found(spark, [(1, text, "s")], []) if r[1:3] == ("DBACE", 1))
    assert row[3:7] == (0, 1, 0, 0)


def test_other_filters(spark):
    failures = spark.createDataFrame(
        [("p", 0, True), ("p", 1, None), ("p", 3, True), (None, None, False)],
        "part string, mask int, flag boolean",
    )
    rows = {
        (r.part, r.filter_order, r.step): r
        for r in filter_audit.audit_filters(failures, "XY", {"flagged": "flag"}).collect()
    }
    assert len(rows) == 2 * 2 * 2
    r = rows["p", "XY", 1]
    assert (r.kept, r.removed, r.redundant, r.unique_fails, r.flagged, r.shapley) == (1, 2, 0, 1, 1, 3)
    r = rows["p", "XY", 2]
    assert (r.kept, r.removed, r.redundant, r.unique_fails, r.flagged, r.shapley) == (1, 0, 1, 0, 0, 1)
    assert rows["", "YX", 2].kept == 1
    with pytest.raises(ValueError):
        filter_audit.audit_filters(failures, "XX")
