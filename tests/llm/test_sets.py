"""Similarity join, repeats, decontamination and components against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from clickstrata.llm import decontamination, repeats, similarity
from clickstrata.llm.common import LOWER, Workspace, workspace
from clickstrata.llm.components import components


def find(above, x):
    while above[x] != x:
        x = above[x]
    return x


def test_components(spark):
    draw = random.Random(1)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(330)]
    edges += [(500 + i, 501 + i) for i in range(60)] + [(600, 600 + i) for i in range(50)]
    above = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = sorted((find(above, a), find(above, b)))
        above[b] = a
    table = spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint")
    with workspace(spark, "test") as work:
        found = dict(map(tuple, components(table, work).collect()))
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: find(above, x) for x in linked}


@pytest.mark.parametrize("edges, tables", [([], 1), ([(5, 1), (1, 7), (9, 9), (5, 1)], 1), ([(1, 2), (2, 3)], 2)])
def test_components_of_stars_take_no_round(spark, monkeypatch, edges, tables):
    made, written = [], Workspace.written
    monkeypatch.setattr(Workspace, "written", lambda self, df, name: made.append(name) or written(self, df, name))
    with workspace(spark, "test") as work:
        found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint"), work).collect()))
    assert found == {x: 1 for a, b in edges if a != b for x in (a, b)}
    assert len(made) == tables


def classes(rows, n, percent):
    sets = []
    for doc, text in rows:
        words = (text or "").encode().translate(LOWER).split()
        size = min(n, len(words))
        runs = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
        sets.append((doc, runs))
    above = {doc: doc for doc, _ in sets}
    postings = defaultdict(list)
    for i, (doc, tokens) in enumerate(sets):
        shared = Counter(j for t in tokens for j in postings[t])
        for j, both in shared.items():
            if 100 * both >= percent * (len(tokens) + len(sets[j][1]) - both):
                a, b = sorted((find(above, doc), find(above, sets[j][0])))
                above[b] = a
        for t in tokens:
            postings[t].append(i)
    return sorted((doc, len(tokens), find(above, doc)) for doc, tokens in sets)


@pytest.mark.parametrize(("shingle", "percent"), [(3, 90), (5, 80)])
def test_similarity_classes(rows_of, monkeypatch, shingle, percent):
    monkeypatch.setattr(similarity, "GROUP_ROWS", 16)  # families of several groups
    draw = random.Random(5)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]

    def near(edits):
        words = base[:]
        for _ in range(edits):
            words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
        return " ".join(words)

    passage = [f"p{i}" for i in range(50)]
    rows = [(i, near(draw.randint(0, 7))) for i in range(150)]
    rows += [
        (1000 + i, " ".join(f"W{draw.randrange(4)}" for _ in range(draw.randint(0, 16))))
        for i in range(250)
    ]
    rows += [
        (3000 + i, " ".join(passage + [f"x{draw.randrange(10**6)}" for _ in range(draw.randint(0, 40))]))
        for i in range(150)
    ]
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "w " * 50_000), (9004, "w " * 40_000)]
    rows += rows[:3]  # repeated rows
    found = similarity.similarity_classes(rows_of(rows, ["component_id"]), shingle, percent)
    assert sorted(map(tuple, found.collect())) == classes(rows, shingle, percent)


def test_sets_visit_only_groups_with_one_of_their_parts(spark, monkeypatch):
    monkeypatch.setattr(similarity, "VISITOR_ROWS", 3)
    members = [(i, 1, i % 5) for i in range(40)] + [(100, 2, 0), (101, 2, 1)]
    parts = [(i, 1000 + i // 2) for i in range(40)] + [(i, 5000) for i in range(0, 40, 5)]
    parts += [(i, 6000) for i in range(1, 40, 5)] + [(0, 6000), (100, 7000), (101, 7000)]
    lost = [(i, 1, i % 5) for i in range(0, 40, 3)] + [(100, 2, 0)]
    found = similarity.visits(
        spark.createDataFrame(lost, "node bigint, family bigint, own bigint"),
        spark.createDataFrame(members, "node bigint, family bigint, grp bigint"),
        spark.createDataFrame(parts, "node bigint, part bigint"),
        spark.range(200).selectExpr("id node", "explode(array(0, 1)) odd", "1 need"),
        Workspace(spark, "test"),
    )
    group = {node: (family, grp) for node, family, grp in members}
    expected = {
        (node, *group[other])
        for node, _, _ in lost
        for mine, part in parts
        if mine == node
        for other, also in parts
        if also == part and group[other] != group[node]
    }
    rows = list(map(tuple, found.collect()))
    assert len(rows) == len(expected) < len(lost) * 4 and set(rows) == expected
    many = spark.range(60).selectExpr("id node", "1L family", "0L grp")
    visiting, pieces = similarity.dealt(many)
    sizes = Counter(r.piece for r in visiting.collect())
    assert pieces.count() == 21 and max(sizes.values()) < 15 and sum(sizes.values()) == 60
    assert set(sizes) <= {r.piece for r in pieces.collect()}


def test_visitors_in_pieces_keep_the_classes(rows_of, monkeypatch):
    monkeypatch.setattr(similarity, "GROUP_ROWS", 8)
    monkeypatch.setattr(similarity, "VISITOR_ROWS", 4)
    draw = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    rows = [
        (i, " ".join(passage + [f"x{draw.randrange(30)}" for _ in range(draw.randint(0, 30))]))
        for i in range(200)
    ]
    found = similarity.similarity_classes(rows_of(rows), 5, 80)
    assert sorted(map(tuple, found.collect())) == classes(rows, 5, 80)


def test_sets_come_to_python_in_small_batches(spark, rows_of, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, classes = spark.conf.get(name), [], similarity._classes

    def watched(docs, *others):
        # the rows of each batch that a worker gets
        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["rows"])

        seen.extend(r["rows"] for r in docs.coalesce(1).mapInArrow(sizes, "rows bigint").collect())
        return classes(docs, *others)

    monkeypatch.setattr(similarity, "_classes", watched)
    docs = rows_of([(i, f"a b c w{i // 2}") for i in range(1200)])
    found = {r.doc_id: r.component_id for r in similarity.similarity_classes(docs).collect()}
    assert found == {i: i // 2 * 2 for i in range(1200)}
    assert sum(seen) == 1200 and max(seen) <= 500
    assert spark.conf.get(name) == before


def test_similarity_edges(rows_of):
    text = " ".join(f"a{i}" for i in range(30))
    other = " ".join(f"b{i}" for i in range(30))
    docs = rows_of([(5, text), (None, text), (7, other), (5, other), (8, None)])
    found = sorted(similarity.similarity_classes(docs).collect(), key=repr)
    # one document with two texts joins what links to either
    assert {(r.doc_id, r.component_id) for r in found} == {(5, 5), (None, 5), (7, 5), (8, 8)}
    assert similarity.similarity_classes(docs.limit(0)).count() == 0
    assert sorted(r.doc_id or 0 for r in similarity.keep_one(docs).collect()) == [0, 5, 5, 8]


@pytest.mark.parametrize(("size", "percent"), [(9, 90), (25, 90), (60, 80), (300, 80)])
def test_linked_sets_share_a_part(size, percent):
    import numpy as np

    rng = np.random.default_rng(size)
    for _ in range(60):
        tokens = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        drop = rng.integers(0, size * (100 - percent) // 100 + 1)
        fewer = tokens[np.sort(rng.permutation(len(tokens))[drop:])]
        add = (len(fewer) * 100 - percent * len(tokens)) // percent
        more = np.union1d(fewer, rng.integers(0, 1 << 63, max(0, add), dtype=np.uint64))
        for other in (fewer, more):
            both = len(np.intersect1d(tokens, other))
            assert 100 * both >= percent * (len(tokens) + len(other) - both)
            (mine, need), (theirs, others_need) = (similarity.part_keys(t, percent) for t in (tokens, other))
            shared = np.intersect1d(mine, theirs)
            assert len(shared)
            # enough of them in the band of the smaller set
            firsts = similarity._bands(percent, 1 << 20)
            odd = (int(np.searchsorted(firsts, min(len(tokens), len(other)), "right")) - 1) % 2
            assert np.count_nonzero(shared % np.uint64(2) == odd) >= max(need[odd], others_need[odd])


def test_groups_below_the_bound_are_not_visited(spark):
    members = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 1, 1), (4, 1, 2)], "node bigint, family bigint, grp bigint")
    # sets 2 and 3 hold three parts of set 1 together, set 4 two, and one of an odd band
    parts = [(1, p) for p in (10, 12, 14, 16, 21)] + [(2, 10), (2, 12), (3, 12), (3, 14), (4, 10), (4, 16), (4, 21)]
    shared = spark.createDataFrame(parts, "node bigint, part bigint")
    lost = spark.createDataFrame([(1, 1, 0)], "node bigint, family bigint, own bigint")

    def groups(even, odd):
        needs = spark.createDataFrame([(1, 0, even), (1, 1, odd)], "node bigint, odd int, need int")
        return sorted(r.grp for r in similarity.visits(lost, members, shared, needs, Workspace(spark, "test")).collect())

    assert groups(3, 2) == [1] and groups(2, 2) == [1, 2] and groups(4, 1) == [2] and groups(4, 2) == []


def test_parts_of_all_groups_count_for_each(spark):
    """Common parts are counted once for a set and not once per group; the bound is the same."""
    draw = random.Random(4)
    members = [(i, i % 3, (i // 3) % 4) for i in range(60)]
    common = {f: [1000 * f + p for p in range(0, 12)] for f in range(3)}
    parts = [(i, p) for i, f, _ in members for p in draw.sample(common[f], draw.randint(2, 9))]
    parts += [(i, 90_000 + draw.randrange(30) * 3 + f) for i, f, _ in members for _ in range(4)]
    parts = sorted(set(parts))
    lost = [(i, f, g) for i, f, g in members if i % 2]
    needs = {(i, odd): draw.randint(1, 6) for i, _, _ in members for odd in (0, 1)}
    found = similarity.visits(
        spark.createDataFrame(lost, "node bigint, family bigint, own bigint"),
        spark.createDataFrame(members, "node bigint, family bigint, grp bigint"),
        spark.createDataFrame(parts, "node bigint, part bigint"),
        spark.createDataFrame([(i, o, n) for (i, o), n in needs.items()], "node bigint, odd int, need int"),
        Workspace(spark, "test"),
    )
    mine = {i: {p for j, p in parts if j == i} for i, _, _ in members}
    expected = set()
    for i, f, own in lost:
        for g in range(4):
            union = set().union(*(mine[j] for j, of, h in members if (of, h) == (f, g)))
            for odd in (0, 1):
                n = sum(p % 2 == odd for p in mine[i] & union)
                if g != own and n >= needs[i, odd]:
                    expected.add((i, f, g))
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected
    assert 0 < len(expected) < 3 * len(lost)


def test_sets_with_too_few_common_parts_are_left_out(spark):
    # 1 and 2 are partners; 3 shares two parts with them, 4 two with 3 only
    parts = {1: [2, 4, 6, 8], 2: [2, 4, 6, 10], 3: [2, 4, 12, 14], 4: [12, 14, 16], 5: [18]}
    sets = spark.createDataFrame([(n, p, [3, 3]) for n, p in parts.items()], "node bigint, parts array<bigint>, needs array<int>")
    with workspace(spark, "test") as work:
        found = {(r.node, r.part) for r in similarity.shared_parts(sets, work).collect()}
    assert found == {(n, p) for n in (1, 2) for p in (2, 4, 6)}


def test_sets_without_a_partners_tokens_are_left_out(spark):
    # 1 and 2 link; 4 has too few tokens of others, and then 3 has, since those of 4 do not count
    tokens = {1: [*range(1, 11)], 2: [*range(1, 10), 20], 3: [*range(1, 8), 31, 32, 33], 4: [31, 32, 33, 41, 42]}
    sets = spark.createDataFrame(
        [(n, bytearray([n]), t) for n, t in tokens.items()], "node bigint, set_id binary, tokens array<bigint>"
    )
    with workspace(spark, "test") as work:
        found = sorted(tuple(r) for r in similarity.rarest_tokens(sets, 80, work).collect())
    # partners share eight of ten, so one of any three, and the one that no other holds is the first
    assert found == [(1, 8), (1, 9), (2, 8), (2, 9)]


def test_near_copies_that_do_not_link_visit_no_group(rows_of, monkeypatch):
    monkeypatch.setattr(similarity, "GROUP_ROWS", 8)
    visits, written = [], Workspace.written

    def counted(self, df, name):
        table = written(self, df, name)
        if name == "visits":
            visits.append(table.count())
        return table

    monkeypatch.setattr(Workspace, "written", counted)
    draw = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(80):
        words = base[:]
        for place in draw.sample(range(150), 9 if i % 4 else 1):
            words[place] = f"e{i}x{place}"
        rows.append((i, " ".join(words)))
    found = similarity.similarity_classes(rows_of(rows), 5, 80)
    expected = classes(rows, 5, 80)
    assert sorted(map(tuple, found.collect())) == expected
    assert len({component for _, _, component in expected}) > 50 and len(visits) == 1 and visits[0] <= len(rows) // 4


@pytest.mark.parametrize(("shingle", "percent"), [(5, 80), (3, 90), (1, 80), (2, 50)])
def test_no_link_is_lost_among_similar_sets(rows_of, monkeypatch, shingle, percent):
    """Texts around the threshold, in families of several small groups."""
    monkeypatch.setattr(similarity, "GROUP_ROWS", 6)
    draw = random.Random(percent + shingle)
    rows = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(draw.randint(12, 90))]
        for _ in range(30):
            words = base[:]
            for _ in range(draw.randint(0, max(1, len(base) // 12))):
                words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
            cut = draw.randint(0, len(words) // 8)
            rows.append((len(rows), " ".join(words[cut:] if draw.random() < 0.5 else words)))
    found = similarity.similarity_classes(rows_of(rows), shingle, percent)
    assert sorted(map(tuple, found.collect())) == classes(rows, shingle, percent)


def test_stages_keep_columns_of_any_name(spark, rows_of):
    from clickstrata.llm import decontamination, mixing, secrets

    names = ["_gone", "gone", "_hit", "hit", "Hit", "_clean", "clean", "n_chars", "_mix_key", "_mix_n", "source", "component_id"]
    names = [n for n in names if n != "Hit"]
    docs = rows_of([(1, "password=abcdef123 here"), (2, "other words"), (None, None)], names)
    items = spark.createDataFrame([(1, "no such words in any text at all you see now")], "item_id bigint, text string")
    for stage in (
        similarity.keep_one,
        lambda d: decontamination.drop_contaminated(d, items),
        secrets.redact_secrets,
        mixing.mix_sources,
    ):
        kept = stage(docs)
        assert kept.columns[: len(docs.columns)] == docs.columns
        rows = kept.collect()
        assert len(rows) == 3
        assert all(r[n] == n for r in rows for n in names if n != "n_chars")


def without_repeats(rows):
    first = {}
    for doc, text in rows:
        words = (text or "").encode().split()
        for s in range(len(words) - 19):
            key = tuple(words[s : s + 20])
            first[key] = min(first.get(key, (1 << 62, 0)), (doc, s))
    out = []
    for doc, text in rows:
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for s in range(len(words) - 19):
            if first[tuple(words[s : s + 20])] < (doc, s):
                keep[s : s + 20] = [False] * 20
        kept = [w for w, k in zip(words, keep, strict=True) if k]
        digest = hashlib.sha256(b" ".join(kept)).hexdigest()
        out.append((doc, len(words), len(words) - len(kept), digest))
    return sorted(out)


def test_repeats_go(rows_of, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE_ROWS", 20)
    monkeypatch.setattr(repeats, "SHARD_ROUTES", 60)
    draw = random.Random(6)
    passages = [[f"p{draw.randrange(30)}" for _ in range(draw.randint(15, 80))] for _ in range(12)]
    rows = []
    for _ in range(300):
        words = []
        for _ in range(draw.randint(0, 6)):
            kind = draw.random()
            if kind < 0.4:
                passage = draw.choice(passages)
                a = draw.randrange(len(passage))
                words += passage[a : draw.randint(a, len(passage))]
            elif kind < 0.6:
                words += ["same", "other"][: draw.randint(1, 2)] * draw.randint(1, 30)
            else:
                words += [f"x{draw.randrange(4)}" for _ in range(draw.randint(1, 40))]
        rows.append((draw.randrange(280), " ".join(words)))  # some ids come again
    rows += [(3, None), (4, ""), (5, "a b " * 20_000), rows[0]]
    found = repeats.remove_repeats(rows_of(rows, ["kept", "doc"])).drop("kept")
    assert sorted(map(tuple, found.collect())) == without_repeats(rows)


def test_repeats_edges(rows_of):
    text = " ".join(f"w{i}" for i in range(25))
    docs = rows_of([(None, text), (2, text), (2, text)])
    found = {r.doc_id: (r.n_removed, r.kept) for r in repeats.remove_repeats(docs).collect()}
    assert found == {None: (25, ""), 2: (0, text)}
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [16, 1 << 15])
def test_hashed_words_are_the_words(monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    monkeypatch.setattr(repeats, "LONG_WORD", 8)
    draw = random.Random(8)
    for size in [0, 1, 15, 16, 17, 400, 3000]:
        data = "".join(draw.choices("abc\0é\x85 \t\n\v\f\r", k=size)).encode()
        data += b"abcabcabcabcabc " * 3 + b"x" * draw.randrange(40)
        starts, ends, hashes = repeats.hashed_words(data)
        words = [data[a:b] for a, b in zip(starts, ends, strict=True)]
        assert words == repeats.words_of(data)
        by_word = dict(zip(words, hashes.tolist(), strict=True))
        assert [by_word[w] for w in words] == hashes.tolist()
        assert len(set(by_word.values())) == len(by_word)


def test_only_words_around_recurring_anchors_are_looked_up(monkeypatch):
    # a passage of 40 words within 20000 others of the owner's words
    passage = [f"p{i}" for i in range(40)]
    text = " ".join(["p1 p2"] * 5000 + passage + ["p3 p4"] * 5000).encode()
    owner = " ".join(passage).encode()
    passages = repeats.Passages(20, 8)
    passages.own(1, owner, repeats.Chunk([owner], 20, 8).named().tolist())
    passages.compile()
    looked_up = []
    numbers = passages._numbers

    def counted(words):
        looked_up.extend(words)
        return numbers(words)

    monkeypatch.setattr(passages, "_numbers", counted)
    stretches, opened = passages.scan(np.array([1, 5, 6]), [owner, b"", text])
    assert [part.tolist() for part in stretches] == [[2], [10000], [10040]]
    # windows that end or begin beside the passage may name an anchor of it
    assert all(9980 < start < 10040 for start in opened[2].tolist())
    assert len(looked_up) < 100


def contaminated(rows, items):
    def words(text):
        return decontamination.words_of((text or "").encode())

    phrases = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            phrases[tuple(w[i : i + n])].add(str(item))
    out = []
    for doc, text in rows:
        w, hit, ids = words(text), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                if own := phrases.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= own
        out.append((doc, len(w), len(hit), sorted(ids)))
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_contamination(spark, rows_of, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontamination, "SEGMENT_WORDS", 500)
    draw = random.Random(7)
    texts = [" ".join(f"w{draw.randrange(6)}" for _ in range(draw.choice([3, 9, 10, 14]))) for _ in range(12)]
    items = [*enumerate(texts), (90, None), (91, ""), (92, "Été-d'Été é"), (93, texts[0])]
    rows = [(i, " ".join(f"W{draw.randrange(6)}" for _ in range(draw.randint(0, 150)))) for i in range(60)]
    rows += [(100, "x,  " + texts[4].upper() + "!"), (101, None), (102, "ÉTÉ d Été ÉTÉ"), (103, "Été d Été é")]
    rows += rows[:2]
    table = spark.createDataFrame([*items, (None, "w1 w2 w3")], "item_id bigint, text string")
    found = decontamination.find_contamination(rows_of(rows, ["items"]), table)
    found = found.withColumn("n_hit", decontamination.covered(found["spans"]))
    got = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect())
    assert got == contaminated(rows, items)


def test_near_phrases_and_empty_tables(spark, rows_of):
    items = spark.createDataFrame([(1, "red green blue")], "item_id int, text string")
    docs = rows_of([(1, "blue and red, green"), (2, "red green blue"), (3, "red x x x x x x green blue")])
    found = decontamination.find_contamination(docs, items, slop=1)
    got = {r.doc_id: (list(r["items"]), list(r.near_items)) for r in found.collect()}
    assert got == {1: ([], ["1"]), 2: (["1"], ["1"]), 3: ([], [])}
    kept = decontamination.drop_contaminated(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert decontamination.find_contamination(docs.limit(0), items).count() == 0
    assert decontamination.drop_contaminated(docs, items.limit(0)).count() == 3
