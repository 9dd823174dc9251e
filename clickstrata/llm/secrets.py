"""Secret scan: all rules in one pass over the bytes, by one minimal automaton.

The regular expressions of all rules are turned into one nondeterministic automaton, that into
a deterministic one by subset construction, and that is minimised. Its transitions are arrays
of 256 entries, one array per state. A text is read once, byte by byte; the automaton reports
each place where a match of some rule ends. Only there two small automata of the one rule are
used: one runs backwards to the leftmost start, one forwards to the longest end.
"""

from __future__ import annotations

import pickle
import re
import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate
from operator import getitem
from re import _constants as K
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import fresh_name

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least`` is the shortest length that counts, of group ``group``.

    Matches are leftmost, longest and do not overlap within a kind; one that is too short is
    dropped after it has been found. ``fold`` ignores the case of letters outside ``group``.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    fold: bool = False


#: The three base rules and common published token formats.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        fold=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_.-]+", least=40),
    Rule("keyblock", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


class _Nfa:
    """States with byte edges and empty edges; ``accept`` maps a state to its rule."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []
        self.accept: dict[int, int] = {}
        self.starts: list[int] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def link(self, a: int, b: int, over: frozenset[int] | None = None) -> None:
        if over is None:
            self.empty[a].append(b)
        else:
            self.edges[a].append((over, b))

    def build(self, tree, a: int, fold: bool) -> int:
        """Add the parsed expression behind state ``a``; return where it ends."""
        for op, arg in tree:
            a = self._item(op, arg, a, fold)
        return a

    def _item(self, op, arg, a: int, fold: bool) -> int:
        if op is K.SUBPATTERN:
            return self.build(arg[3], a, fold)
        end = self.state()
        if op is K.BRANCH:
            for choice in arg[1]:
                self.link(self.build(choice, a, fold), end)
        elif op is K.MAX_REPEAT:
            least, most, item = arg
            for _ in range(least):
                a = self.build(item, a, fold)
            if most is K.MAXREPEAT:
                loop = self.state()
                self.link(a, loop)
                self.link(self.build(item, loop, fold), loop)
                self.link(loop, end)
            else:
                for _ in range(most - least):
                    self.link(a, end)
                    a = self.build(item, a, fold)
                self.link(a, end)
        else:
            self.link(a, end, _bytes_of(op, arg, fold))
        return end

    def closed(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for b in self.empty[todo.pop()]:
                if b not in found:
                    found.add(b)
                    todo.append(b)
        return frozenset(found)

    def reversed(self) -> _Nfa:
        other = _Nfa()
        for _ in self.edges:
            other.state()
        for a, edges in enumerate(self.edges):
            for over, b in edges:
                other.link(b, a, over)
            for b in self.empty[a]:
                other.link(b, a)
        other.starts = list(self.accept)
        other.accept = {a: 0 for a in self.starts}
        return other


def _bytes_of(op, arg, fold: bool) -> frozenset[int]:
    if op is K.LITERAL:
        found = {arg}
    elif op is K.IN:
        found, negated = set(), False
        for kind, value in arg:
            if kind is K.NEGATE:
                negated = True
            elif kind is K.RANGE:
                found.update(range(value[0], value[1] + 1))
            elif kind is K.LITERAL:
                found.add(value)
            else:
                raise ValueError(f"rules take no {kind} in a class")
        if negated:
            found = set(range(256)) - found
    else:
        raise ValueError(f"rules take no {op}")
    if fold:
        found |= {ord(chr(b).swapcase()) for b in found if chr(b).isascii() and chr(b).isalpha()}
    return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """``rows[s][b]`` is the state after byte ``b``; ``rules[s]`` are the rules that end in s."""

    rows: list[list[int]]
    rules: list[tuple[int, ...]]
    dead: int | None


def _determined(nfa: _Nfa, anywhere: bool) -> Automaton:
    """Subset construction. ``anywhere`` lets a match start at every byte."""
    sets = {over for edges in nfa.edges for over, _ in edges}
    kind_of = [tuple(b in over for over in sets) for b in range(256)]
    kinds = {k: i for i, k in enumerate(dict.fromkeys(kind_of))}
    class_of = [kinds[k] for k in kind_of]
    sample = [class_of.index(c) for c in range(len(kinds))]
    first = nfa.closed(nfa.starts)
    number, todo, steps = {first: 0}, [first], []
    while todo:
        here = todo.pop(0)
        row = []
        for byte in sample:
            after = {b for a in here for over, b in nfa.edges[a] if byte in over}
            after = nfa.closed(after | set(nfa.starts) if anywhere else after)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
        steps.append(row)
    rules = [tuple(sorted({nfa.accept[a] for a in s if a in nfa.accept})) for s in number]
    steps, rules = _minimal(steps, rules)
    rows = [[row[c] for c in class_of] for row in steps]
    dead = next(
        (s for s, row in enumerate(steps) if not rules[s] and all(x == s for x in row)), None
    )
    return Automaton(rows, rules, dead)


def _minimal(steps, rules):
    """Merge states that no input tells apart; state 0 stays the first."""
    names = {r: i for i, r in enumerate(dict.fromkeys(rules))}
    part = [names[r] for r in rules]
    while True:
        keys = [(part[s], *(part[t] for t in row)) for s, row in enumerate(steps)]
        names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        if len(names) == len(set(part)):
            break
        part = [names[k] for k in keys]
    members = {part[s]: s for s in reversed(range(len(steps)))}
    order = sorted(members, key=members.get)
    place = {p: i for i, p in enumerate(order)}
    return (
        [[place[part[t]] for t in steps[members[p]]] for p in order],
        [rules[members[p]] for p in order],
    )


def _check_nesting(forward: Automaton, anywhere: Automaton, kind: str) -> None:
    """Refuse a rule one of whose matches can end inside a longer one that has yet to end.

    For all others, the match that ends first is also the one that starts first.
    """
    pairs = {(forward.rows[0][b], 0) for b in range(256) if forward.rows[0][b] != forward.dead}
    todo = list(pairs)
    while todo:
        outer, inner = todo.pop()
        if forward.rules[outer]:
            continue
        for b in range(256):
            pair = forward.rows[outer][b], anywhere.rows[inner][b]
            if pair[0] == forward.dead or pair in pairs:
                continue
            if anywhere.rules[pair[1]] and not forward.rules[pair[0]]:
                raise ValueError(f"rule {kind!r} has matches inside unfinished matches")
            pairs.add(pair)
            todo.append(pair)


class Scanner:
    """The combined automaton of some rules, and the two small ones of each rule."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        whole = _Nfa()
        self.forward, self.backward = [], []
        for i, rule in enumerate(rules):
            tree = _parser.parse(rule.pattern)
            for nfa, mark in ((whole, i), (single := _Nfa(), 0)):
                start = nfa.state()
                nfa.starts.append(start)
                nfa.accept[nfa.build(tree, start, rule.fold)] = mark
            self.forward.append(_determined(single, anywhere=False))
            self.backward.append(_determined(single.reversed(), anywhere=False))
            _check_nesting(self.forward[-1], _determined(single, anywhere=True), rule.kind)
        self.combined = _determined(whole, anywhere=True)
        self._link()

    def _link(self) -> None:
        # states are the arrays themselves: an entry is the array of the next state, and entry
        # 256 names the rules that end here
        arrays: list[list] = [[] for _ in self.combined.rows]
        for array, row, ends in zip(
            arrays, self.combined.rows, self.combined.rules, strict=True
        ):
            array.extend(arrays[t] for t in row)
            array.append(ends)
        self.first = arrays[0]
        self.exact = [
            re.compile(r.pattern.encode(), re.IGNORECASE if r.fold else 0) for r in self.rules
        ]

    def __getstate__(self):
        table = np.array(self.combined.rows, np.uint16 if self.states < 65536 else np.uint32)
        return self.rules, self.forward, self.backward, table, self.combined.rules

    def __setstate__(self, state):
        self.rules, self.forward, self.backward, table, ends = state
        self.combined = Automaton(table.tolist(), ends, None)
        self._link()

    @property
    def states(self) -> int:
        return len(self.combined.rows)

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) of every secret, in bytes, by start and then rule."""
        ends = [
            (at, state[256])
            for at, state in enumerate(accumulate(data, getitem, initial=self.first))
            if state[256]
        ]
        found, last = [], [0] * len(self.rules)
        for at, matched in ends:
            for i in matched:
                if at <= last[i]:
                    continue
                start = self._run(self.backward[i], data, at - 1, last[i] - 1, -1)
                if start is None:
                    continue
                start += 1
                last[i] = end = self._run(self.forward[i], data, start, len(data), 1)
                if self._long_enough(i, data[start:end]):
                    found.append((start, i, end))
        return sorted(found)

    @staticmethod
    def _run(automaton: Automaton, data: bytes, at: int, stop: int, step: int) -> int | None:
        """Read from ``at`` on; the position behind the longest match, or None."""
        state, best = 0, None
        while at != stop:
            state = automaton.rows[state][data[at]]
            if state == automaton.dead:
                break
            at += step
            if automaton.rules[state]:
                best = at
        return best

    def _long_enough(self, i: int, match: bytes) -> bool:
        rule = self.rules[i]
        value = self.exact[i].fullmatch(match)[rule.group] if rule.group else match
        return len(value) >= rule.least


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """Compiled once, by the driver; some thousand states at any data size."""
    return Scanner(rules)


@lru_cache(maxsize=4)
def _packed(rules: tuple[Rule, ...]) -> bytes:
    return zlib.compress(pickle.dumps(scanner(rules)), 1)


@lru_cache(maxsize=4)
def _unpacked(packed: bytes) -> Scanner:
    """The scanner that came with a task, kept by the worker."""
    return pickle.loads(zlib.decompress(packed))


def find_secrets(text: str | None, scan: Scanner) -> list[dict]:
    """Spans of one text in code points, end exclusive, by start and then rule order."""
    if not text:
        return []
    data, rules = text.encode("utf-8", "surrogatepass"), scan.rules
    found = scan.spans(data)
    if found and len(data) != len(text):
        # positions in characters: count the bytes that begin one
        marks = sorted({p for start, _, end in found for p in (start, end)})
        place, chars, before = {}, 0, 0
        for mark in marks:
            chars += len(data[before:mark].decode("utf-8", "surrogatepass"))
            place[mark], before = chars, mark
        found = [(place[start], i, place[end]) for start, i, end in found]
    return [{"kind": rules[i].kind, "start": start, "end": end} for start, i, end in found]


def secret_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All secrets of a text: array of (kind, start, end). Null and empty texts have none."""

    packed = _packed(rules)

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def spans(texts: pa.Array) -> pa.Array:
        scan = _unpacked(packed)
        return pa.array((find_secrets(t.as_py(), scan) for t in texts), pa.list_(SPAN))

    return spans(text)


def redacted(text: str, spans: list[dict], mark: str) -> str:
    """The text with each stretch of overlapping spans replaced by one mark."""
    parts, at, until = [], 0, 0
    for span in spans:
        if span["start"] >= until:
            parts += [text[at : span["start"]], mark]
        at = until = max(until, span["end"])
    return "".join([*parts, text[at:]])


def redact_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]"
) -> DataFrame:
    """The documents, all of them and all columns, with the secrets in ``text`` replaced.

    Null and empty texts stay. ``n_chars``, where there is one, is the new length of changed
    texts.
    """

    packed = _packed(rules)

    @F.arrow_udf("string")
    def redact(texts: pa.Array) -> pa.Array:
        scan = _unpacked(packed)
        return pa.array(
            (
                text and redacted(text, find_secrets(text, scan), mark)
                for text in (t.as_py() for t in texts)
            ),
            pa.string(),
        )

    clean = redact("text")
    if "n_chars" not in docs.columns:
        return docs.withColumn("text", clean)
    kind = docs.schema["n_chars"].dataType
    fresh = fresh_name("clean", docs)
    changed = ~F.col(fresh).eqNullSafe(F.col("text"))
    return docs.withColumn(fresh, clean).select(
        *[
            F.col(fresh).alias("text")
            if c == "text"
            else F.when(changed, F.length(fresh).cast(kind)).otherwise(F.col(c)).alias(c)
            if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        ]
    )


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``secrets`` (array of kind, start, end).

    Rows are scanned each on its own: repeated rows give repeated results, an empty table
    gives an empty one, a null id stays null, other columns are ignored.
    """
    return docs.select("doc_id", secret_spans(F.col("text"), rules).alias("secrets"))
