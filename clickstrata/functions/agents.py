"""Name the browser and the operating system of an agent string by ordered rules.

The rules are configuration (a short Python sequence), so they compile into one
``coalesce(when ...)`` per kind with constant patterns: a narrow transformation that needs
no shuffle, no join and no state, and that works the same in a stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AgentRule:
    """``kind`` is ``browser``, ``os`` or ``bot``; the lowest ``priority`` wins.

    The version is the pattern's ``version_groups`` joined by points, without those that are
    missing at the end; ``_`` in them becomes a point. ``literals``: lower-case runs of letters and
    digits, one of which stands as a whole run in every agent that the pattern matches; they
    let a rule table leave the rule out for all other agents.
    """

    priority: int
    kind: str
    pattern: str
    family: str = ""
    version_groups: tuple[int, ...] = ()
    literals: tuple[str, ...] = ()


#: Value for an agent that no rule names.
UNKNOWN_FAMILY = "Other"

_DOTTED = r"([0-9]+(?:\.[0-9]+)*)"

# A small default rule set for common agents. Callers pass their own.
DEFAULT_RULES: tuple[AgentRule, ...] = (
    AgentRule(1, "bot", r"(?i)bot|crawler|spider|slurp|facebookexternalhit"),
    AgentRule(10, "browser", rf"Edg(?:e|A|iOS)?/{_DOTTED}", "Edge", (1,)),
    AgentRule(11, "browser", rf"(?:OPR|Opera)/{_DOTTED}", "Opera", (1,)),
    AgentRule(12, "browser", rf"SamsungBrowser/{_DOTTED}", "Samsung Internet", (1,)),
    AgentRule(13, "browser", rf"(?:Firefox|FxiOS)/{_DOTTED}", "Firefox", (1,)),
    AgentRule(14, "browser", rf"(?:Chrome|CriOS)/{_DOTTED}", "Chrome", (1,)),
    AgentRule(15, "browser", rf"Version/{_DOTTED}.*Safari", "Safari", (1,)),
    AgentRule(16, "browser", r"Safari/", "Safari"),
    AgentRule(20, "os", r"(?:iPhone|iPad|iPod).* OS ([0-9]+)(?:_([0-9]+))?(?:_([0-9]+))?", "iOS", (1, 2, 3)),
    AgentRule(21, "os", rf"Android {_DOTTED}", "Android", (1,)),
    AgentRule(22, "os", r"Windows NT 10\.0", "Windows 10"),
    AgentRule(23, "os", r"Windows NT 6\.3", "Windows 8.1"),
    AgentRule(24, "os", r"Windows NT 6\.2", "Windows 8"),
    AgentRule(25, "os", r"Windows NT 6\.1", "Windows 7"),
    AgentRule(26, "os", rf"Windows NT {_DOTTED}", "Windows NT", (1,)),
    AgentRule(27, "os", r"Mac OS X ([0-9]+(?:[._][0-9]+)*)", "Mac OS X", (1,)),
    AgentRule(28, "os", r"CrOS", "Chrome OS"),
    AgentRule(29, "os", r"Linux", "Linux"),
)

#: Stands before and between the version groups in what a rule makes of an agent.
_MARK = "\u0001"


def _label(agent: Column, rule: AgentRule) -> Column:
    """``family[ version]`` if the rule matches, else null; the pattern runs once."""
    if not rule.version_groups:
        return F.when(agent.rlike(rule.pattern), F.lit(rule.family))
    groups = "".join(f"{_MARK}${g}" for g in rule.version_groups)
    replaced = F.regexp_replace(
        agent, F.lit(rf"(?s)^.*?(?:{rule.pattern}).*$"), F.lit(groups)
    )

    def named(found: Column) -> Column:
        version = F.translate(F.trim(F.translate(found, _MARK, " ")), " _", "..")
        label = F.when(version != "", F.concat_ws(" ", F.lit(rule.family), version))
        return F.when(found.startswith(_MARK), F.coalesce(label, F.lit(rule.family)))

    return F.get(F.transform(F.array(replaced), named), 0)


def agent_family(agent: Column, rules: Sequence[AgentRule], kind: str) -> Column:
    """``family[ version]`` by the first matching rule; null for an empty agent."""
    chosen = sorted((r for r in rules if r.kind == kind), key=lambda r: r.priority)
    chain = [_label(agent, rule) for rule in chosen]
    named = F.coalesce(*chain, F.lit(UNKNOWN_FAMILY))
    return F.when(F.length(agent) > 0, named)


def is_bot(agent: Column, rules: Sequence[AgentRule]) -> Column:
    """True when any bot rule matches; an empty agent is never a bot."""
    hit = F.lit(False)
    for rule in rules:
        if rule.kind == "bot":
            hit = hit | agent.rlike(rule.pattern)
    return F.coalesce((F.length(agent) > 0) & hit, F.lit(False))
