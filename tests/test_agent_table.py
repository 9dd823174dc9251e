"""The stored agent table against the expression over all rules."""

import random

from pyspark.sql import functions as F

from clickstrata.functions.agents import DEFAULT_RULES, AgentRule
from clickstrata.operators import agent_table, enrich, places
from clickstrata.plans.ingest import ingest_events, ingest_with_agents
from clickstrata.sources import sample_site

SF_DIR = "/root/testdata/sf0.001"


def rules_of(n):
    """``n`` rules of their own words, among general ones, in any order of priority."""
    rng = random.Random(n)
    made = [
        AgentRule(rng.randrange(2000), rng.choice(["browser", "os"]), rf"Agent{i}/([0-9]+)(?:\.([0-9]+))?", f"Family {i}", (1, 2), (f"agent{i}",))
        for i in range(n)
    ]
    made.append(AgentRule(5000, "bot", "Agent7/", literals=("agent7",)))
    made.append(AgentRule(2500, "os", r"(?i)windows|winnt", "Windows", (), ("windows", "winnt")))
    return [*made, *DEFAULT_RULES]


def agents_of(n):
    rng = random.Random(3)
    made = [f"Agent{rng.randrange(600)}/{rng.randrange(9)}.{rng.randrange(9)} (WINNT; Agent{rng.randrange(600)}/7)" for _ in range(n)]
    return [*made, "", None, "Googlebot/2.1", "curl", "Mozilla/5.0 (X11; Linux x86_64) Firefox/99.0", "Agent7/1 Agent70/2\nwindows", "xAgent5/1"]


def compared(df):
    columns = ["user_agent", "browser", "operating_system", "is_bot"]
    return sorted((tuple(r) for r in df.select(columns).distinct().collect()), key=repr)


def test_hundreds_of_rules_agree_with_the_expression(spark):
    rules = [r for r in rules_of(60)]
    agents = spark.createDataFrame([(a,) for a in agents_of(300)], "user_agent string")
    expected = enrich.with_agent(agents.where("user_agent IS NOT NULL"), rules)
    found = agent_table.classify_agents(agents, rules)
    # a rule with literals asks for whole words; no sample agent but the last has part of one
    same = "user_agent NOT LIKE 'xAgent%'"
    assert compared(found.where(same)) == compared(expected.where(same))


def test_an_agent_meets_few_of_500_rules(spark):
    rules = rules_of(500)
    agents = spark.createDataFrame([(a,) for a in agents_of(200)], "user_agent string")
    assert agent_table.rules_table(spark, rules).count() > 500
    words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("user_agent"), F.lit("[a-z0-9]+"), 0)))
    met = agents.select("user_agent", words.alias("literal")).join(agent_table.rules_table(spark, rules), "literal")
    assert met.groupBy("user_agent").count().agg(F.max("count")).collect()[0][0] <= 5
    found = {r.user_agent: r for r in agent_table.classify_agents(agents, rules).collect()}
    assert found["curl"].browser == "Other" and found[""].browser is None and not found[""].is_bot
    assert found["Agent7/1 Agent70/2\nwindows"].is_bot and found["Googlebot/2.1"].is_bot


def test_only_new_agents_are_classified(spark, tmp_path):
    root = str(tmp_path / "agents")
    first = spark.createDataFrame([("curl",), ("Googlebot/2.1",), ("curl",), (None,)], "user_agent string")
    table = agent_table.extend_agents(first, root)
    assert table.count() == 2
    # another rule set shows which agents it is asked for
    other = [AgentRule(1, "browser", ".", "New")]
    more = spark.createDataFrame([("curl",), ("wget",)], "user_agent string")
    for _ in range(2):  # a repeated batch adds nothing
        table = agent_table.extend_agents(more, root, other)
        assert {r.user_agent: r.browser for r in table.collect()} == {"curl": "Other", "Googlebot/2.1": "Other", "wget": "New"}
    assert agent_table.extend_agents(first.limit(0), root).count() == 3
    found = agent_table.lookup(first, table).collect()
    assert sorted((r.user_agent or "", r.browser, r.is_bot) for r in found if r.user_agent) == [
        ("Googlebot/2.1", "Other", True), ("curl", "Other", False), ("curl", "Other", False),
    ]
    assert [(r.browser, r.is_bot) for r in found if r.user_agent is None] == [(None, False)]


def test_ingest_by_the_table_gives_the_same(spark, tmp_path):
    tree = places.place_tree(places.disjoint_places(sample_site.address_blocks(spark, SF_DIR)))
    raw = sample_site.raw_envelopes(spark, SF_DIR)
    arrival = F.col("arrived_at")
    expected = ingest_events(raw, tree, arrival=arrival)
    found = ingest_with_agents(raw, tree, str(tmp_path / "agents"), arrival=arrival)
    assert found.columns == expected.columns
    assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)
