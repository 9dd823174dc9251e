"""A stored table of agents: rules run once for each agent that was not seen before.

Agents repeat: a website sees some hundred thousand of them in billions of records. Rule sets of
agent libraries have hundreds of patterns, so an expression that tries them for each record costs
more than all the rest of ingest. Here the rules are rows. A batch's distinct agents that the
table lacks are classified and appended; records then look their agent up.

A rule with ``literals`` is tried only on agents that have one of these words, found by an
equi-join of the agents' words with the rules' literals: an agent meets the few rules that can
match it. Rules without literals are tried on every new agent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.functions.agents import DEFAULT_RULES, UNKNOWN_FAMILY, AgentRule

SCHEMA = "user_agent STRING, browser STRING, operating_system STRING, is_bot BOOLEAN"

_RULES = (
    "priority INT, kind STRING, pattern STRING, whole STRING, template STRING, family STRING, "
    "literal STRING"
)

#: Stands before and between the version groups in what a rule makes of an agent.
_MARK = "\u0001"

#: The literal of rules that are tried on every agent; no word is empty.
_ANY = ""


def rules_table(spark: SparkSession, rules: Sequence[AgentRule]) -> DataFrame:
    """One row per rule and literal. There are as many as in the configuration, so the table
    is small whatever the number of records."""
    rows = [
        (
            rule.priority,
            rule.kind,
            rule.pattern,
            rf"(?s)^.*?(?:{rule.pattern}).*$",
            "".join(f"{_MARK}${g}" for g in rule.version_groups),
            rule.family,
            literal,
        )
        for rule in rules
        for literal in rule.literals or (_ANY,)
    ]
    return spark.createDataFrame(rows, _RULES)


def _label() -> Column:
    """``family[ version]`` of a rule that matches."""
    groups = F.regexp_replace("user_agent", F.col("whole"), F.col("template"))
    version = F.translate(F.trim(F.translate(groups, _MARK, " ")), " _", "..")
    named = F.concat_ws(" ", "family", version)
    return F.when((F.col("template") != "") & (version != ""), named).otherwise(F.col("family"))


def classify_agents(agents: DataFrame, rules: Sequence[AgentRule] = DEFAULT_RULES) -> DataFrame:
    """Browser, operating system and bot mark of each distinct ``user_agent``.

    The result is that of ``enrich.with_agent``: of the rules of a kind that match, the one with
    the lowest priority counts; without any the family is ``Other``; an empty agent has neither
    and is no bot. Null agents are left out.
    """
    spark = agents.sparkSession
    distinct = agents.where(F.col("user_agent").isNotNull()).select("user_agent").distinct()
    words = F.array_distinct(F.regexp_extract_all(F.lower("user_agent"), F.lit("[a-z0-9]+"), 0))
    met = (
        distinct.where(F.length("user_agent") > 0)
        .select("user_agent", F.explode(F.concat(F.array(F.lit(_ANY)), words)).alias("literal"))
        .join(F.broadcast(rules_table(spark, rules)), "literal")
        .where(F.expr("user_agent RLIKE pattern"))
        .select("user_agent", "priority", "kind", _label().alias("label"))
    )

    def first(kind: str) -> Column:
        return F.expr(f"min_by(label, priority) FILTER (WHERE kind = '{kind}')")

    found = met.groupBy("user_agent").agg(
        first("browser").alias("browser"),
        first("os").alias("operating_system"),
        F.count_if(F.col("kind") == "bot").alias("bots"),
    )
    named = F.length("user_agent") > 0
    return distinct.join(found, "user_agent", "left").select(
        "user_agent",
        *[
            F.when(named, F.coalesce(c, F.lit(UNKNOWN_FAMILY))).alias(c)
            for c in ("browser", "operating_system")
        ],
        (F.coalesce("bots", F.lit(0)) > 0).alias("is_bot"),
    )


def read_agents(spark: SparkSession, root: str) -> DataFrame:
    """The stored table; empty if nothing was stored yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(root)


def extend_agents(
    records: DataFrame, root: str, rules: Sequence[AgentRule] = DEFAULT_RULES
) -> DataFrame:
    """Classify the agents of ``records`` that the table lacks, append them, and read it.

    Running it again on the same records adds nothing, so a batch may be repeated after a
    failure. One writer at a time; two would store an agent twice, which ``lookup`` bears.
    """
    spark = records.sparkSession
    seen = read_agents(spark, root).select("user_agent")
    agents = records.where(F.col("user_agent").isNotNull()).select("user_agent").distinct()
    new = agents.join(seen, "user_agent", "left_anti")
    classify_agents(new, rules).write.mode("append").parquet(root)
    return read_agents(spark, root)


def lookup(records: DataFrame, table: DataFrame) -> DataFrame:
    """Add ``browser``, ``operating_system`` and ``is_bot`` from the table.

    Records whose agent is null, or not in the table, have nulls and are no bots. Spark
    broadcasts the table or not by its size.
    """
    known = table.dropDuplicates(["user_agent"])
    joined = records.join(known, "user_agent", "left")
    return joined.select(
        *records.columns,
        "browser",
        "operating_system",
        F.coalesce("is_bot", F.lit(False)).alias("is_bot"),
    )
