"""

Every query reads the whole sample tables of ``sf_dir``; ``clickstrata.sources.sample_site``
gives their rows the shape of website events.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickstrata.operators import (  # noqa: E402
    agent_table,
    devices,
    enrich,
    locations,
    motions,
    pages,
    places,
    prepare,
    sessions,
    shape,
    sketches,
    social,
    traffic,
)
from clickstrata.plans.ingest import DROPPED  # noqa: E402
from clickstrata.plans.report import (  # noqa: E402
    TOP_CITIES,
    TOP_COUNTRIES,
    SocialSeries,
    report_long,
    web_report,
)
from clickstrata.sources import sample_site  # noqa: E402
from clickstrata.sources.shared import fresh_path, scratch, written  # noqa: E402
from clickstrata.sources.tables import read_events, read_results, write_events  # noqa: E402
from clickstrata.streaming.ingest import OUTCOMES, start_ingest  # noqa: E402
from clickstrata.streaming.sessions import (  # noqa: E402
    number_session_events,
    number_sessions,
    start_session_events,
    start_sessions,
)
from oracle_queries import ORACLES  # noqa: E402

# The operators on training data are an optional part: without them all else works.
try:
    import corpus_pipeline  # noqa: E402
    from clickstrata.llm import queries as llm_queries  # noqa: E402
except ImportError as missing:
    # whatever of it is missing, a module or a library: the website's queries need none of it
    warnings.warn(f"without the operators on training data: {missing}", stacklevel=1)
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

#: Fewest sessions of a page in the page queries.
LIM = 10


# Inputs ------------------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample_site.web_events(spark, sf_dir)
    return sessions.complete_days(events, sample_site.START, sample_site.AS_OF)


def _prepared_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_events(sessions.session_details(_events(spark, sf_dir)))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared events of every day, whenever they arrived."""
    events = sample_site.web_events(spark, sf_dir)
    return prepare.prepare_events(sessions.session_details(events))


def _visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors with place and first day; none of these columns depends on sessions."""
    events = sessions.flat_events(_events(spark, sf_dir))
    return prepare.unique_visitors(events, ["city", "country", "date_day"])


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample_site.raw_envelopes(spark, sf_dir)
    return enrich.sound_records(enrich.decode_envelope(raw))


def _places(spark: SparkSession, sf_dir: str, folder: str) -> places.PlaceTree:
    # both are read several times
    blocks = written(sample_site.address_blocks(spark, sf_dir), "blocks", folder)
    intervals = written(places.disjoint_places(blocks), "intervals", folder)
    return places.place_tree(intervals, fresh_path(spark, "places", folder))


def _social(spark: SparkSession, sf_dir: str) -> SocialSeries:
    daily = sample_site.social_daily(spark, sf_dir)
    return SocialSeries(
        **{
            f"{network}_{value}": daily.select(
                "date_day", F.col(f"{network}_{value}").alias(value)
            )
            for network in social.NETWORKS
            for value in ("reach", "pageviews")
        }
    )


# Queries -----------------------------------------------------------------------------------


def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample_site.raw_envelopes(spark, sf_dir)
    return enrich.decode_envelope(raw).select(
        "error_type",
        "event_type",
        "from_url",
        "details",
        F.try_element_at("headers", F.lit("CloudFront-Is-Mobile-Viewer")).alias("mobile_header"),
        "source_ip",
        "user_agent",
        "request_id",
        "request_millis",
    )


def event_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.event_identity(_decoded(spark, sf_dir)).select("event_id", "request_time")


def classify_user_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.classify_user_agents(_decoded(spark, sf_dir))


def agents_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The agent table after two batches, of which the second adds what the first lacked."""
    with scratch(spark, "agents") as folder:
        decoded, root = _decoded(spark, sf_dir), f"{folder}/agents"
        agent_table.extend_agents(decoded.where("request_id < '5'"), root)
        return written(agent_table.extend_agents(decoded, root), "agents-result")


def drop_bots(spark: SparkSession, sf_dir: str) -> DataFrame:
    agents = enrich.with_agent(_decoded(spark, sf_dir))
    return enrich.drop_bots(agents).select("request_id", "browser", "operating_system")


def device_type_from_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_device_type(_decoded(spark, sf_dir)).select("request_id", "device_type")


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_fingerprint(_decoded(spark, sf_dir)).select("request_id", "fingerprint")


def geoip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "geoip") as folder:
        joined = places.geoip_join(_decoded(spark, sf_dir), _places(spark, sf_dir, folder))
        located = joined.select(
            "request_id",
            "source_ip",
            F.col("place.country_name").alias("country_name"),
            F.col("place.country_iso").alias("country_iso"),
            F.col("place.city").alias("city"),
        )
        return written(located, "geoip-result")


def _ingested(spark: SparkSession, sf_dir: str, folder: str) -> tuple[DataFrame, list[dict]]:
    """Run the stream over the sample records; what it stored, and the counts it observed."""
    sample_site.configure(spark)
    events = spark.readStream.schema(sample_site.SCHEMAS["events"]).parquet(f"{sf_dir}/events*.parquet")
    # a compact file is few tasks, and a record costs far more than reading its row
    tasks = 2 * spark.sparkContext.defaultParallelism
    events = events.repartition(tasks, F.xxhash64("event_id", "ts", "user_id"))
    root = f"{folder}/events"
    query = start_ingest(
        sample_site.raw_envelopes(spark, sf_dir, events),
        _places(spark, sf_dir, folder),
        root,
        f"{folder}/state",
        arrival=F.col("arrived_at"),
        available_now=True,
    )
    query.awaitTermination()
    counts = [p.observedMetrics[OUTCOMES].asDict() for p in query.recentProgress if p.observedMetrics]
    return read_results(spark, root), counts


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything the stream's sink stored, events and errors."""
    with scratch(spark, "ingest") as folder:
        stored, _ = _ingested(spark, sf_dir, folder)
        return written(stored, "ingest-result")


def ingest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by outcome: stored ones as read back, dropped ones as counted on the way."""
    with scratch(spark, "ingest-outcomes") as folder:
        stored, counts = _ingested(spark, sf_dir, folder)
        dropped = spark.createDataFrame(
            [(DROPPED, sum(c["dropped"] for c in counts))], "result string, records bigint"
        )
        by_result = stored.groupBy("result").agg(F.count(F.lit(1)).alias("records"))
        return written(by_result.unionByName(dropped), "ingest-outcomes-result")


def complete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days are folders of the stored table; those outside of the range are not read."""
    with scratch(spark, "complete-days") as folder:
        root = f"{folder}/events"
        write_events(sample_site.web_events(spark, sf_dir), root)
        return written(
            read_events(spark, root, sample_site.START, sample_site.AS_OF), "complete-days-result"
        )


def inactivity_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.inactivity_gaps(sample_site.web_events(spark, sf_dir)).select(
        "event_id", "fingerprint", "request_time", "inactivity_time"
    )


def session_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_starts(sample_site.web_events(spark, sf_dir))


def session_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.sessions(sample_site.web_events(spark, sf_dir))


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_events(_events(spark, sf_dir))


def _streamed(spark: SparkSession, sf_dir: str, folder: str, start) -> str:
    """Run a stream of events three times from its checkpoint; where it stored its rows.

    The first run has the events of the complete days. In the second a mark two days after the
    last event moves the watermark past every session. In the third, events of the days
    before come too late.
    """
    source, root = f"{folder}/in", f"{folder}/out"
    events = _events(spark, sf_dir)
    events.write.parquet(source)
    stored = spark.read.schema(events.schema).parquet(source)
    last = stored.agg((F.max("request_time") + F.expr("INTERVAL 2 DAYS")).alias("request_time"))
    mark = last.select(
        *[
            (F.col(c) if c == "request_time" else F.lit("mark").cast(stored.schema[c].dataType)).alias(c)
            for c in stored.columns
        ]
    )
    late = stored.where(F.col("event_id").cast("bigint") % 50 == 0).withColumns(
        {
            "event_id": F.concat(F.lit("late-"), "event_id"),
            "request_time": F.col("request_time") + F.expr("INTERVAL 1 SECOND"),
        }
    )
    written(late, "late", folder)  # before more rows come to the folder it is read from
    late = spark.read.schema(late.schema).parquet(f"{folder}/late-*")
    for more in (None, mark, late):
        if more is not None:
            more.write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        start(stream, root, f"{folder}/state", available_now=True).awaitTermination()
    return root


def sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "sessions-stream") as folder:
        closed = spark.read.parquet(_streamed(spark, sf_dir, folder, start_sessions))
        return written(number_sessions(closed), "sessions-stream-result")


def sessions_stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "session-events-stream") as folder:
        stored = spark.read.parquet(_streamed(spark, sf_dir, folder, start_session_events))
        return written(number_session_events(stored), "session-events-stream-result")


def prepare_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared_days(spark, sf_dir)


def unique_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.unique_visitors(_prepared_days(spark, sf_dir))


def traffic_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.traffic_daily(_prepared_days(spark, sf_dir))


def traffic_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.traffic_hourly(_prepared_days(spark, sf_dir))


def traffic_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.traffic_weekday(traffic_daily(spark, sf_dir))


def traffic_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.traffic_weekly(_prepared_days(spark, sf_dir))


def session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traffic.session_stats(_prepared_days(spark, sf_dir))


def page_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_stats(_prepared_days(spark, sf_dir), LIM)


def page_stats_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_stats_by_device(_prepared_days(spark, sf_dir), LIM)


def facebook_session_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.facebook_session_ratio(_prepared_days(spark, sf_dir))


def facebook_landing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.facebook_landing_pages(_prepared(spark, sf_dir))


def device_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.device_stats(_prepared_days(spark, sf_dir))


def city_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.location_top_n(_visitors(spark, sf_dir), "city", TOP_CITIES)


def country_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.location_top_n(_visitors(spark, sf_dir), "country", TOP_COUNTRIES)


def city_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.location_per_day(_visitors(spark, sf_dir), "city", TOP_CITIES)


def country_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.location_per_day(_visitors(spark, sf_dir), "country", TOP_COUNTRIES)


def motion_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motions.motion_events(_prepared(spark, sf_dir)).select(
        "event_id", "fingerprint", "session_id", "from_url", "motion"
    )


def motion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return motions.motion_stats(motions.motion_events(_prepared_days(spark, sf_dir)))


def motion_stats_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = motions.motion_events(_prepared(spark, sf_dir))
    return motions.motion_stats(selected, motions.REPORT_MOTIONS)


def _zscores(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    daily = traffic_daily(spark, sf_dir)
    series = _social(spark, sf_dir)
    return social.social_zscores(
        daily,
        series.facebook_reach,
        series.facebook_pageviews,
        series.instagram_reach,
        series.instagram_pageviews,
    )


def social_zscores_facebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_zscores(spark, sf_dir)["facebook"])


def social_zscores_instagram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_zscores(spark, sf_dir)["instagram"])


def _rounded(zscores: DataFrame) -> DataFrame:
    """Ten decimals: two engines may sum in another order."""
    return zscores.select(
        "date_day", *[F.round(c, 10).alias(c) for c in zscores.columns if c != "date_day"]
    )


def series_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = traffic_daily(spark, sf_dir)
    return shape.series_long(daily, ["date_day"], ["pageviews", "sessions", "visitors"])


def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_device = device_stats(spark, sf_dir).select("device_type", "pageviews")
    return shape.share_of_total(per_device, "pageviews")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every figure of every table of the report."""
    events = sessions.session_details(_events(spark, sf_dir))
    with scratch(spark, "web-report") as folder:
        tables = web_report(events, _social(spark, sf_dir), LIM, folder)
        return written(report_long(tables), "web-report-result")


# Stored sketches: each query merges those of days, and says whether the merge is as near to
# the exact figures, which it also gives, as the sketches promise.


def _stored_sketches(made: DataFrame, folder: str) -> DataFrame:
    """Sketches as a daily job stores them, read back."""
    root = fresh_path(made.sparkSession, "sketches", folder)
    sketches.write_sketches(made, root)
    return sketches.read_sketches(made.sparkSession, root, made.schema)


def _within(exact: DataFrame, merged: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    estimates = merged.select(*keys, *[F.col(c).alias(f"merged_{c}") for c in counts])
    near = [
        sketches.within_distinct_error(F.col(f"merged_{c}"), F.col(c)).alias(f"{c}_within")
        for c in counts
    ]
    return exact.join(estimates, keys, "left").select(*exact.columns, *near)


def traffic_weekly_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "weekly-sketches") as folder:
        prepared = written(_prepared_days(spark, sf_dir), "prepared", folder)
        daily = _stored_sketches(sketches.event_sketches(prepared), folder)
        checked = _within(
            traffic.traffic_weekly(prepared),
            sketches.traffic_weekly(daily),
            ["year", "week"],
            ["sessions", "visitors"],
        )
        return written(checked, "weekly-sketches-result")


def _with_medians(prepared: DataFrame, checked: DataFrame, merged: DataFrame, key: str) -> DataFrame:
    value = "seconds_to_next_event_in_session"
    estimates = merged.select(key, F.col("median_seconds").alias("estimate"))
    near = sketches.within_rank_error(
        prepared.select(key, value).join(F.broadcast(estimates), key), [key], value, "estimate"
    )
    return checked.drop("median_seconds").join(near, key, "left")


def page_stats_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "page-sketches") as folder:
        prepared = written(_prepared_days(spark, sf_dir), "prepared", folder)
        daily = _stored_sketches(sketches.event_sketches(prepared, ["clean_url"]), folder)
        merged = sketches.page_stats(daily, 0)
        checked = _within(
            pages.page_stats(prepared, LIM), merged, ["clean_url"], ["sessions", "visitors"]
        )
        return written(_with_medians(prepared, checked, merged, "clean_url"), "page-sketches-result")


def device_stats_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions and their ratios are exact here too: sessions add up over event days."""
    with scratch(spark, "device-sketches") as folder:
        prepared = written(_prepared_days(spark, sf_dir), "prepared", folder)
        keys = ["device_type"]
        events = _stored_sketches(sketches.event_sketches(prepared, keys), folder)
        per_session = _stored_sketches(sketches.session_sketches(prepared, keys), folder)
        merged = sketches.device_stats(events, per_session)
        exact = devices.device_stats(prepared).select("device_type", "visitors")
        medians = ["median_time_per_page", "median_session_time"]
        checked = _within(exact, merged, keys, ["visitors"]).join(
            merged.drop("visitors", *medians), keys
        )
        estimates = sketches.merge_events(events, keys)
        return written(
            _with_medians(prepared, checked, estimates, "device_type"), "device-sketches-result"
        )


# Contract ----------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return traffic_daily(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_site_queries(), **_llm_queries()}


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return {}
    return {**llm_queries.queries(), "pipeline": corpus_pipeline.run}


def _site_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "decode_envelope": decode_envelope,
        "event_identity": event_identity,
        "classify_user_agents": classify_user_agents,
        "agents_stored": agents_stored,
        "drop_bots": drop_bots,
        "device_type_from_headers": device_type_from_headers,
        "fingerprint": fingerprint,
        "geoip_join": geoip_join,
        "ingest_events": ingest,
        "ingest_outcomes": ingest_outcomes,
        "complete_days": complete_days,
        "inactivity_gaps": inactivity_gaps,
        "session_starts": session_starts,
        "sessions": session_table,
        "session_events": session_events,
        "sessions_stream": sessions_stream,
        "sessions_stream_events": sessions_stream_events,
        "prepare_events": prepare_events,
        "unique_visitors": unique_visitors,
        "traffic_daily": traffic_daily,
        "traffic_hourly": traffic_hourly,
        "traffic_weekday": traffic_weekday,
        "traffic_weekly": traffic_weekly,
        "session_stats": session_stats,
        "page_stats": page_stats,
        "page_stats_by_device": page_stats_by_device,
        "facebook_session_ratio": facebook_session_ratio,
        "facebook_landing_pages": facebook_landing_pages,
        "device_stats": device_stats,
        "location_top_n": city_top,
        "location_top_n_country": country_top,
        "location_per_day": city_per_day,
        "location_per_day_country": country_per_day,
        "motion_events": motion_events,
        "motion_stats": motion_stats,
        "motion_stats_top": motion_stats_top,
        "social_zscores": social_zscores_facebook,
        "social_zscores_instagram": social_zscores_instagram,
        "series_long": series_long,
        "share_of_total": share_of_total,
        "web_report": report,
        "traffic_weekly_sketches": traffic_weekly_sketches,
        "page_stats_sketches": page_stats_sketches,
        "device_stats_sketches": device_stats_sketches,
    }


def oracle_sql() -> dict[str, str]:
    oracles = dict(ORACLES)
    if llm_queries is not None:
        oracles.update(llm_queries.oracle_sql())
        if corpus_pipeline.ORACLE_SQL is not None:
            oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return oracles
