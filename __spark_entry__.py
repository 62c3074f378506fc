"""Registered queries: every operator on the whole test tables, with its SQL counterpart.

``entry`` is the flagship query, ``queries`` maps names to ``(spark, sf_dir) -> DataFrame`` and
``oracle_sql`` gives the same results as DuckDB SQL. Money is summed as DECIMAL and shown as
DOUBLE, the type it has in the raw files.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable
from functools import cached_property

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracles  # noqa: E402
from stayrate.functions.transactions import round_up, signed_amount  # noqa: E402
from stayrate.operators import cancellations as cancel  # noqa: E402
from stayrate.operators import asof, band, cohorts, funnel, incremental, numbering  # noqa: E402
from stayrate.operators import paths, payload, quality, sessions  # noqa: E402
from stayrate.operators import retention as ret  # noqa: E402
from stayrate.operators import rollups, segments, staging, triggers  # noqa: E402
from stayrate.plans.marts import build_marts, lazy_marts, marts_only  # noqa: E402
from stayrate.session import run_folder  # noqa: E402
from stayrate.sources import digest, raw, sinks, star  # noqa: E402
from stayrate.streaming import dedup, feed, lapses  # noqa: E402

try:  # these files can be taken out; everything else works without them
    import corpus_pipeline
    from stayrate.llm import queries as corpus
except ImportError:
    corpus = corpus_pipeline = None

TX_AS_OF = oracles.TX_AS_OF
EV_AS_OF = oracles.EV_AS_OF
DAY = dt.timedelta(days=1)
STEPS = ("Login", "View_Portfolio", "Deposit")


class Tables:
    """Staging tables of one scale factor and the lazily defined marts on top of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def users(self) -> DataFrame:
        return staging.stg_users(star.raw_users(self.spark, self.sf_dir))

    @cached_property
    def tx(self) -> DataFrame:
        return staging.stg_transactions(star.raw_transactions(self.spark, self.sf_dir))

    @cached_property
    def events(self) -> DataFrame:
        return staging.stg_events(star.raw_events(self.spark, self.sf_dir))

    @property
    def summary(self) -> DataFrame:
        return rollups.user_summary(self.users, self.tx, self.events, TX_AS_OF)

    @property
    def cohort(self) -> DataFrame:
        return cohorts.churn_cohort(self.summary)

    @property
    def tx_summary(self) -> DataFrame:
        return cohorts.transaction_summary(self.tx)

    @property
    def starters(self) -> DataFrame:
        """Users whose signup date is their first event: orders end before the events begin."""
        return ret.first_activity(self.events)

    @property
    def recent_events(self) -> DataFrame:
        return staging.ingest_window(self.events, EV_AS_OF, 15)

    @property
    def chosen(self) -> DataFrame:
        candidates = cancel.churn_candidates(self.tx, TX_AS_OF)
        return numbering.sample_fraction(candidates, "user_id", 0.30, seed="cancel")

    def lazy(self) -> dict[str, DataFrame]:
        """Staging tables and marts by name, nothing written."""
        staged = {"users": self.users, "transactions": self.tx, "events": self.events}
        return lazy_marts(staged, TX_AS_OF)

    def built(self) -> dict[str, DataFrame]:
        """The marts written to a new folder of this run, as the full run does."""
        raw = star.raw_tables(self.spark, self.sf_dir)
        return build_marts(raw, run_folder(self.spark, "marts"), TX_AS_OF)


def _typed_amounts(t: Tables) -> DataFrame:
    """The sign and round-up rules on the unsigned order price, in the one scan of the orders."""
    kind, price = F.col("transaction_type"), F.abs("amount_usd")
    return t.tx.select(
        "transaction_id",
        "transaction_type",
        signed_amount(kind, price).alias("amount_usd"),
        round_up(kind, price).alias("round_up"),
    )


def _exported_marts(t: Tables) -> DataFrame:
    """Rows of each mart as read back from its CSV export."""
    exports = sinks.export_marts(marts_only(t.built()), run_folder(t.spark, "exports"))
    return sinks.exported_counts(t.spark, exports)


def _export_digest(t: Tables) -> DataFrame:
    """What the CSV exports of the marts hold, column by column, as read back from them."""
    marts = marts_only(t.built())
    exports = sinks.export_marts(marts, run_folder(t.spark, "exports"))
    return digest.digests(sinks.read_exports(t.spark, exports, marts))


def _from_csv(name: str) -> Callable[[Tables], DataFrame]:
    """The staged table as read from CSV files that are first written from the test tables."""

    def build(t: Tables) -> DataFrame:
        whole = star.raw_tables(t.spark, t.sf_dir)[name]
        fields = [F.col(f.name).cast(f.dataType) for f in raw.RAW_SCHEMAS[name]]
        path = f"{run_folder(t.spark, 'raw')}/{name}.csv"
        whole.select(*fields).write.option("header", True).csv(path)
        return staging.STAGING[name](raw.read_table(t.spark, name, path))

    return build


def _bucketed_summary(t: Tables) -> DataFrame:
    """The user summary from tables that were stored in buckets by user."""
    folder = run_folder(t.spark, "bucketed")
    unique = folder.rsplit("-", 1)[-1]
    tables = {"users": t.users, "transactions": t.tx, "events": t.events}
    stored = {
        name: sinks.materialise_bucketed(f"{name}_{unique}", df, folder, "user_id")
        for name, df in tables.items()
    }
    return rollups.user_summary(**stored, as_of=TX_AS_OF)


def _arrived(t: Tables) -> incremental.DailyStore:
    """All events in three arrivals: the early days, the later ones, then a third of the early ones
    that come late."""
    store = incremental.DailyStore(t.spark, run_folder(t.spark, "daily"))
    early = F.coalesce(F.col("event_date") < "2024-01-15", F.lit(False))
    late = early & F.coalesce(F.col("event_id") % 3 == 0, F.lit(False))
    for name, rows in (("a", early & ~late), ("b", ~early), ("c", late)):
        store.arrive(t.events.where(rows), name)
    return store


def _sketch_errors(t: Tables) -> DataFrame:
    """Whether the sketches of all days, merged, stay within their errors of the exact numbers."""
    found = _arrived(t).period("1970-01-01", "2100-01-01")
    session = F.col("session_duration_sec").cast("double")
    timed, ranks = F.count("session_duration_sec"), []
    for p in (50, 90, 99):
        at = F.col(f"session_p{p}")
        below, up_to = F.count_if(session < at) / timed, F.count_if(session <= at) / timed
        ranks.append(((below <= p / 100 + 0.01) & (up_to >= p / 100 - 0.01)).alias(f"p{p}_near"))
    known, about = F.count_distinct("user_id"), F.max("users")
    # One row per event type.
    return t.events.join(F.broadcast(found), "event_type").groupBy("event_type").agg(
        F.max("events").alias("events"),
        F.count(F.lit(1)).alias("n"),
        (F.abs(about - known) <= known * 0.06 + 1).alias("users_near"),
        *ranks,
    )


def _streamed(t: Tables, kind: str, rows_of, again: str = "false") -> DataFrame:
    """What a stream delivers in two runs, of the early events and of those that arrive afterwards:
    the later ones, and early ones that are sent ``again``."""
    folder = run_folder(t.spark, kind)
    events = star.raw_events(t.spark, t.sf_dir)
    first = F.coalesce(F.col("Event_Date") < "2024-01-15", F.lit(False))
    for i, rows in enumerate((events.where(first), events.where(~first | F.expr(again)))):
        rows.write.mode("append").parquet(f"{folder}/in/run={i}")
        stream = feed.read_event_stream(t.spark, f"{folder}/in/run=*", "parquet", events.schema)
        dedup.start_table(rows_of(stream), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{folder}/out")


def _flat_identify(t: Tables) -> DataFrame:
    rows = payload.identify_payload(t.summary)
    as_json = F.to_json(F.struct("*"), payload.JSON_OPTIONS).alias("body")
    return rows.select("user_id", "user_properties.$set.*", as_json)


def _flat_events(t: Tables) -> DataFrame:
    rows = payload.event_payload(t.events)
    as_json = F.to_json(F.struct("*"), payload.JSON_OPTIONS).alias("body")
    return rows.select(
        "user_id", "event_type", "time", "platform", "insert_id",
        "event_properties.session_duration_sec", as_json,
    )


def _batch_sizes(df: DataFrame, key: str, size: int) -> DataFrame:
    """Rows and distinct keys per batch; which rows share a batch depends on the hash."""
    batches = numbering.with_batches(df.select(key), key, size)
    counts = F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("keys")
    return batches.groupBy("batch_no").agg(*counts)


def _request_totals(t: Tables) -> DataFrame:
    rows = payload.event_payload(t.events)
    requests = payload.request_bodies(rows, "insert_id", payload.EVENTS_PER_REQUEST)
    return requests.agg(
        F.count(F.lit(1)).alias("requests"),
        F.max("n_rows").alias("largest"),
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.length("body")).alias("characters"),
    )


def _wrong_rates(t: Tables) -> DataFrame:
    """Cohorts with a deliberately wrong stored rate, so that the check has something to find."""
    wrong = t.cohort.withColumn("churn_rate_pct", F.col("explicit_churn_rate_pct"))
    return quality.check_churn_rate(wrong)


def _wrong_labels(t: Tables) -> DataFrame:
    """The summary with deliberately wrong stored labels, so that the checks have something to find."""
    label = F.col("churn_type")
    wrong = (
        F.when(F.col("user_id") % 7 == 0, "Explicit")
        .when(F.col("user_id") % 7 == 1, "Silent")
        .when(F.col("user_id") % 7 == 2, "Active")
        .otherwise(label)
    )
    return t.summary.withColumn("churn_type", wrong)


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # staging
    "staged_users": lambda t: t.users,
    "staged_transactions": lambda t: t.tx,
    "staged_events": lambda t: t.events,
    "row_counts": lambda t: sinks.row_counts(
        {"users": t.users, "transactions": t.tx, "events": t.events}
    ),
    "preview_transactions": lambda t: sinks.preview(t.tx, 3, "transaction_id"),
    "events_of_type": lambda t: staging.events_of_type(t.events, "Login", "Deposit").select(
        "event_id", "user_id", "event_type"
    ),
    "streamed_events_once": lambda t: _streamed(
        t, "once", lambda stream: dedup.once_each(stream, "60 days"), "Event_ID % 3 = 0"
    ).select("event_id", "user_id", "event_type", "event_ts"),
    "streamed_lapses": lambda t: _streamed(
        t, "lapses", lambda stream: lapses.lapses(stream, 3, "Login", "1 day")
    ),
    "ingest_window": lambda t: t.recent_events.select("event_id", "event_date"),
    # rollups and marts
    "tx_rollup": lambda t: rollups.tx_rollup(t.tx),
    "event_rollup": lambda t: rollups.event_rollup(t.events),
    "cancelled_users": lambda t: rollups.cancelled_users(t.events),
    "last_transaction": lambda t: rollups.last_transaction(t.tx),
    "user_summary": lambda t: t.summary,
    "bucketed_user_summary": _bucketed_summary,
    "incremental_rollup": lambda t: _arrived(t).rollup(),
    "sketch_errors": _sketch_errors,
    "user_profile": lambda t: rollups.user_profile(t.summary, 42),
    "churn_cohort": lambda t: t.cohort,
    "churn_cohort_stacked": lambda t: cohorts.churn_cohort_stacked(t.cohort),
    "cohort_at": lambda t: cohorts.cohort_at(t.cohort, "1995-01-01", "1995-03-01", "1996-02-01"),
    "transaction_summary": lambda t: t.tx_summary,
    "flow_by_product_type": lambda t: cohorts.flow_by_product_type(t.tx_summary),
    "exported_marts": _exported_marts,
    "export_digest": _export_digest,
    "csv_users": _from_csv("users"),
    "csv_transactions": _from_csv("transactions"),
    "csv_events": _from_csv("events"),
    # metrics
    "headline": lambda t: segments.headline(t.summary),
    "churn_by_age_group": lambda t: segments.churn_by(t.summary, "age_group"),
    "churn_by_channel": lambda t: segments.churn_by(t.summary, "acquisition_channel"),
    "churn_by_account_type": lambda t: segments.churn_by(t.summary, "account_type"),
    "churn_by_state_top10": lambda t: segments.churn_by(t.summary, "state", top=10),
    "churn_by_each_segment": lambda t: segments.churn_by_each(t.summary),
    "churn_type_counts": lambda t: segments.value_counts(t.summary, "churn_type"),
    "event_type_counts": lambda t: segments.value_counts(t.events, "event_type"),
    "step_reach": lambda t: segments.step_reach(
        t.events, t.users, "account_type", "Login", ("View_Portfolio", "Deposit", "Withdrawal")
    ),
    "events_with_account_type": lambda t: segments.facts_with(
        t.events, t.users, "account_type"
    ).select("event_id", "user_id", "event_type", "account_type"),
    "segment_counts": lambda t: segments.segment_counts(
        t.events, t.users, ("platform", "account_type", "acquisition_channel")
    ),
    "segment_combinations": lambda t: segments.segment_combinations(
        t.events, t.users, ("platform", "account_type", "acquisition_channel")
    ),
    "session_stats": lambda t: segments.session_stats(t.events, t.summary),
    # product analytics
    "funnel": lambda t: funnel.funnel(t.events, STEPS, DAY),
    "funnel_by_account_type": lambda t: funnel.funnel(
        t.events, STEPS, 7 * DAY, t.users, "account_type"
    ),
    "branch_funnel": lambda t: funnel.branch_funnel(
        t.events, "Login", ("Deposit", "Withdrawal"), DAY, t.users, "account_type"
    ),
    "retention": lambda t: ret.retention(t.events, t.starters, EV_AS_OF, "day"),
    "login_retention_by_churn_type": lambda t: ret.retention(
        t.events,
        t.starters.join(t.summary.select("user_id", "churn_type"), "user_id"),
        EV_AS_OF,
        "week",
        "Login",
        "churn_type",
    ),
    "logins_per_user": lambda t: ret.events_per_user(
        t.events, t.summary, "churned", "Login", "week"
    ),
    "events_per_user_by_churn_type": lambda t: ret.events_per_user(
        t.events, t.summary, "churn_type", None, "month"
    ),
    "crossover": lambda t: ret.crossover(
        ret.events_per_user(t.events, t.summary, "churned", "Login", "day"),
        "period_start", "churned", "events_per_user", 0, 1,
    ),
    "active_share": lambda t: ret.active_share(t.events, t.starters, "day"),
    "paths_to_withdrawal": lambda t: paths.paths_to(t.events, ["Withdrawal"], 3),
    "paths_to_cancel": lambda t: paths.paths_to(t.events, ["Cancel_Account"], 2),
    "sessions": lambda t: sessions.sessions(t.events, 12 * 60),
    "sessions_per_day": lambda t: sessions.sessions_per_day(t.events, 12 * 60),
    "events_with_last_transaction": lambda t: asof.as_of(
        t.events.select("event_id", "user_id", "event_ts"), t.tx, "user_id", "event_ts",
        "transaction_date", "transaction_id", ("transaction_id", "transaction_date", "amount_usd"),
    ),
    "deposits_with_last_view": lambda t: asof.as_of(
        staging.events_of_type(t.events, "Deposit").select("event_id", "user_id", "event_ts"),
        staging.events_of_type(t.events, "View_Portfolio").selectExpr(
            "event_id AS view_id", "user_id", "event_ts AS viewed_at", "platform"
        ),
        "user_id", "event_ts", "viewed_at", "view_id", ("view_id", "viewed_at", "platform"),
        within="3 days",
    ),
    "deposits_after_logins": lambda t: band.followed_within(t.events, "Login", "Deposit", 48 * 60),
    "inactive_users": lambda t: triggers.inactive_users(t.events, t.users, "2024-01-20", 3),
    "stalled_at": lambda t: triggers.stalled_at(
        t.events, "View_Portfolio", "Deposit", EV_AS_OF, 48
    ),
    "favourite_deposit": lambda t: triggers.favourite_deposit(t.tx),
    # quality
    "check_unique": lambda t: quality.check_unique(t.events, "user_id"),
    "null_counts": lambda t: quality.null_counts(
        t.summary, ("user_id", "signup_date", "last_transaction_date", "last_event_date")
    ),
    "check_not_null": lambda t: quality.check_not_null(t.summary, ("user_id", "last_event_date")),
    "explicit_without_cancel": lambda t: quality.explicit_without_cancel(
        _wrong_labels(t), t.events
    ).select("user_id", "churn_type"),
    "check_churn_type": lambda t: quality.check_churn_type(_wrong_labels(t), t.events),
    "check_churn_rate": _wrong_rates,
    "check_orphans": lambda t: quality.check_orphans(t.tx, t.starters),
    "check_domain": lambda t: quality.check_domain(
        t.users, "acquisition_channel", quality.DOMAINS["users"]["acquisition_channel"]
    ),
    "check_product_matches_account": lambda t: quality.check_product_matches_account(
        t.tx, t.users
    ),
    "check_activity_bounds": lambda t: quality.check_activity_bounds(
        t.events, t.starters, "event_id", "event_date", "2024-01-20"
    ),
    "check_amount_rules": lambda t: quality.check_amount_rules(
        t.tx, (0.01, 250_000.0), (50_000.0, 400_000.0)
    ),
    "quality_report": lambda t: quality.quality_report(t.lazy()),
    # rules and cancellations
    "typed_amounts": _typed_amounts,
    "churn_candidates": lambda t: cancel.churn_candidates(t.tx, TX_AS_OF),
    "sampled_candidates": lambda t: t.chosen,
    "append_events": lambda t: staging.append_events(
        t.events.where("NOT event_type <=> 'Login'"), staging.events_of_type(t.events, "Login")
    ).select("event_id", "user_id", "event_type", "event_date"),
    # payloads
    "identify_payload": _flat_identify,
    "event_payload": _flat_events,
    "user_batches": lambda t: _batch_sizes(t.users, "user_id", payload.USERS_PER_REQUEST),
    "event_batches": lambda t: _batch_sizes(t.events, "event_id", payload.EVENTS_PER_REQUEST),
    "event_requests": _request_totals,
    "event_request_bodies": lambda t: payload.event_requests(t.events, seed="send"),
    "identify_requests": lambda t: payload.identify_requests(t.summary, seed="send"),
}


def _shown(df: DataFrame) -> DataFrame:
    """Money as DOUBLE."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: churn per signup cohort."""
    return queries()["churn_cohort"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def registered(build):
        return lambda spark, sf_dir: _shown(build(Tables(spark, sf_dir)))

    found = {name: registered(build) for name, build in _QUERIES.items()}
    if corpus:
        found |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | (corpus.ORACLE_SQL if corpus else {})
