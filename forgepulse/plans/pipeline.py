"""The whole run: load what has landed, then rebuild the models in order."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.clock import AsOf
from forgepulse import rules
from forgepulse.operators.activity import (
    daily_pairs, daily_signals, int_repo_daily_activity, pairs_since,
)
from forgepulse.operators.community import (
    mart_contributor_migration, mart_ecosystem_hourly, mart_fork_conversion, mart_org_scoreboard,
    mart_release_momentum, mart_viral_velocity,
)
from forgepulse.operators.enrichment import upsert_metadata
from forgepulse.operators.ingestion import Load, ingest_hours, pending_hours
from forgepulse.operators.profiles import int_contributor_profiles, int_org_activity
from forgepulse.operators.trending import (
    mart_ai_ecosystem, mart_new_repo_breakout, mart_trending_by_topic, mart_trending_repos,
)
from forgepulse.plans.layers import ACTIVITY, PAIRS, SIGNALS, Build, create_views, is_built
from forgepulse.sources.storage import Scratch
from forgepulse.sources.warehouse import Warehouse, hour_frame, landed_hours

# Fixed value: models built at the same time.
CONCURRENCY = 4


def load_pending(
    warehouse: Warehouse, folder: str, as_of: AsOf, only_report_nulls: bool = False
) -> Load:
    """Loads all landed hours that the ledger does not have whole."""
    landed = hour_frame(warehouse.spark, sorted(landed_hours(warehouse.spark, folder)))
    keys = [row.hour_key for row in pending_hours(landed, warehouse.ledger()).collect()]
    return ingest_hours(warehouse, folder, sorted(keys), as_of, only_report_nulls)


def refresh_daily_tables(build: Build, scratch: Scratch) -> None:
    """Rebuilds the daily tables: the dates of segments not taken in yet, whoever loaded
    them, or all when the tables are not there yet.

    With daily counts stored, reports over all history need not read all events again.
    """
    warehouse = build.warehouse
    touched = warehouse.touched()
    events, dates = warehouse.events(), None
    if all(is_built(warehouse, model) for model in (SIGNALS, ACTIVITY, PAIRS)):
        dates = sorted({day for days in touched.values() for day in days})
        if not dates:
            return
        events = warehouse.events_of(warehouse.version(), dates)
    signals = build.write(SIGNALS, daily_signals(events), dates)
    if dates is not None:
        signals = signals.where(F.col("activity_date").isin(dates))
    build.write(ACTIVITY, int_repo_daily_activity(signals, scratch), dates)
    build.write(PAIRS, daily_pairs(events), dates)
    build.taken_in = list(touched)


def run_pipeline(
    warehouse: Warehouse, as_of: AsOf, landing: str | None = None, records: DataFrame | None = None,
    only_report_nulls: bool = False,
) -> list[str]:
    """Loads pending hours and fetched metadata records, then rebuilds every model.

    All models are built from one version of the events and shown together once the last is
    written; a run that fails leaves the former ones as they are. Models that do not need
    each other are submitted together, and Spark shares the executors between them, so that
    one model's last tasks and commits overlap with the others' work.
    """
    if landing:
        load_pending(warehouse, landing, as_of, only_report_nulls)
    if records is not None:
        upsert_metadata(warehouse, records)
    run = Build(warehouse)
    scratch = Scratch(warehouse.spark, warehouse.path("_scratch"))
    try:
        events, metadata = run.warehouse.events(), run.warehouse.metadata()

        def stored(model: str) -> DataFrame:
            return run.read(model)

        def build(**models: Callable[[], DataFrame]) -> Callable[[], list[str]]:
            def write_each() -> list[str]:
                for model, frame in models.items():
                    run.write(model, frame())
                return list(models)
            return write_each

        def window(days: int) -> DataFrame:
            return pairs_since(stored(PAIRS), events, as_of, days)

        refresh_daily_tables(run, scratch)
        built = [*create_views(events), ACTIVITY]
        with ThreadPool(CONCURRENCY) as pool:
            for tasks in (
                [
                    build(int_contributor_profiles=lambda: int_contributor_profiles(
                        window(rules.CONTRIBUTOR_DAYS), as_of
                    )),
                    build(
                        int_org_activity=lambda: int_org_activity(window(rules.ORG_DAYS), as_of),
                        mart_org_scoreboard=lambda: mart_org_scoreboard(stored("int_org_activity")),
                    ),
                    build(mart_ecosystem_hourly=lambda: mart_ecosystem_hourly(events, as_of)),
                    build(
                        mart_trending_repos=lambda: mart_trending_repos(stored(ACTIVITY), as_of),
                        mart_trending_by_topic=lambda: mart_trending_by_topic(
                            stored("mart_trending_repos"), metadata
                        ),
                        mart_ai_ecosystem=lambda: mart_ai_ecosystem(
                            stored("mart_trending_by_topic"), as_of
                        ),
                    ),
                    build(mart_release_momentum=lambda: mart_release_momentum(
                        window(rules.COMMUNITY_DAYS), as_of
                    )),
                    build(mart_fork_conversion=lambda: mart_fork_conversion(
                        window(rules.COMMUNITY_DAYS), stored(SIGNALS), as_of, scratch
                    )),
                    build(mart_viral_velocity=lambda: mart_viral_velocity(stored(SIGNALS), as_of)),
                    build(mart_new_repo_breakout=lambda: mart_new_repo_breakout(
                        stored(SIGNALS), stored(ACTIVITY), as_of
                    )),
                ],
                [
                    build(mart_contributor_migration=lambda: mart_contributor_migration(
                        window(rules.CONTRIBUTOR_DAYS), stored("int_contributor_profiles"), as_of
                    )),
                ],
            ):
                # A chunk per task: a free thread takes the next one.
                for models in pool.map(lambda task: task(), tasks, chunksize=1):
                    built += models
        run.publish()
        return built
    except BaseException:
        run.drop()
        raise
    finally:
        scratch.drop()
