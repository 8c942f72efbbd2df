"""The lake built from the generic tables, frame by frame and only as far as a query needs it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engagement_lake.plans import gold, marts
from engagement_lake.plans.silver import dedup_events
from engagement_lake.sources.raw import land_raw_json, scan_raw_json, with_path_metadata
from engagement_lake.sources.schemas import GOLD_TABLES, MART_TABLES
from engagement_lake.sources.session import scratch_path
from engagement_lake.sources.tables import footers, read_latest_snapshot, read_table, write_table
from engagement_lake.suite import adapters

# Raw zones landed by this process, so that the queries over one share it.
_landed: dict[tuple[str, str, str], str] = {}


class Lake(Mapping):
    """Gold and mart tables by name, plus the inputs they are built from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._frames: dict[str, DataFrame] = {}
        self._bases: dict[tuple[str, bool], str] = {}

    @cached_property
    def events(self) -> DataFrame:
        return adapters.events(self.spark, self.folder)

    @cached_property
    def metadata(self) -> DataFrame:
        return adapters.metadata(self.spark, self.folder)

    @cached_property
    def stats(self) -> DataFrame:
        return adapters.stats(self.spark, self.folder)

    @cached_property
    def visitors(self) -> DataFrame:
        return adapters.visitors(self.spark, self.folder)

    @cached_property
    def config(self) -> DataFrame:
        return adapters.config(self.spark)

    @cached_property
    def unique_events(self) -> DataFrame:
        """Silver events as a written table: several aggregates read it, dedup runs once."""
        base = scratch_path(self.spark, "silver")
        write_table(dedup_events(self.events), base, "events")
        return read_table(self.spark, base, "events")

    def write(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Write tables that are read more than once; what is built on them reads them back."""
        base = scratch_path(self.spark, "tables")
        for name in names:
            write_table(self[name], base, name)
            self._frames[name] = read_table(self.spark, base, name)
        return {name: self._frames[name] for name in names}

    def _build(self) -> dict[str, Callable[[], DataFrame]]:
        mean = adapters.exact_mean
        return {
            "dim_media": lambda: gold.build_dim_media(self.metadata, self.config),
            "fact_media_daily_stats": lambda: gold.build_fact_media_daily_stats(
                self.stats, self.config
            ),
            "fact_media_engagement": lambda: gold.build_fact_media_engagement(
                self.events, self.config
            ),
            "dim_visitor": lambda: gold.build_dim_visitor(
                self.unique_events, self.visitors, mean
            ),
            "mart_channel_performance": lambda: marts.build_mart_channel_performance(
                self["fact_media_daily_stats"], self["fact_media_engagement"], self["dim_media"], mean
            ),
            "mart_geo_engagement": lambda: marts.build_mart_geo_engagement(
                self["fact_media_engagement"], mean
            ),
            "mart_device_browser": lambda: marts.build_mart_device_browser(
                self["fact_media_engagement"], mean
            ),
            "mart_visitor_engagement": lambda: marts.build_mart_visitor_engagement(
                self["dim_visitor"],
                gold.build_fact_media_engagement(self.unique_events, self.config, True),
            ),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._build()[name]()
        return self._frames[name]

    def __iter__(self):
        return iter((*GOLD_TABLES, *MART_TABLES))

    def __len__(self) -> int:
        return len(GOLD_TABLES) + len(MART_TABLES)

    def raw_base(self) -> str:
        """All four endpoints landed as JSON, once per session and folder; metadata and visitors are those
        of parts and customers."""
        return self._landed_once("all", adapters.raw_metadata, adapters.raw_visitors)

    def matching_raw_base(self) -> str:
        """Another raw zone, whose metadata and visitors belong to the events: the tables above silver that
        are built from it are those of this lake."""
        return self._landed_once("matching", adapters.raw_responses, adapters.raw_summaries)

    def _landed_once(self, name: str, metadata: Callable, visitors: Callable) -> str:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _landed:
            base = scratch_path(self.spark, "raw")
            self.land(base, "events", adapters.raw_events, "media_id", "page")
            self.land(base, "media_stats", adapters.raw_stats, "media")
            self.land(base, "media_metadata", metadata)
            self.land(base, "visitors", visitors)
            _landed[key] = base
        return _landed[key]

    def land(
        self, base: str, endpoint: str, records: Callable | DataFrame, media: str | None = None,
        page: str | None = None, batch: str = "first",
    ) -> None:
        """Land raw records; the media is part of an event's payload but not of statistics."""
        df = records if isinstance(records, DataFrame) else records(self.spark, self.folder)
        left_out = ("landed", page, *(() if endpoint == "events" else (media,)))
        land_raw_json(
            df, base, endpoint, F.col("landed"), F.col(media) if media else None,
            F.col(page) if page else None, [c for c in df.columns if c not in left_out], batch,
        )

    def footers(self, name: str) -> DataFrame:
        """The table, written once, as a source that is counted without being read."""
        return footers(self.spark, self._written_base(name), name)

    def latest(self, name: str) -> DataFrame:
        """The newest snapshot of the table, written with a folder per snapshot."""
        return read_latest_snapshot(self.spark, self._written_base(name, snapshots=True), name)

    def _written_base(self, name: str, snapshots: bool = False) -> str:
        if (name, snapshots) not in self._bases:
            base = scratch_path(self.spark, "tables")
            write_table(self[name], base, name, snapshots=snapshots)
            self._bases[name, snapshots] = base
        return self._bases[name, snapshots]

    def raw(self, endpoint: str) -> DataFrame:
        return with_path_metadata(scan_raw_json(self.spark, self.raw_base(), endpoint))
