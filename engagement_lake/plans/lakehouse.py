"""One run over all layers: raw to silver, gold, marts, then the quality checks."""

from __future__ import annotations

from pyspark.sql import SparkSession

from engagement_lake.plans.gold import run_gold
from engagement_lake.plans.marts import run_marts
from engagement_lake.plans.quality import expected_row_counts, run_validation
from engagement_lake.plans.silver import run_silver
from engagement_lake.sources.config import load_media_config
from engagement_lake.sources.session import require_utc
from engagement_lake.sources.tables import read_table


class ValidationFailed(ValueError):
    """At least one quality check failed; ``failed`` names them."""

    def __init__(self, failed: list[str]):
        super().__init__(f"quality checks failed: {failed}")
        self.failed = failed


def run_lakehouse(
    spark: SparkSession,
    config_path: str,
    raw_base: str,
    silver_base: str,
    gold_base: str,
    mart_base: str,
    validate: bool = True,
    snapshots: bool = False,
) -> dict[str, int]:
    """Rebuild every table from raw and check the result; returns the rows written per table.

    The checks include that nothing raw had to be put aside as malformed.
    """
    require_utc(spark)
    config = load_media_config(spark, config_path)
    written = run_silver(spark, raw_base, silver_base)
    written |= run_gold(
        spark, silver_base, gold_base, config_path, events_unique="events" in written, snapshots=snapshots
    )
    written |= run_marts(spark, gold_base, mart_base, snapshots=snapshots)
    if validate:
        stats = read_table(spark, silver_base, "media_stats")
        channels = config.select("channel").where("channel IS NOT NULL")
        passed, results = run_validation(
            spark, gold_base, mart_base, channels, expected_row_counts(config, stats), silver_base
        )
        if not passed:
            raise ValidationFailed([r["check_name"] for r in results if not r["passed"]])
    return written
