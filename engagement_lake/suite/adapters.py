"""Views of generic event and customer tables in the shape of raw records and silver tables.

The tables have an event stream, customers and a nation/region geography but no media. An event
type plays the media ("error" stays unconfigured), and every tenth event is landed a second time
a month later, so that dedup, latest-row and unmapped-channel rules all have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engagement_lake.functions import play_rate
from engagement_lake.sources.config import media_config
from engagement_lake.sources.schemas import complete

CONFIG_ITEMS = (
    {"media_id": "view", "channel": "YouTube", "name": "View reel"},
    {"media_id": "click", "channel": "YouTube", "name": "Click reel"},
    {"media_id": "purchase", "channel": "Facebook", "name": "Purchase reel"},
    {"media_id": "signup", "channel": "Facebook", "name": "Signup reel"},
)
UNCONFIGURED = {"media_id": "error", "channel": "YouTube", "name": "Error reel"}
CHANNELS = ("Facebook", "YouTube")

FIRST_BATCH, SECOND_BATCH = "2024-01-31", "2024-02-29"
SNAPSHOTS = ("2024-01-10", "2024-01-20", "2024-01-31")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def config(spark: SparkSession, every_media: bool = False) -> DataFrame:
    """The configuration, without or with the media that is left unconfigured on purpose."""
    return media_config(spark, (*CONFIG_ITEMS, UNCONFIGURED) if every_media else CONFIG_ITEMS)


def _landings(key: str, every: int = 10) -> Column:
    """The batches a record is landed in: the first, and every tenth the second, too."""
    first = F.struct(F.lit(FIRST_BATCH).alias("ingest_date"), F.lit(1).alias("source_page"))
    second = F.struct(F.lit(SECOND_BATCH).alias("ingest_date"), F.lit(2).alias("source_page"))
    return F.inline(
        F.when(F.col(key) % every == 0, F.array(first, second)).otherwise(F.array(first))
    )


EVENT_COLUMNS = {
    "event_key": "concat('e', event_id)",
    "received_at": "ts",
    "visitor_key": "concat('v', user_id)",
    "media_hashed_id": "event_type",
    "media_name": "concat(event_type, ' reel')",
    "media_url": "concat('https://media.example/', event_type)",
    "percent_viewed": "least(value / 100D, 1D)",
    "ip_address": "if(located, concat('10.', user_id % 200, '.0.', event_id % 200), NULL)",
    "country": "n_name",
    "region": "r_name",
    "city": "concat('city', user_id % 7)",
    "latitude": "if(located, CAST(user_id % 170 - 85 AS DOUBLE), NULL)",
    "longitude": "if(k % 11 <> 0, CAST(event_id % 350 - 175 AS DOUBLE), NULL)",
    "organization": "if(user_id % 4 = 0, concat('org', user_id % 3), NULL)",
    "email": "if(event_id % 50 = 0, concat('u', user_id, '@example.org'), NULL)",
    "embed_url": "concat('https://site', user_id % 5, '.example')",
    "conversion_type": "if(converts, event_type, NULL)",
    "conversion_data_json": "if(converts, props, NULL)",
    "iframe_heatmap_url": "concat('https://heat.example/', event_id)",
    "browser": "if(known, element_at(array('Chrome', 'Safari', 'Firefox'), k % 3 + 1), NULL)",
    "browser_version": "if(known, CAST(k % 5 AS STRING), NULL)",
    "platform": "if(known, if(k % 2 = 0, 'Android', 'Mac'), NULL)",
    "is_mobile": "if(known, k % 2 = 0, NULL)",
    "thumbnail_url": "concat('https://cdn.example/', event_type)",
    "thumbnail_width": "k + 200",
    "thumbnail_height": "k + 100",
    "ingest_date": "ingest_date",
    "source_page": "source_page",
}


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Silver-shaped events before dedup."""
    geography = read(spark, folder, "nation").join(
        read(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    )
    landed = (
        read(spark, folder, "events")
        .join(geography, F.expr("n_nationkey = user_id % 25"))
        .selectExpr("*", "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k")
        .selectExpr(
            "*",
            "k % 10 <> 9 AS known",
            "k % 7 <> 0 AS located",
            "event_type IN ('purchase', 'signup') AS converts",
        )
        .select("*", _landings("event_id"))
    )
    shaped = landed.selectExpr(*[f"{sql} AS {name}" for name, sql in EVENT_COLUMNS.items()])
    return complete(shaped, "events")


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Silver-shaped media metadata: per media one response in each batch."""
    media = F.col("event_type")
    second = F.col("ingest_date") == SECOND_BATCH
    named = media != "purchase"
    responses = (
        read(spark, folder, "events")
        .select("*", _landings("event_id"))
        .groupBy("event_type", "ingest_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("value").alias("duration_seconds"),
            F.min("ts").alias("created_at"),
            F.max("ts").alias("last_ts"),
        )
    )
    shaped = responses.select(
        F.col("n").alias("media_numeric_id"),
        media.alias("media_hashed_id"),
        F.lit("Video").alias("media_type"),
        F.when(named, F.concat(media, F.lit(" cut "), F.col("ingest_date"))).alias("media_name"),
        "duration_seconds",
        "created_at",
        F.when(~((media == "click") & second), F.col("last_ts")).alias("updated_at"),
        F.lit("ready").alias("status"),
        (media == "error").alias("archived"),
        F.concat(F.lit("about "), media).alias("description"),
        (F.col("n") % 7).alias("project_id"),
        F.concat(F.lit("p"), F.col("n") % 7).alias("project_hashed_id"),
        F.concat(F.lit("project "), media).alias("project_name"),
        (F.col("n") % 5).alias("section_id"),
        F.concat(F.lit("section "), media).alias("section_name"),
        F.concat(F.lit("https://share.example/"), media).alias("share_url"),
        F.concat(F.lit("https://cdn.example/"), media).alias("thumbnail_url"),
        F.lit(640).alias("thumbnail_width"),
        F.lit(360).alias("thumbnail_height"),
        F.concat(F.lit("f"), F.col("ingest_date")).alias("source_file"),
        "ingest_date",
    )
    return complete(shaped, "media_metadata")


def stats(spark: SparkSession, folder: str) -> DataFrame:
    """Silver-shaped daily statistics, cumulative up to each snapshot, each landed twice."""
    taken = F.filter(
        F.array(*map(F.lit, SNAPSHOTS)),
        lambda day: F.to_date("ts") <= day.cast("date"),
    )
    totals = (
        read(spark, folder, "events")
        .select("event_type", "user_id", "value", F.explode(taken).alias("ingest_date"))
        .groupBy("event_type", "ingest_date")
        .agg(
            F.count(F.lit(1)).alias("load_count"),
            F.count_if(F.col("value") >= 20).alias("play_count"),
            (F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.lit(60.0)).alias(
                "hours_watched"
            ),
            F.count_distinct("user_id").alias("visitor_count"),
        )
    )
    shaped = totals.select(
        F.col("event_type").alias("media_hashed_id"),
        "load_count",
        "play_count",
        (F.col("play_count") / (F.col("load_count") + 1)).alias("api_play_rate"),
        play_rate(F.col("play_count"), F.col("load_count")).alias("calculated_play_rate"),
        (F.col("visitor_count") / F.col("load_count")).alias("engagement"),
        "hours_watched",
        "visitor_count",
        "ingest_date",
        F.explode(F.array(F.lit("f1"), F.lit("f2"))).alias("source_file"),
    )
    return complete(shaped, "media_stats")


def visitors(spark: SparkSession, folder: str) -> DataFrame:
    """Silver-shaped visitor summaries: one per customer, for every fourth a newer one, too."""
    key = F.col("c_custkey")
    newer = F.col("ingest_date") == SECOND_BATCH
    landed = read(spark, folder, "customer").select("*", _landings("c_custkey", every=4))
    shaped = landed.select(
        F.concat(F.lit("v"), key).alias("visitor_key"),
        F.lit("2024-03-01").cast("timestamp_ntz").alias("created_at"),
        F.lit("2023-12-01").cast("timestamp_ntz").alias("last_active_at"),
        F.when(key % 3 == 0, F.concat(F.col("c_name"), F.lit("@example.com"))).alias(
            "visitor_email"
        ),
        F.when(newer, F.concat(F.lit("NEW "), F.col("c_mktsegment")))
        .otherwise(F.col("c_mktsegment"))
        .alias("visitor_org_name"),
        F.lit("Edge").alias("browser"),
        F.lit("1").alias("browser_version"),
        F.lit("Windows").alias("platform"),
        F.lit(False).alias("is_mobile"),
        "ingest_date",
    )
    return complete(shaped, "visitors")


def exact_mean(c: Column) -> Column:
    """Mean of values with up to four decimals that does not depend on the order of addition."""
    return F.sum(c.cast("decimal(18,4)")).cast("double") / F.count(c)


def fixed_point_mean(c: Column) -> Column:
    """Mean in steps of 1e-9, so that any engine and any order of addition give the same."""
    return F.sum(F.floor(c * F.lit(1e9))).cast("double") / F.lit(1e9) / F.count(c)


# Raw records as the API would return them. "landed" and "page" say where they are landed.


def _thumbnail() -> Column:
    fields = {"url": "thumbnail_url", "width": "thumbnail_width", "height": "thumbnail_height"}
    return F.struct(*[F.col(c).alias(f) for f, c in fields.items()]).alias("thumbnail")


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event records of all batches, repeats included, with every field."""
    return events(spark, folder).select(
        "event_key",
        F.col("received_at").cast("string").alias("received_at"),
        "visitor_key",
        F.col("media_hashed_id").alias("media_id"),
        "media_name",
        "media_url",
        "percent_viewed",
        F.col("ip_address").alias("ip"),
        "country",
        "region",
        "city",
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        F.col("organization").alias("org"),
        "email",
        "embed_url",
        "conversion_type",
        F.struct(F.col("region").alias("to"), F.col("country").alias("from")).alias(
            "conversion_data"
        ),
        "iframe_heatmap_url",
        F.struct(
            "browser", "browser_version", "platform", F.col("is_mobile").alias("mobile")
        ).alias("user_agent_details"),
        _thumbnail(),
        F.col("ingest_date").alias("landed"),
        F.col("source_page").alias("page"),
    )


def raw_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics records; the media is known from the folder only."""
    return (
        stats(spark, folder)
        .where("source_file = 'f1'")
        .select(
            F.col("media_hashed_id").alias("media"),
            F.col("ingest_date").alias("landed"),
            "load_count",
            "play_count",
            F.col("api_play_rate").alias("play_rate"),
            "hours_watched",
            "engagement",
            F.col("visitor_count").alias("visitors"),
        )
    )


def raw_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata records, one per part; the section is text for even parts, an object for odd."""
    key = F.col("p_partkey")
    as_object = F.to_json(F.struct(key.alias("id"), F.col("p_type").alias("name")))
    url = F.concat(F.lit("https://cdn.example/"), key).alias("url")
    return read(spark, folder, "part").select(
        key.alias("id"),
        F.concat(F.lit("m"), key).alias("hashed_id"),
        F.lit("Video").alias("type"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("duration"),
        F.lit("2024-01-05T10:00:00+02:00").alias("created"),
        F.when(key % 5 != 0, "2024-01-06T10:00:00Z").otherwise("never").alias("updated"),
        F.when(key % 4 == 0, "ready").otherwise("queued").alias("status"),
        (key % 3 == 0).alias("archived"),
        F.concat(F.lit("about "), "p_name").alias("description"),
        F.struct(
            key.alias("id"), F.concat(F.lit("p"), key).alias("hashed_id"), F.col("p_brand").alias("name")
        ).alias("project"),
        F.when(key % 2 == 0, F.col("p_type")).otherwise(as_object).alias("section"),
        F.struct(F.concat(F.lit("https://share.example/"), key).alias("url")).alias("share_link"),
        F.struct(url, F.col("p_size").alias("width"), (F.col("p_size") + 1).alias("height")).alias("thumbnail"),
        F.lit(FIRST_BATCH).alias("landed"),
    )


def raw_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata records of the media that have events, one in each batch."""
    section = F.struct(F.col("section_id").alias("id"), F.col("section_name").alias("name"))
    return metadata(spark, folder).select(
        F.col("media_numeric_id").alias("id"),
        F.col("media_hashed_id").alias("hashed_id"),
        F.col("media_type").alias("type"),
        F.col("media_name").alias("name"),
        F.col("duration_seconds").alias("duration"),
        F.col("created_at").cast("string").alias("created"),
        F.col("updated_at").cast("string").alias("updated"),
        "status",
        "archived",
        "description",
        F.struct(
            F.col("project_id").alias("id"), F.col("project_hashed_id").alias("hashed_id"),
            F.col("project_name").alias("name"),
        ).alias("project"),
        F.to_json(section).alias("section"),
        F.struct(F.col("share_url").alias("url")).alias("share_link"),
        _thumbnail(),
        F.col("ingest_date").alias("landed"),
    )


def _visitor(key: Column, **fields: Column) -> Column:
    """A visitor record with every field; ``fields`` say what differs from one made of the key."""
    made = {
        "name": F.concat(F.lit("visitor "), key),
        "email": F.lit(None).cast("string"),
        "org": F.lit(None).cast("string"),
        "created_at": F.lit("2024-01-03T00:00:00Z"),
        "last_active_at": F.concat(F.lit("2024-01-04T00:00:"), F.lpad((key % 60).cast("string"), 2, "0"), F.lit("Z")),
        "browser_version": F.lit("1"),
        "platform": F.lit("Windows"),
        "mobile": key % 2 == 0,
        **fields,
    }
    return F.struct(
        F.concat(F.lit("v"), key).alias("visitor_key"),
        made["created_at"].alias("created_at"),
        made["last_active_at"].alias("last_active_at"),
        F.concat(F.lit("e"), key).alias("last_event_key"),
        key.alias("load_count"),
        (key % 9).alias("play_count"),
        F.when(key % 2 == 1, F.concat(F.lit("e"), key + 1)).alias("identifying_event_key"),
        F.struct(
            made["name"].alias("name"),
            made["email"].alias("email"),
            F.struct(made["org"].alias("name"), F.concat(F.lit("title "), key % 3).alias("title")).alias("org"),
        ).alias("visitor_identity"),
        F.struct(
            F.lit("Edge").alias("browser"), made["browser_version"].alias("browser_version"),
            made["platform"].alias("platform"), made["mobile"].alias("mobile"),
        ).alias("user_agent_details"),
    )


VISITOR_RECORD = (
    "visitor_key", "created_at", "last_active_at", "last_event_key", "load_count", "play_count",
    "identifying_event_key", "visitor_identity", "user_agent_details",
)


def raw_visitors(spark: SparkSession, folder: str) -> DataFrame:
    """Visitor records, one per customer; odd customers come wrapped in a ``visitors`` list."""
    key = F.col("c_custkey")
    record = _visitor(
        key,
        name=F.col("c_name"),
        email=F.when(key % 3 == 0, F.concat(F.col("c_name"), F.lit("@example.com"))),
        org=F.col("c_mktsegment"),
        browser_version=(key % 5).cast("string"),
        platform=F.when(key % 2 == 0, "Android").otherwise("Mac"),
    )
    alone = F.when(key % 2 == 0, record)
    return read(spark, folder, "customer").select(
        *[alone.getField(f).alias(f) for f in VISITOR_RECORD],
        F.when(key % 2 == 1, F.array(record)).alias("visitors"),
        F.lit(FIRST_BATCH).alias("landed"),
    )


def raw_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Visitor records with what the silver-shaped summaries say, in both batches."""
    key = F.expr("CAST(substr(visitor_key, 2) AS BIGINT)")
    record = _visitor(
        key, email=F.col("visitor_email"), org=F.col("visitor_org_name"), created_at=F.lit("2024-03-01T00:00:00Z"),
        last_active_at=F.lit("2023-12-01T00:00:00Z"), mobile=F.lit(False),
    )
    return visitors(spark, folder).select(
        *[record.getField(f).alias(f) for f in VISITOR_RECORD], F.col("ingest_date").alias("landed")
    )
