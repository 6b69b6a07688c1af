"""Bookkeeping of the collection: listed ids, stored objects, outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.functions.text import object_name
from procrisk.operators.skew import skew_join


def page_ids(pages: DataFrame, *, carry: tuple[str, ...] = ("page",)) -> DataFrame:
    """Listed ids as text, in page order by ``carry`` and ``position``; duplicates stay,
    absent, empty and zero ids go."""
    item = pages.select(*carry, F.posexplode("content").alias("position", "item"))
    listed = item.select(*carry, "position", F.col("item.id").cast("string").alias("id"))
    return listed.where(F.col("id").isNotNull() & ~F.col("id").isin("", "0"))


def missing_ids(
    listed: DataFrame,
    stored: DataFrame,
    *,
    id_col: str = "id",
    entity: str | None = None,
    min_id: int = fixed.MIN_OBJECT_ID,
    hot_rows: int | None = None,
) -> DataFrame:
    """Rows of ``listed`` from ``min_id`` on whose id is not among ``stored``, or with
    ``entity`` not among those stored for the same entity."""
    wanted = listed.where(F.col(id_col).try_cast("long") >= min_id)
    on = [entity, id_col] if entity else [id_col]
    return skew_join(wanted, stored, on, "left_anti", hot_rows=hot_rows)


def missing_counts(listed: DataFrame, stored: DataFrame, entity: str = "entity", **options) -> DataFrame:
    """Per entity: listed ids from ``min_id`` on that are not stored for it, 0 included."""
    missing = missing_ids(listed, stored, entity=entity, **options)
    entities = listed.groupBy(entity).agg(F.lit(0).cast("long").alias("__none"))
    counts = missing.groupBy(entity).agg(F.count("*").alias("missing"))
    return entities.join(counts, entity, "left").select(
        entity, F.coalesce("missing", "__none").alias("missing")
    )


def entity_status(listed: DataFrame, stored: DataFrame) -> DataFrame:
    """Per entity: listed ids, stored objects, remaining and completion percentage."""
    total = listed.groupBy("entity").agg(F.count("*").alias("total_ids"))
    existing = stored.groupBy("entity").agg(F.count("*").alias("existing_objects"))
    both = total.join(existing, "entity", "full").fillna(0, ["total_ids", "existing_objects"])
    share = F.try_divide(F.col("existing_objects") * 100.0, F.col("total_ids"))
    return both.withColumns(
        {
            "remaining": F.col("total_ids") - F.col("existing_objects"),
            "completion_percent": F.round(F.coalesce(share, F.lit(0.0)), 6),
        }
    )


def outcome_tally(results: DataFrame, entity: str = "entity", status: str = "status") -> DataFrame:
    """Per entity: count of every outcome, of any further one (``other``), and all."""
    known = F.coalesce(F.col(status).isin(fixed.OUTCOMES), F.lit(False))
    return results.groupBy(entity).agg(
        *[F.count_if(F.col(status) == o).alias(o) for o in fixed.OUTCOMES],
        F.count_if(~known).alias("other"),
        F.count("*").alias("total"),
    )


def success_rate(objects: DataFrame, listed: DataFrame) -> DataFrame:
    """One row: objects fetched, records listed and the percentage, NULL without objects."""
    fetched = objects.agg(F.count("*").alias("n")).scalar()
    rows = listed.agg(F.count("*").alias("total_records")).select(
        fetched.alias("objects"), "total_records"
    )
    rate = F.try_divide(F.col("objects") * 100.0, F.col("total_records"))
    return rows.withColumn("success_rate", F.when(F.col("objects") > 0, F.round(rate, 6)))


def with_object_name(df: DataFrame, entity: str = "entity", out: str = "object_entity") -> DataFrame:
    """Object entity of each list entity."""
    return df.withColumn(out, object_name(entity))


def record_totals(pages: DataFrame, entity: str = "entity") -> DataFrame:
    """Pages and records per entity, and overall under the name ``all``."""
    name = F.when(F.grouping(entity) == 1, F.lit("all")).otherwise(F.col(entity))
    return (
        pages.rollup(entity)
        .agg(
            name.alias("__name"),
            F.count("*").alias("pages"),
            F.sum(F.coalesce(F.size("content"), F.lit(0))).alias("total_records"),
        )
        .select(F.col("__name").alias(entity), "pages", "total_records")
    )
