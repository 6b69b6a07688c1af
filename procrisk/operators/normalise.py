"""Nested records to flat, typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procrisk.fixed import PATHS
from procrisk.functions.types import DAY_FIRST, MONTH_FIRST, coerce, is_year_last, to_moment
from procrisk.schemas import flat_type, raw_schema
from procrisk.session import at_once
from procrisk.sources.documents import parse, read_texts, records_of, rejects_of
from procrisk.sources.tables import write_csv, write_parquet


def flatten(df: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as columns named by their path; arrays stay whole."""
    return df.select(
        *[
            F.col(".".join(f"`{part}`" for part in path)).alias(separator.join(path))
            for path in leaf_paths(df.schema)
        ]
    )


def leaf_paths(schema: T.StructType) -> list[tuple[str, ...]]:
    """Paths of the leaves of a schema, in field order."""
    paths: list[tuple[str, ...]] = []
    for field in schema:
        if isinstance(field.dataType, T.StructType):
            paths += [(field.name, *rest) for rest in leaf_paths(field.dataType)]
        else:
            paths.append((field.name,))
    return paths


def map_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Mapped paths under their new names, a path the schema lacks as NULL text.

    Only the mapped leaves are read. No mapped path at all gives no rows.
    """
    present = {".".join(path) for path in leaf_paths(df.schema)}
    columns = [
        (F.col(".".join(f"`{p}`" for p in path.split("."))) if path in present
         else F.lit(None).cast("string")).alias(name)
        for path, name in mapping.items()
    ]
    mapped = df.select(*columns)
    return mapped if present & set(mapping) else mapped.limit(0)


def date_layouts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """How each date column writes dates that end with the year, by vote of all its values.

    Per column: such ``values``, how many can be read ``day_first`` and ``month_first``, the
    ``layout`` more of them fit (month first if equal), and the ``lost`` ones, which do not.
    One aggregation for all columns.
    """
    names = columns if columns is not None else _date_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], _LAYOUTS)
    votes = [F.struct(F.lit(c).alias("column"), *_votes(F.col(f"`{c}`"))) for c in names]
    counted = df.agg(F.array(*votes).alias("votes")).select(F.inline("votes"))
    won = F.col("day_first") > F.col("month_first")
    return counted.withColumns(
        {
            "layout": F.when(won, F.lit(DAY_FIRST)).otherwise(F.lit(MONTH_FIRST)),
            "lost": F.col("values") - F.greatest("day_first", "month_first"),
        }
    )


_LAYOUTS = "column string, values long, day_first long, month_first long, layout string, lost long"


def _votes(value: Column) -> list[Column]:
    written = is_year_last(value)
    fits = [
        F.count_if(written & to_moment(value, layout).isNotNull()).alias(layout)
        for layout in (DAY_FIRST, MONTH_FIRST)
    ]
    return [F.count_if(written).alias("values"), *fits]


def _date_columns(df: DataFrame) -> list[str]:
    """Text columns that are typed as dates."""
    text = {field.name for field in df.schema if isinstance(field.dataType, T.StringType)}
    return [c for c in df.columns if c in text and flat_type(c) == "timestamp_ntz"]


def coerce_types(df: DataFrame, layouts: dict[str, str] | None = None) -> DataFrame:
    """Columns typed by their names; a value that does not fit becomes NULL.

    ``layouts`` gives the reading of each date column; without it the values vote first
    (``date_layouts``, one scan). Pass it for streams, so that all batches are read alike.
    """
    if layouts is None:
        # One row per date column.
        layouts = {r["column"]: r["layout"] for r in date_layouts(df).collect()}
    return df.select(
        *[coerce(F.col(c), flat_type(c), layouts.get(c, MONTH_FIRST)).alias(c) for c in df.columns]
    )


def normalise(records: DataFrame, entity: str, layouts: dict[str, str] | None = None) -> DataFrame:
    """Flat, typed table of one entity; dates are read month first unless ``layouts`` says
    otherwise, so that the batches of a stream are read alike."""
    return coerce_types(map_columns(records, PATHS[entity]), layouts or {})


def normalise_entity(
    spark: SparkSession,
    raw: str,
    entity: str,
    out: str,
    *,
    kind: str = "parquet",
    whole_files: bool = True,
) -> dict:
    """Reads, normalises and stores one entity; returns entity, records, columns, file, the
    number of documents that could not be read, the layouts of its dates and the dates that
    do not fit these.

    Rows, rejects and the votes on date layouts are counted while the table is written, all
    dates read month first. Only if a column's vote says otherwise, the table is written once
    more. Without rows ``file`` is None. Rejected documents, if any, are stored beside it as
    ``<entity>.rejects``.
    """
    parsed = parse(read_texts(spark, raw, whole_files), raw_schema(entity))
    unread = Observation(f"rejects of {entity}")
    observed = parsed.observe(unread, F.count_if(F.col("records").isNull()).alias("rejects"))
    records, counted = records_of(observed), Observation(f"rows of {entity}")
    dates = {c: path for path, c in PATHS[entity].items() if flat_type(c) == "timestamp_ntz"}
    votes = [v.alias(f"{k}:{c}") for c, path in dates.items() for k, v in enumerate(_votes(F.col(path)))]
    records = records.observe(counted, F.count(F.lit(1)).alias("records"), *votes)
    table = normalise(records, entity)
    write = {"parquet": write_parquet, "csv": write_csv}[kind]
    path = write(table, f"{out}/{entity}.{kind}")
    found, rejects = counted.get, unread.get["rejects"]
    rows = found["records"]
    won = {c: DAY_FIRST if found[f"1:{c}"] > found[f"2:{c}"] else MONTH_FIRST for c in dates}
    if DAY_FIRST in won.values():
        write(normalise(records_of(parsed), entity, won), path)
    if rejects:
        write_parquet(rejects_of(parsed), f"{out}/{entity}.rejects")
    return {
        "entity": entity,
        "records": rows,
        "columns": table.columns if rows else [],
        "file": path if rows else None,
        "error": None,
        "rejects": rejects,
        "layouts": won,
        "lost_dates": sum(found[f"0:{c}"] - max(found[f"1:{c}"], found[f"2:{c}"]) for c in dates),
    }


def normalise_all(
    spark: SparkSession, raw: str, out: str, *, kind: str = "parquet", whole_files: bool = True
) -> DataFrame:
    """Every entity, all at once; a failure of one is reported in its row and does not stop
    the rest."""
    done = at_once(
        {
            entity: lambda entity=entity: normalise_entity(
                spark, f"{raw}/{entity}", entity, out, kind=kind, whole_files=whole_files
            )
            for entity in PATHS
        }
    )
    rows = [
        {**_NOTHING, "entity": entity, "error": str(result)} if isinstance(result, Exception) else result
        for entity, result in done.items()
    ]
    return spark.createDataFrame([tuple(r[f] for f in _NOTHING) for r in rows], _REPORT)


_NOTHING = {
    "entity": None, "records": 0, "columns": [], "file": None, "error": None, "rejects": None,
    "layouts": None, "lost_dates": None,
}
_REPORT = (
    "entity string, records long, columns array<string>, file string, error string, rejects long, "
    "layouts map<string,string>, lost_dates long"
)
