"""Structure of semi-structured documents."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procrisk.fixed import KEY_FIELDS, PATHS
from procrisk.session import stage

SAMPLE_CHARS = 100
# Different schemas of documents that are unfolded by the driver, and documents whose schemas
# tell what to read.
MAX_SCHEMAS, FIRST_DOCUMENTS = 1_000, 1_000


def merged_schema(texts: DataFrame, column: str = "raw_text") -> DataFrame:
    """One row: the schema that fits all documents, from one aggregation."""
    variant = F.try_parse_json(F.col(column))
    return texts.agg(F.schema_of_variant_agg(variant).alias("schema"))


def path_profile(
    texts: DataFrame, column: str = "raw_text", max_depth: int = 3, max_schemas: int = MAX_SCHEMAS
) -> DataFrame:
    """Per path and type: documents, list lengths and a sample value.

    Lists are followed into their first item. Below ``max_depth`` only the type is given and
    the row is marked truncated.

    Documents are grouped by their schema, so paths and types are unfolded from the few
    different schemas and only lengths and samples are read from each document. Which paths to
    read is taken from the first documents; if others have more, all are read once again.
    With more than ``max_schemas`` schemas, lists of items without a common type, or keys that
    hold dots, brackets or quotes, each document is exploded into its nodes instead, with the
    same result.
    """
    node = F.try_parse_json(F.col(column))
    docs = texts.select(node.alias("__node")).where(F.col("__node").isNotNull())
    first = docs.limit(FIRST_DOCUMENTS).select(F.schema_of_variant("__node").alias("schema")).distinct()
    schemas = {r["schema"] for r in first.collect()}
    while 0 < len(schemas) <= max_schemas:
        nodes = {node for schema in schemas for node in paths_of(schema, max_depth)}
        # A key that looks like a path would be taken for one.
        plain = all(path.count(".") + path.count("[") == depth and '"' not in path for path, depth, _ in nodes)
        if not plain or any(kind == "VARIANT" for *_, kind in nodes):
            break
        profiled, found = _profile_by_schema(docs, nodes, max_depth, max_schemas)
        if profiled is None:
            break
        covered = {(path, _read_as(kind)) for path, _, kind in nodes}
        missing = {
            schema for schema in found - schemas
            if {(path, _read_as(kind)) for path, _, kind in paths_of(schema, max_depth)} - covered
        }
        if not missing:
            return profiled
        schemas |= found
    return profile_by_nodes(texts, column, max_depth)


def _read_as(kind: str) -> str:
    return kind if kind in ("OBJECT", "ARRAY", "VARIANT") else "scalar"


def paths_of(schema: str, max_depth: int) -> list[tuple[str, int, str]]:
    """(path, depth, type) of every node of a schema in Spark's notation, lists by their item;
    nodes below ``max_depth`` are given without those below them."""
    at, out = 0, []

    def word(end: str) -> str:
        nonlocal at
        if schema[at] == "`":
            close = at + 1
            while schema[close] != "`" or schema[close + 1 : close + 2] == "`":
                close += 2 if schema[close] == "`" else 1
            name, at = schema[at + 1 : close].replace("``", "`"), close + 1
            return name
        begin = at
        while at < len(schema) and schema[at] not in end:
            at += 1
        return schema[begin:at]

    def node(path: str, depth: int) -> None:
        nonlocal at
        shown = depth <= max_depth + 1
        place = len(out)
        kind = word("<>,(")
        if schema[at : at + 1] == "(":  # precision and scale
            at = schema.index(")", at) + 1
        if shown:
            out.insert(place, (path, depth, kind))
        if schema[at : at + 1] != "<":
            return
        at += 1
        while schema[at] != ">":
            if kind == "ARRAY":
                node(f"{path}[0]", depth + 1)
            else:
                key = word(":")
                at += 2
                node(f"{path}.{key}", depth + 1)
            if schema[at : at + 2] == ", ":
                at += 2
        at += 1

    node("$", 0)
    return out


def _profile_by_schema(
    docs: DataFrame, nodes: set[tuple], max_depth: int, max_schemas: int
) -> tuple[DataFrame | None, set[str]]:
    """The profile by the paths of ``nodes``, and the schemas that documents have: one
    aggregation per schema of the document and of the first items of its lists, whose own
    types the list's merged schema does not tell. None if there are more than
    ``max_schemas`` of either."""
    kinds: dict[str, set[str]] = {}
    for path, depth, kind in sorted(nodes):
        kinds.setdefault(path, set()).add(kind)
        if kind == "ARRAY" and depth <= max_depth:
            kinds.setdefault(f"{path}[0]", set())
    # Parts of a document with a schema of their own: the whole, and each list's first item.
    parts = ["$", *(p for p in kinds if p.endswith("[0]"))]

    def part_of(path: str) -> str:
        return max((p for p in parts if path == p or path.startswith((f"{p}.", f"{p}["))), key=len)

    def get(path: str, kind: str) -> Column:
        return F.try_variant_get("__node", _quoted(path), kind)

    facts: dict[str, list] = {p: [] for p in parts}
    for path, found in kinds.items():
        text = F.substring(get(path, "string"), 1, SAMPLE_CHARS) if found - {"OBJECT", "ARRAY"} else F.lit(None)
        size = F.size(get(path, "array<variant>")) if "ARRAY" in found else F.lit(None)
        facts[part_of(path)].append(
            F.struct(
                F.lit(path).alias("path"),
                F.min(text.cast("string")).alias("sample"),
                F.min(size.cast("int")).alias("min_length"),
                F.max(size.cast("int")).alias("max_length"),
            )
        )
    rows = []
    items = {p: get(p, "variant") if p != "$" else F.col("__node") for p in parts}
    names = [f"__schema{k}" for k in range(len(parts))]
    keyed = docs.select(
        "__node", *[F.when(items[p].isNotNull(), F.schema_of_variant(items[p])).alias(n) for p, n in zip(parts, names, strict=True)]
    )
    counted = stage(
        keyed.groupBy(*names).agg(
            F.count("*").alias("documents"),
            *[F.array(*facts[p]).alias(f"__facts{k}") for k, p in enumerate(parts)],
        ),
        "schemas",
    )
    for k, part in enumerate(parts):
        own = F.col(f"__schema{k}")
        rows.append(
            counted.where(own.isNotNull()).select(
                F.lit(part).alias("part"), own.alias("schema"), "documents", F.col(f"__facts{k}").alias("facts")
            )
        )
    found = reduce(DataFrame.unionByName, rows)
    known = found.select("part", "schema").distinct().limit(max_schemas + 1).collect()
    if len(known) > max_schemas:
        return None, set()
    unfolded = []
    for part, schema in known:
        start = part.count(".") + part.count("[")
        for path, depth, kind in paths_of(schema, max_depth - start):
            if "[" not in path:  # items of lists are told by their own part
                unfolded.append((part, schema, part + path[1:], kind, start + depth > max_depth))
    table = docs.sparkSession.createDataFrame(
        unfolded, "part string, schema string, path string, type string, truncated boolean"
    )
    told = found.join(F.broadcast(table), ["part", "schema"]).withColumn(
        "fact", F.get(F.filter("facts", lambda f: f["path"] == F.col("path")), F.lit(0))
    )
    shown = ~F.col("truncated")
    listed, scalar = F.col("type") == "ARRAY", ~F.col("type").isin("OBJECT", "ARRAY")
    profiled = _totals(
        told.select(
            "path", "type", "truncated", "documents",
            F.when(shown & listed, F.col("fact.min_length")).alias("min_length"),
            F.when(shown & listed, F.col("fact.max_length")).alias("max_length"),
            F.when(shown & scalar, F.col("fact.sample")).alias("sample"),
        )
    )
    return profiled, {schema for part, schema in known if part == "$"}


def _quoted(path: str) -> str:
    """A path as Spark reads it, each key in quotes."""
    return "$" + re.sub(r"\.([^.\[]*)", r'["\1"]', path[1:])


def _totals(nodes: DataFrame) -> DataFrame:
    """Numbers of different precision are one type; merged on the few counted rows."""
    return nodes.groupBy("path", _kind(F.col("type")).alias("type"), "truncated").agg(
        F.sum("documents").alias("documents"),
        F.min("min_length").alias("min_length"),
        F.max("max_length").alias("max_length"),
        F.min("sample").alias("sample"),
    )


def profile_by_nodes(texts: DataFrame, column: str = "raw_text", max_depth: int = 3) -> DataFrame:
    """``path_profile`` for documents of any schemas. One pass: each document is exploded
    level by level into its leaves, and a node is counted in the row of its first leaf.
    """
    spark = texts.sparkSession
    rows = texts.select(F.lit("$").alias("__path0"), F.try_parse_json(F.col(column)).alias("__node0"))
    rows = rows.where(F.col("__node0").isNotNull())
    levels = range(max_depth + 2)
    for depth in levels[1:]:
        child = spark.tvf.variant_explode_outer(F.col(f"__node{depth - 1}").outer()).toDF(
            "__pos", "__key", f"__node{depth}"
        )
        is_first = F.coalesce("__pos", F.lit(0)) == 0
        step = F.when(F.col("__key").isNotNull(), F.concat(F.lit("."), F.col("__key"))).otherwise("[0]")
        path = F.when(F.col("__pos").isNotNull(), F.concat(F.col(f"__path{depth - 1}"), step))
        # A node above travels on with its first child only: it is counted once, and
        # large documents are not copied to each of their leaves.
        above = {n: F.when(is_first, F.col(n)) for n in (f"__node{d}" for d in range(depth))}
        rows = (
            rows.lateralJoin(child)
            .where(F.col("__key").isNotNull() | is_first)
            .withColumns({**above, f"__path{depth}": path})
            .drop("__pos", "__key")
        )
    found = [
        F.when(
            F.col(f"__path{d}").isNotNull() & F.col(f"__node{d}").isNotNull(),
            F.struct(
                F.col(f"__path{d}").alias("path"),
                F.col(f"__node{d}").alias("node"),
                F.lit(d > max_depth).alias("truncated"),
            ),
        )
        for d in levels
    ]
    nodes = _described(rows.select(F.inline(F.array_compact(F.array(*found)))))
    counted = nodes.groupBy("path", "type", "truncated").agg(
        F.count("*").alias("documents"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
        F.min("sample").alias("sample"),
    )
    return _totals(counted)


def _described(nodes: DataFrame) -> DataFrame:
    """Type of every node; above the cut also list length and sample."""
    node = F.col("node")
    nodes = nodes.withColumn("type", F.substring_index(F.schema_of_variant(node), "<", 1))
    items = F.size(F.try_variant_get(node, "$", "array<variant>"))
    text = F.substring(node.try_cast("string"), 1, SAMPLE_CHARS)
    shown = ~F.col("truncated")
    return nodes.select(
        "path",
        "type",
        "truncated",
        F.when(shown & (F.col("type") == "ARRAY"), items).alias("length"),
        F.when(shown & ~F.col("type").isin("OBJECT", "ARRAY"), text).alias("sample"),
    )


def _kind(raw: Column) -> Column:
    # Type names of the profile.
    names = {
        "OBJECT": "dict", "ARRAY": "list", "STRING": "str", "BIGINT": "int", "BOOLEAN": "bool",
        "VOID": "NoneType",
    }
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), raw), F.lit("float"))


def sample_profile(
    texts: DataFrame,
    key: str = "source_file",
    column: str = "raw_text",
    samples: int = 3,
    fields: list[str] | None = None,
) -> DataFrame:
    """Key fields of the first ``samples`` documents: document, field and value.

    An object is shown by its first three keys. Every row carries the number of
    documents there are in all.
    """
    total = texts.agg(F.count("*").alias("n")).scalar()
    first = texts.select(F.col(key).alias("document"), F.col(column).alias("__text")).orderBy(
        "document"
    ).limit(samples)
    listed = first.withColumn("field", F.explode(F.lit(fields or KEY_FIELDS)))
    top = F.from_json("__text", "map<string,string>")
    value = F.try_element_at(top, F.col("field"))
    nested = F.when(F.ltrim(value).startswith("{"), F.json_object_keys(value))
    shown = F.concat(F.lit("<dict with keys: "), F.array_join(F.slice(nested, 1, 3), ", "), F.lit(">"))
    found = F.array_contains(F.json_object_keys("__text"), F.col("field"))
    return listed.where(found).select(
        total.alias("documents"), "document", "field", F.coalesce(shown, value).alias("value")
    )


def path_coverage(records: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows with a value and their share."""
    counts = records.agg(F.count("*").alias("__n"), *[F.count(c).alias(c) for c in columns])
    return counts.unpivot("__n", columns, "column", "filled").select(
        "column",
        "filled",
        F.round(F.try_divide(F.col("filled").cast("double"), F.col("__n")), 6).alias("share"),
    )


def entity_coverage(flat: DataFrame, entity: str) -> DataFrame:
    """Coverage of the mapped paths of an entity, by source path."""
    names = F.create_map(*[F.lit(x) for p, c in PATHS[entity].items() for x in (c, p)])
    return path_coverage(flat, list(PATHS[entity].values())).withColumn(
        "path", F.element_at(names, F.col("column"))
    )
