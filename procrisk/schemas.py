"""Read schemas of the nested entities, and the flat column types."""

from __future__ import annotations

from pyspark.sql import types as T

from procrisk.fixed import AMOUNT_WORDS, DATE_WORD, METHOD_IDS, PATHS, TEXT_WORDS


def flat_type(column: str) -> str:
    """Type of a flat column, by the naming rules of the data model."""
    name = column.lower()
    textual = any(word in name for word in TEXT_WORDS)
    if name in METHOD_IDS:
        return "int"
    if DATE_WORD in name:
        return "timestamp_ntz"
    if any(word in name for word in AMOUNT_WORDS) and not textual:
        return "double"
    return "string"


def flat_schema(entity: str) -> T.StructType:
    """Bronze schema of an entity."""
    return T.StructType(
        [
            T.StructField(column, T._parse_datatype_string(flat_type(column)))
            for column in PATHS[entity].values()
        ]
    )


def raw_schema(entity: str) -> T.StructType:
    """Nested read schema of an entity: every leaf as text, so that typing is one
    explicit step and a badly typed value never rejects its record."""
    tree: dict = {}
    for path in PATHS[entity]:
        node = tree
        *parents, leaf = path.split(".")
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = None
    return _struct(tree)


def _struct(tree: dict) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, T.StringType() if child is None else _struct(child))
            for name, child in tree.items()
        ]
    )


def page_schema(record: T.DataType | None = None) -> T.StructType:
    """Envelope of a list page; ``record`` is the type of one content element."""
    record = record or T.StructType([T.StructField("id", T.StringType())])
    return T.StructType(
        [
            T.StructField("content", T.ArrayType(record)),
            T.StructField("totalPages", T.IntegerType()),
            T.StructField("totalElements", T.LongType()),
        ]
    )
