"""JSON ingest with a frozen (inferred) schema and rescued data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

_ENTRIES = "array<struct<path: string, text: string>>"


def _entries(*pairs: tuple[Column, Column]) -> Column:
    return F.array(*[F.struct(p.alias("path"), t.alias("text")) for p, t in pairs]).cast(_ENTRIES)


def _named(prefix: Column | None, name: Column) -> Column:
    # dots and brackets of a field's own name are escaped, so no two fields share a path
    name = F.regexp_replace(name, r"([.\[\\])", r"\\$1")
    return name if prefix is None else F.concat(prefix, F.lit("."), name)


def _lost(text: Column, parsed: Column, kind: DataType, path: Column | None) -> Column:
    """(path, text) of what ``parsed`` lacks of the JSON value ``text``."""
    none = F.array().cast(_ENTRIES)
    whole = _entries((path, text)) if path is not None else none
    if isinstance(kind, StructType):
        fields = F.from_json(text, "map<string,string>")
        declared = F.array(*[F.lit(f.name) for f in kind.fields]).cast("array<string>")
        extra = F.map_entries(F.map_filter(fields, lambda k, v: ~F.array_contains(declared, k)))
        parts = [F.transform(extra, lambda e: F.struct(_named(path, e["key"]).alias("path"),
                                                       e["value"].alias("text"))).cast(_ENTRIES)]
        for f in kind.fields:
            parts.append(_lost(F.element_at(fields, F.lit(f.name)), parsed.getField(f.name), f.dataType,
                               _named(path, F.lit(f.name))))
        inner = F.concat(*[F.coalesce(p, none) for p in parts])
        return F.when(text.isNull(), none).when(fields.isNull(), whole).otherwise(inner)
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, (StructType, ArrayType)):
        items = F.transform(F.from_json(text, "array<string>"), lambda x, i: _lost(
            x, F.get(parsed, i), kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.when(text.isNull(), none).when(parsed.isNull(), whole) \
            .otherwise(F.coalesce(F.flatten(items), none))
    return F.when(text.isNotNull() & parsed.isNull(), whole).otherwise(none)


def rescued_fields(col: str, schema: StructType, parsed: Column | None = None) -> Column:
    """JSON text {path: value} of what the schema can't hold (NULL when there is nothing): undeclared
    fields at any depth and values of the wrong type. Paths are like ``a.b`` and ``a.items[2].b``.
    """
    found = _lost(F.col(col), F.from_json(F.col(col), schema) if parsed is None else parsed, schema, None)
    paths = F.transform(found, lambda e: e["path"])
    first = F.filter(found, lambda e, i: F.array_position(paths, e["path"]) == i + 1)  # a key given twice
    return F.when(F.size(found) > 0, F.to_json(F.map_from_entries(first)))


def parse_json_rescue(df: DataFrame, col: str, schema: StructType,
                      rescue_col: str = "_rescued_data", keep: list[str] | None = None) -> DataFrame:
    """Parse a JSON text column with a declared schema; what it can't hold goes to ``rescue_col``.

    Works on batch and streaming frames (text source). A record that is not JSON at all parses to
    NULL fields and keeps its text in ``rescue_col``.
    """
    keep = list(keep or [])
    parsed = df.select(F.col(col).alias("_text"), F.from_json(F.col(col), schema).alias("_parsed"), *keep)
    rescued = F.when(F.from_json("_text", "map<string,string>").isNull(), F.col("_text")) \
        .otherwise(rescued_fields("_text", schema, F.col("_parsed")))
    return parsed.select("_parsed", rescued.alias(rescue_col), *keep) \
        .select("_parsed.*", rescue_col, *keep)
