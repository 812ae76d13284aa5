"""Hash-field functions on map columns, and map, struct and JSON conversion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def set_fields(hash_map: Column, fields: Mapping[str, Column]) -> Column:
    """Set or replace the given fields, leaving the others."""
    update = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)])
    return merge(hash_map, update)


def merge(hash_map: Column, update: Column) -> Column:
    """Field-level merge; the update wins."""
    base = F.map_filter(hash_map, lambda k, v: ~F.map_contains_key(update, k))
    return F.when(hash_map.isNull(), update).when(update.isNull(), hash_map).otherwise(F.map_concat(base, update))


def set_if_absent(hash_map: Column, field: str, value: Column) -> Column:
    present = F.coalesce(F.map_contains_key(hash_map, F.lit(field)), F.lit(False))
    return F.when(present, hash_map).otherwise(set_fields(hash_map, {field: value}))


def delete_fields(hash_map: Column, *fields: str) -> Column:
    return F.map_filter(hash_map, lambda k, v: ~k.isin(*fields))


def field_names(hash_map: Column) -> Column:
    return F.map_keys(hash_map)


def field_values(hash_map: Column) -> Column:
    return F.map_values(hash_map)


def field_count(hash_map: Column) -> Column:
    return F.coalesce(F.cardinality(hash_map), F.lit(0))


def has_field(hash_map: Column, field: str) -> Column:
    return F.coalesce(F.map_contains_key(hash_map, F.lit(field)), F.lit(False))


def map_to_struct(hash_map: Column, schema: T.StructType) -> Column:
    """Pick and cast the schema's fields; a missing or unusable one becomes null."""
    return F.struct(*[F.try_element_at(hash_map, F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in schema])


def struct_to_map(struct: Column, fields: Sequence[str]) -> Column:
    """All fields as text."""
    return F.create_map(*[x for f in fields for x in (F.lit(f), struct[f].cast("string"))])


def to_text(value: Column) -> Column:
    """JSON text of a struct, a map or a list of them."""
    return F.to_json(value)


def from_text(text: Column, schema: T.DataType) -> Column:
    """Struct, or list of structs for an array schema; unparsable text gives null."""
    parsed = F.from_json(text, schema)
    if isinstance(schema, T.ArrayType):
        return parsed
    usable = F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT")
    return F.when(usable, parsed)
