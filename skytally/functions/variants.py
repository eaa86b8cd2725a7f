"""Columns of free JSON documents: which paths a VARIANT column holds, and their values.

The paths and types are found by ``schema_of_variant_agg``, one aggregation over the documents. Where a
path holds objects in some documents and other values in others, it merges to VARIANT and hides the
objects' fields; such paths are aggregated again over their objects alone, one more pass for each level of
conflicts, so no field is missed.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.records import is_object

MAX_LEAVES = 5_000
Path = tuple[str, ...]

_OBJECT = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<")


def type_of(text: str | None) -> T.DataType:
    """The type that ``schema_of_variant`` writes, objects as structs."""
    if text is None:
        return T.NullType()
    return T.DataType.fromDDL(_OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text))


def _child(value: Column, name: str) -> Column:
    """A field whose name no path can write."""
    return F.try_element_at(F.try_variant_get(value, F.lit("$"), "map<string,variant>"), F.lit(name))


def value_at(doc: Column, path: Path, kind: str = "variant") -> Column:
    """The value at a path of field names, whatever characters they have."""
    steps = []
    for depth, name in enumerate(path):
        quote = next((q for q in "'\"" if q not in name), None)
        if not name or quote is None:
            holder = value_at(doc, path[:depth])
            return value_at(_child(holder, name), path[depth + 1:], kind)
        steps.append(f"[{quote}{name}{quote}]")
    return F.try_variant_get(doc, F.lit("$" + "".join(steps)), kind)


def _walk(kind: T.DataType, path: Path, leaves: dict[Path, T.DataType], conflicts: list[Path]) -> None:
    if isinstance(kind, T.StructType) and kind.fields:
        for field in kind:
            _walk(field.dataType, (*path, field.name), leaves, conflicts)
    else:
        leaves[path] = kind
        if isinstance(kind, T.VariantType):
            conflicts.append(path)


def discover(docs: DataFrame, column: str = "doc") -> dict[Path, T.DataType]:
    """Path → type of every leaf of the documents that are objects; VARIANT where types differ."""
    leaves: dict[Path, T.DataType] = {}
    open_paths: list[Path] = [()]
    while open_paths:
        values = [value_at(F.col(column), path) if path else F.col(column) for path in open_paths]
        found = docs.agg(*[
            F.schema_of_variant_agg(F.when(is_object(v), v)).alias(f"s{n}") for n, v in enumerate(values)
        ]).first()
        conflicts: list[Path] = []
        for path, text in zip(open_paths, found):
            kind = type_of(text)
            if isinstance(kind, T.StructType):
                _walk(kind, path, leaves, conflicts)
        open_paths = conflicts
        if len(leaves) > MAX_LEAVES:
            raise ValueError(f"documents have more than {MAX_LEAVES} distinct fields; they cannot be columns")
    return leaves


def leaf(doc: Column, path: Path, kind: T.DataType) -> Column:
    """The typed value of a leaf; fractions as double, lists and mixed values as text."""
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return value_at(doc, path, "double")
    if isinstance(kind, (T.VariantType, T.StructType)):
        value = value_at(doc, path)
        return F.when(~is_object(value), F.try_variant_get(value, F.lit("$"), "string"))
    if isinstance(kind, (T.ArrayType, T.NullType)):
        return value_at(doc, path, "string")
    return value_at(doc, path, kind.simpleString())


def leaf_columns(docs: DataFrame, column: str = "doc") -> dict[str, Column]:
    """Dotted name → value of every leaf, by name; equal dotted names share a column."""
    named: dict[str, list[tuple[Path, T.DataType]]] = {}
    for path, kind in sorted(discover(docs, column).items()):
        named.setdefault(".".join(path), []).append((path, kind))
    doc = F.col(column)

    def shared(found: list[tuple[Path, T.DataType]]) -> Column:
        if len(found) == 1:
            return leaf(doc, *found[0])
        return reduce(lambda a, b: F.coalesce(a, b), [leaf(doc, p, k).cast("string") for p, k in found])

    return {name: shared(found) for name, found in named.items()}
