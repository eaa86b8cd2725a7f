"""Payload unwrapping, record keys and record predicates over VARIANT documents.

A payload is one VARIANT per file. ``unwrap`` turns it into one VARIANT per record; the other
functions read a record by path, so no record is parsed twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.functions.scalars import clean_text, once, to_number

# French domestic airports.
FRENCH_IATA = [
    "CDG", "ORY", "NCE", "MRS", "LYS", "TLS", "BOD", "NTE", "SXB", "MPL", "BIA", "AJA", "BES",
    "RNS", "PUF", "LIL", "BIQ",
]
FRENCH_ICAO_PREFIX = "LF"

# Followed routes (departure, arrival).
FOLLOWED_ROUTES = [
    ("ORY", "MRS"), ("ORY", "NCE"), ("ORY", "TLS"), ("ORY", "BOD"), ("ORY", "MPL"),
    ("CDG", "NCE"), ("CDG", "TLS"), ("CDG", "LYS"), ("CDG", "MRS"), ("CDG", "BOD"),
    ("LYS", "BOD"), ("LYS", "NTE"), ("LYS", "TLS"), ("MRS", "BOD"), ("NCE", "NTE"),
]

# Where a document may hold each code, in order of precedence.
DEPARTURE_IATA_PATHS = ["departure.iata", "departure.iata_code", "departure_iata", "departure_iata_code"]
ARRIVAL_IATA_PATHS = ["arrival.iata", "arrival.iata_code", "arrival_iata", "arrival_iata_code"]
DEPARTURE_ICAO_PATHS = ["departure.icao", "departure.icao_code", "departure_icao", "departure_icao_code"]
ARRIVAL_ICAO_PATHS = ["arrival.icao", "arrival.icao_code", "arrival_icao", "arrival_icao_code"]
AIRLINE_IATA_PATHS = ["airline.iata_code", "airline.iata", "airline_iata"]
OPERATOR_PATHS = [
    "airline.icao_code", "airline.icao", "airline_icao_code", "airline_icao",
    "airline.iata_code", "airline.iata", "airline_iata_code", "airline_iata",
    "airline.airline_name", "airline.name",
]

FLIGHT_KEY = ["flight_date", "flight_number", "departure_iata", "arrival_iata", "airline_iata"]
AIRLINE_KEY = ["airline_iata", "airline_icao", "airline_name"]
AIRPORT_KEY = ["airport_iata", "airport_icao", "airport_name"]

UNWRAP_MODES = ("flights", "reference", "insights", "features", "extractor")


# --- reading VARIANT -------------------------------------------------------------------------


def at(doc: Column, path: str) -> Column:
    """Sub-document at a dotted path: SQL NULL when absent, variant null when present as null."""
    return F.try_variant_get(doc, "$." + path, "variant")


def text_at(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, "$." + path, "string")


def number_at(doc: Column, path: str) -> Column:
    """Double at a path; numeric text counts."""
    return once(text_at(doc, path), to_number)


def number_of(value: Column) -> Column:
    """Double held by a VARIANT; numeric text counts."""
    return once(F.try_variant_get(value, F.lit("$"), "string"), to_number)


def whole_of(value: Column) -> Column:
    """Integer part of :func:`number_of`."""
    return number_of(value).try_cast("int")


def _filled_text_at(doc: Column, path: str) -> Column:
    """Text at a path, SQL NULL for '', false, 0, {} and []; the texts "0" and "false" stay."""
    is_text = F.schema_of_variant(at(doc, path)) == "STRING"
    # Only a text that looks empty needs a look at its JSON type.
    unsure = r"^(false|\{\}|\[\]|-?0(\.0*)?([eE][+-]?\d+)?)$"
    return once(text_at(doc, path), lambda text: F.when(text == "", None).when(
        text.rlike(unsure), F.when(is_text, text)).otherwise(text))


def first_text_at(doc: Column, *paths: str) -> Column:
    """First non-falsy value as text, the last one as it is."""
    *heads, last = paths
    return F.coalesce(*[_filled_text_at(doc, p) for p in heads], text_at(doc, last))


def is_falsy(value: Column) -> Column:
    """null, '', 0, false, {} and [] by JSON type: the text "0" is not falsy."""
    empty = r'^(null|""|false|\{\}|\[\]|-?0(\.0*)?([eE][+-]?\d+)?)$'
    return F.coalesce(F.to_json(value).rlike(empty), F.lit(True))


def first_truthy_at(doc: Column, *paths: str) -> Column:
    """First non-falsy sub-document, the last one as it is."""
    *heads, last = paths
    return F.coalesce(*[once(at(doc, p), lambda v: F.when(~is_falsy(v), v)) for p in heads], at(doc, last))


def is_positive_number(value: Column) -> Column:
    """JSON number (or true) above zero. The text "7" is not a number."""
    def above_zero(held: Column, kind: Column) -> Column:
        numeric = (kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")) & (
            F.try_variant_get(held, "$", "double") > 0
        )
        true_flag = (kind == "BOOLEAN") & F.try_variant_get(held, "$", "boolean")
        return F.coalesce(numeric | true_flag, F.lit(False))

    return once(value, lambda held: once(F.schema_of_variant(held), lambda kind: above_zero(held, kind)))


def as_list(doc: Column, path: str = "$") -> Column:
    return F.try_variant_get(doc, path, "array<variant>")


def is_object(doc: Column) -> Column:
    # A struct of no fields: no value of the object is copied.
    return F.try_variant_get(doc, "$", "struct<>").isNotNull()


# --- unwrapping ------------------------------------------------------------------------------


def record_list(payload: Column, mode: str) -> Column:
    """The records of one payload as ``array<variant>`` under one of the unwrapping rules.

    flights    list, ``data``, ``results`` or the single object; every item kept
    reference  the same, but a list of pages is flattened and non-objects of the list dropped
    insights   as flights, non-objects dropped
    features   as insights, without ``results``
    extractor  ``data`` or ``results`` only, non-objects dropped
    """
    if mode not in UNWRAP_MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {UNWRAP_MODES}")
    none = F.array().cast("array<variant>")
    data, results = as_list(payload, "$.data"), as_list(payload, "$.results")
    single = F.when(is_object(payload), F.array(payload))
    if mode == "reference":
        pages = F.flatten(
            F.transform(
                F.filter(as_list(payload), is_object),
                lambda page: F.coalesce(
                    as_list(page, "$.data"), as_list(page, "$.results"), F.array(page)
                ),
            )
        )
        return F.coalesce(pages, data, results, single, none)
    if mode == "flights":
        return F.coalesce(as_list(payload), data, results, single, none)
    if mode == "extractor":
        found = F.coalesce(data, results, none)
    elif mode == "features":
        found = F.coalesce(as_list(payload), data, single, none)
    else:
        found = F.coalesce(as_list(payload), data, results, single, none)
    return F.filter(found, is_object)


def unwrap(
    payloads: DataFrame, mode: str, payload: str = "payload", keep_empty: bool = False
) -> DataFrame:
    """One row per record: the other columns, ``record_ix`` and ``doc``.

    With ``keep_empty`` a payload without records gives one row with a null ``doc``.
    """
    rest = [c for c in payloads.columns if c != payload]
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return payloads.select(
        *rest, explode(record_list(F.col(payload), mode)).alias("record_ix", "doc")
    )


# --- keys ------------------------------------------------------------------------------------


def flight_key(doc: Column) -> dict[str, Column]:
    return {
        "flight_date": text_at(doc, "flight_date"),
        "flight_number": first_text_at(doc, "flight.iata", "flight.icao", "flight.number"),
        "departure_iata": text_at(doc, "departure.iata"),
        "arrival_iata": text_at(doc, "arrival.iata"),
        "airline_iata": text_at(doc, "airline.iata"),
    }


def airline_key(doc: Column) -> dict[str, Column]:
    return {
        "airline_iata": text_at(doc, "iata_code"),
        "airline_icao": text_at(doc, "icao_code"),
        "airline_name": text_at(doc, "airline_name"),
    }


def airport_key(doc: Column) -> dict[str, Column]:
    return {
        "airport_iata": text_at(doc, "iata_code"),
        "airport_icao": text_at(doc, "icao_code"),
        "airport_name": text_at(doc, "airport_name"),
    }


KEY_RULES = {
    "flights": (flight_key, FLIGHT_KEY),
    "airlines": (airline_key, AIRLINE_KEY),
    "airports": (airport_key, AIRPORT_KEY),
}


def with_keys(records: DataFrame, endpoint: str) -> DataFrame:
    """Key columns and ``is_valid``; invalid rows stay so that they can be counted or set aside."""
    rule, names = KEY_RULES[endpoint]
    keyed = records.withColumns(rule(F.col("doc")))
    if endpoint == "flights":
        valid = F.col("flight_date").isNotNull() & F.col("flight_number").isNotNull()
    else:
        valid = F.coalesce(*[F.col(n) for n in names]).isNotNull()
    return keyed.withColumn("is_valid", is_object(F.col("doc")) & valid)


def meta(run_id: Column, source: Column, endpoint: Column, loaded_at: Column) -> Column:
    return F.struct(
        run_id.alias("run_id"), source.alias("source"), endpoint.alias("endpoint"),
        loaded_at.alias("loaded_at"),
    )


# --- predicates ------------------------------------------------------------------------------


def is_followed_airport_pair(departure: Column, arrival: Column) -> Column:
    return F.upper(departure).isin(FRENCH_IATA) & F.upper(arrival).isin(FRENCH_IATA)


def is_in_air(doc: Column) -> Column:
    """``live.is_ground`` decides when present, and must be the JSON value false."""
    flag = at(doc, "live.is_ground")
    return F.coalesce(
        F.when(flag.isNotNull(), F.to_json(flag) == "false").otherwise(
            text_at(doc, "flight_status") == "active"
        ),
        F.lit(False),
    )


def clean_text_at(doc: Column, paths: Sequence[str], upper: bool = False) -> Column:
    """First non-falsy value as trimmed text, null where it is blank."""
    return once(first_text_at(doc, *paths), lambda text: clean_text(text, upper))


def departure_iata(doc: Column) -> Column:
    return clean_text_at(doc, DEPARTURE_IATA_PATHS, upper=True)


def arrival_iata(doc: Column) -> Column:
    return clean_text_at(doc, ARRIVAL_IATA_PATHS, upper=True)


def departure_icao(doc: Column) -> Column:
    return clean_text_at(doc, DEPARTURE_ICAO_PATHS, upper=True)


def arrival_icao(doc: Column) -> Column:
    return clean_text_at(doc, ARRIVAL_ICAO_PATHS, upper=True)


def airline_iata(doc: Column) -> Column:
    return clean_text_at(doc, AIRLINE_IATA_PATHS)


def operator_code(doc: Column) -> Column:
    """Airline ICAO, else IATA, else name."""
    return clean_text_at(doc, OPERATOR_PATHS, upper=True)


def is_french_domestic(dep_iata: Column, arr_iata: Column, dep_icao: Column, arr_icao: Column) -> Column:
    by_iata = dep_iata.isin(FRENCH_IATA) & arr_iata.isin(FRENCH_IATA)
    by_icao = dep_icao.startswith(FRENCH_ICAO_PREFIX) & arr_icao.startswith(FRENCH_ICAO_PREFIX)
    return F.coalesce(by_iata, F.lit(False)) | F.coalesce(by_icao, F.lit(False))


# --- pruning ---------------------------------------------------------------------------------


def pruned(column: Column, dtype: T.DataType) -> Column:
    """Drop null, '', [] and {} at every level of a typed column; 0 and false stay."""
    if isinstance(dtype, T.StringType):
        return F.nullif(column, F.lit(""))
    if isinstance(dtype, T.StructType):
        if not dtype.fields:
            return F.lit(None).cast(dtype)
        children = [pruned(column.getField(f.name), f.dataType).alias(f.name) for f in dtype]
        filled = reduce(or_, [c.isNotNull() for c in children])
        return F.when(filled, F.struct(*children))
    if isinstance(dtype, T.ArrayType):
        kept = F.filter(
            F.transform(column, lambda x: pruned(x, dtype.elementType)), lambda x: x.isNotNull()
        )
        return F.when(F.size(kept) > 0, kept)
    return column


def pruned_json(column: Column, dtype: T.DataType) -> Column:
    """JSON text of the pruned value, or of the original when nothing is left."""
    return F.coalesce(F.to_json(pruned(column, dtype)), F.to_json(column))


def prune_documents(df: DataFrame, column: str) -> DataFrame:
    """Prune free-form JSON text whose fields are not known beforehand (Arrow batches).

    The functions are nested so that they travel to the workers by value.
    """

    def pruned_node(node):
        if isinstance(node, dict):
            left = {k: v for k, v in ((k, pruned_node(v)) for k, v in node.items()) if v is not None}
            return left or None
        if isinstance(node, list):
            return [v for v in map(pruned_node, node) if v is not None] or None
        return None if node == "" else node

    def prune_text(text):
        left = None if text is None else pruned_node(json.loads(text))
        return text if left is None else json.dumps(left, separators=(",", ":"), ensure_ascii=False)

    def prune_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(prune_text)

    return df.withColumn(column, F.pandas_udf(prune_batches, "string")(F.col(column)))
