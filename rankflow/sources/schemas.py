"""Declared schemas of the tables the dataflows read, and variants of a schema."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """``name type`` per line; a trailing ``!`` marks a field that must be present."""
    fields = []
    for line in text.strip().splitlines():
        name, kind = line.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


# Column names and types of the published data files, in file order.
_INTERACTIONS = """
date_time timestamp!
site_name int
posa_continent int
user_location_country int
user_location_region int
user_location_city int
orig_destination_distance float
user_id int!
is_mobile int
is_package int
channel int
srch_ci string
srch_co string
srch_adults_cnt int
srch_children_cnt int
srch_rm_cnt int
srch_destination_id string
srch_destination_type_id string
is_booking int
cnt int
hotel_continent int
hotel_country int
hotel_market int
"""
_PASSENGERS = """
PassengerId int
Survived int
Pclass int
Name string
Sex string
Age float
SibSp int
Parch int
Ticket string
Fare float
Cabin string
Embarked string
"""
ITEM_INFO_BULKY = ("images_array", "attrsJSON")
ITEM_INFO_TEXTS = ("title", "description")

PASSENGER_SCHEMA = _schema(_PASSENGERS)


def append_field(schema: T.StructType, field: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, field])


def prepend_field(schema: T.StructType, field: T.StructField) -> T.StructType:
    return T.StructType([field, *schema.fields])


def without_fields(schema: T.StructType, names: Collection[str]) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in names])


def interaction_schema(training: bool) -> T.StructType:
    """Training rows end with the label; requests start with their id."""
    base = _schema(_INTERACTIONS)
    if training:
        return append_field(base, T.StructField("hotel_cluster", T.IntegerType(), False))
    return prepend_field(base, T.StructField("id", T.IntegerType(), False))
