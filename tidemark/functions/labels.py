"""Cleaning of labels, names and versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_WORDS = ("", "NAN", "NONE", "NULL")  # fixed values: texts that stand for a missing label


def clean_label(label: Column) -> Column:
    """Trimmed and upper-cased; texts that stand for nothing become null, whole floats lose their zeros."""
    text = F.upper(F.trim(label.cast("string")))
    whole = F.regexp_replace(text, r"^(-?[0-9]+)\.0+$", "$1")
    return F.when(~text.isin(*NULL_WORDS), whole)


def clean_name(name: Column) -> Column:
    """Lower case with runs of other characters as one underscore."""
    return F.trim(F.lower(F.regexp_replace(name, r"[^0-9A-Za-z]+", "_")), F.lit("_"))


def duration_minutes(text: Column) -> Column:
    """The number at the head of a duration such as 5min."""
    return F.regexp_extract(text, r"^\s*([0-9]+)\s*min", 1).try_cast("int")


def version_key(version: Column) -> Column:
    """Major and minor number of a version such as v2.10 or v4.2_test, for ordering."""
    number = F.split(F.regexp_extract(version, r"v?([0-9]+(?:\.[0-9]+)?)", 1), r"\.")
    return F.struct(number[0].try_cast("int").alias("major"), F.coalesce(F.try_element_at(number, F.lit(2)).try_cast("int"), F.lit(0)).alias("minor"))
