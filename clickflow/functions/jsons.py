"""Reads from JSON text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_of_array(col: Column, field: str) -> Column:
    """Element 0 of the array under ``field`` as text; null if absent or empty."""
    return F.get_json_object(col, f"$.{field}[0]")


def field_of_first(col: Column, field: str) -> Column:
    """``field`` of the first object in a JSON array of objects, as text."""
    return F.get_json_object(col, f"$[0].{field}")
