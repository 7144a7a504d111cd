"""Text helpers: emptiness, comma lists and ``key=value`` records."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal(text):
    return r"\Q" + text + r"\E"


def is_empty(col: Column) -> Column:
    return col.isNull() | (col == "")


def is_not_empty(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def trim_comma(col: Column) -> Column:
    """Drop at most one leading and one trailing comma."""
    return F.regexp_replace(col, r"^,|,\z", "")


def pad_two(col: Column) -> Column:
    """Two characters stay as they are; anything else gets one leading zero."""
    return F.when(F.length(col) == 2, col).otherwise(F.concat(F.lit("0"), col))


def csv_to_ids(col: Column) -> Column:
    """Comma list to ``array<bigint>``.

    Null and empty text give null, trailing commas are ignored, any other token
    that is not a number raises (ANSI cast).
    """
    tokens = F.split(F.regexp_replace(col, r",+\z", ""), ",")
    ids = F.transform(tokens, lambda token: token.cast("bigint"))
    return F.when(is_not_empty(col), ids)


def any_of(col: Column, values) -> Column:
    """True where a comma list shares a token with ``values``; null stays null.

    Single values take the plain ``IN`` test; only text that holds a comma is split.
    """
    values = [value for value in values if value != ""]
    if not values:
        return F.lit(False)
    wanted = F.array(*[F.lit(value) for value in values])
    return col.isin(values) | (col.contains(",") & F.arrays_overlap(F.split(col, ","), wanted))


def kv_encode(fields) -> Column:
    """``k=v|k=v`` text from (key, column) pairs; null is written as ``null``."""
    parts = [
        F.concat(F.lit(f"{key}="), F.coalesce(col.cast("string"), F.lit("null")))
        for key, col in fields
    ]
    return F.concat_ws("|", *parts)


def kv_get(col: Column, delimiter: str, field: str) -> Column:
    """Value of the first ``field=value`` segment, null if there is none.

    A segment counts when it has exactly one key and one value once trailing ``=``
    signs are dropped, so ``k=`` has no value.
    """
    segments = F.split(col, _literal(delimiter))
    pairs = F.transform(segments, lambda s: F.split(F.regexp_replace(s, r"=+\z", ""), "="))
    hits = F.filter(pairs, lambda p: (F.size(p) == 2) & (F.get(p, 0) == field))
    return F.get(F.get(hits, 0), 1)


def kv_set(col: Column, delimiter: str, field: str, value) -> Column:
    """Replace the value of the first segment named ``field``.

    An unknown field changes nothing. Segments are always re-joined with ``|`` and
    trailing empty segments are dropped.
    """
    value = value if isinstance(value, Column) else F.lit(value)
    quoted = _literal(delimiter)
    segments = F.split(F.regexp_replace(col, rf"(?:{quoted})+\z", ""), quoted)
    names = F.transform(segments, lambda s: F.split_part(s, F.lit("="), F.lit(1)))
    position = F.array_position(names, F.lit(field)) - 1
    replaced = F.transform(
        segments,
        lambda s, i: F.when(i == position, F.concat(F.lit(f"{field}="), value)).otherwise(s),
    )
    return F.array_join(replaced, "|")


def split_csv(text):
    """Tokens of a comma-joined parameter; missing or empty text gives None."""
    if text is None or text == "":
        return None
    return tuple(token for token in text.split(",") if token != "")
