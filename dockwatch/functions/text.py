"""Column expressions that turn feed text into typed values; bad input gives NULL, never an error."""

from pyspark.sql import Column, functions as F

INTEGER_TEXT = r"^-?\d+$"
DECIMAL_TEXT = r"^-?\d+(\.\d+)?$"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def soft_int(c) -> Column:
    """Text to BIGINT, NULL unless the trimmed text is a plain integer."""
    text = F.trim(_col(c))
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))


def soft_double(c) -> Column:
    """Text to DOUBLE, NULL unless the trimmed text is a plain decimal (no exponent, no NaN)."""
    text = F.trim(_col(c))
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast("double"))


def epoch_ts(c) -> Column:
    """Unix seconds as text to TIMESTAMP."""
    return F.timestamp_seconds(soft_int(c))


def iso_ts(c) -> Column:
    """ISO-8601 text with offset to TIMESTAMP."""
    return F.try_to_timestamp(_col(c))


def flag01(c) -> Column:
    """0/1 text to BOOLEAN, NULL stays NULL."""
    return soft_int(c) == 1


def flag_yes_no(c) -> Column:
    """OUI/NON text (the open-data export) to BOOLEAN."""
    text = F.upper(F.trim(_col(c)))
    return F.when(text == "OUI", F.lit(True)).when(text == "NON", F.lit(False))


def split_coords(c):
    """``"lat, lon"`` text to a (latitude, longitude) pair of DOUBLE columns."""
    text = _col(c)
    return (
        soft_double(F.split_part(text, F.lit(","), F.lit(1))),
        soft_double(F.split_part(text, F.lit(","), F.lit(2))),
    )


def squash_ws(c) -> Column:
    """Trim and collapse each run of whitespace to one space."""
    return F.regexp_replace(F.trim(_col(c)), r"\s+", " ")


def name_changed(c) -> Column:
    """True when squashing the whitespace changes the text."""
    return _col(c) != squash_ws(c)


def has_extra_ws(c) -> Column:
    """Leading/trailing spaces, or two whitespace characters in a row."""
    return (_col(c) != F.trim(_col(c))) | _col(c).rlike(r"\s{2,}")


def blank_to_null(c) -> Column:
    text = _col(c)
    return F.when(F.trim(text) != "", text)


def pad_code(c) -> Column:
    """Town code left-padded with zeros to five characters; empty text is NULL, not 00000."""
    return F.lpad(F.trim(blank_to_null(c)), 5, "0")


def dept_of(c) -> Column:
    return F.left(_col(c), F.lit(2))


def merge_type_maps(c) -> Column:
    """Array of small maps folded to one map; on a repeated key the last value wins.

    Higher-order fold over one row's own array (two entries in the feed), so it stays in the JVM.
    """
    entries = F.flatten(F.transform(F.coalesce(_col(c), F.array()), lambda m: F.map_entries(m)))
    return F.aggregate(
        entries,
        F.create_map().cast("map<string,string>"),
        lambda acc, e: F.map_concat(
            F.map_filter(acc, lambda k, _v: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))
        ),
    )


def type_count(merged: Column, code: str) -> Column:
    """Value of one type in a merged map; NULL when the type is absent."""
    return F.try_element_at(merged, F.lit(code))


def pct(part, whole) -> Column:
    """Percentage rounded to two decimals, NULL when the denominator is zero."""
    return F.round(F.lit(100.0).cast("double") * _col(part) / F.nullif(_col(whole), F.lit(0)), 2)


def compare_status(before, after) -> Column:
    """OK when nothing is left, reduced when fewer are left, accepted otherwise."""
    return (
        F.when(_col(after) == 0, "OK").when(_col(after) < _col(before), "reduced").otherwise("accepted")
    )
