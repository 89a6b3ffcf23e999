"""Day shifts on date (DA) and date-time (DT) text. Partial dates and ranges stay text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanloom.functions.text import ColumnOrName, col, let, lit_or_col, trimmed

MAX_DAYS = 36500
# Date attributes whose keyword does not tell the type. All others end in Date or DateTime, or begin
# with DateOf or DateTimeOf.
DATES_BY_NAME = ["IssueDateOfImagingServiceRequest", "ObservationDateTrial", "SelectorDAValue"]
DATE_TIMES_BY_NAME = ["ContextGroupLocalVersion", "ContextGroupVersion", "HL7DocumentEffectiveTime", "SelectorDTValue", "TemplateLocalVersion", "TemplateVersion"]


def date_type(keyword: ColumnOrName) -> Column:
    """DA or DT for the attributes that the dictionary gives one of these types, by keyword; NULL for all others."""
    k = col(keyword)
    return (F.when(k.endswith("DateTime") | k.startswith("DateTimeOf") | k.isin(DATE_TIMES_BY_NAME), "DT")
            .when(k.endswith("Date") | k.startswith("DateOf") | k.isin(DATES_BY_NAME), "DA"))


def _basic(text: Column, days: Column) -> Column:
    """One trimmed YYYYMMDD or YYYY.MM.DD value without dashes; '' when it is no calendar date."""
    iso = F.regexp_replace(text, r"\A([0-9]{4})(\.?)([0-9]{2})\2([0-9]{2})\z", "$1-$3-$4")
    # Only a rewritten value has a dash; anything else must not reach the lenient date cast.
    moved = let(iso, lambda i: F.when(F.contains(i, F.lit("-")), F.translate(F.date_add(i.try_cast("date"), days).cast("string"), "-", "")))
    return let(moved, lambda m: F.when(F.length(m) == 8, m).otherwise(""))


def _shift(text: Column, days: Column, date_time: Column) -> Column:
    """Shift trimmed text: a date, a date range, or (``date_time``) a date with a verbatim tail."""
    head = F.when(date_time, F.substring(text, 1, 8)).otherwise(text)
    parts = F.transform(F.split(head, "-"), lambda p: let(trimmed(p), lambda t: F.struct(t.alias("was"), _basic(t, days).alias("now"))))

    def combine(z):
        lost = F.exists(z, lambda p: (p["was"] != "") & (p["now"] == ""))
        no_end = (F.size(z) > 1) & (F.element_at(z, -1)["was"] == "") & (F.get(z, F.size(z) - 2)["was"] == "")
        return F.when(lost | no_end, "").otherwise(F.array_join(F.transform(z, lambda p: p["now"]), "-"))

    tail = F.when(date_time, F.substring(text, 9, 2147483647)).otherwise("")
    general = let(let(parts, combine), lambda s: F.when(s == "", "").otherwise(F.concat(s, tail)))
    # The usual plain date needs no lambda and stays inside code generation.
    iso = F.concat(F.substring(head, 1, 4), F.lit("-"), F.substring(head, 5, 2), F.lit("-"), F.substring(head, 7, 2))
    plain = F.translate(F.date_add(iso.try_cast("date"), days).cast("string"), "-", "")
    usual = F.when(F.length(plain) == 8, F.concat(plain, tail))
    return F.coalesce(F.when(head.rlike(r"\A[0-9]{8}\z"), usual).otherwise(general), F.lit(""))


def shift_da(value: ColumnOrName, days: int | Column) -> Column:
    """Shift one DA value or range (open ends kept); '' when it cannot be shifted to the day."""
    return _shift(trimmed(value), lit_or_col(days), F.lit(False))


def shift_dt(value: ColumnOrName, days: int | Column) -> Column:
    """Shift the first eight characters of a DT value, keep the tail verbatim; '' when impossible."""
    return _shift(trimmed(value), lit_or_col(days), F.lit(True))


def shift_in_range(days: ColumnOrName) -> Column:
    """True when the number of days is known and within +/-36500."""
    return F.coalesce(F.abs(col(days).cast("bigint")) <= MAX_DAYS, F.lit(False))


def shifted_values(values: ColumnOrName, vr: ColumnOrName, days: int | Column) -> Column:
    """Shift every value of a DA/DT element; other VRs, and a shift of NULL or 0, pass unchanged.

    A value that cannot be shifted becomes NULL; an element without any value left is empty.
    """
    v, n, date_time = col(values), lit_or_col(days), col(vr) == "DT"
    moved = F.transform(v, lambda one: let(trimmed(one), lambda t: F.nullif(_shift(t, n, date_time), F.lit(""))))
    none = F.array().cast("array<string>")
    kept = let(moved, lambda m: F.when(F.exists(m, lambda x: x.isNotNull()), m).otherwise(none))
    applies = col(vr).isin("DA", "DT") & (F.coalesce(n, F.lit(0)) != 0) & (F.size(v) > 0)
    return F.when(applies, kept).otherwise(v)
