"""Column expressions shared by the measures; built-in functions only."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, functions as F

from .search import count_up_to

PLACEHOLDERS = ("", ".", "..", "...")


def ci(col: Column | str) -> Column:
    """Comparison key of a case-insensitive, blank-padded source string."""
    return F.lower(F.rtrim(_c(col)))


def is_any(col: Column | str, values: Iterable[str]) -> Column:
    return ci(col).isin([v.rstrip().lower() for v in values])


def like(col: Column | str, pattern: str) -> Column:
    """Case-insensitive LIKE; prefix and contains patterns become StartsWith / Contains."""
    return F.lower(_c(col)).like(pattern.lower())


def like_any(col: Column | str, patterns: Iterable[str]) -> Column:
    """Any of the LIKE patterns, read in one pass: wildcard-free ones as a list, the rest as
    one regular expression."""
    patterns = [p.lower() for p in patterns]
    wild = [p for p in patterns if "%" in p or "_" in p]
    plain = [p for p in patterns if p not in wild]
    out = F.lower(_c(col)).isin(plain) if plain else F.lit(False)
    if len(wild) == 1:
        return out | like(col, wild[0])
    if wild:
        parts = ("".join({"%": ".*", "_": "."}.get(c) or re.escape(c) for c in p) for p in wild)
        out = out | F.lower(_c(col)).rlike("(?s)^(?:" + "|".join(parts) + ")$")
    return out


def not_like_all(col: Column | str, patterns: Iterable[str]) -> Column:
    """None of the LIKE patterns; unknown, hence dropped by a filter, for NULL."""
    return ~like_any(col, patterns) & _c(col).isNotNull()


def within(ts: Column | str, start: date, end: date) -> Column:
    """Day of ``ts`` in [start, end], as a half-open range the scan can be filtered with."""
    return (_c(ts) >= F.lit(start)) & (_c(ts) < F.lit(end + timedelta(days=1)))


def day(ts: Column | str) -> Column:
    return _c(ts).cast("date")


def us_date(col: Column | str) -> Column:
    return F.date_format(_c(col), "MM/dd/yyyy")


def or_blank(col: Column | str) -> Column:
    return F.coalesce(_c(col).cast("string"), F.lit(""))


def yes_no(cond: Column) -> Column:
    """'Y' when true, 'N' when false or unknown."""
    return F.when(cond, "Y").otherwise("N")


def flag(cond: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.when(cond, 1).otherwise(0)


def try_int(col: Column | str) -> Column:
    """Whole number or NULL; unlike a plain cast '' and '3.5' are no numbers."""
    return F.when(F.trim(_c(col)).rlike("^[+-]?[0-9]+$"), _c(col).try_cast("int"))


def try_date(col: Column | str) -> Column:
    return _c(col).try_cast("date")


def clean_value(col: Column | str, cast: str | None = None,
                placeholders: Iterable[str] = PLACEHOLDERS) -> Column:
    """Trimmed text, NULL for placeholder dots and blanks, optionally parsed."""
    text = F.trim(_c(col))
    kept = F.when(~text.isin(list(placeholders)), text)
    if cast is None:
        return kept
    return try_int(kept) if cast == "int" else kept.try_cast(cast)


def leading_score(col: Column | str) -> Column:
    """Score text: the first two characters if they are a number, else the first one."""
    two = F.substring(_c(col), 1, 2)
    return F.when(try_int(two).isNotNull(), two).otherwise(F.substring(_c(col), 1, 1))


def business_day_diff(d1: Column | str, d2: Column | str, holidays: Iterable[date] = ()) -> Column:
    """Monday-to-Friday days in (d1, d2], negative when d2 is earlier, NULL on NULL.

    Closed form: with f(d) the working days up to d since a fixed Monday, f(d2) - f(d1). Holidays
    on such days are a sorted array; those up to d are counted by binary search, twice a row
    however long the calendar is.
    """
    d1, d2 = _c(d1), _c(d2)

    def upto(d: Column) -> Column:
        n = F.unix_date(d.cast("date")) + F.lit(3)
        whole = F.floor(n / F.lit(7)).cast("int") * F.lit(5)
        working = whole + F.least(F.pmod(n, F.lit(7)) + F.lit(1), F.lit(5))
        return working - count_up_to(calendar, F.unix_date(d.cast("date"))) if off else working

    # Day numbers as one text literal: the plan holds a single value, not a literal for each day.
    off = sorted({(h - date(1970, 1, 1)).days for h in holidays if h.weekday() < 5})
    calendar = F.split(F.lit(",".join(map(str, off))), ",").cast("array<int>")
    return (upto(d2) - upto(d1)).cast("int")


def minute_diff(a: Column | str, b: Column | str) -> Column:
    """Minute boundaries crossed from a to b: 10:00:59 to 10:01:00 is 1."""
    a, b = _c(a), _c(b)

    def of_day(t: Column) -> Column:
        return F.hour(t) * F.lit(60) + F.minute(t)

    return (F.datediff(b, a) * F.lit(1440) + of_day(b) - of_day(a)).cast("int")


def age_years(birth: Column | str, as_of: date) -> Column:
    """Whole 8766-hour years from birth to midnight of ``as_of``, cut toward zero: 0 for a birth in the year after it."""
    hours = F.datediff(F.lit(as_of), _c(birth)) * F.lit(24)
    return (hours / F.lit(8766)).cast("int")


def age_months(birth: Column | str, as_of: date) -> Column:
    return F.floor(F.months_between(F.lit(as_of), _c(birth))).cast("int")


def age_band(age: Column | str, otherwise: str | None = None) -> Column:
    a = _c(age)
    return (F.when(a.between(0, 5), "A. 0 to 5").when(a.between(6, 13), "B. 6 to 13")
            .when(a.between(14, 21), "C. 14 to 21").when(a >= 22, "D. 22 and Up")
            .otherwise(F.lit(otherwise)))


def label_map(col: Column | str, mapping: dict[str, str], null_label: str = "") -> Column:
    """Short name of a code; codes without a short name stay as they are."""
    out = F.when(_c(col).isNull(), F.lit(null_label))
    for code, label in mapping.items():
        out = out.when(ci(col) == code.lower(), F.lit(label))
    return out.otherwise(_c(col))


def newer_of(a_day: Column, a: Column, b_day: Column, b: Column) -> Column:
    """Value of the later day; ``a`` wins a tie and whichever is present wins over none."""
    return (F.when(a.isNotNull() & b.isNotNull(), F.when(a_day >= b_day, a).otherwise(b))
            .when(a.isNotNull(), a).otherwise(b))


def first_present(cols: Iterable[Column | str], derive=lambda c: c) -> Column:
    """Derivation of the first column that is not NULL."""
    out = None
    for c in cols:
        c = _c(c)
        out = F.when(c.isNotNull(), derive(c)) if out is None else out.when(c.isNotNull(), derive(c))
    return out


def classify_status(status: Column | str, cancelled_by: Column | str, disposition: Column | str,
                    portal_user: int) -> Column:
    """Display text of an appointment status; unknown statuses pass through."""
    s, by, disp = ci(status), _c(cancelled_by), _c(disposition)
    cancelled = s == "cancelled"
    return (F.when(cancelled & ((by == portal_user) | (disp == 2)), "Cancelled by Patient")
            .when(cancelled & ((by != portal_user) | (disp == 3)), "Cancelled by Doctor")
            .when(s == "booked", "Booked").when(s == "no show", "No Show")
            .when(s == "appt kept", "Appt Kept").when(s == "admitted", "Admitted")
            .otherwise(_c(status)))


def _under(age: Column, no_dm_ckd: Column, systolic: Column, diastolic: Column) -> Column:
    """Age 60 and over without diabetes or kidney disease may reach 150, others 140."""
    limit = F.when((age >= 60) & no_dm_ckd, 150).otherwise(140)
    return (age >= 18) & (systolic < limit) & (diastolic < 90)


def bp_first_controlled(age: Column, no_dm_ckd: Column, systolic: Column, diastolic: Column) -> Column:
    return F.coalesce(_under(age, no_dm_ckd, try_int(systolic), try_int(diastolic)), F.lit(False))


def bp_final_controlled(age: Column, no_dm_ckd: Column, first_ok: Column, systolic: Column,
                        diastolic: Column) -> Column:
    """The second reading decides when both its values are there and not zero.

    With no second value at all the first reading stands. With only one of the two the
    comparison is unknown and the result is not controlled.
    """
    s, d = try_int(systolic), try_int(diastolic)
    no_s, no_d = s.isNull() | (s == 0), d.isNull() | (d == 0)
    return (F.when(no_s & no_d, first_ok).when(no_s | no_d, False)
            .otherwise(F.coalesce(_under(age, no_dm_ckd, s, d), F.lit(False))))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
