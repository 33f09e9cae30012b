"""Date extraction and choice (F2-F4) as built-in expressions.

F2 finds dates in a text with five patterns (applied in this order, matches
left to right) and normalises them: full dates to ``yyyy-MM-dd`` (numeric
forms parse year-first or day-first, with one consistent separator), a
month + year to ``yyyy-MM``, a bare year kept when within 1990-2030.
F3 keeps years and full dates whose year is within 1990..current+1 and picks
the lexicographic maximum (``yyyy-MM`` values never survive, as in the
reference).  ``current_year`` is a parameter so results are repeatable.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names and the year window.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December")
YEAR_MIN, YEAR_MAX = 1990, 2030
_MON = "|".join(MONTHS)
P_YMD = r"(?iuU)\b(\d{4}[-/]\d{1,2}[-/]\d{1,2})\b"
P_DMY = r"(?iuU)\b(\d{1,2}[-/]\d{1,2}[-/]\d{4})\b"
P_YEAR = r"(?iuU)\b(\d{4})\b"
P_MON_YEAR = rf"(?iuU)\b({_MON})\s+(\d{{4}})\b"
P_DAY_MON_YEAR = rf"(?iuU)\b(\d{{1,2}})\s+({_MON})\s+(\d{{4}})\b"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _month_num(name: Column) -> Column:
    m = F.create_map(*[F.lit(x) for i, n in enumerate(MONTHS, 1) for x in (n.lower(), str(i))])
    return m[F.lower(name)]


def _ymd(y: Column, m: Column, d: Column) -> Column:
    """``yyyy-MM-dd`` of a valid calendar date, else NULL (strptime rules)."""
    ok = (F.length(y) == 4) & m.rlike(r"^(1[0-2]|0[1-9]|[1-9])$") & \
        d.rlike(r"^(3[01]|[12]\d|0[1-9]|[1-9])$")
    dt = F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-M-d")
    return F.when(ok, F.date_format(dt, "yyyy-MM-dd"))


def extract_dates(text) -> Column:
    """normalised dates found in ``text`` (array<string>, pattern order)."""
    t = F.coalesce(_c(text), F.lit(""))

    def ymd(s):
        p = r"^(\d{4})([-/])(\d{1,2})([-/])(\d{1,2})$"
        return F.when(F.regexp_extract(s, p, 2) == F.regexp_extract(s, p, 4),
                      _ymd(F.regexp_extract(s, p, 1), F.regexp_extract(s, p, 3), F.regexp_extract(s, p, 5)))

    def dmy(s):
        p = r"^(\d{1,2})([-/])(\d{1,2})([-/])(\d{4})$"
        return F.when(F.regexp_extract(s, p, 2) == F.regexp_extract(s, p, 4),
                      _ymd(F.regexp_extract(s, p, 5), F.regexp_extract(s, p, 3), F.regexp_extract(s, p, 1)))

    def year(s):
        y = s.try_cast("int")
        return F.when((y >= YEAR_MIN) & (y <= YEAR_MAX), s)

    def mon_year(s):
        p = rf"(?iuU)^({_MON})\s+(\d{{4}})$"
        return F.concat(F.regexp_extract(s, p, 2), F.lit("-"),
                        F.lpad(_month_num(F.regexp_extract(s, p, 1)), 2, "0"))

    def day_mon_year(s):
        p = rf"(?iuU)^(\d{{1,2}})\s+({_MON})\s+(\d{{4}})$"
        return _ymd(F.regexp_extract(s, p, 3), _month_num(F.regexp_extract(s, p, 2)),
                    F.regexp_extract(s, p, 1))

    parts = [
        F.transform(F.regexp_extract_all(t, F.lit(P_YMD), F.lit(1)), ymd),
        F.transform(F.regexp_extract_all(t, F.lit(P_DMY), F.lit(1)), dmy),
        F.transform(F.regexp_extract_all(t, F.lit(P_YEAR), F.lit(1)), year),
        F.transform(F.regexp_extract_all(t, F.lit(P_MON_YEAR), F.lit(0)), mon_year),
        F.transform(F.regexp_extract_all(t, F.lit(P_DAY_MON_YEAR), F.lit(0)), day_mon_year),
    ]
    return F.filter(F.concat(*parts), lambda x: x.isNotNull())


def extract_dates_all(texts) -> Column:
    """F2 over an array of texts (title, description, metas, ...), in order."""
    return F.flatten(F.transform(F.coalesce(_c(texts), F.array()), lambda t: extract_dates(t)))


def pick_date(dates, current_year: int | None = None) -> Column:
    """lexicographic max of years / full dates within 1990..current+1; NULL if none."""
    cy = current_year if current_year is not None else _dt.date.today().year
    hi = cy + 1

    def ok(x):
        y = F.substring(x, 1, 4).try_cast("int")
        return ((F.length(x) == 4) | x.rlike(r"^\d{4}-\d{2}-\d{2}$")) & (y >= YEAR_MIN) & (y <= hi)

    return F.array_max(F.filter(_c(dates), ok))


def iso_now() -> Column:
    """ISO-8601 UTC text of now, whole seconds."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def epoch_now() -> Column:
    return F.unix_timestamp(F.current_timestamp())
