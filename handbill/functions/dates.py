"""Dates and times: reading them from texts, and windows around a day. The current day is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, filled, group, nonempty

#: An ISO date, a German one, a day with the name of a month, a time of day.
ISO = r"(?U)\b(\d{4}-\d{2}-\d{2})\b"
GERMAN = r"(?U)\b(\d{1,2})\.\s?(\d{1,2})\.\s?(\d{2,4})\b"
TEXTUAL = (
    r"(?iU)\b(\d{1,2})\.?\s*"
    r"(Jan(?:uar)?|Feb(?:ruar)?|M(?:ä|ae)r(?:z)?|Apr(?:il)?|Mai|Jun(?:i)?|Jul(?:i)?|Aug(?:ust)?|Sep(?:t(?:ember)?)?|Okt(?:ober)?|Nov(?:ember)?|Dez(?:ember)?"
    r"|January|February|March|April|May|June|July|August|September|October|November|December)"
    r"\.?\s*(?:(\d{4})(?!\d))?\b"
)
TIME = r"(?U)\b(\d{1,2}[:.]\d{2})\s*(?:Uhr|h)?\b"
#: How the names of months begin, in either language.
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "mär": 3, "mae": 3, "apr": 4, "mai": 5, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "okt": 10, "oct": 10, "nov": 11, "dez": 12, "dec": 12,
}


def day(as_of: Column | str) -> Column:
    """A day given as text or date."""
    return F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of.cast("date")


def shown(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def month_number(name: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in MONTHS.items() for x in pair))
    return F.try_element_at(known, F.left(F.lower(name), F.lit(3)))


def _textual(text: Column, today: Column) -> Column:
    d, m, y = group(text, TEXTUAL, 1), month_number(F.regexp_extract(text, TEXTUAL, 2)), group(text, TEXTUAL, 3)

    def on(year: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", year.cast("string"), m.cast("string"), F.ltrim(d, F.lit("0"))), "y-M-d")

    this = on(F.year(today))
    return F.when(m.isNull() | d.isNull(), None).when(y.isNotNull(), on(y.cast("int"))).otherwise(F.when(this < F.date_sub(today, 31), on(F.year(today) + 1)).otherwise(this))


def parse_date(text: Column | str, as_of: Column | str) -> Column:
    """The first ISO date, else the first German one (not checked against the calendar), else a day with a month's name, which without a year
    lies at most 31 days back; else the current day."""
    t, today = col(text), day(as_of)
    d, m, y = (group(t, GERMAN, n) for n in (1, 2, 3))
    year = F.when(y.cast("int") < 100, y.cast("int") + 2000).otherwise(y.cast("int"))
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    german = F.when(d.isNotNull(), F.concat_ws("-", pad(year, 4), pad(m.cast("int"), 2), pad(d.cast("int"), 2)))
    return F.coalesce(group(t, ISO), german, shown(_textual(t, today)), shown(today))


def parse_meetup_date(text: Column | str, as_of: Column | str) -> Column:
    """The whole text as one of four formats, else the current day."""
    t = col(text)
    formats = ((r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"), (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "MMMM d, yyyy"), (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"), (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"))
    return shown(F.coalesce(*(F.when(t.rlike(shape), F.try_to_date(t, form)) for shape, form in formats), day(as_of)))


def parse_time(text: Column | str) -> Column:
    """The first H:MM or H.MM, with a colon; empty if there is none."""
    return F.replace(F.regexp_extract(col(text), TIME, 1), F.lit("."), F.lit(":"))


def parse_clock(text: Column | str) -> Column:
    """The first H:MM with its AM or PM as written; empty if there is none."""
    pattern = r"(?i)(\d{1,2}:\d{2})\s*(AM|PM)?"
    return F.trim(F.concat_ws(" ", F.regexp_extract(col(text), pattern, 1), F.regexp_extract(col(text), pattern, 2)))


def event_date(date: Column | str) -> Column:
    """A listing's date where its text is one."""
    return F.try_to_date(col(date), "yyyy-MM-dd")


def next_week(as_of: Column | str) -> tuple[Column, Column]:
    """The next Monday, seven days ahead on a Monday, and its Sunday."""
    monday = F.next_day(day(as_of), "MON")
    return monday, F.date_add(monday, 6)


def current_week(as_of: Column | str) -> tuple[Column, Column]:
    """The Sunday on or before a day and its Saturday."""
    sunday = F.date_sub(day(as_of), F.dayofweek(day(as_of)) - 1)
    return sunday, F.date_add(sunday, 6)


#: Where the cycle of 14 days starts, and the two arrays of day names, which disagree.
CYCLE_START, CYCLE_DAYS = "2024-01-06", 14
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
NEXT_DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def cycle_day(as_of: Column | str) -> Column:
    return F.pmod(F.datediff(day(as_of), F.to_date(F.lit(CYCLE_START))), F.lit(CYCLE_DAYS))


def cycle_day_name(n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), (n % 7 + 1).cast("int"))


def next_cycle_day_name(n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, NEXT_DAY_NAMES)), (F.pmod(n + 1, F.lit(CYCLE_DAYS)) % 7 + 1).cast("int"))


def date_time(date: Column | str, time: Column | str) -> Column:
    """A date with its time, if there is one."""
    return F.concat_ws(" ", filled(date), nonempty(time))
