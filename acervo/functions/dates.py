"""Date expressions: every result is an ISO date text or a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions.text import let


def _month(name: Column, table: dict[str, int]) -> Column:
    lookup = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(lookup, F.lower(name))


def _real_date(year: Column, month: Column, day: Column) -> Column:
    """ISO text of a real calendar date, else null."""
    text = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day, 2, "0"))
    return F.when((year != "") & month.isNotNull(), let(
        text, lambda t: F.when(t.try_cast("date").isNotNull(), t)))


def _read(text: Column, pattern: str, build) -> Column:
    """`build(g1, g2, g3)` over the groups of the first match; the text is scanned once."""
    def groups(found: Column) -> Column:
        parts = F.array(*[F.regexp_extract(found, pattern, i) for i in (1, 2, 3)])
        return F.when(found != "", let(parts, lambda g: build(F.get(g, F.lit(0)), F.get(g, F.lit(1)), F.get(g, F.lit(2)))))

    return let(F.regexp_extract(text, pattern, 0), groups)


def br_date(text: Column, label: str | None = None) -> Column:
    """First `DD/MM/YYYY`, after a label if one is given."""
    prefix = f"{label}\\s*:?\\s*" if label else ""
    return _read(text, prefix + r"(\d{2})/(\d{2})/(\d{4})", lambda d, m, y: _real_date(y, m, d))


def loose_br_date(text: Column) -> Column:
    """One- or two-digit day, two- or four-digit year (20YY)."""
    return _read(text, r"(\d{1,2})/(\d{2})/(\d{4}|\d{2})(?!\d)", lambda d, m, y: _real_date(
        F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y), m, d))


def br_datetime(text: Column) -> Column:
    """`DD/MM/YY, HH:MM`."""
    return _read(text, r"(\d{2})/(\d{2})/(\d{2}),\s*\d{2}:\d{2}",
                 lambda d, m, y: _real_date(F.concat(F.lit("20"), y), m, d))


def us_date(text: Column) -> Column:
    return _read(text, r"(\d{2})/(\d{2})/(\d{4})", lambda m, d, y: _real_date(y, m, d))


def long_pt_date(text: Column) -> Column:
    """`D de MÊS de YYYY`."""
    return _read(text, r"(?U)(\d{1,2}) de (\w+) de (\d{4})", lambda d, m, y: _real_date(y, _month(m, P.MONTHS_PT), d))


def month_first_pt_date(text: Column) -> Column:
    """`MÊS D, YYYY`."""
    return _read(text, r"(?U)(\w+) (\d{1,2}), (\d{4})", lambda m, d, y: _real_date(y, _month(m, P.MONTHS_PT), d))


def short_month_date(text: Column) -> Column:
    """`Mon DD, YYYY`, else `DD Mon YYYY`; Portuguese or English, first three letters count.

    The second form is tried only where the first one does not occur.
    """
    first, second = r"(?U)(\w{3,})\s+(\d{1,2}),\s*(\d{4})", r"(?U)(\d{1,2})\s+(\w{3,})\s+(\d{4})"

    def short(name: Column) -> Column:
        return _month(F.substring(F.lower(name), 1, 3), P.MONTHS_SHORT)

    return F.when(text.rlike(first), _read(text, first, lambda m, d, y: _real_date(y, short(m), d))).otherwise(
        _read(text, second, lambda d, m, y: _real_date(y, short(m), d)))


def day_month_comma_date(text: Column) -> Column:
    """`DD Mon, YYYY`, English."""
    return _read(text, r"(?U)(\d{1,2}) (\w{3}), (\d{4})", lambda d, m, y: _real_date(y, _month(m, P.MONTHS_SHORT), d))


def iso_slice(text: Column) -> Column:
    return F.when(text != "", F.substring(text, 1, 10))


def rfc2822_date(text: Column, fallback: Column) -> Column:
    """ISO date of an RFC 2822 stamp in its own zone; `fallback` where it cannot be read."""
    pattern = (r"^\s*(?:[A-Za-z]{3},\s*)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4})\s+\d{2}:\d{2}(?::\d{2})?"
               r"\s+(?:[+-]\d{4}|[A-Z]{1,5})\s*$")
    return F.coalesce(_read(text, pattern, lambda d, m, y: _real_date(y, _month(m, P.MONTHS_SHORT), d)), fallback)


def underscore_file_date(name: Column) -> Column:
    """`…DD_MM_YYYY.pdf`."""
    return _read(name, r"(\d{2})_(\d{2})_(\d{4})\.pdf$", lambda d, m, y: _real_date(y, m, d))


def dotted_edition_dates(text: Column) -> Column:
    """All full-edition file names `YYYY.MM.DD.DOE_0.pdf` in a text."""
    return F.regexp_extract_all(text, F.lit(r"\d{4}\.\d{2}\.\d{2}\.DOE_0\.pdf"), F.lit(0))


def dotted_file_date(name: Column) -> Column:
    return _read(name, r"(\d{4})\.(\d{2})\.(\d{2})\.DOE_0\.pdf$", lambda y, m, d: _real_date(y, m, d))


def reference_date(published: Column, date: Column, captured: Column) -> Column:
    """Publication date, else date, else capture date; first ten characters, must parse."""
    candidate = F.coalesce(_non_blank(published), _non_blank(date))
    return F.coalesce(F.try_to_date(F.substring(candidate, 1, 10), "yyyy-MM-dd"), captured)


def captured_date(listing: Column, page: Column, has_page_rule: Column, as_of: Column,
                  strict: bool = False) -> Column:
    """Date written on capture. `strict` lets an empty page date replace the listing's."""
    if strict:
        return F.coalesce(F.when(has_page_rule, page).otherwise(listing), as_of)
    return F.coalesce(F.when(has_page_rule, page), listing, as_of)


def display_time(value: Column) -> Column:
    return F.coalesce(F.date_format(value, "dd/MM/yyyy HH:mm"), F.lit("nunca rodou"))


def long_english_day(day: Column) -> Column:
    return F.date_format(day, "MMMM d, yyyy")


def within_hours(published: Column, as_of: Column, hours: int = P.FEED_WINDOW_HOURS) -> Column:
    """Fresh enough; a missing publication time is kept."""
    return published.isNull() | (published >= as_of - F.expr(f"INTERVAL {hours} HOURS"))


def _non_blank(text: Column) -> Column:
    return F.when(text != "", text)
