"""Date and fiscal-period column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundflow.config import EXCEL_ORIGIN, NULL_PERIOD_LABEL, SERIAL_OFFSET_DAYS
from fundflow.functions.text import text_to_number

# Year-month-day text: a four- or two-digit year, a month in digits or by its English name, a day; parts are set apart
# by any other characters, or written together in fixed width.  No text has both a month in digits and one by name.
_YMD_NUMBERS = (r"^[^0-9A-Za-z]*(\d{4}|\d{2})(?:(\d{2})(\d{2})|[^0-9A-Za-z]*(\d{1,2})[^0-9A-Za-z]+(\d{1,2}))"
                r"[^0-9A-Za-z]*$")
_YMD_NAMED = r"^[^0-9A-Za-z]*(\d{4}|\d{2})[^0-9A-Za-z]*([A-Za-z]{3,9})[^0-9A-Za-z]*(\d{1,2})[^0-9A-Za-z]*$"
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november",
          "december")
# Two-digit years up to 68 are 20yy, later ones 19yy.
_YEAR_20, _YEAR_19 = r"^([0-5]\d|6[0-8])-", r"^(69|[7-9]\d)-"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def parse_ymd(c, text: bool = True) -> Column:
    """Year-month-day text -> date; unparseable text (a time of day included)
    is NULL.  Two-digit years and English month names, short or full, are
    read.  Pass ``text=False`` for a column that is already a date or
    timestamp."""
    c = _col(c)
    if not text:
        return F.to_date(c)
    # Each step rewrites the text of the one before, so that none is evaluated twice: year-month-day, the year in four
    # digits; what does not end as such text is no date.  Only text with letters is looked through for a month name, and
    # the name is looked up, as a pattern a month would be tried on every row.
    months = F.create_map(*[F.lit(x) for i, full in enumerate(MONTHS, 1) for m in dict.fromkeys((full[:3], full))
                            for x in (m, f"{i:02d}")])
    month = F.element_at(months, F.lower(F.regexp_extract(c, _YMD_NAMED, 2)))
    named = F.replace(F.regexp_replace(c, _YMD_NAMED, "$1-#-$3"), F.lit("#"), month)
    numbers = F.regexp_replace(c, _YMD_NUMBERS, "$1-$2$4-$3$5")
    c = F.when(c.rlike("[A-Za-z]"), named).otherwise(numbers)
    c = F.regexp_replace(F.regexp_replace(c, _YEAR_20, "20$1-"), _YEAR_19, "19$1-")
    return F.regexp_extract(c, r"^\d{4}-\d{1,2}-\d{1,2}$", 0).try_cast("date")


def serial_to_date(c, offset_days: int = SERIAL_OFFSET_DAYS, text: bool = True) -> Column:
    """Excel day serial -> date.  The serial is shifted by ``offset_days``
    and floored before counting from 1899-12-30; bad text is NULL."""
    n = text_to_number(c) if text else _col(c).cast("double")
    days = F.floor(n + F.lit(float(offset_days))).cast("int")
    return F.date_add(F.lit(EXCEL_ORIGIN).cast("date"), days)


def quarter_start(d) -> Column:
    """First day of the calendar quarter."""
    return F.trunc(_col(d), "quarter")


def fiscal_period(d, null_label: str | None = NULL_PERIOD_LABEL) -> Column:
    """Calendar date -> fiscal label ``FY<yy>Q<q>`` (fiscal year starts in
    October).  ``yy`` is ``year % 100`` without padding; a NULL date gets
    ``null_label`` (the source pastes "NA" into the label)."""
    fd = F.add_months(_col(d), 3)
    label = F.concat(
        F.lit("FY"), (F.year(fd) % 100).cast("string"),
        F.lit("Q"), F.quarter(fd).cast("string"),
    )
    return label if null_label is None else F.coalesce(label, F.lit(null_label))


def parse_period(label) -> tuple[Column, Column]:
    """``FY<yy>Q<q>`` -> (fiscal_year = 2000 + yy, quarter).  Pieces that are
    not numbers (``FYNAQNA``) give NULL."""
    parts = F.split(_col(label), "Q")
    head = F.get(parts, 0)
    tail = F.get(parts, 1)
    yy = F.substring(head, 3, 2)
    fiscal_year = (text_to_number(yy) + F.lit(2000.0)).cast("int")
    quarter = text_to_number(tail).cast("int")
    return fiscal_year, quarter
