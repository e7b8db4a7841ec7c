"""Column-expression builders (all JVM-side, no Python UDFs)."""

from fundflow.functions.codes import area_code_from_name, area_from_element, area_name, lookup
from fundflow.functions.dates import fiscal_period, parse_period, parse_ymd, quarter_start, serial_to_date
from fundflow.functions.rejects import REJECT_COLUMNS, mark_rejects
from fundflow.functions.text import (
    as_number,
    matches_any,
    period_from_filename,
    recode,
    text_to_number,
    trim_ws,
)

__all__ = [
    "REJECT_COLUMNS",
    "area_code_from_name",
    "area_from_element",
    "area_name",
    "as_number",
    "fiscal_period",
    "lookup",
    "mark_rejects",
    "matches_any",
    "parse_period",
    "parse_ymd",
    "period_from_filename",
    "quarter_start",
    "recode",
    "serial_to_date",
    "text_to_number",
    "trim_ws",
]
