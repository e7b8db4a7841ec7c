"""Feeds with their unreadable cells: the data, and a quarantine.

Each function returns the feed as its plain counterpart does, and the cells
that could not be read: ``feed, source_file, column_name, text, n``.  Both come from
one pass over the landed rows: ``cut`` writes the feed with the marked cells
(:func:`fundflow.functions.mark_rejects`) and reads it back, then it is split.
In the roll-ups the cells are grouped and counted with the sums, before the
shuffle; they count whether or not their line's key is a known award.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.config import DEFAULT, FlowConfig
from fundflow.functions import REJECT_COLUMNS
from fundflow.operators import KeySet, can_broadcast, combine_sums, numeric_columns, partial_sums, resolve_key
from fundflow.plans import feeds
from fundflow.plans.feeds import LEDGER_CANDIDATES, LEDGER_KEYS, SOURCE_FILE, TXN_CANDIDATES, TXN_KEYS, TXN_MEASURES, Cut

FILE, COLUMN, TEXT = REJECT_COLUMNS
#: Rows behind each row of a written roll-up.
LINES = "__lines"


def _is_cell() -> Column:
    return F.col(COLUMN).isNotNull()


def _split(written: DataFrame, feed: str, lines: str | None) -> tuple[DataFrame, DataFrame]:
    n = F.sum(lines) if lines else F.count(F.lit(1))
    cells = (written.filter(_is_cell()).groupBy(F.lit(feed).alias("feed"), F.col(FILE).alias("source_file"),
                                               F.col(COLUMN).alias("column_name"), F.col(TEXT).alias("text"))
             .agg(n.alias("n")))
    data = written.filter(~_is_cell()).drop(*REJECT_COLUMNS)
    return (data.drop(lines) if lines else data), cells


def active_awards(raw: DataFrame, cut: Cut, cfg: FlowConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """F1 and its unreadable cells."""
    return _split(cut(feeds.active_awards(raw, cfg, marked=True)), "active", None)


def plan(raw: DataFrame, cut: Cut, cfg: FlowConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """F4 and its unreadable cells."""
    return _split(cut(feeds.plan(raw, cfg, marked=True)), "plan", None)


def _rolled(lines: DataFrame, candidates, keys: list[str], measures: list[str], members: DataFrame | KeySet, strict: bool,
            cut: Cut) -> DataFrame:
    """Sums of ``measures`` by resolved key and ``keys``, marked cells apart:
    a cell's keys are blanked, so that equal cells of a file are one group."""
    blank = [c for c in dict.fromkeys([*candidates, *keys]) if c != SOURCE_FILE]
    lines = lines.withColumns({c: F.when(~_is_cell(), F.col(c)) for c in blank})
    # Lines meet a broadcast key set as they are; a shuffled one after pre-aggregation.
    per = [*keys, *REJECT_COLUMNS]
    if can_broadcast(members):
        lines = resolve_key(lines, members, candidates, always=_is_cell())
        sums = partial_sums(lines, per, measures, strict)
    else:
        pre = partial_sums(lines, list(dict.fromkeys([*candidates, *per])), measures, strict)
        sums = resolve_key(pre, members, candidates, cut=cut, always=_is_cell())
    return combine_sums(sums, per, measures, strict, rows=LINES)


def all_cells(cells: list[DataFrame]) -> DataFrame:
    """The quarantines of several feeds as one."""
    out = cells[0]
    for c in cells[1:]:
        out = out.unionByName(c)
    return out


def ledger(raw: DataFrame, all_keys: DataFrame | KeySet, cut: Cut, cfg: FlowConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """F5 and its unreadable cells."""
    lines = feeds.ledger_lines(raw, cfg, marked=True)
    keys = [*LEDGER_KEYS, *([SOURCE_FILE] if SOURCE_FILE in lines.columns else [])]
    measures = numeric_columns(lines, keys)
    rolled = _rolled(lines, LEDGER_CANDIDATES, keys, measures, all_keys, cfg.strict_ledger_sum, cut)
    data, cells = _split(cut(rolled), "ledger", LINES)
    return data.drop(SOURCE_FILE), cells


def transactions(raw: DataFrame, active_keys: DataFrame | KeySet, cut: Cut,
                 cfg: FlowConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """F6 and its unreadable cells."""
    lines = feeds.transaction_measures(raw, cfg, marked=True)
    rolled = _rolled(lines, TXN_CANDIDATES, list(TXN_KEYS), list(TXN_MEASURES), active_keys, False, cut)
    data, cells = _split(cut(rolled), "transactions", LINES)
    return feeds.with_fiscal(data), cells
