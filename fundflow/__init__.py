"""fundflow: award-finance analytics on Spark DataFrames.

Quarterly award extracts (active / expired awards, close-out tracker,
sub-obligation plans, an accounting ledger and raw transactions) are
cleaned, period-stamped, key-resolved and rolled up to award x fiscal
quarter x program area, then joined into reporting datasets and
reconciled.  Every step is a ``DataFrame -> DataFrame`` function:

* ``fundflow.plans.feeds``     -- feed normalisers (F1-F6)
* ``fundflow.plans.datasets``  -- reporting datasets (D0-D3)
* ``fundflow.plans.checks``    -- coverage and reconciliation checks (K1-K10)
* ``fundflow.plans.run``       -- one quarterly run from landing folders
* ``fundflow.streaming``       -- incremental pickup of new period files
"""

from fundflow.config import DEFAULT, FlowConfig

__all__ = ["DEFAULT", "FlowConfig", "run_quarter"]


def run_quarter(*args, **kwargs):
    """See :func:`fundflow.plans.run.run_quarter`."""
    from fundflow.plans.run import run_quarter as _run

    return _run(*args, **kwargs)
