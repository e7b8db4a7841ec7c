"""Run configuration for the award-finance flow.

Everything a quarterly run can vary lives in :class:`FlowConfig`; the
functions in this package take it as an argument instead of reading
globals.  The defaults reproduce the source workflow.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the source workflow's constants for the
# outputs to match; they are stated here once, in their original order.
# ---------------------------------------------------------------------------

# Sector kept from the active / expired award extracts.
SECTOR = "IHO"

# Ledger obligation types kept.
EVENT_TYPE_FILTER = ("OBLG_UNI", "OBLG_SUBOB")

# Distribution codes kept in the ledger and the transaction extracts.
DISTRIBUTION_FILTER = ("656-M", "656-GH-M", "656-W", "656-GH-W")

# Activity-name fragments that exclude an active award (substring, case-sensitive).
REMOVE_AWARDS = ("MEL",)

# Bilateral agreement ids tagged "new" (unanchored regex match).
NEW_AGREEMENTS = (
    "656-DOAG-656-22-020-DRG",
    "656-DOAG-656-22-019-EDU",
    "656-DOAG-656-22-019-IH",
    "656-DOAG-656-22-021-NUT",
    "656-DOAG-656-22-020-EG",
    "656-DOAG-656-22-021-ENV",
    "656-DOAG-656-22-021-WASH",
)

# Program element -> program area code (unmatched elements keep the row's area).
ELEMENT_TO_AREA = (
    ("A047", "HL.1"),
    ("A048", "HL.2"),
    ("A049", "HL.3"),
    ("A050", "HL.4"),
    ("A051", "HL.5"),
    ("A052", "HL.6"),
    ("A053", "HL.7"),
    ("A054", "HL.8"),
    ("A142", "HL.9"),
    ("A141", "PO.2"),
    ("A140", "PO.1"),
)

# Program area code -> program area name.  The plan extract carries names and
# is mapped back to codes through the same pairs (unknown names -> NULL).
AREA_NAMES = (
    ("HL.1", "HIV/AIDS"),
    ("HL.6", "MCH"),
    ("HL.4", "GHS"),
    ("HL.9", "Nutrition"),
    ("HL.7", "FP/RH"),
    ("HL.2", "TB"),
    ("HL.3", "Malaria"),
    ("HL.8", "WASH"),
    ("PO.1", "PD&L"),
    ("DR.4", "Civil Society"),
    ("DR.6", "Human Rights"),
    ("DR.3", "Political Competition and Consensus-Building"),
)

# Value recodes on the award extracts (unmatched values pass through).
SUB_SECTOR_RECODE = (
    ("AFG", "HTHS"),
    ("PCMD", "Family Health"),
    ("FAMILY HEALTH", "Family Health"),
)
ORG_RECODE = (
    ("International", "US/Int'l"),
    ("US", "US/Int'l"),
)

# Header drift: an older header name and the current one.
PLAN_HEADER_DRIFT = (("unliquidated_obligations_beg_fy", "unliquidated_obligations_at_the_beginning_of_the_fy"),)
LEDGER_HEADER_DRIFT = (("last_qtr_adj_amt", "last_qtr_accrual_amt"),)

# Transaction event values behind the conditional measures.
DISBURSEMENT_EVENT = "DISB"
OBLIGATION_EVENT_TYPES = ("OBLG_SUBOB", "OBLG_UNI")

# Excel serial dates count days from this origin; the source subtracts one
# day before converting (so a quarter's first day lands in the prior quarter).
EXCEL_ORIGIN = "1899-12-30"
SERIAL_OFFSET_DAYS = -1

# Label of a transaction whose date is missing ("FY" + NA + "Q" + NA).
NULL_PERIOD_LABEL = "FYNAQNA"

# Marker values written by the coverage checks.
EXISTS_MARK = "exists"
YES_MARK = "yes"

# Program area singled out by the spotlight check.
SPOTLIGHT_AREA = "PO.2"

# Plan columns that arrive as text and are cast to numbers / dates.
PLAN_NUMERIC_COLUMNS = (
    "planned_subobligations_for_the_next_months",
    "total_obligations_this_fy",
    "projected_monthly_burn_rate",
    "un_sub_obligated_funds",
    "approved_budget_cop_op",
    "unliquidated_obligations_at_the_beginning_of_the_fy",
)
PLAN_DATE_COLUMN = "planned_sub_oblig_date"

# Ledger amount columns cast from text.
LEDGER_AMOUNT_COLUMNS = (
    "document_amt",
    "disbursement_amt",
    "undisbursed_amt",
    "last_qtr_accrual_amt",
    "pipeline_amt",
)

# Output column lists of the award extracts.
ACTIVE_COLUMNS = (
    "sub_sector", "activity_name", "award_number", "total_estimated_cost",
    "start_date", "end_date", "u_s_org_local", "aor_cor_or_activity_manager",
    "period", "funding_type", "pepfar_funding",
)
EXPIRED_COLUMNS = (
    "sector", "sub_sector", "activity_name", "award_number",
    "end_date", "u_s_org_local", "aor_cor_or_activity_manager",
    "period", "funding_type",
)
CLOSEOUT_COLUMNS = ("award_number", "to_be_deobligated", "status", "period")
LEDGER_COLUMNS = (
    "document_amt", "obligation_amt", "subobligation_amt", "disbursement_amt",
    "undisbursed_amt", "last_qtr_accrual_amt", "document_number",
    "program_area", "award_number", "program_element", "pipeline_amt",
    "bilateral_obl_number",
)
TXN_COLUMNS = (
    "award_number", "document_number", "obl_document_number",
    "transaction_date", "transaction_amt", "transaction_event",
    "transaction_event_type", "program_element", "distribution",
    "program_area",
)

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FlowConfig:
    """Parameters of one run.  Defaults reproduce the source workflow.

    ``active_sector`` / ``expired_sector`` are separate only so that one
    combined extract can feed both (the source filters both sheets on the
    same sector).
    """

    active_sector: str = SECTOR
    expired_sector: str = SECTOR
    event_types: tuple[str, ...] = EVENT_TYPE_FILTER
    distributions: tuple[str, ...] = DISTRIBUTION_FILTER
    remove_awards: tuple[str, ...] = REMOVE_AWARDS
    new_agreements: tuple[str, ...] = NEW_AGREEMENTS
    serial_offset_days: int = SERIAL_OFFSET_DAYS
    null_period_label: str | None = NULL_PERIOD_LABEL
    # Strict (NULL-poisoning) ledger sums as in the source; False sums leniently.
    strict_ledger_sum: bool = True
    spotlight_area: str = SPOTLIGHT_AREA
    # Amounts of the open-schema plan beyond PLAN_NUMERIC_COLUMNS.
    plan_extra_amounts: tuple[str, ...] = ()

    def with_sectors(self, active: str, expired: str) -> "FlowConfig":
        from dataclasses import replace

        return replace(self, active_sector=active, expired_sector=expired)


DEFAULT = FlowConfig()
