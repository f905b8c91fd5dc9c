"""Column names, label domains and thresholds of the holdings panel."""

from __future__ import annotations

from dataclasses import dataclass

FUND, MANAGER, ASSET, ASSET_ID, AS_AT = "fund_id", "manager_id", "source_asset", "source_asset_id", "as_at_date"
STATUS = "deal_status"

# Fields scored as mandatory, in the order in which ties are broken.
MANDATORY = ["capital_invested", "current_cost", "unrealized_value", "realized_proceeds", "deal_status", "sector", "geographic_focus"]
FINANCIAL = ["capital_invested", "current_cost", "unrealized_value", "realized_proceeds"]
CHECKED = ["capital_invested", "current_cost", "deal_status", "sector", "geographic_focus"]
CLASSES = ["balance_sheet", "accounting_entry", "subtotal", "unnamed_aggregate", "holding"]
STATUSES = ["Written Off", "Written Down", "Partially Exited, Remainder Written Down", "Partially Exited", "Current", "Fully Exited"]
UNCLASSIFIABLE = "Unclassifiable"

# Which financial fields a status is expected to fill (1) or not (0); the last row holds for any other status.
EXPECTED = {
    "Current": (1, 1, 1, 0),
    "Partially Exited": (1, 1, 1, 1),
    "Partially Exited, Remainder Written Down": (1, 1, 1, 1),
    "Written Down": (1, 1, 1, 1),
    "Written Off": (1, 0, 1, 1),
    "Fully Exited": (1, 0, 0, 0),
    "": (1, 1, 1, 0),
}
# Order of the statuses over the life of a position.
STATUS_RANK = {"Current": 0, "Partially Exited": 1, "Written Down": 1, "Partially Exited, Remainder Written Down": 2, "Fully Exited": 3, "Written Off": 3}


@dataclass(frozen=True)
class Params:
    min_rows: int = 10  # groups below are reported, never ranked
    min_rows_geography: int = 100
    fill_threshold: float = 0.85
    full: float = 0.999
    tolerance: float = 0.01
    eps: float = 1.0  # what counts as zero in the consistency rules
    block: int = 4  # letters of the blocking key
    similarity: float = 88.0


DEFAULTS = Params()
