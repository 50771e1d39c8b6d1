"""What a deployment configures: customers with rules of their own, labels and default codes."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

COMMERCIAL_GROUP = "COMERCIAL"


@dataclass(frozen=True)
class WarehouseConfig:
    corporate_cifs: tuple[str, ...]                          # tax ids of the corporate group
    commercial_customers: tuple[tuple[str, dt.date], ...]    # customer, commercial from this day on
    special_customers: tuple[str, ...]
    special_group: str
    corporate_group: str                                     # licences sold inside the corporate group
    default_group: str                                       # seller group when no rule holds
    manual_code: str                                         # catalogue code of lines without one
    agreement_code: str                                      # and of agreement invoices

    @property
    def direct_groups(self) -> tuple[str, ...]:
        return COMMERCIAL_GROUP, self.default_group, self.special_group
