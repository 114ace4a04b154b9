"""Parameters of a run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from tenorbook import fixed_values


#: Type of a staged rate.
RATE_TYPE = "decimal(12,6)"


@dataclass(frozen=True)
class Config:
    """Calendar bounds, as-of months and business rules of one run.

    The defaults describe the two financial years from April 2023 to March 2025.
    """

    calendar_start: dt.date = dt.date(2023, 4, 1)
    calendar_end: dt.date = dt.date(2025, 3, 31)
    as_of_start: dt.date = dt.date(2023, 4, 1)
    as_of_months: int = 24
    fiscal_start_month: int = 4
    active_status: str = "VALIDATED"
    sight_type: str = "SIGHT_DEP"
    rate_type: str = RATE_TYPE
    #: Round rates with more places than rate_type instead of failing.
    round_rates: bool = False
    bucket_edges: tuple[tuple[int, str], ...] = fixed_values.BUCKET_EDGES
    sight_bucket: str = fixed_values.SIGHT_BUCKET
    #: Label beyond the last edge; to be given with edges of one's own.
    last_bucket: str | None = None

    def __post_init__(self) -> None:
        if self.calendar_end < self.calendar_start:
            raise ValueError("calendar_end lies before calendar_start")
        if self.as_of_months < 1:
            raise ValueError("as_of_months must be at least 1")
        if not 1 <= self.fiscal_start_month <= 12:
            raise ValueError("fiscal_start_month must be a month number")
        edges = [days for days, _ in self.bucket_edges]
        if edges != sorted(set(edges)):
            raise ValueError("bucket_edges must rise strictly")
        if self.last_bucket is None:
            if self.bucket_edges != fixed_values.BUCKET_EDGES:
                raise ValueError("bucket_edges need a last_bucket")
            object.__setattr__(self, "last_bucket", fixed_values.LAST_BUCKET)
