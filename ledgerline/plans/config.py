"""Job parameters (the procedure / report parameters of the source scripts),
with the source's own values as defaults. The registered queries run on the
test tables and take their values from ``ledgerline.plans.fixture``."""

from __future__ import annotations

import dataclasses
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class CommissionConfig:
    """Commission job: package key, client start-date cut-offs, load time."""

    package_key: int = 1
    # clients started on or before this day use the regular band card
    regular_until: dt.date = dt.date(2016, 3, 31)
    # clients started on or after this day use the new-business buckets
    bucket_from: dt.date = dt.date(2016, 4, 1)
    # load timestamp recorded on the report rows; None: the clock (UTC) of the run
    run_ts: dt.datetime | None = None

    def started(self) -> CommissionConfig:
        """The same configuration with its load time fixed."""
        if self.run_ts is not None:
            return self
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        return dataclasses.replace(self, run_ts=now)


@dataclass(frozen=True)
class ExtractConfig:
    """File-component extract filters."""

    site_prefix: str = "APPL416"
    completed_from: dt.datetime = dt.datetime(2017, 1, 1)
    completed_to: dt.datetime = dt.datetime(2019, 4, 1)
    status: str = "closed"


# the country variant has its own site and end date
COUNTRY_EXTRACT = ExtractConfig(site_prefix="BCVD001", completed_to=dt.datetime(2019, 3, 31))


@dataclass(frozen=True)
class AdjudicationConfig:
    """Start / end date, site list and batch list of the report dataset.

    ``None`` for a list means "parameter not set": with ``strict_null`` the
    ``IN (NULL)`` filter keeps nothing (the literal reading), otherwise the
    filter is skipped. A list is a tuple of values or a relation with them in
    its first column (any number of rows).
    """

    start_date: dt.datetime = dt.datetime(2017, 5, 1)
    end_date: dt.datetime = dt.datetime(2017, 5, 15)
    sites: tuple[str, ...] | DataFrame | None = ("SPRI001-0000",)
    batches: tuple[str, ...] | DataFrame | None = None
    status: str = "CLOSED"
    strict_null: bool = False


@dataclass(frozen=True)
class ParamSelection:
    """Cascading report parameters industry -> group header / groups ->
    corp ids. ``group_header=None`` is the 'ALL' case; the lists are what the
    user has chosen so far, as values or as relations."""

    industries: tuple[str, ...] | DataFrame = ()
    group_header: tuple[str, ...] | None = None
    clients: tuple[str, ...] | DataFrame = ()
    corp_ids: tuple[str, ...] | DataFrame = (" All",)
