"""Parameter values that suit the test tables (orders of 1992-1998, sites
``SITE000`` to ``SITE024``); the registered queries and their oracles use them."""

from __future__ import annotations

import datetime as dt

from ledgerline.plans.config import (
    AdjudicationConfig, CommissionConfig, ExtractConfig, ParamSelection,
)

COMMISSION = CommissionConfig(regular_until=dt.date(1997, 1, 1), bucket_from=dt.date(1997, 1, 2),
                              run_ts=dt.datetime(2026, 1, 1, 6, 0, 0))

EXTRACT = ExtractConfig(site_prefix="SITE", completed_from=dt.datetime(1995, 1, 1),
                        completed_to=dt.datetime(2001, 8, 1))
# lower-case prefix (case-insensitive LIKE) and its own end date
COUNTRY_EXTRACT = ExtractConfig(site_prefix="site", completed_from=dt.datetime(1995, 1, 1),
                                completed_to=dt.datetime(2001, 7, 31))

REPORT = AdjudicationConfig(
    start_date=dt.datetime(1995, 1, 1), end_date=dt.datetime(2001, 8, 1),
    sites=tuple(f"SITE{n:03d}-0000" for n in range(25)),
    batches=("1-URGENT", "2-high", "3-MEDIUM", "4-NOT SPECIFIED", "5-low "))

# the five market segments used as industries (mixed case on purpose: the
# comparison is case-insensitive)
PARAMS = ParamSelection(industries=("AUTOMOBILE", "building", "FURNITURE", "HOUSEHOLD", "Machinery"),
                        clients=tuple(f"GR{n:02d}-{m}" for n in range(25) for m in range(3)))
PARAM_HEADERS = ParamSelection(group_header=("GR07", "gr12-2", "GR20-0 "),
                               industries=("AUTOMOBILE", "BUILDING", "household"))

# contracts that the test tables break in places
STRICT_CONTRACTS = {
    "client_list": "industry varchar(8) not null, site_no varchar(10) not null, active int, company_name varchar(20) not null",
    "adjudication": "file_no string not null, req_status varchar(6), created_at timestamp_ntz not null",
}
