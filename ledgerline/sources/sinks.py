"""Staging tables and the report-table sink.

Intermediate tables that several later steps read (the per-file fact grain,
the staging table of the commission procedure) are written once as parquet
under the cluster's shared checkpoint folder and read back. That both avoids
recomputing them per reader and cuts their lineage, so a lost executor only
recomputes from the last written table, never from the raw scan.
"""

from __future__ import annotations

import os
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir, sized_shuffles
from ledgerline.sources.contracts import enforced

# Display headings of the report table (snake_case inside, headings at the
# edge), in target order.
REPORT_HEADINGS = {
    "client_key": "ClientKey", "company_name": "CompanyName", "site_number": "SiteNumber",
    "actual_amount": "ActualAmount", "fees_amount": "FeesAmount",
    "miscellaneous_fee": "MiscellaneousFee", "bad_debt_amount": "BadDebtAmount",
    "adjustment_amount": "AdjustmentAmount", "commissionable_amount": "CommissionableAmount",
    "amount_payable_percentage": "AmountPayablePercentage",
    "commission_to_be_paid": "CommissionToBePaid", "commission_type": "CommissionType",
    "account_executive": "AccountExecutive", "billing_date_key": "BillingDateKey",
    "account_aging_in_days": "AccountAgingInDays", "business_start_date": "BusinessStartDate",
    "yr1_rate": "Yr1Rate", "yr2_rate": "Yr2Rate", "yr3_rate": "Yr3Rate",
    "perpetual_rate": "PerpetualRate", "audit_inserted_package_key": "AuditInsertedPackageKey",
    "audit_inserted_date": "AuditInsertedDate",
}


# Display headings of the extract, report-dataset and
# parameter-list outputs (snake_case column -> heading), in output order.
EXTRACT_HEADINGS = {
    "site": "Site", "file_number": "File Number",
    "applicant_first_name": "Applicant First Name", "applicant_last_name": "Applicant Last Name",
    "file_request_date": "File Request Date", "file_completed_date": "File Completed Date",
    "component": "Component", "component_completion_date": "Component Completion Date",
    "component_price": "Component Price", "component_type": "Component Type",
    "component_country": "Component Country",
}
REPORT_DATASET_HEADINGS = {
    "site_no": "Site#", "batch_no": "Batchno", "file_no": "File#", "first_name": "First Name",
    "last_name": "Last Name", "date_requested": "Date Requested",
    "date_completed": "Date Completed", "requester": "Requestor", "file_status": "File Status",
    "package": "Package", "applicant_email": "Applicant Email", "fee_total": "Fee Total",
    "service_total": "Service Total", "total_file_cost": "Total File Cost",
    "original_adj": "Original Adj.", "flag_description": "flagdescription",
    "current_adj_date": "Current Adj. Date", "employee_id": "Employee ID",
    "troubled_file": "Troubled File?",
}
PARAM_HEADINGS = {
    "industry": "Industry", "industry_key": "IndustryKey", "client": "Client",
    "group_key": "GroupKey", "corp_id": "CorpID", "site_name": "SiteName",
    "client_key": "ClientKey",
}


def run_folder(spark: SparkSession, job: str) -> str:
    """A fresh folder for one job run under the shared checkpoint folder. Jobs
    drop theirs (``drop_folder``) when what reads it has been written."""
    return os.path.join(checkpoint_dir(spark), f"{job}-{uuid.uuid4().hex[:12]}")


def stage_table(df: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` once as parquet (``SELECT ... INTO #temp``) and return a
    fresh scan of it. Column limits are enforced and stay with the table
    (``contracts``). ``partitions`` optionally evens out the file count. The
    write's shuffles are sized by its input (``sized_shuffles``)."""
    out = enforced(df if partitions is None else df.repartition(partitions))
    with sized_shuffles(out):
        out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def with_display_names(df: DataFrame, headings: dict[str, str] = REPORT_HEADINGS) -> DataFrame:
    """Rename snake_case columns to their display headings (at the sink only;
    a heading with a dot must be back-quoted when read back in Spark)."""
    return df.select(*[F.col(c).alias(headings.get(c, c)) for c in df.columns])


_POINTER = "_CURRENT-"
_CLAIM = "_CLAIM-"
_LOADING = "_LOADING-"
KEEP_VERSIONS = 3
ABANDONED_AFTER = 24 * 3600  # seconds after which a load that still has not published counts as dead


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _names(spark: SparkSession, target: str, prefix: str) -> dict[str, int]:
    """Entries of the target that begin with ``prefix`` and when they were last changed (ms)."""
    fs, path = _file_system(spark, target)
    found = fs.globStatus(path(os.path.join(target, f"{prefix}*"))) or []
    return {s.getPath().getName(): s.getModificationTime() for s in found}


def _pointers(spark: SparkSession, target: str) -> list[str]:
    """Names of the published pointers, oldest first."""
    return sorted(_names(spark, target, _POINTER))


def _create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file in one step; False where it is there already. The
    local file system's Hadoop client looks first and creates then, so local
    paths use the operating system's exclusive create."""
    fs, hadoop_path = _file_system(spark, path)
    p = fs.makeQualified(hadoop_path(path))
    try:
        if p.toUri().getScheme() == "file":
            with open(p.toUri().getPath(), "x"):
                return True
        return fs.createNewFile(p)
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def _claim_number(spark: SparkSession, target: str) -> int:
    """The next publication number, held by this load alone: compare-and-set on
    the number, tried again with the next one while another load has it."""
    taken = [int(n.split("-")[1]) for prefix in (_POINTER, _CLAIM) for n in _names(spark, target, prefix)]
    number = max(taken, default=0) + 1
    while not _create_once(spark, os.path.join(target, f"{_CLAIM}{number:012d}")):
        number += 1
    return number


def replace_load(df: DataFrame, target: str, audit: Observation | None = None,
                 metrics: tuple[Column, ...] = (), keep: int = KEEP_VERSIONS,
                 abandoned_after: float = ABANDONED_AFTER) -> str:
    """Full replace of the report table (``TRUNCATE`` + ``INSERT``) without an
    empty window: the new rows go to a new version folder, which is then
    published by creating one more pointer, an empty file ``_CURRENT-<number>-<version>``. Creating
    it is one step of the file system and no pointer is ever changed, so a
    reader (``read_current``) always finds a complete version: the old one
    before that step, the new one after it. Loads may run at once: each claims
    a number of its own when its rows are written, and the highest number is
    current. The ``keep`` newest versions stay for readers that have already
    looked up theirs; older ones are deleted, and so are versions that no load
    will publish any more (failed, or without result for ``abandoned_after``
    seconds). Column limits are enforced (``contracts.enforced``).
    ``metrics`` are observed during the write. Returns the version path."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex[:12]}"
    folder, fs_path = os.path.join(target, version), _file_system(spark, target)
    fs, path = fs_path
    fs.mkdirs(path(target))
    loading = path(os.path.join(target, f"{_LOADING}{version}"))
    fs.create(loading, True).close()
    try:
        out = enforced(df if audit is None else df.observe(audit, F.count(F.lit(1)).alias("rows"), *metrics))
        with sized_shuffles(out):
            out.drop("_staged").write.mode("errorifexists").parquet(folder)
        number = _claim_number(spark, target)
        fs.create(path(os.path.join(target, f"{_POINTER}{number:012d}-{version}")), False).close()
    except BaseException:
        fs.delete(path(folder), True)
        raise
    finally:
        fs.delete(loading, False)
    _prune(spark, target, keep, abandoned_after)
    return folder


def _version(pointer: str) -> str:
    return pointer.split("-", 2)[2]


def _prune(spark: SparkSession, target: str, keep: int, abandoned_after: float) -> None:
    """Delete what is older than the ``keep`` newest pointers and the versions
    that are neither published nor being loaded. A load's mark goes only after
    its pointer is there, so folders, marks and pointers are listed in this order."""
    fs, path = _file_system(spark, target)
    versions, marks = _names(spark, target, "v-"), _names(spark, target, _LOADING)
    names = _pointers(spark, target)
    kept = names[-max(keep, 1):]
    deadline = (time.time() - abandoned_after) * 1000
    dead = {m for m, changed in marks.items() if changed < deadline}
    live = {_version(n) for n in kept} | {m[len(_LOADING):] for m in marks if m not in dead}
    oldest = min((int(n.split("-")[1]) for n in kept), default=0)
    claims = [c for c in _names(spark, target, _CLAIM) if int(c.split("-")[1]) < oldest]
    for n in [*names[:-max(keep, 1)], *dead, *claims]:
        fs.delete(path(os.path.join(target, n)), False)
    for v in versions:
        if v not in live:
            fs.delete(path(os.path.join(target, v)), True)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a job's own staging folder (any Hadoop-compatible file system)
    once everything that reads it has been written."""
    fs, path = _file_system(spark, folder)
    fs.delete(path(folder), True)


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """Read the published version of a ``replace_load`` target."""
    names = _pointers(spark, target)
    if not names:
        raise FileNotFoundError(f"nothing is published at {target}")
    return spark.read.parquet(os.path.join(target, _version(names[-1])))
