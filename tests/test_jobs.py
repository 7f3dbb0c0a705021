"""End-to-end batch jobs on sf0.001: staging, versioned replace, audit."""

import os
import tempfile

import datetime as dt
import threading

import pytest

from ledgerline import jobs
from ledgerline.plans import commission, fixture
from ledgerline.sources.roles import Roles
from ledgerline.sources.sinks import read_current, replace_load

from .conftest import SF_SMALL


def test_commission_job_replaces_and_audits(spark):
    target = tempfile.mkdtemp(prefix="ledgerline-target-")
    first = jobs.run_commission(spark, SF_SMALL, target, fixture.COMMISSION)
    v1 = read_current(spark, target)
    assert v1.count() == first["destinationfinalrowcount"] > first["sourcecount"] > 0
    assert first["insertcount"] == first["destinationfinalrowcount"]
    assert first["updatecount"] is None and first["nochangerowcount"] is None
    # same numbers as the lazy query form
    r = Roles(spark, SF_SMALL)
    staged = commission.commission_staged(r, fixture.COMMISSION)
    assert staged.count() == first["sourcecount"]
    assert v1.columns[:2] == ["client_key", "company_name"]
    assert "AuditInsertedPackageKey" not in v1.columns
    # a second run publishes a new version; the old one stays readable until then
    versions_before = {d for d in os.listdir(target) if d.startswith("v-")}
    second = jobs.run_commission(spark, SF_SMALL, target, fixture.COMMISSION)
    versions_after = {d for d in os.listdir(target) if d.startswith("v-")}
    assert len(versions_after - versions_before) == 1
    assert second == first
    assert read_current(spark, target).exceptAll(v1).count() == 0


def test_jobs_remove_their_staging(spark):
    from ledgerline.session import checkpoint_dir

    def staging():
        return set(os.listdir(checkpoint_dir(spark)))

    before = staging()
    out = tempfile.mkdtemp(prefix="ledgerline-target-")
    jobs.run_commission(spark, SF_SMALL, out, fixture.COMMISSION)
    jobs.run_extracts(spark, SF_SMALL, out, fixture.EXTRACT, fixture.COUNTRY_EXTRACT)
    jobs.run_report_dataset(spark, SF_SMALL, out, fixture.REPORT, fixture.PARAMS)
    assert staging() == before


def test_readers_never_miss_a_version(spark):
    """A reader that looks during every load always finds a complete table."""
    target = tempfile.mkdtemp(prefix="ledgerline-target-")
    load = lambda n: replace_load(spark.range(n), target, keep=2)
    load(5)
    seen, failed, done = set(), [], threading.Event()

    def look():
        while not done.is_set():
            try:
                seen.add(read_current(spark, target).count())
            except Exception as e:  # noqa: BLE001
                failed.append(repr(e)[:300])
    reader = threading.Thread(target=look)
    reader.start()
    for n in (6, 7):
        load(n)
    done.set()
    reader.join()
    assert not failed and seen <= {5, 6, 7}
    assert read_current(spark, target).count() == 7
    load(8)
    assert len([d for d in os.listdir(target) if d.startswith("v-")]) == 2  # older versions are pruned
    assert len([d for d in os.listdir(target) if d.startswith("_CURRENT-")]) == 2
    with pytest.raises(FileNotFoundError):
        read_current(spark, tempfile.mkdtemp(prefix="ledgerline-target-"))


def test_checkpoint_folder_is_required_off_a_local_master():
    from ledgerline import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_every_parameter_reaches_the_jobs(spark):
    a = jobs.parser().parse_args([
        "report", "--tables", "t", "--target", "o", "--package-key", "9", "--regular-until", "1996-02-03",
        "--bucket-from", "1996-02-04", "--run-ts", "2024-05-06T07:08:09", "--site-prefix", "AB", "--completed-from",
        "1996-01-01", "--completed-to", "1996-12-31", "--country-site-prefix", "CD", "--country-completed-from", "1997-01-01",
        "--country-completed-to", "1997-12-31", "--status", "open", "--start-date", "1998-01-01", "--end-date", "1998-01-31",
        "--site", "S1", "--site", "S2", "--batch", "B1", "--strict-null", "--industry", "I1", "--group-header", "G1",
        "--client", "C1", "--corp-id", "K1"])
    com, ext, country, rep, sel = jobs.configs(a)
    assert (com.package_key, com.regular_until, com.bucket_from) == (9, dt.date(1996, 2, 3), dt.date(1996, 2, 4))
    assert com.run_ts == dt.datetime(2024, 5, 6, 7, 8, 9)
    assert (ext.site_prefix, ext.completed_to, country.site_prefix, country.completed_from) == (
        "AB", dt.datetime(1996, 12, 31), "CD", dt.datetime(1997, 1, 1))
    assert ext.status == country.status == "open"
    assert (rep.start_date, rep.end_date, rep.sites, rep.batches, rep.strict_null) == (
        dt.datetime(1998, 1, 1), dt.datetime(1998, 1, 31), ("S1", "S2"), ("B1",), True)
    assert (sel.industries, sel.group_header, sel.clients, sel.corp_ids) == (("I1",), ("G1",), ("C1",), ("K1",))
    plain = jobs.configs(jobs.parser().parse_args(["commission", "--tables", "t", "--target", "o"]))
    assert plain[0].regular_until == dt.date(2016, 3, 31) and plain[0].run_ts is None
    assert plain[0].started().run_ts.date() >= dt.date(2024, 1, 1)


def test_extract_and_report_jobs_write_display_names(spark):
    out = tempfile.mkdtemp(prefix="ledgerline-out-")
    ex = jobs.run_extracts(spark, SF_SMALL, out, fixture.EXTRACT, fixture.COUNTRY_EXTRACT)
    assert ex["file_component_extract"] > 0
    rep = jobs.run_report_dataset(spark, SF_SMALL, out, fixture.REPORT, fixture.PARAMS)
    assert rep["param_industry"] >= 1
    df = spark.read.parquet(os.path.join(out, "param_site"))
    assert df.count() == rep["param_site"]
    assert df.columns == ["SiteName", "ClientKey"]
    ds = spark.read.parquet(os.path.join(out, "file_adjudication_report"))
    assert "Original Adj." in ds.columns and "Troubled File?" in ds.columns
    assert ds.select("`Original Adj.`").count() == rep["file_adjudication_report"]
    fx = spark.read.parquet(os.path.join(out, "file_component_extract"))
    assert fx.columns[:2] == ["Site", "File Number"]
