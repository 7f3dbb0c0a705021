"""Benchmark the headline jobs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built from scratch (plan construction and size checks are part
of the timing) and executed in full through Spark's ``noop`` sink, which
computes every output column of every row without collecting to Python
(a report job's real sink is a parquet write). One warm-up pass, then the
median of ``BENCH_RUNS`` (default 3) timed runs. Prints one JSON line.

The four operators that are rewritten (range join, OR join, anti-join,
ordered TOP 1) are also timed in their literal Spark SQL form for
comparison (``naive_literal_form_sec``; not part of ``value``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "commission_mart",                 # D1: three branches + load + adjustment-only
    "file_component_extract",          # D2a
    "file_component_extract_country",  # D2b (OR-join rewrite)
    "file_adjudication_report",        # D3 (eight look-ups)
    "param_site",                      # D4d
    "load_audit",                      # D1f
    "range_band_join",                 # J8 rewrite
    "any_code_join",                   # J9 rewrite
    "unmatched_adjustments",           # J10 rewrite
    "first_differing_status",          # J13 rewrite
]

# The rewritten operators in the form a plain SQL author would write them, over the
# same role views: theta join, OR join, outer join + IS NULL, correlated
# ordered TOP 1. Timed once each, cancelled after NAIVE_TIMEOUT seconds.
NAIVE_TIMEOUT = float(os.environ.get("BENCH_NAIVE_TIMEOUT", "90"))
_CD = "client_day"
_AGE = "datediff(to_date(cast(client_day.billing_date_key as string), 'yyyyMMdd'), client.business_start_date)"
NAIVE_SQL = {
    "range_band_join": f"""
        select client_key, client_day.billing_date_key, {_AGE} as age, commission_band.commission_key
        from client_day join client using (client_key)
        join commission_band on {_AGE} between commission_band.account_age_min and commission_band.account_age_max""",
    "any_code_join": """
        select abroad.file_no, abroad.line_no, abroad.country, named.long_code, named.description
        from detail_international abroad
        left join country_code named on upper(rtrim(abroad.country)) = upper(rtrim(named.long_code))
             or upper(rtrim(abroad.country)) = upper(rtrim(named.short_code))""",
    "unmatched_adjustments": """
        select adj.client_key, adj.adjustment_month, adj.adjustment_year
        from invoice_adjustment adj
        left join client_day on client_day.client_key = adj.client_key
             and concat(adj.adjustment_year, adj.adjustment_month) = left(cast(client_day.billing_date_key as string), 6)
        where client_day.client_key is null""",
    "first_differing_status": """
        select request.file_no,
               (select told.description
                  from adjudication step
                  join client_status told on upper(rtrim(told.req_status)) = upper(rtrim(step.req_status))
                 where step.file_no = request.file_no and told.account_no = request.account_no
                   and upper(rtrim(step.req_status)) <> upper(rtrim(request.client_req_status))
                 order by step.created_at asc nulls first, told.description limit 1) as original_adj
        from request""",
}


def run_naive(spark, sf_dir: str) -> dict:
    import threading

    from ledgerline.plans import commission
    from ledgerline.sources.roles import Roles

    def views():  # built inside the timing, like the rewritten queries
        r = Roles(spark, sf_dir)
        for n in ["request", "adjudication", "client_status", "detail_international",
                  "country_code", "client", "commission_band", "invoice_adjustment"]:
            getattr(r, n).createOrReplaceTempView(n)
        commission.client_day(commission.fact_grain(r), False).createOrReplaceTempView(_CD)

    out = {}
    sc = spark.sparkContext
    for name, sql in NAIVE_SQL.items():
        group = f"naive-{name}"
        sc.setJobGroup(group, group, interruptOnCancel=True)
        timer = threading.Timer(NAIVE_TIMEOUT, lambda g=group: sc.cancelJobGroup(g))
        t0 = time.perf_counter()
        timer.start()
        try:
            views()
            spark.sql(sql).write.format("noop").mode("overwrite").save()
            out[name] = round(time.perf_counter() - t0, 3)
        except Exception:  # noqa: BLE001 - cancelled by the timer
            out[name] = f">{NAIVE_TIMEOUT:.0f}"
        finally:
            timer.cancel()
            sc.setJobGroup("", "")
    return out


def shuffle_mb(spark, events: str, times: int) -> dict:
    """Shuffle megabytes written by one run of each query, from the event log."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    group, total = {}, {}
    for name in os.listdir(events):
        with open(os.path.join(events, name), errors="replace") as f:
            for line in f:
                try:
                    e = json.loads(line)
                except ValueError:  # the last line may be half written
                    continue
                if e["Event"] == "SparkListenerJobStart":
                    for stage in e["Stage IDs"]:
                        group[stage] = (e.get("Properties") or {}).get("spark.jobGroup.id")
                elif e["Event"] == "SparkListenerTaskEnd":
                    wrote = ((e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    key = group.get(e["Stage ID"])
                    total[key] = total.get(key, 0) + wrote
    return {k: round(v / times / 1e6, 2) for k, v in total.items() if k and not k.startswith("naive-")}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from ledgerline.plans.registry import queries
    from ledgerline.session import build_session

    # one shuffle partition per core suits sf0.1 (AQE coalesces / splits at runtime)
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    events = tempfile.mkdtemp(prefix="ledgerline-bench-events-")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=parts, app="ledgerline-bench", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{events}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    qs = queries()

    def run_once(name: str) -> float:
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in names:  # warm-up: JIT, codegen caches, file listing
        run_once(n)
    times = {n: [] for n in names}
    for _ in range(runs):
        for n in names:
            times[n].append(run_once(n))
    med = {n: round(statistics.median(v), 3) for n, v in times.items()}
    naive = run_naive(spark, sf_dir) if os.environ.get("BENCH_NAIVE", "1") == "1" else {}
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(med.values()), 3),
        "unit": "sec",
        "queries": med,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "naive_literal_form_sec": naive,
        "shuffle_mb": shuffle_mb(spark, events, runs + 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
