"""Headline timings: one JSON line, seconds as the median of three warm runs.

Two runs of each step come first and are not counted.

The raw records are landed once before anything is timed: in operation the
sources write them. Each timed step ends in a write or in its result rows. The
builds also run on the next smaller folder, which shows how they grow; ``work``
has the jobs and tasks of each step's last run.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from contract import queries as registered  # noqa: E402
from ofertario.operators import dedup, metrics, normalize, quality, search  # noqa: E402
from ofertario.plans import build as plan  # noqa: E402
from ofertario.session import fresh_folder, get_session, written  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
SMALL_DIR = os.environ.get("BENCH_SMALL_DIR", "/root/testdata/sf0.01")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
AS_OF, CUTOFF = dt.date(2000, 12, 31), dt.date(1999, 6, 30)


def to_nowhere(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = get_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw = registered._raw(spark, SF_DIR)
    serving = registered._published(spark, SF_DIR)
    deduped = plan.dedup_by_source(
        plan.without_payload(plan.keep_worth_showing(plan.staged(raw)), "$.seq")
    )
    deduped = written(deduped, "deduped")
    offers = written(plan.normalised(deduped), "offers")
    events = registered.table(spark, SF_DIR, "events")
    lineitem = registered.table(spark, SF_DIR, "lineitem")
    loaded: list[str] = []
    small = registered._raw(spark, SMALL_DIR) if os.path.isdir(SMALL_DIR) else None

    def build(records, path, cutoff=None) -> None:
        plan.build(spark, records, path, as_of=AS_OF, cutoff=cutoff, tie_path="$.seq", enforce=False)

    def full_build(records):
        return lambda: build(records, fresh_folder(spark, "build"))

    def prepare_increment(records):
        """A fact table up to the cutoff; the timed run reads the partitions after it."""

        def prepare() -> None:
            loaded.append(fresh_folder(spark, "build"))
            build(records, loaded[-1], CUTOFF)

        return prepare

    def increment(records):
        return lambda: build(records, loaded[-1])

    def prepare_merge() -> None:
        loaded.append(fresh_folder(spark, "fact"))
        plan.load_fact(offers, loaded[-1], CUTOFF)

    def checks() -> None:
        gives = (lineitem.l_discount != 0) | (lineitem.l_tax != 0)
        quality.run_checks(
            lineitem,
            [
                quality.not_null("l_shipdate"),
                quality.between("l_discount", 0, 1),
                quality.is_true_share(gives, "gives"),
                quality.unique("l_orderkey"),
            ],
        ).collect()

    steps = {
        "full_build": (None, full_build(raw)),
        "incremental_build": (prepare_increment(raw), increment(raw)),
        "incremental_merge": (prepare_merge, lambda: plan.load_fact(offers, loaded[-1])),
        "normalize_bbva": (None, lambda: to_nowhere(normalize.normalize_bbva(raw))),
        "normalize_galicia": (None, lambda: to_nowhere(normalize.normalize_galicia(raw))),
        "normalize_naranjax": (None, lambda: to_nowhere(normalize.normalize_naranjax(raw))),
        "dedup_by_content": (None, lambda: to_nowhere(dedup.dedup_by_content(deduped))),
        "dedup_audit": (None, lambda: to_nowhere(dedup.dedup_audit(deduped.drop("record_order")))),
        "checks": (None, checks),
        "search_page": (None, lambda: search.search(serving, registered.FOUND).collect()),
        "facets": (None, lambda: search.facet_values(serving, registered.NARROW).collect()),
        "histogram": (
            None,
            lambda: metrics.histogram(
                events.selectExpr("event_type AS spider", "value"), ["spider"]
            ).collect(),
        ),
        "failure_alerts": (
            None,
            lambda: metrics.failure_alerts(registered._runs(events)).collect(),
        ),
        "latest_event": (None, lambda: to_nowhere(registered.w1_latest_by(spark, SF_DIR))),
        "rank_hot_groups": (None, lambda: to_nowhere(registered.w2_rank_within(spark, SF_DIR))),
    }
    if small is not None:
        steps["full_build_small"] = (None, full_build(small))
        steps["incremental_build_small"] = (prepare_increment(small), increment(small))
    seconds: dict[str, float] = {}
    work: dict[str, list[int]] = {}
    tracker = spark.sparkContext.statusTracker()
    for name, (prepare, step) in steps.items():
        taken = []
        for run in range(RUNS + 2):
            if prepare:
                prepare()
            spark.sparkContext.setJobGroup(f"{name}-{run}", name)
            started = time.perf_counter()
            step()
            taken.append(time.perf_counter() - started)
            spark.sparkContext.setJobGroup("between", "between")
        jobs = tracker.getJobIdsForGroup(f"{name}-{RUNS + 1}")
        infos = [tracker.getJobInfo(j) for j in jobs]
        stages = [tracker.getStageInfo(s) for i in infos if i for s in i.stageIds]
        work[name] = [len(jobs), sum(s.numCompletedTasks for s in stages if s)]
        seconds[name] = round(statistics.median(taken[2:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "work": work,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "spark": spark.version,
                "cpus": int(CPUS),
                "shuffle_partitions": int(CPUS),
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
