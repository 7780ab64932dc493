"""The build: landing zone to fact table, serving tables and checks.

The landing zone is JSON, dear to parse, and is read once: the staging rows
are written as parquet and everything after reads those. The raw and staging
checks are counted in the same pass, as observed metrics of that write.
The payloads end there; the dedup needs only the order of the records. The
normalised offers are written once more, as the checks, the merge and its key
match all read them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import quality
from ..operators.category import UNCATEGORISED, resolve_category
from ..operators.conform import keep_worth_showing, union_sources
from ..operators.dedup import dedup_audit, dedup_by_content, dedup_by_source, with_record_order
from ..operators.merge import fact_columns, newer_than, up_to, upsert
from ..operators.normalize import NORMALIZERS
from ..operators.serving import issuer_summary, serving_table
from ..session import scratch, written
from ..sources.landing import usable
from ..sources.seed_values import REQUIRED_KEYS
from ..sources.seeds import read_seed
from ..sources.tables import (
    commit_version,
    read_version,
    remove,
    stage_version,
    write_table,
    write_version,
)


PAYMENT_SEEDS = {
    "bbva": "bbva_payment_methods",
    "galicia": "galicia_payment_methods",
    "naranjax": "naranja_payment_methods",
}


@dataclass
class Result:
    version: int
    reports: dict[str, list[dict]] = field(default_factory=dict)


def staged(raw: DataFrame, sources: list[str] | None = None, **options) -> DataFrame:
    """All sources in the staging schema; each reads its own partitions."""
    return union_sources([NORMALIZERS[s](raw, **options) for s in sources or NORMALIZERS])


def source_deduped(staging: DataFrame, tie_path: str | None = None) -> DataFrame:
    return dedup_by_source(keep_worth_showing(staging), tie_path)


def normalised(
    deduped: DataFrame, overrides: DataFrame | None = None, categories: DataFrame | None = None
) -> DataFrame:
    """Offers of equal content once, with their published category."""
    spark = deduped.sparkSession
    overrides = read_seed(spark, "merchant_overrides") if overrides is None else overrides
    categories = read_seed(spark, "merchant_categories") if categories is None else categories
    return resolve_category(
        dedup_by_content(deduped.drop("discount_metadata", "record_order")), overrides, categories
    )


def offers(raw: DataFrame, tie_path: str | None = None) -> DataFrame:
    """The whole chain from raw records to normalised offers, as one plan."""
    return normalised(source_deduped(staged(raw), tie_path))


#: Unread lines and null payloads of a source above which a build stops.
UNREAD_LIMIT = 9


def raw_checks(spider: str, unread_limit: int | None = UNREAD_LIMIT) -> list[quality.Check]:
    return [
        quality.has_required_keys("raw_payload", REQUIRED_KEYS[spider]),
        quality.has_payload("raw_payload", error=unread_limit),
    ]


def without_payload(staging: DataFrame, tie_path: str | None = None) -> DataFrame:
    """Staging rows with the order of their records in place of the payload."""
    return with_record_order(staging, tie_path).drop("discount_metadata")


def staged_and_checked(
    raw: DataFrame,
    tie_path: str | None = None,
    seeds: dict[str, DataFrame] | None = None,
    unread_limit: int | None = UNREAD_LIMIT,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Staging rows worth showing, and the raw and staging reports per source.

    The checks see all rows; what is written leaves out the rows the business
    filter drops, and the payloads.
    """
    spark = raw.sparkSession
    frames, pending = [], []
    for spider, normalise in NORMALIZERS.items():
        key_checks, row_checks = raw_checks(spider, unread_limit), quality.staging_checks()
        own = raw.filter(F.col("spider") == spider)
        own, keys_seen = quality.observed(own, key_checks, f"raw_{spider}")
        rows = normalise(usable(own), methods=(seeds or {}).get(PAYMENT_SEEDS[spider]))
        rows, rows_seen = quality.observed(rows, row_checks, f"staging_{spider}")
        frames.append(rows)
        pending += [
            (f"raw_{spider}", keys_seen, key_checks),
            (f"staging_{spider}", rows_seen, row_checks),
        ]
    kept_checks = quality.union_checks()
    kept = keep_worth_showing(union_sources(frames))
    kept, kept_seen = quality.observed(kept, kept_checks, "union")
    pending.append(("union", kept_seen, kept_checks))
    staging = written(without_payload(kept, tie_path), "staging")
    return staging, {
        name: quality.observed_report(spark, seen, checks) for name, seen, checks in pending
    }


def newer_partitions(raw: DataFrame, target: DataFrame | None) -> DataFrame:
    """Raw records of the days after everything in ``target``, by partition.

    Nothing else can change the fact: both dedups prefer the newest day, so a row
    newer than the target never follows from an older record.
    """
    if target is None:
        return raw
    newest = target.agg(F.max("last_updated_at_date")).first()[0]
    return raw.filter(F.col("scraped_at_dt") > F.lit(newest).cast("date"))


def next_fact(offers: DataFrame, target: DataFrame | None, cutoff: dt.date | None = None) -> DataFrame:
    """All offers (up to ``cutoff``) where there is no target, its upsert of newer rows after."""
    if target is None:
        return fact_columns(up_to(offers, cutoff))
    return upsert(target, fact_columns(newer_than(offers, target)))


def load_fact(offers: DataFrame, path: str, cutoff: dt.date | None = None) -> int:
    """``next_fact`` as the next version of the table at ``path``."""
    target = read_version(offers.sparkSession, path)
    note = "full" if target is None else "incremental"
    return write_version(next_fact(offers, target, cutoff), path, note)


def laid_out(fact: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The serving table by category and merchant, so that a search skips the row
    groups of other categories. Ids end the sort key, which lets a range cut through
    a category that holds most rows."""
    layout = ["merchant_category_name", "merchant_name", "discount_id"]
    return serving_table(fact, as_of).repartitionByRange(*layout).sortWithinPartitions(*layout)


def build(
    spark: SparkSession,
    raw: DataFrame,
    path: str,
    as_of: dt.date | None = None,
    cutoff: dt.date | None = None,
    tie_path: str | None = None,
    enforce: bool = True,
    audit: bool = False,
    seeds: dict[str, DataFrame] | None = None,
    unread_limit: int | None = UNREAD_LIMIT,
    keep: int | None = None,
) -> Result:
    """Builds fact and serving tables under ``path`` from the ``raw`` records.

    ``seeds`` replaces built-in seeds by name, as ``read_seed`` names them.
    ``audit`` also publishes every record with its place among its duplicates.

    Where the fact table exists, only partitions newer than it are read, and the
    raw and staging checks cover those. ``unread_limit`` is how many unread lines
    and null payloads a source may have. ``keep`` is how many versions of each
    table stay; None keeps all.

    With ``enforce`` a check in error stops the build before anything that
    depends on the checked rows is published: tables are checked as staged files,
    before their logs name them.
    """
    folders: list[str] = []
    with scratch(folders):
        result = _build(
            spark, raw, path, as_of, cutoff, tie_path, enforce, audit, seeds, unread_limit, keep
        )
    for folder in folders:
        remove(spark, folder)
    return result


def _build(spark, raw, path, as_of, cutoff, tie_path, enforce, audit, seeds, unread_limit, keep) -> Result:
    reports: dict[str, list[dict]] = {}

    def check(name: str, report: DataFrame) -> None:
        if enforce:
            reports[name] = quality.enforce(report)
        else:
            reports[name] = [r.asDict() for r in report.collect()]

    target = read_version(spark, f"{path}/fact")
    new = newer_partitions(raw, target)
    staging, staging_reports = staged_and_checked(new, tie_path, seeds, unread_limit)
    named = [r.withColumn("of", F.lit(name)) for name, r in staging_reports.items()]
    rows_of = reduce(lambda a, b: a.unionByName(b), named).coalesce(1).collect()
    for row in rows_of:
        report = row.asDict()
        reports.setdefault(report.pop("of"), []).append(report)
    if enforce:
        quality.enforce_rows([r for name in staging_reports for r in reports[name]])
    deduped = dedup_by_source(staging)
    if audit:
        deduped = written(deduped, "deduped")
        write_table(dedup_audit(deduped.drop("record_order")), f"{path}/audit")
    given = seeds or {}
    rows = normalised(
        deduped, given.get("merchant_overrides"), given.get("merchant_categories")
    )
    rows = written(rows, "offers")
    check("offers", quality.run_checks(rows, quality.normalised_checks(UNCATEGORISED)))
    staged_at = {"fact": stage_version(next_fact(rows, target, cutoff), f"{path}/fact")}

    def staged_table(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}/version={staged_at[name]}")

    fact = staged_table("fact")
    check("fact", quality.run_checks(fact, quality.fact_checks()))
    staged_at["serving"] = stage_version(laid_out(fact, as_of), f"{path}/serving")
    staged_at["issuers"] = stage_version(issuer_summary(fact), f"{path}/issuers")
    differing = [r.asDict() for r in quality.reconcile(fact, staged_table("issuers")).collect()]
    reports["reconcile"] = differing
    if enforce and differing:
        raise quality.ChecksFailed("fact rows and issuer totals differ")
    for name, version in staged_at.items():
        note = "full" if target is None else "incremental"
        commit_version(spark, f"{path}/{name}", version, note, keep)
    return Result(staged_at["fact"], reports)
