"""Declarative checks over a DataFrame, with warn and error thresholds.

All row and element checks of a frame are one aggregation; its uniqueness checks
together are one more, counted per key before the shuffle. The rows that fail can be
listed, or written by check in the pass that counts them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import jsonx

PASS, WARN, ERROR = "pass", "warn", "error"


@dataclass(frozen=True)
class Check:
    """``failing`` counts per row; status is by ``warn``/``error`` on the metric.

    The metric is the failing count, or its share in basis points. A threshold
    is the largest metric that is still fine; None never triggers.
    """

    kind: str
    column: str
    failing: Column | None = None
    share: bool = False
    warn: int | None = None
    error: int | None = 0
    where: Column | None = None


def _flag(condition: Column) -> Column:
    """1 where the condition holds; an unknown one adds nothing to a sum."""
    return condition.cast("int")


def not_null(column: str, **limits) -> Check:
    return Check("not_null", column, _flag(F.col(column).isNull()), **limits)


def unique(column: str, **limits) -> Check:
    return Check("unique", column, None, **limits)


def between(column: str, low=None, high=None, **limits) -> Check:
    """Both bounds are allowed values; NULL passes."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < F.lit(low))
    if high is not None:
        outside = outside | (F.col(column) > F.lit(high))
    return Check("between", column, _flag(outside), **limits)


def is_true(expression: Column, label: str, **limits) -> Check:
    return Check("is_true", label, _flag(~expression), **limits)


def is_true_share(expression: Column, label: str, warn: int = 0, error: int = 500, **more) -> Check:
    """The failing share in basis points; unknown rows do not fail."""
    return Check("is_true_share", label, _flag(~expression), True, warn, error, **more)


def elements_between(column: str, low: int = 0, high: int = 6, **limits) -> Check:
    """Counts the elements outside, not the rows."""
    outside = F.filter(column, lambda e: ~e.between(low, high))
    return Check(
        "elements_between", column, F.coalesce(F.array_size(outside), F.lit(0)), **limits
    )


def not_empty(column: str, **limits) -> Check:
    return Check("not_empty", column, _flag(F.array_size(column) == 0), **limits)


def not_in(column: str, values: list, **limits) -> Check:
    return Check("not_in", column, _flag(F.col(column).isin(*values)), **limits)


def has_required_keys(
    column: str, keys: list[str], where: Column | None = None, warn: int = 0, error: int = 9
) -> Check:
    """Payloads that lack a key, a JSON null lacks all; unread lines are not judged."""
    lacking = F.col(column).isNotNull() & ~jsonx.has_keys(column, keys)
    return Check("has_required_keys", column, _flag(lacking), False, warn, error, where)


def has_payload(column: str, warn: int = 0, error: int | None = None) -> Check:
    """Records whose line could not be read or holds a JSON null."""
    return Check("has_payload", column, _flag(~jsonx.has_content(column)), False, warn, error)


def basis_points(failing: str, total: str) -> str:
    """The share of two named counts, as SQL."""
    return f"coalesce(cast(round(try_divide(10000 * {failing}, {total})) AS bigint), 0L)"


def severity(metric: str, warn: int | None, error: int | None) -> str:
    """Error above ``error``, else warn above ``warn``, else pass, as SQL."""
    limits = [(error, ERROR), (warn, WARN)]
    cases = [f"WHEN {metric} > {limit} THEN '{word}'" for limit, word in limits if limit is not None]
    return f"CASE {' '.join(cases)} ELSE '{PASS}' END" if cases else f"'{PASS}'"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _report(check: Check, failing: str, total: str) -> str:
    metric = basis_points(failing, total) if check.share else failing
    return (
        f"named_struct('check', {_quoted(check.kind)}, 'column', {_quoted(check.column)},"
        f" 'failing', {failing}, 'total', {total}, 'metric', {metric},"
        f" 'status', {severity(metric, check.warn, check.error)})"
    )


def tallies(checks: list[Check]) -> list[Column]:
    """The failing sum of each row check, and the rows each one judges."""
    sums = [F.count(F.lit(1)).alias("n")]
    for i, check in enumerate(checks):
        if check.where is None:
            sums.append(F.sum(check.failing).alias(f"f{i}"))
        else:
            sums.append(F.sum(F.when(check.where, check.failing)).alias(f"f{i}"))
            sums.append(F.count_if(check.where).alias(f"n{i}"))
    return sums


def tally_report(tallied: DataFrame, checks: list[Check]) -> DataFrame:
    totals = ["n" if c.where is None else f"n{i}" for i, c in enumerate(checks)]
    rows = [
        _report(check, f"coalesce(f{i}, 0L)", total)
        for i, (check, total) in enumerate(zip(checks, totals))
    ]
    return tallied.selectExpr(f"inline(array({', '.join(rows)}))")


def _unique_reports(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Fails once per value that occurs again; NULLs are not compared."""
    at = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), key_digest(c.column).alias("key")) for i, c in enumerate(checks)]))
    counts = df.select(at).filter("key IS NOT NULL").groupBy("i", "key").agg(F.count(F.lit(1)).alias("n"))
    sums = []
    for i in range(len(checks)):
        own = F.when(F.col("i") == i, F.col("n"))
        sums += [F.count_if(own > 1).alias(f"f{i}"), F.coalesce(F.sum(own), F.lit(0)).alias(f"n{i}")]
    rows = [_report(check, f"f{i}", f"n{i}") for i, check in enumerate(checks)]
    return counts.agg(*sums).selectExpr(f"inline(array({', '.join(rows)}))")


def key_digest(column: str) -> Column:
    """A digest of a value's text, NULL for NULL; values of one column only compare."""
    return F.unhex(F.md5(F.col(column).cast("string")))


def violations(checks: Iterable[Check]) -> Column:
    """(check, column) of every row check that a row fails, in their order."""
    entries = []
    for check in checks:
        fails = check.failing > 0 if check.where is None else check.where & (check.failing > 0)
        entry = F.struct(F.lit(check.kind).alias("check"), F.lit(check.column).alias("column"))
        entries.append(F.when(fails, entry))
    return F.array_compact(F.array(*entries))


def failing_rows(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """``df`` with check, column: every row once for each check that it fails.

    The row checks are one pass. A uniqueness check lists all rows of a value that
    occurs again.
    """
    checks = list(checks)
    by_row = [c for c in checks if c.failing is not None]
    found = []
    if by_row:
        held = df.withColumn("_violations", violations(by_row)).filter(F.size("_violations") > 0)
        found.append(held.select(*[f"`{c}`" for c in df.columns], F.inline("_violations")))
    for check in checks:
        if check.failing is None:
            key = F.col(f"`{check.column}`")
            again = df.groupBy(key.alias("_again")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
            held = df.join(again.select("_again"), key == F.col("_again"), "left_semi")
            named = [F.lit(check.kind).alias("check"), F.lit(check.column).alias("column")]
            found.append(held.select(*[f"`{c}`" for c in df.columns], *named))
    return reduce(lambda a, b: a.unionByName(b), found)


def quarantine(df: DataFrame, checks: Iterable[Check], path: str) -> DataFrame:
    """Writes the rows that fail row checks under ``path``, a folder for each check, and
    gives the report of the same pass; the table's former rows are replaced."""
    checks = [c for c in checks if c.failing is not None]
    seen, observation = observed(df.withColumn("_violations", violations(checks)), checks, f"quarantine-{uuid.uuid4().hex}")
    held = seen.filter(F.size("_violations") > 0)
    held = held.select(*[f"`{c}`" for c in df.columns], F.inline("_violations"))
    held.write.partitionBy("check").mode("overwrite").parquet(path)
    return observed_report(df.sparkSession, observation, checks)


def run_checks(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """check, column, failing, total, metric, status: one row per check."""
    checks = list(checks)
    by_row = [c for c in checks if c.failing is not None]
    by_key = [c for c in checks if c.failing is None]
    reports = []
    if by_row:
        reports.append(tally_report(df.agg(*tallies(by_row)), by_row))
    if by_key:
        reports.append(_unique_reports(df, by_key))
    return reduce(lambda a, b: a.unionByName(b), reports)


def reconcile(fact: DataFrame, summary: DataFrame) -> DataFrame:
    """One row when the fact count differs from the summary's total."""
    counted = fact.agg(F.count(F.lit(1)).alias("n")).scalar()
    totals = summary.agg(F.sum("discount_count").alias("summary_count"))
    return (
        totals.withColumn("fact_count", counted)
        .filter(F.col("fact_count") != F.col("summary_count"))
        .select("fact_count", "summary_count")
    )


def observed(df: DataFrame, checks: list[Check], name: str) -> tuple[DataFrame, Observation]:
    """``df`` with the row checks counted while an action passes over it.

    Meant for frames that are written without a shuffle after them: there every
    row is counted exactly once, whatever tasks are run again.
    """
    observation = Observation(name)
    return df.observe(observation, *tallies(checks)), observation


def observed_report(
    spark: SparkSession, observation: Observation, checks: list[Check]
) -> DataFrame:
    """The report of observed checks, once the action is over."""
    counts = observation.get
    names = ["n", *[f"{part}{i}" for i in range(len(checks)) for part in "fn"]]
    tallied = spark.range(0, 1, 1, 1).selectExpr(*[f"{counts.get(n) or 0}L AS {n}" for n in names])
    return tally_report(tallied, checks)


class ChecksFailed(RuntimeError):
    """A check reached its error threshold."""


def enforce_rows(rows: list[dict]) -> list[dict]:
    """The rows of a report; raises when one is an error."""
    bad = [f"{r['check']}({r['column']})={r['metric']}" for r in rows if r["status"] == ERROR]
    if bad:
        raise ChecksFailed("; ".join(bad))
    return rows


def enforce(report: DataFrame) -> list[dict]:
    """``enforce_rows`` of a report frame, which has one row per check."""
    return enforce_rows([r.asDict() for r in report.collect()])


def staging_checks() -> list[Check]:
    """What every normalised source is held to."""
    gives = (F.col("discount_rate") != 0) | (F.col("discount_no_interest_installment_qty") != 0)
    usable = F.col("discount_valid_online") | F.col("discount_valid_instore")
    required = [
        "source_id",
        "issuer_name",
        "merchant_name",
        "merchant_category_name",
        "discount_start_date",
        "discount_end_date",
        "discount_rate",
        "discount_terms_and_conditions",
        "discount_url",
        "discount_max_discount_amount",
        "discount_min_purchase_amount",
        "discount_no_interest_installment_qty",
        "discount_valid_days_list",
        "discount_valid_online",
        "discount_valid_instore",
        "discount_payment_methods_list",
    ]
    return [
        is_true_share(usable, "usable"),
        is_true_share(gives, "gives"),
        *[not_null(c) for c in required],
        between("discount_rate", 0, 1),
        between("discount_max_discount_amount", 0),
        between("discount_min_purchase_amount", 0),
        between("discount_no_interest_installment_qty", 0),
        elements_between("discount_valid_days_list"),
        not_empty("discount_payment_methods_list"),
    ]


def union_checks() -> list[Check]:
    gives = (F.col("discount_rate") != 0) | (F.col("discount_no_interest_installment_qty") != 0)
    usable = F.col("discount_valid_instore") | F.col("discount_valid_online")
    return [is_true(gives, "gives"), is_true(usable, "usable")]


def normalised_checks(uncategorised: str) -> list[Check]:
    return [
        unique("discount_id"),
        not_null("discount_id"),
        unique("discount_content_hash"),
        not_null("discount_content_hash"),
        not_null("merchant_category_clean"),
        not_in("merchant_category_clean", [uncategorised]),
    ]


def fact_checks() -> list[Check]:
    return [not_null("id"), unique("id")]
