"""The quality gate of a dimension snapshot, as one aggregation."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import QualityRules
from tidemark.functions.safe import instant, is_blank, to_number, to_time

ERROR, WARNING = "error", "warning"
#: Unexpected values that the report lists.
LISTED = 20


def conform(frame: DataFrame, schema) -> DataFrame:
    """Columns of ``schema`` with its types; values that do not fit become NULL."""
    columns = []
    for field in schema:
        if field.name in frame.columns:
            columns.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return frame.select(*columns)


def lost_values(frame: DataFrame, schema) -> DataFrame:
    """One row: how many values of each column ``conform`` would turn into NULL."""
    return frame.agg(*[
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
        for f in schema if f.name in frame.columns])


def baseline(source: DataFrame, updated_at: str = "updated_at") -> DataFrame:
    """What the source holds: row count and newest change."""
    return source.agg(
        F.count(F.lit(1)).alias("row_count"), F.max(updated_at).alias("max_updated_at"),
    )


def null_rates(frame: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Share of NULLs per required column."""
    return _unpivot(
        frame.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in rules.required]),
        rules.required, "column_name", "null_rate",
    )


def unexpected_values(frame: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Every value outside the allowed domain, with its row count."""
    value = F.col(rules.domain_column)
    return (
        frame.filter(value.isNotNull() & ~value.isin(*rules.allowed))
        .groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    )


def _unpivot(row: DataFrame, names, key: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return row.selectExpr(f"stack({len(names)}, {pairs}) AS ({key}, {value})")


def _measures(frame: DataFrame, rules: QualityRules, clock: datetime) -> dict[str, Column]:
    """Aggregates the checks are built from; only for columns that exist."""
    present = set(frame.columns)
    types = {f.name: f.dataType for f in frame.schema}
    found: dict[str, Column] = {"rows": F.count(F.lit(1))}
    if set(rules.required) <= present:
        for c in rules.required:
            found[f"nulls_{c}"] = F.count_if(F.col(c).isNull())
        for c in rules.text_columns:
            found[f"blank_{c}"] = F.count_if(is_blank(F.col(c)))
    if rules.key in present:
        key = F.col(rules.key)
        number = to_number(key, types[rules.key])
        found["distinct_keys"] = F.count_distinct(key)
        found["null_key"] = F.max(key.isNull().cast("int"))
        found["non_numeric"] = F.count_if(number.isNull())
        found["non_positive"] = F.count_if(number <= 0)
    if rules.domain_column in present:
        value = F.col(rules.domain_column)
        found["unexpected"] = F.count_if(value.isNotNull() & ~value.isin(*rules.allowed))
    if rules.start_date in present:
        start = to_time(F.col(rules.start_date), types[rules.start_date])
        found["unparseable"] = F.count_if(start.isNull())
        found["future"] = F.count_if(start > instant(clock))
    if rules.updated_at in present:
        found["newest"] = F.max(to_time(F.col(rules.updated_at), types[rules.updated_at]))
    return found


def _check(name, passed, metric, detail, severity=ERROR, when=None) -> Column:
    """One report row; ``when`` decides whether it is part of the report."""
    severity = F.lit(severity) if isinstance(severity, str) else severity
    row = F.struct(
        F.lit(name).alias("check_name"), F.coalesce(passed, F.lit(False)).alias("passed"),
        metric.cast("double").alias("metric"), detail.cast("string").alias("detail"),
        severity.alias("severity"),
    )
    return row if when is None else F.when(when, row)


def quality_report(
    frame: DataFrame, rules: QualityRules = QualityRules(), *, clock: datetime,
    source: DataFrame | None = None,
) -> DataFrame:
    """All checks of the gate: (check_name, passed, metric, detail, severity).

    The snapshot is aggregated once to one wide row, which is turned into one
    row per check. ``source`` is the one-row baseline; columns left out of it
    leave out their check.
    """
    measures = _measures(frame, rules, clock)
    wide = frame.agg(*[column.alias(name) for name, column in measures.items()])
    expected = set()
    if source is not None:
        expected = set(source.columns) & {"row_count", "max_updated_at"}
        # Two one-row frames, stacked rather than joined.
        wide = wide.unionByName(source.select(*expected), allowMissingColumns=True)
        wide = wide.agg(*[F.max(c).alias(c) for c in wide.columns])

    if "unexpected" in measures:
        listed = (
            unexpected_values(frame, rules).select(F.col("value").cast("string"))
            .orderBy("value").limit(LISTED + 1)
            .agg(F.array_sort(F.collect_list("value")).alias("unexpected_values"))
        )
        wide = wide.unionByName(listed, allowMissingColumns=True)
        wide = wide.agg(*[F.max(c).alias(c) for c in wide.columns])

    rows = F.col("rows")
    missing = [c for c in rules.required if c not in frame.columns]
    checks = [
        _check("row_count_minimum", rows >= rules.min_rows, rows,
               F.format_string("%d rows, minimum %d", rows, F.lit(rules.min_rows))),
        _check("required_columns_present", F.lit(not missing), F.lit(len(missing)),
               F.lit("missing " + ", ".join(missing) if missing else "all present")),
    ]
    if not missing:
        rates = [F.col(f"nulls_{c}") / F.nullif(rows, F.lit(0)) for c in rules.required]
        worst = F.greatest(*rates)
        worst_name = F.coalesce(*[
            F.when(rate == worst, F.lit(c)) for c, rate in zip(rules.required, rates)])
        blanks = reduce(lambda a, b: a + b, [F.col(f"blank_{c}") for c in rules.text_columns])
        checks += [
            _check("null_rate", worst <= rules.max_null_rate, worst,
                   F.concat(F.lit("worst column "), worst_name)),
            _check("no_empty_strings", blanks == 0, blanks,
                   F.concat_ws(", ", *[F.concat(F.lit(f"{c}: "), F.col(f"blank_{c}"))
                                       for c in rules.text_columns])),
        ]
    if "distinct_keys" in measures:
        # Every occurrence after the first; NULL keys count as one value.
        surplus = rows - F.col("distinct_keys") - F.coalesce("null_key", F.lit(0))
        checks += [
            _check(f"{rules.key}_unique", surplus == 0, surplus,
                   F.concat(surplus, F.lit(" surplus duplicates"))),
            _check(f"{rules.key}_numeric", F.col("non_numeric") == 0, F.col("non_numeric"),
                   F.concat("non_numeric", F.lit(" values are not numbers"))),
            _check(f"{rules.key}_positive", F.col("non_positive") == 0, F.col("non_positive"),
                   F.concat("non_positive", F.lit(" values are zero or negative"))),
        ]
    if "unexpected" in measures:
        checks.append(_check(
            f"{rules.domain_column}_domain", F.col("unexpected") == 0, F.col("unexpected"),
            F.concat("unexpected", F.lit(" rows outside " + ", ".join(sorted(rules.allowed)) + ": "),
                     F.array_join(F.slice("unexpected_values", 1, LISTED), ", "),
                     F.when(F.size("unexpected_values") > LISTED, ", ...").otherwise(""))))
    if "unparseable" in measures:
        checks += [
            _check(f"{rules.start_date}_parseable", F.col("unparseable") == 0,
                   F.col("unparseable"), F.concat("unparseable", F.lit(" unparseable dates"))),
            _check(f"{rules.start_date}_not_future", F.col("future") == 0, F.col("future"),
                   F.concat("future", F.lit(" dates in the future")), WARNING),
        ]
    if "row_count" in expected:
        delta = rows - F.col("row_count")
        checks.append(_check(
            "row_count_reconciles_with_source", delta == 0, delta,
            F.format_string("snapshot %d, source %d", rows, F.col("row_count"))))
    if "newest" in measures:
        newest = F.col("newest")
        age = (F.unix_micros(instant(clock)) - F.unix_micros(newest)) / F.lit(3.6e9)
        checks.append(_check(
            "snapshot_freshness", age <= rules.max_age_hours, age,
            F.coalesce(F.format_string("newest row is %.2f h old", age),
                       F.lit(f"{rules.updated_at} could not be parsed")),
            F.when(newest.isNull(), WARNING).otherwise(ERROR), when=rows > 0))
        if "max_updated_at" in expected:
            ahead = (
                F.unix_micros(newest) - F.unix_micros(F.col("max_updated_at").cast("timestamp"))
            ) / F.lit(1e6)
            checks.append(_check(
                "no_rows_lost_against_source_watermark", ahead >= 0, ahead,
                F.format_string("snapshot is %.0f s ahead of the source", ahead),
                when=(rows > 0) & F.col("max_updated_at").isNotNull()))
    report = wide.select(F.explode(F.array(*checks)).alias("c"))
    return report.filter("c IS NOT NULL").select("c.*")


def summary(report: DataFrame) -> DataFrame:
    """One row: how many checks passed, warned and failed, and the verdict."""
    failed = ~F.col("passed") & (F.col("severity") == ERROR)
    return report.agg(
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed") & (F.col("severity") == WARNING)).alias("warnings"),
        F.count_if(failed).alias("failures"),
        F.bool_and(~failed).alias("ok"),
    )
