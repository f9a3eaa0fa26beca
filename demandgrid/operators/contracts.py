"""Data contracts as rows of a report: (check, model, ok, bad_rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.schema import FORBIDDEN_TARGET_COLUMNS

REPORT_SCHEMA = "check string, model string, ok boolean, bad_rows bigint"
RTOL, ATOL = 1e-5, 1e-8
#: Failing rules that an error spells out; it counts the others.
SHOWN = 20
#: Models whose copies of an id are counted in one row.
MODELS_ABREAST = 16


def require_columns(df: DataFrame, names: list[str], table: str) -> None:
    """An error that lists every column the table lacks."""
    if absent := sorted(set(names) - set(df.columns)):
        raise ValueError(f"{table}: no column {', '.join(absent)}")


def leaking_columns(targets: DataFrame) -> list[str]:
    return sorted(set(FORBIDDEN_TARGET_COLUMNS) & set(targets.columns))


def schema_checks(targets: DataFrame, labels: DataFrame) -> list[tuple[str, str | None, bool, int]]:
    """Checks that need no scan. A failing one counts the columns at fault."""
    have = set(targets.columns)
    missing_target = [] if "id" in have else ["id"]
    missing_label = [c for c in ("id", "city", "demand") if c not in labels.columns]
    leaks = leaking_columns(targets)
    station = bool(have & {"start_station_id", "station_id", "station_key"})
    time = bool(have & {"target_hour_start", "hour_ts"}) or {"date", "hour"} <= have
    return [
        ("target_columns", None, not missing_target, len(missing_target)),
        ("label_columns", None, not missing_label, len(missing_label)),
        ("no_leaking_columns", None, not leaks, len(leaks)),
        ("station_identifier", None, station, 0 if station else 1),
        ("target_time", None, time, 0 if time else 1),
    ]


#: What each schema rule asks of targets, for errors.
_ASKS = {
    "target_columns": "no column id",
    "station_identifier": "no station: start_station_id, station_id or station_key",
    "target_time": "no time: target_hour_start, hour_ts, or date and hour",
}


def assert_targets_are_safe(targets: DataFrame) -> None:
    """The failing schema rules of targets as one error that names the columns at fault;
    touches no data."""
    rows = schema_checks(targets, targets)
    failed = [name for name, _, ok, _ in rows if not ok and name != "label_columns"]
    if failed:
        leaks = ", ".join(leaking_columns(targets))
        told = [_ASKS.get(name, f"{name} (leaking: {leaks})") for name in failed]
        raise ValueError(f"targets: {'; '.join(told)}")


def id_counts(df: DataFrame, side: str) -> DataFrame:
    return df.groupBy("id").agg(F.count("*").alias(side))


def id_report(targets: DataFrame, labels: DataFrame) -> DataFrame:
    """Duplicate ids on either side and ids that only one side has, in one join.

    Ids are counted before they are joined, so a repeated id arrives as one row.
    """
    both = (
        id_counts(targets, "in_targets")
        .join(id_counts(labels, "in_labels"), "id", "full")
        .na.fill(0, ["in_targets", "in_labels"])
    )
    counts = both.agg(
        F.count_if(F.col("in_targets") > 1).alias("target_ids_unique"),
        F.count_if(F.col("in_labels") > 1).alias("label_ids_unique"),
        F.count_if(F.col("in_targets") == 0).alias("label_ids_in_targets"),
        F.count_if(F.col("in_labels") == 0).alias("target_ids_in_labels"),
    )
    return _report(counts, counts.columns, F.lit(None).cast("string"))


def as_number(col: Column | str) -> Column:
    """The value as double; text that is no number and NaN become null, infinities stay."""
    number = (F.col(col) if isinstance(col, str) else col).try_cast("double")
    return F.when(~F.isnan(number), number)


def _rule_counts(predictions: DataFrame) -> DataFrame:
    """Per model, its rows and those that break a rule by their value alone. Only one row for
    each task and model is shuffled."""
    number = as_number("prediction")
    infinite = F.abs(number) == F.lit(float("inf"))
    return predictions.groupBy("model").agg(
        F.count("*").alias("_rows"),
        F.count_if(number.isNull()).alias("numeric"),
        F.count_if(infinite).alias("finite"),
        F.count_if(number < 0).alias("non_negative"),
    )


def _id_checks(targets: DataFrame, predictions: DataFrame, models: list[str | None]) -> DataFrame:
    """Per model, ids with copies, ids that are no target's, and ids of targets without a
    row; further the target ids. One shuffle, by id, for all models.

    Targets and predictions are stacked and counted by id, the copies of each model side by
    side, ``MODELS_ABREAST`` at most. The counts run before the shuffle, so an id repeated in
    a third of the rows travels as one row per task.
    """
    packs = [models[k : k + MODELS_ABREAST] for k in range(0, len(models), MODELS_ABREAST)]
    number = reduce(
        lambda rest, k: F.when(F.col("model").eqNullSafe(F.lit(models[k])), F.lit(k)).otherwise(rest),
        range(len(models)),
        F.lit(None).cast("int"),
    )
    pack, place = F.col("_number") / F.lit(MODELS_ABREAST), F.col("_number") % F.lit(MODELS_ABREAST)
    sent = predictions.select("id", number.alias("_number")).select(
        "id", F.floor(pack).cast("int").alias("_pack"), place.alias("_place")
    )
    each = F.explode(F.sequence(F.lit(0), F.lit(len(packs) - 1))).alias("_pack")
    asked = targets.select("id", each, F.lit(None).cast("int").alias("_place"))
    width = max(map(len, packs))
    copies = [F.count_if(F.col("_place") == k).alias(f"_{k}") for k in range(width)]
    # A null id meets nothing; predictions have a place, so rows without one are targets.
    known = F.count_if(F.col("_place").isNull() & F.col("id").isNotNull()) > 0
    by_id = asked.unionByName(sent).groupBy("id", "_pack").agg(known.alias("_known"), *copies)
    here = [F.col(f"_{k}") for k in range(width)]
    known = F.col("_known")
    sums = by_id.groupBy("_pack").agg(
        F.count_if(known).alias("_ids"),
        *[F.count_if(c > 1).alias(f"_twice{k}") for k, c in enumerate(here)],
        *[F.count_if((c > 0) & ~known).alias(f"_extra{k}") for k, c in enumerate(here)],
        *[F.count_if((c > 0) & known).alias(f"_met{k}") for k, c in enumerate(here)],
    )
    rows = F.array(
        *[
            F.struct(
                (F.col("_pack") * MODELS_ABREAST + k).alias("_number"),
                F.col(f"_twice{k}").alias("prediction_ids_unique"),
                F.col(f"_extra{k}").alias("no_extra_ids"),
                (F.col("_ids") - F.col(f"_met{k}")).alias("no_missing_ids"),
            )
            for k in range(width)
        ]
    )
    return sums.select(F.inline(rows))


def model_checks(targets: DataFrame, predictions: DataFrame) -> DataFrame:
    """Per model, the rows that break each prediction rule.

    The values are counted by model at once, in a first pass that also tells the models; the
    ids in one shuffle for all models. What reaches the driver is a row for each model.
    """
    spark = predictions.sparkSession
    counts = _rule_counts(predictions)
    found = sorted(counts.collect(), key=lambda r: (r.model is not None, r.model))
    schema = T.StructType([*counts.schema.fields]).add("_number", T.IntegerType())
    rules = spark.createDataFrame([(*r, k) for k, r in enumerate(found)], schema)
    row_count = F.abs(F.col("_rows") - targets.agg(F.count("*")).scalar())
    if not found:
        none = F.lit(None).cast("bigint")
        made = rules.withColumns({c: none for c in ("prediction_ids_unique", "no_extra_ids", "no_missing_ids")})
    else:
        ids = _id_checks(targets, predictions, [r.model for r in found])
        made = ids.join(F.broadcast(rules), "_number")  # a row for each model
    return made.withColumn("row_count", row_count).drop("_rows", "_number")


SCORER_CHECKS = [
    "row_count",
    "numeric",
    "prediction_ids_unique",
    "no_extra_ids",
    "no_missing_ids",
]
STRICT_CHECKS = ["finite", "non_negative"]


def prediction_report(targets: DataFrame, predictions: DataFrame) -> DataFrame:
    """Scorer rules and the stricter submission rules, one row per rule and model."""
    checks = model_checks(targets, predictions)
    return _report(checks, [*SCORER_CHECKS, *STRICT_CHECKS], F.col("model"))


def failing_models(targets: DataFrame, predictions: DataFrame, strict: bool = False) -> DataFrame:
    """Models that cannot be scored, with the rules they break, after what they raised if the
    predictions have an ``error`` column."""
    rules = [*SCORER_CHECKS, *(STRICT_CHECKS if strict else [])]
    broken = F.concat_ws(",", *[F.when(F.col(r) > 0, F.lit(r)) for r in rules])
    failing = (
        model_checks(targets, predictions)
        .select("model", broken.alias("error"))
        .where(F.col("error") != "")
    )
    if "error" not in predictions.columns:
        return failing
    raised = predictions.where(F.col("error").isNotNull()).groupBy("model").agg(F.min("error").alias("raised"))
    both = failing.join(raised, "model", "full")
    error = F.concat_ws(",", F.concat(F.lit("raised "), "raised"), "error")
    return both.select("model", error.alias("error"))


def repeatability_report(first: DataFrame, second: DataFrame) -> DataFrame:
    """Per model, rows of two runs that differ beyond the tolerance or lack a partner.

    The order of the rows plays no part, so this also covers shuffled input.
    """
    a = first.select("model", "id", as_number("prediction").alias("a"))
    b = second.select("model", "id", as_number("prediction").alias("b"))
    close = F.abs(F.col("a") - F.col("b")) <= F.lit(ATOL) + F.lit(RTOL) * F.abs(F.col("b"))
    same = F.coalesce(close | (F.col("a") == F.col("b")), F.lit(False))
    counts = (
        a.join(b, ["model", "id"], "full")
        .groupBy("model")
        .agg(F.count_if(~same).alias("repeatable"))
    )
    return _report(counts, ["repeatable"], F.col("model"))


def contract_report(
    targets: DataFrame, labels: DataFrame, predictions: DataFrame
) -> DataFrame:
    """Every rule for targets, labels and all prediction sets."""
    rows = schema_checks(targets, labels)
    schema = _driver_rows(targets.sparkSession, rows)
    return schema.unionAll(id_report(targets, labels)).unionAll(
        prediction_report(targets, predictions)
    )


def assert_ok(report: DataFrame) -> None:
    """Turn failing rows of a report into an error."""
    bad = report.where(~F.col("ok"))
    failed = bad.limit(SHOWN + 1).collect()
    if failed:
        told = [f"{r['check']} ({r.model}): {r.bad_rows}" for r in failed[:SHOWN]]
        if len(failed) > SHOWN:
            told.append(f"and {bad.count() - SHOWN} more")
        raise ValueError("; ".join(told))


def assert_unique(df: DataFrame, keys: list[str], name: str) -> None:
    """Join cardinality check for a side that must hold one row per key."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    if not repeated.isEmpty():
        raise ValueError(f"{name} has more than one row for some {keys}")


def _report(counts: DataFrame, checks: list[str], model: Column) -> DataFrame:
    entries = F.array(
        *[F.struct(F.lit(c).alias("check"), F.col(c).alias("bad_rows")) for c in checks]
    )
    return counts.select(model.alias("model"), F.inline(entries)).select(
        "check", "model", (F.col("bad_rows") == 0).alias("ok"), "bad_rows"
    )


def _driver_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A handful of literal rows as a plan without a Python-side scan."""
    one = [
        spark.range(1).select(
            F.lit(check).alias("check"),
            F.lit(model).cast("string").alias("model"),
            F.lit(ok).alias("ok"),
            F.lit(bad).cast("bigint").alias("bad_rows"),
        )
        for check, model, ok, bad in rows
    ]
    return reduce(DataFrame.unionAll, one)
