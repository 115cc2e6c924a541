"""Row rules: keep the valid rows, or flag and count the others."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fareflow.constants import SCOPE_CODES, SCOPE_NAMES

Rules = Mapping[str, Column]


def in_scope(
    code: Column,
    name: Column,
    codes: Sequence[str] = SCOPE_CODES,
    names: Sequence[str] = SCOPE_NAMES,
) -> Column:
    """Known code or known upper-case name. NULL code with an unlisted name is NULL."""
    return code.isin(*codes) | F.upper(name).isin(*names)


def live_rules() -> dict[str, Column]:
    """The rules of the live table, over the standardised columns of ``shape_live``."""
    required = ("event_id", "observed_at", "source_city", "destination_city", "airline", "price")
    present = {f"{c}_present": F.col(c).isNotNull() for c in required}
    return {
        **present,
        "price_positive": F.col("price") > 0,
        "duration_positive": F.col("duration") > 0,
        "days_left_not_negative": F.col("days_left") >= 0,
        "carrier_in_scope": in_scope(F.col("airline_code"), F.col("airline")),
        "travel_date_valid": F.col("travel_date").isNotNull(),
        "event_time_valid": F.col("event_timestamp").isNotNull(),
    }


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows for which every rule holds; a rule that is NULL does not hold."""
    for rule in rules.values():
        df = df.filter(rule)
    return df


def flag_invalid(df: DataFrame, rules: Rules, name: str = "failed_rules") -> DataFrame:
    """All rows, with the names of the rules each one fails."""
    failed = [F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*failed)))


def failures_by_rule(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with the number of rows that fail it, in a single pass."""
    counts = df.agg(
        *[F.count_if(~F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()]
    )
    return counts.unpivot([], list(rules), "rule", "failed_rows")
