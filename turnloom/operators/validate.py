"""Checks and figures of nested training samples."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


class DatasetValidationError(ValueError):
    """A dataset breaks a rule of its format."""


# Error codes in the order of the checks inside a row.
TOO_FEW = "too_few_turns"
NOT_OBJECT = "message_not_object"
BAD_ROLE = "invalid_role"
BAD_CONTENT = "invalid_content"
UNSUPPORTED = "unsupported_role"
BAD_ENDS = "must_start_human_end_gpt"
BAD_SYSTEM = "system_not_string"


def _message_error(role: Column, content: Column) -> Column:
    return (
        F.when(F.coalesce(role, F.lit("")) == "", BAD_ROLE)
        .when(strip(F.coalesce(content, F.lit(""))) == "", BAD_CONTENT)
        .when(~role.isin("human", "gpt"), UNSUPPORTED)
    )


def _row_error(talk: Column, message_error: Column, bad_system: Column) -> Column:
    first = F.get(F.filter(message_error, lambda e: e.isNotNull()), 0)
    starts = F.coalesce(F.get(talk, 0)["from"] == "human", F.lit(False))
    ends = F.coalesce(F.get(talk, F.size(talk) - 1)["from"] == "gpt", F.lit(False))
    return F.when(F.coalesce(F.size(talk), F.lit(0)) < 2, TOO_FEW).otherwise(F.coalesce(first, F.when(~(starts & ends), BAD_ENDS), F.when(bad_system, BAD_SYSTEM)))


def sample_errors(samples: DataFrame) -> DataFrame:
    """Adds ``error``, the code of the first broken rule of a row, null for valid rows.

    Rules in order: at least two messages; then message by message a role, text, and one of the
    two sides; first human and last gpt. Messages of one side may follow each other.
    """
    talk = F.col("conversations")
    errors = F.transform(talk, lambda m: _message_error(m["from"], m["value"]))
    return samples.withColumn("error", _row_error(talk, errors, F.lit(False)))


def json_sample_errors(rows: DataFrame, json_col: str = "json") -> DataFrame:
    """As ``sample_errors`` for raw JSON rows, where types are checked as well.

    A typed reader would turn numbers into text; here a role or text that is no string, a message
    that is no object, and a ``system`` that is neither null nor a string are errors. Adds
    ``system``, ``conversations`` and ``error``; a row that is no JSON object has no turns.
    """
    v = F.try_parse_json(json_col)

    def kind(value: Column, path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(value, path, "variant"))

    parts = F.when(kind(v, "$.conversations").startswith("ARRAY"), F.try_variant_get(v, "$.conversations", "array<variant>"))

    def message(m: Column) -> Column:
        def text(path: str) -> Column:
            return F.when(kind(m, path) == "STRING", F.try_variant_get(m, path, "string"))

        role, content = text("$.from"), text("$.value")
        error = F.when(~F.schema_of_variant(m).startswith("OBJECT"), NOT_OBJECT).otherwise(_message_error(role, content))
        return F.struct(role.alias("from"), content.alias("value"), error.alias("error"))

    found = rows.withColumn("_m", F.transform(parts, message))
    system = kind(v, "$.system")
    bad = F.coalesce(~system.isin("STRING", "VOID"), F.lit(False))
    talk = F.transform("_m", lambda m: F.struct(m["from"].alias("from"), m["value"].alias("value")))
    error = _row_error(F.col("_m"), F.transform("_m", lambda m: m["error"]), bad)
    return found.select(*rows.columns, F.when(system == "STRING", F.try_variant_get(v, "$.system", "string")).alias("system"), talk.alias("conversations"), error.alias("error"))


def error_counts(samples: DataFrame) -> DataFrame:
    """Rows (error, n_rows), valid rows under 'ok'."""
    found = samples if "error" in samples.columns else sample_errors(samples)
    return found.groupBy(F.coalesce("error", F.lit("ok")).alias("error")).agg(F.count("*").alias("n_rows"))


def dataset_stats(samples: DataFrame, *by: str) -> DataFrame:
    """Figures of a dataset, or of each file or group: counts, and sums from which means follow.

    Lengths are of stripped texts. Sums over messages are made inside each row, so messages are
    not exploded and one aggregate does all.
    """
    talk = F.col("conversations")
    def lengths(side: str) -> Column:
        return F.transform(F.filter(talk, lambda m: m["from"] == side), lambda m: F.length(strip(m["value"])).cast("long"))

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)

    n = F.size(talk).cast("long")
    rows = samples.select(*by, n.alias("n"), lengths("human").alias("u"), lengths("gpt").alias("a"))
    rows = rows.select(*by, "n", F.size("u").cast("long").alias("un"), total(F.col("u")).alias("us"), F.array_max("u").alias("um"), F.size("a").cast("long").alias("an"), total(F.col("a")).alias("as"), F.array_max("a").alias("am"))
    zero = F.lit(0).cast("long")
    return rows.groupBy(*by).agg(
        F.count("*").alias("examples"), F.min("n").alias("min_turns"), F.max("n").alias("max_turns"), F.coalesce(F.sum("n"), zero).alias("total_turns"),
        F.coalesce(F.sum("un"), zero).alias("user_messages"), F.coalesce(F.sum("us"), zero).alias("user_chars"), F.max("um").alias("max_user_chars"),
        F.coalesce(F.sum("an"), zero).alias("assistant_messages"), F.coalesce(F.sum("as"), zero).alias("assistant_chars"), F.max("am").alias("max_assistant_chars"),
    )


def validate_samples(samples: DataFrame, order: str | None = None) -> dict[str, Any]:
    """Raises for the first invalid row, in the order of a column if one is given; else figures.

    Means are rounded as Python rounds.
    """
    found = samples if "error" in samples.columns else sample_errors(samples)
    key = F.col(order) if order else F.monotonically_increasing_id()
    worst = found.where("error IS NOT NULL").select(key.alias("k"), "error").agg(F.min(F.struct("k", "error")).alias("e")).first()[0]
    if worst is not None:
        raise DatasetValidationError(f"row {worst[0]}: {worst[1]}")
    s = dataset_stats(samples).first()
    if not s.examples:
        raise DatasetValidationError("dataset is empty")
    return {
        "examples": s.examples, "min_turns": s.min_turns, "max_turns": s.max_turns, "avg_turns": round(s.total_turns / s.examples, 2),
        "avg_user_chars": round(s.user_chars / s.user_messages, 2), "avg_assistant_chars": round(s.assistant_chars / s.assistant_messages, 2),
        "max_user_chars": s.max_user_chars, "max_assistant_chars": s.max_assistant_chars,
    }
