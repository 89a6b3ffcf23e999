"""Results of retrieve and store operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions.text import ColumnOrName, STATUS_PATTERN, UUID_PATTERN, abbreviated, blank_to_null, col, first_error, full_match, is_blank, trimmed
from scanloom.operators.routing import FAILURE, SUCCESS


def status_hex(status: ColumnOrName) -> Column:
    """Status as four hex digits."""
    return F.lpad(F.hex(col(status).cast("int").bitwiseAND(0xFFFF)), 4, "0")


def store_outcome(status: ColumnOrName) -> Column:
    """SUCCESS (0000), WARNING (0001, 0107, 0116, Bxxx) or FAILED."""
    s = col(status).cast("int")
    return (F.when(s == 0, "SUCCESS").when(s.isin(0x0001, 0x0107, 0x0116) | (s.bitwiseAND(0xF000) == 0xB000), "WARNING").otherwise("FAILED"))


def stored(outcome: ColumnOrName) -> Column:
    return F.coalesce(col(outcome) != "FAILED", F.lit(False))


def retrieve_summary(results: DataFrame, keys: list[str]) -> DataFrame:
    """Per request: counters and final status of its per-instance results.

    ``results(keys…, status, state)`` with state in completed, failed, warning, remaining.
    """
    def counter(state):
        return F.count_if(F.col("state") == state).alias(state)

    out = results.groupBy(*keys).agg(*[counter(s) for s in ("completed", "failed", "warning", "remaining")], F.max("status").alias("status"))
    ok = (F.col("status") == 0) & (F.col("failed") == 0) & (F.col("warning") == 0)
    text = F.concat(F.lit("C-GET failed: status=0x"), status_hex("status"), *[
        x for n in ("completed", "failed", "warning") for x in (F.lit(f", {n}="), F.col(n).cast("string"))])
    return (out.withColumn("route", F.when(ok, SUCCESS).otherwise(FAILURE)).withColumn("status_text", status_hex("status"))
            .withColumn("error_message", F.when(~ok, text)))


def strict_gate(df: DataFrame) -> DataFrame:
    """Accept a retrieval only when every recorded value is present, well formed and successful.

    Input columns are text, as recorded: order_id, study_uid, series_uid, retrieve_id, status,
    finished, completed, failed, warning, remaining, expected, find_count_instances. Adds
    gate_error (first violated rule), expected_instances and route.
    """
    def number(name):
        return trimmed(name).try_cast("int")

    required = ["order_id", "study_uid", "series_uid", "retrieve_id"]
    status = F.upper(trimmed("status"))
    remaining = F.when(is_blank("remaining"), F.lit(-1)).otherwise(number("remaining"))
    expected_text = F.coalesce(blank_to_null("expected"), blank_to_null("find_count_instances"))
    expected = expected_text.try_cast("int")

    def missing(name):
        return is_blank(name), f"Missing required attribute: {name}"

    def not_a_number(text):
        return F.concat(F.lit('For input string: "'), text, F.lit('"'))

    checks = [missing(n) for n in required]
    checks += [(~full_match(trimmed(n), UUID_PATTERN), F.concat(F.lit("Invalid UUID string: "), trimmed(n))) for n in ("order_id", "retrieve_id")]
    checks += [missing("status"), (~full_match(status, STATUS_PATTERN), F.concat(F.lit("Invalid C-GET status: "), status)),
               missing("finished"), (trimmed("finished") != "true", "C-GET has no final response")]
    for n in ("completed", "failed", "warning"):
        checks += [missing(n), (number(n).isNull(), not_a_number(trimmed(n))),
                   (number(n) < 0, F.concat(F.lit(f"Invalid C-GET counter {n}: "), number(n).cast("string")))]
    checks += [(remaining.isNull(), not_a_number(trimmed("remaining"))),
               (remaining < -1, F.concat(F.lit("Invalid C-GET remaining counter: "), remaining.cast("string")))]
    bad = (status != "0000") | (number("completed") == 0) | (number("failed") != 0) | (number("warning") != 0) | ~remaining.isin(0, -1)
    detail = F.concat(F.lit("C-GET not successful: status="), status, *[
        x for n in ("completed", "failed", "warning") for x in (F.lit(f", {n}="), number(n).cast("string"))],
        F.lit(", remaining="), remaining.cast("string"))
    checks += [(bad, detail), (expected_text.isNotNull() & expected.isNull(), not_a_number(expected_text)),
               (expected < 0, F.concat(F.lit("Invalid expected instance count: "), expected.cast("string")))]
    return (df.withColumn("gate_error", first_error(*checks)).withColumn("expected_instances", F.when(expected >= 0, expected))
            .withColumn("route", F.when(F.col("gate_error").isNull(), SUCCESS).otherwise(FAILURE)))


def failure_summary(results: DataFrame, keys: list[str]) -> DataFrame:
    """``CODE xN (first message); …`` per batch in order of first appearance, NULL if none failed.

    ``results(keys…, pos, outcome, error_code, message)``. Codes are reduced map-side; only one
    row per batch and code is ever brought together.
    """
    failed = results.withColumn("_failed", ~stored("outcome")).withColumn("_code", F.when(F.col("_failed"), F.coalesce("error_code", F.lit("UNKNOWN"))))
    said = F.when(~is_blank("message"), F.col("pos"))
    per_code = failed.groupBy(*keys, "_code").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("at"), F.min_by(F.when(said.isNotNull(), F.col("message")), said).alias("msg"))
    part = F.concat(F.col("_code"), F.lit(" x"), F.col("n").cast("string"),
                    F.when(F.col("msg").isNull(), "").otherwise(F.concat(F.lit(" ("), abbreviated("msg", 300), F.lit(")"))))
    entry = F.when(F.col("_code").isNotNull(), F.struct(F.col("at"), part.alias("text")))
    grouped = per_code.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_parts"))
    summary = F.when(F.size("_parts") > 0, F.array_join(F.transform("_parts", lambda p: p["text"]), "; "))
    return grouped.select(*keys, summary.alias("failure_summary"))


def destination_error(host="host", port="port", calling="calling_aet", called="called_aet") -> Column:
    """First violated rule of a store destination; a missing host means localhost."""
    text = F.coalesce(trimmed(port), F.lit(""))
    number = F.when(full_match(text, r"[+-]?[0-9]+"), text.try_cast("int"))

    def bad_title(c):
        return is_blank(c) | (F.length(col(c)) > 16)

    def shown(c):
        return F.coalesce(col(c), F.lit("null"))

    return first_error(
        (number.isNull(), F.concat(F.lit("port is not a number: '"), F.coalesce(col(port), F.lit("null")), F.lit("'"))),
        (col(host).isNotNull() & is_blank(host), "host must not be empty"),
        (~number.between(1, 65535), F.concat(F.lit("invalid port: "), number.cast("string"))),
        (bad_title(calling), F.concat(F.lit("invalid Calling AE Title: "), shown(calling))),
        (bad_title(called), F.concat(F.lit("invalid Called AE Title: "), shown(called))))


def with_destination(df: DataFrame) -> DataFrame:
    """Normalised destination columns, or error_code CONFIG_INVALID with the reason."""
    error = destination_error()
    ok = F.col("destination_error").isNull()
    return (df.withColumn("destination_error", error).withColumn("error_code", F.when(~ok, "CONFIG_INVALID"))
            .withColumn("destination", F.when(ok, F.concat(trimmed("called_aet"), F.lit("@"), F.coalesce(trimmed("host"), F.lit("localhost")),
                                                           F.lit(":"), trimmed("port").try_cast("int").cast("string"),
                                                           F.lit(" (calling "), trimmed("calling_aet"), F.lit(")")))))


def per_destination(df: DataFrame) -> DataFrame:
    """Number of instances and of invalid ones per destination."""
    return with_destination(df).groupBy("destination", "error_code").agg(F.count(F.lit(1)).alias("instances"))


def store_results(df: DataFrame) -> DataFrame:
    """Result row of each stored or failed instance; failed ones can be sent again.

    Needs outcome, status, error_code and message. Columns of the other outcome are NULL.
    """
    ok = stored("outcome")
    return (df.withColumn("store_status", F.when(ok | (F.col("status") >= 0), status_hex("status")))
            .withColumn("store_warning", F.when(F.col("outcome") == "WARNING", F.col("message")))
            .withColumn("store_error_code", F.when(~ok, F.col("error_code")))
            .withColumn("store_error", F.when(~ok, F.coalesce("message", "error_code")))
            .withColumn("retryable", ~ok).withColumn("route", F.when(ok, SUCCESS).otherwise(FAILURE)))


def move_results(df: DataFrame) -> DataFrame:
    """Details text of recorded move results.

    Needs finished (BOOLEAN), status (INT), message, destination_aet, took_ms. No final response
    means a time-out.
    """
    ok = F.coalesce(F.col("finished") & (F.col("status") == 0), F.lit(False))
    details = F.concat(F.lit("Destination_AET:"), F.col("destination_aet"), F.lit(" Status:"), status_hex("status"),
                       F.lit(" tookMs="), F.col("took_ms").cast("string"))
    error = (F.when(~F.coalesce(F.col("finished"), F.lit(False)), "C-MOVE timed out (no final response)")
             .otherwise(F.coalesce(F.col("message"), F.concat(F.lit("C-MOVE failed status="), F.col("status").cast("string")))))
    return (df.withColumn("move_details", F.when(ok, details)).withColumn("move_error", F.when(~ok, error))
            .withColumn("route", F.when(ok, SUCCESS).otherwise(FAILURE)))


def distinct_values(observations: DataFrame, keys: list[str], code: str = "code", value: str = "value") -> DataFrame:
    """Number of distinct non-blank trimmed values per key and code, and the value if it is single.

    A count and a minimum replace the collected set, so a frequent code is reduced map-side.
    """
    v = blank_to_null(value)
    out = (observations.withColumn("_v", v).groupBy(*keys, code)
           .agg(F.countDistinct("_v").alias("distinct_values"), F.min("_v").alias("_min")))
    return out.withColumn("single_value", F.when(F.col("distinct_values") == 1, F.col("_min"))).drop("_min")


def require_single(df: DataFrame, optional: bool = False, code: str = "code") -> DataFrame:
    """Error text where a code does not have exactly one (``optional``: at most one) value."""
    n = F.col("distinct_values")
    bad = (n > 1) if optional else (n != 1)
    wanted = "at most" if optional else "exactly"
    return df.withColumn("error_message", F.when(bad, F.concat(F.lit(f"Expected {wanted} one distinct value for "), F.col(code), F.lit(", found "), n.cast("string"))))
