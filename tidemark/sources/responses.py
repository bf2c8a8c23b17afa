"""What both kinds of upstream response have in common.

A parsed response carries either a reading or the reason it has none.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Why a response gives no reading.
API_ERROR = "api_error"
BAD_VALUE = "bad_value"
MALFORMED = "malformed"
NO_ITEM = "no_item"
UNKNOWN_STRUCTURE = "unknown_structure"

REPORT_COLUMNS = ["reject_reason", "result_code", "result_msg"]

# Fixed value: how much of an unreadable payload a report shows.
EXCERPT_LENGTH = 200


PAYLOAD = "payload"


def kept_columns(responses: DataFrame, payload: str) -> list[str]:
    """What a parsed response keeps as it was; its payload is kept apart, if it is rejected."""
    return [c for c in responses.columns if c not in (payload, PAYLOAD)]


def report(
    reason: Column, code: Column, message: Column, payload: Column
) -> dict[str, Column]:
    """Columns that say why; code and message only for errors the source reports.

    The payload of a rejected response is kept whole, so that it can be looked
    into and parsed again; the excerpt is only for display.
    """
    told = reason == API_ERROR
    return {
        "reject_reason": reason,
        "result_code": F.when(told, code),
        "result_msg": F.when(told, message),
        "excerpt": F.when(reason == MALFORMED, F.substring(payload, 1, EXCERPT_LENGTH)),
        PAYLOAD: F.when(reason.isNotNull(), payload),
    }


def accepted(parsed: DataFrame) -> DataFrame:
    """Responses that gave a reading."""
    kept = parsed.filter(F.col("reject_reason").isNull())
    return kept.drop("excerpt", PAYLOAD, *REPORT_COLUMNS)


def rejected(parsed: DataFrame, *keep: str) -> DataFrame:
    """Responses that gave none: the columns to keep, the reason, an excerpt and the whole payload."""
    dropped = parsed.filter(F.col("reject_reason").isNotNull())
    return dropped.select(*keep, *REPORT_COLUMNS, "excerpt", PAYLOAD)


def reject_report(parsed: DataFrame, *by: str) -> DataFrame:
    """How many responses were rejected for what, with one excerpt of each kind."""
    kinds = rejected(parsed, *by).groupBy(*by, *REPORT_COLUMNS)
    return kinds.agg(F.min("excerpt").alias("excerpt"), F.count("*").alias("n"))
