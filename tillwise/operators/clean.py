"""Parsing and cleaning of JSON order messages; the same code serves batches and streams."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tillwise.functions.domains import STREAM_STATUSES, UNKNOWN_STATUS
from tillwise.functions.text import strip, to_number

REQUIRED = ("order_id", "client_id", "product_id", "total_amount", "status")
IDS = ("order_id", "client_id", "product_id")
OPTIONAL = ("order_date", "sent_at")
_MESSAGE = "array<struct<" + ",".join(f"{f}:string" for f in REQUIRED + OPTIONAL) + ">>"
_STRICT = {"allowSingleQuotes": "false"}


def _parse(text: Column) -> Column:
    """The message's objects as an array, NULL if it is no JSON.

    Read between brackets, so that anything left over after an object is an error.
    """
    bracketed = F.concat(F.lit("["), text, F.lit("]"))
    return F.when(F.is_valid_utf8(text), F.from_json(bracketed, _MESSAGE, _STRICT))


def _any_null(message: Column, fields: tuple[str, ...]) -> Column:
    return reduce(or_, (message[f].isNull() for f in fields))


def _lacks_field(text: Column, message: Column) -> Column:
    """A required field is absent. A field given as null is present; only messages in which
    something is null are parsed again to tell the two apart."""
    some_null = _any_null(message, REQUIRED)
    given = F.map_keys(F.from_json(text, "map<string,string>", _STRICT))
    return some_null & (F.size(F.array_except(F.array(*map(F.lit, REQUIRED)), given)) > 0)


def _fields(text: Column, message: Column, amount: Column, reject_nan: bool) -> Column:
    """The cleaned fields of a parsed message, and why it is not usable (else NULL)."""
    status = F.lower(strip(message["status"]))
    reason = (
        F.when(message.isNull(), "bad_json")
        .when(_lacks_field(text, message), "missing_field")
        .when(_any_null(message, IDS), "null_key")
        .when(amount.isNull(), "bad_amount")
        .when(amount < 0, "negative_amount"))
    if reject_nan:
        reason = reason.when(F.isnan(amount), "nan_amount")
    return F.struct(
        *(strip(message[f]).alias(f) for f in IDS),
        amount.alias("total_amount"),
        F.when(status.isin(*STREAM_STATUSES), status).otherwise(UNKNOWN_STATUS).alias("status"),
        *(F.try_to_timestamp(message[f]).alias(f) for f in OPTIONAL),
        reason.alias("reason"))


def assess(messages: DataFrame, reject_nan: bool = False) -> DataFrame:
    """Every message with its cleaned fields and, if it is not usable, the reason.

    ``messages`` has a text or binary column ``value``. The cleaned message is unfolded from an
    array of one, not projected: Spark would push a filter below a projection, and parse and clean
    the text once for the filter and once for the fields. A message must hold exactly one object.
    """
    text, objects = F.col("value").cast("string"), F.col("objects")
    message = F.when(F.size(objects) == 1, F.get(objects, F.lit(0)))
    fields = _fields(text, F.col("message"), F.col("amount"), reject_nan)
    return (messages.select("value", _parse(text).alias("objects"))
            .select("value", message.alias("message"))
            .select("value", "message", to_number(F.col("message.total_amount")).alias("amount"))
            .select("value", F.inline(F.array(fields))))


def accepted(assessed: DataFrame) -> DataFrame:
    """The usable orders, stamped with the processing time."""
    return (assessed.filter(F.col("reason").isNull()).drop("value", "reason")
            .withColumn("processed_at", F.current_timestamp()))


def rejected(assessed: DataFrame) -> DataFrame:
    """The other messages as they came, with the reason."""
    return assessed.filter(F.col("reason").isNotNull()).select("value", "reason")


def clean_orders(messages: DataFrame, reject_nan: bool = False) -> DataFrame:
    return accepted(assess(messages, reject_nan))


def rejected_orders(messages: DataFrame, reject_nan: bool = False) -> DataFrame:
    return rejected(assess(messages, reject_nan))
