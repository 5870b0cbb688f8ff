"""Event message validation as Column expressions (no UDF).

A message is a JSON text.  It is valid when it is one JSON object and

* every required field is present,
* none of them is null or the empty string (a single space passes),
* ``event_type`` is one of the domain values, exactly (case and spaces count),
* the integer value of ``quantity`` is > 0, where the integer value follows
  the loose rules of a dynamically typed reader: integers and integer strings
  (spaces around allowed) as they are, JSON numbers with a fraction truncated
  toward zero, booleans as 1/0, decimal strings / other text / objects invalid,
* ``currency`` is absent (it then defaults to USD) or one of the supported codes;
  an explicit null is invalid.

Parsing uses two views of the text: ``from_json(.., map<string,string>)`` keeps
"absent" apart from "null" and renders any value as text; a VARIANT parse,
done only for quantities that are not integer text, tells a JSON string from a
JSON number or boolean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.schemas import DEFAULT_CURRENCY, EVENT_TYPES, REQUIRED_EVENT_FIELDS, SUPPORTED_CURRENCIES

# Reason labels, in the order they are reported.
MALFORMED = "malformed"
MISSING_FIELD = "missing_field"
NULL_OR_BLANK = "null_or_blank"
BAD_EVENT_TYPE = "bad_event_type"
BAD_QUANTITY = "bad_quantity"
BAD_CURRENCY = "bad_currency"
REASONS = (MALFORMED, MISSING_FIELD, NULL_OR_BLANK, BAD_EVENT_TYPE, BAD_QUANTITY, BAD_CURRENCY)

_MAP = "_msg_map"
_TEXT = "_msg_text"


def with_parsed(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Add the parsed view (a string map) of a message text column.

    The text itself is kept alongside for the lazy VARIANT view of
    ``quantity_value``.  The parse runs inside a generator (``inline`` of a one-element array):
    the optimizer cannot substitute generated columns back into filters or
    later projections, so each text is parsed exactly once however many rules
    read the result.  Inputs are spread over the cores where they are read
    (``operators.partitioning.spread``), not here.
    """
    text = F.col(text_col).cast("string")
    # An object whose only closing brace is the last character ends there, and there is nothing to trim.
    # Most texts are so; the generator runs each use of the trimmed text anew, which took longer than the parse.
    plain = text.startswith("{") & text.endswith("}") & (
        F.octet_length(F.replace(text, F.lit("}"), F.lit(""))) == F.octet_length(text) - 1)
    bare = F.btrim(text, F.lit(" \t\n\r"))
    braced = bare.startswith("{") & bare.endswith("}")
    ends = (F.locate("}", bare) == F.char_length(bare)) | _one_value(bare)
    parsed = F.struct(F.when(plain | (braced & ends), F.from_json(text, "map<string,string>")).alias(_MAP))
    return (df.select("*", F.inline(F.array(parsed)))
              .withColumn("_msg_is_object", F.col(_MAP).isNotNull())
              .withColumn(_TEXT, text))


def _one_value(text: Column) -> Column:
    """The text is one JSON value with nothing after it.

    It is put into an array alone and before another element.  A text that
    closes the array early is as long in both; one value is one longer in the
    second.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    followed = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]")))
    return F.coalesce((alone == 1) & (followed == 2), F.lit(False))


def field(name: str) -> Column:
    return F.col(_MAP)[name]


def has(name: str) -> Column:
    return F.map_contains_key(F.col(_MAP), F.lit(name))


def _blank(name: str) -> Column:
    return has(name) & (field(name).isNull() | (field(name) == ""))


def quantity_value() -> Column:
    """Integer value of ``quantity`` under the loose typing rules (null if none).

    Integer text -- a JSON integer or a JSON string holding one -- is taken as
    is.  Only otherwise is the message parsed as VARIANT, to tell a JSON number
    (truncated) or boolean (1/0) from a JSON string (invalid); most messages
    never pay for that second parse.
    """
    text = field("quantity")
    var = F.try_parse_json(F.col(_TEXT))
    kind = F.schema_of_variant(F.variant_get(var, "$.quantity", "variant"))
    loose = (F.when(kind == "BOOLEAN", text.try_cast("boolean").cast("bigint"))
              .when(var.isNull() | (kind == "STRING"), F.lit(None).cast("bigint"))
              .otherwise(text.try_cast("double").try_cast("bigint")))
    return F.coalesce(text.try_cast("bigint"), loose)


def reason_flags() -> list[tuple[str, Column]]:
    """(reason, failed?) for every rule; a malformed text fails only that rule."""
    ok = F.col("_msg_is_object")
    missing = F.lit(False)
    for f in REQUIRED_EVENT_FIELDS:
        missing = missing | ~has(f)
    blank = F.lit(False)
    for f in REQUIRED_EVENT_FIELDS:
        blank = blank | _blank(f)
    etype = field("event_type")
    bad_type = has("event_type") & etype.isNotNull() & (etype != "") & ~etype.isin(*EVENT_TYPES)
    qty_present = has("quantity") & field("quantity").isNotNull() & (field("quantity") != "")
    q = quantity_value()
    bad_qty = qty_present & (q.isNull() | (q <= 0))
    cur = field("currency")
    bad_cur = has("currency") & (cur.isNull() | ~cur.isin(*SUPPORTED_CURRENCIES))
    return [
        (MALFORMED, ~ok),
        (MISSING_FIELD, ok & missing),
        (NULL_OR_BLANK, ok & blank),
        (BAD_EVENT_TYPE, ok & bad_type),
        (BAD_QUANTITY, ok & bad_qty),
        (BAD_CURRENCY, ok & bad_cur),
    ]


def is_valid() -> Column:
    """No rule fails.  One boolean, so a message costs no reason text unless someone reads it."""
    failed = F.lit(False)
    for _, rule in reason_flags():
        failed = failed | F.coalesce(rule, F.lit(False))
    return ~failed


def reject_reasons() -> Column:
    """array<string> of failed rules, empty for a valid message."""
    names = F.concat_ws(",", *[F.when(failed, F.lit(name)) for name, failed in reason_flags()])
    return F.when(names == "", F.array().cast("array<string>")).otherwise(F.split(names, ","))


def normalized_currency() -> Column:
    """Absent currency -> USD; a present one is kept as sent."""
    return F.when(has("currency"), field("currency")).otherwise(F.lit(DEFAULT_CURRENCY))


def classify(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Add ``reasons`` (array) and ``is_valid`` to a frame of message texts."""
    parsed = with_parsed(df, text_col)
    return parsed.withColumn("is_valid", is_valid()).withColumn("reasons", reject_reasons())


def bronze_fields() -> list[Column]:
    """The typed columns of a valid message."""
    return [
        field("event_id").alias("event_id"),
        field("customer_id").alias("customer_id"),
        field("product_id").alias("product_id"),
        field("event_type").alias("event_type"),
        field("timestamp").alias("timestamp"),
        quantity_value().alias("quantity"),
        normalized_currency().alias("currency"),
    ]


def to_bronze(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid messages -> typed Bronze rows (schema v1 and v2 share one shape).

    ``message`` is the text as sent, with the fields that have no column.
    """
    return classified.filter("is_valid").select(*keep, *bronze_fields(), F.col(_TEXT).alias("message"))


def judged(df: DataFrame, text_col: str = "value", reasons: bool = False) -> DataFrame:
    """``df`` with ``is_valid`` and ``event``, the typed columns of a valid message (null otherwise).

    Without the parsed view: what a frame holds that is read twice.  With ``reasons``
    also those of an invalid one, comma-joined (null otherwise), where many are invalid;
    they come from a generator like the parsed view, so that the rules run once a message
    and not once for each column that asks whether one failed.
    """
    parsed = with_parsed(df, text_col)
    if reasons:
        failed = F.concat_ws(",", *[F.when(rule, F.lit(name)) for name, rule in reason_flags()])
        parsed = parsed.select("*", F.inline(F.array(F.struct(F.nullif(failed, F.lit("")).alias("reasons")))))
        parsed = parsed.withColumn("is_valid", F.col("reasons").isNull())
    else:
        parsed = parsed.withColumn("is_valid", is_valid())
    return drop_parsed(parsed.withColumn("event", F.when(F.col("is_valid"), F.struct(*bronze_fields()))))


def typed(df: DataFrame, text_col: str = "message") -> DataFrame:
    """``df``, which has the ids of its texts, with their other typed columns; all texts are valid.

    A text holds them already, so what is dealt to other tasks need not carry them beside it.
    The id is the column that is there, so rows in its order stay in order.
    """
    text = F.col(text_col).cast("string")
    parsed = df.withColumns({_MAP: F.from_json(text, "map<string,string>"), _TEXT: text})
    return drop_parsed(parsed.select("*", *bronze_fields()[1:]))


def drop_parsed(df: DataFrame) -> DataFrame:
    return df.drop(_MAP, _TEXT, "_msg_is_object")
