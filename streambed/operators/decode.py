"""Messages to validated events.

A message is parsed once. It is wrapped as ``[message, {"#": hash of message}]`` so that
the parse also proves the text holds one JSON value and nothing more: text after the
first value breaks the array, adds an element, or cuts off the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import lenient_seconds, strict_seconds
from ..schemas import ENVELOPE_FIELDS, PAYLOAD_NUMBER_FIELDS, PAYLOAD_TEXT_FIELDS

# The reasons a message is rejected for, in the order they are tested.
INVALID_JSON = "invalid JSON"
MISSING_ID = "missing _event_id"
MISSING_TIME = "missing _event_timestamp"
INVALID_TIME = "invalid _event_timestamp"

_JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_TEXT_KINDS = "('STRING', 'VOID')"


def _sealed(text: Column, fields: str) -> Column:
    """Parse a JSON text into ``array<struct<fields, # bigint>>``; NULL on bad syntax."""
    wrapped = F.concat(
        F.lit("["), text, F.lit(',{"#":'), F.xxhash64(text).cast("string"), F.lit("}]")
    )
    return F.from_json(wrapped, f"array<struct<{fields}, `#` bigint>>", _JSON_OPTIONS)


def _parsed_once(rows: DataFrame, sealed: Column) -> DataFrame:
    """Add the parsed text as ``__doc``.

    A one-element explode, because a filter on what is read from the document would
    otherwise be pushed below the parse and repeat it.
    """
    return rows.select("*", F.explode(F.array(sealed)).alias("__doc"))


def _intact(text: Column, parsed: str) -> Column:
    seal = F.expr(f"get({parsed}, 1).`#`")
    return F.coalesce((F.size(parsed) == 2) & (seal == F.xxhash64(text)), F.lit(False))


def _text(path: str) -> Column:
    """A text field; JSON null and a missing field both read as empty."""
    return F.coalesce(F.expr(f"try_cast({path} AS string)"), F.lit(""))


def _is_text(path: str) -> Column:
    return F.coalesce(F.expr(f"schema_of_variant({path}) IN {_TEXT_KINDS}"), F.lit(True))


def _payload_types_hold(data: str) -> Column:
    """Whether a payload is an object whose known fields all have their declared type."""
    names = lambda fields: ", ".join(f"'{name}'" for name in fields)
    wrong = F.expr(
        f"""exists(map_entries(try_cast({data} AS map<string, variant>)), e ->
              (e.key IN ({names(PAYLOAD_TEXT_FIELDS)})
                AND schema_of_variant(e.value) NOT IN {_TEXT_KINDS})
              OR (e.key IN ({names(PAYLOAD_NUMBER_FIELDS)})
                AND NOT coalesce(
                  schema_of_variant(e.value) = 'VOID'
                  OR (schema_of_variant(e.value) NOT IN ('STRING', 'BOOLEAN')
                    AND abs(try_cast(e.value AS double)) < double('Infinity')),
                  false)))"""
    )
    return F.expr(f"{data} IS NULL OR schema_of_variant({data}) = 'VOID'") | F.coalesce(
        ~wrong, F.lit(False)
    )


def decode_events(messages: DataFrame, strict: bool = True) -> DataFrame:
    """Add the event columns and ``reason`` (NULL for a valid message) to messages.

    ``strict=False`` skips the type check of payload fields no job reads, which spares
    building the payload; every other check stays.
    """
    value = F.coalesce("value", F.lit(""))
    data = "variant" if strict else "struct<hashUID variant>"
    fields = ", ".join(f"{name} variant" for name in ENVELOPE_FIELDS) + f", _data {data}"
    parsed = _parsed_once(messages, _sealed(value, fields))
    env = "get(__doc, 0)"
    if strict:
        uid = f"try_variant_get({env}._data, '$.hashUID', 'variant')"
        payload_ok = _payload_types_hold(f"{env}._data")
    else:
        uid = f"{env}._data.hashUID"
        payload_ok = _is_text(uid)
    well_typed = _intact(value, "__doc") & payload_ok
    for name in ENVELOPE_FIELDS:
        well_typed = well_typed & _is_text(f"{env}.{name}")
    extracted = parsed.select(
        *messages.columns,
        well_typed.alias("__ok"),
        _text(f"{env}._event_id").alias("event_id"),
        _text(uid).alias("reference_id"),
        _text(f"{env}._event_timestamp").alias("__time"),
        _text(f"{env}._category").alias("category"),
        _text(f"{env}._event_type").alias("event_type"),
    ).withColumn("timestamp", strict_seconds(F.col("__time")))
    reason = (
        F.when(~F.col("__ok"), INVALID_JSON)
        .when(F.col("event_id") == "", MISSING_ID)
        .when(F.col("__time") == "", MISSING_TIME)
        .when(F.col("timestamp").isNull(), INVALID_TIME)
    )
    return extracted.select(
        *[c for c in messages.columns if c != "value"],
        "event_id", "reference_id", "timestamp", "category", "event_type",
        F.col("value").alias("payload"), reason.alias("reason"),
    )


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events, and ``value, reason`` of everything else."""
    events = decoded.where(F.col("reason").isNull()).drop("reason")
    rejects = decoded.where(F.col("reason").isNotNull()).select(
        F.col("payload").alias("value"), "reason"
    )
    return events, rejects


def parse_index_fields(
    lines: DataFrame, line_col: str = "line", strict_reference: bool = False
) -> DataFrame:
    """Replace a segment line by its index fields and a status.

    Status is ``malformed``, ``skipped`` (no event id or no reference) or ``ok``. Writers
    keep the reference inside the payload, so by default a missing top-level
    ``reference_id`` is filled from there; ``strict_reference=True`` reads only the
    top-level field. A time that cannot be read is 0 and flagged.
    """
    line = F.when(F.endswith(F.col(line_col), F.lit("\r")), F.regexp_replace(line_col, r"\r\z", "")).otherwise(F.col(line_col))
    fields = "_event_id variant, reference_id variant, _event_timestamp variant"
    names = ["_event_id", "reference_id", "_event_timestamp"]
    if not strict_reference:
        fields += ", _data struct<hashUID variant>"
    doc = "get(__doc, 0)"
    well_typed = _intact(line, "__doc")
    for name in names:
        well_typed = well_typed & _is_text(f"{doc}.{name}")
    reference = _text(f"{doc}.reference_id")
    if not strict_reference:
        inner = F.when(_is_text(f"{doc}._data.hashUID"), _text(f"{doc}._data.hashUID"))
        reference = F.when(reference != "", reference).otherwise(F.coalesce(inner, F.lit("")))
    kept = [c for c in lines.columns if c != line_col]
    extracted = _parsed_once(lines, _sealed(line, fields)).select(
        *kept,
        well_typed.alias("__ok"),
        _text(f"{doc}._event_id").alias("event_id"),
        reference.alias("reference_id"),
        _text(f"{doc}._event_timestamp").alias("__time"),
    ).withColumn("__strict", strict_seconds(F.col("__time")))
    status = (
        F.when(~F.col("__ok"), "malformed")
        .when((F.col("event_id") == "") | (F.col("reference_id") == ""), "skipped")
        .otherwise("ok")
    )
    return extracted.select(
        *kept, "event_id", "reference_id",
        lenient_seconds(F.col("__time"), F.col("__strict")).alias("ts"),
        (F.col("__strict").isNull() & ~F.col("__time").rlike(r"^[+-]?\d+\z"))
        .alias("time_unreadable"),
        status.alias("status"),
    )
