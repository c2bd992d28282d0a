"""Message contracts: validation with the first failing reason, DLQ rows,
and the typed payload projections.

A raw message is bytes (Kafka ``value``). Checks run as one chain of
column expressions over a VARIANT parse, so a bad message never fails the
job; it gets an ``error`` and is routed to the dead-letter table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from moodstream.functions.text import is_blank
from moodstream.functions.time import iso_utc, parse_iso
from moodstream.schemas import SCHEMA_VERSION

# Error texts (prefixes of the reference's messages) and stages.
ERR_NOT_JSON = "not valid UTF-8 JSON"
ERR_NOT_OBJECT = "payload is not a JSON object"
ERR_VERSION = "unsupported schema_version"
ERR_NO_ID = "missing id"
ERR_NO_TEXT = "missing text"
ERR_KEYED = "payload is not an object with an id"
STAGE_SCORING = "consumer_prediction"
STAGE_JOIN = "consumer_join"

MAX_TEXT, MAX_SOURCE, MAX_SOURCE_ID = 5000, 64, 128
_INTEGRAL = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def payload_text(value) -> Column:
    """The message as text: null when the bytes are not valid UTF-8."""
    v = _c(value)
    return F.when(F.is_valid_utf8(v.cast("binary")), v.cast("binary").cast("string"))


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _type(v: Column, name: str) -> Column:
    return F.schema_of_variant(_field(v, name))


def _py_repr(v: Column, name: str) -> Column:
    """Python-style repr of a JSON field, for error texts."""
    t = _type(v, name)
    return F.when(t.isNull() | (t == "VOID"), F.lit("None")) \
        .when(t == "STRING", F.concat(F.lit("'"), F.try_variant_get(v, f"$.{name}", "string"), F.lit("'"))) \
        .when(t == "BOOLEAN", F.when(F.try_variant_get(v, f"$.{name}", "boolean"), F.lit("True"))
              .otherwise(F.lit("False"))) \
        .otherwise(F.to_json(_field(v, name)))


# Every check is null-safe: a missing field must fail the check, not
# turn it into NULL (which a CASE branch would silently skip).
def _version_ok(v: Column) -> Column:
    return F.coalesce(_type(v, "schema_version").isin(*_INTEGRAL) &
                      (F.try_variant_get(v, "$.schema_version", "bigint") == F.lit(SCHEMA_VERSION)), F.lit(False))


def _id_ok(v: Column) -> Column:
    return F.coalesce((_type(v, "id") == "STRING") & (F.length(F.try_variant_get(v, "$.id", "string")) > 0),
                      F.lit(False))


def _text_ok(v: Column) -> Column:
    return F.coalesce((_type(v, "text") == "STRING") & ~is_blank(F.try_variant_get(v, "$.text", "string")),
                      F.lit(False))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _whole(t: Column) -> Column:
    """The JSON text as VARIANT; null unless it is exactly one JSON value.

    The parser stops after the first value. As the only element of an array
    and the only field of an object, a text with anything after its value
    cannot pass both. A repeated key keeps its last value
    (``spark.sql.variant.allowDuplicateKeys``, set by ``get_spark``); the
    non-standard numbers ``NaN`` and ``Infinity`` are rejected."""
    alone = (F.json_array_length(F.concat(F.lit("["), t, F.lit("]"))) == 1) & \
        (F.size(F.json_object_keys(F.concat(F.lit('{"v":'), t, F.lit("}")))) == 1)
    return F.when(alone, F.try_parse_json(t))


def _parsed(value) -> Column:
    return _whole(payload_text(value))


def raw_error_of(v: Column) -> Column:
    """First failing check of the raw-review contract over a parsed VARIANT
    (null = unparsable), or null when valid:
    UTF-8 → JSON → object → schema_version 1 → non-empty id → non-blank text."""
    return F.when(v.isNull(), F.lit(ERR_NOT_JSON)) \
        .when(~_is_object(v), F.lit(ERR_NOT_OBJECT)) \
        .when(~_version_ok(v), F.concat(F.lit(ERR_VERSION + " "), _py_repr(v, "schema_version"))) \
        .when(~_id_ok(v), F.lit(ERR_NO_ID)) \
        .when(~_text_ok(v), F.lit(ERR_NO_TEXT))


def keyed_error_of(v: Column) -> Column:
    """Join-side contract: id is checked before schema_version; text is not
    checked."""
    return F.when(v.isNull(), F.lit(ERR_NOT_JSON)) \
        .when(~_is_object(v) | ~_id_ok(v), F.lit(ERR_KEYED)) \
        .when(~_version_ok(v), F.concat(F.lit(ERR_VERSION + " "), _py_repr(v, "schema_version")))


def raw_error(value) -> Column:
    return raw_error_of(_parsed(value))


def keyed_error(value) -> Column:
    return keyed_error_of(_parsed(value))


def prediction_error_of(v: Column) -> Column:
    """Alert-input contract: parse, version 1, id, label and a parsable
    ``predicted_at``. Failures are skipped (and counted), never DLQ'd."""
    ts = parse_iso(F.try_variant_get(v, "$.predicted_at", "string"))
    return F.when(v.isNull(), F.lit(ERR_NOT_JSON)) \
        .when(~_is_object(v), F.lit(ERR_NOT_OBJECT)) \
        .when(~_version_ok(v), F.lit(ERR_VERSION)) \
        .when(~_id_ok(v), F.lit(ERR_NO_ID)) \
        .when(F.try_variant_get(v, "$.label", "string").isNull(), F.lit("missing label")) \
        .when(ts.isNull(), F.lit("bad predicted_at"))


def prediction_error(value) -> Column:
    return prediction_error_of(_parsed(value))


def _fields_of(v: Column) -> list[Column]:
    g = lambda n, t="string": F.try_variant_get(v, f"$.{n}", t)
    return [
        g("schema_version", "int").alias("schema_version"),
        g("id").alias("id"),
        g("text").alias("text"),
        g("source").alias("source"),
        g("source_id").alias("source_id"),
        parse_iso(g("produced_at")).alias("produced_at"),
    ]


def _checked(messages: DataFrame, value_col: str, error_of, fields_of) -> DataFrame:
    """The message columns with ``error`` and typed fields, one parse per row.

    Text and VARIANT are columns of their own, and the result comes out of a
    generator over one struct: a later filter on ``error`` cannot be pushed
    below it, which would repeat the parse on both sides."""
    m = messages.select("*", payload_text(value_col).alias("_t"))
    m = m.select(*messages.columns, _whole(F.col("_t")).alias("_v"))
    v = F.col("_v")
    return m.select(*messages.columns, F.inline(F.array(F.struct(error_of(v).alias("error"), *fields_of(v)))))


def parse_raw(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Message frame → same rows with ``error`` and the typed raw fields
    (``schema_version, id, text, source, source_id, produced_at``)."""
    return _checked(messages, value_col, raw_error_of, _fields_of)


def parse_keyed(messages: DataFrame, value_col: str = "value") -> DataFrame:
    return _checked(messages, value_col, keyed_error_of, _fields_of)


def parse_predictions(messages: DataFrame, value_col: str = "value", observation: Observation | None = None) -> DataFrame:
    """Alert input: valid rows only (``predicted_at, label, id`` added).
    ``observation`` (optional) receives ``seen`` and ``skipped`` counts."""
    fields = lambda v: [
        parse_iso(F.try_variant_get(v, "$.predicted_at", "string")).alias("predicted_at"),
        F.try_variant_get(v, "$.label", "string").alias("label"),
        F.try_variant_get(v, "$.id", "string").alias("id"),
    ]
    checked = _checked(messages, value_col, prediction_error_of, fields)
    if observation is not None:
        checked = checked.observe(observation, F.count(F.lit(1)).alias("seen"), F.count("error").alias("skipped"))
    return checked.where(F.col("error").isNull()).drop("error")


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows) of a parsed frame. In a stream, write both
    from one ``foreachBatch`` over a persisted batch."""
    return parsed.where(F.col("error").isNull()), parsed.where(F.col("error").isNotNull())


def source_struct(topic="topic", partition="partition", offset="offset") -> Column:
    return F.struct(_c(topic).cast("string").alias("topic"), _c(partition).cast("int").alias("partition"),
                    _c(offset).cast("long").alias("offset"))


def to_dlq(rejected: DataFrame, stage: str = STAGE_SCORING, value_col: str = "value",
           error_col: str = "error", with_time: bool = True,
           error_prefix: str | None = None) -> DataFrame:
    """DLQ rows: original bytes decoded with replacement characters. The
    scoring stage prefixes contract errors with their exception type
    (``ValueError: ``); pass ``error_prefix=""`` for errors that carry it."""
    err = F.col(error_col)
    prefix = error_prefix if error_prefix is not None else ("ValueError: " if stage == STAGE_SCORING else "")
    if prefix:
        err = F.concat(F.lit(prefix), err)
    cols = [
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(stage).alias("stage"),
        err.alias("error"),
        F.make_valid_utf8(F.col(value_col).cast("binary")).alias("original_payload"),
        source_struct().alias("source"),
    ]
    if with_time:
        cols.append(F.current_timestamp().alias("failed_at"))
    return rejected.select(*cols)


def validate_incoming(df: DataFrame, text_col: str = "text", source_col: str = "source",
                      source_id_col: str = "source_id") -> DataFrame:
    """Ingest contract: text of 1..5000 characters (whitespace-only is
    allowed here), source ≤ 64 and source_id ≤ 128 characters. Adds
    ``rejected_reason`` (null when accepted)."""
    n = F.char_length(F.col(text_col))
    reason = F.when(F.col(text_col).isNull(), F.lit("text: missing")) \
        .when(n < 1, F.lit("text: too short")) \
        .when(n > MAX_TEXT, F.lit("text: too long")) \
        .when(F.char_length(F.col(source_col)) > MAX_SOURCE, F.lit("source: too long")) \
        .when(F.char_length(F.col(source_id_col)) > MAX_SOURCE_ID, F.lit("source_id: too long"))
    return df.withColumn("rejected_reason", reason)


def build_raw(incoming: DataFrame, id_expr: Column | None = None, produced_at: Column | None = None) -> DataFrame:
    """Accepted requests (``validate_incoming`` with no reason) as raw
    messages: a new id and the produce time added (a random UUID and now,
    unless given). The id is also the key of the message."""
    accepted = incoming.where(F.col("rejected_reason").isNull())
    return accepted.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        (id_expr if id_expr is not None else F.expr("uuid()")).cast("string").alias("id"),
        "text", "source", "source_id",
        (produced_at if produced_at is not None else F.current_timestamp()).alias("produced_at"),
    )


def prediction_payload(df: DataFrame, with_time: bool = True) -> DataFrame:
    """Prediction record: confidence and scores to 4 dp, inference_ms to 2."""
    cols = [
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.col("id"),
        F.col("label"),
        F.round("confidence", 4).alias("confidence"),
        F.transform_values("scores", lambda k, v: F.round(v, 4)).alias("scores"),
        F.col("model_version"),
        F.round("inference_ms", 2).alias("inference_ms"),
    ]
    if with_time:
        cols.append(F.current_timestamp().alias("predicted_at"))
    return df.select(*cols)


def to_json_value(df: DataFrame, key_col: str | None = "id", topic: str | Column | None = None) -> DataFrame:
    """``key, value[, topic]`` for a Kafka-style sink: UTF-8 JSON with nulls
    kept (default ``to_json`` drops them) and timestamps as UTC ISO text.
    ``topic``: a topic name, or a column that names each row's topic (left
    out of the value when it is one of the frame's)."""
    named = F.lit(topic) if isinstance(topic, str) and topic not in df.columns else _c(topic) if topic is not None else None
    cols = []
    for name, dtype in df.dtypes:
        if isinstance(topic, str) and name == topic:
            continue
        cols.append(iso_utc(name).alias(name) if dtype.startswith("timestamp") else F.col(name))
    value = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    key = F.col(key_col).cast("binary") if key_col else F.lit(None).cast("binary")
    out = [key.alias("key"), value.cast("binary").alias("value")]
    return df.select(*out, *([named.cast("string").alias("topic")] if named is not None else []))
