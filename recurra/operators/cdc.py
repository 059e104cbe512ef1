"""CDC decoding (C1-C15): wire messages -> typed change rows.

One ``from_json`` per message parses the envelope in both shapes (root or
wrapped in ``payload``) with an ``after`` struct holding the union of all
tables' columns as text; per-table projections then type the columns from the
declared schemas. No Python runs per row; the whole decode is codegen'd
expressions and works unchanged on a stream.

``decode`` splits the input into
  ok          parsed, with an ``after`` image and the required keys
  deletes     parsed, no ``after`` image (the reference writers skip these)
  dead_letter unparseable messages and log rows missing a required key

``route`` judges every change for each sink apart, in one typed pass (``judge``):
a row that the log must refuse (no required key, a date, time or number that
cannot be decoded) may still reach the merchant state, which asks for a merchant
only, and is a dead letter as well. Money that cannot be decoded is null in the
log, as a gap in an amount must not lose the event, and a dead letter too. So no
wrong value is silently null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, StringType,
                               StructField, StructType, TimestampNTZType)

from recurra import schemas
from recurra.functions.decode import (decode_decimal, decode_epoch_date, decode_flag,
                                      decode_timestamp)

# Defaults for absent envelope fields.
DEFAULT_OP = "u"
DEFAULT_TABLE = "unknown"
DEFAULT_TS_MS = 0


def _text_schema(table: str) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schemas.TABLES[table][0].fields])


_SOURCE = StructType([StructField("table", StringType(), True), StructField("db", StringType(), True)])
# ``before``/``after`` are kept as JSON text at this stage: the row images are
# parsed later, once, with the schema of their own table.
ENVELOPE = StructType([
    StructField("before", StringType(), True),
    StructField("after", StringType(), True),
    StructField("source", _SOURCE, True),
    StructField("op", StringType(), True),
    StructField("ts_ms", StringType(), True),
])
WIRE = StructType(ENVELOPE.fields + [StructField("payload", ENVELOPE, True),
                                     StructField("_corrupt", StringType(), True)])


def processing_time() -> Column:
    """Current time as TIMESTAMP_NTZ in UTC wall clock, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def evaluate_once(df: DataFrame, keep: list[str], **exprs: Column) -> DataFrame:
    """Project ``exprs`` so that each is computed once per row.

    A filter over a plain projection is pushed below it with the expression
    substituted for every reference, so an expensive expression (a JSON
    parse) would run again for each predicate that reads it. Evaluating it
    in a one-row generator keeps it below the filters, computed once.
    """
    row = F.struct(*[e.alias(k) for k, e in exprs.items()])
    return df.select(*keep, F.inline(F.array(row)))


def parse_envelope(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row per message with table, op, ts_ms, before and
    after (JSON text), has_after, corrupt. Other input columns (topic,
    offsets, ...) are kept."""
    v = F.col(value)
    keep = list(raw.columns)
    j = evaluate_once(raw, keep, _j=F.from_json(v, WIRE, {"mode": "PERMISSIVE",
                                                          "columnNameOfCorruptRecord": "_corrupt"}))
    wrapped = F.col("_j.payload").isNotNull()

    def pick(field: str) -> Column:
        return F.when(wrapped, F.col("_j.payload." + field)).otherwise(F.col("_j." + field))

    after = pick("after")
    # an empty image ('{}', '{ }', null) is no image
    empty = F.coalesce(after.rlike(r"^\s*(\{\s*\}|null)\s*$"), F.lit(False))
    has_after = after.isNotNull() & ~empty
    corrupt = (v.isNull() | (F.trim(v) == "") | F.col("_j").isNull()
               | F.col("_j._corrupt").isNotNull())
    return j.select(
        *keep,
        F.coalesce(pick("source.table"), F.lit(DEFAULT_TABLE)).alias("table"),
        F.coalesce(pick("op"), F.lit(DEFAULT_OP)).alias("op"),
        F.coalesce(pick("ts_ms").try_cast("bigint"), F.lit(DEFAULT_TS_MS).cast("bigint")).alias("ts_ms"),
        pick("before").alias("before"),
        after.alias("after"),
        has_after.alias("has_after"),
        corrupt.alias("corrupt"),
        processing_time().alias("processed_at"),
    )


class Decoded(NamedTuple):
    ok: DataFrame
    deletes: DataFrame
    dead_letter: DataFrame


def _required_fields() -> list[str]:
    out: list[str] = []
    for cols in schemas.REQUIRED.values():
        out += [c for c in cols if c not in out]
    return out


_REQUIRED_ROW = StructType([StructField(c, StringType(), True) for c in _required_fields()])


def _missing_required(keys: Column) -> Column:
    """First REQUIRED log column absent or null in the image, else null.
    ``keys`` is the image parsed with the key columns only (ids are text)."""
    out = None
    for table, cols in schemas.REQUIRED.items():
        for c in cols:
            cond = (F.col("table") == table) & keys[c].isNull()
            out = F.when(cond, F.lit(c)) if out is None else out.when(cond, F.lit(c))
    return out


def decode(raw: DataFrame, value: str = "value") -> Decoded:
    """Split messages into changes, deletes and dead letters in one pass.

    Dead letters are unparseable messages (C8) and log rows missing a
    REQUIRED key (C13); both keep the received text and a reason.
    """
    return split(parse_envelope(raw, value), value)


def split(envelope: DataFrame, value: str = "value") -> Decoded:
    """``decode`` on an already parsed envelope (e.g. a persisted micro-batch)."""
    e = envelope
    e = evaluate_once(e, e.columns, _k=F.from_json(F.col("after"), _REQUIRED_ROW))
    e = e.withColumn("_missing", F.when(~F.col("corrupt") & F.col("has_after"), _missing_required(F.col("_k"))))
    derived = {"table", "op", "ts_ms", "before", "after", "has_after", "corrupt", "processed_at", "_k", "_missing"}
    passthrough = [c for c in e.columns if c != value and c not in derived]
    dead = e.filter(F.col("corrupt") | F.col("_missing").isNotNull()).select(
        *passthrough, F.when(F.col("corrupt"), F.lit(None).cast("string")).otherwise(F.col("table")).alias("table"),
        F.col(value).alias("value"),
        F.when(F.col("corrupt"), F.lit("unparseable"))
         .otherwise(F.concat(F.lit("missing_required:"), F.col("_missing"))).alias("reason"),
        "processed_at")
    parsed = e.filter(~F.col("corrupt"))
    deletes = parsed.filter(~F.col("has_after")).select(
        *passthrough, "table", "op", "ts_ms", "before", "processed_at")
    ok = parsed.filter(F.col("has_after") & F.col("_missing").isNull()).select(
        *passthrough, "table", "op", "ts_ms", "before", "after", "processed_at")
    return Decoded(ok, deletes, dead)


def decode_column(text: Column, dtype) -> Column:
    """The decoder for a target type."""
    if isinstance(dtype, DateType):
        return decode_epoch_date(text)
    if isinstance(dtype, DecimalType):
        return decode_decimal(text, dtype.precision, dtype.scale)
    if isinstance(dtype, BooleanType):
        return decode_flag(text)
    if isinstance(dtype, TimestampNTZType):
        return decode_timestamp(text)
    if isinstance(dtype, IntegerType):
        return text.try_cast("int")
    return text


def normalise(ok: DataFrame, table: str) -> DataFrame:
    """Rows of ``table`` typed by its declared schema, with the
    CDC columns (operation, processing time, CDC position)."""
    schema = schemas.TABLES[table][0]
    rows = ok.filter(F.col("table") == table)
    parsed = evaluate_once(rows, ["op", "processed_at", "ts_ms"],
                           _a=F.from_json(F.col("after"), _text_schema(table)))
    cols = [decode_column(F.col("_a." + f.name), f.dataType).alias(f.name) for f in schema.fields]
    return parsed.select(*cols, F.col("op").alias("cdc_operation"),
                         F.col("processed_at").alias("cdc_timestamp"),
                         F.col("ts_ms").alias("cdc_ts_ms"))


# ------------------------------------------------------------------ one pass, several labels

STATE_TABLES = ("merchants", "subscriptions", "payment_attempts")
_OWN = ("table", "op", "ts_ms", "before", "after", "has_after", "corrupt", "processed_at")
class Routed(NamedTuple):
    logs: dict[str, DataFrame]        # log table -> the rows that it takes
    state: dict[str, DataFrame]       # source table -> the rows that the merchant state takes
    deletes: DataFrame
    dead_letter: DataFrame


def _passthrough(envelope: DataFrame, value: str) -> list[str]:
    return [c for c in envelope.columns if c not in (*_OWN, value)]


def _image(table: str) -> str:
    return f"row_{table}"


def judge(envelope: DataFrame, value: str = "value") -> DataFrame:
    """Every message that a sink may take, typed once (C3-C7), with its verdicts.

    One pass over the envelope serves all tables and sinks. The image of a
    change is in the column of its table, ``row_<table>``; the other columns of
    that kind are null, and so are all of a delete or an unparseable message.

    missing    the first REQUIRED column without a value (C13), else null
    errors     the columns whose received value cannot be decoded
    to_log     whether the event log takes the row
    to_state   whether the merchant state takes it (C12: it names a merchant)
    value      the received text of a message that is a dead letter, else null
    """
    own = [*_passthrough(envelope, value), "table", "op", "ts_ms", "processed_at", "corrupt", "has_after"]
    changed = ~F.col("corrupt") & F.col("has_after")
    of = {t: changed & (F.col("table") == t) for t in schemas.TABLES}
    rows = envelope.filter(F.col("corrupt") | ~F.col("has_after") | F.col("table").isin(*schemas.TABLES))
    before = F.when(~F.col("has_after"), F.col("before")).alias("before")
    rows = evaluate_once(rows, [*own, before, value],
                         **{"_a_" + t: F.when(is_of, F.from_json(F.col("after"), _text_schema(t))) for t, is_of in of.items()})

    def typed(table: str) -> Column:
        return F.struct(*[decode_column(F.col(f"_a_{table}.{f.name}"), f.dataType).alias(f.name)
                          for f in schemas.TABLES[table][0].fields])

    rows = evaluate_once(rows, [*own, "before", value, *["_a_" + t for t in of]],
                         **{_image(t): F.when(is_of, typed(t)) for t, is_of in of.items()})

    def undecodable(table: str, lenient: bool) -> Column:
        names = [F.when(F.col(f"_a_{table}.{f.name}").isNotNull() & F.col(f"{_image(table)}.{f.name}").isNull(), F.lit(f.name))
                 for f in schemas.TABLES[table][0].fields
                 if not isinstance(f.dataType, (StringType, BooleanType)) and isinstance(f.dataType, DecimalType) is lenient]
        return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")

    def by_table(of_one: Callable[[str], Column], otherwise: Column) -> Column:
        out = otherwise
        for t, is_of in of.items():
            out = F.when(is_of, of_one(t)).otherwise(out)
        return out

    none, no_text = F.array().cast("array<string>"), F.lit(None).cast("string")
    rows = evaluate_once(rows, [*own, "before", value, *[_image(t) for t in of]],
                         missing=by_table(lambda t: F.coalesce(*[F.when(F.col(f"{_image(t)}.{c}").isNull(), F.lit(c))
                                                                 for c in schemas.REQUIRED.get(t, ())], no_text), no_text),
                         _refused=by_table(lambda t: undecodable(t, False), none),
                         _nulled=by_table(lambda t: undecodable(t, True), none),
                         _merchant=by_table(lambda t: F.col(f"{_image(t)}.merchant_id"), no_text))
    logged, in_state = F.col("table").isin(*schemas.LOG_TABLES), F.col("table").isin(*STATE_TABLES)
    dead = F.col("corrupt") | F.col("missing").isNotNull() | (F.size("_refused") > 0) | (F.size("_nulled") > 0)
    return rows.select(
        *own, "before", *[_image(t) for t in of], "missing", F.concat("_refused", "_nulled").alias("errors"),
        (changed & logged & F.col("missing").isNull() & (F.size("_refused") == 0)).alias("to_log"),
        (changed & in_state & F.coalesce(F.col("_merchant") != "", F.lit(False))).alias("to_state"),
        F.when(dead, F.col(value)).alias("value"))


def route(envelope: DataFrame, judged: DataFrame | None = None, value: str = "value") -> Routed:
    """The rows of every sink. ``judged`` is the (written) result of ``judge`` for the envelope."""
    judged = judge(envelope, value) if judged is None else judged
    passthrough = _passthrough(envelope, value)

    def rows(table: str, verdict: str) -> DataFrame:
        return judged.filter((F.col("table") == table) & F.col(verdict)).select(
            f"{_image(table)}.*", F.col("op").alias("cdc_operation"), F.col("processed_at").alias("cdc_timestamp"),
            F.col("ts_ms").alias("cdc_ts_ms"))

    reason = F.when(F.col("corrupt"), F.lit("unparseable")) \
        .when(F.col("missing").isNotNull(), F.concat(F.lit("missing_required:"), "missing")) \
        .otherwise(F.concat(F.lit("undecodable:"), F.array_join("errors", ",")))
    dead = judged.filter("corrupt OR value IS NOT NULL").select(
        *passthrough, F.when(~F.col("corrupt"), F.col("table")).alias("table"), "value", reason.alias("reason"), "processed_at")
    deletes = judged.filter("NOT corrupt AND NOT has_after").select(
        *passthrough, "table", "op", "ts_ms", "before", "processed_at")
    return Routed({log: rows(t, "to_log") for t, log in schemas.LOG_TABLES.items()},
                  {t: rows(t, "to_state") for t in STATE_TABLES}, deletes, dead)


def log_tables(ok: DataFrame, tables: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """K1 routing: log table -> typed rows. Unknown tables and ``merchants``
    (state only) get no log."""
    return {schemas.LOG_TABLES[t]: normalise(ok, t) for t in (tables or schemas.LOG_TABLES)}


def entity_key(table_col: Column, image: Column) -> Column:
    """Primary key of the row in a JSON image (``before`` of a delete)."""
    out = None
    for table, (_, key, _) in schemas.TABLES.items():
        k = F.get_json_object(image, f"$.{key}")
        out = F.when(table_col == table, k) if out is None else out.when(table_col == table, k)
    return out


def route_topic(topic: Column, prefix: str, db: str) -> Column:
    """C16: '<prefix>.<db>.<table>' -> '<prefix>.<table>.cdc'; others unchanged."""
    pattern = "^" + prefix.replace(".", r"\.") + r"\." + db.replace(".", r"\.") + r"\.(.*)$"
    return F.regexp_replace(topic, pattern, prefix + ".$1.cdc")


def topic_table(topic: Column) -> Column:
    """Table named by a routed topic '<prefix>.<table>.cdc'."""
    return F.regexp_extract(topic, r"\.([^.]+)\.cdc$", 1)
