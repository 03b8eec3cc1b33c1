"""Contract-checked ingest (SRC-4..7), batch envelopes, idempotent append, wide->core.

Records arrive as JSON text (one per line, as posted by a collector or
spilled to a JSONL buffer).  ``parse_records`` applies the record contract:
required identity fields, an ISO-8601 timestamp (or seconds or milliseconds
since 1970), optional measures that are numbers or text holding one.
Every line ends up in exactly one of two outputs: ``valid`` (typed rows) or
``quarantine`` (raw text + reasons).  Blank lines are dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..session import cut_lineage, materialize

CORRUPT = "_corrupt_record"
SENSOR_REQUIRED_FIELDS = ["machine_id", "line_id", "station_id", "timestamp"]
PRODUCTION_REQUIRED_FIELDS = ["line_id", "station_id", "timestamp"]


_ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?\s?(Z|z|[+-]\d{2}(:?\d{2})?)?)?$"
_EPOCH = r"^[+-]?\d+(\.\d+)?$"
#: Numbers from here on are milliseconds.
_MILLISECONDS_FROM = 2e10


def wire_schema(schema: T.StructType) -> T.StructType:
    """The JSON side: everything travels as text and is converted explicitly, so that one bad field names itself."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def parse_time(text: Column) -> Column:
    """Timestamp of a full ISO-8601 date or date and time, or of a number of (milli)seconds since 1970; else null.

    A time without a date, a month without a day and the like are no
    timestamps: a cast would complete them from today's date.
    """
    text = F.trim(text)
    number = text.try_cast("double")
    seconds = F.when(F.abs(number) >= _MILLISECONDS_FROM, number / 1000).otherwise(number)
    epoch = F.when(text.rlike(_EPOCH) & (F.abs(number) < 2.5e14), F.timestamp_micros((seconds * 1_000_000).cast("long")))
    return F.when(text.rlike(_ISO_TIME), text.try_cast("timestamp")).otherwise(epoch)


def _is_number(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StringType, T.TimestampType))


def classify_records(lines: DataFrame, schema: T.StructType, required: list[str],
                     text_col: str = "value", arrival: Column | None = None) -> DataFrame:
    """One pass over raw JSON lines: typed fields + ``reject_reasons`` + ``is_valid``.

    ``arrival`` is the ``created_at`` of records that bring none: the time they are stored
    (``parse_records`` takes the current time), which first-write-wins and the delay rule order by.

    Sinks write valid rows and quarantine rows from this one frame (e.g.
    ``partitionBy("is_valid")`` or two writes of a persisted micro-batch), so
    each line is parsed once.  Filtering right here would be pushed below the
    parse and repeat it for every condition.
    """
    wire = wire_schema(schema).add(CORRUPT, T.StringType())
    text = F.col(text_col)
    extra = [c for c in lines.columns if c != text_col]
    base = lines.where(F.trim(text) != "")
    # One parse per line; a line that is not a JSON object lands in the corrupt column.
    parsed = (base.select(*extra, F.from_json(text, wire, {"mode": "PERMISSIVE",
                                                           "columnNameOfCorruptRecord": CORRUPT}).alias("_r"),
                          text.alias("raw_record"))
              .withColumn("_malformed", F.col("_r").isNull() | F.col(f"_r.{CORRUPT}").isNotNull()))
    # One step for each layer of conversions: a later step names a column of an earlier one more than
    # once, so the layers are not folded into one expression that repeats itself.
    names = schema.fieldNames()
    numbers = [f.name for f in schema.fields if _is_number(f.dataType)]
    texts = parsed.select(*extra, "raw_record", "_malformed", *[F.col(f"_r.{n}").alias(f"_t_{n}") for n in names],
                          *[F.col(f"_r.{n}").try_cast("double").alias(f"_d_{n}") for n in numbers])
    finite = {n: F.when(F.abs(F.col(f"_d_{n}")) < float("inf"), F.col(f"_d_{n}")) for n in numbers}  # NaN isn't either
    typed = {}
    for f in schema.fields:
        if f.name not in finite:
            typed[f.name] = parse_time(F.col(f"_t_{f.name}")) if isinstance(f.dataType, T.TimestampType) else F.col(f"_t_{f.name}")
        elif isinstance(f.dataType, T.DoubleType):
            typed[f.name] = finite[f.name]
        else:  # 12 and 12.0, not 12.5; a text of digits keeps more of them than a double holds
            d = F.col(f"_d_{f.name}")
            whole = F.coalesce(F.col(f"_t_{f.name}").try_cast("long"), F.when(d == F.floor(d), d.try_cast("long")))
            typed[f.name] = whole.try_cast(f.dataType.simpleString())
    if set(names) & set(extra):
        raise ValueError(f"columns carried along have names of the record's: {sorted(set(names) & set(extra))}")
    steps = texts.withColumns(typed)
    good = ~F.col("_malformed")
    reasons = [F.when(F.col("_malformed"), F.lit("malformed_json"))]
    for r in required:
        reasons.append(F.when(good & F.col(f"_t_{r}").isNull(), F.lit(f"missing_{r}")))
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            continue
        # infinities and NaN are numbers, and missing
        bad = F.col(f"_d_{f.name}").isNull() if isinstance(f.dataType, T.DoubleType) else F.col(f.name).isNull()
        reasons.append(F.when(good & F.col(f"_t_{f.name}").isNotNull() & bad, F.lit(f"invalid_{f.name}")))
    stored = {n: F.col(n) for n in names}
    if arrival is not None and "created_at" in stored:
        stored["created_at"] = F.coalesce("created_at", arrival)
    return (steps.select(*extra, "raw_record", *[c.alias(n) for n, c in stored.items()],
                         F.array_compact(F.array(*reasons)).alias("reject_reasons"))
            .withColumn("is_valid", F.size("reject_reasons") == 0))


def parse_records(lines: DataFrame, schema: T.StructType, required: list[str],
                  text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split raw JSON lines into (valid typed rows, quarantine rows with reasons)."""
    c = classify_records(lines, schema, required, text_col, F.current_timestamp())
    extra = [x for x in lines.columns if x != text_col]
    valid = c.where("is_valid").select(*extra, *schema.fieldNames())
    quarantine = c.where("not is_valid").select(*extra, "raw_record", "reject_reasons")
    return valid, quarantine


def to_json_lines(df: DataFrame, ts_format: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                  keep: list[str] | None = None) -> DataFrame:
    """Rows -> one JSON object per line (timestamps as ISO text); nulls omitted.

    ``keep`` columns are carried next to the text (default: ``id`` if present).
    """
    cols = [F.date_format(F.col(f.name), ts_format).alias(f.name) if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    keep = keep if keep is not None else [c for c in ["id"] if c in df.columns]
    return df.select(F.to_json(F.struct(*cols)).alias("value"), *keep)


# ------------------------------------------------------------------ SRC-6
def dedupe_batch(incoming: DataFrame, key: str = "event_id", arrival: list[str] | None = None) -> DataFrame:
    """First write wins inside a batch: one row per non-null key, earliest arrival.

    An aggregate (``min_by``) rather than a window: a key sent a million times
    is reduced map-side, never sorted whole in one task.  Rows with a null key
    all pass.
    """
    arrival = arrival or ["created_at", "id"]
    keyed = incoming.where(F.col(key).isNotNull())
    others = [c for c in incoming.columns if c != key]
    first = (keyed.groupBy(key)
             .agg(F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(a) for a in arrival]))
                  .alias("_r"))
             .select(key, "_r.*"))
    return first.unionByName(incoming.where(F.col(key).isNull()).select(key, *others))


def idempotent_append(target: DataFrame, incoming: DataFrame, key: str = "event_id",
                      arrival: list[str] | None = None) -> DataFrame:
    """Rows of ``incoming`` to append: batch-deduplicated, keys already stored dropped."""
    batch = dedupe_batch(incoming, key, arrival)
    keyed = batch.where(F.col(key).isNotNull()).join(
        target.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return keyed.unionByName(batch.where(F.col(key).isNull()))


# ------------------------------------------------------------------ SRC-5
ENVELOPE_KEYS = ("sensor_readings", "production_events")


_ENVELOPE = T.StructType([T.StructField(k, T.ArrayType(T.StringType())) for k in ENVELOPE_KEYS] + [
    T.StructField(CORRUPT, T.StringType())])


def classify_envelopes(envelopes: DataFrame, text_col: str = "value",
                       arrival: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``{sensor_readings: [...], production_events: [...]}`` -> (sensor, production, bad envelopes).

    The first two are ``classify_records`` of the records inside, so each is
    held against the record contract; the third has the envelopes that are no
    such object, with ``raw_record`` and ``reject_reasons``.  An envelope's
    other columns go along as the struct ``envelope``: a record may have fields of the same name.
    """
    extra = [c for c in envelopes.columns if c != text_col]
    parsed = envelopes.select(_carried(extra), F.col(text_col).alias("raw_record"), F.from_json(
        F.col(text_col), _ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_e"))
    parsed = parsed.withColumn("_bad", F.col("_e").isNull() | F.col(f"_e.{CORRUPT}").isNotNull())
    # written once: three outputs read it, and each filter would be pushed below the parse and repeat it
    parsed = materialize(parsed.select("envelope", F.when(F.col("_bad"), F.col("raw_record")).alias("raw_record"),
                                       *[F.col(f"_e.{k}").alias(f"_{k}") for k in ENVELOPE_KEYS], "_bad"), "envelopes")
    is_bad = F.col("_bad")

    def records(key: str) -> DataFrame:
        # elements are kept as JSON text; a null element is a record without fields
        return parsed.where(~is_bad).select("envelope", F.explode(f"_{key}").alias("value")).withColumn(
            "value", F.coalesce("value", F.lit("null")))

    bad = parsed.where(is_bad).select("envelope", "raw_record", F.array(F.lit("malformed_envelope")).alias("reject_reasons"))
    return (classify_records(records("sensor_readings"), S.SENSOR_SCHEMA, SENSOR_REQUIRED_FIELDS, arrival=arrival),
            classify_records(records("production_events"), S.PRODUCTION_SCHEMA, PRODUCTION_REQUIRED_FIELDS, arrival=arrival), bad)


def _carried(extra: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in extra] or [F.lit(0).alias("_none")]).alias("envelope")


def unpack_envelopes(envelopes: DataFrame, text_col: str = "value") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(valid sensor rows, valid production rows, counts per envelope, quarantine).

    Rows and the quarantine name their envelope by the struct ``envelope``; the
    counts of accepted and rejected records have its columns.  The quarantine
    has bad records and bad envelopes with their raw text and reasons; ``kind`` tells which.
    """
    extra = [c for c in envelopes.columns if c != text_col]
    sensor, production, bad = classify_envelopes(envelopes, text_col, F.current_timestamp())
    # written once: valid rows, counts and the quarantine are filters of them, and would parse again for each condition
    sensor, production = materialize(sensor, "sensor_records"), materialize(production, "production_records")
    both = sensor.select("envelope", "is_valid", F.lit(1).alias("s")).unionByName(
        production.select("envelope", "is_valid", F.lit(0).alias("s")))
    counted = both.groupBy("envelope").agg(
        F.count_if(F.col("is_valid") & (F.col("s") == 1)).alias("sensor_count"),
        F.count_if(F.col("is_valid") & (F.col("s") == 0)).alias("production_count"),
        F.count_if(~F.col("is_valid")).alias("rejected_count"))
    # envelopes without a record count too
    counted = envelopes.select(_carried(extra)).distinct().join(counted, "envelope", "left").fillna(
        0, ["sensor_count", "production_count", "rejected_count"])
    counted = counted.select(*[F.col(f"envelope.{c}").alias(c) for c in extra], "sensor_count", "production_count", "rejected_count")
    quarantine = reduce(DataFrame.unionByName, [
        df.select(F.lit(kind).alias("kind"), "envelope", "raw_record", "reject_reasons") for kind, df in (
            ("sensor_reading", sensor.where("not is_valid")), ("production_event", production.where("not is_valid")), ("envelope", bad))])

    def valid(df: DataFrame, schema: T.StructType) -> DataFrame:
        return df.where("is_valid").select("envelope", *schema.fieldNames())

    return valid(sensor, S.SENSOR_SCHEMA), valid(production, S.PRODUCTION_SCHEMA), counted, quarantine


def replay_quarantine(target: DataFrame, quarantine: DataFrame, schema: T.StructType, required: list[str],
                      mend: Column | None = None, key: str = "event_id",
                      arrival: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """SRC-7 / ST-10: (rows to append, still bad) of a replay of spilled or quarantined records.

    ``quarantine`` has ``raw_record``; ``mend`` is an expression of it that
    repairs the text (none: as it is, for records that were spilled because the
    store was away).  Records go through the contract again and then through the
    idempotent append, so that replaying twice, or after a partial append, stores each event once.
    """
    text = mend if mend is not None else F.col("raw_record")
    # written out: a filter on the parse would be pushed below it and repeat the parse for each condition
    again = cut_lineage(classify_records(quarantine.select(text.alias("value")), schema, required, arrival=F.current_timestamp()))
    valid = again.where("is_valid").select(*schema.fieldNames())
    return idempotent_append(target, valid, key, arrival), again.where("not is_valid").select("raw_record", "reject_reasons")


def pack_envelopes(sensor: DataFrame, production: DataFrame, batch: Column) -> DataFrame:
    """Group rows into envelopes; ``batch`` must bound the group size (e.g. id // 100)."""
    def grouped(df, name):
        cols = [F.date_format(F.col(f.name), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(f.name)
                if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema.fields]
        return (df.withColumn("batch_id", batch).groupBy("batch_id")
                .agg(F.collect_list(F.struct(*cols)).alias(name)))
    env = grouped(sensor, "sensor_readings").join(grouped(production, "production_events"), "batch_id", "full")
    return env.select("batch_id", F.to_json(F.struct("sensor_readings", "production_events")).alias("value"))


# ------------------------------------------------------------------ SRC-9
def wide_sensor_to_core(wide: DataFrame) -> DataFrame:
    """Wide sensor rows -> core schema: operating hours from maintenance age, arrival = event time."""
    keep = [c for c in S.SENSOR_SCHEMA.fieldNames() if c not in ("operating_hours", "created_at")]
    return wide.select(
        *[F.col(c) for c in keep if c in wide.columns],
        (F.coalesce(F.col("hours_since_maintenance"), F.lit(0.0))
         + F.coalesce(F.col("machine_age_days"), F.lit(0.0)) * 24.0).alias("operating_hours"),
        F.col("timestamp").alias("created_at"))


def wide_production_to_core(wide: DataFrame) -> DataFrame:
    rename = {"lot_id": "batch_id"}
    cols = []
    for f in S.PRODUCTION_SCHEMA.fieldNames():
        src = next((k for k, v in rename.items() if v == f), f)
        if f == "created_at":
            cols.append(F.col("timestamp").alias("created_at"))
        elif src in wide.columns:
            cols.append(F.col(src).alias(f))
    return wide.select(*cols)


def wide_quality_events_to_issues(dq: DataFrame) -> DataFrame:
    """Generator data-quality events -> issue rows (lower-cased type, table as entity)."""
    return dq.select(F.lower("issue_type").alias("issue_type"), "severity",
                     F.col("affected_table").alias("entity_type"), "machine_id", "line_id", "station_id",
                     "timestamp", "details_json", F.lit("generator").alias("source"))


def wide_maintenance_to_events(wide: DataFrame) -> DataFrame:
    """SRC-9: wide maintenance rows -> ``maintenance_events``; what the core columns don't hold goes to ``details_json``."""
    core = ["machine_id", "line_id", "station_id", "timestamp"]
    rest = [c for c in wide.columns if c not in (*core, "id", "event_type", "maintenance_type")]
    kind = F.coalesce(*[F.col(c) for c in ("maintenance_type", "event_type") if c in wide.columns], F.lit("maintenance"))
    return wide.select(*[c for c in ["id"] if c in wide.columns], *[F.col(c) for c in core if c in wide.columns],
                       F.lower(kind).alias("event_type"), F.to_json(F.struct(*rest)).alias("details_json"))
