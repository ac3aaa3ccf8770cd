"""JSON message decoding and the file/Kafka sources that feed it.

Every source yields a `value` column of JSON text; `decode_json` turns it into
typed columns with a fixed schema. A message is one record or an array of
records. Bad records are kept, with NULL fields and their text in
`_corrupt_record`; `split_bad` parts them from the good ones, so that reports
see good records only and the bad text can be stored.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowstats.schemas import CORRUPT_RECORD

STATUS = "status_code"


def _whole_number(text: Column) -> Column:
    """A whole number written as `5`, `"5"` or `5.0`; NULL for anything else."""
    exact = text.try_cast("decimal(38,6)")
    return F.coalesce(text.try_cast("bigint"), F.when(exact == F.floor(exact), exact).try_cast("bigint"))


def _typed(field: T.StructField, text: Column) -> Column:
    if isinstance(field.dataType, T.LongType):
        return _whole_number(text)
    if field.name == STATUS:  # `200`, `"200"` and `200.0` are one status
        return F.coalesce(_whole_number(text).cast("string"), text)
    return text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)


def _one_value(text: Column) -> Column:
    """Whether `text` is one JSON value and nothing after it.

    The parser stops at the end of a value, so the text is read as the first element of a list whose second one is the
    text's hash: what follows a value makes the list unreadable, or stands where the hash should.
    """
    mark = F.xxhash64(text).cast("string")
    return F.coalesce(F.get_json_object(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")), "$[1]") == mark, F.lit(False))


#: Field of a plainly read record that is set where one of the others could not be read.
UNFIT = "_unfit"
#: An object without brackets inside ends where its one closing bracket is: if it can be read, nothing comes after it.
FLAT = r"^\{[^{}\[\]]*+\}\z"


def _plain_schema(schema: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType if isinstance(f.dataType, T.LongType) else T.StringType()) for f in schema.fields]
    return T.StructType([*fields, T.StructField(UNFIT, T.StringType())])


def _plain_record(text: Column, schema: T.StructType) -> Column:
    """An object whose whole numbers stand as JSON numbers, as nearly all do, read without a text for each field."""
    # NaN and the like are no JSON for `_one_value` either.
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNFIT, "allowNonNumericNumbers": "false"}
    return F.from_json(text, _plain_schema(schema), options)


def decode_json(
    df: DataFrame, schema: T.StructType, value_col: str = "value", keep: list[str] | None = None, extra_col: str | None = None
) -> DataFrame:
    """Parse `value_col` (string or binary) into one row per record of `schema`.

    NULL and blank messages (tombstones, empty lines) hold no record and give no
    row; an array gives a row per element. Numbers may be quoted or have a zero
    fraction. Text that is no JSON object or has anything after it, or a field that does not fit its
    type, sets `_corrupt_record` to the record's text; the fields that fit stay.
    `keep` names source columns (e.g. the Kafka `timestamp`) carried along.
    `extra_col` adds the whole record as a VARIANT, fields outside `schema`
    included (`extra_fields`, `try_variant_get`); NULL for a bad record, or one that
    repeats a field.
    """
    keep = list(keep or [])
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    text = F.col("_text")
    messages = df.select(*keep, F.col(value_col).cast("string").alias("_text")).where(text.rlike(r"[^ \t\r\n]"))
    # An object is read as an array of one; what is neither gives no element that is a record.
    elements = F.from_json(text, T.ArrayType(texts), {"mode": "PERMISSIVE"})
    one_value = _one_value(text)
    lone = F.array(F.lit(None).cast(texts))
    is_list = F.substring(F.ltrim("_text"), 1, 1) == "["

    def decoded(rec: Column) -> list[Column]:
        fields, misfit = {f.name: rec.getField(f.name) for f in schema.fields}, F.lit(False)
        for f in schema.fields:
            if not isinstance(f.dataType, T.StringType):
                misfit = misfit | (fields[f.name].isNotNull() & _typed(f, fields[f.name]).isNull())
        own_text = F.when(is_list & rec.isNotNull(), F.to_json(rec)).otherwise(text)
        bad = F.when(rec.isNull() | misfit, own_text).alias(CORRUPT_RECORD)
        return [*[_typed(f, fields[f.name]).alias(f.name) for f in schema.fields], bad]

    if extra_col is None:
        # What parses a text is named once on each way, as Spark works an expression out wherever it is named. The way of
        # the few has no part in the generated code of the many, which would grow too large to be compiled.
        messages = messages.select(*keep, "_text", F.when(text.startswith("{"), _plain_record(text, schema)).alias("_plain"))
        fits = F.col("_plain").isNotNull() & F.col("_plain").getField(UNFIT).isNull()
        for f in schema.fields:
            if not isinstance(f.dataType, T.LongType | T.StringType):
                ready = F.col("_plain").getField(f.name)
                fits = fits & (ready.isNull() | _typed(f, ready).isNotNull())
        messages = messages.select(*keep, "_text", "_plain", (fits & (text.rlike(FLAT) | one_value)).alias("_fits"))
        plain = [F.col("_plain").getField(f.name) for f in schema.fields]
        plain = [(c if isinstance(f.dataType, T.LongType) else _typed(f, c)).alias(f.name) for f, c in zip(schema.fields, plain, strict=True)]
        ready = F.array(F.struct(*plain, F.lit(None).cast("string").alias(CORRUPT_RECORD)))
        records = F.transform(F.coalesce(F.when(one_value, elements), lone), lambda rec: F.struct(*decoded(rec)))
        messages = messages.select(*keep, F.when(F.col("_fits"), ready).otherwise(records).alias("_records"))
        # Outer, as Spark would first filter by the size of the lists and parse the texts for that too; an empty list gives
        # the row without a place.
        rows = messages.select(*keep, F.posexplode_outer("_records").alias("_place", "_rec")).where(F.col("_place").isNotNull())
        return rows.select(*keep, *[F.col("_rec").getField(n).alias(n) for n in [*schema.fieldNames(), CORRUPT_RECORD]])
    valid = one_value & elements.isNotNull()
    is_empty_list = valid & (F.size(elements) == 0)
    messages = messages.where(~F.coalesce(is_empty_list, F.lit(False)))
    records = F.when(valid, elements).otherwise(lone)
    whole = F.try_parse_json(F.when(valid, text))
    listed = F.coalesce(F.try_variant_get(whole, "$", "array<variant>"), F.array(F.lit(None).cast("variant")))
    variants = F.when(is_list, listed).otherwise(F.array(whole))
    both = F.arrays_zip(records.alias("rec"), variants.alias("var"))
    rows = messages.select(*keep, "_text", F.explode(both).alias("_both"))
    rows = rows.select(*keep, "_text", F.col("_both.rec").alias("_rec"), F.col("_both.var").alias("_var"))
    *typed, bad = decoded(F.col("_rec"))
    extra = F.when(bad.isNull(), F.col("_var")).alias(extra_col)
    return rows.select(*keep, *typed, extra, bad)


def extra_fields(records: DataFrame, extra_col: str = "extra") -> str:
    """The schema that the records of a VARIANT column have together, as DDL text: known and unknown fields."""
    return records.agg(F.schema_of_variant_agg(extra_col)).first()[0]


def split_bad(records: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(good records without `_corrupt_record`, bad records) of decoded rows; no second part where there is no such column."""
    if CORRUPT_RECORD not in records.columns:
        return records, None
    bad = F.col(CORRUPT_RECORD).isNotNull()
    return records.where(~bad).drop(CORRUPT_RECORD), records.where(bad)


def encode_json(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows as JSON text in a `value` column (NULL fields are omitted)."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


#: Column with the place a record comes from: the Kafka message as `topic/partition@offset`, or the file.
SOURCE = "_source"


def decode_timed(lines: DataFrame, schema: T.StructType, time_col: str, keep: list[str] | None = None) -> DataFrame:
    """`decode_json` with a time field, ISO text or epoch seconds, as a timestamp.

    A record whose time is missing or cannot be read belongs to no hour: it is a bad one.
    """
    with_time = T.StructType([*schema.fields, T.StructField(time_col, T.StringType())])
    text = F.col(time_col)
    epoch = F.timestamp_seconds(text.try_cast("double"))
    decoded = decode_json(lines, with_time, keep=keep).withColumn("_time", F.coalesce(text.try_cast("timestamp"), epoch))
    own_text = F.to_json(F.struct(*with_time.fieldNames()))
    bad = F.coalesce(F.col(CORRUPT_RECORD), F.when(F.col("_time").isNull(), own_text))
    names = [f.name for f in schema.fields]
    return decoded.select(*(keep or []), *names, F.col("_time").alias(time_col), bad.alias(CORRUPT_RECORD))


def read_json_files(
    spark: SparkSession, path: str, schema: T.StructType, time_col: str | None = None, with_source: bool = False
) -> DataFrame:
    """Batch read of JSON-lines files through the shared decoder.

    `time_col` names a time field of the records, ISO text or epoch seconds,
    which is decoded as a timestamp besides the fields of `schema`.
    `with_source` adds each record's file as `_source`.
    """
    lines = spark.read.text(path)
    keep = []
    if with_source:
        lines, keep = lines.select("value", F.col("_metadata.file_path").alias(SOURCE)), [SOURCE]
    if time_col is None:
        return decode_json(lines, schema, keep=keep)
    return decode_timed(lines, schema, time_col, keep)


#: Column with the time that a source gives its records: the Kafka timestamp, or the file's modification time.
SOURCE_TIME = "timestamp"


def stream_json_files(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None, with_source: bool = False
) -> DataFrame:
    """Streaming read of JSON-lines files dropped into `path`.

    Each record carries its file's modification time as `timestamp`, which is the same when a batch is run again,
    and with `with_source` the file as `_source`.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(path).select(
        "value", F.col("_metadata.file_modification_time").alias(SOURCE_TIME), F.col("_metadata.file_path").alias(SOURCE)
    )
    return decode_json(lines, schema, keep=[SOURCE_TIME, SOURCE] if with_source else [SOURCE_TIME])


def kafka_stream(
    spark: SparkSession,
    brokers: str,
    topic: str,
    schema: T.StructType,
    starting_offsets: str = "latest",
    options: dict[str, str] | None = None,
    with_source: bool = False,
) -> DataFrame:
    """Decoded records of one Kafka topic; needs the spark-sql-kafka package.

    Only the message value is decoded; the Kafka `timestamp` is kept so a
    replayed batch can be stamped with a stable time, and with `with_source` the
    message's place as `_source`. `options` are the
    source's own, e.g. `maxOffsetsPerTrigger` to bound a catch-up batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    try:
        raw = reader.load()
    except AnalysisException as exc:  # only a missing data source means a missing package
        if "Failed to find data source" in str(exc) or exc.getCondition() in ("DATA_SOURCE_NOT_FOUND", None):
            raise RuntimeError(
                "Kafka source unavailable: start Spark with the spark-sql-kafka-0-10 package "
                "(spark.jars.packages) to read from a topic"
            ) from exc
        raise
    place = F.concat_ws("", "topic", F.lit("/"), F.col("partition").cast("string"), F.lit("@"), F.col("offset").cast("string"))
    raw = raw.select("value", SOURCE_TIME, place.alias(SOURCE))
    return decode_json(raw, schema, keep=[SOURCE_TIME, SOURCE] if with_source else [SOURCE_TIME])
