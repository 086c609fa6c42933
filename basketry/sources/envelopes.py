"""Message envelopes ``(topic, json_data, event_time)``: make, read, check."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.dates import Moment, moment, parse_event_time
from basketry.schemas import CORRUPT, ENTITIES, text_schema

ENVELOPE = "topic string, json_data string, event_time string"
# Packed files cannot be cut when read, so none is to hold more lines than a task should take.
LINES_PER_FILE = 100_000
UNPARSEABLE, MISSING = "unparseable json_data", "missing json_data"


def to_envelope(docs: DataFrame, topic: str, event_time: Moment) -> DataFrame:
    """Each document as JSON text, stamped with the one time of the run."""
    return docs.select(
        F.lit(topic).alias("topic"),
        F.to_json(F.struct("*")).alias("json_data"),
        moment(event_time).alias("event_time"),
    )


def text_envelope(docs: DataFrame, text: Column, topic: str, event_time: Moment) -> DataFrame:
    """Documents that are JSON text already, stamped with the one time of the run."""
    return docs.select(
        F.lit(topic).alias("topic"),
        text.alias("json_data"),
        moment(event_time).alias("event_time"),
    )


def write_envelopes(envelopes: DataFrame, path: str, mode: str = "append") -> None:
    """Packed JSON lines, a folder per topic, so that a reader of one topic opens no other files.

    Mode ``overwrite`` replaces the topics that the envelopes have. Packed for speed: the files go
    once they are consumed, and level 1 takes two thirds of the time of the usual level 6.
    """
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamped = envelopes.withColumn("event_time", iso)
    stamped.write.mode(mode).option("partitionOverwriteMode", "dynamic").option(
        "maxRecordsPerFile", LINES_PER_FILE
    ).option("zlib.compress.level", "BEST_SPEED").partitionBy("topic").json(path, compression="gzip")


def _envelopes(
    spark: SparkSession,
    source: str,
    topics: Sequence[str],
    run_time: Moment | None,
    streaming: bool,
    brokers: str | None,
    max_files: int | None,
    max_bytes: int | None = None,
    consume: bool = False,
) -> DataFrame:
    """All envelopes; one that is not JSON has its raw text as ``json_data``."""
    reader = spark.readStream if streaming else spark.read
    shape = f"{ENVELOPE}, {CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if brokers:
        records = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
            .load()
        )
        body = F.from_json(F.col("value").cast("string"), shape, options)
        rows = records.select("topic", *(body[c].alias(c) for c in ("json_data", "event_time", CORRUPT)))
    else:
        if streaming and max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        if streaming and max_bytes:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        if streaming and consume:
            reader = reader.option("cleanSource", "delete")
        rows = reader.options(**options).schema(shape).json(source)
    now = F.current_timestamp() if run_time is None else run_time
    return rows.select(
        "topic",
        F.coalesce("json_data", CORRUPT).alias("json_data"),
        parse_event_time(F.col("event_time"), now).alias("event_time"),
    )


def read_envelopes(
    spark: SparkSession,
    source: str,
    topics: Sequence[str] = ENTITIES,
    run_time: Moment | None = None,
    streaming: bool = False,
    brokers: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    consume: bool = False,
) -> DataFrame:
    """Envelopes of the topics, oldest first: JSON-line files under ``source``, or a broker.

    With ``brokers`` the Kafka source is used (its connector must be on the class path) and
    ``source`` is ignored. Envelopes of no known topic are given by ``read_unrouted``.
    ``max_files`` or ``max_bytes`` bounds a micro-batch of a stream of files; with ``consume`` the
    stream deletes the files of a batch once it is committed.
    """
    rows = _envelopes(
        spark, source, topics, run_time, streaming, brokers, max_files, max_bytes, consume
    )
    return rows.filter(F.col("topic").isin(*topics))


def read_unrouted(
    spark: SparkSession,
    source: str,
    topics: Sequence[str] = ENTITIES,
    run_time: Moment | None = None,
) -> DataFrame:
    """``json_data, event_time, reason`` of the lines under ``source`` with none of the topics."""
    rows = _envelopes(spark, source, topics, run_time, False, None, None)
    named = F.concat(F.lit("unknown topic: "), F.col("topic"))
    reason = F.coalesce(named, F.lit("missing topic"))
    return rows.filter(~F.coalesce(F.col("topic").isin(*topics), F.lit(False))).select(
        "json_data", "event_time", reason.alias("reason")
    )


def _schema(shape: str | T.StructType) -> T.StructType:
    return text_schema(shape) if isinstance(shape, str) else shape


def _parsing(
    shape: str | T.StructType,
) -> tuple[T.StructType, Column, Column, Callable[[Column], Column]]:
    """What documents are parsed to, the parsed text, and whether a text and its document are there."""
    schema = T.StructType([*_schema(shape), T.StructField(CORRUPT, T.StringType())])
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "allowSingleQuotes": "false",
    }
    parsed = F.from_json("json_data", schema, options)
    sent = F.coalesce(F.col("json_data"), F.lit("")) != ""

    def readable(doc: Column) -> Column:
        found = reduce(Column.__or__, (doc[f.name].isNotNull() for f in _schema(shape)))
        return doc.isNotNull() & (doc[CORRUPT].isNull() | found)

    return schema, parsed, sent, readable


def split_valid(
    envelopes: DataFrame, shape: str | T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Envelopes with a readable document, parsed as text leaves into ``doc``, and the others.

    ``shape`` names an entity or gives the schema of the document. The check sits in the array
    that is exploded: as a filter it would be pushed below the parse and repeat it per field.
    """
    schema, parsed, sent, readable = _parsing(shape)
    none = F.array().cast(T.ArrayType(schema))

    def kept(wanted: Callable[[Column], Column]) -> Column:
        return F.explode(F.when(sent, F.filter(F.array(parsed), wanted)).otherwise(none))

    good = envelopes.withColumn("doc", kept(readable))
    unparsed = (
        envelopes.withColumn("_bad", kept(lambda d: ~readable(d)))
        .select("json_data", "event_time", F.lit(UNPARSEABLE).alias("reason"))
    )
    unsent = envelopes.filter(~sent).select(
        "json_data", "event_time", F.lit(MISSING).alias("reason")
    )
    return good, unparsed.unionByName(unsent)


def judge(
    envelopes: DataFrame, shape: str | T.StructType, where: Column | None = None
) -> DataFrame:
    """All envelopes with ``doc`` as ``split_valid`` gives it, or else the ``reason`` there is none.

    For a frame that is stored and read for both: each text is parsed once, in a projection, as
    no filter is pushed below what is stored. Those not ``where`` have neither.
    """
    _, parsed, sent, readable = _parsing(shape)
    meant = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    doc = F.col("_doc")
    reason = F.when(meant & ~sent, MISSING).when(meant & ~readable(doc), UNPARSEABLE)
    return envelopes.withColumn("_doc", F.when(meant & sent, parsed)).select(
        *envelopes.columns, F.when(readable(doc), doc).alias("doc"), reason.alias("reason")
    )
