"""Registered queries: each reads whole tables below ``sf_dir``."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from isobar.functions.nested import as_text
from isobar.functions.numbers import number_or_zero, to_double
from isobar.functions.sql import ident
from isobar.functions.times import date_text
from isobar.operators import (
    correlation, exactmode, fieldtypes, frequency, histogram, means, numeric, orderstats, rawday, telegram, upsert,
)
from isobar.plans.profile import ProfileConfig, profile_file, profile_frame, report_json, type_text_table
from isobar.plans.stations import as_lines, as_responses, as_telegrams, counter, spread, table, telegrams
from isobar.schemas import MEASURES, RESPONSE, STATION_KEY, TELEGRAM
from isobar.session import shared_dir
from isobar.sources.lateststate import LatestState
from isobar.sources.messages import MESSAGE, landed_responses as file_responses, publish_to_files
from isobar.sources.rawstore import RawStore
from isobar.sources.tables import contains_nul, read_text_table
from isobar.sources.versions import write_text, write_version
from isobar.streaming.health import ProgressTable
from isobar.streaming.jobs import run_acquisition, run_station_means, run_window_means, window_store

Query = Callable[[SparkSession, str], DataFrame]

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Readings before this second make the current state of the upsert queries, the others
# the batch: 2024-01-02 00:00 UTC.
SPLIT_SECOND = 1704153600
# Bounds of the four batches: the 2nd, 10th and 20th of January.
SPLIT_SECONDS = [SPLIT_SECOND, 1704844800, 1705708800]
BOX = (-3.0, 52.0, 0.0, 60.0)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, variances to eight significant digits: sums of doubles depend
    on the order of the rows, and variances differ in size."""

    def value(f: T.StructField) -> str:
        if not isinstance(f.dataType, T.DoubleType):
            return ident(f.name)
        if f.name == "variance":
            return "CAST(format_string('%.7e', variance) AS DOUBLE) AS variance"
        return f"round({ident(f.name)}, 6) AS {ident(f.name)}"

    return df.selectExpr(*map(value, df.schema.fields))


# --- stations -----------------------------------------------------------------


def station_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(means.station_means(telegrams(spark, sf_dir)))


def station_means_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(means.station_means_sql(telegrams(spark, sf_dir)))


def keyed_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    messages = events.select(F.col("event_type").alias("key"), counter().cast("string").alias("value"))
    return rounded(means.keyed_means(messages))


def window_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(means.window_means(telegrams(spark, sf_dir)))


def _telegram_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of messages. The pattern has the source list the files of
    the table, whether it is one file or a folder of them."""
    schema = table(spark, sf_dir, "events").schema
    return telegram.to_messages(as_telegrams(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")))


def stream_window_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "window-means")
    store = window_store(f"{root}/out")
    run_window_means(
        _telegram_stream(spark, sf_dir), store, f"{root}/checkpoint", drain=True, name=None
    ).awaitTermination()
    return rounded(store.read(spark).drop("day"))


def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four parts of the readings by time, a batch each; every seventh reading comes a batch late and is left out
    where the watermark has passed its window. Ticks at the end close what is open. Windows are written once."""
    root = shared_dir(spark, "closed-windows")
    store = window_store(f"{root}/out", fold_every=3)
    readings = telegrams(spark, sf_dir).withColumn(
        "batch", reduce(lambda n, at: n + (F.col("time") >= at).cast("int"), SPLIT_SECONDS, F.lit(0))
    ).withColumn("batch", F.least(F.col("batch") + (F.col("event_id") % 7 == 3).cast("int"), F.lit(3)))
    messages = telegram.to_messages(readings)
    nothing = spark.range(0).select(F.col("id").alias("time"))
    nothing.write.parquet(f"{root}/ticks")
    for batch in range(6):
        if batch < 4:
            telegram.to_messages(readings.where(F.col("batch") == batch)).write.mode("append").parquet(f"{root}/landed")
        else:
            # The watermark of a batch is seen by the next one.
            spark.range(1).select(F.lit(1 << 33).alias("time")).write.mode("append").parquet(f"{root}/ticks")
        run_window_means(
            spark.readStream.schema(messages.schema).parquet(f"{root}/landed"), store, f"{root}/checkpoint", closed=True,
            ticks=spark.readStream.schema(nothing.schema).parquet(f"{root}/ticks"), drain=True, name=None,
        ).awaitTermination()
    return rounded(store.read(spark).drop("day"))


def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "latest-state")
    state = LatestState(f"{root}/state")
    run_station_means(
        _telegram_stream(spark, sf_dir), state, f"{root}/quarantine", f"{root}/checkpoint", drain=True, name=None
    ).awaitTermination()
    return rounded(state.read(spark))


def _quarter(quarter: int) -> Column:
    """The rows of one of four parts by time."""
    at = F.col("time")
    after = at >= SPLIT_SECONDS[quarter - 1] if quarter else F.lit(True)
    return after & (at < SPLIT_SECONDS[quarter]) if quarter < 3 else after


def stream_latest_state_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four parts of the readings by time, landed one after the other and a batch each."""
    root = shared_dir(spark, "latest-batches")
    state = LatestState(f"{root}/state", compact_every=2)
    messages = telegram.to_messages(telegrams(spark, sf_dir))
    for quarter in range(4):
        part = telegrams(spark, sf_dir).where(_quarter(quarter))
        telegram.to_messages(part).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(messages.schema).parquet(f"{root}/landed")
        run_station_means(
            stream, state, f"{root}/quarantine", f"{root}/checkpoint", drain=True, name=None
        ).awaitTermination()
    return rounded(state.read(spark))


def _landed_part(spark: SparkSession, sf_dir: str, parts: int, k: int) -> DataFrame:
    """The responses to one of so many parts of the events."""
    own = table(spark, sf_dir, "events").where(F.col("event_id") % parts == k)
    return as_responses(as_telegrams(spread(own))).select("value", "landed_at")


def _acquired(spark: SparkSession, sf_dir: str, batches: int) -> tuple[RawStore, str]:
    """The raw store and the folder of messages after so many batches of responses."""
    root = shared_dir(spark, "acquire")
    raw = RawStore(f"{root}/raw")
    for k in range(batches):
        part = _landed_part(spark, sf_dir, batches, k)
        part.write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/landed")
        run_acquisition(
            stream, publish_to_files(f"{root}/messages"), raw, f"{root}/checkpoint", drain=True, name=None
        ).awaitTermination()
    return raw, f"{root}/messages"


def stream_acquire_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(_acquired(spark, sf_dir, 1)[0].read(spark))


def stream_acquire_raw_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(_acquired(spark, sf_dir, 3)[0].read(spark))


def stream_acquire_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was published."""
    _, path = _acquired(spark, sf_dir, 2)
    messages = spark.read.schema(MESSAGE).option("recursiveFileLookup", "true").json(path)
    return telegram.accepted(telegram.parse_messages(messages, keep=["key"]))


class _Interrupted(RuntimeError):
    pass


@dataclass(frozen=True)
class _FailingStore(RawStore):
    """Fails before or after a batch is written."""

    place: str = ""

    def write(self, telegrams: DataFrame, batch_id: int, arrival: str | None = None) -> None:
        if self.place == "published":
            raise _Interrupted(self.place)
        super().write(telegrams, batch_id, arrival)
        if self.place == "written":
            raise _Interrupted(self.place)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of responses. The job dies in each of them before it publishes, then between publishing and
    writing, then before the batch is committed, and goes on from its checkpoint each time."""
    root = shared_dir(spark, "restart")
    publish = publish_to_files(f"{root}/messages")

    def failing(messages: DataFrame, batch_id: int) -> None:
        raise _Interrupted("read")

    for batch in range(3):
        part = _landed_part(spark, sf_dir, 3, batch)
        part.write.mode("append").parquet(f"{root}/landed")
        for place in ("read", "published", "written", ""):
            query = run_acquisition(
                spark.readStream.schema(part.schema).parquet(f"{root}/landed"), failing if place == "read" else publish,
                _FailingStore(f"{root}/raw", fold_every=2, place=place), f"{root}/checkpoint", drain=True, name=None,
            )
            try:
                query.awaitTermination()
            except StreamingQueryException:
                if not place:
                    raise
            else:
                if place:
                    raise RuntimeError(f"batch {batch} was not interrupted: {place}")
    raw = RawStore(f"{root}/raw").read(spark).select(
        F.lit("raw").alias("kept_as"), "id", F.unix_seconds("eventtime").alias("at"), "temperature", "humidity", "pressure"
    )
    messages = spark.read.schema(MESSAGE).option("recursiveFileLookup", "true").json(f"{root}/messages")
    sent = telegram.accepted(telegram.parse_messages(messages, keep=["key"])).select(
        F.lit("message").alias("kept_as"), F.col("key").alias("id"), F.col("time").alias("at"),
        F.col("temp").alias("temperature"), "humidity", "pressure",
    )
    return raw.unionByName(sent)


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed figures of four batches, the last of them without input."""
    root = shared_dir(spark, "progress")
    table_of = ProgressTable(spark, f"{root}/progress", per_file=1)
    spark.streams.addListener(table_of)
    try:
        for batch in range(4):
            part = _landed_part(spark, sf_dir, 3, batch)
            part.write.mode("append").parquet(f"{root}/landed")
            query = run_acquisition(
                spark.readStream.schema(part.schema).parquet(f"{root}/landed"), publish_to_files(f"{root}/messages"),
                RawStore(f"{root}/raw"), f"{root}/checkpoint", drain=True, name=None,
            )
            query.awaitTermination()
            if not table_of.wait(query):
                raise RuntimeError("no figures of the batch")
    finally:
        spark.streams.removeListener(table_of)
    done = ProgressTable.read(spark, f"{root}/progress")
    return done.select("batch_id", "rows", "idle", "late", (F.col("elapsed_ms") >= 0).alias("timed"))


def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses landed as text files, a document of some hundred stations each, streamed and flattened."""
    root = shared_dir(spark, "landed-text")
    events = table(spark, sf_dir, "events")
    responses = as_responses(as_telegrams(spread(events))).select("event_id", "value")
    files = F.lit(1 + events.count() // 200)
    stations = responses.select("event_id", F.explode(F.from_json("value", RESPONSE)["list"]).alias("station"))
    documents = stations.groupBy(F.pmod(F.xxhash64("event_id"), files).alias("file")).agg(
        F.to_json(F.struct(F.collect_list("station").alias("list"))).alias("value")
    )
    # Files of one folder: a folder for each would be made, and listed, one by one.
    documents.select("value").write.option("maxRecordsPerFile", 1).text(f"{root}/in")
    out = f"{root}/out"

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_version(telegram.flatten_responses(batch, F.lit(0)), out, batch_id)

    writer = file_responses(spark, f"{root}/in").writeStream.foreachBatch(handle)
    writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).drop("v")


def telegram_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telegram.accepted(telegram.parse_messages(_with_bad_messages(spark, sf_dir)))


def telegram_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected texts, by the fields that can still be read from them."""
    bad = telegram.quarantined(telegram.parse_messages(_with_bad_messages(spark, sf_dir)))
    return bad.select(
        "rejected",
        F.regexp_extract("value", r'^\{"id":(\d+)', 1).alias("id"),
        F.regexp_extract("value", '"location":"([^"]*)"', 1).alias("location"),
        F.regexp_extract("value", r'"time":(\d+)\}$', 1).alias("time"),
    )


def _with_bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message three times: whole, cut in half, and without its id."""
    good = telegram.to_messages(telegrams(spark, sf_dir))
    half = (F.length("value") / 2).cast("int")
    variants = F.array(
        F.col("value"),
        F.substring(F.col("value"), F.lit(1), half),
        F.regexp_replace("value", r'"id":\d+,', ""),
    )
    return good.select("key", F.explode(variants).alias("value"))


def telegram_serialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = telegram.to_messages(telegrams(spark, sf_dir))
    names = TELEGRAM.names
    texts = messages.select("key", "value", F.json_tuple("value", *names).alias(*names))
    return texts.select(
        "key", F.size(F.json_object_keys("value")).alias("n_keys"),
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in TELEGRAM.fields],
    )


def response_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = as_responses(telegrams(spark, sf_dir))
    return telegram.flatten_responses(responses, F.col("landed_at"), keep=["event_id"])


def response_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telegram.response_envelope(as_responses(telegrams(spark, sf_dir)), keep=["event_id"])


def bbox_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telegram.within_box(telegrams(spark, sf_dir), *BOX)


def csv_reading_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telegram.parse_csv_readings(as_lines(telegrams(spark, sf_dir)), keep=["event_id"])


def date_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telegrams(spark, sf_dir).select("event_id", date_text(F.col("time")).alias("date_text"))


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    readings = telegrams(spark, sf_dir)
    early = F.col("time") < SPLIT_SECOND
    return (
        upsert.resolve_batch(means.station_means(readings.filter(early))),
        upsert.resolve_batch(means.station_means(readings.filter(~early))),
    )


def upsert_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, batch = _two_batches(spark, sf_dir)
    flagged = upsert.flag_known(current, batch)
    return flagged.select("id", F.when(F.col("known"), "update").otherwise("insert").alias("action"))


def station_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(upsert.upsert(*_two_batches(spark, sf_dir)))


def _repeated(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings, and the same readings corrected and sent again later."""
    first = readings.withColumn("arrival", F.col("event_id"))
    again = readings.withColumn("arrival", F.col("event_id") + 10**12).withColumn("temp", F.col("temp") + 1)
    return first, again


def _plain_time(raw: DataFrame) -> DataFrame:
    return raw.withColumn("eventtime", F.unix_seconds("eventtime"))


def raw_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, again = _repeated(telegrams(spark, sf_dir))
    raw = rawday.to_raw_day(first.unionByName(again), keep=("arrival",))
    return _plain_time(rawday.last_write_wins(raw, "arrival"))


def raw_by_day_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = RawStore(shared_dir(spark, "raw-by-day"))
    for batch_id, batch in enumerate(_repeated(telegrams(spark, sf_dir))):
        store.write(batch, batch_id, arrival="arrival")
    return _plain_time(store.read(spark))


def raw_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each day, and how many come before their predecessor in a file of the store."""
    root = shared_dir(spark, "raw-order")
    RawStore(root).write(telegrams(spark, sf_dir), 0, arrival="event_id")
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    stored = spark.read.parquet(f"{root}/v=0").withColumn("place", place)
    before = Window.partitionBy("place.file").orderBy("place.at")
    key = F.struct("id", "eventtime")
    checked = stored.withColumn("inverted", F.coalesce(F.lag(key).over(before) > key, F.lit(False)))
    return checked.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("inverted").alias("n_inverted")
    )


# --- profiling ----------------------------------------------------------------


def field_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fieldtypes.field_types(table(spark, sf_dir, "events"), "event_id")


def field_types_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fieldtypes.field_types(table(spark, sf_dir, "events"), "event_id", infer="cast")


def field_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fieldtypes.type_counts(fieldtypes.field_kinds(table(spark, sf_dir, "orders"), "o_orderkey"))


def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(numeric.numeric_summary(table(spark, sf_dir, "lineitem"), LINE_MEASURES))


def numeric_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = orderstats.order_statistics(table(spark, sf_dir, "lineitem"), LINE_MEASURES)
    events = orderstats.order_statistics(table(spark, sf_dir, "events"), ["value"])
    return rounded(lines.unionByName(events))


def _many_numbers(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, list[str]]]:
    return [
        (table(spark, sf_dir, "events"), ["value"]), (table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"]),
        (table(spark, sf_dir, "lineitem"), LINE_MEASURES),
    ]


def mode_or_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact modes of numeric fields, and how many different values each field has."""
    sources = _many_numbers(spark, sf_dir)
    found = reduce(DataFrame.unionByName, [exactmode.exact_modes(df, columns) for df, columns in sources])
    counts = reduce(DataFrame.unionByName, [frequency.number_frequencies(df, columns) for df, columns in sources])
    different = frequency.modes(counts).select("field", "n_unique")
    # A field without any value is in the modes, as the count of nothing, but has no frequencies.
    joined = found.join(different, "field", "left").withColumn("n_unique", F.coalesce("n_unique", F.lit(0).cast("long")))
    return joined.select("field", "n", "n_unique", "has_mode", "mode", "n_mode")


def numeric_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many different values numeric fields have, and their modes, by counting every value."""
    first, *rest = [frequency.number_frequencies(df, columns) for df, columns in _many_numbers(spark, sf_dir)]
    return frequency.modes(reduce(DataFrame.unionByName, rest, first))


def _text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = frequency.text_frequencies(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])
    customers = frequency.text_frequencies(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"])
    return orders.unionByName(customers)


def string_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.modes(_text_values(spark, sf_dir))


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.distinct_values(_text_values(spark, sf_dir))


def discrete_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = frequency.text_frequencies(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])
    return lines.unionByName(frequency.text_frequencies(table(spark, sf_dir, "events"), ["event_type"]))


def histogram10(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = histogram.histogram10(table(spark, sf_dir, "lineitem"), LINE_MEASURES)
    events = histogram.histogram10(table(spark, sf_dir, "events"), ["value"])
    odd = histogram.histogram10(_with_infinities(table(spark, sf_dir, "lineitem")))
    return rounded(lines.unionByName(events).unionByName(odd))


def _with_infinities(lines: DataFrame) -> DataFrame:
    """Numbers of which some, or all, are infinite."""
    up, down = (F.lit(float(sign + "inf")) for sign in ("", "-"))
    number, price = F.col("l_linenumber"), F.col("l_extendedprice").cast("double")
    return lines.select(
        F.when(number == 3, up).otherwise(price).alias("some_above"),
        F.when(number == 3, up).when(number == 5, down).otherwise(price).alias("some_both"),
        F.when(number < 3, up).otherwise(down).alias("all_infinite"),
    )


def profile_infinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every figure of the report on columns with infinite values, as its JSON has them."""
    document = json.loads(report_json(profile_frame(_with_infinities(table(spark, sf_dir, "lineitem")))))
    rows = [
        (r["Name"], metric, None if isinstance(v, str) or v is None else float(v), v if isinstance(v, str) else None)
        for r in document["Fields"] for metric, v in r.items() if metric not in ("Name", "Type")
    ]
    return rounded(spark.createDataFrame(rows, "field string, metric string, number double, text string"))


def pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("constant", F.lit(1.5))
    pairs = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"), ("l_quantity", "constant")]
    events = as_telegrams(table(spark, sf_dir, "events"))
    return rounded(
        correlation.pearson(lines, pairs).unionByName(
            correlation.pearson(events, [("temp", "pressure"), ("windspeed", "winddirection"), ("temp", "time")])
        )
    )


def blank_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    cells = events.select(F.when(counter() < 10, " ").otherwise(F.col("value").cast("string")).alias("cell"))
    numbers = cells.selectExpr(
        f"{number_or_zero('cell')} AS blank_as_zero", f"{to_double('cell')} AS blank_skipped"
    )
    return rounded(numeric.numeric_summary(numbers))


def nested_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k INT").alias("props"))
    return nested.selectExpr("event_id", f"{as_text(nested, 'props')} AS props")


def nul_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contains_nul(table(spark, sf_dir, "documents"), "text")


def profile_csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as delimited text, profiled from the file."""
    path = shared_dir(spark, "lines-csv")
    lines = table(spark, sf_dir, "lineitem").select(*LINE_MEASURES, "l_returnflag", "l_linestatus")
    lines.write.option("header", True).csv(path)
    done = profile_file(spark, ProfileConfig(path))
    return rounded(done.numeric.join(done.distinct_numbers, "field"))


def profile_json_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as JSON lines, profiled from the file: text and numeric fields."""
    path = shared_dir(spark, "orders-json")
    orders = table(spark, sf_dir, "orders")
    orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority").write.json(path)
    done = profile_file(spark, path)
    shared = ["field", "n_unique", "has_mode"]
    strings = done.strings.select(*shared, F.col("mode").alias("text_mode"))
    return rounded(
        done.numeric.join(done.distinct_numbers, "field").select(*shared, "mode", "minimum", "maximum", "average", "median").unionByName(
            strings, allowMissingColumns=True
        )
    )


def headerless_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without a header; some columns have names given."""
    path = shared_dir(spark, "headerless")
    table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_MEASURES).write.csv(path)
    read = read_text_table(spark, path, sep=",", header=False, names=["order", None, "price", ""])
    return read.rows.select("order", *[F.col(c).cast("double").alias(c) for c in ("var1", "price", "var3", "var4")])


def profile_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is counted where lines and cells are damaged."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey")
    key = F.col("o_orderkey")
    as_json = F.to_json(F.struct("o_orderkey", "o_totalprice"))
    cut = F.when(key % 7 == 4, F.substring(as_json, F.lit(1), F.length(as_json) - 4)).otherwise(as_json)
    price = F.when(key % 11 == 5, "nan").when(key % 13 == 6, "oops").otherwise(F.col("o_totalprice").cast("string"))
    line = (
        F.when(key % 5 == 3, key.cast("string")).when(key % 5 == 4, F.concat_ws(",", key, price, F.lit("more")))
        .otherwise(F.concat_ws(",", key, price))
    )
    found = []
    for name, text, options in (("json", cut, {}), ("csv", line, {"sep": ",", "header": False, "names": ["k", "price"]})):
        path = shared_dir(spark, f"damaged-{name}")
        orders.select(text.alias("value")).write.text(path)
        done = type_text_table(read_text_table(spark, path, **options))
        last = done.df.columns[-1]
        n = done.df.select(F.count(F.nanvl(F.col(last), F.lit(None).cast("double")))).first()[0]
        found.append((name, done.n_malformed, done.n_blank[last], done.n_invalid[last], done.n_nan[last], n))
    return spark.createDataFrame(
        found, "source string, n_malformed long, n_blank long, n_invalid long, n_nan long, n long"
    )


def profile_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file profiled by a settings document; the metadata file it writes, read back as rows."""
    root = shared_dir(spark, "settings")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
    table(spark, sf_dir, "orders").select(*columns).write.options(header=True, sep=";").csv(f"{root}/orders")
    settings = {"infile": f"{root}/orders", "metafile": f"{root}/meta.json", "separator": ";", "hasheader": "True"}
    write_text(spark, f"{root}/settings.json", json.dumps(settings))
    document = spark.read.text(f"{root}/settings.json", wholetext=True).first()[0]
    profile_file(spark, ProfileConfig.from_json(document))
    found = json.loads(spark.read.text(f"{root}/meta.json", wholetext=True).first()[0])
    found.pop("inputfile")
    return _report_rows(spark, {"orders": found})


def profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports on all columns of three tables, as rows."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    sources = {
        "lineitem": (lines, "l_orderkey"), "orders": (orders, "o_orderkey"),
        "pair": (lines.select("l_quantity", "l_extendedprice"), None),
    }
    documents = {name: json.loads(report_json(profile_frame(df, first_by=by))) for name, (df, by) in sources.items()}
    return _report_rows(spark, documents)


def _report_rows(spark: SparkSession, documents: dict[str, dict]) -> DataFrame:
    """Reports as rows of source, field, metric, and number or text."""
    rows = []
    for name, document in documents.items():
        for record in document.pop("Fields"):
            for metric, value in record.items():
                if metric not in ("Name", "UniqueValues"):
                    rows.append((name, record["Name"], metric, value))
        rows += [(name, None, metric, value) for metric, value in document.items()]
    parts = [
        (source, of, metric, None if isinstance(v, str) or v is None else float(v), v if isinstance(v, str) else None)
        for source, of, metric, v in rows
    ]
    df = spark.createDataFrame(parts, "source string, field string, metric string, number double, text string")
    digits = F.when(F.col("metric") == "Variance", F.format_string("%.7e", "number").cast("double"))
    return df.withColumn("number", F.coalesce(digits, F.round("number", 6)))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        station_means, station_means_sql, keyed_mean, window_means, stream_window_means, stream_closed_windows, stream_restart, stream_progress,
        stream_latest_state, stream_latest_state_batches, stream_acquire_raw, stream_acquire_raw_batches, stream_acquire_messages,
        landed_responses, raw_file_order, headerless_names, profile_damaged, profile_infinite, profile_settings, profile_report, telegram_parse, telegram_quarantine,
        telegram_serialize, response_flatten, response_envelope, bbox_filter,
        csv_reading_parse, date_render, upsert_classify, station_upsert, raw_by_day,
        raw_by_day_store, field_types, field_types_cast, field_type_counts, numeric_profile,
        numeric_quartiles, mode_or_none, numeric_distinct, string_profile, distinct_values, discrete_histogram,
        histogram10, pearson, blank_zero, nested_text, nul_scan, profile_csv_file,
        profile_json_file,
    )
}
