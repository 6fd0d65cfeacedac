"""Feed pages: scan, quarantine, validate, explode and flatten.

A page is one JSON document per file. Parsing is schema-explicit (never
inferred) and done with built-in JSON expressions, so it runs inside the
executors' codegen'd projections:

  page text  --from_json(struct<status, data: map<string,string>>)-->
             status, metadata / events presence and raw text
  events     --object: struct<all: array<string>> | list: array<string>-->
  one string per event --posexplode--> (source_file, pos, event text)
  event text --from_json(EVENT_SCHEMA)--> fields as text --casts--> typed columns

Corrupt pages and events are split off into quarantine frames, never raised.
"""

from __future__ import annotations

from functools import partial

from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlens.config import PAGE_STATUS_OK, WINDOW_DAYS
from feedlens.functions.columns import file_key, lenient_bool, lenient_double, lenient_int, normalise_ts, offset_from_name
from feedlens.session import shared_scratch

STR, LONG, INT, DBL, BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
WINDOW_TYPE = "map<string,string>"  # keeps {} (empty) apart from absent/null (NULL)

TEXT_FIELDS = ["title", "performer", "performer_slug", "venue", "venue_slug", "city", "state", "country", "date",
               "event_datetime", "event_timezone", "event_utc_datetime", "category_type", "event_category_name",
               "stats_last_updated_at", "forecast_layover_text", "forecast_hover_text"]
# Fields of other types are read as text and cast one by one, so a field in
# another JSON type (a number as text, a boolean as 0 or 1) does not cost the event.
CAST_FIELDS = {
    "id": lenient_int, "get_in_price": lenient_double,
    "stats_total_quantity_of_tickets": partial(lenient_int, kind="int"),
    "forecast_is_available": lenient_bool, "forecast_value": lenient_double, "is_past_with_no_pricing": lenient_bool,
    "mock_data_point": partial(lenient_int, kind="int"), "disable_click_through": partial(lenient_int, kind="int"),
}
WINDOW_FIELDS = [f"{d}day_price_change" for d in WINDOW_DAYS]
EVENT_SCHEMA = T.StructType([T.StructField(f, STR) for f in [*CAST_FIELDS, *TEXT_FIELDS, *WINDOW_FIELDS, "_bad"]])

METADATA_SCHEMA = T.StructType([
    T.StructField("categorization", T.StructType([
        T.StructField("current_utc", STR), T.StructField("total_count", LONG),
        T.StructField("upcoming_count", LONG), T.StructField("past_count", LONG)])),
    T.StructField("filters", T.StructType([
        T.StructField("date_range", T.StructType([
            T.StructField("start_date", STR), T.StructField("end_date", STR),
            T.StructField("is_any", BOOL)]))])),
    T.StructField("pagination", T.StructType([
        T.StructField("offset", LONG), T.StructField("limit", INT),
        T.StructField("current_page_results", INT), T.StructField("total_database_matches", LONG),
        T.StructField("has_more", BOOL), T.StructField("tab_requested", STR)])),
    T.StructField("performance_timing", T.StructType([T.StructField("total_seconds", DBL)])),
])

# Message texts that must equal the reference's.
JSON_PARSE_ERROR = "JSON parse error"
MISSING_DATA = "missing top-level 'data' key"
MISSING_METADATA = "missing data.metadata"
MISSING_EVENTS = "missing data.events"
MISSING_ID = "missing id"
EVENT_PARSE_ERROR = "event parse error"


def file_name() -> Column:
    """The name of the file a row was read from; Spark gives it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _page_writer(folder: str):
    """A function that writes the pages of a partition, sorted by name, into ``folder``."""
    def write(rows) -> None:
        import itertools
        import uuid

        from pyarrow import fs

        target, root = fs.FileSystem.from_uri(folder)
        for name, pages in itertools.groupby(rows, key=lambda r: r[0]):
            begun = f"{root}/.{name}.{uuid.uuid4().hex}"  # readers skip names with a dot; a task tried again leaves whole pages only
            with target.open_output_stream(begun) as out:
                for _, value in pages:
                    out.write(((value or "") + "\n").encode())
            target.move(begun, f"{root}/{name}")

    return write


def write_page_files(pages: DataFrame, folder: str) -> None:
    """Writes each page of (source_file, value) as a file of that name in one flat folder, as a feed's collector leaves them.

    Executors write the texts (each with a line end) under their names, so the driver does nothing a page.
    Arrow must have a file system for the folder; folders of other schemes go through Hadoop's (``_renamed_page_files``)."""
    spark = pages.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(root)
    uri = fs.makeQualified(root).toUri().toString()
    try:
        FileSystem.from_uri(uri)
    except (ValueError, OSError):
        return _renamed_page_files(pages, folder)
    pages.select("source_file", "value").repartition("source_file").sortWithinPartitions("source_file").foreachPartition(_page_writer(uri))


def _renamed_page_files(pages: DataFrame, folder: str) -> None:
    """``write_page_files`` where only Hadoop has a file system: Spark writes a file per name, the driver
    then moves the files to their names, one rename a page."""
    spark = pages.sparkSession
    parts = shared_scratch(spark, "page-parts")
    named = pages.select(F.concat(F.lit("p"), "source_file").alias("page"), "value")  # "p": partition values that look like numbers stay text
    named.repartition("page").write.partitionBy("page").text(parts)
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = spark.read.text(parts).select(F.col("_metadata.file_path").alias("path"), F.expr("substr(page, 2)").alias("name")).distinct()
    for r in found.toLocalIterator():
        if not fs.rename(path(spark._jvm.java.net.URI(r["path"])), path(root, r["name"])):
            raise OSError(f"page {r['name']} could not be moved to {folder}")


# S01
def scan_pages(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """One row per file of a directory whose name matches ``glob``, without nested folders: (source_file, value).

    Small files are packed into tasks by size; spark.sql.files.openCostInBytes
    (256 KB in ``get_session``) is what a file costs beside its bytes."""
    df = spark.read.text(path, wholetext=True, pathGlobFilter=glob)
    return df.select(file_name().alias("source_file"), "value")


def parsed_once(df: DataFrame, **parsed: Column) -> DataFrame:
    """``df`` with the expensive columns ``parsed``, each computed once a row.

    A filter on what is read from a parsed text would be moved below the projection that parses it, and the text
    built and parsed again for every mention. Here each is the output of a generator over one value, past
    which no filter moves."""
    for name, value in parsed.items():
        df = df.select("*", F.explode(F.array(value)).alias(name))
    return df


def _status_message(status: Column) -> Column:
    shown = F.coalesce(F.concat(F.lit("'"), status, F.lit("'")), F.lit("None"))
    return F.concat(F.lit("status != success (got "), shown, F.lit(")"))


ENVELOPE = "status string, data map<string,string>, _bad string"


# S02 + S03
def parse_pages(pages: DataFrame) -> DataFrame:
    """Adds page structure and validation to (source_file, value):
    is_corrupt, status, errors (array), reason, valid, metadata and events text.

    One parse of the page: the envelope is a struct whose ``data`` is a
    map<string,string>, so the presence of ``metadata`` and ``events`` is
    known (a present key with a null value is still present) and their raw
    text is kept for the next, narrower parse. Text that is not a JSON object
    lands in the corrupt-record column. ``"data": null`` counts as missing."""
    pages = parsed_once(pages, _env=F.from_json("value", ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    env = F.col("_env")
    data = env["data"]
    has_data = data.isNotNull()
    has_meta = F.coalesce(F.map_contains_key(data, "metadata"), F.lit(False))
    has_events = F.coalesce(F.map_contains_key(data, "events"), F.lit(False))
    status = env["status"]
    checks = F.array(
        F.when(status.isNull() | (status != F.lit(PAGE_STATUS_OK)), _status_message(status)),
        F.when(~has_data, F.lit(MISSING_DATA)),
        F.when(has_data & ~has_meta, F.lit(MISSING_METADATA)),
        F.when(has_data & ~has_events, F.lit(MISSING_EVENTS)),
    )
    out = pages.select(
        *[c for c in pages.columns if c != "_env"],
        (env.isNull() | env["_bad"].isNotNull()).alias("is_corrupt"),
        status.alias("status"),
        F.filter(checks, lambda x: x.isNotNull()).alias("errors"),
        data["metadata"].alias("metadata_text"),
        data["events"].alias("events_text"),
    )
    return out.select(
        "*",
        F.when(F.col("is_corrupt"), F.lit(JSON_PARSE_ERROR))
         .when(F.size("errors") > 0, F.concat_ws("; ", "errors")).alias("reason"),
        (~F.col("is_corrupt") & (F.size("errors") == 0)).alias("valid"),
    )


def quarantined_pages(parsed: DataFrame) -> DataFrame:
    """S02/S03 quarantine: (source_file, reason) for corrupt or invalid pages."""
    return parsed.where(~F.col("valid")).select("source_file", "reason")


# S04
def page_event_texts(events_text: Column) -> Column:
    """events.all when events is an object, the whole array when it is a list,
    else empty."""
    t = F.ltrim(events_text)
    as_object = F.from_json(events_text, "struct<all: array<string>>")["all"]
    as_list = F.from_json(events_text, "array<string>")
    return F.coalesce(
        F.when(t.startswith("{"), as_object).when(t.startswith("["), as_list),
        F.array().cast("array<string>"))


def explode_events(parsed: DataFrame) -> DataFrame:
    """(source_file, pos, event_text) for every event of every valid page."""
    texts = parsed_once(parsed.where("valid").select("source_file", "events_text"), _texts=page_event_texts(F.col("events_text")))
    return texts.select("source_file", F.posexplode("_texts").alias("pos", "event_text"))


# S05 + S06 + S07
def page_headers(parsed: DataFrame, run_id: Column, loaded_at: Column) -> DataFrame:
    """One header row per valid page (raw_feed_files)."""
    m = F.col("_meta")
    pag, cat, dr = m["pagination"], m["categorization"], m["filters"]["date_range"]
    return parsed_once(parsed.where("valid"), _meta=F.from_json("metadata_text", METADATA_SCHEMA)).select(
        file_key("source_file").alias("file_id"),
        run_id.alias("run_id"),
        "source_file",
        offset_from_name("source_file").alias("offset"),
        F.col("status").alias("feed_status"),
        pag["total_database_matches"].alias("total_db_matches"),
        pag["current_page_results"].alias("current_page_results"),
        F.coalesce(pag["has_more"], F.lit(False)).alias("has_more"),
        pag["limit"].alias("limit_per_page"),
        pag["tab_requested"].alias("tab_requested"),
        dr["start_date"].try_cast("date").alias("date_filter_start"),
        dr["end_date"].try_cast("date").alias("date_filter_end"),
        cat["upcoming_count"].alias("upcoming_count"),
        cat["past_count"].alias("past_count"),
        cat["total_count"].alias("total_count"),
        loaded_at.alias("loaded_at"),
    )


# S08 is feedlens.functions.columns.normalise_ts

# S09 + flattening
def parse_events(exploded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed event columns next to the raw text and the columns ``keep``; ``bad_reason`` is NULL for
    loadable events and names the reason otherwise. Only text that is no JSON
    object and an id that is missing or not castable keep an event out; any
    other field that cannot be cast is NULL and counted in ``cast_failures``."""
    e = F.from_json("event_text", EVENT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    text = parsed_once(exploded.select("source_file", "pos", "event_text", *keep), e=e)
    typed = {f: cast(F.col("e")[f]) for f, cast in CAST_FIELDS.items()}
    typed.update({f: F.col("e")[f] for f in TEXT_FIELDS})
    typed.update({f: F.from_json(F.col("e")[f], WINDOW_TYPE) for f in WINDOW_FIELDS})
    failed = [(F.col("e")[f].isNotNull() & typed[f].isNull()).cast("int") for f in [*CAST_FIELDS, *WINDOW_FIELDS] if f != "id"]
    no_object = F.col("e").isNull() | F.col("e._bad").isNotNull()
    given = F.col("e.id")
    reason = (F.when(no_object | (given.isNotNull() & typed["id"].isNull()), F.lit(EVENT_PARSE_ERROR))
              .when(typed["id"].isNull() | (typed["id"] == 0), F.lit(MISSING_ID)))
    return text.select("source_file", "pos", "event_text", *keep, *[c.alias(f) for f, c in typed.items()], given.alias("id_text"),
                       sum(failed[1:], failed[0]).alias("cast_failures"), reason.alias("bad_reason"))


def quarantined_events(events: DataFrame) -> DataFrame:
    """S09 quarantine: (source_file, reason, event_id) for events not loaded."""
    return (events.where(F.col("bad_reason").isNotNull())
            .select("source_file", F.col("bad_reason").alias("reason"),
                    F.coalesce("id_text", F.lit("")).alias("event_id")))


def loadable_events(events: DataFrame, ntz: bool = False) -> DataFrame:
    """Valid events with normalised timestamps; raw datetime text kept."""
    return (events.where(F.col("bad_reason").isNull())
            .withColumn("event_id", F.col("id"))
            .withColumn("event_datetime_ts", normalise_ts("event_datetime", ntz))
            .withColumn("event_utc_datetime_ts", normalise_ts("event_utc_datetime", ntz))
            .withColumn("stats_last_updated_at_ts", normalise_ts("stats_last_updated_at", ntz)))
