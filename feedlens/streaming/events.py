"""Signed webhook deliveries as a Structured Streaming pipeline.

Every transform here is stateless and works on a batch or a streaming
DataFrame alike: the registered batch queries and the stream share the code.

* ``read_webhooks`` (S6): ``(body binary, signature string, received_at)``
  records from files (parquet/JSON) or Kafka.
* ``route_deliveries`` (W1 = F8 + P18 + P19): verify the signature, parse the
  event, stamp ``receivedAt``; every delivery gets a ``status`` of ``ok``,
  ``bad_signature`` or ``bad_json`` so rejects go to a side output instead of
  failing the query.
* ``issue_events`` (F9) and ``enrich_events`` (J10): stream-static left join with
  the issue, state and team tables; a failed lookup never drops the event.
* ``start_feed`` (W3 / K5): append every verified event to a parquet feed with
  a checkpoint, so a restarted or re-scheduled query resumes exactly once.
* ``start_outputs`` (W1 + K5): verified and rejected deliveries from one verification.
* ``enrich_events_as_of`` / ``start_enriched`` (J10 with history): the issue as it was at the event.
* ``latest_events`` (T9): newest-first read of the feed; ``numbered_events`` gives every place.

Redeliveries are not deduplicated, and there is no watermark or window: the
handler being rebuilt keeps no state.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas
from feedlens.functions.crypto import hmac_sha256_hex, signing_key
from feedlens.operators.asof import join_as_of
from feedlens.operators.ranking import numbered

OK, BAD_SIGNATURE, BAD_JSON = "ok", "bad_signature", "bad_json"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def read_webhooks(spark: SparkSession, path: str, fmt: str = "parquet",
                  options: dict | None = None, signature_header: str = "signature") -> DataFrame:
    """Streaming source of raw deliveries.

    ``fmt`` is ``parquet`` or ``json`` (a landing folder with the
    ``WEBHOOK_RAW`` schema) or ``kafka`` (``value`` is the body, the header named
    ``signature_header`` (any case) the signature; needs the Kafka connector)."""
    opts = dict(options or {})
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**opts).option("includeHeaders", "true").load()
        wanted = signature_header.lower()
        sig = F.filter("headers", lambda h: F.lower(h["key"]) == F.lit(wanted))
        return raw.select(F.col("value").alias("body"),
                          F.get(sig, 0)["value"].cast("string").alias("signature"),
                          F.col("timestamp").alias("received_at"))
    reader = spark.readStream.schema(schemas.WEBHOOK_RAW).options(**opts)
    return reader.format(fmt).load(path)


def signature_ok(body, signature, key: DataFrame) -> Column:
    """F8: header present, trimmed, equal to the lower-case hex HMAC of the raw body
    (equal strings have equal length, so the length check is implied)."""
    sig = F.col(signature) if isinstance(signature, str) else signature
    return F.coalesce(F.trim(sig) == hmac_sha256_hex(body, key), F.lit(False))


def parse_event(body_text) -> list[Column]:
    """Typed fields of the event document (unknown keys stay in ``body``)."""
    b = F.col(body_text) if isinstance(body_text, str) else body_text
    ev = F.from_json(b, schemas.EVENT)
    return [ev["type"].alias("type"), ev["action"].alias("action"),
            ev["data"]["id"].alias("data_id"), ev["data"]["type"].alias("data_type"),
            ev["receivedAt"].alias("_event_received_at")]


def route_deliveries(raw: DataFrame, secret) -> DataFrame:
    """One row per delivery with ``status`` and the parsed event.

    The status passes through a generator, below which no filter on it moves: HMAC
    and JSON check run once per delivery however the rows are filtered later."""
    text = F.col("body").cast("string")
    sig_ok = signature_ok(F.col("body"), F.col("signature"), signing_key(raw.sparkSession, secret))
    well_formed = F.try_parse_json(text).isNotNull()
    status = (F.when(~sig_ok, F.lit(BAD_SIGNATURE)).when(~well_formed, F.lit(BAD_JSON))
              .otherwise(F.lit(OK)))
    out = (raw.select("received_at", text.alias("body_text"), F.explode(F.array(status)).alias("status"))
           .select("received_at", "body_text", "status", *parse_event("body_text")))
    stamped = F.coalesce(F.col("_event_received_at"),                       # P19: event wins
                         F.date_format("received_at", ISO_MILLIS))
    return out.select("received_at", "status", "type", "action", "data_id", "data_type",
                      F.when(F.col("status") == OK, stamped).alias("receivedAt"),
                      F.col("body_text").alias("body"))


def verified_events(raw: DataFrame, secret) -> DataFrame:
    return route_deliveries(raw, secret).filter(F.col("status") == OK)


def rejected_events(raw: DataFrame, secret) -> DataFrame:
    return (route_deliveries(raw, secret).filter(F.col("status") != OK)
            .select("received_at", "status", "body"))


def issue_events(events: DataFrame) -> DataFrame:
    """has a non-empty ``data.id`` and (type mentions ``issue`` in any case, or data.type is ``Issue``)."""
    return events.filter((F.col("data_id") != "")
                         & (F.coalesce(F.lower("type").contains("issue"), F.lit(False))
                            | F.coalesce(F.col("data_type") == "Issue", F.lit(False))))


def enrich_events(events: DataFrame, issues: DataFrame, states: DataFrame,
                  teams: DataFrame) -> DataFrame:
    """J10 (W2): issue-like events ⟕ issue ⟕ state ⟕ team; works as a stream-static
    join.  Events whose id matches no issue keep null lookups."""
    ev = issue_events(events)
    iss = (issues.join(states.select(F.col("id").alias("_sid"), F.col("name").alias("state_name")),
                       issues.state_id == F.col("_sid"), "left")
           .join(teams.select(F.col("id").alias("_tid"), F.col("name").alias("team_name")),
                 issues.team_id == F.col("_tid"), "left")
           .select(F.col("id").cast("string").alias("_iid"), F.col("identifier"),
                   F.col("title"), "state_name", "team_name"))
    return ev.join(iss, ev.data_id == iss._iid, "left").drop("_iid")


def start_feed(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
               query_name: str | None = None):
    """Append verified events to a parquet feed (exactly once per checkpoint)."""
    w = (events.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def latest_events(feed: DataFrame, n: int = 50) -> DataFrame:
    """The newest ``n`` events first (a top-k, planned as TakeOrderedAndProject)."""
    return feed.orderBy(F.desc("received_at"), F.desc("body")).limit(n)


def numbered_events(feed: DataFrame) -> DataFrame:
    """T9 for the whole feed: every event with its ``day`` and its ``place`` in that day, newest
    first.  Days then places give the whole feed in order without one global sort; places come
    from ranges of (day, time), so no task holds a day."""
    return numbered(feed.withColumn("day", F.to_date("received_at")), [F.desc("received_at"), F.desc("body")], ("day",))


# -- W1 / K5: both outputs from one verification -------------------------------------------------

FEED_COLUMNS = ("received_at", "status", "type", "action", "data_id", "data_type", "receivedAt", "body")
REJECT_COLUMNS = ("received_at", "status", "body")


def _write_output(rows: DataFrame, path: str, number: int) -> None:
    """One micro-batch of an output as its own folder; written again it replaces itself."""
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")


def start_outputs(raw: DataFrame, secret, feed: str, rejects: str, checkpoint: str, trigger: dict | None = None):
    """W1 + K5: verified deliveries to ``feed`` and rejected ones to ``rejects``, from one pass.

    Every micro-batch is verified once (kept while both outputs are written) and written under
    its number.  The checkpoint gives a batch that failed between the two writes the same rows and
    number again, so each output holds every delivery exactly once after any restart."""
    def both(batch: DataFrame, number: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _write_output(kept.filter(F.col("status") == OK).select(*FEED_COLUMNS), feed, number)
            _write_output(kept.filter(F.col("status") != OK).select(*REJECT_COLUMNS), rejects, number)
        finally:
            kept.unpersist()

    return (route_deliveries(raw, secret).writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_output(spark: SparkSession, path: str) -> DataFrame:
    """All batches of an output of :func:`start_outputs`."""
    return spark.read.parquet(path).drop("batch")


# -- W2 / J10: lookups as of the event -------------------------------------------------------------

VERSION_COLUMNS = ["identifier", "title", "state_name", "team_name"]


def enrich_events_as_of(events: DataFrame, versions: DataFrame) -> DataFrame:
    """J10 with history: issue-like events with the identifier, title, state and team their issue had
    at ``received_at``.  ``versions`` are (id, valid_from, identifier, title, state_name, team_name)
    rows, one for each change; events before the first version keep null lookups."""
    return join_as_of(issue_events(events), versions.withColumn("id", F.col("id").cast("string")),
                      "data_id", "received_at", "id", "valid_from", VERSION_COLUMNS)


def start_enriched(events: DataFrame, read_versions, path: str, checkpoint: str, trigger: dict | None = None):
    """W2 as a stream: every micro-batch meets the versions known when it runs (``read_versions()``
    gives them), only those of its own issues, and is written under its number."""
    def enrich(batch: DataFrame, number: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            versions = read_versions()
            wanted = issue_events(kept).select(F.col("data_id").alias("_id")).distinct()
            own = versions.join(wanted, versions["id"].cast("string") == F.col("_id"), "left_semi")
            _write_output(enrich_events_as_of(kept, own), path, number)
        finally:
            kept.unpersist()

    return (events.writeStream.foreachBatch(enrich).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
