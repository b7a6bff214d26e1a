"""Publication records, cadence per channel, incremental reuse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import instant, whole_minutes

DAYS_PER_WEEK = 7.0
DAYS_PER_MONTH = 30.436875  # 365.2425 / 12


def _typed(doc: Column, key: str, kinds: tuple[str, ...]) -> tuple[Column, Column]:
    """(value of the key, whether it has one of the JSON types)."""
    node = F.try_variant_get(doc, f"$.{key}", "variant")
    kind = F.schema_of_variant(node)
    ok = F.lit(False)
    for k in kinds:
        ok = ok | kind.startswith(k)
    return node, F.coalesce(ok, F.lit(False))


_NUMBER = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def parse_metadata(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Typed publication fields of JSON metadata plus ``reason``.

    Types are strict: a boolean or a numeric string is not a number, an empty
    string is missing.  ``reason`` is null for a good row; bad rows stay in the
    frame so the caller can route them.
    """
    doc = F.try_parse_json(F.col(payload))
    ts, ts_ok = _typed(doc, "timestamp", _NUMBER)
    duration, duration_ok = _typed(doc, "duration", _NUMBER)
    ts = F.try_variant_get(doc, "$.timestamp", "double")
    duration = F.try_variant_get(doc, "$.duration", "double")
    texts = {k: F.try_variant_get(doc, f"$.{k}", "string") for k in ("channel_id", "title", "id")}

    reason = (
        F.when(doc.isNull(), "invalid JSON")
        .when(~F.schema_of_variant(doc).startswith("OBJECT"), "not an object")
        .when(~ts_ok, "timestamp")
        .when(instant(ts).isNull(), "timestamp range")
        .when(~duration_ok, "duration")
        .when(duration < 0, "negative duration")
    )
    for key, value in texts.items():
        _, is_text = _typed(doc, key, ("STRING",))
        reason = reason.when(~is_text | (F.coalesce(value, F.lit("")) == ""), key)
    good = reason.isNull()
    return raw.withColumns(
        {
            "published_at": F.when(good, instant(ts)),
            "duration_minutes": F.when(good, whole_minutes(duration)),
            "channel_id": F.when(good, texts["channel_id"]),
            "title": F.when(good, texts["title"]),
            "video_id": F.when(good, texts["id"]),
            "reason": reason,
        }
    )


def parse_video_metadata(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Title, description, id and ISO upload date of JSON metadata, with the
    first violated rule in ``reason``."""
    from ..functions.times import compact_date

    doc = F.try_parse_json(F.col(payload))

    def text(key: str) -> tuple[Column, Column, Column]:
        node = F.try_variant_get(doc, f"$.{key}", "variant")
        kind = F.schema_of_variant(node)
        absent = node.isNull() | (kind == "VOID")
        return F.try_variant_get(doc, f"$.{key}", "string"), F.coalesce(kind.startswith("STRING"), F.lit(False)), absent

    title, title_ok, _ = text("title")
    description, description_ok, no_description = text("description")
    ident, ident_ok, no_ident = text("id")
    day, day_ok, no_day = text("upload_date")
    parsed = compact_date(day)
    reason = (
        F.when(doc.isNull(), "invalid JSON")
        .when(~F.schema_of_variant(doc).startswith("OBJECT"), "not an object")
        .when(~title_ok | (F.coalesce(title, F.lit("")) == ""), "title")
        .when(~no_description & ~description_ok, "description")
        .when(~no_ident & (~ident_ok | (F.coalesce(ident, F.lit("")) == "")), "id")
        .when(~no_day & ~day_ok, "upload_date type")
        .when(~no_day & ~day.rlike("^[0-9]{8}$"), "upload_date shape")
        .when(~no_day & parsed.isNull(), "upload_date calendar")
    )
    good = reason.isNull()
    return raw.withColumns(
        {
            "title": F.when(good, title),
            "description": F.when(good & ~no_description, description),
            "video_id": F.when(good & ~no_ident, ident),
            "upload_date": F.when(good & ~no_day, parsed),
            "reason": reason,
        }
    )


def _rates(agg: DataFrame) -> DataFrame:
    span = F.datediff(F.to_date("last_published"), F.to_date("first_published")) + 1
    per_day = F.col("video_count") / F.col("span_days")
    return (
        agg.withColumn("span_days", span.cast("long"))
        .withColumn("per_day", per_day)
        .withColumn("per_week", F.col("per_day") * DAYS_PER_WEEK)
        .withColumn("per_month", F.col("per_day") * DAYS_PER_MONTH)
    )


def _window_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("video_count"),
        F.min("published_at").alias("first_published"),
        F.max("published_at").alias("last_published"),
    ]


def channel_frequencies(pubs: DataFrame) -> DataFrame:
    """Mean rates per channel over its inclusive day span, with the channel id
    of the newest record."""
    newest = F.max_by("channel_id", F.struct("published_at", "video_id")).alias("channel_id")
    return _rates(pubs.groupBy("channel").agg(*_window_aggregates(), newest))


def frequency_report(pubs: DataFrame) -> DataFrame:
    """Per-channel rows plus a TOTAL row over the union of all windows."""
    sets = pubs.groupingSets([["channel"], []], "channel").agg(
        *_window_aggregates(), F.grouping("channel").cast("long").alias("is_total")
    )
    return _rates(sets.withColumn("channel", F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("channel"))))


def by_rate(frequencies: DataFrame) -> DataFrame:
    return frequencies.orderBy(F.desc("per_day"), F.asc("channel"))


def least_frequent_first(frequencies: DataFrame) -> DataFrame:
    return frequencies.orderBy(F.asc("per_day"), F.asc("channel")).select("channel_id", "per_day")


def channel_id_map(meta: DataFrame) -> DataFrame:
    """One channel id per folder: that of the first readable file."""
    readable = F.when(F.col("channel_id").isNotNull(), F.col("path"))
    return meta.groupBy("channel").agg(F.min_by("channel_id", readable).alias("channel_id")).where("channel_id is not null")


def incremental_records(
    current: DataFrame, existing: DataFrame, counts: DataFrame, recorded: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Reuse the stored rows of channels whose file count is unchanged, take
    the others from ``current``.

    ``counts`` and ``recorded`` are (channel, n_files).  Returns (records with
    ``origin``, channels with ``reused``).
    """
    held = existing.select("channel").distinct().withColumn("__held", F.lit(True))
    decided = (
        counts.join(recorded.withColumnRenamed("n_files", "__was"), "channel", "left")
        .join(held, "channel", "left")
        .select(
            "channel",
            "n_files",
            F.coalesce((F.col("n_files") == F.col("__was")) & F.col("__held"), F.lit(False)).alias("reused"),
        )
    )
    kept = existing.join(decided.where("reused").select("channel"), "channel", "left_semi")
    read = current.join(decided.where("not reused").select("channel"), "channel", "left_semi")
    records = kept.withColumn("origin", F.lit("reused")).unionByName(read.withColumn("origin", F.lit("rescanned")))
    return records, decided
