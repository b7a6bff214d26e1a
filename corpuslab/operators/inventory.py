"""File-inventory audits.

An inventory row is (stage, channel, dir, name, size, mtime): one file found
below ``stage/channel``.  Listings come from ``sources.files.inventory``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bracket_id, without_bracket_id

# Processing stages, upstream first, and the file kinds counted.
FILTER_ORDER = ["videos", "audio", "transcripts"]
VIDEO_SUFFIXES = ["mp4", "webm", "m4a", "mov", "m4v", "avi", "mkv", "flv"]
STAGE_KINDS = {
    "videos_active": ("videos", VIDEO_SUFFIXES),
    "videos_archived": ("archive", VIDEO_SUFFIXES),
    "audio": ("audio", ["wav"]),
    "transcripts": ("transcripts", ["srt"]),
    "hall_analysis": ("hallucinations", ["json"]),
    "cleaned_transcripts": ("cleaned", ["srt"]),
    "summaries": ("summaries", ["md"]),
}
PARTIAL = r"\.f[0-9][^/]*\."
GROUP_SUFFIXES = ["srt", "txt", "vtt", "tsv", "json"]
IGNORED_NAMES = ("downloaded.txt",)
IGNORED_SUFFIXES = ("sh",)
MIN_CHECKED_SECONDS = 60
MIN_BYTES_PER_SECOND = 1000


def visible(files: DataFrame) -> DataFrame:
    """Without sidecar files."""
    return files.where(~F.col("name").startswith("._"))


def suffix(name: Column) -> Column:
    return F.regexp_extract(name, r"\.([^./]+)$", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^./]+$", "")


def stage_counts(files: DataFrame) -> DataFrame:
    """Files per channel and stage, and video bytes."""
    seen = visible(files)
    kind = suffix(F.col("name"))
    aggs = [
        F.count_if((F.col("stage") == stage) & kind.isin(kinds)).alias(out)
        for out, (stage, kinds) in STAGE_KINDS.items()
    ]
    video = F.col("stage").isin("videos", "archive") & kind.isin(VIDEO_SUFFIXES)
    size = F.coalesce(F.sum(F.when(video, F.col("size"))), F.lit(0)).alias("total_size_bytes")
    return seen.groupBy("channel").agg(*aggs, size)


def completion(counts: DataFrame) -> DataFrame:
    """Work units and completion per channel plus a TOTAL row.

    A unit is a transcript or a not yet transcribed item; one present as video
    and as audio counts once.
    """
    unit = F.col("transcripts") + F.greatest("videos_active", "audio")
    cols = list(STAGE_KINDS)
    sums = [F.sum(c).alias(c) for c in cols]
    table = counts.withColumn("work_units", unit).groupingSets([["channel"], []], "channel").agg(
        F.grouping("channel").cast("long").alias("is_total"), *sums,
        F.sum("work_units").alias("work_units"), F.sum("total_size_bytes").alias("total_size_bytes"),
    )

    def pct(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part) * 100.0, F.col(whole)), F.lit(0.0))

    return table.withColumns(
        {
            "channel": F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("channel")),
            "completion_pct": pct("summaries", "work_units"),
            "hall_pct": pct("hall_analysis", "transcripts"),
            "cleaned_pct": pct("cleaned_transcripts", "transcripts"),
            "summaries_pct": pct("summaries", "transcripts"),
        }
    )


def mismatched(counts: DataFrame) -> DataFrame:
    """Channels whose transcript stages do not all hold the same count."""
    t = F.col("transcripts")
    same = (t == F.col("hall_analysis")) & (t == F.col("cleaned_transcripts")) & (t == F.col("summaries"))
    return counts.where(~same)


def deltas(current: DataFrame, previous: DataFrame, columns: list[str], clamp: int = 99) -> DataFrame:
    """Change per channel and column against the previous run, clamped; null
    where the channel was not there before."""
    old = previous.select("channel", F.lit(True).alias("__was"), *[F.col(c).alias(f"__{c}") for c in columns])
    both = current.select("channel", *columns).join(old, "channel", "full")
    out = {}
    for c in columns:
        diff = F.coalesce(c, F.lit(0)) - F.col(f"__{c}")
        out[f"{c}_delta"] = F.when(F.col("__was"), F.greatest(F.lit(-clamp), F.least(F.lit(clamp), diff)).cast("long"))
    return both.withColumns(out).select("channel", *[F.coalesce(c, F.lit(0)).alias(c) for c in columns], *out)


def labelled(table: DataFrame, categories: DataFrame) -> DataFrame:
    """Replace channel names by their upper-case category; ``UNKNOWN`` where
    none is mapped."""
    joined = table.join(categories.select("channel", "category"), "channel", "left")
    return joined.withColumn("label", F.coalesce(F.nullif(F.upper("category"), F.lit("")), F.lit("UNKNOWN"))).drop("category")


def id_and_plain_pairs(files: DataFrame) -> DataFrame:
    """Files with an id next to the same name without it, in one folder."""
    seen = visible(files)
    named = seen.withColumn("video_id", bracket_id("name")).where("video_id is not null")
    keyed = named.withColumn("plain_name", without_bracket_id("name"))
    plain = seen.select("stage", "channel", "dir", F.col("name").alias("plain_name")).distinct()
    return keyed.join(plain, ["stage", "channel", "dir", "plain_name"], "left_semi").select(
        "stage", "channel", "dir", "video_id", F.col("name").alias("file_with_id"), F.col("plain_name").alias("file_without_id")
    )


def orphans(files: DataFrame, ignored_names: tuple[str, ...] = IGNORED_NAMES, ignored_suffixes: tuple[str, ...] = IGNORED_SUFFIXES) -> DataFrame:
    """Files without an id and without an id-bearing sibling."""
    seen = files.where(~F.col("name").startswith("."))
    if ignored_names:
        seen = seen.where(~F.col("name").isin(*ignored_names))
    if ignored_suffixes:
        seen = seen.where(~suffix(F.col("name")).isin(*ignored_suffixes))
    covered = (
        seen.where(bracket_id("name").isNotNull())
        .select("stage", "channel", "dir", without_bracket_id("name").alias("name"))
        .distinct()
    )
    return seen.where(bracket_id("name").isNull()).join(covered, ["stage", "channel", "dir", "name"], "left_anti")


def orphan_totals(found: DataFrame) -> DataFrame:
    """Orphans per stage plus a TOTAL row."""
    return found.groupingSets([["stage"], []], "stage").agg(
        F.grouping("stage").cast("long").alias("is_total"), F.count(F.lit(1)).alias("n")
    ).select(F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("stage")).alias("stage"), "n")


def orphan_titles(found: DataFrame) -> DataFrame:
    return found.select("channel", stem(F.col("name")).alias("title")).distinct()


def parse_filter(entries: DataFrame) -> DataFrame:
    """(stage, entry) with entry ``channel/id`` to (stage, channel, video_id);
    malformed entries are dropped."""
    parts = F.regexp_extract("entry", "^([^/]+)/(.+)$", 1), F.regexp_extract("entry", "^([^/]+)/(.+)$", 2)
    return entries.select("stage", parts[0].alias("channel"), parts[1].alias("video_id")).where("video_id <> ''")


def skip_filtered(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Drop files whose (stage, channel, id) is listed."""
    keyed = files.withColumn("video_id", bracket_id("name"))
    return keyed.join(listed.select("stage", "channel", "video_id").distinct(), ["stage", "channel", "video_id"], "left_anti")


def filtered_leftovers(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Files whose id is listed under any stage."""
    keyed = files.where(~F.col("name").startswith(".")).withColumn("video_id", bracket_id("name"))
    return keyed.join(listed.select("video_id").distinct(), "video_id", "left_semi")


def filter_targets(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Files hit by a filter entry at its own stage and every stage upstream."""
    upstream = F.lit(None).cast("array<string>")
    for i, name in enumerate(FILTER_ORDER):
        stages = F.array(*[F.lit(s) for s in FILTER_ORDER[: i + 1]])
        upstream = F.when(F.col("filter_stage") == name, stages).otherwise(upstream)
    spread = listed.select(F.col("stage").alias("filter_stage"), "channel", "video_id").distinct()
    spread = spread.withColumn("stage", F.explode(upstream))
    keyed = files.withColumn("video_id", F.regexp_extract("name", r"\[([A-Za-z0-9_-]+)\]", 1))
    return keyed.join(spread, ["stage", "channel", "video_id"])


def target_bytes(targets: DataFrame) -> DataFrame:
    once = targets.select("stage", "channel", "video_id", "dir", "name", "size").distinct()
    return once.groupBy("channel", "video_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"))


def merge_filter(existing: DataFrame, new: DataFrame) -> DataFrame:
    cols = ["stage", "channel", "video_id"]
    return existing.select(*cols).unionByName(new.select(*cols)).distinct()


def empty_by_suffix(files: DataFrame) -> DataFrame:
    return (
        visible(files).where("size = 0").groupBy(suffix(F.col("name")).alias("ext"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "ext")
    )


def small_transcripts(files: DataFrame, max_bytes: int = 100) -> DataFrame:
    return visible(files).where((F.col("stage") == "transcripts") & (suffix(F.col("name")) == "txt") & (F.col("size") <= max_bytes))


def empty_groups(files: DataFrame) -> DataFrame:
    """Every format of a transcript whose srt file is empty."""
    keyed = files.withColumns({"stem": stem(F.col("name")), "ext": suffix(F.col("name"))})
    empty = keyed.where("ext = 'srt' and size = 0").select("stage", "channel", "dir", "stem").distinct()
    return keyed.where(F.col("ext").isin(GROUP_SUFFIXES)).join(empty, ["stage", "channel", "dir", "stem"], "left_semi")


def files_of(files: DataFrame, video_id: str) -> DataFrame:
    return visible(files).where(F.contains("name", F.lit(video_id)))


def short_videos(media: DataFrame, max_seconds: int) -> DataFrame:
    """Reason codes from media facts (stage, channel, name, duration_s,
    has_audio): short, without audio, both, or an audio-only short orphan."""
    ident = F.regexp_extract("name", r"\[([A-Za-z0-9_-]{11})\]", 1)
    facts = visible(media).withColumn("video_id", ident).where("video_id <> ''")
    is_short = F.coalesce(F.col("duration_s") < max_seconds, F.lit(False))
    silent = ~F.col("has_audio")
    video = facts.where((F.col("stage") == "videos") & F.lower(suffix(F.col("name"))).isin(VIDEO_SUFFIXES))
    reason = (
        F.when(is_short & silent, "short+no_audio").when(is_short, "short").when(silent, "no_audio")
    )
    hits = video.withColumn("reason", reason).where("reason is not null")
    wav = facts.where((F.col("stage") == "audio") & (F.lower(suffix(F.col("name"))) == "wav"))
    alone = wav.join(video.select("channel", "video_id").distinct(), ["channel", "video_id"], "left_anti")
    short_wav = alone.where(is_short).withColumn("reason", F.lit("short_wav_orphan"))
    cols = ["channel", "video_id", "duration_s", "reason"]
    return hits.select(*cols).unionByName(short_wav.select(*cols))


def media_verdict(duration_text: Column, size: Column) -> Column:
    """Reason why a media file looks corrupt, or null."""
    seconds = duration_text.try_cast("double")
    rate = F.try_divide(size, seconds)
    return (
        F.when(F.coalesce(duration_text, F.lit("")).isin("", "N/A"), F.lit("unreadable"))
        .when(~duration_text.rlike(r"^[0-9]+(\.[0-9]+)?$"), F.lit("invalid duration"))
        .when((seconds > MIN_CHECKED_SECONDS) & (rate < MIN_BYTES_PER_SECOND), F.lit("incomplete download"))
    )


def unchecked(files: DataFrame, cache: DataFrame, now: int, min_age: int = 60) -> DataFrame:
    """Settled files whose (path, mtime, size) is not in the check cache."""
    settled = files.where(F.lit(now) - F.col("mtime") >= min_age)
    return settled.join(cache.select("path", "mtime", "size").distinct(), ["path", "mtime", "size"], "left_anti")


def media_stems(files: DataFrame, priority: list[str]) -> DataFrame:
    """Name up to and including ``[id]`` from the first stage that holds it."""
    order = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("stage"))
    ident = F.regexp_extract("name", r"\[([A-Za-z0-9_-]+)\]", 1)
    found = visible(files).withColumns({"video_id": ident, "__p": order}).where("video_id <> '' and __p > 0")
    cut = F.regexp_extract("name", r"^(.*?\[[A-Za-z0-9_-]+\])", 1)
    first = F.min(F.struct("__p", "name", cut.alias("stem"))).alias("__m")
    return found.groupBy("channel", "video_id").agg(first).select("channel", "video_id", F.col("__m.stem").alias("stem"))


def metadata_for_media(media: DataFrame, metadata: DataFrame) -> DataFrame:
    """Metadata file by exact stem, else the first one with the same id."""
    exact = metadata.select("channel", F.col("stem").alias("__s"), F.col("name").alias("__exact"))
    exact = exact.groupBy("channel", "__s").agg(F.min("__exact").alias("__exact"))
    by_id = metadata.where("video_id is not null").groupBy("channel", "video_id").agg(F.min("name").alias("__by_id"))
    return (
        media.join(exact.withColumnRenamed("__s", "stem"), ["channel", "stem"], "left")
        .join(by_id, ["channel", "video_id"], "left")
        .withColumn("metadata_name", F.coalesce("__exact", "__by_id"))
        .drop("__exact", "__by_id")
    )


def partial_downloads(files: DataFrame) -> DataFrame:
    """Interrupted merges per id: artifacts with their count, channel, and whether
    the merged file is there."""
    ident = F.regexp_extract("name", r"\[([A-Za-z0-9_-]{11})\]", 1)
    named = visible(files).withColumn("video_id", ident).where("video_id <> ''")
    parts = named.where(F.col("name").rlike(PARTIAL)).groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n_artifacts"), F.min("channel").alias("channel"), F.min("name").alias("first_artifact"),
        F.array_join(F.array_sort(F.collect_list("name")), ";").alias("artifacts"),
    )
    merged = named.where(
        F.col("name").endswith(".mp4") & ~F.col("name").rlike(r"\.f[0-9][^/]*\.mp4$") & ~F.col("name").endswith(".temp.mp4")
    ).select("video_id").distinct().withColumn("__m", F.lit(True))
    return parts.join(merged, "video_id", "left").withColumn("merged", F.coalesce("__m", F.lit(False))).drop("__m")


def fully_skipped(skipped: DataFrame, processed: DataFrame) -> DataFrame:
    """Channels with skipped files and no processed one."""
    return skipped.select("channel").distinct().join(processed.select("channel"), "channel", "left_anti")


def limited_per_channel(
    pending: DataFrame, limits: DataFrame, order: list[str], run_limit: int | None = None, default_limit: int = -1
) -> DataFrame:
    """Pending items within their channel's limit (0 none, -1 all); ``default_limit``
    holds for channels without a limit row.

    The rank is computed only for limited channels; unlimited ones skip it.
    Then the run limit applies in channel order.
    """
    from .topn import top_per_group

    caps = limits.select("channel", F.col("item_limit").alias("__cap"))
    joined = pending.join(caps, "channel", "left").withColumn("__cap", F.coalesce("__cap", F.lit(default_limit)))
    free = joined.where("__cap = -1").drop("__cap")
    largest = max(limits.agg(F.max("item_limit").alias("m")).first()["m"] or 0, default_limit)
    capped = joined.where("__cap > 0")
    ranked = top_per_group(capped, ["channel"], [F.asc(c) for c in order], max(int(largest), 1), spread_on=order[-1], rank="__rank")
    out = free.unionByName(ranked.where("__rank <= __cap").drop("__rank", "__cap"))
    return out if run_limit is None else out.orderBy("channel", *order).limit(run_limit)


def pending_order(pending: DataFrame, order: list[str]) -> DataFrame:
    """Channels with the fewest pending items first, then channel and file."""
    sizes = pending.groupBy("channel").agg(F.count(F.lit(1)).alias("channel_pending"))
    return pending.join(sizes, "channel").orderBy("channel_pending", "channel", *order)
