"""Front-matter articles: parsing, validation, selection, layout slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import hold
from ..functions.frontmatter import entries, find, is_mapping, parses
from ..functions.text import dateline, image_urls, paragraphs, strip_ws
from .matching import left_join_known
from .topn import ranked

FRONT = r"(?s)^[ \t\r]*---[ \t\r]*\n(?:(.*?)\n)??[ \t\r]*---[ \t\r]*(?:\n(.*))?$"
FRONT_OPEN = r"(?s)^[ \t\r]*---[ \t\r]*(?:\n|$)"
# Required fields, in the order they are checked, and slot sizes.
REQUIRED = ["title", "subtitle", "slug", "author", "date", "dateline", "tags", "summary", "image"]
FRONT_PAGE = 21


def split_front_matter(files: DataFrame, content: str = "content") -> DataFrame:
    """Add ``front`` and ``body``; both null without a closed front matter."""
    c = F.concat(F.col(content))
    ok = c.rlike(FRONT)
    return files.withColumns(
        {
            "front": F.when(ok, F.regexp_extract(c, FRONT, 1)),
            "body": F.when(ok, F.regexp_extract(c, FRONT, 2)),
        }
    )


def parse_articles(files: DataFrame, content: str = "content") -> DataFrame:
    """Front matter as typed entries (``fm``), its fields as text (``fm_<field>``), ``fm_tags``
    array, dateline, paragraphs and images of the body.

    A field that is absent or null is null; of a repeated one the last counts.  Without a
    closed front matter all fields are null and the body is empty.
    """
    parted = split_front_matter(files, content)
    body = F.coalesce("body", F.lit(""))
    held = hold(parted, fm=entries(F.col("front")), body_dateline=dateline(body), paragraphs=paragraphs(body), images=image_urls(body))
    cols = {f"fm_{k}": _text(k) for k in REQUIRED if k != "tags"}
    cols["fm_tags"] = F.transform(find(F.col("fm"), "tags")["items"], lambda i: i["text"])
    return held.withColumns(cols)


def _text(key: str) -> Column:
    entry = find(F.col("fm"), key)
    return F.when(entry["kind"] != "null", entry["text"])


def _breaks(key: str) -> Column:
    """Whether a required field lacks a value of its type: text that is not blank, a date, a list of such texts."""
    entry = find(F.col("fm"), key)
    blank = lambda v: (v["kind"] != "str") | (strip_ws(v["text"]) == "")
    if key == "tags":
        broken = (entry["kind"] != "list") | (F.size(entry["items"]) < 1) | F.exists(entry["items"], blank)
    elif key == "date":
        broken = (entry["kind"] != "date") & blank(entry)
    else:
        broken = blank(entry)
    return F.coalesce(broken, F.lit(True))


#: Tasks that share the files of one slug when slugs that occur more than once are marked.
SLUG_SALT = 16


def violations(parsed: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    """Add ``violations``: every broken rule by name, in order.

    Fields are judged where the front matter parses and is a mapping; a value of another
    type breaks its field's rule as an absent one does.  Slugs are counted by a partial
    aggregate; only slugs that occur more than once are joined back, salted, and files
    without a slug are dealt over all tasks.
    """
    slug, fm = F.col("fm_slug"), F.col("fm")
    closed = F.col("front").isNotNull()
    present = closed & parses(fm) & is_mapping(fm)
    slug_text = F.coalesce(find(fm, "slug")["kind"] == "str", F.lit(False)) & present
    rules = [
        F.when(~F.col(name).endswith(".md"), "file extension"),
        F.when(~F.col(content).rlike(FRONT_OPEN), "front matter opens"),
        F.when(F.col(content).rlike(FRONT_OPEN) & ~closed, "front matter closes"),
        F.when(closed & ~is_mapping(fm), "front matter is a mapping"),
        F.when(closed & is_mapping(fm) & ~parses(fm), "front matter parses"),
    ]
    rules += [F.when(present & _breaks(key), f"field {key}") for key in REQUIRED]
    rules += [
        F.when(present & (strip_ws(F.coalesce("body", F.lit(""))) == ""), "body"),
        F.when(slug_text & ~slug.rlike(r"^[a-z0-9-]+\z"), "slug pattern"),
        F.when(
            present & F.col("fm_date").isNotNull()
            & (~F.col("fm_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") | F.try_to_date("fm_date", "yyyy-MM-dd").isNull()),
            "date format",
        ),
        F.when(F.col("__copied"), "slug unique"),
        F.when(slug_text & (F.regexp_replace(F.col(name), r"\.[^.]*$", "") != slug), "name equals slug"),
    ]
    keyed = parsed.withColumns({"__slug": F.when(slug_text, slug), "__salt": F.pmod(F.xxhash64(F.col(name)), F.lit(SLUG_SALT)).cast("int")})
    copies = keyed.where(F.col("__slug").isNotNull()).groupBy("__slug").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    salted = copies.select("__slug", F.lit(True).alias("__copied"), F.explode(F.sequence(F.lit(0), F.lit(SLUG_SALT - 1))).alias("__salt"))
    joined = left_join_known(keyed, salted, ["__slug", "__salt"])
    return joined.withColumn("violations", F.array_compact(F.array(*rules))).drop("__copied", "__slug", "__salt")


def select_articles(valid: DataFrame, date: str, slug: str, n: int = FRONT_PAGE) -> DataFrame:
    """Newest first, slug as tie-break, the first ``n`` with ``rank``."""
    return ranked(valid, [F.desc(date), F.asc(slug)], n, "rank")


def slots(chosen: DataFrame) -> DataFrame:
    """Rank to layout slot: hero 1, featured 2-6, secondary 7, two sidebar
    columns of three, four brief columns of two."""
    r = F.col("rank")
    slot = (
        F.when(r == 1, "hero").when(r <= 6, "featured").when(r == 7, "secondary").when(r <= 13, "sidebar").otherwise("briefs")
    )
    column = F.when(r.between(8, 13), F.floor((r - 8) / 3)).when(r >= 14, F.floor((r - 14) / 2)).otherwise(F.lit(0))
    place = (
        F.when(r <= 1, F.lit(0)).when(r <= 6, r - 2).when(r == 7, F.lit(0)).when(r <= 13, (r - 8) % 3).otherwise((r - 14) % 2)
    )
    return chosen.withColumns({"slot": slot, "column": column.cast("long"), "position": place.cast("long")})


def front_page(valid: DataFrame, date: str, slug: str) -> DataFrame:
    """Slots of the chosen articles; too few articles is an error."""
    chosen = select_articles(valid, date, slug)
    n = chosen.agg(F.count(F.lit(1)).alias("n")).scalar()
    checked = F.when(n < FRONT_PAGE, F.raise_error(F.lit(f"need {FRONT_PAGE} valid articles")).cast("string")).otherwise(F.col(slug))
    return slots(chosen.withColumn(slug, checked))
