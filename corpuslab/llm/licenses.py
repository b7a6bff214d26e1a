"""Licence scans: exact containment join of text blocks with licence templates, DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import hold
from ..session import Scratch
from .common import id_and_text

#: Phrases whose places are counted, with their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices as their licences give them, with the label of each.
TEMPLATES = {
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
    "apache-line": "Licensed under the Apache License, Version 2.0",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-line": "Released under the MIT License",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0",
    "unlicense-notice": "This is free and unencumbered software released into the public domain",
}
#: Share of a template's distinct words that a block must have.
CONTAINMENT = 0.8
#: Words of a block, and from one block to the next: each run of ``BLOCK - STEP`` words lies whole in some block.
BLOCK, STEP = 64, 32
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Word rank and template: the templates are few, so these tables are literals of the plan.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else; texts of ASCII alone go the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def template_words(templates: dict[str, str]) -> dict[str, list[str]]:
    """Distinct words of each template, in order of appearance."""
    cut = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
    table = str.maketrans({c: " " for c in cut})
    return {label: list(dict.fromkeys("".join(c.lower() if "A" <= c <= "Z" else c for c in t).translate(table).split())) for label, t in templates.items()}


def need(n: int, containment: float = CONTAINMENT) -> int:
    """Fewest shared words of a template with ``n`` distinct words."""
    return math.ceil(n * containment - 1e-9)


def phrase_starts(ws: Column, phrase: str) -> Column:
    """Starts, from 0, of the places where the phrase's words stand consecutively."""
    parts = phrase.split(" ")

    def here(i):
        same = F.get(ws, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            same = same & (F.get(ws, i + k) == p)
        return same

    last = F.size(ws) - len(parts)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(F.array().cast("array<int>"))


def labelled(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per input row.

    Base: places of ``PHRASES``.  Method: blocks of ``BLOCK`` words that hold at least
    ``containment`` of a template's distinct words.  Words are ordered by the number of
    documents they occur in, rarest first; a block that reaches the threshold must have
    one of the first ``n - need + 1`` words of the template (prefix), at least ``need``
    template words at all (length), and behind each match enough words must be left
    (position); what passes is verified in full.  ``score`` is the best containment, 1
    where a base phrase stands, 0 without any.

    Null counts as empty: no words, no labels, null places.  Repeated rows each give a
    row, null ids pass through, an empty table gives no rows.
    """
    spec = template_words(TEMPLATES if templates is None else templates)
    spec = {label: ws for label, ws in spec.items() if ws}
    vocabulary = sorted({w for ws in spec.values() for w in ws} | {p.split(" ")[-1] for p in PHRASES} | {p.split(" ")[0] for p in PHRASES})
    scratch = Scratch(docs.sparkSession, "licences")

    d = hold(id_and_text(docs, id_col, text_col), ws=words(F.col("text"))).drop("text")
    d = hold(d, hits=F.array_intersect("ws", F.lit(vocabulary)))
    # a document whose template words do not reach the threshold has no block that does
    possible = F.lit(False)
    for ws in spec.values():
        possible = possible | (F.size(F.array_intersect("hits", F.lit(ws))) >= need(len(ws), containment))
    starts = []
    for phrase, label in PHRASES.items():
        both = F.array_contains("hits", phrase.split(" ")[0]) & F.array_contains("hits", phrase.split(" ")[-1])
        found = labelled(phrase_starts(F.col("ws"), phrase), label)
        starts.append(F.when(both, found).otherwise(F.array().cast("array<struct<at:int,label:string>>")))
    d = hold(d, base=F.flatten(F.array(*starts)), n_words=F.size("ws").cast("long"), kept=F.when(possible, F.col("ws")))
    base = scratch.save(
        d.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "n_words",
            F.size("base").cast("long").alias("n_base"),
            F.array_min(F.transform("base", lambda x: x["at"])).cast("long").alias("first_word"),
            F.array_max(F.transform("base", lambda x: x["at"])).cast("long").alias("last_word"),
            F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"]))).alias("base_list"),
            "hits",
            F.col("kept").alias("ws"),
        ),
        "base",
    )

    # global order: rarest first; at most one row per vocabulary word comes back
    counts = {r["w"]: r["n"] for r in base.select(F.explode("hits").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    ranked = {label: sorted(ws, key=order.__getitem__) for label, ws in spec.items()}
    prefixes = [
        (w, label, p, len(ws), need(len(ws), containment), ws)
        for label, ws in ranked.items()
        for p, w in enumerate(ws[: len(ws) - need(len(ws), containment) + 1])
    ]
    spark = docs.sparkSession
    prefix = F.broadcast(spark.createDataFrame(prefixes, "word string, template string, place int, n int, need int, template_words array<string>"))
    by_rank = F.lit([w for w, _ in sorted(order.items(), key=lambda x: x[1])])

    blocks = base.where(F.col("ws").isNotNull() & (F.size("ws") > 0)).select(
        "row", F.explode(F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size("ws") - (BLOCK - STEP) - 1, F.lit(0)) / STEP).cast("int")), lambda b: F.slice("ws", b * STEP + 1, BLOCK))).alias("block")
    )
    # template words of the block in global order
    blocks = hold(blocks, own=F.array_intersect(by_rank, F.col("block"))).drop("block")
    tokens = blocks.select("row", "own", F.posexplode("own").alias("at", "word"))
    left = F.least(F.col("n") - F.col("place"), F.size("own") - F.col("at"))
    pairs = tokens.join(prefix, "word").where((F.size("own") >= F.col("need")) & (F.col("place") + left >= F.col("need")))
    shared = F.size(F.array_intersect("own", "template_words"))
    links = pairs.where(shared >= F.col("need")).select("row", "template", (shared / F.col("n")).alias("share"))
    found = links.groupBy("row").agg(F.array_sort(F.collect_set("template")).alias("found"), F.max("share").alias("share"))

    out = base.drop("ws", "hits").join(found, "row", "left")
    every = F.array_sort(F.array_union("base_list", F.coalesce("found", F.array().cast("array<string>"))))
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_list", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def sql() -> str:
    """The same rows by comparing every block with every template."""
    spec = template_words(TEMPLATES)
    rows = ", ".join("('" + label + "', [" + ", ".join(f"'{w}'" for w in ws) + f"], {len(ws)}, {need(len(ws))})" for label, ws in spec.items())
    phrases = ", ".join("('" + p + "', '" + label + "')" for p, label in PHRASES.items())
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), phrases(phrase, label) AS (VALUES {phrases}), templates(label, tw, n, need) AS (VALUES {rows}),
p AS (SELECT string_split(phrase, ' ') AS pw, label FROM phrases),
places AS (
  SELECT doc_id, label, i AS place FROM w, p, unnest(range(len(ws))) AS t(i) WHERE ws[i + 1] = pw[1] AND ws[i + 1 : i + len(pw)] = pw
), base AS (
  SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS labels FROM places GROUP BY doc_id
), blocks AS (
  SELECT doc_id, ws[b * {STEP} + 1 : b * {STEP} + {BLOCK}] AS block FROM w, unnest(range(greatest(len(ws) - {BLOCK - STEP} - 1, 0) // {STEP} + 1)) AS t(b)
), shares AS (
  SELECT doc_id, label, max(len(list_intersect(block, tw)) / n) AS share FROM blocks, templates WHERE len(list_intersect(block, tw)) >= need GROUP BY ALL
), found AS (SELECT doc_id, max(share) AS share, list(DISTINCT label) AS labels FROM shares GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(base.n, 0) AS n_base, base.lo AS first_word, base.hi AS last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
  CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(found.share, 0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""
