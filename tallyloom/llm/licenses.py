"""License scan: MinHash bands over overlapping windows find templates, exact containment confirms.

Texts and templates become words (runs of letters and digits, lower case) and shingles of five
words. Windows are W shingles long by the template's length class: 1 for templates of fewer than
``LONG`` distinct shingles, ``WINDOW`` else. A template is cut into windows at every place, a text
at every second one (every one for W = 1). Each of ``BANDS`` bands keeps a window's smallest shingle
hash under its own order, and a template that shares a band key with a text becomes a candidate.

How surely that finds a template whose shingles a text holds to 75 % and more:

- A run of WINDOW + 1 = 5 shared shingles (nine words on end) holds one of the text's windows whole,
  and the template has that very window, so all bands agree: certain.
- An edit of a word or a cut costs at least four shingles in a row, so n shingles of which a quarter
  is lost are left in at most n / 16 + 1 runs, the longest of which has 0.75 n / (n / 16 + 1)
  shingles: 6 or more from n = 8 on. Edited copies are thus found with certainty, if the template
  repeats no shingle; else, where fewer places can hold the distinct ones, by runs and bands as above.
- A text that holds every shingle in a place of its own meets in at least 0.99 of the cases (measured in
  tests/llm); fewer than 8 shingles are windows of their own, so they are found with certainty.

Everything is DataFrame expressions. Keys are exploded without the texts and joined with a table
of the templates' keys; only candidates are shingled again and verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import read, stored

SHINGLE = 5
WINDOW = 4
LONG = 8
STEP = 2
BANDS = 4
#: Share of a template's shingles that a text must hold.
CONTAINED = 0.75
#: Rows that are broadcast at most (keys of templates, candidates); more are joined by shuffles.
BROADCAST_ROWS = 1_000_000
#: A band's order of hashes is that of their exclusive or with its mask, each from another quarter.
MASKS = tuple((band - 2) * 2**62 + 0x1D8E4E27C47D124F for band in range(BANDS))

# Notices by which works name their license.
TEMPLATES = (
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("mit-line", "Released under the MIT License."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    (
        "apache-2.0-notice",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "mit-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "mpl-2.0-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
)


def _shingled(df: DataFrame, text: str) -> DataFrame:
    """Add __words and __shingles. Fewer than five words are one shingle, none give none."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^\\p{L}\\p{N}]+"), "")
    out = df.withColumn("__words", words)
    many = F.transform(
        F.slice("__words", F.lit(1), F.greatest(F.lit(0), F.size("__words") - (SHINGLE - 1))),
        lambda w, i: F.xxhash64(w, *[F.get("__words", i + j) for j in range(1, SHINGLE)]),
    )
    one = F.array(F.xxhash64(F.concat_ws(" ", "__words"), F.lit("short")))
    return out.withColumn(
        "__shingles",
        F.when(F.size("__words") >= SHINGLE, many)
        .when(F.size("__words") > 0, one)
        .otherwise(F.array().cast("array<bigint>")),
    )


def _band_keys(shingles: str, step: int) -> Column:
    """Smallest hashes, band by band, of the windows of WINDOW shingles that start every ``step`` shingles."""
    last = F.size(shingles) - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))

    def band(mask: int) -> Column:
        # The array of one keeps the masked hashes from being worked out anew for every window.
        masked = F.array(F.transform(shingles, lambda x: x.bitwiseXOR(F.lit(mask))))
        return F.flatten(F.transform(
            masked, lambda m: F.transform(starts, lambda i: F.array_min(F.slice(m, i + 1, F.lit(WINDOW))))
        ))

    return F.flatten(F.array(*[band(mask) for mask in MASKS]))


def _templates(given: DataFrame) -> DataFrame:
    """Per template its id, distinct shingles and the keys of its length class."""
    shingled = _shingled(given.select("template", "template_text").distinct(), "template_text")
    return stored(
        shingled.withColumn("__own", F.array_distinct("__shingles")).select(
            F.xxhash64("template", "template_text").alias("__id"), "template", "__own",
            (F.size("__own") >= LONG).alias("__long"),
            F.array_distinct(
                F.when(F.size("__own") >= LONG, _band_keys("__shingles", 1)).otherwise(F.col("__own"))
            ).alias("__keys"),
        ),
        "license-templates",
    )


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has few rows; Spark picks the join else."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _candidates(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """Per (doc_id, __digest) the ids of the templates that share a band key with the text."""
    sizes = {r["__long"]: r["n"] for r in templates.groupBy("__long").agg(F.sum(F.size("__keys")).alias("n")).collect()}
    # Windows of a length class are made if there is a template of that class.
    classes = []
    if sizes.get(False):
        classes.append(F.col("__shingles"))
    if sizes.get(True):
        classes.append(_band_keys("__shingles", STEP))
    if not classes:
        classes = [F.array().cast("array<bigint>")]
    keys = templates.select("__id", F.explode("__keys").alias("__key"))
    shingled = _shingled(docs, "text").select("doc_id", "__digest", "__shingles")
    marked = shingled.select("doc_id", "__digest", F.explode(F.array_distinct(F.concat(*classes))).alias("__key"))
    return stored(
        marked.join(_bounded(keys, sum(sizes.values())), "__key")
        .groupBy("doc_id", "__digest").agg(F.collect_set("__id").alias("__ids")),
        "license-candidates",
    )


def scan(docs: DataFrame, templates: DataFrame | None = None, contained: float = CONTAINED) -> DataFrame:
    """One row per document and template found: doc_id, template, n_template, n_shared, containment.

    ``templates`` has the columns template and template_text and any number of rows; without it,
    ``TEMPLATES``. A template counts as found if the text holds at least ``contained`` of its
    distinct shingles, wherever they stand; the recall stated above is that for 0.75. Templates
    without words are never found; of texts that share a name the one with the largest share counts.
    Null and blank texts hold none. Rows that share a doc_id give one row per template, with the
    larger share. A null doc_id is reported as null. An empty table, or no templates, gives an empty
    result; other columns than doc_id and text are not read.
    """
    spark = docs.sparkSession
    if templates is None:
        templates = given_templates(spark)
    table = _templates(templates)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("__digest"))
    found = _candidates(texts, table)
    near = _bounded(found.withColumnRenamed("doc_id", "__doc"), found.count())
    met = texts.join(near, F.col("doc_id").eqNullSafe(F.col("__doc")) & (texts["__digest"] == near["__digest"]))
    held = _shingled(met.select("doc_id", "text", "__ids"), "text").select(
        "doc_id", F.array_distinct("__shingles").alias("__held"), "__ids"
    )
    pairs = held.select("doc_id", "__held", F.explode("__ids").alias("__id"))
    shared = pairs.join(table.select("__id", "template", "__own"), "__id").select(
        "doc_id", "template", F.size("__own").cast("long").alias("n_template"),
        F.size(F.array_intersect("__own", "__held")).cast("long").alias("n_shared"),
    )
    best = F.max(F.struct(
        (F.col("n_shared") / F.col("n_template")).alias("containment"), "n_shared", "n_template"
    )).alias("best")
    return (
        shared.groupBy("doc_id", "template").agg(best)
        .select("doc_id", "template", "best.n_template", "best.n_shared", "best.containment")
        .where(F.col("containment") >= contained)
    )


def given_templates(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """Pairs of name and text as a table for ``scan``."""
    return spark.createDataFrame([*templates], "template string, template_text string")


def op10_license_scan(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents"))


def _sql() -> str:
    quoted = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEMPLATES)
    return f"""
with template(template, text) as (values {quoted}),
given as (
  select 't' as kind, template as id, text from template
  union all select 'd', doc_id::varchar, text from documents
),
words as (
  select kind, id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') as w
  from given
),
shingles as (
  select distinct kind, id, unnest(
    case when len(w) >= 5
      then list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
      when len(w) > 0 then ['short ' || array_to_string(w, ' ')] else [] end) as s
  from words
),
sizes as (select id, count(*) as n_template from shingles where kind = 't' group by id),
shared as (
  select d.id as doc_id, t.id as template, count(*) as n_shared
  from shingles t join shingles d on t.s = d.s and t.kind = 't' and d.kind = 'd' group by 1, 2
)
select doc_id::bigint as doc_id, template, n_template, n_shared, n_shared / n_template as containment
from shared join sizes on template = sizes.id where n_shared / n_template >= {CONTAINED}
"""


QUERIES = {"op10_license_scan": (op10_license_scan, _sql())}
