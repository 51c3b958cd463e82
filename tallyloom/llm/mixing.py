"""Mixing sources to target weights by Poisson replication.

Each document is repeated k times, k drawn from a Poisson distribution whose mean is the rate at
which its source has to be repeated. The draw inverts the distribution at a number hashed from the
seed and the doc_id, so it is the same on every run and for every layout of the data. Copies are
then dealt out by a hash of their own and sorted by it: a global shuffle without a random state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import read
from tallyloom.operators import join_cross_scalar

SEED = "mix-1"
#: Weight of a source by default: the number of its documents to this power.
POWER = 0.5
#: A larger rate is the sum of several draws, so that exp(-rate) stays a normal number.
MOST = 256.0


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 hashed bits."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(2.0**52)


def rates(docs: DataFrame, targets: DataFrame | None = None, power: float = POWER) -> DataFrame:
    """Per source (mix_source) the mean number of copies of a document.

    targets: columns source and weight; a source that is not listed has weight 0. Without targets
    a source weighs the number of its documents to the given power. Weights are relative; as many
    copies as documents are expected in all. A null source is a source of its own.
    """
    sizes = docs.groupBy(F.col("source").alias("mix_source")).agg(F.count("*").alias("size"))
    if targets is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(power)))
    else:
        given = targets.select(F.col("source").alias("target_source"), "weight")
        sizes = sizes.join(given, F.col("mix_source").eqNullSafe(F.col("target_source")), "left")
        sizes = sizes.withColumn("weight", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)))
    total = sizes.agg(F.sum("weight").alias("all_weight"), F.sum("size").alias("all_size"))
    return join_cross_scalar(sizes, total).select(
        "mix_source",
        F.when(F.col("all_weight") > 0, F.col("weight") / F.col("all_weight") * F.col("all_size") / F.col("size"))
        .otherwise(F.lit(0.0)).alias("rate"),
    )


def _cumulative(rate: Column) -> Column:
    """P(k <= 0), P(k <= 1), ... until what is left is below the bits of a draw."""
    steps = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    first = F.exp(-rate)
    return F.aggregate(
        F.sequence(F.lit(1), steps),
        F.struct(first.alias("p"), F.array(first).alias("sums")),
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"),
            F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + acc["p"] * rate / k)).alias("sums"),
        ),
        lambda acc: acc["sums"],
    )


def replicate(
    docs: DataFrame, targets: DataFrame | None = None, seed: str = SEED, power: float = POWER
) -> DataFrame:
    """Every document as often as drawn: its columns, copy (from 1) and order_key, shuffled.

    Rows that share a doc_id are drawn alike; a null doc_id draws like the word null. Texts are not
    looked at. An empty table gives an empty result. Columns named copy or order_key are replaced;
    helper columns start with two underscores.
    """
    per_source = rates(docs, targets, power).select(
        F.col("mix_source").alias("__source"),
        F.greatest(F.lit(1), F.ceil(F.col("rate") / MOST)).cast("int").alias("__draws"),
        "rate",
    )
    per_source = per_source.select(
        "__source", "__draws", _cumulative(F.col("rate") / F.col("__draws")).alias("__sums")
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    uniforms = F.transform(
        F.sequence(F.lit(1), F.col("__draws")), lambda i: _uniform(F.lit(seed), name, i.cast("string"))
    )
    placed = docs.join(per_source, F.col("source").eqNullSafe(F.col("__source")))
    placed = placed.withColumn("__uniforms", uniforms)
    count = F.aggregate(
        "__uniforms", F.lit(0), lambda acc, u: acc + F.size(F.filter("__sums", lambda c: u >= c))
    )
    copies = (
        placed.withColumn("__n", count).where("__n > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
        .drop("__source", "__draws", "__sums", "__uniforms", "__n")
    )
    key = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), name, F.col("copy").cast("string")).cast("binary"))
    return copies.withColumn("order_key", key).repartition("order_key").sortWithinPartitions("order_key")


def op7_poisson_mix(spark, sf_dir):
    return replicate(read(spark, sf_dir, "documents"))


SQL = f"""
with sizes as (select source, count(*) size, pow(count(*)::double, {POWER}) weight from documents group by 1),
rates as (
  select source, weight / sum(weight) over () * sum(size) over () / size as rate from sizes
),
parts as (select source, greatest(1, ceil(rate / {MOST}))::integer as draws, rate / draws as mean from rates),
sums as (
  select source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) over (partition by source order by k) as c
  from parts, range(0, {int(MOST + 12 * MOST**0.5 + 31)}) r(k) where k <= ceil(mean + 12 * sqrt(mean) + 30)
),
uniforms as (
  select doc_id, source,
    ('0x' || substr(md5('{SEED}|' || coalesce(doc_id::varchar, 'null') || '|' || i), 1, 13))::bigint
      / 4503599627370496.0::double as u
  from (
    select d.doc_id, d.source, unnest(range(1, p.draws + 1)) as i
    from (select distinct doc_id, source from documents) d join parts p on d.source is not distinct from p.source
  )
),
drawn as (
  select u.doc_id, u.source, count(*) filter (u.u >= s.c) as n
  from uniforms u join sums s on u.source is not distinct from s.source group by 1, 2
)
select doc_id, text, lang, source, n_chars, i::integer as copy,
  md5('{SEED}|order|' || coalesce(doc_id::varchar, 'null') || '|' || i) as order_key
from (
  select d.doc_id, d.text, d.lang, d.source, d.n_chars, unnest(range(1, n + 1)) as i
  from documents d join drawn on d.doc_id is not distinct from drawn.doc_id and d.source is not distinct from drawn.source
)
"""

QUERIES = {"op7_poisson_mix": (op7_poisson_mix, SQL)}
