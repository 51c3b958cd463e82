"""Quality rules with adaptive thresholds, in DataFrame functions alone.

Each document gets counts and shares. Per language and source the shares go into mergeable
quantile sketches, which merge into those of a language and of all. Each of the three gives a limit,
and a group's limit is their mean: n texts give a level the weight n / (n + GROUP_DOCS), the next
wider level has the rest. So every group counts for itself, a small one less, and no verdict changes
at once because a group has one text more. A share above its limit, which lies far above the usual
spread, fails the rule.
Sketches take each text of a group once, and none that fails the base rule. Where the upper quartile
itself is far above what the lower half suggests, the lower half alone gives the limit; so bad texts
switch no rule off until they are half of the different texts of a group. From there on a group
counts as being like that by nature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import read, stored
from tallyloom.operators import join_cross_scalar

_GAP = "[\\x20\\x09-\\x0D]+"
_WORD = "[^\\x20\\x09-\\x0D]"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
REPEAT_PERCENT = 50
#: Values a sketch keeps; its rank error is about 2 / SKETCH_SIZE.
SKETCH_SIZE = 1024
#: Different texts at which a level's own limit and that of the next wider one weigh the same.
GROUP_DOCS = 20
#: A share fails above q75 + SPREADS * (q75 - q25), and never within SLACK of the median. If q75 fails
#: with the upper half taken to be as wide as the lower one, that limit holds.
SPREADS = 6.0
SLACK = {"symbol_share": 0.05, "dup_line_share": 0.3, "repeat_share": 0.2, "word_length": 3.0}
#: Repeated triples up to which membership is tested by scanning them.
FEW = 16


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, n_lines, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long).

    A null text has no words, lines or characters. Existing columns of these names are replaced;
    helper columns start with two underscores.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(t, F.lit(_SPACES))
    out = docs.withColumns(
        {
            "word_chars": F.length(F.regexp_replace(t, _GAP, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(t, f"[^{_SYMBOLS}]+", "")).cast("long"),
            "__words": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _GAP)),
            "__lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(_WORD)),
        }
    )
    # Every array that a later lambda reads is a column of its own, so it is made once a row.
    out = out.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__triples": F.when(
                F.size("__words") >= 3,
                F.transform(
                    F.slice("__words", F.lit(1), F.size("__words") - 2),
                    lambda w, i: F.xxhash64(w, F.get("__words", i + 1), F.get("__words", i + 2)),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("__words", "__lines")
    out = out.withColumn("__sorted", F.sort_array("__triples"))
    out = out.withColumn(
        "__twice",
        F.array_distinct(F.filter("__sorted", lambda x, i: (i > 0) & (x == F.get("__sorted", i - 1)))),
    ).drop("__sorted")
    out = out.withColumn(
        "__pairs",
        F.when(
            F.size("__twice") > FEW,
            F.sort_array(F.transform("__triples", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda e, k: (F.get("__pairs", k - 1)["h"] == e["h"]) | (F.get("__pairs", k + 1)["h"] == e["h"])
    out = out.withColumn(
        "__at",
        F.when(F.size("__twice") == 0, F.array().cast("array<int>"))
        .when(
            F.size("__twice") <= FEW,
            F.filter(
                F.transform("__triples", lambda h, i: F.when(F.array_contains("__twice", h), i)),
                lambda i: i.isNotNull(),
            ),
        )
        .otherwise(
            F.sort_array(
                F.transform(F.filter("__pairs", lambda e, k: F.coalesce(same(e, k), F.lit(False))), lambda e: e["i"])
            )
        ),
    ).drop("__triples", "__twice", "__pairs")
    # Each repeated triple adds the words that the one before it did not cover.
    covered = F.aggregate(
        "__at",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return out.withColumn("n_repeat_words", covered).drop("__at")


#: Share: part, whole, and what damps the share where the whole is small.
SHARES = {
    "symbol_share": ("n_symbols", "word_chars", 0),
    "dup_line_share": ("n_dup_lines", "n_lines", 4),
    "repeat_share": ("n_repeat_words", "n_words", 50),
    "word_length": ("word_chars", "n_words", 0),
}


def _share(name: str) -> Column:
    part, whole, more = SHARES[name]
    share = F.when(F.col(whole) > 0, F.col(part) / (F.col(whole) + more))
    return F.coalesce(share, F.lit(0.0))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def _limit(sketch: Column, slack: float) -> Column:
    """The highest value that passes, from the quartiles of a sketch."""
    low, mid, high = (F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.25, 0.5, 0.75))
    usual = F.greatest(high + SPREADS * (high - low), mid + slack)
    # The same for a symmetric group, from its lower half alone.
    lower = F.greatest(mid + (1 + 2 * SPREADS) * (mid - low), mid + slack)
    return F.when(high > lower, lower).otherwise(usual)


def thresholds(counted: DataFrame, group_docs: float = GROUP_DOCS) -> DataFrame:
    """Per language and source the highest value of each share that passes: max_<share>.

    Sketches are made once per group and merged for the wider levels. Rows of a group that share a
    row_key and all counts are one; rows that fail the base rule are not counted. Without any other
    rows the limits are null.
    """
    parts = sorted({c for part, whole, _ in SHARES.values() for c in (part, whole)})
    texts = counted.select("lang", "source", "row_key", *parts).distinct()
    good = ~_base_failed()
    sketch = [
        F.kll_sketch_agg_double(F.when(good, _share(n)), F.lit(SKETCH_SIZE)).alias(n) for n in SHARES
    ]
    groups = texts.groupBy("lang", "source").agg(F.count_if(good).alias("docs"), *sketch)
    groups = stored(groups, "sketches")  # one row per language and source

    def wider(rows: DataFrame, by: list[str], prefix: str) -> DataFrame:
        merged = [F.kll_merge_agg_double(n, F.lit(SKETCH_SIZE)).alias(prefix + n) for n in SHARES]
        return rows.groupBy(*by).agg(F.sum("docs").alias(prefix + "docs"), *merged)

    by_lang = wider(groups, ["lang"], "lang_")
    wide = join_cross_scalar(by_lang.withColumnRenamed("lang", "its_lang"), wider(groups, [], "all_"))
    leveled = groups.join(wide, F.col("lang").eqNullSafe(F.col("its_lang")), "left")
    out = []
    for name, slack in SLACK.items():
        limit = F.lit(None).cast("double")
        for level in ("all_", "lang_", ""):
            n = F.col(level + "docs")
            # An empty sketch has no quantiles.
            own = F.when(n > 0, _limit(F.col(level + name), slack))
            weight = n / (n + F.lit(float(group_docs)))
            limit = F.coalesce(weight * own + (1 - weight) * limit, own, limit)
        out.append(limit.alias("max_" + name))
    return leveled.select(F.col("lang").alias("group_lang"), F.col("source").alias("group_source"), *out)


def verdicts(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Add base_failed and kept. A null language or source is a group like any other."""
    failed = _base_failed()
    within = F.lit(True)
    for name in SHARES:
        within = within & (_share(name) <= F.col("max_" + name))
    joined = counted.join(
        limits, F.col("lang").eqNullSafe(F.col("group_lang")) & F.col("source").eqNullSafe(F.col("group_source"))
    )
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & within).drop(
        *limits.columns
    )


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row_key, the counts, base_failed and kept.

    Null and empty texts have no words and fail the base rule. Repeated rows get equal verdicts.
    An empty table gives an empty result. Other columns than doc_id, text, lang and source are not
    read, whatever their names.
    """
    narrow = docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text", "lang", "source")
    counted = stored(base_counts(narrow).drop("text"), "counts")
    return verdicts(counted, thresholds(counted))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns."""
    good = judge(docs).where("kept").select(
        F.col("doc_id").alias("good_id"), F.col("row_key").alias("good_key")
    ).distinct()
    same = docs["doc_id"].eqNullSafe(good["good_id"]) & (F.xxhash64(docs["text"]) == good["good_key"])
    return docs.join(good, same, "left_semi")


def op6_quality_rules(spark, sf_dir):
    return judge(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


QUERIES = {"op6_quality_rules": (op6_quality_rules, None)}
