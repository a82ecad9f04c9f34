"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Every metric is a Spark expression over the whole text, and every rule of ``RULES`` one comparison of
a metric with its bounds. The plan is a scan and projections: no shuffle, no Python, so it scales
with the number of input splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, let, read_table, text_of

#: Frequent function words of the four languages of the corpus (fixed values).
STOP_WORDS = (
    "the of and a to in is be that it for on with as was by this an are or at from "
    "de la le et les des en un une du que qui dans par pour sur au aux est pas avec ou "
    "der die und das den ein eine ist mit von zu sich auf für dem im nicht als auch "
    "el los las y por con para se no una al lo como su del es más pero"
).split()


@dataclass(frozen=True)
class Rule:
    """A metric and the closed interval it has to lie in; None leaves that side open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (F.col(self.metric) >= F.lit(self.low))
        if self.high is not None:
            ok = ok & (F.col(self.metric) <= F.lit(self.high))
        return ok


#: Production thresholds. The base rule already demands 50 words, so every ratio has a meaningful
#: denominator. ``n_stop_words`` counts different function words.
RULES = (
    Rule("word_length", "mean_word_chars", 2.5, 10.0),
    Rule("symbols", "symbol_ratio", None, 0.10),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.40),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.30),
)


#: A window's start takes this many low bits of its sort key.
START_BITS = 20


def repeated_window_words(words: Column) -> Column:
    """Words lying in a 3-word window that occurs twice or more in ``words``, the first included.

    Windows are compared by 64-bit hashes. Sorting numbers made of a hash's upper 44 bits and the
    window's start brings equal windows together; the starts of equal neighbours, sorted again, cover
    min(3, distance to the next start) words each. Texts of over a million words sort structs instead.
    """

    def total(starts: Column) -> Column:
        begin = F.struct(F.lit(-3).cast("long").alias("at"), F.lit(0).cast("long").alias("sum"))
        return F.aggregate(
            F.sort_array(F.array_distinct(starts)),
            begin,
            lambda acc, i: F.struct(i.alias("at"), (acc["sum"] + F.least(F.lit(3).cast("long"), i - acc["at"])).alias("sum")),
            lambda acc: acc["sum"],
        )

    def neighbours(s: Column, equal, start_of) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(s) - 2), lambda i: equal(F.get(s, i), F.get(s, i + 1)))
        both = lambda at: F.concat(F.transform(at, lambda i: F.get(s, i)), F.transform(at, lambda i: F.get(s, i + 1)))
        return F.transform(let(firsts, both), start_of)

    def covered(grams: Column) -> Column:
        low = (1 << START_BITS) - 1
        keys = F.transform(grams, lambda g, i: F.shiftleft(F.shiftright(g, START_BITS), START_BITS).bitwiseOR(i.cast("long")))
        start = lambda x: x.bitwiseAND(F.lit(low))
        gram = lambda x: F.get(grams, start(x).cast("int"))
        by_key = let(
            F.sort_array(keys),
            lambda s: neighbours(s, lambda x, y: (F.shiftright(x.bitwiseXOR(y), START_BITS) == 0) & (gram(x) == gram(y)), start),
        )
        pairs = F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.cast("long").alias("i")))
        by_pair = let(F.sort_array(pairs), lambda s: neighbours(s, lambda x, y: x["g"] == y["g"], lambda x: x["i"]))
        return total(F.when(F.size(grams) <= low, by_key).otherwise(by_pair))

    def of_grams(grams: Column) -> Column:
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(covered(grams))

    def of_words(w: Column) -> Column:
        grams = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        return let(grams, of_grams)

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(words, of_words))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add metrics, ``base_failed``, ``failed_rules`` and ``kept`` to documents.

    Null and empty texts have no words: every count is 0, ``base_failed`` is true and ``kept`` false.
    Repeated rows are judged one by one. Columns of the input are dropped but for doc_id, so clashing
    names do no harm.
    """
    text = F.col("_t")
    count_of = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")
    ratio = lambda a, b: F.coalesce(a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    base = docs.select("doc_id", text_of().alias("_t"))
    split = base.select(
        "doc_id",
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_w"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)).alias("_l"),
        count_of("#*$%&|<>").alias("n_symbols"),
    )
    lines, words = F.col("_l"), F.col("_w")
    counted = split.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_window_words(words).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_intersect(words, stop)).cast("long").alias("n_stop_words"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))
        .cast("long")
        .alias("n_ellipsis_lines"),
    )
    measured = counted.select(
        "*",
        ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        ratio(F.col("n_symbols"), F.col("n_words")).alias("symbol_ratio"),
        ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        ratio(F.col("n_ellipsis_lines"), F.col("n_lines")).alias("ellipsis_line_ratio"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )
    failed = F.concat_ws(",", *[F.when(~r.holds(), F.lit(r.name)) for r in rules])
    return measured.withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the contract's columns, and the names of the failed rules."""
    return quality_rules(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failed_rules",
    )


_BOUNDS = ", ".join(
    f"CASE WHEN {' OR '.join(f'{r.metric} {op} {b}' for op, b in (('<', r.low), ('>', r.high)) if b is not None)} THEN '{r.name}' END" for r in RULES
)
_BLANK_FREE = r"[^\x20\x09-\x0D]"
#: The same by plain lists and counts of windows.
SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_BLANK_FREE}+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_BLANK_FREE}')) AS l FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
c AS (SELECT doc_id, sum(least(3, coalesce(ahead - i, 3))) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS ahead FROM r) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines, len(list_intersect(list_distinct(w), {STOP_WORDS!r})) AS n_stop_words,
    len(list_filter(l, lambda x: ends_with(rtrim(x), '...') OR ends_with(rtrim(x), '…'))) AS n_ellipsis FROM t LEFT JOIN c USING (doc_id)),
q AS (SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars, coalesce(n_symbols / nullif(n_words, 0), 0) AS symbol_ratio,
    coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio, coalesce(n_ellipsis / nullif(n_lines, 0), 0) AS ellipsis_line_ratio,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (SELECT *, concat_ws(',', {_BOUNDS}) AS failed_rules FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept, failed_rules FROM f
"""
