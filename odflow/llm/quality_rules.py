"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every document gets a few metrics (higher is worse). For each stratum and metric a
ladder of cutoffs, fixed before looking at data, is tested from the most lenient one
downwards on labelled good documents: a cutoff is certified when the exact binomial
test rejects "more than ``alpha`` / metrics of the good documents of this stratum lie
above it" at level ``delta`` / (strata * metrics). A ladder ends at its first failure
(fixed-sequence testing, so its steps need no further correction); the Bonferroni
factor covers all ladders. With probability 1 - ``delta`` every stratum therefore
loses at most ``alpha`` of its good documents to all metrics together. A stratum with too few
labelled documents certifies nothing, and only the base rule applies there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from odflow.llm.columns import WORD, count_of, fraction_text, let
from odflow.store import Store

SYMBOLS = "#*$%&|<>"
MARKS = "!?;:_~=^@"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
MIN_WORDS = 20
#: Cutoffs tried, most lenient first.
LADDER = tuple(round(0.95 - 0.05 * i, 2) for i in range(18)) + (0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01)
ALPHA, DELTA = 0.04, 0.05


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside runs of ``window`` words that occur twice or more in the array, first ones included.

    Runs are compared by 64-bit hash: two different runs of one text count as equal
    with a probability of about (number of runs)**2 * 2**-65.
    """
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window)))

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (F.get(s, k + 1)["h"] == x["h"]) | (F.get(s, k - 1)["h"] == x["h"]))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        gaps = let(let(ordered, starts), lambda p: F.transform(
            p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))))
        total = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(total)

    return F.when(F.size(words) < window, F.lit(0).cast("long")).otherwise(let(hashes, covered))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks")


def rule_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents' other columns with the base counts; input columns with a count's name are replaced.

    n_words, word_chars, n_symbols, n_lines and n_dup_lines (lines with a word, and those equal to
    an earlier one), n_repeat_words, n_upper (A-Z), n_marks. A null text counts as empty.
    """
    keep = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in {*COUNTS, text_col}]
    return _row_counts(docs, text_col).select(*keep, *COUNTS)


def _row_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """The documents without their text as one struct ``row``, so that their columns may have any name, and the base counts."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    row = (F.struct(*keep) if keep else F.lit(None).cast("struct<none:int>")).alias("row")

    def counts(t: Column) -> Column:
        words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
        of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                                 (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
        blank = F.char_length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long")
        return F.struct(of_words.alias("w"), of_lines.alias("l"), blank.alias("c"),
                        count_of(t, SYMBOLS).alias("s"), count_of(t, UPPER).alias("u"), count_of(t, MARKS).alias("m"))

    one = docs.select(row, let(text, counts).alias("_n"))
    n = F.col("_n")
    values = [n["w"]["n"], n["c"], n["s"], n["l"]["n"], n["l"]["d"], n["w"]["r"], n["u"], n["m"]]
    return one.select("row", *[v.alias(c) for v, c in zip(values, COUNTS)])


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


#: Metric name -> expression over the counts; all lie in 0..1 and higher is worse.
METRICS = {
    "symbol_share": lambda: _share("n_symbols", "word_chars"),
    "upper_share": lambda: _share("n_upper", "word_chars"),
    "mark_share": lambda: _share("n_marks", "word_chars"),
    "repeat_share": lambda: _share("n_repeat_words", "n_words"),
}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) by exact summation of its terms in logarithms; 1 where k >= n p."""
    odds = math.log(p / (1 - p))
    first = F.struct((n * math.log(1 - p)).alias("t"), (n * math.log(1 - p)).alias("s"))

    def add(state: Column, j: Column) -> Column:
        term = state["t"] + F.log((n - j) / (j + F.lit(1))) + F.lit(odds)
        top = F.greatest(state["s"], term)
        return F.struct(term.alias("t"), (top + F.log(F.exp(state["s"] - top) + F.exp(term - top))).alias("s"))

    steps = F.when(k > 0, F.sequence(F.lit(0).cast("long"), k - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(steps, first, add, lambda s: F.exp(s["s"])))


def certified_cutoffs(counts: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id",
                      alpha: float = ALPHA, delta: float = DELTA, ladder: tuple[float, ...] = LADDER) -> DataFrame:
    """Strictest certified cutoff per stratum and metric: (stratum, metric, cutoff, good, above, tail).

    ``labels`` has the id and ``quality``; an id counts as good when all its labels are 1. The holdout are
    the good documents whose crc32(id as text) mod 3 is not 1, every row of ``counts`` once. Null labels
    and labels of unknown ids are ignored.
    """
    good = (labels.filter(F.col("quality").isNotNull() & F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("_id")).agg(F.min("quality").alias("_q")).filter("_q = 1").select("_id"))
    held = counts.filter(fraction_text(F.col(id_col)) % 3 != 1).join(good, F.col(id_col) == F.col("_id"), "left_semi")
    tests = [(m, c) for m in METRICS for c in ladder]
    sums = [F.sum(F.when(METRICS[m]() > c, 1).otherwise(0)).alias(f"s{i}") for i, (m, c) in enumerate(tests)]
    wide = held.filter(~base_failed()).groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("good"), *sums)
    rows = wide.select("stratum", "good", F.posexplode(F.array(*[f"s{i}" for i in range(len(tests))])).alias("i", "above"))
    facts = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(c).alias("cutoff"), F.lit(i % len(ladder)).alias("step"))
                      for i, (m, c) in enumerate(tests)])
    rows = rows.withColumn("f", F.get(facts, F.col("i"))).select("stratum", "good", "above", "f.*")
    strata = wide.groupBy().agg(F.count("*").alias("strata"))
    level = F.lit(delta) / (F.col("strata") * len(METRICS))
    tested = (rows.join(F.broadcast(strata))  # one row
              .withColumn("tail", binomial_tail(F.col("above"), F.col("good"), alpha / len(METRICS)))
              .withColumn("ok", F.col("tail") <= level))
    ladder_so_far = Window.partitionBy("stratum", "metric").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    passed = tested.withColumn("run", F.min(F.col("ok").cast("int")).over(ladder_so_far)).filter("run = 1")
    return (passed.groupBy("stratum", "metric")
            .agg(F.max_by(F.struct("cutoff", "good", "above", "tail"), "step").alias("b")).select("stratum", "metric", "b.*"))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id",
                  text_col: str = "text", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Documents (all columns but the text) with their counts, base_failed, rejected_by and kept.

    Input columns named like one of these results are replaced; any other name is free. Null and empty texts have zero counts and
    fail the base rule (fewer than 20 words); a null stratum is a stratum of its own; repeated rows are judged each for itself;
    without labels nothing is certified and ``kept`` is the opposite of base_failed; an empty table gives an empty result.
    """
    counts = Store(docs.sparkSession, "quality_rules").cut(_row_counts(docs, text_col))
    row = F.col("row")
    plain = counts.select(row.getField(stratum).alias("_stratum"), row.getField(id_col).alias("_doc"), *COUNTS)
    cuts = certified_cutoffs(plain, labels.select(F.col(id_col).alias("_doc"), "quality"), "_stratum", "_doc", alpha, delta)
    cuts = cuts.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("metric", "cutoff"))).alias("cuts"))
    over = [F.when(METRICS[m]() > F.col("cuts")[m], F.lit(m)) for m in METRICS]
    judged = (counts.join(cuts, row.getField(stratum).eqNullSafe(F.col("stratum")), "left")
              .withColumn("base_failed", base_failed())
              .withColumn("rejected_by", F.array_compact(F.array(*over)))
              .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)))
    new = [*COUNTS, "base_failed", "rejected_by", "kept"]
    keep = [row.getField(c).alias(c) for c in docs.columns if c not in {*new, text_col}]
    return judged.select(*keep, *new)
