"""Quality rules with risk-controlled thresholds.

Every rule is a number that grows as a text gets worse. On labelled documents
(quality 1: good) a cutoff is safe for a stratum if an exact binomial test
rejects "at least alpha of the good documents are above it": with k of n good
documents above, P(X <= k) for X binomial(n, alpha) is at most delta. alpha is
the allowed false rejection shared out among the rules; delta is shared out
among all rules, cutoffs and strata (Bonferroni), so with probability
1 - delta no stratum loses more than alpha of its good documents to the
rules. Each rule takes the safe cutoff that rejects most labelled bad documents
net of good ones; where no cutoff can be shown to be safe, the rule rejects
nothing in that stratum.

Cutoffs are a fixed grid, so the labelled documents are a holdout for all of
them. Counts cover all documents. Only DataFrame functions: texts are split and
windows counted within their row, and only counts are shuffled.

Defined results: null and empty texts have no words and fail the base rule; a
null stratum is one of its own; a document with several labels is good only if
all say so; labels that are null or of unknown documents count for nothing; no
labels: no cutoffs; repeated document rows each count; a very long text is measured as
a whole; of equally good cutoffs the highest is taken; an empty table gives an empty
result; other columns stay,
except those named like one that is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exact_stats import binomial_lower_tail
from .store import materialise

SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
_LOW = 0xFFFFFF

#: rule: fixed cutoffs, lowest first
GRID = {
    "symbols_per_word": [0.05, 0.1, 0.2, 0.3, 0.5, 0.8],
    "dup_line_share": [0.1, 0.2, 0.3, 0.4, 0.6, 0.8],
    "repeat_share": [0.1, 0.2, 0.3, 0.4, 0.5, 0.7],
    "mean_word_chars": [9.0, 10.0, 12.0, 15.0, 20.0, 40.0],
    "upper_share": [0.1, 0.2, 0.3, 0.5, 0.7, 0.9],
    "exclamations_per_word": [0.05, 0.1, 0.2, 0.3, 0.5, 0.8],
}
MEASURES = ["q_n_words", "q_word_chars", "q_n_symbols", "q_n_dup_lines", "q_n_repeat_words"]
#: columns that are added; those of the documents with such names are replaced
ADDED = frozenset([*MEASURES, *GRID, "q_base_failed", "q_failed", "q_kept", "q_stratum", "q_n_good", *[f"cut_{r}" for r in GRID]])


def _count(text: Column, characters: str) -> Column:
    """How many of the characters of a class."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", F.lit(""))).cast("long")


def features(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with q_n_words, q_word_chars, q_n_symbols, q_n_dup_lines, q_n_repeat_words and the rules' numbers.

    Write the result before filtering by it: a filter that is pushed down repeats these expressions for every word.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = docs.select(F.struct(F.lit(1).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ADDED]).alias("doc"), text.alias("t"))
    d = kept.withColumns({
        "words": F.when(F.btrim("t", F.lit(SPACE)) == "", F.array().cast("array<string>")).otherwise(F.split(F.btrim("t", F.lit(SPACE)), SPACES)),
        "lines": F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")})
    d = d.withColumn("n", F.size("words").cast("long")).withColumn("h", F.when(F.col("n") < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size("words") - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))))
    # windows in order of hash: 40 bits of it above the place, so that longs are sorted
    d = d.withColumn("keys", F.sort_array(F.transform("h", lambda x, i: x.bitwiseAND(F.lit(~_LOW)).bitwiseOR(i.cast("long")))))
    high = lambda x: F.shiftright(x, 24)
    near = F.filter("keys", lambda x, j: (high(x) == high(F.get("keys", j + 1))) | ((j > 0) & (high(x) == high(F.get("keys", j - 1)))))
    d = d.withColumn("near", F.coalesce(near, F.array().cast("array<bigint>")))
    full = lambda x: F.get("h", x.bitwiseAND(F.lit(_LOW)).cast("int"))
    mixed = F.exists(F.sequence(F.lit(1), F.greatest(F.size("near") - 1, F.lit(1))), lambda j: (high(F.get("near", j)) == high(F.get("near", j - 1))) & (full(F.get("near", j)) != full(F.get("near", j - 1))))
    # equal high bits of different windows, or places of more than 24 bits: the whole hashes, sorted once, beside their places
    d = d.withColumn("pairs", F.when(F.coalesce(mixed, F.lit(False)) | (F.col("n") > _LOW), F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("at"))))))
    twice = F.filter("pairs", lambda x, j: (x["h"] == F.get("pairs", j + 1)["h"]) | ((j > 0) & (x["h"] == F.get("pairs", j - 1)["h"])))
    d = d.withColumn("places", F.when(F.col("pairs").isNotNull(), F.sort_array(F.transform(twice, lambda x: x["at"]))).otherwise(F.sort_array(F.transform("near", lambda x: x.bitwiseAND(F.lit(_LOW))))))
    covered = F.aggregate("places", F.struct(F.lit(-3).cast("long").alias("at"), F.lit(0).cast("long").alias("n")),
                          lambda acc, p: F.struct(p.alias("at"), (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["at"])).alias("n")), lambda acc: acc["n"])
    d = d.select("doc", F.col("n").alias("q_n_words"), F.length(F.regexp_replace("t", SPACES, F.lit(""))).cast("long").alias("q_word_chars"), _count(F.col("t"), "#*$%&|<>").alias("q_n_symbols"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("q_n_dup_lines"), covered.alias("q_n_repeat_words"),
                 F.size("lines").alias("n_lines"), _count(F.col("t"), "A-Z").alias("n_upper"), _count(F.col("t"), "!").alias("n_bang"))
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return d.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c not in ADDED], "q_n_words", "q_word_chars", "q_n_symbols", "q_n_dup_lines", "q_n_repeat_words",
                    share("q_n_symbols", "q_n_words").alias("symbols_per_word"), share("q_n_dup_lines", "n_lines").alias("dup_line_share"),
                    share("q_n_repeat_words", "q_n_words").alias("repeat_share"), share("q_word_chars", "q_n_words").alias("mean_word_chars"),
                    share("n_upper", "q_word_chars").alias("upper_share"), share("n_bang", "q_n_words").alias("exclamations_per_word"))


def _stratum(column: str | None) -> Column:
    return F.lit("all") if column is None else F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column).cast("string")))


def calibrate(measured: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", stratum_col: str | None = "lang", label_col: str = "quality", alpha: float = 0.05, delta: float = 0.05) -> DataFrame:
    """(q_stratum, a cutoff for each rule or null, q_n_good) from features and labels."""
    good = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("good"))
    rules = measured.select(F.col(id_col).alias("id"), _stratum(stratum_col).alias("q_stratum"), *GRID)
    above = {f"{r}_{i}_{g}": F.sum(((F.col(r) > c) & (F.col("good") == g)).cast("long")).cast("double") for r, cuts in GRID.items() for i, c in enumerate(cuts) for g in (0, 1)}
    counts = materialise(rules.join(good, "id").groupBy("q_stratum").agg(F.sum((F.col("good") == 1).cast("long")).cast("double").alias("q_n_good"), *[v.alias(k) for k, v in above.items()]))
    tests = sum(map(len, GRID.values())) * max(counts.count(), 1)
    each = alpha / len(GRID)

    def best_safe(rule: str) -> Column:
        """The safe cutoff that rejects most bad documents net of good ones, the highest if several do."""
        choices = []
        for i, c in enumerate(GRID[rule]):
            k, gain = F.col(f"{rule}_{i}_1"), F.col(f"{rule}_{i}_0") - F.col(f"{rule}_{i}_1")
            safe = (k < F.col("q_n_good") * each) & (gain > 0) & (binomial_lower_tail(k, F.col("q_n_good"), each) <= delta / tests)
            choices.append(F.when(safe, F.struct(gain.alias("gain"), F.lit(c).alias("cutoff"))))
        return F.array_max(F.array(*choices))["cutoff"]

    return materialise(counts.select("q_stratum", "q_n_good", *[best_safe(r).alias(f"cut_{r}") for r in GRID]))


def judge(measured: DataFrame, cutoffs: DataFrame, *, stratum_col: str | None = "lang") -> DataFrame:
    """``measured`` with q_base_failed, q_failed (names of the rules that reject) and q_kept."""
    base = (F.col("q_n_words") < 50) | (100 * F.col("q_n_repeat_words") > 50 * F.col("q_n_words"))
    failed = F.filter(F.array(*[F.when(F.col(r) > F.col(f"cut_{r}"), F.lit(r)) for r in GRID]), lambda x: x.isNotNull())
    joined = measured.withColumn("q_stratum", _stratum(stratum_col)).join(cutoffs, "q_stratum", "left")
    out = joined.withColumns({"q_base_failed": base, "q_failed": failed})
    return out.withColumn("q_kept", ~F.col("q_base_failed") & (F.size("q_failed") == 0)).drop("q_stratum", "q_n_good", *[f"cut_{r}" for r in GRID])
