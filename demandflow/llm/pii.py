"""Personal data: candidate spans, boosted trees, calibrated thresholds.

1. High-recall generators (patterns) propose spans of the base kinds (email, ip,
   card, phone) and of looser kinds (national phone numbers, id numbers, keys,
   secrets); spans of different generators may overlap. Places come from the
   lengths of what a pattern matches and of what it leaves between.
2. Gradient-boosted trees learn from a bounded sample of up to ``sample``
   different candidates (kind, match and context; copies count once) which look
   like spans that pass their kind's strict check (check digit, part sizes,
   number of digits, prefix), from format and context features that do not hold
   the check itself. If all of them agree, up to ``sample`` of the other label
   are added.
3. On all candidates that were not learned from, copies included, the threshold
   is set to the lowest score at which the share of strict spans is at least
   ``precision``. Candidates from there on are selected, best score first where
   they overlap.
4. Base spans that pass their check are always kept.

Only DataFrame functions and Spark ML. Patterns run in linear time: no pattern
starts again inside a run it has failed on, repetitions are possessive.

Defined results: null and empty texts have no spans; places are code points,
end exclusive; without strict or without other candidates to learn from, only
base spans are returned; repeated rows have their own results; null ids stay
null; a very long text is searched as a whole; of equal scores the span that
starts first stays; an empty table gives an empty result; other columns stay out of ``find_pii`` and unchanged in ``redact``.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise

#: kind: pattern, in the order of the spans
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "id": r"(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "key": r"(?<![A-Za-z0-9])(?:[A-Z0-9]{16,}+|[a-f0-9]{32,}+)(?![A-Za-z0-9])",
    "secret": r"(?i)(?<![a-z])(?:password|passwd|token|secret|api_?key)[\x20]?[=:][\x20]?[\"']?[^\s\"']{6,}+",
    "tel": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
KINDS = [*BASE, *LOOSE]
#: without one of these no generator can match: all need a digit, @, = or :, but for keys of letters alone
_ANY = "[0-9@=:]|[A-Z]{16}|[a-f]{32}"
CONTEXT = {
    "says_mail": "mail|contact|write", "says_phone": "phone|call|tel|mobile|fax", "says_card": "card|visa|credit|payment|account", "says_net": "ip|host|server|address",
    "says_secret": "pass|token|secret|key|login", "says_number": "version|page|chapter|number|no\\.|license|section",
}
BEFORE, AFTER = 24, 12
_DIGITS = r"[^0-9]+"


def _hits(text: Column, kind: str, pattern: str) -> Column:
    """An array of (kind, at, gap before, match, before, after) of one generator."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    both = F.struct(pieces.alias("pieces"), matches.alias("matches"))
    one = F.transform(F.array(both), lambda x: F.when(F.size(x["matches"]) > 0, F.transform(F.sequence(F.lit(0), F.size(x["matches"]) - 1), lambda i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("at"), F.length(F.get(x["pieces"], i)).alias("gap"), F.get(x["matches"], i).alias("match"),
        F.right(F.get(x["pieces"], i), F.lit(BEFORE)).alias("before"), F.left(F.get(x["pieces"], i + 1), F.lit(AFTER)).alias("after")))))
    return F.coalesce(F.get(one, F.lit(0)), F.array().cast(_HITS))


_HITS = "array<struct<kind:int,at:int,gap:int,match:string,before:string,after:string>>"


def _digit_sum(match: Column) -> Column:
    """The check-digit sum over the last 19 digits."""
    padded = F.lpad(F.regexp_replace(match, _DIGITS, F.lit("")), 19, "0")
    total = F.lit(0)
    for i in range(19):
        digit = F.substring(padded, 19 - i, 1).cast("int")
        total = total + (digit if i % 2 == 0 else 2 * digit - F.when(digit > 4, 9).otherwise(0))
    return total


def _strict() -> Column:
    """Whether a candidate passes its kind's check."""
    kind, match = F.col("kind"), F.col("match")
    digits = F.length(F.regexp_replace(match, _DIGITS, F.lit("")))
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    is_ = lambda name: kind == KINDS.index(name)
    return (F.when(is_("email"), F.lit(True)).when(is_("ip"), match.rlike(rf"^(?:{part}\.){{3}}{part}$")).when(is_("card"), digits.between(13, 19) & (_digit_sum(match) % 10 == 0))
            .when(is_("phone"), digits.between(9, 15)).when(is_("id"), ~match.rlike("^(000|666|9)|-00-|-0000$")).when(is_("key"), match.rlike("^AKIA[0-9A-Z]{16}$|^[0-9a-f]{32,}$") & match.rlike("[0-9]"))
            .when(is_("secret"), match.rlike("[0-9]")).otherwise(match.rlike(r"^\(?[2-9]")))


def _features() -> dict[str, Column]:
    match, context = F.col("match"), F.lower(F.concat(F.col("before"), F.lit(" "), F.col("after")))
    n = F.length(match)
    share = lambda kept: (F.length(F.regexp_replace(match, f"[^{kept}]+", F.lit(""))) / n).cast("double")
    out = {f"is_{k}": (F.col("kind") == i).cast("double") for i, k in enumerate(KINDS)}
    out |= {"length": n.cast("double"), "digits": share("0-9"), "upper": share("A-Z"), "lower": share("a-z"), "points": share("."), "spaces": share(r"\x20"), "dashes": share(r"\-"),
            "longest_digits": F.array_max(F.transform(F.split(match, _DIGITS), lambda x: F.length(x))).cast("double"), "first": F.ascii(match).cast("double"),
            "after_space": F.col("before").rlike(r"(^|\s)$").cast("double"), "before_space": F.col("after").rlike(r"^(\s|$)").cast("double"), "before_point": F.col("after").rlike(r"^[.,;:]").cast("double"),
            "distinct": F.size(F.array_distinct(F.split(match, ""))).cast("double")}
    return out | {name: context.rlike(words).cast("double") for name, words in CONTEXT.items()}


def candidates(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows: row, id; candidates: row, kind, start, stop, match, before, after, strict, base)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("row", F.monotonically_increasing_id())
    hits = F.when(F.col("text").rlike(_ANY), F.concat(*[_hits(F.col("text"), k, p) for k, p in {**BASE, **LOOSE}.items()])).otherwise(F.array().cast(_HITS))
    rows = materialise(rows.select("row", "id", hits.alias("hits")))
    order = Window.partitionBy("row", "kind").orderBy("at")
    spans = rows.where("size(hits) > 0").select("row", F.explode("hits").alias("h")).select("row", "h.*")
    spans = spans.withColumn("stop", F.sum(F.col("gap") + F.length("match")).over(order)).withColumn("start", F.col("stop") - F.length("match"))
    strict = _strict()
    return rows.select("row", "id"), materialise(spans.select("row", "kind", "start", "stop", "match", "before", "after", strict.alias("strict"), (strict & (F.col("kind") < len(BASE))).alias("base")))


def _selected(found: DataFrame, sample: int, precision: float, seed: int) -> DataFrame | None:
    """Candidates (row, kind, start, stop, score) at or above the threshold; None if there is nothing to learn from."""
    names = list(_features())
    own = ["kind", "match", "before", "after"]
    vectors = lambda df: VectorAssembler(inputCols=names, outputCol="features").transform(df.withColumns(_features()))
    order, for_fit = F.xxhash64(*own, F.lit(seed)), F.pmod(F.shiftright("order", 20), F.lit(4)) != 0
    open_to_fit = found.select(*own, "strict").distinct().withColumn("order", order).where(for_fit)
    chosen = materialise(open_to_fit.orderBy("order", *own).limit(sample))
    last = {r.strict: r.last for r in chosen.groupBy("strict").agg(F.max("order").alias("last")).collect()}
    if len(last) == 1:
        other = materialise(open_to_fit.where(F.col("strict") != next(iter(last))).orderBy("order", *own).limit(sample))
        last |= {r.strict: r.last for r in other.groupBy("strict").agg(F.max("order").alias("last")).collect()}
        chosen = chosen.unionAll(other)
    elif last:  # one sample of both labels: they were learned from up to the same place
        last = dict.fromkeys(last, max(last.values()))
    if len(last) < 2:
        return None
    train = vectors(chosen.withColumn("label", F.col("strict").cast("double")))
    model = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.2, subsamplingRate=0.8, seed=seed, checkpointInterval=-1).fit(train.select("features", "label"))
    learned = for_fit & (F.col("order") <= F.when(F.col("strict"), last[True]).otherwise(last[False]))
    scored = materialise(model.transform(vectors(found)).withColumn("order", order).select("row", "kind", "start", "stop", "strict", learned.alias("learned"), vector_to_array("probability")[1].alias("score")))
    bins = scored.where("NOT learned").groupBy(F.floor(F.col("score") * 100).alias("bin")).agg(F.sum(F.col("strict").cast("long")).alias("strict"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("bin")).collect()  # 101 rows at most
    threshold, strict, n = None, 0, 0
    for b in bins:
        strict, n = strict + b.strict, n + b.n
        if strict >= precision * n:
            threshold = b.bin / 100
    return None if threshold is None else scored.where(F.col("score") >= threshold).select("row", "kind", "start", "stop", "score")


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000, precision: float = 0.9, seed: int = 5) -> DataFrame:
    """A row for each document: (id_col, base: array of (kind, start, stop), spans: base and selected, by kind and start)."""
    rows, found = candidates(docs, id_col, text_col)
    more = _selected(found, sample, precision, seed)
    base = found.where("base").select("row", "kind", "start", "stop", F.lit(2.0).alias("score"))
    chosen = base if more is None else base.unionAll(more.join(found.where("base").select("row", "kind", "start", F.lit(True).alias("base")), ["row", "kind", "start"], "left_anti"))
    # spans that overlap in a chain make a group; in it the best go first, and a span stays if it overlaps none that stays; base spans (score 2) always stay
    kind = "struct<start:bigint,stop:bigint,kind:int,score:double>"
    item = F.struct("start", "stop", "kind", "score").cast(kind)
    none = F.array().cast(f"array<{kind}>")

    def gather(acc: Column, x: Column) -> Column:
        joins = x["start"] < acc["reach"]
        return F.struct(F.when(joins, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["group"]))).alias("done"),
                        F.when(joins, F.concat(acc["group"], F.array(x))).otherwise(F.array(x)).alias("group"), F.greatest(acc["reach"], x["stop"]).alias("reach"))

    start = F.struct(F.array().cast(f"array<array<{kind}>>").alias("done"), none.alias("group"), F.lit(0).cast("bigint").alias("reach"))
    groups = F.aggregate("all", start, gather, lambda acc: F.concat(acc["done"], F.array(acc["group"])))
    ranked = lambda group: F.transform(F.array_sort(F.transform(group, lambda x: F.struct((-x["score"]).alias("rank"), x.alias("x")))), lambda x: x["x"])
    stays = lambda kept, x: (x["score"] == 2.0) | ~F.exists(kept, lambda y: (y["start"] < x["stop"]) & (x["start"] < y["stop"]))
    best = lambda group: F.aggregate(ranked(group), none, lambda kept, x: F.when(stays(kept, x), F.concat(kept, F.array(x))).otherwise(kept))
    swept = F.flatten(F.transform(groups, lambda group: F.when(F.size(group) > 1, best(group)).otherwise(group)))
    by_row = chosen.groupBy("row").agg(F.array_sort(F.collect_list(item)).alias("all")).select("row", F.filter("all", lambda x: x["score"] == 2.0).alias("base"), swept.alias("kept"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    shape = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))),
                                      lambda x: F.struct(F.get(kinds, x["kind"]).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))
    empty = F.array().cast("array<struct<kind:string,start:bigint,stop:bigint>>")
    every = F.array_union(F.col("base"), F.filter("kept", lambda x: (x["score"] < 2.0) & ~F.exists("base", lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"]))))
    return rows.join(by_row, "row", "left").select(F.col("id").alias(id_col), F.coalesce(shape(F.col("base")), empty).alias("base"), F.coalesce(shape(every), empty).alias("spans"))


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **parameters: float) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; documents with the same id must be equal."""
    spans = find_pii(docs, id_col=id_col, text_col=text_col, **parameters).where("size(spans) > 0").select(F.col(id_col).alias("__pii_id"), F.col("spans").alias("__pii_spans")).dropDuplicates(["__pii_id"])
    # overlapping base spans of different kinds are taken together
    ordered = F.array_sort(F.transform("__pii_spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    text = F.col(text_col).cast("string")
    step = lambda acc, s: F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["stop"]).alias("at"))).otherwise(F.struct(
        F.concat(acc["out"], F.array(F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out"), s["stop"].alias("at")))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("bigint").alias("at"))
    clean = F.aggregate(ordered, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"].cast("int") + 1, F.length(text))))
    joined = docs.join(spans, docs[id_col].eqNullSafe(F.col("__pii_id")), "left")
    return joined.withColumn(text_col, F.when(F.col("__pii_spans").isNull(), text).otherwise(clean)).select(*docs.columns)
