"""Registered queries of the operators: each applies one to its whole table and shapes the stated columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversations import repair_conversations
from .decontaminate import decontaminate
from .html_text import extract_main_text
from .licenses import scan_licenses
from .mixing import mix
from .near_dups import near_duplicates
from .pii import BASE, find_pii
from .pitman_yor import score_texts
from .quality import calibrate, features, judge
from .resample import resample
from .sharding import shard_documents
from .store import materialise
from .substrings import remove_repeated
from .toxicity import score_toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(mod: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % mod


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_of_id(5) != 0)
    return scored.select("doc_id", (crc_of_id(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
hit AS (SELECT p.doc_id, p.i, win.k, win.item_id
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k) p
        JOIN win ON win.k = p.k AND win.s = array_to_string(p.w[p.i:p.i + p.k - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(x, ',' ORDER BY x)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialise(features(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("text"))
    judged = judge(measured, calibrate(measured, table(spark, sf_dir, "labels")))
    names = {f"q_{c}": c for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")}
    return judged.select("doc_id", *[F.col(a).alias(b) for a, b in names.items()], F.col("q_failed").alias("failed_rules"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
                        (F.col("mix_size") * F.size("mix_places")).alias("taken"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    labels = lambda places: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))))
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"), "score")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
link AS (SELECT a, b FROM both_ JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
two AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, two.b FROM reach JOIN two ON two.a = reach.r)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeated(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return done.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
win AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM dup),
word AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT word.r, string_agg(x, ' ' ORDER BY word.j) AS t FROM word ANTI JOIN gone ON gone.r = word.r AND gone.j = word.j GROUP BY word.r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT r, count(*) AS n FROM gone GROUP BY r) g ON g.r = d.r LEFT JOIN kept ON kept.r = d.r
"""

def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_texts(table(spark, sf_dir, "documents"), crc_of_id(10) != 0)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32's table as a list of 256 numbers, and crc32 of a list of bytes
_CRC_TABLE_SQL = "SELECT list(list_reduce(list_prepend(b, [1, 2, 3, 4, 5, 6, 7, 8]), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY b) AS t FROM (SELECT unnest(range(256)) AS b)"


def _crc_sql(of: str) -> str:
    """crc32 of a text's UTF-8 bytes, ``t`` being the table's list."""
    codes = f"list_transform(range(octet_length(encode({of}))), lambda k: (instr('0123456789ABCDEF', substr(hex(encode({of})), 2 * k + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(hex(encode({of})), 2 * k + 2, 1)) - 1)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256)), 4294967295)"


OP11_SQL = rf"""
WITH crc AS ({_CRC_TABLE_SQL}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT r, unnest(w) AS x FROM d), bw AS (SELECT unnest(w) AS x FROM b),
word AS (SELECT x, CAST({_crc_sql("x")} % 10000 AS BIGINT) AS k FROM (SELECT x FROM dw UNION SELECT x FROM bw), crc),
s AS (SELECT k, count(*) AS n FROM dw JOIN word USING (x) GROUP BY k), g AS (SELECT k, count(*) AS n FROM bw JOIN word USING (x) GROUP BY k),
gain AS (SELECT k.k, CAST(floor(1000 * ln((coalesce(g.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000) / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)))) AS BIGINT) AS gain
         FROM (SELECT unnest(range(10000)) AS k) k LEFT JOIN s ON s.k = k.k LEFT JOIN g ON g.k = k.k),
scored AS (SELECT r, doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5) / 4294967296.0))) AS BIGINT) AS score
           FROM (SELECT d.r, doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(total, 0) AS BIGINT) AS weight
                 FROM d LEFT JOIN (SELECT r, sum(gain) AS total FROM dw JOIN word USING (x) JOIN gain USING (k) GROUP BY r) q ON q.r = d.r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN place <= 10 * n // 100 THEN place END AS BIGINT) AS rank FROM scored LEFT JOIN placed USING (r)
"""


def _damaged(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` with the faults that the query plants."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = conversations.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"), (F.crc32(F.concat_ws(":", as_text("conv_id"), as_text("turn"))) % 20).alias("c")).where("c <> 0")
    text = F.when(F.col("c") == 1, "").when(F.col("c") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("c") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return hit.select("conv_id", "turn", F.when(F.col("c") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    fixed = repair_conversations(_damaged(conversations)).withColumnRenamed("conv_id", "of")
    ids = conversations.select("conv_id").distinct()
    none = {c: F.lit(0).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return ids.join(fixed, ids["conv_id"].eqNullSafe(fixed["of"]), "left").select("conv_id", *[F.coalesce(F.col(c), v).alias(c) for c, v in none.items()])


#: the lattice turn by turn: s holds cost and least audit of start, after s, after u, after a; op 0 allows inserts, op 1 takes a turn with fault f and initial k
_STEP_SQL = """CASE WHEN x.op = 0 THEN {'op': 0, 'f': 0, 'k': '', 's': [acc.s[1], acc.s[2],
  list_min([acc.s[3], {'c': acc.s[1].c + 2, 'a': acc.s[1].a || 'I'}, {'c': acc.s[2].c + 2, 'a': acc.s[2].a || 'I'}, {'c': acc.s[4].c + 2, 'a': acc.s[4].a || 'I'}]),
  list_min([acc.s[4], {'c': acc.s[3].c + 2, 'a': acc.s[3].a || 'I'}, {'c': acc.s[1].c + 4, 'a': acc.s[1].a || 'II'}, {'c': acc.s[2].c + 4, 'a': acc.s[2].a || 'II'}])]}
 ELSE {'op': 1, 'f': 0, 'k': '', 's': [{'c': acc.s[1].c + 3, 'a': acc.s[1].a || 'D'},
  list_min([{'c': acc.s[2].c + 3, 'a': acc.s[2].a || 'D'}, {'c': acc.s[1].c + x.f + CASE WHEN x.k = 's' THEN 0 ELSE 1000000 END, 'a': acc.s[1].a || 'K'}]),
  list_min(list_concat([{'c': acc.s[3].c + 3, 'a': acc.s[3].a || 'D'}], list_transform([acc.s[1], acc.s[2], acc.s[4]], lambda y: CASE WHEN x.k = 'u' THEN {'c': y.c + x.f, 'a': y.a || 'K'} ELSE {'c': y.c + x.f + 2, 'a': y.a || 'R'} END))),
  list_min([{'c': acc.s[4].c + 3, 'a': acc.s[4].a || 'D'}, CASE WHEN x.k = 'a' THEN {'c': acc.s[3].c + x.f, 'a': acc.s[3].a || 'K'} ELSE {'c': acc.s[3].c + x.f + 2, 'a': acc.s[3].a || 'R'} END])]} END"""
_FAR_SQL = "{'c': 10000000, 'a': ''}"
_KEY_SQL = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

OP12_SQL = rf"""
WITH crc AS ({_CRC_TABLE_SQL}),
t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc_sql(_KEY_SQL)} % 20 AS c FROM conversations, crc),
hit AS (SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role, CASE WHEN c = 1 THEN '' WHEN c = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE WHEN c = 3 THEN 2 ELSE 1 END)) AS copy FROM t WHERE c <> 0),
n AS (SELECT *, left(role, 1) AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hit),
f AS (SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY i) || k AS pair,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM n),
x AS (SELECT conv_id, i, unnest([{{'op': 0, 'f': 0, 'k': '', 's': [{_FAR_SQL}]}},
                                 {{'op': 1, 'f': CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 1 ELSE 1000000 END, 'k': k, 's': [{_FAR_SQL}]}}]) AS x, unnest([0, 1]) AS half FROM f),
steps AS (SELECT conv_id, list_append(list_prepend({{'op': 1, 'f': 0, 'k': '', 's': [{{'c': 0, 'a': ''}}, {_FAR_SQL}, {_FAR_SQL}, {_FAR_SQL}]}}, list(x ORDER BY i, half)), {{'op': 0, 'f': 0, 'k': '', 's': [{_FAR_SQL}]}}) AS steps FROM x GROUP BY conv_id),
best AS (SELECT conv_id, list_min([e.s[1], e.s[4]]) AS b FROM (SELECT conv_id, list_reduce(steps, lambda acc, x: {_STEP_SQL}) AS e FROM steps)),
edit AS (SELECT conv_id, e, sum(CASE WHEN e = 'I' THEN 0 ELSE 1 END) OVER w AS i, sum(CASE WHEN e = 'D' THEN 0 ELSE 1 END) OVER w AS o
         FROM (SELECT conv_id, unnest(range(1, length(b.a) + 1)) AS p, substr(b.a, p, 1) AS e FROM best) WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
o AS (SELECT edit.conv_id, e, o, role, text, max(CASE WHEN o = 1 AND e = 'K' AND k = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY edit.conv_id) AS s
      FROM edit LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM edit.conv_id AND f.i = edit.i AND e <> 'I' WHERE e <> 'D'),
fixed AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (o - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY o)) AS h FROM o GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN fixed ON fixed.conv_id IS NOT DISTINCT FROM d.conv_id
"""


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: name -> (query, DuckDB SQL or None)
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_html_text": (op1_html_text, None),
    "op2_toxicity": (op2_toxicity, None),
    "op3_pii": (op3_pii, None),
    "op4_decontaminate": (op4_decontaminate, OP4_SQL),
    "op5_quality_rules": (op5_quality_rules, None),
    "op6_mix_sources": (op6_mix_sources, None),
    "op7_licenses": (op7_licenses, None),
    "op8_near_duplicates": (op8_near_duplicates, OP8_SQL),
    "op10_lm_scores": (op10_lm_scores, None),
    "op9_substring_dedup": (op9_substring_dedup, OP9_SQL),
    "op11_target_resampling": (op11_target_resampling, OP11_SQL),
    "op12_conversation_repair": (op12_conversation_repair, OP12_SQL),
    "op13_sharding": (op13_sharding, None),
}
