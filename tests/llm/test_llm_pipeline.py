"""The pipeline's stages on a small corpus with planted cases, and the registered queries against DuckDB."""

import random

import duckdb
import pytest

import corpus_pipeline
from demandflow.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_html_text": ["page_id", "url", "text", "n_chars"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6_mix_sources": ["doc_id", "size", "source_size", "target", "taken"],
    "op7_licenses": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op8_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"],
    "op9_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op10_lm_scores": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op11_target_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
    "op12_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op13_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}
#: what has a row in the result, where that is not a document
ROWS = {"op1_html_text": "pages", "op12_conversation_repair": "(select distinct conv_id from conversations)"}


@pytest.mark.parametrize("name", REGISTRY)
def test_registered_query(spark, name):
    query, sql = REGISTRY[name]
    table, key = ROWS.get(name, "documents"), COLUMNS[name][0]
    df = query(spark, SF)
    assert df.columns[:len(COLUMNS[name])] == COLUMNS[name]
    rows = df.toPandas()
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    assert len(rows) == con.execute(f"select count(*) from {table}").fetchone()[0]
    if sql:
        expected = con.execute(sql).fetchdf()[list(rows.columns)].sort_values(key).reset_index(drop=True)
        got = rows.sort_values(key).reset_index(drop=True)
        assert (got.convert_dtypes().astype(str) == expected.convert_dtypes().astype(str)).all(axis=None)  # a null among whole numbers is no fraction


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(n))


def test_stages_keep_and_remove_what_they_should(spark, tmp_path):
    rng = random.Random(11)
    item = sentence(rng, 25)
    clean = {i: sentence(rng, 120) for i in range(30)}
    rows = [(i, t, "en", "a" if i % 2 else "b", len(t)) for i, t in clean.items()]
    near = clean[3].split(" ")
    near[60] = "changed"
    extra = {100: clean[1], 101: " ".join(near), 102: sentence(rng, 60) + " " + item + " " + sentence(rng, 60), 103: "too short", 104: "same line again\n" * 40,
             105: sentence(rng, 80) + " write to a.b@c.org or +1 (555) 123-4567 now", 106: None, 107: ""}
    rows += [(i, t, "en", None, 0 if t is None else len(t)) for i, t in extra.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)))
        kept[name] = docs.toPandas()
        if name != "source_mix":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert set(kept["quality_rules"].doc_id) == set(clean) | {100, 101, 102, 105}
    assert set(kept["near_dedup"].doc_id) == set(clean) | {102, 105}
    assert set(kept["benchmark_decontamination"].doc_id) == set(clean) | {105}
    by_id = kept["personal_data"].set_index("doc_id")
    assert set(by_id.index) == set(clean) | {105} and all(by_id.text[i] == t for i, t in clean.items())
    assert "a.b@c.org" not in by_id.text[105] and "[EMAIL]" in by_id.text[105] and "[PHONE]" in by_id.text[105] and by_id.n_chars[105] == len(by_id.text[105])
    mixed = kept["source_mix"]
    assert set(mixed.doc_id) <= set(by_id.index) and mixed.groupby("doc_id").size().max() <= 3
    total = sum(len(t.split()) for t in by_id.text)
    assert abs(mixed.mix_size.sum() - total) < 0.15 * total
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_rows_without_an_id_of_their_own_are_judged_by_their_text(spark, tmp_path):
    rng = random.Random(12)
    item, null_texts, same_id = sentence(rng, 25), [sentence(rng, 100) for _ in range(6)], [sentence(rng, 100) for _ in range(3)]
    leak, mail = sentence(rng, 50) + " " + item, sentence(rng, 60) + " write to a.b@c.org"
    rows = [(None, t) for t in [*null_texts, null_texts[0], leak, mail]] + [(7, t) for t in [*same_id, same_id[1]]] + [(8, null_texts[2]), (9, ""), (9, ""), (None, ""), (None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], schema).repartition(3)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pairs = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    deduped = corpus_pipeline.materialise(corpus_pipeline.near_dedup(spark, docs, str(tmp_path)))
    own = [(None, t) for i, t in enumerate(null_texts) if i != 2] + [(8, null_texts[2])] + [(7, t) for t in same_id] + [(9, ""), (None, ""), (None, None)]
    assert pairs(deduped) == sorted([*own, (None, leak), (None, mail)], key=str)
    clean = corpus_pipeline.materialise(corpus_pipeline.benchmark_decontamination(spark, deduped, str(tmp_path)))
    assert pairs(clean) == sorted([*own, (None, mail)], key=str)
    assert pairs(corpus_pipeline.personal_data(spark, clean, str(tmp_path))) == sorted([*own, (None, mail.replace("a.b@c.org", "[EMAIL]"))], key=str)
