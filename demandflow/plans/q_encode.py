"""Registered queries: encodings (A19, K1-K7, O7), time split (K2), the scoring
chain (K8-K13, K15, F7, A28), file sinks of its output (S4-S7), and the
V1 / V2 / NB feature tables (C24)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.functions.geo import with_geo_columns
from demandflow.functions.interact import with_interactions
from demandflow.operators import encode as E
from demandflow.operators import score as S
from demandflow.operators.split import time_blocks
from demandflow.plans import inputs as I
from demandflow.plans.features import column_order, model_columns

from demandflow.plans.registry import context, query, rnd, sql_rnd
from demandflow.plans.sql_features import FOLDS_CTE, feature_sql, prefix_sql
from demandflow.session import cut_lineage
from demandflow.sources import files
from demandflow.sources.observations import oracle

ROAD_MODE = """stats as (select (select RoadType from (select RoadType, count(*) as n from history
  where RoadType is not null group by 1) order by n desc, RoadType limit 1) as road_mode)"""
BASE_CTE = ROAD_MODE + """,
ch as (select "Index", geohash, hour, coalesce(RoadType, road_mode) as RoadType, demand, time_order,
  "Index" % 5 as fold from history_t cross join stats),
cf as (select "Index", geohash, hour, coalesce(RoadType, road_mode) as RoadType from future_t cross join stats),
gm as (select cast(sum(cast(demand as decimal(38,12))) as double) / count(demand) as g from ch)"""


def _q(c):
    return f'"{c}"'


# --------------------------------------------------------- encodings

def _hist_f(spark, sf):
    """Cleaned V2 history with folds, and cleaned future (time columns, RoadType filled)."""
    c = I.cleaned(spark, sf, "v2")
    return E.with_fold(c.history), c.future


def _g(spark, sf):
    return context(spark, sf).get("g_v2", lambda: E.global_mean(I.cleaned(spark, sf, "v2").history))


@query("k1_fold_id", oracle('select "Index", cast("Index" % 5 as integer) as fold from history'))
def k1(spark, sf):
    return E.with_fold(I.history(spark, sf)).select("Index", "fold")


@query("k1_shuffled_folds", oracle('select "Index", fold from folds', FOLDS_CTE))
def k1_shuffled(spark, sf):
    return E.with_fold(I.history(spark, sf).select("Index"), method="shuffled")


@query("a19_frequency_encoding", oracle(
    "select x.\"Index\", " + sql_rnd("coalesce(c.kc, 0) / cast(t.n as double)") + " as geohash_freq from "
    "(select \"Index\", geohash from history union all select \"Index\", geohash from future) x "
    "left join (select geohash, count(*) as kc from history group by geohash) c on c.geohash = x.geohash "
    "cross join (select count(*) as n from history) t"))
def a19(spark, sf):
    h, f = I.history(spark, sf), I.future(spark, sf)
    both = h.select("Index", "geohash").unionByName(f.select("Index", "geohash"))
    return E.frequency_encode(both, h).select("Index", rnd("geohash_freq").alias("geohash_freq"))


_TE_SQL = BASE_CTE + """,
pf as (select geohash, fold, sum(cast(demand as decimal(38,12))) as fs, count(*) as fn from ch group by geohash, fold),
pt as (select geohash, sum(fs) as ks, sum(fn) as kn from pf group by geohash)"""


@query("k3_oof_target_encoding", oracle(
    "select h.\"Index\", " + sql_rnd("coalesce((cast(pt.ks - pf.fs as double) + g * 10.0) / (pt.kn - pf.fn + 10.0), g)")
    + " as te_geohash from ch h left join pf on pf.geohash = h.geohash and pf.fold = h.fold "
    "left join pt on pt.geohash = h.geohash cross join gm", _TE_SQL))
def k3(spark, sf):
    h, f = _hist_f(spark, sf)
    out, _ = E.target_encode(h, None, ["geohash"], "te_geohash", 10, _g(spark, sf))
    return out.select("Index", rnd("te_geohash").alias("te_geohash"))


@query("k4_full_target_encoding", oracle(
    "select f.\"Index\", " + sql_rnd("coalesce((cast(pt.ks as double) + g * 10.0) / (pt.kn + 10.0), g)")
    + " as te_geohash from cf f left join pt on pt.geohash = f.geohash cross join gm", _TE_SQL))
def k4(spark, sf):
    h, f = _hist_f(spark, sf)
    _, out = E.target_encode(h, f, ["geohash"], "te_geohash", 10, _g(spark, sf))
    return out.select("Index", rnd("te_geohash").alias("te_geohash"))


def _feature_query(variant, cols=None):
    ctes, body = feature_sql(variant)
    if cols is not None:
        body = f"select {', '.join(_q(c) for c in cols)} from ({body})"

    def fn(spark, sf):
        h, f = I.features(spark, sf, variant)
        t = h.withColumn("side", F.lit("history")).unionByName(
            f.withColumn("side", F.lit("future")), allowMissingColumns=True)
        if cols is not None:
            t = t.select(*cols)
        return t.select(*[rnd(c).alias(c) if isinstance(t.schema[c].dataType, T.DoubleType) else F.col(c)
                          for c in t.columns])
    return oracle(body, ctes), fn


for _variant in ("v1", "v2", "nb"):
    _sql, _fn = _feature_query(_variant)
    query(f"{_variant}_feature_table", _sql)(_fn)

_sql, _fn = _feature_query("v1", ["Index", "side"] + [n for n, _, _ in E.V1_ENCODINGS])
query("k5_v1_encodings", _sql)(_fn)
_sql, _fn = _feature_query("v2", ["Index", "side"] + [n for n, _, _ in E.V2_ENCODINGS])
query("k6_v2_encodings", _sql)(_fn)
_V2_MODEL_COLS = model_columns(column_order("v2", "history"))
_sql, _fn = _feature_query("v2", _V2_MODEL_COLS)
query("c24_feature_select", _sql)(_fn)


def _codes_sql(cols):
    parts = []
    for c in cols:
        parts.append(f"""select '{c}' as column_name, value, cast(row_number() over (order by side, t, "Index") - 1 as integer) as code
  from (select value, min_by(side, (side, t, "Index")) as side, min_by(t, (side, t, "Index")) as t,
        min_by("Index", (side, t, "Index")) as "Index" from (
        select coalesce(cast({_q(c)} as varchar), 'nan') as value, 0 as side, time_order as t, "Index" from fin_history
        union all select coalesce(cast({_q(c)} as varchar), 'nan'), 1, 0, "Index" from fin_future) group by value)""")
    return " union all ".join(parts)


def _codes(spark, sf, cols):
    """Codes of the cleaned rows' categories: the columns they need, not the feature table."""
    c = I.cleaned(spark, sf, "v2")
    wide = lambda df: with_interactions(with_geo_columns(df, decoded=I.decoded(spark, sf)), v2_extras=False)
    codes = E.appearance_codes(wide(c.history).select("Index", "time_order", *cols), wide(c.future).select("Index", *cols), cols)
    return codes.select(F.col("column").alias("column_name"), "value", "code")


_ctes_v2, _ = feature_sql("v2")


@query("o7_first_appearance_rank", oracle(_codes_sql(["geohash"]), _ctes_v2))
def o7(spark, sf):
    return _codes(spark, sf, ["geohash"])


@query("k7_label_encoding", oracle(_codes_sql(E.CATEGORY_COLUMNS), _ctes_v2))
def k7(spark, sf):
    return _codes(spark, sf, E.CATEGORY_COLUMNS)


# ------------------------------------------------------- time split (K2)

BLOCK_CTE = BASE_CTE + """,
pos as (select *, row_number() over (order by time_order, "Index") - 1 as p from ch),
nn as (select count(*) as n, count(*) // 4 as t, count(*) - 3 * (count(*) // 4) as st from ch),
blocked as (select pos.*, cast(case when p < st then -1 else (p - st) // t end as integer) as block
  from pos cross join nn)"""


def _blocked(spark, sf):
    def build():
        h, _ = _hist_f(spark, sf)
        return cut_lineage(time_blocks(h, 3))
    return context(spark, sf).get("blocked", build)


@query("k2_time_split", oracle('select "Index", time_order, block from blocked', BLOCK_CTE))
def k2(spark, sf):
    return time_blocks(I.history_t(spark, sf).select("Index", "time_order"), 3)


def prefix_rows(spark, sf):
    """V2 history with the encodings of each fold of the time split."""
    def build():
        h, _ = I.features(spark, sf, "v2")
        keys = list(dict.fromkeys(k for _, keys, _ in E.V2_ENCODINGS for k in keys))
        rows = E.with_fold(h.select("Index", "demand", "time_order", *keys), method="shuffled")
        return E.prefix_encodings(cut_lineage(time_blocks(rows, 3)), E.V2_ENCODINGS, 3)
    return context(spark, sf).get("prefix", build)


_prefix_ctes, _prefix_body = prefix_sql()


@query("k6_encodings_by_time_fold", oracle(_prefix_body, _prefix_ctes))
def k6_prefix(spark, sf):
    names = [n for n, _, _ in E.V2_ENCODINGS]
    return prefix_rows(spark, sf).select("Index", "cv", "role", *[rnd(n).alias(n) for n in names])


# --------------------------------------------------- scoring chain

def _pred_sql():
    ctes, preds = [], []
    for j, (model, keys, m) in enumerate(S.STANDIN_MODELS):
        ks = ", ".join(_q(k) for k in keys)
        on = " and ".join(f"v.{_q(k)} = r.{_q(k)}" for k in keys)
        ctes.append(f"pf{j} as (select {ks}, fold, sum(cast(demand as decimal(38,12))) as fs, count(*) as fn "
                    f"from ch group by {ks}, fold)")
        ctes.append(f"pt{j} as (select {ks}, sum(fs) as ks, sum(fn) as kn from pf{j} group by {ks})")
        ctes.append(f"pv{j} as (select t.{ks.replace(', ', ', t.')}, s.fold, (cast(t.ks - coalesce(f.fs, 0) as double) "
                    f"+ g * {m!r}) / (t.kn - coalesce(f.fn, 0) + {m!r}) as v from pt{j} t "
                    f"cross join (select unnest(range(5)) as fold) s left join pf{j} f "
                    f"on {' and '.join(f'f.{_q(k)} = t.{_q(k)}' for k in keys)} and f.fold = s.fold cross join gm)")
        preds.append(f"select r.\"Index\", '{model}' as model, [42, 123, 456, 789, 2024][r.fold + 1] as seed, "
                     f"greatest(coalesce(v.v, g), 0.0) as prediction from (select *, unnest(range(5)) as fold from cf) r "
                     f"left join pv{j} v on {on} and v.fold = r.fold cross join gm")
    ctes.append("preds as (" + " union all ".join(preds) + ")")
    ctes.append('avgp as (select "Index", model, cast(sum(cast(prediction as decimal(38,12))) as double) '
                '/ count(prediction) as prediction from preds group by "Index", model)')
    ctes.append('sc as (select model, sqrt(sse / n) as rmse, 1.0 - sse / (syy - sy * sy / n) as r2, n from ('
                'select model, cast(sum(cast(pow(t.demand - a.prediction, 2) as decimal(38,12))) as double) as sse, '
                'cast(sum(cast(t.demand as decimal(38,12))) as double) as sy, '
                'cast(sum(cast(t.demand * t.demand as decimal(38,12))) as double) as syy, count(*) as n '
                'from avgp a join truth t using ("Index") group by model))')
    return BASE_CTE + ",\n" + ",\n".join(ctes)


def _cv_sql():
    ctes, tests = [], []
    for j, (model, keys, m) in enumerate(S.STANDIN_MODELS):
        ks = ", ".join(_q(k) for k in keys)
        ctes.append(f"bk{j} as (select {ks}, block, sum(cast(demand as decimal(38,12))) as bs, count(*) as bn "
                    f"from blocked group by {ks}, block)")
        ctes.append(f"sp{j} as (select {ks}, bs, bn, unnest(range(block + 1, 3)) as fold from bk{j})")
        ctes.append(f"tr{j} as (select {ks}, fold, sum(bs) as ts, sum(bn) as tn from sp{j} group by {ks}, fold)")
        ctes.append(f"gt{j} as (select fold, cast(sum(bs) as double) / sum(bn) as gg from sp{j} group by fold)")
        on = " and ".join(f"r.{_q(k)} = x.{_q(k)}" for k in keys)
        tests.append(f"select x.\"Index\", '{model}' as model, x.block as fold, greatest(coalesce("
                     f"(cast(r.ts as double) + gt.gg * {m!r}) / (r.tn + {m!r}), gt.gg), 0.0) as prediction, x.demand "
                     f"from blocked x left join tr{j} r on {on} and r.fold = x.block "
                     f"left join gt{j} gt on gt.fold = x.block where x.block >= 0")
    ctes.append("cvp as (" + " union all ".join(tests) + ")")
    ctes.append("fsc as (select model, fold, sqrt(sse / n) as rmse, 1.0 - sse / (syy - sy * sy / n) as r2 from ("
                "select model, fold, cast(sum(cast(pow(demand - prediction, 2) as decimal(38,12))) as double) as sse, "
                "cast(sum(cast(demand as decimal(38,12))) as double) as sy, "
                "cast(sum(cast(demand * demand as decimal(38,12))) as double) as syy, count(*) as n "
                "from cvp group by model, fold))")
    ctes.append("cvs as (select model, avg(rmse) as rmse, avg(r2) as r2 from fsc group by model)")
    ctes.append("wts as (select model, (1.0 / rmse) / (select sum(1.0 / rmse) from cvs) as weight from cvs)")
    return BLOCK_CTE + ",\n" + ",\n".join(ctes)


PRED_CTE = _pred_sql()
CV_CTE = _cv_sql()
BLEND_CTE = PRED_CTE + ",\n" + CV_CTE[len(BLOCK_CTE) - len(BLOCK_CTE.lstrip()):].split(BASE_CTE, 1)[1].lstrip(",\n") \
    + """,
bl as (select "Index", sum(weight * prediction) as raw from avgp join wts using (model) group by "Index"),
sub as (select "Index", greatest(raw, 0.0) as demand, raw from bl)"""


def _preds(spark, sf):
    def build():
        h, f = _hist_f(spark, sf)
        return S.encoding_predictions(h, f)
    return context(spark, sf).get("standin_preds", build)


def _avgp(spark, sf):
    return context(spark, sf).get("avgp", lambda: cut_lineage(S.seed_average(_preds(spark, sf))))


def _cv(spark, sf):
    def build():
        b = _blocked(spark, sf)
        out = S.cv_predictions(b, k=3)
        fold_scores = S.score(out, b.select("Index", "demand"), by=("model", "fold"))
        return cut_lineage(S.cv_summary(fold_scores))
    return context(spark, sf).get("cv", build)


def _weights(spark, sf):
    return S.inverse_rmse_weights(_cv(spark, sf))


def _submission(spark, sf):
    return context(spark, sf).get("submission", lambda: cut_lineage(S.blend(_avgp(spark, sf), _weights(spark, sf))))


@query("k12_seed_average", oracle(f'select "Index", model, {sql_rnd("prediction")} as prediction from avgp', PRED_CTE))
def k12(spark, sf):
    return _avgp(spark, sf).select("Index", "model", rnd("prediction").alias("prediction"))


@query("k8_rmse", oracle(f"select model, {sql_rnd('rmse')} as rmse, n from sc", PRED_CTE))
def k8(spark, sf):
    return S.score(_avgp(spark, sf), I.truth(spark, sf)).select("model", rnd("rmse").alias("rmse"), "n")


@query("k9_r2", oracle(f"select model, {sql_rnd('r2')} as r2, {sql_rnd('greatest(0.0, r2 * 100.0)')} as shown "
                       "from sc", PRED_CTE))
def k9(spark, sf):
    s = S.score(_avgp(spark, sf), I.truth(spark, sf))
    return s.select("model", rnd("r2").alias("r2"), rnd(S.display_score()).alias("shown"))


@query("k10_cv_mean_scores", oracle(f"select model, {sql_rnd('rmse')} as rmse, {sql_rnd('r2')} as r2 from cvs",
                                    CV_CTE))
def k10(spark, sf):
    return _cv(spark, sf).select("model", rnd("rmse").alias("rmse"), rnd("r2").alias("r2"))


@query("k11_inverse_rmse_weights", oracle(f"select model, {sql_rnd('weight')} as weight from wts", CV_CTE))
def k11(spark, sf):
    return _weights(spark, sf).select("model", rnd("weight").alias("weight"))


@query("k13_weighted_blend", oracle(f'select "Index", {sql_rnd("demand")} as demand from sub', BLEND_CTE))
def k13(spark, sf):
    return _submission(spark, sf).select("Index", rnd("demand").alias("demand"))


_DEFAULTS = dict(zip([name for name, _, _ in S.STANDIN_MODELS], S.DEFAULT_WEIGHTS_V1.values()))
_FIXED = dict(zip([name for name, _, _ in S.STANDIN_MODELS], S.FIXED_WEIGHTS_V2.values()))


def _case(weights):
    return "case model " + " ".join(f"when '{k}' then {float(v)!r}" for k, v in weights.items()) + " end"


@query("k13_saved_else_default_blend", oracle(
    'select "Index", ' + sql_rnd(f"greatest(sum(coalesce(w.weight, {_case(_DEFAULTS)}) * prediction), 0.0)") + " as demand "
    "from avgp left join (select * from wts where model = 'te_geohash') w using (model) group by \"Index\"", BLEND_CTE))
def k13_saved(spark, sf):
    """Only one model has a saved weight; the others take their defaults."""
    saved = _weights(spark, sf).where("model = 'te_geohash'")
    return S.blend(_avgp(spark, sf), saved, _DEFAULTS).select("Index", rnd("demand").alias("demand"))


@query("k13_fixed_weights_blend", oracle(
    'select "Index", ' + sql_rnd(f"greatest(sum({_case(_FIXED)} * prediction), 0.0)") + ' as demand from avgp group by "Index"', PRED_CTE))
def k13_fixed(spark, sf):
    return S.blend(_avgp(spark, sf), S.weights_frame(spark, _FIXED)).select("Index", rnd("demand").alias("demand"))


@query("f7_clip_at_zero", oracle(f'select "Index", {sql_rnd("raw")} as raw, {sql_rnd("demand")} as demand from sub',
                                 BLEND_CTE))
def f7(spark, sf):
    return _submission(spark, sf).select("Index", rnd("raw").alias("raw"), rnd("demand").alias("demand"))


@query("k15_output_checks", oracle(
    "select count(*) as n_rows, count(distinct \"Index\") as n_unique_index, count(*) filter (where demand is null) "
    "as n_null, count(*) filter (where demand < 0) as n_negative, (select count(*) from future) as expected_rows, "
    "true as columns_ok, count(*) = (select count(*) from future) and count(distinct \"Index\") = count(*) "
    "and count(*) filter (where demand is null) = 0 and count(*) filter (where demand < 0) = 0 as ok from sub",
    BLEND_CTE))
def k15(spark, sf):
    expected = I.future(spark, sf).count()
    return S.output_checks(_submission(spark, sf).select("Index", "demand"), expected)


@query("a28_prediction_summary", oracle(
    f"select {sql_rnd('min(demand)')} as min, {sql_rnd('max(demand)')} as max, "
    f"{sql_rnd('cast(sum(cast(demand as decimal(38,12))) as double) / count(demand)')} as mean, "
    f"{sql_rnd('stddev_pop(demand)')} as std_pop, {sql_rnd('quantile_cont(demand, 0.5)')} as median from sub",
    BLEND_CTE))
def a28(spark, sf):
    s = S.prediction_summary(_submission(spark, sf).select("Index", "demand"))
    return s.select(*[rnd(c).alias(c) for c in ["min", "max", "mean", "std_pop", "median"]])


# ------------------------------------------------------------ sinks

@query("s4_submission_csv_sink", oracle(f'select "Index", {sql_rnd("demand")} as demand from sub', BLEND_CTE))
def s4(spark, sf):
    path = I.scratch(spark, "submission.csv")
    files.write_csv(_submission(spark, sf).select("Index", "demand"), path)
    back = files.read_csv(spark, path, files.SUBMISSION_SCHEMA)
    return back.select("Index", rnd("demand").alias("demand"))


WEIGHTS_SCHEMA = T.StructType([T.StructField("model", T.StringType()), T.StructField("weight", T.DoubleType())])


@query("s6_params_json_sink", oracle(f"select model, {sql_rnd('weight')} as weight from wts", CV_CTE))
def s6(spark, sf):
    path = I.scratch(spark, "best_params.json")
    files.write_params(_weights(spark, sf), path)
    return files.read_params(spark, path, WEIGHTS_SCHEMA).select("model", rnd("weight").alias("weight"))


@query("s5_params_json_source", oracle(f"select model, {sql_rnd('weight')} as weight from wts", CV_CTE))
def s5(spark, sf):
    path = I.scratch(spark, "best_params.json")
    files.write_params(_weights(spark, sf).select(F.struct("model", "weight").alias("params")), path)
    nested = files.read_params(spark, path)
    return nested.select(F.col("params.model").alias("model"), rnd("params.weight").alias("weight"))


@query("s7_params_fallback", oracle(f"select model, {sql_rnd('weight')} as weight from wts", CV_CTE))
def s7(spark, sf):
    path = I.scratch(spark, "missing_params.json")
    df = files.params_or_compute(spark, path, lambda: _weights(spark, sf), WEIGHTS_SCHEMA)
    return df.select("model", rnd("weight").alias("weight"))


@query("s7_params_saved", oracle(f"select model, {sql_rnd('weight')} as weight from wts", CV_CTE))
def s7_saved(spark, sf):
    """The saved file is there, so nothing is computed."""
    path = I.scratch(spark, "saved_params.json")
    files.write_params(_weights(spark, sf), path)

    def never():
        raise AssertionError("saved parameters were not read")
    return files.params_or_compute(spark, path, never, WEIGHTS_SCHEMA).select("model", rnd("weight").alias("weight"))


DOCUMENT_SCHEMA = "models map<string, struct<rmse: double, r2: double>>, ensemble_weights map<string, double>"


@query("s5_nested_params_document", oracle(
    f"select model, {sql_rnd('rmse')} as rmse, {sql_rnd('r2')} as r2, {sql_rnd('weight')} as weight from cvs join wts using (model)", CV_CTE))
def s5_document(spark, sf):
    """One nested document for a run (a record per model, the ensemble weights), written and read back."""
    path = I.scratch(spark, "run_params.json")
    both = _cv(spark, sf).join(_weights(spark, sf), "model")
    files.write_params(both.groupBy().agg(
        F.map_from_entries(F.collect_list(F.struct("model", F.struct("rmse", "r2")))).alias("models"),
        F.map_from_entries(F.collect_list(F.struct("model", "weight"))).alias("ensemble_weights")), path)
    document = spark.read.schema(DOCUMENT_SCHEMA).json(path)
    return document.select(F.explode("models").alias("model", "scores"), "ensemble_weights").select(
        "model", rnd("scores.rmse").alias("rmse"), rnd("scores.r2").alias("r2"), rnd(F.col("ensemble_weights")[F.col("model")]).alias("weight"))
