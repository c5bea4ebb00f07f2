"""Registered queries: modelling tables, models, metrics, attributions and fairness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.operators import bias, evaluation, modeling
from quadrangle.plans.registry import Views, query
from quadrangle.sources import catalog

# --- modelling tables -----------------------------------------------------------------------


def features(v: Views) -> DataFrame:
    """Customers as a table of features, some with nulls."""
    c = v.table("customer")
    return c.select(F.col("c_custkey").cast("string").alias("student_id"), (F.col("c_acctbal") > 3000).alias("target"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"), F.col("c_nationkey").alias("nation"), (F.col("c_nationkey") * 2).alias("twice"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_mktsegment")).alias("segment"), F.lit(1).alias("one"), F.when(F.col("c_custkey") % 10 == 0, 1).alias("rare"))


_FEATURES = "(select cast(c_custkey as varchar) student_id, c_acctbal>3000 target, case when c_acctbal>0 then c_acctbal end balance, c_nationkey nation, c_nationkey*2 twice, case when c_custkey%5>0 then c_mktsegment end segment, 1 one, case when c_custkey%10=0 then 1 end rare from customer)"


_U = "(cast('0x'||substr(md5(student_id||':0'),1,8) as bigint)/4294967296.0)"


@query("random_split", f"select student_id, case when {_U}<0.6 then 'train' when {_U}<0.8 then 'test' else 'validate' end as split from v_pred")
def _(v: Views) -> DataFrame:
    return modeling.random_split(v.pred().drop("split")).select("student_id", "split")


@query("sample_weights", "select student_id, target, r(n/(2.0*k)) as sample_weight from (select student_id, target, count(*) over () n, count(*) over (partition by target) k from v_pred)")
def _(v: Views) -> DataFrame:
    return modeling.sample_weights(v.pred().select("student_id", "target"))


_SKEW = f"(select abs(skewness(balance)) s, avg(balance) a, median(balance) m, count(*)-count(balance) z from {_FEATURES})"
_MODE = f"(select segment from {_FEATURES} where segment is not null group by 1 order by count(*) desc, 1 limit 1)"


@query("impute_fit", f"select 'balance' as \"column\", case when s>=0.5 then 'median' else 'mean' end as strategy, r(case when s>=0.5 then m else a end) as value, z>0 as had_nulls from {_SKEW} union all select 'segment', 'mode', null, true from {_MODE}")
def _(v: Views) -> DataFrame:
    return modeling.impute_fit(features(v), ["balance", "segment"]).select("column", "strategy", F.col("value").try_cast("double").alias("value"), "had_nulls")


_FILLED = f"select student_id, r(coalesce(balance, (select case when s>=0.5 then m else a end from {_SKEW}))) as balance, coalesce(segment, {_MODE}) as segment from {_FEATURES}"


@query("impute_transform", _FILLED)
def _(v: Views) -> DataFrame:
    d = features(v)
    return modeling.impute_transform(d, modeling.impute_fit(d, ["balance", "segment"])).select("student_id", "balance", "segment")


@query("missing_flags", f"select student_id, balance is null as balance_missing_flag, segment is null as segment_missing_flag from {_FEATURES}")
def _(v: Views) -> DataFrame:
    d = features(v)
    return modeling.missing_flags(d, modeling.impute_fit(d, ["balance", "nation", "segment"])).select("student_id", "balance_missing_flag", "segment_missing_flag")


@query("impute_validate", f"select 'rare' as \"column\", count(*) as n_null from {_FEATURES} where rare is null having count(*)>0")
def _(v: Views) -> DataFrame:
    d = features(v)
    return modeling.null_counts(modeling.impute_transform(d, modeling.impute_fit(d, ["balance", "segment"])))


@query("impute_persist", _FILLED)
def _(v: Views) -> DataFrame:
    from quadrangle.sources.readers import read_table
    from quadrangle.sources.writers import scratch_parquet

    d = features(v)
    fitted = read_table(v.spark, scratch_parquet(modeling.impute_fit(d, ["balance", "segment"])), format="parquet")
    return modeling.impute_transform(d, fitted).select("student_id", "balance", "segment")


@query("fill_with_mode", f"select student_id, coalesce(segment, {_MODE}) as segment from {_FEATURES}")
def _(v: Views) -> DataFrame:
    return modeling.fill_with_mode(features(v).select("student_id", "segment"), features(v), ["segment"])


@query("reference_sample", f"select student_id, target, r(balance) as balance, nation, twice, segment, one, rare from {_FEATURES} order by md5(student_id||':0'), student_id limit 100")
def _(v: Views) -> DataFrame:
    return modeling.reference_sample(features(v), n=100)


def _left(v: Views, gone: list[str], cols: list[str]) -> DataFrame:
    return features(v).select("student_id", *[c for c in cols if c not in gone])


@query("drop_incomplete", f"select student_id, balance, nation from {_FEATURES}".replace("balance,", "r(balance) as balance,", 1))
def _(v: Views) -> DataFrame:
    cols = ["balance", "nation", "rare"]
    return _left(v, modeling.incomplete_features(features(v).select(*cols), 0.5), cols)


@query("drop_low_variance", f"select student_id, nation, segment from {_FEATURES}")
def _(v: Views) -> DataFrame:
    cols = ["nation", "segment", "one"]
    return _left(v, modeling.low_variance_features(features(v).select(*cols)), cols)


@query("drop_collinear", f"select student_id, r(balance) as balance from {_FEATURES}")
def _(v: Views) -> DataFrame:
    cols = ["balance", "nation", "twice"]
    gone = modeling.collinear_features(features(v).select(*cols))
    return _left(v, [c for c in cols if c in gone], cols)


@query("select_features", f"select student_id, target, r(balance) as balance, segment from {_FEATURES}")
def _(v: Views) -> DataFrame:
    kept = modeling.select_features(features(v), keep=["student_id", "target"])
    return features(v).select(*kept)


# --- models ---------------------------------------------------------------------------------

_INPUTS = ["balance", "nation"]


@query("train_candidates")
def _(v: Views) -> DataFrame:
    return modeling.train_candidates(modeling.random_split(features(v)), _INPUTS)[0]


def _fitted(v: Views) -> modeling.LinearModel:
    """Fitted on the training rows."""
    d = modeling.random_split(features(v))
    return modeling.fit_logistic(d.where("split = 'train'"), _INPUTS)


_H = {"h00": "p*(1-p)", "h01": "p*(1-p)*u", "h02": "p*(1-p)*v", "h11": "p*(1-p)*u*u", "h12": "p*(1-p)*u*v", "h22": "p*(1-p)*v*v", "g0": "y-p", "g1": "(y-p)*u", "g2": "(y-p)*v"}
#: The same model in SQL: Newton's method, each step solved by Cramer's rule; `fit` is its one row of coefficients.
_FIT = f"""
    tr as (select cast(target as int) y, cast(balance as double) b, cast(nation as double) c from {_FEATURES} where {_U}<0.6),
    ms as (select avg(b) mb, avg(c) mc, sqrt(count(b)*var_pop(b)/count(*)) sb, sqrt(count(c)*var_pop(c)/count(*)) sc from tr),
    z as materialized (select y, (coalesce(b,mb)-mb)/sb u, (coalesce(c,mc)-mc)/sc v from tr, ms),
    it(k, b0, b1, b2) as (select 0, cast(0 as double), cast(0 as double), cast(0 as double) union all
        select k+1, b0+(g0*(a11*a22-h12*h12)-h01*(e1*a22-h12*e2)+h02*(e1*h12-a11*e2))/det,
            b1+(h00*(e1*a22-e2*h12)-g0*(h01*a22-h12*h02)+h02*(h01*e2-e1*h02))/det, b2+(h00*(a11*e2-e1*h12)-h01*(h01*e2-e1*h02)+g0*(h01*h12-a11*h02))/det
        from (select *, h00*(a11*a22-h12*h12)-h01*(h01*a22-h12*h02)+h02*(h01*h12-a11*h02) det from
            (select *, h11+1 a11, h22+1 a22, g1-b1 e1, g2-b2 e2 from (select k, b0, b1, b2, {", ".join(f"sum({t}) {n}" for n, t in _H.items())} from (select it.*, y, u, v, 1/(1+exp(-(b0+b1*u+b2*v))) p from it, z where k<40) group by k, b0, b1, b2)))),
    fit as (select b1/sb w1, b2/sc w2, b0-b1/sb*mb-b2/sc*mc w0, mb, mc from it, ms where k=40)"""


def _by_fit(body: str) -> str:
    return f"with recursive {_FIT} {body}"


@query("predict", _by_fit(f"select student_id, r(p) as pred_prob, p>=0.5 as pred from (select student_id, 1/(1+exp(-(w0+w1*coalesce(balance,mb)+w2*coalesce(nation,mc)))) p from {_FEATURES}, fit)"))
def _(v: Views) -> DataFrame:
    return modeling.predict(_fitted(v), features(v), _INPUTS)


_ATTRIBUTED = _by_fit(f"select student_id, r(w1*(coalesce(balance,mb)-(select avg(coalesce(balance,mb)) from {_FEATURES}, fit))) as balance, r(w2*(nation-(select avg(nation) from {_FEATURES}))) as nation from {_FEATURES}, fit")


@query("linear_attributions", _ATTRIBUTED)
def _(v: Views) -> DataFrame:
    return modeling.linear_attributions(_fitted(v), features(v))


@query("permutation_importance")
def _(v: Views) -> DataFrame:
    return modeling.permutation_importance(_fitted(v), features(v), _INPUTS)


@query("map_partitions_attributions", _ATTRIBUTED)
def _(v: Views) -> DataFrame:
    """The linear attributions again, by an explainer in Python as users bring them."""
    model = _fitted(v)
    d = features(v).select("student_id", F.col("balance").cast("double").alias("balance"), F.col("nation").cast("double").alias("nation"))
    means = d.agg(*[F.avg(model.filled(c)).alias(c) for c in _INPUTS]).first()  # one row
    weights, fills, centre = model.weights, model.fills, means.asDict()

    def explain(frames):
        for f in frames:
            yield f.assign(**{c: w * (f[c].fillna(fills[c]) - centre[c]) for c, w in weights.items()})

    return modeling.apply_attributions(d, explain, "student_id string, balance double, nation double")


# --- attribution tables over embeddings -----------------------------------------------------

_X = [f"x{k}" for k in range(8)]


def attributions(v: Views) -> DataFrame:
    return v.table("embeddings").select(F.col("vec_id").cast("string").alias("student_id"), *[F.col("embedding")[k].cast("double").alias(c) for k, c in enumerate(_X)])


_ATT = "(select cast(vec_id as varchar) student_id, " + ", ".join(f"cast(embedding[{k + 1}] as double) x{k}" for k in range(8)) + " from embeddings)"
_LONG = "(" + " union all ".join(f"select student_id, '{c}' feature, {c} a, {k} k from {_ATT}" for k, c in enumerate(_X)) + ")"


@query("rank_features", f"select feature, round_even(avg(abs(a)),4) as average, case when round_even(avg(abs(a)),4)=0 then '<0.0000' else printf('%.4f', round_even(avg(abs(a)),4)) end as shown from {_LONG} group by 1")
def _(v: Views) -> DataFrame:
    return modeling.rank_features(attributions(v), _X)


@query("rank_features_described", f"select feature, round_even(avg(abs(a)),4) as average, 'component '||substr(feature,2) as readable, 'One component of an embedding' as short_desc, cast(null as varchar) as long_desc from {_LONG} group by 1")
def _(v: Views) -> DataFrame:
    """With an institution's own catalog: one key with a group, without a long description."""
    path = catalog.write_catalog(v.spark, [(0, r"^x(\d+)$", "component {}", "One component of an embedding", None)])
    ranked = modeling.rank_features(attributions(v), _X).drop("shown")
    return catalog.map_feature_names(ranked, catalog.read_catalog(v.spark, path))


_TOP = f"(select *, row_number() over (partition by student_id order by abs(a) desc, k) n from {_LONG})"


@query("top_features_per_student", "select student_id, " + ", ".join(f"max(case when n={n} then feature end) as feature_{n}, round_even(max(case when n={n} then a end),2) as value_{n}, round_even(max(case when n={n} then a end),2) as importance_{n}" for n in (1, 2, 3)) + f" from {_TOP} group by 1")
def _(v: Views) -> DataFrame:
    return modeling.top_features_per_student(attributions(v), attributions(v), _X)


@query("top_k_features_global", f"select student_id, feature, r(a) as attribution, r(a) as value from {_LONG} where feature in (select feature from {_LONG} group by 1 order by round_even(avg(abs(a)),4) desc, 1 limit 3)")
def _(v: Views) -> DataFrame:
    return modeling.top_k_features_global(attributions(v), attributions(v), _X, n=3)


@query("grouped_shap", f"select student_id, r(x0+x1+x2) as a, r(x3+x4) as b from {_ATT}")
def _(v: Views) -> DataFrame:
    return modeling.grouped_attributions(attributions(v), {"a": ["x0", "x1", "x2"], "b": ["x3", "x4"]})


@query("grouped_values", "select cast(c_custkey as varchar) as student_id, case when c_nationkey<5 then 'MISSING' else c_mktsegment end as segment from customer")
def _(v: Views) -> DataFrame:
    d = v.table("customer").select(F.col("c_custkey").cast("string").alias("student_id"), F.when((F.col("c_nationkey") >= 5) & (F.col("c_nationkey") < 15), F.col("c_mktsegment")).alias("s1"), F.when(F.col("c_nationkey") >= 15, F.col("c_mktsegment")).alias("s2"))
    return modeling.grouped_values(d, {"segment": ["s1", "s2"]})


_NAMED = """select f as feature, n, case f when 'num_courses' then 'num courses' when 'took_course_id_engl_101' then 'took course engl_101 this term' else f end as readable,
    case f when 'num_courses' then 'From the data of the institution: num courses' when 'took_course_id_engl_101' then 'Whether a course of it was taken in the term: course id that the name gives' end as short_desc,
    case f when 'num_courses' then 'From the data of the institution: num courses. As reported, or counted from what was reported.' when 'took_course_id_engl_101' then '1 if the student took at least one in this term, else 0.' end as long_desc
    from (select case l_linenumber when 1 then 'num_courses' when 2 then 'took_course_id_engl_101' when 3 then 'cumsum_num_credits' else 'other' end as f, count(*) as n from lineitem group by 1)"""


@query("map_feature_names", _NAMED)
def _(v: Views) -> DataFrame:
    line = F.col("l_linenumber")
    d = v.table("lineitem").groupBy(F.when(line == 1, "num_courses").when(line == 2, "took_course_id_engl_101").when(line == 3, "cumsum_num_credits").otherwise("other").alias("feature")).agg(F.count("*").alias("n"))
    path = catalog.write_catalog(v.spark, catalog.catalog_rows(["num_courses", "cumsum_num_credits_earned"]))
    return catalog.map_feature_names(d, catalog.read_catalog(v.spark, path))


# --- runs: one row per supplier group -------------------------------------------------------


def runs(v: Views) -> DataFrame:
    s = v.table("supplier")
    return s.groupBy(F.concat(F.lit("run"), (F.col("s_suppkey") % 10).cast("string")).alias("run_id"), F.concat(F.lit("model"), (F.col("s_suppkey") % 3).cast("string")).alias("model_type")).agg(F.avg("s_acctbal").alias("val_roc_auc"), F.stddev_pop("s_acctbal").alias("val_log_loss"))


_RUNS = "(select 'run'||cast(s_suppkey%10 as varchar) run_id, 'model'||cast(s_suppkey%3 as varchar) model_type, avg(s_acctbal) val_roc_auc, stddev_pop(s_acctbal) val_log_loss from supplier group by 1, 2)"
_BALANCED = f"select run_id, model_type, r(((1-(val_roc_auc-min(val_roc_auc) over ())/(max(val_roc_auc) over ()-min(val_roc_auc) over ()))+coalesce((val_log_loss-min(val_log_loss) over ())/nullif(max(val_log_loss) over ()-min(val_log_loss) over (),0),0))/2) as balanced from {_RUNS}"


@query("balanced_score", _BALANCED)
def _(v: Views) -> DataFrame:
    return modeling.balanced_score(runs(v), ["val_roc_auc", "val_log_loss"]).select("run_id", "model_type", "balanced")


@query("top_runs", f"{_BALANCED} order by 3, 1, 2 limit 3")
def _(v: Views) -> DataFrame:
    return modeling.balanced_score(runs(v), ["val_roc_auc", "val_log_loss"]).select("run_id", "model_type", "balanced").orderBy("balanced", "run_id", "model_type").limit(3)


@query("compare_models", f"select model_type, r(max(val_roc_auc)) as val_roc_auc from {_RUNS} group by 1")
def _(v: Views) -> DataFrame:
    return modeling.compare_models(runs(v), "val_roc_auc")


# --- metrics --------------------------------------------------------------------------------

_C = "count(*) as n, count(*) filter (where target) as n_positive, count(*) filter (where target and pred)*1.0 tp, count(*) filter (where not target and pred)*1.0 fp, count(*) filter (where target and not pred)*1.0 fn, count(*) filter (where not target and not pred)*1.0 tn, avg(-case when target then ln(least(greatest(pred_prob,1e-15),1-1e-15)) else ln(1-least(greatest(pred_prob,1e-15),1-1e-15)) end) ll"
_M = ["(tp+fn)/n prevalence", "(tp+fp)/n pred_prevalence", "(tp+tn)/n accuracy", "tp/nullif(tp+fp,0) precision", "tp/nullif(tp+fn,0) recall", "2*tp/nullif(2*tp+fp+fn,0) f1", "ll log_loss"]
_METRICS = "n, n_positive, " + ", ".join(f"r({m.rsplit(' ', 1)[0]}) as {m.rsplit(' ', 1)[1]}" for m in _M)


@query("classification_metrics", f"select {_METRICS} from (select {_C} from v_pred)")
def _(v: Views) -> DataFrame:
    return evaluation.classification_metrics(v.pred())


@query("performance_by_split", f"select split, {_METRICS} from (select split, {_C} from v_pred group by 1)")
def _(v: Views) -> DataFrame:
    return evaluation.classification_metrics(v.pred(), ["split"])


@query("format_metrics", "select n, n_positive, " + ", ".join(f"round_even(cast({m.rsplit(' ', 1)[0]} as double),2) as {m.rsplit(' ', 1)[1]}" for m in _M) + f" from (select {_C} from v_pred)")
def _(v: Views) -> DataFrame:
    return evaluation.format_metrics(evaluation.classification_metrics(v.pred()))


@query("sensitivity_top_q", "select r(count(*) filter (where target and pred_prob>=(select quantile_cont(pred_prob,0.9) from v_pred))*1.0/count(*) filter (where target)) as sensitivity from v_pred")
def _(v: Views) -> DataFrame:
    return evaluation.sensitivity_top_q(v.pred(), 0.9)


@query("confusion_matrix", f"select r(tp/(tp+fn)) as true_positive, r(fp/(fp+tn)) as false_positive, r(tn/(tn+fp)) as true_negative, r(fn/(fn+tp)) as false_negative from (select {_C} from v_pred)")
def _(v: Views) -> DataFrame:
    return evaluation.confusion_matrix(v.pred())


_TOTAL = "(select count(*) filter (where target) p, count(*) filter (where not target) q from v_pred)"


@query("roc_curve", f"""select s as threshold, tp, fp, q-fp as tn, p-tp as fn, round_even(tp*1.0/p,4) as tpr, round_even(fp*1.0/q,4) as fpr from (select s, count(*) filter (where target) tp, count(*) filter (where not target) fp from
    (select distinct round_even(pred_prob,4) s from v_pred) t left join v_pred on pred_prob>=s group by 1), {_TOTAL}""")
def _(v: Views) -> DataFrame:
    return evaluation.roc_curve(v.pred())


_PR = f"select s, tp*1.0/n pr, tp*1.0/p rc from (select s, count(*) filter (where target) tp, count(*) n from (select distinct pred_prob s from v_pred) t join v_pred on pred_prob>=s group by 1), {_TOTAL}"


@query("precision_recall_curve", f"select r(s) as threshold, r(pr) as precision, r(rc) as recall from ({_PR})")
def _(v: Views) -> DataFrame:
    return evaluation.precision_recall_curve(v.pred())


_AUC = "select {by} r((sum(case when target then rk end)-p*(p+1)/2.0)/(p*q)) as auc from (select {by} target, rank() over ({part} order by pred_prob)+(count(*) over (partition by {by} pred_prob)-1)/2.0 rk, sum(cast(target as int)) over ({part}) p, sum(cast(not target as int)) over ({part}) q from v_pred) group by {by} p, q"


@query("roc_auc", _AUC.format(by="", part=""))
def _(v: Views) -> DataFrame:
    return evaluation.roc_auc(v.pred())


_BIN = " + ".join(f"cast(pred_prob>{k}/10.0::double as int)" for k in range(1, 10))


@query("calibration_curve", f"select region, {_BIN} as bin, r(avg(pred_prob)) as mean_predicted, r(avg(cast(target as int))) as fraction_positive, count(*) as n from v_pred group by 1, 2")
def _(v: Views) -> DataFrame:
    return evaluation.calibration_curve(v.pred(), ["region"])


@query("score_histogram", "select cast(least(floor(pred_prob*20),19) as int) as bin, count(*) as n from v_pred group by 1")
def _(v: Views) -> DataFrame:
    return evaluation.score_histogram(v.pred())


@query("metrics_near_threshold", f"""select a.split, r(s) as threshold, r(tp*1.0/n) as precision, r(tp*1.0/p) as recall, auc from (select *, row_number() over (partition by split order by abs(s-0.5), s) rn from (select t.split, s, count(*) filter (where target) tp, count(*) n from
    (select distinct split, pred_prob s from v_pred) t join v_pred v on v.split=t.split and pred_prob>=s group by 1, 2)) a join (select split, count(*) filter (where target) p from v_pred group by 1) b on a.split=b.split join ({_AUC.format(by='split,', part='partition by split')}) c on a.split=c.split where rn=1""")
def _(v: Views) -> DataFrame:
    return evaluation.metrics_near_threshold(v.pred())


@query("support_score_bins", "select r(k/10.0) as lower, r((k+1)/10.0) as upper, r((k+0.5)/10.0) as midpoint, n, r(pct) as pct from (select cast(floor(pred_prob*10+1e-9) as int) k, count(*) n, 100.0*count(*)/sum(count(*)) over () pct from v_pred group by 1) where k between 1 and 9")
def _(v: Views) -> DataFrame:
    return evaluation.support_score_bins(v.pred())


@query("split_summary", "select split, count(*) as students, r(100.0*count(*)/sum(count(*)) over ()) as pct, r(sum(count(*)) over ()*case split when 'train' then 0.6 else 0.2 end) as expected from v_pred group by 1")
def _(v: Views) -> DataFrame:
    return evaluation.split_summary(v.pred(), {"train": 0.6, "test": 0.2, "validate": 0.2})


@query("extreme_students", "select which, student_id, r(pred_prob) as pred_prob from (select * from (select 'max' as which, student_id, pred_prob from v_pred order by pred_prob desc, student_id limit 1) union all select * from (select 'min', student_id, pred_prob from v_pred order by pred_prob, student_id limit 1) union all select * from (select 'median', student_id, pred_prob from v_pred order by abs(pred_prob-(select median(pred_prob) from v_pred)), student_id limit 1))")
def _(v: Views) -> DataFrame:
    return evaluation.extreme_students(v.pred())


# --- fairness -------------------------------------------------------------------------------

_GROUPS = ["priority", "region"]
_SUB = "(select *, 'priority' as grp, priority as subgroup from v_pred union all select *, 'region', region from v_pred)"
_RATES = f"""(select split, grp, subgroup, size, p, fnr, greatest(fnr-m,0) lo, least(fnr+m,1) hi from (select *, case when p>0 then 1.959964*sqrt(fnr*(1-fnr)/d) else 0 end m from (select *, case when p>0 then fn/d else 0 end fnr from
    (select *, fn+tp p, fn+tp+ln(1+fn+tp) d from (select split, grp, subgroup, count(*) size, count(*) filter (where target and not pred)*1.0::double fn, count(*) filter (where target and pred)*1.0::double tp from {_SUB} group by 1, 2, 3)))))"""


@query("fnr_by_group", f"select split, grp as \"group\", subgroup, size, r(p) as positives, r(fnr) as fnr, r(lo) as ci_low, r(hi) as ci_high from {_RATES}")
def _(v: Views) -> DataFrame:
    return bias.fnr_by_group(v.pred(), _GROUPS)


@query("group_bias_metrics", f"select split, grp as \"group\", subgroup, {_METRICS} from (select split, grp, subgroup, {_C} from {_SUB} group by 1, 2, 3)")
def _(v: Views) -> DataFrame:
    return bias.group_metrics(v.pred(), _GROUPS)


_PAIR = f"(select a.split, a.grp, a.subgroup s1, b.subgroup s2, a.size n1, b.size n2, a.p p1, b.p p2, a.fnr f1, b.fnr f2, a.lo lo1, a.hi hi1, b.lo lo2, b.hi hi2 from {_RATES} a join {_RATES} b on a.split=b.split and a.grp=b.grp and a.subgroup<b.subgroup)"
_TT = "(1/(1+0.3275911*(z/sqrt(2.0))))"
_P = f"({_TT}*(0.254829592+{_TT}*(-0.284496736+{_TT}*(1.421413741+{_TT}*(-1.453152027+{_TT}*1.061405429))))*exp(-z*z/2.0))"
_ZP = f"(select *, case when n1>30 and n2>30 then {_P} end pv from (select *, abs(f1-f2)/nullif(sqrt(f1*(1-f1)/n1+f2*(1-f2)/n2),0) z from {_PAIR}))"


@query("join_pairs", f"select split, grp as \"group\", s1, s2, r(f1) as f1, r(f2) as f2 from {_PAIR}")
def _(v: Views) -> DataFrame:
    return bias.join_pairs(bias.fnr_by_group(v.pred(), _GROUPS)).select("split", "group", F.col("subgroup_1").alias("s1"), F.col("subgroup_2").alias("s2"), F.col("fnr_1").alias("f1"), F.col("fnr_2").alias("f2"))


@query("z_test_fnr", f"select split, grp as \"group\", s1, s2, r(pv) as p from {_ZP}")
def _(v: Views) -> DataFrame:
    p = bias.join_pairs(bias.fnr_by_group(v.pred(), _GROUPS))
    return p.select("split", "group", F.col("subgroup_1").alias("s1"), F.col("subgroup_2").alias("s2"), bias.z_test_p(F.col("fnr_1"), F.col("fnr_2"), F.col("size_1").cast("double"), F.col("size_2").cast("double")).alias("p"))


@query("ci_overlap", f"select split, grp as \"group\", s1, s2, lo1<=hi2 and lo2<=hi1 as overlap from {_PAIR}")
def _(v: Views) -> DataFrame:
    p = bias.join_pairs(bias.fnr_by_group(v.pred(), _GROUPS))
    return p.select("split", "group", F.col("subgroup_1").alias("s1"), F.col("subgroup_2").alias("s2"), bias.ci_overlap().alias("overlap"))


_FLAGS = f"""(select split, grp, higher, lower, diff, pv, case when pv is null or few<need then 'INSUFFICIENT DATA' when diff<0.05 or pv>0.1 then 'NO BIAS' when diff>=0.15 and pv<=0.01 then 'HIGH BIAS' when diff>=0.1 and pv<=0.01 then 'MODERATE BIAS' else 'LOW BIAS' end flag from
    (select z.split, z.grp, case when f1>=f2 then s1 else s2 end higher, case when f1>=f2 then s2 else s1 end lower, abs(f1-f2) diff, pv, least(p1,p2) few, least(50, cast(floor(a.allp*0.15) as int)) need from {_ZP} z join (select split, grp, sum(p) allp from {_RATES} group by 1, 2) a on z.split=a.split and z.grp=a.grp where f1>0 and f2>0))"""


@query("bias_flags", f"select split, grp as \"group\", higher, lower, r(diff) as diff, r(pv) as p, flag from {_FLAGS}")
def _(v: Views) -> DataFrame:
    return bias.bias_flags(bias.fnr_by_group(v.pred(), _GROUPS)).drop("ci_overlap")


_W = "case flag when 'HIGH BIAS' then 1.0 when 'MODERATE BIAS' then 0.75 when 'LOW BIAS' then 0.25 else 0 end"


@query("bias_scores", f"select split, r(sum(diff*{_W})) as score_sum, r(sum(diff*{_W})/nullif(count(*) filter (where flag<>'INSUFFICIENT DATA'),0)) as score_mean, r(max(case when flag<>'INSUFFICIENT DATA' then diff end)) as max_diff, count(*) filter (where flag<>'INSUFFICIENT DATA') as n_valid, count(*) filter (where flag like '% BIAS' and flag<>'NO BIAS') as n_flagged from {_FLAGS} group by 1")
def _(v: Views) -> DataFrame:
    return bias.bias_scores(bias.bias_flags(bias.fnr_by_group(v.pred(), _GROUPS)))


@query("bias_tables", f"select flag, split, grp as \"group\", higher, lower, r(diff) as diff from {_FLAGS} where flag<>'INSUFFICIENT DATA'")
def _(v: Views) -> DataFrame:
    return bias.bias_flags(bias.fnr_by_group(v.pred(), _GROUPS)).where("flag <> 'INSUFFICIENT DATA'").select("flag", "split", "group", "higher", "lower", "diff").orderBy("flag", F.desc("diff"))


@query("bias_report", f"select split, grp as \"group\", flag, count(*) as n from {_FLAGS} group by 1, 2, 3")
def _(v: Views) -> DataFrame:
    return bias.bias_report(v.pred(), _GROUPS)["flags"].groupBy("split", "group", "flag").agg(F.count("*").alias("n"))


@query("bias_disparity_summary", f"select grp as \"group\", string_agg(t, '; ' order by t) as sentences from (select distinct grp, printf('%s: %s is missed %d%% more often than %s', flag, higher, cast(round_even(diff*100,0) as int), lower) t from {_FLAGS} where split='test' and flag in ('HIGH BIAS','MODERATE BIAS','LOW BIAS')) group by 1")
def _(v: Views) -> DataFrame:
    return bias.disparity_summary(bias.bias_flags(bias.fnr_by_group(v.pred(), _GROUPS)))


@query("group_threshold", "select student_id, pred_prob>=case when region='ASIA' then 0.3 else 0.5 end as flagged from v_pred")
def _(v: Views) -> DataFrame:
    return bias.group_threshold(v.pred(), "region", "ASIA", 0.3).select("student_id", "flagged")


@query("join_bias_perf_tables", f"select a.split, a.grp as \"group\", a.subgroup, r(a.fnr) as fnr, r(tp/nullif(tp+fn,0)) as recall from {_RATES} a join (select split, grp, subgroup, {_C} from {_SUB} group by 1, 2, 3) b on a.split=b.split and a.grp=b.grp and a.subgroup=b.subgroup")
def _(v: Views) -> DataFrame:
    r = bias.bias_report(v.pred(), _GROUPS)
    return r["rates"].join(r["metrics"].select("split", "group", "subgroup", "recall"), ["split", "group", "subgroup"]).select("split", "group", "subgroup", "fnr", "recall")
