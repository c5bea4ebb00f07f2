"""Registered queries: sources and sinks, contracts, descriptions, associations and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrangle.operators import contracts, eda, evaluation, selection, targets
from quadrangle.operators.cleaning import null_future_values
from quadrangle.plans import contract_sql, student_terms
from quadrangle.plans.oracle import WHOLE
from quadrangle.plans.registry import Views, query
from quadrangle.sources import catalog, readers, writers

# --- contracts ------------------------------------------------------------------------------


def _check(check: str, column: str, failed: str, view: str, severity: str = "error") -> str:
    return f"select '{check}' as \"check\", '{column}' as \"column\", '{severity}' as severity, count(*) filter (where {failed}) as n_failed from {view}"


_UNIQUE = "select 'unique', '{key}', 'error', cast(coalesce(sum(n),0) as bigint) from (select count(*) n from {view} group by {key} having count(*)>1)"
_KEY = "student_id,academic_year,academic_term,course_prefix,course_number,section_id"


def _soiled(v: Views, rules: str, source: DataFrame) -> DataFrame:
    """Rows of a table with values that break every rule here and there."""
    return v.spark.sql(contract_sql.soiled(rules, "{rows}"), rows=source)


def _soiled_sql(rules: str, source: str, more: str = "") -> str:
    return f"with rows as materialized ({contract_sql.soiled(rules, source)}) {contract_sql.counted(rules, 'rows')}{more}"


_TWICE = " union all " + _UNIQUE
_CREDITS = " union all " + _check("credits", "number_of_credits_earned", "try_cast(number_of_credits_attempted as float)<try_cast(number_of_credits_earned as float)", "rows")


@query("contract_raw_cohort", _soiled_sql(contract_sql.COHORT, "(select c_custkey k from customer)", _TWICE.format(key="student_id", view="rows")))
def _(v: Views) -> DataFrame:
    rows = _soiled(v, contract_sql.COHORT, v.table("customer").select(F.col("c_custkey").alias("k")))
    return contracts.violations(rows, contracts.COHORT, unique=["student_id"])


@query("contract_raw_course", _soiled_sql(contract_sql.COURSE, "(select l_orderkey*8+l_linenumber k from lineitem)", _CREDITS + _TWICE.format(key=_KEY, view="rows")))
def _(v: Views) -> DataFrame:
    rows = _soiled(v, contract_sql.COURSE, v.table("lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k")))
    earned = contracts.more_earned_than_attempted("earned", "attempted")
    casts = {"earned": F.col("number_of_credits_earned").try_cast("float"), "attempted": F.col("number_of_credits_attempted").try_cast("float")}
    return contracts.violations(rows.withColumns(casts), contracts.COURSE, unique=contracts.COURSE_KEY, extra=[("credits", "number_of_credits_earned", "error", earned)])


@query("contract_student_term", _soiled_sql(contract_sql.STUDENT_TERM, "(select o_orderkey k from orders)"))
def _(v: Views) -> DataFrame:
    rows = _soiled(v, contract_sql.STUDENT_TERM, v.table("orders").select(F.col("o_orderkey").alias("k")))
    return contracts.violations(rows, contracts.STUDENT_TERM)


@query("contract_labeled", " union all ".join([_check("kind", "student_id", "false", "v_pred"), _check("not_null", "student_id", "student_id is null", "v_pred"), _check("kind", "target", "false", "v_pred"), _check("not_null", "target", "target is null", "v_pred"), _check("kind", "split", "false", "v_pred"), _check("isin", "split", "split not in ('train','test','validate')", "v_pred")]))
def _(v: Views) -> DataFrame:
    return contracts.violations(v.pred(), contracts.LABELED)


@query("check_unique", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*)>1")
def _(v: Views) -> DataFrame:
    return contracts.repeated_keys(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_single_institution", "select count(distinct institution_id) as n, count(distinct institution_id)=1 as ok from v_cohort")
def _(v: Views) -> DataFrame:
    return v.cohort().agg(F.countDistinct("institution_id").alias("n")).withColumn("ok", F.col("n") == 1)


@query("check_credits", "select count(*) filter (where number_of_credits_attempted<number_of_credits_earned) as n_failed from v_course")
def _(v: Views) -> DataFrame:
    return v.course().agg(F.count_if(contracts.more_earned_than_attempted()).alias("n_failed"))


@query("check_declared_keys", "select count(*) as n_rows, count(*)-count(distinct c_custkey) as repeated, count(*) filter (where c_name is null) as null_names from customer")
def _(v: Views) -> DataFrame:
    return v.table("customer").agg(F.count("*").alias("n_rows"), (F.count("*") - F.countDistinct("c_custkey")).alias("repeated"), F.count_if(F.col("c_name").isNull()).alias("null_names"))


_WARN = {"c_acctbal": contracts.Field("double", checks={"ge": 1}, severity="warning")}


@query("check_warn_only", " union all ".join([_check("kind", "c_acctbal", "false", "customer"), _check("ge", "c_acctbal", "c_acctbal<1", "customer", "warning")]))
def _(v: Views) -> DataFrame:
    return contracts.violations(v.table("customer"), _WARN)


_SPEC = {"c_name": contracts.Field("string", nullable=False, checks={"str_length": (1, 10)}), "c_nationkey": contracts.Field("int", checks={"isin": (1, 2, 3), "gt": 0})}


@query("compile_contract", " union all ".join([_check("kind", "c_name", "false", "customer"), _check("not_null", "c_name", "c_name is null", "customer"), _check("str_length", "c_name", "length(c_name) not between 1 and 10", "customer"), _check("kind", "c_nationkey", "false", "customer"), _check("isin", "c_nationkey", "c_nationkey not in (1,2,3)", "customer"), _check("gt", "c_nationkey", "c_nationkey<=0", "customer")]))
def _(v: Views) -> DataFrame:
    return contracts.violations(v.table("customer"), _SPEC)


_DATASET = {"customer_key": contracts.Field("long", nullable=False), "balance": contracts.Field("double", required=False, checks={"ge": 0}), "segment": contracts.Field("string", required=False), "note": contracts.Field("string", required=False)}


@query("validate_dataset", "select 'passed_with_soft_errors' as status, '' as extra, '' as missing_required, 'note' as missing_optional, '' as failed_required, case when (select count(*) from customer where c_acctbal<0)>0 then 'balance' else '' end as failed_optional")
def _(v: Views) -> DataFrame:
    return contracts.validate_dataset(v.table("customer").select(F.col("c_custkey").alias("Customer-Key"), F.col("c_acctbal").alias("Balance"), F.col("c_mktsegment").alias("Segment")), _DATASET)


@query("infer_contract", "select 'c_custkey' as \"column\", 'float64' as kind, count(*) filter (where c_custkey is null)>0 as nullable, cast(null as varchar) as categories from customer union all select 'c_mktsegment', 'category', count(*) filter (where c_mktsegment is null)>0, string_agg(distinct c_mktsegment, ',' order by c_mktsegment) from customer union all select 'c_name', 'string', false, null")
def _(v: Views) -> DataFrame:
    return contracts.infer_contract(v.table("customer").select("c_custkey", "c_mktsegment", "c_name"))


def _stats(c: str, t: str) -> str:
    return f"select '{c}' as \"column\", count({c}) as n, count(*)-count({c}) as nulls, count(*) filter (where {c}=0) as zeros, count(distinct {c}) as n_distinct, r(avg({c})) as mean, r(stddev_samp({c})) as sd, r(min({c})) as low, r(max({c})) as high from {t}"


@query("profile_stats", " union all ".join([_stats("c_custkey", "customer"), _stats("c_acctbal", "customer"), "select 'c_name', count(c_name), count(*)-count(c_name), 0, count(distinct c_name), null, null, null, null from customer"]))
def _(v: Views) -> DataFrame:
    return contracts.profile(v.table("customer").select("c_custkey", "c_acctbal", "c_name"))


@query("profile_anomalies", "select * from (select 'c_acctbal' as \"column\", case when min(c_acctbal)<0 then 'below range' when max(c_acctbal)>5000 then 'above range' end as reason from customer) where reason is not null")
def _(v: Views) -> DataFrame:
    limits = v.spark.createDataFrame([("c_acctbal", 0.1, 0.0, 5000.0), ("c_custkey", 0.0, 0.0, 1e12)], "column string, max_null_share double, low double, high double")
    return contracts.anomalies(contracts.profile(v.table("customer").select("c_custkey", "c_acctbal")), limits)


@query("validate_output", "select count(*) as n_rows, count(student_id)-count(distinct student_id) as repeated_ids, count(*) filter (where abs(pred_prob-0.5)<abs(pred_prob-0.4)) as out_of_order, 0 as nan_rows from v_pred")
def _(v: Views) -> DataFrame:
    return contracts.validate_output(v.pred().select("student_id", (F.col("pred_prob") - 0.5).alias("a"), (F.col("pred_prob") - 0.4).alias("b")), importances=["a", "b"])


# --- descriptions ---------------------------------------------------------------------------


@query("value_counts", "select delivery_method, core_course, count(*) as count, round_even(100.0*count(*)/sum(count(*)) over (), 1) as pct from v_course group by 1, 2")
def _(v: Views) -> DataFrame:
    return eda.value_counts(v.course(), ["delivery_method", "core_course"])


@query("crosstab", "select coalesce(gender,'All') as \"row\", coalesce(enrollment_type,'All') as col, count(*) as value from v_cohort group by cube(gender, enrollment_type)")
def _(v: Views) -> DataFrame:
    return eda.crosstab(v.cohort(), "gender", "enrollment_type", margins=True)


@query("describe_columns", "select 'gpa_group_term_1' as \"column\", count(gpa_group_term_1) as count, r(avg(gpa_group_term_1)) as mean, r(stddev_samp(gpa_group_term_1)) as sd, r(min(gpa_group_term_1)) as min, r(quantile_cont(gpa_group_term_1,0.25)) as p25, r(quantile_cont(gpa_group_term_1,0.5)) as p50, r(quantile_cont(gpa_group_term_1,0.75)) as p75, r(max(gpa_group_term_1)) as max, count(*)-count(gpa_group_term_1) as null_count, r(100.0*(count(*)-count(gpa_group_term_1))/count(*)) as null_pct from v_cohort")
def _(v: Views) -> DataFrame:
    return eda.describe_columns(v.cohort(), ["gpa_group_term_1"])


@query("unique_values", "select count(*) as n_unique, cast(sum(n-1) as bigint) as n_duplicates, cast(sum(z) as bigint) as n_null from (select count(*) n, count(*) filter (where course_prefix is null or course_number is null) z from v_course group by course_prefix, course_number)")
def _(v: Views) -> DataFrame:
    return eda.unique_values(v.course(), ["course_prefix", "course_number"])


@query("single_value_columns", "select 'institution_id' as \"column\" from v_cohort having count(distinct institution_id)=1")
def _(v: Views) -> DataFrame:
    return eda.single_value_columns(v.cohort().select("institution_id", "gender", "race"))


@query("null_fractions", "select 'course_number' as \"column\", r(avg(cast(course_number is null as int))) as fraction from v_course union all select 'grade', r(avg(cast(grade is null as int))) from v_course")
def _(v: Views) -> DataFrame:
    return eda.null_fractions(v.course().select("course_number", "grade"))


@query("range_summary", "select count(distinct academic_year) as n, min(academic_year) as low, max(academic_year) as high from v_course")
def _(v: Views) -> DataFrame:
    return v.course().agg(F.countDistinct("academic_year").alias("n"), F.min("academic_year").alias("low"), F.max("academic_year").alias("high"))


@query("students_all_null_courses", "select student_id, count(*) as n from v_course group by 1 having count(course_number)=0")
def _(v: Views) -> DataFrame:
    return v.course().groupBy("student_id").agg(F.count("*").alias("n"), F.count("course_number").alias("k")).where("k = 0").drop("k")


@query("pre_cohort_students", "select c.student_id, bool_or(cohort>academic_year) as any_before, count(*) filter (where cohort>academic_year) as n from v_course c join v_cohort h on c.student_id=h.student_id group by 1")
def _(v: Views) -> DataFrame:
    before = F.col("cohort") > F.col("academic_year")
    return v.course().select("student_id", "academic_year").join(v.cohort().select("student_id", "cohort"), "student_id").groupBy("student_id").agg(F.bool_or(before).alias("any_before"), F.count_if(before).alias("n"))


@query("grouped_mean", "select cohort, enrollment_type, r(avg(gpa_group_year_1)) as gpa from v_cohort group by 1, 2")
def _(v: Views) -> DataFrame:
    return v.cohort().groupBy("cohort", "enrollment_type").agg(F.avg("gpa_group_year_1").alias("gpa"))


@query("pct_credits_by_year", "select academic_year, r(avg(100*number_of_credits_earned/number_of_credits_attempted)) as mean, r(median(100*number_of_credits_earned/number_of_credits_attempted)) as median from v_course group by 1")
def _(v: Views) -> DataFrame:
    pct = 100 * F.try_divide("number_of_credits_earned", "number_of_credits_attempted")
    return v.course().groupBy("academic_year").agg(F.avg(pct).alias("mean"), F.median(pct).alias("median"))


@query("courses_per_student_hist", "select enrollment_intensity_first_term, r(floor(n/5)*5) as bin, count(*) as students from (select student_id, count(*) n from v_course group by 1) a join v_cohort using (student_id) group by 1, 2")
def _(v: Views) -> DataFrame:
    n = v.course().groupBy("student_id").agg(F.count("*").alias("n"))
    return n.join(v.cohort(), "student_id").groupBy("enrollment_intensity_first_term", eda.histogram(F.col("n"), 5).alias("bin")).agg(F.count("*").alias("students"))


@query("grade_histogram", "select delivery_method, r(floor(coalesce(try_cast(grade as double), case grade when 'A' then 4 when 'F' then 0 end))) as bin, count(*) as n from v_course group by 1, 2")
def _(v: Views) -> DataFrame:
    g = F.coalesce(F.col("grade").try_cast("double"), F.when(F.col("grade") == "A", 4.0).when(F.col("grade") == "F", 0.0))
    return v.course().groupBy("delivery_method", eda.histogram(g, 1).alias("bin")).agg(F.count("*").alias("n"))


@query("distinct_courses", "select count(distinct course_prefix||course_number) as courses, count(distinct course_cip) as cips from v_course")
def _(v: Views) -> DataFrame:
    return v.course().agg(F.countDistinct(F.concat("course_prefix", "course_number")).alias("courses"), F.countDistinct("course_cip").alias("cips"))


@query("credits_per_student", "select r(floor(a/10)*10) as attempted, r(floor(e/10)*10) as earned, count(*) as n from (select sum(number_of_credits_attempted) a, sum(number_of_credits_earned) e from v_course group by student_id) group by 1, 2")
def _(v: Views) -> DataFrame:
    s = v.course().groupBy("student_id").agg(F.sum("number_of_credits_attempted").alias("a"), F.sum("number_of_credits_earned").alias("e"))
    return s.groupBy(eda.histogram(F.col("a"), 10).alias("attempted"), eda.histogram(F.col("e"), 10).alias("earned")).agg(F.count("*").alias("n"))


@query("grouped_value_shares", "select delivery_method, core_course, count(*) as n, r(count(*)/sum(count(*)) over (partition by delivery_method)) as share from v_course group by 1, 2")
def _(v: Views) -> DataFrame:
    from pyspark.sql import Window

    n = v.course().groupBy("delivery_method", "core_course").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("delivery_method")))


# --- associations ---------------------------------------------------------------------------

_V = "select r(case when least(r,c)>1 then sqrt(greatest(n*(q-1),0)/n/(least(r,c)-1)) end) as value from (select sum(n) n, sum(n*n/(ra*cb)) q, count(distinct a) r, count(distinct b) c from (select a, b, cast(count(*) as double) n, sum(count(*)) over (partition by a) ra, sum(count(*)) over (partition by b) cb from (select {a} a, {b} b from {t} where {a} is not null and {b} is not null) group by 1, 2))"
_BOTH = "(select {a} a, {b} b from {t} where {a} is not null and {b} is not null)"
_ETA = f"select r(sqrt(sum(n*(m-g)*(m-g))/any_value(t))) as value from (select a, count(*) n, avg(b) m from {_BOTH} group by 1), (select avg(b) g, sum((b-z)*(b-z)) t from {_BOTH}, (select avg(b) z from {_BOTH}))"
_RHO = "select r(corr(x, y)) as value from (select rank() over (order by a)+(count(*) over (partition by a)-1)/2.0 x, rank() over (order by b)+(count(*) over (partition by b)-1)/2.0 y from (select {a} a, {b} b from {t} where {a} is not null and {b} is not null))"


@query("cramers_v", _V.format(a="delivery_method", b="core_course", t="v_course"))
def _(v: Views) -> DataFrame:
    return eda.cramers_v(v.course(), "delivery_method", "core_course")


@query("correlation_ratio", _ETA.format(a="enrollment_type", b="gpa_group_year_1", t="v_cohort"))
def _(v: Views) -> DataFrame:
    return eda.correlation_ratio(v.cohort(), "enrollment_type", "gpa_group_year_1")


@query("spearman", _RHO.format(a="gpa_group_term_1", b="gpa_group_year_1", t="v_cohort"))
def _(v: Views) -> DataFrame:
    return eda.spearman(v.cohort(), "gpa_group_term_1", "gpa_group_year_1")


def _named(a: str, b: str, body: str) -> str:
    return f"select '{a}' as col1, '{b}' as col2, value from ({body})"


_PAIRS = [_named(c, c, "select 1.0 as value") for c in ("enrollment_type", "gender", "gpa_group_year_1")]
_PAIRS += [_named("enrollment_type", "gender", _V.format(a="enrollment_type", b="gender", t="v_cohort")), _named("enrollment_type", "gpa_group_year_1", _ETA.format(a="enrollment_type", b="gpa_group_year_1", t="v_cohort")), _named("gender", "gpa_group_year_1", _ETA.format(a="gender", b="gpa_group_year_1", t="v_cohort"))]


@query("pairwise_associations", " union all ".join(_PAIRS))
def _(v: Views) -> DataFrame:
    return eda.pairwise_associations(v.cohort(), ["enrollment_type", "gender", "gpa_group_year_1"])


_RANKED = ["enrollment_type", "enrollment_intensity_first_term", "gender", "race", "program_of_study_term_1", "pell_status_first_year", "gpa_group_year_1"]
_RANKED_PAIRS = [_named(a, b, (_ETA if b == "gpa_group_year_1" else _V).format(a=a, b=b, t="v_cohort")) for k, a in enumerate(_RANKED) for b in _RANKED[k + 1 :]]


@query("top_bottom_correlations", f"select which, col1, col2, r(value) as value from (select *, unnest(case when hi<=10 and lo<=10 then ['high','low'] when hi<=10 then ['high'] when lo<=10 then ['low'] end) which from (select *, row_number() over (order by value desc, col1, col2) hi, row_number() over (order by value, col1, col2) lo from ({' union all '.join(_RANKED_PAIRS)}) where value is not null))")
def _(v: Views) -> DataFrame:
    return eda.top_bottom(eda.pairwise_associations(v.cohort(), _RANKED))


# --- labels ---------------------------------------------------------------------------------

_INTENSITY = "student_term_enrollment_intensity"
LIMITS = {"FULL-TIME": (2.0, "year"), "*": (3.0, "year")}
_CKPT = "select * from (select *, row_number() over (partition by student_id order by term_rank) rn from cum) where rn=1"
_ALLOWED = "case when {c}='FULL-TIME' then 8 else 12 end"
_BY_TERM = f"select distinct student_id from ({_CKPT}) where term_rank+{_ALLOWED.format(c='student_term_enrollment_intensity')}<=(select max(term_rank) from cum)"
_BY_YEAR = "select student_id from cum group by 1 having min(cast(substr(cohort_id,1,4) as int))<(select max(cast(substr(term_id,1,4) as int)) from cum)"


@query("labelable_by_term", _BY_TERM)
def _(v: Views) -> DataFrame:
    d = v.written_cum("student_id", "term_rank", _INTENSITY)
    return targets.labelable_by_term(d, selection.first_terms(d), LIMITS)


@query("labelable_by_year", _BY_YEAR)
def _(v: Views) -> DataFrame:
    return targets.labelable_by_year(v.written_cum("student_id", "term_id", "cohort_id"))


_YEARS = "first_year_to_bachelors_at_cohort_inst"


@query("target_graduation", f"""select y.student_id, y.yrs is null or coalesce(y.yrs>({_ALLOWED.format(c='m.i')})/4.0,false) as target from (select student_id, any_value({_YEARS}) yrs from cum group by 1) y
    left join (select student_id, i from (select student_id, student_term_enrollment_intensity i, row_number() over (partition by student_id order by count(*) desc, student_term_enrollment_intensity) rn from cum where {_YEARS} is null or year_of_enrollment_at_cohort_inst<={_YEARS} group by 1, 2) where rn=1) m on y.student_id=m.student_id
    where y.student_id in ({_BY_TERM})""")
def _(v: Views) -> DataFrame:
    d = v.written_cum("student_id", "term_rank", _INTENSITY, "year_of_enrollment_at_cohort_inst", _YEARS)
    return targets.target_graduation(d, selection.first_terms(d), LIMITS, years_col=_YEARS)


_JOINED = f"select k.student_id, k.student_term_enrollment_intensity intensity_ckpt, k.term_rank rank_ckpt, t.rank_tgt from ({_CKPT}) k left join (select student_id, min(term_rank) rank_tgt from cum where cumsum_num_credits_earned>=30 group by 1) t on k.student_id=t.student_id"


@query("join_checkpoint_target", _JOINED)
def _(v: Views) -> DataFrame:
    d = v.written_cum("student_id", "term_rank", _INTENSITY, "cumsum_num_credits_earned")
    return targets.join_checkpoint_target(selection.first_terms(d), selection.first_terms_at_credits(d, 30))


_CREDITS = f"select student_id, rank_tgt is null or rank_tgt-rank_ckpt>{_ALLOWED.format(c='intensity_ckpt')} as target from ({_JOINED}) where student_id in ({_BY_TERM})"


@query("target_credits", _CREDITS)
def _(v: Views) -> DataFrame:
    d = v.written_cum("student_id", "term_rank", _INTENSITY, "cumsum_num_credits_earned")
    return targets.target_credits(d, selection.first_terms(d), LIMITS, min_credits=30)


@query("target_retention", f"select student_id, not any_value(retention) as target from cum where retention is not null and student_id in ({_BY_YEAR}) group by 1")
def _(v: Views) -> DataFrame:
    return targets.target_retention(v.written_cum("student_id", "term_id", "cohort_id", "retention"))


#: What labels and masks are made of.
_LABEL_COLUMNS = ["student_id", "term_id", "term_rank", "term_is_core", "term_is_pre_cohort", "student_term_enrollment_intensity", "cumsum_num_credits_earned", "cumnum_terms_enrolled", "year_of_enrollment_at_cohort_inst"]


def labeled(v: Views, features: list[str]) -> DataFrame:
    """Students' first terms with these features and the label; null where a student could not have a value yet."""
    terms = v.cum().select(*dict.fromkeys([*_LABEL_COLUMNS, *features]))
    d = readers.read_table(v.spark, writers.scratch_parquet(terms), format="parquet")  # read three times below
    rows = selection.first_terms(d).join(selection.select_students(v.cohort(), enrollment_type=["FIRST-TIME", "RE-ADMIT"]).select("student_id"), "student_id", "left_semi")
    return rows.join(targets.target_credits(d, selection.first_terms(d), LIMITS, min_credits=30), "student_id")


_LABELED = f"select k.student_id, k.num_courses, t.target from ({_CKPT}) k join ({_CREDITS}) t on k.student_id=t.student_id where enrollment_type in ('FIRST-TIME','RE-ADMIT')"
query("join_labels", _LABELED)(lambda v: labeled(v, ["num_courses"]).select("student_id", "num_courses", "target"))
query("dataset_labeled", _LABELED.replace("k.num_courses, t.target", "k.num_courses, r(case when k.year_of_enrollment_at_cohort_inst>1 then k.gpa_group_year_1 end) as gpa_group_year_1, t.target"))(lambda v: null_future_values(labeled(v, ["num_courses", "gpa_group_year_1"])).select("student_id", "num_courses", "gpa_group_year_1", "target"))

# --- sources and sinks ----------------------------------------------------------------------


@query("src_table", "select r_regionkey, r_name from region")
def _(v: Views) -> DataFrame:
    return readers.read_table(v.spark, f"{v.dir}/region.parquet", format="parquet")


@query("src_csv", "select cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation")
def _(v: Views) -> DataFrame:
    return readers.read_csv(v.spark, writers.scratch_csv(v.table("nation")))


@query("src_raw_course", "select o_orderkey, upper(o_orderpriority) as academic_term, cast(o_orderdate as date) as course_begin_date from orders")
def _(v: Views) -> DataFrame:
    raw = v.table("orders").select("o_orderkey", F.lower("o_orderpriority").alias("AcademicTerm"), F.date_format("o_orderdate", "yyyyMMdd").alias("CourseBeginDate"))
    return readers.standard_course(raw).withColumn("course_begin_date", F.to_date("course_begin_date"))


@query("src_raw_cohort", "select student_id, cohort_term, nullif(gender,'UK') as gpa_group_term_1, retention from v_cohort")
def _(v: Views) -> DataFrame:
    raw = v.cohort().select("student_id", F.lower("cohort_term").alias("CohortTerm"), F.col("gender").alias("GPAGroupTerm1"), F.col("retention").cast("string").alias("Retention"))
    return readers.standard_cohort(raw)


@query("src_course_date_fallback", "select o_orderkey, cast(o_orderdate as date) as d from orders")
def _(v: Views) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd.0")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return v.table("orders").select("o_orderkey", readers.course_date(text).cast("date").alias("d"))


_PRED = "select student_id, target, r(pred_prob) as pred_prob, pred, priority, region, split from v_pred"


@query("src_training_parquet", _PRED)
def _(v: Views) -> DataFrame:
    return readers.read_table(v.spark, writers.scratch_parquet(v.pred()), format="parquet")


@query("sink_table", "select n_nationkey, n_name, n_regionkey from nation")
def _(v: Views) -> DataFrame:
    return writers.write_table(v.table("nation"), writers.scratch_name("nation"))


@query("sink_verify", _soiled_sql(contract_sql.COHORT, "(select c_custkey k from customer)"))
def _(v: Views) -> DataFrame:
    rows = _soiled(v, contract_sql.COHORT, v.table("customer").select(F.col("c_custkey").alias("k")))
    return writers.verify_table(writers.write_table(rows, writers.scratch_name("cohort")), contracts.COHORT)


@query("sink_single_csv", "select cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation")
def _(v: Views) -> DataFrame:
    return readers.read_csv(v.spark, writers.write_single_csv(v.table("nation")))


_CELLS = "(select count(*) filter (where target and pred)*1.0 tp, count(*) filter (where not target and pred)*1.0 fp, count(*) filter (where target and not pred)*1.0 fn, count(*) filter (where not target and not pred)*1.0 tn from v_pred)"
_POINTS = """(select s, round_even(tp*1.0/(tp0+tp1),4) tpr, round_even(fp*1.0/(fp0+fp1),4) fpr from (select s, count(*) filter (where target and pred_prob>=s) tp, count(*) filter (where target and pred_prob<s) tp1, count(*) filter (where not target and pred_prob>=s) fp, count(*) filter (where not target and pred_prob<s) fp1,
    count(*) filter (where target and pred_prob>=s) tp0, count(*) filter (where not target and pred_prob>=s) fp0 from (select distinct round_even(pred_prob,4) s from v_pred) cross join v_pred group by 1))"""
_SIDES = {"true_positive": "tp/(tp+fn)", "false_positive": "fp/(fp+tn)", "true_negative": "tn/(tn+fp)", "false_negative": "fn/(fn+tp)"}


@query("sink_metric_tables", " union all ".join([f"select s as threshold, '{c}' as name, {c} as value from {_POINTS}" for c in ("tpr", "fpr")] + [f"select null, '{n}', r({t}) from {_CELLS}" for n, t in _SIDES.items()]))
def _(v: Views) -> DataFrame:
    """Both tables of a model's metrics, written and read back as one."""
    matrix = writers.write_table(evaluation.confusion_matrix(v.pred()), writers.scratch_name("confusion"))
    curve = writers.write_table(evaluation.roc_curve(v.pred()), writers.scratch_name("roc"))
    rates = matrix.unpivot([], list(matrix.columns), "name", "value")
    return curve.unpivot("threshold", ["tpr", "fpr"], "name", "value").unionByName(rates.withColumn("threshold", F.lit(None).cast("double")))


_EVERY = "(select " + ", ".join(f"{text} as {name}" for name, text in WHOLE.items()) + " from cum)"
_KNOWN = "(select count(*) n_rows, " + ", ".join(f"count({c}) n_{c}" for c in WHOLE) + f" from {_EVERY})"


#: What the catalog's patterns say of the columns of one subject area.
_AREA_NAMES = {
    "num_courses_course_subject_area_13": ("number of courses this term: subject area 13", "Its number of courses in the term", "How many courses of it the student took in this term; sections of one course count each."),
    "frac_courses_course_subject_area_13": ("fraction of courses this term: subject area 13", "Its share of the courses of the term", "Courses of it in this term, divided by all of the student's courses in the term; 1 means all of them."),
    "cumfrac_num_courses_course_subject_area_13": ("fraction of courses so far: subject area 13", "Its share of the courses up to the term", "Courses of it up to and with this term, divided by all of the student's courses up to then."),
    "took_course_subject_area_13": ("took subject area 13 this term", "Whether a course of it was taken in the term", "1 if the student took at least one in this term, else 0."),
    "cummax_took_course_subject_area_13": ("took subject area 13 so far", "Whether a course of it was taken up to the term", "1 from the first term on in which the student took one, 0 before."),
    "took_course_subject_area_13_in_12_creds": ("took subject area 13 within the first 12 credits", "Whether a course of it was taken within the student's first 12 credits", "1 if the student took one before more than 12 credits were earned, else 0; the same in all terms of a student."),
}


def _said(c: str) -> str:
    name, short, long = (_AREA_NAMES[c][0], f"{_AREA_NAMES[c][1]}: course subject area that the name gives", _AREA_NAMES[c][2]) if c in _AREA_NAMES else catalog.describe(c)
    return ", ".join(f"'{k}': '" + v.replace("'", "''") + "'" for k, v in (("feature", c), ("readable", name), ("short_desc", short), ("long_desc", long)))


@query("src_feature_names", "select unnest([" + ", ".join(f"{{{_said(c)}, 'n_known': n_{c}, 'n_rows': n_rows}}" for c in WHOLE) + f"], recursive := true) from {_KNOWN}")
def _(v: Views) -> DataFrame:
    """Readable names and descriptions of all features, from a catalog in a file, and how many rows have them."""
    d = student_terms.student_term_dataset(v.cohort(), v.course(), key_areas=["13"])
    path = catalog.write_catalog(v.spark, catalog.catalog_rows(d.columns))
    return catalog.feature_coverage(d, catalog.read_catalog(v.spark, path))


@query("converter_hook", "select student_id, upper(gender) as gender from v_cohort")
def _(v: Views) -> DataFrame:
    return readers.convert(v.cohort().select("student_id", "gender"), lambda d: d.withColumn("gender", F.upper("gender")))
