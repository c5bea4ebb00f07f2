"""Student-shaped views of the star-schema tables; the text runs unchanged in Spark SQL and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_YEAR = "case when month({d})>=9 then concat(cast(year({d}) as string),'-',substr(cast(year({d})+1 as string),3,2)) else concat(cast(year({d})-1 as string),'-',substr(cast(year({d}) as string),3,2)) end"
_TERM = "case when month({d})>=9 then 'FALL' when month({d})=1 then 'WINTER' when month({d})<=5 then 'SPRING' else 'SUMMER' end"

COURSE = f"""
select cast(o.o_custkey as string) student_id, '1' institution_id, {_YEAR.format(d="o_orderdate")} academic_year, {_TERM.format(d="o_orderdate")} academic_term,
 substr(upper(p_type),1,4) course_prefix, case when p.p_partkey%97=0 then null else cast(100*(p_size%5)+p.p_partkey%100 as string) end course_number,
 cast(l_suppkey%3 as string) section_id, concat(cast(10+p.p_partkey%40 as string),'.',cast(1000+p_size as string)) course_cip,
 case when l_returnflag='R' and l_linenumber=7 then 'W' when l_returnflag='A' and l_linenumber=7 then 'P' when l_linenumber=6 and l_returnflag='N' then 'F' when l_linenumber=6 and l_returnflag='A' then 'I' else cast(cast(l_discount*400 as int)/10.0 as decimal(3,1)) || '' end grade,
 cast(l_quantity%4+1 as double) number_of_credits_attempted, case when l_discount>=0.03 then cast(l_quantity%4+1 as double) else 0.0 end number_of_credits_earned,
 case p_size%3 when 0 then 'F' when 1 then 'O' else 'H' end delivery_method, case when l_linestatus='O' then 'Y' else 'N' end core_course, l_orderkey, l_linenumber
from lineitem l join orders o on l.l_orderkey=o.o_orderkey join part p on l.l_partkey=p.p_partkey
"""

COHORT = f"""
select cast(c.c_custkey as string) student_id, '1' institution_id, {_YEAR.format(d="o.o_orderdate")} cohort, {_TERM.format(d="o.o_orderdate")} cohort_term,
 case c.c_mktsegment when 'HOUSEHOLD' then 'RE-ADMIT' when 'BUILDING' then 'TRANSFER-IN' when 'AUTOMOBILE' then 'TRANSFER-IN' else 'FIRST-TIME' end enrollment_type,
 case when c.c_acctbal>4500 then 'FULL-TIME' else 'PART-TIME' end enrollment_intensity_first_term,
 case when c.c_nationkey%3=0 then 'M' when c.c_nationkey%3=1 then 'F' else 'UK' end gender, cast(c.c_nationkey%5 as string) race,
 concat(cast(10+c.c_custkey%40 as string),'.0101') program_of_study_term_1, concat(cast(10+c.c_custkey%37 as string),'.0101') program_of_study_year_1,
 case when c.c_acctbal<0 then null else c.c_acctbal/2500.0 end gpa_group_term_1, case when c.c_acctbal>9000 then null else (c.c_acctbal+1000)/2750.0 end gpa_group_year_1,
 case when c.c_custkey%7=0 then null when c.c_custkey%2=0 then 'Y' else 'N' end pell_status_first_year,
 c.c_acctbal>0 retention, case when c.c_custkey%3=0 then null else 3+c.c_custkey%5 end first_year_to_bachelors_at_cohort_inst
from customer c join (select o_custkey,o_orderdate,row_number() over (partition by o_custkey order by o_orderdate,o_orderkey) rn, count(*) over (partition by o_custkey) n from orders) o
 on o.o_custkey=c.c_custkey and o.rn = case when c.c_custkey%4=0 and o.n>1 then 2 else 1 end
"""

PREDICTIONS = """
select cast(o.o_orderkey as string) student_id, o.o_orderstatus='F' target, ((o.o_orderkey*7919)%1000003)/cast(1000003 as double) pred_prob, ((o.o_orderkey*7919)%1000003)>=500002 pred,
 o.o_orderpriority priority, r.r_name region, case o.o_orderkey%5 when 0 then 'test' when 1 then 'validate' else 'train' end split
from orders o join customer c on o.o_custkey=c.c_custkey join nation n on c.c_nationkey=n.n_nationkey join region r on n.n_regionkey=r.r_regionkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(text: str, *names: str):
    """A function that runs the text over the named tables, without registering anything in the session."""
    for n in names:
        text = re.sub(rf"\b(from|join) {n}\b", rf"\1 {{{n}}}", text)

    def make(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})

    return make


course = _view(COURSE, "lineitem", "orders", "part")
cohort = _view(COHORT, "customer", "orders")
predictions = _view(PREDICTIONS, "orders", "customer", "nation", "region")
