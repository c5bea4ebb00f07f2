"""Associations of many columns in one scan, catalogs, contracts that must notice a change, and wide terms."""

import dataclasses

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quadrangle.operators import contracts, eda, selection
from quadrangle.plans import contract_sql
from quadrangle.sources import catalog


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(3)
    n = 1500
    base = rng.normal(size=n)
    frame = pd.DataFrame({
        "a": base, "ties": np.round(base * 2 + rng.normal(size=n)), "holes": np.where(rng.random(n) < 0.3, np.nan, -base + rng.normal(size=n)), "rare": np.where(rng.random(n) < 0.97, np.nan, base), "flat": np.ones(n),
        "none": np.full(n, np.nan), "kind": rng.choice(["u", "v", "w"], n), "group": np.where(base > 0, "up", "down"), "gaps": np.where(rng.random(n) < 0.4, None, rng.choice(["p", "q"], n)), "one": ["same"] * n,
    })
    kinds = {c: "string" if frame[c].dtype == object or str(frame[c].dtype).startswith("str") else "double" for c in frame.columns}
    rows = [tuple(None if pd.isna(x) else x for x in r) for r in frame.itertuples(index=False)]
    return frame, spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in kinds.items())).repartition(5)


def test_rank_correlations_equal_pandas(mixed):
    """All pairs at once; ranks are taken within the rows where both are known."""
    frame, df = mixed
    cols = ["a", "ties", "holes", "rare", "flat", "none"]
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1 :]]
    got = {(r.col1, r.col2): r.value for r in eda.rank_correlations(df, pairs).collect()}
    want = frame[cols].astype(float).corr(method="spearman")
    assert set(got) == set(pairs)
    for x, y in pairs:
        assert got[x, y] is None if np.isnan(want.loc[x, y]) else got[x, y] == pytest.approx(want.loc[x, y], abs=1e-9), (x, y)
    assert eda.spearman(df, "holes", "rare").first().value == pytest.approx(want.loc["holes", "rare"], abs=1e-9)


def cramers(a: pd.Series, b: pd.Series) -> float | None:
    known = a.notna() & b.notna()
    t = pd.crosstab(a[known], b[known]).to_numpy(float)
    if min(t.shape, default=0) < 2:
        return None
    e = np.outer(t.sum(1), t.sum(0)) / t.sum()
    return float(np.sqrt(((t - e) ** 2 / e).sum() / t.sum() / (min(t.shape) - 1)))


def ratio(c: pd.Series, x: pd.Series) -> float | None:
    known = c.notna() & x.notna()
    c, x = c[known], x[known].astype(float)
    if c.nunique() < 2:
        return None
    between = sum(len(g) * (g.mean() - x.mean()) ** 2 for _, g in x.groupby(c))
    return float(np.sqrt(between / ((x - x.mean()) ** 2).sum())) if x.nunique() > 1 else 0.0


@pytest.mark.parametrize("held", [1_000_000, 3])
def test_all_pairs_in_one_scan(mixed, held, monkeypatch):
    """Also where tasks must send their cells early."""
    monkeypatch.setattr(eda, "HELD", held)
    frame, df = mixed
    made = eda.pairwise_associations(df)
    got = {(r.col1, r.col2): r.value for r in made.collect()}
    assert len(got) == 55
    text = {"kind", "group", "gaps", "one"}
    spear = frame[[c for c in frame if c not in text]].astype(float).corr(method="spearman")
    for (x, y), v in got.items():
        if x == y:
            want = 1.0
        elif x in text and y in text:
            want = cramers(frame[x], frame[y])
        elif x in text or y in text:
            want = ratio(frame[x], frame[y]) if x in text else ratio(frame[y], frame[x])
        else:
            want = None if np.isnan(spear.loc[x, y]) else spear.loc[x, y]
        assert v is None if want is None else v == pytest.approx(want, abs=1e-7), (x, y)
    assert {(r.col1, r.col2) for r in eda.pairwise_associations(df, ref_col="kind").collect()} == {p for p in got if "kind" in p}


def test_associations_of_no_rows(mixed):
    got = {(r.col1, r.col2): r.value for r in eda.pairwise_associations(mixed[1].where("false"), ["a", "ties", "kind", "group"]).collect()}
    assert len(got) == 10 and all((v == 1.0) == (x == y) for (x, y), v in got.items())


@pytest.mark.parametrize("name", ["COHORT", "COURSE", "STUDENT_TERM"])
def test_a_changed_rule_is_noticed(spark, name):
    """The rules written for SQL find each change of the contract: a bound, a value, a null, a kind, a column."""
    import duckdb

    contract, rules = getattr(contracts, name), getattr(contract_sql, name)
    rows = spark.sql(contract_sql.soiled(rules, "(select id as k from range(700))"))
    want = sorted(duckdb.sql(f"with rows as materialized ({contract_sql.soiled(rules, '(select range k from range(700))')}) {contract_sql.counted(rules, 'rows')}").fetchall())

    def said(c):
        return sorted((r["check"], r["column"], r["severity"], r["n_failed"]) for r in contracts.violations(rows, c).collect())

    assert said(contract) == want
    checked = {k: f for k, f in contract.items() if f.checks}
    some = [c for kind in ("isin", "in_range", "ge") for c in [k for k, f in checked.items() if kind in f.checks][:1]]
    for c in some:
        (kind, args), *_ = contract[c].checks.items()
        other = args[:-1] if kind == "isin" else (args[0], args[1] + 1) if kind == "in_range" else args + 1
        assert said(contract | {c: dataclasses.replace(contract[c], checks={kind: other})}) != want, c
    first = next(iter(contract))
    assert said(contract | {first: dataclasses.replace(contract[first], nullable=True)}) != want
    assert said({k: f for k, f in contract.items() if k != first}) != want
    assert said(contract | {"another": contracts.Field("string")}) != want


def test_catalog_of_a_file(spark):
    rows = [(0, "^took_(.*)_twice$", "took {} twice", "s1", None), (1, "Exact_Name", "an exact name", None, "l2"), (2, "^took_(.*)$", "took {}", "s3", "l3"), (3, "exact_name", "a later one", "s4", "l4"), (4, "^n_(a|b)$", "number of {}", None, None)]
    c = catalog.read_catalog(spark, catalog.write_catalog(spark, rows))
    names = ["exact_name", "EXACT_NAME", "took_math_twice", "Took_Art", "n_b", "n_c", None, "exact_name_more", "took_art"]
    df = spark.createDataFrame([(k, n, "old") for k, n in enumerate(names)], "k int, feature string, readable0 string")
    got = {r.k: (r.readable, r.short_desc, r.long_desc) for r in catalog.map_feature_names(df, c).collect()}
    assert got == {
        0: ("an exact name", None, "l2"), 1: ("an exact name", None, "l2"), 2: ("took math twice", "s1", None), 3: ("took art", "s3", "l3"), 4: ("number of b", None, None), 5: ("n_c", None, None),
        6: (None, None, None), 7: ("exact_name_more", None, None), 8: ("took art", "s3", "l3"),
    }
    assert catalog.map_feature_names(df.where("false"), c).count() == 0 and catalog.map_feature_names(df, c.where("false")).where("readable = 'n_b'").count() == 1


def test_every_column_has_a_name_and_descriptions():
    rows = catalog.catalog_rows(["num_courses", "num_courses_passed", "cumfrac_core_terms_enrolled", "took_course_id_engl_101", "num_credits_earned_diff_term_2_to_term_3", "GENDER"])
    by = {r[1]: r[2:] for r in rows}
    assert len([k for k in by if "(" in k]) == 14 and "took_course_id_engl_101" not in by and all(all(x) for x in by.values())
    assert by["num_courses_passed"][0] == "number of courses this term: passed" and by["cumfrac_core_terms_enrolled"][0] == "fraction of core terms enrolled so far"
    assert by["num_credits_earned_diff_term_2_to_term_3"][1] == "Difference between two of the student's first terms: num credits earned, term 2 to term 3" and "gender" in by


def test_wide_terms(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 2, 7), ("c", 9, 1)], "student_id string, cumnum_terms_enrolled int, n int")
    got = {tuple(r) for r in selection.pivot_terms(df, ["n"], [1, 2]).collect()}
    assert got == {("a", 5, 6), ("b", None, 7), ("c", None, None)}
    assert selection.pivot_terms(df.where(F.lit(False)), ["n"], [1]).columns == ["student_id", "n_term_1"]
