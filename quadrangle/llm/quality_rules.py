"""Quality rules: base checks, and learned decision lists as Spark conditional expressions.

All statistics are built-in column expressions. A decision list is learned by
sequential covering on a bounded sample of labelled statistics: rules for bad
texts are grown condition by condition on two thirds of it, pruned on the rest,
and stop when a rule is no longer precise there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrangle.llm.common import UPPER, WORD

#: Fixed values of the contract.
SPACE, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
STATISTICS = ["n_words", "mean_word", "symbols", "duplicate_lines", "repeats", "upper", "exclaims", "digits", "distinct", "line_words", "stops"]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def text_statistics(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 5) -> DataFrame:
    """One row per input row: id_col, the base counts of the contract, and the ratios in STATISTICS.

    Null counts as empty: all counts 0. Windows are compared by 64-bit hashes of
    their words. Only texts in which a window occurs twice are sorted. Write the
    result before filtering on it: Spark would push the filter, and with it the
    whole computation, below the steps made here.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = df.select(F.col(id_col), text.alias("text")).withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    n = F.size("words")

    def gram(i: Column) -> Column:
        return F.xxhash64(*[F.get("words", i + k) for k in range(window)])

    grams = F.when(n >= window, F.transform(F.sequence(F.lit(0), n - window), gram)).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    letters = F.length(_without(F.col("text"), SPACE))
    d = d.select(
        id_col,
        n.cast("long").alias("n_words"),
        letters.cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        grams.alias("grams"),
        (F.length("text") - F.length(_without(F.col("text"), UPPER))).alias("n_upper"),
        (F.length("text") - F.length(_without(F.col("text"), "!"))).alias("n_exclaim"),
        (F.length("text") - F.length(_without(F.col("text"), "0123456789"))).alias("n_digit"),
        (F.length("text") - F.length(_without(F.col("text"), ".,"))).alias("n_stop"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
    )
    twice = F.size(F.array_distinct("grams")) < F.size("grams")
    placed = F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    d = d.withColumn("n_lines", F.size("lines")).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    d = d.withColumn("sorted", F.when(twice, F.sort_array(placed))).drop("lines", "grams")

    def has_twin(e: Column, k: Column) -> Column:
        last, following = F.get(F.col("sorted"), k - 1)["g"], F.get(F.col("sorted"), k + 1)["g"]
        return F.coalesce(e["g"] == last, F.lit(False)) | F.coalesce(e["g"] == following, F.lit(False))

    d = d.withColumn("starts", F.sort_array(F.transform(F.filter("sorted", has_twin), lambda e: e["i"]))).drop("sorted")
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(-window).alias("prev"), F.lit(0).cast("long").alias("total")),
        lambda acc, x: F.struct(x.alias("prev"), (acc["total"] + F.least(F.lit(window), x - acc["prev"])).alias("total")),
        lambda acc: acc["total"],
    )
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("starts")

    def per(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return d.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        per("word_chars", "n_words").alias("mean_word"), per("n_symbols", "word_chars").alias("symbols"), per("n_dup_lines", "n_lines").alias("duplicate_lines"),
        per("n_repeat_words", "n_words").alias("repeats"), per("n_upper", "word_chars").alias("upper"), per("n_exclaim", "word_chars").alias("exclaims"),
        per("n_digit", "word_chars").alias("digits"), per("n_distinct", "n_words").alias("distinct"), per("n_words", "n_lines").alias("line_words"), per("n_stop", "n_words").alias("stops"),
    )


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return F.col(self.name) > self.threshold if self.above else F.col(self.name) <= self.threshold

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.name)]
        return v > self.threshold if self.above else v <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def learn_rules(x: np.ndarray, bad: np.ndarray, names: list[str], *, precision: float = 0.97, least: int = 5, conditions: int = 3, cuts: int = 48, rules: int = 12) -> list[Rule]:
    """Ordered conjunctions that single out bad rows; rows x statistics, bad as booleans. Every third row prunes."""
    prune = np.arange(len(x)) % 3 == 2
    gx, gy, px, py = x[~prune], bad[~prune], x[prune], bad[prune]
    found: list[Rule] = []
    while len(found) < rules and gy.sum() >= least:
        rule, live = (), np.ones(len(gx), bool)
        for _ in range(conditions):
            p0, n0 = gy[live].sum(), (~gy[live]).sum()
            if not n0:
                break
            best, choice = 1e-9, None
            for j, name in enumerate(names):
                v = gx[live, j]
                for t in np.unique(np.quantile(np.concatenate([v, v[gy[live]]]), np.linspace(0, 1, cuts + 2)[1:-1])):
                    for above in (True, False):
                        hit = v > t if above else v <= t
                        p, n = gy[live][hit].sum(), (~gy[live][hit]).sum()
                        if p < least:
                            continue
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best:
                            best, choice = gain, Condition(name, above, float(t))
            if choice is None:
                break
            rule, live = (*rule, choice), live & choice.holds(gx, names)
        if not rule:
            break

        def worth(r: Rule) -> float:
            hit = _covers(r, px, names)
            p, n = py[hit].sum(), (~py[hit]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        hit = _covers(rule, px, names)
        if not py[hit].sum() or py[hit].mean() < precision:
            break
        found.append(rule)
        keep_g, keep_p = ~_covers(rule, gx, names), ~hit
        gx, gy, px, py = gx[keep_g], gy[keep_g], px[keep_p], py[keep_p]
    return found


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: false at the first rule that holds, else true."""
    out = None
    for rule in rules:
        cond = F.lit(True)
        for c in rule:
            cond = cond & c.column()
        out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def fit_rules(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 8_000, **parameters) -> list[Rule]:
    """Rules learned from at most about `sample` labelled documents (label 0: bad) that pass the base checks.

    Only their statistics reach the driver. Without bad documents the list is empty.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    share = min(1.0, sample / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(13)), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = df.select(id_col, text_col).join(F.broadcast(chosen.select(id_col)), id_col, "left_semi")  # about `sample` ids
    rows = text_statistics(texts, id_col=id_col, text_col=text_col).join(F.broadcast(chosen), id_col).select("label", F.xxhash64(id_col).alias("h"), "n_repeat_words", *STATISTICS).collect()
    rows = [r for r in rows if not (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)]
    rows.sort(key=lambda r: (r.h, tuple(r)))
    x = np.array([[float(r[c]) for c in STATISTICS] for r in rows]).reshape(len(rows), len(STATISTICS))
    return learn_rules(x, np.array([r.label == 0 for r in rows], bool), STATISTICS, **parameters)


def judge(df: DataFrame, rules: list[Rule], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Null and empty texts have no words, so they fail the base checks; null and
    repeated ids are rows like others. Without rules, all that pass are kept.
    """
    s = text_statistics(df, id_col=id_col, text_col=text_col)
    return s.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))
