"""Personal data: base patterns, and candidates judged by boosted trees, all in column expressions.

Base spans come from fixed patterns. A wider pattern for each kind then proposes
candidates in the text without its base spans; boosted trees look at their
format and at what stands around them. The trees learn from base spans of a
bounded sample of documents, rewritten where they stand into forms that the base
patterns don't know, against decoys (digits that fail Luhn's check, dates,
prices, octets over 255) in the same places; per kind the threshold is the
lowest at which, on spans kept aside, nearly all that pass are true. Candidates
that pass are added.

Patterns are written without repeated groups: Java's matcher recurses on those,
and very long texts would exhaust the stack. Starts inside a run are ruled out,
so a long run is read once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrangle.llm import gbt
from quadrangle.llm.common import materialize

KINDS = ["email", "ip", "card", "phone"]

# Fixed values of the contract, each equal to its published pattern: leftmost, greedy, labels of a domain not empty.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}+@(?={_LABEL}+\.{_LABEL}){_LABEL}[A-Za-z0-9.-]*?(?=\.\.|\.?(?![A-Za-z0-9.-]))"
IP = r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Separators that stand between two digits only; all others are blotted out before digits are looked for.
LOOSE, DIGITS = r"(?<![0-9])[\x20-]|[\x20-](?![0-9])", r"[0-9][0-9\x20-]+"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"

#: High-recall generators, bounded in length.
_AT, _DOT = r"(?:@|[\[({<]\x20?at\x20?[\])}>])", r"(?:\.|[\[({<]\x20?dot\x20?[\])}>])"
HIDDEN = "\ufffc"
_OPEN, _CLOSE = rf"(?<![0-9A-Za-z{HIDDEN}])", rf"(?![0-9A-Za-z{HIDDEN}])"
_POINT = r"(?:\.|\x20\.\x20|\x20?[\[({<]\x20?(?:\.|dot)\x20?[\])}>]\x20?)"
WIDE_EMAIL = rf"(?i)(?<!{_LOCAL}|{HIDDEN}){_LOCAL}{{1,64}}\x20?{_AT}\x20?[a-z0-9-]{{1,63}}(?:\x20?{_DOT}\x20?[a-z0-9-]{{1,63}}){{1,5}}"
WIDE_IP = rf"(?i){_OPEN}[0-9]{{1,3}}{_POINT}[0-9]{{1,3}}{_POINT}[0-9]{{1,3}}{_POINT}[0-9]{{1,3}}{_CLOSE}"
WIDE_CARD = rf"{_OPEN}[0-9](?:[\x20./-]?[0-9]){{12,18}}{_CLOSE}"
WIDE_PHONE = rf"{_OPEN}[+(]?[0-9](?:[().\x20/-]{{0,2}}[0-9]){{6,14}}{_CLOSE}"
_NEAR = {"email": r"(?i)mail|contact|write", "ip": r"(?i)\bip\b|host|server|addr", "card": r"(?i)card|visa|credit|kart|tarjeta|carte", "phone": r"(?i)tel|phone|call|fax|mobil"}
FEATURES = ["kind", "length", "digits", "groups", "longest", "dots", "spaces", "hyphens", "parens", "slashes", "brackets", "luhn", "octets", "plus", "zeros", "letters", "joined", "named", "after_mark"]
_SPAN = "array<struct<start:int,end:int,text:string>>"


def spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, text) of the leftmost non-overlapping matches, in code points."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        end = start + F.length(x["hit"])
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("text"))).alias("out"))

    pairs = F.filter(F.arrays_zip(between.alias("before"), found.alias("hit")), lambda x: x["hit"].isNotNull())
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out")), step, lambda acc: acc["out"])


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""

    def value(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), value), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _none() -> Column:
    return F.array().cast(_SPAN)


def base_spans(df: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """id_col, text, and an array of spans for each kind; a kind that can't occur in a text is not looked for."""
    d = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    many = F.col("text").rlike(r"[0-9](?:[\x20-]?[0-9]){13}")
    d = d.select(
        id_col,
        "text",
        F.when(F.col("text").contains("@"), spans(F.col("text"), EMAIL)).otherwise(_none()).alias("email"),
        F.when(F.col("text").rlike(r"[0-9]\.[0-9]"), spans(F.col("text"), IP)).otherwise(_none()).alias("ip"),
        F.when(many, F.regexp_replace("text", LOOSE, "_")).alias("blotted"),
        F.when(F.col("text").contains("+"), spans(F.col("text"), PHONE)).otherwise(_none()).alias("phone"),
    )
    d = d.withColumn("card", F.when(F.col("blotted").isNotNull(), spans(F.col("blotted"), DIGITS)).otherwise(_none())).drop("blotted")

    def card(x: Column) -> Column:
        n = F.length(_digits(x["text"]))
        return F.when((n >= 14) & (n <= 19), luhn(_digits(x["text"]))).otherwise(F.lit(False))

    return d.select(
        id_col,
        "text",
        "email",
        F.filter("ip", lambda x: x["text"].rlike(OCTETS)).alias("ip"),
        F.filter("card", card).alias("card"),
        F.filter("phone", lambda x: F.length(_digits(x["text"])).between(10, 15)).alias("phone"),
    )


def _touches(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _hidden(text: Column, found: Column) -> Column:
    """The text with the characters of these spans, sorted by start, replaced one by one."""

    def step(acc: Column, x: Column) -> Column:
        start, end = F.greatest(acc["at"], x["start"]), F.greatest(acc["at"], x["end"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.substr(text, acc["at"] + 1, start - acc["at"]), F.repeat(F.lit(HIDDEN), end - start)).alias("out"))

    whole = F.aggregate(found, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, whole).otherwise(text)


def candidates(base: DataFrame) -> DataFrame:
    """base with an array `proposed` of (start, end, kind, features in FEATURES), none of which touches a base span."""
    t, rest = F.col("text"), F.col("rest")
    d = base.withColumn("rest", _hidden(t, F.array_sort(F.concat(*KINDS))))
    digits = rest.rlike(r"[0-9][0-9().\x20/-]{6}")
    for kind, pattern, may in (("email", WIDE_EMAIL, rest.rlike(r"(?i)@|[\[({<]\x20?at\x20?[\])}>]")), ("ip", WIDE_IP, rest.rlike(rf"(?i)[0-9]{_POINT}[0-9]")), ("card", WIDE_CARD, digits), ("phone", WIDE_PHONE, digits)):
        d = d.withColumn(f"wide_{kind}", F.when(may, spans(rest, pattern)).otherwise(_none()))

    def describe(kind: str):
        def one(x: Column) -> Column:
            hit, before = x["text"], F.substr(t, F.greatest(x["start"] - 24 + 1, F.lit(1)), F.least(x["start"], F.lit(24)))
            digits, after = _digits(hit), F.substr(t, x["end"] + 1, F.lit(2))

            def count(characters: str) -> Column:
                return F.length(hit) - F.length(F.translate(hit, characters, ""))

            values = {
                "kind": F.lit(KINDS.index(kind)), "length": F.length(hit), "digits": F.length(digits), "groups": F.size(F.filter(F.split(hit, "[^0-9]+"), lambda g: g != "")),
                "longest": F.array_max(F.transform(F.split(hit, "[^0-9]+"), lambda g: F.length(g))), "dots": count("."), "spaces": count(" "), "hyphens": count("-"), "parens": count("()"), "slashes": count("/"), "brackets": count("[](){}<>"),
                "luhn": F.when(F.length(digits) > 1, luhn(digits)).otherwise(F.lit(False)).cast("int"), "octets": F.regexp_replace(hit, f"(?i){_POINT}", ".").rlike(OCTETS).cast("int"), "plus": hit.startswith("+").cast("int"), "zeros": hit.startswith("00").cast("int"), "letters": hit.rlike(r"[A-Za-z]{2}$").cast("int"), "joined": (before.rlike(r"[0-9][\x20./-]?$") | after.rlike(r"^[\x20./-]?[0-9]")).cast("int"),
                "named": before.rlike(_NEAR[kind]).cast("int"), "after_mark": before.rlike(r"[=#/:]$").cast("int"),
            }
            return F.struct(
                x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind"),
                *[values[f].cast("double").alias(f) for f in FEATURES if f != "kind"], values["kind"].cast("double").alias("kind_number"),
            )

        return one

    wide = [f"wide_{k}" for k in KINDS]
    return d.withColumn("proposed", F.concat(*[F.transform(w, describe(k)) for w, k in zip(wide, KINDS, strict=True)])).drop(*wide, "rest")


def examples(base: DataFrame, per_kind: int, per_text: int = 4) -> DataFrame:
    """(example, text): base spans rewritten within 24 characters of their surroundings; example has kind, start, end, true, aside.

    Of each kind at most per_kind spans, chosen by a hash, each in all forms:
    true ones that no base pattern knows, and decoys that only look like it.
    """

    def named(kind: str):
        return lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("hit"))

    found = F.concat(*[F.transform(F.slice(k, 1, per_text), named(k)) for k in KINDS])
    rows = base.select("text", F.explode(found).alias("b")).select(
        "b.kind", "b.hit", F.substr("text", F.greatest(F.col("b.start") - 24 + 1, F.lit(1)), F.least("b.start", F.lit(24))).alias("before"), F.substr("text", F.col("b.end") + 1, F.lit(24)).alias("after")
    )
    chosen = Window.partitionBy("kind").orderBy(F.xxhash64("hit"), "hit", "before", "after")
    rows = rows.withColumn("place", F.row_number().over(chosen)).where(F.col("place") <= per_kind)
    hit, digits = F.col("hit"), _digits(F.col("hit"))

    def some(k: int, salt: int) -> Column:
        return F.lpad(F.pmod(F.xxhash64("hit", F.lit(salt)), F.lit(10**k)).cast("string"), k, "0")

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    def fours(x: Column, mark: str) -> Column:
        return F.regexp_replace(x, "([0-9]{4})(?=[0-9])", f"$1{mark}")

    local, domain = F.substring_index(hit, "@", 1), F.substring_index(hit, "@", -1)
    last = F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), ((F.substr(digits, F.length(digits), F.lit(1)).try_cast("int") + 1) % 10).cast("string"))
    twelve = F.substr(digits, F.lit(1), F.lit(12))
    check = F.get(F.filter(F.array(*[F.lit(str(c)) for c in range(10)]), lambda c: F.call_function("luhn_check", F.concat(twelve, c))), F.lit(0)).cast("int")
    ten = F.right(digits, F.lit(10))
    a, b, c = F.substr(ten, F.lit(1), F.lit(3)), F.substr(ten, F.lit(4), F.lit(3)), F.substr(ten, F.lit(7), F.lit(4))
    over = F.regexp_replace(hit, r"^[0-9]+", F.concat(F.lit("4"), some(2, 1)))
    true = {
        "email": [text(local, at, F.replace(domain, F.lit("."), F.lit(dot))) for at, dot in ((" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" (at) ", "."), (" [at] ", "."), ("{at}", "{dot}"), (" <at> ", " <dot> "))],
        "ip": [F.replace(hit, F.lit("."), F.lit(dot)) for dot in ("[.]", " . ", "(.)", " [dot] ", "(dot)")] + [F.regexp_replace(hit, r"\.([0-9]+)$", "[.]$1")],
        "card": [fours(digits, "."), fours(digits, "/"), text(twelve, check.cast("string"))],
        "phone": [text("(", a, ") ", b, "-", c), text(a, "-", b, "-", c), text(a, ".", b, ".", c), text(a, " ", b, " ", c), text("(", a, ")", b, "-", c), text("00", digits)],
    }
    decoys = {
        "email": [text(local, " @ ", some(1, 1), ".", some(2, 2)), text(some(2, 1), " (at) ", some(1, 2), ".", some(2, 3)), text(local, " [at] v", some(1, 1), ".", some(2, 2))],
        "ip": [F.replace(over, F.lit("."), F.lit(dot)) for dot in (".", "[.]", " . ", " [dot] ")],
        "card": [last, fours(last, "."), fours(last, "/"), fours(last, " "), text(twelve, ((check + 1 + F.pmod(F.xxhash64("hit"), F.lit(9))) % 10).cast("string"))],
        "phone": [text("20", some(2, 1), "-0", some(1, 2), "-1", some(1, 3)), text("1", some(1, 1), "/0", some(1, 2), "/20", some(2, 3)), text("20", some(2, 1), "-0", some(1, 2), "-1", some(1, 3), " 1", some(1, 4)), some(8, 1), some(10, 5), text("15", some(11, 1)), text(some(3, 1), "-", some(2, 2), "-", some(4, 3)), text("978-", some(1, 1), "-", some(2, 2), "-", some(6, 3), "-", some(1, 4)), text(some(1, 1), ".", some(3, 2), ".", some(3, 3), ".", some(3, 4)), text(some(2, 1), " ", some(3, 2), " ", some(3, 3))],
    }
    forms = F.array().cast("array<struct<form:string,true:boolean>>")
    for kind in KINDS:
        own = F.array(*[F.struct(f.alias("form"), F.lit(label).alias("true")) for label, fs in ((True, true[kind]), (False, decoys[kind])) for f in fs])
        forms = F.when(F.col("kind") == kind, own).otherwise(forms)
    rows = rows.withColumn("f", F.explode(forms)).where(F.col("f.form").isNotNull())
    start = F.length("before")
    example = F.struct("kind", start.alias("start"), (start + F.length("f.form")).alias("end"), F.col("f.true").alias("true"), (F.pmod(F.xxhash64("hit", F.lit(3)), F.lit(3)) == 2).alias("aside"))
    return rows.select(example.alias("example"), F.concat("before", "f.form", "after").alias("text"))


@dataclass(frozen=True)
class Judge:
    trees: gbt.Trees
    thresholds: dict[str, float]

    def score(self, x: Column) -> Column:
        """The trees as nested conditions on a candidate's features."""

        def node(tree: int, k: int) -> Column:
            inner = self.trees.feature.shape[1]
            if k >= inner:
                return F.lit(float(self.trees.value[tree, k - inner]))
            t = float(self.trees.threshold[tree, k])
            if not np.isfinite(t):
                return node(tree, 2 * k + 1)
            name = FEATURES[self.trees.feature[tree, k]]
            return F.when(x["kind_number" if name == "kind" else name] > t, node(tree, 2 * k + 2)).otherwise(node(tree, 2 * k + 1))

        raw = F.lit(self.trees.base)
        for tree in range(len(self.trees.feature)):
            raw = raw + node(tree, 0)
        return 1 / (1 + F.exp(-raw))


def fit_judge(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000, trees: int = 12, precision: float = 0.995, per_kind: int = 1000) -> Judge:
    """Learns from examples() of at most about `sample` documents, chosen by a hash of the id; a third of the spans sets thresholds.

    A kind with too few base spans to learn from adds nothing.
    """
    share = min(1.0, sample / max(df.count(), 1))
    some = df.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(1_000_000)) < int(share * 1_000_000))
    made = materialize(examples(base_spans(some, id_col=id_col, text_col=text_col), per_kind), "pii-examples")
    e, c = F.col("example"), F.col("c")
    rows = candidates(base_spans(made, id_col="example", text_col="text")).select("example", F.explode("proposed").alias("c")).where(_touches(e, c))
    whole = (c["start"] == e["start"]) & (c["end"] == e["end"])
    label = F.when(~e["true"] | (c["kind"] != e["kind"]), F.lit(False)).when(whole, F.lit(True))  # parts of a true span count as neither
    rows = rows.select(label.alias("label"), e["aside"].alias("aside"), "c.*").where(F.col("label").isNotNull()).collect()
    got = sorted((tuple(r["kind_number" if f == "kind" else f] for f in FEATURES), r.label, r.aside) for r in rows)
    x, y = np.array([g[0] for g in got], float).reshape(len(got), len(FEATURES)), np.array([g[1] for g in got], float)
    aside = np.array([g[2] for g in got], bool)
    model = gbt.fit(x[~aside], y[~aside], trees=trees, depth=3, rate=0.4)
    p, thresholds = model.probability(x[aside]), {}
    for k, kind in enumerate(KINDS):
        own, is_true = p[(x[aside][:, 0] == k)], y[aside][x[aside][:, 0] == k]
        good = [t for t in sorted({0.5, *own[own > 0.5]}) if (own >= t).sum() >= 50 and is_true[own >= t].mean() >= precision]
        thresholds[kind] = float(good[0]) if good else 2.0
    return Judge(model, thresholds)


def find_personal_data(df: DataFrame, judge: Judge, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, found.

    Null counts as empty. Counts and base_sha256 are of base spans; `spans` has
    all, as kind:start:end in code points, end exclusive, by start, then kind as
    listed. Of added spans that touch each other the first stays. `found`: the
    spans as an array, for redact().
    """
    d = candidates(base_spans(df, id_col=id_col, text_col=text_col))

    def plain(kind: str):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"))

    def passes(c: Column) -> Column:
        limit = F.lit(2.0)
        for kind, t in judge.thresholds.items():
            limit = F.when(c["kind"] == kind, F.lit(t)).otherwise(limit)
        return judge.score(c) >= limit

    d = d.withColumn("base_found", F.array_sort(F.concat(*[F.transform(k, plain(k)) for k in KINDS])))
    ranks = F.create_map(*[v for k, kind in enumerate(KINDS) for v in (F.lit(kind), F.lit(k))])
    more = F.transform(F.filter("proposed", passes), lambda c: F.struct(c["start"].alias("start"), ranks[c["kind"]].alias("rank"), c["end"].alias("end"), c["kind"].alias("kind")))
    d = d.withColumn("more", F.array_sort(more))
    kind = "array<struct<start:int,rank:int,end:int,kind:string>>"
    apart = F.aggregate("more", F.array().cast(kind), lambda acc, x: F.when(F.exists(acc, lambda a: _touches(a, x)), acc).otherwise(F.array_append(acc, x)))
    d = d.withColumn("found", F.array_sort(F.concat("base_found", apart.cast(kind))))

    def joined(column: str) -> Column:
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return d.select(id_col, *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(joined("base_found"), 256).alias("base_sha256"), joined("found").alias("spans"), "found")


def redact(text: Column, found: Column) -> Column:
    """The text with each span of `found` replaced by its kind in angle brackets; of overlapping spans the first counts."""

    def step(acc: Column, x: Column) -> Column:
        cut = F.concat(acc["out"], F.substr(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit("<"), x["kind"], F.lit(">"))
        return F.when(x["start"] >= acc["at"], F.struct(x["end"].alias("at"), cut.alias("out"))).otherwise(acc)

    return F.aggregate(found, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
