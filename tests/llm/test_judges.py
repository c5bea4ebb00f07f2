"""Classifiers, rules, personal data, archives and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quadrangle.llm import archives, gbt
from quadrangle.llm.bpe import vocabulary_path
from quadrangle.llm.common import fold
from quadrangle.llm.personal_data import Judge, find_personal_data, fit_judge, redact
from quadrangle.llm.quality_classifier import fit_quality, keep_good, score_quality, statistics
from quadrangle.llm.quality_rules import Condition, fit_rules, judge, learn_rules, text_statistics
from quadrangle.llm.toxicity import ToxicityModel, fit_toxicity, score_toxicity, train
from tests.llm.helpers import LOWER, SCHEMA, WORD, components, documents, frame, ordered

FOLDER = "/root/testdata/sf0.01"


def corpus(spark, n=600, seed=7):
    """Documents with labels: bad ones shout or repeat, toxic ones hold a few marked words."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for k in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(40, 120))]
        bad, toxic = k % 5 == 0, k % 3 == 0
        if toxic:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(["villain", "dreadful", "rotten"])
        if bad:
            w = [f"{x.upper()}!!" for x in w] if k % 2 else w[:2] * 40
        docs.append((k, " ".join(w)))
        labels.append((k, int(not bad), int(toxic)))
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(scored, labels, column):
    return scored.join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0]


def test_boosted_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = gbt.fit(x[:2000], y[:2000])
    assert ((trees.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    assert gbt.fit(x[:0], y[:0]).probability(x[:3]).tolist() == [0.5] * 3
    assert (gbt.fit(x, np.ones(3000)).probability(x) > 0.9).all()


def test_quality(spark):
    docs, labels = corpus(spark)
    trees = fit_quality(docs, labels, learn_from=fold(F.col("doc_id"), 4) != 2)
    held = labels.where(fold(F.col("doc_id"), 4) == 2)
    assert accuracy(score_quality(docs, trees), held, "quality") > 0.97
    kept = keep_good(docs, trees)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in score_quality(docs, trees).where("predicted = 1").collect()}


def test_toxicity(spark):
    docs, labels = corpus(spark)
    model = fit_toxicity(docs, labels, learn_from=fold(F.col("doc_id"), 5) != 0)
    good = labels.where((fold(F.col("doc_id"), 5) == 0) & (F.col("quality") == 1))
    assert accuracy(score_toxicity(docs, model), good, "toxic") > 0.9


def test_trained_dictionaries(spark):
    """The trainer's own format begins both dictionaries; samples that are too few are kept as they are."""
    docs, labels = corpus(spark, n=1500)
    model = fit_toxicity(docs, labels, learn_from=fold(F.col("doc_id"), 5) != 0)
    magic = (0xEC30A437).to_bytes(4, "little")
    assert model.toxic.startswith(magic) and model.ordinary.startswith(magic)
    assert len(model.toxic) == len(model.ordinary)
    assert any(w in model.toxic and w not in model.ordinary for w in (b"villain", b"dreadful", b"rotten"))
    assert train([b"few", b"few", b"words"], 100) == b"fewwords" and train([], 100) == b""


def test_scores_of_awkward_documents(spark):
    docs, labels = corpus(spark, 60)
    for scored in (score_quality(frame(spark), fit_quality(docs, labels)), score_toxicity(frame(spark), fit_toxicity(docs, labels))):
        got = scored.collect()
        assert len(got) == len(documents()) and all(0 <= r.score <= 1 for r in got)


def test_models_without_labels(spark):
    docs = frame(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nulls = spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    for labels in (none, nulls):
        assert score_quality(docs, fit_quality(docs, labels)).count() == len(documents())
        assert score_toxicity(docs, fit_toxicity(docs, labels)).count() == len(documents())
        assert fit_rules(docs, labels) == []


def test_base_statistics(spark):
    def brute(text):
        text = text or ""
        w = WORD.findall(text)
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        n = Counter(grams)
        covered = {j for k, g in enumerate(grams) if n[g] > 1 for j in range(k, k + 5)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)

    rng = random.Random(8)
    rows = documents() + [(900 + k, " ".join(rng.choice("ab#") for _ in range(rng.randint(0, 40))) + rng.choice(["", "\nx\nx"])) for k in range(80)]
    got = text_statistics(frame(spark, rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert ordered(map(tuple, got)) == ordered((i, *brute(t)) for i, t in rows)


def test_decision_list(spark):
    docs, labels = corpus(spark)
    rules = fit_rules(docs, labels)
    assert rules
    out = judge(docs, rules).join(labels, "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in out) / len(out) > 0.97
    assert not any(r.kept and r.base_failed for r in out)


def test_learned_conjunction():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 3))
    bad = (x[:, 0] > 0.7) & (x[:, 1] <= 0.4)
    rules = learn_rules(x, bad, ["a", "b", "c"])
    assert {c.name for c in rules[0]} == {"a", "b"}
    assert str(Condition("a", True, 0.5)) == "a > 0.5"


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    def digits(s):
        return re.sub("[^0-9]", "", s)

    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return ",".join(f"{['email', 'ip', 'card', 'phone'][k]}:{s}:{e}" for s, k, e in sorted(out))


PARTS = ["a@b.c", "..", "@", "a.b@", "x-y.z", "1.2.3.4", "256.1.1.1", "00255.0.0.1", ".", "4111 1111 1111 1111", "4111-1111-1111-1111", " ", "-", "  ", "1", "23", "+1 (269) 555-3296", "+", "(", "é", "🙂", "_", "%", "\n", "a", "4532"]
NOTHING = Judge(gbt.Trees(3, 0.0, np.zeros((0, 7), int), np.zeros((0, 7)), np.zeros((0, 8))), {})


def test_base_personal_data(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 14))) for _ in range(1200)]
    texts += ["a@" + "b." * 20_000 + "c", "1" * 60_000, "1 " * 30_000, "a" * 100_000, "+1" * 20_000, None, ""]
    got = {r.doc_id: r for r in find_personal_data(frame(spark, list(enumerate(texts))), NOTHING).collect()}
    for k, t in enumerate(texts):
        want = base_spans(t or "")
        assert got[k].spans == want, t
        assert got[k].base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_added_spans_and_redaction(spark):
    rng = random.Random(9)
    rows = [(k, f"call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} or mail a{k}@b.example.com, no 12-34") for k in range(400)]
    docs = frame(spark, rows)
    model = fit_judge(docs)
    texts = {r.doc_id: r.out for r in find_personal_data(docs, model).join(docs.select("doc_id", "text"), "doc_id").select("doc_id", redact(F.col("text"), F.col("found")).alias("out")).collect()}
    assert texts[0] == "call <phone> or mail <email>, no 12-34"
    assert fit_judge(frame(spark, [])).thresholds == dict.fromkeys(["email", "ip", "card", "phone"], 2.0)


def test_wide_forms_are_added_and_decoys_are_not(spark):
    rng = random.Random(5)

    def number(k: int) -> str:
        return "".join(rng.choice("123456789") for _ in range(k))

    def card(k: int, wrong: int = 0) -> str:
        d = number(k - 1)
        total = sum(int(x) if j % 2 else sum(divmod(2 * int(x), 10)) for j, x in enumerate(reversed(d)))
        return f"{d}{(-total + wrong) % 10}"

    known = [(k, f"call +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} or mail a{number(3)}@b{k % 9}.example.com, card {card(16)} from host {rng.randint(1, 255)}.{rng.randint(0, 255)}.3.{k % 250} now") for k in range(400)]
    model = fit_judge(frame(spark, known))
    planted = {"email": ["jo.doe [at] host [dot] com", "jo (at) mail.host.org"], "phone": ["(269) 555-3296", "269-555-3296"], "card": [card(13), "4111.1111.1111.1111"], "ip": ["10[.]20[.]30[.]40", "10 . 20 . 30 . 40"]}
    decoys = {"card": [card(13, 3), "4111.1111.1111.1112"], "ip": ["410[.]20[.]30[.]40"], "phone": ["2024-03-14", "123-45-6789"], "email": ["bread @ 3.50"]}
    near = {"email": "mail", "ip": "host", "card": "card", "phone": "call"}
    every = [(kind, x, kind) for kind, xs in planted.items() for x in xs] + [(kind, x, None) for kind, xs in decoys.items() for x in xs]
    rows = [(k, f"{near[where]} {x} or x@y.org now", kind) for k, (where, x, kind) in enumerate(every)]
    rows += [(200, "call 10.2.3.4 269-555-3297 now", None)]
    got = {r.doc_id: r.spans.split(",") for r in find_personal_data(frame(spark, [r[:2] for r in rows]), model).collect()}
    for k, t, kind in rows[:-1]:
        at = t.index(" or x@y.org")
        mail = f"email:{at + 4}:{at + 11}"
        assert got[k] == ([f"{kind}:5:{at}", mail] if kind else [mail]), t
    assert got[200] == ["ip:5:13", "phone:14:26"]


def test_arc_and_warc_round_trip(spark, tmp_path):
    long = "<p>same</p>" * 200
    pages = [(1, "http://a/x y", long), (2, "http://b", long), (5, "http://b", long), (3, None, None), (4, "http://c", "WARC/1.1\r\n\r\nWARC-Type: no\r\n" * 60), (None, "http://d", "né🙂\r\n\r\nx"), (6, "http://e", "short"), (7, "http://e", "short"), (8, "f", ""), (9, "http://g", "<td>é</td>\n" * 400_000), (10, "http://h", "one of two"), (10, "http://h", "two of two")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("size", F.lit(1))
    got = archives.archive_round_trip(df).collect()
    groups = defaultdict(list)
    for i, _, h in pages:
        if len((h or "").encode()) >= 1000:
            groups[h].append(i)
    want = []
    for i, _, h in pages:
        first = max(groups[h]) if h in groups else i
        want.append((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), "response" if i == first else "revisit", None if i == first else first))
    assert ordered(map(tuple, got)) == ordered(want)
    for version in ("1", "2"):
        archives.write_arc(df, f"{tmp_path}/arc{version}", version=version)
        back = archives.read_arc(spark, f"{tmp_path}/arc{version}").collect()
        assert Counter(r.payload for r in back) == Counter(h or "" for _, _, h in pages)
    archives.convert_arc(spark, f"{tmp_path}/arc1", f"{tmp_path}/warc")
    back = archives.read_warc(spark, f"{tmp_path}/warc").collect()
    assert len({r.record_id for r in back}) == len(pages)
    assert {r.date for r in back} == {"2000-01-01T00:00:00Z"}
    assert {r.type for r in back} == {"response", "revisit"}


def test_cut_archives_raise():
    with pytest.raises(ValueError, match="cut off"):
        list(archives.parse_arc(b"filedesc://x 0.0.0.0 20000101000000 text/plain 99\n1 0 x\n"))
    with pytest.raises(ValueError, match="version block"):
        list(archives.parse_arc(b"http://x 0.0.0.0 20000101000000 text/html 1\nx\n"))


def test_no_pages(spark):
    assert archives.archive_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


EMPTY = gbt.fit(np.zeros((0, 21)), np.zeros(0))


@pytest.mark.parametrize("operator", [lambda d: judge(d, []), lambda d: find_personal_data(d, NOTHING), lambda d: score_quality(d, EMPTY), lambda d: keep_good(d, EMPTY), lambda d: score_toxicity(d, ToxicityModel(b"", b"", np.zeros(14)))])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, FOLDER)
        if k < 4:
            assert docs.columns == columns
        counts.append(docs.count())
    assert before > counts[0] > counts[1] > counts[2] <= counts[3]


def _descended(trees, x):
    """Score of one row, tree by tree and node by node."""
    total = trees.base
    for f, t, v in zip(trees.feature.tolist(), trees.threshold.tolist(), trees.value.tolist(), strict=True):
        node = 0
        while node < len(f):
            node = 2 * node + (2 if x[f[node]] > t[node] else 1)
        total += v[node - len(f)]
    return 1 / (1 + math.exp(-total))


def test_scores_by_descending_each_tree(spark):
    docs, labels = corpus(spark, 300)
    trees = fit_quality(docs, labels)
    rows = documents()
    got = sorted((r.doc_id if r.doc_id is not None else -1, round(r.score, 9)) for r in score_quality(frame(spark, rows), trees).collect())
    assert got == sorted((i if i is not None else -1, round(_descended(trees, statistics((t or "").encode())), 9)) for i, t in rows)


def test_pipeline_by_brute_force(spark, tmp_path):
    """Each stage against brute force on what the stage before it kept: awkward documents, null and repeated ids, an extra column."""
    docs, labels = corpus(spark, 300)
    extra = [(None, "null id alone with enough words to be kept as it is"), (None, None), (5000, "same words twice"), (5000, "same words twice")]
    rows = [(i if i is None or i < 200 else i + 10_000, t) for i, t in documents()] + extra
    every = frame(spark, rows).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000)).withColumn("source", F.concat(F.lit("s"), F.length(F.coalesce("text", F.lit(""))) % 3))
    every.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    labels.withColumn("doc_id", F.col("doc_id") + 1000).coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    held, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, held, str(tmp_path))
        if k < 4:
            assert out.columns == held.columns
        out.write.parquet(f"{tmp_path}/stage{k}")
        held = spark.read.parquet(f"{tmp_path}/stage{k}")
        kept.append(held.collect())
    first = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()]
    pairs = [[(r.doc_id, r.text) for r in stage] for stage in kept[:4]]
    trees = fit_quality(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"), learn_from=fold(F.col("doc_id"), 4) != 2)
    assert ordered(pairs[0]) == ordered((i, t) for i, t in first if _descended(trees, statistics((t or "").encode())) >= 0.7)
    groups = defaultdict(list)
    for i, t in pairs[0]:
        groups[(t or "").translate(LOWER)].append(i)
    best = {g: max((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    assert ordered((i, (t or "").translate(LOWER)) for i, t in pairs[1]) == ordered((i, g) for g, i in best.items())
    parts = defaultdict(list)
    for (i, t), (_, _, c) in zip(pairs[1], components([(k, t) for k, (_, t) in enumerate(pairs[1])]), strict=True):
        parts[c].append((i, t))
    assert len(pairs[2]) == len(parts)
    assert all(sum(Counter(pairs[2])[r] for r in set(p)) == 1 for p in parts.values())
    times, before = Counter(pairs[3]), Counter(pairs[2])
    assert set(times) == set(before) and all(before[r] <= times[r] <= 3 * before[r] for r in before)
    library = Tokenizer.from_file(vocabulary_path())
    want = []
    for i, t in pairs[3]:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        edges = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
    assert ordered((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in kept[4]) == ordered(want)
    sequences = defaultdict(list)
    for r in kept[4]:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(s)]).tolist()]
        assert [at for at, _ in sorted(s)] == ends[:-1] and ends[-1] <= 1024
