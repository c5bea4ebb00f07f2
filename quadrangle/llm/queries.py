"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.llm.alignment import align_tokenizers
from quadrangle.llm.archives import archive_round_trip
from quadrangle.llm.common import LOWER, UPPER, WORD, fold, table
from quadrangle.llm.exact_dedup import exact_duplicates
from quadrangle.llm.minhash_dedup import minhash_components
from quadrangle.llm.mixing import mix_sources
from quadrangle.llm.ngram_join import ngram_components
from quadrangle.llm.packing import pack_documents
from quadrangle.llm.personal_data import find_personal_data, fit_judge
from quadrangle.llm.quality_classifier import fit_quality, score_quality
from quadrangle.llm.quality_rules import fit_rules, judge
from quadrangle.llm.ranked_search import TERM, ranked_search
from quadrangle.llm.token_counts import token_counts
from quadrangle.llm.toxicity import fit_toxicity, score_toxicity


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of at most 1024 tokens. Null text: one piece of the end id; repeated rows are packed each."""
    return pack_documents(table(spark, sf_dir, "documents"), length=1024)


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as ARC, converted to WARC and read back. Null html: an empty payload; null urls: "unknown:"; rows that repeat an id are records of their own."""
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest id stays. Null text counts as empty, null ids lose against others, of repeated rows one is kept."""
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op4_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from four of five folds. Null and empty texts get the score of an empty window; without labels of both kinds the score is a constant."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, learn_from=fold(F.col("doc_id"), 5) != 0)
    return score_toxicity(docs, model, threshold=0.5).withColumn("held_out", fold(F.col("doc_id"), 5) == 0)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 5-word shingles are similar by 0.8. Null and empty texts have no set and stand alone."""
    return ngram_components(table(spark, sf_dir, "documents"), n=5, percent=80)


def op6_decision_list_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of all documents and the verdict of a learned decision list. Null text: no words, so base_failed."""
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit_rules(docs, table(spark, sf_dir, "labels")))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from three of four folds. Null and empty texts get the score of an empty text."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    trees = fit_quality(docs, labels, learn_from=fold(F.col("doc_id"), 4) != 2)
    return score_quality(docs, trees, threshold=0.7).withColumn("held_out", fold(F.col("doc_id"), 4) == 2)


def op8_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents: base spans, and those that boosted trees add. Null text counts as empty: no spans."""
    docs = table(spark, sf_dir, "documents")
    return find_personal_data(docs, fit_judge(docs)).drop("found")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents. Null text counts as empty: 0 of both."""
    return token_counts(table(spark, sf_dir, "documents"), limit=512)


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as often as their source is drawn: once at least, those of small sources up to twice. Null sources are one source; texts without tokens come with whole passes."""
    return mix_sources(table(spark, sf_dir, "documents"), max_repeats=2.0)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all documents for each benchmark item. Null and empty texts are never found; equal scores go by ascending id, null ids last; repeated rows are found each."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles are similar by 0.85. Null and empty texts have no set and stand alone."""
    return minhash_components(table(spark, sf_dir, "documents"), n=3, percent=85)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two vocabularies in all documents. Null and empty texts, and such that a vocabulary can't give back, have zeros and no digest."""
    return align_tokenizers(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_arc_to_warc, op3_exact_dedup, op4_compression_toxicity, op5_ngram_jaccard_join, op6_decision_list_rules, op7_quality_classifier, op8_boosted_pii, op9_token_counts, op10_temperature_mixing, op11_ranked_search, op12_tensored_minhash, op13_tokenizer_alignment)}



def _components_sql(n: int, percent: int, more: str = "") -> str:
    """Shingle sets, links by shared shingles, and the smallest id reachable."""
    return rf"""
        with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w from documents),
        s as (select doc_id, case when len(w) = 0 then [] else list_distinct([array_to_string(w[i:i + {n - 1}], ' ') for i in range(1, greatest(len(w) - {n - 1}, 1) + 1)]) end as s from w),
        g as (select doc_id, len(s) as n, unnest(s) as gram from s),
        p as (select x.doc_id as a, y.doc_id as b, x.n as na, y.n as nb, count(*) as common from g x join g y on x.gram = y.gram and x.doc_id < y.doc_id group by all),
        o as materialized (select a, b from p where 100 * common >= {percent} * (na + nb - common)),
        l as (select a, b from o union all select b, a from o),
        r as (select doc_id, doc_id as reached from s union select r.doc_id, l.b from r join l on l.a = r.reached),
        m as (select doc_id, min(reached) as component_id from r group by doc_id)
        select doc_id, len(s) as n_shingles, component_id{more} from s join m using (doc_id)
    """


ORACLES = {
    "op5_ngram_jaccard_join": _components_sql(5, 80),
    "op12_tensored_minhash": _components_sql(3, 85, ", doc_id = component_id as kept"),
    "op2_arc_to_warc": """
        with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
        g as (select page_id, octet_length(payload) as payload_bytes, sha1(payload) as payload_digest,
                     case when octet_length(payload) >= 1000 then max(page_id) over (partition by payload) else page_id end as first_id from p)
        select page_id, payload_bytes, payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type,
               case when page_id <> first_id then first_id end as refers_to
        from g
    """,
    "op3_exact_dedup": f"""
        with d as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as norm from documents)
        select doc_id, max(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
               doc_id = max(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
        from d
    """,
    "op11_ranked_search": rf"""
        with d as (select doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') as w from documents),
        i as (select item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) as term from benchmark),
        q as (select item_id, term, count(*) as times from i group by all),
        c as (select count(*) as big_n, cast(sum(len(w)) as bigint) as big_l from d where len(w) > 0),
        p as (select doc_id, n, term, count(*) as tf from (select doc_id, len(w) as n, unnest(w) as term from d where len(w) > 0) group by all),
        f as (select term, count(*) as df from p group by term),
        s as (select p.doc_id, p.term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) as bigint) * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))) as part from p join f using (term), c),
        t as (select item_id, doc_id, cast(sum(times * part) as bigint) as score from q join s using (term) group by all),
        r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from t where score > 0)
        select item_id, cast(rank as int) as rank, doc_id, score from r where rank <= 20
    """,
}
