"""Queries: text features over the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import scalar as fx
from riskframe.functions import text as tx
from riskframe.operators import text as T
from riskframe.plans.base import R, r6, sql_e
from riskframe.sources.encounters import encounters
from riskframe.sources.tables import table


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _stop_sql():
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in tx.english_stop_words()) + "]"


def _terms_ctes():
    return [
        f"TK as (select doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '{tx.TOKEN_PATTERN}'), "
        f"lambda t: not list_contains({_stop_sql()}, t)) as uni from documents)",
        "TM as (select doc_id, uni, case when len(uni) < 2 then []::varchar[] else "
        "list_transform(range(1, len(uni)), lambda i: uni[i] || ' ' || uni[i + 1]) end as bi from TK)",
        "TF as (select doc_id, term, count(*) as tf from (select doc_id, unnest(uni || bi) as term from TM) x "
        "group by 1, 2)",
        "DF as (select term, count(*) as df, sum(tf) as tf_total from TF group by term)",
        "VO as (select * from DF order by tf_total desc, term limit 100)",
    ]


def _sql(body, n=5):
    return sql_e(body, ctes=_terms_ctes()[:n], views=())


@R.add("doc_terms", ["FN19", "FN21"], _sql(
    "select doc_id, cast(len(uni) as int) as n_unigrams, cast(len(uni) + len(bi) as int) as n_terms from TM", 2))
def doc_terms(spark, sf_dir):
    t = T.terms(docs(spark, sf_dir), "doc_id", "text", ngram=False).withColumnRenamed("terms", "uni")
    t = t.select("doc_id", F.size("uni").alias("n_unigrams"),
                 (F.size("uni") + F.size(tx.bigrams(F.col("uni")))).alias("n_terms"))
    return t.select("doc_id", F.col("n_unigrams").cast("int"), F.col("n_terms").cast("int"))


@R.add("doc_terms_unicode", ["FN21", "T9"], _sql(
    "select doc_id, cast(len(uni) as int) as n_unigrams, cast(len(uni) + len(bi) as int) as n_terms from TM", 2).replace(
    tx.TOKEN_PATTERN, tx.UNICODE_TOKEN_PATTERN))
def doc_terms_unicode(spark, sf_dir):
    t = T.terms(docs(spark, sf_dir), "doc_id", "text", ngram=False, unicode=True).withColumnRenamed("terms", "uni")
    return t.select("doc_id", F.size("uni").cast("int").alias("n_unigrams"),
                    (F.size("uni") + F.size(tx.bigrams(F.col("uni")))).cast("int").alias("n_terms"))


@R.add("term_doc_freq", ["AGG27"], _sql("select term, df, cast(tf_total as bigint) as tf_total from DF", 4))
def term_doc_freq(spark, sf_dir):
    tf = T.term_counts(docs(spark, sf_dir), "doc_id", "text")
    return T.doc_frequencies(tf, "doc_id").select("term", "df", F.col("tf_total").cast("bigint"))


@R.add("vocabulary", ["TOP7"], _sql("select term, df, cast(tf_total as bigint) as tf_total from VO"))
def vocabulary(spark, sf_dir):
    tf = T.term_counts(docs(spark, sf_dir), "doc_id", "text")
    return T.vocabulary(tf, "doc_id").select("term", "df", F.col("tf_total").cast("bigint"))


@R.add("tfidf_weights", ["FN22", "T4", "SNK3"], _sql(
    "select doc_id, term, round(raw / sqrt(sum(raw * raw) over (partition by doc_id)), 6) as weight from "
    "(select TF.doc_id, TF.term, TF.tf * (ln((1 + n) / (1 + VO.df)) + 1) as raw from TF join VO on TF.term = VO.term, "
    "(select count(*) as n from documents) c) w"))
def tfidf_weights(spark, sf_dir):
    w = T.tfidf(docs(spark, sf_dir), "doc_id", "text")
    return w.select("doc_id", "term", r6("weight").alias("weight"))


@R.add("entity_counts", ["AGG28", "ML18", "JN1"], sql_e(
    "select doc_id, " + ", ".join(
        f"cast(len(regexp_extract_all(coalesce(text, ''), '{p}')) as bigint) as ent_{n}"
        for n, p in T.ENTITY_RULES) + " from documents", views=()))
def entity_counts(spark, sf_dir):
    return T.entity_counts(docs(spark, sf_dir), "doc_id", "text")


@R.add("entity_types", ["SET1"], sql_e(" union ".join(
    f"select '{n}' as entity_type from documents where len(regexp_extract_all(coalesce(text, ''), '{p}')) > 0"
    for n, p in T.ENTITY_RULES), views=()))
def entity_types(spark, sf_dir):
    return T.entity_types(docs(spark, sf_dir), "doc_id", "text")


@R.add("note_flags", ["FN18", "FN19", "JN1"], sql_e(
    "select E.encounter_id, case when coalesce(d.text, '') <> '' then 1 else 0 end as has_notes, "
    "cast(length(coalesce(d.text, '')) as int) as note_chars from E left join documents d on d.doc_id = E.encounter_id"))
def note_flags(spark, sf_dir):
    e = encounters(spark, sf_dir).select("encounter_id")
    d = docs(spark, sf_dir)
    d = d.select("doc_id", fx.has_text("text").alias("noted"),       # two numbers cross the join, not the text
                 F.length(fx.text_or_empty("text")).cast("int").alias("chars"))
    j = e.join(d, e.encounter_id == d.doc_id, "left")
    return j.select("encounter_id", F.coalesce("noted", F.lit(0)).alias("has_notes"),
                    F.coalesce("chars", F.lit(0)).alias("note_chars"))


@R.add("lsa_topics", ["ML12", "SNK3"])
def lsa_topics(spark, sf_dir):
    w = T.tfidf(docs(spark, sf_dir), "doc_id", "text")
    scores, _ = T.lsa(w, "doc_id", keys=docs(spark, sf_dir))
    return scores.select("doc_id", "topic", r6("score").alias("score"))
