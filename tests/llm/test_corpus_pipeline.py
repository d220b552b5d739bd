import corpus_pipeline
import pytest

from riskframe.llm import mixing
from riskframe.llm import order_minhash as om
from riskframe.llm import quality_rules as q
from riskframe.llm import secrets as sec
from riskframe.llm.decontaminate import decontaminate
from riskframe.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and result, written and read again."""
    from riskframe.llm.common import scratch_table
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        got = scratch_table(stage(spark, docs, SF), name.replace(" ", "-"))
        out.append((docs, got))
        docs = got
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_return_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(stages) == 5
    for _, got in stages[:-1]:
        assert got.columns == COLUMNS


def test_quality_stage_agrees_with_its_query(spark, stages):
    docs, got = stages[0]
    want = q.quality_rules(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("kept")
    assert ids(got) == ids(want)


def test_one_document_of_each_class_stays(stages):
    docs, got = stages[1]
    classes = {r["class_id"] for r in om.near_duplicate_classes(docs).collect()}
    assert ids(got) == sorted(classes)


def test_contaminated_documents_go_and_clean_ones_stay(spark, stages):
    docs, got = stages[2]
    judged = decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids(got) == ids(judged.where("not contaminated"))
    assert judged.where("contaminated").count() > 0


def test_no_secret_is_left_and_every_document_stays(stages):
    docs, got = stages[3]
    assert ids(got) == ids(docs)
    left = sec.scan_secrets(got)
    assert left.where("spans <> ''").count() == 0
    assert sec.scan_secrets(docs).where("spans <> ''").count() > 0


def test_mix_is_the_replication_of_what_was_kept(stages):
    docs, got = stages[4]
    assert {r["copy"] for r in got.collect()} >= {1, 2}
    assert set(ids(got)) <= set(ids(docs))
    assert got.count() == mixing.mix_sources(docs).count()


def test_run_gives_the_last_stage(spark, stages):
    key = ["doc_id", "copy", "shuffle_key"]
    want = {tuple(r) for r in stages[-1][1].select(key).collect()}
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).select(key).collect()} == want


def test_stages_stand_empty_and_odd_tables(spark, odd, stages):
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
