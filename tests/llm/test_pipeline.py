"""The stages in a row against plain Python, stage after stage, and the registry."""

import re

import public_tokenizers
import pytest
import tiktoken
from test_dedup import near_by_hand
from test_mixing import by_hand

import __spark_entry__
import corpus_pipeline
from tidemark.llm import bpe, exact_dedup, toxicity


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "minhash_near_dedup", "mixing", "byte_bpe"]
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert all(any(re.fullmatch(rf"op{n}_\w+", q) for q in names) for n in range(1, 11))


@pytest.fixture(scope="module")
def small(spark, folder, tmp_path_factory):
    """Some given documents with odd ones among them, as files of their own."""
    base = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(120)
    odd = spark.createDataFrame([(90_001, None, "en", "src1", 0), (90_002, "", "en", None, 0), (90_003, " \n", None, None, 3),
                                 (90_004, "same words again", "en", "src1", 16), (90_005, "same  words again", "en", "src1", 17)],
                                docs.schema)
    docs.unionByName(odd).repartition(3).write.parquet(f"{base}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{base}/labels.parquet")
    return base


def test_against_plain_python(spark, small):
    got = sorted((r.doc_id, r.token_ids) for r in corpus_pipeline.run(spark, small).collect())
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    fine = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 0").collect()}
    rows = sorted((r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in fine)
    seen, unique = set(), []
    for row in rows:
        plain = re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")
        if plain not in seen:
            seen.add(plain)
            unique.append(row)
    kept = {i for i, *_, is_kept in near_by_hand([r[:2] for r in unique], 5, 80) if is_kept}
    mixed = [r for r in unique if r[0] in kept]
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=bpe.load_ranks(corpus_pipeline.VOCABULARY))
    want = []
    for (i, text, _), (_, size, _, _, taken) in zip(mixed, by_hand(mixed), strict=True):
        if size:
            want += [(i, other.encode_ordinary(text))] * (taken // size)
    assert [g for g in got if g[1] and g[0] < 90_001] == sorted(w for w in want if w[0] < 90_001)
    assert sorted(g for g in got if g[0] in (90_004, 90_005)) == sorted(w for w in want if w[0] > 90_003)


def test_scratch_goes_once_a_result_is_written(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    one, two = (stages["exact_dedup"](spark, docs, small) for _ in range(2))
    assert one.count() == two.count()           # both still readable: nothing was written between
    mixed = stages["mixing"](spark, one, small)
    assert mixed.count() and one.count()        # lazily chained: still readable
    one.write.parquet(f"{tmp_path}/one")
    again = stages["exact_dedup"](spark, spark.read.parquet(f"{tmp_path}/one"), small)
    assert again.count() == spark.read.parquet(f"{tmp_path}/one").count()
    with pytest.raises(Exception):
        one.count()


def test_frames_of_other_calls_outlive_a_run(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    decided = __spark_entry__.queries()["op4_exact_dedup"](spark, small)
    kept = exact_dedup.exact_dedup(docs)
    assert corpus_pipeline.run(spark, small).count() > 0
    assert decided.count() == docs.count() >= kept.count() > 0


def test_every_stage_takes_what_the_one_before_kept(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small)
        assert out.columns == docs.columns
        assert out.select("doc_id").exceptAll(out.select("doc_id").distinct()).count() == 0 or stage.__wrapped__ is corpus_pipeline.mix_sources
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, small).count() == 0
