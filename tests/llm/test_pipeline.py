"""Each stage of the pipeline against brute force on its own input."""

import cases
import corpus_pipeline as pipeline
import pytest
import test_decontaminate
import test_line_dedup
import test_simhash

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = pipeline.table(spark, FOLDER, "documents")
    steps = [docs]
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, FOLDER), name)
        steps.append(docs)
    return steps


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages_in_order(stages):
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "byte_bpe"]
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns and frame.dtypes == stages[0].dtypes


def test_toxicity_keeps_unlabelled_and_clean(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert after.keys() <= before.keys() and all(after[i] == before[i] for i in after)
    assert 0.8 * len(before) < len(after)


def test_lines(stages):
    expected = {int(i): text for i, text, _, _ in test_line_dedup.brute(stages[1].collect(), 10)}
    after = rows(stages[2])
    assert {i: r.text for i, r in after.items()} == expected
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_near_duplicates(stages):
    before = rows(stages[2])
    prints = {i: test_simhash.brute_fingerprint(r.text) for i, r in before.items()}
    group = test_simhash.groups(set(prints.values()), 4)
    first = {}
    for i, value in prints.items():
        first[group[value]] = min(first.get(group[value], i), i)
    assert rows(stages[3]) == {i: before[i] for i in first.values()}


def test_contamination(spark, stages):
    items = [(r.item_id, r.text) for r in pipeline.table(spark, FOLDER, "benchmark").collect()]
    judged = test_decontaminate.brute([(r.doc_id, r.text) for r in stages[3].collect()], items, 10)
    assert rows(stages[4]).keys() == {int(i) for i, _, hit, _ in judged if not hit}


def test_encoding(stages):
    assert rows(stages[5]).keys() == rows(stages[4]).keys()
    assert all(len(r.ids) == r.n_tokens for r in stages[5].collect())


def test_run_equals_the_stages(spark, stages):
    key = lambda r: r.doc_id
    assert sorted(pipeline.run(spark, FOLDER).collect(), key=key) == sorted(stages[5].collect(), key=key)


def test_odd_and_empty_documents(spark):
    for docs in (cases.documents(spark), cases.empty(spark)):
        for _, stage in pipeline.STAGES[:-1]:
            after = pipeline.stored(stage(spark, docs, FOLDER), "odd")
            assert after.columns == docs.columns
            docs = after
        pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    kept = pipeline.drop_near_duplicates(spark, cases.documents(spark, ["same words here now"] * 4), FOLDER)
    assert kept.count() == 1 and kept.first().doc_id == 0


@pytest.mark.parametrize("labels", [
    [], [(10_000, 1), (10_001, 0)], [(i, 1) for i in range(60)], [(i, 0) for i in range(60)],
    [(i, int(i % 4 > 0)) for i in range(60)],  # mostly toxic, and no word tells them apart
])
def test_nothing_is_dropped_as_toxic_by_an_empty_lexicon(spark, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = cases.documents(spark, ["the same few words"] * 60)
    assert pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == docs.count()
