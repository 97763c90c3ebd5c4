"""The pipeline, stage by stage and whole, against plain Python on the small table."""

from __future__ import annotations

import collections

import public_tokenizers
import pytest
from .test_text_tables import classes_by_force, groups_by_force, targets_by_force, token_ids

import corpus_pipeline
from roadlens.llm import qda_quality, queries
from roadlens.llm.common import table, written


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage is given and returns, as lists of rows."""
    docs = table(spark, sf_dir, "documents")
    out = [("documents", docs.columns, docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "test-stage")
        out.append((name, docs.columns, docs.collect()))
    return out


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "packing",
    ]


def test_filtering_stages_return_documents(stages):
    given = set(map(tuple, stages[0][2]))
    for _, columns, rows in stages[1:5]:
        assert columns == stages[0][1]
        assert set(map(tuple, rows)) <= given


def test_quality_stage_equals_the_query(spark, sf_dir, stages):
    predicted = {r.doc_id for r in queries.op5_quality(spark, sf_dir).collect() if r.predicted == 1}
    assert {r.doc_id for r in stages[1][2]} == predicted
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    kept = [labels[d] for d in predicted if d in labels]
    assert sum(kept) > 0.9 * len(kept)
    assert qda_quality.KEEP_AT == 0.7


def test_exact_dedup_stage(stages):
    groups = groups_by_force([r.asDict() for r in stages[1][2]])
    assert {r.doc_id for r in stages[2][2]} == {max(ids) for ids in groups.values()}


def test_near_dedup_stage_keeps_one_of_each_class(stages):
    label = classes_by_force([r.asDict() for r in stages[2][2]])
    kept = collections.Counter(label[r.doc_id] for r in stages[3][2])
    assert set(kept) == set(label.values()) and set(kept.values()) == {1}


def test_mix_stage_takes_sources_near_their_targets(stages):
    size = {r.doc_id: len(r.text.split()) for r in stages[3][2]}
    given, taken = collections.Counter(), collections.Counter()
    for r in stages[3][2]:
        given[r.source] += size[r.doc_id]
    for r in stages[4][2]:
        taken[r.source] += size[r.doc_id]
    copies = collections.Counter(r.doc_id for r in stages[4][2])
    assert max(copies.values()) <= 2
    expected = targets_by_force(given)
    longest = collections.Counter()
    for r in stages[3][2]:
        longest[r.source] = max(longest[r.source], size[r.doc_id])
    for name, words in expected.items():
        assert abs(taken[name] - words) <= longest[name] / 2 + 1


def test_packing_stage_holds_every_copy(stages):
    copies = collections.Counter(r.doc_id for r in stages[4][2])
    text = {r.doc_id: r.text for r in stages[4][2]}
    packed = collections.Counter()
    for p in stages[5][2]:
        packed[p.doc_id] += p.length
    path = public_tokenizers.path(queries.WORD_BPE)
    assert packed == {d: n * len(token_ids(path, text[d], 1)) for d, n in copies.items()}


def test_run_equals_the_stages(spark, sf_dir, stages):
    run = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda p: (p.doc_id, p.start, p.length, p.ids_crc32)
    whole = lambda rows: collections.Counter((p.doc_id, p.doc_tokens) for p in rows if p.start == 0)
    assert whole(run) == whole(stages[5][2]) and sum(p.length for p in run) == sum(p.length for p in stages[5][2])
    assert len({key(p) for p in run}) > 0


def awkward(spark, rows):
    """Documents with columns named like those that the operators use inside."""
    extra = "row_id int, digest string, x string, score string, label string, keep_id int, bucket int, first string, text_sha256 string, __mix_copies int"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    own = (7, "d", "x", "s", "l", 5, 3, "f", "t", 9)
    return spark.createDataFrame([(d, t, "en", s, n, *own) for d, t, s, n in rows], schema)


def test_stages_on_awkward_rows(spark, sf_dir):
    good = [r.text for r in table(spark, sf_dir, "documents").orderBy("doc_id").limit(40).collect()]
    rows = [(i, t, "web" if i % 3 else None, len(t)) for i, t in enumerate(good)]
    rows += rows[:5] * 2 + [(None, good[6], "web", None), (None, None, None, None), (900, None, "", 0), (901, "", "web", 0), (902, " \n\t ", None, 5)]
    rows += [(903, " ".join(good) * 20, "books", 1), (904, "x" * 300_000, "books", 1), (905, good[7] + " ", "web", 1)]
    docs = awkward(spark, rows)
    given = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = written(stage(spark, docs, sf_dir), "test-awkward")
        held = [tuple(r) for r in docs.collect()]
        assert docs.columns == awkward(spark, []).columns and set(held) <= given, name
        assert len(held) <= before or name.startswith("mixing")
        if name == "exact dedup":
            assert len({r[1] or "" for r in held}) == len(held)
    packed = corpus_pipeline.pack(spark, docs, sf_dir).collect()
    assert sum(p.start == 0 for p in packed) == docs.count() > 5


def test_each_stage_alone_takes_awkward_rows(spark, sf_dir):
    """Also rows that the classifier would not let through to the later stages."""
    rows = [(1, None, None, None), (1, None, None, None), (None, "", "a", 0), (2, "same text here", "a", 1), (3, "same text here", None, 1), (4, "w " * 50_000, "b", 1)]
    docs = awkward(spark, rows)
    sizes = {}
    for name, stage in corpus_pipeline.STAGES:
        sizes[name] = stage(spark, docs, sf_dir).count()
    assert sizes["exact dedup"] == sizes["MinHash near-dedup"] == 3 and sizes["packing"] >= 6


def test_an_empty_table_passes_all_stages(spark, sf_dir):
    docs = awkward(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.collect() == [], name
        docs = docs if name == "packing" else written(out, "test-empty")
        assert name == "packing" or docs.columns == awkward(spark, []).columns
