"""The corpus pipeline: every stage against what its operator says, on a whole small table."""

import corpus_pipeline
from cairn.llm import decontamination, mixing, simhash, toxicity
from cairn.llm.tables import read, written
from tests.conftest import SF_SMALL


def test_pipeline_stages(spark):
    docs = read(spark, SF_SMALL, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SF_SMALL), f"test-{name}"))
    start, calm, single, clean, mixed, sharded = frames
    assert all(f.columns == docs.columns for f in frames[:-1])
    scores = toxicity.toxicity(start, read(spark, SF_SMALL, "labels"))
    assert {r.doc_id for r in calm.collect()} == {r.doc_id for r in scores.filter("predicted = 0").collect()}
    near = simhash.near_duplicates(calm)
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in near.collect()})
    dirty = {r.doc_id for r in decontamination.leaks(single, read(spark, SF_SMALL, "benchmark")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - dirty
    slim = mixing.sizes(clean)
    plan = mixing.plan_mix(slim, mixing.ranked_weights(slim, (5, 2, 1)))
    words = {r.source: r.w for r in mixing.sizes(mixed).groupBy("source").agg({"size": "sum"}).withColumnRenamed("sum(size)", "w").collect()}
    largest = slim.agg({"size": "max"}).first()[0]
    for r in plan.collect():
        assert abs(words.get(r.source, 0) - r.target) <= largest
    copies = mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
    assert copies <= 3
    assert sharded.select(*docs.columns).exceptAll(mixed).isEmpty() and sharded.count() == mixed.count()


def test_pipeline_on_messy_rows(spark):
    """Nulls, empty, very long and repeated texts, repeated ids, clashing columns: each stage keeps the
    columns, and what stays is what a plain reading of the stage leaves."""
    from tests.llm.test_models import groups, plain_fingerprint
    from tests.llm.test_oracles import messy
    bench = [r.text for r in read(spark, SF_SMALL, "benchmark").limit(3).collect()]
    more = spark.createDataFrame([(2000 + i, f"{'some other words here ' * i}\n{t}\n{'and more of them ' * i}") for i, t in enumerate(bench)]
                                 + [(5, "a repeated id"), (5, "a repeated id"), (3000, None), (3001, "")], "doc_id long, text string")
    docs = messy(spark).unionByName(more, allowMissingColumns=True)
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SF_SMALL), f"messy-{name}"))
    start, calm, single, clean, mixed, sharded = frames
    assert all(f.columns == docs.columns for f in frames[:-1])
    rows = sorted(((r.doc_id, r.text) for r in calm.collect()), key=lambda r: r[0])
    assert len(rows) == start.count()                                    # none of them is toxic
    first = sorted(rows[g][0] for g in set(groups([plain_fingerprint(t) for _, t in rows], 3)))
    assert sorted(r.doc_id for r in single.collect()) == first           # two texts may have one id
    leaked = {2000 + i for i in range(len(bench))}
    assert sorted(r.doc_id for r in clean.collect()) == [d for d in first if d not in leaked]
    assert {r.doc_id for r in mixed.collect()} <= set(first) - leaked
    kept = [c for c in docs.columns if c != "shard"]                     # the last stage sets its own
    assert sharded.count() == mixed.count() and sharded.select(*kept).exceptAll(mixed.select(*kept)).isEmpty()
