"""The pipeline's stages, each on all that its predecessor kept."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as cp
from costframe.llm import quality
from costframe.llm.common import saved, table

SF = "/root/testdata/sf0.001"


def test_stages_do_what_they_say(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, "en", None, None), (990001, "", "en", "src0", 0), (990001, "", "en", "src0", 0)], docs.schema)
    docs = docs.union(odd).union(docs.where("doc_id < 3"))
    kept = {}
    for name, stage in cp.STAGES:
        before, docs = docs, saved(stage(spark, docs, SF), "test-stage")
        if name != cp.STAGES[-1][0]:
            assert docs.columns == before.columns
        kept[name] = docs.collect()
    good = {r.doc_id for r in quality.quality_scores(table(spark, SF, "documents"), table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert good - {r.doc_id for r in kept["quality classifier"]} == set()

    def sets(t):
        w = (t or "").lower().encode().split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())

    near = [(r, sets(r.text)) for r in kept["near-dedup"]]
    assert not [1 for i, (a, x) in enumerate(near) for b, y in near[:i] if x and y and 5 * len(x & y) >= 4 * len(x | y)]
    every = [sets(r.text) for r in kept["quality classifier"]]
    assert all(not s or any(5 * len(s & x) >= 4 * len(s | x) for _, x in near) for s in every)
    for item in table(spark, SF, "benchmark").collect():
        assert not [r for r in kept["decontamination"] if item.text in (r.text or "")]
    mixed = Counter(r.doc_id for r in kept["mixing"])
    assert set(mixed) <= {r.doc_id for r in kept["decontamination"]} and max(mixed.values()) <= 2
    shards = Counter(r.shard for r in kept["sharding"])
    assert {(r.shard, r.slot) for r in kept["sharding"]} == {(s, k) for s, n in shards.items() for k in range(n)}
    assert Counter(r.doc_id for r in kept["sharding"]) == mixed
    assert all(r.grown_shard in (r.shard, 40) for r in kept["sharding"])


CLASHING = ("name", "copies", "_of", "part", "rank", "first", "size", "shard", "slot", "n", "row", "p", "score")


def test_run_on_a_table_with_other_columns(spark, workdir):
    """Columns with the stages' own names come through with their values; an empty table gives an empty result."""
    docs = table(spark, SF, "documents").limit(40)
    docs = docs.select("*", *[(F.col("doc_id") * 0 + k).alias(c) for k, c in enumerate(CLASHING)])
    none = docs.limit(0)
    for _, stage in cp.STAGES:
        docs, none = saved(stage(spark, docs, SF), "test-columns"), saved(stage(spark, none, SF), "test-empty")
        assert docs.columns == none.columns and none.isEmpty()
    got = docs.collect()
    assert got and all([r[c] for c in CLASHING] == list(range(len(CLASHING))) for r in got)
    assert {"_size", "_shard", "_slot", "text_crc32", "grown_shard"} <= set(docs.columns)


def test_stages_on_a_very_long_text(spark):
    """One text of a few megabytes beside short ones."""
    docs = table(spark, SF, "documents").limit(30)
    text = " ".join(r.text for r in docs.collect())
    long = spark.createDataFrame([(980001, (text + " ") * (3_000_000 // len(text)), "en", "src0", None)], docs.schema)
    docs = docs.union(long)
    for name, stage in cp.STAGES:
        docs = saved(stage(spark, docs, SF), "test-long")
        if name == "quality classifier" and docs.where("doc_id = 980001").isEmpty():
            docs = docs.union(long)
    assert docs.count()
