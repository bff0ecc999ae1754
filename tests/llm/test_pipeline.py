import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
import edge  # noqa: E402

import corpus_pipeline  # noqa: E402
from tabforge.llm import mixing, toxicity  # noqa: E402
from tabforge.llm.common import documents, table, written  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "simhash_dedup", "source_mix", "packing"]

    toxic = {r["doc_id"] for r in toxicity.toxicity_report(docs, table(spark, SF, "labels")).collect() if r["predicted"]}
    kept = written(stages["toxicity"](spark, docs, SF), "t")
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - toxic

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    unique = written(stages["exact_dedup"](spark, kept, SF), "t")
    expected = {rows[i][0] for i, v in brute.exact_dedup(rows).items() if v[2]}
    assert unique.columns == columns and {r["doc_id"] for r in unique.collect()} == expected

    rows = [(r["doc_id"], brute.fingerprint(r["text"])) for r in unique.collect()]
    root = brute.simhash_components({f for _, f in rows})
    first = {}
    for d, f in sorted(rows):
        first.setdefault(root[f], d)
    single = written(stages["simhash_dedup"](spark, unique, SF), "t")
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == set(first.values())

    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_report(single).collect()}
    mixed = written(stages["source_mix"](spark, single, SF), "t")
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len(brute.words(r["text"]))
    assert mixed.columns == columns and words == Counter({d: n for d, n in taken.items() if n})

    packed = stages["packing"](spark, mixed, SF).collect()
    tokens = Counter()
    for r in packed:
        tokens[r["doc_id"]] += r["n_tokens"]
    assert tokens == words

    whole = corpus_pipeline.run(spark, SF).collect()
    assert Counter(tuple(r) for r in whole) == Counter(tuple(r) for r in packed)


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (edge.frame(spark), edge.empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = written(stage(spark, docs, SF), f"edge-{name}")
            assert docs.columns == columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert {"doc_id", "batch_id", "slot"} <= set(out.columns)
        out.collect()
