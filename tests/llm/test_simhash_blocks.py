import random

from pyspark.sql import functions as F

from tabforge.llm import simhash


def _signed(f):
    return f - (1 << 64) if f >> 63 else f


def _frame(spark, fps):
    return spark.createDataFrame([(_signed(x),) for x in sorted(fps)], "fp long")


def test_anchors_keyed_with_blocks_lose_no_link(spark):
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for _ in range(6):
            g = f
            for _ in range(rng.randint(1, 3)):
                g ^= 1 << rng.randrange(64)
            fps.add(g)
    expected = {tuple(sorted((_signed(a), _signed(b)))) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2}
    rows = _frame(spark, fps)
    assert {tuple(r) for r in simhash.links(rows, max_meetings=0).collect()} == expected and len(expected) > 50
    assert {tuple(r) for r in simhash.links(rows).collect()} == expected


def test_blocks_thin_out_a_crowded_anchor(spark):
    rng = random.Random(6)

    def meetings(n, blocks):
        fps = {rng.getrandbits(33) << 31 for _ in range(n)}  # one anchor in the lower part
        members, replicas = simhash.members_and_replicas(_frame(spark, fps), blocks)
        return members.join(replicas, "key").filter("a <> b").count() / n
    assert meetings(1000, 1) > 900
    assert meetings(1000, 3) < 12 and meetings(4000, 3) < 24  # one anchor's own load: 3 n / 2,048 and the other part's


def test_blocks_follow_from_the_number_of_fingerprints():
    assert simhash.blocks_for(10**6) == 1 and simhash.blocks_for(10**8) == 1 and simhash.blocks_for(10**10) == 3
    # meetings expected of a fingerprint stay below the bound up to some 10^11
    for n in (10**7, 10**8, 10**9, 10**10, 9 * 10**10):
        blocks = simhash.blocks_for(n)
        per_key = n / (simhash._ANCHORS if blocks == 1 else simhash._ANCHORS << simhash._BLOCK_BITS)
        assert 2 * 16 * blocks * per_key <= simhash.MAX_MEETINGS


def test_replicas_are_never_broadcast(spark):
    """Spark sizes them as before the explode: 300,000 fingerprints, 10 million replicas, passed for a table to send to the driver."""
    plan = simhash.links(_frame(spark, range(1, 2000)))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
