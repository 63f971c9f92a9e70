"""Merge rounds of packing over bins that do not merge."""

from evenkeel.llm import packing


def test_bins_that_do_not_merge_stay_spread(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 8)
    rounds, packed = [], packing._packed

    def seen(items, capacity, level):
        rounds.append(items.rdd.getNumPartitions())
        return packed(items, capacity, level)

    monkeypatch.setattr(packing, "_packed", seen)
    frame = spark.createDataFrame([(i, 0, 60) for i in range(640)], "doc_id bigint, piece int, length bigint")
    rows = packing.pack(frame, 100).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) == 640
    assert min(rounds) >= 640 // (8 * packing.FAN) and len(rounds) <= 4
