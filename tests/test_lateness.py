"""Late rows are told and the others counted, however a stream is cut."""

import pytest
from pyspark.sql import functions as F

from tributary.session import scratch_path
from tributary.streaming import feeds, lateness

HOUR = 3_600_000_000


def plain(rows, lanes):
    """Counts per window and late rows, row by row."""
    clock, counts, late = {}, {}, set()
    for seq, index, at in sorted(rows):
        key, w = (index, seq % lanes), at // HOUR * HOUR
        if key in clock and clock[key] >= w + 2 * HOUR:
            late.add((seq, index, w, clock[key] - w - 2 * HOUR))
        else:
            counts[(index, w)] = counts.get((index, w), 0) + 1
        clock[key] = max(clock.get(key, at), at)
    return counts, late


@pytest.mark.parametrize("cuts", [(0, 400), (0, 3, 150, 151, 400)])
def test_counts_and_late_rows_are_all_rows(spark, cuts):
    rows = [(i, f"i{i % 3 % 2}", (i // 10) * HOUR // 3 - (HOUR * (i % 13) if i % 7 == 0 else 0) + 10 * HOUR) for i in range(400)]
    df = spark.createDataFrame(rows, "sequence long, index string, us long").select(
        "sequence", "index", F.timestamp_micros("us").alias("timestamp"))
    src, counts, late, ckpt = (scratch_path(spark, f"t/late-{k}") for k in ("src", "counts", "rows", "ckpt"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
    for lo, hi in zip(cuts, cuts[1:]):
        df.filter((F.col("sequence") >= lo) & (F.col("sequence") < hi)).coalesce(1).write.mode("append").parquet(src)
        feeds.run(lateness.counted(stream.parquet(src), 3_600_000, 3_600_000, lanes=2), output_mode="update", checkpoint=ckpt,
                  foreach_batch=lateness.split_sink(counts, late))
    want, behind = plain(rows, 2)
    got = lateness.current_counts(spark.read.parquet(counts)).collect()
    assert {(r["index"], r["window_us"]): r["n"] for r in got} == want
    told = lateness.late_rows(spark.read.parquet(late)).collect()
    assert {(r["sequence"], r["index"], r["window_us"], r["late_us"]) for r in told} == behind and len(told) == len(behind) > 0
    assert sum(want.values()) + len(behind) == len(rows)
    state = spark.read.format("statestore").option("stateVarName", "open").load(ckpt).count()
    assert state < len(want) / 2                           # closed windows have left the state
