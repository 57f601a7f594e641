import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeloom.operators.trades import unique_trades
from tapeloom.plans.history_load import load_history, page_trades
from tapeloom.sinks import compaction, history, snapshots

DAYS = [dt.date(2025, 3, 1), dt.date(2025, 3, 2), dt.date(2025, 3, 3)]
MIDNIGHTS = [1740787200000, 1740873600000, 1740960000000]


def stored(spark, rows):
    text = "[" + ",".join(f'[{i},{mts},"{amount}","100.5"]' for i, mts, amount in rows) + "]"
    frame = spark.createDataFrame([(text,)], "page string")
    return history.to_stored(unique_trades(page_trades(frame, "tX")))


def load(spark, root, ids, days=(0, 1), amount="1.5"):
    rows = [(10 * i + day, MIDNIGHTS[day] + i, amount) for i in ids for day in days]
    return history.append_new_trades(spark, stored(spark, rows), root, "tX")


def ids(frame):
    return sorted(row["id"] for row in frame.collect())


def expected(upto, days=(0, 1)):
    return sorted(10 * i + day for i in range(upto) for day in days)


def test_small_files_are_put_together_and_later_loads_count(spark, tmp_path):
    root = str(tmp_path)
    for i in range(6):
        load(spark, root, [i])
    assert min(compaction.file_counts(spark, root, "tX").values()) >= 6
    taken = compaction.compact_history(spark, root, "tX")
    assert set(taken) == set(DAYS[:2]) and min(taken.values()) >= 6
    assert max(compaction.file_counts(spark, root, "tX").values()) <= 2
    assert ids(history.read_history(spark, root, "tX")) == expected(6)
    # Compacting again finds nothing; trades already held are seen in the snapshot; new ones count at once.
    assert compaction.compact_history(spark, root, "tX") == {}
    assert load(spark, root, range(8)) == 4
    assert ids(history.read_history(spark, root, "tX")) == expected(8)
    assert ids(history.read_history(spark, root, "tX").where(F.col("date") == F.lit(DAYS[1]))) == expected(8, [1])
    assert history.stored_days(spark, root, "tX") == DAYS[:2]


def test_file_count_stays_bounded_over_many_loads(spark, tmp_path):
    root, most = str(tmp_path), 0
    for i in range(12):
        load(spark, root, [i], days=[0])
        compaction.compact_history(spark, root, "tX", least_files=3)
        most = max(most, *compaction.file_counts(spark, root, "tX").values())
    compaction.remove_replaced(spark, root, "tX", older_than_ms=0)
    assert most <= 3 and ids(history.read_history(spark, root, "tX")) == expected(12, [0])


def test_large_files_stay_where_they_are(spark, tmp_path):
    root = str(tmp_path)
    for i in range(4):
        load(spark, root, [i], days=[0])
    before = snapshots.data_files(spark, f"{history.history_path(root, 'tX')}/date={DAYS[0]}")
    assert compaction.compact_history(spark, root, "tX", target_bytes=min(f.bytes for f in before), least_files=2) == {}


def test_readers_and_loads_during_a_compaction(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for i in range(4):
        load(spark, root, [i])
    early = history.read_history(spark, root, "tX")
    publish = snapshots.publish

    def meanwhile(*arguments):  # the run is written, the snapshot not yet in force
        assert ids(history.read_history(spark, root, "tX")) == expected(4)
        assert load(spark, root, [4]) == 2
        result = publish(*arguments)
        assert ids(history.read_history(spark, root, "tX")) == expected(5)
        return result

    monkeypatch.setattr(snapshots, "publish", meanwhile)
    compaction.compact_history(spark, root, "tX")
    monkeypatch.undo()
    assert ids(early) == expected(4)  # resolved before, run after
    assert ids(history.read_history(spark, root, "tX")) == expected(5)
    assert compaction.remove_replaced(spark, root, "tX", older_than_ms=3_600_000) == 0
    assert compaction.remove_replaced(spark, root, "tX", older_than_ms=0) >= 8
    assert ids(history.read_history(spark, root, "tX")) == expected(5)


def test_of_two_compactions_one_fails_and_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for i in range(4):
        load(spark, root, [i])
    publish, inner = snapshots.publish, []

    def meanwhile(*arguments):
        if not inner:
            inner.append(True)
            compaction.compact_history(spark, root, "tX")
        return publish(*arguments)

    monkeypatch.setattr(snapshots, "publish", meanwhile)
    with pytest.raises(snapshots.Conflict):
        compaction.compact_history(spark, root, "tX")
    monkeypatch.undo()
    assert ids(history.read_history(spark, root, "tX")) == expected(4)
    assert max(compaction.file_counts(spark, root, "tX").values()) <= 2


def test_an_interrupted_compaction_leaves_all_as_it_was(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for i in range(4):
        load(spark, root, [i])

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(snapshots, "publish", lost)
    with pytest.raises(OSError):
        compaction.compact_history(spark, root, "tX")
    monkeypatch.undo()
    assert ids(history.read_history(spark, root, "tX")) == expected(4)
    assert set(compaction.compact_history(spark, root, "tX")) == set(DAYS[:2])
    # A manifest that was cut while it was written is not in force, and no other writer passes over it.
    base = history.history_path(root, "tX")
    with open(f"{base}/_snapshots/manifest-{2:012d}.json", "w") as cut:
        cut.write('{"runs": {')
    assert ids(history.read_history(spark, root, "tX")) == expected(4)
    for i in range(4, 8):
        load(spark, root, [i])
    with pytest.raises(snapshots.Conflict):
        compaction.compact_history(spark, root, "tX")
    assert ids(history.read_history(spark, root, "tX")) == expected(8)


def test_days_are_replaced_at_once_in_a_compacted_history(spark, tmp_path):
    root = str(tmp_path)
    for i in range(4):
        load(spark, root, [i])
    compaction.compact_history(spark, root, "tX")
    load(spark, root, [4])
    rows = [(7, MIDNIGHTS[1] + 5, "2"), (8, MIDNIGHTS[2] + 5, "2")]
    count, newest = history.write_history(stored(spark, rows), root, "tX")
    assert (count, newest) == (2, DAYS[2])
    assert ids(history.read_history(spark, root, "tX")) == sorted([*expected(5, [0]), 7, 8])
    assert history.stored_days(spark, root, "tX") == DAYS
    assert history.last_completed_day(spark, root, "tX", DAYS[0], DAYS[2])[0] == DAYS[1]
    compaction.remove_replaced(spark, root, "tX", older_than_ms=0)
    assert ids(history.read_history(spark, root, "tX")) == sorted([*expected(5, [0]), 7, 8])


def test_a_resumed_load_goes_on_in_a_compacted_history(spark, tmp_path):
    root = str(tmp_path)
    text = lambda rows: spark.createDataFrame([("[" + ",".join(f'[{i},{mts},"1","2"]' for i, mts in rows) + "]",)], "page string")
    first = [(i, MIDNIGHTS[i % 2] + i) for i in range(20)]
    load_history(spark, text(first), root, symbol="tX", start=MIDNIGHTS[0])
    compaction.compact_history(spark, root, "tX", least_files=2)
    # The newest day was not complete: a resumed pull delivers it again, and the load replaces it.
    load_history(spark, text(first + [(i, MIDNIGHTS[1 + i % 2] + i) for i in range(20, 40)]), root, symbol="tX")
    assert ids(history.read_history(spark, root, "tX")) == list(range(40))


def test_replaced_files_are_not_opened(spark, tmp_path):
    root = str(tmp_path)
    for i in range(5):
        load(spark, root, [i], days=[0])
    compaction.compact_history(spark, root, "tX")
    load(spark, root, [5], days=[0])
    base = history.history_path(root, "tX")
    for name in snapshots.current(spark, base).replaced[DAYS[0].isoformat()]:
        with open(f"{base}/date={DAYS[0]}/{name}", "wb") as file:
            file.write(b"no Parquet")
    spark.catalog.clearCache()
    assert ids(history.read_history(spark, root, "tX")) == expected(6, [0])


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_extents_of_days_come_from_footers(spark, tmp_path):
    root = str(tmp_path)
    of = lambda: {tuple(r) for r in history.stored_extents(spark, root, "tX").collect()}
    wanted = lambda n, days: {(DAYS[d], n, MIDNIGHTS[d], MIDNIGHTS[d] + n - 1) for d in days}
    for i in range(4):
        load(spark, root, [i])
    text = plan(history.stored_extents(spark, root, "tX"))
    assert "PushedAggregation: [COUNT(*), MIN(mts), MAX(mts)]" in text and "PushedGroupBy: [date]" in text
    assert of() == wanted(4, (0, 1))
    compaction.compact_history(spark, root, "tX")
    assert of() == wanted(4, (0, 1))  # the replaced files still lie there
    load(spark, root, [4])
    assert of() == wanted(5, (0, 1))
    compaction.remove_replaced(spark, root, "tX", older_than_ms=0)
    load(spark, root, [5])
    text = plan(history.stored_extents(spark, root, "tX"))
    assert text.count("PushedAggregation: [COUNT(*), MIN(mts), MAX(mts)]") >= 2
    assert of() == wanted(6, (0, 1))
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
