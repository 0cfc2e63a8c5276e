"""Concurrent publication and compaction that survives a crash at any step."""

import math
from concurrent.futures import ThreadPoolExecutor

import pytest

from tabforge.sources import catalog, history, versions


def test_put_if_absent_never_replaces(spark, tmp_path):
    path = f"{tmp_path}/a b/v0000000001.json"
    assert versions.put_if_absent(spark, path, "one") and not versions.put_if_absent(spark, path, "two")
    assert open(path).read() == "one"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: versions.put_if_absent(spark, f"{tmp_path}/race", str(i)), range(16)))
    assert sum(won) == 1 and open(f"{tmp_path}/race").read() == str(won.index(True))


def test_writers_at_once_get_their_own_versions(spark, tmp_path):
    root = str(tmp_path)

    def publish(i):
        return catalog.publish_gold(spark.range(i, i + 1).withColumnRenamed("id", "ID"), root, "p")["version"]
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(publish, range(6)))
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    for i, v in enumerate(got):
        assert [r.ID for r in catalog.read_gold(spark, root, "p", version=v).collect()] == [i]
    assert catalog.list_versions(spark, root, "gold", "p").count() == 6
    assert catalog.read_gold(spark, root, "p").first().ID == got.index(6)
    with ThreadPoolExecutor(4) as pool:
        reg = list(pool.map(lambda i: catalog.register_model(spark, root, "m/x", f"path{i}", {"n": i})["version"], range(5)))
    assert sorted(reg) == [1, 2, 3, 4, 5]
    rows = {r.version: r for r in catalog.list_versions(spark, root, "models", "m/x").collect()}
    assert all(rows[v].path == f"path{i}" and rows[v].tags == {"n": str(i)} for i, v in enumerate(reg))


def test_a_failed_publication_leaves_no_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    catalog.publish_gold(spark.range(3).withColumnRenamed("id", "ID"), root, "p")
    monkeypatch.setattr(versions, "put_if_absent", lambda *a: False)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, f"{root}/c", lambda n, last: {}, tries=3)
    monkeypatch.undo()
    with pytest.raises(FileNotFoundError):
        catalog.read_gold(spark, root, "p", version=2)
    assert catalog.read_gold(spark, root, "p").count() == 3


def _delta(folder, n):
    with open(f"{folder}/{n}.csv", "w") as f:
        f.write(f"runId,value\nr{n},{n}\n" if n % 3 else f"value,runId,extra\n{n},r{n},x\n")


def _runs(df):
    return sorted(int(r["value"]) for r in df.collect())


def test_batches_stay_logarithmic(spark, tmp_path, monkeypatch):
    """A hundred compactions; writes are stood in for by sums of weights."""
    folder = str(tmp_path)
    batches = []
    rewritten = 0
    monkeypatch.setattr(history, "_read_batches", lambda s, f, bs: sum(b["weight"] for b in bs))
    monkeypatch.setattr(history, "_write_batch", lambda df, f, weight: {"path": f"b{weight}", "weight": weight, "schema": ""})
    for n in range(1, 101):
        batches.append({"path": f"n{n}", "weight": 1, "schema": ""})
        before = {id(b) for b in batches}
        batches, gone = history._merge_tiers(spark, folder, batches)
        rewritten += sum(b["weight"] for b in batches if id(b) not in before)
        assert sum(b["weight"] for b in batches) == n
        assert len(batches) <= (history.FAN - 1) * (1 + math.ceil(math.log(n, history.FAN)))
    assert rewritten <= 100 * (1 + math.ceil(math.log(100, history.FAN)))


def test_compactions_merge_and_read_every_row_once(spark, tmp_path):
    folder = str(tmp_path)
    for n in range(1, 7):
        _delta(folder, n)
        assert _runs(history.compact_history(spark, folder)) == list(range(1, n + 1))
    _, now = history._manifest(spark, folder)
    assert len(now["batches"]) == 3 and sorted(b["weight"] for b in now["batches"]) == [1, 1, 4]
    assert _runs(history.compact_history(spark, folder)) == list(range(1, 7))


@pytest.mark.parametrize("step", ["_write_batch", "_merge_tiers", "put_if_absent", "_delete", "current_history"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_crash_at_any_step_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, step, when):
    folder = str(tmp_path)
    for n in range(1, 4):
        _delta(folder, n)
        history.compact_history(spark, folder)
    _delta(folder, 4)                                       # the fourth batch fills a tier
    real = getattr(history, step)

    def dies(*a, **k):
        if when == "after":
            real(*a, **k)
        raise KeyboardInterrupt
    monkeypatch.setattr(history, step, dies)
    with pytest.raises(KeyboardInterrupt):
        history.compact_history(spark, folder)
    monkeypatch.undo()
    seen = _runs(history.current_history(spark, folder))
    assert seen in ([1, 2, 3], [1, 2, 3, 4])
    _delta(folder, 5)
    assert _runs(history.compact_history(spark, folder)) == [1, 2, 3, 4, 5]


def test_a_delta_of_an_old_name_is_new_and_a_lost_race_is_repeated(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    _delta(folder, 1)
    history.compact_history(spark, folder)
    import os
    _delta(folder, 1)
    os.utime(f"{folder}/1.csv", (1, 1))
    real, lost = history.put_if_absent, []

    def first_lost(*a):
        if not lost:
            lost.append(1)
            return False
        return real(*a)
    monkeypatch.setattr(history, "put_if_absent", first_lost)
    assert _runs(history.compact_history(spark, folder)) == [1, 1] and lost
