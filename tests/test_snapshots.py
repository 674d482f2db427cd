"""The totals store: equal totals, cost by batch, replays, crashes and races."""

import json
import os
import random
from datetime import date

import pytest

from shelfsense.streaming.increments import batch_totals
from shelfsense.streaming.snapshots import Manifest, TotalsStore, absorb_stream

SCHEMA = "user_tag string, item_id long, units double, date date"


def batch(spark, seed, n=40):
    rng = random.Random(seed)
    rows = [(f"u{rng.randrange(6)}", rng.randrange(5), float(rng.randint(1, 9)), date(2020, 1, rng.randint(1, 28))) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def bag(df):
    return sorted(tuple(r[c] for c in ("user_tag", "item_id", "bottles", "n_rows", "first_date", "last_date")) for r in df.collect())


def whole(spark, seeds):
    df = batch(spark, seeds[0])
    for seed in seeds[1:]:
        df = df.union(batch(spark, seed))
    return bag(batch_totals(df))


@pytest.mark.parametrize("compact_at", [0.0, 0.5, 1e9])
def test_totals_of_all_batches(spark, tmp_path, compact_at):
    store = TotalsStore(spark, str(tmp_path), compact_at=compact_at)
    assert store.totals() is None and store.changed() is None and store.manifest() == Manifest()
    for number in range(4):
        store.absorb(batch(spark, number), number)
        assert bag(store.totals()) == whole(spark, range(number + 1))
    store.compact()
    now = store.manifest()
    assert now.parts == [] and now.snapshot_rows == store.totals().count() and now.last_batch == 3
    assert store.compact() == now


def test_a_batch_does_not_read_what_was_before(spark, tmp_path):
    store = TotalsStore(spark, str(tmp_path), compact_at=1e9)
    for number in range(3):
        store.absorb(batch(spark, number), number)
    store.compact()
    snapshot = tmp_path / "parts" / store.manifest().snapshot
    os.chmod(snapshot, 0)
    hidden = snapshot.with_name("hidden")
    snapshot.rename(hidden)  # a reader of the snapshot would fail now
    store.absorb(batch(spark, 3), 3)
    hidden.rename(snapshot)
    os.chmod(snapshot, 0o755)
    assert bag(store.totals()) == whole(spark, range(4))


def test_work_of_compaction_is_bounded(spark, tmp_path):
    store, rewritten = TotalsStore(spark, str(tmp_path), compact_at=0.5), 0
    last = None
    for number in range(12):
        now = store.absorb(batch(spark, number, n=5), number)
        if now.snapshot != last:
            rewritten, last = rewritten + now.snapshot_rows, now.snapshot
        assert now.part_rows <= max(0.5 * now.snapshot_rows, 5)
    assert rewritten < 6 * 30 + 30  # at most 30 keys a snapshot; far from one rewrite a batch at full size


def test_replayed_batch_counts_once(spark, tmp_path):
    store = TotalsStore(spark, str(tmp_path))
    store.absorb(batch(spark, 0), 0)
    before = store.absorb(batch(spark, 1), 1)
    assert store.absorb(batch(spark, 1), 1) == before and store.absorb(batch(spark, 0), 0) == before
    assert bag(store.totals()) == whole(spark, [0, 1])


def test_crash_between_write_and_switch(spark, tmp_path, monkeypatch):
    store = TotalsStore(spark, str(tmp_path), compact_at=1e9)
    store.absorb(batch(spark, 0), 0)
    with monkeypatch.context() as broken:
        broken.setattr(TotalsStore, "_switch", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("power cut")))
        with pytest.raises(RuntimeError):
            store.absorb(batch(spark, 1), 1)
        with pytest.raises(RuntimeError):
            store.compact()
    assert bag(store.totals()) == whole(spark, [0])  # readers still see the old state
    store.absorb(batch(spark, 1), 1)
    assert bag(store.totals()) == whole(spark, [0, 1])
    assert len(store.vacuum()) == 2 and store.vacuum() == []
    assert bag(store.totals()) == whole(spark, [0, 1])


def test_of_two_writers_one_fails(spark, tmp_path):
    store = TotalsStore(spark, str(tmp_path))
    old = store.manifest()
    store._switch(old, last_batch=0)
    with pytest.raises(FileExistsError):
        store._switch(old, last_batch=7)
    assert store.manifest().last_batch == 0
    assert [json.loads(f.read_text())["number"] for f in (tmp_path / "manifests").iterdir() if f.name.isdigit()] == [1]


def test_totals_of_changed_keys(spark, tmp_path):
    store = TotalsStore(spark, str(tmp_path), compact_at=1e9)
    store.absorb(batch(spark, 0), 0)
    store.compact()
    newest = batch(spark, 1, n=3)
    store.absorb(newest, 1)
    keys = {(r.user_tag, r.item_id) for r in newest.collect()}
    everything = bag(batch_totals(batch(spark, 0).union(newest)))
    assert bag(store.changed()) == [r for r in everything if r[:2] in keys]


def test_streams(spark, tmp_path):
    source, store = tmp_path / "in", TotalsStore(spark, str(tmp_path / "store"))
    source.mkdir()
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    progress = str(tmp_path / "progress")
    assert absorb_stream(stream, lambda b: b, store, progress).count() == 0
    for call in range(2):
        for part in range(2):
            batch(spark, 2 * call + part).coalesce(1).write.mode("append").parquet(str(source))
        totals = absorb_stream(stream, lambda b: b, store, progress)
        assert bag(totals) == whole(spark, range(2 * call + 2))
    assert store.manifest().last_batch == 3
