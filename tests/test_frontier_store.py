import datetime as dt
import os

import pytest

from heddle.operators import frontier
from heddle.sources.frontier_store import Conflict, FrontierStore
from tests.test_frontier import T, fetches, hours


def found(spark, urls):
    return spark.createDataFrame([(u, "s", T) for u in urls], "url string, source string, first_seen timestamp")


def urls(host, n):
    return [f"https://{host}/{i}" for i in range(n)]


def folders(store):
    return {b: f for b, (f, _) in store.manifest()["buckets"].items()}


def files(store):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(f"{store.path}/data") for n in names}


@pytest.fixture
def store(spark, tmp_path):
    made = FrontierStore(spark, str(tmp_path / "frontier"), hosts=16, parts=4)
    assert made.add_urls(found(spark, [u for h in range(20) for u in urls(f"h{h}", 50)])) == 1000
    return made


def test_a_batch_rewrites_its_buckets_only(spark, store):
    """A hundredth of the urls, all of one host: four buckets at most; the others' files stay."""
    before, kept = folders(store), files(store)
    batch = fetches(spark, *((u, hours(1), 200, True, "h") for u in urls("h3", 10)))
    store.apply_fetches(batch)
    after, mine = folders(store), {str(b) for b in store.touched(batch)}
    assert 0 < len(mine) <= 4 and {b for b in before if before[b] != after[b]} == mine
    now = files(store)
    assert all(now[f] == at for f, at in kept.items())  # copy on write: nothing is changed in place
    new = [f for f in now if f not in kept and f.endswith(".parquet") and "bucket=" in f]
    assert {f.split("bucket=")[1].split("/")[0] for f in new} == mine
    assert store.state().where("last_status = 200").count() == 10 and store.state().count() == 1000


def test_known_urls_keep_their_state(spark, store):
    store.apply_fetches(fetches(spark, ("https://h1/1", hours(1), 200, True, "x")))
    assert store.add_urls(found(spark, ["https://h1/1", "https://h1/1", "https://new/1", "https://new/1", None, "no host"])) == 2
    rows = {r["url"]: r for r in store.state().where("url in ('https://h1/1', 'https://new/1', 'no host')").collect()}
    assert (rows["https://h1/1"]["content_hash"], rows["https://new/1"]["last_status"], len(rows)) == ("x", None, 3)
    version = store.versions()[-1]
    assert store.add_urls(found(spark, [])) == 0 and store.versions()[-1] == version  # no rows, no version


def test_state_outlives_sessions_and_equals_the_plain_way(spark, store):
    log = [(u, hours(k), 500, False, None) for k in (1, 30) for u in urls("h5", 3)] + [("https://h6/1", hours(2), 200, True, "y"), ("https://unknown/1", hours(1), 200, True, "z")]
    wanted = frontier.apply_fetches(store.state(), fetches(spark, *log)).collect()
    # by batches, through a store that is opened again for each; failures are carried over
    for k in (1, 2, 30):
        FrontierStore(spark, store.path).apply_fetches(fetches(spark, *(r for r in log if r[1] == hours(k))))
    again = FrontierStore(spark, store.path)
    assert sorted(again.state().collect(), key=str) == sorted(wanted, key=str)
    assert {r["gone_date"] for r in again.state().where("url like 'https://h5/_'").collect()} == {None, dt.date(2026, 9, 2)}
    assert (again.hosts, again.parts) == (16, 4)


def test_a_crash_before_the_swap_leaves_the_old_state(spark, store, monkeypatch):
    before, version = folders(store), store.versions()[-1]

    def dies(manifest):
        raise OSError("lost")

    monkeypatch.setattr(store, "_commit", dies)
    with pytest.raises(OSError, match="lost"):
        store.add_urls(found(spark, ["https://h1/new"]))
    again = FrontierStore(spark, store.path)
    assert folders(again) == before and again.versions()[-1] == version and again.state().count() == 1000


def test_a_second_writer_begins_anew(spark, store, monkeypatch):
    """Another writer commits while a batch is being worked out: neither is lost."""
    other, once = FrontierStore(spark, store.path), []
    plain = store._replace

    def late(buckets, batch, change):
        def meanwhile(rows, state):
            if not once:
                once.append(other.add_urls(found(spark, ["https://h1/other"])))
            return change(rows, state)

        return plain(buckets, batch, meanwhile)

    monkeypatch.setattr(store, "_replace", late)
    assert store.add_urls(found(spark, ["https://h1/mine"])) == 1 and once == [1]
    assert store.state().where("url in ('https://h1/mine', 'https://h1/other')").count() == 2
    with pytest.raises(Conflict):
        store._commit(store.manifest())


def test_cohort_and_vacuum(spark, store):
    store.apply_fetches(fetches(spark, *((u, hours(1), 200, True, "h") for u in urls("h3", 30))))
    store.freeze_cohort(7)
    store.freeze_cohort(5)
    assert frontier.panel_due(store.state()).count() == 12
    assert store.vacuum(hours=24) == 0
    held = store.state().count()
    assert store.vacuum(keep=1, hours=0) >= 1 and len(store.versions()) == 1
    assert store.state().count() == held == 1000


def test_rows_outside_the_batch_are_refused(spark, store):
    version = store.versions()[-1]
    with pytest.raises(ValueError, match="outside the batch"):
        store.update(found(spark, ["https://h1/1"]), lambda batch, state: store.state())
    assert store.versions()[-1] == version
