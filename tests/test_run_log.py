"""Leases, numbers and compaction of the run log; scratch folders."""

import subprocess
import sys
import textwrap
import time
from pathlib import Path

from stardw.plans import meta
from stardw.session import counted_cut, lasting_scratch, passing_scratch, scratch_dir


def statuses(log):
    return {r.run_id: (r.job_name, r.status) for r in log.latest(100).collect()}


def test_a_run_whose_driver_is_gone_is_closed_as_lost(spark, store):
    gone = meta.RunLog(store, lease_seconds=2)
    open_run = gone.run("perdu")
    open_run.__enter__()
    alive = meta.RunLog(store, lease_seconds=60)
    with alive.run("vivant"):
        # While its driver renews the lease a run stays open.
        time.sleep(2.5)
        assert meta.RunLog(store).close_lost() == []
        gone._open = 0  # the heartbeat ends with its driver
        gone._wake.set()
        time.sleep(2.5)
        with meta.RunLog(store).run("suivant"):
            assert statuses(alive) == {1: ("perdu", "LOST"), 2: ("vivant", "RUNNING"), 3: ("suivant", "RUNNING")}
    assert statuses(alive) == {1: ("perdu", "LOST"), 2: ("vivant", "SUCCESS"), 3: ("suivant", "SUCCESS")}
    assert meta.RunLog(store).close_lost() == []
    lost = [r for r in alive.latest().collect() if r.run_id == 1][0]
    assert lost.ended_at is not None and "driver" in lost.error_msg and lost.rows_in is None


def test_drivers_take_different_numbers(spark, store):
    one, other = meta.RunLog(store), meta.RunLog(store)
    assert (one._new_id(), other._new_id()) == (1, 1)
    one._next = other._next = 1
    with one.run("a"), other.run("b"), one.run("c"):
        pass
    assert sorted(statuses(one).values()) == [("a", "SUCCESS"), ("b", "SUCCESS"), ("c", "SUCCESS")]
    assert len(statuses(one)) == 3


def test_closed_runs_become_a_table(spark, store):
    log = meta.RunLog(store)
    with log.run("ouvert"):
        for n in range(7):
            with log.run(f"essai {n}") as run:
                run.rows_in = n
        before = statuses(log)
        assert not log.compact(most=7) and log.compact(most=3)
        # The open run keeps its file; the listing has no more than that.
        assert log._names() == ["000000000001.start.json"]
        assert statuses(log) == before and len(before) == 8
        with log.run("encore"):
            pass
        assert log.compact(most=0)
    assert len(log._names()) == 2
    after = meta.RunLog(store)
    assert len(statuses(after)) == 9 and {s for _, s in statuses(after).values()} == {"SUCCESS"}
    assert after.read().filter("rows_in = 6").count() == 1
    assert meta.RunLog(store)._new_id() == 10


def test_what_a_load_writes_on_the_way_goes_with_it(spark):
    kept = Path(scratch_dir(spark, "x")).parent
    with passing_scratch(spark):
        passing, n = counted_cut(spark.range(5).toDF("a"))
        folder = Path(scratch_dir(spark, "y")).parent
        with lasting_scratch():
            lasting, _ = counted_cut(spark.range(3).toDF("a"))
        with passing_scratch(spark):
            assert Path(scratch_dir(spark, "z")).parent == folder
        assert n == passing.count() == 5 and folder.exists() and folder != kept
    assert not folder.exists() and lasting.count() == 3
    assert Path(scratch_dir(spark, "x")).parent == kept


def test_no_folder_is_left_after_a_session(tmp_path):
    code = textwrap.dedent(f"""
        import sys; sys.path.insert(0, {str(Path(__file__).parents[1])!r})
        from stardw.session import build_session, counted_cut, sweep
        spark = build_session("x", "local[1]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path)!r}}})
        old = spark._jvm.java.io.File({str(tmp_path / "stardw-dead" / "cut-1")!r}); old.mkdirs()
        print(counted_cut(spark.range(4).toDF("a"))[1], sweep(spark, days=1), sweep(spark, days=-1))
    """)
    made = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert made.stdout.strip().endswith("4 [] ['stardw-dead']"), made.stderr[-2000:]
    # Spark's own folder for checkpoints is Spark's to keep.
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("stardw")]
