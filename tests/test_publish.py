"""Publishing is all or nothing: whatever fails, readers find the tables of one run."""

import threading

import pytest

from inboxlens.plans import publish
from inboxlens.plans.publish import Files, Run, current_build, read_build

NAMES = ["campaigns", "int_campaign_activities_by_member", "stg_lists"]


def build_once(spark, target, value, **options):
    with Run(spark, target, **options) as run:
        for name in NAMES:
            run.save(name, spark.range(value, value + 1))
        published = run.publish(NAMES)
        run.tidy(published)
    return published


def values(spark, target):
    """What a reader gets of each table."""
    return {df.first().id for df in read_build(spark, target).values()}


def folders(tmp_path):
    return sorted({p.name for base in ("m", "m_stg") for p in (tmp_path / base / "_runs").iterdir()})


def test_builds_follow_one_another(spark, tmp_path):
    target = str(tmp_path / "m")
    assert current_build(spark, target) is None
    with pytest.raises(FileNotFoundError):
        read_build(spark, target)
    runs = [build_once(spark, target, i).run for i in range(4)]
    assert values(spark, target) == {3} and current_build(spark, target).number == 4
    assert folders(tmp_path) == sorted(runs[-2:])  # two builds are kept
    assert len([p for p in (tmp_path / "m" / "_builds").iterdir() if p.suffix == ".json"]) == 2


def test_a_failure_at_any_step_leaves_one_whole_build(spark, tmp_path, monkeypatch):
    """Every call to the file system fails once, in turn, with the ones before it done."""
    steps = ("names", "write", "rename", "delete")
    n, done = 0, False
    while not done:
        target = str(tmp_path / str(n) / "m")
        build_once(spark, target, 1, keep=1)
        calls = 0
        with monkeypatch.context() as patch:
            for step in steps:
                def failing(self, *args, real=getattr(Files, step)):
                    nonlocal calls
                    calls += 1
                    if calls == n + 1:
                        raise OSError("lost")
                    return real(self, *args)
                patch.setattr(Files, step, failing)
            try:
                build_once(spark, target, 2, keep=1)
                done = True  # fewer steps than n
            except OSError:
                pass
        assert values(spark, target) in ({1}, {2})
        # the next build puts everything right
        last = build_once(spark, target, 3, keep=1, stale_hours=-1)
        assert values(spark, target) == {3} and folders(tmp_path / str(n)) == [last.run]
        n += 1
    assert n > 6


def test_what_a_killed_run_left_is_swept_when_it_is_old(spark, tmp_path):
    target = str(tmp_path / "m")
    killed = Run(spark, target)
    killed.save("campaigns", spark.range(1))
    first = build_once(spark, target, 1)
    assert folders(tmp_path) == sorted([first.run, killed.run])  # it may still be running
    second = build_once(spark, target, 2, stale_hours=-1)
    assert folders(tmp_path) == sorted([first.run, second.run])


def test_runs_at_the_same_time_do_not_mix(spark, tmp_path):
    target = str(tmp_path / "m")
    written = threading.Barrier(3)

    def run(value):
        with Run(spark, target) as r:
            for name in NAMES:
                r.save(name, spark.range(value, value + 1))
            written.wait()
            r.tidy(r.publish(NAMES))

    threads = [threading.Thread(target=run, args=(i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert values(spark, target) in ({0}, {1}, {2})
    later = build_once(spark, target, 9, keep=1)
    assert values(spark, target) == {9} and folders(tmp_path) == [later.run]


def test_a_failing_run_deletes_its_tables(spark, tmp_path):
    target = str(tmp_path / "m")
    build_once(spark, target, 1)
    with pytest.raises(RuntimeError):
        with Run(spark, target) as run:
            run.save("campaigns", spark.range(1))
            raise RuntimeError("broken")
    assert folders(tmp_path) == [current_build(spark, target).run] and values(spark, target) == {1}


def test_run_names_tell_their_age():
    assert publish._RUN.fullmatch("r20240131235959_0123abcd")[1] == "20240131235959"
