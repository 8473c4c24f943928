"""Grid points shared by several applications: each is fitted once."""

from __future__ import annotations

import threading
import time

import pytest
from conftest import SF_SMALL

from basketlens.operators import models
from basketlens.operators.claims import Claims
from basketlens.operators.features import split_train_test
from basketlens.plans import tables

GRID = {"dt": [(2, 32), (3, 32), (4, 32)], "nb": [(1.0, "multinomial"), (0.5, "multinomial"), (2.0, "multinomial")]}


def test_two_sessions_share_a_grid(spark, workdir, monkeypatch):
    fits, lock = [], threading.Lock()
    real = models.make_estimator

    def counted(task, model, point):
        with lock:
            fits.append((model, point))
        return real(task, model, point)

    monkeypatch.setattr(models, "make_estimator", counted)
    out, errors = {}, []

    def search(name):
        try:
            session = spark.newSession()
            train, test = split_train_test(tables.labeled(session, SF_SMALL))
            out[name] = models.grid_search(session, "intent", GRID, train, test, f"{workdir}/runs", f"{workdir}/m",
                                           parallel=2).count()
        except Exception as e:  # shown by the assert below
            errors.append(e)

    threads = [threading.Thread(target=search, args=(i,)) for i in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(200)
    assert not errors
    assert out == {0: 6, 1: 6}                               # both return when the whole grid is there
    assert sorted(map(str, fits)) == sorted(str((m, p)) for m, ps in GRID.items() for p in ps)
    assert models.read_runs(spark, f"{workdir}/runs").count() == 6


def test_claims_are_held_kept_fresh_and_taken_over(spark, workdir):
    with Claims(spark, f"{workdir}/c", lease=2.0) as one:
        two = Claims(spark, f"{workdir}/c", lease=2.0)
        claim = one.take("point")
        assert claim and two.take("point") is None and one.take("point") is None
        time.sleep(4)
        assert two.take("point") is None                     # its owner lives: the file is fresh
    time.sleep(3)
    assert two.take("point").endswith("/1")                  # the owner is gone: the next attempt
    assert one.take("point") is None


def test_failed_work_frees_its_point(spark, workdir, monkeypatch):
    train, test = split_train_test(tables.labeled(spark, SF_SMALL))
    grid = {"dt": [(2, 32)]}

    def fails(*_):
        raise ValueError("no fit")

    with monkeypatch.context() as m:
        m.setattr(models, "make_estimator", fails)
        with pytest.raises(ValueError):
            models.grid_search(spark, "intent", grid, train, test, f"{workdir}/runs", f"{workdir}/m")
    assert models.grid_search(spark, "intent", grid, train, test, f"{workdir}/runs", f"{workdir}/m").count() == 1


def test_training_after_counted_cleaning(spark, workdir):
    """A session that has observed metrics trains and evaluates models with summaries."""
    from basketlens.plans import growth
    assert growth.clean_and_count(spark, tables.raw_events(spark, SF_SMALL)).count() > 0
    train, test = split_train_test(tables.labeled(spark, SF_SMALL))
    grid = {"lr": [(50, 0.0, 0.0)], "rf": [(5, 3, 32)]}
    runs = models.grid_search(spark, "intent", grid, train, test, f"{workdir}/runs", f"{workdir}/m")
    assert runs.filter("auc is not null").count() == 2
