import os

import pytest

from pointcluster import kmeans, tree_kmeans
from pointcluster.plans import kmeans as lloyd_plan
from pointcluster.plans.roundlog import RoundLog


def numbers(run):
    return run.centers, run.label_centers, [r[:3] for r in run.history_rows]


class Killed(BaseException):
    pass


@pytest.mark.parametrize("method", [kmeans, tree_kmeans])
@pytest.mark.parametrize("init", [None, "k-means||"])
def test_stopped_run_ends_like_one_that_was_not(random_points, tmp_path, monkeypatch, method, init):
    _, points = random_points(300)
    points = points.coalesce(1)  # sums in one order
    log = str(tmp_path / "rounds")
    whole = numbers(method(points, 4, 6, 0.0, init=init))
    real = lloyd_plan.moved

    def stop_in_round_four(*args):
        if args[-1] == 4:
            raise Killed
        return real(*args)

    monkeypatch.setattr(lloyd_plan, "moved", stop_in_round_four)
    with pytest.raises(Killed):
        method(points, 4, 6, 0.0, init=init, resume=log)
    assert sorted(os.listdir(log)) == ["round-1", "round-2", "round-3", "run"]
    monkeypatch.setattr(lloyd_plan, "moved", real)
    rounds = []
    monkeypatch.setattr(lloyd_plan, "moved", lambda *a: rounds.append(a[-1]) or real(*a))
    assert numbers(method(points, 4, 6, 0.0, init=init, resume=log)) == whole
    assert rounds == [4, 5, 6]
    # a finished run is read back, more rounds go on from it
    assert numbers(method(points, 4, 6, 0.0, init=init, resume=log)) == whole
    assert rounds == [4, 5, 6]
    assert len(method(points, 4, 7, 0.0, init=init, resume=log).history_rows) == 7


def test_tolerance_ends_a_resumed_run(random_points, tmp_path):
    _, points = random_points(300)
    log = str(tmp_path / "rounds")
    first = kmeans(points, 3, 20, 0.05, resume=log)
    again = kmeans(points, 3, 20, 0.05, resume=log)
    assert numbers(first) == numbers(again) and len(first.history_rows) < 20


def test_round_cut_off_while_written_is_run_again(random_points, tmp_path, monkeypatch):
    _, points = random_points(200)
    points = points.coalesce(1)
    log = str(tmp_path / "rounds")
    whole = numbers(kmeans(points, 3, 4, 0.0))
    commit = RoundLog.commit

    def half(self, row, centers):
        if row[0] == 3:
            os.makedirs(f"{self.folder}/round-3.staged-x")  # no rename came
            raise Killed
        commit(self, row, centers)

    monkeypatch.setattr(RoundLog, "commit", half)
    with pytest.raises(Killed):
        kmeans(points, 3, 4, 0.0, resume=log)
    monkeypatch.setattr(RoundLog, "commit", commit)
    assert numbers(kmeans(points, 3, 4, 0.0, resume=log)) == whole


def test_other_parameters_are_refused(random_points, tmp_path):
    _, points = random_points(100)
    log = str(tmp_path / "rounds")
    kmeans(points, 3, 2, 0.0, resume=log)
    before = sorted(os.listdir(log))
    for other in (dict(k=4), dict(k=3, seed=1), dict(k=3, empty="reseed"), dict(k=3, limit=50)):
        with pytest.raises(ValueError, match="other parameters"):
            kmeans(points, max_iterations=2, tol=0.0, resume=log, **other)
    with pytest.raises(ValueError, match="other parameters"):
        tree_kmeans(points, 3, 2, 0.0, resume=log)
    assert sorted(os.listdir(log)) == before
