import math
import random

import pytest

from failcast.operators import search as S

SPACE = {"rate": S.Range(1e-4, 1.0, log=True), "share": S.Range(0.0, 1.0), "depth": S.Choice((2, 3, 4, 5, 6, 7)), "kind": S.Choice(("a", "b", "c"))}


def truth(params, resource, most=27):
    """Best at 0.01, 0.7, 5 and b; little resource shows it through a bias."""
    off = (math.log10(params["rate"]) + 2) ** 2 + 4 * (params["share"] - 0.7) ** 2 + 0.3 * (params["depth"] - 5) ** 2 + (params["kind"] != "b")
    return -off - 0.5 * params["share"] * (1 - resource / most)


def test_proposals_beat_random_draws():
    better = 0
    for seed in range(10):
        best = []
        for propose in (S.proposed, lambda space, seen, rng: S.drawn(space, rng)):
            done = S.search(SPACE, truth, trials=60, most=27, seed=seed, propose=propose)
            best.append(S.best_of(done).last[1])
        better += best[0] > best[1]
    assert better >= 7


def test_brackets_and_pruning():
    plan = S.brackets(27)
    assert plan[0] == [(27, 1), (9, 3), (3, 9), (1, 27)] and plan[-1] == [(4, 27)]
    assert all(rungs[-1][1] == 27 for rungs in plan) and S.brackets(1) == [[(1, 1)]]
    spent = []
    done = S.search(SPACE, lambda p, r: spent.append(r) or truth(p, r), trials=40, most=27, seed=3)
    assert len(done) == 40 and sum(spent) < 40 * 27 / 2
    assert all(t.pruned == (27 not in t.scores) for t in done) and not S.best_of(done).pruned


@pytest.mark.parametrize("trials", [1, 2, 5, 9, 30])
def test_some_trial_has_all_resource_and_reruns_agree(trials):
    runs = [S.search(SPACE, truth, trials=trials, most=9, seed=1) for _ in range(2)]
    assert [t.params for t in runs[0]] == [t.params for t in runs[1]]
    assert len(runs[0]) == trials and S.best_of(runs[0]).last[0] == 9
    with pytest.raises(ValueError):
        S.search(SPACE, truth, trials=0, most=9)


def test_proposals_stay_in_the_space():
    rng = random.Random(0)
    seen = [(S.drawn(SPACE, rng), rng.random()) for _ in range(20)] + [({"rate": 1e-4, "share": 1.0, "depth": 2, "kind": "c"}, 2.0)] * 5
    for _ in range(50):
        p = S.proposed(SPACE, seen, rng)
        assert 1e-4 * 0.999 <= p["rate"] <= 1.001 and 0 <= p["share"] <= 1 and p["depth"] in SPACE["depth"].options and p["kind"] in "abc"
