"""Search for parameters: Parzen estimators propose, Hyperband prunes.

A space names for each parameter its choices, or a range on a plain or logarithmic scale. The
sampler splits the trials seen so far, each judged by what it scored last and what others gained from there on, into the
best few and the rest, models each parameter in both by a mixture around the seen values (counts for
choices, normal curves for ranges; both with a share of the prior), and proposes of a number of draws
from the better part's model the one whose density there exceeds that in the rest's the most.

Hyperband runs brackets of successive halving: one starts many trials on little resource, another few
on much; after each rung the best third goes on with three times the resource. The number of
trials is fixed; brackets follow one another until it is used up.

Scores are to be large. Nothing here knows Spark: a trial is one call of the objective, whose work Spark does.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable
from dataclasses import dataclass, field

GOOD_SHARE = 0.15
DRAWS = 24
LEAST_SEEN = 10
ETA = 3


@dataclass(frozen=True)
class Choice:
    options: tuple

    def drawn(self, rng: random.Random):
        return rng.choice(self.options)


@dataclass(frozen=True)
class Range:
    low: float
    high: float
    log: bool = False

    def drawn(self, rng: random.Random) -> float:
        return self.back(rng.uniform(*self.bounds))

    @property
    def bounds(self) -> tuple[float, float]:
        return (math.log(self.low), math.log(self.high)) if self.log else (self.low, self.high)

    def inner(self, value: float) -> float:
        return math.log(value) if self.log else value

    def back(self, inner: float) -> float:
        return math.exp(inner) if self.log else inner


Space = dict[str, Choice | Range]


def drawn(space: Space, rng: random.Random) -> dict:
    return {name: part.drawn(rng) for name, part in space.items()}


class _Curves:
    """A mixture of normal curves at the seen values and one as wide as the range, cut at its ends."""

    def __init__(self, part: Range, seen: list[float]):
        self.low, self.high = part.bounds
        span = self.high - self.low
        at = sorted(part.inner(v) for v in seen)
        self.curves = [((self.low + self.high) / 2, span)]
        for i, v in enumerate(at):  # as wide as the larger gap to a neighbour, within bounds
            gaps = [v - (at[i - 1] if i else self.low), (at[i + 1] if i + 1 < len(at) else self.high) - v]
            self.curves.append((v, min(max(*gaps, span / min(100, 1 + len(at))), span)))

    def drawn(self, rng: random.Random) -> float:
        at, wide = rng.choice(self.curves)
        for _ in range(100):
            x = rng.gauss(at, wide)
            if self.low <= x <= self.high:
                return x
        return min(max(at, self.low), self.high)

    def density(self, x: float) -> float:
        def inside(at: float, wide: float) -> float:
            up, down = (math.erf((end - at) / wide / math.sqrt(2)) for end in (self.high, self.low))
            return (up - down) / 2

        return sum(math.exp(-(((x - at) / wide) ** 2) / 2) / (wide * math.sqrt(2 * math.pi)) / inside(at, wide) for at, wide in self.curves) / len(self.curves)


class _Counts:
    def __init__(self, part: Choice, seen: list):
        self.weights = {o: 1 + sum(v == o for v in seen) for o in part.options}

    def drawn(self, rng: random.Random):
        return rng.choices(list(self.weights), list(self.weights.values()))[0]

    def density(self, x) -> float:
        return self.weights[x] / sum(self.weights.values())


def proposed(space: Space, seen: list[tuple[dict, float]], rng: random.Random) -> dict:
    """Parameters that look like those of the best trials and unlike those of the others; drawn at random while few are seen."""
    if len(seen) < LEAST_SEEN:
        return drawn(space, rng)
    ranked = sorted(seen, key=lambda t: -t[1])
    n_good = max(2, math.ceil(GOOD_SHARE * len(ranked)))
    good, rest = ranked[:n_good], ranked[n_good:]
    out = {}
    for name, part in space.items():
        kind = _Counts if isinstance(part, Choice) else _Curves
        better, worse = (kind(part, [p[name] for p, _ in some]) for some in (good, rest))
        picked = max((better.drawn(rng) for _ in range(DRAWS)), key=lambda x: better.density(x) / max(worse.density(x), 1e-300))
        out[name] = part.back(picked) if isinstance(part, Range) else picked
    return out


@dataclass
class Trial:
    params: dict
    #: Resource -> score, one for each rung that the trial was in.
    scores: dict[int, float] = field(default_factory=dict)
    pruned: bool = False

    @property
    def last(self) -> tuple[int, float]:
        resource = max(self.scores)
        return resource, self.scores[resource]


def brackets(most: int, least: int = 1, eta: int = ETA) -> list[list[tuple[int, int]]]:
    """Rungs (trials, resource) of each bracket, the one of most trials first."""
    steps = 0
    while least * eta ** (steps + 1) <= most:
        steps += 1
    out = []
    for s in range(steps, -1, -1):
        n = math.ceil((steps + 1) / (s + 1) * eta**s)
        out.append([(max(1, n // eta**i), max(least, round(most / eta ** (s - i)))) for i in range(s + 1)])
    return out


def _seen(trials: list[Trial]) -> list[tuple[dict, float]]:
    """Every trial with what it would have scored on the most resource: its last score, and what those that went on gained from there on average."""
    levels = sorted({r for t in trials for r in t.scores})
    ahead = {levels[-1]: 0.0} if levels else {}
    for low, high in reversed(list(itertools.pairwise(levels))):
        gains = [t.scores[high] - t.scores[low] for t in trials if low in t.scores and high in t.scores]
        ahead[low] = ahead[high] + (sum(gains) / len(gains) if gains else 0.0)
    return [(t.params, t.last[1] + ahead[t.last[0]]) for t in trials]


def search(space: Space, objective: Callable[[dict, int], float], *, trials: int, most: int, least: int = 1, seed: int = 42, eta: int = ETA, propose=proposed) -> list[Trial]:
    """All trials. ``objective(params, resource)`` is called once for each trial and rung; a trial that does not reach ``most`` is pruned."""
    if trials < 1:
        raise ValueError("search: at least one trial")
    rng, done = random.Random(seed), []
    plan = brackets(most, min(least, most), eta)
    turn = 0
    while len(done) < trials:
        rungs = plan[turn % len(plan)]
        turn += 1
        left = trials - len(done)
        going: list[Trial] = []
        if left < rungs[0][0]:  # the last bracket is the widest that is left room for
            rungs = next((b for b in plan if b[0][0] <= left), plan[-1])
        for _ in range(min(rungs[0][0], left)):
            trial = Trial(propose(space, _seen(done), rng))
            trial.scores[rungs[0][1]] = objective(trial.params, rungs[0][1])
            done.append(trial)
            going.append(trial)
        for (_, before), (n, resource) in zip(rungs, rungs[1:], strict=False):
            going.sort(key=lambda t: -t.scores[before])
            for t in going[n:]:
                t.pruned = True
            going = going[:n]
            for t in going:
                t.scores[resource] = objective(t.params, resource)
    return done


def best_of(trials: list[Trial]) -> Trial:
    """The best of those that had the most resource."""
    most = max(t.last[0] for t in trials)
    return max((t for t in trials if t.last[0] == most), key=lambda t: t.scores[most])
