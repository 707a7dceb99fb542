"""Search that learns from finished trials and drops losers early.

Settings are drawn where the density of good trials is high against that of the others (a density ratio, one
setting at a time). Trials come in brackets: all of a bracket are fitted with a small share of their resource, the best
part goes on with more, the last ones with all of it. Suggestions are functions of the seed, the trial's number and
the trials of earlier brackets, so results do not depend on which trial of a bracket ends first.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

Space = Mapping[str, tuple]

#: Trials drawn blindly, share of trials that count as good, proposals per setting, weight of the whole range in
#: points, least bandwidth. Few proposals and a wide least bandwidth keep it from settling on the first good trials.
STARTUP = 10
GOOD_SHARE = 0.1
PROPOSALS = 8
PRIOR = 2.0
LEAST_WIDTH = 0.2
RUNGS = 3
REDUCTION = 3
PARALLEL = 4


@dataclass
class Trial:
    """One setting and its score at every rung it reached."""

    number: int
    settings: dict[str, object]
    resources: list[int] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)

    @property
    def merit(self) -> tuple[int, float]:
        """Survivors of a rung stand above those it dropped; NaN scores stand last."""
        score = self.scores[-1] if self.scores else math.nan
        return len(self.scores), -math.inf if math.isnan(score) else score


def _at(spec: tuple, share: float) -> object:
    """The value at a share of the range; logarithmic kinds are cut in the logarithm."""
    kind, low, high, *step = spec
    if kind == "int":
        return low + step[0] * min(round(share * ((high - low) // step[0])), (high - low) // step[0])
    if kind == "float":
        return low + share * (high - low)
    value = math.exp(math.log(low) + share * (math.log(high) - math.log(low)))
    return min(max(round(value), low), high) if kind == "log_int" else min(max(value, low), high)


def _share(spec: tuple, value) -> float:
    kind, low, high, *_ = spec
    if high == low:
        return 0.5
    if kind in ("int", "float"):
        return (value - low) / (high - low)
    return math.log(value / low) / math.log(high / low)


def _density(points: Sequence[float], width: float, x: float) -> float:
    """Mixture of the uniform density and a normal one around every point, cut to the range."""
    total = PRIOR
    for p in points:
        inside = 0.5 * (math.erf((1 - p) / (width * math.sqrt(2))) - math.erf(-p / (width * math.sqrt(2))))
        total += math.exp(-0.5 * ((x - p) / width) ** 2) / (width * math.sqrt(2 * math.pi)) / max(inside, 1e-12)
    return total / (len(points) + PRIOR)


def _width(points: Sequence[float]) -> float:
    """Bandwidth: narrows as points gather, never to nothing."""
    mean = sum(points) / len(points)
    spread = math.sqrt(sum((p - mean) ** 2 for p in points) / len(points))
    return max(1.06 * spread * len(points) ** -0.2, LEAST_WIDTH)


def _numeric(spec: tuple, good: Sequence, other: Sequence, chance: random.Random) -> object:
    fine, rest = [_share(spec, v) for v in good], [_share(spec, v) for v in other]
    narrow, wide = _width(fine), _width(rest) if rest else 1.0
    best, best_ratio = 0.5, -math.inf
    for _ in range(PROPOSALS):
        place = chance.randrange(len(fine) + 1)
        x = chance.random() if place == len(fine) else chance.gauss(fine[place], narrow)
        x = min(max(x, 0.0), 1.0)
        ratio = math.log(_density(fine, narrow, x)) - math.log(_density(rest, wide, x))
        if ratio > best_ratio:
            best, best_ratio = x, ratio
    return _at(spec, best)


def _choice(options: Sequence, good: Sequence, other: Sequence, chance: random.Random) -> object:
    def share(of: Sequence, option) -> float:
        return (of.count(option) + PRIOR / len(options)) / (len(of) + PRIOR)

    proposed = chance.choices(options, [share(good, o) for o in options], k=PROPOSALS)
    return max(sorted(set(proposed), key=options.index), key=lambda o: share(good, o) / share(other, o))


def suggest(space: Space, finished: Sequence[Trial], number: int, seed: int) -> dict[str, object]:
    """Settings of trial ``number`` given finished ones."""
    chance = random.Random(f"{seed}:{number}")
    if len(finished) < STARTUP:
        return {
            name: chance.choice(spec[1:]) if spec[0] == "choice" else _at(spec, chance.random())
            for name, spec in space.items()
        }
    ranked = sorted(finished, key=lambda t: (t.merit, -t.number), reverse=True)
    cut = max(2, math.ceil(GOOD_SHARE * len(ranked)))
    found = {}
    for name, spec in space.items():
        good, other = [t.settings[name] for t in ranked[:cut]], [t.settings[name] for t in ranked[cut:]]
        if spec[0] == "choice":
            found[name] = _choice(list(spec[1:]), good, other, chance)
        else:
            found[name] = _numeric(spec, good, other, chance)
    return found


def resource_at(full: int, rung: int, rungs: int, reduction: int) -> int:
    return max(1, round(full / reduction ** (rungs - 1 - rung)))


def halving_search(
    space: Space,
    evaluate: Callable[[dict[str, object], int], float],
    resource: str,
    trials: int,
    seed: int,
    rungs: int = RUNGS,
    reduction: int = REDUCTION,
    parallel: int = PARALLEL,
    wrap: Callable = lambda f: f,
) -> list[Trial]:
    """All trials, best first. ``evaluate`` scores settings with an amount of their ``resource`` (greater is better).

    A bracket has ``reduction ** (rungs - 1)`` trials, one of which gets its whole resource; NaN loses. ``wrap``
    prepares ``evaluate`` for the threads that run ``parallel`` trials at a time.
    """
    done: list[Trial] = []
    size = reduction ** (rungs - 1)
    while len(done) < trials:
        first = len(done)
        bracket = [
            Trial(number, suggest(space, done, number, seed)) for number in range(first, min(first + size, trials))
        ]
        left = bracket
        for rung in range(rungs):
            amounts = [resource_at(int(t.settings[resource]), rung, rungs, reduction) for t in left]
            with ThreadPool(parallel) as pool:
                scores = pool.starmap(wrap(evaluate), [(t.settings, a) for t, a in zip(left, amounts)], chunksize=1)
            for trial, amount, score in zip(left, amounts, scores):
                trial.resources.append(amount)
                trial.scores.append(score)
            left = sorted(left, key=lambda t: (t.merit, -t.number), reverse=True)[: max(1, len(left) // reduction)]
        done += bracket
    return sorted(done, key=lambda t: (t.merit, -t.number), reverse=True)
