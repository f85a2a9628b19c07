"""Guided choice of the next point of a search: densities of good and of other trials, several parameters at once."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from statistics import NormalDist

NORMAL = NormalDist()
GOOD_SHARE, MOST_GOOD = 0.1, 25
CANDIDATES = 24


@dataclass(frozen=True)
class Range:
    """Bounds of a parameter, both included; searched by its logarithm or in whole numbers where told."""
    low: float
    high: float
    log: bool = False
    whole: bool = False

    def draw(self, rng: random.Random) -> float:
        return self.value(rng.random())

    def holds(self, value: float) -> bool:
        return self.low <= value <= self.high

    def unit(self, value: float) -> float:
        """Place in [0, 1]. A whole number stands in the middle of a cell of its own."""
        if self.whole:
            return (value - self.low + 0.5) / (self.high - self.low + 1)
        if self.log:
            return math.log(value / self.low) / math.log(self.high / self.low)
        return (value - self.low) / (self.high - self.low)

    def value(self, unit: float) -> float:
        if self.whole:
            return int(min(self.high, self.low + math.floor(unit * (self.high - self.low + 1))))
        if self.log:
            return min(self.high, max(self.low, self.low * (self.high / self.low) ** unit))
        return self.low + unit * (self.high - self.low)

    @property
    def cell(self) -> float:
        """Width of a whole number's cell, 0 for other parameters."""
        return 1 / (self.high - self.low + 1) if self.whole else 0.0


class Density:
    """An even mix of the uniform density and one product of normal kernels, cut to the ranges, for each point.

    Kernels join all parameters of a point, so that values which are good together are drawn together.
    Their width falls with the number of points as it does for the number of parameters.
    """

    def __init__(self, space: Mapping[str, Range], points: Sequence[Mapping[str, float]]):
        self.space = dict(space)
        self.centres = [[r.unit(p[n]) for n, r in self.space.items()] for p in points]
        self.width = 0.2 * max(1, len(points)) ** (-1 / (len(self.space) + 4))

    def _between(self, centre: float, a: float, b: float) -> float:
        return NORMAL.cdf((b - centre) / self.width) - NORMAL.cdf((a - centre) / self.width)

    def _kernel(self, r: Range, centre: float, u: float) -> float:
        whole = self._between(centre, 0.0, 1.0)
        if r.whole:
            return self._between(centre, max(0.0, u - r.cell / 2), min(1.0, u + r.cell / 2)) / whole
        return NORMAL.pdf((u - centre) / self.width) / (self.width * whole)

    def at(self, point: Mapping[str, float]) -> float:
        """Density; a whole number's cell counts by its mass."""
        units = [r.unit(point[n]) for n, r in self.space.items()]
        total = math.prod(r.cell or 1.0 for r in self.space.values())
        for centre in self.centres:
            total += math.prod(self._kernel(r, c, u) for r, c, u in zip(self.space.values(), centre, units))
        return total / (len(self.centres) + 1)

    def draw(self, rng: random.Random) -> dict[str, float]:
        k = rng.randrange(len(self.centres) + 1)
        if k == len(self.centres):
            return {n: r.draw(rng) for n, r in self.space.items()}
        out = {}
        for (n, r), c in zip(self.space.items(), self.centres[k]):
            low, high = NORMAL.cdf(-c / self.width), NORMAL.cdf((1 - c) / self.width)
            p = min(1 - 1e-15, max(1e-15, low + rng.random() * (high - low)))
            out[n] = r.value(min(1.0, max(0.0, c + self.width * NORMAL.inv_cdf(p))))
        return out


def propose(trials: Sequence[tuple[Mapping[str, float], float]], space: Mapping[str, Range], seed: int) -> dict[str, float]:
    """The next point after ``trials`` (point, score): of ``CANDIDATES`` draws from the density of the best
    trials the one that is likeliest there against the density of the rest. Fixed by the trials and the seed."""
    rng = random.Random(f"{seed}:{len(trials)}")
    order = sorted(range(len(trials)), key=lambda i: (-trials[i][1], i))
    good = min(MOST_GOOD, math.ceil(GOOD_SHARE * len(trials)))
    best = Density(space, [trials[i][0] for i in sorted(order[:good])])
    rest = Density(space, [trials[i][0] for i in sorted(order[good:])])
    drawn = [best.draw(rng) for _ in range(CANDIDATES)]
    return max(drawn, key=lambda p: math.log(best.at(p)) - math.log(rest.at(p)))
