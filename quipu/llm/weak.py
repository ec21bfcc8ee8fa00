"""Weak supervision over vote patterns.

Voters say 1, -1 or 0 (abstain). Rows are counted by vote pattern first, so that the fit sees at most 3 ** voters rows however
large the data is; posteriors go back to the rows as a small expression.
"""

import math
from dataclasses import dataclass

SMOOTH = 0.5
#: Prior rates of a voter's votes in the good and the bad class, and their weight as a share of the rows.
GOOD_RATES = {-1: 0.02, 0: 0.18, 1: 0.8}
BAD_RATES = {-1: 0.3, 0: 0.3, 1: 0.4}
STRENGTH = 0.02
#: An objection is at least so many times likelier in the bad class, so that the classes can't change places.
BETTER = 5.0


@dataclass(frozen=True)
class Voters:
    prior: float
    good: list[dict[int, float]]
    bad: list[dict[int, float]]

    def odds(self, votes: tuple[int, ...]) -> float:
        """Log odds of the good class."""
        total = math.log(self.prior / (1 - self.prior))
        for g, b, v in zip(self.good, self.bad, votes, strict=True):
            total += math.log(g[v] / b[v])
        return total

    def posterior(self, votes: tuple[int, ...]) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.odds(votes)))))


def _rates(patterns: dict, weights: dict, voter: int, prior: dict[int, float]) -> dict[int, float]:
    strength = 2 * SMOOTH + STRENGTH * sum(patterns.values())
    mass = {v: strength * p for v, p in prior.items()}
    for votes, n in patterns.items():
        mass[votes[voter]] += n * weights[votes]
    total = sum(mass.values())
    return {v: m / total for v, m in mass.items()}


def _sound(good: dict[int, float], bad: dict[int, float]) -> dict[int, float]:
    """The good class's rates with objections held to a share of the bad class's."""
    objection = min(good[-1], bad[-1] / BETTER)
    rest = (1 - objection) / (1 - good[-1])
    return {-1: objection, 0: good[0] * rest, 1: good[1] * rest}


def fit_voters(patterns: dict[tuple[int, ...], int], prior: float, rounds: int = 50, tolerance: float = 1e-6, objection: float = 0.9) -> Voters:
    """Expectation-maximisation of each voter's rates in both classes.

    patterns: rows by vote pattern. It starts from the votes themselves: an objection makes a row bad with probability
    ``objection``, approval without objection makes it good, abstention alone leaves the prior. Prior rates of small weight and the
    factor BETTER keep the classes' meaning. Empty input gives a model that knows the prior only.
    """
    voters = len(next(iter(patterns), ()))
    soft = {v: (1 - objection if -1 in v else 0.5 + objection / 2 if 1 in v else prior) for v in patterns}
    model = Voters(prior, [], [])
    for _ in range(rounds if patterns else 0):
        total = sum(patterns.values())
        mean = (sum(n * soft[v] for v, n in patterns.items()) + SMOOTH) / (total + 2 * SMOOTH)
        bad = [_rates(patterns, {v: 1 - p for v, p in soft.items()}, k, BAD_RATES) for k in range(voters)]
        good = [_sound(_rates(patterns, soft, k, GOOD_RATES), bad[k]) for k in range(voters)]
        model = Voters(min(max(mean, 1e-6), 1 - 1e-6), good, bad)
        new = {v: model.posterior(v) for v in patterns}
        moved = max((abs(new[v] - soft[v]) for v in patterns), default=0.0)
        soft = new
        if moved < tolerance:
            break
    return model


def _solved(a: list[list[float]], b: list[float]) -> list[float]:
    """x of a x = b, by elimination; a is positive definite."""
    n, m = len(b), [[*row, v] for row, v in zip(a, b, strict=True)]
    for k in range(n):
        for i in range(k + 1, n):
            f = m[i][k] / m[k][k]
            m[i] = [x - f * y for x, y in zip(m[i], m[k], strict=True)]
    x = [0.0] * n
    for k in reversed(range(n)):
        x[k] = (m[k][n] - sum(m[k][j] * x[j] for j in range(k + 1, n))) / m[k][k]
    return x


def fit_logistic(rows: list[tuple[tuple[float, ...], float, float]], rounds: int = 30, penalty: float = 0.05) -> list[float]:
    """Weights (bias last) of a logistic model of (features, probability, count) rows, by Newton steps."""
    width = len(rows[0][0]) + 1 if rows else 1
    weights = [0.0] * width
    rows = [((*x, 1.0), p, n) for x, p, n in rows]
    for _ in range(rounds):
        slope = [-penalty * w for w in weights]
        bend = [[penalty * (i == j) for j in range(width)] for i in range(width)]
        for x, p, n in rows:
            z = sum(w * v for w, v in zip(weights, x, strict=True))
            q = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            own = [k for k, v in enumerate(x) if v]
            for i in own:
                slope[i] += n * (p - q) * x[i]
                for j in own:
                    bend[i][j] += n * q * (1 - q) * x[i] * x[j]
        step = _solved(bend, slope)
        # Shortened where it would overshoot.
        size = max(map(abs, step))
        weights = [w + s * min(1.0, 2.0 / max(size, 1e-12)) for w, s in zip(weights, step, strict=True)]
        if size < 1e-6:
            break
    return weights
