"""Quality classifier: a sparse rule ensemble.

Shallow trees grown by gradient boosting over text statistics give paths; every path is a conjunctive rule. A lasso
logistic regression over the rules keeps few of them, and the kept rules become one Spark column expression.

Only the fit sees labels, on a documented, bounded sample of labelled rows (`max_labelled`, those with the smallest
hash of the id). Scores use nothing but the text: null and empty texts have all statistics zero and a score like any
other. Without a labelled row of both classes the score is the share of label 1, 0.5 without any row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import per_text

#: Statistics of a text; all but the first two are shares or means, so they do not grow with its length.
STATISTICS = (
    "log_chars",
    "log_words",
    "mean_word",
    "longest_word",
    "upper",
    "digit",
    "symbol",
    "exclaim",
    "pipe",
    "non_ascii",
    "distinct_words",
    "distinct_lines",
    "repeated_shingles",
    "ended_words",
    "symbol_words",
    "upper_words",
    "top_word",
    "mean_line",
)
MAX_LABELLED = 20_000
THRESHOLD = 0.7

_UPPER = bytes(range(65, 91))
_DIGIT = b"0123456789"
_SYMBOL = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,'\"-!?;:()|")
_NON_ASCII = bytes(range(128, 256))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])


def statistics(raw: bytes) -> tuple[float, ...]:
    """The statistics of a whole text, in the order of STATISTICS."""
    n = len(raw)
    words = raw.split()
    if not words:
        return (math.log1p(n), *[0.0] * (len(STATISTICS) - 1))
    m = len(words)

    def count(chars: bytes) -> int:
        return n - len(raw.translate(None, chars))

    low = [w.lower() for w in words]
    tally: dict[bytes, int] = {}
    for w in low:
        tally[w] = tally.get(w, 0) + 1
    lines = [line for line in raw.split(b"\n") if line.strip()]
    pairs = set(zip(low, low[1:], low[2:]))
    letters = max(1, count(_LETTERS))
    tops = sum(w.isupper() and len(w) > 1 for w in words)
    marked = sum(w[-1:] in b"!#$%&*@~^" or w[:1] in b"#$%&*@~^" for w in words)
    return (
        math.log1p(n),
        math.log1p(m),
        sum(map(len, words)) / m,
        float(max(map(len, words))),
        count(_UPPER) / letters,
        count(_DIGIT) / n,
        count(_SYMBOL) / n,
        raw.count(b"!") / n,
        raw.count(b"|") / n,
        count(_NON_ASCII) / n,
        len(tally) / m,
        len(set(lines)) / len(lines),
        1 - len(pairs) / (m - 2) if m > 2 else 0.0,
        (raw.count(b". ") + raw.count(b".\n") + raw.endswith(b".")) / m,
        marked / m,
        tops / m,
        max(tally.values()) / m,
        math.log1p(n / len(lines)),
    )


def text_statistics(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` and one double column `stat_<name>` for each statistic."""
    fields = ", ".join(f"stat_{name} double" for name in STATISTICS)
    return per_text(docs, lambda: statistics, fields, keep, text)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is above, bound) with its weight."""

    terms: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for k, above, bound in self.terms:
            out &= (x[:, k] > bound) if above else (x[:, k] <= bound)
        return out

    def column(self) -> Column:
        tests = [
            F.col(f"stat_{STATISTICS[k]}") > bound if above else F.col(f"stat_{STATISTICS[k]}") <= bound
            for k, above, bound in self.terms
        ]
        out = tests[0]
        for test in tests[1:]:
            out = out & test
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    bias: float
    rules: list[Rule] = field(default_factory=list)

    def score(self) -> Column:
        """The probability of label 1 as an expression over the statistics."""
        total = F.lit(float(self.bias))
        for rule in self.rules:
            total = total + F.when(rule.column(), F.lit(float(rule.weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule in self.rules:
            z += rule.weight * rule.holds(x)
        return 1 / (1 + np.exp(-z))


def _bounds(x: np.ndarray, bins: int = 32) -> list[np.ndarray]:
    """Candidate split bounds of each statistic: midpoints between neighbouring quantiles that differ."""
    out = []
    for column in x.T:
        q = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def _grow(codes, residual, hessian, rows, bounds, depth, least, terms, out) -> None:
    """Add the paths of one tree over `rows` to `out` as (terms, value); histograms find each split."""
    g, h = residual[rows], hessian[rows]
    total_g, total_h = g.sum(), h.sum()
    best = None
    if depth and len(rows) >= 2 * least:
        for k, cuts in enumerate(bounds):
            if not len(cuts):
                continue
            sums = np.bincount(codes[rows, k], weights=g, minlength=len(cuts) + 1).cumsum()[:-1]
            mass = np.bincount(codes[rows, k], weights=h, minlength=len(cuts) + 1).cumsum()[:-1]
            sizes = np.bincount(codes[rows, k], minlength=len(cuts) + 1).cumsum()[:-1]
            gain = sums**2 / (mass + 1) + (total_g - sums) ** 2 / (total_h - mass + 1)
            gain[(sizes < least) | (len(rows) - sizes < least)] = -1
            at = int(gain.argmax())
            if gain[at] > total_g**2 / (total_h + 1) + 1e-9 and (best is None or gain[at] > best[0]):
                best = (gain[at], k, at)
    value = total_g / (total_h + 1)
    if terms:
        out.append((terms, value))
    if best is None:
        return
    _, k, at = best
    low = codes[rows, k] <= at
    for above, part in ((False, rows[low]), (True, rows[~low])):
        _grow(codes, residual, hessian, part, bounds, depth - 1, least, (*terms, (k, above, float(bounds[k][at]))), out)


def extract_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3) -> list[Rule]:
    """The distinct paths, inner nodes included, of boosted trees."""
    bounds = _bounds(x)
    codes = np.column_stack([np.searchsorted(b, c, side="left") for b, c in zip(bounds, x.T)])
    z, found = np.zeros(len(y)), {}
    least = max(5, len(y) // 400)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        paths: list = []
        _grow(codes, y - p, p * (1 - p), np.arange(len(y)), bounds, depth, least, (), paths)
        if not paths:
            break
        longer = {terms[:-1] for terms, _ in paths}
        for terms, value in paths:
            rule = Rule(terms)
            found.setdefault(terms, rule)
            if terms not in longer:
                z += rate * value * rule.holds(x)
    return list(found.values())


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Bias and L1-penalised weights of a logistic regression, by accelerated proximal gradient steps."""
    n, k = a.shape
    mean = a.mean(0)
    centred = a - mean
    spread = np.linalg.norm(centred, 2) ** 2 / (4 * n) + 1e-9 if k else 1.0
    w, v, bias, vb, t = np.zeros(k), np.zeros(k), 0.0, 0.0, 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(centred @ v + vb))) - y
        new = v - centred.T @ r / n / spread
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / spread, 0)
        new_bias = vb - 4 * r.mean()
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_new * (new - w), new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    return bias - float(mean @ w), w


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.002) -> RuleEnsemble:
    """The sparse rule ensemble of statistics `x` and labels `y` (0 or 1)."""
    if not len(y):
        return RuleEnsemble(0.0)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    if y.min() == y.max():
        return RuleEnsemble(math.log(share / (1 - share)))
    rules = extract_rules(x, y)
    if not rules:
        return RuleEnsemble(math.log(share / (1 - share)))
    a = np.column_stack([r.holds(x) for r in rules]).astype(float)
    bias, weights = lasso_logistic(a, y, penalty)
    return RuleEnsemble(bias, [Rule(r.terms, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    max_labelled: int = MAX_LABELLED,
) -> RuleEnsemble:
    """Fit on the documents of at most `max_labelled` labelled ids for which `usable` (over `key`) holds.

    An id with two different labels, or without id or label, teaches nothing. At most `max_labelled` rows of
    statistics reach the driver.
    """
    known = labels.where(usable & F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key)
    known = known.agg(F.min(label).alias("_y"), F.max(label).alias("_top")).where(F.col("_y") == F.col("_top"))
    known = known.orderBy(F.xxhash64(key), key).limit(max_labelled).select(key, "_y")
    rows = docs.select(key, text).join(F.broadcast(known), key)
    sample = text_statistics(rows, (key, "_y"), text).orderBy(F.xxhash64(key), *[f"stat_{s}" for s in STATISTICS])
    got = sample.limit(max_labelled).toPandas()
    x = got[[f"stat_{s}" for s in STATISTICS]].to_numpy(dtype=float)
    return fit(x, got["_y"].to_numpy(dtype=float))


def score(docs: DataFrame, model: RuleEnsemble, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` and score, the probability of label 1, for every row."""
    return text_statistics(docs, keep, text).select(*keep, model.score().alias("score"))
