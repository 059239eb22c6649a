"""Operator 2, quality classifier as a sparse ensemble of rules.

Statistics of the whole text (shares of upper case, digits, symbols, repeated
words and lines, ...) feed shallow trees; every path from a root to a node is
a conjunctive rule. A logistic regression with an L1 penalty weighs the rules
and leaves few of them; those are compiled into Spark column expressions over
the statistics, so scoring is one scan without a shuffle.

The model is fitted on at most about FIT_ROWS labelled rows (a sample by a
hash of the id); the statistics and scores cover every row and whole texts.
Only the text is read for a score.

Defined cases: a null text counts as empty; an empty text has all statistics
zero and is scored by the same rules; several labels of one id count once, as
their mean rounded; without labels, or with labels of one kind only, every
score is the share of label 1 (0.5 without any); an empty table gives an empty
result; columns of the input pass through untouched.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.llm.common import appended, id_remainder, unused

FIT_ROWS, TREES, DEPTH, CUTS, SEED = 10_000, 32, 3, 32, 11
LABEL_FOLDS, HELD_OUT_FOLD = 5, 0
THRESHOLD = 0.3

STATS = ["bytes", "words", "word_bytes", "upper", "lower", "digit", "stop", "comma", "bang", "bar", "symbol", "slash",
         "quote", "line", "other", "distinct", "doubled", "line_distinct", "longest", "word_ends"]
_KINDS = ["lower", "upper", "digit", "stop", "comma", "bang", "bar", "symbol", "slash", "quote", "line", "space", "other"]


def _kinds() -> np.ndarray:
    """Kind of each byte."""
    groups = {"digit": b"0123456789", "stop": b".", "comma": b",;:", "bang": b"!?", "bar": b"|", "slash": b"/\\@<>=_",
              "quote": b"'\"()-", "line": b"\n\r", "space": b" \t\x0b\x0c", "symbol": b"#$%&*+[]^`{}~"}
    out = np.full(256, _KINDS.index("other"), np.int64)
    out[ord("a"):ord("z") + 1] = _KINDS.index("lower")
    out[ord("A"):ord("Z") + 1] = _KINDS.index("upper")
    for name, chars in groups.items():
        out[list(chars)] = _KINDS.index(name)
    return out


_KIND = _kinds()


def statistics(values: list[bytes]) -> np.ndarray:
    """One row of STATS per text."""
    n, k = len(values), len(_KINDS)
    size = np.fromiter(map(len, values), np.int64, n)
    kind = _KIND[np.frombuffer(b"".join(values), np.uint8)]
    count = np.bincount(np.repeat(np.arange(n) * k, size) + kind, minlength=n * k).reshape(n, k).astype(float)
    of = {name: count[:, i] for i, name in enumerate(_KINDS)}
    more = np.zeros((n, 6))
    for i, text in enumerate(values):
        words = text.split()
        if words:
            lines = text.split(b"\n")
            more[i] = (len(words), len(set(words)) / len(words), sum(map(eq, words, words[1:])) / len(words),
                       len(set(lines)) / len(lines), max(map(len, words)), sum(w[-1:].isalnum() for w in words) / len(words))
    words = np.maximum(more[:, 0], 1)
    total = np.maximum(size, 1)
    letters = np.maximum(of["lower"] + of["upper"], 1)
    out = {"bytes": size, "words": more[:, 0], "word_bytes": size / words, "upper": of["upper"] / letters, "lower": of["lower"] / total,
           "digit": of["digit"] / total, "other": of["other"] / total, "distinct": more[:, 1], "doubled": more[:, 2],
           "line_distinct": more[:, 3], "longest": more[:, 4], "word_ends": more[:, 5]}
    out |= {name: of[name] / words for name in ("stop", "comma", "bang", "bar", "symbol", "slash", "quote", "line")}
    return np.column_stack([out[name] for name in STATS]).astype(float)


def with_statistics(docs: DataFrame, column: str, text_col: str = "text") -> DataFrame:
    def compute(values: list[bytes]) -> pa.Array:
        stats = statistics(values)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * len(STATS), pa.int32()), pa.array(stats.ravel()))
    return appended(docs, column, "array<double>", text_col, compute)


# -- fitting, on a bounded sample in numpy ---------------------------------
Rule = tuple  # ((statistic, is_above, cut), ...)


def _grow(codes, cuts, y, rows, features, depth, path, rules, rng):
    """Split a node at the cut that lowers the Gini impurity most; every node
    below the root gives a rule."""
    if path:
        rules.add(tuple(sorted(path)))
    p = y[rows].mean()
    if depth == 0 or len(rows) < 40 or p in (0.0, 1.0):
        return
    best = (1e-7, None, None)
    base = len(rows) * p * (1 - p)
    for f in rng.choice(features, max(3, len(features) // 2), replace=False):
        c = codes[rows, f]
        n = np.cumsum(np.bincount(c, minlength=CUTS + 1))[:-1]
        s = np.cumsum(np.bincount(c, weights=y[rows], minlength=CUTS + 1))[:-1]
        m, t = len(rows) - n, p * len(rows) - s
        ok = (n >= 15) & (m >= 15)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, base - (s - s * s / n) - (t - t * t / m), 0)
        i = int(np.argmax(gain))
        if gain[i] > best[0] and i < len(cuts[f]):
            best = (gain[i], f, i)
    if best[1] is None:
        return
    _, f, i = best
    low = codes[rows, f] <= i
    for part, above in ((rows[low], False), (rows[~low], True)):
        _grow(codes, cuts, y, part, features, depth - 1, [*path, (int(f), above, float(cuts[f][i]))], rules, rng)


def extract_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    rng = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    features, rules = [f for f, c in enumerate(cuts) if len(c)], set()
    for _ in range(TREES if features else 0):
        rows = rng.choice(len(y), max(1, len(y) // 2), replace=False)
        _grow(codes, cuts, y, rows, features, DEPTH, [], rules, rng)
    return sorted(rules)


def rule_matrix(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for f, above, cut in rule:
            out[:, j] *= (x[:, f] > cut) if above else (x[:, f] <= cut)
    return out


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the intercept is not penalised."""
    n = len(y)
    step = 4.0 / max(np.linalg.norm(np.column_stack([a, np.ones(n)]), 2) ** 2 / n, 1e-9)
    prior = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w, b = np.zeros(a.shape[1]), np.log(prior / (1 - prior))
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(a @ vw + vb))) - y
        w2 = vw - step * (a.T @ error) / n
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - step * penalty, 0)
        b2 = vb - step * error.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return float(b), w


class Model:
    """Intercept and weighted rules; ``column`` compiles them."""

    def __init__(self, intercept: float, rules: list[tuple[Rule, float]]):
        self.intercept, self.rules = intercept, rules

    def column(self, stats: str) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            met = F.lit(True)
            for f, above, cut in rule:
                value = F.element_at(stats, f + 1)
                met = met & ((value > cut) if above else (value <= cut))
            total = total + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Model:
        if len(y) == 0 or y.min() == y.max():
            share = float(y.mean()) if len(y) else 0.5
            share = min(max(share, 1e-6), 1 - 1e-6)
            return cls(float(np.log(share / (1 - share))), [])
        rules = extract_rules(x, y)
        a = rule_matrix(rules, x)
        # the penalty is chosen on every fifth row, then all rows are fitted
        check = np.arange(len(y)) % 5 == 0
        losses = {}
        for penalty in (0.03, 0.01, 0.003, 0.001):
            b, w = lasso_logistic(a[~check], y[~check], penalty, 150)
            p = np.clip(1 / (1 + np.exp(-(a[check] @ w + b))), 1e-9, 1 - 1e-9)
            losses[penalty] = -np.mean(y[check] * np.log(p) + (1 - y[check]) * np.log(1 - p))
        # the largest penalty, so the fewest rules, that predicts about as well as the best
        best = max(p for p, loss in losses.items() if loss <= min(losses.values()) + 0.01)
        b, w = lasso_logistic(a, y, best)
        return cls(b, [(rules[j], float(w[j])) for j in np.flatnonzero(np.abs(w) > 1e-4)])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """Learn from labelled rows outside the held-out fold."""
    known = labels.where((id_remainder("doc_id", LABEL_FOLDS) != HELD_OUT_FOLD) & F.col(label_col).isNotNull()
                         & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.round(F.avg(label_col)).alias("y"))
    total = known.count()
    share = min(1.0, FIT_ROWS / max(total, 1))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.lit(share * 1_000_003)).limit(2 * FIT_ROWS)
    picked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # FIT_ROWS bounds the broadcast side
    rows = with_statistics(picked, "stats").select("doc_id", "y", "stats").collect()
    rows.sort(key=lambda r: (r[0], r[2]))
    x = np.array([r[2] for r in rows], float).reshape(-1, len(STATS))
    return Model.fit(x, np.array([r[1] for r in rows], float))


def score(docs: DataFrame, model: Model, column: str) -> DataFrame:
    """``docs`` with one more column, the probability of label 1."""
    stats = unused(docs, "text_statistics")
    whole = with_statistics(docs, stats)
    return whole.withColumn(column, model.column(f"`{stats}`")).drop(stats)
