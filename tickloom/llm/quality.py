"""Quality scores from a sparse ensemble of rules.

1. ``statistics`` of whole texts are column expressions: lengths, shares of kinds of
   characters, repetition of words and lines.
2. Small trees are grown on random halves of a bounded sample of labelled rows, each split
   among a few random statistics. Every path from a root to another node is a rule: a
   conjunction of "statistic at most / above a cut".
3. Logistic regression with an L1 penalty weighs the rules and leaves most at zero. The
   penalty is chosen on a fifth of the sample that the weights are not fitted on.
4. The rules left are compiled into one column expression, so scoring is a projection: one
   scan, no shuffle, no Python.

The sample is the ``max_rows`` labelled ids with the smallest hash; that bound is all that
ever reaches the driver, as a few numbers a row. Labels are only taken from ids whose
crc32 modulo 3 is not 1. Neither labels nor other columns of a document enter a score.

A null text is empty and is scored like any other; a null id is scored and never learned
from. Of several labels of one id the largest counts, of several rows of one id one is
learned from (the smallest hash of its text). Without labels of both kinds every score is
the share of good labels, one half without any. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import only, text_of

MAX_ROWS = 20_000
TREES, DEPTH, CUTS = 60, 3, 24
BLANKS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Condition:
    """A statistic at most (or above) a cut."""

    name: str
    above: bool
    cut: float


Rule = frozenset  # of Condition


@dataclass(frozen=True)
class Model:
    base: float
    rules: tuple[tuple[float, Rule], ...]


def statistics(docs: DataFrame, text: Column) -> tuple[DataFrame, list[str]]:
    """``docs`` with the statistics of its texts, and their names."""
    read = docs.withColumn("_text", text).withColumns(
        {
            "_words": F.array_remove(F.split("_text", BLANKS), ""),
            "_lines": F.split("_text", "\n"),
        }
    )
    chars, words, lines = F.length("_text"), F.size("_words"), F.size("_lines")

    def share(pattern: str) -> Column:
        return F.regexp_count("_text", F.lit(pattern)) / F.greatest(chars, F.lit(1))

    found = {
        "chars": chars.cast("double"),
        "words": words.cast("double"),
        "chars_a_word": chars / F.greatest(words, F.lit(1)),
        "words_a_line": words / lines,
        "distinct_words": F.size(F.array_distinct("_words")) / F.greatest(words, F.lit(1)),
        "distinct_lines": F.size(F.array_distinct("_lines")) / lines,
        "capitals": share("[A-Z]"),
        "digits": share("[0-9]"),
        "marks": share("[.,;:]"),
        "shouts": share("[!?]"),
        "symbols": share(r"[#$%&*|<>{}\[\]\\^~=+@_/]"),
    }
    named = {f"_s_{name}": column for name, column in found.items()}
    return read.withColumns(named).drop("_text", "_words", "_lines"), list(found)


def sample(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Statistics and labels of at most ``max_rows`` labelled documents."""
    key = F.col(f"`{id_col}`")
    known = labels.filter(F.col("quality").isNotNull() & (F.crc32(key.cast("string")) % 3 != 1))
    known = known.groupBy(key.alias("_id")).agg(F.max("quality").alias("_label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    rows = only(docs, id_col, text_col).select(key.alias("_id"), text_of(f"`{text_col}`").alias("_of"))
    rows, names = statistics(rows.join(F.broadcast(known), "_id"), F.col("_of"))
    values = F.array(*[F.col(f"_s_{n}") for n in names])
    one = rows.groupBy("_id").agg(F.min_by(F.struct(values.alias("x"), "_label"), F.xxhash64("_of")).alias("r"))
    got = one.select("_id", "r.x", "r._label").toArrow().sort_by("_id")
    x = got.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(names))
    return x, (got.column("_label").to_numpy() == 1).astype(float), names


def holds(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    """Which rows of ``x`` a rule holds for."""
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        v = x[:, names.index(c.name)]
        out &= v > c.cut if c.above else v <= c.cut
    return out


def grow(x: np.ndarray, y: np.ndarray, names: list[str], cuts: list[np.ndarray], rng: np.random.Generator, depth: int) -> set[Rule]:
    """The rules of one tree: the path to each of its nodes but the root."""
    found: set[Rule] = set()

    def split(rows: np.ndarray, path: Rule, left: int) -> None:
        if path:
            found.add(path)
        good = y[rows].sum()
        if not left or len(rows) < 10 or good in (0, len(rows)):
            return
        best, choice = 0.0, None
        for j in rng.choice(len(names), size=max(2, len(names) // 3), replace=False):
            v = x[rows, j]
            order = np.argsort(v, kind="stable")
            below = np.searchsorted(v[order], cuts[j], side="right")
            total = np.concatenate([[0.0], np.cumsum(y[rows][order])])
            fits = (below >= 3) & (below <= len(rows) - 3)
            if not fits.any():
                continue
            n, k = below[fits], total[below[fits]]
            gain = k**2 / n + (good - k) ** 2 / (len(rows) - n) - good**2 / len(rows)
            at = int(np.argmax(gain))
            if gain[at] > best + 1e-9:
                best, choice = gain[at], (int(j), float(cuts[j][fits][at]))
        if choice is None:
            return
        j, cut = choice
        above = x[rows, j] > cut
        split(rows[~above], path | {Condition(names[j], False, cut)}, left - 1)
        split(rows[above], path | {Condition(names[j], True, cut)}, left - 1)

    split(rng.choice(len(x), size=max(1, len(x) // 2), replace=False), frozenset(), depth)
    return found


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray | None = None, steps: int = 400) -> np.ndarray:
    """Intercept and weights of L1 logistic regression, by accelerated proximal steps."""
    n, r = z.shape
    w = np.zeros(r + 1) if start is None else start.copy()
    size = 4 * n / (n + np.linalg.eigvalsh(z.T @ z)[-1])
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(ahead[0] + z @ ahead[1:], -30, 30)))
        new = ahead - size * np.concatenate([[np.mean(p - y)], z.T @ (p - y) / n])
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - size * penalty, 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, moved = new + (t - 1) / t2 * (new - w), np.abs(new - w).max()
        w, t = new, t2
        if moved < 1e-6:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> Model:
    """The weighted rules that a sample supports."""
    good = y.sum()
    share = (good + 0.5) / (len(y) + 1)
    flat = Model(float(np.log(share / (1 - share))), ())
    if not 0 < good < len(y):
        return flat
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, CUTS + 2)[1:-1], method="lower")) for j in range(x.shape[1])]
    # A rare kind of text lies beyond the outer quantiles of all rows, so its own are cuts too.
    rare = x[y == (0 if 2 * good > len(y) else 1)]
    cuts = [np.unique(np.concatenate([c, np.quantile(rare[:, j], np.linspace(0, 1, CUTS), method="lower")])) for j, c in enumerate(cuts)]
    found: set[Rule] = set()
    for _ in range(trees):
        found |= grow(x, y, names, cuts, rng, depth)
    if not found:  # no cut leaves enough rows on both sides
        return flat
    rules = sorted(found, key=lambda r: (len(r), sorted((c.name, c.above, c.cut) for c in r)))
    z = np.stack([holds(r, x, names) for r in rules], axis=1).astype(float)
    # Rules that hold for the same rows are one; the shortest stands for them.
    _, firsts = np.unique(z, axis=1, return_index=True)
    firsts = np.sort(firsts)
    rules, z = [rules[i] for i in firsts], z[:, firsts]
    spread = np.maximum(z.std(axis=0), 1e-3)
    z = (z - z.mean(axis=0)) / spread
    tried = rng.permutation(len(y)) % 5 == 0
    best, chosen, w = np.inf, 0.1, None
    penalties = 0.1 * 0.5 ** np.arange(9)
    for penalty in penalties:
        w = lasso(z[~tried], y[~tried], penalty, w)
        logit = np.clip(w[0] + z[tried] @ w[1:], -30, 30)
        loss = np.mean(np.log1p(np.exp(-logit)) * y[tried] + np.log1p(np.exp(logit)) * (1 - y[tried])) if tried.any() else 0.0
        if loss < best * 0.99:
            best, chosen = loss, penalty
    w = None
    for penalty in penalties[penalties >= chosen]:
        w = lasso(z, y, penalty, w)
    of = np.stack([holds(r, x, names) for r in rules], axis=1).mean(axis=0)
    weights = w[1:] / spread
    base = float(w[0] - np.sum(weights * of))
    return Model(base, tuple((float(a), r) for a, r in zip(weights, rules, strict=True) if a != 0))


def compiled(model: Model, prefix: str = "_s_") -> Column:
    """The model as a column expression over the statistics."""

    def holding(rule: Rule) -> Column:
        out = F.lit(True)
        for c in sorted(rule, key=lambda c: (c.name, c.above, c.cut)):
            v = F.col(f"{prefix}{c.name}")
            out = out & (v > c.cut if c.above else v <= c.cut)
        return out

    # One list of weights instead of a tree of additions: the sum has one order, and no deep plan.
    terms = F.array(F.lit(model.base), *[F.when(holding(r), F.lit(w)).otherwise(F.lit(0.0)) for w, r in model.rules])
    logit = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    return 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0))))


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    return fit(*sample(docs, labels, max_rows, id_col, text_col))


def scores(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and score of every document."""
    model = learn(docs, labels, max_rows, id_col, text_col)
    slim = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("_of"))
    rows, _ = statistics(slim, F.col("_of"))
    return rows.select("doc_id", compiled(model).alias("score"))
