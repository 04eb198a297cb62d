"""Toxicity of texts whose toxic words may be disguised: a noisy channel, then a lexicon.

1. Counts of character 4-grams over all texts give a character language model.
2. Words that labelled toxic documents use in many contexts, and clean ones hardly ever,
   give a lexicon with log-odds weights.
3. In every text, words that look disguised (symbols or digits for letters or among them,
   letters apart from each other, letters repeated) become lattices: each character may
   stand for itself, for letters it resembles, or for nothing, at a cost; a blank may also
   stay a blank. An exact Viterbi search finds the likeliest letters under the language
   model, once over all paths and once over those that read each look-alike as a letter.
   Parts whose lattice has no path to a lexicon word are not searched, which changes nothing.
4. The score is the posterior of the toxic class given which lexicon words occur in the
   text, plain or restored.

Model sizes are bounded by construction: the language model by ALPHABET**4 counts, the
lexicon by words in at least MIN_SHARE of the toxic documents. Both are broadcast; counts
cover all documents, whole texts are scored.

Defined cases: null and empty texts have no lexicon word and get the score of that; with
no labels, or of one class only, every score is the smoothed share of toxic labels;
documents labelled more than once count once, as toxic if any label says so; repeated
rows are scored alike; tokens of digits only are numbers. Letters are apart in pieces of one
or two, at any distance and in runs of any length; a word cut into larger pieces is not
searched for, as those are words of their own. ``clean`` keeps all columns.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import arrow_rows, only, stored, text_of, within

#: Codes: 0 what is no letter, 1-26 letters, then other letters by their code point.
ALPHABET = 36
CONTEXT = 3
THRESHOLD = 0.7
#: A lexicon word occurs in this share of toxic documents at least, in this many contexts
#: (words before it) for each document, and has this log-odds weight.
MIN_SHARE = 0.005
MIN_DOCS = 3
MIN_CONTEXTS = 0.3
MIN_WEIGHT = 2.0
#: And its log-likelihood ratio against equal use in both classes is this large.
MIN_EVIDENCE = 25.0
#: Characters that are written for letters.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Tokens that a task remembers.
TOKENS = 200_000
COST_LOOKALIKE, COST_DROP, COST_REPEAT, COST_LITERAL = 1.5, 1.2, 0.8, 0.05
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…“”„«»‘’–—¡¿"
_LOOKS = "".join(c for c in LOOKALIKES if not c.isalnum())
_LOOKSET = frozenset(_LOOKS)
_SHORT = rf"(?:[^\W_]|[{re.escape(_LOOKS)}])"
_APART = re.compile(rf"(?<![^\W_]){_SHORT}{{1,2}}(?:[\s.\-_*]++{_SHORT}{{1,2}}){{2,}}(?![^\W_])")
_GAP = re.compile(r"\s{2,}")
_TWICE = re.compile(r"([^\W\d_])\1")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_PARTS = re.compile(r"[.\-_*,;:/]+")
_WORD = re.compile(r"[^\W_]+")
_REPEATED = re.compile(r"(.)\1+")

_TABLE = np.zeros(0x300, np.int64)
for _c in range(0x300):
    if chr(_c).isalpha():
        _TABLE[_c] = _c - 96 if 97 <= _c <= 122 else 27 + _c % (ALPHABET - 27)


def codes(text: str) -> np.ndarray:
    """The characters of a lower-case text as codes of the language model."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = _TABLE[np.minimum(points, len(_TABLE) - 1)]
    return np.where(points < len(_TABLE), out, 27 + points % (ALPHABET - 27))


def count_grams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """gram (four codes as one number) and n, over all texts; a text starts after blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ALPHABET**4, np.int64)
        for b in batches:
            for t in b.column(0):
                c = np.concatenate([np.zeros(CONTEXT, np.int64), codes(t.as_py().lower())])
                for i in range(0, max(0, len(c) - CONTEXT), 1 << 20):
                    p = c[i : i + (1 << 20) + CONTEXT]
                    g = ((p[:-3] * ALPHABET + p[1:-2]) * ALPHABET + p[2:-1]) * ALPHABET + p[3:]
                    if len(g) < 4096:
                        np.add.at(counts, g, 1)
                    else:
                        u, n = np.unique(g, return_counts=True)
                        counts[u] += n
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["gram", "n"])

    slim = docs.select(text_of(f"`{text_col}`").alias("text"))
    return slim.mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame, text_col: str = "text", weight: float = 20.0) -> np.ndarray:
    """Costs (-log p) of a code after three, smoothed towards the code's own frequency."""
    counts = np.zeros(ALPHABET**4)
    for gram, n in count_grams(docs, text_col).collect():  # at most ALPHABET**4 rows
        counts[gram] = n
    counts = counts.reshape(-1, ALPHABET)
    single = counts.sum(axis=0) + 1.0
    single /= single.sum()
    p = (counts + weight * single) / (counts.sum(axis=1, keepdims=True) + weight)
    return (-np.log(p)).astype(np.float32).ravel()


def _code(c: str) -> int:
    o = ord(c)
    return int(_TABLE[o]) if o < len(_TABLE) else 27 + o % (ALPHABET - 27)


def decode(noisy: str, lm: np.ndarray, whole: bool = False) -> str:
    """The likeliest letters behind a lower-case noisy part: Viterbi over its lattice.

    A state is the last three codes, and the last letter; the best way to each state is kept,
    so the work is linear in the length. With ``whole``, look-alikes stand for letters and are not dropped.
    """
    # A state has its cost and the place of its last letter in ``path``, which leads back to
    # the letters before it.
    path: list[tuple[int, str]] = [(-1, "")]
    states: dict[tuple[int, str], tuple[float, int]] = {(0, ""): (0.0, 0)}
    size = ALPHABET**CONTEXT
    for ch in noisy:
        looks = LOOKALIKES.get(ch, "")
        edges = [(ch, COST_LITERAL)] if ch.isalpha() else [] if whole and looks else [("", COST_DROP)]
        edges += [(x, COST_LOOKALIKE) for x in looks]
        if ch.isspace():
            edges.append((" ", COST_LITERAL))
        coded = [(x, _code(x), price) for x, price in edges if x]
        dropped = [price for x, price in edges if not x]
        after: dict[tuple[int, str], tuple[float, int, str]] = {}
        for (context, last), (cost, at) in states.items():
            for letter, code, price in coded:
                key = ((context * ALPHABET + code) % size, letter)
                new = cost + price + float(lm[context * ALPHABET + code])
                if key not in after or new < after[key][0]:
                    after[key] = (new, at, letter)
            stays = [cost + price for price in dropped]
            if ch == last:  # the same letter written again
                stays.append(cost + COST_REPEAT)
            if stays and ((context, last) not in after or min(stays) < after[context, last][0]):
                after[context, last] = (min(stays), at, "")
        states = {}
        for key, (cost, at, letter) in after.items():
            if letter:
                path.append((at, letter))
                at = len(path) - 1
            states[key] = (cost, at)
    _, at = min((cost + float(lm[context * ALPHABET]), at) for (context, _), (cost, at) in states.items())
    letters = []
    while at > 0:
        at, letter = path[at]
        letters.append(letter)
    return "".join(reversed(letters))


def forms(token: str) -> tuple[list[str], list[str]]:
    """The words of a lower-case token, and its forms that may be disguised."""
    core = token.strip(_EDGE)
    words: list[str] = []
    odd: list[str] = []
    if core.isalpha():
        words.append(core)
        if _TWICE.search(core):
            odd.append(core)
    elif core:
        words += _WORD.findall(core)
    if not token.isalpha():
        # Symbols at an edge may be letters or decoration.
        found = {token, core, token.lstrip(_EDGE), token.rstrip(_EDGE), *_PARTS.split(token)}
        odd += [f for f in found if f and not f.isalpha() and not f.isdigit()]
    return words, odd


def runs(low: str) -> set[str]:
    """The runs of short tokens in a lower-case text, which may be words with letters apart."""
    return {_GAP.sub(" ", m.group(0)) for m in _APART.finditer(low)}


def squeezed(word: str) -> str:
    """A word with each repeated letter once; a disguise may have lost or added some."""
    return _REPEATED.sub(r"\1", word)


def letter_bits(letters: str) -> int:
    """A bit for each letter; letters beyond a to z share six more."""
    out = 0
    for c in letters:
        code = _code(c)
        out |= 1 << (code - 1 if 1 <= code <= 26 else 26 + code % 6)
    return out


def readable(part: str, shapes: list[tuple[int, str]], bits: dict[str, int]) -> bool:
    """Whether a path of the part's lattice may give a word with one of these squeezed forms.

    ``shapes`` has the forms after the bits of their letters; ``bits`` remembers those that a
    character may stand for.
    """
    held = 0
    for c in part:
        if c not in bits:
            bits[c] = letter_bits(c if c.isalpha() else LOOKALIKES.get(c, ""))
        held |= bits[c]
    fits = [form for need, form in shapes if need & held == need]
    if not fits:
        return False
    letters = squeezed("".join(filter(str.isalpha, part)))
    options = set(letters).union(*(LOOKALIKES.get(c, "") for c in set(part)))
    apart = any(c.isspace() for c in part)
    for form in fits:
        if options.issuperset(form):
            if apart:
                return True
            rest = iter(form)  # letters are never dropped, so they come in this order
            if all(c in rest for c in letters):
                return True
    return False


def restored(odd, decoded, squeezes: dict[str, str]) -> set[str]:
    """The words behind disguised parts; ``squeezes`` has lexicon words by squeezed form.
    ``decoded`` gives the readings of a part."""
    out: set[str] = set()
    for t in odd:
        for reading in decoded(t):
            if reading == t and not _THRICE.search(t):
                continue  # a plain word with a double letter, such as "loose"
            for w in _WORD.findall(reading):
                out.add(squeezes.get(squeezed(w), w))
    return out


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """toxic and text of the labelled documents that may be learned from."""
    learn = labels.filter(F.col("toxic").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    known = stored(learn.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic")), "labels")
    slim = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("_id"), text_of(f"`{text_col}`").alias("text"))
    return slim.join(within(known, 16), "_id").select("toxic", "text")


def evidence(in_toxic: int, in_clean: int, toxic: int, clean: int) -> float:
    """Dunning's log-likelihood ratio of a word's document counts in the two classes."""
    both = in_toxic + in_clean
    out = 0.0
    for seen, of in ((in_toxic, toxic), (in_clean, clean)):
        for n, share in ((seen, both), (of - seen, toxic + clean - both)):
            expected = of * share / (toxic + clean)
            out += 2 * n * math.log(n / expected) if n > 0 and expected > 0 else 0.0
    return out


def learn(known: DataFrame) -> tuple[dict[str, float], float]:
    """Weights of lexicon words, and the log-odds of a text without any of them."""
    sizes = dict(map(tuple, known.groupBy((F.col("toxic") == 1).alias("t")).count().collect()))
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    prior = math.log((toxic + 0.5) / (clean + 0.5))
    if not toxic or not clean:
        return {}, prior
    needed = max(MIN_DOCS, math.ceil(MIN_SHARE * toxic))

    def pairs(text):
        seen: dict[str, str] = {}
        before = ""
        for w in _WORD.findall(text.lower()):
            seen.setdefault(w, before)
            before = w
        return list(seen.items())

    # Copies of a text repeat contexts too, so a word of one much copied text has few.
    by_context = arrow_rows(known.filter("toxic = 1").select("text"), pairs, "word string, before string")
    words = by_context.groupBy("word", "before").count().groupBy("word")
    words = words.agg(F.sum("count").alias("df"), F.count("*").alias("contexts"))
    words = words.filter((F.col("df") >= needed) & (F.col("contexts") >= F.greatest(F.lit(MIN_DOCS), F.col("df") * MIN_CONTEXTS)))
    df = {w: n for w, n in words.select("word", "df").collect()}  # at most words per text / MIN_SHARE
    candidates = frozenset(df)

    def hits(text):
        return [(w,) for w in candidates.intersection(_WORD.findall(text.lower()))]

    other = arrow_rows(known.filter("toxic <> 1").select("text"), hits, "word string").groupBy("word").count()
    among = dict(map(tuple, other.collect()))
    rate = {w: ((df[w] + 0.5) / (toxic + 1), (among.get(w, 0) + 0.5) / (clean + 1)) for w in df}
    weights = {w: math.log(p) - math.log(q) for w, (p, q) in rate.items()}
    sure = {w: evidence(df[w], among.get(w, 0), toxic, clean) >= MIN_EVIDENCE for w in df}
    weights = {w: x for w, x in weights.items() if x >= MIN_WEIGHT and sure[w]}
    # What the absence of all words says.
    absent = sum(math.log1p(-rate[w][0]) - math.log1p(-rate[w][1]) for w in sorted(weights))
    weights = {w: weights[w] - math.log1p(-rate[w][0]) + math.log1p(-rate[w][1]) for w in sorted(weights)}
    return weights, prior + absent


class Scorer:
    """Scores texts; keeps what it has read in tokens."""

    def __init__(self, lm: np.ndarray, weights: dict[str, float], base: float):
        self.weights, self.base = weights, base
        self.squeezes = {squeezed(w): w for w in weights}

        shapes, bits = [(letter_bits(form), form) for form in self.squeezes], {}
        self.readable = lambda part: readable(part, shapes, bits)

        def readings(part: str) -> tuple[str, ...]:
            if not self.readable(part):
                return ()
            return tuple({decode(part, lm), decode(part, lm, whole=True)})

        self.decoded = readings
        self.tokens: dict[str, tuple[set[str], set[str]] | None] = {}

    def _read(self, token: str) -> tuple[set[str], set[str]] | None:
        """The lexicon words a token shows, and those it hides; None for neither."""
        core = token.strip(_EDGE)
        if core.isalpha() and _LOOKSET.isdisjoint(token) and not self.readable(core):
            # What is around the letters stands for none, so no form reads any better.
            words, odd = [core], []
        else:
            words, odd = forms(token)
        plain = self.weights.keys() & words
        hidden = self.weights.keys() & restored(odd, self.decoded, self.squeezes) if odd else set()
        if len(self.tokens) >= TOKENS:
            self.tokens.clear()
        self.tokens[token] = found = (plain, hidden) if plain or hidden else None
        return found

    def __call__(self, text: str) -> tuple[float, int, int]:
        words: set[str] = set()
        hidden: set[str] = set()
        if self.weights:
            low = text.lower()
            known = self.tokens
            for token in set(low.split()):
                found = known[token] if token in known else self._read(token)
                if found:
                    words |= found[0]
                    hidden |= found[1]
            hidden |= restored(runs(low), self.decoded, self.squeezes)
        return posterior(words, hidden, self.weights, self.base)


def posterior(words: set[str], hidden: set[str], weights: dict[str, float], base: float) -> tuple[float, int, int]:
    """Score, lexicon words in the text, and how many of them only restoring shows."""
    plain = words.intersection(weights)
    hidden = (hidden - words).intersection(weights)
    logit = base + sum(weights[w] for w in sorted(plain | hidden))
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, logit)))), len(plain | hidden), len(hidden)


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, n_words, n_restored of every document."""
    model = _model(docs, labels, id_col, text_col)

    def row(scorer, doc_id, text):
        return [(doc_id, *scorer(text))]

    slim = only(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, score double, n_words bigint, n_restored bigint"
    return arrow_rows(slim, row, schema, setup=lambda: (Scorer(*model.value),))


def clean(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without documents that score ``threshold`` or more."""
    model = _model(docs, labels, id_col, text_col)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(*model.value)
        for texts in batches:
            yield pd.Series([scorer(t)[0] for t in texts], dtype="float64")

    return docs.filter(score(text_of(f"`{text_col}`")) < threshold)


def _model(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str):
    weights, base = learn(labelled(docs, labels, id_col, text_col))
    return docs.sparkSession.sparkContext.broadcast((language_model(docs, text_col), weights, base))
