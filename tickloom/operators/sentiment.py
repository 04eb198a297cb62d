"""Lexicon sentiment as a Spark job.

Texts are split into tokens with their places, tokens meet the whole lexicon in one join,
and what is left, the hits, is gathered per text in the order of places. Negations,
boosters, capitals and a "but" are then found among a text's hits by their places. The
lexicon is the caller's table: ``token, valence (thousandths), role`` with role word,
negator, booster or dampener. A token listed several times as a word has its largest
valence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the published scoring rule (Hutto & Gilbert 2014): the factor of a
# negation in thousandths; in millionths the shifts of a booster one, two and three words
# back, those of one in capitals on top, the weight of a word in capitals, and the emphasis
# of each of up to four "!", of two or three "?", and of more "?"; the word that halves what
# stands before it and adds half to what stands behind.
NEGATION_FACTOR = -740
BOOSTER_SHIFTS = (293_000, 278_350, 263_700)
CAPITAL_SHIFTS = (733_000, 696_350, 659_700)
CAPITALS = 733_000
EXCLAMATION, EXCLAMATIONS = 292_000, 4
QUESTION, QUESTIONS, MANY_QUESTIONS = 180_000, 3, 960_000
CONTRAST, BEFORE_CONTRAST, AFTER_CONTRAST = "but", 1, 3
ALPHA = 15
LOOK_BACK = len(BOOSTER_SHIFTS)
#: Sums are of halves of a millionth, so that halving keeps them whole.
HALVES = 2
#: What a broadcast lexicon may take, and what one of its rows takes beside the token.
LEXICON_BYTES, ROW_BYTES = 64 << 20, 64


def join_text(
    headline: str = "headline", summary: str = "summary", summary_chars: int | None = None
) -> Column:
    """Headline and summary joined by a blank; empty parts are left out.

    ``summary_chars`` is the live scorer's option to read only the start of a summary.
    """
    s = F.col(summary) if summary_chars is None else F.substring(summary, 1, summary_chars)
    parts = [F.trim(F.col(headline)), F.trim(s)]
    return F.concat_ws(" ", *[F.when(p != "", p) for p in parts])


def news_text(df: DataFrame, summary_chars: int | None = None) -> DataFrame:
    """Add ``text``; rows without any text are dropped."""
    return df.withColumn("text", join_text(summary_chars=summary_chars)).filter(F.col("text") != "")


def spelled(text: Column | str) -> Column:
    """The words of a text as written; an apostrophe within a word belongs to it."""
    t = F.col(text) if isinstance(text, str) else text
    words = F.split(F.replace(t, F.lit("\u2019"), F.lit("'")), r"[^\p{L}']+")
    return F.array_remove(F.transform(words, lambda w: F.trim(w, F.lit("'"))), "")


def shouted(word: Column) -> Column:
    """Is a word in capitals?"""
    return (word == F.upper(word)) & (word != F.lower(word))


def emphasis(text: Column | str) -> Column:
    """What exclamation and question marks add to a text's score, in millionths."""
    t = F.col(text) if isinstance(text, str) else text
    shouts, asks = F.regexp_count(t, F.lit("!")), F.regexp_count(t, F.lit("[?]"))
    asked = F.when(asks > QUESTIONS, MANY_QUESTIONS).when(asks > 1, asks * QUESTION).otherwise(0)
    return (F.least(shouts, F.lit(EXCLAMATIONS)) * EXCLAMATION + asked).cast("bigint")


def by_token(lexicon: DataFrame) -> DataFrame:
    """One row per token: valence if it is a word, whether it negates, and its lift."""
    role = F.col("role")
    lift = F.when(role == "booster", 1).when(role == "dampener", -1)
    return lexicon.groupBy("token").agg(
        F.max(F.when(role == "word", F.col("valence"))).alias("valence"),
        F.bool_or(role == "negator").alias("neg"),
        F.coalesce(F.max(lift), F.lit(0)).alias("lift"),
    )


def _near(tokens: DataFrame) -> DataFrame:
    """``tokens`` marked for broadcast if they take at most ``LEXICON_BYTES``.

    Left to itself Spark knows the lexicon's size only when the other side of the join, every
    word of every text, is already being shuffled.
    """
    size = tokens.agg(F.coalesce(F.sum(F.octet_length("token") + ROW_BYTES), F.lit(0))).first()[0]
    return F.broadcast(tokens) if size <= LEXICON_BYTES else tokens


def _charge(hits: Column, x: Column, i: Column, mixed: Column, contrast: Column) -> Column:
    """What the hit ``x``, the i-th of its text, adds to the score, in halves of a millionth.

    Hits have places of their own, so the three words before one are among the three hits
    before it, if they are hits at all.
    """
    side = F.signum(x["valence"]).cast("bigint")
    shift = F.when(x["caps"] & mixed, CAPITALS).otherwise(0).cast("bigint")
    negated = F.lit(False)
    for back in range(1, LOOK_BACK + 1):
        earlier = F.get(hits, i - back)
        gap = x["at"] - earlier["at"]
        near = F.coalesce(gap <= LOOK_BACK, F.lit(False))
        negated = negated | (near & earlier["neg"])
        for k, (lift, capital) in enumerate(zip(BOOSTER_SHIFTS, CAPITAL_SHIFTS, strict=True), 1):
            loud = F.when(earlier["caps"] & mixed, capital).otherwise(0)
            shift = shift + F.when((gap == k) & (earlier["lift"] != 0), earlier["lift"] * lift + loud).otherwise(0)
    charge = x["valence"] * 1000 + side * shift
    # All the products are whole thousands.
    charge = F.call_function("div", charge * F.when(negated, NEGATION_FACTOR).otherwise(1000), F.lit(1000))
    weight = F.when(x["at"] < contrast, BEFORE_CONTRAST).when(x["at"] > contrast, AFTER_CONTRAST).otherwise(HALVES)
    return charge * weight


def score(
    df: DataFrame,
    lexicon: DataFrame,
    *,
    keys: tuple[str, ...] = ("id",),
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Score ``text``: keys, carry, n_tokens, n_hits, raw_score, compound, positive, neutral, negative.

    ``keys`` identify a text (dedupe first); ``carry`` columns ride along. Scores are whole
    halves of a millionth until the last step, so they do not depend on row order. A lexicon
    of up to ``LEXICON_BYTES`` goes to all tasks, so that tokens are never shuffled; how a
    larger one is joined is left to adaptive execution. A text's rows come from one map task,
    which gathers them before the one shuffle.
    """
    words = F.col("_words")
    read = df.select(
        *keys,
        *carry,
        spelled("text").alias("_words"),
        emphasis("text").alias("_emphasis"),
    )
    loud = F.size(F.filter(words, shouted))
    counted = read.select(
        *keys,
        *carry,
        F.size(words).cast("bigint").alias("n_tokens"),
        ((loud > 0) & (loud < F.size(words))).alias("_mixed"),
        "_emphasis",
        "_words",
    )
    # Counted before, so that no token's row carries all the words.
    one = counted.select(*keys, *carry, "n_tokens", "_mixed", "_emphasis", F.posexplode_outer(words).alias("_at", "_word"))
    one = one.withColumn("token", F.lower("_word"))
    token = F.col("token")
    # The first token of each text stays, whatever it is, so that texts without hits do too.
    first = F.coalesce(F.col("_at"), F.lit(0)) == 0
    rows = one.join(_near(by_token(lexicon)), "token", "left").select(
        *keys,
        F.when(first, F.struct(*carry, "n_tokens", "_mixed", "_emphasis")).alias("_head"),
        "_at",
        "valence",
        (F.coalesce("neg", F.lit(False)) | F.coalesce(token.endswith("n't"), F.lit(False))).alias("neg"),
        F.coalesce("lift", F.lit(0)).cast("bigint").alias("lift"),
        F.coalesce(shouted(F.col("_word")), F.lit(False)).alias("caps"),
        F.when(token == CONTRAST, F.col("_at")).alias("_contrast"),
    )
    hit = F.col("valence").isNotNull() | F.col("neg") | (F.col("lift") != 0)
    rows = rows.filter(hit | first | F.col("_contrast").isNotNull())
    found = F.when(hit, F.struct(F.col("_at").alias("at"), "valence", "neg", "lift", "caps"))
    texts = rows.groupBy(*keys).agg(
        F.first("_head", ignorenulls=True).alias("_head"),
        F.min("_contrast").alias("_contrast"),
        F.sort_array(F.collect_list(found)).alias("_hits"),
    )
    texts = texts.select(*keys, "_head.*", "_contrast", "_hits")
    hits = F.col("_hits")
    charged = F.transform(hits, lambda x, i: _charge(hits, x, i, F.col("_mixed"), F.col("_contrast")))
    zero, point = F.lit(0).cast("bigint"), HALVES * 1_000_000

    def total(of) -> Column:
        return F.aggregate("_charges", zero, lambda a, m: a + F.coalesce(of(m), zero))

    # Shares weigh each hit by its charge plus one, and each other token by one.
    sums = texts.select(
        *keys, *carry, "n_tokens", (F.col("_emphasis") * HALVES).alias("_e"), F.filter(charged, lambda m: m.isNotNull()).alias("_charges")
    ).select(
        *keys,
        *carry,
        "n_tokens",
        F.size("_charges").cast("bigint").alias("n_hits"),
        "_e",
        total(lambda m: m).alias("_sum"),
        total(lambda m: F.when(m > 0, m + point)).alias("_pos"),
        total(lambda m: F.when(m < 0, point - m)).alias("_neg"),
        total(lambda m: F.when(m != 0, F.lit(1).cast("bigint"))).alias("_charged"),
    )
    e, pos, neg = F.col("_e"), F.col("_pos"), F.col("_neg")
    sums = sums.select(
        *keys,
        *carry,
        "n_tokens",
        "n_hits",
        "_charged",
        (F.col("_sum") + F.signum("_sum").cast("bigint") * e).alias("raw_score"),
        (pos + F.when(pos > neg, e).otherwise(zero)).alias("_pos"),
        (neg + F.when(neg > pos, e).otherwise(zero)).alias("_neg"),
    )
    s = F.col("raw_score").cast("double")
    neu = (F.col("n_tokens") - F.col("_charged")) * point
    whole = (F.col("_pos") + F.col("_neg") + neu).cast("double")

    def share(x: Column) -> Column:
        return F.when(whole > 0, x.cast("double") / whole).otherwise(F.lit(0.0))

    return sums.select(
        *keys,
        *carry,
        "n_tokens",
        "n_hits",
        "raw_score",
        (s / F.sqrt(s * s + float(ALPHA * point * point))).alias("compound"),
        share(F.col("_pos")).alias("positive"),
        share(neu).alias("neutral"),
        share(F.col("_neg")).alias("negative"),
    )
