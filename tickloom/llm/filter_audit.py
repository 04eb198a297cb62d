"""How filters of documents interact, whatever order they are applied in.

A set of filters spans a lattice of subsets: a state is the set of filters applied so
far, an edge adds one more. What an edge removes depends on its state alone, not on the
order in which the state was reached, so all orders share the same few edges:

1. Each document becomes a mask of the filters it fails; masks are counted per part.
   From here on the data is parts x masks rows, whatever the size of the corpus.
2. ``lattice`` counts paths: ``forward`` orders that reach a state, ``backward`` orders that
   leave it, by one sweep up and one down over the edges. An edge lies on
   forward(from) x backward(to) orders.
3. Each edge's removals are read off the masks: a document is removed there if it fails
   the new filter and none applied before.
4. A filter's Shapley total is the sum of its edges' removals weighted by their paths; the
   steps of a single order are read from the edges it walks along.

Nulls: a null text is empty, a null part is the empty string, a document without labels
is neither good nor toxic; of several labels of one id the largest counts. A document
with a null id has no labels, and never is a later copy, nor makes one. Rows that
repeat an id and its text are judged each by itself and are no copies of each other. An
empty table gives no rows. Further columns of the inputs are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import only, stored, text_of

BLANKS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Edge:
    """Adding ``letter`` to the filters of ``state``; ``paths`` orders pass through."""

    state: int
    bit: int
    letter: str
    paths: int


def lattice(letters: str) -> list[Edge]:
    """All edges of the subset lattice with the number of orders that use each."""
    bits = [1 << i for i in range(len(letters))]
    full = sum(bits)
    steps = [(s, b) for s in range(full + 1) for b in bits if not s & b]
    forward, backward = defaultdict(int, {0: 1}), defaultdict(int, {full: 1})
    for s, b in steps:  # a state's number is above those of all its subsets
        forward[s | b] += forward[s]
    for s, b in reversed(steps):
        backward[s] += backward[s | b]
    return [Edge(s, b, letters[bits.index(b)], forward[s] * backward[s | b]) for s, b in steps]


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The conditions that need no other document."""
    n = F.size(words)
    return {
        "A": n < 200,
        "B": F.size(F.array_distinct(words)) * 100 < n * 50,
        "C": F.regexp_count(text, F.lit("[A-Z]")).cast("long") * 100 > F.length(text).cast("long") * 2,
        "D": text.rlike(r"[#$%&*|]"),
    }


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """id, part and mask of every document: bit i is set if it fails filter i of ABCDE."""
    text = text_of(f"`{text_col}`")
    read = only(docs, *dict.fromkeys([id_col, text_col, part_col])).select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.array_remove(F.split(text, BLANKS), "").alias("words"),
    )
    bits = [F.when(c, F.lit(1 << i)).otherwise(0) for i, c in enumerate(failures(F.col("text"), F.col("words")).values())]
    slim = stored(
        read.select("id", "part", sum(bits[1:], bits[0]).alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")),
        "masks",
    )
    # One row for each text that is there; a map task sends one row for a text however often it has it.
    firsts = slim.filter("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("first"))
    firsts = firsts.select(F.col("digest").alias("_digest"), "first")
    joined = slim.join(firsts, (slim["id"] == firsts["first"]) & (slim["digest"] == firsts["_digest"]), "left")
    later = F.col("id").isNotNull() & F.col("first").isNull()
    return joined.select("id", "part", (F.col("mask") + F.when(later, 16).otherwise(0)).alias("mask"))


def counted(judged: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """part, mask, n, good, toxic: documents with each mask, and how many are labelled so."""
    known = labels.groupBy(F.col(f"`{id_col}`").alias("_id")).agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    rows = judged.join(known, F.col("id") == F.col("_id"), "left")
    return rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic")
    )


def on_edges(counts: DataFrame, letters: str) -> DataFrame:
    """What each edge of the lattice does to each part."""
    edges = [
        F.struct(F.lit(e.state).alias("state"), F.lit(e.bit).alias("bit"), F.lit(e.letter).alias("letter"), F.lit(e.paths).alias("paths"))
        for e in lattice(letters)
    ]
    # Counts are a row for each mask of a part, so this is parts x masks x edges rows.
    rows = counts.select("*", F.explode(F.array(*edges)).alias("e")).select("part", "mask", "n", "good", "toxic", "e.*")
    mask, state, bit = F.col("mask"), F.col("state"), F.col("bit")
    fails, alive = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(state) == 0

    def total(condition: Column, of: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(of))), F.lit(0)).cast("long")

    return rows.groupBy("part", "state", "bit", "letter", "paths").agg(
        total(alive & ~fails, "n").alias("kept"),
        total(alive & fails, "n").alias("removed"),
        total(~alive & fails, "n").alias("redundant"),
        total(mask == bit, "n").alias("unique_fails"),
        total(alive & fails, "good").alias("good_lost"),
        total(alive & fails, "toxic").alias("toxic_lost"),
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    letters: str = "ABCDE",
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """Every step of every order of the filters, for each part."""
    spark = docs.sparkSession
    edges = on_edges(counted(masks(docs, id_col, text_col, part_col), labels, id_col), letters)
    edges = stored(edges, "edges")  # parts x edges rows
    shapley = edges.groupBy("part", "letter").agg(F.sum(F.col("removed") * F.col("paths")).alias("shapley"))
    walks = []
    for order in permutations(letters):
        state = 0
        for step, letter in enumerate(order, 1):
            walks.append(("".join(order), step, state, letter))
            state |= 1 << letters.index(letter)
    walked = F.broadcast(spark.createDataFrame(walks, "filter_order string, step int, state int, letter string"))
    return (
        edges.join(walked, ["state", "letter"])
        .join(shapley, ["part", "letter"])
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
        )
    )
