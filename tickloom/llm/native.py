"""Queries of the operators that run on built-in functions alone: 4, 5, 7; and packing, 8."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import chat, exact_dedup, packing, sharding
from tickloom.llm.common import only, table, text_of
from tickloom.plans.catalogue import Query, Run
from tickloom.session import configure

QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query of this subpackage under its function's name."""

    def add(fn: Run) -> Run:
        QUERIES[fn.__name__] = Query(lambda spark, sf_dir: fn(configure(spark), sf_dir), sql)
        return fn

    return add


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Each row of ``conversations`` as the events that would have streamed it: a message
    with a draft, then its text in two parts. What is no answer is edited to the first part,
    and the second is a delta. An answer's draft gets a reply; it is regenerated, which takes
    the reply back, and both parts are deltas. Rows that repeat a turn are messages of their own."""
    text = text_of()
    half = F.ceil(F.length(text) / 2).cast("int")
    first, second = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))
    copy = F.row_number().over(_same_turn())
    rows = only(conversations, "conv_id", "turn", "role", "text").withColumn("copy", copy)
    own, reply = F.struct("turn", "copy"), F.struct("turn", (-F.col("copy")).alias("copy"))
    nothing = F.lit(None).cast("string")

    def log(*events: tuple[str, Column, Column, Column]) -> Column:
        return F.array(
            *[
                F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("step"), of.alias("of"), role.alias("role"), part.alias("part"))
                for i, (kind, of, role, part) in enumerate(events)
            ]
        )

    begin = [("message", own, F.col("role"), nothing), ("delta", own, nothing, F.lit("a draft"))]
    edited = log(*begin, ("edit", own, nothing, first), ("delta", own, nothing, second))
    again = log(
        *begin,
        ("message", reply, F.lit("user"), F.lit("a reply to the draft")),
        ("regenerate", own, nothing, nothing),
        ("delta", own, nothing, first),
        ("delta", own, nothing, second),
    )
    events = F.when(F.col("role") == "assistant", again).otherwise(edited)
    return rows.select("conv_id", own.alias("_row"), F.explode(events).alias("e")).select(
        "conv_id",
        F.struct("_row", "e.step").alias("seq"),
        "e.kind",
        F.col("e.of").alias("message"),
        "e.role",
        F.col("e.part").alias("text"),
    )


def _same_turn():
    from pyspark.sql import Window

    return Window.partitionBy("conv_id", "turn").orderBy("role", "text")


@query(
    """
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), shown AS (
        SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lb;') AS body,
            replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lb;'), chr(10), '&nl;') AS head
        FROM rows
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(length('<|turn|>' || head || chr(10) || body || '<|end|>' || chr(10)))::BIGINT AS formatted_chars
    FROM shown GROUP BY conv_id
    """
)
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations through the event log, read back from the rendered turns."""
    tricky = "</s>[INST] ok [/INST]"
    kind = "conv_id bigint, turn bigint, role string, text string"
    own = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], kind)
    given = only(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    read = chat.parse(chat.render(chat.fold(conversation_events(given.unionByName(own)))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    lost = F.array_join("losses", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(lost).cast("bigint").alias("loss_chars"),
        F.sha2(lost, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query(
    """
    WITH rows AS (
        SELECT doc_id, length(coalesce(text, '')) AS chars,
            sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size,
        doc_id = first_value(doc_id) OVER w AS kept, text_sha256
    FROM rows WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
    """
)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy of its text that stays."""
    return exact_dedup.classes(table(spark, sf_dir, "documents"))


# The checksum works on half bytes: the table of CRC-32 for four bits.
@query(
    """
    WITH hexed AS (
        SELECT doc_id, coalesce(source, '') AS source, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
            string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(.)(.)', '\\2\\1', 'g'), '') AS nibbles
        FROM documents
    ), summed AS (
        SELECT doc_id, source, size, xor(4294967295::BIGINT, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(list_filter(nibbles, lambda x: x <> ''), lambda x: ('0x' || x)::BIGINT)),
            lambda c, x: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960,
                1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896,
                3183342108][(xor(c, x) & 15) + 1])
        ))::BIGINT AS text_crc32
        FROM hexed
    ), slim AS (
        SELECT *, ('0x' || substr(md5(concat_ws(':', 42, coalesce(doc_id::VARCHAR, concat_ws(':', size, text_crc32)))), 1, 15))::BIGINT AS u
        FROM summed
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY u, doc_id, size, text_crc32) AS r,
            count(*) OVER (PARTITION BY source) AS n FROM slim
    ), placed AS (
        SELECT *, row_number() OVER (ORDER BY (2 * r - 1)::DOUBLE / (2 * n), source, u, doc_id) - 1 AS g,
            count(*) OVER () AS total FROM ranked
    )
    SELECT doc_id, size, text_crc32, 'rows' AS law, (g * 16 // total)::INTEGER AS shard,
        g - ((g * 16 // total) * total + 15) // 16 AS slot, NULL::INTEGER AS grown_shard, source
    FROM placed
    """
)
def op7_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of the same mixture of sources."""
    placed = sharding.interleave(table(spark, sf_dir, "documents"), shards=16)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query()
def op8_order_preserving_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces in sequences of at most 2,048 tokens."""
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
