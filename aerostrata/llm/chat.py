"""Chat formatting from event logs.

A conversation is a log of events. Folded in order of sequence they give its final messages: `message`
starts or replaces a message, `delta` appends to it, `edit` replaces its text, `regenerate` empties it
for new deltas; the last three of these that change an earlier message end the branch below it. The
messages are then rendered with a template whose control strings are escaped inside texts, together
with the spans that training takes as loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.llm.common import table

# The template's control strings.
OPEN, ROLE_END, CLOSE, STOP = "[INST ", "]", "[/INST]", "</s>"
# What looks like a control string, with any escapes it already has; one backslash more escapes it.
CONTROL = r"(\[/?|</?)(\\*)(INST|s>)"
ESCAPED = r"(\[/?|</?)\\(\\*)(INST|s>)"
# A rendered turn: role up to the first ], text up to the first unescaped closing string.
TURN = r"(?s)\[INST ([^\]]*)\](.*?)\[/INST\]</s>"

RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def final_messages(events: DataFrame) -> DataFrame:
    """events (conv_id, seq, kind, message long, role, text) to rows (conv_id, message, role, text).

    Per message: the text of the last reset (message, edit, regenerate) and the deltas after it, in
    order of sequence. A reset of a message ends the branch below: later messages keep only what came
    after it. The role is the last one given. Events of unknown or null kind count as deltas, null texts as
    empty; equal sequence numbers are ordered by kind (resets first), role and text. A null
    conversation or message number is a value like any other. Messages left without events go.
    """
    reset = F.col("kind").isin(*RESETS)
    e = events.select("conv_id", "message", "role", F.coalesce("text", F.lit("")).alias("text"),
                      F.coalesce(reset, F.lit(False)).alias("reset"), F.coalesce("seq", F.lit(-(1 << 62))).alias("seq"), "kind")
    # A regenerated message carries no text of its own.
    e = e.withColumn("text", F.when(F.col("kind") == "regenerate", "").otherwise(F.col("text")))
    conv = Window.partitionBy("conv_id")
    # The newest reset of any message before this one; the rank order of messages is by number.
    above = conv.orderBy(F.col("message")).rangeBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("_cut", F.max(F.when(F.col("reset"), F.col("seq"))).over(above))
    e = e.filter(F.col("_cut").isNull() | (F.col("seq") > F.col("_cut")))
    place = Window.partitionBy("conv_id", "message").orderBy("seq", F.col("reset").desc(), "role", "text")
    e = e.withColumn("_no", F.row_number().over(place))
    own = Window.partitionBy("conv_id", "message")
    e = e.withColumn("_last", F.max(F.when(F.col("reset"), F.col("_no"))).over(own))
    folded = e.groupBy("conv_id", "message").agg(
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("_no"))).alias("role"),
        F.array_sort(F.collect_list(F.when(F.col("_last").isNull() | (F.col("_no") >= F.col("_last")),
                                           F.struct("_no", "text")))).alias("parts"))
    return folded.select("conv_id", "message", "role", F.array_join(F.col("parts.text"), "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """messages (conv_id, message, role, text) to rows (conv_id, formatted, loss).

    loss is an array of (start, length) in code points of `formatted`, one for each text of
    `loss_role`, in order; template strings are outside it. Roles are percent-encoded, so any role,
    null as "", can be read back. One conversation becomes one string and must fit a row.
    """
    part = F.struct("message", F.url_encode(F.coalesce("role", F.lit(""))).alias("role"),
                    F.coalesce(F.col("role") == loss_role, F.lit(False)).alias("learn"),
                    escape(F.coalesce("text", F.lit(""))).alias("body"))
    convs = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("m"))
    turns = convs.select("conv_id", "m", F.array_join(F.transform("m", lambda x: F.concat(
        F.lit(OPEN), x["role"], F.lit(ROLE_END), x["body"], F.lit(CLOSE + STOP))), "").alias("formatted"))
    head, tail = len(OPEN + ROLE_END), len(CLOSE + STOP)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(a, x):
        at, n = a["at"] + head + F.length(x["role"]), F.length(x["body"])
        span = F.array(F.struct(at.alias("start"), n.alias("length")))
        return F.struct((at + n + tail).alias("at"), F.when(x["learn"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    return turns.select("conv_id", "formatted", F.aggregate("m", start, step)["spans"].alias("loss"))


def read_back(rendered: DataFrame) -> DataFrame:
    """Rows (conv_id, turns array of (role, text), loss_text): the rendered string read again."""
    pairs = F.arrays_zip(F.regexp_extract_all("formatted", F.lit(TURN), F.lit(1)).alias("role"),
                         F.regexp_extract_all("formatted", F.lit(TURN), F.lit(2)).alias("body"))
    turns = F.transform(pairs, lambda x: F.struct(F.url_decode(x["role"]).alias("role"), unescape(x["body"]).alias("text")))
    learnt = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return rendered.select("conv_id", "formatted", turns.alias("turns"), F.array_join(learnt, "").alias("loss_text"))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Each row of (conv_id, turn, role, text) as the start of a message and one delta with its text.

    Messages are numbered by turn, role and text, so rows that share a turn stay apart.
    """
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    numbered = conversations.select("conv_id", number.cast("bigint").alias("message"), "role", "text")
    kinds = F.explode(F.array(F.struct(F.lit(0).alias("n"), F.lit("message").alias("kind")),
                              F.struct(F.lit(1).alias("n"), F.lit("delta").alias("kind"))))
    return numbered.withColumn("_e", kinds).select(
        "conv_id", "message", (2 * F.col("message") + F.col("_e.n")).alias("seq"), F.col("_e.kind").alias("kind"),
        F.when(F.col("_e.n") == 0, F.col("role")).alias("role"), F.when(F.col("_e.n") == 1, F.col("text")).alias("text"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op8_chat_events(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    back = read_back(render(final_messages(conversation_events(rows.unionByName(own)))))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def oracle() -> str:
    plain = CONTROL.replace("'", "''")
    extra = len(OPEN + ROLE_END + CLOSE + STOP)
    return f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}'))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
      sum({extra} + length(role) + length(text) + len(regexp_extract_all(text, '{plain}')))::BIGINT AS formatted_chars
    FROM c GROUP BY conv_id"""
