r"""Operator 2: chat formatting from an event log, in DataFrame functions only.

``fold`` turns an event log into final messages. Events are
``conv_id, message, seq, kind, role, text``: ``message`` orders the messages of
a conversation, ``seq`` the events of the log. ``delta`` appends its text,
``edit`` replaces what the message holds so far, ``regenerate`` throws it away
so that later deltas start anew. A message's role is that of its last event that
has one.

``render`` writes one text per conversation. Every turn starts with ``<s>``:

* assistant: ``<s>`` text ``</s>``
* any other role: ``<s>[INST]`` role newline text ``[/INST]``

Control strings inside texts get a backslash after their first character
(``<s>`` becomes ``<\s>``, ``<\s>`` becomes ``<\\s>``), so no text can end its
turn, and ``unescape`` undoes exactly that. In a role, backslash and line feed
are written ``\\`` and ``\n``. ``loss_spans`` are the code-point ranges
(start, end exclusive) of all assistant texts.

Defined results: null text and null role count as empty; rows that tie in every
order column are equal, so their order does not show; repeated rows are turns of
their own; a null conv_id is one conversation; an empty log gives no rows.

Deltas are put together per message, so a hot conversation's log is spread by
message; one conversation's finished text is one row by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    t = F.regexp_replace(text, r"<(\\*)(/?s>|</?SYS>>)", r"<\\$1$2")
    return F.regexp_replace(t, r"\[(\\*)(/?INST\])", r"[\\$1$2")


def unescape(text: Column) -> Column:
    t = F.regexp_replace(text, r"<\\(\\*)(/?s>|</?SYS>>)", r"<$1$2")
    return F.regexp_replace(t, r"\[\\(\\*)(/?INST\])", r"[$1$2")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of an event log."""
    e = events.select("conv_id", "message", "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    resets = F.col("kind").isin("edit", "regenerate")
    g = e.groupBy("conv_id", "message").agg(
        F.max(F.when(resets, F.col("seq"))).alias("reset"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
        F.array_sort(F.collect_list(F.when(F.col("kind") != "regenerate", F.struct("seq", "text")))).alias("parts"))
    live = F.filter("parts", lambda p: F.col("reset").isNull() | (p["seq"] >= F.col("reset")))
    return g.select("conv_id", "message", F.coalesce("role", F.lit("")).alias("role"),
                    F.array_join(F.transform(live, lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted``, ``n_turns``, ``loss_spans`` and,
    per turn, the span inside its own piece (``turn_spans``, null where no loss)."""
    learn = F.col("role") == ASSISTANT
    m = (messages
         .withColumn("body", escape(F.col("text")))
         .withColumn("head", F.when(learn, F.lit("<s>")).otherwise(F.concat(F.lit("<s>[INST]"), escape_role(F.col("role")), F.lit("\n"))))
         .withColumn("piece", F.concat("head", "body", F.when(learn, F.lit("</s>")).otherwise(F.lit("[/INST]"))))
         .withColumn("n", F.length("piece").cast("long")))
    line = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    m = (m.withColumn("at", F.coalesce(F.sum("n").over(line), F.lit(0)) + F.length("head"))
         .withColumn("span", F.when(learn, F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end"))))
         .withColumn("own", F.when(learn, F.struct(F.length("head").alias("start"), (F.length("head") + F.length("body")).alias("end")))))
    g = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("message", "piece", "span", "own"))).alias("t"))
    return g.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("t", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        F.transform("t", lambda x: x["own"]).alias("turn_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss texts parsed from ``formatted`` and its spans."""
    pieces = F.transform(F.slice(F.split("formatted", "<s>"), 2, 1 << 30), lambda p: F.concat(F.lit("<s>"), p))
    d = formatted.withColumn("pieces", pieces)

    def role(p):
        return F.when(F.startswith(p, F.lit("<s>[INST]")), unescape_role(F.substring_index(F.substr(p, F.lit(10)), "\n", 1))).otherwise(ASSISTANT)

    def text(p):
        line = F.locate("\n", p)
        return unescape(F.when(F.startswith(p, F.lit("<s>[INST]")), F.substr(p, line + 1, F.length(p) - line - 7))
                        .otherwise(F.substr(p, F.lit(4), F.length(p) - 7)))

    masked = F.zip_with("pieces", "turn_spans", lambda p, s: F.when(
        s.isNotNull(), unescape(F.substr(p, s["start"] + 1, s["end"] - s["start"]))))
    return d.select(
        "conv_id", "n_turns", "formatted",
        F.transform("pieces", lambda p: F.struct(role(p).alias("role"), text(p).alias("text"))).alias("turns"),
        F.array_join(masked, "").alias("loss_text"))


def event_log(rows: DataFrame, chunk: int = 400) -> DataFrame:
    """The event log that streaming the given turns would have left.

    Assistant texts come as a dropped first attempt (the text's first chunk),
    a ``regenerate``, then deltas of ``chunk`` code points. Other texts come as a
    first half that an ``edit`` replaces by the whole."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    r = rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    r = r.withColumn("message", F.row_number().over(order))
    n = F.greatest(F.lit(1), F.ceil(F.length("text") / chunk)).cast("int")

    def event(kind, role, text):
        return F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    none = F.lit(None).cast("string")
    streamed = F.concat(
        F.array(event("delta", F.col("role"), F.substring("text", 1, chunk)), event("regenerate", none, none)),
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: event("delta", none, F.substr(F.col("text"), i * chunk + 1, F.lit(chunk)))))
    edited = F.array(event("delta", F.col("role"), F.substr(F.col("text"), F.lit(1), (F.length("text") / 2).cast("int"))),
                     event("edit", none, F.col("text")))
    return (r.select("conv_id", "message", F.posexplode(F.when(F.col("role") == ASSISTANT, streamed).otherwise(edited)).alias("step", "e"))
            .select("conv_id", "message", F.struct("message", "step").alias("seq"), "e.kind", "e.role", "e.text"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Turn rows -> event log -> folded messages -> rendered conversations."""
    return render(fold(event_log(rows)))


def digests(rows: DataFrame) -> DataFrame:
    d = read_back(format_conversations(rows))
    return d.select(
        "conv_id", "n_turns",
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
