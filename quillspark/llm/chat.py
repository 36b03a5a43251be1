"""Chat formatting with typed content parts.

A message's content is an array of typed parts (``PART``).  A visitor flattens
it, part by part, into the message body: text is escaped, an image, a sound or a
document becomes an ordered placeholder, and is recorded as an attachment with
its reference and the number of tokens it stands for.

The template is ``<|turn|>role<|body|>body<|end|>`` per message.  Texts and roles
cannot contain ``<|``: one backslash is put into every ``<``, backslashes, ``|``
run, and taken out again on reading, so the markers are unambiguous and any
text comes back as it was.

All steps are DataFrame functions.  Offsets come from a running sum over a
conversation's messages; a conversation is one output row, so its messages meet
in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

#: Tokens: one per image patch, per stretch of sound, and so many per document page.
PATCH, SECONDS_PER_TOKEN, TOKENS_PER_PAGE = 28, 0.04, 512

LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def text_parts(text: Column) -> Column:
    """Plain text as a content array of one text part."""
    none = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"),
                            *[F.lit(None).cast(t).alias(c) for c, t in none.items()]))


def _tokens(p: Column) -> Column:
    """Tokens that an attachment expands to (unknown sizes count nothing)."""
    image = F.ceil(p["width"] / PATCH) * F.ceil(p["height"] / PATCH)
    n = (F.when(p["type"] == "image", image).when(p["type"] == "audio", F.ceil(p["seconds"] / SECONDS_PER_TOKEN))
         .when(p["type"] == "document", p["pages"] * TOKENS_PER_PAGE))
    return F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).cast("long")


def _kind(p: Column) -> Column:
    return F.when(p["type"].isin("image", "audio", "document"), p["type"]).otherwise(F.lit("other"))


def visit(content: Column) -> Column:
    """Content parts -> struct of ``body`` and ``attachments(kind, ordinal, ref, tokens)``.

    Placeholders ``<|kind:ordinal|>`` are numbered from 0 in a message.  A null
    part, or one of no known type, becomes a placeholder of kind ``other``
    without tokens; a text part without text is empty; null content has no parts.
    """
    parts = F.coalesce(content, F.array().cast(f"array<{PART}>"))
    is_text = lambda p: F.coalesce(p["type"] == "text", F.lit(False))
    held = F.filter(parts, lambda p: ~is_text(p))
    attachments = F.transform(held, lambda p, i: F.struct(_kind(p).alias("kind"), i.alias("ordinal"), p["ref"].alias("ref"),
                                                          _tokens(p).alias("tokens")))
    start = F.struct(F.lit("").alias("body"), F.lit(0).alias("n"))
    flat = F.aggregate(parts, start, lambda acc, p: F.struct(
        F.concat(acc["body"], F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
            F.concat(F.lit("<|"), _kind(p), F.lit(":"), acc["n"].cast("string"), F.lit("|>")))).alias("body"),
        (acc["n"] + F.when(is_text(p), 0).otherwise(1)).alias("n")))
    return F.struct(flat["body"].alias("body"), attachments.alias("attachments"))


def format_chats(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 content: str = "content", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss, attachments, n_tokens_attached``.

    Messages go by ``turn``, then role and body (nulls first); repeated rows are
    repeated messages; a null role is empty.  ``loss`` lists, for each message of
    ``loss_role``, its ``message`` number, the ``start`` of its body in
    ``formatted``, the ``offset`` in its own message and the ``length``, in code
    points.  ``attachments`` carry the message number.  No messages, no rows.
    """
    who = escape(F.coalesce(F.col(f"`{role}`"), F.lit("")))
    rows = messages.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), who.alias("who"),
                           visit(F.col(f"`{content}`")).alias("seen"))
    head = F.concat(F.lit(TURN), F.col("who"), F.lit(BODY))
    rows = rows.select("conv_id", "turn", "who", F.col("seen.attachments").alias("attachments"),
                       F.concat(head, "seen.body", F.lit(END)).alias("piece"),
                       F.char_length(head).alias("offset"), F.char_length("seen.body").alias("length"))
    order = Window.partitionBy("conv_id").orderBy("turn", "who", "piece")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("n", F.row_number().over(order) - 1).withColumn(
        "at", F.coalesce(F.sum(F.char_length("piece").cast("long")).over(before), F.lit(0)))
    loss = F.when(F.col("who") == loss_role, F.struct(
        F.col("n").alias("message"), (F.col("at") + F.col("offset")).alias("start"), "offset", "length"))
    held = F.transform("attachments", lambda a: F.struct(F.col("n").alias("message"), a["kind"].alias("kind"),
                                                         a["ordinal"].alias("ordinal"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))
    grouped = rows.select("conv_id", F.struct("n", "piece", loss.alias("loss"), held.alias("held")).alias("m")).groupBy(
        "conv_id").agg(F.array_sort(F.collect_list("m")).alias("m"))
    attachments = F.flatten(F.col("m.held"))
    return grouped.select("conv_id", F.array_join("m.piece", "").alias("formatted"),
                          F.filter("m.loss", lambda x: x.isNotNull()).alias("loss"), attachments.alias("attachments"),
                          F.aggregate(attachments, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("n_tokens_attached"))


def read_turns(formatted: Column) -> Column:
    """Formatted text -> array of ``role, text``, unescaped (placeholders stay)."""
    pieces = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, BODY, 1)).alias("role"),
        unescape(F.substring_index(F.substring_index(p, END, 1), BODY, -1)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    pieces = F.split(formatted, r"(?=<\|turn\|>)")
    return F.array_join(F.transform(loss, lambda x: unescape(
        F.element_at(pieces, x["message"] + 1).substr(x["offset"] + 1, x["length"]))), "")
