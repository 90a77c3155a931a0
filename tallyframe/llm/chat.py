"""Chat formatting with typed content parts, in DataFrame functions only.

A row is a turn: ``conv_id``, ``turn``, ``role`` and ``parts``, an array of PART structs. A visitor
flattens the parts of a turn in their order: text is escaped and copied, every image, audio or
document part becomes a placeholder numbered through the conversation. What a placeholder stands
for is recorded as an attachment: its reference, where its placeholder is, and how many tokens it
expands to in the model's input.

A turn is written ``<|turn|>role<|body|>content<|end|>``. Control strings inside roles and texts get
a backslash after their first character (one more than they have there), so that no text can forge
a mark and reading back restores each text exactly.

Defined results: rows are ordered by turn, nulls last, then by role and content; each row is a turn,
repeated ones too. A null role, text or array of parts is empty, a null part is skipped, a part of
unknown kind is its text. Rows without ``conv_id`` form one conversation. Measures that are null or
negative count as zero, and every attachment expands to one token at least. A conversation is one
string and so must fit one task; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
KINDS = ("image", "audio", "document")

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
#: What may not appear inside a text: our marks, and the turn marks of common other templates.
_HEAD, _TAIL = r"([<\[])", r"(\||/?s>|/?INST\])"

#: Expanded sizes: pixels along a side of an image token, audio tokens a second, tokens a page.
IMAGE_SIDE, AUDIO_RATE, PAGE_TOKENS = 28, 12.5, 256


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"(\\*)" + _TAIL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + r"\\(\\*)" + _TAIL, "$1$2$3")


def expanded_tokens(part: Column) -> Column:
    """How many tokens the attachment takes in the model's input."""

    def measure(name: str) -> Column:
        return F.greatest(F.coalesce(part[name], F.lit(0)), F.lit(0)).cast("double")

    size = (
        F.when(part["kind"] == "image", F.ceil(measure("width") / IMAGE_SIDE) * F.ceil(measure("height") / IMAGE_SIDE))
        .when(part["kind"] == "audio", F.ceil(measure("seconds") * AUDIO_RATE))
        .otherwise(measure("pages") * PAGE_TOKENS)
    )
    return F.greatest(size.cast("bigint"), F.lit(1).cast("bigint"))


def text_part(text: Column) -> Column:
    """An array of one text part."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(
        F.struct(F.lit("text").alias("kind"), text.alias("text"), *[F.lit(None).cast(t).alias(c) for c, t in empty.items()])
    )


def _is_attachment(part: Column) -> Column:
    return F.coalesce(part["kind"].isin(*KINDS), F.lit(False))


def _placeholder(kind: Column, number: Column) -> Column:
    return F.concat(F.lit("<|"), kind, F.lit(":"), number.cast("string"), F.lit("|>"))


def _visited(parts: Column, first: Column) -> Column:
    """The visitor: attachments become placeholders, numbered as they come; the text between two of them, which may
    come in several parts, is escaped as a whole, so that parts cannot make up a mark together."""
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("open"), first.cast("bigint").alias("number"))

    def visit(seen: Column, part: Column) -> Column:
        number = seen["number"] + 1
        closed = F.concat(seen["done"], escaped(seen["open"]), _placeholder(part["kind"], number))
        longer = F.concat(seen["open"], F.coalesce(part["text"], F.lit("")))
        is_attachment = _is_attachment(part)
        return F.struct(
            F.when(is_attachment, closed).otherwise(seen["done"]).alias("done"),
            F.when(is_attachment, F.lit("")).otherwise(longer).alias("open"),
            F.when(is_attachment, number).otherwise(seen["number"]).alias("number"),
        )

    return F.aggregate(parts, start, visit, lambda seen: F.concat(seen["done"], escaped(seen["open"])))


def format_chat(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, attachment_tokens.

    ``loss_spans`` holds the 0-based start and the length, in characters of ``formatted``, of each
    assistant content, which is what a model is trained on. ``attachments`` holds number, kind, ref,
    tokens and the start of the placeholder.
    """
    parts = F.filter(F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        parts.alias("parts"),
    ).withColumn("n_attached", F.size(F.filter("parts", _is_attachment)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "parts")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = rows.withColumn("place", F.row_number().over(order)).withColumn(
        "first", F.coalesce(F.sum("n_attached").over(before), F.lit(0))
    )
    attached = F.filter("parts", _is_attachment)
    visited = (
        numbered.withColumn("content", _visited(F.col("parts"), F.col("first")))
        .withColumn("head", F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(BODY)))
        .withColumn("written", F.char_length("head") + F.char_length("content") + len(END))
        .withColumn("start", F.coalesce(F.sum("written").over(before), F.lit(0)) + F.char_length("head"))
        .withColumn(
            "attached",
            F.transform(
                attached,
                lambda p, i: F.struct(
                    (F.col("first") + i + 1).cast("bigint").alias("number"),
                    p["kind"].alias("kind"),
                    p["ref"].alias("ref"),
                    expanded_tokens(p).alias("tokens"),
                    # A placeholder of ours cannot be forged, so its first occurrence is the one.
                    (F.col("start") + F.instr(F.col("content"), _placeholder(p["kind"], F.col("first") + i + 1)) - 1)
                    .cast("bigint")
                    .alias("start"),
                ),
            ),
        )
    )
    turn = F.struct(
        "place",
        F.concat("head", "content", F.lit(END)).alias("text"),
        F.col("start").cast("bigint").alias("start"),
        F.char_length("content").cast("bigint").alias("length"),
        (F.col("role") == "assistant").alias("trained"),
        "attached",
    )
    in_order = visited.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform(
        F.filter("turns", lambda t: t["trained"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))
    )
    return in_order.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["attached"])).alias("attachments"),
    ).withColumn(
        "attachment_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"])
    )


def read_chat(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of role and text, placeholders included in the text."""
    marked = F.split(formatted, r"<\|end\|>", -1)
    whole = F.slice(marked, 1, F.size(marked) - 1)

    def turn(written: Column) -> Column:
        sides = F.split(F.substring(written, len(TURN) + 1, 2**31 - 1), r"<\|body\|>", 2)
        return F.struct(unescaped(sides[0]).alias("role"), unescaped(sides[1]).alias("text"))

    return F.transform(whole, turn)


def trained_texts(formatted: Column, loss_spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(loss_spans, lambda s: unescaped(F.substring(formatted, s["start"].cast("int") + 1, s["length"].cast("int"))))
