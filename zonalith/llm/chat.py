"""Chat formatting with typed content parts, in DataFrame functions only.

A turn is `<|im_start|>` role `<|im_sep|>` content `<|im_end|>`. Inside roles and texts a backslash is doubled and `<|`
becomes `<\\|`, so no control string can occur there, and `unescape` restores every text. Content is an array of parts;
a visitor over the array renders each by its type: text is escaped; image, audio and document parts become a placeholder
`<|kind|>` and are recorded in order with their reference and the number of tokens the placeholder expands to.

Defined results: null texts, roles, parts and part types count as empty; a null turn comes first; equal turns of a
conversation stand in order of role and content; adjacent text parts are escaped as one text; rows with a null conversation id form one conversation; an empty table
gives an empty result; other columns are not carried.

Scale: one shuffle by conversation. A conversation's formatted text is one value, so the longest conversation, and
nothing else, bounds a task's memory. All steps are linear in the text: spans are kept in bytes as well as in characters,
since a binary column can be cut at an offset without a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
#: Tokens a placeholder expands to: a patch of the image, a slice of the audio, a page of the document.
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 256


def escape(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def text_part(text: Column) -> Column:
    """A content array of one text part."""
    none = F.lit(None)
    fields = [F.lit("text").alias("type"), text.alias("text"), none.cast("string").alias("ref"), none.cast("int").alias("width"), none.cast("int").alias("height"), none.cast("double").alias("seconds"), none.cast("int").alias("pages")]
    return F.array(F.struct(*fields))


def placeholder(kind: str) -> str:
    return f"<|{kind}|>"


def visit(part: Column) -> Column:
    """struct(body, kind, ref, tokens) of one part; an unknown type renders its text."""
    kind = F.coalesce(part["type"], F.lit("text"))
    ceil = lambda x: F.ceil(x).cast("long")
    image = ceil(F.coalesce(part["width"], F.lit(0)) / PATCH) * ceil(F.coalesce(part["height"], F.lit(0)) / PATCH)
    audio = ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_RATE)
    pages = F.coalesce(part["pages"], F.lit(0)).cast("long") * PAGE_TOKENS
    body, tokens = escape(part["text"]), F.lit(0).cast("long")
    for name, cost in (("image", image), ("audio", audio), ("document", pages)):
        body = F.when(kind == name, F.lit(placeholder(name))).otherwise(body)
        tokens = F.when(kind == name, cost).otherwise(tokens)
    attached = kind.isin("image", "audio", "document")
    return F.struct(body.alias("body"), F.when(attached, kind).alias("kind"), F.when(attached, part["ref"]).alias("ref"), tokens.alias("tokens"))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", loss_roles: tuple = ("assistant",)) -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans (characters) and loss_bytes (bytes): arrays of (start from 0, length),
    attachments: array of (turn from 0, kind, ref, tokens), expanded_tokens."""
    parts = F.transform(F.filter(F.coalesce(F.col(parts_col), F.array()), lambda p: p.isNotNull()), visit)
    t = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), parts.alias("parts"))
    t = t.withColumn("bodies", F.filter(F.transform("parts", lambda p: p["body"]), lambda b: b != ""))
    # Each part's text is escaped alone; where one ends in `<` and the next goes on with `|`, the two are kept apart as well.
    joint = lambda b, i: F.when((i > 0) & F.get(F.col("bodies"), i - 1).endswith("<") & b.startswith("|"), F.concat(F.lit("\\"), b)).otherwise(b)
    t = t.withColumn("body", F.array_join(F.transform("bodies", joint), "")).drop("bodies")
    t = t.withColumn("head", F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)))
    t = t.withColumn("segment", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    at = lambda length: F.coalesce(F.sum(length("segment")).over(before), F.lit(0)) + length("head")
    t = t.withColumn("k", F.row_number().over(order) - 1)
    t = t.withColumn("chars_at", at(lambda c: F.char_length(F.col(c))).cast("long")).withColumn("bytes_at", at(F.octet_length).cast("long"))
    loss = F.col("role").isin(*loss_roles)
    attached = F.transform(F.filter("parts", lambda p: p["kind"].isNotNull()), lambda p: F.struct(F.col("k").alias("turn"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))
    one = F.struct(
        "k",
        "segment",
        F.when(loss, F.struct(F.col("chars_at").alias("start"), F.char_length("body").cast("long").alias("length"))).alias("chars"),
        F.when(loss, F.struct(F.col("bytes_at").alias("start"), F.octet_length("body").cast("long").alias("length"))).alias("bytes"),
        attached.alias("attached"),
    )
    g = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    spans = lambda c: F.filter(F.transform("turns", lambda x: x[c]), lambda s: s.isNotNull())
    out = g.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda x: x["segment"]), "").alias("formatted"),
        spans("chars").alias("loss_spans"),
        spans("bytes").alias("loss_bytes"),
        F.flatten(F.transform("turns", lambda x: x["attached"])).alias("attachments"),
    )
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda s, x: s + x["tokens"])
    return out.withColumn("expanded_tokens", total)


def parse_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_end\|>", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(p: Column) -> Column:
        cut = F.instr(p, SEP)
        role = F.substring(p, F.lit(len(START) + 1), cut - 1 - len(START))
        text = F.substring(p, cut + len(SEP), F.char_length(p))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, loss_bytes: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    cut = lambda whole: F.transform(loss_bytes, lambda s: unescape(F.decode(F.substring(whole, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")))
    # The bytes are made once, as the element of a one-element array, and not once for each span.
    return F.array_join(F.flatten(F.transform(F.array(F.encode(formatted, "UTF-8")), cut)), "")
