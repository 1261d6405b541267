"""Chat formatting of typed content parts with a reversible template and a loss mask, in DataFrame functions only.

A turn becomes ``<|im_start|>role``, a line end, its content and ``<|im_end|>`` with a line end. A visitor flattens the
content: text is escaped (a backslash before every backslash and between the two characters of ``<|``), an image,
audio or document part becomes its placeholder, in order, and is recorded with its reference and token count.
Inside texts no control string can arise, so the output can be split at the control strings and unescaped.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
# Placeholders of attachments, and tokens for one unit of each: image tiles, seconds of audio, document pages
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 600}
PART = "struct<type:string,text:string,ref:string,units:double>"
LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def text_parts(text: Column) -> Column:
    """A plain text as one text part; null as none."""
    part = F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("units"))
    return F.when(text.isNull(), F.array().cast(f"array<{PART}>")).otherwise(F.array(part).cast(f"array<{PART}>"))


def _visit(part: Column) -> Column:
    """A part as the template shows it: text escaped, others by placeholder; an unknown type shows its text."""
    shown = escape(F.coalesce(part["text"], F.lit("")))
    for kind in TOKENS_PER_UNIT:
        shown = F.when(part["type"] == kind, F.lit(f"<|{kind}|>")).otherwise(shown)
    return shown


def attachments(parts: Column) -> Column:
    """(type, ref, tokens) of the non-text parts in order. No or negative units count as one unit."""
    held = F.filter(parts, lambda p: p["type"].isin(*TOKENS_PER_UNIT))

    def priced(p: Column) -> Column:
        units = F.when(p["units"] >= 0, p["units"]).otherwise(1.0)
        rate = F.lit(0)
        for kind, tokens in TOKENS_PER_UNIT.items():
            rate = F.when(p["type"] == kind, tokens).otherwise(rate)
        return F.struct(p["type"].alias("type"), p["ref"].alias("ref"), F.ceil(units * rate).cast("long").alias("tokens"))

    return F.transform(held, priced)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts: Column | None = None,
                 text_col: str = "text", loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """One row per conversation: id, formatted, loss_spans, attachments, attachment_tokens.

    ``loss_spans`` are (start, size) of the contents of ``loss_roles`` in code points of ``formatted``. Rows go by turn,
    ties by role and content; repeated rows are repeated turns. Null texts and roles are empty, null turns come
    first, rows with a null id form one conversation. ``parts`` (an array of type, text, ref, units) defaults to the
    text column as one part. Other columns are not read; no turns, no rows. A conversation is one output row and
    has to fit into a task; places come from running sums, so the work is linear in its length.
    """
    content = text_parts(F.col(text_col).cast("string")) if parts is None else F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        content.alias("parts"))
    rows = rows.select("conv", "turn", "role", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
                       F.array_join(F.transform("parts", _visit), "").alias("body"), attachments(F.col("parts")).alias("held"))
    size = F.length("head") + F.length("body") + len(END)
    before = Window.partitionBy("conv").orderBy("turn", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")
    placed = rows.withColumn("start", start).withColumn("span", F.when(
        F.col("role").isin(*loss_roles), F.struct(F.col("start").alias("start"), F.length("body").cast("long").alias("size"))))
    turn = F.struct("start", F.concat("head", "body", F.lit(END)).alias("shown"), "span", "held")
    gathered = placed.groupBy("conv").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    held = F.flatten(F.transform("turns", lambda t: t["held"]))
    return gathered.select(F.col("conv").alias(conv_col), F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
                           F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"), held.alias("attachments"),
                           F.aggregate(held, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped; placeholders stay as they are."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    raw = F.slice(pieces, 1, F.size(pieces) - 1)
    role = lambda t: F.regexp_extract(t, r"(?s)^<\|im_start\|>((?:[^\\\n]++|\\.)*+)\n", 1)
    return F.transform(raw, lambda t: F.struct(
        unescape(role(t)).alias("role"), unescape(F.substring(t, F.lit(len(START) + 2) + F.length(role(t)), F.length(t))).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under each span of the loss mask."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["size"].cast("int"))))


def digest(chats: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and hashes of ``format_chats`` output, all read back from it."""
    read = chats.select(conv_col, "formatted", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(shown, 256).alias("turns_sha256"),
                       F.length(F.array_join("loss", "")).cast("long").alias("loss_chars"), F.sha2(F.array_join("loss", ""), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
