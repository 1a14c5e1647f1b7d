"""Chat formatting by event sourcing, in DataFrame functions alone.

A conversation is a log of events (conv_id, seq, op, role, text, target). They are gathered by conversation, sorted by
sequence and folded into final messages:

* `message` opens a message with a role and a first text;
* `delta` appends to it (a streamed piece);
* `edit` replaces what it holds;
* `regenerate` empties it, so that later deltas write it anew.

An event other than `message` belongs to the message last opened before it, or, with a target, to the one opened at
seq = target. A message's events either all have a target or none.

Rendering: each turn is `### role: text</turn>` and a line feed. Inside roles and texts a backslash goes before every
backslash, before the last character of `</turn>`, inside `##` and, in roles, before a colon, so that no control
string survives inside; removing one backslash before each character reverts it.

Null conv_id, role and text: the conversations without id form one of their own with a null id; other nulls count as
empty. Events before any message, and those whose op isn't known, are ignored. Repeated rows and equal seq are kept, in
the order of op, role and text (messages first). Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEAD, TURN_END = "### ", "</turn>"
ASSISTANT = "assistant"
_BEFORE = {"message": 0, "regenerate": 1, "edit": 2, "delta": 3}


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit(TURN_END), F.lit("</turn\\>"))
    out = F.replace(out, F.lit("##"), F.lit("#\\#"))
    return F.replace(out, F.lit(":"), F.lit("\\:")) if role else out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>) from events (conv_id, seq, op, role, text, target)."""
    op = F.col("op").cast("string")
    order = F.create_map(*[F.lit(x) for kv in _BEFORE.items() for x in kv])
    e = events.where(op.isin(*_BEFORE)).select(
        "conv_id",
        F.struct(
            F.coalesce(F.col("target").cast("long"), F.col("seq").cast("long")).alias("owner"),
            (op != "message").alias("later"),
            F.col("seq").cast("long").alias("seq"),
            order[op].alias("rank"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("e"),
    )
    log = e.groupBy("conv_id").agg(F.sort_array(F.collect_list("e")).alias("log"))
    opens = F.filter(F.sequence(F.lit(1), F.size("log")), lambda i: F.element_at("log", i)["rank"] == 0)
    log = log.withColumn("opens", F.when(F.size("log") > 0, opens))

    def message(start: Column, k: Column) -> Column:
        stop = F.when(k + 1 < F.size("opens"), F.get("opens", k + 1)).otherwise(F.size("log") + 1)
        own = F.slice("log", start, stop - start)
        # the last event that sets the text; what follows it is appended
        last = F.array_max(F.transform(own, lambda x, i: F.when(x["rank"] != 3, i + 1)))
        kept = F.slice(own, last, F.size(own) - last + 1)
        pieces = F.transform(kept, lambda x: F.when(x["rank"] == 1, F.lit("")).otherwise(x["text"]))
        whole = F.when(stop - start == 1, F.element_at("log", start)["text"]).otherwise(F.array_join(pieces, ""))
        return F.struct(F.element_at("log", start)["role"].alias("role"), whole.alias("text"))

    return log.select("conv_id", F.transform("opens", message).alias("turns"))


def render(folded: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss array<struct<start, length>>): the text and, in code points from 1, its assistant parts."""
    turn = folded.select("conv_id", F.posexplode_outer("turns").alias("pos", "t")).select(
        "conv_id", "pos",
        F.concat(F.lit(HEAD), escape(F.col("t.role"), role=True), F.lit(": ")).alias("head"),
        escape(F.col("t.text")).alias("body"),
        (F.lower("t.role") == ASSISTANT).alias("loss"),
    )
    piece = F.concat("head", "body", F.lit(TURN_END + "\n"))
    before = F.coalesce(F.sum(F.length(piece)).over(Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    span = F.struct((before + F.length("head") + 1).alias("start"), F.length("body").cast("long").alias("length"))
    placed = turn.select("conv_id", F.when(F.col("pos").isNotNull(), F.struct("pos", piece.alias("piece"), "loss", span.alias("span"))).alias("x"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("x", lambda p: p["piece"]), "").alias("formatted"),
        F.transform(F.filter("x", lambda p: p["loss"]), lambda p: p["span"]).alias("loss"),
    )


def parse(formatted: Column) -> Column:
    """The turns array<struct<role, text>> of a rendered conversation, unescaped."""
    turns = F.split(formatted, F.lit("</turn>\n"), -1)
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)
    body = lambda t: F.substr(t, F.lit(len(HEAD) + 1))
    # a role's colons are escaped, so the first `: ` that has no backslash before its colon ends it
    role = lambda t: F.regexp_extract(body(t), r"(?s)^((?:[^\\:]|\\.)*): ", 1)
    return F.transform(turns, lambda t: F.struct(unescape(role(t)).alias("role"), unescape(F.substr(body(t), F.length(role(t)) + 3)).alias("text")))


def read_back(rendered: DataFrame) -> DataFrame:
    """What a consumer reads from (conv_id, formatted, loss): turns, and the text under the loss mask, as digests."""
    under = F.array_join(F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"].cast("int"), s["length"].cast("int")))), "")
    r = rendered.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), parse(F.col("formatted")).alias("turns"), under.alias("under"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return r.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("turns_sha256"),
        F.length("under").cast("long").alias("loss_chars"),
        F.sha2(F.encode("under", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def events_of(conversations: DataFrame) -> DataFrame:
    """A table of turns (conv_id, turn, role, text) as the events of its log."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("seq"), F.lit("message").alias("op"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.lit(None).cast("long").alias("target"),
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    return render(fold(events_of(conversations)))
