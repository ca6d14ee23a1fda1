"""Operator 4: chat formatting from an event log, in DataFrame functions only.

An event is (conv_id, seq, op, turn, role, text).  ``op``:

* ``message``     sets the text of its turn,
* ``delta``       appends to it (streamed answers),
* ``edit``        replaces it; a null role keeps the turn's role,
* ``regenerate``  drops what the turn and all later turns have so far and
  starts the turn anew with its text.

Events are partitioned by conversation and ordered by ``seq``; one shuffle
serves the windows and both aggregations, since all are by ``conv_id``.  The
final messages are rendered with a template that marks turns::

    ### role: text</turn>\\n

Inside roles and texts the backslash, ``### `` and ``</turn>`` (and ``: `` in
roles) are escaped, so a reader can split at the marks and get every text back.
``loss_spans`` are the code point ranges of the assistant texts in the output.

Cases.  Null text: empty; null role: empty; null ``op``: ``message``; null or
equal ``seq``: ordered by (seq nulls first, turn, op, role, text).  Rows of a
null conv_id are one conversation.  No rows give no rows.  Extra columns are
ignored.  A conversation's turns and its formatted text are one row, as the
format asks, so one that holds a third of all rows is one task's, and a text of
2 GB or more has no row that could hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, MIDDLE, END = "### ", ": ", "</turn>\n"


def _swap(c, pairs):
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(c: Column, role: bool = False) -> Column:
    return _swap(c, [("\\", "\\b"), ("### ", "\\h"), ("</turn>", "\\l")] + [(": ", "\\c")] * role)


def unescape(c: Column) -> Column:
    return _swap(c, [("\\c", ": "), ("\\l", "</turn>"), ("\\h", "### "), ("\\b", "\\")])


def messages(events: DataFrame) -> DataFrame:
    """Final (conv_id, turn, role, text) of an event log."""
    e = events.select("conv_id", F.col("seq").cast("long").alias("seq"), F.coalesce("op", F.lit("message")).alias("op"),
                      F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("seq", "turn", "op", "role", "text")]
    e = e.withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    later = Window.partitionBy("conv_id").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    restart = F.min(F.when(F.col("op") == "regenerate", F.col("turn"))).over(later)
    e = e.withColumn("restart", restart).where("restart is null or restart > turn or turn is null")
    e = e.groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list(F.struct("at", "op", "role", "text"))).alias("e"))
    # a delta appends to the last event that set the text
    last_set = F.array_max(F.transform("e", lambda x, i: F.when(x["op"] == "delta", F.lit(0)).otherwise(i)))
    roles = F.filter(F.transform("e", lambda x: x["role"]), lambda r: r.isNotNull())
    return e.select("conv_id", "turn", F.element_at(roles, F.when(F.size(roles) > 0, F.lit(-1)).otherwise(F.lit(None).cast("int"))).alias("role"),
                    F.array_join(F.transform(F.slice("e", last_set + 1, F.size("e")), lambda x: x["text"]), "").alias("text"))


def render(events: DataFrame) -> DataFrame:
    """Event log -> conv_id, n_turns, formatted, loss_spans (code points, end
    exclusive)."""
    m = messages(events).select(
        "conv_id", "turn", F.concat(F.lit(START), escape(F.coalesce("role", F.lit("")), role=True), F.lit(MIDDLE)).alias("head"),
        escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("learn"))
    m = m.withColumn("piece", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("start", F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0).cast("long")) + F.char_length("head"))
    m = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "start", "piece", (F.col("start") + F.char_length("body")).alias("end"), "learn"))).alias("m"))
    return m.select("conv_id", F.size("m").cast("long").alias("n_turns"),
                    F.array_join(F.transform("m", lambda x: x["piece"]), "").alias("formatted"),
                    F.transform(F.filter("m", lambda x: x["learn"]),
                                lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (array of role, text) and ``loss_text``, both read from
    the rendered text."""
    parts = F.split("formatted", END, -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    turns = F.transform(parts, lambda p: F.struct(
        unescape(F.substr(F.substring_index(p, MIDDLE, 1), F.lit(len(START) + 1))).alias("role"),
        unescape(F.substr(p, F.char_length(F.substring_index(p, MIDDLE, 1)) + len(MIDDLE) + 1)).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.withColumn("turns", turns).withColumn("loss_text", F.array_join(loss, ""))


def conversation_events(conversations: DataFrame, pieces: int = 8, least: int = 24) -> DataFrame:
    """The event log that a chat service would have written for a table of
    finished turns: every row is a turn of its own, in the order of (turn, role,
    text), and its events fold back to it.

    * An assistant turn is streamed twice: deltas of a first answer (the text
      backwards, cut short), a user's reply to it under the next turn number, a
      ``regenerate`` that drops both, then at most ``pieces`` deltas of ``least``
      or more code points that make up the text.
    * A user turn is a ``message`` with a slip, then an ``edit`` to its text.
    * Any other turn is one ``message``.

    Events come out newest first; only ``seq`` tells their order."""
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long")
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).select("conv_id", at.alias("turn"), "role", "text")
    # the largest piece of a text cut into ``pieces``, or ``least`` of a short one
    rows = rows.withColumn("_n", F.char_length("text")).withColumn(
        "_size", F.greatest(F.lit(least), F.ceil(F.col("_n") / pieces)).cast("int"))

    def event(op, text, turn=F.col("turn"), role=F.col("role")):
        return F.struct(F.lit(op).alias("op"), turn.alias("turn"), role.alias("role"), text.alias("text"))

    none = F.lit(None).cast("string")
    cuts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("_n") / F.col("_size")).cast("int") - 1))

    def deltas(text):
        return F.transform(cuts, lambda k: event("delta", F.substr(text, k * F.col("_size") + 1, F.col("_size"))))

    draft = F.reverse(F.substr(F.col("text"), F.lit(1), F.col("_size")))
    streamed = F.concat(F.array(event("delta", draft), event("delta", F.lit(" ...")),
                                event("message", F.lit("Try again?"), F.col("turn") + 1, F.lit("user")),
                                event("regenerate", F.lit(""))), deltas(F.col("text")))
    typed = F.array(event("message", F.concat(F.col("text"), F.lit(" (sic)"))), event("edit", F.col("text"), role=none))
    events = F.when(F.col("role") == "assistant", streamed).when(F.col("role") == "user", typed).otherwise(
        F.array(event("message", F.col("text"))))
    e = rows.withColumn("_events", events).select("conv_id", F.col("turn").alias("_at"), F.size("_events").alias("_last"), F.posexplode(F.reverse("_events")))
    seq = F.col("_at") * F.lit(1 << 20) + F.col("_last") - F.col("pos")
    return e.select("conv_id", seq.alias("seq"), "col.op", "col.turn", "col.role", "col.text")
