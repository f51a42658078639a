"""Chat formatting in budgeted windows (operator 2); DataFrame functions only.

Method: prefix sums of the turns' tokens choose windows that begin and end at turns: a window takes turns while system
turn, history allowance and new turns fit the budget (a turn that alone, beside the system turn, is larger makes a window of its own). Every window
but the first begins with the conversation's system turn, if its first turn is one, and with the last turns before it, as
many as the history allowance and ``history_turns`` let in. The loss mask covers each assistant text once, where it is new;
repeated turns are never in it.

The template writes a turn as ``### role: text</turn>`` and a line feed. Inside texts and roles a backslash becomes two,
``###`` becomes backslash h, ``</turn>`` backslash t, and in roles a colon backslash c; so markers stand only where turns
begin and end, and ``unescaped`` gives the text back.

Null texts and roles count as empty; rows sort by turn, role and text (null turns first); repeated rows are turns of their
own; a null conv_id is a conversation like any other. An empty table gives no rows.

Turns are shuffled once, by conversation. Of a conversation of any length a task holds the numbers of its turns' tokens (about
50 bytes a turn) and one window's turns; texts pass through sorts that spill. Only the query's digests need a conversation's
whole text at once (measured: 200,000 turns, 41 MB of text, in a heap of 1.8 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amplicore.llm._common import table

#: Tokens of a turn's marks, beside those of its text (words, unless given).
MARKS = 4
WORD = r"[^\x20\x09-\x0D]+"
END = "</turn>\n"
#: Turns of a conversation that are looked at together for window bounds.
PART = 512


def escaped(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("###"), F.lit("\\h")), F.lit("</turn>"), F.lit("\\t"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescaped(text: Column) -> Column:
    """Parts between double backslashes hold marks only, so each can be undone by itself."""

    def undone(p: Column) -> Column:
        return F.replace(F.replace(F.replace(p, F.lit("\\h"), F.lit("###")), F.lit("\\t"), F.lit("</turn>")), F.lit("\\c"), F.lit(":"))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), undone), "\\")


def windows(conversations: DataFrame, budget: int = 256, history: int = 64, history_turns: int = 4, tokens: Column | None = None) -> DataFrame:
    """conv_id, window, first (its first new turn), n_new, n_repeated, text, mask (array of start and length), tokens; key (conv_id
    as a struct, which isn't null) says how the rows are dealt, so that what groups by it needs no exchange."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    n = F.regexp_count(text, F.lit(WORD)) if tokens is None else tokens
    rows = conversations.select(F.struct("conv_id").alias("key"), "turn", role.alias("role"), text.alias("text"), (n + MARKS).cast("long").alias("tok"))
    sorted_ = Window.partitionBy("key").orderBy("turn", "role", "text")
    rows = rows.withColumn("ord", F.row_number().over(sorted_) - 1)
    # one row of a conversation beside its turns: each looks itself up in its part, nothing is copied
    begins = _begins(rows, budget - history).hint("merge").alias("b")
    here = F.get(F.col("b.found"), (F.col("ord") / PART).cast("int"))
    turns = rows.alias("t").join(begins, F.col("t.key") == F.col("b.key")).select("t.key", "ord", "role", "text", "tok", F.array_contains(here, F.col("ord")).alias("begin"))
    turns = turns.withColumn("body", escaped(F.col("text"))).withColumn("head", F.concat(F.lit("### "), escaped(F.col("role"), role=True), F.lit(": "))).withColumn("piece", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("key").orderBy("ord")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begin = F.col("begin") & (F.col("ord") > 0)
    first = F.when(F.first("role").over(so_far) == "system", F.struct(F.first("piece").over(so_far).alias("piece"), F.first("tok").over(so_far).alias("tok")))
    cols = [F.when(begin, first).alias("kept")]
    for k in range(history_turns, 0, -1):
        past = F.struct(F.lag("piece", k).over(order).alias("piece"), F.lag("tok", k).over(order).alias("tok"))
        system = (F.col("ord") == k) & (F.lag("role", k).over(order) == "system")
        fits = F.sum("tok").over(order.rowsBetween(-k, -1)) <= history
        cols.append(F.when(begin & (F.col("ord") >= k) & ~system & fits, past).alias(f"past{k}"))
    past_cols = ["kept", *[f"past{k}" for k in range(history_turns, 0, -1)]]
    turns = turns.select("key", "ord", "tok", "piece", (F.col("role") == "assistant").alias("learn"), F.length("head").alias("skip"), F.length("body").alias("size"), (F.sum(F.col("begin").cast("int")).over(so_far) - 1).cast("int").alias("window"), begin.alias("begin"), F.sum(F.length("piece").cast("long")).over(so_far).alias("chars"), *cols)
    again = F.filter(F.array(*past_cols), lambda t: t.isNotNull())
    turn = F.struct("ord", "tok", "piece", "learn", "skip", "size", (F.col("chars") - F.length("piece")).alias("at"))
    out = turns.withColumn("again", F.when(F.col("begin"), again)).groupBy("key", "window").agg(F.array_sort(F.collect_list(turn)).alias("new"), F.max("again").alias("again"))
    out = out.withColumn("repeated", F.coalesce("again", F.slice(F.transform("new", lambda t: F.struct(t["piece"].alias("piece"), t["tok"].alias("tok"))), 1, 0)))
    out = out.withColumn("before", F.array_join(F.transform("repeated", lambda t: t["piece"]), ""))
    out = out.withColumn("lead", F.length("before").cast("long") - F.col("new")[0]["at"])
    mask = F.transform(F.filter("new", lambda t: t["learn"]), lambda t: F.struct((t["at"] + F.col("lead") + t["skip"]).cast("long").alias("start"), t["size"].alias("length")))
    total = F.aggregate(F.concat(F.transform("repeated", lambda t: t["tok"]), F.transform("new", lambda t: t["tok"])), F.lit(0).cast("long"), lambda s, t: s + t)
    return out.select(F.col("key.conv_id").alias("conv_id"), "window", F.col("new")[0]["ord"].alias("first"), F.size("new").alias("n_new"), F.size("repeated").alias("n_repeated"), F.concat("before", F.array_join(F.transform("new", lambda t: t["piece"]), "")).alias("text"), mask.alias("mask"), total.alias("tokens"), "key")


def _begins(rows: DataFrame, room: int) -> DataFrame:
    """key, found: by parts of ``PART`` turns, the turns that begin a window. Of a conversation only the numbers of tokens are
    held, and what a part finds isn't copied for the turns of the next."""
    counts = F.struct("ord", "tok", (F.col("role") == "system").alias("system"))
    parts = rows.groupBy("key", F.floor(F.col("ord") / PART).alias("part")).agg(F.array_sort(F.collect_list(counts)).alias("turns"))
    convs = parts.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("part", "turns"))).alias("parts"), F.max(F.when(F.col("part") == 0, F.col("turns")[0])).alias("head"))
    convs = convs.withColumn("room", F.greatest(F.lit(1), F.lit(room) - F.when(F.col("head.system"), F.col("head.tok")).otherwise(0)))

    def step(s: Column, t: Column) -> Column:
        more = (s["used"] > 0) & (s["used"] + t["tok"] > F.col("room"))
        found = F.when(more, F.concat(s["found"], F.array(t["ord"]))).otherwise(s["found"])
        used = F.when(more, t["tok"]).when((t["ord"] == 0) & t["system"], F.lit(0).cast("long")).otherwise(s["used"] + t["tok"])
        return F.struct(used.alias("used"), found.alias("found"))

    def part(s: Column, p: Column) -> Column:
        begin = F.struct(F.element_at(s, -1)["used"].alias("used"), F.expr("cast(array() as array<int>)").alias("found"))
        return F.concat(s, F.array(F.aggregate(p["turns"], begin, step)))

    start = F.array(F.struct(F.lit(0).cast("long").alias("used"), F.expr("array(0)").alias("found")))
    found = F.aggregate("parts", start, part)["found"]  # the first turn's window stands before all parts
    first = F.concat(F.array(F.concat(found[0], found[1])), F.slice(found, 3, F.size(found)))
    return convs.select("key", first.alias("found"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role and text of the new turns) and learned (texts under the mask), from text and mask alone."""
    parts = F.split("text", F.lit(END), -1)
    new = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))

    def turn(p: Column) -> Column:
        head = F.substring_index(p, ": ", 1)
        return F.struct(unescaped(F.substr(head, F.lit(5))).alias("role"), unescaped(F.substr(p, F.length(head) + 3)).alias("text"))

    learned = F.transform("mask", lambda m: unescaped(F.substr(F.col("text"), (m["start"] + 1).cast("int"), m["length"])))
    return formatted.select("conv_id", "window", F.transform(new, turn).alias("turns"), learned.alias("learned"), F.length("text").alias("chars"), *[c for c in formatted.columns if c == "key"])


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").union(own)
    back = read_back(windows(rows))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = F.struct("window", F.size("turns").cast("long").alias("n"), turns.alias("turns"), F.array_join("learned", "").alias("loss"), "chars")
    convs = back.groupBy("key").agg(F.array_sort(F.collect_list(each)).alias("w"))
    loss = F.array_join(F.col("w.loss"), "")
    total = lambda k: F.aggregate(F.col(f"w.{k}"), F.lit(0).cast("long"), lambda s, x: s + x)
    return convs.select("key.conv_id", total("n").alias("n_turns"), F.sha2(F.array_join(F.col("w.turns"), ""), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), total("chars").alias("formatted_chars"))


OP2_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS ord,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tok,
    14 + length(replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c'))
       + length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t')) AS chars
  FROM t),
p AS (
  SELECT *, sum(tok) OVER (PARTITION BY conv_id ORDER BY ord) - tok AS start,
    first_value(role) OVER (PARTITION BY conv_id ORDER BY ord) = 'system' AS headed,
    greatest(1, 192 - CASE WHEN first_value(role) OVER (PARTITION BY conv_id ORDER BY ord) = 'system'
      THEN first_value(tok) OVER (PARTITION BY conv_id ORDER BY ord) ELSE 0 END) AS room
  FROM o),
g AS (
  SELECT conv_id, ord, true AS begins, CAST(CASE WHEN headed THEN 0 ELSE tok END AS BIGINT) AS used FROM p WHERE ord = 0
  UNION ALL
  SELECT p.conv_id, p.ord, g.used > 0 AND g.used + p.tok > p.room,
    CAST(CASE WHEN g.used > 0 AND g.used + p.tok > p.room THEN p.tok ELSE g.used + p.tok END AS BIGINT)
  FROM g JOIN p ON p.conv_id = g.conv_id AND p.ord = g.ord + 1),
again AS (
  SELECT b.conv_id, sum(h.chars) AS chars
  FROM g JOIN p b ON b.conv_id = g.conv_id AND b.ord = g.ord
  JOIN p h ON h.conv_id = b.conv_id AND h.ord < b.ord
    AND CASE WHEN h.ord = 0 AND h.headed THEN true ELSE h.ord >= b.ord - 4 AND h.start >= b.start - 64 END
  WHERE g.begins AND g.ord > 0 GROUP BY 1)
SELECT p.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY ord), '')) AS loss_sha256,
  CAST(sum(p.chars) + coalesce(any_value(again.chars), 0) AS BIGINT) AS formatted_chars
FROM p LEFT JOIN again ON again.conv_id = p.conv_id GROUP BY 1
"""
