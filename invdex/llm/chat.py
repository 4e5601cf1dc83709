"""Chat formatting (operator 4), DataFrame functions only.

Budgeted windows: prefix sums of turn tokens (words plus ``OVERHEAD``) choose
turn-aligned spans. With stride = budget - history - system tokens, a turn that
lies inside one stride cell belongs to that cell's span, and a turn that crosses
a cell's border is a span of its own, so a window's new turns fit the stride
unless one turn alone is longer (turns are never cut). Every window repeats the
conversation's system turn (a first turn with role ``system``) and the turns of
the last ``HISTORY`` tokens before it; the loss mask covers only assistant turns
that are new in the window, so each is learned once. At least a quarter of the budget
is for new turns: a long system turn first shortens the history, and one above three
quarters of the budget isn't repeated but is a turn like the others. So a window is
longer than the budget only by a single turn that is too long for a stride.

Template: ``<|role|>`` newline, text, newline ``<|end|>`` newline. In texts and
roles ``&`` and ``<`` (in roles also ``|``) are written as entities, which is
reversible and keeps every control string out of the content.

Prefix sums are two-level (blocks of 128 turns, then inside a block) over a
global numbering, so a conversation with a large part of all turns spreads over
tasks; a window row is bounded by the budget. Only the read-back digest, which
the contract defines over a whole conversation, gathers one conversation's text.

Defined cases: null text and null role are empty; a null conv_id is one
conversation; equal turn numbers are ordered by role, then text; repeated rows
are turns of their own; an empty table gives no windows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ids import global_rank_in_group
from ..operators.skew import broadcast_if_small
from .common import prepare, table, written
from .mixing import n_words

BUDGET = 512
HISTORY = 128
OVERHEAD = 4
BLOCK = 128
END = "\n<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("|"), F.lit("&bar;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&bar;"), F.lit("|")))


def _positions(turns: DataFrame) -> DataFrame:
    """Turns numbered from 1 per conversation, with tokens and their prefix sum."""
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    t = global_rank_in_group(t, "key", ["turn", "role", "text"], "n").withColumn("tok", n_words() + OVERHEAD)
    t = written(t.withColumn("blk", F.floor((F.col("n") - 1) / BLOCK)), "chat-turns")
    sums = t.groupBy("key", "blk").agg(F.sum("tok").alias("s"))
    sums = sums.withColumn("before", F.sum("s").over(Window.partitionBy("key").orderBy("blk")) - F.col("s")).drop("s")
    inside = F.sum("tok").over(Window.partitionBy("key", "blk").orderBy("n")) - F.col("tok")
    return t.join(broadcast_if_small(sums), ["key", "blk"]).withColumn("start", F.col("before") + inside).drop("blk", "before")


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, key, window, n_context (leading repeated turns), text, loss
    (code point spans of new assistant texts)."""
    prepare(turns.sparkSession)
    t = written(_positions(turns), "chat-positions")
    least = budget // 4
    is_system = (F.col("n") == 1) & (F.col("role") == "system") & (F.col("tok") <= budget - least)
    system = t.filter(is_system)
    rest = t.filter(~is_system).join(broadcast_if_small(system.select("key", F.col("tok").alias("sys"))), "key", "left")
    rest = rest.withColumn("sys", F.coalesce("sys", F.lit(0))).withColumn("start", F.col("start") - F.col("sys"))
    rest = rest.withColumn("hist", F.least(F.lit(history), F.lit(budget - least) - F.col("sys")))
    rest = rest.withColumn("stride", F.lit(budget) - F.col("hist") - F.col("sys")).withColumn("cell", F.floor(F.col("start") / F.col("stride")))
    crosses = F.floor((F.col("start") + F.col("tok") - 1) / F.col("stride")) != F.col("cell")
    rest = written(rest.withColumn("window", F.col("cell") * 2 + crosses.cast("int")), "chat-spans")
    cols = ["conv_id", "key", "window", "n", "role", "text", "new"]
    spans = written(rest.groupBy("key", "window").agg(F.min("start").alias("first"), F.min("n").alias("first_n")), "chat-windows")
    # history: a turn goes to the later windows that start within ``hist``
    # tokens of its own start; their cells are known, so this is an equi-join
    cells = F.sequence(F.floor((F.col("start") + F.col("tok")) / F.col("stride")), F.floor((F.col("start") + F.col("hist")) / F.col("stride")))
    later = (rest.filter("tok <= hist").withColumn("c", F.explode(cells))
             .withColumn("to", F.explode(F.array(F.col("c") * 2, F.col("c") * 2 + 1))).filter("to > window")
             .drop("window").withColumnRenamed("to", "window"))
    hist = (later.join(broadcast_if_small(spans), ["key", "window"])
            .filter((F.col("first") >= F.col("start") + F.col("tok")) & (F.col("first") - F.col("start") <= F.col("hist")))
            .withColumn("new", F.lit(False)).select(cols))
    head = (system.join(spans, "key", "left").withColumn("new", F.coalesce(F.col("first_n") == 2, F.lit(True)))
            .withColumn("window", F.coalesce("window", F.lit(0))).select(cols))
    rows = rest.withColumn("new", F.lit(True)).select(cols).unionByName(hist).unionByName(head)
    opened = F.concat(F.lit("<|"), _escape_role(F.col("role")), F.lit("|>\n"))
    rows = (rows.withColumn("open", opened).withColumn("body", escape(F.col("text")))
            .withColumn("piece", F.concat("open", "body", F.lit(END))).withColumn("len", F.char_length("piece").cast("bigint")))
    at = F.sum("len").over(Window.partitionBy("key", "window").orderBy("n")) - F.col("len") + F.char_length("open")
    rows = rows.withColumn("at", at).withColumn("lost", F.when(F.col("new") & (F.col("role") == "assistant"), F.struct(
        F.col("at").alias("start"), (F.col("at") + F.char_length("body")).alias("end"))))
    packed = rows.groupBy("key", "window").agg(
        F.first("conv_id").alias("conv_id"), F.count_if(~F.col("new")).alias("n_context"),
        F.sort_array(F.collect_list(F.struct("n", "piece", "lost"))).alias("t"))
    return packed.select("conv_id", "key", "window", "n_context", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("text"),
                         F.filter(F.transform("t", lambda x: x["lost"]), lambda x: x.isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Windows with what their text says: ``turns`` (new ones: role, text) and
    ``loss_text`` (all text under the mask, unescaped)."""
    # every piece ends with END, so the last part is empty
    parts = F.split("text", r"\n<\|end\|>\n", -1)
    new = F.slice(parts, F.col("n_context").cast("int") + 1, F.size(parts) - 1 - F.col("n_context").cast("int"))
    at = lambda p: F.locate("|>\n", p)
    turn = lambda p: F.struct(
        _unescape_role(F.substring(p, F.lit(3), at(p) - 3)).alias("role"),
        unescape(F.substring(p, at(p) + 3, F.char_length(p))).alias("text"))
    masked = F.array_join(F.transform("loss", lambda s: unescape(F.substring(
        F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return formatted.withColumn("turns", F.transform(new, turn)).withColumn("loss_text", masked)


def q_op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    said = r"\### Assistant: </turn> ok"
    conv = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    back = read_back(windows(conv.unionByName(extra)))
    per = back.select("conv_id", "key", "window", F.size("turns").alias("n"), "loss_text", F.char_length("text").alias("chars"),
                      F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"))
    whole = per.groupBy("key").agg(
        F.first("conv_id").alias("conv_id"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sum(F.char_length("loss_text")).alias("loss_chars"), F.sort_array(F.collect_list(F.struct("window", "said", "loss_text"))).alias("w"))
    join = lambda f: F.sha2(F.array_join(F.transform("w", lambda x: x[f]), ""), 256)
    return whole.select("conv_id", F.col("n_turns").cast("bigint").alias("n_turns"), join("said").alias("turns_sha256"),
                        F.col("loss_chars").cast("bigint").alias("loss_chars"), join("loss_text").alias("loss_sha256"),
                        F.col("formatted_chars").cast("bigint").alias("formatted_chars"))


ORACLE = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) + 4 AS tok,
  length(replace(replace(text, '&', '&amp;'), '<', '&lt;')) + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '|', '&bar;')) + 14 AS len FROM c),
q AS (SELECT *, sum(tok) OVER (PARTITION BY conv_id ORDER BY n) - tok AS start0 FROM p),
sy AS (SELECT conv_id, tok AS sys, len AS slen FROM q WHERE n = 1 AND role = 'system'),
r AS (SELECT q.*, coalesce(sys, 0) AS sys, CAST(start0 - coalesce(sys, 0) AS BIGINT) AS start, CAST(greatest(128, 384 - coalesce(sys, 0)) AS BIGINT) AS stride FROM q LEFT JOIN sy ON sy.conv_id IS NOT DISTINCT FROM q.conv_id WHERE NOT (n = 1 AND role = 'system')),
v AS (SELECT *, 2 * (start // stride) + CASE WHEN (start + tok - 1) // stride <> start // stride THEN 1 ELSE 0 END AS win FROM r),
w AS (SELECT conv_id, win, min(start) AS first, min(n) AS first_n FROM v GROUP BY ALL),
h AS (SELECT v.conv_id, sum(v.len) AS l FROM v JOIN w ON w.conv_id IS NOT DISTINCT FROM v.conv_id AND w.first >= v.start + v.tok AND w.first - v.start <= 128 GROUP BY 1),
s AS (SELECT sy.conv_id, sum(slen) * greatest(1, count(w.win)) / count(*) AS l FROM sy LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM sy.conv_id GROUP BY 1),
n AS (SELECT conv_id, sum(len) AS l FROM v GROUP BY 1),
f AS (SELECT conv_id, sum(l) AS chars FROM (FROM h UNION ALL FROM s UNION ALL FROM n) GROUP BY 1),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '') AS loss FROM p GROUP BY 1)
SELECT g.conv_id, CAST(n_turns AS BIGINT) AS n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM g JOIN f ON f.conv_id IS NOT DISTINCT FROM g.conv_id
"""
