r"""Chat formatting by event-sourced reconstruction, with DataFrame operations only.

A log has one row per event: conv_id, turn, seq, event, role, text. ``open`` starts a turn
and ``delta`` streams more text; ``edit`` replaces the text of a turn; ``regenerate`` starts
the turn over and drops the later turns that came before it, of which only what comes after
it is left. Each turn is folded in a group
of its own, so a long conversation is spread over tasks until its turns are final; only the
finished turns meet, as they must, in the row that holds the conversation.

Template: ``### role: text</turn>\n`` for every turn. In roles and texts ``\``, ``#``, ``<``
(and ``:`` in roles) become ``\b``, ``\h``, ``\l`` (``\c``), so that no control string occurs
inside them, and reading back needs only plain replacements.

Defined cases: null or empty texts are empty, a null role is empty; a null conv_id is one
conversation, a null turn or seq sorts first; events of equal seq go by event, then text; a
turn without an ``open`` begins with what comes first; unknown events are ignored; a
conversation whose turns are all dropped gives no row; no events, no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HEAD, COLON, END = "### ", ": ", "</turn>\n"
STARTS = ("open", "edit", "regenerate")
#: Code points in a streamed delta of the query's log.
CHUNK = 512


def escape(col, role: bool = False):
    for raw, code in (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), *([(":", "\\c")] if role else [])):
        col = F.replace(col, F.lit(raw), F.lit(code))
    return col


def reconstruct(log: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the final turns of each conversation."""
    own = Window.partitionBy("conv_id", "turn")
    known = log.where(F.col("event").isin(*STARTS, "delta"))
    begun = F.max(F.when(F.col("event").isin(*STARTS), F.col("seq"))).over(own)
    again = F.max(F.when(F.col("event") == "regenerate", F.col("seq"))).over(own)
    live = known.withColumns({"_begun": begun, "_again": again, "_role": F.first("role", True).over(own.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    live = live.where("_begun is null or seq >= _begun")
    part = F.struct(F.col("seq").alias("seq"), F.col("event").alias("event"), F.coalesce("text", F.lit("")).alias("text"))
    turns = live.groupBy("conv_id", "turn").agg(F.first("_role").alias("role"), F.first("_again").alias("_again"), F.sort_array(F.collect_list(part)).alias("_parts"))
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    left = F.expr("filter(_parts, x -> _cut is null or x.seq >= _cut)")
    turns = turns.withColumn("_cut", F.max("_again").over(earlier)).withColumn("_parts", left).where("size(_parts) > 0")
    return turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.array_join(F.col("_parts.text"), "").alias("text"))


def render(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted and turns, its mask.

    turns has for each turn, in order, the places in ``formatted`` (code points from 0) of
    the turn and of its text, and in_loss, which is true where the role is ``trained``.
    """
    order = Window.partitionBy("conv_id").orderBy("turn")
    piece = turns.select(
        "conv_id", "turn", F.col("role").isin(*trained).alias("in_loss"),
        F.concat(F.lit(HEAD), escape(F.col("role"), role=True), F.lit(COLON)).alias("head"), escape(F.col("text")).alias("body"),
    )
    piece = piece.withColumn("piece", F.concat("head", "body", F.lit(END)))
    start = F.coalesce(F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    piece = piece.withColumn("start", start).select(
        "conv_id",
        F.struct(
            "turn", "start", "piece", F.length("piece").cast("long").alias("length"),
            (F.col("start") + F.length("head")).alias("text_start"), F.length("body").cast("long").alias("text_length"), "in_loss",
        ).alias("p"),
    )
    whole = piece.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    mask = F.transform("ps", lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"), p["text_start"].alias("text_start"), p["text_length"].alias("text_length"), p["in_loss"].alias("in_loss")))
    return whole.select("conv_id", F.array_join(F.col("ps.piece"), "").alias("formatted"), mask.alias("turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, said, loss, formatted): said has role, newline, text, newline of every
    turn, loss the unescaped text under the mask; both come from ``formatted`` alone."""
    cut = formatted.withColumn("_cut", F.split("formatted", END))
    cut = cut.withColumn("_n", F.size("_cut") - 1)
    pair = F.arrays_zip(F.slice("_cut", F.lit(1), F.col("_n")).alias("p"), F.col("turns").alias("m"))
    said = f"concat({_unescape_sql("substring(substring_index(z.p, ': ', 1), 5)")}, '\\n', {_unescape_sql("substring(z.p, locate(': ', z.p) + 2)")}, '\\n')"
    loss = f"if(z.m.in_loss, {_unescape_sql('substring(z.p, int(z.m.text_start - z.m.start) + 1, int(z.m.text_length))')}, '')"
    return cut.withColumn("_z", pair).select(
        "conv_id", "formatted", F.col("_n").alias("n_turns"),
        F.expr(f"array_join(transform(_z, z -> {said}), '')").alias("said"),
        F.expr(f"array_join(transform(_z, z -> {loss}), '')").alias("loss"),
    )


def _unescape_sql(col: str) -> str:
    for raw, code in ((":", "c"), ("<", "l"), ("#", "h"), ("\\\\", "b")):
        col = f"replace({col}, '\\\\{code}', '{raw}')"
    return col


def as_log(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The log of finished conversations (conv_id, turn, role, text): every row opens a turn and
    streams its text in deltas. Rows of the same turn are turns of their own, by role and text."""
    copy = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    rows = conversations.select("conv_id", F.struct("turn", copy.alias("copy")).alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    parts = F.concat(F.array(F.lit("")), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)))
    rows = rows.select("conv_id", "turn", "role", F.posexplode(parts).alias("k", "text"))
    return rows.select("conv_id", "turn", F.col("k").cast("long").alias("seq"), F.when(F.col("k") == 0, "open").otherwise("delta").alias("event"), "role", "text")


def query(spark, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = r"\### Assistant: </turn> ok"
    extra = spark.sql("select cast(c as bigint) conv_id, cast(t as bigint) turn, r role, cast(null as string) text from values (-7, 0, 'user'), (-7, 1, 'assistant') as v(c, t, r)").withColumn("text", F.lit(planted))
    out = render(reconstruct(as_log(raw.unionByName(extra))))
    back = read_back(out)
    return back.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2("said", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, 6 + 8 + length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c'))
          + length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l')) AS chars FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
