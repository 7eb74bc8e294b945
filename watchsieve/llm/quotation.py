"""Quotation linking: replies are ordered by what they quote, and the quotes are taken out. DataFrame functions only.

A line's quote level is the number of > before it. Lines of one level in a row are a passage. Passages and their single
lines, with white space and A-Z made alike, are hashed; what a message says itself (level 0) is indexed by the first
message of the conversation that says it, one row for each hash, so a line that a third of all messages share joins to one
row. Quotes of every level are joined to the message that said them; links() returns them. A message replies to the earlier
message from which its quotes take most characters (the earliest of equals), by the shallowest level that finds one. Threads come from following replies back, in steps that double. In reply order, each message comes after the one it
replies to and before any later reply to another: a conversation's rows by reply_path, which has the turns on the way from the thread's first message.

Defined results: null text counts as empty, and stays with empty text; a quote of nothing known, or of a later message,
links nothing; without a link a message is its own thread of depth 0; lines such as "On ... wrote:" right before a quote
and the quoted lines are not in clean_text; rows that repeat a conversation and turn are each kept, and the first of them by
text answers for both; a null conversation or turn links nothing; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

MARK = r"^ ?((?:> ?)+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARK, 1), " ", ""))


def _alike(text: Column) -> Column:
    return F.translate(F.trim(F.regexp_replace(text, r"[ \t\r\f\x0b]+", " ")), _UPPER, _LOWER)


def _step(turn: Column | str) -> Column:
    """A turn in a path: /, and 19 digits, so that paths are in order as strings."""
    return F.concat(F.lit("/"), F.lpad(F.col(turn).cast("string") if isinstance(turn, str) else turn.cast("string"), 19, "0"))


def messages(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, and clean_text without quotes and the lines that announce them."""
    rows = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    lines = F.split("text", "\n", -1)
    quoted = F.expr(r"exists(lines, x -> x rlike '^ ?>')")
    own = F.filter("lines", lambda x, i: ~x.rlike("^ ?>") & ~(x.rlike("^On .* wrote:$") & F.coalesce(F.get("lines", i + 1).rlike("^ ?>"), F.lit(False))))
    return rows.withColumn("lines", lines).withColumn("clean_text", F.when(quoted, F.trim(F.regexp_replace(F.array_join(own, "\n"), "\n{3,}", "\n\n"))).otherwise(F.col("text")))


def units(rows: DataFrame) -> DataFrame:
    """The passages and lines of each message: conv_id, turn, level, alike, and its hash."""
    each = rows.select("conv_id", "turn", F.xxhash64("text").alias("copy"), F.posexplode("lines").alias("at", "line")).withColumn("level", _level(F.col("line"))).withColumn("alike", _alike(F.regexp_replace("line", MARK, ""))).filter("alike <> ''").select("conv_id", "turn", "copy", "at", "level", "alike")
    message = Window.partitionBy("conv_id", "turn", "copy").orderBy("at")
    runs = each.withColumn("run", F.row_number().over(message) - F.row_number().over(Window.partitionBy("conv_id", "turn", "copy", "level").orderBy("at")))
    passages = runs.groupBy("conv_id", "turn", "copy", "level", "run").agg(F.sort_array(F.collect_list(F.struct("at", "alike"))).alias("all")).filter("size(all) > 1")
    joined = passages.select("conv_id", "turn", "level", F.array_join(F.col("all.alike"), " ").alias("alike"))
    return each.select("conv_id", "turn", "level", "alike").union(joined).withColumn("hash", F.xxhash64("alike"))


def _found(rows: DataFrame) -> DataFrame:
    """rows: of messages(). conv_id, turn, level, alike and source of each quoted line and passage that an earlier message said itself."""
    quoting = rows.filter("exists(lines, x -> x rlike '^ ?>') AND conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", "text", "lines")
    quotes = stored(units(quoting).filter("level > 0").select("conv_id", "turn", "level", "hash", "alike").distinct(), "quotes")
    # only conversations that quote need an index of what they say
    sources = rows.join(quotes.select("conv_id").distinct(), "conv_id", "left_semi").select("conv_id", "turn", "text", "lines")
    said = units(sources).filter("level = 0").groupBy("conv_id", "hash", "alike").agg(F.min("turn").alias("source"))
    return quotes.join(said, ["conv_id", "hash", "alike"]).filter("source < turn").select("conv_id", "turn", "level", "alike", "source")


def links(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, level, source (the first turn that said it) and alike (the words) of each quoted line and passage, by level."""
    return _found(messages(df, conv_col, turn_col, role_col, text_col))


def linked(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, reply_to, thread (the turn it goes back to), depth, reply_path, max_level and clean_text of each row; a conversation in reply order is its rows by reply_path."""
    rows = messages(df, conv_col, turn_col, role_col, text_col)
    marked = rows.withColumn("max_level", F.expr("aggregate(lines, 0, (a, x) -> greatest(a, length(replace(regexp_extract(x, '" + MARK + "', 1), ' ', ''))))"))
    by_level = _found(rows).groupBy("conv_id", "turn", "level", "source").agg(F.sum(F.length("alike")).alias("weight"))
    best = by_level.groupBy("conv_id", "turn").agg(F.min(F.struct("level", (-F.col("weight")).alias("w"), "source")).alias("b"))
    replies = stored(best.select("conv_id", "turn", F.col("b.source").alias("reply_to")), "replies")
    ways = replies.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).alias("depth"), _step("turn").alias("path"))
    open_ = replies.count()
    while open_:  # each step doubles how far back a way leads
        on = ways.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("further"), F.col("depth").alias("more"), F.col("path").alias("before"))
        both = stored(ways.join(on, ["conv_id", "thread"], "left").select("conv_id", "turn", F.coalesce("further", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.concat(F.coalesce("before", F.lit("")), "path").alias("path"), F.col("further").isNotNull().alias("moved")), "ways")
        open_, ways = both.filter("moved").count(), both.drop("moved")
    known = replies.join(ways, ["conv_id", "turn"])
    return marked.join(stored(known, "known"), ["conv_id", "turn"], "left").select("conv_id", "turn", "role", "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"), F.concat(_step(F.coalesce("thread", "turn")), F.coalesce("path", F.lit(""))).alias("reply_path"), "max_level", "clean_text")


def op6_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP6_SQL = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines,
         regexp_matches(coalesce(text, ''), '(^|\n) ?>') AS quotes FROM conversations),
l AS (SELECT conv_id, turn, unnest(lines) AS line, generate_subscripts(lines, 1) AS nth, lines FROM m),
v AS (
  SELECT conv_id, turn, nth, length(replace(regexp_extract(line, '^ ?((?:> ?)+)', 1), ' ', '')) AS level,
         translate(trim(regexp_replace(regexp_replace(line, '^ ?((?:> ?)+)', ''), '[ \t\r\f\x0b]+', ' ', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS alike,
         NOT regexp_matches(line, '^ ?>') AND NOT (regexp_matches(line, '^On .* wrote:$') AND coalesce(regexp_matches(lines[nth + 1], '^ ?>'), false)) AS own, line FROM l),
e AS (SELECT * FROM v WHERE alike <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY nth) - row_number() OVER (PARTITION BY conv_id, turn, level ORDER BY nth) AS run FROM e),
u AS (
  SELECT conv_id, turn, level, alike FROM e
  UNION ALL SELECT conv_id, turn, level, string_agg(alike, ' ' ORDER BY nth) FROM r GROUP BY conv_id, turn, level, run HAVING count(*) > 1),
q AS (SELECT DISTINCT conv_id, turn, level, alike FROM u WHERE level > 0),
s AS (SELECT conv_id, alike, min(turn) AS source FROM u WHERE level = 0 GROUP BY ALL),
w AS (SELECT conv_id, turn, level, source, sum(length(alike)) AS weight FROM q JOIN s USING (conv_id, alike) WHERE source < turn GROUP BY ALL),
p AS (SELECT conv_id, turn, arg_min(source, {'l': level, 'w': -weight, 's': source}) AS reply_to FROM w GROUP BY ALL),
t AS (
  SELECT conv_id, turn, reply_to AS thread, 1 AS depth, '/' || lpad(turn::VARCHAR, 19, '0') AS path FROM p
  UNION ALL SELECT t.conv_id, t.turn, p.reply_to, t.depth + 1, '/' || lpad(p.turn::VARCHAR, 19, '0') || t.path FROM t JOIN p ON p.conv_id = t.conv_id AND p.turn = t.thread),
d AS (SELECT conv_id, turn, min(thread) AS thread, max(depth) AS depth, arg_max(path, depth) AS path FROM t GROUP BY ALL),
c AS (SELECT conv_id, turn, max(level) AS max_level, coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (own), '') AS kept FROM v GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, p.reply_to, coalesce(d.thread, m.turn) AS thread, coalesce(d.depth, 0)::INT AS depth, '/' || lpad(coalesce(d.thread, m.turn)::VARCHAR, 19, '0') || coalesce(d.path, '') AS reply_path, c.max_level::INT AS max_level,
       CASE WHEN m.quotes THEN trim(regexp_replace(c.kept, '\n{3,}', chr(10) || chr(10), 'g')) ELSE m.text END AS clean_text
FROM m JOIN c ON c.conv_id IS NOT DISTINCT FROM m.conv_id AND c.turn IS NOT DISTINCT FROM m.turn
LEFT JOIN p ON p.conv_id = m.conv_id AND p.turn = m.turn LEFT JOIN d ON d.conv_id = m.conv_id AND d.turn = m.turn
"""


def quoting(df: DataFrame) -> DataFrame:
    """The turns of conversations as mail that quotes what came before: every turn but each fourth quotes the one before it, and where that quotes another, this too, a level deeper."""
    rows = df.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    back = lambda k: rows.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("role").alias(f"role{k}"), F.col("text").alias(f"text{k}"))
    deeper = lambda mark, text: F.concat(F.lit(mark), F.replace(F.col(text), F.lit("\n"), F.lit("\n" + mark)), F.lit("\n"))
    first = F.when((F.col("turn") % 4 != 0) & F.col("text1").isNotNull(), F.concat(F.lit("On day "), F.col("turn").cast("string"), F.lit(", "), F.coalesce("role1", F.lit("")), F.lit(" wrote:\n"), deeper("> ", "text1")))
    second = F.when((F.col("turn") % 4 != 0) & ((F.col("turn") - 1) % 4 != 0) & F.col("text1").isNotNull() & F.col("text2").isNotNull(), deeper(">> ", "text2"))
    both = rows.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left")
    return both.select("conv_id", "turn", "role", F.concat(F.coalesce(first, F.lit("")), F.coalesce(second, F.lit("")), "text").alias("text"))


def quoted_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator where there are quotes to link, in two levels."""
    return linked(quoting(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUOTED_SQL = OP6_SQL.replace("WITH RECURSIVE m AS (", r"""WITH RECURSIVE plain AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
mail AS (
  SELECT a.conv_id, a.turn, a.role, CASE WHEN a.turn % 4 <> 0 AND b.text IS NOT NULL THEN 'On day ' || a.turn || ', ' || coalesce(b.role, '') || ' wrote:' || chr(10) || '> ' || replace(b.text, chr(10), chr(10) || '> ') || chr(10) ELSE '' END
    || CASE WHEN a.turn % 4 <> 0 AND (a.turn - 1) % 4 <> 0 AND b.text IS NOT NULL AND c.text IS NOT NULL THEN '>> ' || replace(c.text, chr(10), chr(10) || '>> ') || chr(10) ELSE '' END || a.text AS text
  FROM plain a LEFT JOIN plain b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1 LEFT JOIN plain c ON c.conv_id = a.conv_id AND c.turn = a.turn - 2),
m AS (""").replace("AS quotes FROM conversations)", "AS quotes FROM mail)")
