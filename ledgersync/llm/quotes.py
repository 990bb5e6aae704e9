"""Chats from messages that quote each other: quotation linking and reply order.

A line's quote level is the number of ``>`` before its text. Lines of one level that stand together form passages,
parted by blank lines. Passages and single lines are normalised (white space, case) and hashed. A quoted hash is joined
to the first message of the conversation that has it in its own words and comes before the quoting one. A message
answers the message that most of its level-1 quotation comes from (by characters, then the later one), and messages
that answer, directly or through others, the same unquoting message form a thread. Conversations are put out in reply
order - threads by their first message, messages of a thread by turn - each message in its own words, without quotes
and the line that announces them ("... wrote:").

Only DataFrame functions are used. Scale: only messages with quotes, and conversations that have them, are cut into
lines; a hash of a conversation is reduced to its first message before the join, so no pairs of equal texts arise.
Threads are found by pointer doubling. Ranks in a conversation come from a range partitioning of all messages with
offsets per partition, so one conversation with a third of all messages is spread over tasks.

Defined results: a null or blank text is an empty message and keeps its place; a null conversation is a conversation; a
null turn comes first and is never quoted; messages with the same turn are ordered by role, text and counts, repeated
rows side by side; a quote whose passage isn't found is dropped all the same, and counted; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgersync.llm.common import stage, table

BEGINNING = 64  # characters of a text that choose its range
MARKS = r"^((?:[ \t]*>)+)"
ANNOUNCES = r"(?i)^.{0,200}\b(wrote|writes|said|schrieb|escribió|a écrit)\s*:$"
_MESSAGE = ["conv_id", "turn", "id"]


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, id, pos, level, line) of messages' lines; announcing lines are left out."""
    once = messages.dropDuplicates(_MESSAGE)  # rows that repeat a message are put back by their key
    cut = once.select(*_MESSAGE, F.posexplode(F.split("text", r"\r?\n")).alias("pos", "raw"))
    marks = F.regexp_extract("raw", MARKS, 1)
    read = cut.select(*_MESSAGE, "pos", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.trim(F.regexp_replace("raw", MARKS, "")).alias("line"))
    after = F.lead("level").over(W.partitionBy(*_MESSAGE).orderBy("pos"))
    announces = (F.col("level") == 0) & (F.coalesce(F.col("after"), F.lit(0)) > 0) & F.col("line").rlike(ANNOUNCES)
    return read.withColumn("after", after).where(~announces).drop("after")


def _hashes(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, id, level, hash, chars): passages and single lines, once each."""
    here = W.partitionBy(*_MESSAGE).orderBy("pos")
    blank = F.length("line") == 0
    breaks = F.when(blank | (F.lag("level").over(here) != F.col("level")), 1).otherwise(0)
    runs = lines.withColumn("break", breaks).withColumn("run", F.sum("break").over(here)).where("length(line) > 0")
    passages = runs.groupBy(*_MESSAGE, "level", "run").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("parts"))
    whole = passages.select(*_MESSAGE, "level", F.array_join("parts.line", " ").alias("words"))
    normal = whole.union(runs.select(*_MESSAGE, "level", F.col("line").alias("words"))).withColumn("words", _normal(F.col("words")))
    return normal.select(*_MESSAGE, "level", F.md5(F.col("words").cast("binary")).alias("hash"), F.length("words").alias("chars")).distinct()


def quotations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, id, level, source_turn, chars): what each message quotes from which earlier message.

    ``messages`` has (conv_id, turn, id, text); ``source_turn`` is null where no earlier message has the passage.
    """
    quoting = messages.where(F.col("text").rlike("(?m)" + MARKS))
    talks = quoting.select("conv_id").distinct().withColumnRenamed("conv_id", "c")
    concerned = messages.join(talks, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    own = _hashes(_lines(concerned)).where("level = 0")
    first = own.groupBy(F.col("conv_id").alias("c"), F.col("hash").alias("h")).agg(F.min("turn").alias("source_turn"))
    quoted = _hashes(_lines(quoting)).where("level > 0")
    earlier = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("hash") == F.col("h")) & (F.col("source_turn") < F.col("turn"))
    return quoted.join(first, earlier, "left").select(*_MESSAGE, "level", "source_turn", "chars")


def _threads(answers: DataFrame) -> DataFrame:
    """(conv_id, turn, root) for the answering turns of (conv_id, turn, parent): the end of the chain of parents."""
    known = stage(answers.select("conv_id", "turn", F.col("parent").alias("root")), "threads")
    while True:
        up = known.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("root").alias("next"))
        same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("root") == F.col("t"))
        joined = known.join(up, same, "left")
        known = stage(joined.select("conv_id", "turn", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "threads")
        if known.where("moved").isEmpty():
            return known.drop("moved")
        known = known.drop("moved")


def reply_ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, turn, role, text, parent_turn, n_quotes, n_linked, chat) for every message.

    ``text`` is the message in its own words, ``chat`` the same as a tagged line of the conversation; ``n_quotes``
    counts quoted passages and lines, ``n_linked`` those found in an earlier message.
    """
    read = conversations.select("conv_id", "turn", "role", "text")
    messages = read.withColumn("id", F.xxhash64("role", "text"))
    plain = messages.where(~F.coalesce(F.col("text").rlike("(?m)" + MARKS), F.lit(False)))
    quoting = messages.where(F.col("text").rlike("(?m)" + MARKS))
    found = stage(quotations(messages.drop("role")), "quotations")
    per_source = found.where("source_turn IS NOT NULL AND level = 1").groupBy(*_MESSAGE, "source_turn").agg(F.sum("chars").alias("chars"))
    parents = per_source.groupBy(*_MESSAGE).agg(F.max_by("source_turn", F.struct("chars", "source_turn")).alias("parent_turn"))
    counts = found.groupBy(*_MESSAGE).agg(F.count("*").alias("n_quotes"), F.count("source_turn").alias("n_linked"))
    # of messages with the same turn the chain goes on from the one that answers the earliest
    answers = parents.groupBy("conv_id", "turn").agg(F.min("parent_turn").alias("parent"))
    roots = _threads(answers).select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "root")
    own = _lines(quoting).where("level = 0").groupBy(*_MESSAGE).agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("parts"))
    own = own.select(*_MESSAGE, F.array_join("parts.line", "\n").alias("own"))

    def attach(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        renamed = right.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns])
        on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
        return left.join(renamed, on[0] & on[1] & on[2], "left").drop(*[f"_{c}" for c in keys])

    answered = attach(attach(attach(quoting, own, _MESSAGE), parents, _MESSAGE), counts, _MESSAGE)
    answered = answered.join(roots, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")) & F.col("parent_turn").isNotNull(), "left").drop("c", "t")
    tidy = F.trim(F.regexp_replace(F.coalesce("own", F.lit("")), r"\n{3,}", "\n\n"))
    columns = ["conv_id", "turn", "role", "id", "text", "parent_turn", "root", "n_quotes", "n_linked"]
    answered = answered.withColumn("text", F.regexp_replace(tidy, r"^\s+|\s+$", "")).select(*columns)
    zero, no_turn = F.lit(0).cast("long"), F.lit(None).cast(messages.schema["turn"].dataType)
    plain = plain.select("conv_id", "turn", "role", "id", F.coalesce("text", F.lit("")).alias("text"), no_turn.alias("parent_turn"), no_turn.alias("root"), zero.alias("n_quotes"), zero.alias("n_linked"))
    every = plain.unionByName(answered).withColumn("root", F.coalesce("root", "turn"))
    every = every.withColumns({c: F.coalesce(c, zero) for c in ("n_quotes", "n_linked")})
    order = ["root", "turn", "role", "text", "n_quotes", "n_linked", "id"]
    # Spark samples the range keys on the driver, so they hold beginnings only; rows are ordered whole inside the ranges
    label = F.coalesce(F.char_length("role") > BEGINNING, F.lit(False))
    ranges = ["conv_id", "root", "turn", F.left("role", F.lit(BEGINNING)), label, F.when(~label, F.left("text", F.lit(BEGINNING)))]
    laid = every.repartitionByRange(*ranges).withColumn("part", F.spark_partition_id())
    laid = stage(laid, "messages")
    before = laid.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = before.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base")
    )
    local = F.row_number().over(W.partitionBy("conv_id", "part").orderBy(*order)) - 1
    placed = laid.withColumn("local", local).join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    chat = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>"), F.col("text"))
    return placed.select(
        "conv_id", (F.col("base") + F.col("local")).cast("long").alias("position"), "turn", "role", "text", "parent_turn",
        F.col("n_quotes").cast("long"), F.col("n_linked").cast("long"), chat.alias("chat"),
    )


def op1_reply_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(table(spark, sf_dir, "conversations"))


QUERIES = {"op1_reply_chats": op1_reply_chats}
SQL: dict[str, str] = {}
