"""Chat formatting by quotation linking.

Each line of a message has a quote level, the number of ">" in front of it. What a
message says at a level is a passage, and so are each run of lines of that level, each
paragraph and sentence of it with its lines joined, and each line. So a quote that a mail
client has broken into other lines, or one of several quotes, has the passages of its
original. Passages are
normalised (case, punctuation, white space) and hashed; the first message of a
conversation with an own passage, at level 0, is its original. Quoted passages are
joined to originals by conversation and hash, and the normalised texts are compared,
so a hash never decides alone. A message answers the original of its outermost
linked quote, the latest one if there are several; a message without a linked quote
opens a thread. Threads and depths follow from answers by pointer jumping. The
reply order of a conversation is (thread, depth, turn): a message always comes
behind the one it answers.

Messages of a conversation are never gathered: originals are minima, links are
joined between written tables, so a conversation of any length is spread over tasks.

Defined results: null and empty texts have no passages and an empty text; a null
turn or conversation has no thread, answers nothing and is not answered; messages
that repeat (conv_id, turn) link like one message and get a row each; quotes of the
same or a later message are no links; blank lines, quotes, and lines of attribution
in messages with quotes are left out of the text; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.session import staged

QUOTE = r"^((?:[ \t]*>)+)"
BLANKS = r"\s+"
SENTENCE = r"([.!?])\s+"
NOT_WORD = r"[^\p{L}\p{N}]+"
ATTRIBUTION = r"(?i)^(on|le|am|el) .* (wrote|écrit|schrieb|escribió) ?:$"


def quoted_lines(text: Column) -> Column:
    """All lines as (level, line), quote marks taken off; blank ones, and attributions of quotes, are empty."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")

    def cut(line: Column) -> Column:
        marks = F.regexp_extract(line, QUOTE, 1)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).cast("long").alias("level"),
            F.trim(F.regexp_replace(F.regexp_replace(line, QUOTE, ""), BLANKS, " ")).alias("line"),
        )

    return F.transform(lines, cut)


def without_attributions(lines: Column) -> Column:
    """Lines that say whose quote follows made empty, in messages with quotes."""
    quoting = F.exists(lines, lambda x: (x["level"] > 0) & (x["line"] != ""))

    def kept(x: Column) -> Column:
        told = quoting & (x["level"] == 0) & x["line"].rlike(ATTRIBUTION)
        return F.struct(x["level"].alias("level"), F.when(told, "").otherwise(x["line"]).alias("line"))

    return F.transform(lines, kept)


def own_text(lines: Column) -> Column:
    """Lines without quotes."""
    return F.transform(F.filter(lines, lambda x: (x["level"] == 0) & (x["line"] != "")), lambda x: x["line"])


def runs(lines: Column, starts: Column) -> Column:
    """(level, passage) of the lines from each start to the next, joined; `starts` are places from 0."""

    def passage(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(starts, k + 1), F.size(lines))
        own = F.filter(F.slice(lines, start + 1, end - start), lambda x: x["line"] != "")
        return F.struct(F.get(lines, start)["level"].alias("level"), F.array_join(F.transform(own, lambda x: x["line"]), " ").alias("passage"))

    return F.transform(starts, passage)


def passages(lines: Column) -> Column:
    """(level, passage): runs of one level, paragraphs, sentences and lines of a message."""
    place = F.sequence(F.lit(0), F.size(lines) - 1)  # a text has one line at least
    at = lambda i: F.get(lines, i)
    before = lambda i: F.get(lines, i - 1)
    turns = lambda i: (i == 0) | (F.coalesce(before(i)["level"], F.lit(-1)) != at(i)["level"])
    blocks = runs(lines, F.filter(place, turns))
    begins = F.filter(place, lambda i: (at(i)["line"] != "") & (turns(i) | (F.coalesce(before(i)["line"], F.lit("")) == "")))
    paragraphs = runs(lines, begins)
    sentences = F.flatten(
        F.transform(
            paragraphs,
            lambda p: F.transform(
                F.split(F.regexp_replace(p["passage"], SENTENCE, "$1\n"), "\n"),
                lambda x: F.struct(p["level"].alias("level"), x.alias("passage")),
            ),
        )
    )
    single = F.transform(lines, lambda x: F.struct(x["level"].alias("level"), x["line"].alias("passage")))
    return F.filter(F.array_distinct(F.concat(blocks, paragraphs, sentences, single)), lambda x: x["passage"] != "")


def normal(passage: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(passage), NOT_WORD, " "))


def _hashed(frame: DataFrame) -> DataFrame:
    return frame.withColumn("normal", normal(F.col("passage"))).filter("normal <> ''").withColumn("hash", F.md5("normal"))


def quotations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, origin): each quoted passage with the turn of its original."""
    # with the runs, all that is said at a level
    levels = F.array_distinct(F.transform("lines", lambda x: x["level"]))

    def whole(level: Column) -> Column:
        each = F.filter("lines", lambda x: (x["level"] == level) & (x["line"] != ""))
        return F.struct(level.alias("level"), F.array_join(F.transform(each, lambda x: x["line"]), " ").alias("passage"))

    units = F.array_distinct(F.concat(F.transform(levels, whole), "passages"))
    known = messages.filter("conv_id is not null and turn is not null")
    quoting = known.filter(F.exists("lines", lambda x: (x["level"] > 0) & (x["line"] != "")))

    def said(part: DataFrame) -> DataFrame:
        return part.withColumn("passages", passages(F.col("lines"))).select("conv_id", "turn", F.inline(units))

    quoted = staged(_hashed(said(quoting).filter("level > 0")).drop("passage"), "quoted")
    # only where something is quoted are originals asked for
    asked = known.join(quoted.select("conv_id").distinct(), "conv_id", "left_semi")
    own = said(asked).filter("level = 0").drop("level")
    first = _hashed(own).groupBy("conv_id", "hash", "normal").agg(F.min("turn").alias("origin"))
    first = staged(first, "originals").withColumnRenamed("normal", "_normal")
    return (
        quoted.join(first, ["conv_id", "hash"])
        .filter((F.col("normal") == F.col("_normal")) & (F.col("origin") < F.col("turn")))
        .select("conv_id", "turn", "level", "origin")
    )


def threads(answers: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth) of each message that answers one, from (conv_id, turn, answers).

    In each round a message takes over the thread and the depth of the message its
    chain has reached, so chains halve.
    """
    state = staged(answers.select("conv_id", "turn", F.col("answers").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        reached = state.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("_next"), F.col("depth").alias("_more"))
        jumped = state.join(reached, ["conv_id", "thread"], "left")
        if jumped.filter("_next is not null").isEmpty():
            return state
        state = staged(
            jumped.select(
                "conv_id",
                "turn",
                F.coalesce("_next", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"),
            ),
            "threads",
        )


def link_conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, answers, thread, depth, text), one row per message (conv_id, turn, role, text)."""
    cut = messages.select("conv_id", "turn", "role", quoted_lines(F.col("text")).alias("lines"))
    cut = cut.withColumn("lines", without_attributions(F.col("lines"))).withColumn("own", own_text(F.col("lines")))
    best = F.max(F.struct((-F.col("level")).alias("outer"), "origin"))
    answers = quotations(cut).groupBy("conv_id", "turn").agg(best.alias("best"))
    answers = staged(answers.select("conv_id", "turn", F.col("best.origin").alias("answers")), "answers")
    placed = staged(answers.join(threads(answers), ["conv_id", "turn"]), "placed")
    own = F.when(F.col("conv_id").isNotNull(), F.col("turn"))
    return (
        cut.select("conv_id", "turn", "role", F.array_join("own", "\n").alias("text"))
        .join(placed, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            "answers",
            F.coalesce("thread", own).alias("thread"),
            F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
            "text",
        )
    )
