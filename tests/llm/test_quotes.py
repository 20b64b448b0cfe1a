"""Quotations: wrapped again, several at once, at nested levels; against the SQL on messages with quotes."""

import random
import textwrap

from compare import difference
from pyspark.sql import functions as F

from offerloom.llm import oracles, quotes

MESSAGES = "conv_id bigint, turn bigint, role string, text string"
FIRST = (
    "The first point is about the budget, which nobody has seen since last year. It may be gone!\n"
    "We should ask again.\n\nThe second point is shorter, but it goes on over the end of a line as well."
)
SECOND = "I would rather wait until the end of the month before anything is sent to the office. What do you think?"


def quoted(text, width=None, marks="> "):
    lines = []
    for paragraph in text.split("\n\n"):
        flow = paragraph if width is None else textwrap.fill(" ".join(paragraph.split()), width)
        lines += [*flow.split("\n"), ""]
    return "\n".join(marks + line for line in lines[:-1])


def answers(spark, rows):
    frame = spark.createDataFrame(rows, MESSAGES)
    return {(r["conv_id"], r["turn"]): r["answers"] for r in quotes.link_conversations(frame).collect()}


def test_wrapped_quotes_link(spark):
    rows = [(1, 0, "a", FIRST), (1, 1, "b", SECOND)]
    rows += [(1, 10 + w, "c", f"On Monday X wrote:\n{quoted(FIRST, w)}\nAgreed.") for w in (30, 50, 70)]
    # a part of the original, wrapped, beside a quote of another message of the same level
    part = FIRST.split("\n\n")[1]
    rows += [(1, 100 + w, "c", f"{quoted(part, w)}\nYes.\n{quoted(SECOND, w)}\nNo.") for w in (25, 40, 60)]
    # one sentence of a paragraph
    rows.append((1, 200, "c", "> We should ask\n> again.\nWhy?"))
    # a quote of the first in a quote of the second
    rows.append((1, 300, "c", f"{quoted(SECOND, 33)}\n{quoted(part, 28, '> > ')}\nBoth."))
    got = answers(spark, rows)
    assert [got[1, 10 + w] for w in (30, 50, 70)] == [0, 0, 0]
    assert [got[1, 100 + w] for w in (25, 40, 60)] == [1, 1, 1]
    assert got[1, 200] == 0 and got[1, 300] == 1


def test_random_conversations_equal_the_sql(spark, tmp_path):
    import duckdb

    rng = random.Random(13)
    rows = []
    for conv in range(25):
        said = []
        for turn in range(rng.randint(1, 12)):
            parts = []
            for _ in range(rng.randint(0, 3)):
                if said and rng.random() < 0.7:
                    if rng.random() < 0.4:
                        parts.append("Le lundi X écrit :")
                    parts.append(quoted(rng.choice(said), rng.choice([None, 20, 45]), rng.choice(["> ", ">", ">> ", " > > "])))
                own = " ".join(f"word{rng.randrange(9)}" + rng.choice(["", "", ".", "?", " ,"]) for _ in range(rng.randint(1, 14)))
                parts.append(textwrap.fill(own, 40) + rng.choice(["", "\n", "\n\nmore"]))
            text = "\n".join(parts)
            said.append(text)
            rows.append((conv, turn, "u", text))
    rows += [(1, None, None, "x"), (None, 1, "u", "> x"), (3, 0, "u", "> word1"), (3, 0, "u", None), (4, 99, "u", ""), (4, 98, "u", "\n>\n> \n")]
    frame = spark.createDataFrame(rows, MESSAGES)
    frame.coalesce(1).write.parquet(f"{tmp_path}/c")
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{tmp_path}/c/*.parquet'")
    got = quotes.link_conversations(spark.read.parquet(f"{tmp_path}/c"))
    assert difference(got, db, oracles.QUOTATIONS) is None
    assert got.filter("answers is not null").count() > 40


def test_edges(spark):
    long = "> " + "word " * 30_000 + "\n" + "line\n" * 3000
    rows = [(1, 0, "u", "Hello there."), (1, 1, "u", "> Hello there.\nA"), (1, 1, "u", "B"), (1, 2, "u", long), (1, 3, "u", None)]
    frame = spark.createDataFrame(rows, MESSAGES)
    extra = frame.select("*", *[F.lit(1).alias(c) for c in "lines own level line passage passages normal hash origin answers thread depth".split()])
    got = quotes.link_conversations(extra)
    assert got.columns == ["conv_id", "turn", "role", "answers", "thread", "depth", "text"] and got.count() == 5
    # both rows of turn 1 link like one message
    assert {(r["answers"], r["thread"], r["text"]) for r in got.filter("turn = 1").collect()} == {(0, 0, "A"), (0, 0, "B")}
    assert quotes.link_conversations(extra.limit(0)).count() == 0
