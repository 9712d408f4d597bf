from __future__ import annotations

import random

from llm_helpers import clashing

from floorline.llm.oracle import OP10
from floorline.llm.quotations import reply_ordered

SCHEMA = "conv_id long, turn long, role string, text string"


def sql_rows(tmp_path, frame, columns):
    import duckdb

    path = f"{tmp_path}/conversations.parquet"
    frame.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    found = connection.sql(OP10)
    at = [found.columns.index(c) for c in columns]
    return sorted((tuple(r[i] for i in at) for r in found.fetchall()), key=repr)


def test_replies_are_ordered_below_what_they_quote(spark):
    rows = [
        (1, 0, "user", "What is Spark?\nAnd what is a shuffle?"),
        (1, 1, "assistant", "> what is  SPARK\n\nAn engine."),
        (1, 2, "assistant", ">And what is a shuffle?\nAn exchange of rows."),
        (1, 3, "user", ">> What is Spark?\n> An engine.\n\nThanks!\n> quoted from nowhere"),
        (1, 4, "user", "A new question."),
        (1, 5, "assistant", "> What is Spark?\n> And what is a shuffle?\nBoth at once."),
    ]
    found = {r["turn"]: r for r in reply_ordered(clashing(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert [found[t]["reply_to"] for t in range(6)] == [None, 0, 0, 1, None, 0]
    assert [t for t, _ in sorted(found.items(), key=lambda x: x[1]["position"])] == [0, 1, 3, 2, 5, 4]
    assert [found[t]["depth"] for t in range(6)] == [0, 1, 1, 2, 0, 1]
    assert [found[t]["n_quotes"] for t in range(6)] == [0, 1, 1, 3, 0, 1]
    assert found[3]["own_text"] == "\nThanks!" and found[3]["formatted"] == "<|user|>\n\nThanks!"


def test_deeper_levels_link_where_shallower_ones_do_not(spark):
    rows = [
        (1, 0, "user", "What is Spark?"),
        (1, 1, "assistant", "An engine."),
        (1, 2, "user", ">> What is Spark?\nStill open."),
        (1, 3, "user", "> said elsewhere\n>> An engine.\nYes."),
        (1, 4, "user", "> An engine.\n>> What is Spark?\n>> Still open.\nShallow first."),
        (1, 5, "user", ">>> What is Spark?\n>>> Still open.\n>>> What is Spark?\nThe heavier one."),
        (1, 6, "user", ">>>> said nowhere\nNo link."),
    ]
    frame = clashing(spark.createDataFrame(rows, SCHEMA))
    linked = lambda deepest: [r["reply_to"] for r in sorted(reply_ordered(frame, deepest=deepest).collect(), key=lambda r: r["turn"])]
    assert linked(None) == [None, None, 0, 1, 1, 0, None]
    assert [r["reply_to"] for r in sorted(reply_ordered(frame).collect(), key=lambda r: r["turn"])] == linked(None)  # all levels unless asked otherwise
    assert linked(2) == [None, None, 0, 1, 1, None, None]
    assert linked(1) == [None, None, None, None, 1, None, None]


def test_matches_sql_on_random_threads(spark, tmp_path):
    rng = random.Random(9)
    rows, said = [], {}
    for conv in range(12):
        for turn in range(rng.randrange(1, 25)):
            lines = [f"line {rng.randrange(30)}" for _ in range(rng.randrange(0, 3))]
            for _ in range(rng.randrange(0, 3)):
                source = said.get((conv, rng.randrange(max(1, turn))), ["nothing"])
                lines += [">" * rng.choice((1, 1, 2, 3)) + rng.choice((" ", "")) + x.upper() for x in source if not x.startswith(">")]
                if rng.random() < 0.5:
                    lines.append("own " + str(rng.randrange(5)))
            said[conv, turn] = lines
            rows.append((conv, turn, rng.choice(("user", "assistant", None)), "\n".join(lines)))
    rows += [(None, 0, "user", "hi"), (None, 1, "user", "> hi\nyes"), (50, None, "user", "> hi"), (51, 3, None, None), (51, 4, "user", ""),
             rows[3], rows[3], (52, 1, "user", "ok"), (52, 1, "user", "> ok"), (52, 2, "user", "> ok\nfine")]
    frame = spark.createDataFrame(rows, SCHEMA)
    columns = ["conv_id", "turn", "role", "own_text", "n_quotes", "reply_to", "depth", "position"]
    found = sorted((tuple(r[c] for c in columns) for r in reply_ordered(frame).collect()), key=repr)
    assert found == sql_rows(tmp_path, frame, columns)
    assert max(r[6] for r in found) > 2


def test_long_chain_long_text_and_empty_table(spark):
    chain = [(1, 0, "user", "m0")] + [(1, t, "user", f"> m{t - 1}\nm{t}") for t in range(1, 150)]
    chain.append((2, 0, "user", "\n".join(f"{'>' * (k % 3)} line {k}" for k in range(3000))))
    found = {(r["conv_id"], r["turn"]): r for r in reply_ordered(spark.createDataFrame(chain, SCHEMA)).collect()}
    assert all(found[1, t]["depth"] == t and found[1, t]["position"] == t + 1 for t in range(150))
    assert found[2, 0]["n_quotes"] == 2000
    assert reply_ordered(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = reply_ordered(spark.createDataFrame([(1, 1, "user", "x")], SCHEMA))
    text = plan._jdf.queryExecution().toString()
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))
