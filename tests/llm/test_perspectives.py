"""Rendered dialogues against plain Python."""

import duckdb
import pytest
from pyspark.sql import functions as F

from closeworks.llm import perspectives as P
from closeworks.llm.sql import PERSPECTIVES
from tools.check_queries import difference

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "s<|x"),
    (1, 1, "ann", "é😀"),
    (1, 2, "bob", None),
    (1, 2, "ann", "dup"),
    (1, 2, "ann", "dup"),
    (1, 70, None, "z"),
    (None, 0, "ann", "n"),
    (2, None, "c", "q"),
    (3, 0, "system", "only"),
] + [(9, i, f"p{i % 3}", f"t{i}") for i in range(300)]


def escaped(text):
    return text.replace("<|", "< |")


def brute(rows):
    dialogues = {}
    for conv, turn, role, text in rows:
        dialogues.setdefault(conv, []).append((turn is None, turn or 0, role or "unknown", text or ""))
    out = {}
    for conv, turns in dialogues.items():
        for speaker in {t[2] for t in turns} - {"system"}:
            for last, turn, role, text in sorted(turns):
                key = (conv, None if last else turn // P.TURNS, speaker)
                done, mask = out.get(key, ("", ()))
                head = "system" if role == "system" else "assistant" if role == speaker else f"user name={escaped(role)}"
                start = len(done) + len(f"<|{head}|>\n")
                done += f"<|{head}|>\n{escaped(text)}<|end|>\n"
                out[key] = (done, mask + ((start, len(done)),) if role == speaker else mask)
    return out


def test_every_view(spark):
    got = {
        (r["conv_id"], r["part"], r["speaker"]): (r["text"], tuple(tuple(m) for m in r["mask"]))
        for r in P.rotate(spark.createDataFrame(ROWS, SCHEMA)).collect()
    }
    assert got == brute(ROWS)


@pytest.mark.parametrize("most", [1, 7])
def test_full_parts_are_cut_and_no_turn_is_lost(spark, monkeypatch, most):
    monkeypatch.setattr(P, "MOST", most)
    rows = P.rotate(spark.createDataFrame(ROWS, SCHEMA)).collect()
    people = {}
    for conv, _, role, _ in ROWS:
        people.setdefault(conv, set()).add(role or "unknown")
    expected = sum(len(people[conv] - {"system"}) for conv, *_ in ROWS)
    assert sum(r["n_turns"] for r in rows) == expected
    assert sum(r["n_own"] for r in rows) == sum(role != "system" for _, _, role, _ in ROWS)
    assert sum(len(r["mask"]) for r in rows) == sum(r["n_own"] for r in rows)


@pytest.mark.parametrize("most", [1, 7])
def test_cuts_follow_the_order_of_the_dialogue(spark, monkeypatch, most):
    monkeypatch.setattr(P, "MOST", most)
    same = [(5, 3, "ann", "again")] * 20 + [(None, None, r, t) for r in ("ann", "bob") for t in ("x" * 9 + "b", "x" * 9 + "a", "", "é") * 3]
    views = {}
    for r in sorted(P.rotate(spark.createDataFrame(ROWS + same, SCHEMA)).collect(), key=lambda r: r["cut"]):
        assert r["n_turns"] <= most
        view = views.setdefault((r["conv_id"], r["part"], r["speaker"]), [])
        assert r["cut"] == len(view)
        view.append(r["text"])
    assert {k: "".join(v) for k, v in views.items()} == {k: text for k, (text, _) in brute(ROWS + same).items()}


def test_no_rows_and_other_columns(spark):
    assert P.rotate(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, 0, "a", "x", 5, "y")], SCHEMA + ", part int, speaker string")
    assert P.rotate(df).first()["text"] == "<|assistant|>\nx<|end|>\n"


def test_the_sql_cuts_alike(spark):
    rows = ROWS[:-300] + [(9, i // 50, f"p{i % 3}", f"t{i % 700}") for i in range(2600)] + [(10, 5, "x", "same")] * 1500
    rows = [r for r in rows if r[0] is not None and r[1] is not None]
    df = P.rotate(spark.createDataFrame(rows, SCHEMA))
    ours = df.withColumn("mask", F.concat_ws(",", F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"])))).toArrow()
    connection = duckdb.connect()
    connection.register("conversations", spark.createDataFrame(rows, SCHEMA).toArrow())
    assert difference(ours, connection.sql(PERSPECTIVES).to_arrow_table()) is None
    assert {r["cut"] for r in ours.to_pylist()} == {0, 1, 2}
