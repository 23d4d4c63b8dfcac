"""Quotation linking on a small mailing list."""
from __future__ import annotations

from assayframe.llm import quotes
from assayframe.llm.quotes import linked

SCHEMA = "conv_id long, turn long, role string, text string, position string"
LIST = [
    (1, 0, "a", "How do I sort this?\n\nIt is a large table."),
    (1, 1, "b", "> How do I  SORT this?\n\nWith a range split."),
    (1, 2, "c", "Nothing to do with it."),
    (1, 3, "a", "> > How do I sort this?\r\n> With a range split.\n\nThanks."),
    (2, 0, "d", ">> With a range split.\n> Unknown words\nI read that too."),
    (2, 1, "e", "plain"),
    (3, 0, "f", "> I read that too.\nmore"),
    (4, 0, "g", None), (4, None, None, ""), (None, 1, "h", "x > y\n    > four blanks"),
    (5, 0, "same", "twice"), (5, 0, "same", "twice"),
]


def answer(spark, rows):
    df = spark.createDataFrame([r + ("clash",) for r in rows], SCHEMA)
    return linked(df).collect()


def test_links_levels_and_text(spark):
    got = {(r["conv_id"], r["turn"]): r for r in answer(spark, LIST)}
    to = lambda *key: (got[key]["reply_conv"], got[key]["reply_turn"])
    assert to(1, 0) == (None, None) and to(1, 1) == (1, 0) and to(1, 2) == (1, 1)
    assert to(1, 3) == (1, 1) and got[1, 3]["quote_levels"] == 2 and got[1, 3]["n_linked"] == 2
    assert got[1, 3]["own_text"] == "Thanks." and got[1, 1]["own_text"] == "With a range split."
    assert to(2, 0) == (1, 1) and got[2, 0]["n_quoted"] == 2 and got[2, 0]["n_linked"] == 1
    assert to(2, 1) == (2, 0) and to(3, 0) == (2, 0)
    assert got[2, 1]["thread_id"] == 1 and got[3, 0]["thread_id"] == 1
    assert got[None, 1]["quote_levels"] == 0 and got[None, 1]["own_text"] == "x > y\n    > four blanks"
    assert got[4, 0]["own_text"] == "" and got[4, None]["reply_turn"] == 0


def test_replies_stand_after_their_targets(spark):
    got = answer(spark, LIST)
    assert len(got) == len(LIST)
    place = {(r["conv_id"], r["turn"]): r["position"] for r in got if r["thread_id"] == 1}
    assert sorted(place.values()) == list(range(1, len(place) + 1))
    for r in got:
        if r["thread_id"] == 1 and r["reply_conv"] is not None:
            assert place[r["reply_conv"], r["reply_turn"]] < r["position"]


def test_stretches_do_not_change_places(spark, monkeypatch):
    rows = [(7, t, "u", f"line {t}" if t % 3 else f"> line {t - 1}\nsame") for t in range(40)]
    whole = sorted(map(str, answer(spark, rows)))
    monkeypatch.setattr(quotes, "_STRETCH", 4)
    assert sorted(map(str, answer(spark, rows))) == whole


def test_empty(spark):
    assert answer(spark, []) == []


def test_long_texts_and_many_conversations_in_a_thread(spark, monkeypatch):
    monkeypatch.setattr(quotes, "_STRETCH", 4)
    many = "\n".join(f"> line {i}" if i % 2 else f"own {i}" for i in range(20_000))
    rows = [(0, 0, "a", "said once")] + [(c, 0, "b", "> said once\nyes") for c in range(1, 30)]
    rows += [(40, 0, "c", many), (41, 0, "d", ">" * 50_000), (42, 0, "e", "x" + " " * 200_000 + "y")]
    got = {r["conv_id"]: r for r in answer(spark, rows)}
    assert [got[c]["position"] for c in range(30)] == list(range(1, 31))
    assert {got[c]["thread_id"] for c in range(30)} == {0}
    assert got[40]["n_quoted"] == 10_000 and got[40]["own_text"].count("\n") == 9_999
    assert got[41]["own_text"] == "" and len(got[42]["own_text"]) == 200_002


def test_trimmed_quotes_and_paragraphs_run_together(spark):
    rows = [(1, 0, "a", "one line\ntwo lines\nthree lines\nfour lines\n\nanother paragraph\nwith its end"),
            (1, 1, "b", "said between\nfour lines"),
            (1, 2, "c", "> two lines\n> three  LINES\nyes"),
            (1, 3, "d", "> three lines\n> another paragraph\nno"),
            (2, 0, "e", "> one line\n> two lines\n> three lines\n> [...]\nelsewhere"),
            (2, 1, "f", "> never said\n> nor this\nmore")]
    got = {(r["conv_id"], r["turn"]): r for r in answer(spark, rows)}
    for key in ((1, 2), (1, 3), (2, 0)):
        assert (got[key]["reply_conv"], got[key]["reply_turn"]) == (1, 0)
        assert got[key]["n_quoted"] == 1 and got[key]["n_linked"] == 1
    assert got[2, 1]["n_linked"] == 0 and got[2, 1]["reply_turn"] == 0 and got[2, 1]["reply_conv"] == 2
