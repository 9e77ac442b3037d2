from __future__ import annotations

import re

from civicmart.llm import quotes

SCHEMA = "conv_id long, turn int, role string, text string, thread string"


def ordered(spark, rows):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return sorted(quotes.reply_ordered(frame).collect(), key=lambda r: (r.conv_id or -1, r.position))


CHAT = [
    (1, 0, "user", "How do I sort a list?\nIt has numbers."),
    (1, 1, "assistant", "Use the sort method.\nIt works in place."),
    (1, 2, "user", "> Use the sort  METHOD.\n> It works in place.\n\nAnd for a copy?"),
    (1, 3, "user", "Ann wrote:\n>> How do I sort a list?\n> Use the sort method.\nI prefer another way."),
    (1, 4, "assistant", "> And for a copy?\nUse sorted."),
    (1, 5, "user", "> this was never said here\nHm."),
    (2, 0, "user", "> Use sorted.\nIs that right?"),
]


def test_replies_threads_and_clean_texts(spark):
    got = {(r.conv_id, r.turn): r for r in ordered(spark, CHAT)}
    reply = {k: r.reply_to for k, r in got.items()}
    assert reply == {(1, 0): None, (1, 1): None, (1, 2): 1, (1, 3): 1, (1, 4): 2, (1, 5): None, (2, 0): None}
    assert {k: (r.thread, r.depth) for k, r in got.items() if r.reply_to is not None} == {
        (1, 2): (1, 1),
        (1, 3): (1, 1),
        (1, 4): (1, 2),
    }
    assert got[1, 3].text == "I prefer another way." and got[1, 2].text == "And for a copy?"
    assert (got[1, 3].n_quoted, got[1, 3].n_linked) == (2, 2)
    assert (got[1, 5].n_quoted, got[1, 5].n_linked) == (1, 0)
    assert (got[2, 0].source_conv, got[2, 0].source_turn) == (1, 4)
    assert [r.turn for r in ordered(spark, CHAT) if r.conv_id == 1] == [0, 1, 2, 3, 4, 5]


def brute(rows):
    """Positions, and texts without lines that begin with a sign, one message after the other."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == conv]
        own = {}
        for _, turn, _, text in mine:
            lines = [x for x in text.split("\n") if not re.match(r"[ \t]*>", x)]
            own[turn] = "\n".join(lines).strip() if ">" in text else text
        parent = {}
        for _, turn, _, text in mine:
            best = None
            for block in re.findall(r"(?:^>[^\n]*(?:\n|$))+", text, re.M):
                said = " ".join(re.sub(r"^>\s?", "", block, flags=re.M).split()).lower()
                for t in sorted(own, reverse=True):
                    if t < turn and " ".join(own[t].split()).lower() == said:
                        best = t if best is None else max(best, t)
            parent[turn] = best
        thread = {}
        for turn in sorted(parent):
            thread[turn] = turn if parent[turn] is None else thread[parent[turn]]
        for i, turn in enumerate(sorted(parent, key=lambda t: (thread[t], t))):
            out[conv, turn] = (i, parent[turn], own[turn])
    return out


def test_equals_brute_force_on_long_threads(spark):
    rows = []
    for conv in range(3):
        for turn in range(40):
            text = f"message {turn} of talk {conv} says something"
            if turn > 2 and turn % 3:
                text = f"> message {turn - 1 - turn % 2} of talk {conv} says something\n\n{text}"
            rows.append((conv, turn, "user", text))
    want = brute(rows)
    got = {(r.conv_id, r.turn): (r.position, r.reply_to, r.text) for r in ordered(spark, rows)}
    assert got == want


def test_a_long_conversation_is_counted_in_chunks(spark):
    rows = [(7, t, "user", f"line {t}") for t in range(700)]
    assert [r.position for r in ordered(spark, rows)] == [r.turn for r in ordered(spark, rows)] == list(range(700))


def test_a_passage_that_everyone_quotes_links_each_once(spark):
    rows = [(c, 0, "user", "good morning to all") for c in range(30)]
    rows += [(c, 1, "user", "> good morning to all\nhello") for c in range(30)]
    rows += [(99, 1, "user", "> good morning to all\nhello from outside")]
    got = ordered(spark, rows)
    assert len(got) == 61 and all(r.n_linked == 1 for r in got if r.turn == 1)
    assert all(r.reply_to == 0 for r in got if r.turn == 1 and r.conv_id < 99)
    assert (got[-1].source_conv, got[-1].source_turn) == (0, 0)


def test_nulls_repeats_and_empty(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (None, 1, "user", "> a b\nc"), (1, None, "user", "x"), (2, 3, "u", "> \n>")]
    got = ordered(spark, rows)
    assert len(got) == 5
    assert sorted(r.position for r in got if r.conv_id == 1) == [0, 1, 2]
    assert all(r.n_linked == 0 and r.reply_to is None for r in got)
    assert ordered(spark, []) == []
