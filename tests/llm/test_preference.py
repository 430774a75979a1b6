"""Preference pairs by hand."""

from plantlake.llm import queries
from plantlake.llm.chat_preference import preference_pairs, preference_segments, with_swapped_ends

SCHEMA = "pair_id long, turn long, role string, text string, part string, side int"


def side(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)


def segments(spark, chosen, rejected):
    found = preference_segments(side(spark, chosen), side(spark, rejected))
    assert found.columns == ["pair_id", "part", "turn", "role", "segment", "trained"]
    order = lambda r: (r.pair_id or -1, r.part, -1 if r.turn is None else r.turn, r.segment)
    return [(r.pair_id, r.part, r.turn, r.segment, r.trained) for r in sorted(found.collect(), key=order)]


def text(role, body):
    return f"<|im_start|>{role}\n{body}<|im_end|>\n"


def test_prefix_once_and_masks(spark):
    shared = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")]
    got = segments(spark, [*shared, (1, 3, "user", "v"), (1, 4, "assistant", "good")], [*shared, (1, 3, "user", "v"), (1, 4, "assistant", "bad"), (1, 5, "user", "w")])
    assert got == [
        (1, "chosen", 4, text("assistant", "good"), True),
        (1, "prompt", 0, text("system", "s"), False), (1, "prompt", 1, text("user", "u"), False),
        (1, "prompt", 2, text("assistant", "a"), False), (1, "prompt", 3, text("user", "v"), False),
        (1, "rejected", 4, text("assistant", "bad"), True), (1, "rejected", 5, text("user", "w"), False),
    ]


def test_equal_turns_behind_a_difference_are_completions(spark):
    got = segments(spark, [(1, 0, "user", "a"), (1, 1, "user", "same")], [(1, 0, "user", "b"), (1, 1, "user", "same")])
    assert [(p, t) for _, p, t, *_ in got] == [("chosen", 0), ("chosen", 1), ("rejected", 0), ("rejected", 1)]


def test_odd_rows(spark):
    same = [(1, None, None, None), (1, 0, "user", None), (1, 0, "user", None)]
    assert [(p, t, s) for _, p, t, s, _ in segments(spark, same, same)] == [("prompt", None, text("", "")), ("prompt", 0, text("user", ""))]
    assert [p for _, p, *_ in segments(spark, [(2, 0, "user", "x")], [])] == ["chosen"]
    assert [p for _, p, *_ in segments(spark, [(3, 0, "user", None)], [(3, 0, "user", "")])] == ["chosen", "rejected"]
    assert [p for _, p, *_ in segments(spark, [(None, 0, "user", "x")], [(None, 0, "user", "x")])] == ["prompt"]
    assert segments(spark, [], []) == []
    long = "word " * 200_000
    assert segments(spark, [(4, 0, "user", long)], [(4, 0, "user", long)])[0][3] == text("user", long)


def pairs(spark, chosen, rejected):
    found = preference_pairs(preference_segments(side(spark, chosen), side(spark, rejected)))
    assert found.columns == ["pair_id", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask"]
    return {r.pair_id: (*r[1:4], *[[tuple(t) for t in mask] for mask in r[4:]]) for r in found.collect()}


def test_pairs_hold_the_prompt_once_and_masks(spark):
    shared = [(1, None, "system", "s"), (1, 2, "user", "ü" * 3)]
    good, bad = [(1, 10, "assistant", "good"), (1, 11, "user", "thanks")], [(1, 10, "assistant", "bad 😀")]
    got = pairs(spark, [*good, *shared], [*bad, *shared])
    answer, reply = text("assistant", "good"), text("user", "thanks")
    other = text("assistant", "bad 😀")
    assert got == {
        1: (
            text("system", "s") + text("user", "üüü"), answer + reply, other,
            [(len(answer), True), (len(reply), False)], [(len(other), True)],
        )
    }


def test_odd_pairs(spark):
    same = [(1, 0, "user", None), (1, 0, None, "b"), (1, 0, "user", "a")]
    # By role, null first, then text.
    assert pairs(spark, same, same) == {1: (text("", "b") + text("user", "") + text("user", "a"), "", "", [], [])}
    own = text("assistant", "x")
    assert pairs(spark, [(2, 0, "assistant", "x")], []) == {2: ("", own, "", [(len(own), True)], [])}
    assert pairs(spark, [(None, 0, "user", "")], [(None, 0, "user", "")]) == {None: (text("user", ""), "", "", [], [])}
    assert pairs(spark, [], []) == {}
    turns = [(3, i, "user", "word " * 2000) for i in range(200)]
    prompt, *_ = pairs(spark, turns, turns[:-1])[3]
    assert prompt == text("user", "word " * 2000) * 199


def test_pairs_are_the_turns_of_the_segments(spark, tmp_path):
    rows = [(p, t, "assistant" if t % 2 else "user", f"{p * t % 5}") for p in range(20) for t in range(p % 7)]
    chosen = side(spark, rows)
    segments = preference_segments(chosen, with_swapped_ends(chosen))
    joined = {}
    for r in sorted(segments.collect(), key=lambda r: r.turn):
        joined[r.pair_id, r.part] = joined.get((r.pair_id, r.part), "") + r.segment
    for r in preference_pairs(segments).collect():
        assert [joined.get((r.pair_id, p), "") for p in ("prompt", "chosen", "rejected")] == [r.prompt, r.chosen, r.rejected]
        assert sum(t.n_chars for t in r.chosen_mask) == len(r.chosen) and sum(t.n_chars for t in r.rejected_mask) == len(r.rejected)


def test_swapped_ends(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (2, 0, "user", "r"), (2, 5, "assistant", "a2"), (None, 0, "user", "n")]
    found = with_swapped_ends(side(spark, rows)).collect()
    got = sorted((r.pair_id, r.turn, r.text) for r in found if r.pair_id is not None)
    assert got == [(1, 0, "q"), (1, 1, "a2"), (2, 0, "r")]


def test_columns_of_any_name(spark, tmp_path):
    names = ("pair_id", "_pair", "_turn", "_text", "_other", "_found", "part", "end", "sides")
    schema = "conv_id long, turn long, role string, text string, " + ", ".join(f"{n} string" for n in names)
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", None), (2, 1, None, "b")]
    table = spark.createDataFrame([(*r, *names) for r in rows], schema)
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op1_preference_format(spark, str(tmp_path)).collect()
    assert sorted((r.pair_id, r.part, r.turn, r.trained) for r in found) == [
        (1, "chosen", 1, True), (1, "prompt", 0, False), (1, "rejected", 1, True), (2, "chosen", 1, False), (2, "prompt", 0, False),
    ]
    assert with_swapped_ends(side(spark, [])).collect() == []
