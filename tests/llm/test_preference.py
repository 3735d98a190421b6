from collections import defaultdict

from cropwire.llm import preference as pf

TURNS = "pair_id long, turn long, role string, text string"


def brute(chosen, rejected):
    """Turn by turn, as sets."""
    sides = [defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set))]
    for side, rows in zip(sides, (chosen, rejected)):
        for p, t, role, text in rows:
            if p is not None and t is not None:
                side[p][t].add((role, text))
    out = set()
    for p in set(sides[0]) & set(sides[1]):
        a, b = sides[0][p], sides[1][p]
        differs = min((t for t in set(a) | set(b) if a.get(t) != b.get(t)), default=None)
        for part, turns in (("prompt", a), ("chosen", a), ("rejected", b)):
            for t, rows in turns.items():
                if (differs is None or t < differs) == (part == "prompt"):
                    for role, text in rows:
                        head = f"<|im_start|>{role or ''}\n"
                        out.add((p, part, t, role, f"{head}{text or ''}<|im_end|>\n", len(head) if part != "prompt" and role == "assistant" else None))
    return out


def formatted(spark, a, b):
    got = pf.format_preferences(spark.createDataFrame(a, TURNS), spark.createDataFrame(b, TURNS)).collect()
    assert len(set(got)) == len(got)
    return {tuple(r) for r in got}


def test_formatting_equals_brute_force(spark):
    a = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "system", "s"), (2, 1, "user", "u"), (2, 2, "assistant", "x"), (2, 3, "user", "more"),
         (3, 0, "user", "same"), (3, 1, "assistant", "same"), (4, 0, "user", "only chosen"), (5, 0, None, None), (5, 0, None, None), (5, 1, "assistant", None),
         (None, 0, "user", "x"), (6, None, "user", "x"), (7, 2, "assistant", "b"), (7, 2, "assistant", "a"), (8, 0, "user", "u" * 300000)]
    b = [(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (2, 0, "system", "s"), (2, 1, "user", "other"), (2, 2, "assistant", "x"),
         (3, 0, "user", "same"), (3, 1, "assistant", "same"), (5, 0, None, None), (5, 1, "assistant", ""), (7, 2, "assistant", "a"), (8, 0, "user", "u" * 300000), (8, 1, "assistant", "z")]
    assert formatted(spark, a, b) == brute(a, b)
    assert formatted(spark, [], []) == set() == formatted(spark, a, [])


def test_pairs_from_conversations(spark, clashing):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "a2"), (2, 2, "user", "bye"), (3, 0, "user", "r"), (3, 1, "assistant", "b"), (3, 3, "assistant", "a3"),
            (4, 0, "user", "alone"), (6, 0, "assistant", "no partner"), (None, 0, "user", "x"), (8, 0, "assistant", None), (9, 0, "assistant", "n")]
    chosen, rejected = pf.corrupted_pairs(clashing(spark.createDataFrame(rows, schema)))
    assert {tuple(r) for r in rejected.collect()} == {(2, 0, "user", "q"), (2, 1, "assistant", "a3"), (3, 0, "user", "r"), (3, 1, "assistant", "b"),
                                                     (3, 3, "assistant", "a2"), (8, 0, "assistant", "n"), (9, 0, "assistant", "")}
    assert {tuple(r) for r in chosen.collect()} == {r for r in rows if r[0] in (2, 3, 8, 9) and r[3] != "bye"}
    got = {(r.pair_id, r.part, r.turn) for r in pf.format_preferences(chosen, rejected).collect()}
    assert {g for g in got if g[0] == 3} == {(3, "prompt", 0), (3, "prompt", 1), (3, "chosen", 3), (3, "rejected", 3)}


def test_query_on_the_test_table(spark, tables):
    rows = [tuple(r) for r in tables("conversations").select("conv_id", "turn", "role", "text").collect()]
    last = {}
    for c, t, role, text in rows:
        if role == "assistant":
            last[c] = max(last.get(c, (-1, "")), (t, text or ""))
    pairs = {c for c in last if c ^ 1 in last}
    a = [r for r in rows if r[0] in pairs and r[1] <= last[r[0]][0]]
    b = [(c, t, role, last[c ^ 1][1] if role == "assistant" and t == last[c][0] else text) for c, t, role, text in a]
    assert {tuple(r) for r in pf.op3_preference_formatting(spark, "/root/testdata/sf0.001").collect()} == brute(a, b)
