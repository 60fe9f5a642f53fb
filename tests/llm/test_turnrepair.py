"""Grammar-compressed repair against a plain search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from gaugeline.llm import turnrepair as tr

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
FORM = re.compile(r"(s?(ua)+)?\Z")


def best_edits(items):
    """Cheapest, then ASCII-least edits by a shortest path that keeps whole audits; items are (initial, gone, truncated)."""
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}

    def with_inserts(states):
        todo = list(states.items())
        while todo:
            state, (cost, audit) = todo.pop()
            for role in steps[state]:
                made = (cost + 5, audit + "I")
                if role != "s" and made < states.get(role, (10**9, "")):
                    states[role] = made
                    todo.append((role, made))
        return states
    states = with_inserts({"": (0, "")})
    for initial, gone, truncated in items:
        after = {}
        for state, (cost, audit) in states.items():
            options = [(state, cost + 2, "D")]
            if not gone:
                extra = 5 if truncated else 0
                options += [(r, cost + extra, "K") for r in steps[state] if r == initial]
                options += [(r, cost + extra + 1, "R") for r in steps[state] if r in "ua"]
            for role, c, e in options:
                after[role] = min(after.get(role, (10**9, "")), (c, audit + e))
        states = with_inserts(after)
    return min(v for s, v in states.items() if s in ("", "a"))


def whole_repair(rows):
    """All columns of one conversation, from rows (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        visible = VISIBLE.findall(text)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else "none"
        faults.append(fault)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = best_edits([(r[:1], f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(rows, faults)])
    out, initials, left = [], "", iter(rows)
    for e in audit:
        row = None if e == "I" else next(left)
        if e == "D":
            continue
        role = "user" if initials[-1:] in ("", "s", "a") else "assistant"
        out.append((row[1], row[2]) if e == "K" else (role, "" if e == "I" else row[2]))
        initials += out[-1][0][:1]
    assert FORM.match(initials)
    body = "\n".join(f"{r}:{t}" for r, t in out)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())


def test_plain_search_is_the_cheapest_of_all_edits():
    """The search used above against an enumeration of audits, on short conversations."""
    for items in itertools.product([("u", False, False), ("a", False, True), ("s", False, False), ("x", True, False)], repeat=3):
        found = []
        for inserts in itertools.product(range(3), repeat=4):
            for edits in itertools.product("DKR", repeat=3):
                if any(i[1] and e != "D" for i, e in zip(items, edits)):
                    continue
                audit, cost, initials = "I" * inserts[0], 5 * sum(inserts), ["*"] * inserts[0]
                for (initial, _, truncated), e, n in zip(items, edits, inserts[1:]):
                    audit += e + "I" * n
                    cost += 2 if e == "D" else (e == "R") + 5 * truncated
                    initials += ([] if e == "D" else [initial if e == "K" else "*"]) + ["*"] * n
                at = 1 if initials[:1] == ["s"] else 0
                wanted = ["ua"[n % 2] for n in range(len(initials) - at)]
                fits = len(wanted) % 2 == 0 and (not at or wanted) and all(g in ("*", w) for g, w in zip(initials[at:], wanted))
                if fits:
                    found.append((cost, audit))
        assert best_edits(items) == min(found)


def test_ropes_order_like_texts():
    rng = random.Random(1)

    def rope(s):
        if len(s) < 2 or rng.random() < 0.3:
            return tr.Rope(s)
        cut = rng.randrange(len(s) + 1)
        return rope(s[:cut]) + rope(s[cut:])
    for _ in range(5000):
        a = "".join(rng.choices("DIKR", k=rng.randrange(9)))
        b = a[:rng.randrange(9)] + "".join(rng.choices("DIKR", k=rng.randrange(3)))
        assert (rope(a) < rope(b)) == (a < b) and str(rope(a)) == a


def test_any_grammar_gives_the_plain_search():
    rng = random.Random(2)
    rules = []
    for _ in range(60):
        top = tr.SYMBOLS + len(rules)
        rules.append((rng.randrange(top), rng.randrange(top)))
    expanded = {s: [s] for s in range(tr.SYMBOLS)}
    for n, (a, b) in enumerate(rules):
        expanded[tr.SYMBOLS + n] = expanded[a] + expanded[b]
    matrices = tr.evaluate(rules)
    for _ in range(150):
        sequence = [s for s in rng.choices(range(len(matrices)), k=rng.randrange(9)) if len(expanded[s]) < 40]
        items = [("x" if s == tr.GONE else tr.KINDS[s % 4], s == tr.GONE, 4 <= s < tr.GONE) for n in sequence for s in expanded[n]]
        assert tr.cheapest(tr.product(sequence, matrices)) == best_edits(items)


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    roles = ["user"] * 6 + ["assistant"] * 6 + ["system", "tool", "", None, "sys", "undo"]
    texts = ["Yes.", "no", "Is it?", "", None, " \t", "é!\n ", "wait… ", "Same."]
    rows = []
    for conv in [None, *range(1, 120)]:
        for n in range(rng.randrange(1, 14)):
            rows.append((conv, rng.choice([n, n, n, n + 3, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"t {n} {rng.random()}."))
    rows += rows[:40]  # repeated rows
    rows += [(500, n, "assistant" if n % 2 else "user", f"word {n % 7}" + "." * (n % 3 > 0)) for n in range(9000)]  # many pieces
    rows += [(501, 1, "user", "Same copies.")] * 5000
    rows += [(502, n, "user", "long " * 30_000 + ".") for n in range(3)]
    return rows


def test_repair_equals_whole_search(spark, turns):
    made = spark.createDataFrame([(*r, "x", 1) for r in turns], "conv_id long, turn long, role string, text string, audit string, `a.b` int")
    got = {r["conv"]: tuple(r)[1:] for r in tr.repair(made, least=2).collect()}
    by_conv = {}
    for c, *row in turns:
        by_conv.setdefault(c, []).append(tuple(row))
    assert got.keys() == by_conv.keys()
    for conv, rows in by_conv.items():
        assert got[conv] == whole_repair(rows), conv
    assert tr.repair(made.limit(0)).count() == 0


def test_grammar_shortens_and_expands_to_the_same(spark):
    rng = random.Random(4)
    strings = [[1, 2] * rng.randrange(1, 200) + rng.choices(range(9), k=rng.randrange(5)) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(strings)), "conv long, symbols array<int>")
    rules, short = tr.learn_grammar(df, max_rules=20)
    assert 0 < len(rules) <= 20

    def whole(symbol):
        return [symbol] if symbol < tr.SYMBOLS else [x for part in rules[symbol - tr.SYMBOLS] for x in whole(part)]
    got = {r["conv"]: r["symbols"] for r in short.collect()}
    assert [[x for s in got[n] for x in whole(s)] for n in range(80)] == strings
    assert sum(map(len, got.values())) * 10 < sum(map(len, strings))


def test_damage_and_absent_conversations(spark):
    turns = spark.createDataFrame([(c, t, "assistant", "A. b!") for c in (1, None) for t in (*range(60), None)], "conv_id long, turn long, role string, text string")
    made = sorted(tr.damaged(turns).where("conv_id = 1").select("turn", "role", "text").collect(), key=repr)
    want = []
    for t in (*range(60), None):
        kind = zlib.crc32(f"1:{' ' if t is None else t}".encode()) % 20
        row = (t, "user" if kind == 4 else "assistant", {1: "", 2: "A b"}.get(kind, "A. b!"))
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert [tuple(r) for r in made] == sorted(want, key=lambda r: f"Row(turn={r[0]!r}, role={r[1]!r}, text={r[2]!r})")
    gone = spark.createDataFrame([(3, 1, "user", "x."), (4, 1, "user", "x.")], turns.schema)
    found = {r["conv_id"]: r for r in tr.with_absent(tr.repair(gone.where("conv_id = 3")), gone).collect()}
    assert tuple(found[4])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and found[3]["audit"] == "D"
