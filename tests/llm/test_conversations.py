"""Repairs against a plain search over all audits, a plain dynamic programme, and rows in plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from rimline.llm.common import table
from rimline.llm.conversations import closed, damaged, joined, op11_conversation_repair, repair, search, symbol, transfers

WHITE = " \t\n\v\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        said = [" " if v is None else str(v) for v in (conv, turn)]
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(":".join(said).encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def plain_faults(rows):
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return faults


def least(turns):
    """The least (cost, audit) by a programme over places and last roles; ``turns`` are (initial, fault)."""
    best = {"": (0, "", ())}

    def better(found, state, value):
        if state not in found or value[:2] < found[state][:2]:
            found[state] = value

    def follow(state):
        return "a" if state == "u" else "u"

    for i in range(len(turns) + 1):
        for _ in range(3):
            for state, (cost, audit, made) in list(best.items()):
                better(best, follow(state), (cost + 5, audit + "I", (*made, (follow(state), None))))
        if i == len(turns):
            break
        initial, fault = turns[i]
        found = {}
        for state, (cost, audit, made) in best.items():
            better(found, state, (cost + 2, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            cost += 5 * (fault == "truncated")
            if initial == follow(state) or (initial == "s" and state == ""):
                better(found, initial, (cost, audit + "K", (*made, (initial, i))))
            better(found, follow(state), (cost + 1, audit + "R", (*made, (follow(state), i))))
        best = found
    return min((best[s] for s in ("", "a") if s in best), key=lambda v: v[:2])


def plain_repair(rows):
    """The contract's columns for the damaged rows of one conversation."""
    rows = plain_order(rows)
    faults = plain_faults(rows)
    cost, audit, made = least([(role[:1], fault) for (_, _, role, _), fault in zip(rows, faults)])
    full, lines = {"u": "user", "a": "assistant"}, []
    for state, i in made:
        role = full[state] if i is None or rows[i][2][:1] != state else rows[i][2]
        lines.append(f"{role}:{'' if i is None else rows[i][3]}")
    turns = {r[1] for r in rows} - {None}
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def compare(found, rows, damage=True):
    expected = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        expected[conv] = plain_repair(plain_damage(own) if damage else own)
    found = found.collect()
    assert len(found) == len(expected)
    for r in found:
        assert tuple(r[c] for c in COLUMNS) == expected[r.conv_id], r.conv_id


def all_audits(turns):
    """The least (cost, audit) of all sequences of edits of at most two inserts at a place, none left out."""
    gaps = ["", "I", "II"]
    best = None
    for inserts in itertools.product(gaps, repeat=len(turns) + 1):
        for own in itertools.product("KRD", repeat=len(turns)):
            audit = "".join(g + o for g, o in zip(inserts, own)) + inserts[-1]
            cost, state, at, good = 0, "", 0, True
            for edit in audit:
                follow = "a" if state == "u" else "u"
                if edit == "I":
                    cost, state = cost + 5, follow
                    continue
                turn, at = turns[at], at + 1
                if edit == "D":
                    cost += 2
                    continue
                good &= turn != "x" and (edit == "R" or turn.lower() == follow or (turn.lower() == "s" and state == ""))
                cost += (edit == "R") + 5 * turn.isupper()
                state = follow if edit == "R" else turn.lower()
            if good and state in ("", "a") and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_search_against_all_audits():
    for turns in itertools.chain.from_iterable(itertools.product("suaoxSU", repeat=n) for n in range(3)):
        assert search("".join(turns), "", None) == all_audits(turns), turns
    rng = random.Random(4)
    for _ in range(12):
        turns = "".join(rng.choice("suaoxSUAO") for _ in range(4))
        assert search(turns, "", None) == all_audits(turns), turns


FAULTS = [None, None, None, "blank", "duplicate", "truncated"]


def test_search_and_joined_segments_against_the_programme():
    rng = random.Random(9)
    for k in range(300):
        turns = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.choice(FAULTS)) for _ in range(rng.randrange(0, 40))]
        signs = "".join(symbol(role, fault) for role, fault in turns)
        expected = least(turns)[:2]
        assert search(signs, "", None) == expected
        if k % 5 == 0:
            held, at = {"": (0, "")}, 0
            while at < len(signs):
                size = rng.randrange(1, 9)
                held, at = joined(held, transfers(signs[at : at + size], False)), at + size
            assert closed(held) == expected


def test_query_on_given_conversations(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "conversations").select("conv_id", "turn", "role", "text").collect()]
    compare(op11_conversation_repair(spark, "/root/testdata/sf0.01"), rows)


def random_rows(rng, conversations, turns):
    texts = ["", " \n", "a.", "b!", "c", "d? ", "e…", "f. ", None, "a.b", "ü.", "😀"]
    roles = ["user", "assistant", "system", "tool", None, "", "u", "S", "sales", "ä"]
    return [
        (conv, rng.choice([None, *range(turns)]) if rng.random() < 0.4 else t, rng.choice(roles[:3]) if rng.random() < 0.8 else rng.choice(roles), rng.choice(texts))
        for conv in [None, *range(conversations)]
        for t in range(rng.randrange(1, turns))
    ]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_nulls_ties_and_repeats(spark):
    rows = random_rows(random.Random(11), 150, 9)
    rows += [(500, t, "user", "same.") for t in (3, 1, 1, 1, None)] + [(501, 2**62, "user", "x"), (501, -(2**61), "user", "x")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", copies int, digest string").repartition(7)
    compare(repair(damaged(df)), rows)
    assert repair(damaged(df.limit(0))).count() == 0


def test_conversations_whose_rows_are_all_dropped(spark):
    dropped = [(c, 0, "user", "Yes.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    found = repair(damaged(spark.createDataFrame(dropped, SCHEMA))).collect()
    assert len(found) == len(dropped) > 5
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r[c] for c in COLUMNS) for r in found} == {(0, 0, 0, 0, 0, 0, "", empty)}


@pytest.mark.parametrize("segment", [3, 64])
def test_long_conversations_over_many_tasks(spark, segment):
    rng = random.Random(segment)
    rows = random_rows(rng, 30, 5)
    rows += [(7000, t, rng.choice(["user", "assistant", "user", "system"]), rng.choice(["Yes.", "no", f"t{t}.", f"t{t}!"])) for t in range(1200)]
    rows += [(7001, t // 40, "user", "Same again.") for t in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compare(repair(damaged(df), segment), rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_texts(spark):
    rows = [(1, 0, "user", " " * 2_000_000 + "x. " + " " * 2_000_000), (1, 1, "assistant", "y" * 3_000_000), (2, 5, "user", " " * 10 + "\n")]
    compare(repair(damaged(spark.createDataFrame(rows, SCHEMA))), rows)
