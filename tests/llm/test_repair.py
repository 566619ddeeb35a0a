"""Conversation repair against an exhaustive search over states of the grammar."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from granary.llm import repair

SCHEMA = "conv_id long, turn int, role string, text string, gone string, fault string, digest string, seg string, cost string"
WHITE = "\x20\x09-\x0d"


def search(rows):
    """(cost, audit) of rows of (initial, must go, truncated), by trying every edit."""

    @functools.cache
    def best(i, state):
        want = "a" if state == "u" else "u"
        options = []
        if i == len(rows) and state in "0a":
            options.append((0, ""))
        if i < len(rows):
            initial, must_go, cut = rows[i]
            after = best(i + 1, state)
            options.append((after[0] + 2, "D" + after[1]))
            if not must_go:
                if initial == want or (state == "0" and initial == "s"):
                    after = best(i + 1, initial)
                    options.append((after[0] + 5 * cut, "K" + after[1]))
                after = best(i + 1, want)
                options.append((after[0] + 1 + 5 * cut, "R" + after[1]))
        # Two insertions in a row never pay but from nothing or "s" at the end.
        for added in (1, 2):
            s = state
            for _ in range(added):
                s = "a" if s == "u" else "u"
            tail = (0, "") if i == len(rows) and s == "a" else step(i, s) if i < len(rows) else None
            if tail:
                options.append((5 * added + tail[0], "I" * added + tail[1]))
        return min(options)

    @functools.cache
    def step(i, state):
        """As ``best``, but the next edit is no insertion."""
        want = "a" if state == "u" else "u"
        initial, must_go, cut = rows[i]
        after = best(i + 1, state)
        options = [(after[0] + 2, "D" + after[1])]
        if not must_go:
            if initial == want or (state == "0" and initial == "s"):
                after = best(i + 1, initial)
                options.append((after[0] + 5 * cut, "K" + after[1]))
            after = best(i + 1, want)
            options.append((after[0] + 1 + 5 * cut, "R" + after[1]))
        return min(options)

    return best(0, "0")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(rows, hurt=damage):
    convs = {}
    for conv, *_ in rows:
        convs[conv] = []
    for conv, turn, role, text in hurt(rows):
        convs[conv].append((turn is not None, turn or 0, role, text, turn))
    out = []
    for conv, turns in convs.items():
        turns = [(t[4], t[2], t[3]) for t in sorted(turns, key=lambda t: t[:4])]
        seen, faults = set(), []
        for _, role, text in turns:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
            seen.add((role, text))
        known = [t for t, *_ in turns if t is not None]
        initials = [r[:1] for _, r, _ in turns]
        cost, audit = search(tuple((c, f in ("blank", "duplicate"), f == "truncated") for c, f in zip(initials, faults, strict=True))) if turns else (0, "")
        lines, i, state = [], 0, "0"
        for letter in audit:
            if letter != "D":
                state = initials[i] if letter == "K" else "a" if state == "u" else "u"
                role = turns[i][1] if letter == "K" else {"u": "user", "a": "assistant"}[state]
                lines.append(f"{role}:{'' if letter == 'I' else turns[i][2]}")
            i += letter != "I"
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out.append((
            conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def talk(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            role = rng.choice(["system", "tool", "", "User", None]) if rng.random() < 0.15 else ["user", "assistant"][t % 2]
            rows.append((c - 3, t + rng.randrange(2), role, rng.choice(["a.", "b!", "c?", "d", " ", None, f"{t} end.\n", f"{t}. e"])))
    return rows


AWKWARD = [
    (1, 0, "user", "hi."), (1, None, "system", "be."), (1, None, None, None), (2, 5, "user", "hi."), (2, 5, "user", "hi."), (2, 5, "user", "hi."),
    (3, 1, "assistant", "x. "), (3, 9, "assistant", "y.\x0b\x0c"), (4, 0, "", ""), (5, 0, "superb", "s."), (5, 1, "util", "u!"), (5, 2, "a", "a?"),
    (None, 0, "user", "n."), (None, None, "assistant", "n."), (6, 3, "user", "long " * 60_000 + "."), (6, 4, "assistant", "ü "),
    (7, 0, "ünser", "."), (8, 0, "user", "a\nb."), (8, 1, "assistant", "."), (9, 2, "system", "only."), (-4, 1, "user", "a."), (-4, 1, "assistant", "b."),
]


def test_awkward_rows(spark):
    assert got(repair.repaired(repair.damaged(frame(spark, AWKWARD)))) == brute(AWKWARD)
    assert got(repair.repaired(repair.damaged(frame(spark, [])))) == []


def test_many_conversations(spark):
    rows = talk(1, 150, 12)
    assert got(repair.repaired(repair.damaged(frame(spark, rows)))) == brute(rows)


def test_long_conversations_are_cut(spark, monkeypatch):
    """One conversation with most rows, over several partitions and segments."""
    monkeypatch.setattr(repair, "ROWS", 7)
    rng = random.Random(5)
    rows = talk(2, 20, 30) + [(100, None if t < 5 else t // 2, rng.choice(["user", "assistant", "system"]), f"{t % 9} {rng.choice('.!x')}") for t in range(150)]
    assert got(repair.repaired(repair.damaged(frame(spark, rows)))) == brute(rows)


@pytest.mark.parametrize("longest", [6, 40, 120])
def test_alignment_is_cheapest_and_least(longest):
    rng = random.Random(longest)
    for _ in range(300 if longest < 100 else 60):
        codes = "".join(rng.choices("suaxSUAXd", [1, 6, 6, 1, 1, 1, 1, 1, 2], k=rng.randrange(0, longest)))
        rows = tuple((c.lower(), c == "d", c.isupper()) for c in codes)
        assert repair.align(codes)[:2] == search(rows), codes


def test_segments_chain_to_the_whole():
    rng = random.Random(9)
    for _ in range(100):
        codes = "".join(rng.choices("suaxSUAXd", [1, 6, 6, 1, 1, 1, 1, 1, 2], k=rng.randrange(2, 60)))
        size = rng.randrange(1, 20)
        parts = [codes[i : i + size] for i in range(0, len(codes), size)]
        finals = [{"0": 0, "a": 0}]
        for k in reversed(range(len(parts))):
            matrix = repair.costs(parts[k], k == len(parts) - 1)
            ahead = {s: min(matrix[4 * p + repair.STATES.index(e)] + c for e, c in finals[0].items()) for p, s in enumerate(repair.STATES)}
            finals.insert(0, {s: c for s, c in ahead.items() if c < repair._NONE})
        audit, state = "", "0"
        for k, part in enumerate(parts):
            _, letters, state = repair.align(part, state, finals[k + 1], k == len(parts) - 1)
            audit += letters
        assert (finals[0]["0"], audit) == repair.align(codes)[:2], codes
