"""Repair against a plain search of all edits, chunks of a few rows, runs, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from ledgerproof.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, pos string, symbol int"


def damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def plain(conv, rows):
    """Best (cost, audit) by following every edit, state by state."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    next_, name = {"": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}
    for row, fault in zip([*rows, None], [*faults, None]):
        for _ in range(3):  # inserts
            for s, (cost, audit, out) in list(best.items()):
                to = next_[s]
                way = (cost + 5, audit + "I", (*out, f"{name[to]}:"))
                best[to] = min(best.get(to, way), way)
        if row is None:
            break
        new = {}
        for s, (cost, audit, out) in best.items():
            ways = [(s, (cost + 2, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                more, role = (5 if fault else 0), row[2][:1]
                if role == next_[s] or (role == "s" and s == ""):
                    ways.append((role, (cost + more, audit + "K", (*out, f"{row[2]}:{row[3]}"))))
                ways.append((next_[s], (cost + 1 + more, audit + "R", (*out, f"{name[next_[s]]}:{row[3]}"))))
            for to, way in ways:
                new[to] = min(new.get(to, way), way)
        best = new
    cost, audit, out = min(best[s] for s in ("", "a") if s in best)
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def want(rows):
    hurt = damage(rows)
    return sorted([plain(c, [r for r in hurt if r[0] == c]) for c in {r[0] for r in rows}], key=repr)


def rows_of(rng, convs, longest):
    out = []
    for c in range(convs):
        for t in range(rng.randrange(1, longest)):
            out.append((c, rng.choice([t, t, t, t + 3, None]) if rng.random() < 0.2 else t,
                        rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][t % 2] if t or rng.random() < 0.7 else "system",
                        rng.choice(["Fine.", f"Text {t}!", "Cut", " \t", "", "Is it? \n", None, f"Long. {rng.random()}."]), "p", 1))
    return out


@pytest.mark.parametrize("chunk", [C.CHUNK, 3])
def test_repair_equals_plain_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK", chunk)
    rng = random.Random(11)
    rows = rows_of(rng, 120, 14)
    rows += [(None, None, None, None, "", 0), (None, 1, "user", "A.", "", 0), (None, 2, "assistant", "B.", "", 0), (500, 1, "tool", "x.", "", 0),
             (501, 1, "", "x.", "", 0), (501, 2, "Über", "é.", "", 0), (502, -5, "user", "q" * 1_000_000 + ".", "", 0), (502, -1, "assistant", "ok.", "", 0)]
    rows += [(600, t, "user", f"u{t}." if t % 9 else "u", "", 0) for t in range(300)]  # one long run
    assert sorted(map(tuple, C.digest(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()), key=repr) == want(rows)


def test_all_rows_lost_and_empty_table(spark):
    lost = next((c, 1) for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows = [(*lost, "user", "Gone.", "", 0)]
    nothing = hashlib.sha256(b"").hexdigest()
    frame = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in C.digest(frame).collect()] == [(lost[0], 0, 0, 0, 0, 0, 0, "", nothing)] == want(rows)
    assert C.digest(frame.limit(0)).count() == 0


def test_powers_are_steps():
    rng = random.Random(2)
    for _ in range(30):
        symbols = "".join(rng.choice(C.SYMBOLS) * rng.randrange(1, 20) for _ in range(4))
        slow = C.ending()
        for s in reversed(symbols):
            slow = C.through(C._power(s, 0), slow)
        assert (C.through(C.product(symbols), C.ending()) == slow).all()
        assert sum(n for _, n in C.runs(symbols)) == len(symbols)


def test_repaired_rows_are_legal(spark):
    rows = C.damaged(spark.createDataFrame(rows_of(random.Random(4), 40, 9), SCHEMA))
    got = {}
    for r in sorted(C.repaired(rows).collect(), key=lambda r: (r.conv_id, r.place)):
        got.setdefault(r.conv_id, []).append(r)
    assert got
    for lines in got.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in lines)) and [r.place for r in lines] == list(range(len(lines)))
