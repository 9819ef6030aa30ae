from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import pytest

from corpusloom.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, signature string, audit int, _turn int, gone string"
ROLES = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}


LEGAL_SO_FAR = re.compile("s?(ua)*u?")


def all_edits(signature: str, together: int = 2) -> dict[str, int]:
    """Every edit string that gives a legal conversation with up to so many insertions side by side, with its least cost."""
    out: dict[str, int] = {}

    def walk(i: int, roles: str, cost: int, audit: str, inserted: int):
        if not LEGAL_SO_FAR.fullmatch(roles):
            return
        if i == len(signature) and re.fullmatch("(s?(ua)+)?", roles):
            out[audit] = min(cost, out.get(audit, cost))
        if inserted < (2 if i == len(signature) else together):
            for r in "ua":
                walk(i, roles + r, cost + 2, audit + "I", inserted + 1)
        if i == len(signature):
            return
        symbol = signature[i]
        walk(i + 1, roles, cost + 3, audit + "D", 0)
        if symbol != "x":
            extra = symbol.isupper()
            walk(i + 1, roles + symbol.lower(), cost + extra, audit + "K", 0)
            for r in "ua":
                walk(i + 1, roles + r, cost + 2 + extra, audit + "R", 0)

    walk(0, "", 0, "", 0)
    return out


def test_the_trie_gives_the_cheapest_edits_of_all():
    signatures = ["".join(s) for n in range(3) for s in itertools.product(conversations.SYMBOLS, repeat=n)]
    signatures += ["".join(s) for s in itertools.product("xsuaO", repeat=3)] + ["suau", "aauu", "UaxA", "ssxA", "oosO", "xsau"]
    got = {s: (c, a) for s, c, a in conversations.walk_trie(iter(sorted(signatures)))}
    for s in signatures:
        assert got[s] == min((c, a) for a, c in all_edits(s).items()), s


def test_layers_of_a_shared_prefix_are_computed_once(monkeypatch):
    calls, plain = [], conversations.next_layer
    monkeypatch.setattr(conversations, "next_layer", lambda layer, symbol: calls.append(symbol) or plain(layer, symbol))
    found = list(conversations.walk_trie(iter(sorted(["sua" * 40 + x for x in ("", "u", "ua", "x")]))))
    assert len(found) == 4 and len(calls) == 120 + 1 + 1 + 1


def test_long_signatures_take_one_layer_a_turn():
    (_, cost, audit), *_ = conversations.walk_trie(iter(["s" + "ua" * 20_000]))
    assert cost == 0 and audit == "K" * 40_001


def brute(rows: list[tuple]) -> dict:
    """The contract, row by row; every row is (conv_id, turn, role, text)."""
    turns: dict = {}
    for conv, turn, role, text in rows:
        mine = turns.setdefault(conv, [])
        text, role = " " if text is None else text, " " if role is None else role
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, mine in turns.items():
        mine.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, signature, counts = set(), "", [0, 0, 0]
        for _, role, text in mine:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 1 if not ink else 2 if (role, text) in seen else 3 if ink[-1] not in ".!?" else 0
            seen.add((role, text))
            if fault:
                counts[fault - 1] += 1
            symbol = role[:1] if role[:1] in ("s", "u", "a") else "o"
            signature += "x" if fault in (1, 2) else symbol.upper() if fault else symbol
        cost, audit = min((c, a) for a, c in all_edits(signature, 1).items())
        known = [t for t, *_ in mine if t is not None]
        lines, rest = [], iter(mine)
        for letter in audit:
            expected = "assistant" if lines and lines[-1][0][:1] == "u" else "user"
            role, text = (expected, "") if letter == "I" else next(rest)[1:]
            if letter != "D":
                lines.append((role if letter == "K" else expected, text))
        body = "\n".join(f"{r}:{t}" for r, t in lines)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest(), lines)
    return out


def awkward() -> list[tuple]:
    texts = ["Fine.", "fine, no end", "", " \n\t", None, "Why?", "Ends with dots... \n", "a\u0085", "é!", "Fine."]
    out = [(c, t, ROLES["uasuo"[(c * 3 + t) % 5]], texts[(c + 2 * t) % 10]) for c in range(60) for t in range(c % 5)]
    out += [(100, None, "user", "Hi."), (100, 3, None, "Mid."), (100, 3, "assistant", "Mid."), (100, 9, "assistant", "x" * 200_000)]
    out += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yo."), (101, None, None, None), (102, 5, "", ""), (103, -4, "User", "A."), (103, 1, "assistant", "B.")]
    return out + [(104, 1, "user", "Hi.")] * 3 + [(104, 2, "assistant", "So.")]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


def test_repair_matches_brute_force(spark):
    turns = conversations.damage(table(spark, awkward()))
    repaired = conversations.repair(turns)
    want = brute(awkward())
    got = conversations.digests(turns, repaired).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id][:-1], r
    lines: dict = {c: [] for c in want}
    for r in sorted(conversations.repaired_turns(turns, repaired).collect(), key=lambda r: r.n):
        lines[r.conv_id].append((r.role, r.text))
    assert lines == {c: w[-1] for c, w in want.items()}


def test_dropped_conversations_and_empty_tables(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    turns = conversations.damage(table(spark, [(gone, 1, "user", "Hi.")]))
    (row,) = conversations.digests(turns, conversations.repair(turns)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = conversations.damage(table(spark, []))
    assert conversations.digests(turns, conversations.repair(turns)).collect() == []
    assert conversations.repaired_turns(turns, conversations.repair(turns)).collect() == []


@pytest.mark.parametrize("share", [2, 1024])
def test_a_frequent_signature_is_joined_whole(spark, share):
    from corpusloom.llm.common import durable, join_frequent

    left = durable(spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(90)] + [(91, None)], "n int, k string"))
    right = spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, v int")
    got = sorted((r.n, r.v) for r in join_frequent(left, right, "k", share).collect())
    assert got == sorted([(i, 1) for i in range(90) if i % 3] + [(3, 2)])
