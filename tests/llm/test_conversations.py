import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import conversations as C
from tidemark.llm.grammar import Walk, chosen, matrices

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, audit int, n string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def sha(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        lot = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(conv, turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def automaton(initial, state):
    return {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(initial, {}).get(state)


def cheapest(rows):
    """Rows (initial, has to go, truncated): plain search over the edits one by one, all states kept with whole strings."""
    insert = lambda table: _closure(table)
    table = insert({0: (0, "", [])})
    for initial, go, cut in rows:
        now = {}
        for state, (cost, word, made) in table.items():
            ways = [(state, 2, "D", None)]
            if not go:
                more = 5 if cut else 0
                ways += [(automaton(initial, state), more, "K", initial)] + [(automaton(x, state), 1 + more, "R", x) for x in "ua"]
            for end, c, letter, x in ways:
                if end is not None:
                    found = (cost + c, word + letter, [*made, (letter, x)])
                    now[end] = min(now.get(end, found), found, key=lambda f: f[:2])
        table = insert(now)
    return min((table[s] for s in (0, 3) if s in table), key=lambda f: f[:2])


def _closure(table):
    table = dict(table)
    for _ in range(3):
        for state, (cost, word, made) in list(table.items()):
            for x in "ua":
                end = automaton(x, state)
                if end is not None:
                    found = (cost + 5, word + "I", [*made, ("I", x)])
                    table[end] = min(table.get(end, found), found, key=lambda f: f[:2])
    return table


def by_hand(rows):
    convs = defaultdict(list)
    for r in damaged(rows):
        convs[r[0]].append(r)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(convs[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha(r[2], r[3])))
        seen, kinds = set(), []
        for _, _, role, text in mine:
            said = text.strip(" \t\n\x0b\x0c\r")
            kinds.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in mine if r[1] is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(mine)]
        cost, audit, made = cheapest([(r[2][:1], k in ("blank", "duplicate"), k == "truncated") for r, k in zip(mine, kinds)])
        left, at = [], iter(mine)
        for letter, x in made:
            full = {"u": "user", "a": "assistant"}.get(x)
            if letter == "I":
                left.append(f"{full}:")
                continue
            row = next(at)
            if letter != "D":
                left.append(f"{row[2] if letter == 'K' else full}:{row[3]}")
        initials = "".join(x[:1] for x in left)
        assert LEGAL.match(initials)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest(),
        )
    return out


def make(n, dice):
    rows = []
    for conv in range(n):
        order = dice.choice(["sua", "ua", "uua", "au", "uaua", "suaa"])
        for turn in range(dice.randint(1, 14)):
            role = {"s": "system", "u": "user", "a": "assistant"}[order[turn % len(order)]]
            text = dice.choice(["Yes.", "No!", "so", " ", "", "It was {}. ", "What {}?\n", "{} and", "ü{}."]).format(dice.randrange(9))
            rows.append((conv, turn + dice.choice([0, 0, 0, 0, 1]) if dice.random() < 0.9 else None, dice.choice([role] * 9 + ["tool", None]), dice.choice([text] * 9 + [None])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


def digest(spark, rows):
    df = frame(spark, rows)
    got = C.digests(df, C.damage(df))
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[c] for c in columns) for r in got.collect()}


def test_damaged_conversations(spark):
    dice = random.Random(4)
    rows = make(160, dice) + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 3, "assistant", "So.")]
    rows += [(500, t, "user", "again.") for t in range(30)] + [(501, None, "assistant", "no turn")] * 3
    rows += [(600, t, *[("user", f"Q{t}?"), ("assistant", f"A{t}.")][t % 2]) for t in range(300)]
    assert digest(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("block,rounds", [(3, 2), (3, 0), (4096, 1)])
def test_blocks_and_rules_change_nothing(spark, monkeypatch, block, rounds):
    monkeypatch.setattr(C, "ROUNDS", rounds)
    monkeypatch.setattr(C, "BLOCK", block)
    rows = make(40, random.Random(block)) + [(70, t % 5, "user", "same.") for t in range(40)]
    assert digest(spark, rows) == by_hand(rows)


def test_every_short_sequence():
    rules = [(chr(256), "u", "a"), (chr(257), "x", "x"), (chr(258), chr(256), chr(256)), (chr(259), "A", "o"), (chr(260), chr(258), "s")]
    table = matrices(rules)
    for n in range(5):
        for word in itertools.product("suaoSAx", repeat=n):
            seq = "".join(word)
            for symbol, a, b in rules:
                seq = seq.replace(a + b, symbol)
            walk = Walk(table)
            walk.take(seq)
            assert walk.end() == cheapest([(c.lower(), c == "x", c.isupper()) for c in word])[:2], word


def test_long_sequences_through_deep_rules():
    dice = random.Random(9)
    for _ in range(30):
        word = "".join(dice.choice("suaoSUAOxuaua") for _ in range(200))
        seq, rules = word, []
        for i in range(40):
            at = dice.randrange(len(seq) - 1)
            symbol = chr(256 + i)
            rules.append((symbol, seq[at], seq[at + 1]))
            seq = seq.replace(seq[at : at + 2], symbol)
        walk = Walk(matrices(rules))
        walk.take(seq)
        assert walk.end() == cheapest([(c.lower(), c == "x", c.isupper()) for c in word])[:2]


def test_chosen_pairs_do_not_overlap():
    assert chosen([("ab", 9), ("bc", 8), ("cd", 7), ("ad", 6), ("ee", 5), ("ef", 4)], 9) == ["ab", "cd", "ad", "ee"]


def test_repair_returns_rows(spark):
    rows = [(1, 0, "user", "Why?"), (1, 1, "user", "Why not?"), (1, 2, "assistant", "So."), (2, 0, "assistant", "Hello."), (2, 1, "user", "Yes.")]
    got = C.repair(frame(spark, rows)).orderBy("conv_id", "no").collect()
    assert [(r["conv_id"], r["turn"], r["role"], r["text"], r["edit"]) for r in got] == [
        (1, 1, "user", "Why not?", "K"), (1, 2, "assistant", "So.", "K"), (2, 0, "user", "Hello.", "R"), (2, 1, "assistant", "Yes.", "R"),
    ]
    none = frame(spark, []) if False else spark.createDataFrame([], SCHEMA)
    assert C.repair(none).count() == 0 and C.digests(none, C.damage(none)).count() == 0
