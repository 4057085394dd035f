"""Conversation repair against an exhaustive search over edits, on small and odd tables."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from varlake.llm import repair
from varlake.llm.queries import op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"


def errors(rows):
    """Rows (conv, turn, role, text) after damage, as the task says it."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def legal(initials):
    return re.fullmatch("(s?(ua)+)?", "".join(initials)) is not None


def prefix(initials):
    return any(legal([*initials, *more]) for n in range(3) for more in itertools.product("ua", repeat=n))


def cheapest(rows, faults):
    """Cost, audit and repaired lines by a search over all edits, cheapest and least audit first."""
    heap, seen = [(0, "", 0, ())], set()
    while heap:
        cost, audit, at, kept = heapq.heappop(heap)
        initials = tuple(line[:1] if not line.startswith(":") else "-" for line in kept)
        if at == len(rows) and legal(initials):
            return cost, audit, kept
        if (at, initials[-1:], len(kept) > 0) in seen:
            continue
        seen.add((at, initials[-1:], len(kept) > 0))
        steps = [(2, "I", at, f"{r}:") for r in ("user", "assistant")]
        if at < len(rows):
            role, text = rows[at][2:]
            steps.append((3, "D", at + 1, None))
            if faults[at] not in ("blank", "duplicate"):
                late = faults[at] == "truncated"
                steps += [(late, "K", at + 1, f"{role}:{text}"), *((2 + late, "R", at + 1, f"{r}:{text}") for r in ("user", "assistant"))]
        for more, edit, to, line in steps:
            if line is None or prefix([*initials, line[:1] if not line.startswith(":") else "-"]):
                heapq.heappush(heap, (cost + more, audit + edit, to, kept if line is None else (*kept, line)))


def expected(rows):
    own = {}
    for row in errors(rows):
        own.setdefault(row[0], []).append(row)
    for conv in {r[0] for r in rows}:
        mine = sorted(own.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in mine if r[1] is not None}
        cost, audit, lines = cheapest(mine, faults)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        yield (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def check(spark, rows, tmp_path, more=()):
    df = spark.createDataFrame([(*r, *("x" for _ in more)) for r in rows], SCHEMA + "".join(f", {m} string" for m in more))
    df.repartition(5).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in op11_conversation_repair(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(expected(rows), key=repr)
    return got


def test_repair_against_search(spark, tmp_path):
    rng = random.Random(11)
    texts = ["Yes.", "No!", "cut off", "", " \t", None, "Why?  \n", "é.", "ends  ", "a.b"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "ünknown", "sage"]
    rows = [(c, t, rng.choice(roles[: rng.choice([2, 3, 10])]), rng.choice(texts)) for c in range(150) for t in range(rng.randint(1, 7))]
    rows += [(c, None if rng.random() < 0.3 else rng.randint(0, 3), rng.choice(roles), rng.choice(texts)) for c in range(200, 230) for _ in range(4)]  # ties and null turns
    rows += [(None, t, "user", "Null id.") for t in (4, None, 9, 4)]
    rows += rows[:40]  # repeated rows
    got = check(spark, rows, tmp_path, more=("digest", "word", "kind"))
    assert len({r[7] for r in got}) > 40


def test_repair_edges(spark, tmp_path):
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    long = "word " * 300_000
    got = {r[0]: r for r in check(spark, [(gone, 0, "user", "All that there was."), (1, 1, "user", long + "end."), (1, 2, "assistant", long), (2, None, None, None)], tmp_path)}
    assert got[gone][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert check(spark, [], tmp_path) == []


def test_repair_long_conversation(spark):
    """Far more turns than a batch, in one conversation."""
    rows = [(5, t, ("user", "assistant")[t % 2 if t % 1000 else 1], f"Turn {t}.") for t in range(30_000)]
    repairs, turns = repair.repair(spark.createDataFrame(rows, SCHEMA), damage=False)
    found = repairs.first()
    assert found.audit.count("K") + found.audit.count("R") + found.audit.count("D") == 30_000 and found.cost == 2 * 30
    roles = [r.role for r in turns.collect()]
    assert roles[0] == "user" and all(a != b for a, b in zip(roles, roles[1:])) and len(roles) % 2 == 0


def test_suffixes_share_nodes():
    """Nodes are made once for each distinct suffix, and give what a fresh automaton gives."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(0, 9))) + "uaua" * rng.randint(0, 3) for _ in range(500)}, key=lambda w: w[::-1])
    automaton = repair.Suffixes()
    for word in words:
        assert automaton.solve(word) == repair.Suffixes().solve(word)
    assert automaton.made == len({w[i:] for w in words for i in range(len(w) + 1)})
    assert len(automaton._known) < 200  # classes of nodes, however many words


@pytest.mark.parametrize("word, cost, audit", [("", 0, ""), ("s", 3, "D"), ("ua", 0, "KK"), ("sua", 0, "KKK"), ("u", 2, "KI"), ("a", 2, "IK"), ("x", 3, "D"), ("uu", 2, "KR"), ("Ua", 1, "KK")])
def test_short_words(word, cost, audit):
    assert repair.Suffixes().solve(word) == (cost, audit)
