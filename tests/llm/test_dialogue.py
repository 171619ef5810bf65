"""Conversation repair against plain Python that keeps every state's least (cost, audit) message by message."""

import hashlib
import random
import re

import pytest

from riskloom.llm import dialogue
from riskloom.llm.queries import damaged
from riskloom.session import run_dir

SCHEMA = "conv_id long, turn long, role string, text string, part string, Seq int, rows int, whole int, number int, tag int"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.rstrip(BLANKS)
        kind = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(kind)
    return out


def brute(rows):
    """(cost, audit, repaired) of the cheapest repair with the least audit."""
    ways = {"": (0, "", ())}

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit, out) in list(ways.items()):
                to = NEXT[state]
                way = (cost + 2, audit + "I", (*out, NAMES[to] + ":"))
                ways[to] = min(ways.get(to, way), way)
        return ways

    for (role, text), kind in zip(rows, faults(rows), strict=True):
        new = {}

        def put(state, way, new=new):
            new[state] = min(new.get(state, way), way)

        extra = int(kind == "truncated")
        for state, (cost, audit, out) in inserted(dict(ways)).items():
            put(state, (cost + 3, audit + "D", out))
            if kind not in ("blank", "duplicate"):
                to = NEXT[state]
                put(to, (cost + 2 + extra, audit + "R", (*out, f"{NAMES[to]}:{text}")))
                if role[:1] == to or role[:1] == "s" and state == "":
                    put(role[:1], (cost + extra, audit + "K", (*out, f"{role}:{text}")))
        ways = new
    closed = inserted(dict(ways))
    return min(way for way in (ways.get(""), closed.get("a")) if way)


def expected(rows):
    blank = " "
    rows = [(t, blank if r is None else r, blank if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    said = [(r, x) for _, r, x in rows]
    kinds = faults(said)
    turns = {t for t, *_ in rows if t is not None}
    cost, audit, out = brute(said)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(said, said[1:], strict=False)]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def made(rng, n, hot=False):
    turns = [None if rng.random() < 0.05 else rng.randrange(2 * n) for _ in range(n)]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No", "", " \n", None, "Why? ", "été\x0b", "a!"]
    if not hot:
        texts += [f"text {k}{rng.choice(['.', '', '?'])}" for k in range(2 * n)]
    return [(t, rng.choice(roles[: rng.choice([3, 8])]), rng.choice(texts)) for t in turns]


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(7)
    out = {i: made(rng, rng.randrange(1, 9)) for i in range(150)}
    out[None] = made(rng, 5)
    out[1000] = made(rng, 2600)  # more than two pieces
    out[1001] = [(3, "user", "same.")] * 1500
    out[1002] = made(rng, 1300, hot=True)
    out[1003] = [(0, "user", "x" * 5_000_000 + "."), (1, "assistant", "y" * 100), (2, "user", "z" * 5_000_000)]
    out[1004] = [(1, "user", "Hi."), (9_000_000_000_000_000_000, "assistant", "Yes."), (-9_000_000_000_000_000_000, "system", "Be.")]
    return out


def test_plain_python(spark, conversations):
    rows = [(c, *r, "own", 1, 2, 3, 4, 5) for c, rs in conversations.items() for r in rs]
    random.Random(1).shuffle(rows)
    place = run_dir(spark, "test-dialogue")
    pieces = dialogue.repair(spark.createDataFrame(rows, SCHEMA).repartition(5), place)
    found = {r["conv_id"]: tuple(r)[1:] for r in dialogue.digest(pieces, place).collect()}
    want = {c: expected(rs) for c, rs in conversations.items()}
    want[1004] = ((1 << 63) - 1, *want[1004][1:])
    assert set(found) == set(want)
    assert {c: (found[c], want[c]) for c in want if found[c] != want[c]} == {}
    kept = spark.read.parquet(f"{place}/repaired")
    assert kept.where("conv_id = 1000").count() > 2 and kept.where("whole").count() > 100
    told = {}
    for r in kept.where("conv_id < 200").orderBy("conv_id", "part", "seq").collect():
        told.setdefault(r["conv_id"], []).extend(m["role"][:1] for m in r["messages"])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(m)) for m in told.values())


def test_any_crossing_is_the_least_way():
    rng = random.Random(2)
    for _ in range(300):
        rows = [("sua?"[rng.randrange(4)], rng.choice(["a", "b.", "", "c!"]) + str(rng.randrange(9)) * rng.randrange(2)) for _ in range(rng.randrange(12))]
        kinds = {"": dialogue.FINE, "truncated": dialogue.TRUNCATED, "blank": dialogue.BLANK, "duplicate": dialogue.DUPLICATE}
        codes = dialogue._codes([r for r, _ in rows], [kinds[k] for k in faults(rows)])
        words, end = dialogue.solve(codes)
        assert "".join(words) + dialogue.END_WORD[end] == brute(rows)[1]
        # The same through pieces, each of them a step.
        cut = sorted(rng.choices(range(len(codes) + 1), k=3))
        parts = [codes[a:b] for a, b in zip([0, *cut], [*cut, len(codes)], strict=True) if a < b]
        steps = [dialogue.as_step(dialogue.matrix(p)) for p in parts]
        if steps:
            path = dialogue.crossings(steps, dialogue.START, dialogue.best_end(steps))
            again = [w for p, a, b in zip(parts, path, path[1:], strict=False) for w in dialogue.words_between(p, a, b)]
            assert (again, path[-1]) == (words, end)


def test_empty_table_and_damage(spark):
    none = spark.createDataFrame([], SCHEMA)
    place = run_dir(spark, "test-dialogue")
    assert dialogue.digest(dialogue.repair(none, place), place).count() == 0
    assert damaged(none).count() == 0
    rows = spark.createDataFrame([(i, i, "system", "A. b? c!") for i in range(300)], "conv_id long, turn long, role string, text string")
    found = damaged(rows).collect()
    assert {r["text"] for r in found} == {"", "A b c", "A. b? c!"} and {r["role"] for r in found} == {"system", "user"}
    counts = [sum(r["conv_id"] == i for r in found) for i in range(300)]
    assert set(counts) == {0, 1, 2}
