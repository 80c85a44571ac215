"""Conversation repair against a plain search over all edits."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from starloom.llm import registry, repair
from starloom.llm.common import table

MEDIUM = "/root/testdata/sf0.01"
EMPTY_HASH = hashlib.sha256(b"").hexdigest()
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        out[conv]  # every conversation is reported
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def after(state, initial):
    """State behind a turn, None if it can't come: nothing, s, u or a read last."""
    legal = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    return initial if (state, initial) in legal else None


def plain_repair(rows, faults):
    """(cost, audit, lines) by search over all edits, two insertions anywhere."""
    best = {"": (0, "", ())}

    def offer(table, state, way):
        if state is not None and (state not in table or way[:2] < table[state][:2]):
            table[state] = way

    def inserted(table):
        out = dict(table)
        for _ in range(2):
            for state, (cost, audit, lines) in list(out.items()):
                for role in ("user", "assistant"):
                    offer(out, after(state, role[0]), (cost + 2, audit + "I", (*lines, f"{role}:")))
        return out

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for state, (cost, audit, lines) in inserted(best).items():
            offer(new, state, (cost + 3, audit + "D", lines))
            if fault in ("b", "d"):
                continue
            extra = int(fault == "t")
            if role:
                offer(new, after(state, role[0]), (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            for other in ("user", "assistant"):
                offer(new, after(state, other[0]), (cost + 2 + extra, audit + "R", (*lines, f"{other}:{text}")))
        best = new
    ends = inserted(best)
    return min(ends[s] for s in ("", "a") if s in ends)


def plain_report(rows):
    out = {}
    for conv, own in plain_damage(rows).items():
        if not own:
            out[conv] = (0, 0, 0, 0, 0, 0, "", EMPTY_HASH)
            continue
        faults = faults_of(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = plain_repair(own, faults)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(x) for x in "bdt"), illegal, cost, audit, digest)
    return out


def report(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def tuples(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def messy(n, seed, conversations):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "so", "  ", "", None, "What?\n", "a. b", "ok ."]
    return [
        (
            rng.choice(conversations),
            rng.choice([None, *range(n // 2)]),
            rng.choices(roles, [6, 6, 2, 1, 1, 1])[0],
            rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(n)}" + rng.choice([".", ""]),
        )
        for _ in range(n)
    ]


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_against_plain_search(spark):
    rows = tuples(table(spark, MEDIUM, "conversations"))
    assert report(registry.QUERIES["op11_conversation_repair"](spark, MEDIUM)) == plain_report(rows)


@pytest.mark.parametrize("split", [True, False])
def test_messy_rows(spark, split):
    """Nulls anywhere, ties, repeats; conversations inside a range, and over many."""
    rows = messy(600, 1, [7]) + messy(900, 2, [None, *range(40, 160)]) + [(300 + i, i, "user", "Hi.") for i in range(60)]
    rows += rows[:200]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, str(not split).lower())
    try:
        df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", fault int, tie string")
        found, edits = repair.repair(df)
        expected = plain_report(rows)
        assert any(v[-1] == EMPTY_HASH for v in expected.values())
        assert report(found) == expected
        # The edits hold the repaired turns.
        lines = collections.defaultdict(list)
        for r in sorted(edits.collect(), key=lambda r: (r["part"], r["at"])):
            lines[r["conv_id"]] += repair.lines_of(r["roles"], r["role"] or "", r["text"] or "", r["edit"][-1] in "KR")
        for conv, own in lines.items():
            assert hashlib.sha256("\n".join(own).encode()).hexdigest() == expected[conv][-1]
    finally:
        spark.conf.set(name, before)


def test_halves_meet_like_one_whole():
    rng = random.Random(9)
    for _ in range(300):
        rows = [(rng.choice(["s", "u", "a", "x"]), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 24))]
        elements = [repair.moves_of(*r) for r in rows]
        way = repair.solve(elements, 0, list(repair.ENDING))
        audit = "".join(repair.edit(m)[0] for m in way) + repair.ending_of(way[-1][1])[0]
        plain = [(0, role, f"t{i}") for i, (role, _) in enumerate(rows)]
        cost, expected, _ = plain_repair(plain, ["" if not f else "bdt"[f - 1] for _, f in rows])
        assert (sum(m[2] for m in way) + repair.ENDING[way[-1][1]], audit) == (cost, expected)
        # Any cut into segments gives the same states.
        cut = sorted({0, len(rows), *(rng.randrange(len(rows)) for _ in range(3))})
        segments = [repair.summary(elements[a:b]) for a, b in zip(cut, cut[1:])]
        chain = repair.solve(segments, 0, list(repair.ENDING))
        assert [m[0] for m in chain] == [way[a][0] for a in cut[:-1]]


def test_no_rows(spark):
    found, edits = repair.repair(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and edits.count() == 0


def test_long_texts_and_undamaged_rows(spark):
    rows = [(1, 1, "user", "word " * 200_000 + "."), (1, 2, "assistant", "x" * 300_000), (1, 3, "user", "Thanks.")]
    found, _ = repair.repair(spark.createDataFrame(rows, SCHEMA), damage=False)
    assert [r["audit"] for r in found.collect()] == ["KKKI"]
