import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from refinery.llm import queries, turns
from tests.llm.helpers import words

WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, audit) over all edits that give a sound conversation; rows are (initial, must go, truncated)."""
    n = len(rows)

    @lru_cache(None)
    def best(i, roles, spent):
        """Least (cost, audit) of the rest, with the roles put out so far as their grammar state and insertions in a row."""
        found = []
        if i == n and roles in ("", "a"):
            found.append((0, ""))
        want = "a" if roles == "u" else "u"
        if spent < 2:  # three insertions in a row are never cheapest: two of them can go
            c, a = best(i, want, spent + 1)
            found.append((c + 5, "I" + a))
        if i < n:
            initial, gone, cut = rows[i]
            c, a = best(i + 1, roles, 0)
            found.append((c + 2, "D" + a))
            if not gone:
                for target in [want] + (["s"] if roles == "" else []):
                    c, a = best(i + 1, target, 0)
                    if initial == target:
                        found.append((c + 5 * cut, "K" + a))
                    elif target != "s":
                        found.append((c + 1 + 5 * cut, "R" + a))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


def plainly(table):
    """The contract, conversation by conversation."""
    out = {}
    blank = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in table:
        rows = out.setdefault(conv, [])
        role, text = blank(role), blank(text)
        fate = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        rows += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    told = []
    for conv, rows in out.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{r[1]}\0{r[2]}".encode()).digest()))
        seen, marks, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in rows:
            end = text.rstrip(WHITE)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            marks.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        numbers = [t for t, _, _ in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        cost, audit = cheapest(tuple(marks))
        kept, last, left = [], "", list(rows)
        for op in audit:
            want = "assistant" if last == "u" else "user"
            if op == "I":
                kept.append((want, ""))
            else:
                _, role, text = left.pop(0)
                if op == "D":
                    continue
                kept.append((role if op == "K" else want, text))
            last = kept[-1][0][0]
        assert not left and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in kept))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        told.append((conv, gaps, *faults.values(), illegal, cost, audit, sha, kept))
    return told


def marked(rows):
    return "".join("d" if gone else (c if c in ("u", "a", "s") else "x").upper() if cut else c if c in ("u", "a", "s") else "x"
                   for c, gone, cut in rows)


def test_alignment_is_the_cheapest_and_its_audit_the_least():
    rng = random.Random(3)
    cases = [()] + [tuple((rng.choice("uuaasx"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(1, 12)))
                    for _ in range(2500)]
    for rows in cases:
        want = cheapest(rows)
        assert turns.aligned(marked(rows)) == want, rows
        assert turns.folded(marked(rows)) == want, rows


def test_long_conversations_take_the_same_edits():
    rng = random.Random(9)
    for n in (40, 300, 700):
        marks = "".join(m if rng.random() < 0.85 else rng.choice("uasxUASXd") for m in ("s" + "ua" * n)[:n])
        assert turns.aligned(marks) == turns.folded(marks)
    assert turns.repaired("ua" * 60000 + "u") == (2, "K" * 120000 + "D")


def test_bands_hold_the_incumbent():
    for marks in ("", "d", "s", "uuuu", "aaaa", "ssss", "auauau", "sua", "U", "SUA"):
        assert turns.repaired(marks)[0] <= turns.incumbent(marks)


def sample(rng, convs=60):
    rows = []
    for c in range(convs):
        told = [" ".join(words(rng.randrange(1, 6), rng.randrange(40))).capitalize() + rng.choice([".", "!", "?", "", ". \n"]) for _ in range(6)]
        for t in range(rng.randrange(0, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "", "User", "unknown"])
            rows.append((c, t, role if t else rng.choice(["system", "user"]), rng.choice(told)))
    rows += [(900, None, "user", "Hi."), (901, 3, None, None), (None, 0, "user", "Hi."), (None, 1, "assistant", "So."), (902, None, None, None),
             (903, 1, "user", " \t\n\x0b\x0c\r"), (903, 9, "assistant", "\u00a0."), (904, 5, "user", "A. " * 20000), (904, 6, "assistant", "B.")]
    rows += [(905, t, "ua"[t % 2] + "x", f"text {t}.") for t in range(40, 0, -1)]
    rows += [(906, 1, "user", "Same."), (906, 1, "user", "Same.")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def told(spark, tmp_path_factory):
    """(plain results, results of the query) over one made table with clashing further columns."""
    folder = str(tmp_path_factory.mktemp("turns"))
    rows = sample(random.Random(11))
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "conv_id long, turn long, role string, text string, conv string, audit string, there int")
    df.write.parquet(f"{folder}/conversations.parquet")
    return plainly(rows), queries.op12_conversation_repair(spark, folder), df


def test_query_against_the_contract(told):
    want, got, _ = told
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.columns == names
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted((w[:-1] for w in want), key=repr)


def test_repaired_turns(told):
    want, _, df = told
    rows = turns.damaged(df)
    got = {}
    for r in turns.turns(rows, turns.audits(rows)).orderBy("conv", "no").collect():
        got.setdefault(r["conv"], []).append((r["no"], r["role"], r["text"]))
    assert got == {w[0]: [(i, *t) for i, t in enumerate(w[-1])] for w in want if w[-1]}


def test_sound_and_empty_tables(spark):
    kinds = "conv_id long, turn long, role string, text string"
    sound = spark.createDataFrame([(1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "assistant", "A!")], kinds)
    rows = turns.undamaged(sound)
    assert [tuple(r) for r in turns.audits(rows).collect()] == [(1, 0, 0, 0, 0, 0, 0, "KKK")]
    rows = turns.damaged(spark.createDataFrame([], kinds))
    assert turns.audits(rows).count() == 0
    assert turns.digests(rows, turns.audits(rows)).count() == 0 and turns.turns(rows, turns.audits(rows)).count() == 0


def test_a_long_conversation_in_small_batches(spark):
    n = 30000
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        df = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id, '.') AS text")
        rows = turns.undamaged(df)
        found = turns.audits(rows)
        assert [tuple(r) for r in found.collect()] == [(7, 0, 0, 0, 0, 0, 0, "K" * n)]
        want = hashlib.sha256("\n".join(f"{('user', 'assistant')[i % 2]}:t{i}." for i in range(n)).encode()).hexdigest()
        assert [tuple(r) for r in turns.digests(rows, found).collect()] == [(7, want)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
