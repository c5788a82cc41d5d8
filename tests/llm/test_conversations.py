"""Conversation repair: against a search over whole audits, over windows, and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from fixtures import read
from urbanflow.llm import conversations as C
from urbanflow.llm.queries import op12_conversations

SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    """{conv_id: rows after damage}, by the letter of the task."""
    out = {}
    for conv, turn, role, text in rows:
        found = out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        found += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for found in out.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = text.rstrip(SPACES)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, repaired) by a plain shortest path over (row, roles so far), whole audits kept as strings."""
    best = {"": (0, "", ())}  # by the last two initials' meaning: the place

    def place(roles):
        return "" if not roles else roles[-1][0][0]

    def better(table, roles, cost, audit):
        k = place(roles)
        if k not in table or (cost, audit) < table[k][:2]:
            table[k] = (cost, audit, roles)

    def inserts(table):
        for _ in range(3):
            for cost, audit, roles in list(table.values()):
                new = "assistant" if place(roles) == "u" else "user"
                better(table, (*roles, (new, "")), cost + 3, audit + "I")

    for (_, role, text), fault in zip(rows, faults):
        before = dict(best)
        inserts(before)
        best = {}
        for cost, audit, roles in before.values():
            better(best, roles, cost + 4, audit + "D")
            if fault in ("blank", "duplicate"):
                continue
            extra, p = 3 * (fault == "truncated"), place(roles)
            new = "assistant" if p == "u" else "user"
            better(best, (*roles, (new, text)), cost + 3 + extra, audit + "R")
            if role[:1] == new[0] or (role[:1] == "s" and p == ""):
                better(best, (*roles, (role, text)), cost + extra, audit + "K")
    inserts(best)
    return min(v for k, v in best.items() if k in ("", "a"))


def every_audit(rows, faults, most):
    """The cheapest audit among all sequences of up to ``most`` insertions: no dynamic program at all."""
    best = None
    for letters in itertools.product("DKR", repeat=len(rows)):
        for slots in itertools.product(range(most + 1), repeat=len(rows) + 1):
            roles, cost, audit, ok = [], 0, "", True
            for i in range(len(rows) + 1):
                for _ in range(slots[i]):
                    roles.append(("assistant" if roles and roles[-1][0][:1] == "u" else "user", ""))
                    cost, audit = cost + 3, audit + "I"
                if i == len(rows):
                    break
                e, (_, role, text) = letters[i], rows[i]
                audit += e
                if e == "D":
                    cost += 4
                    continue
                ok &= faults[i] not in ("blank", "duplicate")
                cost += 3 * (faults[i] == "truncated") + 3 * (e == "R")
                roles.append((role if e == "K" else "assistant" if roles and roles[-1][0][:1] == "u" else "user", text))
            if ok and re.fullmatch("(s?(ua)+)?", "".join(r[0][:1] or "-" for r in roles)):
                best = min(best or (cost, audit), (cost, audit))
    return best


def expected(rows):
    faults = faults_of(rows)
    cost, audit, roles = cheapest(rows, faults)
    turns = sorted({t for t, _, _ in rows if t is not None})
    initials = [r[1][:1] for r in rows]
    return {"gaps": turns[-1] - turns[0] + 1 - len(turns) if turns else 0,
            **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in roles).encode()).hexdigest()}


def agree(found, want):
    got = {r["conv_id"]: r.asDict() for r in found}
    assert len(got) == len(found) and set(got) == set(want)
    for k, rows in want.items():
        row = got[k]
        row.pop("conv_id")
        assert row == expected(rows), k


def random_rows(rng, n):
    texts = ["Yes.", "No", "What?", "", " \n", "Well... ", "ok!"]
    roles = ["user", "assistant", "system", "tool", "", "User"]
    return [(rng.randrange(n + 2), rng.choices(roles, [5, 5, 2, 1, 1, 1])[0], rng.choice(texts) + rng.choice(["", str(rng.randrange(9)), "."]))
            for _ in range(n)]


def test_reference_search_is_exhaustive():
    rng = random.Random(1)
    for _ in range(60):
        rows = sorted(random_rows(rng, rng.randrange(4)))
        faults = faults_of(rows)
        assert cheapest(rows, faults)[:2] == every_audit(rows, faults, 2)


def test_query_equals_the_search(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in read(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    agree(op12_conversations(spark, sf).collect(), damaged(rows))


@pytest.mark.parametrize("window", [C.WINDOW, 3])
def test_random_conversations(spark, monkeypatch, window):
    rng = random.Random(window)
    want = {i: sorted(random_rows(rng, rng.choice([1, 2, 3, 5, 8, 20]))) for i in range(150)}
    want[7] = sorted(random_rows(rng, 400))
    done, sent = [], []
    for i, rows in want.items():  # the streaming state itself, without Spark
        now = C._Conversation(i)
        for (turn, role, text), fault in zip(rows, faults_of(rows)):
            now.add(turn, role, text, C._INITIAL.get(role[:1], C.START),
                    {"": C.FINE, "truncated": C.TRUNCATED, "blank": C.BLANK, "duplicate": C.DUPLICATE}[fault])
            if len(now.rows) >= window:
                sent.append(now.window())
        done.append(now.end())
    for d in done:
        windows = sorted((w for w in sent if w["conv_id"] == d["conv_id"]), key=lambda w: -w["window"])
        assert len(windows) == d["windows"]
        audit, place = d["audit"], d["place"]
        for w in windows:
            audit, place = zlib.decompress(w["audits"][place]).decode() + audit, w["places"][place]
        got = {c: d[c] for c in C.RESULTS} | {"audit": audit}
        assert place == C.START and got == expected(want[d["conv_id"]])


def test_long_conversation_goes_out_in_windows(spark):
    n = 3 * C.WINDOW + 17
    rng = random.Random(5)
    turns = [(1, t, "user" if t % 2 == 0 or rng.random() < 0.01 else "assistant", f"text {t}." if rng.random() < 0.95 else "cut")
             for t in range(n)] + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hi.")]
    rng.shuffle(turns)
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    agree(C.repair(df).collect(), {k: sorted(r[1:] for r in turns if r[0] == k) for k in (1, 2)})


def test_states_are_few():
    C.step.cache_clear()
    todo, seen = [C._FIRST], {C._FIRST}
    while todo:
        s = todo.pop()
        for kind in itertools.product(range(4), range(4)):
            new = C.step(s, *kind)[0]
            if new not in seen:
                seen.add(new)
                todo.append(new)
    assert len(seen) < 2000


def test_repaired_turns(spark):
    df = C.damage(read(spark, "conversations"))
    rows = C.repaired_turns(df, gone_col="gone").collect()
    hashes = {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in C.repair(df, gone_col="gone").collect()}
    by = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["position"])):
        by.setdefault(r["conv_id"], []).append(r)
    for k, (audit, sha) in hashes.items():
        found = by.get(k, [])
        assert [r["position"] for r in found] == list(range(len(found)))
        assert "".join(r["edit"] for r in found) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in found).encode()).hexdigest() == sha
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in found))


def test_edges(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 1, "user", "Hi."), (3, None, "user", "a."), (3, None, "assistant", "b."),
            (3, -5, "user", "a."), (4, 2**62, "user", "x" * 100_000 + "."), (4, -2**62, "system", "s."), (5, 1, None, "t."),
            (6, 1, "user", None), (7, 1, "assistant", "\r\n"), (8, 9, "user", "é ünïcode."), (8, 12, "assistant", "b!")]
    rows = [(None if c is None else c, t, r, x) for c, t, r, x in rows]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain = {}
    for c, t, r, x in rows:
        plain.setdefault(c, []).append((t, r if r is not None else " ", x if x is not None else " "))
    for found in plain.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    from pyspark.sql import functions as F
    wide = df.withColumns({c: F.lit("own") for c in (*C.RESULTS, "key", "gone", "h1", "h2", "initial", "fault", "window")})
    found = C.repair(wide).collect()
    agree(found, plain)
    assert found[0].__fields__ == ["conv_id", *C.RESULTS]
    assert C.repair(df.limit(0)).count() == 0 and C.repaired_turns(df.limit(0)).count() == 0
    gone = C.repair(df.withColumn("gone", F.lit(True)), gone_col="gone").collect()
    assert {r["conv_id"] for r in gone} == set(plain) and all(r["audit"] == "" and r["cost"] == 0 and r["gaps"] == 0 for r in gone)
    assert all(r["repaired_sha256"] == hashlib.sha256(b"").hexdigest() for r in gone)


def test_query_takes_nulls_as_one_space(spark, tmp_dir):
    rows = [(c, t, r, x) for c in (None, 1, 2, 3) for t in (None, 0, 1, 2, 5) for r, x in ((None, "a."), ("user", None), ("assistant", "b"))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_dir}/conversations.parquet")
    agree(op12_conversations(spark, tmp_dir).collect(), damaged(rows))
