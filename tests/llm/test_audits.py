"""Conversation repair, MinHash near-duplicates and the filter audit against brute force, and against their SQL."""

import hashlib
import random
import re
import zlib
from itertools import combinations, permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import common, conversations, filter_audit, minhash, queries, simhash

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", ["op11_conversations", "op12_minhash", "op13_filter_audit"])
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    found = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(repr([r[c] for c in names]) for r in got.collect()) == sorted(repr(list(r)) for r in found.fetchall())


# conversations


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute_repair(rows):
    """From the last turn back: the least (cost, audit, lines) from each state on."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    after = {"0": {"s": "1", "u": "2"}, "1": {"u": "2"}, "2": {"a": "3"}, "3": {"u": "2"}}
    names = {"u": "user", "a": "assistant"}

    def with_insertions(best):
        for _ in range(4):
            for q, to in after.items():
                for c in set(to) & set(names):
                    ahead = best.get(to[c])
                    if ahead:
                        more = (ahead[0] + 2, "I" + ahead[1], (names[c] + ":", *ahead[2]))
                        best[q] = min(best.get(q, more), more)
        return best

    best = with_insertions({"0": (0, "", ()), "3": (0, "", ())})
    for (_, _, role, text), fault in zip(rows[::-1], faults[::-1]):
        now = {}
        for q, to in after.items():
            ways = [(best[q][0] + 3, "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                for c, nxt in to.items():
                    cost, audit, lines = best[nxt]
                    if role[:1] == c:
                        ways.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                    if c in names:
                        ways.append((cost + more + 2, "R" + audit, (f"{names[c]}:{text}", *lines)))
            now[q] = min(ways)
        best = with_insertions(now)
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), best["0"][0], best["0"][1], hashlib.sha256("\n".join(best["0"][2]).encode()).hexdigest(),
    )


def talk():
    rng = random.Random(3)
    says = ["Yes.", "No!", "what?", "so", "well,", "", " \t", "Fine.\n", "É. ", None, "a.b", " "]
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 14)):
            role = rng.choice(["user", "assistant"] if rng.random() < 0.3 else [("user", "assistant")[turn % 2]]) if rng.random() < 0.85 else rng.choice(["system", "tool", None, "", "User", "sys"])
            said = rng.choice(says) if rng.random() < 0.4 else f"line {conv} {turn}."
            rows.append((conv, None if rng.random() < 0.04 else turn + rng.choice([0, 0, 0, 0, 3]), role, said))
    rows += [(None, t, "user", "Hm.") for t in (None, None, 1, 2)] + [(900, None, "system", "Go."), (901, 5, None, None)]
    rows += [(902, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(300)]  # long, in order
    rows += [(903, rng.randrange(40), rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b.", "c.", "d"])) for _ in range(200)]  # many repeats
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [8, 2, 0])
def test_conversations(spark, monkeypatch, tmp_path, bits):
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = talk()
    clashing = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("id", "conv", "block", "text_", "kind", "p", "base", "k")})
    clashing.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in conversations.op11_conversations(spark, str(tmp_path)).collect()}
    want = {c: [] for c, *_ in rows}
    for r in brute_damage(rows):
        want[r[0]].append(r)
    assert got == {c: brute_repair(own) for c, own in want.items()}


def test_conversations_all_lost_or_none(spark, tmp_path):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(lost, 0, "user", "Hi.")], TURNS).write.parquet(f"{tmp_path}/a/conversations.parquet")
    assert [tuple(r) for r in conversations.op11_conversations(spark, f"{tmp_path}/a").collect()] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert conversations.op11_conversations(spark, f"{tmp_path}/b").collect() == []


def test_repaired_turns_are_in_order(spark):
    rows = spark.createDataFrame([r for r in talk() if r[2] and r[3]], "conv long, turn long, role string, text string")
    report, turns = conversations.repair(rows)
    by = {}
    for r in sorted(turns.collect(), key=lambda r: (r["conv"] is not None, r["conv"], r["place"], r["nth"])):
        by.setdefault(r["conv"], []).append(r)
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in own)) for own in by.values())
    for r in report.collect():
        edits = [x["edit"][0].upper() for x in by.get(r["conv"], [])]
        assert edits == [c for c in r["audit"] if c != "D"]


# near-duplicates


def brute_near(rows, percent=80, width=4):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(frozenset(" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((repr(i), len(s), repr(least.get(find(k)) if s else i), bool(i is not None and (least.get(find(k)) == i or not s))) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def near_rows():
    rng = random.Random(12)
    rows = [(i, t) for i, t in enumerate([None, "", " \n", "A", "a", "a b", "A  b", "a b c d", "É x Y"])]
    base = [f"w{rng.randrange(300)}" for _ in range(300)]
    for k in range(60):  # a chain
        base[rng.randrange(300)] = f"x{k}"
        rows.append((100 + k, " ".join(base)))
    for k in range(40):  # texts that share a third
        rows.append((200 + k, " ".join(base[:100] + [f"y{k}-{j}" for j in range(200)])))
    for k in range(20):  # copies and copies of another case; a block appended
        rows += [(300 + k, " ".join(base)), (400 + k, " ".join(base).upper()), (500 + k, " ".join(base + [f"z{k}-{j}" for j in range(rng.choice([60, 90]))]))]
    rows += [(None, " ".join(base)), (None, "alone here"), (None, None), (301, "another text of the same id"), (301, " ".join(base[:250])), (100, rows[9][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block, heavy", [(4096, 1_000_000), (3, 5)])
def test_near_duplicates(spark, monkeypatch, block, heavy):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(common, "HEAVY_ROWS", heavy)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n", "id", "node", "key", "th")})
    got = sorted((repr(r[0]), r[1], repr(r[2]), r[3]) for r in minhash.near_duplicates(docs, 80, 4).collect())
    assert got == brute_near(rows)


def test_near_duplicates_of_none(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pairs_within_the_distance_meet():
    """The guarantee: signatures that differ in DISTANCE slots, wherever they are, share a key."""
    rng = random.Random(5)
    for _ in range(500):
        x = np.array([rng.randrange(256) for _ in range(minhash.SLOTS)])
        y = x.copy()
        for k in rng.sample(range(minhash.SLOTS), minhash.DISTANCE):
            y[k] ^= rng.randrange(1, 256)
        assert any((x[key] == y[key]).all() for key in minhash.KEYS)


def test_recall_right_at_the_limit():
    """Sets right at 0.8: nearly all share a key and are not too far apart."""
    rng = np.random.default_rng(7)
    met = 0
    for _ in range(1000):
        both, x, y = (rng.integers(0, 2**64, n, np.uint64) for n in (400, 50, 50))
        x, y = (minhash.signature(np.concatenate([both, own])) for own in (x, y))
        met += any((x[key] == y[key]).all() for key in minhash.KEYS) and (x != y).sum() <= minhash.FAR
    assert met >= 995


# filters


def brute_audit(docs, labels):
    texts = [(i, s or "", t or "") for i, t, s in docs]
    least = {}
    for i, _, t in texts:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    rows = []
    for i, part, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > least[t],
        }
        own = [x for x in labels if i is not None and x[0] == i]
        rows.append((part, {f for f in fails if fails[f]}, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = []
    for part in {r[0] for r in rows}:
        mine, cells = [r for r in rows if r[0] == part], []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                goes = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in mine if f in r[1]]
                cells.append(["".join(order), step, len(left), len(goes), len(failing) - len(goes), sum(r[1] == {f} for r in mine), sum(r[2] for r in goes), sum(r[3] for r in goes), f])
        shapley = {f: sum(c[3] for c in cells if c[-1] == f) for f in "ABCDE"}
        out += [(part, *c[:-1], shapley[c[-1]]) for c in cells]
    return sorted(out)


@pytest.mark.parametrize("rows, heavy", [(1024, 1_000_000), (7, 3)])
def test_filter_audit(spark, monkeypatch, rows, heavy):
    monkeypatch.setattr(filter_audit, "SLICE_ROWS", rows)
    monkeypatch.setattr(common, "HEAVY_ROWS", heavy)
    rng = random.Random(1)
    docs = []
    for i in range(300):
        words = [rng.choice(["ab", "cd", "Ef", f"w{rng.randrange(400)}", "É", "#x"] if rng.random() < 0.1 else [f"w{rng.randrange(300)}"]) for _ in range(rng.choice([0, 5, 150, 199, 200, 260]))]
        if rng.random() < 0.2:
            words = ["THE"] * rng.randrange(300)
        docs.append((i, rng.choice(" \n").join(words), rng.choice(["s0", "s0", "s1", None, ""])))
    docs += [(400 + k, docs[3][1], "s0") for k in range(20)] + [(None, docs[3][1], "s1"), (5, None, "s2"), (5, "", None), (None, None, None), (500, "a b\x1fc", "s2"), (7, docs[7][1], "s0")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 420, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    made = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({c: F.lit(1) for c in ("id", "part", "mask", "n", "k1", "quality", "toxic")})
    got = filter_audit.interactions(filter_audit.failures(made), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1)))
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, labels)


def test_filter_audit_of_none(spark):
    got = filter_audit.interactions(filter_audit.failures(spark.createDataFrame([], "doc_id long, text string, source string")), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert got.collect() == []
