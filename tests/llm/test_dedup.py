"""Components, SimHash, near copies, line dedup and the pipeline against brute force."""

import os
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm import components as components_module
from quillspark.llm import line_dedup, simhash
from quillspark.llm.components import components

SF = "/root/testdata/sf0.001"


def union(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("broadcast, hub", [(200_000, 1_000_000), (0, 5)])
@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, monkeypatch, kind, broadcast, hub):
    monkeypatch.setattr(components_module, "BROADCAST_EDGES", broadcast)
    monkeypatch.setattr(components_module, "HUB_EDGES", hub)
    rng = random.Random(8)
    edges = {
        "chain": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 300)] + [(500, 501), (7, 7)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)], "none": [],
    }[kind]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    want = union({x for e in edges for x in e}, edges)
    assert {n: got.get(n, n) for n in want} == want


def brute_fingerprint(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def near_texts():
    rng = random.Random(9)
    base = [f"w{rng.randrange(200)}" for _ in range(400)]
    texts = [None, "", " \n", "A", "a", "a b", "a b c d", "É x Y", " ".join(base), " ".join(base).upper()]
    for k in range(120):  # near copies by one or two words, in a chain
        base[rng.randrange(400)] = f"w{rng.randrange(200)}"
        texts.append(" ".join(base))
    return texts


def brute_simhash(rows, width=3):
    fps = {}
    for i, t in rows:
        fps.setdefault(brute_fingerprint(t, width), set()).add(i)
    root = union(fps, [(a, b) for a, b in combinations(fps, 2) if bin(a ^ b).count("1") <= 2])
    least = {r: min(i for fp in fps if root[fp] == r for i in fps[fp]) for r in set(root.values())}
    return sorted((i, f"{fp:016x}", least[root[fp]]) for fp, ids in fps.items() for i in ids)


@pytest.mark.parametrize("block", [4096, 2])
def test_simhash_links_are_exact(spark, monkeypatch, block):
    """Ids repeat with other texts: each fingerprint is a node of its own."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = [(i * 7 % 97, t) for i, t in enumerate(near_texts())]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = simhash.near_duplicates(docs, width=3).collect()
    assert sorted((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in got) == brute_simhash(rows)


@pytest.mark.parametrize("block", [4096, 4])
def test_links_of_close_fingerprints(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(block)
    fps = {0, 1, 1 << 63}
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(15):
            at ^= 1 << rng.randrange(64)
            fps.add(at)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in sorted(fps)]
    got = {r["node"]: r["root"] for r in simhash.close_components(spark.createDataFrame([(x,) for x in signed], "node long")).collect()}
    want = union(signed, [(a, b) for a, b in combinations(signed, 2) if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2])
    assert {n: got.get(n, n) for n in want} == want


def test_op2_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = simhash.op2_simhash(spark, SF).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == brute_simhash(rows)


def shingles(text, width=5):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    return {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def test_near_copies(spark):
    rng = random.Random(10)
    rows, copies = [(0, None), (1, ""), (2, "few words"), (3, "few words"), (4, "few other words")], []
    for k in range(40):
        words = [f"{rng.choice('abcdef')}{rng.randrange(3000)}" for _ in range(rng.randrange(80, 400))]
        for c in range(4):
            own = list(words)
            for _ in range(c * len(own) // 150):
                own[rng.randrange(len(own))] = f"z{rng.randrange(3000)}"
            rows.append((100 + 4 * k + c, " ".join(own)))
    docs = spark.createDataFrame([*rows, rows[7], (None, rows[7][1]), (None, "alone")], "doc_id long, text string")
    got = simhash.near_copies(docs).collect()
    assert len(got) == len(rows) + 3
    found = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert sum(r["first"] for r in got) == len(set(found.values())) + 1
    assert sorted((r["component_id"] for r in got if r["doc_id"] is None), key=str) == sorted([found[rows[7][0]], None], key=str)
    sets = {i: shingles(t) for i, t in rows}
    alike = [(a, b) for a, b in combinations(sets, 2) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    # the index may miss a pair near the similarity asked for; nothing else is ever linked
    want = union(sets, alike)
    assert all(want[i] == want[root] for i, root in found.items())
    assert sum(found[i] == want[i] for i in want) >= 0.98 * len(want)
    assert simhash.near_copies(docs.limit(0)).count() == 0


def test_near_copies_repeats(spark):
    """Texts that differ in how often a phrase recurs."""
    rng, rows = random.Random(31), []
    for k in range(40):
        words, phrase = ([f"{rng.choice('abcdef')}{rng.randrange(30000)}" for _ in range(n)] for n in (391, 9))
        once, often = list(words), list(words)
        once[90:90] = phrase
        for at in range(360, 0, -45):
            often[at:at] = phrase
        rows += [(2 * k, " ".join(once)), (2 * k + 1, " ".join(often))]
    sets = {i: shingles(t) for i, t in rows}
    alike = [i for i in range(0, len(rows), 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])]
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(alike) >= 30 and sum(found[i] == found[i + 1] for i in alike) >= 0.95 * len(alike)


def test_near_copies_block_edits(spark):
    """An appended, a cut or a replaced block, right above the similarity asked for."""
    rng, rows, pairs = random.Random(33), [], []
    word = lambda: f"{rng.choice('abcdef')}{rng.randrange(30000)}"
    for k in range(180):
        words = [word() for _ in range(400)]
        more = {0: words + [word() for _ in range(97)], 1: words[76:], 2: words[:200] + [word() for _ in range(40)] + words[240:]}[k % 3]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(more))]
    sets = {i: shingles(t) for i, t in rows}
    pairs = [i for i in range(0, len(rows), 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])]
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(pairs) >= 150 and sum(found[i] == found[i + 1] for i in pairs) >= 0.9 * len(pairs)


def test_drop_near_copies_by_row(spark):
    """Rows that repeat an id with another text are judged each; of rows that repeat both one stays."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    docs = spark.createDataFrame([(5, a, "x"), (5, b, "y"), (5, b, "y"), (1, a, "z"), (None, a, "w"), (None, None, "v")], "doc_id long, text string, i string")
    got = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [(5, b, "y"), (1, a, "z"), (None, None, "v")]))


# Lines

def line_shingles(line):
    line = re.sub(r"\s+", " ", line.lower()).strip()
    return {line[k : k + 5] for k in range(max(1, len(line) - 4))} if line else set()


def brute_lines(rows):
    """(doc_id, text, line number) of the lines that go; rows (doc_id, text)."""
    places = [((i is None, i or 0, t, n), x) for i, t in set(rows) for n, x in enumerate((t or "").split("\n")) if x.strip()]
    sets = {p: line_shingles(x) for p, x in places}
    order, links = sorted(sets, key=lambda p: len(sets[p])), []
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            if len(sets[a]) < line_dedup.SIMILARITY * len(sets[b]):
                break  # sizes too far apart, from here on
            if len(sets[a] & sets[b]) >= line_dedup.SIMILARITY * len(sets[a] | sets[b]):
                links.append((a, b))
    root = union(sets, links)
    return {p for p in sets if root[p] != p}


def line_docs():
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    common = [" ".join(word() for _ in range(20)) for _ in range(12)]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "short\nshort"), (4, common[0]), (5, common[0].upper() + "\n  " + common[0].replace(" ", "  "))]
    for i in range(6, 60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            line = rng.choice(common).split() if rng.random() < 0.6 else [word() for _ in range(15)]
            if rng.random() < 0.4:
                line[rng.randrange(len(line))] = word()
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_line_dedup(spark, monkeypatch, broadcast):
    monkeypatch.setattr(line_dedup, "BROADCAST_CLASSES", broadcast)
    monkeypatch.setattr(line_dedup, "BLOCK", 3)
    rows = line_docs()
    docs = spark.createDataFrame([(i, t, "x", "y", "z", len(t or "")) for i, t in rows], "doc_id long, text string, __gone string, line string, th string, n_chars long")
    gone = {(r["doc_id"], r["ln"]) for r in line_dedup.removed_lines(docs).collect()}
    want = {(p[1], p[3]) for p in brute_lines(rows)}
    # minimum hashes may miss a pair near the similarity asked for, never add one
    assert gone <= want and len(gone) >= 0.98 * len(want)
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    for r in kept.collect():
        text = dict(rows)[r["doc_id"]]
        lines = [x for n, x in enumerate((text or "").split("\n")) if (r["doc_id"], n) not in gone]
        assert r["text"] == (None if text is None else "\n".join(lines)) and r["line"] == "y"
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_repeated_ids(spark):
    """Rows that repeat an id with other texts are documents of their own; a null id comes last."""
    a, b = "a line that two documents share", "another text that is nowhere else"
    rows = [(5, a), (5, b), (1, a), (None, a + "\n" + b), (None, "only here"), (7, "x\n\n \nx"), (8, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()), key=repr)
    assert got == sorted([(5, ""), (5, b), (1, a), (None, ""), (None, "only here"), (7, "x\n\n "), (8, "")], key=repr)
    kept = line_dedup.dedup_lines(docs, least_chars=2)
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} >= {(7, "x\n\n \nx"), (8, "x")}


def test_short_and_near_lines(spark):
    """Small sets: equal lines of any length, and lines of a few shingles that are alike."""
    rng = random.Random(23)
    rows = []
    for n in range(1, 60):
        for _ in range(4):
            line = "".join(rng.choices("abcdefghijklmnop0123456789", k=n))
            rows += [(len(rows) + k, x) for k, x in enumerate((line, line, line + "q", line + "qrs", line[1:]))]
    want, got = brute_lines(rows), {(r["doc_id"], r["ln"]) for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {(p[1], p[3]) for p in want}
    assert got <= want and len(got) >= 0.99 * len(want)


def test_line_dedup_all_shingles(spark):
    """Every shingle of five characters counts: edits of one character, lines without blanks, cut ends."""
    rng = random.Random(21)
    rows = [(0, "Copyright (c) 2021 The Example Authors and others, rights reserved"), (1, "Copyright (c) 2022 The Example Authors and others, rights reserved")]
    for n in (46, 58, 66, 88, 118):
        for blanks in ("", "   "):
            for _ in range(20):
                line = list("x" + "".join(rng.choices("abcdefghijklmnopéß文𝒳" + blanks, k=n - 2)) + "x")
                edited = list(line)
                edited[rng.randrange(1, n - 1)] = "z"
                rows += [(len(rows) + k, "".join(x)) for k, x in enumerate((line, edited, line[:-1]))]
    sets = {}
    for i, x in rows:
        sets[i] = line_shingles(x)
    root = union(sets, [(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
    want = {i for i in sets if root[i] != i}
    gone = {r["doc_id"] for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 1 in want and len(want) > 250
    assert gone <= want and len(gone) >= 0.98 * len(want) and 1 in gone


def test_line_dedup_lean(spark, monkeypatch):
    """Tables of lines take less than 0.65 of their bytes; two sets are intersected once, in generated code; ties at 0.8 count as alike."""
    sizes, cut = {}, line_dedup.cut

    def measured(df, name, *more):
        table = cut(df, name, *more)
        sizes[name] = sum(os.path.getsize(f.removeprefix("file://")) for f in table.inputFiles())
        return table

    monkeypatch.setattr(line_dedup, "cut", measured)
    rng = random.Random(31)
    words = ["".join(rng.choices("aeinorst", k=rng.randrange(2, 9))) for _ in range(3000)]
    rows = [(i, "\n".join(" ".join(rng.choices(words, k=60)) for _ in range(20))) for i in range(400)]
    line_dedup.classes_of(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id", "text", 1)
    assert sizes["line-classes"] < 0.65 * sum(len(t) for _, t in rows)

    # a line of n + 4 different characters has n shingles; cut off are as many as leave 0.8 of them, or one more
    line = "".join(chr(0x4E00 + k) for k in range(104))
    texts = spark.createDataFrame([(0, line), (1, line[:84]), (2, line[:83]), (3, line[:9]), (4, line[:8]), (5, line[:7])], "c long, line string")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (3, 4), (3, 5)], "a long, b long")
    links = line_dedup.verified(pairs, texts)
    assert links._jdf.queryExecution().optimizedPlan().toString().count("array_intersect") == 1
    assert sorted(map(tuple, links.collect())) == [(0, 1), (3, 4)]


def test_op6_is_native(spark):
    got = line_dedup.op6_line_dedup(spark, SF)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    docs = {r["doc_id"]: (r["text"] or "").split("\n") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["n_lines"] == len(docs[r["doc_id"]]) and r["n_kept"] == r["n_lines"] - len(r["removed"])
    want = {(p[1], p[3]) for p in brute_lines([(i, "\n".join(x)) for i, x in docs.items()])}
    gone = {(r["doc_id"], n) for r in rows for n in r["removed"]}
    assert gone <= want and len(gone) >= 0.99 * len(want)


# Pipeline

def test_pipeline_stages(spark):
    from quillspark.llm import repetition, toxicity

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        after = docs.collect()
        texts = {r["doc_id"]: r["text"] for r in before}
        if name == "toxicity":
            model = toxicity._load(toxicity.train(spark.createDataFrame(before, docs.schema), spark.read.parquet(f"{SF}/labels.parquet")).dump())
            want = {i for i, t in texts.items() if toxicity.curve_at(model.curve, *toxicity.features(model, t or "")) < 0.5}
            assert {r["doc_id"] for r in after} == want
        elif name == "quality rules":
            assert {r["doc_id"] for r in after} == {i for i, t in texts.items() if repetition.judge_texts([t or ""])[-1][0]}
        elif name == "line dedup":
            assert {r["doc_id"] for r in after} == set(texts) and all(r["n_chars"] == len(r["text"]) for r in after)
        else:
            sets = {i: shingles(t) for i, t in texts.items()}
            root = union(sets, [(a, b) for a, b in combinations(sets, 2) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])])
            assert {r["doc_id"] for r in after} == {i for i in root if root[i] == i}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}


def test_pipeline_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"w{k * 7919 % 100_003}" for k in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", len(long)), (3, long, "en", "s", len(long)), (4, long, "en", "s", len(long)), (None, long, None, "s", None), (None, None, None, None, None)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            if name != "best-fit packing":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids = {r["doc_id"] for r in docs.collect()}
        assert (3 in ids and 1 not in ids) if given else not ids


def test_pipeline_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(got.columns)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert np.all([r["length"] > 0 for r in got.collect()])


def test_small_and_large_rounds_of_union_find_agree(spark, monkeypatch):
    from quillspark.llm import components as C

    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    found = []
    for most in (50_000, 0):
        monkeypatch.setattr(C, "TASK_EDGES", most)
        found.append({r["node"]: r["root"] for r in C.components(df).collect()})
    least = {n: n for e in edges for n in e}
    while any(least[a] != least[b] for a, b in edges):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert found[0] == found[1] == {n: r for n, r in least.items() if n != r}


def test_alike_sets_are_intersected_once(spark):
    from quillspark.llm import minhash as M

    condition = M._alike(F.col("x"), F.col("y"), 80)
    assert str(condition).count("array_intersect") == 1
    rows = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 3, 4, 5]), ([1, 2, 3, 4], [1, 2, 3, 5]), ([], [1])], "x array<long>, y array<long>")
    assert [r[0] for r in rows.select(condition).collect()] == [True, False, False]


@pytest.mark.parametrize("block, shingles, pack, columns", [(2048, 1 << 21, 1 << 18, 1024), (7, 1 << 21, 1 << 18, 16), (2048, 300, 1, 5), (3, 100, 1 << 18, 1)])
def test_members_of_keys_are_compared_by_blocks(spark, monkeypatch, block, shingles, pack, columns):
    """Keys of many sets: they join the components that brute force joins, whatever the blocks, by links of alike sets alone and by few of them."""
    from quillspark.llm import minhash as M

    for name, value in (("BLOCK", block), ("BLOCK_SHINGLES", shingles), ("PACK_SHINGLES", pack), ("COLUMNS", columns)):
        monkeypatch.setattr(M, name, value)
    rng = random.Random(6)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(120)]
    sets = {n: rng.sample(hashes[:40] if n % 3 else hashes, rng.randrange(28, 40)) for n in range(60)}
    roots = {n: n - n % 4 for n in sets}
    keys = {n: {n % 5, 7 + n % 2, 1 << 40} for n in sets}
    like = {(a, b) for a, b in combinations(sets, 2) if 100 * (both := len(set(sets[a]) & set(sets[b]))) >= 80 * (len(sets[a]) + len(sets[b]) - both)}
    want = {(a, b) for a, b in like if 0 not in (a, b) and keys[a] & keys[b]}
    met = spark.createDataFrame([(k, n, 0) for n in sets for k in keys[n]], "key long, node long, pivot long")
    marks = spark.createDataFrame([(n, (len(s),)) for n, s in sets.items()], "node long, x struct<size: long>")
    found = M._in_blocks(met, spark.createDataFrame(list(roots.items()), "node long, root long"), marks, spark.createDataFrame(list(sets.items()), "node long, shingles array<long>"), 80)
    got = [tuple(r) for r in found.collect()]
    assert set(got) <= want and len(got) == len(set(got))
    assert union(sets, [*roots.items(), *got]) == union(sets, [*roots.items(), *want]) != union(sets, roots.items())
    if block == 2048 and shingles > 300:
        assert len(got) < len(want) / 2


def test_links_of_a_block_are_a_forest():
    from quillspark.llm import minhash as M

    n = 300
    one, roots = np.arange(n), np.arange(n) // 3
    sets = [np.arange(100) + k // 100 * 1000 for k in range(n)]  # three groups of equal sets
    like = M.alike_matrix(one, one, np.concatenate(sets), np.arange(n + 1) * 100, 80)
    assert (like == (one[:, None] // 100 == one[None, :] // 100)).all()
    links = M.forest(like, one, one, roots)
    assert all(like[x, y] for x, y in links) and len(links) == 99  # 100 components: two span two groups, so all are one
    assert len(set(union(range(n), [*links, *((k, k // 3 * 3) for k in range(n))]).values())) == 1
    half = one[:150], one[150:]
    assert M.forest(M.alike_matrix(*half, np.concatenate(sets), np.arange(n + 1) * 100, 80), *half, roots)
    assert M.forest(np.zeros((n, n), bool), one, one, roots) == []
