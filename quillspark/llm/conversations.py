"""Repair of the structure of conversations: the cheapest edits after which the turns' roles are in order.

A conversation is in order if the initials of its roles are ``(s?(ua)+)?``: nothing, or pairs of user and assistant that a system turn may
precede. Edits: Keep costs 0, Rerole to user or assistant 2, Delete 3, Insert an empty turn of user or assistant anywhere 2; a truncated
turn that is not deleted costs 1 more, a blank or duplicate one must be deleted. Of the cheapest sequences of edits the one
whose initials are least by ASCII is chosen.

Turns are numbered in one order over all conversations and dealt out in blocks of 2 ** BLOCK_BITS turns, so that one of any length is spread over many
tasks. Windows within a block flag faults; the turns of a conversation in it are collected as sorted structs, and ``aggregate()`` carries four structs
(cost, audit, path) through ``least``, one for each state that the roles so far can be in: nothing yet, after the system turn, after a user, after an
assistant. In a block that is not its conversation's first this is done from each of the four states, and the blocks are then composed in order.
Two sequences of edits of the same turns that lead to one state at one cost never begin with one another (the longer one would have more insertions and cost
more), so the least one of a state stays least whatever follows: the fold and the composition are exact.

Edge cases: a null role or text is one space; a role without an initial counts as one that is not in order. Turns are ordered by turn (nulls first), role,
and SHA-256 of the text; equal rows are repeats of each other, and all but one are duplicates. Rows with a null conversation are one conversation. A
conversation without rows has no faults, costs nothing and has an empty audit. What one conversation must fit into is a row with its audit, a letter a turn,
and the digest's task, which reads the repaired turns in order and holds a batch of them at a time. Other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.queue import numbered
from .common import cut, table

#: Turns of a block, as a power of two.
BLOCK_BITS = 8
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
#: A cost that no sequence of edits has: the state can't be reached.
NEVER = 1 << 40
STATES = 4
#: Letters of a path and what they are in an audit: kept, made user, made assistant, deleted, a user or an assistant inserted before.
PATH, AUDIT = "kuadUA", "KRRDII"


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text): ``turns`` with faults planted by a checksum of conversation and turn: rows lost, emptied, cut off, repeated, of another role."""
    own = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(a) for c, a in ((role, "role"), (text, "text"))])
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")])
    kind = F.crc32(key) % 20
    marked = own.withColumn("kind", kind).filter("kind <> 0")
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return marked.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), copies.alias("copy")).drop("copy")


def ordered(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, id, block, k1, k2): turns numbered by conversation and turn, and 128 bits of hash of conversation, role and text."""
    own = turns.select("conv", "turn", "role", "text", F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("row"))  # the row parts equal ones
    placed = numbered(own, 0, "conv", "turn", "role", "digest", "row")
    same = [F.col("conv").isNull(), F.coalesce(F.col("conv").cast("string"), F.lit("")), "role", "digest"]
    return cut(placed.select("conv", "turn", "role", "text", "id", F.shiftright("id", BLOCK_BITS).alias("block"), F.xxhash64(*same).alias("k1"), F.xxhash64(F.lit(1), *same).alias("k2")), "turns")


def flagged(rows: DataFrame) -> DataFrame:
    """(conv, block, id, turn, initial, fault, illegal, fresh): each turn's first fault (blank, duplicate, truncated or null), and against the turn before it in its
    block whether their roles may not follow each other and whether its number is a new one."""
    said = F.rtrim("text", F.lit(BLANKS))
    own = rows.select("conv", "block", "id", "turn", "k1", "k2", F.substring("role", 1, 1).alias("initial"), (said == "").alias("blank"), (~F.right(said, F.lit(1)).isin(".", "!", "?")).alias("open"))
    before, alike = Window.partitionBy("conv", "block").orderBy("id"), Window.partitionBy("conv", "block", "k1", "k2").orderBy("id")
    pair, last = F.concat(F.lag("initial").over(before), "initial"), F.lag("turn").over(before)
    marked = own.withColumns({
        "illegal": F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)), "fresh": F.col("turn").isNotNull() & (last.isNull() | (last != F.col("turn"))), "nth": F.row_number().over(alike),
    })
    # across blocks: turns that conversations of several blocks repeat
    spread = own.groupBy("conv").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).filter("lo <> hi").select(F.col("conv").alias("c"))
    firsts = own.join(spread, F.col("conv").eqNullSafe(F.col("c")), "left_semi").groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count("*").alias("times")).filter("times > 1").drop("times")
    again = (F.col("nth") > 1) | F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("open"), "truncated")
    return marked.join(firsts, ["k1", "k2"], "left").select("conv", "block", "id", "turn", "initial", fault.alias("fault"), "illegal", "fresh")


def _state(cost: Column, audit: Column, path: Column) -> Column:
    return F.struct(cost.cast("bigint").alias("cost"), audit.alias("audit"), path.alias("path"))


def _then(state: Column, cost: int | Column, path: str | Column) -> Column:
    """A state after one more edit, with its letter of a path."""
    path = F.lit(path) if isinstance(path, str) else path
    return _state(state["cost"] + cost, F.concat(state["audit"], F.translate(path, PATH, AUDIT)), F.concat(state["path"], path))


def _inserted(s: list[Column]) -> list[Column]:
    """The states before a turn, after as many insertions as can help."""
    user = F.least(*[_then(s[k], INSERT, "U") for k in (0, 1, 3)])
    return [s[0], s[1], F.least(s[2], user), F.least(s[3], _then(s[2], INSERT, "A"), _then(user, INSERT, "A"))]


def _step(states: Column, turn: Column) -> Column:
    """The four states after a turn, a struct (initial, truncated, gone)."""
    s = [F.get(states, F.lit(k)) for k in range(STATES)]
    # the insertions of a step are written once: an array of one element holds them for the inner function
    return F.get(F.transform(F.array(F.array(*_inserted(s))), lambda held: _after(held, turn)), F.lit(0))


def _after(held: Column, turn: Column) -> Column:
    s = [F.get(held, F.lit(k)) for k in range(STATES)]
    more = turn["truncated"].cast("bigint") * TRUNCATED

    def to(initial: str) -> tuple[Column, Column]:
        own = turn["initial"] == initial
        return F.when(turn["gone"], NEVER).when(own, more).otherwise(more + REROLE), F.when(own, "k").otherwise(initial)

    user, assistant = to("u"), to("a")
    system = F.when(turn["gone"] | (turn["initial"] != "s"), NEVER).otherwise(more)
    return F.array(
        _then(s[0], DELETE, "d"), F.least(_then(s[1], DELETE, "d"), _then(s[0], system, "k")),
        F.least(_then(s[2], DELETE, "d"), *[_then(s[k], *user) for k in (0, 1, 3)]), F.least(_then(s[3], DELETE, "d"), _then(s[2], *assistant)),
    )


def _start(at: Column) -> Column:
    return F.array(*[_state(F.when(at == k, 0).otherwise(NEVER), F.lit(""), F.lit("")) for k in range(STATES)])


def folded(flags: DataFrame) -> DataFrame:
    """(conv, first, gaps, blank, duplicate, truncated, illegal, cost, audit, path) for each conversation; first is the number of its first turn."""
    turn = F.struct("id", "initial", (F.coalesce("fault", F.lit("")) == "truncated").alias("truncated"), F.coalesce("fault", F.lit("")).isin("blank", "duplicate").alias("gone"))
    faults = ("blank", "duplicate", "truncated")
    blocks = flags.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list(turn)).alias("turns"), F.min("id").alias("first"), F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count_if("fresh").alias("fresh"), F.count_if("illegal").alias("illegal"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in faults], F.min_by("initial", "id").alias("opens"), F.max_by("initial", "id").alias("ends"),
    )
    own, after = Window.partitionBy("conv"), Window.partitionBy("conv").orderBy("block")
    pair = F.concat(F.lag("ends").over(after), "opens")
    placed = blocks.withColumns({
        "nth": F.row_number().over(after), "illegal": F.col("illegal") + F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).cast("int"),
        "fresh": F.col("fresh") - F.coalesce(F.lag("hi").over(after) == F.col("lo"), F.lit(False)).cast("int"),
    })
    fold = lambda at: F.aggregate("turns", _start(at), _step)
    starts = F.when(F.col("nth") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(STATES - 1)))
    one = placed.withColumn("made", F.transform(starts, fold)).groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("block", "made"))).alias("blocks"), F.min("first").alias("first"), (F.max("hi").cast("bigint") - F.min("lo") + 1 - F.sum("fresh")).alias("gaps"),
        *[F.sum(c).alias(c) for c in (*faults, "illegal")],
    )

    def joined(states: Column, block: Column) -> Column:
        """Each state at the end of a block: the least way over the states at its begin."""
        made = block["made"]
        by = lambda k, to: F.get(F.get(made, F.lit(k)), F.lit(to))
        way = lambda k, to: _state(F.get(states, F.lit(k))["cost"] + by(k, to)["cost"], F.concat(F.get(states, F.lit(k))["audit"], by(k, to)["audit"]), F.concat(F.get(states, F.lit(k))["path"], by(k, to)["path"]))
        return F.array(*[F.least(*[way(k, to) for k in range(STATES)]) for to in range(STATES)])

    rest = F.slice("blocks", F.lit(2), F.greatest(F.size("blocks") - 1, F.lit(0)))
    whole = one.withColumn("s", F.aggregate(rest, F.get(F.get("blocks", F.lit(0))["made"], F.lit(0)), joined))
    end = _inserted([F.get("s", F.lit(k)) for k in range(STATES)])
    best = F.least(end[0], end[3])
    return whole.withColumn("best", best).select("conv", "first", F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps"), *faults, "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), F.col("best.path").alias("path"))


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, place, nth, role, text, edit): the turns after repair, in order of (place, nth); edit is keep, rerole or insert. rows: as from ``ordered``; found: as from ``folded``."""
    tokens = found.select("conv", "first", F.posexplode(F.split("path", "(?<=[kuad])")).alias("k", "token")).filter("token <> ''")
    asked = tokens.select("conv", (F.col("first") + F.col("k")).alias("place"), F.regexp_replace("token", "[kuad]$", "").alias("ins"), F.regexp_extract("token", "[kuad]$", 0).alias("own"))
    # what is inserted after a conversation's last turn has a place of its own, where another conversation's first turn may be
    taken = asked.filter("own in ('k', 'u', 'a')").select("place", "own").join(rows.select(F.col("id").alias("place"), "conv", "role", "text"), "place")
    role = F.when(F.col("own") == "k", F.col("role")).when(F.col("own") == "u", "user").otherwise("assistant")
    kept = taken.select("conv", "place", F.lit(9).alias("nth"), role.alias("role"), "text", F.when(F.col("own") == "k", "keep").otherwise("rerole").alias("edit"))
    new = asked.filter("ins <> ''").select("conv", "place", F.posexplode(F.split("ins", "")).alias("nth", "who")).filter("who <> ''")
    return kept.unionByName(new.select("conv", "place", "nth", F.when(F.col("who") == "U", "user").otherwise("assistant").alias("role"), F.lit("").alias("text"), F.lit("insert").alias("edit")))


def digests(turns: DataFrame) -> DataFrame:
    """(conv, sha256) of each conversation's ``role:text``, newline-joined. A digest reads its text in order: turns are dealt out by conversation, sorted, and read as they come."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None
        for b in batches:
            done = []
            for conv, line in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                if digest is None or conv != held:
                    if digest is not None:
                        done.append((held, digest.hexdigest()))
                    held, digest = conv, hashlib.sha256(line)
                else:
                    digest.update(b"\n" + line)
            yield pa.record_batch([pa.array([c for c, _ in done], b.schema.types[0]), pa.array([d for _, d in done], pa.string())], names=["conv", "sha256"])
            kind = b.schema.types[0]
        if digest is not None:
            yield pa.record_batch([pa.array([held], kind), pa.array([digest.hexdigest()])], names=["conv", "sha256"])

    lines = turns.repartition("conv").sortWithinPartitions("conv", "place", "nth").select("conv", F.concat_ws(":", "role", "text").alias("line"))
    return lines.mapInArrow(work, f"conv {turns.schema['conv'].dataType.simpleString()}, sha256 string")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report, turns after repair) of turns (conv, turn, role, text); the report as from ``folded``, the turns as from ``repaired``."""
    rows = ordered(turns)
    found = cut(folded(flagged(rows)), "conversations")
    return found, repaired(rows, found)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    found, turns = repair(damaged(given))
    report = found.select(F.col("conv").alias("c"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    hashed = digests(turns).select(F.col("conv").alias("d"), "sha256")
    all_ = given.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(hashed, F.col("conv_id").eqNullSafe(F.col("d")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return all_.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


OP11_SQL = r"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
coded AS (SELECT given.*, xor(list_reduce([4294967295] || list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind FROM given, tab),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM coded, (SELECT unnest([1, 2]) AS copy) WHERE kind <> 0 AND (copy = 1 OR kind = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS k FROM damaged),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) AS nth, substr(role, 1, 1) AS i, lag(substr(role, 1, 1)) OVER w AS before,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS said FROM numbered WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
flags AS (SELECT *, CASE WHEN said = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
report AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM flags GROUP BY 1),
ins(st, st2, more, letters, body) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 2, 'I', chr(10) || 'user:'), (1, 2, 2, 'I', chr(10) || 'user:'),
    (3, 2, 2, 'I', chr(10) || 'user:'), (2, 3, 2, 'I', chr(10) || 'assistant:'), (0, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
edits(st2, st3, says) AS (VALUES (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
fold AS (SELECT conv_id, 0::BIGINT AS k, 0 AS st, {'cost': 0::BIGINT, 'audit': '', 'body': ''} AS x FROM report
    UNION ALL SELECT f.conv_id, f.k + 1, e.st3, min({'cost': f.x.cost + ins.more + CASE WHEN says = '' THEN 3 ELSE (fault = 'truncated')::INT + CASE WHEN says = r.i THEN 0 ELSE 2 END END,
        'audit': f.x.audit || ins.letters || CASE WHEN says = '' THEN 'D' WHEN says = r.i THEN 'K' ELSE 'R' END,
        'body': f.x.body || ins.body || CASE WHEN says = '' THEN '' WHEN says = r.i THEN chr(10) || role || ':' || text WHEN says = 'u' THEN chr(10) || 'user:' || text ELSE chr(10) || 'assistant:' || text END})
    FROM fold f JOIN flags r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.k = f.k + 1 JOIN ins USING (st) JOIN edits e USING (st2)
    WHERE says = '' OR fault NOT IN ('blank', 'duplicate') AND (says <> 's' OR r.i = 's') GROUP BY ALL),
best AS (SELECT f.conv_id, min({'cost': f.x.cost + ins.more, 'audit': f.x.audit || ins.letters, 'body': f.x.body || ins.body}) AS x
    FROM fold f JOIN report r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.n = f.k JOIN ins USING (st) WHERE st2 IN (0, 3) GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
    coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.x.cost, 0)::BIGINT AS cost, coalesce(b.x.audit, '') AS audit, sha256(coalesce(substr(b.x.body, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN report r ON r.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id"""
