import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from workpulse.llm import prefix_tree as P


def rebuilt(rows):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        out[c] = own.get(first, [])[:h] + v[h:]
    return out


def brute(conversations):
    members = collections.defaultdict(list)
    for c, v in conversations.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    totals = collections.defaultdict(lambda: [0, 0])
    for k, m in members.items():
        for d in range(len(k) + 1):
            totals[k[:d]][0] += children[k] == 0
            totals[k[:d]][1] += (len(m) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(conversations[c]) == len(k))))
        above = min(members[k[:-1]]) if k else None
        out.append((min(m), len(k), above, len(m), children[k], *totals[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("sizes", [{}, {"shard_turns": 23, "queue": 3}])
def test_random_conversations(spark, sizes):
    rng = random.Random(11)
    rows = []
    for c in range(330):
        if c % 7 == 3:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 6, 9])):
            # small alphabet: many shared prefixes, conversations that end inside others, one hot first turn
            text = "hi" if t == 0 and rng.random() < 0.5 else rng.choice(["a", "b", "é😀", "", None])
            rows.append((c, None if t == 0 else t, rng.choice(["u", "u", "s", None]), text))
    rng.shuffle(rows)
    got = P.prefix_trie(P.with_shared_openings(P.turns(made(spark, rows))), **sizes)
    assert rows_of(got) == brute(rebuilt(rows))


def test_plain_trie_of_copies_and_a_long_conversation(spark):
    long = [(5000, t, "u", str(t)) for t in range(300)]
    rows = [(c, t, "u", "same") for c in range(900) for t in range(2)] + long
    got = rows_of(P.prefix_trie(P.with_root(P.turns(made(spark, rows))), shard_turns=400, queue=10))
    own = collections.defaultdict(list)
    for c, _, r, x in rows:
        own[c].append((r, x))
    assert got == brute(own)


def test_a_node_is_role_and_text(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, None, "abc"), (4, 0, "", "abc"), (5, 0, "abc", None)]
    got = P.prefix_trie(P.with_root(P.turns(made(spark, rows))))
    assert got.where("depth = 1").count() == 4 and got.where("depth = 1 and n_convs = 2").count() == 1


def test_blocks_of_ids(spark, monkeypatch):
    ends = spark.range(3000).select(F.lit(1).cast("long").alias("depth"), (F.col("id") % 2).alias("w1"), F.lit(9).cast("long").alias("w2"), F.col("id").alias("conv_id"))
    monkeypatch.setattr(P, "BLOCK_IDS", 7)
    got = {r["w1"]: r["ends_sha256"] for r in P.ends_hash(ends).collect()}
    assert got == {w: hashlib.sha256(",".join(str(i) for i in range(w, 3000, 2)).encode()).hexdigest() for w in (0, 1)}


def test_queue_spills_and_merges():
    rng = random.Random(4)
    for limit in (0, 1, 7, 10_000):
        queue, want = P.SpillingQueue(limit), collections.defaultdict(lambda: [0, 0])
        for _ in range(3000):
            key = (0, -rng.randrange(40), rng.randrange(5))
            a, b = rng.randrange(9), rng.randrange(9)
            queue.push(key, a, b)
            want[key][0] += a
            want[key][1] += b
        assert [queue.take(k) for k in sorted(want)] == [tuple(want[k]) for k in sorted(want)]
        assert not queue.heap and not queue.heads and not queue.runs
    queue = P.SpillingQueue(2)
    queue.push((0, -3, 0), 1, 1)
    with pytest.raises(RuntimeError):
        queue.take((0, -2, 0))


def test_awkward_tables(spark):
    rows = [(None, 1, "u", "x"), (7, None, None, None), (7, None, None, None), (7, 3, "u", "y" * 30_000), (-150, 1, "u", "x"), (-100, 1, "v", "w"), (-100, 2, "v", "w")]
    rows += rows[3:5]
    table = made(spark, rows).withColumn("depth", F.lit("d")).withColumn("w1", F.lit("w")).withColumn("pos", F.lit("p"))
    assert rows_of(P.prefix_trie(P.with_shared_openings(P.turns(table)))) == brute(rebuilt(rows))
    assert P.prefix_trie(P.with_shared_openings(P.turns(table.where("false")))).count() == 0
    assert P.prefix_trie(P.with_root(P.turns(table.where("conv_id is null")))).count() == 0
