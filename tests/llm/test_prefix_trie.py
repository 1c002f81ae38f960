"""The prefix trie against plain dictionaries, the z-fast trie against all prefixes."""

import hashlib
import random
import zlib

import pytest

from lendscore.llm import prefix_trie as op
from lendscore.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuilt=True):
    """Nodes of the (rebuilt) conversations, by dictionaries of prefixes."""
    turns = {}
    for c, t, role, text in sorted((r for r in rows if r[0] is not None),
                                   key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns.setdefault(c, []).append((role or "", text or ""))
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple((turns.get(c - c % 5, [])[:h] + turns[c][h:]) if rebuilt else turns[c])
    members = {}
    for c, seq in sorted(whole.items()):
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = saved.get(p, 0) + own
        leaves[p] = leaves.get(p, 0) or 1
        if p:
            up = p[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[p]
            saved[up] = saved.get(up, 0) + saved[p]
    ends = {p: ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p)) for p, m in members.items()}
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in members.items())


def result(spark, tmp_path, rows):
    path = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(f"{path}/conversations.parquet")
    got = queries.op11_prefix_trie(spark, path).select(*COLUMNS).collect()
    return sorted(tuple(-1 if k == 2 and v is None else v for k, v in enumerate(r)) for r in got)


def talks(seed, n, words="ab", most=14):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        length = rng.randrange(1, most)
        if c % 7 == 3:
            length = 3
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(words) if c % 7 != 3 else "same")
                 for t in range(length)]
    return rows


def test_z_fast_trie_finds_the_extents_of_all_prefixes():
    rng = random.Random(8)
    for _ in range(60):
        seqs = {tuple(rng.choice("ab") for _ in range(rng.randrange(1, rng.choice([4, 40])))) for _ in range(30)}
        trie = op.ZFastTrie(0)
        for s in seqs:
            path = [s[:d] for d in range(len(s) + 1)]
            node, depth = trie.locate(path, len(s))
            assert trie.top[node] <= depth <= trie.extent[node] or node == 0
            trie.insert(path, len(s))
            node, depth = trie.locate(path, len(s))
            assert depth == len(s) == trie.extent[node]
        prefixes = {s[:d] for s in seqs for d in range(1, len(s) + 1)}
        follow = {p: {q for q in prefixes if len(q) == len(p) + 1 and q[:-1] == p} for p in prefixes}
        assert sorted(trie.extents()) == sorted(p for p in prefixes if p in seqs or len(follow[p]) > 1)
        tops = {(trie.top[i], trie.extent[i]) for i in range(1, len(trie.top))}
        assert all(a < b for a, b in tops)


def test_fattest_number():
    for a in range(40):
        for b in range(a + 1, 60):
            power = lambda x: x & -x
            assert power(op.fattest(a, b)) == max(map(power, range(a + 1, b + 1))) and a < op.fattest(a, b) <= b


@pytest.mark.parametrize("part, stretch", [(200_000, 4096), (25, 4096), (25, 3)])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, part, stretch):
    monkeypatch.setattr(op, "PART_TURNS", part)
    monkeypatch.setattr(op, "STRETCH", stretch)
    monkeypatch.setattr(op, "CHUNK", 5)
    rows = talks(part + stretch, 80)
    assert result(spark, tmp_path, rows) == brute(rows)


def test_hot_first_turn_and_long_conversations_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "PART_TURNS", 60)
    rows = [(c, t, "user", "hello" if t == 0 else f"t{t}" if t < c % 40 else f"{c}") for c in range(0, 300, 5) for t in range(c % 41 + 1)]
    rows += [(c, t, "user", f"t{t}") for c in (500, 505) for t in range(60)]
    assert result(spark, tmp_path, rows) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = [(5, None, "user", "first"), (5, 0, None, None), (5, 0, None, None), (5, 3, "user", "é" * 9), (5, 2, "a", "b"),
            (6, 1, "", ""), (7, 1, "user", "x"), (7, 1, "user", "a"), (None, 1, "user", "lost"), (None, None, None, None),
            (12, 0, "user", "y" * 100_000), (13, 0, "user", "y" * 100_000), (14, 0, "a", "bc"), (10, 0, "ab", "c"),
            (28, 0, "user", "gone"), (31, 0, "user", "gone")]
    got = result(spark, tmp_path, rows)
    assert got == brute(rows)
    assert any(zlib.crc32(str(c).encode()) % 9 and c - c % 5 not in {r[0] for r in rows} for c in (28, 31))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.nodes(op.facts(empty), empty.select("conv_id")).collect() == []
    rows = talks(3, 9)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'x' AS {c}" for c in ("pos", "d", "lo", "hi", "n", "depth", "n_bytes")])
    turns = op.facts(df)
    got = op.nodes(turns, df.select("conv_id")).withColumnRenamed("saved_bytes", "saved_tokens").select(*COLUMNS).collect()
    assert sorted(tuple(-1 if k == 2 and v is None else v for k, v in enumerate(r)) for r in got) == brute(rows, False)


def test_query_on_the_given_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_prefix_trie(spark, path).select(*COLUMNS).collect()
    assert sorted(tuple(-1 if k == 2 and v is None else v for k, v in enumerate(r)) for r in got) == brute(rows)
