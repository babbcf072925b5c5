"""The trie against one built from whole prefixes in plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from actaspark.llm import prefix_trie, queries
from actaspark.plans.shipping import shipped

SCHEMA = "conv_id long, turn long, role string, text string, depth long, node string, words string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, block=20):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    turns = {c: [(t[2], t[4]) for t in sorted(own)] for c, own in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % block if c >= 0 else -(-c % block))
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    nodes = defaultdict(list)
    for c, own in whole.items():
        for d in range(len(own) + 1):
            nodes[own[:d]].append(c)
    children = defaultdict(list)
    for prefix in nodes:
        if prefix:
            children[prefix[:-1]].append(prefix)
    out, leaves, saved = set(), {}, {}
    for prefix in sorted(nodes, key=len, reverse=True):
        members, below = nodes[prefix], children[prefix]
        words = len(WORD.findall(prefix[-1][1])) if prefix else 0
        leaves[prefix] = sum(leaves[b] for b in below) or 1
        saved[prefix] = (len(members) - 1) * words + sum(saved[b] for b in below)
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(prefix))))
        parent = min(nodes[prefix[:-1]]) if prefix else None
        out.add((min(members), len(prefix), parent, len(members), len(below), leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    assert len(out) == len(nodes)
    return out


def conversations(seed):
    rng, rows = random.Random(seed), []
    said = ["yes", "no", "well then", "", None, "a\tb\nc", "é " * 300, "x" * 3000]
    for c in [*range(90), *range(1000, 1030), -3, -25, -20]:
        for turn in range(rng.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, rng.choice([turn, turn, turn, None, 2]), rng.choice(["user", "assistant", None, ""]), rng.choice(said)))
    for c in range(200, 260):  # copies that end together and one that goes on
        rows += [(c, turn, "user", f"copy {turn}") for turn in range(5 + (c == 230))]
    rows += [(300, turn, "user", f"turn {turn % 7}") for turn in range(5000)]
    rows += [(400, 7, "user", "again")] * 4
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None), (61, None, None, None)]
    rng.shuffle(rows)
    return rows


def framed(spark, rows):
    return spark.createDataFrame([(*r, 9, "n", "w") for r in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_query_against_whole_prefixes(spark, tmp_path, seed, monkeypatch):
    if seed == 2:  # pieces and hot groups of small sizes
        monkeypatch.setattr(prefix_trie, "PIECE", 3)
        monkeypatch.setattr(prefix_trie, "ENDS", 7)
        monkeypatch.setattr(prefix_trie, "HOT", 20)
    rows = conversations(seed)
    framed(spark, rows).repartition(4).write.parquet(str(tmp_path / "conversations.parquet"))
    found = [tuple(r) for r in shipped(queries.queries()["op12_prefix_trie"])(spark, str(tmp_path)).collect()]
    assert Counter(found) == Counter(plain(rows))


def test_small_tables(spark):
    assert prefix_trie.trie(framed(spark, [])).count() == 0
    assert prefix_trie.trie(framed(spark, [(None, 1, "user", "a")])).count() == 0
    for rows in ([(5, 1, "user", "a b")], [(0, None, None, None)], [(40, 1, "user", "a"), (41, 1, "user", "a"), (42, 1, "user", "a")]):
        assert {tuple(r) for r in prefix_trie.trie(framed(spark, rows)).collect()} == plain(rows)
