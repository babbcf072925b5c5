"""Stored search against a plain search over all words."""

import random
from itertools import product

import pytest

from actaspark.operators import postings
from actaspark.operators.search import typos_allowed

WORDS = ["alpha", "alphabet", "beta", "gamma", "delta", "omega", "repository", "repositories", "licence", "license", "a", "b7", "été", "xx"]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def plain(docs, query, limit=20):
    wanted = list(dict.fromkeys(query.lower().split()))
    out = []
    for key, attributes in docs.items():
        hits = {}
        for rank, words in enumerate(attributes):
            for pos, word in enumerate(words):
                for w in wanted:
                    d = 0 if word == w or (w == wanted[-1] and word.startswith(w)) else edits(word, w)
                    if d <= (typos_allowed(w) if d else 0):
                        hits.setdefault(w, []).append((d, rank, pos))
        if hits:
            near = [max(p[2] for p in chosen) - min(p[2] for p in chosen) + 1 - len(hits) for chosen in product(*hits.values()) if len({p[1] for p in chosen}) == 1]
            out.append((-len(hits), sum(min(h)[0] for h in hits.values()), min((max(n, 0) for n in near), default=None), min(h[1] for own in hits.values() for h in own), key))
    out.sort(key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0, r[3], r[4]))
    return [(k, -n, t, p, r) for n, t, p, r, k in out[:limit]]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(2)
    docs = {i: [rng.choices(WORDS, k=rng.randint(0, 9)), rng.choices(WORDS, k=rng.randint(0, 3))] for i in range(150)}
    df = spark.createDataFrame([(i, " ".join(a), b) for i, (a, b) in docs.items()] + [(900, None, None)], "doc_id long, text string, tags array<string>")
    path = f"file://{tmp_path_factory.mktemp('index')}/i"
    postings.build(df, "doc_id", ("text", "tags"), path)
    return docs, path


@pytest.mark.parametrize("query", ["alpha beta", "alhpa repositoy", "licence omega alph", "repo", "été gamma", "nothing", "delta delta b", "repositorys licensed"])
def test_search(spark, stored, query, monkeypatch):
    docs, path = stored
    want = plain(docs, query)
    assert [tuple(r) for r in postings.search(spark, path, f"={query}").collect()] == want
    monkeypatch.setattr(postings, "NAMED", 0)  # corrected words joined
    assert [tuple(r) for r in postings.search(spark, path, query).collect()] == want


def test_empty_query(spark, stored):
    assert postings.search(spark, stored[1], "= ").collect() == []


def test_deletions_meet_within_two_edits(spark):
    rng = random.Random(3)
    for _ in range(2000):
        a = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "c"])
        assert postings.plain_deletions(a) & postings.plain_deletions("".join(b))
    rows = spark.createDataFrame([(w,) for w in WORDS], "w string").select("w", postings.deletions(postings.F.col("w"))).collect()
    assert all(set(cut) == postings.plain_deletions(w) for w, cut in rows)


def test_postings_are_pruned(spark, stored):
    hits = postings.matched(spark, stored[1], ["alpha", "beta"])
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [folder" in plan and "PushedFilters: [In(word" in plan
