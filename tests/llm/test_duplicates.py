import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from actaspark.llm import graph, line_dedup, minhash
from actaspark.llm.common import odd_sketches, stored


def roots(n, edges):
    par = list(range(n))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        par[y] = x
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(100, 160)]
    edges = path + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)] + [(170, i) for i in range(171, 200)]
    want = roots(200, edges)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for i in range(200):
        assert got.get(i, i) == want[i]
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_linked_groups_lose_no_link(spark):
    """Buckets whose members are linked in chains that no pivot sees as a whole."""
    rng = random.Random(2)
    links = {(i, i + 1) for i in range(0, 39) if i != 20} | {(50, 59)}
    members = [(1, i) for i in range(0, 45)] + [(2, i) for i in range(45, 60)] + [(3, rng.randrange(45)) for _ in range(10)]
    buckets = stored(spark.createDataFrame(members, "key long, node long").distinct(), "test-buckets")
    good = spark.createDataFrame(sorted(links), "a long, b long")
    features = spark.range(60).select(F.col("id").alias("node"), F.col("id").alias("mark"))
    maybe = lambda x, y: F.abs(F.col(f"{x}.mark") - F.col(f"{y}.mark")) < 10
    got = {r["node"]: r["root"] for r in graph.linked_groups(buckets, features, maybe, lambda p: p.join(good, ["a", "b"], "left_semi"), rounds=2).collect()}
    want = roots(60, links)
    for i in range(60):
        assert got.get(i, i) == want[i], i


def exact(rows, width, percent=80):
    def words(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")

    sets = []
    for _, text in rows:
        w = [x for x in words(text) if x]
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    group = roots(len(rows), edges)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[group[k]] = min(doc, least.get(group[k], doc))
    return [(doc, len(sets[k]), least.get(group[k]) if sets[k] else doc) for k, (doc, _) in enumerate(rows)]


@pytest.mark.parametrize("width", [4, 5])
def test_near_groups(odd_docs, no_docs, width):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_groups(odd_docs, width).collect()]
    assert sorted(map(str, got)) == sorted(map(str, exact(rows, width)))
    assert minhash.near_groups(no_docs, width).count() == 0


def test_many_near_copies(spark):
    """A large group of near copies around one base, where copies are further from each other than from the base."""
    rng = random.Random(6)
    base, rows = [f"w{i}" for i in range(120)], []
    for d in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_groups(df, 5).collect())
    assert got == sorted(exact(rows, 5))


def test_estimate(spark):
    rng = np.random.default_rng(4)
    hasher = minhash.MinHasher(240)
    for share in (0.3, 0.8, 0.95):
        both = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
        n = int(2000 * share)
        rest = (2000 - n) // 2
        a, b = both[: n + rest], np.concatenate([both[:n], both[n + rest :]])
        planes = minhash.bit_planes(hasher.minima([a, b]))
        row = spark.createDataFrame([(planes[0].tolist(), planes[1].tolist())], "a array<long>, b array<long>")
        got = row.select(minhash.estimate(F.col("a"), F.col("b"), 240).alias("e")).first()["e"]
        assert abs(got - share) < 0.13


def test_one_of_each(odd_docs):
    left = minhash.one_of_each(odd_docs)
    assert left.columns == odd_docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert 60 in ids and 61 not in ids and None in ids and {75, 76, 77} <= set(ids)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_within():
    rng = random.Random(5)
    for _ in range(2000):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 9))]
        b = [rng.choice("abc") for _ in range(rng.randint(0, 9))]
        d, most = edits(a, b), rng.randint(0, 6)
        assert line_dedup.within(a, b, most) == (d <= most), (a, b, d, most)


def test_simhash():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    starts = np.array([0, 7, 20])
    got = line_dedup.simhash(words, starts)
    huge = np.concatenate([np.full(70_000, words[0]), np.full(69_000, words[1]), words[2:5]])
    assert line_dedup.simhash(huge, np.array([0, 139_000]))[0, 0] == np.int64(words[0])
    for k, (a, b) in enumerate([(0, 7), (7, 20), (20, 50)]):
        for bit in range(64):
            ones = sum(int(w) >> bit & 1 for w in words[a:b])
            assert (int(got[k, 0]) >> bit & 1) == (ones * 2 > b - a)


def line_rows(docs):
    out = []
    for r in docs.dropDuplicates(["doc_id", "text"]).collect():
        for i, line in enumerate((r["text"] or "").lower().split("\n")):
            words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in line).split(" ")
            out.append((r["doc_id"], i, tuple(w.encode() for w in words if w)))
    return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


def test_line_classes(odd_docs, no_docs):
    rows = line_rows(odd_docs)
    marks = {}
    import xxhash

    for _, _, w in rows:
        if len(w) >= 5 and w not in marks:
            h = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, w)), ">u8").astype(np.uint64)
            marks[w] = line_dedup.simhash(h, np.array([0])).view(np.uint64)[0]
    nodes = list(marks)
    near = [(i, j) for i in range(len(nodes)) for j in range(i) if sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(marks[nodes[i]], marks[nodes[j]])) <= 3 and edits(nodes[i], nodes[j]) <= 0.2 * max(len(nodes[i]), len(nodes[j])) + 1e-9]
    group = dict(zip(nodes, roots(len(nodes), near)))
    first, want = {}, {}
    for doc, i, w in rows:
        want[doc, i] = first.setdefault(group[w], (doc, i)) if w in group else (doc, i)
    assert near
    got = {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"], r["kept"]) for r in line_dedup.line_classes(odd_docs).collect()}
    assert got == {k: (*v, k == v) for k, v in want.items()}
    assert line_dedup.line_classes(no_docs).count() == 0


def test_without_repeats(odd_docs, no_docs):
    left = line_dedup.without_repeats(odd_docs)
    assert left.columns == odd_docs.columns
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    assert 60 in texts and 79 not in texts and texts[75] is None and texts[77] == " \n\t \n"
    assert line_dedup.without_repeats(no_docs).count() == 0


def test_line_groups_find_similar_lines(spark):
    """Lines of 5 to 50 words with edits at random and at even places: what brute force links is linked."""
    rng = random.Random(8)
    rows = []
    for n in [*range(5, 51), 5, 5, 5, 6, 10]:
        base = [f"w{rng.randrange(3000)}" for _ in range(n)]
        rows.append(base)
        for even in (False, True):
            w, e = list(base), rng.randint(1, n // 5)
            for at in range(2, 5 * e, 5) if even else rng.sample(range(n), e):
                w[at] = f"x{rng.randrange(3000)}"
            rows.append(w)
        rows += [base[:2] + ["more"] + base[2:], [f"w{rng.randrange(3000)}" for _ in range(n)]]
    want = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if edits(rows[i], rows[j]) <= 0.2 * max(len(rows[i]), len(rows[j])) + 1e-9])
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_doc_id"] for r in line_dedup.line_groups(docs).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_line_groups_of_short_and_unspaced_lines(spark):
    """Equal lines go however short they are; without blanks, characters are compared."""
    long = "我们今天在这里讨论如何删除重复的文本行"
    texts = ["All rights reserved\n\n----\nunlike", "all rights, reserved.\n\n----\n====", "ปีใหม่ไทย\n" + long, "ปีใหม่ไทย\n" + long.replace("今", "明"), "全く別の行です\n \t"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"]) for r in line_dedup.line_groups(docs).collect()}
    linked = {(1, 0): (0, 0), (1, 2): (0, 2), (3, 0): (2, 0), (3, 1): (2, 1)}
    assert got == {(d, i): linked.get((d, i), (d, i)) for d, t in enumerate(texts) for i in range(t.count("\n") + 1)}


def test_rows_without_an_id_or_with_one_id_twice(spark):
    rng = random.Random(9)
    line = lambda n=12: " ".join(f"w{rng.randrange(9000)}" for _ in range(n))
    shared, a, b, c, d = (line() for _ in range(5))
    rows = [(None, f"{a}\n{shared}"), (None, f"{b}\n{shared}"), (7, f"{c}\n{a}"), (7, f"{d}\nown line of this text")]
    left = line_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = [r["text"] for r in left.collect()]
    want = [a, b, c, d, "own line of this text", shared]
    assert sorted(x for t in texts for x in t.split("\n")) == sorted(want)
    x, y, z, near = line(60), line(60), line(60), line(60)
    rows = [(3, x), (7, x), (7, y), (None, z), (None, z), (None, near), (None, near + " more"), (None, x), (None, None), (None, None)]
    left = minhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((str(r["doc_id"]), str(r["text"]).removesuffix(" more")) for r in left.collect())
    assert got == sorted([("3", x), ("7", y), ("None", z), ("None", near), ("None", "None"), ("None", "None")])


def test_line_groups_against_edit_distance(spark):
    """Links by brute force over all pairs, without SimHash and keys."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    lines = []
    for n in [5, 6, 8, 10, 13, 17, 22, 30, 40, 50] * 6:
        line = rng.choices(vocabulary, k=n)
        lines.append(line)
        for share in (0.0, 1.0):  # one edit, and as many as a link allows
            other = list(line)
            for _ in range(max(1, int(share * 0.2 * n))):
                at = rng.randrange(len(other))
                other[at : at + rng.choice((0, 1, 1))] = rng.choices(vocabulary, k=1)
            lines.append(other)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(lines)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_doc_id"] for r in line_dedup.line_groups(docs).collect()}
    linked = [(i, j) for i in range(len(lines)) for j in range(i) if line_dedup.similar(" ".join(lines[i]), " ".join(lines[j]))]
    assert len(linked) > 100
    assert sum(got[i] == got[j] for i, j in linked) >= 0.97 * len(linked)
    root = list(range(len(lines)))
    for i, j in linked:
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    assert all(root[i] == root[got[i]] for i in got)  # no group joins lines that no chain of links joins


def test_odd_sketches_bound_differences(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 900, np.uint64)
    sets = [np.unique(base[rng.random(900) < p]) for p in (0.2, 0.5, 0.9, 0.95, 1.0)]
    marks = odd_sketches(np.concatenate(sets), np.array([len(s) for s in sets]), 1024)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            bits = int(np.unpackbits((marks[i] ^ marks[j]).view(np.uint8)).sum())
            assert bits <= len(np.setxor1d(x, y)) and (i != j or bits == 0)


def test_many_nearly_linked(spark):
    """A base and copies that are near it but mostly not near each other: as by brute force over all pairs."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(90):
        own = list(base)
        for at in rng.sample(range(120), rng.randint(1, 6)):
            own[at] = f"x{i}-{at}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(minhash.shingles(t, 4).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_groups(docs, width=4).collect()}
    assert got == dict(enumerate(root))


def replaced(words, kind, rng, vocabulary):
    """A fifth of the words replaced: at random places, at even distances, or the longest ones by others as long."""
    n, out = len(words), list(words)
    places = {"random": rng.sample(range(n), n // 5), "even": range(2, 5 * (n // 5), 5), "longest": sorted(range(n), key=lambda i: -len(words[i]))[: n // 5]}
    for i in places[kind]:
        out[i] = rng.choice(vocabulary) if kind != "longest" else b"%d" % rng.randrange(10**6) + b"z" * max(1, len(words[i]) - 6)
    return out


def keys_and_mark(words, exact=False):
    hashes, letters = line_dedup._hashes([words]), np.array([len(w) for w in words], np.int32)
    keys = line_dedup.block_keys(hashes, letters, np.array([0]), np.array([len(words)]), exact)[1]
    return set(keys.tolist()), int(line_dedup.simhash(hashes, np.array([0]), 1)[0, 0])


def test_keys_needed_is_the_pigeonhole_number():
    for n in range(5, 2000):
        assert line_dedup.keys_needed(np.array([n]))[0] == max(3 * (m // 5) - (m - n) for m in range(n, n + n // 4 + 1)) + 1


@pytest.mark.parametrize("kind", ["random", "even", "longest"])
def test_similar_real_lines_share_keys_at_any_length(kind):
    """Lines of real documents, and long ones joined from them, with the most edits that a link allows."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    lines = sorted({tuple(w) for t in texts for w in line_dedup.line_words(t) if len(w) >= 15})
    rng = random.Random(11)
    vocabulary = [w for line in rng.sample(lines, 300) for w in line]
    for low, high in ((15, 25), (25, 50), (50, 100), (100, 300), (300, 600), (600, 1500)):
        own = [list(x) for x in lines if low <= len(x) < high]
        own = rng.sample(own, min(100, len(own)))
        while len(own) < 100:
            joined = []
            while len(joined) < low:
                joined += rng.choice(lines)
            own.append(joined[: high - 1])
        near = exact = 0
        for words in own:
            other = replaced(words, kind, rng, vocabulary)
            (x, a), (y, b) = keys_and_mark(words), keys_and_mark(other)
            near += bool(x & y) and ((a ^ b) & (2**64 - 1)).bit_count() <= line_dedup.NEAR
            exact += bool(keys_and_mark(words, True)[0] & keys_and_mark(other, True)[0])
        assert near >= 93, (low, near)
        assert exact == 100


def test_exact_keys_lose_no_group(spark):
    """Long lines that repeat a sentence, near each other only by runs that few keys would leave out: as by brute force."""
    rng = random.Random(5)
    sentence = [f"word{i}" for i in range(20)]
    rows = []
    for d in range(24):
        w = sentence * (2 + d % 5)
        for i in rng.sample(range(len(w)), len(w) // (5 + d % 7)):
            w[i] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    got = line_dedup.line_groups(spark.createDataFrame(rows, "doc_id long, text string"), exact=True).collect()
    links = [(i, j) for i in range(24) for j in range(i) if line_dedup.similar(rows[i][1], rows[j][1])]
    assert links and sorted((r["doc_id"], r["class_doc_id"]) for r in got) == list(enumerate(roots(24, links)))


def test_within_by_bits():
    """As the furthest places on diagonals and the full table say, at and beyond the limit, and soon for long lines."""
    rng = random.Random(6)
    for _ in range(1500):
        a, b = ([rng.choice("abcdefgh"[: rng.choice((2, 8))]) for _ in range(rng.randint(1, 70))] for _ in range(2))
        if rng.random() < 0.7:
            b = list(a)
            for _ in range(rng.randint(0, 9)):
                at = rng.randrange(len(b) + 1)
                b[at : at + rng.choice((0, 1, 1))] = rng.choices("abcxyz", k=rng.choice((0, 1, 1)))
        true = edits(a, b)
        for most in (true - 1, true, true + 1):
            assert line_dedup.within(a, b, most) == (true <= most)
            if a and b and most >= 0:
                assert line_dedup._within_by_bits(a, b, most) == line_dedup._within_by_diagonals(a, b, most) == (true <= most)
    line = [f"w{rng.randrange(500)}" for _ in range(6000)]
    other, far = list(line), rng.sample(line, len(line))
    for i in rng.sample(range(6000), 1200):
        other[i] = "x"
    start = time.process_time()
    assert line_dedup.similar(" ".join(line), " ".join(other)) and not line_dedup.similar(" ".join(line), " ".join(far))
    assert time.process_time() - start < 1.5


def test_query_and_pipeline_lose_no_similar_lines(spark, tmp_path):
    """Pairs with the most edits that a link allows, which share none of the keys that are taken by default."""
    import corpus_pipeline
    from actaspark.llm.queries import op5_simhash_lines

    rng, pairs = random.Random(12), []
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 9))).encode()
    while len(pairs) < 12:
        words = [word() for _ in range(45)]
        for _ in range(60):
            other = replaced(words, "random", rng, [word() for _ in range(50)])
            if not keys_and_mark(words)[0] & keys_and_mark(other)[0]:
                pairs.append((words, other))
                break
    texts = [b" ".join(w).decode() for pair in pairs for w in pair]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["class_doc_id"] for r in op5_simhash_lines(spark, str(tmp_path)).collect()}
    assert got == {i: i // 2 * 2 for i in range(24)}
    left = corpus_pipeline.line_dedup_stage(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(0, 24, 2))


def test_dealt_runs_lose_no_link():
    """Lines at the most edits that a link allows: each shares as many of the dealt keys as is asked of it, one of them needed by both."""
    from actaspark.llm import shared_runs

    rng = random.Random(8)

    def dealt(words):
        data = b" ".join(words)
        _, sizes, first, letters, data = line_dedup._laid_out([data.decode()])
        assert sizes.tolist() == [len(words)]
        line, runs, place, _, ends = line_dedup._ordered_runs(line_dedup._word_hashes(data, first, letters), letters, np.array([0]), sizes)
        needed = line_dedup.keys_needed(sizes)
        keys = set(runs[place < shared_runs.keys_dealt(sizes, needed)[0]].tolist())
        return keys | set(ends.tolist()), set(runs[place < needed[0]].tolist()) | set(ends.tolist()), shared_runs.least_shared(sizes, needed, np.array([len(line)]))[0], shared_runs.length_code(sizes)[0]

    for n in [*range(5, 60), 100, 255, 700]:
        for kind in range(6):
            x = [f"word{rng.randrange(10 * n if kind else 6)}".encode() for _ in range(n)]
            y = list(x)
            for i in range(2, n, 5) if kind < 3 else rng.sample(range(n), n // 5):
                y[i : i + 1] = [[b"x%d" % i], [], [b"x%d" % i, *y[i : i + 1]]][kind % 3]
            if len(y) < 5 or not line_dedup.similar(b" ".join(x).decode(), b" ".join(y).decode()):
                continue
            (a, a_needed, a_least, a_code), (b, b_needed, b_least, b_code) = dealt(x), dealt(y)
            assert len(a & b) >= max(a_least, b_least), (n, kind)
            assert a_needed & b_needed and abs(int(a_code) - int(b_code)) <= shared_runs.LENGTHS


def test_words_of_all_lines_at_once():
    texts = [None, "", "  \n--- \n;", "Été, 今天天气 ok\t\x0b x\n\n a  b ", "\n", "w" * 300 + " " + "z" * 64 + " 123456789 " + "ab" * 4, "end\n"]
    counts, sizes, first, letters, data = line_dedup._laid_out(texts)
    lines = [w for t in texts for w in line_dedup.line_words(t)]
    assert counts.tolist() == [len(line_dedup.line_words(t)) for t in texts] and sizes.tolist() == [len(w) for w in lines]
    assert [data[i : i + k] for i, k in zip(first, letters)] == [w for own in lines for w in own]
    signs = [s for t in texts for s in line_dedup._signs(t)]
    assert line_dedup._names(texts, counts, sizes, first, letters, data) == [b" ".join(w) or (s and b"\n" + s) for w, s in zip(lines, signs)]
    words = [b"a", b"a" * 7, b"a" * 8, b"a" * 9, b"a" * 64, b"a" * 65, b"a" * 66, b"a"]
    _, _, first, letters, data = line_dedup._laid_out([b" ".join(words).decode()])
    hashes = line_dedup._word_hashes(data, first, letters).tolist()
    assert hashes[0] == hashes[-1] and len(set(hashes)) == len(set(words))


def test_lines_of_repeated_words_are_told_apart_before_they_are_pairs():
    rng = random.Random(5)
    junk = lambda words, times: [w for w in words for _ in range(times)]
    lines = []
    for times, n in ((28, 8), (20, 40), (40, 60)):
        for _ in range(6):
            lines.append(junk(["the", *("".join(rng.choices("abcdefghij", k=6)) for _ in range(n - 1))], times))
    linked = [list(lines[0]), list(lines[12])]
    linked[0][50:60] = ["other"] * 10
    linked[1][100:500] = ["other"] * 400
    lines = [[w.encode() for w in line] for line in [*lines, *linked]]
    lines.sort(key=len)
    sizes = np.array([len(x) for x in lines])
    bags = line_dedup._bags(line_dedup._bag_lists(line_dedup._hashes(lines), sizes))
    top = line_dedup._alike_sets(np.zeros(len(lines), np.int64), sizes, *bags)
    want = {(i, j) for i in range(len(lines)) for j in range(i) if line_dedup.within(lines[i], lines[j], len(lines[i]) // 5)}
    assert len(want) == 2
    assert {(i, j) for i in range(len(lines)) for j in range(i) if top[i] == top[j]} == want


def test_bags_of_words_bound_differences():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ([rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.choice((5, 9, 300, 700)))] for _ in range(2))
        b = b if rng.random() < 0.5 else [rng.choice("xyz") if rng.random() < 0.1 else w for w in a]
        x, y = line_dedup.Counter(a), line_dedup.Counter(b)
        differ = sum(((x - y) + (y - x)).values())
        lines = [[w.encode() for w in a], [w.encode() for w in b]]
        odd, counts, row = line_dedup._bags(line_dedup._bag_lists(line_dedup._hashes(lines), np.array([len(a), len(b)])))
        assert np.bitwise_count(odd[0] ^ odd[1]).sum() <= differ
        if (row >= 0).all():
            assert np.abs(counts[0] - counts[1]).sum() <= differ


def test_places_of_first_occurrences_are_in_the_bitmap(spark):
    rows = [(None if i % 50 == 0 else i * 7919 - 40_000, i % 13) for i in range(2000)]
    known = spark.createDataFrame([((d, 0, n), n) for d, n in rows], "first struct<doc_id: long, row: long, line_no: int>, n int")
    places = line_dedup._places(known)
    bits = line_dedup._place_bits(pa.array([d for d, _ in rows], pa.int64()), np.array([n for _, n in rows]), len(places) << 6)
    assert ((places[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1)).all()
    assert np.bitwise_count(places).sum() <= 2 * len(rows)
    assert not line_dedup._places(known.limit(0)).any()
