"""Substring dedup by super-k-mers, periodic runs and hard negatives against brute-force versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazetta.llm import negatives, queries, runs, superkmers

SPACE = re.compile(r"[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, block string, hot int"


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def passages(rows):
    """(doc_id, n_words, n_removed, kept) of rows (doc_id, text); null ids are larger than all others."""
    key = lambda i: float("inf") if i is None else i
    least = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - 49):
            t = tuple(w[k : k + 50])
            least[t] = min(least.get(t, float("inf")), key(i))
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = {j for k in range(len(w) - 49) if least[tuple(w[k : k + 50])] < key(i) for j in range(k, k + 50)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def passage_rows():
    rng = random.Random(3)
    word = lambda: rng.choice("ab") * rng.randint(1, 2) if rng.random() < 0.5 else f"w{rng.randrange(4000)}é"
    shared = [[word() for _ in range(rng.randint(45, 160))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += rng.choice(shared)[rng.randint(0, 20) :] if rng.random() < 0.6 else [word() for _ in range(rng.randint(0, 90))]
        rows.append((i, rng.choice([" ", "\t\n", " \r "]).join(w)))
    tau = "a"
    for _ in range(10):
        tau += tau.translate(str.maketrans("ab", "ba"))
    other = tau.translate(str.maketrans("ab", "ba"))
    rows += [(70, " ".join([tau] * 51)), (71, " ".join([other] * 51)), (72, " ".join(["x"] * 400)), (73, " ".join(["x"] * 60)), (74, None), (75, ""), (76, " \n ")]
    rows += [rows[5], (5, rows[9][1]), (None, rows[9][1]), (None, "only here " * 30), (80, " ".join(f"long{k}" for k in range(30000))), (81, " ".join(f"long{k}" for k in range(200, 29000)))]
    return rows


@pytest.mark.parametrize("hot", [superkmers.HOT, 1])
def test_passages_against_brute_force(spark, hot):
    rows = passage_rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(5)
    got = sorted((tuple(r) for r in superkmers.remove_repeated_passages(docs, hot=hot).collect()), key=repr)
    assert got == passages(rows)
    assert sum(r[2] for r in got) > 1000


def test_passages_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(superkmers, "BLOCK_BYTES", 5000)
    monkeypatch.setattr(superkmers, "BUCKET", 20)
    rows = passage_rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)
    assert sorted((tuple(r) for r in superkmers.remove_repeated_passages(docs).collect()), key=repr) == passages(rows)


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(superkmers, "grams", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    texts = [" ".join(f"{c}{k}" for k in range(52)).encode() for c in "ab"] + [" ".join(f"a{k}" for k in range(1, 55)).encode()]
    group, string = superkmers.equal_windows(texts)
    assert string.tolist() == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2, 2]
    assert group[1] == group[6] and group[2] == group[7] and len(set(group.tolist())) == 9


def test_passages_of_no_rows(spark):
    assert superkmers.remove_repeated_passages(spark.createDataFrame([], DOCS)).count() == 0


def brute_runs(w, shortest=12):
    seen = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            b = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            e = i + p
            if e - b >= max(2 * p, shortest):
                seen.setdefault((b, e), p)
            i = max(i, b + 1)
    return sorted((b, e - b, p) for (b, e), p in seen.items())


def numbers(w):
    m = {}
    return [m.setdefault(x, len(m)) for x in w]


def test_runs_against_brute_force():
    rng = random.Random(5)

    def doc():
        n, k = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5, 30])
        w = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n > 4 else 0):
            a = rng.randrange(n)
            p, z = rng.randint(1, max(1, (n - a) // 2)), rng.randint(a, n)
            for i in range(a, z):
                w[i] = w[a + (i - a) % p]
            j = rng.randrange(n)
            size = rng.randint(0, n - max(a, j))
            w[j : j + size] = w[a : a + size]
        return numbers(w)

    total = 0
    for _ in range(150):
        docs = [doc() for _ in range(12)]
        want = [brute_runs(d) for d in docs]
        assert runs.runs_of(docs) == want
        total += sum(map(len, want))
    assert total > 1000
    fib, g = [0], [0, 1]
    while len(g) < 2000:
        fib, g = g, g + fib
    assert runs.runs_of([g, [], [0], g[:500]]) == [brute_runs(g), [], [], brute_runs(g[:500])]


def planted(i, text):
    w = words_of(text)
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    return w


def test_runs_query_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["x", "y", "zé", f"v{rng.randrange(99)}"]) for _ in range(rng.randint(0, 150)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "a b c " * 30), (202, "a b " * 30), (None, "q " * 12), (204, " \t".join(["one", "two"] * 6)), (205, "same " * 20000)]
    spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.doc_id, r.collapsed_sha256): r for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        w = planted(i, text)
        found = brute_runs(w) if len(w) < 5000 else [(0, len(w), 1)]
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        r = got[i, hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()]
        top = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *top)
        assert r.exponent_milli == (1000 * top[1] // top[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
    assert runs.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0


VECTORS = "id long, label long, q array<long>, rank int, score string"


def mined(rows, step, positives=5, negatives=10, shares=(30, 90)):
    rows = [(i, label, q) for i, label, q in rows if i is not None and label is not None and q is not None and all(x is not None and abs(x) < negatives.BOUND for x in q)]
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2], strict=False))
    out = []
    for a in (r for r in rows if r[0] % step == 0):
        best = sorted((-score(a, r), r[0], r[1]) for r in rows)
        for p, i, _ in [x for x in best if x[2] == a[1] and x[1] != a[0]][:positives]:
            good = [x for x in best if x[2] != a[1] and shares[0] * -p <= 100 * -x[0] <= shares[1] * -p][:negatives]
            out += [(a[0], i, k, n, -p, -s) for k, (s, n, _) in enumerate(good, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [3, 200, 1 << 20])
def test_negatives_against_brute_force(spark, spread):
    rng = random.Random(spread)
    centre = {k: [rng.randint(-spread, spread) for _ in range(9)] for k in range(4)}
    rows = []
    for i in range(700):
        k = 0 if rng.random() < 0.4 else rng.randrange(4)
        rows.append((i, k, [x + rng.randint(-spread, spread) for x in centre[rng.randrange(4) if rng.random() < 0.3 else k]]))
    rows += [(None, 1, [1] * 9), (701, None, [1] * 9), (702, 1, None), (703, 1, [1, None]), (704, 2, []), (705, 2, [spread]), (750, 3, [spread] * 12), (750, 3, [spread] * 12), (751, 9, [1 << 24]), (800, 77, [spread] * 9), (752, 2, rows[3][2])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS).repartition(4)
    got = negatives.mine(df, F.col("id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, got.collect()))
    assert got == mined(rows, 50) and len(got) > 200


def test_negatives_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP_BYTES", 3000)
    rng = random.Random(4)
    rows = [(i, rng.randrange(3), [rng.randint(-9, 9) + 4 for _ in range(5)]) for i in range(300)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    assert sorted(map(tuple, negatives.mine(df, F.col("id") % 10 == 0, positives=2, negatives=3, shares=(10, 95)).collect())) == mined(rows, 10, 2, 3, (10, 95))


def test_quantised_drops_what_is_not_finite(spark):
    rows = [(7, [0.5, -0.001], 9), (8, [float("nan")], 1), (9, [float("inf")], 1), (10, None, 1), (11, [1.0], None), (12, [None, 1.0], 1), (13, [], 3)]
    got = negatives.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert [tuple(r) for r in got.collect()] == [(7, 0, [128, -1]), (13, 3, [])]
    assert negatives.mine(got.limit(0), F.col("id") % 100 == 0).count() == 0
