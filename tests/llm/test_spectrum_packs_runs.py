"""Whitening, best-two-fit packing and periodic runs: by brute force, and on edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagflow.llm import bestfit, packing, runs, whiten
from tagflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def brute_runs(w, least=12):
    out = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            own = w[s : i + p]
            if len(own) >= max(least, 2 * p) and not any(own[q:] == own[:-q] for q in range(1, p)):
                out.append((s, len(own), p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_are_those_of_brute_force():
    r = random.Random(1)
    for _ in range(400):
        n, k = r.randrange(120), r.choice((1, 2, 2, 3, 5, 20))
        w = [r.randrange(k) for _ in range(n)]
        if r.random() < 0.5 and n:
            a = r.randrange(n)
            p = 1 + (n - a) // r.randrange(3, 10)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        least = r.choice((12, 12, 2, 3, 7))
        assert runs.find_runs(np.array(w, np.int64), least) == brute_runs(w, least)


def test_op13_by_brute_force(spark):
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, DATA).collect()}
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(rows) and sum(r.n_runs > 0 for r in got.values()) > 15
    for r in rows:
        w, h = (r.text or "").encode().split(), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if len(w) > 1500:
            continue  # the brute force is quadratic
        own, o = brute_runs(w), got[r.doc_id]
        gone = {i for s, n, p in own for i in range(s + p, s + n)}
        sha = lambda b: hashlib.sha256(b).hexdigest()
        assert o.runs_sha256 == sha("".join(f"{s},{n},{p}\n" for s, n, p in own).encode()) and o.n_runs == len(own)
        assert o.collapsed_sha256 == sha(b" ".join(x for i, x in enumerate(w) if i not in gone))
        if own:
            s, n, p = min(own, key=lambda x: (-x[1], x[0], x[2]))
            assert (o.start, o.length, o.period, o.exponent_milli) == (s, n, p, 1000 * n // p)
        else:
            assert (o.start, o.length, o.period, o.exponent_milli) == (None,) * 4


def test_runs_of_odd_texts(spark):
    texts = [(1, None), (2, ""), (3, " \n\t "), (None, "a b " * 6), (4, "a b " * 6), (4, "a b " * 6), (5, "x y " * 12), (6, "word " * 300_000)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in texts], "doc_id long, text string, runs string, n_words string")
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(df).collect()))
    assert got == [(0, 12, [(0, 12, 2)], "a b"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 12, [(0, 12, 2)], "a b"), (4, 12, [(0, 12, 2)], "a b"), (5, 12, [(0, 12, 1)], "x y"), (6, 300_000, [(0, 300_000, 1)], "word")]
    assert runs.periodic_runs(df.limit(0)).count() == 0
    assert {r.doc_id: r.text for r in runs.planted(df).collect() if r.doc_id is None} == {None: "a b " * 6}


def first_fit_decreasing(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        k = next((k for k, gap in enumerate(bins) if gap >= x), None)
        if k is None:
            bins.append(capacity - x)
        else:
            bins[k] -= x
    return len(bins)


def test_best_two_fit_finds_the_best_pair_and_packs_well():
    r = np.random.default_rng(1)
    for _ in range(200):
        cap = int(r.integers(5, 60))
        own = r.integers(1, cap + 1, int(r.integers(0, 150)))
        packed = bestfit.windows(own, cap)
        assert sorted(x for w in packed for x in w) == sorted(own.tolist()) and all(0 < sum(w) <= cap for w in packed)
        assert len(packed) <= first_fit_decreasing(own.tolist(), cap) + 1
        room, rows = int(r.integers(1, cap + 1)), own.tolist()
        best = max((rows[i] + rows[j] for i in range(len(rows)) for j in range(i) if rows[i] + rows[j] <= room), default=0)
        assert sum(bestfit.Classes(own, cap).best_pair(room)) == best
    # 6 is filled as 4 + 1; its smallest gives way to the pair 1 + 1 that fills the gap
    assert sorted(map(sorted, bestfit.windows(np.array([4, 3, 3]), 7))) == [[3], [3, 4]]
    assert bestfit.windows(np.array([6, 3, 2, 2]), 10) == [[6, 2, 2], [3]]


def test_op12_by_brute_force(spark):
    from tokenizers import Tokenizer

    rows = QUERIES["op12_best_two_fit"](spark, DATA).collect()
    model, by_doc, by_window = Tokenizer.from_str(packing.read_spec()), {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append(r)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert set(by_doc) == {r.doc_id for r in docs}
    total = 0
    for d in docs:
        ids = np.array([*model.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4")
        own, at = sorted(by_doc[d.doc_id], key=lambda r: r.piece), 0
        assert len(own) == -(-len(ids) // 2048) and all(r.length == 2048 for r in own[1:])
        for k, r in enumerate(own):
            assert (r.piece, r.start) == (k, at) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
        total += at
    for own in by_window.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(by_window) <= -(-total // 2048) + 3


def test_whole_packing_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 2), (2, "", 2), (None, "a", 3), (3, "word " * 30_000, 4)], "doc_id long, text string, piece int")
    got = bestfit.pack_whole(df).collect()
    assert sorted(r.length for r in got if r.doc_id in (1, 2)) == [1, 1, 1] and sum(r.doc_id is None for r in got) == 1
    long = sorted((r for r in got if r.doc_id == 3), key=lambda r: r.piece)
    assert len(long) > 10 and [r.start for r in long[:2]] == [0, long[0].length] and bestfit.pack_whole(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", range(6))
def test_spectrum_slicing_by_dense_solver(kind):
    r = np.random.default_rng(kind)
    for d in (1, 2, 7, 24, 40):
        q, _ = np.linalg.qr(r.normal(size=(d, d)))
        part = d // 3
        e = (r.exponential(size=d), np.ones(d), np.r_[np.full(part, 5.0), np.full(part, 2.0), np.full(d - 2 * part, 2 - 1e-9)], np.r_[r.exponential(size=(d + 1) // 2), np.zeros(d // 2)], 10.0 ** (-8 * np.arange(d) / d), 1 + 1e-12 * np.arange(d))[kind] * 10.0 ** r.integers(-3, 8)
        v = (q * e) @ q.T
        v = (v + v.T) / 2
        values, vectors = whiten.leading(v)
        want = np.linalg.eigvalsh(v)[::-1]
        k = min(32, int((want > whiten.RANK_SHARE * want.sum()).sum()))
        assert len(values) == k and np.abs(values - want[:k]).max() <= 1e-13 * d * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() <= 1e-6 and np.abs(v @ vectors - vectors * values).max() <= 1e-11 * want[0]
        for s in (want[0] * 1.01, want[0] * 0.37, 1e-30):
            if np.abs(want - s).min() > 1e-10 * want[0]:
                assert whiten.count_above(v, s) == (want > s).sum()


def test_op11_by_brute_force(spark):
    src = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas()
    got = QUERIES["op11_whiten"](spark, DATA).toPandas()
    x = np.floor(64 * np.array(src["embedding"].tolist(), float)).astype(int) + 10**6
    n, s = len(x), x.sum(0)
    v = (x - s / n).T @ (x - s / n) / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1][:32], p[:, ::-1][:, :32]
    own = got.pivot(index="vec_id", columns="component", values="whitened").loc[src["vec_id"]].to_numpy()
    want = (x - s / n) @ p / np.sqrt(e)
    assert np.abs(own * np.sign((own * want).sum(0)) - want).max() < 1e-8 and (got["identity_error"] < 1e-10).all()
    assert np.abs(np.cov(own.T, bias=True) - np.eye(32)).max() < 1e-10
    first = got[got["component"] == 1].set_index("vec_id").loc[src["vec_id"]]
    assert (first["deviation"].to_numpy() == ((n * x - s) ** 2).sum(1)).all() and (got["n"] == n).all()
    assert np.abs(got[got["vec_id"] == src["vec_id"][0]].sort_values("component")["explained"].to_numpy() - e / np.trace(v)).max() < 1e-12


def test_whitening_of_odd_tables(spark):
    rows = [(1, [1.0, 2.0, 5.0]), (2, None), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]), (5, [float("inf"), 1.0, 1.0]), (None, [2.0, 4.0, 5.0]), (1, [1.0, 2.0, 5.0]), (6, [9.0, -3.0, 5.0])]
    df = spark.createDataFrame([(i, e, "x", 1.0) for i, e in rows], "vec_id long, embedding array<double>, label string, whitened double")
    got = whiten.whiten(df, whiten.fit(df)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted((i, c) for i in (0, 1, 1, 6) for c in (1, 2)) and all(r.n == 4 for r in got)
    assert all(r.identity_error < 1e-9 for r in got)
    none = df.limit(0)
    assert whiten.whiten(none, whiten.fit(none)).count() == 0
    same = df.where("vec_id = 1 AND embedding IS NOT NULL")
    assert whiten.whiten(same, whiten.fit(same)).count() == 0
    with pytest.raises(ValueError):
        whiten.fit(df.unionByName(spark.createDataFrame([(7, [1.0], "x", 1.0)], df.schema)))
    far = spark.createDataFrame([(k, [float(k) * 1e8, 1.0]) for k in range(4)], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whiten.whiten(far, whiten.fit(far)).collect()} == {None}
    near = spark.createDataFrame([(k, [float(k) * 1e6, 1.0]) for k in range(4)], "vec_id long, embedding array<double>")
    x = [64 * k * 10**6 + 10**6 for k in range(4)]
    assert sorted(r.deviation for r in whiten.whiten(near, whiten.fit(near)).collect()) == sorted((4 * v - sum(x)) ** 2 for v in x)
