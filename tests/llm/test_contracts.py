"""The registered queries by brute force on their folds, and the inputs that once went wrong."""

import collections
import hashlib
import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagflow.llm import decontaminate, gam, packing, rules, secrets, simhash, toxicity, warc
from tagflow.llm.common import fold
from tagflow.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture
def short_training(monkeypatch):
    """Where any toxicity model will do."""
    monkeypatch.setattr(toxicity, "STEPS", 120)


def rest(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_op1_by_brute_force(spark, docs, labels):
    got = {r.doc_id: r for r in QUERIES["op1_quality_gam"](spark, DATA).collect()}
    model = gam.train(docs, labels, "quality", fold("doc_id", 5) != 0)
    assert set(got) == {r.doc_id for r in docs.collect()}
    for r in docs.collect():
        x, z = gam.features(r.text or ""), model.base
        place = lambda cuts, v: sum(c <= v for c in cuts)
        for k, (cuts, table) in enumerate(zip(model.cuts, model.tables)):
            z += table[place(cuts, x[k])]
        for i, j, ci, cj, table in model.pairs:
            z += table[place(ci, x[i]), place(cj, x[j])]
        p = 1 / (1 + np.exp(-z))
        o = got[r.doc_id]
        assert abs(o.score - p) < 1e-9 and o.held_out == (rest(r.doc_id, 5) == 0) and o.predicted == int(o.score >= 0.3)


def test_op4_by_brute_force(spark, docs, labels, short_training):
    got = {r.doc_id: r for r in QUERIES["op4_toxicity_cnn"](spark, DATA).collect()}
    m = toxicity.train(docs, labels, "toxic", fold("doc_id", 4) != 2)
    for r in docs.collect():
        words = (r.text or "").lower().encode().translate(toxicity._TO_SPACE).split()
        if len(words) > 400:
            continue
        v = [sum(t[row] for t, row in zip(m.tables, (zlib.crc32(w) & 0xFFFF, zlib.crc32(w) >> 16, zlib.crc32(w[:4]) >> 16, zlib.crc32(w[:5]) & 0xFFFF))) for w in words] + [np.zeros(toxicity.DIM)] * 2
        top = np.full(len(m.v), -np.inf)
        for at in range(len(v) - 1 if words else 1):
            for k, w in enumerate(toxicity.WIDTHS):
                part = sum((v[at + i] if at + i < len(v) else np.zeros(toxicity.DIM)) @ m.w[w][i] for i in range(w))
                own = slice(k * toxicity.FILTERS, (k + 1) * toxicity.FILTERS)
                top[own] = np.maximum(top[own], part + m.b[own])
        # windows may start on the padding after the text
        p = 1 / (1 + np.exp(-(np.maximum(top, 0) @ m.v + m.c)))
        o = got[r.doc_id]
        assert abs(o.score - p) < 0.02 and o.held_out == (rest(r.doc_id, 4) == 2) and o.predicted == int(o.score >= 0.3)


def test_toxicity_finds_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in QUERIES["op4_toxicity_cnn"](spark, "/root/testdata/sf0.1").collect()}
    held = [(got[r.doc_id].toxic, r.toxic) for r in labels.collect() if rest(r.doc_id, 4) == 2]
    caught = [t for t, y in held if y == 1]
    clean = [t for t, y in held if y == 0]
    assert np.mean(caught) >= 0.9 and np.mean(clean) <= 0.05 and docs.count() == len(got)


def test_op9_by_brute_force(spark, docs, labels):
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, DATA).collect()}
    model = rules.train(docs, labels, "quality", fold("doc_id", 5) != 0)
    for r in docs.collect():
        o, t = got[r.doc_id], r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        runs = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        again = {i + k for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for k in range(8)}
        failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
        assert (o.n_words, o.n_repeat_words, o.base_failed) == (len(words), len(again), failed)
        w = [zlib.crc32(x.encode()) for x in words]
        pairs = [((a * 2246822519) ^ (b * 3266489917)) & 0xFFFFFFFF for a, b in zip(w, w[1:])]
        chars = []
        for i in range(len(t) - 3):
            key = 0
            for c in t[i : i + 4]:
                key = (key * 16777619 + ord(c)) & 0xFFFFFFFF
            chars.append(key)
        z = model.bias
        for keys, bits, weight in zip((w, pairs, chars), rules.BITS, model.weights):
            if keys:
                z += rules.SCALE * np.mean([float(weight[((k * 2654435761) & 0xFFFFFFFF) >> (32 - bits)]) for k in keys])
        p = 1 / (1 + np.exp(-np.clip(model.slope * z + model.shift, -30, 30)))
        assert abs(o.probability - p) < 1e-4 and o.kept == (not failed and o.probability >= 0.3)


def test_op8_by_brute_force(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op8_secrets"](spark, DATA).collect()}
    table, n = secrets.train(secrets.labelled_samples(docs)), len(secrets.ALPHABET)
    assign = re.compile(secrets.ASSIGN, re.ASCII)
    for r in docs.collect():
        t = free = r.text or ""
        spans = []
        for kind, (pattern, good) in enumerate(((assign, lambda m: len(m[2]) >= 12), (re.compile(secrets.ACCESS), lambda m: True), (re.compile(secrets.HEX), lambda m: True))):
            spans += [(m.start(), kind, m.end()) for m in pattern.finditer(t) if good(m)]
            free = pattern.sub(lambda m: " " * len(m[0]) if good(m) else m[0], free)
        base = sorted(spans)
        for m in re.finditer(secrets.CANDIDATE, free):
            at = [secrets.ALPHABET.index(c) for c in m[0]]
            if sum(table[a * n + b] for a, b in zip(at, at[1:])) / (len(at) - 1) >= secrets.RATIO:
                spans.append((m.start(), 3, m.end()))
        told = lambda x: ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(x))
        o = got[r.doc_id]
        assert o.base_sha256 == hashlib.sha256(told(base).encode()).hexdigest() and o.spans == told(spans)
        assert [o.n_assign, o.n_access, o.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]


def test_character_models_tell_random_from_ordinary(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    table, r = secrets.train(secrets.labelled_samples(docs)), random.Random(1)
    words = sorted({w.lower() for (t,) in docs.select("text").limit(500).collect() for w in (t or "").split() if w.isalpha() and w.isascii()})
    letters = string.ascii_letters + string.digits
    rows = [(True, "".join(r.choice(letters) for _ in range(r.choice((16, 20, 32, 40))))) for _ in range(1000)]
    while len(rows) < 2000:
        join, own = r.choice(("_", "-", "/", "")), []
        while sum(map(len, own)) < 20:
            own.append(r.choice(words))
        rows.append((False, join.join(own) if join else "".join(map(str.capitalize, own))))
    df = spark.createDataFrame(rows, "random boolean, t string").select("random", (secrets.ratio(F.col("t"), table) >= secrets.RATIO).alias("found"))
    share = {x.random: x.s for x in df.groupBy("random").agg(F.avg(F.col("found").cast("int")).alias("s")).collect()}
    assert share[True] >= 0.95 and share[False] <= 0.05, share


def test_secret_scan_is_linear(spark):
    import time

    letters = string.ascii_letters + string.digits
    texts = [" ".join(["0123456789abcdef"] * 100_000), "token" * 400_000, "".join(random.Random(2).choices(letters, k=2_000_000)), "password=abcdefghijklm " * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = secrets.train(secrets.labelled_samples(df))
    began = time.time()
    sizes = {x.doc_id: x.n for x in secrets.scan(df, table).select("doc_id", F.size("found").alias("n")).collect()}
    assert sizes[0] == 100_000 and sizes[1] == 0 and sizes[3] == 50_000 and time.time() - began < 120


def test_benchmark_passages_survive_substitutions(spark):
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    r, rows = random.Random(4), []
    for b in bench.collect():
        own = b.text.split()
        for share in (0.0, 0.1, 0.2):
            changed = [f"zz{r.randrange(99)}" if r.random() < share else w for w in own]
            rows.append((len(rows), b.item_id, share, " ".join(["lead", "words"] * 9 + changed + ["tail"] * 7)))
    df = spark.createDataFrame(rows, "doc_id long, want long, share double, text string")
    found = {(x.doc_id, x.item_id) for x in decontaminate.leaks(df, bench).collect()}
    for share in (0.0, 0.1, 0.2):
        own = [(i, w) in found for i, w, s, _ in rows if s == share]
        assert sum(own) / len(own) >= 0.9, share


def test_short_items_and_rows_without_ids(spark):
    item = " ".join(f"w{k}" for k in range(30))
    d = spark.createDataFrame([(1, "x red fox y"), (2, "red. Fox!"), (3, "red big fox"), (None, f"a {item}"), (None, "clean text"), (4, item), (4, "other")], "doc_id long, text string")
    b = spark.createDataFrame([(5, "Red fox"), (None, item), (6, "")], "item_id long, text string")
    assert {tuple(x) for x in decontaminate.leaks(d, b).collect()} == {(1, 5, 2, 2), (2, 5, 2, 2), (None, None, 30, 30), (4, None, 30, 30)}
    left = decontaminate.without_leaks(d, b.withColumn("leak_key", F.lit(1)))
    assert {tuple(x) for x in left.collect()} == {(3, "red big fox"), (None, "clean text"), (4, "other")} and left.columns == d.columns


def test_one_of_each_knows_rows_by_id_and_text(spark):
    a, b = "alpha beta gamma delta", "completely different words stand here"
    d = spark.createDataFrame([(3, a), (5, a), (5, b), (None, a), (None, "words of their own kind"), (7, b), (7, b)], "doc_id long, text string")
    assert sorted((x.doc_id or 0, x.text) for x in simhash.keep_one(d).collect()) == [(0, "words of their own kind"), (3, a), (5, b)]


def test_large_subtries_are_split(spark):
    r = np.random.default_rng(6)
    base = (r.integers(0, 1 << 48, 300, dtype=np.uint64)) | (np.uint64(7) << np.uint64(48))
    flips = np.array([np.bitwise_xor.reduce([np.uint64(1) << np.uint64(x) for x in r.choice(64, k, replace=False)]) for k in (1, 2, 3, 4) for _ in range(75)], np.uint64)
    fps = np.unique(np.concatenate([base, base ^ flips])).astype(np.uint64).view(np.int64)
    edges = simhash.links(spark.createDataFrame([(int(x),) for x in fps], "fp long"), len(fps), rows_per_trie=50)
    roots = {x.node: x.root for x in simhash.components(edges).collect()}
    up = {int(x): int(x) for x in fps}

    def find(x):
        return x if up[x] == x else find(up[x])

    for i, x in enumerate(fps.view(np.uint64)):
        for j in np.flatnonzero(np.bitwise_count(fps.view(np.uint64)[i + 1 :] ^ x) <= 3):
            p, q = find(int(fps[i])), find(int(fps[i + 1 + j]))
            up[max(p, q)] = min(p, q)
    assert all(roots.get(int(x), int(x)) == find(int(x)) for x in fps)


def test_warc_keeps_long_headers_and_reports_gaps(spark):
    pages = spark.createDataFrame([(1, "u" * 1_100_000, "a"), (2, "u", "b" * 300_000), (3, None, None)], "page_id long, url string, html string")
    records, gaps = warc.archived(pages.withColumn("file", F.lit("x")).withColumn("sha", F.lit("y")))
    assert {x.page_id for x in records.collect()} == {1, 2, 3} and gaps.count() == 0
    plain = warc.record_bytes("urn:page:1", "u", b"x") + b"WARC/1." * 2000
    assert [x[0] for x in warc.salvage(plain)] == ["record", "gap"]


def test_samples_are_bounded_and_ids_count_once(spark):
    d = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "x"), (3, "w " * 100_000)], "doc_id long, text string")
    y = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1), (None, 1), (4, None), (5, 7)], "doc_id long, quality int")
    from tagflow.llm.labelled import collected, sample

    got = {(x.label, x.text) for x in sample(d, y, "quality", F.lit(True), 10).collect()}
    assert got == {(0, "a"), (1, ""), (1, "w " * 100_000)}
    few = collected(sample(d, y, "quality", F.lit(True), 10), F.length("text"), 10)
    assert few["text"].str.len().sum() <= 10


def test_pipeline_stage_by_stage(spark, docs, short_training):
    import corpus_pipeline

    stages, bench = dict(corpus_pipeline.STAGES), [re.findall(r"[^\W_]+", r.text.lower()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    edge = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "s", 0), (9002, "word " * 30_000, "en", "s", 1), (9003, docs.first().text, None, None, None)], docs.schema)
    edge = edge.unionByName(edge)
    d0 = docs.unionByName(edge)
    model = toxicity.train(d0, spark.read.parquet(f"{DATA}/labels.parquet"), "toxic", fold("doc_id", 4) != 2)
    bad = {(r.doc_id, r.n) for r in toxicity.score(d0, model).where("toxic").groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    d1 = stages["toxicity"](spark, d0, DATA)
    assert d1.columns == d0.columns and d0.count() - d1.count() == sum(n for _, n in bad)

    def keyed(r):
        return (r.doc_id if r.doc_id is not None else 1 << 62, r.text or "")

    seen, lines = {}, {}
    rows1 = d1.collect()
    for k in sorted({keyed(r) for r in rows1}, key=lambda k: k[0]):
        own = k[1].split("\n")
        lines[k] = own
        for p in range(len(own) - 2):
            if any(own[p : p + 3]):
                seen.setdefault(tuple(own[p : p + 3]), []).append((k, p))
    gone = collections.defaultdict(set)
    for places in seen.values():
        first = min(places, key=lambda x: (x[0][0], x[1]))
        for k, p in places:
            if (k, p) != first:
                gone[k] |= set(range(max(p, first[1] + 3) if k == first[0] else p, p + 3))
    want = collections.Counter()
    for r in rows1:
        k = keyed(r)
        if len(gone[k]) < len(lines[k]):
            want[(r.doc_id, "\n".join(x for i, x in enumerate(lines[k]) if i not in gone[k]))] += 1
    d2 = stages["line dedup"](spark, d1, DATA)
    rows2 = d2.collect()
    assert collections.Counter((r.doc_id, r.text or "") for r in rows2) == want
    assert all(r.n_chars == len(r.text) for r in rows2 if r.text is not None)

    fps = {k: simhash.fingerprint(k[1]) for k in {keyed(r) for r in rows2}}
    groups: list[set] = []
    for k in fps:
        near = [g for g in groups if any((fps[k] ^ fps[o]).bit_count() <= 3 for o in g)]
        groups = [g for g in groups if g not in near] + [set().union({k}, *near)]
    d3 = stages["simhash"](spark, d2, DATA)
    rows3 = d3.collect()
    kept = {keyed(r) for r in rows3}
    assert len(rows3) == len(groups) and all(len(g & kept) == 1 and min(x[0] for x in g) == min(x[0] for x in g & kept) for g in groups)

    def holds(text):
        own = re.findall(r"[^\W_]+", text.lower())
        at = collections.defaultdict(list)
        for p, w in enumerate(own):
            at[w].append(p)
        for b in bench:
            shifts = {p - q for q in range(len(b) - 4) for p in at[b[q]] if own[p : p + 2] == b[q : q + 2]}
            shifts |= {p - q for q in range(len(b) - 5) for p in at[b[q]] if own[p + 2 : p + 4] == b[q + 2 : q + 4]}
            for s in shifts:
                if sum(0 <= i + s < len(own) and own[i + s] == w for i, w in enumerate(b)) >= max(5, min(13, -(-len(b) * 6 // 10))):
                    return True
        return False

    d4 = stages["decontamination"](spark, d3, DATA)
    left = {keyed(r) for r in d4.collect()}
    assert d4.columns == d0.columns and left == {k for k in kept if not holds(k[1])} and len(left) < len(kept)
    d5 = stages["packing"](spark, d4, DATA)
    assert {r.doc_id for r in d5.collect()} == {r.doc_id for r in d4.collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0


def test_packing_has_little_padding(docs):
    rows = packing.pack_documents(docs)
    n = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert n.agg(F.sum("n")).first()[0] / (1024 * n.count()) > 0.97


def test_katz_scores_other_texts_from_stored_tables(spark, docs, tmp_path, monkeypatch):
    from tagflow.llm import katz

    folder = f"file://{tmp_path}/model"
    model = katz.train(docs, folder=folder)
    pairs, weights = spark.read.parquet(f"{folder}/ngrams"), spark.read.parquet(f"{folder}/weights")
    assert {r.order for r in pairs.select("order").distinct().collect()} == {1, 2} and {"order", "bucket"} < set(pairs.columns) and "bucket" in weights.columns
    texts = {1: "the and of", 2: "never-seen-word the", 3: "", 4: docs.first().text}
    other = spark.createDataFrame([*texts.items(), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in katz.score(other, katz.load(spark, folder)).collect()}
    m, words = model.meta, katz._Ids(model.words)
    count = {r.w: r.c for r in pairs.where("order = 1").collect()} | dict(enumerate(model.counts.tolist()))
    pair = {(r.h, r.w): r.c for r in pairs.where("order = 2").collect()}
    weight = {r.h: (r.total, r.weight) for r in weights.collect()}
    for i, t in [*texts.items(), (None, "")]:
        ids = [words[x] for x in katz.words_of(t)] + [words[katz.END]]
        s = 0.0
        for h, w in zip([katz.START, *ids], ids):
            c, low = pair.get((h, w), 0), float(katz.word_probability(count.get(w, 0), m))
            total, owed = weight.get(h, (1, 1))
            s += np.log10((c * (m["d2"][c - 1] if c <= katz.K_GT else 1 - katz.EPSILON) if c else owed * low) / total)
        assert abs(got[i].score - s) < 1e-6 * max(1, abs(s)) and got[i].n_tokens == len(ids)
    monkeypatch.setattr(katz, "SCORE_TOKENS", 40_000)
    again = {r.doc_id: r for r in katz.score(docs, model).collect()}
    monkeypatch.undo()
    once = {r.doc_id: r for r in katz.score(docs, model).collect()}
    assert len(once) == docs.count() and all(abs(again[i].score - r.score) < 1e-6 * abs(r.score) and again[i].n_tokens == r.n_tokens for i, r in once.items())


def test_katz_counted_and_scored_at_once_is_as_from_stored_tables(spark, docs):
    from tagflow.llm import katz

    learn = F.pmod(F.col("doc_id"), F.lit(5)) != 1
    got = {r.doc_id: r for r in katz.katz_scores(docs, learn).collect()}
    stored = {r.doc_id: r for r in katz.score(docs, katz.train(docs.where(learn))).collect()}
    assert got.keys() == stored.keys() and len(got) == docs.count()
    for i, r in stored.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (r.n_tokens, r.n_known, r.train_tokens)
        assert abs(got[i].score - r.score) < 1e-9 * abs(r.score) and abs(got[i].base_score - r.base_score) < 1e-9 * abs(r.base_score)


def test_long_rows_do_not_keep_others_from_being_learned(spark, monkeypatch):
    from tagflow.llm import labelled

    rows = [(i, f"good plain words number {i} stand here" if i % 2 else f"zz{i} ## ## && {i}") for i in range(40)]
    ids = [r.s for r in spark.createDataFrame(rows, "doc_id long, text string").select(F.struct(F.xxhash64("doc_id"), "doc_id").alias("s")).orderBy("s").collect()]
    first = ids[0][1]
    long = [(i, " ".join(f"w{k}" for k in range(20_000)) if i == first else t) for i, t in rows]
    y = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    taken = []
    own = rules.fit
    monkeypatch.setattr(rules, "fit", lambda sparse, y: taken.append(len(y)) or own(sparse, y))
    for some in (rows, long):
        rules.train(spark.createDataFrame(some, "doc_id long, text string"), y, "quality", F.lit(True), max_bytes=200_000)
    assert taken == [40, 39]
    d = spark.createDataFrame(long, "doc_id long, text string")
    few = labelled.collected(labelled.sample(d, y, "quality", F.lit(True), 40), F.length("text"), 64 * 40)
    assert 25 < len(few) and few["text"].str.len().max() <= 40
    with pytest.raises(ValueError):
        labelled.collected(labelled.sample(d, y, "quality", F.lit(True), 40), F.length("text"), 64)


@pytest.mark.parametrize("n", [1_000_000])
def test_repetitive_texts_take_a_window_a_shift(spark, n):
    from corpus_pipeline import drop_leaked

    item = " ".join(["word"] * 30)
    d = spark.createDataFrame([(1, "word " * n), (2, "word " * 20), (3, "other words"), (4, f"a b {item}")], "doc_id long, text string")
    b = spark.createDataFrame([(7, item), (8, "x " * 12 + " ".join(f"w{k}" for k in range(9)))], "item_id long, text string")
    assert {tuple(x) for x in decontaminate.leaks(d, b).collect()} == {(1, 7, 30, 30), (2, 7, 20, 30), (4, 7, 30, 30)}
    assert [r.doc_id for r in decontaminate.without_leaks(d, b).collect()] == [3] and callable(drop_leaked)


def test_salvage_is_linear_and_streams(spark, tmp_path):
    import time

    whole = warc.record_bytes("urn:page:1", "u", b"p" * 100)
    for junk in (b"WARC/1." * 700_000, b"WARC/1.1\r\n" * 400_000 + b"\r\n\r\n", b"X: WARC/1.1\r\n" * 300_000 + b"\r\n\r\n", b"\nWARC/1.1\r\nContent-Length: 3000000\r\n\r\n" * 90_000, b"\x1f\x8b\x08" * 700_000):
        began = time.time()
        out = [x[0] for x in warc.salvage(whole + junk + whole)]
        assert out[0] == "record" and out.count("record") == 2 and time.time() - began < 40
    # an archive far larger than what a reader may hold is read block by block
    held, data = [], warc.squeeze(warc.record_bytes("urn:page:2", "u", random.Random(1).randbytes(300_000))) * 40
    source = warc.Archive(len(data), lambda at, n: held.append(n) or data[at : at + n])
    assert sum(x[0] == "record" for x in warc.salvage(source)) == 40 and max(held) <= warc.BLOCK + warc.PAST
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(data[:-9] + b"x")
    (folder / "b.warc").write_bytes(whole * 2500)
    (folder / "c.warc").write_bytes(b"")
    back = warc.read_archives(spark, f"file://{folder}", with_payload=True)
    assert {(r.kind, r.n) for r in back.groupBy("kind").agg(F.count("*").alias("n")).collect()} == {("record", 2539), ("gap", 1)}


def test_a_damaged_record_loses_no_other():
    r = random.Random(2)
    rows = [(f"urn:{i}", "".join(r.choices("ab \n", k=r.randrange(3000))).encode()) for i in range(200)]
    for kind in range(3):
        raw = [warc.record_bytes(i, "u", p) for i, p in rows]
        raw = [warc.squeeze(x) if kind == 1 or (kind == 2 and k % 2) else x for k, x in enumerate(raw)]
        ends, data = np.cumsum([len(x) for x in raw]), bytearray(b"".join(raw))
        hurt = set()
        for _ in range(15):
            at = r.randrange(len(data))
            data[at] ^= 0x5A
            hurt.add(int(np.searchsorted(ends, at, "right")))
        got = list(warc.salvage(bytes(data)))
        assert got[0][1] == 0 and got[-1][2] == len(data) and all(a[2] == b[1] for a, b in zip(got, got[1:]))
        kept = {x[3]["record_id"] for x in got if x[0] == "record"}
        assert {f"urn:{k}" for k in range(200) if k not in hurt} <= kept


def test_quality_features_by_hand():
    r = random.Random(8)
    texts = ["", " \n\t ", "one", "A b! c# 12, d|e. f.\nA b!\n\nA b! c# 12, d|e. f.\n", "a b c d e " * 4 + "\u00e9t\u00e9 \u4e16\u754c", *("".join(r.choices("ab C1.,|!#\n", k=300)) for _ in range(20))]
    for t in texts:
        raw, words = t.encode(), t.encode().split()
        n, size, lines = len(words), max(1, len(t.encode())), [x for x in t.encode().split(b"\n") if x.strip()]
        m, share = max(1, n), lambda chars: sum(c in chars for c in raw) / size  # noqa: B023
        grams = [tuple(words[i : i + 5]) for i in range(n - 4)]
        want = {
            "log_words": np.log1p(n), "word_length": sum(map(len, words)) / m, "upper_share": share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digit_share": share(b"0123456789"), "symbol_share": share(b"#*$%&|<>@^~_=+{}[]\\/"),
            "bang_share": raw.count(b"!") / size, "stop_share": raw.count(b".") / m, "comma_share": raw.count(b",") / m, "pipe_share": raw.count(b"|") / m, "line_words": n / max(1, len(lines)),
            "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)), "distinct_words": len(set(words)) / m, "repeated_grams": 1 - len(set(grams)) / max(1, len(grams)),
            "capital_words": sum(w.isupper() for w in words) / m, "end_symbols": sum(w[-1:] in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b"!") for w in words) / m, "longest_word": np.log1p(max(map(len, words), default=0)),
        }
        assert np.allclose(gam.features(t), [want[k] for k in gam.FEATURES], atol=1e-12), t


def test_toxicity_of_long_texts_is_that_of_the_whole(monkeypatch):
    r = np.random.default_rng(4)
    model = toxicity.Cnn()
    for k in (0, 1, 2, 5, 23, 400, 3000):
        h = [r.integers(0, 1 << 63, k).astype(np.uint64), r.integers(0, 1 << 63, 7).astype(np.uint64)]
        monkeypatch.setattr(toxicity, "SEGMENT", 50_000)
        whole = model.score(h)
        monkeypatch.setattr(toxicity, "SEGMENT", 11)
        assert np.allclose(model.score(h), whole, atol=1e-6)


def test_training_ends_when_unseen_rows_get_no_better():
    r = np.random.default_rng(5)
    rows = [r.integers(0, 1 << 63, 30).astype(np.uint64) for _ in range(300)]
    y = r.integers(0, 2, 300).astype(np.float32)  # nothing to learn
    steps = []
    model = toxicity.Cnn()
    vectors = model.vectors
    model.vectors = lambda h: steps.append(len(h)) or vectors(h)
    model.fit(rows[:240], y[:240], (rows[240:], y[240:]))
    assert sum(n <= toxicity.BATCH and n != 60 for n in steps) < toxicity.STEPS
    assert model.loss(rows[240:], y[240:]) < 1.5
