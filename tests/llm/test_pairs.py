"""Hard negatives, SimHash groups and spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadenza.llm import hard_negatives, simhash, spelling
from cadenza.llm.common import clean_up, table
from cadenza.session import ensure_checkpoint_dir
from tests.conftest import SF
from tests.llm.helpers import clash, edge_rows, frame, lower


def by_key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


# ------------------------------------------------------------------ SimHash
def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    k = min(4, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(prints):
    """(doc_id, fingerprint, smallest id reachable)"""
    parent = {d: d for d, _ in prints if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, f) in enumerate(prints):
        for b, g in prints[:i]:
            if a is not None and b is not None and (f ^ g).bit_count() <= 4:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [(d, f"{f:016x}", None if d is None else root(d)) for d, f in prints]


def test_simhash_edges(spark):
    rows = [(*r[:2], *r[2:]) for r in edge_rows()]
    got = [tuple(r)[:3] for r in simhash.simhash_groups(clash(frame(spark, rows))).collect()]
    assert by_key(got) == by_key(plain_groups([(d, plain_fingerprint(t)) for d, t in (r[:2] for r in rows)]))
    assert simhash.simhash_groups(frame(spark, rows).limit(0)).count() == 0


def test_simhash_table(spark):
    docs = table(spark, SF, "documents")
    want = plain_groups([(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()])
    assert by_key([tuple(r) for r in simhash.simhash_groups(docs).collect()]) == by_key(want)


def test_simhash_several_prints_of_one_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(80)) for x in "pq")
    got = simhash.simhash_groups(frame(spark, [(7, a, "", "", 1), (7, b, "", "", 1), (3, a, "", "", 1), (9, b, "", "", 1)])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(7, 3), (3, 3), (9, 3)}


def prints(seed, n=500):
    rng = random.Random(seed)
    out = [0, (1 << 64) - 1]
    for _ in range(n):
        f = rng.choice(out) if rng.random() < 0.6 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.choice([1, 2, 4, 4, 5, 6])):
            f ^= 1 << b
        out.append(f)
    return sorted(set(out))


@pytest.mark.parametrize("leaves", [simhash.LEAVES, 6])
def test_trie_join_finds_all_links(spark, monkeypatch, leaves):
    """Also with units of six leaves, which are split down the trie."""
    monkeypatch.setattr(simhash, "LEAVES", leaves)
    fps = prints(5)
    df = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)], "id long, fp long")
    links = simhash.near_pairs(df)
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links.collect():
        assert r.a != r.b
        x, y = root(r.a), root(r.b)
        parent[max(x, y)] = min(x, y)
    assert [root(i) for i in range(len(fps))] == [c for _, _, c in plain_groups(list(enumerate(fps)))]


@given(st.sets(st.integers(0, 63), max_size=4))
@settings(max_examples=300, deadline=None)
def test_one_rotation_keeps_the_budget(bits):
    """Any four differing bits pass the depth budgets in one rotation."""
    x = sum(1 << b for b in bits)
    turned = [(x << 4 * r | x >> (64 - 4 * r)) & (1 << 64) - 1 for r in range(16)]
    assert any(all((t >> (64 - d)).bit_count() <= simhash.budget(d) for d in range(1, 65)) for t in turned)


def test_frontier_in_pieces(monkeypatch):
    fps = prints(9, 300)
    code = np.array(fps, np.uint64)
    n = len(code)
    whole = [(0, np.array([[0], [n], [0], [n], [0]]))]
    monkeypatch.setattr(simhash, "budget", lambda depth: 4)
    want = [c for _, _, c in plain_groups(list(enumerate(fps)))]
    assert simhash.self_join(code, list(whole)).tolist() == want
    monkeypatch.setattr(simhash, "FRONTIER", 7)
    assert simhash.self_join(code, list(whole)).tolist() == want


# ---------------------------------------------------------------- spelling
def near(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    if len(x) > len(y):
        x, y = y, x
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def plain_spelling(docs, every=97):
    n = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    around = defaultdict(set)  # words that share a deletion or a gap
    for w in n:
        for i in range(len(w) + 1):
            around[w[:i] + "_" + w[i + 1:]].add(w) if i < len(w) else None
            around[w[:i] + "_" + w[i:]].add(w)
    links = defaultdict(set)
    for group in around.values():
        for a in group:
            links[a] |= {b for b in group if near(a, b)}
    form = {}
    for w in n:
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return out


def words(seed):
    rng = random.Random(seed)
    base = ["aaaaa", "aaaaaa", "aaaaaaa", "aaaab", "baaaa", "abcde", "abcdé", "éabcd", "×÷×÷×", "zzzzz" * 300, "zzzzz" * 300 + "z"]
    for _ in range(150):
        w = rng.choice(base) if rng.random() < 0.7 else "".join(rng.choice("abcé") for _ in range(rng.randint(5, 9)))
        p = rng.randint(0, len(w))
        base.append(w[:p] + rng.choice(["", "a", "b", "ÿ"]) + w[p + rng.randint(0, 1):])
    return [w for w in dict.fromkeys(base) if len(w) >= 5]


@pytest.mark.parametrize("group", [spelling.GROUP, 4])
def test_spelling_matches_brute_force(spark, monkeypatch, group):
    """Also with partitions of four words, which are split code point by code point."""
    monkeypatch.setattr(spelling, "GROUP", group)
    rng = random.Random(2)
    vocab = words(7)[:60 if group == 4 else 400]
    vocab = [w for w in vocab if len(w) < 20] if group == 4 else vocab
    rows = [(None if i % 40 == 0 else i, " ".join(rng.choice(vocab).title() if rng.random() < 0.1 else rng.choice(vocab) for _ in range(40)) + "1x", "", "", 1)
            for i in range(60)] + [(99, None, "", "", 1), (100, "", "", "", 1)]
    got = [tuple(r) for r in spelling.spelling_variants(clash(frame(spark, rows)), typo_every=5).collect()]
    assert by_key(got) == by_key(plain_spelling([r[:2] for r in rows], 5))
    assert spelling.spelling_variants(frame(spark, rows).limit(0)).count() == 0


def test_spelling_table(spark):
    docs = table(spark, SF, "documents")
    want = plain_spelling([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert by_key([tuple(r) for r in spelling.spelling_variants(docs).collect()]) == by_key(want)


@given(st.lists(st.text("abc", min_size=1, max_size=6), max_size=40))
@settings(max_examples=100, deadline=None)
def test_composition_gives_each_pair_once(vocab):
    vocab = sorted(set(vocab))
    got = sorted(tuple(sorted(p)) for p in spelling.Composition(spelling.Acceptor(vocab)).pairs())
    assert got == sorted((a, b) for i, a in enumerate(vocab) for b in vocab[i + 1:] if near(a, b))


def test_acceptor_is_minimal():
    a = spelling.Acceptor(sorted(x + y for x in ("pre", "re", "un") for y in ("do", "tie")))
    assert len(a.arcs) == 9  # root, the end, d, t, i, and p, r, e, u around them


# ----------------------------------------------------------- hard negatives
def plain_mining(rows):
    v = []
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        v.append((i, [int(np.floor(256 * float(x))) for x in vec], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for k, (a, x, la) in enumerate(v):
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), b, lb) for j, (b, y, lb) in enumerate(v) if j != k)
        for s, p, _ in [r for r in scored if r[2] == la][:5]:
            fits = [r for r in scored if r[2] != la and 80 * -s <= 100 * -r[0] <= 100 * -s]
            out += [(a, p, rank + 1, r[1], -s, -r[0]) for rank, r in enumerate(fits[:5])]
    return out


def mined(df):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return [tuple(r) for r in hard_negatives.mine(df.withColumn("label", moved), F.col("vec_id") % 100 == 0).collect()]


@pytest.mark.parametrize("block", [(4096, 512), (64, 2)])
def test_mining_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", block[0])
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", block[1])
    df = table(spark, SF, "embeddings")
    assert by_key(mined(df)) == by_key(plain_mining([tuple(r) for r in df.collect()]))


def test_mining_edges(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(-2, 3)).tolist(), int(rng.integers(0, 3))) for i in range(0, 700, 5)]
    rows += [(i, rows[3][1], i % 3) for i in range(1000, 1060)] + [(100, rows[7][1], 1), (100, rows[7][1], 1), (200, [], 1), (300, [1.0], 0),
             (400, None, 1), (500, [1.0, None], 1), (600, [float("nan")] * 8, 1), (601, [float("inf")] * 8, 1), (None, [1.0] * 8, 1),
             (603, [1.0] * 8, None), (800, [0.0] * 8, 9), (900, (-np.ones(8)).tolist(), 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for c in ("qid", "rid", "vec", "slot", "score", "anchor"):
        df = df.withColumn(c, F.lit("x"))
    assert by_key(mined(df)) == by_key(plain_mining(rows))
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id % 100 != 0")) == []
    assert by_key(mined(df.where("label = 1"))) == by_key(plain_mining([r for r in rows if r[2] == 1]))


@given(st.integers(0, 10_000))
@settings(max_examples=60, deadline=None)
def test_pruned_join_is_exact(seed):
    rng = np.random.default_rng(seed)
    m, n, d = rng.integers(1, 12), rng.integers(1, 40), rng.integers(0, 30)
    a, x = (rng.integers(-9, 10, (k, d)) * (rng.random((k, d)) < 0.5) for k in (m, n))
    least = np.where(rng.random(m) < 0.2, -np.inf, rng.integers(-50, 300, m)).astype(float)
    alive = rng.random((m, n)) < 0.8
    full = a @ x.T
    i, j, s = hard_negatives.threshold_pairs(a.astype(float), x.astype(float), least, alive.copy())
    want = [(p, q, full[p, q]) for p, q in zip(*np.nonzero(alive & (full >= least[:, None])), strict=True)]
    assert sorted(zip(i.tolist(), j.tolist(), s.tolist(), strict=True)) == sorted(want)


# ------------------------------------------------------------------- tables
def test_operators_leave_only_their_result(spark):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/cadenza-llm/{spark.sparkContext.applicationId}")

    def tables():
        where = fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return len(where.listStatus(fs)) if where.exists(fs) else 0

    clean_up(spark)
    assert tables() == 0
    docs = table(spark, SF, "documents")
    for k in (1, 2):
        simhash.simhash_groups(docs)
        assert tables() == k
    clean_up(spark)
    assert tables() == 0
