"""Decontamination, suffix dedup, near-dedup, token store."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import decontaminate, minhash, suffix_dedup, token_store
from cadenza.llm.common import table
from tests.conftest import SF
from tests.llm.helpers import clash, contaminated, cut_repeats, edge_rows, frame, near, rows_of


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def same(got, want):
    key = [(r[0] is None, r[0] or 0, *r[1:]) for r in got]
    return sorted(key, key=str) == sorted([(r[0] is None, r[0] or 0, *r[1:]) for r in want], key=str)


@pytest.mark.parametrize("options", [{}, {"block_chars": 2000}])
def test_decontamination_matches_brute_force(spark, options):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = [tuple(r)[:6] for r in decontaminate.contamination_report(docs, bench, **options).collect()]
    assert same(got, contaminated(pairs(docs), [tuple(r) for r in bench.select("item_id", "text").collect()]))


@pytest.mark.parametrize("options", [{}, {"block_chars": 40}])
def test_decontamination_edges(spark, options):
    items = [(1, None), (2, ""), (3, "one"), (4, "dolor sit amet"), (5, "dolor sit amet"), (None, "tail"), (6, "Tail WORDS here"),
             (6, "consectetur adipiscing elit"), (7, "lorem ipsum dolor sit amet consectetur adipiscing elit sed do lorem ipsum"), (8, "日本")]
    bench = frame(spark, items, "item_id long, text string")
    df = frame(spark, edge_rows())
    got = [tuple(r)[:6] for r in decontaminate.contamination_report(clash(df), bench, **options).collect()]
    assert same(got, contaminated([r[:2] for r in edge_rows()], items))
    clean = decontaminate.remove_contaminated(clash(df), bench, **options)
    assert clean.columns == clash(df).columns and 8 not in {r.doc_id for r in clean.collect()}
    assert decontaminate.contamination_report(df.limit(0), bench).count() == 0
    none = decontaminate.contamination_report(df, bench.limit(0)).collect()
    assert len(none) == len(edge_rows()) and not any(r.contaminated for r in none)


def test_longest_match(spark):
    words = [f"t{i}" for i in range(30)]
    bench = frame(spark, [(5, " ".join(words))], "item_id long, text string")
    docs = frame(spark, [(1, "x y " + " ".join(words[3:20]) + " z " + " ".join(words[10:21]), "en", "s", 1)])
    r = decontaminate.contamination_report(docs, bench).first()
    assert (r.longest_words, r.longest_item, r.longest_at, r.n_hit) == (17, 5, 2, 28)


def mutated(seed, n=60):
    rng = random.Random(seed)
    base = "".join(rng.choice("ab cd") for _ in range(2500))
    rows = []
    for i in range(n):
        t = base
        for _ in range(rng.randint(0, 5)):
            p = rng.randint(0, len(t) - 1)
            t = t[:p] + rng.choice(["x", "", "yy", "é"]) + t[p + rng.randint(0, 2):]
        rows.append((i, t[rng.randint(0, 900):] if i % 5 == 0 else t, "en", "s", 1))
    return rows + [(500, "ab" * 700, "en", "s", 1), (501, "c" * 399, "en", "s", 1), (502, "c" * 400, "en", "s", 1), (503, "d" * 401, "en", "s", 1),
                   (504, None, "en", "s", 1), (506, base, "en", "s", 1), (506, base, "en", "s", 1), (None, base, "en", "s", 1)]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 0, 8])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, hot):
    """Also with every recurring gram, or those of more than eight anchors, taken as frequent."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "RANGE_RECORDS", 50)
    rows = mutated(3)
    df = frame(spark, rows).repartition(4)
    got = [tuple(r) for r in suffix_dedup.dedup_report(clash(df)).collect()]
    assert same(got, cut_repeats([r[:2] for r in rows]))
    assert suffix_dedup.dedup_report(df.limit(0)).count() == 0


def test_suffix_dedup_edges_and_documents(spark):
    rows = edge_rows()
    rows[4] = (5, rows[4][1][:9000], "en", "a", 9000)
    got = [tuple(r) for r in suffix_dedup.dedup_report(frame(spark, rows)).collect()]
    assert same(got, cut_repeats([r[:2] for r in rows]))


def test_anchors_do_not_depend_on_the_cut_of_long_texts(monkeypatch):
    rng = random.Random(1)
    text = bytes(rng.choice(b"abcd ") for _ in range(20_000))

    def places(chunk):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        cover = set()
        for _, offs, parts in suffix_dedup._chunks([text], 400):
            lens = np.array([len(p) for p in parts])
            ends = np.cumsum(lens)
            _, h, a, lo, hi = suffix_dedup.anchors(np.frombuffer(b"".join(parts), np.uint8), ends - lens, ends, 400)
            for x, y, z, w in zip(h.tolist(), a.tolist(), lo.tolist(), hi.tolist(), strict=True):
                cover |= {(s + offs[0], y + offs[0], x) for s in range(z, w + 1)}
        return cover

    assert places(1 << 19) == places(3000) and len(places(3000)) == len(text) - 399


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=12), min_size=1, max_size=6))
def test_loser_tree_merges_runs(runs):
    runs = [sorted(r) for r in runs]
    coded = [(r, [suffix_dedup.common_prefix(a, b) for a, b in zip([b"", *r], r, strict=False)]) for r in runs]
    order, lcps = suffix_dedup.merge_runs(coded)
    got = [runs[w][i] for w, i in order]
    assert got == sorted(x for r in runs for x in r)
    assert lcps == [suffix_dedup.common_prefix(a, b) for a, b in zip([b"", *got], got, strict=False)]


def test_class_and_left_byte_do_not_mix():
    """Suffix number c with left byte b - 1 is not suffix number b with left byte c - 1."""
    n = 200
    lcp = np.zeros(n, int)  # all suffixes differ at once
    lefts = [bytes([n - i - 1]) for i in range(n)]  # class i + 1, byte + 1 = n - i
    one = np.ones(n, int)
    entry, _, _ = suffix_dedup.recurring(lcp, lefts, one, one, np.zeros(n, np.uint8), 400)
    assert len(entry) == 0


def test_entries_cover_every_window_once():
    for a, back, ahead in ((500, 336, 0), (40, 40, 7), (9, 0, 0), (700, 95, 64), (33, 32, 31)):
        place = (a << 20) | (back << 10) | ahead
        assert list(suffix_dedup.entries(place)) == [(place, False)]
        starts = []
        for p, hot in suffix_dedup.entries(-1 - place):
            b, h = (p >> 10) & 1023, p & 1023
            assert hot and 0 <= h <= b < suffix_dedup.SUB
            starts += [(p >> 20) - o for o in range(h, b + 1)]
        assert sorted(starts) == list(range(a - back, a - ahead + 1))


def test_front_coding_round_trip():
    run = sorted([(b"abc", b"L", 1, 2, 3, 0), (b"abcd", b"", 4, 5, 6, 1), (b"b", b"xyz", 7, 8, 9, 0), (b"", b"q", 1, 1, 1, 0)])
    rights, shared, lefts, owner, twice = suffix_dedup.decode_run(suffix_dedup.front_code(run))
    assert rights == [r[0] for r in run] and lefts == [r[1] for r in run] and twice.tolist() == [r[5] for r in run]
    assert owner.tolist() == [list(r[2:5]) for r in run] and shared[0] == 0


def near_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    base = [rng.choice(words) for _ in range(160)]
    rows = []
    for i in range(110):
        t = list(base)
        for _ in range(rng.randint(0, 12)):
            t[rng.randint(0, 159)] = rng.choice(words)
        rows.append((i, "  ".join(t)))
    rows += [(200, None), (201, ""), (202, "  "), (203, "A b"), (204, "a  B\n"), (205, "a b"), (None, rows[0][1]), (206, rows[3][1]),
             (206, rows[3][1]), (206, "x y z w q r s"), (207, "X y z w q r s"), (208, "x")]
    return [(*r, "en", "s", 1) for r in rows]


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)  # several squares a bucket
    df = frame(spark, near_rows()).repartition(3)
    got = [tuple(r) for r in minhash.near_duplicates(clash(df)).collect()]
    assert same([r[:3] for r in got], near([r[:2] for r in near_rows()]))
    assert all(r[3] == (r[0] == r[2]) for r in got)


def test_near_duplicates_of_ids_with_several_texts(spark, monkeypatch):
    """Ids that rows of different texts share: every text takes part, also in the squares."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(12):  # families of texts about 0.75 alike, so that the smallest id does not meet all of them
        base = [rng.choice(words) for _ in range(160)]
        for _ in range(9):
            t = list(base)
            for _ in range(rng.randint(0, 6)):
                t[rng.randint(0, 159)] = rng.choice(words)
            rows.append([None, " ".join(t)])
    rng.shuffle(rows)
    for i, r in enumerate(rows):
        r[0] = i if i % 6 else i // 60  # every sixth row shares its id with nine others
    df = frame(spark, [(*r, "en", "s", 1) for r in rows]).repartition(4)
    assert same([tuple(r)[:3] for r in minhash.near_duplicates(df).collect()], near([tuple(r) for r in rows]))


def test_squares_take_every_text_of_an_id(spark):
    """Two texts under id 1 in one bucket with id 2: the second alone is like the text of id 2."""
    a, b = ("common words " + " ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = spark.createDataFrame([(7, 0, i, i, [0] * 8, [9]) for i in (1, 2)],
                                 "key long, band int, id long, comp long, sig array<bigint>, bands array<bigint>")
    for first, second in ((a, b), (b, a)):
        texts = spark.createDataFrame([(1, first), (1, second), (2, b)], "id long, text string")
        assert minhash._square_links(rows, texts, 0.55, 75).collect() == [(2, 1)]


def test_near_duplicates_on_documents_and_edges(spark):
    docs = table(spark, SF, "documents")
    assert same([tuple(r)[:3] for r in minhash.near_duplicates(docs).collect()], near(pairs(docs)))
    df = frame(spark, edge_rows())
    assert same([tuple(r)[:3] for r in minhash.near_duplicates(df).collect()], near([r[:2] for r in edge_rows()]))
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    one = minhash.keep_one(clash(df))
    assert one.columns == clash(df).columns
    # One row per kept id; the row with a null id has the words of others and goes.
    assert sorted(str(r.doc_id) for r in one.collect()) == sorted({str(d) for d, _, c in near([r[:2] for r in edge_rows()]) if d == c and d is not None})


def test_one_row_of_a_class_stays(spark):
    a, b, c = "one two three four five six", "seven eight nine ten eleven", "lone words here and there"
    rows = [(1, a), (1, a), (None, a.upper()), (None, a), (2, b), (None, c), (None, "  " + c), (None, None), (None, ""), (3, "")]
    got = minhash.keep_one(frame(spark, [(i, t, "en", "s", 1) for i, t in rows])).collect()
    assert sorted((str(r.doc_id), " ".join((r.text or "").lower().split())) for r in got) == sorted(
        [("1", a), ("2", b), ("None", c), ("None", ""), ("None", ""), ("3", "")])


def test_components_of_a_long_chain(spark):
    ids = list(range(40))
    random.Random(2).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)) + [(100, 101)], "a long, b long")
    got = {r.id: r.comp for r in minhash.components(edges).collect()}
    assert got == dict.fromkeys(range(40), 0) | {100: 100, 101: 100}


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    a, b = np.unique(pool[:3000]), np.unique(pool[1000:4000])
    x, y = (minhash.packed(minhash.minima(s)).view(np.uint64)[None] for s in (a, b))
    assert abs(minhash._bit_counts(x, y)[0, 0] - 0.5) < 0.2 and minhash._bit_counts(x, x)[0, 0] == 1


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


ODD = ["İstanbul. x", "ŉa, Σας ΟΔΟΣ.", "a\x1cb c\x85d\u2028e", "don't I'll they're.", "<|endoftext|> x", "word<|startoftext|>b", "é. x́,",
       "ﬁn. ǅa! Ⅷ ª.º,", "12.5, a1b2. $5", "क़़. क़", "日本語。テスト", "😀. a😀,", "\u2002lead\u3000", "\n\n", "x" * 3000, "ſtraße. ǆ", "Ɓa. ƀ"]


def test_word_cache_gives_the_tokenizers_ids(tokenizer):
    import public_tokenizers

    enc = token_store.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), bound=40)
    assert enc.plain
    for t in ODD * 2:
        assert np.frombuffer(enc.encode(t), np.uint16).tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_word_cache_on_any_text(text):
    import public_tokenizers

    enc = token_store._encoder(public_tokenizers.path("word_bpe_49k.json"), 1)
    assert np.frombuffer(enc.encode(text), np.uint16).tolist() == enc.tok.encode(text, add_special_tokens=False).ids + [1]


def test_token_store_round_trip(spark, tokenizer, tmp_path):
    rows = edge_rows()
    df = frame(spark, rows)
    got = token_store.token_report(clash(df)).collect()
    want, start = [], 0
    encoded = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1]) for r in rows]
    for d, ids in sorted(encoded, key=lambda x: (x[0] is None, x[0] or 0, len(x[1]))):
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert rows_of(spark.createDataFrame(got, "doc_id long, start long, n_tokens long, ids_crc32 long")) == \
        rows_of(spark.createDataFrame(want, "doc_id long, start long, n_tokens long, ids_crc32 long"))
    path = str(tmp_path / "store")
    token_store.write_store(df, path, block_bytes=200, part_bytes=2000)
    assert token_store.fetch(spark, path, 4) == [dict(encoded)[4]]
    assert token_store.fetch(spark, path, 6) == [dict(encoded)[6]] * 2 and token_store.fetch(spark, path, 99) == []
    again = token_store.read_store(spark, path, with_ids=True).collect()
    assert sorted((str(r.doc_id), r.ids) for r in again) == sorted((str(d), i) for d, i in encoded)
    assert sorted((r.start, r.n_tokens) for r in again) == [(w[1], w[2]) for w in want]


def test_token_store_of_no_documents(spark):
    assert token_store.token_report(frame(spark, [])).count() == 0
