"""Quality rules, language identification, URL filters, mixing."""

import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cadenza.llm import lang_id, mixing, quality_rules, url_filter
from cadenza.llm.common import table
from tests.conftest import SF
from tests.llm.helpers import clash, edge_rows, frame, rows_of


def brute_repeat_words(text):
    w = text.split()
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    return len({i + o for i, g in enumerate(grams) if grams.count(g) > 1 for o in range(3)})


def test_quality_edges(spark):
    df = frame(spark, edge_rows())
    got = quality_rules.quality_report(df)
    assert got.count() == len(edge_rows())
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].n_words == 0 and by[1].base_failed and not by[1].kept
    assert by[3].n_words == 0 and by[3].n_dup_lines == 0
    assert by[13].n_words == 3 and by[13].word_chars == 9
    assert by[6].kept and not by[5].kept
    assert quality_rules.quality_report(df.limit(0)).count() == 0
    assert by[5].n_repeat_words == by[5].n_words


def test_repeat_words_match_brute_force():
    for text in ("a b c a b c d", "a a a a", "x y z", "a b c d e a b c", "q " * 30 + "r s t q q", "a b a b a b a"):
        assert quality_rules._repeat_words(text.encode().split()) == brute_repeat_words(text)


def test_line_rules_and_cleaning(spark):
    good = "\n".join(" ".join(f"word{i}n{j}" for j in range(12)) + "." for i in range(8))
    junk = "\n".join(" ".join(f"bad{i}n{j}###" for j in range(12)) for i in range(8))
    menu = "Home | News | Sport | About"
    df = frame(spark, [(1, good + "\n" + menu + "\nAll rights reserved.", "en", "s", 1), (2, good[:60] + "\n" + junk, "en", "s", 1)])
    kept = quality_rules.keep_good(clash(df))
    assert kept.columns == clash(df).columns
    row = kept.collect()
    assert [r.doc_id for r in row] == [1] and row[0].text == good and row[0].n_chars == len(good)


def test_long_line_with_few_separators_stays(spark):
    words = [f"word{i}" for i in range(20000)]
    for at in (100, 9000, 15000):
        words[at] = "/"
    text = " ".join(words)
    df = frame(spark, [(1, text, "en", "s", 1), (2, "Terms of Service | Privacy | About us | Contact\n" + text, "en", "s", 1)])
    by = {r.doc_id: r for r in quality_rules.quality_report(df).collect()}
    assert by[1].n_lost_words == 0 and by[1].kept
    assert by[2].n_lost_words == 10 and by[2].kept
    assert [r.text for r in quality_rules.keep_good(df).collect()] == [text, text]


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    got = lang_id.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_language_edges(spark):
    df = clash(frame(spark, edge_rows()))
    by = {r.doc_id: r for r in lang_id.language_report(df).collect()}
    assert by[1].lang_pred == by[3].lang_pred == by[14].lang_pred == "und"
    assert by[None].held_out and by[5].lang_pred != "und"
    assert lang_id.language_report(df.limit(0)).count() == 0
    no_label = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang_id.language_report(no_label).collect()} == {"und"}


def test_language_batch_equals_single(spark):
    model = lang_id.train(table(spark, SF, "documents").where(~lang_id.held_out()).select("lang", "text"))
    texts = ["hello the thing", None, "die straße und das", "", "Él niño", "x", "ñ" * 3000]
    together = lang_id.predict_texts(texts, *model)
    alone = [lang_id.predict_texts([t], *model) for t in texts]
    assert together[0] == [p[0] for p, _ in alone]
    assert all(abs(a - s[0]) < 1e-9 for a, (_, s) in zip(together[1], alone, strict=True))


def plain_bayes(rows, texts, buckets=lang_id.BUCKETS, smooth=0.5):
    """Naive Bayes n-gram by n-gram: (best language, probability) of each text."""
    def grams(text):
        t = "".join(c if "a" <= c <= "z" or ord(c) > 127 else " " for c in text.lower())
        for n in lang_id.ORDERS:
            for i in range(len(t) - n + 1):
                if t[i:i + n] not in bucket:
                    bucket[t[i:i + n]] = int(lang_id.gram_buckets([t[i:i + n]], buckets, (n,))[0][0][0])
                yield bucket[t[i:i + n]]

    bucket, counts, sizes = {}, defaultdict(Counter), Counter()
    for lang, text in rows:
        counts[lang].update(grams(text or ""))
        sizes[lang] += 1
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        found = list(grams(text))
        prior = {la: math.log(sizes[la] / sum(sizes.values())) for la in sizes}
        total = {la: sum(math.log(c[g] + smooth) - math.log(sum(c.values()) + smooth * buckets) for g in found) for la, c in counts.items()}
        best = min(sizes, key=lambda la: (-total[la] - prior[la], la))
        share = min(1.0, 100 / (4 * len(text)))
        z = {la: total[la] * share + prior[la] for la in sizes}
        out.append((best, 1 / sum(math.exp(v - z[best]) for v in z.values())))
    return out


def test_language_matches_plain_bayes(spark):
    """Also in groups of two languages: more languages than a matrix holds lose nothing."""
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang").where("length(text) < 1500").withColumn(
        "lang", F.concat("lang", (F.col("doc_id") % 2).cast("string")))
    docs = docs.unionByName(frame(spark, [(10**6, None, "en0"), (10**6 + 1, "12 !", "en1"), (10**6 + 2, "a", None)], "doc_id long, text string, lang string"))
    rows = docs.collect()
    learn = [(r.lang, r.text) for r in rows if r.lang and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    some = sorted(rows, key=lambda r: -r.doc_id)[:40]
    want = dict(zip([r.doc_id for r in some], plain_bayes(learn, [r.text for r in some]), strict=True))
    for max_langs in (500, 2):
        got = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.language_report(docs, max_langs).collect()}
        assert len(got) == len(rows) and len({la for la, _ in learn}) > 4
        for d, (lang, p) in want.items():
            assert got[d][0] == lang and abs(got[d][1] - p) < 1e-4


def test_url_edges(spark):
    rows = [(1, None), (2, "nohost"), (2, "http://a.NET"), (3, "http://net/x"), (4, "x://example.net/en/"), (5, "http://example.net/en"),
            (6, "http://org/fr/?x"), (6, "http://org/fr/?x"), (None, "ftp://a.org/fr/a#b"), (7, "http://badnet/x"), (8, "://"),
            (9, "http://a.example.com/de/" + "p/" * 300), (10, "http://example.com/de")]
    got = url_filter.url_report(clash(frame(spark, rows, "page_id long, url string")))
    want = [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (2, "a.net", "", None, "allow"), (3, "net", "/x", "net/", "block"),
            (4, "example.net", "/en/", "example.net/en/", "allow"), (5, "example.net", "/en", "net/", "block"),
            (6, "org", "/fr/", "org/fr/", "allow"), (6, "org", "/fr/", "org/fr/", "allow"), (None, "a.org", "/fr/a", "org/fr/", "allow"),
            (7, "badnet", "/x", None, "allow"), (8, "", "", None, "allow"),
            (9, "a.example.com", "/de/" + "p/" * 300, "example.com/de/", "block"), (10, "example.com", "/de", None, "allow")]
    assert rows_of(got) == rows_of(frame(spark, want, got.schema))
    assert url_filter.url_report(frame(spark, [], "page_id long, url string")).count() == 0


def test_url_rules_inside_a_path_part(spark):
    rules = url_filter.rule_table(spark, [("block", "a.b", "/x/ev"), ("allow", "b", "/x/"), ("allow", "a.b", "/x/ev")])
    got = url_filter.url_report(frame(spark, [(1, "http://a.b/x/evil"), (2, "http://c.b/x/evil"), (3, "http://a.b/x/e")], "page_id long, url string"), rules)
    assert {(r.page_id, r.rule, r.verdict) for r in got.collect()} == {(1, "a.b/x/ev", "block"), (2, "b/x/", "allow"), (3, "b/x/", "allow")}


def test_very_long_urls(spark):
    """A path of a million slashes, one of as many parts, and a host of ten thousand labels: linear work."""
    import time
    rows = [(1, "http://a.example.com/de" + "/" * 1_000_000), (2, "http://example.net/en/" + "p/" * 500_000), (3, "http://" + "x." * 10_000 + "net/a"),
            (4, "http://" + "x." * 10_000 + "org/fr/" + "q/" * 200_000), (5, "http://" + "." * 5_000 + "/" * 5_000), (6, "no" * 500_000)]
    began = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.url_report(frame(spark, rows, "page_id long, url string")).collect()}
    assert got == {1: ("example.com/de/", "block"), 2: ("example.net/en/", "allow"), 3: ("net/", "block"), 4: ("org/fr/", "allow"),
                   5: (None, "allow"), 6: (None, "allow")}
    assert time.time() - began < 60


def test_no_rules(spark):
    none = url_filter.rule_table(spark).limit(0)
    got = url_filter.judge(frame(spark, [(1, "http://a.net/x"), (2, None)], "page_id long, url string"), none, default="block").collect()
    assert [(r.rule, r.verdict) for r in got] == [(None, "block")] * 2


def test_menu_rule_equals_its_sql(spark, tmp_path):
    """Three separators in a line of 300 words do not make it a menu, in ten words they do."""
    import duckdb

    from cadenza.llm.oracle import OP3
    words = [f"word{i}" for i in range(300)]
    texts = [" ".join([*words[:100], "|", *words[100:200], "|", *words[200:], "|"]), " ".join(words) + "\n" + "a | b | c | d", "x | y > z / w\n" + " ".join(words[:60]),
             " ".join(words[:30]) + " | | |"]
    df = frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)])
    df.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(OP3)
    cols = [c[0] for c in want.description]
    got = quality_rules.quality_report(df).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall()) and [r.kept for r in sorted(got)] == [True, True, True, False]


def waterfill(sizes, cap=3):
    weight = {s: 1 + i % 3 for i, s in enumerate(sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else []))}
    target, full = dict.fromkeys(sizes, 0.0), set()
    left = float(sum(sizes.values()))
    while left > 1e-9:
        free = [s for s in sizes if s not in full]
        w = sum(weight[s] for s in free)
        over = [s for s in free if target[s] + left * weight[s] / w > cap * sizes[s]]
        for s in free:
            target[s] += left * weight[s] / w
        left = sum(target[s] - cap * sizes[s] for s in over)
        for s in over:
            target[s] = float(cap * sizes[s])
        full |= set(over)
        if not over:
            break
    return target


def test_mix_targets_and_taken(spark):
    docs = table(spark, SF, "documents")
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = waterfill(sizes)
    taken = {}
    for r in got:
        assert r.taken <= 3 * r.size and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 2 * mixing.BLOCK_WORDS for s in sizes)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_words_taken_match_a_layout_by_hand(spark, monkeypatch):
    """Every block of a source as often as its quota says, and each document's words block by block."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    docs = table(spark, SF, "documents")
    units = (docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
             .groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies")))
    n_buckets = max(1, -(-units.count() // 50))
    src = mixing.targets(units)
    picks = {(r.sid, r.block): r.times for r in mixing.picked_blocks(src, 64, 4096, 17, True, 8).collect()}
    by_source = {r.source: r for r in src.collect()}
    for r in by_source.values():
        n = -(-r.source_size // 64)
        quota = round(r.target * n / r.source_size) if r.source_size else 0
        times = [picks.get((r.sid, b), 0) for b in range(n)]
        assert sum(times) == quota and (not times or max(times) - min(times) <= 1)
    assert set(picks) <= {(r.sid, b) for r in by_source.values() for b in range(-(-r.source_size // 64))}
    rows = units.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(n_buckets))).collect()
    want, at = [], {}
    for r in sorted(rows, key=lambda r: (r.bucket, r.doc_id, r.size)):
        sid = by_source[r.source].sid
        for _ in range(r.copies):
            start = at.get(sid, 0)
            at[sid] = start + r.size
            want.append((r.doc_id, r.size, sum(picks.get((sid, w // 64), 0) for w in range(start, start + r.size))))
    assert sorted((r.doc_id, r.size, r.taken) for r in mixing.mix(docs).collect()) == sorted(want)


def test_running_sums_in_two_levels(spark):
    rows = [(k, p, (k + 3) * p % 17) for k in (1, 2) for p in range(0, 90, k)]
    df = spark.createDataFrame(rows, "k long, p long, v long").repartition(4)
    want = sorted((k, p, v, sum(w for q, x, w in rows if q == k and x < p)) for k, p, v in rows)
    for width in (1, 7, 1000):
        assert sorted(map(tuple, mixing._before(df, "k", "p", "v", "b", width).select("k", "p", "v", "b").collect())) == want
    assert mixing._before(df.limit(0), "k", "p", "v", "b").count() == 0


def test_mix_edges(spark):
    df = frame(spark, edge_rows())
    got = mixing.mix(clash(df).select("*")).collect()
    assert len(got) == len(edge_rows())
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = waterfill(sizes)
    assert all(abs(r.target - want[r.source]) < 1e-6 * max(1, r.target) and 0 <= r.taken <= 3 * r.size for r in got)
    assert mixing.mix_report(df.limit(0)).count() == 0
    out = mixing.mixed_documents(clash(df))
    assert out.columns == clash(df).columns and out.count() > 0


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 5, 17, 64, 97, 1000, 4099):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("p"))
        assert sorted(r.p for r in got.collect()) == list(range(n))
