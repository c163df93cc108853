"""Suffix-array dedup: remove every byte inside a ``span``-byte string that also starts elsewhere.

Which suffixes are sorted. Each window of ``span`` bytes owns one anchor: the place of its least
``GRAM``-byte hash (leftmost of equals), which depends on the window's bytes alone, so equal windows have
their anchors at equal offsets. One anchor serves a run of neighbouring windows ``l .. r``; about one
byte in 170 is an anchor. Only suffixes at anchors whose gram hash recurs can matter; those are sorted.

The sort is a distributed merge sort. A task sorts its suffixes (their first ``span`` bytes), cuts the
run at shared splitters, front-codes each piece against its predecessor and sends it to its range.
A range merges its runs with a loser tree that keeps, per entry, the length of the prefix it shares with
the last output; entries are told apart by these lengths, and bytes are compared only beyond them. The
merge yields the common-prefix lengths of neighbours. A window that starts ``o`` bytes before its anchor
recurs if another suffix shares its first ``span - o`` bytes and the ``o`` bytes before it; both classes
follow from the prefix lengths and a running hash of the left context.

Hot content. Equal texts are one text with a count (all of it is removed when it has ``span`` bytes).
Equal neighbourhoods in a task's run are decided there, and one of them travels on. Suffixes that share
their gram meet in one range. A gram of more than ``HOT`` anchors (a line that many texts share, say) is
entered at several places before its anchor, each for ``SUB`` windows: those share all but ``SUB`` - 1 of the
``span`` bytes, so such suffixes are dealt to ranges by that much longer prefix, and a short common passage
in many different surroundings no longer gathers in one range.

Texts are UTF-8 bytes; null is empty. Texts under ``span`` bytes lose nothing. Every row gives one row,
repeated rows, null and repeated ids included; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import frees, materialise, mix64, small_batches, tidy

SPAN = 400
GRAM = 64
CHUNK = 1 << 19
RUN_BYTES = 24 << 20
RANGE_RECORDS = 20_000
SAMPLE = 20_000
HOT = 2_000
SUB = 32
KEY = ("k1", "k2")


# ---------------------------------------------------------------- anchors
def gram_hashes(x: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position, built by doubling."""
    h = mix64(x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    k = 1
    while k < GRAM:
        h = h[:-k] * np.uint64(0xD6E8FEB86659FD93) + h[k:]
        h ^= h >> np.uint64(32)
        k *= 2
    return mix64(h)


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    size = 1
    m = v
    while 2 * size <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[:len(v) - w + 1], m[w - size:]) if size < w else m


def anchors(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, span: int):
    """(text number, hash, anchor, first window, last window) over texts ``x[starts:ends]``, relative to
    the start of each text."""
    none = np.zeros(0, np.int64)
    if len(x) < span:
        return none, none.astype(np.uint64), none, none, none
    h = gram_hashes(x)
    low = np.uint64((1 << 20) - 1)
    m = _sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), span - GRAM + 1)
    n = len(x) - span + 1
    at = (m[:n] & low).astype(np.int64)
    s = np.arange(n)
    text = np.searchsorted(starts, s, "right") - 1
    ok = s + span <= ends[text]
    new = ok.copy()
    new[1:] &= (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new)
    stop = ok.copy()
    stop[:-1] &= np.append(new[1:], True)[:n - 1] | ~ok[1:]
    last = np.flatnonzero(stop)
    a, t = at[first], text[first]
    base = starts[t]
    return t, h[a], a - base, first - base, last - base


def _chunks(texts: list[bytes], span: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Groups of texts of about CHUNK bytes: (text numbers, offsets, bytes); a longer text comes in
    pieces that share ``span - 1`` bytes, so that each window lies in one piece."""
    ids, offs, parts, size = [], [], [], 0
    for i, b in enumerate(texts):
        for o in range(0, max(1, len(b) - span + 1), CHUNK - span + 1):
            piece = b[o:o + CHUNK] if len(b) > CHUNK else b
            if size + len(piece) > CHUNK and parts:
                yield ids, offs, parts
                ids, offs, parts, size = [], [], [], 0
            ids.append(i)
            offs.append(o)
            parts.append(piece)
            size += len(piece)
            if len(b) <= CHUNK:
                break
    if parts:
        yield ids, offs, parts


def anchor_table(texts: DataFrame, span: int) -> DataFrame:
    """(k1, k2, h, place): one row per anchor; ``place`` packs the anchor and how far its first and last
    window start before it."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            k1, k2 = pdf["k1"].to_numpy(), pdf["k2"].to_numpy()
            for ids, offs, parts in _chunks([t.encode("utf-8", "surrogatepass") for t in pdf["text"]], span):
                lens = np.array([len(p) for p in parts])
                ends = np.cumsum(lens)
                t, h, a, lo, hi = anchors(np.frombuffer(b"".join(parts), np.uint8), ends - lens, ends, span)
                i, o = np.array(ids)[t], np.array(offs)[t]
                yield pd.DataFrame({"k1": k1[i], "k2": k2[i], "h": h.view(np.int64),
                                    "place": ((a + o) << 20) | ((a - lo) << 10) | (a - hi)})

    return texts.mapInPandas(frees(scan), "k1 bigint, k2 bigint, h bigint, place bigint")


# ---------------------------------------------------------------- runs
def common_prefix(x: bytes, y: bytes, known: int = 0) -> int:
    n = min(len(x), len(y))
    x, y = x[known:n], y[known:n]
    if x == y:
        return n
    return known + (8 * (n - known) - (int.from_bytes(x) ^ int.from_bytes(y)).bit_length()) // 8


def front_code(run: list[tuple]) -> dict:
    """A sorted run of (right, left, k1, k2, place, twice) as columns; rights lose what they share with
    the one before."""
    shared, tails, prev = [], [], b""
    for r in run:
        n = common_prefix(prev, r[0])
        shared.append(n)
        tails.append(r[0][n:])
        prev = r[0]
    return {"shared": np.array(shared, "<u2").tobytes(), "sizes": np.array([len(t) for t in tails], "<u2").tobytes(),
            "lefts": np.array([len(r[1]) for r in run], "<u2").tobytes(), "bytes": b"".join(tails) + b"".join(r[1] for r in run),
            "owners": np.array([r[2:5] for r in run], "<i8").tobytes(), "twice": np.array([r[5] for r in run], np.uint8).tobytes()}


def decode_run(row) -> tuple[list[bytes], list[int], list[bytes], np.ndarray, np.ndarray]:
    shared, sizes = np.frombuffer(row["shared"], "<u2").tolist(), np.frombuffer(row["sizes"], "<u2").tolist()
    lefts, data = np.frombuffer(row["lefts"], "<u2").tolist(), row["bytes"]
    rights, at, prev = [], 0, b""
    for n, size in zip(shared, sizes, strict=True):
        prev = prev[:n] + data[at:at + size]
        at += size
        rights.append(prev)
    left = []
    for size in lefts:
        left.append(data[at:at + size])
        at += size
    return rights, shared, left, np.frombuffer(row["owners"], "<i8").reshape(-1, 3), np.frombuffer(row["twice"], np.uint8)


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merge sorted runs (strings, prefix shared with the one before) with a loser tree.

    Returns the order as (run, index) and the prefix length each output shares with the one before. Every
    entry in the tree keeps the prefix length it shares with the last output; of two entries the one that
    shares more comes first, and only equals are compared, beyond that length."""
    k = 1
    while k < len(runs):
        k *= 2
    strings = [r[0] for r in runs] + [[]] * (k - len(runs))
    shares = [r[1] for r in runs] + [[]] * (k - len(runs))
    pos = [0] * k
    cur = [s[0] if s else None for s in strings]
    known = [0] * k
    loser = [-1] * k
    order, lcps = [], []

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes that with the winner."""
        x, y = cur[a], cur[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        n = common_prefix(x, y, known[a])
        if x <= y:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    level = list(range(k))
    node = k // 2
    while len(level) > 1:
        nxt = []
        for i in range(0, len(level), 2):
            w, z = play(level[i], level[i + 1])
            loser[node + i // 2] = z
            nxt.append(w)
        level, node = nxt, node // 2
    win = level[0]
    while cur[win] is not None:
        i = pos[win]
        order.append((win, i))
        lcps.append(known[win])
        pos[win] = i = i + 1
        if i < len(strings[win]):
            cur[win], known[win] = strings[win][i], shares[win][i]
        else:
            cur[win] = None
        node = (win + k) // 2
        while node:
            w, z = play(win, loser[node])
            loser[node] = z
            win = w
            node //= 2
    return order, lcps


def recurring(lcp: np.ndarray, lefts: list[bytes], back: np.ndarray, ahead: np.ndarray, twice: np.ndarray,
              span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, first offset, last offset before the anchor) of maximal runs of recurring windows among
    sorted suffixes; ``lcp`` is shared with the entry before."""
    n = len(lcp)
    width = int(back.max()) + 1 if n else 0
    left = np.zeros((n, max(width, 1)), np.uint8)
    for i, b in enumerate(lefts):
        if b:
            left[i, :len(b)] = np.frombuffer(b, np.uint8)[::-1]
    dup = np.zeros((n, width + 1), bool)
    h = np.zeros(n, np.uint64)
    for o in range(width):
        if o:
            h = mix64(h + left[:, o - 1] + np.uint64(1))
        at = np.flatnonzero((ahead <= o) & (o <= back))
        if not len(at):
            continue
        # Sorted neighbours that share span - o bytes are one class.
        key = h[at] * np.uint64(0x9E3779B97F4A7C15) + np.cumsum(lcp < span - o).astype(np.uint64)[at]
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        hit = twice[at] > 0
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        dup[at[hit], o] = True
    edge = np.diff(np.pad(dup, ((0, 0), (1, 0))).astype(np.int8), axis=1)
    entry, first = np.nonzero(edge == 1)
    _, after = np.nonzero(edge == -1)
    return entry, first, after - 1


def _spans(owner: np.ndarray, first, last, span: int) -> pd.DataFrame:
    a = owner[:, 2] >> 20
    return pd.DataFrame({"k1": owner[:, 0], "k2": owner[:, 1], "start": a - last, "stop": a - first + span})


RUN = ("target int, shared binary, sizes binary, lefts binary, bytes binary, owners binary, twice binary, "
       "spans binary")


def entries(place: int) -> Iterator[tuple[int, bool]]:
    """(place, hot) of each suffix to sort for an anchor. A negative number marks a frequent gram: its windows are
    cut at multiples of SUB bytes before the anchor, and each part is a place of its own."""
    if place >= 0:
        yield place, False
        return
    place = -1 - place
    a, back, ahead = place >> 20, (place >> 10) & 1023, place & 1023
    for j in range(ahead // SUB, back // SUB + 1):
        o = SUB * j
        yield ((a - o) << 20) | ((min(back, o + SUB - 1) - o) << 10) | (max(ahead, o) - o), True


def shared_prefix(hot: bool, span: int) -> int:
    """Bytes that any two suffixes with an equal window share."""
    return span - SUB + 1 if hot else GRAM


def sorted_runs(cands: DataFrame, splitters: tuple[list[bytes], list[bytes]], span: int) -> DataFrame:
    """Front-coded pieces of locally sorted runs, and spans that are decided already (dealt evenly). Ranges of
    frequent grams have negative numbers."""
    n_ranges = len(splitters[0]) + 1
    shared = cands.sparkSession.sparkContext.broadcast(splitters)  # SAMPLE prefixes at most

    def emit(records: list[tuple], turn: int) -> Iterator[dict]:
        from bisect import bisect_right

        records.sort(key=lambda r: (r[5], r[0], r[1]))
        done = []
        cuts: dict[int, list] = {}
        i = 0
        while i < len(records):
            r = records[i]
            j = i + 1
            while j < len(records) and records[j][0] == r[0] and records[j][1] == r[1] and records[j][5] == r[5]:
                j += 1
            if j > i + 1:
                done += [x[2:5] for x in records[i:j]]
            k = bisect_right(shared.value[r[5]], r[0][:shared_prefix(r[5], span)])
            cuts.setdefault(-1 - k if r[5] else k, []).append((*r[:5], int(j > i + 1)))
            i = j
        for target, piece in cuts.items():
            yield {"target": target, **front_code(piece), "spans": None}
        if done:
            owner = np.array(done, np.int64)
            back, ahead = (owner[:, 2] >> 10) & 1023, owner[:, 2] & 1023
            s = _spans(owner, ahead, back, span)
            yield {"target": turn % n_ranges, "shared": b"", "sizes": b"", "lefts": b"", "bytes": b"", "owners": b"",
                   "twice": b"", "spans": s.to_numpy(np.int64).astype("<i8").tobytes()}

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records, size, turn = [], 0, 0
        for pdf in batches:
            for k1, k2, text, places in zip(pdf["k1"], pdf["k2"], pdf["text"], pdf["places"], strict=True):
                b = text.encode("utf-8", "surrogatepass")
                turn = int(k1) & 0x7FFFFFFF
                for p, hot in (e for x in places for e in entries(int(x))):
                    a, back, ahead = p >> 20, (p >> 10) & 1023, p & 1023
                    records.append((b[a:a + span - ahead], b[a - back:a], k1, k2, p, hot))
                    size += span - ahead + back + 100
                    if size >= RUN_BYTES:
                        for row in emit(records, turn):
                            yield pd.DataFrame([row])
                        records, size = [], 0
        if records:
            for row in emit(records, turn):
                yield pd.DataFrame([row])

    return cands.select(*KEY, "text", "places").mapInPandas(frees(scan), RUN)


def merged_spans(runs: DataFrame, span: int) -> DataFrame:
    """(k1, k2, start, stop): bytes inside recurring windows, from the merged order of each range."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame(np.frombuffer(s, "<i8").reshape(-1, 4), columns=["k1", "k2", "start", "stop"])
               for s in pdf["spans"] if s]
        rows = [decode_run(r) for r in pdf.to_dict("records") if r["sizes"]]
        if rows:
            order, lcps = merge_runs([r[:2] for r in rows])
            owner = np.array([rows[w][3][i] for w, i in order], np.int64)
            twice = np.array([rows[w][4][i] for w, i in order], np.uint8)
            lefts = [rows[w][2][i] for w, i in order]
            lcp = np.array(lcps)
            # Suffixes that may have equal windows, in blocks of whole groups.
            heads = np.flatnonzero(lcp < shared_prefix(pdf["target"].iloc[0] < 0, span))
            cuts, at = [0], 0
            for g in heads.tolist():
                if g - at >= 4096:
                    cuts.append(g)
                    at = g
            cuts.append(len(lcp))
            for i, j in zip(cuts, cuts[1:], strict=False):
                part = owner[i:j]
                local = lcp[i:j].copy()
                local[0] = 0
                e, first, last = recurring(local, lefts[i:j], (part[:, 2] >> 10) & 1023, part[:, 2] & 1023, twice[i:j], span)
                out.append(_spans(part[e], first, last, span))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("k1", "k2", "start", "stop")})

    return runs.groupBy("target").applyInPandas(merge, "k1 bigint, k2 bigint, start bigint, stop bigint")


# ---------------------------------------------------------------- whole operator
def _cut(text: str, spans: list) -> tuple[bytes, list[tuple[int, int]]]:
    """Remaining bytes and maximal removed runs."""
    b = text.encode("utf-8", "surrogatepass")
    runs: list[list[int]] = []
    for s, e in sorted(spans):
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    keep, at = [], 0
    for s, e in runs:
        keep.append(b[at:s])
        at = e
    keep.append(b[at:])
    return b"".join(keep), [tuple(r) for r in runs]


def _splitters(cands: DataFrame, parts: int, span: int) -> tuple[list[bytes], list[bytes]]:
    """Cuts of the ranges for plain and for frequent grams, from at most SAMPLE prefixes picked by a hash; they
    shape the ranges only. About RANGE_RECORDS suffixes a range, and ``parts`` ranges or more where that pays."""
    counts = cands.select(F.explode("places").alias("p")).agg(
        F.count_if(F.col("p") >= 0), F.sum(F.when(F.col("p") < 0, F.ceil(F.shiftright(F.col("p") * -1 - 1, 10).bitwiseAND(1023) / SUB)))).first()
    records = [int(c or 0) for c in counts]
    every = max(1, -(-sum(records) // (SAMPLE // 2)))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = []
            for k1, text, places in zip(pdf["k1"], pdf["text"], pdf["places"], strict=True):
                b = None
                for p, hot in (e for x in places for e in entries(int(x))):
                    if (int(k1) ^ p * 0x9E3779B1) % 1_000_003 % every == 0:
                        b = b or text.encode("utf-8", "surrogatepass")
                        got.append((hot, b[p >> 20:][:shared_prefix(hot, span)]))
            yield pd.DataFrame(got, columns=["hot", "prefix"])

    some = cands.select("k1", "text", "places").mapInPandas(frees(pick), "hot boolean, prefix binary").limit(SAMPLE).collect()
    out = []
    for hot in (False, True):
        prefixes = sorted(bytes(r[1]) for r in some if r[0] == hot)
        n = max(1, -(-records[hot] // RANGE_RECORDS), parts if records[hot] > 2000 else 1)
        out.append(sorted({prefixes[i * len(prefixes) // n] for i in range(1, n)}) if prefixes else [])
    return out[0], out[1]


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``docs`` rows by a 128-bit content key, with their length and checksum."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"),
                       F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))


def find_spans(docs: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows by content key, candidate texts, spans to remove per content key)."""
    if not 2 * GRAM <= span < 1024:
        raise ValueError("span must lie in 128 .. 1023")
    small_batches(docs.sparkSession)
    keyed = distinct_texts(docs)
    rows = materialise(keyed.select("doc_id", *KEY, "n_bytes", F.sha2("text", 256).alias("sha")), "rows")
    long = keyed.where(F.col("n_bytes") >= span).select(*KEY, "text")
    table = materialise(anchor_table(long, span), "anchors")
    # Copies of a text give copies of its anchors: count places in texts, not rows.
    again = materialise(table.groupBy("h").agg(
        F.min("k1").alias("a"), F.max("k1").alias("b"), F.min("place").alias("c"), F.max("place").alias("d"),
        F.count("*").alias("n")).where("a != b or c != d").select("h", (F.col("n") > HOT).alias("hot")), "recurring")
    # Stored, so that both sides of the join are shuffled for it and a frequent hash is split at run time.
    found = table.join(again, "h").select(*KEY, F.when(F.col("hot"), -1 - F.col("place")).otherwise(F.col("place")).alias("place"))
    places = found.groupBy(*KEY).agg(F.sort_array(F.collect_set("place")).alias("places"))  # bounded by the text's length
    texts = long.groupBy(*KEY).agg(F.first("text").alias("text"))
    cands = materialise(texts.join(places, list(KEY)), "candidates")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = sorted_runs(cands, _splitters(cands, parts, span), span)
    return rows, cands, materialise(merged_spans(runs, span), "spans")


@tidy
def dedup_report(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, cands, spans = find_spans(docs, span)
    per_text = spans.groupBy(*KEY).agg(F.array_distinct(F.collect_list(F.struct("start", "stop"))).alias("spans"))

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, s in zip(text, spans, strict=True):
            keep, runs = _cut(t, [(int(x["start"]), int(x["stop"])) for x in s])
            out.append((sum(e - b for b, e in runs), len(runs), hashlib.sha256(keep).hexdigest()))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256"])

    partly = cands.join(per_text, list(KEY)).select(*KEY, cut("text", "spans").alias("r"))
    counts = rows.groupBy(*KEY).agg(F.count("*").alias("copies"))
    # Stored, so that the join below is between two shuffled sides and a text of very many rows is split.
    known = materialise(counts.join(partly, list(KEY), "left").where("copies > 1 or r is not null"), "known")
    out = rows.join(known, list(KEY), "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= span)
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("r.n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("r.n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("r.kept_sha256", F.col("sha"))).alias("kept_sha256"))
