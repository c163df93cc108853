"""Plain Python twins of the operators, for tables small enough to hold, and edge-case tables."""

import hashlib
import re
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def edge_rows():
    long = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do " * 3000
    base = " ".join(f"w{i * 7 % 101}x{i}" for i in range(120)) + "."
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", "en", "a", 7), (4, "one", "en", "b", 3),
        (5, long, "en", "a", len(long)), (6, base, "en", "a", 1), (6, base, "en", "a", 1), (7, base, "fr", None, 1),
        (8, base + " tail words here", None, "b", 1), (None, base, "en", "c", 1), (9, "é" * 900, "fr", "c", 900),
        (10, "ß日本 😀 " * 60, "de", "c", 1), (11, base.upper(), "en", "a", 1), (12, "x" * 5000, "en", "a", 1),
        (13, "a\x1cb\x1fc \x85 d\xa0e", "en", "a", 1), (14, "!!! ### 123", "en", "b", 1),
    ]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def clash(df):
    """The table with extra columns named as the operators name theirs."""
    for c in ("quality", "kept", "found", "row_no", "mix_size", "mix_copy", "size", "sid", "k1", "k2", "id", "component_id",
              "kept_id", "taken", "copy", "n_words", "h", "u", "known"):
        df = df.selectExpr("*", f"'x' AS {c}")
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in r))


def near(docs):
    """doc_id -> (set size, smallest reachable id)"""
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    parent = {d: d for d, _ in docs if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if docs[i][0] is not None and docs[j][0] is not None and a and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(docs[i][0]), root(docs[j][0])
                parent[max(x, y)] = min(x, y)
    return [(d, len(s), root(d) if d is not None else None) for (d, _), s in zip(docs, sets, strict=True)]


def cut_repeats(docs, span=400):
    texts = [(t or "").encode("utf-8") for _, t in docs]
    seen = Counter(b[i:i + span] for b in texts for i in range(len(b) - span + 1))
    out = []
    for (d, _), b in zip(docs, texts, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if seen[b[i:i + span]] > 1:
                gone[i:i + span] = b"\1" * span
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def contaminated(docs, items, n=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))

    windows = {}
    for item, t in items:
        w = words(t)
        m = min(n, len(w))
        if m and item is not None:
            for k in range(len(w) - m + 1):
                windows.setdefault(tuple(w[k:k + m]), set()).add(item)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in {len(k) for k in windows}:
            for k in range(len(w) - m + 1):
                owner = windows.get(tuple(w[k:k + m]))
                if owner:
                    hit |= set(range(k, k + m))
                    found |= owner
        ids = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0))
    return out
