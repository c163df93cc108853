"""Quality classifier by co-training two views.

The text view holds the words of a document (hashed; in a fit, those found in ``MIN_DF`` sampled documents
or more whose presence goes with the label by a chi-square test) and shares of its characters, words and lines; the metadata view its source, language and sizes. For each
target (quality, toxic) a logistic model per view is fitted on labelled rows; in every round each view
labels the unlabelled rows it is surest of (calibrated probability beyond ``SURE``) for the other view, and
both are fitted again. Every document is scored by the combination of both calibrated views.

A hash of the id puts each document into one of four folds. Labels of ``fit`` fit the views; those of ``choose`` scale
the views during the rounds, so they decide the pseudo-labels; those of ``calibrate`` scale the final views (Platt) and
weigh them against each other; documents of ``report`` take no part in any of this, and ``held_out_report`` measures on
them. Where ``choose`` or ``calibrate`` lacks one kind of label, the two serve both ends together.

Fitting uses a bounded sample: at most about ``labelled_rows`` labelled and ``pool_rows`` unlabelled documents, picked by a
hash of the id, of any length and read whole; only their feature numbers reach the driver, at most ``BUCKETS`` words of
each. Scoring covers all whole texts; the weights have a fixed size (``BUCKETS`` words) and are broadcast.

A null text counts as empty; null source, language and size are values of their own. Several labels of one
id count as the lower quality and the higher toxicity; rows that share an id get their own scores; a null id
is scored and never learned from. Without labels of both kinds in the sample, quality is 1 and
toxicity 0, so every document is kept. Every document row gives one row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import hash_words, small_batches
from cadenza.llm.decontaminate import words_of

BUCKETS = 1 << 18
META = 1 << 12
MIN_DF = 4
SURE = 0.97
TOXIC_FROM = 0.4  # a probability from which a document counts as toxic
LOGIT = 6.0  # a view's say is bounded before the views are weighed
TARGETS = ("quality", "toxic")
FOLDS = {"report": 100, "choose": 225, "calibrate": 350, "fit": 1000}  # upper ends, in thousandths of the documents
_SYMBOLS = b"#*$%&|<>!"


def _bin(x: float, edges: tuple) -> int:
    return int(np.searchsorted(edges, x, "right"))


_SHARES = (0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7)
_N_SHAPE = 64


def text_features(text: str | None) -> np.ndarray:
    """Distinct word buckets, then shape numbers from BUCKETS on."""
    words = words_of(text)
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    lines = raw.split(b"\n")
    upper = sum(map(str.isupper, text or ""))
    shape = [
        _bin((n - len(raw.translate(None, _SYMBOLS))) / n, _SHARES),
        8 + _bin(upper / n, _SHARES),
        16 + _bin(1 - len(set(words)) / max(1, len(words)), _SHARES),
        24 + _bin(1 - len(set(lines)) / len(lines), _SHARES),
        32 + _bin(len(words), (1, 20, 50, 100, 300, 1000, 5000)),
        40 + _bin(sum(map(len, words)) / max(1, len(words)), (2, 3, 4, 5, 6, 8, 12)),
        48 + _bin(raw.count(b"!!") / max(1, len(words)), _SHARES),
        56 + _bin(raw.count(b" | ") / max(1, len(words)), _SHARES),
    ]
    ids = np.unique((hash_words(words) >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)) if words else np.zeros(0, np.int64)
    return np.concatenate([ids, BUCKETS + np.array(shape)])


def meta_features(source, lang, n_chars) -> np.ndarray:
    import xxhash

    size = -1 if n_chars is None or n_chars != n_chars else int(np.log2(max(1, n_chars) + 1) * 2)
    keys = [f"s {source}", f"l {lang}", f"n {size}", f"l {lang} n {size}"]
    return np.array([xxhash.xxh3_64_intdigest(k) % META for k in keys], np.int64)


class Rows:
    """Binary features of rows: numbers, and the row of each."""

    def __init__(self, features: list[np.ndarray]):
        self.n = len(features)
        lens = np.array([len(f) for f in features], np.int64)
        self.index = np.concatenate(features) if features else np.zeros(0, np.int64)
        self.row = np.repeat(np.arange(self.n), lens)

    def score(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.row, w[self.index], self.n) + b

    def gradient(self, d: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.index, d[self.row], size)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Logistic:
    def __init__(self, size: int, l2: float):
        self.w, self.b, self.l2 = np.zeros(size), 0.0, l2
        self.square, self.square_b = np.full(size, 1e-8), 1e-8

    def fit(self, rows: Rows, y: np.ndarray, weight: np.ndarray, steps: int, rate: float = 0.3) -> None:
        total = max(weight.sum(), 1.0)
        for _ in range(steps):
            d = (_sigmoid(rows.score(self.w, self.b)) - y) * weight / total
            g, gb = rows.gradient(d, len(self.w)) + self.l2 * self.w, d.sum()
            self.square += g * g
            self.square_b += gb * gb
            self.w -= rate * g / np.sqrt(self.square)
            self.b -= rate * gb / np.sqrt(self.square_b)


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a calibrated logit, by Newton steps with a weak prior towards slope 1."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = _sigmoid(a * z + b)
        s = p * (1 - p) + 1e-9
        g = np.array([((p - y) * z).sum() + 0.1 * (a - 1), (p - y).sum() + 0.01 * b])
        h = np.array([[(s * z * z).sum() + 0.1, (s * z).sum()], [(s * z).sum(), s.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return float(max(a, 0.0)), float(b)


def combine(z1: np.ndarray, z2: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Weights of two calibrated logits, not below 0, and an offset (projected gradient)."""
    w = np.array([1.0, 0.0, 0.0])
    x = np.stack([np.clip(z1, -LOGIT, LOGIT), np.clip(z2, -LOGIT, LOGIT), np.ones_like(z1)], axis=1)
    for _ in range(400):
        g = x.T @ (_sigmoid(x @ w) - y) / max(1, len(y)) + 0.01 * (w - [1.0, 0.0, 0.0])
        w = w - 0.1 * g
        w[:2] = np.maximum(w[:2], 0)
    return tuple(map(float, w))


def telling(rows: Rows, y: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """Features whose presence goes with the label: chi-square beyond 2 ln(features in use), which about one
    of them passes by chance."""
    n1, n0 = (weight * y).sum(), (weight * (1 - y)).sum()
    f1, f0 = rows.gradient(weight * y, size), rows.gradient(weight * (1 - y), size)
    f, n = f1 + f0, n1 + n0
    chi = n * (f1 * (n0 - f0) - f0 * (n1 - f1)) ** 2 / np.maximum(f * (n - f) * n1 * n0, 1e-9)
    return chi > 2 * np.log(max(2, (f > 0).sum()))


def _fit_view(all_rows: Rows, y: np.ndarray, weight: np.ndarray, size: int, choose: bool) -> tuple[np.ndarray, float]:
    """Weights over all ``size`` features (0 where not chosen) and offset; both classes weigh the same."""
    keep = np.ones(size, bool)
    if choose:
        keep = telling(all_rows, y, weight, size)
        keep[BUCKETS:] = True
    some = keep[all_rows.index]
    number = np.cumsum(keep) - 1
    rows = Rows([])
    rows.n, rows.index, rows.row = all_rows.n, number[all_rows.index[some]], all_rows.row[some]
    mean = float((weight * y).sum() / max(weight.sum(), 1e-9))
    m = Logistic(int(keep.sum()), 1e-3)
    m.fit(rows, y, weight * np.where(y == 1, 0.5 / max(mean, 1e-3), 0.5 / max(1 - mean, 1e-3)), 200)
    w = np.zeros(size)
    w[keep] = m.w
    return w, m.b


def co_train(text: list[np.ndarray], meta: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, rounds: int = 3,
             share: float = 0.05) -> dict:
    """One target. ``labels``: 1, 0, or -1 (unlabelled); ``fold``: the fold of each row, none of them ``report``."""
    pool = labels < 0
    fit, choose, calibrate = (~pool & (fold == name) for name in ("fit", "choose", "calibrate"))
    if min(len(set(labels[choose])), len(set(labels[calibrate]))) < 2:
        choose = calibrate = choose | calibrate
    if len(set(labels[fit])) < 2 or len(set(labels[choose])) < 2:
        return {}
    views, sizes = [Rows(text), Rows(meta)], [BUCKETS + _N_SHAPE, META]
    y = [labels.astype(float).clip(0, 1) for _ in views]
    weight = [fit.astype(float) for _ in views]
    take = max(1, int(share * pool.sum()))
    for turn in range(rounds + 1):
        models = [_fit_view(views[v], y[v], weight[v], sizes[v], v == 0) for v in (0, 1)]
        z = [views[v].score(*models[v]) for v in (0, 1)]
        if turn == rounds:
            break
        scales = [platt(z[v][choose], labels[choose].astype(float)) for v in (0, 1)]
        given = []
        for v in (0, 1):
            p = _sigmoid(scales[v][0] * z[v] + scales[v][1])
            sure = np.flatnonzero(pool & (weight[1 - v] == 0) & ((p > SURE) | (p < 1 - SURE)))
            best = sure[np.argsort(-np.abs(p[sure] - 0.5), kind="stable")][:take]
            given.append((best, (p[best] > 0.5).astype(float)))
        for v in (0, 1):
            at, lab = given[1 - v]
            y[v][at], weight[v][at] = lab, 0.5
    truth = labels[calibrate].astype(float)
    scales = [platt(z[v][calibrate], truth) for v in (0, 1)]
    mix = combine(*[scales[v][0] * z[v][calibrate] + scales[v][1] for v in (0, 1)], truth)
    return {"views": models, "scales": scales, "mix": mix}


def probability(model: dict, text: np.ndarray, meta: np.ndarray, default: float) -> float:
    if not model:
        return default
    total = model["mix"][2]
    for f, (w, b), (a, c), k in zip((text, meta), model["views"], model["scales"], model["mix"], strict=False):
        total += k * float(np.clip(a * (w[f].sum() + b) + c, -LOGIT, LOGIT))
    return float(_sigmoid(total))


def fold_of(doc_id):
    """Column expression: the fold of an id (null for a null id)."""
    place = F.pmod(F.xxhash64(doc_id, F.lit(5)), F.lit(1000))
    out = F.when(F.col(doc_id).isNull(), F.lit(None))
    for name, end in FOLDS.items():
        out = out.when(place < end, F.lit(name))
    return out


def one_label(labels: DataFrame) -> DataFrame:
    """One row per labelled id: the lower quality and the higher toxicity."""
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))


def _sample(docs: DataFrame, labels: DataFrame, labelled_rows: int, pool_rows: int) -> pd.DataFrame:
    """Feature numbers, labels and fold of the bounded sample."""
    small_batches(docs.sparkSession)
    lab = one_label(labels)
    known, every = lab.count(), docs.count()
    h = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
    some = docs.withColumn("fold", fold_of("doc_id")).where("fold <> 'report'") \
        .withColumn("u", h).where(F.col("u") < min(1.0, 1.2 * max(labelled_rows / max(1, known), pool_rows / max(1, every - known))))
    lab = lab.withColumn("u2", h).where(F.col("u2") < min(1.0, labelled_rows / max(1, known))).drop("u2").withColumn("known", F.lit(True))
    pool = F.col("known").isNotNull() | (F.col("u") < pool_rows / max(1, every - known))
    joined = some.join(lab, "doc_id", "left").where(pool)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"], "fold": pdf["fold"], "quality": pdf["quality"].fillna(-1).astype(int), "toxic": pdf["toxic"].fillna(-1).astype(int),
                "text": [text_features(t if isinstance(t, str) else None).astype(np.int32) for t in pdf["text"]],
                "meta": [meta_features(s, la, c).astype(np.int32) for s, la, c in zip(pdf["source"], pdf["lang"], pdf["n_chars"], strict=True)]})

    rows = joined.select("doc_id", "fold", "quality", "toxic", "text", "source", "lang", "n_chars").mapInPandas(
        scan, "doc_id bigint, fold string, quality int, toxic int, text array<int>, meta array<int>")
    return rows.limit(2 * (labelled_rows + pool_rows)).toPandas().sort_values("doc_id", kind="stable").reset_index(drop=True)


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = 12_000, pool_rows: int = 6_000, rounds: int = 3) -> dict:
    s = _sample(docs, labels, labelled_rows, pool_rows)
    text = [np.asarray(t, np.int64) for t in s["text"]]
    meta = [np.asarray(t, np.int64) for t in s["meta"]]
    # Words of fewer sampled documents say nothing that holds beyond them.
    df = np.bincount(np.concatenate(text), minlength=BUCKETS + _N_SHAPE) if text else np.zeros(BUCKETS + _N_SHAPE)
    use = df >= MIN_DF
    use[BUCKETS:] = True
    text = [t[use[t]] for t in text]
    return {t: co_train(text, meta, s[t].to_numpy().astype(int), s["fold"].to_numpy(), rounds) for t in TARGETS}


def score(docs: DataFrame, model: dict):
    """Column expression struct(quality_score, toxic_score) over text, source, lang and n_chars."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("quality_score double, toxic_score double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for text, source, lang, n_chars in batches:
            out = []
            for t, s, la, c in zip(text, source, lang, n_chars, strict=True):
                x, y = text_features(t if isinstance(t, str) else None), meta_features(s, la, c)
                out.append([probability(m[k], x, y, default) for k, default in zip(TARGETS, (1.0, 0.0), strict=True)])
            yield pd.DataFrame(out, columns=["quality_score", "toxic_score"])

    return run.asNondeterministic()("text", "source", "lang", "n_chars")  # one call for all that reads it


def quality_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, quality_score, toxic_score, score (good and not toxic), toxic, kept, held_out (of the
    fold ``report``, so its label had no say)."""
    base = docs.select("doc_id", "text", "source", "lang", "n_chars")
    model = train(base, labels, **options)
    out = base.withColumn("p", score(base, model)).select("doc_id", "p.quality_score", "p.toxic_score")
    return (out.withColumn("score", F.col("quality_score") * (1 - F.col("toxic_score")))
            .withColumn("toxic", F.col("toxic_score") >= TOXIC_FROM)
            .withColumn("kept", (F.col("quality_score") >= 0.5) & ~F.col("toxic"))
            .withColumn("held_out", F.coalesce(fold_of("doc_id") == "report", F.lit(False))))


def held_out_report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Accuracy on the fold ``report``, one row per target: n (labelled rows), n_right, n_positive, n_found (positives so
    predicted) and n_false (other rows predicted positive)."""
    seen = quality_report(docs, labels, **options).where("held_out").withColumnRenamed("toxic", "p_toxic").join(one_label(labels), "doc_id")
    said = F.inline(F.array(
        F.struct(F.lit("quality").alias("target"), (F.col("quality") == 1).alias("truth"), (F.col("quality_score") >= 0.5).alias("said")),
        F.struct(F.lit("toxic").alias("target"), (F.col("toxic") == 1).alias("truth"), F.col("p_toxic").alias("said"))))
    rows = seen.select(said).where("truth is not null")
    return rows.groupBy("target").agg(
        F.count("*").alias("n"), F.count_if(F.col("said") == F.col("truth")).alias("n_right"), F.count_if("truth").alias("n_positive"),
        F.count_if(F.col("truth") & F.col("said")).alias("n_found"), F.count_if(~F.col("truth") & F.col("said")).alias("n_false"))
