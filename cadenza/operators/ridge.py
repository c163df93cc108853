"""Ridge regression on feature panels.

Rows are sparse (``idx``, ``val``) with several outputs ``y``. One pass over the rows gives their moments per split: per
feature the sums with itself and with the outputs, and per pair of features that meet in a row the sum of their
products; all are aggregated before the shuffle, and moments of splits add up, so no later step reads rows.

Everything as long as the features is a table of panels: ``BLOCK`` consecutive features with their part of a matrix
(right sides, Krylov basis, weights), one row each. A product with the Gram matrix joins the panels to strips of the
sparse matrix by feature range and adds the partial panels up by range. The solver is a block Krylov method whose
space all outputs and alphas share. The driver holds only matrices over outputs, alphas and basis directions
(at most ``keep``), never one as long as the features.

Centring. Features that every row names are shifted by their mean and the outputs by theirs before any product, so
no large sums cancel; the rest of the means is a rank-one term. A feature that a row does not name counts as zero
there. Splits without rows have zero moments; features without rows have zero weights.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import reliable_checkpoint

BLOCK = 1024                # features of a panel
STRIP = 64                  # panels of rows that one strip of the Gram matrix covers
PART_BYTES = 1 << 20


def _matrix(b: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(b).reshape(rows, -1)


def summed(df: DataFrame, shape: tuple, product) -> np.ndarray:
    """Sum over all rows of ``product(row)`` (a matrix of ``shape``) on the driver: a task adds its rows up and sends the
    total in parts of at most ``PART_BYTES``, which are added up part by part."""
    step = max(1, PART_BYTES // (8 * max(1, shape[1])))

    def partial(it):
        acc = None
        for pdf in it:
            for row in pdf.itertuples(index=False):
                p = product(row)
                acc = p if acc is None else acc + p
        if acc is not None:
            for k in range(0, shape[0], step):
                yield pd.DataFrame({"part": [k], "m": [acc[k:k + step].tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "m": [sum(np.frombuffer(b) for b in pdf["m"]).tobytes()]})

    out = np.zeros(shape)
    for r in df.mapInPandas(partial, "part int, m binary").groupBy("part").applyInPandas(add, "part int, m binary").collect():
        out[r["part"]:r["part"] + step] = _matrix(r["m"], -1) if shape[1] == 0 else np.frombuffer(r["m"]).reshape(-1, shape[1])
    return out


class Moments:
    """Moments of ``df(idx, val, y)`` by the values of ``by`` (a column; none: one split), d features and r outputs."""

    def __init__(self, df: DataFrame, d: int, r: int, by: str | None = None):
        self.d, self.r = d, r
        self.spark = df.sparkSession
        rows = df.select((F.col(by).cast("string") if by else F.lit("all")).alias("split"), "idx", "val", "y")
        whole = rows.agg(F.count("*").alias("n"), Summarizer.mean(array_to_vector("y")).alias("m")).first()
        entries = F.arrays_zip("idx", "val")
        # Features of every row: at most as many as a row is long.
        named = rows.select(F.explode(entries).alias("e")).groupBy("e.idx").agg(F.count("*").alias("c"), F.avg("e.val").alias("m"))
        self.shift = {r["idx"]: r["m"] for r in named.where(F.col("c") == whole["n"]).collect()}
        self.centre = np.asarray(whole["m"].toArray()) if whole["n"] else np.zeros(r)
        if self.shift:
            table = F.create_map(*[F.lit(x) for kv in self.shift.items() for x in kv])
            rows = rows.withColumn("val", F.zip_with("val", "idx", lambda v, i: v - F.coalesce(table[i], F.lit(0.0))))
        rows = rows.withColumn("y", F.zip_with("y", F.array(*[F.lit(float(v)) for v in self.centre]), lambda a, b: a - b))
        heads = rows.groupBy("split").agg(F.count("*").alias("n"), Summarizer.sum(array_to_vector("y")).alias("y"),
                                          Summarizer.sum(array_to_vector(F.transform("y", lambda v: v * v))).alias("yy"))
        self.heads = {h["split"]: (h["n"], h["y"].toArray(), h["yy"].toArray()) for h in heads.collect()}
        e = rows.withColumn("e", entries)
        one = e.select("split", F.explode("e").alias("x"), "y")
        feat = one.groupBy("split", F.col("x.idx").alias("idx")).agg(
            F.sum("x.val").alias("s"), F.sum(F.col("x.val") * F.col("x.val")).alias("ss"),
            Summarizer.sum(array_to_vector(F.zip_with("y", F.array_repeat(F.col("x.val"), F.size("y")), lambda a, b: a * b))).alias("sy"))
        self.features = feat.select("split", "idx", "s", "ss", vector_to_array("sy").alias("sy")).transform(reliable_checkpoint)
        two = e.select("split", F.explode("e").alias("x"), "e").select("split", "x", F.explode("e").alias("z"))
        gram = two.groupBy("split", F.col("x.idx").alias("i"), F.col("z.idx").alias("j")).agg(F.sum(F.col("x.val") * F.col("z.val")).alias("g"))
        # A strip: the entries of BLOCK columns within STRIP panels of rows.
        strips = gram.withColumn("col", F.expr(f"j div {BLOCK}").cast("int")).groupBy("split", "col", F.expr(f"i div {BLOCK * STRIP}").alias("part"))
        self.strips = strips.agg(F.array_sort(F.collect_list(F.struct("i", "j", "g"))).alias("e")).select(
            "split", "col", F.col("e.i").alias("i"), F.col("e.j").alias("j"), F.col("e.g").alias("g")).transform(reliable_checkpoint)


class Design:
    """The centred least-squares problem of some splits. ``panels``: (block, m, mean, diag, rhs) as float64 bytes."""

    def __init__(self, moments: Moments, splits: Iterable[str] | None = None):
        mo = self.moments = moments
        self.d, self.r = mo.d, mo.r
        self.splits = sorted(mo.heads) if splits is None else list(splits)
        zero = (0, np.zeros(mo.r), np.zeros(mo.r))
        heads = [mo.heads.get(s, zero) for s in self.splits]
        n = self.n = max(1.0, float(sum(h[0] for h in heads)))
        ysum, yy = sum(h[1] for h in heads), sum(h[2] for h in heads)
        self.my = mo.centre + ysum / n
        self.syy = yy - ysum * ysum / n
        mine = F.col("split").isin(self.splits)
        r, d, shift, ym = mo.r, mo.d, mo.shift, ysum / n

        def panel(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            block, size = key[0], min(BLOCK, d - key[0] * BLOCK)
            at = pdf["idx"].to_numpy() - block * BLOCK
            s, ss, sy = np.zeros(size), np.zeros(size), np.zeros((size, r))
            np.add.at(s, at, pdf["s"].to_numpy())
            np.add.at(ss, at, pdf["ss"].to_numpy())
            np.add.at(sy, at, np.vstack(list(pdf["sy"])))
            m = s / n
            mean = m + np.array([shift.get(block * BLOCK + k, 0.0) for k in range(size)])
            return pd.DataFrame({"block": [block], "m": [m.tobytes()], "mean": [mean.tobytes()], "diag": [(ss - n * m * m).tobytes()],
                                 "rhs": [(sy - n * np.outer(m, ym)).tobytes()]})

        have = (mo.features.where(mine).groupBy(F.expr(f"idx div {BLOCK}").cast("int").alias("block"))
                .applyInPandas(panel, "block int, m binary, mean binary, diag binary, rhs binary"))
        blocks = mo.spark.range(-(-d // BLOCK)).select(F.col("id").cast("int").alias("block"))
        size = F.least(F.lit(BLOCK), F.lit(d) - F.col("block") * BLOCK).cast("int")

        def blank(width):
            return F.unhex(F.repeat(F.lit("00"), size * 8 * width))

        self.panels = blocks.join(have, "block", "left").select(
            "block", *[F.coalesce(c, blank(w)).alias(c) for c, w in (("m", 1), ("mean", 1), ("diag", 1), ("rhs", r))]).transform(reliable_checkpoint)
        self.strips = mo.strips.where(mine).select("col", "i", "j", "g")

    def gram(self, p: DataFrame) -> DataFrame:
        """(block, g): the shifted Gram matrix (no rank-one term) times the panels ``p`` (block, p)."""
        d = self.d

        def partial(it):
            for pdf in it:
                for col, i, j, g, p in pdf.itertuples(index=False, name=None):
                    m = _matrix(p, min(BLOCK, d - col * BLOCK))
                    rows, first = np.unique(i, return_index=True)  # entries come sorted by row
                    part = np.add.reduceat(np.asarray(g)[:, None] * m[np.asarray(j) - col * BLOCK], first, axis=0)
                    cut = np.flatnonzero(np.diff(rows // BLOCK)) + 1
                    yield pd.DataFrame([(int(at[0] // BLOCK), (at % BLOCK).astype(np.int32).tobytes(), x.tobytes())
                                        for at, x in zip(np.split(rows, cut), np.split(part, cut), strict=True)], columns=["block", "at", "x"])

        def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            out = None
            for at, x in zip(pdf["at"], pdf["x"], strict=True):
                at = np.frombuffer(at, np.int32)
                x = _matrix(x, len(at))
                out = np.zeros((min(BLOCK, d - key[0] * BLOCK), x.shape[1])) if out is None else out
                out[at] += x
            return pd.DataFrame({"block": [key[0]], "g": [out.tobytes()]})

        joined = self.strips.join(p.select(F.col("block").alias("col"), "p"), "col").select("col", "i", "j", "g", "p")
        return joined.mapInPandas(partial, "block int, at binary, x binary").groupBy("block").applyInPandas(add, "block int, g binary")


class Fits:
    """Weights of several alphas: ``table`` (block, w: a panel with the outputs of every alpha side by side) and the
    intercept of each alpha."""

    def __init__(self, design: Design, alphas: list[float], table: DataFrame, intercepts: np.ndarray):
        self.design, self.alphas, self.table, self.r, self.d = design, alphas, table, design.r, design.d
        self.intercept = dict(zip(alphas, intercepts, strict=True))

    def rows(self, alpha: float) -> DataFrame:
        """(idx, w): one row per feature."""
        k, r = self.alphas.index(alpha), self.r

        def scan(it):
            for pdf in it:
                for block, w in pdf.itertuples(index=False, name=None):
                    m = np.frombuffer(w).reshape(-1, r * len(self_alphas))[:, k * r:(k + 1) * r]
                    yield pd.DataFrame({"idx": np.arange(len(m), dtype=np.int32) + block * BLOCK, "w": list(m)})

        self_alphas = list(self.alphas)
        return self.table.mapInPandas(scan, "idx int, w array<double>")


def _columns(w: np.ndarray, k: int) -> list[np.ndarray]:
    return np.split(w, k, axis=1)


def _solve(h: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Least-norm solution of a symmetric positive semidefinite system."""
    e, q = np.linalg.eigh((h + h.T) / 2)
    good = e > 1e-13 * max(e[-1], 1e-300)
    return (q[:, good] / e[good]) @ (q[:, good].T @ rhs)


_STATE = "block int, m binary, mean binary, diag binary, left binary, base binary, v binary, u binary"


class _Panel:
    """One row of the solver's state, decoded; features are scaled to unit diagonal."""

    def __init__(self, row, alphas, c):
        self.m, self.diag = np.frombuffer(row.m), np.frombuffer(row.diag)
        size = len(self.m)
        self.s = 1.0 / np.sqrt(np.where(self.diag > 0, self.diag, 1.0))[:, None]
        self.left, self.base, self.v, self.u = (_matrix(b, size) if len(b) else np.zeros((size, 0)) for b in (row.left, row.base, row.v, row.u))
        self.alphas, self.c = alphas, c

    def residual(self) -> np.ndarray:
        if not self.v.shape[1]:
            return self.left
        parts = _columns(self.left, len(self.alphas))
        return np.hstack([x - self.u @ c - a * self.s * self.s * (self.v @ c) for x, a, c in zip(parts, self.alphas, self.c, strict=True)])

    def weights(self) -> np.ndarray:
        return self.base + np.hstack([self.v @ c for c in self.c]) if self.v.shape[1] else self.base


def ridge(x: Design, alphas, tol: float = 1e-10, block: int = 128, keep: int = 1024) -> Fits:
    """For every alpha the weights that minimise ``||y - Xw - b||^2 + alpha ||w||^2`` per output, the intercept free.

    Block Krylov: a step multiplies up to ``block`` new directions, the strongest parts of all open residuals, with the
    Gram matrix; every fit is then the best one in the whole space. ``keep`` directions at most are held; beyond, the
    fits so far become the start of a new space. At alpha 0 the fit is a least-squares solution (its predictions
    are unique, on rank-deficient one-hot columns its weights are not). Residuals that stay above ``tol`` and 1e-7 of
    the right side raise an error.
    """
    alphas = [float(a) for a in alphas]
    k, r = len(alphas), x.r
    wide = k * r
    c = [np.zeros((0, r)) for _ in alphas]

    def start(it):
        for pdf in it:
            for row in pdf.itertuples(index=False):
                diag, rhs = np.frombuffer(row.diag), _matrix(row.rhs, len(np.frombuffer(row.diag)))
                left = np.tile(rhs / np.sqrt(np.where(diag > 0, diag, 1.0))[:, None], (1, k))
                yield pd.DataFrame({"block": [row.block], "m": [row.m], "mean": [row.mean], "diag": [row.diag], "left": [left.tobytes()],
                                    "base": [np.zeros_like(left).tobytes()], "v": [b""], "u": [b""]})

    state = x.panels.mapInPandas(start, _STATE)
    size, worst, width, rel = None, np.inf, 0, np.zeros(wide)
    for _ in range(3 * x.d + 100):
        def norms(row, c=c):
            p = _Panel(row, alphas, c)
            res = p.residual()
            return np.vstack([res.T @ res, (p.m[:, None] * p.s).T @ res])

        got = summed(state, (wide + 1, wide), norms)
        square, along = got[:wide], got[wide]
        length = np.sqrt(np.maximum(np.diag(square), 0))
        size = np.maximum(length, 1e-300) if size is None else size
        rel = length / size
        if rel.max() <= tol:
            break
        restart = False
        for again in (False, True):
            pick = np.flatnonzero(rel > (0 if again else tol))
            scaled = square[np.ix_(pick, pick)] / np.outer(length[pick], length[pick])
            e, q = np.linalg.eigh((scaled + scaled.T) / 2)
            order = np.argsort(-e)[:block]
            order = order[e[order] > 1e-13 * e.max()]
            mix = np.zeros((wide, len(order)))
            mix[pick] = q[:, order] / np.sqrt(e[order]) / length[pick, None]
            if again or width + len(order) <= keep:
                break
            restart = True
        if restart and rel.max() > 0.9 * worst:
            break  # no progress over a whole space
        if restart:
            worst, width = rel.max(), 0
        n, tilt = x.n, along @ mix

        def grown(it, c=c, mix=mix, restart=restart):
            for pdf in it:
                for row in pdf.itertuples(index=False):
                    p = _Panel(row, alphas, c)
                    res = p.residual()
                    q = res @ mix
                    left, base, v, u = (res, p.weights(), q, row.u[:0]) if restart else (p.left, p.base, np.hstack([p.v, q]), p.u)
                    yield pd.DataFrame({"block": [row.block], "m": [row.m], "mean": [row.mean], "diag": [row.diag], "left": [left.tobytes()],
                                        "base": [base.tobytes()], "v": [v.tobytes()], "u": [u if isinstance(u, bytes) else u.tobytes()],
                                        "p": [(p.s * q).tobytes()]})

        new = state.mapInPandas(grown, _STATE + ", p binary")

        def times(it, n=n, tilt=tilt):
            for pdf in it:
                for row in pdf.itertuples(index=False):
                    p = _Panel(row, alphas, [])
                    g = _matrix(row.g, len(p.m)) if row.g is not None else 0.0
                    u = p.s * (g - n * np.outer(p.m, tilt))
                    yield pd.DataFrame({"block": [row.block], "m": [row.m], "mean": [row.mean], "diag": [row.diag], "left": [row.left],
                                        "base": [row.base], "v": [row.v], "u": [np.hstack([p.u, u]).tobytes()]})

        state = new.join(x.gram(new.select("block", "p")), "block", "left").drop("p").mapInPandas(times, _STATE).transform(reliable_checkpoint)
        width += mix.shape[1]

        def projected(row):
            p = _Panel(row, alphas, [])
            return p.v.T @ np.hstack([p.u, p.s * p.s * p.v, p.left])

        got = summed(state, (width, 2 * width + wide), projected)
        h, mass, right = got[:, :width], got[:, width:2 * width], _columns(got[:, 2 * width:], k)
        c = [_solve(h + a * mass, b) for a, b in zip(alphas, right, strict=True)]
    if rel.max() > max(tol, 1e-7):
        raise RuntimeError("the ridge solver did not reach its tolerance")

    def final(it, c=c):
        for pdf in it:
            for row in pdf.itertuples(index=False):
                p = _Panel(row, alphas, c)
                yield pd.DataFrame({"block": [row.block], "w": [(p.s * p.weights()).tobytes()]})

    table = state.mapInPandas(final, "block int, w binary").transform(reliable_checkpoint)
    means = summed(x.panels.select("block", "mean").join(table, "block"), (1, wide),
                   lambda row: np.frombuffer(row.mean)[None] @ np.frombuffer(row.w).reshape(-1, wide))
    return Fits(x, alphas, table, (np.tile(x.my, k) - means[0]).reshape(k, r))


def gradient_gap(x: Design, fits: Fits) -> dict:
    """Largest ``|X'(y - Xw - b) - alpha w|`` per alpha, in units of the largest ``|X'y|`` (a fresh product)."""
    k, r, n = len(fits.alphas), x.r, x.n
    both = x.panels.join(fits.table, "block")
    tilt = summed(both.select("m", "w"), (1, k * r), lambda row: np.frombuffer(row.m)[None] @ np.frombuffer(row.w).reshape(-1, k * r))[0]
    alphas = fits.alphas
    rows = both.join(x.gram(fits.table.select("block", F.col("w").alias("p"))), "block", "left").select("m", "rhs", "w", "g")

    def worst(it):
        for pdf in it:
            for row in pdf.itertuples(index=False):
                m, rhs = np.frombuffer(row.m), _matrix(row.rhs, len(np.frombuffer(row.m)))
                w, g = _matrix(row.w, len(m)), _matrix(row.g, len(m)) if row.g is not None else 0.0
                gap = np.tile(rhs, (1, k)) - (g - n * np.outer(m, tilt)) - np.repeat(alphas, r) * w
                yield pd.DataFrame({"gap": [[float(np.abs(a).max()) for a in _columns(gap, k)]], "rhs": [float(np.abs(rhs).max())]})

    top = rows.mapInPandas(worst, "gap array<double>, rhs double").agg(F.max("rhs"), *[F.max(F.col("gap")[i]) for i in range(k)]).first()
    return {a: top[i + 1] / max(top[0], 1e-300) for i, a in enumerate(alphas)}


def scores(x: Design, fits: Fits) -> dict:
    """A11 + A12 of every fit on the splits of ``x``, from their moments: ``{alpha: {mse, r2}}``; MSE averages over rows and
    outputs, R^2 over outputs that vary."""
    k, r, n = len(fits.alphas), x.r, x.n
    rows = x.panels.join(fits.table, "block").join(x.gram(fits.table.select("block", F.col("w").alias("p"))), "block", "left")

    def product(row):
        m = np.frombuffer(row.m)
        w = _matrix(row.w, len(m))
        g = _matrix(row.g, len(m)) if row.g is not None else np.zeros_like(w)
        return np.vstack([(w * np.tile(_matrix(row.rhs, len(m)), (1, k))).sum(0), (w * g).sum(0), np.frombuffer(row.mean) @ w, m @ w])

    cross, square, mean, m = summed(rows.select("m", "mean", "rhs", "w", "g"), (4, k * r), product)
    bias = np.tile(x.my, k) - mean - np.concatenate([fits.intercept[a] for a in fits.alphas])
    sse = np.tile(x.syy, k) - 2 * cross + square - n * m * m + n * bias * bias
    ok = x.syy > 1e-12 * np.maximum(np.abs(x.syy).max(), 1e-300)
    return {a: {"mse": float(np.mean(e / n)), "r2": float(np.mean(1 - e[ok] / x.syy[ok])) if ok.any() else None}
            for a, e in zip(fits.alphas, sse.reshape(k, r), strict=True)}


def predict(df: DataFrame, fits: Fits, alpha: float, key: str, out_col: str = "pred") -> DataFrame:
    """``df`` (unique ``key``, idx, val) with the prediction of one fit. Weights meet the rows' (feature, value) pairs in a
    join; those of features that every row names (no more than a row is long) are shipped."""
    r = fits.r
    every = sorted(fits.design.moments.shift)
    weights = fits.rows(alpha)
    dense = {w["idx"]: np.asarray(w["w"]) for w in weights.where(F.col("idx").isin(every)).collect()} if every else {}
    pairs = df.select(F.col(key).alias("_k"), F.explode(F.arrays_zip("idx", "val")).alias("e")).select("_k", "e.idx", "e.val")
    part = (pairs.where(~F.col("idx").isin(every)) if every else pairs).join(weights, "idx")
    part = part.select("_k", array_to_vector(F.zip_with("w", F.array_repeat("val", r), lambda a, b: a * b)).alias("v")) \
        .groupBy("_k").agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("_part"))
    b = fits.intercept[alpha]

    def fn(it):
        for pdf in it:
            out = []
            for idx, val, p in zip(pdf["idx"], pdf["val"], pdf["_part"], strict=True):
                y = b + (np.asarray(p) if p is not None else 0.0)
                out.append(y + sum((v * dense[i] for i, v in zip(idx, val, strict=True) if i in dense), np.zeros(r)))
            yield pdf.drop(columns="_part").assign(**{out_col: out})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", {out_col} array<double>"
    return df.join(part, df[key] == F.col("_k"), "left").drop("_k").mapInPandas(fn, schema)


def alpha_search(moments: Moments, train: str, val: str, test: str, alphas=(0.0, 0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0)) -> dict:
    """Pick the alpha with the lowest MSE on split ``val``, refit on train and val and score test. ``refit`` gives the
    winner's fit on all rows (C8) when it is asked for."""
    fits = ridge(Design(moments, [train]), alphas)
    by = scores(Design(moments, [val]), fits)
    best = min(by, key=lambda a: (by[a]["mse"], a))
    both = ridge(Design(moments, [train, val]), [best])
    test_m = scores(Design(moments, [test]), both)[best]
    return {"scores": [{"alpha": a, "val_mse": m["mse"], "val_r2": m["r2"]} for a, m in by.items()], "best_alpha": best,
            "test_mse": test_m["mse"], "test_r2": test_m["r2"], "fits": fits,
            "refit": functools.cache(lambda: ridge(Design(moments, [train, val, test]), [best]))}


def coefficient_table(fits: Fits, alpha: float) -> DataFrame:
    """``(output, feature_idx, weight)`` rows; feature_idx -1 holds the intercept."""
    spark = fits.table.sparkSession
    long = fits.rows(alpha).select(F.col("idx").alias("feature_idx"), F.posexplode("w").alias("output", "weight"))
    icpt = spark.createDataFrame([(j, -1, float(v)) for j, v in enumerate(fits.intercept[alpha])], "output int, feature_idx int, weight double")
    return long.select("output", "feature_idx", "weight").unionByName(icpt)
