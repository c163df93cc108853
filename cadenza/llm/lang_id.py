"""Language identification: multinomial naive Bayes over hashed character 1- to 4-grams.

Training sums n-gram counts of all learnable documents per language on the executors (one blob of
counts per task, language and bucket block, added up after a shuffle). The model is a log-probability
matrix of ``buckets x languages``, cut into groups of at most ``max_langs`` languages, so that what is broadcast at a
time is bounded. Scoring is batched in numpy: hash every n-gram of a batch, gather matrix rows,
add them up per document. More languages than one group holds take one pass per group: the best language so far and the
total of all likelihoods are written with the documents between passes, and the result is that of one matrix.

A null text or one without letters gives ``und`` with score 0; so does every text when there is no
training row. Ties go to the first language in code-point order. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import frees, free_name, materialise, mix64, small_batches

BUCKETS = 1 << 15
BLOCK = 1 << 12
ORDERS = (1, 2, 3, 4)
CHUNK_CHARS = 1 << 19
LETTER = re.compile(r"[^\W\d_]")
# ASCII that is no letter counts as a space, so marks and digits carry no weight.
_ASCII = np.array([c if 97 <= c <= 122 else 32 for c in range(128)], np.uint32)


def gram_buckets(texts: list[str], buckets: int = BUCKETS, orders: tuple = ORDERS):
    """Bucket of every n-gram, order by order, and the start of each text; n-grams that would leave
    their text go to the extra bucket ``buckets``."""
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_ = x < 128
    x = np.where(ascii_, _ASCII[np.where(ascii_, x, 0)], x)
    left = np.repeat(np.cumsum(lens), lens) - np.arange(len(x))
    starts = np.cumsum(lens) - lens
    out = []
    h = np.zeros(len(x), np.uint64)
    for n in range(1, max(orders) + 1):
        nxt = np.zeros(len(x), np.uint64)
        nxt[: len(x) - n + 1] = x[n - 1:]
        h = h * np.uint64(0x9E3779B97F4A7C15) + nxt + np.uint64(n)
        if n in orders:
            b = (mix64(h) >> np.uint64(40)).astype(np.int64) & (buckets - 1)
            b[left < n] = buckets
            out.append(b)
    return out, starts, lens


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters, with the index of the first."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, texts[at:]


def count_grams(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(lang, block, counts) summed over ``docs``; block -1 holds the number of documents."""
    small_batches(docs.sparkSession)

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                acc = sums.setdefault(lang, np.zeros(buckets + 1, np.int64))
                n_docs[lang] = n_docs.get(lang, 0) + len(part)
                for _, some in chunks([t.lower() for t in part["text"] if t]):
                    for b in gram_buckets(some, buckets)[0]:
                        acc += np.bincount(b, minlength=buckets + 1)
        for lang, acc in sums.items():
            rows = [(lang, -1, np.array([n_docs[lang]], np.int64).tobytes())]
            rows += [(lang, i, acc[i * BLOCK:(i + 1) * BLOCK].tobytes()) for i in range(buckets // BLOCK)]
            yield pd.DataFrame(rows, columns=["lang", "block", "counts"])

    def add(key, pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum((np.frombuffer(c, np.int64) for c in pdf["counts"]), start=np.int64(0))
        return pd.DataFrame([(key[0], key[1], total.tobytes())], columns=["lang", "block", "counts"])

    schema = "lang string, block int, counts binary"
    part = docs.where("lang is not null").select("lang", "text").mapInPandas(frees(local), schema)
    # Two levels, so that no task gathers the blobs of every map task at once.
    spread = part.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(64)))
    first = spread.groupBy("lang", "block", "slot").applyInPandas(
        lambda key, pdf: add((key[0], key[1]), pdf), schema)
    return first.groupBy("lang", "block").applyInPandas(add, schema)


def train_groups(docs: DataFrame, buckets: int = BUCKETS, max_langs: int = 500, smooth: float = 0.5) -> Iterator[tuple]:
    """(languages, log-probability matrix [buckets + 1, languages], log priors) of each group of at most ``max_langs``
    languages in code-point order; only one group is on the driver at a time."""
    counts = materialise(count_grams(docs, buckets), "grams")
    sizes = {r["lang"]: int(np.frombuffer(r["counts"], np.int64)[0]) for r in counts.where("block = -1").collect()}
    every = sorted(sizes)
    n_docs = max(sum(sizes.values()), 1)
    for at in range(0, len(every), max_langs):
        langs = every[at:at + max_langs]
        m = np.zeros((buckets + 1, len(langs)))
        place = {lang: k for k, lang in enumerate(langs)}
        for r in counts.where((F.col("block") >= 0) & F.col("lang").between(langs[0], langs[-1])).collect():
            m[r["block"] * BLOCK:(r["block"] + 1) * BLOCK, place[r["lang"]]] = np.frombuffer(r["counts"], np.int64)
        logp = np.log(m + smooth) - np.log(m[:buckets].sum(axis=0) + smooth * buckets)
        logp[buckets] = 0.0
        yield langs, logp.astype(np.float32), np.log(np.array([max(sizes[la], 1) for la in langs]) / n_docs)


def train(docs: DataFrame, buckets: int = BUCKETS, max_langs: int = 500, smooth: float = 0.5):
    """The one group of ``train_groups``; an error if there are more languages than it holds."""
    groups = train_groups(docs, buckets, max_langs, smooth)
    model = next(groups, ([], np.zeros((buckets + 1, 0), np.float32), np.zeros(0)))
    if next(groups, None) is not None:
        raise ValueError(f"more than max_langs={max_langs} languages: use train_groups and identify")
    return model


def group_scores(texts: list, langs: list[str], logp: np.ndarray, prior: np.ndarray):
    """Per text: the best language (null for a text without letters or without languages), its log score, and of the
    tempered logits that of the best language and log-sum-exp over the group. Tempering weighs at most 100 n-grams' worth
    of evidence, else every long text would have probability 1."""
    best_lang, value = [None] * len(texts), np.zeros((3, len(texts)))
    at = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
    if not langs:
        return best_lang, value
    buckets = len(logp) - 1
    for first, some in chunks([texts[i].lower() for i in at]):
        grams, starts, lens = gram_buckets(some, buckets)
        total = np.zeros((len(some), len(langs)))
        for k in range(len(langs)):
            col = np.ascontiguousarray(logp[:, k])
            for b in grams:
                total[:, k] += np.add.reduceat(col[b], starts, dtype=np.float64)
        best = np.argmax(total + prior, axis=1)
        rows, here = np.arange(len(some)), at[first:first + len(some)]
        z = total * np.minimum(1.0, 100.0 / np.maximum(lens * len(grams), 1))[:, None] + prior
        top = z.max(axis=1)
        value[:, here] = (total + prior)[rows, best], z[rows, best], top + np.log(np.exp(z - top[:, None]).sum(axis=1))
        for i, k in zip(here, best, strict=True):
            best_lang[i] = langs[k]
    return best_lang, value


def predict_texts(texts: list, langs: list[str], logp: np.ndarray, prior: np.ndarray) -> tuple[list, list]:
    """Best language and its probability by one matrix."""
    best, (_, z, all_z) = group_scores(texts, langs, logp, prior)
    return ["und" if b is None else b for b in best], [0.0 if b is None else float(p) for b, p in zip(best, np.exp(z - all_z), strict=True)]


_STATE = "best string, total double, z double, all_z double"


def _scores(spark, model):
    """Pandas UDF text -> state of one group of languages."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # buckets x max_langs floats at most

    @F.pandas_udf(_STATE)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            best, value = group_scores([t if isinstance(t, str) else None for t in s], *shared.value)
            yield pd.DataFrame({"best": best, "total": value[0], "z": value[1], "all_z": value[2]})

    return score


def identify(docs: DataFrame, groups, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a column struct(lang_pred, score), and the (free) name of that column. ``groups``: models of
    ``train_groups``."""
    name = free_name(docs, "language")
    out, new = None, name + "_new"
    for model in groups:
        score = _scores(docs.sparkSession, model)
        if out is None:
            out = docs.withColumn(name, score(F.col(text_col)))
            continue
        # The first group wins a tie: its languages come first in code-point order.
        out = materialise(out, "languages").withColumn(new, score(F.col(text_col)))
        old, now = F.col(name), F.col(new)
        high, low = F.greatest(old["all_z"], now["all_z"]), F.least(old["all_z"], now["all_z"])
        pick = now["total"] > old["total"]
        out = out.withColumn(name, F.when(old["best"].isNull(), now).otherwise(F.struct(
            F.when(pick, now["best"]).otherwise(old["best"]).alias("best"), F.greatest(old["total"], now["total"]).alias("total"),
            F.when(pick, now["z"]).otherwise(old["z"]).alias("z"), (high + F.log1p(F.exp(low - high))).alias("all_z")))).drop(new)
    if out is None:  # nothing to learn from
        out = docs.withColumn(name, F.lit(None).cast("struct<best:string,total:double,z:double,all_z:double>"))
    p = F.col(name)
    unknown = F.coalesce(p["best"].isNull(), F.lit(True))
    return out.withColumn(name, F.struct(
        F.when(unknown, F.lit("und")).otherwise(p["best"]).alias("lang_pred"),
        F.when(unknown, F.lit(0.0)).otherwise(F.exp(p["z"] - p["all_z"])).alias("score"))), name


def held_out():
    """crc32 of the id as text, modulo 3, is 1; a null id counts as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))


def language_report(docs: DataFrame, max_langs: int = 500) -> DataFrame:
    """Train on the learnable documents, predict all."""
    groups = train_groups(docs.where(~held_out()).select("lang", "text"), max_langs=max_langs)
    out, p = identify(docs.select("doc_id", "text"), groups)
    return out.select("doc_id", held_out().alias("held_out"), f"{p}.lang_pred", f"{p}.score")
