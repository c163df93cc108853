"""Token-ID output: tokenised documents in a block file format with a shared zstandard dictionary.

Format. A store is a Parquet folder; each row is one *block* of consecutive documents in ascending
``doc_id`` order (null ids last, equal ids by their token count and checksum):

* ``part``, ``block``: place of the block; blocks in this order hold the documents in order;
* ``first_doc``, ``last_doc``, ``n_docs``, ``n_tokens``: for pruning and prefix sums;
* ``dict_sha256``: hash of the dictionary that the payload needs (empty: none); the dictionary itself
  is a row of the sister folder ``<store>-dictionary``;
* ``width``: bytes per id, 2 or 4 (little-endian, unsigned);
* ``doc_ids``: the ids of its documents; ``offsets``: their ``n_docs + 1`` byte offsets in ``payload``;
* ``payload``: one zstandard frame per document, so that one short document is read by its offset.

The dictionary is fitted on a bounded sample of serialised id arrays (``sample_docs`` documents of at
most ``sample_chars`` characters, picked by a hash of the id); it changes only the size of the files. Every
document is encoded whole and written. Null text is an empty document (the end id alone).
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.common import frees, materialise, small_batches
from cadenza.session import ensure_checkpoint_dir

END_ID = 1
DICT_BYTES = 64 << 10
BLOCK_BYTES = 2 << 20
PART_BYTES = 32 << 20
_PUNCT = ".,;:!?"
# Letters that normalising and lower-casing turn into letters only.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e]+").fullmatch
# Python splits words there, the tokenizer does not.
_CONTROL = re.compile("[\x1c-\x1f]").search


class WordEncoder:
    """Token ids of whole texts through a bounded cache of words.

    The tokenizer's normaliser and splitter never join characters across white space, so a text's ids
    are its words' ids in turn. A run of plain letters is also split from the ASCII marks that end it and
    goes straight to the merge model, if the tokenizer lower-cases and maps bytes as probed at the start.
    The cache has two generations: when the young one is full it replaces the old one, and words in use
    move back, so frequent words stay.
    """

    def __init__(self, tokenizer_file: str, end_id: int = END_ID, bound: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tok = Tokenizer.from_file(tokenizer_file)
        self.dtype = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else np.uint32
        self.code = "H" if self.dtype is np.uint16 else "I"
        self.merge = self.tok.model.tokenize
        self.end = np.array([end_id], self.dtype).tobytes()
        self.half = bound // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        letters = [chr(c) for c in range(0x41, 0x17F) if _PLAIN(chr(c))]
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.mapped = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
        probes = letters + ["".join(letters[i:i + 7]) for i in range(0, len(letters), 5)] + ["word", "Word", "ÀÉÎõü", "STRASSE"]
        self.plain = all(self._direct(w + m) == self._letters(w.lower()) + (self._direct(m) if m else b"")
                         for w in probes for m in ("", *_PUNCT, ".,"))

    def _direct(self, word: str) -> bytes:
        return array(self.code, self.tok.encode(word, add_special_tokens=False).ids).tobytes()

    def _letters(self, word: str) -> bytes:
        return array(self.code, [t.id for t in self.merge(word if word.isascii() else word.translate(self.mapped))]).tobytes()

    def _cached(self, word: str, make) -> bytes:
        out = self.old.get(word)
        if out is None:
            out = make(word)
        if len(word) <= 40:
            self.young[word] = out
        return out

    def _word(self, word: str) -> bytes:
        """Ids of a word that is not in the young generation."""
        core = word.rstrip(_PUNCT)
        if not self.plain or not (_PLAIN(core) if not core.isascii() else core.isalpha()):
            return self._cached(word, self._direct)
        low = core.lower()
        out = self.young.get(low)
        seen = out is not None
        if not seen:
            out = self._cached(low, self._letters)
            if low is word or low == word:
                return out
        if core != word:
            marks = word[len(core):]
            out = out + (self.young.get(marks) or self._cached(marks, self._direct))
        if seen and len(word) <= 40:  # a word met again in this form
            self.young[word] = out
        return out

    def encode(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        if _CONTROL(text):
            return self._direct(text) + self.end
        get, word = self.young.get, self._word
        parts = [get(w) or word(w) for w in text.split()]
        parts.append(self.end)
        return b"".join(parts)


def _path(tokenizer: str) -> str:
    """A file path, or the name of a file of the installed public tokenizers."""
    if os.path.isabs(tokenizer):
        return tokenizer
    import public_tokenizers

    return public_tokenizers.path(tokenizer)


def _encoder(tokenizer: str, end_id: int, kept: dict = {}) -> WordEncoder:  # noqa: B006  (one per worker process)
    key = (tokenizer, end_id)
    if key not in kept:
        kept.clear()
        kept[key] = WordEncoder(_path(tokenizer), end_id)
    return kept[key]


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, sample_docs: int, sample_chars: int) -> bytes:
    """A zstandard dictionary of at most 64 KiB from the bounded sample; empty if there is no text."""
    import zstandard

    every = max(1, docs.count() // max(1, sample_docs))
    picked = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.length("text")), F.lit(every)) == 0
    texts = [r["text"] for r in docs.where(F.length("text").between(1, sample_chars) & picked)
             .select("text").limit(sample_docs).collect()]
    enc = _encoder(tokenizer, end_id)
    arrays = [enc.encode(t) for t in texts]
    if not arrays:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their bytes serve as they are
        return b"".join(arrays)[-DICT_BYTES:]


def _zdict(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if data else None


def _bytes_of(df: DataFrame, col: str) -> int:
    return df.agg(F.coalesce(F.sum(F.length(col)), F.lit(0))).first()[0]


def write_store(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID,
                level: int = 1, sample_docs: int = 500, sample_chars: int = 16_384,
                block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES) -> None:
    """Encode ``docs`` (doc_id, text) and write the store at ``path`` (a folder that all executors share)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    dictionary = train_dictionary(docs, tokenizer, end_id, sample_docs, sample_chars)
    digest = hashlib.sha256(dictionary).hexdigest() if dictionary else ""
    spark.createDataFrame([(digest, bytearray(dictionary))], "dict_sha256 string, bytes binary") \
        .write.mode("overwrite").parquet(f"{path}-dictionary")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        enc = _encoder(tokenizer, end_id)
        z = zstandard.ZstdCompressor(level=level, dict_data=_zdict(dictionary), write_checksum=False)
        width = np.dtype(enc.dtype).itemsize
        row = 0
        for pdf in batches:
            n, crc, frames = [], [], []
            for t in pdf["text"]:
                ids = enc.encode(t if isinstance(t, str) else None)
                n.append(len(ids) // width)
                crc.append(zlib.crc32(ids))
                frames.append(z.compress(ids))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": n, "crc": crc, "salt": range(row, row + len(n)),
                                "width": width, "frame": frames})
            row += len(n)
        enc.old = {}  # the worker may serve other stages next

    encoded = materialise(docs.mapInPandas(
        frees(encode), "doc_id bigint, n_tokens bigint, crc bigint, salt bigint, width int, frame binary"), "encoded")
    parts = max(1, -(-_bytes_of(encoded, "frame") // part_bytes))
    # The salt only spreads equal rows of one id over several parts; they are interchangeable.
    order = [F.col("doc_id").asc_nulls_last(), F.col("n_tokens"), F.col("crc"), F.col("salt")]
    ordered = (encoded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
               .withColumn("part", F.spark_partition_id()))

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, frames, tokens, size, block, part, width = [], [], 0, 0, 0, 0, 2

        def flush():
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8").tobytes()
            known = [i for i in ids if i is not None]
            return pd.DataFrame({
                "part": [part], "block": [block], "first_doc": pd.array([known[0] if known else None], "Int64"),
                "last_doc": pd.array([known[-1] if known else None], "Int64"), "n_docs": [len(ids)],
                "n_tokens": [tokens], "dict_sha256": [digest], "width": [width], "doc_ids": [list(ids)],
                "offsets": [offsets], "payload": [b"".join(frames)]})

        for pdf in batches:
            for d, n, w, p, f in zip(pdf["doc_id"], pdf["n_tokens"], pdf["width"], pdf["part"], pdf["frame"], strict=True):
                ids.append(None if pd.isna(d) else int(d))
                frames.append(f)
                tokens, size, part, width = tokens + n, size + len(f), p, w
                if size >= block_bytes or len(ids) >= 4096:
                    yield flush()
                    ids, frames, tokens, size, block = [], [], 0, 0, block + 1
        if ids:
            yield flush()

    ordered.mapInPandas(frees(blocks), (
        "part int, block int, first_doc bigint, last_doc bigint, n_docs int, n_tokens bigint, dict_sha256 string, "
        "width int, doc_ids array<bigint>, offsets binary, payload binary")) \
        .write.mode("overwrite").option("compression", "none").parquet(path)


def _dictionary(spark: SparkSession, path: str) -> bytes:
    """The store's dictionary (64 KiB at most), checked against its hash."""
    row = spark.read.parquet(f"{path}-dictionary").first()
    data = bytes(row["bytes"])
    if data and hashlib.sha256(data).hexdigest() != row["dict_sha256"]:
        raise ValueError("the dictionary does not match its hash")
    return data


def _decode(frame: bytes, z, width: int) -> np.ndarray:
    return np.frombuffer(z.decompress(frame), "<u2" if width == 2 else "<u4").astype("<u4")


def read_store(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32 (and the ids if asked for)."""
    small_batches(spark)
    dictionary = _dictionary(spark, path)
    digest = hashlib.sha256(dictionary).hexdigest() if dictionary else ""
    store = spark.read.parquet(path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        z = zstandard.ZstdDecompressor(dict_data=_zdict(dictionary))
        for pdf in batches:
            for part, block, sha, width, doc_ids, offsets, payload in zip(
                    pdf["part"], pdf["block"], pdf["dict_sha256"], pdf["width"], pdf["doc_ids"], pdf["offsets"],
                    pdf["payload"], strict=True):
                if sha != digest:
                    raise ValueError("a block needs another dictionary")
                at = np.frombuffer(offsets, "<u8").astype(np.int64)
                arrays = [_decode(payload[at[i]:at[i + 1]], z, width) for i in range(len(at) - 1)]
                n = np.array([len(a) for a in arrays], np.int64)
                out = pd.DataFrame({
                    "part": part, "block": block, "inside": np.cumsum(n) - n,
                    "doc_id": pd.array([None if pd.isna(d) else int(d) for d in doc_ids], "Int64"), "n_tokens": n,
                    "ids_crc32": [zlib.crc32(a.tobytes()) for a in arrays]})
                if with_ids:
                    out["ids"] = [a.tolist() for a in arrays]
                yield out

    ids = ", ids array<bigint>" if with_ids else ""
    docs = store.select("part", "block", "dict_sha256", "width", "doc_ids", "offsets", "payload").mapInPandas(
        decode, "part int, block int, inside bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint" + ids)
    heads = store.select("part", "block", "n_tokens")
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = heads.groupBy("part").agg(F.sum("n_tokens").alias("t"))  # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    starts = (heads.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)))
              .join(bases, "part").select("part", "block", (F.col("base") + F.col("in_part")).alias("at")))
    return (docs.join(starts, ["part", "block"])
            .select("doc_id", (F.col("at") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32",
                    *(["ids"] if with_ids else [])))


def fetch(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of every document with this id: only blocks whose id range holds it are read, and of them
    only the frames at its offsets are decompressed."""
    import zstandard

    z = zstandard.ZstdDecompressor(dict_data=_zdict(_dictionary(spark, path)))
    hits = spark.read.parquet(path).where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)) \
        .select("width", "offsets", "payload", F.expr(f"filter(transform(doc_ids, (d, i) -> if(d = {int(doc_id)}L, i, null)), x -> x is not null)").alias("at"))
    out = []
    for r in hits.select("width", F.explode("at").alias("i"), "offsets", "payload").select(
            "width", F.expr("substring(offsets, i * 8 + 1, 16)").alias("o"), "payload").toLocalIterator():
        a, b = struct.unpack("<QQ", bytes(r["o"]))
        out.append(_decode(bytes(r["payload"])[a:b], z, r["width"]).tolist())
    return out


def token_report(docs: DataFrame, **options) -> DataFrame:
    """Write a store in the shared folder and read it back."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cadenza-llm/tokens-{uuid.uuid4().hex}"
    write_store(docs, path, **options)
    return read_store(spark, path)
