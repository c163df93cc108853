"""Spelling variant grouping by finite-state composition.

Words. Maximal runs of letters (``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased) of whole texts; with ``typo_every`` a run
loses one code point where the crc32 of ``<doc_id>:<run>`` is divisible by it, which plants variants. The
vocabulary holds the results of at least ``min_length`` code points that occur at least ``min_count`` times.

Pairs. Two words are near if one insertion, deletion or replacement of a code point turns one into the other. The
accepted pairs of A o T o A are enumerated, with A the minimised acceptor of the vocabulary and T the transducer
of exactly one edit. A state of the composition is (p, edits so far, q). Before the edit both sides have read the
same prefix, so p = q, and after it the rest must be equal, so what is accepted is the meet of two right
languages, which minimal states share between prefixes.

Partitions. The composition is dealt by what its initial state reads: pairs that agree in the first code point go
to that code point's partition, where the acceptor of the remainders is built and composed. Pairs whose edit comes
there are the edit arcs of the state itself: words that are equal but for that place, found by one equi-grouping on
the remainder (at most one word per letter of the alphabet and one without, a bounded group). A partition with more
than ``GROUP`` words is split in the same way at the next code point, so no task holds a larger one.

Every pair is given once: a deletion inside a run of equal letters is taken at the end of the run.

Form. The near word that occurs most (ties: smallest in code-point order), if it occurs at least twice as often
as the word; root: the last word along the forms (counts double at each step, so the chain ends).

Null and empty texts have no words. A row with a null id gives its runs unchanged. Repeated rows count each. An empty
table, or one without words, gives an empty result. Words of any length are whole words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import frees, materialise, small_batches, tidy

TYPO_EVERY = 97
MIN_LENGTH = 5
MIN_COUNT = 3
GROUP = 8192
_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def variant(run: str, doc_id: str | None, typo_every: int) -> str:
    if typo_every and doc_id is not None:
        h = zlib.crc32(f"{doc_id}:{run}".encode("utf-8", "surrogatepass"))
        if h % typo_every == 0:
            p = h % len(run)
            return run[:p] + run[p + 1:]
    return run


def vocabulary(docs: DataFrame, typo_every: int = TYPO_EVERY, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the words of all texts and how often they occur; counted in the tasks before the shuffle."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def counted() -> pd.DataFrame:
            return pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())}).astype({"word": "object", "n": "int64"})

        for pdf in batches:
            for d, text in zip(pdf["id"], pdf["text"], strict=True):
                if not isinstance(text, str):
                    continue
                low = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
                for run, k in Counter(_RUN.findall(low)).items():
                    if len(run) >= min_length:
                        word = variant(run, d if isinstance(d, str) else None, typo_every)
                        if len(word) >= min_length:
                            seen[word] += k
                if len(seen) > 100_000:
                    yield counted()
                    seen.clear()
        yield counted()

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInPandas(frees(scan), "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Acceptor:
    """Minimal deterministic acceptor of sorted distinct words: arcs[state] = {code point: state}."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[False, []]]  # the states of the last word's prefixes, still open: final, arcs

        def close(to: int, word: str) -> None:
            while len(path) > to + 1:
                end, arcs = path.pop()
                key = (end, tuple(arcs))
                state = known.get(key)
                if state is None:
                    state = known[key] = len(self.arcs)
                    self.arcs.append(dict(arcs))
                    self.final.append(end)
                path[-1][1].append((word[len(path) - 1], state))

        last = ""
        for w in words:
            same = 0
            for x, y in zip(last, w, strict=False):
                if x != y:
                    break
                same += 1
            close(same, last)
            path.extend([False, []] for _ in range(len(w) - same))
            path[len(w)][0] = True
            last = w
        close(0, last)
        self.root = len(self.arcs)
        self.arcs.append(dict(path[0][1]))
        self.final.append(path[0][0])


class Composition:
    """Pairs accepted by A o T o A, T being one insertion, deletion or replacement."""

    def __init__(self, a: Acceptor):
        self.a = a
        self._meets: dict[tuple[int, int], tuple[bool, bool, list]] = {}
        self._edits: dict[int, tuple[list, list]] = {}

    def meet(self, p: int, q: int) -> tuple[bool, bool, list]:
        """Of the words that both states accept: any, the empty one, and the arcs that lead to the others."""
        arcs, final, found = self.a.arcs, self.a.final, self._meets
        todo = [(p, q)]
        while todo:
            key = todo[-1]
            if key in found:
                todo.pop()
                continue
            x, y = arcs[key[0]], arcs[key[1]]
            both = [(c, (x[c], y[c])) for c in (x if len(x) <= len(y) else y) if c in x and c in y]
            open_ = [k for _, k in both if k not in found]
            if open_:
                todo += open_
                continue
            end = final[key[0]] and final[key[1]]
            live = [(c, k) for c, k in both if found[k][0]]
            found[key] = (end or bool(live), end, live)
            todo.pop()
        return found[p, q]

    def rests(self, p: int, q: int, but: str = "") -> Iterator[str]:
        """The words that both states accept, without those that begin with ``but``."""
        stack = [(p, q, 0, "")]
        read: list[str] = []
        while stack:
            p, q, depth, c = stack.pop()
            del read[max(depth - 1, 0):]
            if depth:
                read.append(c)
            _, end, live = self.meet(p, q)
            if end:
                yield "".join(read)
            stack += [(k[0], k[1], depth + 1, x) for x, k in live if depth or x != but]

    def edits(self, q: int) -> tuple[list, list]:
        """Edit arcs out of (q, 0, q) from which a final state can be reached."""
        got = self._edits.get(q)
        if got is None:
            arcs = list(self.a.arcs[q].items())
            swaps = [(c, p, d, r) for i, (c, p) in enumerate(arcs) for d, r in arcs[i + 1:] if self.meet(p, r)[0]]
            drops = [(c, p) for c, p in arcs if self.meet(p, q)[0]]
            got = self._edits[q] = (swaps, drops)
        return got

    def pairs(self) -> Iterator[tuple[str, str]]:
        stack = [(self.a.root, 0, "")]
        read: list[str] = []
        while stack:
            q, depth, c = stack.pop()
            del read[max(depth - 1, 0):]
            if depth:
                read.append(c)
            swaps, drops = self.edits(q)
            if swaps or drops:
                u = "".join(read)
                for x, p, y, r in swaps:
                    for rest in self.rests(p, r):
                        yield u + x + rest, u + y + rest
                for x, p in drops:
                    for rest in self.rests(p, q, x):
                        yield u + x + rest, u + rest
            stack += [(t, depth + 1, x) for x, t in self.a.arcs[q].items()]


def _composed(parts: DataFrame) -> DataFrame:
    """word, near, near_n of the pairs inside each partition (head, word, n)."""
    dealt = parts.select("head", "word", "n").repartition("head").sortWithinPartitions("head", "word")

    def found(head: str, count: dict[str, int]) -> pd.DataFrame:
        out: list[tuple[str, str, int]] = []
        cut = len(head)
        for x, y in Composition(Acceptor([w[cut:] for w in count])).pairs():
            x, y = head + x, head + y
            out += [(x, y, count[y]), (y, x, count[x])]
        return pd.DataFrame(out, columns=["word", "near", "near_n"]).astype({"near_n": "int64"})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, count = None, {}
        for pdf in batches:
            for head, word, n in zip(pdf["head"], pdf["word"], pdf["n"], strict=True):
                if head != at:
                    if len(count) > 1:
                        yield found(at, count)
                    at, count = head, {}
                count[word] = n
        if len(count) > 1:
            yield found(at, count)

    return dealt.mapInPandas(frees(scan), "word string, near string, near_n bigint")


def _edited_here(words: DataFrame, depth: int) -> DataFrame:
    """word, near, near_n of the pairs whose edit stands at code point ``depth``, all before it being equal."""
    def key(at: int):
        return F.concat(F.substring("word", 1, depth), F.lit(" "), F.expr(f"substring(word, {at})"))

    holes = words.where(F.length("word") > depth).select(key(depth + 2).alias("key"), F.expr(f"substring(word, {depth + 1}, 1)").alias("c"),
                                                         F.expr(f"substring(word, {depth + 2}, 1)").alias("next"), "word", "n")
    wholes = words.select(key(depth + 1).alias("key"), F.lit("").alias("c"), F.expr(f"substring(word, {depth + 1}, 1)").alias("next"), "word", "n")
    rows = holes.unionByName(wholes)
    # A group holds one word per letter that stands in the gap, and the word without it: the alphabet bounds it.
    groups = rows.groupBy("key", "next").agg(F.collect_list(F.struct("c", "word", "n")).alias("g")).where(F.size("g") > 1)
    pairs = groups.select("next", F.explode("g").alias("x"), "g").select("next", "x", F.explode("g").alias("y"))
    # A deletion inside a run is taken at its end, where the next letter differs.
    longest = F.greatest("x.c", "y.c")
    whole = (F.col("x.c") == "") | (F.col("y.c") == "")
    return pairs.where((F.col("x.c") != F.col("y.c")) & (~whole | (longest != F.col("next")))) \
        .select(F.col("x.word").alias("word"), F.col("y.word").alias("near"), F.col("y.n").alias("near_n"))


def near_pairs(vocab: DataFrame) -> DataFrame:
    """word, near, near_n: every pair of near words of ``vocab`` (word, n), both ways, each once."""
    open_, ready, found, depth = vocab, None, None, 0
    while True:
        here = _edited_here(open_, depth)
        found = here if found is None else found.unionByName(here)
        depth += 1
        # Words that end here have no further code point to read.
        parts = open_.where(F.length("word") >= depth).select(F.substring("word", 1, depth).alias("head"), "word", "n")
        large = materialise(parts.groupBy("head").count().where(F.col("count") > GROUP).select("head"), "large_heads")
        if large.isEmpty():
            parts = parts if ready is None else ready.unionByName(parts)
            return found.unionByName(_composed(parts))
        light = parts.join(large, "head", "left_anti").select("head", "word", "n")
        ready = light if ready is None else ready.unionByName(light)
        open_ = materialise(parts.join(large, "head", "left_semi").select("word", "n"), "large_words")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of ``forms`` (word, form; no cycles), by pointer doubling."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = materialise(now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"),
                                                                  F.col("ahead").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


@tidy
def spelling_variants(docs: DataFrame, typo_every: int = TYPO_EVERY, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    vocab = materialise(vocabulary(docs, typo_every, min_length, min_count), "vocabulary")
    best = near_pairs(vocab).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    most = -F.col("b.m")
    formed = materialise(vocab.join(best, "word", "left").withColumn("is_form", most >= 2 * F.col("n")).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("is_form"), F.col("b.near")).alias("form"), F.when(F.col("is_form"), most).alias("form_n")), "forms")
    last = roots(formed.where("form is not null").select("word", "form"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
