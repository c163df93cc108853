"""Quality rules, line first: judge every line, remove the failing ones, then reject documents
that lose too much text.

Line rules (a line without words never fails):

* punctuation: over ``symbol_words_pct`` % of its words hold a character of ``#*$%&|<>`` or end in ``!!``;
* navigation: three or more of its words, and ``separator_words_pct`` % of them or more, are menu separators (``|``,
  ``>``, ``/`` or a middle dot), so that a few separators in a long line fail nothing;
* boilerplate: at most ``boilerplate_words`` words, one of the fixed phrases among them.

A document is rejected when the failing lines hold more than ``max_lost_pct`` % of its words, or when
it fails the base rules (fewer than 50 words, or over half of them in repeated 3-word windows).
Words are runs of characters other than space and ``\\x09-\\x0D``. Null and empty texts have no words
and are rejected; every row gives one row, repeated rows and null ids included.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import free_name, release, small_batches

SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", ">", "/", "·")
# Phrases of notices and page furniture, lower case.
BOILERPLATE = (
    "all rights reserved", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "released under the", "licensed under the", "subscribe to our newsletter", "javascript is disabled",
)

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_lost_words long, base_failed boolean, kept boolean, clean_text string")


def _line_fails(low: bytes, words: list[bytes], symbol_words_pct: int, boilerplate_words: int,
                separator_words_pct: int, phrases: tuple, separators: frozenset, drop: bytes) -> bool:
    n = len(words)
    if len(low.translate(None, drop)) != len(low) or b"!!" in low:
        bad = sum(1 for w in words if w.endswith(b"!!") or len(w.translate(None, drop)) != len(w))
        if 100 * bad > symbol_words_pct * n:
            return True
    if n >= 3:
        menu = sum(1 for w in words if w in separators)
        if menu >= 3 and 100 * menu >= separator_words_pct * n:
            return True
    return n <= boilerplate_words and any(p in low for p in phrases)


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that are found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict = {}
    again = set()
    for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
        j = seen.setdefault(w, i)
        if j != i:
            again.add(j)
            again.add(i)
    if not again:
        return 0
    covered, end = 0, -1
    for i in sorted(again):
        covered += i + 3 - max(i, end)
        end = i + 3
    return covered


def assess_text(text: str | None, symbol_words_pct: int = 30, boilerplate_words: int = 20,
                max_lost_pct: int = 40, separator_words_pct: int = 10) -> tuple:
    if text is None:
        return 0, 0, 0, 0, 0, 0, True, False, None
    drop = SYMBOLS.encode()
    phrases = tuple(p.encode() for p in BOILERPLATE)
    separators = frozenset(s.encode() for s in SEPARATORS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    n_symbols = len(raw) - len(raw.translate(None, drop))
    dup = lost = 0
    seen, keep = set(), []
    for line in raw.split(b"\n"):
        lw = line.split()
        if lw:
            if line in seen:
                dup += 1
            else:
                seen.add(line)
            if _line_fails(line.lower(), lw, symbol_words_pct, boilerplate_words, separator_words_pct, phrases,
                           separators, drop):
                lost += len(lw)
                continue
        keep.append(line)
    rep = _repeat_words(words)
    base_failed = n < 50 or 100 * rep > 50 * n
    kept = not base_failed and 100 * lost <= max_lost_pct * n
    clean = text if not lost else b"\n".join(keep).decode("utf-8", "surrogatepass")
    return n, word_chars, n_symbols, dup, rep, lost, base_failed, kept, clean


def assess(docs: DataFrame, text_col: str = "text", symbol_words_pct: int = 30, boilerplate_words: int = 20,
           max_lost_pct: int = 40, with_text: bool = True, separator_words_pct: int = 10) -> tuple[DataFrame, str]:
    """``docs`` plus one struct column with the counts, the verdict and the cleaned text; returns the
    frame and the name of that column (chosen so that it never clashes). No shuffle."""
    small_batches(docs.sparkSession)
    names = [x.split()[0] for x in RESULT.split(", ")]

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = [assess_text(t, symbol_words_pct, boilerplate_words, max_lost_pct, separator_words_pct) for t in s]
            out = pd.DataFrame(rows, columns=names)
            if not with_text:
                out["clean_text"] = None
            yield out
        release()

    name = free_name(docs, "quality")
    # Called non-deterministic, so that the planner keeps one call for the filter and the columns behind it.
    return docs.withColumn(name, judge.asNondeterministic()(F.col(text_col))), name


def quality_report(docs: DataFrame, **rules) -> DataFrame:
    """One row per document: id, counts, ``base_failed``, ``kept``."""
    out, q = assess(docs.select("doc_id", "text"), with_text=False, **rules)
    return out.select("doc_id", *[f"{q}.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                       "n_repeat_words", "n_lost_words", "base_failed", "kept")])


def keep_good(docs: DataFrame, **rules) -> DataFrame:
    """The kept documents with failing lines removed and ``n_chars`` renewed; same columns as ``docs``."""
    out, q = assess(docs, **rules)
    fresh = {"text": F.col(f"{q}.clean_text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length(f"{q}.clean_text").cast(docs.schema["n_chars"].dataType)
    return out.where(F.col(f"{q}.kept")).withColumns(fresh).select(*docs.columns)
