"""Quality rules by compression bands (operator 7).

A text that compresses far better than prose is repetitive (loops, copied
lines, menus); one that hardly compresses is noise (encoded data, keyboard
junk).  The zstandard ratio (compressed / raw bytes) is taken over the whole
document and over each fixed-size chunk, the last one being the text's last
bytes (a text shorter than a chunk is judged whole); the limits depend on the
length, because a short text cannot reach the ratio of a long one.

Row-local: one Arrow-batched pass, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm.common import fresh

#: (bytes from, lowest ratio, highest ratio): the last band whose first number
#: is not above the text's size holds.  Under 64 bytes the frame overhead of
#: the codec hides the content, so only the base rules speak there.
#: The highest ratios lie between clean text and base64 of the same length.
BANDS = ((0, 0.0, float("inf")), (64, 0.35, 1.25), (256, 0.24, 0.84), (512, 0.24, 0.78),
         (1024, 0.18, 0.74), (4096, 0.14, 0.70), (16384, 0.12, 0.66))
CHUNK_BYTES = 2048
CHUNK_LIMITS = (0.18, 0.70)
#: Share of chunks outside CHUNK_LIMITS above which a text is rejected.
MAX_BAD_CHUNKS = 0.25
LEVEL = 3
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, base_failed boolean, kept boolean, ratio double, "
            "n_chunks long, n_bad_chunks long")


def repeated_words(words: Sequence[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more in the text."""
    grams = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(grams)) == len(grams):
        return 0
    first: dict = {}
    again = set()
    for i, g in enumerate(grams):
        if first.setdefault(g, i) != i:
            again.add(g)
    covered, end = 0, 0
    for i, g in enumerate(grams):
        if g in again:
            covered += i + 5 - max(i, end)
            end = i + 5
    return covered


def measure(text: str | None, compressor, bands=BANDS, chunk_bytes: int = CHUNK_BYTES,
            chunk_limits=CHUNK_LIMITS, max_bad: float = MAX_BAD_CHUNKS) -> tuple:
    """The MEASURES of one whole text (null counts as empty)."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split cuts at exactly \x20 and \x09-\x0D
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    n_dup = len(lines) - len(set(lines))
    n_rep = repeated_words(words)
    failed = n_words < MIN_WORDS or 100 * n_rep > MAX_REPEAT_PERCENT * n_words
    size = len(raw)
    ratio, n_chunks, n_bad = None, 0, 0
    kept = not failed
    if size:
        ratio = len(compressor.compress(raw)) / size
        low, high = next((lo, hi) for at, lo, hi in reversed(bands) if size >= at)
        kept = kept and low <= ratio <= high
        starts = list(range(0, size - chunk_bytes + 1, chunk_bytes))
        if size > chunk_bytes and size % chunk_bytes:
            starts.append(size - chunk_bytes)  # the end, as a full chunk
        n_chunks = len(starts)
        for k in starts:
            r = len(compressor.compress(raw[k:k + chunk_bytes])) / chunk_bytes
            n_bad += not chunk_limits[0] <= r <= chunk_limits[1]
        kept = kept and n_bad <= max_bad * n_chunks
    return (n_words, word_chars, n_symbols, n_dup, n_rep, failed, kept, ratio, n_chunks, n_bad)


def measures_udf():
    names = [x.split()[0] for x in MEASURES.split(", ")]

    def run(texts: pd.Series) -> pd.DataFrame:
        import zstandard

        c = zstandard.ZstdCompressor(level=LEVEL)
        return pd.DataFrame([measure(t, c) for t in texts], columns=names)

    return F.pandas_udf(run, MEASURES)


def score(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the struct column of :data:`MEASURES` (named by the
    returned frame's last column).

    Null text counts as empty: no words, base rules fail, ``ratio`` null.
    Repeated rows are judged one by one; an empty table gives an empty one.
    """
    return docs.withColumn(fresh(docs, "quality"), measures_udf()(F.col(f"`{text_col}`").cast("string")))


def quality_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that pass the base rules and the compression bands,
    with unchanged columns."""
    scored = score(docs, text_col)
    q = scored.columns[-1]
    return scored.where(F.col(q)["kept"]).drop(q)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the base counts and the verdict."""
    scored = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return scored.select("doc_id", f"{scored.columns[-1]}.*")
