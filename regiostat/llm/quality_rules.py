"""Quality rules with compression bands.

Every whole text is compressed with zstandard, once as a whole and once in
fixed chunks.  ``ratio = bytes / compressed bytes``: repetitive text has a
high one, random or encoded text a low one.  What is normal depends on the
length (short texts carry the frame, long ones repeat their vocabulary), so
the limits are a band per length class.  A text is rejected when its own
ratio leaves the band of its length, or when more than ``max_bad_chunks`` of
its chunks leave the band of theirs.

Results: one row per input row.  A null or empty text has no words, all
counts 0, ratio null and fails the base rule.  Memory is bounded by a block
of rows or the longest text.  Repeated rows give repeated rows; other columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import batch, map_rows
from regiostat.llm.textvec import NOT_SPACE, Words, doc_windows, mix64, spans_hash, sums, text_blocks


@dataclass(frozen=True)
class Bands:
    """``limits``: (bytes below which the row holds, least ratio, greatest
    ratio), in order of length; the last one is open."""

    level: int = 3
    chunk: int = 4096
    max_bad_chunks: float = 0.5
    limits: tuple[tuple[float, float, float], ...] = (
        (128, 0.0, 3.0),
        (512, 0.95, 4.0),
        (2048, 1.15, 5.0),
        (8192, 1.30, 6.0),
        (65536, 1.35, 8.0),
        (float("inf"), 1.35, 12.0),
    )

    def inside(self, n_bytes: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        edge = np.array([x[0] for x in self.limits])
        at = np.searchsorted(edge, n_bytes, side="right").clip(max=len(edge) - 1)
        return (ratio >= np.array([x[1] for x in self.limits])[at]) & (ratio <= np.array([x[2] for x in self.limits])[at])


SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _structure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Word, symbol, line and repetition counts of each text of a block."""
    w = Words(data, offsets, NOT_SPACE, lower=False)
    chars = NOT_SPACE[data] & ((data & 0xC0) != 0x80)
    out = {"n_words": w.counts, "word_chars": sums(chars, offsets), "n_symbols": sums(SYMBOLS[data], offsets)}
    # words inside a three-word window that the text has at least twice
    h, at, doc = doc_windows(w, 3)
    _, which, times = np.unique(mix64(h + doc.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)), return_inverse=True, return_counts=True)
    twice = at[times[which] > 1] if len(h) else at
    marks = np.zeros(len(w.hashes) + 3, dtype=bool)
    for k in range(3):
        marks[twice + k] = True
    out["n_repeat_words"] = sums(marks[:len(w.hashes)], w.first)
    # lines: one more than there are line feeds, in each text
    feeds = np.flatnonzero(data == 10)
    starts, ends = np.sort(np.concatenate([offsets[:-1], feeds + 1])), np.sort(np.concatenate([feeds, offsets[1:]]))
    doc = np.repeat(np.arange(len(offsets) - 1), 1 + np.diff(np.searchsorted(feeds, offsets)))
    full = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    key = mix64(spans_hash(data, starts[full], ends[full]) + doc[full].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    _, firsts = np.unique(key, return_index=True)
    n = len(offsets) - 1
    out["n_dup_lines"] = np.bincount(doc[full], minlength=n) - np.bincount(doc[full][firsts], minlength=n)
    return out


def _ratios(data: np.ndarray, offsets: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Ratio of each whole text (nan if empty) and its share of bad chunks."""
    press, raw = zstandard.ZstdCompressor(level=bands.level), memoryview(np.ascontiguousarray(data))
    n = len(offsets) - 1
    ratio, bad = np.full(n, np.nan), np.zeros(n)
    for i in range(n):
        a, b = int(offsets[i]), int(offsets[i + 1])
        if a == b:
            continue
        ratio[i] = (b - a) / len(press.compress(raw[a:b]))
        if b - a > bands.chunk:
            cuts = list(range(a, b, bands.chunk))
            sizes = np.array([min(bands.chunk, b - c) for c in cuts])
            ratios = np.array([s / len(press.compress(raw[c:c + s])) for c, s in zip(cuts, sizes.tolist())])
            bad[i] = 1 - bands.inside(sizes, ratios).mean()
    return ratio, bad


def quality(docs: DataFrame, bands: Bands = Bands(), min_words: int = 50, max_repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, compression ratio and verdict of every text."""
    def measure(rows: pa.RecordBatch):
        for start, data, offsets in text_blocks(rows["t"]):
            s = _structure(data, offsets)
            ratio, bad = _ratios(data, offsets, bands)
            size = np.diff(offsets)
            failed = (s["n_words"] < min_words) | (100 * s["n_repeat_words"] > max_repeat_percent * s["n_words"])
            fits = bands.inside(size, np.nan_to_num(ratio)) & (bad <= bands.max_bad_chunks)
            yield batch(i=rows["i"].slice(start, len(size)), **{k: pa.array(v.astype(np.int64)) for k, v in s.items()},
                        ratio=pa.array(ratio, mask=np.isnan(ratio)), bad_chunks=bad, base_failed=failed, kept=~failed & fits)

    out = map_rows(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")), measure,
                   f"i {docs.schema[id_col].dataType.simpleString()}, n_words bigint, word_chars bigint, n_symbols bigint, n_repeat_words bigint, n_dup_lines bigint,"
                   " ratio double, bad_chunks double, base_failed boolean, kept boolean")
    return out.withColumnRenamed("i", id_col)
