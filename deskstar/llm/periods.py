"""Periodic runs in the words of a text, found by minimizers at several scales.

A run is a stretch of words with smallest period ``q`` that is at least ``max(6, 4 q)`` words long and that no neighbouring
word extends. Periods fall into scales, ``2**s <= q < 2**(s + 1)``:

* At scale ``s`` each position has the hash of the ``2**(s + 1)`` words from it on, and the least hash in each window of
  ``2**s`` positions is a minimizer. Inside a run the windows at ``i`` and ``i + q`` hold the same words, so their
  minimizers lie ``q`` apart; and as the hashed stretch is longer than the period, no position between them has that hash.
  So each run of the scale shows up as two following minimizers of equal hash, one period apart: a seed.
* Seeds are extended on the words themselves, so a chance collision of hashes adds nothing.
* Periods below ``SHORT`` are too short for windows; each is found by one scan that compares the words at that lag.

A stretch found at a multiple of its period is the same stretch as at the period itself, and the smaller period stays.

Texts of a batch are laid one after the other with unequal marks between, so array passes are long and no run crosses
texts. Memory grows with the longest text only: its words are numbers from the first pass on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar.llm.common import mix64, unused, words_pattern

LEAST, REPEATS = 6, 4
SHORT_BITS = 3
SHORT = 1 << SHORT_BITS
AT_ONCE = 1 << 16  # words in one array pass, or one text
PIECE = 1 << 20  # characters that become words at once
WORD = re.compile(words_pattern())
BLANK = re.compile(r"[\x20\x09-\x0D]")
RESULT = ("struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, "
          "n_dropped: bigint, text: string>")


def pieces(text: str) -> Iterator[str]:
    """The text in parts that end between words."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            found = BLANK.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def words_of(text: str) -> Iterator[list[str]]:
    return (WORD.findall(part) for part in pieces(text))


class Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: str) -> int:
        self[word] = value = len(self)
        return value


def numbered(text: str, numbers: Numbers) -> np.ndarray:
    parts = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in words_of(text)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def equal_stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of ``same`` with at least ``least`` true values."""
    walls = np.concatenate([[-1], np.flatnonzero(~same), [len(same)]])
    length = np.diff(walls) - 1
    long = length >= least
    return walls[:-1][long] + 1, length[long]


def sliding(values: np.ndarray, scale: int, fold: np.ufunc) -> np.ndarray:
    """``fold`` over each window of ``2**scale`` values."""
    for step in range(scale):
        values = fold(values[:-(1 << step)], values[1 << step:])
    return values


def minimizers(hashes: np.ndarray, scale: int) -> np.ndarray:
    """Positions whose hash is the least of some window of ``2**scale`` positions."""
    width = 1 << scale
    least = sliding(hashes, scale, np.minimum)
    edge = np.zeros(width - 1, np.uint64)  # no window there; a hash of 0 only adds seeds
    greatest = sliding(np.concatenate([edge, least, edge]), scale, np.maximum)
    return np.flatnonzero(greatest == hashes)


def matching(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading values are equal, looked up in growing steps."""
    at, step, end = 0, 64, min(len(x), len(y))
    while at < end:
        differ = x[at:min(at + step, end)] != y[at:min(at + step, end)]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, step = at + len(differ), step * 2
    return end


def seeds(hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of following minimizers with equal hash, as far apart as the scale's periods."""
    at = minimizers(hashes, scale)
    at = at[np.argsort(hashes[at], kind="stable")]
    apart = np.diff(at)
    usable = (hashes[at[1:]] == hashes[at[:-1]]) & (apart >= 1 << scale) & (apart < 2 << scale)
    found, apart = at[:-1][usable], apart[usable]
    order = np.lexsort((found, apart))
    return found[order], apart[order]


def runs(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows start, length, period of all runs, by start and period; no text in ``words`` is longer than ``longest``."""
    found: list[np.ndarray] = []
    for period in range(1, min(SHORT - 1, longest // REPEATS) + 1):
        start, length = equal_stretches(words[period:] == words[:-period], max(LEAST, REPEATS * period) - period)
        found.append(np.stack([start, length + period, np.full(len(start), period)], axis=1))
    hashes = mix64(words.astype(np.uint64) + np.uint64(1))
    rows: list[tuple[int, int, int]] = []
    scale, size = 0, 1
    while REPEATS << scale <= longest:
        while size < 2 << scale:
            # The hash of twice as many words, from the hashes of both halves.
            hashes = mix64(hashes[:-size] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[size:] + np.uint64(scale))
            size *= 2
        if scale >= SHORT_BITS:
            last = (0, 0, 0)
            for at, period in zip(*(x.tolist() for x in seeds(hashes, scale)), strict=True):
                if period == last[2] and at + period < last[0] + last[1]:
                    continue
                right = matching(words[at:], words[at + period:])
                left = matching(words[:at][::-1], words[:at + period][::-1])
                last = at - left, left + right + period, period
                if last[1] >= REPEATS * period:
                    rows.append(last)
        scale += 1
    found.append(np.array(rows, dtype=np.int64).reshape(-1, 3))
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    same = np.zeros(len(every), dtype=bool)
    same[1:] = (every[1:, :2] == every[:-1, :2]).all(axis=1)  # a stretch at a multiple of its period
    every = every[~same]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def repeated(found: np.ndarray, n: int) -> np.ndarray:
    """Whether each of ``n`` words comes after the first period of some run that holds it."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def kept_text(text: str, gone: np.ndarray) -> str:
    """The words that are not gone, joined by one blank."""
    parts, at = [], 0
    for words in words_of(text):
        lost = gone[at:at + len(words)]
        at += len(words)
        if lost.all():
            continue
        parts.append(" ".join(w for w, out in zip(words, lost.tolist(), strict=True) if not out) if lost.any()
                     else " ".join(words))
    return " ".join(parts)


def examined(texts: list[str | None]) -> tuple[list[int], list[np.ndarray], list[int], list[str]]:
    """Number of words, runs, number of dropped words and kept text of each text."""
    size, found, dropped, kept = [], [], [], []

    def settle(group: list[np.ndarray]) -> None:
        """Runs of consecutive texts in one pass, with a mark after each that equals nothing else."""
        ends = np.cumsum([len(g) + 1 for g in group])
        laid = np.concatenate([part for k, g in enumerate(group) for part in (g, [-1 - k])]).astype(np.int64)
        every = runs(laid, max(map(len, group)))
        owner = np.searchsorted(ends, every[:, 0], side="right")
        for k, g in enumerate(group):
            mine = every[owner == k] - np.array([ends[k] - len(g) - 1, 0, 0])
            text = texts[len(size)] or ""
            gone = repeated(mine, len(g))
            size.append(len(g))
            found.append(mine)
            dropped.append(int(gone.sum()))
            kept.append(kept_text(text, gone))

    numbers, waiting, held = Numbers(), [], 0
    for text in texts:
        words = numbered(text or "", numbers)
        if waiting and held + len(words) > AT_ONCE:
            settle(waiting)
            waiting, held = [], 0
        waiting.append(words)
        held += len(words)
    if waiting:
        settle(waiting)
    return size, found, dropped, kept


def periodic_runs(docs: DataFrame, text: str = "text", into: str = "periodic") -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, runs (start, length, period), n_dropped and the collapsed text.

    Words are runs of anything but the six ASCII blanks, numbered from 0 over the whole text, however long. The collapsed
    text joins the words that stay by one blank: a word goes if it comes after the first period of any run that holds it.
    A null, empty or blank text has no words, no runs and an empty collapsed text. Every row is a text of its own,
    repeated rows and rows without an id too. Other columns pass through; one named like ``into`` (case aside) is
    replaced. An empty table gives an empty table.
    """
    def find(texts: pa.Array) -> pa.Array:
        size, found, dropped, kept = examined(texts.to_pylist())
        every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        each = pa.StructArray.from_arrays([pa.array(c) for c in every.T.copy()], names=["start", "length", "period"])
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), each), pa.array(dropped, pa.int64()),
             pa.array(kept, pa.string())], names=["n_words", "runs", "n_dropped", "text"])

    # Arrow functions are told apart by type hints, which must be classes here.
    find.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    name = unused(docs, "found_runs")
    return docs.withColumn(name, F.arrow_udf(find, RESULT)(F.col(text))).drop(into).withColumnRenamed(name, into)


def looped(text: Column, doc_id: Column) -> Column:
    """The text of a document whose tail repeats, for those whose id has a checksum divisible by 10; others unchanged.

    With checksum h, g = floor(h / 10) and n words, the words from a = g % n on become those of the first
    p = 1 + floor((n - a) / (3 + g % 8)) of them, over and over. Null ids and texts without words stay as they are.
    """
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(words_pattern()), F.lit(0))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words).cast("long")
    a = F.when(n > 0, g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    cycle = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    tail = F.slice(F.flatten(cycle), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)
