"""Language identification by rank-order profiles.

A language's profile is its most frequent character n-grams, in order, over labelled documents. A text's own most
frequent n-grams are compared to each profile: an n-gram adds the difference of its two ranks, or the profile's length if
the profile lacks it. The language with the least sum (out-of-place distance) wins; ties go to the smaller name.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskstar.llm.common import mapped, staged

UNKNOWN = "und"
RESULT = "struct<lang: string, score: double>"
BLANK = 32
BITS = 21  # of a code point; a gram of up to three is one 63-bit number, ordered as the gram is by code point
PIECE = 1 << 22
BROADCAST_NAMES = 10_000


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams (n = 1 to 3) in the words of the whole text, lower-cased, in order, and how often each occurs.

    A word is a run of letters between two blanks; a blank is in an n-gram only at its ends, and never alone.
    """
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(letters()[codes], codes, BLANK).astype(np.int64)
    blank = codes == BLANK
    codes = codes[~(blank & np.concatenate([[False], blank[:-1]]))]
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start in range(0, len(codes), PIECE):
        part = codes[start:start + PIECE + 2]
        own = min(PIECE, len(codes) - start)
        one = part[:own] << (2 * BITS)
        two = one[:len(part) - 1] | part[1:own + 1] << BITS
        three = two[:len(part) - 2] | part[2:own + 2]
        three = three[part[1:len(three) + 1] != BLANK]
        found, n = np.unique(np.concatenate([one[part[:own] != BLANK], two, three]), return_counts=True)
        keys, counts = (found, n) if not start else summed(np.concatenate([keys, found]), np.concatenate([counts, n]))
    return keys, counts


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, weights=counts, minlength=len(found)).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` most frequent n-grams, ties by code point."""
    if len(keys) > length:
        often = counts >= np.partition(counts, -length)[-length]
        keys, counts = keys[often], counts[often]
    return keys[np.argsort(-counts, kind="stable")[:length]]


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          docs_per_language: int = 4000, length: int = 400) -> dict[str, list[int]]:
    """Profiles of the non-null ``lang`` values.

    Fitted on a bounded sample: about ``docs_per_language`` documents of each language, drawn by a hash of the id.
    Held-out documents, null ids, null texts and texts without a letter teach nothing. The profiles hold ``length``
    n-grams for each language, and only they reach the driver.
    """
    usable = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    usable = usable.where(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
                          & ~held_out(F.col("id")))
    share = usable.groupBy("lang").agg((F.lit(float(docs_per_language)) / F.count("*")).alias("share"))
    share = staged(share, "shares")
    # One row a language; where they are few, the draw filters before any text moves.
    if share.count() <= BROADCAST_NAMES:
        share = F.broadcast(share)
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(11), "id"), 11) / F.lit(float(1 << 53))
    sample = usable.join(share, "lang").where(draw < F.col("share")).select("lang", "text")

    def count(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        found: dict[str, list] = {}
        for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            found.setdefault(name, []).append(gram_counts(value.as_py()))
        for name, parts in found.items():
            keys, n = summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            yield pa.record_batch([pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(n)],
                                  ["lang", "gram", "n"])

    totals = mapped(sample, count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = totals.withColumn("place", place).where(F.col("place") <= length)
    profiles: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "place").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Profiles:
    """Ranks of the profiles' n-grams: one row per n-gram, one column per language, -1 where it is missing."""

    def __init__(self, profiles: dict[str, list[int]], length: int):
        self.names, self.length = sorted(profiles), length
        self.keys = np.unique(np.array([g for grams in profiles.values() for g in grams], dtype=np.int64))
        self.places = np.full((len(self.keys), len(self.names)), -1)
        for k, name in enumerate(self.names):
            self.places[np.searchsorted(self.keys, profiles[name]), k] = np.arange(len(profiles[name]))

    def classify(self, text: str | None) -> tuple[str, float]:
        """The nearest language and 1 minus its share of the greatest distance; no letter: unknown and 0."""
        top = ranked(*gram_counts(text), self.length) if text else ()
        if not len(top) or not len(self.keys):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.keys, top), len(self.keys) - 1)
        place = np.where((self.keys[at] == top)[:, None], self.places[at], -1)
        mine = np.arange(len(top))[:, None]
        distance = np.where(place < 0, self.length, np.abs(place - mine)).sum(axis=0)
        best = int(distance.argmin())
        return self.names[best], 1.0 - float(distance[best]) / (self.length * len(top))


def predicted(text: Column, profiles: dict[str, list[int]], length: int = 400) -> Column:
    """Struct ``lang, score`` of each whole text.

    ``und`` with score 0 where the text is null or has no letter, or where no language was learned. The score is 1 for a
    text that ranks its n-grams as the profile does and 0 if it shares none.
    """
    model = Profiles(profiles, length)

    def predict(texts: pa.Array) -> pa.Array:
        found = [model.classify(value.as_py()) for value in texts]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=["lang", "score"])

    predict.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(predict, RESULT)(text)
