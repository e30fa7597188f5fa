"""Line dedup: drop the lines that many documents share, found by a sharded minimal perfect hash.

1. Every document sends the 128-bit hash of each of its distinct line keys once; Spark counts documents per hash.
2. Hashes that reach ``min_docs`` are dealt over shards by their leading bits. Each shard becomes a minimal perfect
   hash (levels of bit vectors with ranks) that numbers its hashes without gaps, plus a fingerprint and a count array
   in that numbering. Hashes below the bar need no entry: a probe for one meets another's fingerprint and reads 0.
3. Documents probe the arrays. No line is ever joined or shuffled, and texts never leave their task.

The shards of one pass are broadcast, so a pass takes at most ``index_bytes`` of them; more shards mean more passes over
the documents. Lines fall by their key alone, so passes can follow each other.
"""

from __future__ import annotations

import io
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar.llm.common import mapped, mix64, staged, unused

BYTES_PER_KEY = 13  # 8 fingerprint, 4 count, and under 8 bits of perfect hash
RESULT = "struct<n_lines: bigint, n_dropped: bigint, text: string>"


def line_keys(text: bytes | None) -> tuple[list[bytes], list[bytes]]:
    """Lines and their keys: ASCII blanks stripped at both ends, A-Z lower-cased."""
    lines = (text or b"").split(b"\n")
    return lines, [line.strip(b" \t\n\v\f\r").lower() for line in lines]


def hashed(keys: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit halves of each key's hash."""
    raw = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=">u8").astype(np.uint64)
    return raw[0::2], raw[1::2]


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit keys, with a fingerprint and a count per key.

    Each level is a bit vector over positions that exactly one remaining key takes; the number of a key is the count of
    bits before its own. Keys whose 64 bits collide in full never settle and are kept aside in a plain list.
    """

    LEVELS = 48
    LOAD = 1.7

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays

    @classmethod
    def build(cls, keys: np.ndarray, marks: np.ndarray, counts: np.ndarray) -> PerfectHash:
        fingerprint = np.zeros(len(keys), dtype=np.uint64)
        count = np.zeros(len(keys), dtype=np.int64)
        words, sizes, left, settled = [], [], np.arange(len(keys)), 0
        for level in range(cls.LEVELS):
            if not len(left):
                break
            size = -(-int(len(left) * cls.LOAD + 64) // 64) * 64
            at = cls._place(keys[left], level, size)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.cumsum(alone) - 1
            done = alone[at]
            fingerprint[settled + rank[at[done]]] = marks[left[done]]
            count[settled + rank[at[done]]] = counts[left[done]]
            settled += int(done.sum())
            left = left[~done]
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
        bits = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])[:-1]
        return cls({"bits": bits, "before": before, "sizes": np.array(sizes, dtype=np.int64),
                    "fingerprint": fingerprint[:settled], "count": count[:settled], "aside": keys[left],
                    "aside_mark": marks[left], "aside_count": counts[left]})

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + np.uint64(level * 0x9E3779B9 + 1)) % np.uint64(size)).astype(np.int64)

    def probe(self, keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The count of each key, 0 for keys that are not in the index."""
        a, out = self.arrays, np.zeros(len(keys), dtype=np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(a["sizes"]):
            at = self._place(keys[left], level, int(size))
            word, bit = start + (at >> 6), (at & 63).astype(np.uint64)
            bits = a["bits"][word]
            hit = (bits >> bit) & np.uint64(1) == 1
            below = bits[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            number = a["before"][word[hit]] + np.bitwise_count(below)
            same = a["fingerprint"][number] == marks[left[hit]]
            out[left[hit]] = np.where(same, a["count"][number], 0)
            left, start = left[~hit], start + int(size) // 64
        for key, mark, count in zip(a["aside"], a["aside_mark"], a["aside_count"], strict=True):
            out[(keys == key) & (marks == mark)] = count
        return out

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.arrays)
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> PerfectHash:
        with np.load(io.BytesIO(blob)) as stored:
            return cls({name: stored[name] for name in stored.files})


def shared_lines(docs: DataFrame, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """Hash halves and document counts of the line keys in at least ``min_docs`` documents."""
    def distinct(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        found: list[bytes] = []
        for value in batch.column(0).to_pylist():
            found.extend({k for k in line_keys(value)[1] if len(k) >= min_chars and long_enough(k, min_chars)})
        if found:
            first, second = hashed(found)
            yield pa.record_batch([pa.array(first.view(np.int64)), pa.array(second.view(np.int64))], ["h1", "h2"])

    rows = mapped(docs.select(F.col(text).cast("binary").alias("text")), distinct, "h1 bigint, h2 bigint")
    return rows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)


def long_enough(key: bytes, min_chars: int) -> bool:
    return min_chars <= 1 or len(key.decode()) >= min_chars


def build_index(shared: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its number and its packed perfect hash with arrays."""
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        made = PerfectHash.build(rows["h1"].to_numpy().view(np.uint64), rows["h2"].to_numpy().view(np.uint64),
                                 rows["n"].to_numpy())
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "index": [made.dump()]})

    shard = F.pmod(F.shiftrightunsigned("h1", 32), F.lit(shards)).alias("shard")
    return shared.select(shard, "h1", "h2", "n").groupBy("shard").applyInPandas(pack, "shard bigint, index binary")


def probing(text: Column, index: dict[int, bytes], shards: int, spark) -> Column:
    """Kept text and line counts of each text, by the shards in ``index``."""
    held = spark.sparkContext.broadcast(index)
    opened: dict[int, PerfectHash] = {}

    def drop(texts: pa.Array) -> pa.Array:
        for number, blob in held.value.items():
            if number not in opened:
                opened[number] = PerfectHash.load(blob)
        split = [line_keys(value) for value in texts.to_pylist()]
        h1, h2 = hashed(key for _, keys in split for key in keys)
        shard = ((h1 >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
        gone = np.zeros(len(h1), dtype=bool)
        for number, part in opened.items():
            mine = np.flatnonzero(shard == number) if shards > 1 else np.arange(len(h1))
            gone[mine] = part.probe(h1[mine], h2[mine]) > 0
        kept, n_lines, n_dropped, at = [], [], [], 0
        for lines, _ in split:
            lost = gone[at:at + len(lines)]
            at += len(lines)
            kept.append(b"\n".join(line for line, out in zip(lines, lost, strict=True) if not out).decode())
            n_lines.append(len(lines))
            n_dropped.append(int(lost.sum()))
        return pa.StructArray.from_arrays(
            [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
            names=["n_lines", "n_dropped", "text"])

    # Arrow functions are told apart by type hints, which must be classes here.
    drop.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(drop, RESULT)(text.cast("binary"))


def drop_shared_lines(docs: DataFrame, text: str = "text", into: str = "lines", min_docs: int = 10,
                      min_chars: int = 1, keys_per_shard: int = 65_536,
                      index_bytes: int = 128 << 20) -> DataFrame:
    """``docs`` with a struct column ``into``: n_lines, n_dropped and the text without its shared lines.

    A null text is one empty line, as is an empty one; its kept text is empty. Empty keys are never dropped. Every row
    is a document of its own, repeated rows and rows without an id too. Other columns pass through untouched; if one is
    named like ``into`` (case aside), it is replaced. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    shared = staged(shared_lines(docs, text, min_docs, min_chars), "lines")
    n = shared.count()
    shards = max(1, -(-n // keys_per_shard))
    index = staged(build_index(shared, shards), "index") if n else None
    per_pass = max(1, index_bytes // (BYTES_PER_KEY * keys_per_shard))
    name = unused(docs, "kept_lines")
    done = docs.withColumn(name, F.lit(None).cast(RESULT))
    for start in range(0, shards, per_pass):
        rows = index.where(F.col("shard").between(start, start + per_pass - 1)).collect() if n else []
        before = F.col(text) if not start else F.col(name)["text"]
        found = probing(before, {r["shard"]: bytes(r["index"]) for r in rows}, shards, spark)
        now = unused(done, "found_lines")
        done = done.withColumn(now, found)
        if start:
            total = F.struct(F.col(name)["n_lines"].alias("n_lines"),
                             (F.col(name)["n_dropped"] + F.col(now)["n_dropped"]).alias("n_dropped"),
                             F.col(now)["text"].alias("text"))
            done = staged(done.withColumn(name, total).drop(now), "lines")
        else:
            done = done.withColumn(name, F.col(now)).drop(now)
            if shards > per_pass:
                done = staged(done, "lines")
    return done.drop(into).withColumnRenamed(name, into)
