"""Suffix-array dedup: remove every byte covered by a string of ``length`` bytes that a document with a smaller id holds too.

Only equality up to ``length`` bytes matters, so suffixes are ordered by a radix sort that stops there and drops whatever
stands alone after each digit, the most significant first:

1. The first digit of a suffix is its anchor: the gram of ``GRAM`` bytes with the least hash among those in its first
   ``length`` bytes. Neighbouring suffixes with one anchor form a run, and equal suffixes have equal anchors, so runs stand
   for their suffixes (about 15 each). Runs are dealt to buckets by this digit and sorted there.
2. The second digit is the whole run. A run that a smaller document holds as a whole is removed as a whole. Runs whose
   anchor no smaller document has are left alone. Both need no further digit.
3. What is left is the ends of repeats: their suffixes are sorted one by one by all ``length`` bytes, in buckets again.

In every pass a task first sorts what it has read itself, and only the smallest document of each group goes on, so a
passage that a third of all documents share sends one row per task. Digits travel as hashes, packed by bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskstar.llm.common import mix64, staged, unused

GRAM = 20
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
CHUNK_BYTES = 24 << 20
PLANES = (4, 4, 2, 4, 6)  # bytes of document step, position step, width and the two digits
BUCKET_BYTES = 8 << 20
PACKED = "bucket int, part binary"
FOUND = "id bigint, mark bigint, first int, last int, open boolean"
RESULT = "struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept: binary>"


def window_hashes(data: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Hash of every window of each size, put together from windows of powers of two."""
    powers = {1: data.astype(np.uint64) + np.uint64(1)}
    k = 1
    while 2 * k <= max(sizes):
        h = powers[k]
        powers[2 * k] = h[:len(h) - k] * np.uint64(pow(BASE, k, 1 << 64)) + h[k:]
        k *= 2
    out = []
    for size in sizes:
        n, at, h = len(data) - size + 1, 0, None
        for k in sorted(powers, reverse=True):
            if size - at >= k:
                part = powers[k][at:at + n]
                h = part if h is None else h * np.uint64(pow(BASE, k, 1 << 64)) + part
                at += k
        out.append(mix64(h))
    return out


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` values in a row is; the first of equals."""
    least, at, k = values, np.arange(len(values)), 1
    while k < width:
        step = min(k, width - k)
        n = len(least) - step
        later = least[step:] < least[:n]
        at = np.where(later, at[step:], at[:n])
        least = np.where(later, least[step:], least[:n])
        k += step
    return at


def runs(text: bytes, length: int) -> tuple[np.ndarray, ...]:
    """First and last suffix of each run, its anchor's hash and the hash of the whole run."""
    gram, whole = window_hashes(np.frombuffer(text, dtype=np.uint8), (GRAM, length))
    anchor = leftmost_least(gram, length - GRAM + 1)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [len(anchor)]]) - 1
    # The first and last suffix overlap or meet, so they make up the run.
    return first, last, gram[anchor[first]], mix64(whole[first] * np.uint64(3) + mix64(whole[last]) + np.uint64(1))


class Packer:
    """Entries of one chunk: document number, first and last suffix, and two digits."""

    def __init__(self, buckets: int):
        self.buckets, self.turn = buckets, 0
        self.clear()

    def clear(self) -> None:
        self.ids, self.marks, self.parts, self.bytes = [], [], [], 0

    def add(self, doc_id: int, mark: int, size: int, first, last, digit, whole) -> None:
        number = np.full(len(first), len(self.ids), dtype=np.uint32)
        self.ids.append(doc_id)
        self.marks.append(mark)
        self.parts.append((number, first.astype(np.uint32), last.astype(np.uint32), digit, whole))
        self.bytes += size

    def flush(self) -> Iterator[pa.RecordBatch]:
        """One row per bucket; what a smaller document of the chunk holds is settled at once and passes through."""
        if not self.parts:
            return
        number, first, last, digit, whole = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        ids, marks = np.array(self.ids, dtype=np.int64), np.array(self.marks, dtype=np.int64)
        settled = smallest(ids[number], digit, whole) < ids[number]
        bucket = ((digit >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)
        bucket[settled] = self.buckets + self.turn % self.buckets
        self.turn += 1
        order = np.argsort(bucket, kind="stable")
        ends = np.flatnonzero(np.diff(bucket[order])) + 1
        rows = [(int(bucket[part[0]]), pack(ids, marks, *(x[part] for x in (number, first, last, digit, whole))))
                for part in np.split(order, ends)]
        self.clear()
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                              ["bucket", "part"])


def pack(ids, marks, number, first, last, digit, whole) -> bytes:
    """Bytes of a bucket's share: only the documents it names, positions as differences, digits cut to 32 and 48 bits.

    Numbers are laid out by significance of their bytes, so that the many zero bytes compress.
    """
    used, number = np.unique(number, return_inverse=True)
    columns = (np.diff(number, prepend=0), first - np.where(np.diff(number, prepend=-1) == 0, np.roll(first, 1), 0),
               last - first, digit, whole)
    planes = [x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T.tobytes()
              for x, n in zip(columns, PLANES, strict=True)]
    return b"".join([np.array([len(used), len(number)], dtype=np.int64).tobytes(), ids[used].tobytes(),
                     marks[used].tobytes(), *planes])


def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    docs, n = (int(x) for x in np.frombuffer(blob, np.int64, 2))
    ids, marks = np.frombuffer(blob, np.int64, docs, 16), np.frombuffer(blob, np.int64, docs, 16 + 8 * docs)
    at, columns = 16 + 16 * docs, []
    for size in PLANES:
        full = np.zeros((n, 8), dtype=np.uint8)
        full[:, :size] = np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n).T
        columns.append(full.view("<u8").ravel())
        at += n * size
    step, ahead, wide, digit, whole = columns
    number, ahead = np.cumsum(step.astype(np.int64)), ahead.astype(np.int64)
    # Positions are differences within a document.
    total = np.cumsum(ahead)
    begins = np.flatnonzero(np.diff(number, prepend=-1))
    first = total - np.repeat((total - ahead)[begins], np.diff(np.append(begins, n)))
    return ids[number], marks[number], first, first + wide.astype(np.int64), digit, whole


def smallest(ids: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """The smallest id among the entries that share all keys."""
    order = np.lexsort((ids, *reversed(keys)))
    new = np.zeros(len(ids), dtype=bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    least = ids[order][np.flatnonzero(new)]
    out = np.empty(len(ids), dtype=np.int64)
    out[order] = least[np.cumsum(new) - 1]
    return out


def found_rows(ids, marks, first, last, kind) -> pa.Table:
    return pa.table([pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(first, pa.int32()),
                     pa.array(last, pa.int32()), pa.array(kind, pa.bool_())],
                    names=["id", "mark", "first", "last", "open"])


def joined_parts(table: pa.Table) -> tuple[np.ndarray, ...]:
    parts = [unpack(value.as_py()) for value in table.column("part")]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def repeated_spans(docs: DataFrame, id_: str, mark: str, text: str, length: int) -> DataFrame:
    """Rows id, mark, first, last: suffixes ``first`` to ``last`` of the document begin with a repeat from a smaller one."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("long")).first()[0]
    buckets = max(16, -(-size // BUCKET_BYTES))
    usable = docs.where(F.col(id_).isNotNull() & (F.octet_length(text) >= length)).select(
        F.col(id_).alias("id"), F.col(mark).alias("mark"), F.col(text).cast("binary").alias("text"))

    def by_anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets)
        for batch in batches:
            for i, m, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = value.as_py()
                packer.add(i, m, len(data), *runs(data, length))
                if packer.bytes >= CHUNK_BYTES:
                    yield from packer.flush()
        yield from packer.flush()

    def settle_runs(table: pa.Table) -> pa.Table:
        ids, marks, first, last, anchor, whole = joined_parts(table)
        if table.column("bucket")[0].as_py() >= buckets:
            return found_rows(ids, marks, first, last, np.zeros(len(ids), dtype=bool))
        same, alike = smallest(ids, anchor, whole), smallest(ids, anchor)
        held = same < ids
        unsure = ~held & (alike < ids)
        # An anchor with an unsure run opens the smallest holder of each of its runs.
        opened = ~held & np.isin(anchor, np.unique(anchor[unsure]))
        keep = held | opened
        return found_rows(ids[keep], marks[keep], first[keep], last[keep], opened[keep])

    packed = usable.mapInArrow(by_anchor, PACKED)
    coarse = staged(packed.groupBy("bucket").applyInArrow(settle_runs, FOUND), "runs")
    span = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("last").cast("long"))
    asked = coarse.where("open").groupBy("id", "mark").agg(F.collect_list(span).alias("spans"))

    def by_suffix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets)
        for batch in batches:
            for i, m, value, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                                          batch.column(3), strict=True):
                packed_spans = np.sort(spans.values.to_numpy())
                first, last = packed_spans >> 32, packed_spans & 0xFFFFFFFF
                at = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
                whole = window_hashes(np.frombuffer(value.as_py(), dtype=np.uint8), (length,))[0][at]
                packer.add(i, m, 8 * len(at), at, at, whole, mix64(whole + np.uint64(7)))
                if packer.bytes >= CHUNK_BYTES:
                    yield from packer.flush()
        yield from packer.flush()

    def settle_suffixes(table: pa.Table) -> pa.Table:
        ids, marks, first, last, one, two = joined_parts(table)
        if table.column("bucket")[0].as_py() >= buckets:
            held = np.ones(len(ids), dtype=bool)
        else:
            held = smallest(ids, one, two) < ids
        return found_rows(ids[held], marks[held], first[held], last[held], np.zeros(int(held.sum()), dtype=bool))

    fine = usable.join(asked, ["id", "mark"]).select("id", "mark", "text", "spans").mapInArrow(by_suffix, PACKED)
    fine = staged(fine.groupBy("bucket").applyInArrow(settle_suffixes, FOUND), "suffixes")
    return coarse.where("not open").union(fine).select("id", "mark", span.alias("span"))


def cut_out(text: Column, spans: Column, length: int) -> Column:
    """Struct of sizes and kept bytes of a text without the bytes that its spans of suffixes cover."""
    def cut(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = [[], [], [], []]
        for value, found in zip(texts, lists, strict=True):
            data = value.as_py() or b""
            edge = np.zeros(len(data) + 1, dtype=np.int32)
            if found.is_valid:
                packed = found.values.to_numpy()
                np.add.at(edge, packed >> 32, 1)
                np.add.at(edge, (packed & 0xFFFFFFFF) + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            starts = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
            kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes() if starts else data
            for column, x in zip(out, (len(data), int(gone.sum()), starts, kept), strict=True):
                column.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                          names=["n_bytes", "n_removed", "n_spans", "kept"])

    cut.__annotations__ = {"texts": pa.Array, "lists": pa.Array, "return": pa.Array}
    return F.arrow_udf(cut, RESULT)(text.cast("binary"), spans)


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "cut",
                 length: int = 50) -> DataFrame:
    """``docs`` with a struct column ``into``: n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes.

    A null text is empty. A document without an id is not smaller than any and loses nothing. Documents with one id do not
    count against each other. Repeats inside a document, matches across documents' ends and strings shorter than
    ``length`` do not count. Kept bytes need not be valid text, as a cut may fall inside a character. Other columns pass
    through; one named like ``into`` (case aside) is replaced. An empty table gives an empty table.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    base = docs.drop(into)
    number, mark, spans = unused(base, "number"), unused(base, "mark"), unused(base, "spans")
    keyed = base.withColumn(number, F.col(doc_id).cast("long")).withColumn(mark, F.xxhash64(text))
    found = repeated_spans(keyed, number, mark, text, length).groupBy("id", "mark").agg(
        F.collect_list("span").alias(spans)).toDF(number, mark, spans)
    joined = keyed.join(found, [number, mark], "left")
    return joined.withColumn(into, cut_out(F.col(text), F.col(spans), length)).drop(number, mark, spans)
