"""Removal of long repeated byte strings by refining buckets of positions.

A position belongs to a string of ``length`` bytes only through the string's pointer: the position of the least hash
among the string's q-grams (the leftmost, on ties). Equal strings have equal pointers, so it is enough to bucket the
pointers, about one position in eighty, rather than every suffix:

1. Pointers are put in buckets by their q-gram. Buckets of one position are settled: no string through it repeats.
2. Buckets are refined by all that the strings through a pointer reach, from the start of the first to the end of the
   last, that is by what stands at the earlier and later offsets. Where two positions stay in one bucket, every string
   through them repeats, and their bytes are covered without looking further.
3. What remains are borders, where a repeated passage begins or ends. Their reach is fetched, and the buckets are
   refined for each string start by itself: identifiers of short blocks are sorted in pairs, block and the block that
   follows it, and the pairs' ranks are the identifiers of blocks twice as long, used again until the length is
   reached. A start whose bucket still holds another position is covered.

   A bucket with more than ``HOT`` borders and a two-thousandth of them all (a short line that many documents hold) is
   not brought together: its starts are dealt out by the hash of their string, each batch settling what it can first.

A bucket is never expanded into pairs, copies of a whole document are settled in step 2 by their hashes alone, and a
border is at most 2 * ``length`` bytes whatever the documents' sizes.

Null text counts as empty; texts shorter than ``length`` bytes lose nothing. An id stands for one document: repeated
rows count as one and are reported each; rows with a null id are neither searched nor returned. An empty table gives
an empty result; extra columns are ignored. Step 2 takes strings for equal when two 64-bit hashes agree, whose bases
are drawn anew in each call, so that no text can be made to collide; where only the first agrees, step 3 decides. Step 3
compares the bytes, or for buckets beyond ``HOT`` both hashes. A q-gram that many documents hold (``MANY`` pointers in
one batch) leaves a few pointers in its bucket; the others are refined in buckets chosen by their reach, as borders at
least.
"""

from __future__ import annotations

import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import mixed, partitions, prefix_hashes, slices, span_hash, stored, text_buffers

CHUNK = 1 << 17  # bytes of text hashed at a time, at some 150 bytes of arrays each
GRAM = 32
HOT = 2000  # borders
MANY = 64  # pointers of one gram and batch
PLACE_BITS = 26  # positions are told apart within 64 MB, far beyond the strings' length


def pointers(data: np.ndarray, offsets: np.ndarray, length: int, bases: tuple[int, int]):
    """(row, first start, last start, pointer, gram hash, two reach hashes): runs of string starts with one pointer.

    Starts and pointers are offsets within their row's text.
    """
    none = np.zeros(0, np.int64)
    n = len(data)
    nothing = (none,) * 4 + (none.astype(np.uint64),) * 3
    if n < length:
        return nothing
    prefix, second = (prefix_hashes(data, base) for base in bases)
    at = np.arange(n - GRAM + 1)
    gram = span_hash(prefix, at, at + GRAM, bases[0])
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = (gram & ~mask) | (at.astype(np.uint64) & mask)
    window, size = length - GRAM + 1, 1
    while size * 2 <= window:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if size < window:
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    start = np.arange(len(least))
    row = np.searchsorted(offsets, start, side="right") - 1
    inside = start + length <= offsets[row + 1]
    start, row = start[inside], row[inside]
    if not len(start):
        return nothing
    pointer = start + (((least[inside] & mask).astype(np.int64) - start) & int(mask))
    new = np.ones(len(start), bool)
    new[1:] = (pointer[1:] != pointer[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    a, b, p, r = start[first], start[last], pointer[first], row[first]
    place = mixed((p - a).astype(np.uint64))
    reach, check = (mixed(span_hash(x, a, b + length, base) ^ place) for x, base in zip((prefix, second), bases, strict=True))
    begin = offsets[r]
    return r, a - begin, b - begin, p - begin, gram[p], reach, check


def new_bases() -> tuple[int, int]:
    """Two odd numbers whose powers modulo 2 ** 64 repeat late."""
    return secrets.randbits(61) * 8 + 3, secrets.randbits(61) * 8 + 3


def _pointer_blocks(docs: DataFrame, length: int, buckets: int, bases: tuple[int, int]) -> DataFrame:
    """Pointers packed as one block for each batch and range of gram hashes; ``sure`` ones by their reach instead."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = text_buffers(batch.column(1))
            found = []
            for a, b in slices(offsets, CHUNK):
                r, s, e, p, gram, reach, check = pointers(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length, bases)
                found.append((gram, reach, check, ids[a + r], s.astype(np.int32), (p - s).astype(np.int16), (e - s).astype(np.int16)))
            if not found:
                continue
            columns = [np.concatenate(x) for x in zip(*found, strict=True)]
            order = np.argsort(columns[0])
            columns = [x[order] for x in columns]
            gram, reach = columns[:2]
            sure = np.arange(len(gram)) - np.searchsorted(gram, gram) >= MANY
            bucket = ((np.where(sure, reach, gram) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64) * 2 + sure
            order = np.argsort(bucket, kind="stable")
            columns, bucket = [x[order] for x in columns], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(2 * buckets + 1))
            own = np.flatnonzero(np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [pa.array((own // 2).astype(np.int32)), pa.array(own % 2 == 1)] + [pa.array([x[cuts[k] : cuts[k + 1]].tobytes() for k in own], pa.binary()) for x in columns],
                ["bucket", "sure", *KINDS],
            )

    return docs.mapInArrow(run, "bucket int, sure boolean, gram binary, reach binary, check binary, id binary, start binary, ahead binary, more binary")


KINDS = {"gram": np.uint64, "reach": np.uint64, "check": np.uint64, "id": np.int64, "start": np.int32, "ahead": np.int16, "more": np.int16}


def refined(blocks: DataFrame, length: int) -> DataFrame:
    """kind 0: covered (id, start, stop); kind 1: borders (id, start, stop, gram); kind 2: the same, covered already.

    Of positions covered already, one of each bucket stands with the borders of its gram.
    """

    def run(table: pa.Table) -> pa.Table:
        c = {n: np.concatenate([np.frombuffer(x.as_buffer(), k) for x in table.column(n)]) for n, k in KINDS.items()}
        c["sure"] = np.repeat(table.column("sure").to_numpy(), [len(x.as_buffer()) // 8 for x in table.column("gram")])
        order = np.lexsort((c["start"], c["id"], c["reach"], c["gram"]))
        c = {n: x[order] for n, x in c.items()}
        fresh = np.ones(len(order), bool)  # a repeated row's positions count once
        fresh[1:] = np.any([c[n][1:] != c[n][:-1] for n in ("gram", "reach", "id", "start")], axis=0)
        c = {n: x[fresh] for n, x in c.items()}
        gram_new = np.concatenate([[True], c["gram"][1:] != c["gram"][:-1]])
        reach_new = gram_new | np.concatenate([[True], c["reach"][1:] != c["reach"][:-1]])
        of_gram, of_reach = np.cumsum(gram_new) - 1, np.cumsum(reach_new) - 1
        in_gram, in_reach = np.bincount(of_gram)[of_gram], np.bincount(of_reach)[of_reach]
        unlike = np.zeros(len(of_reach), bool)  # the first hash agrees with the row before, the second does not
        unlike[1:] = ~reach_new[1:] & (c["check"][1:] != c["check"][:-1])
        whole = (in_reach > 1) & (np.bincount(of_reach, unlike)[of_reach] == 0)
        sure = np.bincount(of_gram, c["sure"])[of_gram] > 0
        border = ~whole & ((in_gram > 1) | sure)
        has_border = sure | (np.bincount(of_gram, border)[of_gram] > 0)
        witness = whole & reach_new & has_border
        take = np.concatenate([np.flatnonzero(whole), np.flatnonzero(border), np.flatnonzero(witness)])
        kind = np.repeat(np.array([0, 1, 2], np.int32), [whole.sum(), border.sum(), witness.sum()])
        start = c["start"][take].astype(np.int64)
        return pa.table(
            {"kind": kind, "id": c["id"][take], "start": start, "stop": start + c["more"][take] + length, "gram": c["gram"][take].view(np.int64)}
        )

    return blocks.groupBy("bucket").applyInArrow(run, "kind int, id long, start long, stop long, gram long")


def _fetched(docs: DataFrame, borders: DataFrame) -> DataFrame:
    """Borders with their bytes: (bucket, kind, id, start, reach)."""
    lists = borders.groupBy("id").agg(F.collect_list(F.struct("kind", "start", "stop", "gram")).alias("borders"))

    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            data, offsets = text_buffers(batch.column("text"))
            items = batch.column("borders")
            flat, cuts = items.flatten(), np.asarray(items.offsets) - items.offsets[0].as_py()
            kind, start, stop, gram = (flat.field(n).to_numpy() for n in ("kind", "start", "stop", "gram"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(cuts))
            a, b = offsets[row] + start, offsets[row] + stop
            for i in range(0, len(a), 20_000):
                part = slice(i, i + 20_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram[part]),
                        pa.array(kind[part]),
                        ids.take(pa.array(row[part])),
                        pa.array(start[part]),
                        pa.array([data[x:y].tobytes() for x, y in zip(a[part], b[part], strict=True)], pa.binary()),
                    ],
                    ["gram", "kind", "id", "start", "reach"],
                )

    joined = docs.join(lists, "id").select("id", "text", "borders")
    return joined.mapInArrow(run, "gram long, kind int, id long, start long, reach binary")


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.uint64)


def string_buckets(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """A bucket number for each start, equal where the ``length`` bytes from there on are equal.

    Blocks of eight bytes are their own identifiers. Ranks of pairs of identifiers, a block's and that of the block
    behind it, identify blocks twice as long; the last step joins two that overlap, to the exact length.
    """
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    ids = np.zeros(len(data) + length, np.uint64)
    for k in range(8):
        ids |= padded[k : k + len(ids)] << np.uint64(8 * k)
    ids, size = _ranks(ids), 8
    while size * 2 <= length:
        ids, size = _ranks(ids[: len(ids) - size] << np.uint64(32) | ids[size:]), size * 2
    if size == length:
        return ids[starts]
    return ids[starts] << np.uint64(32) | ids[starts + length - size]


def settled(fetched: DataFrame, length: int, buckets: int) -> DataFrame:
    """Covered (id, start, stop) of borders: runs of starts whose string stands at another start too."""

    def run(table: pa.Table) -> pa.Table:
        data, offsets = text_buffers(table.column("reach"))
        kind, ids, first = (table.column(n).to_numpy() for n in ("kind", "id", "start"))
        size = np.diff(offsets) - length + 1
        row = np.repeat(np.arange(len(size)), size)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        at = offsets[row] + inner
        bucket = _ranks(string_buckets(data, at, length)).astype(np.int64)
        # one document's start may be listed by a repeated row, or as a border and a witness: it counts once
        once = np.unique(np.stack([bucket, ids[row], first[row] + inner]), axis=1)
        shared = np.bincount(once[0], minlength=bucket.max(initial=-1) + 1) > 1
        hit = shared[bucket] & (kind[row] == 1)
        row, inner = row[hit], inner[hit]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (inner[1:] != inner[:-1] + 1)
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(row)) - 1 if len(a) else a
        start = first[row[a]] + inner[a]
        return pa.table({"id": ids[row[a]], "start": start, "stop": first[row[a]] + inner[b] + length})

    dealt = fetched.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)).cast("int"))
    return dealt.groupBy("bucket").applyInArrow(run, "id long, start long, stop long")


def _spans(ids: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, start, stop) of the runs of neighbouring string starts."""
    order = np.lexsort((start, ids))
    ids, start = ids[order], start[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (start[1:] > start[:-1] + 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(ids)) - 1 if len(a) else a
    return ids[a], start[a], start[b] + length


def _by_string(key, check, own, start):
    """Starts by string and place, each once; whether each is the first of its string; whether its string has others."""
    order = np.lexsort((start, own, check, key))
    key, check, own, start = key[order], check[order], own[order], start[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])])
    fresh = new.copy()
    fresh[1:] |= (own[1:] != own[:-1]) | (start[1:] != start[:-1])
    key, check, own, start, new = (x[fresh] for x in (key, check, own, start, new))
    of = np.cumsum(new) - 1
    return key, check, own, start, new, np.bincount(of)[of] > 1


def settled_apart(fetched: DataFrame, length: int, buckets: int, bases: tuple[int, int]) -> DataFrame:
    """Covered (id, start, stop) as ``settled``, for borders of buckets too large to be brought together."""

    def dealt(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column("reach"))
            ids, first = batch.column("id").to_numpy(), batch.column("start").to_numpy()
            for a, b in slices(offsets, CHUNK):
                part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                size = np.diff(cuts) - length + 1
                row = np.repeat(np.arange(b - a), size)
                inner = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                at = cuts[row] + inner
                key, check = (span_hash(prefix_hashes(part, base), at, at + length, base) for base in bases)
                key, check, own, start, new, shared = _by_string(key, check, ids[a + row], first[a + row] + inner)
                spans = _spans(own[shared], start[shared], length)
                key, check, own, start = key[new], check[new], own[new], start[new]  # one of each string goes on
                bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                cut = np.searchsorted(bucket, np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cut))
                n, k = len(spans[0]), len(full)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.full(n, -1), full]).astype(np.int32)),
                        *(pa.concat_arrays([pa.array(x.astype(np.int64)), pa.nulls(k, pa.int64())]) for x in spans),
                        *(pa.array([None] * n + [x[cut[f] : cut[f + 1]].tobytes() for f in full], pa.binary()) for x in (key, check, own, start)),
                    ],
                    ["bucket", "id", "start", "stop", "keys", "checks", "ids", "starts"],
                )

    def run(table: pa.Table) -> pa.Table:
        kinds = {"keys": np.uint64, "checks": np.uint64, "ids": np.int64, "starts": np.int64}
        _, _, own, start, _, shared = _by_string(*(np.concatenate([np.frombuffer(x.as_buffer(), k) for x in table.column(n)]) for n, k in kinds.items()))
        return pa.table(dict(zip(("id", "start", "stop"), _spans(own[shared], start[shared], length), strict=True)))

    shape = "bucket int, id long, start long, stop long, keys binary, checks binary, ids binary, starts binary"
    parts = stored(fetched.select("id", "start", "reach").mapInArrow(dealt, shape), "strings")
    met = parts.where("bucket >= 0").select("bucket", "keys", "checks", "ids", "starts").groupBy("bucket").applyInArrow(run, "id long, start long, stop long")
    return parts.where("bucket < 0").select("id", "start", "stop").union(met)


def repeated_spans(docs: DataFrame, length: int) -> DataFrame:
    """(id, start, stop) for (id, text): byte ranges covered by strings that also start elsewhere; ranges may overlap."""
    buckets = 4 * partitions(docs.sparkSession)
    bases = new_bases()
    found = stored(refined(_pointer_blocks(docs, length, buckets, bases), length), "buckets")
    borders = found.where("kind > 0")
    per_gram = borders.groupBy("gram").count()
    most = max(HOT, borders.count() // HOT)
    hot = F.broadcast(per_gram.where(F.col("count") > most).select("gram"))  # at most HOT rows, by the line above
    fetched = stored(_fetched(docs, borders), "reaches")
    late = stored(settled(fetched.join(hot, "gram", "left_anti"), length, buckets), "borders")
    covered = found.where("kind = 0").select("id", "start", "stop").union(late)
    large = fetched.join(hot, "gram", "left_semi")
    return covered if hot.isEmpty() else covered.union(settled_apart(large, length, buckets, bases))


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """(id, n_bytes, spans, kept) per row: ``spans`` (start, stop) are the maximal removed runs, ``kept`` the bytes left."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id is not null")
    spans = repeated_spans(rows, length).groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def run(batches):
        for batch in batches:
            n_bytes, merged, kept = [], [], []
            for text, own in zip(batch.column("text"), batch.column("spans"), strict=True):
                raw = memoryview(text.as_buffer())
                runs = []
                for s in sorted((s["start"], s["stop"]) for s in own.as_py() or ()):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append([*s])
                edges = [0, *(x for r in runs for x in r), len(raw)]
                n_bytes.append(len(raw))
                merged.append([{"start": a, "stop": b} for a, b in runs])
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_bytes, pa.int64()), pa.array(merged, kind), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"]
            )

    joined = rows.join(spans, "id", "left").select("id", "text", "spans")
    return joined.mapInArrow(run, "id long, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary")
