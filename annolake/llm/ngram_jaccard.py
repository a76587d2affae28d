"""N-gram Jaccard join by parity sketches, a pigeonhole join per size band, and exact verification.

Every distinct n-gram of a document flips one bit of a very wide bit vector: the document's parity sketch. N-grams two
documents share cancel, so the Hamming distance of two sketches is at most the symmetric difference of their sets, and
Jaccard >= t bounds that difference by D = |A| (1 - t) / t. The vector is cut into pieces, as many per document as its
size band says; a piece is kept as the XOR of its set bits' 64-bit codes, so equal pieces have equal keys. At most D
of the pieces that a document fills can differ, so the first piece (in any fixed order) that both hold alike is among
the first D + 1 filled pieces of each: joining those D + 1 keys per size band misses no pair. N-grams that very many
documents hold sort their pieces last, which keeps them out of the keys. Candidates must then pass a folded sketch's
Hamming bound, and at last the sets themselves are compared.

Groups of identical sets are one class throughout. A key of up to ``group_limit`` classes gives all its pairs. A larger
one is dealt into blocks, and pairs of blocks are held against each other: first by sketches, where a member gives its
partners if they are few and else its nearest one; then, for members of many partners whose key still has several
components, by the sets themselves, where a pair of blocks returns a spanning forest of its links and never their pairs.
Links are counted in the same way, component by component.

Sets are compared by 64-bit hashes of their n-grams. Two sets are one class if two sums of 64 bits agree: where only the
first does, all is done anew with other sums.

Nulls, empty texts and texts without words have no n-grams and link with nothing; repeated rows (same id) are one
document, whose set comes from each row alone; rows with a null id are left out; extra columns, whatever their names,
are ignored; texts of any length are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import mixed, named, partitions, prefix_hashes, slices, span_hash, stored, text_buffers, whole_row
from annolake.llm.graph import components

LEAST_BITS = 64
CHUNK = 1 << 18  # bytes of text hashed at a time, at some 50 bytes of arrays each
KEYS_AT_ONCE = 1 << 19  # keys packed at a time
BLOCK, BLOCK_HASHES = 2048, 1 << 19  # members of a group, and n-grams of them, held against each other at a time
DEALT = 100_000  # rows of blocks in one task, or n-grams of them times 32
PAIRS_AT_ONCE = 1 << 15
TOGETHER, BUCKET_HASHES = 64, 1 << 22  # members of a component of candidates whose sets go to one bucket; n-grams of a bucket
SIZE_STEP = 1.06
RUNTIME_BITS = 1 << 24
LEAST_ID = -(1 << 63)
BLOCKS = "bucket int, sure boolean, keys binary, classes binary, sizes binary"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word of the texts, and the n + 1 places where each text's words begin."""
    low = _LOWER[data]
    inside = ~_SPACE[low]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span_hash(prefix_hashes(low), start, end), np.searchsorted(start, offsets)


def shingle_sets(array: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, offsets) for slices of a text column: each row's distinct n-grams, sorted."""
    data, offsets = text_buffers(array)
    for a, b in slices(offsets, CHUNK):
        words, at = word_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        padded = np.concatenate([words, np.zeros(width, np.uint64)])
        grams = np.zeros(len(words), np.uint64)
        for k in range(width):
            grams = grams * np.uint64(0xFF51AFD7ED558CCD) + padded[k : k + len(words)]
        grams = mixed(grams)
        sets, sizes = [], [0]
        for r in range(b - a):
            s, e = at[r], at[r + 1]
            if e - s >= width:
                own = np.unique(grams[s : e - width + 1])
            elif e > s:
                own = np.array([e - s], np.uint64)
                for k in range(s, e):
                    own = mixed(own * np.uint64(31) ^ words[k : k + 1])
            else:
                own = np.zeros(0, np.uint64)
            sets.append(own)
            sizes.append(len(own))
        yield a, np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum(sizes)


def _class_ids(hashes: np.ndarray, offsets: np.ndarray, salt: int) -> np.ndarray:
    """One 64-bit id for each set, the same for equal sets (0 for the empty one); other salts give other ids."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mixed(hashes ^ mixed(np.array([0xA0761D6478BD642F + salt], np.uint64))), out=sums[1:])
    n = np.diff(offsets).astype(np.uint64)
    ids = mixed(sums[offsets[1:]] - sums[offsets[:-1]] + n * np.uint64(0xE7037ED1A0B428DB))
    return np.where(n == 0, 0, ids.view(np.int64))


def _folded(hashes: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The parity sketch folded to a power of two of bits, one for each n-gram or more: a lower bound still."""
    n = np.diff(offsets)
    bits = 2 ** np.ceil(np.log2(np.maximum(n, LEAST_BITS))).astype(np.int64)
    first = np.cumsum(bits) - bits
    bit = (hashes >> np.uint64(7)) & (np.repeat(bits, n) - 1).astype(np.uint64)
    odd = np.bincount(np.repeat(first, n) + bit.astype(np.int64), minlength=int(bits.sum())) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little")
    return [packed[a : a + k].tobytes() for a, k in zip(first // 8, bits // 8, strict=True)]


def halved(sketches: np.ndarray) -> np.ndarray:
    """Rows of sketches folded once more: bits that fall together cancel or stay, so distances only shrink."""
    half = sketches.shape[-1] // 2
    return sketches[..., :half] ^ sketches[..., half:]


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two folded sketches, the wider one folded to the other's width."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = halved(x)
    while len(y) > len(x):
        y = halved(y)
    return int(np.bitwise_count(x ^ y).sum())


def _frequent(parts: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Values that the parts hold ``least`` times or more, and how often; empties ``parts``, and sorts in place."""
    held = np.concatenate(parts or [np.zeros(0, np.uint64)])
    parts.clear()
    held.sort()
    values = held[: max(len(held) - least + 1, 0)]
    values = np.unique(values[values == held[least - 1 :]])
    return values, np.searchsorted(held, values, "right") - np.searchsorted(held, values)


def describe(docs: DataFrame, width: int, salt: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, cls, sums, sketch) per row, and (hash, n) rows with kind 1 for n-grams that are frequent within a batch."""
    names = ["kind", "id", "n", "cls", "sums", "sketch"]

    def run(batches):
        for batch in batches:
            tokens = []
            for a, hashes, offsets in shingle_sets(batch.column(1), width):
                n = len(offsets) - 1
                tokens.append(hashes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(n, np.int32)),
                        batch.column(0).slice(a, n),
                        pa.array(np.diff(offsets)),
                        pa.array(_class_ids(hashes, offsets, salt)),
                        pa.array(_class_ids(hashes, offsets, ~salt & 0xFFFF)),
                        pa.array(_folded(hashes, offsets), pa.binary()),
                    ],
                    names,
                )
            values, counts = _frequent(tokens, max(16, batch.num_rows // 500))
            k = len(values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.ones(k, np.int32)),
                    pa.array(values.view(np.int64)),
                    pa.array(counts),
                    pa.nulls(k, pa.int64()),
                    pa.nulls(k, pa.int64()),
                    pa.nulls(k, pa.binary()),
                ],
                names,
            )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "kind int, id long, n long, cls long, sums long, sketch binary"
    )


def _bands(n: np.ndarray, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, band) for the size bands [4**k, 4**(k + 1)) of sets and the next band, where a larger partner may be."""
    home = np.zeros(len(n), np.int64)
    filled = n > 0
    home[filled] = (np.floor(np.log2(n[filled])) // 2).astype(np.int64)
    rows = np.flatnonzero(filled)
    yield rows, home[rows]
    near = rows[np.floor(n[rows] / t) >= 4.0 ** (home[rows] + 1)]
    yield near, home[near] + 1


def piece_keys(hashes, offsets, t: float, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row): for each set and band, the keys of its first D + 1 filled pieces, those of rarer n-grams first.

    A set that fills D pieces or fewer, so small that its n-grams fell together, gives a key for each n-gram besides.
    """
    keys, owners = [], []
    sizes = np.diff(offsets)
    most = np.floor(sizes * ((1 - t) / t) + 1e-9).astype(np.int64)
    common = np.isin(hashes, hot) if len(hot) else np.zeros(len(hashes), bool)
    for rows, band in _bands(sizes, t):
        if not len(rows):
            continue
        take = np.concatenate([np.arange(offsets[r], offsets[r + 1]) for r in rows])
        h, count = hashes[take], sizes[rows]
        owner = np.repeat(np.arange(len(rows)), count)
        bits = (2 * band + np.where(band < 3, 4, 2)).astype(np.uint64)  # 4 ** (band + 1) pieces, more for small sets
        piece = h >> (np.uint64(64) - bits[owner])  # sets are sorted by hash, so pieces are in order
        new = np.ones(len(h), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])
        at = np.flatnonzero(new)
        salt = mixed(piece[at] + (bits[owner[at]] << np.uint64(56)))
        key = mixed(np.bitwise_xor.reduceat(mixed(h ^ np.uint64(0x8EBC6AF09C88C6E3)), at) ^ salt)
        only_common = np.bitwise_and.reduceat(common[take], at)
        who = owner[at]
        order = np.lexsort((piece[at], only_common, who))
        key, who = key[order], who[order]
        filled = np.bincount(who, minlength=len(rows))
        rank = np.arange(len(who)) - np.repeat(np.cumsum(filled) - filled, filled)
        kept = rank <= most[rows][who]
        keys.append(key[kept])
        owners.append(rows[who[kept]])
        short = (filled <= most[rows])[owner]
        if short.any():
            keys.append(mixed(h[short] ^ (bits[owner[short]] << np.uint64(40)) ^ np.uint64(0x589965CC75374CC3)))
            owners.append(rows[owner[short]])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def _size_steps(n: np.ndarray) -> np.ndarray:
    """Sizes as one byte each: the logarithm to the base SIZE_STEP, the last step open upwards."""
    return np.minimum(np.log(np.maximum(n, 1)) / np.log(SIZE_STEP), 255).astype(np.uint8)


def _may_fit(x: np.ndarray, y: np.ndarray, t: float) -> np.ndarray:
    """Whether sizes of these steps can have the ratio ``t`` or more."""
    apart = np.abs(x.astype(np.int64) - y)
    return SIZE_STEP ** (apart - 1.0) <= 1 / t + 1e-9


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys byte plane by byte plane: the upper planes are long runs, which the shuffle's compression removes."""
    return keys.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _distinct_members(key: np.ndarray, cls: np.ndarray, size: np.ndarray):
    """(key, cls, size), each member of a key once and in order, and the place of each member within its key."""
    order = np.lexsort((cls, key))
    key, cls, size = key[order], cls[order], size[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
    key, cls, size = key[new], cls[new], size[new]
    return key, cls, size, np.arange(len(key)) - np.searchsorted(key, key)


def key_blocks(key: np.ndarray, cls: np.ndarray, size: np.ndarray, buckets: int, limit: int) -> pa.RecordBatch:
    """Keys with (class, step of its size, one byte), as one packed block for each range of keys; ``candidates`` reads them.

    A batch gives ``limit`` + 1 members of a key to the key's range. Those beyond it, whose key is large already, are
    ``sure`` members and go to any range, so that no range gets more than a few members of one key from a batch.
    """
    key, cls, size, place = _distinct_members(key, cls, size.astype(np.uint8))
    sure = place > limit
    home = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    bucket = np.where(sure, (cls.view(np.uint64) % np.uint64(buckets)).astype(np.int64), home) * 2 + sure
    order = np.argsort(bucket, kind="stable")
    key, cls, size, bucket = key[order], cls[order], size[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(2 * buckets + 1))
    own = np.flatnonzero(np.diff(cuts))
    return pa.RecordBatch.from_arrays(
        [
            pa.array((own // 2).astype(np.int32)),
            pa.array(own % 2 == 1),
            pa.array([_packed(key[cuts[x] : cuts[x + 1]]) for x in own], pa.binary()),
            pa.array([cls[cuts[x] : cuts[x + 1]].tobytes() for x in own], pa.binary()),
            pa.array([size[cuts[x] : cuts[x + 1]].tobytes() for x in own], pa.binary()),
        ],
        ["bucket", "sure", "keys", "classes", "sizes"],
    )


def _key_blocks(docs: DataFrame, width: int, t: float, salt: int, id_col: str, text_col: str, hot: np.ndarray, buckets: int, limit: int) -> DataFrame:
    """Keys with (class, step of its size), as one packed block for each batch and range of keys."""

    def run(batches):
        for batch in batches:
            keys, sizes, classes, held = [], [], [], 0
            for _, hashes, offsets in shingle_sets(batch.column(1), width):
                cls = _class_ids(hashes, offsets, salt)
                _, firsts = np.unique(cls, return_index=True)
                firsts = np.sort(firsts)  # copies within the batch give keys once
                if len(firsts) < len(cls):
                    hashes = np.concatenate([hashes[offsets[r] : offsets[r + 1]] for r in firsts])
                    offsets = np.concatenate([[0], np.cumsum(np.diff(offsets)[firsts])])
                    cls = cls[firsts]
                k, o = piece_keys(hashes, offsets, t, hot)
                keys.append(k)
                classes.append(cls[o])
                sizes.append(_size_steps(np.diff(offsets))[o])
                held += len(k)
                if held >= KEYS_AT_ONCE:
                    yield key_blocks(np.concatenate(keys), np.concatenate(classes), np.concatenate(sizes), buckets, limit)
                    keys, sizes, classes, held = [], [], [], 0
            if keys:
                yield key_blocks(np.concatenate(keys), np.concatenate(classes), np.concatenate(sizes), buckets, limit)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, BLOCKS)


def candidates(blocks: DataFrame, t: float, limit: int) -> DataFrame:
    """kind 0: (a, b) candidate classes of keys with up to ``limit`` of them; kind 1: members (key, cls) of larger keys.

    A member may be given more than once.
    """

    def run(table: pa.Table) -> pa.Table:
        keys = [_unpacked(x.as_py()) for x in table.column("keys")]
        sure = np.repeat(table.column("sure").to_numpy(), [len(k) for k in keys])
        key, cls = np.concatenate(keys), np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table.column("classes")])
        size = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("sizes")])
        passed = (key[sure], cls[sure])
        key, cls, size, _ = _distinct_members(key[~sure], cls[~sure], size[~sure])
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.append(at, len(key)))
        pairs = [np.zeros((2, 0), np.int64)]
        for k in range(1, limit):
            s = at[(n > k) & (n <= limit)]
            for j in range(k):
                fits = _may_fit(size[s + j], size[s + k], t)
                pairs.append(np.stack([cls[s + j][fits], cls[s + k][fits]]))
        both = np.unique(np.concatenate(pairs, axis=1), axis=1)
        large = np.repeat(n > limit, n)
        return pa.table(
            {
                "kind": pa.array(np.repeat(np.array([0, 1, 1], np.int32), [both.shape[1], large.sum(), len(passed[0])])),
                "a": pa.array(np.concatenate([both[0], key[large].view(np.int64), passed[0].view(np.int64)])),
                "b": pa.array(np.concatenate([both[1], cls[large], passed[1]])),
            }
        )

    return blocks.groupBy("bucket").applyInArrow(run, "kind int, a long, b long")


def _within_bound(pairs: DataFrame, classes: DataFrame, t: float) -> DataFrame:
    """Pairs whose sizes and folded sketches still allow the similarity."""
    left = classes.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = classes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") >= t * F.greatest("na", "nb"))

    def run(batches):
        for batch in batches:
            far = np.array([distance(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True)])
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            near = pa.array(far * (1 + t) <= (1 - t) * total + 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(near)

    return joined.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


class _Sketches:
    """Folded sketches of many rows, held by width, for distances of many pairs at once."""

    def __init__(self, sketches: list[bytes]):
        self.width = np.array([len(x) // 8 for x in sketches])
        self.place = np.zeros(len(sketches), np.int64)
        self.held = {}
        for w in np.unique(self.width):
            rows = np.flatnonzero(self.width == w)
            self.place[rows] = np.arange(len(rows))
            self.held[w, w] = np.frombuffer(b"".join(sketches[r] for r in rows), np.uint64).reshape(-1, w)
            while w > 1 and (self.width == w // 2).any():
                self.held[self.width[rows[0]], w // 2] = halved(self.held[self.width[rows[0]], w])
                w //= 2

    def within(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Distances of the pairs, and infinity for those beyond ``most``."""
        far = np.zeros(len(i))
        for w, v in {*zip(self.width[i].tolist(), self.width[j].tolist(), strict=True)}:
            at = np.flatnonzero((self.width[i] == w) & (self.width[j] == v))
            x, y = (self.held.get((k, min(w, v))) for k in (w, v))
            if x is not None and y is not None:  # sizes are near, so widths are the same or one fold apart
                far[at] = np.bitwise_count(x[self.place[i[at]]] ^ y[self.place[j[at]]]).sum(axis=1)
        return np.where(far <= most, far, np.inf)


class _Sets:
    """Sets of many rows as bits, one for each n-gram that two of them hold, for intersections of many pairs at once."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(x) for x in sets])
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times > 1
        place = np.cumsum(shared) - 1
        row, column = np.repeat(np.arange(len(sets)), sizes)[shared[column]], place[column[shared[column]]]
        words = max(1, -(-int(shared.sum()) // 64))
        code = np.unique(row * (words * 64) + column)
        at, new = code >> 6, np.ones(len(code), bool)
        new[1:] = at[1:] != at[:-1]
        self.bits = np.zeros(len(sets) * words, np.uint64)
        if len(code):
            first = np.flatnonzero(new)
            self.bits[at[first]] = np.bitwise_or.reduceat(np.uint64(1) << (code & 63).astype(np.uint64), first)
        self.bits = self.bits.reshape(len(sets), words)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out, step = np.zeros(len(i), np.int64), max(1, (1 << 22) // self.bits.shape[1])
        for a in range(0, len(i), step):
            own = slice(a, a + step)
            out[own] = np.bitwise_count(self.bits[i[own]] & self.bits[j[own]]).sum(axis=1)
        return out


def _pairs_by_size(group: np.ndarray, n: np.ndarray, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group whose sizes have the ratio ``t``, in parts; rows are sorted by group, then size."""
    end = np.searchsorted(group, group, side="right")
    live, k, parts, held = np.arange(len(group)), 0, [], 0
    while len(live):
        k += 1
        live = live[live + k < end[live]]
        live = live[n[live] >= t * n[live + k] - 1e-9]  # partners further on are larger still
        parts.append((live, live + k))
        held += len(live)
        if held >= PAIRS_AT_ONCE or not len(live):
            i, j = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            for a in range(0, len(i), PAIRS_AT_ONCE):
                yield i[a : a + PAIRS_AT_ONCE], j[a : a + PAIRS_AT_ONCE]
            parts, held = [], 0


def dealt(members: DataFrame, by: str, carried: list[str]) -> DataFrame:
    """Members (``by``, node, n, ...) of groups dealt into blocks, a row for each pair of blocks that a member is in.

    A block has about BLOCK members and BLOCK_HASHES n-grams at most, however large its group; ``bucket`` brings many
    pairs of blocks together, of about DEALT rows or 32 times as many n-grams in all.
    """
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_HASHES, F.lit(1))).cast("int")
    per_group = stored(members.groupBy(by).agg(blocks.alias("blocks"), F.count("*").alias("m"), F.sum("n").alias("grams")), "groups")
    load = per_group.agg(F.coalesce(F.sum(F.col("blocks") * F.greatest(F.col("m"), F.col("grams") / 32)), F.lit(0))).first()[0]
    buckets = max(4 * partitions(members.sparkSession), int(load // DEALT))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = members.join(per_group.select(by, "blocks"), by).withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(by, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "n", *carried)
    return rows.withColumn("bucket", F.pmod(F.xxhash64(by, "x", "y"), F.lit(buckets)))


def in_order(table: pa.Table, by: str) -> tuple[pa.Table, np.ndarray, dict[str, np.ndarray]]:
    """A bucket's rows by pair of blocks and size, each member once; the number of its pair of blocks; its number columns."""
    c = {k: table.column(k).to_numpy() for k in (by, "x", "y", "node", "n")}
    order = np.lexsort((c["node"], c["n"], c["y"], c["x"], c[by]))
    c = {k: v[order] for k, v in c.items()}
    new = np.ones(len(order), bool)
    new[1:] = (c[by][1:] != c[by][:-1]) | (c["x"][1:] != c["x"][:-1]) | (c["y"][1:] != c["y"][:-1])
    once = new.copy()
    once[1:] |= c["node"][1:] != c["node"][:-1]
    table = table.take(pa.array(order[once]))
    return table, np.cumsum(new)[once], {k: table.column(k).to_numpy() for k in table.column_names if pa.types.is_integer(table.schema.field(k).type)}


def apart(c: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether this pair of blocks is the one that holds the two rows against each other."""
    return (c["x"][i] == c["y"][i]) | (c["own"][i] != c["own"][j])


def _nearest_partners(members: DataFrame, t: float, limit: int) -> DataFrame:
    """kind 0: pairs (a, b) of one key's members that the sketches allow; kind 1: (key, node).

    Of a member with up to ``limit`` such partners, all its pairs are given, of others that with the nearest partner;
    kind 1 names the members that have more.
    """

    def run(table: pa.Table) -> pa.Table:
        table, group, c = in_order(table, "key")
        node, n = c["node"], c["n"]
        sketches = _Sketches(table.column("sketch").to_pylist())
        best, partner, count, few = np.full(len(n), np.inf), np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), []
        for i, j in _pairs_by_size(group, n, t):
            new = apart(c, i, j)
            i, j = i[new], j[new]
            total = n[i] + n[j]
            far = sketches.within(i, j, ((1 - t) * total + 1e-9) / (1 + t))
            near = np.isfinite(far)
            i, j, share = i[near], j[near], (far / total)[near]
            for p, q in ((i, j), (j, i)):
                first = np.lexsort((q, share, p))
                first = first[np.concatenate([[True], p[first][1:] != p[first][:-1]])] if len(p) else first
                first = first[share[first] < best[p[first]]]
                best[p[first]], partner[p[first]] = share[first], q[first]
            count += np.bincount(i, minlength=len(n)) + np.bincount(j, minlength=len(n))
            kept = (count[i] <= limit) | (count[j] <= limit)
            few.append(np.stack([i[kept], j[kept]]))
        i = np.flatnonzero(np.isfinite(best))
        few = np.concatenate([*few, np.zeros((2, 0), np.int64)], axis=1)
        few = few[:, (count[few] <= limit).any(axis=0)]
        ends = np.concatenate([node[few], np.stack([node[i], node[partner[i]]])], axis=1)
        ends = np.unique(np.sort(ends, axis=0), axis=1)
        many = count > limit
        return pa.table(
            {
                "kind": np.repeat(np.array([0, 1], np.int32), [ends.shape[1], many.sum()]),
                "a": np.concatenate([ends[0], c["key"][many]]),
                "b": np.concatenate([ends[1], node[many]]),
            }
        )

    return dealt(members, "key", ["sketch"]).groupBy("bucket").applyInArrow(run, "kind int, a long, b long")


def _linked(table: pa.Table, group: np.ndarray, n: np.ndarray, t: float, percent: int, wanted) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of rows of one group, in parts, by their sets; ``wanted`` says which pairs (i, j) are looked at."""
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes")]
    offsets = np.concatenate([[0], np.cumsum(n)])
    sketches = _Sketches(_folded(np.concatenate(sets), offsets))
    for g in np.unique(group):
        a, b = np.searchsorted(group, [g, g + 1])
        bits = None
        for i, j in _pairs_by_size(group[a:b], n[a:b], t):
            i, j = i + a, j + a
            keep = wanted(i, j)
            i, j = i[keep], j[keep]
            total = n[i] + n[j]
            near = np.isfinite(sketches.within(i, j, ((1 - t) * total + 1e-9) / (1 + t)))
            i, j = i[near], j[near]
            if not len(i):
                continue
            bits = bits or _Sets(sets[a:b])
            both = bits.common(i - a, j - a)
            link = 100 * both >= percent * (n[i] + n[j] - both)
            yield i[link], j[link]


def _one_key_of_each_set(members: DataFrame) -> DataFrame:
    """``members`` of one key for each set of nodes: copies share many n-grams, and keys of the same nodes give the same pairs."""
    known = stored(members.distinct(), "members")
    both = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"h{k}") for k in (1, 2)]
    marks = known.groupBy("key").agg(F.count("*").alias("m"), *both)
    return known.join(marks.groupBy("m", "h1", "h2").agg(F.min("key").alias("key")).select("key"), "key")


def _across(members: DataFrame, t: float) -> DataFrame:
    """The members (key, node, n, root) that the sketches allow a link with a member of their key in another component."""

    def run(table: pa.Table) -> pa.Table:
        table, group, c = in_order(table, "key")
        sketches = _Sketches(table.column("sketch").to_pylist())
        n, root, marked = c["n"], c["root"], np.zeros(len(group), bool)
        for i, j in _pairs_by_size(group, n, t):
            other = (root[i] != root[j]) & apart(c, i, j) & ~(marked[i] & marked[j])
            i, j = i[other], j[other]
            near = np.isfinite(sketches.within(i, j, ((1 - t) * (n[i] + n[j]) + 1e-9) / (1 + t)))
            marked[i[near]] = marked[j[near]] = True
        return pa.table({k: c[k][marked] for k in ("key", "node", "n", "root")})

    return dealt(members, "key", ["root", "sketch"]).groupBy("bucket").applyInArrow(run, "key long, node long, n long, root long").distinct()


def _forests(members: DataFrame, t: float, percent: int) -> DataFrame:
    """(a, b): links that join components, a spanning forest from each pair of blocks of a key; members have their sets."""

    def run(table: pa.Table) -> pa.Table:
        table, group, c = in_order(table, "key")
        _, part = np.unique(c["root"], return_inverse=True)
        above = list(range(part.max(initial=-1) + 1))

        def top(x: int) -> int:
            while above[x] != x:
                above[x] = x = above[above[x]]
            return x

        label, found = part.copy(), []
        for i, j in _linked(table, group, c["n"], t, percent, lambda i, j: (label[i] != label[j]) & apart(c, i, j)):
            _, first = np.unique(np.stack([label[i], label[j]], axis=1), axis=0, return_index=True)
            for k in first:
                x, y = sorted((top(int(label[i[k]])), top(int(label[j[k]]))))
                if x != y:
                    above[y] = x
                    found.append((c["node"][i[k]], c["node"][j[k]]))
            label[:] = np.array([top(x) for x in range(len(above))])[part]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return dealt(members, "key", ["root", "hashes"]).groupBy("bucket").applyInArrow(run, "a long, b long")


def _link_counts(members: DataFrame, t: float, percent: int) -> DataFrame:
    """(node, n_links) of the members (root, node, n, hashes) of components."""

    def run(table: pa.Table) -> pa.Table:
        table, group, c = in_order(table, "root")
        links = np.zeros(len(group), np.int64)
        for i, j in _linked(table, group, c["n"], t, percent, lambda i, j: apart(c, i, j)):
            links += np.bincount(i, minlength=len(links)) + np.bincount(j, minlength=len(links))
        some = links > 0
        return pa.table({"node": c["node"][some], "links": links[some]})

    parts = dealt(members, "root", ["hashes"]).groupBy("bucket").applyInArrow(run, "node long, links long")
    return parts.groupBy("node").agg(F.sum("links").alias("n_links"))


def _sets_of(wanted: DataFrame, docs: DataFrame, width: int, salt: int, id_col: str, text_col: str) -> DataFrame:
    """(cls, bucket, hashes): the sets of the classes (cls, rep, bucket), from the texts of their representatives, in the shared folder.

    Spark's runtime filter, of RUNTIME_BITS whatever the input, drops most other texts before they are shuffled.
    """
    spark = docs.sparkSession
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    settings = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "1g", "expectedNumItems": "4000000", "numBits": str(RUNTIME_BITS)}
    before = {k: spark.conf.get(prefix + k) for k in settings}
    needed = stored(wanted.select(F.col("rep").alias("id"), "bucket").distinct(), "needed").where(F.col("id") >= LEAST_ID)  # Spark filters by a side that has a condition
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(needed, "id")

    def run(batches):
        for batch in batches:
            for a, hashes, offsets in shingle_sets(batch.column("text"), width):
                sets = [hashes[offsets[r] : offsets[r + 1]].tobytes() for r in range(len(offsets) - 1)]
                yield pa.RecordBatch.from_arrays([pa.array(_class_ids(hashes, offsets, salt)), batch.column("bucket").slice(a, len(sets)), pa.array(sets, pa.binary())], ["cls", "bucket", "hashes"])

    try:
        for k, v in settings.items():
            spark.conf.set(prefix + k, v)
        return stored(rows.mapInArrow(run, "cls long, bucket long, hashes binary"), "sets")
    finally:
        for k, v in before.items():
            spark.conf.set(prefix + k, v)


def _alike(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    both = np.count_nonzero(q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p)
    return 100 * both >= percent * (len(p) + len(q) - both)


def _in_buckets(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, rep, bucket) of the classes in ``pairs``: those of one small component of candidates share a bucket; -1: a large one's."""
    roots = stored(components(pairs), "candidate-roots").join(classes.select(F.col("cls").alias("node"), "rep", "n"), "node")
    sizes = stored(roots.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("grams")), "sizes")
    load = sizes.agg(F.coalesce(F.sum("grams"), F.lit(0))).first()[0]
    buckets = max(4 * partitions(pairs.sparkSession), int(load // BUCKET_HASHES))
    small = (F.col("members") <= TOGETHER) & (F.col("grams") <= BUCKET_HASHES)
    bucket = F.when(small, F.pmod(F.xxhash64("root"), F.lit(buckets).cast("long"))).otherwise(F.lit(-1).cast("long"))
    return stored(roots.join(sizes.select("root", bucket.alias("bucket")), "root").select(F.col("node").alias("cls"), "rep", "bucket"), "buckets")


def _verified(pairs: DataFrame, sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose sets have 100 * intersection >= percent * union.

    Pairs of small components of candidates are looked at where the sets of their bucket are, so each set is shuffled
    once however many pairs it is in; for a large component's pairs the sets are joined to each pair.
    """

    def together(left: pa.Table, right: pa.Table) -> pa.Table:
        at = {c: k for k, c in enumerate(right.column("cls").to_pylist())}
        own = right.column("hashes").combine_chunks() if right.num_rows else None
        found = [(a, b) for a, b in zip(left.column("a").to_pylist(), left.column("b").to_pylist(), strict=True) if _alike(*(np.frombuffer(own[at[x]].as_buffer(), np.uint64) for x in (a, b)), percent)]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    def run(batches):
        for batch in batches:
            keep = [_alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(batch.column("ha"), batch.column("hb"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    dealt_out = pairs.join(placed.select(F.col("cls").alias("a"), "bucket"), "a")
    near = dealt_out.where("bucket >= 0").groupBy("bucket").cogroup(sets.where("bucket >= 0").groupBy("bucket")).applyInArrow(together, "a long, b long")
    rest, own = dealt_out.where("bucket < 0").select("a", "b"), sets.where("bucket < 0")
    joined = rest.join(own.select(F.col("cls").alias("a"), F.col("hashes").alias("ha")), "a")
    joined = joined.join(own.select(F.col("cls").alias("b"), F.col("hashes").alias("hb")), "b")
    return near.union(joined.select("a", "b", "ha", "hb").mapInArrow(run, "a long, b long")).distinct()


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 75,
    group_limit: int = 8,
    count_links: bool = False,
) -> DataFrame:
    """(id, n_shingles, class_id, component_id[, n_links]) per document; links are 100 * intersection >= percent * union.

    class_id is the smallest id with the same set, component_id the smallest id reachable by links; both are the id
    itself for documents without words. With ``count_links``, n_links is the number of other classes that the row's
    class is linked with. ``group_limit`` only sets how many partners are given as pairs; it changes no result.
    """
    spark = docs.sparkSession
    t = percent / 100
    for salt in range(8):
        facts = stored(describe(docs, width, salt, id_col, text_col), "sketches")
        described = facts.where("kind = 0 and id is not null")
        by_class = described.where("n > 0").groupBy("cls")
        torn = (F.min("sums") != F.max("sums")).alias("torn")
        classes = stored(by_class.agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("id").alias("rep"), torn), "classes")
        if classes.where("torn").isEmpty():
            break
    n_docs = described.count()
    # n-grams of one document in a thousand and more: at most a thousand times a document's mean size, whatever the input
    frequent = facts.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).where(F.col("n") * 1000 >= n_docs)
    hot = np.array([r.id for r in frequent.orderBy(F.desc("n"), "id").limit(200_000).collect()], np.int64).view(np.uint64)

    blocks = _key_blocks(docs, width, t, salt, id_col, text_col, hot, 4 * partitions(spark), group_limit)
    found = stored(candidates(blocks, t, group_limit), "candidates")
    members = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node")).distinct()
    members = members.join(classes.select(F.col("cls").alias("node"), "n", "sketch"), "node")
    near = stored(_nearest_partners(members, t, group_limit), "partners")
    small = _within_bound(found.where("kind = 0").select("a", "b").distinct(), classes, t)
    pairs = stored(small.union(near.where("kind = 0").select("a", "b")).distinct(), "pairs")
    placed = _in_buckets(pairs, classes)
    sets = _sets_of(placed, docs, width, salt, id_col, text_col)
    links = stored(_verified(pairs, sets, placed, percent), "links")
    sets = sets.select("cls", "hashes")
    roots = components(links)

    # all pairs of the other members of large keys have been looked at; of these, only those in different components matter
    many = near.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node")).distinct()
    many = many.join(classes.select(F.col("cls").alias("node"), "n"), "node").join(roots, "node", "left")
    many = many.select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    split = many.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    many = stored(_one_key_of_each_set(many.join(split.select("key"), "key")), "apart")
    if not many.isEmpty():
        # sketches are small: only members that they allow a link across components come with their sets
        many = stored(_across(many.join(classes.select(F.col("cls").alias("node"), "sketch"), "node"), t), "across")
        late = stored(_forests(many.join(sets.withColumnRenamed("cls", "node"), "node"), t, percent), "links")
        if not late.isEmpty():
            roots = components(links.union(late))

    named = classes.join(roots, F.col("cls") == F.col("node"), "left").select("cls", F.col("rep").alias("class_id"), F.coalesce("root", "cls").alias("root"))
    named = stored(named, "named")
    named = named.join(named.groupBy("root").agg(F.min("class_id").alias("component_id")), "root").select("cls", "class_id", "component_id")
    extra = []
    if count_links:
        rooted = roots.join(classes.select(F.col("cls").alias("node"), "n"), "node").join(sets.withColumnRenamed("cls", "node"), "node")
        named = named.join(_link_counts(rooted, t, percent), F.col("cls") == F.col("node"), "left").drop("node")
        extra = [F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")]
    return described.join(named, "cls", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("component_id", "id").alias("component_id"), *extra
    )


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with its own columns, without the rows whose id is not the smallest of its component.

    Rows with a null id are no part of any group and stay.
    """
    gone = near_duplicates(docs, id_col=id_col, **options).where("id <> component_id").select(F.col("id").alias("key")).distinct()
    rows = docs.select(whole_row(docs).alias("doc"), named(id_col).cast("long").alias("key"))
    return rows.join(gone, "key", "left_anti").select("doc.*")
