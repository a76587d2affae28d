"""Local image descriptors: cropped, turned or edited copies in a media column.

A media value is a binary PGM picture (``P5``, 8 bits). Corners are sought at three scales, the strongest
of each cell of a grid, so that their number grows with the picture and a crop shares those of its part; each is given the direction
of its surroundings' centre of brightness, and 256 comparisons of pixel pairs, turned by that direction, make its
descriptor. Descriptors are cut into four parts of 64 bits; two descriptors at most 3 bits apart agree in one part, and
of the many corners that copies share some do, so tables keyed by (part, its bits) join pictures that may share a
corner. A candidate pair is then compared in full: its
mutually nearest descriptors each propose a shift, turn and scaling, and the pair is linked if ``least`` corners agree
with one proposal.

Pictures of equal pixels are one class throughout, so copies are never expanded into pairs. A key that more than
``group_limit`` classes hold is linked as a star; where its members stay in several components it is dealt into blocks,
and each pair of blocks compares members of different components and returns a spanning forest of their links. Links
are not counted.

Null, empty or unreadable media and pictures without corners have no descriptors: they link with nothing, though equal
pictures stay one class. Rows with a null id are left out; repeated rows (same id) give one row, that of one of their
pictures, while all of them link. Extra columns are ignored and an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import mixed, partitions, stored
from annolake.llm.graph import components
from annolake.llm.ngram_jaccard import BLOCKS, apart, candidates, dealt, in_order, key_blocks

LEVELS = ((1.0, 16), (2**-0.5, 10), (0.5, 6))  # scale, corners kept in each cell
ONE_CELL, CELL = 96, 64  # pixels: sides up to the first are one cell, longer ones are cut into cells of the second or less
ROWS = 1024  # corners of a large picture compared at a time
RADIUS = 9
PARTS = 4
NEAR = 40  # bits of 256 within which descriptors may match

_rng = np.random.default_rng(2024)
_first = _rng.normal(0, 4.0, (256, 2))
_second = _first + _rng.normal(0, 2.5, (256, 2))  # pixels near each other: their order depends little on other tests
_TESTS = np.stack([_first[:, 0], _second[:, 0], _first[:, 1], _second[:, 1]], axis=1)  # x, x, y, y
_TESTS *= np.tile(np.minimum(1, RADIUS / np.maximum(1e-9, np.hypot(_TESTS[:, :2], _TESTS[:, 2:]))), 2)
_grid = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1].reshape(2, -1)
_DISC = _grid[:, (_grid**2).sum(axis=0) <= RADIUS**2]


def to_pgm(pixels: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (pixels.shape[1], pixels.shape[0]) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def from_pgm(raw: bytes | None) -> np.ndarray | None:
    head = re.match(rb"P5\s+(\d+)\s+(\d+)\s+255\s", raw or b"")
    if not head:
        return None
    w, h = int(head[1]), int(head[2])
    body = np.frombuffer(raw, np.uint8, offset=head.end())
    return body[: w * h].reshape(h, w) if len(body) >= w * h > 0 else None


def _boxed(x: np.ndarray, r: int) -> np.ndarray:
    """Means over (2r + 1)-wide squares; edges repeat."""
    k = 2 * r + 1
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (r + 1, r)
        s = np.cumsum(np.pad(x, pad, mode="edge"), axis=axis)
        x = (s[k:] - s[:-k]) if axis == 0 else (s[:, k:] - s[:, :-k])
    return x / (k * k)


def _scaled(x: np.ndarray, factor: float) -> np.ndarray:
    """Bilinear reduction of the smoothed picture."""
    if factor == 1:
        return x
    h, w = (max(1, int(n * factor)) for n in x.shape)
    y, z = (np.arange(h) + 0.5) / factor - 0.5, (np.arange(w) + 0.5) / factor - 0.5
    y0, z0 = np.clip(y.astype(int), 0, x.shape[0] - 2), np.clip(z.astype(int), 0, x.shape[1] - 2)
    fy, fz = (y - y0)[:, None], (z - z0)[None, :]
    a, b, c, d = x[np.ix_(y0, z0)], x[np.ix_(y0, z0 + 1)], x[np.ix_(y0 + 1, z0)], x[np.ix_(y0 + 1, z0 + 1)]
    return a * (1 - fy) * (1 - fz) + b * (1 - fy) * fz + c * fy * (1 - fz) + d * fy * fz


def describe(pixels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(points, bits): x, y, direction and scale of each corner, and its descriptor as four 64-bit words."""
    points, words = [], []
    smooth = _boxed(pixels.astype(np.float64), 1)
    for factor, most in LEVELS:
        x = _scaled(_boxed(smooth, 1) if factor < 1 else smooth, factor) if min(pixels.shape) > 4 else smooth
        if min(x.shape) < 2 * RADIUS + 6:
            continue
        gy, gx = np.gradient(x)
        a, b, c = _boxed(gx * gx, 2), _boxed(gx * gy, 2), _boxed(gy * gy, 2)
        strength = a * c - b * b - 0.05 * (a + c) ** 2
        m = RADIUS + 2
        inner = strength[m:-m, m:-m]
        top = np.max([strength[m + dy : x.shape[0] - m + dy, m + dx : x.shape[1] - m + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)
        peak = np.flatnonzero((inner == top) & (inner > 25.0))
        if not len(peak):
            continue
        cells = [1 if n <= ONE_CELL else -(-n // CELL) for n in pixels.shape]
        cell = peak // inner.shape[1] * cells[0] // inner.shape[0] * cells[1] + peak % inner.shape[1] * cells[1] // inner.shape[1]
        order = np.lexsort((-inner.ravel()[peak], cell))
        peak, cell = peak[order], cell[order]
        peak = peak[np.arange(len(peak)) - np.searchsorted(cell, cell) < most]
        py, px = peak // inner.shape[1] + m, peak % inner.shape[1] + m
        disc = x[py[:, None] + _DISC[0], px[:, None] + _DISC[1]]
        turn = np.arctan2((disc * _DISC[0]).sum(axis=1), (disc * _DISC[1]).sum(axis=1))
        cos, sin = np.cos(turn)[:, None], np.sin(turn)[:, None]

        def at(dx, dy, x=x, px=px, py=py, cos=cos, sin=sin):
            return x[np.rint(py[:, None] + sin * dx + cos * dy).astype(int), np.rint(px[:, None] + cos * dx - sin * dy).astype(int)]

        bits = np.packbits(at(_TESTS[:, 0], _TESTS[:, 2]) < at(_TESTS[:, 1], _TESTS[:, 3]), axis=1, bitorder="little")
        points.append(np.stack([(px + 0.5) / factor, (py + 0.5) / factor, turn, np.full(len(px), 1 / factor)], axis=1))
        words.append(bits.view(np.uint64))
    if not points:
        return np.zeros((0, 4)), np.zeros((0, 4), np.uint64)
    return np.concatenate(points), np.concatenate(words)


def agreeing(pa_, da, pb, db, reach: float = 4.0) -> int:
    """Corners of two pictures that one shift, turn and scaling brings together."""
    if not len(da) or not len(db):
        return 0
    i, j, near = np.arange(len(da)), np.zeros(len(da), np.int64), np.zeros(len(da), np.int64)
    back, least = np.zeros(len(db), np.int64), np.full(len(db), 257)
    for k in range(0, len(da), ROWS):
        far = np.zeros((len(da[k : k + ROWS]), len(db)), np.int64)
        for word in range(PARTS):
            far += np.bitwise_count(da[k : k + ROWS, None, word] ^ db[None, :, word])
        j[k : k + ROWS], near[k : k + ROWS] = far.argmin(axis=1), far.min(axis=1)
        closer = far.min(axis=0) < least
        back[closer], least[closer] = far.argmin(axis=0)[closer] + k, far.min(axis=0)[closer]
    good = (near <= NEAR) & (back[j] == i)
    i, j = i[good], j[good]
    if len(i) < 2:
        return len(i)
    p, q = pa_[i], pb[j]
    scale, turn = q[:, 3] / p[:, 3], q[:, 2] - p[:, 2]
    z, w = p[:, 0] + 1j * p[:, 1], q[:, 0] + 1j * q[:, 1]
    move = scale * np.exp(1j * turn)
    most = 0
    for k in range(0, len(i), ROWS):
        own = slice(k, k + ROWS)
        miss = np.abs(move[own, None] * (z[None] - z[own, None]) + w[own, None] - w[None])
        most = max(most, int((miss <= reach).sum(axis=1).max()))
    return most


def described(media: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """(id, cls, n, points, bits): every picture's pixel class and packed corners; cls is null without a picture."""

    def run(batches):
        import hashlib

        for batch in batches:
            cls, n, points, bits = [], [], [], []
            for raw in batch.column(1):
                picture = from_pgm(raw.as_py())
                if picture is None:
                    p, d = np.zeros((0, 4)), np.zeros((0, 4), np.uint64)
                    cls.append(None)
                else:
                    p, d = describe(picture)
                    cls.append(int.from_bytes(hashlib.sha256(b"%d " % picture.shape[1] + picture.tobytes()).digest()[:8], "little", signed=True))
                n.append(len(p))
                points.append(p.astype(np.float32).tobytes())
                bits.append(d.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cls, pa.int64()), pa.array(n, pa.int32()), pa.array(points, pa.binary()), pa.array(bits, pa.binary())],
                ["id", "cls", "n", "points", "bits"],
            )

    rows = media.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).alias("media")).where("id is not null")
    return rows.mapInArrow(run, "id long, cls long, n int, points binary, bits binary")


def _tables(classes: DataFrame, buckets: int, limit: int) -> DataFrame:
    """Keys (part, its 64 bits) with their classes, as one packed block for each batch and range of keys."""

    def run(batches):
        for batch in batches:
            n = batch.column("n").to_numpy()
            parts = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64)
            key = mixed(parts ^ mixed(np.tile(np.arange(1, PARTS + 1, dtype=np.uint64), len(parts) // PARTS)))
            cls = np.repeat(batch.column("cls").to_numpy(), n * PARTS)
            yield key_blocks(key, cls, np.ones(len(key)), buckets, limit)

    return classes.select("cls", "n", "bits").mapInArrow(run, BLOCKS)


def _corners(points, bits) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(points.as_buffer(), np.float32).reshape(-1, 4).astype(np.float64), np.frombuffer(bits.as_buffer(), np.uint64).reshape(-1, 4)


def _linked(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of classes whose corners agree."""
    left = classes.select(F.col("cls").alias("a"), F.col("points").alias("pa"), F.col("bits").alias("da"))
    right = classes.select(F.col("cls").alias("b"), F.col("points").alias("pb"), F.col("bits").alias("db"))

    def run(batches):
        for batch in batches:
            sides = zip(*(batch.column(c) for c in ("pa", "da", "pb", "db")), strict=True)
            same = [agreeing(*_corners(p, d), *_corners(q, e)) >= least for p, d, q, e in sides]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(same, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "pa", "da", "pb", "db").mapInArrow(run, "a long, b long")


def _forests(members: DataFrame, least: int) -> DataFrame:
    """(a, b): links that join components, a spanning forest from each pair of blocks of a key's members."""

    def run(table: pa.Table) -> pa.Table:
        table, group, c = in_order(table, "key")
        corners = [_corners(p, d) for p, d in zip(table.column("points").combine_chunks(), table.column("bits").combine_chunks(), strict=True)]
        held = np.concatenate([d for _, d in corners])
        cuts = np.concatenate([[0], np.cumsum([len(d) for _, d in corners])])
        root, found = c["root"].copy(), []
        for i in range(len(root)):
            end = np.searchsorted(group, group[i], side="right")
            j = np.arange(i + 1, end)
            j = j[(root[j] != root[i]) & apart(c, np.full(len(j), i), j)]
            if not len(j):
                continue
            mine, first = corners[i][1], cuts[i + 1]
            far = sum(np.bitwise_count(mine[:, None, w] ^ held[None, first : cuts[end], w]).astype(np.int16) for w in range(PARTS))
            near = np.add.reduceat(far <= NEAR, cuts[i + 1 : end] - first, axis=1) > 0
            for k in j[near.sum(axis=0)[j - i - 1] >= least]:  # fewer corners than ``least`` near each other cannot agree
                p, q = (i, k) if c["node"][i] < c["node"][k] else (k, i)
                if root[i] != root[k] and agreeing(*corners[p], *corners[q]) >= least:
                    found.append((c["node"][p], c["node"][q]))
                    root[root == root[k]] = root[i]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return dealt(members, "key", ["root", "points", "bits"]).groupBy("bucket").applyInArrow(run, "a long, b long")


def edited_copies(media: DataFrame, *, id_col: str = "media_id", media_col: str = "media", least: int = 4, group_limit: int = 8) -> DataFrame:
    """(id, n_corners, class_id, component_id) for every id.

    class_id: the smallest id with the same pixels; component_id: the smallest id reachable by links; both the id itself
    without a picture. ``group_limit`` changes no result.
    """
    found = stored(described(media, id_col, media_col), "corners")
    by_class = found.where("cls is not null").groupBy("cls")
    classes = stored(by_class.agg(F.min("id").alias("class_id"), F.first("n").alias("n"), F.first("points").alias("points"), F.first("bits").alias("bits")), "pictures")
    blocks = _tables(classes.where("n > 0"), 4 * partitions(media.sparkSession), group_limit)
    joined = stored(candidates(blocks, 0.75, group_limit), "candidates")
    members = stored(joined.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node")).distinct(), "members")
    star = members.join(members.groupBy("key").agg(F.min("node").alias("a")), "key").where("a <> node").select("a", F.col("node").alias("b"))
    links = stored(_linked(joined.where("kind = 0").select("a", "b").union(star).distinct(), classes, least), "links")
    roots = components(links)

    labelled = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    split = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    rest = labelled.join(split.select("key"), "key").join(classes.select(F.col("cls").alias("node"), F.col("n").cast("long").alias("n"), "points", "bits"), "node")
    late = stored(_forests(rest, least), "links")
    if not late.isEmpty():
        roots = components(links.union(late))

    rooted = classes.select("cls", "class_id").join(roots, F.col("cls") == F.col("node"), "left").select("cls", "class_id", F.coalesce("root", "cls").alias("root"))
    rooted = stored(rooted, "classes")
    named = rooted.join(rooted.groupBy("root").agg(F.min("class_id").alias("component_id")), "root").select("cls", "class_id", "component_id")
    rows = found.groupBy("id").agg(F.min(F.struct("cls", "n")).alias("p")).select("id", "p.cls", "p.n")
    return rows.join(named, "cls", "left").select(
        "id", F.col("n").alias("n_corners"), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("component_id", "id").alias("component_id")
    )


def picture(vector: np.ndarray, size: int = 96) -> np.ndarray:
    """A grainy picture of overlapping rectangles that a vector decides; equal vectors give equal pictures."""
    rng = np.random.default_rng(np.frombuffer(vector.astype(np.float32).tobytes(), np.uint32))
    x = np.zeros((size, size))
    places = rng.integers(0, size - 12, (24, 2))
    sizes, greys = rng.integers(8, 30, (24, 2)), rng.uniform(-60, 60, 24)
    for (a, b), (h, w), g in zip(places, sizes, greys, strict=True):
        x[a : a + h, b : b + w] += g
    grain = _boxed(rng.normal(0, 90, (size, size)), 1)
    return np.clip(128 + x + grain, 0, 255).astype(np.uint8)


def edited(x: np.ndarray, kind: int) -> np.ndarray:
    """One of four edits: a crop, another brightness with noise, a quarter turn, or a bar laid over the lower edge."""
    if kind == 0:
        return x[9:87, 5:85]
    if kind == 1:
        noise = np.random.default_rng(int(x[0, 0]) + 1).integers(-3, 4, x.shape)
        return np.clip(x * 0.8 + 20 + noise, 0, 255).astype(np.uint8)
    if kind == 2:
        return np.rot90(x)
    out = x.copy()
    out[80:] = 255
    return out


def rendered(embeddings: DataFrame) -> DataFrame:
    """(media_id, media): a picture for every vector, id 2 * vec_id, and for each eighth an edited copy with the next id.

    The tables hold no pictures; these are drawn from the vectors. A null vector has null media.
    """

    def run(batches):
        for batch in batches:
            ids, media = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = None if v.values is None else picture(np.nan_to_num(v.values.to_numpy(zero_copy_only=False)))
                ids.append(2 * i)
                media.append(None if x is None else to_pgm(x))
                if i % 8 == 0 and x is not None:
                    ids.append(2 * i + 1)
                    media.append(to_pgm(edited(x, i // 8 % 4)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(media, pa.binary())], ["media_id", "media"])

    return embeddings.select(F.col("vec_id").cast("long"), "embedding").where("vec_id is not null").mapInArrow(run, "media_id long, media binary")
