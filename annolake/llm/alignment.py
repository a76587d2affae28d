"""Alignment of two tokenizers' tokens by the byte offsets where tokens end.

Workers tokenise a block of texts, for a blank and the text (one tokenizer is given the blank, the other adds it), and
lay the ends of all its tokens on one line, text after text. Ends that both sides share cut the tokens into groups, by
one search of sorted arrays for the whole block. A text goes on with its distinct pairs of linked ids and how often it
links each, two ids packed into a long: a group is expanded into its links only where these are few, else its distinct
ids are paired. Counting over the corpus is grouping and joining by pair.

``tokens`` keeps every row, whole texts, repeated rows one by one, null ids as they are. A text that is null or empty,
or that the tokens of either side do not spell byte by byte after a blank, has no tokens: empty arrays, no group, no
link. Strings of control tokens are plain text. Extra columns are ignored, whatever their names. Empty tables: no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.llm.common import slices, stored, text_buffers

BYTE_MODEL, PIECE_MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
BLOCK = 1 << 20  # bytes of text whose tokens go on in one batch
FEW_PAIRS = 500_000  # up to so many id pairs are broadcast with their counts, about 30 MB
SALTS = 16
EXPANDED = 1 << 12  # links of a group that are made one by one
# fixed value: the pattern by which byte-level models of this kind split text
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

Encoder = Callable[[list[str]], Iterator[np.ndarray]]


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if it prints, else 256, 257 and so on."""
    prints = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(others)}


def byte_level(path: str) -> tuple[Encoder, list[bytes]]:
    """(encoder of texts as they are, bytes of each id) of a byte-level model; no special tokens."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special, at = {t["content"] for t in model["added_tokens"]}, _byte_of()
    vocabulary = {bytes(at[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    spelled = [b""] * (1 + max(model["model"]["vocab"].values()))
    for token, i in vocabulary.items():
        spelled[i] = token
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    if [model["model"]["vocab"].get(a + b) for a, b in merges] == list(range(256, 256 + len(merges))) and model["pre_tokenizer"].get("use_regex", True):
        import tiktoken  # ids in the order of merges: they are ranks

        ranked = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        return (lambda texts: (ranked.encode_to_numpy(t, disallowed_special=()).astype(np.int32) for t in texts)), spelled
    import tokenizers

    whole = tokenizers.Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return (lambda texts: (np.array(e.ids, np.int32) for e in whole.encode_batch(texts, add_special_tokens=False))), spelled


def pieces(path: str) -> tuple[Encoder, list[bytes]]:
    """(encoder that puts a blank before a text, bytes of each id) of a piece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    spelled = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        spelled.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return (lambda texts: (np.array(ids, np.int32) for ids in model.encode(texts, num_threads=1))), spelled


_ints = T.ArrayType(T.IntegerType(), containsNull=False)
COLUMNS = ("a_ids", "a_ends", "b_ids", "b_ends")


@dataclass
class Block:
    """Tokens of consecutive texts, one text's after the other's; text k has ids[first[k]] .. ids[first[k + 1]] of each side."""

    rows: pa.Array
    ids: tuple[np.ndarray, np.ndarray]
    ends: tuple[np.ndarray, np.ndarray]
    first: tuple[np.ndarray, np.ndarray]

    def texts(self, side: int) -> np.ndarray:
        """The text of each token."""
        return np.repeat(np.arange(len(self.rows)), np.diff(self.first[side]))


class Side:
    """One tokenizer: its encoder, the bytes of each id, and their number."""

    def __init__(self, encode: Encoder, spelled: list[bytes]):
        self.encode, self.spelled = encode, pa.array(spelled, pa.binary())
        self.sizes = np.array([len(x) for x in spelled], np.int64)

    def spells(self, ids: list[np.ndarray], wholes: list[bytes]) -> list[bool]:
        """Whether the ids of each text spell it."""
        flat = np.concatenate(ids)
        first = np.r_[0, np.cumsum(self.sizes[flat])][np.r_[0, np.cumsum([len(x) for x in ids])]].tolist()
        raw = self.spelled.take(pa.array(flat)).buffers()[2]
        data = memoryview(raw).cast("B") if raw is not None else b""
        return [data[s:e] == whole for s, e, whole in zip(first[:-1], first[1:], wholes, strict=True)]


def token_blocks(batch: pa.RecordBatch, sides: tuple[Side, Side]) -> Iterator[Block]:
    """Blocks of the texts of a batch (id, text)."""
    none = np.zeros(0, np.int32)
    _, offsets = text_buffers(batch.column(1))
    for first, end in slices(offsets, BLOCK):
        texts = [t or "" for t in batch.column(1).slice(first, end - first).to_pylist()]
        wholes = [f" {t}".encode() for t in texts]
        ids = [list(sides[0].encode([f" {t}" for t in texts])), list(sides[1].encode(texts))]
        alike = [bool(t) and x and y for t, x, y in zip(texts, *(side.spells(own, wholes) for side, own in zip(sides, ids, strict=True)), strict=True)]
        flat, ends, starts = [], [], []
        for side, own in zip(sides, ids, strict=True):
            own = [x if same else none for x, same in zip(own, alike, strict=True)]
            starts.append(np.r_[0, np.cumsum([len(x) for x in own])])
            flat.append(np.concatenate(own).astype(np.int32))
            total = np.r_[0, np.cumsum(side.sizes[flat[-1]])]
            ends.append(total[1:] - np.repeat(total[starts[-1][:-1]], np.diff(starts[-1])))
        yield Block(batch.column(0).slice(first, end - first), tuple(flat), tuple(ends), tuple(starts))


def _sides(byte_model: str, piece_model: str) -> tuple[Side, Side]:
    return Side(*byte_level(byte_model)), Side(*pieces(piece_model))


def tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """(id, a_ids, a_ends, b_ids, b_ends) for every row of ``docs``; ends are byte offsets in a blank and the text."""

    def run(batches):
        sides = _sides(byte_model, piece_model)
        for batch in batches:
            for block in token_blocks(batch, sides):
                lists = [
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x, pa.int32()))
                    for ids, ends, first in zip(block.ids, block.ends, block.first, strict=True)
                    for x in (ids, ends)
                ]
                yield pa.RecordBatch.from_arrays([block.rows, *lists], ["id", *COLUMNS])

    shape = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(c, _ints) for c in COLUMNS)])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, shape)


def cuts(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, end of A, end of B) of the groups in order: places between tokens, so a group begins where that before it ends."""
    (a, b), texts = block.ends, block.texts(0)
    length = np.zeros(len(block.rows), np.int64)
    length[texts] = a  # of each text, its last token's end stays
    base = np.cumsum(length) - length
    a, b = a + base[texts], b + base[block.texts(1)]
    place = np.searchsorted(b, a)
    shared = b[np.minimum(place, len(b) - 1)] == a if len(b) else np.zeros(0, bool)
    return texts[shared], np.flatnonzero(shared) + 1, place[shared] + 1


SIGNS = (",", "|", ";", "")


def groups_text(block: Block, end_a: np.ndarray, end_b: np.ndarray, printed: pa.Array) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of each text: the ids of each group, A's before B's. ``printed``: each id before each of SIGNS."""
    size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    code = np.zeros(len(block.ids[0]) + len(block.ids[1]), np.int64)
    code[np.arange(len(block.ids[0])) + np.repeat(end_b - size_b, size_a)] = block.ids[0].astype(np.int64) * 4
    code[np.arange(len(block.ids[1])) + np.repeat(end_a, size_b)] = block.ids[1].astype(np.int64) * 4
    code[end_a + end_b - size_b - 1] += 1
    code[end_a + end_b - 1] += 2
    first = block.first[0] + block.first[1]
    code[first[1:][np.diff(first) > 0] - 1] += 1  # no sign after the last group
    out = printed.take(pa.array(code))
    at = np.frombuffer(out.buffers()[1], np.int64)[: len(out) + 1][first] if len(out) else np.zeros(len(first), np.int64)
    data = out.buffers()[2] if len(out) else pa.py_buffer(b"")
    return pa.Array.from_buffers(pa.string(), len(block.rows), [None, pa.py_buffer(at.astype(np.int32)), data])


def link_counts(block: Block, text: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, times), by text: the distinct pairs of linked ids of each text, and how often it links them."""
    ids_a, ids_b = (x.astype(np.int64) for x in block.ids)
    size_a, size_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    start_a, start_b, n = end_a - size_a, end_b - size_b, size_a * size_b
    few = np.flatnonzero(n <= EXPANDED)
    g = np.repeat(few, n[few])
    k = np.arange(len(g)) - np.repeat(np.cumsum(n[few]) - n[few], n[few])
    found = [(text[g], packed(ids_a[start_a[g] + k // size_b[g]], ids_b[start_b[g] + k % size_b[g]]), np.ones(len(g), np.int64))]
    for x in np.flatnonzero(n > EXPANDED):
        (a, times_a), (b, times_b) = (np.unique(i[e - s : e], return_counts=True) for i, e, s in ((ids_a, end_a[x], size_a[x]), (ids_b, end_b[x], size_b[x])))
        pairs = packed(a[:, None], b).ravel()
        found.append((np.full(len(pairs), text[x]), pairs, np.outer(times_a, times_b).ravel()))
    text, pair, times = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((pair, text))
    text, pair, times = text[order], pair[order], times[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return text[at], pair[at], np.add.reduceat(times, at) if len(at) else times


def packed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two ids as one long, that of A in the upper half."""
    return a << 32 | b


SIZES = ("n_a", "n_b", "n_groups", "n_links")


def linked(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, pairs, times) for every row of ``docs``: its groups as text, its distinct pairs and their links."""

    def run(batches):
        sides = _sides(byte_model, piece_model)
        printed = pa.array([f"{i}{sign}" for i in range(max(len(x.sizes) for x in sides)) for sign in SIGNS], pa.large_string())
        for batch in batches:
            for block in token_blocks(batch, sides):
                rows = len(block.rows)
                text, end_a, end_b = cuts(block)
                own, pair, times = link_counts(block, text, end_a, end_b)
                n_links = np.zeros(rows, np.int64)
                np.add.at(n_links, own, times)
                first = pa.array(np.searchsorted(own, np.arange(rows + 1)), pa.int32())
                sizes = [*(np.diff(x) for x in block.first), np.bincount(text, minlength=rows), n_links]
                lists = [pa.ListArray.from_arrays(first, pa.array(x)) for x in (pair, times)]
                columns = [block.rows, *(pa.array(x, pa.int64()) for x in sizes), groups_text(block, end_a, end_b, printed), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["id", *SIZES, "groups", "pairs", "times"])

    longs = T.ArrayType(T.LongType(), containsNull=False)
    fields = [*((c, T.LongType()) for c in SIZES), ("groups", T.StringType()), ("pairs", longs), ("times", longs)]
    shape = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(*x) for x in fields)])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, shape)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best) for ``pairs`` of ``rows``: rows that hold the pair, and the highest count of its id of A."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    return counts.select("pair", "count", F.max("count").over(W.partitionBy(F.shiftright("pair", 32))).alias("best"))


def with_counts(rows: DataFrame) -> DataFrame:
    """``rows`` (with a unique column ``row``, ``pairs`` and ``times``) with ``n_best`` and ``count_sum`` in place of these two."""
    counts = stored(pair_counts(rows), "pairs")
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    if counts.count() <= FEW_PAIRS:
        each = each.join(F.broadcast(counts), "pair")
    else:  # a pair of frequent words stands in nearly every row
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        each = each.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(counts.withColumn("salt", salts), ["salt", "pair"])
    best = F.sum(F.when(F.col("count") == F.col("best"), F.col("n")).otherwise(0))
    sums = each.groupBy("row").agg(best.cast("long").alias("n_best"), F.sum(F.col("count") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    out = rows.drop("pairs", "times").join(sums, "row", "left")
    return out.withColumns({"n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)})


def aligned(docs: DataFrame, *, digest: Callable[[Column], Column] = lambda text: text, **options) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) for every row of ``docs``; ``options``: those of ``tokens``.

    groups: ``digest`` of ``groups_text``. n_best: links whose pair is held by no fewer rows than any other pair of its
    id of A. count_sum: over all links, how many rows hold their pair.
    """
    found = linked(docs, **options)
    text = F.when(F.col("n_groups") > 0, digest(F.col("groups"))).otherwise("")
    rows = stored(found.withColumns({"groups": text, "row": F.monotonically_increasing_id()}), "aligned")
    return with_counts(rows).drop("row")
