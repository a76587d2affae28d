"""SentencePiece encoding and decoding by a Viterbi search that words share along their common prefixes.

A text gets a leading space, spaces are word marks, and it falls into marked words (a run of spaces and what follows
it; line breaks by themselves, as no piece holds one). No piece crosses from one word into the next, so the best
segmentation of a text is that of its words. The distinct words of a block of texts are sorted, which lays their trie
out depth first: each word takes over the forward scores and the open pieces of the prefix that it shares with the
word before it and goes on from there. Among segmentations of equal score the one with the longer last piece wins.

Pieces and scores come from a SentencePiece model file. A unigram model's scores are log probabilities and are used as
they are. A byte-pair model's are merge ranks, which cannot be added up: its piece of rank r gets the logarithm of
1 / (r + ZIPF), the law that frequencies by rank follow, so that a few frequent pieces beat many short ones. Ids are
then those of the best segmentation under these scores, not those that the model's merges give. A character that no piece holds is given by its bytes at the
score of the unknown piece, ten below the least; a literal word mark (U+2581) too, so that decoding gives every text
back exactly. Null text gives null, an empty text no pieces. Repeated rows encode alike, extra columns go through
untouched, one named like the result as ``name_before``, and an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from annolake.llm.common import slices, text_buffers

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
ZIPF = 100.0
BLOCK = 1 << 19  # bytes of text whose words are sorted together
KNOWN = 1 << 16  # words whose ids are kept from block to block
_WORDS = re.compile(r" *[^ \n]+| +|\n+")


@dataclass(frozen=True)
class Vocabulary:
    """pieces: (text with spaces for word marks, score, id) of ordinary pieces; byte_ids: id of each of 256 bytes."""

    pieces: tuple[tuple[str, float, int], ...]
    byte_ids: tuple[int, ...]
    unknown_score: float

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, at_byte = [], {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                at_byte[int(piece[3:5], 16)] = i
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                pieces.append((piece.replace(MARK, " "), model.get_score(i), i))
        if all(s <= 0 and s == int(s) for _, s, _ in pieces):  # merge ranks
            pieces = [(p, -math.log(ZIPF - s), i) for p, s, i in pieces]
        return Vocabulary(tuple(pieces), tuple(at_byte[b] for b in range(256)), min(s for _, s, _ in pieces) - 10.0)

    def trie(self) -> dict:
        """Nested dicts by character; under "" of a node stand score and id of the piece that ends there."""
        root: dict = {}
        for text, score, i in self.pieces:
            node = root
            for c in text:
                node = node.setdefault(c, {})
            node[""] = (score, i)
        return root


def segmented(words: list[str], vocabulary: Vocabulary, root: dict) -> Iterator[tuple[str, list[int]]]:
    """(word, ids) for sorted distinct words."""
    best, back, opened = [0.0], [(0, 0)], [()]  # by depth: forward score, (start, id) of the last piece, pieces not yet ended
    unknown, previous = vocabulary.unknown_score, ""
    for word in words:
        depth, most = 0, min(len(word), len(previous))
        while depth < most and word[depth] == previous[depth]:
            depth += 1
        del best[depth + 1 :], back[depth + 1 :], opened[depth + 1 :]
        for at in range(depth, len(word)):
            c, top, last, going = word[at], None, None, []
            for start, node in (*opened[at], (at, root)):
                node = node.get(c)
                if node is not None:
                    going.append((start, node))
                    piece = node.get("")
                    if piece is not None:
                        score = best[start] + piece[0]
                        if top is None or score > top:
                            top, last = score, (start, piece[1])
            own = root.get(c)
            if own is None or "" not in own:
                score = best[at] + unknown
                if top is None or score > top:
                    top, last = score, (at, -1)
            best.append(top)
            back.append(last)
            opened.append(going)
        ids, end = [], len(word)
        while end:
            start, i = back[end]
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(vocabulary.byte_ids[b] for b in reversed(word[start:end].encode()))
            end = start
        ids.reverse()
        yield word, ids
        previous = word


def encoded_block(texts: list[str | None], vocabulary: Vocabulary, root: dict, known: dict[str, list[int]]) -> list[np.ndarray | None]:
    """Ids of each text; ``known`` has ids of words of earlier blocks and takes those of this one, as long as they are few."""
    split = [None if t is None else _WORDS.findall(f" {t}") if t else [] for t in texts]
    distinct = {w for words in split if words for w in words}
    if len(known) > KNOWN:
        known.clear()
    known.update(segmented(sorted(distinct.difference(known)), vocabulary, root))
    out = []
    for words in split:
        if words is None:
            out.append(None)
            continue
        flat: list[int] = []
        for w in words:
            flat += known[w]
        out.append(np.array(flat, np.int32))
    return out


def encoded_batch(texts: pa.Array, vocabulary: Vocabulary, root: dict) -> Iterator[pa.Array]:
    """Ids of the texts, block by block: what a worker holds does not grow with the batch."""
    known: dict[str, list[int]] = {}
    _, offsets = text_buffers(texts)
    for a, b in slices(offsets, BLOCK):
        yield pa.array(encoded_block(texts.slice(a, b - a).to_pylist(), vocabulary, root, known), pa.list_(pa.int32()))


def _renamed(df: DataFrame, taken: str) -> DataFrame:
    """``df``, its own column of the name ``taken`` under a free one: ``taken_before``."""
    names = list(df.columns)
    if taken in names:
        free = f"{taken}_before"
        while free in names:
            free += "_before"
        names[names.index(taken)] = free
    return df.toDF(*names)


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with plain names, as mapInArrow takes no names with dots."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def encode(docs: DataFrame, *, text_col: str = "text", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``docs`` with ``ids_col``, the piece ids of each whole text."""
    vocabulary = Vocabulary.load(model)
    docs = _renamed(docs, ids_col)
    kept, at = docs.columns, docs.columns.index(text_col)

    def run(batches):
        root = vocabulary.trie()
        for batch in batches:
            a = 0
            for ids in encoded_batch(batch.column(at), vocabulary, root):
                yield pa.RecordBatch.from_arrays([*(c.slice(a, len(ids)) for c in batch.columns), ids], [*kept, ids_col])
                a += len(ids)

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    return _numbered(docs).mapInArrow(run, schema)


def decode(encoded: DataFrame, *, ids_col: str = "ids", text_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """``encoded`` with ``text_col``, the text that its ids stand for."""
    vocabulary = Vocabulary.load(model)
    encoded = _renamed(encoded, text_col)
    kept, at = encoded.columns, encoded.columns.index(ids_col)

    def run(batches):
        size = 1 + max(*(i for _, _, i in vocabulary.pieces), *vocabulary.byte_ids)
        spelled = [b""] * size
        for text, _, i in vocabulary.pieces:
            spelled[i] = text.encode()
        for b, i in enumerate(vocabulary.byte_ids):
            spelled[i] = bytes([b])
        for batch in batches:
            ids = batch.column(at)
            texts = []
            for k in range(batch.num_rows):
                row = ids[k].values
                texts.append(None if row is None else b"".join([spelled[i] for i in row.to_numpy()])[1:].decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*kept, text_col])

    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField(text_col, T.StringType())])
    return _numbered(encoded).mapInArrow(run, schema)
