"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The pieces and their log scores come from a SentencePiece model file; nothing is trained. A
text gets a leading space, spaces become the marker, and the segmentation with the largest sum
of scores wins. A character that no piece covers costs the worst score less 10 and is written
as its UTF-8 bytes. Decoding is the exact inverse for every text.

No piece holds a marker after another character, so the best segmentation of a text is the best
one of each of its words; that is checked when the model is read. Equal words of a chunk are
segmented once, all of them side by side in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.llm.arrays import ranges_hash, text_chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0
CHUNK = 1 << 18
SIDE_BY_SIDE = 96  # words up to this many bytes are segmented together, longer ones by themselves
ENCODED = "doc_id long, ids array<int>, n_pieces int, n_bytes int, round_trip boolean"


class DoubleArray:
    """``check[base[s] + byte] == s`` when state s has a child by that byte; value: piece or -1."""

    def __init__(self, keys: dict[bytes, int]) -> None:
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys.items():
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({}), values.append(-1)
                node = children[node][byte]
            values[node] = value
        size = 2 * len(children) + 512
        base, check, self_values = [0] * size, [-1] * size, [-1] * size
        check[0] = size  # the root's own cell is taken
        place, free = {0: 0}, 1
        for node in range(len(children)):
            if not children[node]:
                continue
            labels = sorted(children[node])
            start, tries = max(1, free - labels[0]), 0
            while any(check[start + c] >= 0 for c in labels):
                start += 1
                tries += 1
            if tries > 64:  # the cells below are nearly all taken
                free = start
            state = place[node]
            base[state] = start
            for c in labels:
                check[start + c] = state
                self_values[start + c] = values[children[node][c]]
                place[children[node][c]] = start + c
            if start + 1024 > size:
                base += [0] * size
                check += [-1] * size
                self_values += [-1] * size
                size *= 2
        self.base = np.array(base, np.int32)
        self.check = np.array(check, np.int32)
        self.value = np.array(self_values, np.int32)

    def matches(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Every (start, length, value) of a key that begins at a start and ends by its end."""
        at, state = starts, np.zeros(len(starts), np.int32)
        last, depth, out = ends, 0, []
        while len(at):
            inside = at + depth < last
            at, state, last = at[inside], state[inside], last[inside]
            step = self.base[state] + text[at + depth]
            known = self.check[step] == state
            at, state, last = at[known], step[known], last[known]
            depth += 1
            found = self.value[state]
            hit = found >= 0
            out.append((at[hit], np.full(int(hit.sum()), depth, np.int32), found[hit]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        return tuple(np.concatenate(part) for part in zip(*out))


@dataclass
class Vocabulary:
    trie: DoubleArray
    score: np.ndarray       # by id
    unknown: float          # score of a character without piece
    byte_id: np.ndarray     # id of each byte, -1 if the model has none
    content: np.ndarray     # bytes of all pieces, the marker as a space
    bounds: np.ndarray      # of piece i: bounds[i]:bounds[i + 1]


def load(path: str = MODEL) -> Vocabulary:
    """Read a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    byte_id, keys, content = np.full(256, -1, np.int32), {}, []
    score = np.array([model.get_score(i) for i in range(n)])
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_id[int(piece[3:5], 16)] = i
            content.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            content.append(b"")
        else:
            if MARKER in piece.lstrip(MARKER):
                raise ValueError(f"piece {i} has a marker inside a word")
            content.append(piece.replace(MARKER, " ").encode())
            keys[content[-1]] = i
    if (byte_id < 0).any():
        raise ValueError("the model has no byte fallback")
    worst = score[list(keys.values())].min() if keys else 0.0
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in content])])
    return Vocabulary(DoubleArray(keys), score, worst - UNKNOWN_PENALTY, byte_id,
                      np.frombuffer(b"".join(content), np.uint8), bounds)


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for each start, one run after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _segment(vocabulary: Vocabulary, text: np.ndarray, bounds: np.ndarray):
    """Best pieces of many words. Returns ids and the number of ids of each word.

    Word i is ``text[bounds[i]:bounds[i + 1]]``. Of equal sums the longer last piece wins.
    """
    begin, end = bounds[:-1], bounds[1:]
    word_of = np.repeat(np.arange(len(begin)), end - begin)
    lead = (text & 0xC0) != 0x80  # first byte of a character
    lead[begin] = True
    starts = np.flatnonzero(lead)
    at, length, piece = vocabulary.trie.matches(text, starts, end[word_of[starts]])
    gain = vocabulary.score[piece]
    # characters that are no piece of their own
    char_end = np.minimum(np.append(starts[1:], len(text)), end[word_of[starts]])
    single = np.zeros(len(text), bool)
    whole = np.zeros(len(text) + 1, np.int64)
    whole[starts] = char_end - starts
    single[at[length == whole[at]]] = True
    alone = ~single[starts]
    at = np.concatenate([at, starts[alone]])
    length = np.concatenate([length, (char_end - starts)[alone].astype(np.int32)])
    piece = np.concatenate([piece, np.full(int(alone.sum()), -1, np.int32)])
    gain = np.concatenate([gain, np.full(int(alone.sum()), vocabulary.unknown)])
    # node of a word's byte position; a word has one node more than bytes
    start_node = at + word_of[at]
    stop_node = start_node + length
    size = len(text) + len(begin)
    best = np.full(size, -np.inf)
    first_node = begin + np.arange(len(begin))
    best[first_node] = 0.0
    came_by = np.full(size, -1, np.int64)
    depth = at - begin[word_of[at]]
    order = np.lexsort((start_node, depth))
    together = (end - begin)[word_of[at[order]]] <= SIDE_BY_SIDE
    near = order[together]
    cuts = np.searchsorted(depth[near], np.arange(SIDE_BY_SIDE + 1))
    for i in range(SIDE_BY_SIDE):  # all links that leave at byte i of their word
        link = near[cuts[i]:cuts[i + 1]]
        if not len(link):
            continue
        total = best[start_node[link]] + gain[link]
        better = total > best[stop_node[link]]
        link, total = link[better], total[better]
        best[stop_node[link]] = total
        came_by[stop_node[link]] = link
    far = order[~together]
    far = far[np.argsort(start_node[far], kind="stable")]
    for link, a, b, g in zip(far.tolist(), start_node[far].tolist(), stop_node[far].tolist(),
                             gain[far].tolist()):
        total = best[a] + g
        if total > best[b]:
            best[b] = total
            came_by[b] = link
    used = np.full(size, -1, np.int64)
    node = (end + np.arange(len(begin)))[end > begin]
    while len(node):
        link = came_by[node]
        used[node] = link
        node = start_node[link]
        node = node[came_by[node] >= 0]
    stops = np.flatnonzero(used >= 0)
    links = used[stops]
    ids = piece[links]
    counts = np.where(ids >= 0, 1, length[links]).astype(np.int64)
    out = np.repeat(ids, counts)
    raw = out < 0
    bytes_at = _gather(at[links], counts)
    out[raw] = vocabulary.byte_id[text[bytes_at[raw]]]
    per_word = np.bincount(word_of[at[links]], weights=counts, minlength=len(begin))
    return out, per_word.astype(np.int64)


def encode_texts(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray):
    """Ids of several texts (UTF-8 in ``data``) and the bounds of each text in them."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    full = lengths > 0
    # a space before each text that is not empty
    text = np.empty(len(data) + int(full.sum()), np.uint8)
    shift = np.concatenate([[0], np.cumsum(full)])
    begins = offsets[:-1] + shift[:-1]
    heads = begins[full]
    text[heads] = 0x20
    body = np.ones(len(text), bool)
    body[heads] = False
    text[body] = data
    if not len(text):
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    opens = text == 0x20
    opens[1:] &= text[:-1] != 0x20
    opens[heads] = True
    start = np.flatnonzero(opens)
    end = np.append(start[1:], len(text))
    _, first, which = np.unique(ranges_hash(text.astype(np.uint64) + np.uint64(1), start, end),
                                return_index=True, return_inverse=True)
    size = (end - start)[first]
    words = text[_gather(start[first], size)]
    ids, counts = _segment(vocabulary, words, np.concatenate([[0], np.cumsum(size)]))
    where = np.concatenate([[0], np.cumsum(counts)])[:-1]
    out = ids[_gather(where[which], counts[which])]
    total = np.concatenate([[0], np.cumsum(counts[which])])
    bounds = total[np.searchsorted(start, np.append(begins, len(text)))]
    return out, bounds


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray):
    """UTF-8 bytes of several id lists and their offsets; the first space of each goes."""
    size = np.diff(vocabulary.bounds)[ids]
    data = vocabulary.content[_gather(vocabulary.bounds[ids], size)]
    total = np.concatenate([[0], np.cumsum(size)])
    offsets = total[bounds]
    full = np.diff(offsets) > 0
    heads = offsets[:-1][full]
    heads = heads[data[heads] == 0x20]
    keep = np.ones(len(data), bool)
    keep[heads] = False
    gone = np.concatenate([[0], np.cumsum(~keep)])
    return data[keep], offsets - gone[offsets]


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, ids, n_pieces, n_bytes, round_trip), one row per row of ``docs``.

    ``n_bytes`` counts the pieces that stand for single bytes; ``round_trip`` tells whether
    decoding gives the very text back. Null and empty texts have no ids. Repeated rows give
    repeated results; ids may be null; other columns are ignored.
    """
    vocabulary = load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_byte = np.zeros(len(vocabulary.score), bool)
        is_byte[vocabulary.byte_id] = True
        for batch in batches:
            for chunk in text_chunks(batch.column(1), CHUNK):
                ids, bounds = encode_texts(vocabulary, chunk.data, chunk.offsets)
                back, where = decode_ids(vocabulary, ids, bounds)
                same = np.diff(where) == np.diff(chunk.offsets)
                if same.all():
                    wrong = np.concatenate([[0], np.cumsum(back != chunk.data)])
                    same = np.diff(wrong[chunk.offsets]) == 0
                else:  # compare text by text
                    same = np.array([bytes(back[where[i]:where[i + 1]]) == bytes(
                        chunk.data[chunk.offsets[i]:chunk.offsets[i + 1]])
                        for i in range(chunk.count)])
                raw = np.concatenate([[0], np.cumsum(is_byte[ids])])
                yield pa.record_batch([
                    batch.column(0).slice(chunk.first, chunk.count),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                    pa.array(np.diff(bounds).astype(np.int32)),
                    pa.array(np.diff(raw[bounds]).astype(np.int32)), pa.array(same)],
                    names=["doc_id", "ids", "n_pieces", "n_bytes", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, text) of ``encoded(doc_id, ids)``; no ids or null give an empty text.

    Ids outside the vocabulary are an error of the caller and fail the task. Byte sequences
    that are no UTF-8 become U+FFFD.
    """
    vocabulary = load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.array([0 if x is None else x for x in
                              pa.compute.list_value_length(lists).to_pylist()], np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            ids = np.asarray(lists.drop_null().flatten() if lists.null_count
                             else lists.flatten(), dtype=np.int32)
            data, where = decode_ids(vocabulary, ids, bounds)
            texts = [bytes(data[a:b]).decode("utf-8", "replace")
                     for a, b in zip(where[:-1], where[1:])]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())],
                                  names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids") \
        .mapInArrow(run, "doc_id long, text string")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
