"""SentencePiece encoding by forward filtering and backward sampling, and decoding.

The pieces of a public model span a lattice over a text; their weights fall with their
rank as ranks of words do. A space is the mark U+2581 in a piece. A character that is no
piece, among them that mark itself, is encoded by its bytes, so every text can be decoded.
Neither a character without a piece nor the border before a run of spaces lies inside a
piece, so the lattice falls apart there, and equal parts share one forward pass.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm import texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Characters after which a word without a border, or a run of spaces, is cut.
LONGEST = 1024
# Parts that share their tables.
PARTS = 300_000
# Code points for bytes of characters without a piece; they occur in no piece.
_BYTE = 0xF0000
_MARK, _END = "▁", "\0"


class Vocabulary(NamedTuple):
    pieces: list[bytes]  # by id; empty for control pieces
    first_byte: int  # id of the piece of byte 0
    normal: dict[str, int]
    log_weight: np.ndarray


def load(model: str = MODEL, alpha: float = 1.0) -> Vocabulary:
    """Reads the model file on the driver. A piece of rank r weighs (r + 2.7) ** -alpha.

    Fails if a piece has a space after another character, for then texts would not fall apart.
    """
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, normal, first_byte, ranks = [], {}, None, []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            first_byte = i if first_byte is None else first_byte
            pieces.append(bytes([i - first_byte]))
        elif processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
            pieces.append(b"")
        else:
            if _MARK in piece.lstrip(_MARK) or _END in piece:
                raise ValueError(f"piece {i} crosses a border of words")
            normal[piece] = i
            pieces.append(piece.replace(_MARK, " ").encode())
        ranks.append(len(normal))
    if first_byte is None:
        raise ValueError("the model has no pieces for bytes")
    weight = -alpha * np.log(np.array(ranks, float) + 2.7)
    return Vocabulary(pieces, first_byte, normal, weight)


class Trie(NamedTuple):
    """Transitions in an open hash table, piece by state (-1: none), and codes of characters."""

    keys: np.ndarray
    targets: np.ndarray
    piece: np.ndarray
    code: np.ndarray
    known: np.ndarray  # by code point: whether the character is a piece
    split: re.Pattern


_TRIES: dict[int, Trie] = {}


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def build_trie(vocabulary: Vocabulary) -> Trie:
    """States are prefixes of pieces. Codes: 0 ends a part, 1 to 256 are bytes, then characters."""
    characters = sorted({c for piece in vocabulary.normal for c in piece})
    code = np.zeros(0x110000, np.int64)
    code[_BYTE : _BYTE + 256] = np.arange(1, 257)
    code[[ord(c) for c in characters]] = np.arange(257, 257 + len(characters))
    code[ord(" ")], code[ord(_MARK)] = code[ord(_MARK)], 0
    width = 257 + len(characters)
    moves: dict[int, int] = {}
    piece = [-1]

    def add(codes: list[int], number: int) -> None:
        state = 0
        for c in codes:
            state = moves.setdefault(state * width + c, len(piece))
            if state == len(piece):
                piece.append(-1)
        piece[state] = number

    for b in range(256):
        add([1 + b], vocabulary.first_byte + b)
    for text, number in vocabulary.normal.items():
        add([int(code[ord(" " if c == _MARK else c)]) for c in text], number)
    size = 1 << (len(moves) * 4).bit_length()
    keys, targets = np.full(size, -1, np.int64), np.zeros(size, np.int32)
    todo, to = np.array(list(moves)), np.array(list(moves.values()), np.int32)
    at = _slots(todo, size)
    while len(todo):  # the first of those that want a free slot gets it
        free = np.flatnonzero(keys[at] == -1)
        slots, first = np.unique(at[free], return_index=True)
        keys[slots], targets[slots] = todo[free[first]], to[free[first]]
        rest = np.ones(len(todo), bool)
        rest[free[first]] = False
        todo, to, at = todo[rest], to[rest], (at[rest] + 1) % size
    single = [" ", *(c for c in characters if c in vocabulary.normal and c not in (" ", _MARK))]
    is_known = np.zeros(len(code), bool)
    is_known[[ord(c) for c in single]] = True
    known = "".join(map(re.escape, single[1:]))
    split = re.compile(f" {{0,{LONGEST}}}[{known}]{{1,{LONGEST}}}| {{1,{LONGEST}}}|.", re.S)
    return Trie(keys, targets, np.array(piece, np.int32), code, is_known, split)


def _step(trie: Trie, width: int, state: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Next states, -1 where there is none."""
    key = state * width + code
    size = len(trie.keys)
    at = _slots(key, size)
    out = np.full(len(key), -1, np.int64)
    left = np.arange(len(key))
    while len(left):
        held = trie.keys[at]
        hit = held == key[left]
        out[left[hit]] = trie.targets[at[hit]]
        more = ~hit & (held != -1)
        left, at = left[more], (at[more] + 1) % size
    return out


class Lattice(NamedTuple):
    end: np.ndarray  # by part: its last node
    start: np.ndarray  # by node: the first of its edges
    up_to: np.ndarray  # by edge: cumulative probability in its node, the last one 2
    piece: np.ndarray
    before: np.ndarray  # node in which the edge begins


def forward(parts: list[str], trie: Trie, log_weight: np.ndarray) -> Lattice:
    """All pieces in all parts, and for each node the probabilities of the piece that ends there."""
    stream = trie.code[np.frombuffer((_END.join(parts) + _END).encode("utf-32-le"), np.uint32)]
    width = int(trie.code.max()) + 1
    n = len(stream)
    ends = np.flatnonzero(stream == 0)
    begins = np.r_[0, ends[:-1] + 1]
    at = np.flatnonzero(stream).astype(np.int32)
    state = np.zeros(len(at), np.int64)
    heads, tails, numbers = [], [], []
    length = 0
    while len(at):  # one character further in all pieces that go on
        code = stream[at + length]
        going = code > 0
        at, code, state = at[going], code[going], state[going]
        state = _step(trie, width, state, code)
        alive = state >= 0
        at, state = at[alive], state[alive]
        length += 1
        number = trie.piece[state]
        whole = number >= 0
        heads.append(at[whole])
        tails.append(at[whole] + length)
        numbers.append(number[whole])
    # Edges by the node they end in, long pieces first: they are likely, so few are compared.
    head, tail, number = (np.concatenate(x[::-1]) for x in (heads, tails, numbers))
    order = np.argsort(tail, kind="stable")
    head, tail, number = head[order], tail[order], number[order]
    start = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(tail, minlength=n), out=start[1:])
    # Then layer by layer, by the distance of a node from the begin of its part.
    sizes = ends - begins
    depth = (np.arange(n) - np.repeat(begins, sizes + 1)).astype(np.int16)[tail]
    layered = np.argsort(depth, kind="stable")
    layer = np.r_[0, np.cumsum(np.bincount(depth))]
    weight = log_weight[number]
    total = np.full(n, -np.inf)
    total[begins] = 0.0
    share = np.zeros(len(head))
    for a, b in zip(layer[:-1], layer[1:], strict=True):
        if a == b:
            continue
        edge = layered[a:b]
        value = total[head[edge]] + weight[edge]
        node = tail[edge]
        first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        count = np.diff(np.r_[first, b - a])
        most = np.maximum.reduceat(value, first)
        value = np.exp(value - np.repeat(most, count))
        sums = np.add.reduceat(value, first)
        share[edge] = value / np.repeat(sums, count)
        total[node[first]] = most + np.log(sums)
    sums = np.r_[0.0, np.cumsum(share)]
    up_to = sums[1:] - sums[start[tail]]
    up_to[start[tail + 1] - 1] = 2.0
    return Lattice(ends, start, up_to, number, head)


def _uniform(key: np.ndarray, step: int) -> np.ndarray:
    """In [0, 1), from the key of a part and the number of the draw in it."""
    z = key + np.uint64(0x9E3779B97F4A7C15 * (step + 1) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)


def backward(lattice: Lattice, part: np.ndarray, key: np.ndarray, draw: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all parts in a row, and how many each part has; from its end, piece by piece.

    `draw` off takes the likeliest piece that ends in each node instead.
    """
    node = lattice.end[part]
    alive = np.flatnonzero(lattice.start[node + 1] > lattice.start[node])
    node = node[alive]
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while len(alive):
        edge = lattice.start[node].copy()
        if draw:
            u = _uniform(key[alive], len(steps))
            left = np.flatnonzero(u >= lattice.up_to[edge])
            while len(left):
                edge[left] += 1
                left = left[u[left] >= lattice.up_to[edge[left]]]
        steps.append((alive, lattice.piece[edge]))
        node = lattice.before[edge]
        more = lattice.start[node + 1] > lattice.start[node]  # the begin of a part has no edges
        alive, node = alive[more], node[more]
    count = np.zeros(len(part), np.int64)
    for who, _ in steps:
        count[who] += 1
    last = np.cumsum(count) - 1
    out = np.empty(int(count.sum()), np.int32)
    for i, (who, piece) in enumerate(steps):
        out[last[who] - i] = piece
    return out, count


def _by_bytes(character: str) -> str:
    return "".join(chr(_BYTE + b) for b in character.encode())


def _parts(rows: list[str], trie: Trie) -> Iterator[tuple[int, int, list[str]]]:
    """Row, number of the first part, and parts, at most PARTS at a time."""
    for i, text in enumerate(rows):
        if len(text) <= LONGEST * LONGEST:
            yield i, 0, trie.split.findall(text)
            continue
        found, at = (m.group() for m in trie.split.finditer(text)), 0
        while block := list(islice(found, PARTS)):
            yield i, at, block
            at += len(block)


def encode_rows(rows: list[str], keys: np.ndarray, trie: Trie, log_weight: np.ndarray, draw: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows in a row, and how many each row has. Draws depend on key and place only."""
    out, sizes = [], np.zeros(len(rows), np.int64)
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def settle() -> None:
        nonlocal size
        if held:
            names = [_by_bytes(w) if len(w) == 1 and not trie.known[ord(w)] else w for w in number]
            part = np.concatenate([p for _, _, p in held])
            place = np.concatenate([np.arange(at, at + len(p), dtype=np.uint64) for _, at, p in held])
            row = np.repeat([i for i, _, _ in held], [len(p) for _, _, p in held])
            key = keys.astype(np.uint64)[row] ^ (place * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
            ids, count = backward(forward(names, trie, log_weight), part, key, draw)
            out.append(ids)
            np.add.at(sizes, row, count)
        held.clear()
        number.clear()
        size = 0

    for i, at, parts in _parts(rows, trie):
        if parts:
            held.append((i, at, np.fromiter(map(number.__getitem__, parts), np.int64, len(parts))))
            size += len(parts)
        if size >= PARTS:
            settle()
    settle()
    return (np.concatenate(out) if out else np.zeros(0, np.int32)), sizes


def _tables(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(p) for p in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.r_[0, np.cumsum(size)[:-1]], size


def decode_ids(ids: np.ndarray, counts: np.ndarray, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows, and offsets."""
    data, first, size = _tables(pieces)
    n = size[ids]
    ends = np.cumsum(n)
    shift = np.repeat(first[ids] - (ends - n), n)
    raw = data[np.arange(len(shift)) + shift] if len(shift) else np.zeros(0, np.uint8)
    at = np.r_[0, np.cumsum(counts)]
    return raw, np.r_[0, ends][at]


@lru_cache(maxsize=1)
def _worker_trie(token: str, held) -> Trie:
    return build_trie(held.value)


def encode(
    docs: DataFrame,
    key_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: Vocabulary | None = None,
    seed: int = 0,
    draw: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """key, columns of `keep`, ids (array<int>), n_pieces and lossless of every row.

    Each part of a text is segmented by a draw from the distribution of its
    segmentations: forward filtering sums the weights of all ways to each node, backward
    sampling draws the last piece, the one before it, and so on. Draws are hashes of the
    row's key, the seed and the place in the text, so reruns, other partitions and equal
    keys with equal texts give equal ids. `lossless` says that the ids decode to the text.

    A null or empty text has no ids and is lossless. A null key is a key like any other.
    Words and runs of spaces are cut after LONGEST characters. The vocabulary, of fixed size, is broadcast.
    """
    vocabulary = vocabulary or load()
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    token = f"{id(held)}"
    columns = [key_col, *keep]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _worker_trie(token, held)
        for batch in batches:
            column = batch.column(len(columns) + 1)
            _, offsets = texts.flat(column)
            for i, j in texts.groups(offsets, 2 * texts.CHUNK):
                part = column.slice(i, j - i)
                rows = [t or "" for t in part.to_pylist()]
                keys = batch.column(len(columns)).slice(i, j - i).to_numpy(zero_copy_only=False)
                ids, counts = encode_rows(rows, keys, trie, held.value.log_weight, draw)
                raw, at = texts.flat(part)
                back, back_at = decode_ids(ids, counts, held.value.pieces)
                same = at == back_at
                same = same[1:] & same[:-1]
                if len(back) == len(raw):
                    wrong = np.r_[0, np.cumsum(back != raw)]
                    same &= wrong[at[1:]] == wrong[at[:-1]]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, j - i) for c in range(len(columns))), lists, pa.array(counts), pa.array(same)],
                    [*columns, "ids", "n_pieces", "lossless"],
                )

    fields = [docs.schema[c] for c in columns]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()), T.StructField("lossless", T.BooleanType())]
    key = F.xxhash64(F.col(key_col), F.lit(seed))
    # By position: names of other columns may clash.
    source = docs.select(*columns, key, text_col).toDF(*columns, "_key_", "_text_")
    return source.mapInArrow(work, T.StructType(fields))


def decode(encoded: DataFrame, key_col: str = "doc_id", ids_col: str = "ids", vocabulary: Vocabulary | None = None) -> DataFrame:
    """key and text of every row. Null ids give an empty text."""
    pieces = (vocabulary or load()).pieces
    held = encoded.sparkSession.sparkContext.broadcast(pieces)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                lists = part.column(1)
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                raw, at = decode_ids(ids, counts, held.value)
                data = raw.tobytes()
                found = [data[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.string())], [key_col, "text"])

    schema = T.StructType([encoded.schema[key_col], T.StructField("text", T.StringType())])
    return encoded.select(key_col, ids_col).mapInArrow(work, schema)
