"""Byte-level BPE: pre-tokens from a scan over codepoint classes, then cached pair merging.

The pattern that cuts a text into pre-tokens is a small automaton over classes of
characters. Each character stands for a function from state to state; functions compose
associatively, so the states before all characters of a batch come from a prefix scan over
arrays instead of a regex. The slices between boundaries go through a cache of merged
pieces. Ids keep the byte offset at which each token starts.

Empty and null texts have no tokens. Texts are never cut, whatever their length. Rows keep
their number; repeated rows are encoded each. Only the key columns asked for are carried,
so other columns of the table, whatever their names, do not matter.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import map_batches

# The White_Space property of Unicode.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Symbols.
LETTER, LETTER_E, LETTER_ONE, LETTER_RV, LETTER_L, NUMBER, OTHER, QUOTE, SPACE, BLANK = range(10)
SYMBOLS = 10
# States, named by what came last. CUT: start of a text, or just behind a contraction.
CUT, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, AFTER_BLANK, AT_QUOTE, QUOTE_RV, QUOTE_L = range(9)
STATES = 9
# Whether a pre-token starts before a symbol.
NO, YES, UNLESS_CONTRACTED, IF_LAST_BLANK = range(4)

BLOCK = 64
CACHE_ENTRIES = 250_000
SHORT_PIECE = 48


@lru_cache(1)
def symbol_table() -> np.ndarray:
    """The symbol of each code point, by the Unicode version that the tokenizer library has."""
    everything = "".join(chr(point) for point in range(sys.maxunicode + 1) if not 0xD800 <= point < 0xE000)
    single = {bytes([byte]): byte for byte in range(256)}
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for pattern, symbol in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        # The library drops what its pattern leaves out, so this lists the members of a class.
        members = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(members.encode_ordinary(everything)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = symbol
    table[WHITE] = BLANK
    table[0x20] = SPACE
    table[ord("'")] = QUOTE
    for letters, symbol in (("stmd", LETTER_ONE), ("rv", LETTER_RV), ("l", LETTER_L), ("e", LETTER_E)):
        for letter in letters:
            table[ord(letter)] = symbol
    return table


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state by symbol and state, with a second set of rows for symbols that start a
    text, and the kind of boundary by state and symbol."""
    step = np.empty((2 * SYMBOLS, STATES), np.uint8)
    edge = np.full((STATES, SYMBOLS), YES, np.uint8)
    letters = (LETTER, LETTER_E, LETTER_ONE, LETTER_RV, LETTER_L)
    step[list(letters)] = IN_LETTERS
    step[NUMBER], step[OTHER], step[QUOTE] = IN_NUMBERS, IN_OTHER, AT_QUOTE
    step[SPACE], step[BLANK] = AFTER_SPACE, AFTER_BLANK
    step[QUOTE, [IN_OTHER, AFTER_SPACE, AT_QUOTE]] = IN_OTHER
    step[LETTER_ONE, AT_QUOTE] = CUT
    step[LETTER_RV, AT_QUOTE] = QUOTE_RV
    step[LETTER_L, AT_QUOTE] = QUOTE_L
    step[LETTER_E, QUOTE_RV] = CUT
    step[LETTER_L, QUOTE_L] = CUT
    step[SYMBOLS:] = step[:SYMBOLS, [CUT]]

    for symbol in letters:
        edge[[IN_LETTERS, QUOTE_RV, QUOTE_L], symbol] = NO
    edge[AT_QUOTE, LETTER_ONE] = NO
    edge[AT_QUOTE, [LETTER_RV, LETTER_L]] = UNLESS_CONTRACTED
    edge[IN_NUMBERS, NUMBER] = NO
    edge[IN_OTHER, [OTHER, QUOTE]] = NO
    edge[AT_QUOTE, [OTHER, QUOTE]] = NO
    edge[AFTER_SPACE, :SPACE] = NO
    edge[[[AFTER_SPACE], [AFTER_BLANK]], [SPACE, BLANK]] = IF_LAST_BLANK
    return step, edge


def scan_states(symbols: np.ndarray) -> np.ndarray:
    """The state behind each symbol, by an associative scan over transition functions."""
    step, _ = automaton()
    flat = step.ravel()
    blocks = -(-len(symbols) // BLOCK)
    grid = np.zeros((blocks, BLOCK), np.uint8)
    grid.ravel()[: len(symbols)] = symbols
    rows = (grid.astype(np.intp) * STATES).T.copy()

    whole = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))
    for row in rows:
        whole = flat[row[:, None] + whole]
    reach = 1
    while reach < blocks:
        later = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), axis=1)
        whole = np.concatenate([whole[:reach], later])
        reach *= 2

    states = np.empty((BLOCK, blocks), np.uint8)
    state = np.concatenate([[CUT], whole[:-1, CUT]]).astype(np.uint8)
    for at, row in enumerate(rows):
        state = flat[row + state]
        states[at] = state
    return states.T.ravel()[: len(symbols)]


def cut(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Positions where pre-tokens start in texts laid end to end; ``firsts``: where texts start."""
    if not len(points):
        return np.empty(0, np.intp)
    _, edge = automaton()
    symbols = symbol_table()[points]
    starts_text = np.zeros(len(points) + 1, bool)
    starts_text[firsts] = True
    starts_text[-1] = True
    states = scan_states(symbols + SYMBOLS * starts_text[:-1])

    kind = np.full(len(points), YES, np.uint8)
    kind[1:] = edge[states[:-1], symbols[1:]]
    following = np.append(states[1:], CUT + 1) == CUT
    blank = np.append(symbols[1:] >= SPACE, True) | starts_text[1:]
    start = (kind == YES) | ((kind == UNLESS_CONTRACTED) & ~following) | ((kind == IF_LAST_BLANK) & ~blank)
    return np.flatnonzero(start | starts_text[:-1])


class Pieces(dict):
    """Ids of a piece of bytes, merged on first sight; forgets all when it is full."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        ids = self.merge(piece)
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        if len(piece) <= SHORT_PIECE:
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Join the neighbours of lowest rank, leftmost first, until none are in the table."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        if len(piece) > SHORT_PIECE:
            return self.merge_long(piece)
        get, none = ranks.get, len(ranks)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        joined = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while joined:
            lowest = min(joined)
            if lowest == none:
                break
            at = joined.index(lowest)
            parts[at] += parts.pop(at + 1)
            joined.pop(at)
            if at:
                joined[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(joined):
                joined[at] = get(parts[at] + parts[at + 1], none)
        return tuple(ranks[part] for part in parts)

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap over linked parts, for pieces of any length."""
        ranks, size = self.ranks, len(piece)
        end = list(range(1, size + 1))  # of the part that starts here
        before = list(range(-1, size - 1))
        queue: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and end[at] < size:
                rank = ranks.get(piece[at : end[end[at]]])
                if rank is not None:
                    heapq.heappush(queue, (rank, at, end[end[at]]))

        for at in range(size):
            offer(at)
        gone = bytearray(size)
        while queue:
            _, at, stop = heapq.heappop(queue)
            if gone[at] or end[at] >= size or end[end[at]] != stop:
                continue
            gone[end[at]] = 1
            end[at] = stop
            if stop < size:
                before[stop] = at
            offer(at)
            offer(before[at])
        ids, at = [], 0
        while at < size:
            ids.append(ranks[piece[at : end[at]]])
            at = end[at]
        return tuple(ids)


def read_ranks(path: str) -> bytes:
    """The rank file: base64 of a token's bytes and its rank a line."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(2)
def pieces_of(rank_file: bytes) -> Pieces:
    lines = (line.split() for line in rank_file.splitlines() if line)
    return Pieces({base64.b64decode(token): int(rank) for token, rank in lines})


@lru_cache(2)
def vocabulary_of(rank_file: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes end to end, with start and length by id."""
    ranks = pieces_of(rank_file).ranks
    length = np.zeros(max(ranks.values()) + 1, np.int64)
    tokens = sorted(ranks.items(), key=lambda item: item[1])
    for token, rank in tokens:
        length[rank] = len(token)
    return np.frombuffer(b"".join(t for t, _ in tokens), np.uint8), np.cumsum(length) - length, length


def slices(texts: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bytes of all texts, where pre-tokens start in them, and where texts start (and end)."""
    encoded = [text.encode() if text else b"" for text in texts.to_pylist()]
    data = b"".join(encoded)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in encoded], dtype=np.int64)])
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    widths = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    at_byte = np.concatenate([[0], np.cumsum(widths)])
    firsts = np.searchsorted(at_byte, bounds[:-1][np.diff(bounds) > 0])
    return data, at_byte[cut(points, firsts)], bounds


def encode_texts(texts: pa.Array, rank_file: bytes) -> tuple[pa.Array, pa.Array]:
    """Lists of ids and of the byte offsets of their tokens, one list a text."""
    data, starts, bounds = slices(texts)
    cache = pieces_of(rank_file)
    places = starts.tolist()
    merged = [cache[data[a:b]] for a, b in zip(places, [*places[1:], len(data)])]
    counts = np.fromiter(map(len, merged), np.int64, len(merged))
    ids = np.fromiter(chain.from_iterable(merged), np.int32, int(counts.sum()))
    lengths = vocabulary_of(rank_file)[2][ids]
    tokens_before = np.concatenate([[0], np.cumsum(counts)])
    lists = tokens_before[np.searchsorted(starts, bounds)]
    at = np.cumsum(lengths) - lengths
    at -= np.repeat(bounds[:-1], np.diff(lists))
    offsets = pa.array(lists, pa.int32())
    return (
        pa.ListArray.from_arrays(offsets, pa.array(ids)),
        pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32())),
    )


def decode_ids(lists: pa.Array, rank_file: bytes) -> pa.Array:
    """The bytes of each list of ids; ids outside the vocabulary raise IndexError."""
    data, first, length = vocabulary_of(rank_file)
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    widths = length[ids]
    ends = np.cumsum(widths)
    out = data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[ids] - (ends - widths), widths)]
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
    return pa.Array.from_buffers(
        pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)]
    )


#: Texts a step inside a batch, to bound the arrays of the scan.
STEP_ROWS, STEP_BYTES = 256, 8 << 20


def steps(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about STEP_BYTES; a row that is larger stands alone."""
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    first, held = 0, 0
    for at, size in enumerate(sizes):
        if at > first and (held + size > STEP_BYTES or at - first >= STEP_ROWS):
            yield batch.slice(first, at - first)
            first, held = at, 0
        held += size
    if len(sizes) > first:
        yield batch.slice(first)


def encode(df: DataFrame, rank_file: bytes, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Ids of each row's text: the keys, ``ids`` and ``starts`` (byte offset of each token).

    ``keys`` must not be named ``ids`` or ``starts``.
    """
    shipped = df.sparkSession.sparkContext.broadcast(rank_file)
    picked = df.select(*keys, F.col(text).cast("string").alias("__text"))
    arrays = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([*picked.schema.fields[:-1], T.StructField("ids", arrays), T.StructField("starts", arrays)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*keys, "ids", "starts"]
        for batch in batches:
            for part in steps(batch, "__text"):
                made = encode_texts(part.column("__text"), shipped.value)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names)

    return map_batches(picked, run, schema)


def decode(df: DataFrame, rank_file: bytes, keep: Sequence[str] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """The bytes of each row's ids in column ``decoded``, beside the columns to keep."""
    shipped = df.sparkSession.sparkContext.broadcast(rank_file)
    picked = df.select(*keep, F.col(ids).alias("__ids"))
    schema = T.StructType([*picked.schema.fields[:-1], T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(first, STEP_ROWS)
                made = decode_ids(part.column("__ids"), shipped.value)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], [*keep, "decoded"])

    return map_batches(picked, run, schema)


def digests(docs: DataFrame, rank_file: bytes) -> DataFrame:
    """Per row of ``docs``: doc_id, number of ids, and hashes of the ids and of the decoded bytes."""
    encoded = encode(docs, rank_file).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
    )
    return decode(encoded, rank_file, ["doc_id", "n_tokens", "ids_sha256"]).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
