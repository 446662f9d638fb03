"""Periodic runs of words, found by online dyadic square catching.

A square is a stretch of words that stands twice in a row; a run is a stretch of smallest period
q and length 2q or more that cannot be extended. Words are appended to a stream. For every power
of two h, a catcher sits on each completed block of h words that starts at a multiple of h. A
square whose half has a length from 2h to 4h - 1 holds such a block in its first half, so its
catcher sees the block again at that distance: each appended word ends one window of h words,
and that window is compared with the two blocks that lie at such a distance (lengths 1 to 3 are
compared word by word). From a window that agrees, the comparison is carried on to the left as
far as it goes and to the right as far as the words are known. A comparison that reaches the
last word stays open, and the next appended words carry it on. As soon as it is as long as its
distance it is a square, and squares of one distance that overlap are one comparison: a run.

What the appended words are compared by is a hash of any window, from sums of powers, so a
stretch of appended words is compared with all catchers of one size in a few array operations.
Hashes only choose; each run is compared word by word before it counts. Windows inside a known
run whose period divides the distance are skipped, and of equal stretches the smallest period
stays, so text that repeats one word a million times is one run found in a few comparisons.
Words are appended in stretches of any lengths, with the same result.

Documents of a batch are appended to one stream, each followed by a word that stands nowhere
else, which no run can hold. Work grows as n log n; memory is about 150 bytes a word of the
longest document.

Null and empty texts have no words and no runs. Rows keep their number, repeated rows too, and
the result of a row depends on its text alone. Only the columns asked for are carried, so other
columns do not matter. Runs are listed by start, then period. A word goes from the collapsed text
if some run holds it after its first period.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import map_batches, whole

#: Shortest run that is reported.
LEAST_WORDS = 12
#: Words of a stream, about; a longer document is a stream of its own.
STREAM_WORDS = 1 << 18
#: Odd numbers for the window hashes, and the inverse of the first.
BASE = 0x9E3779B97F4A7C15
MIXER = 0xD1342543DE82EF95
INVERSE = pow(BASE, -1, 1 << 64)
#: Blanks between words.
BLANKS = r"[\x20\x09-\x0D]+"


def powers(number: int, length: int) -> np.ndarray:
    made = np.full(length, number, np.uint64)
    made[:1] = 1
    return np.cumprod(made)


class SquareCatcher:
    """Runs of a growing stream of whole numbers.

    ``longest`` bounds the length of a run where the caller knows one.
    """

    def __init__(self, least: int = LEAST_WORDS, longest: int | None = None):
        self.least, self.longest = least, longest
        self.words = np.empty(0, np.int64)
        self.sums = np.zeros(1, np.uint64)  # of mixed words times powers, over prefixes
        self.back = np.ones(1, np.uint64)  # inverse powers
        # The known run that reaches furthest over each word: its end and its period.
        self.reach = np.empty(0, np.int64)
        self.period = np.ones(0, np.int64)
        self.open: set[tuple[int, int]] = set()  # first word and distance of comparisons that reach the end
        self.found: dict[tuple[int, int], int] = {}  # smallest period by start and end

    def same(self, x: np.ndarray, y: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Whether the windows of ``length`` words at ``x`` and ``y`` have one hash."""
        sums, back = self.sums, self.back
        return (sums[x + length] - sums[x]) * back[x] == (sums[y + length] - sums[y]) * back[y]

    def carried(self, x: np.ndarray, distance: np.ndarray, limit: np.ndarray, way: int) -> np.ndarray:
        """How many words from ``x`` on (or before it, for way -1) equal those ``distance`` later."""
        done = np.zeros(len(x), np.int64)
        step = 1 << int(limit.max(initial=0)).bit_length()
        while step:
            more = np.flatnonzero(done + step <= limit)
            if len(more):
                start = x[more] + done[more] if way > 0 else x[more] - done[more] - step
                done[more[self.same(start, start + distance[more], step)]] += step
            step >>= 1
        return done

    def append(self, words: np.ndarray) -> None:
        """Take the next words in."""
        old, new = len(self.words), len(self.words) + len(words)
        if old == new:
            return
        self.words = np.concatenate([self.words, words])
        forward = powers(BASE, new)[old:]
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(MIXER)
        mixed ^= mixed >> np.uint64(29)
        added = np.cumsum(mixed * forward, dtype=np.uint64) + self.sums[-1]
        self.sums = np.concatenate([self.sums, added])
        self.back = powers(INVERSE, new + 1)
        self.reach = np.concatenate([self.reach, np.zeros(len(words), np.int64)])
        self.period = np.concatenate([self.period, np.ones(len(words), np.int64)])
        waiting, self.open = sorted(self.open, key=lambda pair: pair[1]), set()
        if waiting:
            left, distance = np.array(waiting, np.int64).T
            right = old - distance
            self.close(left, distance, right + self.carried(right, distance, old + len(words) - right - distance, 1))
        block = 1
        while block == 1 or 4 * block <= min(new, self.longest or new):
            self.catch(block, old, new)
            block *= 2

    def catch(self, block: int, old: int, new: int) -> None:
        """Compare the windows of ``block`` words that end in the new words with the blocks before."""
        windows = np.arange(max(old - block + 1, 0), new - block + 1)
        if block == 1:
            hashes = self.words
            pairs = [(later - k, later) for k in (1, 2, 3) for later in [windows[windows >= k]]]
        else:
            hashes = (self.sums[block:] - self.sums[:-block]) * self.back[: new - block + 1]
            nearest = (windows - 2 * block) // block * block
            pairs = [(b[b >= 0], windows[b >= 0]) for b in (nearest, nearest - block)]
        agree = [(a[same], b[same]) for a, b in pairs for same in [hashes[a] == hashes[b]]]
        first = np.concatenate([a for a, _ in agree])
        distance = np.concatenate([b for _, b in agree]) - first
        unknown = (self.reach[first] < first + distance + block) | (distance % self.period[first] != 0)
        first, distance = first[unknown], distance[unknown]
        if not len(first):
            return
        # Blocks that agree side by side at one distance are one comparison.
        order = np.lexsort((first, distance))
        first, distance = first[order], distance[order]
        fresh = np.ones(len(first), bool)
        fresh[1:] = (distance[1:] != distance[:-1]) | (first[1:] != first[:-1] + block)
        starts = np.flatnonzero(fresh)
        ends = first[np.append(starts[1:], len(first)) - 1] + block
        first, distance = first[starts], distance[starts]
        left = first - self.carried(first, distance, first, -1)
        right = ends + self.carried(ends, distance, new - ends - distance, 1)
        self.close(left, distance, right)

    def close(self, left: np.ndarray, distance: np.ndarray, right: np.ndarray) -> None:
        """Keep what reaches the end open, and report comparisons as long as their distance."""
        size = len(self.words)
        reaching = right + distance == size
        square = right - left >= np.maximum(distance, self.least - distance)
        for i in np.flatnonzero(reaching | square):
            start, q, end = int(left[i]), int(distance[i]), int(right[i] + distance[i])
            if square[i]:
                start, end = self.checked(start, end, q)
                if end - start < max(2 * q, self.least):
                    continue
                covered = self.reach[start:end]
                further = covered < end
                self.period[start:end][further] = q
                covered[further] = end
            if end == size:
                self.open.add((start, q))
            else:
                self.found[start, end] = min(q, self.found.get((start, end), q))

    def checked(self, start: int, end: int, q: int) -> tuple[int, int]:
        """The stretch itself if its words repeat at ``q`` and those next to it do not; else, where
        a hash misled, the longest true part of it."""
        words = self.words
        unequal = np.flatnonzero(words[start : end - q] != words[start + q : end])
        if not len(unequal):
            return start, end
        bounds = np.concatenate([[-1], unequal, [end - q - start]])
        longest = int(np.argmax(np.diff(bounds)))
        return start + int(bounds[longest]) + 1, start + int(bounds[longest + 1]) + q

    def runs(self) -> list[tuple[int, int, int]]:
        """``(start, length, period)`` of all runs so far, by start, then period."""
        size, all_of_them = len(self.words), dict(self.found)
        for start, q in self.open:
            if size - start >= max(2 * q, self.least):
                all_of_them[start, size] = min(q, all_of_them.get((start, size), q))
        return sorted(
            ((start, end - start, q) for (start, end), q in all_of_them.items()), key=lambda run: (run[0], run[2])
        )


def streams(documents: Sequence[list[bytes]]) -> Iterator[list[int]]:
    """Numbers of documents that go through one stream, documents of like length together."""
    group, held = [], 0
    for number in sorted(range(len(documents)), key=lambda i: len(documents[i])):
        length = len(documents[number])
        if group and held + length > STREAM_WORDS:
            yield group
            group, held = [], 0
        group.append(number)
        held += length
    if group:
        yield group


def runs_of(documents: Sequence[list[bytes]], least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """The runs of each document, a list of words."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    for group in streams(documents):
        codes: dict[bytes, int] = defaultdict(count(len(group)).__next__)  # numbers below are separators
        parts, starts, at = [], [], 0
        for separator, number in enumerate(group):
            words = documents[number]
            starts.append(at)
            at += len(words) + 1
            parts += [np.fromiter(map(codes.__getitem__, words), np.int64, len(words)), np.array([separator])]
        catcher = SquareCatcher(least, len(documents[group[-1]]))
        catcher.append(np.concatenate(parts))
        places = np.array(starts)
        for start, length, period in catcher.runs():
            owner = int(np.searchsorted(places, start, "right")) - 1
            found[group[owner]].append((start - starts[owner], length, period))
    return found


def collapsed(words: list[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words, without those that a run holds after its first period."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def find_runs(
    docs: DataFrame, text: str = "text", keys: Sequence[str] = ("doc_id",), least: int = LEAST_WORDS
) -> DataFrame:
    """The keys, ``runs`` (start, length and period, in words) and ``collapsed``, the text without
    repetitions, of each row."""
    picked = docs.select(*keys, whole(F.col(text).cast("string")).alias("__text"))
    schema = T.StructType([
        *picked.schema.fields[:-1], T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in RUN.names]))
        for batch in batches:
            # The bytes that part words in bytes are the six blanks, and no others.
            documents = [value.as_py().encode().split() for value in batch.column(len(keys))]
            runs = runs_of(documents, least)
            listed = pa.array([[dict(zip(RUN.names, x)) for x in each] for each in runs], kind)
            texts = pa.array([collapsed(words, each).decode() for words, each in zip(documents, runs)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], listed, texts], [*keys, "runs", "collapsed"])

    return map_batches(picked, run, schema)


def planted(text: Column, key: Column) -> Column:
    """The text; in a tenth of the documents, by a hash of the key, the words from some place on
    are repeated with some period instead."""
    words = F.array_remove(F.split(whole(text), BLANKS), "")
    mark = F.crc32(key.cast("string"))
    # One array item, so that its words are split once however often they are used.
    made = F.array(F.struct(words.alias("w"), F.floor(mark / 10).alias("g")))
    start = lambda x: (x["g"] % F.size(x["w"])).cast("int")
    length = lambda x: F.floor((F.size(x["w"]) - start(x)) / (3 + x["g"] % 8)).cast("int") + 1

    def repeated(x: Column) -> Column:
        a, p, size = start(x), length(x), F.size(x["w"])
        times = F.ceil((size - a) / p).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(x["w"], a + 1, p), times))
        return F.array_join(F.concat(F.slice(x["w"], F.lit(1), a), F.slice(tail, F.lit(1), size - a)), " ")

    changed = F.transform(made, lambda x: F.when(F.size(x["w"]) > 0, repeated(x)).otherwise(F.lit("")))
    return F.when(mark % 10 == 0, F.get(changed, 0)).otherwise(whole(text))


def report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Numbers and hashes of each document's runs, and the longest of them."""
    rewritten = docs.select(key, planted(F.col(text).cast("string"), F.col(key)).alias("text"))
    found = find_runs(rewritten, "text", [key])
    # Greatest length, then smallest start, then smallest period.
    ranked = F.array_max(
        F.transform(
            "runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("s"), (-x["period"]).alias("p"))
        )
    )
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    best = found.select(
        key, F.size("runs").cast("long").alias("n_runs"), ranked.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    length, period = F.col("best.length"), -F.col("best.p")
    return best.select(
        key, "n_runs", (-F.col("best.s")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
