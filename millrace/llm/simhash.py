"""SimHash near-duplicates with pivot distance tables.

Fingerprints of 64 bits link at two or fewer differing bits. Two such fingerprints agree on
at least two of their four 16-bit segments, so they meet under one of six keys of 32 bits.
Each fingerprint carries a table of its Hamming distances to reference fingerprints
(pivots). By the triangle inequality the coordinates of linked fingerprints differ by at
most two, so pairs under a key are discarded by their largest coordinate difference, and
the bits of the survivors are counted.

A pivot alone cannot be the join key: distances of random fingerprints to a pivot have a
deviation of four, so a window of two either side keeps half of all pairs.

Keys shared by many fingerprints (near copies of one text in thousands) are not paired.
There each fingerprint is listed under itself and its 64 neighbours at one bit; two
fingerprints within two bits share such a point, and all that share one are within two bits
of each other, so a star round the smallest keeps every component. A point has at most 65
members, whatever the data.

Texts that are null, empty or blank have fingerprint zero and link like any other. Rows with
equal ids are rows of their own in the result. A component of rows that all lack an id has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_batches
from millrace.llm.components import components
from millrace.operators.joins import join_with_heavy_keys
from millrace.workspace import materialize

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: Fingerprints a key may have before its members are listed by points instead of paired.
PAIRED_MEMBERS = 64
PIVOTS = 16
#: Rows of bits that are summed at once.
BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint: bits set in over half of the shingles' hashes."""
    parts = (text or "").encode().lower().split()  # on bytes both know ASCII only
    if not parts:
        return 0
    if len(parts) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(x), SEED) for x in zip(*(parts[i:] for i in range(words)))]
    values = np.array(hashes, "<u8")
    ones = np.zeros(64, np.int64)
    for first in range(0, len(values), BLOCK):
        block = values[first : first + BLOCK]
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, text_hash, fingerprint)`` for each row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([fingerprint(x.as_py()) for x in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], made], [key, "text_hash", "fingerprint"])

    whole = F.col(text).cast("string")
    picked = docs.select(key, F.xxhash64(whole).alias("text_hash"), whole.alias("__text"))
    return map_batches(picked, run, f"`{key}` {kind}, text_hash bigint, fingerprint bigint")


def pivots() -> list[int]:
    """Reference fingerprints, fixed for all runs."""
    return [int(xxhash.xxh64_intdigest(b"pivot %d" % i, SEED)) - (1 << 63) for i in range(PIVOTS)]


def distance_table(fp: Column) -> list[Column]:
    """Distances to the pivots, eight of them in each long."""
    distances = [F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long") for p in pivots()]
    return [
        reduce(Column.bitwiseOR, [F.shiftleft(d, 8 * i) for i, d in enumerate(distances[first : first + 8])])
        .alias(f"table_{first // 8}")
        for first in range(0, PIVOTS, 8)
    ]


def coordinates_agree(a: str, b: str) -> Column:
    """Whether no pivot distance differs by more than the allowed bits."""
    far = []
    for i in range(PIVOTS):
        left, right = (
            F.shiftright(F.col(f"{side}.table_{i // 8}"), 8 * (i % 8)).bitwiseAND(F.lit(127)) for side in (a, b)
        )
        far.append(F.abs(left - right))
    return F.greatest(*far) <= MAX_BITS


def keys(fp: Column) -> Column:
    """Six keys: two of the four segments, with the number of the choice above them."""
    segment = [F.shiftright(fp, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    return F.array(*[
        F.shiftleft(segment[i], 16).bitwiseOR(segment[j]).bitwiseOR(F.lit(number << 32))
        for number, (i, j) in enumerate(combinations(range(4), 2))
    ])


def links(distinct: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that join all fingerprints of ``distinct(fingerprint)`` within two bits."""
    tables = materialize(distinct.select("fingerprint", *distance_table(F.col("fingerprint"))), "pivots")
    keyed = tables.withColumn("key", F.explode(keys(F.col("fingerprint"))))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = materialize(keyed.join(shared, "key"), "met")

    paired = met.where(F.col("members") <= PAIRED_MEMBERS)
    pairs = (
        paired.alias("a").join(
            paired.alias("b"),
            (F.col("a.key") == F.col("b.key"))
            & (F.col("a.fingerprint") < F.col("b.fingerprint"))
            & coordinates_agree("a", "b")
            & (F.bit_count(F.col("a.fingerprint").bitwiseXOR(F.col("b.fingerprint"))) <= MAX_BITS),
        )
        .select(F.col("a.fingerprint").alias("a"), F.col("b.fingerprint").alias("b"))
    )

    crowded = met.where(F.col("members") > PAIRED_MEMBERS).select("fingerprint").distinct()
    fp = F.col("fingerprint")
    points = F.array(fp, *[fp.bitwiseXOR(F.lit(bit - (1 << 64) if bit >> 63 else bit)) for bit in (1 << i for i in range(64))])
    stars = (
        crowded.withColumn("point", F.explode(points))
        .select(F.min("fingerprint").over(Window.partitionBy("point")).alias("a"), fp.alias("b"))
        .where("a != b")
    )
    return pairs.union(stars)


def classes(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``(key, text_hash, fingerprint, root, component_id)`` for each row: ``root`` is a fingerprint
    that names the component, ``component_id`` its smallest key."""
    marked = materialize(fingerprints(docs, text, key), "fingerprints")
    smallest = materialize(marked.groupBy("fingerprint").agg(F.min(key).alias("least")), "distinct")
    roots = components(links(smallest))
    linked = smallest.join(roots, F.col("fingerprint") == F.col("node"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(least, "root").select(F.col("node").alias("fingerprint"), "root", "component_id")
    named = smallest.join(named, "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"),
        F.coalesce("component_id", "least").alias("component_id"),
    )
    # Exact copies and empty texts may share a fingerprint by the million.
    joined = join_with_heavy_keys(marked, named, ["fingerprint"], spread=[key, "text_hash"])
    return joined.select(key, "text_hash", "fingerprint", "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fingerprint, component_id)`` for each row: the smallest key reachable by links."""
    return classes(docs, text, key).select(key, "fingerprint", "component_id")


def without_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component, all columns kept: that of the smallest key, and where several
    texts of the component have that key, of the smallest fingerprint and text hash.

    Rows without a key stay all. Rows that share a key but not a component are told apart by their
    text, so none goes for the other's sake.
    """
    found = classes(docs.where(F.col(key).isNotNull()), text, key).where(F.col(key) == F.col("component_id"))
    first = found.groupBy("root").agg(F.min(F.struct(key, "fingerprint", "text_hash")).alias("first"))
    chosen = first.select(F.col(f"first.{key}").alias("__kept"), F.col("first.text_hash").alias("__hash"))
    marked = docs.withColumn("__text_hash", F.xxhash64(F.col(text).cast("string")))
    match = (F.col(key) == F.col("__kept")) & (F.col("__text_hash") == F.col("__hash"))
    kept = marked.join(chosen, match, "left_semi").dropDuplicates([key, "__text_hash"])
    return kept.drop("__text_hash").unionByName(docs.where(F.col(key).isNull()))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
