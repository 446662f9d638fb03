"""Benchmark decontamination by a prefix-filtered set join.

A window is 13 consecutive words of a benchmark item (a shorter item is one window). A window
occurs in a document only if all its shingles do, so the join needs a prefix of one shingle:
the one that is rarest in the documents. Document shingles join these prefixes; a match at a
place fixes where the window would start, the bounds of the document drop windows that would
stick out, and the words of that stretch are compared exactly. Hit words are the union of
the stretches found.

All steps are DataFrame functions. Documents are scanned twice, once to count the shingles
that the benchmark has, once to find places; only matches and one small row per document are
shuffled. The benchmark's shingles and the prefixes are broadcast while their measured
size allows it; beyond, document places carry the words around them into a shuffled join, where
shingles and windows that many places share are dealt over several tasks.

Null and empty texts have no words and are never contaminated. Null items have no windows.
Item ids that are null are not listed or counted, but their windows hit. Repeated document
rows are judged each; repeated items count once by id. Only key and text are read, so other
columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import joined_ids, once, plain_words
from millrace.operators.joins import join_with_heavy_keys, repeated, salted, width_of
from millrace.workspace import materialize

WINDOW_WORDS = 13
SHINGLE_WORDS = 3
#: A document counts as contaminated if hit words are one in this many, or more.
ONE_IN = 20
#: Bytes up to which the benchmark's shingles, and the prefixes with their words, are broadcast.
BROADCAST_BYTES = 32 << 20
#: Bytes of one hash, and of one window with its item, in a hash table, about.
SHINGLE_BYTES, MEMBER_BYTES = 32, 200


def shingle(words: Column, at: Column, length: Column) -> Column:
    """Hash of the ``length`` (at most SHINGLE_WORDS) words from a place on."""
    return F.xxhash64(length, *[F.when(length > k, F.get(words, at + k)) for k in range(SHINGLE_WORDS)])


def each_place(df: DataFrame, first: int) -> DataFrame:
    """A row ``at`` for each place of a shingle of ``length`` in ``words`` (``n`` of them),
    from place 0; or from -1, so that each row of ``df`` stays.

    Places are numbers and shingles are hashed behind the generator, which keeps both in
    compiled code; a lambda over the words would be interpreted.
    """
    last = F.greatest(F.col("n") - F.col("length"), F.lit(-1))
    return df.withColumn("at", F.explode(F.sequence(F.lit(-1), last))).where(F.col("at") >= first)


def windows(items: DataFrame, text: str, key: str, words: int) -> tuple[DataFrame, DataFrame]:
    """``(window, words, n)`` for each different window, and ``(window, item)`` for its items."""
    parts = (
        items.select(F.col(key).alias("item"), once(words=plain_words(F.col(text).cast("string"))).alias("p"))
        .select("item", F.col("p.words").alias("all"), F.size("p.words").alias("n")).where("n > 0")
    )
    cut = parts.select(
        "item",
        F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - words, F.lit(0)))).alias("at"),
        "all",
    ).select("item", F.slice("all", F.col("at") + 1, words).alias("words"))
    cut = cut.withColumn("window", F.sha2(F.concat_ws(" ", "words"), 256))
    distinct = cut.groupBy("window").agg(F.first("words").alias("words")).withColumn("n", F.size("words"))
    return distinct, cut.select("window", "item").distinct()


def document_words(docs: DataFrame, text: str, key: str) -> DataFrame:
    """``(doc, text_hash, words, n)`` for each row."""
    whole = F.col(text).cast("string")
    return docs.select(
        F.col(key).alias("doc"), F.xxhash64(whole).alias("text_hash"), once(words=plain_words(whole)).alias("p")
    ).select("doc", "text_hash", F.col("p.words").alias("words"), F.size("p.words").alias("n"))


def prefixes(docs: DataFrame, distinct: DataFrame, lengths: list[int], broadcast_bytes: int) -> DataFrame:
    """``(hash, places, offset, window, words, n)``: of each window whose shingles all occur, the
    rarest, and in how many places of documents it stands."""
    hashed = shingle(F.col("words"), F.col("at"), F.col("length")).alias("hash")
    listed = each_place(distinct.withColumn("length", F.least(F.col("n"), F.lit(SHINGLE_WORDS))), 0).select(
        "window", F.col("at").alias("offset"), hashed
    )
    wanted = materialize(listed.select("hash").distinct(), "shingles")
    if wanted.count() * SHINGLE_BYTES <= broadcast_bytes:
        wanted = F.broadcast(wanted)
    spread = each_place(docs.withColumn("length", F.explode(F.lit(lengths))), 0).select(hashed)
    counts = spread.join(wanted, "hash", "left_semi").groupBy("hash").agg(F.count("*").alias("places"))
    rarest = (
        listed.join(counts, "hash", "left").groupBy("window")
        .agg(
            F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "hash", "offset")).alias("rarest")
        )
        .where("rarest.places > 0")
        .select("window", "rarest.*")
    )
    return rarest.join(distinct, "window").select("hash", "places", "offset", "window", "words", "n")


def heavy_shingles(found: DataFrame) -> DataFrame:
    """Prefixes that stand in more places than an even share of all that count, with their salts;
    fewer than there are partitions."""
    width = width_of(found.sparkSession)
    counts = found.select("hash", "places").distinct()
    share = (counts.agg(F.sum("places")).first()[0] or 0) / width
    listed = [(row["hash"], -int(-row["places"] // share)) for row in counts.where(F.col("places") > share).collect()]
    return found.sparkSession.createDataFrame(listed, "hash bigint, _salts int")


def hit_words(spans: Column) -> Column:
    """Length of the union of ``(start, n)`` spans."""
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("reach"))

    def add(state: Column, span: Column) -> Column:
        end = span["start"] + span["n"]
        fresh = F.greatest(F.lit(0), end - F.greatest(span["start"], state["reach"]))
        return F.struct(
            (state["hit"] + fresh).alias("hit"), F.greatest(state["reach"], end).alias("reach")
        )

    return F.aggregate(F.array_sort(spans), start, add, lambda state: state["hit"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    words: int = WINDOW_WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(doc, text_hash, n_words, n_hit, items, contaminated)`` for each row of ``docs``."""
    distinct, members = windows(items, item_text, item_key, words)
    distinct, members = materialize(distinct, "windows"), materialize(members, "members")
    lengths = [r[0] for r in distinct.select(F.least("n", F.lit(SHINGLE_WORDS))).distinct().collect()]
    split = document_words(docs, text, key)
    if lengths:
        found = materialize(prefixes(split, distinct, lengths, broadcast_bytes), "prefixes")
    else:
        kinds = "hash bigint, places bigint, offset int, window string, words array<string>, n int"
        found = docs.sparkSession.createDataFrame([], kinds)
    size = found.agg(F.sum(F.length(F.concat_ws(" ", "words")) + 100)).first()[0] or 0
    small = size <= broadcast_bytes

    # Place -1 of every document meets nothing, so that no document is lost; its hash is the row's own.
    lengths = lengths or [1]
    places = each_place(split.withColumn("length", F.explode(F.lit(lengths))), -1)
    places = places.where((F.col("at") >= 0) | (F.col("length") == F.lit(lengths[0]))).withColumn(
        "hash",
        F.when(F.col("at") < 0, F.xxhash64("doc", "text_hash")).otherwise(
            shingle(F.col("words"), F.col("at"), F.col("length"))
        ),
    )
    if not small:
        first = F.greatest(F.col("at") - (words - 1), F.lit(0))
        places = places.withColumn("words", F.slice("words", first + 1, 2 * words)).withColumn("from", first)
    else:
        places = places.withColumn("from", F.lit(0))
    table = found.select(
        F.col("hash").alias("prefix"), "offset", "window", F.col("words").alias("window_words"), F.col("n").alias("window_n")
    )
    if small:
        joined = places.join(F.broadcast(table), F.col("hash") == F.col("prefix"), "left")
    else:
        heavy = heavy_shingles(found)
        dealt = salted(places, heavy, ["hash"], ["doc", "text_hash", "at"])
        copies = repeated(table.withColumn("hash", F.col("prefix")), heavy, ["hash"])
        joined = dealt.join(copies, ["hash", "_salt"], "left")
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("window_n") <= F.col("n"))
    same = F.slice("words", F.greatest(start - F.col("from"), F.lit(0)) + 1, F.col("window_n")) == F.col("window_words")
    own = F.col("at") < 0
    met = joined.where(own | (F.col("window").isNotNull() & inside & same)).select(
        "doc", "text_hash", "n", F.when(~own, F.col("window")).alias("window"), start.alias("start"), "window_n"
    )
    if members.count() * MEMBER_BYTES <= broadcast_bytes:
        listed = met.join(F.broadcast(members), "window", "left")
    else:
        # Every document has a row without a window, and a common passage many rows with one.
        listed = join_with_heavy_keys(materialize(met, "met"), members, ["window"], "left", spread=["doc", "text_hash", "start"])
    spans = F.collect_set(
        F.when(F.col("window").isNotNull(), F.struct("start", F.col("window_n").alias("n")))
    )
    judged = (
        listed.groupBy("doc", "text_hash", "n")
        .agg(
            F.count_if(F.col("window").isNull()).alias("copies"),
            spans.alias("spans"), F.collect_set("item").alias("items"),
        )
        .select(
            "doc", "text_hash", F.col("n").cast("long").alias("n_words"), hit_words(F.col("spans")).alias("n_hit"),
            "items", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
        )
        .drop("copy")
    )
    return judged.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words")))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The judgement of each document, with a hash of its items' ids."""
    return contamination(docs, items).select(
        F.col("doc").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        joined_ids(F.col("items")).alias("items_sha256"), "contaminated",
    )


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = (
        contamination(docs, items, text, key).where("contaminated")
        .select(F.col("doc").alias("__doc"), F.col("text_hash").alias("__hash")).distinct()
    )
    match = F.col(key).eqNullSafe(F.col("__doc")) & (F.xxhash64(F.col(text).cast("string")) == F.col("__hash"))
    return docs.join(bad, match, "left_anti")
