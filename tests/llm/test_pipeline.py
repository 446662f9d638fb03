"""Every stage on what the stage before it kept."""

from __future__ import annotations

import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from millrace.llm import bpe
from millrace.llm.queries import RANK_FILE
from test_decontaminate import slow as slow_hits
from test_secrets import PLANTED
from test_simhash import slow_components, slow_fingerprint

MEDIUM = "/root/testdata/sf0.01"


def test_stages_in_turn(spark, tmp_path):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    columns, kept = docs.columns, {"start": {r["doc_id"]: r for r in docs.collect()}}
    before = "start"
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, MEDIUM)
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        kept[name] = {r["doc_id"]: r for r in rows}
        assert len(rows) == len(kept[name]) and set(kept[name]) <= set(kept[before])
        if name != "tokens":
            assert docs.columns == columns
        before = name

    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    gone = set(kept["start"]) - set(kept["toxicity"])
    assert sum(labels.get(k) == 1 for k in gone) > 0.6 * sum(labels.values())
    assert sum(labels.get(k) == 0 for k in gone) < 0.01 * len(labels)

    marked = [(k, slow_fingerprint(r["text"])) for k, r in kept["toxicity"].items()]
    assert set(kept["near_duplicates"]) == set(slow_components(marked).values())

    items = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").select("item_id", "text").collect()]
    judged = slow_hits([(k, r["text"]) for k, r in kept["near_duplicates"].items()], items)
    assert set(kept["decontamination"]) == {row[0] for row in judged if not row[5]}
    assert len(kept["decontamination"]) < len(kept["near_duplicates"])

    assert set(kept["secrets"]) == set(kept["decontamination"])
    for key, row in kept["secrets"].items():
        assert row["text"] == PLANTED.sub("[SECRET]", kept["decontamination"][key]["text"])

    raw = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    library = tiktoken.Encoding(
        "all", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.pieces_of(raw).ranks, special_tokens={}
    )
    assert set(kept["tokens"]) == set(kept["secrets"])
    for key, row in kept["tokens"].items():
        text = kept["secrets"][key]["text"]
        ids = library.encode_ordinary(text)
        assert row["n_tokens"] == len(ids) and row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_run_and_odd_tables(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and extra columns pass all stages; so does an empty table."""
    token = 'see token = "abcdef0123456789abcdef0123456789abcd" here'
    rows = [(1, None, 0, "x"), (2, "", 0, "x"), (None, None, 0, "x"), (3, token, 9, "y"), (3, token, 9, "y"), (4, "words " * 9, 1, None),
            (5, "some long words " * 20_000, 1, "z")]
    schema = "doc_id long, text string, n_chars long, words string"
    for name, data in (("full", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        found = corpus_pipeline.run(spark, str(folder)).collect()
        want = [1, 3, 4, 5, None] if data else []
        assert sorted((r["doc_id"] for r in found), key=str) == sorted(want, key=str)
