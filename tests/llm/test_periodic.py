"""Runs against brute force over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import periodic
from millrace.llm.queries import QUERIES


def slow_runs(words, least=12):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - start >= max(q, least - q):
                found.setdefault((start, end + q), q)
            start = end + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda run: (run[0], run[2]))


def samples():
    rng = random.Random(8)
    yield []
    yield [1] * 100
    yield [1, 2] * 37 + [1]
    yield list(range(50)) * 3 + [7] * 30 + list(range(50)) * 2
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    yield fibonacci[-1]
    yield [bin(i).count("1") % 2 for i in range(300)]
    for letters in (1, 2, 3, 6):
        for _ in range(8):
            words = [rng.randrange(letters) for _ in range(rng.randrange(1, 250))]
            for _ in range(rng.randrange(3)):
                at, length = rng.randrange(len(words)), rng.randrange(1, 40)
                words[at:at] = words[at : at + length] * rng.randrange(2, 5)
            yield words


@pytest.mark.parametrize("least", [2, 12])
def test_catcher_by_brute_force(least):
    for words in samples():
        catcher = periodic.SquareCatcher(least)
        catcher.append(np.array(words, np.int64))
        assert catcher.runs() == slow_runs(words, least)


def test_words_appended_in_pieces():
    rng = random.Random(9)
    for words in samples():
        catcher, at = periodic.SquareCatcher(), 0
        while at < len(words):
            step = rng.choice([1, 1, 2, 7, 40])
            catcher.append(np.array(words[at : at + step], np.int64))
            at += step
            assert catcher.runs() == slow_runs(words[:at])


def test_hashes_that_mislead_are_checked(monkeypatch):
    monkeypatch.setattr(periodic, "MIXER", 0)  # all windows of a length have one hash
    words = [random.Random(2).randrange(40) for _ in range(60)] + [1, 2, 3] * 6
    catcher = periodic.SquareCatcher()
    catcher.append(np.array(words, np.int64))
    assert all(run in slow_runs(words) for run in catcher.runs())


def test_long_repetitions_end():
    catcher = periodic.SquareCatcher()
    catcher.append(np.zeros(300_000, np.int64))
    assert catcher.runs() == [(0, 300_000, 1)]
    words = np.random.default_rng(1).integers(0, 1_000_000, 100_000)
    catcher = periodic.SquareCatcher()
    catcher.append(np.concatenate([words, words]))
    assert catcher.runs() == [(0, 200_000, 100_000)]


def slow_report(key, text, plant=True):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    mark = zlib.crc32(str(key).encode())
    g, n = mark // 10, len(words)
    if plant and key is not None and mark % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = slow_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    start, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (
        key, len(runs), start, length, q, 1000 * length // q if runs else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_on_whole_table(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op12_periodic"](spark, small).collect()))
    assert got == sorted(slow_report(*doc) for doc in docs)
    assert sum(row[1] > 0 for row in got) > len(got) / 20


def test_odd_texts(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a\u00a0a\u2003a " * 20), (5, "one two " * 40), (5, "one two " * 40),
        (None, "x " * 13), (6, "\x1c \x1f " * 9), (7, "word%d " * 3000 % tuple(range(3000)) + "again and " * 700),
    ] + [(i, "p q r s t u v " * 9) for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as runs", "2 as collapsed", "3 as start")
    got = sorted((tuple(r) for r in periodic.report(docs).collect()), key=repr)
    assert got == sorted((slow_report(*row) for row in rows), key=repr)
    assert periodic.report(docs.limit(0)).count() == 0
    found = {r["doc_id"]: r for r in periodic.find_runs(docs).collect()}
    assert found[5]["collapsed"] == "one two" and found[5]["runs"] == [(0, 80, 2)]
    assert found[7]["collapsed"].endswith("word2999 again and")
