"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

import math
import string

from millrace.llm import centroids
from millrace.llm.decontaminate import ONE_IN, WINDOW_WORDS
from millrace.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES, block_words, template_words

LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
WORDS = f"regexp_extract_all({LOWERED}, {WORD})"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, list_slice(w, i, i + {WINDOW_WORDS - 1}) AS x
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW_WORDS - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT len(x) AS n FROM bw),
dw AS (
    SELECT r, i, n, list_slice(w, i, i + n - 1) AS x
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)
),
m AS (SELECT r, i, n, item_id FROM dw JOIN bw USING (x)),
h AS (
    SELECT r, count(DISTINCT p) AS hit
    FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r
),
k AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM m WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit, 0) AS n_hit,
    CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
    sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
    coalesce(hit, 0) > 0 AND {ONE_IN} * coalesce(hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN k USING (r)
"""


def phrase_places(phrase: str, label: str) -> str:
    parts = phrase.split()
    same = " AND ".join(f"w[i + {k}] = '{part}'" for k, part in enumerate(parts))
    return f"SELECT r, i, '{label}' AS label FROM words WHERE {same}"


def template_values() -> str:
    rows = []
    for number, (label, notice) in enumerate(TEMPLATES):
        words = template_words(notice)
        needed = math.ceil(CONTAINMENT * len(words) - 1e-9)
        rows += [f"({number}, '{label}', '{word}', {len(words)}, {needed}, {block_words(notice)})" for word in words]
    return ", ".join(rows)


LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {LOWERED} AS lowered, {WORDS} AS w FROM documents),
words AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
places AS ({" UNION ALL ".join(phrase_places(p, label) for p, label in PHRASES.items())}),
base AS (
    SELECT r, count(*) AS n, min(i) - 1 AS first_word, max(i) - 1 AS last_word, list(DISTINCT label) AS labels
    FROM places GROUP BY r
),
templates(number, label, word, size, needed, width) AS (VALUES {template_values()}),
hits AS (SELECT r, i, templates.* FROM words JOIN templates ON w[i] = word),
blocks AS (
    SELECT a.r, any_value(a.label) AS label, count(DISTINCT b.word) AS common, any_value(a.size) AS size, any_value(a.needed) AS needed
    FROM hits a JOIN hits b ON a.r = b.r AND a.number = b.number AND b.i >= a.i AND b.i < a.i + a.width
    GROUP BY a.r, a.number, a.i
),
met AS (
    SELECT r, list(DISTINCT label) AS labels, max(common / CAST(size AS DOUBLE)) AS share
    FROM blocks WHERE common >= needed GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
    array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(met.labels, [])))), ',') AS labels,
    CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN met USING (r)
"""


DISTANCE = "list_sum(list_transform(range(1, len(p) + 1), lambda i: (p[i] - c[i]) * (p[i] - c[i])))"


def nearest(name: str, centres: str) -> str:
    """Each vector's nearest centroid."""
    return f"""
{name} AS (
    SELECT r, any_value(vec_id) AS vec_id, any_value(p) AS p, min(d) AS distance, arg_min(k, d * 1000 + k) AS k
    FROM (SELECT r, vec_id, p, k, {DISTANCE} AS d FROM v, {centres}) GROUP BY r
)"""


def moved(name: str, assigned: str, centres: str) -> str:
    """Centroids after a round: floors of means, empty ones as they were."""
    return f"""
{name} AS (
    SELECT o.k, coalesce(m.c, o.c) AS c FROM {centres} o LEFT JOIN (
        SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
        FROM (
            SELECT k, i, sum(x) AS s, count(*) AS n
            FROM (SELECT k, unnest(p) AS x, unnest(range(1, len(p) + 1)) AS i FROM {assigned}) GROUP BY k, i
        ) GROUP BY k
    ) m USING (k)
)"""


def centroid_rounds(rounds: int) -> str:
    steps = []
    for i in range(rounds):
        steps += [nearest(f"a{i}", f"c{i}"), moved(f"c{i + 1}", f"a{i}", f"c{i}")]
    return ",".join([*steps, nearest("found", f"c{rounds}")])


CENTROIDS = f"""
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS p
    FROM embeddings
    WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {centroids.DIMENSIONS}
),
c0 AS (
    SELECT row_number() OVER (ORDER BY m, p) - 1 AS k, p AS c
    FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS m, p FROM v ORDER BY m, p LIMIT {centroids.CLUSTERS})
),{centroid_rounds(centroids.ROUNDS)}
SELECT vec_id, CAST(found.k AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
    CAST(sum(distance) OVER (PARTITION BY found.k) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM found JOIN c{centroids.ROUNDS} USING (k)
"""
