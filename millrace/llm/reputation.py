"""URL filters: rules first, then empirical-Bayes reputation of hosts.

The outcome of a page is the quality label of the document whose text it shows; pages and
documents meet by a hash of their blocks. Outcomes are counted per host and shrunk in steps:
the suffix towards all hosts, the registered domain towards its suffix, the host towards its
domain. Each step is a beta-binomial prior whose strength is estimated by moments from how
much the groups of that level differ. A host is blocked if the upper bound of its posterior
share of good pages stays under a threshold, so hosts with few or no outcomes pass.

The registered domain is the last two labels of a host and the suffix the last one; for suffixes
of two labels that sites are registered under, as co.uk, they are the last three and the last
two. An address in numbers is a domain of its own, and all of them share a suffix. Ports and
user names do not count there. Urls are read whole, however long. Urls that are null or lack ``://`` have an empty host and
path, fit no rule, and are judged like any host by what is known of pages without one. With
no outcomes at all every host has the prior share and passes. Rows keep their number; only
key, url and the text asked for are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, once, whole
from millrace.operators.joins import join_with_heavy_keys
from millrace.workspace import materialize

#: (host, path, verdict)
Rule = tuple[str, str, str]
#: Prior share of good pages without any outcome, and least and largest prior strengths.
PRIOR_SHARE, LEAST_STRENGTH, MOST_STRENGTH = 0.5, 1.0, 1000.0
# Suffixes of two labels under which sites are registered.
SHARED_SUFFIXES = """
    ac.uk co.uk gov.uk ltd.uk me.uk net.uk org.uk plc.uk sch.uk
    com.au edu.au gov.au id.au net.au org.au
    ac.nz co.nz govt.nz net.nz org.nz
    ac.jp ad.jp co.jp ed.jp go.jp gr.jp lg.jp ne.jp or.jp
    com.br edu.br gov.br net.br org.br
    com.ar edu.ar gob.ar com.mx edu.mx gob.mx org.mx com.co edu.co com.pe com.ve com.uy com.ec
    ac.in co.in edu.in gov.in net.in org.in
    ac.za co.za gov.za org.za
    com.cn edu.cn gov.cn net.cn org.cn com.tw edu.tw org.tw com.hk edu.hk org.hk com.sg edu.sg
    ac.kr co.kr go.kr or.kr
    com.tr edu.tr gov.tr org.tr com.pl edu.pl gov.pl net.pl org.pl com.ua gov.ua com.ru
    ac.il co.il org.il com.my com.ph co.th in.th com.vn co.id or.id com.pk com.bd com.np com.lk
    com.sa com.eg com.ng co.ke or.ke com.gh com.es nom.es org.es com.pt com.gr
""".split()

#: Deviations of the bound, and the share below which a host is blocked.
DEVIATIONS, LEAST_SHARE = 1.645, 0.5


def with_address(pages: DataFrame, keep: list[str], url: str = "url") -> DataFrame:
    """The columns to keep with ``host``, ``path``, ``domain`` and ``suffix``."""
    text = whole(F.col(url).cast("string"))
    whole_url = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    parts = pages.select(*keep, once(
        host=ascii_lower(F.regexp_extract(text, whole_url, 1)), path=F.regexp_extract(text, whole_url, 2)
    ).alias("p")).select(*keep, "p.host", "p.path")
    name = F.regexp_replace("host", r"^.*@|:[0-9]*$", "")
    three, two, one = (F.regexp_extract(name, rf"([^.]+\.){{0,{n}}}[^.]*\.?$", 0) for n in (2, 1, 0))
    numeric = name.rlike(r"^[0-9]+(\.[0-9]+){3}$|^\[")
    shared = F.rtrim(two, F.lit(".")).isin(SHARED_SUFFIXES)
    return parts.withColumns({
        "domain": F.when(numeric, name).when(shared, three).otherwise(two),
        "suffix": F.when(numeric, F.lit("number")).when(shared, two).otherwise(one),
    })


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, word in sorted(rules, key=lambda rule: len(rule[0] + rule[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        text = F.when(fits, F.lit(name + start)).otherwise(text)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return text, verdict


def block_hash(blocks: Column) -> Column:
    """Hash of blocks whose white space is evened out; empty ones do not count."""
    even = F.transform(blocks, lambda b: F.trim(F.regexp_replace(b, r"\s+", " ")))
    return F.sha2(F.array_join(F.array_remove(even, ""), "\n"), 256)


def outcomes(texts: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(page, good)`` for pages of ``texts(page, text)`` that show a labelled document, either as
    their whole text or below a headline, their first block. Texts without words show nothing."""
    worded = docs.where(F.col("text").rlike(r"\S"))
    known = worded.select("doc_id", block_hash(F.split(F.col("text"), "\n")).alias("hash")).join(
        labels.select("doc_id", F.col("quality").cast("double").alias("quality")).where("quality in (0, 1)"), "doc_id"
    )
    by_text = known.groupBy("hash").agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    blocks = F.split(F.col("text"), "\n")
    below = block_hash(F.slice(blocks, F.lit(2), F.size(blocks)))
    shown = texts.where(F.col("text").rlike(r"\S")).select(
        "page", F.posexplode(F.array(block_hash(blocks), below)).alias("below", "hash")
    )
    # Pages of one text may be many. Stored, since counting heavy hashes must not read the pages again.
    met = join_with_heavy_keys(materialize(shown, "shown"), by_text, ["hash"], spread=["page", "below"])
    return met.groupBy("page").agg(F.min_by("good", "below").alias("good"))


def strength(groups: DataFrame) -> Column:
    """Moment estimate of the strength of the prior that ``groups(n, good, mean)`` were drawn from."""
    n, share, mean = F.col("n"), F.col("good") / F.col("n"), F.col("mean")
    spread = F.sum(n * (share - mean) * (share - mean) / (mean * (1 - mean)))
    freedom = F.count("*") - 1
    weight = F.sum(n) - F.sum(n * n) / F.sum(n) - freedom
    between = F.when(weight > 0, (spread - freedom) / weight)
    bounded = F.greatest(F.least(between, F.lit(0.5)), F.lit(1 / (MOST_STRENGTH + 1)))
    return F.when(between.isNull(), F.lit(MOST_STRENGTH)).otherwise(1 / bounded - 1)


def level(counts: DataFrame, name: str, parents: DataFrame | None, above: str | None, mean: float) -> tuple[DataFrame, float]:
    """``(name, n, good, mean)`` of one level, shrunk towards its parents, and the strength used."""
    keys = [name] if above is None else [name, above]
    groups = counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    if parents is None:
        groups = groups.withColumn("mean", F.lit(mean))
    else:
        groups = groups.join(parents.select(above, "mean"), above)
    groups = materialize(groups, f"level-{name}")
    found = groups.where("n > 0").agg(strength(groups).alias("s")).first()["s"]
    weight = max(LEAST_STRENGTH, float(found))
    shrunk = groups.withColumn("mean", (F.col("good") + weight * F.col("mean")) / (F.col("n") + weight))
    return shrunk, weight


def reputations(addresses: DataFrame, known: DataFrame) -> DataFrame:
    """``(host, n, good, mean, bound)`` for each host of ``addresses(page, host, domain, suffix)``."""
    judged = addresses.join(known, "page", "left")
    counts = materialize(
        judged.groupBy("host", "domain", "suffix").agg(
            F.count("good").cast("double").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good")
        ),
        "hosts",
    )
    total = counts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    # One good and one bad page more keep the share away from 0 and 1.
    mean = ((total["good"] or 0.0) + 2 * PRIOR_SHARE) / ((total["n"] or 0.0) + 2)
    suffixes, _ = level(counts, "suffix", None, None, mean)
    domains, _ = level(counts, "domain", suffixes, "suffix", mean)
    hosts, weight = level(counts, "host", domains, "domain", mean)
    size = F.col("n") + weight
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))
    return hosts.select("host", "n", "good", "mean", F.least(F.lit(1.0), F.col("mean") + DEVIATIONS * deviation).alias("bound"))


def judge(
    pages: DataFrame, texts: DataFrame, docs: DataFrame, labels: DataFrame, rules: list[Rule],
    key: str = "page_id", url: str = "url",
) -> DataFrame:
    """``(key, host, path, rule, verdict, n_outcomes, share, bound)`` for each page.

    ``texts``: key and ``text`` of pages.
    """
    addresses = materialize(
        with_address(pages.select(F.col(key).alias("page"), F.col(url)), ["page"], url), "addresses"
    )
    known = outcomes(texts.select(F.col(key).alias("page"), "text"), docs, labels)
    found = reputations(addresses.select("page", "host", "domain", "suffix"), known)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") < LEAST_SHARE, F.lit("block")).otherwise(F.lit("allow"))
    # A common host, or none at all, may hold most pages.
    return join_with_heavy_keys(addresses, found, ["host"], spread=["page", "path"]).select(
        F.col("page").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        F.col("n").cast("long").alias("n_outcomes"), F.col("mean").alias("share"), "bound",
    )
