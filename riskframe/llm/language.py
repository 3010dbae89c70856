"""Language identification by fusing evidence in Bayes' manner.

The posterior of a language is proportional to the product of

* the likelihood of the text under the language's model of byte trigrams, tempered because neighbouring
  trigrams are not independent,
* the likelihood of the language that the markup declares, and that of the address suffix, both from
  smoothed counts over the whole corpus (a declared language may be a careless default),
* the prior of the host: counts of the host are smoothed towards its domain's, these towards all hosts'.

Counts come from grouped aggregations of what the text alone says; a row's own vote is left out of its
host's counts. Missing evidence is a factor of one. The text models are fitted on at most ``max_samples``
labelled documents, chosen by a hash of their id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch, stage
from riskframe.llm.rendering import language as declared_language
from riskframe.llm.rendering import render
from riskframe.llm.urls import host as url_host
from riskframe.operators.skew import splittable

MAX_SAMPLES = 20_000
SLOTS = 1 << 16
#: So many trigrams count in full; more count by their logarithm.
FULL = 100.0
#: Weight, in rows, of the parent's distribution in a smoothed one.
STRENGTH = 4.0


@dataclass
class TextModel:
    languages: list[str]
    weights: np.ndarray  # slots x languages, ln P(trigram | language)

    def likelihood(self, text: str | None) -> np.ndarray:
        """Tempered log-likelihood of a text for every language."""
        found = slots(text)
        if not len(found):
            return np.zeros(len(self.languages))
        total = np.zeros(len(self.languages))
        for at in range(0, len(found), 65536):
            total += self.weights[found[at : at + 65536]].sum(axis=0, dtype=np.float64)
        n = len(found)
        told = n if n <= FULL else FULL * (1 + np.log(n / FULL))
        return total / n * told


def slots(text: str | None) -> np.ndarray:
    """Hashed byte trigrams of the text in lower case, digits left out."""
    raw = np.frombuffer(f" {text or ''} ".lower().encode(), np.uint8)
    raw = raw[(raw < ord("0")) | (raw > ord("9"))].astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_samples: int = MAX_SAMPLES) -> TextModel:
    """Trigram models of all languages among the sampled labels; null labels and texts are left out."""
    some = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    some = some.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    some = some.join(_sample(some, max_samples), "id", "left_semi")
    schema = "lang string, slot long, n long"

    def run(batches: Batches) -> Batches:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total.setdefault(lang, np.zeros(SLOTS, np.int64))
                total[lang] += np.bincount(slots(text), minlength=SLOTS)
        for lang, count in total.items():
            there = np.flatnonzero(count)
            yield batch(arrow_type(schema), ([lang] * len(there), there, count[there]))

    counted = some.select("lang", "text").mapInArrow(run, schema).groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    table: dict[str, np.ndarray] = {}
    for r in counted.toLocalIterator():  # at most SLOTS rows for each language
        table.setdefault(r["lang"], np.zeros(SLOTS))[r["slot"]] = r["n"]
    names = sorted(table)
    weights = [np.log((table[n] + 0.5) / (table[n].sum() + 0.5 * SLOTS)) for n in names]
    return TextModel(names, np.array(weights, np.float32).T.copy() if names else np.zeros((SLOTS, 0), np.float32))


def _sample(rows: DataFrame, bound: int) -> DataFrame:
    """The ids of the sample: bounded, hence small beside the rows."""
    return stage(rows.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(bound), "sample")


def page_evidence(pages: DataFrame, model: TextModel, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, declared, host, likelihood) of pages: visible text, the root element's language and the address."""
    schema = "id long, host string, declared string, likelihood array<double>"

    def run(batches: Batches) -> Batches:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                source = part.column(2).to_pylist()
                yield batch(arrow_type(schema), (part.column(0), part.column(1), [declared_language(h) for h in source], [model.likelihood(render(h)[1]) for h in source]))

    address = url_host(F.col(url_col).cast("string"))
    narrow = pages.select(F.col(id_col).cast("long").alias("id"), F.when(address != "", address).alias("host"), F.col(html_col).cast("string").alias("html"))
    return narrow.mapInArrow(run, schema)


def text_evidence(docs: DataFrame, model: TextModel, *, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None) -> DataFrame:
    """The same of plain texts; ``host`` may name what they come from, nothing is declared."""
    schema = "id long, host string, declared string, likelihood array<double>"

    def run(batches: Batches) -> Batches:
        for b in batches:
            found = [model.likelihood(t) for t in b.column(2).to_pylist()]
            yield batch(arrow_type(schema), (b.column(0), b.column(1), [None] * b.num_rows, found))

    host = F.lit(None) if host is None else host
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), host.cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, schema)


def fuse(evidence: DataFrame, model: TextModel) -> DataFrame:
    """(id, lang, confidence, text_lang, declared, host) from rows (id, host, declared, likelihood).

    A row without any evidence gets the language of most rows; ties go to the first language in order. With no
    languages at all ``lang`` and ``confidence`` are null. Repeated rows stay repeated and vote as often.
    """
    names = model.languages
    n = len(names)
    if not n:
        return evidence.select("id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    languages = F.array(*map(F.lit, names))
    top = F.array_max("likelihood")
    ours = evidence.withColumn("vote", F.when(top != F.array_min("likelihood"), F.array_position("likelihood", top).cast("int") - 1))
    ours = ours.withColumn("suffix", F.when(F.col("host").contains("."), F.substring_index("host", ".", -1)))
    ours = ours.withColumn("domain", F.when(F.col("host").isNotNull(), F.substring_index("host", ".", -2)))
    rows = stage(ours, "evidence")
    voters = rows.filter("vote is not null")
    tally = lambda: F.array(*[F.count_if(F.col("vote") == i).cast("double") for i in range(n)])
    everywhere = voters.agg(tally().alias("n")).first()["n"]
    share = np.array(everywhere) + 1.0
    share = share / share.sum()
    overall = F.array(*[F.lit(float(x)) for x in share])
    all_votes = F.array(*[F.lit(float(x)) for x in everywhere])

    def counts(key: str) -> DataFrame:
        # Rebalanced so that a join splits a popular key.
        found = voters.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{key}")).agg(tally().alias(f"{key}_n"))
        return splittable(found)

    for key in ("declared", "suffix", "domain", "host"):
        table = counts(key)
        rows = rows.join(table, F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}")
    own = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(F.col("vote") == i, 1.0).otherwise(0.0))
    zero = F.array(*[F.lit(0.0)] * n)
    less = lambda name: F.zip_with(F.coalesce(name, zero), "own", lambda c, o: F.greatest(c - o, F.lit(0.0)))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    rows = rows.withColumn("own", own)
    for key in ("domain", "host"):
        rows = rows.withColumn(f"{key}_n", less(f"{key}_n")).withColumn(f"{key}_t", total(F.col(f"{key}_n")))
    smooth = lambda name, parent: F.zip_with(f"{name}_n", parent, lambda c, p: (c + STRENGTH * p) / (F.col(f"{name}_t") + STRENGTH))
    rows = rows.withColumn("domain_p", smooth("domain", overall)).withColumn("prior", smooth("host", F.col("domain_p")))
    # P(sign | language): the sign's share of the language's votes, smoothed by its share of all votes.
    for key in ("declared", "suffix"):
        of_all = total(F.col(f"{key}_n")) / float(max(1.0, sum(everywhere)))
        told = F.zip_with(f"{key}_n", all_votes, lambda c, t: F.log((c + STRENGTH * of_all) / (t + STRENGTH)))
        rows = rows.withColumn(f"{key}_l", F.when(F.col(f"{key}_n").isNotNull() & (of_all > 0), told).otherwise(zero))
    parts = F.arrays_zip("likelihood", F.col("prior").alias("prior"), "declared_l", "suffix_l")
    rows = rows.withColumn("sum", F.transform(parts, lambda x: x["likelihood"] + F.log(x["prior"]) + x["declared_l"] + x["suffix_l"]))
    best = F.array_max("sum")
    weight = total(F.transform("sum", lambda x: F.exp(x - best)))
    return rows.select(
        "id",
        F.element_at(languages, F.array_position("sum", best).cast("int")).alias("lang"),
        (1.0 / weight).alias("confidence"),
        F.element_at(languages, F.col("vote") + 1).alias("text_lang"),
        "declared",
        "host",
    )
