"""URL filter: host and path rules, and a character language model for what no rule decides.

Two variable-order Markov models, one of accepted and one of rejected URLs, predict each character from the
``ORDER`` characters before it; a context's estimate is blended with that of the next shorter one in the
Witten-Bell manner, so rare contexts lean on short ones. The filter is the mean log-likelihood difference per
character, against a threshold calibrated on URLs that the models have not seen.

Characters are mapped to 32 symbols. That bounds the counts by 2 x 32**(ORDER + 1) whatever the number of
URLs; they are summed in Spark over all labelled URLs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch

ORDER = 3
SYMBOLS = 32
FOLDS = 5
#: The rules of the registered query as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CODE = np.full(256, 31)
_CODE[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CODE[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_CODE[ord("0") : ord("9") + 1] = 27
for _i, _c in enumerate(b"./-"):
    _CODE[_c] = 28 + _i


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without it."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def decide(host_col: Column, path_col: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, owner, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_col == owner) | host_col.endswith("." + owner)) & path_col.startswith(start)
        found = F.when(fits, F.struct(F.lit(owner + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def symbols(url: str | None) -> np.ndarray:
    """Symbols of a URL without its scheme."""
    rest = (url or "").partition("://")[2]
    return _CODE[np.frombuffer(rest.encode(), np.uint8)]


def grams(text: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Each symbol with the ``order`` symbols before it as one number; 0 stands before the first."""
    padded = np.concatenate((np.zeros(order, np.int64), text))
    code = np.zeros(len(text), np.int64)
    for k in range(order + 1):
        code = code * SYMBOLS + padded[k : k + len(text)]
    return code


def counts(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(rejected, gram, n) over rows (url, rejected); tasks add up before the shuffle."""
    schema = "rejected boolean, gram long, n long"

    def run(batches: Batches) -> Batches:
        size, out = SYMBOLS ** (order + 1), arrow_type(schema)
        total = np.zeros((2, size), np.int64)
        for b in batches:
            for url, bad in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                np.add.at(total[int(bad)], grams(symbols(url), order), 1)
        for bad in (0, 1):
            there = np.flatnonzero(total[bad])
            for at in range(0, len(there), 50_000):
                some = there[at : at + 50_000]
                yield batch(out, ([bool(bad)] * len(some), some, total[bad][some]))

    return urls.mapInArrow(run, schema).groupBy("rejected", "gram").agg(F.sum("n").alias("n"))


def log_likelihood(total: np.ndarray, order: int = ORDER) -> np.ndarray:
    """ln P(symbol | context) for all grams, blended over orders from counts of full grams."""
    estimate = np.full(SYMBOLS, 1 / SYMBOLS)
    for k in range(order + 1):
        # Counts of the last k context symbols and the symbol.
        here = total.reshape(-1, SYMBOLS**k, SYMBOLS).sum(axis=0).astype(float)
        seen, kinds = here.sum(axis=1, keepdims=True), (here > 0).sum(axis=1, keepdims=True)
        shorter = np.tile(estimate.reshape(-1, SYMBOLS), (SYMBOLS if k else 1, 1))[: SYMBOLS**k]
        whole = np.maximum(seen + kinds, 1)
        estimate = np.where(seen > 0, (here + kinds * shorter) / whole, shorter)
    return np.log(estimate).reshape(-1)


def mean_difference(url: str | None, table: np.ndarray, order: int = ORDER) -> float | None:
    """Mean log-likelihood difference (rejected less accepted) per character; None for nothing to judge."""
    found = grams(symbols(url), order)
    return float(table[found].mean()) if len(found) else None


def train(urls: DataFrame, order: int = ORDER) -> tuple[np.ndarray, float]:
    """(difference table, threshold) from rows (url, rejected).

    One fold of ``FOLDS`` is kept for calibration: the threshold makes the sum of both error shares least.
    If a class is missing nothing is ever rejected.
    """
    fold = F.pmod(F.xxhash64("url"), F.lit(FOLDS)) == 0
    total = np.zeros((2, SYMBOLS ** (order + 1)), np.int64)
    for r in counts(urls.filter(~fold).select("url", "rejected"), order).toLocalIterator():
        total[int(r["rejected"]), r["gram"]] = r["n"]
    if not total.any(axis=1).all():
        return np.zeros(total.shape[1], np.float32), np.inf
    table = (log_likelihood(total[1], order) - log_likelihood(total[0], order)).astype(np.float32)
    schema = "rejected boolean, bin int"

    def run(batches: Batches) -> Batches:
        for b in batches:
            scores = [mean_difference(u, table, order) for u in b.column(0).to_pylist()]
            yield batch(arrow_type(schema), (b.column(1), [int(np.clip(np.floor((s or 0.0) * 200), -2000, 2000)) for s in scores]))

    bins = urls.filter(fold).select("url", "rejected").mapInArrow(run, schema).groupBy("rejected", "bin").count().collect()
    shape = np.zeros((2, 4002))
    for r in bins:
        shape[int(r["rejected"]), r["bin"] + 2000] += r["count"]
    share = shape / np.maximum(shape.sum(axis=1, keepdims=True), 1)
    # Rejecting bins from k on: accepted ones there, and rejected ones below, are errors.
    wrong = share[0][::-1].cumsum()[::-1] + np.concatenate(([0], share[1].cumsum()[:-1]))
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return table, float((best[len(best) // 2] - 2000) / 200)


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = ORDER) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, score): every row with its rule's verdict, else the models'.

    ``score`` is the mean log-likelihood difference less the threshold; a URL at or above zero that no rule
    decides is blocked. Null URLs and those without ``://`` have nothing that speaks against them: score null,
    allowed. Repeated rows count as often as they occur.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    rows = rows.withColumn("found", decide(F.col("host"), F.col("path"), rules))
    labelled = rows.filter("found is not null").select("url", (F.col("found.verdict") == "block").alias("rejected"))
    table, threshold = train(labelled, order)
    schema = "page_id long, url string, host string, path string, rule string, ruled string, score double"

    def run(batches: Batches) -> Batches:
        for b in batches:
            scores = [mean_difference(u, table, order) for u in b.column(1).to_pylist()]
            yield batch(arrow_type(schema), (*b.columns, [None if s is None else s - threshold for s in scores]))

    scored = rows.select("page_id", "url", "host", "path", "found.rule", F.col("found.verdict").alias("ruled")).mapInArrow(run, schema)
    own = F.when(F.col("score") >= 0, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("ruled", own)).drop("ruled")
