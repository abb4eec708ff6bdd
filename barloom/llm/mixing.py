"""Operator 6: mixing sources to target weights by soft membership.

A naive Bayes classifier, counted on labelled rows, gives each document posteriors over the
domains. Nonnegative document rates are fitted by projected gradient least squares so that the
expected tokens of every domain (rate x tokens x posterior) meet the targets. Only DataFrame
functions are used; the driver sees a few numbers per domain.

The gradient is taken in the metric in which a document weighs as many as its tokens. A step
then changes a rate by the posteriors' mean of the domains' errors, so a document's rate follows
from its posteriors and the errors of the steps so far: no table of rates has to be kept.
"""

from __future__ import annotations

from collections.abc import Mapping
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.store import Store

#: Pieces of text whose counts the classifier sees; those of a lower-cased text, in bytes.
PIECES = ("é", "è", "ê", "ç", "ä", "ö", "ü", "ß", "ñ", "ó", "í", "th", "wh", "ei", "sch", "qu", "eau", "ción", "en", "on")

#: Counts beyond so many pieces weigh no more: posteriors of long texts stay soft.
EVIDENCE = 12.0

#: Steps at most; they end before when all errors, or a step's changes, are within TOLERANCE of the targets.
STEPS, TOLERANCE = 60, 1e-4


def tokens(text: Column) -> Column:
    """Words as white space parts them: blanks and line feeds plus one, 0 for no text."""
    plain = F.coalesce(text, F.lit(""))
    seps = sum((F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(c)))) for c in (" ", "\n"))
    return F.when(F.octet_length(plain) == 0, F.lit(0)).otherwise(seps + 1).cast("long")


def counts(text: Column) -> Column:
    plain = F.lower(F.coalesce(text, F.lit("")))
    return F.array(*(((F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(p)))) / len(p.encode())).cast("double") for p in PIECES))


class Classifier:
    """Multinomial naive Bayes over `PIECES`, as an expression."""

    def __init__(self, domains: list[str], priors: list[float], logs: list[list[float]]):
        self.domains, self.priors, self.logs = domains, priors, logs

    def with_posteriors(self, frame: DataFrame) -> DataFrame:
        """`frame` with a column p0, p1, ... for each domain, from its column `counts`.

        A text without any piece gets the priors. The steps are projections of their own, so
        that each is computed once a row.
        """
        own, size = [f"`{c}`" for c in frame.columns], range(len(self.domains))
        seen = F.col("counts")
        total = sum(seen[i] for i in range(len(PIECES)))
        frame = frame.select(*own, F.when(total > EVIDENCE, F.lit(EVIDENCE) / total).otherwise(F.lit(1.0)).alias("_scale"))
        rows = zip(self.priors, self.logs)
        frame = frame.select(*own, *((F.lit(p) + F.col("_scale") * sum(seen[i] * F.lit(w) for i, w in enumerate(row))).alias(f"_s{d}") for d, (p, row) in enumerate(rows)))
        top = F.greatest(*(F.col(f"_s{d}") for d in size)) if len(size) > 1 else F.col("_s0")
        frame = frame.select(*own, *(f"_s{d}" for d in size), top.alias("_top"))
        frame = frame.select(*own, *(F.exp(F.col(f"_s{d}") - F.col("_top")).alias(f"_e{d}") for d in size))
        frame = frame.select(*own, *(f"_e{d}" for d in size), sum(F.col(f"_e{d}") for d in size).alias("_sum"))
        return frame.select(*own, *((F.col(f"_e{d}") / F.col("_sum")).alias(f"p{d}") for d in size))


def learn(seen: DataFrame, labelled: DataFrame, domains: list[str]) -> Classifier:
    """A classifier from `seen` (doc_id, counts) and `labelled` (doc_id, domain).

    An id labelled twice counts for each label; unknown domains and null ids are left out.
    """
    rows = seen.join(labelled.where(F.col("domain").isin(domains)).select("doc_id", "domain").distinct(), "doc_id")
    sums = [F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(len(PIECES))]
    found = {r["domain"]: r for r in rows.groupBy("domain").agg(F.count("*").alias("n"), *sums).collect()}
    n = sum(r["n"] for r in found.values())
    priors, logs = [], []
    for d in domains:
        r = found.get(d)
        own = [(r[f"c{i}"] if r else 0.0) + 1.0 for i in range(len(PIECES))]
        priors.append(((r["n"] if r else 0) + 1) / (n + len(domains)))
        logs.append([x / sum(own) for x in own])
    return Classifier(domains, [log(p) for p in priors], [[log(x) for x in row] for row in logs])


class Rates:
    """Rates as an expression of posteriors: the steps' scaled errors, applied in turn."""

    def __init__(self, steps: list[list[float]], floor: float = 0.0):
        self.steps, self.floor = steps, floor

    def of(self, posteriors: list[Column]) -> Column:
        rate = F.lit(1.0)
        for step in self.steps:
            rate = F.greatest(F.lit(float(self.floor)), rate - sum(p * F.lit(float(e)) for p, e in zip(posteriors, step)))
        return rate


def fit_rates(members: DataFrame, targets: Mapping[str, float], budget: float | None = None, floor: float = 0.0) -> Rates:
    """Rates for `members` (n_tokens, p0, p1, ... in the order of `targets`).

    Targets are shares of `budget` tokens; without one, of the fewest tokens at which no domain
    has to lose any. Minimises the sum over domains of squared errors, each scaled by its
    domain's size, from rates of 1 with the step 1 / L, over rates of `floor` or more. Domains
    without tokens are let be.
    """
    weights = [float(w) for w in targets.values()]
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("targets must be nonnegative and not all 0")
    shares = [w / sum(weights) for w in weights]
    size = len(shares)
    p = [F.col(f"p{i}") for i in range(size)]
    n = F.col("n_tokens")
    gram = [[f"h{min(i, j)}_{max(i, j)}" for j in range(size)] for i in range(size)]
    first = members.agg(
        *(F.sum(n * p[i]).alias(f"s{i}") for i in range(size)), *(F.sum(n * p[i] * p[j]).alias(f"h{i}_{j}") for i in range(size) for j in range(i, size))
    ).first()
    start = [first[f"s{i}"] or 0.0 for i in range(size)]
    if sum(start) == 0:
        return Rates([], floor)
    live = [i for i in range(size) if start[i] > 0]
    budget = budget or max(start[i] / shares[i] for i in live if shares[i] > 0)
    goal = [share * budget for share in shares]
    scale = [1.0 / first[gram[i][i]] if i in live and first[gram[i][i]] else 0.0 for i in range(size)]
    # The largest row sum bounds the largest eigenvalue of the scaled Gram matrix.
    bound = max(sum(scale[i] * first[gram[i][j]] for j in live) for i in live)
    steps: list[list[float]] = []
    now = start
    for _ in range(STEPS):
        errors = [now[i] - goal[i] for i in range(size)]
        if all(abs(errors[i]) <= TOLERANCE * max(goal[i], TOLERANCE * budget) for i in live):
            break
        steps.append([errors[i] * scale[i] / bound for i in range(size)])
        got = members.withColumn("rate", Rates(steps, floor).of(p)).agg(*(F.sum(n * p[i] * F.col("rate")).alias(f"s{i}") for i in range(size))).first()
        last, now = now, [got[f"s{i}"] or 0.0 for i in range(size)]
        if all(abs(now[i] - last[i]) <= TOLERANCE * max(goal[i], TOLERANCE * budget) for i in live):
            # At the bound of the rates: further steps change nothing.
            break
    return Rates(steps, floor)


def copies(rate: Column, *key: Column) -> Column:
    """The rate rounded up or down, by a hash of the key, so that it is met in the mean."""
    chance = F.pmod(F.xxhash64(F.lit(6), *key), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("int")


def described(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, counts) of every row."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), tokens(F.col(text_column)).alias("n_tokens"), counts(F.col(text_column)).alias("counts"))


def mix(described_docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], budget: float | None = None, floor: float = 0.0) -> tuple[Classifier, Rates]:
    """The classifier and the rates for documents described by `described`.

    Null and empty texts have no tokens and the priors as posteriors. Repeated rows count as
    often as they occur. Rates of an empty table are 1. Ties can't occur: all is sums.
    """
    model = learn(described_docs, labelled, list(targets))
    members = model.with_posteriors(described_docs).select("n_tokens", *(f"p{i}" for i in range(len(targets))))
    return model, fit_rates(Store(described_docs.sparkSession, "mixing").put("members", members), targets, budget, floor)


def rated(described_docs: DataFrame, model: Classifier, rates: Rates) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>..., rate, copies) of every row."""
    p = [F.col(f"p{i}") for i in range(len(model.domains))]
    own = model.with_posteriors(described_docs)
    named = own.select("doc_id", "n_tokens", *(c.alias(f"p_{d}") for c, d in zip(p, model.domains)), rates.of(p).alias("rate"))
    return named.withColumn("copies", copies(F.col("rate"), F.col("doc_id")))


def repeated(docs: DataFrame, model: Classifier, rates: Rates, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs`, each as often as its rate says, with all their columns."""
    p = [F.col(f"p{i}") for i in range(len(model.domains))]
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    own = model.with_posteriors(docs.select(row, F.col(id_column).alias("key"), counts(F.col(text_column)).alias("counts")))
    times = own.select("row", copies(rates.of(p), F.col("key")).alias("times"))
    return times.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("row.*")
