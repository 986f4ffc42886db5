"""Mixing sources to target weights by soft membership; DataFrame and SQL functions only.

A naive Bayes classifier over hashed words, counted on a labelled table, gives each document a posterior over the
domains; its temperature is fitted on labelled rows that weren't counted.  A document's rate is the expected number of its copies in the mixture.  The rates are the nonnegative solution that
projected-gradient least squares reaches from one copy of each document: the tokens that each domain is expected to get,
over the rates and posteriors, match the targets, errors counting in proportion to the domain's own tokens.

Each step changes a rate by the document's posterior times the domains' errors.  A step is one aggregation of all
documents, whose partial sums meet as one number for each domain.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, table, training_rows, written

#: Steps after which the rates are written.
STEPS_WRITTEN = 8
SPLIT = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Fit:
    """About `rows` labelled rows are learned from, by a hash of the text; of every `held`-th the words aren't counted, and
    the temperature is fitted on it."""

    rows: int = 20000
    buckets: int = 4096
    smoothing: float = 0.5
    held: int = 5


#: Temperatures tried: words of a text aren't independent, so its log odds count for less than they say.
TEMPERATURES = tuple(2.0 ** (-k / 2) for k in range(25))


@dataclass
class Classifier:
    """domains, sorted; odds[k]: log odds of each bucket in domain k + 1 against the first one; shares of the domains;
    scale: what log odds are multiplied by, the inverse of the temperature."""

    domains: list[str]
    odds: list[list[float]]
    shares: list[float]
    fit: Fit = Fit()
    scale: float = 1.0


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def _bucket(word: Column, fit: Fit) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(fit.buckets)).cast("int")


def learn(labelled: DataFrame, fit: Fit = Fit()) -> Classifier:
    """A classifier from rows (text, domain); rows with a null text or domain aren't used; without rows it has no domain.

    All domains of the rows are learned; the expression of the posteriors has fit.buckets numbers for each.
    """
    rows = labelled.where("text IS NOT NULL AND domain IS NOT NULL").select("text", F.col("domain").cast("string").alias("domain"))
    sizes = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains, total = sorted(sizes), sum(sizes.values())
    if not domains:
        return Classifier([], [], [], fit)
    share = min(1_000_000, math.ceil(1_000_000 * fit.rows / total))
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share)
    held = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(fit.held)) == 0
    words = sample.where(~held).select("domain", F.explode(_words(F.col("text"))).alias("word")).select("domain", _bucket(F.col("word"), fit).alias("bucket"))
    # At most domains times buckets counts come to the driver.
    counts = {(r.domain, r.bucket): r.n for r in words.groupBy("domain", "bucket").agg(F.count("*").alias("n")).toLocalIterator()}
    logs = []
    for d in domains:
        n = sum(counts.get((d, b), 0) for b in range(fit.buckets))
        logs.append([math.log((counts.get((d, b), 0) + fit.smoothing) / (n + fit.smoothing * fit.buckets)) for b in range(fit.buckets)])
    odds = [[round(x - y, 4) for x, y in zip(row, logs[0])] for row in logs[1:]]
    model = Classifier(domains, odds, [sizes[d] / total for d in domains], fit)
    return replace(model, scale=_temperature(sample.where(held), model)) if len(domains) > 1 else model


def _temperature(rows: DataFrame, model: Classifier) -> float:
    """The scale of the log odds under which the rows' own domains are likeliest; 1 without rows."""
    at = F.array_position(F.array(*map(F.lit, model.domains)), F.col("domain")).cast("int") - 1
    known = _log_odds(rows, model, "text", "_").select(F.col("_s").alias("s"), at.alias("at"))
    tried = known.select("*", F.explode(F.array(*map(F.lit, TEMPERATURES))).alias("t"))  # one plain expression for all of them
    tried = tried.select("t", "at", _logits(F.col("s"), model, F.col("t")).alias("z")).select("t", "at", "z", F.array_max("z").alias("top"))
    likely = F.get("z", F.col("at")) - F.col("top") - F.log(F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    found = {r.t: r.ll for r in tried.groupBy("t").agg(F.sum(likely).alias("ll")).collect()}
    return max((ll, t) for t, ll in found.items())[1] if found else 1.0


def _log_odds(docs: DataFrame, model: Classifier, text_col: str, prefix: str) -> DataFrame:
    """docs with prefix + tokens, the words of the text, and prefix + s, their summed log odds for each domain."""
    fit = model.fit
    out = docs.withColumn(prefix + "b", F.transform(_words(F.coalesce(F.col(text_col), F.lit(""))), lambda w: _bucket(w, fit)))

    def summed(row: list[float]) -> Column:
        odds = F.split(F.lit(",".join(map(str, row))), ",").cast("array<double>")  # one literal, folded before the query runs
        return F.aggregate(prefix + "b", F.lit(0.0), lambda a, b: a + F.get(odds, b))

    sums = F.array(F.lit(0.0), *[summed(row) for row in model.odds])
    return out.withColumn(prefix + "tokens", F.size(prefix + "b").cast("long")).withColumn(prefix + "s", sums).drop(prefix + "b")


def _logits(s: Column, model: Classifier, scale: float | Column) -> Column:
    return F.zip_with(s, F.array(*[F.lit(math.log(x)) for x in model.shares]), lambda a, p: a * scale + p)


def posteriors(docs: DataFrame, model: Classifier, text_col: str = "text", prefix: str = "_mix_") -> DataFrame:
    """docs with two more columns: prefix + tokens, the words of the text, and prefix + p, the posterior of each domain
    (its parts sum to 1).  Without a word the posterior is the domains' shares."""
    k = len(model.domains)
    if k < 2:
        return docs.withColumn(prefix + "tokens", F.size(_words(F.coalesce(F.col(text_col), F.lit("")))).cast("long")).withColumn(prefix + "p", F.array(*[F.lit(1.0)] * k).cast("array<double>"))
    out = _log_odds(docs, model, text_col, prefix).withColumn(prefix + "s", _logits(F.col(prefix + "s"), model, model.scale))
    top = F.array_max(prefix + "s")
    out = out.withColumn(prefix + "s", F.transform(prefix + "s", lambda s: F.exp(s - top)))
    total = F.aggregate(prefix + "s", F.lit(0.0), lambda a, s: a + s)
    return out.withColumn(prefix + "p", F.transform(prefix + "s", lambda s: s / total)).drop(prefix + "s")


def _dot(p: Column, g: Column, k: int) -> Column:
    return sum((F.get(p, F.lit(i)) * F.get(g, F.lit(i)) for i in range(1, k)), F.get(p, F.lit(0)) * F.get(g, F.lit(0)))


def _rate(p: Column, steps: list[list[float]], k: int, rate: Column | None = None) -> Column:
    """The rate after the steps: from 1 (or `rate`), each time less the posterior times the step, and not under 0."""
    rate = F.lit(1.0) if rate is None else rate
    if not steps:
        return rate
    return F.aggregate(F.lit(steps), rate, lambda r, g: F.greatest(F.lit(0.0), r - _dot(p, g, k)))


@dataclass
class Mixture:
    classifier: Classifier
    targets: list[float]  # tokens of each domain
    reached: list[float]
    steps: list[list[float]]

    @property
    def short(self) -> float:
        """The largest distance of a domain from its target, as a share of all tokens."""
        return max((abs(r - t) for r, t in zip(self.reached, self.targets)), default=0.0) / (sum(self.targets) or 1.0)


def fit_rates(known: DataFrame, model: Classifier, weights: Mapping[str, float] | None = None, most_steps: int = 500, tolerance: float = 1e-4, prefix: str = "_mix_") -> Mixture:
    """Rates for the rows of known (with the columns of `posteriors`), as the steps that lead to them.

    weights: domain -> share of all tokens; domains without one share what is left alike; no weights: all alike.  The steps end
    when all domains are within `tolerance` of all tokens of their targets, or when nothing changes any more: targets that no
    nonnegative rates reach, or whose domain isn't expected to have one token of the table, stay unmet, and `short` of the result
    says by how much.  Steps that haven't ended after
    `most_steps` are an error.
    """
    k = len(model.domains)
    groups = written(known.select(F.col(prefix + "p").alias("p"), F.col(prefix + "tokens").alias("tokens"), F.lit(1.0).alias("rate")))
    token = lambda r: [F.sum(F.col("tokens") * F.get("p", F.lit(i)) * r).alias(f"d{i}") for i in range(k)]
    own = [float(x or 0) for x in groups.agg(*token(F.lit(1.0))).first()] if k else []
    total = sum(own)
    given = {d: max(0.0, float(w)) for d, w in (weights or {}).items() if d in model.domains}
    free = [d for d in model.domains if d not in given]
    left = max(0.0, 1.0 - sum(given.values()))
    wanted = [given.get(d, left / len(free) if free else 0.0) for d in model.domains]
    norm = sum(wanted) or 1.0
    targets = [total * w / norm for w in wanted]
    steps, ahead, reached = [], [], own  # ahead: the steps that the written rates lack
    for _ in range(most_steps):
        errors = [r - t for r, t in zip(reached, targets)]
        # A domain that isn't expected to have one token can't be reached, and no document pulls towards it.
        step = [e / o if o >= 1 else 0.0 for e, o in zip(errors, own)]
        if not total or max(map(abs, errors), default=0.0) <= tolerance * total:
            break
        if len(ahead) == STEPS_WRITTEN:
            groups, ahead = written(groups.withColumn("rate", _rate(F.col("p"), ahead, k, F.col("rate")))), []
        ahead.append(step)
        new = [float(x or 0) for x in groups.agg(*token(_rate(F.col("p"), ahead, k, F.col("rate")))).first()]
        settled = sum(abs(a - b) for a, b in zip(new, reached)) <= tolerance * 0.01 * total
        steps, reached = [*steps, step], new
        if settled:
            break
    else:
        raise RuntimeError(f"rates did not settle in {most_steps} steps: {reached} of {targets} tokens")
    return Mixture(model, targets, reached, steps)


def rated(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: Mapping[str, float] | None = None, fit: Fit = Fit(), seed: int = 11) -> DataFrame:
    """id_col, n_tokens, domain (the likeliest), posteriors (by the sorted domains), rate and copies of each row of docs.

    copies is the rate rounded up with the chance of its fraction, drawn from a hash of the id and the text.  Null and
    empty texts have no tokens, the posterior of the domains' shares, and the rate that follows from it.  Without
    labelled rows there is no domain, and every rate is 1.  Repeated rows are rated alike; a null id stays null; an empty
    table gives an empty one; other columns are not read.  An id_col called like a result keeps its name, and the result
    gets an underscore behind.
    """
    model = learn(labelled, fit)
    known = written(posteriors(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model).withColumn("u", F.pmod(F.xxhash64("id", "text", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)).drop("text"))
    mixture = fit_rates(known, model, weights)
    k = len(model.domains)
    out = known.withColumn("rate", _rate(F.col("_mix_p"), mixture.steps, k))
    names = F.array(*map(F.lit, model.domains)) if k else F.lit(None).cast("array<string>")
    domain = F.get(names, (F.array_position("_mix_p", F.array_max("_mix_p")) - 1).cast("int")) if k else F.lit(None).cast("string")
    copies = (F.floor("rate") + (F.col("u") < F.col("rate") - F.floor("rate")).cast("long")).cast("long")
    return named(out.select("id", F.col("_mix_tokens").alias("n_tokens"), domain.alias("domain"), F.col("_mix_p").alias("posteriors"), "rate", copies.alias("copies")), id=id_col)


def mixed(docs: DataFrame, labelled: DataFrame, text_col: str = "text", id_col: str = "doc_id", weights: Mapping[str, float] | None = None, fit: Fit = Fit(), seed: int = 11) -> DataFrame:
    """The mixture: each row of docs as many times as its copies, all its columns as they are; rows at 0 copies go."""
    model = learn(labelled, fit)
    prefix = "mix_"
    while any(c.lower().startswith(prefix) for c in docs.columns):  # the columns of docs stay as they are
        prefix = "_" + prefix
    known = posteriors(docs, model, text_col, prefix)
    mixture = fit_rates(written(known.select(prefix + "tokens", prefix + "p")), model, weights, prefix=prefix)
    u = F.pmod(F.xxhash64(id_col, text_col, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    rate = F.col(prefix + "rate")
    out = known.withColumn(prefix + "rate", _rate(F.col(prefix + "p"), mixture.steps, len(model.domains)))
    out = out.withColumn(prefix + "n", (F.floor(rate) + (u < rate - F.floor(rate)).cast("long")).cast("int"))
    return out.withColumn(prefix + "i", F.explode(F.array_repeat(F.lit(0), F.col(prefix + "n")))).select(*[F.col(f"`{c}`") for c in docs.columns])


#: Shares of the tokens that the registered query and the pipeline aim at.
TARGETS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


def labelled_domains(spark, sf_dir: str, column: str = "lang") -> DataFrame:
    """(text, domain) of about Fit.rows documents that the labels table covers; the domain is what they are marked with in
    the column, the language or the source."""
    covered = table(spark, sf_dir, "labels").select("doc_id", F.lit(0).alias("label")).distinct()
    known = training_rows(table(spark, sf_dir, "documents").select("doc_id", "text", F.col(column).alias("domain")), covered, Fit.rows)
    return known.select("text", "domain")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    return rated(table(spark, sf_dir, "documents"), labelled_domains(spark, sf_dir), weights=TARGETS)
