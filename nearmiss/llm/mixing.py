"""Mixing documents to target weights of softly assigned domains.

A naive Bayes classifier, fitted on a labelled table, gives every document posteriors
over domains. Each document gets a rate, the times it is to be taken. The rates are the
nonnegative least-squares fit of the expected tokens of each domain to its target,
found by projected gradient descent. All of it is DataFrame operations; a step of the
descent is one aggregate, of which a number for each domain comes back.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearmiss.llm.common import cut

#: Labelled documents the classifier is fitted on, the first by a hash of the id.
TRAINING_DOCUMENTS = 6000
#: Terms it looks at, those that tell most, and in how many training documents each must be.
TERMS, TERM_DOCUMENTS = 200, 5
#: A term counts as a marker of a domain if it is so many times as frequent there as in all
#: documents. Others say more about a document's length and language than about its domain.
LIFT = 2.5
#: One labelled document in so many is kept out of the fit; the posteriors are calibrated on these.
KEPT_OUT = 3
#: The descent ends at this mismatch of every domain, relative to the domain, or after so many
#: passes over the documents; after so many the rates are written down.
TOLERANCE, PASSES, STORED = 1e-4, 40, 15
#: Pull of the rates to 1 that the queries use: weights are met within about a hundredth of a
#: domain's tokens where posteriors allow it.
PULL = 0.01
#: Gradient steps a pass starts with and the most it can take, as powers of 4.
FIRST_STEPS, MOST_STEPS = 2, 6

#: Runs of letters are terms, and so are each of these marks and how often words repeat.
MARKS = "#*$%&|<>!"
#: Thai to Burmese, Khmer, kana and Han: scripts written without spaces.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"



@dataclass
class DomainModel:
    """Log odds of a naive Bayes classifier over the presence of terms. A domain's calibrated
    score is ``scale`` times its log odds and its ``shift``."""

    domains: list[str]
    prior: list[float]
    weights: dict[str, list[float]]  # term -> for each domain
    scale: float = 1.0
    shift: list[float] = field(default_factory=list)  # none: 0 for each domain


def terms(text: Column) -> Column:
    """Runs of letters of a text in lower case, as an array with repetitions."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), "")


def marks(text: Column) -> Column:
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{MARKS}]+", ""), "")


def repetition(words: Column) -> Column:
    """How often a word comes on average, as a term: its half powers of 2. A blank in it sets it
    apart from words."""
    often = F.size(words) / F.size(F.array_distinct(words))
    level = F.floor(2 * F.log2(often)).cast("string")
    return F.when(F.size(words) > 0, F.array(F.concat(F.lit("repeats "), level))).otherwise(F.array().cast("array<string>"))


def token_count(text: Column, words: Column) -> Column:
    """Tokens of a text with these ``terms``: runs of letters and runs of digits; in a script
    written without spaces every further letter of a run is one too."""
    others = rf"\p{{Nd}}+|[{UNSPACED}](?=[{UNSPACED}])"
    return (F.size(words) + F.regexp_count(F.coalesce(text, F.lit("")), F.lit(others))).cast("long")


def fit_domains(
    documents: DataFrame, labelled: DataFrame, *, id_col="doc_id", text_col="text", domain_col="domain",
    n_documents: int = TRAINING_DOCUMENTS, n_terms: int = TERMS,
) -> DomainModel:
    """The classifier fitted on ``labelled`` (``id_col``, ``domain_col``).

    Null ids and domains don't count; of several domains of one id the smallest does, of several
    rows of one id that with the smallest hash of its text. One id in KEPT_OUT is not fitted on
    but calibrates the posteriors (``calibrated``); a domain that all ids of are kept out doesn't
    count. The driver gets ``n_terms`` rows of counts, and of each kept-out document its scores.
    Without labelled documents there are no domains.
    """
    chosen = (
        labelled.select(F.col(id_col).cast("long").alias("doc_id"), F.col(domain_col).cast("string").alias("domain"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("domain").alias("domain"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(n_documents)
    )
    slim = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = cut(
        slim.join(F.broadcast(chosen), "doc_id")  # n_documents ids at most
        .groupBy("doc_id")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("domain").alias("domain"))
        .withColumn("_terms", terms(F.col("text")))
        .select(
            "domain", token_count(F.col("text"), F.col("_terms")).alias("n_tokens"),
            F.array_distinct(F.concat("_terms", marks(F.col("text")), repetition(F.col("_terms")))).alias("terms"),
            (F.pmod(F.xxhash64(F.lit("kept out"), "doc_id"), F.lit(KEPT_OUT)) == 0).alias("kept_out"),
        )
    )
    kept_out, found = found.filter("kept_out"), found.filter("NOT kept_out")
    sizes = {r.domain: r.n for r in found.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    domains = sorted(sizes)
    if not domains:
        return DomainModel([], [], {})
    total = sum(sizes.values())
    counted = (
        found.select("domain", F.explode("terms").alias("term"))
        .filter("term != ''")
        .groupBy("term")
        .agg(F.count("*").alias("n"), *(F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(domains)))
        .filter(F.col("n") >= TERM_DOCUMENTS)
    )

    def gain(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    tells = F.lit(0.0)  # the likelihood ratio statistic of a term and the domains
    for k, d in enumerate(domains):
        n = F.col(f"n{k}")
        share = F.lit(sizes[d] / total)
        tells = tells + gain(n, F.col("n") * share) + gain(F.lit(sizes[d]) - n, (F.lit(total) - F.col("n")) * share)
    marks_one = F.lit(False)
    for k, d in enumerate(domains):
        marks_one = marks_one | (F.col(f"n{k}") * total >= F.lit(LIFT) * F.col("n") * sizes[d])
    best = counted.filter(marks_one).orderBy(tells.desc(), "term").limit(n_terms).collect()
    prior = [math.log((sizes[d] + 1) / (total + len(domains))) for d in domains]
    weights = {}
    for r in best:
        shares = [(r[f"n{k}"] + 0.5) / (sizes[d] + 1) for k, d in enumerate(domains)]
        prior = [p + math.log(1 - s) for p, s in zip(prior, shares)]
        weights[r.term] = [math.log(s) - math.log(1 - s) for s in shares]
    return calibrated(DomainModel(domains, prior, weights), kept_out)


def calibrated(model: DomainModel, kept_out: DataFrame) -> DomainModel:
    """The model with the scale and shifts under which the posteriors of kept-out documents fit
    their labels best, by their tokens.

    ``kept_out``: ``domain``, ``n_tokens`` and the distinct ``terms`` of each document, a bounded
    number. Multinomial logistic regression by Newton's method; its score equations make the
    expected tokens of each domain those of the labels. A unit ridge keeps it near the model as
    fitted where documents are few.
    """
    n = len(model.domains)
    present = F.array_intersect("terms", known_terms(model))
    rows = [
        (float(r.n_tokens), model.domains.index(r.domain), [r[f"s{k}"] for k in range(n)])
        for r in kept_out.filter(F.col("domain").isin(model.domains) & (F.col("n_tokens") > 0))
        .select("domain", "n_tokens", *(s.alias(f"s{k}") for k, s in enumerate(scores(model, present))))
        .collect()
    ]
    if n < 2 or not rows:
        return model
    mean = sum(w for w, _, _ in rows) / len(rows)
    rows = [(w / mean, d, s) for w, d, s in rows]
    before = [1.0] + [0.0] * n

    def posterior(x: list[float], s: list[float]) -> tuple[list[float], float]:
        z = [x[0] * v + b for v, b in zip(s, x[1:])]
        top = max(z)
        e = [math.exp(v - top) for v in z]
        return [v / sum(e) for v in e], top + math.log(sum(e))

    def loss(x: list[float]) -> float:
        ridge = sum((a - b) ** 2 for a, b in zip(x, before)) / 2
        return ridge + sum(w * (posterior(x, s)[1] - x[0] * s[d] - x[1 + d]) for w, d, s in rows)

    x, now = before, loss(before)
    for _ in range(50):
        slope = [a - b for a, b in zip(x, before)]
        curve = [[float(i == j) for j in range(n + 1)] for i in range(n + 1)]
        for w, d, s in rows:
            p = posterior(x, s)[0]
            m = sum(a * b for a, b in zip(p, s))
            slope[0] += w * (m - s[d])
            curve[0][0] += w * (sum(a * b * b for a, b in zip(p, s)) - m * m)
            for k in range(n):
                slope[1 + k] += w * (p[k] - (k == d))
                cross = w * p[k] * (s[k] - m)
                curve[0][1 + k] += cross
                curve[1 + k][0] += cross
                for j in range(n):
                    curve[1 + k][1 + j] += w * (p[k] * (k == j) - p[k] * p[j])
        move, size = solved(curve, slope), 1.0
        while True:
            new = [a - size * b for a, b in zip(x, move)]
            after = loss(new)
            if after <= now or size < 1e-6:
                break
            size /= 2
        done = now - after <= 1e-9 * (1 + now)
        x, now = (new, after) if after <= now else (x, now)
        if done:
            break
    return replace(model, scale=x[0], shift=x[1:])


def solved(matrix: list[list[float]], right: list[float]) -> list[float]:
    """The solution of a small positive definite system, by elimination."""
    rows = [[*r, b] for r, b in zip(matrix, right)]
    for i, own in enumerate(rows):
        for other in rows[i + 1 :]:
            f = other[i] / own[i]
            for j in range(i, len(own)):
                other[j] -= f * own[j]
    out = [0.0] * len(right)
    for i in reversed(range(len(rows))):
        out[i] = (rows[i][-1] - sum(rows[i][j] * out[j] for j in range(i + 1, len(out)))) / rows[i][i]
    return out


def known_terms(model: DomainModel) -> Column:
    return F.array(*(F.lit(t) for t in model.weights)) if model.weights else F.array().cast("array<string>")


def scores(model: DomainModel, present: Column) -> list[Column]:
    """The log score of each domain, from the array of the model's terms that are present."""

    def score(k: int) -> Column:
        start = F.lit(float(model.prior[k]))
        if not model.weights:
            return start
        odds = F.create_map(*(F.lit(x) for term, w in model.weights.items() for x in (term, float(w[k]))))
        return F.aggregate(present, start, lambda sum_so_far, term: sum_so_far + F.try_element_at(odds, term))

    return [score(k) for k in range(len(model.domains))]


def domain_table(
    documents: DataFrame, model: DomainModel, *, id_col="doc_id", text_col="text", carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, n_tokens, p0, p1, ...`` of every row, by its whole text, and the columns ``carry``."""
    text = F.col(text_col).cast("string")
    carried = [F.col(c).alias(f"_carry_{c}") for c in carry]
    words = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), *carried, terms(text).alias("_terms"), marks(text).alias("_marks"),
        text.alias("_text"),
    )
    seen = words.select(
        "doc_id", *(f"_carry_{c}" for c in carry), token_count(F.col("_text"), F.col("_terms")).alias("n_tokens"),
        F.array_intersect(F.concat("_terms", "_marks", repetition(F.col("_terms"))), known_terms(model)).alias("_present"),
    )
    shift = model.shift or [0.0] * len(model.domains)
    scored = seen.withColumns(
        {f"_s{k}": F.lit(model.scale) * s + F.lit(shift[k]) for k, s in enumerate(scores(model, F.col("_present")))}
    ).drop("_present")
    names = [f"_s{k}" for k in range(len(model.domains))]
    top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    exps = {f"_e{k}": F.exp(F.col(n) - top) for k, n in enumerate(names)}
    total = sum((F.col(e) for e in exps), F.lit(0.0))
    shares = {f"p{k}": F.col(f"_e{k}") / total for k in range(len(names))}
    return scored.withColumns(exps).withColumns(shares).drop(*names, *exps)


def domain_targets(totals: Sequence[float], weights: Sequence[float], epochs: float | None = None) -> list[float]:
    """Target tokens of each domain: its weight of one total that all domains share.

    The total is that of all tokens there are, so a domain shorter than its weight gets rates
    above 1. With ``epochs`` it is made smaller until no domain needs more than so many rounds
    over what it has. Domains without tokens get none; the others share their weight.
    """
    live = [w if t > 0 else 0.0 for t, w in zip(totals, weights)]
    whole = sum(live)
    if whole <= 0:
        return list(totals)
    common = sum(totals)
    if epochs is not None:
        common = min(common, *(epochs * t * whole / w for t, w in zip(totals, live) if w > 0))
    return [w / whole * common for w in live]


def fit_rates(
    soft: DataFrame, n_domains: int, targets: Sequence[float], totals: Sequence[float], pull: float = 0.0
) -> DataFrame:
    """A ``domain_table`` with the ``rate`` of each row and the ``mismatch`` that is left: the
    largest difference of a domain's expected tokens from its target, as a share of all targets.

    Minimises the sum over domains of mismatch^2 / tokens over all nonnegative rates, from
    rate 1 on, and ``pull`` times the sum over rows of tokens * (rate - 1)^2. Targets that
    posteriors can't meet are met the worse the farther they are from the totals at rate 1; without a
    pull whatever mismatch can be lowered is, even if nearly all rows get rate 0 for it.

    Measured by tokens, the first sum's largest curvature is exactly 1 (the
    posteriors of a row add up to 1), so the gradient step is 1 / (1 + pull). A step only depends
    on the mismatches of the steps before, so rates are worked out anew in each aggregate and
    written down only every STORED passes.

    A pass also sums the products of posteriors of the rows whose rate isn't 0. While no rate
    reaches 0 they say what mismatch every further step meets, so a pass takes many gradient
    steps at once and projects then: more of them where the loss fell, fewer, from the rates
    before, where it did not. It ends when all targets are met, when the most steps of a pass led
    to just the totals foreseen, when a single step gains less than a thousandth of what
    is left, or after PASSES.
    """
    live = [k for k in range(n_domains) if totals[k] > 0]
    whole = sum(targets) or 1.0
    step, keep = 1 / (1 + pull), 1 / (1 + pull)  # a step leaves ``keep`` of a rate's distance from 1
    rate, best, power, foreseen, taken = F.lit(1.0), None, FIRST_STEPS, None, 0
    for _ in range(PASSES):
        now, tokens = F.col("_now"), F.col("n_tokens")
        p = {k: F.col(f"p{k}") for k in live}
        free = tokens * (now > 0).cast("double")
        sums = soft.withColumn("_now", rate).agg(
            F.sum(tokens * (now - 1) * (now - 1)).alias("apart"),
            *(F.sum(tokens * now * p[k]).alias(f"t{k}") for k in live),
            *(F.sum(free * p[k]).alias(f"u{k}") for k in live),
            *(F.sum(free * p[k] * p[j]).alias(f"h{k}_{j}") for k in live for j in live if j <= k),
        ).first()
        met = {k: sums[f"t{k}"] for k in live}
        off = {k: (met[k] - targets[k]) / totals[k] for k in live}
        loss = sum(totals[k] * off[k] ** 2 for k in live) + pull * sums["apart"]
        gains = best is None or best[1] - loss > 1e-3 * best[1]
        as_foreseen = foreseen and power == MOST_STEPS and all(abs(met[k] - foreseen[k]) <= TOLERANCE * totals[k] for k in live)
        if best is None or loss < best[1]:
            best = (rate, loss, off, met, sums)
        if max(map(abs, best[2].values()), default=0.0) <= TOLERANCE or as_foreseen or (not gains and power == 0):
            break
        if taken:
            power = min(power + 2, MOST_STEPS) if gains else max(power - 2, 0)
        old, _, _, foreseen, known = best
        share, change = 1.0, dict.fromkeys(live, 0.0)
        for _ in range(4**power):
            ahead = {k: (foreseen[k] - targets[k]) / totals[k] for k in live}
            change = {k: keep * change[k] + step * ahead[k] for k in live}
            moved = {k: sum(known[f"h{max(k, j)}_{min(k, j)}"] * ahead[j] for j in live) for k in live}
            foreseen = {k: foreseen[k] - step * (moved[k] + pull * (foreseen[k] - known[f"u{k}"])) for k in live}
            share *= keep
        away = F.lit(share) * (old - 1.0) - sum((p[k] * F.lit(float(change[k])) for k in live), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), 1.0 + away)
        taken += 1
        if taken % STORED == 0:
            plain = [c for c in soft.columns if c not in ("rate", "_before")]
            soft = cut(soft.select(*plain, rate.alias("rate"), old.alias("_before")))
            rate, best = F.col("rate"), (F.col("_before"), *best[1:])
    left = max((abs(best[2][k]) * totals[k] for k in live), default=0.0) / whole
    return soft.withColumn("rate", best[0]).drop("_before").withColumn("mismatch", F.lit(float(left)))


def mix(
    documents: DataFrame, labelled: DataFrame, weights: Mapping[str, float], *, epochs: float | None = None,
    pull: float = 0.0, id_col="doc_id", text_col="text", domain_col="domain", carry: Sequence[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Rates of all rows of ``documents`` and the domains in the order of ``p0, p1, ...``:
    ``doc_id, n_tokens, p0, ..., rate, mismatch`` (what the fit leaves, ``fit_rates``) and the
    columns ``carry`` as ``_carry_<name>``.

    ``weights``: target weight of each domain; 0 for one not named. Rates above 1 make up for
    a domain shorter than its weight; with ``epochs`` less of all domains is taken instead
    (``domain_targets``). ``pull`` keeps rates near 1 where weights can't be met (``fit_rates``). A null text has no
    tokens and the posteriors of a text without terms. Without labelled documents, or any
    tokens, every rate is 1 and no mismatch is left. Repeated rows stay repeated, null ids stay null, an empty
    table gives no rows; equal documents get equal rates.
    """
    model = fit_domains(documents, labelled, id_col=id_col, text_col=text_col, domain_col=domain_col)
    if not model.domains:
        text = F.col(text_col).cast("string")
        plain = documents.select(
            F.col(id_col).cast("long").alias("doc_id"), *(F.col(c).alias(f"_carry_{c}") for c in carry),
            token_count(text, terms(text)).alias("n_tokens"), F.lit(1.0).alias("rate"), F.lit(0.0).alias("mismatch"),
        )
        return plain, []
    n = len(model.domains)
    soft = cut(domain_table(documents, model, id_col=id_col, text_col=text_col, carry=carry))
    sums = soft.agg(*(F.sum(F.col("n_tokens") * F.col(f"p{k}")).alias(f"t{k}") for k in range(n))).first()
    totals = [float(sums[f"t{k}"] or 0.0) for k in range(n)]
    wanted = [float(weights.get(d, 0.0)) for d in model.domains]
    if sum(wanted) <= 0 or sum(totals) <= 0:
        return soft.withColumns({"rate": F.lit(1.0), "mismatch": F.lit(0.0)}), model.domains
    return fit_rates(soft, n, domain_targets(totals, wanted, epochs), totals, pull), model.domains


def draws(rate: Column, *keys: str | Column) -> Column:
    """How often a row with this rate is taken: the rate rounded to hundredths, up or down by
    a hash of the keys, so that the expected number is the rate to a hundredth and a rate of about
    1 leaves no row out. Rates below a half stay as they are, as hundredths are too coarse for them."""
    even = F.pmod(F.xxhash64(*keys), F.lit(1 << 32)) / F.lit(float(1 << 32))
    return F.floor(F.when(rate < 0.5, rate).otherwise(F.round(rate, 2)) + even).cast("int")


def quality_domains(labels: DataFrame, *, id_col="doc_id") -> DataFrame:
    """Domains of a labels table: ``toxic``, else ``low`` quality, else ``good``."""
    return labels.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good").alias("domain"),
    )
