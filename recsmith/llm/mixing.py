"""Soft-membership mixing of documents to target domain weights.

A naive Bayes classifier learned from a labelled table gives every document its posterior over
the domains.  ``rates`` then fits one nonnegative rate per document by projected-gradient least
squares, such that the expected tokens per domain (rate x tokens x posterior, summed) match the
target weights, staying as close to rate 1 as the targets allow.

Only DataFrame functions are used.  The rate of a document depends on its posterior alone, so
the iterations run over the cells of a posterior grid (``GRID`` steps per domain: a fixed number
of cells, whatever the number of documents).  Posteriors are exact; the grid only says which
documents share a rate, and a cell holds its tokens and the sums of tokens x exact posterior, so
the totals are those of the documents.  Each iteration is one distributed sum, and only one number
per domain comes back.  The learned word list is bounded
(``VOCABULARY``) and fitted on a bounded sample of labelled rows (``MAX_SAMPLE``).

Defined results: a null or empty text has no tokens, its posterior is that of a text without any
word, and its copies follow its rate; without labelled rows the posterior is uniform; a
domain without any expected tokens cannot be matched and is left out of the fit (so is one whose
target is missing); repeated rows are mixed each on their own (their copies differ only if their
columns do); an empty table gives no rows; repeated labels of one id count once; input columns
named like an output column are replaced.  A very long text is read whole, in time linear in its length.

Copies are the whole part of the rate and one more for some documents.  Who gets one more is drawn
in strata (leading domain, length, fraction of the rate): the strata of a domain, ordered by length,
share out the expected number of further copies by running sums, and in a stratum the documents of
smallest hash get them.  So the totals of a domain miss the expected ones by a few documents at most,
however few carry it.  A stratum is counted in ``BINS`` slices of the hash, so counting needs no order of
the rows and the strata are a small table of fixed size, whatever the number of documents.  Rows
of one id share one hash and get the same number of copies if their columns are equal.  The fit
ends when its misses stand still, or after ``ROUNDS``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.session import materialise

MAX_SAMPLE = 10_000   # labelled rows that the classifier is fitted on, at most
VOCABULARY = 400      # words and traits of the classifier, at most
MIN_DOCS = 5          # sample documents that hold a listed word, at least
MARKER = 3            # times its overall share that a word must have in a domain to mark it
GRID = 500            # posterior steps of a cell
ANCHOR = 1e-3         # weight of staying near rate 1
ROUNDS = 60
CUT_EVERY = 10        # rounds between two written cell tables
BINS = 1024           # slices of a document's hash in which a stratum is counted
LENGTHS = 60          # length levels of strata (half powers of two), at most
FRACTIONS = 10        # levels of a rate's fraction

DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.97, "poor": 0.02, "toxic": 0.01}


def label_domain() -> Column:
    """Domain of a row of ``labels``; null where it has none."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor"))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def _level(name: str, value: Column, top: int) -> Column:
    return F.concat(F.lit(f"\x00{name}"), F.least(F.floor(value), F.lit(top)).cast("string"))


def traits(text: Column, ws: Column) -> Column:
    """Binned traits of a text, named so that they clash with no word: how often words repeat
    (by length), how long they are, and how many signs there are."""
    n = F.greatest(F.size(ws), F.lit(1))
    size = F.least(F.floor(F.log2(n.cast("double"))), F.lit(12))
    distinct = F.size(F.array_distinct(ws)) / n
    long = (F.length(text) - n + 1) / n
    signs = F.regexp_count(text, F.lit("[!#*$%&|<>]"))
    return F.array(_level("d", size * 10 + F.least(distinct * 10, F.lit(9.0)), 139),
                   _level("m", F.greatest(F.coalesce(long, F.lit(0.0)), F.lit(0.0)), 12),
                   _level("x", F.coalesce(signs, F.lit(0)) / n * 8, 16))


class Classifier:
    """Naive Bayes over listed words and traits that a text has: ``prior`` holds the log scores of
    the domains, ``weight[feature]`` what each listed feature adds to them."""

    def __init__(self, domains: list[str], prior: list[float], weight: dict[str, list[float]]):
        self.domains, self.prior, self.weight = domains, prior, weight

    def log_scores(self, places: Column) -> list[Column]:
        """Log score of each domain (not normalised), given the places of a text's distinct listed
        features in ``weight``."""
        def score(first: float, column: Column) -> Column:
            return F.aggregate(places, F.lit(first), lambda a, at: a + F.element_at(column, at))

        return [score(p, F.array(*[F.lit(v[i]) for v in self.weight.values()]).cast("array<double>"))
                for i, p in enumerate(self.prior)]


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        domains: tuple[str, ...] = DOMAINS, rows: int = MAX_SAMPLE, size: int = VOCABULARY) -> Classifier:
    """Fit the classifier on ``labelled`` (id, domain): the ids of smallest hash, at most ``rows``
    of them, which bounds the broadcast."""
    ids = (labelled.filter(F.col("domain").isin(*domains) & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg(F.max("domain").alias("domain"))
           .orderBy(F.xxhash64("id"), "id").limit(rows))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    texts = texts.select("domain", "text", words(F.col("text")).alias("words"))
    sample = materialise(texts.select("domain", F.concat(traits(F.col("text"), F.col("words")),
                                                         F.array_distinct("words")).alias("words")))
    totals = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    n = sum(totals.values())
    k = len(domains)
    prior = [math.log((totals.get(d, 0) + 1) / (n + k)) for d in domains]
    if not n:
        return Classifier(list(domains), prior, {})
    counts = [F.sum((F.col("domain") == d).cast("long")).alias(f"n{i}") for i, d in enumerate(domains)]
    per_word = (sample.select("domain", F.explode("words").alias("word")).groupBy("word")
                .agg(F.count("*").alias("n"), *counts).filter(F.col("n") >= MIN_DOCS))
    # chi-squared of word and domain
    share = F.col("n") / F.lit(float(n))
    chi = sum((((F.col(f"n{i}") - share * totals.get(d, 0)) ** 2) / (share * totals.get(d, 0) * (1 - share) + 1e-9)
               for i, d in enumerate(domains) if totals.get(d, 0)), F.lit(0.0))
    trait = F.col("word").startswith("\x00")
    best = per_word.withColumn("chi", chi).orderBy(~trait, F.desc("chi"), "word").limit(size).collect()
    weight = {}
    for r in best:
        p = [(r[f"n{i}"] + 0.5 * r["n"] / n) / (totals.get(d, 0) + 0.5) for i, d in enumerate(domains)]
        weight[r["word"]] = [math.log(x / (r["n"] / n)) for x in p]
        if max(p) > MARKER * r["n"] / n and not r["word"].startswith("\x00"):
            # a marker of one domain: its absence speaks as well
            absent = [math.log((1 - min(x, 0.999)) / (1 - r["n"] / n)) for x in p]
            prior = [a + b for a, b in zip(prior, absent)]
            weight[r["word"]] = [a - b for a, b in zip(weight[r["word"]], absent)]
    return Classifier(list(domains), prior, weight)


def memberships(df: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` (words) and the exact ``posterior``, one number per domain."""
    listed = F.array(*[F.lit(w) for w in model.weight]).cast("array<string>")
    taken = {"n_tokens", "posterior", "_words", "_text", "_places", "_scores"}
    rest = [f"`{c}`" for c in df.columns if c.lower() not in taken]
    # one projection per step: a step that is used more than once is not evaluated again
    base = df.select(*rest, F.col(text_col).alias("_text"), words(F.col(text_col)).alias("_words"))
    base = base.select(*rest, F.size("_words").cast("long").alias("n_tokens"),
                       F.concat(traits(F.col("_text"), F.col("_words")), "_words").alias("_words"))
    places = F.transform(F.array_intersect("_words", listed), lambda w: F.array_position(listed, w).cast("int"))
    base = base.select(*rest, "n_tokens", places.alias("_places"))
    base = base.select(*rest, "n_tokens", F.array(*model.log_scores(F.col("_places"))).alias("_scores"))
    score = [F.col("_scores")[i] for i in range(len(model.domains))]
    share = [1 / sum((F.exp(F.least(b - a, F.lit(700.0))) for b in score), F.lit(0.0)) for a in score]
    return base.select(*rest, "n_tokens", F.array(*share).alias("posterior"))


def cell_of(posterior: Column) -> Column:
    """The grid cell of a posterior."""
    return F.transform(posterior, lambda x: F.round(x * GRID) / GRID)


def rates(member: DataFrame, domains: list[str], targets: dict[str, float], budget: float | None = None) -> DataFrame:
    """(posterior, rate) of every grid cell (``cell_of``).  ``budget``: wanted tokens in all; by
    default as many as there are with the first domain kept as it is."""
    k = len(domains)
    held = [F.sum(F.col("n_tokens") * F.col("posterior")[i]).alias(f"held{i}") for i in range(k)]
    cells = materialise(member.groupBy(cell_of(F.col("posterior")).alias("posterior"))
                        .agg(F.sum("n_tokens").cast("double").alias("tokens"), *held).withColumn("rate", F.lit(1.0)))
    # mean posterior of a cell's tokens
    p = [F.when(F.col("tokens") > 0, F.col(f"held{i}") / F.col("tokens")).otherwise(F.col("posterior")[i])
         for i in range(k)]

    def totals(df: DataFrame) -> list[float]:
        row = df.agg(*[F.coalesce(F.sum(F.col("rate") * F.col(f"held{i}")), F.lit(0.0)) for i in range(k)]).first()
        return list(row)

    mass = totals(cells)
    if budget is None:
        first = targets.get(domains[0])
        budget = mass[0] / first if first else sum(mass)
    fitted = [mass[i] > 0 and d in targets for i, d in enumerate(domains)]
    want = [targets.get(d, 0.0) * budget for d in domains]
    step = 1 / (1 + ANCHOR)
    now, last = mass, None
    for i in range(ROUNDS):
        miss = [(now[j] - want[j]) / mass[j] if fitted[j] else 0.0 for j in range(k)]
        if last is not None and max(abs(a - b) for a, b in zip(miss, last)) < 1e-5:
            break
        last = miss
        slope = sum((x * m for x, m in zip(p, miss)), F.lit(0.0)) + ANCHOR * (F.col("rate") - 1)
        cells = cells.withColumn("rate", F.greatest(F.lit(0.0), F.col("rate") - step * slope))
        if (i + 1) % CUT_EVERY == 0:
            cells = materialise(cells)
        now = totals(cells)
    return materialise(cells.select("posterior", "rate"))


def strata(rated: DataFrame, id_col: str) -> DataFrame:
    """``rated`` with ``_part`` (fraction of the rate), ``_draw`` (hash of the id, 0 to 1) and its stratum."""
    lead = F.array_position("posterior", F.array_max("posterior")).cast("int")
    level = F.least(F.floor(2 * F.log2(F.col("n_tokens") + 1.0)), F.lit(LENGTHS)).cast("int")
    draw = F.pmod(F.xxhash64(F.lit("mix"), F.col(id_col)), F.lit(1 << 40)) / float(1 << 40)
    out = rated.select("*", (F.col("rate") - F.floor("rate")).alias("_part"), draw.alias("_draw"), lead.alias("_lead"),
                       level.alias("_level"))
    return out.withColumn("_tenth", F.floor(F.col("_part") * FRACTIONS).cast("int"))


STRATUM = ("_lead", "_level", "_tenth")


def draw_limits(rows: DataFrame) -> DataFrame:
    """``STRATUM`` and ``_limit``: documents of a stratum whose draw is below it get one copy more.

    ``rows`` as ``strata`` gives them.  At most domains x (``LENGTHS`` + 1) x ``FRACTIONS`` rows come out."""
    bins = (rows.filter("_part > 0").groupBy(*STRATUM, F.floor(F.col("_draw") * BINS).alias("_bin"))
            .agg(F.count(F.lit(1)).alias("_n"), F.sum("_part").alias("_want")))
    # the strata of a domain share out the expected copies by running sums, longest documents first
    order = Window.partitionBy("_lead").orderBy(F.desc("_level"), "_tenth")
    upto = F.sum("_want").over(order.rowsBetween(Window.unboundedPreceding, 0))
    wanted = bins.groupBy(*STRATUM).agg(F.sum("_want").alias("_want")).select(*STRATUM, "_want", upto.alias("_upto"))
    share = wanted.select(*STRATUM, F.greatest(F.floor(F.col("_upto") + 0.5) - F.floor(F.col("_upto") - F.col("_want") + 0.5),
                                               F.lit(0)).alias("_copies"))
    held = F.sum("_n").over(Window.partitionBy(*STRATUM).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    ends = bins.select(*STRATUM, ((F.col("_bin") + 1) / float(BINS)).alias("_end"), held.alias("_held")).join(share, list(STRATUM))
    best = ends.groupBy(*STRATUM).agg(F.max("_copies").alias("_copies"), F.min(
        F.struct(F.abs(F.col("_held") - F.col("_copies")).alias("miss"), F.col("_end").alias("end"))).alias("_best"))
    limit = F.when(F.col("_copies") <= F.col("_best.miss"), F.lit(0.0)).otherwise(F.col("_best.end"))
    return best.select(*STRATUM, limit.alias("_limit"))


def mix(df: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        domains: tuple[str, ...] = DOMAINS, targets: dict[str, float] = TARGETS,
        budget: float | None = None, keep_text: bool = True) -> DataFrame:
    """``df`` with n_tokens, posterior, rate and copies.  Copies: the whole part of the rate, and
    one more where a hash of the id lies below the limit of the document's stratum."""
    model = fit(df, labelled, id_col, text_col, domains)
    member = memberships(df, model, text_col)
    member = materialise(member if keep_text else member.drop(text_col))
    cell = rates(member, list(domains), targets, budget)
    taken = {"rate", "copies", "_part", "_draw", "_limit", *STRATUM}
    member = member.select(*[f"`{c}`" for c in member.columns if c.lower() not in taken])
    rated = member.join(cell, cell_of(member["posterior"]) == cell["posterior"]).drop(cell["posterior"])
    drawn = strata(rated, id_col)
    # a fixed number of strata bounds the broadcast
    limits = F.broadcast(materialise(draw_limits(drawn.select("_part", "_draw", *STRATUM))))
    out = drawn.join(limits, list(STRATUM), "left")
    more = (F.col("_part") > 0) & (F.col("_draw") < F.coalesce("_limit", F.lit(0.0)))
    kept = [f"`{c}`" for c in rated.columns]
    return out.select(*kept, (F.floor("rate") + more.cast("long")).cast("long").alias("copies"))
