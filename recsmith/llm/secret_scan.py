"""Secret scanning: fixed patterns, and a battery of randomness tests for unknown tokens.

Only DataFrame functions are used.  The base patterns (assign, access, hex) are found leftmost and
without overlap per kind.  Beyond them, every run of at least ``MIN_LENGTH`` token characters that
touches no base match is a candidate.  The tightest alphabet that holds all of a candidate's characters
is its inferred encoding; against it, three tests are made:

* chi-squared of the character counts against a uniform alphabet,
* runs of the character classes (capitals, small letters, digits; a capital that begins a word of small
  letters belongs to it, and signs belong to no class),
* lag-one serial correlation of the characters' places in the alphabet.

The hypothesis to reject is "ordinary writing" in that alphabet: letters drawn as in running text, few
capitals among small letters, few digits and signs.  Under it the chi-squared sum is large, class
changes are few, and places far from the alphabet's middle follow each other; the three z-values are
combined (Stouffer) into a p-value that shrinks with length.  A candidate that is not uniform either (any
test further than ``MAX_Z`` from a random token's expectation) is out before anything is counted.  False
discoveries are held to ``RATE`` by the weighted Benjamini-Hochberg procedure over all distinct candidates
left, with weights in proportion to length: a long token has more power, and gets more of the budget.  The
procedure's threshold comes from a histogram of p-values with a fixed number of bins.  Random tokens of
letters of one case only cannot be told from words at these lengths and are not found.

Defined results: a null or empty text has no spans; positions are code points, end exclusive; an
added span never overlaps a base span; repeated rows are treated alike, each on its own; an
empty table gives no rows; other columns are ignored.  A very long text is cut by its matches once
per pattern, in time linear in its length.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsmith.session import materialise

MIN_LENGTH = 20
RATE = 0.01    # false discovery rate
MAX_Z = 4.0    # distance from uniform that a random token may show in any test
BIN = 0.05     # width of a bin of -log10(p)
BINS = 6400
KINDS = ("assign", "access", "hex", "random")

# The patterns.  Runs are maximal, so a length bound inside them equals dropping
# shorter matches; only assign needs its check afterwards.
PATTERNS = {
    "assign": """(?i)(password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{16,}+",
    "hex": "[0-9a-f]{24,}+",
    "random": f"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}+={{0,2}}",
}
# Relative frequency of letters in running text, a to z, in percent.
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1,
           2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
UPPER_SHARE, DIGIT_SHARE, SIGN_SHARE = 0.04, 0.02, 0.01
_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = (_DIGITS, _DIGITS + _LOWER[:6], _DIGITS + _LOWER[:6].upper(), _LOWER, _LOWER.upper(),
             _LOWER.upper() + "234567", _DIGITS + _LOWER, _DIGITS + _LOWER.upper(), _LOWER.upper() + _LOWER,
             _LOWER.upper() + _LOWER + _DIGITS, _LOWER.upper() + _LOWER + _DIGITS + "+/",
             _LOWER.upper() + _LOWER + _DIGITS + "-_", _LOWER.upper() + _LOWER + _DIGITS + "+/-_")


def writing(alphabet: str) -> list[float]:
    """Probability of each character of an alphabet in ordinary writing: letters by their frequency, few capitals
    where there are small letters, and fixed shares of digits and signs beside letters."""
    groups = [[c for c in alphabet if c in chars] for chars in (_LOWER, _LOWER.upper(), _DIGITS, "+/-_")]
    lower, upper, digits, signs = groups
    letters = bool(lower or upper)
    share = [0.0, UPPER_SHARE if lower and upper else float(letters and bool(upper)), 0.0, SIGN_SHARE if signs else 0.0]
    share[2] = (DIGIT_SHARE if letters else 1 - share[3]) if digits else 0.0
    rest = 1 - share[2] - share[3]
    share[1] *= rest
    share[0] = rest - share[1] if lower else 0.0
    of = {}
    frequency = dict(zip(_LOWER, LETTERS))
    for chars, part in zip(groups, share):
        weights = [frequency.get(c.lower(), 1.0) for c in chars]
        of.update({c: part * w / sum(weights) for c, w in zip(chars, weights)})
    return [of[c] for c in alphabet]


def class_changes(alphabet: str, q: list[float]) -> tuple[float, float]:
    """Mean and variance, per place, of the number of class changes in independent characters from ``q``."""
    share = [sum(p for c, p in zip(alphabet, q) if c in chars) for chars in (_LOWER.upper(), _LOWER, _DIGITS)]
    share = [x / sum(share) for x in share]
    upper, lower = 0, 1
    seen = lambda a, b: lower if (a, b) == (upper, lower) else a
    change = lambda a, b, c: seen(a, b) != seen(b, c)
    mean, both = 0.0, [0.0, 0.0, 0.0]  # product of changes at a distance of 0, 1 and 2 places
    for five in itertools.product(range(3), repeat=5):
        p = math.prod(share[x] for x in five)
        at = [change(*five[i:i + 3]) for i in range(3)]
        mean += p * at[0]
        for d in range(3):
            both[d] += p * (at[0] and at[d])
    return mean, max(0.0, both[0] - mean ** 2 + 2 * (both[1] - mean ** 2) + 2 * (both[2] - mean ** 2))


def expectations(alphabet: str) -> dict[str, float]:
    """What the battery must know of an alphabet: its size, the excess of the chi-squared sum per character under
    writing, class changes under writing and for random characters, and the serial sum under writing."""
    q, k = writing(alphabet), len(alphabet)
    place = [i - (k - 1) / 2 for i in range(k)]
    unit = (k * k - 1) / 12
    first = sum(p * x for p, x in zip(q, place)) ** 2
    second = sum(p * x * x for p, x in zip(q, place))
    changes, spread = class_changes(alphabet, q)
    even, even_spread = class_changes(alphabet, [1 / k] * k)
    return {"k": float(k), "mass": k * sum(x * x for x in q) - 1, "changes": changes, "spread": spread, "even": even,
            "even_spread": even_spread, "serial": first / unit, "serial_0": (second ** 2 - first ** 2) / unit ** 2,
            "serial_1": 2 * (first * second - first ** 2) / unit ** 2}


def normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal, P(Z > z): its continued-fraction bound beyond 5, else the
    rational approximation of the error function with an error below 1.5e-7."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    tail = F.when(x > 5, density / (x + 1 / (x + 2 / (x + 3 / x)))).otherwise(density * poly)
    return F.when(z >= 0, tail).otherwise(1 - tail)


# --- spans ----------------------------------------------------------------------------

def occurrences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A written table (row, id, and per kind the matches and the lengths of the text between
    them) of every row; the text itself is read once and not kept."""
    found = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = found.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, p in PATTERNS.items()])
    # the text is cut (and the values are taken) only where there is a match
    between = [F.when(F.size(k) > 0, F.transform(F.split("text", p, -1), lambda s: F.length(s))).alias(f"{k}_between")
               for k, p in PATTERNS.items()]
    values = F.when(F.size("assign") > 0, F.transform(F.regexp_extract_all("text", F.lit(PATTERNS["assign"]), F.lit(2)),
                                                      lambda s: F.length(s))).alias("assign_values")
    return materialise(found.select("row", "id", *KINDS, *between, values))


def spans(found: DataFrame) -> DataFrame:
    """(row, kind number, start, end, token) of all matches that hold."""
    parts = []
    for number, k in enumerate(KINDS):
        rows = found.filter(F.size(k) > 0).select("row", F.posexplode(k).alias("i", "token"), f"{k}_between",
                                                  "assign_values" if k == "assign" else F.lit(None).alias("assign_values"))
        rows = rows.select("row", "i", "token", F.element_at(f"{k}_between", F.col("i") + 1).alias("gap"),
                           (F.element_at("assign_values", F.col("i") + 1) if k == "assign" else F.lit(99)).alias("value"))
        so_far = Window.partitionBy("row").orderBy("i")
        end = F.sum(F.col("gap") + F.length("token")).over(so_far)
        rows = rows.select("row", F.lit(number).alias("kind"), (end - F.length("token")).alias("start"), end.alias("end"),
                           "token", "value")
        parts.append(rows.filter("value >= 6").drop("value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialise(out)


# --- randomness battery ---------------------------------------------------------------

def free_candidates(every: DataFrame) -> DataFrame:
    """Candidates that overlap no base match of their row: what ends last among the base matches that begin before,
    and what begins first among those that begin later, decides."""
    random = KINDS.index("random")
    is_base = F.col("kind") != random
    before = Window.partitionBy("row").orderBy("start", "kind")
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"))
    seen = every.select("*", F.max(F.when(is_base, F.col("end"))).over(before).alias("until"),
                        F.min(F.when(is_base, F.col("start"))).over(after).alias("next"))
    clear = (F.coalesce("until", F.lit(0)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))
    return seen.filter(~is_base & clear).drop("until", "next")


def battery(tokens: DataFrame) -> DataFrame:
    """(token, n, p, looks_random) of distinct tokens: the p-value under writing, and whether no test is far from
    a random token's expectation."""
    body = F.rtrim(F.col("token"), F.lit("="))
    known = [expectations(a) for a in ALPHABETS]
    which = F.lit(None).cast("int")
    for i, a in reversed(list(enumerate(ALPHABETS))):
        which = F.when(F.length(F.translate("body", a, "")) == 0, i).otherwise(which)
    t = tokens.select("token", body.alias("body")).filter(F.length("body") >= MIN_LENGTH)
    t = t.select("token", "body", F.length("body").alias("n"), which.alias("which"), F.split("body", "").alias("chars"))
    of = {name: F.get(F.array(*[F.lit(x[name]) for x in known]), F.col("which")).alias(name) for name in known[0]}
    t = t.select("token", "body", "n", "chars", *of.values(), F.get(F.array(*map(F.lit, ALPHABETS)), F.col("which")).alias("alphabet"))
    t = t.select("*", F.transform("chars", lambda c: F.position(c, F.col("alphabet")) - 1).alias("x"))
    squares = F.aggregate(F.array_distinct("chars"), F.lit(0.0), lambda s, c: s + F.pow(
        F.col("n") - F.length(F.replace(F.col("body"), c, F.lit(""))), F.lit(2)))
    first, second = F.slice("x", 1, F.col("n") - 1), F.slice("x", 2, F.col("n") - 1)
    middle = (F.col("k") - 1) / 2
    products = F.aggregate(F.zip_with(first, second, lambda a, b: (a - middle) * (b - middle)), F.lit(0.0),
                           lambda s, v: s + v)
    words = F.regexp_replace("body", "[A-Z](?=[a-z])", "a")
    classes = F.translate(words, _LOWER.upper() + _LOWER + _DIGITS + "+/-_", "u" * 26 + "l" * 26 + "d" * 10)
    t = t.select("token", "n", *known[0], (squares * F.col("k") / F.col("n") - F.col("n")).alias("chi"),
                 (products / ((F.col("k") * F.col("k") - 1) / 12.0)).alias("products"), classes.alias("classes"))
    runs = F.length(F.regexp_replace("classes", "u+|l+|d+", "r"))
    t = t.select("*", F.greatest(F.length("classes") - 1, F.lit(0)).alias("pairs"), F.greatest(runs - 1, F.lit(0)).alias("turns"))
    n, free, pairs = F.col("n"), F.col("k") - 1, F.col("pairs")
    # under writing: a noncentral chi-squared sum, few changes of class, and neighbours on one side of the middle
    chi_z = (F.col("chi") - (free + n * F.col("mass"))) / F.sqrt(2 * (free + 2 * n * F.col("mass")))
    turns_z = (F.col("turns") - pairs * F.col("changes")) / F.sqrt(pairs * F.col("spread") + 1)
    serial_z = (F.col("products") - (n - 1) * F.col("serial")) / F.sqrt((n - 1) * F.col("serial_0") + (n - 2) * F.col("serial_1"))
    # of random characters
    no_class = (F.col("even_spread") == 0) | (pairs == 0)
    even = [(F.pow(F.col("chi") / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free)),
            F.when(no_class, 0.0).otherwise((F.col("turns") - pairs * F.col("even")) / F.sqrt(pairs * F.col("even_spread"))),
            F.col("products") / F.sqrt(n - 1)]
    looks_random = F.lit(True)
    for z in even:
        looks_random = looks_random & (F.abs(z) <= MAX_Z)
    z = (-chi_z + turns_z - serial_z) / math.sqrt(3)
    return t.select("token", "n", normal_tail(z).alias("p"), looks_random.alias("looks_random"))


def discoveries(tested: DataFrame, rate: float = RATE) -> DataFrame:
    """Tokens of a written table (token, n, p, looks_random) that the weighted Benjamini-Hochberg procedure, over
    those that look random, rejects as ordinary writing."""
    tested = tested.filter("looks_random")
    m, mean = tested.agg(F.count("*"), F.avg("n")).first()
    if not m:
        return tested.select("token")
    p = F.col("p") / (F.col("n") / mean)
    level = F.least(F.greatest(F.floor(-F.log10(F.greatest(p, F.lit(1e-310))) / BIN), F.lit(0)), F.lit(BINS)).cast("int")
    binned = tested.select("token", level.alias("level"))
    counts = {r["level"]: r["n"] for r in binned.groupBy("level").agg(F.count("*").alias("n")).collect()}
    cut, at_least = None, 0
    for b in sorted(counts, reverse=True):
        at_least += counts[b]
        if 10 ** (-b * BIN) * m / at_least <= rate:
            cut = b
    return (binned.filter(F.col("level") >= cut) if cut is not None else binned.limit(0)).select("token")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per row of ``df``: id, the number of base spans per kind, the digest of the base
    spans, and all spans."""
    found = occurrences(df, id_col, text_col)
    every = spans(found)
    random = KINDS.index("random")
    candidates = free_candidates(every)
    tested = materialise(battery(candidates.select("token").distinct()))
    named = discoveries(tested, rate)
    base = every.filter(F.col("kind") != random).select("row", "kind", "start", "end")
    added = candidates.join(named, "token", "left_semi").select("row", "kind", "start", "end")
    item = F.struct("start", "kind", "end")
    rows = base.unionByName(added).groupBy("row").agg(F.sort_array(F.collect_list(item)).alias("s"))
    own = F.filter("s", lambda x: x["kind"] != random)
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda x: F.concat_ws(
            ":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")

    rows = rows.select("row", own.alias("own"), F.col("s").alias("all"))
    out = found.select("row", "id").join(rows, "row", "left")
    none = F.lit("")
    counts = [_count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:-1])]
    return out.select(F.col("id").alias(id_col), *counts, F.sha2(F.coalesce(joined(F.col("own")), none), 256).alias("base_sha256"),
                      F.coalesce(joined(F.col("all")), none).alias("spans"))


def _count(kind: int) -> Column:
    """Base spans of one kind."""
    return F.when(F.col("own").isNotNull(), F.size(F.filter("own", lambda x: x["kind"] == kind))).otherwise(0).cast("long")
