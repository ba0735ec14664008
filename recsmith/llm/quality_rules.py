"""Quality rules by distribution divergence.

``measure`` counts, per document, the rule inputs and two histograms: character classes and
common (function) words.  ``judge`` sums the histograms of all documents that pass the base
rules into one reference per language and rejects a document whose Jensen-Shannon distance
to its nearest language reference is too large.  The allowed divergence grows for short texts
by the sampling noise to be expected there (the length guard).

A document whose language has no reference words (any value of the language column outside the
reference languages) is not measured against other languages: it is judged by its character
classes alone, against the sum of all documents of its own language that pass the base rules.

Defined results: a null text counts as empty (no words, base rules fail, not kept); a
document without a language is compared with every reference; where there is no reference (no
document of the language passes the base rules) the base rules decide alone.  Repeated rows are
judged alike, each on its own.  An input column named like an output column is replaced.  A very
long text is measured whole, in time linear in its length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsmith.llm.common import add_columns, row_udf, strings, structs
from recsmith.session import materialise

# Function words of the reference languages.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on with as be by this are at from or an he his not but have they",
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als auch es an werden aus er",
    "fr": "de la le et les des en un du une que est pour qui dans au sur par pas avec il ne se plus ce son je",
    "es": "de la que el en y los se del las un por con no una para su es al lo como más pero sus le ha me",
}
MIN_WORDS = 50            # base rule
REPEAT_PERCENT = 50       # base rule
MAX_CHAR_DISTANCE = 0.25  # Jensen-Shannon distance of character classes
MAX_WORD_DISTANCE = 0.32  # Jensen-Shannon distance of common words
BROADCAST_LANGUAGES = 10_000  # references that are broadcast (a megabyte), at most
SALTS = 64
NOISE_BINS = 10           # bins that a short text spreads over: sets the length guard
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "letter", "other")

_WORD_BINS = sorted({w for ws in COMMON_WORDS.values() for w in ws.split()})
N_WORD_BINS = len(_WORD_BINS) + 1
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_WS = " \t\n\v\f\r"


def _class_table() -> np.ndarray:
    """Class number of each code point up to U+024F; all later ones are letters if alphabetic."""
    table = np.full(0x110000, CLASSES.index("other"), dtype=np.uint8)
    for i in range(0x250):
        c = chr(i)
        if c in SYMBOLS:
            k = "symbol"
        elif c in _WS:
            k = "space"
        elif "0" <= c <= "9":
            k = "digit"
        elif c in ".,;:'\"-()":
            k = "stop"
        elif c.isupper():
            k = "upper"
        elif c.islower():
            k = "lower"
        elif c.isalpha():
            k = "letter"
        else:
            continue
        table[i] = CLASSES.index(k)
    table[0x250:0x20000] = [CLASSES.index("letter") if chr(i).isalpha() else CLASSES.index("other")
                            for i in range(0x250, 0x20000)]
    table[0x20000:0x30000] = CLASSES.index("letter")
    return table


def repeated_words(ids: np.ndarray) -> int:
    """Words inside any 3-word window that occurs at least twice."""
    n = len(ids) - 2
    if n < 2:
        return 0
    size = int(ids.max()) + 1
    if size < 2_000_000:
        key = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:
        _, pair = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)
        key = pair[:-1].astype(np.int64) * size + ids[2:]
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[k:k + n] |= twice
    return int(covered.sum())


def _setup():
    bins = {w: i for i, w in enumerate(_WORD_BINS)}
    return _class_table(), bins


def _measure(state, texts: pa.Array) -> pa.Array:
    table, bins = state
    other = N_WORD_BINS - 1
    base: list[tuple] = []
    chars, words_hist = [], []
    space, symbol = CLASSES.index("space"), CLASSES.index("symbol")
    for text in strings(texts):
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        hist = np.bincount(table[points], minlength=len(CLASSES))
        raw = text.encode().split()  # splits at exactly the six ASCII white-space bytes
        seen: dict[bytes, int] = {}
        ids = np.array([seen.setdefault(w, len(seen)) for w in raw], dtype=np.int64)
        counts = np.bincount(ids, minlength=len(seen)).tolist()
        common = [0] * N_WORD_BINS
        for w, k in zip(seen, counts):
            common[bins.get(w.decode().lower().strip(".,;:!?'\"()"), other)] += k
        lines = [x for x in text.split("\n") if x.strip(_WS)]
        base.append((len(raw), len(points) - int(hist[space]), int(hist[symbol]),
                     len(lines) - len(set(lines)), repeated_words(ids)))
        chars.append(hist)
        words_hist.append(common)
    cols = list(zip(*base)) or [()] * len(BASE)
    out = {name: (list(v), pa.int64()) for name, v in zip(BASE, cols)}
    out["char_hist"] = (chars, pa.list_(pa.int64()))
    out["word_hist"] = (words_hist, pa.list_(pa.int32()))
    return structs(out)


def measure(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the base columns, ``char_hist`` and ``word_hist`` of every whole text."""
    fields = [*BASE, "char_hist", "word_hist"]
    schema = ", ".join(f"{n} long" for n in BASE) + ", char_hist array<long>, word_hist array<int>"
    return add_columns(df, row_udf(_measure, schema, _setup)(F.col(text_col)), fields)


def base_failed(min_words: int = MIN_WORDS, repeat_percent: int = REPEAT_PERCENT) -> Column:
    n = F.col("n_words")
    return (n < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * n)


def references(measured: DataFrame, lang_col: str, languages: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Summed histograms per language over all documents that pass the base rules (a few
    hundred numbers for the fixed ``languages``)."""
    ok = measured.filter(~F.col("base_failed") & F.col(lang_col).isin(languages))
    parts = [ok.select(F.col(lang_col).alias("lang"), F.lit(kind).alias("kind"), F.posexplode(col).alias("bin", "n"))
             for kind, col in (("char", "char_hist"), ("word", "word_hist"))]
    rows = (parts[0].unionByName(parts[1].withColumn("n", F.col("n").cast("long"))).filter("n > 0")
            .groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n")).collect())
    out = {}
    for lang in sorted({r["lang"] for r in rows}):
        c, w = np.zeros(len(CLASSES)), np.zeros(N_WORD_BINS)
        for r in rows:
            if r["lang"] == lang:
                (c if r["kind"] == "char" else w)[r["bin"]] = r["n"]
        out[lang] = (c / c.sum(), w / w.sum())
    return out


def js_divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence (base 2) of each row of ``p`` to ``q``."""
    m = (p + q) / 2

    def kl(a, b):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(b > 0, b, 1)), 0).sum(axis=1)

    return np.clip((kl(p, m) + kl(np.broadcast_to(q, p.shape), m)) / 2, 0, 1)


def own_references(measured: DataFrame, lang_col: str, languages: list[str]) -> DataFrame:
    """(lang, own_chars): character classes of each language without reference words, summed over its documents
    that pass the base rules."""
    ok = measured.filter(~F.col("base_failed") & F.col(lang_col).isNotNull() & ~F.col(lang_col).isin(languages))
    sums = [F.sum(F.get("char_hist", F.lit(i))) for i in range(len(CLASSES))]
    return ok.groupBy(F.col(lang_col).alias("_own_lang")).agg(F.array(*sums).alias("_own_chars"))


def _with_own(df: DataFrame, own: DataFrame, lang_col: str) -> DataFrame:
    """``df`` with ``_own_chars`` of its language.  The references (eight numbers a language) are broadcast up to
    ``BROADCAST_LANGUAGES`` of them; a table with more is joined with its rows salted, as a language may
    hold most rows."""
    n = own.count()
    if n == 0:
        return df.withColumn("_own_chars", F.lit(None).cast("array<long>"))
    if n <= BROADCAST_LANGUAGES:
        return df.join(F.broadcast(own), df[lang_col] == own["_own_lang"], "left").drop("_own_lang")
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    each = own.withColumn("_own_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    on = (salted[lang_col] == each["_own_lang"]) & (salted["_salt"] == each["_own_salt"])
    return salted.join(each, on, "left").drop("_own_lang", "_own_salt", "_salt")


def _distances(refs: dict, max_char: float, max_word: float):
    def fn(_, chars: pa.Array, words: pa.Array, foreign: pa.Array, own: pa.Array) -> pa.Array:
        n = len(chars)
        c = np.asarray(chars.flatten(), dtype=float).reshape(n, len(CLASSES))
        w = np.asarray(words.flatten(), dtype=float).reshape(n, N_WORD_BINS)
        nc, nw = np.maximum(c.sum(1), 1), np.maximum(w.sum(1), 1)
        best = np.full(n, np.inf)
        lang = np.full(n, "", dtype=object)
        dc, dw = np.ones(n), np.ones(n)
        for name, (rc, rw) in refs.items():
            a, b = js_divergence(c / nc[:, None], rc), js_divergence(w / nw[:, None], rw)
            better = a + b < best
            best = np.where(better, a + b, best)
            lang[better] = name
            dc, dw = np.where(better, a, dc), np.where(better, b, dw)
        # the divergence that sampling alone gives to a text of so many draws
        noise_c = (len(CLASSES) - 1) / (8 * math.log(2) * nc)
        noise_w = NOISE_BINS / (8 * math.log(2) * nw)
        far = (dc > max_char ** 2 + noise_c) | (dw > max_word ** 2 + noise_w)
        for i in np.flatnonzero(np.array(foreign.to_pylist(), dtype=bool)).tolist():
            sums = own[i].as_py()
            lang[i], dw[i], far[i] = None, np.nan, False
            dc[i] = np.nan
            if sums and sum(sums):  # no reference otherwise: the base rules alone
                ref = np.array(sums, dtype=float) / sum(sums)
                dc[i] = js_divergence(c[i:i + 1] / nc[i], ref)[0]
                far[i] = dc[i] > max_char ** 2 + noise_c[i]
        if not refs:
            known = ~np.array(foreign.to_pylist(), dtype=bool)
            lang[known], dc[known], dw[known], far[known] = None, np.nan, np.nan, False
        return structs({"nearest_lang": (lang.tolist(), pa.string()), "char_distance": (_or_null(dc), pa.float64()),
                        "word_distance": (_or_null(dw), pa.float64()), "diverges": (far, pa.bool_())})

    return fn


def _or_null(squared: np.ndarray) -> list:
    return [None if np.isnan(x) else math.sqrt(x) for x in squared.tolist()]


def judge(measured: DataFrame, lang_col: str = "lang", languages: list[str] | None = None,
          max_char_distance: float = MAX_CHAR_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """``measured`` (a written table: it is read twice) with ``base_failed``, the distances to
    the nearest language reference and ``kept``."""
    df = measured.withColumn("base_failed", base_failed())
    languages = languages or list(COMMON_WORDS)
    refs = references(df, lang_col, languages)
    df = _with_own(df, materialise(own_references(df, lang_col, languages)), lang_col)
    foreign = F.col(lang_col).isNotNull() & ~F.col(lang_col).isin(languages)
    fn = row_udf(_distances(refs, max_char_distance, max_word_distance),
                 "nearest_lang string, char_distance double, word_distance double, diverges boolean")
    out = add_columns(df, fn(F.col("char_hist"), F.col("word_hist"), foreign, F.col("_own_chars")),
                      ["nearest_lang", "char_distance", "word_distance", "diverges"])
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("diverges")).drop("diverges", "_own_chars")
