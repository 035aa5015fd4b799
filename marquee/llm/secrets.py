"""Secret scan: known patterns, and a randomness test battery with false-discovery control.

Patterns (kinds assign, access, hex) are matched leftmost and non-overlapping, each kind by itself.

Method for the rest: every other run of 20 or more characters of a token alphabet is a candidate. Its
encoding is inferred (hexadecimal in one case, base 32, base 64 or its URL form) and tests compare it with
ordinary, i.e. non-random, text of that encoding:

* chi-squared uniformity: the statistic of ordinary text is noncentral with length * EXCESS of its encoding;
* runs: changes between character classes are rarer than RUN_RATE of the places in ordinary tokens;
* serial correlation of neighbouring symbols: counted or repeated tokens have far more than random ones.

The deviates of the first two are added up to one score. The third can only tell that a token is not
random: beyond SERIAL deviates it rules the token out, otherwise it says nothing, as ordinary words have
hardly more correlation than random strings. How the score of ordinary tokens is distributed is read from
the corpus itself, per encoding and class of length: a normal distribution is fitted to a histogram of at
most BINS counts, next to the known one of random strings, with PRIOR pseudo-counts of the model above.
The upper tail of the fit gives p-values; false discoveries are held to RATE by the step-up procedure of
Benjamini and Hochberg over all candidates of the corpus, one family for each encoding and class of length,
so that many short strings don't spend what long ones are due. Nothing but the histograms is collected.

Defined cases: null text is empty and has no span; candidates that touch a pattern's span add none; ties
and repeated rows are scanned each; an empty table gives an empty table; columns other than doc_id and
text are not read.
"""

from __future__ import annotations

import math
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from marquee.sources.scratch import keep

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("assign", "access", "hex", "random")
LEAST = 20                # characters of a candidate
RATE = 0.01
STEP = 20                 # bins to a power of ten
BINS = 400
CLASSES = (24, 32, 48, 64)  # lengths at which a new family starts
SCORE_STEP = 10           # bins to a deviate
LOWEST = -8.0             # score of the first bin, which also holds what is ruled out
SERIAL = 3.5
PRIOR = 50.0
# encoding: alphabet, excess of ordinary text in chi-squared a character, changes of class a place
ENCODINGS = {
    "hex": ("0123456789abcdef", 1.0, 0.15),
    "HEX": ("0123456789ABCDEF", 1.0, 0.15),
    "base32": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.2, 0.05),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 2.8, 0.25),
    "base64url": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 2.8, 0.25),
}
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns, by start and then by kind as listed."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def merged_spans(spans: list[tuple[int, str, int]]) -> list[list[int]]:
    """The union of spans that ascend by start, as disjoint [start, end]."""
    out: list[list[int]] = []
    for start, _, end in spans:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def encoding_of(token: str) -> str | None:
    """The narrowest encoding that has every character of the token; None if there is none."""
    seen = set(token)
    for name, (alphabet, _, _) in ENCODINGS.items():
        if seen <= set(alphabet):
            return name
    return None


def _below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def score(token: str) -> float:
    """How much more random than ordinary text of its encoding, in deviates; LOWEST if ruled out."""
    token = token.rstrip("=")
    name = encoding_of(token)
    n = len(token)
    if name is None or n < LEAST:
        return LOWEST
    alphabet, excess, run_rate = ENCODINGS[name]
    size = len(alphabet)
    index = {c: i for i, c in enumerate(alphabet)}
    symbols = [index[c] for c in token]
    mean = sum(symbols) / n
    spread = sum((s - mean) ** 2 for s in symbols)
    r = sum((a - mean) * (b - mean) for a, b in zip(symbols, symbols[1:])) / spread if spread else 1.0
    if math.atanh(min(abs(r), 0.999999)) * math.sqrt(n - 3) > SERIAL:
        return LOWEST
    counts: dict[int, int] = {}
    for s in symbols:
        counts[s] = counts.get(s, 0) + 1
    chi = sum(c * c for c in counts.values()) * size / n - n
    kinds = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in token]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    return _score(n, chi, changes, size, excess, run_rate)


def _score(n: int, chi: float, changes: float, size: int, excess: float, run_rate: float) -> float:
    shift = n * excess
    uniform = (size - 1 + shift - chi) / math.sqrt(2 * (size - 1 + 2 * shift))
    runs = (changes - 0.5 - (n - 1) * run_rate) / math.sqrt((n - 1) * run_rate * (1 - run_rate))
    return (uniform + runs) / math.sqrt(2)


def bin_of(value: float) -> int:
    return max(0, min(BINS - 1, int((value - LOWEST) * SCORE_STEP)))


def family_of(token: str) -> int:
    """Encoding and class of length as one number."""
    name, n = encoding_of(token.rstrip("=")), len(token.rstrip("="))
    return (1 + list(ENCODINGS).index(name) if name else 0) * (len(CLASSES) + 1) + sum(n >= c for c in CLASSES)


def random_score(family: int) -> float:
    """Expected score of random strings of the least length of the family."""
    code, length = divmod(family, len(CLASSES) + 1)
    alphabet, excess, run_rate = list(ENCODINGS.values())[code - 1]
    size, n = len(alphabet), (LEAST, *CLASSES)[length]
    kinds = [sum(c.isdigit() for c in alphabet), sum(c.islower() for c in alphabet), sum(c.isupper() for c in alphabet)]
    changes = (n - 1) * (1 - sum((k / size) ** 2 for k in (*kinds, size - sum(kinds))))
    return _score(n, size - 1, changes, size, excess, run_rate)


def ordinary(counts: dict[int, int], family: int) -> tuple[float, float]:
    """Mean and deviation of the ordinary scores in a histogram that may hold random strings too."""
    # what is ruled out is in the first bin and takes no part
    at = [(LOWEST + (b + 0.5) / SCORE_STEP, n) for b, n in sorted(counts.items()) if b > 0]
    top = random_score(family)
    mean, dev, share = 0.0, 1.0, 0.1
    for _ in range(200):
        one = square = many = strange = 0.0
        for x, n in at:
            f0 = (1 - share) * math.exp(-0.5 * ((x - mean) / dev) ** 2) / dev
            f1 = share * math.exp(-0.5 * min(0.0, x - top) ** 2)
            w = n * (f0 / (f0 + f1) if f0 + f1 else x < top)
            many, one, square, strange = many + w, one + w * x, square + w * x * x, strange + n - w
        old, mean = mean, one / (many + PRIOR)
        dev = max(0.5, math.sqrt(max(0.0, (square + PRIOR) / (many + PRIOR) - mean * mean)))
        share = min(0.95, max(1e-6, strange / (many + strange))) if at else 0.0
        if abs(old - mean) < 1e-6:
            break
    return mean, dev


def p_bins(histogram: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """For each family and bin of scores the bin of its p-value: whole steps of 1/STEP of a power of ten, rounded upwards."""
    out = {}
    for family in {f for f, _ in histogram}:
        if family <= len(CLASSES):  # no encoding
            out.update({(f, b): 0 for f, b in histogram if f == family})
            continue
        mean, dev = ordinary({b: n for (f, b), n in histogram.items() if f == family}, family)
        for b in (b for f, b in histogram if f == family):
            p = _below(-(LOWEST + b / SCORE_STEP - mean) / dev) if b else 1.0
            out[family, b] = min(BINS - 1, int(-math.log10(p) * STEP)) if p > 0 else BINS - 1
    return out


def scan_text(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, int, int, int]]]:
    """Pattern spans, and candidates (start, end, family, bin of the score)."""
    base = base_spans(text)
    candidates = []
    covered = merged_spans(base)
    at = 0  # both lists ascend, so they are walked together
    for m in TOKEN.finditer(text):
        while at < len(covered) and covered[at][1] <= m.start():
            at += 1
        if at < len(covered) and covered[at][0] < m.end():
            continue
        candidates.append((m.start(), m.end(), family_of(m.group()), bin_of(score(m.group()))))
    return base, candidates


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base (array of start, kind, end) and candidates (array of start, end, class, bin)."""
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in batches:
            found = [scan_text(t or "") for t in batch["text"]]
            out = pd.DataFrame({
                "doc_id": batch["doc_id"],
                "base": [[{"start": a, "kind": k, "end": b} for a, k, b in base] for base, _ in found],
                "candidates": [[{"start": a, "end": b, "class": c, "bin": x} for a, b, c, x in more] for _, more in found],
            })
            if id_type in ("bigint", "int"):
                out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    schema = (f"doc_id {id_type}, base array<struct<start:bigint,kind:string,end:bigint>>, "
              "candidates array<struct<start:bigint,end:bigint,class:int,bin:int>>")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInPandas(run, schema)


def thresholds(histogram: dict[tuple[int, int], int], rate: float = RATE) -> dict[int, int]:
    """For each class the least bin that the step-up procedure lets through (BINS: none)."""
    out = {}
    for family in {c for c, _ in histogram}:
        counts = {b: n for (c, b), n in histogram.items() if c == family}
        total, passed, least = sum(counts.values()), 0, BINS
        for b in sorted(counts, reverse=True):
            passed += counts[b]
            if 10 ** (-b / STEP) <= rate * passed / total:
                least = b
        out[family] = least
    return out


def least_scores(histogram: dict[tuple[int, int], int], rate: float = RATE) -> dict[int, int]:
    """For each family the least bin of scores that is let through (BINS: none)."""
    of = p_bins(histogram)
    by_p: dict[tuple[int, int], int] = {}
    for (f, b), n in histogram.items():
        by_p[f, of[f, b]] = by_p.get((f, of[f, b]), 0) + n
    least = thresholds(by_p, rate)
    return {f: min([b for g, b in histogram if g == f and of[g, b] >= least[f]], default=BINS) for f in least}


def _least_bins(found: DataFrame, rate: float) -> dict[int, int]:
    bins = found.select(F.explode("candidates").alias("c")).groupBy("c.class", "c.bin").agg(F.count("*").alias("n"))
    return least_scores({(r["class"], r["bin"]): r["n"] for r in bins.collect()}, rate)  # at most 30 x BINS rows


def find_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, base and spans: arrays of (start, kind, end) ordered by start, then kind as listed."""
    found = keep(scan(docs), "scan")
    least = _least_bins(found, rate)
    names = F.array(*[F.lit(k) for k in KINDS])

    def passes(c: Column) -> Column:
        ok = F.lit(False)
        for family, least_bin in sorted(least.items()):
            ok = ok | ((c["class"] == family) & (c["bin"] >= least_bin))
        return ok

    def entry(s: Column, turn: Column) -> Column:
        return F.struct(s["start"].alias("start"), turn.alias("turn"), s["end"].alias("end"))

    base = F.transform("base", lambda s: entry(s, (F.array_position(names, s["kind"]) - 1).cast("int")))
    more = F.transform(F.filter("candidates", passes), lambda c: entry(c, F.lit(len(KINDS) - 1)))
    named = F.transform(F.sort_array(F.concat(base, more)), lambda s: F.struct(
        s["start"].alias("start"), F.get(names, s["turn"]).alias("kind"), s["end"].alias("end")))
    return found.select("doc_id", "base", named.alias("spans"))


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans give one mark."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents, all their columns, with secrets masked in the text.

    The first pass gathers the histogram only; the second scans again and masks, so no text is shuffled.
    """
    least = _least_bins(scan(docs), rate)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            if text is None:
                out.append(None)
                continue
            base, more = scan_text(text)
            spans = [(a, b, k) for a, k, b in base] + [(a, b, KINDS[-1]) for a, b, c, x in more if x >= least[c]]
            out.append(masked(text, spans) if spans else text)
        return pd.Series(out, dtype=object)

    return docs.withColumn("text", clean("text"))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
