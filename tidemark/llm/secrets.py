"""Secret scan: known forms, and strings that look random to character Markov models.

Two models of character transitions are counted over the whole corpus: strings in known secret
forms against all words and identifiers outside them. A token, or a part of one, that fits the
first model clearly better is reported too. Column expressions and aggregates only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, materialise, quoted, sha256_text, whole
from tidemark.llm.spans import count_of, hits, listing, overlaps

KINDS = ("assign", "access", "hex", "random")
# The forms. Runs are possessive and start where a run starts, which finds the same matches as
# the plain forms and stays linear on very long texts.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
WORD = r"[A-Za-z0-9+/_=-]{2,}+"
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{10,}+"
PART = r"(?<![A-Za-z0-9+-])[A-Za-z0-9+-]{10,}+"     # between = / _ and what ends a token
LEAST_ASSIGNED = 6

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# share of the even distribution in a character's chance, whatever the corpus' size; prior count of a
# character's transitions; least share of what an ordinary transition leans on
EVEN, LEAN, SELDOM = 0.01, 10.0, 0.02
# mean log-likelihood ratio of a transition, in nats, from which a token is reported; below so many
# characters it rises with the spread of the mean
THRESHOLD, FULL_LENGTH = 1.0, 20


def _span(kind: int, h: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), h["start"].alias("start"), h["end"].alias("end"),
                    h["value"].alias("value"))


def known_forms(text: Column) -> Column:
    """Base spans of the three forms with their secret part."""
    assigned = F.filter(hits(text, ASSIGN, group=2), lambda h: F.length(h["value"]) >= LEAST_ASSIGNED)
    return F.concat(F.transform(assigned, lambda h: _span(0, h)),
                    F.transform(hits(text, ACCESS), lambda h: _span(1, h)),
                    F.transform(hits(text, HEX), lambda h: _span(2, h)))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, base, tokens, parts``: known forms, and tokens and their parts outside them.

    Null texts are empty. Every row is kept as it is, repeated or not, whatever its key.
    """
    first = docs.select(docs[quoted(key)].alias("key"), whole(docs[quoted(text)]).alias("text"))
    def places(found: Column) -> Column:
        return F.transform(found, lambda h: F.struct(
            h["start"].alias("start"), h["end"].alias("end"), h["value"].alias("value")))

    # the table is small beside the texts
    table = materialise(first.select(
        "key", known_forms(F.col("text")).alias("base"), places(hits(F.col("text"), TOKEN)).alias("tokens"),
        places(hits(F.col("text"), PART)).alias("parts")), "secrets")
    return table.withColumns({c: F.filter(c, lambda t: ~overlaps(t, F.col("base"))) for c in ("tokens", "parts")})


def transition_counts(docs: DataFrame, scanned: DataFrame, text: str = "text") -> DataFrame:
    """``random, pair, n`` over the whole corpus: at most two rows per pair of characters.

    Secret parts of known forms are samples of random strings; all words and identifiers outside
    known forms, digits included, are samples of ordinary ones. Words are counted before pairs.
    """
    random = scanned.select(F.lit(True).alias("random"), F.explode("base.value").alias("sample"))
    rest = F.regexp_replace(whole(docs[quoted(text)]), f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    ordinary = docs.select(F.lit(False).alias("random"),
                           F.explode(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0))).alias("sample"))
    samples = random.unionByName(ordinary).groupBy("random", "sample").agg(F.count("*").alias("times"))
    pairs = F.regexp_extract_all("sample", F.lit("(?=([A-Za-z0-9+/_=-]{2}))"), F.lit(1))
    return (samples.select("random", "times", F.explode(pairs).alias("pair"))
            .groupBy("random", "pair").agg(F.sum("times").alias("n")))


def log_ratios(counts: DataFrame) -> list[float]:
    """Of every transition, row by row of the alphabet; the table is as large as the alphabet squared.

    A random string's transition leans on how common its second character is, the less the more often its
    first one was seen. An ordinary one's leans on the sorts of both characters (capital, small, digit,
    sign) and on the same letters in any case, ``SELDOM`` at least: a digit after a digit is nothing strange, even
    where few numbers were seen. Where the words of an identifier meet, at a sign or a capital
    after a small letter, nothing speaks for a random string. Half of the random model is the even distribution: the known secrets may be of one sort only, other random
    strings use any character; without any it is all of it. No ordinary sample, no evidence: zeros.
    """
    size = len(ALPHABET)
    seen = {True: {}, False: {}}
    for random, pair, n in counts.collect():
        seen[random][pair] = n if random else n - 1     # a token is no witness for itself
    if not seen[False]:
        return [0.0] * (size * size)
    random, ordinary = seen[True], seen[False]
    found = sum(random.values())
    common = {b: (1 - EVEN) * sum(random.get(a + b, 0) for a in ALPHABET) / found + EVEN / size if found else 1 / size
              for b in ALPHABET}
    by_sort = _by_sort(ordinary)
    out = []
    for a in ALPHABET:
        often, row = (sum(pairs.get(a + b, 0) for b in ALPHABET) for pairs in (random, ordinary))
        lean = max(SELDOM, LEAN / (row + LEAN))
        for b in ALPHABET:
            p = (random.get(a + b, 0) + LEAN * common[b]) / (often + LEAN)
            q = (1 - lean) * ordinary.get(a + b, 0) / max(row, 1) + lean * by_sort[a + b]
            ratio = math.log((p / 2 + 0.5 / size) / q)
            joint = _sort(a) == "+" or _sort(b) == "+" or (_sort(a), _sort(b)) == ("a", "A")
            out.append(min(ratio, 0.0) if joint else ratio)
    return out


def _sort(c: str) -> str:
    return "A" if c.isupper() else "a" if c.islower() else "0" if c.isdigit() else "+"


def _by_sort(ordinary: dict[str, int]) -> dict[str, float]:
    """Of each pair, the chance of its second character by the sorts of both and, for letters, whatever their case."""
    sized = {s: sum(_sort(c) == s for c in ALPHABET) for s in "Aa0+"}
    moves = {(s, t): 0 for s in sized for t in sized}
    single, lower, first = dict.fromkeys(ALPHABET, 0), {}, {}
    for (a, b), n in ordinary.items():
        moves[_sort(a), _sort(b)] += n
        single[b] += n
        if a.isalpha() and b.isalpha():
            lower[(a + b).lower()] = lower.get((a + b).lower(), 0) + n
            first[a.lower()] = first.get(a.lower(), 0) + n
    heads = {s: sum(n for c, n in single.items() if _sort(c) == s) for s in sized}
    out = {}
    for a in ALPHABET:
        s = _sort(a)
        for b in ALPHABET:
            t = _sort(b)
            usual = 0.7 if s == t else 0.1          # runs of one sort are usual
            move = (1 - SELDOM) * (moves[s, t] + LEAN * usual) / (
                sum(moves[s, u] for u in sized) + LEAN) + SELDOM * usual
            within = (single[b] + LEAN / sized[t]) / (heads[t] + LEAN)
            if a.isalpha() and b.isalpha():
                within = (within + lower.get((a + b).lower(), 0) / max(1, first.get(a.lower(), 0))) / 2
            out[a + b] = move * within
    return out


def mean_ratio(value: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of the token's transitions; one pass, however long it is."""
    # constants the optimiser folds: one array for the whole query
    table = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def total(place: Column) -> Column:
        n = F.size(place) - 1
        steps = F.zip_with(F.slice(place, F.lit(1), n), F.slice(place, F.lit(2), n),
                           lambda a, b: F.get(table, a * len(ALPHABET) + b))
        return F.aggregate(steps, F.lit(0.0), lambda sum_, step: sum_ + step) / n

    return let(places, total)


def looks_random(token: Column, ratios: list[float], threshold: float = THRESHOLD) -> Column:
    short = F.sqrt(F.greatest(F.lit(1.0), FULL_LENGTH / F.length(token["value"])))
    return mean_ratio(token["value"], ratios) >= threshold * short


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key, base, spans`` of each row: known forms, and those with the random-looking tokens.

    A span is ``kind`` (index of `KINDS`), ``start``, ``end``. Parts are reported where the whole
    token does not look random.
    """
    scanned = scan(docs, key, text)
    ratios = log_ratios(transition_counts(docs, scanned, text))
    plain = "array<struct<kind:int,start:int,end:int>>"
    base = F.transform("base", lambda s: s.dropFields("value")).cast(plain)
    judged = scanned.select("key", "base", "parts", F.filter("tokens", lambda t: looks_random(t, ratios, threshold)).alias("whole"))
    parts = F.filter("parts", lambda t: ~overlaps(t, F.col("whole")) & looks_random(t, ratios, threshold))
    extra = F.transform(F.concat("whole", parts), lambda t: F.struct(
        F.lit(3).alias("kind"), t["start"].alias("start"), t["end"].alias("end"))).cast(plain)
    return judged.select(F.col("key").alias(key), base.alias("base"), F.concat(base, extra).alias("spans"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per form, the hash of the base spans and the listing of all, by start, then kind."""
    def order(s: Column) -> list[Column]:
        return [s["start"], s["kind"]]

    counts = [count_of(F.col("base"), k).alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select(key, *counts, sha256_text(listing(F.col("base"), KINDS, order)).alias("base_sha256"),
                        listing(F.col("spans"), KINDS, order).alias("spans"))
