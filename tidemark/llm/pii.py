"""Personal data by weak supervision.

Wide patterns propose spans. Labelers of three sorts vote on each: regular expressions,
gazetteers and the words before it. Expectation-maximisation over the counts of vote patterns
of the whole corpus estimates how far each labeler can be trusted, and a logistic classifier
learns from the resulting beliefs. Column expressions and aggregates only; what is fitted is
a table with a row per vote pattern.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, materialise, quoted, sha256_text, whole
from tidemark.llm.spans import HIT, count_of, digits, hits, listing, nothing, overlaps

KINDS = ("email", "ip", "card", "phone")
# Possessive runs that start where a run starts, or where the last match ended: the same
# matches as the plain forms, linear on very long texts.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Wider forms: proposals only, which the labelers and the classifier decide on.
_AT = r"(?:\x20{0,2}[\[({]\x20?(?:@|at|AT)\x20?[\])}]\x20{0,2}|\x20{1,2}@\x20{0,2}|@\x20{1,2})"
_DOT = r"\x20{0,2}[\[({]\x20?(?:\.|dot|DOT)\x20?[\])}]\x20{0,2}|\x20{1,2}(?:dot|DOT)\x20{1,2}"
_NAME, _LABEL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++", r"[A-Za-z0-9-]++"
_OPEN = ("[", "(", "{")
WIDE_EMAILS = {     # with what a text must hold for a match, so that most texts are not searched
    rf"{_NAME}{_AT}{_LABEL}(?:(?:\.|{_DOT}){_LABEL})++": (("@ ", " @", *_OPEN), ("@", "at", "AT")),
    rf"{_NAME}\x20(?:at|AT)\x20{_LABEL}(?:(?:{_DOT}){_LABEL})++": ((" at ", " AT "), ("dot", "DOT", *_OPEN)),
    rf"{_NAME}@{_LABEL}(?:(?:{_DOT}){_LABEL})++": (("@",), ("dot", "DOT", *_OPEN)),
}
_STOP = r"(?:\x20?[\[(](?:\.|dot)[\])]\x20?|\x20\.\x20|\.)"
WIDE_IP = rf"(?<![0-9.])[0-9]{{1,3}}(?:{_STOP}[0-9]{{1,3}}){{3}}(?![0-9.])"
WIDE_CARD = r"(?<![0-9])[0-9]{4}([./_]|\x20{2}|\x20-\x20)[0-9]{4}\1[0-9]{4}\1[0-9]{4,7}(?![0-9])"
LOCAL_PHONE = r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"
TRUNK_PHONE = r"(?<![0-9+.-])\(?0[1-9][0-9]{1,4}\)?(?:[\x20/-][0-9]{2,8}){1,4}(?![0-9/-])"
EXIT_PHONE = r"(?<![0-9+.-])00[\x20-]?[1-9](?:[\x20().-]{0,2}[0-9]){7,13}(?![0-9])"

_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)"
_ADDRESS = rf"^(?=[0-9]){_OCTET}(?:\.(?=[0-9]){_OCTET}){{3}}$"

# gazetteers
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "eu", "de", "fr", "es", "it", "nl", "uk")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44",
                 "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "61", "62", "81", "82",
                 "86", "90", "91", "351", "352", "353", "358", "420")
AMEX = r"^3[47][0-9]{2}([\x20-]?)[0-9]{6}\1[0-9]{5}$"
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|4|5))"
CONTEXT = {
    "email": r"(?i)(?:e-?mail|contact|write|reach|courriel|correo)[^\n]{0,24}$",
    "ip": r"(?i)(?:\bip\b|address|server|host|gateway|adresse)[^\n]{0,24}$",
    "card": r"(?i)(?:card|visa|credit|payment|carte|karte|tarjeta)[^\n]{0,24}$",
    "phone": r"(?i)(?:phone|tel\b|mobile|call|fax|telefon|t[ée]l[ée]phone)[^\n]{0,24}$",
}
AGAINST = r"(?i)(?:version|release|isbn|order|invoice|section|chapter)[^\n]{0,12}$"

LEAST_CARD = 13

VOTES = ("form", "gazetteer", "context", "shape")
LEAST_ODDS = (50, 1, 10, 1)         # by which a vote moves the odds at least: a failed checksum stays one
ROUNDS = 40
ACCEPT = 0.9        # belief from which a span beside the base forms is added


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def weighed(i: Column) -> Column:
        digit = F.substr(number, i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when((F.length(number) - i) % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda t, i: t + weighed(i))
    return total % 10 == 0


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0)


def _proposals(kind: int, found: Column, base, gazetteer, shape, unfit=None) -> Column:
    """Matches with their votes. ``base`` is None where the pattern is no base form, ``unfit`` says
    which matches the form speaks against, those that do not fit unless given."""
    name = KINDS[kind]

    def judged(h: Column) -> Column:
        fits = F.lit(False) if base is None else base(h["value"])
        against_form = unfit(h["value"]) if unfit else ~fits
        against = h["before"].rlike(AGAINST)
        around = (F.right(h["before"], F.lit(1)).rlike(r"[A-Za-z0-9]").cast("int")
                  + h["after"].rlike(r"[A-Za-z0-9]").cast("int"))
        return F.struct(
            F.lit(kind).alias("kind"), h["start"].alias("start"), h["end"].alias("end"), fits.alias("base"),
            (F.lit(0) if base is None else _vote(fits, against_form)).alias("form"),
            gazetteer(h["value"]).alias("gazetteer"),
            _vote(h["before"].rlike(CONTEXT[name]) & ~against, against).alias("context"),
            shape(h["value"]).alias("shape"), around.alias("around"))

    return F.transform(found, judged)


def propose(text: Column) -> Column:
    """All proposals of a text, each with ``base`` (it is a base span), votes and surroundings."""
    def parts_plain(v: Column) -> Column:
        return ~v.rlike(r"(?:^|\.)0[0-9]")

    def country(v: Column) -> Column:
        number = digits(v)
        codes = F.array(*[F.lit(c) for c in CALLING_CODES])
        return _vote(v.startswith("+") & F.exists(codes, lambda c: number.startswith(c)), v.startswith("+"))

    def right_size(v: Column) -> Column:
        return F.length(digits(v)).between(8, 15)

    def good_card(v: Column) -> Column:
        return let(digits(v), lambda d: F.length(d).between(16, 19) & luhn(d))

    def found(pattern: str, *needs: tuple[str, ...]) -> Column:
        """Matches; searched for only in texts that hold one of each of ``needs``, as every match does."""
        at = hits(text, pattern, over=2)
        if not needs:
            return at
        held = [reduce(or_, [text.contains(mark) for mark in marks]) for marks in needs]
        return F.when(reduce(and_, held), at).otherwise(nothing(HIT))

    def issuer(v: Column) -> Column:
        return _vote(digits(v).rlike(CARD_ISSUERS), ~digits(v).rlike(CARD_ISSUERS))

    def dotted(v: Column) -> Column:
        return F.regexp_replace(v, "[^0-9]+", ".")

    emails = _proposals(0, found(EMAIL), lambda v: F.lit(True),
                        lambda v: _vote(F.regexp_extract(v, r"\.([A-Za-z0-9-]+)$", 1).isin(*TOP_DOMAINS),
                                        v.rlike(r"\.[0-9-]+$")),
                        lambda v: _vote(v.rlike(r"^[A-Za-z0-9](?!.*\.\.)[^@]*@"), v.rlike(r"^[.%+-]|\.\.")))
    ips = _proposals(1, found(IP), lambda v: v.rlike(_ADDRESS),
                     lambda v: _vote(~v.rlike(r"^0*\."), v.rlike(r"^0*\.")),
                     lambda v: _vote(parts_plain(v), ~parts_plain(v)))
    # runs of fewer digits are plain numbers and no card by any labeler
    long_runs = F.filter(found(CARD), lambda h: F.length(digits(h["value"])) >= LEAST_CARD)
    cards = _proposals(2, long_runs, good_card, issuer,
                       lambda v: _vote(v.rlike(r"^(?:[0-9]{16,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4,7})$")
                                       | v.rlike(AMEX), ~F.length(digits(v)).between(13, 19)),
                       unfit=lambda v: let(digits(v), lambda d: (F.length(d) > 19) | ~luhn(d)))
    phones = _proposals(3, found(PHONE), right_size, country,
                        lambda v: _vote(v.rlike(r"[\x20().-]"), ~right_size(v)))
    wide = [_proposals(0, found(pattern, *needs), None,
                       lambda v: _vote(F.regexp_extract(F.lower(v), "([a-z0-9-]+)$", 1).isin(*TOP_DOMAINS),
                                       v.rlike("[0-9-]$")),
                       lambda v: _vote(v.rlike(r"[\])}]|\x20(?:dot|DOT)\x20"), v.rlike(r"^[.%+-]|\.\.")))
            for pattern, needs in WIDE_EMAILS.items()]
    # plain dots only are the base pattern's
    marked = F.filter(found(WIDE_IP, ("[", "(", " . ")), lambda h: h["value"].rlike(r"[\[(\x20]"))
    wide.append(_proposals(1, marked, None, lambda v: _vote(~v.rlike(r"^0"), v.rlike(r"^0")),
                           lambda v: _vote(dotted(v).rlike(_ADDRESS) & parts_plain(dotted(v)), ~dotted(v).rlike(_ADDRESS))))
    wide.append(_proposals(2, found(WIDE_CARD), None, issuer, lambda v: _vote(luhn(digits(v)), ~luhn(digits(v)))))
    wide += [
        _proposals(3, found(LOCAL_PHONE), None, country,
                   lambda v: _vote(v.rlike(r"^\([0-9]{3}\)|^[0-9]{3}([.-])[0-9]{3}\1"), F.lit(False))),
        _proposals(3, found(TRUNK_PHONE), None, country,
                   lambda v: _vote(F.length(digits(v)).between(9, 12), ~F.length(digits(v)).between(7, 13))),
        _proposals(3, found(EXIT_PHONE), None, lambda v: country(F.regexp_replace(v, r"^00[\x20-]?", "+")),
                   lambda v: _vote(F.length(digits(v)).between(11, 15), ~F.length(digits(v)).between(10, 17)))]
    known = F.concat(emails, ips, cards, phones)
    return let(known, lambda k: let(F.filter(k, lambda s: s["base"]), lambda base: F.concat(
        k, F.filter(F.concat(*wide), lambda p: ~overlaps(p, base)))))


def pattern_counts(proposed: DataFrame) -> DataFrame:
    """How often each pattern of kind, votes and surroundings occurs: a bounded number of rows."""
    each = proposed.select(F.explode("proposals").alias("p"))
    return each.groupBy("p.kind", *[f"p.{v}" for v in VOTES], "p.around").agg(F.count("*").alias("n"))


def _sort(p: Sequence) -> tuple[int, bool]:
    """Kind of a pattern, and whether it is a wider form, on which the form labeler does not speak."""
    return p[0], p[1 + VOTES.index("form")] == 0


def believed(patterns: Sequence[tuple], rounds: int = ROUNDS) -> list[float]:
    """The belief that a proposal is personal data, by vote pattern; labelers taken as independent.

    ``patterns`` are ``kind, votes..., around, n``. Starts from a weighted majority of votes. A labeler
    that does not speak says nothing either way; wider forms have a prior of their own. No
    reliability falls below that of `LEAST_ODDS`, so labelers that often err together do not
    outvote a checksum.
    """
    votes = range(len(VOTES))
    belief = [min(0.9, max(0.1, 0.5 + sum(p[1 + v] * 0.1 * (1 + math.log(LEAST_ODDS[v])) for v in votes))) for p in patterns]
    for _ in range(rounds):
        prior, chance = {}, {}
        for sort in sorted({_sort(p) for p in patterns}):
            rows = [(p, b) for p, b in zip(patterns, belief, strict=True) if _sort(p) == sort]
            prior[sort] = (sum(p[-1] * b for p, b in rows) + 1) / (sum(p[-1] for p, _ in rows) + 2)
        for k in sorted({p[0] for p in patterns}):
            for v in votes:
                spoken = [(p, b) for p, b in zip(patterns, belief, strict=True) if p[0] == k and p[1 + v]]
                yes = sum(p[-1] * b for p, b in spoken)
                no = sum(p[-1] * (1 - b) for p, b in spoken)
                for said in (-1, 1):
                    hit = sum(p[-1] * b for p, b in spoken if p[1 + v] == said)
                    miss = sum(p[-1] * (1 - b) for p, b in spoken if p[1 + v] == said)
                    # a labeler is taken to be better than chance until the counts say otherwise
                    chance[k, v, said] = ((hit + 1 + 2 * (said == 1)) / (yes + 4),
                                          (miss + 1 + 2 * (said == -1)) / (no + 4))
        belief = []
        for p in patterns:
            odds = math.log(prior[_sort(p)] / (1 - prior[_sort(p)]))
            for v in (v for v in votes if p[1 + v]):
                yes, no = chance[p[0], v, p[1 + v]]
                odds += p[1 + v] * max(p[1 + v] * math.log(yes / no), math.log(LEAST_ODDS[v]))
            belief.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return belief


def _features(p: Sequence) -> list[float]:
    kind = [float(_sort(p) == (k, wide)) for wide in (False, True) for k in range(len(KINDS))]
    said = [float(p[1 + v] == s) for v in range(len(VOTES)) for s in (-1, 1)]
    return [*kind, *said, float(p[1 + len(VOTES)])]


def span_classifier(patterns: Sequence[tuple], belief: Sequence[float], steps: int = 400) -> list[float]:
    """Weights of a logistic classifier fitted to the beliefs, each pattern by the log of its count."""
    rows = [(_features(p), b, math.log1p(p[-1])) for p, b in zip(patterns, belief, strict=True)]
    total = sum(r[2] for r in rows) or 1.0
    width = 2 * len(KINDS) + 2 * len(VOTES) + 1
    weights = [0.0] * width
    for _ in range(steps):
        slope = [0.001 * w for w in weights]
        for x, b, n in rows:
            z = sum(w * f for w, f in zip(weights, x, strict=True))
            gap = (1 / (1 + math.exp(-z)) - b) * n / total
            for i, f in enumerate(x):
                slope[i] += gap * f
        weights = [w - 2.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def _belief(p: Column, weights: Sequence[float]) -> Column:
    at = 2 * len(KINDS)
    z = F.element_at(F.array(*[F.lit(w) for w in weights[:at]]),
                     p["kind"] + 1 + F.when(p["form"] == 0, len(KINDS)).otherwise(0))
    for v in VOTES:
        for said in (-1, 1):
            z = z + F.when(p[v] == said, weights[at]).otherwise(0.0)
            at += 1
    return 1 / (1 + F.exp(-(z + p["around"] * weights[at])))


def find_personal(docs: DataFrame, key: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``key, base, spans`` of each row: base spans, and those with what the classifier adds.

    Beside the base forms there are proposals in wider forms: emails that are spaced, bracketed or
    in words, addresses and cards with other separators, phone numbers without ``+``.

    A span is ``kind`` (index of `KINDS`), ``start``, ``end``. Null texts are empty; every row is
    kept, repeated or not, whatever its key. Texts are looked at once, whole; what was proposed
    is written, so that fitting and deciding read only that.
    """
    first = docs.select(docs[quoted(key)].alias("key"), whole(docs[quoted(text)]).alias("text"))
    proposed = materialise(first.select("key", propose(F.col("text")).alias("proposals")), "personal")
    patterns = [tuple(r) for r in pattern_counts(proposed).collect()]
    patterns.sort()
    weights = span_classifier(patterns, believed(patterns))
    plain = "array<struct<kind:int,start:int,end:int>>"

    def bare(spans: Column) -> Column:
        return F.transform(spans, lambda p: F.struct(p["kind"], p["start"], p["end"])).cast(plain)

    extra = F.filter("proposals", lambda p: ~p["base"] & (_belief(p, weights) >= accept)
                     & ~overlaps(p, F.filter(F.col("proposals"), lambda o: o["base"])))
    base = bare(F.filter("proposals", lambda p: p["base"]))
    return proposed.select(F.col("key").alias(key), base.alias("base"),
                           F.concat(base, F.array_distinct(bare(extra))).alias("spans"))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Base counts per kind, the hash of the base spans and the listing of all, by kind, then start."""
    def order(s: Column) -> list[Column]:
        return [s["kind"], s["start"]]

    counts = [count_of(F.col("base"), k).alias(f"n_{name}")
              for k, name in enumerate(KINDS)]
    return found.select(key, *counts, sha256_text(listing(F.col("base"), KINDS, order)).alias("base_sha256"),
                        listing(F.col("spans"), KINDS, order).alias("spans"),
                        F.size("spans").cast("long").alias("n_spans"))
