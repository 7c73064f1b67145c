"""Personal data by weak supervision.

Fixed patterns give the base spans. Narrower and wider patterns propose further spans, such
as a phone number and a card number that the base patterns swallow as one. Labelers of
three sorts vote on every candidate: patterns and checks on the digits, gazetteers, and the
words around it. Expectation-maximisation estimates how reliable each labeler is from how
the votes agree, without labelled data, and gives each candidate a probability. With these as
soft labels a naive Bayes span classifier is trained over the candidate's shape and
surroundings, and what it accepts is added to the base spans.

All work on rows is DataFrame functions. To the driver come the counts of vote patterns
and of feature values: their number is fixed by the number of labelers and values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tristrata.llm.shared import staged

KINDS = ("email", "ip", "card", "phone")
# The base patterns, written so that a long run of characters is tried once. A
# match can begin within a run only where the one before it ended.
_LOCAL = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further candidates: forms written to be overlooked, and single items within longer runs.
PROPOSED = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\)|\{at\})\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\[dot\]|\(dot\)|\{dot\}|\.)\x20?[A-Za-z0-9-]{2,63}){1,4}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3}(?![0-9])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{14,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# Gazetteers: ends of mail domains, first digits of card issuers, country codes.
MAIL_ENDS = "com org net edu gov io de fr es uk eu info".split()
CARD_STARTS = "34 37 4 51 52 53 54 55 22 23 24 25 26 27 60 64 65 35 36 38".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 61 64 65 81 82 86 90 91".split()
# Words before a candidate that speak for one kind, and some that speak against any.
CUES = {
    "email": "mail|e-mail|contact|write|correo|courriel",
    "ip": "ip|host|server|address|servidor|serveur",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telefon|móvil|portable",
}
NO_CUES = "version|section|page|isbn|sku|token|key|password|hash|total|figure|order|part"
BEFORE, AFTER = 24, 8
ACCEPT = 0.5
EM_ROUNDS = 60
VOTES = ("check", "gazetteer", "context", "border", "layout")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        value = F.substring(digits, -i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return value - F.when(value > 9, 9).otherwise(0)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def base_valid(kind: Column, found: Column) -> Column:
    """Whether a match of a base pattern stands."""
    digits, n = _digits(found), F.length(_digits(found))
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", found.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == "card", n.between(14, 19) & F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
        .otherwise(n.between(10, 15))
    )


def _matches(text: Column, pattern: str) -> Column:
    """Matches in order, each with the length of the text since the one before and its surroundings."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    zipped = F.arrays_zip(found.alias("found"), between.alias("gap"), F.slice(between, 2, F.size(found)).alias("next"))

    def shaped(x: Column) -> Column:
        return F.struct(
            x["found"].alias("found"),
            F.length(x["gap"]).alias("gap"),
            F.right(x["gap"], F.lit(BEFORE)).alias("before"),
            F.left(x["next"], F.lit(AFTER)).alias("after"),
        )

    kept = F.filter(zipped, lambda x: x["found"].isNotNull())
    return F.when(F.regexp_count(text, F.lit(pattern)) > 0, F.transform(kept, shaped))


def scan(docs: DataFrame) -> DataFrame:
    """``row, doc_id`` and per pattern the matches of each row, staged: the one pass over the texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    arrays = [_matches(F.col("_text"), BASE[k]).alias(f"base_{k}") for k in KINDS]
    arrays += [_matches(F.col("_text"), PROPOSED[k]).alias(f"more_{k}") for k in KINDS]
    rows = docs.select("doc_id", text.alias("_text"))
    return staged(rows.select("doc_id", *arrays).withColumn("row", F.monotonically_increasing_id()))


def _spans(found: DataFrame, prefix: str) -> DataFrame:
    """``row, kind, start, end, found, before, after`` of every match; offsets in code points.

    Sums run over one row's matches of one pattern, so no group is larger than a text.
    """
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{prefix}_{k}").alias("all")) for k in KINDS])
    kinds = found.select("row", F.inline(each)).where(F.size("all") > 0)
    flat = kinds.select("row", "kind", F.posexplode("all").alias("pos", "m")).select("row", "kind", "pos", "m.*")
    upto = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("found")).over(upto).cast("bigint")
    return flat.withColumn("end", end).select(
        "row", "kind", (F.col("end") - F.length("found")).alias("start"), "end", "found", "before", "after"
    )


def votes(spans: DataFrame) -> DataFrame:
    """A vote of 1, 0 (none) or -1 from each labeler."""
    found, kind = F.col("found"), F.col("kind")
    digits = _digits(found)
    lower = F.lower(F.col("before"))
    word = lambda cues: rf"(?:^|[^\p{{L}}])(?:{cues})[^\p{{L}}]{{0,3}}(?:\p{{L}}{{1,4}}[^\p{{L}}]{{1,2}})?$"
    yes = lambda c: F.when(F.coalesce(c, F.lit(False)), 1)
    check = yes(base_valid(kind, found)).otherwise(-1)
    listed = (
        F.when(kind == "email", F.lower(F.regexp_extract(found, r"([A-Za-z]+)$", 1)).isin(MAIL_ENDS))
        .when(kind == "card", digits.rlike(f"^(?:{'|'.join(CARD_STARTS)})"))
        .when(kind == "phone", found.rlike(rf"^\+(?:{'|'.join(COUNTRY_CODES)})(?![0-9]{{9}})"))
    )
    gazetteer = F.when(listed, 1).when(~listed, -1).otherwise(0)
    cue = F.lit(None)
    for k, cues in CUES.items():
        cue = F.when(kind == k, lower.rlike(word(cues))).otherwise(cue)
    context = F.when(lower.rlike(word(NO_CUES)), -1).when(cue, 1).otherwise(0)
    touching = F.col("before").rlike(r"[\p{L}\p{N}_]$") | F.col("after").rlike(r"^[\p{L}\p{N}_]")
    border = F.when(touching, -1).otherwise(1)
    regular = (
        F.when(kind == "card", found.rlike(r"^(?:[0-9]{14,19}|[0-9]{4}(?:[ -][0-9]{4}){3})$"))
        .when(kind == "phone", found.rlike(r"^\+?[0-9 ]{0,4}\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$"))
        .when(kind == "ip", ~found.rlike(r"(?:^|\.)0[0-9]"))
        .otherwise(~found.rlike(r"\.\.|^[.%+-]"))
    )
    layout = F.when(regular, 1).otherwise(-1)
    return spans.select("*", check.alias("check"), gazetteer.alias("gazetteer"), context.alias("context"), border.alias("border"), layout.alias("layout"))


@dataclass
class Reliability:
    """Per kind the share of true candidates, and per labeler and truth the shares of its votes."""

    prior: dict[str, float]
    share: dict[tuple[str, int, int, int], float]

    def probability(self, kind: str, vote: tuple[int, ...]) -> float:
        odds = math.log(self.prior[kind]) - math.log(1 - self.prior[kind])
        for i, v in enumerate(vote):
            odds += math.log(self.share[kind, i, 1, v]) - math.log(self.share[kind, i, 0, v])
        return 1 / (1 + math.exp(-max(min(odds, 500), -500)))


def estimate(patterns: dict[tuple[str, tuple[int, ...]], int], rounds: int = EM_ROUNDS) -> Reliability:
    """Expectation-maximisation over the counts of vote patterns (kind, votes).

    It starts from labelers that are right more often than not, which settles which of the
    two classes is the true one. Shares are smoothed, so none becomes 0 or 1.
    """
    kinds = sorted({k for k, _ in patterns})
    right = {1: {1: 0.7, 0: 0.2, -1: 0.1}, 0: {1: 0.1, 0: 0.2, -1: 0.7}}
    share = {(k, i, t, v): right[t][v] for k in kinds for i in range(len(VOTES)) for t in (0, 1) for v in (1, 0, -1)}
    now = Reliability({k: 0.5 for k in kinds}, share)
    for _ in range(rounds):
        p = {key: now.probability(*key) for key in patterns}
        prior, share = {}, {}
        for k in kinds:
            mine = [(vote, n, p[kind, vote]) for (kind, vote), n in patterns.items() if kind == k]
            total = sum(n for _, n, _ in mine)
            true = sum(n * q for _, n, q in mine)
            prior[k] = (true + 1) / (total + 2)
            for t, weight in ((1, true), (0, total - true)):
                for i in range(len(VOTES)):
                    for v in (1, 0, -1):
                        had = sum(n * (q if t else 1 - q) for vote, n, q in mine if vote[i] == v)
                        # The starting shares count as ten votes, so that rare kinds keep them.
                        share[k, i, t, v] = (had + 10 * right[t][v]) / (weight + 10)
        now = Reliability(prior, share)
    return now


def _table(rows: dict[tuple[str, ...], float], key: Column, otherwise: float) -> Column:
    """A bounded lookup table as a map expression."""
    if not rows:
        return F.lit(otherwise)
    flat = [F.lit(x) for k, v in rows.items() for x in ("|".join(k), float(v))]
    return F.coalesce(F.element_at(F.create_map(*flat), key), F.lit(otherwise))


def features(spans: DataFrame) -> Column:
    """``name=value`` of a candidate's shape and surroundings; every name has few values."""
    kind_of = lambda c: (
        F.when(F.length(c) == 0, "edge").when(c.rlike(r"\p{L}"), "letter").when(c.rlike("[0-9]"), "digit")
        .when(c.rlike(r"\s"), "blank").otherwise("mark")
    )
    found = F.col("found")
    named = {
        "length": F.least(F.floor(F.length(found) / 4), F.lit(12)).cast("string"),
        "digits": F.least(F.length(_digits(found)), F.lit(24)).cast("string"),
        "blanks": F.least(F.regexp_count(found, F.lit(" ")), F.lit(4)).cast("string"),
        "marks": F.least(F.regexp_count(found, F.lit(r"[^0-9A-Za-z ]")), F.lit(6)).cast("string"),
        "left": kind_of(F.right(F.col("before"), F.lit(1))),
        "right": kind_of(F.left(F.col("after"), F.lit(1))),
        "first": kind_of(F.left(found, F.lit(1))),
        **{v: F.col(v).cast("string") for v in VOTES},
    }
    return F.array(*[F.concat(F.lit(f"{name}="), value) for name, value in named.items()])


def find(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the numbers of base spans ``n_email, n_ip, n_card, n_phone``,
    ``base_sha256``, ``spans``, ``added_probability`` (the least of an added span; null without any).

    Spans are written ``kind:start:end``, in code points and by start and kind. A null text is an
    empty one and has none; repeated rows get equal results; an empty table gives no rows. Texts of any
    length are searched whole. A candidate is added when the
    classifier accepts it and it overlaps no base span; of added spans that overlap, the one that
    begins first stays, the longer of two. Other columns play no part.
    """
    found = scan(docs)
    base = staged(
        votes(_spans(found, "base").where(base_valid(F.col("kind"), F.col("found")))).withColumn("base", F.lit(True))
    )
    # A number that fails its check digit is no card, whatever stands around it.
    spans = _spans(found, "more").where((F.col("kind") != "card") | base_valid(F.col("kind"), F.col("found")))
    inside = spans.alias("s").join(
        base.select("row", F.col("start").alias("b0"), F.col("end").alias("b1")).alias("b"),
        (F.col("s.row") == F.col("b.row")) & (F.col("start") < F.col("b1")) & (F.col("b0") < F.col("end")),
        "left_anti",
    )
    candidates = staged(base.unionByName(votes(inside).withColumn("base", F.lit(False))))

    counted = candidates.groupBy("kind", *VOTES).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = {(r["kind"], tuple(r[v] for v in VOTES)): r["n"] for r in counted}
    model = estimate(patterns)
    soft = {(k, *map(str, v)): model.probability(k, v) for k, v in patterns}
    key = F.concat_ws("|", "kind", *[F.col(v).cast("string") for v in VOTES])
    labelled = candidates.withColumn("truth", _table(soft, key, 0.0)).withColumn("features", features(candidates))

    sums = (
        labelled.select("kind", "truth", F.explode("features").alias("feature"))
        .groupBy("kind", "feature")
        .agg(F.sum("truth").alias("true"), F.sum(1 - F.col("truth")).alias("false"))
        .collect()
    )
    totals = labelled.groupBy("kind").agg(F.sum("truth").alias("true"), F.sum(1 - F.col("truth")).alias("false")).collect()
    total = {r["kind"]: (r["true"], r["false"]) for r in totals}
    weight = {
        (r["kind"], r["feature"]): math.log((r["true"] + 1) / (total[r["kind"]][0] + 20))
        - math.log((r["false"] + 1) / (total[r["kind"]][1] + 20))
        for r in sums
    }
    prior = {(k,): math.log((t + 1) / (f + 1)) for k, (t, f) in total.items()}
    each = F.transform("features", lambda x: _table(weight, F.concat_ws("|", "kind", x), 0.0))
    odds = F.aggregate(each, _table(prior, F.col("kind"), 0.0), lambda a, x: a + x)
    scored = labelled.where(~F.col("base")).withColumn("p", 1 / (1 + F.exp(-odds)))
    accepted = scored.where(F.col("p") >= ACCEPT)

    # Of overlapping accepted spans: those that begin before the furthest end so far go.
    before = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    added = accepted.withColumn("reach", F.max("end").over(before)).where("reach is null or reach <= start")
    every = base.select("row", "kind", "start", "end", "base", F.lit(None).cast("double").alias("p")).unionByName(
        added.select("row", "kind", "start", "end", "base", "p")
    )
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    written = F.concat_ws(":", "kind", "start", "end")
    # A row's spans are gathered: no more than its text holds.
    listed = F.sort_array(F.collect_list(F.struct("start", place.alias("place"), "base", written.alias("written"))))
    per_row = every.groupBy("row").agg(
        listed.alias("list"),
        F.min("p").alias("added_probability"),
        *[F.count(F.when((F.col("kind") == k) & F.col("base"), 1)).alias(f"n_{k}") for k in KINDS],
    )
    joined_text = lambda xs: F.array_join(F.transform(xs, lambda x: x["written"]), ",")
    per_row = per_row.select(
        "row",
        *[f"n_{k}" for k in KINDS],
        joined_text(F.filter("list", lambda x: x["base"])).alias("base_spans"),
        joined_text(F.col("list")).alias("spans"),
        "added_probability",
    )
    none = F.lit("")
    return found.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base_spans", none), 256).alias("base_sha256"),
        F.coalesce("spans", none).alias("spans"),
        "added_probability",
    )
