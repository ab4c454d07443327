"""Personal data by weak supervision, in DataFrame functions only.

Four strict patterns (email, ip, card, phone) and four wider ones (addresses spelled with at and dot, full IPv6 addresses,
cards with other separators, national phone numbers) propose spans. Six labelers vote on each proposal: the pattern with
its check (Luhn, part and digit bounds), gazetteers (top-level domains, calling codes, issuer prefixes, networks in use),
words before and after that speak for or against the kind, the characters at both ends, and the shape. Votes are counted by
pattern of votes, at most 4 x 3^6 rows; expectation-maximisation on that table estimates how often each labeler gives each
vote on true and on false spans of a kind, starting from and held near `_START`. The posteriors are soft labels for a logistic regression on
features of the span itself and of its neighbouring words, trained on about `TRAINED` spans at most (chosen by a hash).

Strict spans that pass their check always stay. Any other proposal is added if the classifier gives one half or more and it
does not overlap a strict span that stays. `findings` returns the spans with their scores, `personal_data` a row per document
with counts of the strict spans (n_email, n_ip, n_card, n_phone), their digest, all spans, and the number of added ones.

Strict patterns are written so that no run of characters is read twice, whatever its length; texts are read once and whole.

Defined results: null texts count as empty and have no spans; places are code points, end exclusive; rows that repeat, null ids
among them, are rows of their own; without proposals no model is fitted; if no proposal or every proposal is likely
true, the posterior itself is the score; an empty table gives no rows; of other columns only doc_id and text are read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import limit_for, spread_bits, stored

KINDS = ("email", "ip", "card", "phone")
#: Spans the classifier is trained on, at most about; rounds of expectation-maximisation; characters of context on each side.
TRAINED = 20_000
ROUNDS = 15
AROUND = 48
_BUCKETS = 256

# A strict pattern begins where the plain one can begin; possessive parts never give characters back.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
_PHONE = r"\+[0-9](?:[\x20().-]*+[0-9]){8,14}+(?![\x20().-]*+[0-9])"
_AT, _DOT = r"\x20?(?:\[at\]|\(at\)|\{at\})\x20?", r"(?:\x20?(?:\[dot\]|\(dot\)|\{dot\})\x20?|\.)"
_WIDE_EMAIL = rf"(?i)(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:{_AT}|\x20at\x20(?=[A-Za-z0-9-]++\x20dot\x20))[A-Za-z0-9-]++(?:(?:{_DOT}|\x20dot\x20)[A-Za-z0-9-]++)++"
_WIDE_IP = r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
_WIDE_CARD = r"(?<![0-9])[0-9]{4}([._/  –]|\x20{2})[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])"
_WIDE_PHONE = r"(?<![0-9A-Za-z+.(-])(?<![+0-9][\x20(-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z]|[.\x20-][0-9])"
#: (kind, strict, pattern, characters of which a text must hold one for the pattern to be looked for)
PATTERNS = (
    ("email", True, _EMAIL, r"@"), ("ip", True, _IP, r"[0-9]\.[0-9]"), ("card", True, _CARD, r"[0-9]{2}|[0-9][\x20-][0-9]"), ("phone", True, _PHONE, r"\+[0-9]"),
    ("email", False, _WIDE_EMAIL, r"(?i)[\[({\x20]at[\])}\x20]"), ("ip", False, _WIDE_IP, r"[0-9A-Fa-f]:[0-9A-Fa-f]"),
    ("card", False, _WIDE_CARD, r"[0-9]{4}[._/  –\x20]"), ("phone", False, _WIDE_PHONE, r"[0-9][)\x20./-]\x20?[0-9]"),
)
#: A number of at most 255, with zeros before it or not.
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

#: Fixed values, gazetteers: top-level domains; calling codes; issuer prefixes; networks that belong to nobody.
DOMAINS = "com org net edu gov mil int info biz io co me eu us uk de fr es it nl be at ch se no dk fi pl cz pt ie gr ru ua br mx ar ca au nz jp cn in kr za".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split()
ISSUERS = "4|5[1-5]|2[2-7]|3[0-9]|6(?:011|5|4[4-9])|62|50|5[6-8]"
NOBODY = r"^(?:0|127|22[4-9]|2[34][0-9]|25[0-5])\."
#: Fixed values, words that speak for a kind (English, German, French, Spanish), and words that speak against any.
WORDS_FOR = {
    "email": "mail email e-mail contact write reply kontakt schreiben courriel contacter correo contacto escribir address adresse",
    "ip": "ip host server client login address logged remote adresse serveur servidor dirección",
    "card": "card visa mastercard amex credit debit payment karte kreditkarte carte paiement tarjeta pago account",
    "phone": "phone tel telephone call mobile cell fax ring telefon handy anrufen téléphone appeler portable teléfono llamar móvil",
}
WORDS_AGAINST = "version release isbn issn doi section chapter token hash sha md5 key id serial invoice order build revision copyright license ticket"

LABELERS = ("pattern", "gazetteer", "words_for", "words_against", "ends", "shape")
#: What labelers are taken to do before votes are counted: shares of the votes -1, 0, 1 on true and on false spans, and how
#: many counted spans that belief weighs. The checks are arithmetic, so they begin as the surest.
_START = {
    "pattern": ((0.01, 0.29, 0.70), (0.80, 0.18, 0.02)), "gazetteer": ((0.10, 0.10, 0.80), (0.50, 0.10, 0.40)), "words_for": ((0.01, 0.59, 0.40), (0.01, 0.94, 0.05)),
    "words_against": ((0.03, 0.96, 0.01), (0.40, 0.59, 0.01)), "ends": ((0.05, 0.05, 0.90), (0.50, 0.10, 0.40)), "shape": ((0.05, 0.25, 0.70), (0.40, 0.30, 0.30)),
}
_BELIEF = 50.0
_SHARE = 0.5
_PROPOSALS = "array<struct<kind:int,strict:boolean,pattern:int,at:int,skipped:int,value:string,before:string,after:string>>"


def _proposal(kind: str, strict: bool, pattern: int) -> Callable[[Column, Column], Column]:
    return lambda x, at: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), F.lit(strict).alias("strict"), F.lit(pattern).alias("pattern"), at.alias("at"), F.length(x["gap"]).alias("skipped"),
        x["value"].alias("value"), F.right(x["gap"], F.lit(AROUND)).alias("before"), F.left(x["next"], F.lit(AROUND)).alias("after"),
    )


def proposals(docs: DataFrame) -> DataFrame:
    """row, doc_id and an array of proposals for every document; the texts are read once and left behind here.

    A text is split at the matches of a pattern, so the gaps between them give the places without a second search.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found, gaps = [], []
    for i, (_, _, pattern, trigger) in enumerate(PATTERNS):
        there = F.col("text").rlike(trigger)
        found.append(F.when(there, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias(f"found{i}"))
        gaps.append(F.when(there, F.split("text", pattern, -1)).alias(f"gaps{i}"))
    rows = rows.select("row", "doc_id", *found, *gaps)
    every = []
    for i, (kind, strict, _, _) in enumerate(PATTERNS):
        after = F.slice(f"gaps{i}", 2, F.greatest(F.lit(1), F.size(f"gaps{i}")))
        both = F.arrays_zip(F.col(f"found{i}").alias("value"), F.col(f"gaps{i}").alias("gap"), after.alias("next"))
        named = F.transform(both, _proposal(kind, strict, i))
        every.append(F.coalesce(F.filter(named, lambda x: x["value"].isNotNull()), F.lit([]).cast(_PROPOSALS)))
    return rows.select("row", "doc_id", F.concat(*every).alias("proposals"))


def passes_luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(digits)))

    def value(place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(place % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _by_kind(cases: dict[str, Column], otherwise: Column) -> Column:
    out = otherwise
    for kind, value in cases.items():
        out = F.when(F.col("kind") == KINDS.index(kind), value).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    return F.coalesce(F.when(yes, 1).when(no, -1), F.lit(0)).cast("int")


def _words(column: str) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit(r"[\p{L}][\p{L}-]*"), F.lit(0))


def voted(found: DataFrame) -> DataFrame:
    """The proposals, a row each, with their place and a vote of each labeler."""
    each = found.select("row", F.explode("proposals").alias("p")).select("row", "p.*")
    before = Window.partitionBy("row", "pattern").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum(F.col("skipped") + F.length("value")).over(before), F.lit(0))
    placed = each.withColumn("start", (passed + F.col("skipped")).cast("long")).withColumn("end", F.col("start") + F.length("value"))
    digits = F.regexp_replace("value", "[^0-9]", "")
    placed = placed.withColumn("digits", digits)
    # digit counts of strict cards and phones are part of their patterns; the wide pattern of ip finds no numbers with points
    parts = F.col("value").rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$") | ~F.col("strict")
    placed = placed.withColumn("good", _by_kind({"ip": parts, "card": passes_luhn(F.col("digits"))}, F.lit(True)))
    placed = placed.withColumn("base", F.col("strict") & F.col("good"))
    top = F.lower(F.regexp_extract("value", "([A-Za-z0-9-]+)$", 1))
    issued = F.col("digits").rlike(f"^(?:{ISSUERS})")
    called = F.col("digits").rlike(f"^(?:{'|'.join(CALLING)})")
    owned = ~F.col("value").rlike(NOBODY)
    gazetteer = _by_kind({"email": top.isin(DOMAINS), "ip": owned, "card": issued, "phone": F.when(F.col("strict"), called)}, F.lit(None).cast("boolean"))
    near = F.concat(_words("before"), F.slice(_words("after"), 1, 3))
    speaks = _by_kind({k: F.arrays_overlap(near, F.array(*map(F.lit, w.split()))) for k, w in WORDS_FOR.items()}, F.lit(False))
    against = F.arrays_overlap(near, F.array(*map(F.lit, WORDS_AGAINST.split())))
    left, right = F.right("before", F.lit(1)), F.left("after", F.lit(1))
    inside = left.rlike(r"[\p{L}\p{N}_]") | right.rlike(r"[\p{L}\p{N}_]")
    free = (left.rlike(r"^[\s\p{Punct}]$") | (left == "")) & (right.rlike(r"^[\s\p{Punct}]$") | (right == ""))
    even = F.col("value").rlike(r"^[0-9]+$|^[0-9]{4}(.{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$|^3[0-9]{3}(.)[0-9]{6}\2[0-9]{5}$")
    dull = F.col("digits").rlike(r"^(?:0*([0-9])\1*|0?123456789[0-9]*)$")
    shaped = _by_kind({
        "email": F.col("value").rlike(r"^[A-Za-z0-9][^@]*[A-Za-z]|^[A-Za-z]") & ~F.col("value").contains(".."), "ip": ~F.col("value").rlike(r"(?:^|\.)0[0-9]"),
        "card": even & ~dull, "phone": F.length("digits").between(9, 13) & F.col("value").rlike(r"[\x20().-]|^\+[0-9]+$") & ~dull,
    }, F.lit(False))
    votes = {
        "pattern": _vote(F.col("base"), ~F.col("good")), "gazetteer": _vote(gazetteer, ~gazetteer), "words_for": _vote(speaks, F.lit(False)),
        "words_against": _vote(F.lit(False), against), "ends": _vote(free, inside), "shape": _vote(shaped, ~shaped),
    }
    features = [
        F.log1p(F.length("value").cast("double")), F.log1p(F.length("digits").cast("double")), F.length("digits") / F.length("value"), left.rlike(r"[\p{L}\p{N}_]").cast("double"),
        right.rlike(r"[\p{L}\p{N}_]").cast("double"), F.col("strict").cast("double"), (~F.col("good")).cast("double"), dull.cast("double"),
        F.col("value").rlike(r"[\x20().-]").cast("double"), F.col("value").rlike(r"[A-Za-z]").cast("double"), speaks.cast("double"), against.cast("double"),
        *[((F.col("kind") == k) & f).cast("double") for k in range(len(KINDS)) for f in (F.lit(True), F.col("strict"))],
    ]
    return placed.select("row", "kind", "base", "start", "end", *[v.alias(k) for k, v in votes.items()], F.array(*features).alias("numbers"), near.alias("near"))


class Reliabilities:
    """Shares of the votes of each labeler on true and false spans of each kind, and the share of true ones."""

    def __init__(self) -> None:
        self.share = dict.fromkeys(range(len(KINDS)), _SHARE)
        self.given = {(k, j, y): _START[j][1 - y] for k in range(len(KINDS)) for j in LABELERS for y in (0, 1)}

    def posterior(self) -> Column:
        """Probability that a span with the votes of its row is true."""
        odds: dict[str, Column] = {}
        for k, kind in enumerate(KINDS):
            total = F.lit(math.log(self.share[k] / (1 - self.share[k])))
            for j in LABELERS:
                steps = [math.log(t / f) for t, f in zip(self.given[k, j, 1], self.given[k, j, 0], strict=True)]
                total = total + F.when(F.col(j) < 0, steps[0]).when(F.col(j) > 0, steps[2]).otherwise(steps[1])
            odds[kind] = total
        return 1 / (1 + F.exp(-F.least(F.lit(500.0), F.greatest(F.lit(-500.0), _by_kind(odds, F.lit(0.0))))))

    def refined(self, counted: list[Row]) -> Reliabilities:
        """One round: expected votes on true and false spans give new shares."""
        votes: dict[tuple, float] = {}
        for r in counted:
            odds = math.log(self.share[r["kind"]] / (1 - self.share[r["kind"]]))
            for j in LABELERS:
                odds += math.log(self.given[r["kind"], j, 1][r[j] + 1] / self.given[r["kind"], j, 0][r[j] + 1])
            true = r["n"] / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            for y, n in ((1, true), (0, r["n"] - true)):
                for key in [(r["kind"], y), *((r["kind"], j, y, r[j]) for j in LABELERS)]:
                    votes[key] = votes.get(key, 0.0) + n
        out = Reliabilities()
        for k in range(len(KINDS)):
            true, false = votes.get((k, 1), 0.0), votes.get((k, 0), 0.0)
            out.share[k] = (true + _BELIEF * _SHARE) / (true + false + _BELIEF)
            for j in LABELERS:
                for y, n in ((1, true), (0, false)):
                    out.given[k, j, y] = tuple((votes.get((k, j, y, v - 1), 0.0) + _BELIEF * _START[j][1 - y][v]) / (n + _BELIEF) for v in range(3))
        return out


def reliabilities(votes: DataFrame, rounds: int = ROUNDS) -> Reliabilities:
    """Estimated from `votes` (kind and a column per labeler), which Spark counts by pattern of votes: at most 4 x 3^6 rows,
    whatever the input, and these alone reach the driver."""
    counted = votes.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).cast("double").alias("n")).collect()
    out = Reliabilities()
    for _ in range(rounds):
        out = out.refined(counted)
    return out


def findings(found: DataFrame, trained: int = TRAINED, rounds: int = ROUNDS) -> DataFrame:
    """row, kind (index in KINDS), start, end, base, likely (posterior), score for every proposal of `proposals`."""
    votes = stored(voted(found))
    known = reliabilities(votes, rounds)
    likely = votes.withColumn("likely", known.posterior())
    learn = stored(likely.where(spread_bits("row", "kind", "start") < F.lit(limit_for(trained, votes.count()))))
    twice = learn.select("numbers", "near", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("likely").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("likely")).alias("weight")))).alias("y"))
    twice = twice.select("numbers", "near", "y.*").withColumn("dense", array_to_vector("numbers"))
    seen = learn.agg(F.min("likely").alias("low"), F.max("likely").alias("high")).first()
    if seen["low"] is None or seen["low"] >= 0.5 or seen["high"] < 0.5:
        return likely.select("row", "kind", "start", "end", "base", "likely", F.col("likely").alias("score"))
    stages = [
        HashingTF(inputCol="near", outputCol="hashed", numFeatures=_BUCKETS, binary=True), VectorAssembler(inputCols=["dense", "hashed"], outputCol="features"),
        LogisticRegression(weightCol="weight", regParam=0.003, maxIter=40, standardization=True),
    ]
    model = Pipeline(stages=stages).fit(twice)
    scored = model.transform(likely.withColumn("dense", array_to_vector("numbers")))
    return scored.select("row", "kind", "start", "end", "base", "likely", vector_to_array("probability")[1].alias("score"))


def chosen(rows: DataFrame) -> DataFrame:
    """Of `findings`, the strict spans that pass and those added: likely ones that no strict span overlaps."""
    # two sorted passes: a frame that reaches to the last row would be read again for every row
    one = Window.partitionBy("row").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.max(F.when(F.col("base"), F.col("end"))).over(one.orderBy("start", "kind", "end"))
    begins = F.min(F.when(F.col("base"), F.col("start"))).over(one.orderBy(F.desc("start"), F.desc("kind"), F.desc("end")))
    marked = rows.withColumn("ended", F.coalesce(ended, F.lit(-1))).withColumn("begins", begins)
    clear = (F.col("ended") <= F.col("start")) & (F.col("begins").isNull() | (F.col("begins") >= F.col("end")))
    return marked.where(F.col("base") | ((F.col("score") >= 0.5) & clear)).drop("ended", "begins")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _base_of(kind: int) -> Callable[[Column], Column]:
    return lambda s: s["base"] & (s["kind"] == kind)


def personal_data(docs: DataFrame, trained: int = TRAINED, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for every document."""
    found = stored(proposals(docs))
    rows = chosen(findings(found, trained, rounds))
    # the spans of one document, no more than its text holds
    per = rows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "base"))).alias("every"))
    out = found.select("row", "doc_id").join(per, "row", "left").withColumn("every", F.coalesce("every", F.lit([]).cast("array<struct<start:bigint,kind:int,end:bigint,base:boolean>>")))
    base = F.filter("every", lambda s: s["base"])
    counts = [F.size(F.filter("every", _base_of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("every")).alias("spans"), F.size(F.filter("every", lambda s: ~s["base"])).cast("long").alias("n_added"))
