"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Spans of the base patterns (email, ip, card, phone with their checks) are always reported.  Further
candidates (numbers without ``+``, numbers that failed a check, emails spelt out) get votes from
six labelers: two regular expressions, a checksum, a gazetteer, the context before and the context
after.  The base spans are voted on too, so labelers are compared on them.  A candidate's votes
make a pattern; expectation-maximisation over the counted patterns (a small table, however large
the corpus) estimates within each kind how often each labeler votes for and against true and false
spans.  What is true is tied to the labelers' meaning: each labeler's error has an upper bound below
one half (``ERRORS``), so a vote never counts less than ``LEAST`` in its direction, and the hidden class
can't become another one.  The posteriors are soft labels on which a final
classifier of the span's shape, surroundings, checksum and gazetteer (naive Bayes over categorical
features, within each kind) is trained; candidates with positive log odds join the base spans.

DataFrame functions only.  Texts are scanned once: spans and their short contexts go to a written
table, and training and classification read that.  A span's offsets are code points, from the
lengths of what lies between and in the matches.  Patterns are written with possessive quantifiers
and left boundaries where that leaves the matches as they are, so a long run of digits or letters
costs linear time and no recursion.

Defined results: null and empty texts have no spans (counts 0, empty string); repeated rows each
get a row; an empty table gives no rows; without candidates the model adds nothing; ``keep``
columns keep their names, the operator's own begin with ``_``, others are dropped.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

KINDS = ("email", "ip", "card", "phone", "id")
BASE = 4  # the first four kinds have base patterns

# A local part begins at the start of a run of its characters or where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

NUMBER = r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){1,5}(?![0-9A-Za-z])"
SPELT = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]?(?:at|AT)[\])]?\x20?[A-Za-z0-9-]{1,64}\x20?[\[(]?(?:dot|DOT)[\])]?\x20?[A-Za-z]{2,12}(?![A-Za-z])"

# Gazetteers by kind: a pattern of what is listed (votes for) and of what is known as no one's
# (votes against).  Mail domains' endings; address blocks that name no person; issuer ranges of
# cards; country codes; numbers that are never given out.
GAZETTEERS = {
    "email": (r"(?i)(?:com|org|net|edu|gov|mil|info|biz|io|dev|app|me|co|eu|de|at|ch|fr|be|nl|lu|es|pt|it|uk|ie|us|ca|mx|br|ar|cl|au|nz|in|jp|cn|kr|pl|cz|se|no|dk|fi|ru|tr|za)$",
              r"(?i)(?:png|jpe?g|gif|svg|css|js|html?|pdf|zip|example|invalid|localhost|test)$"),
    "ip": (r"^$", r"^(?:0|10|127|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168|192\.0\.2|198\.51\.100|203\.0\.113|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."),
    "card": (r"^(?:4|5[1-5]|2[2-7]|3[47]|36|38|60|62|64|65|35)", r"^(?:0|1|7|8|9)"),
    "phone": (r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|^\(?[2-9][0-9]{2}\)?[\x20.-][2-9][0-9]{2}[\x20.-][0-9]{4}$", r"^\(?[01]"),
    "id": (r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$", r"^(?:000|666|9)|-00-|-0000$"),
}
FOR = r"(?i)(?:e-?mail|mail|contact|call|phone|tel|fax|mobile|card|visa|mastercard|iban|account|ssn|passport|ip|address|write to)\W{0,4}$"
AGAINST = r"(?i)(?:version|license|licence|page|isbn|doi|token|key|hash|order|line|year|total|sum|issue|no|nr)\W{0,4}$"
UNIT_AFTER = r"^(?:\x20?(?:%|kg|km|px|ms|mb|gb)|[.,:][0-9]|=|\x20?[*/x]\x20?[0-9])"

CONTEXT = 24
LABELERS = ("shape", "boundary", "checksum", "gazetteer", "before", "after")
FEATURES = ("digits", "joiner", "left", "right", "checksum", "gazetteer")
VALUES = 6  # a feature's values are 0 to VALUES - 1
ROUNDS = 12
# Upper bounds of the labelers' errors, so least weights of their votes: what fails its checksum
# isn't a card or address; the others are held to be right in three of five cases.
ERRORS = {"shape": 0.4, "boundary": 0.4, "checksum": 0.001, "gazetteer": 0.4, "before": 0.4, "after": 0.4}
LEAST = {j: math.log((1 - e) / e) for j, e in ERRORS.items()}
MOST = 8.0  # of any weight
PRIOR = 2.0  # of the prior log odds, either way


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, m, pre, post>>: all matches with short contexts."""
    def gather(parts: Column) -> Column:
        zipped = F.arrays_zip(parts.alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                              F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))).alias("q"))
        empty = F.array().cast("array<struct<start:int,end:int,m:string,pre:string,post:string>>")

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["p"])
            end = start + F.length(x["m"])
            span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m"), F.right(x["p"], F.lit(CONTEXT)).alias("pre"),
                            F.left(F.coalesce(x["q"], F.lit("")), F.lit(CONTEXT)).alias("post"))
            return F.when(x["m"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out")))

        return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), empty.alias("out")), step)["out"]

    none = F.array().cast("array<struct<start:int,end:int,m:string,pre:string,post:string>>")
    return F.when(text.rlike(pattern), let(F.split(text, pattern, -1), gather)).otherwise(none)


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = digits.substr(F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i))
    return total % 10 == 0


def passes(kind: int, m: Column) -> Column:
    if KINDS[kind] == "ip":
        return m.rlike("^" + r"\.".join([IP_PART] * 4) + "$")
    if KINDS[kind] == "card":
        return let(digits_of(m), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
    if KINDS[kind] == "phone":
        return F.length(digits_of(m)).between(8, 15)
    return F.lit(True)


def _passing(kind: int) -> Callable[[Column], Column]:
    return lambda s: passes(kind, s["m"])


def _of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda s: s["k"] == kind


def _tagged(spans: Column, kind: Column | int, base: bool) -> Column:
    number = (lambda s: F.lit(kind)) if isinstance(kind, int) else kind
    return F.transform(spans, lambda s: F.struct(
        number(s).cast("int").alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("m"),
        s["pre"].alias("pre"), s["post"].alias("post"), F.lit(base).alias("base")))


def found_spans(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``base`` spans and other ``more`` candidates of every row, written."""
    x = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = [_tagged(F.filter(matches(x, p), _passing(k)), k, True)
            for k, p in enumerate((EMAIL, IP, CARD, PHONE))]
    number = matches(x, NUMBER)
    sized = F.filter(number, lambda s: F.length(digits_of(s["m"])).between(7, 19))
    kind = lambda s: (F.when(s["m"].rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), 4)
                      .when(s["m"].rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), 1)
                      .when(F.length(digits_of(s["m"])) >= 16, 2).otherwise(3))
    more = F.concat(_tagged(sized, kind, False), _tagged(F.when(F.contains(F.lower(x), F.lit("dot")), matches(x, SPELT)), 0, False))
    more = F.coalesce(more, _tagged(sized, kind, False))
    spans = let(F.concat(*base), lambda b: F.struct(b.alias("base"), F.filter(
        more, lambda c: ~F.exists(b, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))).alias("more")))
    rows = docs.select(*[F.col(f"`{k}`") for k in keep], spans.alias("_s"))
    return written(rows.select(*[F.col(f"`{k}`") for k in keep], F.col("_s.base").alias("_base"), F.col("_s.more").alias("_more")), "pii")


def _listed(x: Column, known: str, nobody: str) -> Column:
    return F.when(x.rlike(nobody), -1).when(x.rlike(known), 1).otherwise(0)


def votes(s: Column, gazetteers: dict[str, tuple[str, str]] = GAZETTEERS) -> dict[str, Column]:
    """Each labeler's vote on a span: 1 for, -1 against, 0 abstains."""
    m, k = s["m"], s["k"]
    d = digits_of(m)
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    grouped = m.rlike(r"[0-9][\x20.)-]+[0-9]")
    sum_ok = F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)
    return {
        "shape": vote(m.rlike(r"^\+|^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$|@|^[0-9]{4}(?:[\x20-]?[0-9]{4}){3}$"),
                      k.isin(2, 3) & ~grouped),
        "boundary": vote(s["pre"].rlike(r"(?:^|\s)$") & s["post"].rlike(r"^(?:[.,;:!?]*(?:\s|$))"), s["pre"].rlike(r"[\w=#/]$") | s["post"].rlike(r"^[\w=#/]")),
        "checksum": F.when(k == 2, vote(sum_ok, ~sum_ok)).when(k == 1, vote(passes(1, m), ~passes(1, m))).otherwise(0),
        "gazetteer": functools.reduce(lambda c, i: c.when(k == i, _listed(m if KINDS[i] in ("phone", "ip", "id", "email") else d, *gazetteers[KINDS[i]])),
                                      range(1, len(KINDS)), F.when(k == 0, _listed(m, *gazetteers[KINDS[0]]))).otherwise(0),
        "before": vote(s["pre"].rlike(FOR), s["pre"].rlike(AGAINST)),
        "after": vote(F.lit(False), s["post"].rlike(UNIT_AFTER)),
    }


def features(s: Column, gazetteers: dict[str, tuple[str, str]] = GAZETTEERS) -> dict[str, Column]:
    """Shape and surroundings of a span, its checksum and gazetteer; each value is below VALUES."""
    voted = votes(s, gazetteers)
    m = s["m"]
    edge = lambda c, at: (F.when(c == "", 0).when(c.rlike(rf"\s{at}" if at == "$" else rf"{at}\s"), 1)
                          .when(c.rlike(rf"\w{at}" if at == "$" else rf"{at}\w"), 2)
                          .when(c.rlike(rf"[.,;:!?]{at}" if at == "$" else rf"{at}[.,;:!?]"), 3).otherwise(4))
    n = F.length(digits_of(m))
    return {
        "digits": F.when(n < 7, 0).when(n < 10, 1).when(n < 12, 2).when(n < 16, 3).when(n == 16, 4).otherwise(5),
        "joiner": F.when(m.rlike(r"[@\[]|(?i)at"), 0).when(m.rlike(r"^[0-9]+$"), 1).when(m.rlike("[+(]"), 2)
        .when(F.contains(m, F.lit("-")), 3).when(F.contains(m, F.lit(".")), 4).otherwise(5),
        "left": edge(s["pre"], "$"),
        "right": edge(s["post"], "^"),
        "checksum": voted["checksum"] + 1,
        "gazetteer": voted["gazetteer"] + 1,
    }


def _sum_of(weights: list, kind: Column, values: list[Column]) -> Column:
    """Sum of the prior and of each value's weight in the span's kind.  The weights are one constant,
    so new ones need no new code."""
    every = F.array(*(F.array(*(F.array(*(F.lit(float(w)) for w in row)) for row in rows)) for rows in weights))
    own = F.get(every, kind)
    return sum((F.get(F.get(own, F.lit(i)), v) for i, v in enumerate([F.lit(0), *values])), F.lit(0.0))


class Model:
    """Log odds of a span under the trained classifier: in each kind the prior, and a weight for each
    value of each feature."""

    def __init__(self, weights: list, gazetteers: dict[str, tuple[str, str]] = GAZETTEERS):
        self.weights, self.gazetteers = weights, gazetteers

    def log_odds(self, s: Column) -> Column:
        return _sum_of(self.weights, s["k"], list(features(s, self.gazetteers).values()))


def log_ratios(pattern: DataFrame, p: Column, names: list[str], size: int, smooth: float = 1.0) -> list:
    """In each kind the prior log odds, and for each column the log ratio of each of its values among
    true and among false spans, when a row stands for ``n`` spans that are true with probability ``p``."""
    each = [F.sum(F.when(F.col(c) == v, F.col("n") * q).otherwise(0.0)) for c in names for v in range(size) for q in (F.col("p"), 1 - F.col("p"))]
    both = [F.sum(F.col("n") * q) for q in (F.col("p"), 1 - F.col("p"))]
    out = [[[0.0]] + [[0.0] * size for _ in names] for _ in KINDS]
    for row in pattern.withColumn("p", p).groupBy("kind").agg(*[c.alias(f"c{i}") for i, c in enumerate(both + each)]).collect():
        kind, one, zero, *got = row
        at = iter(got)
        ratio = lambda: (math.log((next(at) + smooth) / (one + smooth * size))
                         - math.log((next(at) + smooth) / (zero + smooth * size)))
        out[kind] = [[math.log((one + smooth) / (zero + smooth))]] + [[ratio() for _ in range(size)] for _ in names]
    return out


def tied(weights: list) -> list:
    """Weights of votes (against, none, for) that keep their direction."""
    bound = lambda x, low, high: min(max(x, low), high)
    return [[[bound(prior, -PRIOR, PRIOR)]] + [[bound(a, -MOST, -LEAST[j]), bound(b, -0.5, 0.5), bound(c, min(LEAST[j], 1.0), MOST)]
                                               for j, (a, b, c) in zip(LABELERS, rows)] for (prior,), *rows in weights]


def estimate(pattern: DataFrame, rounds: int = ROUNDS) -> list:
    """EM over vote patterns (kind, a vote + 1 for each labeler, n): the tied weights."""
    weights = tied([[[0.0]] + [[-1.0, 0.0, 1.0] for _ in LABELERS] for _ in KINDS])
    for _ in range(rounds):
        weights = tied(log_ratios(pattern, posterior(weights), list(LABELERS), 3))
    return weights


def posterior(weights: list) -> Column:
    return 1 / (1 + F.exp(-_sum_of(weights, F.col("kind"), [F.col(x) for x in LABELERS])))


def train(found: DataFrame, rounds: int = ROUNDS, gazetteers: dict[str, tuple[str, str]] = GAZETTEERS) -> Model:
    """EM over vote patterns, then the classifier on the posteriors."""
    spans = found.select(F.explode(F.concat("_base", "_more")).alias("s"))
    s = F.col("s")
    cols = {"kind": s["k"], **{j: v + 1 for j, v in votes(s, gazetteers).items()}, **{f"f_{n}": v for n, v in features(s, gazetteers).items()}}
    pattern = written(spans.select(*[c.cast("int").alias(n) for n, c in cols.items()]).groupBy(*cols).agg(
        F.count("*").alias("n")), "pii-patterns")
    return Model(log_ratios(pattern, posterior(estimate(pattern, rounds)), [f"f_{n}" for n in FEATURES], VALUES), gazetteers)


def with_spans(docs: DataFrame, text: str = "text", keep: list[str] = ("doc_id",), gazetteers: dict[str, tuple[str, str]] = GAZETTEERS) -> DataFrame:
    """``keep`` columns, ``_s_base`` and ``_s_all``: arrays of struct<k, start, end> in order of
    kind and start; ``_s_all`` holds the base spans and those that the classifier adds."""
    found = found_spans(docs, text, list(keep))
    model = train(found, gazetteers=gazetteers)
    place = lambda a: F.transform(a, lambda s: F.struct(s["k"].alias("k"), s["start"].alias("start"), s["end"].alias("end")))
    added = F.filter("_more", lambda s: model.log_odds(s) > 0)
    return found.select(*[F.col(f"`{k}`") for k in keep], F.array_sort(place(F.col("_base"))).alias("_s_base"),
                        F.array_sort(place(F.concat("_base", added))).alias("_s_all"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: str = "text") -> Column:
    """For a row of ``with_spans``: its text with every span replaced by its kind in angle brackets; of spans that overlap, the
    first (then the longest) stands for all."""
    def step(acc: Column, s: Column) -> Column:
        cut = F.col(f"`{text}`").substr(acc["at"] + 1, s["start"] - acc["at"])
        put = F.concat(acc["out"], F.array(F.concat(cut, F.lit("<"), F.get(F.array(*map(F.lit, (k.upper() for k in KINDS))), s["k"]), F.lit(">"))))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), put.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    by_place = F.array_sort(F.transform("_s_all", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), s["end"].alias("end"), s["k"].alias("k"))))
    done = F.aggregate(by_place, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step)
    whole = let(done, lambda d: F.concat(F.array_join(d["out"], ""), F.col(f"`{text}`").substr(d["at"] + 1, F.length(F.col(f"`{text}`")))))
    return F.when(F.size("_s_all") > 0, whole).otherwise(F.col(f"`{text}`"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    spans = with_spans(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter("_s_base", _of_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(BASE)]
    return spans.select("doc_id", *counts, F.sha2(_joined(F.col("_s_base")).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("_s_all")).alias("spans"))
