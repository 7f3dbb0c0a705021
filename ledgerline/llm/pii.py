"""Personal data: overlapping candidate spans, boosted trees, calibrated
thresholds; DataFrame and pyspark.ml operations only.

High-recall generators propose spans: the four base patterns and, over the
same text, narrower ones that still find a number when a base pattern has run
it together with its neighbour. Every candidate gets format features (digits,
separators, check sums, field ranges) and context features (what stands
before and after, key words near by). Gradient-boosted trees are fitted on a
bounded sample (``max_rows`` candidates, shared out by kind, those with the smallest
hashes of each; a rare kind's rows weigh more) with labels from the base
rules and the formats' check rules. All candidates are scored; on the held-out
fifth of all of them each kind gets the lowest probability cut at which
``MIN_PRECISION`` of what is above it is labelled, a prior of ``PRIOR``
candidates included (``cuts``). Base spans that meet their rule are always reported; other
candidates are reported where their probability reaches their kind's cut and
no reported base span already holds them.

Defined results: null texts are empty; null ids stay null; repeated rows each
get their row; an empty table gives an empty result; with labels of one class
only there are no trees and the candidates that meet their kind's rule are
reported; other columns are not read (``redact`` keeps them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.spans import Kind, all_matches, blanked, listed, placed, span_list
from ledgerline.llm.staging import documents, staged

MAX_ROWS = 20_000
MIN_PRECISION = 0.95
PRIOR = 5
MOST_WEIGHT = 50.0
TREES, DEPTH = 12, 3
MARK = "[PII]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# possessive forms of the base patterns: the same leftmost matches without
# rescanning a run of letters or digits from each of its places
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0, lambda value, size: size >= 9),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
ADDED = (
    Kind("card_number", r"(?<![0-9])[0-9]{4}([\x20-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}(?![0-9])"),
    Kind("phone_number", r"(?<![0-9A-Za-z+.-])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    Kind("mail_words", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:[(\[]dot[)\]]|\.)\x20?[A-Za-z0-9-]{2,63}+){1,4}"),
)
KINDS = BASE + ADDED
EMAIL, IP, CARD, PHONE, CARD_NUMBER, PHONE_NUMBER, SSN, IBAN, MAIL_WORDS = range(len(KINDS))

# a word for a phone with no digit between it and the number, and words for other numbers
PHONE_WORD = r"(?i)(?<![\p{L}])(?:tele)?(?:phones?|tel|call|mobile|cell|fax|anruf|contact|t\u00e9l)(?![\p{L}])[^0-9]*$"
OTHER_WORD = r"(?i)(?<![\p{L}])(?:version|release|build|v|ids?|ssn|serial|order|ticket|invoice)(?![\p{L}])[^0-9]*$"
# area and exchange of the North American plan, or an area with its trunk 0
NATIONAL = (r"^(?:\([2-9][0-9]{2}\)|[2-9][0-9]{2})[\x20.-][1-9][0-9]{2}[\x20.-][0-9]{4}$"
            r"|^(?:\(0[1-9][0-9]{0,2}\)|0[1-9][0-9]{0,2})[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}$")

KEYWORDS = {
    "near_phone": r"(?i)phone|tel|call|mobile|fax|anruf|contact|tél",
    "near_mail": r"(?i)mail|write to|reach|address",
    "near_card": r"(?i)card|visa|credit|account|konto|carte|tarjeta",
    "near_id": r"(?i)ssn|social|\bid\b|iban|passport",
    "near_version": r"(?i)version|release|build|\bv$",
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def _iban_rest(value: Column) -> Column:
    """The number of an IBAN, its first four places last and letters as 10 to 35, modulo 97."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    places = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""),
                         lambda c: F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    return F.aggregate(places, F.lit(0), lambda rest, x: (F.when(x > 9, rest * 100).otherwise(rest * 10) + x) % 97)


def _national(value: Column) -> Column:
    """A number without country code: 9 to 11 digits in the ranges of a national plan."""
    return F.length(_digits(value)).between(9, 11) & value.rlike(NATIONAL)


def rule(kind: Column, value: Column, before: Column) -> Column:
    """Whether a candidate meets its kind's own rule (the base kinds' is the
    contract). A national phone number needs a word for a phone before it."""
    n = F.length(_digits(value))
    return (F.when(kind == EMAIL, F.lit(True))
            .when(kind == IP, value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
            .when(kind.isin(CARD, CARD_NUMBER), _luhn(value))
            .when(kind == PHONE, n.between(10, 15))
            .when(kind == PHONE_NUMBER, F.when(value.startswith("+"), n.between(10, 15))
                  .otherwise(_national(value) & before.rlike(PHONE_WORD) & ~before.rlike(OTHER_WORD)))
            .when(kind == SSN, ~value.rlike(r"^(?:000|666|9)|-00-|-0000$"))
            .when(kind == IBAN, _iban_rest(value) == 1)
            .otherwise(value.rlike(r"[A-Za-z]{2,}$")))


def features() -> dict[str, Column]:
    """Format and context features of a candidate, all of them numbers."""
    value, before, after = F.col("_value"), F.col("_before"), F.col("_after")
    digits = _digits(value)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    out = {
        "size": F.least(F.length(value), F.lit(64)).cast("double"),
        "digits": F.least(F.length(digits), F.lit(40)).cast("double"),
        "letters": F.least(F.length(F.regexp_replace(value, "[^A-Za-z]", "")), F.lit(40)).cast("double"),
        "separators": F.least(F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")), F.lit(20)).cast("double"),
        "different": F.size(F.array_distinct(F.split(F.substring(digits, 1, 40), ""))).cast("double"),
        "plus": flag(value.startswith("+")), "at": flag(value.contains("@")), "brackets": flag(value.contains("(")),
        "luhn": flag(_luhn(value)),
        "octets": flag(value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        "phone_range": flag(F.length(digits).between(10, 15)),
        "national": flag(_national(value)),
        "phone_word": flag(before.rlike(PHONE_WORD)), "other_word": flag(before.rlike(OTHER_WORD)),
        "iban": flag(F.when(F.col("_kind") == IBAN, _iban_rest(value) == 1)),
        "ends_in_letters": flag(value.rlike(r"[A-Za-z]{2,}$")),
        "open_before": flag(before.rlike(r"(?:^|[\s(\[<\"':=,;])$")),
        "open_after": flag(after.rlike(r"^(?:$|[\s)\]>\"',;.!?])")),
        "digits_before": flag(before.rlike(r"[0-9]\S?$")), "digits_after": flag(after.rlike(r"^\S?[0-9]")),
        **{name: flag(before.rlike(words)) for name, words in KEYWORDS.items()},
        **{f"is_{k.name}": flag(F.col("_kind") == i) for i, k in enumerate(KINDS)},
    }
    return {f"_f_{k}": v for k, v in out.items()}


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All rows (``_row``, ``_id``, ``_key`` of the text) and their candidates."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(docs.sparkSession, docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(text).alias("_key"), all_matches(text, KINDS).alias("_found")), "pii-candidates")
    found = placed(rows.filter(F.size("_found") > 0), "_found", KINDS)
    found = found.select("_row", "_id", "_key", "_kind", "_start", "_end",
                         F.coalesce(rule(F.col("_kind"), F.col("_value"), F.col("_before")), F.lit(False)).alias("_valid"),
                         *[v.alias(k) for k, v in features().items()])
    return rows.drop("_found"), staged(docs.sparkSession, found, "pii-spans")


def quotas(counts: dict[int, int], max_rows: int) -> dict[int, int]:
    """``max_rows`` shared out evenly by kind; what a kind does not fill goes to the others."""
    out, left = {}, max_rows
    for i, (kind, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[kind] = min(n, left // (len(counts) - i))
        left -= out[kind]
    return out


def cuts(scored: DataFrame, min_precision: float = MIN_PRECISION) -> dict[int, float]:
    """For each kind the lowest probability from which on the precision reaches
    ``min_precision``: the share of labelled candidates, with ``PRIOR`` further
    ones that are right as often as the trees say at that probability. So a kind
    without any candidates is cut at ``min_precision`` itself, every kind has a
    cut, and counts take over steadily as a corpus grows."""
    bins: dict[int, dict[int, tuple[int, int]]] = {k: {} for k in range(len(KINDS))}
    for r in (scored.groupBy("_kind", F.floor(F.col("_p") * 100).cast("int").alias("_bin"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_valid").cast("int")).alias("good")).collect()):
        bins[r["_kind"]][r["_bin"]] = (r["n"], r["good"])
    out = {}
    for kind, by_bin in bins.items():
        n = good = 0
        for b in range(100, -1, -1):
            n, good = n + by_bin.get(b, (0, 0))[0], good + by_bin.get(b, (0, 0))[1]
            if good + PRIOR * b / 100 >= min_precision * (n + PRIOR):
                out[kind] = b / 100
    return out


def judged(spans: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Reported spans: ``_base`` ones that meet their rule, and others whose
    probability reaches their kind's cut."""
    spark = spans.sparkSession
    names = list(features())
    base = (F.col("_kind") < len(BASE)) & F.col("_valid")
    order = F.xxhash64("_id", "_key", "_kind", "_start")
    counts = {r["_kind"]: r["n"] for r in spans.groupBy("_kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = quotas(counts, max_rows)
    chance, weight = F.lit(0.0), F.lit(1.0)
    for kind, n in taken.items():
        chance = F.when(F.col("_kind") == kind, F.lit(n / counts[kind])).otherwise(chance)
        weight = F.when(F.col("_kind") == kind, F.lit(min(max(taken.values()) / max(n, 1), MOST_WEIGHT))).otherwise(weight)
    sample = staged(spark, spans.filter(F.shiftrightunsigned(order, 33) / float(1 << 31) < chance)
                    .orderBy(order).limit(max_rows).withColumn("_fold", F.pmod(order, F.lit(5))), "pii-sample")
    vectors = VectorAssembler(inputCols=names, outputCol="_features")
    learn = vectors.transform(sample.filter("_fold > 0")).select(
        "_features", F.col("_valid").cast("double").alias("_label"), weight.alias("_weight"))
    classes = {r["_label"] for r in learn.select("_label").distinct().collect()}
    if len(classes) < 2:
        return spans.filter("_valid").withColumn("_base", base).withColumn("_p", F.lit(1.0))
    trees = GBTClassifier(featuresCol="_features", labelCol="_label", weightCol="_weight", maxIter=TREES, maxDepth=DEPTH,
                          stepSize=0.3, seed=1).fit(learn.coalesce(2))
    scored = staged(spark, trees.transform(vectors.transform(spans)).withColumn("_p", vector_to_array("probability")[1])
                    .select(*[c for c in spans.columns if c not in names], "_p"), "pii-scored")
    found = cuts(scored.filter(F.pmod(order, F.lit(5)) == 0))
    passed = reduce(lambda a, b: a | b, [(F.col("_kind") == k) & (F.col("_p") >= v) for k, v in found.items()
                                         if k >= len(BASE)], F.lit(False))
    return scored.withColumn("_base", base).filter(F.col("_base") | passed)


def _reported(base: str, added: str) -> Column:
    """Base spans and the added ones that no base span holds."""
    outside = F.filter(F.col(added), lambda a: ~F.exists(
        F.col(base), lambda b: (b["start"] <= a["start"]) & (b["end"] >= a["end"])))
    return F.concat(F.col(base), outside)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans."""
    rows, spans = candidates(docs, id_col, text_col)
    counts = [F.count(F.when(F.col("_base") & (F.col("_kind") == i), 1)).alias(f"n_{k.name}") for i, k in enumerate(BASE)]
    found = judged(spans, **limits).groupBy("_row").agg(
        *counts, span_list(F.col("_base")).alias("_own"), span_list(~F.col("_base")).alias("_more"))
    zero = F.lit(0).cast("long")
    return (rows.join(found, "_row", "left")
            .select("_id", *[F.coalesce(f"n_{k.name}", zero).alias(f"n_{k.name}") for k in BASE],
                    F.sha2(F.coalesce(listed(F.col("_own"), KINDS), F.lit("")).cast("binary"), 256).alias("base_sha256"),
                    F.coalesce(listed(_reported("_own", "_more"), KINDS), F.lit("")).alias("spans")))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with all reported spans replaced by ``MARK``."""
    _, spans = candidates(docs, id_col, text_col)
    found = (judged(spans, **limits).groupBy("_id", "_key")
             .agg(F.array_sort(F.collect_set(F.struct(F.col("_start").alias("start"), F.col("_end").alias("end")))).alias("_pii_spans"))
             .select(F.col("_id").alias("_pii_id"), F.col("_key").alias("_pii_key"), "_pii_spans"))
    text = F.coalesce(docs[text_col], F.lit(""))
    joined = docs.join(found, docs[id_col].cast("long").eqNullSafe(found["_pii_id"])
                       & (F.xxhash64(text) == found["_pii_key"]), "left")
    new = F.when(F.col("_pii_spans").isNotNull(), blanked(F.col(f"`{text_col}`"), F.col("_pii_spans"), MARK))
    return joined.select(*[F.coalesce(new, F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`")
                           for c in docs.columns])


def op7_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).withColumnRenamed("_id", "doc_id")
