"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Patterns give candidates; each candidate's value is hashed, and the hashes are
counted over the whole corpus by different repositories and owners. A value
that stands in the texts of more than ``MAX_OWNERS`` owners or
``MAX_REPOSITORIES`` repositories is a widely copied example; one that does
not, and does not look like a placeholder, looks live. Besides the base kinds,
which are always reported, the method adds prefixed keys, web tokens and
private keys that look live.

A private key is a header line, its fields, and a base64 body whose first line
has at least 16 characters, up to the END line; without one (a cut text), up to
the last run of 16. Its value is the body, which is compared without line
breaks, escapes and quotes; a header without a body holds no secret.

An owner is a document's source; a repository is a source's part in one
language. Counts are taken over distinct (hash, owner, repository), combined
before the shuffle, so a value copied into a third of all documents is one row
per task.

Defined results: null texts are empty; a null owner or language counts as the
empty one; null ids stay null; repeated rows each get their row; an empty table
gives an empty result; other columns are not read (``redact`` keeps them).
Documents without candidates get empty lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.spans import Kind, all_matches, blanked, listed, placed, span_list
from ledgerline.llm.staging import documents, staged

MAX_OWNERS = 2
MAX_REPOSITORIES = 4
MARK = "[SECRET]"

BASE = (
    Kind("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2,
         lambda value, size: F.length(value) >= 6),
    Kind("access", r"AKIA[A-Z0-9]+", 0, lambda value, size: size >= 20),
    Kind("hex", r"[0-9a-f]{24,}"),  # a run of 24 or more is found from its start, shorter ones never count
)
# between the lines of a key: line breaks, also escaped ones, quotes and comment marks
_GAP = r"(?:\\++[nrt]|[\s\"',>#|\\])"
_END = r"-----END [A-Z ]{0,30}PRIVATE KEY-----"
_BODY = r"[A-Za-z0-9+/=]"
_INSIDE = r"[A-Za-z0-9+/=\s\"',>#|\\]"  # body and gaps: one class, so a key of any length is matched without recursion
ADDED = (
    Kind("key", r"(?<![A-Za-z0-9_-])(?:gh[oprsu]|glpat|[prs]k|xox[abprs])[-_][A-Za-z0-9_-]{16,}+"),
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Kind("pem", rf"-----BEGIN [A-Z ]{{0,30}}PRIVATE KEY-----{_GAP}{{0,64}}+"
                rf"(?:[A-Z][A-Za-z-]{{1,40}}+:\x20?[^\s\\]{{0,128}}+{_GAP}{{1,64}}+){{0,8}}+"
                rf"((?={_BODY}{{16}})(?={_INSIDE}*+{_END}){_INSIDE}*{_BODY}(?<!\\[nrt])(?={_GAP}{{0,64}}+{_END})"
                rf"|{_BODY}{{16,}}+(?:{_GAP}{{0,64}}+{_BODY}{{16,}}+)*+)", 1),  # possessive: a loop of any length, no recursion
)
KINDS = BASE + ADDED
PEM = len(KINDS) - 1
PLACEHOLDER = r"(?i)example|changeme|placeholder|your[-_]?|dummy|redacted|x{6,}|\*{4,}|0{8,}|123456"
# the shorter words stand by chance in a key body of thousands of characters
PEM_PLACEHOLDER = r"(?i)^(?:your|dummy)|example|changeme|placeholder|redacted|x{6,}|0{8,}|123456"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
               part_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All rows (``_row``, ``_id``, ``_key`` of the text) and their candidate spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    owner = F.coalesce(F.col(owner_col).cast("string"), F.lit(""))
    rows = staged(docs.sparkSession, docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(text).alias("_key"), owner.alias("_owner"),
        F.xxhash64(owner, F.coalesce(F.col(part_col).cast("string"), F.lit(""))).alias("_repository"),
        all_matches(text, KINDS).alias("_found")), "secret-candidates")
    spans = placed(rows.filter(F.size("_found") > 0), "_found", KINDS)
    spans = spans.select("_row", "_id", "_key", "_owner", "_repository", "_kind", "_start", "_end",
                         (F.col("_end") - F.length("_value")).alias("_value_start"),
                         F.xxhash64(F.when(F.col("_kind") == PEM, F.regexp_replace("_value", rf"{_GAP}+", ""))
                                    .otherwise(F.col("_value"))).alias("_hash"),
                         (F.when(F.col("_kind") == PEM, F.col("_value").rlike(PEM_PLACEHOLDER))
                          .otherwise(F.col("_value").rlike(PLACEHOLDER))
                          | (F.size(F.array_distinct(F.split("_value", ""))) < 6)).alias("_placeholder"))
    return rows.drop("_found"), staged(docs.sparkSession, spans, "secret-spans")


def ownership(spans: DataFrame) -> DataFrame:
    """Different owners and repositories of every candidate hash, written: a join
    straight on top of the grouping would keep all spans of a hot hash in one task."""
    counted = (spans.select("_hash", "_owner", "_repository").distinct()
            .groupBy("_hash", "_owner").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("_hash").agg(F.count(F.lit(1)).alias("_owners"), F.sum("_n").alias("_repositories")))
    return staged(spans.sparkSession, counted, "secret-owners")


def judged(spans: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Spans with ``_live``, without added kinds that do not look live."""
    live = (F.col("_owners") <= max_owners) & (F.col("_repositories") <= max_repositories) & ~F.col("_placeholder")
    return (spans.join(ownership(spans), "_hash").withColumn("_live", live)
            .filter((F.col("_kind") < len(BASE)) | F.col("_live")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         part_col: str = "lang", **limits) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, and
    how many look live or like examples."""
    rows, spans = candidates(docs, id_col, text_col, owner_col, part_col)
    base = F.col("_kind") < len(BASE)
    counts = [F.count(F.when(F.col("_kind") == i, 1)).alias(f"n_{k.name}") for i, k in enumerate(BASE)]
    found = judged(spans, **limits).groupBy("_row").agg(
        *counts, span_list(base).alias("_base"), span_list(F.lit(True)).alias("_all"),
        F.count(F.when(F.col("_live"), 1)).alias("n_live"), F.count(F.when(~F.col("_live"), 1)).alias("n_example"))
    zero = F.lit(0).cast("long")
    return (rows.join(found, "_row", "left")
            .select("_id", *[F.coalesce(f"n_{k.name}", zero).alias(f"n_{k.name}") for k in BASE],
                    F.sha2(F.coalesce(listed(F.col("_base"), KINDS), F.lit("")).cast("binary"), 256).alias("base_sha256"),
                    F.coalesce(listed(F.col("_all"), KINDS), F.lit("")).alias("spans"),
                    F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example")))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
           part_col: str = "lang", length_col: str = "n_chars", **limits) -> DataFrame:
    """``docs`` with the values of secrets that look live replaced by ``MARK``."""
    _, spans = candidates(docs, id_col, text_col, owner_col, part_col)
    live = (judged(spans, **limits).filter("_live")
            .select("_id", "_key", F.struct(F.col("_value_start").alias("start"), F.col("_end").alias("end")).alias("_s"))
            .groupBy("_id", "_key").agg(F.array_sort(F.collect_set("_s")).alias("_secret_spans"))
            .select(F.col("_id").alias("_secret_id"), F.col("_key").alias("_secret_key"), "_secret_spans"))
    text = F.coalesce(docs[text_col], F.lit(""))
    joined = docs.join(live, docs[id_col].cast("long").eqNullSafe(live["_secret_id"])
                       & (F.xxhash64(text) == live["_secret_key"]), "left")
    new = F.when(F.col("_secret_spans").isNotNull(), blanked(F.col(f"`{text_col}`"), F.col("_secret_spans"), MARK))
    marked = joined.withColumn("_secret_text", new)
    out = {text_col: F.coalesce("_secret_text", F.col(f"`{text_col}`")).alias(text_col)}
    if length_col in docs.columns:
        out[length_col] = F.coalesce(F.length("_secret_text").cast(docs.schema[length_col].dataType),
                                     F.col(f"`{length_col}`")).alias(length_col)
    return marked.select(*[out.get(c, F.col(f"`{c}`")) for c in docs.columns])


def redact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def op6_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).withColumnRenamed("_id", "doc_id")
