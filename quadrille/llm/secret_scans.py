"""Secret scans weighed by corpus-wide ownership.

Candidates are found by pattern with their places. Every candidate value is then counted over the whole corpus: in how
many repositories (documents) and by how many owners (sources) it occurs, whatever its kind, whole copies of a text
once. A value that many owners carry, or that is all over the repositories of one, is a copied example; one that stays
in few places of its owner looks like a live credential. That separation sets the status of the base spans and decides
which free-standing tokens, too vague to report on their pattern alone, are added as spans.

Places come from the matches and the texts between them, so no Python looks at a text: a match begins where the
lengths of all that stands before it add up to, sums that a window makes per document, in time linear in the matches. A
value is a key that is counted, never a list; documents without a candidate never leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_of

#: Kinds in the order of the report, their patterns, the group that holds the value, its least length.
KINDS = {
    "assign": (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
    "owned": (r"[A-Za-z0-9_-]{24,}", 0, 24),
}
#: Runs below the least length cannot count, and no shorter run hides a longer one: the same matches, found faster.
_SEARCH = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}
BASE = ("assign", "access", "hex")
#: A value of at most so many owners is its owner's; of more, a copied example.
MOST_OWNERS = 1
#: A value in more distinct texts than this is a copied example, even within one owner.
MOST_REPOSITORIES = 5


def _matches(text: Column, kind: str, rank: int) -> Column:
    """Array of (rank, gap, n, value) of a kind's matches in order: the code points between a match and the one before,
    its own, and its value; shorter ones than the kind allows included, as the next match stands behind them."""
    pattern, group, _ = KINDS[kind]
    pattern = _SEARCH.get(kind, pattern)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    found = F.zip_with(
        F.slice(between, F.lit(1), F.size(whole)),
        F.arrays_zip(whole.alias("w"), value.alias("v")),
        lambda b, m: F.struct(F.lit(rank).alias("rank"), F.length(b).alias("gap"), F.length(m["w"]).alias("n"), m["v"].alias("value")),
    )
    return F.when(F.rlike(text, F.lit(pattern)), found)


def _mixed(value: Column) -> Column:
    """Digits, small and capital letters all occur: a free-standing token that no word looks like."""
    return F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[a-z]")) & F.rlike(value, F.lit("[A-Z]"))


def scan(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> tuple[DataFrame, DataFrame]:
    """Staged: the documents (``doc_id``, ``__row``), and their spans: ``__row``, ``rank`` (of the kind), ``start``,
    ``end``, ``hash`` of the value, ``copy`` (a digest of the text), ``repository`` and ``owner``. Free-standing tokens
    count as spans where they are apart from base spans."""
    rows = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("__row"),
        F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
        text_of("text").alias("text"),
    )
    matches = [F.coalesce(_matches(F.col("text"), kind, i), F.array()) for i, kind in enumerate(KINDS)]
    found = rows.select("doc_id", "__row", "repository", "owner", F.md5("text").alias("copy"), F.concat(*matches).alias("found"))
    scanned = stage(found.withColumn("found", F.when(F.size("found") > 0, F.col("found"))))
    held = scanned.where("found is not null").select("__row", "repository", "owner", "copy", F.posexplode("found").alias("at", "m"))
    held = held.select("__row", "repository", "owner", "copy", "at", "m.*")
    before = Window.partitionBy("__row", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.col("n")).cast("bigint")).over(before)
    held = held.withColumn("end", end).withColumn("start", F.col("end") - F.col("n"))
    least = F.get(F.array(*[F.lit(KINDS[k][2]) for k in KINDS]), F.col("rank"))
    held = held.where(F.length("value") >= least).where((F.col("rank") < len(BASE)) | _mixed(F.col("value")))
    # A token touches a base span if one of those that begin before its end reaches beyond its start. Both kinds of
    # ends rise, so of all that begin before the end the furthest decides.
    reach = Window.partitionBy("__row").orderBy("point", "first").rowsBetween(Window.unboundedPreceding, 0)
    is_base = F.col("rank") < len(BASE)
    lined = held.withColumns({"point": F.when(is_base, F.col("start")).otherwise(F.col("end") - 1), "first": F.when(is_base, F.lit(0)).otherwise(F.lit(1))})
    lined = lined.withColumn("reach", F.max(F.when(is_base, F.col("end"))).over(reach))
    apart = lined.where(is_base | F.col("reach").isNull() | (F.col("reach") <= F.col("start")))
    spans = apart.select("__row", "rank", "start", "end", F.xxhash64("value").alias("hash"), "copy", "repository", "owner")
    return scanned.select("doc_id", "__row"), stage(spans)


def ownership(spans: DataFrame) -> DataFrame:
    """Per candidate hash: ``repositories`` and ``owners`` that hold it, distinct, over the whole corpus.

    Documents with the same text are one: that of the least owner and repository. Distinct by (hash, text), then by
    (hash, owner) and (hash, repository) first, so a value that a third of all documents hold is spread over them; only
    counts meet. A null owner or repository is one of its own.
    """
    each = spans.groupBy("hash", "copy").agg(F.min(F.struct("owner", "repository")).alias("first")).select("hash", "first.*")
    pairs = each.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("x"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n")).groupBy("hash").agg(F.count(F.lit(1)).alias("owners"))
    held = pairs.groupBy("hash", "repository").agg(F.lit(1).alias("x")).groupBy("hash").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.join(held, "hash")


def scan_secrets(
    docs: DataFrame,
    repository: str = "doc_id",
    owner: str = "source",
    most_owners: int = MOST_OWNERS,
    most_repositories: int = MOST_REPOSITORIES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` (all spans as
    kind:start:end, comma-joined, by start and then kind), ``n_live`` (spans of a value that at most ``most_owners``
    owners hold, in at most ``most_repositories`` repositories) and ``n_example`` (the others).

    A null or empty text has no spans. Repeated rows and other copies of a text are reported each, but are one
    repository. Other columns are not read. An empty table gives no rows. A document's spans meet in one row, as its
    text did.
    """
    rows, spans = scan(docs, repository, owner)
    each = spans.join(ownership(spans), "hash")
    live = (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories)
    added = len(BASE)
    text = F.concat_ws(":", F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("rank")), F.col("start"), F.col("end"))
    item = F.struct("start", "rank", text.alias("t"))
    per_row = each.where((F.col("rank") < added) | live).groupBy("__row").agg(
        *[F.sum((F.col("rank") == i).cast("bigint")).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sort_array(F.collect_list(F.when(F.col("rank") < added, item))).alias("base"),
        F.sort_array(F.collect_list(item)).alias("all"),
        F.sum(live.cast("bigint")).alias("n_live"),
        F.sum((~live).cast("bigint")).alias("n_example"),
    )
    counts = [f"n_{k}" for k in BASE]
    full = per_row.select(
        "__row",
        *counts,
        F.sha2(F.array_join("base.t", ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join("all.t", ",").alias("spans"),
        "n_live",
        "n_example",
    )
    zero = F.lit(0).cast("bigint")
    out = rows.join(full, "__row", "left")
    return out.select(
        "doc_id",
        *[F.coalesce(c, zero).alias(c) for c in counts],
        F.coalesce("base_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"),
        F.coalesce("n_example", zero).alias("n_example"),
    )
