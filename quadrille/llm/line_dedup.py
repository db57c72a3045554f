"""Line dedup by a segment-partition edit join.

Lines that differ by at most ``threshold`` edits, cut into threshold + 1 segments, must agree in one whole segment.
Every distinct line is indexed under its own segments (length, segment number, text) and probes the segments of
all lines that are as long or up to ``threshold`` characters shorter, at the few positions where such a segment can
stand in it. Lines that meet under a key are verified with a banded bit-parallel edit distance: the band of 2 *
threshold + 1 diagonals is one machine word that slides along both lines. Everything is a column expression.

Meeting keys are found by counting (smallest and largest line per key, combined on the map side), so the many keys
of one line are dropped before any line is looked at. Lines that meet others are cut again, into twice as many segments,
and only those of which enough segments occur elsewhere stay. Lines are compared by pivots
(``graph.linked_classes``), first by their letters' counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, joined_small, number_rows, stage
from .graph import linked_classes

THRESHOLD = 2
#: Shorter lines are compared exactly: two edits may turn one short line into any other.
LEAST_CHARS = 20
#: Letters that are counted to tell lines apart before they are compared; any choice gives the same result.
LETTERS = "etaoinshrdlucmwf"
#: Fixed value: the white space of which a blank line consists.
BLANK = " \t\n\x0b\f\r"


def _probes(parts: int, threshold: int) -> Column:
    """The places where a line of a given length may hold a segment of a line that is as long or shorter: an array of
    (``shorter``, ``part`` from 1, ``shift``). A line's own segments are those with ``shorter`` and ``shift`` 0."""
    found = []
    for shorter in range(threshold + 1):
        for part in range(1, parts + 1):
            for shift in range(-threshold, threshold + 1):
                # Edits in front of the segment move it, those behind it make up for the lengths.
                if abs(shift) + abs(shorter - shift) > threshold:
                    continue
                # With one segment more than edits, the first equal segment has part - 1 edits in front at most; so
                # with the last one from behind.
                if parts == threshold + 1 and (abs(shift) > part - 1 or abs(shift - shorter) > parts - part):
                    continue
                found.append(F.struct(F.lit(shorter).alias("shorter"), F.lit(part).alias("part"), F.lit(shift).alias("shift")))
    return F.array(*found)


def segment_keys(lines: DataFrame, parts: int, threshold: int) -> DataFrame:
    """``lines`` (with ``line`` and its ``length``) once per key that they have: ``bucket``, ``shorter`` and ``part``.

    Segments are even, longer ones last. The probes are exploded before the segments are cut, so each key is a few
    generated instructions on its row.
    """
    rows = lines.withColumn("__probe", F.explode(_probes(parts, threshold))).select("*", "__probe.*").drop("__probe")
    indexed = F.col("length") - F.col("shorter")
    base = F.floor(indexed / parts).cast("int")
    spare = (indexed - base * parts).cast("int")
    rows = rows.withColumns({"__indexed": indexed, "__base": base, "__spare": spare})
    long_from = F.lit(parts) - F.col("__spare")
    at = (F.col("part") - 1) * F.col("__base") + F.greatest(F.lit(0), F.col("part") - 1 - long_from) + 1 + F.col("shift")
    size = F.col("__base") + F.when(F.col("part") > long_from, F.lit(1)).otherwise(F.lit(0))
    rows = rows.withColumns({"__at": at, "__size": size})
    rows = rows.where((F.col("__size") > 0) & (F.col("__at") >= 1) & (F.col("__at") + F.col("__size") - 1 <= F.col("length")))
    key = F.xxhash64(F.lit(parts), "__indexed", "part", F.substring(F.col("line"), F.col("__at"), F.col("__size")))
    return rows.withColumn("bucket", key).drop("__indexed", "__base", "__spare", "__at", "__size")


def _supported(nodes: DataFrame, threshold: int) -> DataFrame:
    """The nodes that may have a partner: of two linked lines, cut into twice as many segments, at most ``threshold``
    differ. A line whose segments occur in too few others, wherever, has no partner, so what
    merely shares a beginning with many is compared with none. Counts of keys only; no link is lost."""
    parts = 2 * (threshold + 1)
    keyed = segment_keys(nodes.select("node", "line", F.length("line").alias("length")), parts, threshold)
    keyed = keyed.select("node", "bucket", "shorter", "part")
    held = keyed.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("bucket")
    met = keyed.join(held, "bucket", "left_semi").groupBy("node", "shorter").agg(F.count_distinct("part").alias("n"))
    return met.where(F.col("n") >= parts - threshold).select("node").distinct()


def letter_counts(line: Column) -> Column:
    """Length and counts of frequent letters: an edit changes the surplus of one line over the other by one at most."""
    counts = [(F.length(line) - F.length(F.translate(line, c, ""))).alias(f"n_{c}") for c in LETTERS]
    return F.struct(F.length(line).alias("chars"), *counts)


def _surplus(a: Column, b: Column) -> Column:
    total = F.lit(0)
    for c in LETTERS:
        total = total + F.greatest(a[f"n_{c}"] - b[f"n_{c}"], F.lit(0))
    return total


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.get(F.transform(F.array(value), body), 0)


def _common(a: Column, b: Column, most: Column, part) -> Column:
    """Length of the common prefix (or suffix, by ``part``) of two texts, ``most`` at most, by halving steps."""
    steps = F.array(*[F.lit(1 << i) for i in range(20, -1, -1)])

    def grow(have: Column, step: Column) -> Column:
        return F.when((have + step <= most) & (part(a, have, step) == part(b, have, step)), have + step).otherwise(have)

    return F.aggregate(steps, F.lit(0), grow)


def within_edits(a: Column, b: Column, threshold: int = THRESHOLD) -> Column:
    """Whether two texts, each longer than ``threshold``, are at most ``threshold`` edits apart.

    What both share in front and behind is cut off first (but for a rim of the band's width). The word of the band
    holds the rows from ``threshold`` above to ``threshold`` below the diagonal; per character, one addition
    propagates along all of them.
    """
    k = threshold
    if not 1 <= k <= 28:
        raise ValueError("the band must fit a word: a threshold of 1 to 28")
    width = 2 * k + 1
    mask = (1 << width) - 1
    la, lb = F.length(a), F.length(b)
    shortest = F.least(la, lb)
    rim = k + 1

    def front(t: Column, have: Column, step: Column) -> Column:
        return F.substring(t, have + 1, step)

    def behind(t: Column, have: Column, step: Column) -> Column:
        return F.substring(t, F.length(t) - have - step + 1, step)

    def letters(cut: Column) -> Column:
        """Both as arrays of characters, cut once."""
        return F.struct(
            F.split(cut["a"], "").alias("x"), F.split(cut["b"], "").alias("y"), F.length(cut["a"]).alias("m"), F.length(cut["b"]).alias("n")
        )

    def decide(cut: Column) -> Column:
        x, y, m, n = cut["x"], cut["y"], cut["m"], cut["n"]

        def column(state: Column, j: Column) -> Column:
            here = F.get(y, j - 1)
            bits = F.lit(0).cast("bigint")
            for t in range(width):
                row = j - k + t
                hit = F.coalesce(F.when((row >= 1) & (row <= m), F.get(x, F.greatest(row - 1, F.lit(0))) == here), F.lit(False))
                bits = bits + F.when(hit, F.lit(1 << t).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            vp, vn, distance = state["vp"], state["vn"], state["d"]

            def step(match: Column) -> Column:
                carried = (match.bitwiseAND(vp) + vp).bitwiseAND(F.lit(mask)).bitwiseXOR(vp)
                return carried.bitwiseOR(match).bitwiseOR(vn)

            def update(d0: Column) -> Column:
                hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp)).bitwiseAND(F.lit(mask)))
                hn = d0.bitwiseAND(vp)
                down = F.shiftright(d0, 1)
                # Along the diagonal until the last row is in the band's lowest place, then along that row.
                last = F.greatest(m - j + k, F.lit(0))
                bit = F.expr("1L")
                along = F.call_function("shiftright", hp, last).bitwiseAND(bit) - F.call_function("shiftright", hn, last).bitwiseAND(bit)
                diagonal = 1 - F.shiftright(d0, 2 * k).bitwiseAND(bit)
                return F.struct(
                    hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(F.lit(mask))).alias("vp"),
                    down.bitwiseAND(hp).alias("vn"),
                    (distance + F.when(j <= m - k, diagonal).otherwise(along)).alias("d"),
                )

            return _let(bits, lambda match: _let(step(match), update))

        first = F.struct(
            F.lit(((1 << (k + 1)) - 1) << k).cast("bigint").alias("vp"),
            F.lit(0).cast("bigint").alias("vn"),
            F.lit(k).cast("bigint").alias("d"),
        )
        return F.aggregate(F.sequence(F.lit(1), n), first, column, lambda s: s["d"] <= k)

    def trimmed(ends: Column) -> Column:
        head = F.greatest(ends["p"] - rim, F.lit(0))
        tail = F.greatest(ends["s"] - rim, F.lit(0))
        return F.struct(
            F.substring(a, head + 1, la - head - tail).alias("a"), F.substring(b, head + 1, lb - head - tail).alias("b")
        )

    prefix = _common(a, b, shortest, front)
    ends = _let(prefix, lambda p: F.struct(p.alias("p"), _common(a, b, shortest - p, behind).alias("s")))
    near = _let(_let(_let(ends, trimmed), letters), decide)
    return F.when((la <= k) | (lb <= k) | (F.abs(la - lb) > k), F.lit(False)).otherwise(near)


def _lines(docs: DataFrame, columns: list[str]) -> DataFrame:
    exploded = docs.select(*columns, F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line_no", "line"))
    return exploded.where(F.ltrim("line", F.lit(BLANK)) != "").withColumn("length", F.length("line"))


def line_classes(
    docs: DataFrame, threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS
) -> DataFrame:
    """One row per line with something other than white space: ``doc_id``, ``__row`` (its document's number),
    ``line_no`` (from 0), ``chars``, ``class_id`` and ``kept``.

    Lines are in one class if they are equal, or, both of ``least_chars`` characters at least, connected by steps of
    at most ``threshold`` edits. The first line of a class, by ``doc_id`` (null last), row and position, is kept; the
    others are not. ``docs`` has ``doc_id``, ``text`` and ``__row``. Null and empty texts have no lines.
    """
    if least_chars <= threshold + 1:
        raise ValueError("least_chars must exceed the number of segments")
    lines = _lines(docs, ["doc_id", "__row"])
    ids = [F.xxhash64(F.lit(1), "line").alias("h1"), F.xxhash64(F.lit(2), "line").alias("h2")]
    long_ = lines.where(F.col("length") >= least_chars).select(*ids, "line", "length")
    # Cut once and written as two numbers a key; what meets nothing is dropped before any text is looked at again.
    keyed = stage(segment_keys(long_, threshold + 1, threshold).select("bucket", "h1"))
    shared = keyed.groupBy("bucket").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo < hi")
    met = stage(joined_small(keyed, stage(shared.select("bucket")), ["bucket"]).distinct())
    # The lines that meet others, with their texts; a node is a distinct line.
    hits = joined_small(long_.select("h1", "h2", "line"), stage(met.select("h1").distinct()), ["h1"])
    nodes = number_rows(hits.groupBy("h1", "h2").agg(F.min("line").alias("line")), "node")
    sized = nodes.select("h1", "node", letter_counts(F.col("line")).alias("size"))
    able = sized.join(_supported(nodes, threshold), "node", "left_semi")
    placed = stage(met.join(able, "h1").select("bucket", "node", "size"))

    def verify(pairs: DataFrame) -> DataFrame:
        near = pairs.join(nodes.select(F.col("node").alias("a"), F.col("line").alias("xa")), "a")
        near = near.join(nodes.select(F.col("node").alias("b"), F.col("line").alias("xb")), "b")
        return near.where(within_edits(F.col("xa"), F.col("xb"), threshold))

    def possible(a: Column, b: Column) -> Column:
        return (F.abs(a["chars"] - b["chars"]) <= threshold) & (_surplus(a, b) <= threshold) & (_surplus(b, a) <= threshold)

    classes = linked_classes(placed, verify, possible)
    said = lines.select("doc_id", "__row", "line_no", F.col("length").alias("chars"), *ids)
    if classes is None:
        said = said.withColumns({"c1": F.col("h1"), "c2": F.col("h2")})
    else:
        heads = nodes.select(F.col("node").alias("label"), F.col("h1").alias("c1"), F.col("h2").alias("c2"))
        moved = classes.where("node <> label").join(heads, "label").join(nodes.select("node", "h1", "h2"), "node")
        moved = stage(moved.select("h1", "h2", "c1", "c2"))
        said = joined_small(said, moved, ["h1", "h2"], "left")
        said = said.withColumns({"c1": F.coalesce("c1", "h1"), "c2": F.coalesce("c2", "h2")})
    said = stage(said)
    rank = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "__row", "line_no")
    # A line alone in its class is its first; only the others meet by class.
    firsts = said.groupBy("c1", "c2").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("held"))
    firsts = stage(firsts.where("held > 1").select("c1", "c2", "first"))
    out = joined_small(said, firsts, ["c1", "c2"], "left")
    same = (F.col("__row") == F.col("first.__row")) & (F.col("line_no") == F.col("first.line_no"))
    kept = F.col("first").isNull() | same
    name = F.lower(F.concat(F.lpad(F.hex("c1"), 16, "0"), F.lpad(F.hex("c2"), 16, "0")))
    return out.select("doc_id", "__row", "line_no", "chars", name.alias("class_id"), kept.alias("kept"))


def find_line_copies(docs: DataFrame, **options) -> DataFrame:
    """The classes of all lines of ``docs`` (``line_classes``), without row numbers.

    Only ``doc_id`` and ``text`` are read, so other columns cannot clash; repeated rows are documents of their own,
    whose lines are copies of each other. An empty table gives no rows.
    """
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("__row"))
    return line_classes(rows, **options).drop("__row")


def drop_line_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every column, their texts without the lines that copy an earlier one.

    A document that would lose every line it has is a copy as a whole and keeps its text: which document of a group
    stays is for a document-level operator to decide. Blank lines stay where they are. Null texts stay null.
    """
    number = fresh(docs, "__number")
    rows = number_rows(docs, number)
    found = line_classes(rows.select("doc_id", "text", F.col(number).alias("__row")), **options)
    lost = fresh(rows, "__lost")
    losses = found.groupBy(F.col("__row").alias(number)).agg(
        F.collect_list(F.when(~F.col("kept"), F.col("line_no"))).alias(lost), F.max("kept").alias("any")
    )
    losses = stage(losses.where(F.col("any") & (F.size(lost) > 0)).select(number, lost))
    lines = F.split(F.col("text").cast("string"), "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(lost, i)), "\n")
    out = rows.join(losses, number, "left")
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(left)
    return out.withColumn("text", text).select(*[F.col(f"`{c}`") for c in docs.columns])
