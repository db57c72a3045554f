"""Best-fit packing improved by a grouping genetic algorithm, on islands that exchange their elites.

Documents are tokenised and ended by a separator; only those longer than a window are cut, into full windows and a
first piece that may be shorter. Full pieces are sequences of their own. The others are dealt at random into problems of
about ``PROBLEM`` pieces, on each of which several islands breed packings, apart from each other:

* A population begins with best fit by decreasing length, and with best fits by lengths that are blurred at random.
* Crossover injects whole well-filled bins of one parent into the other, drops the bins there that hold one of their
  pieces already, along with the worst-filled ones and some of many short pieces, and puts the displaced pieces back: first in exchange for shorter
  ones where that fills a bin better, the rest by best fit.
* After every epoch an island's best packing migrates to the next island of its problem.

The best packing of all islands counts, and it is never worse than best fit decreasing. A problem whose packing meets
the lower bound is settled. A problem's size is fixed, so memory is bounded, and the tasks are as many as the input
asks for. Islands are rows of a staged table, so a lost executor costs the current epoch of its islands.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stage, text_of
from .packing import CapacityTree, encoder, narrowed, widened

WINDOW = 1024
SEPARATOR = 2
PROBLEM = 16_384
ISLANDS = 3
POPULATION = 4
EPOCHS = 3
GENERATIONS = 30
#: Share of a parent's bins that crossover injects, and of the other's that it opens besides.
INJECTED = 0.005
OPENED = 0.01
ISLANDS_PER_TASK = 4


def lower_bound(sizes: np.ndarray, window: int = WINDOW) -> int:
    """No packing has fewer bins: the sum over the window, or what pieces beyond half a window force.

    For every k up to half a window: pieces longer than window - k, and those longer than half, take a bin each; the
    pieces of k and more that are no longer than half must go into what the latter leave open, or into bins beyond.
    """
    held = np.bincount(sizes, minlength=window + 1)
    total = held * np.arange(window + 1)
    count_up, sum_up = np.cumsum(held[::-1])[::-1], np.cumsum(total[::-1])[::-1]
    half = window // 2
    best = -(-int(total.sum()) // window)
    for k in range(1, half + 1):
        alone = int(count_up[window - k + 1])
        large, large_sum = int(count_up[half + 1]) - alone, int(sum_up[half + 1] - sum_up[window - k + 1])
        small = int(sum_up[k] - sum_up[half + 1])
        best = max(best, alone + large + max(0, -(-(small - (large * window - large_sum)) // window)))
    return best


def fit_into(pieces: np.ndarray, sizes: np.ndarray, where: np.ndarray, fills: list[int], window: int) -> None:
    """Put ``pieces`` (numbers), longest first, each into the tightest bin that takes it; new bins are added to ``fills``."""
    tree = CapacityTree(window)
    for which, fill in enumerate(fills):
        if fill < window:
            tree.add(window - fill, which)
    for i in pieces:
        size = int(sizes[i])
        found = tree.take(size)
        if found is None:
            which, capacity = len(fills), window
            fills.append(0)
        else:
            which, capacity = found
        where[i] = which
        fills[which] += size
        if capacity > size:
            tree.add(capacity - size, which)


def best_fit(sizes: np.ndarray, order: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The bin of every piece, by best fit in the given order."""
    where, fills = np.zeros(len(sizes), np.int32), []
    fit_into(order, sizes, where, fills, window)
    return where


def exchange(free: list[int], sizes: np.ndarray, where: np.ndarray, fills: np.ndarray, bins: np.ndarray, window: int) -> list[int]:
    """Put displaced pieces into ``bins`` in place of one shorter piece each, wherever that leaves less open.

    Returns the pieces that are displaced now: shorter ones, which best fit places more easily.
    """
    members: dict[int, list[int]] = {}
    chosen = np.flatnonzero(np.isin(where, bins))
    for i in chosen[np.argsort(where[chosen], kind="stable")].tolist():
        members.setdefault(int(where[i]), []).append(i)
    by_size: dict[int, list[int]] = {}
    for i in free:
        by_size.setdefault(int(sizes[i]), []).append(i)
    present = np.zeros(window + 1, bool)
    present[list(by_size)] = True
    for which, held in members.items():
        room = window - int(fills[which])
        # A displaced piece that just fits; the others are better off with what then remains.
        options = np.flatnonzero(present[1 : room + 1])
        if len(options):
            size = 1 + int(options[-1])
            where[by_size[size].pop()] = which
            present[size] = bool(by_size[size])
            fills[which] += size
            continue
        for i in held:
            own = int(sizes[i])
            # The largest displaced piece that is longer than this one and still fits.
            options = np.flatnonzero(present[own + 1 : own + room + 1])
            if not len(options):
                continue
            size = own + 1 + int(options[-1])
            taken = by_size[size].pop()
            present[size] = bool(by_size[size])
            by_size.setdefault(own, []).append(i)
            present[own] = True
            where[taken], where[i] = which, -1
            fills[which] += size - own
            break
    return [i for each in by_size.values() for i in each]


def cross(
    a: np.ndarray, b: np.ndarray, sizes: np.ndarray, rng: np.random.Generator, window: int = WINDOW,
    injected: float = INJECTED, opened: float = OPENED,
) -> np.ndarray:
    """A child of two packings: ``a`` with whole well-filled bins of ``b``."""
    fill_a, fill_b = np.bincount(a, sizes).astype(np.int64), np.bincount(b, sizes).astype(np.int64)
    # By fill, ties at random: the best of twice as many as are injected.
    take = max(1, int(len(fill_b) * injected))
    well = np.lexsort([rng.random(len(fill_b)), -fill_b])
    full = max(2 * take, int(np.count_nonzero(fill_b == window)))
    chosen = np.zeros(len(fill_b), bool)
    chosen[rng.permutation(well[:full])[:take]] = True
    moved = chosen[b]
    gone = np.zeros(len(fill_a), bool)
    gone[a[moved]] = True
    # Full bins of many short pieces are opened too: those fill what long pieces leave open elsewhere.
    some = max(1, int(len(fill_a) * opened / 2))
    pieces = np.bincount(a, minlength=len(fill_a))
    gone[np.argsort(fill_a, kind="stable")[:some]] = True
    gone[np.argsort(rng.random(len(fill_a)) / pieces**2, kind="stable")[:some]] = True
    number = np.cumsum(~gone) - 1
    child = np.where(gone[a], -1, number[a]).astype(np.int32)
    kept = int(np.count_nonzero(~gone))
    child[moved] = (kept + np.cumsum(chosen) - 1)[b[moved]]
    fills = np.concatenate([fill_a[~gone], fill_b[chosen]])
    free = np.flatnonzero(child < 0)
    loose = np.flatnonzero(fills < window)
    loose = loose[rng.permutation(len(loose))]
    free = np.asarray(exchange(free.tolist(), sizes, child, fills, loose, window), np.int64)
    ends = fills.tolist()
    fit_into(free[np.argsort(-sizes[free], kind="stable")], sizes, child, ends, window)
    return child


def worth(packing: np.ndarray, sizes: np.ndarray) -> tuple[int, int]:
    """Fewer bins are better; of as many, those that are filled less evenly. Smaller is better."""
    fills = np.bincount(packing, sizes).astype(np.int64)
    return len(fills), -int((fills * fills).sum())


def evolve(
    sizes: np.ndarray, population: list[np.ndarray], seed: int | list[int], window: int = WINDOW, generations: int = GENERATIONS, size: int = POPULATION
) -> list[np.ndarray]:
    """The population after some generations, best first; an empty one is begun. Ends early at the lower bound."""
    rng = np.random.default_rng(seed)
    bound = lower_bound(sizes, window)
    if not population:
        population = [best_fit(sizes, np.argsort(-sizes, kind="stable"), window)]
    ranked = sorted(((worth(p, sizes), i, p) for i, p in enumerate(population)), key=lambda x: x[:2])
    while len(ranked) < size and ranked[0][0][0] > bound:
        blurred = sizes * np.exp(rng.normal(0, 0.02, len(sizes)))
        packing = best_fit(sizes, np.argsort(-blurred, kind="stable"), window)
        ranked = sorted([*ranked, (worth(packing, sizes), len(ranked), packing)], key=lambda x: x[:2])
    for turn in range(generations):
        if ranked[0][0][0] <= bound:
            break
        # The better of two is a parent.
        one, two = (min(rng.choice(len(ranked), 2)) for _ in range(2))
        if one == two:
            two = (one + 1) % len(ranked)
        child = cross(ranked[one][2], ranked[two][2], sizes, rng, window)
        entry = (worth(child, sizes), size + turn, child)
        if all(entry[0] != r[0] for r in ranked):
            ranked = sorted([*ranked, entry], key=lambda x: x[:2])[:size]
    return [p for *_, p in ranked]


_STATE = "grp bigint, island int, population binary, elite binary, bins int, open bigint, bound int"


def _evolved(window: int, generations: int, size: int):
    """Breeds every island (a row with ``sizes``, ``population`` and the ``migrant`` from its neighbour) for an epoch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                sizes = np.frombuffer(row.sizes, "<i4").astype(np.int64)
                held = [np.frombuffer(x, "<i4").reshape(-1, len(sizes)) for x in (row.population, row.migrant) if x is not None]
                population = evolve(sizes, [p for x in held for p in x], [row.grp, row.island, row.epoch], window, generations, size)
                bins, filled = worth(population[0], sizes)
                data = np.stack(population).astype("<i4").tobytes()
                best = population[0].astype("<i4").tobytes()
                yield pd.DataFrame([(row.grp, row.island, data, best, bins, filled, lower_bound(sizes, window))], columns=["grp", "island", "population", "elite", "bins", "open", "bound"])

    return run


def breed(
    problems: DataFrame, window: int = WINDOW, islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS, population: int = POPULATION
) -> DataFrame:
    """The best packing (``grp``, ``elite``, the 32-bit bin of every piece) of every problem (staged: ``grp``, ``sizes``)."""
    tasks = max(1, -(-problems.count() * islands // ISLANDS_PER_TASK))
    state, settled = None, None
    for epoch in range(epochs):
        rows = problems.select("grp", "sizes", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
        if state is None:
            rows = rows.withColumns({"population": F.lit(None).cast("binary"), "migrant": F.lit(None).cast("binary")})
        else:
            # The elite of the island before; problems that are settled have no rows any more.
            migrants = state.select("grp", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("elite").alias("migrant"))
            rows = rows.join(state.select("grp", "island", "population"), ["grp", "island"]).join(migrants, ["grp", "island"])
        rows = rows.withColumn("epoch", F.lit(epoch)).repartition(tasks, "grp", "island")
        found = stage(rows.mapInPandas(_evolved(window, generations, population), _STATE))
        best = found.groupBy("grp").agg(F.min_by("elite", F.struct("bins", "open", "island")).alias("elite"), (F.min("bins") <= F.min("bound")).alias("done"))
        best = stage(best)
        final = best if epoch == epochs - 1 else best.where("done")
        settled = final.select("grp", "elite") if settled is None else settled.unionByName(final.select("grp", "elite"))
        state = stage(found.join(best.where("not done").select("grp"), "grp", "left_semi"))
        left = state.select("grp").distinct().count()
        if not left:
            break
        tasks = max(1, -(-left * islands // ISLANDS_PER_TASK))
    return settled


def cut_pieces(
    rows: DataFrame, tokenizer: str, window: int = WINDOW, separator: int = SEPARATOR, with_ids: bool = False
) -> DataFrame:
    """One row per piece of every (``__row``, ``doc_id``, ``text``): of a longer document first what full windows leave."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"`__row` bigint, doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    end = np.asarray([separator], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                found: list[list] = [[] for _ in range(5 + with_ids)]
                for i, text in enumerate(part.column(2).to_pylist()):
                    data = made.encode(text) + end
                    total = len(data) // 4
                    starts = [0, *range(total % window or window, total, window)]
                    for number, (start, stop) in enumerate(zip(starts, [*starts[1:], total], strict=True)):
                        piece = data[4 * start : 4 * stop]
                        said = (i, number, start, stop - start, zlib.crc32(piece))
                        for column, value in zip(found, (*said, narrowed(piece)) if with_ids else said, strict=True):
                            column.append(value)
                origin = pa.array(found[0], pa.int64())
                columns = [part.column(0).take(origin), part.column(1).take(origin), pa.array(found[1], pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in found[2:5]]
                columns += [pa.array(x, pa.binary()) for x in found[5:]]
                names = ["__row", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return bounded_batches(rows.select("__row", "doc_id", "text")).mapInArrow(cut, schema)


def pack_pieces(pieces: DataFrame, window: int = WINDOW, problem: int = PROBLEM, **breeding) -> DataFrame:
    """``pieces`` (staged, with ``__row``, ``length``; at most one of a row shorter than the window) with
    ``sequence_id`` and ``offset``. A piece's problem is a digest of its row number, so a rerun packs alike."""
    rest = pieces.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // problem))
    dealt = rest.select("__row", F.col("length").cast("int").alias("length"), F.pmod(F.xxhash64("__row"), F.lit(groups)).alias("grp"))

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("__row")
        cells = [group["__row"].to_numpy("<i8").tobytes(), group["length"].to_numpy("<i4").tobytes()]
        return pd.DataFrame([(int(group["grp"].iloc[0]), *cells)], columns=["grp", "rows", "sizes"])

    problems = stage(dealt.groupBy("grp").applyInPandas(gather, "grp bigint, rows binary, sizes binary"))
    best = breed(problems.select("grp", "sizes"), window, **breeding)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                sizes, where = np.frombuffer(row.sizes, "<i4").astype(np.int64), np.frombuffer(row.elite, "<i4")
                order = np.lexsort([-sizes, where])
                before = np.cumsum(sizes[order]) - sizes[order]
                first = np.ones(len(order), bool)
                first[1:] = where[order][1:] != where[order][:-1]
                offset = before - np.maximum.accumulate(np.where(first, before, 0))
                number = (where[order].astype(np.int64) * groups + row.grp) * 2
                yield pd.DataFrame({"__row": np.frombuffer(row.rows, "<i8")[order], "sequence_id": number, "offset": offset})

    placed = problems.join(best, "grp").mapInPandas(spread, "`__row` bigint, sequence_id bigint, offset bigint")
    short = rest.join(placed, "__row")
    full = pieces.where(F.col("length") == window)
    full = full.withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("bigint"))
    return short.select(*full.columns).unionByName(full)


def pack_genetically(
    docs: DataFrame, tokenizer: str, window: int = WINDOW, separator: int = SEPARATOR, problem: int = PROBLEM, with_ids: bool = False, **breeding
) -> DataFrame:
    """One row per piece of every document: ``doc_id``, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32``,
    ``sequence_id`` and ``offset`` in the sequence (and ``ids``, little-endian unsigned 32-bit, if asked for).

    ``tokenizer`` is the path of a tokenizer file that every executor has; ``breeding`` are the options of ``breed``. A
    null or empty text is its separator alone. Documents of up to a window stay whole; of longer ones only the first
    piece may be shorter than the window. Pieces of a sequence follow each other without a gap. Repeated rows are
    documents of their own, ties are settled by row. Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("__row"), F.col("doc_id"), text_of("text").alias("text"))
    pieces = stage(cut_pieces(rows, tokenizer, window, separator, with_ids))
    packed = pack_pieces(pieces, window, problem, **breeding).drop("__row")
    return packed.withColumn("ids", widened(F.col("ids"), F.col("length"))) if with_ids else packed
