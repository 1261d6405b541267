"""Mixing of sources to target weights by Pfair scheduling, in DataFrame functions only.

Every source's rows are dealt into blocks. Block i of a source with share w of a phase has release time floor(i / w) and
deadline ceil((i + 1) / w), counted from the phase's first slot; in each slot the released block with the earliest
deadline runs. As the shares add up to 1, every block meets its window, so at any slot of a phase, however long, a
source has run less than one block more or less than its weight asks for. A phase lasts until a source runs out; the
others go on with their weights in proportion. Every row gets exactly one place.
"""

import heapq

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut, literal_rows

#: Slots that one task schedules at a time; a source without weight gets one block in as many.
CYCLE = 1000
#: Shares are whole numbers of this sum, or less where block numbers times it would leave 64 bits.
SHARES = 10**12
BLOCK_ROWS = 32
BUCKET_ROWS = 50_000
LEAST_BUCKETS = 64
BROADCAST_ROWS = 500_000


def apportion(weights: dict[str, float], total: int) -> dict[str, int]:
    """Whole numbers of sum ``total`` in proportion to the weights by largest remainders, 1 at least."""
    total = max(total, len(weights))
    whole = sum(weights.values())
    exact = {s: (w / whole if whole > 0 else 1 / len(weights)) * total for s, w in weights.items()}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (parts[s] - exact[s], s))[:max(0, total - sum(parts.values()))]:
        parts[s] += 1
    while sum(parts.values()) > total:
        parts[max(parts, key=lambda s: (parts[s] - exact[s] if parts[s] > 1 else -1e9, s))] -= 1
    return parts


def shares_of(weights: dict[str, float], whole: int, cycle: int) -> dict[str, int]:
    """Shares of sum ``whole``: a ``cycle``-th for sources without weight, half of all at most, the rest in proportion."""
    weighty = {s: w for s, w in weights.items() if w > 0}
    if not weighty:
        return apportion(weights, whole)
    zero = len(weights) - len(weighty)
    each = max(1, min(whole // cycle, whole // (2 * max(zero, 1))))
    return dict.fromkeys(weights, each) | apportion(weighty, whole - zero * each)


def phase(blocks: list[int], shares: list[int], cycle: int) -> tuple[list[int], list[list[int]]]:
    """Blocks run by each source until one runs out, and the blocks run before every ``cycle``-th slot.

    Blocks are scheduled here once, in order, and only these counts are kept; tasks repeat the slots between them.
    """
    whole = sum(shares)
    done, starts = [0] * len(blocks), []
    waiting, ready = [(0, i) for i in range(len(blocks))], []
    for t in range(min(-(-n * whole // a) for n, a in zip(blocks, shares))):
        if t % cycle == 0:
            starts.append(list(done))
        while waiting and waiting[0][0] <= t:
            _, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(done[i] + 1) * whole // shares[i]), i))
        if not ready:
            if starts[-1] == done:
                starts.pop()
            break
        _, i = heapq.heappop(ready)
        done[i] += 1
        if done[i] < blocks[i]:
            heapq.heappush(waiting, (done[i] * whole // shares[i], i))
    return done, starts


def cycles(blocks: dict[str, int], weights: dict[str, float], cycle: int = CYCLE) -> list[dict]:
    """The phases that schedule all blocks, at most one for each source: first slot, slots, sum of shares, per source
    its blocks, first block and share, and the blocks run before every ``cycle``-th slot."""
    left, used, slot, found = dict(blocks), dict.fromkeys(blocks, 0), 0, []
    whole = min(SHARES, 2**62 // (max(blocks.values(), default=0) + 2))
    while any(left.values()):
        active = sorted(s for s, n in left.items() if n)
        shares = shares_of({s: weights[s] for s in active}, whole, cycle)
        done, starts = phase([left[s] for s in active], [shares[s] for s in active], cycle)
        found.append({"cycle": len(found), "first_slot": slot, "slots": sum(done), "repeats": 1, "whole": sum(shares.values()), "starts": starts, "parts": [
            {"source": s, "blocks": n, "first_block": used[s], "share": shares[s]} for s, n in zip(active, done)]})
        slot += sum(done)
        for s, n in zip(active, done):
            used[s] += n
            left[s] -= n
    return found


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def release_of(i: Column, whole: Column, share: Column) -> Column:
    return _div(i * whole, share)


def deadline_of(i: Column, whole: Column, share: Column) -> Column:
    return _div((i + 1) * whole + share - 1, share)


def edf_turns(whole: Column, shares: Column, blocks: Column, start: Column, first: Column, end: Column) -> Column:
    """(i, n) for each slot from ``first`` to ``end``: the source whose released block has the earliest deadline, and
    that block's number. ``start`` holds the blocks each source has run before."""
    def step(state: Column, t: Column) -> Column:
        def bid(done: Column, i: Column) -> Column:
            share = F.get(shares, i)
            return F.when((done < F.get(blocks, i)) & (release_of(done, whole, share) <= t),
                          F.struct(deadline_of(done, whole, share).alias("deadline"), i.alias("i"), done.alias("n")))

        bids = F.array_min(F.transform(state["done"], bid))
        # a one-element transform names the winner, so it is found once a slot
        return F.transform(F.array(bids), lambda pick: F.struct(
            F.transform(state["done"], lambda d, i: d + F.when(i == pick["i"], 1).otherwise(0)).alias("done"),
            F.concat(state["turns"], F.array(F.struct(pick["i"].alias("i"), pick["n"].alias("n")))).alias("turns")))[0]

    zero = F.struct(start.alias("done"), F.array().cast("array<struct<i:int,n:bigint>>").alias("turns"))
    return F.aggregate(F.sequence(first, end - 1), zero, step, lambda s: s["turns"])


def edf_order(slots: Column, blocks: Column) -> Column:
    """Index of the source that runs in each slot, where the numbers of blocks are the shares and fill all slots."""
    counts = blocks.cast("array<bigint>")
    turns = edf_turns(slots.cast("bigint"), counts, counts, F.transform(counts, lambda b: F.lit(0).cast("bigint")), F.lit(0).cast("bigint"), slots.cast("bigint"))
    return F.transform(turns, lambda t: t["i"])


def schedule(plan: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """(source, block, slot, release, deadline) of every block."""
    each = plan.select("cycle", "first_slot", "slots", "whole", "parts", F.posexplode("starts").alias("no", "start")).repartition("cycle", "no")
    first = F.col("no").cast("bigint") * cycle
    turns = edf_turns(F.col("whole"), F.transform("parts", lambda p: p["share"]), F.transform("parts", lambda p: p["blocks"]), F.col("start"),
                      first, F.least(first + cycle, "slots"))
    run = each.select("first_slot", "whole", "parts", first.alias("first"), F.posexplode(turns).alias("at", "turn"))
    run = run.withColumn("part", F.get("parts", F.col("turn.i")))
    n, whole, share = F.col("turn.n"), F.col("whole"), F.col("part.share")
    return run.select("part.source", (F.col("part.first_block") + n).alias("block"), (F.col("first_slot") + F.col("first") + F.col("at")).alias("slot"),
                      (F.col("first_slot") + release_of(n, whole, share)).alias("release"), (F.col("first_slot") + deadline_of(n, whole, share)).alias("deadline"))


def numbered(docs: DataFrame, source: Column, id_col: str, text_col: str | None) -> tuple[DataFrame, dict[str, int]]:
    """``docs`` with __source and __rank, a number from 0 within the source by hash of the id, and rows by source.

    Ranks are counted inside hash buckets and carried across by bucket totals, so no source lands in one task.
    """
    total = docs.count()
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_ROWS))
    version = F.xxhash64(F.col(text_col).cast("string")) if text_col else F.lit(0)
    hashed = docs.withColumns({"__source": source, "__hash": F.xxhash64(F.col(id_col).cast("string")), "__version": version})
    hashed = hashed.withColumn("__bucket", F.pmod(F.xxhash64("__hash", "__version"), F.lit(buckets)).cast("int"))
    sizes = cut(hashed.groupBy("__source", "__bucket").agg(F.count(F.lit(1)).alias("n")))
    earlier = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__source", "__bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    if sizes.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy("__source", "__bucket").orderBy("__hash", F.col(id_col), "__version")
    ranked = hashed.join(offsets, ["__source", "__bucket"]).withColumn("__rank", F.col("__before") + F.row_number().over(inside) - 1)
    rows = {r["__source"]: r["n"] for r in sizes.groupBy("__source").agg(F.sum("n").alias("n")).collect()}
    return ranked.drop("__hash", "__version", "__bucket", "__before"), rows


def mix(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = 0.5, block_rows: int = BLOCK_ROWS, cycle: int = CYCLE,
        id_col: str = "doc_id", source_col: str = "source", text_col: str | None = "text") -> DataFrame:
    """``docs`` with block, slot, release, deadline and position; ordered by position the sources mix to weight.

    ``weights`` are shares of blocks by source; without them a source weighs its number of rows to the power of
    ``exponent``. Sources missing in ``weights`` and weights of 0 get one block in ``cycle`` slots. A null source is a source of
    its own. Repeated rows and null ids get a place each; an empty table stays empty. A position is slot times
    ``block_rows`` plus the place in the block; only a source's last block may be short. One row per source (their
    names are configured) reaches the driver. Columns of these names in ``docs`` are replaced.
    """
    source = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    docs = docs.drop("block", "slot", "release", "deadline", "position")
    ranked, rows = numbered(docs, source, id_col, text_col)
    given = {f"={s}" if s is not None else "": w for s, w in (weights or {}).items()}
    weight = {s: given.get(s, 0.0) if weights else n**exponent for s, n in rows.items()}
    plan = cycles({s: -(-n // block_rows) for s, n in rows.items()}, weight, cycle)
    places = schedule(literal_rows(docs.sparkSession, plan, "cycle int, first_slot bigint, slots bigint, whole bigint, starts array<array<bigint>>, "
                                   "parts array<struct<source string, blocks bigint, first_block bigint, share bigint>>"), cycle)
    places = places.withColumnRenamed("source", "__source")
    # at most block_rows rows share a place, so a shuffle has no hot key
    if sum(p["slots"] for p in plan) <= BROADCAST_ROWS:
        places = F.broadcast(places)
    placed = ranked.withColumn("block", F.floor(F.col("__rank") / block_rows)).join(places, ["__source", "block"])
    position = (F.col("slot") * block_rows + F.col("__rank") % block_rows).cast("long")
    return placed.select(*[f"`{c}`" for c in docs.columns], "block", "slot", "release", "deadline", position.alias("position"))
