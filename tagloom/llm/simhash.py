"""SimHash near-duplicates found by the generalised pigeonhole principle.

A text's words (A-Z lower-cased, cut at ASCII white space) form shingles of four; a bit of its fingerprint is set if
it is set in over half of the shingles' XXH64 values. Fingerprints link at `distance` or fewer differing bits.

If the thresholds of m parts of the bits add up to distance - m + 1, two linked fingerprints are within its threshold
in at least one part. Bits that vary together share a part; the thresholds, unequal and down to -1 (part unused), come
from a dynamic programme over estimated candidate counts, as does m. Each part is probed with all values within its
threshold and candidates are verified on all bits.

Equal texts, and equal fingerprints, are merged first. Null and empty texts have fingerprint zero and link like any
other; rows without id get the component of their fingerprint; repeated rows give a row each.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import LOWER, packed, per_text, stored, unpacked
from tagloom.llm.components import connected_components
from tagloom.operators.joins import spread_join

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Members of a bucket above which it is compared in blocks of `BLOCK` members, in Python, with one link per merge.
LARGE_BUCKET = 256
BLOCK = 8192


def fingerprint(raw: bytes, size: int = SHINGLE) -> int:
    """The fingerprint of a whole text as an unsigned 64-bit number."""
    words = raw.translate(LOWER).split()
    if not words:
        return 0
    text = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0] + [end + 1 for end in ends[:-1]]
    spans = zip(starts, ends[size - 1 :] or ends[-1:])
    hashed = xxhash.xxh64_intdigest
    values = np.array([hashed(text[a:b], SEED) for a, b in spans], dtype="<u8")
    # blocks keep the unpacked bits of a very long text small
    ones = np.zeros(BITS, dtype=np.int64)
    for block in range(0, len(values), 1 << 16):
        part = values[block : block + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", size: int = SHINGLE) -> DataFrame:
    """`keep` and fp, the fingerprint's bits as a signed long."""

    def factory():
        return lambda raw: (((f := fingerprint(raw, size)) ^ (1 << 63)) - (1 << 63),)

    return per_text(docs, factory, "fp long", keep, text)


def bit_agreement(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and, for every two bits, in how many both are set: one small row from each task."""

    def run(batches):
        total, both = 0, np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(values, axis=1, bitorder="little").astype(np.float32)
            total += len(bits)
            both += np.rint(bits.T @ bits).astype(np.int64)
        cells = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(np.append(both.ravel(), total), pa.int64())], names=["cell", "n"]
        )

    sums = nodes.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(BITS * BITS + 1, dtype=np.int64)
    for row in sums.collect():  # 4,097 rows, whatever the input
        flat[row.cell] = row.n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def correlated_parts(total: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m parts of nearly equal size, correlated bits together."""
    share = both / max(1, total)
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    relation = np.abs((share - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(relation, 0)
    free, parts = list(range(BITS)), []
    for k in range(m):
        size = (BITS - sum(map(len, parts))) // (m - k)
        inside = relation[np.ix_(free, free)]
        part = [free[int(inside.sum(1).argmax())]]
        rest = [b for b in free if b != part[0]]
        while len(part) < size:
            nearest = max(rest, key=lambda b: (relation[b, part].sum(), -b))
            part.append(nearest)
            rest.remove(nearest)
        parts.append(sorted(part))
        free = rest
    return parts


def part_value(bits: list[int]) -> Column:
    """These bits of the fingerprint, others zero."""
    return F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _equal_pairs(nodes: DataFrame, parts: list[list[int]]) -> list[float]:
    """For each part, the number of pairs of fingerprints with equal bits there, exact, from bucket sizes."""
    sides = F.array(*[F.struct(F.lit(k).alias("part"), part_value(p).alias("value")) for k, p in enumerate(parts)])
    sizes = nodes.select(F.inline(sides)).groupBy("part", "value").count()
    pairs = sizes.groupBy("part").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("n"))
    found = {row.part: row.n for row in pairs.collect()}
    return [found.get(k, 0.0) for k in range(len(parts))]


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds from -1 for each part that add up to `budget` at least cost; costs[k][t + 1] is that of threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for index, more in enumerate(options):
                at = (spent + index - 1, (cost + more, [*chosen, index - 1]))
                if at[0] not in step or at[1][0] < step[at[0]][0]:
                    step[at[0]] = at[1]
        best = step
    return best[budget]


def plan_parts(nodes: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Parts of the bits with their thresholds, unused ones left out, at the least estimated cost.

    The cost of a threshold is its probes, one for each value within it of each fingerprint, and its candidates:
    exact pair counts of equal values, scaled by the number of values probed. Only this plan reaches the driver.
    """
    counted, both = bit_agreement(nodes)
    # probes have a price also where there is nothing to probe with
    total, plans = max(1, counted), []
    for m in range(2, distance + 2):
        parts = correlated_parts(total, both, m)
        equal = _equal_pairs(nodes, parts)
        costs = []
        for bits, pairs in zip(parts, equal):
            options, probes = [0.0], 0
            for t in range(distance + 1):
                probes += comb(len(bits), t)
                spread = total * (total - 1) / 2 / 2.0 ** len(bits)
                # a probe costs some three verified candidates: it is shuffled, they are not
                options.append(3.0 * total * (1 + probes) + pairs + spread * (probes - 1))
            costs.append(options)
        cost, chosen = allocate(costs, distance - m + 1)
        plans.append((cost, [(bits, t) for bits, t in zip(parts, chosen) if t >= 0]))
    return min(plans, key=lambda plan: plan[0])[1]


def _masks(bits: list[int], threshold: int) -> list[int]:
    """Signed 64-bit masks of all changes of at most `threshold` of these bits, no change first."""
    return [_signed(sum(1 << b for b in some)) for t in range(threshold + 1) for some in combinations(bits, t)]


def candidate_buckets(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """part, value, fp, own: every fingerprint in the bucket of its value (own) and of the values it probes.

    Of two fingerprints that differ in a part, the one with the smaller value probes the other's bucket.
    """
    out = None
    for k, (bits, threshold) in enumerate(plan):
        masks = F.array(*[F.lit(m) for m in _masks(bits, threshold)])
        own = part_value(bits).alias("own_value")
        rows = nodes.select("fp", own).select("fp", "own_value", F.explode(masks).alias("mask"))
        rows = rows.withColumn("value", F.col("own_value").bitwiseXOR(F.col("mask")))
        rows = rows.where(F.col("value") >= F.col("own_value"))
        rows = rows.select(F.lit(k).alias("part"), "value", "fp", (F.col("mask") == 0).alias("own"))
        out = rows if out is None else out.unionByName(rows)
    return out


def near_links(nodes: DataFrame, plan: list[tuple[list[int], int]], distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of all links within `distance`.

    Buckets of at most LARGE_BUCKET members are joined with themselves in Spark. The members of a larger one are dealt
    to blocks; every two blocks meet in one group, compared in numpy, and give only links that join what that group
    has not joined yet. No candidate is left out either way.
    """
    rows = stored(candidate_buckets(nodes, plan), "buckets")
    sizes = rows.groupBy("part", "value").agg(F.count("*").alias("n"), F.max(F.col("own").cast("int")).alias("used"))
    live = sizes.where((F.col("n") > 1) & (F.col("used") == 1)).select("part", "value", "n")
    live = stored(live, "sizes")
    close = F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= distance
    once = (F.col("l.fp") < F.col("r.fp")) | ~F.col("r.own")
    small = rows.join(live.where(F.col("n") <= LARGE_BUCKET), ["part", "value"], "left_semi")
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("part", "value")]
    found = small.where("own").alias("l").join(small.alias("r"), [*same, once, F.col("l.fp") != F.col("r.fp"), close])
    found = found.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    return found.unionByName(_large_bucket_links(rows, live, distance))


def _large_bucket_links(rows: DataFrame, live: DataFrame, distance: int) -> DataFrame:
    large = rows.join(live.where(F.col("n") > LARGE_BUCKET), ["part", "value"])
    blocks = F.ceil(F.col("n") / BLOCK)
    mine = F.pmod(F.xxhash64("fp"), blocks)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1), lambda other: F.struct(F.least(other, mine).alias("i"), F.greatest(other, mine).alias("j"))
    )
    dealt = large.select("part", "value", "fp", "own", mine.alias("mine"), F.explode(pairs).alias("pair"))
    dealt = dealt.select("part", "value", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "mine", "fp", "own")

    def links(group: pa.Table) -> pa.Table:
        fp = group["fp"].to_numpy().astype(np.int64).view(np.uint64)
        mine, own = group["mine"].to_numpy(), group["own"].to_numpy(zero_copy_only=False)
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        a, b = _spanning(fp[mine == i], own[mine == i], fp[mine == j], own[mine == j], i == j, distance)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return dealt.groupBy("part", "value", "i", "j").applyInArrow(links, "a long, b long")


def _spanning(left, left_own, right, right_own, same: bool, distance: int, rows: int = 256):
    """Links of a forest that spans the close pairs of two blocks of one bucket; a pair needs one member of its own."""
    fps, where = np.unique(left if same else np.concatenate([left, right]), return_inverse=True)
    at_left = where[: len(left)]
    at_right = at_left if same else where[len(left) :]
    label, a, b = np.arange(len(fps)), [], []
    for start in range(0, len(left), rows):
        some = slice(start, start + rows)
        near = np.bitwise_count(left[some, None] ^ right[None, :]) <= distance
        near &= left_own[some, None] | right_own[None, :]
        for x, close in enumerate(near, start):
            u, others = at_left[x], at_right[close]
            others = others[label[others] != label[u]]
            while len(others):
                v = others[0]
                a.append(fps[u])
                b.append(fps[v])
                label[label == label[v]] = label[u]
                others = others[label[others] != label[u]]
    return np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)


def simhash_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """key, fp and component (the smallest key that can be reached) of every row. `key` may be of any ordered type."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    marked = stored(fingerprints(rows, ("_key",), "_text", size), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("_key").alias("first")), "nodes")
    plan = plan_parts(nodes, distance)
    joined = connected_components(near_links(nodes, plan, distance))
    grouped = nodes.join(joined, F.col("fp") == F.col("node"), "left")
    grouped = stored(grouped.select("fp", "first", F.coalesce("component", "fp").alias("root")), "grouped")
    least = grouped.groupBy("root").agg(F.min("first").alias("component"))
    named = spread_join(grouped, least, ["root"], "inner", spread_by=["fp"]).select("fp", "component")
    out = spread_join(marked, named, ["fp"], "inner", spread_by=["fp"])
    return out.select(F.col("_key").alias(key), "fp", "component")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The columns of `docs` for one row of each component: that with the smallest key, then the smallest row hash.

    Rows without key stand behind all others; equal rows count as one.
    """
    hashed = F.xxhash64(*[F.col("_text") if c == text else F.col("_doc")[c] for c in docs.columns])
    row = F.struct(F.col("_doc")[key].isNull().alias("last"), F.col("_doc")[key].alias("key"), hashed.alias("hash"))
    keyed = packed(docs, text).withColumn("_row", row)
    found = simhash_components(keyed, "_row", "_text", size, distance)
    stay = found.where(F.col("_row").eqNullSafe(F.col("component"))).groupBy(F.col("_row").alias("_stay")).count()
    stay = stored(stay, "stay")
    # part by part, as a row without key is equal to itself too
    same = [F.col(f"_row.{part}").eqNullSafe(F.col(f"_stay.{part}")) for part in ("last", "key", "hash")]
    out = keyed.join(stay.where(F.col("count") == 1), same, "left_semi")
    repeated = stay.where(F.col("count") > 1)
    if not repeated.isEmpty():
        out = out.unionByName(keyed.join(repeated, same, "left_semi").dropDuplicates(["_row"]))
    return unpacked(out, docs, text)
