"""Near duplicates by MinHash, with odd sketches between the bands and the exact check.

A document's set holds the hashes of its distinct shingles. Documents with equal sets form a class, of which only the least goes
on. Bands of MinHash values deal classes into buckets; a band count follows from the similarity and the chance of missing
a link. All samples fold into a parity bitmap: bits in which two bitmaps differ tell how many samples do, most
precisely where few do, and pairs that differ too much are left out before their sets are compared in full.

Pairs of a bucket aren't written out. First each bucket's members meet its hub, the class with most copies; sketches and then
full sets decide. Members that are then in other components than most of the hub's company are compared with all of that company,
in blocks of bounded size: a first pass over sketches leaves out rows that are close to none, a second one over full sets emits
one link for each component that a member turns out to belong to. So no link between two components is left unchecked.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.bpe import Pieces, spread
from tidemark.llm.common import by_ids, chunks, drop, saved, table, texts_only
from tidemark.llm.components import connected_components
from tidemark.llm.line_dedup import mixed

#: MinHash values to a band, and the chance at most that a pair of just the similarity shares no band.
ROWS, MISS = 5, 1e-8
#: Bits of a parity bitmap.
SKETCH_BITS = 1024
#: Rows, or hashes of their sets, in a block of members that are compared with each other.
BLOCK_ROWS, BLOCK_HASHES = 1_024, 1 << 19
#: Hashes of a long set that are sampled at a time.
BLOCK = 1 << 11


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS)))


@lru_cache(8)
def most_differing_bits(percent: int, samples: int) -> int:
    """Bits in which the bitmaps of a pair of just this similarity differ at most, but for the chance ``MISS``.

    From the distribution itself: so many samples differ, and each that does flips two bits of the bitmaps' difference.
    """
    away, bits = 1 - percent / 100, np.arange(SKETCH_BITS + 1)
    odd, total = np.zeros(SKETCH_BITS + 1), np.zeros(SKETCH_BITS + 1)
    odd[0] = 1.0
    ways = lambda k: math.lgamma(samples + 1) - math.lgamma(k + 1) - math.lgamma(samples - k + 1)
    share = [math.exp(ways(k) + k * math.log(away) + (samples - k) * math.log1p(-away)) if away else float(k == 0) for k in range(samples + 1)]
    for differ in range(samples + 1):
        total += share[differ] * odd
        for _ in range(2):
            more, less = odd * (SKETCH_BITS - bits) / SKETCH_BITS, odd * bits / SKETCH_BITS
            odd = np.concatenate([[0.0], more[:-1]]) + np.concatenate([less[1:], [0.0]])
    beyond = total[::-1].cumsum()[::-1]
    return int(np.flatnonzero(beyond > MISS)[-1])


@lru_cache(8)
def odd_numbers(n: int) -> np.ndarray:
    """Factors of a sum of hashes, without a pattern by which sums could agree."""
    return np.random.default_rng(3).integers(0, 1 << 64, n, np.uint64, endpoint=False) | np.uint64(1)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles, case of A-Z aside; fewer words are one shingle; none, none."""
    found = Pieces.between_blanks([t.lower() for t in texts])
    distinct, which = found.distinct()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[which]
    begins = np.concatenate([[0], found.counts.cumsum()])
    factors = odd_numbers(words)
    whole = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k, factor in enumerate(factors):
        whole += hashes[k : k + len(whole)] * factor
    whole = mixed(whole, 1)
    sets = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        if b - a >= words:
            sets.append(np.unique(whole[a : b - words + 1]))
        elif b > a:
            one = (hashes[a:b] * factors[: b - a]).sum(keepdims=True, dtype=np.uint64)
            sets.append(mixed(one, 6 + b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


@lru_cache(4)
def _families(samples: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    return random.integers(0, 1 << 31, (samples, 1), np.uint32) * np.uint32(2) + np.uint32(1), random.integers(0, 1 << 32, (samples, 1), np.uint32)


def min_hashes(hashes: np.ndarray, samples: int) -> np.ndarray:
    factor, term = _families(samples)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    parts = [(factor * short[a : a + BLOCK] + term).min(1) for a in range(0, len(short), BLOCK)]
    return parts[0] if len(parts) == 1 else np.min(parts, 0)


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples as signed 64-bit numbers."""
    at = mixed(values.astype(np.uint64) << np.uint64(16) | np.arange(len(values), dtype=np.uint64), 3) % np.uint64(SKETCH_BITS)
    odd = np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``n`` (set size), ``set_a``, ``set_b`` (fingerprint of the set), ``bands``, ``sketch``; null for empty sets."""
    bands = bands_for(percent)
    samples = bands * ROWS

    def run(batches):
        weights = odd_numbers(ROWS)
        for batch in chunks(batches):
            sizes, a, b, keys, sketches = [], [], [], [], []
            for hashes in shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), words):
                sizes.append(len(hashes))
                if not len(hashes):
                    a.append(None), b.append(None), keys.append(None), sketches.append(None)
                    continue
                values = min_hashes(hashes, samples)
                a.append(int(mixed(hashes, 4).sum(dtype=np.uint64).view(np.int64)))
                b.append(int(mixed(hashes, 5).sum(dtype=np.uint64).view(np.int64)))
                folded = (values.astype(np.uint64).reshape(bands, ROWS) * weights).sum(1, dtype=np.uint64)
                keys.append(mixed(folded + np.arange(bands, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F), 6).view(np.int64))
                sketches.append(odd_sketch(values))
            lists = pa.list_(pa.int64())
            columns = [batch.column("doc_id"), *(pa.array(x, t) for x, t in ((sizes, pa.int64()), (a, pa.int64()), (b, pa.int64()), (keys, lists), (sketches, lists)))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "set_a", "set_b", "bands", "sketch"])

    return texts_only(docs).mapInArrow(run, "doc_id long, n long, set_a long, set_b long, bands array<long>, sketch array<long>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``hashes``: the whole set of each document."""

    def run(batches):
        for batch in chunks(batches):
            sets = [s.view(np.int64) for s in shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "hashes"])

    return texts_only(docs).mapInArrow(run, "doc_id long, hashes array<long>")


def _differing(samples_bits: str = "sketch") -> Column:
    return F.aggregate(F.zip_with(f"x_{samples_bits}", f"y_{samples_bits}", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x)


def true_links(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the pairs (``x``, ``y``), those whose sets are similar enough: sketches first, then the full sets."""
    side = lambda c, of: sketches.select(F.col("rep").alias(c), F.col(of).alias(f"{c}_{of}"))
    limit = most_differing_bits(percent, bands_for(percent) * ROWS)
    near = saved(pairs.join(side("x", "sketch"), "x").join(side("y", "sketch"), "y").filter(_differing() <= limit).select("x", "y"))
    asked = saved(near.select(F.col("x").alias("doc_id")).unionByName(near.select(F.col("y").alias("doc_id"))).distinct())
    sets = saved(full_sets(by_ids(docs, asked), words))
    of = lambda c: sets.select(F.col("doc_id").alias(c), F.col("hashes").alias(f"{c}_set"))
    common = F.size(F.array_intersect("x_set", "y_set"))
    enough = 100 * common >= percent * (F.size("x_set") + F.size("y_set") - common)
    links = saved(near.join(of("x"), "x").join(of("y"), "y").filter(enough).select("x", "y"))
    drop(near), drop(sets)
    return links


def in_blocks(company: DataFrame, payload: list[str], weight: Column, limit: int) -> DataFrame:
    """Each hub's company in blocks: a strange member (in another component than most) meets all blocks, others come once a strange block.

    ``company``: ``hub``, ``rep``, ``component``, ``strange``, ``n`` and the payload. Block counts follow from sums of ``weight``, so that no block holds much more than
    ``limit``, save for a single row. Adds ``left``, ``right`` (block numbers) and ``is_left``.
    """
    sums = company.groupBy("hub").agg(F.sum(F.when(F.col("strange"), weight).otherwise(0)).alias("out"), F.sum(weight).alias("all"))
    sums = sums.filter("out > 0").select("hub", F.ceil(F.col("out") / limit).cast("int").alias("lefts"), F.ceil(F.col("all") / limit).cast("int").alias("rights"))
    lot = F.xxhash64("rep")
    company = company.join(sums, "hub").withColumns({"own_left": F.pmod(lot, "lefts").cast("int"), "own_right": F.pmod(F.xxhash64("rep", F.lit(1)), "rights").cast("int")})
    rest = ["hub", "rep", "component", "n", *payload]
    lefts = company.filter("strange").select(*rest, F.col("own_left").alias("left"), F.explode(F.sequence(F.lit(0), F.col("rights") - 1)).alias("right"), F.lit(True).alias("is_left"))
    rights = company.select(*rest, F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("left"), F.col("own_right").alias("right"), F.lit(False).alias("is_left"))
    return lefts.unionByName(rights).groupBy("hub", "left", "right")


def _sides(rows: pa.Table) -> tuple[dict, dict]:
    """Left and right rows by column; bitmaps as rows of words, of sets the hashes end to end and their numbers."""
    rows = rows.combine_chunks()
    sides = []
    for some in (rows.filter(rows.column("is_left")), rows.filter(pa.compute.invert(rows.column("is_left")))):
        side = {c: some.column(c).to_numpy() for c in ("rep", "component", "n")}
        side["sketch"] = some.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_BITS // 64)
        if "hashes" in some.column_names:
            lists = some.column("hashes").combine_chunks()
            side["hashes"], side["sizes"] = lists.flatten().to_numpy(), np.diff(np.asarray(lists.offsets))
        sides.append(side)
    return sides[0], sides[1]


def _may_link(left: dict, k: int, right: dict, percent: int, limit: int) -> np.ndarray:
    """Of the right rows, those of other components whose size and bitmap allow the similarity to the ``k``-th left row."""
    n, ns = int(left["n"][k]), right["n"]
    may = (right["component"] != left["component"][k]) & (100 * np.minimum(n, ns) >= percent * np.maximum(n, ns))
    at = np.flatnonzero(may)
    return at[np.bitwise_count(right["sketch"][at] ^ left["sketch"][k]).sum(1) <= limit]


def close_rows(percent: int, limit: int):
    """Of a block, the members that another component's member may be similar to."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        left, right = _sides(rows)
        found, near = [], np.zeros(len(right["rep"]), bool)
        for k in range(len(left["rep"])):
            close = _may_link(left, k, right, percent, limit)
            if len(close):
                found.append(left["rep"][k])
                near[close] = True
        ids = np.unique(np.concatenate([np.array(found, np.int64), right["rep"][near]]))
        return pa.table({"hub": pa.array(np.full(len(ids), key[0].as_py(), np.int64)), "rep": pa.array(ids)})

    return run


def linked_rows(percent: int, limit: int):
    """Of a block, for each strange member one link to each other component that holds a similar one; sets of pairs that may not link are not compared."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        left, right = _sides(rows)
        x, y = [], []
        if len(left["rep"]) and len(right["rep"]):
            names, ids = np.unique(np.concatenate([left["hashes"], right["hashes"]]), return_inverse=True)
            mine, theirs = np.split(ids[: len(left["hashes"])], left["sizes"].cumsum())[:-1], ids[len(left["hashes"]) :]
            starts = right["sizes"].cumsum() - right["sizes"]
            marks = np.zeros(len(names), np.int32)
            for k, own in enumerate(mine):
                close = _may_link(left, k, right, percent, limit)
                if not len(close):
                    continue
                marks[own] = 1
                sizes = right["sizes"][close]
                common = np.add.reduceat(marks[theirs[spread(starts[close], sizes)]], sizes.cumsum() - sizes)
                marks[own] = 0
                linked = close[100 * common >= percent * (left["n"][k] + right["n"][close] - common)]
                for at in linked[np.unique(right["component"][linked], return_index=True)[1]]:
                    x.append(left["rep"][k]), y.append(right["rep"][at])
        return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})

    return run


def other_links(members: DataFrame, components: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (``x``, ``y``) between components: of members that share a bucket, and so its hub."""
    at = members.join(components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_keys = at.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    company = saved(at.join(open_keys, "key").select("hub", "rep", "component").distinct())
    main = company.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("size")).groupBy("hub").agg(F.max_by("component", F.struct("size", "component")).alias("main"))
    company = company.join(main, "hub").withColumn("strange", F.col("component") != F.col("main")).drop("main")
    # A hub that met all its company is in no unchecked pair.
    company = saved(company.filter("rep <> hub").join(classes.select("rep", "n"), "rep"))
    limit = most_differing_bits(percent, bands_for(percent) * ROWS)
    sketched = company.join(classes.select("rep", "sketch"), "rep")
    near = in_blocks(sketched, ["sketch"], F.lit(1), BLOCK_ROWS).applyInArrow(close_rows(percent, limit), "hub long, rep long")
    company = saved(sketched.join(near.distinct(), ["hub", "rep"]))
    asked = saved(company.select(F.col("rep").alias("doc_id")).distinct())
    sets = saved(full_sets(by_ids(docs, asked), words).withColumnRenamed("doc_id", "rep"))
    # A strange member's block holds its own set once more for each block it meets; sizes bound both.
    with_sets = company.join(sets, "rep").withColumn("n", F.size("hashes").cast("long"))
    links = saved(in_blocks(with_sets, ["sketch", "hashes"], F.col("n"), BLOCK_HASHES).applyInArrow(linked_rows(percent, limit), "x long, y long"))
    drop(sets)
    return links


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the least id linked with it, over others too), ``kept``: a row for each row.

    Documents are linked when 100 * common shingles >= ``percent`` * all shingles of both. A null text counts as empty; empty sets are linked
    with nothing. A row without an id is linked with nothing, stays, and has no component. Rows that repeat an id
    are one document: it is linked with what any of its texts is linked with.
    """
    docs = texts_only(docs)
    signed = saved(signatures(docs, words, percent))
    in_class = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = in_class.groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies"))
    classes = saved(classes)
    sketches = classes.select("rep", "sketch")
    rows = signed.select("doc_id", "n", "set_a", "set_b").join(classes.select("set_a", "set_b", "n", "rep"), ["set_a", "set_b", "n"], "left")
    rows = saved(rows.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")))
    # An id with several texts is in several classes, and links them.
    several = rows.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high").select("doc_id")
    given = saved(rows.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("x"), F.col("rep").alias("y")))
    held = classes.select("rep", "copies", F.explode("bands").alias("key"))
    hubs = held.groupBy("key").agg(F.min(F.struct(-F.col("copies"), "rep")).alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = saved(held.select("key", "rep").join(hubs.select("key", F.col("hub.rep").alias("hub")), "key"))
    pairs = members.filter("rep <> hub").select(F.col("hub").alias("x"), F.col("rep").alias("y")).distinct()
    links = true_links(pairs, sketches, docs, words, percent).unionByName(given)
    components = connected_components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    more = other_links(members, components, classes, docs, words, percent)
    if not more.isEmpty():
        components = connected_components(links.unionByName(more).select(F.col("x").alias("a"), F.col("y").alias("b")))
    found = rows.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)
