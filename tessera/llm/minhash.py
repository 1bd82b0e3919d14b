"""Near-duplicates of texts by HyperMinHash sketches, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MOST_BROADCAST_ROWS, join_small, join_spread, saved, small_batches
from .components import hooked_components, joined_blocks
from .hashing import U64, mix, shingles, slices, span_hashes, word_spans

WIDTH = 5
#: 256 buckets, cut into 51 bands of 5 registers: two texts at a similarity of 0.75 share no band with a chance of 1e-6.
BUCKETS, ROWS, BANDS = 256, 5, 51
MANTISSA = 10
_SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, registers binary"
#: Ids of documents to read again are broadcast up to this many (16 MB or so), beyond it they are joined by shuffles.
MOST_BROADCAST_IDS = 1_000_000
#: A block that one task compares with another has at most so many documents and about so many shingles.
BLOCK_DOCS, BLOCK_SHINGLES = 500, 150_000
#: Groups of more pairs of blocks first have all members compared with so many leads, again as long as that joins much.
FEW_BLOCK_PAIRS, LEADS = 8, 64
#: Members of a band up to which its open pairs become rows; larger bands are compared as blocks.
PAIRED = 32
_ROUNDS = 400


def sketch(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """HyperMinHash registers [texts, BUCKETS] of sorted distinct hashes; 0 is an empty bucket.

    A hash's top 8 bits name its bucket. Of the smallest rest in a bucket the register keeps the number of leading
    zeros and the ``MANTISSA`` bits after the leading one.
    """
    out = np.zeros((len(bounds) - 1, BUCKETS), np.uint16)
    if not len(hashes):
        return out
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    bucket = (hashes >> U64(56)).astype(np.int64)
    first = np.ones(len(hashes), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])
    rest = ((hashes[first] & U64((1 << 56) - 1)) >> U64(3)).astype(np.float64)  # 53 bits: exact as a float
    fraction, exponent = np.frexp(rest)
    zeros = 53 - exponent
    bits = np.where(rest > 0, (fraction - 0.5) * 2 * (1 << MANTISSA), 0).astype(np.int64)
    out[text[first], bucket[first]] = (zeros << MANTISSA) + bits + 1
    return out


def _donors() -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(np.arange(_ROUNDS * BUCKETS, dtype=U64) + U64(77)) >> U64(56)).astype(np.int64).reshape(_ROUNDS, BUCKETS)


_DONORS = _donors()


def band_keys(registers: np.ndarray) -> np.ndarray:
    """64-bit keys [texts, BANDS]. An empty bucket borrows the first filled one of its own fixed random sequence, so
    equal keys keep the chance that the similarity gives, for short texts too."""
    full = registers.copy()
    rows, columns = np.nonzero(registers == 0)
    has_any = (registers != 0).any(axis=1)
    rows, columns = rows[has_any[rows]], columns[has_any[rows]]
    for t in range(_ROUNDS):
        if not len(rows):
            break
        value = registers[rows, _DONORS[t, columns]]
        full[rows, columns] = value
        rows, columns = rows[value == 0], columns[value == 0]
    for step in range(1, BUCKETS):
        if not len(rows):
            break
        value = registers[rows, (columns + step) % BUCKETS]
        full[rows, columns] = value
        rows, columns = rows[value == 0], columns[value == 0]
    parts = full[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(U64)
    keys = np.zeros(parts.shape[:2], U64) + np.arange(1, BANDS + 1, dtype=U64) * U64(0x9FB21C651E98DF25)
    for k in range(ROWS):
        keys = mix(keys ^ (parts[:, :, k] * U64(0xC2B2AE3D27D4EB4F) + U64(k)))
    return keys


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for at, end, data, offsets in slices(batch.column("text")):
                starts, ends, text = word_spans(data, offsets)
                found, bounds = shingles(span_hashes(data, starts, ends), text, end - at, WIDTH)
                registers = sketch(found, bounds)
                sums = [np.concatenate([[U64(0)], np.cumsum(mix(found ^ U64(salt)), dtype=U64)]) for salt in (11, 13)]
                k1, k2 = (s[bounds[1:]] - s[bounds[:-1]] for s in sums)
                n = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, end - at).cast(pa.int64()),
                        pa.array(n),
                        pa.array(k1.view(np.int64)),
                        pa.array(k2.view(np.int64)),
                        pa.array([r.tobytes() for r in registers], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "k1", "k2", "registers"],
                )


def _band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                keys = band_keys(np.frombuffer(b"".join(part.column("registers").to_pylist()), np.uint16).reshape(-1, BUCKETS))
                flat = pa.array(np.ascontiguousarray(keys).reshape(-1).view(np.int64))
                ends = pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(ends, flat)], names=["id", "bands"])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, its distinct shingles, sorted, as little-endian 64-bit integers)."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for at, end, data, offsets in slices(batch.column("text")):
                starts, ends, text = word_spans(data, offsets)
                found, bounds = shingles(span_hashes(data, starts, ends), text, end - at, WIDTH)
                packed = [found[bounds[i] : bounds[i + 1]].tobytes() for i in range(end - at)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, end - at), pa.array(packed, pa.binary())], names=["id", "shingles"])


def chance_matches(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Expected number of buckets in which unrelated sets of n and m shingles hold equal registers."""
    level = np.arange(1, 47, dtype=np.float64)
    low, high = 2.0**-level / BUCKETS, 2.0 ** -(level - 1) / BUCKETS

    def at_level(size: np.ndarray) -> np.ndarray:
        return np.exp(size[:, None] * np.log1p(-low)) - np.exp(size[:, None] * np.log1p(-high))

    return BUCKETS * (at_level(n.astype(float)) * at_level(m.astype(float))).sum(axis=1) / (1 << MANTISSA)


def estimated_similarity(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates from registers [pairs, BUCKETS], corrected for chance matches, and the buckets they rest on."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    chance = np.minimum(chance_matches(n, m), used * 0.9)
    return (same - chance) / np.maximum(used - chance, 1e-9), used


def _likely(threshold: float):
    """Keeps pairs whose estimate is less than five standard deviations below the threshold, or whose sets are small."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb"))
                n, m = (part.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
                guess, used = estimated_similarity(a, b, n, m)
                ok = (guess >= threshold - 5 * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))) | (used < 32)
                yield pa.RecordBatch.from_arrays([part.column("a").filter(pa.array(ok)), part.column("b").filter(pa.array(ok))], names=["a", "b"])

    return keep


def _linked(percent: int):
    """Keeps pairs whose full sets meet 100 * intersection >= percent * union."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok[i] = len(both) > 0 and 100 * common >= percent * (len(both) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))], names=["a", "b"])

    return keep


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct shingles of five words (A-Z lower-cased); with fewer words, the whole
    sequence. Documents are linked where 100 * intersection >= percent * union; component_id is the smallest doc_id
    that links reach.

    Documents with equal sets become one class first, so groups of copies cost one row. Classes meet in bands of
    their compressed registers. Every class is compared with one lead, the smallest class of most of its bands. Pairs
    that this leaves in different components are compared as blocks where their leads' leads agree, which they do in
    large groups of near copies, or where a band has many of them, and else one by one. Estimates from the registers
    drop unlikely pairs; the rest are confirmed on full sets. Every pair that shares a band is thus either connected or
    compared.

    Texts that are null, empty or without words have an empty set and no links. Rows with a null doc_id stay alone,
    with a null component. Rows that repeat a doc_id are one document, with the links of all its texts. Empty tables give
    no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    sketched = saved(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_sketch_batches, _SKETCH), "sketches")
    key = ["k1", "k2", "n_shingles"]
    # a class goes by its smallest doc_id; copies are combined before they are shuffled
    classes = sketched.where("n_shingles > 0 and doc_id is not null").groupBy(key).agg(F.min("doc_id").alias("id"), F.min_by("registers", "doc_id").alias("registers"))
    heads = saved(classes.select("id", *key, "registers"), "classes")
    classes, heads = heads.select("id", *key), heads.select("id", F.col("n_shingles").alias("n"), "registers")

    slots = heads.mapInArrow(_band_batches, "id long, bands array<long>").select(F.explode("bands").alias("band"), "id")
    shared = slots.groupBy("band").agg(F.min("id").alias("lead"), F.count("*").alias("many")).where("many > 1")
    slots = saved(slots.join(shared, "band").select("band", "id", "lead"), "bands")
    first = slots.where("id <> lead").groupBy("lead", "id").agg(F.count("*").alias("bands"))
    # of a class's leads, the one that shares most bands
    first = saved(first.groupBy("id").agg(F.max_by("lead", F.struct("bands", -F.col("lead"))).alias("lead")), "leads")
    links = _confirmed(_likely_pairs(first.select(F.col("lead").alias("a"), F.col("id").alias("b")), heads, percent), docs, percent)
    places = _join_groups(None, _places(heads, first, hooked_components(links)), docs, percent)

    # what is left: pairs of a band that belong to different tops, and aren't in one component yet
    marked = join_small(slots.select("band", "id"), places, "id")
    mixed = marked.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("many"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("members"))
    mixed = saved(mixed.where("low <> high"), "mixed-bands")
    marked = saved(join_small(marked, mixed.where(F.col("many") <= PAIRED).select("band"), "band"), "open-bands")
    one, two = (marked.select("band", F.col("id").alias(k), *[F.col(c).alias(c + k) for c in ("part", "top", "least", "n")]) for k in "ab")
    open_pair = f"a < b and parta <> partb and topa <> topb and 100 * least(na, nb) >= {percent} * greatest(leasta, leastb)"
    rest = saved(one.join(two, "band").where(open_pair).select("a", "b").distinct(), "open-pairs")
    places = _with_links(places, _confirmed(_likely_pairs(rest, heads, percent), docs, percent))
    # many bands of a large group have the same members: one of these bands is enough
    large = mixed.where(F.col("many") > PAIRED).groupBy("many", "members").agg(F.min("band").alias("g")).select("g")
    if not large.isEmpty():
        large = saved(slots.select(F.col("band").alias("g"), "id").join(large, "g"), "large-bands")
        places = _join_groups(large, places, docs, percent)

    named = join_small(classes, places.select("id", F.col("part").alias("smallest")), "id").select(*key, "smallest")
    # a null key part never joins, which leaves sets that are empty and rows without an id to themselves
    out = sketched.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("k1")).alias("k1"), "k2").join(named, key, "left")
    component = F.coalesce("smallest", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _likely_pairs(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Pairs, read from a saved table, whose sizes and registers allow the similarity; pairs are formed on ids first, registers follow."""
    if pairs.isEmpty():
        return pairs
    a, b = (heads.select(F.col("id").alias(k), F.col("n").alias("n" + k), F.col("registers").alias("r" + k)) for k in "ab")
    fit = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
    return saved(join_small(b, pairs, "b").join(a, "a").where(fit).mapInArrow(_likely(percent / 100), "a long, b long").distinct(), "likely")


def _places(heads: DataFrame, first: DataFrame, found: DataFrame) -> DataFrame:
    """(id, least, n, top, part) of all classes: sizes of its sets (several where an id is repeated), the lead of its
    lead, and its component so far. Classes near one another mostly have the same top."""
    ids = heads.groupBy("id").agg(F.min("n").alias("least"), F.max("n").alias("n"))
    led = join_small(ids, first.select("id", "lead"), "id", "left").withColumn("lead", F.coalesce("lead", "id"))
    topped = join_small(led, first.select(F.col("id").alias("lead"), F.col("lead").alias("top")), "lead", "left")
    parted = join_small(topped, found.select("id", F.col("component_id").alias("part")), "id", "left")
    return saved(parted.select("id", "least", "n", F.coalesce("top", "lead").alias("top"), F.coalesce("part", "id").alias("part")), "places")


# ---------------------------------------------------------------- large groups


def _join_groups(groups: DataFrame | None, places: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Places, with enough members of a group (g, id; None: of a top) linked to join what any of them join.

    Members of a group's largest component are near, the others open; pairs of one component need no look. Blocks of
    open members meet one another and the blocks of near ones; a block is one row, two are compared as matrices in one
    task, and no pair of documents becomes a row. In groups of many blocks all members are first compared with a few
    leads, round after round as long as that leaves clearly fewer open ones; each round is linear in the members.
    """
    members = _open_members(groups, places)
    if members.isEmpty():
        return places
    sets = _sets_of(members.select("id"), docs)
    before = None
    for turn in range(1, 1000):
        sizes = saved(_block_counts(members), "group-sizes")
        large = sizes.where(F.col("open_blocks") * (F.col("open_blocks") + F.col("near_blocks")) > FEW_BLOCK_PAIRS)
        left = large.agg(F.sum("open_docs")).first()[0]
        if not left or (before is not None and left > 0.7 * before):
            break
        before = left
        some = join_spread(members, saved(large.select("g"), "large-groups"), "g", "id")
        blocks = _packed_blocks(some, large, sets)
        # half of the leads are open, half near
        draw = F.xxhash64("id", F.lit(turn))
        leads = some.withColumn("bucket", F.pmod(draw, F.lit(LEADS // 2))).groupBy("g", "near", "bucket").agg(F.min_by("id", draw).alias("id"))
        leads = _with_sets(leads.select("g", "id"), large.count() * LEADS, sets).select("g", F.lit(True).alias("near"), F.lit(0).cast("long").alias("block"), "id", "shingles")
        leads = leads.groupBy("g", "near", "block").applyInArrow(_pack, _BLOCK).select("g", *[F.col(c).alias("lead_" + c) for c in ("ids", "sizes", "shingles")])
        met = join_spread(blocks, saved(leads, "group-leads"), "g", "block", 16, 0).mapInArrow(_meet_leads(percent), "a long, b long")
        places = _with_links(places, met)
        members = _open_members(groups, places)
        if members.isEmpty():
            return places

    blocks = _packed_blocks(members, sizes, sets)
    last = F.col("open_blocks") - 1
    pairs = sizes.select("g", "open_blocks", "near_blocks", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("i"))
    with_open = F.transform(F.sequence("i", last), lambda j: F.struct(F.lit(False).alias("near"), j.alias("block")))
    none = F.array().cast("array<struct<near:boolean,block:bigint>>")
    with_near = F.when(F.col("near_blocks") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("near_blocks") - 1), lambda j: F.struct(F.lit(True).alias("near"), j.alias("block")))).otherwise(none)
    pairs = saved(pairs.select("g", "i", F.explode(F.concat(with_open, with_near)).alias("other")), "block-pairs")
    own = F.struct(F.lit(False).alias("near"), F.col("i").alias("block"))
    sides = F.when(own == F.col("other"), F.array(own)).otherwise(F.array(own, F.col("other")))
    met = pairs.select("g", "i", F.col("other.near").alias("to_near"), F.col("other.block").alias("j"), F.posexplode(sides).alias("side", "at")).select("g", "i", "to_near", "j", "side", "at.*")
    met = met.join(blocks, ["g", "near", "block"]).groupBy("g", "i", "to_near", "j").applyInArrow(_compare_blocks(percent), "a long, b long")
    return _with_links(places, met)


def _with_links(places: DataFrame, links: DataFrame) -> DataFrame:
    """Places after links (a, b): only links between different parts are looked at."""
    links = saved(links, "inside")
    if links.isEmpty():
        return places
    for k in "ab":
        part = places.select(F.col("id").alias(k), F.col("part").alias("part" + k))
        links = saved(join_small(part, links, k).drop(k), "part-links")
    names = hooked_components(links, "parta", "partb").select(F.col("id").alias("part"), "component_id")
    if names.isEmpty():
        return places
    moved = join_small(places, names, "part", "left").withColumn("part", F.coalesce("component_id", "part"))
    return saved(moved.select(*places.columns), "places")


def _open_members(groups: DataFrame | None, places: DataFrame) -> DataFrame:
    """(g, id, n, near) of groups of more than one component. A hot group's rows are counted before they are shuffled."""
    if groups is None:
        parts = places.select(F.col("top").alias("g"), "id", "n", "part")
    else:
        parts = saved(join_small(groups, places.select("id", "n", "part"), "id"), "group-parts")
    mains = parts.groupBy("g", "part").agg(F.count("*").alias("many")).groupBy("g").agg(F.count("*").alias("parts"), F.max_by("part", F.struct("many", -F.col("part"))).alias("main"))
    mains = saved(mains.where("parts > 1").select("g", "main"), "group-mains")
    near = (F.col("part") == F.col("main")).alias("near")
    return saved(join_spread(parts, mains, "g", "id").select("g", "id", "n", near), "members")


def _block_counts(members: DataFrame) -> DataFrame:
    """(g, open_docs, open_blocks, near_blocks)"""
    is_open, is_near = ~F.col("near"), F.col("near")

    def blocks(which):
        docs, shingles = F.count(F.when(which, 1)), F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))
        return F.greatest(F.ceil(docs / BLOCK_DOCS), F.ceil(shingles / BLOCK_SHINGLES))

    return members.groupBy("g").agg(F.count(F.when(is_open, 1)).alias("open_docs"), blocks(is_open).alias("open_blocks"), blocks(is_near).alias("near_blocks"))


_BLOCK = "g long, near boolean, block long, ids binary, sizes binary, shingles binary"


def _packed_blocks(members: DataFrame, sizes: DataFrame, sets: DataFrame) -> DataFrame:
    """The members of each block as one row."""
    placed = join_spread(members, sizes.select("g", "open_blocks", "near_blocks"), "g", "id")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.when(F.col("near"), F.col("near_blocks")).otherwise(F.col("open_blocks"))))
    placed = _with_sets(placed.select("g", "near", "block", "id"), members.count(), sets)
    return saved(placed.groupBy("g", "near", "block").applyInArrow(_pack, _BLOCK), "blocks")


def _with_sets(rows: DataFrame, many: int, sets: DataFrame) -> DataFrame:
    """Rows with the sets of their ids; up to ``many`` rows go to the sets, which aren't shuffled then."""
    return sets.join(F.broadcast(rows) if many <= MOST_BROADCAST_ROWS else rows, "id")


def _pack(table: pa.Table) -> pa.Table:
    sets = table.column("shingles").to_pylist()
    packed = {"ids": table.column("id").to_numpy().astype(np.int64).tobytes(), "sizes": np.array([len(s) // 8 for s in sets], np.int64).tobytes(), "shingles": b"".join(sets)}
    return pa.table({**{c: table.column(c).slice(0, 1) for c in ("g", "near", "block")}, **{c: pa.array([v], pa.binary()) for c, v in packed.items()}})


def _unpacked(ids: bytes, sizes: bytes, shingles: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64), np.frombuffer(shingles, U64)


def common_counts(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many hashes each set of one side shares with each of the other, by products of incidence matrices.

    A side is (sizes, hashes set after set), each set distinct.
    """
    out = np.zeros((len(left[0]), len(right[0])), np.float32)
    both = np.intersect1d(left[1], right[1])
    if not len(both):
        return out
    sides = []
    for sizes, hashes in (left, right):
        place = np.minimum(np.searchsorted(both, hashes), len(both) - 1)
        there = both[place] == hashes
        place, row = place[there], np.repeat(np.arange(len(sizes)), sizes)[there]
        order = np.argsort(place, kind="stable")
        sides.append((place[order], row[order], len(sizes)))
    for at in range(0, len(both), 2048):
        tables = []
        for place, row, n in sides:
            a, b = np.searchsorted(place, [at, at + 2048])
            table = np.zeros((n, 2048), np.float32)
            table[row[a:b], place[a:b] - at] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _links(one: tuple, two: tuple | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest id, id) that join what the links between two blocks, or inside one, join."""
    ids, sizes, hashes = one
    other_ids, other_sizes, other_hashes = two or one
    common = common_counts((sizes, hashes), (other_sizes, other_hashes))
    linked = ((100 + percent) * common >= percent * (sizes[:, None] + other_sizes[None]).astype(np.float32)) & (common > 0)
    joined = joined_blocks(linked, ids, other_ids)
    roots, names = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for members, least in joined:
        members = np.unique(members)
        names.append(members[members != least])
        roots.append(np.full(len(names[-1]), least))
    return np.concatenate(roots), np.concatenate(names)


def _meet_leads(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                roots, names = _links(_unpacked(row["ids"], row["sizes"], row["shingles"]), _unpacked(row["lead_ids"], row["lead_sizes"], row["lead_shingles"]), percent)
                yield pa.RecordBatch.from_arrays([pa.array(roots), pa.array(names)], names=["a", "b"])

    return run


def _compare_blocks(percent: int):
    def run(table: pa.Table) -> pa.Table:
        sides = [_unpacked(*(table.column(c)[k].as_py() for c in ("ids", "sizes", "shingles"))) for k in range(table.num_rows)]
        roots, names = _links(sides[0], sides[1] if len(sides) > 1 else None, percent)
        return pa.table({"a": pa.array(roots), "b": pa.array(names)})

    return run


def _sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, shingles) of the documents named, perhaps repeatedly, in a saved table; from their texts."""
    if ids.count() <= MOST_BROADCAST_IDS:
        ids = F.broadcast(ids)
    else:
        ids = saved(ids.distinct(), "named")
        if ids.count() <= MOST_BROADCAST_IDS:  # else the texts are dealt by id
            ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    return saved(texts.mapInArrow(_set_batches, "id long, shingles binary"), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents whose full sets are similar enough; texts are read again for the documents named only."""
    if pairs.isEmpty():
        return pairs
    sets = _sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), docs)
    a, b = (sets.select(F.col("id").alias(k), F.col("shingles").alias("s" + k)) for k in "ab")
    return saved(join_small(b, pairs, "b").join(a, "a").select("a", "b", "sa", "sb").mapInArrow(_linked(percent), "a long, b long"), "confirmed")
