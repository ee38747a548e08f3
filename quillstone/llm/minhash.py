"""MinHash near-duplicates: SuperMinHash signatures, banding, verification on full sets and union-find grouping.

SuperMinHash (Ertl, 2017) gives each element of a set a random permutation of the signature's places; the j-th place of the
permutation is offered j plus a random fraction, and each place keeps the least offer. A set is done as soon as all its
places hold less than the next j.

Documents of equal sets are one class. Classes that share a band's hash are candidates. A bucket's pivot is its most central
class, the one whose buckets hold the most members; the others meet it if their signatures agree in AGREE places, and these
stars' links give components. Of a pivot's members that are still in different components no pairs are made: each is written as
its difference from the pivot's set, which tells exactly how many tokens of their differences two members must share to be
linked, and so how long a prefix of them, rarest first, must hold one that both have (a prefix filter, Chaudhuri et al., 2006).
So no link between candidates is lost, while copies of one text cost a verification each: their own changes are rare tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.llm.components import components
from quillstone.llm.session import arrow_map, cut, delete, free_prefix, table
from quillstone.llm.words import LOWER, Words, mix, raw, shingles

BANDS, ROWS = 24, 4
PLACES = BANDS * ROWS
#: Places, of which 77 agree on average at similarity 0.8, with a deviation of 4 at most.
AGREE = 54
_SKETCH = [f"s{i}" for i in range(PLACES // 8)]
_FRACTION = np.uint64((1 << 56) - 1)
_EVEN = [np.uint64(x) for x in np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 2 * PLACES, dtype=np.uint64)]


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles, ascending; A-Z count as a-z."""
    data, offsets = raw(column)
    words = Words(LOWER[data], offsets)
    hashes = words.hashes()
    return [np.unique(shingles(hashes[a:b], size)) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, PLACES): the places' least offers; the top byte holds j, the rest the fraction. Empty sets keep the maximum."""
    h = np.full((len(sets), PLACES), ~np.uint64(0))
    sizes = np.array([len(s) for s in sets], np.int64)
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.tile(np.arange(PLACES, dtype=np.uint8), (len(elements), 1))
    for j in range(PLACES):
        if not len(elements):
            break
        rows = np.arange(len(elements))
        k = j + (mix(elements ^ _EVEN[2 * j]) % np.uint64(PLACES - j)).astype(np.int64)
        place = order[rows, k]
        order[rows, k] = order[:, j]
        np.minimum.at(h.reshape(-1), owner * PLACES + place, np.uint64(j << 56) | (mix(elements ^ _EVEN[2 * j + 1]) & _FRACTION))
        going = (h.max(axis=1) >> np.uint64(56)) > j  # some place could still get less
        go = going[owner]
        if not go.all():
            elements, owner, order = elements[go], owner[go], order[go]
    return h


def _signed(documents: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text"), size)
            sign = signatures(sets)
            band = np.zeros((len(sets), BANDS), np.uint64)
            for r in range(ROWS):
                band = mix(band + sign[:, r::ROWS])
            sums = [(np.add.reduce(mix(s)), np.add.reduce(mix(s ^ _EVEN[0]))) for s in sets]
            fp = np.array(sums, np.uint64).reshape(-1, 2).view(np.int64)
            sketch = (mix(sign) & np.uint64(255)).astype(np.uint8).view(np.int64)  # a byte of each place
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(fp[:, 0]), pa.array(fp[:, 1]), pa.array(list(band.view(np.int64)), pa.list_(pa.int64())), *map(pa.array, sketch.T)],
                ["doc_id", "text_hash", "n", "fp1", "fp2", "bands", *_SKETCH],
            )

    rows = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return arrow_map(rows, run, "doc_id long, text_hash long, n long, fp1 long, fp2 long, bands array<long>, " + ", ".join(f"{c} long" for c in _SKETCH))


def _agreeing(x: str, y: str):
    """In how many places two sketches, columns of x and y, agree: bytes of the exclusive or that are 0."""
    total = F.lit(PLACES)
    for c in _SKETCH:
        bits = F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit(mask)))
        total = total - F.bit_count(bits.bitwiseAND(F.lit(0x0101010101010101)))
    return total


def _verified(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """pairs (a, b) with `shared`, the size of their sets' intersection, na and nb."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(pa.concat_arrays([batch.column("ta"), batch.column("tb")]), size)
            k = batch.num_rows
            shared = [len(x) + len(y) - len(np.union1d(x, y)) for x, y in zip(sets[:k], sets[k:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array([len(s) for s in sets[:k]], pa.int64()), pa.array([len(s) for s in sets[k:]], pa.int64())], ["a", "b", "shared", "na", "nb"])

    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return arrow_map(both.select("a", "b", "ta", "tb"), run, "a long, b long, shared long, na long, nb long")


def _differences(spokes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """spokes (id, pivot, label, main) with n, pivot_n and common, the sizes of the two sets and of their intersection, and tokens, what only one of them has; those linked to the pivot are main."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(pa.concat_arrays([batch.column("t"), batch.column("pivot_t")]), size)
            k = batch.num_rows
            differ = [np.setxor1d(x, y, assume_unique=True) for x, y in zip(sets[:k], sets[k:], strict=True)]
            n, pivot_n, d = (np.array([len(x) for x in xs], np.int64) for xs in (sets[:k], sets[k:], differ))
            common = (n + pivot_n - d) // 2
            main = batch.column("main").to_numpy(zero_copy_only=False) | (100 * common >= percent * (n + pivot_n - common))
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(d)]).astype(np.int32)), pa.array(np.concatenate([*differ, np.zeros(0, np.uint64)]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "pivot", "label")), pa.array(main), pa.array(n), pa.array(pivot_n), pa.array(common), tokens], ["id", "pivot", "label", "main", "n", "pivot_n", "common", "tokens"])

    both = spokes.join(texts.select(F.col("id").alias("pivot"), F.col("text").alias("pivot_t")), "pivot").join(texts.select("id", F.col("text").alias("t")), "id")
    return arrow_map(both.select("id", "pivot", "label", "main", "t", "pivot_t"), run, "id long, pivot long, label long, main boolean, n long, pivot_n long, common long, tokens array<long>")


def _links_of_differences(found: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) between members of one pivot that have different labels, at least one of them not main.

    Two members have common + other common - pivot_n + (shared tokens) shingles in common, and are linked from
    percent * (n + other n) / (100 + percent) on. That needs a positive number of shared tokens if one of them isn't linked to
    the pivot, so both hold one of the same in a prefix of their tokens in any fixed order. `wide` tokens are the prefix for
    partners of all kinds, `short` ones for partners that aren't main, which is all that a main member can meet. A token at some
    place can be a pair's first common one only if enough follow on both sides (the positional filter of PPJoin).
    """
    whole = 100 + percent
    spare = F.lit(percent) * F.col("n") - F.lit(whole) * F.col("common")
    least = found.groupBy("pivot").agg(F.min(spare).alias("least"), F.min(F.when(~F.col("main"), spare)).alias("least_rest")).where("least_rest is not null")
    prefix = lambda other: F.size("tokens") + 1 - F.ceil((spare + F.lit(whole) * F.col("pivot_n") + F.col(other)) / F.lit(whole))
    sized = found.join(least, "pivot").select("id", "pivot", "label", "main", "tokens", spare.alias("spare"), "pivot_n", prefix("least_rest").alias("short"), F.when(F.col("main"), prefix("least_rest")).otherwise(F.greatest(prefix("least"), prefix("least_rest"))).alias("wide"), F.size("tokens").alias("n_tokens"))
    each = sized.where("wide > 0").select("id", "pivot", "label", "main", "short", "wide", "n_tokens", "spare", "pivot_n", F.explode("tokens").alias("token"))
    often = each.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    own = Window.partitionBy("pivot", "id")
    place = F.col("n_tokens") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("times", "token")) - 1
    rare = each.join(often, ["pivot", "token"]).withColumn("place", place).where("place < wide").select("pivot", "token", "id", "label", "main", (F.col("place") < F.col("short")).alias("short"), "spare", "pivot_n", (F.col("n_tokens") - F.col("place")).alias("left"))
    rare = cut(rare)
    x, y = rare.where("not main").alias("x"), rare.alias("y")
    meet = F.col("y.main") | (F.col("x.short") & F.col("y.short") & (F.col("x.id") < F.col("y.id")))
    enough = F.lit(whole) * F.least("x.left", "y.left") >= F.col("x.spare") + F.col("y.spare") + F.lit(whole) * F.col("x.pivot_n")
    pairs = x.join(y, [F.col("x.pivot") == F.col("y.pivot"), F.col("x.token") == F.col("y.token"), F.col("x.label") != F.col("y.label"), enough, meet])
    pairs = pairs.select(F.col("x.pivot").alias("pivot"), F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    side = lambda name: found.select("pivot", *(F.col(c).alias(f"{c}_{name}") for c in ("id", "n", "pivot_n", "common", "tokens"))).withColumnRenamed(f"id_{name}", name)
    both = pairs.join(side("a"), ["pivot", "a"]).join(side("b"), ["pivot", "b"])
    shared = F.col("common_a") + F.col("common_b") - F.col("pivot_n_a") + F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both.where(F.lit(whole) * shared >= F.lit(percent) * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _key():
    return F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_key")


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash of every row; kept holds for a component's smallest doc_id.

    Documents link where 100 * |intersection| >= percent * |union| of their sets of distinct `size`-word shingles (fewer words:
    the whole sequence). documents: doc_id, text; other columns don't matter. Null, empty and wordless texts have no shingles
    and no links. Repeated rows are linked like other equal texts and all returned; rows of one doc_id and different texts are
    separate documents until linked. A null doc_id takes part and is its own component if it has no link; in a component of
    others it isn't the smallest. Very long texts are hashed whole. No rows give no rows.

    Candidates share one of BANDS bands of ROWS places and agree in AGREE: at similarity 0.8 a pair is missed with probability 3e-6.
    Both are chosen for that, so a percent below 80 raises ValueError.
    """
    if percent < 80:
        raise ValueError(f"percent is {percent}, but bands and AGREE find links of 80 or more")
    spark, paths = documents.sparkSession, []

    def kept(df: DataFrame, name: str) -> DataFrame:
        out, path = table(df, name)
        paths.append(path)
        return out

    key = ["n", "fp1", "fp2"]
    whole = kept(_signed(documents, size), "signatures")
    classes = whole.where("n > 0").groupBy(*key).agg(F.min(F.struct("doc_id", "text_hash")).alias("at"), F.min("doc_id").alias("low"), F.first(F.struct("bands", *_SKETCH)).alias("look"))
    classes = kept(classes.select(F.monotonically_increasing_id().alias("id"), *key, "at.*", "low", "look.*"), "classes")

    # Buckets of two are a pair as they are; only larger ones need their members.
    bucket = ["band", "hash"]
    banded = classes.select("id", F.posexplode("bands").alias(*bucket))
    buckets = kept(banded.groupBy(*bucket).agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets")
    members = kept(banded.join(buckets.where("members > 2").select(*bucket, "members"), bucket), "members")
    central = members.groupBy("id").agg(F.sum("members").alias("met"))
    pivots = members.join(central, "id").groupBy(*bucket).agg(F.max_by("id", F.struct("met", -F.col("id"))).alias("pivot"))
    spokes = kept(members.join(pivots, bucket).where("id <> pivot").select("id", "pivot").distinct(), "spokes")
    meeting = buckets.where("members = 2").select(F.col("high").alias("a"), F.col("low").alias("b")).union(spokes).distinct()
    looks = classes.select("id", "n", *_SKETCH)
    side = lambda name, prefix: looks.select(F.col("id").alias(name), *(F.col(c).alias(f"{prefix}{c}") for c in ("n", *_SKETCH)))
    # A link needs sizes this close; and less agreement than AGREE has a chance of 1e-7 in linked sets.
    near = (F.lit(percent) * F.greatest("x_n", "y_n") <= F.lit(100) * F.least("x_n", "y_n")) & (_agreeing("x_", "y_") >= AGREE)
    stars = kept(meeting.join(side("a", "x_"), "a").join(side("b", "y_"), "b").where(near).select("a", "b"), "stars")

    wanted = stars.select(F.col("a").alias("id")).union(stars.select("b")).union(spokes.select("id")).union(spokes.select("pivot")).distinct().join(classes.select("id", _key(), "text_hash"), "id")
    there = documents.select(_key(), F.xxhash64("text").alias("text_hash"), "text")
    texts = kept(there.join(wanted, ["doc_key", "text_hash"]).groupBy("id").agg(F.first("text").alias("text")), "texts")

    linked = (F.lit(100) * F.col("shared")) >= F.lit(percent) * (F.col("na") + F.col("nb") - F.col("shared"))
    first = components(_verified(stars, texts, size).where(linked).select("a", "b"))

    # What is left: members of a pivot in different components.
    label = lambda name: first.select(F.col("node").alias(name), F.col("label").alias(f"{name}_label"))
    placed = spokes.join(label("id"), "id", "left").join(label("pivot"), "pivot", "left").select("id", "pivot", F.coalesce("id_label", "id").alias("label"), F.coalesce("pivot_label", "pivot").alias("pivot_label"))
    placed = placed.withColumn("main", F.col("label") == F.col("pivot_label")).drop("pivot_label")
    mixed = placed.groupBy("pivot").agg(F.min("label").alias("u"), F.max("label").alias("v")).where("u <> v").select("pivot")
    differ = kept(_differences(placed.join(mixed, "pivot"), texts, size, percent), "differences")
    more = differ.where("main").select(F.col("id").alias("a"), F.col("pivot").alias("b")).union(_links_of_differences(differ, percent))
    labels = components(first.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more))

    grouped = classes.select("id", *key, "low").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    lowest = grouped.groupBy("label").agg(F.min("low").alias("component_id"))
    of_class = cut(grouped.join(lowest, "label").select(*key, "component_id"))
    signed = cut(whole.select("doc_id", "text_hash", *key))
    for path in paths:
        delete(spark, path)
    out = signed.join(of_class, key, "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")


def keep_one(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of documents that near_duplicates() keeps, with all their columns, whatever their names.

    Of rows of one doc_id and text that stay all stay, also repeated ones, as none comes before the others. Null, empty and
    wordless texts stay, and rows without a doc_id unless they are linked to one that has one. No rows give no rows.
    """
    found = near_duplicates(documents.select("doc_id", "text"), size, percent)
    key, text_hash = (f"{free_prefix(documents.columns)}{name}" for name in ("key", "hash"))
    gone = found.where(~F.col("kept")).select(_key().alias(key), F.col("text_hash").alias(text_hash)).distinct()
    here = (F.coalesce(documents["doc_id"], F.lit(-(1 << 63))) == F.col(key)) & (F.xxhash64(documents["text"]) == F.col(text_hash))
    return documents.join(gone, here, "left_anti")
