"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

1. Every text becomes a signature of 64 coordinates, made by two permutations of which one
   is turned (``shingles.circulant_minhash``), cut into bands by the least similarity asked for:
   16 of 4 at 0.85, where two documents meet in no band with probability (1 - 0.85^4)^16 = 8e-6,
   and 21 of 3 at 0.80, where it is (1 - 0.80^3)^21 = 3e-7.
2. Equal sets are one *class*, so copies never make pairs. The set's fingerprint names the
   class; ids play no part until the smallest one of each component is looked up at the end.
3. Classes that share a band bucket are first compared with the bucket's smallest class only
   (a star, not all pairs). Pairs that the bounds of size and signature leave are confirmed on the full sets.
4. What the stars left apart inside a bucket is compared across components: first classes of
   which too few shingles occur in any other such class are set aside (they can have no link),
   the rest meet in blocks of a bucket and pass the bounds of size and signature. What such likely pairs
   hold together is a group; its sets meet in blocks, where pairs that are apart are confirmed until
   links join them. So no link between different texts is lost to the star, and a group of near
   copies makes no rows for its pairs.
5. Components come from alternating large and small stars over the links, on Spark.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadentia.llm import shingles as S
from cadentia.llm.workers import given_back
from cadentia.session import drop_scratch, materialise, owned_scratch

COORDINATES = 64
#: Links of the query: ``100 * intersection >= LEAST * union``. Callers may ask for another least similarity.
LEAST = 85
#: How likely a pair at the least similarity may be to meet in no band, and to agree in too few coordinates.
MISSED, DISAGREEING = 1e-5, 1e-6
#: Low bits of a bucket that name its band.
BAND_BITS = 6
#: Classes of one bucket that meet in one task.
BLOCK = 512
#: Bits of the map of candidate ids, 8 MB at most.
MAP_BITS = 1 << 26


@dataclass(frozen=True)
class Banding:
    """What a least similarity of ``least`` per cent asks of signatures."""

    least: int
    rows: int
    bands: int
    agreeing: int  # coordinates; a pair of fewer is never verified


def banding(least: int) -> Banding:
    """The longest bands that miss a pair at the least similarity with probability ``MISSED`` at most."""
    if not 0 < least <= 100:
        raise ValueError(f"a least similarity of {least} per cent")
    s = least / 100
    fitting = [r for r in range(1, COORDINATES + 1) if (1 - s**r) ** (COORDINATES // r) <= MISSED]
    if not fitting:
        raise ValueError(f"{COORDINATES} coordinates are too few for a least similarity of {least} per cent")
    fewer, agreeing = 0.0, 0
    while agreeing < COORDINATES:
        fewer += comb(COORDINATES, agreeing) * s**agreeing * (1 - s) ** (COORDINATES - agreeing)
        if fewer > DISAGREEING:
            break
        agreeing += 1
    return Banding(least, fitting[-1], COORDINATES // fitting[-1], agreeing)


_SKETCH = "row long, named boolean, n_shingles long, fp1 long, fp2 long, signature binary"


def _row() -> Column:
    """What finds a row again: its doc_id, or a hash of its text if it has none."""
    return F.coalesce("doc_id", F.xxhash64("text"))


def _named() -> Column:
    return F.col("doc_id").isNotNull()


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: its key, set size, 128-bit fingerprint of the set, and signature."""

    def sketch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sets = [s for texts in S.batches(part["text"]) for s in S.shingle_sets(texts)]
            signature = S.circulant_minhash(sets, COORDINATES)
            prints = [S.set_fingerprint(s) for s in sets]
            yield pd.DataFrame(
                {
                    "row": part["row"],
                    "named": part["named"],
                    "n_shingles": [len(s) for s in sets],
                    "fp1": [p[0] for p in prints],
                    "fp2": [p[1] for p in prints],
                    "signature": [row.tobytes() for row in signature],
                }
            )

    return docs.select(_row().alias("row"), _named().alias("named"), "text").mapInPandas(lambda parts: given_back(sketch(parts)), _SKETCH)


def _buckets(cut: Banding) -> Column:
    """One key per band: a hash of the band's slice of the signature, the band in its low bits."""
    width = 4 * cut.rows
    high = F.lit(~((1 << BAND_BITS) - 1))
    return F.array(
        *[
            F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)).bitwiseAND(high).bitwiseOR(F.lit(i))
            for i in range(cut.bands)
        ]
    )


def _marked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is, or by its hash may be, a wanted one.

    The wanted keys set bits in a map of ``MAP_BITS``, at most ``MAP_BITS / 8`` bytes whatever
    their number, which is broadcast: so few texts move in the join that follows.
    """
    place = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(MAP_BITS)) + 1
    met = docs.withColumn("part", F.bitmap_bucket_number(place)).join(F.broadcast(_bit_map(wanted)), "part")
    return met.filter(_bit("bits", place)).select(*docs.columns)


def _bit_map(wanted: DataFrame) -> DataFrame:
    place = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(MAP_BITS)) + 1
    return wanted.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def _bit(bits: str, place: Column) -> Column:
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def shingle_table(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(fp1, shingles)`` of the wanted ``(row, named, fp1)``, the sets as sorted arrays."""

    def sets_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            at = 0
            for texts in S.batches(part["text"]):
                sets = S.shingle_sets(texts)
                rows = part.iloc[at : at + len(texts)]
                at += len(texts)
                found = pd.DataFrame({"fp1": [S.set_fingerprint(s)[0] for s in sets], "shingles": [s.view(np.int64) for s in sets]})
                # a doc_id that repeats brings texts of other classes
                yield found[found["fp1"].to_numpy() == rows["fp1"].to_numpy()]

    slim = docs.select(_row().alias("row"), _named().alias("named"), "text")
    named = _marked(slim.filter("named"), wanted)
    unnamed = _marked(slim.filter("not named"), wanted).distinct()  # many copies may share one text
    exact = named.union(unnamed).join(wanted, ["row", "named"]).select("row", "fp1", "text").distinct()
    return exact.select("fp1", "text").mapInPandas(lambda parts: given_back(sets_of(parts)), "fp1 long, shingles array<long>")


def _similar(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    both = S.common(a.view(np.uint64), b.view(np.uint64))
    return 100 * both >= least * (len(a) + len(b) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, cut: Banding) -> DataFrame:
    """Those of the ``(a, b)`` that are links by their full sets."""

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_similar(a, b, cut.least) for a, b in zip(x, y, strict=True)], dtype=bool)

    left = sets.select(F.col("fp1").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("fp1").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(right, "b").join(left, "a").filter(linked("set_a", "set_b")).select("a", "b")


def _likely(pairs: DataFrame, classes: DataFrame, cut: Banding) -> DataFrame:
    """Those of the ``(a, b)`` that the bounds of size and signature let be links; moves no sets."""

    @F.pandas_udf("boolean")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        a, b = (np.frombuffer(b"".join(s), np.uint32).reshape(len(s), COORDINATES) for s in (x, y))
        return pd.Series((a == b).sum(axis=1) >= cut.agreeing, dtype=bool)

    side = lambda c: classes.select(F.col("fp1").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("signature").alias(f"s_{c}"))
    met = pairs.join(side("b"), "b").join(side("a"), "a")
    met = met.filter(100 * F.least("n_a", "n_b") >= cut.least * F.greatest("n_a", "n_b"))
    return met.filter(agree("s_a", "s_b")).select("a", "b")


def _star_links(members: DataFrame, classes: DataFrame, sets: DataFrame, cut: Banding) -> DataFrame:
    """Confirmed links of each class with the smallest class of every bucket it lies in."""
    buckets = members.groupBy("bucket").agg(F.min(F.struct("order", "fp1")).alias("least"), F.count("*").alias("n"))
    buckets = materialise(buckets.filter("n > 1").select("bucket", F.col("least.fp1").alias("a"), "n"), "buckets")
    # a bucket of many members doesn't meet in one task: there are few of these, so their side is slim
    hot = materialise(buckets.filter(F.col("n") > BLOCK).select("bucket", F.col("a").alias("hot")), "crowded")
    tagged = members.join(hot, "bucket", "left")
    plain = tagged.filter("hot is null").join(buckets.filter(F.col("n") <= BLOCK).select("bucket", "a"), "bucket").select("a", "fp1")
    both = plain.union(tagged.filter("hot is not null").select("hot", "fp1"))
    pairs = both.filter("fp1 <> a").select("a", F.col("fp1").alias("b")).distinct()
    return _confirmed(materialise(_likely(pairs, classes, cut), "likely"), sets, cut)


def _links_by_id(sketch: DataFrame) -> DataFrame:
    """Links between the classes that share a doc_id."""
    rows = sketch.filter("named and n_shingles > 0").select("row", "fp1")
    several = rows.groupBy("row").agg(F.min("fp1").alias("a"), F.max("fp1").alias("b")).filter("a <> b").drop("b")
    return rows.join(materialise(several, "several"), "row").filter("fp1 <> a").select("a", F.col("fp1").alias("b")).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every id in ``links(a, b)``: the smallest id reachable.

    Alternating large and small stars. A round joins the edges with one row per node, so a
    node of many links is split like any skewed join, and no neighbour list is collected.
    The edges of a round go when those of the next one are written.
    """
    spark, own = links.sparkSession, uuid.uuid4().hex

    def written(df: DataFrame, number: int) -> DataFrame:
        with owned_scratch(f"{own}-{number}"):
            return materialise(df, "edges")

    first = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = written(first, 0)
    state = _state(edges)
    for number in range(1, rounds + 1):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u <> v")
            .distinct()
        )
        edges = written(small, number)
        drop_scratch(spark, f"{own}-{number - 1}")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = materialise(edges.select(F.col("u").alias("id"), F.col("v").alias("component")), "component")
    drop_scratch(spark, f"{own}-{number}")
    return found


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges: two numbers on the driver."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def _residual_links(members: DataFrame, component: DataFrame, classes: DataFrame, sets: DataFrame, cut: Banding) -> DataFrame:
    """Confirmed links between classes of one bucket that the stars left in different components."""
    placed = members.join(component, "fp1", "left").withColumn("component", F.coalesce("component", "fp1"))
    split = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("bucket")
    )
    # few buckets, so this side is slim and a crowded bucket stays spread over its tasks
    apart = materialise(placed.join(materialise(split, "split"), "bucket"), "apart")
    ids = apart.select("fp1").distinct()
    # a link shares the least similarity of either set: shingles found in no other class of these can't be in it
    loose = sets.join(ids, "fp1").select("fp1", F.explode("shingles").alias("shingle"))
    seen = loose.groupBy("shingle").agg(F.count("*").alias("n"), F.min("fp1").alias("fp1")).filter("n = 1")
    alone = seen.groupBy("fp1").agg(F.count("*").alias("alone"))
    able = (
        classes.join(ids, "fp1")
        .join(alone, "fp1", "left")
        .withColumn("shared", F.col("n_shingles") - F.coalesce("alone", F.lit(0)))
        .filter(100 * F.col("shared") >= cut.least * F.col("n_shingles"))
        .select("fp1", "signature", "shared", "n_shingles")
    )
    able = materialise(able, "able")
    met = apart.join(able.select("fp1"), "fp1")
    sizes = met.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    sizes = sizes.filter("low <> high").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    sizes = materialise(sizes.select("bucket", "blocks", "n"), "sizes")
    # small buckets share a task: an own group for each would cost more than its pairs
    tasks = (sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0) // (4 * BLOCK) + 1
    sizes = sizes.drop("n")
    mine = F.pmod(F.xxhash64("fp1"), F.col("blocks")).cast("int")
    dealt = (
        met.join(sizes, "bucket")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
            "mine", "component", "fp1",
        )
        .withColumn("task", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(tasks)))
    )

    def spanning(rows: pd.DataFrame) -> pd.DataFrame:
        """Likely pairs that hold together what likely pairs hold together: fewer than there are classes."""
        blocks = rows.groupby(["bucket", "i", "j"], sort=False).indices
        found = []
        for (_, i, j), at in blocks.items():
            block = rows.iloc[at]
            ids, joined = block["fp1"].to_numpy(), _Joined(np.arange(len(block)))
            found += [(ids[x], ids[y]) for x, ys in _likely_in_block(block, i, j, cut) for y in ys if joined.join(x, y)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    forest = dealt.join(able, "fp1").groupBy("task").applyInPandas(spanning, "a long, b long")
    group = components(materialise(forest.distinct(), "forest")).toDF("fp1", "near")
    return _links_in_groups(group.union(group.select("near", "near").distinct()), component, able, sets, cut)


class _Joined:
    """Which of a few numbered classes hang together."""

    def __init__(self, start: np.ndarray):
        self.of = {}
        self.root = [self.of.setdefault(c, i) for i, c in enumerate(start.tolist())]

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """Joins two classes; says whether they were apart."""
        x, y = self.find(x), self.find(y)
        self.root[x] = y
        return x != y


def _likely_in_block(rows: pd.DataFrame, i: int, j: int, cut: Banding) -> Iterator[tuple[int, np.ndarray]]:
    """For each place among ``rows`` of block ``i`` those of block ``j`` that may be its links, by component, size, signature and a band in common."""
    signature = np.frombuffer(b"".join(rows["signature"]), np.uint32).reshape(len(rows), COORDINATES)
    mine, component = rows["mine"].to_numpy(), rows["component"].to_numpy()
    n, shared = rows["n_shingles"].to_numpy(), rows["shared"].to_numpy()
    for x in np.flatnonzero(mine == i):
        other = component != component[x]
        other &= (mine == j) if i != j else (np.arange(len(rows)) > x)
        other &= 100 * np.minimum(n, n[x]) >= cut.least * np.maximum(n, n[x])
        other &= (100 + cut.least) * np.minimum(shared, shared[x]) >= cut.least * (n + n[x])
        y = np.flatnonzero(other)
        equal = signature[y] == signature[x]
        band = equal[:, : cut.bands * cut.rows].reshape(len(y), cut.bands, cut.rows).all(axis=2).any(axis=1)
        yield int(x), y[band & (equal.sum(axis=1) >= cut.agreeing)]


def _links_in_groups(group: DataFrame, component: DataFrame, able: DataFrame, sets: DataFrame, cut: Banding) -> DataFrame:
    """Links that join the classes of each group of likely pairs as far as its links do, confirmed on the full sets.

    A set moves once to its group, or once for each block of a large one. No pair makes a row: a
    task leaves out pairs that its links already join, so few links come out of a group of near copies.
    """
    sizes = group.groupBy("near").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = materialise(group.join(sizes, "near").join(able, "fp1").join(component, "fp1", "left"), "grouped")
    # small groups share a task, of about a million shingles
    tasks = (placed.agg(F.sum(F.col("n_shingles") * F.col("blocks"))).first()[0] or 0) // (1 << 20) + 1
    placed = placed.withColumn("component", F.coalesce("component", "fp1")).withColumn("mine", F.pmod(F.xxhash64("fp1"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "near", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        "mine", "component", "fp1", "signature", "shared", "n_shingles",
    ).withColumn("task", F.pmod(F.xxhash64("near", "i", "j"), F.lit(tasks)))

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, i, j), at in rows.groupby(["near", "i", "j"], sort=False).indices.items():
            block = rows.iloc[at].sort_values("fp1", kind="stable")
            ids, held, joined = block["fp1"].to_numpy(), block["shingles"].to_numpy(), _Joined(block["component"].to_numpy())
            for x, ys in _likely_in_block(block, i, j, cut):
                for y in ys:
                    if joined.find(x) != joined.find(y) and _similar(held[x], held[y], cut.least):
                        joined.join(x, y)
                        found.append((ids[x], ids[y]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.join(sets, "fp1").groupBy("task").applyInPandas(linked, "a long, b long")


def _placed(docs: DataFrame, least: int) -> DataFrame:
    """Every row's key, its ``doc_id``, ``n_shingles``, ``component_id``, and ``alone``.

    ``alone`` says of a row without a doc_id that it stands for its component, which has none.
    """
    cut = banding(least)
    sketch = materialise(sketches(docs), "sketches")
    own = F.when(F.col("named"), F.col("row"))
    classes = (
        sketch.filter("n_shingles > 0")
        .groupBy("fp1", "fp2", "n_shingles")
        .agg(
            F.min(own).alias("id"), F.min(F.when(~F.col("named"), F.col("row"))).alias("unnamed"),
            F.first("signature").alias("signature"),
        )
    )
    classes = materialise(classes, "classes")
    # an original comes before its copies, as a rule, so stars are centred on the smallest doc_id
    order = F.coalesce("id", F.lit((1 << 63) - 1)).alias("order")
    band = classes.select("fp1", order, F.explode(_buckets(cut)).alias("bucket"))
    spark, owner = docs.sparkSession, uuid.uuid4().hex
    with owned_scratch(owner):  # goes with the last of it read
        crowded = band.groupBy("bucket").count().filter("count > 1").drop("count")
        members = materialise(band.join(crowded, "bucket"), "members")
        found_at = classes.select(F.coalesce("id", "unnamed").alias("row"), F.col("id").isNotNull().alias("named"), "fp1")
        wanted = materialise(found_at.join(members.select("fp1").distinct(), "fp1"), "wanted")
        sets = materialise(shingle_table(docs, wanted), "sets")
        stars = materialise(_star_links(members, classes, sets, cut).union(_links_by_id(sketch)), "links")
        near = components(stars).toDF("fp1", "component")
        rest = materialise(_residual_links(members, near, classes, sets, cut), "links")
        # (class, component), with the component's smallest doc_id
        component = components(stars.union(rest)).toDF("fp1", "component")
    component = component.union(component.select("component", "component").distinct())  # its least class too
    linked = classes.select("fp1", "id").join(component, "fp1")
    linked = materialise(linked, "linked")
    drop_scratch(spark, owner)
    smallest = materialise(linked.groupBy("component").agg(F.min("id").alias("smallest")), "smallest")
    linked = linked.drop("id").join(smallest, "component")

    per_class = (
        classes.join(linked, "fp1", "left")
        .select(
            "fp1", "fp2", "n_shingles", F.coalesce("smallest", "id").alias("component_id"),
            F.when(F.coalesce("component", "fp1") == F.col("fp1"), F.col("unnamed")).alias("first_unnamed"),
        )
    )
    empty = F.col("n_shingles") == 0
    return sketch.join(per_class, ["fp1", "fp2", "n_shingles"], "left").select(
        "row", "named", own.alias("doc_id"), "n_shingles",
        F.when(empty, own).otherwise(F.col("component_id")).alias("component_id"),
        (~F.col("named") & (empty | F.col("component_id").isNull() & F.col("first_unnamed").eqNullSafe(F.col("row")))).alias("alone"),
    )


def near_duplicates(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text, ...)``.

    ``component_id`` is the smallest doc_id reachable over links of similarity ``least`` per
    cent and more, the document itself included; ``kept`` says that it is the document's own.
    Texts that are null, empty or white space have no shingles and are linked with nothing.
    Rows that repeat a doc_id are the same document to a component; rows without one are
    documents of their own, and a component of such rows alone has no id. Other columns are
    not looked at.
    """
    placed = _placed(docs, least)
    return placed.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, that of the smallest doc_id; all columns kept.

    Of rows that repeat a doc_id and a text one stays. Of rows without a doc_id one stays for each
    group that has none at all, and one for each text without words.
    """
    kept = F.when(F.col("named"), F.col("doc_id") == F.col("component_id")).otherwise(F.col("alone"))
    found = _placed(docs, least).groupBy("row", "named").agg(F.bool_or(kept).alias("_dedup_kept"), F.count("*").alias("n"))
    special = materialise(found.filter("not _dedup_kept or n > 1").select("row", "named", "_dedup_kept"), "special")
    # all others stay where they lie; only rows that go, or may come twice, move to be joined
    place = F.pmod(F.xxhash64(F.col("_dedup_row"), F.lit(1)), F.lit(MAP_BITS)) + 1
    keyed = docs.withColumn("_dedup_row", _row()).withColumn("_dedup_named", _named())
    keyed = keyed.withColumn("_dedup_part", F.bitmap_bucket_number(place)).join(
        F.broadcast(_bit_map(special).toDF("_dedup_part", "_dedup_bits")), "_dedup_part", "left"
    )
    maybe = F.coalesce(_bit("_dedup_bits", place), F.lit(False))
    rest = keyed.filter(maybe).drop("_dedup_part", "_dedup_bits")
    special = special.withColumnsRenamed({"row": "_dedup_row", "named": "_dedup_named"})
    rest = rest.join(special, ["_dedup_row", "_dedup_named"], "left").filter("coalesce(_dedup_kept, true)")
    again = Window.partitionBy("_dedup_row", "_dedup_named", F.xxhash64("text")).orderBy(F.lit(0))
    first = rest.withColumn("_dedup_nth", F.row_number().over(again)).filter("_dedup_nth = 1")
    return keyed.filter(~maybe).select(*docs.columns).union(first.select(*docs.columns))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
