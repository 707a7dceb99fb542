"""Near-duplicate embeddings by randomised-rotation binary codes with stored correction factors.

A unit vector is rotated at random and each rotated coordinate kept as one bit. With the correction factor, the inner
product of the rotated vector and its own code, ``<code, q> / factor`` is an unbiased estimate of ``<v, q>`` for any unit
vector q, and ``sqrt(1 - factor²) / factor`` bounds its error. Several rotations make several codes, whose estimates are
averaged.

Bands of the codes' bits propose pairs. Their width follows the rows of the largest label, so that unrelated vectors
seldom meet, and their number follows the width, so that a pair exactly at the threshold is missed with probability
``MISS`` at most. A proposal whose first code differs in too many bits is dropped; the rest is estimated, and only pairs
that may reach the threshold within the confidence bound are computed exactly, in double precision.

Equal vectors are one class with a count. Buckets of more than ``BUCKET`` classes are not compared pair by pair: their
members are measured against a centre. All classes within half the threshold's angle of a centre, its core, are linked
to each other whatever lies between them, so a core counts as one number. Any other class that meets a core is linked to
all of it, to none of it, or compared with those members that the triangle inequality leaves open.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import objects
from footfall.llm.components import components
from footfall.session import cut_lineage

THRESHOLD = 0.93
SEED = 7
#: Chance that no band proposes a pair which is exactly at the threshold.
MISS = 0.0001
#: Unrelated classes of the largest label that share a band, about.
CROWD = 8
#: Standard deviations by which bits and estimates may be off before a pair is dropped.
SPREAD = 4.0
#: Classes of a band that are compared with each other; beyond, they are measured against a centre.
BUCKET = 256
#: Members that a centre is the mean of, about.
CENTRE_OF = 64
#: Cosine of two centres that count as one.
SAME_CENTRE = 0.99
#: Room for rounding in angles.
SLACK = 1e-6

_VECTOR = "double"


def bands_for(rows: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(bits of a band, bands) for the classes of the largest label."""
    width = min(max(math.ceil(math.log2(max(rows, 1) / CROWD)), 8), 40)
    agree = (1 - math.acos(threshold) / math.pi) ** width
    return width, max(1, math.ceil(math.log(MISS) / math.log1p(-agree)))


@cache
def rotations(size: int, bits: int) -> np.ndarray:
    """Seeded random rotations of ``size`` dimensions, as many as ``bits`` bits take, side by side."""
    found = []
    for i in range(-(-bits // size)):
        normal = np.random.default_rng((SEED, size, i)).standard_normal((size, size))
        q, r = np.linalg.qr(normal)
        found.append(q * np.sign(np.diag(r)))
    return np.hstack(found)


def encode(units: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (0/1, rows × bits of all rotations) and correction factors (rows × rotations) of unit vectors."""
    size = units.shape[1]
    rotated = units @ rotations(size, bits)
    code = rotated > 0
    factors = np.abs(rotated).reshape(len(units), -1, size).sum(axis=2) / math.sqrt(size)
    return code, factors


def estimate(codes: np.ndarray, factors: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded vectors with unit vectors, row by row, and their confidence bounds."""
    size = queries.shape[1]
    n_rotations = factors.shape[1]
    rotated = (queries @ rotations(size, n_rotations * size)).reshape(len(queries), n_rotations, size)
    signs = np.where(codes.reshape(len(codes), n_rotations, size), 1.0, -1.0) / math.sqrt(size)
    each = (signs * rotated).sum(axis=2) / factors
    error = np.sqrt(np.maximum(1 - factors**2, 0)) / factors / math.sqrt(max(size - 1, 1))
    return each.mean(axis=1), SPREAD * np.sqrt((error**2).sum(axis=1)) / n_rotations


def unit(vector: np.ndarray) -> np.ndarray | None:
    """The vector scaled to length 1; None if it is zero or holds anything that is not finite."""
    top = np.abs(vector).max() if len(vector) else 0.0
    if not np.isfinite(top) or top == 0.0:
        return None
    scaled = vector / top
    return scaled / math.sqrt(float(scaled @ scaled))


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keys, found = [], []
        for label, values in zip(batch["label"], batch["vector"]):
            vector = None if values is None or label is None else unit(np.asarray(values, dtype=np.float64))
            keys.append(None if vector is None else hashlib.sha256(f"{label}:".encode() + vector.tobytes()).digest())
            found.append(vector)
        yield pd.DataFrame(
            {
                "vec_id": pd.array([None if i is None else int(i) for i in batch["vec_id"]], dtype="Int64"),
                "label": objects(batch["label"]),
                "class_key": objects(keys),
                "unit": objects(found),
            }
        )


def _by_size(vectors: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors stacked) of each number of dimensions."""
    sizes = np.fromiter(map(len, vectors), dtype=np.int64, count=len(vectors))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.stack(vectors.iloc[at].to_numpy())


def _coder(bits: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, factors = [None] * len(batch), [None] * len(batch)
            for at, units in _by_size(batch["unit"]):
                code, factor = encode(units, bits)
                for row, c, f in zip(at, np.packbits(code, axis=1), factor):
                    codes[row], factors[row] = c.tobytes(), f
            yield batch.assign(code=objects(codes), factors=objects(factors))

    return coded


def _band_keys(width: int, bands: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    weights = 1 << np.arange(width, dtype=np.int64)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, codes in _by_size(batch["code"].map(lambda c: np.frombuffer(c, dtype=np.uint8))):
                bits = np.unpackbits(codes, axis=1)[:, : width * bands].reshape(len(at), bands, width)
                first = np.zeros((len(at), 8), dtype=np.uint8)
                first[:, : min(8, codes.shape[1])] = codes[:, :8]
                size = batch["size"].to_numpy()[at]
                yield pd.DataFrame(
                    {
                        "label": objects(np.repeat(batch["label"].to_numpy(dtype=object)[at], bands)),
                        "size": np.repeat(size, bands),
                        "band": np.tile(np.arange(bands, dtype=np.int32), len(at)),
                        "bits": (bits.astype(np.int64) @ weights).ravel(),
                        "cid": np.repeat(batch["cid"].to_numpy()[at], bands),
                        "first": np.repeat(first.view(">i8").ravel().astype(np.int64), bands),
                    }
                )

    return keyed


def _may_link(pairs: DataFrame, coded: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a, b`` that may reach the threshold by estimate and bound, then those that do, exactly."""

    def open_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            for at, units in _by_size(batch["unit"]):
                some = batch.iloc[at]
                codes = np.stack([np.frombuffer(c, dtype=np.uint8) for c in some["code"]])
                factors = np.stack(some["factors"].to_numpy())
                bits = np.unpackbits(codes, axis=1)[:, : factors.shape[1] * units.shape[1]]
                guess, bound = estimate(bits, factors, units)
                keep[at] = guess + bound >= threshold
            yield batch.loc[keep, ["a", "b"]]

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            for at, units in _by_size(batch["unit"]):
                others = np.stack(batch["other"].iloc[at].to_numpy())
                keep[at] = np.einsum("ij,ij->i", units, others) >= threshold
            yield batch.loc[keep, ["a", "b"]]

    left = coded.select(F.col("cid").alias("a"), "unit")
    codes = coded.select(F.col("cid").alias("b"), "code", "factors")
    right = coded.select(F.col("cid").alias("b"), F.col("unit").alias("other"))
    likely = pairs.join(left, "a").join(codes, "b").mapInPandas(open_pairs, "a long, b long")
    checked = cut_lineage(likely).join(left, "a").join(right, "b")
    return cut_lineage(checked.mapInPandas(exact, "a long, b long"))


def _angle(a: str, b: str) -> Column:
    """Angle of two unit vectors."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))


def _hubs(hot: DataFrame, coded: DataFrame) -> DataFrame:
    """Crowded band keys ``key, n, cid`` → ``key, hub, n, centre``: centres, near ones merged into the fuller.

    A centre is the mean of about ``CENTRE_OF`` members, told by a hash. It is merged into the centre of the
    fullest key that its members hold, if the two are close; three such steps follow each other.
    """
    fullest = hot.groupBy("cid").agg(F.max(F.struct("n", "key")).alias("top"))
    drawn = hot.filter(F.pmod(F.xxhash64("cid", "key"), "n") < CENTRE_OF)
    units = drawn.join(coded.select("cid", "unit"), "cid").join(fullest, "cid")

    def centre(batch: pd.DataFrame) -> pd.DataFrame:
        mean = unit(np.stack(batch["unit"].to_numpy()).mean(axis=0))
        if mean is None:
            mean = batch["unit"].iloc[0]
        tops = batch["parent"].value_counts()
        parent = int(tops.index[tops == tops.max()].min())
        return pd.DataFrame(
            {"key": batch["key"].iloc[:1], "n": batch["n"].iloc[:1], "centre": objects([mean]), "parent": [parent]}
        )

    found = cut_lineage(
        units.select("key", "n", "unit", F.col("top.key").alias("parent"))
        .groupBy("key")
        .applyInPandas(centre, f"key long, n long, centre array<{_VECTOR}>, parent long")
    )
    above = found.select(F.col("key").alias("parent"), F.col("n").alias("up_n"), F.col("centre").alias("up_centre"))
    fuller = (F.col("up_n") > F.col("n")) | ((F.col("up_n") == F.col("n")) & (F.col("parent") > F.col("key")))
    near = _angle("centre", "up_centre") <= math.acos(SAME_CENTRE)
    merged = cut_lineage(
        found.join(above, "parent", "left").select(
            "key", F.when(fuller & near, F.col("parent")).otherwise(F.col("key")).alias("hub")
        )
    )
    for _ in range(3):
        on = merged.select(F.col("key").alias("hub"), F.col("hub").alias("next"))
        merged = cut_lineage(merged.join(on, "hub").select("key", F.col("next").alias("hub")))
    centres = found.select(F.col("key").alias("hub"), "n", "centre")
    return cut_lineage(merged.join(centres, "hub").select("key", "hub", "n", "centre"))


def _cores(hot: DataFrame, coded: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """Crowded keys → cores ``cid, hub, angle``, one for a class at most, and centres ``hub, n, centre``.

    Of the centres of its keys that lie within half of ``reach``, a class takes the fullest.
    """
    hubs = _hubs(hot, coded)
    centres = hubs.filter("key = hub").select("hub", "n", "centre")
    told = hot.select("key", "cid").join(hubs.select("key", "hub"), "key").select("cid", "hub").distinct()
    seen = told.join(centres, "hub").join(coded.select("cid", "unit"), "cid")
    within = seen.withColumn("angle", _angle("unit", "centre")).filter(F.col("angle") <= reach / 2 - SLACK)
    best = within.groupBy("cid").agg(F.max(F.struct("n", "hub", "angle")).alias("own"))
    return cut_lineage(best.select("cid", "own.hub", "own.angle")), centres


def _in_blocks(members: DataFrame, bucket: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the comparison of a key's members; keys with more than ``bucket`` in several groups."""
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / bucket).alias("blocks"))
    sized = cut_lineage(members.join(sizes, "key"))
    left = sized.withColumn("block", F.pmod(F.xxhash64("cid"), "blocks"))
    right = sized.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return left, right


def _links(coded: DataFrame, keyed: DataFrame, threshold: float, bucket: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links between classes but those within a core and those of ``wholes``, ``a, b``; cores ``cid, hub, angle``;
    classes linked to all of a core they are not in, ``cid, hub``.

    Each pair of classes that share a key is judged once: within a core, by the class or core that meets a core in
    a crowded key, or by comparison.
    """
    spark = coded.sparkSession
    reach = math.acos(threshold)
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"))
    shared = cut_lineage(counts.filter("n > 1"))
    crowded = shared.filter(F.col("n") > bucket)
    some = keyed.join(shared.filter(F.col("n") <= bucket).select("key"), "key")
    core = spark.createDataFrame([], "cid long, hub long, angle double")
    wholes = spark.createDataFrame([], "cid long, hub long")
    close = spark.createDataFrame([], "a long, b long")
    any_crowd = not crowded.isEmpty()
    if any_crowd:
        hot = cut_lineage(keyed.join(crowded, "key").select("key", "n", "cid", "first", "size"))
        core, centres = _cores(hot, coded, reach)
        own = core.select("cid", F.col("hub").alias("own"))
        owned = cut_lineage(hot.join(own, "cid", "left"))
        owners = cut_lineage(owned.filter("own IS NOT NULL").select("key", F.col("own").alias("hub")).distinct())
        strays = owned.filter("own IS NULL")
        met = cut_lineage(strays.join(owners, "key").select("cid", "hub").distinct())
        lower, higher = owners.withColumnRenamed("hub", "low"), owners.withColumnRenamed("hub", "high")
        neighbours = cut_lineage(lower.join(higher, "key").filter("low < high").select("low", "high").distinct())
        of_core = neighbours.join(core.select("cid", F.col("hub").alias("low")), "low").select("cid", F.col("high").alias("hub"))
        wide = core.groupBy("hub").agg(F.max("angle").alias("wide"))
        judged = cut_lineage(
            met.unionByName(of_core)
            .join(centres.join(wide, "hub").select("hub", "centre", "wide"), "hub")
            .join(coded.select("cid", "unit"), "cid")
            .select("cid", "hub", "wide", _angle("unit", "centre").alias("angle"))
            .filter(F.col("angle") - F.col("wide") <= reach + SLACK)
        )
        to_all = F.col("angle") + F.col("wide") <= reach - SLACK
        wholes = judged.filter(to_all).select("cid", "hub")
        members = core.select(F.col("cid").alias("b"), "hub", F.col("angle").alias("b_angle"))
        close = (
            judged.filter(~to_all)
            .select(F.col("cid").alias("a"), "hub", "angle")
            .join(members, "hub")
            .filter(F.abs(F.col("angle") - F.col("b_angle")) <= reach + SLACK)
            .select("a", "b")
        )
        some = some.join(own, "cid", "left").unionByName(strays.drop("n"))
    else:
        some = some.withColumn("own", F.lit(None).cast("long"))
    size = F.least("size", F.lit(64))
    apart = reach / math.pi
    most = size * apart + SPREAD * F.sqrt(size * apart * (1 - apart))
    left, right = _in_blocks(some.select("key", "cid", "first", "own", most.alias("most")), bucket)
    left = left.select("key", "block", "most", *[F.col(c).alias(n) for c, n in (("cid", "a"), ("first", "fa"), ("own", "oa"))])
    right = right.select("key", "block", *[F.col(c).alias(n) for c, n in (("cid", "b"), ("first", "fb"), ("own", "ob"))])
    near = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= F.col("most")
    other = F.col("oa").isNull() | F.col("ob").isNull() | (F.col("oa") != F.col("ob"))
    pairs = left.join(right, ["key", "block"]).filter((F.col("a") < F.col("b")) & near & other).select("a", "b", "oa", "ob").distinct()
    if any_crowd:
        pairs = cut_lineage(pairs.withColumns({"low": F.least("oa", "ob"), "high": F.greatest("oa", "ob")}))
        pairs = (
            pairs.join(met.select(F.col("cid").alias("a"), F.col("hub").alias("ob")), ["a", "ob"], "left_anti")
            .join(met.select(F.col("cid").alias("b"), F.col("hub").alias("oa")), ["b", "oa"], "left_anti")
            .join(neighbours, ["low", "high"], "left_anti")
        )
    both = cut_lineage(pairs.select("a", "b").unionByName(close))
    return _may_link(both, coded, threshold), core, wholes


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, bucket: int = BUCKET) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``, linked at a cosine of ``threshold`` or more.

    Vectors are compared where ``label`` and number of components are equal. Vectors that are null, empty or
    zero, hold null or non-finite components or have no label link with nothing: no links, their own
    component. Equal vectors, and ones that differ in length only, link. Repeated ids are vectors of their
    own, so they count each other; ids may be null, and a component of such rows alone has a null
    ``component_id``; a row without an id is never ``kept``. An empty table gives an empty one; other
    columns are not looked at. ``threshold`` lies between 0 and 1.
    """
    own = vectors.select(
        F.col("vec_id").cast("long").cast("string").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast(f"array<{_VECTOR}>").alias("vector"),
    )
    whole = F.when(F.size("vector") > 0, F.when(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)), F.col("vector")))
    rows = cut_lineage(
        own.withColumn("vector", whole).mapInPandas(
            _units, f"vec_id long, label string, class_key binary, unit array<{_VECTOR}>"
        )
    )
    classes = cut_lineage(
        rows.filter("class_key IS NOT NULL")
        .groupBy("class_key")
        .agg(
            F.first("label").alias("label"),
            F.first("unit").alias("unit"),
            F.min("vec_id").alias("first_id"),
            F.count("*").alias("copies"),
        )
        .withColumn("size", F.size("unit"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    largest = classes.groupBy("label", "size").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("n")).first().n
    width, bands = bands_for(largest, threshold)
    kept = classes.select("cid", "label", "size", "unit")
    coded = cut_lineage(
        kept.mapInPandas(
            _coder(width * bands),
            f"cid long, label string, size int, unit array<{_VECTOR}>, code binary, factors array<double>",
        )
    )
    bits = coded.select("cid", "label", "size", "code").mapInPandas(
        _band_keys(width, bands), "label string, size int, band int, bits long, cid long, first long"
    )
    keyed = cut_lineage(bits.select(F.xxhash64("label", "size", "band", "bits").alias("key"), "cid", "first", "size"))
    links, core, wholes = _links(coded, keyed, threshold, bucket)

    copies = classes.select("cid", "copies")
    links_of = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    direct = links_of.join(copies.withColumnRenamed("cid", "b"), "b").select(F.col("a").alias("cid"), "copies")
    in_core = core.join(copies, "cid").select("cid", "hub", "copies")
    hub_size = in_core.groupBy("hub").agg(F.sum("copies").alias("of_core"), F.min("cid").alias("head"))
    mates = in_core.join(hub_size, "hub").select("cid", (F.col("of_core") - F.col("copies")).alias("copies"))
    to_core = wholes.join(hub_size, "hub").select("cid", F.col("of_core").alias("copies"))
    visitors = wholes.join(copies, "cid").groupBy("hub").agg(F.sum("copies").alias("copies"))
    from_wholes = core.select("cid", "hub").join(visitors, "hub").select("cid", "copies")
    linked = (
        direct.unionByName(mates).unionByName(to_core).unionByName(from_wholes).groupBy("cid").agg(F.sum("copies").alias("n"))
    )
    star = core.join(hub_size, "hub").select(F.col("cid").alias("a"), F.col("head").alias("b"))
    touch = wholes.join(hub_size, "hub").select(F.col("cid").alias("a"), F.col("head").alias("b"))
    found = components(links.unionByName(star).unionByName(touch)).select(F.col("node").alias("cid"), "root")
    rooted = cut_lineage(found.join(classes.select("cid", "first_id"), "cid"))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("least_id"))
    joined = rooted.join(firsts, "root").select("cid", "least_id", F.lit(True).alias("linked"))
    result = cut_lineage(
        classes.select("class_key", "cid", "copies", "first_id")
        .join(linked, "cid", "left")
        .join(joined, "cid", "left")
        .select(
            "class_key",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.when(F.col("linked"), F.col("least_id")).otherwise(F.col("first_id")).alias("component_id"),
        )
    )
    linking = rows.filter("class_key IS NOT NULL").select("vec_id", "class_key").join(result, "class_key")
    alone = rows.filter("class_key IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        linking.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
        .unionByName(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
