"""Near-duplicates of word shingles by SetSketch registers, banded, estimated and verified."""

from __future__ import annotations

import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import SPACE, WordHashes, forget, space_words, stage, window_hashes
from bazaarlake.llm.components import connected

SHINGLE = 5
# Similarity of linked texts, in hundredths.
SIMILARITY = 85
BANDS, ROWS = 20, 5
REGISTERS = BANDS * ROWS
# Register base, rate and largest value: with a base this near to 1, registers agree about as
# often as the sets do, and 16 bits are enough for any set size.
BASE, RATE, TOP = 1.001, 20.0, 65535
# Pairs estimated below this are not verified: five standard deviations under the threshold.
LEAST_ESTIMATE = 0.66
# Places of the map that bounds how far two sets are apart.
PARITIES = 1024

_random = np.random.default_rng(20)
_TIMES = _random.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _random.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_CHUNK = 8192


# --- task side ------------------------------------------------------------------------------


def shingle_set(text: str | None, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; a shorter text is one shingle."""
    words = [w.lower() for w in space_words(text)] if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = known.of(words)
    if len(words) < SHINGLE:
        return window_hashes(np.append(hashes, np.uint64(len(words))), len(words) + 1)
    return np.unique(window_hashes(hashes, SHINGLE))


def registers(shingles: np.ndarray) -> np.ndarray:
    """Truncated minima on an exponential scale; the larger register of two sets is their union's."""
    mixed = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(mixed), _CHUNK):
        part = mixed[start : start + _CHUNK]
        np.minimum(least, (part[None, :] * _TIMES[:, None] + _PLUS[:, None]).min(axis=1), out=least)
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, TOP).astype(np.uint16)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        sizes, prints, sketches, bands = [], [], [], []
        for text in batch.column("text"):
            shingles = shingle_set(text.as_py(), known)
            sizes.append(len(shingles))
            if not len(shingles):
                prints.append(None)
                sketches.append(None)
                bands.append(None)
                continue
            row = registers(shingles)
            prints.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            sketches.append(row.tobytes())
            bands.append(
                [
                    xxhash.xxh3_64_intdigest(row[b * ROWS : (b + 1) * ROWS].tobytes(), b) - (1 << 63)
                    for b in range(BANDS)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array(sizes, pa.int64()),
                pa.array(prints, pa.binary()),
                pa.array(sketches, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "text_hash", "n_shingles", "print", "sketch", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        texts = batch.column("text")
        # A batch is cut in pieces: arrays of hashes are larger than the texts.
        for start in range(0, len(texts), 256):
            piece = texts[start : start + 256]
            sets = [shingle_set(text.as_py(), known).view(np.int64) for text in piece]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("print")[start : start + 256],
                    pa.array(sets, pa.list_(pa.int64())),
                    pa.array([parity_map(s) for s in sets], pa.list_(pa.int64())),
                ],
                ["print", "shingles", "parity"],
            )


def parity_map(shingles: np.ndarray) -> np.ndarray:
    """Per place whether an odd number of shingles falls there, 64 places to a number."""
    counts = np.bincount((shingles.view(np.uint64) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def likely_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity from registers (rows of ``a`` and ``b``) and set sizes.

    With u and v the shares of the two sizes, a register of a is larger with probability
    p(u - v J), of b with p(v - u J), p(x) = -log_b(1 - x (b-1)/b); the rest are equal. The
    likelihood of the three counts is concave in J, so its peak is found by bisection of the
    slope.
    """
    more = (a > b).sum(axis=1).astype(float)
    less = (a < b).sum(axis=1).astype(float)
    same = a.shape[1] - more - less
    u = na / (na + nb)
    v = 1.0 - u
    q, scale = (BASE - 1) / BASE, np.log(BASE)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * q) / scale

    def slope(x: np.ndarray) -> np.ndarray:
        return q / ((1 - x * q) * scale)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        j = (low + high) / 2
        x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        rise = (
            more * -v * slope(x) / np.maximum(p(x), 1e-12)
            + less * -u * slope(y) / np.maximum(p(y), 1e-12)
            + same * (v * slope(x) + u * slope(y)) / np.maximum(1 - p(x) - p(y), 1e-12)
        )
        low, high = np.where(rise > 0, j, low), np.where(rise > 0, high, j)
    return (low + high) / 2


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            for c in ("sketch_a", "sketch_b")
        )
        na, nb = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
        likely = pa.array(likely_similarity(a, b, na, nb) >= LEAST_ESTIMATE)
        yield batch.select(["a", "b", "n_a", "n_b"]).filter(likely)


# --- plan -----------------------------------------------------------------------------------


def _similar_sizes(a: str, b: str) -> Column:
    """What any two linked sets obey: the smaller has the similarity's share of the larger."""
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def _likely_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of prints whose registers do not rule the similarity out."""
    a = nodes.select(F.col("print").alias("a"), F.col("sketch").alias("sketch_a"))
    b = nodes.select(F.col("print").alias("b"), F.col("sketch").alias("sketch_b"))
    return stage(
        pairs.join(b, "b")
        .join(a, "a")
        .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
        .mapInArrow(_likely, "a binary, b binary, n_a long, n_b long"),
        "likely",
    )


def _full_sets(prints: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Shingles and parity map of the given prints, from one text each: the smallest document's."""
    holders = nodes.join(prints, "print").select(
        "print", F.coalesce(F.col("first.doc_id"), F.lit(-1)).alias("_doc"), "first.text_hash"
    )
    texts = docs.withColumn("_doc", F.coalesce("doc_id", F.lit(-1))).join(holders, ["_doc", "text_hash"])
    return stage(
        texts.select("print", "text")
        .mapInArrow(_sets, "print binary, shingles array<long>, parity array<long>")
        .dropDuplicates(["print"]),
        "shingles",
    )


def _verified(likely: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of prints whose full shingle sets reach the similarity."""
    shared = F.size(F.array_intersect("shingles", "shingles_a")).cast("long")
    return stage(
        likely.join(sets.select(F.col("print").alias("b"), "shingles"), "b")
        .join(sets.select(F.col("print").alias("a"), F.col("shingles").alias("shingles_a")), "a")
        .withColumn("shared", shared)
        .filter(_enough(F.col("shared"), F.col("n_a"), F.col("n_b")))
        .select("a", "b"),
        "links",
    )


def _enough(shared: Column, n_a: Column, n_b: Column) -> Column:
    return 100 * shared >= SIMILARITY * (n_a + n_b - shared)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id`` and ``kept``.

    1. Every text becomes its set size, a fingerprint of the set and a SetSketch. Rows of one
       fingerprint are one node from here on, so exact copies never pair up.
    2. Register bands put nodes into buckets; each node is paired with the hub of its bucket,
       never with all others. Pairs are estimated from the registers, then verified on full sets.
    3. Links make components. Buckets that still hold several components pair their minority
       members with the members of other components, so a link that misses the hub of its
       bucket is found too. Parity maps of the sets rule out most of these pairs; the others are
       estimated and verified alike.
    4. The component id is the smallest document id of the component.

    A pair at exactly the threshold shares no band with probability 8e-6, and has less for more
    similar pairs. Null, empty and wordless texts have no shingles, link with nothing and stay.
    Rows with a null id take part; a component of such rows only has a null id and is kept. Rows
    that repeat an id are one document. An empty table gives no rows.
    """
    own = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        _components(docs)
        .select("doc_id", "text_hash", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _components(docs: DataFrame) -> DataFrame:
    """Per row its ``root``, one fingerprint for the whole component (null without shingles)."""
    source = docs.select(F.col("doc_id").cast("long"), "text").withColumn("text_hash", F.xxhash64("text"))
    sketched = stage(
        source.select("doc_id", "text_hash", "text").mapInArrow(
            _sketch,
            "doc_id long, text_hash long, n_shingles long, print binary, sketch binary, bands array<long>",
        ),
        "sketches",
    )
    nodes = stage(
        sketched.filter("print is not null")
        .groupBy("print")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    buckets = stage(_buckets(nodes), "buckets")
    likely = _likely_pairs(_star_pairs(buckets), nodes)
    paired = likely.select(F.col("a").alias("print")).union(likely.select("b")).distinct()
    sets = _full_sets(paired, nodes, source)
    first_links = _verified(likely, sets)
    forget(likely, sets)
    mixed = stage(_mixed(buckets, connected(first_links)), "mixed")
    forget(buckets)
    sets = _full_sets(mixed.select("print").distinct(), nodes, source)
    likely = _likely_pairs(_cross_pairs(mixed, sets), nodes)
    more_links = _verified(likely, sets)
    forget(likely, sets, mixed)
    parts = connected(first_links.union(more_links))

    rooted = (
        nodes.select("print", "first.doc_id")
        .join(parts, "print", "left")
        .withColumn("root", F.coalesce("root", "print"))
    )
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = rooted.join(smallest, "root").select("print", "root", "component_id")
    return sketched.select("doc_id", "text_hash", "n_shingles", "print").join(classes, "print", "left")


def _buckets(nodes: DataFrame) -> DataFrame:
    """Members of every band value that two or more nodes share, with the hub of the bucket.

    The hub is the member that shares its bands with most others. An original is nearer to each
    of its edited copies than these are to one another, so it becomes the hub of all its buckets
    and links the copies in one step.
    """
    members = nodes.select("print", "n", F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    shared = stage(members.join(sizes, "band"), "shared")
    popular = shared.groupBy("print").agg(F.sum("members").alias("company"))
    known = shared.join(popular, "print").select("band", "print", "n", "company")
    hubs = known.groupBy("band").agg(F.max(F.struct("company", "print", "n")).alias("first"))
    return known.drop("company").join(hubs, "band")


def _star_pairs(buckets: DataFrame) -> DataFrame:
    return (
        buckets.select(
            F.col("first.print").alias("a"), F.col("print").alias("b"), F.col("first.n").alias("n_a"), F.col("n").alias("n_b")
        )
        .filter((F.col("a") != F.col("b")) & _similar_sizes("n_a", "n_b"))
        .distinct()
    )


def _mixed(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of buckets with several components; ``main`` is the component with most of them."""
    rooted = (
        buckets.select("band", "print", "n")
        .join(parts, "print", "left")
        .withColumn("root", F.coalesce("root", "print"))
    )
    sizes = rooted.groupBy("band", "root").agg(F.count("*").alias("members"))
    several = (
        sizes.groupBy("band")
        .agg(F.count("*").alias("roots"), F.max(F.struct("members", "root")).alias("main"))
        .filter("roots > 1")
        .select("band", F.col("main.root").alias("main"))
    )
    return rooted.join(several, "band")


def _apart(a: str, b: str) -> Column:
    """Places at which two parity maps differ: never more than shingles in one set only."""
    xors = [F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))) for i in range(PARITIES // 64)]
    return reduce(operator.add, [F.bit_count(x) for x in xors])


def _cross_pairs(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs across components within a bucket, from the side of the smaller components.

    A pair leaves the join only if its parity maps allow the similarity. The maps bound the
    difference of the sets from below, so no pair that reaches the similarity is passed over,
    and a large group of edited copies, alike but not enough, gives few pairs.
    """
    members = stage(mixed.join(sets.select("print", "parity"), "print"), "members")
    probes = members.filter("root != main").select(
        "band",
        F.col("print").alias("a"),
        F.col("n").alias("n_a"),
        F.col("root").alias("root_a"),
        F.col("parity").alias("parity_a"),
    )
    others = members.select("band", F.col("print").alias("b"), F.col("n").alias("n_b"), "root", "parity")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    reachable = _enough((n_a + n_b - _apart("parity_a", "parity")) / 2, n_a, n_b)
    return (
        probes.join(others, "band")
        .filter((F.col("root") != F.col("root_a")) & _similar_sizes("n_a", "n_b") & reachable)
        # A pair found from both sides is one.
        .select(
            F.least("a", "b").alias("a"),
            F.greatest("a", "b").alias("b"),
            F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
            F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
        )
        .distinct()
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns; rows without words all stay.

    The row with the smallest id stays (null last), then with the smallest hash of its text. Of rows
    that repeat id and text, the one with the smallest hash of its columns does.
    """
    key = ["_near_none", "_near_doc", "_near_text"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    keys = (
        _components(docs)
        .filter("root is not null")
        .groupBy("root")
        .agg(first.alias("first"))
        .select(
            F.col("first.none").alias(key[0]),
            F.coalesce("first.doc_id", F.lit(-1)).alias(key[1]),
            F.col("first.text_hash").alias(key[2]),
        )
    )
    # A map has neither order nor hash.
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(f"[^{SPACE}]")
    keyed = (
        docs.filter(worded)
        .withColumn(key[0], F.col("doc_id").cast("long").isNull())
        .withColumn(key[1], F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)))
        .withColumn(key[2], F.xxhash64("text"))
    )
    # One row per id and text first: Spark keeps one in each input task before rows are moved.
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(*hashed)))
    single = keyed.withColumn("_near_place", place).filter("_near_place = 1")
    columns = [f"`{name}`" for name in docs.columns]
    return single.join(keys, key, "left_semi").select(*columns).union(docs.filter(~worded).select(*columns))
