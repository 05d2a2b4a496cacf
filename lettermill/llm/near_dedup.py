"""MinHash near-dedup by chosen paths.

Texts with the same set of shingles become one class. Classes are branched by minwise
tokens: a node of a tree selects one or two of the sketch's functions, and the classes
that agree on the minimum go to the same child. Children of up to SMALL classes are
compared exhaustively. Below a larger one the paths are laid out in order, all levels at
once, and every class is compared with its NEXT neighbours, which share the longest
path, and with a pivot. If that connects all but REST of them, these are compared with
all others, else the node is branched on; rounds repeat until one connects next to nothing. What
large nodes then hold apart is joined exactly, by the rarest shingles of each class.
Independent trees make up for paths on which a pair parts. Candidates are confirmed on
the full shingle sets; components come from distributed stars.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import digest16, text_batches, whole_text
from lettermill.llm.components import components
from lettermill.llm.words import mix64, split_words, text_blocks, window_hashes
from lettermill.storage import stored

SHINGLE = 5
#: Links need this percentage of the union in common.
PERCENT = 85
#: Functions of a sketch, and how often a pair may be lost for their number.
SKETCH, LOST = 64, 1e-6
SMALL = 16
#: Once all but so many classes of a node are in one component, these few are compared with all others.
REST = 64
#: Neighbours in path order that a class of a large node is compared with, and the steps of a path.
NEXT, STEPS = 1, 12
#: Bytes of texts cut into shingles at once when pairs are confirmed.
CONFIRM_BYTES = 2 << 20
#: Rounds end when one connects less than this share of the pairs it compares: the exact join settles the rest.
PAYS = 0.02
_SEED = 0xA0761D6478BD642F


def shared_functions(percent: int) -> int:
    """How many functions a candidate pair must share: a pair at `percent` shares fewer once in 1 / LOST."""
    p, below, k = percent / 100, 0.0, 0
    while k < SKETCH:
        below += math.comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
        if below > LOST:
            break
        k += 1
    return k


def trees(percent: int) -> int:
    """So many that a pair at `percent` parts in all of them at the first level once in 1 / LOST at most."""
    n = 1
    while (1 - percent / 100) ** n > LOST:
        n += 1
    return n


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    w = split_words(texts, lower=True)
    h, at = window_hashes(w, SHINGLE)
    bounds = np.searchsorted(at, w.first)
    out = []
    for i in range(len(texts)):
        n = w.first[i + 1] - w.first[i]
        if 0 < n < SHINGLE:  # the whole sequence; its length keeps it apart from shingles
            x = np.uint64(n)
            for v in w.hashes[w.first[i] : w.first[i + 1]]:
                x = mix64(np.array([x], np.uint64) * np.uint64(_SEED | 1) + v)[0]
            out.append(np.array([x], np.uint64))
        else:
            out.append(np.unique(h[bounds[i] : bounds[i + 1]]))
    return out


def similar(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


_MULTIPLIERS = mix64(np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(_SEED)) | np.uint64(1)


def sketch(s: np.ndarray) -> np.ndarray:
    """The least value of the set under each function; trees start with whole values, further down
    and for estimates the low byte of each will do."""
    if len(s) > 4096:
        least = np.array([(s * m).min() for m in _MULTIPLIERS], np.uint64)
    else:
        least = (s[None, :] * _MULTIPLIERS[:, None]).min(axis=1)
    return least.view(np.int64)


def _sketched(n_trees: int):
    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for a, b in text_blocks([len(t) for t in texts]):
                sets = shingle_sets(texts[a:b])
                minima = [sketch(s) if len(s) else None for s in sets]
                roots = [m[:: SKETCH // n_trees][:n_trees] if m is not None else None for m in minima]
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("digest").slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array(roots, pa.list_(pa.int64())),
                        pa.array([m.astype(np.int8) if m is not None else None for m in minima], pa.list_(pa.int8())),
                        pa.array([press.compress(t) for t in texts[a:b]], pa.binary()),
                    ],
                    names=["doc_id", "digest", "n_shingles", "body", "roots", "sketch", "packed"],
                )

    return run


def _confirmed(percent: int):
    """Of pairs with both texts, compressed, those whose full sets are similar. Texts are cut into shingles
    many at a time, each once for all its pairs of a block of CONFIRM_BYTES."""

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            sides = [(batch.column(c).to_pylist(), batch.column(f"text_{c}")) for c in ("a", "b")]
            keep = np.zeros(batch.num_rows, bool)
            packed: dict[bytes, bytes] = {}
            start = held = 0

            def settle(end, keep=keep, packed=packed, sides=sides):
                sets = dict(zip(packed, shingle_sets([unpress.decompress(p) for p in packed.values()]), strict=True))
                for i in range(start, end):  # noqa: B023
                    keep[i] = similar(sets[sides[0][0][i]], sets[sides[1][0][i]], percent)
                packed.clear()

            for i in range(batch.num_rows):
                for keys, texts in sides:
                    if keys[i] not in packed:
                        packed[keys[i]] = texts[i].as_py()
                        held += zstandard.frame_content_size(packed[keys[i]])
                if held >= CONFIRM_BYTES:
                    settle(i + 1)
                    start, held = i + 1, 0
            if packed:
                settle(batch.num_rows)
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return run


def _key(least_id: Column, body: Column) -> Column:
    """25 bytes that order classes by their smallest doc_id, those without one last."""
    high = F.lpad(F.hex(F.coalesce(least_id, F.lit(0)).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.unhex(F.concat(F.when(least_id.isNull(), "01").otherwise("00"), high, F.hex(body)))


def _draw(*of) -> Column:
    return F.xxhash64(*of)


def _branch(rows: DataFrame, percent: int) -> DataFrame:
    """node, key, sketch -> the children of each row: one function, and a second one for 100/percent - 1 of the nodes."""

    def child(no: int) -> Column:
        k = F.pmod(_draw(F.col("node"), F.lit(no)), F.lit(SKETCH)).cast("int")
        return _draw(F.col("node"), k, F.col("sketch")[k])

    second = F.pmod(_draw(F.col("node"), F.lit(-1)), F.lit(1000)) < round(1000 * (100 / percent - 1))
    children = F.when(second, F.array_distinct(F.array(child(0), child(1)))).otherwise(F.array(child(0)))
    return rows.select(F.explode(children).alias("node"), "key", "sketch")


def _first_children(classes: DataFrame, n_trees: int) -> DataFrame:
    """The rows of every tree after its first branching; trees start with functions of their own."""
    firsts = F.array(*[_draw(F.lit(t), F.col("roots")[t]) for t in range(n_trees)])
    return classes.select(F.explode(firsts).alias("node"), "key", "sketch")


def _neighbours(batches):
    before: list[tuple[int, bytes]] = []
    for batch in batches:
        a, b = [], []
        for row in zip(batch.column("node").to_pylist(), batch.column("key").to_pylist(), strict=True):
            for node, key in before:
                if node == row[0] and key != row[1]:
                    a.append(min(key, row[1]))
                    b.append(max(key, row[1]))
            before = [*before, row][-NEXT:]
        yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _along_paths(rows: DataFrame) -> DataFrame:
    """Pairs of neighbours in the order of the paths below each node. Ordering by range lets many
    tasks share a node; a pair that the edge of a task parts is met in another tree."""
    at = [F.pmod(_draw(F.col("node"), F.lit(f"step {i}")), F.lit(SKETCH)).cast("int") for i in range(STEPS)]
    path = F.concat(*[F.lpad(F.hex(F.col("sketch")[k].cast("int") + 128), 2, "0") for k in at])
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("node", path.alias("path"), "key").repartitionByRange(n, "node", "path")
    return rows.sortWithinPartitions("node", "path", "key").select("node", "key").mapInArrow(_neighbours, "a binary, b binary")


def _candidates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) to compare at this level, and the rows of its large nodes."""
    sizes = stored(
        rows.groupBy("node")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(_draw("node", "key").alias("d"), "key")).alias("least"))
        .filter("n > 1")
        .select("node", "n", F.col("least.key").alias("pivot")),
        "nodes",
    )
    members = rows.join(sizes, "node")
    small = members.filter(F.col("n") <= SMALL).groupBy("node").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    pairs = F.flatten(
        F.transform(
            "keys",
            lambda x, i: F.transform(
                F.slice("keys", i + 2, F.size("keys")), lambda y: F.struct(x.alias("a"), y.alias("b"))
            ),
        )
    )
    within = small.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    large = stored(members.filter(F.col("n") > SMALL).select("node", "key", "sketch", "pivot"), "large")
    to_pivot = large.filter("key <> pivot").select(F.least("key", "pivot").alias("a"), F.greatest("key", "pivot").alias("b"))
    pairs = within.unionByName(to_pivot).unionByName(_along_paths(large))
    return pairs.distinct(), large.select("node", "key", "sketch")


def _with_sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """Pairs with columns of both classes, as <column>_a and <column>_b."""
    for side in ("a", "b"):
        own = table.select(F.col("key").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs


def _picked(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """The rows whose `no` is among the numbers. Only a bit for each row is sent around (4 KB for each 32,768 of a
    partition, or part of that), so that the other rows are left out where they lie, whatever they hold."""
    bucket, at = F.bitmap_bucket_number("no"), F.bitmap_bit_position("no").cast("int")
    bits = numbers.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("no")).alias("bits"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = rows.join(F.broadcast(bits), bucket == F.col("bucket")).filter(F.getbit(byte, F.pmod(at, F.lit(8))) == 1)
    return held.select(*rows.columns)


def _texts_of(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """key, text of the classes in pairs."""
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    return _picked(bodies, keys.join(bodies.select("key", "no"), "key")).select("key", "text")


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and sketches allow, with what their sketches share."""
    both = _with_sides(pairs, classes, "n_shingles", "sketch")
    equal = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
    )
    sizes = 100 * F.least("n_shingles_a", "n_shingles_b") >= percent * F.greatest("n_shingles_a", "n_shingles_b")
    return both.filter(sizes).select("a", "b", equal.alias("equal")).filter(F.col("equal") >= shared_functions(percent))


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Of the pairs of each class the one whose sketches share most."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("own"), F.col("b").alias("other")),
                             F.struct(F.col("b").alias("own"), F.col("a").alias("other"))))
    best = pairs.select("equal", ends.alias("e")).groupBy("e.own").agg(F.max(F.struct("equal", "e.other")).alias("m"))
    return best.select(F.least("own", "m.other").alias("a"), F.greatest("own", "m.other").alias("b")).distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose classes aren't connected yet."""
    for side in ("a", "b"):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return pairs.filter("root_a <> root_b").select("a", "b")


def _exploded(batches):
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        numbers, texts = batch.column("no"), batch.column("text")
        for i in range(batch.num_rows):
            own = shingle_sets([unpress.decompress(texts[i].as_py())])[0]
            no = np.full(len(own), numbers[i].as_py(), np.int64)
            yield pa.record_batch([pa.array(no), pa.array(own.view(np.int64))], names=["no", "shingle"])


def _by_rare_shingles(rest: DataFrame, bodies: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """key, root -> all pairs of different roots that can reach `percent`. With shingles in one order,
    rarest first, two sets that share enough meet within the first n - need + 1 of each, where need is
    percent of n: no set of at least percent of n shingles shares less. Before the first shingle that two sets
    share lie only those that they do not, so its places bound what they share: in a group of near copies
    the shingles of few classes come first, and pairs below `percent` mostly do not meet at all."""
    # all shingles move twice: with a number, not with a key
    rest = rest.join(classes.select("key", "n_shingles"), "key")
    rest = stored(rest.withColumn("no", F.monotonically_increasing_id()), "numbered")
    texts = rest.join(bodies.select("key", "text"), "key").select("no", "text")
    shingles = stored(texts.mapInArrow(_exploded, "no long, shingle long"), "shingles")
    often = stored(shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).filter("often > 1"), "often")
    # a shingle of one class only meets nothing, but takes a place at the front
    ranked = shingles.join(often, "shingle").groupBy("no").agg(F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("s"))
    sized = ranked.join(rest, "no")
    need = F.ceil(F.col("n_shingles") * percent / 100)
    places = (F.size("s") - need + 1).cast("int")  # the n - size(s) single ones come first
    front = stored(
        sized.filter(places > 0)
        .select("key", "root", "n_shingles", F.size("s").alias("n"), F.posexplode(F.slice("s", F.lit(1), places)).alias("at", "e"))
        .select("key", "root", "n_shingles", "e.shingle", (F.col("n") - F.col("at")).alias("left")),
        "fronts",
    )
    x, y = (
        front.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("key", "root", "n_shingles", "left")])
        for side in ("a", "b")
    )
    # at most what either has from here on, this one included
    shared = F.least("left_a", "left_b") * (100 + percent) >= percent * (F.col("n_shingles_a") + F.col("n_shingles_b"))
    pairs = x.join(y, "shingle").filter("key_a < key_b AND root_a <> root_b").filter(shared)
    return pairs.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, keys: bool = False) -> DataFrame:
    """Groups of texts that share `percent` of their five-word shingles, directly or through others.

    Returns per input row doc_id, n_shingles, component_id (the smallest doc_id of the
    group), kept (doc_id = component_id); with `keys` also digest (of the text) and group (the same
    for all rows of a group; null without words).

    A-Z count as a-z. A text of one to four words is one shingle; null, empty and blank
    texts have none and are linked with nothing. Rows with equal texts are linked, repeated
    rows too; a row without doc_id has the component of its group, null if no row of it has
    an id, and is not kept unless it is alone. An empty table gives an empty table; other
    columns are ignored. No cap on groups: what branching and neighbours do not settle in large nodes is
    joined by rare shingles.
    Below 50 percent a node would need more than two functions: a ValueError.
    """
    if not 50 <= percent <= 100:
        raise ValueError(f"percent must be from 50 to 100, not {percent}")
    text_batches(docs.sparkSession)
    text = whole_text()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest16(text).alias("digest"), text.alias("text"))
    rows = stored(
        texts.mapInArrow(
            _sketched(trees(percent)),
            "doc_id long, digest binary, n_shingles long, body binary, roots array<long>, sketch array<tinyint>, packed binary",
        ).withColumn("no", F.monotonically_increasing_id()),
        "sketches",
    )
    classes = stored(
        rows.filter("body is not null")
        .groupBy("body")
        .agg(
            F.min("doc_id").alias("least"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("roots").alias("roots"),
            F.first("sketch").alias("sketch"),
            F.min("no").alias("no"),  # any text of a class has its shingles
        )
        .withColumn("key", _key(F.col("least"), F.col("body"))),
        "classes",
    )
    nodes = stored(_first_children(classes, trees(percent)), "paths")
    found, large = _candidates(nodes)
    first_large = large
    found = stored(_plausible(found, classes, percent), "pairs")
    # every later candidate shares a first node with another class, but only plausible pairs need texts;
    # classes of large nodes may meet anew further down
    wanted = found.select(F.col("a").alias("key")).unionByName(found.select(F.col("b").alias("key")))
    wanted = wanted.unionByName(large.select("key")).distinct().join(classes, "key").select("key", "no")
    wanted = stored(wanted, "wanted")
    bodies = _picked(rows.select("no", F.col("packed").alias("text")), wanted)
    bodies = stored(bodies.join(wanted, "no").select("key", "no", "text"), "bodies")

    def connected(pairs: DataFrame, roots: DataFrame | None) -> tuple[DataFrame, bool]:
        """Components with the pairs that their full sets confirm, and whether that paid."""
        texts = stored(_texts_of(pairs, bodies), "texts")
        sides = _with_sides(pairs.select("a", "b"), texts, "text")
        links = stored(sides.mapInArrow(_confirmed(percent), "a binary, b binary"), "confirmed")
        if roots is not None:
            n = links.count()
            if not n:
                return roots, False
            pays = n >= PAYS * pairs.count()
            links = links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        return components(links), roots is None or pays

    # the likeliest pair of each class first: most others then lie in one component and need no texts
    likeliest = stored(_likeliest(found), "pairs")
    roots, _ = connected(likeliest, None)
    tested = likeliest
    while True:
        found = stored(_apart(found, roots).join(tested, ["a", "b"], "left_anti"), "pairs")
        roots, more = connected(found, roots)
        first, tested = tested is likeliest, tested.unionByName(found)
        if not more and not first:
            break  # a whole round has connected next to nothing
        label = roots.select(F.col("node").alias("key"), "root")
        open_rows = large.join(label, "key", "left").withColumn("root", F.coalesce("root", "key"))
        parts = open_rows.groupBy("node", "root").agg(F.count(F.lit(1)).alias("n"))
        mixed = stored(
            parts.groupBy("node")
            .agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("most"))
            .filter("most.n < n")
            .select("node", F.col("most.root").alias("main"), (F.col("n") - F.col("most.n")).alias("rest")),
            "nodes",
        )
        if mixed.isEmpty():
            break
        left = stored(open_rows.join(mixed, "node"), "open")
        few = left.filter(F.col("rest") <= REST)
        rest = few.filter("root <> main").select("node", F.col("key").alias("x"), F.col("root").alias("root_x"))
        across = (
            few.select("node", F.col("key").alias("y"), "root")
            .join(rest, "node")
            .filter("root <> root_x")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        nodes = left.filter(F.col("rest") > REST).select("node", "key", "sketch")
        nodes = stored(_branch(_branch(nodes, percent), percent), "paths")
        found, large = _candidates(nodes)
        found = _plausible(found.unionByName(across).distinct(), classes, percent)
    # neighbours and pivots are not all pairs: nodes that are still mixed are joined exactly
    label = roots.select(F.col("node").alias("key"), "root")
    open_rows = first_large.join(label, "key", "left").select("node", "key", F.coalesce("root", "key").alias("root"))
    mixed = open_rows.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    rest = stored(open_rows.join(mixed.select("node"), "node").select("key", "root").distinct(), "rest")
    if not rest.isEmpty():
        found = _by_rare_shingles(rest, bodies, classes, percent)
        found = _plausible(found, classes, percent).join(tested, ["a", "b"], "left_anti")
        roots, _ = connected(stored(found, "pairs"), roots)
        label = roots.select(F.col("node").alias("key"), "root")
    # bytes 2 to 9 of a root are its doc_id, if the first one says that it has one
    group = F.coalesce("root", "key")
    root_id = F.conv(F.hex(F.substring(group, 2, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    root_id = F.when(F.hex(F.substring(group, 1, 1)) == "00", root_id)
    of_class = classes.join(label, "key", "left").select("body", root_id.alias("component"), group.alias("group"))
    component = F.when(F.col("body").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return (
        rows.select("doc_id", "digest", "n_shingles", "body")
        .join(of_class, "body", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
            *(["digest", "group"] if keys else []),
        )
    )


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
