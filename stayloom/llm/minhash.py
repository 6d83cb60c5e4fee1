"""Near duplicates by improved consistent weighted sampling over TF-IDF word shingles.

* Shingles are five consecutive words; a text with fewer words is one shingle, one with none has no
  shingle and is alone in its class.  A shingle weighs its count in the text times its inverse
  document frequency.  That is 1 for shingles in up to `COMMON` of all documents and falls to 0.5, in
  the logarithm of the frequency, for one in all.  Which shingles are common is found in two passes:
  a shingle common in the corpus is common in some chunk of it, so chunks name candidates, whose
  number is bounded by the mean text length over COMMON, and the second pass counts these exactly.
* Each text draws BANDS x ROWS consistent samples; equal bands make candidates.  Texts with the same
  weighted shingles are one node from the start.
* A bucket's members are compared with its leaders, members with about the most candidates over all
  their bands, which stand in the middle of a large group of near copies; in the second turn those
  outside the bucket's largest component with leaders inside it.  Members then leave a bucket if what
  they share with texts of other components is too little for a link to any text as heavy as the
  bucket's lightest.  Last, every member outside its bucket's largest component is compared with all
  members of other components, but for pairs whose common weight is known to be too small: what both
  share with other components at most, what the largest component as a whole has of the member, and
  the common part of both texts' sketches.  A sketch is the weight of a text's shingles by part, a part
  being a share of all shingles by hash; the lesser weight of each part, added up, is never below
  what two texts have in common.
  So no candidate pair is left out whose link could join classes, and pairs within a component are
  never listed.
* Comparison is the weighted Jaccard similarity of the whole texts.  Classes are the connected
  components of the links.

The class id is the least doc_id in the class (null if there is none), and that document stays.
Null texts are empty. Repeated rows are in one class; of rows that agree in id too, one stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayloom.llm import arrays
from stayloom.llm.frames import packed, ready, settle, survivors, unpacked

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 3
COMMON = 0.05
CHUNK_TEXTS, CHUNK_SHINGLES = 8192, 4_000_000
TURNS, LEADERS = 2, 3  # of leaders of each bucket
PRUNINGS = 3
PARTS = 128  # of a sketch

_random = np.random.Generator(np.random.PCG64(7))
_ODD = _random.integers(1, 1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GAMMA = _random.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
_LOG_GAMMA = np.log(_random.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count) of a block, sorted, each shingle of a row once."""
    start, end, bounds = arrays.words(data, offsets)
    hashes = arrays.word_hashes(data, start, end)
    row = arrays.rows_of(bounds)
    many = np.diff(bounds)
    inner = np.flatnonzero(row[words - 1 :] == row[: max(0, len(row) - words + 1)]) if len(row) >= words else np.zeros(0, np.int64)
    short = np.flatnonzero((many > 0) & (many < words))
    own = arrays.windows(hashes, words)[inner]
    few = arrays.spans(arrays.sums(hashes), bounds[:-1][short], bounds[1:][short])
    values, at = np.concatenate([own, few]), np.concatenate([row[inner], short])
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(at[order].astype(np.uint16 if len(offsets) < 65536 else np.int64), kind="stable")]
    values, at = values[order], at[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (at[1:] != at[:-1])
    first = np.flatnonzero(fresh)
    return at[first], values[first], np.diff(np.append(first, len(values)))


class Weights:
    """Inverse document frequencies: 1 but for the common shingles listed."""

    def __init__(self, common: np.ndarray, share: np.ndarray):
        order = np.argsort(common)
        self.common = common[order]
        self.idf = (1 - 0.5 * np.log(np.maximum(share[order], COMMON) / COMMON) / np.log(1 / COMMON)).astype(np.float32)

    def __call__(self, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weight = counts.astype(np.float32)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, values), len(self.common) - 1)
            hit = self.common[at] == values
            weight[hit] *= self.idf[at[hit]]
        return weight


def unsigned(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64).view(np.uint64)


def candidates(words: int) -> Callable:
    """Shingles that half of COMMON of a chunk's texts hold, with how many do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        texts = size = 0

        def out() -> pa.RecordBatch:
            values, many = np.unique(np.concatenate(held), return_counts=True)
            often = many >= max(1, np.ceil(COMMON / 2 * texts))
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].view(np.int64)), pa.array(many[often].astype(np.int64))], ["shingle", "many"]
            )

        for batch in batches:
            for _, data, offsets in arrays.blocks(batch.column("in_text")):
                held.append(shingles(data, offsets, words)[1])
                texts, size = texts + len(offsets) - 1, size + len(held[-1])
                if texts >= CHUNK_TEXTS or size >= CHUNK_SHINGLES:
                    yield out()
                    held, texts, size = [], 0, 0
        if held:
            yield out()

    return run


def counted(words: int, listed: Broadcast) -> Callable:
    """How many of a task's texts hold each listed shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = listed.value
        total = np.zeros(len(own), np.int64)
        for batch in batches:
            for _, data, offsets in arrays.blocks(batch.column("in_text")):
                _, values, _ = shingles(data, offsets, words)
                at = np.minimum(np.searchsorted(own, values), len(own) - 1)
                total += np.bincount(at[own[at] == values], minlength=len(own))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own[some].view(np.int64)), pa.array(total[some])], ["shingle", "many"])

    return run


def weights(source: DataFrame, words: int) -> Weights:
    """Document frequencies of all common shingles, over all documents."""
    documents = source.count()
    schema = "shingle bigint, many bigint"
    named = source.select("in_text").mapInArrow(candidates(words), schema).groupBy("shingle").agg(F.sum("many").alias("many"))
    listed = [r[0] for r in named.where(F.col("many") >= COMMON / 2 * documents).select("shingle").collect()]
    if not listed:
        return Weights(np.zeros(0, np.uint64), np.zeros(0))
    sorted_ = source.sparkSession.sparkContext.broadcast(np.sort(unsigned(np.array(listed))))
    exact = source.select("in_text").mapInArrow(counted(words, sorted_), schema).groupBy("shingle").agg(F.sum("many").alias("many"))
    rows = exact.where(F.col("many") >= COMMON * documents).collect()
    return Weights(unsigned(np.array([r[0] for r in rows], np.int64)), np.array([r[1] for r in rows]) / max(1, documents))


def samples(values: np.ndarray, weight: np.ndarray, first: np.ndarray) -> Iterator[np.ndarray]:
    """One consistent weighted sample of each row after the other; `first` are the rows' first shingles."""
    size = np.diff(np.append(first, len(values)))
    logs = np.log(weight)
    plain = not logs.any()
    low = np.uint64(0xFFFF)
    for odd in _ODD:
        x = values * odd
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x9FB21C651E98DF25)
        r = _GAMMA[(x >> np.uint64(48)).astype(np.int64)]
        c = _LOG_GAMMA[((x >> np.uint64(32)) & low).astype(np.int64)]
        beta = ((x >> np.uint64(8)) & low).astype(np.float32) * np.float32(2.0**-16)
        t = 0 if plain else np.floor(logs / r + beta)
        a = c - r * (t - beta + 1)
        least = np.minimum.reduceat(a, first)
        hit = np.flatnonzero(a == np.repeat(least, size))
        chosen = hit[np.searchsorted(hit, first)]
        step = np.zeros(len(first), np.int64) if plain else t[chosen].astype(np.int64)
        yield arrays.mix(values[chosen] + step.view(np.uint64) * arrays.SEED)


def signatures(words: int, idf: Broadcast) -> Callable:
    """Hashes of the bands of each text with a shingle, and a 128-bit hash of all its weighted shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, offsets in arrays.blocks(batch.column("in_text")):
                row, values, counts = shingles(data, offsets, words)
                first = np.flatnonzero(np.diff(row, prepend=-1))
                rows = len(offsets) - 1
                bands, whole = np.zeros((rows, BANDS), np.uint64), np.zeros((2, rows), np.uint64)
                some = np.zeros(rows, bool)
                if len(first):
                    own = row[first]
                    some[own] = True
                    for k in range(2):
                        whole[k, own] = np.add.reduceat(
                            arrays.mix(values * np.uint64(2 * k + 1) + (counts.astype(np.uint64) << np.uint64(k))), first
                        )
                    drawn = list(samples(values, idf.value(values, counts), first))
                    for b in range(BANDS):
                        key = np.full(len(first), b + 1, np.uint64)
                        for sample in drawn[b * ROWS : (b + 1) * ROWS]:
                            key = arrays.mix(key * arrays.SEED + sample)
                        bands[own, b] = key
                keys = lists_of(bands, some)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(start, rows) for c in ("in_id", "in_hash", "rest")),
                        *(pa.array(w.view(np.int64), mask=~some) for w in whole), keys,
                    ],
                    ["in_id", "in_hash", "rest", "c1", "c2", "bands"],
                )

    return run


def lists_of(bands: np.ndarray, some: np.ndarray) -> pa.Array:
    return arrays.lists(np.where(some, BANDS, 0), pa.array(bands[some].view(np.int64).ravel()))


def similar(words: int, idf: Broadcast, similarity: float) -> Callable:
    """Pairs whose weighted Jaccard similarity is at least `similarity`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = [np.asarray(batch.column(c).cast(pa.binary()).to_pandas().str.len()) for c in ("text_u", "text_v")]
            total = np.concatenate([[0], np.cumsum(length[0] + length[1])])
            at = 0
            while at < len(batch):
                to = max(at + 1, int(np.searchsorted(total, total[at] + 2 * arrays.BLOCK, "right")) - 1)
                part = batch.slice(at, min(to, len(batch)) - at)
                sides = []
                for column in ("text_u", "text_v"):
                    (_, data, offsets), = arrays.blocks(part.column(column), 1 << 62)
                    row, values, counts = shingles(data, offsets, words)
                    sides.append((row, values, idf.value(values, counts).astype(np.float64)))
                row, values, weight = (np.concatenate(x) for x in zip(*sides))
                order = np.lexsort((values, row))
                row, values, weight = row[order], values[order], weight[order]
                both = np.flatnonzero((row[1:] == row[:-1]) & (values[1:] == values[:-1]))
                common = np.bincount(row[both], weights=np.minimum(weight[both], weight[both + 1]), minlength=len(part))
                every = np.bincount(row, weights=weight, minlength=len(part)) - common
                hit = np.flatnonzero((common >= similarity * every * (1 - 1e-9)) & (every > 0))
                yield part.select(["u", "v"]).take(pa.array(hit))
                at = min(to, len(batch))

    return run


def weighed(words: int, idf: Broadcast) -> Callable:
    """(row, label, shingle, weight) of each text's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, offsets in arrays.blocks(batch.column("in_text")):
                row, values, counts = shingles(data, offsets, words)
                at = pa.array(row + start)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(at), batch.column("label").take(at), pa.array(values.view(np.int64)), pa.array(idf.value(values, counts).astype(np.float64))],
                    ["row", "label", "shingle", "weight"],
                )

    return run


def sketches(words: int, idf: Broadcast) -> Callable:
    """(row, sketch): the weight of each text's shingles by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, data, offsets in arrays.blocks(batch.column("in_text")):
                rows = len(offsets) - 1
                row, values, counts = shingles(data, offsets, words)
                part = (values >> np.uint64(40)).astype(np.int64) % PARTS
                found = np.bincount(row * PARTS + part, weights=idf.value(values, counts), minlength=rows * PARTS)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, rows), arrays.lists(np.full(rows, PARTS), pa.array(found.astype(np.float32)))],
                    ["row", "sketch"],
                )

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, label): least node of each connected component of the links (u, v)."""
    both = settle(links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    labels = settle(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")))
    while True:
        offered = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("offer"))
        lower = offered.join(labels, offered.u == labels.node).select("node", "label", F.least("label", "offer").alias("next"))
        lower = settle(lower)
        # Labels are nodes: what a label itself has fallen to holds for those that bear it.
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("further"))
        moved = settle(
            lower.join(jump, "next", "left").select("node", "label", F.least("next", F.coalesce("further", "next")).alias("next"))
        )
        labels = moved.select("node", F.col("next").alias("label"))
        if moved.where("label != next").isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """`docs` without its text, with in_id and in_hash (the row's key), class_id, class_size and kept."""
    spark = ready(docs.sparkSession)
    source = packed(docs, text, id).withColumn("in_hash", F.xxhash64("in_text"))
    idf = spark.sparkContext.broadcast(weights(source, words))
    rest = source.schema["rest"].dataType.simpleString()
    nodes = settle(
        source.mapInArrow(
            signatures(words, idf), f"in_id bigint, in_hash bigint, rest {rest}, c1 bigint, c2 bigint, bands array<bigint>"
        ).withColumn("row", F.monotonically_increasing_id())
    )
    # Texts with the same weighted shingles: one node, the least row.
    same = settle(nodes.where("c1 IS NOT NULL").groupBy("c1", "c2").agg(F.min("row").alias("node")))
    heads = nodes.join(same.select(F.col("node").alias("row")), "row", "left_semi")
    banded = heads.select(F.posexplode("bands").alias("band", "key"), "row")
    # Written, like other grouped sides below: a join of plain exchanges is one Spark can split.
    full = settle(banded.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1"))
    members = settle(banded.join(full, ["band", "key"]))
    wanted = members.select("row").distinct()
    keyed = heads.join(wanted, "row", "left_semi").select("row", F.coalesce("in_id", F.lit(-(2**63))).alias("in_id"), "in_hash")
    texts = settle(
        source.select(F.coalesce("in_id", F.lit(-(2**63))).alias("in_id"), "in_hash", "in_text")
        .join(keyed, ["in_id", "in_hash"])
        .dropDuplicates(["row"])
        .select("row", "in_text")
    )

    def linked(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("row").alias("u"), F.col("in_text").alias("text_u"))
        right = texts.select(F.col("row").alias("v"), F.col("in_text").alias("text_v"))
        sides = pairs.join(left, "u").join(right, "v").select("u", "v", "text_u", "text_v")
        return settle(sides.mapInArrow(similar(words, idf, similarity), "u bigint, v bigint"))

    def open_buckets(held: DataFrame) -> DataFrame:
        """Members, with labels, of buckets with several components, and each bucket's largest one."""
        sizes = held.groupBy("band", "key", "label").agg(F.count("*").alias("n"))
        top = settle(
            sizes.groupBy("band", "key")
            .agg(F.count("*").alias("labels"), F.sum("n").alias("n"), F.max_by("label", "n").alias("main"))
            .where("labels > 1")
        )
        return settle(held.join(top, ["band", "key"]))

    def pruned(held: DataFrame) -> DataFrame:
        """`held` without the members that cannot be linked to a text of another component in the bucket.

        A link of similarity s needs a common weight of s / (1 + s) times both weights together, and
        of s times the own weight; what any other component's text has counts as common.
        """
        named = held.select("row", "label").distinct()
        listed = settle(
            texts.join(named, "row").select("row", "label", "in_text").mapInArrow(
                weighed(words, idf), "row bigint, label bigint, shingle bigint, weight double"
            )
        )
        spread = listed.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        shared = settle(spread.where("low < high").select("shingle", F.lit(1.0).alias("shared")))
        own = settle(
            listed.join(shared, "shingle", "left")
            .groupBy("row")
            .agg(F.sum("weight").alias("weight"), F.sum(F.col("weight") * F.col("shared")).alias("common"))
        )
        weighted = settle(held.select("band", "key", "row", "label").join(own, "row"))
        lightest = settle(weighted.groupBy("band", "key").agg(F.min("weight").alias("lightest")))
        needed = F.greatest(
            similarity * F.col("weight"), similarity / (1 + similarity) * (F.col("weight") + F.col("lightest"))
        )
        left = weighted.join(lightest, ["band", "key"]).where(F.col("common") >= needed * (1 - 1e-6))
        return left.select("band", "key", "row", "label", "weight", "common")

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        """The labels after the links."""
        if links.isEmpty():
            return labels
        ends = [labels.select(F.col("row").alias(c), F.col("label").alias(f"l{c}")) for c in "uv"]
        between = links.join(ends[0], "u").join(ends[1], "v").select(F.col("lu").alias("u"), F.col("lv").alias("v")).distinct()
        fallen = components(between).select(F.col("node").alias("label"), F.col("label").alias("next"))
        return settle(labels.join(fallen, "label", "left").select("row", F.coalesce("next", "label").alias("label")))

    def pairs(found: DataFrame) -> DataFrame:
        return settle(found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())

    labels = settle(wanted.select("row", F.col("row").alias("label")))
    degree = settle(members.groupBy("row").agg(F.sum("n").alias("degree")))
    buckets = members.withColumns({"label": F.col("row"), "main": F.lit(None).cast("long")})
    for turn in range(TURNS):
        # The degree, moved by up to a tenth by chance, so that each leader is another of the central members.
        seeds = range(turn * LEADERS, (turn + 1) * LEADERS)
        moved = [F.col("degree") * (1 + F.pmod(F.xxhash64("row", F.lit(k)), F.lit(4096)) / 40960) for k in seeds]
        lead = settle(
            buckets.where("main IS NULL OR label = main")
            .join(degree, "row")
            .groupBy("band", "key")
            .agg(F.array_distinct(F.array(*[F.max_by("row", m) for m in moved])).alias("leaders"))
        )
        found = buckets.where("main IS NULL OR label != main").select("band", "key", F.col("row").alias("v")).join(lead, ["band", "key"])
        found = found.select("v", F.explode("leaders").alias("u")).where("u != v")
        labels = joined(labels, linked(pairs(found)))
        buckets = open_buckets(buckets.select("band", "key", "row").join(labels, "row"))
    for _ in range(PRUNINGS):
        buckets = open_buckets(pruned(buckets))
    # What a member shares with its buckets' largest components, each as a whole.
    mains = buckets.select(F.col("main").alias("label")).distinct()
    listed = settle(
        texts.join(buckets.select("row", "label").distinct(), "row").select("row", "label", "in_text").mapInArrow(
            weighed(words, idf), "row bigint, label bigint, shingle bigint, weight double"
        )
    )
    held = settle(listed.join(mains, "label").select("shingle", F.col("label").alias("main")).distinct())
    asked = buckets.where("label != main").select("row", "main").distinct()
    with_main = settle(
        listed.join(asked, "row").join(held, ["shingle", "main"]).groupBy("row", "main").agg(F.sum("weight").alias("with_main"))
    )
    # Each pair in the first band that both have in common, if their weights allow a link.
    sketched = settle(
        texts.join(buckets.select("row").distinct(), "row").select("row", "in_text").mapInArrow(
            sketches(words, idf), "row bigint, sketch array<float>"
        )
    )
    banded_members = settle(
        buckets.join(heads.select("row", "bands"), "row").join(with_main, ["row", "main"], "left").join(sketched, "row")
    )
    fewer, other = (
        banded_members.where(where).select("band", "key", *[F.col(c).alias(f"{c}_{side}") for c in ("row", "label", "main", "bands", "weight", "common", "with_main", "sketch")])
        for side, where in (("u", "label != main"), ("v", "true"))
    )
    earlier = F.exists(F.slice(F.zip_with("bands_u", "bands_v", lambda a, b: a == b), F.lit(1), F.col("band")), lambda same: same)
    most = F.when(F.col("label_v") == F.col("main_u"), F.coalesce("with_main_u", F.lit(0.0))).otherwise(F.col("common_u"))
    enough = F.least(most, "common_v") >= similarity / (1 + similarity) * (1 - 1e-6) * (F.col("weight_u") + F.col("weight_v"))
    meet = F.aggregate(F.zip_with("sketch_u", "sketch_v", lambda a, b: F.least(a, b).cast("double")), F.lit(0.0), lambda s, x: s + x)
    alike = meet >= similarity / (1 + similarity) * (1 - 1e-5) * (F.col("weight_u") + F.col("weight_v"))
    found = fewer.join(other, ["band", "key"]).where((F.col("label_u") != F.col("label_v")) & enough & ~earlier & alike)
    labels = joined(labels, linked(pairs(found.select(F.col("row_u").alias("u"), F.col("row_v").alias("v")))))
    classes = (
        nodes.select("row", "in_id", "in_hash", "rest", "c1", "c2")
        .join(same, ["c1", "c2"], "left")
        .join(labels.select(F.col("row").alias("node"), "label"), "node", "left")
        .select("row", "in_id", "in_hash", "rest", F.coalesce("label", "node", "row").alias("class"))
    )
    least = classes.groupBy("class").agg(
        F.min("in_id").alias("class_id"),
        F.min_by("row", F.coalesce("in_id", F.lit(2**63 - 1))).alias("keep_row"),
        F.count("*").alias("class_size"),
    )
    out = classes.join(least, "class").withColumn("kept", F.col("row") == F.col("keep_row"))
    names = ["in_id", "in_hash", "class_id", "class_size", "kept"]
    return unpacked(out, [c for c in docs.columns if c != text and c not in names], {c: F.col(c) for c in names})


def kept_documents(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One document of each class, with all columns."""
    decided = near_duplicates(docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), words, similarity)
    least = F.lit(-(2**63))
    keys = {
        "out_id": F.coalesce(F.col(f"`{id}`").cast("long"), least),
        "out_hash": F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))),
    }
    found = decided.select(F.coalesce("in_id", least).alias("out_id"), F.col("in_hash").alias("out_hash"), "kept")
    return survivors(docs, keys, settle(found))


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text")).select("doc_id", "class_id", "class_size", "kept")
