"""Exact n-gram Jaccard join by a token-group matrix.

A document's set holds its distinct 5-word shingles as 64-bit hashes; two documents
link when 100 * |intersection| >= 75 * |union|. Documents with equal sets are one class.

1. Grouping. Classes that share a min-hash are compared with one leader of that bucket:
   the class made of the most common shingles, around which near copies were edited. A
   class has at most ``KEYS`` leaders, so this is linear however many near copies there
   are. Groups are the components of these verified links.
2. Matrix. Shingles are ordered by how common they are (from a count sketch of fixed
   size over all documents), rarest first. If two sets link, the first shingle they
   share is near the front of both, so only fronts count: a seventh of the smaller set,
   a quarter of the larger. The matrix holds, per shingle and group, the union of its
   members' fronts with bounds on their sizes and remaining shingles.
3. Bound. Groups are looked up in the matrix by the shingles of their fronts; another
   group qualifies if sizes and remaining shingles still allow the overlap a link needs.
4. Open. Only in qualifying groups are members compared: by the same bound, by an upper
   bound from small bitmaps of the sets, then exactly. All links together give the components.

Texts are shingled once for sizes, min-hashes and the sketch and once for the fronts, which
are kept. Later steps shingle only the texts whose sets they need, found by a text hash.

The order and the groups decide how much is compared, never what links: no link between
different classes is lost unless both ends are in one component already. 64-bit hashes
stand for shingles and classes.

Defined cases: null and word-free texts have empty sets and link with nothing; texts of
fewer than five words are one shingle; rows of one doc_id keep their own texts, their
component is the smallest id reached; null ids are never the smallest unless alone;
repeated rows fall in one class; an empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarjuman.llm.common import WORD, batches_of
from tarjuman.llm.components import components
from tarjuman.llm.language import mix64
from tarjuman.operators.shape import free_name
from tarjuman.workspace import materialize

WORDS = 5
KEYS = 4
SKETCH_BITS = 22
CHUNK = 4096
COMMON_SIGMAS = 4
BITMAP_BITS = 26

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and extended by doubling."""
    known = _POWERS.get(base, np.ones(1, np.uint64))
    while len(known) < n:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
    if len(known) <= 1 << 19:
        _POWERS[base] = known
    return known[:n]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's word 5-grams: a polynomial over the bytes of the
    words joined by single blanks, all by one prefix sum."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    terms = (data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > WORDS:
        starts, ends = starts[:len(words) - WORDS + 1], ends[WORDS - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    spans = (sums[ends] - sums[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return np.unique(mix64(spans + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def class_of(own: np.ndarray) -> int:
    """A hash of the whole set; 0 for the empty set."""
    if not len(own):
        return 0
    total = mix64(own + np.uint64(1)).sum(dtype=np.uint64, keepdims=True)
    return int(signed(mix64(total + np.uint64(len(own))))[0])


def bits_of(own: np.ndarray) -> bytes:
    """A bitmap of the set by the low bits of its hashes, four to eight bits a shingle."""
    size = max(64, 1 << (4 * max(len(own), 1) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(own & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def most_overlap(x: bytes, y: bytes, n: int, m: int) -> int:
    """An upper bound of the overlap of two sets of sizes ``n`` and ``m``: a bit that only
    one bitmap has is a shingle that only that set has. The larger bitmap is folded."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(a) > len(b):
        a = np.bitwise_or.reduce(a.reshape(-1, len(b)))
    elif len(b) > len(a):
        b = np.bitwise_or.reduce(b.reshape(-1, len(a)))
    return min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))


def needed(a, b):
    """Overlap from which sets of sizes ``a`` and ``b`` link, as numbers or columns."""
    return F.ceil((a + b) * 3 / F.lit(7)).cast("int")


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs; the length of the whole tells how many."""
    most = int(counts.max())
    return counts.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def unpacked_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, {1: "u1", 2: "<u2", 4: "<i4", 8: "<i8"}[len(data) // CHUNK]).astype(np.int64)


def scan_sets(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``(doc_id, text_hash, n, class, keys, bits)`` of every row of ``(doc_id, text, text_hash)``,
    and the count sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int32)
        # Shingle hashes are mixed well: an odd factor each gives other orders of them.
        factors = mix64(np.arange(1, KEYS + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
        for batch in batches:
            sizes, classes, keys, bits = [], [], [], []
            for text in batch["text"]:
                own = shingles(text)
                np.add.at(sketch, (own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                sizes.append(len(own))
                classes.append(class_of(own))
                bits.append(bits_of(own))
                keys.append([int(signed((own * f).min().reshape(1))[0]) for f in factors] if len(own) else [])
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "n": sizes, "class": classes, "keys": keys,
                "bits": bits, "chunk": None, "counts": None,
            })
        for chunk in range(0, 1 << SKETCH_BITS, CHUNK):
            if sketch[chunk:chunk + CHUNK].any():
                yield pd.DataFrame({
                    "doc_id": [None], "text_hash": None, "n": None, "class": None, "keys": None, "bits": None,
                    "chunk": chunk, "counts": [packed_counts(sketch[chunk:chunk + CHUNK])],
                })

    scanned = docs.select("doc_id", "text", "text_hash").mapInPandas(
        scan, f"doc_id {kind}, text_hash long, n int, class long, keys array<long>, bits binary, chunk int, counts binary")
    scanned = materialize(scanned, "sets")

    @F.pandas_udf("binary")
    def added(parts: pd.Series) -> bytes:
        # The sketches of a chunk's tasks, of fixed size each; wide sums, as tasks are many.
        total = np.zeros(CHUNK, np.int64)
        for part in parts:
            total += unpacked_counts(part)
        return packed_counts(total)

    counts = scanned.where("chunk is not null").select("chunk", "counts", (F.rand(7) * 16).cast("int").alias("lot"))
    counts = counts.groupBy("chunk", "lot").agg(added("counts").alias("counts"))
    counts = counts.groupBy("chunk").agg(added("counts").alias("counts"))
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in counts.collect():
        sketch[row["chunk"]:row["chunk"] + CHUNK] = unpacked_counts(bytes(row["counts"]))
    return scanned.where("chunk is null").drop("chunk", "counts"), sketch


def levels_of(sketch: np.ndarray) -> np.ndarray:
    """How common each bin of the sketch is: 0 within noise, else by powers of two."""
    mean = max(sketch.mean(), 1.0)
    above = sketch - mean - COMMON_SIGMAS * np.sqrt(mean)
    return np.where(above > 0, np.log2(np.maximum(above, 1)) + 1, 0).astype(np.uint8)


def rare_first(own: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The set in the order all documents share: rare shingles first, then by hash."""
    level = levels[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    return own[np.argsort(level, kind="stable")]


def bitmap_of(hashes: DataFrame, column: str):
    """A broadcast bitmap with a bit for each hash, by its low bits: a first filter of
    fixed size, whatever the data, put together on the executors."""
    bit = F.col(column).bitwiseAND((1 << BITMAP_BITS) - 1)
    words = hashes.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(63).cast("int").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        chunk = int(group["word"].iloc[0]) // CHUNK
        packed = np.zeros(CHUNK, np.int64)
        packed[group["word"].to_numpy(np.int64) % CHUNK] = group["bits"].to_numpy(np.int64)
        return pd.DataFrame({"chunk": [chunk], "bits": [packed.tobytes()]})

    chunks = words.groupBy(F.shiftright("word", CHUNK.bit_length() - 1)).applyInPandas(pack, "chunk long, bits binary")
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    for row in chunks.collect():
        bitmap[row["chunk"] * CHUNK:(row["chunk"] + 1) * CHUNK] = np.frombuffer(bytes(row["bits"]), np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(bitmap)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64((1 << BITMAP_BITS) - 1)
    return (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


def sets_of(docs: DataFrame, sets: DataFrame, classes: DataFrame, compute, schema: str) -> DataFrame:
    """``compute`` of the sets of the documents that stand for ``(class)``, and of few others.

    One text hash per class goes into a bitmap of fixed size; only texts that it has are
    shingled. Texts are looked up and shingled by one worker, which keeps memory down.
    """
    wanted = sets.join(classes, "class", "left_semi").groupBy("class").agg(F.min("text_hash").alias("text_hash"))
    likely = bitmap_of(wanted, "text_hash")

    def shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hit = in_bitmap(likely.value, batch["text_hash"].to_numpy(np.int64).view(np.uint64))
            if hit.any():
                yield compute([shingles(t) for t in batch["text"][hit]])

    return docs.where("text is not null").select("text", "text_hash").mapInPandas(shingled, schema)


def star_pairs(docs: DataFrame, sets: DataFrame, levels) -> DataFrame:
    """``(a, b)``: a class and the leader of a min-hash bucket it is in, if sizes allow a link."""
    kept = sets.where("n > 0").groupBy("class").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    keyed = kept.select("class", "n", F.posexplode("keys").alias("k", "key"))
    several = keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    keyed = materialize(keyed.join(several, ["k", "key"]), "keyed")

    def rate(own: list[np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({
            "class": [class_of(s) for s in own],
            "common": [float(levels.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].mean())
                       if len(s) else 0.0 for s in own],
        })

    rated = sets_of(docs, sets, keyed.select("class").distinct(), rate, "class long, common double")
    rated = materialize(rated.groupBy("class").agg(F.first("common").alias("common")), "rated")
    keyed = keyed.join(rated, "class")
    leaders = keyed.groupBy("k", "key").agg(
        F.max(F.struct("common", "class", "n")).alias("leader")).select("k", "key", "leader.class", "leader.n")
    leaders = leaders.withColumnsRenamed({"class": "b", "n": "m"})
    pairs = keyed.join(leaders, ["k", "key"]).where("class <> b and 4 * least(n, m) >= 3 * greatest(n, m)")
    return pairs.select(F.col("class").alias("a"), "b").distinct()


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of classes whose bitmaps allow a link. No link is lost, few others stay."""
    classes = sets.where("n > 0").groupBy("class").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))

    @F.pandas_udf("boolean")
    def allowed(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([7 * most_overlap(*row) >= 3 * (row[2] + row[3]) for row in zip(x, y, n, m)], dtype=bool)

    both = pairs.join(classes.toDF("a", "n", "x"), "a").join(classes.toDF("b", "m", "y"), "b")
    return materialize(both.where(allowed("x", "y", "n", "m")).select("a", "b"), "possible")


def verified(docs: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of classes whose sets link: by bitmaps first, what they leave by exact comparison."""
    pairs = possible(pairs, sets)
    wanted = materialize(
        pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct(), "compared")

    def hashed(own: list[np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"class": [class_of(s) for s in own], "set": [s.tobytes() for s in own]})

    # Only classes that are compared are kept, each once; most others are not even shingled.
    compared = sets_of(docs, sets, wanted, hashed, "class long, set binary")
    compared = compared.join(wanted, "class", "left_semi").dropDuplicates(["class"])
    compared = materialize(compared, "compared-sets")

    @F.pandas_udf("boolean")
    def link(left: pd.Series, right: pd.Series) -> pd.Series:
        found = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[at] == x).sum())
            found.append(100 * both >= 75 * (len(x) + len(y) - both))
        return pd.Series(found, dtype=bool)

    both = pairs.join(compared.toDF("a", "left"), "a").join(compared.toDF("b", "right"), "b")
    return materialize(both.where(link("left", "right")).select("a", "b"), "verified")


def fronts(docs: DataFrame, levels) -> DataFrame:
    """``(class, n, front)``: the first shingles of every document, as many as any link needs."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [s for s in map(shingles, batch["text"]) if len(s)]
            yield pd.DataFrame({
                "class": [class_of(s) for s in own], "n": [len(s) for s in own],
                "front": [rare_first(s, levels.value)[:len(s) - -(-3 * len(s) // 4) + 1].tobytes() for s in own],
            })

    return materialize(docs.select("text").mapInPandas(cut, "class long, n int, front binary"), "fronts")


def tokens_of(cut: DataFrame, bitmap=None) -> DataFrame:
    """``(token, class, n, pos)``: the shingles of the fronts, at most those that ``bitmap`` has."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for own_class, n, data in zip(batch["class"], batch["n"], batch["front"]):
                front = np.frombuffer(data, np.uint64)
                pos = np.arange(len(front), dtype=np.int32)
                if bitmap is not None:
                    hit = in_bitmap(bitmap.value, front)
                    front, pos = front[hit], pos[hit]
                if len(front):
                    parts.append((front, np.full(len(front), own_class), np.full(len(front), n, np.int32), pos))
            if parts:
                token, own_class, n, pos = map(np.concatenate, zip(*parts))
                yield pd.DataFrame({"token": signed(token), "class": own_class, "n": n, "pos": pos})

    return cut.mapInPandas(emit, "token long, class long, n int, pos int")


def shared_tokens(cut: DataFrame) -> DataFrame:
    """Shingles that are at the front of more than one class."""
    rows = tokens_of(cut).groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return materialize(rows.where("low < high").select("token"), "shared")


def cross_pairs(docs: DataFrame, groups: DataFrame, levels) -> DataFrame:
    """``(a, b)``: classes of different groups that may link, by the token-group matrix."""
    cut = fronts(docs, levels)
    tokens = shared_tokens(cut)
    rows = tokens_of(cut, bitmap_of(tokens, "token")).join(tokens, "token", "left_semi").distinct()
    rows = rows.join(groups.withColumnsRenamed({"node": "class", "label": "group"}), "class", "left")
    rows = materialize(rows.withColumn("group", F.coalesce("group", "class")), "front-tokens")
    index = rows.where(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * 6 / F.lit(7)))
    rest = F.max(F.col("n") - F.col("pos"))
    asking = rows.groupBy("token", "group").agg(
        F.min("n").alias("q_least"), F.max("n").alias("q_most"), rest.alias("q_rest"))
    matrix = index.groupBy("token", "group").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), rest.alias("rest")).withColumnRenamed("group", "other")
    # The least overlap that any of the group's sets needs with any of the other's.
    smallest = F.greatest("least", F.ceil(F.col("q_least") * 3 / F.lit(4)).cast("int"))
    qualified = asking.join(matrix, "token").where(
        (F.col("group") != F.col("other")) & (F.col("least") <= F.col("q_most")) & (4 * F.col("most") >= 3 * F.col("q_least"))
        & (F.least("q_rest", "rest") >= needed(F.greatest("q_least", "least"), smallest))
    ).select("token", "group", "other")
    asked = rows.select("token", "group", F.col("class").alias("q"), F.col("n").alias("qn"), F.col("pos").alias("qpos"))
    opened = qualified.join(asked, ["token", "group"]).drop("group").join(
        index.withColumnRenamed("group", "other"), ["token", "other"]
    ).where(
        (F.col("n") <= F.col("qn")) & (4 * F.col("n") >= 3 * F.col("qn"))
        & (F.least(F.col("qn") - F.col("qpos"), F.col("n") - F.col("pos")) >= needed(F.col("n"), F.col("qn")))
    )
    return opened.select(F.least("q", "class").alias("a"), F.greatest("q", "class").alias("b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, n_shingles, class, label, component_id)``, one row per row of ``docs``.

    ``label`` tells components apart (null for empty sets), ``component_id`` is the
    smallest doc_id in one, ``text_hash`` the xxhash64 of the text.
    """
    spark = docs.sparkSession
    own = F.col(f"`{text}`")
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), own.alias("text"), F.xxhash64(own).alias("text_hash"))
    with batches_of(spark, 256, "8MB"):
        sets, sketch = scan_sets(docs)
        levels = spark.sparkContext.broadcast(levels_of(sketch))
        stars = verified(docs, star_pairs(docs, sets, levels), sets)
        groups = components(stars)
        crossing = verified(docs, cross_pairs(docs, groups, levels), sets)
        labels = components(stars.union(crossing))
    least = sets.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    labelled = least.join(labels, F.col("class") == F.col("node"), "left")
    labelled = labelled.select("class", "least", F.coalesce("label", "class").alias("label"))
    reached = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = materialize(labelled.join(reached, "label").select("class", "label", "component_id"), "components")
    found = sets.join(named, "class", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "class", "label",
        component.alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that of the smallest id; rows with an empty set all stay."""
    found = near_duplicates(docs, doc_id, text).where("label is not null")
    first = found.groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select("first.*")
    # Null-safe ids as text; both sides are dealt by them, so repeated rows meet in one task.
    key, print_ = free_name(docs.columns, "_id"), free_name(docs.columns, "_print")
    as_key = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(key)
    first = materialize(first.select(as_key("doc_id"), F.col("text_hash").alias(print_)), "kept")
    own = F.col(f"`{text}`")
    marked = docs.select(*[F.col(f"`{c}`") for c in docs.columns], as_key(doc_id), F.xxhash64(own).alias(print_))
    has_words = F.coalesce(own.rlike(WORD), F.lit(False))
    kept = marked.where(has_words).join(first.hint("merge"), [key, print_], "left_semi").dropDuplicates([key, print_])
    return kept.unionByName(marked.where(~has_words)).drop(key, print_)
