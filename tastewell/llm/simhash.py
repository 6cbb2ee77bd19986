"""Near-duplicate groups by SimHash, found with meet-in-the-middle ball hashing.

Two fingerprints at most three bits apart have a common variant: one bit off both if they differ in two;
if they differ in three, two of these bits lie in the same half, and one side flips that pair while the
other flips the third. The sides of an odd distance have bit counts of different parity, so only even
fingerprints emit pair flips (992 variants, besides the 65 of radius one that all emit). A variant is met by
at most as many fingerprints as its ball holds, so no key can be hot; a star from the smallest radius-one
member to all others links each of them in a number of rows linear in the bucket.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastewell.llm.components import components
from tastewell.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
RADIUS = 3
SEED = 42
VARIANTS_PER_PARTITION = 1 << 20
HASHES_PER_STEP = 1 << 16
VIEWS, VIEW_BITS, VIEW_RADIUS = 2, 40, 2  # fingerprints of the distinct words, for candidates
LEAST_PARITIES = 256
FOLDS = [f"fold_{i}" for i in range(LEAST_PARITIES // 64)]
BROADCAST_KEYS = 500_000  # pairs of id and text hash: some 20 MB
PREFIXES_PER_PARTITION = 1 << 20
SAMPLED_TEXTS = 20_000  # that tell which shingles are common; this sets their order only
COMMON_TEXTS, COMMON = 3, 100_000  # sampled texts that hold a common shingle, and how many such shingles are told apart
HUBS = 4  # stars a size class may have over its prefix shingles
SLACK = 1e-9  # for rounding of products with the similarity


def fingerprint(words: list[bytes], shingle: int) -> int:
    """Majority bits of the hashes of all shingles; zero without words."""
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(shingles), HASHES_PER_STEP):
        part = shingles[start : start + HASHES_PER_STEP]
        hashed = np.array([xxhash.xxh64_intdigest(s, SEED) for s in part], np.uint64)
        bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles), bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint((t or "").encode().lower().split(), shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(marks, np.uint64).view(np.int64))], names=["id", "mark"]
            )

    return compute


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3) -> DataFrame:
    """(id, mark): the 64-bit fingerprint of each row's whole text, as a signed long."""
    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).mapInArrow(
        _fingerprints(shingle), "id bigint, mark bigint"
    )


def _masks(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Flips within radius one, and the pair flips inside one half."""
    bit = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    half = bits // 2
    pairs = [bit[i + h] | bit[j + h] for h in (0, half) for i in range(half) for j in range(i + 1, half)]
    return np.concatenate([[np.uint64(0)], bit]), np.array(pairs, np.uint64)


def _variants(bits: int, radius: int = RADIUS):
    single, double = _masks(bits)
    both = np.concatenate([single, double]) if radius > 2 else single

    def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(variant, flip): the number of the flip that made the variant; a fingerprint is its variant flipped again."""
        for batch in batches:
            marks = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            even = np.bitwise_count(marks) % 2 == 0
            for group, masks in ((marks[even], both), (marks[~even], single)):
                for start in range(0, len(group), 256):
                    part = group[start : start + 256]
                    out = (part[:, None] ^ masks[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out.view(np.int64)), pa.array(np.tile(np.arange(len(masks), dtype=np.int16), len(part)))],
                        names=["variant", "flip"],
                    )

    return variants


def _meet(bits: int):
    single, double = _masks(bits)
    both = np.concatenate([single, double]).view(np.int64)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Star edges of the variants of one partition."""
        parts = [[batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)] for batch in batches if batch.num_rows]
        if not parts:
            return
        variant, flip = (np.concatenate([p[i] for p in parts]) for i in range(2))
        order = np.argsort(variant)
        variant, flip = variant[order], flip[order]
        same = variant[1:] == variant[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        variant, flip = variant[shared], flip[shared]
        if not len(variant):
            return
        mark, near = variant ^ both[flip], flip < len(single)
        # Equal variants stand together; within them those of radius one first, by fingerprint.
        order = np.lexsort((mark, ~near, variant))
        variant, mark, near = variant[order], mark[order], near[order]
        first = np.flatnonzero(np.concatenate([[True], variant[1:] != variant[:-1]]))
        sizes = np.diff(np.append(first, len(variant)))
        hub, reached = np.repeat(mark[first], sizes), np.repeat(near[first], sizes)
        keep = reached & (mark != hub)
        edges = np.unique(np.stack([hub[keep], mark[keep]], 1), axis=0)
        if len(edges):
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])

    return meet


def links(marks: DataFrame, bits: int = BITS, radius: int = RADIUS) -> DataFrame:
    """Verified edges (a, b) between distinct fingerprints that connect all pairs within the radius, two or three.

    Bits above ``bits`` never differ inside a pair: they keep fingerprints of several kinds apart.
    """
    if radius not in (2, 3):
        raise ValueError(f"radius {radius}")
    spark = marks.sparkSession
    distinct = written(marks.select("mark").distinct(), "marks")
    emitted = distinct.count() * (1 + bits + (bits // 2 * (bits // 2 - 1) // 2 if radius > 2 else 0))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), emitted // VARIANTS_PER_PARTITION + 1)
    # Few small rows become hundreds of times as many: deal them to all cores first.
    spread = distinct.repartition(partitions, F.xxhash64("mark"))
    variants = spread.mapInArrow(_variants(bits, radius), "variant bigint, flip smallint")
    met = variants.repartition(partitions, "variant").mapInArrow(_meet(bits), "a bigint, b bigint")
    return met.distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicate_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3) -> DataFrame:
    """Every row's fingerprint and group: (id, fingerprint, component_id).

    The component is the smallest id reachable over fingerprints at most three bits apart. Null and empty
    texts have fingerprint zero and are linked like any other; shorter texts count as one shingle. Rows
    with a null id keep a null id and take the smallest known id of their group, if it has any. Repeated
    rows come back as often as they came; other columns are ignored.
    """
    marks = written(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    grouped = components(links(marks))
    least = marks.groupBy("mark").agg(F.min("id").alias("first_id"))
    named = written(
        least.join(grouped, F.col("mark") == F.col("node"), "left").select(
            "mark", "first_id", F.coalesce("component", "mark").alias("component")
        ),
        "classes",
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = named.join(smallest, "component").select("mark", "component_id")
    return marks.join(classes, "mark").select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id"
    )


def _shingled(words: list[bytes], shingle: int) -> np.ndarray:
    """The distinct hashes of the word shingles, ascending."""
    parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)) if len(words) > shingle else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64))


def _shingle_counts(shingle: int):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(token, n): shingles and how many texts of the batch hold them."""
        for batch in batches:
            found = [_shingled((t or "").encode().lower().split(), shingle) for t in batch.column(0).to_pylist()]
            token, n = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

    return counts


def _common_shingles(docs: DataFrame, text_column: str, shingle: int) -> np.ndarray:
    """Shingles that many sampled texts hold, the rarest first."""
    share = SAMPLED_TEXTS / max(1, docs.count())
    texts = docs.select(F.col(text_column).alias("text"))
    texts = texts.sample(share, seed=SEED) if share < 1 else texts
    counted = texts.mapInArrow(_shingle_counts(shingle), "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    top = counted.filter(F.col("n") >= COMMON_TEXTS).orderBy(F.desc("n"), "token").limit(COMMON).toPandas()
    return top["token"].to_numpy(np.int64)[::-1].copy().view(np.uint64)


def _parities(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens in each of about as many cells; the cells of a smaller table are sums of these."""
    cells = max(LEAST_PARITIES, 1 << max(0, len(tokens) - 1).bit_length())
    counts = np.bincount((tokens & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _most_apart(one: np.ndarray, two: np.ndarray, similarity: float) -> np.ndarray:
    """Most shingles that only one of two texts alike can have."""
    return (1 - similarity) / (1 + similarity) * (one + two) + SLACK


def _folded(parities: bytes) -> list[int]:
    """The parities of the smallest table, as longs."""
    return np.bitwise_xor.reduce(np.frombuffer(parities, np.int64).reshape(-1, len(FOLDS)), axis=0).tolist()


def _likely(similarity: float):
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs that may be alike: a shingle of one text alone changes one parity, so these differ in no more cells than
        the texts in shingles."""
        for batch in batches:
            kept = []
            most = _most_apart(*(batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)), similarity)
            for i in range(batch.num_rows):
                one, two = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint8) for c in (4, 5))
                while len(one) != len(two):
                    one, two = (two, one) if len(one) < len(two) else (one, two)
                    one = one[: len(one) // 2] ^ one[len(one) // 2 :]
                if int(np.bitwise_count(one ^ two).sum()) <= most[i]:
                    kept.append(i)
            if kept:
                yield batch.select([0, 1]).take(pa.array(kept))

    return likely


def _sketches(shingle: int, similarity: float, common: np.ndarray):
    """Adds the key of the word sequence, the views (majority bits of the hashes of the distinct words), the
    number of distinct shingles, the prefix and the parities of the shingles.

    All texts order their shingles alike: by hash, the common ones last. Two sets alike in ``similarity`` share that
    part of the larger, so if the first of one are as many as it may lack and one more, these and those of the other meet.
    """
    order = np.argsort(common)
    known = common[order]

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, views, sizes, prefixes, parities, folds = [], [], [], [], [], []
            for text in batch.column(2).to_pylist():
                words = (text or "").encode().lower().split()
                keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
                hashed = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, set(words))), np.uint8).reshape(-1, 16)
                bits = 2 * np.unpackbits(hashed, axis=1).sum(0, dtype=np.int64) > len(hashed)
                views.append([int.from_bytes(np.packbits(bits[v * VIEW_BITS : (v + 1) * VIEW_BITS])) | v << VIEW_BITS for v in range(VIEWS)])
                tokens = _shingled(words, shingle)
                parities.append(_parities(tokens))
                folds.append(_folded(parities[-1]))
                if len(known):
                    place = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    last = known[place] == tokens
                    tokens = np.concatenate([tokens[~last], common[np.sort(order[place[last]])]])
                sizes.append(len(tokens))
                prefixes.append(tokens[: len(tokens) - int(np.ceil(similarity * len(tokens) - SLACK)) + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(views, pa.list_(pa.int64())),
                    pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(parities, pa.binary()),
                    *(pa.array([f[i] for f in folds], pa.int64()) for i in range(len(FOLDS))),
                ],
                names=["id", "text_hash", "key", "views", "size", "prefix", "parities", *FOLDS],
            )

    return sketches


def _rows_by_token(batches: Iterator[pa.RecordBatch], columns: int) -> list[np.ndarray]:
    """The columns of a partition, the first being the token; rows whose token no other has are left out."""
    parts = [[batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)] for batch in batches if batch.num_rows]
    if not parts:
        return [np.zeros(0, np.int64)] * columns
    rows = [np.concatenate([p[i] for p in parts]) for i in range(columns)]
    order = np.argsort(rows[0], kind="stable")
    same = np.diff(rows[0][order]) == 0
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    return [r[order] for r in rows]


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, node, size, rest) of tokens that stand in several prefixes."""
    rows = _rows_by_token(batches, 4)
    if len(rows[0]):
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["token", "node", "size", "rest"])


def _may_be_alike(size: np.ndarray, rest: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether what follows the first common shingle, with it, can still be enough; rules out unlike sizes too."""
    return np.minimum(rest[i], rest[j]) >= similarity / (1 + similarity) * (size[i] + size[j]) - SLACK


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _stars(similarity: float):
    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One text of every token and size class with the others; few different hubs in all."""
        token, node, size, rest = _rows_by_token(batches, 4)
        if not len(token):
            return
        level = np.floor(np.log(size) / -np.log(similarity)) if similarity < 1 else size
        turn = (token & (HUBS - 1)).view(np.uint64)
        mixed = (node.view(np.uint64) * np.uint64(HUBS) + turn + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        order = np.lexsort((mixed, level, token))
        token, node, size, rest, level = (x[order] for x in (token, node, size, rest, level))
        new = np.concatenate([[True], (np.diff(token) != 0) | (np.diff(level) != 0)])
        hub = np.flatnonzero(new)[np.cumsum(new) - 1]
        kept = np.flatnonzero(_may_be_alike(size, rest, hub, np.arange(len(hub)), similarity) & (node != node[hub]))
        if len(kept):
            yield _edges(node[hub[kept]], node[kept])

    return stars


def _pairs(similarity: float):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All pairs of a token that may be alike by sizes and parities and are not in one group yet."""
        token, node, size, rest, group, *folds = _rows_by_token(batches, 5 + len(FOLDS))
        order = np.lexsort((size, token))
        token, node, size, rest, group, *folds = (x[order] for x in (token, node, size, rest, group, *folds))
        marks = np.stack(folds, 1).view(np.uint64)
        left, step, held, many = np.arange(len(token)), 0, [], 0
        while len(left):
            step += 1
            left = left[left + step < len(token)]
            right = left + step
            # Sizes ascend within a token: from the first that is too large on, no other fits.
            fits = (token[left] == token[right]) & (similarity * size[right] <= size[left] + SLACK)
            left, right = left[fits], right[fits]
            found = np.flatnonzero((group[left] != group[right]) & _may_be_alike(size, rest, left, right, similarity))
            apart = np.bitwise_count(marks[left[found]] ^ marks[right[found]]).sum(1, dtype=np.int64)
            found = found[apart <= _most_apart(size[left[found]], size[right[found]], similarity)]
            if len(found):
                held.append((node[left[found]], node[right[found]]))
                many += len(found)
            if held and (many >= PREFIXES_PER_PARTITION or not len(left)):
                yield _edges(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
                held, many = [], 0

    return pairs


def _shingle_sets(shingle: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, shingles): the distinct hashes of the text's word shingles."""
        for batch in batches:
            out = [_shingled((text or "").encode().lower().split(), shingle).view(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["node", "shingles"])

    return sets


def _near(df: DataFrame, keys: DataFrame, how: str, most: int) -> DataFrame:
    """Joins on (id, text hash), nulls being equal; the keys are sent whole only if they are few."""
    if keys.limit(most + 1).count() <= most:
        keys = F.broadcast(keys)
    same = F.col("__key.id").eqNullSafe(F.col("__id")) & F.col("__key.text_hash").eqNullSafe(F.col("__text_hash"))
    return df.join(keys, same, how)


def deduplicated(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, similarity: float = 0.8, most: int = BROADCAST_KEYS
) -> DataFrame:
    """One row of every group of near duplicates, with its columns.

    Texts are linked whose sets of word shingles have a Jaccard similarity of ``similarity`` or more, all of them.
    Candidates come from ball hashing over two short fingerprints of the distinct words, which join the large
    groups in few rows, and from a prefix-filtered join of the shingles, which is complete: first stars over
    the shingles of the prefixes, then every pair of a prefix shingle that is not in one group by then. What
    the parities of the shingles do not rule out is verified on the shingles themselves. The row with the smallest id stays, null last; of rows
    alike in id and text one. Null, empty and blank texts are equal to each other.
    """
    own = docs.select(F.struct(F.col(id_column).cast("long").alias("id"), F.xxhash64(text_column).alias("text_hash")).alias("__key"), F.struct("*").alias("__doc"))
    keyed = own.select("__key.id", "__key.text_hash", F.col(f"__doc.{text_column}").alias("text")).mapInArrow(
        _sketches(shingle, similarity, _common_shingles(docs, text_column, shingle)),
        "id bigint, text_hash bigint, key binary, views array<bigint>, size int, prefix array<bigint>, parities binary, " + ", ".join(f"{f} bigint" for f in FOLDS),
    )
    keyed = written(keyed, "sketches")
    named = F.struct(F.col("id").isNull().alias("unknown"), "id", "text_hash")
    classes = keyed.groupBy("key").agg(F.min(named).alias("name"), F.first(F.struct("views", "size", "prefix", "parities", *FOLDS)).alias("sketch")).select("key", "name", "sketch.*")
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "text-classes")
    # The smallest class of each fingerprint stands for it; the others with that fingerprint are linked to it.
    held = written(classes.select("node", F.explode("views").alias("mark")), "class-marks")
    first = written(held.groupBy("mark").agg(F.min("node").alias("first")), "first-classes")
    found = links(first, VIEW_BITS, VIEW_RADIUS)
    names = first.select(F.col("mark").alias("__mark"), "first")
    edges = found.join(names, F.col("a") == F.col("__mark")).select(F.col("first").alias("a"), "b")
    edges = edges.join(names, F.col("b") == F.col("__mark")).select("a", F.col("first").alias("b"))
    alike = held.join(first, "mark").select(F.col("first").alias("a"), F.col("node").alias("b"))
    ball = edges.union(alike).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    spark = docs.sparkSession
    emitted = classes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), emitted // PREFIXES_PER_PARTITION + 1)
    prefixes = classes.select("node", "size", F.posexplode("prefix").alias("at", "token"))
    prefixes = prefixes.select("token", "node", "size", (F.col("size") - F.col("at")).alias("rest")).repartition(partitions, "token")
    shared = written(prefixes.mapInArrow(_shared, "token bigint, node bigint, size int, rest int"), "shared-prefixes")
    stars = shared.repartition(partitions, "token").mapInArrow(_stars(similarity), "a bigint, b bigint")

    def verified(edges: DataFrame) -> DataFrame:
        # Most candidates of a shared shingle are ruled out by their parities, before any text is read again.
        marks = [classes.select(*[F.col(c).alias(f"{c}_{side}") for c in ("node", "size", "parities")]) for side in "ab"]
        pairs = edges.distinct().join(marks[0], F.col("a") == F.col("node_a")).join(marks[1], F.col("b") == F.col("node_b"))
        pairs = pairs.select("a", "b", "size_a", "size_b", "parities_a", "parities_b").mapInArrow(_likely(similarity), "a bigint, b bigint")
        edges = written(pairs, "candidates")
        wanted = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = written(wanted.join(classes, "node").select("node", F.col("name.id").alias("__id"), F.col("name.text_hash").alias("__text_hash")), "wanted")
        texts = _near(own, wanted, "inner", most).select("node", F.col(f"__doc.{text_column}").alias("text"))
        sets = written(texts.mapInArrow(_shingle_sets(shingle), "node bigint, shingles array<bigint>").dropDuplicates(["node"]), "shingle-sets")
        one = edges.join(sets.withColumnRenamed("node", "a").withColumnRenamed("shingles", "left"), "a")
        both = one.join(sets.withColumnRenamed("node", "b").withColumnRenamed("shingles", "right"), "b")
        common = F.size(F.array_intersect("left", "right"))
        return both.filter(common >= F.lit(similarity) * (F.size("left") + F.size("right") - common)).select("a", "b")

    groups = written(components(verified(ball.union(stars))), "first-groups")
    named = shared.join(groups, "node", "left").join(classes.select("node", *FOLDS), "node")
    named = named.select("token", "node", "size", "rest", F.coalesce("component", "node").alias("component"), *FOLDS)
    others = named.repartition(partitions, "token").mapInArrow(_pairs(similarity), "a bigint, b bigint")
    near = verified(others).union(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
    grouped = components(near).select(F.col("node").alias("member"), "component")
    joined = classes.join(grouped, F.col("node") == F.col("member"), "left")
    groups = joined.select("key", "name", F.coalesce("component", "node").alias("component"))
    kept = groups.groupBy("component").agg(F.min("name").alias("kept"))
    # What goes: every (id, text) that is not the kept one of its group.
    kept_names = kept.select(F.col("kept.id").alias("__id"), F.col("kept.text_hash").alias("__text_hash"))
    rows = keyed.groupBy("id", "text_hash").agg(F.count("*").alias("n"))
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__text_hash"))
    state = written(rows.join(kept_names.withColumn("stays", F.lit(True)), same, "left").select("id", "text_hash", "n", "stays"), "fates")
    names = [F.col("id").alias("__id"), F.col("text_hash").alias("__text_hash")]
    rest = _near(own, written(state.filter("stays IS NULL").select(*names), "dropped"), "left_anti", most)
    again = written(state.filter("stays AND n > 1").select(*names), "repeated")
    if again.limit(1).count():
        repeated = _near(rest, again, "left_semi", most).dropDuplicates(["__key"])
        rest = _near(rest, again, "left_anti", most).union(repeated)
    return rest.select("__doc.*")
