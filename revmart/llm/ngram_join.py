"""Exact Jaccard self-join of word n-gram sets by signature trees.

Documents with equal sets are one class. Classes meet in groups: of a set's
shingles in a global order (common ones last, else by hash) the first
n - ceil(0.8 n) + 1 are its prefix, and two sets that link share a prefix
shingle. All classes with a shingle in their prefix join the group of the
smallest class that has it, so near copies, which share most shingles, meet
in one group and not in one per shingle.

In a group the sets become signature trees: every node holds the OR of its
token bitmaps and its range of set sizes. A traversal of pairs of nodes
starts at the root with itself and drops a pair whose size ranges or largest
possible overlap cannot reach the threshold. The pairs left at the leaves
split a group into its candidate parts: what only shares a passage falls
apart here, and only bitmaps (a quarter byte a shingle) were moved for it.
The parts then get their whole sets, and a second traversal verifies its
leaf pairs on them, unless both documents hang together already. A part
leaves the edges of a spanning forest, never all pairs.

Which shingles count as common comes from a bounded sample of documents; it
only changes the order, never the result. Rows of common shingles are not
shuffled by shingle: their groups come from an aggregate with one row per
common shingle. Groups over ``block`` classes are split into blocks and
every pair of blocks is a task's group of its own.

Shingles are 64-bit hashes of word sequences; two different ones are taken
as equal with a probability of 2^-64.

Defined results: null and wordless texts have size 0, link with nothing and
are their own component; fewer words than n are one shingle; rows that share
an id share a component; rows with a null id link with nothing (component
null); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import bounded_sample, limited, materialise, neutral_names, words_of
from revmart.llm.components import components
from revmart.llm.embedding_dedup import unite

FAN = 8
_P, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M
    return (h ^ (h >> np.uint64(32))) * _M


class Shingler:
    """Sorted distinct shingle hashes of texts; word hashes are looked up in a bounded table."""

    def __init__(self, n: int, table_words: int = 300_000) -> None:
        self.n, self.table_words, self.hashes = n, table_words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        import xxhash

        words = words_of(text)
        if not words:
            return np.zeros(0, dtype=np.uint64)
        table = self.hashes
        if len(table) > self.table_words:
            table.clear()
        for w in set(words).difference(table):
            table[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([table[w] for w in words], dtype=np.uint64)
        k = min(self.n, len(h))
        out = np.full(len(h) - k + 1, k, dtype=np.uint64)
        for i in range(k):
            out = out * _P + h[i:len(h) - k + 1 + i]
        return np.unique(_mix(out))


def needed(size: np.ndarray | int) -> np.ndarray | int:
    """Least number of shared shingles of a set with any set that links: ceil(0.8 size)."""
    return (4 * size + 4) // 5


def _common_shingles(docs: DataFrame, n: int, sample: int, least: int, most: int) -> np.ndarray:
    """Shingles in at least ``least`` different sets of a sample, the ``most`` most frequent at the most."""
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingler(n)
        for batch in limited(batches, "text", 2_000_000):
            sets = {s.tobytes() for s in map(make, batch.column("text").to_pylist())}  # copies count once a batch
            for s in sets:
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s, "<i8"))], ["token"])

    rows = bounded_sample(docs, "doc_id", sample, seed=31).select("text").mapInArrow(shingles, "token long")
    common = (rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
              .orderBy(F.desc("n"), "token").limit(most).collect())
    return np.sort(np.array([r["token"] for r in common], dtype=np.int64).view(np.uint64))


def _sets(docs: DataFrame, n: int, common: np.ndarray) -> DataFrame:
    """Per row: doc_id, n_shingles, digest of the set, its prefix in rare and common shingles, its bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(common)  # bounded: see _common_shingles

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, frequent = Shingler(n), shared.value
        for batch in limited(batches, "text", 2_000_000):
            out: list[list] = [[] for _ in range(5)]
            for text in batch.column("text").to_pylist():
                s = make(text)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    is_common = frequent[at] == s
                    rare, hot = s[~is_common], s[is_common]
                else:
                    rare, hot = s, s[:0]
                p = len(s) - needed(len(s)) + 1 if len(s) else 0
                rare = rare[:p]
                for column, value in zip(out, (len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                                               rare.view(np.int64), hot[:p - len(rare)].view(np.int64),
                                               signature(s))):
                    column.append(value)
            types = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, t) for v, t in zip(out, types))],
                ["doc_id", "n_shingles", "digest", "rare", "hot", "bitmap"])

    return docs.mapInArrow(compute, "doc_id long, n_shingles long, digest binary, rare array<long>, "
                                    "hot array<long>, bitmap binary")


def _groups_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (token, rep): (smallest rep of the token, rep), for tokens of several reps."""
    token = lowest = None
    for batch in batches:
        tokens, reps = batch.column("token").to_numpy(), batch.column("rep").to_numpy()
        if not len(tokens):
            continue
        starts = np.append(True, tokens[1:] != tokens[:-1])
        starts[0] = tokens[0] != token
        first = np.maximum.accumulate(np.where(starts, np.arange(len(tokens)), -1))
        low = np.where(first >= 0, reps[np.maximum(first, 0)], lowest if lowest is not None else 0)
        member = ~starts & (reps != low)
        leader = np.unique(low[member])
        pairs = np.unique(np.stack((np.concatenate((low[member], leader)),
                                    np.concatenate((reps[member], leader))), axis=1), axis=0)
        token, lowest = tokens[-1], low[-1]
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["low", "rep"])


def _members(classes: DataFrame) -> DataFrame:
    """(low, rep): the classes of every group of at least two."""
    rare = classes.select(F.explode("rare").alias("token"), "rep")
    from_rare = (rare.repartition("token").sortWithinPartitions("token", "rep")
                 .mapInArrow(_groups_of_sorted, "low long, rep long"))
    hot = classes.select(F.explode("hot").alias("token"), "rep")
    lows = hot.groupBy("token").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high")
    from_hot = hot.join(F.broadcast(lows), "token").select("low", "rep")  # a row per common shingle: bounded
    return materialise(from_rare.unionByName(from_hot).distinct(), "members")


MOST_BITS = 1 << 16


def signature(shingles: np.ndarray) -> bytes:
    """Bitmap of a set: a power of two of bits, at least twice its size (up to MOST_BITS); bit h mod bits."""
    bits = 512
    while bits < 2 * len(shingles) and bits < MOST_BITS:
        bits *= 2
    flags = np.zeros(bits, dtype=np.uint8)
    flags[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags).tobytes()


def fold(bitmap: bytes, size: int) -> bytes:
    """The same set's bitmap of ``size`` bytes, at most as many as it has."""
    rows = np.frombuffer(bitmap, np.uint8).reshape(-1, size)
    return np.bitwise_or.reduce(rows, axis=0).tobytes()


class SignatureTree:
    """Sets ordered by size, and above them nodes of FAN children: OR of bitmaps, sizes, most hidden tokens.

    All bitmaps are of one width; sizes ascend.
    """

    def __init__(self, bitmaps: list[bytes], sizes: np.ndarray) -> None:
        maps = np.frombuffer(b"".join(bitmaps), np.uint64).reshape(len(bitmaps), -1)
        # hidden: tokens of a set beyond its bits (several on one bit)
        hidden = sizes - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
        self.levels = [(maps, sizes, sizes, hidden)]
        while len(maps) > 1:
            starts = np.arange(0, len(maps), FAN)
            _, low, high, hidden = self.levels[-1]
            maps = np.bitwise_or.reduceat(maps, starts, axis=0)
            self.levels.append((maps, np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts),
                                np.maximum.reduceat(hidden, starts)))

    def possible(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether some set under node i can link with some set under node j."""
        maps, low, high, hidden = self.levels[level]
        ok = (5 * high[i] >= 4 * low[j]) & (5 * high[j] >= 4 * low[i])
        at = np.flatnonzero(ok)
        for k in range(0, len(at), 4096):
            part = at[k:k + 4096]
            a, b = i[part], j[part]
            overlap = np.bitwise_count(maps[a] & maps[b]).sum(axis=1).astype(np.int64) + np.minimum(hidden[a], hidden[b])
            overlap = np.minimum(overlap, np.minimum(high[a], high[b]))
            ok[part] = 9 * overlap >= 4 * (low[a] + low[b])
        return ok

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sets (i < j) that no bound rules out, in portions: a traversal of node pairs from the root."""
        stack = [(len(self.levels) - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
        while stack:
            level, i, j = stack.pop()
            keep = self.possible(level, i, j)
            i, j = i[keep], j[keep]
            if not level:
                if len(i):
                    yield i, j
                continue
            below = len(self.levels[level - 1][1])
            a = (i[:, None] * FAN + np.repeat(np.arange(FAN), FAN)).ravel()
            b = (j[:, None] * FAN + np.tile(np.arange(FAN), FAN)).ravel()
            inside = (a < below) & (b < below) & ((a < b) if level == 1 else (a <= b))
            a, b = a[inside], b[inside]
            stack += [(level - 1, a[k:k + 50_000], b[k:k + 50_000]) for k in range(0, len(a), 50_000)]


def candidate_pairs(bitmaps: list[bytes], sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sets that may link, as indices, in portions.

    Sets that link differ in size by a quarter at most, so their bitmaps are
    of one width or of neighbouring ones: a tree per width holds the sets of
    that width and, folded, those of the next.
    """
    widths = np.array([len(b) for b in bitmaps])
    for width in np.unique(widths):
        rows = np.flatnonzero((widths == width) | (widths == 2 * width))
        rows = rows[np.argsort(sizes[rows], kind="stable")]
        if len(rows) < 2:
            continue
        tree = SignatureTree([bitmaps[r] if widths[r] == width else fold(bitmaps[r], int(width)) for r in rows],
                             sizes[rows])
        for i, j in tree.candidates():
            i, j = rows[i], rows[j]
            own = (widths[i] == width) | (widths[j] == width)  # two wider ones meet in their own tree
            if own.any():
                yield i[own], j[own]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 80 * (len(a) + len(b) - both)


def join_sets(sets: list[np.ndarray], pairs_ok=None) -> list[tuple[int, int]]:
    """Linked pairs that make a spanning forest of the sets' components (indices into ``sets``).

    pairs_ok(i, j) can rule pairs out that another group looks at.
    """
    label, edges = np.arange(len(sets)), []
    for i, j in candidate_pairs([signature(s) for s in sets], np.array([len(s) for s in sets], dtype=np.int64)):
        if pairs_ok is not None:
            keep = pairs_ok(i, j)
            i, j = i[keep], j[keep]
        while True:
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            if not len(i):
                break
            found = [(a, b) for a, b in zip(i[:64].tolist(), j[:64].tolist()) if linked(sets[a], sets[b])]
            i, j = i[64:], j[64:]
            if found:
                edges += found
                unite(label, *np.array(found).T)
    return edges


def _other_block(block: np.ndarray, bi: int, bj: int):
    """Of a pair of blocks only pairs across them: those inside are the block's own group's."""
    return None if bi == bj else lambda i, j: block[i] != block[j]


def _split_group(key: tuple, table: pa.Table) -> pa.Table:
    """A group's candidate parts, by bitmaps: (smallest rep of the part, rep), parts of one left out."""
    table = table.sort_by([("rep", "ascending"), ("n_shingles", "ascending")])
    reps, block = table.column("rep").to_numpy(), table.column("block").to_numpy()
    across, label = _other_block(block, key[1].as_py(), key[2].as_py()), np.arange(len(reps))
    for i, j in candidate_pairs(table.column("bitmap").to_pylist(), table.column("n_shingles").to_numpy()):
        if across is not None:
            keep = across(i, j)
            i, j = i[keep], j[keep]
        unite(label, i, j)
    part = np.flatnonzero(np.bincount(label, minlength=len(label))[label] > 1)
    return pa.table({"low": reps[label[part]], "rep": reps[part]})


def _join_group(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("rep")
    reps, block = table.column("rep").to_numpy(), table.column("block").to_numpy()
    sets = [np.frombuffer(b, "<u8") for b in table.column("shingles").to_pylist()]
    edges = join_sets(sets, _other_block(block, key[1].as_py(), key[2].as_py()))
    a, b = np.array(edges, dtype=np.int64).reshape(-1, 2).T
    return pa.table({"a": reps[a], "b": reps[b]})


def _deal(members: DataFrame, block: int) -> DataFrame:
    """(low, bi, bj, block, rep): a group over ``block`` rows as pairs of blocks, each a group of its own."""
    large = members.groupBy("low").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks")).filter("blocks > 1")
    return (members.join(large, "low", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("bigint")))
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
            .select("low", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                    "block", "rep"))


def _parts(members: DataFrame, bitmaps: DataFrame, block: int) -> DataFrame:
    """(low, rep): the groups' candidate parts."""
    rows = _deal(members, block).join(bitmaps, "rep")
    return materialise(rows.groupBy("low", "bi", "bj").applyInArrow(_split_group, "low long, rep long").distinct(),
                       "parts")


def _likely(docs: DataFrame, ids: DataFrame, bits: int = 1 << 27) -> DataFrame:
    """``docs`` without most rows whose doc_id is not among ``ids`` (rep).

    A bitmap of hashed ids, ``bits`` / 8 bytes (16 MB) at the most however many
    ids there are, is broadcast; rows without their bit need not be shuffled.
    A hash met by chance lets a row through, never stops one.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    marks = ids.select(place("rep").alias("h")).groupBy(F.bitmap_bucket_number("h").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits"))
    met = (docs.withColumn("h", place("doc_id")).withColumn("at", F.bitmap_bit_position("h"))
           .join(F.broadcast(marks), F.bitmap_bucket_number("h") == F.col("bucket")))
    byte = F.conv(F.hex(F.expr("substring(bits, cast(at div 8 + 1 as int), 1)")), 16, 10).cast("int")
    bit = F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (F.col("at") % 8 + 1).cast("int"))
    return met.filter(byte.bitwiseAND(bit) != 0).select(*docs.columns)


def _edges(docs: DataFrame, parts: DataFrame, n: int, block: int) -> DataFrame:
    """Linked pairs, a spanning forest of each part."""
    places = _deal(parts, block).groupBy("rep").agg(F.collect_list(F.struct("low", "bi", "bj", "block")).alias("places"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingler(n)
        for batch in batches:
            for rep, text, places in zip(*(batch.column(c).to_pylist() for c in ("rep", "text", "places"))):
                data = make(text).tobytes()
                for k in range(0, len(places), 100):
                    some = places[k:k + 100]
                    yield pa.RecordBatch.from_pydict({
                        **{c: pa.array([p[c] for p in some], pa.int64()) for c in ("low", "bi", "bj", "block")},
                        "rep": pa.array([rep] * len(some), pa.int64()),
                        "shingles": pa.array([data] * len(some), pa.binary())})

    texts = _likely(docs, parts).join(places, F.col("doc_id") == F.col("rep")).select("rep", "text", "places")
    rows = texts.mapInArrow(compute, "low long, bi long, bj long, block long, rep long, shingles binary")
    return rows.groupBy("low", "bi", "bj").applyInArrow(_join_group, "a long, b long")


def jaccard_components(docs: DataFrame, n: int = 5, sample: int = 8000, common_least: int = 10,
                       common_most: int = 200_000, block: int = 400) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (Jaccard of the n-gram sets of 0.8 or more links)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    common = _common_shingles(rows, n, sample, common_least, common_most)
    sets = materialise(_sets(rows, n, common), "shingle-sets")
    usable = sets.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("rare").alias("rare"),
                                           F.first("hot").alias("hot"))
    bitmaps = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
                                           F.first("bitmap").alias("bitmap")).drop("digest")
    parts = _parts(_members(classes), bitmaps, block)
    edges = materialise(_edges(rows, parts, n, block), "edges")
    comps = components(edges, "a", "b")
    resolved = materialise(
        usable.groupBy("digest").agg(F.min("doc_id").alias("rep"))
        .join(comps, F.col("rep") == F.col("node"), "left")
        .select("digest", F.coalesce("component", "rep").alias("component_id")), "resolved")
    alone = sets.filter("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return usable.join(resolved, "digest").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def keep_representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those whose group has a smaller id; columns as they were."""
    dropped = (jaccard_components(docs).filter("doc_id <> component_id")
               .select(F.col("doc_id").alias("_dropped")).distinct())
    rows, names = neutral_names(docs)
    return rows.join(dropped, F.col(names["doc_id"]) == F.col("_dropped"), "left_anti").toDF(*docs.columns)


#: DuckDB SQL of ``jaccard_components`` over ``documents``.
JOIN_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM e JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), reach AS (
  SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), lowest AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM w JOIN lowest USING (doc_id) LEFT JOIN n USING (doc_id)"""
