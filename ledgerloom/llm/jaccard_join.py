"""N-gram Jaccard join: exact components of documents whose word shingles are similar enough.

Documents with equal sets are one class. Two sets that reach the similarity
share a shingle among the first ones of each (a prefix of n - ceil(t n) + 1
shingles in any fixed order), so classes meet by prefix shingles. Shingles that
are common among all documents come last in the order; which ones these are
changes the work, never the result. Sizes are cut into classes so wide that
similar sets are of the same class or of neighbours: a prefix shingle counts
only among sets of a class and those of the class below that may still reach
them, so sets of other sizes never meet.

Keys with the same least set are one key. First every member of a key is
compared with a few leaders of other components, which links large groups of
near copies with few comparisons. Keys that still hold several components go
through signature trees: their members are dealt to cells of bounded size,
every two cells of a key meet in some task, and a dual traversal gives the
pairs of different components that bitmaps and sizes do not rule out. They do
so twice. The first time a cell suggests only pairs that would join its
components, the most alike first: fewer pairs than it has members. Once these
are checked, few candidates are left between different components, and the
second time a cell suggests all of them. Keys without a suggestion have none
the second time either and are left out then. All suggested pairs are checked on
their whole sets, so no link between different texts is lost and none is made
up (sets are named by 64-bit digests of their hashed shingles).

Nothing grows into one task: keys are counted with partial sums, common keys
are joined by a join that can be split, cells have ``CELL`` rows. Documents
without words have the empty set and link with nothing; a null id is a
document like any other; rows that repeat an id are classes by their texts.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.signature_tree import FEWEST_BITS, SignatureTree, bitmap, dual_join, folded, pair_overlaps
from ledgerloom.llm.text import WordHashes, byte_words, mixed, shingle_hashes
from ledgerloom.session import cut_lineage, scratch_scope

CELL = 512  # rows of one side of a cell
COMMON = 500  # a shingle that one of so many documents has is common
FEWEST = 8  # documents with a common shingle, however small the table
COUNTED = 1 << 19  # shingles that are counted at a time
COUNTING = 16 * COMMON  # documents that a task counts at least, on average
LEADERS = 4
BINS, SLACK = 128, 12  # of the sketches that leaders are told by, and the percent by which these may be off


def token_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Distinct hashed shingles of a text in ascending order."""
    return np.unique(shingle_hashes(hashes.of(byte_words(text)), size))


def set_id(tokens: np.ndarray) -> int:
    """Digest of a set, as a signed number."""
    with np.errstate(over="ignore"):
        total = mixed(np.array([mixed(tokens + np.uint64(1)).sum(dtype=np.uint64) ^ np.uint64(len(tokens))], np.uint64))
    return int(total.view(np.int64)[0])


EDGES = (np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)).astype(np.uint64)


def sketch(tokens: np.ndarray) -> bytes:
    """One byte for each of ``BINS`` ranges of hashes: of the least token in it, 0 if there is none. Tokens ascend."""
    first = np.searchsorted(tokens, EDGES)
    last = np.append(first[1:], len(tokens))
    least = tokens[np.minimum(first, len(tokens) - 1)]
    return np.where(first < last, mixed(least) % np.uint64(255) + np.uint64(1), np.uint64(0)).astype(np.uint8).tobytes()


class SizeClasses:
    """Classes of set sizes: sets of ``percent`` similarity are of the same class or of two that follow each other."""

    def __init__(self, percent: int):
        self.percent, self.edges = percent, [1]

    def of(self, n: int) -> tuple[int, int]:
        """The class of a size, and the least size of the class above."""
        while self.edges[-1] <= n:
            self.edges.append(100 * self.edges[-1] // self.percent + 1)
        k = bisect.bisect_right(self.edges, n)
        return k, self.edges[k]

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """Prefix shingles of a set, whose tokens are in the order of prefixes, named with a class.

        The first shingle that two sets share leaves each of them tokens enough
        for their overlap: ``percent`` of its own size where no class is above
        its own, else what the least size of the class above asks for.
        """
        n = len(tokens)
        k, above = self.of(n)
        own = n - -(-self.percent * n // 100) + 1
        short = max(0, n - -(-self.percent * (n + above) // (100 + self.percent)) + 1)
        salts = mixed(np.array([k, k + 1], np.uint64))
        return np.concatenate([tokens[:own] ^ salts[0], tokens[:short] ^ salts[1]])


def _signed(tokens: np.ndarray) -> pa.Array:
    return pa.array(tokens.view(np.int64))


def profiles(docs: DataFrame, size: int, percent: int, common) -> DataFrame:
    """doc_id, n_shingles, set_id (null for the empty set), bitmap, its sketch, md5 of the text, and prefix shingles by size class of every document.

    Copies of a text seen shortly before in the same task leave the keys out.
    """

    def ordered(tokens: np.ndarray, late: np.ndarray) -> np.ndarray:
        if len(late):
            last = late[np.minimum(np.searchsorted(late, tokens), len(late) - 1)] == tokens
            tokens = np.concatenate([tokens[~last], tokens[last]])
        return tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, late, classes = WordHashes(), common.value, SizeClasses(percent)
        seen: set[int] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                counts, ids, bits, sketches, digests, keys, ends = [], [], [], [], [], [], [0]
                for text in batch.column(1):
                    text = text.as_py()
                    tokens = token_set(text, size, hashes)
                    own = set_id(tokens) if len(tokens) else None
                    digests.append(hashlib.md5((text or "").encode("utf-8", "surrogatepass")).hexdigest())
                    first = np.empty(0, np.uint64)
                    if own is not None and own not in seen:
                        if len(seen) >= 1 << 17:
                            seen.clear()
                        seen.add(own)
                        first = classes.keys(ordered(tokens, late))
                    counts.append(len(tokens))
                    ids.append(own)
                    whole_bits = bitmap(tokens) if len(tokens) else None
                    bits.append(whole_bits)
                    sketches.append(sketch(tokens) if len(tokens) else None)
                    keys.append(first)
                    ends.append(ends[-1] + len(first))
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(np.concatenate(keys)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.int64()), pa.array(bits, pa.binary()), pa.array(sketches, pa.binary()), pa.array(digests), listed],
                    names=["doc_id", "n_shingles", "set_id", "bitmap", "sketch", "digest", "keys"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, set_id bigint, bitmap binary, sketch binary, digest string, keys array<bigint>")


class FrequentShingles:
    """Lossy counts over all sets given: what more than 1 / (2 COMMON) of the sets have is held, and never counted too high."""

    def __init__(self):
        self.waiting, self.size, self.sets, self.before = [], 0, 0, 0
        self.tokens, self.counts, self.missed = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, tokens: np.ndarray) -> None:
        """Distinct shingles of one more set."""
        self.waiting.append(tokens)
        self.size += len(tokens)
        self.sets += 1
        if self.size >= COUNTED:
            self.settle()

    def settle(self) -> None:
        """Count what waits. A shingle that is left out had 1 / (2 COMMON) of the sets so far at most: ``missed`` of one that comes again."""
        fresh, counts = np.unique(np.concatenate(self.waiting or [self.tokens[:0]]), return_counts=True)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, fresh), len(self.tokens) - 1)
            held = self.tokens[at] == fresh
            self.counts[at[held]] += counts[held]
            fresh, counts = fresh[~held], counts[~held]
        tokens = np.concatenate([self.tokens, fresh])
        counts = np.concatenate([self.counts, counts])
        missed = np.concatenate([self.missed, np.full(len(fresh), self.before // (2 * COMMON))])
        stays = np.flatnonzero(counts + missed > self.sets // (2 * COMMON))
        stays = stays[np.argsort(tokens[stays])]
        self.tokens, self.counts, self.missed = tokens[stays], counts[stays], missed[stays]
        self.waiting, self.size, self.before = [], 0, self.sets


def shingle_counts(docs: DataFrame, size: int, n_docs: int) -> DataFrame:
    """token and n: lossy counts of every task. All documents are counted.

    A task leaves out what 1 / (2 COMMON) of its documents or fewer have. One
    of less than 2 COMMON documents could leave nothing out, so small
    partitions are counted together, ``COUNTING`` documents a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, found = WordHashes(), FrequentShingles()
        for batch in batches:
            for text in batch.column(0):
                found.add(token_set(text.as_py(), size, hashes))
        found.settle()
        yield pa.record_batch([_signed(found.tokens), pa.array(found.counts)], names=["token", "n"])

    return docs.select("text").coalesce(max(1, n_docs // COUNTING)).mapInArrow(run, "token bigint, n bigint")


def common_shingles(docs: DataFrame, size: int, n_docs: int) -> np.ndarray:
    """All shingles that 1 / COMMON of the documents have (FEWEST at least), and none that fewer than half as many have.

    All tasks together miss n_docs / (2 COMMON) of a shingle at most. What
    comes to the driver is 2 COMMON times the shingles of an average text at
    most.
    """
    counts = shingle_counts(docs, size, n_docs).groupBy("token").agg(F.sum("n").alias("n"))
    least = max(FEWEST, -(-n_docs // COMMON)) - n_docs // (2 * COMMON)
    rows = counts.where(F.col("n") >= least).select("token").toPandas()
    return np.sort(rows["token"].to_numpy(np.int64).view(np.uint64))


def _members(profile: DataFrame, **kept) -> DataFrame:
    """(key, set_id) of the sets that share a shingle of a class with another one.

    Keys whose least set is the same are one: near copies share many shingles,
    and so meet once instead of once for each of them. The shingles are dealt
    once, for the least sets and for the join with them.
    """
    keys = profile.select(F.explode("keys").alias("shingle"), "set_id").where("shingle is not null").repartition("shingle")
    several = keys.groupBy("shingle").agg(F.min("set_id").alias("key"), F.max("set_id").alias("other")).where("key <> other").select("shingle", "key")
    return cut_lineage(keys.join(several, "shingle").select("key", "set_id").distinct(), **kept)


def _may_link(m: np.ndarray, n: np.ndarray, left: list[bytes], right: list[bytes], percent: int) -> np.ndarray:
    """Which pairs of sets their sizes and whole bitmaps do not rule out; the longer bitmap is folded to the shorter."""
    widths = np.minimum([len(x) for x in left], [len(y) for y in right])
    fits = np.zeros(len(m), bool)
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        for rows in np.array_split(at, len(at) * width // (1 << 24) + 1):
            x, y = folded([left[i] for i in rows], width), folded([right[i] for i in rows], width)
            fits[rows] = (100 + percent) * pair_overlaps(m[rows], n[rows], x, y) >= percent * (m[rows] + n[rows])
    return fits


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes fit and whose sketches look alike; what is left out here, the trees find."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in (2, 3))
            both, either = ((x == y) & (x > 0)).sum(axis=1), ((x > 0) | (y > 0)).sum(axis=1)
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(100 * both >= (percent - SLACK) * either))

    sides = [classes.select(F.col("set_id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab"]
    sized = pairs.join(sides[0], "a").join(sides[1], "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return sized.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a bigint, b bigint")


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, sets: DataFrame | None, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Those of the distinct pairs that are similar, by the whole sets, and the sets read so far.

    Only the texts that pairs name are read into sets, each once.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for own, text in zip(batch.column(0), batch.column(1)):
                tokens = token_set(text.as_py(), size, hashes)
                if len(tokens) and set_id(tokens) == own.as_py():  # another row may have the same doc_id
                    yield pa.record_batch([pa.array([own.as_py()]), pa.array([tokens.tobytes()], pa.binary())], names=["set_id", "tokens"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                fits.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(fits, pa.bool_()))

    named = pairs.select(F.col("a").alias("set_id")).union(pairs.select(F.col("b").alias("set_id"))).distinct()
    if sets is not None:
        named = named.join(sets.select("set_id"), "set_id", "left_anti")
    wanted = cut_lineage(classes.join(named, "set_id").select("set_id", F.col("doc_id").alias("of")))  # a few ids are broadcast, by their size
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("of")))
    more = cut_lineage(texts.select("set_id", "text").mapInArrow(read, "set_id bigint, tokens binary").dropDuplicates(["set_id"]))
    sets = more if sets is None else sets.union(more)
    sides = [sets.select(F.col("set_id").alias(c), F.col("tokens").alias(f"tokens_{c}")).join(pairs.select(c), c, "left_semi") for c in "ab"]
    links = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "tokens_a", "tokens_b").mapInArrow(check, "u bigint, v bigint")
    return cut_lineage(links), sets


def _leader_pairs(members: DataFrame) -> DataFrame:
    """Each member of a key with the key's leaders (the least by hash) of other components."""
    least = [F.min_by(F.struct("set_id", "component"), F.xxhash64("set_id", F.lit(salt))) for salt in range(LEADERS)]
    leaders = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.array(*least).alias("leaders")).where("low <> high")
    led = members.join(leaders.select("key", "leaders"), "key").select("set_id", "component", F.explode("leaders").alias("l")).where("component <> l.component")
    return led.select(F.least("set_id", "l.set_id").alias("a"), F.greatest("set_id", "l.set_id").alias("b")).distinct()


def _tree_pairs(members: DataFrame, classes: DataFrame, percent: int, forest: bool) -> DataFrame:
    """key, a and b: pairs of different components that share a key, by signature trees over cells of each key's members.

    ``members`` has key, set_id and component. A key with m cells' worth of
    members has m (m + 1) / 2 pairs of cells, each a group of its own. With
    ``forest`` a cell gives only pairs that would join its components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            cells = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
            starts = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]).any(axis=1)]) if len(cells) else np.array([0])
            for low, high in zip(starts[:-1], starts[1:]):
                yield from _cell_pairs(table.slice(low, high - low), percent, forest)
            rest = table.slice(starts[-1])  # the last cell may go on in the next batch
        if rest is not None and rest.num_rows:
            yield from _cell_pairs(rest, percent, forest)

    cells = members.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    cells = cells.select("key", F.ceil(F.col("n") / CELL).cast("int").alias("m"))
    dealt = members.join(cells, "key").withColumn("own", F.pmod(F.xxhash64("set_id"), F.col("m")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "set_id", "component")
    sized = dealt.join(classes.select("set_id", "n_shingles", "bitmap"), "set_id").select("key", "i", "j", "own", "set_id", "component", "n_shingles", "bitmap")
    return sized.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "key bigint, a bigint, b bigint")


def _joining(p: np.ndarray, q: np.ndarray, alike: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Places of the pairs that join two groups not yet joined by a pair that is more alike."""
    names, label = np.unique(groups, return_inverse=True)
    parent, left = list(range(len(names))), len(names) - 1

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    taken = []
    order = np.argsort(-alike, kind="stable")
    for at, a, b in zip(order.tolist(), label[p[order]].tolist(), label[q[order]].tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[a] = b
            taken.append(at)
            left -= 1
            if not left:
                break
    return np.array(taken, np.int64)


def _cell_pairs(cell: pa.Table, percent: int, forest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs within one cell (i = j), or between its two sides."""
    cell = cell.combine_chunks()
    own, ids, groups, sizes = (cell.column(c).to_numpy() for c in ("own", "set_id", "component", "n_shingles"))
    whole = cell.column("bitmap").to_pylist()
    bits = folded(whole, FEWEST_BITS // 8)
    if cell.column("i")[0].as_py() == cell.column("j")[0].as_py():
        sides = [np.arange(len(ids))] * 2
    else:
        low = own.min()
        sides = [np.flatnonzero(own == low), np.flatnonzero(own != low)]
    if not (len(sides[0]) and len(sides[1])) or len(ids) < 2:
        return
    left = SignatureTree(sizes[sides[0]], bits[sides[0]], groups[sides[0]])
    right = left if sides[0] is sides[1] else SignatureTree(sizes[sides[1]], bits[sides[1]], groups[sides[1]])
    found = []
    for p, q in dual_join(left, right, percent):
        p, q = sides[0][p], sides[1][q]
        fits = _may_link(sizes[p], sizes[q], [whole[i] for i in p], [whole[i] for i in q], percent)
        found.append((p[fits], q[fits]))
    p, q = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    if forest and len(p):
        overlap = pair_overlaps(sizes[p], sizes[q], bits[p], bits[q])
        some = _joining(p, q, overlap / (sizes[p] + sizes[q] - overlap), groups)
        p, q = p[some], q[some]
    if len(p):
        a, b = ids[p], ids[q]
        key = cell.column("key")[0].as_py()
        yield pa.record_batch([pa.array(np.full(len(a), key)), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["key", "a", "b"])


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every document.

    ``digest`` (md5 of the text) and ``component`` tell rows and components apart where ids repeat; the empty set has no component.
    """
    with scratch_scope(docs.sparkSession):
        return cut_lineage(_components(docs.select("doc_id", "text"), size, percent), outlive=True)


def _components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(docs, size, docs.count()))
    with scratch_scope(spark):  # the prefix shingles are on disk until the members are
        keyed = cut_lineage(profiles(docs, size, percent, common))
        first = [F.first(c).alias(c) for c in ("n_shingles", "bitmap", "sketch")]
        classes = cut_lineage(keyed.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), *first), outlive=True)
        profile = cut_lineage(keyed.select("doc_id", "n_shingles", "set_id", "digest"), outlive=True)
        members = _members(keyed, outlive=True)

    links, sets = None, None
    known = spark.createDataFrame([], "node bigint, component bigint")
    for turn in ("leaders", "forest", "all"):
        grouped = members.join(known.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
        if turn == "leaders":
            pairs = _likely(_leader_pairs(grouped), classes, percent)
        else:
            suggested = _tree_pairs(grouped, classes, percent, turn == "forest")
            if turn == "forest":
                suggested = cut_lineage(suggested)
                members = members.join(suggested.select("key").distinct(), "key", "left_semi")
            pairs = suggested.select("a", "b").distinct()
        pairs = cut_lineage(pairs)
        if not pairs.isEmpty():
            found, sets = _linked(pairs, docs, classes, sets, size, percent)
            links = found if links is None else links.union(found)
            known = components(links)

    least = known.join(classes.select(F.col("set_id").alias("node"), "doc_id"), "node")
    least = least.join(least.groupBy("component").agg(F.min("doc_id").alias("component_id")), "component").select(F.col("node").alias("set_id"), "component_id", "component")
    named = classes.select("set_id", F.col("doc_id").alias("own")).join(least, "set_id", "left").select("set_id", F.coalesce("component_id", "own").alias("component_id"), F.coalesce("component", "set_id").alias("component"))
    return profile.join(named, "set_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "digest", "component")
