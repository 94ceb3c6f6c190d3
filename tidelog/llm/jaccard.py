"""N-gram Jaccard join (operator 10): an exact similarity join in the metric space of shingle sets.

Jaccard distance is a metric on sets, and r = 1 - threshold is the join radius. Documents with equal sets are
one point. The join goes region by region:

* The first pivots are the single shingles. All of a document's own shingles are its nearest pivots, at equal
  distance; ties go to the rarer one. Dropping the i first shingles of a set A leaves a set at distance
  i / |A|, so a set that has none of them is at least that far from A: a document's window reaches over its
  floor(r |A|) + 1 first regions, and two points within r share a region. (Pivots taken from the documents
  would not do here: unrelated texts are all at distance near 1 from every document, so every window would
  hold everything; the README has the figures.) Rarity is counted over all documents, each distinct set of a
  chunk once, in packed runs of shortened hashes; it sets the order only, and any order is exact.
* Within a region, points of sizes that cannot be within r of any neighbour in size leave.
* A region is then joined recursively with pivots taken from its points: first the most central one (with the
  fewest rarer shingles before the region's own), later ever more of them, found by aggregation. Distances to
  the pivots are exact. A point within r of a pivot is linked to its nearest pivot (its Voronoi region). Links of
  such a point x to others reach only points y with r < d(y, p) <= 2 r and d(x, p) >= d(y, p) - r, by the
  triangle inequality: such border points y are replicated into the pivot's region and compared there with
  such x, unless both are in one class already. Points beyond r of all pivots are joined again among
  themselves. Pivots leave, so this ends. Two points within r of one pivot need no comparison: they are in
  one class through it. A large group of near copies costs about one comparison each.

No group is gathered, and no pairs within a group are made but those with its pivots and over its borders. What decides is exact
intersection sizes of whole sets of 64-bit shingle hashes.

Defined cases. Null and empty texts, or texts with no words: the empty set, linked with nothing, their own
class. Fewer than k words: the whole sequence is the only shingle. Repeated rows and equal sets: one class.
Rows with a null id: take part, but never name a class unless all its ids are null. Empty table: no rows.
Further columns are ignored. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import arrays, substrings
from tidelog.llm.components import components
from tidelog.llm.scratch import Scratch

MOST_TIMES = (1 << 16) - 1  # so far rarity is counted; it sets an order only, and any order is exact
PIVOTS, MOST_PIVOTS = 8, 512  # pivots of a region: one in the first round, PIVOTS in the second, then twice as many each round
_SHORT, _SET = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
PACKS = "part int, chunk int, hashes binary, many binary"
MEMBERS = "region long, node long, n int, pos int"
POINTS = "doc_id long, node long, n int, near array<long>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of the distinct shingles of each text, ascending."""
    starts, ends, doc = arrays.runs(~arrays.SPACE[data], offsets)
    words = arrays.hash_runs(arrays.LOWER[data], starts, ends)
    inside = arrays.whole(doc, k)
    of, h = doc[: len(inside)][inside], arrays.windows(words, k)[inside]
    n_words = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(n_words)])
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):  # at most k - 1 words each
        own = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = n_words[short] > j
            own[has] = own[has] * arrays.BASE + words[first[short[has]] + j]
        of, h = np.concatenate([of, short]), np.concatenate([h, arrays.mix(own ^ (_SHORT + n_words[short].astype(np.uint64)))])
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return of[new], h[new]


def _nodes(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A 64-bit signature of each set, whose hashes follow one another; 0 for the empty set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(arrays.mix(h ^ _SET), dtype=np.uint64)])
    at = np.concatenate([[0], np.cumsum(n)])
    out = arrays.mix(sums[at[1:]] - sums[at[:-1]] + n.astype(np.uint64))
    return np.where(n > 0, out, np.uint64(0))


def _chunk_sets(table: pa.Table, k: int) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Ids, the number of shingles and all shingles of a chunk's texts, text by text."""
    ids, texts = substrings.unpacked(table)
    sizes, found = [], []
    for first, end, data, offsets in arrays.slices(pa.array(texts, pa.binary()).cast(pa.large_binary()).cast(pa.large_string())):
        of, h = shingle_sets(data, offsets, k)
        sizes.append(np.bincount(of, minlength=end - first))
        found.append(h)
    return ids, np.concatenate(sizes), np.concatenate(found)


def points(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """POINTS: doc_id, node, n and the first regions (the window of its nearest pivots, rarest first) of every document."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number
    chunks, bits = max(8, -(-size // substrings.CHUNK_BYTES)), substrings.range_bits(size // 6)
    cut = np.uint64(64 - min(64, max(32, int(size // 6).bit_length() + 8)))  # shortened: hardly any two shingles meet

    def sent(key: tuple, table: pa.Table) -> pa.Table:
        _, n, h = _chunk_sets(table, k)
        _, first = np.unique(_nodes(h, n), return_index=True)
        once = np.zeros(len(n), bool)
        once[first] = True
        keys, times = np.unique(h[np.repeat(once, n)] >> cut, return_counts=True)
        rows = list(zip(*(x.tolist() for x in substrings.ranges_of(keys, 64 - int(cut) - bits)), strict=True))
        times = np.minimum(times, MOST_TIMES).astype(np.uint16)
        return pa.table(
            {
                "part": pa.array([i for i, _, _ in rows], pa.int32()),
                "chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "hashes": pa.array([substrings.deltas(keys[a:b]) for _, a, b in rows], pa.binary()),
                "many": pa.array([zstandard.compress(times[a:b].tobytes(), 1) for _, a, b in rows], pa.binary()),
            }
        )

    def send(key: tuple, table: pa.Table) -> pa.Table:
        out = sent(key, table)
        arrays.give_back()
        return out

    def add(key: tuple, table: pa.Table) -> pa.Table:
        lists = [substrings.undeltas(x) for x in table["hashes"].to_pylist()]
        times = np.concatenate([np.frombuffer(zstandard.decompress(x), np.uint16) for x in table["many"].to_pylist()])
        _, place = np.unique(np.concatenate(lists), return_inverse=True)
        total = np.minimum(np.bincount(place, weights=times)[place], MOST_TIMES).astype(np.uint16)
        ends = np.cumsum([len(x) for x in lists])
        levels = [zstandard.compress(x.tobytes(), 1) for x in np.split(total, ends[:-1])]
        return pa.table({"chunk": table["chunk"], "part": pa.array([key[0].as_py()] * len(lists), pa.int32()), "bits": pa.array(levels, pa.binary())})

    def placed(table: pa.Table, told: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("near", pa.list_(pa.int64()))])
        if not len(table):
            return schema.empty_table()
        ids, n, h = _chunk_sets(table, k)
        keys, where = np.unique(h >> cut, return_inverse=True)
        where_of = {p: (a, b) for p, a, b in zip(*(x.tolist() for x in substrings.ranges_of(keys, 64 - int(cut) - bits)), strict=True)}
        level = np.zeros(len(keys), np.uint16)
        for part, packed in zip(told["part"].to_pylist(), told["bits"].to_pylist(), strict=True):
            a, b = where_of[part]
            level[a:b] = np.frombuffer(zstandard.decompress(packed), np.uint16)
        of = np.repeat(np.arange(len(n)), n)
        order = np.lexsort(((level[where].astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)), of)) if len(h) else np.zeros(0, int)
        rank = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
        window = np.where(n > 0, n * (100 - percent) // 100 + 1, 0)
        near = h[order][rank < np.repeat(window, n)]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(window)]), pa.int32()), pa.array(arrays.signed(near), pa.int64()))
        return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(arrays.signed(_nodes(h, n))), pa.array(n, pa.int32()), lists], schema=schema)

    def place(_: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        out = placed(table, told)
        arrays.give_back()
        return out

    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    packed = dealt.mapInArrow(substrings.pack, substrings.PACKED)
    told = packed.groupBy("chunk").applyInArrow(send, PACKS).groupBy("part").applyInArrow(add, substrings.BITS)
    return packed.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(place, POINTS)


def crowded(members: DataFrame, percent: int) -> DataFrame:
    """Members with a neighbour that their sizes let be within the radius; regions are split where sizes leave a gap.

    Members pass in order of region and size; only the last of a batch is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["region", "node", "n", "pos"]
        tail = [pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())], names)]
        held = last = None  # the last row; whether it goes on with a run of its left neighbour, and the run's key
        for batch in _then(batches, tail):
            final = batch is tail[0]
            row = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            if held is not None:
                row = [np.concatenate([x, y]) for x, y in zip(held, row, strict=True)]
            region, node, n, pos = row
            if not len(region):
                continue
            close = (region[1:] == region[:-1]) & (100 * n[:-1].astype(np.int64) >= percent * n[1:].astype(np.int64))
            left = np.concatenate([[last[0] if last else False], close])
            right = np.concatenate([close, [False]])
            begin = np.maximum.accumulate(np.where(left, 0, np.arange(len(region))))
            run_key = arrays.signed(arrays.mix(region.view(np.uint64) + arrays.BASE * n[begin].astype(np.uint64)))
            if last and last[0]:  # the held row's run began before this batch
                run_key[begin == 0] = last[1]
            upto = len(region) if final else len(region) - 1
            keep = (left | right)[:upto]
            yield pa.RecordBatch.from_arrays([pa.array(x[:upto][keep]) for x in (run_key, node, n, pos)], names)
            held, last = [x[-1:] for x in row], (bool(left[-1]), int(run_key[-1]))

    return members.repartition("region").sortWithinPartitions("region", "n", "node").mapInArrow(run, MEMBERS)


def _then(batches: Iterator[pa.RecordBatch], tail: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from batches
    yield from tail


def whole_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """node and its sorted hashes (as bytes) for the wanted (doc_id, node), from one shuffle of compressed texts."""

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([z.compress(x.as_buffer()) if x.is_valid else b"" for x in texts], pa.binary())], ["doc_id", "packed"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        un = zstandard.ZstdDecompressor()
        for batch in batches:
            node = batch.column("node").to_numpy(zero_copy_only=False)
            texts = pa.array([un.decompress(x) if x else b"" for x in batch.column("packed").to_pylist()], pa.large_binary()).cast(pa.large_string())
            for first, end, data, offsets in arrays.slices(texts):
                of, h = shingle_sets(data, offsets, k)
                n = np.bincount(of, minlength=end - first)
                same = np.flatnonzero(arrays.signed(_nodes(h, n)) == node[first:end])  # not another text with the same id
                at = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays([pa.array(node[first:end][same]), pa.array([h[at[i] : at[i + 1]].tobytes() for i in same], pa.binary())], ["node", "hashes"])

    packed = docs.where("text is not null").mapInArrow(press, "doc_id long, packed binary")
    asked = wanted.select(F.col("doc_id").alias("asked"), "node")
    found = packed.join(asked, F.col("doc_id").eqNullSafe(F.col("asked"))).select("node", "packed")
    return found.mapInArrow(make, "node long, hashes binary").dropDuplicates(["node"])


def distances(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, d (Jaccard distance) and linked for distinct pairs (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, linked = [], []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                p, q = (p, q) if len(p) <= len(q) else (q, p)
                at = np.searchsorted(q, p)
                both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                either = len(p) + len(q) - both
                d.append(1 - both / either)
                linked.append(100 * both >= percent * either)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(d, pa.float64()), pa.array(linked, pa.bool_())], ["a", "b", "d", "linked"])

    with_x = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    with_y = with_x.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    return with_y.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, d double, linked boolean")


def _possible(percent: int, n: str, pos: str, m: str, at: str) -> Column:
    """Whether two members of a region can be within the radius: by sizes, and if the region's shingle is the first that both have.

    A linked pair shares the region of its first common shingle, and passes there.
    """
    n, pos, m, at = (F.col(x) for x in (n, pos, m, at))
    least = F.ceil(F.lit(percent) * (n + m) / (100 + percent))  # of the intersection
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.least(n - pos, m - at) >= least)


def _joinable(members: DataFrame, percent: int) -> DataFrame:
    """Members of regions that hold a possible pair.

    Of a linked pair the smaller set has its first common shingle early, among the first n - 2 t n / (1 + t): the
    intersection is at least t (n + m) / (1 + t). Members that are so placed may be pivots; regions without any are done.
    """
    return members.join(members.where(_may_lead(percent)).select("region").distinct(), "region", "left_semi")


def _may_lead(percent: int) -> Column:
    return F.col("n") - F.col("pos") >= F.ceil(F.lit(2 * percent) * F.col("n") / (100 + percent))


def links(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame | None:
    """Links (a, b) that join every class, by recursive pivot regions over MEMBERS rows."""
    radius, slack = 1 - percent / 100, 1e-9
    found: list[DataFrame] = []
    active, turn = members, 0

    def measured(pairs: DataFrame) -> DataFrame:
        known = scratch.save(distances(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), sets, percent), "distances")
        found.append(known.where("linked").select("a", "b"))
        return known

    while not active.isEmpty():
        split = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(min(PIVOTS << (turn - 1), MOST_PIVOTS) if turn else 1))
        pivots = active.where(_may_lead(percent)).groupBy("region", split.alias("salt")).agg(F.min(F.struct("pos", "node", "n")).alias("p")).select("region", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.pos").alias("pivot_pos"))
        near = active.join(pivots, "region")
        known = measured(near.where((F.col("node") != F.col("pivot")) & _possible(percent, "n", "pos", "pivot_n", "pivot_pos")).select(F.col("node").alias("x"), F.col("pivot").alias("y")))
        bound = F.lit(1.0) - F.least("n", "pivot_n") / F.greatest("n", "pivot_n")  # a lower bound of the distance where it was not measured
        own = F.col("node") == F.col("pivot")
        told = near.withColumn("a", F.least("node", "pivot")).withColumn("b", F.greatest("node", "pivot")).join(known, ["a", "b"], "left")
        told = told.select("region", "node", "n", "pos", "pivot", F.when(own, 0.0).otherwise(F.coalesce("d", bound)).alias("d"), (own | F.coalesce("linked", F.lit(False))).alias("linked"))
        told = scratch.save(told, "regions")
        state = told.groupBy("region", "node").agg(F.max(own).alias("is_pivot"), F.max("linked").alias("linked"), F.min_by("pivot", F.struct(~F.col("linked"), "d", "pivot")).alias("owner"), F.min("n").alias("n"), F.min("pos").alias("pos"))
        # over the borders of each pivot's Voronoi region
        border = told.where(~F.col("linked") & (F.col("d") <= 2 * radius + slack)).select("region", "pivot", F.col("node").alias("y"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("d").alias("far"))
        inner = told.where("linked and node <> pivot").join(state.where("linked and not is_pivot").select("region", "node", F.col("owner").alias("pivot")), ["region", "node", "pivot"], "left_semi")
        inner = inner.select("region", "pivot", F.col("node").alias("x"), "n", "pos", "d")
        inner = inner.join(border.select("region", "pivot").distinct(), ["region", "pivot"], "left_semi")
        classes = components(_union(found), scratch)
        cross = inner.join(border, ["region", "pivot"]).where((F.col("d") >= F.col("far") - radius - slack) & _possible(percent, "n", "pos", "m", "at")).select("x", "y").distinct()
        for side in ("x", "y"):
            cross = cross.join(classes.select(F.col("node").alias(side), F.col("component").alias(f"{side}_class")), side, "left")
        measured(cross.where(F.coalesce("x_class", "x") != F.coalesce("y_class", "y")))
        after = scratch.save(_joinable(crowded(state.where("not is_pivot and not linked").select("region", "node", "n", "pos"), percent), percent), "members")
        scratch.drop(active, told, classes)
        active, turn = after, turn + 1
    return _union(found) if found else None


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for x in tables[1:]:
        out = out.unionByName(x)
    return out


def join(docs: DataFrame, k: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, node (the set's signature), n_shingles, component_id for every row of docs."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = scratch.save(points(rows, k, percent), "points")
    scratch.release()
    nodes = table.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("near").alias("near"))
    members = scratch.save(crowded(nodes.select("node", "n", F.posexplode("near").alias("pos", "region")), percent), "members")
    joinable = scratch.save(_joinable(members, percent), "members")
    scratch.drop(members)
    members = joinable
    named = table.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    wanted = named.join(members.select("node").distinct(), "node", "left_semi")
    sets = scratch.save(whole_sets(rows, wanted, k), "sets")
    scratch.release()
    found = links(members, sets, percent, scratch)
    scratch.drop(sets)
    out = table.select("doc_id", "node", F.col("n").cast("long").alias("n_shingles")).join(named.select("node", F.col("doc_id").alias("first")), "node", "left")
    if found is None:
        return out.select("doc_id", "node", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("first")).alias("component_id"))
    classes = components(found, scratch)
    least = classes.join(named, "node").groupBy("component").agg(F.min("doc_id").alias("least"))
    label = scratch.save(classes.join(least, "component").select("node", "least"), "classes")
    return out.join(label, "node", "left").select("doc_id", "node", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("least", "first")).alias("component_id"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM words)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), linked AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * shared >= 90 * (s.n + t.n - shared)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reached.doc_id, b FROM reached JOIN linked ON other = a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(other) FROM reached r WHERE r.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
"""
