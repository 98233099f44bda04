"""Similarity join of documents as sets of word shingles under the Jaccard distance.

Two documents link at a distance of at most 0.2. Equal sets are one member. The join
narrows regions of the metric space down in three steps, each of which loses no link.

1. *Shingles as pivots.* The one-shingle set {s} is at distance 1 - 1/n from a document
   of n shingles that holds s and at 1 from others, so a document's cell is that of any
   of its own shingles; the rarest comes first. A linked document shares all but a fifth
   of them, so its cell is among the first n // 5 + 1: that window is the replication.
   Documents whose window holds only shingles of their own have no neighbour. Document
   pivots alone could not begin here: unrelated documents are all at distance 1.
2. *Regions.* Documents that share a cell, directly or by others, form a region.
3. *Document pivots.* Inside a region distances to pivot documents are computed. Members
   near a pivot link to it. The others fall into the Voronoi cell of their nearest pivot,
   and by the triangle inequality a link to a member of another cell is only possible
   within a window of twice the radius, so such members are replicated there. Cells are
   joined in the same way. Members that are connected already are not compared.

Shared shingles are all that an intersection needs, so the third step never reads texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from quillmill.durable import durable
from quillmill.operators.limits import tie_break
from quillmill.llm.components import components
from quillmill.llm.memory import give_back, giving_back
from quillmill.llm.shingles import shingle_set

PIVOTS = 4
LEAF = 16
#: Documents and shingles of a region that one task joins; larger ones are cut into blocks.
REGION_DOCUMENTS = 4_096
REGION_SHINGLES = 2_000_000
#: Shingles sorted together by one task when rarity is found out.
BUCKET_SHINGLES = 2_000_000
KEY_BITS = 48
#: Very common shingles, put last without counting: at most so many, and one of so many documents.
COMMON = 50_000
COMMON_SHARE = 1_000
ROWS = 2_000


def linked(common, n, m):
    """100 * intersection >= 80 * union, in whole numbers."""
    return 100 * common >= 80 * (n + m - common)


def set_id(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes()) >> 1


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part.column(0).to_pylist(), [shingle_set(t) for t in part.column(1).to_pylist()]


@giving_back
def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, number of shingles and set id of each document; shingles common in a batch."""
    for ids, sets in _batches(batches):
        if not ids:
            continue
        sids = [set_id(s) for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sids, pa.int64()), pa.nulls(len(ids), pa.int64())], ["id", "n", "sid", "common"])
        distinct = list({k: s for k, s in zip(sids, sets)}.values())
        keys, counts = np.unique(np.concatenate(distinct), return_counts=True)
        often = counts >= max(8, len(distinct) // 100)
        if often.any():
            nulls = pa.nulls(int(often.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays([nulls, pa.array(counts[often]), nulls, pa.array(keys[often].view(np.int64))], ["id", "n", "sid", "common"])


def _pack(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, KEY_BITS // 8)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, : KEY_BITS // 8] = raw
    return wide.view("<u8").reshape(-1)


DEALT = "bucket int, header boolean, sids binary, counts binary, keys binary"
NAMES = ["bucket", "header", "sids", "counts", "keys"]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], NAMES)


def _deal_shingles(bits: int, common):
    """Shingles of a batch by bucket, each run under its set id; headers with sizes."""

    key_bits = min(KEY_BITS, 64 - bits)
    shift = 64 - bits - key_bits

    @giving_back
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _batches(batches):
            distinct = {set_id(s): s for s in sets if len(s)}
            if not distinct:
                continue
            sids, sizes = np.array(list(distinct), np.uint64), np.array([len(s) for s in distinct.values()])
            keys = np.concatenate(list(distinct.values()))
            owner = np.repeat(np.arange(len(sids)), sizes)
            hot = np.isin(keys, common.value)
            hots = np.bincount(owner[hot], minlength=len(sids))
            yield _rows([(int(sids[0]) % (1 << bits), True, sids.tobytes(), np.stack([sizes, hots], 1).astype("<u4").tobytes(), (keys[hot] >> np.uint64(shift)).tobytes())])
            keys, owner = keys[~hot] >> np.uint64(shift), owner[~hot]
            bucket = (keys >> np.uint64(key_bits)).astype(np.uint16 if bits <= 16 else np.uint32)
            order = np.argsort(bucket, kind="stable")
            keys, owner, bucket = keys[order], owner[order], bucket[order]
            edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
            rows = []
            for lo, hi in zip(edges, edges[1:]):
                if hi > lo:
                    own, runs = np.unique(owner[lo:hi], return_counts=True)
                    rows.append((int(bucket[lo]), False, sids[own].tobytes(), runs.astype("<u4").tobytes(), _pack(keys[lo:hi] & np.uint64((1 << key_bits) - 1))))
            yield _rows(rows)

    return deal


def _shared_shingles(bits: int):
    """Of a bucket, the shingles of several sets with their counts, by side of the set id."""

    sides, key_bits = 1 << bits, min(KEY_BITS, 64 - bits)

    def share(table: pa.Table) -> pa.Table:
        give_back()  # what dealing, or another bucket, has freed
        out, sids, counts, keys, base = [], [], [], [], 0
        for row in table.to_pylist():
            if row["header"]:
                ids = np.frombuffer(row["sids"], "<u8")
                sizes = np.frombuffer(row["counts"], "<u4").reshape(-1, 2)
                ends = np.cumsum(sizes[:, 1])
                side, hots = ids % np.uint64(sides), np.frombuffer(row["keys"], "<u8")
                at = np.repeat(side, sizes[:, 1])
                for k in np.unique(side).tolist():
                    out.append((k, True, ids[side == k].tobytes(), sizes[side == k].tobytes(), hots[at == k].tobytes() if len(ends) else b""))
            else:
                base = row["bucket"]
                runs = np.frombuffer(row["counts"], "<u4")
                sids.append(np.repeat(np.frombuffer(row["sids"], "<u8"), runs))
                keys.append(_unpack(row["keys"]))
        if keys:
            key, sid = np.concatenate(keys), np.concatenate(sids)
            order = np.argsort(key, kind="stable")
            key, sid = key[order], sid[order]
            again = key[1:] == key[:-1]
            several = np.concatenate((again, [False])) | np.concatenate(([False], again))
            key, sid = key[several], sid[several]
            order = np.lexsort((sid, key))
            key, sid = key[order], sid[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])))[: len(key)]
            key, sid = key[new], sid[new]
            _, place, df = np.unique(key, return_inverse=True, return_counts=True)
            df = df[place]
            key, sid, df = key[df > 1] | np.uint64(base << key_bits), sid[df > 1], df[df > 1]
            side = sid % np.uint64(sides)
            order = np.lexsort((sid, side))
            key, sid, df, side = key[order], sid[order], df[order], side[order]
            edges = [0, *(np.flatnonzero(np.diff(side)) + 1).tolist(), len(side)]
            for lo, hi in zip(edges, edges[1:]):
                if hi > lo:
                    own, runs = np.unique(sid[lo:hi], return_counts=True)
                    out.append((int(side[lo]), False, own.tobytes(), runs.astype("<u4").tobytes(), np.stack([key[lo:hi], df[lo:hi].astype("<u8")], 1).tobytes()))
        return pa.Table.from_batches([_rows(out)])

    return share


def window_length(n):
    """How many of n shingles a linked document may lack, and one more."""
    return n - (4 * n + 4) // 5 + 1


def _windows(table: pa.Table) -> pa.Table:
    """Sets whose window reaches a shared shingle, with all their shared shingles."""
    give_back()
    sizes: dict[int, tuple[int, np.ndarray]] = {}
    sids, parts = [], []
    for row in table.to_pylist():
        ids, counts = np.frombuffer(row["sids"], "<u8"), np.frombuffer(row["counts"], "<u4")
        if row["header"]:
            counts = counts.reshape(-1, 2)
            hots = np.split(np.frombuffer(row["keys"], "<u8"), np.cumsum(counts[:, 1])[:-1])
            sizes.update(zip(ids.tolist(), zip(counts[:, 0].tolist(), hots)))
        else:
            sids.append(np.repeat(ids, counts))
            parts.append(np.frombuffer(row["keys"], "<u8").reshape(-1, 2))
    sid = np.concatenate(sids) if sids else np.zeros(0, np.uint64)
    part = np.concatenate(parts) if parts else np.zeros((0, 2), np.uint64)
    order = np.lexsort((part[:, 0], part[:, 1], sid))  # rarest first
    sid, key = sid[order], part[order, 0]
    own, first, count = np.unique(sid, return_index=True, return_counts=True)
    shared = dict(zip(own.tolist(), zip(first.tolist(), count.tolist())))
    found = []
    for one, (n, hot) in sizes.items():
        start, m = shared.get(one, (0, 0))
        reach = window_length(n) - (n - m - len(hot))
        if reach > 0 and m + len(hot):
            keys = np.concatenate((key[start : start + m], np.sort(hot)))
            found.append((one, n, np.sort(keys).tobytes(), keys[:reach].view(np.int64).tolist()))
    types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
    return pa.table([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 4, types)], names=["sid", "n", "keys", "cells"])


class Region:
    """Members with their shared shingles, numbered so that a whole row of the distance
    matrix is one pass over the region's shingles."""

    def __init__(self, sizes: np.ndarray, keys: list[np.ndarray]):
        self.sizes = sizes
        _, self.number = np.unique(np.concatenate(keys), return_inverse=True)
        self.mark = np.zeros(self.number.max() + 1, bool)
        self.starts = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        self.root = np.arange(len(sizes))

    def common(self, i: int) -> np.ndarray:
        """Size of the intersection of member ``i`` with each member."""
        own = self.number[self.starts[i] : self.starts[i + 1]]
        self.mark[own] = True
        found = np.add.reduceat(self.mark[self.number].astype(np.int64), self.starts[:-1])
        self.mark[own] = False
        return found

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = int(self.root[i])
        return i

    def link_row(self, i: int) -> np.ndarray:
        """Link a pivot to all its neighbours; its distances."""
        common = self.common(i)
        for j in np.flatnonzero(linked(common, self.sizes, self.sizes[i])).tolist():
            a, b = self.find(i), self.find(j)
            self.root[max(a, b)] = min(a, b)
        return 1 - common / (self.sizes + self.sizes[i] - common)

    def join(self, radius: float = 0.2) -> np.ndarray:
        """Root of each member after all links."""
        done = np.zeros(len(self.sizes), bool)  # all links of a former pivot are known
        stack = [np.arange(len(self.sizes))]
        while stack:
            members = stack.pop()
            members = members[~done[members]]
            roots = np.array([self.find(i) for i in members.tolist()])
            names, sizes = np.unique(roots, return_counts=True)
            if len(names) < 2:
                continue
            outside = members[roots != names[sizes.argmax()]]  # pivots outside the largest component
            if len(members) <= LEAF:
                for i in outside.tolist():
                    self.link_row(i)
                    done[i] = True
                continue
            pivots, rows = [int(outside[0])], []
            while True:
                rows.append(self.link_row(pivots[-1])[members])
                done[pivots[-1]] = True
                nearest = np.min(rows, axis=0)
                far = np.where(done[members] | (roots == names[sizes.argmax()]), -1, nearest)
                if len(pivots) == PIVOTS or far.max() < 0:
                    break
                pivots.append(int(members[far.argmax()]))
            cells = [members[row - nearest <= 2 * radius + 1e-9] for row in rows]
            if max(map(len, cells)) > 0.8 * len(members):
                cells = [members]  # these pivots do not part it: go on with others
            stack.extend(cells)
        return np.array([self.find(i) for i in range(len(self.sizes))])


def _join_region(table: pa.Table) -> pa.Table:
    rows = sorted(table.select(["sid", "n", "keys"]).to_pylist(), key=lambda r: r["sid"])
    region = Region(np.array([r["n"] for r in rows]), [np.frombuffer(r["keys"], "<u8") for r in rows])
    sids = np.array([r["sid"] for r in rows])
    return pa.table({"a": sids, "b": sids[region.join()]})


def _measure(block: pa.Table, pivots: pa.Table) -> pa.Table:
    """Linked pivots, home cell and window cells of each member of a block."""
    rows, marks = block.to_pylist(), sorted(pivots.to_pylist(), key=lambda r: r["pivot"])
    region = Region(np.array([r["n"] for r in rows + marks]), [np.frombuffer(r["keys"], "<u8") for r in rows + marks])
    found = [region.common(len(rows) + i)[: len(rows)] for i in range(len(marks))]
    sizes, own = np.array([r["n"] for r in rows]), np.array([m["n"] for m in marks])[:, None]
    common = np.array(found)
    near, distance = linked(common, sizes, own), 1 - common / (sizes + own - common)
    inside = distance - distance.min(0) <= 0.4 + 1e-9
    return pa.table(
        {
            "region": block.column("region"),
            "sid": block.column("sid"),
            "n": block.column("n"),
            "keys": block.column("keys"),
            "near": pa.array([[marks[p]["pivot"] for p in np.flatnonzero(near[:, i])] for i in range(len(rows))], pa.list_(pa.int64())),
            "home": pa.array(distance.argmin(0), pa.int32()),
            "inside": pa.array([np.flatnonzero(inside[:, i]).tolist() for i in range(len(rows))], pa.list_(pa.int32())),
        }
    )


def _compare(probes: pa.Table, members: pa.Table) -> pa.Table:
    """Links of some members of a cell to others; roots stand for them."""
    rows = probes.select(["sid", "n", "keys"]).to_pylist() + members.select(["sid", "n", "keys"]).to_pylist()
    if not probes.num_rows or not members.num_rows:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    region = Region(np.array([r["n"] for r in rows]), [np.frombuffer(r["keys"], "<u8") for r in rows])
    for i in range(probes.num_rows):
        region.link_row(i)
    sids = np.array([r["sid"] for r in rows])
    return pa.table({"a": sids, "b": sids[[region.find(i) for i in range(len(rows))]]})


def _renewed(df: DataFrame) -> DataFrame:
    """The same rows under new attributes, for a cogroup with a frame of the same origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _large_links(rows: DataFrame, sizes: DataFrame, pivots: int, shingles: int) -> DataFrame:
    """Links of the regions that one task cannot hold, as (member, another) rows.

    Pivots part a region into Voronoi cells with windows. Members near the pivot with the
    most neighbours are connected through it; only the others are compared, block by
    block, with the members of their home cell.
    """
    blocks = F.ceil(F.col("shingles") / shingles).cast("int")
    blocked = rows.join(sizes.select("region", blocks.alias("blocks")), "region").withColumn("block", F.pmod(F.xxhash64("sid", F.lit(1)), F.col("blocks")).cast("int"))
    rank = F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64("sid"), "sid"))
    chosen = rows.select("region", "sid").withColumn("rank", rank).where(F.col("rank") <= pivots).select(F.col("sid").alias("pivot"))
    marks = blocked.join(chosen, F.col("sid") == F.col("pivot")).select("region", "pivot", "n", "keys", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    marks = _renewed(marks)
    schema = "region bigint, sid bigint, n bigint, keys binary, near array<bigint>, home int, inside array<int>"
    measured = durable(blocked.drop("blocks").groupBy("region", "block").cogroup(marks.groupBy("region", "block")).applyInArrow(_measure, schema), "measured")
    near = measured.select("region", "sid", F.explode("near").alias("pivot"))
    anchors = near.groupBy("region", "pivot").count().groupBy("region").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("anchor"))
    flagged = measured.join(anchors, "region", "left").withColumn("outside", ~F.coalesce(F.array_contains("near", F.col("anchor")), F.lit(False)))
    cells = flagged.select("region", "sid", "n", "keys", F.explode("inside").alias("cell"), (F.col("outside") & (F.col("home") == F.col("cell"))).alias("probe"))
    weight = F.octet_length("keys") / 8
    parts = lambda total: F.greatest(F.lit(1), F.ceil(total / shingles)).cast("int")
    loads = cells.groupBy("region", "cell").agg(parts(F.sum(weight)).alias("right"), parts(F.sum(F.when(F.col("probe"), weight))).alias("left"), F.max("probe").alias("probed"))
    loaded = cells.join(loads.where("probed").drop("probed"), ["region", "cell"])
    hashed = F.xxhash64("sid", F.lit(2))
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    lefts = loaded.where("probe").select("region", "cell", "sid", "n", "keys", F.pmod(hashed, F.col("left")).cast("int").alias("l"), every(F.col("right")).alias("r"))
    rights = loaded.select("region", "cell", "sid", "n", "keys", every(F.col("left")).alias("l"), F.pmod(hashed, F.col("right")).cast("int").alias("r"))
    task = ["region", "cell", "l", "r"]
    found = lefts.groupBy(*task).cogroup(_renewed(rights).groupBy(*task)).applyInArrow(_compare, "a bigint, b bigint")
    return near.select(F.col("sid").alias("a"), F.col("pivot").alias("b")).unionByName(found)


def similar_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", region_documents: int = REGION_DOCUMENTS, region_shingles: int = REGION_SHINGLES, pivots: int = 4 * PIVOTS) -> DataFrame:
    """``id, n_shingles, component_id`` of every row.

    ``component_id`` is the smallest id that links reach. Null, empty and wordless texts
    have no shingles and link with nothing, not even each other. Equal sets link, also
    repeated rows. Null ids take part and come after all others. Shingles and sets are
    known by 64-bit hashes. No rows give no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    described = durable(source.mapInArrow(_describe, "id bigint, n bigint, sid bigint, common bigint"), "described")
    members = described.where("common is null").select("id", "n", "sid")
    rows, total = members.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    often = described.where("common is not null").groupBy("common").agg(F.sum("n").alias("n")).where(F.col("n") * COMMON_SHARE >= rows)
    common = [r.common for r in often.orderBy(F.desc("n"), "common").limit(COMMON).collect()]
    shared = spark.sparkContext.broadcast(np.sort(np.array(common, np.int64).view(np.uint64)))
    bits = max(3, (total // BUCKET_SHINGLES).bit_length())
    dealt = source.mapInArrow(_deal_shingles(bits, shared), DEALT)
    counted = dealt.groupBy("bucket").applyInArrow(_shared_shingles(bits), DEALT)
    reach = durable(counted.groupBy("bucket").applyInArrow(_windows, "sid bigint, n bigint, keys binary, cells array<bigint>"), "reach")

    cells = reach.select("sid", F.explode("cells").alias("cell"))
    first = cells.groupBy("cell").agg(F.min("sid").alias("b"), F.count(F.lit(1)).alias("count")).where("count > 1")
    neighbours = cells.join(first, "cell").select(F.col("sid").alias("a"), "b")
    regions = durable(components(neighbours).select(F.col("id").alias("sid"), F.col("root").alias("region")), "regions")
    regional = durable(reach.select("sid", "n", "keys").join(regions, "sid"), "regional")
    sizes = regional.groupBy("region").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.octet_length("keys") / 8).alias("shingles"))
    sizes = durable(sizes.withColumn("large", (F.col("documents") > region_documents) | (F.col("shingles") > region_shingles)), "region-sizes")
    small = regional.join(sizes.where("not large").select("region"), "region").groupBy("region").applyInArrow(_join_region, "a bigint, b bigint")
    links, large = small.where("a <> b"), sizes.where("large")
    if not large.isEmpty():
        inside = regional.join(large.select("region"), "region")
        links = links.unionByName(_large_links(inside, large, pivots, region_shingles))
    roots = components(links)

    rooted = members.join(roots.withColumnRenamed("id", "_sid"), F.col("sid") == F.col("_sid"), "left")
    rooted = rooted.select("id", "n", F.coalesce("root", "sid").alias("root"))
    least = durable(rooted.where("n > 0").groupBy("root").agg(F.min("id").alias("least")).withColumnRenamed("root", "_root"), "least")
    labelled = rooted.join(least, (F.col("root") == F.col("_root")) & (F.col("n") > 0), "left")
    return labelled.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id, then text hash.

    Components are those of texts, so different documents that share an id, or have none,
    stay apart. Documents without shingles all stay; rows with a null id go if their group
    has another. Of rows that agree in id and text one stays. Texts are known by 64-bit
    hashes.
    """
    hashed = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), F.xxhash64(F.col(text)).alias("text"), F.coalesce(F.col(text), F.lit("")).rlike(r"\A[\x20\x09-\x0D]*\z").alias("wordless"))
    texts = similar_documents(docs.select(F.xxhash64(F.col(text)).alias("id"), F.col(text).alias("text")), "id", "text", **options)
    groups = texts.where("n_shingles > 0").select(F.col("id").alias("text"), "component_id").distinct()
    # combined per text and then per component, so that a large group is no hot key
    first = hashed.where("not wordless").groupBy("text").agg(F.min(F.struct(F.col("id").isNull().alias("nul"), "id")).alias("least"))
    kept = first.join(groups, "text").groupBy("component_id").agg(F.min(F.struct("least", "text")).alias("one"))
    kept = kept.select(F.col("one.least.id").alias("_id"), F.col("one.text").alias("_text"))
    stays = hashed.where("not wordless").join(kept, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text") == F.col("_text")), "left_semi")
    nth = F.row_number().over(Window.partitionBy("id", "text").orderBy(*tie_break(docs, "row")))
    return stays.unionByName(hashed.where("wordless")).withColumn("nth", nth).where("nth = 1").select("row.*")
