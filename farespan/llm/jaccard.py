"""Exact n-gram Jaccard join with signature trees.

A document's set holds the hashes of its distinct 5-word shingles. Two sets link when their
Jaccard similarity is at least 80 %.

1. Documents with equal sets form a class; one set stands for it.
2. Under one global order of shingles, linked sets share one among the first n // 5 + 1 of
   each, the prefix. The order puts rare shingles first, so a set shares its prefix with others
   only if it has few shingles of its own: of the lowest LOW of all hashes those that one class
   alone has, then the rest by the number of classes that have them; then the higher
   hashes; and last the shingles that very many documents have (at most HINTS, counted over all
   documents). These need no counting by shingle, so none meets in one place.
3. The classes that share a prefix shingle are listed under the least of them, their leader.
4. Under each leader a signature tree is built: a leaf holds some sets of similar size, a
   node the OR of the bitmaps below it, the range of sizes and the most that a bitmap
   undercounts. The tree is traversed against itself; a pair of nodes is dropped when its
   largest possible overlap is too small for its sizes, or when all below it is connected
   already. A leader of over GROUP sets is cut into a grid of cells.
5. Pairs that the bitmaps can't exclude are compared there and then, by the whole sets, unless
   they are connected already. Only the links that connect two components leave a cell: fewer
   than it has sets, however many pairs come near.
6. Distributed union-find makes components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farespan.llm import arrays as A
from farespan.llm.common import components, drop_staged, hot_join, scoped, stage

HINTS = 1 << 16  # common shingles that go last in the order
HINT_ROWS = 8  # seen in at least so many documents
LOW = 0.3  # share of all hashes whose classes are counted; a prefix takes a fifth
GROUP = 4000  # sets in a signature tree
WEIGHT = 4 << 20  # shingles of these sets
LEAF, FAN = 32, 8
BLOCK = 1 << 20  # bitmap words that two leaves compare at once
EDGES = 1 << 16  # links that a task contracts at once
FLUSH = 2 << 20  # hashes that a task gathers before it hands them on


def needed(a: int, b: int) -> int:
    """Least overlap with which sets of these sizes link: 100 i >= 80 (a + b - i)."""
    return -(-80 * (a + b) // 180)


# -- sets and prefixes -----------------------------------------------------------------

def _set_id(own: np.ndarray) -> np.int64:
    h = A.mix(np.bitwise_xor.reduce(A.mix(own + A.U(1)), keepdims=True) + A.U(len(own) * int(A.BASE) & 0xFFFFFFFFFFFFFFFF) + own.sum(dtype=A.U, keepdims=True))
    return h.astype(np.int64)[0]


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that several different texts of this task have, with the number of texts."""

    def flush(sets: dict) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate([*sets.values(), np.zeros(0, A.U)]), return_counts=True)
        often = n >= 4
        return pa.RecordBatch.from_pydict({"token": token[often].astype(np.int64), "n": n[often].astype(np.int64)})

    sets, held = {}, 0
    for batch in batches:
        for part in A.pieces(batch, "text"):
            for own in A.shingle_sets(part.column("text")):
                if len(own):
                    sets[_set_id(own)] = own
                    held += len(own)
            if held > FLUSH:
                yield flush(sets)
                sets, held = {}, 0
    yield flush(sets)


def common_shingles(docs: DataFrame) -> np.ndarray:
    """The most frequent shingles, least frequent first: those of every count that leaves no
    more than HINTS. Counts are cut off by their histogram, a row for each power of two and
    quarter of it, so no ranking meets in one place."""
    rows = docs.select("text").mapInArrow(_common, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = stage(rows.filter(F.col("n") >= HINT_ROWS), "jaccard-common")
    step = F.floor(F.log2("n") * 4)
    least, held = None, 0
    for r in sorted(rows.groupBy(step.alias("step")).agg(F.count("*").alias("tokens"), F.min("n").alias("n")).collect(), key=lambda r: -r.step):
        held += r.tokens
        if held > HINTS:
            break
        least = r.n
    top = rows.filter(F.col("n") >= least).toPandas() if least else None
    drop_staged(rows)
    if top is None:
        return np.zeros(0, A.U)
    top = top.sort_values(["n", "token"])
    return top["token"].to_numpy(np.int64).astype(A.U)


def shingle_table(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """One row per document: doc_id, sid (id of its set), key (hash of its text), n, tokens,
    gap, last.

    ``tokens``: the low shingles that are not common, sorted, and if these don't fill the prefix
    the higher ones that do. ``gap``: how many shingles the prefix takes beyond the low ones,
    below zero if there are more of these. ``last``: the common ones that it takes.
    """
    by_hash = np.argsort(common, kind="stable")
    hot, place = common[by_hash], by_hash
    quick = np.zeros(1 << 20, dtype=bool)
    quick[(hot >> A.U(44)).astype(np.int64)] = True
    top = A.U(int(LOW * 2.0**64))
    none = np.zeros(0, A.U)

    def prefix(own: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
        size, last = len(own) // 5 + 1, none
        maybe = np.flatnonzero(quick[(own >> A.U(44)).astype(np.int64)])
        if len(maybe) and len(hot):
            at = np.minimum(np.searchsorted(hot, own[maybe]), len(hot) - 1)
            same = hot[at] == own[maybe]
            at, maybe = at[same], maybe[same]
            last = own[maybe][np.argsort(place[at])]
            own = np.delete(own, maybe)
        low = int(np.searchsorted(own, top))
        rest = own[: max(size, low)]
        return rest, size - low, last[: max(size - len(rest), 0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.pieces(batch, "text"):
                sid, n, tokens, gap, last = [], [], [], [], []
                for own in A.shingle_sets(part.column("text")):
                    n.append(len(own))
                    sid.append(_set_id(own) if len(own) else None)
                    x, g, y = prefix(own) if len(own) else (none, 0, none)
                    tokens.append(x.tobytes())
                    gap.append(g)
                    last.append(y.astype(np.int64))
                ends = np.concatenate([[0], np.cumsum([len(y) for y in last])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(sid, pa.int64()), pa.array(n, pa.int64()), pa.array(gap, pa.int64()), pa.array(tokens, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *last])))],
                    ["doc_id", "key", "sid", "n", "gap", "tokens", "last"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    return rows.mapInArrow(run, "doc_id long, key long, sid long, n long, gap long, tokens binary, last array<long>")


def bitmap(own: np.ndarray) -> np.ndarray:
    """A power of two of bits, at least eight a shingle."""
    size = max(64, 1 << int(8 * len(own) - 1).bit_length())
    out = np.zeros(size, dtype=np.uint8)
    out[(own & A.U(size - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").view(A.U)


# -- sets that share a prefix shingle ----------------------------------------------------

def _dealt(buckets: int):
    """Packs (shingle, set) by bucket, so that few rows are shuffled."""

    def flush(held: list) -> pa.RecordBatch:
        token = np.concatenate([t for _, t in held])
        sid = np.repeat(np.array([s for s, _ in held], dtype=np.int64), [len(t) for _, t in held])
        bucket = (A.mix(token) % A.U(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, token, sid = bucket[order], token[order], sid[order]
        edge = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
        return pa.RecordBatch.from_pydict({
            "bucket": bucket[edge[:-1]],
            "token": pa.array([token[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
            "sid": pa.array([sid[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()
        for batch in batches:
            for sid, tokens in zip(batch.column("sid").to_pylist(), batch.column("tokens")):
                if sid in seen:
                    continue
                seen.add(sid)
                held.append((sid, np.frombuffer(tokens.as_buffer(), dtype=A.U)))
                size += len(held[-1][1])
                if size > FLUSH:
                    yield flush(held)
                    held, size, seen = [], 0, set()
        if size:
            yield flush(held)

    return run


def _shared(table: pa.Table) -> pa.Table:
    """(sid, token, df) of the shingles of this bucket that several sets have."""
    token = np.concatenate([np.frombuffer(x.as_buffer(), dtype=A.U) for x in table.column("token")])
    sid = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.int64) for x in table.column("sid")])
    order = np.lexsort((sid, token))
    token, sid = token[order], sid[order]
    new = np.r_[True, (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])]
    token, sid = token[new], sid[new]
    at = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    df = np.diff(np.r_[at, len(token)])
    several = np.repeat(df > 1, df)
    return pa.table({"sid": sid[several], "token": token[several].astype(np.int64), "df": np.repeat(df, df)[several].astype(np.int64)})


def prefixes(sets: DataFrame) -> DataFrame:
    """(sid, token) of the prefix shingles that other classes have as well, in their low or
    higher part, and of all common ones.

    Of ``low`` shingles, ``shared`` ones among them, a prefix of ``low + gap`` takes those
    without a second class first, so ``shared + gap`` of the others are left to take.
    """
    whole = sets.filter("n > 0")
    total = whole.agg(F.sum(F.octet_length("tokens") / 8)).first()[0] or 0
    buckets = int(total // FLUSH) + 1 + sets.sparkSession.sparkContext.defaultParallelism
    found = whole.select("sid", "tokens").mapInArrow(_dealt(buckets), "bucket long, token binary, sid binary").groupBy("bucket").applyInArrow(_shared, "sid long, token long, df long")
    gaps = whole.select("sid", "gap").dropDuplicates(["sid"])
    rows = found.join(gaps, "sid")
    # Hashes are unsigned; as signed numbers the low ones are those from 0 on.
    low = F.col("token").between(0, int(LOW * 2.0**64)) if LOW <= 0.5 else F.lit(None)
    rank = F.row_number().over(Window.partitionBy("sid").orderBy("df", "token"))
    shared = F.count("*").over(Window.partitionBy("sid"))
    few = rows.filter(low & (F.col("gap") <= 0)).withColumns({"_rank": rank, "_shared": shared}).filter("_rank <= _shared + gap").select("sid", "token")
    all_ = rows.filter("gap > 0").select("sid", "token")
    return few.unionByName(all_).unionByName(whole.select("sid", F.explode("last").alias("token")).distinct())


def members(sets: DataFrame) -> DataFrame:
    """Distinct (leader, sid), the leader among its own."""
    picks = stage(prefixes(sets), "jaccard-picks")
    heads = stage(picks.groupBy("token").agg(F.min("sid").alias("leader"), F.count("*").alias("_n")).filter("_n > 1"), "jaccard-heads")
    total = heads.agg(F.sum("_n")).first()[0] or 1
    rows = hot_join(picks, heads, "token", "_n", total).filter("leader is not null")
    both = rows.filter("leader != sid").select("leader", "sid").distinct()
    return both.unionByName(both.select("leader", F.col("leader").alias("sid")).distinct())


# -- signature trees -------------------------------------------------------------------

class Node:
    """OR of the bitmaps below, the range of sizes, and by how much a bitmap may undercount. The
    lowest nodes, leaves of the tree, hold the bitmaps of their sets in ``rows``."""

    __slots__ = ("bits", "lo", "hi", "extra", "kids", "sets", "rows", "single", "folds")

    def __init__(self, kids, sets, rows, bits, lo, hi, extra):
        self.kids, self.sets, self.rows, self.bits, self.lo, self.hi, self.extra = kids, sets, rows, bits, lo, hi, extra
        self.single, self.folds = len(sets) == 1, {}

    def folded(self, size: int) -> tuple[np.ndarray, int]:
        """The bitmap at a smaller size, and the undercount it has there."""
        if size == len(self.bits):
            return self.bits, self.extra
        if size not in self.folds:
            bits = _fold(self.bits, size)
            lost = int(np.bitwise_count(self.bits).sum()) - int(np.bitwise_count(bits).sum())
            self.folds[size] = bits, self.extra + lost
        return self.folds[size]


def _fold(bits: np.ndarray, size: int) -> np.ndarray:
    return bits if len(bits) == size else np.bitwise_or.reduce(bits.reshape(-1, size), axis=0)


def _leaf(at: list[int], n: list[int], bits: list[np.ndarray]) -> Node:
    rows = np.stack([_fold(bits[i], min(len(bits[j]) for j in at)) for i in at])
    extra = max(n[i] - int(c) for i, c in zip(at, np.bitwise_count(rows).sum(axis=1, dtype=np.int64)))
    return Node([], at, rows, np.bitwise_or.reduce(rows, axis=0), min(n[i] for i in at), max(n[i] for i in at), extra)


def _parent(kids: list[Node]) -> Node:
    size = min(len(k.bits) for k in kids)
    parts = [k.folded(size) for k in kids]
    return Node(kids, [i for k in kids for i in k.sets], None, np.bitwise_or.reduce([p[0] for p in parts]), min(k.lo for k in kids), max(k.hi for k in kids), max(p[1] for p in parts))


def most_overlap(x: Node, y: Node) -> int:
    size = min(len(x.bits), len(y.bits))
    (a, more_a), (b, more_b) = x.folded(size), y.folded(size)
    return min(x.hi, y.hi, int(np.bitwise_count(a & b).sum()) + min(more_a, more_b))


def apart(x: Node, y: Node) -> bool:
    """No set below one can link with a set below the other."""
    return 5 * x.hi < 4 * y.lo or 5 * y.hi < 4 * x.lo or most_overlap(x, y) < needed(x.lo, y.lo)


def _at_size(rows: np.ndarray, size: int) -> np.ndarray:
    return rows if rows.shape[1] == size else np.bitwise_or.reduce(rows.reshape(len(rows), -1, size), axis=1)


def near(x: Node, y: Node, n: np.ndarray) -> np.ndarray:
    """For each set of a leaf and each of another the most that they may share, or -1 if they can't link."""
    size = min(x.rows.shape[1], y.rows.shape[1])
    a, b = _at_size(x.rows, size), _at_size(y.rows, size)
    step = max(1, BLOCK // b.size)
    both = np.concatenate([np.bitwise_count(a[i : i + step, None] & b[None]).sum(axis=2, dtype=np.int64) for i in range(0, len(a), step)])
    n_a, n_b = n[x.sets][:, None], n[y.sets][None]
    only_a = np.bitwise_count(a).sum(axis=1, dtype=np.int64)[:, None] - both
    only_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)[None] - both
    most = np.minimum(n_a - only_a, n_b - only_b)
    return np.where((5 * n_a >= 4 * n_b) & (5 * n_b >= 4 * n_a) & (most >= -(-80 * (n_a + n_b) // 180)), most, -1)


def links(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets of distinct hashes, sorted, are similar enough."""
    all_ = np.concatenate([x, y])
    all_.sort(kind="stable")
    return int((all_[1:] == all_[:-1]).sum()) >= needed(len(x), len(y))


def tree_links(sets: list[np.ndarray], root: list, side: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect the components of these sets: fewer than there are sets.

    ``root`` names the known component of each set. With ``side`` only pairs across the two
    sides are wanted.
    """
    up, n = {}, [len(s) for s in sets]
    parent = [up.setdefault(r, i) for i, r in enumerate(root)]

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def connected(x: Node, y: Node) -> bool:
        r = find(x.sets[0])
        for node in (x,) if x is y else (x, y):
            if find(node.sets[0]) != r:
                return False
            if not node.single:
                if any(find(i) != r for i in node.sets):
                    return False
                node.single = True
        return True

    bits, sizes, sides = [bitmap(s) for s in sets], np.array(n), np.array(side) if side else None
    order = sorted(range(len(n)), key=lambda i: (side[i] if side else 0, n[i], i))
    level = [_leaf(order[i : i + LEAF], n, bits) for i in range(0, len(order), LEAF)]
    while len(level) > 1:
        level = [_parent(level[i : i + FAN]) for i in range(0, len(level), FAN)]
    out, stack = [], [(level[0], level[0])]
    while stack:
        x, y = stack.pop()
        if connected(x, y):
            continue
        if x is y and x.kids:
            stack.extend((x.kids[i], x.kids[j]) for i in range(len(x.kids)) for j in range(i, len(x.kids)))
        elif x.kids or y.kids:
            if not apart(x, y):
                a, b = (x, y) if len(x.sets) >= len(y.sets) else (y, x)
                stack.extend((k, b) for k in a.kids)
        elif x is y or not apart(x, y):
            wanted = np.array([find(i) for i in x.sets])[:, None] != np.array([find(i) for i in y.sets])[None]
            if side:
                wanted &= sides[x.sets][:, None] != sides[y.sets][None]
            if not wanted.any():
                continue
            most = near(x, y, sizes)
            wanted &= most >= 0
            if x is y:
                wanted = np.triu(wanted, 1)
            p, q = np.nonzero(wanted)
            for k in np.argsort(-most[p, q], kind="stable"):  # those that are likeliest to connect first
                i, j = x.sets[p[k]], y.sets[q[k]]
                a, b = find(i), find(j)
                if a != b and links(sets[i], sets[j]):
                    out.append((i, j))
                    parent[a] = b
    return out


def _cells(table: pa.Table) -> pa.Table:
    """Links of some cells, each by itself."""
    sid, cell, root, side = (table.column(c).to_numpy() for c in ("sid", "cell", "root", "side"))
    sets = [np.frombuffer(x.as_buffer(), dtype=A.U) for x in table.column("hashes")]
    order = np.lexsort((sid, cell))
    edge = np.r_[np.flatnonzero(np.r_[True, np.diff(cell[order]) != 0]), len(order)]
    a, b = [], []
    for at in (order[i:j] for i, j in zip(edge[:-1], edge[1:])):
        sides = side[at].tolist()
        for i, j in tree_links([sets[k] for k in at], root[at].tolist(), sides if len(set(sides)) > 1 else None):
            a.append(min(sid[at[i]], sid[at[j]]))
            b.append(max(sid[at[i]], sid[at[j]]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def links_in(cells: DataFrame, classes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(a, b) of the links that the signature tree of each cell of ``cell, side, sid, n`` finds."""
    cells = stage(cells, "jaccard-cells")
    rows, weight = cells.agg(F.count("*"), F.sum("n")).first()
    packs = max(rows // (2 * GROUP), (weight or 0) // WEIGHT) + cells.sparkSession.sparkContext.defaultParallelism
    sets = cells.drop("n").join(classes.select("sid", "hashes"), "sid")
    if roots is None:
        sets = sets.withColumn("root", F.col("sid"))
    else:
        sets = sets.join(roots, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid")).drop("node")
    sets = sets.withColumn("_pack", F.pmod(F.xxhash64("cell"), F.lit(packs)))
    out = stage(sets.groupBy("_pack").applyInArrow(_cells, "a long, b long"), "jaccard-links")
    drop_staged(cells)
    return out


def listed(docs: DataFrame, thin: DataFrame, own: DataFrame) -> DataFrame:
    """sid, n, hashes of one document of each class that is listed anywhere."""
    wanted = own.select("sid").distinct().join(thin.filter("n > 0"), "sid")
    wanted = wanted.groupBy("sid").agg(F.min(F.struct("key", "doc_id")).alias("of")).select("sid", F.col("of.key").alias("key"), F.col("of.doc_id").alias("_doc"))
    rows = docs.select(F.xxhash64("text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.join(wanted, (rows["key"] == wanted["key"]) & rows["doc_id"].eqNullSafe(F.col("_doc"))).select("sid", "text")
    return rows.dropDuplicates(["sid"]).mapInArrow(_hashes, "sid long, n long, hashes binary")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in A.pieces(batch, "text"):
            sets = list(A.shingle_sets(part.column("text")))
            n, hashes = pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("sid"), n, hashes], ["sid", "n", "hashes"])


# -- the join ----------------------------------------------------------------------------

def _grid(own: DataFrame, classes: DataFrame) -> DataFrame:
    """Members with their chunk: a leader of over GROUP sets, or of over WEIGHT shingles, is cut
    into several. A chunk holds a share of both by chance, and a set of its own in any case."""
    own = stage(own.join(classes.select("sid", "n"), "sid"), "jaccard-own")
    sizes = stage(own.groupBy("leader").agg(F.count("*").alias("_n"), F.sum("n").alias("_weight")), "jaccard-leaders")
    out = hot_join(own, sizes, "leader", "_n", own.count())
    parts = F.least(F.greatest(F.ceil(F.col("_n") / GROUP), F.ceil(F.col("_weight") / WEIGHT)), F.col("_n"))
    out = stage(out.select("leader", "sid", "n", parts.alias("parts"), F.pmod(F.xxhash64("sid"), parts).alias("chunk")), "jaccard-members")
    drop_staged(own)
    return out


def components_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, sid, n of every row; sid, root of every class with a link)."""
    sets = stage(shingle_table(docs, common_shingles(docs)), "jaccard-sets")
    thin = stage(sets.select("doc_id", "key", "sid", "n"), "jaccard-rows")
    own = stage(members(sets), "jaccard-own")
    drop_staged(sets)
    classes = stage(listed(docs, thin, own), "jaccard-classes")
    grid = _grid(own, classes)
    name = F.xxhash64("leader", F.lit(0), "chunk")
    inside = grid.select(name.alias("cell"), F.lit(0).alias("side"), "sid", "n")
    first = grid.filter("parts > 1").groupBy("leader", "chunk").agg(F.min(F.struct("sid", "n")).alias("of"))
    heads = first.select(F.xxhash64("leader", F.lit(1)).alias("cell"), F.lit(0).alias("side"), "of.sid", "of.n")
    roots = roots_of(links_in(inside.unionByName(heads), classes, None), None)
    large = grid.filter("parts > 1")
    if not large.isEmpty():
        more = links_in(across(large, roots), classes, roots)
        roots = roots if more.isEmpty() else roots_of(more, roots)
    return thin, roots


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, least node) of the components within each run of EDGES links."""

    def flush(parent: dict) -> pa.RecordBatch:
        nodes = [x for x in parent if parent[x] != x]
        return pa.RecordBatch.from_pydict({"a": pa.array(nodes, pa.int64()), "b": pa.array([find(parent, x) for x in nodes], pa.int64())})

    def find(parent: dict, x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    parent, held = {}, 0
    for batch in batches:
        for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            parent.setdefault(x, x)
            parent.setdefault(y, y)
            x, y = find(parent, x), find(parent, y)
            parent[max(x, y)] = min(x, y)
        held += batch.num_rows
        if held > EDGES:
            yield flush(parent)
            parent, held = {}, 0
    yield flush(parent)


def roots_of(links: DataFrame, known: DataFrame | None) -> DataFrame:
    """node, root of the components of new links and those known before.

    Runs of links are contracted to stars first, then stars meet in distributed union-find. If
    there are no more than EDGES links, one run holds them all and its stars are the components.
    """
    edges = links.select("a", "b")
    if known is not None:
        edges = edges.unionByName(known.select(F.col("node").alias("a"), F.col("root").alias("b")))
    edges = stage(edges, "jaccard-edges")
    parts = edges.count() // EDGES + 1
    stars = edges.repartition(parts).mapInArrow(_forest, "a long, b long")
    out = stage(stars.select(F.col("a").alias("node"), F.col("b").alias("root")) if parts == 1 else components(stars), "jaccard-roots")
    drop_staged(edges)
    return out


def across(large: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of chunks of one leader, without those that lie in one component together."""
    row = large.join(roots, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid"))
    chunk = row.groupBy("leader", "chunk").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    x, y = chunk.alias("x"), chunk.alias("y")
    pairs = x.join(y, (F.col("x.leader") == F.col("y.leader")) & (F.col("x.chunk") < F.col("y.chunk"))).filter(
        ~((F.col("x.lo") == F.col("x.hi")) & (F.col("y.lo") == F.col("y.hi")) & (F.col("x.lo") == F.col("y.lo")))
    ).select(F.col("x.leader").alias("leader"), F.col("x.chunk").alias("c"), F.col("y.chunk").alias("d"))
    sides = pairs.select("leader", "c", "d", F.explode(F.array(F.struct(F.col("c").alias("chunk"), F.lit(0).alias("side")), F.struct(F.col("d").alias("chunk"), F.lit(1).alias("side")))).alias("p")).select("leader", "c", "d", "p.*")
    return sides.join(large.select("leader", "chunk", "sid", "n"), ["leader", "chunk"]).select(F.xxhash64("leader", F.lit(2), "c", "d").alias("cell"), "side", "sid", "n")


@scoped
def join(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Null, empty and blank texts have an empty set and stand alone, as does a row whose
    component holds no doc_id. Rows of equal sets, repeated rows too, share a component. Only
    ``doc_id`` and ``text`` are read, whatever the names of other columns; a long text is one row
    of a task. Empty input gives no rows.
    """
    rows, roots = components_of(docs)
    named = _named(rows, roots)
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = stage(named.join(least, "root").select("sid", "rows", "component_id"), "jaccard-components")
    out = hot_join(rows, named, "sid", "rows", rows.count())
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _named(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """sid, rows, doc_id (least), first (least row) and root of every class with a word."""
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    thin = rows.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.min(first).alias("first"), F.count("*").alias("rows"))
    return thin.join(roots, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid")).drop("node")


@scoped
def one_per_group(docs: DataFrame) -> DataFrame:
    """The first row of each component by doc_id and text (a null doc_id comes after all others),
    and all without words.

    A row is told by its doc_id and text: rows that repeat both count as one, those of one doc_id
    and different texts are judged apart, and so are rows without a doc_id. All columns stay.
    """
    rows, roots = components_of(docs)
    best = _named(rows, roots).groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.key")
    stays = stage(best.unionByName(rows.filter("n = 0").select("doc_id", "key").distinct()), "jaccard-stays")
    often = rows.groupBy("doc_id", "key").agg(F.count("*").alias("_often")).filter("_often > 1")
    same = lambda side: F.col("_doc").eqNullSafe(side["doc_id"]) & (F.col("_text") == side["key"])
    names = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.select(F.struct(*names).alias("_row"), F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_text"))
    kept = kept.join(stays, same(stays), "left_semi")
    twice = stage(often.join(stays, (often["doc_id"].eqNullSafe(stays["doc_id"])) & (often["key"] == stays["key"]), "left_semi"), "jaccard-twice")
    if twice.isEmpty():
        return kept.select("_row.*")
    once = kept.join(twice, same(twice), "left_anti")
    return once.unionByName(kept.join(twice, same(twice), "left_semi").dropDuplicates(["_doc", "_text"])).select("_row.*")
