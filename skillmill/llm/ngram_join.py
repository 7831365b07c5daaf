"""N-gram Jaccard join through R-trees over count vectors.

A document is the set of its distinct word shingles.  The shingles are hashed into
groups; how many fall into each group makes the document a point, and the sum of the
smaller coordinates of two points bounds the overlap of their sets from above.

Which documents share a tree.  Sets of a size class, and of the next, can reach the
similarity only with each other.  Such a pair differs in at most ``floor(na * d)``
shingles, ``d`` set by the threshold, and a class has more groups than that, so some
group holds the very same shingles in both.  Documents with the same filling of a
group are the points of one tree; pairs that share no tree cannot be linked.  Two documents for which this
is not certain, as they have many empty groups, share one of their first shingles, which are
trees of such documents.

Which trees count.  A document that fills ``f`` groups shares at least ``f - d`` fillings with a partner, so the two
also meet among the ``d + 1`` fillings that fewest documents hold, in one order for all.  The others, first of all those
of passages that many documents share, are left out; a document that shares fewer fillings than ``f - d`` with any
others is left out as a whole.

In a tree, points are packed into leaves by what is already known to be connected,
each with its bounding box.  Two boxes whose bound is too low are not opened.  Points are
held at a finer grain, every group cut into cells: two sets that just miss the threshold
then seldom pass the bound, and only what passes it is verified on the sets.

Who is compared.  Documents with equal sets are one class.  Some rounds link each component
to documents it shares most trees with; then all pairs of documents that share any tree and are
not yet connected are bounded and verified.  A pair skipped this way is connected already, so
no component is lost and a group of copies costs no square of its size.

Defined results: null or empty text, or one without words, has no shingles and no
links; fewer words than a shingle make one shingle; rows that repeat an id are one
document; a row without an id has no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillmill.llm.common import blocks, components, narrow, partitions, stored

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)
#: How far the groups that are expected to be filled exceed the shingles in which a linked pair may differ.
SPARE = 1.125
#: Cells each group is cut into where points are compared.
FINE = 8
#: Points of a leaf, about, and of one whose points have no more than ``SHORT`` shingles; trees of up to ``LEAF`` points are one leaf.
LEAF, WIDE, SHORT = 64, 1024, 1024
#: Most rounds that connect components over one in ``SOME`` trees, the later ones over all trees that are no single leaf as well, and
#: pairs of a component in these.
ROUNDS, SOME, OFFERS = 4, 8, 8
#: A round that links no more than one in so many documents is the last.
FEW = 20
#: Largest set the classes are laid out for.
LARGEST = 1 << 40
#: What a count of a cell says at most; so many or more.
FULL = 255

ROW = "bucket int, kind string, a long, b long, c long, d long, e long, f long, keys binary, ids binary"
FOUND = "kind string, a long, b long, c long, d long, e long, f long"
#: Bytes of an Arrow batch that are made Python objects at a time, and pairs that are sent on together.
PIECE, PAIRS = 1 << 20, 200_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w) for w in words], dtype=np.uint64)
    total = np.zeros(len(hashes) - size + 1, dtype=np.uint64)
    for k in range(size):
        total = mixed(total * _MULTIPLIERS[k % 5] + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(total)


def class_tops(percent: int) -> np.ndarray:
    """Largest set size of each class.  A set and one at most 100/percent as large are in
    the same class or in neighbouring ones."""
    tops = [0, 1]
    while tops[-1] < LARGEST:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // percent))
    return np.array(tops, dtype=np.int64)


def group_quarters(percent: int) -> int:
    """Shingles of one group on average, times four; fewer make more trees.

    The most for which a document fills more groups than it differs in from a partner: of ``g``
    shingles a group, ``(1 - exp(-g)) / g`` groups a shingle are filled.
    """
    differing = (100 - percent) / percent
    fit = [q for q in range(1, 33) if (1 - np.exp(-q / 4)) / (q / 4) >= SPARE * differing]
    return max(fit, default=1)


class Shape:
    """Size classes, groups and bounds for a threshold in percent."""

    def __init__(self, percent: int):
        self.percent = percent
        self.tops = class_tops(percent)
        self.quarters = group_quarters(percent)

    def classes(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, n)

    def groups(self, tree: np.ndarray) -> np.ndarray:
        return -(-self.tops[tree] * 4 // self.quarters) + 2

    def differing(self, n: np.ndarray, tree: np.ndarray) -> np.ndarray:
        """Most shingles in which a document and a partner of the tree differ."""
        smaller = np.minimum(n, self.tops[tree])
        return smaller * (100 - self.percent) // self.percent

    def needed(self, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
        """Least overlap of two linked sets of these sizes."""
        return -(-(na + nb) * self.percent // (100 + self.percent))


def counted(hashes: np.ndarray, owner: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell of each hash, first cell of each owner): owner ``i`` has ``groups[i]`` cells."""
    first = np.concatenate([[0], np.cumsum(groups)])
    within = ((hashes >> np.uint64(32)) * groups[owner].astype(np.uint64)) >> np.uint64(32)
    return first[owner] + within.astype(np.int64), first


def tree_keys(sets: list[np.ndarray], shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, index of the set) for every filled group, in the set's two trees, and how many keys of each tree may be left out.

    The number of the set's own class is in the lower byte of the first of the two.
    Where a set may share no filling with a partner, its first shingles are keys as well and none may be left out.
    """
    n = np.array([len(s) for s in sets], dtype=np.int64)
    keys, owners, spare = [], [], np.zeros((len(sets), 2), dtype=np.int64)
    used = np.flatnonzero(n)
    if not len(used):
        return np.empty(0, np.uint64), np.empty(0, np.int64), spare
    hashes, n = np.concatenate([sets[i] for i in used]), n[used]
    owner = np.repeat(np.arange(len(used)), n)
    start = np.cumsum(n) - n
    low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(float), (hashes >> np.uint64(32)).astype(float)
    for back in (0, 1):
        tree = shape.classes(n) - back
        live = tree >= 1
        groups = np.where(live, shape.groups(np.maximum(tree, 1)), 1)
        cell, first = counted(hashes, owner, groups)
        size = int(first[-1])
        number = np.bincount(cell, minlength=size)
        sums = [np.bincount(cell, weights=w, minlength=size).astype(np.uint64) for w in (low, high)]
        who = np.repeat(np.arange(len(used)), groups)
        group = np.arange(size) - first[who]
        key = mixed(sums[0] * _MULTIPLIERS[0] + mixed(sums[1] + _MULTIPLIERS[1] * group.astype(np.uint64)))
        filled = (number > 0) & live[who]
        differing = shape.differing(n, np.maximum(tree, 1))
        more = np.bincount(who[filled], minlength=len(used)) - differing
        spare[used, back] = np.where(live, np.maximum(more - 1, 0), 0)
        if not back:
            spare[used, 0] = spare[used, 0] << 8 | tree
        # At most so many of a set's shingles are not its partner's, so the two share one of their first.
        rare = np.flatnonzero(live & (more <= 0))
        many = np.minimum(differing[rare] + 1, n[rare])
        at = np.repeat(start[rare] + many - np.cumsum(many), many) + np.arange(int(many.sum()))
        whose = np.repeat(rare, many)
        # The key's last byte is the tree's class; there are fewer than 256.
        for k, i in ((key[filled], who[filled]), (mixed(hashes[at] + _MULTIPLIERS[2]), whose)):
            keys.append(k << np.uint64(8) | tree[i].astype(np.uint64))
            owners.append(i)
    return np.concatenate(keys), used[np.concatenate(owners)], spare


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each run of equal values begins, its length)."""
    begin = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return begin, np.diff(np.concatenate([begin, [len(sorted_keys)]]))


def tree_rows(shape: Shape, size: int, buckets: int, by_set: bool = False):
    """Maps texts to a row per document and to packed tree keys, dealt out by key.

    The keys are those of documents or, ``by_set``, of sets, named by the first half of their hash.
    ``members`` are keys that occur several times in the block, ``keys`` the others.
    """

    def out(rows: list[tuple]) -> pa.RecordBatch:
        names = [x.split()[0] for x in ROW.split(", ")]
        kinds = [pa.int32(), pa.string(), *[pa.int64()] * 6, *[pa.binary()] * 2]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            ids, sets, rows = block["doc_id"], [], []
            for i, (doc, text) in enumerate(zip(ids, block["text"], strict=True)):
                found = shingle_hashes(text, size)
                sets.append(found if doc is not None else found[:0])
                h = xxhash.xxh3_128_intdigest(found.tobytes())
                halves = [(h >> s & (1 << 64) - 1) - (1 << 63) for s in (0, 64)]
                rows.append((hash((doc, i)) % buckets, "doc", doc, len(found), *halves))
            # Copies within the block need not all be packed; a row without an id stands for none of them.
            seen: dict[tuple, int] = {}
            for i, row in enumerate(rows):
                if ids[i] is not None and seen.setdefault(row[4:6], i) != i:
                    sets[i] = sets[i][:0]
            keys, owner, spare = tree_keys(sets, shape)
            named = np.array([row[4] if by_set else row[2] or 0 for row in rows], dtype=np.int64)
            rows = [(*row, *map(int, spare[i]), None, None) for i, row in enumerate(rows)]
            if not len(keys):
                yield out(rows)
                continue
            who = named[owner]
            order = np.lexsort((who, keys))
            keys, who = keys[order], who[order]
            _, length = runs(keys)
            several = np.repeat(length > 1, length)
            # The bucket is that of the key's upper half, so the order by key is one by bucket.
            bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            for kind, part in (("members", several), ("keys", ~several)):
                if part.any():
                    k, w, at = keys[part], who[part], bucket[part]
                    for b, n in zip(*runs(at), strict=True):
                        rows.append((int(at[b]), kind, *[None] * 6, k[b : b + n].tobytes(), w[b : b + n].tobytes()))
            yield out(rows)

    return run


def shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the keys dealt to a task, those that several hold, each with how many do; rows of documents pass through."""

    def out(kind, *columns):
        arrays = [pa.array([kind] * len(columns[0])), *[pa.array(x, pa.int64()) for x in columns]]
        return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in FOUND.split(", ")])

    held = []
    for batch in batches:
        kind = batch.column("kind")
        docs = batch.filter(pc.equal(kind, "doc"))
        if docs.num_rows:
            yield out("doc", *[docs.column(c) for c in "abcdef"])
        packed = batch.filter(pc.not_equal(kind, "doc"))
        rows = zip(*[packed.column(c).to_pylist() for c in ("keys", "ids")], strict=True)
        held += [(np.frombuffer(k, np.uint64), np.frombuffer(i, np.int64)) for k, i in rows]
    if held:
        keys, who = [np.concatenate(x) for x in zip(*held, strict=True)]
        held = []
        order = np.lexsort((who, keys))
        keys, who = keys[order], who[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (who[1:] != who[:-1])])
        keys, who = keys[new], who[new]
        _, length = runs(keys)
        number = np.repeat(length, length)
        several = number > 1
        keys, who, number = keys[several].view(np.int64), who[several], number[several]
        for i in range(0, len(keys), PAIRS):
            part = slice(i, i + PAIRS)
            none = pa.nulls(len(keys[part]), pa.int64())
            yield out("member", keys[part], who[part], number[part], none, none, none)


def points(shape: Shape, size: int):
    """Maps texts to the sorted set and the cell counts of the document's two trees."""

    def vector(found: np.ndarray, tree: int) -> bytes:
        if tree < 1:
            return b""
        cells = shape.groups(np.array([tree])) * FINE
        cell, _ = counted(found, np.zeros(len(found), dtype=np.int64), cells)
        return np.minimum(np.bincount(cell, minlength=int(cells[0])), FULL).astype(np.uint8).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            sets = [shingle_hashes(t, size) for t in block["text"]]
            of = [int(c) for c in shape.classes(np.array([len(s) for s in sets]))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block["doc_id"], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(of, pa.int64()),
                    pa.array([vector(s, c) for s, c in zip(sets, of, strict=True)], pa.binary()),
                    pa.array([vector(s, c - 1) for s, c in zip(sets, of, strict=True)], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["rep", "n", "class", "own", "back", "shingles"],
            )

    return run


def may_link(x: np.ndarray, y: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Whether the summed minima of the counts in the rows of ``x`` and ``y`` reach what is needed.

    A cell that is full on both sides may hold more than it says, so such pairs always pass.
    """
    least = np.minimum(x, y)
    return (least.sum(1, dtype=np.int64) >= needed) | (least.max(1, initial=0) == FULL)


def by_tree(docs: DataFrame) -> DataFrame:
    """(rep, n, tree, counts): a row per document and size class whose trees it can be in."""
    two = F.array(
        F.struct(F.col("class").alias("tree"), F.col("own").alias("counts")),
        F.struct((F.col("class") - 1).alias("tree"), F.col("back").alias("counts")),
    )
    return docs.select("rep", "n", F.inline(two)).where("tree >= 1")


def linked(pairs: DataFrame, docs: DataFrame, shape: Shape) -> DataFrame:
    """Of the pairs (u, v, tree), those whose sets reach the similarity."""

    def met(pairs: DataFrame, frame: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
        # Stored pairs have a known size: where they are few, Spark sends them to the documents and
        # leaves those in place.  Only rows of pairs are dealt out then, both sides by the pair.
        sides = [
            pairs.join(frame.select(F.col("rep").alias(s), *on, *[F.col(c).alias(f"{s}_{c}") for c in columns]), [s, *on])
            for s in ("u", "v")
        ]
        return sides[0].join(sides[1], ["u", "v", *on])

    def bound(batches):
        for batch in pieces(batches):
            held = batch.to_pydict()
            keep = []
            for a, b, na, nb in zip(*[held[c] for c in ("u_counts", "v_counts", "u_n", "v_n")], strict=True):
                x, y = (np.frombuffer(c, np.uint8)[None] for c in (a, b))
                keep.append(bool(may_link(x, y, shape.needed(na, nb))[0]))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    def exact(batches):
        for batch in pieces(batches):
            held = batch.to_pydict()
            keep = []
            for a, b in zip(held["u_shingles"], held["v_shingles"], strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= shape.percent * (len(a) + len(b) - common) and common > 0)
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    seen = met(stored(narrow(pairs), "pairs"), by_tree(docs), ["tree"], ["n", "counts"])
    passed = stored(seen.mapInArrow(bound, "u long, v long"), "passed")
    return met(passed, docs, [], ["shingles"]).mapInArrow(exact, "u long, v long")


def pieces(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes: as Python objects rows take many times that."""
    for batch in batches:
        step = max(1, batch.num_rows * (most or PIECE) // max(batch.nbytes, 1))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


class Pairs:
    """Pairs (u, v, tree) gathered from arrays and given out as batches of no more than some."""

    def __init__(self):
        self.held, self.number = [], 0

    def add(self, i: np.ndarray, k: np.ndarray, tree: int) -> None:
        if len(i):
            self.held.append((np.minimum(i, k), np.maximum(i, k), np.full(len(i), tree)))
            self.number += len(i)

    def out(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.held and (last or self.number >= PAIRS):
            arrays = [np.concatenate(x) for x in zip(*self.held, strict=True)]
            self.held, self.number = [], 0
            for i in range(0, len(arrays[0]), PAIRS):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + PAIRS], pa.int64()) for x in arrays], ["u", "v", "tree"])


def listed(rows: list) -> dict[str, np.ndarray]:
    return {c: np.array([r[c] for r in rows], dtype=np.int64) for c in ("rep", "component")}


def small_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of points of different components, of trees that are a single leaf."""
    pairs = Pairs()
    for batch in pieces(batches):
        for tree, rows in zip(batch.column("tree").to_pylist(), batch.column("held").to_pylist(), strict=True):
            x = listed(rows)
            i, k = np.triu_indices(len(rows), 1)
            apart = x["component"][i] != x["component"][k]
            pairs.add(x["rep"][i[apart]], x["rep"][k[apart]], tree)
            yield from pairs.out()
    yield from pairs.out(last=True)


LEAF_ROW = "key long, tree long, leaf long, only long, reps binary, comps binary, sizes binary, counts binary, most binary, keys binary, owners binary"


def packed_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per leaf: its points, its bounding box and the component that all its points are of, if there is one."""
    for batch in pieces(batches):
        out, only = [], []
        for rows in batch.column("held").to_pylist():
            x = listed(rows)
            counts = np.stack([np.frombuffer(r["counts"], np.uint8) for r in rows])
            full = (counts == FULL).any()
            groups = counts.reshape(len(rows), -1, FINE).sum(2, dtype=np.int32)
            sizes = np.array([r["n"] for r in rows], dtype=np.int64)
            # A box with a full cell is open to all.
            most = np.full_like(groups[0], sizes.max()) if full else groups.max(0)
            keys = np.concatenate([np.array(r["keys"], dtype=np.int64) for r in rows])
            owners = np.repeat(np.arange(len(rows)), [len(r["keys"]) for r in rows])
            only.append(int(x["component"][0]) if (x["component"] == x["component"][0]).all() else None)
            out.append([a.tobytes() for a in (x["rep"], x["component"], sizes, counts, most, keys, owners)])
        own = [batch.column(c) for c in ("key", "tree", "leaf")]
        made = [pa.array(c, pa.binary()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.binary())] * 7
        yield pa.RecordBatch.from_arrays([*own, pa.array(only, pa.int64()), *made], [x.split()[0] for x in LEAF_ROW.split(", ")])


def leaf_pairs(shape: Shape):
    """Opens pairs of leaves whose boxes may hold linked points and bounds the points.

    Points that share several trees are bounded in the one of the smallest key only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Pairs()
        for batch in pieces(batches):
            held = batch.to_pydict()
            for i in range(batch.num_rows):
                a, b = ({k: np.frombuffer(held[f"{s}_{k}"][i], np.int64) for k in ("reps", "comps", "sizes", "keys", "owners")} for s in "ab")
                box = [np.frombuffer(held[f"{s}_most"][i], np.int32) for s in "ab"]
                if np.minimum(*box).sum() < shape.needed(a["sizes"].min(), b["sizes"].min()):
                    continue
                x, y = (np.frombuffer(held[f"{s}_counts"][i], np.uint8).reshape(len(p["reps"]), -1) for s, p in (("a", a), ("b", b)))
                same = held["a_leaf"][i] == held["b_leaf"][i]
                earlier = np.flatnonzero(b["keys"] < held["key"][i])
                earlier = earlier[np.argsort(b["keys"][earlier], kind="stable")]
                keys, owners = b["keys"][earlier], b["owners"][earlier]
                begin = np.searchsorted(a["owners"], np.arange(len(x) + 1))
                for k in range(len(x)):
                    enough = a["comps"][k] != b["comps"]
                    if same:
                        enough[: k + 1] = False
                    if not enough.any():
                        continue
                    mine = a["keys"][begin[k] : begin[k + 1]]
                    for first, last in zip(np.searchsorted(keys, mine), np.searchsorted(keys, mine, "right"), strict=True):
                        enough[owners[first:last]] = False
                    at = np.flatnonzero(enough)
                    at = at[may_link(x[k], y[at], shape.needed(a["sizes"][k], b["sizes"][at]))]
                    pairs.add(np.full(len(at), a["reps"][k]), b["reps"][at], held["tree"][i])
                    yield from pairs.out()
        yield from pairs.out(last=True)

    return run


def tree_join(trees: DataFrame, labels: DataFrame, docs: DataFrame, shape: Shape) -> DataFrame:
    """All pairs (u, v, tree) of a tree that lie in different components, less what the boxes rule out."""
    named = trees.join(labels, "rep")
    spread = (
        named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n_key"))
        .where("lo < hi").select("key", "n_key")
    )
    open_ = stored(named.join(spread, "key"), "open")
    pairs = "u long, v long, tree long"
    single = open_.where(F.col("n_key") <= LEAF).groupBy("key", "tree").agg(F.collect_list(F.struct("rep", "component")).alias("held"))
    met = single.select("tree", "held").mapInArrow(small_trees, pairs)

    large = open_.where(F.col("n_key") > LEAF)
    size = large.groupBy("key", "component").agg(F.count("*").alias("n_comp"))
    # Leaves hold whole components where these are small, slices of them where they are large.
    most = F.when(F.col("tree") <= int(shape.classes(np.array([SHORT]))[0]), WIDE).otherwise(LEAF)
    leaf = F.pmod(F.xxhash64("component"), F.ceil(F.col("n_key") / most).cast("long")) * F.lit(1 << 20) + F.pmod(
        F.xxhash64("rep"), F.least(F.ceil(F.col("n_comp") / most), F.lit(1 << 20)).cast("long")
    )
    # A document is in no more trees than it has groups.
    of = large.groupBy("rep").agg(F.collect_list("key").alias("keys"))
    points_ = large.join(size, ["key", "component"]).join(by_tree(docs), ["rep", "tree"]).join(of, "rep")
    grouped = points_.select("key", "tree", leaf.alias("leaf"), F.struct("rep", "component", "n", "counts", "keys").alias("x"))
    leaves = stored(grouped.groupBy("key", "tree", "leaf").agg(F.collect_list("x").alias("held")).mapInArrow(packed_leaves, LEAF_ROW), "leaves")

    def side(s: str, *more: str) -> DataFrame:
        held = [c for c in leaves.columns if c not in ("key", "tree")]
        return leaves.select("key", *more, *[F.col(c).alias(f"{s}_{c}") for c in held])

    apart = F.coalesce(F.col("a_only") != F.col("b_only"), F.lit(True))
    opened = side("a", "tree").join(side("b"), "key").where("a_leaf <= b_leaf").where(apart).drop("a_only", "b_only")
    return met.union(opened.mapInArrow(leaf_pairs(shape), pairs)).groupBy("u", "v").agg(F.min("tree").alias("tree"))


def rarest(held: DataFrame) -> DataFrame:
    """(key, rep, tree, holders): of the shared keys (key, n_key, h1, rep, own, back), those among which linked documents must meet.

    A set's keys stand in one order for all sets, the rarest first; ``own`` and ``back`` say
    how many at the end of it can be left out.
    """
    of_tree = Window.partitionBy("h1", "h2", "tree")
    is_own = F.col("tree") == F.col("own").bitwiseAND(255)
    spare = F.when(is_own, F.shiftright("own", 8)).otherwise(F.col("back"))
    ranked = held.withColumn("tree", F.col("key").bitwiseAND(255)).select(
        "*", F.row_number().over(of_tree.orderBy("n_key", "key")).alias("nth"), F.count("*").over(of_tree).alias("n_tree")
    )
    # Each of them is used twice, so they are written rather than ranked again.
    kept = stored(ranked.where(F.col("nth") <= F.col("n_tree") - spare).select("key", "rep", "tree"), "kept")
    several = kept.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count("*").alias("holders"))
    # An id with several texts may hold a key more than once.
    return kept.join(several.where("lo < hi").select("key", "holders"), "key").dropDuplicates(["key", "rep", "tree"])


def star_pairs(trees: DataFrame, labels: DataFrame, round_: int) -> DataFrame:
    """(u, v, tree): each component with the few documents of others it shares most trees with.

    Every tree offers one document, another in each round, so the pairs are in proportion to the components.
    """
    named = trees.join(labels, "rep")
    lot = F.xxhash64("rep", "key", F.lit(round_))
    pivot = named.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.max_by(F.struct("rep", "component"), lot).alias("pivot")
    ).where("lo < hi").select("key", F.col("pivot.rep").alias("u"), F.col("pivot.component").alias("other"))
    votes = named.join(pivot, "key").where("component <> other").groupBy("component", "u", "rep", "tree").agg(F.count("*").alias("votes"))
    # Where several share as many trees, each component takes others, as one document may be linked with few.
    order = Window.partitionBy("component").orderBy(F.desc("votes"), F.xxhash64("component", "u", F.lit(round_)), "u", "rep", "tree")
    best = votes.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= (1 if round_ == 0 else OFFERS))
    return best.select("u", F.col("rep").alias("v"), "tree")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (rep, component) after the components that ``links`` (u, v) connect become one."""
    of = {s: labels.select(F.col("rep").alias(s), F.col("component").alias(f"{s}_of")) for s in "uv"}
    between = links.join(of["u"], "u").join(of["v"], "v").select(F.col("u_of").alias("u"), F.col("v_of").alias("v"))
    joined = components(between).select(F.col("node").alias("component"), F.col("component").alias("to"))
    return stored(narrow(labels.join(joined, "component", "left").select("rep", F.coalesce("to", "component").alias("component"))), "labels")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the size of its set, the smallest id reachable by links."""
    spark = docs.sparkSession
    shape = Shape(percent)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    buckets = 4 * partitions(spark)
    packed = texts.mapInArrow(tree_rows(shape, shingle, buckets, by_set=True), ROW)
    found = stored(packed.repartition(partitions(spark), "bucket").mapInArrow(shared_rows, FOUND), "trees")
    names = {"a": "doc_id", "b": "n", "c": "h1", "d": "h2", "e": "spare_own", "f": "spare_back"}
    info = found.where("kind = 'doc'").select(*[F.col(c).alias(name) for c, name in names.items()])
    # Copies that emitted no keys say that no key may be left out; those that did know better.
    classes = info.where("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.max("spare_own").alias("own"), F.max("spare_back").alias("back"), F.first("n").alias("n")
    )
    members = found.where("kind = 'member'").select(F.col("a").alias("key"), F.col("b").alias("h1"), F.col("c").alias("n_key"))
    trees = stored(rarest(members.join(classes.drop("n"), "h1")), "rarest")
    nodes = stored(narrow(trees.select("rep").distinct()), "nodes")
    chosen = texts.join(nodes, texts.doc_id == nodes.rep, "left_semi")
    columns = "rep long, n long, class long, own binary, back binary, shingles binary"
    # An id with several texts is a point for each of them.
    vectors = stored(chosen.mapInArrow(points(shape, shingle), columns).dropDuplicates(["rep", "shingles"]), "points")

    # Similar documents share most of their trees, so some of the trees are enough to connect most of them.
    # In large trees the pairs that these rounds leave grow with the square of a component, so all of those take part.
    lot = F.pmod(F.xxhash64("key"), F.lit(SOME)) == 0
    some = [stored(trees.where(which), "some") for which in (lot, lot | (F.col("holders") > LEAF))]
    labels = nodes.select("rep", F.col("rep").alias("component"))
    enough = nodes.count() // FEW
    for round_ in range(ROUNDS):
        new = stored(linked(star_pairs(some[min(round_, 1)], labels, round_), vectors, shape), "links")
        labels = merged(labels, new)
        # Where a round finds few links there are few components left to connect.
        if new.count() <= enough:
            break
    labels = merged(labels, stored(linked(tree_join(trees.drop("holders"), labels, vectors, shape), vectors, shape), "links"))

    final = classes.join(labels, "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("smallest"))
    return info.join(final, ["h1", "h2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **shape) -> DataFrame:
    """``docs`` with one document, the smallest id, of each component; rows without an id stay."""
    found = near_components(docs, id_col, text_col, **shape).where("component_id <> doc_id").select(
        F.col("doc_id").alias(id_col)
    ).distinct()
    return docs.join(found, id_col, "left_anti")
