"""Components of texts that share band keys, with every link verified.

Used where copies are collapsed already, so that all texts differ. No bucket
is capped, pairs of items are rows only in buckets of a few, and every link that
decides a component is confirmed on the full shingle sets of both texts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.common import arrow, keep, keep_counted, keep_sized, sized
from quill.llm.graph import components
from quill.llm.texts import overlap

Shingle = Callable[[str], np.ndarray]     # text -> sorted distinct hashes
# texts -> their hashes one after the other, in any order and with repeats, and how many each has
Shingles = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
BLOCK = 128                               # texts per block, at most about
FEW = 16                                  # a bucket of more single items is compared in blocks
AT_ONCE = 1 << 17                         # characters of pairs compared at once
BLOCK_BYTES = 32 << 20                    # their UTF-8 bytes; a longer text is a block of its own or nearly so


def buckets(items: DataFrame) -> DataFrame:
    """``items(id, keys)`` -> ``(key, id, centre)`` for keys of two items or more;
    the centre is the bucket's smallest id. Items must be kept."""
    rows = items.select("id", F.explode("keys").alias("key"))
    # partial aggregation, then a join whose sides are plain shuffles: a key that
    # very many items share is split by AQE
    _, hot, _ = keep_sized(rows.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("top"))
                           .filter("centre < top").select("key", "centre"))
    return keep(rows.join(hot, "key"))


def _pairs(shingle: Shingle, share: int, whole: int, most: Callable[[str], int] | None):
    """``(a, b, ta, tb)`` -> ``(a, b, link)``; equal neighbours in ``a`` share their
    set. ``most`` bounds a text's set size: too small a set is not built."""
    def run(batches):
        last, sa = None, None
        for b in batches:
            link = []
            for a, ta, tb in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if a != last:
                    last, sa = a, shingle(ta)
                if most and most(tb) * whole < len(sa) * share:
                    link.append(False)
                    continue
                sb = shingle(tb)
                both = overlap(sa, sb)
                link.append(both * whole >= (len(sa) + len(sb) - both) * share)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(link, pa.bool_())],
                                             ["a", "b", "link"])
    return run


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def _linked(shingles: Shingles, share: int, whole: int, most: Callable[[str], int] | None,
            left: list[str], own: np.ndarray, right: list[str]) -> np.ndarray:
    """Whether ``left[own[p]]`` and ``right[p]`` are linked, for all pairs p. The
    sets of all are sorted together: a pair's or text's number takes the upper
    bits of a key, as many bits as that needs, and a hash's upper bits the rest."""
    top = np.uint64(len(right).bit_length())
    bits = np.uint64(64) - top

    def sets(texts: list[str]):
        h, size = shingles(texts)
        key = np.repeat(np.arange(len(texts), dtype=np.uint64) << bits, size) | (h >> top)
        key.sort()
        key = key[np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]])]
        return key & ((np.uint64(1) << bits) - np.uint64(1)), np.bincount((key >> bits).astype(np.int64), minlength=len(texts))

    ha, na = sets(left)
    link = np.zeros(len(right), bool)
    # no link if a set is too small for the other one: such pairs go no further
    p = np.arange(len(right))
    if most:
        p = p[np.array([most(x) for x in right]) * whole >= na[own] * share]
    if not len(p):
        return link
    hb, nb = sets([right[k] for k in p])
    at, na = (np.cumsum(na) - na)[own[p]], na[own[p]]
    fit = np.minimum(na, nb) * whole >= np.maximum(na, nb) * share
    p, at, na, bt, nb = p[fit], at[fit], na[fit], (np.cumsum(nb) - nb)[fit], nb[fit]
    number = np.arange(len(p), dtype=np.uint64) << bits
    key = np.concatenate([np.repeat(number, na) | ha[_ranges(at, na)], np.repeat(number, nb) | hb[_ranges(bt, nb)]])
    key.sort()
    both = np.bincount((key[1:][key[1:] == key[:-1]] >> bits).astype(np.int64), minlength=len(p))
    link[p] = both * whole >= (na + nb - both) * share
    return link


def _many_pairs(shingles: Shingles, share: int, whole: int, most: Callable[[str], int] | None):
    """``_pairs`` with about ``AT_ONCE`` characters of either side's texts compared
    at a time. Equal neighbours in ``a`` share their set."""
    def run(batches):
        for b in batches:
            links, left, own, right = [np.zeros(0, bool)], [], [], []
            of_left = of_right = 0
            last = None
            for a, ta, tb in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                new = a != last
                if right and (of_right + len(tb) > AT_ONCE or new and of_left + len(ta) > AT_ONCE):
                    links.append(_linked(shingles, share, whole, most, left, np.array(own), right))
                    left, own, right = [], [], []
                    of_left = of_right = 0
                if new or not left:
                    left.append(ta)
                    of_left += len(ta)
                    last = a
                own.append(len(left) - 1)
                right.append(tb)
                of_right += len(tb)
            if right:
                links.append(_linked(shingles, share, whole, most, left, np.array(own), right))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.concatenate(links))],
                                             ["a", "b", "link"])
    return run


def _blocks(shingle: Shingle, share: int, whole: int):
    """Rows ``(single, left, right)`` of two blocks of ``(id, label, text)`` -> links
    that connect them, never all of them. The right block belongs to one
    component: one link per label on the left is enough. Or (``single``) both
    hold items of any labels: a spanning forest of the labels.

    One inverted index per right block counts the overlaps of a text with all of
    it at once."""
    def run(batches):
        for batch in batches:
            found: tuple[list, list] = ([], [])
            for row in batch.to_pylist():
                ids, labels = [x["id"] for x in row["right"]], [x["label"] for x in row["right"]]
                sets = [shingle(x["text"]) for x in row["right"]]
                size = np.array([len(s) for s in sets])
                owner = np.repeat(np.arange(len(sets)), size)
                flat = np.concatenate(sets)
                order = np.argsort(flat, kind="stable")
                flat, owner = flat[order], owner[order]
                root: dict[int, int] = {}

                def top(x: int) -> int:
                    while root.setdefault(x, x) != x:
                        x = root[x]
                    return x

                for x in row["left"]:
                    if not row["single"] and x["label"] in root:
                        continue                 # its component is connected already
                    if row["single"] and {top(y) for y in labels} == {top(x["label"])}:
                        continue                 # with all of the block
                    s = shingle(x["text"])
                    lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
                    n = hi - lo
                    at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    both = np.bincount(owner[at], minlength=len(sets))
                    hits = np.nonzero(both * whole >= (size + len(s) - both) * share)[0]
                    for k in hits if row["single"] else hits[:1]:
                        y = ids[k]
                        if row["single"]:
                            u, v = top(x["label"]), top(labels[k])
                            if u == v:
                                continue
                            root[u] = v
                        else:
                            root[x["label"]] = y
                        found[0].append(min(x["id"], y))
                        found[1].append(max(x["id"], y))
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in found], ["a", "b"])
    return run


def _block_pairs(side: DataFrame, texts: DataFrame, single: bool) -> DataFrame:
    """``side(c, left, id, label)`` -> rows of ``_blocks``: per ``c``, the blocks of
    the left side with those of the right side (``single``: of one side with
    each other). Items are dealt to blocks by hash, to as many as keep a block
    at about ``BLOCK`` texts and ``BLOCK_BYTES`` of text."""
    side = keep(side.join(texts.select("id", F.octet_length("text").cast("long").alias("bytes")), "id"))
    _, parts, _ = keep_sized(side.groupBy("c", "left").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("parts")), 32)
    block = keep(side.drop("bytes").join(parts, ["c", "left"]).join(texts, "id")
                 .groupBy("c", "left", F.pmod(F.xxhash64("id"), "parts").alias("part"))
                 .agg(F.collect_list(F.struct("id", "label", "text")).alias("rows")))
    # the list of block pairs first, so that blocks are joined by their own key
    # and a component of very many blocks is dealt over all tasks
    have = block.select("c", "left", "part")
    l, r = have.filter("left").alias("l"), have.filter("left" if single else "not left").alias("r")
    todo = (l.join(r, F.col("l.c") == F.col("r.c")).filter("l.part <= r.part" if single else "true")
            .select("l.c", F.col("l.part").alias("lp"), F.col("r.part").alias("rp")))
    lrows = block.filter("left").select("c", F.col("part").alias("lp"), F.col("rows").alias("left"))
    rrows = (block.filter("left" if single else "not left")
             .select("c", F.col("part").alias("rp"), F.col("rows").alias("right")))
    return (todo.join(lrows, ["c", "lp"]).join(rrows, ["c", "rp"])
            .select(F.lit(single).alias("single"), "left", "right"))


def clusters(bucket: DataFrame, texts: DataFrame, shingle: Shingle, share: int, whole: int,
             most: Callable[[str], int] | None = None, shingles: Shingles | None = None) -> DataFrame:
    """``(id, low)``: the smallest id reachable over links with ``whole *
    intersection >= share * union``, for items where that is another id.

    1. star: every item of a bucket is compared with the bucket's centre;
    2. verified links give components; a bucket inside one component is done;
    3. in other buckets, the items outside the largest component are compared
       with all members of it and, where their components differ, with each
       other. So an item is one row a bucket, however many components meet in
       it. Both sides are cut into blocks of about ``BLOCK`` texts; a task
       compares two blocks and returns as many links as it takes to connect
       them, so the rows of a bucket of n items are (n / BLOCK)^2 pairs of
       blocks and at most n - 1 links. Only of ``FEW`` items at most, the pairs
       themselves are rows: no more than FEW / 2 an item;
    4. components again, over the graph contracted by the first ones.

    A step that has no rows is left out: where the star has linked all there is to
    link, nothing of 3 and 4 runs.

    ``most`` bounds a text's set size. ``shingles`` is ``shingle`` for many texts:
    pairs of short texts are then compared together.
    """
    ta = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")
        compare = _many_pairs(shingles, share, whole, most) if shingles else _pairs(shingle, share, whole, most)
        return (arrow(both, compare, "a long, b long, link boolean")
                .filter("link").select("a", "b"))

    star = verify(bucket.filter("id <> centre")
                  .select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct())
    comp = keep(components(star))
    _, size, _ = keep_sized(comp.groupBy("comp").agg(F.count(F.lit(1)).alias("size")))
    label = keep(comp.join(size, "comp").select(F.col("node").alias("id"), F.col("comp").alias("label"), "size"))

    at = (bucket.join(label, "id", "left")
          .select("key", "id", F.coalesce("label", "id").alias("label"), F.coalesce("size", F.lit(1)).alias("size")))
    _, split, n_split = keep_sized(
        at.groupBy("key").agg(F.min("label").alias("l0"), F.max("label").alias("l1"),
                              F.max(F.struct("size", "label")).alias("top"))
        .filter("l0 < l1").select("key", F.col("top.size").alias("top"), F.col("top.label").alias("host")), 32)
    starred = comp.select(F.col("node").alias("id"), F.col("comp").alias("low")).filter("low <> id")
    if not n_split:
        return starred
    open_ = keep(at.join(split, "key").select("key", "id", "label", "top", "host"))

    # items beside the largest component of their bucket
    blocks = []
    meets, n = keep_counted(open_.filter("top > 1 and label <> host")
                            .select(F.col("host").alias("c"), F.lit(True).alias("left"), "id", "label").distinct(),
                            rows=F.count(F.lit(1)))
    if n["rows"]:
        _, hosts, _ = keep_sized(meets.select(F.col("c").alias("comp")).distinct())
        side = meets.unionByName(comp.join(hosts, "comp").select(
            F.col("comp").alias("c"), F.lit(False).alias("left"), F.col("node").alias("id"), F.col("comp").alias("label")))
        blocks.append(_block_pairs(side, texts, single=False))
    # these items with each other, and those of buckets without a component, where the
    # star has not compared them all. Buckets of the same items (copies agree in
    # several bands) are compared once
    lone = (open_.filter("top = 1 or label <> host")
            .select(F.col("key").alias("c"), F.lit(True).alias("left"), "id", "label", "top"))
    several = keep(lone.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.max("top").alias("top"),
                                         F.min("label").alias("l0"), F.max("label").alias("l1"),
                                         F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s"),
                                         F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("x"))
                   .filter("l0 < l1 and (n > 2 or top > 1)")
                   .groupBy("n", "s", "x").agg(F.min("c").alias("c")).select("c", "n"))
    _, many, n_many = keep_sized(several.filter(F.col("n") > FEW).select("c"))
    if n_many:
        blocks.append(_block_pairs(lone.drop("top").join(many, "c"), texts, single=True))
    met = [arrow(reduce(DataFrame.unionByName, blocks), _blocks(shingle, share, whole), "a long, b long")] if blocks else []

    # few items: their pairs, at most FEW / 2 rows an item, each pair once over all
    # buckets, and without what the star has compared
    _, short, n_short = keep_sized(several.filter(F.col("n") <= FEW).select("c"))
    if n_short:
        few = lone.select("c", "id", "label").join(short, "c")
        other = few.select("c", F.col("id").alias("other"), F.col("label").alias("its"))
        pair = (few.join(other, "c").filter("id < other and label <> its")
                .select(F.col("id").alias("a"), F.col("other").alias("b")).distinct()
                .join(bucket.select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(), ["a", "b"], "left_anti"))
        met.append(verify(pair))
    if not met:
        return starred
    near, n = keep_counted(reduce(DataFrame.unionByName, met).distinct(), rows=F.count(F.lit(1)))
    if not n["rows"]:
        return starred

    la = comp.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    lb = comp.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    joined = (near.join(la, "a", "left").join(lb, "b", "left")
              .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    merged, final, _ = keep_sized(components(joined))
    final = final.select(F.col("node").alias("label"), F.col("comp").alias("top"))
    alone = merged.join(comp, "node", "left_anti").select("node", F.col("node").alias("label"))
    return keep(comp.select("node", F.col("comp").alias("label")).unionByName(alone)
                .join(final, "label", "left")
                .select(F.col("node").alias("id"), F.coalesce("top", "label").alias("low"))
                .filter("low <> id"))
