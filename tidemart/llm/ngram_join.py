"""Similarity join of documents on word n-grams by chosen paths."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemart.llm.common import components, documents, stored

WORDS, SIMILARITY = 5, 0.8
# Tokens a set chooses per node of its path tree, on average, and levels of the tree.
CHOICES, DEPTH = 1.25, 3
TARGET_RECALL = 0.9975


def run_recall(depth: int = DEPTH, shared: float = CHOICES * SIMILARITY) -> float:
    """Chance that a run finds a pair at the threshold by paths of `depth` levels, at least. The pair shares `shared`
    choices per node on average if one set holds the other, more if not: 0.63 at the first level, 0.37 at the third."""
    found = 1.0
    for _ in range(depth):
        found = 1 - math.exp(-shared * found)
    return found


# Runs are repeated until pairs that need all levels reach the target recall: thirteen.
RUN_RECALL = run_recall()
RUNS = math.ceil(math.log(1 - TARGET_RECALL) / math.log(1 - RUN_RECALL))
BUCKET_ROWS = 512  # buckets up to here are compared at once
SET_BLOCK, TOKEN_BLOCK = 1024, 1 << 21  # sets of one group, and n-grams of them, that are compared at once
REPRESENTATIVES = 8  # sets that all members of a larger group are measured against
CORE = 1 - (1 - SIMILARITY) / 2  # two sets this close to a third one are linked, as 1 - Jaccard is a metric
SKETCH_BINS = 64
SKETCH_LEAST = 0.55  # five standard deviations below the threshold
UNSHARED = (1 - SIMILARITY) / (1 + SIMILARITY)  # n-grams of one set only, at most, by the sum of both sizes
_WORD = re.compile(r"\w+")
_KEPT_WORDS = 200_000
_MASK = (1 << 64) - 1


class _Hashes(dict):
    """Hashes of words, a bounded table."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted different values."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


class Shingler:
    """Sets of hashed n-grams. Words are runs of letters, digits and _ in lower case. A text of fewer words has
    one n-gram of all of them."""

    def __init__(self, words: int = WORDS):
        self.words, self._kept = words, _Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted different 64-bit values."""
        words = _WORD.findall(text.lower()) if text else []
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self._kept.__getitem__, words), np.uint64, len(words))
        length = min(self.words, len(words))
        count = len(words) - length + 1
        mixed = np.full(count, length, np.uint64)
        for i in range(length):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + count]
            mixed ^= mixed >> np.uint64(29)
        return distinct(mixed * np.uint64(0xD6E8FEB86659FD93))


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def chosen_paths(tokens: np.ndarray, runs: int = RUNS, depth: int = DEPTH,
                 choices: float = CHOICES) -> list[tuple[np.ndarray, np.ndarray]]:
    """(parent path, path) arrays per level. A run is a root; each path chooses the tokens whose hash with
    that path is below choices / size, so sets that share a path and a chosen token share the next path."""
    paths = _mix(np.arange(1, runs + 1, dtype=np.uint64))
    levels, size = [], len(tokens)
    border = np.uint64(min(_MASK, int(choices / max(size, 1) * 2.0 ** 64)))
    step = max(1, (1 << 20) // max(size, 1))
    for _ in range(depth):
        picked = [np.empty(0, np.int64)]
        for start in range(0, len(paths), step):
            part = paths[start:start + step, None]
            rows = tokens * (part | np.uint64(1)) + part  # high bits: all of a token
            picked.append(np.flatnonzero(rows <= border) + start * size)
        at, token = np.divmod(np.concatenate(picked), max(size, 1))
        parents = paths[at]
        paths = _mix(parents + _mix(tokens[token]))
        levels.append((parents, paths))
    return levels


def sketch(tokens: np.ndarray) -> bytes:
    """One-permutation sketch: 16 bits of the least value in each of 64 ranges of hashes, 0 for an empty one."""
    edges = np.arange(SKETCH_BINS, dtype=np.uint64) << np.uint64(58)
    mixed = np.sort(_mix(tokens))
    first = np.searchsorted(mixed, edges)
    ends = np.append(first[1:], len(mixed))
    values = np.zeros(SKETCH_BINS, np.uint16)
    full = first < ends
    values[full] = (mixed[first[full]] & np.uint64(0xFFFF)).astype(np.uint16) | np.uint16(1)
    return values.tobytes()


_PATHS = pa.list_(pa.struct([("parent", pa.int64()), ("path", pa.int64())]))
_MARKS = pa.schema([("row_id", pa.int64()), ("doc_id", pa.int64()), ("row_key", pa.binary()),
                    ("k1", pa.int64()), ("k2", pa.int64()), ("size", pa.int32()), ("sketch", pa.binary()),
                    *((f"level{i + 1}", _PATHS) for i in range(DEPTH))])
_MARK_COLUMNS = ("row_id long, doc_id long, row_key binary, k1 long, k2 long, size int, sketch binary, "
                 + ", ".join(f"level{i + 1} array<struct<parent:long,path:long>>" for i in range(DEPTH)))


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingles = Shingler()
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column("text")]
        ids = batch.column("row_id").to_numpy()
        keys = [(int(i), -1) if not len(s) else
                tuple(xxh64_intdigest(s.tobytes(), seed) - (1 << 63) for seed in (1, 2))
                for i, s in zip(ids, sets, strict=True)]
        levels = [chosen_paths(s) if len(s) else
                  [(np.empty(0, np.uint64), np.empty(0, np.uint64))] * DEPTH for s in sets]
        columns = []
        for at in range(DEPTH):
            counts = [len(level[at][1]) for level in levels]
            flat = [np.concatenate([level[at][side] for level in levels]).view(np.int64)
                    if levels else np.empty(0, np.int64) for side in (0, 1)]
            columns.append(pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *counts]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(f) for f in flat], ["parent", "path"])))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), batch.column("doc_id"), batch.column("row_key"),
             pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
             pa.array([len(s) for s in sets], pa.int32()),
             pa.array([sketch(s) if len(s) else b"" for s in sets], pa.binary()), *columns],
            schema=_MARKS)


def row_key(docs: DataFrame) -> Column:
    """Rows of equal id and text have one key, of 128 bits."""
    text = F.when(docs["text"].isNull(), "-").otherwise(F.concat(F.lit("+"), docs["text"]))
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(docs["doc_id"].cast("long").cast("string"), F.lit("")), text)))


def marks(docs: DataFrame) -> DataFrame:
    """One small row per document: keys of its set, size, sketch and the paths of all levels. Stored."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"),
                       docs["doc_id"].cast("long").alias("doc_id"), row_key(docs).alias("row_key"),
                       docs["text"].alias("text"))
    return stored(rows.mapInArrow(_mark, _MARK_COLUMNS), "marks")


def _local_components(count: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Least member of each member's component."""
    label = np.arange(count)
    if not pairs:
        return label
    a = np.concatenate([p[0] for p in pairs])
    b = np.concatenate([p[1] for p in pairs])
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _units(rows: DataFrame, few: int) -> DataFrame:
    """(group, node, unit, side) from rows (group, blocks, node): what one task compares.

    Groups of one block share `few` units. A larger group is cut in blocks by a
    hash of the node and has a unit for each two blocks: side 1 meets side 2, side 0 itself.
    """
    mine = F.pmod(F.xxhash64(F.lit(13), "node"), F.col("blocks"))
    one, two = F.least("mine", "other"), F.greatest("mine", "other")
    shared = F.pmod(F.xxhash64("group"), F.lit(max(1, few)))
    return (rows.withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select("group", "node",
                    F.when(F.col("blocks") == 1, shared).otherwise(F.xxhash64("group", one, two)).alias("unit"),
                    F.when(F.col("mine") == F.col("other"), 0)
                    .when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side")))


def _core(rows: DataFrame, payload: Callable[[DataFrame], DataFrame],
          alike: Callable[[pd.DataFrame], pd.DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(members, groups) from rows (group, blocks, node) of large groups.

    Each member is measured once, against a few representatives of its group, those with the least hashes.
    The one that most members are alike to is the hub, these members are the core. members: group, node, core, hub, blocks,
    n, n_core; groups: a row each. `payload` adds what `alike` reads to rows with a node; `alike` gets a block of members
    (`rep` -1) and the representatives and returns group, node and a bit per representative.
    """
    reps = stored(rows.groupBy("group", "blocks").agg(F.array_distinct(F.array(*[
        F.min_by("node", F.xxhash64(F.lit(s), "node")) for s in range(REPRESENTATIVES)])).alias("reps")), "reps")
    own = F.pmod(F.xxhash64(F.lit(13), "node"), F.col("blocks"))
    members = rows.select("group", "node", own.alias("block"), F.lit(-1).alias("rep"))
    shown = reps.select("group", "reps", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias(
        "block")).select("group", "block", F.posexplode("reps").alias("rep", "node"))
    measured = stored(payload(members.unionByName(shown)).groupBy("group", "block").applyInPandas(
        lambda frame: alike(frame), "group long, node long, bits int"), "measured")
    counts = measured.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.array(*[
        F.sum(F.shiftright("bits", s).bitwiseAND(F.lit(1))) for s in range(REPRESENTATIVES)]).alias("hits"))
    best = (F.array_position("hits", F.array_max("hits")) - 1).cast("int")
    groups = stored(counts.withColumn("best", best).join(reps, "group").select(
        "group", "blocks", "n", "best", F.array_max("hits").alias("n_core"), F.get("reps", F.col("best")).alias("hub")),
        "cores")
    core = F.expr("shiftright(bits, best)").bitwiseAND(F.lit(1)) == 1
    return measured.join(groups, "group").select(
        "group", "node", core.alias("core"), "hub", "blocks", "n", "n_core"), groups


def _open_units(members: DataFrame) -> DataFrame:
    """Units as of `_units` for the pairs of a group that are not both in its core."""
    share = F.col("n_core") / F.col("n")
    members = members.filter("n_core < n").withColumns({
        "inner": F.greatest(F.ceil(share * F.col("blocks")), F.lit(1).cast("long")),
        "outer": F.greatest(F.ceil((1 - share) * F.col("blocks")), F.lit(1).cast("long"))})
    loose = members.filter("not core")
    cross = []
    for rows, mine, other, side in ((loose, "outer", "inner", 1), (members.filter("core"), "inner", "outer", 2)):
        at = F.pmod(F.xxhash64(F.lit(17), "node"), F.col(mine))
        to = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        rows = rows.select("group", "node", at.alias("at"), to.alias("to"))
        pair = ("at", "to") if side == 1 else ("to", "at")
        cross.append(rows.select("group", "node", F.xxhash64(F.lit("x"), "group", *pair).alias("unit"),
                                 F.lit(side).alias("side")))
    among = _units(loose.select("group", F.col("outer").alias("blocks"), "node"), 64)
    return among.unionByName(cross[0]).unionByName(cross[1])


def _groups(frame: pd.DataFrame, name: str) -> Iterator[np.ndarray]:
    order = np.argsort(frame[name].to_numpy(), kind="stable")
    values = frame[name].to_numpy()[order]
    for part in np.split(order, np.flatnonzero(values[1:] != values[:-1]) + 1):
        if len(part) > 1:
            yield part


def _linked(nodes: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(node, hub) of the nodes in pairs; the hub is the least node of the component."""
    order = np.argsort(nodes, kind="stable")
    rank = np.empty(len(nodes), int)
    rank[order] = np.arange(len(nodes))
    label = _local_components(len(nodes), [(rank[a], rank[b]) for a, b in pairs])
    touched = np.unique(np.concatenate([np.concatenate(p) for p in pairs]))
    return nodes[touched], nodes[order][label[rank[touched]]]


def _near(table: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether sketches are close enough, a matrix. Bins of small sets are too few to estimate by, their pairs go by a
    bound: a bin differs only by an n-gram of one of the two sets, and a pair at the threshold has few of these."""
    small = np.minimum(sizes[left][:, None], sizes[right][None, :])
    large = np.maximum(sizes[left][:, None], sizes[right][None, :])
    near = small >= SIMILARITY * large - 1e-9
    i, j = near.nonzero()
    small, large = small[i, j], large[i, j]
    mine, yours = table[left[i]], table[right[j]]
    differ = (mine != yours).sum(axis=1)
    same = SKETCH_BINS - ((mine | yours) == 0).sum(axis=1) - differ
    near[i, j] = np.where(small < SKETCH_BINS, differ <= UNSHARED * (small + large) + 1e-9,
                          same >= SKETCH_LEAST * (same + differ))
    return near


def _sketches(frame: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(frame["sketch"]), np.uint16).reshape(len(frame), SKETCH_BINS)


def _alike(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Pairs of a bucket whose sketches are close enough, as (node, hub) of their components."""
    sizes, nodes, sides = (frame[c].to_numpy() for c in ("size", "node", "side"))
    table = _sketches(frame)
    found = [(np.empty(0, "int64"), np.empty(0, "int64"))]
    for part in _groups(frame, "group"):
        if sides[part].any():
            left, right = part[sides[part] == 1], part[sides[part] == 2]
        else:
            left = right = part
        pairs = []
        for start in range(0, len(left), 64):
            some = left[start:start + 64]
            near = _near(table, sizes, some, right) & (nodes[some][:, None] != nodes[right][None, :])
            i, j = near.nonzero()
            if len(i):
                pairs.append((some[i], right[j]))
        if pairs:
            members = np.unique(np.concatenate([np.concatenate(p) for p in pairs]))
            found.append(_linked(nodes[members], [
                (np.searchsorted(members, a), np.searchsorted(members, b)) for a, b in pairs]))
    return pd.DataFrame({"node": np.concatenate([f[0] for f in found]),
                         "hub": np.concatenate([f[1] for f in found])})


def _bits(frame: pd.DataFrame, alike: np.ndarray) -> pd.DataFrame:
    """One bit per representative from a matrix members x representatives (rows of the frame, in order)."""
    member, reps = (frame["rep"] < 0).to_numpy(), frame["rep"].to_numpy()[(frame["rep"] >= 0).to_numpy()]
    bits = (alike.astype(np.int64) << reps[None, :].astype(np.int64)).sum(axis=1)
    return frame.loc[member, ["group", "node"]].assign(bits=bits.astype(np.int32))


def _alike_reps(frame: pd.DataFrame) -> pd.DataFrame:
    member = (frame["rep"] < 0).to_numpy()
    return _bits(frame, _near(_sketches(frame), frame["size"].to_numpy(), member.nonzero()[0], (~member).nonzero()[0]))


def candidates(nodes: DataFrame) -> DataFrame:
    """(node, hub): nodes that a bucket of some path finds alike by sketch.

    A path's bucket of up to `BUCKET_ROWS` sets is compared. In a larger one each set meets a few representatives
    first: the sets alike to the most common one are its core and together in any case. If that are all, the bucket is
    done; else its sets go on to their paths of the next level. At the last level the sets outside the core are compared
    with all others in blocks, so none is left out; only there the cost is more than a constant per set.
    """
    sketches = nodes.select("node", "size", "sketch")
    links, small, beyond = [], [], None
    for level in range(1, DEPTH + 1):
        rows = nodes.select("node", F.explode(f"level{level}").alias("p")).select("node", "p.parent", "p.path")
        if beyond is not None:
            rows = stored(rows.join(beyond.select(F.col("group").alias("parent")), "parent", "left_semi"), "paths")
        rows = rows.select("node", F.col("path").alias("group"))
        counts = stored(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
        small.append(rows.join(counts.filter(F.col("n") <= BUCKET_ROWS), "group").select(
            "group", F.lit(1).cast("long").alias("blocks"), "node"))
        large = counts.filter(F.col("n") > BUCKET_ROWS).select(
            "group", F.ceil(F.col("n") / BUCKET_ROWS).alias("blocks"))
        if large.isEmpty():
            break
        members, groups = _core(rows.join(large, "group"), lambda r: r.join(sketches, "node"), _alike_reps)
        links.append(members.filter("core").select("node", "hub"))
        beyond = groups.filter("n_core < n")
        if level == DEPTH:
            links.append(_open_units(members).join(sketches, "node").groupBy("unit").applyInPandas(
                _alike, "node long, hub long"))
    rows = small[0]
    for part in small[1:]:
        rows = rows.unionByName(part)
    rows = stored(rows, "paths")
    out = _units(rows, rows.count() // 4096).join(sketches, "node").groupBy("unit").applyInPandas(
        _alike, "node long, hub long")
    for part in links:
        out = out.unionByName(part)
    return out.distinct()


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets `left` with sets `right`, a matrix."""
    sizes = np.array([len(s) for s in sets])
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column, minlength=len(tokens)) > 1  # others are in one set only
    place = np.where(shared, np.cumsum(shared) - 1, -1)[column]
    owner = np.repeat(np.arange(len(sets)), sizes)[place >= 0]
    place = place[place >= 0]
    common = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(shared.sum()), 4096):
        now = (place >= start) & (place < start + 4096)
        table = np.zeros((len(sets), 4096), np.float32)
        table[owner[now], place[now] - start] = 1
        common += table[left] @ table[right].T
    return common


def _similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    sizes = np.array([len(s) for s in sets], float)
    common = _common(sets, left, right)
    return common >= least * (sizes[left][:, None] + sizes[right][None, :] - common) - 1e-9


def _verify(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Exact similarities within the groups of a unit: links per node and (node, hub) of components."""
    shingles = Shingler()
    nodes, sides = frame["node"].to_numpy(), frame["side"].to_numpy()
    out = [(np.empty(0, "int64"),) * 3]
    for part in _groups(frame, "group"):
        sets = [shingles(t) for t in frame["text"].iloc[part]]
        every = np.arange(len(part))
        link = _similar(sets, every, every, SIMILARITY)
        np.fill_diagonal(link, False)
        if sides[part].any():
            link &= sides[part][:, None] != sides[part][None, :]
        i, j = link.nonzero()
        if not len(i):
            continue
        linked, hubs = _linked(nodes[part], [(i, j)])
        counts = dict(zip(nodes[part].tolist(), link.sum(axis=1).tolist(), strict=True))
        out.append((linked, hubs, np.array([counts[n] for n in linked.tolist()], "int64")))
    return pd.DataFrame({c: np.concatenate([o[k] for o in out])
                         for k, c in enumerate(("node", "hub", "n_links"))})


def _close_reps(frame: pd.DataFrame) -> pd.DataFrame:
    """Members within half the allowed distance of a representative."""
    shingles = Shingler()
    member = (frame["rep"] < 0).to_numpy()
    sets = [shingles(t) for t in frame["text"]]
    return _bits(frame, _similar(sets, member.nonzero()[0], (~member).nonzero()[0], CORE))


def _links(docs: DataFrame, own: DataFrame, near: DataFrame) -> DataFrame:
    """(node, hub, n_links) of candidate groups (node, component), by exact comparison.

    Two sets within half the allowed distance of a representative are linked for certain, so in a large group
    the core of such sets is counted without meeting; pairs with a set outside it are compared in blocks.
    Blocks are cut by sets and by n-grams, so long texts make smaller ones.
    """
    rows = near.select(F.col("component").alias("group"), "node").join(own.select("node", "size"), "node")
    blocks = F.ceil(F.greatest(F.col("n") / SET_BLOCK, F.col("tokens") / TOKEN_BLOCK))
    # Stored, so that the join with it can split a large group.
    counts = stored(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens"))
                    .filter("n > 1").withColumn("blocks", blocks), "groups")
    total = counts.filter("blocks = 1").agg(F.sum("n"), F.sum("tokens")).first()
    few = max((total[0] or 0) // SET_BLOCK, (total[1] or 0) // TOKEN_BLOCK) + 1
    rows = rows.select("group", "node").join(counts.select("group", "blocks"), "group")

    def texts(asked: DataFrame) -> DataFrame:
        asked = asked.join(own.select("node", "row_key"), "node")
        found = docs.select(row_key(docs).alias("row_key"), docs["text"].alias("text")).join(
            asked.select("row_key").distinct(), "row_key", "left_semi").dropDuplicates(["row_key"])
        return asked.join(found, "row_key")

    units, certain = _units(rows.filter("blocks = 1"), few), None
    if not counts.filter("blocks > 1").isEmpty():
        members, _ = _core(rows.filter("blocks > 1"), texts, _close_reps)
        units = units.unionByName(_open_units(members))
        certain = members.filter("core and n_core > 1").select(
            "node", "hub", (F.col("n_core") - 1).alias("n_links"))
    checked = texts(units).groupBy("unit").applyInPandas(_verify, "node long, hub long, n_links long")
    return stored(checked.unionByName(certain) if certain is not None else checked, "links")


def joined(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(marks, nodes): nodes are different sets with copies, links and class.

    Columns of nodes: k1, k2 (key of the set), node (a row of it), copy_id (least doc_id of its documents),
    n_copies, n_links (other sets of similarity 0.8 or more), component.
    """
    rows = marks(docs)
    sets = rows.groupBy("k1", "k2").agg(
        F.min("row_id").alias("node"), F.min("doc_id").alias("copy_id"), F.count(F.lit(1)).alias("n_copies"))
    sets = stored(sets, "sets")
    own = stored(rows.join(sets.select(F.col("node").alias("row_id")), "row_id")
                 .withColumnRenamed("row_id", "node").drop("doc_id", "k1", "k2"), "nodes")
    near = components(candidates(own.filter("size > 0")), "node", "hub")
    checked = _links(docs, own, near)
    links = checked.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    classes = components(checked, "node", "hub")
    nodes = (sets.join(links.join(classes, "node"), "node", "left")
             .withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
             .withColumn("component", F.coalesce("component", "node")))
    return rows, stored(nodes, "classes")


def similarity_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, copy_id, n_copies, n_links for every row of `docs` (doc_id, text).

    Two sets of five-word n-grams are linked from a Jaccard similarity of 0.8. Documents with the same
    set are copies: copy_id is their least doc_id, n_copies their number; n_links counts the other sets
    linked with theirs. Classes are connected over links; class_id is the least doc_id of the class (null if it
    has none). A null text or one without words is in a class of its own. Repeated rows are copies, an empty
    table gives no row, whole texts count however long; other columns are left out.
    """
    rows, nodes = joined(docs)
    names = nodes.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    nodes = nodes.join(names, "component").drop("node", "component")
    return rows.select("doc_id", "k1", "k2").join(nodes, ["k1", "k2"]).select(
        "doc_id", "class_id", "copy_id", "n_copies", "n_links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the least doc_id of every class, with all its columns; of repeated rows one.

    Null ids come last; documents without words are classes of their own. An empty table stays empty.
    """
    rows, nodes = joined(docs)
    chosen = (rows.select("k1", "k2", "row_id", "doc_id", "row_key").join(
        nodes.select("k1", "k2", "component"), ["k1", "k2"])
        .groupBy("component").agg(F.min(F.struct(
            F.col("doc_id").isNull().alias("none"), "doc_id", "row_id", "row_key")).alias("best"))
        .select(F.col("best.row_key").alias("key")).distinct())
    times = rows.groupBy(F.col("row_key").alias("key")).agg(F.count(F.lit(1)).alias("times"))
    kept = docs.select(F.struct("*").alias("row"), row_key(docs).alias("key")).join(
        stored(chosen.join(times, "key"), "chosen"), "key")
    # Of repeated rows tasks send one each.
    once = kept.filter("times > 1").groupBy("key").agg(F.first("row").alias("row"))
    return kept.filter("times = 1").select("row").unionByName(once.select("row")).select("row.*")


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return similarity_classes(documents(spark, folder, "doc_id", "text"))


# Brute force over all pairs that share an n-gram, on any table DuckDB can hold.
OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents),
grams AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3),
         lambda i: array_to_string(w[i:i + 4], ' ')))) END AS g FROM words),
keyed AS (SELECT doc_id, g, CASE WHEN len(g) = 0 THEN 'doc ' || doc_id ELSE md5(array_to_string(g, '|')) END AS k
          FROM grams),
sets AS (SELECT k, min(doc_id) AS copy_id, count(*) AS n_copies, any_value(g) AS g FROM keyed GROUP BY k),
tokens AS (SELECT copy_id AS s, len(g) AS n, unnest(g) AS t FROM sets),
links AS (
  SELECT a.s AS s, b.s AS o FROM tokens a JOIN tokens b ON a.t = b.t AND a.s <> b.s
  GROUP BY a.s, b.s, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
reach AS (SELECT copy_id AS s, copy_id AS c FROM sets
          UNION SELECT l.o AS s, r.c FROM reach r JOIN links l ON r.s = l.s),
classes AS (SELECT s, min(c) AS class_id FROM reach GROUP BY s),
degree AS (SELECT s, count(*) AS n_links FROM links GROUP BY s)
SELECT d.doc_id, c.class_id, x.copy_id, x.n_copies, coalesce(g.n_links, 0) AS n_links
FROM keyed d JOIN sets x ON d.k = x.k JOIN classes c ON c.s = x.copy_id LEFT JOIN degree g ON g.s = x.copy_id
"""
