"""SimHash near-duplicates: fingerprints of word shingles, linked by a self-join of a binary trie.

The trie of all fingerprints is cut at a depth that grows with their number.
Every pair of nodes at that depth whose prefixes differ in at most the budget
is one group of a shuffle; a group walks its two subtries together, adds up
differing bits and drops a pair of nodes as soon as the budget is exceeded.
A pair of nodes with too many fingerprints is split into pairs of its
descendants before the walk. Groups return a spanning forest of their links,
and connected components are found by contracting edges, round by round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bound_batches, stored, strings

BITS = 64
SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
LEAF_ROWS = 1 << 14
_BLOCK = 1 << 16


def text_fingerprint(text: str, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of ``width``-word shingles, repeats included; 0 for a text without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(width, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1:].tolist())]
    set_in = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), _BLOCK):
        block = np.array(hashes[k:k + _BLOCK], "<u8").view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * set_in > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: str | Column) -> Column:
    """The fingerprint of a text column as a signed 64-bit integer; a null text counts as empty."""

    @F.arrow_udf("bigint")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.array([text_fingerprint(t) for t in strings(batch)], np.uint64)
            yield pa.array(values.view(np.int64))

    return of(text)


def hex_digits(value: Column) -> Column:
    """A signed 64-bit fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _masks(width: int, budget: int) -> list[int]:
    """All differences of ``width`` bits with at most ``budget`` (0 to 2) bits set."""
    masks = [0]
    if budget >= 1:
        masks += [1 << i for i in range(width)]
    if budget >= 2:
        masks += [1 << i | 1 << k for i in range(width) for k in range(i)]
    return masks


def _prefix(column: Column, depth: int) -> Column:
    return F.shiftrightunsigned(column, BITS - depth) if depth else F.lit(0).cast("bigint")


def _node_pairs(fps: DataFrame, depth: int, budget: int) -> DataFrame:
    """Each fingerprint beside every pair of nodes at ``depth`` that it belongs to: ``fp, a, b``, a <= b."""
    masks = F.array(*[F.lit(m).cast("bigint") for m in _masks(depth, budget)])
    spread = fps.select("fp", _prefix(F.col("fp"), depth).alias("p"), F.explode(masks).alias("m"))
    other = F.col("p").bitwiseXOR(F.col("m"))
    return spread.select("fp", F.least("p", other).alias("a"), F.greatest("p", other).alias("b"))


def _split(rows: DataFrame, depth: int, by: int, budget: int) -> DataFrame:
    """The same node pairs ``by`` levels deeper, without the pairs beyond the budget."""
    masks = F.array(*[F.lit(m).cast("bigint") for m in _masks(by, budget)])
    child = _prefix(F.col("fp"), depth + by)
    in_a = _prefix(F.col("fp"), depth) == F.col("a")
    spread = rows.select("fp", "a", "b", child.alias("c"), in_a.alias("in_a"), F.explode(masks).alias("m"))
    low = F.col("c").bitwiseAND(F.lit((1 << by) - 1).cast("bigint")).bitwiseXOR(F.col("m"))
    mate = F.shiftleft(F.when(F.col("in_a"), F.col("b")).otherwise(F.col("a")), by).bitwiseOR(low)
    within = F.bit_count(F.col("c").bitwiseXOR(mate)) <= budget
    return spread.where(within).select("fp", F.least("c", mate).alias("a"), F.greatest("c", mate).alias("b"))


def subtrie_links(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints that differ in at most ``budget`` bits.

    ``a`` and ``b`` are sorted distinct unsigned fingerprints below one trie
    node each, at ``depth``; ``b`` None joins ``a`` with itself. A node is a
    range of the sorted array; the frontier of node pairs is split in halves
    when it grows, so memory stays bounded.
    """
    same, b = b is None, a if b is None else b
    if not len(a) or not len(b):
        return
    shared = np.uint64(BITS - depth)
    apart = 0 if same or not depth else int(np.bitwise_count(a[0] >> shared ^ b[0] >> shared))
    first = np.array([[0], [len(a)], [0], [len(b)], [apart]], np.int64)
    stack = [(depth, first)]
    while stack:
        level, pairs = stack.pop()
        if pairs.shape[1] > 1 << 20:
            half = pairs.shape[1] // 2
            stack += [(level, pairs[:, :half]), (level, pairs[:, half:])]
            continue
        rows_a, rows_b = pairs[1] - pairs[0], pairs[3] - pairs[2]
        small = rows_a * rows_b <= 64 if level < BITS else np.ones(pairs.shape[1], bool)
        if small.any():
            i, j = _expand(pairs[:, small])
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= i < j
            if near.any():
                yield i[near], j[near]
        pairs = pairs[:, ~small]
        if not pairs.shape[1]:
            continue
        bit = np.uint64(1 << (BITS - 1 - level))
        kept = ~((bit << np.uint64(1)) - np.uint64(1)) if level else np.uint64(0)
        mid_a = np.clip(np.searchsorted(a, (a[pairs[0]] & kept) | bit), pairs[0], pairs[1])
        mid_b = np.clip(np.searchsorted(b, (b[pairs[2]] & kept) | bit), pairs[2], pairs[3])
        children = []
        for side_a in (0, 1):
            for side_b in (0, 1):
                lo_a, hi_a = (pairs[0], mid_a) if side_a == 0 else (mid_a, pairs[1])
                lo_b, hi_b = (pairs[2], mid_b) if side_b == 0 else (mid_b, pairs[3])
                error = pairs[4] + (side_a != side_b)
                live = (lo_a < hi_a) & (lo_b < hi_b) & (error <= budget)
                if same:  # of (x, y) and (y, x) below one node, walk only the first
                    live &= lo_a <= lo_b
                children.append(np.stack([lo_a, hi_a, lo_b, hi_b, error])[:, live])
        stack.append((level + 1, np.concatenate(children, axis=1)))


def _expand(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of the node pairs, each a small rectangle."""
    wide = pairs[3] - pairs[2]
    cells = (pairs[1] - pairs[0]) * wide
    of = np.repeat(np.arange(pairs.shape[1]), cells)
    at = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
    return pairs[0][of] + at // wide[of], pairs[2][of] + at % wide[of]


def merge_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels after also linking ``i`` with ``j``; a label is the smallest index of its component."""
    while len(i):
        x, y = labels[i], labels[j]
        open_ = x != y
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further
    return labels


def _forest_of_group(depth: int, budget: int):
    def forest(table: pa.Table) -> pa.Table:
        # one group: at most twice the limit of a node
        fps = np.unique(table.column("fp").to_numpy().view(np.uint64))
        node_a, node_b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        nodes = (fps >> np.uint64(BITS - depth)).view(np.int64) if depth else np.zeros(len(fps), np.int64)
        if node_a == node_b:
            a, b, everyone = fps, None, fps
        else:
            a, b = fps[nodes == node_a], fps[nodes == node_b]
            everyone = np.concatenate([a, b])
        labels = np.arange(len(everyone))
        for i, j in subtrie_links(a, b, depth, budget):
            labels = merge_labels(labels, i, j if b is None else j + len(a))
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"u": everyone[linked].view(np.int64), "v": everyone[labels[linked]].view(np.int64)})

    return forest


def fingerprint_links(fps: DataFrame, budget: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Links ``u, v`` that join exactly the fingerprints reachable from each other.

    ``fps`` holds distinct fingerprints ``fp``. A link joins two of them that
    are connected by differences of at most ``budget`` (at most 2) bits; the
    links form a forest per pair of trie nodes, not all pairs.
    """
    if not 0 <= budget <= 2:
        raise ValueError("the budget is 0, 1 or 2 bits")
    depth, n = 0, fps.count()
    while n >> depth > leaf_rows and depth < BITS - 4:
        depth += 1
    rows, found = _node_pairs(fps, depth, budget), []
    heavy_nodes = fps.groupBy(_prefix(F.col("fp"), depth).alias("p")).count().where(F.col("count") > 2 * leaf_rows)
    if not heavy_nodes.isEmpty():
        rows = stored(rows, "trie_pairs")
        while depth < BITS:
            size = rows.groupBy("a", "b").count()
            heavy = stored(size.where(F.col("count") > 4 * leaf_rows).select("a", "b"), "trie_heavy")
            if heavy.isEmpty():
                break
            found.append(_walk(rows.join(heavy, ["a", "b"], "left_anti"), depth, budget))
            by = min(3, BITS - depth)
            rows = stored(_split(rows.join(heavy, ["a", "b"], "left_semi"), depth, by, budget), "trie_pairs")
            depth += by
    found.append(_walk(rows, depth, budget))
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links.distinct()


def _walk(rows: DataFrame, depth: int, budget: int) -> DataFrame:
    return rows.groupBy("a", "b").applyInArrow(_forest_of_group(depth, budget), "u bigint, v bigint")


def components(links: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of ``u, v``: equal roots exactly for connected vertices.

    Each round maps every vertex to the neighbour (or itself) that comes first
    in a random order drawn for the round, and contracts the links by that
    map, so the number of vertices shrinks by a constant factor on any graph,
    long chains included.
    """
    maps: list[DataFrame] = []
    links = stored(links, "links")
    while not links.isEmpty():
        priority = F.xxhash64("v", F.lit(len(maps)))
        both = links.select("u", "v").union(links.select("v", "u")).union(links.select("u", "u"))
        both = both.union(links.select("v", "v"))
        nearest = stored(both.groupBy("u").agg(F.min_by("v", priority).alias("parent")), "parents")
        maps.append(nearest)
        left = nearest.select("u", F.col("parent").alias("pu"))
        right = nearest.select(F.col("u").alias("v"), F.col("parent").alias("pv"))
        moved = links.join(left, "u").join(right, "v").where(F.col("pu") != F.col("pv"))
        links = stored(moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "links")
    if not maps:
        return links.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    roots = maps[0].select(F.col("u").alias("vertex"), F.col("parent").alias("root"))
    for step in maps[1:]:
        step = step.select(F.col("u").alias("root"), "parent")
        roots = roots.join(step, "root", "left").select("vertex", F.coalesce("parent", "root").alias("root"))
    return roots


def _rooted(docs: DataFrame, doc_id: str, text: str, budget: int, leaf_rows: int) -> DataFrame:
    """Per document ``doc_id, fp, root, component_id``; the root is a fingerprint, another for each component."""
    bound_batches(docs.sparkSession)
    numeric = isinstance(docs.schema[doc_id].dataType, T.NumericType)
    ident = F.col(doc_id).cast("bigint") if numeric else F.col(doc_id)
    marked = stored(docs.select(ident.alias("doc_id"), fingerprint(F.col(text)).alias("fp")), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprint_classes")
    roots = components(fingerprint_links(classes.select("fp"), budget, leaf_rows))
    rooted = classes.join(roots.withColumnRenamed("vertex", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = MAX_BITS,
                    leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Per document its id, fingerprint (``fp``, signed) and ``component_id``, the smallest id of its component.

    Documents link when their fingerprints differ in at most ``budget`` bits.
    A null text counts as empty and has fingerprint 0, like any text without
    words. A null id takes part in links; ``component_id`` is null only where
    every id of the component is. Repeated rows each keep their row; further
    columns are ignored. An empty input gives no rows.
    """
    return _rooted(docs, doc_id, text, budget, leaf_rows).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest ``doc_id`` (null ids last); all its columns.

    Of repeated rows with that id one stays, the first by a hash of its columns
    (maps apart). Ids may be of any ordered type. The rows kept are joined back by
    id, so only ids and fingerprints are grouped, never texts, except for rows
    that share an id.
    """
    members = stored(_rooted(docs, "doc_id", "text", budget, LEAF_ROWS), "members")
    least = members.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # a component is known by its root: several share a smallest id where texts of one id differ, or ids are null
    keepers = least.groupBy("root", "doc_id").agg(F.min("fp").alias("keeper_fp"))
    keepers = stored(keepers.select(F.col("doc_id").alias("keeper_id"), "keeper_fp"), "keepers")
    shared_ids = stored(
        members.groupBy("doc_id").count().where(F.col("count") > 1).select(F.col("doc_id").alias("shared_id")), "shared_ids")
    # one plan at every size: a broadcast of the keepers would stop at some size, and the keepers grow with the input
    plain = docs.join(keepers.hint("merge"), docs["doc_id"].eqNullSafe(keepers["keeper_id"]), "left_semi")
    if shared_ids.isEmpty():
        return plain
    alone = plain.join(shared_ids, plain["doc_id"].eqNullSafe(shared_ids["shared_id"]), "left_anti")
    ambiguous = docs.join(shared_ids, docs["doc_id"].eqNullSafe(shared_ids["shared_id"]), "left_semi")
    columns = ambiguous.columns
    packed = ambiguous.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    packed = packed.select("row", F.col("row.doc_id").alias("id"), fingerprint(F.col("row.text")).alias("fp"))
    exact = packed.join(keepers, packed["id"].eqNullSafe(keepers["keeper_id"]) & (packed["fp"] == keepers["keeper_fp"]))
    # rows of one id and fingerprint: the first by a hash of all columns that have one
    hashed = F.xxhash64(*[F.col(f"row.`{c}`") for c, kind in ambiguous.dtypes if "map<" not in kind and kind != "variant"])
    one = exact.groupBy("id", "fp").agg(F.min_by("row", hashed).alias("row")).select("row.*")
    return alone.unionByName(one.select(*[F.col(f"`{c}`") for c in columns]))
