"""Jaccard self-join of word n-gram sets by chosen paths.

Documents become sets of hashed word n-grams; documents with equal sets form one vertex
(counted in each task first, so thousands of copies are one row per task).

A run of the join is a tree. Its root holds all sets; in a node, a set chooses each of its
tokens with probability ``1 / (threshold * size)`` by a hash of (node, token), the same for
all sets, and goes to one child per chosen token. Two similar sets share a child with good
chance, dissimilar sets drift apart. Nodes of at most ``limit`` sets are leaves, compared by
brute force; larger ones are split again, down to ``depth`` levels. A leaf at the last level
that is still too large is compared exactly all the same, by classes of similar size and
blocks against blocks in separate groups. Runs are repeated until a pair at the threshold is
found with the target recall: a pair shares 1 child or more per node on average, so the
chance that it is together at level d is at least q(d) = 1 - exp(-q(d-1)), q(0) = 1, and
``runs`` is the least number with ``(1 - q(depth)) ** runs <= 1 - recall``.

Leaves compare 256-bit one-bit minwise sketches (a pair at the threshold fails the sketch
test with probability below 1e-7) and return, for each set with a partner, one edge of a
spanning forest: never all pairs. The components of these edges are the candidate families;
every set is then sent once to its family, where all pairs are compared exactly as products
of incidence matrices, and only the exact number of links per set and the edges of a
spanning forest leave the task. Families beyond one block are compared block against block
in separate groups. Work in a family grows with the square of its different texts (copies do
not count), output with their number.

Recall: the pairs of one family are all compared, so a pair is lost only if no chain of
candidate edges connects it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickstar.llm.common import fraction, masked, stored, unmasked
from kickstar.llm.components import components

#: Maps the bytes of a UTF-8 text: separators to blanks, A-Z to a-z, all else to itself.
_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
BITS = 256
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)     # odd mixing constants
_MULTIPLIERS = np.random.default_rng(20).integers(0, 2**63, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """word -> 64-bit hash; forgets everything when it has grown to a million words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: bytes | None, n: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word runs of a UTF-8 text; a shorter text is one
    run, a text without words has none."""
    words = (text or b"").translate(_BYTES).split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(ids))
    h = np.full(len(ids) - k + 1, k, np.uint64)
    for j in range(k):
        h = mixed(h * M2 + ids[j:len(ids) - k + 1 + j])
    return np.unique(h)


def sketch(tokens: np.ndarray) -> bytes:
    """One bit of each of 256 minima (tokens in slices, so a huge set needs little memory)."""
    low = np.full(BITS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(tokens), 2048):
        np.minimum(low, (tokens[i:i + 2048, None] * _MULTIPLIERS[None, :]).min(axis=0), out=low)
    return np.packbits(((mixed(low) >> np.uint64(17)) & np.uint64(1)).astype(np.uint8)).tobytes()


def sketch_floor(threshold: float) -> int:
    """Equal bits that a pair at the threshold reaches, but for 5.5 standard deviations."""
    p = (1 + threshold) / 2
    return math.floor(BITS * p - 5.5 * math.sqrt(BITS * p * (1 - p)))


def runs_for(recall: float, depth: int) -> int:
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def paths(tokens: np.ndarray, threshold: float, runs: int, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level (index of the parent in the level before, node) of the paths that the
    set follows in all runs, by parent.

    A token is chosen in a node if its product with the node's (odd, random) number is below
    the bound; tokens are taken in slices, so a huge set needs little memory."""
    bound = np.uint64(min(2**64 - 1, int(2.0**64 / (threshold * len(tokens)))))
    nodes, out = mixed(np.arange(1, runs + 1, dtype=np.uint64) * M1), []
    for _ in range(depth):
        odd, found = nodes | np.uint64(1), []
        for at in range(0, len(tokens), 16_384):
            part = tokens[at:at + 16_384]
            parent, token = np.nonzero(part[None, :] * odd[:, None] <= bound)
            found.append((parent, part[token]))
        parent, token = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(parent, kind="stable")
        parent, token = parent[order], token[order]
        nodes = mixed(mixed(token + M1) ^ (nodes[parent] * M2))
        out.append((parent, nodes))
    return out


def _tree_type(depth: int) -> str:
    return "array<struct<node:bigint" + (f",next:{_tree_type(depth - 1)}" if depth > 1 else "") + ">>"


def _tree_array(trees: list, depth: int) -> pa.ListArray:
    """The paths of many sets (None: no paths) as nested lists of (node, next)."""
    below = None
    for level in range(depth - 1, -1, -1):
        there = [t for t in trees if t is not None]
        nodes = np.concatenate([t[level][1] for t in there]) if there else np.empty(0, np.uint64)
        fields = {"node": pa.array(nodes.view(np.int64))} | ({"next": below} if below is not None else {})
        rows = pa.StructArray.from_arrays(list(fields.values()), list(fields))
        if level:
            sizes = [np.bincount(t[level][0], minlength=len(t[level - 1][1])) for t in there]
        else:
            sizes = [np.array([0 if t is None else len(t[0][1])]) for t in trees]
        ends = np.cumsum(np.concatenate([[0], *sizes])).astype(np.int32)
        below = pa.ListArray.from_arrays(pa.array(ends), rows)
    return below


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, th, text as UTF-8); the id and the text's hash name a row up to repeated rows."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"),
                       text.cast("binary").alias("text"))


def signatures(rows: DataFrame, n: int, threshold: float, runs: int, depth: int) -> DataFrame:
    """(doc_id, th, sig, size, sketch, paths): sig is the md5 of the set; texts without words
    have a null sig and no paths."""
    names = ["doc_id", "th", "sig", "size", "sketch", "paths"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = []
                for text in part.column("text"):
                    s = shingle_set(text.as_py(), n, hashes)
                    out.append((hashlib.md5(s.tobytes()).digest(), len(s), sketch(s), paths(s, threshold, runs, depth)) if len(s)
                               else (None, 0, None, None))
                sig, size, bits, trees = zip(*out)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sig, pa.binary()), pa.array(size, pa.int32()),
                                                  pa.array(bits, pa.binary()), _tree_array(list(trees), depth)], names)
    return rows.mapInArrow(run, f"doc_id long, th long, sig binary, size int, sketch binary, paths {_tree_type(depth)}")


def _forest(similar: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the smallest index of its component."""
    n = len(similar)
    root, seen = np.arange(n), np.zeros(n, bool)
    for i in range(n):
        if seen[i]:
            continue
        front, seen[i] = [i], True
        while front:
            new = np.flatnonzero(similar[front].any(axis=0) & ~seen)
            seen[new] = True
            root[new] = i
            front = new.tolist()
    return root


_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _similar(sketches: list[bytes], sizes: np.ndarray, floor: int, p: int, q: int) -> np.ndarray:
    s = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    n, similar = len(s), np.zeros((len(s), len(s)), bool)
    for i in range(0, n, 64):
        equal = BITS - _POP[s[i:i + 64, None, :] ^ s[None, :, :]].sum(axis=2, dtype=np.int32)
        small, large = np.minimum(sizes[i:i + 64, None], sizes[None, :]), np.maximum(sizes[i:i + 64, None], sizes[None, :])
        similar[i:i + 64] = (equal >= floor) & (q * small >= p * large)
    return similar


def _compare_leaves(leaves: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) of spanning forests from rows (members array<sig, size, sketch, own>).

    Members of two blocks (``own``): each block's own forest comes from the row that holds
    it alone, so a row of two blocks gives only the edges that join their components."""
    floor, (p, q) = sketch_floor(threshold), fraction(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column(0):
                m = sorted(((x["sig"], x["size"], x["sketch"], x["own"]) for x in members.as_py()), key=lambda x: x[0])
                own = np.array([x[3] for x in m])
                similar = _similar([x[2] for x in m], np.array([x[1] for x in m], np.int64), floor, p, q)
                root = _forest(similar)
                if own.min() != own.max():
                    inner = _forest(similar & (own[:, None] == own[None, :]))
                    root = np.where(inner == np.arange(len(m)), root, np.arange(len(m)))
                for i in np.flatnonzero(root != np.arange(len(m))):
                    a.append(m[i][0])
                    b.append(m[root[i]][0])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
    return leaves.select("members").mapInArrow(run, "a binary, b binary")


def candidate_edges(signed: DataFrame, facts: DataFrame, threshold: float, depth: int, limit: int, block: int) -> DataFrame:
    """Edges between sets that meet in a leaf and pass the sketch test, one forest per leaf.

    ``signed``: (sig, paths), repeated for copies; ``facts``: (sig, size, sketch), one row per
    set. Rows of a node are counted and joined to their count, so a large node is never
    gathered: its members go on to its children, which they carry along."""
    member = F.struct("sig", "size", "sketch", "own")
    edges = None
    kids = signed.filter("sig is not null").select("sig", F.explode("paths").alias("p"))
    for level in range(1, depth + 1):
        rows = kids.select("sig", "p.*").distinct()
        counts = stored(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("sig")).alias("a"),
                                                 F.bit_xor(F.xxhash64(F.lit(1), "sig")).alias("b")).filter("n > 1"), f"nodes{level}")
        # nodes with the same members (from any run) are compared once
        once = counts.filter((F.col("n") <= limit) | F.lit(level == depth)).groupBy("n", "a", "b").agg(F.min("node").alias("node"))
        split = counts.filter((F.col("n") > limit) & F.lit(level < depth))
        rows = stored(rows.join(once.select("node", "n").unionAll(split.select("node", "n")), "node"), f"level{level}")
        leaves = (rows.filter(F.col("n") <= limit).select("node", "sig").join(facts, "sig").withColumn("own", F.lit(0))
                  .groupBy("node").agg(F.collect_list(member).alias("members")))
        new = _compare_leaves(leaves, threshold)
        edges = new if edges is None else edges.unionAll(new)
        large = rows.filter(F.col("n") > limit)
        if level < depth:
            kids = large.select("sig", F.explode("next").alias("p"))
    # What is still large is compared exactly all the same: members by classes of their size
    # (similar sets are in the same class or in neighbours, and every member stands in its own
    # class and the next), blocks of a class against blocks.
    width = F.lit(math.log(1 / threshold) * (1 + 1e-9))
    sized = stored(large.select("node", "sig").join(facts, "sig").withColumn("c", F.floor(F.log("size") / width).cast("int"))
                   .withColumn("c", F.explode(F.array(F.col("c"), F.col("c") + 1))), "large")
    classes = sized.groupBy("node", "c").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("nb"), F.count(F.lit(1)).alias("n"))
    blocks = (sized.join(classes.filter("n > 1").drop("n"), ["node", "c"]).withColumn("own", F.pmod(F.xxhash64("sig"), F.col("nb")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
              .groupBy("node", "c", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
              .agg(F.collect_list(member).alias("members")))
    return edges.unionAll(_compare_leaves(blocks, threshold))


def exact_links(sets: list[np.ndarray], weight: np.ndarray, first: np.ndarray, second: np.ndarray,
                p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of linked documents of each set, and the smallest index of its component.

    ``first`` and ``second`` mark the two blocks; only pairs between them count (all pairs,
    if both mark everything). Intersections are products of incidence matrices, a slice of
    the shared tokens at a time."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    tokens, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n, width = len(sets), 4096
    common = np.zeros((n, n), np.float32)
    for at in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [at, at + width])
        matrix = np.zeros((n, width), np.float32)
        matrix[owner[lo:hi], column[lo:hi] - at] = 1
        common += matrix @ matrix.T
    both = (p + q) * common.astype(np.int64) >= p * (sizes[:, None] + sizes[None, :])
    both &= (first[:, None] & second[None, :]) | (second[:, None] & first[None, :])
    np.fill_diagonal(both, False)
    return both @ weight, _forest(both)


def _families(rows: DataFrame, n: int, threshold: float) -> DataFrame:
    """(sig, links, root) from rows (root, i, j, sig, own, weight, text) by group (root, i, j)."""
    p, q = fraction(threshold)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        hashes = _WordHashes()
        group = group.sort_values("sig")        # the smallest signature of a component is its root
        sets = [shingle_set(t, n, hashes) for t in group["text"]]
        own, weight = group["own"].to_numpy(), group["weight"].to_numpy(np.int64)
        links, root = exact_links(sets, weight, own == group["i"].to_numpy(), own == group["j"].to_numpy(), p, q)
        sig = group["sig"].to_numpy()
        return pd.DataFrame({"sig": sig, "links": links.astype(np.int64), "root": sig[root]})
    return rows.groupBy("root", "i", "j").applyInPandas(run, "sig binary, links long, root binary")


def _classes(docs: DataFrame, threshold: float, n: int, recall: float, depth: int, limit: int, block: int,
             block_tokens: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, sig) of every row, and (sig, doc_id, weight, root, links) of every set."""
    rows = _text_rows(docs, id_col, text_col)
    signed = stored(signatures(rows, n, threshold, runs_for(recall, depth), depth), "signed")
    sets = signed.filter("sig is not null")
    reps = stored(sets.groupBy("sig", "size", "sketch").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "th")).alias("at"), F.count(F.lit(1)).alias("weight")), "reps")

    family = components(candidate_edges(signed, reps.select("sig", "size", "sketch"), threshold, depth, limit, 4 * limit))
    sized = stored(family.join(reps, F.col("v") == F.col("sig")).select("root", "sig", "at", "weight", "size"), "families")
    blocks = (sized.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens"))
              .select("root", F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("tokens") / block_tokens)).cast("int").alias("nb")))
    # a merge join at every size: what must meet its texts grows with the corpus
    texts = (sized.join(rows.hint("merge"), F.col("at.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("at.th") == F.col("th")))
             .dropDuplicates(["sig"]).select("root", "sig", "weight", "text"))
    placed = (texts.join(blocks, "root").withColumn("own", F.pmod(F.xxhash64("sig"), F.col("nb")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
              .select("root", "sig", "weight", "text", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    linked = stored(_families(placed, n, threshold), "links")
    classes = components(linked.select(F.col("sig").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy(F.col("sig").alias("lsig")).agg(F.sum("links").alias("links"))
    root = stored(reps.join(classes, F.col("v") == F.col("sig"), "left").join(links, F.col("lsig") == F.col("sig"), "left")
                  .select("sig", "doc_id", "weight", F.coalesce("root", "sig").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "roots")
    return signed.select("doc_id", "th", "sig"), root


def near_duplicates(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.999, depth: int = 2,
                    limit: int = 512, block: int = 512, block_tokens: int = 2_000_000, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, class_id, n_links).

    Two documents are linked if their n-gram sets have a Jaccard similarity of ``threshold``
    or more; ``n_links`` counts the other documents a document is linked to, copies included;
    ``class_id`` is the smallest id of the documents connected by links. A document without
    words has no links and is a class of its own. Rows with a null id take part like all
    others (a class of such rows only has a null class_id); repeated rows are copies of each
    other. Other columns are not read; an empty table gives no rows."""
    signed, root = _classes(docs, threshold, n, recall, depth, limit, block, block_tokens, id_col, text_col)
    ids = root.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    out = root.join(ids, "root").select(F.col("sig").alias("rsig"), "class_id", (F.col("links") + F.col("weight") - 1).alias("n_links"))
    return (signed.join(out, F.col("sig") == F.col("rsig"), "left")
            .select("doc_id", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def keep_one(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.999, depth: int = 2, limit: int = 512,
             block: int = 512, block_tokens: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each class: that with the smallest id (null last), then
    text hash; of repeated rows one. Documents without words all stay."""
    docs, names = masked(docs)
    id_col, text_col = names[id_col], names[text_col]
    signed, root = _classes(docs, threshold, n, recall, depth, limit, block, block_tokens, id_col, text_col)
    placed = (signed.groupBy("sig", "doc_id", "th").agg(F.count(F.lit(1)).alias("same")).filter("sig is not null")
              .join(root.select("sig", "root"), "sig").select("root", "doc_id", "th", "same"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("th"))
    best = placed.groupBy("root").agg(F.min(order).alias("best"))
    gone = stored(placed.join(best, "root").select("doc_id", "th", "same", (order == F.col("best")).alias("stays"))
                  .filter("not stays or same > 1"), "gone").withColumnsRenamed({"doc_id": "__gid", "th": "__gth"})
    rows = docs.withColumn("__th", F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__gid")) & (F.col("__th") == F.col("__gth"))
    single = rows.join(gone, same, "left_anti")
    repeated = rows.join(gone.filter("stays"), same, "left_semi").dropDuplicates([id_col, "__th"])
    return single.unionByName(repeated).select(*unmasked(names))
