"""Operator 9: n-gram Jaccard join by size-banded tiles and bitmap signatures.

A document's set holds the 64-bit hashes of its distinct word n-grams. Two sets
link when ``100 * |both| >= percent * |either|``.

1. Equal sets become one node (64-bit digest), so copies are never paired.
2. Size bands: sizes of a linked pair differ by the factor ``percent / 100`` at
   most, which is one band, so two neighbouring bands share a tile. Inside a tile
   two linked sets share one of the first ``size - ceil(t * size) + 1`` elements
   in any common order of elements, so only those are dealt out, keyed by tile
   and element. The order puts elements frequent in a bounded sample last; a
   poor sample costs time, never a link.
3. In each key the smallest node is the centre. Each node is compared with its
   smallest centre: bit counts of two hashed bitmaps bound the overlap from
   above, what passes is intersected exactly as sorted arrays. Links give a forest.
4. Keys whose nodes are still in different components are cut into blocks; pairs
   of blocks compare all nodes of different components, again first by bitmap,
   then exactly. So every pair that shares a key either is tested or already
   lies in one component.
5. Components are contracted by alternating stars; copies take their node's.

Defined results: null, empty or blank text gives an empty set, linked with
nothing, its own component; fewer than ``words`` words are one element; rows of
equal text share a component; a component's id is its smallest doc_id (null if
all are null).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import mix64, pieces, place_factors, release_memory, released, stored, text_steps, word_hashes
from tripforge.llm.components import components

#: Documents whose elements are counted for the order, and elements put last.
SAMPLE_DOCUMENTS, FREQUENT = 10_000, 500_000
#: Fewest bits of a signature, nodes of a block of a shared key.
LEAST_BITS, BLOCK = 512, 2000
#: Rounds of likeliest pairs before all that are left are compared; only time depends on it.
LIKELY_ROUNDS = 1
#: Ids up to this number are broadcast (8 bytes each), more are joined.
BROADCAST_IDS = 2_000_000


def element_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    out = []
    for _, part in text_steps(texts):
        h, bounds = word_hashes(part)
        grams = np.zeros(max(0, len(h) - words + 1), np.uint64)
        factors = place_factors(words)
        for k in range(words):
            grams += h[k: k + len(grams)] * factors[k]
        grams = mix64(grams)
        for i in range(len(part)):
            a, b = bounds[i], bounds[i + 1]
            if b - a >= words:
                out.append(np.unique(grams[a: b - words + 1]))
            elif b > a:
                short = h[a:b] * factors[: b - a]
                out.append(mix64(short.sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def node_of(s: np.ndarray) -> int:
    """64-bit digest of a set."""
    import hashlib

    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def band(size: int, percent: int) -> int:
    """Bands so wide that linked sizes are in one band or two neighbours."""
    return int(math.log(size) / math.log(100 / percent) + 1e-9)


def bitmap(s: np.ndarray) -> bytes:
    """Parity of the elements of each bit; four bits for an element, rounded up to a power of two."""
    width = max(LEAST_BITS, 1 << (4 * len(s) - 1).bit_length())
    n = np.bincount((s % np.uint64(width)).astype(np.int64), minlength=width)
    return np.packbits((n & 1).astype(np.uint8)).tobytes()


def folded(bits: bytes, width: int) -> np.ndarray:
    """The bitmap of ``width`` bytes of the same set: halves are added until it is as short."""
    x = np.frombuffer(bits, np.uint8)
    while len(x) > width:
        x = x[: len(x) // 2] ^ x[len(x) // 2:]
    return x.view(np.uint64)


def shortened(batches):
    """Bitmaps folded to a quarter, for the tiles of frequent keys."""
    for b in batches:
        short = [folded(x, max(LEAST_BITS // 8, len(x) // 4)).tobytes() for x in b.column("bits").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(short, pa.binary())], ["node", "bits"])


def most_shared(bits: list[bytes], p: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The most elements that sets ``p`` and ``q`` (rows of ``bits``) can share: half of the sizes less the bits that differ."""
    size = np.array([len(x) for x in bits])
    width = np.minimum(size[p], size[q])
    out = np.zeros(len(p), np.int64)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        rows, place = np.unique(np.concatenate([p[at], q[at]]), return_inverse=True)
        m = np.stack([folded(bits[i], w) for i in rows])
        for lo in range(0, len(at), max(1, (1 << 22) // int(w))):
            hi = min(len(at), lo + max(1, (1 << 22) // int(w)))
            differ = np.bitwise_count(m[place[lo:hi]] ^ m[place[len(at) + lo: len(at) + hi]]).sum(1, dtype=np.int64)
            na, nb = n[p[at[lo:hi]]], n[q[at[lo:hi]]]
            out[at[lo:hi]] = np.minimum((na + nb - differ) // 2, np.minimum(na, nb))
    return out


def links(inter, a, b, percent: int):
    return 100 * inter >= percent * (a + b - inter)


# ------------------------------------------------------------------ passes
def digest_rows(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (set size), node and bits (null for an empty set)."""

    def run(batches):
        for b in (x for whole in batches for x in pieces(whole)):
            sets = element_sets(b.column("text"), words)
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"), "n": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                "bits": pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary())})

    d = docs.select("doc_id", "text")
    return d.mapInArrow(released(run), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n long, node long, bits binary")


def frequent_elements(docs: DataFrame, words: int, rows: int) -> np.ndarray:
    """Elements in three or more sampled documents, most frequent last; at most FREQUENT."""
    d = docs.select("doc_id", "text")
    if rows > SAMPLE_DOCUMENTS:
        h = F.xxhash64(F.lit("jaccard"), F.col("doc_id").cast("string"))
        d = d.filter(h < int(-(2**63) + SAMPLE_DOCUMENTS / rows * 2**64))

    def run(batches):
        for b in (x for whole in batches for x in pieces(whole)):
            sets = element_sets(b.column("text"), words)
            v, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64), np.empty(0, int))
            yield pa.RecordBatch.from_pydict({"e": pa.array(v.view(np.int64)), "c": pa.array(n.astype(np.int64))})

    top = (d.mapInArrow(released(run), "e long, c long").groupBy("e").agg(F.sum("c").alias("c")).filter("c > 2")
           .orderBy(F.desc("c"), "e").limit(FREQUENT).toPandas())
    return top["e"].to_numpy(np.int64).view(np.uint64)[::-1].copy()


def key_rows(docs: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """key (tile and element), node, n: the leading elements of each distinct set of a batch, in both its tiles."""
    order = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], order))  # at most 12 MB

    def run(batches):
        values, place = shared.value
        for b in batches:
            seen = set()
            for piece in pieces(b):
                keys, nodes, sizes = [], [], []
                for s in element_sets(piece.column("text"), words):
                    n = len(s)
                    lead = n - (-(-percent * n // 100)) + 1
                    if not n or (100 * n // percent == n and lead == 1):  # links with none but equal sets
                        continue
                    node = node_of(s)
                    if node in seen:
                        continue
                    seen.add(node)
                    if len(values):
                        at = np.searchsorted(values, s)
                        at[at == len(values)] = 0
                        common = values[at] == s
                        s = np.concatenate([s[~common], s[common][np.argsort(place[at[common]])]])
                    t = band(n, percent)
                    for tile in (t, t + 1):
                        keys.append(mix64(s[:lead] ^ np.uint64(tile * 0xD6E8FEB86659FD93 % 2**64)))
                    nodes.append(np.full(2 * lead, node, np.int64))
                    sizes.append(np.full(2 * lead, n, np.int32))
                if keys:
                    yield pa.RecordBatch.from_pydict({"key": pa.array(np.concatenate(keys).view(np.int64)), "node": pa.array(np.concatenate(nodes)),
                                                      "n": pa.array(np.concatenate(sizes))})

    return docs.select("text").filter("text is not null").mapInArrow(released(run), "key long, node long, n int")


def shared_keys(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows of keys that two or more nodes have, with the key's smallest node as
    centre. A sorted stream per partition: nothing of a key but its first row is held."""

    def run(batches):
        held = None  # the last key's first row, whether it was given out, its last node
        for b in batches:
            if not b.num_rows:
                continue
            k, v, n = (b.column(i).to_numpy() for i in range(3))
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])])
            if held is not None and held[0] == k[0] and held[4] == v[0]:
                new[0] = False
            k, v, n = k[new], v[new], n[new]
            if not len(k):
                continue
            first = np.concatenate([[True], k[1:] != k[:-1]])
            given = False
            if held is not None and held[0] == k[0]:
                if not held[3]:
                    k, v, n = (np.concatenate([[h], x]).astype(x.dtype) for h, x in zip(held, (k, v, n)))
                    first = np.concatenate([[True], first])
                    first[1] = False
                    c0, m0 = v[0], n[0]
                else:
                    first[0] = False
                    given, c0, m0 = True, held[1], held[2]
            run_of = np.cumsum(first) - 1 + given
            starts = np.flatnonzero(first)
            centre, size = v[starts], n[starts]
            if given:
                centre, size = (np.concatenate([np.array([h], x.dtype), x]) for h, x in ((c0, centre), (m0, size)))
            count = np.bincount(run_of, minlength=len(centre))
            several = count > 1
            if given:
                several[0] = True
            last = int(run_of[-1])
            held = (int(k[-1]), int(centre[last]), int(size[last]), bool(several[last]), int(v[-1]))
            keep = several[run_of]
            if keep.any():
                yield pa.RecordBatch.from_pydict({"key": pa.array(k[keep]), "node": pa.array(v[keep]), "n": pa.array(n[keep]),
                                                  "centre": pa.array(centre[run_of][keep]), "cn": pa.array(size[run_of][keep])})

    return (rows.repartition(partitions, "key").sortWithinPartitions("key", "node")
            .mapInArrow(released(run), "key long, node long, n int, centre long, cn int"))


def sets_of(docs: DataFrame, words: int, digests: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, elements (sorted bytes) of ``nodes``, each from one document that has it."""
    ids = stored(digests.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "jaccard-ids")
    some = ids.select(F.col("doc_id").alias("_id")).distinct()
    if ids.count() <= BROADCAST_IDS:
        some = F.broadcast(some)
    d = docs.select("doc_id", "text").filter("text is not null")
    d = d.join(some, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def run(batches):
        for b in (x for whole in batches for x in pieces(whole)):
            out = {node_of(s): s for s in element_sets(b.column("text"), words) if len(s)}
            yield pa.RecordBatch.from_pydict({"node": pa.array(list(out), pa.int64()), "elements": pa.array([s.tobytes() for s in out.values()], pa.binary())})

    found = d.mapInArrow(released(run), "node long, elements binary").join(nodes, "node", "left_semi")
    return found.groupBy("node").agg(F.first("elements").alias("elements"))


def pass_bits(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, na, b, nb) whose bit counts allow a link."""
    p = (pairs.join(bits.withColumnsRenamed({"node": "a", "bits": "ba"}), "a")
         .join(bits.withColumnsRenamed({"node": "b", "bits": "bb"}), "b"))

    def by_bits(batches):
        for x in batches:
            if not x.num_rows:
                continue
            n = np.concatenate([x.column(c).to_numpy().astype(np.int64) for c in ("na", "nb")])
            rows = np.arange(x.num_rows)
            most = most_shared(x.column("ba").to_pylist() + x.column("bb").to_pylist(), rows, rows + x.num_rows, n)
            ok = pa.array(links(most, n[: x.num_rows], n[x.num_rows:], percent))
            yield pa.RecordBatch.from_arrays([x.column("a").filter(ok), x.column("b").filter(ok)], ["a", "b"])

    return p.select("a", "b", "na", "nb", "ba", "bb").mapInArrow(released(by_bits), "a long, b long")


def pass_exact(pairs: DataFrame, docs: DataFrame, words: int, digests: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that link, by intersecting their sorted sets."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    e = stored(sets_of(docs, words, digests, nodes), "jaccard-sets")

    def exact(batches):
        for x in batches:
            keep = []
            for p, q in zip(x.column("ea"), x.column("eb")):
                p, q = (np.frombuffer(v.as_py(), np.uint64) for v in (p, q))
                keep.append(bool(links(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q), percent)))
            ok = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([x.column("a").filter(ok), x.column("b").filter(ok)], ["a", "b"])

    p = (pairs.join(e.withColumnsRenamed({"node": "a", "elements": "ea"}), "a")
         .join(e.withColumnsRenamed({"node": "b", "elements": "eb"}), "b"))
    return p.select("a", "b", "ea", "eb").mapInArrow(released(exact), "a long, b long")


def block_pairs(mixed: DataFrame, bits: DataFrame, percent: int, best: bool) -> DataFrame:
    """key, a, b: pairs of different components in one key that pass size and bit count.

    A key of more than BLOCK nodes is cut into blocks by node hash; every pair of
    blocks is one tile of bounded size. With ``best``, a tile gives only the
    likeliest pair of each of its components, else all."""
    size = mixed.groupBy("key").agg(F.count("*").alias("g")).withColumn("blocks", F.ceil(F.col("g") / BLOCK).cast("int"))
    m = (mixed.join(size, "key").join(bits, "node")
         .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
         .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
         .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "component", "bits"))

    def tiles(batches):
        """Batches cut so that no tile is split between two of them."""
        rest = None
        for x in batches:
            if not x.num_rows:
                continue
            x = x if rest is None else pa.concat_batches([rest, x])
            t = [x.column(c).to_numpy() for c in ("key", "i", "j")]
            new = np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in t])) + 1
            at = int(new[-1]) if len(new) else 0
            rest = x.slice(at)
            if at:
                yield x.slice(0, at)
        if rest is not None:
            yield rest

    def run(batches):
        for x in tiles(batches):
            key, i, j, own, v, n, c = (x.column(k).to_numpy() for k in ("key", "i", "j", "own", "node", "n", "component"))
            n = n.astype(np.int64)
            bits = x.column("bits").to_pylist()
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            tile = np.cumsum(new) - 1
            end = np.append(np.flatnonzero(new)[1:], len(v))[tile]
            todo = end - np.arange(len(v)) - 1  # partners of each row: the rest of its tile
            total = np.concatenate([[0], np.cumsum(todo)])
            lo = 0
            while lo < len(v):
                hi = max(lo + 1, int(np.searchsorted(total, total[lo] + 400_000, "right")) - 1)
                p = np.repeat(np.arange(lo, hi), todo[lo:hi])
                q = np.arange(len(p)) - np.repeat(total[lo:hi] - total[lo], todo[lo:hi]) + p + 1
                lo = hi
                t = (c[p] != c[q]) & (percent * np.maximum(n[p], n[q]) <= 100 * np.minimum(n[p], n[q])) & ((i[p] == j[p]) | (own[p] != own[q]))
                p, q = p[t], q[t]
                if not len(p):
                    continue
                most = most_shared(bits, p, q, n)
                t = links(most, n[p], n[q], percent)
                p, q, like = p[t], q[t], (most / (n[p] + n[q]))[t]
                if best:
                    side, edge = np.concatenate([p, q]), np.tile(np.arange(len(p)), 2)
                    order = np.lexsort((v[q][edge], v[p][edge], -like[edge], c[side], tile[side]))
                    x1, x2 = tile[side][order], c[side][order]
                    first = np.concatenate([[True], (x1[1:] != x1[:-1]) | (x2[1:] != x2[:-1])])[: len(order)]
                    edge = np.unique(edge[order][first])
                    p, q = p[edge], q[edge]
                yield pa.RecordBatch.from_arrays([pa.array(key[p]), pa.array(np.minimum(v[p], v[q])), pa.array(np.maximum(v[p], v[q]))], ["key", "a", "b"])

    return (m.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(released(run), "key long, a long, b long"))


def link_nodes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The digest of every row, and the component (a node) of every linked node."""
    digests = stored(digest_rows(docs, words), "jaccard-digests")
    rows, elements = digests.agg(F.count("*"), F.sum("n")).first()
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), (elements or 0) // 5_000_000 + 1)
    keys = key_rows(docs, words, percent, frequent_elements(docs, words, rows))
    shared = stored(shared_keys(keys, partitions), "jaccard-keys")

    first = (shared.filter(f"node != centre and {percent} * greatest(n, cn) <= 100 * least(n, cn)")
             .groupBy(F.col("node").alias("b")).agg(F.min(F.struct(F.col("centre").alias("a"), F.col("cn").alias("na"))).alias("x"), F.first("n").alias("nb"))
             .select("x.a", F.col("x.na").cast("long").alias("na"), "b", F.col("nb").cast("long").alias("nb")))
    bits = stored(digests.filter("node is not null").groupBy("node").agg(F.first("bits").alias("bits")), "jaccard-bits")
    short = stored(bits.mapInArrow(released(shortened), bits.schema), "jaccard-short-bits")
    first = stored(pass_bits(first, bits, percent), "jaccard-first")
    forest = stored(components(pass_exact(first, docs, words, digests, percent)), "jaccard-forest")

    rows = shared.select("key", "node", "n")
    sizes = digests.filter("node is not null").groupBy("node").agg(F.first("n").alias("n"))
    for _ in range(LIKELY_ROUNDS):
        rows = still_mixed(rows, forest)
        found = stored(block_pairs(rows, short, percent, best=True), "jaccard-likely")
        # a key without a pair has none later either
        rows = rows.join(found.select("key").distinct(), "key", "left_semi")
        more = stored(pass_all(found, sizes, bits, docs, words, digests, percent), "jaccard-more")
        forest = joined(forest, more)
    rows = still_mixed(rows, forest)
    rest = stored(block_pairs(rows, short, percent, best=False), "jaccard-pairs")
    rest = rest.join(found.select("a", "b").distinct(), ["a", "b"], "left_anti")
    return digests, joined(forest, pass_all(rest, sizes, bits, docs, words, digests, percent))


def pass_all(pairs: DataFrame, sizes: DataFrame, bits: DataFrame, docs: DataFrame, words: int, digests: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs`` (a, b): whole signatures, then sets."""
    p = (pairs.select("a", "b").distinct().join(sizes.withColumnsRenamed({"node": "a", "n": "na"}), "a")
         .join(sizes.withColumnsRenamed({"node": "b", "n": "nb"}), "b"))
    return pass_exact(stored(pass_bits(p, bits, percent), "jaccard-passed"), docs, words, digests, percent)


def still_mixed(rows: DataFrame, forest: DataFrame) -> DataFrame:
    """key, node, n, component of keys whose nodes are in different components."""
    m = (rows.select("key", "node", "n").join(forest, "node", "left")
         .withColumn("component", F.coalesce("component", "node")))
    mixed = m.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("key")
    return stored(m.join(mixed, "key", "left_semi"), "jaccard-mixed")


def joined(forest: DataFrame, links_: DataFrame) -> DataFrame:
    edges = forest.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links_)
    return stored(components(edges), "jaccard-forest")


def link_documents(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    digests, linked = link_nodes(docs, words, percent)
    nodes = digests.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id")
    return (digests.join(named, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id
    (null last, ties by digest, then the smallest of rows with equal words). Rows
    without words are kept. Columns keep their names and values, whatever they are."""
    digests, linked = link_nodes(docs, words, percent)
    rows = digests.filter("node is not null").select("node", "doc_id").distinct()
    rows = rows.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("x"))
    best = best.select(F.col("x.node").alias("best_node"), F.col("x.doc_id").alias("best_id"))
    same = (F.col("node") == F.col("best_node")) & F.col("id").eqNullSafe(F.col("best_id"))
    row = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row")

    # an id of one row says which row it is, so no text is read again
    ids = stored(digests.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("rows"), F.first("node").alias("node")), "jaccard-ids")
    kept = ids.filter("rows = 1").join(best, same, "left").filter("node is null or best_node is not null").select(F.col("id").alias("kept_id"))
    one = docs.select(row, F.col("doc_id").alias("id")).join(kept, F.col("id").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")

    @F.pandas_udf("long")
    def node(texts: pd.Series) -> pd.Series:
        column = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], ["text"])
        nodes = [node_of(s) if len(s) else None for x in pieces(column) for s in element_sets(x.column("text"), words)]
        release_memory()
        return pd.Series(nodes, dtype="Int64")

    # rows that share an id are told apart by their digest, declared not deterministic so that a text is hashed once
    several = docs.select(row, F.col("doc_id").alias("id"), F.col("text").alias("t")).join(
        ids.filter("rows > 1").select(F.col("id").alias("one_id")), F.col("id").eqNullSafe(F.col("one_id")), "left_semi")
    several = several.select("row", "id", node.asNondeterministic()(F.col("t")).alias("node"))
    several = several.join(best, same, "left").filter("node is null or best_node is not null")
    # blank rows stay as they are; of the others one of each id stays
    place = F.when(F.col("node").isNull(), F.monotonically_increasing_id())
    many = several.withColumn("place", place).groupBy("best_node", "best_id", "place").agg(F.min("row").alias("row")).select("row.*")
    return one.unionByName(many)
