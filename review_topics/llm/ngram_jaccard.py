"""N-gram Jaccard join: MinHash banding proposes, full n-gram sets decide.

Texts with equal n-gram sets are one class and meet the join once, whatever their number. Class signatures are cut into
bands; classes that share a band are candidates. A candidate group is cut into blocks of bounded size, and each pair of
blocks in which some bucket has members is verified in one task by counting common n-grams with matrix products. What
leaves a task is one row per class, with its number of links and its root among what it is linked to, so a group costs
rows in proportion to its size while no link is lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics.llm import words
from review_topics.operators.components import components
from review_topics.session import hot_lookup, stage, stage_counted, unstage

BLOCK_ROWS = 256
BLOCK_GRAMS = 2_000_000
_CELLS = 4_000_000


def choose_bands(threshold: float, recall: float, max_hashes: int = 128) -> tuple[int, int]:
    """``(bands, rows)`` with the most rows a band for which a pair at ``threshold`` meets with at least ``recall``."""
    best = None
    for rows in range(1, max_hashes + 1):
        miss = 1 - threshold**rows
        bands = 1 if miss <= 0 else math.ceil(math.log(1 - recall) / math.log(miss))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


def _minhash(grams: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Minima of ``count`` hash functions over each run of ``grams`` that begins at ``starts``: one row a run."""
    multiply = words.mix(np.arange(1000, 1000 + count, dtype=np.uint64)) | np.uint64(1)
    add = words.mix(np.arange(5000, 5000 + count, dtype=np.uint64))
    out = np.empty((len(starts), count), np.uint64)
    for k in range(count):
        out[:, k] = np.minimum.reduceat(grams * multiply[k] + add[k], starts)
    return out


def _band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(signature), bands), np.uint64)
    for r in range(rows):
        out = words.mix(out + signature[:, r::rows][:, :bands])
    return out


def _profiles(bands: int, rows: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.sub_batches(batch, "text", 1 << 20):
                grams, offsets = words.ngram_hashes(*words.word_hashes(part.column("text")), n)
                has = np.flatnonzero(np.diff(offsets))
                band_rows = _band_hashes(_minhash(grams, offsets[has], bands * rows), bands, rows) if len(has) else []
                keys, sizes = [], []
                for i in has:
                    own = np.unique(grams[offsets[i] : offsets[i + 1]])
                    keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    sizes.append(len(own))
                ids, texts = (part.column(c).take(pa.array(has)) for c in ("doc_id", "text_key"))
                silent = part.column("doc_id").take(pa.array(np.flatnonzero(np.diff(offsets) == 0)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, bands * len(has) + 1, bands, dtype=np.int32)),
                    pa.array(np.asarray(band_rows, dtype=np.uint64).reshape(-1).view(np.int64)),
                )
                names = ["doc_id", "text_key", "set_key", "n_grams", "bands"]
                yield pa.RecordBatch.from_arrays([ids, texts, pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), lists], names=names)
                none = [pa.nulls(len(silent), kind) for kind in (pa.int64(), pa.binary(), pa.int32(), lists.type)]
                yield pa.RecordBatch.from_arrays([silent, *none], names=names)

    return run


def _gram_sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.sub_batches(batch, "text", 1 << 20):
                grams, offsets = words.ngram_hashes(*words.word_hashes(part.column("text")), n)
                sets = [np.unique(grams[a:b]).tobytes() for a, b in zip(offsets, offsets[1:])]
                keep = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(sets, pa.binary())], names=[*keep, "grams"])

    return run


def common_grams(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common values of each left and each right set of unique values; memory is bounded by blocks."""
    values = np.concatenate([*left, *right]) if left or right else np.zeros(0, np.uint64)
    _, code, counts = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    shared = counts[code] > 1
    code, owner = code[shared], owner[shared]
    codes, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    out = np.zeros((len(left), len(right)), np.float64)
    width = max(1, _CELLS // max(1, len(left) + len(right)))
    for lo in range(0, len(codes), width):
        a, b = np.searchsorted(code, (lo, lo + width))
        cells = np.zeros((len(left) + len(right), min(width, len(codes) - lo)), np.float32)
        cells[owner[a:b], code[a:b] - lo] = 1
        out += cells[: len(left)] @ cells[len(left) :].T
    return np.rint(out).astype(np.int64)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes; ``a`` and ``b`` are the ends of the links."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _verify(threshold: float):
    share = Fraction(str(threshold))

    def run(table: pa.Table) -> pa.Table:
        frame = table.select(["node", "text_key", "side", "copies", "grams"]).to_pandas()
        frame = frame.drop_duplicates(["node", "text_key", "side"]).sort_values(["node", "text_key"])
        sets = [np.frombuffer(g, np.uint64) for g in frame["grams"]]
        side, node, text, copies = (frame[c].to_numpy() for c in ("side", "node", "text_key", "copies"))
        left = np.flatnonzero(side <= 0)
        right = left if (side == -1).all() else np.flatnonzero(side == 1)
        common = common_grams([sets[i] for i in left], [sets[i] for i in right]) if len(left) and len(right) else np.zeros((len(left), len(right)), np.int64)
        size = np.array([len(s) for s in sets])
        either = size[left][:, None] + size[right][None, :] - common
        linked = (common * share.denominator >= either * share.numerator) & (common > 0)
        linked &= (node[left][:, None] != node[right][None, :]) | (text[left][:, None] != text[right][None, :])
        links, documents = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        links[left] += linked.sum(1)
        documents[left] += linked @ copies[right]
        if right is not left:
            links[right] += linked.sum(0)
            documents[right] += copies[left] @ linked
        a, b = np.nonzero(linked)
        root = _roots(len(node), left[a], right[b])
        return pa.table({"node": node, "text_key": text, "root": node[root], "links": links, "documents": documents})

    return run


def jaccard_links(documents: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9995) -> DataFrame:
    """``(doc_id, class_id, copy_id, n_links, n_text_links)`` for every row of ``documents(doc_id, text)``.

    Two texts are linked when the Jaccard similarity of their sets of ``n`` words is at least ``threshold``; a pair at the
    threshold is found with probability ``recall`` or more, a closer one with more than that, equal sets always.
    ``class_id`` is the smallest doc_id that links lead to, ``copy_id`` the smallest one with the same set, ``n_links``
    counts linked rows, those with an equal set included, and ``n_text_links`` linked sets other than the own one.

    Texts without a word (empty, null) are linked to nothing and are their own class. Texts of fewer than ``n`` words
    have one gram. Repeated rows are copies of each other; a doc_id with several texts joins what these are linked to.
    Rows without doc_id are left out. Other columns are ignored; an empty table gives an empty result.
    """
    bands, rows = choose_bands(threshold, recall)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")).where("doc_id is not null")
    profile = stage(
        docs.mapInArrow(_profiles(bands, rows, n), "doc_id long, text_key long, set_key binary, n_grams int, bands array<long>"), "profiles"
    )
    # A class is named by its smallest doc_id, and by the text there, as one doc_id may lead several classes.
    first = F.min(F.struct(F.col("doc_id").alias("node"), "text_key")).alias("first")
    classes = profile.where("set_key is not null").groupBy("set_key").agg(first, F.count("*").alias("copies"), F.max("n_grams").alias("n_grams"))
    classes = stage(classes.select("set_key", "first.*", "copies", "n_grams"), "classes")

    # Buckets with more than one class. A bucket is led by its smallest class; all others hang on that one.
    own_key = profile.select(F.col("doc_id").alias("node"), "set_key", "bands").dropDuplicates(["node", "set_key"])
    signed = classes.join(own_key, ["node", "set_key"]).select("node", "text_key", "copies", "n_grams", "bands")
    banded = stage(signed.select("node", "text_key", F.posexplode("bands").alias("band", "bucket")), "bands")
    buckets = banded.groupBy("band", "bucket").agg(F.min("node").alias("lead"), F.count("*").alias("members"))
    buckets, heaviest = stage_counted(buckets.where("members > 1"), "members")
    met = stage(hot_lookup(banded, buckets, ["band", "bucket"], "members", heaviest), "met")

    # Blocks of bounded rows and n-grams. A class goes with the smallest lead of its buckets, so copies of one text share
    # a block; where a bucket spans blocks, each pair of these is verified too. No pair that meets in a bucket is left out.
    homes = met.groupBy("node", "text_key").agg(F.min("lead").alias("home"))
    sized = homes.join(classes.select("node", "text_key", "copies", "n_grams"), ["node", "text_key"])
    per_home = sized.groupBy("home").agg(F.count("*").alias("members"), F.sum("n_grams").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("long")
    per_home, largest = stage_counted(per_home.select("home", "members", blocks.alias("blocks")), "members")
    placed = hot_lookup(sized, per_home, ["home"], "members", largest)
    block = F.struct("home", F.pmod(F.xxhash64("node", "text_key"), F.col("blocks")).alias("part")).alias("block")
    placed = stage(placed.select("node", "text_key", "copies", block), "blocks")
    seen = met.join(placed.select("node", "text_key", "block"), ["node", "text_key"]).groupBy("band", "bucket").agg(F.collect_set("block").alias("blocks"))
    seen = seen.where(F.size("blocks") > 1).select(F.sort_array("blocks").alias("blocks")).distinct()
    one = seen.select("blocks", F.posexplode("blocks").alias("at", "block"))
    across = one.select("block", F.explode(F.slice("blocks", F.col("at") + 2, F.greatest(F.lit(0), F.size("blocks")))).alias("other")).distinct()
    left = across.select("block", F.struct("block", "other", F.lit(0).alias("side")).alias("unit"))
    right = across.select(F.col("other").alias("block"), F.struct("block", "other", F.lit(1).alias("side")).alias("unit"))
    units = left.unionByName(right).groupBy("block").agg(F.collect_list("unit").alias("units"))
    unit = "array<struct<block:struct<home:long,part:long>,other:struct<home:long,part:long>,side:int>>"
    own_unit = F.array(F.struct("block", F.col("block").alias("other"), F.lit(-1).alias("side"))).cast(unit)
    members = placed.join(units, "block", "left").select(
        F.col("node").alias("doc_id"), "text_key", "copies", F.concat(own_unit, F.coalesce(F.col("units").cast(unit), F.array().cast(unit))).alias("units")
    )
    sets = docs.join(members, ["doc_id", "text_key"]).mapInArrow(
        _gram_sets(n), f"doc_id long, text_key long, copies long, units {unit}, grams binary"
    )
    work = sets.select(F.col("doc_id").alias("node"), "text_key", "copies", "grams", F.explode("units").alias("unit")).select("node", "text_key", "copies", "grams", "unit.*")
    found = stage(
        work.groupBy("block", "other").applyInArrow(_verify(threshold), "node long, text_key long, root long, links long, documents long"),
        "links",
    )
    unstage(banded, met, placed, buckets, per_home)
    grouped = components(found.where("root <> node").select(F.col("node").alias("u"), F.col("root").alias("v")))
    linked = found.groupBy("node", "text_key").agg(F.sum("links").alias("links"), F.sum("documents").alias("documents"))

    described = classes.join(grouped, "node", "left").join(linked, ["node", "text_key"], "left").select(
        "set_key",
        "copies",
        F.coalesce("component", "node").alias("class_id"),
        F.col("node").alias("copy_id"),
        (F.col("copies") - 1 + F.coalesce("documents", F.lit(0))).alias("n_links"),
        F.coalesce("links", F.lit(0)).alias("n_text_links"),
    )
    with_words = hot_lookup(profile.where("set_key is not null").select("doc_id", "set_key"), described.withColumn("matches", F.col("copies")), ["set_key"], "matches")
    silent = profile.where("set_key is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_text_links")
    )
    return with_words.select(silent.columns).unionByName(silent)
