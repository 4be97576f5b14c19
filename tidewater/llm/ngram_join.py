"""Operator 3: n-gram Jaccard join by T-occurrence search (DivideSkip).

Two texts link when their shingle sets reach ``percent`` Jaccard. A text of n
shingles can only link if at least T = ceil(percent * n / 100) of them occur
in a partner, which the search uses in three steps:

1. Sieve. Shingles in the lowest quarter of the hash space are counted over
   all texts. A text with more than n - T shingles there that no other text
   has cannot link; nothing else of it is looked at. (No false negatives; the
   keys that remain go into a Bloom filter of bounded size.)
2. Lists. The remaining texts, equal sets collapsed into one, are indexed by
   shingle. Of a text's r shared shingles, the L = T - ``MERGED`` with the
   longest inverted lists aren't merged; the others are its short lists. They
   are merged with a heap, which counts each candidate's occurrences: every
   partner is in T - L = ``MERGED`` of them at least (in all T, if T is less),
   candidates met less often go. The L longer lists are binary-probed, which
   is done on the candidate's own sorted shingles (the transposed index).
   Probing ends as soon as T can't be reached.
3. Lists longer than ``max_list`` are never spread into pairs (a partner met in
   none of them is met in ``MERGED`` others). Lists with the
   same smallest-hash member (hub) are a bundle; every member is probed against
   the hub, and a bundle that is one component then is done. The others are
   dealt into chunks of bounded size, and every two chunks are compared in a
   task of their own, which gives a forest of links, not the pairs.

Every link between different sets either is found or lies inside a component
already, so components are exact; they are joined by contraction.

Rules for odd input: null or wordless texts have no shingles and link with
nothing; rows are told apart by id and text, so a row repeated with the same
id and text is one document; a null id takes part and never is a component's
id while there is another; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import bloom
from tidewater.llm.common import ship_by_value, small_batches, stored, table
from tidewater.llm.components import components
from tidewater.llm.shingles import shingle_sets

MAX_LIST = 64
MERGED = 2           # T - L: occurrences in the merged lists that make a candidate
CHUNK = 1024         # sets compared with each other at a time, of long lists
_QUARTER = np.uint64(1 << 62)


def _needed(percent: int, n: str = "n") -> Column:
    """T: the overlap without which a set of n can't link."""
    return F.expr(f"cast(({percent} * {n} + 99) div 100 as long)")


def _merged(percent: int, n: str = "n") -> Column:
    """T - L: the occurrences in the merged lists without which two sets can't link, the smaller one of n."""
    return F.least(F.lit(MERGED).cast("long"), _needed(percent, n))


def _thin(words: int):
    """Batches of (key, id, text) to (key, id, n, q): set size and its lowest quarter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(shingle_sets(b.column("text").to_pylist(), words))
            q = [s[:np.searchsorted(s, _QUARTER)].view(np.int64) for s in sets]
            flat = pa.array(np.concatenate(q) if q else np.zeros(0, np.int64))
            at = pa.array(np.cumsum([0] + [len(x) for x in q]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), b.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.ListArray.from_arrays(at, flat)], ["key", "id", "n", "q"])
    return run


def _full(words: int):
    """Batches of (key, text) to (key, n, digest, s): the whole set and its digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = list(shingle_sets(b.column("text").to_pylist(), words))
            flat = pa.array((np.concatenate(sets) if sets else np.zeros(0, np.uint64)).view(np.int64))
            at = pa.array(np.cumsum([0] + [len(x) for x in sets]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.ListArray.from_arrays(at, flat)], ["key", "n", "digest", "s"])
    return run


def heap_merge(lists: list[list[int]]) -> list[tuple[int, int]]:
    """Merge sorted lists of ids with a heap: each id with the number of lists it is in."""
    out: list[tuple[int, int]] = []
    last, count = None, 0
    for v in heapq.merge(*lists):
        if v == last:
            count += 1
            continue
        if count:
            out.append((last, count))
        last, count = v, 1
    if count:
        out.append((last, count))
    return out


def reaches(x: np.ndarray, y: np.ndarray, need: int, step: int = 64) -> int:
    """|x & y| of sorted arrays by binary probes into y, or -1 once ``need`` is out of reach."""
    found, left = 0, len(x)
    if min(len(x), len(y)) < need:
        return -1
    for a in range(0, len(x), step):
        part = x[a:a + step]
        at = np.searchsorted(y, part)
        found += int((y[np.minimum(at, len(y) - 1)] == part).sum()) if len(y) else 0
        left -= len(part)
        if found + left < need:
            return -1
    return found


def _merge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        xs, ys = [], []
        for x, need, lists in zip(*(b.column(c).to_pylist() for c in ("x", "need", "lists"))):
            for y, count in heap_merge(lists):
                if count >= need:
                    xs.append(x)
                    ys.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(xs, pa.int64()), pa.array(ys, pa.int64())], ["x", "y"])


def _probe_rows(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y, nx, ny = (b.column(c).to_pylist() for c in ("x", "y", "nx", "ny"))
            sx, sy = b.column("sx"), b.column("sy")
            keep = []
            for i in range(len(x)):
                need = -(-percent * (nx[i] + ny[i]) // (100 + percent))
                keep.append(reaches(sx[i].values.to_numpy(), sy[i].values.to_numpy(), need) >= need)
            m = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("x").filter(m), b.column("y").filter(m)], ["a", "b"])
    return run


def _probe(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that link, as edges (a, b)."""
    at_x = sets.select(F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("s").alias("sx"))
    at_y = sets.select(F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("s").alias("sy"))
    return stored(pairs.join(at_x, "x").join(at_y, "y").mapInArrow(_probe_rows(percent), "a long, b long"), "links")


def _sieve(thin: DataFrame, percent: int) -> DataFrame:
    """(key) of the texts that the counts of the lowest quarter don't rule out."""
    seen = thin.select("key", F.explode("q").alias("h")).groupBy("h").agg(F.min("key").alias("key"), F.max("key").alias("k2"))
    alone = seen.where("key = k2").groupBy("key").agg(F.count(F.lit(1)).alias("alone"))
    return (thin.where("n > 0").select("key", "n").join(alone, "key", "left")
                .where(F.coalesce("alone", F.lit(0)) <= F.col("n") - _needed(percent)).select("key"))


def _index(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Shared shingles of the sets that can still link, and their short lists' entries."""
    rows = sets.select("rep", "n", F.explode("s").alias("h"))
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = (rows.join(counts, "h").groupBy("rep").agg(F.first("n").alias("n"), F.collect_list(F.struct("c", "h")).alias("s"))
                  .where(F.size("s") >= _needed(percent)))
    sets = stored(shared.select("rep", "n", F.sort_array(F.col("s.h")).alias("s"),
                                F.slice(F.sort_array("s"), F.lit(1), (F.size("s") - _needed(percent) + _merged(percent)).cast("int"))
                                 .alias("short")), "sets")
    entries = sets.select("rep", "n", F.explode("short.h").alias("h"))
    return sets.drop("short"), entries


def _short_pairs(entries: DataFrame, percent: int, max_list: int) -> DataFrame:
    """Candidates (x, y) from the lists of at most ``max_list`` entries."""
    lists = entries.groupBy("h").agg(F.sort_array(F.collect_list(F.struct("n", "rep"))).alias("l"))
    after = lists.select(F.posexplode("l").alias("i", "e"), "l").select(
        F.col("e.rep").alias("x"), _merged(percent, "e.n").alias("need"), F.expr(
            f"sort_array(transform(filter(slice(l, i + 2, {max_list}), y -> 100 * e.n >= {percent} * y.n), y -> y.rep))").alias("ys"))
    return (after.where(F.size("ys") > 0).groupBy("x").agg(F.first("need").alias("need"), F.collect_list("ys").alias("lists"))
                 .mapInArrow(_merge_rows, "x long, y long"))


def _block_links(percent: int):
    """Links between the two chunks of a block (or within one), a forest of them, by blocked matrix products."""
    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("rep", kind="stable").reset_index(drop=True)
        n, lens = b["n"].to_numpy(), b["s"].map(len).to_numpy()
        _, col = np.unique(np.concatenate(b["s"].to_list()), return_inverse=True)
        row = np.repeat(np.arange(len(b)), lens)
        order = np.argsort(col, kind="stable")
        col, row = col[order], row[order]
        left = np.flatnonzero(b["chunk"] == b["i"])
        right = np.flatnonzero(b["chunk"] == b["j"])
        both = np.zeros((len(left), len(right)), np.float32)
        for c in range(0, int(col[-1]) + 1, 4096):   # dense in slices: bounded memory
            lo, hi = np.searchsorted(col, [c, c + 4096])
            m = np.zeros((len(b), 4096), np.float32)
            m[row[lo:hi], col[lo:hi] - c] = 1
            both += m[left] @ m[right].T
        links = np.argwhere((100 + percent) * both.astype(np.int64) >= percent * (n[left][:, None] + n[right][None, :]))
        labels, reps = b["label"].tolist(), b["rep"].tolist()
        root: dict[int, int] = {}

        def find(v: int) -> int:
            while (q := root.setdefault(v, v)) != v:
                root[v] = v = root[q]
            return v

        out = []
        for x, y in links:
            x, y = left[x], right[y]
            lx, ly = find(labels[x]), find(labels[y])
            if lx != ly:
                root[lx] = ly
                out.append((reps[x], reps[y]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def _long_links(entries: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, chunk: int) -> DataFrame:
    """The labels after the links of the long lists.

    Lists with the same hub (the member with the smallest hash) are one
    bundle. Every member is probed against the hub; bundles that are one
    component then are done. The others are dealt into chunks and every two
    chunks are compared in a task of their own.
    """
    order = F.struct(F.xxhash64("rep"), "rep")
    hubs = entries.groupBy("h").agg(F.min(order).alias("o")).select("h", F.col("o.rep").alias("hub"))
    members = stored(entries.join(hubs, "h").groupBy("hub", "rep").agg(F.first("n").alias("n")), "bundles")
    if members.isEmpty():
        return labels
    star = members.where("hub <> rep").select(F.least("hub", "rep").alias("x"), F.greatest("hub", "rep").alias("y")).distinct()
    labels = relabel(labels, _probe(star, sets, percent))
    named = members.join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    open_ = (named.groupBy("hub").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"))
                  .where("lo <> hi").select("hub", F.expr(f"cast((size + {chunk} - 1) div {chunk} as int)").alias("chunks")))
    dealt = (named.join(open_, "hub").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
                  .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
                  .select("hub", "rep", "label", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")))
    blocks = dealt.join(sets.select("rep", "n", "s"), "rep").groupBy("hub", "i", "j")
    return relabel(labels, stored(blocks.applyInPandas(_block_links(percent), "a long, b long"), "links"))


def relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components after adding ``links`` to those of ``labels``."""
    if links.isEmpty():
        return labels
    return components(links.union(labels.select("v", "label")))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
                max_list: int = MAX_LIST, chunk: int = CHUNK, max_words: int = bloom.MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(key, id, n)`` of every row, and ``(key, id, label)`` of the rows that have links.

    The key is a hash of id and text; rows of one component have one label.
    """
    src = small_batches(docs).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.withColumn("key", F.xxhash64("id", "text"))
    id_type = src.schema["id"].dataType.simpleString()
    thin = stored(src.select("key", "id", "text").mapInArrow(_thin(words), f"key long, id {id_type}, n long, q array<long>"), "thin")

    left = stored(_sieve(thin, percent), "left")
    size = bloom.n_words(left.count(), max_words)
    some = stored(bloom.member_filter(bloom.with_bits(left, F.xxhash64("key"), size)), "bloom")
    again = bloom.probe(bloom.with_bits(src.select("key", "text"), F.xxhash64("key"), size), some, "maybe").where("maybe")
    full = stored(again.select("key", "text").mapInArrow(_full(words), "key long, n long, digest binary, s array<long>")
                       .where("n > 0"), "full")

    equal = full.groupBy("digest").agg(F.min_by(F.struct("key", "n", "s"), "key").alias("r"))
    reps = stored(equal.select("digest", F.col("r.key").alias("rep"), F.col("r.n").alias("n"), F.col("r.s").alias("s")), "reps")
    sets, entries = _index(reps.select("rep", "n", "s"), percent)
    size_of = entries.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    entries = stored(entries.join(size_of, "h"), "entries")
    links = _probe(_short_pairs(entries.where(F.col("c") <= max_list), percent, max_list), sets, percent)
    labels = components(links)
    labels = _long_links(entries.where(F.col("c") > max_list).select("h", "rep", "n"), sets, labels, percent, chunk)

    member = (full.select("key", "digest").distinct().join(reps.select("digest", "rep"), "digest")
                  .join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left")
                  .select("key", F.coalesce("label", "rep").alias("label")))
    ids = thin.select("key", "id").distinct()
    return thin.select("key", "id", "n"), stored(member.join(ids, "key"), "members")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
                     max_list: int = MAX_LIST, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable) of every row."""
    thin, member = near_groups(docs, id_col, text_col, words, percent, max_list, chunk)
    least = member.groupBy("label").agg(F.min("id").alias("least"))
    named = member.join(least, "label").select("key", "least")
    return (thin.join(named, "key", "left")
                .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
                         max_list: int = MAX_LIST, chunk: int = CHUNK, max_words: int = bloom.MAX_WORDS) -> DataFrame:
    """The rows of ``docs``, one of each component (the smallest id), columns unchanged.

    Rows that a Bloom filter of the dropped keys clears are not shuffled.
    """
    _, member = near_groups(docs, id_col, text_col, words, percent, max_list, chunk, max_words)
    order = F.struct(F.col("id").isNull(), "id", "key")
    stays = member.groupBy("label").agg(F.min(order).alias("o")).select("label", F.col("o.key").alias("stay"))
    dropped = stored(member.join(stays, "label").where("key <> stay").select("key"), "dropped")
    size = bloom.n_words(dropped.count(), max_words)
    some = stored(bloom.member_filter(bloom.with_bits(dropped, F.xxhash64("key"), size)), "bloom")
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                        F.xxhash64(docs[id_col], F.coalesce(docs[text_col], F.lit(""))).alias("key"))
    probed = bloom.probe(bloom.with_bits(keyed, F.xxhash64("key"), size), some, "maybe")
    clear = probed.where("NOT maybe").select("row.*")
    return clear.unionByName(probed.where("maybe").join(dropped, "key", "left_anti").select("row.*"))


def op3_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), words=4, percent=85)


ship_by_value(__name__)
