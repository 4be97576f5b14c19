"""Operator 11: source divergence audit over a minimal acyclic transducer vocabulary.

1. Terms that occur in enough documents of a language are kept (one shuffle of
   distinct terms, combined in the map tasks).
2. The kept terms are range-sorted; each task turns runs of at most ``BLOCK``
   sorted terms into a minimal acyclic transducer over UTF-8 bytes whose
   outputs add up to a term's lexicographic ordinal.
3. The bytes of all texts are streamed through the transducers: all terms of a
   chunk take their next byte at once, and what arrives in an accepting state is
   counted by (language, source, ordinal).
4. Groups are compared in slices of ordinals; ties between terms go by ordinal,
   and only the ordinals that are reported are spelled out again.

The vocabulary grows with the corpus. What is broadcast does not: at most
``PASS_BYTES`` of transducers go out at once (and one transducer at least), a
larger vocabulary takes several passes over the texts. The driver sees one
(language, first term, size) row a transducer, and those bytes.

Rules for odd input: null text, language or source count as ''; a row is a
document, so repeated rows count each; a text without terms still makes its
group occur; a language without kept terms has pairs of value 0 and no term
rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, small_batches, stored, table
from tidewater.session import sized_broadcast

MIN_DOCS = 3            # documents of its language that a kept term is in, at least
TOP_TERMS = 200         # ranks that are reported of a group's terms
UNIT = 1_000_000_000    # a share of 1
BLOCK = 1 << 18         # terms of a transducer, at most
PASS_BYTES = 64 << 20   # bytes of transducers that are broadcast at once
CHUNK_BYTES = 8 << 20   # bytes of text that are streamed at once (a longer text is taken whole)
HELD = 1 << 20          # counts that a task holds before it hands them on
SLICE = 256             # ordinals that two groups are compared on in one piece of work
TILE = 64               # about as many sources of a language are compared at once

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IN_TERM = np.zeros(256, bool)
IN_TERM[97:123] = IN_TERM[128:] = True
TO_WORDS = np.where(IN_TERM[FOLD], FOLD, 32).astype(np.uint8).tobytes()  # letters folded, all that is no term a space


class Builder:
    """Minimal acyclic transducer of terms that arrive in byte order.

    A state is the tuple of its outgoing edges and whether it accepts; states
    that no later term can change are looked up in a register, so equal
    right languages are one state. ``size`` counts the terms below a state.
    """

    def __init__(self) -> None:
        self.register: dict[tuple, int] = {}
        self.states: list[tuple[tuple, bool]] = []
        self.size: list[int] = []
        self.path: list[list] = [[[], False]]  # open states along the last term: edges (label, target), accepts
        self.last = b""

    def _close(self, state: list) -> int:
        key = (tuple(state[0]), state[1])
        if key not in self.register:
            self.register[key] = len(self.states)
            self.states.append(key)
            self.size.append(state[1] + sum(self.size[t] for _, t in state[0]))
        return self.register[key]

    def _shorten(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            closed = self._close(self.path.pop())
            self.path[-1][0].append((self.last[len(self.path) - 1], closed))

    def add(self, term: bytes) -> None:
        same, most = 0, min(len(term), len(self.last))
        while same < most and term[same] == self.last[same]:
            same += 1
        self._shorten(same)
        self.path.extend([[], False] for _ in range(len(term) - same))
        self.path[-1][1] = True
        self.last = term

    def finish(self) -> bytes:
        """The transducer as a double array, see :class:`Transducer`."""
        self._shorten(0)
        root = self._close(self.path.pop())
        base = _places([[c for c, _ in edges] for edges, _ in self.states])
        slots = int(base.max()) + 512
        check, target, output = (np.full(slots, fill, np.int32) for fill in (-1, 0, 0))
        accepts = np.zeros(slots, np.uint8)
        for (edges, ends), own in zip(self.states, base.tolist()):
            accepts[own] = smaller = int(ends)  # the term that ends here comes before all longer ones
            for c, t in edges:
                check[own + c], target[own + c], output[own + c] = own, base[t], smaller
                smaller += self.size[t]
        head = np.array([base[root], slots], np.int64)
        return b"".join(x.tobytes() for x in (head, check, target, output, accepts))


def _places(labels: list[list[int]], window: int = 1024) -> np.ndarray:
    """A base for each state, no two alike, so that base + label is no other state's: first fit, states of many edges first."""
    base = np.zeros(len(labels), np.int64)
    free, fresh = np.ones(1 << 14, bool), np.ones(1 << 14, bool)
    low, edges = 0, -1
    for s in sorted(range(len(labels)), key=lambda s: -len(labels[s])):
        if len(labels[s]) != edges:
            low, edges = 0, len(labels[s])
        at = low
        while True:
            if at + window + 256 > len(free):
                free, fresh = (np.concatenate([x, np.ones(len(x), bool)]) for x in (free, fresh))
            fits = fresh[at:at + window].copy()
            for c in labels[s]:
                fits &= free[at + c:at + c + window]
            k = int(fits.argmax())
            if fits[k]:
                break
            low, at = (low + window if at == low else low), at + window
        base[s] = at + k
        fresh[at + k] = False
        free[[at + k + c for c in labels[s]]] = False
    return base


@dataclass
class Transducer:
    """Double array: a state is its base; byte c leads from it to ``target[base + c]`` if ``check`` there names the state.

    A walk adds up ``output``; in an accepting state the sum is the term's ordinal.
    """
    root: int
    check: np.ndarray
    target: np.ndarray
    output: np.ndarray
    accepts: np.ndarray

    @classmethod
    def load(cls, blob: bytes) -> "Transducer":
        root, n = np.frombuffer(blob, np.int64, 2).tolist()
        check, target, output = (np.frombuffer(blob, np.int32, n, 16 + 4 * n * k).astype(np.int64) for k in range(3))
        return cls(root, check, target, output, np.frombuffer(blob, np.uint8, n, 16 + 12 * n))

    def ordinals(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Ordinal of each term ``data[start:start + length]``, -1 where it isn't in the vocabulary; all take their next byte at once."""
        order = np.argsort(-length, kind="stable")  # those that still have a byte are always the first ones
        at, falling = start[order], -length[order]
        state, total = np.full(len(at), self.root, np.int64), np.zeros(len(at), np.int64)
        dead = len(self.check) - 256  # nothing leads on from here
        n, k = len(at), 0
        while n := int(np.searchsorted(falling[:n], -k)):  # lengths above k
            slot = state[:n] + data[at[:n] + k]
            ok = self.check[slot] == state[:n]
            total[:n] += self.output[slot]
            state[:n] = np.where(ok, self.target[slot], dead)
            k += 1
            if n < 64 and not ok.any():
                break
        out = np.empty(len(at), np.int64)
        out[order] = np.where(self.accepts[state] == 1, total, -1)
        return out

    def terms(self) -> Iterator[bytes]:
        """All terms in the order of their ordinals."""
        edges = np.argsort(self.check, kind="stable")  # a state's edges in the order of their bytes
        owner = self.check[edges]
        path, stack = bytearray(), [(self.root, 0, b"")]
        while stack:
            state, depth, byte = stack.pop()
            path[depth:] = byte
            if self.accepts[state]:
                yield bytes(path)
            for e in edges[np.searchsorted(owner, state):np.searchsorted(owner, state, "right")][::-1].tolist():
                stack.append((int(self.target[e]), len(path), bytes([e - state])))


def clean(docs: DataFrame) -> DataFrame:
    """lang, source and text of every document, nulls as ''."""
    return docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, documents that have it) of one task's texts; partial sums."""
    seen: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in seen.items():
            terms = pa.array(list(counts), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), terms, pa.array(list(counts.values()), pa.int64())],
                                             names=["lang", "term", "n"])
        seen.clear()

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
            seen.setdefault(lang, Counter()).update(set(text.translate(TO_WORDS).split()))
        if sum(map(len, seen.values())) > HELD // 2:
            yield from out()
    yield from out()


def kept_terms(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang and term of the terms in at least ``min_docs`` documents of the language."""
    found = small_batches(rows).select("lang", "text").mapInArrow(_terms, "lang string, term string, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


def _build(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Transducers of a task's sorted (lang, term) rows."""
    made: Builder | None = None
    lang, first, n = "", b"", 0

    def row() -> pa.RecordBatch:
        blob = made.finish()
        return pa.RecordBatch.from_pydict({"lang": [lang], "first": [first], "n": [n], "bytes": [len(blob)], "blob": [blob]},
                                          schema=pa.schema([("lang", pa.string()), ("first", pa.binary()), ("n", pa.int64()),
                                                            ("bytes", pa.int64()), ("blob", pa.binary())]))

    for b in batches:
        for now, term in zip(b.column("lang").to_pylist(), b.column("term").cast(pa.binary()).to_pylist()):
            if made is None or now != lang or n == block:
                if made is not None:
                    yield row()
                made, lang, first, n = Builder(), now, term, 0
            made.add(term)
            n += 1
    if made is not None:
        yield row()


def transducers(kept: DataFrame, block: int = BLOCK) -> DataFrame:
    """lang, first, n, bytes, blob: one row a transducer, and ``start``, the ordinal of its first term in the language."""
    parts = max(1, -(-kept.count() // block) * 2)
    ordered = kept.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    built = stored(ordered.mapInArrow(partial(_build, block=block), "lang string, first binary, n long, bytes long, blob binary"), "transducers")
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    starts = built.select("lang", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return stored(built.join(starts, ["lang", "first"]), "vocabulary")


class Vocabulary:
    """The transducers of one pass: by language in lexicographic order."""

    def __init__(self, blocks: list[tuple[str, bytes, int, bytes]]):
        self.by_lang: dict[str, list[tuple[int, Transducer]]] = {}
        self.bounds: dict[str, np.ndarray] = {}
        for lang, first, start, blob in sorted(blocks, key=lambda r: (r[0], r[1])):
            self.by_lang.setdefault(lang, []).append((start, Transducer.load(blob)))
            self.bounds.setdefault(lang, []).append(int.from_bytes(first[:8].ljust(8, b"\0"), "big"))
        self.bounds = {k: np.array(v, np.uint64) for k, v in self.bounds.items()}

    def ordinals(self, lang: str, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Each term walks the transducers whose range its first eight bytes may be in: one, save at a boundary."""
        blocks = self.by_lang.get(lang, [])
        if len(blocks) == 1:
            out = blocks[0][1].ordinals(data, start, length)
            return np.where(out >= 0, out + blocks[0][0], -1)
        out = np.full(len(start), -1, np.int64)
        if not blocks:
            return out
        key = np.zeros(len(start), np.uint64)
        for k in range(8):
            byte = np.where(k < length, data[np.minimum(start + k, len(data) - 1)], 0)
            key = (key << np.uint64(8)) | byte.astype(np.uint64)
        low = np.searchsorted(self.bounds[lang], key, "left") - 1
        high = np.searchsorted(self.bounds[lang], key, "right") - 1
        for i, (base, t) in enumerate(blocks):
            who = np.flatnonzero((low <= i) & (i <= high) & (out < 0))
            if len(who):
                found = t.ordinals(data, start[who], length[who])
                out[who] = np.where(found >= 0, found + base, -1)
        return out


def term_spans(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, and start, length and row of each term; ``rows`` are the offsets of the texts in ``raw``."""
    data = FOLD[raw]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = IN_TERM[data]
    edge = np.zeros(len(data) + 1, bool)  # a text begins here: no term goes on across it
    edge[rows] = True
    before = np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(inside & (~before | edge))
    end = np.flatnonzero(before & (~inside | edge))
    return data, start, end - start, np.searchsorted(rows, start, "right") - 1


def _recount(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    """Occurrences of kept terms by (lang, source, ordinal) of one task's texts; partial sums."""
    vocabulary = vocabulary.value
    groups: dict[tuple[str, str], int] = {}
    held: list[tuple[np.ndarray, np.ndarray]] = []  # group << 40 | ordinal, occurrences
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ord", pa.int64()), ("n", pa.int64())])

    def size() -> int:
        return sum(len(codes) for codes, _ in held)

    def merged() -> tuple[np.ndarray, np.ndarray]:
        codes, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        return codes[new], np.add.reduceat(n, new)

    def out() -> pa.RecordBatch:
        (codes, n), names = merged(), list(groups)
        lang, source = (pa.array([g[k] for g in names], pa.string()).take(pa.array(codes >> 40)) for k in (0, 1))
        return pa.RecordBatch.from_arrays([lang, source, pa.array(codes & ((1 << 40) - 1)), pa.array(n)], schema=schema)

    for b in batches:
        text = b.column("text").cast(pa.large_string())
        offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
        body = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        keys = list(zip(b.column("lang").to_pylist(), b.column("source").to_pylist()))
        ids = np.array([groups.setdefault(k, len(groups)) for k in keys], np.int64)
        langs = np.array([k[0] for k in keys], object)
        at = 0
        while at < len(keys):  # whole texts up to CHUNK_BYTES, one at least
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
            data, start, length, row = term_spans(body[offsets[at]:offsets[to]], offsets[at:to] - offsets[at])
            for lang in set(langs[at:to]) & set(vocabulary.by_lang):
                own = np.flatnonzero((langs[at:to] == lang)[row])
                if len(own):
                    found = vocabulary.ordinals(lang, data, start[own], length[own])
                    hit = found >= 0
                    pairs = ids[at:to][row[own[hit]]] * (1 << 40) + found[hit]
                    if len(pairs):
                        held.append(np.unique(pairs, return_counts=True))
            at = to
            if size() > HELD:
                held = [merged()]
                if size() > HELD // 2:
                    yield out()
                    held, groups = [], {}
                    ids = np.array([groups.setdefault(k, len(groups)) for k in keys], np.int64)
    if held:
        yield out()


def recount(rows: DataFrame, vocab: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """lang, source, ord, n of every kept term that occurs, counted by streaming all texts through the transducers."""
    spark = rows.sparkSession
    sizes = vocab.select("lang", "first", "bytes").orderBy("lang", "first").collect()
    passes, room = [], 0
    for r in sizes:
        if not passes or r["bytes"] > room:
            passes.append([])
            room = pass_bytes
        passes[-1].append((r["lang"], r["first"]))
        room -= r["bytes"]
    schema = "lang string, source string, ord long, n long"
    counted = spark.createDataFrame([], schema)
    for own in passes:
        (lang, first), (to_lang, to_first) = own[0], own[-1]
        from_ = (F.col("lang") > lang) | ((F.col("lang") == lang) & (F.col("first") >= F.lit(bytes(first))))
        to = (F.col("lang") < to_lang) | ((F.col("lang") == to_lang) & (F.col("first") <= F.lit(bytes(to_first))))
        blocks = [(r["lang"], bytes(r["first"]), r["start"], bytes(r["blob"])) for r in vocab.where(from_ & to).collect()]
        shared = spark.sparkContext.broadcast(Vocabulary(blocks))
        counted = counted.unionByName(small_batches(rows).mapInArrow(partial(_recount, vocabulary=shared), schema))
    return counted.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))


def share(n: str, of: str, v: str) -> Column:
    """1 + floor(UNIT * (n + 1) / (of + v)), exact; null where there are no terms."""
    whole = "decimal(38,0)"
    return F.expr(f"1 + (cast({UNIT} as decimal(10,0)) * (cast({n} as decimal(20,0)) + 1)) div nullif(cast({of} + {v} as {whole}), 0)").cast("long")


def _pair_sums(b: pd.DataFrame, width: int) -> pd.DataFrame:
    """Summed divergences between all sources of two tiles over one slice of ordinals."""
    mark = b[b["ord"] < 0].sort_values("source")
    names, tile = mark["source"].to_numpy(), mark["tile"].to_numpy()
    terms = b[b["ord"] >= 0]
    lang, i, j, piece = (b[c].iat[0] for c in ("lang", "i", "j", "piece"))
    p = np.repeat(mark["p"].to_numpy(np.int64)[:, None], max(0, min(width, int(b["v"].iat[0]) - int(piece) * width)), 1)
    p[np.searchsorted(names, terms["source"].to_numpy()), terms["ord"].to_numpy() - piece * width] = terms["p"].to_numpy(np.int64)
    values = np.full((len(names), len(names)), -1, np.int64)
    for g in range(len(names)):
        other = tile == (j if tile[g] == i else i)
        values[g, other] = ((p[g] - p[other]) ** 2 // p[other]).sum(1)
    np.fill_diagonal(values, -1)
    a, c = np.nonzero(values >= 0)
    return pd.DataFrame({"lang": lang, "source": names[a], "item": names[c], "value": values[a, c]})


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, block: int = BLOCK,
                pass_bytes: int = PASS_BYTES, width: int = SLICE, tile: int = TILE) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others and from its whole language."""
    rows = clean(docs)
    vocab = transducers(stored(kept_terms(rows, min_docs), "kept"), block)
    counts = stored(recount(rows, vocab, pass_bytes), "recount")

    sizes = vocab.groupBy("lang").agg(F.sum("n").alias("v"))
    groups = rows.select("lang", "source").distinct()
    seen = counts.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    whole = seen.groupBy("lang").agg(F.sum("own").alias("whole"))
    groups = groups.join(seen, ["lang", "source"], "left").join(langs, "lang").join(sizes, "lang", "left").join(whole, "lang", "left")
    groups = stored(groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("own", "whole", "v", "sources")]), "groups")
    tiles = F.ceil(F.col("sources") / tile)
    facts = groups.select("*", tiles.alias("tiles"), F.pmod(F.xxhash64("source"), tiles).alias("tile"),
                          F.coalesce(share("0", "own", "v"), F.lit(1)).alias("p0"))
    known = counts.join(sized_broadcast(groups), ["lang", "source"]).select(
        "lang", "source", "ord", "n", "own", "whole", "v", "sources", share("n", "own", "v").alias("p"))

    # pairs: every slice of ordinals meets every pair of tiles of its language
    marks = facts.select("lang", "source", "v", "tile", "tiles", F.lit(-1).cast("long").alias("ord"), F.col("p0").alias("p"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("v") / width) - 1, F.lit(0)))).alias("piece"))
    terms = known.select("lang", "source", "v", F.pmod(F.xxhash64("source"), tiles).alias("tile"), tiles.alias("tiles"), "ord", "p",
                         F.expr(f"ord div {width}").alias("piece"))
    both = marks.unionByName(terms).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("to"))
    both = both.select("lang", "source", "v", "tile", "ord", "p", "piece", F.least("tile", "to").alias("i"), F.greatest("tile", "to").alias("j"))

    def compare(b: pd.DataFrame) -> pd.DataFrame:
        return _pair_sums(b, width)

    sums = both.groupBy("lang", "i", "j", "piece").applyInPandas(compare, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    # terms above their language's share; ties by ordinal, the reported ones are spelled out by their transducer
    totals = counts.groupBy("lang", "ord").agg(F.sum("n").alias("all"))
    above = known.join(totals, ["lang", "ord"]).select("lang", "source", "ord", "p", share("all", "whole", "v").alias("q")).where("p > q")
    above = above.select("lang", "source", "ord", F.expr("((p - q) * (p - q)) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    best = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    best = best.join(vocab.select("lang", "start", "blob").mapInArrow(_spell, "lang string, ord long, item string"), ["lang", "ord"])
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of each transducer with their ordinals."""
    for b in batches:
        for lang, start, blob in zip(*(b.column(c).to_pylist() for c in ("lang", "start", "blob"))):
            terms = pa.array(list(Transducer.load(blob).terms()), pa.binary()).cast(pa.string())
            for at in range(0, len(terms), 10_000):
                part = terms.slice(at, 10_000)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(np.arange(len(part), dtype=np.int64) + start + at), part],
                                                 names=["lang", "ord", "item"])


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergences(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
o AS (SELECT lang, source, sum(n) AS own FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(o.own, 0) + v.v) AS BIGINT) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN o USING (lang, source) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v.v)) AS BIGINT) AS q
      FROM c JOIN v USING (lang) GROUP BY lang, term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p)::HUGEINT * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
y AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q)::HUGEINT * (p - q) // q AS BIGINT) AS value
      FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
      FROM (SELECT * FROM x UNION ALL SELECT * FROM y))
SELECT * FROM z WHERE part = 'pair' OR rank <= 200
"""

ship_by_value(__name__)
