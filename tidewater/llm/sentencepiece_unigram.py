"""Operator 5: SentencePiece unigram encoding and decoding.

Pieces lie in a double-array trie over UTF-8 bytes; Viterbi finds the
segmentation with the largest sum of log scores. A character without a piece
costs the smallest score less 10 and is written as byte pieces. Spaces are
written as the marker U+2581, with one in front of the text; decoding turns
markers back into spaces and drops the first.

Texts are cut where no piece can cross (before a marker run, around line
ends), the distinct parts of a batch are segmented together, one numpy step
per trie depth and per position, and texts are put together from them.

The public vocabulary is a merge list, whose scores are negated ranks; log
scores are derived from the ranks by Zipf's law (``scores="zipf"``), or used
as they are (``scores="model"``).

Rules for odd input: null and empty texts have no ids; a marker character in
a text decodes to a space (the one loss); very long parts only take more
steps; repeated rows are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, small_batches, table

MARK = "▁"
_PARTS = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
_UNKNOWN_COST = 10.0
_BATCH_BYTES = 1 << 20   # distinct parts segmented together
_GROUP_CHARS = 1 << 22   # texts cut into parts together
_KNOWN = 300_000         # parts whose ids a task remembers


@dataclass
class Trie:
    """Double array: from state s by byte c to ``base[s] + c`` if ``check`` there is s; ``value`` is a piece's id or -1."""
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @staticmethod
    def build(keys: dict[bytes, int]) -> Trie:
        kids: list[dict[int, int]] = [{}]
        ends = {}
        for k, v in keys.items():
            s = 0
            for c in k:
                t = kids[s].get(c)
                if t is None:
                    t = kids[s][c] = len(kids)
                    kids.append({})
                s = t
            ends[s] = v
        size = 2 * len(kids) + 1024
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        free = bytearray(b"\1") * size
        free[0] = 0
        check[0] = 0
        low = 1
        queue = [(0, 0)]
        for node, at in queue:  # grows while it is read
            if node in ends:
                value[at] = ends[node]
            codes = sorted(kids[node])
            if not codes:
                continue
            low = free.find(1, low)
            slot = max(low, codes[0] + 1)
            while True:
                slot = free.find(1, slot)
                b = slot - codes[0]
                if slot < 0 or b + codes[-1] >= size:
                    grow = size
                    base, check, value = (np.concatenate([a, np.full(grow, f, np.int32)]) for a, f in ((base, 0), (check, -1), (value, -1)))
                    free += bytearray(b"\1") * grow
                    size += grow
                    slot = max(1, slot)
                    continue
                if all(free[b + c] for c in codes):
                    break
                slot += 1
            base[at] = b
            for c in codes:
                free[b + c] = 0
                check[b + c] = at
                queue.append((kids[node][c], b + c))
        return Trie(base, check, value)


@dataclass
class Unigram:
    trie: Trie
    scores: np.ndarray          # by id
    byte_ids: np.ndarray        # id of each byte's piece
    pieces: list[bytes]         # what an id decodes to; control pieces to nothing

    @staticmethod
    def load(path: str | None = None, scores: str = "zipf") -> Unigram:
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        rank = np.array([-sp.get_score(i) for i in range(n)])
        log = -np.log(np.maximum(rank - rank[normal].min(), 0) + 2.0) if scores == "zipf" else -rank
        if scores == "zipf":
            log -= np.log(np.exp(log[normal]).sum())
        byte_ids = np.full(256, -1, np.int32)
        for i in range(n):
            if sp.is_byte(i):
                byte_ids[int(names[i][3:5], 16)] = i
        crossing = [names[i] for i in normal if re.search(f"[^{MARK}]{MARK}|\n", names[i])]
        if crossing or (byte_ids < 0).any():
            raise ValueError("pieces that cross a marker or line end, or missing byte pieces")
        decoded = [b""] * n
        for i in normal:
            decoded[i] = names[i].replace(MARK, " ").encode()
        for v, i in enumerate(byte_ids):
            decoded[i] = bytes([v])
        keep = np.full(n, -np.inf)
        keep[normal] = log[normal]
        return Unigram(Trie.build({names[i].encode(): i for i in normal}), keep, byte_ids, decoded)

    def parts(self) -> tuple:
        """Plain arrays, for a broadcast."""
        return self.trie.base, self.trie.check, self.trie.value, self.scores, self.byte_ids, self.pieces

    @staticmethod
    def of(parts: tuple) -> Unigram:
        return Unigram(Trie(*parts[:3]), *parts[3:])

    def segment(self, parts: Sequence[bytes]) -> list[np.ndarray]:
        """The best segmentation of every part: Viterbi over all of them together."""
        out: list[np.ndarray] = []
        a = 0
        while a < len(parts):
            b, size = a, 0
            while b < len(parts) and (b == a or size + len(parts[b]) <= _BATCH_BYTES):
                size += len(parts[b])
                b += 1
            out += self._segment(parts[a:b])
            a = b
        return out

    def _segment(self, parts: Sequence[bytes]) -> list[np.ndarray]:
        lens = np.fromiter(map(len, parts), np.int64, len(parts))
        start = np.cumsum(lens) - lens
        data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32)
        total = len(data)
        end = np.repeat(start + lens, lens)
        begins = np.flatnonzero((data & 0xC0) != 0x80)          # first bytes of characters
        width = np.diff(np.append(begins, total))
        # edges (from, to, piece): walk the trie from every character at once
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        at, state, depth = begins, np.zeros(len(begins), np.int32), 0
        single = np.zeros(total, bool)                           # has a piece of exactly one character
        char_len = np.zeros(total, np.int64)
        char_len[begins] = width
        froms, tos, ids = [], [], []
        while len(at):
            live = at + depth < end[at]
            at, state = at[live], state[live]
            to = base[state] + data[at + depth]
            ok = to < len(check)
            ok[ok] = check[to[ok]] == state[ok]
            at, state = at[ok], to[ok]
            depth += 1
            hit = value[state] >= 0
            froms.append(at[hit])
            tos.append(at[hit] + depth)
            ids.append(value[state[hit]])
            single[at[hit][char_len[at[hit]] == depth]] = True
        lone = begins[~single[begins]]
        froms.append(lone)
        tos.append(lone + char_len[lone])
        ids.append(np.full(len(lone), -1, np.int32))
        src, dst, piece = np.concatenate(froms), np.concatenate(tos), np.concatenate(ids)
        cost = np.where(piece >= 0, self.scores[piece], self.scores[np.isfinite(self.scores)].min() - _UNKNOWN_COST)
        # relax by place in the part; edges of one place and length never meet
        place = src - np.repeat(start, lens)[src]
        order = np.lexsort((dst - src, place))
        src, dst, piece, cost, place = src[order], dst[order], piece[order], cost[order], place[order]
        # node p + part number: a part's end is not the next one's start
        part = np.repeat(np.arange(len(parts)), lens)
        u, v = src + part[src], dst + part[src]
        best = np.full(total + len(parts), -np.inf)
        best[start + np.arange(len(parts))] = 0.0
        back = np.full(total + len(parts), -1, np.int64)
        cuts = np.append(np.flatnonzero(np.diff(place, prepend=-1)), len(place))
        for a, b in zip(cuts[:-1], cuts[1:]):
            s = best[u[a:b]] + cost[a:b]
            better = s > best[v[a:b]]
            best[v[a:b][better]] = s[better]
            back[v[a:b][better]] = np.arange(a, b)[better]
        # follow the best edges back, all parts at once
        where, node = np.arange(len(parts)), start + lens + np.arange(len(parts))
        owner, edges = [], []
        live = lens > 0
        where, node = where[live], node[live]
        while len(where):
            e = back[node]
            owner.append(where)
            edges.append(e)
            node = u[e]
            on = place[e] > 0
            where, node = where[on], node[on]
        if not owner:
            return [np.zeros(0, np.int32)] * len(parts)
        step = np.repeat(-np.arange(len(owner)), [len(o) for o in owner])
        owner, edges = np.concatenate(owner), np.concatenate(edges)
        order = np.lexsort((step, owner))
        owner, edges = owner[order], edges[order]
        got = piece[edges]
        n = np.where(got >= 0, 1, dst[edges] - src[edges])       # ids written: a piece, or the character's bytes
        ids = np.repeat(got, n)
        raw = np.repeat(src[edges] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        ids = np.where(ids >= 0, ids, self.byte_ids[data[np.where(ids >= 0, 0, raw)]]).astype(np.int32)
        sizes = np.bincount(owner, n, len(parts)).astype(np.int64)
        ends = np.cumsum(sizes)
        return [ids[a:b].copy() for a, b in zip((ends - sizes).tolist(), ends.tolist())]

    def encode(self, texts: Sequence[str], known: dict[str, np.ndarray] | None = None) -> Iterator[np.ndarray]:
        """The ids of every text, in order; ``known`` keeps parts' ids between calls (up to ``_KNOWN`` of them)."""
        known = {} if known is None else known
        group: list[str] = []
        size = 0
        for t in texts:
            if group and size + len(t) > _GROUP_CHARS:
                yield from self._encode(group, known)
                group, size = [], 0
            group.append(t)
            size += len(t)
        yield from self._encode(group, known)

    def _encode(self, texts: list[str], known: dict[str, np.ndarray]) -> list[np.ndarray]:
        cut = [_PARTS.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        flat = np.array([p for c in cut for p in c], dtype=object)
        if not len(flat):
            return [np.zeros(0, np.int32)] * len(texts)
        code, names = pd.factorize(flat)
        new = [n for n in names if n not in known]
        if len(known) + len(new) > _KNOWN:
            known.clear()
            new = list(names)
        known.update(zip(new, self.segment([n.encode("utf-8", "replace") for n in new])))
        seg = [known[n] for n in names]
        sizes = np.fromiter(map(len, seg), np.int64, len(seg))
        first = np.cumsum(sizes) - sizes
        pool, n = np.concatenate(seg), sizes[code]
        ids = pool[np.repeat(first[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0] + [len(c) for c in cut])]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def decode(self, ids: Sequence[int]) -> str:
        """The text of a list of ids."""
        out = b"".join(map(self.pieces.__getitem__, np.asarray(ids).tolist())).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out

    def score(self, ids: Sequence[int], chars_unknown: int = 0) -> float:
        """Sum of the pieces' log scores (byte pieces count by ``chars_unknown``)."""
        s = self.scores[np.asarray(ids, int)]
        return float(s[np.isfinite(s)].sum() + chars_unknown * (self.scores[np.isfinite(self.scores)].min() - _UNKNOWN_COST))


def encode_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                scores: str = "zipf") -> DataFrame:
    """id, ids (array) and decoded text of every row. The model (a vocabulary, fixed size) is built once and broadcast."""
    parts = docs.sparkSession.sparkContext.broadcast(Unigram.load(path, scores).parts())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, known = Unigram.of(parts.value), {}
        for b in batches:
            ids = list(m.encode(b["text"].tolist(), known))
            yield pd.DataFrame({"id": b["id"], "text": b["text"], "ids": ids, "decoded": [m.decode(i) for i in ids]})

    src = small_batches(docs).select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = src.mapInPandas(run, "id string, text string, ids array<int>, decoded string")
    return out.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))


def encode_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                   scores: str = "zipf") -> DataFrame:
    """Per row: id, n_tokens, n_byte_tokens, ids_crc32 and whether decoding gives the text back."""
    parts = docs.sparkSession.sparkContext.broadcast(Unigram.load(path, scores).parts())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, known = Unigram.of(parts.value), {}
        is_byte = np.zeros(len(m.pieces), bool)
        is_byte[m.byte_ids] = True
        for b in batches:
            texts = b["text"].tolist()
            ids = list(m.encode(texts, known))
            yield pd.DataFrame({"id": b["id"], "n_tokens": [len(i) for i in ids], "n_byte_tokens": [int(is_byte[i].sum()) for i in ids],
                                "ids_crc32": [zlib.crc32(i.astype("<u4").tobytes()) for i in ids],
                                "round_trip": [m.decode(i) == t for i, t in zip(ids, texts)]})

    src = small_batches(docs).select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = src.mapInPandas(run, "id string, n_tokens long, n_byte_tokens long, ids_crc32 long, round_trip boolean")
    return out.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def op5_sentencepiece_unigram(spark, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))


ship_by_value(__name__)
