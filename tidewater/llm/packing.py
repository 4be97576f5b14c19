"""Operator 7: packing by vector bin packing.

An example needs some of each of three resources of a sequence: tokens, one
segment, and loss-bearing tokens. Examples are dealt at random into blocks of
bounded size; in a block, bins are filled one after another, each time with
the example that fits and has the largest dot product of its demand and the
bin's free capacity, both as shares of the limits. Examples with the same
demand are one class, so a block's work depends on its distinct demands.

Texts longer than a sequence are cut into full pieces and a rest; the rows
that are shuffled are piece sizes, never ids or texts.

Rules for odd input: a null text is empty (only the end id); repeated rows
are pieces of their own; a null id is kept; an empty table packs to nothing;
an example over a limit raises an error, it is never dropped.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, small_batches, stored, table

MAX_TOKENS = 2048
MAX_SEGMENTS = 256
BLOCK = 4096       # examples packed together
END_ID = 1
SPECIAL = {"<|endoftext|>": 50256}


class Encoder:
    """The ids that the JSON tokenizer gives a whole text without added special tokens.

    The same vocabulary's ranks are several times faster; the JSON file is
    read only for a text that their pattern engine gives up on.
    """

    def __init__(self, ranks_path: str | None = None, json_path: str | None = None) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
        self.json_path, self.slow = json_path or public_tokenizers.path("byte_bpe_50k.json"), None

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        except Exception:
            if self.slow is None:
                from tokenizers import Tokenizer
                self.slow = Tokenizer.from_file(self.json_path)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS,
           ranks_path: str | None = None, json_path: str | None = None) -> DataFrame:
    """Every text's ids and the end id, cut into pieces of at most ``max_tokens``.

    ``loss`` counts a piece's ids that are predicted from an id of the same text.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(ranks_path, json_path)
        for b in batches:
            rows = []
            for i, text in zip(b["id"], b["text"]):
                ids = np.append(encode(text), np.uint32(END_ID)).astype("<u4")
                for a in range(0, len(ids), max_tokens):
                    part = ids[a:a + max_tokens]
                    rows.append((i, a, len(part), zlib.crc32(part.tobytes()), len(ids), len(part) - (a == 0)))
            out = pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "loss"])
            out["id"] = out["id"].astype("Int64")
            yield out

    src = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # ids as text: a batch with a null id would otherwise become floats
    src = src.withColumn("id", F.col("id").cast("string"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(b.assign(id=pd.array([None if x is None else int(x) for x in b["id"]], "Int64")) for b in batches)

    return src.mapInPandas(parse, "id long, start long, length long, ids_crc32 long, doc_tokens long, loss long")


def fill_bins(demand: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dot-product vector packing of the rows of ``demand``: each row's bin and place in it."""
    n = len(demand)
    if n and (demand > limits).any():
        raise ValueError("an example is over a limit of its sequence")
    classes, of, counts = np.unique(demand, axis=0, return_inverse=True, return_counts=True)
    of = of.reshape(-1)
    members = np.split(np.argsort(of, kind="stable"), np.cumsum(counts)[:-1])
    used = np.zeros(len(classes), np.int64)
    share = classes / limits
    bins, place = np.empty(n, np.int64), np.empty(n, np.int64)
    bin_no, seat, free, left = 0, 0, limits.astype(np.int64).copy(), n
    while left:
        fits = (used < counts) & (classes <= free).all(1)
        if not fits.any():
            bin_no, seat, free = bin_no + 1, 0, limits.astype(np.int64).copy()
            continue
        c = int(np.argmax(np.where(fits, share @ (free / limits), -1.0)))
        i = members[c][used[c]]
        bins[i], place[i] = bin_no, seat
        used[c] += 1
        seat += 1
        left -= 1
        free -= classes[c]
    return bins, place


def _pack_block(max_tokens: int, max_segments: int, max_loss: int):
    limits = np.array([max_tokens, max_segments, max_loss])

    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["length", "id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        demand = np.stack([b["length"], np.ones(len(b), np.int64), b["loss"]], 1).astype(np.int64)
        bins, place = fill_bins(demand, limits)
        b = b.assign(bin=bins, place=place).sort_values(["bin", "place"])
        b["offset"] = b.groupby("bin")["length"].cumsum() - b["length"]
        b["sequence_id"] = b["block"] * (1 << 24) + b["bin"]
        b["id"] = b["id"].astype("Int64")
        return b[["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss"]]
    return run


def pack(parts: DataFrame, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_TOKENS,
         block: int = BLOCK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have ``id, start, length, loss, ids_crc32, doc_tokens``."""
    blocks = max(1, math.ceil(parts.count() / block))
    key = F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(blocks))
    return parts.withColumn("block", key).groupBy("block").applyInPandas(
        _pack_block(max_tokens, max_segments, max_loss),
        "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss long")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    parts = stored(pieces(docs, id_col, text_col, limits.get("max_tokens", MAX_TOKENS)), "pieces")
    return pack(parts, **limits).select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                        "offset", F.col("loss").alias("loss_tokens"))


def op7_vector_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


ship_by_value(__name__)
