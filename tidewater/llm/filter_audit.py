"""Operator 12: filter interaction audit over count-weighted decision diagrams.

Every document gets a mask of the filters it fails. Per part (source) the
masks are counted and put into a decision diagram: one filter a level, a pass
and a fail branch a node, document counts at the leaves, equal sub-diagrams
stored once. The diagram is then taken through all orders of the filters, each
reached from the one before by swapping two adjacent levels; following the
pass branches from the root gives the steps of an order.

Only masks are counted per part (2**filters rows at most), so a diagram has a
fixed size however large its part is.

Rules for odd input: a null text counts as empty (no words, no characters); a
null source is the part ''; a row is a document, so repeated rows count each;
a row is a repeat if another row of the whole table has the same text and a
smaller id (a null id is neither smaller nor larger than any); labels that are
missing or null lose nothing, several label rows of one id count as one that is 1
if any is; an empty table has no parts and gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, stored, table

SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, MARKS = 200, 50, 2, "[#$%&*|]"

SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


class Diagram:
    """Count-weighted decision diagram; a node is (pass child, fail child), a leaf holds counts.

    No level is skipped: a node with equal children stands for twice the
    documents of one child. Nodes keep their number through swaps, so a swap
    touches two levels only.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], n: int, width: int):
        self.order = list(range(n))
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in range(n)]
        self.leaves: dict[tuple[int, ...], int] = {}
        self.edges: list[tuple[int, int] | None] = []
        self.total: list[tuple[int, ...]] = []
        self.counts, self.zero = counts, (0,) * width
        self.root = self._build(0, 0)

    def _build(self, level: int, mask: int) -> int:
        if level == len(self.order):
            weight = self.counts.get(mask, self.zero)
            if weight not in self.leaves:
                self.leaves[weight] = self._add(None, weight)
            return self.leaves[weight]
        return self._node(level, self._build(level + 1, mask), self._build(level + 1, mask | 1 << level))

    def _add(self, edges: tuple[int, int] | None, total: tuple[int, ...]) -> int:
        self.edges.append(edges)
        self.total.append(total)
        return len(self.edges) - 1

    def _node(self, level: int, ok: int, bad: int) -> int:
        known = self.levels[level]
        if (ok, bad) not in known:
            known[ok, bad] = self._add((ok, bad), tuple(map(sum, zip(self.total[ok], self.total[bad]))))
        return known[ok, bad]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the one below it."""
        upper, self.levels[level], self.levels[level + 1] = self.levels[level], {}, {}
        for (ok, bad), node in upper.items():
            (ok_ok, ok_bad), (bad_ok, bad_bad) = self.edges[ok], self.edges[bad]
            pair = self._node(level + 1, ok_ok, bad_ok), self._node(level + 1, ok_bad, bad_bad)
            self.levels[level][pair], self.edges[node] = node, pair
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, counts kept, counts removed) along the all-pass path."""
        out, node = [], self.root
        for var in self.order:
            ok, bad = self.edges[node]
            out.append((var, self.total[ok], self.total[bad]))
            node = ok
        return out


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels whose swaps, one after the other, visit every order of ``n`` filters once.

    The last filter sweeps through the others, which make one swap of their
    own at each end of its way.
    """
    if n < 2:
        return
    down = True
    for inner in [*adjacent_swaps(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if inner is not None:
            yield inner + down
        down = not down


def audit_part(counts: dict[int, tuple[int, int, int]], letters: str = LETTERS) -> Iterator[tuple]:
    """Rows after ``part`` of ``SCHEMA`` for one part's {mask: (documents, good, toxic)}."""
    diagram = Diagram(counts, len(letters), 3)
    paths = [(tuple(diagram.order), diagram.steps())]
    for level in adjacent_swaps(len(letters)):
        diagram.swap(level)
        paths.append((tuple(diagram.order), diagram.steps()))
    fails, alone, shapley = {}, {}, dict.fromkeys(range(len(letters)), 0)
    for _, steps in paths:
        fails[steps[0][0]] = steps[0][2][0]    # the first filter removes all that fail it
        alone[steps[-1][0]] = steps[-1][2][0]  # the last one only what fails no other
        for var, _, removed in steps:
            shapley[var] += removed[0]
    for order, steps in sorted(paths):
        name = "".join(letters[v] for v in order)
        for k, (var, kept, removed) in enumerate(steps, 1):
            yield name, k, kept[0], removed[0], fails[var] - removed[0], alone[var], removed[1], removed[2], shapley[var]


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of one text by letter, as columns over ``words`` (its pieces between white space) and ``text``."""
    words = F.col("words")
    first, last = F.element_at(words, 1) == "", F.element_at(words, -1) == ""  # empty pieces can only be at the ends
    n = F.size(words) - first.cast("int") - (last & (F.size(words) > 1)).cast("int")
    distinct = F.size(F.array_distinct(words)) - (first | last).cast("int")
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {"A": n < MIN_WORDS, "B": 100 * distinct.cast("long") < DISTINCT_PERCENT * n.cast("long"),
            "C": 100 * capitals.cast("long") > UPPER_PERCENT * F.length(text).cast("long"), "D": text.rlike(MARKS)}


def failure_marks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One narrow row per document: id, part, mask of A to D, digest of the text. Texts are read once and not shuffled."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"),
                       text.alias("text"), F.split(text, SPACE).alias("words"))
    fails = text_failures(F.col("text"))
    mask = sum((fails[c].cast("int") * (1 << k) for k, c in enumerate("ABCD")), F.lit(0))
    return rows.select("id", "part", mask.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, documents, good, toxic: one row for each mask that occurs in a part."""
    marks = stored(failure_marks(docs), "marks")
    ids = marks.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    repeats = ids.where("first < last").select("sha", "first")
    known = labels.groupBy(labels["doc_id"].cast("long").alias("id")).agg(
        F.max((labels["quality"] == 1).cast("int")).alias("good"), F.max((labels["toxic"] == 1).cast("int")).alias("toxic"))
    rows = marks.join(repeats, "sha", "left").select(
        "id", "part", (F.col("mask") + F.when(F.col("id") > F.col("first"), 16).otherwise(0)).alias("mask"))
    rows = rows.join(known, "id", "left")
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                                            F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders and steps of every part, see ``SCHEMA``."""
    parts = mask_counts(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for b in batches:
            for part, counts in zip(b["part"], b["counts"]):  # a frame a part: 5 * 120 rows
                by_mask = {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in counts}
                yield pd.DataFrame([(part, *r) for r in audit_part(by_mask)], columns=names)

    return parts.mapInPandas(run, SCHEMA)


def op12_filter_interaction_audit(spark, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT part, concat(CASE WHEN len(ws) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' END,
             CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' END,
             CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > first_id THEN 'E' END) AS mask,
             coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, x,
             sum(CASE WHEN translate(mask, before || x, '') = mask THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN contains(mask, x) AND translate(mask, before, '') = mask THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN contains(mask, x) AND translate(mask, before, '') <> mask THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = x THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN contains(mask, x) AND translate(mask, before, '') = mask THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN contains(mask, x) AND translate(mask, before, '') = mask THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""

ship_by_value(__name__)
