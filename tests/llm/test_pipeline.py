"""The pipeline against a plain Python version of its stages, on small tables."""

import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from helpers import doc_frame, near_components

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ODD = [(1, None), (2, ""), (3, "a"), (4, "a"), (None, "a"), (None, "b c"), (5, "x " * 30000), (7, "A b\tc"), (8, "a  b c"), (8, "a  b c"),
       (9, "é É"), (10, " \n\t "), (11, "write to bob@example.com")]


def _expected(rows):
    """{(doc_id, redacted text)} of rows that the classifier keeps: exact copies by largest id, near copies by smallest."""
    best = {}
    for i, t in rows:
        t = t or ""
        if t not in best or (i is not None and (best[t] is None or i > best[t])):
            best[t] = i
    rows = [(i, t) for t, i in best.items()]
    sets, least = near_components(rows, 5, 80)
    return {(i, EMAIL.sub("[EMAIL]", t)) for n, (i, t) in enumerate(rows) if not sets[n] or i == least[n]}


def _check(got, want):
    import public_tokenizers
    from tokenizers import Tokenizer
    enc = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == {i for i, _ in want}
    for i in pieces:
        if i is None:
            continue
        (text,) = [t for j, t in want if j == i]
        ids, at = np.array([*enc.encode(text, add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048


def _run(spark, tmp, rows, labels, extra=False):
    doc_frame(spark, rows, extra).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    return corpus_pipeline.run(spark, tmp).collect()


def test_pipeline_equals_plain_python(spark, tmp):
    rng = random.Random(8)
    words = "calm river stone and the morning light over quiet fields where old houses stand near water under trees".split()
    good = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice((40, 90, 3000)))]
        good.append(" ".join(base) + ".")
        good.append(" ".join(base) + ".")                                           # an exact copy
        near = list(base)
        near[rng.randrange(len(near))] = "bridge"
        good.append(" ".join(near) + " Mail ann.lee@example.org now.")                # a near copy, with an address
    bad = ["BUY!! NOW!! $$$ ### " * rng.randrange(5, 12) + str(n) for n in range(40)]
    rows = list(enumerate(rng.sample(good + bad, len(good + bad))))
    labels = [(i, int("BUY" not in t), 0) for i, t in rows]
    want = _expected([(i, t) for i, t in rows if "BUY" not in t])
    # copies of the 40 texts: exact ones go, near ones do in the longer texts
    assert 40 < len(want) < 80 and any("[EMAIL]" in t for _, t in want)
    _check(_run(spark, tmp, rows, labels), want)


@pytest.mark.parametrize("extra", [False, True])
def test_pipeline_of_odd_rows_without_labels(spark, tmp, extra):
    _check(_run(spark, tmp, ODD, [], extra), _expected(ODD))


def test_pipeline_of_an_empty_table(spark, tmp):
    assert _run(spark, tmp, [], []) == []


def test_stages_keep_the_columns(spark, tmp):
    df = doc_frame(spark, ODD, extra=True)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, tmp).columns == df.columns
