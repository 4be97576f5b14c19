"""Operators 1, 4 to 10: brute force, round trips and odd input."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from helpers import doc_frame
from pyspark.sql import functions as F
from tidewater.llm import line_dedup
from tidewater.llm.ann import blocks_of, nearest_rows, scaled, visit
from tidewater.llm.line_dedup import alike, dedup_lines, edit_distance, normalise, simhashes
from tidewater.llm.packing import Encoder, fill_bins, pack_documents
from tidewater.llm.pii import KINDS, base_spans, candidates, find_pii, redact, reliabilities
from tidewater.llm.quality_gam import FEATURES, fit, keep_good, quality_scores, text_features
from tidewater.llm.sentencepiece_unigram import Unigram, encode_digests
from tidewater.llm.style_tree import _hash, counted, extract, main_text, parse, style_tree
from tidewater.llm.warc import MAGIC, base32, read_warc, with_revisits, write_warc

ODD = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x@y.org \n\n 10.0.0.1"), (4, "word " * 40000), (5, "y" * 50000), (6, "é 日本 \U0001F600\n")]


def test_base_spans_follow_the_patterns():
    t = "ann.b@ex-a.com, @x.y a@b@c.de 1.2.3.4.5.6.7.8 256.1.1.1, 4111 1111 1111 1111 +1 (555) 010-9999. +12 a@b"
    got = [("email ip card phone".split()[k], t[a:b]) for k, a, b in base_spans(t)]
    assert got == [("email", "ann.b@ex-a.com"), ("email", "b@c.de"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8"),
                   ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 010-9999")]
    assert base_spans("9" * 300000) == [] and base_spans("a" * 300000 + "@") == []


def test_base_spans_equal_the_literal_patterns():
    """Random strings against the contract's patterns, read as they stand."""
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
                r"\+[0-9][\x20().0-9-]+[0-9]"]

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    def plain(t):
        out = []
        for k, p in enumerate(patterns):
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m[0])
                if (True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else 0, 13 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15)[k]:
                    out.append((k, *m.span()))
        return sorted(out)

    rng = random.Random(11)
    found = 0
    for alphabet in ("a@.b-", "12.@a", "0123456789.", "4 1-0", "+1 (2).-9", "a1.@+-() %_é\u0661\n"):
        for _ in range(6000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            want = plain(t)
            found += len(want)
            assert base_spans(t) == want, t
    assert found > 4000


def _planted(rng):
    """(text, kind, span) with spans that are personal data and spans that only look like it (kind None)."""
    digits = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("bdklmnrst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))

    def iban(good):
        body = digits(18)
        check = 98 - int(body + "131400") % 97                     # D and E are 13 and 14
        return f"DE{check if good else (check + 5) % 90 + 10:02d}{body}"
    first, last = rng.choice(["Maria", "Paul", "Sofia", "Hans"]), word().title()
    true = {"email": ("write to ", f"{word()} [at] {word()}.org"), "phone": (rng.choice(["tel ", "call "]), f"(030) {digits(3)} {digits(4)}"),
            "identity": (rng.choice(["SSN ", "social security "]), f"{rng.randint(100, 600)}-{digits(2)}-{digits(4)}"),
            "iban": ("IBAN ", iban(True)), "secret": (rng.choice(["api_key=", "secret token: "]), "sk-" + hexa(32)),
            "name": (rng.choice(["signed ", "Dear "]), f"{rng.choice(['', 'Dr ', 'Mrs '])}{first} {last}")}
    false = {"email": ("version ", f"{word()} [at] {word()}.{word()}"), "phone": ("page ", f"{digits(2)} {digits(2)} {digits(2)}"),
             "identity": ("order ", f"9{digits(2)}-{digits(2)}-0000"), "iban": ("invoice ", iban(False)),
             "secret": ("commit ", f"{word()}_{word()}_{word()}_{word()}_{digits(1)}_{word()}")}
    kind = rng.choice(list(true))
    good = kind == "name" or rng.random() < 0.6
    before, span = (true if good else false)[kind]
    head = f"{word()} {word()} {before}"
    return f"{head}{span} {word()} {word()}", kind if good else None, (len(head), len(head) + len(span)), kind


def test_pii_finds_planted_spans_and_rejects_lookalikes(spark):
    rng = random.Random(4)
    planted = [_planted(rng) for _ in range(900)]
    got = {r.doc_id: r.spans for r in find_pii(doc_frame(spark, [(i, t) for i, (t, *_) in enumerate(planted)])).collect()}
    for kind in ("email", "phone", "identity", "iban", "secret", "name"):
        hits = misses = wrong = 0
        for i, (_, true, (a, b), like) in enumerate(planted):
            if like == kind:
                hit = f"{kind}:{a}:{b}" in got[i].split(",")
                hits, misses, wrong = hits + (hit and true == kind), misses + (not hit and true == kind), wrong + (bool(got[i]) and true is None)
        assert hits >= 40 and hits / (hits + misses) >= 0.95 and hits / (hits + wrong) >= 0.95, (kind, hits, misses, wrong)


def test_kinds_compete_for_a_span():
    for text, want in (("SSN 123-45-6789", "identity"), ("tel 123-45-6789", "phone"), ("x 123-45-6789 y", "identity"), ("call Maria Lopez now", "name"),
                       ("password: hunter22 ok", "secret")):
        assert [KINDS[k] for k, *_ in candidates(text, [])] == [want], text
    many = candidates("123-45-6789 (030) 123 4567 " * 20000, [])
    assert len(many) == 40000 and all(x[2] <= y[1] for x, y in zip(many, many[1:]))
    a = "Maria Lopez 123-45-6789"
    assert [x[:3] for x in candidates(a, [(0, 6, 14)])] == []


def test_reliabilities_are_of_each_kind():
    rng = np.random.default_rng(8)
    kinds = rng.choice([3, 6], 4000)
    true = rng.random(4000) < 0.5
    votes = np.where(rng.random((4000, 7)) < 0.8, np.where(true, 1, -1)[:, None], np.where(true, -1, 1)[:, None])
    votes[:, 1] = np.where(kinds == 3, votes[:, 1], rng.choice([-1, 1], 4000))   # the second labeler only knows phones
    p, post = reliabilities(kinds, votes, np.ones(4000))
    informative = np.where(np.arange(7) == 1, (kinds == 3)[:, None], True)
    best = (votes * informative).sum(1)                             # with equal true reliabilities the sum of votes decides
    assert ((post > 0.5) == true)[best != 0].mean() > (np.sign(best[best != 0]) == np.where(true, 1, -1)[best != 0]).mean() - 0.01
    assert p[3, 1, 1, 2] > 0.75 and abs(p[6, 1, 1, 2] - 0.5) < 0.07 and p[6, 1, 0, 2] > 0.75


def test_pii_rows_and_redaction(spark):
    secret = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
    rows = [*ODD, *[(10 + i, f"see {secret} or mail me@a.io") for i in range(5)]]
    df = doc_frame(spark, rows, extra=True)
    got = {(r.doc_id, r.n_email): r for r in find_pii(df).collect()}
    assert got[None, 1].spans == "email:0:7,ip:11:19" and got[None, 1].base_sha256 == hashlib.sha256(b"email:0:7,ip:11:19").hexdigest()
    assert got[2, 0].spans == "" and "secret:13:53" in got[10, 1].spans
    out = redact(df)
    assert out.columns == df.columns
    texts = {r.doc_id: r for r in out.collect()}
    assert texts[1].text is None and texts[6].text == rows[7][1] and texts[None].text == "[EMAIL] \n\n [IP]"
    assert "24be" not in texts[10].text and texts[10].n_chars == len(texts[10].text)
    assert find_pii(df.limit(0)).count() == 0 and redact(df.limit(0)).count() == 0


def test_secrets_of_any_length_and_long_documents():
    for n in (128, 129, 400, 200_000):
        key = ("eyJ" + "aB3x" * n)[:n]
        assert [(k, a, b) for k, a, b, _ in candidates(f"token = {key}== end", [])] == [(6, 8, 10 + n)]
    rng = random.Random(2)
    line = lambda: "api_key=sk-" + "".join(rng.choice("abcdef0123456789") for _ in range(30)) + " plain words" * 40 + "\n"
    few, many = (candidates("".join(line() for _ in range(n)), []) for n in (40, 60))
    assert len(many) == 60 and {c for *_, c in many} <= {c for *_, c in few}
    dense = candidates(" ".join(line()[:41] for _ in range(60)), [])
    assert {c for *_, c in dense}.isdisjoint(c for *_, c in few)


def test_fill_bins_keeps_all_limits():
    rng = np.random.default_rng(1)
    demand = np.stack([rng.integers(1, 2049, 800), np.ones(800, int), rng.integers(0, 600, 800)], 1)
    limits = np.array([2048, 9, 1500])
    bins, place = fill_bins(demand, limits)
    for b in np.unique(bins):
        assert (demand[bins == b].sum(0) <= limits).all() and sorted(place[bins == b]) == list(range((bins == b).sum()))
    with pytest.raises(ValueError):
        fill_bins(np.array([[3000, 1, 1]]), limits)


def test_packing_covers_every_id_once(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    slow, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Encoder()
    for _, t in ODD:
        assert fast(t or "").tolist() == slow.encode(t or "", add_special_tokens=False).ids
    assert fast("a<|endoftext|>b").tolist() == slow.encode("a<|endoftext|>b", add_special_tokens=False).ids
    got = pack_documents(doc_frame(spark, ODD, extra=True)).toPandas()
    want = sorted(len(fast(t or "")) + 1 for _, t in ODD)
    assert got["length"].sum() == sum(want) and (got.groupby("sequence_id")["length"].sum() <= 2048).all()
    ids = np.append(fast(ODD[5][1]), 1).astype("<u4")
    for r in got[got.doc_id == 4].itertuples():
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"].to_numpy() == np.cumsum(g["length"]).to_numpy() - g["length"].to_numpy()).all()
    assert pack_documents(doc_frame(spark, ODD).limit(0)).count() == 0


def test_gam_learns_pairs_and_missing_labels():
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)        # no single feature tells
    gam = fit(x[:2000], y[:2000])
    assert ((gam.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    assert fit(np.zeros((0, len(FEATURES))), np.zeros(0)).score(x[:3]).tolist() == [0.5] * 3
    assert text_features("") == [0.0] * len(FEATURES)


def test_quality_rows(spark):
    rows = [(i, "A calm line of plain words, and more of it.\n" * (1 + i % 3) if i % 4 else "BUY!! NOW!! $$$ ### " * 9) for i in range(200)]
    df = doc_frame(spark, rows + ODD, extra=True)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(df, labels).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id > 6]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.predicted == (r.doc_id % 4 > 0) for r in held)
    kept = keep_good(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect() if r.doc_id and r.doc_id > 6} == {i for i in range(7, 200) if i % 4}
    assert quality_scores(df.limit(0), labels).count() == 0 and quality_scores(df, labels.limit(0)).first().score == 0.5


def test_warc_rejects_magic_in_payloads(spark, tmp):
    fake = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    bodies = [None, "", "plain é", fake, "x" + fake + fake[:40] + MAGIC, MAGIC * 3, "same", "same", "z" * 200000, fake * 50]
    pages = spark.createDataFrame([(i, None if i == 2 else f"http://h/\r\n{i}", b) for i, b in enumerate(bodies)] + [(6, "u", "same"), (None, "v", "q")],
                                  "page_id long, url string, html string")
    write_warc(pages.coalesce(2), f"{tmp}/w")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")   # many splits a file
    try:
        records = read_warc(spark, f"{tmp}/w")
        got = with_revisits(records).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 12
    for r in got:
        if r.page_id is not None and r.page_id != 6:
            b = (bodies[r.page_id] or "").encode()
            assert (r.payload_bytes, r.payload_digest) == (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode()), r.page_id
    assert {r.page_id: (r.record_type, r.refers_to) for r in got if r.page_id in (0, 1, 6, 7)} == \
        {0: ("revisit", 1), 1: ("response", None), 6: ("revisit", 7), 7: ("response", None)}
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in records.collect()}   # the archive itself says it
    assert kinds[0] == ("revisit", 1) and kinds[7] == ("response", None)
    files = [f.read_bytes() for f in Path(tmp, "w").glob("part-*")]
    assert sum(x.count(b"\r\n\r\nsame\r\n\r\n") for x in files) == 1          # a revisit leaves the payload out
    assert sum(x.count(b"WARC-Type: revisit") for x in files) == 3
    sha = spark.range(300).select(F.sha1(F.col("id").cast("string").cast("binary")).alias("h"))
    for r in sha.select("h", base32(F.col("h")).alias("b")).collect():
        assert r.b == base64.b32encode(bytes.fromhex(r.h)).decode()
    write_warc(pages.limit(0), f"{tmp}/none")
    assert with_revisits(read_warc(spark, f"{tmp}/none")).count() == 0


def test_unigram_is_the_best_path_and_round_trips(spark):
    m = Unigram.load()
    names = {m.pieces[i].replace(b" ", "▁".encode()): m.scores[i] for i in np.flatnonzero(np.isfinite(m.scores))}
    unknown = m.scores[np.isfinite(m.scores)].min() - 10
    for t in ("hello worlds", "naïve  café", "zq日x\U0001F600", "the\nthe"):
        s = "▁" + t.replace(" ", "▁")
        best = [0.0] + [-np.inf] * len(s)
        for e in range(1, len(s) + 1):
            for a in range(max(0, e - 20), e):
                p = s[a:e].encode()
                v = names.get(p, unknown if e - a == 1 else -np.inf)
                best[e] = max(best[e], best[a] + v)
        ids = next(m.encode([t]))
        missing = sum(c.encode() not in names for c in s)
        assert abs(m.score(ids, missing) - best[-1]) < 1e-6 and m.decode(ids) == t
    got = encode_digests(doc_frame(spark, ODD, extra=True)).collect()
    assert len(got) == len(ODD) and all(r.round_trip for r in got) and {r.n_tokens for r in got if r.doc_id in (1, 2)} == {0}
    assert encode_digests(doc_frame(spark, ODD).limit(0)).count() == 0


def test_edit_distance_and_simhash():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(0, 14))) for _ in range(2))
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            d, old = [i], d
            for j, y in enumerate(b, 1):
                d.append(min(old[j] + 1, d[-1] + 1, old[j - 1] + (x != y)))
        assert edit_distance(a, b) == d[-1] and alike(a, b, 0.8) == (d[-1] <= int(0.2 * max(len(a), len(b)) + 1e-9))
    assert simhashes(["a b", "a b"]).tolist()[0] == simhashes(["x", "a b"]).tolist()[1]


@pytest.mark.parametrize("max_list", [32, 2])
def test_lines_keep_one_of_each_group(spark, max_list):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [" ".join(word() for _ in range(40)) for _ in range(5)]
    lines = []
    for b in base:
        for _ in range(12):
            w = b.split()
            if rng.random() < 0.7:
                w[rng.randrange(40)] += "x"
            lines.append(" ".join(w))
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[3 * i:3 * i + 3]) + "\n---\nPage 12!") for i in range(20)] + ODD
    norm = sorted({normalise(x) for _, t in rows for x in (t or "").split("\n") if normalise(x)})
    sims, root = simhashes(norm), list(range(len(norm)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for a in range(len(norm)):
        for b in range(a):
            if bin(int(sims[a]) ^ int(sims[b])).count("1") <= 3 and alike(norm[a], norm[b], 0.9):
                root[find(a)] = find(b)
    group = {n: find(i) for i, n in enumerate(norm)}
    seen, want = set(), []
    unique = dict.fromkeys(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)))
    for i, t in unique:
        keep = []
        for x in (t or "").split("\n"):
            g = group.get(normalise(x))
            if g is None or g not in seen:
                keep.append(x)
            seen.add(g)
        want.append((str(i), "\n".join(keep)))
    got = dedup_lines(doc_frame(spark, rows, extra=True), max_list=max_list, chunk=8).collect()
    assert len(got) == len(rows) and {(str(r.doc_id), r.text) for r in got} == set(want)


def test_lines_recall_against_edit_similarity_alone(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randrange(3, 8)))
    lines = []
    for n in (10, 20, 40, 60):
        for _ in range(30):
            a = [word() for _ in range(n)]
            b, c = list(a), list(" ".join(a))
            b[rng.randrange(n)] = word()
            for i in rng.sample(range(len(c)), len(c) // 20):
                c[i] = rng.choice("vwxyz")
            lines += [(n, " ".join(a)), (n, " ".join(b)), (n, "".join(c))]
    want = {n: set() for n, _ in lines}
    for i, (n, x) in enumerate(lines):
        if any(alike(x, y, 0.9) for _, y in lines[:i]):
            want[n].add(i)
    got = {r.doc_id for r in dedup_lines(doc_frame(spark, [(i, x) for i, (_, x) in enumerate(lines)])).collect() if r.n_dropped}
    assert got <= set().union(*want.values())
    for n, alike_before in want.items():
        assert len(alike_before) >= 40 and len(got & alike_before) >= 0.95 * len(alike_before), n


def test_lines_recall_at_the_threshold(spark):
    """One in ten characters replaced all over the line: the farthest lines that still link."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randrange(3, 8)))
    lines, linked = [], {20: 0, 40: 0, 60: 0, 100: 0}
    for n in linked:
        for _ in range(150):
            a = " ".join(word() for _ in range(n))
            c = list(a)
            for i in rng.sample(range(len(c)), len(c) // 10):
                c[i] = rng.choice("vwxyz")
            if alike(a, "".join(c), 0.9):
                linked[n] += 1
                lines += [(n, a), (n, "".join(c))]
    got = Counter(lines[r.doc_id][0] for r in dedup_lines(doc_frame(spark, [(i, x) for i, (_, x) in enumerate(lines)])).collect() if r.n_dropped)
    assert sum(linked.values()) > 500 and all(got[n] <= linked[n] for n in linked)
    assert sum(got.values()) >= 0.9 * sum(linked.values()) and all(got[n] >= 0.86 * linked[n] for n in linked), (got, linked)


def test_lines_lists_do_not_depend_on_the_buffer():
    """Long lists written before their range ends have the same members, short lists the same pairs."""
    rng = np.random.default_rng(5)
    key = np.concatenate([np.repeat(np.uint32(7), 900), rng.integers(0, 400, 900).astype(np.uint32) + np.uint32(10)])
    rep = rng.permutation(np.arange(-900, 900))
    order = rng.permutation(len(key))
    key, rep, size = key[order], rep[order].astype(np.int64), np.full(len(key), 9000, np.uint16)
    cuts = np.arange(0, len(key), 50)
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(cuts), np.int32)), *(line_dedup._binary(x, cuts) for x in (key, rep, size))],
                                       names=["part", "keys", "reps", "sizes"])
    found = []
    for limit in (10_000, 200):
        t = pa.Table.from_batches(list(line_dedup._meet(32, 0.9, limit)(iter([batch])))).to_pylist()
        found.append(({(r["a"], r["b"]) for r in t if not r["bundled"]}, {r["b"] for r in t if r["bundled"]}))
    assert found[0] == found[1] and found[0][1] == set(rep[key == 7].tolist())
    want = {(x, y) for k in set(key.tolist()) - {7} for x in rep[key == k].tolist() for y in rep[key == k].tolist() if x < y}
    assert found[0][0] == want


def test_edit_distance_may_stop_early():
    rng = random.Random(9)
    for _ in range(600):
        letters = rng.choice(["ab ", "abcdefghij "])
        a = [rng.choice(letters) for _ in range(rng.randrange(1, 150))]
        b = list(a)
        for _ in range(rng.randrange(len(a) // 5 + 2)):
            i = rng.randrange(len(b) + 1)
            b[i:i + rng.randrange(2)] = [rng.choice(letters) for _ in range(rng.randrange(3))]
        a, b = "".join(a), "".join(b)
        d, most = edit_distance(a, b), rng.randrange(30)
        assert (edit_distance(a, b, most) <= most) == (d <= most) and alike(a, b, 0.9) == (d <= int(0.1 * max(len(a), len(b)) + 1e-9))
        counts = line_dedup.profiles([a, b or "x"])
        assert line_dedup.may_be_alike(counts[0], counts[1:], np.array([d + (not b)])).all()


def test_lines_with_a_common_passage_meet_only_at_like_places():
    """A passage in many unlike lines makes neither a bundle nor many pairs; its near copies still meet."""
    rng = random.Random(21)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n)).replace(" ", "q")
    passage, lines = text(80), []
    for i in range(120):
        a = i * 2
        lines.append(text(a) + passage + text(240 - a + rng.randrange(200)))
    copies = [lines[7][:30] + "zz" + lines[7][31:], lines[60] + "z"]
    nh = np.arange(len(lines) + 2)
    batch = pa.RecordBatch.from_arrays([pa.array(nh), pa.array(lines + copies)], names=["nh", "s"])
    for limit in (line_dedup.HELD, 500):
        blocks = pa.Table.from_batches(list(line_dedup._pack(1, 0.9)(iter([batch])))).to_batches()
        met = pa.Table.from_batches(list(line_dedup._meet(32, 0.9, limit)(iter(blocks)))).to_pylist()
        pairs = {(r["a"], r["b"]) for r in met if not r["bundled"]}
        assert {(7, 120), (60, 121)} <= pairs
        if limit == line_dedup.HELD:
            assert not any(r["bundled"] for r in met) and len(pairs) < 0.1 * 122 * 121 / 2


def test_lines_that_repeat_themselves_share_keys():
    for line in ("spam and eggs " * 60, "a" * 900, "ab " * 30):
        line = line.strip()
        key, of, place = line_dedup.entries([line, line[:50] + "x" + line[51:]])
        assert set(key[of == 0].tolist()) & set(key[of == 1].tolist()) and (np.bincount(of) < 100).all()


def test_many_edit_distances_and_marks():
    rng = random.Random(12)
    pairs = []
    for _ in range(400):
        letters = rng.choice(["ab ", "abcdefghij ", "a\u00e9\u6f22\U0001d11e "])
        a = [rng.choice(letters) for _ in range(rng.choice([0, 3, 20, 70, 150, 700]) + rng.randrange(9))]
        b = list(a)
        for _ in range(rng.randrange(len(a) // 6 + 2)):
            i = rng.randrange(len(b) + 1)
            b[i:i + rng.randrange(2)] = [rng.choice(letters) for _ in range(rng.randrange(3))]
        a, b = "".join(a), "".join(b)
        d = edit_distance(a, b)
        pairs.append((a, b, max(0, d + rng.randrange(-2, 3)) if rng.random() < 0.6 else rng.randrange(len(a) // 4 + 3)))
        x, y = line_dedup.marks([a]), line_dedup.marks([b])
        assert line_dedup.marks_apart(x, y)[0] <= 2 * d
        assert line_dedup.bags_fit(line_dedup.bags([a]), line_dedup.bags([b]), np.array([d])).all()
    assert line_dedup.within(pairs).tolist() == [edit_distance(a, b) <= room for a, b, room in pairs]


def test_lines_are_compared_many_at_once(monkeypatch):
    """Pairs of lines up to some thousand characters take no Python steps of their own, in pairs and in bundles."""
    rng = random.Random(17)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    lines, base = [], [text(rng.choice((40, 300, 700))) for _ in range(6)]
    for i in range(240):
        c = list(base[i % 6])
        for j in rng.sample(range(len(c)), len(c) * rng.randrange(2, 9) // 100):
            c[j] = rng.choice("uvwxyz")
        lines.append("".join(c))
    x, y = np.triu_indices(len(lines), 1)
    like = [abs(len(lines[i]) - len(lines[j])) < 100 for i, j in zip(x, y)]
    x, y = x[like], y[like]
    want = {(i, j) for i, j in zip(x.tolist(), y.tolist()) if alike(lines[i], lines[j], 0.9)}
    alone = []
    for name in ("_quick", "edit_distance"):
        real = getattr(line_dedup, name)
        monkeypatch.setattr(line_dedup, name, lambda *a, real=real: (alone.append(a), real(*a))[1])
    batch = pd.DataFrame({"x": x, "y": y, "sx": [lines[i] for i in x], "sy": [lines[j] for j in y]})
    got = pd.concat(line_dedup._verify(0.9)(iter([batch])))
    assert set(zip(got["a"].tolist(), got["b"].tolist())) == want and 1000 < len(want) < len(x) / 2
    rows = pd.DataFrame({"rep": range(240), "s": lines, "sim": simhashes(lines).view(np.int64), "label": range(240), "chunk": 0, "i": 0, "j": 0})
    links = line_dedup._compare_chunks(64, 0.9)(rows)
    groups = lambda pairs: len({tuple(sorted(g)) for g in _groups(240, pairs)})
    assert groups(zip(links["a"], links["b"])) == groups(want) and len(links) == 240 - groups(want)
    assert len(alone) < len(x) / 20, (len(alone), len(x))


def test_lines_meet_unless_their_characters_need_too_many_edits():
    """Characters that come or go count once and not as half a replacement; no alike lines are lost by it."""
    rng = random.Random(18)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))

    def met(lines):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(lines))), pa.array(lines)], names=["nh", "s"])
        blocks = pa.Table.from_batches(list(line_dedup._pack(1, 0.9)(iter([batch])))).to_batches()
        found = pa.Table.from_batches(list(line_dedup._meet(32, 0.9)(iter(blocks)))).to_pylist()
        return {(r["a"], r["b"]) for r in found}

    x = text(200)
    assert met([x, x[:184]]) == met([x, x[:100] + "x" * 10 + x[110:]]) == {(0, 1)}
    assert met([x, x[:100] + "x" * 10 + x[110:184]]) == set()  # 26 edits, where 20 may be
    lines = []
    for _ in range(300):
        c = list(text(rng.choice((30, 100, 300, 900))))
        lines.append("".join(c))
        for _ in range(rng.randrange(len(c) // 10 + 1)):
            i = rng.randrange(len(c))
            c[i:i + rng.randrange(2)] = [rng.choice("uvwxyz")] * rng.randrange(2)
        lines.append("".join(c))
    found, (key, of, place) = met(lines), line_dedup.entries(lines)
    keys = [dict(zip(key[of == i].tolist(), place[of == i].tolist())) for i in range(len(lines))]
    size, want = [len(s) for s in lines], set()
    for i in range(0, len(lines), 2):
        for k in keys[i].keys() & keys[i + 1].keys():
            before = [keys[j][k] / line_dedup.PLACES * size[j] for j in (i, i + 1)]
            apart = abs(before[0] - before[1]) + abs(size[i] - before[0] - size[i + 1] + before[1])
            if apart < 0.099 * max(size[i:i + 2]) and alike(lines[i], lines[i + 1], 0.9):
                want.add((i, i + 1))
    assert len(want) > 200 and want <= found


def _groups(n, pairs):
    root = list(range(n))
    for a, b in pairs:
        root = [root[a] if r == root[b] else r for r in root]
    return [[i for i in range(n) if root[i] == r] for r in set(root)]


def test_visit_order_and_blocks():
    rng = np.random.default_rng(3)
    d1, d2, counts = rng.random(7), rng.random(5), rng.integers(0, 4, 35)
    got = visit(d1, d2, counts, int(counts.sum()))
    far = (d1[:, None] + d2[None, :]).ravel()
    assert got == [c for c in np.argsort(far, kind="stable").tolist() if counts[c]]
    first, parts = blocks_of(np.array([3, 3, 9, 1, 1]), 4)
    assert first.tolist() == [0, 1, 2, 5, 5] and parts.tolist() == [1, 1, 3, 1, 1]


def test_nearest_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    x[::3] = x[0]                                    # a third of the rows are equal
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(1000, None, 0), (1050, [0.0] * 8, 0), (1100, [float("nan")] * 8, 0), (1150, [1.0], 0), (1200, [None] * 8, 0), (0, x[0].tolist(), 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = nearest_rows(df, chunk=64, query_chunk=5).toPandas()
    u = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(1, keepdims=True))
    hits = 0
    for q in range(0, 600, 50):
        s = u @ u[q]
        s[q] = -9
        want = sorted(range(600), key=lambda i: (-round(s[i], 12), i))[:5]
        g = got[got.query_id == q].sort_values("rank")
        assert g["rank"].tolist() == [1, 2, 3, 4, 5] and np.allclose(s[g.vec_id], g.score, atol=1e-12)
        hits += len(set(want) & set(g.vec_id))
    assert hits >= 0.9 * 60 and set(got.query_id) == set(range(0, 600, 50))
    assert got[got.query_id == 0].sort_values("rank").vec_id.tolist() == [3, 6, 9, 12, 15]
    assert nearest_rows(df.limit(0)).count() == 0


def test_nearest_rows_of_very_large_and_small_components(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(80, 3))
    size = 10.0 ** rng.choice([-300, -200, 0, 200, 300], 80)
    x[0], size[0] = [1, 1, 0], 1e200
    x[50], size[50] = [1, 0, 0], 1e-200
    tiny = [(200, [5e-324, 0.0, 0.0]), (250, [1.7e308, 1.7e308, -1.7e308])]
    df = spark.createDataFrame([(i, (v * m).tolist()) for i, (v, m) in enumerate(zip(x, size))] + tiny, "vec_id long, embedding array<double>")
    ids, all_ = [*range(80), 200, 250], np.vstack([x, [1, 0, 0], [1, 1, -1]])
    u = all_ / np.sqrt((all_ ** 2).sum(1, keepdims=True))
    got = nearest_rows(df, recall=1.0).toPandas()
    for q in (0, 50, 200, 250):
        s = u @ u[ids.index(q)]
        g = got[got.query_id == q].sort_values("rank")
        best = sorted((i for i in range(len(ids)) if ids[i] != q), key=lambda i: (-round(s[i], 12), ids[i]))[:5]
        assert np.allclose(g.score, s[best], atol=1e-12) and len(set(ids[i] for i in best) & set(g.vec_id)) >= 4, q
    u = scaled(np.array([[0.0, 0.0], [3e-320, 1.0], [5e-324, 0], [-1e308, 1e308]]))
    assert np.isfinite(u).all() and (np.abs(u).max(1)[1:] >= 0.5).all() and (np.abs(u) <= 1).all()


def test_main_text():
    page = ("<html><head><title>T</title><script>if (a<b) x('</p>')</script></head><body><header><a>Top</a></header><nav><ul><li>Home</ul></nav>"
            "<div class='cookie-notice'>We use cookies</div><article><h1>Title &amp; more</h1><p>One<br>two  <b>three</b><p>Four&nbsp;five"
            "<aside>Buy</aside><ul><li>a<li>b</ul><form>Name <input></form></article><div id=comments><article>Nice!</article></div>"
            "<footer>&copy; me</footer><!-- <p>no</p> --> </body></html>")
    assert main_text(page) == "Title & more\nOne two three\nFour five\na\nb"
    assert main_text(None) == "" and main_text("a < b &lt; c <p") == "a < b < c"


def test_layout_words_do_not_mark_the_article():
    text = "<p>The text</p><div class=share>Tell all</div>"
    for page in ("<body class='has-sidebar'><article>{}</article></body>", "<html class=no-cookie><body class='no-comments'><div>{}</div></body></html>",
                 "<body><article class='post share'>{}</article></body>", "<body><main id='search-results'>{}</main></body>",
                 "<body><main id=search><article class='post related'>{}</article></main></body>", "<body><div id=widget role=main>{}</div></body>",
                 "<body><div class='sticky-header'><div id=no-sidebar><article>{}</article></div></div><p class=ad>Buy</p></body>",
                 "<body><div class=has-sidebar><article>{}</article><div class=comments><article>Nice!</article></div></div></body>",
                 "<body><article>{}<article class=comment>Nice!</article></article></body>"):
        assert main_text(page.format(text)) == "The text", page
    assert main_text("<body><p>The text</p><div id=comments><article>Nice!</article></div></body>") == "The text"
    assert main_text("<body><p>The text</p><div class=sidebar>Links</div><div hidden><article>Old</article></div></body>") == "The text"


def test_style_tree_removes_what_a_host_repeats(spark):
    page = "<body><div class=top1><p>Same words on every page</p></div><div class=content><p>Text {0} only here</p><p>More {0}</p></div></body>"
    rows = [(i, "https://u@A.example:80/x", page.format(i)) for i in range(8)] + [(9, None, None), (10, "bad", ""), (11, "https://b.example/", page.format(11))]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "page_id long, url string, html string, host long, noise string")
    got = {r.page_id: r for r in extract(df).collect()}
    assert all(got[i].text == f"Text {i} only here\nMore {i}" for i in range(8)) and got[3].n_chars == len(got[3].text)
    assert got[9].text == "" and got[10].n_chars == 0 and got[11].text.startswith("Same words")
    assert extract(df.limit(0)).count() == 0


def test_style_tree_removes_what_a_host_repeats_inside_the_article(spark):
    page = ("<body><p>Dated {0}</p><article><div><p>Read our other texts</p></div><h1>Title {0}</h1><p>Text {0}</p><p>Follow us</p><p>More {0}</p></article>"
            "<div class=x><p>Mind the gap</p></div></body>")
    rows = [(i, "https://a.example/", page.format(i)) for i in range(8)]
    rows += [(20 + i, "https://copies.example/", "<body><main><p>One text</p><p>in two blocks</p></main></body>") for i in range(8)]
    rows += [(40, "https://few.example/", page.format(40))]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Dated {i}\nTitle {i}\nText {i}\nMore {i}" for i in range(8))
    assert all(got[20 + i] == "One text\nin two blocks" for i in range(8))
    assert got[40].split("\n") == ["Dated 40", "Read our other texts", "Title 40", "Text 40", "Follow us", "More 40", "Mind the gap"]


def test_words_do_not_decide_on_prose_inside_the_article(spark):
    for inside, want in (("<p>The <span class='search-hit'>court</span> ruled.</p>", "The court ruled."), ("<p class=legal>Law</p>", "Law"),
                         ("<div class='share-price'>9</div>", "9"), ("<section class=alert>Storm</section>", "Storm"),
                         ("<p>a <span class=share>x<span>y</span>z</span> b</p>", "a b"), ("<div class='ad box'>Buy</div><p>a", "a"),
                         ("<div><span class=ad>x</div><p>kept</p></span>", "kept"), ("<p>a <i class=ad>b", "a b"), ("<div hidden>x</div><p>a", "a")):
        assert main_text(f"<body><article>{inside}</article></body>") == want, inside
    assert main_text("<article>" + "<div class='c legal'>" * 50_000 + "deep" + "</p></section></div>" * 50_000 + "end</article>") == "deep\nend"
    assert main_text("<p>" + "<span class=ad>x" * 50_000) == "x" * 50_000
    page = "<body><article><p>Text {0}</p><div class=share-now><p>Tell {1}</p></div></article></body>"
    rows = [(i, "https://a.example/", page.format(i, "a friend")) for i in range(6)] + [(10 + i, "https://b.example/", page.format(i, i)) for i in range(6)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Text {i}" and got[10 + i] == f"Text {i}\nTell {i}" for i in range(6))


def test_importance_equals_entropies_by_definition(spark):
    rng = random.Random(5)
    pages = []
    for host in (1, 2, -3):
        for i in range(rng.randint(6, 12)):
            parts = [f"<div class=c{rng.randint(0, 1)}>" + "".join(f"<p>w{rng.randint(0, 3)}</p>" for _ in range(rng.randint(1, 3))) + "</div>" for _ in range(2)]
            pages.append((host, "<body><h1>same</h1>" + "".join(parts) + f"<article><p>t{i}</p><p class=legal>c</p></article><nav>n</nav></body>"))
    got = {(r.host, r.path): r for r in style_tree(counted(spark.createDataFrame(pages, "host long, html string"))).collect()}

    def entropy(share):
        return -sum(p * np.log(p) for p in share)

    seen = {}
    for host, html in pages:
        blocks, styles = parse(html)
        for path in {b.path for b in blocks if not b.noise}:
            seen.setdefault((host, path), []).append((" ".join(styles.get(path, [])), {b.text for b in blocks if b.path == path}, next(b.lean for b in blocks if b.path == path)))
    assert set(got) == set(seen)
    for key, on in seen.items():
        m, texts = len(on), [t for _, ts, _ in on for t in ts]
        look = entropy([sum(s == x for s, _, _ in on) / m for x in {s for s, _, _ in on}]) / np.log(m) if m > 1 else 1
        # a block's entropy over the pages with the node, averaged over the blocks of those pages
        content = 1 - np.mean([np.log(texts.count(t)) / np.log(m) for t in texts]) if m > 1 else 1
        want, lean = 0.9 * content + 0.1 * look, max(x for *_, x in on)
        want = (want * m + (lean > 0)) / (m + abs(lean))
        assert got[key].pages == m and abs(got[key].importance - want) < 1e-9
    assert {x for on in seen.values() for *_, x in on} == {1, 0, -1} and _hash("a", -5) == _hash("a", -5) != _hash("a", 5)
