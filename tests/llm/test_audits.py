"""Operators 11 to 13 against plain Python versions of their contracts."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewater.llm import filter_audit, language_id, source_divergence

SCHEMA = "doc_id long, text string, lang string, source string"
CLASHES = "part string, mask int, sha string, ord long, n long, p long, v long, start long, key long, label string, id string, draw double"


def docs_of(spark, rows, extra=False):
    if not extra:
        return spark.createDataFrame(rows, SCHEMA)
    return spark.createDataFrame([(*r, "x", 1, "s", 2, 3, 4, 5, 6, 7, "l", "i", 0.5) for r in rows], f"{SCHEMA}, {CLASHES}")


# ---- operator 12

def brute_audit(rows, labels):
    texts = [t or "" for _, t, _, _ in rows]
    good = {i: max((q == 1) for j, q, _ in labels if j == i) for i, _, _ in labels if i is not None}
    toxic = {i: max((x == 1) for j, _, x in labels if j == i) for i, _, x in labels if i is not None}
    fails = []
    for (i, _, _, _), t in zip(rows, texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            f.add("C")
        if re.search("[#$%&*|]", t):
            f.add("D")
        if i is not None and any(j is not None and j < i and u == t for (j, _, _, _), u in zip(rows, texts)):
            f.add("E")
        fails.append(f)
    out = {}
    parts = defaultdict(list)
    for r, f in zip(rows, fails):
        parts[r[3] or ""].append((r[0], f))
    for part, members in parts.items():
        shapley = Counter()
        mine = {}
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, x in enumerate(order, 1):
                gone = [m for m in left if x in m[1]]
                left = [m for m in left if x not in m[1]]
                shapley[x] += len(gone)
                mine["".join(order), step] = (x, len(left), len(gone), sum(x in f for _, f in members) - len(gone),
                                              sum(f == {x} for _, f in members), sum(good.get(i, False) for i, _ in gone),
                                              sum(toxic.get(i, False) for i, _ in gone))
        out |= {(part, *k): (*v[1:], shapley[v[0]]) for k, v in mine.items()}
    return out


def audit_rows(seed=1, n=60):
    r = random.Random(seed)
    base = [" ".join(r.choice(["ab", "Cd", "é", "x", "Yz"]) + (str(k) if r.random() < .5 else "") for k in range(r.choice([3, 150, 200, 260])))
            + r.choice(["", " | ", "\t#"]) for _ in range(12)]
    texts = [*base, None, "", " ", "\n\x0b", "A", "é" * 50 + "A", "w " * 199 + "w", "w" * 20_000, "𝔸" * 60 + "B"]
    rows = [(k if r.random() < .95 else None, r.choice(texts), "en", r.choice(["s", "t", None, ""])) for k in range(n)]
    return rows + rows[:3]


def test_filter_audit_equals_brute_force(spark):
    rows = audit_rows()
    labels = [(k, k % 3, k % 2) for k in range(0, 60, 2)] + [(None, 1, 1), (4, 1, 0), (6, None, None)]
    got = filter_audit.audit_filters(docs_of(spark, rows, extra=True), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == [c.split()[0] for c in filter_audit.SCHEMA.split(", ")]
    found = {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()}
    assert found == brute_audit(rows, labels)


def test_filter_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(docs_of(spark, []), empty).collect() == []
    one = filter_audit.audit_filters(docs_of(spark, [(None, None, None, None)]), empty).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""} and {r["kept"] + r["removed"] for r in one if r["step"] == 1} == {1}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_adjacent_swaps_visit_every_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for level in filter_audit.adjacent_swaps(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n))))


def test_diagram_shares_equal_parts_and_keeps_its_counts():
    d = filter_audit.Diagram({0: (5,), 3: (2,), 31: (1,)}, 5, 1)
    assert d.total[d.root] == (8,) and len(d.levels[4]) <= 4  # of 16 possible nodes of that level
    for level in filter_audit.adjacent_swaps(5):
        d.swap(level)
        assert d.total[d.root] == (8,)
        assert all(d.total[n][0] == d.total[a][0] + d.total[b][0] for l in d.levels for (a, b), n in l.items())


# ---- operator 11

def brute_divergence(rows, min_docs=3, top=200):
    rows = [(t or "", l or "", s or "") for _, t, l, s in rows]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t, _, _ in rows]
    df, counts = Counter(), defaultdict(Counter)
    for (_, l, _), w in zip(rows, words):
        df.update((l, x) for x in set(w))
    kept = defaultdict(set)
    for (l, x), n in df.items():
        if n >= min_docs:
            kept[l].add(x)
    for (_, l, s), w in zip(rows, words):
        for key in ((l, s), l):
            counts[key].update(x for x in w if x in kept[l])

    def p(key, x):
        v = len(kept[key if isinstance(key, str) else key[0]])
        return 1 + 10**9 * (counts[key][x] + 1) // (sum(counts[key].values()) + v)

    out = set()
    groups = {(l, s) for _, l, s in rows}
    for l, s in groups:
        pairs = [(sum((p((l, s), x) - p((l, h), x)) ** 2 // p((l, h), x) for x in kept[l]), h) for m, h in groups if m == l and h != s]
        terms = [((p((l, s), x) - p(l, x)) ** 2 // p(l, x), x) for x in kept[l] if counts[l, s][x] and p((l, s), x) > p(l, x)]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            order = sorted(found, key=lambda r: (-r[0], r[1].encode()))[:most]
            out |= {(l, s, part, x, v, k) for k, (v, x) in enumerate(order, 1)}
    return out


def word_rows(seed=2, n=90):
    r = random.Random(seed)
    vocab = ["a", "ab", "abc", "abd", "b", "the", "éa", "é", "日本", "日", "𝔸x", "zz", "Zebra", "ABD", "long" * 60, "prefix00" * 2, "prefix00"]
    rows = []
    for k in range(n):
        text = r.choice([" ", "-", "_", "1", "\n"]).join(r.choice(vocab) for _ in range(r.randrange(0, 30)))
        rows.append((k, r.choice([text, text, text, None, ""]), r.choice(["en", "en", "fr", None]), r.choice(["s", "t", "u", "v", None])))
    return rows + rows[:4] + [(900, "only here", "xx", "s"), (901, None, "xx", "t"), (None, "a", "yy", None)]


@pytest.mark.parametrize("block, pass_bytes, width, tile", [(1 << 18, 64 << 20, 256, 64), (3, 1, 4, 2)])
def test_divergence_equals_brute_force(spark, block, pass_bytes, width, tile):
    rows = word_rows()
    got = source_divergence.divergences(docs_of(spark, rows, extra=True), block=block, pass_bytes=pass_bytes, width=width, tile=tile)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute_divergence(rows)


def test_divergence_of_nothing(spark):
    assert source_divergence.divergences(docs_of(spark, [])).collect() == []


def test_transducer_is_minimal_and_numbers_terms_in_byte_order():
    r = random.Random(3)
    terms = sorted({"".join(r.choice("abéz日") for _ in range(r.randrange(1, 8))).encode() for _ in range(400)} | {b"x" * 5000, b"x" * 5001})
    b = source_divergence.Builder()
    for t in terms:
        b.add(t)
    t = source_divergence.Transducer.load(b.finish())
    assert list(t.terms()) == terms
    rights = {frozenset(x[k:] for x in terms if x.startswith(p)) for x in terms if len(x) < 50 for k in range(len(x) + 1) for p in [x[:k]]}
    assert len({s for s in b.states}) == len(b.states)
    assert len(b.states) <= len(rights) + 5002  # one state a right language; the long terms have their own
    probe = [*terms, b"", b"zz", terms[0] + b"q", b"x" * 4999]
    data = np.frombuffer(b"".join(probe), np.uint8)
    length = np.array([len(x) for x in probe])
    where = {x: k for k, x in enumerate(terms)}
    assert t.ordinals(data, np.cumsum(length) - length, length).tolist() == [where.get(x, -1) for x in probe]


# ---- operator 13

def lang_rows(n=240):
    r = random.Random(5)
    syllables = {"en": ["th", "er", "ing", "and", "wh"], "de": ["sch", "ein", "ü", "ung", "zu"], "el": ["αι", "το", "ου", "σ"]}
    rows = []
    for k in range(n):
        lang = r.choice(list(syllables))
        text = " ".join("".join(r.choice(syllables[lang]) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(4, 40)))
        rows.append((k, text, lang, "s"))
    return rows


def test_language_id_on_held_out_rows(spark):
    rows = lang_rows()
    odd = [(1000, None, "en", None), (1001, "", "en", "s"), (1002, "12 — 3 ² !", "de", "s"), (None, "the thing and the", "en", "s"),
           (1004, "wherand " * 60_000, None, "s"), (rows[0][0], *rows[0][1:])]
    docs = docs_of(spark, rows + odd, extra=True)
    got = language_id.identify(docs, language_id.train(docs)).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in got}
    for i, text, lang, _ in rows:
        assert by_id[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= by_id[i]["score"] <= 1
    tested = [r for r in rows if by_id[r[0]]["held_out"]]
    assert len(tested) > 60 and sum(by_id[i]["lang_pred"] == lang for i, _, lang, _ in tested) >= 0.97 * len(tested)
    assert [by_id[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by_id[1002]["score"] == 0
    assert by_id[1004]["lang_pred"] == "en" and by_id[None]["lang_pred"] == "en" and not by_id[None]["held_out"]


def test_language_id_without_labels(spark):
    docs = docs_of(spark, [(1, "some text", None, "s"), (2, None, None, None)])
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(docs, language_id.train(docs)).collect()} == {("und", 0.0)}
    empty = docs_of(spark, [])
    assert language_id.identify(empty, language_id.train(empty)).collect() == []


def test_labels_of_held_out_rows_change_nothing(spark):
    rows = lang_rows(90)
    swapped = [(i, t, "el" if zlib.crc32(str(i).encode()) % 3 == 1 else l, "other") for i, t, l, _ in rows]
    a, b = ({tuple(r) for r in language_id.identify(d, language_id.train(d)).collect()} for d in (docs_of(spark, rows), docs_of(spark, swapped)))
    assert a == b


def test_ngrams_of_pieces_equal_ngrams_of_the_whole(monkeypatch):
    text = "Das ist ein längerer Text, 12 mal; " * 40
    whole = language_id.ngram_counts(text)
    monkeypatch.setattr(language_id, "PIECE", 17)
    assert (language_id.ngram_counts(text) == whole).all()
    assert whole.sum() == sum(len(" " + language_id._OTHER.sub(" ", text.lower()).strip() + " ") - k for k in (0, 1, 2))


def test_ftrl_equals_a_scalar_version():
    r = np.random.default_rng(1)
    learner = language_id.Ftrl(3)
    z, n = defaultdict(float), defaultdict(float)
    for _ in range(40):
        at = np.sort(r.choice(50, 6, replace=False))
        x, y = r.random(6), int(r.integers(3))

        def w(i, c):
            if abs(z[i, c]) <= language_id.L1:
                return 0.0
            return (np.sign(z[i, c]) * language_id.L1 - z[i, c]) / ((language_id.BETA + n[i, c] ** .5) / language_id.ALPHA + language_id.L2)

        full = [*zip(at, x), (language_id.SIZE, 1.0)]
        margin = [sum(v * w(i, c) for i, v in full) for c in range(3)]
        e = np.exp(np.array(margin) - max(margin))
        p = e / e.sum()
        step = {(i, c): (v * (p[c] - (c == y)), w(i, c)) for i, v in full for c in range(3)}
        for k, (g, old) in step.items():
            z[k] += g - ((n[k] + g * g) ** .5 - n[k] ** .5) / language_id.ALPHA * old
            n[k] += g * g
        learner.learn(at, x, y)
    assert all(abs(learner.z[k] - v) < 1e-9 for k, v in z.items())
    assert (learner.weight(slice(None)) == 0).mean() > 0.99  # never seen, or held at 0 by L1


def test_temperature_is_the_best_of_a_grid():
    r = np.random.default_rng(2)
    y = r.integers(0, 3, 300)
    m = r.normal(size=(300, 3)) * 6 + 4 * np.eye(3)[y]

    def loss(t):
        return -np.log(language_id.softmax(m / t)[np.arange(300), y]).sum()

    best = language_id.temperature(m, y)
    assert loss(best) <= min(loss(t) for t in np.exp(np.linspace(-2.5, 2.5, 200))) + 1e-3
