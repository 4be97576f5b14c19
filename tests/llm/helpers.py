"""Plain Python versions of the definitions, and small fixtures."""

import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = WORD.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def near_components(rows, k, percent):
    """{position: smallest id reachable} by comparing all pairs that share a shingle."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(a, b) for l in where.values() for n, a in enumerate(l) for b in l[n + 1:]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = min(ids) if ids else None
    return sets, out


def doc_frame(spark, rows, extra=False):
    """(doc_id, text) rows as a documents table; ``extra`` adds columns with names the operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    if extra:
        schema += ", key long, label string, id string, n long, sha string, row string, h long, rep long, x long, y long, maybe boolean, bloom_word long"
        full = [(*r, 1, "l", "i", 2, "s", "r", 3, 4, 5, 6, False, 7) for r in full]
    return spark.createDataFrame(full, schema)
