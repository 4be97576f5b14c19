"""Operator 1: personal data by weak supervision.

Base patterns (e-mail, IP, card, phone) always count. Beyond them, wider
patterns propose candidate spans (obfuscated e-mails, local phone numbers,
identity numbers, IBANs, secrets, names). Labelers of three sorts vote for or
against each candidate or abstain: patterns, gazetteers and context words.
Where candidates of several kinds overlap, the one with most votes stands (an
identity number before a phone number, then the first). Expectation-
maximisation over the table of vote patterns estimates how reliable each
labeler is for each kind, drawn towards its reliability over all kinds; its
posteriors train a logistic span classifier, which decides on the candidates
and sees, beside the votes, what no labeler looks at: the span's length, its
variety of characters, words behind it and where in a line it is.

Vote and feature patterns are counted over all documents in Spark. Their number
is bounded by labelers, features and kinds (3**7 * 48 * 6), whatever the input,
and so is what the driver fits on.

Rules for odd input: a null text is empty and has no spans; spans are code
points, end exclusive; candidates never overlap base spans or each other;
repeated rows are handled alike; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship_by_value, small_batches, stored, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "identity", "iban", "secret", "name")
N_LABELERS = 7
FEATURE_SIZES = (4, 3, 2, 2)   # values of each span feature
N_FEATURES = 48                # their product
# Candidates of one kind that make a table of numbers or codes of a text: so many, and so many a character.
CROWD, CROWD_RATE = 50, 0.01

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every '@' with the longest local part before it that no earlier match has taken."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)  # nothing before this '@' can be part of a later local part
        at = text.find("@", max(done, at + 1))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, sorted."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m[0])
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((3, *m.span()))
    return sorted(out)


# Candidate patterns: bounded or possessive repetitions only, so long runs stay linear.
_WIDE = (
    (0, re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{2,63}){1,4}")),
    (3, re.compile(r"(?<![\w+.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{2,4}(?:[\x20.-][0-9]{2,4}){1,3}(?![\w-])")),
    (4, re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")),
    (5, re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)")),
    (6, re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_-])")),
    (7, re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Señor|Señora)\.?\x20[A-Z][a-z]{1,20}(?:\x20[A-Z][a-z]{1,20})?(?!\w)")),
)
# Short secrets are proposed only where they are assigned.
_ASSIGNED = re.compile(r"""(?:[Pp]assw(?:or)?d|PASSW(?:OR)?D|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Aa]pi_?[Kk]ey|API_?KEY)["']?\x20?[=:]\x20?["']?"""
                       r"""([^\s"',;]{6,19})(?![^\s"',;])""")
_CAPITALISED = re.compile(r"(?<!\w)[A-Z][a-z]{1,20}(?:\x20[A-Z][a-z]{1,20})++(?!\w)")
# Gazetteers and context words.
_TLDS = frozenset("app at au be biz br ca ch cn co com cz de dev dk edu es eu example fi fr gov gr hu ie in info int invalid io it jp kr me mil "
                  "mx net nl no nz org pl pt ro ru se sg sk test tr tv ua uk us za".split())
# The length of an IBAN in each country.
_IBAN_LENGTHS = {"AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "BR": 29, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
                 "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20,
                 "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
                 "TR": 26, "UA": 29}
_FIRST_NAMES = frozenset(
    "Adam Ahmed Alan Albert Alexander Alice Amy Andrea Andrew Angela Ann Anna Anne Anthony Antonio Barbara Ben Benjamin Bernd Brian Carlos Carol "
    "Caroline Catherine Charles Charlotte Chris Christian Christine Claire Clara Daniel David Deborah Diana Diego Donald Edward Elena Elizabeth "
    "Emily Emma Eric Erik Eva Fatima Felix Fernando Francisco Frank Fritz George Giulia Hannah Hans Heinz Helen Henry Ingrid Isabel Jack James Jan "
    "Jane Javier Jean Jennifer Jessica Joan John Jonas Jorge Joseph Juan Julia Julie Karen Karl Katharina Kevin Klaus Kurt Laura Lena Linda Lisa "
    "Louis Lucas Lucia Luis Manuel Marco Maria Marie Mark Martin Mary Matthew Max Michael Michelle Miguel Mohammed Monika Nancy Nicolas Nicole Nina "
    "Olga Oliver Olivia Pablo Patricia Patrick Paul Pedro Peter Philip Pierre Rachel Ralf Rebecca Richard Robert Rosa Ruth Samuel Sandra Sara Sarah "
    "Simon Sofia Sophie Stefan Stephanie Steven Susan Susanne Sven Teresa Thomas Timothy Ursula Victor Walter Werner William Wolfgang".split())
_DIAL = frozenset("01 02 03 04 05 06 07 08 09 020 030 040 089 212 415 555 650 800".split())
_SECRET_PREFIXES = ("sk-", "ghp_", "AKIA", "xox", "AIza", "eyJ")
_CUES = {
    0: re.compile(r"mail|contact|write|correo|courriel", re.I),
    3: re.compile(r"tel|phone|call|mobile|fax|anruf|handy", re.I),
    4: re.compile(r"ssn|social|security|identity|passport|ausweis", re.I),
    5: re.compile(r"iban|bank|konto|account|compte|cuenta", re.I),
    6: re.compile(r"token|secret|passw|api.?key|credential|auth", re.I),
    7: re.compile(r"dear|from|signed|name|contact|author", re.I),
}
_AGAINST = re.compile(r"\b(?:isbn|version|page|price|total|order|invoice|chapter|vol|fig|sha|md5|commit|hash)\b", re.I)


def _shape(kind: int, s: str) -> int:
    """A strict pattern labeler for each kind."""
    d = _digits(s)
    if kind == 0:
        return 1
    if kind == 3:
        return 1 if 9 <= len(d) <= 12 else -1
    if kind == 4:
        return -1 if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else 1
    if kind == 5:
        c = s.replace(" ", "")
        return 1 if int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1 and len(c) == _IBAN_LENGTHS.get(c[:2], len(c)) else -1
    if kind == 6:
        if len(s) < 20:
            return 1 if bool(d) and any(c.isalpha() for c in s) else -1
        hexa = all(c in "0123456789abcdef" for c in s) and len(s) in (32, 40, 64)
        mixed = bool(d) and any(c.isupper() for c in s) and any(c.islower() for c in s) and len(s) >= 24
        return 1 if hexa and len(set(s)) > 6 or mixed else -1
    return 1 if s.count(" ") == 2 else 0


def _gazetteer(kind: int, s: str) -> int:
    if kind == 0:
        return 1 if re.split(r"[^A-Za-z]+", s)[-1].lower() in _TLDS else -1
    if kind == 3:
        return 1 if re.split(r"[^0-9]+", s.lstrip("("))[0] in _DIAL else 0
    if kind == 5:
        return 1 if s[:2] in _IBAN_LENGTHS else -1
    if kind == 6:
        return 1 if s.startswith(_SECRET_PREFIXES) else 0
    if kind == 7:
        return 1 if not _FIRST_NAMES.isdisjoint(s.replace(".", "").split()[:-1]) else 0
    return 0


def _votes(text: str, kind: int, a: int, b: int, many: bool) -> list[int]:
    """The labelers' votes (1, -1, or 0 to abstain) on a candidate."""
    s, before = text[a:b], text[max(0, a - 40):a]
    assigned = re.search(r"""[=:]\s?["']?$""", before)
    inside = (a > 0 and text[a - 1].isalnum()) or (b < len(text) and text[b].isalnum())
    distinct = len(set(_digits(s)))
    return [_shape(kind, s), _gazetteer(kind, s),
            1 if kind in _CUES and _CUES[kind].search(before) else 0,
            -1 if _AGAINST.search(before) else 0,
            1 if assigned and kind in (3, 4, 5, 6) else 0,
            -1 if inside or many else 0,
            (1 if distinct >= 4 else -1) if kind in (3, 4, 5) or kind == 6 and b - a >= 20 else 0]


def _features(text: str, kind: int, a: int, b: int) -> int:
    """What the classifier sees beside the votes, as one number: length, variety of characters, a cue behind, start of a line."""
    size, distinct = b - a, len(set(text[a:b]))
    values = (int(size >= 12) + (size >= 20) + (size >= 40), int(distinct >= 8) + (distinct >= 12),
              int(bool(_CUES[kind].search(text[b:b + 40]))), int(a == 0 or text[a - 1] == "\n"))
    code = 0
    for v, n in zip(values, FEATURE_SIZES):
        code = code * n + v
    return code


def _proposals(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of all candidates, overlapping ones too; linear in the text."""
    found = {(*m.span(), k) for k, p in _WIDE for m in p.finditer(text)}
    found.update((*m.span(1), 6) for m in _ASSIGNED.finditer(text))
    found = {(a, b, k) for a, b, k in found if k != 6 or any(c.isdigit() for c in text[a:b])}
    for m in _CAPITALISED.finditer(text):
        at = m.start()
        words = m[0].split(" ")
        i = 0
        while i < len(words):
            take = 1
            if words[i] in _FIRST_NAMES and i + 1 < len(words):
                take = min(3 if words[i + 1] in _FIRST_NAMES else 2, len(words) - i)
                found.add((at, at + sum(map(len, words[i:i + take])) + take - 1, 7))
            at += sum(map(len, words[i:i + take])) + take
            i += take
    return sorted(found)


def _best(group: list[tuple[int, int, int, list[int]]]) -> list[tuple[int, int, int, list[int]]]:
    """Of overlapping candidates those with most votes, as long as they are apart."""
    if len(group) == 1:
        return group
    kept: list[tuple[int, int, int, list[int]]] = []
    for c in sorted(group, key=lambda c: (-sum(c[3]), c[2] == 3, c[0], -c[1], c[2])):
        i = bisect_left(kept, c)
        if (i == 0 or kept[i - 1][1] <= c[0]) and (i == len(kept) or c[1] <= kept[i][0]):
            insort(kept, c)
    return kept


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, code) beside the base spans; the code holds votes (base 3) and span features."""
    found = _proposals(text)
    if not found:
        return []
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken], np.maximum.accumulate([b for _, b in taken]) if taken else []
    counts = np.bincount([k for _, _, k in found], minlength=len(KINDS))
    crowd = max(CROWD, len(text) * CROWD_RATE)
    out, group, end = [], [], 0
    for a, b, k in found:
        i = bisect_left(starts, b)
        if i and ends[i - 1] > a:
            continue
        if group and a >= end:
            out += _best(group)
            group = []
        group.append((a, b, k, _votes(text, k, a, b, counts[k] > crowd)))
        end = max(end, b)
    out += _best(group) if group else []
    coded = []
    for a, b, k, votes in out:
        code = 0
        for v in votes:
            code = code * 3 + v + 1
        coded.append((k, a, b, code * N_FEATURES + _features(text, k, a, b)))
    return coded


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``base`` and ``cand`` (arrays of structs) of every row."""
    schema = ("id string, base array<struct<kind:int,a:long,b:long>>, "
              "cand array<struct<kind:int,a:long,b:long,code:int>>")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            base = [base_spans(t) for t in batch["text"]]
            cand = [candidates(t, s) for t, s in zip(batch["text"], base)]
            yield pd.DataFrame({"id": batch["id"],
                                "base": [[dict(kind=k, a=a, b=b) for k, a, b in s] for s in base],
                                "cand": [[dict(kind=k, a=a, b=b, code=c) for k, a, b, c in s] for s in cand]})

    src = small_batches(docs).select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return src.mapInPandas(run, schema)


def vote_matrix(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes // N_FEATURES // 3 ** (N_LABELERS - 1 - j) % 3 - 1 for j in range(N_LABELERS)], 1) if len(codes) \
        else np.zeros((0, N_LABELERS), np.int64)


def reliabilities(kinds: np.ndarray, votes: np.ndarray, n: np.ndarray, steps: int = 50, pull: float = 20.0) -> tuple[np.ndarray, np.ndarray]:
    """EM for a two-class model with independent labelers of each kind: (p[kind, class, labeler, vote], posterior of class 1).

    A kind's reliabilities are drawn towards those over all kinds by ``pull`` candidates, and these
    towards a labeler that is right more often than wrong by a few.
    """
    post = 1 / (1 + np.exp(-1.5 * votes.sum(1)))  # start: the majority of the votes
    of = [kinds == k for k in range(len(KINDS))]
    anchor = np.array([[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]])[:, None, :]
    p = np.full((len(KINDS), 2, N_LABELERS, 3), 1 / 3)
    for _ in range(steps):
        w = np.stack([(1 - post) * n, post * n])
        seen = np.stack([np.stack([w[:, at] @ (votes[at] == v - 1) for v in range(3)], 2) for at in of])
        pooled = seen.sum(0) + anchor
        pooled /= pooled.sum(2, keepdims=True)
        p = seen + pull * pooled
        p /= p.sum(3, keepdims=True)
        prior = np.stack([(w[:, at].sum(1) + 1) / (w[:, at].sum() + 2) for at in of])
        logs = np.log(prior)[kinds].T + sum(np.log(p[kinds, :, j, votes[:, j] + 1]).T for j in range(N_LABELERS))
        post = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
    return p, post


@dataclass
class SpanModel:
    """Logistic span classifier over votes, kinds and span features."""
    weights: np.ndarray
    labelers: np.ndarray  # EM's vote probabilities by kind and class

    def score(self, kinds: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(kinds, codes) @ self.weights, -50, 50)))


def _design(kinds: np.ndarray, codes: np.ndarray) -> np.ndarray:
    votes, rest = vote_matrix(codes), codes % N_FEATURES
    kind = kinds[:, None] == np.arange(len(KINDS))
    cols = [np.ones((len(votes), 1)), votes > 0, votes < 0, kind, kind * votes[:, :1], kind * votes[:, 3:4]]
    for size in reversed(FEATURE_SIZES):
        cols.append((rest % size)[:, None] == np.arange(size))
        rest = rest // size
    return np.concatenate(cols, 1).astype(float)


def fit_model(patterns: pd.DataFrame, ridge: float = 1.0, steps: int = 30) -> SpanModel:
    """EM on the counted vote patterns, then logistic regression on its posteriors (Newton steps)."""
    kinds, codes, n = (patterns[c].to_numpy(np.int64) for c in ("kind", "code", "n"))
    p, post = reliabilities(kinds, vote_matrix(codes), n.astype(float))
    x = _design(kinds, codes)
    w = np.zeros(x.shape[1])
    scale = n / max(1, n.sum()) * len(n)  # frequent patterns weigh more, the ridge keeps its size
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        grad = x.T @ (scale * (post - q)) - ridge * w * 0.01
        hess = (x * (scale * q * (1 - q))[:, None]).T @ x + 0.01 * ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return SpanModel(w, p)


def pattern_counts(spans: DataFrame) -> pd.DataFrame:
    """Counts of (kind, votes and features) over all rows: at most kinds * 3**labelers * features of them."""
    return (spans.select(F.explode("cand").alias("c")).groupBy("c.kind", "c.code").agg(F.count(F.lit(1)).alias("n"))
                 .orderBy("kind", "code").toPandas())


def _added(cand: list, model: SpanModel) -> list[tuple[int, int, int]]:
    if len(cand) == 0:
        return []
    s = model.score(np.array([c["kind"] for c in cand]), np.array([c["code"] for c in cand]))
    return [(int(c["kind"]), int(c["a"]), int(c["b"])) for c, p in zip(cand, s) if p >= 0.5]


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base counts, SHA-256 of the base spans, all spans; one pass over the texts."""
    rows = stored(spans_of(docs, id_col, text_col), "spans")
    model = fit_model(pattern_counts(rows))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            base = [[(int(s["kind"]), int(s["a"]), int(s["b"])) for s in x] for x in b["base"]]
            out = pd.DataFrame({"id": b["id"]})
            for j, k in enumerate(BASE):
                out[f"n_{k}"] = [sum(s[0] == j for s in x) for x in base]
            out["base_sha256"] = [hashlib.sha256(_join(x).encode()).hexdigest() for x in base]
            added = [_added(c, model) for c in b["cand"]]
            out["spans"] = [_join(x + y) for x, y in zip(base, added)]
            out["n_added"] = [len(y) for y in added]
            yield out

    found = rows.mapInPandas(run, "id string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                                  "spans string, n_added long")
    return found.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def redact_text(text: str, model: SpanModel) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    base = base_spans(text)
    cand = candidates(text, base)
    spans = base + _added([dict(kind=k, a=a, b=b, code=c) for k, a, b, c in cand], model)
    out, end = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= end:
            out += [text[end:a], f"[{KINDS[k].upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:] if out else text


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal data replaced; ``n_chars`` follows the text."""
    id_col = docs.columns[0]
    model = fit_model(pattern_counts(spans_of(docs, id_col, text_col)))
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            new = [t if t is None else redact_text(t, model) for t in b.column(at).to_pylist()]
            cols = list(b.columns)
            cols[at] = pa.array(new, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    out = docs.mapInArrow(run, docs.schema)
    if chars_col and chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col(text_col).isNull(), F.col(chars_col))
                             .otherwise(F.length(text_col)).cast(docs.schema[chars_col].dataType))
    return out


def op1_weak_supervision_pii(spark, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


ship_by_value(__name__)
