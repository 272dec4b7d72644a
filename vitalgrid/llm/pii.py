"""Personal data by weak supervision.

Exact patterns give the base spans. Looser patterns propose more: numbers run together, obfuscated addresses, local phone
numbers, quoted secrets. Labelers of three sorts (form, gazetteer, context) vote for, against or not at all on every
candidate, the base spans among them. Votes with equal features are counted over the whole corpus; on these counts
expectation-maximisation estimates each labeler's reliability and each vote pattern's posterior, and the posteriors train
a logistic span classifier. Candidates it accepts are added where they touch no base span.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vitalgrid.session import stored

#: Fixed by the contract: kinds in their order, and the patterns of the base spans.
BASE = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a later start in the same digits fails alike
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

KINDS = BASE + ("secret",)
#: Looser forms, each with its kind.
LOOSE = (("card", re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])|(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])")),
         ("phone", re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
         ("secret", re.compile(r"(?<=[\"'])[A-Za-z0-9+/_-]{24,128}(?=[\"'])")))
LOOSE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63})+",
                         re.IGNORECASE)
DIGIT = re.compile(r"[0-9]")
#: Words that go with a kind, and what lies near a number that is none.
CUES = {"email": r"mail|contact|write|kontakt|correo|courriel", "ip": r"\bip\b|host|server|addr", "phone": r"phone|tel|call|fax|mobil",
        "card": r"card|visa|credit|karte|carte|tarjeta", "secret": r"token|secret|key|passw|api"}
CUES = {k: re.compile(v, re.IGNORECASE) for k, v in CUES.items()}
AGAINST = re.compile(r"\b(?:version|section|chapter|isbn|issn|doi|page|figure|sha\d*|md5|commit|checksum)\b", re.IGNORECASE)
TOP_DOMAINS = frozenset("com org net edu gov io de fr es it uk eu info".split())
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "36")
NEAR = 32

ROUNDS, RIDGE, ACCEPT = 40, 1e-2, 0.5


def luhn(digits: str) -> bool:
    values = np.frombuffer(digits.encode(), np.uint8)[::-1].astype(int) - 48
    twice = values[1::2] * 2
    return (values[::2].sum() + (twice - 9 * (twice > 9)).sum()) % 10 == 0


def digits_of(s: str) -> str:
    return "".join(DIGIT.findall(s))


def emails(text: str):
    """Leftmost matches of local part, @ and dotted domain, around each @ in turn: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) by start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            d = digits_of(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(digits_of(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the looser forms that touch no base span; one at a place, the earlier kind first."""
    found = []
    if DIGIT.search(text) or '"' in text or "'" in text:
        found += [(m.start(), KINDS.index(kind), m.end()) for kind, form in LOOSE for m in form.finditer(text)]
    low = text.lower()
    if "(at)" in low or "[at]" in low:
        found += [(m.start(), 0, m.end()) for m in LOOSE_EMAIL.finditer(text)]
    out, ends, i = [], 0, 0
    for start, kind, end in sorted(found, key=lambda s: (s[0], s[1])):
        while i < len(base) and base[i][2] <= start:
            i += 1
        if start >= ends and not (i < len(base) and base[i][0] < end):
            out.append((start, kind, end))
            ends = end
    return out


def votes(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """Of each labeler: 1 for, -1 against, 0 abstains. Form, form, check, gazetteer, context, context, context."""
    name, s, d = KINDS[kind], text[start:end], digits_of(text[start:end])
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    strict = {"email": "@" in s, "ip": True, "card": len(d) == 16 or len(d) == 15, "phone": s[0] in "+(" or "-" in s,
              "secret": len(s) >= 32}[name]
    mixed = {"email": not s[0].isdigit(), "ip": all(len(p) <= 3 for p in s.split(".")), "card": len(set(d)) > 3,
             "phone": len(set(d)) > 3, "secret": 0.1 < len(d) / len(s) < 0.95 and len(set(s)) > 8}[name]
    check = {"email": 0, "ip": 0, "card": 1 if luhn(d) else -1, "phone": 0, "secret": 0}[name]
    listed = {"email": 1 if s.rsplit(".", 1)[-1].lower() in TOP_DOMAINS else -1 if "@" in s else 0,
              "ip": -1 if s.split(".")[0] in ("0", "127", "255") else 1,
              "card": 1 if d.startswith(ISSUERS) else -1, "phone": 1 if s[:2] in ("+1", "+3", "+4") else 0, "secret": 0}[name]
    cue = 1 if CUES[name].search(before) else 0
    apart = -1 if before[-1:].isalnum() or after[:1].isalnum() else 1
    other = -1 if AGAINST.search(before) else 0
    return (1 if strict else -1, 1 if mixed else -1, check, listed, cue, apart, other)


def features(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """Shape of a span: length, share of digits, character sorts and neighbours, each as a small number."""
    s = text[start:end]
    sort = lambda c: 0 if not c else 1 if c.isalpha() else 2 if c.isdigit() else 3 if c.isspace() else 4
    return (min(len(s) // 4, 12), 4 * len(DIGIT.findall(s)) // len(s), int(any(c.isalpha() for c in s)),
            int(any(not c.isalnum() for c in s)), sort(text[start - 1 : start]), sort(text[end : end + 1]))


def pattern(text: str, start: int, kind: int, end: int) -> str:
    return f"{kind}|{','.join(map(str, votes(text, start, kind, end)))}|{','.join(map(str, features(text, start, kind, end)))}"


SCAN = "n array<long>, base string, sha string, candidates array<struct<start int, kind int, stop int, pattern string>>, seen array<string>"


def scan(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        text = t or ""
        base = base_spans(text)
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
        more = [(a, k, b, pattern(text, a, k, b)) for a, k, b in loose_spans(text, base)]
        rows.append(([sum(k == i for _, k, _ in base) for i in range(len(BASE))], joined,
                     hashlib.sha256(joined.encode()).hexdigest(),
                     [{"start": a, "kind": k, "stop": b, "pattern": p} for a, k, b, p in more],
                     [pattern(text, a, k, b) for a, k, b in base] + [p for *_, p in more]))
    return pd.DataFrame(rows, columns=["n", "base", "sha", "candidates", "seen"])


def parsed(patterns: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [p.split("|") for p in patterns]
    return (np.array([int(k) for k, _, _ in parts], int), np.array([v.split(",") for _, v, _ in parts], int),
            np.array([f.split(",") for _, _, f in parts], int))


def reliabilities(kind: np.ndarray, vote: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM on counted vote patterns: P(span is real) of each pattern, and P(vote | real or not) by kind and labeler.

    Starts from the majority; a Beta prior keeps a labeler that seldom votes near even.
    """
    post = sigmoid(vote.sum(1).astype(float))
    table = np.zeros((len(KINDS), vote.shape[1], 2, 3))
    for _ in range(ROUNDS):
        score = np.zeros(len(vote))
        for k in range(len(KINDS)):
            own = kind == k
            if not own.any():
                continue
            share = np.stack([1 - post[own], post[own]]) * count[own]
            prior = (share.sum(1) + [1, 2]) / (share.sum() + 3)
            score[own] += np.log(prior[1] / prior[0])
            for j in range(vote.shape[1]):
                seen = np.stack([np.bincount(vote[own, j] + 1, share[c], 3) for c in (0, 1)])
                table[k, j] = (seen + [[2, 1, 1], [1, 1, 2]]) / (seen.sum(1, keepdims=True) + 4)
                score[own] += np.log(table[k, j, 1] / table[k, j, 0])[vote[own, j] + 1]
        post = sigmoid(score)
    return post, table


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def encoded(kind: np.ndarray, vote: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """One-hot kind, shapes by kind, and votes."""
    hot = [np.eye(len(KINDS))[kind], vote]
    for j, top in enumerate((13, 5, 2, 2, 5, 5)):
        hot.append(np.eye(top * len(KINDS))[kind * top + np.minimum(shape[:, j], top - 1)])
    return np.hstack(hot)


def classifier(patterns: list[str], counts: list[int]) -> np.ndarray:
    """Weights of the span classifier: logistic regression on the EM posteriors, patterns weighted by the log of counts."""
    kind, vote, shape = parsed(patterns)
    count = np.array(counts, float)
    post, _ = reliabilities(kind, vote, count)
    x, weight = encoded(kind, vote, shape), np.log1p(count)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = sigmoid(x @ w)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + RIDGE * weight.sum() * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (weight * (post - p)) - RIDGE * weight.sum() * w)
    return w


def accepted(patterns: list[str], w: np.ndarray) -> np.ndarray:
    return sigmoid(encoded(*parsed(patterns)) @ w) >= ACCEPT if patterns else np.zeros(0, bool)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of each row.

    Null text counts as empty. Offsets are code points, ends exclusive. Patterns and votes are small numbers, so their
    combinations, which the driver fits on, are bounded whatever the corpus. Other columns are not looked at.
    """
    got = stored(docs.select(F.col(id_col).alias("doc_id"), F.pandas_udf(scan, SCAN)(text_col).alias("s"))
                 .select("doc_id", "s.n", "s.base", "s.sha", "s.candidates", "s.seen"), "pii-scan")
    counted = sorted((r["p"], r["count"]) for r in got.select(F.explode("seen").alias("p")).groupBy("p").count().collect())
    weights = classifier([p for p, _ in counted], [n for _, n in counted]) if counted else None

    @F.pandas_udf("spans string, n_added int")
    def joined(base: pd.Series, candidates: pd.Series) -> pd.DataFrame:
        rows = []
        for own, more in zip(base, candidates):
            spans = [(int(a), KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in own.split(",") if x)]
            taken = accepted([c["pattern"] for c in more], weights)
            spans += [(int(c["start"]), int(c["kind"]), int(c["stop"])) for c, ok in zip(more, taken) if ok]
            rows.append((",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans)), int(taken.sum())))
        return pd.DataFrame(rows, columns=["spans", "n_added"])

    told = got.withColumn("j", F.when(F.size("candidates") > 0, joined("base", "candidates")))
    return told.select("doc_id", *[F.col("n")[i].alias(f"n_{k}") for i, k in enumerate(BASE)], F.col("sha").alias("base_sha256"),
                       F.coalesce("j.spans", "base").alias("spans"), F.coalesce("j.n_added", F.lit(0)).alias("n_added"))
