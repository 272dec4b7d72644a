import hashlib
import random
import re

import numpy as np

from vitalgrid.llm import pii as P

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = []
    for no, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text):
            s = m.group()
            d = re.sub("[^0-9]", "", s)
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in s.split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), no, m.end()))
    return sorted(out)


def test_base_spans_against_patterns():
    rng = random.Random(5)
    bits = ["a", "é", "@", ".", "b.c", "1", "23", "255", "4111111111111111", "+1", " ", "-", "(555)", "x@y.zz", "1.2.3.4", "@@", "_", "%"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert P.base_spans(text) == brute(text), text


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "a" * 200_000 + "@", "+1" + "(" * 200_000, "1." * 150_000, "@" * 200_000):
        assert P.base_spans(text) == brute("x") or len(P.base_spans(text)) <= len(text)


def test_em_finds_the_reliable_labeler():
    rng = np.random.default_rng(2)
    real = rng.random(4000) < 0.6
    right = [0.95, 0.9, 0.6]
    vote = np.stack([np.where(rng.random(4000) < r, real, ~real) for r in right], axis=1) * 2 - 1
    patterns, count = np.unique(vote, axis=0, return_counts=True)
    post, table = P.reliabilities(np.zeros(len(patterns), int), patterns, count.astype(float))
    agree = [table[0, j, 1, 2] for j in range(3)]
    assert agree[0] > agree[2] and agree[1] > agree[2]
    assert all((p > 0.5) == (v[0] + v[1] > 0) for p, v in zip(post, patterns) if v[0] == v[1])


def test_query_columns_and_added_spans(make):
    rows = [(i, f"write to joe{i}@mail.example.com or call +1 (555) 010-{1000 + i} now", "en", "a") for i in range(40)]
    rows += [(100 + i, f'my token = "{hashlib.sha1(bytes([i])).hexdigest()}" here', "en", "a") for i in range(40)]
    rows += [(200 + i, "cards 4111111111111111 5500000000000004 here", "en", "a") for i in range(5)]
    got = {r.doc_id: r for r in P.find(make(rows)).collect()}
    for i, text, *_ in rows:
        want = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in brute(text))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert not want or set(want.split(",")) <= set(got[i].spans.split(","))
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == n for _, k, _ in brute(text)) for n in range(4)]
    assert "secret:" in got[100].spans and got[100].n_added == 1
    assert got[200].spans == "card:6:22,card:23:39"


def test_edges(odd, make):
    got = P.find(odd).collect()
    assert len(got) == odd.count()
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.doc_id in (1, 2, 3))
    assert P.find(make([])).count() == 0
