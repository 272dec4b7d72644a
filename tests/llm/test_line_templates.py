import math
import random
import re
from collections import Counter

import pytest

from vitalgrid.llm import line_templates as T


def result(df):
    return {r.doc_id: r for r in T.dedup_lines(df).collect()}


def test_recurring_lines_stay_in_the_first_document(make):
    boiler = "Licensed under the terms of version 3 of this license"
    df = make([(i, f"{chr(97 + i)} own words\n{boiler}\nthe end", "en", "a") for i in range(6)])
    got = result(df)
    assert got[0].n_dropped == 0 and boiler in got[0].text
    assert all(got[i].n_dropped == 1 and got[i].text == f"{chr(97 + i)} own words\nthe end" for i in range(1, 6))


def test_digits_and_varying_fields_generalise(make):
    df = make([(i, f"page {i} of {i * 7} was shown to user{i} today\n"
                   f"request from host {name} was answered by the main server here", "en", "a")
               for i, name in enumerate(["ape", "bee", "cat", "dog"])])
    got = result(df)
    assert got[0].n_dropped == 0 and all(got[i].n_dropped == 2 and got[i].text == "" for i in (1, 2, 3))


def test_recurring_field_values_generalise_at_every_size(make):
    # two fields of 10 values each recur within a leaf that also holds a rarer template with a field of its own
    for n in (20, 200):
        parcels = [(i, f"parcel from the {'abcdefghij'[i % 10]}x depot to the {'abcdefghij'[i * 7 // 10 % 10]}y depot was accepted "
                       "for transport today", "en", "a") for i in range(n)]
        rare = [(n + i, f"parcel from the shop {'pqrst'[i % 5]} was sent back because nobody opened the front door", "en", "a") for i in range(n // 4)]
        got = result(make(parcels + rare))
        assert sorted(i for i, r in got.items() if r.n_dropped == 0) == [0, n]


def test_different_lines_of_a_leaf_stay(make):
    df = make([(1, "one two three alpha beta gamma delta epsilon zeta", "en", "a"),
               (2, "one two three red green blue black white grey", "en", "a")])
    assert all(r.n_dropped == 0 for r in result(df).values())


def test_short_lines_and_one_document_repeats_stay(make):
    df = make([(1, "a b c\na b c\n" + "the same line of words again\n" * 3, "en", "a"), (2, "a b c", "en", "a")])
    assert all(r.n_dropped == 0 for r in result(df).values())


def test_lines_of_few_tokens_and_without_blanks_recur(make):
    shared = "All rights reserved.\n版权所有\n本网站所有内容未经许可不得转载\nสงวนลิขสิทธิ์"
    got = result(make([(i, f"{shared}\n独自の文{'あいう'[i]}", "en", "a") for i in range(3)]))
    assert got[0].n_dropped == 0 and all(got[i].n_dropped == 4 and got[i].text == f"独自の文{'あいう'[i]}" for i in (1, 2))


def test_rows_of_figures_are_compared_as_they_are(make):
    df = make([(i, f"{i} {i + 3} {i * 7} {i * i} {i - 9}\nTotal {i}.5 {i}.25 {i}\n12 345 6789 0 1\n2024年{i}月第{i}号\n2024年版权所有", "en", "a")
               for i in range(4)])
    got = result(df)
    assert got[0].n_dropped == 0 and all(got[i].n_dropped == 2 and "12 345" not in got[i].text and "版权" not in got[i].text
                                         for i in (1, 2, 3))


def test_words_and_figures_together_leave_enough_constant(make):
    # four figures and two of four words vary: not the same line
    df = make([(i, f"scale read 1{i} 2{i} 3{i} 4{i} {a} {b}", "en", "a") for i, (a, b) in enumerate(["pq", "rs", "tu", "vw"])])
    assert all(r.n_dropped == 0 for r in result(df).values())


def test_differing_facts_of_few_lines_stay(make):
    facts = [("1901", "Spain", "Madrid"), ("1902", "France", "Paris"), ("1903", "Norway", "Oslo")]
    df = make([(i, f"In {y}, the king of {c} was crowned in {t}.", "en", "a") for i, (y, c, t) in enumerate(facts)])
    assert all(r.n_dropped == 0 for r in result(df).values())
    assert [r.n_dropped for r in sorted(T.dedup_lines(df, field_lines=3).collect())] == [0, 1, 1]
    # a line that is not generalised for want of evidence still recurs as it is
    same = make([(i, f"In {1900 + i}, the king of Spain was crowned in Madrid.", "en", "a") for i in range(2)])
    assert [r.n_dropped for r in sorted(T.dedup_lines(same).collect())] == [0, 1]


def test_edges(odd, make):
    rows = T.dedup_lines(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text is None and by_id[1].n_lines == 0 and by_id[2].text == "" and by_id[2].n_lines == 1
    assert by_id[3].text == " \t\n" and by_id[6].n_dropped == 0 and by_id[7].n_dropped == 1
    assert T.dedup_lines(make([])).count() == 0


def brute(rows):
    """The template tree line by line: leaves, supports and templates as plain dictionaries."""
    def fields_leave_enough(tokens):
        words = sum(t != T.FIELD for t in tokens)
        return words >= T.LEAST_WORDS and words >= len(tokens) * T.WORD_SHARE

    cut = {}  # (document, line number): masked line
    for doc, text in rows:
        for no, line in enumerate((text or "").split("\n") if text is not None else []):
            line = re.sub(r"[ \t\x0b\f\r]+", " ", line).strip(" ")
            masked = [T.FIELD if re.search("[0-9]", t) else t for t in line.split(" ")]
            cut[doc, no] = " ".join(masked) if fields_leave_enough(masked) else line

    def leaf(line):
        tokens = line.split(" ")
        if len(tokens) >= T.LEAST_TOKENS:
            return len(tokens), *tokens[: T.DEPTH]
        return (len(tokens), line) if len(line.encode()) >= T.LEAST_BYTES else None

    docs_of = {}
    for (doc, _), line in cut.items():
        if leaf(line):
            docs_of.setdefault(line, set()).add(doc)
    leaves, support, template = {}, {}, {}
    for line in docs_of:
        leaves.setdefault(leaf(line), []).append(line)
    open_ = [line for line in docs_of if len(leaves[leaf(line)]) > 1 and len(line.split(" ")) >= T.GENERAL_TOKENS]
    for line in open_:
        for place in enumerate(line.split(" ")):
            support[leaf(line), place] = support.get((leaf(line), place), 0) + len(docs_of[line])
    for line in docs_of:
        template[line] = line
        if line in open_:
            own = [support[leaf(line), place] for place in enumerate(line.split(" "))]
            usual = sorted(own, reverse=True)[math.ceil(len(own) * T.CONSTANT_SHARE) - 1]
            general = [t if n > usual * T.FIELD_SHARE else T.FIELD for t, n in zip(line.split(" "), own)]
            template[line] = " ".join(general) if fields_leave_enough(general) else line
    sharing = Counter(template[line] for line in open_)
    for line in open_:
        if sharing[template[line]] < T.FIELD_LINES:
            template[line] = line
    homes = {}
    for line, docs in docs_of.items():
        homes.setdefault(template[line], set()).update(docs)
    gone = {at for at, line in cut.items() if leaf(line) and len(homes[template[line]]) >= T.LEAST_DOCS and at[0] != min(homes[template[line]])}
    out = []
    for doc, text in rows:
        lines = [] if text is None else text.split("\n")
        left = [x for no, x in enumerate(lines) if (doc, no) not in gone]
        out.append((doc, len(lines), len(lines) - len(left), None if text is None else "\n".join(left)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_plain_dictionaries(make, seed):
    rng = random.Random(seed)
    words = ["order", "from", "host", "was", "sent", "to", "the", "main", "door", "at", "noon", "été", "日本"]
    shapes = [[rng.choice([rng.choice(words)] * 4 + ["#", "%"]) for _ in range(rng.choice([1, 3, 5, 7, 8, 9, 12]))] for _ in range(12)]

    def line():
        filled = [str(rng.randrange(9)) + "x" if t == "#" else rng.choice("abcdefgh") + "q" if t == "%" else t for t in rng.choice(shapes)]
        return rng.choice([" ", " ", "  ", "\t"]).join(filled) + rng.choice(["", "", " ", "\r"])

    rows = [(i, "\n".join(line() for _ in range(rng.randrange(1, 9)))) for i in range(120)] + [(200, None), (201, ""), (202, "\n\n")]
    got = sorted((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in T.dedup_lines(make([(*r, "en", "a") for r in rows])).collect())
    want = brute(rows)
    assert got == want
    assert 0 < sum(w[2] for w in want) < sum(w[1] for w in want)
