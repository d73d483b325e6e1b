"""Personal data: base patterns against plain regular expressions, the field against all segmentations."""

import hashlib
import itertools
import math
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import pii
from tierline.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    found = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return found + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(list("@.+-%_ ab()015") + ["a@b.c", "1.2.3.4", "4111111111111111", "+1 (555) 123-4567", "é", "\n"]), max_size=40).map("".join))
def test_base_spans_equal_patterns(text):
    assert pii.base_spans(text) == brute(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 60_000 + "@!", "1" * 60_000, "1." * 30_000, "+1" * 30_000, "a@" * 30_000, "12 " * 20_000):
        pii.all_spans(text, pii.Model({}, tuple([(0.0,) * 5] * 5)))


def test_real_texts_and_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op5_pii"](spark, folder).collect()
    assert len(rows) == len(texts)
    extra = 0
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for k, _, _ in want) for i in range(4))
        assert r.base_sha256 == hashlib.sha256(pii.spell(want).encode()).hexdigest()
        every = set(r.spans.split(",")) - {""}
        assert set(pii.spell(want).split(",")) - {""} <= every
        extra += len(every) - len(want)
    assert extra <= 10


def random_model(rng, s):
    names = {f for _, _, fs in s.spans for f in fs}
    weights = {(k, f): float(rng.normal()) for k in range(4) for f in sorted(names)}
    return pii.Model(weights, tuple(map(tuple, rng.normal(size=(5, 5)).tolist())))


def every_segmentation(n, arcs):
    def go(at):
        if at == n:
            yield ()
        for i, j, kind, score in arcs:
            if i == at:
                for rest in go(j):
                    yield ((i, j, kind, score), *rest)

    return go(0)


def test_field_against_all_segmentations():
    rng = np.random.default_rng(4)
    for text in ("tel 555-123-4567 or", "a@b.co 12", "1.2.3.4 5550", "x"):
        s = pii.Stretch([m.start() for m in pii.TOKEN.finditer(text)] + [len(text)], pii.TOKEN.findall(text))
        pii._candidates(s)
        model = random_model(rng, s)
        arcs = [(k, k + 1, pii.OUTSIDE, 0.0) for k in range(len(s.tokens))]
        arcs += [(i, j, kind, model.score(f, kind)) for i, j, f in s.spans for kind in range(4)]

        def total(path):
            label, value = pii.OUTSIDE, 0.0
            for _, _, kind, score in path:
                value += model.follow[label][kind] + score
                label = kind
            return value

        paths = list(itertools.islice(every_segmentation(len(s.tokens), arcs), 100_000))
        best = max(paths, key=total)
        want = [(kind, i, j) for i, j, kind, _ in best if kind != pii.OUTSIDE]
        assert [(k, i, j) for k, i, j, _ in pii.decode(model, s)] == want
        for kind, i, j, margin in pii.decode(model, s):
            without = [p for p in paths if all(a >= j or b <= i or k == pii.OUTSIDE for a, b, k, _ in p)]
            assert abs(margin - (total(best) - max(map(total, without)))) < 1e-9
        log_z = math.log(sum(math.exp(total(p) - total(best)) for p in paths)) + total(best)
        likelihood, gradient, _ = pii._gradient(dict(model.weights), np.array(model.follow), s, want)
        assert abs(likelihood - (total(best) - log_z)) < 1e-6
        for key in list(gradient)[:5]:
            moved = dict(model.weights)
            moved[key] = moved.get(key, 0.0) + 1e-4
            assert abs((pii._gradient(moved, np.array(model.follow), s, want)[0] - likelihood) / 1e-4 - gradient[key]) < 1e-2


def test_held_out_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = pii.train(docs.filter("doc_id % 3 <> 0"))
    texts = [r.text for r in docs.filter("doc_id % 3 = 0").collect() if pii.base_spans(r.text)]
    right = wrong = missed = 0
    for s, gold in pii._examples(texts):
        got = {(k, i, j) for k, i, j, score in pii.decode(model, s) if score >= pii.MARGIN}
        right, wrong, missed = right + len(got & set(gold)), wrong + len(got - set(gold)), missed + len(set(gold) - got)
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9
    found = pii.all_spans("call (743) 555-3824 now", model)[1]
    assert found == [(3, 5, 19)]


WORDS = "call we the of on to for and house mail street reply tel ask about green road".split()


def planted(n):
    """Texts with one span in one of many spellings, or with another number: (text, span or None)."""
    r = random.Random(1)
    for i in range(n):
        digits = "".join(str(r.randint(2, 9)) for _ in range(10))
        a, b, c = digits[:3], digits[3:6], digits[6:]
        card = "4" + "".join(str(r.randint(0, 9)) for _ in range(14))
        card += next(str(d) for d in range(10) if pii.luhn(card + str(d)))
        four = [card[k : k + 4] for k in range(0, 16, 4)]
        mail = f"{r.choice(['bob', 'amy.lee', 'j_roe', 'k.ito77', 'mary'])}@{r.choice(['site', 'mail3', 'corp', 'north-sea'])}.{r.choice(['org', 'com', 'example.net', 'co.uk'])}"
        day = f"{r.randint(1950, 2040)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}"
        small = [r.randint(0, 99) for _ in range(3)]
        forms = [
            (0, mail), (0, mail.replace("@", " (at) ").replace(".", " (dot) ")), (0, mail.replace("@", "[at]")),
            (0, mail.replace("@", " [at] ").replace(".", "[dot]")), (3, f"({a}) {b}-{c}"), (3, f"{a}-{b}-{c}"),
            (3, f"{a}.{b}.{c}"), (3, f"+1 ({a}) {b}-{c}"), (2, " ".join(four)), (2, ".".join(four)), (2, card),
            (1, ".".join(str(r.randint(0, 255)) for _ in range(4))),
            (None, f"{day} {r.randint(0, 23):02}:{r.randint(0, 59):02}"), (None, day.replace("-", "/")),
            (None, "{}.{}.{}.".format(*small) + str(r.randint(256, 999))), (None, "v{}.{}.1{:03}".format(*small)),
            (None, f"{r.randint(1, 99)},{r.randint(100, 999)},{r.randint(100, 999)}.{r.randint(0, 99):02}"),
            (None, f"{r.randint(1900, 1999)}-{r.randint(2000, 2030)}"),
            (None, f"978-{r.randint(0, 9)}-{r.randint(10, 99)}-{r.randint(100000, 999999)}-{r.randint(0, 9)}"),
        ]
        kind, span = forms[i % len(forms)]
        head = " ".join(r.choices(WORDS, k=2)) + " "
        tail = r.choice([" the road", ", and", ". We", ""])
        yield head + span + tail, None if kind is None else (kind, len(head), len(head) + len(span))


def test_planted_spellings_and_other_numbers(spark):
    model = pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    right = wrong = missed = added = 0
    for text, span in planted(19 * 20):
        base, more = pii.all_spans(text, model)
        got, want = {*base, *more}, {span} - {None}
        right, wrong, missed = right + len(got & want), wrong + len(got - want), missed + len(want - got)
        added += len(set(more) & want)
    assert right / (right + wrong) >= 0.9 and right / (right + missed) >= 0.9 and added > 100
    for text in ("2024-01-02 10:11", "at 10.20.30.400 we", "version 1.2.3 of 2021-03-04T10:11:12"):
        assert pii.all_spans(text, model) == ([], [])
    assert pii.all_spans("john (at) example (dot) com", model)[1] == [(0, 0, 27)]
    assert pii.all_spans("mail bob[at]site.org now", model)[1] == [(0, 5, 20)]


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "a@b.co", "x"), (None, "a@b.co", "x")], "doc_id long, text string, spans string")
    rows = sorted(r.spans for r in pii.scan(docs, pii.train(docs)).collect())
    assert rows == ["", "", "email:0:6", "email:0:6"]
    assert pii.train(docs.limit(0)) is None and pii.scan(docs.limit(0), None).count() == 0
