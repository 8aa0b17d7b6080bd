import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from awkward import LONG, awkward_rows, documents
from pyspark.sql import functions as F
from tabularium.llm import crf, personal
from tabularium.llm.personal_lines import LINES

# The forms of the plain kinds as they are given, without any care for long runs.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# Written apart from the labelled lines.
HELD_OUT = [
    "Please drop a line to <email:bob.jones (at) acme [dot] co [dot] uk> before Monday",
    "questions? <email:helpdesk [at] uni [dot] example [dot] edu> will know",
    "Anfragen an <email:presse(at)verlag.de> richten",
    "vous pouvez joindre <email:claire (arobase) societe.fr> ici",
    "my number is <phone:(743) 555-3824> if you need it",
    "Rufen Sie <phone:0171 2345678> an",
    "Tel. <phone:089/63648018> abends",
    "give us a call on (<phone:0161) 496 0000> today",
    "appelez <phone:01 42 68 53 00> vite",
    "he paid by card <card:4539.1488.0343.6467> yesterday",
    "Kreditkarte <card:4716/1082/9997/9531> belastet",
    "traffic from <ip:10[.]20[.]30[.]40> was dropped",
    "the host <ip:192 . 168 . 17 . 4> is slow",
    "we sold 120 of 400 cars in 2004 at 30,000 dollars each",
    "on 2021-03-04 at 10:15:22 it rained",
    "order 8007782375593431 was sent",
    "see section 4.2.1.3 and page 17",
    "he stood at the door (at 9 or so) and left",
    "un point de 12 lignes",
    "size 20 x 30 x 40 cm, 5 pieces",
    "release 2.14.0 fixes 37 faults",
]


def naive_spans(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and naive_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(FORMS).index(s[2])))


def naive_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


@pytest.mark.parametrize("letters", ["0123456789.- +()", "ab@.-_%+é", "15 .@+-a\n🙂"])
def test_plain_spans_are_those_of_the_forms(letters):
    rng = random.Random(letters)
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 60)))
        assert personal.plain_spans(text) == naive_spans(text)


def test_plain_forms_that_pass_and_fail():
    text = "a@b.c_x@y.z 1.2.3.4.5.6.7.8 256.1.1.1; 4111 1111-1111 1111; 4111111111111112; +1 (743) 555-3824; +12 3"
    assert personal.written(personal.plain_spans(text)) == (
        "email:0:5,email:5:11,ip:12:19,ip:20:27,card:39:58,phone:78:95"
    )


def random_field(rng, features, kinds):
    return crf.Field(rng.normal(size=(features, kinds)), rng.normal(size=(kinds, kinds)), rng.normal(size=kinds))


def paths(field, active, kinds):
    """Every path of one sequence with its score."""
    scores = crf.emissions(field, active)
    for path in itertools.product(range(kinds), repeat=len(active)):
        steps = sum(field.steps[a, b] for a, b in itertools.pairwise(path))
        yield path, field.first[path[0]] + steps + sum(scores[k, y] for k, y in enumerate(path))


def test_viterbi_and_likelihood_equal_all_paths():
    rng = np.random.default_rng(2)
    field, active = random_field(rng, 9, 3), rng.integers(0, 9, (12, 2))
    bounds, labels = np.array([0, 1, 6, 7, 12]), rng.integers(0, 3, 12)
    best = crf.viterbi(field, crf.emissions(field, active), bounds)
    lost = 0.0
    for a, b in itertools.pairwise(bounds.tolist()):
        found = dict(paths(field, active[a:b], 3))
        assert tuple(best[a:b]) == max(found, key=found.get)
        lost += np.log(sum(np.exp(list(found.values())))) - found[tuple(labels[a:b])]
    assert np.isclose(crf.loss(field, active, bounds, labels)[0], lost)


def test_gradient_equals_differences():
    rng = np.random.default_rng(4)
    field, active = random_field(rng, 5, 3), rng.integers(0, 5, (8, 2))
    bounds, labels = np.array([0, 3, 8]), rng.integers(0, 3, 8)
    _, gradient = crf.loss(field, active, bounds, labels)
    for x, g in zip(field, gradient, strict=True):
        for at in np.ndindex(x.shape):
            ends = []
            for step in (1e-5, -2e-5):
                x[at] += step
                ends.append(crf.loss(field, active, bounds, labels)[0])
            x[at] += 1e-5
            assert np.isclose((ends[0] - ends[1]) / 2e-5, g[at], atol=1e-5)


@pytest.fixture(scope="module")
def model(spark):
    return personal.learn(personal.labelled_lines(spark))


def found(spark, model, texts):
    rows = documents(spark, texts).select("doc_id", personal.find(F.col("text"), model).alias("f")).collect()
    return [r.f for r in sorted(rows)]


def test_other_forms_of_lines_not_trained_on(spark, model):
    lines = [personal.vary(line, random.Random(1)) for line in HELD_OUT]
    right = told = wanted = 0
    for row, (text, spans) in zip(found(spark, model, [t for t, _ in lines]), lines, strict=True):
        assert row.plain == personal.written(personal.plain_spans(text))
        expected = set(personal.written(spans).split(",")) - {""}
        given = set(row.spans.split(",")) - {""} - set(row.plain.split(","))
        right, told, wanted = right + len(expected & given), told + len(given), wanted + len(expected)
    assert right >= 0.8 * wanted and right >= 0.9 * told


def test_plain_spans_stay_and_positions_are_code_points(spark, model):
    text = "🙂 é: a@b.co, ruf (743) 555-3824, 漢字, host 10[.]20[.]30[.]40 down, +49 30 1234567"
    (row,) = found(spark, model, [text])
    assert row.plain == "email:5:11,phone:66:80" == personal.written(naive_spans(text))
    assert {*row.plain.split(",")} < {*row.spans.split(",")}
    assert personal.mask(text, row.spans) == "🙂 é: [email], ruf [phone], 漢字, host [ip] down, [phone]"
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 0, 0, 1)


def test_spans_do_not_depend_on_neighbours(spark, model):
    rng = random.Random(5)
    texts = ["\n".join(personal.vary(rng.choice(LINES), rng)[0] for _ in range(rng.randint(0, 4))) for _ in range(200)]
    texts += ["john (at) example.com\n\nat example.com", "at 5", "", "@", "1"]
    together = found(spark, model, texts)
    known = model.value
    for text, row in zip(texts, together, strict=True):
        added = []
        for piece in personal.pieces(pa.array([text])):
            spans = [(a, b, kind) for _, a, b, kind in personal._field_spans(piece, known)]
            added = personal._added(text, text.encode(), spans, personal.plain_spans(text))
        every = sorted(personal.plain_spans(text) + added, key=personal._place)
        assert row.spans == personal.written(every)


def test_awkward_rows(spark, model):
    docs = awkward_rows(spark)
    rows = docs.select("*", personal.find(F.col("text"), model).alias("f")).collect()
    assert len(rows) == docs.count()
    assert all(r.f.spans == r.f.plain == "" for r in rows)
    assert docs.limit(0).select(personal.find(F.col("text"), model)).collect() == []


def test_without_labelled_lines_only_plain_spans_are_found(spark):
    model = personal.learn(personal.labelled_lines(spark, []))
    (row,) = found(spark, model, ["a@b.co or (743) 555-3824"])
    assert row.spans == row.plain == "email:0:6"


@pytest.mark.parametrize("unit", ["a", "1", "1 ", "a@", "1.", "+1 ", "x@y.z ", "(at) ", "é1-"])
def test_long_runs_take_seconds(spark, model, unit):
    text = unit * (200_000 // len(unit))
    known = model.value
    begin = time.perf_counter()
    personal.plain_spans(text)
    for piece in personal.pieces(pa.array([text, LONG])):
        list(personal._field_spans(piece, known))
    assert time.perf_counter() - begin < 30
