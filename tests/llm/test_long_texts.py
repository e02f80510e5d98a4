"""Ten megabytes of the shapes that a careless scan goes through again and again, and texts of awkward characters."""

import random
import re
import time

import pytest

from scorewatch.llm import crf, licenses, main_text, pii, secret_scan

SIZE = 10_000_000
LIMIT = 100


@pytest.fixture(scope="module")
def field():
    return pii.SkipChain.fit(*pii._merged(pii.made_up_graphs()), len(pii.TAGS))


@pytest.fixture(scope="module")
def chain():
    return crf.Chain.fit(list(secret_scan.made_up_runs()), 3)


def filled(shape, size=SIZE):
    return shape * (size // len(shape))


@pytest.mark.parametrize(
    "text",
    ["@" + "a" * SIZE, "a" * SIZE + "@", "1" * SIZE, filled("1."), filled("1 "), "+1" + "(" * SIZE, filled("a@"), filled("+")],
    ids=["blob", "local", "digits", "dots", "card", "phone", "ats", "plus"],
)
def test_personal_data_patterns(text):
    start = time.time()
    pii.base_spans(text)
    assert time.time() - start < LIMIT


def test_emails_are_those_of_the_pattern():
    r = random.Random(2)
    for _ in range(20_000):
        text = "".join(r.choice("ab@@..-_%+ é") for _ in range(r.randint(0, 24)))
        want = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        assert pii.emails(text) == want, text
        digits = "".join(r.choice("12..- ") for _ in range(r.randint(0, 24)))
        for ours, pattern in ((pii.IP, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), (pii.CARD, r"[0-9]([\x20-]?[0-9])+")):
            assert [m.span() for m in ours.finditer(digits)] == [m.span() for m in re.finditer(pattern, digits)], digits


def test_many_spans(field, chain):
    """Hundreds of thousands of spans in one text, of the patterns and of the model."""
    start = time.time()
    text = filled("write a1@mail1.example.com now, server 10.0.0.1 of\n", SIZE // 4)
    base, _ = next(pii.spans_of([text], field))
    assert len(base) == 2 * text.count('@')
    text = filled("pwd = hunterTwoHunter\npassword = abcdef123456\n", SIZE // 20)
    assert secret_scan.all_spans(text, chain)
    assert sum(1 for _ in secret_scan.tagged_runs(text))
    assert time.time() - start < 3 * LIMIT


def test_license_phrases():
    words = licenses.WORD.findall(filled("under the mit license, ", SIZE))
    start = time.time()
    found = licenses.phrase_places(words, licenses.PHRASES)
    assert found[-1] == (len(words) - 4, "mit") and len(found) == len(words) // 4 and time.time() - start < LIMIT


@pytest.mark.parametrize(
    "shape",
    ['<a ">"', "<a '>\"", '<p x="', "<!--", "<article>", "</article>", "<svg/>", "<nav><b>", "<b><li>", "<", "<a", "&amp;", "<div>x"],
)
def test_pages(shape):
    start = time.time()
    for page in (filled(shape), "<nav>" + filled("<b>", SIZE // 20) + filled(shape, SIZE // 20)):
        main_text.main_text(page)
    assert time.time() - start < 2 * LIMIT


def test_no_text_ends_a_job(field, chain):
    r = random.Random(4)
    signs = list("0123456789.,@+-()= :\"'<>/&#;\n\tabkT_") + [
        "³", "²", "⁶", "①", "٣", "１", "१", "½", "Ⅷ", "é", "İ", "ß", "中", "👍", "\x00", "\x85", " ", "﻿", "퟿",
        "token=", "password: ", "AKIA", "mit license", "<p>", "</p>", "<svg/>", "<main>", "&#51;", "&#x110000;", "12.³", "1.2.3.²",
    ]
    assert list(pii.spans_of(["see page 12.³ for more", "10² and 5² and 10⁶ x", "1.2.3.²"], field))
    for _ in range(4000):
        text = "".join(r.choice(signs) for _ in range(r.randint(0, 40)))
        list(pii.spans_of([text], field))
        list(pii.tagged_graph(text))
        secret_scan.all_spans(text, chain)
        licenses.phrase_places(licenses.WORD.findall(text), licenses.PHRASES)
        main_text.main_text(text)
