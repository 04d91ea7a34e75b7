"""The training-data operators find all their rules and formats allow."""

import re

import pytest

from bisque.llm import op01_pii, op06_licenses

from .test_native import op10_jaccard


def ungated(text):
    """Labels of all rules' intervals, neither gated nor by keyword, suppressed by containment."""
    norm = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(op10_jaccard.LOWER))) + " "
    hits = [(m.start(), m.end(), r.priority, i, r.label) for i, r in enumerate(op06_licenses.rules()) for m in re.finditer(r.regex, norm)]
    return sorted({h[4] for h in hits if not any(o[0] <= h[0] and o[1] >= h[1] and (o[2], o[1] - o[0], -o[3]) > (h[2], h[1] - h[0], -h[3]) for o in hits)})


def test_every_license_passes_the_gate(spark):
    texts = ["released under Apache 2.0", "Apache-2.0", "ASL 2.0", "BSD-3-Clause", "2-clause BSD", "new BSD", "FreeBSD", "0BSD", "MIT-0", "MIT no attribution", "NASA open source agreement", "Creative Commons Attribution NonCommercial No Derivatives", "limits, examples, success by 2 and commit no 0"]
    for regex in [x[2].replace("{V}", op06_licenses.VERSION) for x in (*op06_licenses.NAMES, *op06_licenses.SENTENCES)]:
        for core in op06_licenses.cores(regex):
            one = core.replace("[cs]", "c").replace("[1-4]", "4").replace("[05]", "0")
            texts += [one.replace("?", ""), re.sub(" ?[?]", "", one).replace(" ", "--").upper(), re.sub(".[?]", "", one)]
    assert sum(not ungated(t) for t in texts[:-1]) < len(texts) // 20
    for x in op06_licenses.scan(spark.createDataFrame([(t,) for t in texts], "text string")).collect():
        assert sorted({d.label for d in x.detections}) == ungated(x.text), x.text
    assert all(ungated(t) for t in texts[:12])


def test_identifiers(spark):
    ids = {x.replace("[1-4]", "4").replace("[05]", "0").replace("[01]", "1"): label for label, x in op06_licenses.SPDX}
    rows = [(f"x SPDX-License-Identifier: {i.replace(' ', '-')}", label) for i, label in ids.items()]
    for x in op06_licenses.scan(spark.createDataFrame(rows, "text string, want string")).collect():
        assert ({d.label for d in x.detections}, x.score) == ({x.want}, 1.0), x.text


CARD, SPANISH, BELGIAN = "4111 1111 1111 1111", "ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034"


@pytest.mark.parametrize(
    ("text", "value", "kind"),
    [
        (f"{CARD} 12/27", CARD, "card"), ("4111111111111111 123", "4111111111111111", "card"), (f"12 {CARD}", CARD, "card"), (f"12345 {CARD}", CARD, "card"), (f"+1 {CARD} 9", CARD, "card"), (f"AB13 CDEF GHIJ KLMN {CARD}", CARD, "card"),
        (f"2020-13-45 {CARD} 123", CARD, "card"), (f"{SPANISH} BIC", SPANISH, "iban"), (f"{SPANISH} EUR 20", SPANISH, "iban"), (f"{BELGIAN} EUR", BELGIAN, "iban"), (f"AB13 {BELGIAN}", BELGIAN, "iban"),
        ("+49 30 123458 2024 12 31", "+49 30 123458", "phone"),
    ],
)
def test_values_beside_digits_and_capitals(text, value, kind):
    new, n, found = op01_pii.Pseudonyms(b"k").apply(text)
    assert value not in new and n == len(found) == 1 and found[0]["kind"] == kind and len(new) == len(text)
    if kind != "phone":
        at = text.index(value)
        assert (found[0]["start"], found[0]["stop"]) == (at, at + len(value))
        assert new[:at] == text[:at] and new[at + len(value) :] == text[at + len(value) :]


def test_values_inside_one_group_stay():
    for text in ("4111111111111111123", "x 1234111111111111111 y", "ES9121000418450200051332BIC", "12 34 56"):
        assert op01_pii.Pseudonyms(b"k").apply(text)[:2] == (text, 0), text
