"""License scans against a plain counterpart."""

import re

import pytest
from helpers import documents, ordered, pairs, texts

from tradeloom.llm import licenses
from tradeloom.llm.license_texts import NOTICES, PHRASES


def cut(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def plain(rows, notices=NOTICES):
    found = []
    for doc, text in rows:
        w = cut(text)
        places = []
        for phrase, label in PHRASES.items():
            p = phrase.split()
            places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
        more = {}
        for label, notice in notices:
            t = cut(notice)
            size, own = 8, set(t)
            while size < len(t):
                size *= 2
            for b in range(0, max(len(w), 1), size):
                k = len(own & set(w[b : b + 2 * size]))
                if 100 * k >= licenses.SHARE * len(own):
                    more.setdefault((b, size, label.split("-")[0]), []).append((k, label, k / len(own)))
        best = [x for group in more.values() for x in group if x[0] == max(group)[0]]
        base = {x[1] for x in places}
        score = 1.0 if places else max((x[2] for x in best), default=0.0)
        at = [x[0] for x in places]
        labels = base | {x[1] for x in best}
        found.append((doc, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score))
    return found


def check(spark, rows):
    got = ordered(map(tuple, licenses.judged(texts(spark, rows)).collect()))
    assert got == ordered(plain(rows))
    return {r[0]: r for r in got}


def noisy(text, step):
    """Every ``step``-th word exchanged."""
    return " ".join("other" if i % step == 1 else w for i, w in enumerate(text.split()))


def test_notices(spark):
    filler = "so it goes on and on with words of all kinds " * 9
    rows = [(i, filler[: 7 * i] + noisy(t, 12) + " " + filler) for i, (_, t) in enumerate(NOTICES)]
    rows += [(100 + i, t.upper()) for i, (_, t) in enumerate(NOTICES)]
    rows += [(200, NOTICES[-1][1] + "\n" + NOTICES[0][1]), (201, filler), (202, NOTICES[1][1][:40])]
    found = check(spark, rows)
    for i, (label, _) in enumerate(NOTICES):
        assert label in found[100 + i][6].split(",")
    assert set(found[200][6].split(",")) >= {NOTICES[-1][0], NOTICES[0][0]}
    assert found[201][6] == found[202][6] == ""


def test_nulls_long_texts_and_repeats(spark):
    note = "Released under the MIT License. Licensed under CC BY-NC 4.0.\x00CC;by\x7fnc"
    rows = [(1, None), (None, ""), (2, note), (2, note), (2, note), (3, "é " * 300_000 + note + " x" * 200_000 + " " + NOTICES[3][1])]
    rows += [(4, "Ünder the MIT license"), (5, "under the MIT"), (6, "under the under the mit license under the mit license")]
    assert check(spark, rows)[3][2] == 3


def test_no_rows(spark):
    assert check(spark, []) == {}


def test_documents(spark):
    docs = documents(spark)
    assert ordered(map(tuple, licenses.judged(docs).collect())) == ordered(plain(pairs(docs)))


def test_templates_must_have_words():
    with pytest.raises(ValueError):
        licenses.Templates([("x", "...")])


def test_all_pairs_are_found(spark):
    """The filters lose no pair: every pair of a block and a template above the threshold is there."""
    templates = licenses.Templates()
    rows = [(i, noisy(t, 5 + i % 5) + " " + NOTICES[(i * 7) % len(NOTICES)][1]) for i, (_, t) in enumerate(NOTICES)]
    scan = licenses.scanned(texts(spark, rows), templates)
    ids = {r.row: r.doc_id for r in scan.filter("kind = 0").collect()}
    got = {(ids[r.row], r.start, r.template, r.overlap) for r in licenses.matches(scan, templates).collect()}
    want = set()
    for doc, text in rows:
        w = [x.encode() for x in cut(text)]
        for no, t in enumerate(templates.all):
            for b in range(0, len(w), t.kind):
                k = len(t.words & set(w[b : b + 2 * t.kind]))
                if k >= t.needed:
                    want.add((doc, b, no, k))
    assert got == want and want
