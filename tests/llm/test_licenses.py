import random
import re

import pytest

from workpulse.llm import licenses as L
from workpulse.llm.queries import QUERIES


@pytest.mark.parametrize(("name", "text"), L.TEMPLATES)
def test_every_template_is_found(name, text):
    inside = f"Some words before it. {text} And others behind it, of no licence at all."
    found = L.text_notices(inside)
    assert (name, 0) in [(n[0], len(n[4])) for n in found]
    assert any(L.words_with_places(inside[n[1] : n[2]])[0] == L.words_with_places(text)[0] for n in found)
    assert re.search(L.CUE, text)


def test_one_word_tells_licenses_apart():
    text = "Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0."
    assert [n[0] for n in L.text_notices(text)] == ["CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0"]
    assert L.text_notices("Licensed under CC BY 5.0.") == []
    assert [n[0] for n in L.text_notices("licensed under the gnu general public licence, VERSION 3 ; this work is licensed under the GNU General Public License, version 3")] == ["GPL-3.0"]


def test_wording_differences():
    long = dict((t, n) for n, t in L.TEMPLATES if t.startswith("Permission is hereby"))
    text = next(iter(long)).replace("free of charge", "without charge").replace("sublicense", "sub-license")
    (found,) = L.text_notices(f"x {text} y")
    assert found[0] == "MIT" and found[4] == ["free of>without", "sublicense>sub license"]
    assert L.text_notices(text.replace("Software", "Work").replace("rights", "duties").replace("copy", "harm").replace("use", "eat").replace("person", "cat")) == []


def test_plain_words_are_no_notice():
    assert L.text_notices("") == []
    assert L.text_notices("He lost his driving licence and asked for permission to drive in the public domain.") == []


def test_longer_form():
    for name, more in (("AGPL-3.0", ""), ("AGPL-3.0-or-later", " or later")):
        text = f"Work. This work is licensed under the GNU Affero General Public License, version 3{more}. Licensed under CC BY 3.0. End."
        assert [n[0] for n in L.text_notices(text)] == [name, "CC-BY-3.0"]


def test_long_text():
    text = "filler words go here " * 20_000 + "Released under the MIT License." + " filler" * 20_000
    (found,) = L.text_notices(text)
    assert text[found[1] : found[2]] == "Released under the MIT License"


def test_query_finds_every_notice(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    notices = {n: t.rstrip(".") for n, t in L.TEMPLATES if len(t) < 80}
    want = {(i, n, m.start()) for i, t in texts.items() for n, s in notices.items() for m in re.finditer(re.escape(s), t)}
    rows = QUERIES["op9_licenses"](spark, sf).collect()
    got = {(r["doc_id"], r["license"], r["start"]) for r in rows}
    assert want and want <= got
    # whatever is found without differences has the words of a template of that license
    own = {(n, *L.words_with_places(t)[0]) for n, t in L.TEMPLATES}
    exact = [r for r in rows if not r["n_differences"]]
    assert all((r["license"], *L.words_with_places(texts[r["doc_id"]][r["start"] : r["end"]])[0]) in own for r in exact)


class Exhaustive(L.Matcher):
    """Every template is aligned at every cue; the fewest differences for the length, then the longest, wins."""

    def confirmed(self, block, cue):
        fits = []
        for number in range(len(self.templates)):
            fit = self.differences(number, block, cue)
            if fit:
                fits.append((len(fit[0]) / len(self.words[number]), -len(self.words[number]), self.templates[number][0], number, fit))
        if not fits:
            return None
        _, _, _, number, fit = min(fits, key=lambda x: x[:3])
        return number, 0, *fit


class Unranked(L.Matcher):
    """Compression switched off: templates in the order of the list."""

    def ranked(self, block):
        return [(0, number) for number in range(len(self.templates))]


def spans(found):
    return [n[:3] for n in found]


def test_agrees_with_the_exhaustive_version():
    """On every template, on pairs of templates, and on changed ones: at least 0.99."""
    mine, every = L.Matcher(), Exhaustive()
    rng = random.Random(1)
    texts = [f"Some words before it. {t} And others behind it." for _, t in L.TEMPLATES]
    texts += [f"Some words. {a[1]} Then others. {b[1]} The end." for a, b in (rng.choices(L.TEMPLATES, k=2) for _ in range(400))]
    for _, t in L.TEMPLATES:
        words = t.split(" ")
        at = rng.randrange(len(words))
        texts.append("Note. " + " ".join([*words[:at], rng.choice(["", "such", words[at] + " own"]), *words[at + 1 :]]) + " The end.")
    same = sum(spans(mine.notices(t)) == spans(every.notices(t)) for t in texts)
    assert same / len(texts) >= 0.99, same / len(texts)


def test_compression_decides():
    """Without the ranking other templates are confirmed first."""
    mine, blind = L.Matcher(), Unranked()
    texts = [t for _, t in L.TEMPLATES] + [f"{a[1]} Then others. {b[1]}" for a, b in zip(L.TEMPLATES, L.TEMPLATES[::-1], strict=True)]
    assert sum(spans(mine.notices(t)) != spans(blind.notices(t)) for t in texts) >= 5


def test_ranking_spares_alignments(monkeypatch):
    counted = {"n": 0}
    real = L.Matcher.differences

    def count(self, *args):
        counted["n"] += 1
        return real(self, *args)

    monkeypatch.setattr(L.Matcher, "differences", count)
    for _, t in L.TEMPLATES:
        L.text_notices(f"Some words before it. {t} And others behind it.")
    assert counted["n"] < len(L.TEMPLATES) ** 2 / 4


def test_time_grows_with_the_notices():
    import time

    took = []
    for n in (250, 2000):
        text = " filler words ".join(["Released under the MIT License."] * n)
        began = time.process_time()
        assert len(L.text_notices(text)) == n
        took.append(time.process_time() - began)
    assert took[1] < 30 * max(took[0], 0.05)


def test_awkward_tables(awkward, empty):
    assert L.license_notices(awkward).count() == 0
    assert L.license_notices(empty).count() == 0


GPL = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
CC = "This work is licensed under a Creative Commons Attribution{} License."


@pytest.mark.parametrize(
    ("name", "text"),
    [
        ("GPL-3.0-or-later", GPL.format("", 3)),
        ("GPL-2.0-or-later", GPL.format("", 2)),
        ("LGPL-3.0-or-later", GPL.format("Lesser ", 3)),
        ("LGPL-2.1-or-later", GPL.format("Lesser ", "2.1").replace("program", "library")),
        ("LGPL-2.0-or-later", GPL.format("Library ", 2).replace("program", "library")),
        ("AGPL-3.0-or-later", GPL.format("Affero ", 3)),
        (None, GPL.format("", 9)),
        (None, GPL.format("Grander ", 3)),
        ("CC-BY-4.0", CC.format(" 4.0 International")),
        ("CC-BY-ND-4.0", CC.format("-NoDerivatives 4.0 International")),
        ("CC-BY-3.0", CC.format(" 3.0 Unported")),
        (None, CC.format(" 3.0 International")),
        (None, CC.format("-NonCommercial 1.0 International")),
        ("GPL-1.0", "This work is licensed under the GNU General Public License, version 1."),
        ("GPL-2.0-or-later", "This work is licenced under the GNU General Public License, version 2 or later."),
        (None, "This work is licensed under the GNU General Public License, version 7."),
        (None, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.0."),
    ],
)
def test_siblings_and_versions_are_told_apart(name, text):
    assert [n[0] for n in L.text_notices(f"Some words before it. {text} And others behind it.")] == ([name] if name else [])
