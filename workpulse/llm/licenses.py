"""License notices by conditional compression, confirmed by exact wording differences.

License wording can't do without a few words (``CUE``). The text is walked from one such word to the next. The
block around it reaches as far on both sides as the longest template, with its tolerance, and back to the last
notice at most. It is compressed with zstandard alone and with each template as a raw dictionary, and the bytes that
a dictionary saves rank the templates. From the best down, a template is confirmed by aligning its words (lower case,
letters and digits) with a stretch of the block that holds the cue: its differences (words left out, put in
or changed within the stretch) must be at most ``DIFFERENCE_RATE`` of its words, and none may fall on a telling word
(``TELLING``: names of licenses, versions, conditions), on either side, or between two of them. The first
template that agrees word for word is the notice, or its longer form where the words go on like that; those ranked
lower are not looked at. Where none agrees, the confirmed one with the fewest differences for its length is,
the better rank first. A template is never given up for its rank: where none is confirmed, all have been tried. Templates of under 10 words must
agree word for word, longer ones in all that tells a license from its siblings and its other versions.

Defined cases: a null or empty text holds none; a very long text is walked whole, in time that grows with its
cues; of templates that save the same number of bytes the first listed is tried first; repeated rows are answered
each; an empty table has no notice; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import difflib
import functools
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The customary short notices of public licenses, and the first sentences of their texts.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released under the CC0 1.0 Universal license."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # siblings and other versions of the licenses above
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Apache-1.1", "Released under the Apache License, Version 1.1."),
    ("BSD-4-Clause", "Licensed under the BSD 4-Clause License."),
    ("ECL-2.0", "Licensed under the Educational Community License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.osedu.org/licenses/ECL-2.0"),
    ("LGPL-2.0-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("NCSA", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal with the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    *(
        (f"{name}-or-later", f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
        for name, kind, version in (("GPL-1.0", "", "1"), ("GPL-2.0", "", "2"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))
    ),
    *(
        (name + ("-or-later" if more else ""), f"This work is licensed under the GNU {kind}General Public License, version {version}{more}.")
        for name, kind, version in (("GPL-1.0", "", "1"), ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3"))
        for more in ("", " or later")
        if more or name not in ("GPL-2.0", "GPL-3.0")
    ),
    ("GPL-2.0", "Licensed under the GNU General Public License v2.0."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    *(
        (f"CC-{code}-{version}", f"This work is licensed under a Creative Commons {name} {version} {area} License.")
        for code, name in (("BY", "Attribution"), ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-SA", "Attribution-ShareAlike"))
        for version, area in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"))
        if version != "4.0" or code in ("BY-NC-ND", "BY-NC-SA", "BY-ND")
    ),
    *(
        (f"CC-{code}-{version}", f"Licensed under CC {code} {version}.")
        for code in ("BY", "BY-NC", "BY-NC-ND", "BY-NC-SA", "BY-ND", "BY-SA")
        for version in ("3.0", "2.5", "2.0")
    ),
)

#: Words that tell a license from another: no difference within the tolerance may take, put or change one.
TELLING = re.compile(
    r"v?\d+|gnu|general|public|lesser|affero|mozilla|apache|educational|community|bsd|mit|isc|clause|unlicense"
    r"|creative|commons|attribution|non|commercial|noncommercial|noderiv\w*|derivatives?|share|alike|sharealike|nc|nd|sa|cc0?"
    r"|international|unported|generic|universal|igo|version|later|only|either|no|not"
)

#: Every template has one of these words, which a difference within the tolerance seldom takes.
CUE = r"(?i)licen[cs]|permission|permitted|redistribut|public domain|free software"
DIFFERENCE_RATE = 0.1
LEVEL = 3
_WORD = re.compile(r"[^\W_]+")


def words_with_places(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    found = [(m.group().lower(), m.span()) for m in _WORD.finditer(text)]
    return [w for w, _ in found], [s for _, s in found]


@functools.lru_cache(maxsize=1)
def _cue() -> re.Pattern:
    return re.compile(CUE)


def cue_words(text: str, places: list[tuple[int, int]]) -> list[int]:
    """Numbers of the words in which a cue begins, ascending."""
    starts = [start for start, _ in places]
    return sorted({max(0, bisect.bisect_right(starts, cue.start()) - 1) for cue in _cue().finditer(text)}) if starts else []


class Matcher:
    """Templates ready to compress with and to compare."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.templates = templates
        self.words = [words_with_places(text)[0] for _, text in templates]
        self.telling = [[TELLING.fullmatch(w) is not None for w in words] for words in self.words]
        own = [" ".join(words).encode() for words in self.words]  # blocks are compared in this form too
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = [
            zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False,
                dict_data=zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for text in own
        ]
        # templates that begin with all words of another, the longest first
        self.longer = [
            sorted((j for j, other in enumerate(self.words) if len(other) > len(own) and other[: len(own)] == own), key=lambda j: -len(self.words[j]))
            for own in self.words
        ]
        # a block holds any stretch that a template can be confirmed for and that has its cue
        self.reach = max(len(words) + int(DIFFERENCE_RATE * len(words)) for words in self.words)

    def ranked(self, block: str) -> list[tuple[int, int]]:
        """(bytes saved by the template as a dictionary, template number), the best first."""
        data = block.encode("utf-8", "surrogatepass")
        alone = len(self.plain.compress(data))
        return sorted(((alone - len(given.compress(data)), i) for i, given in enumerate(self.given)), key=lambda s: (-s[0], s[1]))

    def differences(self, number: int, words: list[str], cue: int) -> tuple[list[str], int, int] | None:
        """Differences of a template from the stretch [first, last] of ``words`` that holds word ``cue`` and that it fits best."""
        wanted = self.words[number]
        allowed = int(DIFFERENCE_RATE * len(wanted))
        best = None
        opening = set(wanted[: allowed + 1])
        for start in range(max(0, cue - len(wanted) - allowed), cue + 1):
            if words[start] not in opening:
                continue
            window = words[start : start + len(wanted) + allowed]
            if window[: len(wanted)] == wanted and start + len(wanted) > cue:
                return [], start, start + len(wanted) - 1
            if not allowed:
                continue
            codes = difflib.SequenceMatcher(None, wanted, window, autojunk=False).get_opcodes()
            # what follows the last agreement isn't part of the notice
            if codes and codes[-1][0] == "insert":
                codes = codes[:-1]
            last = start + max((j2 for op, _, _, _, j2 in codes if op == "equal"), default=1) - 1
            if last < cue:
                continue
            found = [f"{' '.join(wanted[i1:i2])}>{' '.join(window[j1:j2])}" for op, i1, i2, j1, j2 in codes if op != "equal"]
            size = sum(max(i2 - i1, j2 - j1) for op, i1, i2, j1, j2 in codes if op != "equal")
            if size > allowed or any(self.telltale(number, i1, i2, window[j1:j2]) for op, i1, i2, j1, j2 in codes if op != "equal"):
                continue
            if best is None or size < best[0]:
                best = (size, found, start, last)
        return best[1:] if best else None

    def telltale(self, number: int, start: int, end: int, put: list[str]) -> bool:
        """Whether ``put`` in place of words [start, end) of a template makes it the notice of another license."""
        telling = self.telling[number]
        between = 0 < start < len(telling) and start == end and telling[start - 1] and telling[start]
        return between or any(telling[start:end]) or any(TELLING.fullmatch(w) for w in put)

    def confirmed(self, block: list[str], cue: int) -> tuple | None:
        """(template number, bytes saved, differences, first, last) of the notice that holds the cue, by rank.

        The first template that agrees word for word ends the walk down the ranking, as does its longer form if the
        words go on like that. One with differences stands unless a lower one has fewer.
        """
        best = None
        ranking = self.ranked(" ".join(block))
        saved_by = {number: saved for saved, number in ranking}
        for saved, number in ranking:
            fit = self.differences(number, block, cue)
            if fit is None:
                continue
            if fit[0]:
                rate = len(fit[0]) / len(self.words[number])
                if best is None or rate < best[0]:
                    best = (rate, (number, saved, *fit))
                continue
            for longer in self.longer[number]:
                whole = self.differences(longer, block, cue)
                if whole is not None and not whole[0] and whole[1] == fit[1]:
                    return longer, saved_by[longer], *whole
            return number, saved, *fit
        return best[1] if best else None

    def notices(self, text: str) -> list[tuple]:
        """(license, start, end, bytes saved, differences) of the notices in a text, in order of place."""
        words, places = words_with_places(text)
        out, behind = [], 0
        for cue in cue_words(text, places):
            if cue < behind:
                continue  # in the last notice
            low = max(behind, cue - self.reach)
            found = self.confirmed(words[low : cue + self.reach + 1], cue - low)
            if found:
                number, saved, changes, first, last = found
                out.append((self.templates[number][0], places[low + first][0], places[low + last][1], saved, changes))
                behind = low + last + 1
        return out


@functools.lru_cache(maxsize=2)
def _matcher(templates: tuple[tuple[str, str], ...]) -> Matcher:
    return Matcher(templates)


def text_notices(text: str, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> list[tuple]:
    """(license, start, end, bytes saved, differences) of the notices in a text."""
    return _matcher(templates).notices(text)


def license_notices(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES
) -> DataFrame:
    """One row for each notice: id, license, span, bytes saved, number of differences and the differences."""
    kind = dict(docs.dtypes)[id_col]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *n) for i, t in zip(batch["id"], batch["text"], strict=True) for n in text_notices(t, templates)]
            yield pd.DataFrame({
                "id": pd.Series([r[0] for r in rows], dtype="object"), "license": pd.Series([r[1] for r in rows], dtype="object"),
                "start": [r[2] for r in rows], "end": [r[3] for r in rows], "saved": [r[4] for r in rows],
                "n_differences": [len(r[5]) for r in rows], "differences": pd.Series([", ".join(r[5]) for r in rows], dtype="object"),
            })

    # the cue test runs in the JVM: only texts with a cue go to Python
    # Ids go there as text: next to a null, pandas would make long integers floating-point numbers.
    found = docs.select(docs[id_col].cast("string").alias("id"), docs[text].cast("string").alias("text")).where(
        F.col("text").rlike(CUE)
    )
    notices = found.mapInPandas(
        scan, "id string, license string, start int, end int, saved int, n_differences int, differences string"
    )
    return notices.select(F.col("id").cast(kind).alias(id_col), *notices.columns[1:])
